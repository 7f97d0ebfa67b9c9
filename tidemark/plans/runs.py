"""Runs over folders of datasets: each file is detected, aligned and counted by its own configuration; stage counters, summary, integration.

The loop is over files, of which a folder has some dozens; each file's work is distributed. What a later step reads more than once is
written to the dataset's output folder first, so nothing is aligned twice, and stages are counted there."""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import dates, sequences, texts
from tidemark.operators import align, coding, counts, motif, profile
from tidemark.plans import integration, pipeline
from tidemark.plans.catalogue import MARKER
from tidemark.plans.integration import STORE
from tidemark.sources import config as configs
from tidemark.sources import fasta, files, ordered
from tidemark.sources.config import Config

#: Fixed columns of a run's summary; text ones, all others are numbers.
SUMMARY = (
    "dataset status detected protein_ref motif_ref motifs input_sequences orf_in orf_kept orf_dropped_no_orf cds_in cds_kept cds_dropped_short protein_in "
    "hmm_dropped_long aligned motif_kept motif_dropped_ambig motif_dropped_nt counted_records unique_variants unknown_date motif_detail error"
).split()
TEXTS = frozenset("dataset status detected protein_ref motif_ref motifs motif_detail error".split())
FRAGMENTS = "motif_fragments"


@dataclass
class Options:
    monthly: bool = False
    start_year: int | None = None
    orf_share: float = 0.5
    orf_least: int | None = None
    least_called: float = motif.LEAST_CALLED


def names(dataset: str, tags: list[str], monthly: bool) -> list[tuple[str | None, str, str, str]]:
    """(tag, infix, prefix of the motif's files, name of the count table) of each count job. A single motif called `motif` has no infix, and so has a run without motifs."""
    ending = f"_counts_by_{'month' if monthly else 'year'}_wide.csv"
    if not tags:
        return [(None, "", dataset, dataset + ending)]
    if tags == ["motif"]:
        return [("motif", "", f"{dataset}_motif", dataset + ending)]
    return [(t, f"_{t}", f"{dataset}_{t}_motif", f"{dataset}_{t}{ending}") for t in tags]


def seen(rows: DataFrame, **sums) -> tuple[DataFrame, Observation]:
    """rows, observed while they are written: `n`, and the sum of each condition."""
    o = Observation()
    return rows.observe(o, F.count(F.lit(1)).alias("n"), *(F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(k) for k, c in sums.items())), o


def stored(rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _as_fasta(rows: DataFrame, prefix: str, columns: dict[str, str]) -> None:
    """Folders PREFIX_KIND.fasta of a stored table's columns, in the order of its records."""
    for kind, column in columns.items():
        fasta.write_fasta(rows, f"{prefix}_{kind}.fasta", column, pipeline.ORDER)


def _coding(records: DataFrame, c: Config, facts: pipeline.Facts, o: Options, out: str, stats: dict) -> DataFrame:
    """The raw sequences' peptides and nucleotides."""
    watched, n = seen(records)
    if facts.molecule == "protein":
        rows = stored(watched.withColumn("aa", F.col("seq")), f"{out}/coding")
        stats |= {"protein_in": n.get["n"], "input_sequences": n.get["n"]}
        return rows
    least = coding.least_length(len(c.protein), o.orf_share, o.orf_least)
    genome = profile.is_genome(facts.median_len, len(c.protein))
    if genome:
        made = coding.extract_orfs(watched, c.protein, least)
        note = texts.annotation("orf", F.length("aa"), F.col("frame"), F.col("score"))
    else:
        made = coding.translate_cds(watched, least)
        note = texts.annotation("cds", F.length("aa"), F.col("frame"))
    rows = stored(made.withColumn("description", F.concat_ws(" ", F.expr("nullif(description, '')"), note)), f"{out}/coding")
    if genome:
        _as_fasta(rows, f"{out}/{stats['dataset']}_orf", {"proteins": "aa", "nucleotides": "nt"})
    total, kept = n.get["n"], rows.count()
    stats |= {"input_sequences": total, **({"orf_in": total, "orf_kept": kept, "orf_dropped_no_orf": total - kept} if genome else {"cds_in": total, "cds_kept": kept, "cds_dropped_short": total - kept})}
    return rows


def process(spark: SparkSession, path: str, dataset: str, c: Config, out: str, o: Options) -> tuple[dict, DataFrame]:
    """The stage counters of one file, and its long counts (infix, motif_tag, nt, aa, year, month, n); writes its tables to `out`. An error if nothing is left to count.

    The folder is made beside `out` and takes its place when all is in it: a run that fails or is stopped leaves what was there before, whole."""
    files.recover(spark, out)
    made = files.making(spark, out)
    try:
        stats, schema = _process(spark, path, dataset, c, made, o)
        files.publish(spark, made, out)
    finally:
        files.discard(spark, made)
    return stats, spark.read.schema(schema).parquet(f"{out}/{STORE}/*")


def _process(spark: SparkSession, path: str, dataset: str, c: Config, out: str, o: Options) -> tuple[dict, StructType]:
    stats: dict = {"dataset": dataset, "protein_ref": "yes" if c.protein else "no", "motif_ref": "yes" if c.motifs else "no", "motifs": ";".join(m.tag for m in c.motifs)}
    records = pipeline.dated(fasta.read_fasta(spark, path))
    facts = pipeline.detect(records)
    nucleotide = facts.molecule == "nucleotide"
    stats["detected"] = f"{facts.molecule}/{'aligned' if facts.aligned else 'raw'}"
    if facts.aligned:
        watched, n = seen(records)
        rows = stored(watched, f"{out}/aligned")
        stats["input_sequences"] = n.get["n"]
        rows = rows.withColumns({"aln_nt": F.col("seq")} if nucleotide else {"aln_aa": F.col("seq"), "nt": F.lit("")})
    else:
        if c.protein is None:
            raise ValueError("raw sequences need a protein reference")
        made = _coding(records, c, facts, o, out, stats)
        rows = stored(align.align_to_reference(made, c.protein, nt="nt" if nucleotide else None, apart=pipeline.ORDER), f"{out}/aligned")
        stats |= {"hmm_dropped_long": made.where(F.length("aa") > align.longest_query(len(c.protein))).count(), "aligned": rows.count()}
        _as_fasta(rows, f"{out}/{dataset}_aligned", {"proteins": "aln_aa"} | ({"nucleotides": "aln_nt"} if nucleotide else {}))
    width = motif.codon_width(facts.median_len) if c.motifs and facts.aligned and nucleotide else facts.median_len if facts.aligned else len(c.protein)
    text = functools.cache(lambda: motif.consensus(rows, width, "aln_nt" if facts.aligned and nucleotide else "aln_aa", F.struct(*pipeline.ORDER), coding=facts.aligned and nucleotide))
    details, longs, made = [], [], {}
    for (tag, infix, prefix, table), m in zip(names(dataset, [m.tag for m in c.motifs], o.monthly), c.motifs or [None], strict=True):
        if m is None:
            found = _whole(rows, facts)
        else:
            found = _motif(rows, m, c, facts, o, text)
            found, n = seen(found, kept=F.col("dropped").isNull(), ambiguous=F.col("dropped") == "ambiguous", nt=F.col("dropped") == "nt")
            found = stored(motif.kept(found).select(*pipeline.ORDER, "description", "nt", "aa", "year", "month"), f"{out}/{FRAGMENTS}/count={prefix}")
            _as_fasta(found, f"{out}/{prefix}", {"proteins": "aa"} | ({"nucleotides": "nt"} if nucleotide else {}))
        long = stored(counts.count_variants(found).select(F.lit(infix).alias("infix"), F.lit(tag or "whole").alias("motif_tag"), "nt", "aa", "year", "month", "n"), f"{out}/{STORE}/count={prefix}")
        unknown = F.coalesce(F.sum(F.when(F.col("year").isNull(), F.col("n"))), F.lit(0))
        total, variants, unknown, low, high = long.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_distinct(F.struct("nt", "aa")), unknown, F.min("year"), F.max("year")).first()
        if not total:
            raise ValueError("nothing to count: no record came through" + (f" for motif {tag}" if tag else ""))
        for key, value in (("counted_records", total), ("unique_variants", variants), ("unknown_date", unknown)):
            stats[key] = stats.get(key, 0) + value
        if m is not None:
            for key, name in (("motif_kept", "kept"), ("motif_dropped_ambig", "ambiguous"), ("motif_dropped_nt", "nt")):
                stats[key] = stats.get(key, 0) + n.get[name]
            details += [f"{tag}: kept {n.get['kept']:,}", f"{tag}: {variants:,} variants"]
        start, made[prefix] = _calendar(low, high, table, o)
        longs.append(long.groupBy(F.lit(prefix).alias("table"), "nt", "aa", counts.label(o.monthly, start).alias("bin")).agg(F.sum("n").cast("long").alias("n")))
    ordered.write_wide(functools.reduce(DataFrame.unionByName, longs), made, out)
    stats["motif_detail"] = "; ".join(details)
    return stats, long.schema


def _whole(rows: DataFrame, facts: pipeline.Facts) -> DataFrame:
    """nt and aa of whole sequences."""
    if facts.molecule == "nucleotide" and facts.aligned:
        return counts.with_peptide(rows.withColumns({"nt": F.col("aln_nt"), "aa": F.lit(None).cast("string")}))
    return rows.withColumns({"aa": F.col("aln_aa"), "nt": sequences.degap("aln_nt") if facts.molecule == "nucleotide" else F.lit("")})


def _motif(rows: DataFrame, m, c: Config, facts: pipeline.Facts, o: Options, consensus) -> DataFrame:
    """The judged fragments of a motif. consensus: a function that gives the consensus of the rows, made once for all motifs."""
    nucleotide = facts.molecule == "nucleotide"
    if facts.aligned and nucleotide:
        return motif.judged_codons(rows, motif.columns_in_consensus(consensus(), m.parts), "aln_nt", o.least_called)
    columns = pipeline.place(m, "" if facts.aligned else c.protein, rows, consensus)
    return motif.judged(rows, columns, "aln_aa", "aln_nt" if nucleotide else None, o.least_called)


def summary(spark: SparkSession, stats: list[dict]) -> DataFrame:
    """A row per dataset and their TOTAL, in that order."""
    schema = ", ".join(f"{c} {'string' if c in TEXTS else 'long'}" for c in SUMMARY)
    each = spark.createDataFrame([tuple(s.get(c) for c in SUMMARY) for s in stats], schema)
    return counts.with_total(each, "dataset").orderBy(F.col("dataset") == "TOTAL", "dataset")


def _calendar(low: int | None, high: int | None, name: str, o: Options) -> tuple[int, ordered.Table]:
    """The first year of a count table's axis, and the table: the years as given, else as observed, else 2000."""
    start = next(y for y in (o.start_year, low, 2000) if y is not None)
    return start, ordered.Table(dates.calendar(start, start if high is None else high, o.monthly), [name])


def integrated_name(infix: str, o: Options) -> str:
    return f"integrated{infix}_counts_by_{'month' if o.monthly else 'year'}_wide.csv"


def integrate(spark: SparkSession, output: str, o: Options) -> list[str]:
    """One table per motif over all datasets of an output folder, also of earlier runs, all in one job; the paths of those that had to be made again."""
    pending = integration.update(spark, output, {"monthly": o.monthly, "start_year": o.start_year})
    rows = integration.sums(spark, output).where(F.col("infix").isin(pending))
    made, starts = {}, {}
    for r in rows.groupBy("infix").agg(F.min("year").alias("low"), F.max("year").alias("high")).toLocalIterator() if pending else ():
        start, made[r.infix] = _calendar(r.low, r.high, integrated_name(r.infix, o), o)
        starts.setdefault(start, []).append(r.infix)
    bin_ = F.coalesce(*(F.when(F.col("infix").isin(infixes), counts.label(o.monthly, start)) for start, infixes in starts.items()), F.lit(None).cast("string"))
    long = rows.groupBy(F.col("infix").alias("table"), "nt", "aa", bin_.alias("bin")).agg(F.sum("n").cast("long").alias("n"))
    out = ordered.write_wide(long, made, output)
    for infix in sorted(set(pending) - set(made)):  # no dataset has the motif any more
        files.delete(spark, f"{output}/{integrated_name(infix, o)}")
    integration.finish(spark, output)
    return out


def run(spark: SparkSession, folder: str, output: str, o: Options | None = None, dataset: str | None = None, config_text: str | None = None) -> DataFrame:
    """All datasets of a folder (or one): their tables, run_summary.csv and integrated tables; the summary. A dataset's error doesn't stop the others, and what an earlier run made of it stays.

    config_text: of all datasets; else each file's own NAME.txt, or the folder's reference.txt or config.txt."""
    o = o or Options()
    listed = [(r.path, r.dataset) for r in fasta.datasets(spark, folder, dataset).toLocalIterator()]
    if not listed:
        have = ", ".join(r.dataset for r in fasta.datasets(spark, folder).toLocalIterator())
        raise ValueError(f"no FASTA files in {folder}" if dataset is None else f"dataset {dataset!r} is not in {folder}; there are: {have}")
    stats = []
    for path, name in listed:
        try:
            stem = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
            text = config_text if config_text is not None else files.read_text(spark, configs.find(folder, stem, lambda p: files.exists(spark, p)))
            one, _ = process(spark, path, name, configs.parse(text), f"{output}/{name}", o)
            stats.append(one | {"status": "OK", "error": ""})
        except (ValueError, FileNotFoundError) as e:
            stats.append({"dataset": name, "status": "FAILED", "error": str(e)})
    table = summary(spark, stats)
    files.write_csv(table, f"{output}/run_summary.csv")
    integrate(spark, output, o)
    return table


def finish(spark: SparkSession, chunk: str) -> None:
    """Marks a chunk's folder as done."""
    files.write_text(spark, f"{chunk}/{MARKER}", "")

