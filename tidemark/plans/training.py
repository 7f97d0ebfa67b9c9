"""From the counts of finished chunks to training tables, and the audit of what was merged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates, sequences, texts
from tidemark.sources import files, ordered, tables

#: Fixed columns of the audit.
AUDIT = "group_id motif_tag benchmarks chunks_merged variants_kept variants_dropped_gapX counts_kept counts_dropped_gapX counts_unknown date_range status".split()
MOST_GAPS = 0.10


def planned_motifs(plan: DataFrame) -> DataFrame:
    """group_id, motif_tag, benchmarks, monthly, min_year of each motif of a plan."""
    code = F.create_map(*(F.lit(x) for kv in dates.MIN_YEAR.items() for x in kv))
    m = plan.select("group_id", "virus_code", "binning", F.explode("motifs").alias("m"))
    return m.select(
        "group_id", texts.safe_tag("m.tag").alias("motif_tag"), "m.benchmarks", (F.col("binning") == "monthly").alias("monthly"),
        F.coalesce(F.try_element_at(code, F.col("virus_code")), F.lit(dates.DEFAULT_MIN_YEAR)).alias("min_year"))


def chunk_counts(spark: SparkSession, chunks: DataFrame) -> DataFrame:
    """group_id, chunk, motif_tag, nt, aa, bin, n of the wide tables of chunks (folder, chunk, counts_by_motif as of `catalogue.probe`, path prefixed already)."""
    each = chunks.select("folder", "chunk", F.explode("counts_by_motif").alias("motif_tag", "path"))
    paths = [r.path for r in each.select("path").distinct().toLocalIterator()]
    if not paths:
        return spark.createDataFrame([], "group_id string, chunk string, motif_tag string, nt string, aa string, bin string, n long")
    long = tables.read_wide_tables(spark, paths)
    rows = long.join(each.select(F.col("folder").alias("group_id"), "chunk", "motif_tag", F.regexp_replace("path", "^file:/+", "/").alias("path")), "path")
    return rows.select("group_id", "chunk", "motif_tag", F.trim("nt").alias("nt"), F.trim("aa").alias("aa"), "bin", "n")


def merged(counted: DataFrame, motifs: DataFrame, max_year: int | None = None) -> DataFrame:
    """group_id, motif_tag, nt, aa, bin, n over all chunks; implausible bins are `unknown`, empty peptides are left out."""
    rows = counted.join(motifs.select("group_id", "motif_tag", "monthly", "min_year"), ["group_id", "motif_tag"])
    valid = F.when(F.col("monthly"), dates.label_valid("bin", True, F.col("min_year"), max_year)).otherwise(dates.label_valid("bin", False, F.col("min_year"), max_year))
    bin_ = F.when(valid, F.col("bin")).otherwise("unknown")
    return rows.where("aa <> ''").groupBy("group_id", "motif_tag", "nt", "aa", bin_.alias("bin")).agg(F.sum("n").cast("long").alias("n"))


def audit(found: DataFrame, motifs: DataFrame, counted: DataFrame) -> DataFrame:
    """A row per planned motif: what was kept and dropped by the gap filter, unknown dates and the range of dates; `no count files yet` where nothing was counted."""
    keep, known = sequences.gap_share("aa") <= MOST_GAPS, F.col("bin") != "unknown"
    rows = found.groupBy("group_id", "motif_tag", "nt", "aa").agg(
        F.sum("n").alias("n"), F.min(F.when(known, F.col("bin"))).alias("low"), F.max(F.when(known, F.col("bin"))).alias("high"), F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("u"))
    def total(c, condition):
        return F.coalesce(F.sum(F.when(condition, F.col(c))), F.lit(0)).cast("long")

    facts = rows.groupBy("group_id", "motif_tag").agg(
        F.count(F.when(keep, 1)).alias("variants_kept"), F.count(F.when(~keep, 1)).alias("variants_dropped_gapX"), total("n", keep).alias("counts_kept"), total("n", ~keep).alias("counts_dropped_gapX"),
        F.sum("u").cast("long").alias("counts_unknown"), F.concat_ws("..", F.min("low"), F.max("high")).alias("date_range"))
    chunks = counted.groupBy("group_id", "motif_tag").agg(F.count_distinct("chunk").alias("chunks_merged"))
    out = motifs.join(chunks, ["group_id", "motif_tag"], "left").join(facts, ["group_id", "motif_tag"], "left")
    number = [c for c in AUDIT if c.startswith(("chunks", "variants", "counts"))]
    out = out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in number} | {"date_range": F.coalesce("date_range", F.lit("")), "benchmarks": F.concat_ws(";", "benchmarks")})
    return out.withColumn("status", F.when(F.col("chunks_merged") > 0, "OK").otherwise("no count files yet")).select(*AUDIT)


def rows_for(found: DataFrame, motifs: DataFrame) -> DataFrame:
    """benchmark, nt, aa, bin, n, total of the well-called variants, once per benchmark that a motif serves."""
    kept = found.where(sequences.gap_share("aa") <= MOST_GAPS)
    total = kept.groupBy("group_id", "motif_tag", "nt", "aa").agg(F.sum("n").cast("long").alias("total"))
    fan = motifs.select("group_id", "motif_tag", F.explode("benchmarks").alias("benchmark"))
    return kept.join(total, ["group_id", "motif_tag", "nt", "aa"]).join(fan, ["group_id", "motif_tag"]).select("benchmark", "nt", "aa", "bin", "n", "total")


def tables_of(found: DataFrame, motifs: DataFrame) -> dict[str, ordered.Table]:
    """Of each counted motif its bins in order, `unknown` last, and the files of the benchmarks that it serves; of two motifs that serve one benchmark the last. A plan has some hundred motifs, a calendar some hundred bins."""
    bins = found.where(sequences.gap_share("aa") <= MOST_GAPS).groupBy("group_id", "motif_tag").agg(F.collect_set("bin").alias("bins"))
    counted = found.select("group_id", "motif_tag").distinct().join(bins, ["group_id", "motif_tag"], "left")
    out, owner = {}, {}
    for m in motifs.join(counted, ["group_id", "motif_tag"]).orderBy("group_id", "motif_tag").toLocalIterator():
        labels = sorted({*(m.bins or []), "unknown"}, key=dates.label_order)
        for b in m.benchmarks:
            path = f"{b[:-4] if b.lower().endswith('.csv') else b}_training_counts.csv"
            if path in owner:
                out[owner[path]].paths.remove(path)
            owner[path] = f"{m.group_id}/{m.motif_tag}"
            out.setdefault(owner[path], ordered.Table(labels, [], total=False)).paths.append(path)
    return {k: v for k, v in out.items() if v.paths}


def aggregate(spark: SparkSession, plan: DataFrame, chunks: DataFrame, out: str) -> DataFrame:
    """Writes NAME_training_counts.csv per benchmark, all in one job, and _aggregation_summary.csv; the summary. plan: as of `tables.read_plan`; chunks: as of `catalogue.probe` with whole paths."""
    motifs = planned_motifs(plan)
    counted = chunk_counts(spark, chunks)
    found = merged(counted, motifs)
    tables.write_counts(found, f"{out}/merged_counts")  # the chunks' tables are read once
    found = tables.read_counts(spark, f"{out}/merged_counts", schema=found.schema)
    kept = found.where(sequences.gap_share("aa") <= MOST_GAPS).withColumn("table", F.concat_ws("/", "group_id", "motif_tag"))
    ordered.write_wide(kept, tables_of(found, motifs), out)
    table = audit(found, motifs, counted).orderBy("group_id", "motif_tag")
    files.write_csv(table, f"{out}/_aggregation_summary.csv")
    return table
