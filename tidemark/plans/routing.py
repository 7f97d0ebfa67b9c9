"""Which files serve a group: folders in tiers, then suitability by molecule and length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import texts

#: Fixed values of the suitability rule.
GENOME_NT, RATIO, PARENT = 8000, (0.6, 1.5), 1.2


def folder_tiers(virus: Column, host: Column, segment: Column) -> Column:
    """Folders to look in, best first."""
    v, h = F.trim(F.coalesce(virus, F.lit(""))), F.lower(F.trim(F.coalesce(host, F.lit(""))))
    known = h.isin("human", "avian")
    def path(*parts):
        return F.concat_ws("/", F.lit("IAV"), *parts)
    s = segment.isNotNull()
    iav = F.array(
        F.when(known & s, path(h, segment)), F.when(s, path(F.lit("all"), segment)), F.when(known, path(h)), path(F.lit("all")), F.lit("IAV"))
    return F.when(v == "IAV", F.array_distinct(F.array_compact(iav))).otherwise(F.array(v))


def in_folder(folder: Column, prefix: Column) -> Column:
    clean = F.replace(folder, F.lit("\\"), F.lit("/"))
    return (clean == prefix) | F.startswith(clean, F.concat(prefix, F.lit("/")))


def ancestors(folder: Column) -> Column:
    """The folder and all above it, so that a prefix match is an equi-join."""
    parts = F.split(F.replace(folder, F.lit("\\"), F.lit("/")), "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def best_tier(groups: DataFrame, files: DataFrame, group: str = "group_id", file: str = "path") -> DataFrame:
    """Pairs of a group and the files of its first tier that has any. groups: group, tiers. files: file, folder."""
    tiers = groups.select(group, F.posexplode("tiers").alias("tier", "prefix"))
    places = files.select(file, F.explode(ancestors(F.col("folder"))).alias("prefix"))
    pairs = tiers.join(places, "prefix")
    first = pairs.groupBy(group).agg(F.min("tier").alias("tier"))
    return pairs.join(first, [group, "tier"]).select(group, "tier", "prefix", file)


def suitability(molecule: Column, state: Column, median: Column, reference: Column, parent: Column) -> Column:
    """The mode in which a file serves a reference, or null. All lengths as numbers; ratio bounds are included."""

    def within(length: Column, of: Column) -> Column:
        return (of > 0) & (length / of).between(*RATIO)

    aligned = state == "aligned"
    aa = median / 3.0
    return (
        F.when((molecule == "protein") & within(median, reference), F.when(aligned, "protein_aligned").otherwise("protein_raw"))
        .when(molecule != "nucleotide", None)
        .when(median >= GENOME_NT, F.when(aligned, "genome_aligned").otherwise("genome"))
        .when(within(aa, reference), F.when(aligned, "cds_aligned").otherwise("cds"))
        .when((parent >= PARENT * reference) & within(aa, parent), F.when(aligned, "subregion_aligned").otherwise("subregion"))
    )


def segment_allows(path: Column, folder: Column, segment: Column) -> Column:
    """Whether neither the file's name nor its folder hints at another segment."""
    hint = F.coalesce(texts.segment_of_file(path), F.nullif(F.regexp_extract(folder, r"(?:^|/)(PB2|PB1|PA|HA|NA|NP)(?:/|$)", 1), F.lit("")))
    return segment.isNull() | hint.isNull() | (hint == segment)


def route(groups: DataFrame, inventory: DataFrame) -> DataFrame:
    """group_id, path, tier, mode (null: not suitable), reason. groups as of `grouping.groups`, inventory as of `read_inventory`."""
    tiers = groups.withColumn("tiers", folder_tiers(F.col("virus_code"), F.col("host"), F.col("segment")))
    pairs = best_tier(tiers, inventory).join(inventory, "path").join(groups.select("group_id", "ref_len", "parent_len", "segment"), "group_id")
    mode = suitability(F.col("molecule"), F.col("state"), F.col("median_length"), F.col("ref_len"), F.col("parent_len"))
    ok = segment_allows(F.col("path"), F.col("folder"), F.col("segment"))
    reason = F.when(~ok, "other segment").when(mode.isNull(), F.format_string("%s median %d for a reference of %d", "molecule", "median_length", "ref_len"))
    return pairs.select("group_id", "path", F.col("prefix").alias("tier"), F.when(ok, mode).alias("mode"), reason.alias("reason"), "n_records", "rel_path", "state")


def plan_status(groups: DataFrame, routed: DataFrame) -> DataFrame:
    """group_id and status: planned, no folder or no suitable file."""
    found = routed.groupBy("group_id").agg(F.bool_or(F.col("mode").isNotNull()).alias("some"))
    return groups.select("group_id").join(found, "group_id", "left").select("group_id", F.when(F.col("some"), "planned").when(F.col("some").isNull(), "no folder").otherwise("no suitable file").alias("status"))


def lengths_within(left: DataFrame, right: DataFrame, a: str, b: str, low: float = RATIO[0], high: float = RATIO[1]) -> DataFrame:
    """Pairs with low <= a / b <= high, by an equi-join of logarithmic buckets: a row of the right side stands in three of them.

    a and b are positive lengths; a row with length 0 or null has no pair."""
    base = F.log(F.lit(high / low))

    def bucket(c):
        return F.floor(F.log(F.col(c).cast("double")) / base).cast("long")

    x = left.where(F.col(a) > 0).withColumn("_b", bucket(a))
    y = right.where(F.col(b) > 0).withColumn("_b", F.explode(F.array(*(bucket(b) + k for k in (-1, 0, 1)))))
    return x.join(y, "_b").where((F.col(a) / F.col(b)).between(low, high)).drop("_b")
