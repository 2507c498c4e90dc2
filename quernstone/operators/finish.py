"""From groups to packaged rows: canonical rows, operation tags and flags, duplicates, quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions.text import ODD, nfkc_squeezed, strip

# The operation tags that a packaged row may bear.
ALLOWED_OPS = ("remove_header", "merge_lines", "fix_bullets", "fix_hyphenation", "normalize_space", "fallback", "vision_fix")
# Quality of a cleaning call by its outcome.
CLEAN_QUALITY = {"offline": 0.8, "ok": 0.9, "ok_empty": 0.6, "quota_fallback": 0.75, "safety_blocked": 0.72, "finish_max_tokens": 0.72, "finish_safety": 0.72, "finish_recitation": 0.72, "empty": 0.7, "client_error": 0.7}


def canonical_rows(variants: DataFrame, targets: str = "canonical") -> DataFrame:
    """The canonical variants, or all of them, with the tag of where they come from in ops."""
    every = targets == "all"
    rows = variants if every else variants.where("is_canonical")
    return rows.withColumn("ops", F.array(F.lit("from_variant" if every else "canonicalize_from_variants")))


def clean_offline(rows: DataFrame) -> DataFrame:
    """What cleaning gives without a model: the text as it is, no tags, not continuing, the quality of the offline outcome."""
    return rows.withColumn("text_clean_quality", F.lit(CLEAN_QUALITY["offline"])).withColumn("continues", F.lit(False))


def normalize_ops(ops: Column) -> Column:
    """Tags in lower case with underscores, those allowed, each once, sorted; null is none."""
    named = F.transform(F.filter(F.coalesce(ops, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != "")), lambda x: F.replace(F.lower(strip(x)), F.lit(" "), F.lit("_")))
    return F.array_sort(F.array_distinct(F.filter(named, lambda x: x.isin(*ALLOWED_OPS))))


def default_flags(flags: Column) -> Column:
    """Flags with continues and error there, false unless set."""
    base = F.create_map(F.lit("continues"), F.lit(False), F.lit("error"), F.lit(False))
    own = F.coalesce(flags, F.create_map().cast("map<string,boolean>"))
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(own), k)), own)


def dedupe(rows: DataFrame, text_col: str = "text", order: str = "pos") -> DataFrame:
    """The first of the rows of a document and page with the same normalised text, with copies, how many there are.

    Rows meet by key only as positions: the first position of each key is aggregated, then joined back.
    """
    keyed = rows.withColumn(text_col, nfkc_squeezed(F.coalesce(text_col, F.lit("")))).withColumn("text_sha1", F.sha1(text_col))
    first = keyed.groupBy(F.col("document_id").alias("_d"), F.col("page").alias("_p"), F.col("text_sha1").alias("_h")).agg(F.min(order).alias("_first"), F.count("*").alias("copies"))
    same = keyed["document_id"].eqNullSafe(first["_d"]) & keyed["page"].eqNullSafe(first["_p"]) & (keyed["text_sha1"] == first["_h"]) & (keyed[order] == first["_first"])
    return keyed.join(first, same).drop("_d", "_p", "_h", "_first")


def quality_score(text: Column, error: Column) -> Column:
    """0.6 for a scrap; else 0.95, less for an error and for odd characters, between 0 and 1."""
    t = F.coalesce(text, F.lit(""))
    ratio = F.regexp_count(t, F.lit(ODD)) / F.greatest(F.length(t), F.lit(1))
    score = 0.95 - F.when(F.coalesce(error, F.lit(False)), 0.25).otherwise(0.0) - 0.2 * F.least(ratio, F.lit(0.05))
    return F.when(F.length(strip(t)) < 5, 0.6).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))


def package(rows: DataFrame, timestamp: str, version: str = "v1") -> DataFrame:
    """Packaged rows: (chunk_id, document_id, clean_text, ops, flags, quality_score, source_linkage, page_range, version, timestamp).

    timestamp: one literal for the whole run, in UTC.
    """
    return rows.select(
        F.col("id").alias("chunk_id"), "document_id", F.col("text").alias("clean_text"), normalize_ops(F.col("ops")).alias("ops"), default_flags(F.col("flags")).alias("flags"), "quality_score",
        F.struct("page", "offset", "metadata").alias("source_linkage"), F.array("page", "page").alias("page_range"), F.lit(version).alias("version"), F.lit(timestamp).alias("timestamp"),
    )
