"""Boilerplate at the head of a document's first chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions.text import lines

HEAD_CHARS, HEAD_LINES, PREVIEW_LINES, FIRST_PAGES, FIRST_OFFSET = 1200, 10, 5, 2, 200


def is_candidate(text: Column, page: Column, offset: Column) -> Column:
    """Whether a chunk may hold a header: of the first pages or near the start, or of no known page."""
    near = page.isNull() | (page <= FIRST_PAGES) | F.coalesce(offset <= FIRST_OFFSET, F.lit(False))
    return near & (F.length(F.coalesce(text, F.lit(""))) > 0)


def numbered_head(text: Column) -> Column:
    """What a decider sees: the first lines, numbered."""
    head = F.slice(lines(F.substring(text, 1, HEAD_CHARS)), 1, HEAD_LINES)
    return F.array_join(F.transform(head, lambda x, i: F.concat(F.lit("["), i.cast("string"), F.lit("] "), x)), "\n")


def removable(removed: Column) -> Column:
    """How many leading lines a decision removes: its line numbers must be 0, 1, 2 and so on; else none."""
    n = F.size(removed)
    return F.when((n > 0) & (removed == F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))), F.least(n, F.lit(HEAD_LINES))).otherwise(0)


def strip_prefix(text: Column, count: Column) -> Column:
    """The text without its first lines; the rest is joined by plain line ends. Unchanged if count is 0."""
    all_lines = lines(text)
    rest = F.slice(all_lines, F.least(count, F.size(all_lines)) + 1, F.greatest(F.size(all_lines) - count, F.lit(0)))
    return F.when(count > 0, F.array_join(rest, "\n")).otherwise(text)


def strip_headers(chunks: DataFrame, decide=None) -> DataFrame:
    """chunks with text stripped of headers, and columns header_removed, header_lines, header_confidence.

    decide: DataFrame of candidates (id, head) -> (id, action, removed_lines[, header_confidence]); None decides nothing, and so
    does any other action than strip_prefix.
    """
    if decide is None:
        return chunks.withColumn("header_removed", F.lit(0)).withColumn("header_lines", F.lit(None).cast("array<string>")).withColumn("header_confidence", F.lit(None).cast("double"))
    asked = chunks.where(is_candidate(F.col("text"), F.col("page"), F.col("offset"))).select("id", numbered_head(F.col("text")).alias("head"))
    answered = decide(asked)
    sure = F.col("header_confidence").cast("double") if "header_confidence" in answered.columns else F.lit(None).cast("double")
    answers = answered.select(F.col("id").alias("_id"), sure.alias("header_confidence"), F.when(F.col("action") == "strip_prefix", removable(F.col("removed_lines"))).otherwise(0).alias("header_removed")).where("header_removed > 0")
    joined = chunks.join(answers, chunks["id"] == answers["_id"], "left").drop("_id").withColumn("header_removed", F.coalesce("header_removed", F.lit(0)))
    preview = F.when(F.col("header_removed") > 0, F.slice(F.slice(lines(F.col("text")), 1, F.greatest("header_removed", F.lit(1))), 1, PREVIEW_LINES))
    return joined.withColumn("header_lines", preview).withColumn("text", strip_prefix(F.col("text"), F.col("header_removed")))


def recurring_heads(chunks: DataFrame, least: int = 8):
    """A decider without a model: leading lines that open or follow in the heads of at least that many documents are headers."""

    def decide(asked: DataFrame) -> DataFrame:
        rows = asked.join(chunks.select("id", "document_id", "text"), "id").select("id", "document_id", F.posexplode(F.slice(lines(F.substring("text", 1, HEAD_CHARS)), 1, HEAD_LINES)).alias("line_no", "line"))
        known = rows.groupBy("line").agg(F.countDistinct("document_id").alias("n")).where((F.col("n") >= least) & (F.length("line") > 0)).select("line", F.lit(True).alias("known"))
        first_other = rows.join(known, "line", "left").groupBy("id").agg(F.min(F.when(F.col("known").isNull(), F.col("line_no"))).alias("stop"), F.count("*").alias("n"))
        count = F.coalesce("stop", "n")
        return first_other.where(count > 0).select("id", F.lit("strip_prefix").alias("action"), F.sequence(F.lit(0), (count - 1).cast("int")).alias("removed_lines"))

    return decide
