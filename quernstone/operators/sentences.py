"""Chunks into sentences: the plain rule, repair of proposed spans, rows with ids, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.functions.text import WS, fingerprint, nfkc_squeezed, strip


def raw_sentences(text: Column) -> Column:
    """Parts after a final mark and white space, or at empty lines, stripped; empty ones dropped. Not yet normalised."""
    unix = F.replace(text, F.lit("\r\n"), F.lit("\n"))
    return F.filter(F.transform(F.split(unix, rf"(?<=[.?!…])[{WS}]+|\n{{2,}}", -1), strip), lambda x: x != "")


def sentence_rows(chunks: DataFrame, id_col: str = "id", text_col: str = "text", keep: tuple[str, ...] = ("document_id", "page", "offset")) -> DataFrame:
    """(kept columns, chunk_id, sentence_index, sentence_id, text) of every sentence; chunks without one have no row."""
    parts = chunks.where(F.length(F.coalesce(F.col(text_col), F.lit(""))) > 0).select(*keep, F.col(id_col).alias("chunk_id"), F.posexplode(raw_sentences(F.col(text_col))).alias("sentence_index", "_raw"))
    return parts.select(*keep, "chunk_id", "sentence_index", F.concat(F.col("chunk_id").cast("string"), F.lit("#s"), F.col("sentence_index").cast("string")).alias("sentence_id"), nfkc_squeezed("_raw").alias("text"))


def split_rows(chunks: DataFrame, splitter=None, keep: tuple[str, ...] = ("document_id", "page", "offset")) -> DataFrame:
    """As sentence_rows, by the spans that splitter proposes: DataFrame (id, text) -> (id, i, start, end) in order, positions from 0.

    Proposed spans are repaired to cover the text; a chunk without any is split by the rule. Blank parts keep their index.
    """
    if splitter is None:
        return sentence_rows(chunks, keep=keep)
    rows = chunks.where(F.length(F.coalesce("text", F.lit(""))) > 0)
    sizes = rows.select("id", F.length("text").alias("n"))
    proposed = splitter(rows.select("id", "text")).select("id", "i", "start", "end").join(sizes, "id")
    spans = repair_spans(proposed, "id")
    parts = spans.join(rows.select("id", "text"), "id").select("id", F.struct("start", F.expr("substring(text, start + 1, end - start)").alias("part")).alias("s"))
    listed = parts.groupBy(F.col("id").alias("_id")).agg(F.transform(F.sort_array(F.collect_list("s")), lambda s: s["part"]).alias("_parts"))  # the parts of one chunk
    joined = rows.join(listed, rows["id"] == listed["_id"], "left").withColumn("_parts", F.coalesce("_parts", raw_sentences(F.col("text"))))
    out = joined.select(*keep, F.col("id").alias("chunk_id"), F.posexplode("_parts").alias("sentence_index", "_raw")).where(F.length(strip(F.col("_raw"))) > 0)
    return out.select(*keep, "chunk_id", "sentence_index", F.concat(F.col("chunk_id").cast("string"), F.lit("#s"), F.col("sentence_index").cast("string")).alias("sentence_id"), nfkc_squeezed("_raw").alias("text"))


def repair_spans(spans: DataFrame, by: str, n: str = "n") -> DataFrame:
    """(by, start, end) that cover 0..n without overlap: proposed spans (by, i, start, end, n) in order, gaps filled.

    A span that is empty, negative or beyond the end goes; one that overlaps an earlier one is cut; what no span covers
    becomes a span. Rows with i null carry only n.
    """
    ok = F.col("start").isNotNull() & (F.col("start") >= 0) & (F.col("end") >= 0) & (F.col("start") < F.least("end", n))
    order = Window.partitionBy(by).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    valid = spans.where(ok).withColumn("end", F.least("end", n))
    placed = valid.withColumn("_prev", F.coalesce(F.max("end").over(order), F.lit(0))).where("end > _prev")
    pieces = placed.select(by, F.explode(F.filter(F.array(F.struct(F.col("_prev").alias("start"), F.col("start").alias("end")), F.struct(F.greatest("start", "_prev").alias("start"), F.col("end").alias("end"))), lambda s: s["end"] > s["start"])).alias("s")).select(by, "s.start", "s.end")
    ends = spans.groupBy(by).agg(F.max(n).alias("_n"), F.coalesce(F.max(F.when(ok, F.least("end", n))), F.lit(0)).alias("_max"))
    return pieces.unionByName(ends.where("_max < _n").select(by, F.col("_max").alias("start"), F.col("_n").alias("end")))


def is_complete(text: Column) -> Column:
    """1 if a sentence looks whole, by its length, its last mark, a legal reference or an ellipsis inside."""
    s = strip(F.coalesce(text, F.lit("")))
    return (
        F.when(F.length(s) < 10, 0)
        .when(F.right(s, F.lit(1)).isin(*".;:?!)]”\"'»"), 1)
        .when(s.rlike(rf"(?<![\p{{L}}\p{{N}}_])(Điều|Khoản|Mục)[{WS}]+\p{{Nd}}+(\.|:)"), 1)
        .when(s.contains("...") | s.contains("… "), 0)
        .otherwise((F.length(s) > 30).cast("int"))
    )


def classify(sentences: DataFrame, decide=None, text_col: str = "text") -> DataFrame:
    """sentences with column complete (0 or 1).

    decide: (key, text) of distinct normalised texts -> (key, decision 0/1 or null); null and missing answers fall back to
    the rule, and so do blank texts, which are incomplete.
    """
    if decide is None:
        return sentences.withColumn("complete", is_complete(F.col(text_col)))
    keyed = sentences.withColumn("_key", fingerprint(F.lit("clf"), nfkc_squeezed(text_col)))
    answers = decide(keyed.groupBy(F.col("_key").alias("key")).agg(F.substring(F.min(text_col), 1, 400).alias("text"))).select(F.col("key").alias("_k"), F.col("decision").cast("int").alias("_d"))
    return keyed.join(answers, keyed["_key"] == answers["_k"], "left").withColumn("complete", F.coalesce("_d", is_complete(F.col(text_col)))).drop("_key", "_k", "_d")
