"""The whole way from chunks to packaged rows, for any number of documents at once."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernstone.functions.config import Settings
from quernstone.operators import cleaning, finish, header, sentences, similarity, structure
from quernstone.runtime import cut
from quernstone.sources.tables import chunk_scan



def now() -> str:
    """This moment in UTC, to the second."""
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def placed_sentences(chunks: DataFrame, splitter=None) -> DataFrame:
    """Sentences with pos, dense within their document, of chunks with pos."""
    extra = tuple(c for c in ("header_lines", "header_confidence") if c in chunks.columns)
    rows = sentences.split_rows(chunks, splitter, keep=("document_id", "page", "offset", "pos", *extra))
    counts = rows.groupBy(F.col("document_id").alias("_d"), F.col("pos").alias("_p")).agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy("_d").orderBy("_p")) - F.col("_n"))
    # indexes of one chunk may have holes where a part was blank, so rank within the chunk
    rank = F.row_number().over(Window.partitionBy("document_id", "pos").orderBy("sentence_index")) - 1
    ranked = rows.withColumn("_rank", rank)
    joined = ranked.join(before, ranked["document_id"].eqNullSafe(before["_d"]) & (ranked["pos"] == before["_p"]))
    return joined.withColumn("pos", (F.col("_before") + F.col("_rank")).cast("bigint")).drop("_d", "_p", "_n", "_before", "_rank")


def equal_text_groups(rows: DataFrame) -> DataFrame:
    """Groups without an embedder: equal texts of one document, whose similarity is 1 under any embedding."""
    first = rows.groupBy(F.col("document_id").alias("_d"), F.col("text").alias("_t")).agg(F.min("pos").alias("root"), F.count("*").alias("variants"))
    return rows.join(first, rows["document_id"].eqNullSafe(first["_d"]) & (rows["text"] == first["_t"])).drop("_d", "_t")


def embedded_groups(rows: DataFrame, embed: Callable[[DataFrame], DataFrame], settings: Settings, merge_decider=None) -> DataFrame:
    """Groups by similarity; embed adds the column embedding. With use_merge_assist, groups that are nearly similar enough are
    merged if merge_decider says so, and short variants stay only if it confirms them; without one, none does."""
    items = embed(rows)
    if settings.same_anchor_only:
        items = items.withColumn("article", F.lit(None).cast("string")).withColumn("clause", F.lit(None).cast("string"))
    items = cut(items, "embedded")
    grouped = similarity.group_variants(items, settings.group_similarity, settings.neighbours, settings.same_anchor_only).drop("article", "clause").withColumn("turn", F.lit(0).cast("bigint"))
    if settings.use_merge_assist:
        if merge_decider is not None:
            grouped = cut(grouped.drop("turn"), "similar")
            grouped = similarity.absorb(grouped, similarity.merged_groups(grouped, merge_decider, settings.assist_similarity, settings.merge_ranks))
        grouped = similarity.confirm_variants(grouped.drop("embedding"), merge_decider)
    grouped = cut(grouped.drop("embedding"), "variants")
    counts = grouped.groupBy(F.col("document_id").alias("_d"), F.col("root").alias("_r")).agg(F.count("*").alias("variants"))
    return grouped.join(counts, grouped["document_id"].eqNullSafe(counts["_d"]) & (grouped["root"] == counts["_r"])).drop("_d", "_r")


def _source(rows: DataFrame):
    """Where a sentence comes from: its chunk, its place there, whether it is complete, and the header that its chunk lost."""
    named = {"chunk_id": "split_from_chunk", "sentence_index": "sentence_index", "complete": "complete", "header_lines": "header_lines", "header_confidence": "header_confidence"}
    return F.struct(*(F.col(c).alias(n) for c, n in named.items() if c in rows.columns))


def canonical_sentences(grouped: DataFrame) -> DataFrame:
    """The canonical sentence of each group, at its group's place."""
    best = F.max_by(F.struct("sentence_id", "page", "offset", "text", _source(grouped).alias("source")), F.struct(F.length("text"), -F.col("turn"), -F.col("pos")))
    return grouped.groupBy("document_id", F.col("root").alias("pos")).agg(best.alias("b"), F.first("variants").alias("variants")).select("document_id", "pos", F.col("b.sentence_id").alias("id"), "b.page", "b.offset", "b.text", "b.source", "variants", F.concat(F.lit("cg-"), F.col("pos").cast("string")).alias("content_group_id"))


def all_variants(whole: DataFrame, grouped: DataFrame) -> DataFrame:
    """whole with every variant of each group in place of its canonical row; flat and stitched rows are no variant's, and stay.

    Adds place, by which the rows sort: a group's members, then those of each group that it took.
    """
    plain = ~F.col("is_flat") & (F.col("merged") == 1)
    made = whole.where(~plain).withColumn("place", F.struct(F.col("pos").cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("turn"), F.lit(0).cast("bigint").alias("at")))
    own = grouped.select(F.col("document_id").alias("_d"), (F.col("root") * 2 + 1).alias("_p"), F.col("turn").cast("bigint").alias("_turn"), F.col("pos").cast("bigint").alias("_at"), F.struct("sentence_id", "page", "offset", "text", _source(grouped).alias("source")).alias("_v"))
    rows = whole.where(plain)
    joined = rows.join(own, rows["document_id"].eqNullSafe(own["_d"]) & (rows["pos"] == own["_p"]))
    each = joined.withColumn("is_canonical", F.col("id") == F.col("_v.sentence_id")).withColumn("id", F.col("_v.sentence_id"))
    for c in ("page", "offset", "text", "source"):
        each = each.withColumn(c, F.col(f"_v.{c}"))
    each = each.withColumn("place", F.struct(F.col("pos").cast("bigint").alias("pos"), F.col("_turn").alias("turn"), F.col("_at").alias("at")))
    return each.drop("_d", "_p", "_turn", "_at", "_v").unionByName(made)


def run_pipeline(chunks: DataFrame, settings: Settings | None = None, header_decider=None, completeness_decider=None, embed=None, steps: tuple[Callable[[DataFrame], DataFrame], ...] = (), merge_decider=None, splitter=None, text_cleaner=None, timestamp: str | None = None) -> DataFrame:
    """(chunk_id, document_id, clean_text, ops, flags, quality_score, source_linkage, page_range, version, timestamp).

    Deciders and the embedder are optional; without them every judgement is the rule's. merge_decider (similarity.same_content)
    is asked with an embedder only: without one, groups hold equal texts, which there is nothing to ask about. splitter proposes
    spans (sentences.split_rows), text_cleaner cleans (cleaning.clean_texts). Extra steps see the canonical rows, or those of all
    variants. timestamp is the run's, by default the moment of this call.
    """
    s = settings or Settings()
    rows = chunk_scan(chunks.select("id", "document_id", "page", "offset", "text"))
    if s.use_header_filter:
        rows = header.strip_headers(rows, header_decider)
    # each stage that the next reads more than once is a table of its own
    parts = cut(sentences.classify(placed_sentences(rows, splitter), completeness_decider), "sentences")
    grouped = embedded_groups(parts, embed, s, merge_decider) if embed else equal_text_groups(parts).withColumn("turn", F.lit(0))
    if s.targets == "all":
        grouped = cut(grouped, "grouped")
    groups = cut(canonical_sentences(grouped), "groups")
    if s.flatten_lists:
        groups = structure.flatten_lists(groups)
    else:
        groups = groups.withColumn("is_flat", F.lit(False)).withColumn("ord", F.lit(1))
    placed = cut(groups.withColumn("pos", F.col("pos") * 2 + F.col("ord")).drop("ord"), "placed")
    stitched = structure.stitch(placed, min_len=s.min_len, max_len=s.max_len, max_merge=s.max_merge).select(F.col("document_id").alias("_d"), F.col("pos").alias("_p"), F.col("text").alias("_text"), "merged", F.col("members").alias("stitched_from"))
    joined = placed.join(stitched, placed["document_id"].eqNullSafe(stitched["_d"]) & (placed["pos"] == stitched["_p"])).drop("_d", "_p")
    whole = joined.withColumn("text", F.when(F.col("merged") > 1, F.col("_text")).otherwise(F.col("text"))).withColumn("id", F.concat("id", F.when(F.col("is_flat"), "-flat").otherwise(""), F.when(F.col("merged") > 1, "-stitched").otherwise(""))).drop("_text")
    whole = whole.withColumn("is_canonical", F.lit(True))
    if s.targets == "all":
        whole = all_variants(whole, grouped)
    whole = finish.canonical_rows(whole, s.targets)
    flags = F.create_map(F.lit("continues"), F.lit(False), F.lit("error"), F.lit(False))
    if s.use_text_clean and text_cleaner is not None:
        whole = cleaning.clean_texts(whole, text_cleaner)
        flags = F.map_filter(F.col("clean_flags"), lambda _, v: v.isNotNull())
    elif s.use_text_clean:
        whole = finish.clean_offline(whole)
    whole = reduce(DataFrame.transform, steps, whole)
    once = finish.dedupe(cut(whole, "whole"), order="place" if s.targets == "all" else "pos")
    scored = once.withColumn("quality_score", finish.quality_score(F.col("text"), F.coalesce(flags["error"], F.lit(False)))).withColumn("flags", flags)
    kept = [c for c in ("content_group_id", "text_clean_quality") if c in scored.columns]
    stitched = F.when(F.col("merged") > 1, F.col("stitched_from")).alias("stitched_from")
    scored = scored.withColumn("metadata", F.to_json(F.struct("variants", F.col("is_flat").alias("flattened"), (F.col("merged") > 1).alias("stitched"), stitched, "source.*", *kept)))
    return finish.package(scored, timestamp or now(), s.version)
