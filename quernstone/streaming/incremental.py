"""Stages that need no other rows, over a stream of chunks: split, complete, score, and exact duplicates within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.operators.finish import quality_score
from quernstone.operators.sentences import is_complete, sentence_rows


def sentence_stream(chunks: DataFrame, arrived: str = "arrived_at", watermark: str = "1 day") -> DataFrame:
    """Sentences of a stream (or a batch) of chunks with column arrived; a text that the same document and page had within
    the watermark is dropped."""
    rows = sentence_rows(chunks, keep=("document_id", "page", arrived)).withColumn("text_sha1", F.sha1("text"))
    once = rows.withWatermark(arrived, watermark).dropDuplicatesWithinWatermark(["document_id", "page", "text_sha1"])
    return once.withColumn("complete", is_complete(F.col("text"))).withColumn("quality_score", quality_score(F.col("text"), F.lit(False)))
