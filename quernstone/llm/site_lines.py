"""Problem 2: lines that stand in very many documents of one site.

Documents of a site are numbered, and a line's documents are kept as a sparse bitmap: words of 64 documents, only those
with a bit set. The bitmaps of all variants of a line (case, white space, digits, compatibility forms) are united by OR, which
combines on the map side; cardinalities are exact. Occurrences are found, and deleted, by looking the bit of their document up.

Defined results: null texts have no lines; a document registered for several sites counts for each; chunks of unknown
documents have no site and keep all lines; repeated lines in one document count once.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.runtime import cut

MIN_DOCUMENTS, MIN_LETTERS = 8, 10
_DIGITS, _NO_LETTER = re.compile(r"\d+"), re.compile(r"[\W\d_]+")


def line_key(line: str) -> int | None:
    """64-bit key of what a line and its variants have in common; null if it has too few letters."""
    if len(line) < 2:
        return None
    k = "".join(unicodedata.normalize("NFKC", line).lower().split())
    if len(_NO_LETTER.sub("", k)) < MIN_LETTERS:
        return None
    return xxhash.xxh3_64_intdigest(_DIGITS.sub("0", k).encode("utf-8", "surrogatepass")) - (1 << 63)


@F.arrow_udf(T.ArrayType(T.LongType()))
def line_keys(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else [line_key(x) for x in t.split("\n")] for t in texts.to_pylist()], pa.list_(pa.int64()))


def numbered_documents(docs: DataFrame, id_col: str = "id", site_col: str = "site_id") -> DataFrame:
    """(document_id, site, word, bit): each document's place in its site's bitmaps, numbered in 64 even parts."""
    parts = docs.select(F.col(id_col).alias("document_id"), F.col(site_col).alias("site")).where("document_id is not null and site is not null").distinct().withColumn("bit", F.pmod(F.xxhash64("document_id"), F.lit(64)).cast("int"))
    return parts.withColumn("word", F.row_number().over(Window.partitionBy("site", "bit").orderBy("document_id")).cast("bigint"))


def line_bitmaps(lines: DataFrame, docs: DataFrame) -> DataFrame:
    """(site, key, word, bits): united bitmaps of the lines (document_id, keys), for documents numbered as above."""
    pairs = lines.select("document_id", F.explode("keys").alias("key")).where("key is not null").distinct()
    return pairs.join(docs, "document_id").groupBy("site", "key", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))


def repeated_lines(chunks: DataFrame, source_docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(chunk_id, line_no, site, key, n_documents) of each occurrence of a line of at least min_documents documents of a site."""
    lines = cut(chunks.select(F.col("id").alias("chunk_id"), "document_id", line_keys("text").alias("keys")).where("keys is not null and exists(keys, k -> k is not null)"), "lines")
    docs = cut(numbered_documents(source_docs), "docs")
    bitmaps = cut(line_bitmaps(lines, docs), "bitmaps")
    hot = bitmaps.groupBy("site", "key").agg(F.sum(F.bit_count("bits")).alias("n_documents")).where(F.col("n_documents") >= min_documents)
    held = bitmaps.join(hot, ["site", "key"])
    places = lines.select("chunk_id", "document_id", F.posexplode("keys").alias("line_no", "key")).where("key is not null").join(docs, "document_id")
    found = places.join(held, ["site", "key", "word"]).where(F.expr("shiftright(bits, bit) & 1 = 1"))
    return found.select("chunk_id", "line_no", "site", "key", "n_documents")


def strip_repeated_lines(chunks: DataFrame, source_docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """chunks with column clean_text: the text without its repeated lines. Other columns, of whatever name, stay."""
    gone = repeated_lines(chunks, source_docs, min_documents).groupBy(F.col("chunk_id").alias("_chunk_id")).agg(F.collect_set("line_no").alias("_gone"))
    joined = chunks.join(gone, chunks["id"] == gone["_chunk_id"], "left")
    kept = F.expr("array_join(filter(split(text, '\\n', -1), (x, i) -> not array_contains(coalesce(_gone, array()), i)), '\\n')")
    return joined.withColumn("clean_text", F.when(F.col("text").isNotNull(), kept)).drop("_chunk_id", "_gone")
