"""Problem 4: copies within a group that differ in white space, case, punctuation or field order.

Classes are refined step by step. First by invariants that cost little: the number of letters and digits, and a
fingerprint of the letter histogram. Only members of classes with several members get the full key, which normalises the
text and, where it is a list of fields, sorts them; only its hash leaves the worker.

Defined results: null and blank texts belong to no class; null groups count as one group; equal texts are copies; the kept
row is the one with the smallest id.
"""

from __future__ import annotations

import functools
import re
import unicodedata

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.runtime import cut

_PARTS = re.compile(r"[\n\r\t;|\x0b\x0c\x1c-\x1e\x85\u2028\u2029；｜]+")


class _Marks(dict):
    """Per character: white space goes, punctuation becomes a mark, all else stays."""

    def __missing__(self, cp: int) -> str:
        c = chr(cp)
        self[cp] = out = "" if c.isspace() else "\0" + c if unicodedata.category(c)[0] == "P" else c
        return out


_NO_SPACE = _Marks()
_PUNCTUATION: dict[int, bool] = {}
_DIGIT_MARK = re.compile("(?<=\\d)\0(.)(?=\\d)")
_MARK = re.compile("\0.", re.S)


def plain(text: str) -> str:
    """Letters, digits, accents and symbols in lower case, and punctuation that stands directly between two digits."""
    spaced = re.sub(r"\s+", "\1", text.lower())
    marked = "".join("\1" if c == "\1" else _NO_SPACE[ord(c)] for c in spaced) if not spaced.isalnum() else spaced
    kept = _DIGIT_MARK.sub("\2\\1", marked)
    return _MARK.sub("", kept).replace("\1", "").replace("\2", "")


def fields(text: str) -> list[tuple[str, str]] | None:
    """Label and value of each field, if the text is at least two of them and nothing else."""
    got = []
    for part in _PARTS.split(text):
        if not plain(part):
            continue
        label, colon, value = part.replace("：", ":").partition(":")
        label, value = plain(label), plain(value)
        if not (colon and label and value):
            return None
        got.append((label, value))
    return got if len(got) >= 2 else None


def content_key(text: str) -> bytes | None:
    """Equal for texts that are copies, null for those without content."""
    found = fields(text) if ":" in text or "：" in text else None
    if found:
        key = "\n".join(sorted(f"{a}\t{b}" for a, b in found))
    else:
        key = plain(text)
    return xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass")) if key else None


@F.arrow_udf(T.BinaryType())
def content_keys(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else content_key(t) for t in texts.to_pylist()], pa.binary())


@functools.cache
def _letter_weights() -> tuple[np.ndarray, np.ndarray]:
    """Fixed 64-bit weights of each letter, digit or accent in lower case, 0 of all else, whose sum tells histograms apart; and
    how many letters each becomes in lower case."""
    weight = np.random.default_rng(4).integers(1, 2**63, 0x110000, dtype=np.int64)
    table, sizes = np.zeros(0x110000, np.int64), np.zeros(0x110000, np.int64)
    for cp in range(0x32400):
        if not 0xD800 <= cp <= 0xDFFF:
            low = [x for x in chr(cp).lower() if unicodedata.category(x)[0] in "LNM"]
            table[cp], sizes[cp] = sum(int(weight[ord(x)]) >> 8 for x in low), len(low)
    return table, sizes


@F.arrow_udf(T.StructType([T.StructField("length", T.LongType()), T.StructField("histogram", T.LongType())]))
def invariants(texts: pa.Array) -> pa.Array:
    """Number of letters and digits, and a fingerprint of the letter histogram; the same for all copies of a content."""
    (table, sizes), lengths, sums = _letter_weights(), [], []
    for a in range(0, len(texts), 500):
        block = [t or "" for t in texts.slice(a, 500).to_pylist()]
        cp = np.frombuffer(("\0".join(block) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum([0] + [len(t) + 1 for t in block[:-1]])
        lengths.append(np.add.reduceat(sizes[cp], starts))
        sums.append(np.add.reduceat(table[cp], starts))
    none = np.zeros(0, np.int64)
    return pa.StructArray.from_arrays([pa.array(np.concatenate(lengths or [none])), pa.array(np.concatenate(sums or [none]))], ["length", "histogram"])


def format_copies(df: DataFrame, group_cols: tuple[str, ...] = ("document_id", "page"), id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(kept_id, copy_id, n_copies): each copy but the kept one, with the number of copies of its content in the group."""
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text")).where("_text is not null")
    group = F.concat_ws("\x1f", *(F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in group_cols))
    cheap = cut(df.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), group.alias("_group"), invariants(F.col(text_col)).alias("_cheap")), "cheap")
    several = cheap.groupBy("_group", "_cheap").agg(F.count("*").alias("n")).where("n > 1")
    members = cheap.join(several, ["_group", "_cheap"], "left_semi").select("id", "_group")
    keyed = cut(texts.join(members, "id").select("id", "_group", content_keys("_text").alias("key")), "keys").where("key is not null")
    classes = keyed.groupBy("_group", "key").agg(F.min("id").alias("kept_id"), F.count("*").alias("n_copies")).where("n_copies > 1")
    return keyed.join(classes, ["_group", "key"]).where("id <> kept_id").select("kept_id", F.col("id").alias("copy_id"), "n_copies")
