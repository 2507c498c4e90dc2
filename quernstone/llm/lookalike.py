"""Problem 3: texts that look the same but are built from different characters.

Every text is mapped to one form: characters that don't show go, blanks of any kind or width become a space, full-width
forms and ligatures become plain letters, accents are composed, look-alike letters of other scripts become Latin. Only
mapped forms of texts that the mapping changed are compared as text: grouped in SQL under the accent- and case-sensitive
collation UNICODE. A text that the mapping left alone is its own mapped form, so a hash finds its class. Each class gets a
canonical member, joined back to its rows.

Defined results: null and blank texts belong to no class; equal texts share a class but make no pair; a text that nothing
looks like is its own canonical form; ties for the canonical member go to the unchanged form, then the smallest id.
"""

from __future__ import annotations

import functools
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of other scripts that look like a Latin letter, each followed by that letter.
LOOKALIKE_LETTERS = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "ι": "i", "ν": "v", "ο": "o", "ρ": "p", "υ": "u",
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X",
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "ԝ": "w", "х": "x", "у": "y",
    "Ð": "Đ", "Ɖ": "Đ",
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    "ӏ": "l", "Ү": "Y", "Ѵ": "V", "ѵ": "v", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W", "ɑ": "a", "ɡ": "g", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J", "օ": "o", "ս": "u", "հ": "h", "ո": "n", "Օ": "O", "Տ": "S", "Լ": "L",
}
# Hyphens that look like the plain one.
LOOKALIKE_HYPHENS = {"\u2010": "-", "\u2011": "-"}


#: Code points looked at: the basic plane, and the letters of mathematics.
_RANGE = (*range(0x10000), *range(0x1D400, 0x1D800))


def _mapped(cp: int) -> str | None:
    """What one character becomes before accents are composed; None: itself."""
    c = chr(cp)
    kind = unicodedata.category(c)
    if c in "\t\n\v\f\r\x1c\x1d\x1e\x1f\x85":
        return None
    if kind in ("Cf", "Cc") or 0xFE00 <= cp <= 0xFE0F or cp in (0x34F, 0x115F, 0x1160, 0x180B, 0x180C, 0x180D, 0x3164, 0xFFA0):
        return ""
    if kind == "Zs":
        return " " if c != " " else None
    form = unicodedata.decomposition(c)
    if form.startswith(("<wide>", "<narrow>", "<noBreak>")) or form.startswith("<font>") and kind[0] in "LN" or form.startswith("<compat>") and kind[0] in "LN":
        return unicodedata.normalize("NFKC", c)
    return LOOKALIKE_HYPHENS.get(c)


@functools.cache
def _tables() -> tuple[dict[int, str], dict[int, str], re.Pattern[str]]:
    """(single characters, letters after decomposition, what may change at all)."""
    singles = {cp: m for cp in _RANGE if not 0xD800 <= cp <= 0xDFFF and (m := _mapped(cp)) is not None}
    for k, v in list(singles.items()):
        singles[k] = "".join(x if (m := _mapped(ord(x))) is None else m for x in v)
    singles.update(dict.fromkeys(range(0xE0000, 0xE1000), ""))
    letters = {ord(a): b for a, b in LOOKALIKE_LETTERS.items()}
    changing = [cp for cp in _RANGE if not 0xD800 <= cp <= 0xDFFF and (cp in singles or unicodedata.combining(chr(cp)) or any(ord(x) in letters for x in unicodedata.normalize("NFD", chr(cp))) or unicodedata.normalize("NFC", chr(cp)) != chr(cp))]
    # as ranges: what lies beyond the basic plane is tried item by item on every character of a text
    ranges: list[list[int]] = []
    for cp in (*changing, *range(0xE0000, 0xE1000)):
        if ranges and cp == ranges[-1][1] + 1:
            ranges[-1][1] = cp
        else:
            ranges.append([cp, cp])
    return singles, letters, re.compile(f"[{''.join(f'{re.escape(chr(a))}-{re.escape(chr(z))}' for a, z in ranges)}]")


def _replaced(text: str, by: dict[int, str]) -> str:
    # as text.translate(by), to which each character that isn't a key is an error that it catches
    return text.translate({o: by.get(o, o) for o in map(ord, set(text))})


def _form(text: str) -> str:
    singles, letters, _ = _tables()
    return unicodedata.normalize("NFC", _replaced(unicodedata.normalize("NFD", _replaced(text, singles)), letters))


def skeleton(text: str) -> str:
    """The one form of all texts that look like this one."""
    return _form(text) if _tables()[2].search(text) else text


@functools.cache
def _may_change() -> np.ndarray:
    """Whether each code point may change."""
    out, changing = np.zeros(0x110000, bool), _tables()[2]
    out[[cp for cp in (*_RANGE, *range(0xE0000, 0xE1000)) if changing.match(chr(cp))]] = True
    return out


def skeletons(texts: list[str]) -> list[str]:
    """skeleton of each text; the characters of all are looked up at once."""
    if not texts:
        return []
    cp = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    out = list(texts)
    for i in np.flatnonzero(np.logical_or.reduceat(_may_change()[cp], starts)):
        out[i] = _form(texts[i])
    return out


@F.arrow_udf(T.StringType())
def changed_skeleton(texts: pa.Array) -> pa.Array:
    """The mapped form where it differs from the text, else null."""
    return pa.array([None if t is None or (s := skeleton(t)) == t else s for t in texts.to_pylist()], pa.string())


def lookalike_rows(df: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, skeleton_hash, form) of the rows that aren't blank; form: the mapped text if it isn't the text."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull()).withColumn("form", changed_skeleton("text"))
    return rows.where(F.coalesce("form", "text").rlike(r"[^\s\x{85}\x{a0}\x{1c}-\x{1f}]")).select("id", F.xxhash64("text").alias("text_hash"), F.xxhash64(F.coalesce("form", "text")).alias("skeleton_hash"), "form")


def lookalike_classes(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, class_id, id, text_hash, changed) of the rows in classes with a changed member; rows: of lookalike_rows."""
    spark = rows.sparkSession
    forms = rows.where("form is not null").select(*by, "skeleton_hash", "form").distinct()
    forms.createOrReplaceTempView("quernstone_forms")
    keys = "".join(f"{c}, " for c in by)
    named = spark.sql(f"SELECT {keys}skeleton_hash, min(skeleton_hash) OVER (PARTITION BY {keys}form COLLATE UNICODE) AS class_id FROM quernstone_forms").distinct()
    return rows.join(named, [*by, "skeleton_hash"]).select(*by, "class_id", "id", "text_hash", F.col("form").isNotNull().alias("changed"))


def lookalike_pairs(classes: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, id_a, id_b), id_a < id_b: rows of one class whose texts differ."""
    a = classes.select(*by, "class_id", F.col("id").alias("id_a"), F.col("text_hash").alias("hash_a"))
    b = classes.select(*by, "class_id", F.col("id").alias("id_b"), F.col("text_hash").alias("hash_b"))
    return a.join(b, [*by, "class_id"]).where("id_a < id_b and hash_a <> hash_b").select(*by, "id_a", "id_b")


def canonical_members(classes: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, id, canonical_id): the canonical member of each row's class, by count-free, deterministic choice."""
    best = classes.groupBy(*by, "class_id").agg(F.min(F.struct("changed", "id")).alias("best"))
    return classes.join(best, [*by, "class_id"]).select(*by, "id", F.col("best.id").alias("canonical_id"))
