"""Text expressions shared by the operators. White space is that of Unicode, spelled out, so that every engine agrees."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space inside a character class, for Java's regular expressions.
WS = r"\t\n\x0b\f\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: The same white space as plain characters.
WS_CHARS = "".join(map(chr, (*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: Line ends that part lines; \r\n is one.
LINE_ENDS = r"\r\n|[\n\r\x0b\f\x1c-\x1e\x{85}\x{2028}\x{2029}]"
#: Characters that count against a text's quality: all but letters, digits, white space and usual marks.
ODD = rf"""[^{WS}\p{{L}}\p{{N}}_.,\-–—()\[\]{{}}:;'"/\\+*=&%$€£°©®™§|!?…]"""
FINAL = r"""[.!?…](['"”’)]*)$"""


@F.arrow_udf(T.StringType())
def nfkc(texts: pa.Array) -> pa.Array:
    """Compatibility composition; null stays null. Like nfkc_squeezed it leaves the JVM, which has no function for it."""
    return pa.array([None if t is None else t if t.isascii() else unicodedata.normalize("NFKC", t) for t in texts.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def nfkc_squeezed(texts: pa.Array) -> pa.Array:
    """Compatibility composition, white space stripped, and runs of it inside made one space."""
    return pa.array([None if t is None else " ".join((t if t.isascii() else unicodedata.normalize("NFKC", t)).split()) for t in texts.to_pylist()], pa.string())


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WS_CHARS))


def lines(c: Column) -> Column:
    """Lines without their ends; a final line end begins no line, and an empty text has none."""
    parts = F.split(c, LINE_ENDS, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def is_upper(c: Column) -> Column:
    """At least one upper-case letter, and none in lower or title case."""
    return c.rlike(r"\p{Lu}") & ~c.rlike(r"[\p{IsLowercase}\p{Lt}]")


def fingerprint(*parts: Column) -> Column:
    """SHA-1 of the parts put together without a separator."""
    return F.sha1(F.concat(*(F.coalesce(p, F.lit("")).cast("string") for p in parts)))


def trim_to_tokens(c: Column, tokens: int) -> Column:
    """The text cut to a budget of tokens, at four characters each."""
    return F.substring(c, 1, 4 * tokens)
