"""Problem 7: values cut off by a field's length or in transfer.

One pass over the texts counts words, pairs of words and openings of lines, describes the end of every value that no final
mark closes, and cuts the intact values of a bounded sample artificially to make positives. The counts that these ends need
are joined to them, exact, by key. Lengths, in code points or bytes, at which the open values of one source pile up are
that source's field limits. A hashed logistic regression on closing characters, punctuation, word counts and limits is
trained on the sample and scores every end. A chunk that the next one of its document goes on with is no case: that one
starts, past running lines, in lower case or with a word or number that the corpus puts after the chunk's last word.

Defined results: null and blank texts are no cases; copies are scored each; a value that a final mark closes is whole, and so
is one that ends in an unspaced script without final marks (Thai, Lao, Khmer, Burmese) unless it ends at a limit or with a
mark of omission; characters that don't show, and a dash or bullet alone at the end, are looked past.
"""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.llm.lookalike import skeleton, skeletons
from quernstone.runtime import cut

HASHED = 1 << 14
#: About how many rows of each table the regression is trained on, those with the lowest hashes of their ids.
SAMPLE_ROWS = 6_000
THRESHOLD = 0.75
#: Weights in training. Values without a final mark are rarely cut, so their pieces weigh little against them; of values with
#: one, few lack it whole.
OPEN_WEIGHT, OPEN_CUT_WEIGHT, MARKED_CUT_WEIGHT, STRIPPED_WEIGHT = 1.0, 0.04, 0.4, 0.2
#: A length is a source's limit if so many different open values have it, so many times its neighbours' mean, and so many
#: standard deviations of a count more than that, and at least this share of the number of longer open values. Neighbours
#: are lengths at most LIMIT_AROUND away.
LIMIT_VALUES, LIMIT_RATIO, LIMIT_DEVIATIONS, LIMIT_LONGER, LIMIT_AROUND = 5, 4.0, 6.0, 0.5, 12
#: Lines at a chunk's start that may be running lines, as long as not all are: then twice as many may be, and so on. Pages of a
#: document on which one stands at least.
HEAD_LINES, RUNNING_PAGES = 4, 3
#: Ends of values and lines alike that may be the value's own: itself, as a chunk's sentence, and in copies of another format.
OWN_ENDS = 3
#: How often the corpus must put a capitalised word or a number after a word to go on with it, and in what share of the word's cases.
PAIR_LEAST, PAIR_SHARE = 3, 0.003
BLOCK_CHARS = 400_000
#: Different keys that a task holds before it passes their counts on.
HELD_KEYS = 2_000_000

FINAL, CLOSERS, PAUSES = ".!?。！？।॥｡．", "\"'”’»)]）」』》〉", ",;:,，；：、-–—"
# What stands where the rest of a text is left out.
_OMISSION = re.compile(r"(?:\[\s*(?:\.{2,}|…)\s*\]|\(\s*(?:\.{2,}|…)\s*\)|[\[(（]?(?:còn nữa|còn tiếp|to be continued|continued|à suivre|продолжение следует|未完待续|未完)[\])）]?|\.{2,}|…|�)+\s*$", re.I)
#: The last characters of these.
_OMISSION_END = re.compile("[\\])）apdeт续完.…�]", re.I)
_FIELD = re.compile(r"^\s*[^:\n]{2,40}:\s*\S[^:\n]*$|[;|\t]\s*[^:;|\t\n]{2,40}:\s*[^;|\t\n]+$")
_PAGE = re.compile(r"^\W*(?:(?:trang|page|seite|стр|tr|pg|p)\.?\s*)?\d{1,4}(?:\s*[/|]\s*\d{1,4})?\W*$", re.I)
#: A running line: a page number after a gap at its end.
_RUNNING = re.compile(r"\S\s{2,}\d{1,4}\s*$")
_HEADING = re.compile(r"^\s*(?:Mục|Chương|Phần|Phụ lục|Tiểu mục|Điều|Section|Chapter|Part|Annex|Article|Chapitre|Annexe|Глава|Раздел)\s+[\dIVXLC]+\s*[.:)]?(?:\s|$)", re.I)
_ITEM = re.compile(r"^\s*(?:[-•*+]|\(?\w{1,3}[.)])\s")
_LABEL = re.compile(r"^\W*(?:\d{1,3}|\w)[.)](?:\s|$)")
_DASHES = ("-", "–", "—", "•", "*", "·", "|")
_LONE_DASH = re.compile(r"\s+[-–—•*·|]$")
_WORD = re.compile(r"[^\W_]+(?:[̀-ͯऀ-ॣั-ฺ็-๎]+[^\W_]*)*")
_ODD_SPACE = re.compile(r"[\x0b\f\x1c-\x1f\x85\u2028\u2029]")
_SPACES = re.compile(r"[^\S\n\t]+")
_DIGITS = re.compile(r"\d+")


def settled(text: str) -> str:
    """The text with one form for what looks the same, single blanks, and no dash or bullet alone at its end."""
    return _settled(skeleton(text))


def _settled(t: str) -> str:
    if "\r" in t:
        t = t.replace("\r\n", "\n").replace("\r", "\n")
    if "  " in t or _ODD_SPACE.search(t):
        t = _SPACES.sub(" ", t)
    t = t.strip()
    if t[-1:] in _DASHES:
        while (m := _LONE_DASH.search(t, max(0, len(t) - 8))) is not None:
            t = t[: m.start()].rstrip()
    return t


@functools.cache
def _classes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(0 blank, 1 word, 2 mark, 3 line end), lower-case symbol, digits alike, and whether it is a capital, of every code point."""
    kind, low, capital = np.full(0x110000, 2, np.uint8), np.arange(0x110000, dtype=np.uint32), np.zeros(0x110000, bool)
    for cp in range(0x32400):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        c = chr(cp)
        cat = unicodedata.category(c)
        if cat[0] in "LMN":
            kind[cp] = 1
            low[cp] = 0x30 if cat == "Nd" else ord(lc) if len(lc := c.lower()) == 1 else cp
            capital[cp] = cat in ("Lu", "Lt")
        elif c in "\n\r\v\f\x85  ":
            kind[cp] = 3
        elif c.isspace() and c != "\t":  # a tab parts fields
            kind[cp] = 0
    return kind, low, capital


_END_MARKS = np.array([ord(c) for c in FINAL + CLOSERS + "…"], np.uint32)
_POWERS = np.cumprod(np.full(512, 1000003, np.uint64), dtype=np.uint64)
_U = np.uint64


def _mix(h: np.ndarray, shift: int, factor: int) -> np.ndarray:
    h = h ^ (h >> _U(shift))
    return h * _U(factor)


class Words:
    """Words of a block of texts as 64-bit keys, with what follows each."""

    def __init__(self, texts: list[str]):
        kind, low, capital = _classes()
        cp = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        k = kind[cp]
        word = k == 1
        begins = np.zeros(len(word), bool)
        begins[1:] = word[1:] & ~word[:-1]
        first = np.flatnonzero(begins)
        last = np.flatnonzero(word[:-1] & ~word[1:])
        self.first, self.last, self.n = first, last, len(first)
        self.text_starts = np.cumsum([1] + [len(t) + 1 for t in texts])
        at = np.flatnonzero(word)
        if not len(at):
            self.hash = self.pair = self.capital_pair = self.opener = self.line = np.zeros(0, np.int64)
            self.adjacent = self.stops = self.capital = self.worded = self.marked = np.zeros(0, bool)
            self.text = self.line_ends = np.zeros(0, np.int64)
            return
        own = begins[at]
        of, begin = np.cumsum(own) - 1, np.flatnonzero(own)
        sym = low[cp[at]].astype(np.uint64)
        h = _mix(np.add.reduceat(sym * _POWERS[(at - first[of]) & 511], begin), 33, 0xFF51AFD7ED558CCD)
        self.hash = h.view(np.int64)
        self.adjacent = np.zeros(self.n, bool)
        self.adjacent[1:] = (first[1:] - last[:-1] == 2) & (k[np.minimum(last[:-1] + 1, len(k) - 1)] == 0)
        mixed = h.copy()
        mixed[1:] += h[:-1] * _U(0x9E3779B97F4A7C15)
        mixed = _mix(mixed, 29, 0xBF58476D1CE4E5B9)
        self.pair = mixed.view(np.int64)
        self.capital = capital[cp[first]]
        self.capital_pair = (mixed ^ _U(0xA5A5A5A5A5A5A5A5)).view(np.int64)
        after = cp[np.minimum(last + 1, len(cp) - 1)]
        self.stops = (k[np.minimum(last + 1, len(k) - 1)] == 2) & (after != 0x2F) & (after != 0x2D)
        self.text = np.searchsorted(self.text_starts, first, "right") - 1
        # lines: the key of the first two words, and whether a final or closing mark ends them
        ends = np.flatnonzero(k == 3)
        self.line_ends = ends[1:]
        own = np.searchsorted(first, ends[:-1])
        here, second = np.minimum(own, self.n - 1), np.minimum(own + 1, self.n - 1)
        opener = h[here] + np.where(first[second] < ends[1:], h[second], 0).astype(np.uint64) * _U(0x9E3779B97F4A7C15)
        self.opener = (_mix(opener, 31, 0x94D049BB133111EB) ^ _U(0x5A5A5A5A5A5A5A5A)).view(np.int64)
        self.worded = (own < self.n) & (first[here] < ends[1:])
        of_line = np.searchsorted(ends, first) - 1
        parts = np.zeros(len(ends), np.uint64)
        np.add.at(parts, of_line, h * _POWERS[(np.arange(self.n) - own[np.minimum(of_line, len(own) - 1)]) & 511])
        self.line = (_mix(parts[:-1], 27, 0x94D049BB133111EB) ^ _U(0x3C3C3C3C3C3C3C3C)).view(np.int64)
        shown = np.maximum.accumulate(np.where((k == 1) | (k == 2), np.arange(len(k)), 0))
        self.marked = np.isin(cp[shown[ends[1:] - 1]], _END_MARKS)

    def last_of_text(self, n: int) -> np.ndarray:
        """Position of each text's last word, or -1."""
        if not self.n:
            return np.full(n, -1)
        out = np.searchsorted(self.first, self.text_starts[1 : n + 1], "left") - 1
        return np.where((out >= 0) & (self.text[out] == np.arange(n)), out, -1)


def _blocks(texts: list[str]):
    a = size = 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= BLOCK_CHARS:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


class Counts:
    """Counts by key: (occurrences, before a mark or unmarked, at the end of a value), summed up as they come."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.added: tuple[list[np.ndarray], ...] = ([], [], [])
        self.size = 0

    def add(self, keys: np.ndarray, column: int) -> None:
        if len(keys):
            self.added[column].append(keys)
            self.size += len(keys)
            if self.size > 2 * HELD_KEYS:
                keys, n = self.summed()
                self.clear()
                self.parts, self.size = [(keys, n)], len(keys)

    def summed(self) -> tuple[np.ndarray, np.ndarray]:
        parts = list(self.parts)
        for column, added in enumerate(self.added):
            if added:
                # keys are sorted by themselves, a column at a time, and only the different ones with their counts
                keys = np.sort(np.concatenate(added))
                starts = _runs(keys)
                n = np.zeros((len(starts), 3), np.int32)
                n[:, column] = np.diff(starts, append=len(keys))
                parts.append((keys[starts], n))
        if not parts:
            return np.zeros(0, np.int64), np.zeros((0, 3), np.int32)
        if len(parts) == 1:
            return parts[0]
        keys, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        starts = _runs(keys)
        return keys[starts], np.add.reduceat(n, starts, axis=0)


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys starts."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))


def _omission(t: str) -> re.Match[str] | None:
    """The mark of omission at a text's end."""
    end = t.rstrip()[-2:]
    # most texts end in a single point, or in a letter, digit or mark that no mark of omission ends in
    if end[-1:] == "." and end != ".." or not _OMISSION_END.match(end[-1:]):
        return None
    return _OMISSION.search(t, max(0, len(t) - 60))


def without_omission(t: str) -> str:
    m = _omission(t)
    return t[: m.start()].rstrip() if m else t


def is_open(text: str) -> bool:
    """Whether no final mark closes a settled text, or a mark of omission or a broken character stands at its end."""
    if _omission(text):
        return True
    inner = text.rstrip(CLOSERS)
    return not inner or inner[-1] not in FINAL


DENSE, CROSSED = 38, 8
AT_LIMIT, OMITS, BROKEN, PAGE, FIELD, CAPITALS, RUNNING, UNSPACED, HEADED = 14, 11, 10, 17, 16, 18, 34, 22, 28


def describe(t: str, raw: str) -> tuple[list[float], list[int], str]:
    """(numbers, hashed closing characters, last word) of a settled text that is open, raw being its last line as it stands; what counts give is left 0."""
    core = without_omission(t)
    d = [0.0] * DENSE
    end = core[-1:] or " "
    inner = core.rstrip(CLOSERS)
    mark = bool(inner) and inner[-1] in FINAL
    line = core.rsplit("\n", 1)[-1]
    lettered = sum(1 for _ in itertools.islice(filter(str.isalpha, line), 4)) > 3
    d[7] = mark
    d[8] = end in CLOSERS and mark
    d[9] = end in PAUSES
    d[BROKEN] = t.endswith("�")
    d[OMITS] = len(core) < len(t) and not d[BROKEN]
    d[12] = end.isdigit()
    d[13] = end in CLOSERS and not mark
    d[FIELD] = bool(_FIELD.search(line))
    d[PAGE] = bool(_PAGE.match(line))
    d[CAPITALS] = lettered and all(c == c.upper() for c in filter(str.isalpha, line))
    d[19] = float(np.log1p(len(line))) / 5
    d[20] = bool(_ITEM.match(line))
    d[21] = "\n" in core
    script = unicodedata.name(end, "").split(" ")[0] if end.isalpha() or unicodedata.category(end)[0] == "M" else ""
    d[UNSPACED] = script in ("THAI", "LAO", "KHMER", "MYANMAR")
    d[23] = script in ("CJK", "HIRAGANA", "KATAKANA", "HANGUL", "DEVANAGARI")
    d[24] = end.isupper()
    d[25] = len(core.rsplit(" ", 1)[-1]) == 1
    d[HEADED] = bool(_HEADING.match(line)) or lettered and line[:1].isupper() and not mark and len(line) < 70
    d[29] = 1
    d[RUNNING] = bool(_RUNNING.search(raw))
    d[30] = "…" in core.rsplit(". ", 1)[-1].rsplit("\n", 1)[-1]
    # every word of the line begins with a capital, as in names and in titles
    words = [w for w in line.split() if w[0].isalpha()]
    d[35] = len(words) > 1 and all(w[0].isupper() for w in words)
    tail = core[-3:].lower()
    last = _WORD.findall(core[-80:])
    return d, [hash_text(tail) % (HASHED // 4), hash_text(tail[-2:]) % (HASHED // 4)], last[-1] if last and core.rstrip(CLOSERS + PAUSES + " ").endswith(last[-1]) else ""


def hash_text(s: str) -> int:
    h = 2166136261
    for c in s:
        h = (h ^ ord(c)) * 16777619 & 0xFFFFFFFF
    return h


def artificial(t: str, rng: np.random.Generator) -> list[tuple[str, float, float, bool]]:
    """(text, label, weight, at a limit) of training values from a settled text: itself without its mark, and it cut.

    A value without a final mark is taken for whole with little weight by the caller: some are headings and fields, some are
    cut. Where one is cut again, the piece is cut in any case.
    """
    out = []
    core = t.rstrip(CLOSERS)
    ends = bool(core) and core[-1] in FINAL and without_omission(t) == t
    if ends:
        out.append((core[:-1].rstrip(), 0.0, STRIPPED_WEIGHT, False))
    if len(t) < 30 or without_omission(t) != t:
        return out
    for _ in range(2):
        at = int(rng.integers(12, len(t) - 2))
        limit = bool(rng.random() < 0.4)
        piece = t[:at]
        if not piece.strip() or piece.rstrip()[-1] in FINAL + CLOSERS or t[at : at + 1] in FINAL + "\n":
            continue
        kind = rng.random()
        if not limit and kind < 0.25:
            piece = piece.rstrip() + ("...", "…", "[...]", " ...", "�")[int(kind * 20)]
        elif limit and kind < 0.1:
            piece = piece.rstrip() + "�"
        piece = settled(piece)
        if piece and is_open(piece):
            out.append((piece, 1.0, MARKED_CUT_WEIGHT if ends else OPEN_CUT_WEIGHT, limit))
    return out


_OBSERVED = T.StructType(
    [T.StructField("what", T.ByteType()), T.StructField("tbl", T.StringType()), T.StructField("rec_id", T.StringType()), T.StructField("document_id", T.StringType()), T.StructField("page", T.LongType()), T.StructField("off", T.LongType())]
    + [T.StructField("key", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType())]
    + [T.StructField("chars", T.IntegerType()), T.StructField("bytes", T.IntegerType()), T.StructField("content", T.LongType()), T.StructField("label", T.FloatType()), T.StructField("weight", T.FloatType()), T.StructField("limited", T.BooleanType())]
    + [T.StructField("dense", T.ArrayType(T.FloatType())), T.StructField("tails", T.ArrayType(T.IntegerType())), T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("word", T.StringType())]
    + [T.StructField("head_keys", T.ArrayType(T.LongType())), T.StructField("head_words", T.ArrayType(T.StringType()))]
)
COUNTED, END, HEAD = 0, 1, 2


def _batch(n_rows: int, /, **columns) -> pa.RecordBatch:
    made = []
    for f in _OBSERVED.fields:
        kind = {"byte": pa.int8(), "string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "float": pa.float32(), "boolean": pa.bool_(), "array<float>": pa.list_(pa.float32()), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "tinyint": pa.int8()}[f.dataType.simpleString()]
        made.append(pa.array(columns[f.name], kind) if f.name in columns else pa.nulls(n_rows, kind))
    return pa.RecordBatch.from_arrays(made, names=_OBSERVED.names)


def observe(batches, shares: dict[str, float]):
    """Rows of _OBSERVED of batches (tbl, rec_id, text, document_id, page, off): counts, open ends with the sample's training values, and chunk heads."""
    counts = Counts()

    def counted():
        keys, n = counts.summed()
        for a in range(0, len(keys), 100_000):
            k = keys[a : a + 100_000]
            yield _batch(len(k), what=np.full(len(k), COUNTED, np.int8), key=k, **{c: n[a : a + 100_000, i] for i, c in enumerate("nse")})
        counts.clear()

    for b in batches:
        tables, ids, raws, docs, pages, offs = (b.column(i).to_pylist() for i in range(6))
        for x, y in _blocks(raws):
            texts = [_settled(t) for t in skeletons(raws[x:y])]
            w = Words(texts)
            lasts = w.last_of_text(len(texts))
            opens = np.array([bool(t) and is_open(t) for t in texts])
            inner = np.ones(w.n, bool)
            inner[lasts[lasts >= 0]] = False
            counts.add(w.hash[inner], 0)
            counts.add(w.pair[inner & w.adjacent], 0)
            counts.add(w.pair[inner & w.adjacent & w.stops], 1)
            counts.add(w.capital_pair[inner & w.adjacent & w.capital], 0)
            counts.add(w.opener[w.worded], 0)
            counts.add(w.opener[w.worded & ~w.marked], 1)
            counts.add(w.line[w.worded & ~w.marked], 0)
            closing = lasts[(lasts >= 0) & opens]
            counts.add(w.hash[closing], 2)
            counts.add(w.pair[closing[w.adjacent[closing]]], 2)
            rows: list[tuple] = []
            for i, t in enumerate(texts):
                if not t:
                    continue
                tbl, rec = tables[x + i], ids[x + i]
                chosen = xxhash.xxh3_64_intdigest(str(rec).encode("utf-8", "surrogatepass")) < shares.get(tbl, 0.0) * 2**64
                if opens[i]:
                    raw = raws[x + i]
                    rows.append((t, _last_line(raw) if t[-1].isdigit() else "", tbl, rec, len(raw), len(raw.encode("utf-8", "surrogatepass")), OPEN_WEIGHT if chosen else None, None, None, docs[x + i]))
                if chosen:
                    rng = np.random.default_rng(hash_text(f"{tbl}\0{rec}"))
                    rows += [(piece, piece, tbl, rec, None, None, weight, label, limit, None) for piece, label, weight, limit in artificial(t, rng)]
            if rows:
                yield _ends(rows)
            heads = [(rec, texts[i], docs[x + i], pages[x + i], offs[x + i]) for i, (tbl, rec) in enumerate(zip(tables[x:y], ids[x:y])) if tbl == "chunks" and texts[i] and docs[x + i] is not None]
            if heads:
                yield _heads(heads)
        if counts.size > HELD_KEYS:
            yield from counted()
    yield from counted()


def _last_line(raw: str) -> str:
    """The last line of a text as it stands. It is looked at for a page number alone: without a digit at the end there is none."""
    return skeleton(raw[-400:]).rstrip().rsplit("\n", 1)[-1]


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    texts = [r[0] for r in rows]
    seen = [describe(r[0], r[1]) for r in rows]
    w = Words([without_omission(t) for t in texts])
    last = w.last_of_text(len(texts))
    at = np.maximum(last, 0)
    keys = [[None] * 4 for _ in texts]
    if w.n:
        line = np.searchsorted(w.line_ends, w.text_starts[1:] - 1)
        for i in np.flatnonzero(last >= 0):
            keys[i] = [int(w.hash[at[i]]), int(w.pair[at[i]]) if w.adjacent[at[i]] else None, *((int(w.opener[line[i]]), int(w.line[line[i]])) if w.worded[line[i]] else (None, None))]
    return _batch(
        len(rows), what=np.full(len(rows), END, np.int8), tbl=[r[2] for r in rows], rec_id=[r[3] for r in rows], chars=[r[4] for r in rows], bytes=[r[5] for r in rows],
        content=content_keys(texts), weight=[r[6] for r in rows], label=[r[7] for r in rows], limited=[r[8] for r in rows], document_id=[r[9] for r in rows],
        dense=[d for d, _, _ in seen], tails=[h for _, h, _ in seen], keys=keys, word=[x for _, _, x in seen],
    )


@functools.cache
def _letter_weights() -> np.ndarray:
    """A fixed random weight of each letter, digits alike, 0 of all else."""
    kind, low, _ = _classes()
    return np.where(kind == 1, np.random.default_rng(7).integers(1, 2**63, 0x110000, dtype=np.uint64)[low], 0).astype(np.uint64)


def content_keys(texts: list[str]) -> np.ndarray:
    """The same for texts of the same letters in whatever order, so for copies of another format; digits are alike."""
    cp = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    return np.add.reduceat(_letter_weights()[cp], starts).view(np.int64)


def _heads(rows: list[tuple]) -> pa.RecordBatch:
    keys, words = [], []
    for _, t, *_ in rows:
        lines = [x for x in (x.strip() for x in t.split("\n")) if x]
        keys.append([xxhash.xxh3_64_intdigest(_DIGITS.sub("0", x).encode("utf-8", "surrogatepass")) - (1 << 63) for x in lines])
        words.append([_opening(x) for x in lines])
    return _batch(len(rows), what=np.full(len(rows), HEAD, np.int8), tbl=["chunks"] * len(rows), rec_id=[r[0] for r in rows], document_id=[r[2] for r in rows], page=[r[3] for r in rows], off=[r[4] for r in rows], head_keys=keys, head_words=words)


def _opening(line: str) -> str:
    """The first word of a line, empty if a label, a mark or nothing stands before it."""
    if _LABEL.match(line):
        return ""
    m = _WORD.match(line)
    return m.group()[:60] if m else ""


def field_limits(ends: DataFrame) -> DataFrame:
    """(tbl, source, unit, size): lengths at which different open values of a source pile up; ends: with chars, bytes, content."""
    each = ends.select("tbl", "source", "content", F.explode(F.map_from_arrays(F.array(F.lit("chars"), F.lit("bytes")), F.array("chars", "bytes"))).alias("unit", "size")).distinct()
    counts = each.groupBy("tbl", "source", "unit", "size").agg(F.count("*").alias("values"))
    around = Window.partitionBy("tbl", "source", "unit").orderBy("size").rangeBetween(-LIMIT_AROUND, LIMIT_AROUND)
    others = (F.sum("values").over(around) - F.col("values")) / (F.least(F.lit(LIMIT_AROUND), F.col("size") - 1) + LIMIT_AROUND)
    longer = F.coalesce(F.sum("values").over(Window.partitionBy("tbl", "source", "unit").orderBy("size").rangeBetween(1, Window.unboundedFollowing)), F.lit(0))
    spikes = counts.withColumn("others", others).withColumn("longer", longer).where((F.col("values") >= LIMIT_LONGER * F.col("longer"))).where((F.col("values") >= LIMIT_VALUES) & (F.col("values") >= LIMIT_RATIO * F.col("others")) & (F.col("values") >= F.col("others") + LIMIT_DEVIATIONS * F.sqrt("others")))
    return spikes.select("tbl", "source", "unit", "size")


def starts(heads: DataFrame) -> DataFrame:
    """(rec_id, start) of each chunk with a line past its running lines: the first word of that line; heads: as for following."""
    rows, depth, settled_before = heads, F.lit(HEAD_LINES), None
    while True:
        looked_at = F.slice(F.arrays_zip(F.col("head_keys").alias("key"), F.col("head_words").alias("word")), F.lit(1), depth)
        lines = rows.select("rec_id", "document_id", "page", F.size("head_keys").alias("size"), F.posexplode(looked_at).alias("at", "line")).select("rec_id", "document_id", "page", "size", "at", "line.key", "line.word")
        running = lines.select("document_id", "key", "page").distinct().groupBy("document_id", "key").agg(F.count("*").alias("pages")).where(F.col("pages") >= RUNNING_PAGES).select("document_id", "key", F.lit(True).alias("running"))
        reached = lines.join(running, ["document_id", "key"], "left").groupBy("document_id", "rec_id").agg(F.min(F.when(F.col("running").isNull(), F.struct("at", "word"))).alias("start"), (F.max("at") + 1).alias("depth"), F.max("size").alias("size"))
        reached = cut(reached, "starts")
        all_running = F.col("start").isNull() & (F.col("depth") < F.col("size"))
        # a line counts within its document: only those with such a chunk are looked at again
        again = reached.where(all_running).select("document_id").distinct()
        ended = reached.join(again, "document_id", "left_anti").where("start is not null").select("rec_id", F.col("start.word").alias("start"))
        settled_before = ended if settled_before is None else settled_before.unionByName(ended)
        if not again.limit(1).count():
            return settled_before
        deeper = reached.join(again, "document_id", "left_semi").select("document_id", "rec_id", F.when(all_running, 2 * F.col("depth")).otherwise(F.col("depth")).alias("depth"))
        rows, depth = heads.join(deeper, ["document_id", "rec_id"]), F.greatest("depth", F.lit(HEAD_LINES))


def following(heads: DataFrame) -> DataFrame:
    """(rec_id, next_word) of each chunk that another one follows: the first word past running lines, empty if there is none.

    heads: (rec_id, document_id, page, off, head_keys, head_words). The order is page, offset, id; the next chunk is found within
    the page, and only the last of a page looks at the next page's first.
    """
    placed = heads.select("rec_id", "document_id", "page", "off").join(starts(heads), "rec_id", "left").withColumn("start", F.coalesce("start", F.lit("")))
    within = Window.partitionBy("document_id", "page").orderBy(F.asc_nulls_last("off"), F.asc("rec_id"))
    placed = placed.withColumn("next_word", F.lead("start").over(within)).withColumn("is_first", F.row_number().over(within) == 1)
    pages = placed.where("is_first").select(F.col("document_id").alias("d"), F.col("page").alias("p"), F.lead("start").over(Window.partitionBy("document_id").orderBy(F.asc_nulls_last("page"))).alias("page_after"))
    last = placed.where("next_word is null").join(pages, (F.col("document_id") == F.col("d")) & F.col("page").eqNullSafe(F.col("p")))
    return placed.where("next_word is not null").select("rec_id", "next_word").unionByName(last.where("page_after is not null").select("rec_id", F.col("page_after").alias("next_word")))


def with_joins(ends: DataFrame) -> DataFrame:
    """ends with the keys of its last word and the next chunk's first: as one word, as a pair, and as a pair with a capital."""

    def run(batches):
        for b in batches:
            at = b.schema.get_field_index("keys")
            keys, words, nexts = b.column("keys").to_pylist(), b.column("word").to_pylist(), b.column("next_word").to_pylist()
            both = [i for i, (x, y) in enumerate(zip(words, nexts)) if x and y]
            if both:
                one, two = Words([words[i] + nexts[i] for i in both]), Words([f"{words[i]} {nexts[i]}" for i in both])
                single, pairs = one.last_of_text(len(both)), two.last_of_text(len(both))
                for k, i in enumerate(both):
                    keys[i] = [*keys[i], int(one.hash[single[k]]), int(two.pair[pairs[k]]), int(two.capital_pair[pairs[k]])]
            yield b.set_column(at, "keys", pa.array(keys, pa.list_(pa.int64())))

    return ends.mapInArrow(run, ends.schema)


def with_counts(ends: DataFrame, counts: DataFrame) -> DataFrame:
    """ends with counts: of each key, in its place, (n, s, e); keys that don't occur have no entry."""
    asked = ends.select("uid", F.posexplode("keys").alias("at", "key")).where("key is not null")
    known = counts.groupBy("key").agg(*(F.sum(c).cast("float").alias(c) for c in "nse"))
    found = asked.join(known, "key").groupBy("uid").agg(F.collect_list(F.struct(F.col("at").cast("int").alias("at"), "n", "s", "e")).alias("counts"))
    return ends.join(found, "uid", "left")


def model_inputs(dense: np.ndarray, tails: np.ndarray, counts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, DENSE + CROSSED) numbers and (rows, 6) hashed places; counts: (rows, 4 keys, 3); words: a hash of the last word."""
    d = dense.copy()
    word, pair, stop, opens, bare = counts[:, 0, 0], counts[:, 1, 0], counts[:, 1, 1], counts[:, 2, 0], counts[:, 2, 1]
    # a part of a word is seen at ends alone, and its ends say nothing
    known = word > counts[:, 0, 2]
    pair_end = np.maximum(counts[:, 1, 2] - OWN_ENDS, 0) * known
    joined = d[:, 6] > 0
    mark = d[:, 7] > 0
    d[:, 0], d[:, 1] = np.log1p(word), np.log1p(pair)
    whole = (stop + pair_end + 0.02) / (pair + pair_end + 0.2)
    d[:, 2] = whole * ~mark
    d[:, 3] = ~known
    d[:, 4] = joined & (pair + pair_end == 0)
    d[:, 5] = joined & (pair >= 5) & ((stop + pair_end) * 50 < pair)
    d[:, 15] = (d[:, AT_LIMIT] > 0) & ~mark
    d[:, 26] = (d[:, 5] > 0) & ~mark
    d[:, 27] = (d[:, 3] > 0) & ~mark & (d[:, 12] == 0)
    d[:, 31] = np.log1p(opens)
    d[:, 32] = (bare + 0.5) / (opens + 1.0)
    d[:, 33] = (opens >= 4) & (bare * 10 >= opens * 9)
    # the line stands elsewhere as it is
    again = np.maximum(counts[:, 3, 0] - OWN_ENDS, 0) * known
    d[:, 36], d[:, 37] = np.log1p(again), again >= 2
    formal, bounded = (d[:, 3] == 0) & (d[:, 4] == 0), d[:, AT_LIMIT] > 0
    d = np.hstack([d, *(((d[:, c] > 0) & formal)[:, None] for c in (FIELD, HEADED, CAPITALS, 33, 37, 35)), *(((d[:, c] > 0) & bounded)[:, None] for c in (HEADED, FIELD))])
    log2 = lambda x, most: np.minimum(np.log2(x + 1).astype(np.int64), most)
    flags = (mark * 8 + (d[:, AT_LIMIT] > 0) * 4 + (d[:, 12] > 0) * 2 + (d[:, 24] > 0)).astype(np.int64)
    kinds = (d[:, FIELD] * 8 + d[:, CAPITALS] * 4 + d[:, OMITS] * 2 + d[:, 35]).astype(np.int64)
    share = (np.minimum(whole, 1.2) * 5).astype(np.int64)
    quarter = HASHED // 4
    spread = lambda x: (x * 2654435761 >> 7) % quarter
    hashed = np.stack([words % quarter, quarter + tails[:, 0], 2 * quarter + tails[:, 1], 3 * quarter + spread(kinds * 16 + flags), 3 * quarter + spread(1_000 + ((log2(word, 15) * 16 + log2(pair, 12)) * 8 + share) * 16 + flags), 3 * quarter + spread(900_000 + ((log2(opens, 7) * 8 + (d[:, 32] * 4).astype(np.int64)) * 8 + share) * 16 + flags)], axis=1)
    return d, hashed


def train(dense: np.ndarray, hashed: np.ndarray, labels: np.ndarray, weights: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression by full-batch Adam with L2: (dense weights, hashed weights)."""
    scale = np.maximum(dense.std(axis=0), 1e-3)
    scale[29] = 1
    x = dense / scale
    w, v = np.zeros(x.shape[1]), np.zeros(HASHED)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, v)]
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-(x @ w + v[hashed].sum(axis=1))))
        e = weights * (p - labels) / weights.sum()
        grads = (x.T @ e + 1e-5 * w, np.bincount(hashed.ravel(), np.repeat(e, hashed.shape[1]), HASHED) + 2e-5 * v)
        for param, g, (m, s), rate in zip((w, v), grads, state, (0.1, 0.03)):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            param -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return w / scale, v


def score(dense: np.ndarray, hashed: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(dense @ model[0] + model[1][hashed].sum(axis=1), -50, 50)))


def fit(dense: np.ndarray, hashed: np.ndarray, labels: np.ndarray, weights: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The regression; values of unknown label (taken for whole) that it finds cut are left out, and it is trained again."""
    if not len(labels):
        return np.zeros(DENSE + CROSSED), np.zeros(HASHED)
    model = train(dense, hashed, labels, weights)
    for _ in range(2):
        kept = weights * (known | (score(dense, hashed, model) < 0.5))
        model = train(dense, hashed, labels, kept)
    return model


def _arrays(table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(dense with the limit's flag, tails, counts of the own keys, counts of the joining keys, last words' hashes) of ends."""
    n = table.num_rows
    column = lambda c: x.combine_chunks() if isinstance(x := table.column(c), pa.ChunkedArray) else x
    numbers = lambda x, kind: x.to_numpy(zero_copy_only=False).astype(kind)
    dense = numbers(column("dense").flatten(), np.float64).reshape(n, DENSE)
    tails = numbers(column("tails").flatten(), np.int64).reshape(n, 2)
    counts = np.zeros((n, 7, 3))
    found = column("counts")
    if len(each := found.flatten()):
        row, at = numbers(pc.list_parent_indices(found), np.int64), numbers(each.field("at"), np.int64)
        for i, c in enumerate("nse"):
            counts[row, at, i] = numbers(each.field(c), np.float64)
    keys = column("keys")
    dense[:, 6] = numbers(pc.list_element(keys, 1).is_valid(), np.float64)
    dense[:, AT_LIMIT] = numbers(column("at_limit"), np.float64)
    words = numbers(pc.list_element(keys, 0).fill_null(0), np.int64) & 0x7FFFFFFF
    return dense, tails, counts[:, :4], counts[:, 4:], words


def goes_on(words: list[str], nexts: list[str | None], own: np.ndarray, joins: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """Whether the next chunk goes on with each end."""
    out = np.zeros(len(words), bool)
    for i, (word, following_word) in enumerate(zip(words, nexts)):
        if not following_word or dense[i, BROKEN] or dense[i, OMITS] or dense[i, AT_LIMIT]:
            continue  # what a limit, an omission or a broken character took away isn't in the next chunk
        one, pair, capital = joins[i, 0, 0], joins[i, 1, 0], joins[i, 2, 0]
        first = following_word[0]
        if first.isupper():
            out[i] = capital >= max(PAIR_LEAST, PAIR_SHARE * own[i, 0, 0])
        elif first.isdigit():
            out[i] = pair >= max(PAIR_LEAST, PAIR_SHARE * own[i, 0, 0])
        elif not first.islower():
            # scripts without case: as their own words go on, or with the same script
            out[i] = pair >= PAIR_LEAST or bool(word) and not word[-1].isascii() and unicodedata.name(word[-1], "").split(" ")[0] == unicodedata.name(first, "?").split(" ")[0]
        else:
            # the middle of a sentence: of this one, unless its last word is but a part that the next doesn't complete
            out[i] = pair > 0 or one > 0 or not (word and own[i, 0, 0] <= own[i, 0, 2])
    return out


_SCORED = T.StructType([T.StructField("tbl", T.StringType()), T.StructField("rec_id", T.StringType()), T.StructField("p", T.DoubleType()), T.StructField("goes_on", T.BooleanType())])


def scored_ends(values: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """(tbl, rec_id, p, goes_on) of every open value; p: the probability that it is cut, goes_on: whether the next chunk continues it.

    values: (tbl, rec_id, text, document_id, page, off); sources: (document_id, source), without which all documents are one's.
    """
    spark = values.sparkSession
    values = values.withColumn("rec_id", F.col("rec_id").cast("string"))
    sizes = {r["tbl"]: r["n"] for r in values.groupBy("tbl").agg(F.count("*").alias("n")).collect()}  # a row a table
    shares = {t: min(1.0, SAMPLE_ROWS / max(1, n)) for t, n in sizes.items()}
    columns = ("tbl", "rec_id", "text", F.col("document_id").cast("string").alias("document_id"), F.col("page").cast("bigint").alias("page"), F.col("off").cast("bigint").alias("off"))
    seen = cut(values.select(*columns).where("text is not null").mapInArrow(lambda batches: observe(batches, shares), _OBSERVED), "observed")
    ends = seen.where(f"what = {END}").select("tbl", "rec_id", "document_id", "chars", "bytes", "content", "label", "weight", "limited", "dense", "tails", "keys", "word")
    ends = ends.withColumn("uid", F.concat_ws("\t", "tbl", "rec_id", F.col("chars").cast("string"), F.col("bytes").cast("string"), F.col("content").cast("string"), F.col("label").cast("string")))
    if sources is None:
        own = ends.withColumn("source", F.lit(""))
    else:
        named = sources.groupBy(F.col("document_id").cast("string").alias("document_id")).agg(F.min("source").cast("string").alias("source"))
        own = ends.join(named, "document_id", "left")
    real = own.where("label is null")
    limits = field_limits(real)
    for unit in ("chars", "bytes"):
        at = limits.where(F.col("unit") == unit).select(F.col("tbl").alias("_t"), F.col("source").alias("_s"), F.col("size").alias("_n"), F.lit(True).alias(f"at_{unit}"))
        own = own.join(at, (F.col("tbl") == F.col("_t")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col(unit) == F.col("_n")), "left").drop("_t", "_s", "_n")
    own = own.withColumn("at_limit", F.coalesce("limited", F.col("at_chars") | F.col("at_bytes"), F.col("at_chars"), F.col("at_bytes"), F.lit(False)))
    after = following(seen.where(f"what = {HEAD}").select("rec_id", "document_id", "page", "off", "head_keys", "head_words")).withColumn("tbl", F.lit("chunks"))
    joined = own.drop("document_id", "chars", "bytes", "content", "source", "limited", "at_chars", "at_bytes").join(after.dropDuplicates(["rec_id"]), ["tbl", "rec_id"], "left")
    known = cut(with_counts(with_joins(joined), seen.where(f"what = {COUNTED}").select("key", "n", "s", "e")), "known")
    trained = known.where("weight is not null and (label is not null or not at_limit)").select("uid", "label", "weight", "dense", "tails", "keys", "counts", "at_limit").orderBy("uid").toArrow()  # the bounded sample, as numbers
    dense, tails, own_counts, _, words = _arrays(trained)
    labels = trained.column("label").to_pylist()
    inputs = model_inputs(dense, tails, own_counts, words)
    model = spark.sparkContext.broadcast(fit(*inputs, np.array([x or 0.0 for x in labels]), np.array(trained.column("weight").to_pylist(), np.float64), np.array([x is not None for x in labels], bool)))

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            dense, tails, own_counts, joins, words = _arrays(b)
            p = score(*model_inputs(dense, tails, own_counts, words), model.value)
            no_limit = (dense[:, AT_LIMIT] == 0) & (dense[:, OMITS] == 0) & (dense[:, BROKEN] == 0)
            # page numbers and running lines are whole, and so is what ends in a script without final marks
            whole = (dense[:, PAGE] > 0) | (dense[:, RUNNING] > 0) | (dense[:, UNSPACED] > 0)
            p = np.where(whole & no_limit, 0.0, np.where(dense[:, BROKEN] > 0, 1.0, p))
            on = goes_on(b.column("word").to_pylist(), b.column("next_word").to_pylist(), own_counts, joins, dense)
            yield pa.RecordBatch.from_arrays([b.column("tbl"), b.column("rec_id"), pa.array(p), pa.array(on)], names=_SCORED.names)

    return known.where("label is null").select("tbl", "rec_id", "dense", "tails", "keys", "counts", "at_limit", "word", "next_word").mapInArrow(run, _SCORED)


def cut_values(values: DataFrame, sources: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(tbl, rec_id, p) of the values that are cut; values and sources as in scored_ends, tbl 'chunks' being in order."""
    found = scored_ends(values, sources).where((F.col("p") >= threshold) & ~F.col("goes_on"))
    return found.groupBy("tbl", "rec_id").agg(F.max("p").alias("p"))
