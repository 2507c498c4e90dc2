"""Problem 8: byte-level BPE ids of whole texts.

Texts are joined into one code point array per block. A class table turns it into symbols, each symbol stands for a
transition function over scanner states, and composing those functions (an associative scan) gives the state before every
position; piece boundaries follow from state and symbol, with no regular expression. The pieces are slices of one Arrow
buffer, dictionary-encoded in C++, so that each different piece of a block is merged once, from a cache.

Defined results: null and empty texts give the empty list; blank texts are encoded; strings of special tokens are text.
"""

from __future__ import annotations

import base64
import functools
import heapq
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKENIZER_DIR = os.environ.get("QUERNSTONE_TOKENIZERS", "/opt/tokenizers")
BYTE_BPE_50K = os.path.join(TOKENIZER_DIR, "byte_bpe_50k.tiktoken")
#: Code points scanned at once; a longer text makes a block of its own.
BLOCK_CHARS = 400_000
#: Pieces kept in a worker's cache, and the longest piece kept.
CACHE_PIECES, CACHE_BYTES = 400_000, 64

LETTER, NUMBER, OTHER, SPACE, BLANK, END = range(6)
WHITE_SPACE = (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


@functools.cache
def class_table() -> np.ndarray:
    """Class of every code point: letter, number, other, white space (U+0020 apart as SPACE, the rest BLANK)."""
    table = np.full(0x110000, OTHER, np.uint8)
    for cp in range(0x32400):
        c = unicodedata.category(chr(cp))[0]
        if c == "L":
            table[cp] = LETTER
        elif c == "N":
            table[cp] = NUMBER
    table[list(WHITE_SPACE)] = BLANK
    table[0x20] = SPACE
    return table


# Scanner states: the first six are "the last symbol was of that class"; MARK is an apostrophe that begins a piece, R V L the
# first letter of a two-letter contraction after it, DONE the last letter of a contraction.
MARK, IN_R, IN_V, IN_L, DONE = range(6, 11)
N_STATES = 11


@functools.cache
def transition_rows() -> dict[str, np.ndarray]:
    """State functions (rows indexed by the state before) of the symbols that are not constant near an apostrophe."""
    rows = {}
    mark = np.full(N_STATES, MARK, np.uint8)
    mark[[OTHER, SPACE, MARK]] = OTHER
    rows["'"] = mark
    for c in "stmdrvle":
        f = np.full(N_STATES, LETTER, np.uint8)
        if c in "stmd":
            f[MARK] = DONE
        elif c in "rvl":
            f[MARK] = {"r": IN_R, "v": IN_V, "l": IN_L}[c]
        if c == "e":
            f[[IN_R, IN_V]] = DONE
        if c == "l":
            f[IN_L] = DONE
        rows[c] = f
    return rows


def states_after(cp: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State after each position, and positions of apostrophes.

    A symbol's function is constant unless it is an apostrophe or one of a few letters within two places of one; only
    those short stretches are scanned, by doubling over composed function rows. The rest is its own class.
    """
    state = cls.copy()
    marks = np.flatnonzero(cp == 0x27)
    if not len(marks):
        return state, marks
    n = len(cp)
    near = np.unique(np.concatenate([marks, marks + 1, marks + 2]))
    near = near[near < n]
    rows = transition_rows()
    funcs = np.repeat(cls[near][:, None], N_STATES, axis=1)
    for c, row in rows.items():
        funcs[cp[near] == ord(c)] = row
    first = np.ones(len(near), bool)
    first[1:] = np.diff(near) != 1
    at = np.arange(len(near))
    begin = np.maximum.accumulate(np.where(first, at, 0))
    depth = at - begin
    step = 1
    while step <= int(depth.max(initial=0)):
        take = np.flatnonzero(depth >= step)
        earlier, later = funcs[take - step], funcs[take]
        funcs[take] = np.take_along_axis(later, earlier.astype(np.intp), axis=1)
        step *= 2
    before = np.where(near[begin] > 0, cls[np.maximum(near[begin] - 1, 0)], END)
    state[near] = funcs[at, before]
    return state, marks


def piece_starts(cp: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each position. Texts are parted by END symbols; the first and last symbols are END."""
    run = np.where(cls == BLANK, SPACE, cls)
    start = np.ones(len(cp), bool)
    start[1:] = run[1:] != run[:-1]
    start |= cls == END
    white = run == SPACE
    last = np.flatnonzero(white[:-1] & ~white[1:] & (run[1:] != END))
    start[last] = True
    start[last[cls[last] == SPACE] + 1] = False
    state, marks = states_after(cp, cls)
    for width in (2, 3):
        ends = marks[(marks + width - 1) < len(cp)]
        ends = ends[(state[ends] == MARK) & (state[ends + width - 1] == DONE)]
        if width == 3:
            ends = ends[state[ends + 1] != DONE]
        for k in range(1, width):
            start[ends + k] = False
        after = ends + width
        start[after[after < len(cp)]] = True
    return start


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte-pair merging of one piece by rank: the lowest rank first, the leftmost of equals. A heap of pairs over a linked list."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    end = list(range(1, n + 1))  # where the part that starts at i ends; 0 once it is merged away
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, mid, stop = heapq.heappop(heap)
        if end[i] != mid or end[mid] != stop:
            continue  # one of the two has been merged since
        end[i], end[mid] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, stop, end[stop]))
        j = before[i]
        if j >= 0 and (r := ranks.get(piece[j:stop])) is not None:
            heapq.heappush(heap, (r, j, i, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


@functools.cache
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Encoder:
    """Encodes lists of texts; one per worker process and vocabulary."""

    def __init__(self, path: str = BYTE_BPE_50K, native: bool = True):
        self.ranks = load_ranks(path)
        self.cache: dict[str, tuple[int, ...]] = {}
        self.merge = functools.partial(merge_pairs, ranks=self.ranks)
        if native:
            try:
                import tiktoken

                self.merge = tiktoken.Encoding("pieces", pat_str=r"\p{L}+", mergeable_ranks=self.ranks, special_tokens={})._encode_single_piece
            except ImportError:
                pass

    def of_piece(self, piece: str) -> tuple[int, ...]:
        ids = self.cache.get(piece)
        if ids is None:
            raw = piece.encode()
            ids = tuple(self.merge(raw))
            if len(raw) <= CACHE_BYTES:
                if len(self.cache) >= CACHE_PIECES:
                    self.cache.clear()
                self.cache[piece] = ids
        return ids

    def block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, their offsets by text)."""
        ids, offs, _ = self.block_offsets(texts, places=False)
        return ids, offs

    def block_offsets(self, texts: list[str], places: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """(ids of all texts, their offsets by text, of each id the code point of its text in which it begins)."""
        joined = "\0" + "\0".join(texts) + "\0"
        cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum(np.array([0] + [len(t) + 1 for t in texts]))
        cls = class_table()[cp]
        cls[ends] = END
        starts = np.flatnonzero(piece_starts(cp, cls))
        width = np.ones(len(cp), np.int8)
        for bound in (0x80, 0x800, 0x10000):
            width += cp >= bound
        at = np.zeros(len(cp) + 1, np.int64)
        np.cumsum(width, out=at[1:])
        offsets = np.append(at[starts], at[-1]).astype(np.int64 if at[-1] > 2**31 - 1 else np.int32)
        kind = pa.LargeStringArray if offsets.dtype == np.int64 else pa.StringArray
        pieces = kind.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(joined.encode("utf-8", "surrogatepass")))
        coded = pieces.dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False)
        of = [self.of_piece(p) for p in coded.dictionary.to_pylist()]
        sizes = np.array([len(x) for x in of], np.int64)
        flat = np.fromiter((i for x in of for i in x), np.int32, int(sizes.sum()))
        lens = sizes[index]
        lens[cls[starts] == END] = 0
        total = np.zeros(len(lens) + 1, np.int64)
        np.cumsum(lens, out=total[1:])
        from_ = (np.cumsum(sizes) - sizes)[index]
        ids = flat[np.repeat(from_ - total[:-1], lens) + np.arange(total[-1])] if total[-1] else np.zeros(0, np.int32)
        offs = total[np.searchsorted(starts, ends)]
        if not places:
            return ids, offs, None
        # bytes of the ids before each within its piece, carried to the block's bytes, and from there to code points
        length = self.lengths()[ids]
        run = np.cumsum(length) - length
        piece_of = np.repeat(np.arange(len(lens)), lens)
        first = run[np.minimum(total[:-1], max(0, len(ids) - 1))] if len(ids) else np.zeros(len(lens), np.int64)
        byte_at = offsets[:-1].astype(np.int64)[piece_of] + run - first[piece_of]
        point = np.searchsorted(at, byte_at, "right") - 1
        text_of = np.searchsorted(ends, point, "right") - 1
        return ids, offs, point - ends[text_of] - 1

    @functools.cached_property
    def _lengths(self) -> np.ndarray:
        out = np.zeros(max(self.ranks.values()) + 1, np.int64)
        for word, i in self.ranks.items():
            out[i] = len(word)
        return out

    def lengths(self) -> np.ndarray:
        """Bytes of each id."""
        return self._lengths


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about BLOCK_CHARS code points."""
    a = size = 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= BLOCK_CHARS:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def encode_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = BYTE_BPE_50K) -> DataFrame:
    """(id, ids) of every row. Null and empty texts give the empty list; duplicates are encoded each."""
    src = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        enc = encoder(path)
        for b in batches:
            texts = b.column(1).to_pylist()
            for x, y in blocks(texts):
                ids, offs = enc.block(texts[x:y])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(x, y - x), pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(ids))], names=["doc_id", "ids"])

    return src.mapInArrow(run, T.StructType([src.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def encode_with_offsets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = BYTE_BPE_50K) -> DataFrame:
    """(doc_id, ids, starts): as encode_documents, with the code point in which each id begins."""
    src = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        enc = encoder(path)
        for b in batches:
            texts = b.column(1).to_pylist()
            for x, y in blocks(texts):
                ids, offs, starts = enc.block_offsets(texts[x:y])
                lists = [pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(v.astype(np.int32))) for v in (ids, starts)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(x, y - x), *lists], names=["doc_id", "ids", "starts"])

    return src.mapInArrow(run, T.StructType([src.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("starts", T.ArrayType(T.IntegerType()))]))


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = BYTE_BPE_50K) -> DataFrame:
    """(doc_id, n_tokens) of every row, without the ids leaving the worker."""
    src = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        enc = encoder(path)
        for b in batches:
            texts = b.column(1).to_pylist()
            for x, y in blocks(texts):
                _, offs = enc.block(texts[x:y])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(x, y - x), pa.array(np.diff(offs))], names=["doc_id", "n_tokens"])

    return src.mapInArrow(run, T.StructType([src.schema["doc_id"], T.StructField("n_tokens", T.LongType())]))


def decode_documents(df: DataFrame, path: str = BYTE_BPE_50K) -> DataFrame:
    """(doc_id, text) of (doc_id, ids): the bytes of the ids joined; the inverse of encode_documents but for nulls."""

    def run(batches):
        words = {i: b for b, i in load_ranks(path).items()}
        for b in batches:
            texts = [b"".join(words[i] for i in ids or ()).decode("utf-8", "replace") for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    src = df.select("doc_id", "ids")
    return src.mapInArrow(run, T.StructType([src.schema["doc_id"], T.StructField("text", T.StringType())]))


def piece_offsets(text: str) -> list[int]:
    """Code point offsets at which the pieces of one text start."""
    cp = np.frombuffer(("\0" + text + "\0").encode("utf-32-le"), np.uint32)
    cls = class_table()[cp]
    cls[[0, -1]] = END
    return [int(i) - 1 for i in np.flatnonzero(piece_starts(cp, cls)) if cls[i] != END]
