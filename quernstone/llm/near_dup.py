"""Problem 6: sentences that share most of their words.

Texts are reduced to their set of words; equal sets are compared once. The words of a set are ordered, frequent ones last. Two
sets of the threshold's similarity share one of their first words, so many that fewer than the threshold's share are left, and so
sets meet under each of those. The place of their first common word in each bounds how many words they may share, and so the sizes
of the sets that each may be similar to from there: sets are compared where both sizes keep to that. Then the parities of their
words in 128 places are compared: as many parities differ at most as words do. No similar pair fails that; what passes is decided
exactly on the sets.

Sets that meet under a word of more than BUCKET are compared by blocks of at most BLOCK, all with all.

Defined results: texts without words (null, empty, blank, only marks) pair with nothing; texts equal but for white space, or
that only look different to a machine, are no pairs; pairs are listed singly.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.llm.lookalike import skeleton
from quernstone.runtime import cut

THRESHOLD = 0.7
#: Minima of the estimate, and how far below the threshold it may lie: 3.6 standard errors. Pairs don't hang on it.
BANDS, ROWS = 30, 4
MARGIN = 0.235
#: Sets under one word that are compared by a join; more are compared by blocks of at most BLOCK.
BUCKET, BLOCK = 2_000, 100_000
#: Sets that 32 others are compared with at once.
TILE = 2_048
#: The most frequent words that are ordered by frequency; others come before them. The order decides the work, not the pairs.
RANKED = 65_536
_WORD = re.compile(r"[^\W_]+")
_K = BANDS * ROWS
_rng = np.random.default_rng(20240229)
_MULTIPLY = _rng.integers(1, 2**32, _K, dtype=np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 2**32, _K, dtype=np.uint32)


def word_hashes(text: str) -> list[int]:
    return sorted({xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in _WORD.findall(text.lower())})


def minima(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(sets, K) minima of K hash functions over sets given as one flat array of hashes and where each begins."""
    out = np.empty((len(starts), _K), np.uint32)
    x = (flat >> np.uint64(32)).astype(np.uint32)
    for k in range(_K):
        h = x * _MULTIPLY[k] + _ADD[k]
        h ^= h >> np.uint32(15)
        h *= np.uint32(2246822519)
        h ^= h >> np.uint32(13)
        out[:, k] = np.minimum.reduceat(h, starts)
    return out


def packed_bits(low: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(sets, 2) the low bit of each of the K minima, and in the last byte the size of the set, 255 at most."""
    bits = np.packbits(((low >> np.uint32(9)) & np.uint32(1)).astype(np.uint8), axis=1)
    out = np.zeros((len(low), 16), np.uint8)
    out[:, : bits.shape[1]] = bits
    out[:, 15] = np.minimum(sizes, 255)
    return out.view(np.int64)


def estimate(a: list[int], b: list[int]) -> float:
    """Similarity estimated from packed bits: the share of minima that agree, corrected for chance agreement."""
    differ = bin((a[0] ^ b[0]) & (2**64 - 1)).count("1") + bin((a[1] ^ b[1]) & (2**56 - 1)).count("1")
    return 1 - 2 * differ / _K


_SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("set_id", T.LongType()), T.StructField("bare", T.LongType()), T.StructField("look", T.LongType()), T.StructField("words", T.ArrayType(T.LongType()))])


def word_sets(df: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, set_id, bare, look, words): the word set and its hash, hashes of the text without white space and of its look."""

    def signed(x: int) -> int:
        return x - (1 << 64) if x >= 1 << 63 else x

    h, known = xxhash.xxh3_64_intdigest, {}

    def hashed(word: str) -> int:
        if len(known) > 500_000:
            known.clear()
        known[word] = out = signed(h(word.encode("utf-8", "surrogatepass")))
        return out

    def run(batches):
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = sorted({known[w] if w in known else hashed(w) for w in _WORD.findall(t.lower())})
                if words:
                    for o, v in zip(out, (i, signed(h(np.array(words, np.int64).tobytes())), signed(h("".join(t.split()).encode("utf-8", "surrogatepass"))), signed(h(skeleton(t).encode("utf-8", "surrogatepass"))), words)):
                        o.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())))], names=_SCHEMA.names)

    return df.select(F.col(id_col).cast("string"), F.col(text_col)).where(F.col(text_col).isNotNull()).mapInArrow(run, _SCHEMA)


def most_different(sizes, threshold: float):
    """How many words two sets of at least the threshold's similarity differ in at most; sizes: the sum of theirs."""
    return (sizes * (1 - threshold) / (1 + threshold) + 1e-6) // 1


def signatures(sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(set_id, size, low, high, keys) of distinct (set_id, words): parities of the words in 128 places, and the first words."""
    counts = sets.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(RANKED).toArrow()  # of a fixed size
    by_word = np.argsort(counts.column("word").to_numpy())
    shared = sets.sparkSession.sparkContext.broadcast((counts.column("word").to_numpy()[by_word], counts.column("n").to_numpy()[by_word]))

    def run(batches):
        known, often = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            words = b.column(1)
            offsets = words.offsets.to_numpy()
            flat, starts, sizes = words.flatten().to_numpy(), offsets[:-1] - offsets[0], np.diff(offsets)
            of = np.repeat(np.arange(len(sizes)), sizes)
            at = np.minimum(np.searchsorted(known, flat), len(known) - 1)
            order = np.lexsort((flat, np.where(known[at] == flat, often[at], 0), of))
            first = sizes - np.ceil(threshold * sizes - 1e-6).astype(np.int64) + 1
            kept = np.arange(len(flat)) - starts[of] < np.minimum(first, sizes)[of]
            place = flat.view(np.uint64) >> np.uint64(57)
            bit = np.uint64(1) << (place & np.uint64(63))
            low, high = (np.bitwise_xor.reduceat(np.where((place >> np.uint64(6)) == half, bit, np.uint64(0)), starts).view(np.int64) for half in (0, 1))
            keys = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.minimum(first, sizes))]).astype(np.int32)), pa.array(flat[order][kept]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes.astype(np.int32)), pa.array(low), pa.array(high), keys], names=["set_id", "size", "low", "high", "keys"])

    return sets.where(F.size("words") > 0).select("set_id", "words").mapInArrow(run, "set_id bigint, size int, low bigint, high bigint, keys array<bigint>")


def reach(size, at, threshold: float):
    """The largest set that one of this size may be similar to whose first word in common is its word number at."""
    return ((size - at) * ((1 + threshold) / threshold) - size + 1e-6) // 1


def near_in_block(table: pa.Table, threshold: float) -> pa.Table:
    """(a, b), a < b, of the sets of one key that reach each other and differ in few enough parities; of two blocks (own, x, y),
    those between them."""
    size, most = (table.column(c).to_numpy().astype(np.int64) for c in ("size", "reach"))
    order = np.lexsort((most, size))
    size, most, ids = size[order], most[order], table.column("set_id").to_numpy()[order]
    low, high = (table.column(c).to_numpy()[order].view(np.uint64) for c in ("low", "high"))
    own = table.column("own").to_numpy()[order]
    between = bool(len(own)) and table.column("x")[0].as_py() != table.column("y")[0].as_py()
    limit, found = np.minimum(most_different(np.arange(2 * int(size[-1]) + 1 if len(size) else 1), threshold), 128).astype(np.uint8), []
    # of two sets the smaller one reaches its own size at least, as the larger one has that
    inner = np.flatnonzero(most >= size)
    xor, bits, more = np.empty(TILE * 32, np.uint64), np.empty(TILE * 32, np.uint8), np.empty(TILE * 32, np.uint8)
    for start in range(0, len(inner), 32):
        rows = inner[start : start + 32]
        # sets of their size on, up to the largest that they reach, that reach the smallest of them
        stop = int(np.searchsorted(size, most[rows].max(), "right"))
        others = rows[0] + np.flatnonzero(most[rows[0] : stop] >= size[rows[0]])
        for at in range(0, len(others), TILE):
            cols = others[at : at + TILE]
            shape, n = (len(rows), len(cols)), len(rows) * len(cols)
            x, u, v = xor[:n].reshape(shape), bits[:n].reshape(shape), more[:n].reshape(shape)
            np.bitwise_count(np.bitwise_xor(low[rows, None], low[cols][None], out=x), out=u)
            np.bitwise_count(np.bitwise_xor(high[rows, None], high[cols][None], out=x), out=v)
            u += v
            k = np.flatnonzero((u <= limit[size[rows[-1]] + size[cols]][None]).ravel())
            i, j = rows[k // len(cols)], cols[k % len(cols)]
            near = (i < j) & (u.ravel()[k] <= limit[size[i] + size[j]]) & (size[j] <= most[i]) & (size[i] <= most[j])
            if between:
                near &= own[i] != own[j]
            found.append(np.stack([ids[i[near]], ids[j[near]]]))
    pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return pa.table({"a": pairs.min(axis=0), "b": pairs.max(axis=0)})


def proposed(signed: DataFrame, threshold: float, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """(a, b), a < b, each once: all sets of at least the threshold's similarity, and some of less."""
    rows = signed.select("set_id", "size", "low", "high", F.posexplode("keys").alias("at", "key")).withColumn("reach", F.floor((F.col("size") - F.col("at")) * ((1 + threshold) / threshold) - F.col("size") + 1e-6).cast("int")).drop("at")
    full = cut(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > bucket), "full")
    few = rows.join(full, "key", "left_anti")
    x, y = few.alias("x"), few.alias("y")
    differ = F.bit_count(F.col("x.low").bitwiseXOR(F.col("y.low"))) + F.bit_count(F.col("x.high").bitwiseXOR(F.col("y.high")))
    both = F.col("x.size") + F.col("y.size")
    near = (F.col("x.size") <= F.col("y.reach")) & (F.col("y.size") <= F.col("x.reach")) & (differ <= F.floor(both * ((1 - threshold) / (1 + threshold)) + 1e-6))
    joined = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.set_id") < F.col("y.set_id")) & near).select(F.col("x.set_id").alias("a"), F.col("y.set_id").alias("b"))
    # every two blocks of a key's sets meet, and each block itself
    blocks = F.ceil(F.col("n") / block).cast("int")
    held = rows.join(full, "key").withColumn("own", F.pmod(F.xxhash64("set_id"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    held = held.select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "set_id", "size", "reach", "low", "high")
    met = held.groupBy("key", "x", "y").applyInArrow(lambda table: near_in_block(table, threshold), "a bigint, b bigint")
    return joined.unionByName(met).distinct()


def similar_sets(sets: DataFrame, threshold: float = THRESHOLD, bucket: int = BUCKET) -> DataFrame:
    """(a, b, similarity), a < b, of distinct sets (set_id, words) with at least the threshold."""
    likely = proposed(cut(signatures(sets, threshold), "signatures"), threshold, bucket)
    words = sets.select("set_id", "words")
    both = likely.join(words.select(F.col("set_id").alias("a"), F.col("words").alias("wa")), "a").join(words.select(F.col("set_id").alias("b"), F.col("words").alias("wb")), "b")
    common = both.withColumn("common", F.size(F.array_intersect("wa", "wb"))).withColumn("all", F.size("wa") + F.size("wb") - F.col("common"))
    return common.where(F.col("common") >= threshold * F.col("all") - 1e-9).select("a", "b", (F.col("common") / F.col("all")).alias("similarity"))


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id_a, id_b, similarity), id_a < id_b, of all pairs of rows with at least the threshold."""
    rows = cut(word_sets(df, id_col, text_col), "sets")
    sets = rows.groupBy("set_id").agg(F.first("words").alias("words"))
    variants = rows.select("set_id", "bare", "look").distinct()
    linked = similar_sets(cut(sets, "distinct"), threshold)
    own = variants.groupBy("set_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("set_id").alias("a"), F.col("set_id").alias("b"), F.lit(1.0).alias("similarity"))
    x = variants.select(*(F.col(c).alias(f"{c}_a") for c in variants.columns))
    y = variants.select(*(F.col(c).alias(f"{c}_b") for c in variants.columns))
    texts = linked.unionByName(own).join(x, F.col("a") == F.col("set_id_a")).join(y, F.col("b") == F.col("set_id_b")).where("bare_a <> bare_b and look_a <> look_b and (a <> b or bare_a < bare_b)")
    p = rows.select("id", "set_id", "bare", "look").select(*(F.col(c).alias(f"{c}_a") for c in ("id", "set_id", "bare", "look")))
    q = rows.select("id", "set_id", "bare", "look").select(*(F.col(c).alias(f"{c}_b") for c in ("id", "set_id", "bare", "look")))
    pairs = texts.join(p, ["set_id_a", "bare_a", "look_a"]).join(q, ["set_id_b", "bare_b", "look_b"])
    return pairs.where("id_a <> id_b").select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), "similarity")
