"""Problem 9: documents into containers of a fixed number of tokens.

Only the histogram of sizes (at most CAPACITY rows, whatever the corpus) comes to the driver. Patterns of a few documents
that fill a container are enumerated over it, their repeat counts fitted by non-negative least squares, rounded down, and
what is left is packed best-fit decreasing, still over counts of sizes. The plan says which ranks of which size go where;
documents take their rank within their size, in salted parts, and look the plan up.

Defined results: documents without tokens (null, empty) get no row; one larger than a container is cut into full containers
and a rest that is packed like a document; equal documents are packed each; ties go by doc_id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.llm.tokens import BYTE_BPE_50K, count_tokens
from quernstone.runtime import cut

CAPACITY = 8192
#: Parts in which the documents of one size are ranked.
SALTS = 64
#: Patterns begun from each size, and the most documents in one.
VARIANTS, FEW = 2, 8
ROUNDS = 150


def enumerate_patterns(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> list[dict[int, int]]:
    """Patterns (position of size -> repeats) of at most FEW documents, or of a run of one size and FEW - 1 others where that
    doesn't fill a container, each closed with the largest size that fits."""
    order = np.repeat(np.arange(len(sizes)), np.maximum(1, np.minimum(counts, 4 + counts * 4096 // max(1, counts.sum()))))
    patterns, seen, step = [], set(), 0
    for v in range(VARIANTS):
        for i in range(len(sizes) - 1, -1, -1):
            # short documents come in a run of one size, which few others close
            run = max(1, min(int(counts[i]), capacity // int(sizes[i]) - FEW)) if int(sizes[i]) * FEW < capacity else 1
            got, room = {i: run}, capacity - run * int(sizes[i])
            for k in range(FEW - 1):
                fit = int(np.searchsorted(sizes, room, "right")) - 1
                if fit < 0:
                    break
                step += 1
                j = fit if k == FEW - 2 or room <= 2 * sizes[i] and v == 0 else int(order[int(step * 0.6180339887 % 1 * len(order))])
                j = min(j, fit)
                rest = room - int(sizes[j])
                if rest > 0 and rest < sizes[0]:
                    j = fit
                    rest = room - int(sizes[j])
                got[j] = got.get(j, 0) + 1
                room = rest
            key = tuple(sorted(got.items()))
            if key not in seen:
                seen.add(key)
                patterns.append(got)
    return patterns


def fit_counts(patterns: list[dict[int, int]], counts: np.ndarray) -> np.ndarray:
    """Non-negative least squares of A x = counts by multiplicative updates, A being sparse (sizes by patterns)."""
    col = np.repeat(np.arange(len(patterns)), [len(p) for p in patterns])
    row = np.fromiter((i for p in patterns for i in p), np.int64)
    val = np.fromiter((m for p in patterns for m in p.values()), np.float64)
    target = np.bincount(col, val * counts[row], len(patterns))
    x = np.full(len(patterns), counts.sum() / max(1.0, val.sum()))
    for _ in range(ROUNDS):
        covered = np.bincount(row, val * x[col], len(counts))
        x *= target / np.maximum(np.bincount(col, val * covered[row], len(patterns)), 1e-12)
    return x


def pack_histogram(hist: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """[(containers, {size: documents in each})] that hold exactly hist (size -> number, sizes from 1 to capacity)."""
    hist = {s: c for s, c in hist.items() if c > 0}
    if not hist:
        return []
    if min(hist) < 1 or max(hist) > capacity:
        raise ValueError("sizes must lie between 1 and the capacity")
    sizes = np.array(sorted(hist), np.int64)
    left = np.array([hist[int(s)] for s in sizes], np.int64)
    patterns = enumerate_patterns(sizes, left, capacity)
    x = fit_counts(patterns, left.astype(np.float64))
    groups: list[tuple[int, dict[int, int]]] = []
    waste = [capacity - sum(int(sizes[i]) * m for i, m in p.items()) for p in patterns]
    for k in sorted(range(len(patterns)), key=lambda k: (waste[k], -x[k], k)):
        p = patterns[k]
        n = min([int(np.floor(x[k] + 0.5)), *(int(left[i]) // m for i, m in p.items())])
        if n > 0 and waste[k] <= capacity // 512:
            for i, m in p.items():
                left[i] -= n * m
            groups.append((n, {int(sizes[i]): m for i, m in p.items()}))
    return groups + best_fit({int(s): int(c) for s, c in zip(sizes, left)}, capacity)


def best_fit(hist: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Best-fit decreasing over counts: containers that hold the same stay one group with a multiplicity."""
    by_room: dict[int, list[tuple[int, dict[int, int]]]] = {}
    mask = 0
    for size in sorted((s for s, c in hist.items() if c), reverse=True):
        todo = hist[size]
        while todo:
            fits = mask >> size
            if not fits:
                per = capacity // size
                new = [(todo // per, per), (1 if todo % per else 0, todo % per)]
                for n, m in new:
                    if n:
                        by_room.setdefault(capacity - m * size, []).append((n, {size: m}))
                        mask |= 1 << (capacity - m * size)
                break
            room = size + (fits & -fits).bit_length() - 1
            n, held = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                mask &= ~(1 << room)
            per = room // size
            full, rest = min(n, todo // per), 0
            if full < n:
                rest = todo - full * per if full * per < todo and todo - full * per < per else 0
            parts = [(full, per), (1 if rest else 0, rest), (n - full - (1 if rest else 0), 0)]
            for k, m in parts:
                if k:
                    to = room - m * size
                    by_room.setdefault(to, []).append((k, {**held, size: m} if m else held))
                    mask |= 1 << to
            todo -= full * per + rest
    return [g for room in sorted(by_room) for g in by_room[room]]


def plan_rows(groups: list[tuple[int, dict[int, int]]]) -> tuple[np.ndarray, ...]:
    """(size, first rank, first container, documents of the size in each container), sorted by size and rank."""
    rank: dict[int, int] = {}
    rows, container = [], 0
    for n, held in groups:
        for size, m in held.items():
            rows.append((size, rank.get(size, 0), container, m))
            rank[size] = rank.get(size, 0) + n * m
        container += n
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return tuple(table.T.copy())


def pack_documents(df: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", path: str = BYTE_BPE_50K) -> DataFrame:
    """(doc_id, piece_no, container, start_token, n_tokens): every token of every document exactly once."""
    sizes = cut(count_tokens(df, id_col, text_col, path).where("n_tokens > 0"), "sizes")
    return pack_sizes(sizes, capacity)


def pack_sizes(sizes: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """As pack_documents, from (doc_id, n_tokens)."""
    spark = sizes.sparkSession
    sizes = sizes.where("n_tokens > 0").withColumn("full", F.expr(f"n_tokens div {capacity}"))
    rest = sizes.select("doc_id", F.col("full").alias("piece_no"), (F.col("full") * capacity).alias("start_token"), (F.col("n_tokens") - F.col("full") * capacity).alias("size"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt")).where("size > 0")
    parts = rest.groupBy("size", "salt").agg(F.count("*").alias("n"))
    hist = {r["size"]: r["n"] for r in parts.groupBy("size").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    size, first, container, per = plan_rows(pack_histogram(hist, capacity))
    shared = spark.sparkContext.broadcast((size * (1 << 40) + first, first, container, per))
    before = parts.withColumn("before", F.sum("n").over(Window.partitionBy("size").orderBy("salt")) - F.col("n")).drop("n")
    ranked = rest.join(before, ["size", "salt"]).withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("size", "salt").orderBy("doc_id", "piece_no")) - 1)

    def place(batches):
        key, first, container, per = shared.value
        for b in batches:
            size, rank = b.column(2).to_numpy(), b.column(4).to_numpy()
            at = np.searchsorted(key, size * (1 << 40) + rank, "right") - 1
            where = container[at] + (rank - first[at]) // per[at]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([f"c{w}" for w in where.tolist()], pa.string()), b.column(3), b.column(2)], names=["doc_id", "piece_no", "container", "start_token", "n_tokens"])

    schema = T.StructType([sizes.schema["doc_id"], T.StructField("piece_no", T.LongType()), T.StructField("container", T.StringType()), T.StructField("start_token", T.LongType()), T.StructField("n_tokens", T.LongType())])
    packed = ranked.select("doc_id", "piece_no", "size", "start_token", F.col("rank").cast("bigint")).mapInArrow(place, schema)
    whole = sizes.where("full > 0").select("doc_id", F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("piece_no")).select("doc_id", F.col("piece_no").cast("bigint"), F.concat(F.lit("w"), F.col("doc_id").cast("string"), F.lit("."), F.col("piece_no").cast("string")).alias("container"), (F.col("piece_no") * capacity).cast("bigint").alias("start_token"), F.lit(capacity).cast("bigint").alias("n_tokens"))
    return packed.unionByName(whole)
