"""The merge of groups that a decider confirms, the filter of short variants, and all variants as targets."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from quernstone.functions.config import Settings
from quernstone.plans.pipeline import embedded_groups, run_pipeline

CHUNKS = "id string, document_id string, page int, offset int, text string"


def decide(pairs):
    return pairs.select("key", (F.crc32(F.concat("canonical", F.lit("|"), "candidate").cast("binary")) % 3 > 0).cast("int").alias("decision"))


def decide_one(canonical, candidate):
    return zlib.crc32(f"{canonical}|{candidate}".encode()) % 3 > 0


def plain_loop(texts, vectors):
    """Members of each group in order, by going through groups one after the other."""
    n = len(texts)
    root = list(range(n))
    for i in range(n):
        for j in range(n):
            if i != j and vectors[i] @ vectors[j] >= 0.92:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    roots = sorted(set(root))
    held = {r: [i for i in range(n) if root[i] == r] for r in roots}

    def canonical(r):
        return max(held[r], key=lambda i: (len(texts[i]), -held[r].index(i)))

    e, gone = np.array([vectors[r] for r in roots]), set()
    for i, r in enumerate(roots):
        if r in gone:
            continue
        sims = e @ e[i]
        near = [roots[j] for j in np.argsort(-sims)[:6] if j != i and sims[j] >= 0.86]
        told = [decide_one(texts[canonical(r)], texts[canonical(j)]) for j in near]
        for j, yes in zip(near, told):
            if yes and j not in gone:
                held[r] = held[r] + held[j]
                gone.add(j)
    out = {}
    for r in roots:
        if r not in gone:
            c = canonical(r)
            out[r] = [i for i in held[r] if i == c or len(texts[i]) >= max(20, len(texts[c]) // 2) or decide_one(texts[c], texts[i])]
    return out


def test_merge_like_a_plain_loop(spark):
    rng = np.random.default_rng(8)
    docs = {}
    for d in (*"abcdefgh", None):
        v = rng.normal(size=(19, 3))
        docs[d] = ([f"{d} {i} " + "x" * int(rng.integers(5, 70)) for i in range(19)], v / np.linalg.norm(v, axis=1, keepdims=True))
    rows = [(d, i, f"{d}#{i}", 1, 0, t, v.tolist()) for d, (texts, vectors) in docs.items() for i, (t, v) in enumerate(zip(texts, vectors))]
    df = spark.createDataFrame(rows, "document_id string, pos bigint, sentence_id string, page int, offset int, text string, embedding array<double>")
    got = {}
    for r in embedded_groups(df, lambda x: x, Settings(), decide).orderBy("turn", "pos").collect():
        got.setdefault((r["document_id"], r["root"]), []).append(r["pos"])
    expected = {(d, root): held for d, (texts, vectors) in docs.items() for root, held in plain_loop(texts, vectors).items()}
    assert got == expected and max(map(len, expected.values())) > 3


LONG, NEAR, SHORT, OTHER = "Câu dài nhất trong nhóm này, có đủ mọi chữ.", "Câu gần giống với nội dung của nhóm.", "Câu rất ngắn.", "Một câu khác hẳn nội dung."


def embed(df):
    at = F.when(F.col("text") == NEAR, 0.5).when(F.col("text") == OTHER, 1.5).otherwise(0.0)  # cos 0.5 is 0.88
    return df.withColumn("embedding", F.array(F.cos(at), F.sin(at)))


def test_pipeline_merges_and_filters(spark):
    chunks = spark.createDataFrame([("c1", "d", 1, 0, f"{NEAR} {SHORT} {LONG} {OTHER}")], CHUNKS)

    def yes(pairs):
        return pairs.select("key", F.lit(1).alias("decision"))

    def texts(targets, decider):
        return sorted(r["clean_text"] for r in run_pipeline(chunks, Settings(targets=targets), embed=embed, merge_decider=decider).collect())

    assert texts("canonical", yes) == sorted([LONG, OTHER])
    assert texts("all", yes) == sorted([LONG, NEAR, SHORT, OTHER])
    assert texts("all", None) == sorted([LONG, NEAR, OTHER])


def test_all_variants_offline(spark):
    rows = [("c1", "d", 1, 0, "Câu này đứng ở hai trang. Gồm:\n\na) một mục dài hơn.\n\nb) hai mục dài hơn."), ("c2", "d", 2, 0, "Câu này đứng ở hai trang. Câu này đứng ở hai trang.")]
    out = run_pipeline(spark.createDataFrame(rows, CHUNKS), Settings(targets="all")).collect()
    same = [(r["chunk_id"], r["page_range"][0]) for r in out if r["clean_text"] == "Câu này đứng ở hai trang."]
    assert sorted(same) == [("c1#s0", 1), ("c2#s0", 2)]
    assert sum(r["clean_text"].startswith("Gồm: a)") for r in out) == 1 and len(out) == 6
