"""Nearest neighbours, groups of variants and their canonical member, within documents."""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernstone.functions.text import fingerprint
from quernstone.runtime import cut

#: Vectors in a block; similarities are computed block against block, so no task holds a document.
BLOCK = 512


def nearest(items: DataFrame, k: int = 20, least: float | None = None) -> DataFrame:
    """(document_id, i, j, similarity, rank) of the k items most similar to each, itself included, rank from 1.

    items: (document_id, pos, embedding), embeddings of one length and unit norm. Exact, by inner product in double
    precision; ties go to the lower position. With `least`, only similarities of at least that are returned.
    """
    blocks = (
        items.where("embedding is not null")
        .select("document_id", F.expr(f"pos div {BLOCK}").alias("block"), "pos", F.col("embedding").cast("array<double>").alias("v"))
        .groupBy("document_id", "block")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "v"))).alias("rows"))
        .select("document_id", "block", F.col("rows.pos").alias("pos"), F.flatten("rows.v").alias("flat"))
    )
    held = cut(blocks, "blocks")
    a = held.select("document_id", F.col("block").alias("block_a"), F.col("pos").alias("pos_a"), F.col("flat").alias("flat_a"))
    b = held.select(F.col("document_id").alias("doc_b"), F.col("pos").alias("pos_b"), F.col("flat").alias("flat_b"))
    pairs = a.join(b, F.col("document_id").eqNullSafe(F.col("doc_b"))).select("document_id", "pos_a", "flat_a", "pos_b", "flat_b")
    doc_type = held.schema["document_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                pos_a, pos_b = (batch.column(c)[r].values.to_numpy() for c in (1, 3))
                x, y = (batch.column(c)[r].values.to_numpy().reshape(len(p), -1) for c, p in ((2, pos_a), (4, pos_b)))
                sims = x @ y.T
                take = min(k, len(pos_b))
                # order by similarity, then position: exact even where ties straddle the cut
                order = np.lexsort((np.broadcast_to(pos_b, sims.shape), -sims))[:, :take]
                rows = np.repeat(np.arange(len(pos_a)), take)
                cols = order.ravel()
                values = sims[rows, cols]
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[r].as_py()] * len(rows), batch.column(0).type), pa.array(pos_a[rows]), pa.array(pos_b[cols]), pa.array(values)], names=["document_id", "i", "j", "similarity"])

    found = pairs.mapInArrow(run, f"document_id {doc_type}, i bigint, j bigint, similarity double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("document_id", "i").orderBy(F.desc("similarity"), "j"))).where(F.col("rank") <= k)
    return ranked if least is None else ranked.where(F.col("similarity") >= least)


def similar_edges(items: DataFrame, threshold: float = 0.92, k: int = 20, same_anchor_only: bool = False) -> DataFrame:
    """(document_id, i, j, similarity) of neighbours that reach the threshold; article and clause must agree if asked, null
    agreeing with null. items then need columns article and clause."""
    edges = nearest(items, k, threshold).where("i <> j").select("document_id", "i", "j", "similarity")
    if not same_anchor_only:
        return edges
    a = items.select(F.col("document_id").alias("_d"), F.col("pos").alias("i"), F.col("article").alias("_a1"), F.col("clause").alias("_c1"))
    b = items.select(F.col("document_id").alias("_e"), F.col("pos").alias("j"), F.col("article").alias("_a2"), F.col("clause").alias("_c2"))
    joined = edges.join(a, edges["document_id"].eqNullSafe(a["_d"]) & (edges["i"] == a["i"])).drop(a["i"]).join(b, F.col("document_id").eqNullSafe(b["_e"]) & (edges["j"] == b["j"])).drop(b["j"])
    return joined.where(F.col("_a1").eqNullSafe(F.col("_a2")) & F.col("_c1").eqNullSafe(F.col("_c2"))).select("document_id", "i", "j", "similarity")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(document_id, pos, root): the least position that edges (document_id, i, j) connect each node (document_id, pos) to.

    Labels spread to the least neighbour's and then to the label's own label, so rounds grow with the logarithm of a
    component's width. Only nodes with an edge take part; each round is written to the shared folder.
    """
    key = F.coalesce(F.col("document_id").cast("string"), F.lit(""))
    both = cut(edges.select(key.alias("d"), "i", "j").unionByName(edges.select(key.alias("d"), F.col("j").alias("i"), F.col("i").alias("j"))).distinct(), "edges")
    labels = cut(both.groupBy("d", "i").agg(F.least(F.min("j"), F.first("i")).alias("root")), "labels")
    while True:
        theirs = labels.select("d", F.col("i").alias("j"), F.col("root").alias("near"))
        spread = both.join(theirs, ["d", "j"]).groupBy("d", "i").agg(F.min("near").alias("near")).join(labels, ["d", "i"]).select("d", "i", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        up = spread.select("d", F.col("i").alias("root"), F.col("root").alias("above"))
        step = cut(spread.join(up, ["d", "root"], "left").select("d", "i", "old", F.coalesce(F.least("root", "above"), F.col("root")).alias("root")), "labels")
        labels = step.select("d", "i", "root")
        if not step.where("root <> old").limit(1).count():
            break
    named = labels.select(F.col("d").alias("_d"), F.col("i").alias("_i"), "root")
    return nodes.select("document_id", "pos").join(named, (key == F.col("_d")) & (F.col("pos") == F.col("_i")), "left").select("document_id", "pos", F.coalesce("root", "pos").alias("root"))


def canonical_members(members: DataFrame) -> DataFrame:
    """(document_id, root, content_id, variants, canonical_pos): the longest text of each group, the first of equal ones.

    members: (document_id, pos, root, text).
    """
    best = F.max_by("pos", F.struct(F.length(F.coalesce("text", F.lit(""))), -F.col("pos")))
    return members.groupBy("document_id", "root").agg(F.count("*").alias("variants"), best.alias("canonical_pos")).withColumn("content_id", F.concat(F.lit("cg-"), F.col("root").cast("string")))


def group_variants(items: DataFrame, threshold: float = 0.92, k: int = 20, same_anchor_only: bool = False) -> DataFrame:
    """items with root: members of one group share it, and it is the group's first position."""
    found = components(items, similar_edges(items, threshold, k, same_anchor_only)).select(F.col("document_id").alias("_d"), F.col("pos").alias("_p"), "root")
    return items.join(found, items["document_id"].eqNullSafe(found["_d"]) & (items["pos"] == found["_p"])).drop("_d", "_p")


def merge_candidates(groups: DataFrame, threshold: float = 0.86, ranks: int = 6) -> DataFrame:
    """(document_id, i, j, rank, similarity): of each group's first `ranks` neighbours, itself among them, those that are
    others and reach the threshold. groups: (document_id, pos, embedding)."""
    return nearest(groups, ranks, threshold).where("i <> j").select("document_id", "i", "j", "rank", "similarity")


def absorb_order(pairs: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(absorbed, into) by going through (i, rank, j): a group that isn't absorbed yet takes each that isn't either."""
    gone: dict[int, int] = {}
    for i, _, j in sorted(pairs):
        if i not in gone and j not in gone and i != j:
            gone[j] = i
    return sorted(gone.items())


def greedy_absorb(confirmed: DataFrame) -> DataFrame:
    """(document_id, absorbed, into) of confirmed candidates (document_id, i, j, rank), document by document.

    The order decides, so the confirmed edges of one document meet in one task; nothing but their positions does.
    """
    rows = confirmed.select("document_id", "i", "rank", "j")

    def run(key, table):
        out = absorb_order(list(zip(*(table.column(c).to_pylist() for c in ("i", "rank", "j")))))
        return pa.table({"document_id": pa.array([key[0].as_py()] * len(out), table.schema.field("document_id").type), "absorbed": pa.array([a for a, _ in out], pa.int64()), "into": pa.array([b for _, b in out], pa.int64())})

    doc = confirmed.schema["document_id"].dataType.simpleString()
    return rows.groupBy("document_id").applyInArrow(run, f"document_id {doc}, absorbed bigint, into bigint")


def same_content(pairs: DataFrame, decide=None) -> DataFrame:
    """pairs (..., canonical, candidate) with column same: whether both say the same.

    decide: (key, canonical, candidate) of distinct pairs, cut to 800 and 400 characters, -> (key, decision 0/1 or null);
    null and missing answers are no, and without a decider all are.
    """
    if decide is None:
        return pairs.withColumn("same", F.lit(False))
    keyed = pairs.withColumn("_key", fingerprint(F.lit("merge"), F.col("canonical"), F.lit("\n"), F.col("candidate")))
    questions = keyed.groupBy(F.col("_key").alias("key")).agg(F.substring(F.min("canonical"), 1, 800).alias("canonical"), F.substring(F.min("candidate"), 1, 400).alias("candidate"))
    answers = decide(questions).select(F.col("key").alias("_k"), (F.col("decision").cast("int") == 1).alias("_d"))
    return keyed.join(answers, keyed["_key"] == answers["_k"], "left").withColumn("same", F.coalesce("_d", F.lit(False))).drop("_key", "_k", "_d")


def merge_walk(edges: list[tuple[int, int, int]], same: dict[tuple[int, int], bool], lengths: dict[int, int]) -> tuple[dict[int, list[int]], set[tuple[int, int]]]:
    """({group: it and what it took, in order}, questions still open) of candidates (i, rank, j).

    As absorb_order, but a group that took a longer text is asked about by that text, so the questions depend on the walk:
    same holds answers by (i, the group whose text j bears then). Where one is missing, j's own text stands in.
    """
    held: dict[int, list[int]] = {}
    bears: dict[int, int] = {}
    gone: set[int] = set()
    missing: set[tuple[int, int]] = set()
    for i, near in groupby(sorted(edges), key=lambda e: e[0]):
        if i in gone:
            continue
        for _, _, j in near:
            if j in gone or j == i:
                continue
            c = bears.get(j, j)
            if (i, c) not in same:
                missing.add((i, c))
            if same.get((i, c), same.get((i, j), False)):
                held.setdefault(i, [i]).extend(held.pop(j, [j]))
                gone.add(j)
                if lengths[c] > lengths[bears.get(i, i)]:
                    bears[i] = c
    return held, missing


def merged_groups(members: DataFrame, decide, threshold: float = 0.86, ranks: int = 6) -> DataFrame:
    """(document_id, absorbed, into, turn): each group that was merged, the group it is in at last, and its place there.

    members: (document_id, pos, root, text, embedding). A group stands for its first member's embedding and its longest text.
    """
    own = cut(members.groupBy(F.col("document_id").alias("_d"), F.col("root").alias("_r")).agg(F.max_by("text", F.struct(F.length("text"), -F.col("pos"))).alias("_t")), "own")
    edges = cut(merge_candidates(members.where("pos = root").select("document_id", "pos", "embedding"), threshold, ranks).select("document_id", "i", "rank", "j"), "candidates")

    def with_texts(pairs: DataFrame, j: str) -> DataFrame:
        a, b = own.select("_d", "_r", F.col("_t").alias("canonical")), own.select(F.col("_d").alias("_e"), F.col("_r").alias("_s"), F.col("_t").alias("candidate"))
        first = pairs.join(a, F.col("document_id").eqNullSafe(F.col("_d")) & (F.col("i") == F.col("_r")))
        return first.join(b, F.col("document_id").eqNullSafe(F.col("_e")) & (F.col(j) == F.col("_s"))).drop("_d", "_r", "_e", "_s")

    none = F.lit(None)
    sized = with_texts(edges, "j").select("document_id", "i", F.col("rank").cast("bigint").alias("rank"), "j", F.length("canonical").cast("bigint").alias("n_i"), F.length("candidate").cast("bigint").alias("n_j"), none.cast("boolean").alias("same"))
    sized = cut(sized, "sized")

    def run(key, table):
        links, same, lengths = [], {}, {}
        for i, rank, j, n_i, n_j, yes in zip(*(table.column(c).to_pylist() for c in ("i", "rank", "j", "n_i", "n_j", "same"))):
            if yes is None:
                links.append((i, rank, j))
                lengths[i], lengths[j] = n_i, n_j
            else:
                same[i, j] = yes
        held, missing = merge_walk(links, same, lengths)
        out = [(g, i, turn) for i, took in held.items() for turn, g in enumerate(took)] + [(i, c, None) for i, c in sorted(missing)]
        return pa.table({"document_id": pa.array([key[0].as_py()] * len(out), table.schema.field("document_id").type), **{c: pa.array([x[k] for x in out], pa.int64()) for k, c in enumerate(("absorbed", "into", "turn"))}})

    doc = members.schema["document_id"].dataType.simpleString()
    asked, known = edges.select("document_id", "i", "j"), sized
    while True:
        answers = cut(same_content(with_texts(asked, "j"), decide).select("document_id", "i", "j", "same"), "answers")
        null = none.cast("bigint")
        known = known.unionByName(answers.select("document_id", "i", null.alias("rank"), "j", null.alias("n_i"), null.alias("n_j"), "same"))
        walked = cut(known.select("document_id", "i", "rank", "j", "n_i", "n_j", "same").groupBy("document_id").applyInArrow(run, f"document_id {doc}, absorbed bigint, into bigint, turn bigint"), "walked")
        asked = walked.where("turn is null").select("document_id", F.col("absorbed").alias("i"), F.col("into").alias("j"))
        if not asked.limit(1).count():
            return walked


def absorb(members: DataFrame, absorbed: DataFrame) -> DataFrame:
    """members (document_id, pos, root, text) with the roots of absorbed groups replaced by those that hold them at last, and
    turn, the place of a member's old group there. absorbed: (document_id, absorbed, into, turn) of merged_groups."""
    moved = absorbed.select(F.col("document_id").alias("_d"), F.col("absorbed").alias("_a"), "into", "turn")
    joined = members.join(moved, members["document_id"].eqNullSafe(moved["_d"]) & (members["root"] == moved["_a"]), "left")
    return joined.withColumn("root", F.coalesce("into", "root")).withColumn("turn", F.coalesce("turn", F.lit(0))).drop("_d", "_a", "into")


def confirm_variants(members: DataFrame, decide=None) -> DataFrame:
    """members (document_id, pos, root, turn, text) but for short ones that aren't confirmed to say what the canonical one does."""
    best = F.max_by(F.struct("pos", "text"), F.struct(F.length("text"), -F.col("turn"), -F.col("pos")))
    own = members.groupBy(F.col("document_id").alias("_d"), F.col("root").alias("_r")).agg(best.alias("_b"))
    joined = members.join(own, members["document_id"].eqNullSafe(own["_d"]) & (members["root"] == own["_r"]))
    marked = cut(joined.withColumn("is_canonical", F.col("pos") == F.col("_b.pos")).withColumn("canonical", F.col("_b.text")).withColumn("candidate", F.col("text")).withColumn("content_id", F.to_json(F.struct("document_id", "root"))).drop("_d", "_r", "_b"), "marked")
    long = keep_long_variants(marked).withColumn("same", F.lit(False))
    kept = long.select(F.col("content_id").alias("_c"), F.col("pos").alias("_p"))
    short = marked.join(kept, (F.col("content_id") == F.col("_c")) & (F.col("pos") == F.col("_p")), "left_anti")
    told = long.unionByName(same_content(short, decide))
    return keep_long_variants(told, "same").drop("is_canonical", "canonical", "candidate", "content_id", "same")


def keep_long_variants(variants: DataFrame, confirmed: str = "false") -> DataFrame:
    """Variants (content_id, text, is_canonical, ...) but for those much shorter than the canonical one and not confirmed.

    A group's canonical text is that of its canonical row; a group without one keeps all.
    """
    own = variants.where("is_canonical").groupBy(F.col("content_id").alias("_c")).agg(F.max(F.length(F.coalesce("text", F.lit("")))).alias("_n"))
    least = F.greatest(F.lit(20), F.floor(F.col("_n") * 0.5))
    joined = variants.join(own, variants["content_id"] == own["_c"], "left")
    keep = F.col("_n").isNull() | F.col("is_canonical") | (F.length(F.coalesce("text", F.lit(""))) >= least) | F.expr(confirmed)
    return joined.where(keep).drop("_c", "_n")


def group_summary(variants: DataFrame) -> DataFrame:
    """(content_id, canonical_text, variant_count, coverage) of variants (content_id, text, is_canonical)."""
    return variants.groupBy("content_id").agg(F.max(F.when(F.col("is_canonical"), F.col("text"))).alias("canonical_text"), F.count("*").alias("variant_count")).withColumn("coverage", F.lit(0.0))
