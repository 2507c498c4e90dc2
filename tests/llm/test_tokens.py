import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quernstone.llm import packing, tokens

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.BYTE_BPE_50K), reason="no vocabulary here")
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=tokens.load_ranks(tokens.BYTE_BPE_50K), special_tokens={})


def encode(texts, native=True):
    ids, at = tokens.Encoder(native=native).block(texts)
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


def test_same_ids_as_the_pattern(reference):
    rng = random.Random(1)
    alphabet = "'' stmdrevl  \n\t éạ1٣!.'…ế中ก็🗂️\x00x’"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(5000)] + ["", "   ", " 's", "x's's'll've're't'm'd", "I'LL", "''s", "\n's", "<|endoftext|>", "a" * 20000, "\r\n\r\n  x  "]
    assert encode(texts) == [reference.encode_ordinary(t) for t in texts]


def test_own_merging_agrees(reference):
    texts = ["Điều 1. Phạm vi áp dụng", "the quick brown fox's", "注文", "  ", "ก็"]
    assert encode(texts, native=False) == [reference.encode_ordinary(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=30), max_size=5))
def test_pieces_cover_the_text(texts):
    for t in texts:
        cuts = tokens.piece_offsets(t)
        assert "".join(t[a:b] for a, b in zip(cuts, [*cuts[1:], len(t)])) == t and (cuts[:1] == [0] or not t)


def test_documents(spark, reference):
    rows = [(1, None, "x"), (2, "", "x"), (3, "  \n ", "x"), (4, "Lặp lại", "x"), (5, "Lặp lại", "x"), (6, "y" * 300_000, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = {r["doc_id"]: r["ids"] for r in tokens.encode_documents(df).collect()}
    assert got == {i: reference.encode_ordinary(t or "") for i, t, _ in rows}
    back = {r["doc_id"]: r["text"] for r in tokens.decode_documents(tokens.encode_documents(df)).collect()}
    assert back == {i: t or "" for i, t, _ in rows}
    assert tokens.encode_documents(df.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_packing_places_everything(hist):
    groups = packing.pack_histogram(hist, 64)
    placed = {}
    for n, held in groups:
        assert n > 0 and sum(s * m for s, m in held.items()) <= 64
        for s, m in held.items():
            placed[s] = placed.get(s, 0) + n * m
    assert placed == hist
    assert sum(n for n, _ in groups) <= 2 * -(-sum(s * c for s, c in hist.items()) // 64)


def test_packing_of_documents(spark):
    rng = random.Random(2)
    sizes = [(i, rng.choice([0, 1, 7, 30, 63, 64, 65, 200, rng.randint(1, 64)])) for i in range(400)] + [(1000 + i, 33) for i in range(300)]
    rows = packing.pack_sizes(spark.createDataFrame(sizes, "doc_id bigint, n_tokens bigint"), 64).collect()
    load, seen = {}, {}
    for r in rows:
        load[r["container"]] = load.get(r["container"], 0) + r["n_tokens"]
        seen.setdefault(r["doc_id"], []).append((r["start_token"], r["n_tokens"]))
    assert max(load.values()) <= 64
    for i, n in sizes:
        parts = sorted(seen.get(i, []))
        assert sum(x for _, x in parts) == n and [s for s, _ in parts] == [sum(x for _, x in parts[:k]) for k in range(len(parts))]
        assert len(parts) == -(-n // 64)
    assert packing.pack_sizes(spark.createDataFrame([], "doc_id bigint, n_tokens bigint"), 64).count() == 0


def test_offsets_and_long_pieces():
    import numpy as np

    enc = tokens.Encoder()
    texts = ["", "a", "€uro ñ 漢字 thử", "  x\r\n", "không " * 50]
    ids, offs, starts = enc.block_offsets(texts)
    inverse = {i: b for b, i in enc.ranks.items()}
    for k, t in enumerate(texts):
        at = np.cumsum([0] + [len(c.encode()) for c in t])
        place = 0
        for i, s in zip(ids[offs[k] : offs[k + 1]], starts[offs[k] : offs[k + 1]]):
            assert s == np.searchsorted(at, place, "right") - 1
            place += len(inverse[int(i)])
        assert place == len(t.encode())
    long = b"abcde" * 20_000
    assert b"".join(inverse[i] for i in tokens.merge_pairs(long, enc.ranks)) == long
