import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quernstone.functions.text import lines
from quernstone.operators import finish, header, sentences, serving, similarity, structure
from quernstone.plans.pipeline import run_pipeline
from quernstone.sources import tables


def split_one(spark, text):
    df = spark.createDataFrame([("c", text)], "id string, text string")
    return [r["text"] for r in sentences.sentence_rows(df, keep=()).orderBy("sentence_index").collect()]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Điều 1. Phạm vi. Áp dụng từ 3.14 ngày…  Hết", ["Điều 1.", "Phạm vi.", "Áp dụng từ 3.14 ngày...", "Hết"]),
        ("a\r\n\r\nb  c", ["a", "b c"]),
        ("TP. HCM có 5 quận", ["TP.", "HCM có 5 quận"]),
        ("   ", []),
        ("ﬁrst…\n\n\nsecond", ["first...", "second"]),
        (None, []),
    ],
)
def test_split(spark, text, expected):
    assert split_one(spark, text) == expected


def test_complete(spark):
    cases = [("ngắn.", 0), ("Câu này đầy đủ.", 1), ("Theo Khoản 2: nội dung", 1), ("dở dang ... tiếp tục mà chưa hết nhé bạn", 0), ("một đoạn khá dài không có dấu câu nào", 1), ("đoạn vừa đủ thôi", 0), (None, 0)]
    df = spark.createDataFrame(cases, "text string, expected int")
    assert [r[0] for r in df.select(sentences.is_complete(F.col("text"))).collect()] == [c[1] for c in cases]


def test_classify_with_decider(spark):
    df = spark.createDataFrame([("a", "x y"), ("b", "X  y"), ("c", "x y"), ("d", "một đoạn khá dài không có dấu câu nào")], "id string, text string")
    asked = []

    def decide(rows):
        asked.extend(r["text"] for r in rows.collect())
        return rows.select("key", F.when(F.lower("text").startswith("x y"), 1).alias("decision"))

    got = {r["id"]: r["complete"] for r in sentences.classify(df, decide).collect()}
    assert got == {"a": 1, "b": 0, "c": 1, "d": 1} and len(asked) == 3


def test_quality(spark):
    cases = [("abc", False, 0.6), ("Hello world.", False, 0.95), ("Hello world.", True, 0.70), ("a#b@c^d~e", False, 0.94), ("x" * 99 + "#", False, 0.948), ("\u00e9" * 5, False, 0.95), ("e\u0301" * 5, False, 0.94), (None, None, 0.6)]
    df = spark.createDataFrame([c[:2] for c in cases], "text string, error boolean")
    for r, c in zip(df.select(finish.quality_score(F.col("text"), F.col("error"))).collect(), cases):
        assert r[0] == pytest.approx(c[2])


def test_header_strip(spark):
    text = "QUỐC HIỆU\nKhẩu hiệu\n---\nNội dung\x0bdòng 2"
    for removed, expected in [([0, 1, 2], "Nội dung\ndòng 2"), ([0, 2], text), ([], text), ([1, 2], text), ([0, 1, 2, 3, 4, 5], "")]:
        df = spark.createDataFrame([(text, removed)], "text string, removed array<int>")
        assert df.select(header.strip_prefix(F.col("text"), header.removable(F.col("removed")))).first()[0] == expected


def test_lines(spark):
    df = spark.createDataFrame([("a\r\nb\rc\x85d\u2028e\x1cf\n",), ("",), ("\n",), (None,)], "t string")
    assert [r[0] for r in df.select(lines(F.col("t"))).collect()] == [list("abcdef"), [], [""], None]


@pytest.mark.parametrize("spans, n, expected", [([(0, 4), (4, 9)], 12, [(0, 4), (4, 9), (9, 12)]), ([(2, 5), (4, 8)], 8, [(0, 2), (2, 5), (5, 8)]), ([(5, 3), (-1, 2), (0, 20)], 10, [(0, 10)]), ([], 3, [(0, 3)]), ([(0, 6), (1, 5)], 6, [(0, 6)])])
def test_span_repair(spark, spans, n, expected):
    rows = [("a", i, s, e, n) for i, (s, e) in enumerate(spans)] or [("a", None, None, None, n)]
    df = spark.createDataFrame(rows, "id string, i int, start int, end int, n int")
    assert sorted((r["start"], r["end"]) for r in sentences.repair_spans(df, "id").collect()) == expected


def test_flatten(spark):
    df = spark.createDataFrame([("d", i, t) for i, t in enumerate(["Gồm:", "a) một", "B) hai", "c)ba", "Hết."])], "document_id string, pos int, text string")
    got = [r["text"] for r in structure.flatten_lists(df).orderBy("pos", "ord").collect()]
    assert got == ["Gồm: a)một, b)hai, c)a", "Gồm:", "a) một", "B) hai", "c)ba", "Hết."]


def greedy_flat(texts):
    out, i = [], 0
    import re

    while i < len(texts):
        t = texts[i].strip()
        if t.endswith(":") and i + 1 < len(texts):
            j = i + 1
            while j < len(texts) and re.match(r"^([a-zA-Z])\)\s*", texts[j].strip()):
                j += 1
            if j - i - 1 >= 2:
                out.append(i)
                i = j
                continue
        i += 1
    return out


def test_flatten_like_a_greedy_walk(spark):
    rng = random.Random(5)
    docs = [[rng.choice(["x:", "a) y", "b) z", "c) w:", "plain", "d)q"]) for _ in range(rng.randint(0, 12))] for _ in range(300)]
    df = spark.createDataFrame([(d, i, t) for d, ts in enumerate(docs) for i, t in enumerate(ts)], "document_id int, pos int, text string")
    got = sorted((r["document_id"], r["pos"]) for r in structure.flatten_lists(df).where("is_flat").collect())
    assert got == [(d, i) for d, ts in enumerate(docs) for i in greedy_flat(ts)]


def greedy_stitch(rows, apart, max_len):
    out, i = [], 0
    import re

    while i < len(rows):
        t, flat = rows[i]
        k, cur, j = 1, t, i + 1
        while not flat and j < len(rows) and k < 3:
            nxt, nflat = rows[j]
            if nflat or re.search(r"[.!?…](['\"”’)]*)$", cur) or apart(nxt) or len(cur) + len(nxt) > max_len:
                break
            cur, k, j = cur + " " + nxt, k + 1, j + 1
        out.append((i, k, cur))
        i += k
    return out


def test_stitch_like_a_greedy_walk(spark):
    rng = random.Random(6)
    import re

    def apart(t):
        return t.isupper() and len(t) < 32 or bool(re.match(r"^(Chương|Điều|Mục|Section)\s+\d+", t, re.I)) or bool(re.match(r"^\d+[.)]", t)) or bool(re.match(r"^[a-zA-Z]\)\s+", t)) or len(t) < 8

    words = ["phần đầu của câu", "phần cuối kết thúc.", "ĐIỀU KHOẢN CHUNG", "điều 5 quy định", "1) mục nhỏ này", "ngắn", "nối tiếp đoạn treo dài", "b) khoản tiếp theo"]
    docs = [[(rng.choice(words), rng.random() < 0.1) for _ in range(rng.randint(0, 14))] for _ in range(300)]
    df = spark.createDataFrame([(d, i, t, f) for d, ts in enumerate(docs) for i, (t, f) in enumerate(ts)], "document_id int, pos int, text string, is_flat boolean")
    got = sorted((r["document_id"], r["pos"], r["merged"], r["text"]) for r in structure.stitch(df, max_len=45).collect())
    assert got == [(d, *x) for d, ts in enumerate(docs) for x in greedy_stitch(ts, apart, 45)]


def test_ops_and_flags(spark):
    df = spark.createDataFrame([(["Fix Bullets", "remove_header", "canonicalize_from_variants", "fix_bullets"],), (["Fallback"],), (None,), (["quota_fallback", "", None],)], "ops array<string>")
    assert [r[0] for r in df.select(finish.normalize_ops(F.col("ops"))).collect()] == [["fix_bullets", "remove_header"], ["fallback"], [], []]
    flags = spark.createDataFrame([({"error": True},), (None,)], "f map<string,boolean>")
    assert [dict(r[0]) for r in flags.select(finish.default_flags(F.col("f"))).collect()] == [{"continues": False, "error": True}, {"continues": False, "error": False}]


def test_dedupe_counts_null_pages_together(spark):
    df = spark.createDataFrame([("a", "d", None, 0, "x  y"), ("b", "d", None, 1, "x y"), ("c", "d", 1, 2, "x y"), ("e", None, None, 3, None), ("f", None, None, 4, "")], "id string, document_id string, page int, pos int, text string")
    assert sorted((r["id"], r["copies"]) for r in finish.dedupe(df).collect()) == [("a", 2), ("c", 1), ("e", 2)]


def test_chunk_scan_and_lookup(spark):
    df = spark.createDataFrame([("c", "d", None, 0), ("a", "d", 2, None), ("b", "d", 2, 5), ("e", "d", 1, 9), ("x", None, 1, 1)], "id string, document_id string, page int, offset int")
    assert {r["id"]: r["pos"] for r in tables.chunk_scan(df).collect()} == {"e": 0, "b": 1, "a": 2, "c": 3, "x": 0}
    docs = spark.createDataFrame([("2", "f.pdf", None), ("1", "f.pdf", None), ("0", "f.pdf", "g.pdf"), ("9", None, None)], "id string, filename string, meta_filename string")
    assert tables.find_document(docs, "f.pdf").collect()[0][0] == "1"
    assert tables.find_document(docs, "g.pdf").collect()[0][0] == "0"
    assert tables.find_document(docs, "none").count() == 0


def test_metadata(spark):
    cases = [('{"type": "table", "bbox": ["1", 2, 3.5, 4], "continues_flag": "false"}', "table", True, 1.0), ('{"type": "Table", "bbox": [1, 2, 3], "continues_flag": 0}', "text", False, None), ('{"type": 3, "continues_flag": ""}', "text", False, None), ("null", "text", None, None), ("", "text", None, None), (None, "text", None, None), ('{"continues_flag": []}', "text", False, None), ('{"continues_flag": {"a": 1}, "bbox": [1, "x", 3, 4]}', "text", True, None), ('{"continues_flag": null}', "text", None, None), ('{"continues_flag": true}', "text", True, None)]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "id int, metadata string")
    for r, c in zip(tables.decode_metadata(df).orderBy("id").collect(), cases):
        assert (r["chunk_type"], r["continues"], r["x0"]) == c[1:], c


def test_nearest_is_exact_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK", 7)
    rng = np.random.default_rng(1)
    v = rng.normal(size=(40, 5))
    v[11] = v[3]
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([("d" if i < 30 else "e", i if i < 30 else i - 30, v[i].tolist()) for i in range(40)], "document_id string, pos bigint, embedding array<double>")
    got = {(r["document_id"], r["i"], r["rank"]): r["j"] for r in similarity.nearest(df, 4).collect()}
    for doc, rows in (("d", v[:30]), ("e", v[30:])):
        s = rows @ rows.T
        for i in range(len(rows)):
            assert [got[doc, i, k + 1] for k in range(4)] == list(np.lexsort((np.arange(len(rows)), -s[i].round(12))))[:4]


def test_components(spark):
    rng = random.Random(3)
    n, pairs = 60, [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(i, i + 1) for i in range(40, 59)]
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    nodes = spark.createDataFrame([("d", i) for i in range(n)], "document_id string, pos bigint")
    edges = spark.createDataFrame([("d", a, b) for a, b in pairs], "document_id string, i bigint, j bigint")
    assert {r["pos"]: r["root"] for r in similarity.components(nodes, edges).collect()} == {i: find(i) for i in range(n)}


def test_absorb_and_short_variants(spark):
    edges = spark.createDataFrame([("d", 0, 2, 1), ("d", 1, 0, 1), ("d", 1, 3, 2), ("d", 2, 4, 1), ("d", 3, 1, 1), ("e", 5, 4, 2)], "document_id string, i bigint, j bigint, rank int")
    got = sorted(tuple(r) for r in similarity.greedy_absorb(edges).collect())
    # 0 takes 2; 1 takes 0 (earlier, not gone) and 3; 2 and 3 are gone
    assert got == [("d", 0, 1), ("d", 2, 0), ("d", 3, 1), ("e", 4, 5)]
    v = spark.createDataFrame([("g", "x" * 60, True), ("g", "y" * 29, False), ("g", "z" * 30, False), ("h", "k", True), ("h", None, False), ("i", "alone", False)], "content_id string, text string, is_canonical boolean")
    assert sorted(r["text"] for r in similarity.keep_long_variants(v).collect()) == ["alone", "k", "x" * 60, "z" * 30]


def test_errors(spark):
    cases = [(429, None, "RATE_LIMIT"), (None, "resource_exhausted", "RATE_LIMIT"), (503, None, "UNAVAILABLE"), (400, None, "BAD_REQUEST"), (404, None, "NOT_FOUND"), (500, None, "SERVER_ERROR"), (403, None, "CLIENT_ERROR"), (400, "UNAVAILABLE", "UNAVAILABLE"), (None, None, "UNKNOWN")]
    df = spark.createDataFrame([c[:2] for c in cases], "code int, status string")
    assert [r[0] for r in df.select(serving.error_class(F.col("code"), F.col("status"))).collect()] == [c[2] for c in cases] == [serving.classify(*c[:2]) for c in cases]


def test_pipeline_keeps_what_it_should(spark):
    rows = [("c1", "d", 1, 0, "Gồm:\n\na) một mục dài hơn.\n\nb) hai mục dài hơn.\n\nKết thúc ở đây."), ("c2", "d", 1, 50, "Kết thúc ở đây. Câu riêng lẻ."), ("c3", "e", None, None, None), ("c4", "e", None, None, "  "), ("c5", "e", None, None, "Chỉ một câu thôi.")]
    out = run_pipeline(spark.createDataFrame(rows, "id string, document_id string, page int, offset int, text string")).collect()
    texts = sorted(r["clean_text"] for r in out if r["document_id"] == "d")
    assert "Gồm: a)một mục dài hơn., b)hai mục dài hơn." in texts and texts.count("Kết thúc ở đây.") == 1
    assert [r["chunk_id"] for r in out if r["document_id"] == "e"] == ["c5#s0"]
    assert all(0.6 <= r["quality_score"] <= 0.95 and r["ops"] == [] for r in out)


def test_pipeline_of_nothing(spark):
    assert run_pipeline(spark.createDataFrame([], "id string, document_id string, page int, offset int, text string")).count() == 0


def test_pipeline_with_embedder(spark):
    rows = [("c1", "d", 1, 0, "Một câu dài đủ chữ. Một câu dài đủ chữ! Câu khác hẳn nội dung.")]

    def embed(df):
        return df.withColumn("embedding", F.when(F.col("text").startswith("Một"), F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0))))

    out = run_pipeline(spark.createDataFrame(rows, "id string, document_id string, page int, offset int, text string"), embed=embed).collect()
    assert sorted(r["clean_text"] for r in out) == ["Câu khác hẳn nội dung.", "Một câu dài đủ chữ."]


def test_split_rows_repairs_what_a_splitter_proposes(spark):
    from quernstone.operators.sentences import split_rows

    rows = spark.createDataFrame([("a", "Một hai. Ba bốn. Năm"), ("b", "Không ai. Đề xuất"), ("c", None)], "id string, text string")
    spans = spark.createDataFrame([("a", 0, 2, 8), ("a", 1, 8, 9), ("a", 2, 6, 40), ("a", 3, 5, 4)], "id string, i int, start int, end int")
    got = sorted((r["sentence_id"], r["text"]) for r in split_rows(rows, lambda asked: spans, keep=()).collect())
    assert got == [("a#s0", "Mộ"), ("a#s1", "t hai."), ("a#s3", "Ba bốn. Năm"), ("b#s0", "Không ai."), ("b#s1", "Đề xuất")]


def test_clean_texts_by_a_model(spark):
    from quernstone.operators.cleaning import REPLY, clean_texts

    rows = spark.createDataFrame([("1", "xin  chào", ["from_variant"]), ("2", "lạ", None), ("3", None, [])], "id string, text string, ops array<string>")

    def clean(asked):
        answer = F.to_json(F.struct(F.upper("text").alias("clean_text"), F.array(F.lit("normalize_space")).alias("ops"), F.struct(F.lit(True).alias("continues")).alias("flags")))
        reply = F.struct(F.lit(True).alias("answered"), F.lit(None).cast("string").alias("block_reason"), F.lit(1).alias("candidates"), F.lit("STOP").alias("finish_reason"), answer.alias("text"), F.lit(None).cast("array<string>").alias("parts"))
        return asked.where("text <> 'lạ'").select("key", reply.cast(REPLY).alias("reply"))

    got = {r["id"]: (r["text"], list(r["ops"]), r["clean_flags"], r["text_clean_quality"]) for r in clean_texts(rows, clean).collect()}
    assert got["1"] == ("XIN  CHÀO", ["from_variant", "normalize_space"], {"continues": True}, 0.9)
    assert got["2"] == ("lạ", ["fallback_passthrough"], {"error": True, "llm_mismatch": True}, 0.0)
    assert got["3"][0] == "" and got["3"][3] == 0.6


def test_timestamp_and_provenance_of_a_run(spark):
    import json
    import re

    from quernstone.plans.pipeline import run_pipeline

    chunks = spark.createDataFrame([("c1", "d", 1, 0, "Một câu dài hơn ba mươi ký tự ở đây. Câu sau cũng dài như vậy, không kém gì.")], "id string, document_id string, page int, offset int, text string")
    row = run_pipeline(chunks).orderBy("chunk_id").first()
    assert re.fullmatch(r"20\d\d-\d\d-\d\dT\d\d:\d\d:\d\dZ", row["timestamp"]) and run_pipeline(chunks, timestamp="2000-01-01T00:00:00Z").first()["timestamp"] == "2000-01-01T00:00:00Z"
    told = json.loads(row["source_linkage"]["metadata"])
    assert told["split_from_chunk"] == "c1" and told["sentence_index"] == 0 and told["complete"] == 1 and told["content_group_id"] == "cg-0"
