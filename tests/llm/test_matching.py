import itertools
import random
import re
import unicodedata

from quernstone.llm import format_copies, lookalike, near_dup, site_lines

WORD = re.compile(r"[^\W_]+")


def test_skeleton():
    base = "Điều 5: Phê duyệt ‑ file"
    assert lookalike.skeleton(unicodedata.normalize("NFD", base)) == lookalike.skeleton(base) == "Điều 5: Phê duyệt - file"
    for other in ("Đi​ều 5: Phê duyệt - ﬁle", "Ðiều 5： Ｐhê duyệt ‐ file", "Điều　5: Рhê duуệt - filе"):
        assert lookalike.skeleton(other) == lookalike.skeleton(base), other
    for other in ("điều 5: Phê duyệt - file", "Điều  5: Phê duyệt - file", "Điều 5. Phê duyệt - file", "Điều ⁵: Phê duyệt - file", "Điêu 5: Phê duyệt - file", "Điều 5: Phê duyệt - filé"):
        assert lookalike.skeleton(other) != lookalike.skeleton(base), other


def test_what_may_change_is_searched_by_ranges():
    import time

    changing, text = lookalike._tables()[2], "Điều khoản về đất ở đô thị " * 10_000
    plain = re.compile("[\u3000-\u9fff]")

    def seconds(pattern):
        return min((t := time.process_time(), pattern.search(text), time.process_time() - t)[2] for _ in range(3))

    assert not changing.search(text) and seconds(changing) < 25 * seconds(plain)
    for c in ("\U0001d400", "\U0001d7ff", "\U000e0000", "\U000e0fff", "\u200b", "\u0430", "\u0301", "\uff21"):
        assert changing.search(text + c) and not changing.search(text + "\U0001d455\U0001f600\U000e1000")


def test_lookalike_pairs(spark):
    rows = [("a", "Cổng Tây", 1), ("b", "Cổng Tаy", 1), ("c", "Cổng Tây", 1), ("d", "Cổng Tây", 1), ("e", "Cổng  Tây", 1), ("f", None, None), ("g", " ", 1), ("h", " ", 1), ("i", "", 1), ("b2", "Cổng Tаy", 1), ("n", "Cổng Tâ​y" + "!" * 100_000, 1)]
    df = spark.createDataFrame(rows, "id string, text string, form int")
    classes = lookalike.lookalike_classes(lookalike.lookalike_rows(df))
    got = {(r["id_a"], r["id_b"]) for r in lookalike.lookalike_pairs(classes).collect()}
    texts = {i: t for i, t, _ in rows if t and t.strip()}
    want = {(x, y) for x, y in itertools.combinations(sorted(texts), 2) if texts[x] != texts[y] and lookalike.skeleton(texts[x]) == lookalike.skeleton(texts[y])}
    assert got == want and ("a", "d") in got and ("a", "c") not in got
    named = {r["id"]: r["canonical_id"] for r in lookalike.canonical_members(classes).collect()}
    assert named["a"] == named["d"] == "a"
    assert lookalike.lookalike_pairs(lookalike.lookalike_classes(lookalike.lookalike_rows(df.limit(0)))).count() == 0


def test_content_key():
    k = format_copies.content_key
    assert k("Số tờ: 17; Địa bàn: xã Cẩm Sơn") == k("ĐỊA BÀN :xã  cẩm sơn | số tờ: 17") == k("Số tờ: 17\nĐịa bàn: xã Cẩm Sơn\n.")
    assert k("Số tờ: 17; Địa bàn: 5") != k("Số tờ: 5; Địa bàn: 17")
    assert k("Kết quả, 12.5 ha") == k("KẾT QUẢ 12.5 HA!") != k("Kết quả 12,5 ha")
    assert k("Kết quả 12 5") == k("kết quả 125") != k("kết quả 12.5")
    assert k("a + b") != k("a b") and k("é") != k("e") and k(" \n.,") is None


def test_format_copies(spark):
    rng = random.Random(4)
    base = ["Một câu, có dấu.", "Số: 1; Tên: Hai", "Khác hẳn 3.5", "Khác hẳn 35", None, "  ", "..."]
    change = [lambda t: t, str.upper, lambda t: t.replace(" ", "  "), lambda t: t + "!", lambda t: "\n" + t]
    rows = []
    for i in range(300):
        t = rng.choice(base)
        rows.append((f"k{i:03}", rng.choice(["d", "e", None]), rng.choice([1, None]), rng.choice(change)(t) if t else t, "x"))
    df = spark.createDataFrame(rows, "id string, document_id string, page int, text string, _group string")
    groups = {}
    for i, d, p, t, _ in rows:
        if t and (k := format_copies.content_key(t)):
            groups.setdefault((d, p, k), []).append(i)
    want = {(min(v), x, len(v)) for v in groups.values() for x in v if x != min(v)}
    assert {tuple(r) for r in format_copies.format_copies(df).collect()} == want
    assert format_copies.format_copies(df.limit(0)).count() == 0


def test_site_lines(spark):
    line = "Bản quyền thuộc về cổng 12"
    chunks = [(f"c{i}", f"d{i % 10}", f"dòng riêng thứ {'abcdefghijklmnop'[i]}\n{line.upper() if i % 2 else line.replace('12', '7 ')}  \nngắn 1", "x") for i in range(10)] + [("n", "d0", None, "x"), ("o", "zz", line, "x"), ("p", None, line, "x")]
    docs = [(f"d{i}", 1 if i < 8 else 2, "a") for i in range(10)] + [("d0", 1, "again"), ("zz", None, "a")]
    c = spark.createDataFrame(chunks, "id string, document_id string, text string, _gone string")
    s = spark.createDataFrame(docs, "id string, site_id int, filename string")
    got = sorted((r["chunk_id"], r["line_no"], r["n_documents"]) for r in site_lines.repeated_lines(c, s).collect())
    assert got == [(f"c{i}", 1, 8) for i in range(8)]
    clean = {r["id"]: r["clean_text"] for r in site_lines.strip_repeated_lines(c.drop("_gone"), s).collect()}
    assert clean["c0"] == "dòng riêng thứ a\nngắn 1" and clean["c9"] == chunks[9][2] and clean["n"] is None and clean["o"] == line
    assert site_lines.repeated_lines(c, s, 9).count() == 0 and site_lines.repeated_lines(c.limit(0), s).count() == 0


def test_near_duplicates(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(60):
        own = rng.sample(words, rng.randint(8, 40))
        texts.append(" ".join(own))
        for _ in range(rng.randint(0, 3)):
            near = [w if rng.random() > 0.08 else rng.choice(words) for w in own]
            rng.shuffle(near)
            texts.append(" ".join(near))
    texts += [texts[0], texts[0].replace(" ", "  "), texts[0].replace("w", "ｗ", 1), texts[0] + ".", texts[0].upper(), "", None, "...", "!!"]
    rows = [(f"s{i:03}", t, 1) for i, t in enumerate(texts)]
    sets = {i: set(WORD.findall(t.lower())) for i, t, _ in rows if t}
    by = {i: t for i, t, _ in rows}
    want = set()
    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and len(x & y) >= 0.7 * len(x | y) - 1e-9 and "".join(by[a].split()) != "".join(by[b].split()) and lookalike.skeleton(by[a]) != lookalike.skeleton(by[b]):
            want.add((a, b))
    df = spark.createDataFrame(rows, "id string, text string, words int")
    got = {(r["id_a"], r["id_b"]) for r in near_dup.near_duplicates(df).collect()}
    assert got <= want and len(got) >= 0.98 * len(want) > 30
    sets_df = near_dup.word_sets(df).groupBy("set_id").agg({"words": "first"}).withColumnRenamed("first(words)", "words")
    whole = {(r["a"], r["b"]) for r in near_dup.similar_sets(sets_df).collect()}
    split = {(r["a"], r["b"]) for r in near_dup.similar_sets(sets_df, bucket=0).collect()}
    assert split <= whole and len(split) >= 0.98 * len(whole)
    assert near_dup.near_duplicates(df.limit(0)).count() == 0


def test_every_similar_pair_is_proposed(spark):
    """All pairs at the threshold and above, whatever the buckets; among them many of exactly the threshold."""
    rng = random.Random(5)
    sets = {}
    for _ in range(300):
        base = rng.sample(range(2000), 17)
        for _ in range(4):
            sets[len(sets)] = sorted({*rng.sample(base, 14), *rng.sample(range(2000, 2100), 3)})
    sets.update({len(sets) + k: list(range(5000, 5000 + k)) for k in range(1, 40)})
    want = {(a, b) for a, b in itertools.combinations(sets, 2) if len(x := set(sets[a]) & set(sets[b])) >= 0.7 * (len(sets[a]) + len(sets[b]) - len(x)) - 1e-9}
    mixed = lambda w: (w * 0x9E3779B97F4A7C15 + 0x1234567) % 2**64 - 2**63
    df = spark.createDataFrame([(i, sorted(map(mixed, w))) for i, w in sets.items()], "set_id bigint, words array<bigint>")
    for bucket in (0, 20, 2_000):
        assert {(r["a"], r["b"]) for r in near_dup.similar_sets(df, bucket=bucket).collect()} == want
    signed = near_dup.signatures(df).localCheckpoint()
    blocks = {(r["a"], r["b"]) for r in near_dup.proposed(signed, 0.7, bucket=5, block=7).collect()}
    assert want <= blocks == {(r["a"], r["b"]) for r in near_dup.proposed(signed, 0.7, bucket=5).collect()} and len(want) > 200


def test_sets_meet_only_where_their_first_common_word_allows_it(spark):
    """Sets of 20 words are similar from 17 common ones on, so their first common word is one of the first four of both."""
    import pyarrow as pa

    assert [int(near_dup.reach(20, at, 0.7)) for at in (0, 3, 4, 6)] == [28, 21, 18, 14]
    for at, want in ((3, 1), (4, 0)):
        table = pa.table({"set_id": [1, 2], "size": [20, 20], "reach": [int(near_dup.reach(20, at, 0.7))] * 2, "low": [0, 0], "high": [0, 0], "own": [0, 0], "x": [0, 0], "y": [0, 0]})
        assert near_dup.near_in_block(table, 0.7).num_rows == want
        rows = [(i, 20, 0, 0, [100 * i + k for k in range(at)] + [7]) for i in (1, 2)]
        signed = spark.createDataFrame(rows, "set_id bigint, size int, low bigint, high bigint, keys array<bigint>")
        assert [near_dup.proposed(signed, 0.7, bucket=bucket).count() for bucket in (0, 2_000)] == [want, want]


def test_estimate_is_near_the_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    for share in (0.5, 0.7, 0.9):
        a = rng.integers(0, 2**63, 400, dtype=np.uint64)
        b = a.copy()
        b[: int(400 * (1 - share) / (1 + share) * 1)] = rng.integers(0, 2**63, int(400 * (1 - share) / (1 + share)), dtype=np.uint64)
        true = len(set(a) & set(b)) / len(set(a) | set(b))
        bits = near_dup.packed_bits(near_dup.minima(np.concatenate([a, b]), np.array([0, len(a)])), np.array([len(a), len(b)]))
        assert abs(near_dup.estimate(bits[0].tolist(), bits[1].tolist()) - true) < near_dup.MARGIN


def test_letters_that_grow_in_lower_case_and_other_scripts(spark):
    df = spark.createDataFrame([("a", "d", 1, "İstanbul abc"), ("b", "d", 1, "i̇stanbul, ABC")], "id string, document_id string, page int, text string")
    assert [(r["kept_id"], r["copy_id"]) for r in format_copies.format_copies(df).collect()] == [("a", "b")]
    assert {lookalike.skeleton(x) for x in ("Hòa", "𝐇òa", "Ꮋòa", "Нòа")} == {"Hòa"} and lookalike.skeleton("ı") == "ı"


def test_short_documents_fill_patterns():
    import numpy as np

    from quernstone.llm import packing

    rng = np.random.default_rng(1)
    hist = {s: int(rng.integers(50, 400)) for s in range(20, 200)}
    groups = packing.pack_histogram(hist)
    held: dict[int, int] = {}
    for n, d in groups:
        assert sum(s * m for s, m in d.items()) <= packing.CAPACITY
        for s, m in d.items():
            held[s] = held.get(s, 0) + n * m
    assert held == hist and sum(n for n, _ in groups) == -(-sum(s * c for s, c in hist.items()) // packing.CAPACITY)
