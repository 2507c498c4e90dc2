import pyarrow.parquet as pq
import pytest

from quernstone.llm.queries import oracle_sql, queries
from tests.compare import duck, same
from tests.conftest import SMALL

COLUMNS = {"p1_found": ["chunk_id", "end_pos"], "p2_found": ["chunk_id", "line_no"], "p3_found": ["tbl", "id_a", "id_b"], "p4_found": ["kept_id", "copy_id"], "p5_found": ["chunk_id", "line_no", "fault"], "p6_found": ["id_a", "id_b"], "p7_found": ["tbl", "rec_id"], "p8_ids": ["doc_id", "ids"], "p10_found": ["doc_id"]}


def texts(name: str, key: str = "id") -> dict:
    t = pq.read_table(f"{SMALL}/{name}.parquet", columns=[key, "text"])
    return dict(zip(t.column(0).to_pylist(), t.column(1).to_pylist()))


def rows(spark, name: str) -> list[tuple]:
    return [tuple(r) for r in queries()[name](spark, SMALL).collect()]


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_as_sql(spark, name):
    df = queries()[name](spark, SMALL)
    assert COLUMNS.get(name, df.columns) == df.columns
    same(df, duck(SMALL), oracle_sql()[name])


def test_found_columns(spark):
    for name in set(COLUMNS) - set(oracle_sql()):
        assert queries()[name](spark, SMALL).columns == COLUMNS[name]


def test_sentences_cover_the_chunks(spark):
    t = texts("chunks")
    sample = set(pq.read_table(f"{SMALL}/split_sample.parquet").column(0).to_pylist())
    ends: dict[str, list[int]] = {}
    for i, e in rows(spark, "p1_found"):
        ends.setdefault(i, []).append(e)
    assert set(ends) == {i for i in sample if t.get(i) and t[i].strip()}
    assert all(max(e) == len(t[i].rstrip()) and not t[i][x - 1].isspace() for i, e in ends.items() for x in e)
    units: dict[str, str] = {}
    for i, n, s, e, text in sorted(rows(spark, "p1_units")):
        assert t[i][s:e] == text
        units[i] = units.get(i, "") + text
    assert all("".join(units.get(i, "").split()) == "".join((x or "").split()) for i, x in t.items())


def test_faults_lie_in_the_texts(spark):
    t = texts("chunks")
    got = rows(spark, "p5_found")
    assert len(got) == len(set(got)) > 20 and {f for *_, f in got} == {"break", "misread", "running", "page_no"}
    assert all(0 <= n < len(t[i].split("\n")) for i, n, _ in got)
    repaired = dict(rows(spark, "p5_repaired"))
    assert set(repaired) == set(t) and all((repaired[i] is None) == (x is None) for i, x in t.items())


def test_cut_values_are_open(spark):
    t = {"chunks": texts("chunks"), "sentences": texts("sentences")}
    got = rows(spark, "p7_found")
    assert 3 < len(got) < 60 and len(got) == len(set(got)) and all(t[tbl][i].strip() for tbl, i in got)
    shares = rows(spark, "p7_site_share")
    assert all(n >= c >= 0 and abs(s - c / n) < 1e-5 for _, _, n, c, s in shares)


def test_packing_holds_every_token_once(spark):
    ids = {d: i for d, i in rows(spark, "p8_ids")}
    placed: dict[int, int] = {}
    held: dict[str, int] = {}
    for d, _, c, _, n in rows(spark, "p9_pack"):
        placed[d] = placed.get(d, 0) + n
        held[c] = held.get(c, 0) + n
    assert placed == {d: len(i) for d, i in ids.items() if i} and max(held.values()) <= 8192


def test_residue_and_the_rest(spark):
    t = texts("documents", "doc_id")
    found, kept, clean = {d for (d,) in rows(spark, "p10_found")}, {d for (d,) in rows(spark, "p10_kept")}, {d: (x, n) for d, x, n in rows(spark, "p10_cleaned")}
    assert found and not found & kept and found | kept == {d for d, x in t.items() if x is not None}
    assert set(clean) == set(t) and all((n > 0) == (d in found) for d, (x, n) in clean.items())
