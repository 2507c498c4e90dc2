import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quernstone.functions.config import Settings, load_env_file
from quernstone.operators.serving import Limiter, TokenBucket, call_with_retry
from quernstone.plans import cli
from quernstone.sources.sinks import with_cached, write_json_array
from quernstone.streaming.incremental import sentence_stream


class Clock:
    def __init__(self):
        self.now = 0.0

    def __call__(self):
        return self.now

    def sleep(self, s):
        self.now += s


class Failure(Exception):
    def __init__(self, code, retry_seconds=None):
        self.code, self.status, self.retry_seconds = code, None, retry_seconds


def test_limiter():
    c = Clock()
    lim = Limiter(10, clock=c, sleep=c.sleep)
    for _ in range(3):
        lim.wait()
    assert c.now == pytest.approx(2 * 8.4)
    for _ in range(30):
        lim.penalize()
    assert lim.gap == pytest.approx(48)
    assert Limiter(10, tasks=4).gap == pytest.approx(4 * 8.4)


def test_bucket():
    c = Clock()
    b = TokenBucket(2, 1, c)
    assert [b.take(), b.take(), b.take()] == [True, True, False]
    c.now = 1
    assert b.take() and not b.take()
    b.penalize()
    assert b.capacity == 1


def run(answers, **kw):
    c = Clock()
    seen = []

    def call(model):
        seen.append(model)
        a = answers[min(len(seen), len(answers)) - 1]
        if isinstance(a, Exception):
            raise a
        return a

    out = call_with_retry(call, Settings(**kw), Limiter(6000, slowdown=1, clock=c, sleep=c.sleep), models=2, clock=c, sleep=c.sleep, jitter=lambda: 0.0)
    return out, seen, c.now


def test_retry():
    out, seen, _ = run([Failure(500), Failure(503), "yes"])
    assert out.ok and out.value == "yes" and out.attempts == 3 and out.errors == ["SERVER_ERROR", "UNAVAILABLE"]
    out, seen, _ = run([Failure(404), "never"])
    assert not out.ok and out.attempts == 1
    out, seen, _ = run([Failure(429, 1.0)])
    assert not out.ok and out.attempts == 6 and set(seen) == {0, 1}
    out, _, now = run([Failure(503)], retry_budget_sec=5.0)
    assert not out.ok and out.attempts < 6 and now <= 6
    with pytest.raises(KeyboardInterrupt):
        call_with_retry(lambda m: (_ for _ in ()).throw(KeyboardInterrupt()), Settings(), Limiter(1e9))


def test_settings(tmp_path):
    f = tmp_path / ".env"
    f.write_text("# x\nQUERNSTONE_RPM=abc\nQUERNSTONE_VERSION='v2'\n\nQUERNSTONE_FLATTEN_LISTS=off\n")
    env = load_env_file(str(f), {"QUERNSTONE_MAX_LEN": "100"})
    s = Settings.from_env(env)
    assert (s.rpm, s.version, s.flatten_lists, s.max_len) == (10, "v2", False, 100)


def test_cache(spark):
    now = datetime(2024, 1, 2)
    cache = spark.createDataFrame([("a", 1, now - timedelta(hours=1)), ("b", 1, now - timedelta(days=2))], "key string, decision int, decided_at timestamp")
    rows = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "k string")
    out, made = with_cached(rows, cache, "k", lambda m: m.withColumn("decision", F.lit(0)), now="timestamp'2024-01-02 00:00:00'")
    assert sorted((r["k"], r["decision"]) for r in out.collect()) == [("a", 1), ("a", 1), ("b", 0), ("c", 0)]
    assert sorted(r["key"] for r in made.collect()) == ["b", "c"]


def test_json_and_cli(spark, tmp_path, capsys):
    df = spark.createDataFrame([("é", None)], "a string, b string")
    write_json_array(df, str(tmp_path / "x.json"))
    assert json.loads((tmp_path / "x.json").read_text()) == [{"a": "é", "b": None}]
    spark.createDataFrame([("d1", "f.pdf", None, 1)], "id string, filename string, meta_filename string, site_id int").write.parquet(str(tmp_path / "source_docs.parquet"))
    spark.createDataFrame([("c1", "d1", 1, 0, "Câu thứ nhất. Câu thứ hai."), ("c2", "d2", 1, 0, "Khác.")], "id string, document_id string, page int, offset int, text string").write.parquet(str(tmp_path / "chunks.parquet"))
    assert cli.main(["--filename", "f.pdf", "--tables", str(tmp_path)]) == 0
    assert [x["clean_text"] for x in json.loads(capsys.readouterr().out)] in (["Câu thứ nhất.", "Câu thứ hai."], ["Câu thứ hai.", "Câu thứ nhất."])
    with pytest.raises(SystemExit):
        cli.main(["--filename", "none", "--tables", str(tmp_path)])


def test_stream(spark, tmp_path):
    schema = "id string, document_id string, page int, text string, arrived_at timestamp"
    at = datetime(2024, 1, 1)
    src = str(tmp_path / "in")
    spark.createDataFrame([("c1", "d", 1, "Một câu dài. Một câu dài.", at), ("c2", "d", 1, "Một câu dài. Câu mới hoàn toàn.", at)], schema).write.parquet(src)
    q = sentence_stream(spark.readStream.schema(schema).parquet(src)).writeStream.format("memory").queryName("heard").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r["text"] for r in spark.table("heard").collect()) == ["Câu mới hoàn toàn.", "Một câu dài."]


def test_batched_decider_retries_and_pads(spark):
    from quernstone.functions.config import Settings
    from quernstone.operators.serving import batched, limiter_of, policy_of, rpm_of

    settings = Settings(rpm=6_000_000, base_backoff_sec=0.0, jitter_sec=0.0, max_retries=1)

    def ask(model, rows):
        if any(r["text"] == "fail" for r in rows):
            raise RuntimeError("no")
        return [len(r["text"]) for r in rows][:2]  # an answer of two at most

    asked = spark.createDataFrame([(f"k{i}", "x" * i) for i in range(1, 4)], "key string, text string")
    got = {r["key"]: r["decision"] for r in batched(ask, settings, "classify", batch=3, tasks=1, sleep=lambda s: None)(asked).collect()}
    assert set(got) == {"k1", "k2", "k3"} and sum(v is None for v in got.values()) == 1 and all(v in (None, int(k[1])) for k, v in got.items())
    failed = spark.createDataFrame([("k", "fail")], "key string, text string")
    assert batched(ask, settings, "classify", batch=3, tasks=1, sleep=lambda s: None)(failed).first()["decision"] is None
    assert policy_of(settings, "header").retry_budget_sec == 120.0 and policy_of(settings, "text") is settings
    assert rpm_of(Settings(rpm=0, rpm_merge=7), "merge") == 7 and rpm_of(Settings(rpm=3), "merge") == 3 and limiter_of(Settings(rpm=30), "text").rpm == 30
