"""Writing results, and a side table of decisions that spares repeated calls."""

from __future__ import annotations

import json
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, one file per partition: for results of any size."""
    df.write.mode("overwrite").json(path)


def write_json_array(df: DataFrame, path: str) -> None:
    """One JSON array, indented, to a file or, for "-" or nothing, to standard output: for the rows of one document."""
    rows = [json.loads(r[0]) for r in df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator()]
    text = json.dumps(rows, ensure_ascii=False, indent=2)
    if path.strip() in ("", "-"):
        sys.stdout.write(text + "\n")
    else:
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)


def with_cached(rows: DataFrame, cache: DataFrame, key: str, decide, ttl_seconds: int = 86_400, now: str = "current_timestamp()") -> tuple[DataFrame, DataFrame]:
    """(rows with column decision, new cache rows): cached decisions by key, and decide(distinct missing keys) for the rest.

    cache: (key, decision, decided_at); entries older than the time to live don't count.
    """
    fresh = cache.where(F.expr(f"decided_at >= {now} - make_dt_interval(0, 0, 0, {ttl_seconds})")).select(F.col("key").alias("_key"), F.col("decision").alias("_hit"))
    missing = rows.select(F.col(key).alias("_key")).distinct().join(fresh, "_key", "left_anti")
    made = decide(missing.withColumnRenamed("_key", "key"))
    known = fresh.select("_key", "_hit").unionByName(made.select(F.col("key").alias("_key"), F.col("decision").alias("_hit")))
    return rows.join(known, rows[key] == known["_key"], "left").withColumnRenamed("_hit", "decision").drop("_key"), made.withColumn("decided_at", F.expr(now))
