"""Command line: the packaged rows of one document, by file name."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from quernstone.functions.config import Settings, load_env_file
from quernstone.plans.pipeline import run_pipeline
from quernstone.sources.sinks import write_json_array
from quernstone.sources.tables import find_document, table


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quernstone")
    parser.add_argument("--filename", required=True)
    parser.add_argument("--json-out", default="-")
    parser.add_argument("--tables", default=".", help="folder of the tables source_docs and chunks")
    args = parser.parse_args(argv)
    load_env_file(".env")
    spark = SparkSession.builder.appName("quernstone").getOrCreate()
    found = find_document(table(spark, args.tables, "source_docs"), args.filename).collect()  # at most one row
    if not found:
        raise SystemExit(f"no document is named {args.filename}")
    chunks = table(spark, args.tables, "chunks")
    write_json_array(run_pipeline(chunks.where(chunks["document_id"] == found[0][0]), Settings.from_env()), args.json_out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
