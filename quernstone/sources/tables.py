"""Reading documents and chunks, in reading order, with their metadata decoded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quernstone.runtime import spread

CHUNK_TYPES = ("text", "table", "list", "other")


#: Tables with texts, on which each row takes work.
TEXT_TABLES = ("chunks", "sentences", "documents")


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{directory}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def jdbc_table(spark: SparkSession, url: str, name: str, partition_column: str | None = None, lower: int = 0, upper: int = 0, partitions: int = 16, **options: str) -> DataFrame:
    """A relation of a database, read in parallel ranges of partition_column if one is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name).options(**options)
    if partition_column:
        reader = reader.option("partitionColumn", partition_column).option("lowerBound", lower).option("upperBound", upper).option("numPartitions", partitions)
    return reader.load()


def document_names(docs: DataFrame) -> DataFrame:
    """(name, document_id): of each file name its smallest id. The name in the metadata goes before the plain one."""
    return docs.select(F.coalesce("meta_filename", "filename").alias("name"), "id").where("name is not null").groupBy("name").agg(F.min("id").alias("document_id"))


def find_document(docs: DataFrame, filename: str) -> DataFrame:
    """(document_id) of a file name: at most one row."""
    return document_names(docs.where(F.coalesce("meta_filename", "filename") == filename)).select("document_id")


def chunk_scan(chunks: DataFrame, document_id: str | None = None) -> DataFrame:
    """Chunks with pos, their place in their document by page, offset and id, nulls last.

    A document is never sorted as a whole with its texts: chunks are ranked within their page, pages by their sizes.
    """
    if document_id is not None:
        chunks = chunks.where(F.col("document_id") == document_id)
    within = Window.partitionBy("document_id", "page").orderBy(F.asc_nulls_last("offset"), F.asc_nulls_last("id"))
    sizes = chunks.groupBy("document_id", "page").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.partitionBy("document_id").orderBy(F.asc_nulls_last("page"))) - F.col("_n")).select(F.col("document_id").alias("_d"), F.col("page").alias("_p"), "_before")
    ranked = chunks.withColumn("_rank", F.row_number().over(within))
    joined = ranked.join(before, ranked["document_id"].eqNullSafe(before["_d"]) & ranked["page"].eqNullSafe(before["_p"]))
    return joined.withColumn("pos", (F.col("_before") + F.col("_rank") - 1).cast("bigint")).drop("_d", "_p", "_before", "_rank")


def _kind(v: str, path: str) -> Column:
    return F.expr(f"schema_of_variant(variant_get({v}, '{path}'))")


def decode_metadata(chunks: DataFrame) -> DataFrame:
    """chunks with chunk_type, x0 y0 x1 y1 and continues, decoded from the JSON of metadata.

    An unknown or odd type is text; a box needs four numbers, or strings of them; continues is truth as a scripting
    language sees it: a string that isn't empty is true, whatever it says; missing and null stay null.
    """
    v = chunks.withColumn("_v", F.expr("try_parse_json(metadata)"))
    v = v.withColumn("_flag_kind", _kind("_v", "$.continues_flag")).withColumn("_type_kind", _kind("_v", "$.type"))
    flag = F.expr("try_variant_get(_v, '$.continues_flag', 'string')")
    number = F.expr("try_variant_get(_v, '$.continues_flag', 'double')")
    kind = F.col("_flag_kind")
    truth = (
        F.when(kind.isNull() | (kind == "VOID"), None)
        .when(kind == "BOOLEAN", flag == "true")
        .when(kind == "STRING", F.length(flag) > 0)
        .when(kind.startswith("ARRAY"), ~flag.eqNullSafe("[]"))
        .when(kind.startswith("OBJECT"), ~flag.eqNullSafe("{}"))
        .otherwise(number != 0)
    )
    name = F.expr("try_variant_get(_v, '$.type', 'string')")
    box = F.expr("try_variant_get(_v, '$.bbox', 'array<double>')")
    whole = F.when((F.size(box) == 4) & ~F.exists(box, lambda x: x.isNull()), box)
    v = v.withColumn("chunk_type", F.when((F.col("_type_kind") == "STRING") & name.isin(*CHUNK_TYPES), name).otherwise("text")).withColumn("continues", truth).withColumn("_box", whole)
    for i, c in enumerate(("x0", "y0", "x1", "y1")):
        v = v.withColumn(c, F.col("_box")[i])
    return v.drop("_v", "_flag_kind", "_type_kind", "_box")
