"""Readers and writers of JSON lines, documents, partitioned datasets and dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_jsonl(spark: SparkSession, path: str, schema: StructType, strict: bool = False) -> DataFrame:
    """JSON lines; bad lines are dropped, or fail the load if ``strict``.  Blank lines are
    never rows.  The schema is stated, so no pass infers it."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def read_with_rejects(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected lines) of JSON lines, from one scan of the text."""
    full = StructType([*schema.fields, StructField("_bad", StringType())])
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = spark.read.text(path).filter(F.trim("value") != "").select("value", parsed.alias("r"))
    return rows.filter("r._bad is null").select("r.*").drop("_bad"), rows.filter("r._bad is not null").select(F.lit("parse").alias("stage"), F.col("value").alias("payload"))


def read_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Whole-file JSON documents: the rows of a ``samples`` array, or the document itself."""
    samples = StructType([*schema.fields, StructField("samples", _array(schema))])
    rows = spark.read.schema(samples).option("multiLine", True).json(path)
    many = rows.filter("samples is not null").select(F.explode("samples").alias("s")).select("s.*")
    return many.unionByName(rows.filter("samples is null").drop("samples"))


def _array(schema: StructType):
    from pyspark.sql.types import ArrayType

    return ArrayType(schema)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines in UTF-8; characters beyond ASCII stay as they are."""
    df.write.mode(mode).json(path)


def write_by_date(df: DataFrame, path: str, at: str) -> None:
    """``year=/month=/day=`` folders with padded months and days, one writer per day.

    Rows are gathered by day first, so a day is a few files and not one per task; AQE splits
    a day that is too large for one writer.
    """
    day = F.to_date(F.timestamp_seconds(at))
    parts = df.withColumns({"year": F.date_format(day, "yyyy"), "month": F.date_format(day, "MM"), "day": F.date_format(day, "dd")})
    parts.hint("rebalance", "year", "month", "day").write.mode("overwrite").partitionBy("year", "month", "day").json(path)


def dead_letters(df: DataFrame, problem: str, stage: str) -> DataFrame:
    """Rows with a problem, as (error_type, stage, payload) of the dead-letter sink."""
    bad = df.filter(F.col(problem).isNotNull())
    payload = F.to_json(F.struct(*[c for c in df.columns if c != problem]))
    return bad.select(F.col(problem).alias("error_type"), F.lit(stage).alias("stage"), payload.alias("payload"))


def file_counts(df: DataFrame) -> DataFrame:
    """Rows of each file that was read, by name."""
    return df.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
