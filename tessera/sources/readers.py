"""Scans: JSON lines, two-column CSV, point files, chunk folders, stop words, pair models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


CORRUPT = ("_corrupt_record", StringType())
REVIEW = _struct(
    ("user_id", StringType()),
    ("business_id", StringType()),
    ("stars", DoubleType()),
    ("date", StringType()),
    ("text", StringType()),
    CORRUPT,
)
BUSINESS = _struct(
    ("business_id", StringType()),
    ("categories", StringType()),
    ("stars", DoubleType()),
    ("review_count", LongType()),
    ("is_open", IntegerType()),
    CORRUPT,
)
USER = _struct(
    ("user_id", StringType()),
    ("fans", LongType()),
    ("review_count", LongType()),
    ("average_stars", DoubleType()),
    CORRUPT,
)
PAIR_MODEL = _struct(("b1", StringType()), ("b2", StringType()), ("sim", DoubleType()), CORRUPT)
INTERACTION = _struct(("user_id", StringType()), ("business_id", StringType()))


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Typed JSON lines; lines that do not parse keep their text in _corrupt_record."""
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    return read_json_lines(spark, path, REVIEW).withColumn(
        "date", F.to_date(F.substring("date", 1, 10))
    )


def read_business(spark: SparkSession, path: str) -> DataFrame:
    return read_json_lines(spark, path, BUSINESS)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return read_json_lines(spark, path, USER)


def read_interactions(spark: SparkSession, path: str) -> DataFrame:
    """user_id,business_id CSV with a header line."""
    return spark.read.schema(INTERACTION).option("header", True).csv(path)


def _points(lines: DataFrame) -> DataFrame:
    parts = F.split("value", ",")
    return lines.where(F.trim("value") != "").select(
        parts[0].alias("point_id"),
        F.transform(F.slice(parts, 2, F.size(parts) - 1), lambda x: x.cast("double")).alias(
            "features"
        ),
    )


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Headerless lines 'id,f1,...,fd' as (point_id, features)."""
    return _points(spark.read.text(path))


def stream_points(spark: SparkSession, path: str) -> DataFrame:
    """The same lines as a stream that takes one file per micro-batch."""
    reader: DataStreamReader = spark.readStream.format("text").option("maxFilesPerTrigger", 1)
    return _points(reader.load(path))


def chunk_paths(spark: SparkSession, folder: str) -> list[str]:
    """What makes up the rounds of a chunk folder, in name order: the files in it, or where it
    has folders, each of these. Files are listed, not read, and one name per round comes back."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    parent = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    direct = parent.endswith(folder.split("://")[-1].rstrip("/"))
    rounds = files.select(F.when(direct, F.col("path")).otherwise(parent).alias("round"))
    return sorted(r["round"] for r in rounds.distinct().collect())


def read_chunks(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The points of each round, in the order of the rounds' names."""
    return [read_points(spark, p) for p in chunk_paths(spark, folder)]


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """One word per line; the empty string is always a stop word."""
    listed = spark.read.text(path).select(F.rtrim("value").alias("word"))
    return listed.union(spark.createDataFrame([("",)], "word string")).distinct()


def read_pair_model(spark: SparkSession, path: str) -> DataFrame:
    m = read_json_lines(spark, path, PAIR_MODEL)
    return m.select(
        F.least("b1", "b2").alias("b1"), F.greatest("b1", "b2").alias("b2"), "sim"
    ).distinct()
