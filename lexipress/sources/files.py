"""File sources and sinks: JSON lines, delimited text, captured pages, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One JSON object a line; blank lines are skipped, broken ones are null rows."""
    rows = spark.read.text(path).where(F.trim("value") != "")
    return rows.select(F.from_json("value", schema).alias("row")).select("row.*")


def write_jsonl(df: DataFrame, path: str, compression: str = "none") -> None:
    df.write.mode("overwrite").option("compression", compression).option("ignoreNullFields", "false").json(path)


def read_delimited(spark: SparkSession, path: str, columns: list[str], sep: str = ";", rows: int | None = None) -> DataFrame:
    """Delimited text with a header, a byte-order mark or not, quoted line ends; nulls are empty texts."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    df = spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"').option("multiLine", True).schema(schema).csv(path).na.fill("")
    return df.limit(rows) if rows is not None else df


def write_delimited(df: DataFrame, path: str, sep: str = ";", compression: str = "gzip") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).option("quoteAll", True).option("escape", '"').option("compression", compression).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """A small report as one JSON file; the commit protocol puts it in place whole."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_bulk(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Rows as Parquet, by partition columns if given; only the partitions written are replaced."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def read_captured_pages(spark: SparkSession, path: str, item: str) -> DataFrame:
    """Items of captured vendor pages: a page is a JSON list, or a JSON text that holds one; ``page`` and ``position`` tell where from."""
    raw = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_name").alias("page"), "value")
    inner = F.coalesce(F.from_json(F.concat(F.lit('{"v":'), F.col("value"), F.lit("}")), "v string")["v"], F.col("value"))
    items = raw.select("page", F.posexplode(F.from_json(inner, f"array<struct<{item}>>")).alias("position", "row"))
    return items.select("page", "position", "row.*")


def with_file_goal(df: DataFrame) -> DataFrame:
    """``id_goal`` from the number in the name of the file a row comes from."""
    from ..functions.keys import goal_of_file

    return df.withColumn("id_goal", goal_of_file(F.col("_metadata.file_path")))
