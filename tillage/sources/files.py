"""JSON-lines, CSV and summary files."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType, check: bool = True) -> DataFrame:
    """Rows of JSON-lines files; blank lines are skipped, a missing file fails.

    A malformed line raises ValueError with its file and line number. That takes a scan before the rows are read; without ``check`` such a line
    is a row of nulls. Nothing is cached.
    """
    given = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    bad = "_corrupt_record"
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    if check:
        checked = T.StructType([*given.fields, T.StructField(bad, T.StringType())])
        faults = lines.where(F.btrim("value") != "").select("value", "file", "start", "at", F.from_json("value", checked, {"columnNameOfCorruptRecord": bad})[bad].alias(bad)).where(F.col(bad).isNotNull())
        first = faults.orderBy("file", "start", "at").select("value", "file", "start", "at").first()
        if first:
            raise ValueError(f"Invalid JSONL at {first['file']}:{_line_number(lines, first)}: {first['value'][:200]}")
    return lines.where(F.btrim("value") != "").select(F.from_json("value", given).alias("r")).select("r.*")


def _line_number(lines: DataFrame, line: Row) -> int:
    """The number of a line in its file, from 1: the lines of the file's splits before its own, and its place there.

    A split's lines have consecutive numbers in their task, so a count and the smallest number of each split are enough.
    """
    splits = lines.where(F.col("file") == line["file"]).groupBy("start").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = splits.agg(F.sum(F.when(F.col("start") < line["start"], F.col("n")).otherwise(0)), F.max(F.when(F.col("start") == line["start"], F.col("first")))).first()
    return before[0] + line["at"] - before[1] + 1


def _sorted_type(kind: T.DataType, c: F.Column) -> F.Column:
    """The value with the fields of every struct in the order of their names."""
    if isinstance(kind, T.StructType):
        made = F.struct(*[_sorted_type(f.dataType, c[f.name]).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)])
        return F.when(c.isNull(), None).otherwise(made)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return F.transform(c, lambda x: _sorted_type(kind.elementType, x))
    return c


def write_jsonl(df: DataFrame, path: str, sort_keys: bool = False, single: bool = False) -> None:
    """UTF-8 JSON lines with nulls kept; keys in column order, or sorted at every level."""
    out = df.select(*[_sorted_type(df.schema[c].dataType, F.col(c)).alias(c) for c in sorted(df.columns)]) if sort_keys else df
    (out.coalesce(1) if single else out).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with a byte-order mark, a header and CRLF line ends; the mark goes in front of the first column's name."""
    marked = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    (marked.coalesce(1) if single else marked).write.mode("overwrite").option("header", True).option("lineSep", "\r\n").option("escape", '"').option("emptyValue", "").csv(path)


def summary_json(payload: dict[str, Any], sort_keys: bool = True) -> str:
    return json.dumps(payload, ensure_ascii=False, indent=2, sort_keys=sort_keys)


def write_summary(spark: SparkSession, payload: dict[str, Any], path: str, sort_keys: bool = True) -> None:
    """A small JSON document, through Spark's writer so that any store works."""
    spark.createDataFrame([(summary_json(payload, sort_keys),)], "value string").coalesce(1).write.mode("overwrite").text(path)
