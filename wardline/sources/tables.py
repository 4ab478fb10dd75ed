"""Table readers and writers."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The 25 raw columns and their types, in file order.
RAW_COLUMNS = (
    ("Timestamp", "timestamp"),
    ("Source IP Address", "string"),
    ("Destination IP Address", "string"),
    ("Source Port", "int"),
    ("Destination Port", "int"),
    ("Protocol", "string"),
    ("Packet Length", "int"),
    ("Packet Type", "string"),
    ("Traffic Type", "string"),
    ("Payload Data", "string"),
    ("Malware Indicators", "string"),
    ("Anomaly Scores", "double"),
    ("Alerts/Warnings", "string"),
    ("Attack Type", "string"),
    ("Attack Signature", "string"),
    ("Action Taken", "string"),
    ("Severity Level", "string"),
    ("User Information", "string"),
    ("Device Information", "string"),
    ("Network Segment", "string"),
    ("Geo-location Data", "string"),
    ("Proxy Information", "string"),
    ("Firewall Logs", "string"),
    ("IDS/IPS Alerts", "string"),
    ("Log Source", "string"),
)


def raw_schema(as_text: bool = False) -> T.StructType:
    """Schema of the raw log; ``as_text`` keeps every column as written, for row validation."""
    return T.StructType(
        [
            T.StructField(name, T._parse_datatype_string("string" if as_text else kind), True)
            for name, kind in RAW_COLUMNS
        ]
    )


def _header(spark: SparkSession, path: str, **options) -> list[str]:
    return spark.read.options(header=True, **options).csv(path).columns


def read_raw_csv(spark: SparkSession, path: str, as_text: bool = False, *, multi_line: bool = False, corrupt: str | None = None) -> DataFrame:
    """Comma-separated raw log, its columns taken by the names in the header, in any order.

    Files of one read share their header; one with another header is an error, and so is a missing column.
    Quoted text may hold commas and quotes, and line breaks with ``multi_line``, which makes every file one
    task; without it files are split. ``corrupt`` names a column that keeps lines with unreadable cells.
    """
    kinds = {f.name: f for f in raw_schema(as_text)}
    names = _header(spark, path, escape='"', multiLine=multi_line)
    if missing := [n for n in kinds if n not in names]:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    fields = [kinds.get(n, T.StructField(n, T.StringType())) for n in names]
    reader = (
        spark.read.option("header", True).option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
    )
    if corrupt:
        fields.append(T.StructField(corrupt, T.StringType()))
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    wanted = [*kinds, *([corrupt] if corrupt else [])]
    return reader.schema(T.StructType(fields)).csv(path).select(*[F.col(f"`{n}`") for n in wanted])


def read_processed_csv(
    spark: SparkSession, path: str, schema: str | T.StructType, ts_cols: Sequence[str] = ("date", "date dd")
) -> DataFrame:
    """Pipe-separated table with a row index, which is dropped.

    ``schema`` lists all columns, the index first. Columns are found by the names in the header, in any order, and come in the order of
    the schema; columns that it does not list are left out, and a listed one that is not there is a ValueError. An index that has
    another name, or none, is the file's first column. Where a folder's files differ in their headers, reading fails. Time columns are
    read as text and converted.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    header = spark.read.option("header", True).option("sep", "|").csv(path).columns
    index, *fields = wanted.fields
    if missing := [f.name for f in fields if f.name not in header]:
        raise ValueError(f"columns {missing} are not in the header of {path}")
    kinds = {f.name: f.dataType for f in (fields if index.name not in header else wanted.fields)}
    read_as = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in header])
    # A nameless column is named by the reader, so its header can't be compared.
    named = not any(re.fullmatch(r"_c\d+", n) for n in header)
    table = spark.read.schema(read_as).option("header", True).option("sep", "|").option("enforceSchema", not named).csv(path)
    return table.select(*[F.col(f"`{f.name}`") for f in fields]).withColumns(
        {c: F.to_timestamp(F.col(f"`{c}`").cast("string")) for c in ts_cols if c in [f.name for f in fields]}
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def coerced(df: DataFrame) -> DataFrame:
    """Nested and binary columns as text, all other columns as they are."""
    plain = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[
            F.col(f"`{f.name}`")
            if isinstance(f.dataType, plain)
            else F.col(f"`{f.name}`").cast("string").alias(f.name)
            for f in df.schema.fields
        ]
    )


def write_parquet_coerced(
    df: DataFrame, path: str, mode: str = "overwrite", null_text: str | None = None
) -> None:
    """Write Parquet with non-plain columns as text; ``null_text`` stands in for missing text."""
    out = coerced(df)
    if null_text is not None:
        texts = [f.name for f in out.schema.fields if isinstance(f.dataType, T.StringType)]
        out = out.fillna(null_text, subset=texts)
    out.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",") -> None:
    (
        df.write.mode(mode)
        .option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def try_read_parquet(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None when nothing has been written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def checkpoint_table(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read the table at ``path``; when there is none, build it, write it and read it back."""
    found = try_read_parquet(spark, path)
    if found is None:
        build().write.mode("overwrite").parquet(path)
        found = spark.read.parquet(path)
    return found
