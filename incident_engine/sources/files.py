"""Readers for raw incident files and for stored results."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incident_engine.constants import NA_TOKENS
from incident_engine.functions.text import null_if_na
from incident_engine.operators.cleaning import trim_headers, underscore_headers
from incident_engine.scratch import cut_lineage


def read_incidents_csv(
    spark: SparkSession,
    path: str | list[str],
    na_tokens: Iterable[str] | None = NA_TOKENS,
    underscore: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Raw incidents from CSV files with a header, every column as text.

    Columns go by their header names; files whose headers differ from each other fail instead
    of mixing columns. Types are never inferred, as that reads all data once more. Quotes
    inside quoted fields are doubled. ``multi_line`` allows line breaks inside quoted fields at
    the price of one task per file. ``na_tokens`` become null; pass ``None`` to keep them. Values
    that the folder names hold (``day=2026-01-05``) become typed columns, by which reads are pruned.
    """
    df = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    df = underscore_headers(df) if underscore else trim_headers(df)
    if na_tokens is None:
        return df
    tokens = tuple(na_tokens)
    return df.withColumns(
        {f.name: null_if_na(F.col(f"`{f.name}`"), tokens) for f in df.schema if f.dataType == T.StringType()}
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """All parts of a parquet directory."""
    return spark.read.parquet(path)


def read_result_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored CSV result, file or directory: all ``part-*.csv``, else all ``*.csv``.

    ``schema`` names the columns in file order. Fails if there is no CSV file.
    """
    for pattern in ("part-*.csv", "*.csv"):
        df = (
            spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", False)
            .option("escape", '"')
            .option("pathGlobFilter", pattern)
            .csv(path)
        )
        if df.inputFiles():
            return df
    raise FileNotFoundError(f"no CSV files at {path}")


def _as_text(schema: str) -> str:
    return ", ".join(f"`{f.name}` string" for f in T.StructType.fromDDL(schema).fields)


def read_result_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored CSV result with all columns as text; no rows if it does not exist."""
    text = _as_text(schema)
    try:
        return read_result_csv(spark, path, text)
    except FileNotFoundError:
        return spark.createDataFrame([], text)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], text)


def read_bundle_members(spark: SparkSession, path: str, members: Mapping[str, str]) -> dict[str, DataFrame]:
    """Tables of a JSON bundle by member name (S8, G1): an object whose members are arrays of rows.

    ``members`` gives the schema of each. The file, one document of bounded size, is parsed once for all of
    them and kept as one row of arrays. A member that is missing gives no rows.
    """
    rows = [T.StructField(m, T.ArrayType(T.StructType.fromDDL(s))) for m, s in members.items()]
    bundle = spark.read.schema(T.StructType(rows)).option("multiLine", True).json(path)
    parsed = bundle if len(members) == 1 else cut_lineage(bundle)
    return {m: parsed.select(F.inline(F.col(f"`{m}`"))) for m in members}


def read_bundle(spark: SparkSession, path: str, member: str, schema: str) -> DataFrame:
    """One table of a JSON bundle (S8, G1); see :func:`read_bundle_members`."""
    return read_bundle_members(spark, path, {member: schema})[member]
