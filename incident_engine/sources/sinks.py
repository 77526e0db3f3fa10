"""Writers. Every writer replaces what is at the target path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, *partition_by: str) -> None:
    """Parquet directory (K1)."""
    df.write.mode("overwrite").parquet(path, partitionBy=list(partition_by) or None)


def replace_partitions(df: DataFrame, path: str, *partition_by: str) -> None:
    """Replace the partitions that ``df`` has rows of in a partitioned parquet directory, no others (K1).

    Rows are dealt by partition value into files of even size, also where one value has most rows.
    """
    even = df.hint("rebalance", *(F.col(c) for c in partition_by))
    even.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path, partitionBy=list(partition_by))


# Values keep their outer blanks, and quotes inside quoted fields are doubled.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, path: str, single_file_order: list[str | Column] | None = None) -> None:
    """CSV directory with a header (K2).

    By default each partition becomes a part file, in the order of a sorted frame. Short results
    may give ``single_file_order``: they are gathered into one file sorted by these keys, after
    the work before has run on all tasks. Never use it for row-level data.
    """
    if single_file_order is not None:
        df = df.repartition(1).sortWithinPartitions(*single_file_order)
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def export_report(df: DataFrame, path: str, order: list[str | Column]) -> bool:
    """Write a filtered result as one CSV file unless it is empty; tells whether it did (K3)."""
    if df.isEmpty():
        return False
    write_csv(df, path, order)
    return True


def json_rows(df: DataFrame, as_text: bool = False) -> DataFrame:
    """One JSON object per row, nulls included; ``as_text`` turns all values to strings (K4, G1)."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    if as_text:
        columns = [column.cast("string").alias(c) for column, c in zip(columns, df.columns)]
    return df.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("json"))


def write_json(df: DataFrame, path: str) -> None:
    """Directory of JSON lines (K4)."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_bundle(path: str, members: Mapping[str, DataFrame]) -> None:
    """One JSON object whose members are the rows of short result tables."""
    spark = next(iter(members.values())).sparkSession
    columns = [
        df.agg(F.collect_list(F.struct(*(F.col(f"`{c}`") for c in df.columns)))).scalar().alias(name)
        for name, df in members.items()
    ]
    write_json(spark.range(0, 1, 1, 1).select(*columns), path)
