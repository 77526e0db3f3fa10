"""Small relational building blocks used by several operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incident_engine.functions.scoring import lookup
from incident_engine.scratch import cut_lineage


def incidents(weight: str | None = None) -> Column:
    """Number of incidents in a group.

    ``weight`` names a column that says how many incidents a row stands for, so that the same
    operator runs on single incidents and on pre-aggregated ones.
    """
    return F.count(F.lit(1)) if weight is None else F.sum(F.col(weight))


def total(value: Column, weight: str | None = None) -> Column:
    """Sum of ``value`` over the incidents in a group."""
    return F.sum(value) if weight is None else F.sum(value * F.col(weight))


def descending_then(value: str, *ties: str) -> list[Column]:
    """Sort keys: ``value`` from high to low, then the tie keys ascending."""
    return [F.desc(value), *(F.asc(t) for t in ties)]


def short_sorted(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Sort a result of a few rows (hours, weekdays, clusters) in one task.

    The aggregation before it still runs on all tasks; gathering its rows first spares the
    sampling job of a range-partitioned sort.
    """
    return df.repartition(1).orderBy(*keys)


def top_k(df: DataFrame, n: int, by: str, *ties: str) -> DataFrame:
    """The ``n`` rows with the highest ``by`` (L1-L5); planned as a per-task top-n."""
    return df.orderBy(*descending_then(by, *ties)).limit(n)


def ranked(df: DataFrame, by: str, *ties: str, name: str = "rank") -> DataFrame:
    """Number the rows of a short, already limited table from 1.

    The window spans the whole input in one task, so call it after :func:`top_k` only.
    """
    order = Window.orderBy(*descending_then(by, *ties))
    return df.withColumn(name, F.row_number().over(order))


def ranked_all(df: DataFrame, by: str, *ties: str, name: str = "rank") -> DataFrame:
    """Number the rows of a table of any size from 1 (W3); ``by`` and ``ties`` must order it fully.

    Rows are sorted by ranges and stored once, so that their places cannot change; a row's number
    is its place in its range and the sizes of the ranges before, of which there are as many as
    shuffle partitions.
    """
    keys = descending_then(by, *ties)
    ranges = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = cut_lineage(ranges.withColumn(name, F.monotonically_increasing_id()))
    part, place = F.shiftright(name, 33), F.col(name).bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    known = F.map_from_entries(F.collect_list(F.struct("part", "offset")))
    parts = F.sequence(F.lit(0).cast("bigint"), F.max("part"))
    table = offsets.agg(known.alias("known"), parts.alias("parts"))
    by_part = table.select(F.transform("parts", lambda p: F.element_at("known", p))).scalar()
    return placed.withColumn(name, F.get(by_part, part.cast("int")) + place + 1)


def largest(label: str, amount: Column) -> Column:
    """Label of the largest amount in a group; ties go to the first label, null labels lose."""
    key = F.when(F.col(label).isNotNull(), F.struct(-amount, F.col(label)))
    return F.min_by(F.col(label), key)


def map_column(
    df: DataFrame, column: str, mapping: Mapping[Any, Any], name: str, default: Any = None
) -> DataFrame:
    """Add ``name``: the value of ``column`` in a small mapping."""
    return df.withColumn(name, lookup(F.col(column), mapping, default))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values in order."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def sum_over_domain(
    df: DataFrame, key: str, domain: Sequence[Any], value: str, fill: int | None
) -> DataFrame:
    """Sum ``value`` for every key of a fixed domain; keys without rows get ``fill``.

    The domain joins the input as extra rows before the aggregation, so that one aggregation
    does both the completion and the sum. Keys outside the domain are left out.
    """
    key_type, value_type = df.schema[key].dataType, df.schema[value].dataType
    spine = (
        df.sparkSession.range(0, 1, 1, 1)
        .select(F.explode(F.array(*map(F.lit, domain)).cast(T.ArrayType(key_type))).alias(key))
        .withColumn(value, F.lit(fill).cast(value_type))
    )
    present = df.where(F.col(key).isin(*domain)).select(key, value)
    return present.unionByName(spine).groupBy(key).agg(F.sum(value).alias(value))


def union_all(*frames: DataFrame) -> DataFrame:
    """Concatenate frames by column name."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def coalesce_frames(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """``primary`` unless it is empty, else ``fallback``.

    One lazy plan: whether there is a first row is a scalar subquery that the rows of the fallback are
    filtered by. Both frames have the same columns.
    """
    is_empty = primary.limit(1).agg(F.count(F.lit(1)) == 0).scalar()
    return primary.unionByName(fallback.where(is_empty))


def product(df: DataFrame, domains: Mapping[str, Sequence[Any]]) -> DataFrame:
    """Each row of ``df`` with every combination of the values of further columns, which are literals."""
    for name, domain in domains.items():
        df = df.withColumn(name, F.explode(F.array(*map(F.lit, domain))))
    return df


def complete(df: DataFrame, domain: DataFrame, fill: Mapping[str, Any]) -> DataFrame:
    """A row for every key of a domain: those of ``df``, and filled ones for the missing keys.

    The columns of ``domain`` are the keys; it may hold a key more than once, and keys with a null are
    left out. Rows of ``df`` whose key is not in the domain are dropped, all others stay as they are.
    ``fill`` gives the values of further columns for missing keys; a column without one is null there.
    """
    keys = domain.columns
    spine = domain.na.drop().distinct()
    missing = spine.join(df.select(*keys), keys, "left_anti")
    filled = missing.select(
        *(
            F.col(f.name) if f.name in keys else F.lit(fill.get(f.name)).cast(f.dataType).alias(f.name)
            for f in df.schema
        )
    )
    return df.join(spine, keys, "left_semi").select(*df.columns).unionByName(filled)


def ranks_of(rows: DataFrame, table: DataFrame, n: int, by: str, *ties: str, name: str = "rank") -> DataFrame:
    """At most ``n`` rows of ``table`` with their ranks in it, from 1 (W3): ``by`` and ``ties`` order it fully.

    ``table`` is neither sorted nor numbered: one aggregation counts, for each of the few rows, those that
    come before it, and tasks send ``n`` counts each. The rows, which become literals of it, are read first;
    the result keeps their order.
    """
    few = rows.limit(n).collect()

    def before(row: Row) -> Column:
        ahead, level = F.col(by) > F.lit(row[by]), F.col(by) == F.lit(row[by])
        for tie in ties:
            ahead |= level & (F.col(tie) < F.lit(row[tie]))
            level &= F.col(tie) == F.lit(row[tie])
        return F.count_if(ahead) + 1

    found = T.StructType([*rows.schema.fields, T.StructField(name, T.LongType())])
    if not few:
        return table.sparkSession.createDataFrame([], found)
    fields = [f.name for f in rows.schema]
    counted = table.agg(*(before(row).alias(f"n{i}") for i, row in enumerate(few)))
    structs = (
        F.struct(*(F.lit(row[c]).cast(rows.schema[c].dataType).alias(c) for c in fields), F.col(f"n{i}").alias(name))
        for i, row in enumerate(few)
    )
    return counted.select(F.inline(F.array(*structs)))
