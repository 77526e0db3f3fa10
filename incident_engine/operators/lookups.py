"""Lookups in a table of any size (J2, J3): the size that is measured picks the join.

A dimension whose rows fit a stated bound goes to every task; a larger one is shuffled by its keys. Facts may
hold a few keys very often: keys with over one row in HOT_KEYS are at most HOT_KEYS keys, so their dimension
rows always fit the first way, and only facts of other keys are shuffled. A key that the dimension has twice
would multiply facts, so it is refused.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Dimensions up to this size in memory are sent to every task.
BROADCAST_BYTES = 32 << 20
#: A key is hot if more than one fact in this many has it.
HOT_KEYS = 200
#: What a row and a value of fixed size take at most, in bytes.
ROW_BYTES, VALUE_BYTES = 32, 16


class Size(NamedTuple):
    """Rows and bytes of a dimension, and the most rows that share a key."""

    rows: int
    bytes: int
    repeats: int


def _key_name(n: int) -> str:
    return f"__key{n}"


def measured(dim: DataFrame, keys: Sequence[str]) -> Size:
    """Size of a dimension by one aggregation; rows without a whole key never match and do not count as repeats."""
    sized = [f.name for f in dim.schema if not isinstance(f.dataType, (T.StringType, T.BinaryType))]
    texts = [c for c in dim.columns if c not in sized]
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in texts), F.lit(ROW_BYTES + VALUE_BYTES * len(dim.columns)))
    known = F.lit(True)
    for key in keys:
        known &= F.col(f"`{key}`").isNotNull()
    per_key = dim.groupBy(*(F.col(f"`{k}`") for k in keys)).agg(
        F.count(F.lit(1)).alias("__rows"), F.sum(width).alias("__bytes"), F.count_if(known).alias("__known")
    )
    row = per_key.agg(F.sum("__rows"), F.sum("__bytes"), F.max("__known")).first()
    return Size(*(int(v or 0) for v in row))


def hot_keys(facts: DataFrame, keys: Sequence[str], share: int = HOT_KEYS) -> DataFrame:
    """Keys that more than one row in `share` has: fewer than `share` keys, whatever the data."""
    counts = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n")).scalar()
    return counts.where(F.col("__n") * share > total).drop("__n")


def lookup_table(
    facts: DataFrame,
    dim: DataFrame,
    keys: Mapping[str, Column],
    defaults: Mapping[str, Any],
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add columns of a dimension table to facts.

    `keys` gives, for each key column of `dim`, what it must equal on the facts' side; `defaults` names the
    columns to add and their values where the key is not found (or null). Facts keep their rows and columns, of
    which the added ones must not be part. Every fact, also one without a key, gives exactly one row.
    """
    clash = sorted(set(defaults) & set(facts.columns))
    if clash:
        raise ValueError(f"facts have columns {clash} already")
    size = measured(dim, list(keys))
    if size.repeats > 1:
        raise ValueError(f"a key of {list(keys)} has {size.repeats} rows")
    names = [_key_name(n) for n in range(len(keys))]
    added = [f"__value{n}" for n in range(len(defaults))]
    table = dim.select(
        *(F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)),
        *(F.col(f"`{v}`").alias(n) for v, n in zip(defaults, added)),
        F.lit(True).alias("__found"),
    )
    keyed = facts.withColumns(dict(zip(names, keys.values())))
    if size.bytes <= broadcast_bytes:
        joined = keyed.join(F.broadcast(table), names, "left")
    else:
        hot = hot_keys(keyed, names).withColumn("__hot", F.lit(True))
        marked = keyed.join(F.broadcast(hot), names, "left")
        no_key = F.lit(False)
        for n in names:
            no_key |= F.col(n).isNull()
        near = F.coalesce("__hot", no_key)
        few = table.join(F.broadcast(hot.drop("__hot")), names, "left_semi")
        joined = marked.where(near).drop("__hot").join(F.broadcast(few), names, "left")
        joined = joined.unionByName(marked.where(~near).drop("__hot").join(table.hint("merge"), names, "left"))
    kept = [F.col(f"`{c}`") for c in facts.columns]
    found = [
        F.when(F.col("__found"), F.col(n)).otherwise(F.lit(default)).alias(v)
        for (v, default), n in zip(defaults.items(), added)
    ]
    return joined.select(*kept, *found)
