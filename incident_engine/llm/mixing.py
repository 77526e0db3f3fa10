"""Mixing sources to target weights: a token budget handed down a tree of domains, languages and sources.

The budget of a node is dealt among its children by weight. A child takes at most what its leaves can
give (their tokens times the allowed epochs); what it leaves is dealt again among its siblings, and as a
node's own capacity is the sum of its children's, only a shortage that all siblings share reaches the
ancestors. Each leaf then gives whole epochs and a prefix of one more, in an order seeded per epoch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incident_engine.llm.batches import free_name

#: Most leaves whose plan is broadcast; beyond, it is joined by the leaf's columns.
BROADCAST_LEAVES = 20_000
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    """Words of a text; none in a null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def _deal(children: DataFrame, parent: list[str]) -> DataFrame:
    """Children with `share`: the parent's `budget` dealt by `weight`, no share over `capacity`."""
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = group.orderBy(F.col("capacity") / F.col("weight"), "node")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    active = children.where("weight > 0 AND capacity > 0")
    filled = (
        active.withColumn("w_rest", F.sum("weight").over(group) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("b_rest", F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0)))
        .withColumn("full", (F.col("capacity") * F.col("w_rest") <= F.col("weight") * F.col("b_rest")).cast("int"))
        .withColumn("full", F.min("full").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("rest", F.col("budget") - F.sum(F.when(F.col("full") == 1, F.col("capacity")).otherwise(0)).over(group))
        .withColumn("open", F.sum(F.when(F.col("full") == 0, F.col("weight")).otherwise(0)).over(group))
    )
    share = F.when(F.col("full") == 1, F.col("capacity")).otherwise(F.expr("rest * weight DIV open"))
    return filled.withColumn("share", share)


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], weights: Sequence[Mapping[str, int]], budget: Column, max_epochs: int) -> DataFrame:
    """Leaves (`levels` and `tokens`) with `share`, the tokens to take from each; empty leaves drop out.

    `weights` holds a mapping per level from a node's name to its weight, 1 where it names none. All
    arithmetic is on whole numbers; the parts of tokens that a division leaves are not dealt.
    """
    plan = leaves.withColumn("budget", budget.cast("long"))
    for depth, level in enumerate(levels):
        parent = list(levels[:depth])
        own = [*parent, level]
        table = weights[depth]
        weight = F.lit(1)
        if table:
            pairs = [F.lit(x) for item in table.items() for x in item]
            weight = F.coalesce(F.create_map(*pairs)[F.col(level)], F.lit(1))
        nodes = plan.groupBy(*own).agg(
            (F.sum("tokens") * max_epochs).alias("capacity"), F.first("budget").alias("budget")
        )
        nodes = nodes.withColumn("weight", weight.cast("long")).withColumn("node", F.col(level))
        dealt = _deal(nodes, parent).select(*own, F.col("share").alias("budget"))
        plan = plan.drop("budget").join(dealt, own)
    return plan.withColumnRenamed("budget", "share")


def _cut_keys(rows: DataFrame, leaf: str) -> DataFrame:
    """For each leaf the smallest order key that no longer fits in `rest`, found digit by digit.

    Sums per leaf and key prefix are small, and only the prefix in which the sum passes `rest` is looked
    into further, so that no leaf's rows are ever sorted in one task.
    """
    base, before = rows, F.lit(0)
    for digits in (2, 4, 32):
        sums = base.groupBy(leaf, F.substring("key", 1, digits).alias("prefix")).agg(
            F.sum("n").alias("n"), F.first("rest").alias("rest"), F.first(before).alias("before")
        )
        running = F.col("before") + F.sum("n").over(Window.partitionBy(leaf).orderBy("prefix"))
        over = sums.withColumn("upto", running).where("upto > rest")
        first = over.groupBy(leaf).agg(F.min("prefix").alias("prefix"), F.min_by(F.col("upto") - F.col("n"), "prefix").alias("before"))
        if digits < 32:
            base = rows.join(first, leaf).where(F.substring("key", 1, digits) == F.col("prefix")).drop("prefix")
            before = F.col("before")
    return first.select(leaf, F.col("prefix").alias("cut"))


def mix(
    docs: DataFrame,
    levels: Sequence[tuple[str, Column]],
    weights: Sequence[Mapping[str, int]],
    budget: tuple[int, int] | int,
    max_epochs: int = 1,
    seed: str = "0",
    doc_id: str = "doc_id",
    text: str = "text",
    epoch: str = "epoch",
) -> DataFrame:
    """The rows of `docs` that the mix takes, once per epoch, with the column `epoch` (from 0).

    `levels` are (name, expression) from the root's children to the leaves; a null counts as the empty
    name. `budget` is a number of words, or a fraction (numerator, denominator) of all words. A leaf
    orders its documents by md5 of seed, epoch and id, and takes the longest prefix within what is left
    after whole epochs. Rows with the same id stand or fall together; empty texts cost nothing and go
    with their place in the order; a leaf without any word is left out. Empty tables give no rows.
    """
    names = [f"level_{i}" for i in range(len(levels))]
    leaf_of = F.concat_ws("\x1f", *[F.coalesce(e.cast("string"), F.lit("")) for _, e in levels])
    leaf, copies, epoch = free_name(docs, "mix_leaf"), free_name(docs, "mix_copies"), free_name(docs, epoch)
    ident = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    narrow = docs.select(
        ident.alias("id"), leaf_of.alias("leaf"), *[F.coalesce(e.cast("string"), F.lit("")).alias(n) for n, (_, e) in zip(names, levels)], word_count(text).alias("n")
    ).checkpoint()
    leaves = narrow.groupBy("leaf", *names).agg(F.sum("n").alias("tokens"))
    total = leaves.agg(F.sum("tokens").alias("all"))
    if isinstance(budget, tuple):
        leaves = leaves.crossJoin(F.broadcast(total))  # one row
        words = F.expr(f"`all` * {int(budget[0])} DIV {int(budget[1])}")
    else:
        words = F.lit(int(budget))
    leaves = leaves.checkpoint()
    plan = (
        leaf_budgets(leaves, names, weights, words, max_epochs)
        .where("tokens > 0")
        .select("leaf", F.expr("share DIV tokens").alias("full"), F.expr("share % tokens").alias("rest"))
        .checkpoint()
    )
    small = plan.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES
    sized = F.broadcast if small else (lambda df: df)
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("full"), F.col("id")))
    keyed = narrow.join(sized(plan), "leaf").select("leaf", key.alias("key"), "n", "rest")
    cuts = plan.join(_cut_keys(keyed, "leaf"), "leaf", "left").checkpoint()
    mine = cuts.select(F.col("leaf").alias(leaf), F.struct("full", "cut").alias(copies))
    plan_full, cut = F.col(f"`{copies}`.full"), F.col(f"`{copies}`.cut")
    own = F.md5(F.concat_ws(":", F.lit(str(seed)), plan_full, ident))
    taken = plan_full + F.when(cut.isNull() | (own < cut), 1).otherwise(0)
    # a leaf whose budget is whole epochs has no cut only if nothing is over; its rest is then 0 words
    return (
        docs.withColumn(leaf, leaf_of)
        .join(sized(mine), leaf)
        .withColumn(copies, taken)
        .where(F.col(copies) > 0)
        .withColumn(epoch, F.explode(F.sequence(F.lit(0), (F.col(copies) - 1).cast("int"))))
        .select(*[f"`{c}`" for c in docs.columns], epoch)
    )


def statement(levels: Sequence[str], weights: Sequence[Mapping[str, int]], budget: tuple[int, int], max_epochs: int, seed: str, columns: str, source: str = "documents") -> str:
    """The same mix in SQL, with one running sum per leaf."""
    names = [f"level_{i}" for i in range(len(levels))]
    parts = ["mix_rows AS (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') AS id, "
             + ", ".join(f"coalesce(CAST({e} AS VARCHAR), '') AS {n}" for n, e in zip(names, levels))
             + f", coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS n FROM {source})",
             f"b_0 AS (SELECT {', '.join(names)}, CAST(sum(n) AS BIGINT) AS tokens, CAST(sum(sum(n)) OVER () AS BIGINT) * {budget[0]} // {budget[1]} AS budget FROM mix_rows GROUP BY ALL)"]
    for d in range(len(levels)):
        own, parent = ", ".join(names[: d + 1]), ", ".join(names[:d])
        by = f"PARTITION BY {parent}" if parent else ""
        weight = "CASE " + " ".join(f"WHEN {names[d]} = '{k}' THEN {w}" for k, w in weights[d].items()) + " ELSE 1 END" if weights[d] else "1"
        parts += [
            f"n_{d} AS (SELECT {own}, CAST(sum(tokens) AS BIGINT) * {max_epochs} AS capacity, CAST(any_value(budget) AS BIGINT) AS budget, CAST({weight} AS BIGINT) AS weight FROM b_{d} GROUP BY {own})",
            f"p_{d} AS (SELECT *, sum(weight) OVER ({by}) - coalesce(sum(weight) OVER ({by} ORDER BY capacity / weight, {names[d]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_rest, budget - coalesce(sum(capacity) OVER ({by} ORDER BY capacity / weight, {names[d]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b_rest FROM n_{d} WHERE weight > 0 AND capacity > 0)",
            f"f_{d} AS (SELECT *, min(CASE WHEN capacity * w_rest <= weight * b_rest THEN 1 ELSE 0 END) OVER ({by} ORDER BY capacity / weight, {names[d]} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM p_{d})",
            f"s_{d} AS (SELECT *, budget - sum(CASE WHEN filled = 1 THEN capacity ELSE 0 END) OVER ({by}) AS rest, sum(CASE WHEN filled = 0 THEN weight ELSE 0 END) OVER ({by}) AS open FROM f_{d})",
            f"b_{d + 1} AS (SELECT b.* EXCLUDE (budget), CAST(CASE WHEN s.filled = 1 THEN s.capacity ELSE s.rest * s.weight // s.open END AS BIGINT) AS budget FROM b_{d} b JOIN s_{d} s USING ({own}))",
        ]
    leaf = ", ".join(names)
    parts += [
        f"mix_plan AS (SELECT {leaf}, budget // tokens AS filled, budget % tokens AS rest FROM b_{len(levels)} WHERE tokens > 0)",
        f"mix_keys AS (SELECT r.*, p.filled, p.rest, md5(concat_ws(':', '{seed}', CAST(p.filled AS VARCHAR), r.id)) AS mix_key FROM mix_rows r JOIN mix_plan p USING ({leaf}))",
        f"mix_sums AS (SELECT *, sum(n) OVER (PARTITION BY {leaf} ORDER BY mix_key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM mix_keys)",
        f"mix_cuts AS (SELECT *, min(CASE WHEN upto > rest THEN mix_key END) OVER (PARTITION BY {leaf}) AS cut FROM mix_sums)",
        "mix_taken AS (SELECT *, filled + CASE WHEN cut IS NULL OR mix_key < cut THEN 1 ELSE 0 END AS copies FROM mix_cuts)",
    ]
    return "WITH " + ",\n".join(parts) + f"\nSELECT {columns}, CAST(unnest(range(copies)) AS INTEGER) AS epoch FROM mix_taken WHERE copies > 0"
