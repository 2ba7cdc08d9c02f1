"""Joins and numbering that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

# A key is hot when it holds more than 1/HOT_KEYS of the rows, so there are fewer than
# HOT_KEYS hot keys whatever the data, and the table of hot keys is safe to broadcast.
HOT_KEYS = 1000


def hot_keys(key_rows: DataFrame, key: str, rows: str, total: int | None = None) -> DataFrame:
    """Keys that hold more than 1/HOT_KEYS of all rows; fewer than HOT_KEYS by counting.

    `total` is the number of all rows where it is known.
    """
    bound = key_rows.agg(F.sum(rows)).scalar() if total is None else F.lit(total)
    return key_rows.filter(F.col(rows) * HOT_KEYS > bound).select(key, F.lit(True).alias("_hot"))


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: str,
    hot: DataFrame | None = None,
    spread: int = 64,
) -> DataFrame:
    """Inner join of `facts` to `lookup`, which has one row per key.

    Rows of a hot key go to `spread` tasks by a hash of `spread_by`, and the lookup row of
    a hot key is copied to each of them. Other keys join once. `hot` comes from `hot_keys`;
    without it the facts are counted per key.
    """
    if hot is None:
        hot = hot_keys(facts.groupBy(key).agg(F.count(F.lit(1)).alias("rows")), key, "rows")
    hot = F.broadcast(hot)
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread_by), F.lit(spread)).cast("int")).otherwise(0)
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(F.lit(0)))
    left = facts.join(hot, key, "left").withColumn("_salt", salt).drop("_hot")
    right = lookup.join(hot, key, "left").withColumn("_salt", F.explode(salts)).drop("_hot")
    return left.join(right, [key, "_salt"]).drop("_salt")


def running_number(
    df: DataFrame, keys: list[str], order: list[Column | str], name: str, total: str | None = None
) -> DataFrame:
    """Number the rows of each key from 1 in the given order, which must be total.

    `total` names a column to add with the number of rows of the key.

    A window per key would sort all rows of a key in one task. Here one sort by key and
    order splits even a single key over all tasks; the rows before a task's share are
    then added from counts per (task, key). The sorted rows are checkpointed so that
    both uses see the same split, also after an executor is lost.
    """
    task, row = F.shiftright("_at", 33), F.col("_at")
    placed = (
        df.orderBy(*keys, *order)
        .withColumn("_at", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_task", task)
    )
    here = [*keys, "_task"]
    counts = placed.groupBy(*here).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    tasks = W.partitionBy(*keys)  # of one key, or of all: a row per task of the sort
    earlier = tasks.orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    base = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    if total is not None:
        base = base.withColumn(total, F.sum("_rows").over(tasks))
    base = base.drop("_rows")
    if not keys:
        base = F.broadcast(base)  # one row per task of the sort
    numbered = placed.join(base, here) if not keys else _null_safe_join(placed, base, here)
    return numbered.withColumn(name, row - F.col("_first") + 1 + F.col("_before")).drop(
        "_at", "_task", "_first", "_before"
    )


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    match = F.lit(True)
    for k in keys:
        match = match & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, match).drop(*[f"_r_{k}" for k in keys])
