"""Joins that hold when one key has a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Only a key with this many rows can slow down a task; smaller inputs join plainly.
HOT_ROWS = 2_000_000
# Entries a sketch keeps for each key that it may have to report.
TRACKED = 16
SALTS = 64


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> list[str]:
    """Keys of at least ``hot_rows`` rows, without a shuffle of the keys.

    There are at most rows / hot_rows such keys; the sketch reports as many, so what reaches
    the driver is one key for each ``hot_rows`` rows. It only decides how rows are spread,
    never which rows are in the result.
    """
    known = df.where(F.col(key).isNotNull())
    most = known.count() // hot_rows
    if not most:
        return []
    most = min(most, 50_000)
    tracked = min(1_000_000, max(10_000, TRACKED * most))
    top = known.agg(F.expr(f"approx_top_k(`{key}`, {most}, {tracked})").alias("top")).first()["top"]
    return [item["item"] for item in top or [] if item["count"] >= hot_rows]


def lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    spread_by: str = "seq",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Join ``left`` to a side with at most one row per key.

    Rows of hot keys are spread over SALTS tasks, and the one right row of each hot
    key is repeated as often. All other keys meet in an ordinary equi-join. Hot keys are
    looked for in a pass over ``left``, which should be a scan or a checkpoint;
    ``hot_rows=None`` says that it is known to be too small to have any.
    """
    hot = [] if hot_rows is None else hot_keys(left, key, hot_rows)
    if hot and how == "left":  # rows without a key would all meet at one
        missing = left.where(F.col(key).isNull())
        found = _salted(left.where(F.col(key).isNotNull()), right, key, how, spread_by, hot)
        return found.unionByName(missing, allowMissingColumns=True)
    if hot:
        return _salted(left, right, key, how, spread_by, hot)
    return left.join(right, key, how)


def _salted(
    left: DataFrame, right: DataFrame, key: str, how: str, spread_by: str, hot: list[str]
) -> DataFrame:

    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    none, all_salts = F.array(F.lit(0)), F.sequence(F.lit(0), F.lit(SALTS - 1))
    salted = left.withColumn(
        "_salt",
        F.when(is_hot, F.pmod(F.xxhash64(F.col(spread_by)), F.lit(SALTS)).cast("int")).otherwise(0),
    )
    repeated = right.withColumn("_salt", F.explode(F.when(is_hot, all_salts).otherwise(none)))
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")


def broadcast_if_small(df: DataFrame, most: int = 100_000) -> DataFrame:
    """Ask for a broadcast only when a bounded count shows that ``df`` is small."""
    if df.limit(most + 1).count() <= most:
        return F.broadcast(df)
    return df


def numbered(df: DataFrame, key: str, seq: str, width: int, name: str = "nth") -> DataFrame:
    """Number the rows of each key by ``seq`` without one task per key.

    Rows are numbered inside (key, range of seq) pieces. Each piece then adds the
    size of the earlier pieces of its key; only piece sizes meet in one window.
    """
    from pyspark.sql import Window

    pieces = df.withColumn("_piece", F.floor(F.col(seq) / F.lit(width)))
    inside = F.row_number().over(Window.partitionBy(key, "_piece").orderBy(seq))
    earlier = Window.partitionBy(key).orderBy("_piece").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = (
        pieces.groupBy(key, "_piece")
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .drop("_size")
    )
    return (
        pieces.withColumn("_inside", inside)
        .join(sizes, [key, "_piece"])
        .withColumn(name, (F.col("_before") + F.col("_inside")).cast("bigint"))
        .drop("_piece", "_inside", "_before")
    )


def previous(
    df: DataFrame, key: str, seq: str, value: str, name: str, width: int | None
) -> DataFrame:
    """Add the last value that is not NULL among the earlier rows of the same key.

    The composition of steps that each set a state or leave it as it is: steps are composed
    inside (key, range of ``width`` seqs) pieces, and only the pieces' results meet in a window
    over the key. ``width=None`` says that no key has many rows.
    """
    from pyspark.sql import Window

    def before(*keys: str, order: str, column: str) -> Column:
        earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.last(column, ignorenulls=True).over(earlier)

    if width is None:
        return df.withColumn(name, before(key, order=seq, column=value))
    pieces = df.withColumn("_piece", F.floor(F.col(seq) / F.lit(width)))
    results = (
        pieces.where(F.col(value).isNotNull())
        .groupBy(key, "_piece")
        .agg(F.max_by(value, seq).alias("_result"))
    )
    # a piece may have no result of its own, so every piece is looked up among the results
    starts = pieces.select(key, "_piece").distinct().join(results, [key, "_piece"], "left")
    starts = starts.select(key, "_piece", before(key, order="_piece", column="_result").alias("_before"))
    return (
        pieces.withColumn("_inside", before(key, "_piece", order=seq, column=value))
        .join(starts, [key, "_piece"])
        .withColumn(name, F.coalesce("_inside", "_before"))
        .drop("_piece", "_inside", "_before")
    )


def distinct_items(
    df: DataFrame, group: str, item: Column, order: Column, name: str
) -> DataFrame:
    """Ordered distinct items per group, reduced per (group, item) before collecting."""
    return (
        df.groupBy(group, item.alias("_item"))
        .agg(F.min(order).alias("_order"))
        .groupBy(group)
        .agg(F.array_sort(F.collect_list(F.struct("_order", "_item"))).alias(name))
        .withColumn(name, F.transform(F.col(name), lambda e: e["_item"]))
    )
