"""File operations of a batch as layers that may each run side by side.

A batch's operations were decided one message after the other, but all contents are those of
its start. What counts in the end is, for every path, the last operation on it: either the
content of some path is put there, or nothing is left. A put may only happen once all puts that
read the old content of its path have; so each put has at most one follower, the put at the
path it reads. Chains of these give the layers, by jumps that double their reach. A ring of
puts, as a table of renames may have it, is cut at its smallest path, whose content is first
set aside under a temporary name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docintake.operators.skew import HOT_ROWS, lookup
from docintake.session import cut

ASIDE = ".aside"


def net_changes(actions: DataFrame) -> DataFrame:
    """Last operation on every path that one touches: ``path`` and the ``source`` put there.

    ``source`` is NULL where nothing is left. ``actions`` are rows of ``path_actions``.
    """
    done = actions.where("op IN ('move', 'remove')")
    written = done.where("op = 'move'").select(
        F.col("to_path").alias("path"), "seq", F.lit(1).alias("nth"), F.col("from_path").alias("source")
    )
    gone = done.select(
        F.col("from_path").alias("path"), "seq", F.lit(0).alias("nth"),
        F.lit(None).cast("string").alias("source"),
    )
    return (
        written.unionByName(gone)
        .groupBy("path")
        .agg(F.max(F.struct("seq", "nth", "source"))["source"].alias("source"))
    )


def _rings(follows: DataFrame, hot_rows: int | None) -> DataFrame:
    """The smallest ``path`` of every ring of ``follows`` (path, to)."""
    jumps = follows.select("path", "to", F.least("path", "to").alias("low"))
    state = None
    while True:
        jumps = cut(jumps)
        # once no path has a longer way to it, only rings are jumped to
        seen = jumps.agg(
            F.count(F.lit(1)), F.countDistinct("to"), F.bit_xor(F.xxhash64("path", "low"))
        ).first()
        if seen == state or not seen[0]:
            break
        state = seen
        further = jumps.select(
            F.col("path").alias("to"), F.col("to").alias("next"), F.col("low").alias("next_low")
        )
        jumps = lookup(jumps, further, "to", how="inner", spread_by="path", hot_rows=hot_rows).select(
            "path", F.col("next").alias("to"), F.least("low", "next_low").alias("low")
        )
    on_ring = jumps.select("to").distinct()
    return jumps.join(on_ring.withColumnRenamed("to", "path"), "path", "left_semi").select(
        F.col("low").alias("path")
    ).distinct()


def _ways(follows: DataFrame, hot_rows: int | None) -> DataFrame:
    """``path``, the last put of the chain it begins, and the number of steps to that one."""
    ways = cut(follows.select("path", F.col("to").alias("last"), F.lit(1).cast("bigint").alias("steps")))
    while True:
        further = ways.select(
            F.col("path").alias("last"), F.col("last").alias("next"), F.col("steps").alias("more")
        )
        longer = cut(lookup(ways, further, "last", spread_by="path", hot_rows=hot_rows))
        if longer.where("next IS NOT NULL").isEmpty():
            return ways
        ways = longer.select(
            "path", F.coalesce("next", "last").alias("last"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
        )


def layered_operations(changes: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """``layer, op, from_path, to_path``: operations that make changes at once, in layers from 0.

    ``changes`` says of each path which path's old content comes there (``path, source``; NULL:
    none), as :func:`net_changes` does of a batch. ``op`` is move, copy (the content is wanted again) or remove. Operations of one layer touch
    nothing that another one of it reads or writes, but that several may copy from one path.
    """
    changes = cut(changes)
    puts = changes.where("source IS NOT NULL AND source <> path").select("path", "source")
    readers = puts.select(F.col("source").alias("path"), F.col("path").alias("reader"))
    # the put at a reader's source follows the reader
    follows = cut(
        lookup(
            readers, puts.select("path", F.lit(True).alias("is_put")), "path", how="inner",
            spread_by="reader", hot_rows=hot_rows,
        ).select(F.col("reader").alias("path"), F.col("path").alias("to"))
    )
    aside = cut(_rings(follows, hot_rows).withColumn("is_aside", F.lit(True)))
    cut_off = aside.select(F.col("path").alias("to"))
    ways = _ways(follows.join(cut_off, "to", "left_anti"), hot_rows)
    # a put that no other follows is the last of its chain
    known = puts.join(ways, "path", "left").select(
        "path", "source", F.coalesce("last", "path").alias("last"),
        F.coalesce("steps", F.lit(0).cast("bigint")).alias("steps"),
    )
    longest = known.groupBy("last").agg(F.max("steps").alias("most"))
    placed = lookup(known, longest, "last", spread_by="path", hot_rows=hot_rows)
    placed = lookup(
        placed, aside.withColumnRenamed("path", "source"), "source", spread_by="path", hot_rows=hot_rows
    ).select(
        (F.col("most") - F.col("steps") + 1).alias("layer"),
        F.when(F.col("is_aside"), F.concat("source", F.lit(ASIDE))).otherwise(F.col("source")).alias("from_path"),
        F.col("path").alias("to_path"),
    )
    placed = cut(placed)
    wanted = placed.groupBy("from_path").agg(
        F.count(F.lit(1)).alias("n_readers"), F.max("layer").alias("last_read")
    )
    gone = changes.where("source IS NULL").select(F.col("path").alias("from_path"), F.lit(True).alias("is_gone"))
    # what is read by one put alone, and is not to stay, is moved
    stays = changes.where("source = path").select(F.col("path").alias("from_path"), F.lit(True).alias("stays"))
    ready = lookup(placed, wanted, "from_path", spread_by="to_path", hot_rows=hot_rows)
    ready = lookup(ready, stays, "from_path", spread_by="to_path", hot_rows=hot_rows)
    op = F.when((F.col("n_readers") == 1) & F.col("stays").isNull(), F.lit("move")).otherwise(F.lit("copy"))
    put = ready.select("layer", op.alias("op"), "from_path", "to_path")
    none = F.lit(None).cast("string").alias("to_path")
    set_aside = aside.select(
        F.lit(0).cast("bigint").alias("layer"), F.lit("move").alias("op"), F.col("path").alias("from_path"),
        F.concat("path", F.lit(ASIDE)).alias("to_path"),
    )
    left = gone.unionByName(
        aside.select(F.concat("path", F.lit(ASIDE)).alias("from_path"), F.lit(True).alias("is_gone"))
    ).join(wanted, "from_path", "left").where("n_readers IS NULL OR n_readers > 1")
    removed = left.select(
        F.coalesce(F.col("last_read") + 1, F.lit(0).cast("bigint")).alias("layer"),
        F.lit("remove").alias("op"), "from_path", none,
    )
    return put.unionByName(set_aside).unionByName(removed)
