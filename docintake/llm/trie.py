"""Prefix trie of conversations, rolled up by centroid decomposition.

A node is a distinct sequence of first turns (role, text); its parent is the sequence without
the last one, the root the empty sequence. Nodes are named by 128 bits, the exclusive or of
hashes of (place, turn), so a prefix costs no more than its last turn, its parent's name
follows from its own, and a long conversation is summed piece by piece.

Sums over subtrees: a component of the forest of parent edges is split at a centroid. What the
component has below it (itself included) is added up once, and the total is added to every
node from the centroid to the component's top. The centroid's subtrees and the part above are
components of their own, each with at most half the weight, and are split again, so that a
node takes part in about log2 of the nodes' splits however deep the trie is.

Components of at most ``LOCAL`` nodes are split to the end inside a task, by their number of
nodes. Larger ones are split by joins, all at once in each round: at the deepest node that more
than half of the component's ends (of conversations, and of paths where earlier centroids were cut
off) are below, or in the middle of a path. Which nodes are below it follows from the turns of
each node's first member, and so does the path above it.

Turns are ordered by turn (nulls first), then role and text; null roles and texts count as
empty. They are sorted by ranges, so that one conversation can be in many tasks. Rows without
a conv_id are no conversation's and are left out. Repeated rows are turns like others. Texts of
any length are hashed once and not carried further. An empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docintake.operators.skew import HOT_ROWS, broadcast_if_small, lookup
from docintake.session import cut

LOCAL = 1 << 15  # nodes
PIECE = 1 << 12  # turns of a conversation that are summed together
IDS = 1 << 12  # neighbouring conv_ids whose list is one string
HEADS = 3  # turns that a conversation can take over at most

ROOT = "0" * 32


def _node(a: Column, b: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, part, at`` and a turn's hashes ``a, b`` and ``words``, and the parts.

    Rows are sorted by ranges; ``part`` is a range and ``at`` a row's place in its conversation
    there, from 1. The parts are ``conv_id, part, n`` and ``before``, the turns in earlier ranges.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    )
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    turns = cut(
        rows.select(
            "conv_id",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("place"),
            F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint").alias("a"),
            F.conv(F.substring(digest, 16, 15), 16, 10).cast("bigint").alias("b"),
            F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
        )
    )
    parts = turns.groupBy("conv_id", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = cut(parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
    return turns, parts


def rebuilt(turns: DataFrame, parts: DataFrame, every: int = 20) -> tuple[DataFrame, DataFrame]:
    """Turns ``conv_id, depth, a, b, words`` of the rebuilt conversations, and ``conv_id, length``.

    A conversation begins with the first ``crc32(conv_id) % 4`` turns of that with the next lower
    multiple of ``every``, and goes on with its own after as many.
    """
    convs = parts.groupBy("conv_id").agg(F.sum("n").alias("n")).withColumn(
        "h", F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(HEADS + 1))
    )
    heads = (
        turns.where(F.col("conv_id") % every == 0)
        .join(parts, ["conv_id", "part"])
        .withColumn("at", F.col("place") - F.col("first") + F.col("before") + 1)
        .where(F.col("at") <= HEADS)
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct("at", "a", "b", "words"))).alias("head"))
    )
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    convs = convs.join(heads, "base", "left").withColumn(
        "head", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h").cast("int"))
    )
    convs = cut(
        convs.withColumn("taken", F.size("head").cast("bigint")).select(
            "conv_id", "h", "head", "taken",
            (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
        )
    )
    begun = convs.select("conv_id", F.inline("head")).withColumnRenamed("at", "depth")
    places = parts.join(convs.select("conv_id", "h", "taken"), "conv_id").select(
        "conv_id", "part", "first", "before", "h", "taken"
    )
    at = F.col("place") - F.col("first") + F.col("before") + 1
    own = turns.join(places, ["conv_id", "part"]).withColumn("at", at).where("at > h")
    own = own.select("conv_id", (F.col("taken") + F.col("at") - F.col("h")).alias("depth"), "a", "b", "words")
    return begun.unionByName(own), convs.select("conv_id", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, node, parent, words`` of every prefix of every conversation but the root."""
    placed = turns.select(
        "conv_id", "depth", "words",
        F.floor((F.col("depth") - 1) / F.lit(PIECE)).alias("piece"),
        F.xxhash64(F.lit(1), "depth", "a", "b").alias("a"),
        F.xxhash64(F.lit(2), "depth", "b", "a").alias("b"),
    )
    whole = placed.groupBy("conv_id", "piece").agg(F.bit_xor("a").alias("x"), F.bit_xor("b").alias("y"))
    earlier = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    before = whole.select(
        "conv_id", "piece", F.bit_xor("x").over(earlier).alias("x"), F.bit_xor("y").over(earlier).alias("y")
    ).where("piece > 0")
    inside = Window.partitionBy("conv_id", "piece").orderBy("depth")
    summed = (
        placed.withColumn("p", F.bit_xor("a").over(inside))
        .withColumn("q", F.bit_xor("b").over(inside))
        .join(before, ["conv_id", "piece"], "left")
        .withColumn("p", F.col("p").bitwiseXOR(F.coalesce("x", F.lit(0))))
        .withColumn("q", F.col("q").bitwiseXOR(F.coalesce("y", F.lit(0))))
    )
    above = _node(F.col("p").bitwiseXOR(F.col("a")), F.col("q").bitwiseXOR(F.col("b")))
    return summed.select(
        "conv_id", "depth", _node(F.col("p"), F.col("q")).alias("node"),
        F.when(F.col("depth") == 1, F.lit(ROOT)).otherwise(above).alias("parent"), "words",
    )


def ends_digest(ends: DataFrame) -> DataFrame:
    """``node, ends_sha256`` over the ascending ids of the conversations that end at the node.

    Ids are joined to strings in parallel, by ranges of ``IDS`` numbers; a node's strings are then
    sorted beside each other and pass through its digest one by one.
    """
    lists = ends.groupBy("node", F.floor(F.col("conv_id") / F.lit(IDS)).alias("range")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_node, digest = None, None
        for batch in batches:
            done = []
            for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if node == open_node:
                    digest.update(f",{ids}".encode())
                    continue
                if open_node is not None:
                    done.append((open_node, digest.hexdigest()))
                open_node, digest = node, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["node", "ends_sha256"])
        if open_node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([open_node]), pa.array([digest.hexdigest()])], ["node", "ends_sha256"])

    dealt = lists.repartition("node").sortWithinPartitions("node", "range").select("node", "ids")
    return dealt.mapInArrow(run, "node string, ends_sha256 string")


def split_locally(parents: list[int], values: list[list[int]]) -> list[list[int]]:
    """Sums of each of ``values`` over the subtrees of a forest; parents (-1: none) come first.

    Every component is split at its centroid until nothing is left.
    """
    n = len(parents)
    component = [0] * n  # the top of a node's component
    for v in range(n):
        component[v] = v if parents[v] < 0 else component[parents[v]]
    up = list(parents)
    sums = [[0] * n for _ in values]
    alive = list(range(n))
    while alive:
        size = dict.fromkeys(alive, 1)
        below = [dict(zip(alive, (value[v] for v in alive))) for value in values]
        for v in reversed(alive):
            p = up[v]
            if p >= 0:
                size[p] += size[v]
                for part in below:
                    part[p] += part[v]
        centroid: dict[int, int] = {}
        for v in alive:  # the deepest node with more than half of its component below it
            if 2 * size[v] > size[component[v]]:
                centroid[component[v]] = v
        for v in centroid.values():
            totals, at = [part[v] for part in below], v
            while at >= 0:
                for s, total in zip(sums, totals):
                    s[at] += total
                at = up[at]
        taken = set(centroid.values())
        rest = []
        for v in alive:
            if v in taken:
                continue
            if up[v] in taken:
                up[v] = -1
                component[v] = v
            elif up[v] >= 0:
                component[v] = component[up[v]]
            rest.append(v)
        alive = rest
    return sums


def _finish(state: DataFrame, kept: list[str]) -> DataFrame:
    """Sums of the nodes of small components, several components at a time in each task."""
    schema = state.select(*kept, "leaves", "saved").schema

    def rows(table: pa.Table) -> pa.Table:
        place = {node: k for k, node in enumerate(table.column("node").to_pylist())}
        same = table.column("component").to_pylist()
        parents = [place.get(p, -1) for p in table.column("parent").to_pylist()]
        parents = [p if p >= 0 and same[p] == c else -1 for p, c in zip(parents, same)]
        values = [table.column(c).to_pylist() for c in ("leaf", "cost")]
        sums = split_locally(parents, values)
        for name, found in zip(("leaves", "saved"), sums):
            so_far = table.column(name).to_pylist()
            at = table.schema.get_field_index(name)
            table = table.set_column(at, name, pa.array([a + b for a, b in zip(so_far, found)], pa.int64()))
        return table.select([*kept, "leaves", "saved"]).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            component = batch.column("component")
            last = component[-1].as_py()
            first = component.index(pa.scalar(last)).as_py()  # rows of a component are together
            if first or (held and held[0].column("component")[0].as_py() != last):
                whole = [*held, batch.slice(0, first)]
                yield from rows(pa.Table.from_batches([b for b in whole if b.num_rows])).to_batches()
                held = []
            held.append(batch.slice(first))
        if held:
            yield from rows(pa.Table.from_batches(held)).to_batches()

    dealt = state.repartition("component").sortWithinPartitions("component", "depth")
    return dealt.mapInArrow(run, schema)


def _split(state: DataFrame, paths: DataFrame, large: DataFrame, hot_rows: int | None) -> DataFrame:
    """One round: every component named in ``large`` (with its size, ends and top) is split."""
    large = broadcast_if_small(large)
    known = state.join(large, "component")
    is_path = F.col("all_ends") <= 1
    half = F.when(is_path, F.col("depth") == F.col("top") + F.floor(F.col("size") / 2)).otherwise(
        2 * F.col("ends") > F.col("all_ends")
    )
    centroids = cut(
        known.where(half)
        .groupBy("component")
        .agg(F.max_by(F.struct("node", "conv_id", "depth", "ends", "top"), "depth").alias("c"))
        .select(
            "component", F.col("c.node").alias("centroid"), F.col("c.conv_id").alias("by"),
            F.col("c.depth").alias("c_depth"), F.col("c.ends").alias("c_ends"), F.col("c.top").alias("c_top"),
        )
    )
    few = broadcast_if_small(centroids)
    # conversations that go on below a centroid, and the child by which they do
    passing = paths.join(
        few.select(F.col("centroid").alias("parent"), F.col("component").alias("p_component")), "parent"
    ).select("conv_id", "p_component", F.col("node").alias("child"))
    # nodes on the way from a centroid to its component's top
    way = paths.join(few.withColumnRenamed("by", "conv_id"), "conv_id").where(
        "depth <= c_depth AND depth >= c_top"
    ).select("node", "component").unionByName(few.where("c_top = 0").select(F.lit(ROOT).alias("node"), "component"))
    marked = state.join(few.drop("by", "c_top"), "component")
    low = lookup(
        cut(marked.where("depth > c_depth").withColumn("pass", F.concat_ws(":", "conv_id", "component"))),
        passing.select(F.concat_ws(":", "conv_id", "p_component").alias("pass"), "child"),
        "pass", spread_by="node", hot_rows=hot_rows,
    ).drop("pass")
    high = marked.where("depth <= c_depth").join(
        way.withColumn("on_way", F.lit(True)), ["node", "component"], "left"
    )
    marked = cut(low.unionByName(high, allowMissingColumns=True))
    is_centroid = F.coalesce(F.col("node") == F.col("centroid"), F.lit(False))
    below = F.col("child").isNotNull() | is_centroid
    totals = marked.where(below).groupBy("component").agg(
        F.sum("leaf").alias("t_leaves"), F.sum("cost").alias("t_saved")
    )
    on_way = F.coalesce("on_way", F.lit(False))
    added = marked.join(broadcast_if_small(cut(totals)), "component", "left")
    return added.select(
        *[c for c in state.columns if c not in ("component", "ends", "leaves", "saved")],
        F.when(on_way, F.col("leaves") + F.col("t_leaves")).otherwise(F.col("leaves")).alias("leaves"),
        F.when(on_way, F.col("saved") + F.col("t_saved")).otherwise(F.col("saved")).alias("saved"),
        # the part above keeps an end where the centroid was
        F.when(on_way, F.col("ends") - F.col("c_ends") + 1).otherwise(F.col("ends")).alias("ends"),
        F.when(is_centroid, F.col("node")).otherwise(F.coalesce("child", "component")).alias("component"),
        is_centroid.alias("finished"),
    )


def roll_up(
    nodes: DataFrame, paths: DataFrame, kept: list[str], local: int = LOCAL, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """``kept`` columns of ``nodes`` with ``leaves`` and ``saved``, sums of ``leaf`` and ``cost``
    over each node's subtree.

    ``nodes`` are ``node, parent, depth``, a member ``conv_id``, ``ends`` (conversations in
    ``paths`` that end in the subtree) and the values; ``paths`` has the prefixes of the members.
    """
    state = nodes.withColumns(
        {"component": F.lit(ROOT), "leaves": F.lit(0).cast("bigint"), "saved": F.lit(0).cast("bigint")}
    )
    done = []
    state = cut(state)
    while True:
        sizes = state.groupBy("component").agg(
            F.count("*").alias("size"), F.max("ends").alias("all_ends"), F.min("depth").alias("top")
        )
        large = cut(sizes.where(F.col("size") > local))
        if large.isEmpty():
            break
        names = broadcast_if_small(large.select("component"))
        done.append(_finish(state.join(names, "component", "left_anti"), kept))
        split = cut(_split(state.join(names, "component", "left_semi"), paths, large, hot_rows))
        done.append(split.where("finished").select(*kept, "leaves", "saved"))
        state = split.where("NOT finished").drop("finished")
    done.append(_finish(state, kept))
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def prefix_trie(
    conversations: DataFrame, local: int = LOCAL, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Every node with its members, children, leaves, saved tokens and ends.

    ``conv_id`` (the smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256`` and the node's name ``node``.
    """
    turns, convs = rebuilt(*numbered_turns(conversations))
    paths = cut(prefixes(turns))
    convs = cut(convs)
    root_ends = convs.where("length = 0").select(F.lit(ROOT).alias("node"), "conv_id")
    last = lookup(
        paths.select("conv_id", "depth", "node"), convs, "conv_id", spread_by="depth", hot_rows=hot_rows
    ).where("depth = length").select("node", "conv_id")
    ends = cut(last.unionByName(root_ends))
    first_ends = ends.groupBy("node").agg(F.min("conv_id").alias("conv_id"))
    members = first_ends.select("conv_id").withColumn("is_first", F.lit(1))
    marked = lookup(paths, members, "conv_id", spread_by="depth", hot_rows=hot_rows)
    inner = marked.groupBy("node", "parent", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.max("words").alias("words"), F.count("is_first").alias("ends"),
    )
    each = convs.select("conv_id", F.lit(1).alias("conv"), F.lit(0).alias("first")).union(
        first_ends.select("conv_id", F.lit(0), F.lit(1))
    )
    root = each.agg(
        F.min("conv_id").alias("conv_id"), F.sum("conv").alias("n_convs"), F.sum("first").alias("ends")
    ).where("n_convs > 0")
    root = root.select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("bigint").alias("depth"),
        "conv_id", "n_convs", F.lit(0).cast("bigint").alias("words"), "ends",
    )
    nodes = cut(inner.unionByName(root))
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
        F.count("*").alias("n_children")
    )
    up = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    known = lookup(
        nodes.join(children, "node", "left"), up, "parent", spread_by="node", hot_rows=hot_rows
    ).withColumns(
        {
            "n_children": F.coalesce("n_children", F.lit(0).cast("bigint")),
            "leaf": F.col("n_children").isNull().cast("bigint"),
            "cost": (F.col("n_convs") - 1) * F.col("words"),
        }
    )
    kept = ["node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children"]
    firsts = marked.where("is_first IS NOT NULL").select("conv_id", "depth", "node", "parent")
    summed = roll_up(
        known.select(*kept, "parent", "ends", "leaf", "cost"), cut(firsts), kept, local, hot_rows
    )
    none = hashlib.sha256(b"").hexdigest()
    return summed.join(ends_digest(ends), "node", "left").select(
        *kept[1:], F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"), "node",
    )
