"""Layers of file operations against operations one after the other."""

import random

import pytest

from docintake.operators.ordering import layered_operations, net_changes

SCHEMA = "seq long, op string, from_path string, to_path string"


def final_files(files, actions):
    """Contents are those of the start; the last operation on a path decides."""
    after = dict(files)
    for _, op, source, target in sorted(actions, key=lambda a: a[0]):
        if op == "move":
            after.pop(source, None)
            after[target] = files[source]
        elif op == "remove":
            after.pop(source, None)
    return after


def run_layers(files, rows, rng):
    now = dict(files)
    layers = {}
    for r in rows:
        layers.setdefault(r.layer, []).append(r)
    for layer in sorted(layers):
        ops = layers[layer]
        rng.shuffle(ops)  # side by side, in whatever order
        touched = [p for r in ops for p in ({r.to_path} if r.op == "copy" else {r.from_path, r.to_path}) if p]
        assert len(touched) == len(set(touched))
        for r in ops:
            content = now[r.from_path] if r.op != "remove" else None
            if r.op != "copy":
                now.pop(r.from_path, None)
            if r.op != "remove":
                now[r.to_path] = content
    return now


def check(spark, files, actions, hot_rows=None):
    given = spark.createDataFrame(actions, SCHEMA).repartition(3)
    rows = layered_operations(net_changes(given), hot_rows).collect()
    assert run_layers(files, rows, random.Random(1)) == final_files(files, actions)
    return rows


def test_chain(spark):
    files = {c: c.upper() for c in "abcdsz"}
    actions = [
        (1, "move", "c", "d"), (2, "move", "b", "c"), (3, "move", "a", "b"),
        (6, "remove", "s", None), (7, "orphan", "z", None),
    ]
    rows = check(spark, files, actions)
    layer = {(r.from_path, r.to_path): r.layer for r in rows}
    assert layer[("c", "d")] < layer[("b", "c")] < layer[("a", "b")] and len(rows) == 4


@pytest.mark.parametrize("seed, hot_rows", [(4, None), (5, 3)])
def test_changes_at_once(spark, seed, hot_rows):
    """Swaps, rings, paths with many readers, and ways that lead into rings."""
    rng = random.Random(seed)
    files = {f"p{i}": f"content {i}" for i in range(50)}
    changes = {p: rng.choice([*files, None]) for p in rng.sample(sorted(files), 40)}
    files |= {f"r{i}": f"ring {i}" for i in range(20)} | {"x": "X", "y": "Y"}
    changes |= {f"r{i}": f"r{(i + 1) % 20}" for i in range(20)} | {"x": "y", "y": "x"}
    changes |= {f"new{i}": "r3" for i in range(5)}
    given = spark.createDataFrame(list(changes.items()), "path string, source string")
    want = {p: c for p, c in files.items() if changes.get(p, p) is not None}
    want |= {p: files[s] for p, s in changes.items() if s is not None}
    for p in set(changes.values()) - {None}:
        if p not in changes:  # what is read without being kept is moved, so say that it stays
            given = given.union(spark.createDataFrame([(p, p)], given.schema))
    rows = layered_operations(given, hot_rows).collect()
    assert run_layers(files, rows, rng) == want
    assert sum(r.to_path is not None and r.to_path.endswith(".aside") for r in rows) >= 2


@pytest.mark.parametrize("seed, hot_rows", [(1, None), (2, None), (3, 4)])
def test_equals_one_after_the_other(spark, seed, hot_rows):
    rng = random.Random(seed)
    paths = [f"p{i}" for i in range(60)]
    files = {p: f"content of {p}" for p in paths}
    actions = []
    for seq in range(90):
        source, target = rng.sample(paths, 2)
        op = rng.choices(["move", "remove", "orphan"], [8, 2, 1])[0]
        actions.append((seq, op, source, target if op == "move" else None))
    # a chain of 20, and many puts from one path
    actions += [(200 - i, "move", f"r{i}", f"r{i + 1}") for i in range(20)]
    actions += [(200 + i, "move", "shared", f"s{i}") for i in range(8)]
    files |= {f"r{i}": f"chain {i}" for i in range(21)} | {"shared": "many"}
    check(spark, files, actions, hot_rows)


def test_no_operations(spark):
    assert layered_operations(net_changes(spark.createDataFrame([], SCHEMA))).count() == 0
