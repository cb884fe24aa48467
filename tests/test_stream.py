"""Micro-batches end like their messages taken one at a time."""

import json
import random

import pytest
from pyspark.sql import functions as F

from docintake.config import IntakeConfig
from docintake.streaming.intake import new_store, size_summary, take_in
from tests.sequential_model import AS_OF_SECONDS, Model, digest
from tests.test_ingest import frames, stamp, universe

FILES = ("path", "length", "md5", "mtime", "kind")


def raw_of(spark, messages):
    rows = []
    for m in messages:
        keys = ("source", "origins", "tags", "derivative", "verify")
        rows.append((m["seq"], json.dumps({k: m[k] for k in keys if m[k] is not None})))
    return spark.createDataFrame(rows, "seq long, value string")


def start(spark, tmp_path, data):
    return new_store(
        spark, f"file://{tmp_path}/store", data["catalog"], data["mappings"], data["flags"],
        data["files"].select(*FILES),
    )


def state(store):
    rows = {r.doc_id: (r.source, r.hash) for r in store.load("catalog").collect()}
    files = {r.path: r.md5 for r in store.load("files").collect()}
    edges = {r.mapping_id: (r.child, r.child_path) for r in store.load("mappings").collect()}
    return rows, files, edges


def wanted(model):
    return (
        {k: (r["source"], r["hash"]) for k, r in model.catalog.items()},
        {p: h for p, (h, _) in model.files.items()},
        {e["mapping_id"]: (e["child"], e["child_path"]) for e in model.mappings},
    )


def as_of():
    return F.lit(stamp(AS_OF_SECONDS)).cast("timestamp")


@pytest.mark.parametrize("seed, cuts", [(11, 3), (12, 2)])
def test_stream_equals_sequence(spark, tmp_path, seed, cuts):
    """Each batch reads the files as the one before left them; a repeated batch does nothing."""
    rng = random.Random(seed)
    parts, messages = ({}, [], {}, {}, [], []), []
    for u in range(6):
        *made, batch = universe(f"u{u}", rng, rng.randint(2, 8))
        for part, extra in zip(parts, made):
            part.update(extra) if isinstance(part, dict) else part.extend(extra)
        messages += batch
    rng.shuffle(messages)
    for seq, m in enumerate(messages):
        m["seq"] = seq
    files, _, chains, bodies, catalog, mappings = parts
    cfg = IntakeConfig(recent_tolerance=None, max_retries=0)
    data = frames(spark, parts, messages)
    store = start(spark, tmp_path, data)
    model = Model(catalog, files, chains, bodies, mappings, None)
    size = -(-len(messages) // cuts)
    for batch_id in range(cuts):
        batch = messages[batch_id * size : (batch_id + 1) * size]
        # payloads are read at the start of a batch
        model.snapshot, model.consumed = dict(model.files), set()
        for m in batch:
            model.run(m)
        for _ in range(2 if batch_id == 1 else 1):
            take_in(raw_of(spark, batch), batch_id, store, None, data["captures"], as_of(), cfg)
        assert state(store) == wanted(model)


def test_equal_messages_in_two_batches(spark, tmp_path):
    """The file is gone after the first; the second finds none, as within one batch."""
    path = "ingress/d/a.txt"
    message = dict(source=path, origins=[], tags=[], derivative=None, verify=False)
    data = frames(spark, ({path: (digest("a"), 1)}, [], {}, {}, [], []), [])
    store = start(spark, tmp_path, data)
    cfg = IntakeConfig(recent_tolerance=None, max_retries=0)
    for n in range(2):
        take_in(raw_of(spark, [dict(message, seq=n)]), n, store, None, data["captures"], as_of(), cfg)
    errors = spark.read.parquet(f"{store.path}/out/errors").collect()
    assert [(r.seq, r.outcome) for r in errors] == [(1, "file_not_found")]
    assert state(store)[1] == {"local/d/a.txt": digest("a")}


def test_message_waits_for_its_file(spark, tmp_path):
    path = "ingress/d/late.txt"
    message = dict(seq=1, source=path, origins=[], tags=["t"], derivative=None, verify=False)
    other = dict(seq=2, source="ingress/never.txt", origins=[], tags=[], derivative=None, verify=False)
    data = frames(spark, ({}, [], {}, {}, [], []), [])
    store = start(spark, tmp_path, data)
    cfg = IntakeConfig(recent_tolerance=None, max_retries=2)
    nothing = raw_of(spark, [message]).limit(0)
    landed = spark.createDataFrame([(path, 5, digest("late"), stamp(0), None)], data["files"].schema)
    take_in(raw_of(spark, [message, other]), 0, store, None, data["captures"], as_of(), cfg)
    assert state(store)[0] == {} and store.load("retries").count() == 2
    take_in(nothing, 1, store, landed, data["captures"], as_of(), cfg)
    rows, files, _ = state(store)
    assert list(rows.values()) == [("local/d/late.txt", digest("late"))]
    assert files == {"local/d/late.txt": digest("late")}
    assert [(r.seq, r.attempt) for r in store.load("retries").collect()] == [(2, 2)]
    take_in(nothing, 2, store, None, data["captures"], as_of(), cfg)
    assert store.load("retries").count() == 0
    errors = spark.read.parquet(f"{store.path}/out/errors").collect()
    assert [(r.seq, r.outcome) for r in errors] == [(2, "file_not_found")]


def test_compaction_keeps_the_state(spark, tmp_path):
    files = {f"ingress/{i}.txt": (digest(str(i)), 1) for i in range(3)}
    data = frames(spark, (files, [], {}, {}, [], []), [])
    store = start(spark, tmp_path, data)
    message = dict(seq=1, source="ingress/1.txt", origins=[], tags=[], derivative=None, verify=False)
    take_in(raw_of(spark, [message]), 4, store, None, data["captures"], as_of(), IntakeConfig())
    before = state(store)
    store.compact(store.last_batch())
    assert state(store) == before and store.last_batch() == 4


def test_rows_lost_in_a_commit_are_found(spark, tmp_path, monkeypatch):
    """A row that does not reach the commit sends its message to the retries, or is reported."""
    files = {f"ingress/{i}.txt": (digest(str(i)), 10 * i) for i in range(1, 4)}
    data = frames(spark, (files, [], {}, {}, [], []), [])
    store = start(spark, tmp_path, data)
    messages = [dict(seq=i, source=f"ingress/{i}.txt", origins=[], tags=[], derivative=None, verify=False)
                for i in range(1, 4)]
    commit = store.commit_changes

    def losing(changed, *rest):
        if "catalog" in changed:
            kept = changed["catalog"].where(F.col("source") != "local/2.txt")
            changed = {**changed, "catalog": kept}
        return commit(changed, *rest)

    monkeypatch.setattr(store, "commit_changes", losing)
    for _ in range(2):  # a repeated batch changes nothing
        take_in(raw_of(spark, messages[:2]), 0, store, None, data["captures"], as_of(), IntakeConfig(max_retries=1))
        assert [(r.seq, r.attempt) for r in store.load("retries").collect()] == [(2, 1)]
    take_in(raw_of(spark, messages[2:]), 1, store, None, data["captures"], as_of(), IntakeConfig(max_retries=0))
    assert {r.source for r in store.load("catalog").collect()} == {"local/1.txt", "local/3.txt"}
    counts = spark.read.parquet(f"{store.path}/out/counts").groupBy("outcome").agg(F.sum("n").alias("n"))
    assert {r.outcome: r.n for r in counts.collect()} == {"ok": 3, "file_not_found": 1}
    sizes = [tuple(r) for r in size_summary(store).collect()]
    assert sizes == [("file", "MOVE", 3, 60, 20.0, 30.0)]


def test_unconfirmed_updates_are_listed(spark, tmp_path, monkeypatch):
    data = frames(spark, ({"ingress/a.txt": (digest("a"), 1)}, [], {}, {}, [], []), [])
    store = start(spark, tmp_path, data)
    commit = store.commit_changes
    monkeypatch.setattr(store, "commit_changes", lambda changed, *rest: commit(
        {n: d.limit(0) if n == "catalog" else d for n, d in changed.items()}, *rest))
    message = dict(seq=7, source="ingress/a.txt", origins=[], tags=[], derivative=None, verify=False)
    take_in(raw_of(spark, [message]), 3, store, None, data["captures"], as_of(), IntakeConfig(max_retries=0))
    rows = spark.read.parquet(f"{store.path}/out/unconfirmed").collect()
    assert [(r.seq, r.outcome) for r in rows] == [(7, "update_failed")]
    assert store.load("retries").count() == 0


def test_merged_summaries(spark):
    from docintake.operators.metrics import RANK_ERRORS, merged_summary, summary_sketches

    rng = random.Random(9)
    rows = [(f"l{i % 3}", i % 5, rng.expovariate(0.01)) for i in range(6000)] + [("none", 0, None)]
    df = spark.createDataFrame(rows, "label string, batch int, v double")
    parts = [summary_sketches(df.where(f"batch = {b}"), ["label"], "v") for b in range(5)]
    stored = parts[0]
    for part in parts[1:]:
        stored = stored.unionByName(part)
    got = {r.label: r for r in merged_summary(stored, ["label"]).collect()}
    assert len(got) == 4 and got["none"].q50 is None
    for label in ("l0", "l1", "l2"):
        values = sorted(v for name, _, v in rows if name == label)
        for q, allowed, found in zip((0.5, 0.9), RANK_ERRORS, (got[label].q50, got[label].q90)):
            assert abs(sum(v <= found for v in values) / len(values) - q) <= allowed
        assert got[label].n == len(values)
