"""A batch must end like its messages taken one at a time."""

import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docintake import schema
from docintake.config import IntakeConfig
from docintake.operators.targets import apply_actions
from docintake.plans.ingest import ingest_batch
from tests.sequential_model import AS_OF_SECONDS, Model, digest, remote_path

UTC = datetime.timezone.utc


def stamp(seconds):
    return datetime.datetime.fromtimestamp(seconds, UTC).replace(tzinfo=None)


def origin(scheme, uri):
    return {"scheme": scheme, "hostname": "h", "uri": uri, "headers": None, "metadata": None}


def chain_origin(uri, status, location=None):
    headers = [("Location", [location])] if location else []
    return {
        "scheme": uri.split(":")[0], "hostname": uri.split("://")[1].split("/")[0], "uri": uri,
        "headers": headers, "metadata": [("status", "int", str(status))],
    }


def universe(u, rng, n_messages):
    """A few paths, hashes and URLs that get in each other's way on purpose."""
    hashes = [digest(f"{u}-{i}") for i in range(3)] + [f"empty-{u}"]
    names = [f"{u}-{i}.txt" for i in range(3)]
    paths = [f"ingress/{n}" for n in names] + [f"local/{n}" for n in names[:2]]
    paths += [f"ingress/remote/https/h/{names[0]}", f"remote/https/h/{names[0]}"]
    paths += [f"ingress/derivatives/derivatives/{names[0]}", f"ingress/derivatives/{names[0]}"]
    paths += [f"ingress/copies/{u}-{i}.txt" for i in range(4)]
    weights = [5, 3, 1, 1]
    files = {}
    for p in paths:
        if rng.random() < 0.9:
            h = rng.choices(hashes, weights)[0]
            files[p] = (h, 0 if h == hashes[3] else 10)
    urls = [f"https://h/{n}" for n in names]
    captures, chains, bodies = [], {}, {}
    for i, url in enumerate(urls):
        h = rng.choices(hashes, weights)[0]
        bodies[url] = (h, 0 if h == hashes[3] else 10)
        captures.append((url, 200, None, [], h, bodies[url][1]))
        chains[url] = [chain_origin(url, 200)]
        alias = url.replace("https", "http")
        if i < 2:
            captures.append((alias, 301, url, [("Location", [url])], None, None))
            chains[alias] = chains[url] + [chain_origin(alias, 301, url)]
    sources = paths + urls + [f"remote/https/h/{n}" for n in names]
    catalog = []
    for i in range(rng.randint(0, 4)):
        origins = rng.choice([None, [], [origin("https", rng.choice(urls))],
                              [origin("mongodb", "x"), origin("http", f"http://h/{names[0]}")]])
        catalog.append(dict(
            doc_id=f"{i}-{u}", source=rng.choice(sources), hash=rng.choice(hashes),
            created=AS_OF_SECONDS - rng.choice([2, 5, 1000, 2000]), origin=origins,
            tags=rng.sample(["a", "b"], rng.randint(0, 2)), derivative=False,
            rogue=rng.choice([None, None, None, None, True]),
            started=rng.choice([None, None, AS_OF_SECONDS - 5, AS_OF_SECONDS - 500]),
        ))
    mappings = [
        dict(mapping_id=f"{u}-{i}", parent=rng.choice(["x", f"0-{u}", f"1-{u}"]), child=None,
             child_path=rng.choice(paths))
        for i in range(3)
    ]
    messages = []
    for _ in range(n_messages):
        source = rng.choice(paths) if rng.random() < 0.65 else rng.choice(
            list(chains) + [f"http://gone/{u}"]
        )
        origins = []
        if rng.random() < 0.3:
            origins = rng.choice([
                [origin("https", rng.choice(urls))], [origin("mongodb", None)],
                [origin("http", None)], [origin("ftp", "no-scheme")],
                [origin("mongodb", "x"), origin("ftp", f"ftp://h/{rng.choice(names)}")],
            ])
        messages.append(dict(
            source=source, origins=origins, tags=rng.sample(["a", "b", "c"], rng.randint(0, 2)),
            derivative=rng.choice([None, True, False]), verify=rng.random() < 0.15,
        ))
    return files, captures, chains, bodies, catalog, mappings, messages


def frames(spark, parts, messages):
    files, captures, _, _, catalog, mappings = parts
    return dict(
        messages=spark.createDataFrame(
            [(m["seq"], m["source"], m["origins"], m["tags"], None, m["derivative"], m["verify"])
             for m in messages], schema.MESSAGE),
        files=spark.createDataFrame(
            [(p, n, h, stamp(0), None) for p, (h, n) in files.items()], schema.FILES),
        captures=spark.createDataFrame(
            [(u, s, loc, hd, h, n, None, None) for u, s, loc, hd, h, n in captures], schema.CAPTURES),
        catalog=spark.createDataFrame(
            [(r["doc_id"], r["source"], r["hash"], "", stamp(r["created"]), stamp(r["created"]),
              r["derivative"], None, None, r["tags"], None, r["origin"], None, r["rogue"])
             for r in catalog], schema.CATALOG),
        mappings=spark.createDataFrame(
            [(e["mapping_id"], e["parent"], e["child"], e["child_path"], None, None)
             for e in mappings], schema.MAPPINGS),
        flags=spark.createDataFrame(
            [(r["doc_id"], "intake", "1", stamp(r["started"]), None)
             for r in catalog if r["started"] is not None], schema.FLAGS),
    )


def plain(o):
    return (o["scheme"], o["uri"], len(o["headers"] or []))


def check(spark, model, messages, data, cfg, hot_rows):
    as_of = F.lit(stamp(AS_OF_SECONDS)).cast("timestamp")
    result = ingest_batch(**data, as_of=as_of, cfg=cfg, hot_rows=hot_rows)
    for m in messages:
        model.run(m)
    got = {r["seq"]: (r["outcome"], r["doc_id"]) for r in result.outcomes.collect()}
    assert {k: (v, model.outcomes.get(k)) for k, v in got.items() if v != model.outcomes.get(k)} == {}
    assert len(got) == len(messages)
    assert result.counts == Counter(outcome for outcome, _ in got.values())

    rows = {r["doc_id"]: r for r in result.catalog.collect()}
    assert set(rows) == set(model.catalog)
    for key, want in model.catalog.items():
        row = rows[key]
        assert (row["source"], row["hash"]) == (want["source"], want["hash"]), key
        assert row["tags"] == want["tags"], key
        assert row["derivative"] == want["derivative"], key
        assert [plain(o) for o in row["origin"] or []] == [
            plain(o) for o in want["origin"] or []
        ], key

    actions = sorted(tuple(a) for a in result.actions.collect() if a["op"] != "orphan")
    assert actions == sorted(a for a in model.actions if a[1] != "orphan")
    orphans = sorted(a["from_path"] for a in result.actions.collect() if a["op"] == "orphan")
    assert orphans == sorted(a[2] for a in model.actions if a[1] == "orphan")

    payloads = result.outcomes.select(
        "seq", F.col("hash").alias("md5"), "length", F.lit(None).cast("timestamp_ntz").alias("mtime")
    )
    stored = apply_actions(data["files"], result.actions, payloads).collect()
    assert {r["path"]: r["md5"] for r in stored} == {p: h for p, (h, _) in model.files.items()}

    edges = {r["mapping_id"]: (r["child"], r["child_path"]) for r in result.mappings.collect()}
    assert edges == {e["mapping_id"]: (e["child"], e["child_path"]) for e in model.mappings}

    flags = {r["doc_id"]: r["started"] for r in result.flags.collect()}
    want = {
        k: stamp(r["started"]) for k, r in model.catalog.items() if r["started"] is not None
    }
    assert flags == want
    return result


@pytest.mark.parametrize("tolerance, seed", [(None, 1), (10, 2), (None, 3)])
def test_batch_equals_sequence(spark, tolerance, seed):
    rng = random.Random(seed)
    parts = ({}, [], {}, {}, [], [])
    messages = []
    for u in range(20):
        *made, batch = universe(f"u{u}", rng, rng.randint(1, 9))
        for part, extra in zip(parts, made):
            part.update(extra) if isinstance(part, dict) else part.extend(extra)
        messages += batch
    rng.shuffle(messages)
    for seq, m in enumerate(messages):
        m["seq"] = seq
    files, _, chains, bodies, catalog, mappings = parts
    model = Model(catalog, files, chains, bodies, mappings, tolerance)
    cfg = IntakeConfig(recent_tolerance=tolerance)
    data = frames(spark, parts, messages)
    check(spark, model, messages, data, cfg, 20 if seed == 3 else 10**6)


def test_hot_copies_need_two_rounds(spark):
    """A third of all messages carry the same bytes; they must not go one by one."""
    n = 60
    files = {f"ingress/d/{i}.txt": (digest("hot" if i % 3 == 0 else str(i)), 5) for i in range(n)}
    messages = [
        dict(seq=i, source=f"ingress/d/{i}.txt", origins=[], tags=[f"t{i % 7}"], derivative=None,
             verify=False)
        for i in range(n)
    ]
    parts = (files, [], {}, {}, [], [])
    model = Model([], files, {}, {}, [], None)
    data = frames(spark, parts, messages)
    result = check(spark, model, messages, data, IntakeConfig(recent_tolerance=None), 10)
    assert result.rounds == 2


def test_hot_target_needs_one_round(spark):
    """Different documents that go to one path replace each other within one round."""
    n = 30
    # fragments make different addresses of one path
    urls = [f"https://h/x#{i}" for i in range(n)]
    head = [("Content-Disposition", ["inline; filename=a.pdf"])]
    captures = [(u, 200, None, head if i % 3 else [], digest(u), 5) for i, u in enumerate(urls)]
    messages = [
        dict(seq=i, source=c[0], origins=[], tags=[], derivative=None, verify=False)
        for i, c in enumerate(captures)
    ]
    data = frames(spark, ({}, captures, {}, {}, [], []), messages)
    as_of = F.lit(stamp(AS_OF_SECONDS)).cast("timestamp")
    result = ingest_batch(**data, as_of=as_of, hot_rows=10)
    by_action = {r["action"]: r["n"] for r in result.outcomes.groupBy("action").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    assert by_action == {"MOVE": 2, "REPLACE": 28}
    assert result.rounds == 1
    targets = {r["target_path"] for r in result.outcomes.collect()}
    assert targets == {remote_path("https://h/x") + ".html", remote_path("https://h/x") + "/a.pdf"}


@pytest.mark.parametrize("fetched", [None, 0, 50])
def test_versions_of_one_origin_need_no_round_each(spark, fetched):
    """100 landing files say that they come from one address, which may be fetched as well."""
    url, n = "https://h/x.txt", 100
    files = {f"ingress/d/{i}.txt": (digest(f"v{i}"), 5) for i in range(n)}
    chains = {url: [chain_origin(url, 200)]}
    captures = [(url, 200, None, [], digest("body"), 5)]
    sources = list(files)
    if fetched is not None:
        sources.insert(fetched, url)
    messages = [
        dict(seq=i, source=s, origins=[] if s == url else [origin("https", url)], tags=[f"t{i % 7}"],
             derivative=None, verify=False)
        for i, s in enumerate(sources)
    ]
    model = Model([], files, chains, {url: (digest("body"), 5)}, [], None)
    data = frames(spark, (files, captures, {}, {}, [], []), messages)
    result = check(spark, model, messages, data, IntakeConfig(recent_tolerance=None), 20)
    assert result.rounds <= 2
    assert sum(v[0] == "ok" for v in model.outcomes.values()) == len(messages)


@pytest.mark.parametrize("stored, hot_rows", [(False, 10), (True, 10**6)])
def test_contents_taking_turns_at_one_path(spark, monkeypatch, stored, hot_rows):
    """1,000 files of three contents come from one address, so that each meets another's file."""
    monkeypatch.setattr("docintake.plans.ingest.PIECE", 64)
    url, n, rng = "https://h/x.txt", 1000, random.Random(7)
    hashes = [digest(f"turn {i}") for i in range(3)]
    files = {f"ingress/d/{i}.txt": (hashes[i % 2] if i % 50 else rng.choice(hashes), 5) for i in range(n)}
    target = remote_path(url)
    catalog = []
    if stored:  # a row in place whose file may be missing, and one that gets in the way
        catalog = [dict(
            doc_id=f"old-{i}", source=target, hash=hashes[i], created=AS_OF_SECONDS - 100 - i,
            origin=[origin("https", url)], tags=[], derivative=False, rogue=None, started=None,
        ) for i in range(2)]
    messages = [
        dict(seq=i, source=s, origins=[origin("https", url)], tags=[f"t{i % 7}"], derivative=None,
             verify=False)
        for i, s in enumerate(files)
    ]
    model = Model(catalog, files, {}, {}, [], None)
    data = frames(spark, (files, [], {}, {}, catalog, []), messages)
    result = check(spark, model, messages, data, IntakeConfig(recent_tolerance=None), hot_rows)
    assert result.rounds <= 12
    replaced = result.outcomes.where("action = 'REPLACE'").count()
    assert replaced > 800


def test_error_says_why_a_fetch_failed(spark):
    captures = [("https://h/x", 404, None, [], None, None), ("https://h/y", 301, None, [], None, None)]
    messages = [
        dict(seq=i, source=u, origins=[], tags=[], derivative=None, verify=False)
        for i, u in enumerate(("https://h/x", "https://h/y", "https://h/z"))
    ]
    data = frames(spark, ({}, captures, {}, {}, [], []), messages)
    result = ingest_batch(**data, as_of=F.lit(stamp(AS_OF_SECONDS)).cast("timestamp"))
    texts = {r["seq"]: r["error_text"] for r in result.errors.collect()}
    none = "no document found for URI: "
    assert texts[0] == none + "https://h/x. Unable to process https://h/x with status code 404"
    assert texts[1].startswith(none + "https://h/y. unable_to_follow")
    assert texts[2].startswith(none + "https://h/z. not_captured")


def test_empty_contents_need_no_round_each(spark):
    """Each empty file deletes the newest row of its content; refused ones may add one."""
    empty = digest("")
    paths = [f"ingress/z{i:02}.txt" for i in range(40)]
    files = {p: (empty, 0) for p in paths}
    catalog = [dict(
        doc_id=f"{i:02}", source=f"local/z{i:02}.txt", hash=empty if i % 3 else digest(str(i)),
        created=AS_OF_SECONDS - 1000 - i % 11, origin=None, tags=[], derivative=False,
        rogue=True if i == 1 else None, started=None,
    ) for i in range(30)]
    messages = [dict(
        seq=i, source=p, origins=[origin("http", None)] if i % 5 == 3 else [], tags=[],
        derivative=None, verify=i % 7 == 2,
    ) for i, p in enumerate(paths)]
    model = Model(catalog, files, {}, {}, [], None)
    data = frames(spark, (files, [], {}, {}, catalog, []), messages)
    result = check(spark, model, messages, data, IntakeConfig(recent_tolerance=None), 10**6)
    assert result.rounds <= 2


def test_copies_that_run_again_hold_up_no_one(spark):
    """Stored documents of one address replace each other; a copy of each comes right after it."""
    n = 8
    address = [origin("https", "https://h.example.com/all.html")]
    files = {f"ingress/{c}{i}.txt": (digest(str(i)), 5) for i in range(n) for c in "ab"}
    catalog = [dict(
        doc_id=f"d{i:02}", source=f"local/s{i}.txt", hash=digest(str(i)),
        created=AS_OF_SECONDS - 1000, origin=address, tags=[], derivative=False,
        rogue=None, started=None,
    ) for i in range(n)]
    messages = [
        dict(seq=2 * i + (c == "b"), source=f"ingress/{c}{i}.txt", origins=[], tags=[],
             derivative=None, verify=False)
        for i in range(n) for c in "ab"
    ]
    model = Model(catalog, files, {}, {}, [], 10)
    data = frames(spark, (files, [], {}, {}, catalog, []), messages)
    result = check(spark, model, messages, data, IntakeConfig(recent_tolerance=10), 10**6)
    assert result.rounds <= 3


def test_refused_copies_hold_up_no_one(spark):
    """Every third copy of a content is refused, so it does nothing at the path of the others."""
    n = 30
    files = {f"ingress/c{i:02}.txt": (digest("one"), 5) for i in range(n)}
    messages = [
        dict(seq=i, source=p, origins=[origin("http", None)] if i % 3 == 1 else
             [origin("https", f"https://h/{i}.txt")] if i % 3 == 2 else [], tags=[],
             derivative=None, verify=False)
        for i, p in enumerate(files)
    ]
    model = Model([], files, {}, {}, [], None)
    data = frames(spark, (files, [], {}, {}, [], []), messages)
    result = check(spark, model, messages, data, IntakeConfig(recent_tolerance=None), 10**6)
    assert result.rounds <= 4
