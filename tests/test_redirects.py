"""Walks over recorded redirects against a walk hop by hop."""

import random

import pytest
from pyspark.sql import functions as F

from docintake.operators import redirects


def plain_walk(start, answers, statuses, most):
    seen, at = [], start
    while True:
        if most is not None and len(seen) == most:
            return seen, at, None, "too_many_redirects"
        if not at.startswith("http"):
            if at.startswith("ftp"):
                return [*seen, at], at, None, None
            return seen, at, None, "unsupported_scheme"
        if at not in answers:
            return seen, at, None, "not_captured"
        status, location = answers[at]
        if status not in statuses:
            return [*seen, at], at, status, None
        seen.append(at)
        if location is None:
            return seen, at, status, "unable_to_follow"
        if location in seen:
            return seen, location, None, "too_many_redirects"
        at = location


def frames(spark, starts, answers):
    log = spark.createDataFrame(
        [(u, s, loc, [("Location", [loc])] if loc else []) for u, (s, loc) in answers.items()],
        "uri string, status int, location string, headers array<struct<name: string, values: array<string>>>",
    )
    return spark.createDataFrame([(s,) for s in starts], "uri string"), log


def check(spark, starts, answers, statuses, most, hot_rows):
    uris, log = frames(spark, starts, answers)
    rows = redirects._follow(uris, log, statuses, most, hot_rows).collect()
    got = {
        r.uri: ([o["uri"] for o in r.chain], r.current, r.terminal_status, r.error) for r in rows
    }
    want = {s: plain_walk(s, answers, statuses, most) for s in starts if s is not None}
    assert len(rows) == len(want)
    assert got == want


@pytest.mark.parametrize("most, hot_rows", [(None, None), (None, 5), (7, None), (1, None), (8, 5)])
def test_equals_plain_walk(spark, most, hot_rows):
    rng = random.Random(most)
    urls = [f"http://h/{i}" for i in range(120)]
    ends = ["ftp://h/x", "gopher://h/x", "http://gone/x"]
    answers = {}
    for i, u in enumerate(urls):
        roll = rng.random()
        if roll < 0.2:
            answers[u] = (rng.choice([200, 404, 307]), None)
        elif roll < 0.25:
            answers[u] = (301, None)
        else:
            near = urls[max(0, i - 4) : i] or ends
            answers[u] = (rng.choice([301, 302]), rng.choice([*near, rng.choice(ends), rng.choice(urls), u]))
    for i in range(20):  # a path, a ring with a way in, and many that go to one address
        answers[f"http://p/{i}"] = (301, f"http://p/{i + 1}")
        answers[f"http://r/{i}"] = (301, f"http://r/{(i + 1) % 20}")
        answers[f"http://w/{i}"] = (302, f"http://w/{i + 1}" if i < 5 else "http://r/3")
        answers[f"http://m/{i}"] = (301, "http://p/15")
    starts = [*answers, *ends, "http://nowhere/", None, "http://p/0"]
    check(spark, starts, answers, (301, 302), most, hot_rows)


def test_two_thousand_hops_need_twelve_rounds(spark, monkeypatch):
    n = 2000
    answers = {f"http://p/{i}": (301, f"http://p/{i + 1}") for i in range(n)}
    answers[f"http://p/{n}"] = (200, None)
    answers |= {f"http://r/{i}": (301, f"http://r/{(i + 1) % 700}") for i in range(700)}
    written = []
    monkeypatch.setattr(redirects, "cut", lambda df, cut=redirects.cut: written.append(1) or cut(df))
    check(spark, ["http://p/0", "http://p/1990", "http://r/5"], answers, (301, 302), None, None)
    assert len(written) <= 2 * 12 + 1  # walks and jumps of each round


def test_empty_tables(spark):
    uris, log = frames(spark, [], {"http://a/": (301, "http://b/")})
    assert redirects.resolve_redirects(uris, log).count() == 0
    uris, log = frames(spark, ["http://a/"], {})
    assert [r.error for r in redirects.resolve_redirects(uris, log).collect()] == ["not_captured"]
