"""Parts of language identification, lexical search and the conversation trie."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docintake.llm import langid, search, trie
from docintake.session import prepare_python
from tests.llm import brute


# --- language identification


def plain_profile(texts, size):
    grams = Counter()
    for text in texts:
        letters = "".join(c.lower()[0] if c.isalpha() else " " for c in text or "")
        signs = " ".join(["", *letters.split(), ""])
        if not letters.strip():
            continue
        for n in (1, 2, 3):
            for i in range(len(signs) - n + 1):
                g = signs[i : i + n]
                if g != " " and not (n == 3 and g[1] == " "):
                    grams[g] += 1
    return {g: r for r, (g, _) in enumerate(sorted(grams.items(), key=lambda e: (-e[1], e[0]))[:size])}


def plain_language(text, languages, size):
    own = plain_profile([text], size)
    if not own or not languages:
        return "und", 0.0
    away = {
        name: sum(abs(r - ranks[g]) if g in ranks else size for g, r in own.items())
        for name, ranks in languages.items()
    }
    best = min(away, key=lambda name: (away[name], name))
    return best, 1 - away[best] / (size * len(own))


RARE = ["ÄÖ é\U0001F600 日本   x", "Straße ΑΒΓ αβγ", "", None, " \n1 2 3 !", "日本語の文章です。", "a", "ab" * 30]


@pytest.mark.parametrize("size, languages, piece", [(400, 500, 1 << 20), (30, 1, 97), (5, 2, 8)])
def test_language_equals_plain_version(spark, monkeypatch, size, languages, piece):
    monkeypatch.setattr(langid, "PIECE", piece)
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rows = [(r.doc_id, (r.text or "")[:3000], r.lang) for r in given.limit(60).collect()]
    rows += [(1000 + i, t, None) for i, t in enumerate(RARE)] + [(2000, "日本語", "ja"), (2001, None, "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    by_lang = defaultdict(list)
    for _, text, lang in rows:
        if lang is not None:
            by_lang[lang].append(text)
    known = {name: plain_profile(texts, size) for name, texts in by_lang.items()}
    known = {name: ranks for name, ranks in known.items() if ranks}

    learned = langid.profiles(docs, size=size)
    found = langid.identify(docs.drop("lang"), learned, size=size, languages=languages)
    got = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in found.collect()}
    want = {d: plain_language(t, known, size) for d, t, _ in rows}
    assert got == {d: (name, round(score, 9)) for d, (name, score) in want.items()}
    assert got[1003] == ("und", 0.0) and got[2000][0] == "ja"


def test_language_without_anything_learned(spark):
    docs = spark.createDataFrame([(1, "some words"), (None, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "text string, lang string")
    found = langid.identify(docs, langid.profiles(none)).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)] * 2


def test_language_of_held_out_rows(spark):
    from docintake.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    lang = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op11_language_id"](spark, sf).where("held_out").join(lang, "doc_id").collect()
    right = [r.lang == r.lang_pred for r in rows]
    assert len(rows) > 250 and sum(right) / len(rows) > 0.98


# --- lexical search


def plain_search(docs, items, best=10):
    words = [(d, brute.words(t)) for d, t in docs]
    texts = sum(1 for _, w in words if w)
    total = sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    terms = defaultdict(set)
    for item, text in items:
        terms[item] |= set(brute.words(text))
    out = []
    for item, wanted in terms.items():
        scored = []
        for d, w in words:
            count, score = Counter(w), 0
            for t in wanted & count.keys():
                weight = int(np.floor(1000 * np.log((2 * texts + 2) / (2 * df[t] + 1))))
                m = 10 + 90 * len(w) * texts // total
                score += weight * (1_000_000_000 * count[t] // (1000 * count[t] + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d))
        for rank, (score, _, d) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:best], 1):
            out.append((item, rank, d, -score))
    return Counter(out)


@pytest.mark.parametrize("most, piece, cells", [(search.BLOCK, 1 << 20, 1 << 22), (300, 50, 7)])
def test_search_equals_plain_version(spark, odd_tables, monkeypatch, most, piece, cells):
    """In one block, and in many with texts in pieces and few scores at a time."""
    monkeypatch.setattr(search, "PIECE", piece)
    monkeypatch.setattr(search, "CELLS", cells)
    prepare_python(spark)
    for folder in (odd_tables, "/root/testdata/sf0.001"):
        docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
        items = spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").limit(25)
        docs, items = ([tuple(r) for r in t.collect()] for t in (docs, items))
        docs = [(d, (t or "")[:20_000]) for d, t in docs] + [(None, "short item"), (None, None)]
        found = search.search(
            spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
            spark.createDataFrame(items, "item_id long, text string"), most=most,
        )
        assert Counter(tuple(r) for r in found.collect()) == plain_search(docs, items)


def test_search_blocks_keep_their_bound(spark):
    rows = [(i, f"word{i} other{i}") for i in range(500)] + [(9999, " ".join(f"w{i}" for i in range(400)))]
    rows += [(7, f"word7 more{i}") for i in range(20)] + [(None, "nothing"), (None, "known")]
    items = spark.createDataFrame(rows + rows, "item_id long, text string")
    blocks = list(search.item_blocks(search.item_terms(items, "item_id", "text").cache(), 1000))
    names = [n for b in blocks for n in b]
    assert len(names) == len(set(names)) == 502
    for block in blocks:
        size = sum(search.PER_ITEM + sum(len(t) + 2 for t in ts) for ts in block.values())
        assert size <= 1000 or len(block) == 1
    assert sum(len(ts) for b in blocks for ts in b.values()) == 500 * 2 + 400 + 20 + 2


# --- conversation trie


def plain_sums(parents, values):
    out = list(values)
    for v in reversed(range(len(parents))):
        if parents[v] >= 0:
            out[parents[v]] += out[v]
    return out


def test_local_split_equals_plain_sums():
    draw = random.Random(5)
    for n in (0, 1, 2, 3, 10, 50, 200):
        for shape in ("path", "star", "any", "forest"):
            parents = [
                -1 if v == 0 or (shape == "forest" and draw.random() < 0.2)
                else {"path": v - 1, "star": 0}.get(shape, draw.randrange(v)) for v in range(n)
            ]
            values = [[draw.randrange(100) for _ in range(n)] for _ in range(2)]
            assert trie.split_locally(parents, values) == [plain_sums(parents, v) for v in values]
    long = 20_000
    parents = [v - 1 for v in range(long)]
    assert trie.split_locally(parents, [[1] * long]) == [[long - v for v in range(long)]]


def talks(draw, n, depth):
    rows = []
    for c in range(n):
        for turn in range(draw.randrange(depth)):
            rows.append((c - 10, turn, draw.choice(["user", None]), draw.choice(["a b", "c", " ", None])))
    return rows


def plain_trie(rows):
    import re
    import zlib

    talk = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            talk[c].append((turn is not None, turn or 0, role or "", text or ""))
    talk = {c: [t[2:] for t in sorted(turns)] for c, turns in talk.items()}
    built = {}
    for c, turns in talk.items():
        base, h = c - int(np.fmod(c, 20)), zlib.crc32(str(c).encode()) % 4
        built[c] = (*talk.get(base, [])[:h], *turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, convs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(convs) - 1) * words
    return Counter(
        (min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), children[p], leaves[p], saved[p],
         brute.sha256(",".join(str(c) for c in sorted(convs) if len(built[c]) == len(p))))
        for p, convs in members.items()
    )


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("local", [trie.LOCAL, 6])
def test_trie_equals_plain_version(spark, monkeypatch, local):
    """Also with components of over six nodes split by joins, and turns summed by threes."""
    prepare_python(spark)
    draw = random.Random(3)
    rows = talks(draw, 60, 8) + [(c, t, "user", "x") for c in (400, 405, 419) for t in range(30)]
    rows += [(700, None, "user", "same")] * 9 + [(None, 0, "user", "nobody's")] * 3
    if local == 6:
        monkeypatch.setattr(trie, "PIECE", 3)
        monkeypatch.setattr(trie, "IDS", 7)
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    found = trie.prefix_trie(given, local=local, hot_rows=None)
    assert Counter(tuple(r) for r in found.select(COLUMNS).collect()) == plain_trie(rows)


def test_trie_with_hot_keys(spark):
    prepare_python(spark)
    rows = [(c, t, "user", "a") for c in range(100, 140) for t in range(5)]
    rows += [(5000, t, "user", f"turn {t}") for t in range(300)]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    found = trie.prefix_trie(given, local=50, hot_rows=20)
    assert Counter(tuple(r) for r in found.select(COLUMNS).collect()) == plain_trie(rows)
