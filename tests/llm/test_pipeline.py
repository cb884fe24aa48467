"""The pipeline against plain versions of its stages."""

from collections import Counter

import corpus_pipeline
from docintake.llm import pii
from tests.llm import brute


def run_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir).cache()
        out.append(docs)
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def check(spark, sf_dir):
    stages = run_stages(spark, sf_dir)
    bench = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(
        "item_id", "text").collect()]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
    good, single, clean, redacted = map(pairs, stages[1:-1])

    named = Counter(d for d, _, c in brute.simhash(good) if d == c)
    kept = Counter(d for d, _ in single if d is not None)
    assert set(kept) == set(named) and set(kept.values()) <= {1}

    hit = {d for d, *_, bad in brute.decontaminate(single, bench) if bad}
    assert Counter(clean) == Counter((d, t) for d, t in single if d not in hit)

    anchors = pii.automaton()
    assert Counter(redacted) == Counter(
        (d, pii.redact(t, pii.find(t, anchors)) if t else t) for d, t in clean)
    assert all(r.n_chars == len(r.text) for r in stages[-2].collect() if r.text is not None)

    packed = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in stages[-1].collect())
    assert packed == Counter(brute.pieces(redacted))
    return stages


def test_given_tables(spark):
    stages = check(spark, "/root/testdata/sf0.01")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    ids = {d for d, _ in pairs(stages[1])}
    good = [d for d, q in labels.items() if q == 1]
    bad = [d for d, q in labels.items() if q == 0]
    assert sum(d in ids for d in good) >= 0.98 * len(good)
    assert sum(d in ids for d in bad) <= 0.1 * len(bad)


def test_odd_tables(spark, odd_tables):
    check(spark, odd_tables)


def test_empty_tables(spark, empty_tables):
    assert corpus_pipeline.run(spark, empty_tables).count() == 0


def test_one_row_of_each_class_stays(spark):
    """Repeated ids in several classes, and rows without an id."""
    a, b, c = (" ".join(f"{w}{i}" for i in range(40)) for w in ("apple", "brick", "cloud"))
    rows = [(1, a), (1, b), (2, a), (3, b), (1, a), (None, c), (None, c), (None, a), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert len({brute.fingerprint(t) for _, t in rows}) == 4
    kept = pairs(corpus_pipeline.keep_one_of_each(spark, docs, ""))
    assert Counter(kept) == Counter([(1, a), (1, b), (None, c), (None, "")])
