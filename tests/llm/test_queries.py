"""Every operator's query against a plain version, over odd rows and the smallest given tables."""

import hashlib
from collections import Counter, defaultdict

import pytest

from docintake.llm.queries import QUERIES
from docintake.llm.oracles import ORACLES
from tests.compare import compare, connect
from tests.llm import brute
from tests.llm.conftest import DOCS

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(params=["odd", "small"])
def sf_dir(request, odd_tables):
    return odd_tables if request.param == "odd" else SMALL


def docs_of(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in rows]


def result(spark, name, sf_dir, columns):
    df = QUERIES[name](spark, sf_dir)
    return Counter(tuple(r) for r in df.select(columns).collect())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf_dir, name, odd_tables):
    if sf_dir == odd_tables and name == "op10_decontaminate":
        pytest.skip("its SQL lists every window of the very long texts; brute force has this case")
    con = connect(sf_dir) if sf_dir == SMALL else connect_folders(sf_dir)
    got, want = compare(spark, con, QUERIES[name], ORACLES[name], sf_dir)
    if sf_dir == odd_tables and name == "op3_warc":  # equal ids: SQL's window has no such case
        got, want = ([r for r in x[1] if None not in r[:2]] for x in (got, want))
        got, want = Counter(map(str, got)), Counter(map(str, want))
    assert got == want


def connect_folders(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet/*.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty_tables, name):
    rows = QUERIES[name](spark, empty_tables).collect()
    assert len(rows) == (1 if name.startswith("op1_") else 0)  # op1 adds a conversation


def test_token_counts(spark, sf_dir):
    columns = ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert result(spark, "op2_token_counts", sf_dir, columns) == Counter(
        brute.token_counts(docs_of(spark, sf_dir)))


def test_chat_returns_every_text(spark, odd_tables):
    rows = {r.conv_id: r for r in QUERIES["op1_chat_format"](spark, odd_tables).collect()}
    said = "</s>[INST] ok [/INST]"
    assert rows[-7].turns_sha256 == brute.sha256(f"user\n{said}\nassistant\n{said}\n")
    assert rows[-7].loss_sha256 == brute.sha256(said) and rows[-7].valid
    assert [rows[i].valid for i in (1, 2, 3, 4, 5, None, 6, 7)] == [
        True, False, True, False, False, False, False, False]
    assert rows[4].n_turns == 2 and rows[2].loss_chars == 5


def test_warc_digests(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html").collect()
    want = Counter()
    for page_id, html in pages:
        raw = (html or "").encode()
        same = [p for p, h in pages if (h or "") == (html or "") and p is not None]
        keeper = max(same, default=None)
        again = len(raw) >= 1000 and keeper is not None and page_id != keeper
        want[(page_id, len(raw), hashlib.sha1(raw).hexdigest(),
              "revisit" if again else "response", keeper if again else None)] += 1
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert result(spark, "op3_warc", sf_dir, columns) == want


def test_url_aliases(spark, odd_tables):
    got = {r.page_id: r for r in QUERIES["op4_url_filter"](spark, odd_tables).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == (
        "a.example.net", "/en/x", "example.net/en/", "allow")
    assert (got[2].host, got[2].path, got[2].rule, got[2].verdict) == ("", "", None, "allow")
    assert got[4].verdict == "allow" and got[9].rule is None
    # z.org/p is linked with a blocked page; so is z.org/q, which names it; /fr/ is allowed
    assert [got[i].verdict for i in (7, 8, 11)] == ["block", "block", "allow"]
    assert got[10].verdict == "block" and got[10].rule is None


def test_syncmers(spark, sf_dir):
    docs = [(d, t) for d, t in docs_of(spark, sf_dir)]
    docs.sort(key=lambda r: r[0])  # the repeated row has the same text
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
               "near_edited", "near_next", "passages"]
    rows = QUERIES["op5_syncmers"](spark, sf_dir).select(columns).collect()
    got = Counter((*r[:5], round(r[5], 9), round(r[6], 9), r[7]) for r in rows)
    want = Counter(brute.syncmers(docs))
    assert got == want
    if sf_dir == SMALL:
        long = [r for r in rows if r.n_chars > 1000]
        assert sum(r.near_edited for r in long) / len(long) > 0.15
        assert sorted(r.near_next for r in long)[len(long) // 2] < 0.05


def test_simhash(spark, sf_dir):
    columns = ["doc_id", "fingerprint", "component_id"]
    assert result(spark, "op6_simhash", sf_dir, columns) == Counter(
        brute.simhash(docs_of(spark, sf_dir)))


def test_pii(spark, sf_dir):
    want = Counter()
    for doc_id, text in docs_of(spark, sf_dir):
        spans = brute.base_spans(text)
        n = [sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")]
        want[(doc_id, *n, brute.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans)))] += 1
    columns = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
    assert result(spark, "op7_pii", sf_dir, columns) == want


def test_quality(spark, odd_tables):
    rows = QUERIES["op8_quality"](spark, odd_tables).collect()
    import zlib

    assert Counter(r.doc_id for r in rows) == Counter(d for d, *_ in DOCS)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    right = [r.predicted == (r.doc_id >= 300) for r in rows if 200 <= r.doc_id < 360]
    assert sum(right) / len(right) > 0.95


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op8_quality"](spark, sf).where("held_out").join(labels, "doc_id").collect()
    right = [r.predicted == r.quality for r in rows]
    assert len(rows) > 100 and sum(right) / len(rows) > 0.97


def test_packing(spark, sf_dir):
    docs = docs_of(spark, sf_dir)
    rows = QUERIES["op9_packing"](spark, sf_dir).collect()
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want = brute.pieces(docs)
    assert got == Counter(want)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    total = sum(p[3] for p in want)
    assert len(sequences) <= -(-total // 2048) * 1.02 + 2


def test_decontaminate(spark, sf_dir):
    bench = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(
        "item_id", "text").collect()]
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert result(spark, "op10_decontaminate", sf_dir, columns) == Counter(
        brute.decontaminate(docs_of(spark, sf_dir), bench))
