"""Landing scan, versioned tables and summaries on small inputs."""

import datetime
import hashlib

from pyspark.sql import functions as F

from docintake.config import EMPTY_MD5
from docintake.operators.skew import lookup, numbered
from docintake.sources import landing
from docintake.sources.landing import list_files, scan_landing_files
from docintake.sources.tables import TableStore


def test_scan_lists_empty_files(spark, tmp_path):
    folder = tmp_path / "ingress" / "a b%"
    folder.mkdir(parents=True)
    (folder / "full.txt").write_text("This is a test file.\n")
    (folder / "empty.txt").write_text("")
    rows = {r["path"]: r for r in scan_landing_files(spark, str(tmp_path), "ingress").collect()}
    assert rows["ingress/a b%/full.txt"]["md5"] == "2d282102fa671256327d4767ec23bc6b"
    assert rows["ingress/a b%/empty.txt"]["md5"] == EMPTY_MD5
    assert rows["ingress/a b%/empty.txt"]["length"] == 0


def test_listing_by_levels(spark, tmp_path):
    """Thousands of files at several depths, hidden ones left out, none passing the driver."""
    want = {}
    for i in range(3000):
        path = tmp_path / "zone" / f"a{i % 7}" / f"k=ü {i % 3}" / f"{i}.txt"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x" * (i % 5))
        want[str(path.relative_to(tmp_path))] = i % 5
    (tmp_path / "zone" / "top.txt").write_text("top")
    want["zone/top.txt"] = 3
    for hidden in ("_SUCCESS", ".crc", "_tmp/x"):
        path = tmp_path / "zone" / hidden
        path.parent.mkdir(exist_ok=True)
        path.write_text("h")
    got = scan_landing_files(spark, f"file:{tmp_path}/", "zone").collect()
    assert {r.path: r.length for r in got} == want and len(got) == len(want)
    for r in got[:20]:
        path = tmp_path / r.path
        assert r.md5 == hashlib.md5(path.read_bytes()).hexdigest()
        moment = datetime.datetime.fromtimestamp(path.stat().st_mtime, datetime.timezone.utc)
        assert abs((r.mtime.replace(tzinfo=datetime.timezone.utc) - moment).total_seconds()) < 0.01
    assert list_files(spark, str(tmp_path), "nowhere").count() == 0


def test_store_versions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"))
    schema = "doc_id string, hash string"
    store.commit_full({"catalog": spark.createDataFrame([("a", "1"), ("b", "1")], schema)})
    changed = spark.createDataFrame([("b", "2"), ("c", "2")], schema)
    store.commit_changes({"catalog": changed}, batch_id=0)
    store.commit_changes({}, {"catalog": spark.createDataFrame([("a", ""), ("c", "")], schema)}, 1)
    store.commit_changes({"catalog": spark.createDataFrame([("c", "4")], schema)}, batch_id=2)

    def rows(version=None):
        return sorted(tuple(r) for r in store.load("catalog", version).collect())

    assert rows(1) == [("a", "1"), ("b", "1")]
    assert rows(2) == [("a", "1"), ("b", "2"), ("c", "2")]
    assert rows(3) == [("b", "2")]
    assert rows() == [("b", "2"), ("c", "4")]
    assert store.last_batch() == 2


def test_salted_lookup_keeps_all_rows(spark):
    left = spark.range(300).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
    )
    right = spark.createDataFrame([("hot", 1), ("1", 2), ("x", 3)], "key string, v int")
    plain = lookup(left, right, "key", hot_rows=None)
    salted = lookup(left, right, "key", hot_rows=50)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, salted.collect()))


def test_numbering_over_pieces(spark):
    df = spark.range(100).select(F.col("id").alias("seq"), (F.col("id") % 2).alias("key"))
    rows = numbered(df, "key", "seq", 7).collect()
    assert all(r["nth"] == r["seq"] // 2 + 1 for r in rows)


def test_texts_are_placed_by_the_tasks(spark, tmp_path):
    """Each file is written once, in its place, under the name Spark's own writer would give it."""
    rows = [("src1/7", "one"), ("a%b=c[d]/8", "two\nlines"), ("", "no name"), ("ü +/9", ""), ("r/1", "x"), ("r/1", "x")]
    texts = spark.createDataFrame(rows, "file string, value string")
    texts.write.partitionBy("file").text(f"{tmp_path}/spark")
    landing.place_texts(texts, f"{tmp_path}/ingress")
    names = {p.name for p in (tmp_path / "ingress").iterdir()}
    assert names == {p.name for p in (tmp_path / "spark").iterdir() if p.is_dir()}
    written = [p for p in (tmp_path / "ingress").rglob("*") if p.is_file()]
    assert [p.name for p in written] == ["text.txt"] * 5
    got = {r["path"]: r["md5"] for r in scan_landing_files(spark, str(tmp_path), "ingress").collect()}
    want = {"src1%2F7": "one\n", "a%25b%3Dc%5Bd%5D%2F8": "two\nlines\n", "ü +%2F9": "\n",
            "__HIVE_DEFAULT_PARTITION__": "no name\n", "r%2F1": "x\nx\n"}
    assert got == {
        f"ingress/file={k}/text.txt": hashlib.md5(v.encode()).hexdigest() for k, v in want.items()
    }
