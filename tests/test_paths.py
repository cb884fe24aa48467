"""Golden rows of the path, header and URI expressions."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from docintake.functions import headers, naming, paths, uris
from docintake.schema import HEADERS

SITE = "https://docs.example.org"
HOME = "remote/https/docs.example.org"
MARK = hashlib.md5(b"?item=7").hexdigest()
PDF = "survey-of-wells_2b.pdf"


def disposition(value, name="Content-Disposition"):
    return [(name, value if isinstance(value, list) else [value])]


INLINE = disposition(f"inline; filename={PDF}")

REMOTE_PATHS = [
    ("/topics", None, None, None, "/topics.html"),
    ("/topics", None, None, "application/pdf", "/topics.pdf"),
    ("/topics?item=7", None, None, None, f"/topics.{MARK}.html"),
    ("/topics/", None, None, None, "/topics/index.html"),
    ("", None, None, None, "/index.html"),
    ("?item=7", None, None, None, f"/index.{MARK}.html"),
    ("/", None, None, None, "/index.html"),
    ("/topics/daily-204", None, "harvest.pdf", None, "/topics/daily-204/harvest.pdf"),
    ("/topics/w?item=7", None, "harvest.pdf", None, f"/topics/w/harvest.{MARK}.pdf"),
    ("/topics/w?item=7", None, "harvest.pdf", "text/html", f"/topics/w/harvest.{MARK}.pdf"),
    ("/topics/", None, "crop.pdf", None, "/topics/crop.pdf"),
    ("/topics", INLINE, None, None, f"/topics/{PDF}"),
    ("/topics", disposition(f"inline; filename={PDF}", "content-disposition"), None, None,
     f"/topics/{PDF}"),
    ("/topics", disposition(["", f"inline; filename={PDF}"]), None, None, f"/topics/{PDF}"),
    ("/topics", disposition(f"inline; FILENAME={PDF}"), None, None, f"/topics/{PDF}"),
    ("/topics", disposition(f'inline; filename="{PDF}"'), None, None, f"/topics/{PDF}"),
    ("/topics", disposition(f"inline; filename=utf-8''{PDF}"), None, None, f"/topics/{PDF}"),
    ("/topics", disposition(f"inline; filename=UTF-8''{PDF}"), None, None, f"/topics/{PDF}"),
    ("/topics/", INLINE, None, None, f"/topics/{PDF}"),
    ("", INLINE, None, None, f"/{PDF}"),
    ("/w?item=7", INLINE, None, None, f"/w/{PDF}"),
    ("/w", INLINE, "harvest.pdf", None, "/w/harvest.pdf"),
    ("/w?item=7", INLINE, "harvest.pdf", None, f"/w/harvest.{MARK}.pdf"),
    (f"/{PDF}", [("Location", ["/elsewhere"])], None, None, f"/elsewhere/{PDF}"),
    (f"/{PDF}", [("Location", ["/"])], None, None, f"/{PDF}"),
    (f"/{PDF}", [("Location", [""])], None, None, f"/{PDF}"),
    ("/w?item=7", INLINE + [("Location", ["https://one.two.example"])], None, None, f"/w/{PDF}"),
    ("/a%20b.pdf", None, None, None, "/a b.pdf"),
]


def run(spark, rows, schema, expr):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    out = df.select("i", expr.alias("v")).orderBy("i").collect()
    return [r["v"] for r in out]


def test_remote_file_path(spark):
    rows = [(SITE + u, h, n, c) for u, h, n, c, _ in REMOTE_PATHS]
    rows.append((f"{SITE}/{PDF}", [("Location", ["https://one.two.example"])], None, None))
    rows.append(("ftp://bob:x@host:2121/a/b.txt", None, None, None))
    got = run(
        spark, rows, f"uri string, headers {HEADERS}, name string, ctype string",
        naming.remote_file_path(
            F.col("uri"), F.col("headers"), "remote", F.col("name"), F.col("ctype")
        ),
    )
    want = [HOME + w for *_, w in REMOTE_PATHS]
    want += [f"remote/https/one.two.example/{PDF}", "remote/ftp/host/a/b.txt"]
    assert got == want


@pytest.mark.parametrize(
    "expr, cases",
    [
        (lambda: paths.local_target_path(F.col("s")), [
            ("ingress/tea/green-leaf.tx", "local/tea/green-leaf.tx"),
            ("local/tea/green-leaf.tx", "local/tea/green-leaf.tx"),
            ("ingress/derivatives/raw.txt", "local/derivatives/raw.txt"),
        ]),
        (lambda: paths.remote_target_path(F.col("s"), F.lit("/remote/tea/a.tx")), [
            ("remote-ingress/tea/a.tx", "remote/tea/a.tx"),
            ("remote/tea/b.tx", "remote/tea/b.tx"),
        ]),
        (lambda: paths.zone_target_path(F.col("s"), "local"), [
            ("ingress/derivatives/remote/http/some/box.zip/inner.txt",
             "local/derivatives/remote/http/some/box.zip/inner.txt"),
            ("ingress/derivatives/derivatives/a.txt", "local/derivatives/a.txt"),
            ("local/a.txt", "local/a.txt"),
        ]),
        (lambda: paths.archive_path(F.col("s"), F.lit("H")), [
            ("remote/tea/green-leaf.tx", "archive/remote/tea/green-leaf.tx/H.tx"),
            ("remote/tea/green-leaf", "archive/remote/tea/green-leaf/H"),
            ("remote/do.tted/tea/leaf", "archive/remote/do.tted/tea/leaf/H"),
            ("local/derivatives/remote/dir/file.txt",
             "archive/local/derivatives/remote/dir/file.txt/H.txt"),
            ("remote/derivatives/derivatives/remote/dir/file.txt",
             "archive/remote/derivatives/remote/dir/file.txt/H.txt"),
            ("nofolder", None),
        ]),
        (lambda: paths.lookup_target(F.col("s")), [
            ("ingress/remote/https/h/x", "remote/https/h/x"),
            ("ingress/x", "local/x"),
            ("local/x", "local/x"),
            ("ingress/remote-x/a", "remote-x/a"),
            ("ingress2/a", "local2/a"),
        ]),
        (lambda: paths.strip_root(F.col("s"), "/data"), [
            ("/data/ingress/x", "ingress/x"), ("ingress/x", "ingress/x"), ("/data2/x", "/data2/x"),
        ]),
        (lambda: uris.route(uris.classify_source(F.col("s"))), [
            ("ingress/Rate model/Gain=10%/run_1.dat", "local"),
            ("ingress/Rate model/x.txt", "local"),
            ("https://h/a b", "remote"),
            ("file:///x", "local"),
            ("C:/x", "remote"),
        ]),
        (lambda: uris.scheme_status(F.col("s")), [
            ("http://h", "supported"), ("sftp://h", "supported"),
            ("gopher://h", "unsupported_scheme"), ("h/x", "undefined_scheme"),
        ]),
    ],
)
def test_path_rules(spark, expr, cases):
    assert run(spark, [(s,) for s, _ in cases], "s string", expr()) == [w for _, w in cases]


def test_local_to_remote(spark):
    expr = paths.local_to_remote_target_path(
        F.lit("ingress/x"), F.col("u"), F.lit(None).cast(HEADERS)
    )
    schemes = ["ftp", "http", "https"]
    got = run(spark, [(f"{s}://my.host/in/some/place.txt",) for s in schemes], "u string", expr)
    assert got == [f"remote/{s}/my.host/in/some/place.txt" for s in schemes]


def test_classify_keeps_raw_without_uri(spark):
    raw = "ingress/Gain=10%/run.dat"
    row = run(spark, [(raw,)], "s string", uris.classify_source(F.col("s")))[0]
    assert row["raw"] == raw and row["is_uri"] is False and row["path"] is None


def test_header_values(spark):
    rows = [
        ([("Content-Disposition", ['attachment; filename*="TABLE OF DEPTHS.pdf"'])],),
        ([("content-disposition", ['attachment; filename="plain.html"'])],),
        ([("Content-Disposition", ['attachment; filename*="second.pdf"; filename="first.pdf"'])],),
        ([("Content-Disposition", ['attachment; filename="first.pdf"; filename*="second.pdf"'])],),
        ([("Content-Type", ['attachment; filename="first.pdf"'])],),
        ([("content-type", ["application/pdf"])],),
    ]
    got = run(spark, rows, f"h {HEADERS}", headers.header_filename(F.col("h")))
    assert got == ["TABLE OF DEPTHS.pdf", "plain.html", "second.pdf", "second.pdf", None, None]
    assert run(spark, rows, f"h {HEADERS}", headers.header_content_type(F.col("h")))[-1] == (
        "application/pdf"
    )


def test_shorten_name(spark):
    def md5(s):
        return hashlib.md5(s.encode()).hexdigest()

    long = "x" * 230
    mark = md5("?item=7")
    cases = [
        ("/77/2/SomeName.pdf", "SomeName.pdf", "SomeName.pdf"),
        (f"/en/{long}.pdf", f"{long}.{mark}.pdf", f"{md5(long)}.{mark}.pdf"),
        (f"/en/{long * 2}.pdf", f"{long * 2}.pdf", f"{md5(long * 2)}.pdf"),
        (f"/en/{long * 2}", long * 2, md5(long * 2)),
        ("", "", ""),
    ]
    got = run(spark, [c[:2] for c in cases], "p string, n string",
              naming.shorten_name(F.col("p"), F.col("n")))
    assert got == [c[2] for c in cases]


def test_runs_of_derivatives(spark):
    """As the pattern would have it, and without recursion in paths of a megabyte."""
    rng = random.Random(1)
    parts = ["derivatives", "xderivatives", "a", "local", "ingress"]
    rows = [
        "".join(rng.choice(parts) + rng.choice(["/", "//"]) for _ in range(rng.randint(1, 9)))
        + rng.choice(["", "f.txt", "derivatives"])
        for _ in range(500)
    ]

    def plain(path):
        bare = re.sub(r"(^|/)(?:derivatives/+)+", r"\1derivatives/", re.sub("^ingress/+", "", path))
        placed = bare if bare.startswith("local/") else "local/" + bare
        return re.sub("(?<=.)/$", "", re.sub("/+", "/", placed))

    long = ["ingress/" + "derivatives/" * 90_000 + "x.txt", "ingress/" + "a/" * 500_000 + "b"]
    want = [plain(p) for p in rows] + ["local/derivatives/x.txt", "local/" + "a/" * 500_000 + "b"]
    df = spark.createDataFrame(list(enumerate(rows + long)), "i int, p string").orderBy("i")
    for query in (lambda c: paths.zone_target_path(c, "local"), paths.local_target_path):
        got = [r[0] for r in df.select(query(F.col("p"))).collect()]
        same = [i for i, p in enumerate(rows + long) if not p.startswith("local/")]
        assert [got[i] for i in same] == [want[i] for i in same]
