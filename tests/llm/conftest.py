import os
import uuid

import pytest

LONG = " ".join(f"word{i % 977} the{i % 31}" for i in range(30_000))
CARD = "4111 1111 1111 1111"


def _write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")


@pytest.fixture(scope="session")
def shared(tmp_path_factory, spark):
    """A folder that the session's checkpoints go to as well."""
    return str(tmp_path_factory.mktemp("llm"))


DOCS = [
    (0, "", "en"), (1, None, "en"), (2, "  \n\t ", None), (3, LONG, "en"),
    (4, "Mail a.b@c.example.org or +1 (375) 555-4393, card " + CARD + " at 10.1.2.3.4 <|endoftext|> x", "en"),
    (5, "One two Three four five six seven eight nine TEN eleven twelve", "en"),
    (6, "one two three four five six seven eight nine ten eleven twelve", "de"),
    (7, "x one, two; three four-five six seven eight nine ten! eleven twelve y", "de"),
    (7, "x one, two; three four-five six seven eight nine ten! eleven twelve y", "de"),
    (8, "short item", "fr"), (9, "a", None), (10, LONG, "en"), (11, LONG + " tail", "en"),
    (12, "\x00\x7f ÄÖ é\U0001F600 日本   x", "fr"), (13, "password=abc123def <s>", None),
    (1013, "far away id", "en"), (5_000_000_000, "very far id with some more words in it", "en"),
] + [(100 + i, "Copied text, the same in many rows, with many words in it.", "en") for i in range(40)] + [
    (200 + i, f"Junk$$$ stuff%%% again*** %%% $$$ number{i}### thing&&&", "en") for i in range(60)
] + [(300 + i, f"Plain words in a row, number{i} of them, are good here.", "en") for i in range(60)]


@pytest.fixture(scope="session")
def odd_tables(spark, shared):
    """Small tables with nulls, empty and long texts, repeated rows and clashing columns."""
    folder = f"{shared}/odd-{uuid.uuid4().hex}"
    clash = ["score", "spans", "hits", "items", "fp", "component_id", "row", "cell", "_score", "key"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"{c} string" for c in clash)
    rows = [(i, t, lang, "s", len(t or ""), *["c"] * len(clash)) for i, t, lang in DOCS]
    _write(spark, folder, "documents", rows, schema)
    labels = [(i, int(i >= 300), None) for i in range(200, 360)] + [(5, None, 1), (None, 1, 0)]
    _write(spark, folder, "labels", labels, "doc_id long, quality int, toxic int")
    items = [
        (1, "one two three four five six seven eight nine ten"), (2, "Short, item!"), (3, ""),
        (4, None), (2, "eight nine ten eleven"), (None, "far away id"), (10, "a"),
    ]
    _write(spark, folder, "benchmark", items, "item_id long, text string")
    html = "<html>" + "x" * 1200 + "</html>"
    pages = [
        (1, "http://A.Example.NET/en/x#top", html), (2, None, None), (3, "no scheme", ""),
        (4, "https://x.org/fr/y?utm_source=feed&a=1", html), (5, "https://x.org", "y" * 999),
        (6, "https://x.org/FR/y", html), (6, "https://x.org/FR/y", html), (None, "http://q.net", html),
        (7, "http://z.org/p", '<link rel="canonical" href="http://bad.net/p">'),
        (8, "http://z.org/q", '<LINK href=/p rel=canonical>'), (9, "http://net", "y" * 999),
        (10, "http://example.net:80/en/", '<meta http-equiv="refresh" content="0; url=http://bad.net/p">'),
        (11, "http://z.org/fr/q", '<meta http-equiv="refresh" content="0; url=http://z.org/p#x">'),
    ]
    _write(spark, folder, "pages", [(*p, "v") for p in pages],
           "page_id long, url string, html string, host string")
    talk = [
        (1, 0, "user", "hi \\ [INST] <s></s> \\\\"), (1, 1, "assistant", "yo [/INST] [\\INST] ["),
        (2, 0, "assistant", "first"), (2, 1, "user", None), (3, 1, "user", "b"), (3, 0, "system", ""),
        (3, 2, "assistant", None), (4, 0, None, "no role"), (4, 0, None, "no role"),
        (5, 0, "tool] [SAYS] ", " [/TURN]"), (None, 0, "user", "x"), (6, None, "user", LONG[:50_000]),
        (6, None, "assistant", "\n</s>\n"), (7, 0, "user", " [/TURN] [OUT] ["),
    ]
    _write(spark, folder, "conversations", [(*t, "v") for t in talk],
           "conv_id long, turn long, role string, text string, formatted string")
    return folder


@pytest.fixture(scope="session")
def empty_tables(spark, shared, odd_tables):
    folder = f"{shared}/empty-{uuid.uuid4().hex}"
    for name in os.listdir(odd_tables):
        spark.read.parquet(f"{odd_tables}/{name}").where("false").write.parquet(f"{folder}/{name}")
    return folder
