"""Intake inputs derived from the given tables, with Spark expressions only.

documents give landing files, messages and an existing catalog; pages give a crawl log
with redirects; events give an operation log; conversations give edges; labels say which
documents are rogue and which messages only verify.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docintake.schema import ATTRS, CATALOG, HEADERS, META, ORIGIN
from docintake.session import cut
from docintake.sources.landing import content_facts

DEEP = 21
AS_OF = "2024-06-01 00:00:00"


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Path a document lands under; some are derivatives, some stored, some no valid URI.
LANDING_PATH = """
CASE doc_id % 8
  WHEN 0 THEN concat('ingress/derivatives/remote/http/', source, '.example.com/a.zip/', doc_id, '.txt')
  WHEN 1 THEN concat('ingress/remote/https/', source, '.example.com/', doc_id, '.html')
  WHEN 2 THEN concat('ingress/', source, '/', doc_id)
  WHEN 3 THEN concat('local/', source, '/', doc_id, '.txt')
  WHEN 4 THEN concat('ingress/', source, '/Noise=10%/', doc_id, '.cps')
  WHEN 5 THEN concat('ingress/derivatives/derivatives/', source, '/', doc_id, '.v1.csv')
  ELSE concat('ingress/', source, '/', doc_id, '.txt')
END
"""
BODY = "coalesce(text, '')"
# The given documents and, beside them, some empty files.
DOCUMENTS = """(
  SELECT doc_id, text, lang, source FROM documents
  UNION ALL SELECT doc_id + 1000000000, '', lang, source FROM documents WHERE doc_id % 97 = 5)"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    empty = given.where("doc_id % 97 = 5").select(
        (F.col("doc_id") + 1_000_000_000).alias("doc_id"), F.lit("").alias("text"), "lang", "source"
    )
    return given.unionByName(empty)


def landing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return docs.select(
        F.col("doc_id").alias("seq"),
        F.expr(LANDING_PATH).alias("path"),
        *content_facts(F.expr(BODY).cast("binary")),
        F.lit("2024-05-31").cast("timestamp_ntz").alias("mtime"),
    )


def _origin(scheme: str, uri: str) -> str:
    return (
        f"CAST(named_struct('scheme', {scheme}, 'hostname', CAST(NULL AS STRING), 'uri', {uri}, "
        f"'headers', CAST(NULL AS {HEADERS}), 'metadata', CAST(NULL AS array<{META}>)) AS {ORIGIN})"
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per document, in the order of their ids."""
    docs = documents(spark, sf_dir).select("doc_id", "source", "lang")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    joined = docs.join(labels, "doc_id", "left")
    kept = _origin("'https'", "concat('https://', source, '.example.com/d/', doc_id, '.html')")
    no_uri = _origin("'http'", "CAST(NULL AS STRING)")
    no_scheme = _origin("'ftp'", "concat(source, '/x')")
    other = _origin("'mongodb'", "CAST(NULL AS STRING)")
    return joined.select(
        F.col("doc_id").alias("seq"),
        F.expr(f"concat(CASE WHEN doc_id % 2 = 0 THEN '/' ELSE '' END, {LANDING_PATH})").alias(
            "source"
        ),
        F.expr(
            f"CASE doc_id % 26 WHEN 0 THEN array({other}, {kept}) WHEN 13 THEN array({kept}) "
            f"WHEN 7 THEN array({other}, {no_uri}) WHEN 9 THEN array({no_scheme}, {no_uri}) END"
        ).alias("origins"),
        F.array("lang", F.expr("concat('s', doc_id % 3)")).alias("tags"),
        F.expr(
            f"CAST(array(named_struct('key', 'lang', 'vtype', 'string', 'value', lang)) AS array<{META}>)"
        ).alias("metadata"),
        F.expr("CASE WHEN doc_id % 8 IN (0, 5) THEN true WHEN doc_id % 8 = 1 THEN false END").alias(
            "derivative"
        ),
        F.expr("coalesce(quality, 0) = 1 AND doc_id % 5 = 0").alias("verify"),
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as JSON text; some are cut off, some lack a source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    good = (
        "concat('{\"source\":\"ingress/', source, '/', doc_id, '.txt\",\"tags\":[\"', lang, '\"],',"
        "'\"derivative\":', CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE 'false' END, ',',"
        "CASE WHEN doc_id % 3 = 0 THEN '\"origin\"' ELSE '\"origins\"' END,"
        "':[{\"scheme\":\"https\",\"uri\":\"https://', source, '.example.com/', doc_id, '\",'"
        ",'\"headers\":{\"Server\":[\"x\"]}}]}')"
    )
    return docs.select(
        F.col("doc_id").alias("seq"),
        F.expr(
            "CASE WHEN doc_id % 19 = 0 THEN '{\"source\": \"ingress/cut' "
            f"WHEN doc_id % 23 = 0 THEN '{{\"tags\":[\"a\"]}}' ELSE {good} END"
        ).alias("value"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored documents: a third of the given ones, with older and newer versions."""
    docs = documents(spark, sf_dir).select(
        "doc_id", "source", "lang", F.expr(LANDING_PATH).alias("path"),
        F.expr(f"md5({BODY})").alias("hash"),
        F.expr(f"md5(concat({BODY}, 'old'))").alias("old_hash"),
        F.expr(f"md5(concat({BODY}, 'new'))").alias("new_hash"),
    )
    rogue = (
        table(spark, sf_dir, "labels")
        .groupBy("doc_id")
        .agg((F.max("toxic") == 1).alias("rogue_file"))
    )
    docs = docs.join(rogue, "doc_id", "left")
    place = (
        "CASE WHEN path LIKE 'ingress/remote%' THEN concat('remote', substr(path, 15)) "
        "WHEN path LIKE 'ingress%' THEN concat('local', substr(path, 8)) ELSE path END"
    )

    def version(kind: str, where: str, hash_: str, day: str) -> DataFrame:
        return docs.where(where).select(
            F.expr(f"concat('{kind}', lpad(CAST(doc_id AS STRING), 12, '0'))").alias("doc_id"),
            F.expr(place).alias("source"),
            F.col(hash_).alias("hash"),
            F.lit("text/plain").alias("mimetype"),
            F.expr(f"TIMESTAMP_NTZ '{day} 00:00:00'").alias("created"),
            F.expr(f"TIMESTAMP_NTZ '{day} 00:00:00'").alias("updated"),
            F.lit(False).alias("derivative"),
            F.lit(None).cast("array<string>").alias("derivatives"),
            F.lit(None).cast(ATTRS).alias("attrs"),
            F.expr("array(lang, 'stored')").alias("tags"),
            F.expr(
                "CAST(array(named_struct('key', 'lang', 'vtype', 'int', 'value', lang)) "
                f"AS array<{META}>)"
            ).alias("metadata"),
            F.expr(
                "CASE WHEN source = 'src1' THEN array("
                + _origin("'https'", "concat('https://', source, '.example.com/')")
                + ") END"
            ).alias("origin"),
            F.expr(
                f"CASE WHEN length(source) = 4 THEN concat('{kind}-uuid-', doc_id) END"
            ).alias("uuid"),
            "rogue_file",
        )

    same = version("c", "doc_id % 3 = 0", "hash", "2024-03-01")
    old = version("a", "doc_id % 5 = 0", "old_hash", "2024-01-01")
    new = version("e", "doc_id % 7 = 0", "new_hash", "2024-05-01")
    return same.unionByName(old).unionByName(new).to(spark.createDataFrame([], CATALOG).schema)


def stored_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files and the content of the newest stored document at each path."""
    stored = (
        catalog(spark, sf_dir)
        .groupBy(F.col("source").alias("path"))
        .agg(F.max(F.struct("created", "doc_id", "hash"))["hash"].alias("md5"))
    )
    landing = landing_files(spark, sf_dir).drop("seq")
    return landing.unionByName(
        stored.join(landing, "path", "left_anti").select(
            "path",
            F.lit(1).cast("bigint").alias("length"),
            "md5",
            F.lit(None).cast("string").alias("kind"),
            F.lit("2024-05-01").cast("timestamp_ntz").alias("mtime"),
        )
    )


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of stored documents, some of them seconds before the batch."""
    return catalog(spark, sf_dir).select(
        "doc_id",
        F.lit("intake").alias("consumer"),
        F.lit("1").alias("version"),
        F.expr(
            "CASE WHEN CAST(substr(doc_id, 2) AS BIGINT) % 4 = 0 "
            "THEN TIMESTAMP_NTZ '2024-05-31 23:59:55' ELSE created END"
        ).alias("started"),
        F.expr("CAST(NULL AS TIMESTAMP_NTZ)").alias("ended"),
    )


PAGE_HEADERS = f"""
CAST(CASE WHEN page_id % 11 = 0 THEN array(
    named_struct('name', 'Content-Disposition', 'values',
      array(concat('attachment; filename="page ', page_id, '.pdf"'))),
    named_struct('name', 'content-type', 'values', array('application/pdf')))
  WHEN page_id % 5 = 0 THEN array(
    named_struct('name', 'Location', 'values', array(concat('/moved/', page_id))),
    named_struct('name', 'Content-Type', 'values', array('text/plain; charset=utf-8')))
  ELSE array(named_struct('name', 'Content-Type', 'values', array('text/html; charset=utf-8')))
END AS {HEADERS})
"""


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl log: every page, and redirects of several kinds that lead to them.

    Some pages and redirects were captured before, with other answers.
    """
    pages = table(spark, sf_dir, "pages")
    fetched = F.expr("TIMESTAMP_NTZ '2024-05-01 00:00:00' + make_dt_interval(0, 0, 0, page_id % 1000000)")
    bodies = pages.select(
        F.col("url").alias("uri"),
        F.expr("CASE WHEN page_id % 17 = 3 THEN 404 ELSE 200 END").alias("status"),
        F.lit(None).cast("string").alias("location"),
        F.expr(PAGE_HEADERS).alias("headers"),
        *content_facts(F.col("html").cast("binary")),
        fetched.alias("fetched"),
    )

    def hop(where: str, uri: str, status: int, location: str, before: bool = False) -> DataFrame:
        time = F.lit("2024-01-01").cast("timestamp_ntz") if before else fetched
        return pages.where(where).select(
            F.expr(uri).alias("uri"),
            F.lit(status).alias("status"),
            F.expr(f"CAST({location} AS STRING)").alias("location"),
            F.lit(None).cast(HEADERS).alias("headers"),
            F.lit(None).cast("bigint").alias("length"),
            F.lit(None).cast("string").alias("md5"),
            F.lit(None).cast("string").alias("kind"),
            time.alias("fetched"),
        )

    hops = [
        hop("page_id % 9 = 0", "url", 301, "concat('http://before.example.com/', page_id)", True),
        hop("page_id % 10 = 0", "concat('http://r1.example.com/', page_id)", 302,
            "concat('http://before.example.com/', page_id)", True),
        hop("true", "concat('http://r1.example.com/', page_id)", 301, "url"),
        hop("page_id % 7 = 0", "concat('http://r2.example.com/', page_id)", 302,
            "concat('http://r1.example.com/', page_id)"),
        hop("page_id % 13 = 0", "concat('http://r3.example.com/', page_id)", 307,
            "concat('http://r1.example.com/', page_id)"),
        hop("page_id % 29 = 0", "concat('http://lost.example.com/', page_id)", 301, "NULL"),
        hop("page_id % 50 = 0", "concat('http://loop.example.com/', page_id)", 302,
            "concat('http://loop.example.com/', page_id)"),
        hop("page_id % 31 = 0", "concat('http://odd.example.com/', page_id)", 302,
            "concat('gopher://h/', page_id)"),
        # a third of all starts meet at one address
        hop("page_id % 3 = 0", "concat('http://go.example.com/', page_id)", 302,
            "'http://hub.example.com/'"),
        hop("page_id = 1", "'http://hub.example.com/'", 301, "url"),
        # longer than a payload fetch may be
        *[
            hop("page_id = 2", f"'http://deep.example.com/{i}'", 301,
                f"'http://deep.example.com/{i + 1}'" if i < DEEP else "url")
            for i in range(1, DEEP + 1)
        ],
    ]
    out = bodies
    for h in hops:
        out = out.unionByName(h)
    return out


def start_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything in the crawl log, some ftp files and pages nobody fetched."""
    pages = table(spark, sf_dir, "pages")
    extra = pages.select(
        F.expr(
            "CASE WHEN page_id % 2 = 0 THEN concat('ftp://bob:x@files.example.org:2121/p/', page_id, '.txt') "
            "ELSE concat('http://gone.example.com/', page_id) END"
        ).alias("uri")
    )
    return captures(spark, sf_dir).select("uri").union(extra)


def remote_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message for each page and for each of its redirects, numbered after the local ones."""
    pages = table(spark, sf_dir, "pages")
    starts = pages.select(
        "page_id",
        F.explode(
            F.expr(
                "array(concat('http://r1.example.com/', page_id), url, "
                "CASE WHEN page_id % 3 = 0 THEN concat('http://go.example.com/', page_id) "
                "WHEN page_id % 7 = 0 THEN concat('http://r2.example.com/', page_id) "
                "ELSE concat('http://gone.example.com/', page_id) END)"
            )
        ).alias("source"),
    )
    kind = F.when(F.col("source").startswith("http://r1."), 0).when(
        F.col("source").rlike("^http://(go|r2|gone)\\."), 2
    ).otherwise(1)
    seq = (F.lit(1_000_000_000_000) + F.col("page_id") * 3 + kind).alias("seq")
    return starts.select(
        seq,
        "source",
        F.lit(None).cast(f"array<{ORIGIN}>").alias("origins"),
        F.array(F.lit("web")).alias("tags"),
        F.lit(None).cast(f"array<{META}>").alias("metadata"),
        F.lit(False).alias("derivative"),
        F.lit(False).alias("verify"),
    )


def mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges from conversations to their turns, and from archives to landing derivatives."""
    turns = table(spark, sf_dir, "conversations").select(
        F.expr("concat('m', conv_id, '-', turn)").alias("mapping_id"),
        F.expr("concat('p', conv_id)").alias("parent"),
        F.expr("CASE WHEN turn % 3 = 0 THEN concat('k', conv_id, '-', turn) END").alias("child"),
        F.expr("concat('ingress/derivatives/conv', conv_id, '/', turn, '.txt')").alias("child_path"),
        F.lit(None).cast(f"array<{META}>").alias("metadata"),
        F.expr("CASE WHEN turn = 0 THEN 'unpack' END").alias("consumer"),
    )
    derived = table(spark, sf_dir, "documents").where("doc_id % 8 IN (0, 5)").select(
        F.expr("concat('d', doc_id)").alias("mapping_id"),
        F.expr("concat('a', lpad(CAST(doc_id - doc_id % 8 AS STRING), 12, '0'))").alias("parent"),
        F.lit(None).cast("string").alias("child"),
        F.expr(LANDING_PATH).alias("child_path"),
        F.lit(None).cast(f"array<{META}>").alias("metadata"),
        F.lit("unpack").alias("consumer"),
    )
    return turns.unionByName(derived)


def operation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations with their time, kind, scheme and size, one per event."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.expr("CASE WHEN user_id % 2 = 0 THEN 'intake' ELSE 'unpack' END").alias("consumer"),
        F.expr(
            "element_at(array('move', 'copy', 'remove', 'update_document', 'insert_document', "
            "'update_parent_child_mappings'), CAST(event_id % 6 AS INT) + 1)"
        ).alias("operation"),
        F.expr(
            "element_at(array('http', 'https', 'ftp', 'ftps', 'sftp'), CAST(event_id % 5 AS INT) + 1)"
        ).alias("scheme"),
        F.expr(
            "element_at(array('text/html', 'application/pdf', 'text/plain'), "
            "CAST(event_id % 3 AS INT) + 1)"
        ).alias("mimetype"),
        F.col("value").alias("seconds"),
        F.expr("CAST(event_id * 37 % 100000 AS BIGINT)").alias("bytes"),
    )


# Families of documents whose end is known beforehand, by doc_id % 6: new, a new version of a
# stored one, a copy of a stored one, empty, rogue, and twice the same content.
FAMILY_PATH = "concat('fam/', doc_id, '.txt')"
FAMILY_BODY = "CASE WHEN doc_id % 6 = 3 THEN '' ELSE concat(coalesce(text, ''), '#', doc_id) END"


def families(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw messages (with their batch), files and catalog of the families."""
    # files and catalog are read several times; the contents are hashed once
    docs = cut(table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.expr(FAMILY_PATH).alias("place"),
        *content_facts(F.expr(FAMILY_BODY).cast("binary")),
        (F.col("doc_id") % 6).alias("family"),
    ))
    mtime = F.lit("2024-05-31").cast("timestamp_ntz").alias("mtime")
    facts = ["length", "md5", mtime, "kind"]
    copies = docs.where("family = 5").withColumn("place", F.concat(F.lit("copy/"), "place"))
    arrived = docs.unionByName(copies)
    landed = arrived.select(F.concat(F.lit("ingress/"), "place").alias("path"), *facts)
    hash_ = F.when(F.col("family") == 1, F.md5(F.concat(F.lit("old"), "doc_id"))).otherwise(
        F.col("md5")
    )
    known = docs.where("family IN (1, 2, 4)").withColumn("md5", hash_)
    stored = known.select(F.concat(F.lit("local/"), "place").alias("path"), *facts)
    day = F.lit("2024-03-01").cast("timestamp_ntz")
    rows = known.select(
        F.concat(F.lit("f"), F.lpad(F.col("doc_id").cast("string"), 12, "0")).alias("doc_id"),
        F.concat(F.lit("local/"), "place").alias("source"),
        F.col("md5").alias("hash"), F.lit("text/plain").alias("mimetype"),
        day.alias("created"), day.alias("updated"), F.lit(False).alias("derivative"),
        F.lit(None).cast("array<string>").alias("derivatives"),
        F.lit(None).cast(ATTRS).alias("attrs"), F.array(F.lit("stored")).alias("tags"),
        F.lit(None).cast(f"array<{META}>").alias("metadata"),
        F.lit(None).cast(f"array<{ORIGIN}>").alias("origin"),
        F.lit(None).cast("string").alias("uuid"), (F.col("family") == 4).alias("rogue_file"),
    )
    copy = F.col("place").startswith("copy/")
    asked = arrived.select(
        (F.col("doc_id") * 2 + copy.cast("int")).alias("seq"),
        copy.cast("int").alias("batch"),
        F.to_json(
            F.struct(F.concat(F.lit("ingress/"), "place").alias("source"), F.array("lang").alias("tags"))
        ).alias("value"),
    )
    empty = spark.createDataFrame([], CATALOG).schema
    return {
        "raw": asked, "files": landed.unionByName(stored), "catalog": rows.to(empty),
    }


def renames(spark, sf_dir):
    """Changes of paths at once: chains of parts, rings of customers, suppliers sharing files."""
    part, ring, group = F.col("p_partkey"), F.col("c_custkey"), F.col("s_suppkey")

    def path(kind, key):
        return F.concat(F.lit(f"local/{kind}"), key.cast("string"))

    chains = table(spark, sf_dir, "part").select(
        path("p", part).alias("path"),
        F.when(part % 10 == 9, F.concat(F.lit("ingress/p"), part.cast("string")))
        .when(part % 10 > 0, path("p", part + 1)).alias("source"),
    )
    rings = table(spark, sf_dir, "customer").select(
        path("c", ring).alias("path"), path("c", ring - ring % 4 + (ring + 1) % 4).alias("source")
    )
    shared = table(spark, sf_dir, "supplier").select(
        path("s", group).alias("path"), path("s", group - group % 5).alias("source")
    )
    return chains.unionByName(rings).unionByName(shared)
