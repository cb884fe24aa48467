"""Every operator as a query over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docintake.config import DEFAULT, IntakeConfig
from docintake.functions import (
    headers,
    identity,
    merging,
    mimetypes,
    naming,
    paths,
    uris,
    validation,
)
from docintake.operators import (
    catalog as catalog_ops,
    lineage,
    matching,
    ordering,
    metrics,
    redirects,
    runs,
    targets,
)
from docintake.plans import workload as w
from docintake.plans.ingest import IngestResult, ingest_batch, message_facts
from docintake.schema import HEADERS, ORIGIN
from docintake.session import cut, ensure_checkpoint_dir, prepare_python
from docintake.sources import landing, messages as message_source, sinks, tables
from docintake.streaming import suppression
from docintake.streaming.intake import ingest_stream, new_store


def _big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _scratch(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/query-{uuid.uuid4().hex}"


def _paths(spark, sf_dir, **columns: Column) -> DataFrame:
    df = w.landing_files(spark, sf_dir)
    return df.select("seq", "path", *[c.alias(n) for n, c in columns.items()])


def _pages(spark, sf_dir) -> DataFrame:
    return w.table(spark, sf_dir, "pages").select(
        "page_id", "url", F.expr(w.PAGE_HEADERS).alias("headers")
    )


def _log(spark, sf_dir) -> DataFrame:
    return cut(redirects.current_captures(w.captures(spark, sf_dir)))


# --- sources and sinks ---------------------------------------------------------------


def decode_messages(spark, sf_dir):
    parsed = message_source.parse_messages(w.raw_messages(spark, sf_dir))
    first = F.get("origins", F.lit(0))
    return parsed.select(
        "seq",
        F.col("error").isNull().alias("good"),
        F.when(F.col("error").isNull(), F.col("source")).alias("source"),
        F.concat_ws(",", "tags").alias("tags"),
        "derivative",
        first["uri"].alias("origin_uri"),
        F.get(first["headers"], F.lit(0))["name"].alias("header"),
    )


def message_stream(spark, sf_dir):
    folder = _scratch(spark)
    w.raw_messages(spark, sf_dir).write.parquet(f"{folder}/queue")
    stream = message_source.message_stream(
        spark, "parquet", {"maxFilesPerTrigger": "1000"}, f"{folder}/queue",
        "seq bigint, value string",
    )
    good = message_source.parse_messages(stream).select(
        "seq", F.col("error").isNull().alias("good")
    )
    query = (
        good.writeStream.format("parquet")
        .option("path", f"{folder}/decoded")
        .option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema("seq bigint, good boolean").parquet(f"{folder}/decoded")


def scan_landing_files(spark, sf_dir):
    """The given texts as files of a landing folder, one for each document, and their facts."""
    folder = _scratch(spark)
    docs = w.table(spark, sf_dir, "documents").select(
        F.concat_ws("/", "source", "doc_id").alias("file"), F.coalesce("text", F.lit("")).alias("value")
    )
    landing.place_texts(docs, f"{folder}/ingress")
    found = landing.scan_landing_files(spark, folder, "ingress")
    name = F.try_url_decode(F.regexp_extract("path", r"ingress/file=([^/]*)/", 1))
    return found.where("path NOT LIKE '%/_SUCCESS'").select(
        F.substring_index(name, "/", -1).cast("bigint").alias("doc_id"), "length", "md5", "kind"
    )


def landing_facts(spark, sf_dir):
    return w.landing_files(spark, sf_dir).select(
        "seq", "path", "length", "md5", "kind"
    )


def load_catalog(spark, sf_dir):
    """A snapshot, one commit of newer rows, and one of deletions, read back."""
    rows = w.catalog(spark, sf_dir)
    folder = _scratch(spark)
    store = tables.TableStore(spark, folder)
    store.commit_full({"catalog": rows.where("doc_id NOT LIKE 'e%'")})
    changed = rows.where("doc_id LIKE 'e%' OR source LIKE '%7.txt'").withColumn(
        "mimetype", F.lit("text/html")
    )
    store.commit_changes({"catalog": changed})
    store.commit_changes({}, {"catalog": rows.where("source LIKE '%5.txt'")})
    return tables.load_catalog(spark, folder).select("doc_id", "source", "hash", "mimetype")


def attach_payloads(spark, sf_dir):
    log = _log(spark, sf_dir)
    resolved = redirects.resolve_redirects(w.start_uris(spark, sf_dir), log)
    return redirects.attach_payloads(resolved, log).select(
        "uri", "origin_uri", "temp_path", "target_path", "hash", "length", "mimetype",
        F.col("error").isNull().alias("good"),
    )


def write_content(spark, sf_dir):
    """Every document written to one of fifty places, then the last write of each."""
    docs = w.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("local/"), "source", F.lit("/"), F.expr("doc_id % 50")).alias("path"),
        F.col("doc_id").alias("seq"),
        F.md5("text").alias("md5"),
        F.col("text").cast("binary").alias("content"),
    )
    folder = _scratch(spark)
    sinks.write_content(docs.where("doc_id % 2 = 0"), folder, 0)
    for _ in range(2):  # a batch that is repeated replaces its first try
        sinks.write_content(docs.where("doc_id % 2 = 1"), folder, 1)
    stored = spark.read.parquet(folder)
    return sinks.read_content(stored).select(
        "path", "seq", "zone", F.md5("content").alias("md5")
    )


# --- projections -----------------------------------------------------------------------


def strip_root(spark, sf_dir):
    return w.messages(spark, sf_dir).select(
        "seq", "source", paths.strip_root(F.col("source"), "/").alias("stripped")
    )


def classify_source(spark, sf_dir):
    starts = w.start_uris(spark, sf_dir).select(F.col("uri").alias("src"))
    both = starts.union(w.landing_files(spark, sf_dir).select("path"))
    parsed = both.withColumn("p", uris.classify_source(F.col("src")))
    return parsed.select(
        "src", "p.is_uri", "p.scheme", "p.host", "p.path", "p.query", "p.userinfo",
        uris.route(F.col("p")).alias("route"),
    )


def scheme_support(spark, sf_dir):
    log = w.captures(spark, sf_dir).where("location IS NOT NULL")
    every = log.select(F.col("location").alias("uri")).union(
        w.landing_files(spark, sf_dir).select("path")
    )
    return every.select("uri", uris.scheme_status(F.col("uri")).alias("status"))


def remote_origins(spark, sf_dir):
    kept = merging.remote_origins(F.col("origins"))
    first = merging.first_remote_origin(F.col("origins"))
    return w.messages(spark, sf_dir).where("origins IS NOT NULL").select(
        "seq",
        _big(F.size("origins")).alias("n_origins"),
        _big(F.size(kept)).alias("n_remote"),
        first["scheme"].alias("first_scheme"),
        first["uri"].alias("first_uri"),
    )


def in_zone(spark, sf_dir):
    stored = w.catalog(spark, sf_dir)
    return stored.select(
        "doc_id",
        paths.in_zone(F.col("source"), "local").alias("in_local"),
        paths.in_zone(F.col("source"), "remote").alias("in_remote"),
    )


def lookup_target(spark, sf_dir):
    return _paths(spark, sf_dir, target=paths.lookup_target(F.col("path")))


def zone_target_path(spark, sf_dir):
    return _paths(
        spark, sf_dir,
        in_local=paths.zone_target_path(F.col("path"), "local"),
        in_archive=paths.zone_target_path(F.col("path"), "archive"),
    )


def local_target_path(spark, sf_dir):
    return _paths(spark, sf_dir, target=paths.local_target_path(F.col("path")))


def remote_target_path(spark, sf_dir):
    return _paths(
        spark, sf_dir,
        target=paths.remote_target_path(
            F.regexp_replace("path", "^ingress/", ""), F.concat(F.lit("/remote//x/"), "path")
        ),
    )


def local_to_remote_target_path(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    source = F.concat(
        F.when(F.col("page_id") % 4 == 0, F.lit("remote/old/")).otherwise(F.lit("ingress/")),
        F.col("page_id"),
    )
    return pages.select(
        "page_id",
        paths.local_to_remote_target_path(source, F.col("url"), F.col("headers")).alias("target"),
    )


def archive_path(spark, sf_dir):
    return _paths(
        spark, sf_dir, archived=paths.archive_path(paths.local_target_path(F.col("path")), F.col("md5"))
    )


def remote_file_path(spark, sf_dir):
    return _pages(spark, sf_dir).select(
        "page_id", "url",
        naming.remote_file_path(F.col("url"), F.col("headers"), "remote").alias("path"),
        naming.remote_file_path(
            F.col("url"), F.lit(None).cast(HEADERS), "remote-ingress/",
            F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("given-"), "page_id")),
            headers.header_content_type(F.col("headers")),
        ).alias("temp_path"),
    )


def basename(spark, sf_dir):
    none = F.lit(None).cast("string")
    return _pages(spark, sf_dir).select(
        "page_id", naming.basename(F.col("url"), F.col("headers"), none, none).alias("base")
    )


def insert_query_hash(spark, sf_dir):
    none = F.lit(None).cast("string")
    name = F.element_at(F.split(uris.path_of(F.col("url")), "/"), -1)
    return _pages(spark, sf_dir).select(
        "page_id", naming.insert_query_hash(name, uris.query_of(F.col("url")), none).alias("name")
    )


def header_values(spark, sf_dir):
    """Names and types read from response headers, in both ways of reading names."""
    h = F.col("headers")
    return _pages(spark, sf_dir).select(
        "page_id",
        headers.disposition_filename(h).alias("disposition"),
        headers.header_filename(h).alias("file_name"),
        headers.header_content_type(h).alias("content_type"),
        headers.location_value(h).alias("location"),
        naming.location_part(F.col("url"), h).alias("location_part"),
    )


def shorten_name(spark, sf_dir):
    """Names made of the text of each document, many of them far too long."""
    docs = w.table(spark, sf_dir, "documents")
    stem = F.regexp_replace("text", "[^A-Za-z]+", "-")
    path = F.concat(F.lit("/d/"), stem, F.lit(".PDF"))
    name = F.concat(stem, F.lit(".q1.pdf"))
    return docs.select("doc_id", naming.shorten_name(path, name).alias("name"))


def endpoint_profile(spark, sf_dir):
    starts = w.start_uris(spark, sf_dir)
    return redirects.endpoint_profile(starts)


def detect_mimetype(spark, sf_dir):
    """Pages and landing files, and bodies whose mark is far from their beginning."""
    pages = w.table(spark, sf_dir, "pages")
    late = F.concat(F.lit("<!-- "), F.repeat(F.lit("x"), 70), F.lit(" -->"), F.repeat(F.lit(" "), 70))
    bodies = [
        (F.col("url"), F.col("html")),
        (F.concat(F.lit("late/"), "page_id"), F.concat(late, "html")),
        (F.concat(F.lit("binary/"), "page_id"), F.concat(F.lit("text "), "html", F.char(F.lit(1)))),
    ]
    files = w.landing_files(spark, sf_dir).select(F.col("path").alias("name"), "kind")
    for name, body in bodies:
        kind = mimetypes.sniff(body.cast("binary"))
        files = files.union(pages.select(name.alias("name"), kind.alias("kind")))
    return files.select(
        "name", mimetypes.detect_mimetype(F.col("kind"), F.col("name")).alias("mimetype")
    )


def file_attrs(spark, sf_dir):
    attrs = paths.file_attrs(F.col("path"), F.col("length"), F.col("mtime"), "/data")
    files = w.landing_files(spark, sf_dir).withColumn("a", attrs)
    return files.select(
        "seq", F.col("a.path").alias("folder"), "a.name", _text("a.mtime").alias("mtime"),
        "a.size", paths.is_zero_length(F.col("length")).alias("empty"),
    )


def catalog_source(spark, sf_dir):
    moved = F.when(F.col("seq") % 2 == 0, F.concat(F.lit("/data/"), "path"))
    return _paths(
        spark, sf_dir,
        source=paths.catalog_source(moved, F.concat(F.lit("old/"), F.col("path")), "/data"),
    )


def fill_uuid(spark, sf_dir):
    stored = w.catalog(spark, sf_dir)
    return stored.select("doc_id", identity.fill_uuid(F.col("uuid"), F.col("doc_id")).alias("uuid"))


# --- matching and state ------------------------------------------------------------------


def local_matches(spark, sf_dir) -> DataFrame:
    landed = w.landing_files(spark, sf_dir).select(
        "seq", "path", F.col("md5").alias("hash"), "length",
        F.array_distinct(F.array("path", paths.lookup_target(F.col("path")))).alias("sources"),
    )
    return matching.match_catalog(landed, w.catalog(spark, sf_dir))


def match_local(spark, sf_dir):
    return local_matches(spark, sf_dir).select(
        "seq", "n_matches", F.col("newest.doc_id").alias("newest_doc")
    )


def _remote_rows(spark, sf_dir) -> DataFrame:
    """Catalog of pages: stored under their path, or known by URL or origin only."""
    pages = w.table(spark, sf_dir, "pages")
    return pages.select(
        F.expr("concat('p', lpad(CAST(page_id AS STRING), 12, '0'))").alias("doc_id"),
        F.expr("CASE WHEN page_id % 4 = 0 THEN url ELSE concat('remote/p/', page_id) END").alias(
            "source"
        ),
        F.expr("CASE WHEN page_id % 5 = 0 THEN md5(concat(html, 'x')) ELSE md5(html) END").alias(
            "hash"
        ),
        F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(CAST(page_id % 9 AS INT))")
        .alias("created"),
        F.expr(
            f"CASE WHEN page_id % 2 = 0 THEN array({w._origin('NULL', 'url')}) "
            f"WHEN page_id % 3 = 0 THEN array({w._origin('NULL', 'NULL')}, "
            + w._origin("'http'", "concat('http://r1.example.com/', page_id)") + ") END"
        ).cast(f"array<{ORIGIN}>").alias("origin"),
    )


def match_remote(spark, sf_dir):
    pages = w.table(spark, sf_dir, "pages")
    fetched = pages.select(
        F.col("page_id").alias("seq"), F.md5("html").alias("hash"),
        F.array("url").alias("sources"), F.col("url").alias("uri"),
    ).union(
        pages.where("page_id % 3 = 0").select(
            F.col("page_id") + 10_000_000, F.md5("html"),
            F.array(F.concat(F.lit("http://r1.example.com/"), "page_id")),
            F.concat(F.lit("http://r1.example.com/"), "page_id"),
        )
    )
    matched = matching.match_catalog(
        fetched, _remote_rows(spark, sf_dir), ("hash", "source", "origin_uri")
    )
    latest = matching.latest_and_archivable(matched)
    return latest.select("seq", "n_matches", "doc_id", "is_new", "n_archivable")


def latest_and_archivable(spark, sf_dir):
    latest = matching.latest_and_archivable(local_matches(spark, sf_dir))
    return latest.select("seq", "doc_id", "doc_source", "is_new", "n_archivable")


def content_dedup(spark, sf_dir):
    return matching.content_dedup(w.landing_files(spark, sf_dir))


def resolve_redirects(spark, sf_dir):
    resolved = redirects.resolve_redirects(w.start_uris(spark, sf_dir), _log(spark, sf_dir))
    chain = F.concat_ws(" ", F.transform("chain", lambda o: o["uri"]))
    return resolved.select(
        "uri", chain.alias("chain"), "n_origins", "terminal_status", "error",
        merging.canonical_origin(F.col("chain"))["hostname"].alias("canonical_host"),
    )


def follow_to_payload(spark, sf_dir):
    return redirects.follow_to_payload(w.start_uris(spark, sf_dir), _log(spark, sf_dir))


def content_type_extension(spark, sf_dir):
    """Types of the pages' headers, and unknown, missing and parametrised ones."""
    types = F.element_at(
        F.expr("filter(headers, h -> lower(h.name) = 'content-type')"), 1
    )["values"][0]
    known = _pages(spark, sf_dir).select("page_id", types.alias("type"))
    odd = ("x-some/unknown; q=1", None, " IMAGE/Webp ;v=2", "video/mp4")
    for n, kind in enumerate(odd, 1):
        moved = (F.col("page_id") + n * 10**9).alias("page_id")
        known = known.unionByName(
            known.where("page_id < 1000000000").select(moved, F.lit(kind).cast("string").alias("type"))
        )
    return known.select("page_id", naming.content_type_extension(F.col("type")).alias("extension"))


def _found(spark, sf_dir) -> DataFrame:
    """Messages with their document: the newest match, or a new one."""
    latest = matching.latest_and_archivable(local_matches(spark, sf_dir))
    stored = w.catalog(spark, sf_dir).select(
        "doc_id", F.col("origin").alias("doc_origin"), F.col("created").alias("doc_created"),
        "rogue_file", F.col("tags").alias("doc_tags"), F.col("metadata").alias("doc_metadata"),
    )
    asked = w.messages(spark, sf_dir).select(
        "seq", F.col("origins").alias("msg_origins"), "tags", "metadata", "derivative", "verify"
    )
    return (
        latest.join(stored, "doc_id", "left")
        .join(asked, "seq")
        .withColumn("doc_source", F.coalesce("doc_source", "path"))
        .withColumn("doc_hash", F.col("hash"))
        .withColumn("chain", F.lit(None).cast(f"array<{ORIGIN}>"))
        .withColumn("download_target", F.lit(None).cast("string"))
        .withColumn("temp_path", F.col("path"))
    )


def document_targets(spark, sf_dir):
    return targets.document_targets(_found(spark, sf_dir)).select(
        "seq", "target_path", "in_place", "temp_path",
        F.concat_ws(" ", F.transform("new_origin", lambda o: F.coalesce(o["uri"], F.lit("-")))).alias(
            "origins"
        ),
    )


def validate_messages(spark, sf_dir):
    error = validation.validation_error(
        F.col("verify"),
        F.coalesce("doc_created", w.as_of().cast("timestamp_ntz")),
        F.col("rogue_file"),
        validation.origin_error(F.col("msg_origins")),
        w.as_of(),
    )
    return _found(spark, sf_dir).select("seq", error.alias("error"))


def verify_window(spark, sf_dir):
    log = w.operation_log(spark, sf_dir)
    apart = validation.seconds_apart(F.col("ts"), F.lit("2024-01-15 12:00:00").cast("timestamp"))
    return log.select(
        _text("ts").alias("ts"), "operation", _big(apart).alias("apart"),
        (apart > 86400).alias("old"),
    )


def _plan(spark, sf_dir) -> DataFrame:
    placed = targets.document_targets(_found(spark, sf_dir))
    return targets.plan_file_actions(placed, w.stored_files(spark, sf_dir))


def target_occupancy(spark, sf_dir):
    return _plan(spark, sf_dir).select("seq", "target_path", "occupant")


def plan_file_actions(spark, sf_dir):
    return _plan(spark, sf_dir).select("seq", "target_path", "action")


def path_actions(spark, sf_dir):
    return targets.path_actions(_plan(spark, sf_dir))


def new_catalog_rows(spark, sf_dir):
    asked = _found(spark, sf_dir).where("is_new").withColumn("match_source", F.col("path"))
    rows = catalog_ops.new_catalog_rows(asked, w.as_of())
    return rows.select(
        "doc_id", "source", "hash", "mimetype", _text("created").alias("created"),
        "derivative", _big(F.size("tags")).alias("n_tags"), "uuid",
    )


def append_new(spark, sf_dir):
    asked = _found(spark, sf_dir).where("is_new").withColumn("match_source", F.col("path"))
    rows = catalog_ops.append_new(
        w.catalog(spark, sf_dir), catalog_ops.new_catalog_rows(asked, w.as_of())
    )
    return rows.select("doc_id", "source", "hash", _text("updated").alias("updated"))


def consolidate_origins(spark, sf_dir):
    merged = merging.consolidate_origins(
        F.col("doc_origin"), F.col("chain"), F.col("msg_origins")
    )
    as_text = F.transform(
        merged, lambda o: F.concat(o["scheme"], F.lit("|"), F.coalesce(o["uri"], F.lit("-")))
    )
    return _found(spark, sf_dir).select("seq", F.concat_ws(" ", as_text).alias("origins"))


def merge_tags(spark, sf_dir):
    merged = merging.merge_tags(F.col("tags"), F.col("doc_tags"))
    return _found(spark, sf_dir).select("seq", F.concat_ws(",", merged).alias("tags"))


def merge_metadata(spark, sf_dir):
    merged = merging.merge_metadata(F.col("metadata"), F.col("doc_metadata"))
    as_text = F.transform(merged, lambda m: F.concat_ws("/", m["key"], m["vtype"], m["value"]))
    return _found(spark, sf_dir).select("seq", F.concat_ws(",", as_text).alias("metadata"))


def upsert_catalog(spark, sf_dir):
    """Rows of the catalog after a change to every second of them."""
    stored = w.catalog(spark, sf_dir)
    number = F.expr("CAST(substr(doc_id, 2) AS BIGINT)")
    changes = stored.where(number % 2 == 0).select(
        "doc_id",
        F.concat(F.lit("moved/"), "source").alias("source"),
        F.col("origin"),
        F.array(F.lit("fresh"), F.lit("stored")).alias("tags"),
        F.lit(None).cast("array<" + stored.schema["metadata"].dataType.elementType.simpleString() + ">")
        .alias("metadata"),
        F.lit(True).alias("derivative"),
        paths.file_attrs(F.col("source"), F.lit(5), F.col("created"), "/").alias("attrs"),
        F.when(number % 4 == 0, F.lit("text/html")).alias("mimetype"),
    )
    rows = catalog_ops.upsert_catalog(stored, changes, w.as_of())
    return rows.select(
        "doc_id", "source", "hash", "mimetype", "derivative",
        _text("updated").alias("updated"), F.concat_ws(",", "tags").alias("tags"),
        F.col("attrs.name").alias("name"), "uuid",
    )


def _replacing(spark, sf_dir) -> DataFrame:
    return _plan(spark, sf_dir).where("action = 'REPLACE'").select(
        F.coalesce("doc_id", F.lit("new")).alias("doc_id"), "hash", "sources",
        F.lit(None).cast("string").alias("uri"),
    )


def delete_superseded(spark, sf_dir):
    stored = w.catalog(spark, sf_dir)
    gone = matching.superseded_rows(stored, _replacing(spark, sf_dir))
    return catalog_ops.delete_rows(stored, gone).select("doc_id", "source", "hash")


def delete_lineage(spark, sf_dir):
    gone = matching.superseded_rows(w.catalog(spark, sf_dir), _replacing(spark, sf_dir))
    edges = lineage.delete_lineage(w.mappings(spark, sf_dir), gone)
    return edges.select("mapping_id", "parent", "child_path")


def delete_zero_length(spark, sf_dir):
    empty = _plan(spark, sf_dir).where("action = 'ZERO_LENGTH' AND NOT is_new").select("doc_id")
    return catalog_ops.delete_rows(w.catalog(spark, sf_dir), empty.distinct()).select(
        "doc_id", "hash"
    )


def update_lineage(spark, sf_dir):
    """Turns of even number are taken in; those whose child is stored are named again."""
    turns = w.table(spark, sf_dir, "conversations")
    seq = F.col("conv_id") * 100_000 + F.col("turn")
    path = F.concat(F.lit("ingress/derivatives/conv"), "conv_id", F.lit("/"), "turn", F.lit(".txt"))
    taken = turns.where("turn % 2 = 0").select(
        seq.alias("seq"), path.alias("source"), F.concat(F.lit("n"), seq).alias("doc_id")
    )
    again = turns.where("turn % 4 = 0").select(
        (seq + 10**12).alias("seq"),
        F.regexp_replace(path, "^ingress", "local").alias("source"),
        F.concat(F.lit("z"), seq).alias("doc_id"),
    )
    edges = lineage.update_lineage(w.mappings(spark, sf_dir), taken.union(again))
    return edges.select("mapping_id", "parent", "child", "child_path", "consumer")


def confirm_updates(spark, sf_dir):
    processed = w.landing_files(spark, sf_dir).select(
        "seq", F.expr("concat('c', lpad(CAST(seq AS STRING), 12, '0'))").alias("doc_id")
    )
    return catalog_ops.confirm_updates(processed, w.catalog(spark, sf_dir)).select(
        "seq", "doc_id", "confirmed"
    )


# --- summaries ---------------------------------------------------------------------------


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("total", F.round("total", 2))


def document_size_summary(spark, sf_dir):
    return metrics.document_size_summary(w.operation_log(spark, sf_dir))


def fetch_latency_summary(spark, sf_dir):
    return _rounded(metrics.latency_summary(w.operation_log(spark, sf_dir), ["scheme"]))


def file_operation_summary(spark, sf_dir):
    log = w.operation_log(spark, sf_dir).where("operation IN ('move', 'copy', 'remove')")
    return _rounded(metrics.latency_summary(log, ["operation"]))


def catalog_operation_summary(spark, sf_dir):
    log = w.operation_log(spark, sf_dir).where("operation NOT IN ('move', 'copy', 'remove')")
    return _rounded(metrics.latency_summary(log, ["consumer", "operation"]))


def outcome_counts(spark, sf_dir):
    outcomes = w.operation_log(spark, sf_dir).select(
        "consumer",
        F.when(F.col("bytes") % 10 == 0, F.lit("no_document")).otherwise(F.lit("ok")).alias("result"),
    )
    return metrics.outcome_counts(outcomes)


# --- order, runs, streams ------------------------------------------------------------------


def batch_sequence(spark, sf_dir):
    """Arrival order of the messages of each content."""
    landed = w.landing_files(spark, sf_dir).select("seq", "md5")
    return runs.batch_sequence(landed, "md5", width=100).select("seq", "md5", "nth")


def suppress_recent(spark, sf_dir):
    matched = matching.latest_and_archivable(local_matches(spark, sf_dir)).where("NOT is_new")
    checked = runs.suppress_recent(
        matched.select("seq", "doc_id"), w.flags(spark, sf_dir), w.as_of()
    )
    return checked.select("seq", "doc_id", "too_recent")


def mark_run_state(spark, sf_dir):
    stored = w.catalog(spark, sf_dir).where("doc_id LIKE 'c%'")
    processed = stored.select("doc_id", (F.length("source") % 2 == 0).alias("finished"))
    marked = runs.mark_run_state(w.flags(spark, sf_dir), processed, w.as_of())
    return marked.select(
        "doc_id", "consumer", _text("started").alias("started"), _text("ended").alias("ended")
    )


def retry_candidates(spark, sf_dir):
    errors = message_source.parse_messages(w.raw_messages(spark, sf_dir)).where(
        "error IS NOT NULL"
    ).select("seq", F.expr("seq % 5").alias("attempt"))
    return runs.retry_candidates(errors)


def _ingest(spark, sf_dir, cfg: IntakeConfig = DEFAULT) -> IngestResult:
    asked = w.messages(spark, sf_dir).unionByName(w.remote_messages(spark, sf_dir))
    return ingest_batch(
        asked, w.stored_files(spark, sf_dir), w.captures(spark, sf_dir),
        w.catalog(spark, sf_dir), w.mappings(spark, sf_dir), w.flags(spark, sf_dir),
        w.as_of(), cfg,
    )


def ingest_outcomes(spark, sf_dir):
    result = _ingest(spark, sf_dir)
    return result.outcomes.select(
        "seq", "outcome", "action", "doc_id", "is_new", "new_source", "target_path"
    )


def ingest_catalog(spark, sf_dir):
    result = _ingest(spark, sf_dir, IntakeConfig(recent_tolerance=None))
    return result.catalog.select(
        "doc_id", "source", "hash", "mimetype", "derivative",
        F.concat_ws(",", "tags").alias("tags"),
        _big(F.size(F.coalesce("origin", F.array().cast(f"array<{ORIGIN}>")))).alias("n_origins"),
    )


def emit_notifications(spark, sf_dir):
    planned = _plan(spark, sf_dir).where("NOT is_new").select(
        "seq", "doc_id", F.col("target_path").alias("new_source"), "hash",
        F.lit("intake").alias("consumer"),
        F.when(F.col("action").isin("ZERO_LENGTH", "MISSING_TARGET"), F.lower("action"))
        .otherwise("ok")
        .alias("outcome"),
    )
    return sinks.emit_notifications(planned)


def emit_errors(spark, sf_dir):
    error = validate_messages(spark, sf_dir).join(
        w.landing_files(spark, sf_dir).select("seq", F.col("path").alias("raw")), "seq"
    )
    return sinks.emit_errors(error.withColumn("outcome", F.coalesce("error", F.lit("ok"))))


def message_sources(spark, sf_dir):
    """What a message stands for before any state is looked at: hash, keys, errors."""
    facts = message_facts(
        w.messages(spark, sf_dir), w.landing_files(spark, sf_dir), w.captures(spark, sf_dir)
    )
    return facts.select(
        "seq", "raw", "route", "hash", "length", F.concat_ws(" ", "sources").alias("sources"),
        "origin_error", "static_error",
    )


def _queue(batches, folder, rows_per_file=50_000):
    """Write batches, each in as many files as it needs; options to read one in a trigger."""
    batches = [b.persist() for b in batches]
    files = max(1, -(-max(b.count() for b in batches) // rows_per_file))
    for batch in batches:
        # rows are dealt in turn, so that no file is empty and a trigger takes one batch
        batch.repartition(files).write.mode("append").parquet(f"{folder}/queue")
        batch.unpersist()
    return {"maxFilesPerTrigger": str(files)}


def _message_queue(spark, batches, folder):
    options = _queue(batches, folder)
    return message_source.message_stream(
        spark, "parquet", options, f"{folder}/queue", "seq bigint, value string"
    )


def suppress_stream(spark, sf_dir):
    """Events as runs of their user's document, in two triggers, at most one in six hours."""
    folder = _scratch(spark)
    runs = w.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("doc_id"), F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
    )
    middle = F.timestamp_micros(F.lit(1_705_276_800_000_000))  # the middle of the month
    halves = [runs.where(F.col("ts") < middle), runs.where(F.col("ts") >= middle)]
    reader = spark.readStream.options(**_queue(halves, folder)).schema("doc_id string, seq bigint, ts timestamp")
    stream = reader.parquet(f"{folder}/queue")
    prepare_python(spark)
    query = (
        suppression.mark_recent(stream, 6 * 3600).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True)
        .start(f"{folder}/out")
    )
    query.awaitTermination()
    return spark.read.schema(suppression.MARKED).parquet(f"{folder}/out").select(
        "doc_id", "seq", "too_recent"
    )


def running_size_summary(spark, sf_dir):
    """Sizes by scheme and type from the sketches of seven batches, and if they are near enough."""
    labels = ["scheme", "mimetype"]
    log = w.operation_log(spark, sf_dir).withColumn("scheme", uris.scheme_label(F.col("scheme")))
    batch = F.pmod(F.col("bytes"), F.lit(7)).alias("batch")
    parts = cut(metrics.summary_sketches(log.select(*labels, batch, "bytes"), [*labels, "batch"], "bytes"))
    found = metrics.merged_summary(parts, labels)
    ranks = log.join(F.broadcast(found), labels).groupBy(*labels).agg(
        F.any_value("n").alias("n"), F.any_value("total").alias("total"),
        *[F.avg((F.col("bytes") <= F.col(q)).cast("int")).alias(q) for q in ("q50", "q90")],
    )
    near = [
        (F.abs(F.col(q) - share) <= allowed).alias(f"{q}_near")
        for q, share, allowed in zip(("q50", "q90"), metrics.QUANTILES, metrics.RANK_ERRORS)
    ]
    return ranks.select(*labels, "n", "total", *near)


def layered_operations(spark, sf_dir):
    """Renames in chains, rings and with shared sources, as layers of file operations."""
    return ordering.layered_operations(w.renames(spark, sf_dir))


def ingest_stream_catalog(spark, sf_dir):
    """Landing messages through the stream, in two micro-batches, into a table store."""
    folder = _scratch(spark)
    store = new_store(
        spark, f"{folder}/store", w.catalog(spark, sf_dir), w.mappings(spark, sf_dir),
        w.flags(spark, sf_dir), w.stored_files(spark, sf_dir).select("path", "length", "md5", "mtime", "kind"),
    )
    raw = w.messages(spark, sf_dir).select(
        "seq", F.to_json(F.struct("source", "tags", "metadata", "derivative", "verify")).alias("value")
    )
    half = F.pmod(F.floor(F.col("seq") / 8), F.lit(2))
    stream = _message_queue(spark, [raw.where(half == part) for part in (0, 1)], folder)
    query = ingest_stream(
        stream, store, w.captures(spark, sf_dir), f"{folder}/state", as_of=w.as_of()
    )
    query.awaitTermination()
    return store.load("catalog").select("doc_id", "source", "hash")


def ingest_families(spark, sf_dir):
    """Outcomes of one batch over families of documents whose ends are known beforehand."""
    made = w.families(spark, sf_dir)
    good, _ = message_source.decode_messages(made["raw"])
    result = ingest_batch(
        good, made["files"], w.captures(spark, sf_dir), made["catalog"],
        w.mappings(spark, sf_dir), w.flags(spark, sf_dir).limit(0), w.as_of(),
        IntakeConfig(recent_tolerance=None),
    )
    return result.outcomes.select("seq", "outcome", "action", "new_source", "target_path")


def ingest_stream_families(spark, sf_dir):
    """Catalog and files after the families went through the stream in two batches."""
    made, folder = w.families(spark, sf_dir), _scratch(spark)
    store = new_store(
        spark, f"{folder}/store", made["catalog"], w.mappings(spark, sf_dir),
        w.flags(spark, sf_dir).limit(0), made["files"],
    )
    halves = [made["raw"].where(f"batch = {part}").select("seq", "value") for part in (0, 1)]
    stream = _message_queue(spark, halves, folder)
    ingest_stream(
        stream, store, w.captures(spark, sf_dir), f"{folder}/state", as_of=w.as_of(),
        cfg=IntakeConfig(recent_tolerance=None),
    ).awaitTermination()
    rows = store.load("catalog").select(
        F.lit("row").alias("what"), F.col("source").alias("place"), F.col("hash").alias("md5"),
        F.concat_ws(",", "tags").alias("tags"), F.col("doc_id").startswith("f").alias("old"),
    )
    files = store.load("files").select(
        F.lit("file").alias("what"), F.col("path").alias("place"), "md5",
        F.lit(None).cast("string").alias("tags"), F.lit(None).cast("boolean").alias("old"),
    )
    return rows.unionByName(files)


QUERIES = {
    f.__name__: f
    for f in (
        decode_messages, message_stream, scan_landing_files, landing_facts, load_catalog,
        attach_payloads, write_content, emit_notifications, emit_errors,
        strip_root, classify_source, scheme_support, remote_origins, in_zone, lookup_target,
        zone_target_path, local_target_path, remote_target_path, local_to_remote_target_path,
        archive_path, remote_file_path, basename, insert_query_hash, header_values, shorten_name,
        endpoint_profile, detect_mimetype, file_attrs, catalog_source, fill_uuid,
        match_local, match_remote, latest_and_archivable, content_dedup, resolve_redirects,
        follow_to_payload, content_type_extension, document_targets, validate_messages,
        verify_window, target_occupancy, plan_file_actions, path_actions, layered_operations,
        new_catalog_rows, suppress_stream, running_size_summary,
        append_new, consolidate_origins, merge_tags, merge_metadata, upsert_catalog,
        delete_superseded, delete_lineage, delete_zero_length, update_lineage, confirm_updates,
        document_size_summary, fetch_latency_summary, file_operation_summary,
        catalog_operation_summary, outcome_counts, batch_sequence, suppress_recent,
        mark_run_state, retry_candidates, message_sources, ingest_outcomes, ingest_catalog,
        ingest_stream_catalog, ingest_families, ingest_stream_families,
    )
}
