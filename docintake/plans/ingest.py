"""One batch of messages applied to the catalog, as if taken one at a time.

Messages meet when they share a key: a content hash, a path or an origin URI. All
pending messages are judged against the current state. A message is final when no
earlier pending message can change anything it depends on; the others are judged again
against the state the final ones leave. Messages that merely find their document (all
copies after the first) change no key and become final together, and so do documents
that replace each other at one path, whether or not they came from one origin.

At a path each message is a step that maps what is stored there to what is stored after it:
its own content, if it moves a file there or finds its document in place, or what was there.
Steps compose, so what every message finds follows from one segmented prefix scan over the
path's messages, whatever contents take turns there. A round is needed per conflict over
rows or origins and not per message, however many messages share a key. Every step is
a join or an aggregation by key; the driver only sees whether rows are left.

Messages of an empty content delete the stored document they find, so each finds the next
newest one. What all of them find follows from one pass over them in their order, in bounded
pieces, so that they wait for messages of other contents only.

Payload facts are read once, at the start: a message naming a path that another message
of the same batch writes sees the file as it was before the batch.
"""

from __future__ import annotations

from bisect import insort
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from docintake.config import DEFAULT, IntakeConfig
from docintake.functions.identity import new_doc_id
from docintake.functions.merging import first_remote_origin
from docintake.functions.mimetypes import detect_mimetype
from docintake.functions.paths import (
    file_attrs,
    in_zone,
    is_zero_length,
    local_target_path,
    local_to_remote_target_path,
    lookup_target,
    strip_root,
)
from docintake.functions.uris import classify_source, route
from docintake.functions.validation import origin_error, seconds_apart, validation_error
from docintake.operators.catalog import new_catalog_rows, upsert_catalog
from docintake.operators.lineage import delete_lineage, update_lineage
from docintake.operators.matching import origin_uris, single_keys, superseded_rows
from docintake.operators.redirects import attach_payloads, current_captures, resolve_redirects
from docintake.operators.runs import mark_run_state, run_recently
from docintake.operators.skew import (
    HOT_ROWS,
    broadcast_if_small,
    distinct_items,
    lookup,
    previous,
)
from docintake.operators.targets import (
    file_action,
    file_changes,
    path_actions,
    target_columns,
    target_occupancy,
)
from docintake.schema import META, ORIGIN
from docintake.session import cut, prepare_python, remove_folder, run_folder
from docintake.sources.sinks import ERROR_TEXT, emit_errors, emit_notifications


#: Arrival numbers whose steps are composed together where a path may have many messages.
PIECE = 100_000
#: Messages of one empty content, and rows they may find, that one pass goes over in a round.
QUEUE = 50_000


#: Every way a message can end.
OUTCOMES = ("ok", "zero_length", *ERROR_TEXT)


@dataclass
class IngestResult:
    catalog: DataFrame
    mappings: DataFrame
    flags: DataFrame
    actions: DataFrame
    outcomes: DataFrame
    notifications: DataFrame
    errors: DataFrame
    changed_rows: DataFrame
    deleted: DataFrame
    changed_flags: DataFrame
    deleted_edges: DataFrame
    touched_edges: DataFrame
    changed_files: DataFrame
    deleted_files: DataFrame
    failed: DataFrame
    counts: dict[str, int]
    rounds: int
    scratch: str

    def release(self) -> None:
        """Delete the intermediate tables, after everything wanted has been written."""
        remove_folder(self.outcomes.sparkSession, self.scratch)


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def message_facts(
    messages: DataFrame,
    files: DataFrame,
    captures: DataFrame,
    cfg: IntakeConfig = DEFAULT,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Everything about a message that does not depend on the catalog."""
    origins = F.coalesce("origins", F.array().cast(f"array<{ORIGIN}>"))
    base = messages.select(
        "seq",
        strip_root(F.col("source"), cfg.root).alias("raw"),
        origins.alias("msg_origins"),
        origin_error(origins).alias("origin_error"),
        "tags",
        "metadata",
        "derivative",
        "verify",
    )
    base = base.withColumn("route", route(classify_source(F.col("raw"))))

    landing = files.select(
        F.col("path").alias("raw"), F.col("md5").alias("hash"), "length", "mtime", "kind"
    )
    local = lookup(base.where("route = 'local'"), landing, "raw", hot_rows=hot_rows)
    local = (
        local.withColumn("match_source", F.col("raw"))
        .withColumn("sources", F.array_distinct(F.array("raw", lookup_target(F.col("raw"), cfg))))
        .withColumn("uri", _null("string"))
        .withColumn("chain", _null(f"array<{ORIGIN}>"))
        .withColumn("temp_path", F.col("raw"))
        .withColumn("download_target", _null("string"))
        .withColumn(
            "static_error", F.when(F.col("hash").isNull(), F.lit("file_not_found"))
        )
        .withColumn("cause", _null("string"))
    )

    remote = base.where("route <> 'local'")
    if remote.isEmpty():
        return local

    log = cut(current_captures(captures))
    resolved = resolve_redirects(
        remote.select(F.col("raw").alias("uri")), log, hot_rows=hot_rows
    )
    downloads = attach_payloads(resolved, log, cfg, hot_rows).select(
        F.col("uri").alias("raw"),
        F.col("origin_uri").alias("match_source"),
        F.array("origin_uri").alias("sources"),
        F.col("origin_uri").alias("uri"),
        "chain",
        "temp_path",
        F.concat(F.lit(cfg.root_slash), "target_path").alias("download_target"),
        "hash",
        "length",
        _null("timestamp_ntz").alias("mtime"),
        "kind",
        F.when(F.col("error").isNotNull(), F.lit("no_document")).alias("static_error"),
        F.when(
            F.col("error") == "bad_status",
            F.concat(
                F.lit("Unable to process "), "uri", F.lit(" with status code "),
                F.col("status").cast("string"),
            ),
        ).when(F.col("error").isNotNull(), F.concat_ws(": ", "error", "uri")).alias("cause"),
    )
    fetched = lookup(remote, downloads, "raw", hot_rows=hot_rows)
    return local.unionByName(fetched)


def _slice_catalog(
    facts: DataFrame, catalog: DataFrame, flags: DataFrame, cfg: IntakeConfig
) -> DataFrame:
    """Catalog rows some message can match, without their wide columns."""
    wanted = cut(
        facts.where("static_error IS NULL")
        .select(
            F.explode(single_keys(F.col("hash"), F.col("sources"), F.array("uri"))).alias("key")
        )
        .distinct()
    )
    keyed = catalog.select(
        "doc_id",
        F.explode(
            single_keys(F.col("hash"), F.array("source"), origin_uris(F.col("origin")))
        ).alias("key"),
    )
    ids = cut(
        keyed.join(broadcast_if_small(wanted), "key", "left_semi").select("doc_id").distinct()
    )
    few = broadcast_if_small(ids)
    rows = catalog.select("doc_id", "source", "hash", "created", "rogue_file", "origin").join(
        few, "doc_id", "left_semi"
    )
    started = (
        flags.where(F.col("consumer") == cfg.consumer)
        .join(few, "doc_id", "left_semi")
        .groupBy("doc_id")
        .agg(F.max("started").alias("started"))
    )
    return cut(
        rows.join(started, "doc_id", "left").withColumn("is_new", F.lit(False))
    )


def _slice_store(
    facts: DataFrame, rows: DataFrame, files: DataFrame, cfg: IntakeConfig
) -> DataFrame:
    """Files at any path a document of this batch can be placed at."""

    def l2r(source: Column, origins: Column) -> Column:
        first = first_remote_origin(origins)
        return F.when(
            first.isNotNull(),
            local_to_remote_target_path(source, first["uri"], first["headers"], cfg),
        )

    source = F.col("source")
    for_rows = rows.select(
        F.explode(
            F.array(source, local_target_path(source, cfg), l2r(source, F.col("origin")))
        ).alias("path")
    )
    place = F.col("match_source")
    for_messages = facts.where("static_error IS NULL").select(
        F.explode(
            F.array(
                local_target_path(place, cfg),
                l2r(place, F.col("msg_origins")),
                strip_root(F.col("download_target"), cfg.root),
            )
        ).alias("path")
    )
    paths = cut(for_rows.union(for_messages).where("path IS NOT NULL").distinct())
    stored = files.select("path", "md5").join(broadcast_if_small(paths), "path", "left_semi")
    return cut(stored)


#: A row as messages find it; the newest is the largest.
ROW = ("created", "doc_id", "source", "hash", "rogue_file", "started", "origin")


def _rules(as_of: Column, cfg: IntakeConfig) -> dict:
    """Column expressions of one round, built once for all rounds."""
    time = as_of.cast("timestamp_ntz")
    empty = F.array().cast("array<string>")
    live = F.col("static_error").isNull()
    same = F.coalesce(F.col("newest.hash") == F.col("hash"), F.lit(False))

    def found(field: str) -> Column:
        return F.when(same, F.col(f"newest.{field}"))

    document = {
        "is_new": live & ~same,
        "doc_id": F.when(live, F.coalesce(found("doc_id"), new_doc_id(as_of, F.col("seq")))),
        "doc_source": F.when(
            live, F.when(same, found("source")).otherwise(F.col("match_source"))
        ),
        "doc_created": F.when(same, found("created")).otherwise(time),
        "doc_origin": found("origin"),
        "doc_started": found("started"),
        "doc_rogue": found("rogue_file"),
        "doc_hash": F.col("hash"),
    }
    too_recent = run_recently(F.col("doc_started"), as_of, cfg.recent_tolerance)
    invalid = validation_error(
        F.col("verify"),
        F.col("doc_created"),
        F.col("doc_rogue"),
        F.col("origin_error"),
        as_of,
        cfg.verify_timeout,
    )
    error = F.coalesce("static_error", F.when(too_recent, F.lit("run_too_recently")), invalid)

    accepted = F.col("error").isNull()
    moved = F.coalesce(F.col("action").isin("MOVE", "REPLACE"), F.lit(False))
    zero = F.coalesce(F.col("action") == "ZERO_LENGTH", F.lit(False))
    effect = {
        "ok": accepted & ~F.coalesce(
            F.col("action").isin("ZERO_LENGTH", "MISSING_TARGET"), F.lit(False)
        ),
        "new_source": F.when(moved, F.col("target_path")).otherwise(F.col("doc_source")),
        "creates": F.col("is_new") & ~zero,
        "deletes_own": live & ~F.col("is_new") & zero,
        "consumes": (
            F.col("uri").isNull()
            & F.coalesce(F.col("action").isin("MOVE", "REPLACE", "DISCARD"), F.lit(False))
            & ~(moved & (F.col("temp_path") == F.col("target_path")))
        ),
        "target_written": F.when(moved, F.col("target_path")),
        "file_key": F.when(
            F.col("uri").isNull() & live, F.array(F.concat(F.lit("F\x01"), "raw"))
        ).otherwise(empty),
        "match_keys": F.when(
            live, single_keys(F.col("hash"), F.col("sources"), F.array("uri"))
        ).otherwise(empty),
    }
    origin_after = {
        "origin_after": F.when(F.col("ok"), F.col("new_origin")).otherwise(F.col("doc_origin")),
        "target_read": F.when(F.col("ok"), F.col("target_path")),
    }

    def row_keys(source: str, origin: str) -> Column:
        return single_keys(F.col("hash"), F.array(source), origin_uris(F.col(origin)))

    row = {
        "before": F.when(
            live & ~F.col("is_new"), row_keys("doc_source", "doc_origin")
        ).otherwise(empty),
        "after": F.when(
            live & ~zero, row_keys("new_source", "origin_after")
        ).otherwise(empty),
    }

    def first_uri(origin: str) -> Column:
        return first_remote_origin(F.col(origin))["uri"]

    starts = accepted if cfg.recent_tolerance is not None else F.lit(False)
    changes_row = (
        F.col("creates")
        | F.col("deletes_own")
        | (live & starts)
        | F.coalesce(F.col("new_source") != F.col("doc_source"), F.lit(False))
        | ~first_uri("doc_origin").eqNullSafe(first_uri("origin_after"))
    )
    if cfg.keep_prior_origins:
        changes_row = changes_row | ~F.col("doc_origin").eqNullSafe(F.col("origin_after"))
    before, after = F.col("before"), F.col("after")
    changed_keys = F.when(live & changes_row, F.array_union(before, after)).otherwise(
        F.array_union(F.array_except(before, after), F.array_except(after, before))
    )
    # origin URIs the document may still come to have
    possible = single_keys(
        _null("string"),
        empty,
        F.concat(origin_uris(F.col("chain")), origin_uris(F.col("msg_origins"))),
    )
    # and the path it may come to be placed at
    place = single_keys(_null("string"), F.array("target_path"), empty)
    access = {
        # the address its place follows from
        "aims": F.when(
            F.col("ok"), single_keys(_null("string"), empty, F.array(first_uri("new_origin")))
        ).otherwise(empty),
        "reads": F.concat("match_keys", "file_key"),
        "row_changes": changed_keys,
        "touches": F.when(
            live, F.array_distinct(F.concat("match_keys", "file_key", before, after, possible, place))
        ).otherwise(empty),
    }
    settles = {
        "writes": F.concat(
            "row_changes", F.when(F.col("consumes"), F.col("file_key")).otherwise(empty)
        ),
        # it finds its document in place and changes no row's keys, so that it only does more
        # than removing its file if it replaces another content
        "quiet": F.coalesce(
            F.col("ok") & ~F.col("is_new") & F.col("in_place")
            & (F.col("target_path") == F.col("doc_source"))
            & (F.col("temp_path") != F.col("target_path"))
            & (F.size("row_changes") == 0),
            F.lit(False),
        ),
    }
    # and if it finds no other document, only its file is moved or removed in any case
    steady = {
        "steady": F.col("quiet") & F.coalesce(
            (F.col("low") == F.col("doc_id")) & (F.col("high") == F.col("doc_id")), F.lit(False)
        ),
    }
    queue = {
        # what keeps every message, and those that verify, from deleting the row
        "stuck": run_recently(F.col("started"), as_of, cfg.recent_tolerance)
        | F.coalesce("rogue_file", F.lit(False)),
        "old": F.coalesce(seconds_apart(F.col("created"), as_of) > cfg.verify_timeout, F.lit(False)),
        "row": F.struct(*ROW),
        "born": time.cast("string"),
        "new_id": new_doc_id(as_of, F.col("seq")),
        "new_row": F.struct(
            time.alias("created"), new_doc_id(as_of, F.col("seq")).alias("doc_id"),
            F.col("match_source").alias("source"), "hash", _null("boolean").alias("rogue_file"),
            _null("timestamp_ntz").alias("started"), _null(f"array<{ORIGIN}>").alias("origin"),
        ),
    }
    return {
        "queue": queue,
        "judge": [document, {"error": error}, *target_columns(cfg)],
        "act": [
            {"action": F.when(F.col("error").isNull(), file_action())},
            effect,
            origin_after,
            row,
            access,
            settles,
            steady,
        ],
    }


def _with(df: DataFrame, steps: list[dict[str, Column]]) -> DataFrame:
    for columns in steps:
        df = df.withColumns(columns)
    return df


def _pop_in_order(messages: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """The row each message of one empty content finds; it deletes it if nothing forbids that.

    A message that finds no row and is refused leaves a new one.
    """
    stack: list[tuple] = []
    for row in sorted(zip(rows["made"], rows["doc_id"], rows["stuck"], rows["old"])):
        if not stack or stack[-1][1] != row[1]:
            stack.append(row)
    messages, found = messages.sort_values("seq"), []
    for verify, bad, born, new_id, made, other in zip(
        *(messages[c] for c in ("verify", "bad", "born", "new_id", "other_made", "other_id"))
    ):
        top = stack[-1] if stack else None
        if top is None or (other is not None and (made, other) > top[:2]):
            found.append(None)
            if bad:
                insort(stack, (born, new_id, False, False))
            continue
        found.append(top[1])
        if not (bad or top[2] or (verify and top[3])):
            stack.pop()
    return messages[["seq", "hash"]].assign(found=pd.Series(found, messages.index, dtype=object))


def _queued(
    pending: DataFrame, rows: DataFrame, rules: dict, hot_rows: int | None
) -> DataFrame:
    """``seq``, ``queue`` (the content) and ``next_row`` of messages of empty contents.

    They only delete rows of their content or, if refused, add one, so what one finds follows
    from those before it. Left out, and judged like all others, are those whose other keys lead to rows
    of another empty content, and those that come after the first QUEUE ones of a content.
    """
    queue = rules["queue"]
    made = F.coalesce(F.col("row.created").cast("string"), F.lit("")).alias("made")
    empty = pending.where(is_zero_length(F.col("length"))).where(
        "static_error IS NULL AND hash IS NOT NULL"
    )
    contents = broadcast_if_small(empty.select("hash").distinct().withColumn("is_empty", F.lit(True)))
    rows = rows.join(contents, "hash", "left").select(
        "*", *[queue[c].alias(c) for c in ("stuck", "old", "row")]
    )
    none = F.array().cast("array<string>")
    others = (
        rows.select(
            F.explode(
                single_keys(_null("string"), F.array("source"), origin_uris(F.col("origin")))
            ).alias("key"),
            "row", F.when(F.col("is_empty"), F.col("hash")).alias("empty"),
        )
        .groupBy("key")
        .agg(
            F.max(F.when(F.col("empty").isNull(), F.col("row"))).alias("row"),
            F.min("empty").alias("low"), F.max("empty").alias("high"),
        )
    )
    keys = single_keys(_null("string"), F.coalesce("sources", none), F.array("uri"))
    others = (
        lookup(
            empty.select("seq", F.explode(keys).alias("key")), others, "key", how="inner",
            hot_rows=hot_rows,
        )
        .groupBy("seq")
        .agg(F.max("row").alias("row"), F.min("low").alias("low"), F.max("high").alias("high"))
    )
    own = F.coalesce(F.col("low") == F.col("hash"), F.lit(True)) & F.coalesce(
        F.col("high") == F.col("hash"), F.lit(True)
    )

    def first(df: DataFrame, *order: Column, n: int) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy("hash").orderBy(*order))
        return df.withColumn("nth", nth).where(F.col("nth") <= n).drop("nth")

    messages = first(
        empty.join(others, "seq", "left").where(own).select(
            "seq", "hash", F.coalesce("verify", F.lit(False)).alias("verify"),
            F.col("origin_error").isNotNull().alias("bad"),
            queue["born"].alias("born"), queue["new_id"].alias("new_id"),
            made.alias("other_made"), F.col("row.doc_id").alias("other_id"),
        ),
        F.col("seq"), n=QUEUE,
    )
    stored = rows.where("is_empty")
    newest = first(
        stored.groupBy("hash", "doc_id").agg(F.max(F.struct("row", "stuck", "old")).alias("top")).select(
            "hash", "doc_id", "top.*"
        ).select("hash", "doc_id", made, "stuck", "old"),
        F.desc("made"), F.desc("doc_id"), n=QUEUE + 1,
    )
    prepare_python(pending.sparkSession)
    found = messages.groupBy("hash").cogroup(newest.groupBy("hash")).applyInPandas(
        _pop_in_order, "seq long, hash string, found string"
    )
    known = stored.groupBy("doc_id").agg(F.max("row").alias("next_row")).select(
        F.col("doc_id").alias("found"), "next_row"
    ).union(
        empty.where("origin_error IS NOT NULL").select(queue["new_id"], queue["new_row"])
    )
    return found.withColumnRenamed("hash", "queue").join(known, "found", "left").drop("found")


def _judge(
    pending: DataFrame,
    rows: DataFrame,
    store: DataFrame,
    rules: dict,
    hot_rows: int | None,
    empties: bool = True,
) -> DataFrame:
    """Outcome, action and effect of each pending message on the current state.

    Adds the keys each message reads, writes and may come to write.
    """
    index = (
        rows.select(
            F.explode(
                single_keys(F.col("hash"), F.array("source"), origin_uris(F.col("origin")))
            ).alias("key"),
            F.struct(*ROW).alias("row"),
        )
        .groupBy("key")
        .agg(
            F.max("row").alias("newest"),
            F.min("row.doc_id").alias("low"),
            F.max("row.doc_id").alias("high"),
        )
    )
    wanted = pending.where("static_error IS NULL").select(
        "seq",
        F.explode(single_keys(F.col("hash"), F.col("sources"), F.array("uri"))).alias("key"),
    )
    best = (
        lookup(wanted, index, "key", how="inner", hot_rows=hot_rows)
        .groupBy("seq")
        .agg(
            F.max("newest").alias("newest"), F.min("low").alias("low"), F.max("high").alias("high")
        )
    )
    df = pending.join(best, "seq", "left")
    if empties:
        df = df.join(_queued(pending, rows, rules, hot_rows), "seq", "left").withColumn(
            "newest", F.when(F.col("queue").isNotNull(), F.col("next_row")).otherwise(F.col("newest"))
        ).drop("next_row")
    else:
        df = df.withColumn("queue", _null("string"))
    df = _with(df, rules["judge"]).drop("newest", "consolidated", "first_remote")
    df = target_occupancy(df, store.select("path", "md5"), hot_rows, vacant="vacant")
    return _with(df, rules["act"]).drop(
        "file_key", "match_keys", "before", "after", "low", "high", "row_changes"
    )


def _idle(slim: DataFrame, hot_rows: int | None) -> DataFrame:
    """``seq`` of messages that will find their document just run, and so change nothing.

    They follow an accepted message of the same stored document. No message of another document
    touches a key that one of this document's messages reads, or reads one that it may touch, so
    none can change what they find.
    """
    groups = slim.where("NOT is_new AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(F.col("error").isNull(), F.col("seq"))).alias("first_ok"),
        F.max(
            F.col("queue").isNotNull() | F.coalesce(F.col("action") == "ZERO_LENGTH", F.lit(False))
        ).alias("deletes"),
    ).where("n > 1 AND first_ok IS NOT NULL AND NOT deletes").select("doc_id", "first_ok")
    members = cut(
        lookup(slim, groups, "doc_id", how="inner", hot_rows=hot_rows).select(
            "seq", "doc_id", "first_ok", "reads", "touches"
        )
    )
    is_read = F.array_contains("reads", F.col("key"))
    keys = cut(
        members.select("doc_id", "reads", F.explode("touches").alias("key"))
        .groupBy("key", "doc_id").agg(F.max(is_read).alias("is_read"))
    )
    wanted = broadcast_if_small(keys.select("key").distinct())
    others = (
        slim.select("doc_id", "reads", F.explode("touches").alias("key"))
        .join(wanted, "key", "left_semi")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
            F.min(F.when(is_read, F.col("doc_id"))).alias("low_reader"),
            F.max(F.when(is_read, F.col("doc_id"))).alias("high_reader"),
        )
    )
    doc = F.col("doc_id")
    opened = (
        lookup(keys, others, "key", how="inner", spread_by="doc_id", hot_rows=hot_rows)
        .where(
            (F.col("low_reader") != doc) | (F.col("high_reader") != doc)
            | F.col("is_read") & ((F.col("low") != doc) | (F.col("high") != doc))
        )
        .select("doc_id").distinct()
    )
    return members.where("seq > first_ok").join(opened, "doc_id", "left_anti").select(
        "seq", F.lit(True).alias("idle")
    ).distinct()


def _settle(
    effects: DataFrame, rows: DataFrame, hot_rows: int | None, at_once: bool = True
) -> tuple[DataFrame, int]:
    """Say of each judged message whether it is blocked, and how many are.

    ``at_once`` says that a document may run again at once.
    """
    slim = effects.select(
        "seq", "doc_id", "raw", "hash", "sources", "uri", "ok", "action", "consumes",
        "reads", "writes", "touches", "aims", "target_path", "target_read", "target_written",
        "quiet", "steady", "vacant", "in_place", "temp_path", "queue", "error", "is_new",
    )
    # A message is free if no earlier one has to do with a key it reads: whatever else those
    # do, it finds the same document and the same older versions.
    # Messages of one queue know what those before them write.
    writes = F.array_contains("writes", F.col("key"))
    per_key = slim.select(
        "seq", F.explode("touches").alias("key"), "writes", "queue"
    ).groupBy("key").agg(
        F.min("seq").alias("first"),
        F.min(F.when(writes, F.col("seq"))).alias("first_write"),
        F.min(F.when(writes & F.col("queue").isNull(), F.col("seq"))).alias("first_other"),
        F.min(F.when(writes, F.col("queue"))).alias("low"),
        F.max(F.when(writes, F.col("queue"))).alias("high"),
    )
    one_queue = (F.col("queue") == F.col("low")) & (F.col("queue") == F.col("high"))
    per_seq = (
        lookup(
            slim.select("seq", "queue", F.explode("reads").alias("key")), per_key, "key", how="inner",
            hot_rows=hot_rows,
        )
        .groupBy("seq")
        .agg(
            F.min("first").alias("first"),
            F.min(
                F.when(one_queue, F.col("first_other")).otherwise(F.col("first_write"))
            ).alias("first_write"),
        )
    )
    earlier = F.coalesce(F.col("first") < F.col("seq"), F.lit(False))
    slim = slim.withColumn("idle", F.lit(False)) if at_once else slim.join(
        _idle(slim, hot_rows), "seq", "left"
    ).withColumn("idle", F.col("idle").isNotNull())
    df = cut(
        slim.join(per_seq, "seq", "left")
        .withColumn("free", ~earlier)
        .withColumn("blocked", F.col("idle") | F.coalesce(F.col("first_write") < F.col("seq"), F.lit(False)))
        .drop("first", "first_write", "error", "is_new")
    )
    # Idle messages are judged in the next round, but nothing has to wait for them.

    # Targets: steps of free and of quiet messages compose, so each of them follows the ones
    # before it at once; all others wait for earlier writers, and these for writers among all others. So does
    # a quiet message that turns out to replace a content and has older versions to delete.
    # One that leaves the path as it is, such as a refused one, holds up nobody.
    # A stored path that is taken away counts as written by a message that is not free.
    moves = F.col("temp_path") != F.col("target_path")
    df = df.withColumn("composes", F.col("ok") & ~F.col("idle") & (F.col("free") | (F.col("quiet") & ~F.col("blocked"))))
    steps = df.where("composes AND target_path IS NOT NULL").select(
        "target_path", "seq", F.when(moves, F.col("hash")).alias("leaves"),
        F.when(moves & ~F.col("in_place"), F.col("seq")).alias("filled"),
    )
    fills = steps.groupBy("target_path").agg(F.min("filled").alias("first_fill"))
    steps = previous(steps, "target_path", "seq", "leaves", "left", None if hot_rows is None else PIECE)
    df = lookup(
        df.join(steps.select("seq", "left"), "seq", "left"), fills, "target_path", hot_rows=hot_rows
    )
    # where nothing is stored, a document in place changes nothing
    met = F.when(~F.col("vacant") | (F.col("first_fill") < F.col("seq")), F.col("left"))
    becomes = F.when(met != F.col("hash"), F.lit("REPLACE")).when(
        F.col("quiet") & (met == F.col("hash")), F.lit("DISCARD")
    )
    settled = F.col("free") | F.col("steady") | (F.coalesce("becomes", "action") != "REPLACE")
    df = cut(
        df.withColumn("becomes", F.when(F.col("composes"), becomes))
        .withColumn("composes", F.col("composes") & F.coalesce(settled, F.lit(True)))
        .withColumn("becomes", F.when(F.col("composes"), F.col("becomes")))
        .drop("left", "first_fill")
    )
    written = F.coalesce(F.col("becomes") == "REPLACE", F.lit(False)) | (
        F.col("target_written").isNotNull() & F.col("becomes").isNull()
    )
    aimed = df.where("target_path IS NOT NULL AND NOT idle").select(
        "target_path", "seq", "composes", written.alias("written")
    )
    emptied = df.where("consumes AND NOT idle").select(
        F.col("raw").alias("target_path"), "seq", F.lit(False), F.lit(True)
    )
    per_target = aimed.union(emptied).groupBy("target_path").agg(
        F.min(F.when(F.col("written") & ~F.col("composes"), F.col("seq"))).alias("first_bound"),
        F.min(F.when(F.col("written"), F.col("seq"))).alias("first_written"),
    )
    wait_for = F.when(F.col("composes"), F.col("first_bound")).otherwise(
        F.when(F.col("target_read").isNotNull(), F.col("first_written"))
    )
    df = cut(
        lookup(df, per_target, "target_path", hot_rows=hot_rows)
        .withColumn(
            "blocked", F.col("blocked") | F.coalesce(wait_for < F.col("seq"), F.lit(False))
        )
        .withColumn("action", F.coalesce("becomes", "action"))
        .drop("first_bound", "first_written", "composes", "vacant", "in_place")
    )

    # Rows that a replacement may delete: whoever reads one of their keys later waits.
    replacing = df.where("ok AND action = 'REPLACE' AND NOT idle").select(
        "seq", "doc_id",
        F.explode(single_keys(F.col("hash"), F.col("sources"), F.array("uri"))).alias("key"),
    ).groupBy("key").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.min("seq").alias("first")
    )
    row_keys = single_keys(F.col("hash"), F.array("source"), origin_uris(F.col("origin")))
    doomed = (
        rows.select("doc_id", F.explode(row_keys).alias("key"))
        .join(replacing, "key")
        .where("low <> doc_id OR high <> doc_id")
        .groupBy("doc_id")
        .agg(F.min("first").alias("first"))
    )
    lost = (
        rows.select("doc_id", F.explode(row_keys).alias("key"))
        .join(doomed, "doc_id")
        .groupBy("key")
        .agg(F.min("first").alias("first"))
    )
    late = _reading_after(df, lost, hot_rows)

    df = (
        df.join(late, "seq", "left")
        .withColumn("blocked", F.col("blocked") | F.coalesce("late", F.lit(False)))
        .drop("late")
    )

    # Whatever a blocked message may still change blocks its later readers as well, and
    # whatever it still has to read those that would change it.
    target = F.when(
        F.col("target_path").isNotNull(), F.array(F.concat(F.lit("T\x01"), "target_path"))
    ).otherwise(F.array().cast("array<string>"))
    placing = F.when(F.col("target_read").isNotNull(), F.concat("aims", target)).otherwise(
        F.col("aims")
    )
    df = cut(
        df.withColumn("touches", F.concat("touches", target)).withColumn(
            "reads", F.array_union("reads", placing)
        )
    )
    n_blocked = df.where("blocked").count()
    idle, df = df.where("idle"), df.where("NOT idle")
    fresh = df.where("blocked") if n_blocked else None
    while fresh is not None:
        late = cut(_late_after(df, fresh, hot_rows))
        n_late = late.count()
        n_blocked += n_late
        fresh = None
        if n_late:
            df = (
                df.join(late, "seq", "left")
                .withColumn("blocked", F.col("blocked") | F.coalesce("late", F.lit(False)))
                .drop("late")
            )
            fresh = df.join(late, "seq", "left_semi")
    settled = df.select("seq", "blocked", "becomes")
    return settled.unionByName(idle.select("seq", "blocked", "becomes")), n_blocked


def _reading_after(df: DataFrame, firsts: DataFrame, hot_rows: int | None) -> DataFrame:
    """seq of messages that read a key after the seq given for it."""
    read = df.select("seq", F.explode("reads").alias("key"))
    return (
        lookup(read, firsts, "key", how="inner", hot_rows=hot_rows)
        .where("first < seq")
        .select("seq")
        .distinct()
        .withColumn("late", F.lit(True))
    )


def _late_after(df: DataFrame, blocked: DataFrame, hot_rows: int | None) -> DataFrame:
    """seq of unblocked messages that read what an earlier blocked one may touch, or write
    what it reads.

    A blocked message may come to find the document of any message it shares a key with,
    and so may come to have that one's target.
    """
    wanted = blocked.select("seq", F.explode("reads").alias("key")).groupBy("key").agg(
        F.min("seq").alias("first")
    )
    near = df.where("target_path IS NOT NULL").select(
        "seq", F.explode("touches").alias("key"),
        F.concat(F.lit("T\x01"), "target_path").alias("target"),
    )
    targets = lookup(near, wanted, "key", how="inner", hot_rows=hot_rows).select(
        F.col("target").alias("key"), "first", _null("bigint").alias("first_read")
    )
    touched = blocked.select(
        "seq", "reads", F.explode(F.array_union("touches", "reads")).alias("key")
    ).select(
        "key",
        F.col("seq").alias("first"),
        F.when(F.array_contains("reads", F.col("key")), F.col("seq")).alias("first_read"),
    )
    risky = targets.union(touched).groupBy("key").agg(
        F.min("first").alias("first"), F.min("first_read").alias("first_read")
    )
    access = df.where("NOT blocked").select(
        "seq", "reads", F.explode(F.array_union("reads", "writes")).alias("key")
    )
    access = access.select("seq", "key", F.array_contains("reads", F.col("key")).alias("is_read"))
    return (
        lookup(access, risky, "key", how="inner", hot_rows=hot_rows)
        .where("is_read AND first < seq OR first_read < seq")
        .select("seq")
        .distinct()
        .withColumn("late", F.lit(True))
    )


def _apply_rows(
    rows: DataFrame, final: DataFrame, deleted: DataFrame, as_of: Column, hot_rows: int | None
) -> DataFrame:
    """Catalog slice after the final messages of one round."""
    time = as_of.cast("timestamp_ntz")
    created = final.where("creates").select(
        "doc_id",
        F.col("match_source").alias("source"),
        "hash",
        time.alias("created"),
        _null("boolean").alias("rogue_file"),
        _null(f"array<{ORIGIN}>").alias("origin"),
        time.alias("started"),
        F.lit(True).alias("is_new"),
    ).withColumn("started", _null("timestamp_ntz"))
    current = rows.unionByName(created).join(deleted.select("doc_id"), "doc_id", "left_anti")

    # a message that changes its document is the last one of it in this round
    latest = final.where("static_error IS NULL").groupBy("doc_id").agg(
        F.max_by("new_source", "seq").alias("new_source"),
        F.max(F.when(F.col("error").isNull(), time)).alias("new_started"),
        F.max("ok").alias("ok"),
        F.max(
            F.when(
                F.col("ok") & F.col("chain").isNotNull(), F.struct("seq", "origin_after")
            )
        ).alias("download"),
    )
    added = final.where("ok AND chain IS NULL AND size(msg_origins) > 0").select(
        "seq", "doc_id", F.posexplode("msg_origins").alias("at", "origin")
    )
    replaced = latest.where("download IS NOT NULL").select(
        "doc_id", F.col("download.seq").alias("since")
    )
    added = lookup(added, replaced, "doc_id", hot_rows=hot_rows).where(
        "since IS NULL OR seq > since"
    )
    added = distinct_items(added, "doc_id", F.col("origin"), F.struct("seq", "at"), "added")
    none = F.array().cast(f"array<{ORIGIN}>")
    joined = current.join(latest, "doc_id", "left").join(added, "doc_id", "left")
    merged = F.array_distinct(
        F.concat(
            F.coalesce("download.origin_after", "origin", none), F.coalesce("added", none)
        )
    )
    return joined.select(
        "doc_id",
        F.coalesce("new_source", "source").alias("source"),
        "hash",
        "created",
        "rogue_file",
        F.when(F.col("ok"), merged).otherwise(F.col("origin")).alias("origin"),
        F.coalesce("new_started", "started").alias("started"),
        "is_new",
    )


def _split_rows(rows: DataFrame, pending: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows some pending message can find, and all others, which no later round can change.

    A message's own keys stay as they are, and only what it finds by them is changed or deleted.
    Rows of one document stay together.
    """
    wanted = pending.where("static_error IS NULL").select(
        F.explode(single_keys(F.col("hash"), F.col("sources"), F.array("uri"))).alias("key")
    ).distinct()
    keyed = rows.select(
        "doc_id",
        F.explode(
            single_keys(F.col("hash"), F.array("source"), origin_uris(F.col("origin")))
        ).alias("key"),
    )
    found = keyed.join(broadcast_if_small(wanted), "key", "left_semi").select("doc_id").distinct()
    marked = cut(
        rows.join(found.withColumn("found", F.lit(True)), "doc_id", "left").withColumn(
            "found", F.col("found").isNotNull() | F.col("doc_id").isNull()
        )
    )
    return cut(marked.where("found").drop("found")), marked.where("NOT found").drop("found")


def _apply_store(store: DataFrame, final: DataFrame) -> DataFrame:
    written = (
        final.where("action IN ('MOVE', 'REPLACE') AND temp_path <> target_path")
        .groupBy(F.col("target_path").alias("path"))
        .agg(F.max_by("hash", "seq").alias("md5"))
    )
    gone = final.where("consumes").select(F.col("raw").alias("path")).union(
        written.select("path")
    )
    return store.join(gone, "path", "left_anti").unionByName(written)


KEPT = [
    "seq", "raw", "match_source", "temp_path", "target_path", "doc_id", "doc_source",
    "new_source", "hash", "length", "is_new", "creates", "ok", "action", "error", "uri",
]


def _run_rounds(
    facts: DataFrame,
    rows: DataFrame,
    store: DataFrame,
    as_of: Column,
    cfg: IntakeConfig,
    hot_rows: int | None,
) -> tuple[list[DataFrame], list[DataFrame], DataFrame, int]:
    rules = _rules(as_of, cfg)
    pending = facts.drop("tags", "metadata", "derivative", "mtime", "kind", "route", "cause")
    columns = pending.columns
    done, deletions, settled_rows, rounds, n_pending = [], [], [], 0, None
    empties = not pending.where(is_zero_length(F.col("length"))).isEmpty()
    while n_pending != 0:
        rounds += 1
        judged = cut(_judge(pending, rows, store, rules, hot_rows, empties))
        settled, n_pending = _settle(judged, rows, hot_rows, not cfg.recent_tolerance)
        replaces = F.coalesce(F.col("becomes") == "REPLACE", F.lit(False))
        moves = F.col("temp_path") != F.col("target_path")
        judged = cut(
            judged.join(settled, "seq")
            .withColumns(
                {
                    "action": F.coalesce("becomes", "action"),
                    "new_source": F.when(replaces, F.col("target_path")).otherwise(
                        F.col("new_source")
                    ),
                    "consumes": F.col("consumes")
                    | (replaces & F.col("uri").isNull() & moves),
                }
            )
            .drop("reads", "writes", "touches")
        )
        final = judged.where("NOT blocked")
        superseded = superseded_rows(rows, final.where("action = 'REPLACE'"), hot_rows)
        deleted = cut(
            superseded.withColumn("replaced", F.lit(True))
            .union(final.where("deletes_own").select("doc_id", F.lit(False)))
            .groupBy("doc_id")
            .agg(F.max("replaced").alias("replaced"))
        )
        rows = cut(_apply_rows(rows, final, deleted, as_of, hot_rows))
        done.append(final.select(*KEPT))
        deletions.append(deleted)
        if n_pending == 0:
            break

        store = cut(_apply_store(store, final))
        rows, rest = _split_rows(rows, judged.where("blocked"))
        settled_rows.append(rest)
        used = final.where("consumes").select("raw").distinct().withColumn("used", F.lit(True))
        lost = F.col("used") & F.col("uri").isNull() & F.col("static_error").isNull()
        pending = (
            lookup(judged.where("blocked").select(columns), used, "raw", hot_rows=hot_rows)
            .withColumn(
                "static_error",
                F.when(lost, F.lit("file_not_found")).otherwise(F.col("static_error")),
            )
            .drop("used")
        )
    return done, deletions, reduce(DataFrame.unionByName, [rows, *settled_rows]), rounds


def _document_changes(outcomes: DataFrame, facts: DataFrame, rows: DataFrame,
                      cfg: IntakeConfig) -> DataFrame:
    """One row per updated document: additions of all its messages, newest first."""
    ok = outcomes.where("outcome = 'ok'").select("seq", "doc_id", "action", "target_path")
    merged = ok.join(
        facts.select("seq", "tags", "metadata", "derivative", "length", "mtime", "kind"), "seq"
    )
    newest_first = F.struct((-F.col("seq")).alias("a"), F.col("at"))
    tags = distinct_items(
        merged.select("seq", "doc_id", F.posexplode("tags").alias("at", "item")),
        "doc_id", F.col("item"), newest_first, "tags",
    )
    metadata = distinct_items(
        merged.select("seq", "doc_id", F.posexplode("metadata").alias("at", "item")),
        "doc_id", F.col("item"), newest_first, "metadata",
    )
    last = merged.groupBy("doc_id").agg(
        F.max(F.struct("seq", F.coalesce("derivative", F.lit(False)).alias("derivative")))[
            "derivative"
        ].alias("derivative"),
        F.max(
            F.when(
                F.col("action").isin("MOVE", "REPLACE"),
                F.struct("seq", "target_path", "length", "mtime", "kind"),
            )
        ).alias("moved"),
    )
    joined = (
        last.join(tags, "doc_id", "left")
        .join(metadata, "doc_id", "left")
        .join(rows.select("doc_id", "source", "origin"), "doc_id")
    )
    moved = F.col("moved")
    return joined.select(
        "doc_id",
        "source",
        "origin",
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
        F.coalesce("metadata", F.array().cast(f"array<{META}>")).alias("metadata"),
        "derivative",
        F.when(
            moved.isNotNull(),
            file_attrs(moved["target_path"], moved["length"], moved["mtime"], cfg.root),
        ).alias("attrs"),
        F.when(
            moved.isNotNull(), detect_mimetype(moved["kind"], moved["target_path"])
        ).alias("mimetype"),
    )


def ingest_batch(
    messages: DataFrame,
    files: DataFrame,
    captures: DataFrame,
    catalog: DataFrame,
    mappings: DataFrame,
    flags: DataFrame,
    as_of: Column,
    cfg: IntakeConfig = DEFAULT,
    hot_rows: int = HOT_ROWS,
) -> IngestResult:
    """Take in one batch; ``seq`` gives the arrival order and is unique.

    The result reads tables in the checkpoint folder until it is released.
    """
    with run_folder(messages.sparkSession) as scratch:
        return _ingest(
            messages, files, captures, catalog, mappings, flags, as_of, cfg, hot_rows, scratch
        )


def _ingest(
    messages: DataFrame,
    files: DataFrame,
    captures: DataFrame,
    catalog: DataFrame,
    mappings: DataFrame,
    flags: DataFrame,
    as_of: Column,
    cfg: IntakeConfig,
    hot_rows: int,
    scratch: str,
) -> IngestResult:
    facts = cut(message_facts(messages, files, captures, cfg, hot_rows))
    keys = F.size("sources") + F.coalesce(F.size("msg_origins"), F.lit(0)) + 2  # hash and target
    if (facts.agg(F.sum(F.greatest(keys, F.lit(2)))).first()[0] or 0) < hot_rows:
        hot_rows = None  # not even all keys of all messages together are that many
    start_rows = _slice_catalog(facts, catalog, flags, cfg)
    store = _slice_store(facts, start_rows, files, cfg)
    done, deletions, rows, rounds = _run_rounds(facts, start_rows, store, as_of, cfg, hot_rows)

    final = reduce(DataFrame.unionByName, done)
    deletions = reduce(DataFrame.union, deletions)
    deleted = deletions.select("doc_id").distinct()
    # only a replacement takes the edges of the deleted documents with it
    parents = deletions.where("replaced").select("doc_id").distinct()
    outcome = F.when(F.col("ok"), F.lit("ok")).otherwise(
        F.coalesce("error", F.lower("action"))
    )
    # counted while they are written, without a pass of their own
    seen = Observation()
    outcomes = cut(
        final.withColumn("outcome", outcome)
        .withColumn("consumer", F.lit(cfg.consumer))
        .observe(seen, *[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES])
    )

    changes = _document_changes(outcomes, facts, rows, cfg)
    created = outcomes.where("creates").join(
        facts.select("seq", "derivative"), "seq"
    ).withColumn(
        # a remote document is created as no derivative; its update sets the flag
        "derivative", F.when(F.col("uri").isNull(), F.col("derivative"))
    )
    new_rows = new_catalog_rows(created, as_of).join(deleted, "doc_id", "left_anti")
    touched = cut(changes.select("doc_id"))
    few = broadcast_if_small(touched)
    old_rows = catalog.join(few, "doc_id", "left_semi")
    changed_rows = cut(upsert_catalog(old_rows.unionByName(new_rows), changes, as_of))
    replaced = broadcast_if_small(
        cut(changed_rows.select("doc_id").union(deleted).distinct())
    )
    new_catalog = catalog.join(replaced, "doc_id", "left_anti").select(
        changed_rows.columns
    ).unionByName(changed_rows)

    derived = (
        outcomes.where("outcome = 'ok'")
        .join(facts.where("derivative").select("seq"), "seq", "left_semi")
        .select("seq", F.col("raw").alias("source"), "doc_id")
    )
    new_mappings = update_lineage(delete_lineage(mappings, parents), derived, cfg)

    started = (
        outcomes.where("error IS NULL")
        .groupBy("doc_id")
        .agg(F.max_by("ok", "seq").alias("finished"))
    )
    zero_new = outcomes.where("is_new AND action = 'ZERO_LENGTH'").select("doc_id")
    no_flag = deleted.union(zero_new)
    changed_flags = mark_run_state(flags.limit(0), started, as_of, cfg).join(
        no_flag, "doc_id", "left_anti"
    )
    new_flags = mark_run_state(flags, started, as_of, cfg).join(no_flag, "doc_id", "left_anti")
    deleted_edges = mappings.join(
        parents.select(F.col("doc_id").alias("parent")), "parent", "left_semi"
    ).select("mapping_id")

    # edges that now have a child are those of the derived messages' paths
    touched_edges = new_mappings.join(
        derived.select(F.col("doc_id").alias("child")).distinct(), "child", "left_semi"
    ).select(mappings.columns)
    actions = cut(path_actions(outcomes.where("action IS NOT NULL"), cfg))
    payloads = facts.select("seq", F.col("hash").alias("md5"), "length", "mtime", "kind")
    moved = cut(file_changes(actions, payloads))
    failed = messages.join(
        outcomes.where("outcome NOT IN ('ok', 'zero_length')").select("seq", "outcome"), "seq"
    )

    return IngestResult(
        catalog=new_catalog,
        mappings=new_mappings,
        flags=new_flags,
        actions=actions,
        outcomes=outcomes,
        notifications=emit_notifications(outcomes),
        errors=emit_errors(outcomes.join(facts.select("seq", "cause"), "seq")),
        changed_rows=changed_rows,
        deleted=deleted,
        changed_flags=changed_flags,
        deleted_edges=deleted_edges,
        touched_edges=touched_edges,
        changed_files=moved.where("content IS NOT NULL").select("path", "content.*"),
        deleted_files=moved.where("content IS NULL").select("path"),
        failed=failed,
        counts={o: n for o, n in seen.get.items() if n},
        rounds=rounds,
        scratch=scratch,
    )
