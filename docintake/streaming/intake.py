"""Continuous intake: each micro-batch of messages goes through the batch job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docintake.config import DEFAULT, IntakeConfig
from docintake.functions.uris import scheme_label, scheme_of
from docintake.operators.catalog import confirm_updates
from docintake.operators.metrics import merged_summary, summary_sketches
from docintake.operators.runs import retry_candidates
from docintake.plans.ingest import ingest_batch
from docintake.schema import MESSAGE
from docintake.session import cut, remove_folder, run_folder
from docintake.sources.messages import decode_messages
from docintake.sources.sinks import emit_errors
from docintake.sources.tables import TableStore, is_complete


# Fixed value: what may come right by itself, so that it is tried again.
RETRIED = ("file_not_found", "no_document", "missing_target", "update_failed")


SIZE_LABELS = ["scheme", "action"]


def take_in(
    raw: DataFrame,
    batch_id: int,
    store: TableStore,
    landed: DataFrame | None,
    captures: DataFrame,
    as_of: Column,
    cfg: IntakeConfig = DEFAULT,
) -> None:
    """Apply one micro-batch to the store; a batch already in it is left alone.

    The store's ``files`` are what the batches before this one left. ``landed`` are files
    that have arrived since; one at a known path replaces what was there. Messages that
    failed for want of a file or a document are in ``retries`` and come again with the
    next batches, before its own messages, ``cfg.max_retries`` times.
    """
    last = store.last_batch()
    if last is not None and batch_id <= last:
        confirm(store, batch_id, cfg)  # the run before may have ended between the two
        return
    spark = raw.sparkSession
    with run_folder(spark) as scratch:
        decoded, bad = decode_messages(raw)
        waiting = store.load("retries")
        good = cut(
            decoded.withColumn("attempt", F.lit(0)).unionByName(
                waiting.select(*decoded.columns, "attempt")
            )
        )
        files = store.load("files")
        if landed is not None:
            landed = cut(landed.select(files.columns))
            files = cut(files.join(landed, "path", "left_anti").unionByName(landed))
        result = ingest_batch(
            good.drop("attempt"), files, captures, store.load("catalog"), store.load("mappings"),
            store.load("flags"), as_of, cfg,
        )
        out = f"{store.path}/out"
        number = f"batch={batch_id}"
        result.notifications.write.mode("overwrite").text(f"{out}/notifications/{number}")
        failed = good.join(result.failed.select("seq", "outcome"), "seq")
        again = cut(retry_candidates(failed.where(F.col("outcome").isin(*RETRIED)), cfg.max_retries))
        errors = result.errors.join(again.select("seq"), "seq", "left_anti").unionByName(
            bad.select(
                "seq", F.col("value").alias("source"), "outcome",
                F.col("error").alias("error_text"),
            )
        )
        errors.write.mode("overwrite").parquet(f"{out}/errors/{number}")
        result.actions.write.mode("overwrite").parquet(f"{out}/actions/{number}")
        counts = spark.createDataFrame(list(result.counts.items()), "outcome string, n bigint")
        counts.coalesce(1).write.mode("overwrite").parquet(f"{out}/counts/{number}")
        sizes = result.outcomes.where("outcome = 'ok'").select(
            F.coalesce(scheme_label(scheme_of(F.col("uri"))), F.lit("file")).alias("scheme"),
            "action", "length",
        )
        summary_sketches(sizes, SIZE_LABELS, "length").write.mode("overwrite").parquet(
            f"{out}/sizes/{number}"
        )
        updated = result.outcomes.where("outcome = 'ok'").select("seq", "doc_id").join(
            result.changed_rows.select("doc_id"), "doc_id", "left_semi"
        )
        good.join(updated, "seq").write.mode("overwrite").parquet(f"{out}/expected/{number}")
        changed_files = result.changed_files.select(files.columns)
        if landed is not None:
            touched = changed_files.select("path").union(result.deleted_files)
            changed_files = changed_files.unionByName(landed.join(touched, "path", "left_anti"))
        store.commit_changes(
            {
                "catalog": result.changed_rows,
                "mappings": result.touched_edges,
                "flags": result.changed_flags,
                "files": changed_files,
                "retries": again.select(waiting.columns),
            },
            {
                "catalog": result.deleted,
                "mappings": result.deleted_edges,
                "flags": result.deleted,
                "files": result.deleted_files,
                "retries": waiting.join(again.select("seq"), "seq", "left_anti").select("seq"),
            },
            batch_id,
        )
        result.release()
    remove_folder(spark, scratch)
    confirm(store, batch_id, cfg)
    store.compact_if_long()


def confirm(store: TableStore, batch_id: int, cfg: IntakeConfig = DEFAULT) -> None:
    """Look for a committed batch's documents in what its commit wrote.

    Messages whose document is not there end as ``update_failed``: they wait in ``retries``, or
    are listed in ``out/unconfirmed`` once they were tried often enough. A batch is confirmed
    once; a confirmation that was broken off is done again, with the same result.
    """
    spark, number = store.spark, f"batch={batch_id}"
    done = f"{store.path}/out/confirmed/{number}"
    commits = spark.read.schema("batch_id bigint").json(f"{store.path}/commits/*")
    name = F.element_at(F.split("_metadata.file_path", "/"), -2)
    row = commits.where((F.col("batch_id") == batch_id) & name.endswith("-part")).agg(F.min(name)).first()
    if row[0] is None or is_complete(spark, done):
        return
    version = int(row[0].split("-")[0])
    expected = spark.read.parquet(f"{store.path}/out/expected/{number}")
    stored = spark.read.parquet(f"{store.path}/catalog/changed/version={version}")
    with run_folder(spark) as scratch:
        checked = cut(confirm_updates(expected, stored.select("doc_id")).where("NOT confirmed"))
        if not checked.isEmpty():
            waiting = store.load("retries")
            failed = checked.withColumn("outcome", F.lit("update_failed"))
            again = cut(retry_candidates(failed, cfg.max_retries))
            store.commit_changes({"retries": again.select(waiting.columns)})
            lost = failed.join(again.select("seq"), "seq", "left_anti")
            emit_errors(lost.withColumn("raw", F.col("source"))).write.mode("overwrite").parquet(
                f"{store.path}/out/unconfirmed/{number}"
            )
        remove_folder(spark, scratch)
    spark.range(1).coalesce(1).write.mode("overwrite").json(done)


def size_summary(store: TableStore) -> DataFrame:
    """Sizes of all documents taken in so far by scheme and action, from the batches' sketches."""
    return merged_summary(store.spark.read.parquet(f"{store.path}/out/sizes"), SIZE_LABELS)


def new_store(
    spark, path: str, catalog: DataFrame, mappings: DataFrame, flags: DataFrame, files: DataFrame
) -> TableStore:
    """Store that a stream starts from; nothing waits to be tried again."""
    store = TableStore(spark, path)
    retries = spark.createDataFrame([], f"{MESSAGE}, attempt int")
    store.commit_full(
        {"catalog": catalog, "mappings": mappings, "flags": flags, "files": files, "retries": retries}
    )
    return store


def ingest_stream(
    messages: DataFrame,
    store: TableStore,
    captures: DataFrame,
    checkpoint: str,
    landed: Callable[[int], DataFrame | None] | None = None,
    as_of: Column | None = None,
    cfg: IntakeConfig = DEFAULT,
    **trigger,
) -> StreamingQuery:
    """Start taking in a stream of (seq, value); delivery at least once, effect once.

    ``landed`` gives, for a batch's number, the files that arrived since the batch before;
    it must give the same ones when a batch is repeated.
    """
    time = F.current_timestamp() if as_of is None else as_of

    def handle(batch: DataFrame, batch_id: int) -> None:
        now = time
        if as_of is None:
            # one clock reading for the whole batch
            now = F.lit(batch.sparkSession.range(1).select(time).first()[0])
        arrived = landed(batch_id) if landed else None
        take_in(batch, batch_id, store, arrived, captures, now, cfg)

    return (
        messages.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
