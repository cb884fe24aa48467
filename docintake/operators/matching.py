"""Matching messages to catalog rows by content hash, path or origin URI.

"hash = h OR source IN (raw, target) OR any origin URI = u" is a join on a union of
keys. Rows of the catalog are first reduced to one entry per key (row count and newest
row), so a key shared by many messages and many rows never makes all their pairs. The
number of distinct matching rows follows from counting single keys and subtracting
rows that match on two of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docintake.session import cut
from docintake.operators.skew import HOT_ROWS, lookup

SEPARATOR = "\x01"


def _key(kind: str, *parts: Column) -> Column:
    return F.concat_ws(SEPARATOR, F.lit(kind), *parts)


def _entry(sign: int, kind: str, *parts: Column) -> Column:
    complete = parts[0].isNotNull()
    for part in parts[1:]:
        complete = complete & part.isNotNull()
    return F.when(
        complete, F.struct(F.lit(sign).alias("sign"), _key(kind, *parts).alias("key"))
    )


def single_keys(hash_: Column, sources: Column, uris: Column) -> Column:
    """Keys under which a row can be found: its hash, its source and its origin URIs."""
    parts = F.concat(
        F.array(F.when(hash_.isNotNull(), _key("H", hash_))),
        F.transform(sources, lambda s: F.when(s.isNotNull(), _key("S", s))),
        F.transform(uris, lambda u: F.when(u.isNotNull(), _key("U", u))),
    )
    return F.array_distinct(F.filter(parts, lambda k: k.isNotNull()))


def _counting_keys(hash_: Column, sources: Column, uris: Column, with_uri: bool) -> Column:
    """Single keys with +1, pairs with -1 and triples with +1."""
    parts = [
        F.array(_entry(1, "H", hash_)),
        F.transform(sources, lambda s: _entry(1, "S", s)),
        F.transform(sources, lambda s: _entry(-1, "HS", hash_, s)),
    ]
    if with_uri:
        parts += [
            F.transform(uris, lambda u: _entry(1, "U", u)),
            F.transform(uris, lambda u: _entry(-1, "HU", hash_, u)),
            F.flatten(
                F.transform(
                    sources, lambda s: F.transform(uris, lambda u: _entry(-1, "SU", s, u))
                )
            ),
            F.flatten(
                F.transform(
                    sources,
                    lambda s: F.transform(uris, lambda u: _entry(1, "HSU", hash_, s, u)),
                )
            ),
        ]
    return F.array_distinct(F.filter(F.concat(*parts), lambda e: e.isNotNull()))


def origin_uris(origin: Column) -> Column:
    uris = F.filter(F.transform(origin, lambda o: o["uri"]), lambda u: u.isNotNull())
    return F.coalesce(F.array_distinct(uris), F.array().cast("array<string>"))


def match_catalog(
    messages: DataFrame,
    catalog: DataFrame,
    keys: tuple[str, ...] = ("hash", "source"),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Count and newest of the catalog rows each message matches.

    ``messages`` has seq, hash, sources and, with the key ``origin_uri``, uri. Adds
    n_matches and newest (created, doc_id, hash, source), NULL without a match.
    """
    with_uri = "origin_uri" in keys
    none = F.array().cast("array<string>")
    row_uris = origin_uris(F.col("origin")) if with_uri else none
    message_uris = F.array("uri") if with_uri else none

    entries = catalog.select(
        "created", "doc_id", "hash", "source",
        F.explode(
            _counting_keys(F.col("hash"), F.array("source"), row_uris, with_uri)
        ).alias("e"),
    )
    index = (
        entries.groupBy(F.col("e.key").alias("key"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.max(F.struct("created", "doc_id", "hash", "source")).alias("newest"),
        )
    )
    wanted = messages.select(
        "seq",
        F.explode(
            _counting_keys(F.col("hash"), F.array_distinct("sources"), message_uris, with_uri)
        ).alias("e"),
    ).select("seq", "e.key", "e.sign")
    if hot_rows is not None:
        wanted = cut(wanted)  # looked at for hot keys first, so not to be made twice
    hits = (
        lookup(wanted, index, "key", how="inner", hot_rows=hot_rows)
        .groupBy("seq")
        .agg(
            F.sum(F.col("sign") * F.col("rows")).cast("bigint").alias("n_matches"),
            F.max("newest").alias("newest"),
        )
    )
    return messages.join(hits, "seq", "left").withColumn(
        "n_matches", F.coalesce("n_matches", F.lit(0).cast("bigint"))
    )


def latest_and_archivable(matches: DataFrame) -> DataFrame:
    """Is the newest match the same document? All other matches are older versions."""
    same = F.coalesce(F.col("newest.hash") == F.col("hash"), F.lit(False))
    return (
        matches.withColumn("doc_id", F.when(same, F.col("newest.doc_id")))
        .withColumn("doc_source", F.when(same, F.col("newest.source")))
        .withColumn("is_new", ~same)
        .withColumn(
            "n_archivable",
            F.when(same, F.col("n_matches") - 1).otherwise(F.col("n_matches")),
        )
    )


def superseded_rows(
    catalog: DataFrame, replacing: DataFrame, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """doc_id of every row that a replacing message matches, but for its own document.

    ``replacing`` has doc_id, hash, sources and uri. Per key only the smallest and the
    largest kept doc_id are needed: a row goes if one of them is not its own.
    """
    kept = (
        replacing.select(
            "doc_id",
            F.explode(single_keys(F.col("hash"), F.col("sources"), F.array("uri"))).alias("key"),
        )
        .groupBy("key")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    )
    rows = catalog.select(
        "doc_id",
        F.explode(
            single_keys(F.col("hash"), F.array("source"), origin_uris(F.col("origin")))
        ).alias("key"),
    )
    return (
        lookup(rows, kept, "key", how="inner", spread_by="doc_id", hot_rows=hot_rows)
        .where((F.col("low") != F.col("doc_id")) | (F.col("high") != F.col("doc_id")))
        .select("doc_id")
        .distinct()
    )


def content_dedup(files: DataFrame) -> DataFrame:
    """One row per content: the file seen first stands for all its copies."""
    return files.groupBy("md5").agg(
        F.min(F.struct("seq", "path"))["path"].alias("path"),
        F.min("seq").alias("first_seq"),
        F.count(F.lit(1)).alias("n_copies"),
        (F.sum("length") - F.min("length")).cast("bigint").alias("bytes_saved"),
    )
