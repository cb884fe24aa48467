"""Following recorded redirects and attaching the payloads they lead to."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docintake.config import DEFAULT, FTP_SCHEMES, HTTP_SCHEMES, IntakeConfig
from docintake.functions.headers import header_content_type, header_filename
from docintake.functions.mimetypes import detect_mimetype
from docintake.functions.naming import remote_file_path, shorten_path
from docintake.functions.uris import (
    default_port,
    host_of,
    path_of,
    port_of,
    scheme_of,
    scheme_status,
    userinfo_of,
)
from docintake.operators.skew import HOT_ROWS, lookup
from docintake.schema import HEADERS, META, ORIGIN
from docintake.session import cut

# Statuses the origin chain follows, and those a payload fetch follows.
RESOLVE_STATUSES = (301, 302)
FETCH_STATUSES = tuple(range(300, 400))


def _origin(uri, headers, status):
    metadata = F.when(
        status.isNotNull(),
        F.array(
            F.struct(
                F.lit("status").alias("key"),
                F.lit("int").alias("vtype"),
                status.cast("string").alias("value"),
            )
        ),
    )
    return F.struct(
        scheme_of(uri).alias("scheme"),
        host_of(uri).alias("hostname"),
        uri.alias("uri"),
        headers.cast(HEADERS).alias("headers"),
        metadata.cast(f"array<{META}>").alias("metadata"),
    ).cast(ORIGIN)


def current_captures(captures: DataFrame) -> DataFrame:
    """The newest capture of each URI; a log may hold many, a server gives one answer."""
    others = [c for c in captures.columns if c not in ("uri", "fetched")]
    newest = F.max(F.struct("fetched", *others)).alias("newest")
    return captures.groupBy("uri").agg(newest).select(
        "uri", *[F.col(f"newest.{c}").alias(c) for c in captures.columns if c != "uri"]
    )


def _walks(
    starts: DataFrame, hops: DataFrame, most: int | None, hot_rows: int | None
) -> DataFrame:
    """``uri, pos, node`` of each walk from a distinct URI over ``hops`` (node, to).

    Walks double: with the jumps of ``reach`` hops at hand, the nodes at places ``reach`` to
    ``2 * reach - 1`` follow from those before them, and a jump of a jump reaches twice as
    far. So n hops take about log2(n) rounds, and a walk that has ended is left alone. A walk
    that comes back to one of its nodes ends before it does, any walk after ``most`` nodes.
    """
    node, repeat = Window.partitionBy("uri", "node").orderBy("pos"), Window.partitionBy("uri")
    jumps, reach, done = hops, 1, []
    active = starts.select("uri", F.lit(0).cast("bigint").alias("pos"), F.col("uri").alias("node"))
    while True:
        # starts are distinct; only nodes further on are shared, and only by many walks
        hot = hot_rows if reach > 1 else None
        new = lookup(active, jumps, "node", how="inner", spread_by="uri", hot_rows=hot).select(
            "uri", (F.col("pos") + reach).alias("pos"), F.col("to").alias("node")
        )
        if most is not None:
            new = new.where(F.col("pos") < most)
        again = F.when(F.lag("pos").over(node).isNotNull(), F.col("pos"))
        state = cut(
            active.unionByName(new)
            .repartition("uri")
            .withColumn("again", again)
            .withColumns(
                {"stop": F.min("again").over(repeat), "n": F.count(F.lit(1)).over(repeat)}
            )
            .where("stop IS NULL OR pos < stop")
            .select("uri", "pos", "node", (F.col("stop").isNull() & (F.col("n") == 2 * reach)).alias("goes_on"))
        )
        if most is not None and 2 * reach >= most:
            done.append(state.select("uri", "pos", "node"))
            break
        done.append(state.where("NOT goes_on").select("uri", "pos", "node"))
        active = state.where("goes_on").select("uri", "pos", "node")
        if active.isEmpty():
            break
        jumps = cut(
            lookup(
                jumps.select(F.col("node").alias("from"), F.col("to").alias("node")), jumps, "node",
                how="inner", spread_by="from", hot_rows=hot_rows,
            ).select(F.col("from").alias("node"), "to")
        )
        reach *= 2
    return reduce(DataFrame.unionByName, done)


def _follow(
    uris: DataFrame,
    log: DataFrame,
    statuses: tuple[int, ...],
    max_requests: int | None,
    hot_rows: int | None,
) -> DataFrame:
    """Walk from each distinct URI over the redirects of the log.

    Only redirect rows are jumped over; the whole log is joined once, with the nodes of all
    walks, and each chain is put together once.
    """
    none = F.lit(None)
    is_http = F.coalesce(scheme_of(F.col("node")).isin(*HTTP_SCHEMES), F.lit(False))
    is_ftp = F.coalesce(scheme_of(F.col("node")).isin(*FTP_SCHEMES), F.lit(False))
    hops = cut(
        log.where(F.col("status").isin(*statuses) & F.col("location").isNotNull())
        .select(F.col("uri").alias("node"), F.col("location").alias("to"))
        .where(is_http)
    )
    starts = uris.select("uri").where(F.col("uri").isNotNull()).distinct()
    walks = _walks(starts, hops, max_requests, hot_rows)
    answers = log.select(F.col("uri").alias("node"), "status", "location", "headers")
    redirected = is_http & F.coalesce(F.col("status").isin(*statuses), F.lit(False))
    error = (
        F.when(redirected, F.when(F.col("location").isNull(), F.lit("unable_to_follow")))
        .when(~is_http & ~is_ftp, scheme_status(F.col("node")))
        .when(is_http & F.col("status").isNull(), F.lit("not_captured"))
    )
    visited = F.when(is_ftp, _origin(F.col("node"), none, none.cast("int"))).otherwise(
        _origin(F.col("node"), F.col("headers"), F.col("status"))
    )
    nodes = (
        lookup(walks if hot_rows is None else cut(walks), answers, "node", spread_by="uri", hot_rows=hot_rows)
        .withColumns({"redirected": redirected, "error": error})
        .withColumns(
            {
                "visited": F.when(F.col("redirected") | F.col("error").isNull(), visited),
                # the log answers an address the same way each time, so a walk that could
                # go on after its last node came back, or went too far
                "after": F.when(
                    F.col("redirected"), F.coalesce("location", "node")
                ).otherwise(F.col("node")),
                "status": F.when(is_http & ~(F.col("redirected") & F.col("location").isNotNull()), F.col("status")),
                "error": F.when(
                    F.col("redirected") & F.col("location").isNotNull(), F.lit("too_many_redirects")
                ).otherwise(F.col("error")),
            }
        )
    )
    ended = nodes.groupBy("uri").agg(
        F.array_sort(F.collect_list(F.when(F.col("visited").isNotNull(), F.struct("pos", "visited")))).alias("places"),
        F.max(F.struct("pos", F.struct("after", "status", "error").alias("end")))["end"].alias("end"),
    )
    return ended.select(
        "uri",
        F.col("end.after").alias("current"),
        F.transform("places", lambda p: p["visited"]).alias("chain"),
        F.col("end.status").alias("terminal_status"),
        F.col("end.error").alias("error"),
    )


def resolve_redirects(
    uris: DataFrame,
    log: DataFrame,
    statuses: tuple[int, ...] = RESOLVE_STATUSES,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Origin chain of each distinct URI, the canonical origin first, the start last.

    ``log`` has one capture per URI (see :func:`current_captures`). Chains may be of any
    length; one that comes back to itself ends there.
    """
    walked = _follow(uris, log, statuses, None, hot_rows)
    return walked.select(
        "uri",
        F.reverse("chain").alias("chain"),
        F.size("chain").cast("bigint").alias("n_origins"),
        F.col("current").alias("terminal_uri"),
        F.col("terminal_status").cast("bigint").alias("terminal_status"),
        "error",
    )


def _answered(df: DataFrame, n_requests, status) -> DataFrame:
    """Ends of walks as payload facts; an end other than a 200 answer is an error."""
    is_http = scheme_of(F.col("current")).isin(*HTTP_SCHEMES)
    return df.select(
        "uri",
        F.col("current").alias("payload_uri"),
        n_requests.cast("bigint").alias("n_requests"),
        status.cast("bigint").alias("status"),
        F.coalesce("error", F.when(is_http & (status != 200), F.lit("bad_status"))).alias("error"),
    )


def follow_to_payload(
    uris: DataFrame,
    log: DataFrame,
    max_requests: int = DEFAULT.max_requests,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Follow any redirect status to a 200 answer; every other end is an error."""
    walked = _follow(uris, log, FETCH_STATUSES, max_requests, hot_rows)
    return _answered(walked, F.size("chain"), F.col("terminal_status"))


def attach_payloads(
    resolved: DataFrame,
    log: DataFrame,
    cfg: IntakeConfig = DEFAULT,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Body facts and paths of the document each resolved URI leads to.

    The payload is looked for from the end of the resolved chain on; only ends with some
    other redirect status are walked any further.
    """
    canonical = resolved.withColumn("origin", F.try_element_at("chain", F.lit(1))).withColumn(
        "origin_uri", F.when(F.col("error").isNull(), F.col("origin.uri"))
    )
    canonical = cut(canonical)
    ends = canonical.where("origin_uri IS NOT NULL").groupBy(F.col("origin_uri").alias("uri")).agg(
        F.first("terminal_status").alias("terminal_status")
    )
    more = F.coalesce(F.col("terminal_status").isin(*FETCH_STATUSES), F.lit(False))
    direct = ends.where(~more).select(
        "uri", F.col("uri").alias("current"), "terminal_status", F.lit(None).cast("string").alias("error")
    )
    fetched = _answered(direct, F.lit(1), F.col("terminal_status"))
    further = cut(ends.where(more).select("uri"))
    if not further.isEmpty():
        fetched = fetched.unionByName(follow_to_payload(further, log, cfg.max_requests, hot_rows))
    fetched = cut(fetched)
    bodies = log.select(
        F.col("uri").alias("payload_uri"),
        F.col("headers").alias("p_headers"),
        F.col("md5").alias("hash"),
        "length",
        "kind",
    )
    payloads = lookup(
        fetched.where("error IS NULL"), bodies, "payload_uri", spread_by="uri", hot_rows=hot_rows
    ).unionByName(fetched.where("error IS NOT NULL"), allowMissingColumns=True)
    payloads = payloads.select(
        F.col("uri").alias("origin_uri"),
        F.col("error").alias("fetch_error"),
        F.col("status").alias("fetch_status"),
        "p_headers", "hash", "length", "kind", "payload_uri",
    )
    # starts that led nowhere have no origin and would all meet at one key
    led = canonical.where("origin_uri IS NOT NULL")
    joined = lookup(led, payloads, "origin_uri", spread_by="uri", hot_rows=hot_rows).unionByName(
        canonical.where("origin_uri IS NULL"), allowMissingColumns=True
    )

    is_http = F.col("origin.scheme").isin(*HTTP_SCHEMES)
    file_name = F.when(is_http, header_filename(F.col("p_headers")))
    content_type = F.when(is_http, header_content_type(F.col("p_headers")))

    def path(root: str):
        full = remote_file_path(
            F.col("origin.uri"), F.col("origin.headers"), root, file_name, content_type
        )
        return F.when(is_http, shorten_path(F.col("origin.uri"), full)).otherwise(full)

    error = F.coalesce(
        "error", "fetch_error", F.when(F.col("hash").isNull(), F.lit("not_captured"))
    )
    good = F.col("error").isNull()
    placed = joined.withColumn("error", error).withColumn(
        "target_path", F.when(good, path(cfg.remote))
    )
    return placed.select(
        "uri",
        "chain",
        F.when(good, F.col("origin_uri")).alias("origin_uri"),
        F.when(good, path(cfg.remote_ingress)).alias("temp_path"),
        "target_path",
        F.when(good, F.col("hash")).alias("hash"),
        F.when(good, F.col("length")).alias("length"),
        F.when(good, F.col("kind")).alias("kind"),
        F.when(good, detect_mimetype(F.col("kind"), F.col("target_path"))).alias("mimetype"),
        "error",
        F.coalesce("fetch_status", "terminal_status").alias("status"),
    )


def endpoint_profile(starts: DataFrame) -> DataFrame:
    """Server, port and kind of login of each ftp URI; passwords are never read out."""
    uri = F.col("uri")
    scheme = scheme_of(uri)
    user = F.regexp_extract(userinfo_of(uri), r"^([^:]*)", 1)
    ftp = starts.where(scheme.isin(*FTP_SCHEMES)).select(
        scheme.alias("scheme"),
        host_of(uri).alias("host"),
        F.coalesce(port_of(uri), default_port(scheme)).cast("bigint").alias("port"),
        F.coalesce(user, F.lit("anonymous")).alias("login"),
        path_of(uri).alias("path"),
    )
    return ftp.groupBy("scheme", "host", "port", "login").agg(
        F.count(F.lit(1)).alias("n"), F.min("path").alias("first_path")
    )
