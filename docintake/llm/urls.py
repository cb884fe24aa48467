"""URL rules, and block decisions that follow redirects and canonical links.

Rules are (host, path) pairs that block or allow. A rule fits its host and all subdomains if
the URL's path starts with the rule's; the longest rule wins, and allow wins over block
between rules of the same length. Pages whose rule allows stay allowed and pages whose rule
blocks stay blocked: an explicit decision goes before any alias. A page without a rule is
blocked if an alias is: any URL that is connected with it over redirects and canonical links
and that a rule blocks. Otherwise it is allowed.

Aliases are connected components of the link table. Its links are the canonical link and
the meta refresh in a page's html, each URL's own form without tracking parameters, and any
redirect table (source, target) that is passed in. URLs are nodes without their fragment, with
scheme and host in lower case; links are resolved against their page, dot segments included.
Only SQL functions are used, and no page table is joined on a key that many rows share
without a unique other side.

A null URL, or one without ``://``, has empty host and path, fits no rule, has no alias and
is allowed. Repeated rows are judged one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docintake.functions.binding import bind
from docintake.llm.columns import fresh
from docintake.llm.components import components
from docintake.session import cut

Rule = tuple[str, str]  # what it does, and host/path

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MOST_RULES = 2_000  # the rules are part of the plan


def _rest(url: Column) -> Column:
    at = F.instr(url, F.lit("://"))
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    found = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(found, _UPPER, _UPPER.lower()), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def node(url: Column) -> Column:
    """The URL without its fragment, scheme and host in lower case; null where not absolute."""
    bare = F.regexp_replace(url, r"(?s)#.*$", "")
    parts = r"(?s)^(.*?://)((?:[^/?]*@)?)([^/?]*)(.*)$"  # scheme, user, host, the rest

    def part(number: int) -> Column:
        return F.regexp_extract(bare, parts, number)

    def lower(text: Column) -> Column:
        return F.translate(text, _UPPER, _UPPER.lower())

    return F.when(
        F.instr(url, F.lit("://")) > 0, F.concat(lower(part(1)), part(2), lower(part(3)), part(4))
    )


def without_tracking(url: Column) -> Column:
    """The URL without parameters that only say where a visitor came from."""
    bare = F.regexp_replace(url, r"[?&](?:utm_[a-z]+|ref|gclid|fbclid)=[^&#]*", "")
    return F.regexp_replace(bare, r"^([^?&]*)&", "$1?")


def _without_dots(path_: Column) -> Column:
    """A path from the root without its segments ``.`` and ``..``."""
    parts = F.split(path_, "/")
    kept = F.aggregate(
        F.slice(parts, F.lit(2), F.size(parts)),
        F.array().cast("array<string>"),
        lambda out, p: F.when(p == "..", F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0))))
        .when(p == ".", out)
        .otherwise(F.concat(out, F.array(p))),
    )
    open_ = path_.rlike(r"/\.\.?$")  # a last segment of dots names a directory
    plain = bind(
        lambda v: F.concat(
            F.lit("/"), F.array_join(v["kept"], "/"),
            F.when(open_ & (F.size(v["kept"]) > 0), "/").otherwise(""),
        ),
        kept=kept,
    )
    return F.when(path_.rlike(r"/\.\.?(?:/|$)"), plain).otherwise(path_)


def _absolute(target: Column, url: Column) -> Column:
    """``target`` as a link on the page ``url``; null for other schemes and empty targets."""
    target = F.replace(F.trim(target), F.lit("&amp;"), F.lit("&"))
    origin = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    here = path(url)
    folder = F.when(here == "", "/").otherwise(F.regexp_extract(here, r"(?s)^(.*/)", 1))
    query = F.regexp_extract(target, r"(?s)[?#].*$", 0)
    asked = F.regexp_extract(target, r"(?s)^[^?#]*", 0)
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when((origin == "") | (target == "") | target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(target.startswith("//"), F.concat(F.substring_index(url, "//", 1), target))
        .when(target.startswith("/"), F.concat(origin, _without_dots(asked), query))
        .when(target.startswith("?"), F.concat(origin, here, target))
        .when(target.startswith("#"), url)
        .otherwise(F.concat(origin, _without_dots(F.concat(folder, asked)), query))
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Links ``a`` to ``b`` between the nodes of pages and their other forms."""
    link = F.regexp_extract(
        html, r"""(?i)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>""", 0)
    refresh = F.regexp_extract(
        html, r"""(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>""", 0)
    href = F.regexp_extract(link, r"""(?i)\bhref\s*=\s*["']?([^"'>\s]*)""", 1)
    to = F.regexp_extract(refresh, r"""(?i)\burl\s*=\s*["']?([^"'>\s]*)""", 1)
    here = node(F.col(url))
    others = F.array(
        without_tracking(here), node(_absolute(href, F.col(url))), node(_absolute(to, F.col(url)))
    )
    return pages.select(here.alias("a"), F.explode(others).alias("b")).where("a <> b")


def rule_of(host_: Column, path_: Column, rules: list[Rule]) -> Column:
    """The rule that decides, as ``struct(rule, verdict)``, or null."""
    if len(rules) > MOST_RULES:
        raise ValueError("too many rules for one plan; give them as a table")
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    order = sorted(rules, key=lambda r: (len(r[1]), r[0] == "allow", r[1]))
    for verdict, rule in order:  # the last one that is put around the others wins
        name, slash, rest = rule.partition("/")
        fits = (host_ == name) | host_.endswith("." + name)
        fits = fits & path_.startswith(slash + rest)
        decided = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, decided).otherwise(found)
    return found


def with_rule(df: DataFrame, host_: str, path_: str, rules, name: str) -> DataFrame:
    """``df`` with column ``name``, the rule that decides (see :func:`rule_of`).

    ``rules`` are a short list, or a table (verdict, rule) of any length. A table is joined
    with the keys of the distinct hosts and paths: each of a host's suffixes with the starts
    of the path that are as long as some rule's.
    """
    if not isinstance(rules, DataFrame):
        return df.withColumn(name, rule_of(F.col(host_), F.col(path_), rules))
    known = rules.select(F.col("rule").alias("key"), F.col("verdict").alias("does"))
    path_length = F.length("key") - F.instr("key", F.lit("/")) + 1
    # as many numbers as there are lengths of paths
    lengths = sorted(r[0] for r in known.select(path_length).distinct().collect())
    asked = df.select(F.col(host_).alias("h"), F.col(path_).alias("p")).distinct()
    labels = F.split("h", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    starts = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("p")),
        lambda n: F.substring(F.col("p"), 1, n),
    )
    keys = F.flatten(
        F.transform(suffixes, lambda s: F.transform(starts, lambda t: F.concat(s, t)))
    )
    best = F.max(F.struct(F.length("key").alias("n"), (F.col("does") == "allow").alias("a"), "key", "does"))
    found = (
        asked.select("h", "p", F.explode(F.array_distinct(keys)).alias("key"))
        .join(known, "key")
        .groupBy("h", "p")
        .agg(best.alias("best"))
        .select(
            F.col("h").alias(host_),
            F.col("p").alias(path_),
            F.struct(F.col("best.key").alias("rule"), F.col("best.does").alias("verdict")).alias(name),
        )
    )
    return df.join(found, [host_, path_], "left")


def judge(
    pages: DataFrame,
    rules: list[Rule] | DataFrame,
    redirects: DataFrame | None = None,
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """``pages`` without html, with host, path, rule, verdict."""
    links = page_links(pages, url, html)
    if redirects is not None:
        extra = redirects.select(node(F.col("source")).alias("a"), node(F.col("target")).alias("b"))
        links = links.unionByName(extra)
    member = cut(components(cut(links.distinct())))
    judged = member.withColumn("host", host(F.col("node"))).withColumn("path", path(F.col("node")))
    judged = with_rule(judged, "host", "path", rules, "decided")
    blocks = F.col("decided.verdict") == "block"
    blocked = judged.groupBy("component").agg(F.max(blocks).alias("blocked"))
    blocked = blocked.where("blocked").join(member, "component")

    kept = [c for c in pages.columns if c != html]
    names = fresh(pages.select(*kept), "host", "path", "decided", "alias", "rule", "verdict")
    host_, path_, decided_, alias_, rule_, verdict_ = names
    judged = (
        pages.select(*kept)
        .withColumn(host_, host(F.col(url)))
        .withColumn(path_, path(F.col(url)))
        .withColumn(alias_, node(F.col(url)))
    )
    judged = with_rule(judged, host_, path_, rules, decided_)
    blocked = blocked.select(F.col("node").alias(alias_), F.lit("block").alias(verdict_))
    judged = judged.join(blocked, alias_, "left")
    return judged.select(
        *kept,
        host_,
        path_,
        F.col(decided_)["rule"].alias(rule_),
        F.coalesce(F.col(decided_)["verdict"], verdict_, F.lit("allow")).alias(verdict_),
    )
