"""Document fingerprints of closed syncmers.

The letters of a text are what its characters end: each character but the lower-case ones of
``INSIDE`` (blanks, capitals, digits, marks, everything beyond ASCII, and some of a to z) ends a
letter. So letters are about half a word of plain prose and single characters of scripts without
blanks, code or numbers, by one rule for texts of every size, and an edit changes only the
letters around it. A k-mer is ``K`` letters; its inner substrings are the ``S`` letters from each
of its places on, by their hashes. A k-mer is chosen if the smallest of them is its first or its
last. The choice depends on nothing outside the k-mer, so equal passages have equal anchors
wherever they stand, and of any K - S neighbouring k-mers at least one is chosen. An anchor is
a place (a letter's number) and a hash of the k-mer there.

The fingerprint of a text is the set of its anchors' hashes; its string form is the ``SKETCH``
smallest of them, in hexadecimal, and if there are more a hash of them all. Likeness is the
Jaccard similarity of two sets, 1 for two empty ones. A text none of whose k-mers is chosen (one
of fewer than K letters, or hardly more) has one anchor, its whole. Null and empty texts have
none. Anchors that two texts have at the same places give the passages they share in place;
:func:`shared_passages` finds those at any places, for any pairs of texts.

All of it is SQL functions over arrays of hashes: a text is split once, and a letter, an inner
substring and a k-mer each cost one hash; texts of any length are taken whole. Repeated rows
are rows like others; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docintake.functions.binding import bind
from docintake.operators.skew import broadcast_if_small, previous
from docintake.session import cut

K = 5  # letters
S = 2
INSIDE = "b-ik-pr-wy"  # characters that do not end a letter
SKETCH = 32
CELL_BYTES = 8 << 20  # of texts that are put in order together
MOST_BOUNDS = 50_000
TIE_BITS = 60
_ROW_BITS = 20


def letter_hashes(text: Column) -> Column:
    letters = F.split(F.coalesce(text, F.lit("")), f"(?<=[^{INSIDE}])")
    return F.transform(F.filter(letters, lambda x: x != ""), lambda x: F.xxhash64(x))


def kmers(text: Column, k: int = K, s: int = S) -> Column:
    """Struct of the places (``pos``, from 0) and hashes of a text's anchors, in order."""
    wide = k - s  # the last inner substring is ``wide`` after the first

    def inner(v: Column) -> Column:  # hashes of s letters, from each letter on
        h = out = v["h"]
        for step in range(1, s):
            count = F.greatest(F.size(h) - step, F.lit(0))
            out = F.zip_with(
                F.slice(out, F.lit(1), count), F.slice(h, F.lit(step + 1), count),
                lambda a, b: F.xxhash64(a, b),
            )
        return out

    def closed(m: Column, i: Column) -> Column:
        found = [F.get(m, i + j) for j in range(wide + 1)]
        between = F.least(*found[1:-1]) if wide > 2 else found[1]
        return F.least(found[0], found[-1]) <= between

    def chosen(v: Column) -> Column:
        m, count = v["m"], F.size(v["m"]) - wide
        places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        return F.filter(places, lambda i: closed(m, i))

    def hashed(v: Column) -> Column:  # by inner substrings that cover the k-mer
        cover = [*range(0, wide, s), wide]
        found = F.struct(
            v["at"].alias("pos"),
            F.transform(v["at"], lambda i: F.xxhash64(*[F.get(v["m"], i + j) for j in cover])).alias("hash"),
        )
        whole = F.struct(F.array(F.lit(0)).alias("pos"), F.array(F.xxhash64(v["h"])).alias("hash"))
        return F.when((F.size(v["at"]) == 0) & (F.size(v["h"]) > 0), whole).otherwise(found)

    return bind(
        lambda v: bind(
            lambda w: bind(hashed, h=w["h"], m=w["m"], at=chosen(w)), h=v["h"], m=inner(v)
        ),
        h=letter_hashes(text),
    )


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """Anchors (pos, hash) of a text."""
    return bind(
        lambda v: F.zip_with(
            v["f"]["pos"], v["f"]["hash"], lambda p, h: F.struct(p.alias("pos"), h.alias("hash"))
        ),
        f=kmers(text, k, s),
    )


def hash_set(found: Column) -> Column:
    """Sorted set of the hashes of anchors."""
    return F.sort_array(F.array_distinct(found["hash"]))


def sketch(hashes: Column, size: int = SKETCH) -> Column:
    """String form of a sorted set of anchors' hashes; of a larger one, also a digest of all."""
    shown = F.transform(
        F.slice(hashes, F.lit(1), F.lit(size)), lambda h: F.lpad(F.hex(h), 16, "0")
    )
    digest = F.when(F.size(hashes) > size, F.lpad(F.hex(F.xxhash64(hashes)), 16, "0")).otherwise("")
    return F.lower(F.concat(F.array_join(shown, ""), digest))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of hashes."""
    both = F.size(F.array_intersect(a, b))
    return bind(
        lambda v: F.when(v["all"] == 0, F.lit(1.0)).otherwise(v["both"] / v["all"]),
        both=both,
        all=F.size(a) + F.size(b) - both,
    )


def passages_in_place(a: Column, b: Column, k: int = K) -> Column:
    """Passages (start, end), in letters, that two texts' k-mers show at the same places."""

    def placed(found: Column) -> Column:  # place and hash as one number
        low = F.lit((1 << 32) - 1).cast("bigint")
        return F.zip_with(
            found["pos"], found["hash"],
            lambda p, h: F.shiftleft(p.cast("bigint"), 32).bitwiseOR(h.bitwiseAND(low)),
        )

    def runs(v: Column) -> Column:
        at = v["at"]
        starts = F.filter(at, lambda p, i: (i == 0) | (p - F.get(at, i - 1) > k))
        ends = F.filter(at, lambda p, i: (i == F.size(at) - 1) | (F.get(at, i + 1) - p > k))
        return F.zip_with(
            starts, ends, lambda x, y: F.struct(x.alias("start"), (y + k).alias("end"))
        )

    same = F.array_intersect(placed(a), placed(b))
    return bind(runs, at=F.transform(same, lambda x: F.shiftright(x, 32).cast("int")))


def shared_passages(anchored: DataFrame, pairs: DataFrame, k: int = K) -> DataFrame:
    """Passages that the texts of each pair share, at whatever places.

    ``anchored`` has ``id, anchors`` (one row an id), ``pairs`` has ``a, b``. Gives ``a, b, a_start,
    b_start, length`` in letters: anchors of one hash are joined for each pair, and those whose
    places differ by the same number follow one another in a passage as long as they overlap.
    A hash that is at several places of a text is matched at the first ones in turn.
    """
    each = anchored.select("id", F.inline("anchors")).withColumn(
        "nth", F.row_number().over(Window.partitionBy("id", "hash").orderBy("pos"))
    )
    wanted = pairs.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL").distinct()
    left = wanted.join(each.select(F.col("id").alias("a"), "hash", "nth", F.col("pos").alias("p")), "a")
    right = each.select(F.col("id").alias("b"), "hash", "nth", F.col("pos").alias("q"))
    met = left.join(right, ["b", "hash", "nth"]).withColumn("shift", F.col("q") - F.col("p"))
    along = Window.partitionBy("a", "b", "shift").orderBy("p")
    first = (F.col("p") - F.lag("p").over(along) > k) | F.lag("p").over(along).isNull()
    number = F.sum(F.col("first").cast("int")).over(along)
    return (
        met.withColumn("first", first)
        .withColumn("passage", number)
        .groupBy("a", "b", "shift", "passage")
        .agg(F.min("p").alias("a_start"), F.min("q").alias("b_start"), (F.max("p") - F.min("p") + k).alias("length"))
        .select("a", "b", "a_start", "b_start", "length")
    )


def edited_text(text: Column, following: Column, n: Column) -> Column:
    """The last half of ``text`` (``n`` code points) replaced by the start of ``following``."""
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), n.cast("int") - half), F.substr(following, F.lit(1), half))


def _cell(key: Column, tie: Column, bounds: list[int], ends: tuple[int, int], fine: int) -> Column:
    """Number of the range that a key is in, of ``fine`` between neighbouring bounds.

    A key that fills several ranges by itself is dealt over them by ``tie``.
    """
    known = [ends[0], *bounds, ends[1]]
    table = F.split(F.lit(",".join(map(str, known))), ",").cast("array<bigint>")
    steps = [1 << b for b in reversed(range(len(bounds).bit_length()))]

    def count(fits) -> Column:  # binary search for the number of bounds that fit
        def step(low: Column, width: Column) -> Column:
            at = low + width
            good = (at <= len(bounds)) & F.coalesce(fits(F.get(table, at)), F.lit(False))
            return F.when(good, at).otherwise(low)

        return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step) if steps else F.lit(0)

    def numbered(v: Column) -> Column:
        many = v["upto"] - v["before"]
        share = F.shiftright(tie, TIE_BITS - 24).cast("double") / F.lit(float(1 << 24))
        low, high = (F.get(table, v["upto"] + i).cast("double") for i in (0, 1))
        inside = F.when(high > low, (key.cast("double") - low) / (high - low)).otherwise(0.0)
        inside = F.least(F.greatest(inside, F.lit(0.0)), F.lit(1 - 1e-9))
        place = F.when(many > 1, v["before"] + 1 + share * (many - 1)).otherwise(v["upto"] + inside)
        return F.floor(place * fine)

    return bind(numbered, before=count(lambda b: b < key), upto=count(lambda b: b <= key))


def in_order(
    rows: DataFrame, cell_bytes: int = CELL_BYTES, most_bounds: int = MOST_BOUNDS
) -> DataFrame:
    """``doc_id, text`` in cells, so that each row's successor by doc_id is beside it.

    Ids are cut into ranges of about ``cell_bytes`` of text, at up to ``most_bounds`` quantiles and
    evenly between them; a null or repeated id that fills several ranges is dealt over them by its
    texts' hashes, equal texts by their row numbers.
    Rows with the same id follow one another by these, null ids come first. The first row of the
    next cell (after the last: the first of all) closes each cell, with ``end`` set; it is looked
    up among first rows of cells in pieces.
    """
    number = F.xxhash64(F.monotonically_increasing_id())
    keyed = rows.select(
        "doc_id", "text",
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("key"),
        F.shiftrightunsigned(F.xxhash64("text"), 64 - TIE_BITS + _ROW_BITS).alias("mark"),
        F.shiftrightunsigned(number, 64 - _ROW_BITS).alias("row"),
    ).withColumn("tie", F.shiftleft("mark", _ROW_BITS).bitwiseOR(F.col("row"))).drop("mark", "row")
    size, low, high = keyed.agg(
        F.sum(F.octet_length("text") + 16), F.min("key"), F.max("key")
    ).first()
    cells = int((size or 0) // cell_bytes)
    coarse, bounds = min(cells, most_bounds), []
    if coarse:
        shares = [i / (coarse + 1) for i in range(1, coarse + 1)]
        accuracy = max(10_000, 20 * coarse)
        bounds = sorted(keyed.agg(F.percentile_approx("key", shares, accuracy).alias("b")).first()["b"])
    fine = -(-cells // coarse) if coarse else 1
    # hashes of texts come first in ``tie``, so dealing by it keeps the order
    keyed = keyed.withColumn(
        "cell", _cell(F.col("key"), F.col("tie"), bounds, (low or 0, high or 0), fine)
    )
    firsts = cut(keyed.groupBy("cell").agg(F.min(F.struct("key", "tie")).alias("first")))
    least = firsts.agg(F.min("first").alias("f")).first()["f"]
    if least is None:
        return keyed.withColumn("end", F.lit(False))
    wrapped = F.struct(F.lit(least["key"]).alias("key"), F.lit(least["tie"]).alias("tie"))
    following = previous(
        firsts.select("cell", "first", F.lit(0).alias("all"), (-F.col("cell")).alias("order")),
        "all", "order", "first", "following", 4096,
    ).select("cell", F.coalesce("following", wrapped).alias("following"))
    # rows that differ in their numbers alone have the same text, so any of them closes a cell
    mark = F.shiftright("tie", _ROW_BITS)
    wanted = following.select(
        F.col("cell").alias("before"), "following.key", F.shiftright("following.tie", _ROW_BITS).alias("mark")
    )
    closing = (
        keyed.select("key", mark.alias("mark"), "tie", "text")
        .join(broadcast_if_small(cut(wanted)), ["key", "mark"])
        .groupBy("before", "key", "mark")
        .agg(F.first("text").alias("text"), F.min("tie").alias("tie"))
        .select(F.lit(None).cast("bigint").alias("doc_id"), "text", "key", "tie",
                F.col("before").alias("cell"), F.lit(True).alias("end"))
    )
    dealt = keyed.withColumn("doc_id", F.col("doc_id").cast("bigint")).withColumn("end", F.lit(False))
    return dealt.unionByName(closing)


def fingerprint_pairs(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    cell_bytes: int = CELL_BYTES,
    most_bounds: int = MOST_BOUNDS,
) -> DataFrame:
    """Every row's text and edited text with their anchors and fingerprints, and the next row's.

    ``doc_id, text, edited``, the chosen k-mers ``own_kmers, edited_kmers`` and the sorted hash sets
    ``own, edited_own, next_own``.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    order = ["end", "key", "tie"]
    beside = Window.partitionBy("cell").orderBy(*order)
    # k-mers are made after the sort, so that only texts are moved and sorted
    sorted_rows = in_order(rows, cell_bytes, most_bounds).repartition("cell")
    near = (
        sorted_rows.sortWithinPartitions("cell", *order)
        .withColumn("own_kmers", kmers(F.col("text")))
        .withColumn("own", hash_set(F.col("own_kmers")))
        .withColumn("following", F.lead("text").over(beside))
        .withColumn("next_own", F.lead("own").over(beside))
        .where("NOT end")
    )
    edited = near.select(
        "doc_id", "text", "own_kmers", "own", "next_own",
        edited_text(F.col("text"), F.col("following"), F.length("text")).alias("edited"),
    )
    return edited.withColumn("edited_kmers", kmers(F.col("edited"))).withColumn(
        "edited_own", hash_set(F.col("edited_kmers"))
    )
