"""Document fingerprints: threshold-scaled sketches of five-word shingles, in DataFrame functions only.

A sketch holds every 32-bit shingle hash below a fixed fraction of the range, and at least the SMALLEST smallest ones, so
that short texts are not left without any.  Up to its limit (the threshold or its last hash, whichever is larger) a
sketch is complete; two sketches are compared up to the lower of their limits, whatever the sizes of the texts.  The
union of two sketches of disjoint parts, cut by the same rule, is the sketch of the whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import materialize, own_text

RANGE = 1 << 32
#: The fixed fraction of hashes that a sketch retains, and how many it has at least if the text has them.
FRACTION, SMALLEST = 1 / 8, 16
SHINGLE = 5
#: About the rows of an id range within which neighbours are found; a row there is an id and a hash.
RANGE_ROWS = 200_000


def _bind(value: Column, use) -> Column:
    """use(value) with value computed once, however often use names it."""
    return F.transform(F.array(value), use)[0]


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """The sorted distinct 32-bit hashes of runs of words of a text in lower case; fewer words are one run."""
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def runs(w: Column) -> Column:
        last = F.greatest(F.size(w) - (size - 1), F.lit(1))
        each = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(w, i, F.lit(size))).bitwiseAND(F.lit(RANGE - 1)))
        return F.when(F.size(w) > 0, each).otherwise(F.array().cast("array<bigint>"))

    return _bind(words, runs)


def sketch(text: Column, fraction: float = FRACTION, smallest: int = SMALLEST) -> Column:
    """The hashes below the threshold, or else the smallest ones, ascending."""
    limit = int(RANGE * fraction)

    def cut(hashes: Column) -> Column:
        below = F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h < limit)))
        return _bind(below, lambda b: F.when(F.size(b) >= smallest, b).otherwise(F.slice(F.array_sort(F.array_distinct(hashes)), 1, smallest)))

    return _bind(shingle_hashes(text), cut)


def merge(left: Column, right: Column, fraction: float = FRACTION, smallest: int = SMALLEST) -> Column:
    """The sketch of the union of two shingle sets from their sketches."""
    limit = int(RANGE * fraction)
    both = F.array_sort(F.array_union(left, right))
    return _bind(both, lambda b: F.slice(b, F.lit(1), F.greatest(F.size(F.filter(b, lambda h: h < limit)), F.lit(smallest))))


def _upto(hashes: Column, fraction: float, smallest: int) -> Column:
    return F.when(F.size(hashes) < smallest, F.lit(RANGE).cast("long")).otherwise(F.greatest(F.lit(int(RANGE * fraction)).cast("long"), F.array_max(hashes)))


def _shares(left: Column, right: Column, fraction: float, smallest: int, score) -> Column:
    limit = F.least(_upto(left, fraction, smallest), _upto(right, fraction, smallest))
    own = F.struct(F.filter(left, lambda h: h <= limit).alias("a"), F.filter(right, lambda h: h <= limit).alias("b"))
    counted = _bind(own, lambda p: F.struct(F.size(p["a"]).alias("a"), F.size(p["b"]).alias("b"), F.size(F.array_intersect(p["a"], p["b"])).alias("both")))
    return _bind(counted, score)


def likeness(left: Column, right: Column, fraction: float = FRACTION, smallest: int = SMALLEST) -> Column:
    """The estimated Jaccard similarity of two sketches, 1 if both are empty."""

    def score(n: Column) -> Column:
        union = n["a"] + n["b"] - n["both"]
        return F.when(union == 0, 1.0).otherwise(n["both"] / union).cast("double")

    return _shares(left, right, fraction, smallest, score)


def containment(left: Column, right: Column, fraction: float = FRACTION, smallest: int = SMALLEST) -> Column:
    """The estimated share of the left text's shingles that the right text has, 1 if the left has none."""
    return _shares(left, right, fraction, smallest, lambda n: F.when(n["a"] == 0, 1.0).otherwise(n["both"] / n["a"]).cast("double"))


def as_text(hashes: Column) -> Column:
    """Eight hexadecimal digits for each hash."""
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), 8, "0"))), "")


def next_names(names: DataFrame) -> DataFrame:
    """names(doc_id, own), without repeats, with next_id and next_own of the next row; the first follows the last.

    The order is by id, nulls first, then by the hash of the text.  Names are dealt to ranges, as many as their number
    needs, and sorted there; the last of a range looks at the first row of the next one.
    """
    names = materialize(names, "fingerprint-names")
    ranges = max(1, -(-names.count() // RANGE_ROWS))
    order = ["doc_id", "own"]
    placed = materialize(names.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()), "fingerprint-ranges")
    # a row for each range: ids in a few bytes, not texts
    first = F.struct((F.col("doc_id").isNotNull()).alias("has_id"), F.col("doc_id"), F.col("own"))
    heads = placed.groupBy("part").agg(F.min(first).alias("h"))
    every = Window.orderBy("part")
    around = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("part", F.coalesce(F.lead("h").over(every), F.first("h").over(around)).alias("h"))
    within = Window.partitionBy("part").orderBy(*order)
    rows = placed.select("part", *order, F.lead(first).over(within).alias("n")).join(heads, "part")
    rows = rows.withColumn("n", F.coalesce("n", "h"))
    return rows.select(*order, F.col("n.doc_id").alias("next_id"), F.col("n.own").alias("next_own"))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, sketch and, of the next document by id, the sketch and as many first code points as a quarter of text has.

    The first document follows the last.  Nulls come first, and rows with equal ids are in the order of hashes of their
    texts; of rows that repeat id and text all but one are followed by the same text.  No whole text goes to a neighbour,
    and texts move once: both joins find them dealt by id and hash.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("own", own_text(rows))
    quarter = F.floor(F.length("text") / 4).cast("int")
    names = materialize(rows.groupBy("doc_id", "own").agg(F.count("*").alias("times"), F.max(quarter).alias("quarter")), "fingerprint-times")
    known = names.join(next_names(names.select("doc_id", "own")).withColumnsRenamed({"doc_id": "_d", "own": "_o"}), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("own") == F.col("_o"))).drop("_d", "_o")
    wanted = known.select("next_id", "next_own", F.col("doc_id").alias("for_id"), F.col("own").alias("for_own"), "quarter")
    sketched = rows.withColumn("sketch", sketch(F.col("text")))
    again = names.where("times > 1")
    once = sketched
    if not again.isEmpty():  # a text that is repeated is looked at once; copies are combined in the tasks
        twin = again.select(F.col("doc_id").alias("_d"), F.col("own").alias("_o")).hint("shuffle_hash")
        same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("own") == F.col("_o"))
        some = rows.join(twin, same, "left_semi").groupBy("doc_id", "own").agg(F.first("text").alias("text"))
        once = rows.join(twin, same, "left_anti").select("doc_id", "own", "text").unionByName(some).withColumn("sketch", sketch(F.col("text"))).select(sketched.columns)
    shown = once.join(wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("next_id")) & (F.col("own") == F.col("next_own")))
    shown = shown.select("for_id", "for_own", F.substring("text", F.lit(1), F.col("quarter")).alias("next_start"), F.col("sketch").alias("next_sketch"))
    both = once.join(shown, F.col("doc_id").eqNullSafe(F.col("for_id")) & (F.col("own") == F.col("for_own")))
    both = both.select("doc_id", "own", "text", "sketch", "next_start", "next_sketch")
    if again.isEmpty():
        return both.drop("own")
    repeated = both.join(again.select(F.col("doc_id").alias("_d"), F.col("own").alias("_o"), "times"), same).select(
        "doc_id", "text", "sketch", F.substring("text", F.lit(1), quarter).alias("next_start"), F.col("sketch").alias("next_sketch"), F.explode(F.sequence(F.lit(2), F.col("times").cast("int"))).alias("_n"))
    return both.drop("own").unionByName(repeated.drop("_n"))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last quarter of code points replaced by as many first ones of the next document.
    A null text counts as empty; it has an empty fingerprint, which is like another empty one (1) and unlike all others
    (0).  A single document is its own next.  Further columns are not read.
    """
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), F.length("text") - quarter), F.col("next_start"))
    rows = with_next(docs).withColumn("edited", edited)
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "sketch", "next_sketch", sketch(F.col("edited")).alias("edited_sketch"))
    both = F.struct(F.col("sketch").alias("own"), F.col("edited_sketch").alias("edited"), F.col("next_sketch").alias("next"))
    out = lambda p: F.struct(
        as_text(p["own"]).alias("fingerprint"), as_text(p["edited"]).alias("edited_fingerprint"),
        likeness(p["own"], p["edited"]).alias("near_edited"), likeness(p["own"], p["next"]).alias("near_next"))
    return rows.select("doc_id", "n_chars", "edited_sha256", _bind(both, out).alias("o")).select("doc_id", "n_chars", "edited_sha256", "o.*")
