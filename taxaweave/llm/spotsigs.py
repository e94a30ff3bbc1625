"""Document fingerprints after SpotSigs, in DataFrame expressions only.

A spot is a common word (anchor); its signature is the anchor with the chain of
the next ``CHAIN`` content words. A content word before any anchor, or over
``FAR`` words behind the last one, is a signature itself. A text without words
but with other characters has the hash of the whole as its only signature, an
empty text none. The fingerprint is the
sorted set of 32-bit signature hashes; equal texts have equal fingerprints.

Two fingerprints are compared by Jaccard likeness (1 where both are empty). A
least likeness prunes by set length alone: sets whose lengths differ by more
than it allows are not intersected and count as 0.

Nulls: a null text is an empty one. Rows of a null doc_id sort first. Every row
is returned: those that repeat a doc_id are in the order of their text hashes,
equal ones (of one doc_id and text) have the same next document, the first one
unlike them. An empty table gives no rows; the next document of a single one
is itself. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaweave.llm.common import query, table, written

CHAIN = 2
#: A content word over so many words behind the last anchor is a signature itself.
FAR = 8

# Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from had has have he her his in is it its not of on or she that the their they this to was were which with you "
    "als am auf aus bei das dem den der des die durch ein eine einen einer er es für hat ich im ist mit nach nicht oder sich sie sind um und von vor war wie zu zum zur "
    "au aux avec ce cette dans de des du elle en est et il ils je la le les leur mais ne nous ou par pas pour qui que sa se ses son sont sur un une vous "
    "al como con del el ella esta este hay las lo los más no para pero por sin su sus también una y"
).split()

NO_ID = -(1 << 63)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def fingerprint(text: Column, chain: int = CHAIN) -> Column:
    """Sorted distinct signature hashes (array<int>) of a text column."""
    anchors = sorted(set(ANCHORS))

    def spots(words: Column) -> Column:
        places = lambda here: F.filter(F.transform(words, lambda w, i: F.when(here(w), i).otherwise(-1)), lambda i: i >= 0)
        content = F.filter(words, lambda w: ~w.isin(anchors))

        def signatures(content: Column, anchor_at: Column) -> Column:
            # the j-th anchor at word i has i - j content words before it, the
            # j-th content word at word i has i - j anchors before it
            chains = F.transform(anchor_at, lambda i, j: F.hash(F.get(words, i), *[F.get(content, i - j + k) for k in range(chain)]))
            far = lambda i, j: (i == j) | (i - F.get(anchor_at, i - j - 1) > FAR)
            lone = F.transform(places(lambda w: ~w.isin(anchors)), lambda i, j: F.when(far(i, j), F.hash(F.lit(""), F.get(words, i))))
            return F.concat(chains, F.array_compact(lone))

        return let(content, lambda c: let(places(lambda w: w.isin(anchors)), lambda a: signatures(c, a)))

    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    none = F.when(F.length(text) > 0, F.array(F.hash(text))).otherwise(F.array().cast("array<int>"))
    return let(words, lambda w: F.when(F.size(w) > 0, F.sort_array(F.array_distinct(spots(w)))).otherwise(none))


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard likeness of two fingerprints, 0 where their lengths rule out ``least``."""
    short, long = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    exact = let(F.size(F.array_intersect(a, b)), lambda n: n / (F.size(a) + F.size(b) - n))
    return F.when(long == 0, 1.0).when(short < least * long, 0.0).otherwise(exact).cast("double")


def written_out(print_: Column) -> Column:
    """A fingerprint as a string: its hashes in hex, parted by spaces."""
    return F.array_join(F.transform(print_, lambda h: F.lower(F.hex(h.cast("long").bitwiseAND(0xFFFFFFFF)))), " ")


def with_neighbours(docs: DataFrame) -> DataFrame:
    """(key, n, after, before, before_n) of every key in ascending order, the
    last followed by the first. Range partitions are numbered, neighbours found
    within each, and the ends joined through one row per partition."""
    spread = docs.select("key", F.length("text").cast("long").alias("n")).repartitionByRange("key").sortWithinPartitions("key")
    ordered = written(spread.withColumn("part", F.spark_partition_id()), "ordered")
    ends = ordered.groupBy("part").agg(F.min("key").alias("first"), F.max(F.struct("key", "n")).alias("last"))
    by = Window.orderBy("part")  # one row per partition
    whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "part",
        F.coalesce(F.lead("first").over(by), F.first("first").over(whole)).alias("after_part"),
        F.coalesce(F.lag("last").over(by), F.last("last").over(whole)).alias("before_part"),
    )
    own = Window.partitionBy("part").orderBy("key")
    near = ordered.select("part", "key", "n", F.lead("key").over(own).alias("a"), F.lag(F.struct("key", "n")).over(own).alias("b"))
    joined = near.join(F.broadcast(ends), "part")  # bounded by the number of partitions
    before = F.coalesce("b", "before_part")
    return joined.select("key", "n", F.coalesce("a", "after_part").alias("after"), before["key"].alias("before"), before["n"].alias("before_n"))


def keyed(docs: DataFrame) -> DataFrame:
    """(key, text), both without nulls. The key is the doc_id, or where rows
    repeat one (has an id, doc_id, text hash), which equal rows share. It alone
    tells the doc_id, so that all who read the texts by key share one exchange."""
    doc = F.col("doc_id").cast("long")
    rows = docs.select(F.coalesce(doc, F.lit(NO_ID)).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    least = docs.where(doc == NO_ID).limit(1)  # a real id that stands for no id
    twice = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").limit(1)
    if not twice.select("key").union(least.select(doc.alias("key"))).limit(1).count():
        return rows
    named = docs.select(doc.isNotNull().alias("named"), F.coalesce(doc, F.lit(NO_ID)).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return named.select(F.struct("named", "id", F.xxhash64("text").alias("hash")).alias("key"), "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited (the text whose last quarter is the start of the
    next document), print, edited_print, next_print."""
    rows = keyed(docs)
    repeated = isinstance(rows.schema["key"].dataType, T.StructType)
    places = rows.dropDuplicates(["key"]) if repeated else rows
    around = written(with_neighbours(places), "neighbours")
    own = rows.join(around, "key")
    start = F.substring("text", F.lit(1), F.floor(F.col("before_n") / 4).cast("int"))
    if repeated:  # one of equal rows, written so that a key of many is a skewed join that Spark can split
        first = own.select("before", start.alias("start"), "text").dropDuplicates(["before"])
        given = written(first.select(F.col("before").alias("key"), "start", fingerprint(F.col("text")).alias("next_print")), "given")
    else:
        given = own.select(F.col("before").alias("key"), start.alias("start"), fingerprint(F.col("text")).alias("next_print"))
    doc = F.when(F.col("key.named"), F.col("key.id")) if repeated else F.nullif("key", F.lit(NO_ID))
    keep = (F.col("n") - F.floor(F.col("n") / 4)).cast("int")
    both = own.select("key", "n", "text").join(given, "key").withColumn("edited", F.concat(F.substring("text", F.lit(1), keep), "start"))
    return both.select(doc.alias("doc_id"), F.col("n").alias("n_chars"), "edited", fingerprint(F.col("text")).alias("print"), fingerprint(F.col("edited")).alias("edited_print"), "next_print")


def op7_columns(f: DataFrame) -> DataFrame:
    return f.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        written_out(F.col("print")).alias("fingerprint"),
        written_out(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )


@query("op7_spotsigs_fingerprints")
def op7_spotsigs_fingerprints(spark, sf_dir):
    return op7_columns(fingerprints(table(spark, sf_dir, "documents")))
