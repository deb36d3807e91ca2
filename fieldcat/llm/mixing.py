"""Mixing sources to target weights with exact budgets.

Every document gets a hash-random key. Within a source, documents are sorted by that key in
ranges (equal slices of the key space, as many as the source's rows ask for, so a hot source
is spread over many tasks); the ranges' word totals give each range its offset, so running
sums inside the ranges are prefix sums of the whole source. A source's budget is cut at its
exact word: whole epochs first, then documents in key order until the budget ends inside a
document, of which the first words are taken.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating, and share
``share`` of all words by weight; a target stops at ``most`` times its source's words and the
excess goes to the others by weight until none is above.

Defined results: a null or empty text has size 0 and gets no words. A null source is a source
of its own, a null doc_id sorts by its hash like any other. Rows given twice are documents of
their own; equal rows are interchangeable, so reruns agree. Empty tables give empty results.
Columns other than those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldcat.llm.support import small_side, stage

#: Documents that one range of a source should hold.
RANGE_ROWS = 4096
WEIGHTS = (5, 2, 1)


def size_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, 0 for null."""
    bare = F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``, the 0-based place of each source in code point order, null
    last: sorted in ranges, numbered inside each, offset by the ranges before."""
    rows = stage(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("id_", F.monotonically_increasing_id()), "sources")
    rows = rows.withColumns({"range_": F.shiftright("id_", 33), "at_": F.col("id_").bitwiseAND((1 << 33) - 1)})
    before = rows.groupBy("range_").agg(F.count("*").alias("n_")).withColumn(
        "before_", F.sum("n_").over(Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)))
    return rows.join(before, "range_").select(*sources.columns, (F.coalesce("before_", F.lit(0)) + F.col("at_")).alias("place"))


def targets(sources: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, rows, place, target) of (source, source_size, rows): each round is
    one sum over the sources that fixes those above ``most`` times their words."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    rows = stage(ranked(sources).withColumn("weight", weight), "weights")
    limit = most * F.col("source_size")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    rate = None
    while total:
        full = F.lit(False) if rate is None else F.col("weight") * F.lit(rate) >= limit
        done, left = rows.agg(F.sum(F.when(full, limit).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        now = (share * total - done) / left if left else rate
        if now == rate:
            break
        rate = now
    target = F.least(F.col("weight") * F.lit(float(rate or 0.0)), limit)
    return rows.select("source", "source_size", "rows", "place", target.alias("target"))


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(doc_id, size, source, key, source_size, target, taken) of every row of ``docs``
    (doc_id, text, source). ``key`` tells apart documents that share a doc_id."""
    text = F.col("text").cast("string")
    rows = stage(docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string").alias("source"), size_of(text).alias("size"),
        F.xxhash64(F.lit("mix"), F.col("doc_id").cast("long"), text).alias("key")), "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    planned = stage(targets(sources, share, most), "targets")
    rows = rows.withColumnRenamed("source", "source_").join(
        small_side(planned), F.col("source_").eqNullSafe(F.col("source"))).drop("source_")
    # the key's upper 32 bits, cut into equal slices: the range it is sorted in
    rows = rows.withColumn("range", F.expr("cast(shiftrightunsigned(key, 32) * (rows div %d + 1) div 4294967296 as bigint)" % RANGE_ROWS))
    sums = rows.groupBy("place", "range").agg(F.sum("size").alias("words"))
    before = sums.withColumn("before", F.coalesce(F.sum("words").over(
        Window.partitionBy("place").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("words")
    inside = Window.partitionBy("place", "range").orderBy(F.expr("shiftrightunsigned(key, 32)"), "key", "doc_id", "size")
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("upto", upto).join(before, ["place", "range"])
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size")
    start = F.col("before") + F.col("upto") - F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - start))
    return rows.select("doc_id", "size", "source", "key", "source_size", "target", (epochs * F.col("size") + part).cast("long").alias("taken"))


def materialise(docs: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mixed corpus: a row of ``docs`` for each time the mix takes it; the document in
    which a source's budget ends comes with its first words only."""
    text = F.col("text").cast("string")
    plan = mix(docs, share, most).groupBy(F.col("doc_id").alias("id_"), F.col("key").alias("key_"), F.col("size").alias("size_")).agg(
        F.sort_array(F.collect_list("taken")).alias("takes_")).where("array_max(takes_) > 0")
    rows = docs.select("*", F.col("doc_id").cast("long").alias("row_"), F.xxhash64(F.lit("mix"), F.col("doc_id").cast("long"), text).alias("hash_"))
    rows = rows.join(plan, F.col("row_").eqNullSafe(F.col("id_")) & (F.col("hash_") == F.col("key_")))
    # equal rows take what their equals don't
    rows = rows.withColumn("taken_", F.expr("element_at(takes_, row_number() over (partition by row_, hash_ order by size_))"))
    rows = rows.where("taken_ > 0").withColumn("copy_", F.explode(F.expr("sequence(0, cast((taken_ - 1) div size_ as int))")))
    left = (F.col("taken_") - F.col("copy_") * F.col("size_")).cast("int")
    first = F.array_join(F.slice(F.split(F.btrim(text, F.lit(" \t\n\x0b\x0c\r")), r"[\x20\x09-\x0D]+"), 1, left), " ")
    return rows.withColumn("text", F.when(left >= F.col("size_"), text).otherwise(first)).select(*docs.columns)
