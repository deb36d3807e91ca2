"""Importance resampling towards a target distribution, over hashed word n-grams.

Texts are cut at newlines into lines. Each distinct line's features are counted once, on a
table of distinct lines with their occurrences, and staged as bucket lists; n-grams that
cross a newline belong to no line and are counted apart, from the documents. Corpus counts
are the lines' counts times their occurrences plus the crossing ones; a document's gain is
the sum of its lines' gains plus that of its crossing n-grams. A bucket's gain compares its
share of the target's features with its share of the corpus's; a document's weight is its
mean gain, and documents are drawn without replacement by weight plus Gumbel noise.

Distribution: distinct lines are found by a partial aggregate; a document's lines refer to
them by a 128-bit digest. Lines that make more than a ten-thousandth of all occurrences (so
at most 10,000 lines) are joined by broadcast, the others by a shuffle in which no key holds
more than that share. The gains are one vector of ``buckets`` numbers. Ranks come from a
range sort whose last key differs for equal rows.

Defined results: a null text is empty, and an empty text or one without words has no
features and weight 0. Rows given twice are documents of their own, with equal scores, and
take ranks next to each other. A null doc_id draws its noise from the seed alone and sorts
after the others. Texts are read whole, however long; only the buckets of a batch are held.
Empty tables give empty results; an empty target gives gains from the smoothing alone.
Columns other than those named are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcat.llm.support import stage, text_pieces

BUCKETS = 10_000
#: A line with more than this part of all occurrences is joined by broadcast.
HOT_PART = 10_000
#: Words longer than this are hashed one by one.
LONG_WORD = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def _crc_table() -> np.ndarray:
    """The byte table of CRC-32 (reflected polynomial 0xEDB88320)."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows (null: none) with A-Z lower-cased, each row followed by a
    newline, and the place after each row's newline."""
    values = [b"" if v is None else v.encode() for v in text.to_pylist()]
    data = np.frombuffer(b"\n".join(values) + b"\n", np.uint8) if values else np.zeros(0, np.uint8)
    return _LOWER[data], np.cumsum([len(v) + 1 for v in values], dtype=np.int64)


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word."""
    inside = np.concatenate([[False], _IN_WORD[data], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


def feed(crc: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC registers after the bytes ``start`` to ``end``, all rows a byte at a time."""
    table, out, size = _crc_table(), crc.copy(), end - start
    live = np.flatnonzero((size > 0) & (size <= LONG_WORD))
    k = 0
    while len(live):
        now = out[live]
        out[live] = table[(now ^ data[start[live] + k]) & np.uint32(255)] ^ (now >> np.uint32(8))
        k += 1
        live = live[size[live] > k]
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = zlib.crc32(data[start[i]:end[i]].tobytes(), int(out[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return out


def gram_buckets(data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, n: int, buckets: int) -> np.ndarray:
    """Buckets of the runs of ``n`` words, joined by one space, that begin at words ``first``."""
    crc = np.full(len(first), 0xFFFFFFFF, np.uint32)
    blank = np.array([32], np.uint8)
    for k in range(n):
        if k:
            crc = feed(crc, blank, np.zeros(len(first), np.int64), np.ones(len(first), np.int64))
        crc = feed(crc, data, start[first + k], end[first + k])
    return ((crc ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets)).astype(np.int32)


def _lists(row: np.ndarray, value: np.ndarray, rows: int) -> pa.Array:
    """``value`` as one list for each of ``rows``; ``row`` says whose each value is."""
    order = np.argsort(row, kind="stable")
    off = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(value[order], pa.int32()))


def line_features(text: pa.Array, n: int, buckets: int) -> tuple[np.ndarray, pa.Array]:
    """Words of each line, and the buckets of its runs of 1 to ``n`` words."""
    data, ends = text_bytes(text)
    start, end = words_of(data)
    row = np.searchsorted(ends, start, side="right")
    rows, values = [], []
    for k in range(1, n + 1):
        first = np.flatnonzero(row[:len(row) - k + 1] == row[k - 1:]) if len(row) >= k else np.zeros(0, np.int64)
        rows.append(row[first])
        values.append(gram_buckets(data, start, end, first, k, buckets))
    return np.bincount(row, minlength=len(text)), _lists(np.concatenate(rows), np.concatenate(values), len(text))


def crossing_features(text: pa.Array, n: int, buckets: int) -> pa.Array:
    """Buckets of the runs of 2 to ``n`` words of each text that hold a newline between words."""
    data, ends = text_bytes(text)
    start, end = words_of(data)
    row = np.searchsorted(ends, start, side="right")
    line = np.concatenate([[0], np.cumsum(data == 10)])[start]
    rows, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    for k in range(2, n + 1):
        if len(row) >= k:
            first = np.flatnonzero((row[:len(row) - k + 1] == row[k - 1:]) & (line[:len(row) - k + 1] != line[k - 1:]))
            rows.append(row[first])
            values.append(gram_buckets(data, start, end, first, k, buckets))
    return _lists(np.concatenate(rows), np.concatenate(values), len(text))


class Features:
    """The staged features of a table of texts.

    ``refs``: (row, doc_id, digest), a row for each line with a word, and one with a null
    digest for each text; ``lines``: (digest, times, n_words, buckets) of the distinct lines;
    ``crossing``: (row, buckets), None where runs have one word only.
    """

    def __init__(self, docs: DataFrame, n: int, buckets: int):
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        parts = F.split(text, "\n", -1)
        worded = F.col("line").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
        self.n, self.buckets = n, buckets
        rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text.alias("text"))
        if n > 1:
            rows = stage(rows, "texts")
        self.refs = stage(rows.select("row", "doc_id", F.explode(F.concat(F.array(F.lit(None).cast("string")), parts)).alias("line"))
                          .where(F.col("line").isNull() | worded)
                          .select("row", "doc_id", F.unhex(F.md5("line")).alias("digest")), "line-refs")
        distinct = docs.select(F.explode(parts).alias("line")).where(worded).groupBy("line").agg(F.count("*").alias("times"))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in text_pieces(batch, "line"):
                    words, lists = line_features(piece.column("line"), n, buckets)
                    yield pa.RecordBatch.from_arrays([piece.column("digest"), piece.column("times"), pa.array(words, pa.int64()), lists],
                                                     ["digest", "times", "n_words", "buckets"])

        self.lines = stage(distinct.select(F.unhex(F.md5("line")).alias("digest"), "times", "line").mapInArrow(
            count, "digest binary, times long, n_words long, buckets array<int>"), "line-features")

        def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in text_pieces(batch):
                    yield pa.RecordBatch.from_arrays([piece.column("row"), crossing_features(piece.column("text"), n, buckets)], ["row", "buckets"])

        self.crossing = stage(rows.select("row", "text").mapInArrow(cross, "row long, buckets array<int>"), "crossing") if n > 1 else None

    def totals(self) -> np.ndarray:
        """Features of the whole table in each bucket."""
        buckets = self.buckets

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(buckets, np.int64)
            for batch in batches:
                times = np.repeat(batch.column("times").to_numpy(), np.diff(batch.column("buckets").offsets.to_numpy()))
                np.add.at(total, batch.column("buckets").flatten().to_numpy(), times)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

        parts = self.lines.select("times", "buckets")
        if self.crossing is not None:
            parts = parts.unionAll(self.crossing.select(F.lit(1).cast("long").alias("times"), "buckets"))
        out = np.zeros(buckets, np.int64)
        for bucket, n in parts.mapInArrow(add, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
            out[bucket] = n
        return out

    def documents(self, gains: np.ndarray) -> DataFrame:
        """(row, doc_id, n_words, n_features, gain) of every text."""
        vector = self.lines.sparkSession.sparkContext.broadcast(gains)

        def gained(name: str, kept: list[str]):
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    off = batch.column("buckets").offsets.to_numpy()
                    sums = np.concatenate([[0], np.cumsum(vector.value[batch.column("buckets").flatten().to_numpy()])])
                    off = off - off[0] if len(off) else off
                    yield pa.RecordBatch.from_arrays(
                        [*[batch.column(c) for c in kept], pa.array(np.diff(off).astype(np.int64)), pa.array(np.diff(sums[off]).astype(np.int64))],
                        [*kept, "n_features", "gain"])
            return run

        lines = stage(self.lines.mapInArrow(gained("lines", ["digest", "times", "n_words"]),
                                            "digest binary, times long, n_words long, n_features long, gain long"), "line-gains")
        total = lines.agg(F.sum("times")).first()[0] or 0
        hot = F.col("times") * HOT_PART > F.lit(total)
        refs, sums = self.refs.where("digest is not null"), ["n_words", "n_features", "gain"]
        found = lines.where(hot).select("digest", *sums)
        parts = [refs.join(F.broadcast(found), "digest"), refs.join(F.broadcast(found.select("digest")), "digest", "left_anti").join(
            lines.where(~hot).select("digest", *sums).hint("shuffle_hash"), "digest")]
        none = F.lit(0).cast("long")
        out = self.refs.where("digest is null").select("row", "doc_id", *[none.alias(c) for c in sums])
        for part in parts:
            out = out.unionAll(part.select("row", "doc_id", *sums))
        if self.crossing is not None:
            more = self.crossing.mapInArrow(gained("crossing", ["row"]), "row long, n_features long, gain long")
            out = out.unionAll(more.select("row", F.lit(None).cast(out.schema["doc_id"].dataType).alias("doc_id"), none.alias("n_words"),
                                           "n_features", "gain"))
        return out.groupBy("row").agg(F.max("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in sums])


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln(share in target / share in corpus))`` of every bucket, smoothed by one."""
    s_all, t_all, n = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n))))
                     for s, t in zip(corpus.astype(float).tolist(), target.astype(float).tolist())], np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """A fixed Gumbel draw in thousandths, from the seed and the doc_id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = BUCKETS, percent: int = 10,
             least_words: int = 20, seed: int = 2024) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs`` (doc_id, text): the
    ``percent`` of the documents of ``least_words`` and more with the highest scores are drawn
    and ranked; ``target`` has a column ``text``."""
    mine = Features(docs.select("doc_id", "text"), n, buckets)
    theirs = Features(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), n, buckets)
    gains = bucket_gains(mine.totals(), theirs.totals())
    weight = F.when(F.col("n_features") > 0, F.expr("(gain - pmod(gain, n_features)) div n_features")).otherwise(F.lit(0)).cast("long")
    rows = stage(mine.documents(gains).withColumn("weight", weight).withColumn("score", (F.col("weight") + noise(F.col("doc_id"), seed)).cast("long")),
                 "scores")
    able = rows.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    # the least score that can be drawn, from the counts of the scores: whole numbers between
    # the logarithms of the bucket shares and of 32-bit noise, so some 100,000 at any size
    cut, above = None, 0
    for score, count in sorted(able.groupBy("score").count().collect(), reverse=True):
        if above >= drawn:
            break
        cut, above = score, above + count
    best = stage(able.where(F.col("score") >= cut if cut is not None else F.lit(False))
                 .orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), F.xxhash64("row"), "row")
                 .select("row", F.monotonically_increasing_id().alias("id_")), "drawn")
    best = best.select("row", F.shiftright("id_", 33).alias("range_"), F.col("id_").bitwiseAND((1 << 33) - 1).alias("at_"))
    before, sofar = {}, 0
    for part, count in sorted(best.groupBy("range_").count().collect()):
        before[part] = sofar
        sofar += count
    if before:
        offset = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("range_"))
        best = best.select("row", (offset + F.col("at_") + 1).cast("long").alias("rank")).where(F.col("rank") <= drawn)
    else:
        best = best.select("row", F.lit(None).cast("long").alias("rank"))
    return rows.join(best, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")
