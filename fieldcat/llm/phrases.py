"""Phrase collocations per language, counted by double-array tries.

Texts (A-Z lower-cased) are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words
``[^\\x20\\x09]+``. Candidates are found level by level and never lose a frequent phrase
(Apriori): a pair counts only where both words are frequent, a triple only where both its
pairs may be. "May be" is a bitmap of hashes whose summed counts reach the limit; a hash's
count is never below a phrase's, so hashes pass too much at worst. The candidates' texts come
from joins of the hashes with the words; they are dealt to shards by their first two words and
built there into a double-array trie of bytes. One pass over the texts, however many the shards,
sends each shard the windows of text that begin with its pairs: from each word on, as many words
as may be a phrase. Numpy advances the states of all windows of a batch at once, a byte a level,
and bincounts the accepting states. These sums alone are the counts of phrases.

Bounds: a bitmap has at most 2**30 bits. Shards grow with the candidates (about ``SHARD_PHRASES``
phrases and ``SHARD_BYTES`` bytes of text each, more only where one pair of words begins more)
and with the words; a shard's trie is made in the task that reads its windows, so the driver
holds none. Runs are counted by buckets of their hashes, a row for each bucket and piece of text.
Windows and runs that are alike count once in a piece, so a language or phrase with a third of all
words is a few rows a task. The first ``top`` of a language are cut in ``PARTS`` parts before
they meet.

Defined results: a null text is empty; a null lang is ``und``. Rows given twice count twice,
ties are ordered by the phrase's bytes, phrases are found in whole texts however long, and
empty tables give empty results. Columns other than lang and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldcat.llm.shingles import mix
from fieldcat.llm.support import small_batches, stage, text_pieces

SHARD_PHRASES = 100_000
SHARD_BYTES = 6_400_000
BITMAP_BITS = 1 << 30
#: Words for which there is one more bucket of hashes or shard, and the least number of these.
BUCKET_WORDS, BUCKETS = 1 << 20, 64
#: Bytes of an Arrow batch, and of windows walked at once.
BATCH_BYTES, WALK_BYTES = 16_000_000, 2_000_000
#: Parts of a language whose first ``top`` are cut before the language's own.
PARTS = 64

#: Bytes by class: 0 word, 1 blank, 2 end of a piece; upper case folded.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK, _END = 0x20, 0x0A
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: The first 0 to 8 bytes of a number.
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class Words:
    """The words of a batch as one run of bytes, each followed by a blank or, at the end of
    its piece, by a newline (neither occurs in a word)."""

    def __init__(self, text: pa.Array, lang: pa.Array):
        text = pc.fill_null(text, "")
        ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        whole = pc.binary_join(pa.ListArray.from_arrays([0, len(text)], text), "\n")[0]
        data = _LOWER[np.concatenate([np.frombuffer(whole.as_buffer(), np.uint8), np.array([_END], np.uint8)])]
        kind = _CLASS[data]
        word = kind == 0
        edge = np.flatnonzero(np.diff(word, prepend=False))
        start, end = edge[::2], edge[1::2]
        # a word is the last of its piece if an end of pieces lies before the next word
        stops = np.append(np.flatnonzero(kind == 2), len(data))
        last = np.append(stops[np.searchsorted(stops, end[:-1])] < start[1:], True) if len(start) else np.zeros(0, bool)
        word[end] = True
        data[end] = np.where(last, _END, _BLANK)
        self.data = data[word]
        size = end - start + 1
        self.end = np.cumsum(size) - 1
        self.start = self.end - size + 1
        self.last = last
        coded = lang.dictionary_encode()
        self.langs = [v.encode() for v in coded.dictionary.to_pylist()]
        self.lang = coded.indices.to_numpy(zero_copy_only=False)[np.searchsorted(ends, start, side="right")]

    @cached_property
    def _blocks(self) -> np.ndarray:
        """The eight bytes from each byte on, as a number (little end first)."""
        data = np.concatenate([self.data, np.zeros(8, np.uint8)])
        return np.ndarray((len(self.data) + 1,), "<u8", data, strides=(1,))

    def eight(self, at: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Up to eight bytes from ``at`` on, of ``left`` (one or more)."""
        return self._blocks[at] & _MASK[np.minimum(left, 8)]

    def differ(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the ``n`` bytes from ``a`` and those from ``b`` differ."""
        out, live = np.zeros(len(a), bool), np.arange(len(a))
        while len(live):
            unlike = self.eight(a, n) != self.eight(b, n)
            out[live[unlike]] = True
            more = np.flatnonzero(~unlike & (n > 8))
            live, a, b, n = live[more], a[more] + 8, b[more] + 8, n[more] - 8
        return out

    @cached_property
    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word and its language."""
        seeds = [mix(np.array([int.from_bytes(hashlib.blake2b(v, digest_size=8).digest(), "little")], np.uint64))[0] for v in self.langs]
        out = np.array(seeds or [0], np.uint64)[self.lang]
        size = self.end - self.start
        out ^= size.astype(np.uint64)
        at, left, live, value, k = self.start, size, np.arange(len(size)), out, 0
        while len(live) and k < 8:
            value = (value ^ self.eight(at, left)) * _BASE
            value ^= value >> np.uint64(29)
            k += 1
            out[live] = value
            more = np.flatnonzero(left > 8)
            live, at, left, value = live[more], at[more] + 8, left[more] - 8, value[more]
        for i in live.tolist():  # the rest of very long words, one by one
            rest = np.frombuffer(self.data[self.start[i] + 8 * k:self.end[i]].tobytes() + bytes(-int(size[i] - 8 * k) % 8), np.uint64)
            out[i] ^= np.bitwise_xor.reduce(mix(rest + np.arange(len(rest), dtype=np.uint64) * _BASE))
        return mix(out)

    def runs(self, n: int) -> np.ndarray:
        """First words of all runs of ``n`` words within a piece."""
        ok = np.ones(max(0, len(self.start) - n + 1), bool)
        for k in range(n - 1):
            ok &= ~self.last[k:k + len(ok)]
        return np.flatnonzero(ok)

    def texts(self, first: np.ndarray, n: int) -> pa.Array:
        """The runs of ``n`` words that begin at words ``first``."""
        start = self.start[first]
        size = self.end[first + n - 1] - start
        off = np.concatenate([[0], np.cumsum(size)])
        data = self.data[np.repeat(start - off[:-1], size) + np.arange(off[-1])]
        return pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())

    def lang_names(self, first: np.ndarray) -> pa.Array:
        return pa.array([v.decode() for v in self.langs], pa.string()).take(pa.array(self.lang[first]))


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, a place of each, and their counts."""
    order = np.argsort(h)
    value = h[order]
    new = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(h) else np.zeros(0, np.int64)
    return value[new], order[new], np.diff(np.append(new, len(h)))


def run_hashes(word: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    out = word[first]
    for k in range(1, n):
        out = mix(out * _BASE + word[first + k])
    return out


# ---------------------------------------------------------------- bitmaps

class Bitmap:
    """Hashes as bits, in blocks that Spark unites; only the blocks reach the driver."""

    def __init__(self, hashes: DataFrame):
        """``hashes``: one long column. The bits grow with the rows, up to ``BITMAP_BITS``."""
        rows = hashes.count()
        self.bits = min(BITMAP_BITS, max(1 << 15, 1 << (32 * max(rows, 1) - 1).bit_length()))
        at = F.expr(f"pmod({hashes.columns[0]}, {self.bits}) + 1").alias("at")
        blocks = hashes.select(at).groupBy(F.expr("bitmap_bucket_number(at)").alias("block")).agg(
            F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bits"))
        data = np.zeros(self.bits // 8, np.uint8)
        for block, bits in blocks.toLocalIterator():
            data[(block - 1) * 4096:block * 4096] = np.frombuffer(bits, np.uint8)
        self.shared = hashes.sparkSession.sparkContext.broadcast(data)

    def test(self):
        shared, bits = self.shared, self.bits

        def has(h: np.ndarray) -> np.ndarray:
            at = (h & np.uint64(bits - 1)).view(np.int64)  # pmod: the bits are a power of two
            return (shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return has


# ---------------------------------------------------------------- double-array trie

class DoubleArray:
    """``next = base[state] + byte`` if ``check[next] == state``; ``accept[state]`` is the
    number of the phrase that ends there, or -1. State 256 is the root."""

    def __init__(self, keys: list[bytes]):
        order = sorted(range(len(keys)), key=keys.__getitem__)
        size = np.array([len(keys[i]) for i in order], np.int64)
        data = np.frombuffer(b"".join(keys[i] for i in order) or b"\0", np.uint8)
        off = np.concatenate([[0], np.cumsum(size)])[:-1]
        parents, bytes_, node, count, last = [], [], np.zeros(len(keys), np.int64), 1, np.zeros(len(keys), np.int64)
        live, depth = np.flatnonzero(size > 0), 0
        while len(live):  # keys are sorted: equal (node, byte) are neighbours
            byte = data[off[live] + depth]
            new = np.concatenate([[True], (node[live[1:]] != node[live[:-1]]) | (byte[1:] != byte[:-1])])
            parents.append(node[live[new]])
            bytes_.append(byte[new])
            node[live] = count - 1 + np.cumsum(new)
            count += int(new.sum())
            depth += 1
            done = size[live] == depth
            last[live[done]] = node[live[done]]
            live = live[~done]
        parent = np.concatenate(parents) if parents else np.zeros(0, np.int64)
        byte = (np.concatenate(bytes_) if bytes_ else np.zeros(0, np.uint8)).astype(np.int64)
        # node i + 1 is reached by edge i; edges of one parent are neighbours
        children = np.bincount(parent, minlength=count)
        first = np.concatenate([[0], np.cumsum(children)])
        base = self._place(byte, first, children)
        slot = np.full(count, 256, np.int64)
        slot[1:] = base[parent] + byte
        top = int(max(slot.max(), base.max())) + 257
        self.base, self.check, self.accept = np.zeros(top, np.int32), np.full(top, -1, np.int32), np.full(top, -1, np.int32)
        self.base[slot] = base
        self.check[slot[1:]] = slot[parent]
        self.accept[slot[last]] = np.array(order, np.int32)

    @staticmethod
    def _place(byte: np.ndarray, first: np.ndarray, children: np.ndarray) -> np.ndarray:
        """A base for every node such that no two edges share a slot: nodes with many children
        have 256 slots of their own, the others draw places together until all are free, and
        single edges fill the gaps."""
        base = np.zeros(len(children), np.int64)  # leaves: slots below 256, which hold nothing
        wide = np.flatnonzero(children > 12)
        base[wide] = 512 + 256 * np.arange(len(wide))
        low = 512 + 256 * (len(wide) + 1)
        few = np.flatnonzero((children > 1) & (children <= 12))
        total = int(children[few].sum())
        high = low + 3 * total + 1024
        single = np.flatnonzero(children == 1)
        used = np.zeros(high + 512 + len(single), bool)
        for i in wide:
            used[base[i] + byte[first[i]:first[i + 1]]] = True
        draw = np.random.default_rng(1)
        claim = np.empty(len(used), np.int64)
        while len(few):
            at = draw.integers(low, high - 256, len(few))
            n = children[few]
            whose = np.repeat(np.arange(len(few)), n)
            edge = np.repeat(first[few] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
            place = at[whose] + byte[edge]
            claim[place] = edge
            bad = used[place] | (claim[place] != edge)
            ok = np.ones(len(few), bool)
            ok[whose[bad]] = False
            base[few[ok]] = at[ok]
            used[place[ok[whose]]] = True
            few = few[~ok]
        free = np.flatnonzero(~used[512:])[:len(single)] + 512
        base[single] = free - byte[first[single]]
        return base

    def step(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        to = self.base[state] + byte
        return to, self.check[to] == state

    def count(self, words: Words, phrases: int) -> np.ndarray:
        """Occurrences of each phrase, a key being ``lang``, a zero byte and the words joined by
        blanks, at all words of the batch."""
        state = np.array([self.root(lang) for lang in words.langs] or [-1], np.int64)[words.lang]
        return self.walk(words.data, words.start, state, np.ones(len(state), np.int64), phrases)

    def root(self, lang: bytes) -> int:
        """The state after ``lang`` and a zero byte, -1 if no phrase is of it."""
        state = np.array([256])
        for b in lang + b"\0":
            state, ok = self.step(state, np.int32(b))
            if not ok[0]:
                return -1
        return int(state[0])

    def walk(self, data: np.ndarray, at: np.ndarray, state: np.ndarray, times: np.ndarray, phrases: int) -> np.ndarray:
        """How often each phrase begins at the places ``at`` of ``data``, each of which is there
        ``times``; ``state``: the roots of their langs."""
        live = np.flatnonzero(state >= 0)
        state, at, times = state[live], at[live], times[live]
        accepted, often = [], []
        while len(state):
            byte = data[at]
            ends = np.flatnonzero((byte == _BLANK) | (byte == _END))
            found = self.accept[state[ends]]
            accepted.append(found[found >= 0])
            often.append(times[ends[found >= 0]])
            state, ok = self.step(state, byte)
            ok = np.flatnonzero(ok)
            state, at, times = state[ok], at[ok] + 1, times[ok]
        out = np.zeros(phrases, np.int64)
        if accepted:
            np.add.at(out, np.concatenate(accepted), np.concatenate(often))
        return out


# ---------------------------------------------------------------- passes

def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for batch in batches:
        for piece in text_pieces(batch):
            words = Words(piece.column("text"), piece.column("lang"))
            if len(words.start):
                yield words


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for words in _batches(batches):
        h, first, count = distinct(words.hashes)
        yield pa.RecordBatch.from_arrays([words.lang_names(first), words.texts(first, 1), pa.array(h.view(np.int64)), pa.array(count)],
                                         ["lang", "phrase", "hash", "n"])


def _dealt(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The bytes of ``values``, cut at ``starts``."""
    off = np.append(starts, len(values)) * values.itemsize
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _run_counts(n: int, has, bits: int):
    """Counts of runs of ``n`` words whose two runs of ``n - 1`` words pass, dealt to ``2**bits``
    buckets; a run is told by the hash of its first ``n - 1`` words and that of its last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _batches(batches):
            shorter = words.runs(n - 1)
            before = np.zeros(len(words.start) + 1, np.uint64)
            before[shorter] = run_hashes(words.hashes, shorter, n - 1)
            passes = np.zeros(len(before), bool)
            passes[shorter] = has(before[shorter])
            runs = words.runs(n)
            runs = runs[passes[runs] & passes[runs + 1]]
            value, first, count = distinct(mix(before[runs] * _BASE + words.hashes[runs + n - 1]))
            first = runs[first]
            bucket = (value >> np.uint64(64 - bits)).astype(np.int32)
            starts = np.flatnonzero(np.diff(bucket, prepend=-1))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[starts]), _dealt(before[first], starts), _dealt(words.hashes[first + n - 1], starts),
                                              _dealt(count.astype(np.uint32), starts)], ["bucket", "head", "tail", "n"])
    return run


def _frequent_runs(least: int):
    """(head, tail, hash) of the runs found ``least`` times or more, from dealt rows sorted by bucket."""
    def frequent(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        head, tail, n = (np.concatenate([np.frombuffer(v.as_buffer(), kind) for r in rows for v in r.column(c)])
                         for c, kind in (("head", np.uint64), ("tail", np.uint64), ("n", np.uint32)))
        value = mix(head * _BASE + tail)
        order = np.argsort(value)
        value = value[order]
        new = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
        keep = np.add.reduceat(n[order].astype(np.int64), new) >= least
        at = order[new[keep]]
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (head[at], tail[at], value[new[keep]])], ["head", "tail", "hash"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for bucket, rows in _segments(batches, "bucket"):
            if held and bucket != last:
                yield frequent(held)
                held = []
            held, last = [*held, rows], bucket
        if held:
            yield frequent(held)
    return run


def _segments(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Neighbouring rows of a batch that agree on the (whole number) columns: these numbers, and the rows."""
    for batch in batches:
        if batch.num_rows:
            keys = [batch.column(c).to_numpy() for c in columns]
            new = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)]))
            for start, end in zip(new.tolist(), [*new[1:].tolist(), batch.num_rows]):
                yield *(int(k[start]) for k in keys), batch.slice(start, end - start)


def candidates_of(texts: DataFrame, words: DataFrame, longest: int, least: int, parts: int = BUCKETS) -> tuple[DataFrame, list[Bitmap]]:
    """(lang, phrase, pair) of 2 to ``longest`` words that may be found ``least`` times or more: all
    that are, and those that share a hash with others; ``pair`` is the hash of the first two words.
    With them a bitmap of the hashes for each length. ``words``: the frequent ones (lang, phrase,
    hash); ``parts``: the buckets in which runs are counted."""
    level, bitmap, out, bitmaps = words, Bitmap(words.select("hash")), None, []
    bits = max(1, (parts - 1).bit_length())
    for n in range(2, longest + 1):
        counts = texts.mapInArrow(_run_counts(n, bitmap.test(), bits), "bucket int, head binary, tail binary, n binary")
        with small_batches(texts.sparkSession, BATCH_BYTES):
            keys = stage(counts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_frequent_runs(least), "head long, tail long, hash long"),
                         "hashes")
        pair = F.col("hash") if n == 2 else F.col("pair")
        first = level.select("lang", F.col("phrase").alias("first"), F.col("hash").alias("head"), *([] if n == 2 else ["pair"]))
        last = words.select("lang", F.col("phrase").alias("last"), F.col("hash").alias("tail"))
        level = stage(keys.join(first, "head").join(last, ["lang", "tail"]).select(
            "lang", F.concat_ws(" ", "first", "last").alias("phrase"), "hash", pair.alias("pair")), "found")
        bitmap = Bitmap(level.select("hash"))
        bitmaps.append(bitmap)
        out = level if out is None else out.unionAll(level)
    return out.select("lang", "phrase", "pair").distinct(), bitmaps


def _shard_of(pair: np.ndarray, shards: int) -> np.ndarray:
    return ((pair >> np.uint64(33)).view(np.int64) % shards).astype(np.int32)


def _windows(tests: list, shards: int):
    """The windows of the texts: from each word on as many words as pass ``tests`` (of two words,
    three, ...), if two do, followed by an end of piece. A row has those of a lang and shard, and
    how often each is there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _batches(batches):
            first = words.runs(2)
            pair = run_hashes(words.hashes, first, 2)
            ok = tests[0](pair)
            first, pair = first[ok], pair[ok]
            whole, last, live = pair.copy(), first + 1, np.arange(len(first))
            for test in tests[1:]:
                live = live[~words.last[last[live]]]
                longer = mix(whole[live] * _BASE + words.hashes[last[live] + 1])
                ok = test(longer)
                live = live[ok]
                whole[live] = longer[ok]
                last[live] += 1
            start = words.start[first]
            size = words.end[last] - start
            order = np.argsort(whole)
            a, b = order[1:], order[:-1]
            new = (whole[a] != whole[b]) | (size[a] != size[b]) | (words.lang[first[a]] != words.lang[first[b]])
            alike = np.flatnonzero(~new)  # by their hashes
            new[alike] = words.differ(start[a[alike]], start[b[alike]], size[a[alike]])
            new = np.flatnonzero(np.concatenate([[True], new])) if len(order) else np.zeros(0, np.int64)
            at, count = order[new], np.diff(np.append(new, len(order)))
            part = _shard_of(pair[at], shards).astype(np.int64) * len(words.langs) + words.lang[first[at]]
            order = np.argsort(part, kind="stable")
            at, count, part = at[order], count[order], part[order]
            starts = np.flatnonzero(np.diff(part, prepend=-1))
            start, size = start[at], size[at] + 1
            off = np.concatenate([[0], np.cumsum(size)])
            data = words.data[np.repeat(start - off[:-1], size) + np.arange(off[-1])]
            data[off[1:] - 1] = _END
            cut = np.append(off[starts], off[-1]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array((part[starts] // len(words.langs)).astype(np.int32)), pa.array(np.ones(len(starts), np.int32)),
                 pa.array([v.decode() for v in words.langs], pa.string()).take(pa.array(part[starts] % len(words.langs))),
                 pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cut), pa.py_buffer(data)]),
                 _dealt(count.astype(np.uint32), starts)], ["shard", "kind", "lang", "data", "n"])
    return run


def _count_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, f) of the phrases (rows of kind 0) found in the windows (of kind 1), the rows
    being sorted by shard and kind: a shard's trie, then its windows past it."""
    now, langs, phrases, trie, sums = None, [], [], None, None

    def found() -> pa.RecordBatch:
        at = np.flatnonzero(sums)
        return pa.RecordBatch.from_arrays([pa.array([langs[i] for i in at], pa.string()), pa.array([phrases[i].decode() for i in at], pa.string()),
                                           pa.array(sums[at])], ["lang", "phrase", "f"])

    for shard, kind, rows in _segments(batches, "shard", "kind"):
        if shard != now:
            if trie is not None:
                yield found()
            now, langs, phrases, trie = shard, [], [], None
        if kind == 0:
            langs += rows.column("lang").to_pylist()
            phrases += rows.column("data").to_pylist()
            continue
        if not phrases:
            continue  # windows of hashes that only look like a phrase's
        if trie is None:
            trie, sums = DoubleArray([a.encode() + b"\0" + b for a, b in zip(langs, phrases)]), np.zeros(len(phrases), np.int64)
        coded = rows.column("lang").dictionary_encode()
        root = np.array([trie.root(v.encode()) for v in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()]
        size = pc.binary_length(rows.column("data")).to_numpy().astype(np.int64)
        part = np.cumsum(size) // WALK_BYTES
        for some in np.split(np.arange(len(size)), np.flatnonzero(np.diff(part)) + 1):
            held = rows.slice(int(some[0]), len(some))
            data = np.frombuffer(b"".join(held.column("data").to_pylist()), np.uint8)
            often = np.frombuffer(b"".join(held.column("n").to_pylist()), np.uint32).astype(np.int64)
            start = np.flatnonzero(np.concatenate([[True], data[:-1] == _END]))
            many = (pc.binary_length(held.column("n")).to_numpy() // 4).astype(np.int64)
            sums += trie.walk(data, start, np.repeat(root[some], many), often, len(phrases))
    if trie is not None:
        yield found()


def count_phrases(texts: DataFrame, candidates: DataFrame, bitmaps: list[Bitmap], parts: int = BUCKETS) -> DataFrame:
    """(lang, phrase, f) of the candidates: exact occurrences in ``texts`` (lang, text). ``parts``:
    the least number of shards."""
    rows = stage(candidates, "candidates")
    room = F.greatest(F.lit(1), F.expr(f"(octet_length(phrase) + octet_length(lang)) div {SHARD_BYTES // SHARD_PHRASES}"))
    shards = max(parts, -(-(rows.agg(F.sum(room)).first()[0] or 0) // SHARD_PHRASES))
    shard = F.pmod(F.shiftrightunsigned("pair", 33), F.lit(shards)).cast("int").alias("shard")
    tries = rows.select(shard, F.lit(0).alias("kind"), "lang", F.encode("phrase", "UTF-8").alias("data"), F.lit(None).cast("binary").alias("n"))
    windows = texts.mapInArrow(_windows([b.test() for b in bitmaps], shards), "shard int, kind int, lang string, data binary, n binary")
    with small_batches(texts.sparkSession, BATCH_BYTES):
        return stage(tries.unionAll(windows).repartition("shard").sortWithinPartitions("shard", "kind")
                     .mapInArrow(_count_windows, "lang string, phrase string, f long"), "phrase-counts")


def mine(docs: DataFrame, longest: int = 3, least: int = 10, top: int = 2000, cover: int = 50) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the ``top`` collocations of 2 to ``longest``
    words of each lang of ``docs`` (lang, text)."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    words = stage(texts.mapInArrow(_count_words, "lang string, phrase string, hash long, n long")
                  .groupBy("lang", "phrase", "hash").agg(F.sum("n").alias("f")), "words")
    frequent = words.where(F.col("f") >= least)
    parts = max(BUCKETS, (words.agg(F.sum("f")).first()[0] or 0) // BUCKET_WORDS)
    found, bitmaps = candidates_of(texts, frequent.select("lang", "phrase", "hash"), longest, least, parts)
    f = count_phrases(texts, found, bitmaps, parts).where(F.col("f") >= least).withColumn("words", F.size(F.split("phrase", " ")))
    return rank(frequent, words, f, top, cover)


def rank(frequent: DataFrame, words: DataFrame, phrases: DataFrame, top: int, cover: int) -> DataFrame:
    """Scores, covers and ranks of ``phrases`` (lang, phrase, f, words); ``words`` has all words,
    ``frequent`` those that a phrase can hold."""
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    every = frequent.select("lang", "phrase", "f").unionAll(phrases.select("lang", "phrase", "f"))
    cuts = phrases.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"),
                          F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.expr("slice(w, 1, k)"), " ").alias("left"),
                       F.array_join(F.expr("slice(w, k + 1, size(w))"), " ").alias("right"))
    for side, short in (("left", "l"), ("right", "r")):
        cuts = cuts.join(every.select("lang", F.col("phrase").alias(side), F.col("f").alias(short)), ["lang", side])
    score = F.expr("cast((cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) "
                   "div (cast(l as decimal(18,0)) * cast(r as decimal(18,0))) as bigint)")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # a phrase inside a longer one that has nearly all its occurrences is dropped
    inside = phrases.where("words > 2").select(
        "lang", F.col("f").alias("longer"), F.split("phrase", " ").alias("w"), F.explode(F.expr("sequence(2, words - 1)")).alias("k"))
    inside = inside.select("lang", "longer", "w", "k", F.explode(F.expr("sequence(1, size(w) - k + 1)")).alias("i")).groupBy(
        "lang", F.array_join(F.expr("slice(w, i, k)"), " ").alias("phrase")).agg(F.max("longer").alias("longer"))
    kept = best.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * cover))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    ranked = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"),
                         F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).alias("part"))
    for keys in (["lang", "part"], ["lang"]):  # the first of each part hold the first of the whole
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
