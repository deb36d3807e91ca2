"""Sum-of-squares packing of tokenised documents into fixed-length sequences.

Documents are tokenised and ended by token 0; a longer one is cut into full pieces, the first
of which may be shorter. Pieces are dealt at random to shards whose number follows the count
of pieces. A shard opens sequences and keeps, for every residual gap g, the number N(g) of
open sequences with that gap. Each piece goes where the sum of N(g)^2 becomes smallest: into
a sequence with some gap g, which then has gap g - size; ties take the smallest gap. A new
sequence opens where none has room.

A shard's state is N(g) and one stack of open sequences per gap, so memory is bounded by the
shard's rows; shards never meet, and each leaves a few sequences open, a share that does not
grow with the data.

Defined results: a null or empty text has one piece, the end token. Rows given twice, null
doc_ids included, are packed like any others. Columns other than those named are ignored by
``pieces``; ``pack`` carries them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcat.llm.support import stage, text_pieces, worker_cache

LENGTH = 2048
END = 0
#: Pieces that one shard should hold.
SHARD_ROWS = 16_384
#: Text chunks whose ids a task remembers at most.
REMEMBERED = 150_000
#: Bytes of text tokenised at once.
TEXT_BYTES = 2_000_000

#: The pattern that byte-level tokenizers of this family split text with (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: A space after any white space.
_ODD_SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}] "


class ChunkedTokenizer:
    """Token ids of many texts from a byte-level BPE tokenizer file, each distinct chunk
    encoded once.

    Such a tokenizer never joins a visible character with the space after it, so a text
    whose spaces all follow visible characters is the chain of its chunks " word"; any other
    text is encoded whole. Merges are ranked by id in these files, so the file's vocabulary
    is all that the encoder needs. A text that holds the string of one of the file's added
    tokens is left to the file's own tokenizer if ``added``; else such strings are ordinary
    text."""

    def __init__(self, path: str, added: bool = False):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()] if added else []
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        # byte-level files write printable bytes as themselves, the others from U+0100 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in set(printable)]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}
        ranks = {bytes(byte[c] for c in token): rank for token, rank in vocabulary.items()}
        self.encoder = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = np.zeros(max(ranks.values()) + 1, np.int64)
        self.bytes_of[list(ranks.values())] = [len(token) for token in ranks]
        self._forget()

    def _forget(self):
        self.known: dict[str, int] = {}
        self.begin = self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.encoder.encode_ordinary(text), np.uint32)

    def _learn(self, chunks: list[str]):
        """Encode new chunks: those that end in a visible character all in one text, which
        the chunks' lengths in bytes cut again."""
        plain = [c for c in chunks if len(c) > 1 and c[0] == " " and not c[-1].isspace()]
        odd = [c for c in chunks if len(c) == 1 or c[0] != " " or c[-1].isspace()]
        ids = self.encode("".join(plain))
        ends = np.cumsum(pc.binary_length(pa.array(plain, pa.string())).to_numpy(zero_copy_only=False), dtype=np.int64)
        cuts = np.searchsorted(np.cumsum(self.bytes_of[ids]), ends, side="left") + 1
        more = [self.encode(c) for c in odd]
        length = np.concatenate([np.diff(cuts, prepend=0) if len(cuts) else np.zeros(0, np.int64),
                                 np.array([len(m) for m in more], np.int64)])
        self.known.update(zip(plain + odd, range(len(self.known), len(self.known) + len(chunks))))
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.ids = np.concatenate([self.ids, ids, *more])

    def __call__(self, text: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each row."""
        if len(self.known) > REMEMBERED:
            self._forget()
        text = pc.fill_null(text.cast(pa.string()), "")
        split = pc.split_pattern(text, " ")
        off = split.offsets.to_numpy().astype(np.int64)
        off = off - off[0]
        coded = pc.dictionary_encode(split.flatten())
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        size = len(coded.dictionary)
        code[off[:-1]] += size  # a text's first chunk has no space before it
        present = np.zeros(2 * size, bool)
        present[code] = True
        used = np.flatnonzero(present)
        plain = coded.dictionary.to_pylist()
        chunks = [" " + plain[c] if c < size else plain[c - size] for c in used.tolist()]
        chunks = [c or "" for c in chunks]
        new = [c for c in chunks if c and c not in self.known]
        if new:
            self._learn(new)
        number = np.zeros(2 * size, np.int64)
        number[used] = [self.known[c] if c else -1 for c in chunks]
        number = number[code]
        n = np.where(number < 0, 0, self.length[number]) if len(self.length) else np.zeros(len(number), np.int64)
        ends = np.cumsum(n)
        at = np.repeat(self.begin[number] - (ends - n), n) + np.arange(ends[-1]) if len(ends) and ends[-1] else np.zeros(0, np.int64)
        flat = self.ids[at]
        bounds = np.concatenate([[0], ends])[off]
        odd = pc.match_substring_regex(text, _ODD_SPACE).to_numpy(zero_copy_only=False)
        special = np.zeros(len(text), bool)
        for token in self.added:
            special |= pc.match_substring(text, token).to_numpy(zero_copy_only=False)
        for i in range(len(text)):
            if special[i]:
                yield np.array(self.whole.encode(text[i].as_py(), add_special_tokens=False).ids, np.uint32)
            else:
                yield self.encode(text[i].as_py()) if odd[i] else flat[bounds[i]:bounds[i + 1]]


def _pieces(path: str, most: int, added: bool):
    def run(batches):
        cache = worker_cache()
        tokenizer = cache.get((path, added)) or cache.setdefault((path, added), ChunkedTokenizer(path, added))
        for batch in batches:
            for part in text_pieces(batch, most=TEXT_BYTES):
                ids, rows = part.column("doc_id").to_pylist(), []
                for doc, tokens in zip(ids, tokenizer(part.column("text"))):
                    tokens = np.append(tokens, np.uint32(END))
                    first = (len(tokens) - 1) % most + 1
                    start = 0
                    for k, end in enumerate(range(first, len(tokens) + 1, most)):
                        rows.append((doc, k, start, end - start, tokens[start:end].astype("<u4").tobytes()))
                        start = end
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                    ["doc_id", "piece", "start", "length", "ids"])
    return run


def pieces(docs: DataFrame, tokenizer: str, most: int = LENGTH, added: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids) of every row's text; ``ids`` are little-endian
    unsigned 32-bit numbers, ``tokenizer`` is the path of the tokenizer's file. With ``added``
    the strings of the file's added tokens have those tokens' ids, as its tokenizer gives them."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _pieces(tokenizer, most, added), "doc_id long, piece int, start long, length long, ids binary")


def place(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length, in the given order, by the sum-of-squares rule."""
    count = np.zeros(most + 1, np.int64)  # count[g]: open sequences with gap g
    stacks: list[list[int]] = [[] for _ in range(most + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened, never = 0, np.iinfo(np.int64).max
    for i, n in enumerate(lengths.tolist()):
        gap = most
        if n < most:
            # from gap g to g - n the sum changes by 2 (N(g - n) - N(g)) + 2; gap 0 closes and counts no more
            change = 2 * (count[:most - n] - count[n:most]) + 2
            change[0] = 1 - 2 * count[n]
            change[count[n:most] == 0] = never
            best = int(np.argmin(change))
            if change[best] != never:
                gap = best + n
        if gap < most:
            which = stacks[gap].pop()
            count[gap] -= 1
        else:
            which, opened = opened, opened + 1
        sequence[i], offset[i] = which, most - gap
        if gap > n:
            stacks[gap - n].append(which)
            count[gap - n] += 1
    return sequence, offset


def pack(rows: DataFrame, most: int = LENGTH) -> DataFrame:
    """``rows`` (doc_id, piece, start, length and any others) with ``sequence_id`` and
    ``offset``. Longest pieces come first inside a shard; a sequence opens when no open one
    has room."""
    rows = stage(rows, "pieces")
    shards = rows.count() // SHARD_ROWS + 1
    schema = T.StructType([*rows.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def fill(key, frame):
        frame = frame.sort_values(["length", "doc_id", "piece", "start"], ascending=[False, True, True, True], kind="stable")
        sequence, offset = place(frame["length"].to_numpy(), most)
        return frame.assign(sequence_id=sequence + (int(key[0]) << 32), offset=offset)

    # the staged row's own number spreads rows that are alike in all else: null ids, copies
    rows = rows.withColumn("row_", F.monotonically_increasing_id())
    shard = F.expr(f"pmod(xxhash64(doc_id, piece, start, length, row_), {shards})")
    return rows.withColumn("shard_", shard).drop("row_").groupBy("shard_").applyInPandas(lambda key, frame: fill(key, frame.drop(columns="shard_")), schema)


def sequences(docs: DataFrame, tokenizer: str, most: int = LENGTH) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, as little-endian numbers."""
    return (pack(pieces(docs, tokenizer, most), most).groupBy("sequence_id")
            .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids")))
