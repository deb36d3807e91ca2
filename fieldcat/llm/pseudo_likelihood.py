"""Masked pseudo-likelihood: a bidirectional window network, trained in numpy on the corpus,
predicts every word from the words on both sides; the summed log-probabilities score texts.

Vocabulary: every word that the whole corpus holds at least ``SEEN`` times (counts over all
documents); it grows with the corpus and stays a distributed table. The ``WORDS`` most
frequent are outputs of the network by themselves; the others are dealt to ``RARE`` groups by
their hash, and the network predicts the group. Inside a group a vocabulary word has its share
of the group's counted words; the share of words seen less often goes to all other words, by
their own spelling (a model of byte pairs, learnt from the words seen less often). So every
word, seen or not, has a probability of its own, and those of all words sum to at most one.

The network joins the embeddings of ``SIDE`` words on either side, applies one tanh layer, and
gives the probability as that of the class times that of the word or group inside the class.
A word is never among its own inputs, so every position is predicted as if masked. As a
neighbour, a word of a group has the group's embedding.

Training covers every position of all documents once: a position's hash names the one of the
``ROUNDS`` rounds in which it is a target. In each round every task starts from the same
parameters and takes a pass of stochastic gradients over its positions of that round; the
tasks' parameters are averaged, weighted by their
positions, in segments and in two steps, so no task gathers all of them. What reaches the
driver is one set of parameters, the network's own words, the byte pairs and a number for each
group, all of fixed size; the vocabulary meets the scored words by a join.

Defined results: a null or empty text has no words and log-likelihood 0. Texts of one word are
predicted from padding. Rows given twice score alike. An empty corpus keeps the first
parameters. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcat.llm.shingles import distinct_words, hash_strings, mix, word_codes
from fieldcat.llm.support import stage, text_pieces

WORDS, RARE, CLASSES = 3968, 128, 64
SIDE, EMBED, HIDDEN = 2, 16, 32
TOKENS = WORDS + RARE
INSIDE = TOKENS // CLASSES
ROUNDS, BATCH, RATE = 2, 4096, 0.15
#: Leading bits of a word's hash that name the bucket in which it is counted.
BUCKET_BITS = 11
#: Occurrences from which a word is in the vocabulary; rarer ones are spelled.
SEEN = 2
#: The mark at both ends of a spelled word, beside the 256 bytes.
EDGE = 256
#: Log-likelihoods are summed in whole units of this size, so in any order alike.
UNIT = 1e-6
#: Parameters in one averaged segment.
SEGMENT = 8192
_BLOCK = 8192
#: Scores up to this size have exponentials whose sums single precision holds.
SAFE = 60.0

Model = dict[str, np.ndarray]


class Vocabulary(NamedTuple):
    """``hashed`` (sorted) and ``ids``: the network's own words. ``words``: (word, logp), the
    other words and the logarithm of each one's share of its group. ``others``: per group, the
    logarithm of the share of all words not in the vocabulary. ``spelling``: the logarithm of
    each byte's probability after another."""

    hashed: np.ndarray
    ids: np.ndarray
    words: DataFrame
    others: np.ndarray
    spelling: np.ndarray


def shapes() -> dict[str, tuple[int, ...]]:
    return {"embed": (TOKENS + 1, EMBED), "layer": (2 * SIDE * EMBED, HIDDEN), "shift": (HIDDEN,),
            "class": (HIDDEN, CLASSES), "class_bias": (CLASSES,), "word": (CLASSES, HIDDEN, INSIDE), "word_bias": (CLASSES, INSIDE)}


def new_model(seed: int = 11) -> Model:
    rng = np.random.default_rng(seed)
    return {k: (rng.normal(0, 0.1, s) if len(s) > 1 and "bias" not in k else np.zeros(s)).astype(np.float32) for k, s in shapes().items()}


def flat(model: Model) -> np.ndarray:
    return np.concatenate([model[k].ravel() for k in shapes()])


def unflat(values: np.ndarray) -> Model:
    out, at = {}, 0
    for k, s in shapes().items():
        n = int(np.prod(s))
        out[k] = values[at:at + n].reshape(s).astype(np.float32)
        at += n
    return out


def token_ids(text: pa.Array, vocabulary: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words, and each row's offsets. ``vocabulary``: sorted hashes, ids."""
    hashed, code, off = word_codes(text)
    return ids_of(hashed, vocabulary)[code], off


def ids_of(hashed: np.ndarray, vocabulary: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    ids = (WORDS + (hashed % np.uint64(RARE)).astype(np.int64))
    if len(vocabulary[0]):
        at = np.minimum(np.searchsorted(vocabulary[0], hashed), len(vocabulary[0]) - 1)
        ids = np.where(vocabulary[0][at] == hashed, vocabulary[1][at], ids)
    return ids.astype(np.int32)


def byte_pairs(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of every word's byte pairs, its edges included, and the words' offsets."""
    words = words.cast(pa.string())
    size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    line = np.full(size.sum() + len(size) + 1, EDGE, np.int64)
    if size.sum():
        first = np.frombuffer(words.buffers()[1], np.int32)[words.offset]
        line[np.arange(size.sum()) + 1 + np.repeat(np.arange(len(size)), size)] = np.frombuffer(words.buffers()[2], np.uint8)[first:first + size.sum()]
    return line[:-1] * (EDGE + 1) + line[1:], np.concatenate([[0], np.cumsum(size + 1)])


def spelled(words: pa.Array, spelling: np.ndarray) -> np.ndarray:
    """The log-probability of each word's spelling."""
    pair, off = byte_pairs(words)
    total = np.concatenate([[0.0], np.cumsum(spelling.ravel()[pair])])
    return total[off[1:]] - total[off[:-1]]


def _packed(ids: np.ndarray, off: np.ndarray) -> pa.Array:
    """The ids of each text as a binary value."""
    return pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer((off * 2).astype(np.int32)), pa.py_buffer(ids.astype(np.uint16))])


def _unpacked(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids and offsets again."""
    packed = packed.cast(pa.binary())
    off = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset:packed.offset + len(packed) + 1].astype(np.int64)
    data = np.frombuffer(packed.buffers()[2] or b"", np.uint8)[off[0]:off[-1]]
    return data.view(np.uint16).astype(np.int32), (off - off[0]) // 2


def padded(ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids with SIDE paddings (TOKENS) round each text, and each position's place there."""
    where = np.arange(len(ids)) + SIDE * (1 + np.repeat(np.arange(len(off) - 1), np.diff(off)))
    out = np.full(len(ids) + SIDE * (len(off) + 1), TOKENS, np.int32)
    out[where] = ids
    return out, where


def contexts(wide: np.ndarray, where: np.ndarray) -> np.ndarray:
    """(positions, 2 * SIDE) neighbours of places in padded ids."""
    return wide[where[:, None] + np.array([*range(-SIDE, 0), *range(1, SIDE + 1)])]


def _by_class(target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The targets' order by class, and (class, start, end) of each class that is there."""
    group = target % CLASSES
    ends = np.cumsum(np.bincount(group, minlength=CLASSES)).tolist()
    runs = [(c, s, e) for c, (s, e) in enumerate(zip([0, *ends], ends)) if e > s]
    return np.argsort(group.astype(np.uint8), kind="stable"), runs


def _exponentials(z: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The exponentials of (positions, scores) in their place, up to a factor of each position,
    and each position's sum. The hidden values lie in -1 to 1, so the weights bound the scores;
    only where they could pass single precision is each position's greatest score taken off."""
    most = max(bias.max(), -bias.min())
    if HIDDEN * max(weights.max(), -weights.min()) + most > SAFE and np.abs(weights).sum(-2).max() + most > SAFE:
        z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    return z, z @ np.ones(z.shape[1], z.dtype)


def _hidden(model: Model, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = model["embed"].take(around, axis=0).reshape(len(around), 2 * SIDE * EMBED)
    h = x @ model["layer"]
    h += model["shift"]
    # tanh(h) = 1 - 2 / (1 + exp(2h)); beyond 40 it is one in either precision
    np.exp(2 * np.clip(h, -40, 40, out=h), out=h)
    h += 1
    np.divide(-2, h, out=h)
    h += 1
    return x, h


def _class_parts(model: Model, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    z = h @ model["class"]
    z += model["class_bias"]
    return _exponentials(z, model["class"], model["class_bias"])


def _word_parts(model: Model, h: np.ndarray, runs: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The same inside each position's class, for positions ordered by class."""
    z = np.empty((len(h), INSIDE), h.dtype)
    for c, s, e in runs:
        np.matmul(h[s:e], model["word"][c], out=z[s:e])
        z[s:e] += model["word_bias"][c]
    return _exponentials(z, model["word"], model["word_bias"])


def log_probabilities(model: Model, around: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The log-probability of each target between its neighbours."""
    order, runs = _by_class(target)
    target, place = target[order], np.arange(len(target))
    _, h = _hidden(model, around[order])
    e, total = _class_parts(model, h)
    got = np.log(e[place, target % CLASSES] / total)
    e, total = _word_parts(model, h, runs)
    got += np.log(e[place, target // CLASSES] / total)
    out = np.empty_like(got)
    out[order] = got
    return out


def gradient(model: Model, around: np.ndarray, target: np.ndarray) -> Model:
    """The gradient of the mean negative log-probability."""
    n = len(target)
    order, runs = _by_class(target)
    around, target, place = around[order], target[order], np.arange(n)
    x, h = _hidden(model, around)
    grad = {k: np.zeros_like(model[k]) for k in ("word", "word_bias", "embed")}
    d, total = _class_parts(model, h)
    d /= total[:, None]
    d[place, target % CLASSES] -= 1
    one = np.ones(n, d.dtype)
    grad["class"], grad["class_bias"] = h.T @ d, one @ d
    dh = d @ model["class"].T

    d, total = _word_parts(model, h, runs)
    d /= total[:, None]
    d[place, target // CLASSES] -= 1
    inner = np.empty_like(dh)
    for c, s, e in runs:
        np.matmul(h[s:e].T, d[s:e], out=grad["word"][c])
        np.matmul(one[s:e], d[s:e], out=grad["word_bias"][c])
        np.matmul(d[s:e], model["word"][c].T, out=inner[s:e])
    dh += inner

    dh *= 1 - h * h
    grad["layer"], grad["shift"] = (dh.T @ x).T, one @ dh
    token = around.ravel()
    by_token = np.argsort(token.astype(np.uint16), kind="stable")  # TOKENS is below 2**16: a radix sort
    starts = np.flatnonzero(np.diff(token[by_token], prepend=-1))
    grad["embed"][token[by_token[starts]]] = np.add.reduceat((dh @ model["layer"].T).reshape(-1, EMBED).take(by_token, axis=0), starts, axis=0)
    for g in grad.values():
        g /= n
    return {k: grad[k] for k in model}


def _count_words(batches):
    """(bucket, words, n, spellings): the distinct words of a piece, dealt out by their hash."""
    for batch in batches:
        for piece in text_pieces(batch):
            words, code, _ = distinct_words(piece.column("text"))
            hashed, count = hash_strings(words), np.bincount(code, minlength=len(words))
            bucket = (hashed >> np.uint64(64 - BUCKET_BITS)).astype(np.uint16)
            order = np.argsort(bucket, kind="stable")
            order = order[count[order] > 0]
            hashed, count, bucket = hashed[order], count[order].astype(np.int64), bucket[order].astype(np.int32)
            starts = np.flatnonzero(np.diff(bucket, prepend=-1))
            off = np.append(starts, len(order)).astype(np.int32)
            # no word holds a space
            spellings = pc.binary_join(pa.ListArray.from_arrays(pa.array(off), words.take(pa.array(order)).cast(pa.string())), " ")
            packed = pa.py_buffer((off * 8).astype(np.int32))
            held = [pa.Array.from_buffers(pa.binary(), len(starts), [None, packed, pa.py_buffer(x)]) for x in (hashed, count)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[starts]), *held, spellings], ["bucket", "words", "n", "spellings"])


def _sum_words(batches):
    """(word, n, spelling) of each word, from dealt rows sorted by bucket."""
    def summed(rows):
        word, n = (np.frombuffer(b"".join(rows.column(c).to_pylist()), np.int64) for c in ("words", "n"))
        spelling = pc.list_flatten(pc.split_pattern(rows.column("spellings").combine_chunks(), " "))
        word, first, back = np.unique(word, return_index=True, return_inverse=True)
        total = np.zeros(len(word), np.int64)
        np.add.at(total, back, n)
        return pa.RecordBatch.from_arrays([pa.array(word), pa.array(total), spelling.take(pa.array(first))], ["word", "n", "spelling"])

    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        bucket = batch.column("bucket").to_numpy()
        # the last bucket's rows wait for the rest of it
        cut = int(np.searchsorted(bucket, bucket[-1]))
        if held and bucket[-1] != last:
            yield summed(pa.concat_tables([*held, rows.slice(0, cut)]))
            held = []
        elif cut:
            yield summed(rows.slice(0, cut))
        held, last = [*held, rows.slice(cut)], bucket[-1]
    if held:
        yield summed(pa.concat_tables(held))


def _count_pairs(batches):
    count = np.zeros((EDGE + 1) ** 2, np.int64)
    for batch in batches:
        pair, _ = byte_pairs(batch.column("spelling"))
        count += np.bincount(pair, minlength=len(count))
    some = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[some])], ["pair", "n"])


def vocabulary_of(docs: DataFrame) -> Vocabulary:
    """The vocabulary of all documents: the most frequent words by rank, the others as a table."""
    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_count_words, "bucket int, words binary, n binary, spellings string")
    counts = counts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_sum_words, "word long, n long, spelling string")
    counts = stage(counts, "words")
    top = counts.select("word", "n").orderBy(F.desc("n"), "word").limit(WORDS).collect()
    hashed = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(hashed)

    beyond = F.lit(False)
    if len(top) == WORDS:
        n, word = top[-1]["n"], top[-1]["word"]
        beyond = (F.col("n") < n) | ((F.col("n") == n) & (F.col("word") > word))
    rest = counts.where(beyond).withColumn("group", F.expr(f"cast(pmod(word, {RARE}) as int)"))
    size, once = np.ones(RARE), np.ones(RARE)  # one more word that was never seen
    for r in rest.groupBy("group").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("n") < SEEN, F.col("n")).otherwise(0)).alias("once")).collect():
        size[r["group"]] += r["n"]
        once[r["group"]] += r["once"]
    logs = F.array(*[F.lit(float(x)) for x in np.log(size)])
    words = rest.where(F.col("n") >= SEEN).select("word", (F.log("n") - F.element_at(logs, F.col("group") + 1)).alias("logp"))

    pairs = np.full((EDGE + 1) ** 2, 0.1)
    found = rest.where(F.col("n") < SEEN).select("spelling").mapInArrow(_count_pairs, "pair int, n long")
    for r in found.groupBy("pair").agg(F.sum("n").alias("n")).collect():
        pairs[r["pair"]] += r["n"]
    pairs = pairs.reshape(EDGE + 1, EDGE + 1)
    return Vocabulary(hashed[order], order.astype(np.int64), words, np.log(once / size), np.log(pairs / pairs.sum(1, keepdims=True)))


def rounds_of(ids: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The round in which each position is a target, by its place in its text and its word."""
    place = np.arange(len(ids)) - np.repeat(off[:-1], np.diff(off))
    return (mix(place.astype(np.uint64) * np.uint64(31) + ids.astype(np.uint64)) % np.uint64(ROUNDS)).astype(np.int64)


def _passes(held, turn: int, keep: bool = False):
    """(segment, part, weight, values): the parameters after a task's pass over its texts, or
    over their token ids. With ``keep``, also a row with the token ids of each text."""
    def run(batches):
        vocabulary, values = held.value
        model, seen = unflat(values), 0
        power = {k: np.full_like(v, 1e-4) for k, v in model.items()}
        around, target = np.zeros((0, 2 * SIDE), np.int32), np.zeros(0, np.int32)

        def learn(around, target):
            for k, g in gradient(model, around, target).items():
                step = g * g
                power[k] += step
                np.sqrt(power[k], out=step)
                g *= RATE
                g /= step
                model[k] -= g

        mark = 0
        for batch in batches:
            column = batch.schema.names[0]
            for piece in text_pieces(batch, column):
                if column == "ids":
                    ids, off = _unpacked(piece.column("ids"))
                else:
                    ids, off = token_ids(piece.column("text"), vocabulary)
                if keep:
                    n = len(piece)
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.binary()),
                         _packed(ids, off)], ["segment", "part", "weight", "vals", "ids"])
                at = np.flatnonzero(rounds_of(ids, off) == turn)
                mark = int(mix(np.array([mark + len(ids)], np.uint64))[0] >> np.uint64(1))
                wide, where = padded(ids, off)
                for s in range(0, len(at), _BLOCK):
                    around = np.concatenate([around, contexts(wide, where[at[s:s + _BLOCK]])])
                    target = np.concatenate([target, ids[at[s:s + _BLOCK]]])
                    while len(target) >= BATCH:
                        learn(around[:BATCH], target[:BATCH])
                        around, target, seen = around[BATCH:], target[BATCH:], seen + BATCH
        if len(target):
            learn(around, target)
            seen += len(target)
        if seen:
            new = flat(model)
            starts = range(0, len(new), SEGMENT)
            out = pa.RecordBatch.from_arrays([
                pa.array(list(range(len(starts))), pa.int32()), pa.array([mark % 64] * len(starts), pa.int32()),
                pa.array([float(seen)] * len(starts)), pa.array([new[s:s + SEGMENT].tobytes() for s in starts], pa.binary())],
                ["segment", "part", "weight", "vals"])
            yield out.append_column("ids", pa.nulls(len(starts), pa.binary())) if keep else out
    return run


def _averaged(frame):
    weight = frame["weight"].to_numpy()
    total = sum(w * np.frombuffer(v, np.float32).astype(np.float64) for w, v in zip(weight, frame["vals"]))
    first = frame.iloc[:1]
    return first.assign(weight=weight.sum(), vals=[(total / weight.sum()).astype(np.float32).tobytes()])


def train(docs: DataFrame, vocabulary: Vocabulary) -> Model:
    """The network after ``ROUNDS`` averaged passes over ``docs``; the first writes the texts'
    token ids, which the others read."""
    schema = "segment int, part int, weight double, vals binary"
    values = flat(new_model())
    texts = docs.select(F.col("text").cast("string").alias("text"))
    for turn in range(ROUNDS):
        held = docs.sparkSession.sparkContext.broadcast(((vocabulary.hashed, vocabulary.ids), values))
        keep = turn == 0 and ROUNDS > 1
        rows = texts.mapInArrow(_passes(held, turn, keep), schema + ", ids binary" * keep)
        if keep:
            rows = stage(rows, "ids")
            texts = rows.where("segment is null").select("ids")
            rows = rows.where("segment is not null").drop("ids")
        rows = rows.groupBy("segment", "part").applyInPandas(_averaged, schema).groupBy("segment").applyInPandas(_averaged, schema)
        got = sorted(rows.select("segment", "vals").collect())
        if got:
            values = np.concatenate([np.frombuffer(r["vals"], np.float32) for r in got])
    return unflat(values)


def _scores(held):
    """A row (``times`` 0) with the network's log-likelihood for each document, and a row for
    each of its distinct words that are in a group, with the logarithm of its share there if
    it should not be in the vocabulary."""
    def run(batches):
        vocabulary, others, spelling, model = held.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for piece in text_pieces(batch):
                words, code, off = distinct_words(piece.column("text"))
                hashed = hash_strings(words)
                token = ids_of(hashed, vocabulary)
                ids = token[code]
                logp = np.empty(len(ids), np.float64)
                wide, where = padded(ids, off)
                for s in range(0, len(ids), _BLOCK):
                    at = slice(s, s + _BLOCK)
                    logp[at] = log_probabilities(model, contexts(wide, where[at]), ids[at])
                total = np.concatenate([[0.0], np.cumsum(logp)])
                rows = row + np.arange(len(piece))
                row += len(piece)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), piece.column("doc_id"), pa.array(np.diff(off)), pa.array(mix(rows.view(np.uint64)).view(np.int64)),
                     pa.array(np.zeros(len(piece), np.int64)), pa.array(total[off[1:]] - total[off[:-1]])],
                    ["row", "doc_id", "n_tokens", "word", "times", "other"])
                grouped = np.flatnonzero(token >= WORDS)
                other = np.zeros(len(words))
                other[grouped] = others[token[grouped] - WORDS] + spelled(words.take(pa.array(grouped)), spelling)
                place = np.flatnonzero(ids >= WORDS)
                pair, times = np.unique(np.repeat(np.arange(len(piece)), np.diff(off))[place] * len(words) + code[place], return_counts=True)
                for s in range(0, len(pair), _BLOCK):
                    of, word = np.divmod(pair[s:s + _BLOCK], len(words))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[of]), pa.nulls(len(of), pa.int64()), pa.nulls(len(of), pa.int64()), pa.array(hashed[word].view(np.int64)),
                         pa.array(times[s:s + _BLOCK].astype(np.int64)), pa.array(other[word])],
                        ["row", "doc_id", "n_tokens", "word", "times", "other"])
    return run


def score(docs: DataFrame, vocabulary: Vocabulary, model: Model) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_probability) of every row."""
    held = docs.sparkSession.sparkContext.broadcast(((vocabulary.hashed, vocabulary.ids), vocabulary.others, vocabulary.spelling, model))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _scores(held), "row long, doc_id long, n_tokens long, word long, times long, other double")
    term = F.when(F.col("times") == 0, F.col("other")).otherwise(F.col("times") * F.coalesce("logp", "other"))
    rows = rows.join(vocabulary.words.hint("shuffle_hash"), "word", "left").groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), (F.sum(F.rint(term / UNIT).cast("long")) * UNIT).alias("log_likelihood"))
    return rows.select("doc_id", "n_tokens", "log_likelihood",
                       F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")).alias("mean_log_probability"))


def score_corpus(docs: DataFrame) -> DataFrame:
    """Scores of all documents by a network trained on all documents."""
    vocabulary = vocabulary_of(docs)
    return score(docs, vocabulary, train(docs, vocabulary))
