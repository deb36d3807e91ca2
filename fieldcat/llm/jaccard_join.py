"""N-gram Jaccard join: an exact metric-space join of documents' shingle sets.

The Jaccard distance 1 - J is a metric. Two documents link when J >= 0.8 (``100 * |A n B|
>= 80 * |A u B|``), a ball of radius 0.2. The join runs in these steps, all of which keep
every link:

1. ``meta``: one row per document with its set's size and fingerprint. Equal sets are one
   node from here on.
2. ``survivors``: a first region split. Tokens (shingle hashes) below a size-dependent hash
   level are dealt to buckets; a set keeps its place only if so many of its own tokens occur
   in another set that a link remains possible (a link needs ``|A n B| >= 0.8 |A|``, so at
   most ``0.2 |A|`` tokens of A may be unshared). In text, nearly all sets are at distance 1
   from every pivot; this is the exact test that puts them in regions of their own.
3. ``regions``: among the survivors that agree in the least token of a min-hash order, the
   set with the smallest share of unshared tokens is the pivot (a few orders). Each set's
   exact distance to its pivots is computed; sets within 0.2 link to the pivot.
4. ``boundary``: the join goes on inside the survivors. Each set is copied to the cells of
   its rarest tokens that another survivor shares, as many as can be the first common token
   of a link, so two linked sets meet in a cell. Pairs of a cell are compared only if their
   region differs (links inside one component are not needed), if their sizes, the tokens
   left from the cell's on and a parity sketch (which bounds the symmetric difference from
   below) allow J >= 0.8, and if the triangle inequality does: |d(x, p) - d(y, p)| <= 0.2
   for every pivot p that both were measured against.
5. ``components`` of all links, by distributed star contraction.

Defined results: a null or empty text, or one without words, has an empty set, links with
nothing and is its own component. Rows with one doc_id twice stay two rows. A null doc_id is
kept as a row; it never names a component unless all members' ids are null. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcat.llm.shingles import mix, shingle_sets
from fieldcat.llm.support import BROADCAST_ROWS, connected_components, small_batches, small_side, stage, text_pieces

WIDTH = 5
#: Tokens that one bucket should hold.
BUCKET_TOKENS = 50_000
#: Text whose sets are made at once: the kernels hold its words several times.
SET_BYTES = 1_000_000
#: Tokens (with their sets and sizes) that a task deals out at once, in bytes.
DEAL_BYTES = 5_000_000
#: Sets whose repeats a task leaves out when it deals tokens.
SEEN_SETS = 8192
#: Min-hash orders that choose pivots.
ORDERS = 6
#: Survivors that may be broadcast to choose their rows; beyond it the same join shuffles.
BROADCAST_SETS = BROADCAST_ROWS
#: Stands for a null doc_id where the rows of the sets are chosen.
NO_ID = -(1 << 63)


def need(n):
    """Tokens of a set of size n that a linked set must share: ceil(0.8 n)."""
    return (4 * n + 4) // 5


def level(n):
    """Share of the hash range whose tokens a set of size n deals out; falls with n."""
    return np.minimum(1.0, 0.28 + 40.0 / np.maximum(n, 1))


def _below(values: np.ndarray, share) -> np.ndarray:
    return (values >> np.uint64(11)) < (np.asarray(share) * float(1 << 53)).astype(np.uint64)


def _fingerprints(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    n = np.diff(off)
    return mix((total[off[1:]] - total[off[:-1]]) + n.astype(np.uint64)).view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for piece in text_pieces(batch, most=SET_BYTES):
            values, off = shingle_sets(piece.column("text"), WIDTH)
            yield piece, values, off, np.diff(off), _fingerprints(values, off)


def _meta(batches):
    """(doc_id, text_hash, n, fp, own): a row's set's size and fingerprint, and how many of its
    tokens lie below its own level."""
    for piece, values, _, n, fp in _sets(batches):
        rows = np.repeat(np.arange(len(n)), n)
        own = np.bincount(rows[_below(values, level(1.25 * n)[rows])], minlength=len(n))
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("text_hash"), pa.array(n), pa.array(fp, mask=n == 0), pa.array(own.astype(np.int64))],
                                         ["doc_id", "text_hash", "n", "fp", "own"])


def _deal(bucket: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """One row for each bucket, with its values of the columns as bytes."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    spans = list(zip(starts.tolist(), np.append(starts[1:], len(bucket)).tolist()))
    held = [pa.array([x[s:e].tobytes() for s, e in spans], pa.binary()) for x in (c[order] for c in columns.values())]
    return pa.RecordBatch.from_arrays([pa.array(bucket[starts]), *held], ["bucket", *columns])


def _deals(parts: Iterator[dict[str, np.ndarray]], by: str, buckets: int) -> Iterator[pa.RecordBatch]:
    """The rows of many parts dealt out together by the column ``by``, DEAL_BYTES at a time: few
    rows for each bucket, however small the parts are."""
    held: list[dict[str, np.ndarray]] = []

    def dealt():
        whole = {c: np.concatenate([part[c] for part in held]) for c in held[0]}
        held.clear()
        return _deal(_bucket(whole[by], buckets), **whole)

    for part in parts:
        held.append(part)
        if sum(c.nbytes for x in held for c in x.values()) >= DEAL_BYTES:
            yield dealt()
    if held:
        yield dealt()


def _buckets(batches, **kinds) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns of one bucket after another, from dealt rows sorted by bucket."""
    held: list[pd.DataFrame] = []

    def whole():
        return tuple(np.frombuffer(b"".join(v for part in held for v in part[c]), kind) for c, kind in kinds.items())

    for batch in batches:
        for bucket, part in batch.to_pandas().groupby("bucket", sort=False):
            if held and bucket != held[-1]["bucket"].iloc[-1]:
                yield whole()
                held.clear()
            held.append(part)
    if held:
        yield whole()


def _bucket(values: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(values.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _low_tokens(buckets: int):
    """Tokens below the level of their sets, dealt out with their sets and whether they count
    for the set itself."""
    def low(batches):
        seen = np.zeros(0, np.int64)
        for _, values, _, n, fp in _sets(batches):
            once = np.zeros(len(n), bool)
            once[np.unique(fp, return_index=True)[1]] = True
            once &= ~np.isin(fp, seen)
            seen = np.append(seen, fp[once])[-SEEN_SETS:]
            share, own = level(n), level(1.25 * n)
            rows = np.repeat(np.arange(len(n)), n)
            take = once[rows] & _below(values, share[rows])
            token, rows = values[take], rows[take]
            yield {"tokens": token, "fps": fp[rows], "mine": _below(token, own[rows]).astype(np.uint8)}

    return lambda batches: _deals(low(batches), "tokens", buckets)


def _shared(batches):
    """(fp, shared): per bucket, how many own tokens of a set occur in another set too."""
    for token, fp, mine in _buckets(batches, tokens=np.uint64, fps=np.int64, mine=np.bool_):
        order = np.lexsort((fp, token))
        token, fp, mine = token[order], fp[order], mine[order]
        new_token = np.concatenate([[True], token[1:] != token[:-1]])
        new = new_token | np.concatenate([[True], fp[1:] != fp[:-1]])
        token, fp, mine, new_token = token[new], fp[new], mine[new], new_token[new]
        group = np.cumsum(new_token) - 1
        several = np.bincount(group)[group] > 1
        key, count = np.unique(fp[several & mine], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(count.astype(np.int64))], ["fp", "shared"])


def _chosen(batches):
    """(fp, n, tokens, least): sets themselves and their min-hashes."""
    for _, values, off, n, fp in _sets(batches):
        rows = np.flatnonzero(n > 0)
        tokens = [values[off[i]:off[i + 1]] for i in rows]
        least = [[int(mix(t * np.uint64(2 * j + 3) + np.uint64(j)).min().view(np.int64)) for j in range(ORDERS)] for t in tokens]
        yield pa.RecordBatch.from_arrays([
            pa.array(fp[rows]), pa.array(n[rows]), pa.array([t.tobytes() for t in tokens], pa.binary()),
            pa.array(least, pa.list_(pa.int64()))], ["fp", "n", "tokens", "least"])


def _measured(batches):
    """(a, b, na, nb, both): sizes of the intersections of pairs of sets."""
    for batch in batches:
        a, b = batch.column("ta").to_pylist(), batch.column("tb").to_pylist()
        both = np.empty(len(a), np.int64)
        for i, (x, y) in enumerate(zip(a, b)):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            z = np.sort(np.concatenate([x, y]))
            both[i] = np.count_nonzero(z[1:] == z[:-1])
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), batch.column("na"), batch.column("nb"), pa.array(both)],
                                         ["a", "b", "na", "nb", "both"])


def measure(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of fingerprints with their sizes and intersection sizes."""
    left = sets.select(F.col("fp").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("fp").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "ta", "tb").mapInArrow(
        _measured, "a long, b long, na long, nb long, both long")


def linked():
    """The link condition on a measured pair."""
    return F.expr("100 * both >= 80 * (na + nb - both)")


def _all_tokens(buckets: int):
    """All tokens of the sets, dealt out."""
    def tokens(batches):
        for batch in batches:
            raw = batch.column("tokens").to_pylist()
            count = [len(r) // 8 for r in raw]
            fp, n = (np.repeat(batch.column(c).to_numpy(), count) for c in ("fp", "n"))
            yield {"tokens": np.frombuffer(b"".join(raw), np.int64), "fps": fp, "ns": n}

    return lambda batches: _deals(tokens(batches), "tokens", buckets)


def _several(buckets: int):
    """The tokens that two or more sets hold, with that number, dealt out by set."""
    def several(batches):
        for token, fp, n in _buckets(batches, tokens=np.int64, fps=np.int64, ns=np.int64):
            _, back, count = np.unique(token, return_inverse=True, return_counts=True)
            df = count[back]
            keep = df > 1
            yield {"tokens": token[keep], "fps": fp[keep], "ns": n[keep], "dfs": df[keep]}

    return lambda batches: _deals(several(batches), "fps", buckets)


def _prefix(batches):
    """(token, fp, n, rest, apart, parity) of the rarest tokens of each set; ``rest`` counts
    the set's tokens from this one on, unshared ones first, then by rarity; ``apart`` counts
    the unshared ones; ``parity`` has a bit for each of PARITY hash classes, set where the
    class holds an odd number of the set's shared tokens.

    If a link's first common token in this order is t, all common tokens are among both
    sets' tokens from t on; a link of sets of n and m tokens needs 4 / 9 (n + m) common ones
    and m >= 0.8 n. So a token with ``rest`` < 0.8 n is no link's first common token."""
    for token, fp, n, df in _buckets(batches, tokens=np.int64, fps=np.int64, ns=np.int64, dfs=np.int64):
        order = np.lexsort((token, df, fp))
        token, fp, n = token[order], fp[order], n[order]
        ends = np.append(np.flatnonzero(fp[1:] != fp[:-1]) + 1, len(fp)) if len(fp) else np.zeros(0, np.int64)
        size = np.diff(ends, prepend=0)
        group = np.repeat(np.arange(len(size)), size)
        bits = np.zeros((len(size), PARITY), np.uint8)
        np.bitwise_xor.at(bits, (group, (mix(token.view(np.uint64) ^ np.uint64(0x1B873593)) % np.uint64(PARITY)).astype(np.int64)), 1)
        parity = [row.tobytes() for row in np.packbits(bits, axis=1)]
        rest = ends[group] - np.arange(len(fp))
        keep = rest >= need(n)
        kept = group[keep]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[keep]) for x in (token, fp, n, rest, n - size[group])] + [pa.array([parity[g] for g in kept.tolist()], pa.binary())],
            ["token", "fp", "n", "rest", "apart", "parity"])


#: Cells up to this size are paired all at once, larger ones in blocks of rows.
SMALL_CELL = 48
#: Rows of a large cell that are paired at once, with so many of the rows after them.
BLOCK, ACROSS = 256, 1024
#: Hash classes of the parity bits.
PARITY = 512


def _pairs(batches):
    """(a, b) to compare, from rows sorted by token: the pairs of a cell whose regions differ
    and that may link if this is their first common token. A link's sets differ in (n + m) / 9
    tokens at most; unshared tokens differ, and so does a token for each parity class in which
    the sets disagree. Large cells are worked in blocks, and found pairs go out between them, so
    memory stays bounded however many sets a cell holds."""
    found: list[np.ndarray] = []
    for rows in _whole_cells(batches):
        token, fp, n, rest, apart, region = (rows[c].to_numpy() for c in ("token", "fp", "n", "rest", "apart", "region"))
        parity = np.frombuffer(b"".join(rows["parity"]), np.uint64).reshape(len(rows), -1)

        def add(i, j):
            ok = (region[i] != region[j]) & (9 * np.minimum(rest[i], rest[j]) >= 4 * (n[i] + n[j]))
            i, j = i[ok], j[ok]
            for s in range(0, len(i), 100_000):
                p, q = i[s:s + 100_000], j[s:s + 100_000]
                differ = np.bitwise_count(parity[p] ^ parity[q]).sum(1, dtype=np.int64) + apart[p] + apart[q]
                p, q = fp[p[9 * differ <= n[p] + n[q]]], fp[q[9 * differ <= n[p] + n[q]]]
                found.append(np.stack([np.minimum(p, q), np.maximum(p, q)], 1))

        starts = np.flatnonzero(np.diff(token, prepend=token[0] - 1))
        size = np.diff(np.append(starts, len(token)))
        mixed = np.minimum.reduceat(region, starts) != np.maximum.reduceat(region, starts)
        small = np.flatnonzero(np.repeat(mixed & (size <= SMALL_CELL), size))
        for k in range(1, SMALL_CELL):
            same = token[small[:-k]] == token[small[k:]]
            if not same.any():
                break
            add(small[:-k][same], small[k:][same])
        for s, e in zip(starts[mixed & (size > SMALL_CELL)].tolist(), (starts + size)[mixed & (size > SMALL_CELL)].tolist()):
            for i, k in ((i, k) for i in range(s, e, BLOCK) for k in range(i + 1, e, ACROSS)):
                p, q = np.meshgrid(np.arange(i, min(i + BLOCK, e)), np.arange(k, min(k + ACROSS, e)), indexing="ij")
                ahead = p < q
                add(p[ahead], q[ahead])
                if sum(map(len, found)) > 200_000:
                    yield _pair_batch(np.unique(np.concatenate(found), axis=0))
                    found.clear()
        if sum(map(len, found)) > 200_000:
            yield _pair_batch(np.unique(np.concatenate(found), axis=0))
            found.clear()
    if found:
        yield _pair_batch(np.unique(np.concatenate(found), axis=0))


def _pair_batch(pairs):
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, k])) for k in (0, 1)], ["a", "b"])


def _whole_cells(batches):
    """Frames of rows sorted by token that never cut a token's rows."""
    held = None
    for batch in batches:
        frame = batch.to_pandas()
        if held is not None:
            frame = pd.concat([held, frame], ignore_index=True)
        if not len(frame):
            continue
        cut = int(np.searchsorted(frame["token"].to_numpy(), frame["token"].iloc[-1]))
        held = frame.iloc[cut:]
        if cut:
            yield frame.iloc[:cut]
    if held is not None and len(held):
        yield held


def grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, n, fp, own) of every row of ``docs`` (doc_id, text), and (fp, least,
    root) of every set that is not empty; sets of one component have one root. Both are staged."""
    with small_batches(docs.sparkSession):
        return _grouped(docs)


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    every = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        _meta, "doc_id long, text_hash long, n long, fp long, own long")
    every = stage(every, "sets")
    nodes = every.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("own").alias("own"))

    # a first split: sets whose tokens are shared too little are alone
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = (nodes.agg(F.sum("own")).first()[0] or 0) // BUCKET_TOKENS + 1
    shared = (docs.mapInArrow(_low_tokens(buckets), "bucket long, tokens binary, fps binary, mine binary")
              .repartition(max(shuffles, buckets // 16), "bucket").sortWithinPartitions("bucket")
              .mapInArrow(_shared, "fp long, shared long").groupBy("fp").agg(F.sum("shared").alias("shared")))
    survivors = stage(nodes.join(shared, "fp", "left").where("coalesce(shared, 0) >= own - n div 5").select(
        "fp", "least", "n", F.expr("(own - coalesce(shared, 0)) / greatest(own, 1)").alias("apart")), "survivors")
    tokens = survivors.agg(F.sum("n")).first()[0]
    kind = "fp long, n long, tokens binary, least array<long>"
    # each set from a row with its least doc_id; a doc_id may have other texts too
    known = F.coalesce("doc_id", F.lit(NO_ID))
    ids = survivors.select(F.coalesce("least", F.lit(NO_ID)).alias("id_")).distinct()
    sets = docs.join(small_side(ids, BROADCAST_SETS), known == F.col("id_"), "left_semi").select("doc_id", "text").mapInArrow(_chosen, kind)
    sets = sets.join(small_side(survivors.select("fp"), BROADCAST_SETS), "fp", "left_semi").dropDuplicates(["fp"])
    sets = stage(sets, "chosen")

    # regions: exact distances to the pivots
    cells = sets.join(survivors.select("fp", "apart"), "fp").select("fp", "apart", F.posexplode(sets["least"]).alias("j", "token"))
    pivots = cells.groupBy("j", "token").agg(F.min_by("fp", F.struct("apart", "fp")).alias("b"), F.count("*").alias("c")).where("c > 1")
    near = cells.join(pivots, ["j", "token"]).where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    near = stage(measure(near, sets).distinct(), "near")
    links = near.where(linked()).select("a", "b")
    regions = stage(connected_components(links), "regions")

    # boundary: cells of the rarest shared tokens, other regions only
    buckets = (tokens or 0) // BUCKET_TOKENS + 1
    parts = max(shuffles, buckets // 16)
    prefix = (sets.select("fp", "n", "tokens").mapInArrow(_all_tokens(buckets), "bucket long, tokens binary, fps binary, ns binary")
              .repartition(parts, "bucket").sortWithinPartitions("bucket")
              .mapInArrow(_several(buckets), "bucket long, tokens binary, fps binary, ns binary, dfs binary")
              .repartition(parts, "bucket").sortWithinPartitions("bucket")
              .mapInArrow(_prefix, "token long, fp long, n long, rest long, apart long, parity binary"))
    prefix = prefix.join(regions.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "token", "fp", "n", "rest", "apart", "parity", F.coalesce("root", "fp").alias("region"))
    pairs = prefix.repartition(F.col("token")).sortWithinPartitions("token").mapInArrow(_pairs, "a long, b long").distinct()
    distance = near.groupBy("a").agg(F.map_from_entries(F.collect_list(
        F.struct("b", F.expr("1 - both / (na + nb - both)").alias("d")))).alias("da"))
    window = F.expr("da is null or db is null or forall(map_keys(da), p -> db[p] is null or abs(da[p] - db[p]) <= 0.2 + 1e-9)")
    pairs = (pairs.join(distance, "a", "left").join(distance.withColumnsRenamed({"a": "b", "da": "db"}), "b", "left")
             .where(window).select("a", "b"))
    links = stage(links.unionAll(measure(pairs, sets).where(linked()).select("a", "b")), "links")

    roots = connected_components(links).withColumnRenamed("node", "fp")
    named = stage(nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "named")
    return every, named


def join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of ``docs`` (doc_id, text), one row per row."""
    every, named = grouped(docs)
    best = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(best, "root").select("fp", "component_id")
    some = every.where("n > 0").join(named, "fp").select("doc_id", "n", "component_id")
    none = every.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return some.unionAll(none).withColumnRenamed("n", "n_shingles")
