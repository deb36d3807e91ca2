"""Jaccard join, personal data, source mixing: brute force, edge cases."""

import random
import re
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldcat.llm import jaccard_join, mixing, pii, support

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOCS = "doc_id long, text string, lang string, source string, n long, fp long, row long, key long"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", s, 1, 2, 3, 4) for i, t, s in rows], DOCS)


def corpus(rng):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5)))
    rows, texts = [], []
    for i in range(60):
        texts.append(" ".join(word() for _ in range(rng.choice([3, 6, 40, 120]))))
    passage = " ".join(word() for _ in range(60))
    for i in range(240):
        t = rng.choice(texts).split(" ")
        for _ in range(rng.choice([0, 0, 1, 2, 3, 8])):
            t[rng.randrange(len(t))] = word()
        t = " ".join(t) if rng.random() < 0.8 else " ".join(t) + "\n" + passage
        rows.append((i, t.upper() if rng.random() < 0.1 else t, f"s{rng.randrange(4)}"))
    rows += [(1000, None, None), (1001, "", "s1"), (1002, " \t\n", "s1"), (1003, "one two", "s0"), (1004, "One  TWO", "s0"),
             (1005, " ".join(word() for _ in range(20_000)), "s2"), (5, rows[5][1], "s0")]
    return rows


def components(rows):
    sets = []
    for _, t, _ in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)})
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted((r[0], len(s), least[find(i)]) for i, (r, s) in enumerate(zip(rows, sets)))


def test_join_equals_brute_force(spark, monkeypatch):
    rows = corpus(random.Random(3))
    monkeypatch.setattr(jaccard_join, "BUCKET_TOKENS", 500)
    monkeypatch.setattr(jaccard_join, "SMALL_CELL", 4)
    got = sorted(tuple(r) for r in jaccard_join.join(frame(spark, rows)).collect())
    assert got == components(rows)
    monkeypatch.setattr(jaccard_join, "BROADCAST_SETS", 0)  # the way without a broadcast
    assert sorted(tuple(r) for r in jaccard_join.join(frame(spark, rows)).collect()) == got


def test_join_of_an_empty_table(spark):
    assert jaccard_join.join(frame(spark, [])).collect() == []


def test_join_keeps_a_null_id(spark):
    got = jaccard_join.join(frame(spark, [(None, "a b c d e f", "s"), (7, "a b c d e f", "s")])).collect()
    assert sorted((r.doc_id is None, r.component_id) for r in got) == [(False, 7), (True, 7)]


PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in pattern.finditer(text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits[::-1]))
                if not 16 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(1)
    parts = ["a.b@c-d.ef", "@", "x@y", "a@b.c@d.e", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111111111111112",
             "+1 (269) 555-3298", "+12", "+", " ", "-", ".", "7", "\n", "é", "\U0001f600", "%x+y@h.io.", "00000001.2.3.04"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("1" * 200_000) == [] and pii.base_spans("a" * 200_000 + "@") == []


def test_gradient_of_the_network():
    rng = np.random.default_rng(0)
    model = {k: v.astype(float) for k, v in pii.new_model(1).items()}
    x, y = rng.integers(0, pii.NONE + 1, (6, 3)), rng.integers(0, pii.TAGS, (6, 3))
    _, grad = pii.loss_and_gradient(model, x, y)
    for k in model:
        at = tuple(rng.integers(0, s) for s in model[k].shape)
        if k.startswith("in_"):
            at = (int(x[2, 1]), at[1])
        old, sides = model[k][at], []
        for step in (1e-5, -1e-5):
            model[k][at] = old + step
            sides.append(pii.loss_and_gradient(model, x, y)[0])
        model[k][at] = old
        assert (sides[0] - sides[1]) / 2e-5 == pytest.approx(grad[k][at], abs=1e-6)


def test_network_finds_held_out_spans_and_leaves_clean_text(spark):
    rng = random.Random(5)
    words = "the form was sent to him and her on that day in spring with much love from all of them".split()

    def text(kind):
        w = [rng.choice(words) for _ in range(30)]
        span = {0: f"{rng.choice(words)}.{rng.randint(10, 99)}@mail{rng.randint(0, 9)}.example.com",
                1: ".".join(str(rng.randint(0, 255)) for _ in range(4)), 3: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}",
                2: "4111 1111 1111 1111", 4: str(rng.randint(1, 99))}[kind]
        w[rng.randrange(30)] = span
        return " ".join(w)

    train = frame(spark, [(i, text(i % 5), "s") for i in range(400)])
    model = pii.fit(train)
    hit = total = 0
    for i in range(200):
        t = text(i % 4)
        code = pii.encode(t)
        found = []
        for lo in pii._evident(code):
            x = np.full((pii.WINDOW, 1), pii.NONE)
            part = code[lo:lo + pii.WINDOW]
            x[:len(part), 0] = part
            found += pii._spans_of(pii.decode(model, x)[:, 0], lo, len(part))
        base = pii.base_spans(t)
        total += len(base)
        hit += len(set(base) & set(pii.reconcile(t, found, [])))
    assert hit >= 0.8 * total
    rows = [(1, None, "s"), (2, "", "s"), (3, " ".join(words) * 50, "s"), (4, "mail a.b@c.de now", "s"), (4, "mail a.b@c.de now", "s"), (None, "1.2.3.4", "s")]
    got = pii.find(frame(spark, rows), model).orderBy("doc_id", "spans").collect()
    assert [(r.doc_id, r.spans) for r in got] == [(None, "ip:0:7"), (1, ""), (2, ""), (3, ""), (4, "email:5:13"), (4, "email:5:13")]
    red = {r.doc_id: r.text for r in pii.redact(frame(spark, rows), model).collect()}
    assert red[4] == "mail <EMAIL> now" and red[None] == "<IP>" and red[1] is None and red[3] == rows[2][1]


def test_no_labelled_spans_train_nothing(spark):
    empty = frame(spark, [])
    assert pii.fit(empty) is None and pii.find(empty, None).collect() == []
    assert [r.spans for r in pii.find(frame(spark, [(1, "12 monkeys", "s")]), None).collect()] == [""]


def test_reconcile_joins_windows_and_keeps_base():
    text = "call 555-123-4567 or a@b.cd"
    assert pii.reconcile(text, [(3, 5, 13), (3, 11, 17)], [(0, 21, 27)]) == [(0, 21, 27), (3, 5, 17)]
    assert pii.reconcile(text, [(0, 21, 27), (3, 9, 17)], [(0, 21, 27)]) == [(0, 21, 27)]  # "-123-4567" has too few digits


def plain_targets(sizes, share=1.5, most=2.0):
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, total, got = set(names), share * sum(sizes.values()), {}
    while left:
        rate = total / sum(weight[s] for s in left)
        full = {s for s in left if weight[s] * rate >= most * sizes[s]}
        if not full:
            return got | {s: weight[s] * rate for s in left}
        for s in full:
            got[s] = most * sizes[s]
            total -= got[s]
        left -= full
    return got


def test_mix_cuts_at_exact_budgets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 16)
    rng = random.Random(2)
    rows = [(i, " ".join("w" * rng.randint(1, 9) for _ in range(rng.choice([0, 1, 5, 30]))), rng.choice(["a", "a", "a", "b", "é", "B", None]))
            for i in range(400)]
    rows += [(400, None, "a"), (401, "x " * 3000, "b"), (7, rows[7][1], rows[7][2]), (None, "p q", "c")]
    first = mixing.mix(frame(spark, rows)).collect()
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(WORD.findall(t or ""))
    want = plain_targets(size)
    for s in size:
        own = [r for r in first if r.source == s]
        assert {r.source_size for r in own} == {size[s]}
        assert all(r.target == pytest.approx(want[s]) for r in own)
        assert sum(r.taken for r in own) == int(want[s] + 1e-9)
        assert all(0 <= r.taken <= 2 * r.size for r in own)
    again = mixing.mix(frame(spark, rows[::-1]).repartition(5)).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, first)) == sorted(map(key, again))
    made = mixing.materialise(frame(spark, rows))
    assert made.columns == frame(spark, rows).columns
    assert made.select(F.sum(mixing.size_of(F.col("text")))).first()[0] == sum(r.taken for r in first)


def test_mix_of_nothing(spark):
    assert mixing.mix(frame(spark, [])).collect() == [] and mixing.materialise(frame(spark, [])).collect() == []
    got = mixing.mix(frame(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert sorted((r.size, r.taken, r.target) for r in got) == [(0, 0, 0.0), (0, 0, 0.0)]


def test_texts_of_null_ids_link_with_any_number_of_survivors(spark, monkeypatch):
    text = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(3)]
    rows = [(None, text[0] + " end", "s"), (None, text[0] + " end", "s"), (7, text[0], "s"), (8, text[1], "s"), (None, text[1], "s"),
            (None, text[2], "s"), (None, text[2] + " end", "s"), (8, text[2] + " stop end", "s"), (9, "a b c d e f", "s"), (9, "a b c d e f", "s")]
    want = [(7, 57, None), (7, 57, None), (7, 56, 7), (8, 56, 8), (8, 56, None), (8, 56, None), (8, 57, None), (8, 58, 8), (9, 2, 9), (9, 2, 9)]
    for most in (2_000_000, 0):
        monkeypatch.setattr(jaccard_join, "BROADCAST_SETS", most)
        got = [(r.component_id, r.n_shingles, r.doc_id) for r in jaccard_join.join(frame(spark, rows)).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_arrow_memory_is_given_back_between_batches(monkeypatch):
    given = []
    monkeypatch.setattr(support.pa, "default_memory_pool", lambda: SimpleNamespace(release_unused=lambda: given.append(1)))
    batch = pa.RecordBatch.from_arrays([pa.array(["a b", None, "c"])], ["text"])
    pieces = support.text_pieces(batch, most=1)
    assert next(pieces).num_rows and given == [1]
    list(pieces)
    assert given == [1, 1]


def test_pairs_of_a_large_cell_go_out_in_blocks():
    n = 1500
    cell = pa.RecordBatch.from_pandas(pd.DataFrame({
        "token": 7, "fp": np.arange(n), "n": 100, "rest": 100, "apart": 0, "parity": [b"\0" * (jaccard_join.PARITY // 8)] * n, "region": np.arange(n)}))
    sizes = [len(b) for b in jaccard_join._pairs([cell])]
    assert sum(sizes) == n * (n - 1) // 2 and max(sizes) <= 200_000 + 256 * n


def test_near_duplicates_hand_over_small_batches(spark, monkeypatch):
    name, jobs, staged = "spark.sql.execution.arrow.maxBytesPerBatch", [], jaccard_join.stage
    before = spark.conf.get(name)
    monkeypatch.setattr(jaccard_join, "stage", lambda df, what: jobs.append(int(spark.conf.get(name))) or staged(df, what))
    text = "a b c d e f g h"
    got = jaccard_join.join(frame(spark, [(1, text, "s"), (2, text, "s"), (3, "x y z", "s")]))
    assert jobs and set(jobs) == {support.BATCH_BYTES} and spark.conf.get(name) == before
    assert sorted(tuple(r) for r in got.collect()) == [(1, 4, 1), (2, 4, 1), (3, 1, 3)]
    # a failed job gives the old limit back too
    with pytest.raises(ValueError), support.small_batches(spark):
        raise ValueError
    assert spark.conf.get(name) == before


def test_tokens_of_many_small_batches_are_dealt_together_and_repeats_once():
    rng = np.random.default_rng(5)
    texts = [" ".join(map(str, rng.integers(0, 1000, 60))) for _ in range(200)]
    batches = [pa.RecordBatch.from_pydict({"doc_id": [i, i], "text": [t, None], "text_hash": [i, i]}) for i, t in enumerate(texts + texts)]
    rows = [r for b in jaccard_join._low_tokens(8)(iter(batches)) for r in b.to_pylist()]
    assert sorted(r["bucket"] for r in rows) == list(range(8))  # not a row for each batch and bucket
    got = sorted((t, f, m) for r in rows for t, f, m in zip(
        np.frombuffer(r["tokens"], np.uint64).tolist(), np.frombuffer(r["fps"], np.int64).tolist(), list(r["mine"])))
    want = []
    for _, values, off, n, fp in jaccard_join._sets(iter([pa.RecordBatch.from_pydict({"doc_id": list(range(200)), "text": texts})])):
        for i in range(len(n)):
            own = values[off[i]:off[i + 1]]
            own = own[jaccard_join._below(own, jaccard_join.level(n[i]))]
            want += zip(own.tolist(), [int(fp[i])] * len(own), jaccard_join._below(own, jaccard_join.level(1.25 * n[i])).astype(int).tolist())
    assert got == sorted(want)


def test_sets_and_large_cells_are_worked_in_small_blocks():
    words = " ".join(str(i) for i in range(20_000))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(30)), "text": [words] * 30, "text_hash": [0] * 30})
    sizes = [len(n) for _, _, _, n, _ in jaccard_join._sets([batch])]
    assert sum(sizes) == 30 and max(sizes) * len(words) <= jaccard_join.SET_BYTES + len(words)
    n = 6000
    cell = pa.RecordBatch.from_pandas(pd.DataFrame({
        "token": 7, "fp": np.arange(n), "n": 100, "rest": [100 if i % 1500 == 0 else 0 for i in range(n)], "apart": 0,
        "parity": [b"\0" * (jaccard_join.PARITY // 8)] * n, "region": np.arange(n)}))
    tracemalloc.start()
    pairs = [(r["a"], r["b"]) for b in jaccard_join._pairs([cell]) for r in b.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(pairs) == [(0, 1500), (0, 3000), (0, 4500), (1500, 3000), (1500, 4500), (3000, 4500)]
    assert peak < 25_000_000
