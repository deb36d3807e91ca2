"""Packing, quality rules, url filters, licenses, quotations, embeddings, scoring, pipeline."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldcat.llm import licenses, packing, pseudo_likelihood, quality, quotes, url_filter, vector_graph
from fieldcat.llm.queries import tokenizer_path
from fieldcat.llm.shingles import hash_strings, word_codes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, shard long, words_ string, row long, length long"


def docs(spark, rows):
    """(doc_id, text[, lang, source]) with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, *("en", "s")[len(r) - 2:], 1, "w", 3, 4) for r in rows], DOCS)


def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t


ODD = ["", " ", "a  b", " a\n b", "x \n y", "tab\t c", "it's  ok", "end ", "\n\n a", "é à <|endoftext|> b", "a\u00a0 b\u2003c", "z\x1c b", "a\u0085 b", "\U0001f600 \U0001f600"]


def test_pieces_are_the_tokenizers_ids(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(90, None), (91, "word salad " * 3000), (1, " ")]
    got = collections.defaultdict(list)
    for r in packing.pieces(docs(spark, rows), tokenizer_path(), most=64).collect():
        got[r.doc_id].append(r)
    for i, t in rows[:-1]:
        ids = np.array(tokenizer().encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        own = sorted(got[i], key=lambda r: r.piece)
        own = own[::2] if i == 1 else own  # given twice
        assert b"".join(bytes(r.ids) for r in own) == ids.tobytes()
        assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1]] and [r.piece for r in own] == list(range(len(own)))
        assert all(r.length == 64 for r in own[1:])
    assert len(got[1]) == 2


def test_sum_of_squares_places_where_the_sum_is_least():
    rng = random.Random(4)
    lengths = np.array([rng.randint(1, 20) for _ in range(300)])
    sequence, offset = packing.place(lengths, 20)
    gaps = {}
    for n, s, o in zip(lengths.tolist(), sequence.tolist(), offset.tolist()):
        count = collections.Counter(gaps.values())
        total = lambda c: sum(v * v for g, v in c.items() if g)
        choices = {g: total(count - collections.Counter([g]) + collections.Counter([g - n])) for g in count if g >= n}
        if s in gaps:
            assert choices[gaps[s]] == min(choices.values()) and o == 20 - gaps[s]
        else:
            assert not choices and o == 0
        gaps[s] = gaps.get(s, 20) - n
    assert min(gaps.values()) >= 0


def test_packed_sequences_are_gapless_and_few(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 200)
    rng = random.Random(9)
    rows = [(i, "w " * rng.randint(0, 90)) for i in range(700)] + [(3, None), (None, "x"), (None, "x")]
    got = packing.pack(packing.pieces(docs(spark, rows), tokenizer_path(), most=64).withColumn("crc", F.crc32("ids")).drop("ids"), most=64).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 64
    assert len(by) <= 1.06 * math.ceil(sum(r.length for r in got) / 64)
    whole = packing.sequences(docs(spark, rows), tokenizer_path(), most=64).collect()
    assert sum(len(r.ids) for r in whole) == 4 * sum(r.length for r in got)
    assert packing.pack(packing.pieces(docs(spark, []), tokenizer_path())).collect() == []


def plain_counts(t):
    w = WORD.findall(t or "")
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    grams = [tuple(w[j:j + 3]) for j in range(len(w) - 2)]
    seen, cover = collections.Counter(grams), set()
    for j, g in enumerate(grams):
        if seen[g] > 1:
            cover |= {j, j + 1, j + 2}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(cover)


def test_rules_count_exactly_and_judge_by_group_fences(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7)))
    clean = [" ".join(word() for _ in range(rng.randint(60, 90))) for _ in range(200)]
    rows = [(i, t, "en", rng.choice(["a", "b", None])) for i, t in enumerate(clean)]
    bad = ["### " * 20 + clean[0], ("same line of words here\n") * 40, clean[1].upper(), "a b " * 60, "tiny", "", None, " \t\x0b\n", "x" * 4000 + " " + clean[2]]
    rows += [(1000 + i, t, "en", "a") for i, t in enumerate(bad)] + [(5, *rows[5][1:]), (2000, " ".join(word() for _ in range(30_000)), None, "a")]
    rows += [(3000, "a b\r\nc\n a b\n\na b\n", "en", "a"), (3001, "é é é é #é", "en", "a")]
    got = collections.defaultdict(list)
    for r in quality.judge(docs(spark, rows), "doc_id").collect():
        got[r.doc_id].append(r)
    for i, t, *_ in rows:
        for r in got[i]:
            n = plain_counts(t)
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
            assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
    assert all(r.kept for i in range(200) for r in got[i]) and len(got[5]) == 2 and got[2000][0].kept
    assert not any(r.kept for i in range(len(bad)) for r in got[1000 + i])
    assert quality.judge(docs(spark, []), "doc_id").collect() == []


def test_sketch_quantiles_have_small_relative_error_and_merge(spark):
    values = sorted(random.Random(1).randint(0, 5_000_000) for _ in range(4000))
    rows = spark.createDataFrame([(v,) for v in values], "value long").select("value", F.expr(quality.bin_of("value")).alias("bin"))
    assert all(r.bin <= r.value and r.value - r.bin <= r.value / 1024 and (r.value >= 2048 or r.bin == r.value) for r in rows.collect())
    one = rows.groupBy("bin").count()
    two = rows.where("value % 2 = 0").groupBy("bin").count().unionAll(rows.where("value % 2 = 1").groupBy("bin").count()).groupBy("bin").agg(F.sum("count"))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_urls_take_the_decisions_of_their_aliases(spark):
    rows = [(1, "http://A.Example.org/es/1", '<link href="http://free.net/x#y" rel="canonical">'), (2, "http://free.net/x", ""),
            (3, "http://other.net/q?a#b", '<meta http-equiv="refresh" content="0; url=http://free.net/x">'),
            (4, "http://z.com/fr/1", "<link rel=canonical href=/de/2>"), (5, "http://z.com/de/2", None), (6, None, None), (7, "nohost", ""),
            (8, "http://k.net/de/", ""), (9, "https://x.example.org/en/12", ""), (9, "https://x.example.org/en/12", ""),
            (10, "http://m.net/a", "<link rel='canonical' href='http://n.com/fr/z'><meta http-equiv=refresh content='1;url=http://n.com/de/z'>"),
            (11, "http://p.net/a/b", '<link rel="canonical" href="c">'), (12, "http://p.net/a/c?", "x" * 100_000), (13, "u://org", ""), (14, "http://q.org/?x", "")]
    table = spark.createDataFrame([(*r, 1, "n", "a") for r in rows], "page_id long, url string, html string, node long, host string, alias string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(table).collect()}
    assert got == {
        1: ("a.example.org", "/es/1", "example.org/es/", "block"), 2: ("free.net", "/x", None, "block"), 3: ("other.net", "/q", None, "block"),
        4: ("z.com", "/fr/1", "com/fr/", "allow"), 5: ("z.com", "/de/2", "com/de/", "block"), 6: ("", "", None, "allow"), 7: ("", "", None, "allow"),
        8: ("k.net", "/de/", None, "allow"), 9: ("x.example.org", "/en/12", "example.org/en/1", "block"), 10: ("m.net", "/a", None, "allow"),
        11: ("p.net", "/a/b", None, "allow"), 12: ("p.net", "/a/c", None, "allow"), 13: ("org", "", None, "allow"), 14: ("q.org", "/", "org/", "allow")}
    assert url_filter.judge(table).count() == len(rows) and url_filter.judge(table.limit(0)).collect() == []


def test_long_redirect_chains_are_one_group(spark):
    rows = [(i, f"http://h{i}.net/", f'<link rel="canonical" href="http://h{i + 1}.net/">') for i in range(40)] + [(40, "http://h40.net/", '<link rel="canonical" href="http://w.com/de/x">')]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.verdict for r in got} == {"block"} and len(got) == 41


def test_licenses_are_found_wherever_they_stand(spark):
    rng = random.Random(8)
    filler = lambda n: " ".join("".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(n))
    names = list(licenses.TEMPLATES)
    rows = [(i, f"{filler(rng.randint(0, 200))}\n{licenses.TEMPLATES[names[i % len(names)]].upper()} {filler(rng.randint(0, 50))}") for i in range(120)]
    rows += [(500, filler(300)), (501, None), (502, ""), (503, "Licensed under the"), (504, filler(20_000) + " " + licenses.TEMPLATES["MIT"]), (0, rows[0][1])]
    got = collections.defaultdict(set)
    for r in licenses.scan(docs(spark, rows)).collect():
        got[r.doc_id].add(r.template)
    for i in range(120):
        assert names[i % len(names)] in got[i], names[i % len(names)]
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    for i, t in rows:
        w = words(t or "")
        grams = {tuple(w[j:j + 3]) for j in range(len(w) - 2)}
        for name in got.get(i, ()):
            own = words(licenses.TEMPLATES[name])
            own = {tuple(own[j:j + 3]) for j in range(len(own) - 2)}
            assert len(own & grams) >= 0.8 * len(own)
    assert got[504] == {"MIT"} and not any(i in got for i in (500, 501, 502, 503))
    assert licenses.scan(docs(spark, [])).collect() == []


def test_quotations_link_and_order(spark):
    rows = [(1, 0, "u", "Hello there my friend.\n\nSecond paragraph here."), (1, 1, "a", "> Hello there my friend.\n\nI answer this.\n> second PARAGRAPH here.\nmore"),
            (1, 2, "u", ">> hello there my friend\n> I answer this.\nok then"), (1, 3, "u", "new topic"), (2, 0, "u", "> new topic\nhm"), (2, 1, None, None),
            (None, None, None, "> ok then"), (3, 0, "u", "q" * 50_000 + "\n" + "> deep\n" * 500), (1, 3, "u", "new topic"), (4, 0, "u", "> > \n>>>\nbody")]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, row long, hash long")
    got = collections.defaultdict(list)
    for r in quotes.link(table).collect():
        got[(r.conv_id, r.turn)].append((r.body if len(r.body) < 99 else "long", r.n_quotes, r.n_linked, r.reply_to, r.thread))
    assert got[(1, 1)] == [("I answer this.\nmore", 2, 2, 0, 0)] and got[(1, 2)] == [("ok then", 2, 2, 1, 0)]
    assert got[(1, 3)] == [("new topic", 0, 0, None, 3)] * 2 and got[(2, 0)] == [("hm", 1, 1, None, 0)]
    assert got[(2, 1)] == [("", 0, 0, None, 1)] and got[(None, None)] == [("", 1, 0, None, None)]
    assert got[(3, 0)] == [("long", 1, 0, None, 0)] and got[(4, 0)][0][0] == "body"
    assert quotes.link(table.limit(0)).collect() == []


def test_reply_chains_end_at_their_first_message(spark):
    rows = [(1, 0, "u", "message number 0")] + [(1, i, "u", f"> message number {i - 1}\nmessage number {i}") for i in range(1, 30)]
    got = quotes.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {r.thread for r in got} == {0} and all(r.reply_to == (r.turn - 1 if r.turn else None) for r in got)


def test_graph_finds_links_as_brute_force_does(spark, monkeypatch):
    monkeypatch.setattr(vector_graph, "SHARD", 90)
    monkeypatch.setattr(vector_graph, "CENTRES", 8)
    monkeypatch.setattr(vector_graph, "RECALL", 0.0)  # one pass
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(40, 16))
    x = np.concatenate([centre[rng.integers(0, 40, 240)] + 0.12 * rng.normal(size=(240, 16)), centre[0] + 0.05 * rng.normal(size=(120, 16)), rng.normal(size=(40, 16))])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, x[0].tolist()), (901, (2 * x[0]).tolist()), (902, None), (903, [0.0] * 16), (904, [float("nan")] * 16),
                                                           (905, [None] * 16), (906, [1.0, 2.0]), (907, [1.0, 2.0]), (908, []), (909, [float("inf")] * 16)]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, node long, cell long")
    got = {r.vec_id: r for r in vector_graph.near_duplicates(table).collect()}
    ids = [i for i, v in rows if i < 902]
    u = vector_graph.unit(np.array([v for i, v in rows if i < 902]))
    near = u @ u.T >= vector_graph.LINK
    true = near.sum(1) - 1
    found = np.array([got[i].n_links for i in ids])
    assert (found <= true).all() and found.sum() >= 0.9 * true.sum()
    assert got[900].component_id == 0 == got[901].component_id and not got[900].kept and got[0].kept
    assert [(got[i].n_links, got[i].component_id, got[i].kept) for i in (902, 903, 904, 905, 908, 909)] == [(0, i, True) for i in (902, 903, 904, 905, 908, 909)]
    assert (got[906].n_links, got[907].component_id, got[907].kept) == (1, 906, False) and len(got) == len(rows)
    assert vector_graph.near_duplicates(table.limit(0)).collect() == []


def test_pseudo_likelihood_learns_from_both_sides(spark):
    rng = random.Random(7)
    pairs = {"a": "b", "c": "d", "e": "f", "g": "h"}
    line = lambda: " ".join(x for k in (rng.choice(list(pairs)) for _ in range(30)) for x in (k, pairs[k]))
    rows = [(i, line()) for i in range(400)] + [(900, None), (901, ""), (902, "a"), (903, " ".join(rng.sample(line().split(), 60))), (1, line()), (None, line())]
    table = docs(spark, rows)
    vocabulary = pseudo_likelihood.vocabulary_of(table)
    assert len(vocabulary[0]) == 8
    held_out = docs(spark, [(1, line()), (2, "h g b e d a f c " * 8)])
    model = pseudo_likelihood.train(table, vocabulary)
    good, bad = pseudo_likelihood.score(held_out, vocabulary, model).orderBy("doc_id").collect()
    first = pseudo_likelihood.score(held_out, vocabulary, pseudo_likelihood.new_model()).orderBy("doc_id").first()
    assert good.mean_log_probability > bad.mean_log_probability + 0.3 and good.mean_log_probability > first.mean_log_probability + 3
    got = {r.doc_id: r for r in pseudo_likelihood.score(table, vocabulary, model).collect() if r.doc_id and r.doc_id >= 900}
    assert [(got[i].n_tokens, got[i].log_likelihood, got[i].mean_log_probability) for i in (900, 901)] == [(0, 0.0, None)] * 2 and got[902].log_likelihood < 0
    assert pseudo_likelihood.score_corpus(docs(spark, [])).collect() == []


def test_words_are_counted_by_dealt_buckets(monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "BUCKET_BITS", 3)
    rng = random.Random(5)
    texts = [None, "", " \n"] + [" ".join(rng.choice(["Ünï", "a,b", "X"]) + str(rng.randrange(40)) for _ in range(rng.randrange(60))) for _ in range(50)]
    dealt = pa.Table.from_batches([row for s in range(0, 53, 9) for row in pseudo_likelihood._count_words(
        [pa.RecordBatch.from_arrays([pa.array(texts[s:s + 9], pa.string())], ["text"])])])
    assert dealt.num_rows <= 6 * 8
    for size in (1, 3, 7, 1000):
        got = pa.Table.from_batches(pseudo_likelihood._sum_words(dealt.sort_by("bucket").combine_chunks().to_batches(max_chunksize=size)))
        assert dict(zip(got["spelling"].to_pylist(), got["n"].to_pylist())) == collections.Counter(w for x in texts for w in (x or "").replace("X", "x").split())
        assert got["word"].to_numpy().view(np.uint64).tolist() == hash_strings(got["spelling"].combine_chunks()).tolist()
        assert len(set(got["word"].to_pylist())) == got.num_rows
    assert list(pseudo_likelihood._sum_words([])) == []


def test_gradient_of_the_window_network():
    rng = np.random.default_rng(0)
    model = {k: v.astype(float) for k, v in pseudo_likelihood.new_model(1).items()}
    around, target = rng.integers(0, pseudo_likelihood.TOKENS + 1, (40, 4)), rng.integers(0, pseudo_likelihood.TOKENS, 40)
    grad = pseudo_likelihood.gradient(model, around, target)
    for k in model:
        at = tuple(rng.integers(0, s) for s in model[k].shape)
        at = (int(around[3, 1]), at[1]) if k == "embed" else (int(target[5] % pseudo_likelihood.CLASSES), *at[1:]) if k.startswith("word") else at
        old, sides = model[k][at], []
        for step in (1e-5, -1e-5):
            model[k][at] = old + step
            sides.append(-pseudo_likelihood.log_probabilities(model, around, target).mean())
        model[k][at] = old
        assert (sides[0] - sides[1]) / 2e-5 == pytest.approx(grad[k][at], abs=1e-6)


def test_pipeline_stages_do_what_the_operators_decide(spark):
    import corpus_pipeline

    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7)))
    texts = [" ".join(word() for _ in range(rng.randint(60, 90))) for _ in range(60)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)]
    rows += [(100 + i, texts[i], "en", "s0", 1) for i in range(10)] + [(200, "short", "en", "s0", 1), (201, None, None, None, None),
                                                                      (202, texts[11] + " mail a.b@c.de", "en", "s1", 1), (203, "# # " * 60, "en", "s0", 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.quality_rules(spark, table, "")
    assert kept.columns == corpus_pipeline.COLUMNS
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {200, 201, 203}
    single = corpus_pipeline.near_duplicates(spark, kept, "")
    assert sorted(r.doc_id for r in single.collect()) == list(range(60))
    clean = corpus_pipeline.personal_data(spark, table.where("doc_id = 202"), "").first()
    assert clean.text == texts[11] + " mail <EMAIL>" and clean.n_chars == len(clean.text)
    mixed = corpus_pipeline.mixing_sources(spark, single, "")
    assert mixed.columns == corpus_pipeline.COLUMNS
    packed = corpus_pipeline.best_fit_packing(spark, mixed, "")
    ids = {i: np.array(tokenizer().encode(t, add_special_tokens=False).ids + [0], "<u4") for i, t in enumerate(texts)}
    whole = [r for r in packed.collect() if r.length == len(ids[r.doc_id])]
    assert whole and all(r.ids_crc32 == zlib.crc32(ids[r.doc_id].tobytes()) for r in whole) and packed.count() == mixed.count()
    assert len(corpus_pipeline.STAGES) == 5


def test_every_word_has_its_own_probability(spark):
    common = " ".join(f"w{i}" for i in range(pseudo_likelihood.WORDS) for _ in range(6))
    rest = [f"r{i}" for i in range(3000)]  # seen five, two times or once
    rows = [(1, common), (2, " ".join(rest[:1000] * 5)), (3, " ".join(rest[1000:2000] * 2)), (4, " ".join(rest[2000:]))]
    vocabulary = pseudo_likelihood.vocabulary_of(docs(spark, rows))
    assert len(vocabulary.hashed) == pseudo_likelihood.WORDS and vocabulary.words.count() == 2000
    assert vocabulary.words.groupBy(F.expr(f"pmod(word, {pseudo_likelihood.RARE}) as g")).agg(F.sum(F.exp("logp")).alias("p")).where("p >= 1").count() == 0
    group = lambda w: int(word_codes(pa.array([w]))[0][0] % pseudo_likelihood.RARE)
    often = rest[0]
    twice, junk = (next(w for w in of if group(w) == group(often)) for of in (rest[1000:2000], (f"#zq{i}ézzzzzzzz" for i in range(9999))))
    unseen = next(w for w in (f"r{i}" for i in range(3000, 99999)) if group(w) == group(often))
    got = {r.doc_id: r.log_likelihood for r in pseudo_likelihood.score(
        docs(spark, list(enumerate([often, twice, unseen, junk]))), vocabulary, pseudo_likelihood.new_model()).collect()}
    assert got[0] > got[1] > got[2] > got[3] + 20  # one group, so all equal if scored as their group
    assert got[0] - got[1] == pytest.approx(math.log(5 / 2), abs=1e-5)


def test_every_position_is_a_target_once(spark, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in (1, 2, 3, 50, 400)]
    plain, targets = pseudo_likelihood.gradient, []
    monkeypatch.setattr(pseudo_likelihood, "gradient", lambda model, around, target: targets.append((around, target)) or plain(model, around, target))

    class held:
        value = ((np.zeros(0, np.uint64), np.zeros(0, np.int64)), pseudo_likelihood.flat(pseudo_likelihood.new_model()))

    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    seen = [row for turn in range(pseudo_likelihood.ROUNDS) for row in pseudo_likelihood._passes(held, turn)([batch])]
    ids, off = pseudo_likelihood.token_ids(pa.array(texts), held.value[0])
    around = pseudo_likelihood.contexts(*pseudo_likelihood.padded(ids, off))
    got = [(*a, t) for x, y in targets for a, t in zip(x.tolist(), y.tolist())]
    assert seen and sorted(got) == sorted((*a, t) for a, t in zip(around.tolist(), ids.tolist()))


def test_added_tokens_have_their_own_ids_in_query_and_pipeline(spark, tmp_path):
    import corpus_pipeline
    from fieldcat.llm.queries import op1_packing
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    rows = [(i, t) for i, t in enumerate([*ODD, "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x<|endoftext|>", "<|endoftext|", "a\n <|endoftext|>  b"])]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    for got in op1_packing(spark, str(tmp_path)), corpus_pipeline.best_fit_packing(spark, docs(spark, rows), ""):
        got = {r.doc_id: (r.start, r.length, r.ids_crc32) for r in got.collect()}
        ids = [np.array(plain.encode(t, add_special_tokens=False).ids + [0], "<u4") for _, t in rows]
        assert got == {i: (0, len(x), zlib.crc32(x.tobytes())) for i, x in enumerate(ids)}


def test_pipeline_keeps_one_row_of_each_group(spark):
    import corpus_pipeline

    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(80)) for _ in range(7)]
    rows = [(1, texts[0]), (1, texts[0]), (1, texts[0]),  # given twice
            (2, texts[1]), (None, texts[1]), (None, texts[1] + " end"),  # copies without an id
            (3, texts[2]), (4, texts[2] + " end"), (4, texts[3]),  # an id of a copy and of a clean document
            (None, texts[4]), (None, texts[4]), (None, texts[5]),  # no ids at all
            (6, texts[6]), (6, texts[6] + " end"), (7, ""), (8, None)]
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text if r.text != texts[6] + " end" else texts[6]) for r in corpus_pipeline.near_duplicates(spark, table, "").collect()]
    want = [(1, texts[0]), (2, texts[1]), (3, texts[2]), (4, texts[3]), (None, texts[4]), (None, texts[5]), (6, texts[6]), (7, ""), (8, None)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_partial_quotations_link(spark):
    rows = [(1, 0, "u", "First part.\n\nSecond part.\n\nThird part."), (1, 1, "a", "> First part.\n>\n> Second part.\nyes"),  # two of three paragraphs
            (2, 0, "u", "line one\nline two\nline three\nline four"), (2, 1, "u", "line two"), (2, 2, "a", "> line one\n> line two\n> line four\n> not there\nno"),  # lines; most units decide
            (3, 0, "u", "zero"), (3, 1, "u", "> zero\nalpha\nbeta\n> zero\ngamma\ndelta"), (3, 2, "a", "> gamma\n> delta"),  # a run between quotes
            (4, 0, "u", "> said before\nhm"), (4, 1, "u", "said before"), (5, 0, "u", "said before"),  # own later repeat, original elsewhere
            (6, 0, "u", "> nobody\n> wrote this")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.n_quotes, r.n_linked, r.reply_to, r.thread) for r in quotes.link(table).collect()}
    assert got[(1, 1)] == (1, 1, 0, 0) and got[(2, 2)] == (1, 1, 0, 0)
    assert got[(3, 1)] == (2, 2, 0, 0) and got[(3, 2)] == (1, 1, 1, 0)
    assert got[(4, 0)] == (1, 1, None, 0) and got[(6, 0)] == (1, 0, None, 0)


def test_graph_is_exact_where_rounds_fail_the_audit(spark, monkeypatch):
    monkeypatch.setattr(vector_graph, "SHARD", 60)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(80, 12))
    x = np.concatenate([x, x[::4] + 0.08 * rng.normal(size=(20, 12))])
    plain, rounds = vector_graph.links, []

    def blind(nodes, link, copies, levels=1):  # rounds that find nothing
        rounds.append(levels)
        return spark.createDataFrame([], "node long, links long, root long") if levels else plain(nodes, link, copies, 0)

    monkeypatch.setattr(vector_graph, "links", blind)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in vector_graph.near_duplicates(table).collect()}
    u = vector_graph.unit(x)
    assert [got[i] for i in range(100)] == ((u @ u.T >= vector_graph.LINK).sum(1) - 1).tolist() and rounds == [1, 1, 1, 0]


def test_sweep_completes_what_a_walk_missed():
    x = vector_graph.unit(np.concatenate([np.eye(6), np.eye(6) + 0.1]))
    n = len(x)
    near = np.flatnonzero(((x @ x.T >= 0.9) & ~np.eye(n, dtype=bool)).ravel())
    assert len(near) and vector_graph.swept(x, near[:0], 0.9).tolist() == near.tolist() == vector_graph.swept(x, near[::2], 0.9).tolist()


def test_rows_that_are_alike_are_spread_over_shards(spark):
    from pyspark.sql import functions as F

    rows = spark.range(50_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
                                      F.lit(700).cast("long").alias("length"))
    got = packing.pack(rows).select((F.col("sequence_id") / 2**32).cast("long").alias("shard"), "sequence_id", "offset")
    sizes = {r.shard: r["count"] for r in got.groupBy("shard").count().collect()}
    assert len(sizes) == 50_000 // packing.SHARD_ROWS + 1 and max(sizes.values()) < 1.2 * packing.SHARD_ROWS
    filled = got.groupBy("sequence_id").agg(F.sort_array(F.collect_list("offset")).alias("at"))
    assert filled.where("at <> array(0L, 700L)").count() <= len(sizes)


def test_references_resolve_as_urls_do(spark):
    from urllib.parse import urldefrag, urljoin

    from pyspark.sql import functions as F

    bases = ["http://a.net/b/c/d?q=1#f", "http://a.net", "http://a.net/", "https://a.net/b", "http://a.net/b/c/?x=/y/z"]
    links = ["g", "./g", "g/", "/g", "//g.net/h", "?y=2", "g?y", "#s", "g#s", "../g", "..", ".", "./", "../", "../../g", "../../../../g", "/./g", "/../g", "g.", "..g",
             "./g/.", "g/./h", "g/../h", "g?y/../x", "g#s/../x", "http://h.net/x?u=1", "/r?u=http://h.net/", "r;x=1", "../r?u=http://h.net/../z"]
    rows = spark.createDataFrame([(b, t) for b in bases for t in links], "base string, target string")
    for r in rows.withColumn("to", url_filter.resolved(F.col("target"), F.col("base"))).collect():
        assert r.to == urldefrag(urljoin(r.base, r.target)).url, (r.base, r.target)
    assert rows.select(url_filter.resolved(F.lit("mailto:x@y.net?u=http://h.net/"), F.col("base"))).distinct().collect() == [(None,)]


def test_every_link_of_a_page_counts_as_in_the_sql(spark):
    import duckdb

    from fieldcat.llm import oracle

    canonical, refresh = '<link rel="canonical" href="{}">'.format, "<meta http-equiv=refresh content='0;url={}'>".format
    rows = [(1, "http://a.net/x/y", canonical("http://b.net/") + canonical("http://w.com/de/1")), (2, "http://b.net/", ""),  # the second canonical link
            (3, "http://c.net/p/q", refresh("../r?a=1&amp;b=2") + refresh("?z=1#f")), (4, "http://c.net/r?a=1&b=2", canonical("http://w.com/de/2")), (5, "http://c.net/p/q?z=1", None),
            (6, "http://d.net/p", canonical("/go?u=http://w.com/de/3")), (7, "http://e.net/p/./q", canonical("./../s/./t")), (8, "http://e.net/s/t", canonical("http://w.com/de/4")),
            (9, "http://f.net/", canonical("http://w.com/de/5") + "x" * 200_000 + refresh("http://z.org/")), (10, "http://g.net/", canonical("") + refresh("javascript:go('http://w.com/de/6')")),
            (11, None, canonical("http://w.com/de/7")), (12, "", None), (13, "http://h.net", canonical("k")), (13, "http://h.net/k", canonical("HTTP://W.com/de/8"))]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    names = ["page_id", "host", "path", "rule", "verdict"]
    got = sorted(map(repr, (tuple(r[n] for n in names) for r in url_filter.judge(table).collect())))
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    sql = f"SELECT {', '.join(names)} FROM ({oracle.URL_FILTER})"
    assert got == sorted(map(repr, con.execute(sql).fetchall()))
    verdicts = {r.page_id: r.verdict for r in url_filter.judge(table).collect()}
    assert {i for i, v in verdicts.items() if v == "block"} == {1, 2, 3, 4, 5, 7, 8, 13}


@pytest.mark.parametrize("seed", [1, 2])
def test_links_come_from_the_graph(seed):
    rng = np.random.default_rng(seed)
    few = rng.normal(size=(300, 24))
    x = vector_graph.unit(np.concatenate([few, few + 0.1 * rng.normal(size=few.shape), few[:100] + 0.15 * rng.normal(size=(100, 24)), rng.normal(size=24) + 0.1 * rng.normal(size=(400, 24))]))
    true = x @ x.T >= vector_graph.LINK
    np.fill_diagonal(true, False)
    edges = vector_graph.edges_of(x)
    found = vector_graph.search(x, edges, vector_graph.LINK)
    assert not (found & ~true).any() and (found == found.T).all() and found.sum() >= 0.98 * true.sum()
    single = true[:700, :700].sum()
    assert found[:700, :700].sum() >= 0.98 * single
    # without edges nothing but a node's nearness to the medoid is left
    assert vector_graph.search(x, np.full_like(edges, -1), vector_graph.LINK).sum() < 0.05 * true.sum()


def test_a_pair_is_counted_by_its_first_shard(spark):
    import pandas as pd

    rng = np.random.default_rng(4)
    x = vector_graph.unit(rng.normal(size=20) + 0.05 * rng.normal(size=(6, 20)))
    shard = {c: pd.DataFrame({"node": range(6), "copies": [1, 1, 1, 1, 1, 3], "cell": c, "a": 0, "b": 0, "own": 0, "cells": [np.array(k) for k in ([5, 9],) * 3 + ([9],) * 3],
                              "near": [np.array([j for j in range(6) if j != i]) for i in range(6)], "vector": list(x)}) for c in (5, 9)}
    shard[5] = shard[5].iloc[:3]
    for exact in (False, True):
        run = vector_graph._shard_links(vector_graph.LINK, exact)
        first, second = run(shard[5]), run(shard[9])
        assert first["links"].tolist() == [2, 2, 2] and second["links"].tolist() == [5, 5, 5, 7, 7, 5] and second["root"].tolist() == [0] * 6


def test_later_rounds_read_the_token_ids_of_the_first():
    rng = random.Random(4)
    texts = ["", None, "é", *(" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in (1, 2, 300, 5000))]

    class held:
        value = ((np.zeros(0, np.uint64), np.zeros(0, np.int64)), pseudo_likelihood.flat(pseudo_likelihood.new_model()))

    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    kept = [b for b in pseudo_likelihood._passes(held, 0, keep=True)([batch.slice(0, 3), batch.slice(3)])]
    ids = pa.concat_arrays([b.column("ids") for b in kept]).drop_null()
    assert len(ids) == len(texts) and [len(x) // 2 for x in ids.to_pylist()] == [len((t or "").split()) for t in texts]
    plain, = pseudo_likelihood._passes(held, 1)([batch])
    again, = pseudo_likelihood._passes(held, 1)([pa.RecordBatch.from_arrays([ids], ["ids"])])
    assert plain.equals(again)
