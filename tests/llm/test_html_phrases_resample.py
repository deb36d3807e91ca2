"""Main text, collocations and importance resampling against plain versions."""

import collections
import hashlib
import html
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF_SMALL
from fieldcat.llm import importance, main_text, phrases
from fieldcat.llm.queries import QUERIES

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- main text

def plain_article(page):
    """The blocks of a page whose article is one ``article`` element without other parts."""
    inner = re.search(r"<article>(.*?)</article>", page or "", re.S)
    blocks = re.split(r"</?(?:p|h1)>", inner.group(1).replace("<br>", " ")) if inner else []
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_given_pages_equal_their_articles(spark):
    got = {r.page_id: r for r in QUERIES["op11_main_text"](spark, SF_SMALL).collect()}
    for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect():
        want = plain_article(r.html)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


LONG = "A sentence of the article that is long enough to weigh in a window of lines."
BESIDE = "Text beside the article, long enough to weigh as much as any of its sentences."


@pytest.mark.parametrize("part", [
    f"<nav><p>{BESIDE}</p></nav>", f"<header><p>{BESIDE}</p></header>", f"<footer>{BESIDE}</footer>", f"<aside><div>{BESIDE}</div></aside>",
    f"<form><p>{BESIDE}</p><input></form>", f"<div class='cookie-notice'>{BESIDE}</div>", f"<div id=ad-top><p>{BESIDE}</p></div>",
    f"<section class='comments'><article><p>{BESIDE}</p></article></section>", f"<div role=navigation>{BESIDE}</div>",
    f"<script>var x = '<p>{BESIDE}</p>';</script>", f"<style>p:after {{content: '{BESIDE}'}}</style>", f"<!-- <p>{BESIDE}</p> -->",
    f"<div hidden>{BESIDE}</div>", f"<ul class='menu main-menu'><li>{BESIDE}</li></ul>"])
@pytest.mark.parametrize("marked", ["article", "main", "div"])
def test_parts_beside_the_article_go(part, marked):
    article = f"<{marked}><h1>Title</h1><p>{LONG}<p>Short.</p><div>{LONG} <a href='/x'>Linked</a> words.</div><p>End.</p></{marked}>"
    want = f"Title\n{LONG}\nShort.\n{LONG} Linked words.\nEnd."
    assert main_text.extract_texts([f"<body>{part}{article}{part}</body>"]) == [want]
    inside = article.replace("<p>Short.", f"{part}<p>Short.")
    if marked != "div" and not part.startswith("<header"):  # an article's own header holds its title
        assert main_text.extract_texts([f"<body>{inside}</body>"]) == [want]


def test_pages_at_the_edges(spark):
    many = "<article>" + "".join(f"<p>{i} &amp; &#233;</p>" for i in range(60_000)) + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>a&nbsp;\n b"), (3, "u", "plain &lt;text&gt;"), (3, "u", "plain &lt;text&gt;"), (4, "u", many),
            (5, "u", "<div><a href=x>link</a></div>"), (6, "u", "<article><p>cut <b"), (7, "u", "<" * 5000 + "<p a=\"" * 2000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = sorted(main_text.extract(df).collect(), key=lambda r: (r.page_id is None, r.page_id or 0))
    text = [(r.page_id, r.text) for r in got if r.page_id not in (4, 7)]
    assert text == [(1, ""), (2, ""), (3, "plain <text>"), (3, "plain <text>"), (5, ""), (6, "cut"), (None, "a b")]
    long = next(r for r in got if r.page_id == 4)
    assert long.text == "\n".join(f"{i} & é" for i in range(60_000)) and long.n_chars == len(long.text)
    assert main_text.extract(df.limit(0)).count() == 0


# ---------------------------------------------------------------- collocations

def plain_collocations(rows, least=10, top=2000, cover=50):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for m in (1, 2, 3):
                for i in range(len(w) - m + 1):
                    f[lang or "und"][" ".join(w[i:i + m])] += 1
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if a >= least and 1 <= p.count(" ") <= 2}
        found = []
        for p, a in cand.items():
            w = p.split(" ")
            inside = [x for q, x in cand.items() if len(q) > len(p) and f" {p} " in f" {q} "]
            if any(100 * x >= cover * a for x in inside):
                continue
            cuts = [(1_000_000 * a * a // (c[" ".join(w[:k])] * c[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found.append((-score, -a, p.encode(), c[" ".join(w[:k])], c[" ".join(w[k:])]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(t, "x", la) for la, t in rows], "text string, phrase string, lang string")
    return sorted(tuple(r) for r in phrases.mine(df, **options).collect())


def test_collocations_equal_plain_counts(spark, monkeypatch):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows += [("en", "a A a, a\ta a a"), (None, "x\x0by X é"), ("und", "x y é")] * 12 + [("fr", None), ("fr", ""), ("en", "w" * 200_000 + " v")] * 11
    want = plain_collocations(rows)
    assert mined(spark, rows) == want and len(want) > 100
    monkeypatch.setattr(phrases, "SHARD_PHRASES", 300)  # many tries, one for the long phrase
    assert mined(spark, rows, top=20) == [r for r in want if r[1] <= 20]


def test_collocations_of_nothing(spark):
    assert mined(spark, []) == [] and mined(spark, [("en", None), (None, ". ,")]) == []


def test_one_pass_counts_phrases_however_many_the_shards(spark, monkeypatch):
    rows = [("en", f"w{i % 40} w{i % 39} w{i % 38} w{i % 37}") for i in range(6000)]
    kind = type(spark.range(1))
    passes, plain = [], kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda df, *a, **k: passes.append(df.columns) or plain(df, *a, **k))
    few = mined(spark, rows, least=2)
    one = len(passes)
    monkeypatch.setattr(phrases, "SHARD_PHRASES", 50)
    assert mined(spark, rows, least=2) == few and len(few) > 1000
    assert len(passes) == 2 * one  # before: a pass over the texts for each shard


def test_windows_of_one_hash_are_told_apart_by_their_bytes(monkeypatch):
    monkeypatch.setattr(phrases, "mix", lambda x: x * np.uint64(0))
    text = "a long word a long word a long wort. a longer one, a longer one" + " very-long-words" * 5
    every = lambda h: np.ones(len(h), bool)
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "fr"]), pa.array([text, "a long word"])], ["lang", "text"])
    got = collections.Counter()
    for out in phrases._windows([every, every], 7)([batch]):
        for r in out.to_pylist():
            for window, n in zip(r["data"].decode().split("\n"), np.frombuffer(r["n"], np.uint32).tolist()):
                got[r["lang"], window] += n
    want = collections.Counter([("fr", "a long word"), ("fr", "long word")])
    for piece in text.replace(",", ".").split("."):
        w = piece.split()
        want.update(("en", " ".join(w[i:i + 3])) for i in range(len(w) - 1))
    assert got == want


def test_trie_accepts_its_keys_only():
    rng = np.random.default_rng(3)
    words = sorted({bytes(rng.integers(97, 123, rng.integers(1, 6)).astype(np.uint8)) for _ in range(3000)})
    keys = [b"en\0" + w for w in words[::2]] + [b"fr\0" + words[1]]
    text = b" ".join(words).decode()
    batch = phrases.Words(pa.array([text, text]), pa.array(["en", "fr"]))
    got = phrases.DoubleArray(keys).count(batch, len(keys))
    assert got.tolist() == [1] * len(keys)


# ---------------------------------------------------------------- importance resampling

def plain_resample(rows, target, n=1, buckets=10_000, percent=10, least=20):
    def grams(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
        return w, [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]
    s = collections.Counter(b for _, t in rows for b in grams(t)[1])
    t = collections.Counter(b for x in target for b in grams(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in s}
    out = []
    for i, text in rows:
        w, g = grams(text)
        weight = sum(gain[b] for b in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w)])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[:percent * len(able) // 100]
    return sorted(((*r[:4], next((k + 1 for k, d in enumerate(drawn) if d is r), None)) for r in out), key=str)


def resampled(spark, rows, target, **options):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, line string")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    return sorted((tuple(r) for r in importance.resample(docs, goal, **options).collect()), key=str)


@pytest.mark.parametrize("n", [1, 3])
def test_resampling_equals_plain_version(spark, n):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()] + [None, ""]
    extra = "The same line\nfor all, é É 1st\n\nthe same line"
    rows = [(i, f"{t}\n{extra}") for i, t in rows]
    rows += [(5000, None), (5001, ""), (5002, "... !"), (5003, "x" * 300_000), (None, "a b c " * 30), (5004, "\n\n" + "w\n" * 5000)]
    assert resampled(spark, rows, target, n=n) == plain_resample(rows, target, n=n)


def test_equal_rows_take_ranks_side_by_side(spark):
    text = "one two three " * 10
    got = resampled(spark, [(7, text)] * 40 + [(8, text)] * 5, ["two"], percent=50)
    want = plain_resample([(7, text)] * 40 + [(8, text)] * 5, ["two"], percent=50)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert sorted((r[0], r[4]) for r in got if r[4]) == sorted((r[0], r[4]) for r in want if r[4])


def test_resampling_of_nothing(spark):
    assert resampled(spark, [], ["x"]) == [] and resampled(spark, [(1, None)], []) == [(1, 0, 0, plain_resample([(1, None)], [])[0][3], None)]
