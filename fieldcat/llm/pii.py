"""Personal data: exact base patterns, and spans that a character-level BiLSTM-CRF adds.

The network reads characters in both directions (an LSTM each way), scores a B/I tag per kind
or O for every character, and a linear-chain CRF scores tag sequences. It is trained in
numpy, on the driver, from labelled spans: windows of the corpus in which the base patterns
mark spans, ``SAMPLE`` windows at most, those of lowest hash over all documents. Labelled
spans are varied in training (other separators, no plus sign), which is what the network
can find beyond the patterns.

A text is cut into windows of ``WINDOW`` characters, each overlapping the next by half. Every
kind of span holds a digit or an ``@`` by definition, so windows with neither have no span
and are not decoded; all others are, in whole texts. The windows' spans are reconciled over
the text: overlapping spans of one kind join, a joined span must hold what its kind asks for
(digits, parts, Luhn sum) and end where words do, must not touch a base span, and of overlapping ones the longest
stays. Base spans always stay.

Defined results: a null or empty text has no spans. A corpus without labelled spans trains no
network and adds none. Rows given twice get equal results; null ids and other columns pass
through. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcat.llm.support import text_pieces

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 96, 48
#: Windows used for training at most, and the training's size.
SAMPLE, EPOCHS, BATCH, HIDDEN = 800, 10, 80, 16
#: Characters of their own: ASCII; then any other letter or digit, any other character, none.
ASCII, LETTER, OTHER, NONE = 128, 128, 129, 130
TAGS = 1 + 2 * len(KINDS)

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a digit run is tried at its first digit only: its other digits give no other outcome
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _is_ip(s: str) -> bool:
    parts = s.split(".")
    return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def _is_card(s: str) -> bool:
    d = _digits(s)
    return 16 <= len(d) <= 19 and luhn(d)


def _is_phone(s: str) -> bool:
    return 8 <= len(_digits(s)) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind, then start."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((0, start, found.end()))
        done = found.end() if found else at + 1
        at = text.find("@", done)
    for kind, pattern, valid in ((1, _IP, _is_ip), (2, _CARD, _is_card), (3, _PHONE, _is_phone)):
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if valid(m[0])]
    return out


# --- the network -------------------------------------------------------------------------

def encode(text: str) -> np.ndarray:
    """Character numbers of a text."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    wide = np.array([LETTER if chr(c).isalnum() else OTHER for c in np.unique(code[code >= ASCII]).tolist()], np.int64)
    out = code.astype(np.int64)
    if len(wide):
        out[code >= ASCII] = wide[np.searchsorted(np.unique(code[code >= ASCII]), code[code >= ASCII])]
    return out


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


def new_model(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    h = HIDDEN
    model = {"out": rng.normal(0, 0.3, (2 * h, TAGS)), "bias": np.zeros(TAGS), "step": rng.normal(0, 0.1, (TAGS, TAGS)), "first": np.zeros(TAGS)}
    for way in ("f", "b"):
        gate = np.zeros(4 * h)
        gate[h:2 * h] = 1.0  # forget gates start open
        model |= {f"in_{way}": rng.normal(0, 0.4, (NONE + 1, 4 * h)) + gate, f"rec_{way}": rng.normal(0, 1 / np.sqrt(h), (h, 4 * h))}
    return model


def _lstm(x, table, rec):
    """Hidden states (time, batch, HIDDEN) of one direction and what its gradient needs."""
    steps, batch, h = *x.shape, rec.shape[0]
    hs, cs = (np.zeros((steps + 1, batch, h), rec.dtype) for _ in range(2))
    gates = np.empty((steps, batch, 4 * h), rec.dtype)
    for t in range(steps):
        z = table[x[t]] + hs[t] @ rec
        z[:, :3 * h] = _sigmoid(z[:, :3 * h])
        z[:, 3 * h:] = np.tanh(z[:, 3 * h:])
        cs[t + 1] = z[:, h:2 * h] * cs[t] + z[:, :h] * z[:, 3 * h:]
        hs[t + 1] = z[:, 2 * h:3 * h] * np.tanh(cs[t + 1])
        gates[t] = z
    return hs, cs, gates


def _lstm_back(x, rec, saved, dh_out, size):
    hs, cs, gates = saved
    h = rec.shape[0]
    drec = np.zeros_like(rec)
    dh, dc = np.zeros_like(hs[0]), np.zeros_like(cs[0])
    dz = np.empty_like(gates)
    for t in range(len(x) - 1, -1, -1):
        i, f, o, g = (gates[t][:, k * h:(k + 1) * h] for k in range(4))
        dh = dh + dh_out[t]
        tc = np.tanh(cs[t + 1])
        dc = dc + dh * o * (1 - tc * tc)
        dz[t] = np.concatenate([dc * g * i * (1 - i), dc * cs[t] * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
        drec += hs[t].T @ dz[t]
        dh, dc = dz[t] @ rec.T, dc * f
    return np.eye(size)[x.ravel()].T @ dz.reshape(-1, 4 * h), drec


def scores(model, x):
    """Tag scores (time, batch, TAGS) of windows x (time, batch)."""
    f = _lstm(x, model["in_f"], model["rec_f"])
    b = _lstm(x[::-1], model["in_b"], model["rec_b"])
    both = np.concatenate([f[0][1:], b[0][1:][::-1]], 2)
    return both @ model["out"] + model["bias"], both, f, b


def _lse(a, axis):
    m = a.max(axis, keepdims=True)
    return np.log(np.exp(a - m).sum(axis)) + m.squeeze(axis)


def loss_and_gradient(model, x, y):
    """The CRF's mean negative log-likelihood of tags y (time, batch) and its gradient."""
    e, both, f, b = scores(model, x)
    steps, batch, _ = e.shape
    step, rows = model["step"], np.arange(batch)
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = model["first"] + e[0]
    for t in range(1, steps):
        alpha[t] = _lse(alpha[t - 1][:, :, None] + step, 1) + e[t]
    for t in range(steps - 2, -1, -1):
        beta[t] = _lse(step + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    logz = _lse(alpha[-1], 1)
    gold = model["first"][y[0]] + e[0, rows, y[0]]
    marginal = np.exp(alpha + beta - logz[:, None])
    de, dstep = marginal.copy(), np.zeros_like(step)
    de[0, rows, y[0]] -= 1
    for t in range(1, steps):
        gold = gold + step[y[t - 1], y[t]] + e[t, rows, y[t]]
        de[t, rows, y[t]] -= 1
        dstep += np.exp(alpha[t - 1][:, :, None] + step + (e[t] + beta[t])[:, None, :] - logz[:, None, None]).sum(0)
        np.add.at(dstep, (y[t - 1], y[t]), -1)
    dfirst = marginal[0].sum(0) - np.bincount(y[0], minlength=TAGS)
    dboth = de @ model["out"].T
    h = model["rec_f"].shape[0]
    gf = _lstm_back(x, model["rec_f"], f, dboth[:, :, :h], NONE + 1)
    gb = _lstm_back(x[::-1], model["rec_b"], b, dboth[::-1, :, h:], NONE + 1)
    grad = {"out": both.reshape(-1, 2 * h).T @ de.reshape(-1, TAGS), "bias": de.sum((0, 1)), "step": dstep, "first": dfirst,
            "in_f": gf[0], "rec_f": gf[1], "in_b": gb[0], "rec_b": gb[1]}
    return float((logz - gold).mean()), {k: v / batch for k, v in grad.items()}


def decode(model, x):
    """The best tag sequence (time, batch) of each window."""
    e, *_ = scores(model, x)
    steps, batch, _ = e.shape
    best, back = model["first"] + e[0], np.empty(e.shape, np.int8)
    for t in range(1, steps):
        to = best[:, :, None] + model["step"]
        back[t] = to.argmax(1)
        best = to.max(1) + e[t]
    tags = np.empty((steps, batch), np.int64)
    tags[-1] = best.argmax(1)
    for t in range(steps - 1, 0, -1):
        tags[t - 1] = back[t][np.arange(batch), tags[t]]
    return tags


def _varied(text: str, spans, rng) -> tuple[str, list[tuple[int, int, int]]]:
    """The window with some labelled spans written otherwise, and the spans' new places."""
    out, moved, at = [], [], 0
    for kind, s, e in sorted(spans, key=lambda x: x[1]):
        if s < at:
            continue
        part = text[s:e]
        if kind == 3 and rng.random() < 0.3:
            part = part.lstrip("+")
        if kind in (2, 3) and rng.random() < 0.3:
            part = re.sub(r"[\x20-]", rng.choice([".", "/", "-", " "]), part)
        out += [text[at:s], part]
        start = sum(map(len, out)) - len(part)
        moved.append((kind, start, start + len(part)))
        at = e
    out.append(text[at:])
    return "".join(out), moved


def _window(text: str, spans, lo: int = 0):
    x, y = np.full(WINDOW, NONE, np.int64), np.zeros(WINDOW, np.int64)
    code = encode(text)[:WINDOW]
    x[:len(code)] = code
    for kind, s, e in spans:
        s, e = s - lo, e - lo
        if e > 0 and s < WINDOW:
            y[max(s, 0):e] = 2 + 2 * kind
            if s >= 0:
                y[s] = 1 + 2 * kind
    return x, y


def train(windows: list[tuple[str, list[tuple[int, int, int]]]], seed: int = 7) -> dict[str, np.ndarray] | None:
    """A model from labelled windows (text, spans); none if no window has a span."""
    if not any(spans for _, spans in windows):
        return None
    rng = np.random.default_rng(seed)
    model = new_model(seed)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.items()}
    turn = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), BATCH):
            pairs = [_window(*_varied(*windows[k], rng)) for k in order[i:i + BATCH]]
            _, grad = loss_and_gradient(model, np.stack([p[0] for p in pairs], 1), np.stack([p[1] for p in pairs], 1))
            turn += 1
            for k, g in grad.items():
                g = np.clip(g, -5, 5)
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                model[k] = model[k] - 0.02 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in model.items()}


# --- over texts --------------------------------------------------------------------------

def _starts(length: int) -> range:
    return range(0, max(1, length - STRIDE), STRIDE)


def _evident(code: np.ndarray) -> list[int]:
    """Starts of the windows that hold a digit or an ``@``."""
    at = np.flatnonzero(((code >= 48) & (code <= 57)) | (code == 64))
    if not len(at):
        return []
    starts = np.array(_starts(len(code)))
    return starts[np.searchsorted(at, starts + WINDOW) > np.searchsorted(at, starts)].tolist()


def _spans_of(tags: np.ndarray, lo: int, length: int) -> list[tuple[int, int, int]]:
    out, kind, start = [], -1, 0
    for i, t in enumerate(tags[:length].tolist() + [0]):
        now = (t - 1) // 2 if t else -1
        if kind >= 0 and (now != kind or t % 2 == 1):
            out.append((kind, lo + start, lo + i))
            kind = -1
        if now >= 0 and kind < 0:
            kind, start = now, i
    return out


def _valid(kind: int, s: str) -> bool:
    if kind == 0:
        return bool(re.fullmatch(r"[^\s@]+@[^\s@]+\.[^\s@]{2,}", s))
    if kind == 1:
        return _is_ip(s)
    return _is_card(s) if kind == 2 else _is_phone(s) and len(re.findall(r"[A-Za-z]", s)) == 0


def reconcile(text: str, found: list[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """All spans of a text: the base ones and what the windows found besides."""
    joined: list[list[int]] = []
    for kind, s, e in sorted(found):
        if joined and joined[-1][0] == kind and s < joined[-1][2]:
            joined[-1][2] = max(joined[-1][2], e)
        else:
            joined.append([kind, s, e])
    taken = [(s, e) for _, s, e in base]
    more = []
    for kind, s, e in sorted(joined, key=lambda x: (x[1] - x[2], x[0], x[1])):
        while s < e and not text[s].isalnum() and text[s] not in "+(":
            s += 1
        while e > s and not text[e - 1].isalnum():
            e -= 1
        whole = s < e and not text[s - 1:s].isalnum() and not text[e:e + 1].isalnum()
        if whole and all(e <= a or b <= s for a, b in taken) and _valid(kind, text[s:e]):
            more.append((kind, s, e))
            taken.append((s, e))
    return sorted([*base, *more])


def _all_spans(model, texts: list[str | None]) -> list[tuple[list, list]]:
    """(all spans, base spans) of each text; windows of all the texts are decoded together."""
    out: list = [([], [])] * len(texts)
    held, where, found = [], [], {}

    def flush():
        if held:
            tags = decode(model, np.stack(held, 1))
            for k, (i, lo, n) in enumerate(where):
                found.setdefault(i, []).extend(_spans_of(tags[:, k], lo, n))
            held.clear()
            where.clear()

    bases = {}
    for i, text in enumerate(texts):
        if not text:
            continue
        code = encode(text)
        starts = _evident(code)
        if not starts:
            continue
        bases[i] = base_spans(text)
        for lo in starts if model is not None else ():
            x = np.full(WINDOW, NONE, np.int64)
            part = code[lo:lo + WINDOW]
            x[:len(part)] = part
            held.append(x)
            where.append((i, lo, len(part)))
            if len(held) == 512:
                flush()
    flush()
    for i, base in bases.items():
        out[i] = (reconcile(texts[i], found.get(i, []), base), base)
    return out


def _texts(batches: Iterator[pa.RecordBatch]):
    """Pieces of the batches, their texts without those that hold no digit and no ``@``."""
    for batch in batches:
        for piece in text_pieces(batch):
            text = piece.column("text")
            some = pc.match_substring_regex(text, "[0-9@]").to_pylist()
            yield piece, [value.as_py() if held else None for value, held in zip(text, some)]


def _labelled(batches):
    """(rank, window, spans) of windows that hold a digit or an ``@``."""
    for piece, texts in _texts(batches):
        rows = []
        for text in texts:
            if not text:
                continue
            base, code = base_spans(text), encode(text)
            for lo in _evident(code):
                own = [(k, s - lo, e - lo) for k, s, e in base if s < lo + WINDOW and e > lo]
                window = text[lo:lo + WINDOW]
                rank = int.from_bytes(hashlib.blake2b(window.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)
                rows.append((rank, window, ",".join(f"{k}:{s}:{e}" for k, s, e in own)))
        rows.sort()
        rows = rows[:SAMPLE]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string()))],
                                         ["rank", "window", "spans"])


def fit(docs: DataFrame) -> dict[str, np.ndarray] | None:
    """The network trained on ``docs``' labelled windows."""
    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_labelled, "rank long, window string, spans string")
    sample = rows.distinct().orderBy("rank", "window", "spans").limit(SAMPLE).collect()
    windows = [(r["window"], [tuple(map(int, s.split(":"))) for s in r["spans"].split(",") if s]) for r in sample]
    return train(windows)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def _find(held):
    def run(batches):
        for piece, texts in _texts(batches):
            pairs = _all_spans(held.value, texts)
            counts = [[sum(s[0] == k for s in spans) for spans, _ in pairs] for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts], pa.array([_joined(b) for _, b in pairs], pa.string()),
                 pa.array([_joined(s) for s, _ in pairs], pa.string())],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base", "spans"])
    return run


def find(docs: DataFrame, model: dict[str, np.ndarray] | None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans) of every row; ``base`` and
    ``spans`` list kind:start:end."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _find(held), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")


def _redact(held):
    def run(batches):
        for piece, texts in _texts(batches):
            changed = {}
            for i, (spans, _) in enumerate(_all_spans(held.value, texts)):
                text, at, parts = texts[i], 0, []
                for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
                    if s >= at:
                        parts += [text[at:s], f"<{KINDS[kind].upper()}>"]
                    at = max(at, e)
                if parts:
                    changed[i] = "".join([*parts, text[at:]])
            if changed:
                column = piece.column("text").to_pylist()
                for i, new in changed.items():
                    column[i] = new
                piece = piece.set_column(piece.schema.get_field_index("text"), "text", pa.array(column, pa.string()))
            yield piece
    return run


def redact(docs: DataFrame, model: dict[str, np.ndarray] | None) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_redact(held), docs.schema)
