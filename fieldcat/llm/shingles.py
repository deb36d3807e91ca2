"""Numpy kernels for word shingles: words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z
lower-cased; a shingle is ``width`` consecutive words, hashed to 64 bits the same way on
every executor."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                  0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x2127599BF4325C37], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_strings(values: pa.Array) -> np.ndarray:
    """A 64-bit hash for each string: polynomial over its bytes, then mixed."""
    if not len(values):
        return np.zeros(0, np.uint64)
    off = np.frombuffer(values.buffers()[1], np.int32)[values.offset:values.offset + len(values) + 1].astype(np.int64)
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[off[0]:off[-1]].astype(np.uint64) + np.uint64(1)
    off = off - off[0]
    size = np.diff(off)
    power = np.full(int(size.max()) + 1, _BASE, np.uint64)
    power[0] = 1
    np.cumprod(power, out=power)
    data *= power[np.arange(len(data)) - np.repeat(off[:-1], size)]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data, dtype=np.uint64)])
    return mix(total[off[1:]] - total[off[:-1]] + size.astype(np.uint64))


def distinct_words(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, every word's place among them, and the offsets of each row's words
    (null text: none)."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(text.cast(pa.string()), "")))
    off = words.offsets.to_numpy().astype(np.int64)
    coded = pc.dictionary_encode(words.flatten())
    code = coded.indices.to_numpy(zero_copy_only=False)
    used = (pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False) > 0)[code]
    before = np.concatenate([[0], np.cumsum(used)])
    return coded.dictionary, code[used], before[off - off[0]]


def word_codes(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of distinct words, every word's place among them, and the offsets of each
    row's words (null text: none)."""
    words, code, off = distinct_words(text)
    return hash_strings(words), code, off


def word_hashes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the offsets of each row's words."""
    hashed, code, off = word_codes(text)
    return hashed[code], off


def shingle_sets(text: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of every row, one after another, and the rows' offsets.
    A row with fewer words than ``width`` has its whole sequence as one shingle; a row
    without words has none."""
    hashed, off = word_hashes(text)
    count = np.diff(off)
    total = len(hashed)
    windows = max(0, total - width + 1)
    value = np.zeros(windows, np.uint64)
    for k in range(width):
        value += hashed[k:k + windows] * _FOLD[k]
    value = mix(value)
    out, ends = [], [0]
    for i, n in enumerate(count):
        s = off[i]
        if n >= width:
            own = np.sort(value[s:s + n - width + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) > 1 else own
        elif n:
            own = mix(np.sum(hashed[s:s + n] * _FOLD[:n], dtype=np.uint64, keepdims=True) + np.uint64(n))
        else:
            own = hashed[:0]
        out.append(own)
        ends.append(ends[-1] + len(own))
    return (np.concatenate(out) if out else hashed[:0]), np.array(ends, np.int64)
