"""Feature rows of whole texts, as array operations over Arrow columns."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import tokens

#: Documents in one dense step.
DENSE_ROWS = 512


def fold_key(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string")) % folds


def unit(key: Column, salt: str) -> Column:
    """A number in [0, 1) that depends on key and salt alone."""
    return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(1 << 52)) / F.lit(float(1 << 52))


def hashed_profile(texts: tokens.Texts, dim: int) -> np.ndarray:
    """Square roots of counts of byte trigrams and of words, each hashed to dim columns, scaled to length 1."""
    n, w = len(texts), tokens.words(texts)
    plain = np.where(tokens.is_word(w.lower), w.lower, np.uint8(32)).astype(np.uint64)
    owner = np.repeat(np.arange(n), np.diff(texts.offsets))
    grams = (plain[:-2] << np.uint64(16)) | (plain[1:-1] << np.uint64(8)) | plain[2:] if len(plain) > 2 else np.zeros(0, np.uint64)
    own = owner[:-2][: len(grams)]
    inside = own == owner[2:] if len(grams) else np.zeros(0, bool)
    cell = own[inside] * dim + (tokens.mix(grams[inside]) % np.uint64(dim)).astype(np.int64)
    a = np.bincount(cell, minlength=n * dim).reshape(n, dim)
    b = np.bincount(w.text * dim + (w.hash % np.uint64(dim)).astype(np.int64), minlength=n * dim).reshape(n, dim)
    x = np.sqrt(np.concatenate([a, b], axis=1)).astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


#: Byte lengths of the word beginnings that stand for inflected forms.
STEMS = (4, 5)


def stem_hashes(w: tokens.Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the beginning of every word longer than it, for each length of STEMS."""
    text, value = [], []
    for n in STEMS:
        long = (w.end - w.start) > n
        text.append(w.text[long])
        value.append(tokens.mix(tokens.span_hashes(w.lower, w.start[long], w.start[long] + n) + np.uint64(n)))
    return np.concatenate(text), np.concatenate(value)


def present(w: tokens.Words, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, column) of each distinct hashed word or stem of each text, sorted; bits of the hash are kept."""
    text, value = stem_hashes(w)
    of = np.concatenate([w.text, text]).astype(np.uint64)
    value = np.concatenate([w.hash, value])
    pairs = np.unique((of << np.uint64(bits)) | (value >> np.uint64(64 - bits)))
    return (pairs >> np.uint64(bits)).astype(np.int64), (pairs & np.uint64((1 << bits) - 1)).astype(np.int64)


#: Bytes whose share of a text is a feature of its own.
MARKS = b"*$#&%!|?.,<>{}=\n"


def style(texts: tokens.Texts) -> np.ndarray:
    """Shape of each text: shares of kinds of bytes, word lengths, repetition. 8 + len(MARKS) + 8 columns."""
    n, data, w = len(texts), texts.data, tokens.words(texts)
    size = np.diff(texts.offsets)
    owner = np.repeat(np.arange(n), size)
    share = lambda mask, of: np.bincount(owner[mask], minlength=n) / np.maximum(of, 1)
    upper, lower, high = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122), data >= 128
    letters = np.bincount(owner[upper | lower], minlength=n)
    count = np.diff(w.first)
    per = np.maximum(count, 1)
    lens = (w.end - w.start).astype(float)
    again = np.zeros(len(w.hash), bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.text[1:] == w.text[:-1])
    distinct = np.bincount(_distinct(w.text, w.hash), minlength=n)
    two = tokens.shingles(w.hash, 2)
    pair_text = w.text[: len(two)][w.text[: len(two)] == w.text[1:]] if len(two) else w.text[:0]
    two = two[w.text[: len(two)] == w.text[1:]] if len(two) else two
    pairs = np.bincount(_distinct(pair_text, two), minlength=n)
    most = _largest_share(w.text, w.hash, n)
    columns = [
        share(upper, letters), letters / np.maximum(size, 1), share((data >= 48) & (data <= 57), size), share(data == 32, size),
        share(high, size), np.log1p(size), np.log1p(count), share((data < 48) & (data > 32), size),
        *[share(data == m, size) for m in MARKS],
        np.bincount(w.text, lens, n) / per, distinct / per, np.bincount(w.text[again], minlength=n) / per, pairs / np.maximum(count - 1, 1),
        most / per, np.bincount(w.text[lens > 20], minlength=n) / per, np.bincount(w.text[lens <= 3], minlength=n) / per, (count == 0).astype(float),
    ]
    return np.stack(columns, axis=1).astype(np.float32)


def _distinct(text: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The text of each distinct (text, value)."""
    order = np.lexsort((value, text))
    t, v = text[order], value[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (v[1:] != v[:-1])
    return t[new]


def _largest_share(text: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((value, text))
    t, v = text[order], value[order]
    new = np.flatnonzero(np.concatenate(([True], (t[1:] != t[:-1]) | (v[1:] != v[:-1])))) if len(t) else np.zeros(0, np.int64)
    out = np.zeros(n)
    if len(t):
        np.maximum.at(out, t[new], np.diff(np.append(new, len(t))).astype(float))
    return out
