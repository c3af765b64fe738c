"""Benchmark decontamination by Wu-Manber multi-pattern search.

Patterns are benchmark windows of ten words in normal form (lower case, one space between words, a space at
either end). A shift table over blocks of a few bytes, built from the first m bytes of all patterns (m: the shortest
pattern), lets a cursor skip positions where no pattern can end; a zero shift leads to the bucket of patterns
with the same suffix hash, and bytes are compared. All cursors of a batch of text segments advance together, so
the search runs as array operations.

Defined results: a null text has no words; an empty benchmark hits nothing; item_ids may repeat or be null
(null items are left out); repeated document rows each get a row; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .store import written

WINDOW = 10
#: Bytes of benchmark text that one search holds. A larger benchmark is searched in blocks of this size.
BLOCK_BYTES = 32 << 20
SEGMENT = 2048
#: Bytes in a block of the shift table: about log_c(2 m P) for a text alphabet of c letters and P patterns of m bytes.
BLOCK = 6
#: Bits of the shift table's index; blocks that share an entry only make a shift smaller.
TABLE_BITS = 20
#: Patterns shorter than this get a machine of their own, so that they don't shorten the shifts of the rest.
SHORT = 24

_SCHEMA = "doc_id long, n_words long, hits array<int>, items array<string>"


def normal_form(texts: tokens.Texts) -> tuple[np.ndarray, np.ndarray, tokens.Words]:
    """Bytes ' w1 w2 … wn ' of all texts joined and eight bytes of padding, the position of the space before each word, and the words."""
    w = tokens.words(texts)
    lens = w.end - w.start
    # one space before each word, and one after the last word of each text
    closes = np.diff(w.first) > 0
    extra = np.zeros(len(lens), np.int64)
    extra[w.first[1:][closes] - 1] = 1
    begin = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens + 1 + extra, out=begin[1:])
    out = np.full(int(begin[-1]) + 8, 32, np.uint8)
    nth = np.arange(lens.sum())  # of the bytes of words
    before = np.cumsum(lens) - lens
    out[np.repeat(begin[:-1] + 1 - before, lens) + nth] = w.lower[np.repeat(w.start - before, lens) + nth]
    return out, begin[:-1], w


def windows(items: list[tuple[str, str]]) -> tuple[list[bytes], list[list[str]], list[int]]:
    """Distinct windows in normal form, the item_ids of each, and their lengths in words."""
    found: dict[bytes, set[str]] = {}
    size: dict[bytes, int] = {}
    for item, text in items:
        if item is None or text is None:
            continue
        raw = text.encode()
        t = tokens.Texts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)], np.int64), 0)
        w = tokens.words(t)
        own = [w.lower[a:b].tobytes() for a, b in zip(w.start.tolist(), w.end.tolist(), strict=True)]
        if not own:
            continue
        n = min(WINDOW, len(own))
        for i in range(len(own) - n + 1):
            key = b" " + b" ".join(own[i : i + n]) + b" "
            found.setdefault(key, set()).add(item)
            size[key] = n
    keys = sorted(found)
    return keys, [sorted(found[k]) for k in keys], [size[k] for k in keys]


class WuManber:
    """Shift table, suffix-hash buckets and comparison over the patterns numbered `which`."""

    def __init__(self, patterns: list[bytes], which: list[int]):
        self.which = np.array(which, np.int64)
        own = [patterns[i] for i in which]
        self.m = m = min(map(len, own))
        self.block = b = min(BLOCK, m)
        self.mask = np.uint64((1 << (8 * b)) - 1)
        head = np.frombuffer(b"".join(p[:m] + bytes(8) for p in own), np.uint8)
        self.shift = np.full(1 << TABLE_BITS, m - b + 1, np.int32)
        at = np.arange(len(own)) * (m + 8)
        for j in range(m - b + 1):  # the block that ends j + b bytes into the pattern
            np.minimum.at(self.shift, self._entry(head, at + j), m - b - j)
        hashes = tokens.span_hashes(head, at, at + m)
        self.order = np.argsort(hashes, kind="stable")
        self.keys = hashes[self.order]
        self.lens = np.array([len(p) for p in own])
        self.flat = np.frombuffer(b"".join(own), np.uint8)
        self.at = np.concatenate(([0], np.cumsum(self.lens)[:-1]))

    def _entry(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Table index of the block that starts at each position; eight bytes must follow each."""
        word = np.ndarray(len(data) - 7, "<u8", data, 0, (1,))[at]
        return (tokens.mix(word & self.mask) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def find(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, pattern) of every occurrence in text, which ends in eight bytes of padding."""
        none, n, b = np.zeros(0, np.int64), len(text) - 8, self.block
        # a cursor is the position of the last byte of an m-byte head; each segment of positions has its own
        cursor = np.arange(self.m - 1, n, SEGMENT)
        stop, found = np.minimum(cursor + SEGMENT, n), []
        while len(cursor):
            skip = self.shift[self._entry(text, cursor - b + 1)]
            if (hit := skip == 0).any():
                found.append(cursor[hit])
            cursor = cursor + np.maximum(skip, 1)
            if not (live := cursor < stop).all():
                cursor, stop = cursor[live], stop[live]
        if not found:
            return none, none
        at = np.sort(np.concatenate(found)) - (self.m - 1)
        keys = tokens.span_hashes(text, at, at + self.m)
        low, high = np.searchsorted(self.keys, keys), np.searchsorted(self.keys, keys, "right")
        hit = np.flatnonzero(high > low)
        size = (high - low)[hit]
        pos = np.repeat(at[hit], size)
        one = self.order[np.repeat(low[hit] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        fits = pos + self.lens[one] <= n
        pos, one = pos[fits], one[fits]
        same = np.zeros(len(pos), bool)
        for length in np.unique(self.lens[one]):  # direct comparison, a length at a time
            group = np.flatnonzero(self.lens[one] == length)
            for i in range(0, len(group), 20000):
                part, span = group[i : i + 20000], np.arange(length)
                same[part] = (text[pos[part, None] + span] == self.flat[self.at[one[part], None] + span]).all(1)
        return pos[same], self.which[one[same]]


def machines(patterns: list[bytes]) -> list[WuManber]:
    classes = ([i for i, p in enumerate(patterns) if len(p) < SHORT], [i for i, p in enumerate(patterns) if len(p) >= SHORT])
    return [WuManber(patterns, c) for c in classes if c]


class Search:
    """Windows of benchmark items, and where they occur in texts."""

    def __init__(self, items: list[tuple[str, str]]):
        patterns, self.owners, sizes = windows(items)
        self.machines, self.sizes = machines(patterns), np.array(sizes, np.int64)

    def __call__(self, texts: tokens.Texts) -> tuple[tokens.Words, np.ndarray, np.ndarray]:
        """The words, and (word, window) of every occurrence."""
        body, begin, w = normal_form(texts)
        found = [m.find(body) for m in self.machines] or [(np.zeros(0, np.int64),) * 2]
        pos, which = (np.concatenate(x) for x in zip(*found, strict=True))
        word = np.searchsorted(begin, pos)  # a pattern starts with the space before a word
        if len(pos):
            keep = (word < len(begin)) & (begin[np.minimum(word, len(begin) - 1)] == pos)
            word, which = word[keep], which[keep]
        return w, word, which


def _search(items: list[tuple[str, str]]):
    def run(batches):
        search = Search(items)
        for batch in batches:
            for texts in tokens.steps(batch.column("text")):
                w, word, which = search(texts)
                delta = np.zeros(len(w.start) + 1, np.int64)
                np.add.at(delta, word, 1)
                np.add.at(delta, word + search.sizes[which], -1)
                hit = np.cumsum(delta[:-1]) > 0
                owned: dict[int, set[str]] = {}
                for t, p in zip(w.text[word].tolist(), which.tolist(), strict=True):
                    owned.setdefault(t, set()).update(search.owners[p])
                rows = {"n_words": [], "hits": [], "items": []}
                for i in range(len(texts)):
                    a, b = int(w.first[i]), int(w.first[i + 1])
                    rows["n_words"].append(b - a)
                    rows["hits"].append(np.flatnonzero(hit[a:b]).tolist() if i in owned else [])
                    rows["items"].append(sorted(owned.get(i, ())))
                part = batch.slice(texts.first, len(texts))
                names = [n for n in part.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(rows["n_words"], pa.int64()), pa.array(rows["hits"], pa.list_(pa.int32())), pa.array(rows["items"], pa.list_(pa.string()))],
                    names=[*names, *rows],
                )

    return run


def _clean(items: list[tuple[str, str]]):
    def run(batches):
        search = Search(items)
        for batch in batches:
            for texts in tokens.steps(batch.column("text")):
                w, word, _ = search(texts)
                keep = np.ones(len(texts), bool)
                keep[w.text[word]] = False
                yield batch.slice(texts.first, len(texts)).filter(pa.array(keep))

    return run


def _blocks(benchmark: DataFrame, limit: int):
    """Lists of (item_id, text) of at most limit bytes of text, streamed to the driver one block at a time."""
    block, held = [], 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("i"), "text").where("item_id is not null and text is not null").toLocalIterator():
        block.append((row["i"], row["text"]))
        held += len(row["text"].encode())
        if held >= limit:
            yield block
            block, held = [], 0
    if block:
        yield block


def hits(documents: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, hits (word positions inside an occurrence), items (item_ids with occurring windows)."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = _blocks(benchmark, block_bytes)
    block, after = next(blocks, []), next(blocks, None)
    if after is None:
        return docs.mapInArrow(_search(block), _SCHEMA)
    # blocks of a large benchmark: rows are numbered and written, so that each keeps its number in the search of every block
    docs = written(docs.withColumn("row", F.monotonically_increasing_id()), "rows")
    parts = [docs.select("row", "doc_id", "text").mapInArrow(_search(b), "row long, " + _SCHEMA) for b in chain([block, after], blocks)]
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    merged = out.groupBy("row", "doc_id").agg(
        F.max("n_words").alias("n_words"),
        F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return merged.drop("row")


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's digest columns."""
    found = hits(documents, benchmark)
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of documents without any benchmark window; all columns stay."""
    for block in _blocks(benchmark, block_bytes):
        documents = documents.mapInArrow(_clean(block), documents.schema)
    return documents


def brute_force(text: str | None, items: list[tuple[str, str]]) -> tuple[int, int, str]:
    """n_words, n_hit and items_sha256 by plain word lists, for tests."""
    import re

    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    low = lambda s: pattern.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or ""))
    own, hit, got = low(text), set(), set()
    for item, t in items:
        ws = low(t)
        n = min(WINDOW, len(ws))
        if item is None or not n:
            continue
        for i in range(len(ws) - n + 1):
            for j in range(len(own) - n + 1):
                if own[j : j + n] == ws[i : i + n]:
                    hit |= set(range(j, j + n))
                    got.add(item)
    return len(own), len(hit), hashlib.sha256(",".join(sorted(got)).encode()).hexdigest()
