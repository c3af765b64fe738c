"""Exact substring deduplication by difference-cover blockwise suffix sorting.

Every 100-byte string (window) belongs to the suffix bucket of its anchor: the least hash of the 28-byte strings that
start in its first 73 bytes. Equal windows have equal anchors, so buckets are independent. Consecutive windows with
one anchor occurrence are a run, and its bytes are the run's context.

1. Runs meet by anchor as (anchor, context fingerprint, place): 128 bits name a context. A run whose context came
   earlier is a repeat as a whole. Of anchors with several contexts the first run of each context stays open.
2. The open runs ship their context bytes. Anchors are collected into blocks of bounded size, and a block's suffixes
   are sorted blockwise: a difference cover modulo 31 is sampled, the sample suffixes are ranked by 100 bytes, all
   suffixes are sorted by their first 31 bytes, and longer ties are resolved by the ranks of the sample suffixes that
   stand at one offset below 31 from both. Neighbours in that order that share 100 bytes are equal windows.
3. Marked windows go back to their documents, whose covered bytes are cut.

Only 16 bytes per run (about 1 in 33 windows) and the contexts of open runs are shuffled besides the text itself.

Defined results: null text is empty; texts below 100 bytes keep all; rows that share a doc_id are documents in order
of their text; rows of null doc_id come first; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .chunks import dealt, in_order
from .store import parts_for

LENGTH = 100
GRAM = 28
SPAN = LENGTH - GRAM + 1  # 28-byte strings that start in a window
MODULUS = 31
# A perfect difference set modulo 31.
COVER = (1, 5, 11, 24, 25, 27)
#: Windows that one block sorts at a time.
BLOCK_WINDOWS = 200_000
#: Bytes of shuffled entries that one bucket task is planned to hold.
BUCKET_BYTES = 8 << 20

_ENTRY = "bucket int, route int, anchor binary, name binary, run binary"
_REPLY = "route int, repeats binary, open binary"
_OPEN = "bucket int, route int, anchor binary, run binary, size binary, context binary, windows binary"
_MARK = "route int, run binary, low binary, high binary"
_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


class Runs:
    """Runs of some consecutive documents: document, first byte in the block, windows, anchor hash, context fingerprint.

    Long texts are worked on a stretch of STEP_BYTES windows at a time; a stretch's end also ends a run."""

    def __init__(self, texts: tokens.Texts):
        n = len(texts.data)
        parts = [self._stretch(texts, a, min(a + tokens.STEP_BYTES, n - LENGTH + 1)) for a in range(0, n - LENGTH + 1, tokens.STEP_BYTES)]
        empty = [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.uint64)] * 2
        self.begin, self.count, self.anchor, self.name = (np.concatenate(x) for x in zip(empty, *parts, strict=True))

    @staticmethod
    def _stretch(texts: tokens.Texts, low: int, high: int) -> list[np.ndarray]:
        """begin, count, anchor, name of the runs of the windows that start in [low, high)."""
        data = texts.data[low : high + LENGTH - 1]
        m = len(data) - GRAM + 1
        word = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), 0, (1,))
        h = word[:m] * np.uint64(0x9E3779B97F4A7C15)
        for at in (8, 16, GRAM - 8):
            h ^= h >> np.uint64(29)
            h = (h + word[at : at + m]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        # least hash of each SPAN consecutive ones and its leftmost place, by doubling
        least, at, width = h, np.arange(m, dtype=np.int32), 1
        while width * 2 <= SPAN:
            left = least[:-width] <= least[width:]
            least, at = np.where(left, least[:-width], least[width:]), np.where(left, at[:-width], at[width:])
            width *= 2
        if (rest := SPAN - width) > 0:
            at = np.where(least[:-rest] <= least[rest:], at[:-rest], at[rest:])
        # windows within one document; the first one of a document starts a run, even right after the last of another
        first = np.clip(texts.offsets[:-1] - low, 0, len(at))
        bound = np.clip(texts.offsets[1:] - LENGTH + 1 - low, 0, len(at))
        first, bound = first[bound > first], bound[bound > first]
        inside = np.zeros(len(at) + 1, np.int8)
        np.add.at(inside, first, 1)
        np.add.at(inside, bound, -1)
        valid = np.cumsum(inside[:-1]) > 0
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (at[1:] != at[:-1])
        new[first] = True
        begin = np.flatnonzero(new)
        end = np.minimum(np.append(begin[1:], len(at)), bound[np.searchsorted(first, begin, "right") - 1]) if len(begin) else begin
        anchor = tokens.mix(h[at[begin]])
        name = tokens.mix(tokens.span_hashes(data, begin, end - 1 + LENGTH) + (at[begin] - begin).astype(np.uint64))
        return [begin + low, end - begin, anchor, name]

    def __len__(self) -> int:
        return len(self.begin)


def _packed(table: pa.Table) -> list[tuple[tokens.Texts, Runs, int]]:
    """Blocks of a chunk's texts with their runs and the chunk's number of the first of them."""
    out, number = [], 0
    for texts in tokens.steps(table["text"]):
        runs = Runs(texts)
        out.append((texts, runs, number))
        number += len(runs)
    return out


def _first_in_chunk(packed: list[tuple[tokens.Texts, Runs, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor and name of a chunk's runs, and whether each is the first of its anchor and name in the chunk."""
    anchor, name = (np.concatenate([getattr(r, k) for _, r, _ in packed]) for k in ("anchor", "name"))
    order = np.lexsort((name, anchor))  # stable: equal runs stay in document order
    first = np.ones(len(order), bool)
    first[order[1:]] = (anchor[order[1:]] != anchor[order[:-1]]) | (name[order[1:]] != name[order[:-1]])
    return anchor, name, first


def _entries(buckets: int):
    """The first run of each context in a chunk; later ones are known to be repeats, so a passage of very many documents
    sends one entry per chunk."""

    def run(table: pa.Table) -> pa.Table:
        route = table["route"][0].as_py()
        anchor, name, first = _first_in_chunk(_packed(in_order(table.select(["doc_id", "text"]))))
        kept = np.flatnonzero(first)
        bucket = (anchor[kept] % np.uint64(buckets)).astype(np.int32)
        order = kept[np.argsort(bucket, kind="stable")]
        cut = np.searchsorted(np.sort(bucket), np.arange(buckets + 1))
        rows = [(b, order[cut[b] : cut[b + 1]]) for b in range(buckets) if cut[b] < cut[b + 1]]
        return pa.table(
            [pa.array([b for b, _ in rows], pa.int32()), pa.array([route] * len(rows), pa.int32()), pa.array([anchor[i].tobytes() for _, i in rows], pa.binary()),
             pa.array([name[i].tobytes() for _, i in rows], pa.binary()), pa.array([i.astype(np.uint32).tobytes() for _, i in rows], pa.binary())],
            names=["bucket", "route", "anchor", "name", "run"],
        )

    return run


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), kind)


def _by_route(route: np.ndarray):
    order = np.argsort(route, kind="stable")
    values, first = np.unique(route[order], return_index=True)
    for v, own in zip(values.tolist(), np.split(order, first[1:]), strict=True):
        yield v, own


def _match(table: pa.Table) -> pa.Table:
    """Per route the runs whose context came earlier, and the first runs of anchors with several contexts."""
    anchor, name, run = _joined(table["anchor"], np.uint64), _joined(table["name"], np.uint64), _joined(table["run"], np.uint32)
    route = np.repeat(np.array(table["route"].to_pylist(), np.int32), [len(x.as_py()) // 4 for x in table["run"]])
    order = np.lexsort((run, route, name, anchor))
    a, c = anchor[order], name[order]
    same_anchor = np.zeros(len(a), bool)
    same_anchor[1:] = a[1:] == a[:-1]
    repeat = np.zeros(len(a), bool)
    repeat[1:] = same_anchor[1:] & (c[1:] == c[:-1])
    group = np.cumsum(~same_anchor) - 1
    contexts = np.bincount(group[~repeat]) if len(a) else np.zeros(0, np.int64)
    opened = ~repeat & (contexts[group] > 1) if len(a) else repeat
    rows = {"route": [], "repeats": [], "open": []}
    pick = np.flatnonzero(repeat | opened)
    for v, own in _by_route(route[order[pick]]):
        at = pick[own]
        rows["route"].append(v)
        rows["repeats"].append(np.sort(run[order[at[repeat[at]]]]).tobytes())
        rows["open"].append(np.sort(run[order[at[opened[at]]]]).tobytes())
    return pa.table([pa.array(rows["route"], pa.int32()), pa.array(rows["repeats"], pa.binary()), pa.array(rows["open"], pa.binary())], names=list(rows))


def _contexts(buckets: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = {n: [] for n in ("bucket", "route", "anchor", "run", "size", "context", "windows")}
        types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        wanted = np.sort(_joined(right["open"], np.uint32)) if len(right) else np.zeros(0, np.uint32)
        if len(left) and len(wanted):
            route = left["route"][0].as_py()
            table = in_order(left.select(["doc_id", "text"]))
            held: list[tuple] = []
            for texts, runs, number in _packed(table):
                own = wanted[np.searchsorted(wanted, number) : np.searchsorted(wanted, number + len(runs))].astype(np.int64) - number
                for i in own.tolist():
                    a = int(runs.begin[i])
                    n = int(runs.count[i])
                    held.append((int(runs.anchor[i]) % buckets, int(runs.anchor[i]), number + i, n, texts.data[a : a + n + LENGTH - 1].tobytes()))
            by: dict[int, list[tuple]] = {}
            for x in held:
                by.setdefault(x[0], []).append(x)
            for b, xs in by.items():
                rows["bucket"].append(b)
                rows["route"].append(route)
                rows["anchor"].append(np.array([x[1] for x in xs], np.uint64).tobytes())
                rows["run"].append(np.array([x[2] for x in xs], np.uint32).tobytes())
                rows["size"].append(np.array([len(x[4]) for x in xs], np.uint32).tobytes())
                rows["context"].append(b"".join(x[4] for x in xs))
                rows["windows"].append(np.array([x[3] for x in xs], np.uint32).tobytes())
        return pa.table([pa.array(v, t) for v, t in zip(rows.values(), types, strict=True)], names=list(rows))

    return run


_DELTA = np.zeros((MODULUS, MODULUS), np.int64)
for _i in range(MODULUS):
    for _j in range(MODULUS):
        _DELTA[_i, _j] = next(d for d in range(MODULUS) if (_i + d) % MODULUS in COVER and (_j + d) % MODULUS in COVER)


def suffix_order(text: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """`windows` (positions in text) sorted by the text from each on, at least to depth LENGTH.

    text must end in LENGTH + MODULUS bytes of padding."""
    if len(windows) < 2:
        return windows
    # ranks of the cover sample by LENGTH bytes
    n = len(text) - LENGTH
    sample = np.flatnonzero(np.isin(np.arange(MODULUS), COVER)[np.arange(n) % MODULUS])
    strings = np.lib.stride_tricks.as_strided(text, (n, LENGTH), (1, 1))[sample]
    _, rank = np.unique(np.ascontiguousarray(strings).view(f"V{LENGTH}").ravel(), return_inverse=True)
    ranks = np.full(len(text) + 1, -1, np.int64)
    ranks[sample] = rank.ravel()
    # first MODULUS bytes as four big-endian words
    word = np.ndarray(len(text) - 7, ">u8", text, 0, (1,))
    keys = [word[windows + k].astype(np.uint64) for k in (0, 8, 16, MODULUS - 8)]
    order = np.lexsort(keys[::-1])
    out = windows[order]
    tie = np.ones(len(out) - 1, bool)
    for k in keys:
        s = k[order]
        tie &= s[1:] == s[:-1]
    # label of a tied group: its first place
    label = np.maximum.accumulate(np.where(np.concatenate(([True], ~tie)), np.arange(len(out)), 0))
    live = np.flatnonzero(np.concatenate((tie, [False])) | np.concatenate(([False], tie)))
    while len(live):
        pivot = out[label[live]]
        x = out[live]
        delta = _DELTA[x % MODULUS, pivot % MODULUS]
        side = np.sign(ranks[x + delta] - ranks[pivot + delta])
        place = np.lexsort((side, label[live]))
        out[live] = x[place]
        side, old = side[place], label[live]  # labels are in order already
        new = np.concatenate(([True], (old[1:] != old[:-1]) | (side[1:] != side[:-1])))
        label[live] = live[np.maximum.accumulate(np.where(new, np.arange(len(live)), 0))]
        size = np.bincount(np.cumsum(new) - 1)
        live = live[(side != 0) & (size[np.cumsum(new) - 1] > 1)]
    return out


def first_equal(text: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Whether an equal window stands before each of windows (ascending positions in text)."""
    order = suffix_order(text, windows)
    same = np.ones(max(len(order) - 1, 0), bool)
    word = np.ndarray(len(text) - 7, "<u8", text, 0, (1,))
    for k in (*range(0, LENGTH - 8, 8), LENGTH - 8):
        s = word[order + k]
        same &= s[1:] == s[:-1]
    group = np.cumsum(np.concatenate(([True], ~same))) - 1 if len(order) else np.zeros(0, np.int64)
    least = np.full(group[-1] + 1 if len(group) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, group, order)
    later = np.zeros(len(text), bool)
    later[order[order != least[group]]] = True
    return later[windows]


def _sort_blocks(table: pa.Table) -> pa.Table:
    """Marks of repeated windows of open runs: per route the run and the windows [low, high) within it."""
    anchor, run = _joined(table["anchor"], np.uint64), _joined(table["run"], np.uint32)
    size, windows = _joined(table["size"], np.uint32).astype(np.int64), _joined(table["windows"], np.uint32).astype(np.int64)
    text = _joined(table["context"], np.uint8)
    route = np.repeat(np.array(table["route"].to_pylist(), np.int32), [len(x.as_py()) // 4 for x in table["run"]])
    start = np.cumsum(size) - size
    order = np.lexsort((run, route, anchor))  # within an anchor in document order
    groups = np.flatnonzero(np.concatenate(([True], anchor[order][1:] != anchor[order][:-1]))) if len(order) else np.zeros(0, np.int64)
    limits = np.append(groups, len(order))
    upto = np.concatenate(([0], np.cumsum(windows[order])))
    marks: list[tuple] = []
    g = 0
    while g < len(groups):
        e = max(g + 1, int(np.searchsorted(upto[limits], upto[limits[g]] + BLOCK_WINDOWS, "right")) - 1)
        own = order[limits[g] : limits[e]]
        g = e
        block = np.concatenate([*(text[start[i] : start[i] + size[i]] for i in own.tolist()), np.zeros(LENGTH + MODULUS + 8, np.uint8)])
        base = np.cumsum(size[own]) - size[own]
        nth = np.arange(windows[own].sum()) - np.repeat(np.cumsum(windows[own]) - windows[own], windows[own])
        later = first_equal(block, np.repeat(base, windows[own]) + nth)
        owner = np.repeat(np.arange(len(own)), windows[own])
        on = np.flatnonzero(later)
        if len(on):
            new = np.concatenate(([True], (on[1:] != on[:-1] + 1) | (owner[on[1:]] != owner[on[:-1]])))
            last = np.concatenate((new[1:], [True]))
            who = own[owner[on[new]]]
            marks.append((route[who], run[who], nth[on[new]].astype(np.uint32), (nth[on[last]] + 1).astype(np.uint32)))
    rows = {"route": [], "run": [], "low": [], "high": []}
    if marks:
        r, u, lo, hi = (np.concatenate(x) for x in zip(*marks, strict=True))
        for v, own in _by_route(r):
            rows["route"].append(v)
            for name, x in (("run", u), ("low", lo), ("high", hi)):
                rows[name].append(x[own].tobytes())
    return pa.table([pa.array(v, t) for v, t in zip(rows.values(), [pa.int32(), pa.binary(), pa.binary(), pa.binary()], strict=True)], names=list(rows))


def _cut(left: pa.Table, right: pa.Table) -> pa.Table:
    """The contract's row of each document of a chunk."""
    rows = {n: [] for n in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")}
    if len(left):
        table = in_order(left.select(["doc_id", "text"]))
        ids = table["doc_id"].to_pylist()
        repeats = _joined(right["repeats"], np.uint32) if len(right) else np.zeros(0, np.uint32)
        marks = [_joined(right[n], np.uint32) if len(right) else np.zeros(0, np.uint32) for n in ("run", "low", "high")]
        order = np.argsort(marks[0], kind="stable")
        marks = [m[order].astype(np.int64) for m in marks]
        packed = _packed(table)
        repeated = ~_first_in_chunk(packed)[2]
        repeated[repeats] = True
        for texts, runs, number in packed:
            n = len(texts.data)
            delta = np.zeros(n + 1, np.int32)
            own = np.flatnonzero(repeated[number : number + len(runs)])
            low, high = ([], [])
            if len(own):
                low.append(runs.begin[own])
                high.append(runs.begin[own] + runs.count[own] - 1 + LENGTH)
            a, b = np.searchsorted(marks[0], number), np.searchsorted(marks[0], number + len(runs))
            if b > a:
                base = runs.begin[marks[0][a:b] - number]
                low.append(base + marks[1][a:b])
                high.append(base + marks[2][a:b] - 1 + LENGTH)
            for x in low:
                np.add.at(delta, x, 1)
            for x in high:
                np.add.at(delta, x, -1)
            gone = np.cumsum(delta[:-1]) > 0
            edge = gone.copy()
            edge[1:] &= ~gone[:-1]
            starts = texts.offsets[:-1][texts.offsets[:-1] < n]
            edge[starts] = gone[starts]
            for i in range(len(texts)):
                s, e = int(texts.offsets[i]), int(texts.offsets[i + 1])
                rows["doc_id"].append(ids[texts.first + i])
                rows["n_bytes"].append(e - s)
                rows["n_removed"].append(int(gone[s:e].sum()))
                rows["n_spans"].append(int(edge[s:e].sum()))
                rows["kept_sha256"].append(hashlib.sha256(texts.data[s:e][~gone[s:e]].tobytes()).hexdigest())
    return pa.table([pa.array(v, t) for v, t in zip(rows.values(), [pa.int64()] * 4 + [pa.string()], strict=True)], names=list(rows))


def report(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    docs, routes = dealt(documents)
    # about one run for 33 bytes, 20 bytes each
    buckets = parts_for(routes * (16 << 20) * 20 // 33, BUCKET_BYTES)
    entries = docs.groupBy("route").applyInArrow(_entries(buckets), _ENTRY)
    replies = entries.groupBy("bucket").applyInArrow(_match, _REPLY)
    opened = docs.groupBy("route").cogroup(replies.groupBy("route")).applyInArrow(_contexts(buckets), _OPEN)
    marks = opened.groupBy("bucket").applyInArrow(_sort_blocks, _MARK)
    none = F.lit(None).cast("binary")
    both = replies.select("route", "repeats", none.alias("run"), none.alias("low"), none.alias("high")).unionByName(marks.withColumn("repeats", none))
    empty = F.lit(b"")
    both = both.select("route", *[F.coalesce(c, empty).alias(c) for c in ("repeats", "run", "low", "high")])
    return docs.groupBy("route").cogroup(both.groupBy("route")).applyInArrow(_cut, _OUT)
