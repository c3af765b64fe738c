"""Fuzzy repeated passages by collinear chaining.

1. Seeds are five-word shingles: those of small hash, which an edit elsewhere does not change, and the least of every
   WINNOW consecutive ones, so that no stretch is without one.
2. A seed of at most FEW documents joins each of them with every earlier one. One of more documents joins them with the
   first, and goes on in longer keys of several frequent seeds in a row, which are matched likewise; the longest keys are
   about a passage long, so that their first document mostly is a source (not where it holds less than a passage of the
   words). So matches grow with the seeds and not with the pairs of a group. No task gathers a frequent seed: what a
   stretch of rows shows to be frequent goes around the buckets in which seeds meet, and its rows later meet one row, in
   a join that Spark can split.
3. Matches of two documents on one diagonal merge into segments, which are chained: in order of the later document,
   a segment follows the best one that ends before it in both, its score less GAP per word skipped on either side. A
   Fenwick tree over the ends in the earlier document holds those scores. A chain is parted where it skips more than
   MARGIN words.
4. Each chain's words are aligned (greedy differences, without a limit on them) and its ends extended over small
   differences. A passage is an alignment of at least LEAST_WORDS words of which IDENTITY are equal.

Passages are reported in the later document, with their source in an earlier one; the first occurrence stays. Documents
are in order of doc_id, those that share one in order of a hash of their text. Defined results: null and short texts have
no passages; rows alike in doc_id and text are one document; rows of null doc_id take no part (and are kept as they are
by cut_passages); repeats inside one document are not passages; extra columns are not read. Words as in tokens. Results
don't depend on how rows are dealt into partitions.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .alignment import matched_runs
from .store import parts_for, written

SHINGLE, WINNOW = 5, 16
#: Share of the shingles that are seeds by their hash.
SHARE = 0.3
#: Documents of a seed of which each is matched with every earlier one.
FEW = 6
#: Keys of more frequent seeds: how many of the keys before make one, how far apart in their order, most words between ends.
LONGER = ((4, 1, 160), (3, 4, 400))
GAP = 0.05
#: Words a chain must cover, less its gaps, to be aligned.
LEAST_SCORE = 9.0
LEAST_WORDS = 40
IDENTITY = 0.8
#: Words without a seed that part a chain, and words beyond its ends that its alignment may take in.
MARGIN = 64
#: Seeds that are packed at a time, bytes of text whose seeds one bucket is planned to hold, and rows of a Python group.
STRETCH, BUCKET_TEXT, GROUP_ROWS = 200_000, 12 << 20, 150_000

#: Packed seeds of a bucket: hashes, documents and the first seed of each, occurrence numbers, places.
_PACKED = "bucket int, kind int, h binary, docs binary, starts binary, o binary, a binary"
#: Seeds in few documents, those that a stretch shows to be frequent, and word of the latter to their buckets.
_RARE, _FREQUENT, _NOTICE = 0, 1, 2
#: A match (h null), or a row of a frequent seed: its places in a document.
_MET = "h long, doc_id long, t long, source long, s long, x int, y int, n int, places array<struct<a:int,b:int>>"
_MATCH = "doc_id long, t long, source long, s long, x int, y int, n int"
#: The chains of two documents, best first: from [a, b) of the later one to [c, d) of the other.
_CHAIN = "doc_id long, t long, source long, s long, a array<int>, b array<int>, c array<int>, d array<int>"


def seeds_of(w: tokens.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, word, hash) of the seeds of some texts, in order of place."""
    h = tokens.shingles(w.hash, SHINGLE)
    none = np.zeros(0, np.int64)
    if not len(h):
        return none, none, np.zeros(0, np.uint64)
    text = w.text[: len(h)]
    inside = text == w.text[SHINGLE - 1 : SHINGLE - 1 + len(h)]
    least, width = np.where(inside, h, np.uint64(0xFFFFFFFFFFFFFFFF)), 1
    least = np.concatenate([least, np.full(WINNOW, 0xFFFFFFFFFFFFFFFF, np.uint64)])
    at = np.arange(len(least), dtype=np.int64)
    while width < WINNOW:
        left = least[:-width] <= least[width:]
        least, at = np.where(left, least[:-width], least[width:]), np.where(left, at[:-width], at[width:])
        width *= 2
    picked = inside & (h < np.uint64(int(SHARE * 2**64)))
    # of each WINNOW shingles that all are one text's, the least
    whole = np.flatnonzero(inside[: len(h) - WINNOW + 1] & inside[WINNOW - 1 :] & (text[: len(h) - WINNOW + 1] == text[WINNOW - 1 :])) if len(h) >= WINNOW else none
    picked[at[whole]] = True
    chosen = np.flatnonzero(picked)
    return text[chosen], chosen - w.first[text[chosen]], h[chosen]


def _packs(doc: np.ndarray, t: np.ndarray, o: np.ndarray, a: np.ndarray, h: np.ndarray, bucket: np.ndarray, kind: int):
    """Rows of _PACKED, one for each bucket that has seeds; within it seeds are in order of document and place."""
    order = np.lexsort((a, t, doc, bucket))
    doc, t, o, a, h, bucket = (v[order] for v in (doc, t, o, a, h, bucket))
    limits = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    for lo, hi in zip(limits.tolist(), [*limits[1:].tolist(), len(h)], strict=True):
        d, u = doc[lo:hi], t[lo:hi]
        new = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (u[1:] != u[:-1]))))
        docs = np.stack([d[new], u[new]])
        yield int(bucket[lo]), kind, h[lo:hi].tobytes(), docs.tobytes(), new.astype(np.uint32).tobytes(), _planes(o[lo:hi]), _planes(a[lo:hi])


def _planes(values: np.ndarray) -> bytes:
    """Low halves, then high halves, of 32-bit numbers: the high ones are mostly zero and compress away."""
    v = values.astype(np.uint32)
    return (v & np.uint32(0xFFFF)).astype(np.uint16).tobytes() + (v >> np.uint32(16)).astype(np.uint16).tobytes()


def _unplanes(raw: bytes) -> np.ndarray:
    v = np.frombuffer(raw, np.uint16).astype(np.int64)
    n = len(v) // 2
    return v[:n] | (v[n:] << 16)


def _unpacked(table: pa.Table) -> tuple[np.ndarray, ...]:
    """h, doc_id, t, o, a of packed seeds."""
    parts = []
    for h, docs, starts, o, a in zip(*(table[n].to_pylist() for n in ("h", "docs", "starts", "o", "a")), strict=True):
        h, docs, starts = np.frombuffer(h, np.int64), np.frombuffer(docs, np.int64).reshape(2, -1), np.frombuffer(starts, np.uint32)
        size = np.diff(np.append(starts, len(h)).astype(np.int64))
        parts.append((h, np.repeat(docs[0], size), np.repeat(docs[1], size), _unplanes(o), _unplanes(a)))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 5


def _packed_seeds(buckets: int):
    """Seeds for the bucket of their hash. A seed of more than FEW documents in one stretch is frequent for certain: its
    rows go to any bucket, and the bucket of its hash has notice."""

    def flush(parts: list[tuple]) -> pa.RecordBatch:
        doc, t, a, h = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((a, t, doc, h))
        doc, t, a, h = (v[order] for v in (doc, t, a, h))
        seed = np.concatenate(([True], h[1:] != h[:-1]))
        turn = seed | np.concatenate(([True], (doc[1:] != doc[:-1]) | (t[1:] != t[:-1])))
        at = np.arange(len(h))
        o = at - np.maximum.accumulate(np.where(turn, at, 0))
        group = np.cumsum(seed) - 1
        often = (np.bincount(group, turn) > FEW)[group]
        bucket = (h.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
        rows = []
        for own, kind, to in ((~often, _RARE, bucket), (often, _FREQUENT, at // max(1, len(at) // 4) + int(h[0] & 0xFFFF)), (often & seed, _NOTICE, bucket)):
            if own.any():
                to = to[own] % buckets
                rows += _packs(doc[own], t[own], o[own], a[own], h[own], to, kind)
        names = [x.split()[0] for x in _PACKED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n in ("bucket", "kind") else pa.binary()) for n, c in zip(names, zip(*rows, strict=True), strict=True)], names=names)

    def run(batches):
        parts, held = [], 0
        for batch in batches:
            ids, hashes = batch.column("doc_id").to_numpy(), batch.column("t").to_numpy()
            for texts in tokens.steps(batch.column("text")):
                text, word, h = seeds_of(tokens.words(texts))
                row = text + texts.first
                parts.append((ids[row], hashes[row], word, h.view(np.int64)))
                held += len(h)
                if held >= STRETCH:
                    yield flush(parts)
                    parts, held = [], 0
        if held:
            yield flush(parts)

    return run


def _meet(table: pa.Table) -> pa.Table:
    """Matches of the seeds of few documents, and the rows of frequent ones."""
    kind = table["kind"].to_numpy()
    h, doc, t, o, a = _unpacked(table.filter(pa.array(kind == _RARE)))
    notice = np.unique(_unpacked(table.filter(pa.array(kind == _NOTICE)))[0])
    order = np.lexsort((o, t, doc, h))
    h, doc, t, o, a = (v[order] for v in (h, doc, t, o, a))
    seed = np.concatenate(([True], h[1:] != h[:-1])) if len(h) else np.zeros(0, bool)
    group = np.cumsum(seed) - 1
    docs = np.bincount(group, o == 0)[group] if len(h) else np.zeros(0)
    often = (docs > FEW) | np.isin(h, notice)
    few = (docs > 1) & ~often
    match = _pairs(h[few], doc[few], t[few], o[few], a[few], a[few] + SHINGLE)
    fh, fd, ft, _, fa = (np.concatenate(x) for x in zip((h[often], doc[often], t[often], o[often], a[often]), _unpacked(table.filter(pa.array(kind == _FREQUENT))), strict=True))
    # a row for each frequent seed and document, with its places in order
    order = np.lexsort((fa, ft, fd, fh))
    fh, fd, ft, fa = (v[order] for v in (fh, fd, ft, fa))
    new = np.flatnonzero(np.concatenate(([True], (fh[1:] != fh[:-1]) | (fd[1:] != fd[:-1]) | (ft[1:] != ft[:-1])))) if len(fh) else np.zeros(0, np.int64)
    spans = pa.StructArray.from_arrays([pa.array(fa.astype(np.int32)), pa.array((fa + SHINGLE).astype(np.int32))], names=["a", "b"])
    places = pa.ListArray.from_arrays(pa.array(np.append(new, len(fh)).astype(np.int32)), spans)
    n, k = len(match[0]), len(new)
    both = lambda u, v, kind: pa.concat_arrays([pa.nulls(n, kind) if u is None else pa.array(u.astype(kind.to_pandas_dtype())), pa.nulls(k, kind) if v is None else pa.array(v)])
    columns = [both(None, fh[new], pa.int64()), both(match[0], fd[new], pa.int64()), both(match[1], ft[new], pa.int64())]
    columns += [both(match[2], None, pa.int64()), both(match[3], None, pa.int64()), *(both(m, None, pa.int32()) for m in match[4:])]
    columns.append(pa.concat_arrays([pa.nulls(n, places.type), places]))
    return pa.table(columns, names=[x.split()[0] for x in _MET.split(", ")])


def _pairs(h: np.ndarray, doc: np.ndarray, t: np.ndarray, o: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Columns of _MATCH: each document of a key with every earlier one, at its first place there and that of equal rank.
    Rows come in order of key, document, occurrence."""
    new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]) | (t[1:] != t[:-1])))) if len(h) else np.zeros(0, np.int64)
    size = np.diff(np.append(new, len(h)))
    out = []
    for back in range(1, FEW):
        run = np.arange(back, len(new))
        run = run[h[new[run]] == h[new[run - back]]]  # of the key's documents, the one so many before
        if not len(run):
            break
        later = np.repeat(new[run], size[run]) + np.arange(size[run].sum()) - np.repeat(np.cumsum(size[run]) - size[run], size[run])
        source, most = np.repeat(new[run - back], size[run]), np.repeat(size[run - back], size[run])
        same = source + np.minimum(o[later], most - 1)
        twice = same != source
        out.append((np.concatenate([later, later[twice]]), np.concatenate([source, same[twice]])))
    i, j = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 2
    return doc[i], t[i], doc[j], t[j], a[i], a[j], np.minimum(b[i] - a[i], b[j] - a[j])


def _pair_groups(table: pa.Table) -> pa.Table:
    """Matches of the rows of rare longer keys."""
    columns = [table[n].to_numpy() for n in ("h", "doc_id", "t", "o", "a", "b")]
    order = np.lexsort((columns[3], columns[2], columns[1], columns[0]))
    found = _pairs(*(c[order] for c in columns))
    return pa.table([pa.array(c) for c in found], names=[x.split()[0] for x in _MATCH.split(", ")])


def _same(left: str, right: str) -> Column:
    return F.col(left) == F.col(right)


def _with_first(hot: DataFrame) -> DataFrame:
    """Matches of the documents of frequent keys with the first document of each: every place with the first place there
    and with that of equal rank."""
    rows = hot.where("not (doc_id = first.doc_id and t = first.t)").select("doc_id", "t", "places", F.col("first.doc_id").alias("source"), F.col("first.t").alias("s"), F.col("first.places").alias("there"))
    match = lambda p, q: F.struct(p["a"].alias("x"), q["a"].alias("y"), F.least(p["b"] - p["a"], q["b"] - q["a"]).alias("n"))
    heads = F.transform("places", lambda p: match(p, F.get("there", F.lit(0))))
    second = F.slice("places", F.lit(2), F.greatest(F.lit(0), F.least(F.size("places"), F.size("there")) - 1))
    ranks = F.transform(second, lambda p, i: match(p, F.get("there", i + 1)))
    return rows.select("doc_id", "t", "source", "s", F.explode(F.concat(heads, ranks)).alias("m")).select("doc_id", "t", "source", "s", "m.x", "m.y", "m.n")


def _longer(hot: DataFrame, count: int, step: int, most: int) -> DataFrame:
    """h, doc_id, t, places of keys made of `count` of a document's keys, each `step` after the one before in order of place."""
    place = Window.partitionBy("doc_id", "t").orderBy("at", "h")
    rows = hot.select("h", "doc_id", "t", F.explode("places").alias("at"))
    rows = rows.select("doc_id", "t", "h", "at", *[F.lead(F.struct("h", "at.b"), i * step).over(place).alias(f"h{i}") for i in range(1, count)])
    last = F.col(f"h{count - 1}")
    rows = rows.where(last.isNotNull() & (last["b"] - F.col("at.a") <= most))
    key = F.xxhash64("h", *[F.col(f"h{i}.h") for i in range(1, count)])
    rows = rows.select(key.alias("h"), "doc_id", "t", F.struct(F.col("at.a"), last["b"].alias("b")).alias("at"))
    return rows.groupBy("doc_id", "t", "h").agg(F.sort_array(F.collect_list("at")).alias("places")).select("h", "doc_id", "t", "places")


def _counted(keys: DataFrame, name: str) -> DataFrame:
    """Rows of keys of several documents, with their number (docs) and the first of them."""
    of = keys.groupBy("h").agg(F.count(F.lit(1)).alias("docs"), F.min(F.struct("doc_id", "t", "places")).alias("first")).where("docs > 1")
    of = written(of.withColumnRenamed("h", "k"), f"{name}-firsts")  # read from files, the side that a hot key meets has one row
    return written(keys.join(of, _same("h", "k")).drop("k"), name)


def _matches(docs: DataFrame, text_bytes: int) -> tuple[DataFrame, int]:
    """doc_id, t, source, s, x, y, n: n words from x of a document and from y of an earlier one that may be alike; and
    about how many rows these are."""
    packed = docs.mapInArrow(_packed_seeds(parts_for(text_bytes, BUCKET_TEXT)), _PACKED)
    met = written(packed.groupBy("bucket").applyInArrow(_meet, _MET), "met")
    found, rows = met.where("h is null").drop("h", "places"), met.count()
    hot = met.where("h is not null").select("h", "doc_id", "t", "places")
    if hot.isEmpty():
        return found, rows
    hot = _counted(hot, "frequent")
    places = lambda df: 2 * (df.agg(F.sum(F.size("places")).alias("n")).first()["n"] or 0)
    for count, step, most in LONGER:
        rows += places(hot)
        found = found.unionByName(_with_first(hot))
        shared = _counted(_longer(hot, count, step, most), "longer")
        few = shared.where(F.col("docs") <= FEW).select("h", "doc_id", "t", F.posexplode("places").alias("o", "at")).select("h", "doc_id", "t", "o", "at.a", "at.b")
        n = few.count()
        rows += 2 * n
        found = found.unionByName(few.groupBy(F.pmod("h", F.lit(parts_for(n, GROUP_ROWS))).alias("group")).applyInArrow(_pair_groups, _MATCH))
        hot = shared.where(F.col("docs") > FEW)
    return found.unionByName(_with_first(hot)), rows + places(hot)


class Fenwick:
    """Largest (score, segment) over the places up to one."""

    def __init__(self, n: int):
        self.best: list[tuple[float, int]] = [(-1e18, -1)] * (n + 1)

    def put(self, i: int, value: tuple[float, int]) -> None:
        i += 1
        while i < len(self.best):
            if value > self.best[i]:
                self.best[i] = value
            i += i & -i

    def upto(self, i: int) -> tuple[float, int]:
        """Over places 0 .. i - 1."""
        top = (-1e18, -1)
        while i > 0:
            if self.best[i] > top:
                top = self.best[i]
            i -= i & -i
        return top


def chain(x0: list[int], x1: list[int], y0: list[int], y1: list[int], gap: float = GAP) -> list[tuple[list[int], float]]:
    """Chains (segments in order, score) of segments [x0, x1) x [y0, y1), best first; no segment is in two chains.

    Segments are taken by x0; one that ends at (x1, y1) waits until x reaches x1 and is then found by its y1. The gap
    cost is linear, so the best predecessor has the largest score + gap * (x1 + y1)."""
    n = len(x0)
    order = sorted(range(n), key=lambda i: (x0[i], y0[i]))
    ends = sorted(range(n), key=lambda i: x1[i])
    places = sorted({*y1})
    place = {v: i for i, v in enumerate(places)}
    tree, score, back, waiting = Fenwick(len(places)), [0.0] * n, [-1] * n, 0
    done = [False] * n
    for i in order:
        while waiting < n and x1[ends[waiting]] <= x0[i]:
            j = ends[waiting]
            if done[j]:
                tree.put(place[y1[j]], (score[j] + gap * (x1[j] + y1[j]), j))
            waiting += 1
        own = float(min(x1[i] - x0[i], y1[i] - y0[i]))
        best, j = tree.upto(bisect_right(places, y0[i]))
        gain = best - gap * (x0[i] + y0[i])
        score[i], back[i] = (own + gain, j) if j >= 0 and gain > 0 else (own, -1)
        done[i] = True
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda i: -score[i]):
        if used[i]:
            continue
        path, j = [], i
        while j >= 0 and not used[j]:
            used[j] = True
            path.append(j)
            j = back[j]
        out.append((path[::-1], score[i] - (score[j] if j >= 0 else 0.0)))
    return out


def _chains(table: pa.Table) -> pa.Table:
    d, t, s, u, x, y, n = (table[c].to_numpy().astype(np.int64) for c in ("doc_id", "t", "source", "s", "x", "y", "n"))
    diagonal = x - y
    order = np.lexsort((n, x, diagonal, u, s, t, d))
    d, t, s, u, x, y, n, diagonal = (v[order] for v in (d, t, s, u, x, y, n, diagonal))
    line = np.concatenate(([True], (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (s[1:] != s[:-1]) | (u[1:] != u[:-1]) | (diagonal[1:] != diagonal[:-1])))
    # matches of one line that overlap or are close are one segment
    number = np.cumsum(line) - 1
    shift = number * (1 << 32)  # a running maximum that starts anew with each line
    reach = np.maximum.accumulate(x + n + shift) - shift
    new = line.copy()
    new[1:] |= x[1:] > reach[:-1] + SHINGLE
    at = np.flatnonzero(new)
    end = np.append(at[1:], len(x)) - 1
    d, t, s, u, x0, y0, x1 = d[at], t[at], s[at], u[at], x[at], y[at], reach[end]
    y1 = y0 + x1 - x0
    order = np.lexsort((y0, x0, u, s, t, d))
    d, t, s, u, x0, y0, x1, y1 = (v[order] for v in (d, t, s, u, x0, y0, x1, y1))
    turn = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (s[1:] != s[:-1]) | (u[1:] != u[:-1]))))
    total = np.add.reduceat(x1 - x0, turn)
    rows = []
    for lo, hi, sum_ in zip(turn.tolist(), [*turn[1:].tolist(), len(d)], total.tolist(), strict=True):
        if sum_ < LEAST_SCORE:
            continue
        own = [v[lo:hi].tolist() for v in (x0, x1, y0, y1)]
        parts = [p for path, _ in (chain(*own) if hi - lo > 1 else [([0], 0.0)]) for p in parted(path, *own)]
        kept = [p for p, score in uncovered(sorted(parts, key=lambda p: (-p[1], p[0])), own[0], own[1]) if score >= LEAST_SCORE]
        if kept:
            ends = ([own[n][p[i]] for p in kept] for n, i in ((0, 0), (1, -1), (2, 0), (3, -1)))
            rows.append((d[lo], t[lo], s[lo], u[lo], *ends))
    kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())] * 4
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _CHAIN.split(", ")])


def parted(path: list[int], x0: list[int], x1: list[int], y0: list[int], y1: list[int]):
    """(segments, score) of the parts of a chain between gaps of more than MARGIN words."""
    part, score = [path[0]], float(min(x1[path[0]] - x0[path[0]], y1[path[0]] - y0[path[0]]))
    for j, i in zip(path, path[1:], strict=False):
        skip = (x0[i] - x1[j], y0[i] - y1[j])
        own = float(min(x1[i] - x0[i], y1[i] - y0[i]))
        if max(skip) > MARGIN:
            yield part, score
            part, score = [i], own
        else:
            part, score = [*part, i], score + own - GAP * sum(skip)
    yield part, score


def uncovered(parts: list[tuple[list[int], float]], x0: list[int], x1: list[int]):
    """Those parts, best first, that hold more than words which equal words of a better one cover already, where that
    has as many equal words as a passage needs. A text that repeats itself has many such parts in every source."""
    covered: list[tuple[int, int]] = []  # disjoint, in order
    for part, score in parts:
        for i in part:
            at = bisect_right(covered, (x0[i], 1 << 62)) - 1
            if at < 0 or covered[at][1] < x1[i]:
                break
        else:
            continue
        yield part, score
        if score >= LEAST_WORDS * IDENTITY:
            spans = sorted([*covered, *((x0[i], x1[i]) for i in part)])
            covered = []
            for lo, hi in spans:
                if covered and lo <= covered[-1][1]:
                    covered[-1] = (covered[-1][0], max(hi, covered[-1][1]))
                else:
                    covered.append((lo, hi))


def _short(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype(np.uint32)


class _Recent:
    """Words of texts by document; joined rows come sorted, so the same document follows itself."""

    def __init__(self):
        self.key, self.value = None, None

    def words(self, key, text) -> tokens.Words:
        if key != self.key:
            raw = text.as_buffer()
            data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
            self.key, self.value = key, tokens.words(tokens.Texts(data, np.array([0, len(data)], np.int64), 0))
        return self.value


def _fetch(batches):
    """The words of the source around its chains with a document."""
    recent = _Recent()
    for batch in batches:
        c, d, source, same = (batch.column(n).to_pylist() for n in ("c", "d", "source", "s"))
        text, regions, start = batch.column("text"), [], []
        for i in range(batch.num_rows):
            w = recent.words((source[i], same[i]), text[i])
            lo = max(0, min(c[i]) - MARGIN)
            regions.append(_short(w.hash[lo : max(d[i]) + MARGIN]).tobytes())
            start.append(lo)
        names = [x.split()[0] for x in _CHAIN.split(", ")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(start, pa.int32()), pa.array(regions, pa.binary())], names=[*names, "region_start", "region"])


def _extend(a: np.ndarray, i: int, b: np.ndarray, j: int, step: int) -> tuple[int, int, int]:
    """How far equal words go on from a[i], b[j] in direction step, over small differences: words of a, of b, equal."""
    u = v = equal = 0
    n = (len(a) - i) if step > 0 else i + 1
    m = (len(b) - j) if step > 0 else j + 1
    x, y = (a[i:], b[j:]) if step > 0 else (a[: i + 1][::-1], b[: j + 1][::-1])
    while True:
        k = min(n - u, m - v)
        differ = np.flatnonzero(x[u : u + k] != y[v : v + k])
        run = int(differ[0]) if len(differ) else k
        u, v, equal = u + run, v + run, equal + run
        for p, q in ((1, 1), (1, 0), (0, 1), (2, 2), (2, 1), (1, 2)):
            if n - u - p >= 3 and m - v - q >= 3 and (x[u + p : u + p + 3] == y[v + q : v + q + 3]).all():
                u, v = u + p, v + q
                break
        else:
            return u, v, equal


def _stretches(runs: list[tuple[int, int, int]]):
    """Slices of runs, each the best stretch from where it starts when an equal word counts 1 and a word that either
    side skips -2; so 80 % of the words of a stretch are equal."""
    i = 0
    while i < len(runs):
        level = best = runs[i][2]
        end = j = i
        while j + 1 < len(runs):
            (x, y, n), (u, v, m) = runs[j], runs[j + 1]
            level -= 2 * (u - x - n + v - y - n)
            if level <= 0:
                break
            j += 1
            level += m
            if level > best:
                best, end = level, j
        yield runs[i : end + 1]
        i = end + 1


def align(a: np.ndarray, lo: int, hi: int, b: np.ndarray, c: int, d: int) -> list[tuple[int, int, int, int, float]]:
    """Passages around the chain [lo, hi) of a and [c, d) of b: their ends in both and the share of equal words."""
    runs = matched_runs(a[lo:hi], b[c:d], hi - lo + d - c)
    out, parts = [], list(_stretches(runs))
    for n, part in enumerate(parts):
        p, q = lo + part[0][0], lo + part[-1][0] + part[-1][2]
        r, s = c + part[0][1], c + part[-1][1] + part[-1][2]
        equal = sum(x[2] for x in part)
        if n == 0 and p > 0 and r > 0:
            u, v, e = _extend(a, p - 1, b, r - 1, -1)
            p, r, equal = p - u, r - v, equal + e
        if n == len(parts) - 1 and q < len(a) and s < len(b):
            u, v, e = _extend(a, q, b, s, 1)
            q, s, equal = q + u, s + v, equal + e
        out.append((p, q, r, s, 2 * equal / max(q - p + s - r, 1)))
    return out


_FOUND = "doc_id long, start_word int, n_words int, start_byte int, end_byte int, source_doc_id long, source_start_word int, source_n_words int, identity double, text_hash long"


def _align(batches):
    recent = _Recent()
    names = ("doc_id", "t", "source", "a", "b", "c", "d", "region_start", "region")
    for batch in batches:
        rows, text = [], batch.column("text")
        for i, (doc, t, source, begins, ends, there, upto, base, region) in enumerate(zip(*(batch.column(n).to_pylist() for n in names), strict=True)):
            w, region, found = recent.words((doc, t), text[i]), np.frombuffer(region, np.uint32), []
            known = set(region.tolist())
            for a, b, c, d in zip(begins, ends, there, upto, strict=True):
                if any(p <= a and b <= p + n for _, p, n, *_ in found):
                    continue  # a better chain's passage has these words already
                lo, low = max(0, a - MARGIN), max(0, c - base - MARGIN)
                own, other = _short(w.hash[lo : b + MARGIN]), region[low : d - base + MARGIN]
                # no passage without as many words of its own that the region has at all
                if sum(map(known.__contains__, own.tolist())) < LEAST_WORDS * IDENTITY * IDENTITY:
                    continue
                for p, q, r, s, same in align(own, a - lo, min(b - lo, len(own)), other, c - base - low, min(d - base - low, len(other))):
                    if same >= IDENTITY and q - p >= LEAST_WORDS:
                        found.append((doc, p + lo, q - p, int(w.start[p + lo]), int(w.end[q + lo - 1]), source, r + base + low, s - r, same, t))
            rows += found
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int64()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 10
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _FOUND.split(", ")])


def passages(documents: DataFrame) -> DataFrame:
    """A row per repeated passage: where it is in doc_id (words and UTF-8 bytes) and in its earlier source; text_hash
    is of the text that the places count in."""
    docs = documents.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"), F.coalesce("text", F.lit("")).alias("text"))
    # where rows repeat, the documents are written once each; else they are read as they are, and the joins below,
    # straight over shuffled rows, are ones whose hot documents Spark can split
    n = docs.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("doc_id", "t").alias("ids"), F.sum(F.octet_length("text")).alias("bytes")).first()
    docs = docs if n["rows"] == n["ids"] else written(docs.groupBy("doc_id", "t").agg(F.min("text").alias("text")), "documents")
    matches, rows = _matches(docs, n["bytes"] or 0)
    groups = parts_for(rows, GROUP_ROWS)
    chains = written(matches.groupBy(F.pmod(F.xxhash64("doc_id", "t", "source", "s"), F.lit(groups)).alias("group")).applyInArrow(_chains, _CHAIN), "chains")
    text = docs.select(F.col("doc_id").alias("id"), F.col("t").alias("id_t"), "text")
    regions = chains.join(text, _same("source", "id") & _same("s", "id_t")).mapInArrow(_fetch, _CHAIN + ", region_start int, region binary")
    return regions.join(text, _same("doc_id", "id") & _same("t", "id_t")).mapInArrow(_align, _FOUND)


def _cutter(spans_name: str):
    def run(batches):
        for batch in batches:
            texts, keep = [], []
            for text, spans in zip(batch.column("text"), batch.column(spans_name), strict=True):
                if not (spans := spans.as_py()):
                    texts.append(text.as_py())
                    keep.append(True)
                    continue
                raw, at, parts = text.as_py().encode(), 0, []
                for s in sorted(spans, key=lambda s: (s["a"], s["b"])):
                    if s["a"] > at:
                        parts.append(raw[at : s["a"]])
                    at = max(at, s["b"])
                rest = b"".join([*parts, raw[at:]])
                data = np.frombuffer(rest, np.uint8)
                texts.append(rest.decode())
                keep.append(len(tokens.words(tokens.Texts(data, np.array([0, len(data)], np.int64), 0)).start) > 0)
            names = [n for n in batch.schema.names if n != spans_name]
            columns = [pa.array(texts, batch.column("text").type) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep))

    return run


def cut_passages(documents: DataFrame) -> DataFrame:
    """documents without their repeated passages (the first occurrence stays); n_chars follows the text.

    A document of which no word is left is dropped. Rows that share a doc_id are each cut by the places of their own text."""
    have = {c.lower() for c in documents.columns}
    name = next(n for n in ("spans" + "_" * i for i in range(99)) if n not in have)
    where = F.struct(F.col("start_byte").alias("a"), F.col("end_byte").alias("b"))
    found = passages(documents).groupBy(F.col("doc_id").alias("cut_id"), "text_hash").agg(F.collect_list(where).alias(name))
    joined = documents.join(found, (documents["doc_id"] == found["cut_id"]) & (F.xxhash64(documents["text"]) == found["text_hash"]), "left")
    rows = joined.select(*[documents[c] for c in documents.columns], found[name])
    out = rows.mapInArrow(_cutter(name), documents.schema)
    return out.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType)) if "n_chars" in documents.columns else out


def report(documents: DataFrame) -> DataFrame:
    return passages(documents).drop("text_hash")
