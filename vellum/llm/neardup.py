"""Near-duplicate documents by order MinHash.

A text's five-word shingles are labelled with their occurrence number, and each of BANDS hash functions takes the
MINIMA labelled shingles of least hash; those, in text order, make one key of the text. Texts share a key only where
the same shingles come in the same order, so keys follow edit similarity. A pair is a link if a banded alignment of
their words (greedy difference algorithm, band set by the threshold at every length) leaves at least SIMILARITY of
their shingles matched. Links make classes. Texts of one key are compared with its first document, then with one another
where links do not join them yet: in the end any two texts that share SHARED keys are compared or in one class.
So links are those that join classes, not all pairs of a class; n_links counts them.

Exact copies (same words) are one text from the start. Rows that share a doc_id are one document. Texts of fewer
than five words are one shingle. Texts without words are copies only of texts with the same bytes; null is the empty
text. A null doc_id is in no class (class_id null, class_size 1). Extra columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .alignment import matched_runs
from .graph import components
from .store import written

SHINGLE = 5
SIMILARITY = 0.8
#: A pair at the threshold shares a key of 3 minima with a chance of about one half: 20 keys miss one pair in a million.
BANDS, MINIMA = 20, 3
#: Keys that a compared pair shares. At the threshold 20 keys of chance one half give two or fewer once in 5,000 pairs.
SHARED = 3
#: Of a key's texts outside of its largest part, up to EACH are paired with all its texts by a join, up to WIDE in blocks of
#: BLOCK texts, more are first divided by further keys; before, for up to TURNS turns, single texts of such a key meet all others.
TURNS, EACH, WIDE, BLOCK = 2, 32, 20000, 512
#: Bins of a sketch, and the standard errors by which its estimate may fall below SIMILARITY (lost: 3 in 100,000 pairs).
BINS, ERRORS = 1024, 4.0
_SKETCH = "doc_id long, sig binary, n long, keys array<long>"


def occurrence_labels(values: np.ndarray, kind: str | None = "stable") -> np.ndarray:
    """How often each value came before; with another kind of sort, equal values are numbered in any order."""
    order = np.argsort(values, kind=kind)
    new = np.ones(len(values), bool)
    new[1:] = values[order][1:] != values[order][:-1]
    start = np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - start
    return out


def shingles_of(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the five-word shingles; of a shorter text, one for all its words."""
    return tokens.shingles(hashes, min(SHINGLE, len(hashes))) if len(hashes) else np.zeros(0, np.uint64)


_SEEDS = tokens.mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def _keys_from(labelled: np.ndarray) -> np.ndarray:
    """The BANDS keys of a text from its labelled shingles (at least one)."""
    take = min(MINIMA, len(labelled))
    h = (labelled[None, :] ^ _SEEDS[:, None]) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    at = np.sort(np.argpartition(h, take - 1, axis=1)[:, :take], axis=1) if len(labelled) > take else np.tile(np.arange(len(labelled)), (BANDS, 1))
    key = np.arange(BANDS, dtype=np.uint64) * np.uint64(8) + np.uint64(take)
    for c in range(take):
        key = tokens.mix(key * np.uint64(3) + labelled[at[:, c]])
    return key


def _bins_from(labelled: np.ndarray) -> bytes:
    """A byte of the least hash in each of BINS bins, 0 for a bin without any."""
    h = np.sort(tokens.mix(labelled ^ np.uint64(0x94D049BB133111EB)))
    at = (h >> np.uint64(54)).astype(np.int64)  # the top 10 bits: BINS = 1024
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    out = np.zeros(BINS, np.uint8)
    out[at[first]] = (h[first] % np.uint64(255)).astype(np.uint8) + 1
    return out.tobytes()


def _label(shingles: np.ndarray) -> np.ndarray:
    """Hashes of shingles with their occurrence numbers."""
    return tokens.mix(shingles + occurrence_labels(shingles).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))


def _sketch(batches):
    for batch in batches:
        for texts in tokens.steps(batch.column("text")):
            w, sig, n, keys = tokens.words(texts), [], [], []
            cut = w.first.tolist()
            for i in range(len(texts)):
                own = w.hash[cut[i] : cut[i + 1]]
                if not len(own):
                    sig.append(hashlib.md5(b"bytes" + texts.raw(i)).digest())
                    n.append(0)
                    keys.append([])
                    continue
                sig.append(hashlib.md5(own.tobytes()).digest())
                s = shingles_of(own)
                n.append(len(s))
                keys.append(_keys_from(_label(s)).view(np.int64))
            part = batch.slice(texts.first, len(texts))
            columns = [part.column("doc_id"), pa.array(sig, pa.binary()), pa.array(n, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "sig", "n", "keys"])


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Share of shingles that the alignment of two word sequences matches, or 0.0 where it can't reach `least`."""
    if np.array_equal(a, b):
        return 1.0
    if min(len(a), len(b)) < SHINGLE:
        return 0.0
    sa, sb = shingles_of(a), shingles_of(b)
    total = len(sa) + len(sb)
    need = least / (1 + least) * total  # matched / (total - matched) >= least
    if min(len(sa), len(sb)) < need - 1e-9:
        return 0.0
    va, ca = np.unique(sa, return_counts=True)
    vb, cb = np.unique(sb, return_counts=True)
    _, x, y = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    if np.minimum(ca[x], cb[y]).sum() < need - 1e-9:  # no alignment matches more shingles than the texts share
        return 0.0
    most = int(len(a) + len(b) - 2 * (need + SHINGLE - 1) + 1e-6)
    if (runs := matched_runs(a, b, max(0, most))) is None:
        return 0.0
    matched = sum(max(0, n - SHINGLE + 1) for _, _, n in runs)
    value = matched / (total - matched)
    return value if value >= least - 1e-12 else 0.0


def _labelled(w: tokens.Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle hash that is the same only for the same text number, shingle and occurrence) of some texts."""
    h = tokens.shingles(w.hash, SHINGLE)
    text = w.text[: len(h)]
    inside = text == w.text[SHINGLE - 1 : SHINGLE - 1 + len(h)]
    text = text[inside]
    z = tokens.mix(h[inside] ^ tokens.mix(text.astype(np.uint64) + np.uint64(1)))
    return text, tokens.mix(z + occurrence_labels(z, None).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))


def may_be_links(wa: tokens.Words, wb: tokens.Words) -> np.ndarray:
    """Which pairs (text i of a, text i of b) share enough shingles for SIMILARITY, in any order of them."""
    n = len(wa.first) - 1
    (ta, za), (tb, zb) = _labelled(wa), _labelled(wb)
    _, at, _ = np.intersect1d(za, zb, assume_unique=True, return_indices=True)
    shared, total = np.bincount(ta[at], minlength=n), np.bincount(ta, minlength=n) + np.bincount(tb, minlength=n)
    return (shared >= SIMILARITY * (total - shared) - 1e-6) | (total == 0)


def _verify(batches):
    for batch in batches:
        for texts in tokens.steps(batch.column("text_a"), most=256):
            part = batch.slice(texts.first, len(texts))
            wa = tokens.words(texts)
            for other in tokens.steps(part.column("text_b")):
                own = part.slice(other.first, len(other))
                lo, hi = other.first, other.first + len(other)
                wb = tokens.words(other)
                a0, a1 = int(wa.first[lo]), int(wa.first[hi])
                cut = tokens.Words(wa.start[a0:a1], wa.end[a0:a1], wa.hash[a0:a1], wa.text[a0:a1] - lo, wa.first[lo : hi + 1] - a0, wa.lower)
                score = np.zeros(len(other))
                for i in np.flatnonzero(may_be_links(cut, wb)).tolist():
                    score[i] = similarity(cut.hash[cut.first[i] : cut.first[i + 1]], wb.hash[wb.first[i] : wb.first[i + 1]])
                keep = pa.array(score > 0)
                yield pa.RecordBatch.from_arrays([own.column("a").filter(keep), own.column("b").filter(keep), pa.array(score[score > 0])], names=["a", "b", "similarity"])


def sketches(documents: DataFrame) -> DataFrame:
    """doc_id, sig (of the words), n (shingles), keys."""
    docs = documents.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return docs.mapInArrow(_sketch, _SKETCH)


def _verified(pairs: DataFrame, documents: DataFrame) -> DataFrame:
    """a, b, similarity of those pairs (a, b) that are links."""
    text = documents.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    # joins on ids, whose hot sides Spark splits: a document that very many resemble is read by many tasks
    with_b = pairs.join(text, F.col("b") == F.col("id")).select("a", "b", F.col("text").alias("text_b"))
    both = with_b.join(text, F.col("a") == F.col("id")).select("a", "b", F.col("text").alias("text_a"), "text_b")
    return both.mapInArrow(_verify, "a long, b long, similarity double")


def _plausible(pairs: DataFrame, reps: DataFrame, least: int) -> DataFrame:
    """Those pairs (a, b) that share at least `least` keys, before any text is fetched."""
    if least < 2:
        return pairs
    keys = reps.groupBy("rep").agg(F.flatten(F.collect_list("keys")).alias("keys"))
    a, b = (keys.select(F.col("rep").alias(f"{x}_id"), F.col("keys").alias(f"{x}_keys")) for x in "ab")
    met = pairs.join(a, F.col("a") == F.col("a_id")).join(b, F.col("b") == F.col("b_id"))
    return met.where(F.size(F.array_intersect("a_keys", "b_keys")) >= least).select("a", "b")


def _across(open_: DataFrame, others: DataFrame) -> DataFrame:
    """Pairs a < b of a key's texts that no links join and whose numbers of shingles can reach SIMILARITY."""
    other = others.select(F.col("key").alias("k"), F.col("rep").alias("r"), F.col("part").alias("p"), F.col("n").alias("m"))
    near = F.least("n", "m") >= SIMILARITY * F.greatest("n", "m") - 1e-9
    met = open_.join(other, (F.col("key") == F.col("k")) & (F.col("part") != F.col("p")) & (F.col("rep") != F.col("r")) & near)
    return met.select(F.least("rep", "r").alias("a"), F.greatest("rep", "r").alias("b")).distinct()


def _opened(placed: DataFrame) -> DataFrame:
    """Texts (key, rep, n, part, of and any other columns) of the keys whose texts are in several parts; out: not in the
    key's largest part; outs: texts of the key that are out."""
    sizes = placed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("c"))
    several = sizes.groupBy("key").agg(F.max(F.struct("c", "part")).alias("top"), F.count(F.lit(1)).alias("parts"), F.sum("c").alias("all")).where("parts > 1")
    several = written(several.select(F.col("key").alias("k"), F.col("top.part").alias("main"), (F.col("all") - F.col("top.c")).alias("outs")), "several")
    return written(placed.join(several, F.col("key") == F.col("k")).select(*placed.columns, (F.col("part") != F.col("main")).alias("out"), "outs"), "open")


def likely(a: np.ndarray, b: np.ndarray, n: int, m: np.ndarray) -> np.ndarray:
    """Which rows of sketches b, of m shingles, may be as similar to sketch a, of n shingles, as SIMILARITY asks.

    The filled bins are a sample, without replacement, of the shingles that either text has: at SIMILARITY (n + m) /
    (1 + SIMILARITY) of them, so that a sketch of a short text is nearly exact."""
    filled = np.count_nonzero(b | a, axis=1)
    same = np.count_nonzero((b == a) & (a != 0), axis=1)
    missed = np.clip(1 - filled * (1 + SIMILARITY) / (n + m), 0, 1)
    return same >= SIMILARITY * filled - ERRORS * np.sqrt(SIMILARITY * (1 - SIMILARITY) * filled * missed) - 0.5


class _Common:
    """The keys of a group's texts up to the last of `of`, the keys that define the group."""

    def __init__(self, keys: list[list[int]], of: list[int]):
        known = [[k for k in own if k <= max(of)] for own in keys]
        _, self.key = np.unique(np.array([k for own in known for k in own], np.int64), return_inverse=True)
        self.cut = np.concatenate(([0], np.cumsum([len(own) for own in known])))
        self.least = len(set(of))

    def only(self, i: int) -> np.ndarray:
        """Which texts have no key before the last of the group's in common with text i but the group's. A pair that shares
        many keys so is compared in one group, that of its first ones."""
        mine = np.zeros(int(self.key.max()) + 1, bool)
        mine[self.key[self.cut[i] : self.cut[i + 1]]] = True
        before = np.concatenate(([0], np.cumsum(mine[self.key])))
        return before[self.cut[1:]] - before[self.cut[:-1]] == self.least


def _blocks(table: pa.Table) -> pa.Table:
    """Links a < b across parts of two blocks of texts of a key: enough to join what links of theirs join, so no more than
    there are texts. Likely pairs are verified most alike first; those that links have joined meanwhile are passed over."""
    column = lambda n: table[n].to_numpy()
    rep, root, left, out = (column(c) for c in ("rep", "part", "left", "out"))
    root, common, words = root.copy(), _Common(table["keys"].to_pylist(), table["of"][0].as_py()), []
    for texts in tokens.steps(table["text"]):
        w = tokens.words(texts)
        words += [w.hash[lo:hi].copy() for lo, hi in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)]
    shingles = [shingles_of(x) for x in words]
    n = np.array([len(x) for x in shingles], np.int64)
    bins = np.frombuffer(b"".join(_bins_from(_label(x)) for x in shingles), np.uint8).reshape(-1, BINS)
    del shingles
    v, found = np.flatnonzero(~left), []
    for i in np.flatnonzero(left).tolist():
        # two texts that both are outside of the largest part meet once, from the lesser one
        to = v[(root[v] != root[i]) & (~out[v] | (rep[v] > rep[i])) & (np.minimum(n[v], n[i]) >= SIMILARITY * np.maximum(n[v], n[i]) - 1e-9)]
        to = to[common.only(i)[to]] if len(to) else to
        to = to[likely(bins[i], bins[to], n[i], n[to])]
        to = to[np.argsort(np.count_nonzero(bins[to] != bins[i], axis=1), kind="stable")]
        while len(to):
            j, to = int(to[0]), to[1:]
            a, b = (i, j) if rep[i] < rep[j] else (j, i)
            if value := similarity(words[a], words[b]):
                found.append((rep[a], rep[b], value))
                root[root == root[j]] = root[i]
                to = to[root[to] != root[i]]
    a, b, value = zip(*found, strict=True) if found else ([], [], [])
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(value, pa.float64())], names=["a", "b", "similarity"])


def _in_blocks(open_: DataFrame, keys: DataFrame, documents: DataFrame) -> DataFrame:
    """Links across parts of keys of many texts: blocks of texts outside of the largest part meet blocks of all."""
    blocks = open_.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("of_all"), F.ceil(F.max("outs") / BLOCK).cast("int").alias("of_outs"))
    blocks = written(blocks.withColumnRenamed("key", "k"), "blocks")
    text = documents.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = open_.select("key", "of", "rep", "part", "out").join(blocks, F.col("key") == F.col("k")).join(keys, F.col("rep") == F.col("keys_of")).join(text, F.col("rep") == F.col("id"))
    place = lambda count: F.pmod(F.xxhash64("rep"), F.col(count)).cast("int")
    others = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    columns = ["key", "of", "rep", "part", "out", "keys", "text"]
    left = rows.where("out").select(*columns, F.lit(True).alias("left"), place("of_outs").alias("i"), others("of_all").alias("j"))
    right = rows.select(*columns, F.lit(False).alias("left"), others("of_outs").alias("i"), place("of_all").alias("j"))
    return left.unionByName(right).groupBy("key", "i", "j").applyInArrow(_blocks, "a long, b long, similarity double")


def _links_left(open_: DataFrame, reps: DataFrame, documents: DataFrame, least: int) -> DataFrame:
    """Links across parts of every key. A key with very many texts outside of its largest part is first divided by
    the other keys that its texts hold: a pair shares `least` keys, so it meets again in a smaller group."""
    keys = reps.groupBy(F.col("rep").alias("keys_of")).agg(F.array_distinct(F.flatten(F.collect_list("keys"))).alias("keys"))
    open_, pairs, out = open_.withColumn("of", F.array("key")), [], []
    for level in range(max(1, least)):
        small = open_.where(F.col("outs") <= EACH)
        pairs.append(_plausible(_across(small, small.where("out")), reps, least))
        more = F.col("outs") > EACH
        wide = more & (F.col("outs") > WIDE) if level + 1 < least else F.lit(False)
        if not (several := open_.where(more & ~wide)).isEmpty():
            out.append(_in_blocks(several, keys, documents))
        if level + 1 >= least or (wide := open_.where(wide)).isEmpty():
            break
        shared = wide.join(keys, F.col("rep") == F.col("keys_of")).select("rep", "n", "part", "of", F.explode(F.array_except("keys", "of")).alias("and"))
        shared = shared.select("rep", "n", "part", F.array_sort(F.array_append("of", F.col("and"))).alias("of")).distinct()
        open_ = _opened(shared.withColumn("key", F.xxhash64("of")))
    out.append(_verified(reduce(DataFrame.unionByName, pairs).distinct(), documents))
    return reduce(DataFrame.unionByName, out)


def links(documents: DataFrame, reps: DataFrame, least_shared: int = 1) -> DataFrame:
    """a, b, similarity: verified pairs that share least_shared keys; reps: rep, n, keys. Every such pair is compared, or
    other links join it; of groups of many texts, every pair whose sketches do not rule it out.

    Pairs with a key's first document come first. What they leave in several parts is joined across parts: texts
    outside of the key's largest part with all others. Before, where these are very many, for up to TURNS turns one text of
    the largest part and one outside of it meet the others, so that large groups grow together."""
    keyed = reps.select("rep", "n", F.explode(F.array_distinct("keys")).alias("key"))
    first = keyed.groupBy("key").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("key").alias("k"), "a")
    first = written(first, "firsts")  # read from files, the side of a hot key is one that Spark can split
    shared = written(keyed.join(first, F.col("key") == F.col("k")).select("key", "rep", "n", "a"), "shared")
    starts = shared.where("a <> rep").select("a", F.col("rep").alias("b")).distinct()
    found = written(_verified(_plausible(starts, reps, least_shared), documents), "links")
    for turn in range(TURNS + 1):
        roots = components(found.select("a", "b"))
        placed = shared.join(roots, F.col("rep") == F.col("node"), "left").select("key", "rep", "n", F.coalesce("root", "rep").alias("part"))
        open_ = _opened(written(placed, "placed"))
        left = open_.agg(F.count(F.lit(1)).alias("rows"), F.max("outs").alias("outs")).first()
        if not left["rows"]:
            return found
        last = turn == TURNS or left["outs"] <= WIDE
        if last:
            more = _links_left(open_, reps, documents, least_shared)
        else:
            one = F.min(F.struct(F.xxhash64("rep", F.lit(turn)).alias("h"), "rep", "part", "n")).alias("one")
            others = written(open_.groupBy("key", "out").agg(one).select("key", "one.rep", "one.part", "one.n"), "others")
            more = _verified(_plausible(_across(open_, others), reps, least_shared), documents)
        found = written(found.unionByName(more).dropDuplicates(["a", "b"]), "links")
        if last:
            break
    return found


def classes(documents: DataFrame) -> DataFrame:
    """doc_id, class_id (the class's least doc_id), class_size, n_links: one row per distinct doc_id."""
    known = written(sketches(documents), "sketches")
    by_sig = known.groupBy("sig").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    reps = written(by_sig, "reps")
    found = links(documents, reps.select("rep", "n", "keys"), SHARED)
    # rows that share a doc_id but not their words are joined into one document
    same = known.select("doc_id", "sig").join(reps.select(F.col("sig").alias("s"), "rep"), F.col("sig") == F.col("s")).select("doc_id", "rep").distinct()
    members = written(same, "members")
    torn = members.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("a", "b")
    roots = components(found.select("a", "b").unionByName(torn))
    rooted = members.join(roots, F.col("rep") == F.col("node"), "left").select("doc_id", F.coalesce("root", "rep").alias("class_id")).groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    rooted = written(rooted, "classes")
    size = written(rooted.groupBy(F.col("class_id").alias("c")).agg(F.count(F.lit(1)).alias("class_size")), "sizes")
    ends = found.select(F.col("a").alias("d")).unionByName(found.select(F.col("b").alias("d"))).groupBy("d").agg(F.count(F.lit(1)).alias("n_links"))
    return rooted.join(size, F.col("class_id") == F.col("c")).join(ends, F.col("doc_id") == F.col("d"), "left").select("doc_id", "class_id", "class_size", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def report(documents: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size, n_links, kept for every row of documents."""
    found = classes(documents).withColumnRenamed("doc_id", "__d")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id")).join(found, F.col("doc_id") == F.col("__d"), "left")
    return rows.select("doc_id", "class_id", F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("class_id"))).alias("kept"))


def keep_first(documents: DataFrame) -> DataFrame:
    """documents with one row of each class: of the least doc_id, the row of least text; rows of null doc_id stay."""
    found = classes(documents).where("doc_id = class_id").select(F.col("doc_id").alias("kept_id"))
    named = documents.where(F.col("doc_id").isNotNull())
    kept = named.join(found, named["doc_id"] == found["kept_id"], "left_semi")
    order = Window.partitionBy(kept["doc_id"]).orderBy(kept["text"])
    place = _free_name(documents, "place")
    once = kept.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place)
    return once.unionByName(documents.where(F.col("doc_id").isNull()))


def _free_name(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, in any case."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name
