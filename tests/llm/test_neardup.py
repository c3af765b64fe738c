import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vellum.llm import alignment, graph, neardup, tokens

from . import cases


def edited(text, rng, n):
    w = text.split()
    for _ in range(n):
        i = rng.randrange(len(w))
        w[i : i + 1] = rng.choice([[], ["zzz"], [w[i], "yyy"]])
    return " ".join(w)


def hashes(text):
    raw = text.encode()
    return tokens.words(tokens.Texts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)], np.int64), 0)).hash


def aligned_share(a, b):
    """Shingles matched by a longest common subsequence of words over all shingles, by plain dynamic programming."""
    n, m = len(a), len(b)
    if min(n, m) < 5:
        return 1.0 if a == b else 0.0
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    i = j = run = matched = 0
    while i < n and j < m:
        if a[i] == b[j]:
            run += 1
            matched += run >= 5
            i, j = i + 1, j + 1
        else:
            run = 0
            if best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
    return matched / (n + m - 8 - matched)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(6, 90), st.integers(0, 8))
def test_alignment_is_a_longest_common_subsequence(seed, n, edits):
    rng = random.Random(seed)
    a = cases.prose(seed, n).replace(".", "")
    b = edited(a, rng, edits)
    x, y = hashes(a), hashes(b)
    runs = alignment.matched_runs(x, y, len(x) + len(y))
    for p, q, k in runs:
        assert (x[p : p + k] == y[q : q + k]).all()
    u, v = a.split(), b.split()
    best = [[0] * (len(v) + 1) for _ in range(len(u) + 1)]
    for i in range(len(u)):
        for j in range(len(v)):
            best[i + 1][j + 1] = best[i][j] + 1 if u[i] == v[j] else max(best[i][j + 1], best[i + 1][j])
    assert sum(k for _, _, k in runs) == best[-1][-1]


def test_classes_against_all_pairs(spark):
    rng = random.Random(5)
    rows = []
    for f in range(40):
        base = cases.prose(f, rng.randint(40, 160))
        for k in range(rng.choice([1, 1, 2, 4])):
            rows.append((len(rows) * 2, base if k == 1 else edited(base, rng, rng.choice([0, 1, 2, 12]) if k else 0)))
    rows += [(1000, None), (1001, ""), (1003, "!!!"), (1005, "???"), (1007, "one two"), (1009, "one two"), (1011, "one two three")]
    got = {r.doc_id: r for r in neardup.report(cases.documents(spark, rows)).collect()}
    assert len(got) == len(rows)
    parent = {d: d for d, _ in rows}

    def root(d):
        return d if parent[d] == d else root(parent[d])

    texts = {d: (t or "") for d, t in rows}
    for i, (d, _) in enumerate(rows):
        for e, _ in rows[:i]:
            a, b = texts[d], texts[e]
            if a == b or (neardup.similarity(hashes(a), hashes(b)) >= 0.8 and len(hashes(a))):
                x, y = sorted((root(d), root(e)))
                parent[y] = x
    assert {d: r.class_id for d, r in got.items()} == {d: root(d) for d, _ in rows}
    for d, r in got.items():
        assert r.kept == (d == r.class_id) and r.class_size == sum(g.class_id == r.class_id for g in got.values())


def test_similarity_agrees_with_plain_alignment():
    for seed in range(120):
        rng = random.Random(seed)
        a = cases.prose(seed, rng.randint(5, 120)).replace(".", "")
        b = edited(a, rng, rng.randint(0, 9))
        got, want = neardup.similarity(hashes(a), hashes(b)), aligned_share(a.split(), b.split())
        assert got == pytest.approx(want, abs=0.06) or (got == 0 and want < 0.86)


def test_large_group_of_copies_gives_one_class(spark):
    base = cases.prose(1, 100)
    rng = random.Random(1)
    rows = [(i, base if i % 2 else edited(base, rng, 1)) for i in range(400)]
    got = neardup.report(cases.documents(spark, rows)).collect()
    assert {r.class_id for r in got} == {0}
    assert neardup.keep_first(cases.documents(spark, rows)).count() == 1


def with_bins(spark, rows):
    """reps of (rep, text, keys)."""
    found = []
    for rep, text, keys in rows:
        s = neardup.shingles_of(hashes(text))
        bins = neardup._bins_from(tokens.mix(s + neardup.occurrence_labels(s).astype(np.uint64) * np.uint64(3)))
        found.append((rep, len(s), keys, bytearray(bins)))
    return spark.createDataFrame(found, "rep long, n long, keys array<long>, bins binary")


@pytest.mark.parametrize("each", [8, 0])
def test_any_two_texts_of_a_key_are_compared_or_joined(spark, monkeypatch, each):
    monkeypatch.setattr(neardup, "EACH", each)
    monkeypatch.setattr(neardup, "BLOCK", 3)
    rng = random.Random(9)
    rows = []
    for f in range(12):
        base = cases.prose(300 + f, 100)
        rows += [edited(base, rng, 4 * k) for k in range(rng.choice([1, 2, 5]))]
    rng.shuffle(rows)
    keys = [sorted(rng.sample(range(4), 2)) for _ in rows]
    reps = with_bins(spark, [(i, t, keys[i]) for i, t in enumerate(rows)])
    found = neardup.links(cases.documents(spark, list(enumerate(rows))), reps)
    got = {r.node: r.root for r in graph.components(found.select("a", "b")).collect()}
    parent = list(range(len(rows)))

    def root(d):
        return d if parent[d] == d else root(parent[d])

    for b in range(len(rows)):
        for a in range(b):
            if set(keys[a]) & set(keys[b]) and neardup.similarity(hashes(rows[a]), hashes(rows[b])):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert {d: got.get(d, d) for d in range(len(rows))} == {d: root(d) for d in range(len(rows))}


def test_texts_that_a_keys_first_one_does_not_resemble(spark):
    base = cases.prose(2, 100)
    rows = [(1, cases.prose(1, 100)), (2, base), (3, edited(base, random.Random(3), 1))]
    reps = with_bins(spark, [(d, t, [7]) for d, t in rows])
    assert {(r.a, r.b) for r in neardup.links(cases.documents(spark, rows), reps).collect()} == {(2, 3)}


def test_long_texts_of_repeated_lines_are_linked():
    lines = [cases.prose(i, 10).replace(".", "").split() for i in range(100)]
    a = [w for i in range(2000) for w in lines[i % 100]]
    b, rng = list(a), random.Random(4)
    for i in rng.sample(range(len(b)), 420):
        b[i] = "zzz"
    assert len(a) == 20000 and neardup.similarity(hashes(" ".join(a)), hashes(" ".join(b))) >= 0.8


@pytest.mark.parametrize("kept", [4000, 3])
def test_alignment_in_halves_is_as_long(monkeypatch, kept):
    monkeypatch.setattr(alignment, "KEPT", kept)
    for seed in range(200):
        rng = random.Random(seed)
        a = [rng.randrange(rng.choice([2, 5, 1000])) for _ in range(rng.randint(0, 50))]
        b = list(a)
        for _ in range(rng.randint(0, 20)):
            i = rng.randrange(len(b) + 1)
            b[i : i + rng.choice([0, 1, 2])] = [rng.randrange(5) for _ in range(rng.choice([0, 1, 2]))]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        differences = len(a) + len(b) - 2 * best[-1][-1]
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        assert sum(n for _, _, n in alignment.matched_runs(x, y, differences)) == best[-1][-1]
        assert not differences or alignment.matched_runs(x, y, differences - 1) is None


def test_sketches_do_not_rule_out_similar_texts():
    for seed in range(1500):
        rng = random.Random(seed)
        a = cases.prose(seed, rng.randint(8, 900))
        b = edited(a, rng, rng.randint(0, 1 + len(a.split()) // 40))
        if neardup.similarity(hashes(a), hashes(b)):
            made, n = [], []
            for t in (a, b):
                s = neardup.shingles_of(hashes(t))
                n.append(len(s))
                made.append(np.frombuffer(neardup._bins_from(tokens.mix(s + neardup.occurrence_labels(s).astype(np.uint64) * np.uint64(3))), np.uint8))
            assert neardup.likely(made[0], made[1][None, :], n[0], np.array(n[1:]))[0]


def test_groups_of_many_unlike_texts_are_divided_by_other_keys(spark, monkeypatch):
    monkeypatch.setattr(neardup, "EACH", 2)
    monkeypatch.setattr(neardup, "WIDE", 5)
    rng = random.Random(6)
    rows = [cases.prose(700 + i, 60) for i in range(40)]
    rows += [edited(t, rng, 1) for t in rows[30:]]
    keys = [[1, 2, *([3] if i % 2 else []), 100 + i - i // 40 * 10] for i in range(len(rows))]
    reps = with_bins(spark, [(i, t, keys[i]) for i, t in enumerate(rows)])
    got = {(r.a, r.b) for r in neardup.links(cases.documents(spark, list(enumerate(rows))), reps, 3).collect()}
    assert got == {(30 + i, 40 + i) for i in range(10)}


def test_components(spark):
    rng = random.Random(2)
    nodes = list(range(200))
    links = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(30)] + [(7, 7)]
    parent = {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: root(n) for a, b in links if a != b for n in (a, b)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_awkward_and_empty(spark):
    assert neardup.report(cases.empty(spark)).count() == 0
    rows = neardup.report(cases.awkward(spark)).collect()
    assert len(rows) == len(cases.AWKWARD)
    assert {r.class_id for r in rows if r.doc_id in (5, 7)} == {5}
    assert {r.class_id for r in rows if r.doc_id in (1, 2)} == {1}
    kept = neardup.keep_first(cases.awkward(spark))
    assert kept.columns == cases.awkward(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) == 1 and 7 not in ids and ids.count(None) == 2


def test_a_large_group_of_near_copies_gives_links_in_proportion(spark, monkeypatch):
    monkeypatch.setattr(neardup, "EACH", 2)
    rng = random.Random(8)
    rows = [(i, edited(cases.prose(900 + i % 6, 100), rng, rng.choice([1, 2]))) for i in range(180)]
    reps = with_bins(spark, [(d, t, [7, 8, 9, 1000 + d]) for d, t in rows])
    found = neardup.links(cases.documents(spark, rows), reps, 3)
    got = {r.node: r.root for r in graph.components(found.select("a", "b")).collect()}
    parent = {d: d for d, _ in rows}

    def root(d):
        return d if parent[d] == d else root(parent[d])

    words = {d: hashes(t) for d, t in rows}
    pairs = 0
    for i, (d, _) in enumerate(rows):
        for e, _ in rows[:i]:
            if neardup.similarity(words[e], words[d]):
                pairs += 1
                x, y = sorted((root(d), root(e)))
                parent[y] = x
    assert {d: got.get(d, d) for d in words} == {d: root(d) for d in words}
    assert pairs > 5 * len(rows) > 5 * found.count()
