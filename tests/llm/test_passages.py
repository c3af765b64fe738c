import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from vellum.llm import alignment, passages, tokens

from . import cases


def plant(rng, passage, n_before, n_after, edits=0):
    w = passage.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = "zzz"
    return cases.prose(rng.random(), n_before) + " " + " ".join(w) + " " + cases.prose(rng.random(), n_after)


def test_planted_passages_are_found_and_clean_texts_left(spark):
    rng = random.Random(4)
    rows, planted = [], {}
    for f in range(30):
        passage = cases.prose(5000 + f, rng.randint(55, 140))
        first = len(rows)
        rows.append((first, plant(rng, passage, rng.randint(0, 50), rng.randint(0, 50))))
        for _ in range(rng.randint(1, 4)):
            planted[len(rows)] = (first, passage)
            rows.append((len(rows), plant(rng, passage, rng.randint(0, 50), rng.randint(0, 50), rng.choice([0, 0, 2, 4]))))
    clean = [(1000 + i, cases.prose(7000 + i, 150)) for i in range(60)]
    docs = cases.documents(spark, rows + clean)
    got = passages.report(docs).collect()
    assert {r.doc_id for r in got} == set(planted)
    for r in got:
        assert r.source_doc_id < r.doc_id and r.identity >= passages.IDENTITY and r.n_words >= passages.LEAST_WORDS
    text = dict(rows)
    for d, (_, passage) in planted.items():
        found = [r for r in got if r.doc_id == d]
        covered = max(r.n_words for r in found)
        assert covered >= len(passage.split()) - 12
        raw = text[d].encode()[found[0].start_byte : found[0].end_byte].decode()
        assert raw.split()[0].strip(".").lower() and len(raw.split()) == found[0].n_words
    cut = {r.doc_id: r for r in passages.cut_passages(docs).collect()}
    for d, t in clean:
        assert cut[d].text == t
    for d, (first, passage) in planted.items():
        assert cut[first].text == text[first]
        if d in cut:
            assert len(cut[d].text) < len(text[d]) and cut[d].n_chars == len(cut[d].text)


def test_hot_passage_grows_with_its_rows(spark):
    passage = cases.prose(1, 90)
    rng = random.Random(8)
    docs = cases.documents(spark, [(i, plant(rng, passage, 20, 20)) for i in range(300)])
    got = passages.report(docs).collect()
    assert {r.doc_id for r in got} == set(range(1, 300)) and len(got) <= 2 * 299


def test_texts_that_repeat_themselves(spark):
    words = cases.WORDS[:12]
    text = " ".join(w for w in words for _ in range(25))
    got = passages.report(cases.documents(spark, [(1, text), (2, text), (3, cases.prose(3, 200))])).collect()
    assert {r.doc_id for r in got} == {2} and max(r.n_words for r in got) > 250


def test_results_do_not_depend_on_partitions(spark):
    passage, rng = cases.prose(1, 90), random.Random(8)
    rows = [(i, plant(rng, passage, 20, 20, i % 5) if i % 3 else cases.prose(50 + i, 120)) for i in range(60)]
    docs = cases.documents(spark, rows)
    got = [sorted(map(tuple, passages.report(docs.repartition(n)).collect())) for n in (1, 7, 64)]
    assert got[0] == got[1] == got[2] and {r[0] for r in got[0]} == {i for i in range(2, 60) if i % 3}


def test_texts_of_one_doc_id_are_documents_of_their_own(spark):
    passage = cases.prose(1, 80)
    for rows in ([(1, passage), (2, cases.prose(2, 80)), (2, passage)], [(1, passage), (1, cases.prose(2, 30) + " " + passage), (1, passage)]):
        got = passages.report(cases.documents(spark, rows)).collect()
        assert len(got) == 1 and got[0].n_words >= 75
        kept = sorted(len(tokens.words(tokens.Texts(np.frombuffer(r.text.encode(), np.uint8), np.array([0, len(r.text.encode())]), 0)).start) for r in passages.cut_passages(cases.documents(spark, rows)).collect())
        assert sum(kept) <= sum(len(t.split()) for _, t in rows) - 70


def test_passage_whose_parts_stand_scattered_before(spark):
    words = cases.prose(3, 70).replace(".", "").split()
    rng = random.Random(2)
    scattered = lambda: " ".join(w for i in rng.sample(range(66), 66) for w in [*words[i : i + 5], f"x{rng.random()}"])
    rows = [(1, scattered()), (2, cases.prose(4, 30) + " " + " ".join(words)), (3, scattered()), (4, " ".join(words) + " " + cases.prose(5, 30))]
    got = passages.report(cases.documents(spark, rows)).collect()
    assert any(r.doc_id == 4 and r.source_doc_id == 2 and r.n_words >= 68 for r in got)


def test_passage_of_frequent_lines(spark):
    one, two = cases.prose(11, 30), cases.prose(12, 30)
    rows = [(i, cases.prose(20 + i, 30) + " " + (one if i % 2 else two) + " " + cases.prose(60 + i, 30)) for i in range(40)]
    rows += [(100 + i, cases.prose(200 + i, 25) + " " + one + " " + two + " " + cases.prose(300 + i, 25)) for i in range(2)]
    got = passages.report(cases.documents(spark, rows)).collect()
    assert any(r.doc_id == 101 and r.source_doc_id == 100 and r.n_words >= 58 for r in got)


def test_recall_of_edited_passages(spark):
    rng, rows, kinds = random.Random(3), [], {}
    for every in (7, 8, 10, 14):
        for f in range(40):
            w = cases.prose(9000 + 100 * every + f, 60).split()
            edited = ["zzz" if i % every == every - 1 else x for i, x in enumerate(w)]
            rows.append((len(rows), plant(rng, " ".join(w), 20, 20)))
            kinds[len(rows)] = every
            rows.append((len(rows), plant(rng, " ".join(edited), 20, 20)))
    found = {r.doc_id for r in passages.report(cases.documents(spark, rows)).collect()}
    share = {e: sum(d in found for d, k in kinds.items() if k == e) / 40 for e in (7, 8, 10, 14)}
    assert share[14] == 1 and share[10] >= 0.95 and share[8] >= 0.9 and share[7] >= 0.8, share
    assert found <= set(kinds)


def test_long_passages_of_repeated_lines_are_aligned(spark):
    lines = [cases.prose(i, 10).replace(".", "").split() for i in range(40)]
    a = [w for i in range(400) for w in lines[i % 40]]
    b, rng = list(a), random.Random(4)
    for i in rng.sample(range(len(b)), 200):
        b[i] = "zzz"
    got = passages.report(cases.documents(spark, [(1, " ".join(a)), (2, " ".join(b))])).collect()
    covered = set()
    for r in got:
        covered |= set(range(r.start_word, r.start_word + r.n_words))
    assert len(covered) >= 0.95 * len(b)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60), st.integers(1, 12)), min_size=1, max_size=14))
def test_chain_scores_are_the_best_ones(parts):
    x0, y0 = [p[0] for p in parts], [p[1] for p in parts]
    x1, y1 = [p[0] + p[2] for p in parts], [p[1] + p[2] for p in parts]
    n = len(parts)
    best = [0.0] * n
    for i in sorted(range(n), key=lambda i: (x0[i], y0[i])):
        before = [best[j] - passages.GAP * (x0[i] - x1[j] + y0[i] - y1[j]) for j in range(n) if j != i and x1[j] <= x0[i] and y1[j] <= y0[i]]
        best[i] = parts[i][2] + max([0.0, *before])
    chains = passages.chain(x0, x1, y0, y1)
    assert abs(max(s for _, s in chains) - max(best)) < 1e-9
    used = [i for path, _ in chains for i in path]
    assert sorted(used) == list(range(n))
    for path, _ in chains:
        for a, b in zip(path, path[1:], strict=False):
            assert x1[a] <= x0[b] and y1[a] <= y0[b]


def test_awkward_and_empty(spark):
    assert passages.report(cases.empty(spark)).count() == 0
    got = passages.report(cases.awkward(spark)).collect()
    assert {r.doc_id for r in got} == {7} and {r.source_doc_id for r in got} == {5}
    cut = passages.cut_passages(cases.awkward(spark))
    assert cut.columns == cases.awkward(spark).columns
    rows = cut.collect()
    assert len(rows) == len(cases.AWKWARD) - 1 and 7 not in [r.doc_id for r in rows]
    assert passages.cut_passages(cases.empty(spark)).count() == 0


def test_paths_of_many_differences_are_sought_on_lists(monkeypatch):
    def on_arrays(*_, **__):
        raise AssertionError("a path of 150 differences was sought on arrays")

    monkeypatch.setattr(alignment, "_forward", on_arrays)
    a = np.arange(1500, dtype=np.uint64)
    b = a.copy()
    b[10::20] += np.uint64(5000)
    runs = alignment.matched_runs(a, b, 150)
    assert sum(n for _, _, n in runs) == 1425 and all((a[x : x + n] == b[y : y + n]).all() for x, y, n in runs)


def test_paths_on_lists_are_those_on_arrays(monkeypatch):
    for seed in range(400):
        rng = random.Random(seed)
        kinds = rng.choice([2, 5, 1000])
        a = [rng.randrange(kinds) for _ in range(rng.randint(1, 60))]
        b = list(a)
        for _ in range(rng.randint(0, 20)):
            i = rng.randrange(len(b) + 1)
            b[i : i + rng.choice([0, 1, 2])] = [rng.randrange(kinds) for _ in range(rng.choice([0, 1, 2]))]
        most, got = rng.choice([0, 1, 5, 20, len(a) + len(b)]), []
        for few, kept in ((256, 4000), (3, 4000), (3, 4)):
            monkeypatch.setattr(alignment, "FEW", few)
            monkeypatch.setattr(alignment, "KEPT", kept)
            got.append(alignment.matched_runs(np.array(a, np.uint64), np.array(b, np.uint64), most))
        assert got[0] == got[1]
        assert (got[2] is None) == (got[0] is None)
        assert got[0] is None or sum(r[2] for r in got[2]) == sum(r[2] for r in got[0])
