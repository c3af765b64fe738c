from collections import defaultdict

import duckdb
import pytest

from vellum.llm import mixing

from . import cases


def plain_shares(sizes):
    """Targets by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, s.encode() if s else b""))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        target = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if target[s] > 3 * sizes[s]]
        if not over:
            return target | capped
        capped |= {s: 3.0 * sizes[s] for s in over}


def check(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert r.taken == r.size * r.copies and r.taken <= 3 * r.size
    targets = plain_shares({s: sum(r.size for r in rs) for s, rs in by.items()})
    for s, rs in by.items():
        assert rs[0].source_size == sum(r.size for r in rs)
        assert rs[0].target == pytest.approx(targets[s], abs=1e-6)
    return by, targets


def test_targets_caps_and_words(spark):
    rows = [(i, cases.prose(i, 5 + i % 40), "en", ["a", "b", "é", "z", None][i % 5] if i > 20 else "b") for i in range(600)]
    rows += [(1000 + i, "w " * 3, "en", "B") for i in range(4)]  # a small source of weight 5: capped
    docs = cases.documents(spark, rows)
    first = mixing.report(docs).collect()
    by, targets = check(first)
    for s, rs in by.items():
        assert abs(sum(r.taken for r in rs) - targets[s]) <= 12
    again = {(r.doc_id, r.taken) for r in mixing.report(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in first}
    con = duckdb.connect()
    documents = docs.toPandas()  # noqa: F841
    want = con.sql(mixing.ORACLE).fetchall()
    assert sorted(want, key=str) == sorted([tuple(r) for r in first], key=str)


def test_awkward_and_empty(spark):
    assert mixing.report(cases.empty(spark)).count() == 0
    rows = mixing.report(cases.awkward(spark)).collect()
    assert len(rows) == len(cases.AWKWARD)
    check(rows)
    assert {r.size for r in rows if r.doc_id in (1, 2, 3)} == {0}


def test_no_words_at_all(spark):
    rows = mixing.report(cases.documents(spark, [(1, None), (2, "  ")])).collect()
    assert [(r.size, r.taken, r.target) for r in rows] == [(0, 0, 0.0)] * 2
