import hashlib
import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from vellum.llm import chunks, suffixes

from . import cases


def brute(rows):
    seen, out = set(), []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 99):
            w = raw[p : p + 100]
            if w in seen:
                gone[p : p + 100] = True
            seen.add(w)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((d, len(raw), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


def texts(seed):
    rng = random.Random(seed)
    base = cases.prose(seed, 400)
    rows = [(0, base), (1, base), (2, base[:500] + "X" + base[500:]), (3, "a" * 1000), (4, "ab" * 333), (5, None), (6, base[40:139]), (7, base[40:140])]
    for d in range(8, 60):
        a = rng.randint(0, 1500)
        rows.append((d, cases.prose(1000 + d, rng.randint(0, 80)) + base[a : a + rng.randint(0, 700)] + "é" * rng.randint(0, 120)))
    return rows


def test_against_brute_force(spark, monkeypatch):
    for seed, chunk in ((1, 1 << 20), (2, 3000)):
        monkeypatch.setattr(suffixes, "dealt", lambda d, c=chunk: chunks.dealt(d, c))
        rows = texts(seed)
        got = suffixes.report(cases.documents(spark, rows)).collect()
        assert sorted(map(tuple, got), key=str) == brute(rows)


def test_awkward_and_empty(spark):
    assert suffixes.report(cases.empty(spark)).count() == 0
    got = suffixes.report(cases.awkward(spark)).collect()
    assert sorted((r.doc_id, r.n_bytes) for r in got if r.doc_id is not None) == sorted((r[0], len((r[1] or "").encode())) for r in cases.AWKWARD if r[0] is not None)
    both = [r for r in got if r.doc_id == 5]
    assert sorted(r.n_removed for r in both) == [0, both[0].n_bytes]  # the second of two equal rows goes
    rows = [(d, t) for d, t, *_ in cases.AWKWARD]
    assert sorted(map(tuple, got), key=str) == brute(rows)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=40), st.integers(0, 10**6))
def test_suffix_order_finds_equal_windows(parts, seed):
    rng = np.random.default_rng(seed)
    pool = [rng.integers(97, 99 + 20 * k, size=int(rng.integers(1, 90))).astype(np.uint8) for k in range(3)]
    body = np.concatenate([pool[p] for p in parts] + [rng.integers(97, 123, size=100).astype(np.uint8)])
    text = np.concatenate([body, np.zeros(suffixes.LENGTH + suffixes.MODULUS + 8, np.uint8)])
    windows = np.arange(len(body) - suffixes.LENGTH + 1)
    seen, want = set(), []
    for p in windows.tolist():
        w = body[p : p + 100].tobytes()
        want.append(w in seen)
        seen.add(w)
    assert suffixes.first_equal(text, windows).tolist() == want


def in_process(rows, buckets=3):
    """The steps of report() on one chunk, in this process, where constants can be changed."""
    left = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] or "" for r in rows], "route": pa.array([0] * len(rows), pa.int32())})

    def by_bucket(table, step):
        return pa.concat_tables([step(table.filter(pa.array([v == b for v in table["bucket"].to_pylist()]))) for b in sorted(set(table["bucket"].to_pylist()))])

    replies = by_bucket(suffixes._entries(buckets)(left), suffixes._match)
    opened = suffixes._contexts(buckets)(left, replies)
    none = pa.array([b""] * len(replies))
    parts = [pa.table({"repeats": replies["repeats"], "run": none, "low": none, "high": none})]
    if len(opened):
        marks = by_bucket(opened, suffixes._sort_blocks)
        parts.append(pa.table({"repeats": pa.array([b""] * len(marks)), "run": marks["run"], "low": marks["low"], "high": marks["high"]}))
    out = suffixes._cut(left, pa.concat_tables(parts))
    return sorted(zip(*(out[c].to_pylist() for c in out.column_names), strict=True), key=str)


def test_stretches_and_blocks_of_any_size_give_the_same_result(monkeypatch):
    for step, block, seed in ((1 << 20, 200_000, 5), (400, 500, 5), (173, 1, 6), (5000, 3000, 7)):
        monkeypatch.setattr(suffixes.tokens, "STEP_BYTES", step)
        monkeypatch.setattr(suffixes.tokens.steps, "__defaults__", (step * 3, 1 << 14))
        monkeypatch.setattr(suffixes, "BLOCK_WINDOWS", block)
        assert in_process(texts(seed)) == brute(texts(seed))


def test_hashes_of_spans_do_not_depend_on_stretches(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.integers(0, 255, 5000).astype(np.uint8)
    starts = np.sort(rng.integers(0, 4900, 300))
    ends = starts + rng.integers(0, 100, 300)
    want = suffixes.tokens.span_hashes(data, starts, ends)
    monkeypatch.setattr(suffixes.tokens, "STEP_BYTES", 500)
    assert (suffixes.tokens.span_hashes(data, starts, ends) == want).all()
