import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from vellum.llm import fingerprints

from . import cases


def jaccard(a, b):
    a, b = (Counter(w for w in re.split("[\x20\x09-\x0d]+", t) if w) for t in (a, b))
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def brute(rows):
    """n_chars, edited text and next text by a plain loop over distinct doc_ids."""
    order = sorted(rows, key=lambda r: -r[0])
    for i, (d, t) in enumerate(order):
        after = order[(i + 1) % len(order)][1] or ""
        t = t or ""
        half = len(t) // 2
        yield d, t, t[: len(t) - half] + after[:half], after


def test_against_loop_over_many_ranges(spark, monkeypatch):
    rows = [(i * 3, cases.prose(i // 2, 10 + (i * 37) % 300)) for i in range(200)] + [(1, None), (2, ""), (4, "😀 é " * 9)]
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 3000)
    got = {r.doc_id: r for r in fingerprints.report(cases.documents(spark, rows)).collect()}
    assert len(got) == len(rows)
    errors, prints = [], {}
    for d, t, edited, after in brute(rows):
        r = got[d]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
        assert (r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1.0)
        errors += [abs(r.near_edited - jaccard(t, edited)), abs(r.near_next - jaccard(t, after))]
        if t == after:
            assert r.near_next == 1.0
    assert sum(errors) / len(errors) < 0.04


def test_awkward_and_empty(spark):
    assert fingerprints.report(cases.empty(spark)).count() == 0
    rows = fingerprints.report(cases.awkward(spark)).collect()
    assert len(rows) == len(cases.AWKWARD)
    one = fingerprints.report(cases.documents(spark, [(5, "a b c d")])).collect()[0]
    assert one.near_next == 1.0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)


def test_no_python_in_the_plan(spark):
    plan = fingerprints.report(cases.documents(spark, [(i, cases.prose(i, 20)) for i in range(9)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_skewed_counts(spark):
    words = " ".join(f"w{i}" for i in range(100))
    rows = [(4, "heavy " * 1000 + words), (3, words), (2, "a " * 50 + words), (1, "a " * 25 + words)]
    got = {r.doc_id: r.near_next for r in fingerprints.report(cases.documents(spark, rows)).collect()}
    for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        assert abs(got[d] - jaccard(t, after)) < 0.13


def test_values_are_consistent_weighted_samples(spark):
    """The value of a weighted word is that of r, c and b drawn from the same hashes by the textbook formula, and these have
    their distributions."""
    import math

    df = spark.range(3000).select(F.xxhash64("id").alias("h"), (F.col("id") % 7 + 1).alias("weight"))
    rows = fingerprints.ranked(df.withColumn("other", F.xxhash64("h", F.lit(1)))).collect()
    r_, c_, b_ = [], [], []
    for x in rows:
        u, v = (((x.other >> s) & 0xFFFFFFFF) + 0.5 for s in (0, 32))
        s = -math.log(((x.h >> 24) + 2**39 + 0.5) / 2**40)
        c = s - math.log(u / 2**32)
        e = math.log(c / s)
        r = e - math.log(v / 2**32)
        b = 1 - e / r
        t = math.floor(math.log(x.weight) / r + b)
        rank = c * math.exp(-r * (t - b + 1))
        assert abs((x.value >> 24) - (math.exp(-rank) * 2**40 - 2**39)) <= 2 + 2**40 * 1e-12 or abs(math.log(x.weight) / r + b - round(math.log(x.weight) / r + b)) < 1e-9
        assert t > 0 or x.value == x.h
        for kept, value in ((r_, r), (c_, c), (b_, b)):
            kept.append(value)
    gamma = lambda x: 1 - math.exp(-x) * (1 + x)
    for values, law in ((r_, gamma), (c_, gamma), (b_, lambda x: x)):
        values.sort()
        assert max(abs(law(x) - i / len(values)) for i, x in enumerate(values)) < 0.03
