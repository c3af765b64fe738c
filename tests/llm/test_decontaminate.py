import random

import pytest

from vellum.llm import decontaminate

from . import cases


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, score string")


def test_against_brute_force(spark):
    rng = random.Random(3)
    bench = [(i, cases.prose(900 + i, rng.choice([1, 4, 9, 10, 11, 25])), "") for i in range(30)] + [(77, None, ""), (78, "", ""), (79, cases.prose(900, 30), ""), (80, "Ein Satz, mit  Zeichen; und 123 Zahlen", "")]
    rows = []
    for d in range(120):
        text = cases.prose(d, rng.randint(0, 60))
        if d % 3 == 0:
            text += " " + rng.choice(bench[:30])[1].upper().replace(" ", " ;\n")
        rows.append((d, text))
    rows += [(500, "EIN SATZ mit zeichen und 123 zahlen"), (501, None), (502, bench[0][1] + bench[1][1])]
    got = {r.doc_id: r for r in decontaminate.report(cases.documents(spark, rows), items(spark, bench)).collect()}
    listed = [(str(i), t) for i, t, _ in bench]
    for d, t in rows:
        assert (got[d].n_words, got[d].n_hit, got[d].items_sha256) == decontaminate.brute_force(t, listed), d
        assert got[d].contaminated == (got[d].n_hit > 0)
    blocks = decontaminate.hits(cases.documents(spark, rows), items(spark, bench), block_bytes=60)
    assert {r.doc_id: (r.n_words, len(r.hits), tuple(r["items"])) for r in blocks.collect()} == {
        r.doc_id: (r.n_words, len(r.hits), tuple(r["items"])) for r in decontaminate.hits(cases.documents(spark, rows), items(spark, bench)).collect()
    }


def test_blocks_keep_repeated_and_null_rows(spark):
    bench = [(i, cases.prose(900 + i, 12), "") for i in range(6)]
    a, b = bench[0][1], bench[5][1]
    docs = cases.documents(spark, [(None, a), (None, b), (None, None), (1, a), (1, a), (1, b), (2, a + " " + b), (3, cases.prose(1, 40))])
    digest = lambda df: sorted((str(r.doc_id), r.n_words, sorted(r.hits), r["items"]) for r in df.collect())
    whole = digest(decontaminate.hits(docs, items(spark, bench)))
    assert len(whole) == 8
    assert digest(decontaminate.hits(docs, items(spark, bench), block_bytes=60)) == whole


@pytest.mark.parametrize("bench", [[], [(1, None, "")], [(1, cases.prose(10, 12), "")]])
def test_awkward(spark, bench):
    b = items(spark, bench or [(1, "", "")]).limit(len(bench))
    assert decontaminate.report(cases.awkward(spark), b).count() == len(cases.AWKWARD)
    assert decontaminate.report(cases.empty(spark), b).count() == 0
    assert decontaminate.drop_contaminated(cases.awkward(spark), b).columns == cases.awkward(spark).columns


def test_drop_keeps_clean_rows(spark):
    bench = items(spark, [(1, cases.prose(10, 30), "")])
    kept = decontaminate.drop_contaminated(cases.documents(spark, [(1, cases.prose(1, 50) + " " + cases.prose(10, 12)), (2, cases.prose(2, 50)), (3, None)]), bench).collect()
    assert sorted(r.doc_id for r in kept) == [2, 3]
