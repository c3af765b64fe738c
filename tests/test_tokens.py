"""The token view reads every document to its end."""

import os
import re

import pytest

from vellum.plans import catalog, views

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_tokens_of_every_word(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = {d: len(re.split("[ \n]+", t)) for d, t in texts.items()}
    assert any(d % 5 for d in want) and max(want.values()) > 60
    assert {r.response_id: r.n for r in views.view(spark, SF, "v_tokens").groupBy("response_id").count().withColumnRenamed("count", "n").collect()} == want


def test_weak_spans_of_every_word(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = {d: sum((d * 7 + n * 13) % 40 > 10 for n in range(1, len(re.split("[ \n]+", t)) + 1)) for d, t in texts.items()}
    got = {r.response_id: r.n for r in catalog.queries()["weak_spans"](spark, SF).groupBy("response_id").count().withColumnRenamed("count", "n").collect()}
    assert got == {d: n for d, n in want.items() if n}
