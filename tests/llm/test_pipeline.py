import corpus_pipeline
import pytest

from vellum.llm import queries

from . import cases


def tables(spark, path, docs):
    docs.write.mode("overwrite").parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, cases.prose(10, 30)), (None, None)], "item_id long, text string").write.mode("overwrite").parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(5, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_do_their_work(spark, tmp_path):
    passage = cases.prose(20, 70)
    rows = [
        (1, cases.prose(1, 80)), (2, "idiot moron scum " + cases.prose(2, 60)), (3, cases.prose(3, 80)), (4, cases.prose(3, 80)), (5, cases.prose(5, 40) + " " + passage),
        (6, passage + " " + cases.prose(6, 60)), (7, cases.prose(7, 40) + " " + cases.prose(10, 14)), (8, cases.prose(8, 100)),
    ]
    more = [(100 + i, cases.prose(100 + i, 60)) for i in range(60)] + [(200 + i, cases.prose(200 + i, 50) + " idiot scum moron") for i in range(6)]
    where = tables(spark, tmp_path, cases.documents(spark, rows + more))
    docs = spark.read.parquet(f"{where}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, where)
        docs.write.parquet(f"{where}/{name}")
        docs = spark.read.parquet(f"{where}/{name}")
        assert {100 + i for i in range(60)} <= {r.doc_id for r in docs.collect()} or name == "mixing"
        kept.append({r.doc_id: r for r in docs.collect() if not 100 <= r.doc_id < 200})
    assert set(kept[0]) == {1, 3, 4, 5, 6, 7, 8}
    assert set(kept[1]) == {1, 3, 5, 6, 7, 8}
    assert passage in kept[2][5].text and passage not in kept[2][6].text
    assert set(kept[3]) == {1, 3, 5, 6, 8}
    for stage in kept[:4]:
        assert all(set(r.asDict()) == {"doc_id", "text", "lang", "source", "n_chars"} for r in stage.values())
    assert all(r.copies > 0 and r.taken == r.size * r.copies for r in kept[4].values())


@pytest.mark.parametrize("empty", [False, True])
def test_awkward_and_empty(spark, tmp_path, empty):
    where = tables(spark, tmp_path, cases.empty(spark) if empty else cases.documents(spark, cases.AWKWARD))
    docs = spark.read.parquet(f"{where}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, where)
        docs.write.parquet(f"{where}/{name}")
        docs = spark.read.parquet(f"{where}/{name}")
    assert corpus_pipeline.run(spark, where).count() == docs.count()
    assert empty == (docs.count() == 0)


def test_queries_are_named_by_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.queries())
    assert numbers == list(range(1, 11))
