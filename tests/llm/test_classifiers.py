import random

import numpy as np
import pytest

from vellum.llm import language, quality, toxicity

from . import cases

EN = "the of and to in that is was for with as his they this have from one had word but not what all were when your can said there use each which she how their".split()
DE = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um".split()
FR = "le la les de des un une et est dans que qui pour par sur pas plus avec tout faire son mais nous vous leur cette être deux même aussi".split()
ES = "el la los de que y en un una por con no se su para como más pero sus le ya este sí porque esta entre cuando muy sin sobre también".split()


def sentence(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string, score string, kind string")


def test_language(spark):
    rng = random.Random(1)
    rows = [(i, sentence(rng, w, rng.randint(8, 40)), lang) for i in range(600) for lang, w in [list(zip(("en", "de", "fr", "es"), (EN, DE, FR, ES), strict=True))[i % 4]]]
    rows += [(9001, None, "en"), (9002, "", "de"), (9003, "123 !!! 456", "fr"), (9004, sentence(rng, DE, 20), None)]
    got = {r.doc_id: r for r in language.report(cases.documents(spark, rows)).collect()}
    import zlib

    held = [(d, lang) for d, t, lang in rows[:600] if got[d].held_out]
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, *_ in rows)
    assert np.mean([got[d].lang_pred == lang for d, lang in held]) > 0.97
    assert [got[d].lang_pred for d in (9001, 9002, 9003)] == ["und"] * 3 and got[9004].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_awkward(spark):
    assert language.report(cases.empty(spark)).count() == 0
    rows = language.report(cases.awkward(spark)).collect()
    assert len(rows) == len(cases.AWKWARD)
    only = language.report(cases.documents(spark, [(i, "abc def", None) for i in range(5)])).collect()
    assert {r.lang_pred for r in only} == {"und"}


def test_toxicity(spark):
    rng = random.Random(2)
    rows, marks = [], []
    for i in range(900):
        words = sentence(rng, EN if i % 2 else DE, rng.randint(10, 60)).split()
        toxic = i % 8 == 0
        if toxic:
            for _ in range(3):
                # the German insults are in no list: they are known by labels, in many forms
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "scum", "loser"]) if i % 2 else "blorf" + rng.choice(["en", "ung", "lich", "heit"]))
        if i % 16 == 4:
            words.append("you are pathetic")
            toxic = True
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(toxic), "", "", ""))
    got = {r.doc_id: r for r in toxicity.report(cases.documents(spark, rows), labels(spark, marks)).collect()}
    held = [m for m in marks if got[m[0]].held_out]
    assert np.mean([got[m[0]].predicted == m[2] for m in held]) > 0.97
    assert all(r.predicted == int(r.score >= 0.5) for r in got.values())
    kept = toxicity.drop_toxic(cases.documents(spark, rows, cases.CLASHING), labels(spark, marks))
    assert {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if not r.predicted}


def test_label_model_counts_correlated_voters_once():
    rng = np.random.default_rng(3)
    n, m = 20000, len(toxicity.VOTERS)
    y = rng.random(n) < 0.3
    votes = np.full((n, m), -1, np.int8)
    flip = lambda p: np.where(rng.random(n) < p, ~y, y).astype(np.int8)
    votes[:, 0], votes[:, 1], votes[:, 2] = flip(0.1), flip(0.15), flip(0.3)
    for j in (3, 4, 5):
        votes[:, j] = votes[:, 2]  # three copies of the poor voter
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = toxicity.LabelModel(patterns, counts.astype(float), 0.3)
    right = ((model.posterior(votes) > 0.5) == y).mean()
    assert right > 0.85 and abs(model.accuracy[0] - 0.9) < 0.06


def test_toxicity_awkward(spark):
    none = labels(spark, [(1, 1, 1, "", "", "")]).limit(0)
    assert toxicity.report(cases.empty(spark), none).count() == 0
    odd = labels(spark, [(None, None, None, None, None, None), (5, None, None, "", "", ""), (6, 1, 1, "", "", ""), (6, 1, 0, "", "", "")])
    for marks in (none, odd, None):
        assert toxicity.report(cases.awkward(spark), marks).count() == len(cases.AWKWARD)
        assert toxicity.drop_toxic(cases.awkward(spark), marks).columns == cases.awkward(spark).columns


def junk(rng, n):
    return " ".join(rng.choice(EN) + rng.choice(["***", "$$$", "%%%"]) for _ in range(n))


def test_quality(spark):
    rng = random.Random(4)
    rows, marks = [], []
    for i in range(1600):
        good = rng.random() < 0.8
        rows.append((i, sentence(rng, EN, rng.randint(15, 60)) if good else junk(rng, rng.randint(15, 60))))
        if rng.random() < 0.5:
            marks.append((i, int(good), 0, "", "", ""))
    got = {r.doc_id: r for r in quality.report(cases.documents(spark, rows), labels(spark, marks)).collect()}
    held = [m for m in marks if got[m[0]].held_out]
    assert np.mean([got[m[0]].predicted == m[1] for m in held]) > 0.95
    only_positive = [m for m in marks if m[1] == 1]
    again = {r.doc_id: r.score for r in quality.report(cases.documents(spark, rows), labels(spark, only_positive)).collect()}
    assert again == pytest.approx({d: r.score for d, r in got.items()})  # labels of 0 are never read


def test_prior_estimate():
    rng = np.random.default_rng(5)
    p = rng.normal(2, 1, 6000)
    u = np.concatenate([rng.normal(2, 1, 4200), rng.normal(-2, 1, 1800)])
    assert abs(quality.estimate_prior(p, u) - 0.7) < 0.05


def test_quality_awkward(spark):
    none = labels(spark, [(1, 1, 1, "", "", "")]).limit(0)
    assert quality.report(cases.empty(spark), none).count() == 0
    rows = quality.report(cases.awkward(spark), none).collect()
    assert len(rows) == len(cases.AWKWARD) and {r.score for r in rows} == {0.5}
    odd = labels(spark, [(None, 1, None, None, None, None), (5, 1, None, "", "", ""), (6, 1, 1, "", "", ""), (6, 0, 0, "", "", ""), (8, 1, 0, "", "", "")])
    assert quality.report(cases.awkward(spark), odd).count() == len(cases.AWKWARD)
