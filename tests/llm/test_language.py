"""Language mixture: held-out accuracy, mixed texts, the estimation against a plain EM."""

import random
import zlib

import numpy as np

from eventide.llm import language

SCHEMA = "doc_id long, text string, lang string, held_out string, score string"


def test_held_out_accuracy_on_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert np.mean([r.lang_pred == r.lang for r in held]) >= 0.97


def made():
    rng = random.Random(1)
    words = {"aa": ["kala", "tuli", "mina", "sata"], "bb": ["xorp", "zwick", "gnaf", "brx"], "cc": ["éçà", "ñoño", "üöß", "œuf"]}
    rows = []
    for i in range(300):
        lang = ["aa", "bb", "cc"][i % 3]
        rows.append((i, " ".join(rng.choice(words[lang]) for _ in range(30)) + ".", lang))
    mixed = " ".join(words["aa"] * 6 + words["cc"] * 3)
    extra = [None, "", "12 !? \n", mixed, mixed.upper(), "kala " * 250_000, "Kala"]
    rows += [(1000 + i, t, None) for i, t in enumerate(extra)] + [(None, "gnaf gnaf brx", "bb"), (5, "xorp", "bb"), (5, "xorp", "bb")]
    return rows


def test_mixed_texts_and_edge_cases(spark):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in made()], SCHEMA)
    got = language.identify(df).collect()
    by = {r.doc_id: r for r in got if r.doc_id is not None and r.doc_id >= 1000}
    assert len(got) == len(made())
    assert [by[1000 + i].lang_pred for i in range(7)] == ["und"] * 3 + ["aa"] * 4
    assert [by[1000 + i].score for i in range(3)] == [0.0] * 3
    for i in (1003, 1004):
        assert by[i].languages == ["aa", "cc"] and abs(by[i].score - 2 / 3) < 0.05
    assert by[1005].languages == ["aa"] and by[1005].score > 0.99
    null = [r for r in got if r.doc_id is None]
    assert [(r.held_out, r.lang_pred) for r in null] == [(False, "bb")]
    assert language.identify(df.limit(0)).count() == 0
    unlabelled = language.identify(df.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


def test_language_of_a_held_out_row_teaches_nothing(spark):
    rows = [(i, "zzz qqq", "wrong") for i in range(200) if zlib.crc32(str(i).encode()) % 3 == 1]
    df = spark.createDataFrame([*made()[:300], *rows], "doc_id long, text string, lang string")
    assert "wrong" not in {r.lang_pred for r in language.identify(df).collect()}


def test_mixture_is_plain_em():
    rng = np.random.default_rng(3)
    sizes = [5, 1, 0, 40, 7]
    owner = np.repeat(np.arange(5), sizes)
    words = rng.normal(size=(len(owner), 3)).astype(np.float32) * 3
    p, s = language.mixture(words, owner, 5)

    def em(rows, keep):
        like = np.exp(rows - rows.max(axis=1, keepdims=True))
        q = keep / keep.sum()
        for _ in range(language.EM_STEPS):
            joint = like * q
            q = (joint / joint.sum(axis=1, keepdims=True)).mean(axis=0)
        return q, np.log((like * q).sum(axis=1)).sum()

    for i in range(5):
        rows = words[owner == i].astype(float)
        if not len(rows):
            assert not s[i].any() and not p[i].any()
            continue
        keep = np.ones(3)
        q, score = em(rows, keep)
        while keep.sum() > 1:
            trial = keep.copy()
            trial[np.where(keep > 0, q, np.inf).argmin()] = 0
            q2, score2 = em(rows, trial)
            if score - score2 >= 0.5 * np.log(max(len(rows), 2)):
                break
            keep, q, score = trial, q2, score2
        assert (s[i] == (keep > 0)).all() and np.allclose(p[i], q, atol=1e-3)
