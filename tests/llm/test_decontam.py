"""Decontamination against a plain search, paraphrases, edge cases, the latent space."""

import random

import numpy as np
import regex

from eventide.llm import decontam

SCHEMA = "doc_id long, text string, item_id string, cosine string"


def words(text):
    return regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())


def holds(text, item):
    return f" {' '.join(words(item))} " in f" {' '.join(words(text))} "


def test_lcs():
    rng = random.Random(5)
    for _ in range(200):
        a = [rng.randint(0, 6) for _ in range(rng.randint(1, 25))]
        b = [rng.randint(0, 6) for _ in range(rng.randint(0, 40))]
        row = [0] * (len(b) + 1)
        for x in a:
            last = list(row)
            for j, y in enumerate(b, 1):
                row[j] = last[j - 1] + 1 if x == y else max(row[j - 1], last[j])
        assert decontam.lcs_length(decontam.lcs_masks(a), b) == row[-1]


def test_every_copy_is_found_and_clean_documents_stay_clean(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, items).collect()}
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    want = {(i, r.item_id) for r in items.collect() for i, t in texts if holds(t, r.text)}
    assert len(want) > 20 and got == want


def fixture():
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(2000)]
    common = ["the", "of", "and", "to", "in"]

    def prose(n):
        return [rng.choice(common) if rng.random() < 0.4 else rng.choice(vocabulary) for _ in range(n)]

    items = [" ".join(prose(rng.randint(14, 60))) for _ in range(60)]
    docs = [" ".join(prose(rng.randint(0, 400))) for _ in range(120)]
    leaks = set()
    for k in range(40):
        w = items[k].split()
        kind = k % 4
        if kind == 1:  # a fifth of the words replaced
            for j in rng.sample(range(len(w)), len(w) // 5):
                w[j] = "other"
        elif kind == 2:  # words put in between
            w = [x for y in w for x in ([y, "well"] if rng.random() < 0.2 else [y])]
        elif kind == 3:  # other case and marks
            w = [x.upper() + rng.choice((",", ".", "!?", "")) for x in w]
        around = prose(300)
        at = rng.randint(0, 300)
        docs.append(" ".join(around[:at] + w + around[at:]))
        leaks.add((len(docs) - 1, k))
    return items, docs, leaks


def test_copies_and_paraphrases(spark):
    items, docs, leaks = fixture()
    docs += [None, "", "...", "the of and", "w1 " * 30_000]
    rows = [(i, t, "clash", "clash") for i, t in enumerate(docs)] + [(None, docs[120], "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    bench = spark.createDataFrame([(i, t) for i, t in enumerate([*items, None, "", "?!", items[0]])], "item_id long, text string")
    for at_once in (1000, 25):
        got = decontam.contaminated(df, bench, items_at_once=at_once, rank=32).collect()
        found = {(r.doc_id, r.item_id) for r in got}
        assert {p for p in found if p[1] == 63} == {(120, 63), (None, 63)}  # a repeated item
        found = {p for p in found if p[1] != 63}
        assert len(found & leaks) >= 0.9 * len(leaks)  # recall of the latent search
        assert found - leaks == {(None, 0)}
    assert all(0 <= r.lcs <= 1 and r.cosine >= decontam.COSINE - 1e-6 for r in got)
    assert decontam.contaminated(df.limit(0), bench).count() == 0
    assert decontam.contaminated(df, bench.limit(0)).count() == 0


def test_answers_are_checked(spark):
    docs = spark.createDataFrame([(1, "what is the capital city of northland it is surely oslund"), (2, "what is the capital city of northland nobody can ever tell me")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "what is the main capital city of old northland", "surely oslund")], "item_id long, text string, answer string")
    got = decontam.contaminated(docs, bench, answer_col="answer").collect()
    by = {r.doc_id: r.answer for r in got}
    assert by.get(1) == 1.0 and by.get(2, 0.0) == 0.0


def test_latent_space_is_that_of_a_plain_svd(spark):
    items, docs, _ = fixture()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "id long, text string")
    index = decontam.make_index([(i, t, None) for i, t in enumerate(items)], df, 32)
    decontam.fit_latent(index, df, 20, 32, 10**6)
    rows = []
    for t in docs:
        for _, hashes, begins in decontam.slices([decontam.normal_bytes(t)]):
            first, _, _, total, f = decontam.windows(index, hashes, begins, 32)
            for w in first:
                row = np.zeros(len(index.features))
                np.add.at(row, f[total[w] : total[w + index.window]], 1)
                rows.append(row * index.weight)
    rows = decontam._unit(np.array(rows))
    q = decontam.item_rows(index)
    gram = rows.T @ rows / len(rows) + q.T @ q / len(q)
    best = np.sort(np.linalg.eigvalsh(gram))[::-1][:20].sum()
    basis = index.basis / index.weight[:, None]
    assert np.allclose(basis.T @ basis, np.eye(20), atol=1e-4)
    assert np.trace(basis.T @ gram @ basis) >= 0.95 * best


def test_latent_space_is_fitted_on_all_passages(spark, monkeypatch):
    """More than 5,000 documents: every passage is in the products, as one by one."""
    monkeypatch.setattr(decontam, "GRAM_BLOCK", 1 << 12)
    items, docs, _ = fixture()
    rng = random.Random(2)
    docs = [*docs, None, "", *(" ".join(rng.choices(items[i % 60].split(), k=rng.randint(1, 40))) for i in range(5_500))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "id long, text string").repartition(5)
    index = decontam.make_index([(i, t, None) for i, t in enumerate(items)], df, 32)
    rows = []
    for t in docs:
        for _, hashes, begins in decontam.slices([decontam.normal_bytes(t)]):
            first, _, _, total, f = decontam.windows(index, hashes, begins, 32)
            rows += [np.bincount(f[total[w] : total[w + index.window]], minlength=len(index.features)) for w in first]
    rows = decontam._unit(np.array(rows) * index.weight)
    blocks = decontam.gram(index, df, 32).cache()
    assert sum(r.mass for r in blocks.collect()) == len(rows) > 5_500
    q = np.random.default_rng(1).normal(size=(len(index.features), 7))
    want = rows.T @ (rows @ q)
    assert np.abs(decontam.gram_product(blocks, q) - want).max() < 1e-4 * np.abs(want).max()


def test_a_passing_stretch_is_not_hidden():
    """Beside a stretch with more of the item's words, one that passes by its answer counts."""
    item = list(range(20))
    answer = [17, 18, 19]
    near = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12] + [100 + i for i in range(17)]
    far = [5, 6, 7, 8, 9, 10, 11, 12, 200, 13, 201, 17, 18, 19] + [300 + i for i in range(16)]
    whole, said = decontam.lcs_masks(item), decontam.lcs_masks(answer)
    lcs, share = decontam.word_check(whole, said, near + far)
    assert decontam.passes(lcs, share) and share == 1.0 and lcs < 13 / 20
    lcs, share = decontam.word_check(whole, said, near)
    assert lcs == 13 / 20 and not decontam.passes(lcs, share)
