"""Quality measures against a plain count, and the estimation against a plain EM."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from eventide.llm import quality

SCHEMA = "doc_id long, text string, n_words string, _id string"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w in windows if windows.count(w) > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        n < 10 or 100 * len(covered) > 20 * n,
    )


def texts():
    rng = random.Random(3)
    out = [None, "", " \n\n\t", "a", "a b c d e f g h i j", "x y " * 30, "line\nline \nline\n\nline", "é🙂 " * 12, "a\x0bb\x0cc\rd e"]
    out += ["p q r s t u v w " * 3 + " ".join(map(str, range(60)))] * 2
    for _ in range(40):
        out.append("".join(rng.choice(["a ", "b ", "c\n", "dd|", "e#  ", "F "]) for _ in range(rng.randint(0, 60))))
    return out


def test_measures(spark):
    data = [(i if i % 9 else None, t, "clash", "clash") for i, t in enumerate(texts())]
    df = spark.createDataFrame(data, SCHEMA)
    got = quality.judge(df).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(brute(t) for t in texts())
    assert all(not (r.kept and r.base_failed) and 0 <= r.quality <= 1 for r in got)
    assert quality.judge(df.limit(0)).count() == 0


def plain_em(patterns, names, rounds):
    model = {"p": quality.PRIOR_GOOD, "good": {n: quality.PRIOR["good"] for n in names}, "bad": {n: quality.PRIOR["bad"] for n in names}}

    def good(v):
        a, b = model["p"], 1 - model["p"]
        for n, x in zip(names, v, strict=True):
            a, b = a * model["good"][n][x + 1], b * model["bad"][n][x + 1]
        return a / (a + b)

    total = sum(patterns.values())
    for _ in range(rounds):
        post = {v: good(v) for v in patterns}
        extra = quality.PRIOR_SHARE * total
        mass = {"good": sum(c * post[v] for v, c in patterns.items())}
        mass["bad"] = total - mass["good"]
        new = {"p": (mass["good"] + extra * quality.PRIOR_GOOD) / (total + extra), "good": {}, "bad": {}}
        for y in ("good", "bad"):
            for k, n in enumerate(names):
                new[y][n] = tuple(
                    (sum(c * (post[v] if y == "good" else 1 - post[v]) for v, c in patterns.items() if v[k] == x) + extra * quality.PRIOR[y][n_]) / (mass[y] + extra)
                    for x, n_ in ((-1, 0), (0, 1), (1, 2))
                )
        model = new
    return {v: good(v) for v in patterns}


def test_estimation_is_plain_em(spark):
    names = ["a", "b", "c"]
    rng = random.Random(1)
    patterns = {}
    for _ in range(3000):
        is_good = rng.random() < 0.7
        v = tuple(rng.choices((-1, 0, 1), (0.05, 0.3, 0.65) if is_good else (0.6, 0.3, 0.1))[0] for _ in names)
        patterns[v] = patterns.get(v, 0) + 1
    df = spark.createDataFrame([(*v, c) for v, c in patterns.items()], "v_a int, v_b int, v_c int, n long").cache()
    model = quality.estimate(df, names, iterations=6)
    want = plain_em(patterns, names, 6)
    for r in df.withColumn("p", quality.posterior(model, names)).collect():
        assert r.p == pytest.approx(want[(r.v_a, r.v_b, r.v_c)], abs=1e-3)
    assert math.isclose(sum(model["good"]["a"]), 1)


def test_clean_texts_stay_and_junk_goes(spark):
    path = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    rows = quality.judge(docs).join(labels, "doc_id").where("NOT base_failed").collect()
    good = [r.kept for r in rows if r[-2] == 1]
    bad = [r.kept for r in rows if r[-2] == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_estimates_share_generated_code(spark, capsys):
    """Or each round of the estimation makes classes of its own, on the driver and the executors."""
    names = list(quality.votes())
    df = spark.range(4).select(*[(F.col("id") % 3 - 1).alias(f"v_{n}") for n in names])
    made = []
    for p_good in (0.4, 0.7):
        model = {"p_good": p_good} | {y: {n: tuple(x * p_good for x in quality.PRIOR[y]) for n in names} for y in ("good", "bad")}
        model["good"] = {n: (a, b, c + p_good) for n, (a, b, c) in model["good"].items()}
        df.select(quality.posterior(model, names).alias("p")).explain("codegen")
        made.append([x for x in capsys.readouterr().out.splitlines() if re.match(r"/\* \d+ \*/", x)])
    assert made[0] and made[0] == made[1]
