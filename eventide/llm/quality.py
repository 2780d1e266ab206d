"""Quality rules as weak supervision (DataFrame functions only).

Each rule looks at a whole text and votes for (+1), against (-1) or abstains (0).  No
rule decides by itself: expectation-maximisation estimates, without labels, how often a
rule gives each vote to good and to bad texts, and the posterior probability that a text
is good replaces the all-rules-must-pass filter.

The votes of all texts are counted by pattern first.  There are at most 3 ** rules
patterns whatever the corpus, so an iteration is one aggregate over that small table, and
only its sums (two per rule and vote) come to the driver.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import WORD, written

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: Frequent function words of the languages expected; lower case.
FUNCTION_WORDS = (
    "the of and to in is that for was on with as at by this from are be it an or not have which "
    "de la le les et des en un une du que pour dans est sur qui par avec au pas plus ne ce "
    "el los las y del se por con una su para es al lo como más pero o "
    "der die das und zu den mit von für im dem nicht ein eine auf ist sich auch aus wie war"
).split()

#: Votes before any text is seen: P(vote | good), P(vote | bad) for the votes -1, 0, +1.
PRIOR = {"good": (0.03, 0.27, 0.70), "bad": (0.50, 0.30, 0.20)}
PRIOR_GOOD = 0.85
#: The prior counts as so large a share of the texts.
PRIOR_SHARE = 0.05
ITERATIONS = 40
TOLERANCE = 1e-4


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0)).cast("byte")


def measured(docs: DataFrame, id_col: str, text_col: str, keep: list[str]) -> DataFrame:
    """The measures of each whole text, in one narrow pass."""
    d = docs.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)],
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("t"),
    )
    d = d.withColumn("w", F.regexp_extract_all("t", F.lit(WORD), F.lit(0)))
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.withColumn("lines", lines).withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    # Windows of five words as hashes; only a text with two equal ones goes on to the
    # sort that finds where they are.
    at = F.sequence(F.lit(0), F.size("h") - WINDOW)
    windows = F.when(
        F.size("h") >= WINDOW,
        F.transform(at, lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))
    d = d.withColumn("win", windows)
    ordered = F.when(
        F.size(F.array_distinct("win")) < F.size("win"),
        F.sort_array(F.transform("win", lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
    )
    d = d.withColumn("s", ordered)
    same = F.transform(
        F.filter(
            F.sequence(F.lit(0), F.size("s") - 1),
            lambda i: F.get("s", i)["h"].eqNullSafe(F.get("s", i - 1)["h"])
            | F.get("s", i)["h"].eqNullSafe(F.get("s", i + 1)["h"]),
        ),
        lambda i: F.get("s", i)["i"],
    )
    d = d.withColumn("p", F.when(F.col("s").isNotNull(), F.sort_array(same)))
    covered = F.when(F.col("p").isNull(), F.lit(0)).otherwise(
        F.aggregate(
            F.sequence(F.lit(0), F.size("p") - 1),
            F.lit(0),
            lambda n, i: n + F.least(F.lit(WINDOW), F.coalesce(F.get("p", i + 1) - F.get("p", i), F.lit(WINDOW))),
        )
    )

    def left_without(pattern: str) -> Column:
        return F.length("t") - F.length(F.regexp_replace("t", pattern, ""))

    return d.select(
        *[c for c in d.columns if c.startswith("_")],
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        left_without(r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        left_without(r"\p{L}+").cast("long").alias("n_letters"),
        left_without(r"\p{Lu}+").cast("long").alias("n_upper"),
        F.size(F.array_intersect("w", F.array(*map(F.lit, FUNCTION_WORDS)))).cast("long").alias("n_function"),
    )


def votes() -> dict[str, Column]:
    """The rules over the measures."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return {
        "length": _vote(n < MIN_WORDS, n >= 40),
        "word_length": _vote((chars < 2 * n) | (chars > 12 * n), (chars >= 3 * n) & (chars <= 9 * n)),
        "symbols": _vote(F.col("n_symbols") * 10 > n, F.col("n_symbols") * 50 <= n),
        "letters": _vote(F.col("n_letters") * 10 < chars * 7, F.col("n_letters") * 10 >= chars * 9),
        "upper_case": _vote(F.col("n_upper") * 10 > F.col("n_letters") * 3, F.col("n_upper") * 10 <= F.col("n_letters")),
        "repeated_lines": _vote(F.col("n_dup_lines") * 10 > F.col("n_lines") * 3, F.col("n_dup_lines") == 0),
        "repeated_words": _vote(F.col("n_repeat_words") * 100 > n * MAX_REPEAT_PERCENT, F.col("n_repeat_words") == 0),
        "function_words": _vote((F.col("n_function") == 0) & (n >= 20), F.col("n_function") >= 3),
    }


def log_odds(model: dict, names: list[str]) -> Column:
    """Log odds that a text with these votes is good."""

    each = []
    for name in names:
        each += [math.log(g / b) for g, b in zip(model["good"][name], model["bad"][name], strict=True)]
    prior = math.log(model["p_good"] / (1 - model["p_good"]))
    each[:3] = [prior + x for x in each[:3]]
    # One array: its numbers are no part of the code that Spark makes, which serves all estimates.
    numbers = F.array(*map(F.lit, each))

    def ratio(i: int, name: str) -> Column:
        v = F.col(f"v_{name}")
        return F.get(numbers, F.when(v < 0, 3 * i).when(v > 0, 3 * i + 2).otherwise(3 * i + 1))

    return reduce(add, [ratio(i, n) for i, n in enumerate(names)])


def posterior(model: dict, names: list[str]) -> Column:
    return 1 / (1 + F.exp(-log_odds(model, names)))


def estimate(patterns: DataFrame, names: list[str], iterations: int = ITERATIONS) -> dict:
    """Expectation-maximisation over ``patterns`` (``v_<rule>..., n``).

    E: the posterior of each pattern under the present estimates.  M: the share of each
    vote among good and among bad texts, with the prior counted as ``PRIOR_SHARE`` of the
    texts, so that a class that no text belongs to keeps the prior's.  Ends when no
    estimate moves by ``TOLERANCE``.
    """
    model = {"p_good": PRIOR_GOOD} | {y: {n: PRIOR[y] for n in names} for y in ("good", "bad")}
    for _ in range(iterations):
        p = posterior(model, names)
        sums = [F.sum("n").alias("n"), F.sum(F.col("n") * p).alias("good")]
        for n in names:
            for v in (-1, 0, 1):
                hit = F.when(F.col(f"v_{n}") == v, F.col("n")).otherwise(0)
                sums += [F.sum(hit).alias(f"{n}{v}"), F.sum(hit * p).alias(f"{n}{v}_good")]
        got = patterns.agg(*sums).first()
        if not got["n"]:
            return model
        extra = PRIOR_SHARE * got["n"]
        size = {"good": got["good"], "bad": got["n"] - got["good"]}
        new = {"p_good": (size["good"] + extra * PRIOR_GOOD) / (got["n"] + extra), "good": {}, "bad": {}}
        for n in names:
            for y in ("good", "bad"):
                counts = [got[f"{n}{v}_good"] if y == "good" else got[f"{n}{v}"] - got[f"{n}{v}_good"] for v in (-1, 0, 1)]
                new[y][n] = tuple(
                    (c + extra * q) / (size[y] + extra) for c, q in zip(counts, PRIOR[y], strict=True)
                )
        moved = max(
            abs(new["p_good"] - model["p_good"]),
            *(abs(a - b) for y in ("good", "bad") for n in names for a, b in zip(new[y][n], model[y][n], strict=True)),
        )
        model = new
        if moved < TOLERANCE:
            break
    return model


def judge(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, the columns ``keep``, the measures,
    ``base_failed``, ``quality`` (posterior that the text is good) and ``kept``.

    ``base_failed``: fewer than 10 words, or over 20 % of the words in five-word windows
    that occur twice.  ``kept``: not ``base_failed`` and ``quality >= threshold``.

    NULL or empty text: all measures 0, ``base_failed``.  Repeated rows and NULL ids give
    a row each.  Columns that are not in ``keep`` are not read.  Empty input: empty output.
    """
    keep = keep or []
    rules = votes()
    names = list(rules)
    m = measured(docs, id_col, text_col, keep)
    m = written(m.select("*", *[v.alias(f"v_{n}") for n, v in rules.items()]), "quality")
    patterns = written(
        m.groupBy(*[f"v_{n}" for n in names]).agg(F.count("*").alias("n")).coalesce(1), "quality-patterns"
    )
    model = estimate(patterns, names)
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    quality = posterior(model, names)
    return m.select(
        F.col("_id").alias(id_col),
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        quality.alias("quality"),
        (~base & (quality >= threshold)).alias("kept"),
    )
