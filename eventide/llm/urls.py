"""URL filter: host/path rules first, then a weighted vocabulary found by Aho-Corasick.

The rules and the host/path split are column expressions.  Only the multi-pattern
search runs in Python, on Arrow batches: one automaton per worker finds all terms in one
pass over a url, whatever the size of the vocabulary.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.session import ship_package

#: (verdict, rule): host and its subdomains, then the start of the path.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

#: One hit of a strict term rejects.
STRICT_TERMS = (
    "porn", "xxx", "casino", "viagra", "cheap-pills", "escort", "hentai", "warez", "malware", "phishing",
)
#: Weights of soft terms; distinct ones count, and their weights must reach ``SOFT_WEIGHT``.
SOFT_TERMS = {
    "cheap": 1.0, "pills": 1.0, "free": 1.0, "win": 1.0, "bonus": 1.0, "bet": 1.0, "poker": 1.5, "sex": 1.5,
    "adult": 1.0, "dating": 1.0, "loan": 1.0, "loans": 1.0, "crypto": 1.0, "torrent": 1.0, "deals": 0.5,
    "discount": 0.5, "offer": 0.5, "bets": 1.5, "spam": 1.5, "farm": 1.0, "ads": 1.0, "track": 1.0,
}
SOFT_DISTINCT = 2
#: Terms that a vocabulary table may have at most: they go to every task.
MOST_TERMS = 500_000
SOFT_WEIGHT = 2.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BOUND = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def term_hits(automaton, url: str) -> tuple[int, int, float]:
    """(distinct strict terms, distinct soft terms, their weight) of a lower-case url.

    A hit counts where neither neighbour is an ASCII letter or digit.
    """
    strict, soft = set(), {}
    for last, (term, weight) in automaton.iter(url):
        first = last - len(term) + 1
        if (first and url[first - 1] in _BOUND) or (last + 1 < len(url) and url[last + 1] in _BOUND):
            continue
        if weight is None:
            strict.add(term)
        else:
            soft[term] = weight
    return len(strict), len(soft), float(sum(soft.values()))


def build_automaton(strict: Sequence[str], soft: dict[str, float]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for term, weight in [*soft.items(), *((t, None) for t in strict)]:
        automaton.add_word(term.lower(), (term.lower(), weight))
    automaton.make_automaton()
    return automaton


def vocabulary(table: DataFrame, most: int = MOST_TERMS) -> tuple[list[str], dict[str, float]]:
    """(strict, soft) terms for ``judge_urls`` from a table of ``term, weight``; a NULL weight is
    strict, and so is a term that stands there as both.

    Terms are lower-cased (A-Z) and trimmed; empty and NULL ones say nothing; of repeated soft
    terms the largest weight counts.  A table of over ``most`` terms is an error, as all tasks get
    a copy."""
    term = F.trim(F.translate(F.col("term"), _UPPER, _LOWER))
    rows = table.select(term.alias("term"), F.col("weight").cast("double").alias("weight")).where("term <> ''")
    rows = rows.groupBy("term").agg(F.max(F.col("weight").isNull()).alias("strict"), F.max("weight").alias("weight"))
    found = rows.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"a vocabulary of over {most} terms")
    return sorted(r.term for r in found if r.strict), {r.term: r.weight for r in sorted(found) if not r.strict}


def judge_urls(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    strict: Sequence[str] = STRICT_TERMS,
    soft: dict[str, float] = SOFT_TERMS,
    soft_distinct: int = SOFT_DISTINCT,
    soft_weight: float = SOFT_WEIGHT,
) -> DataFrame:
    """One row per row of ``pages``: ``id_col, host, path, rule, verdict, n_strict, n_soft, soft_weight``.

    The longest rule that fits decides (of two as long, that with the longer host).
    Else the vocabulary does: block on one strict term, or on ``soft_distinct`` distinct
    soft terms whose weights sum to ``soft_weight``.  ``rules`` and the vocabularies are
    parameters of the plan, not data.

    NULL url, or one without ``://``: empty host and path, no rule; the vocabulary still
    reads what there is (NULL: no hit, allowed).  Repeated rows and NULL ids give a row
    each, other columns are not read.
    """
    ship_package(pages.sparkSession)
    url = F.col(url_col)
    parts = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), parts, 1), _UPPER, _LOWER)
    path = F.regexp_extract(F.coalesce(url, F.lit("")), parts, 2)
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path"), url.alias("_url"))

    found = F.lit(None).cast("string")
    verdict = F.lit(None).cast("string")
    for decision, rule in sorted(rules, key=lambda r: (len(r[1]), r[1].index("/"))):  # the last one wins
        name, _, rest = rule.partition("/")
        fits = ((F.col("host") == name) | F.col("host").endswith(f".{name}")) & F.col("path").startswith(f"/{rest}")
        found = F.when(fits, F.lit(rule)).otherwise(found)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)

    strict, soft = list(strict), dict(soft)
    made: list = []

    @F.pandas_udf("n_strict int, n_soft int, weight double")
    def hits(urls: pd.Series) -> pd.DataFrame:
        if not made:
            made.append(build_automaton(strict, soft))
        lowered = urls.fillna("").str.translate(str.maketrans(_UPPER, _LOWER))
        return pd.DataFrame([term_hits(made[0], u) for u in lowered], columns=["n_strict", "n_soft", "weight"])

    by_terms = F.when(
        (F.col("_h.n_strict") >= 1) | ((F.col("_h.n_soft") >= soft_distinct) & (F.col("_h.weight") >= soft_weight)),
        F.lit("block"),
    ).otherwise(F.lit("allow"))
    return rows.withColumn("_h", hits(F.col("_url"))).select(
        id_col,
        "host",
        "path",
        found.alias("rule"),
        F.coalesce(verdict, by_terms).alias("verdict"),
        F.col("_h.n_strict").alias("n_strict"),
        F.col("_h.n_soft").alias("n_soft"),
        F.col("_h.weight").alias("soft_weight"),
    )


def oracle(table: str = "pages") -> str:
    """DuckDB SQL of ``judge_urls`` with the default rules and vocabulary."""
    low = f"translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}')"

    def hit(term: str) -> str:
        return f"CAST(regexp_matches(u, '(^|[^a-z0-9]){term}([^a-z0-9]|$)') AS INTEGER)"

    strict = " + ".join(hit(t) for t in STRICT_TERMS)
    soft = " + ".join(hit(t) for t in SOFT_TERMS)
    weight = " + ".join(f"{w} * {hit(t)}" for t, w in SOFT_TERMS.items())
    rule, verdict = "NULL", "NULL"
    for decision, r in sorted(RULES, key=lambda r: (len(r[1]), r[1].index("/"))):
        name, _, rest = r.partition("/")
        fits = f"(host = '{name}' OR suffix(host, '.{name}')) AND starts_with(path, '/{rest}')"
        rule, verdict = f"CASE WHEN {fits} THEN '{r}' ELSE {rule} END", f"CASE WHEN {fits} THEN '{decision}' ELSE {verdict} END"
    return f"""
    WITH p AS (
      SELECT page_id, {low} AS u,
             translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
             regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
      FROM {table}),
    h AS (
      SELECT page_id, host, path, CAST({rule} AS VARCHAR) AS rule, CAST({verdict} AS VARCHAR) AS ruled,
             CAST({strict} AS INTEGER) AS n_strict, CAST({soft} AS INTEGER) AS n_soft, CAST({weight} AS DOUBLE) AS soft_weight
      FROM p)
    SELECT page_id, host, path, rule, n_strict, n_soft, soft_weight,
           coalesce(ruled, CASE WHEN n_strict >= 1 OR (n_soft >= {SOFT_DISTINCT} AND soft_weight >= {SOFT_WEIGHT})
                                THEN 'block' ELSE 'allow' END) AS verdict
    FROM h"""
