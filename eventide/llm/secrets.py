"""Secret scan: fixed patterns, and the entropy of sliding windows (DataFrame functions only).

Patterns.  ``split`` and ``regexp_extract_all`` with the same pattern give the texts
between the matches and the matches; the running sum of their lengths gives positions in
code points.  Texts without a match never get that far.

Entropy.  A candidate is a run of letters, digits and ``+/_=-`` that has a digit and a
letter.  A window of ``WINDOW`` characters slides over it: the counts of its characters and
``sum(c * log2 c)`` are updated by the character that enters and the one that leaves, so a
step costs the same whatever the window.  A window's class is that of its own characters
(hexadecimal if all of them are, else base64) and sets its threshold, so a key is found behind
a name, ``=`` or a path.  Hot windows that overlap are one stretch, and each stretch a span.
An allow-list of well-known harmless forms suppresses whole candidates, or stretches by what
is in them; the fixed patterns' spans are never suppressed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: kind -> (pattern, group whose length counts, least length), in the order of listing.
KINDS = {
    "assign": (
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    "access": ("AKIA[A-Z0-9]+", 0, 16),
    "hex": ("[0-9a-f]+", 0, 32),
}
#: The same matches once the short ones are dropped: a run that fails has no later start
#: that would do, so these two need not stop at every short run.
_SEARCH = {"assign": KINDS["assign"][0], "access": "AKIA[A-Z0-9]{12,}", "hex": "[0-9a-f]{32,}"}

WINDOW = 20
#: Least entropy in bits of a window, by its class.
THRESHOLDS = {"hex": 2.9, "base64": 3.9}
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: For each letter of the alphabet whether it is hexadecimal.
_IS_HEX = "".join("1" if c in "ABCDEFabcdef0123456789" else "0" for c in _ALPHABET)

#: Candidates that match as a whole are no secrets: UUIDs, paths and identifiers made of words.
ALLOW = (
    r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",
    r"^[A-Za-z]{2,}([/_=+-]+([A-Za-z]{2,}|[0-9]{1,6}))+[/_=+-]*$",
    r"(?i)^(data|image|text|application)/",
)
#: Stretches that hold one of these are none: placeholders, alphabets and digit rows in order.
ALLOW_INSIDE = (
    r"(?i)placeholder|changeme|xxxx|your[_-]",
    r"(?i)abcdefgh|01234567|12345678|qwertz|qwerty",
)

_SPANS = "array<struct<s:bigint,e:bigint>>"


def pattern_spans(text: Column, kind: str) -> Column:
    """Spans ``{s, e}`` of one kind, in order; NULL for a text without a match."""
    _, group, least = KINDS[kind]
    pattern = _SEARCH[kind]

    def lengths(parts: Column) -> Column:
        return F.transform(parts, lambda x: F.length(x).cast("long"))

    between = lengths(F.split(text, pattern, -1))
    whole = lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    counted = lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)))
    found = F.arrays_zip(
        F.slice(between, F.lit(1), F.size(whole)).alias("b"), whole.alias("w"), counted.alias("c")
    )
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPANS).alias("out"))

    def step(acc: Column, m: Column) -> Column:
        s = acc["at"] + m["b"]
        e = s + m["w"]
        span = F.array(F.struct(s.alias("s"), e.alias("e")))
        return F.struct(e.alias("at"), F.when(m["c"] >= least, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    return F.when(text.rlike(pattern), F.aggregate(found, start, step, lambda acc: acc["out"]))


def _gain(c: Column) -> Column:
    """(c + 1) log2(c + 1) - c log2 c, the entropy sum's step from c to c + 1 occurrences."""

    def term(x: Column) -> Column:
        return F.when(x > 1, x * F.log2(x.cast("double"))).otherwise(F.lit(0.0))

    return term(c + 1) - term(c)


def hot_stretches(candidate: Column, window: int = WINDOW) -> Column:
    """Spans ``{s, e}`` inside ``candidate``: its runs of overlapping windows whose entropy is
    over the threshold of the window's class."""
    letters = F.array(*map(F.lit, _ALPHABET))
    codes = F.transform(F.split(candidate, ""), lambda ch: F.array_position(letters, ch).cast("int"))
    # The codes are bound as a lambda's variable, so they are made once.
    bound = F.array(F.filter(codes, lambda c: c > 0))
    none = F.lit(None).cast("bigint")

    def other(code: Column) -> Column:
        """1 for the code of a character that is not hexadecimal."""
        return F.when(code.isNull() | F.substring(F.lit(_IS_HEX), code, 1).eqNullSafe("1"), 0).otherwise(1)

    def scan(b: Column) -> Column:
        start = F.struct(
            F.array_repeat(F.lit(0), len(_ALPHABET)).alias("counts"),
            F.lit(0.0).alias("sum"),
            F.lit(0).alias("others"),
            none.alias("s"),
            none.alias("e"),
            F.array().cast(_SPANS).alias("out"),
        )

        def step(acc: Column, i: Column) -> Column:
            into = F.get(b, i)
            out = F.when(i >= window, F.get(b, i - window))
            had = F.get(acc["counts"], into - 1)
            leaves = F.get(acc["counts"], out - 1) + F.when(into == out, 1).otherwise(0)
            total = acc["sum"] + _gain(had) - F.coalesce(_gain(leaves - 1), F.lit(0.0))
            others = acc["others"] + other(into) - other(out)
            least = F.when(others == 0, F.lit(THRESHOLDS["hex"])).otherwise(F.lit(THRESHOLDS["base64"]))
            hot = (i >= window - 1) & (F.lit(math.log2(window)) - total / window >= least)
            first = (i - window + 1).cast("bigint")
            apart = hot & (acc["s"].isNull() | (first > acc["e"]))
            counts = F.transform(
                acc["counts"],
                lambda c, k: c
                + F.when(k == into - 1, 1).otherwise(0)
                - F.when(k == F.coalesce(out, F.lit(0)) - 1, 1).otherwise(0),
            )
            return F.struct(
                counts.alias("counts"),
                total.alias("sum"),
                others.alias("others"),
                F.when(apart, first).otherwise(acc["s"]).alias("s"),
                F.when(hot, (i + 1).cast("bigint")).otherwise(acc["e"]).alias("e"),
                F.when(apart, ended(acc)).otherwise(acc["out"]).alias("out"),
            )

        def ended(acc: Column) -> Column:
            return F.when(acc["s"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(acc["s"].alias("s"), acc["e"].alias("e")))))

        return F.aggregate(F.sequence(F.lit(0), F.size(b) - 1), start, step, ended)

    return F.get(F.transform(bound, scan), F.lit(0))


def entropy_spans(text: Column, allow: tuple[str, ...] = ALLOW, inside: tuple[str, ...] = ALLOW_INSIDE) -> Column:
    """Spans ``{s, e}`` found by entropy, in order; NULL for a text without a candidate."""
    between = F.transform(F.split(text, CANDIDATE, -1), lambda x: F.length(x).cast("long"))
    runs = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    found = F.arrays_zip(F.slice(between, F.lit(1), F.size(runs)).alias("b"), runs.alias("r"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPANS).alias("out"))

    def any_of(x: Column, patterns: tuple[str, ...]) -> Column:
        out = F.lit(False)
        for pattern in patterns:
            out = out | x.rlike(pattern)
        return out

    def mixed(x: Column) -> Column:
        return x.rlike("[0-9]") & x.rlike("[A-Za-z]")

    def step(acc: Column, m: Column) -> Column:
        s = acc["at"] + m["b"]

        def secret(span: Column) -> Column:
            part = F.substring(m["r"], (span["s"] + 1).cast("int"), (span["e"] - span["s"]).cast("int"))
            return mixed(part) & ~any_of(part, inside)

        hot = F.transform(F.filter(hot_stretches(m["r"]), secret), lambda x: F.struct((s + x["s"]).alias("s"), (s + x["e"]).alias("e")))
        more = F.when(mixed(m["r"]) & ~any_of(m["r"], allow), hot).otherwise(F.array().cast(_SPANS))
        return F.struct((s + F.length(m["r"])).alias("at"), F.concat(acc["out"], more).alias("out"))

    return F.when(text.rlike(CANDIDATE), F.aggregate(found, start, step, lambda acc: acc["out"]))


def _joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    names = F.array(*map(F.lit, [*KINDS, "entropy"]))
    return F.array_join(
        F.transform(
            F.sort_array(spans),
            lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string")),
        ),
        ",",
    )


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_assign, n_access, n_hex, base_sha256,
    spans, n_entropy``.

    A span of the entropy method that lies inside a pattern's span says nothing new and
    is left out.  Positions are code points of the whole text, ends exclusive.

    NULL or empty text: no spans, an empty ``spans`` and the hash of the empty string.
    Repeated rows and NULL ids give a row each; other columns are not read.
    """
    d = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    d = d.select("_id", *[pattern_spans(F.col("t"), k).alias(k) for k in KINDS], entropy_spans(F.col("t")).alias("entropy"))
    empty = F.array().cast(_SPANS)
    d = d.select("_id", *[F.coalesce(F.col(k), empty).alias(k) for k in [*KINDS, "entropy"]])
    base = F.concat(*[_with_kind(F.col(k), i) for i, k in enumerate(KINDS)])
    d = d.withColumn("base", base)
    new = F.filter(
        "entropy", lambda x: ~F.exists("base", lambda b: (b["s"] <= x["s"]) & (x["e"] <= b["e"]))
    )
    d = d.withColumn("new", new)
    return d.select(
        F.col("_id").alias(id_col),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat(F.col("base"), _with_kind(F.col("new"), len(KINDS)))).alias("spans"),
        F.size("new").cast("long").alias("n_entropy"),
    )


def _with_kind(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(kind).alias("k"), x["e"].alias("e")))
