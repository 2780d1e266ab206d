"""Language identification as mixture inference.

Model.  Per language, counts of hashed character n-grams (1 to 4, inside words with their
ends marked) of the training texts, smoothed; fitted by a distributed count over a
bounded sample of the labelled rows.  The table of log probabilities (languages x
buckets) is what the executors get; its size does not depend on the corpus.

Inference.  A text is a mixture: each of its words is written in one language, and the
likelihood of a word in a language is that of its n-grams.  Expectation-maximisation
estimates the languages' proportions of the words.  The language set is selected by
penalised likelihood: from all languages, the one with the smallest proportion is left
out as long as the log likelihood falls by less than a half of ln(words) for it.  The
language with the largest proportion is predicted, the proportion is the score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import written
from eventide.session import ship_package

BUCKETS = 1 << 15
NGRAMS = (1, 2, 3, 4)
#: At most about so many labelled rows are used to fit (a hash of the id picks them).
TRAIN_ROWS = 20_000
SMOOTHING = 0.1
EM_STEPS = 12
#: Code points that are looked at in one go; longer texts are cut at white space.
SLICE_POINTS = 1 << 20

_FOLD = np.zeros(0x110000, np.uint32)


def _fold() -> np.ndarray:
    """Code point -> its lower-case form if it is a letter, else 0."""
    if not _FOLD[ord("a")]:
        for c in range(0x110000):
            if not 0xD800 <= c < 0xE000 and (ch := chr(c)).isalpha():
                low = ch.lower()
                _FOLD[c] = ord(low) if len(low) == 1 else c
    return _FOLD


def letters_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(folded code points, text number) over all texts; a 0 follows each text."""
    joined = "\0".join(texts) + "\0"
    points = _fold()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    ends = np.cumsum([len(t) + 1 for t in texts])
    owner = np.zeros(len(points), np.int32)
    owner[ends[:-1]] = 1
    return points, np.cumsum(owner, dtype=np.int32)


def grams(points: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(positions of letters, for each n the bucket of the n-gram that ends there).

    An n-gram reaches over the start of its word into one 0 at most; where it would reach
    further it is given bucket -1.
    """
    at = np.flatnonzero(points)
    out = []
    padded = np.concatenate([np.zeros(max(NGRAMS), np.uint64), points.astype(np.uint64)])
    at_padded = at + max(NGRAMS)
    for n in NGRAMS:
        h = np.full(len(at), np.uint64(n), np.uint64)
        valid = np.ones(len(at), bool)
        for k in range(n):
            c = padded[at_padded - k]
            h = (h ^ c) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            if 0 < k < n - 1:
                valid &= c != 0
        bucket = (h >> np.uint64(40)).astype(np.int64) % BUCKETS
        out.append(np.where(valid, bucket, -1))
    return at, out


def _slices(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    i = 0
    while i < len(texts):
        j, held = i, 0
        while j < len(texts) and (j == i or held + len(texts[j]) <= SLICE_POINTS):
            held += len(texts[j])
            j += 1
        yield i, texts[i:j]
        i = j


def fit(train: DataFrame, *, max_rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities) from ``train`` (``doc_id, text, lang``).

    A hash of the id picks about ``max_rows`` rows where there are more; the counts are
    summed by Spark, and one row per language and used bucket comes to the driver.
    """
    ship_package(train.sparkSession)
    n = train.count()
    if n > max_rows:
        share = int(max_rows / n * (1 << 31))
        train = train.where(F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 31)) < share)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                total = sums.setdefault(lang, np.zeros((len(NGRAMS), BUCKETS), np.int64))
                for _, part in _slices(list(texts)):
                    for k, b in enumerate(grams(letters_of(part)[0])[1]):
                        total[k] += np.bincount(b[b >= 0], minlength=BUCKETS)
        for lang, total in sums.items():
            k, bucket = np.nonzero(total)
            yield pd.DataFrame({"lang": lang, "k": k, "bucket": bucket, "n": total[k, bucket]})

    counts = train.select("lang", "text").mapInPandas(count, "lang string, k int, bucket int, n long")
    counts = written(counts.groupBy("lang", "k", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    languages = [r.lang for r in counts.select("lang").distinct().orderBy("lang").collect()]
    table = np.zeros((len(languages), len(NGRAMS), BUCKETS))
    got = counts.toPandas()
    number = {lang: i for i, lang in enumerate(languages)}
    table[got["lang"].map(number).to_numpy(int), got["k"].to_numpy(), got["bucket"].to_numpy()] = got["n"]
    table += SMOOTHING
    model = np.log(table / table.sum(axis=2, keepdims=True))
    return languages, np.ascontiguousarray(model.transpose(1, 2, 0), dtype=np.float32)


def mixture(words: np.ndarray, owner: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, selected) per text, from log likelihoods of words (rows) by language.

    ``owner`` is each word's text, in order; a text without words has no language.
    """
    n_lang = words.shape[1]
    size = np.bincount(owner, minlength=n_texts)
    has = np.flatnonzero(size)
    selected = np.zeros((n_texts, n_lang), bool)
    result = np.zeros((n_texts, n_lang))
    if not len(has):
        return result, selected
    begins = np.concatenate([[0], np.cumsum(size[has])[:-1]])
    rank = np.repeat(np.arange(len(has)), size[has])
    # A row per language: sums over languages then run along whole rows.
    by_language = np.ascontiguousarray(words.T)
    like = np.exp(by_language - by_language.max(axis=0))

    def em(active: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions and log likelihood of the texts ``rows`` with their ``active`` languages."""
        inside = np.isin(rank, rows) if len(rows) < len(has) else slice(None)
        lk = like[:, inside]
        counts = size[has][rows]
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        p = active / active.sum(axis=1, keepdims=True)
        for _ in range(EM_STEPS):
            joint = np.repeat(p.T.astype(np.float32), counts, axis=1)
            joint *= lk
            joint /= np.maximum(joint.sum(axis=0), np.float32(1e-30))
            p = np.add.reduceat(joint, starts, axis=1, dtype=np.float64).T / counts[:, None]
        total = np.maximum((lk * np.repeat(p.T.astype(np.float32), counts, axis=1)).sum(axis=0), 1e-30)
        return p, np.add.reduceat(np.log(total, dtype=np.float64), starts)

    active = np.ones((len(has), n_lang), bool)
    best, score = em(active, np.arange(len(has)))
    penalty = 0.5 * np.log(np.maximum(size[has], 2))
    open_rows = np.arange(len(has)) if n_lang > 1 else np.zeros(0, int)
    while len(open_rows):
        # Leave out the weakest of the set, and keep that where the loss is below the penalty.
        trial = active[open_rows].copy()
        weakest = np.where(trial, best[open_rows], np.inf).argmin(axis=1)
        trial[np.arange(len(open_rows)), weakest] = False
        p, s = em(trial, open_rows)
        better = score[open_rows] - s < penalty[open_rows]
        rows = open_rows[better]
        active[rows], best[rows], score[rows] = trial[better], p[better], s[better]
        open_rows = rows[active[rows].sum(axis=1) > 1]
    result[has], selected[has] = best, active
    return result, selected


def predict_texts(texts: list[str], model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``mixture`` of each text under the log probabilities ``model`` (n, bucket, language)."""
    n_lang = model.shape[2]
    shares, sets = [], []
    for _, part in _slices(texts):
        found = [word_likelihoods(*letters_of(p), model) for p in _pieces(part)]
        owner = np.concatenate([o for _, o in found])
        p, s = mixture(np.concatenate([w for w, _ in found]), owner, len(part))
        shares.append(p)
        sets.append(s)
    return np.concatenate(shares), np.concatenate(sets)


def _pieces(texts: list[str]) -> Iterator[list[str]]:
    """``texts`` as they are, or one long text in pieces cut at white space."""
    if len(texts) > 1 or len(texts[0]) <= SLICE_POINTS:
        yield texts
        return
    text, at = texts[0], 0
    while at < len(text):
        stop = min(len(text), at + SLICE_POINTS)
        while stop < len(text) and not text[stop].isspace():
            stop += 1
        yield [text[at:stop]]
        at = stop


def word_likelihoods(points: np.ndarray, owner: np.ndarray, model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log likelihood of each word by language, each word's text)."""
    at, buckets = grams(points)
    if not len(at):
        return np.zeros((0, model.shape[2]), np.float32), np.zeros(0, np.int32)
    score = np.zeros((len(at), model.shape[2]), np.float32)
    for k, b in enumerate(buckets):
        got = model[k][b]
        got[b < 0] = 0
        score += got
    first = np.flatnonzero(np.diff(at, prepend=-9) != 1)  # a word's first letter
    # N-grams of all lengths overlap: their mean keeps a word from counting four-fold.
    return np.add.reduceat(score, first, axis=0) / len(NGRAMS), owner[at[first]]


def identify(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col, held_out, lang_pred, score, languages``.

    ``held_out``: crc32 of the id's text modulo 3 is 1; such rows, and those without text
    or language, teach nothing (a NULL id: not held out).  Of the others about
    ``max_rows`` at most do.  ``lang_pred`` is one of the learned languages, or ``und``
    with score 0 for a text that is NULL or has no letter, or where nothing was learned;
    ``score`` is its proportion of the text's words, ``languages`` the selected set, by
    proportion.  Ties go to the first language by name.  Repeated rows get a row each; other
    columns are not read.  Empty input: empty output.
    """
    spark = docs.sparkSession
    held_out = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
    d = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
        held_out.alias("held_out"),
    )
    languages, model = fit(d.where("NOT held_out AND text IS NOT NULL AND lang IS NOT NULL"), max_rows=max_rows)
    shared = spark.sparkContext.broadcast(model)
    out = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("held_out", T.BooleanType()),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("languages", T.ArrayType(T.StringType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            p, s = predict_texts(texts, shared.value) if languages else (np.zeros((len(texts), 0)),) * 2
            names, scores, sets = [], [], []
            for i in range(len(texts)):
                order = [j for j in np.argsort(-p[i], kind="stable") if s[i, j]]
                names.append(languages[order[0]] if order else "und")
                scores.append(float(min(1.0, p[i, order[0]])) if order else 0.0)
                sets.append([languages[j] for j in order])
            columns = [batch.column(0), batch.column(2), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sets, pa.list_(pa.string()))], names=out.names)

    return d.select("doc_id", "text", "held_out").mapInArrow(run, out)
