"""Benchmark decontamination by latent semantic retrieval.

The benchmark's items are the queries, all passages of all documents are searched.

1. Words are runs of letters and digits, lower case.  Features are words of the items;
   their document frequencies are counted over the whole corpus.  Words that no document
   has cannot match.  Words in over
   ``COMMON_PERCENT`` of the documents are left out, but for the ``LEAST_FEATURES`` rarest
   of each item.
2. Passages are overlapping windows: ``stride`` words apart, as long as the longest item
   and a stride, so that some window holds any copy of an item whole.
3. A distributed randomised SVD of the TF-IDF passages gives the latent space: one pass
   over all passages of the corpus adds up ``A'A`` in blocks, tasks multiply those with
   ``Q`` (the items and the passages weigh the same), Spark sums the tasks' parts, the
   driver only orthogonalises the (features x rank) sums.
4. Cosine search: each task projects its windows and multiplies them with the items'
   latent vectors.  Nothing is shuffled.
5. Candidates are checked by words: the longest common subsequence of item and window,
   and for paraphrases the item's answer as well.

Items are taken in blocks of ``ITEMS``: what is broadcast and what the driver holds has a
bound, whatever the benchmark's size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import scratch_scope, written
from eventide.llm.neardup import word_hashes
from eventide.session import ship_package

ITEMS = 2_000
STRIDE = 32
RANK = 192
OVERSAMPLE = 16
COMMON_PERCENT = 5
LEAST_FEATURES = 6
COSINE = 0.45
#: Shares of an item's words, in order: enough by itself, or with the answer's.
VERBATIM, PARAPHRASE, ANSWER = 0.75, 0.55, 0.6
#: Without an answer column the last part of an item stands for its answer.
ANSWER_PART = 0.25
SLICE_BYTES = 2 << 20
FEATURE_BLOCK = 512
#: Cells in a block of the passages' ``A'A`` (a row of it at least).
GRAM_BLOCK = 1 << 16
#: Pairs that are formed at once, and summed cells that a task holds.
GRAM_PAIRS, GRAM_HELD = 1 << 20, 1 << 22

#: Bytes of ASCII characters that are no letters or digits become blanks.
_TABLE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def normal_bytes(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_TABLE)


def lcs_length(masks: dict, window: list) -> int:
    """Length of the longest common subsequence of ``window`` and the sequence whose
    positions ``masks`` has as bits by element (one machine operation a word)."""
    size = masks[None]
    full = (1 << size) - 1
    v = full
    for x in window:
        m = masks.get(x)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return size - v.bit_count()


def lcs_masks(words: list) -> dict:
    masks: dict = {None: len(words)}
    for i, w in enumerate(words):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


@dataclass
class Index:
    """What the tasks need for one block of items (its size is bounded by ``ITEMS``)."""

    item_ids: list
    words: list[list[int]]
    answers: list[list[int]]
    features: np.ndarray  # sorted hashes
    weight: np.ndarray  # inverse document frequency of each feature
    window: int  # strides in a window
    least_hits: int
    basis: np.ndarray | None = None  # features x rank, weighted
    latent: np.ndarray | None = None  # items x rank, unit length

    def __post_init__(self) -> None:
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.features & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, features) of the words that are features."""
        at = np.flatnonzero(self.bits[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if not len(at) or not len(self.features):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        f = np.minimum(np.searchsorted(self.features, hashes[at]), len(self.features) - 1)
        same = self.features[f] == hashes[at]
        return at[same], f[same]


def slices(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, word hashes, begin of each text in them) of runs of texts."""
    i = 0
    while i < len(texts):
        if len(texts[i]) > SLICE_BYTES:
            parts, at, data = [], 0, texts[i]
            while at < len(data):
                stop = data.find(b" ", at + SLICE_BYTES)
                stop = len(data) if stop < 0 else stop
                parts.append(word_hashes(data[at:stop])[1])
                at = stop
            hashes = np.concatenate(parts)
            yield i, hashes, np.array([0, len(hashes)])
            i += 1
            continue
        j, held = i, 0
        while j < len(texts) and (j == i or held + len(texts[j]) <= SLICE_BYTES):
            held += len(texts[j]) + 1
            j += 1
        starts, hashes = word_hashes(b" ".join(texts[i:j]))
        yield i, hashes, np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts[i:j]]))
        i = j


def windows(index: Index, hashes: np.ndarray, begins: np.ndarray, stride: int):
    """(windows' first words, their texts, blocks' bounds in hits, features) of a slice.

    Blocks are runs of ``stride`` words of one text; a window is ``index.window`` blocks.
    Only windows with ``index.least_hits`` features are given: fewer could not reach the
    share of an item's words that any check asks for.
    """
    at, f = index.lookup(hashes)
    text = np.searchsorted(begins, at, side="right") - 1
    blocks_of = -(-np.diff(begins) // stride)
    base = np.concatenate([[0], np.cumsum(blocks_of + index.window)])
    block = base[text] + index.window - 1 + (at - begins[text]) // stride
    counts = np.bincount(block, minlength=int(base[-1]) + index.window)
    total = np.cumsum(np.concatenate([[0], counts]))
    hits = total[index.window :] - total[: -index.window]
    first = np.flatnonzero(hits >= index.least_hits)
    owner = np.searchsorted(base, first, side="right") - 1
    word = begins[owner] + (first - base[owner] - index.window + 1) * stride
    return first, owner, word, total, f


def window_vectors(index: Index, first: np.ndarray, total: np.ndarray, f: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums of ``table`` rows of the features in each window."""
    used = np.unique((first[:, None] + np.arange(index.window)).ravel())
    used = used[total[used + 1] > total[used]]
    out = np.zeros((len(first), table.shape[1]), np.float32)
    if not len(used):
        return out
    lengths = total[used + 1] - total[used]
    sums = table[f[total[used]]]
    for k in range(1, int(lengths.max())):  # blocks hold few features, at most their words
        more = np.flatnonzero(lengths > k)
        sums[more] += table[f[total[used[more]] + k]]
    for k in range(index.window):
        at = np.searchsorted(used, first + k)
        here = (at < len(used)) & (used[np.minimum(at, len(used) - 1)] == first + k)
        out[here] += sums[at[here]]
    return out


def _texts(column: pa.Array) -> list[bytes]:
    return [normal_bytes(t) for t in column.to_pylist()]


def document_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[int, np.ndarray]:
    """(documents with text, documents that hold each word of ``vocabulary``), over all rows."""
    index = Index([], [], [], vocabulary, np.ones(0), 1, 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(len(vocabulary) + 1, np.int64), 0
        for batch in batches:
            texts = _texts(batch.column(0))
            n += len(texts)
            for _, hashes, begins in slices(texts):
                at, f = index.lookup(hashes)
                owner = np.searchsorted(begins, at, side="right") - 1
                pairs = np.unique(owner * len(vocabulary) + f)
                found += np.bincount(pairs % max(len(vocabulary), 1), minlength=len(found))
        found[-1] = n
        word = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(found[word])], names=["word", "n"])

    counts = docs.where("text IS NOT NULL").select("text").mapInArrow(count, "word long, n long")
    df = np.zeros(len(vocabulary) + 1, np.int64)
    for r in counts.groupBy("word").agg(F.sum("n").alias("n")).toPandas().itertuples():
        df[r.word] = r.n
    return int(df[-1]), df[:-1]


def make_index(items: list[tuple], docs: DataFrame, stride: int) -> Index | None:
    """Features, weights and window of a block of items ``(id, text, answer)``."""
    words = [word_hashes(normal_bytes(t))[1] for _, t, _ in items]
    keep = [i for i, w in enumerate(words) if len(w)]
    if not keep:
        return None
    items, words = [items[i] for i in keep], [words[i] for i in keep]
    answers = []
    for (_, _, answer), w in zip(items, words, strict=True):
        given = word_hashes(normal_bytes(answer))[1] if answer is not None else w[:0]
        answers.append(given if len(given) else w[-max(3, math.ceil(ANSWER_PART * len(w))) :])
    vocabulary = np.unique(np.concatenate(words))
    n, df = document_frequencies(docs, vocabulary)
    seen = df > 0  # what no document holds matches nothing
    rare = seen & (df * 100 <= COMMON_PERCENT * n)
    for w in words:
        f = np.unique(np.searchsorted(vocabulary, w))
        f = f[seen[f]]
        rare[f[np.argsort(df[f], kind="stable")[:LEAST_FEATURES]]] = True
    if not rare.any():
        return None
    features = vocabulary[rare]
    weight = np.log((n + 1) / (df[rare] + 0.5))
    weight = np.maximum(weight, 0.1)
    # Of an item's words, those that are no features may all be matched; the rest of the
    # least share must be features.
    need = [math.ceil(PARAPHRASE * len(w)) - int((~np.isin(w, features)).sum()) for w in words]
    strides = -(-max(map(len, words)) // stride) + 1
    return Index(
        [i for i, _, _ in items], [w.tolist() for w in words], [a.tolist() for a in answers],
        features, weight, strides, max(1, min(need)),
    )


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def item_rows(index: Index) -> np.ndarray:
    """TF-IDF rows of the items, of unit length."""
    rows = np.zeros((len(index.words), len(index.features)))
    for i, w in enumerate(index.words):
        at, f = index.lookup(np.array(w, np.uint64))
        np.add.at(rows[i], f, index.weight[f])
    return _unit(rows)


def fit_latent(index: Index, docs: DataFrame, rank: int, stride: int, seed: int = 0) -> None:
    """Randomised SVD of the TF-IDF passages: sets ``index.basis`` and ``index.latent``.

    Two rounds of ``Q <- orth(A'(A Q))`` from a random start, then the singular vectors
    inside ``Q``'s space.  The products are made with ``gram``'s ``A'A`` of all passages.
    """
    n_f = len(index.features)
    q = np.random.default_rng(seed).normal(size=(n_f, min(n_f, rank + OVERSAMPLE)))
    items = item_rows(index)
    with scratch_scope(docs.sparkSession):
        blocks = written(gram(index, docs, stride), "latent-gram")
        mass = blocks.agg(F.sum("mass")).first()[0] or 0.0

        def product(q: np.ndarray) -> np.ndarray:
            return items.T @ (items @ q) / len(items) + gram_product(blocks, q) / max(mass, 1.0)

        q, _ = np.linalg.qr(product(q))
        q, _ = np.linalg.qr(product(q))
        values, u = np.linalg.eigh((m := q.T @ product(q)) + m.T)
    basis = q @ u[:, np.argsort(-values)[:rank]]
    index.basis = (basis * index.weight[:, None]).astype(np.float32)
    index.latent = _unit(items @ basis).astype(np.float32)


def unit_rows(index: Index, first, total, f) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, features, values) of the unit TF-IDF rows of some windows, in order."""
    lengths = total[first + index.window] - total[first]
    starts = np.cumsum(np.concatenate([[0], lengths[:-1]]))
    rows = np.repeat(total[first] - starts, lengths) + np.arange(int(lengths.sum()))
    window = np.repeat(np.arange(len(first)), lengths)
    cell, count = np.unique(window * len(index.features) + f[rows], return_counts=True)
    window, feature = cell // len(index.features), cell % len(index.features)
    value = count * index.weight[feature]
    norm = np.sqrt(np.bincount(window, value**2, minlength=len(first)))
    return window, feature, value / norm[window]


def row_products(n_f: int, window, feature, value) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(cells, sums) of the lower triangles of ``a a'`` of the rows ``a``, in bounded parts."""
    # Each value of a row with those up to it.
    pairs = np.arange(len(window)) - np.searchsorted(window, window) + 1
    ends = np.cumsum(pairs)
    at = 0
    while at < len(window):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + GRAM_PAIRS)))
        n = pairs[at:stop]
        x = np.repeat(np.arange(at, stop), n)
        y = x + np.arange(1, len(x) + 1) - np.repeat(np.cumsum(n), n)
        yield summed_cells(feature[x] * n_f + feature[y], value[x] * value[y])
        at = stop


def summed_cells(cell: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(cell)
    cell = cell[order]
    at = np.flatnonzero(np.diff(cell, prepend=-1))
    return cell[at], np.add.reduceat(value[order], at)


def gram(index: Index, docs: DataFrame, stride: int) -> DataFrame:
    """``block, cells, sums, mass``: ``A'A`` over the unit TF-IDF rows of all passages, its
    lower triangle in blocks of rows.

    Windows hold few features, so a task's products fall into few cells.  Each block is the
    sum of all tasks' parts of it; the size is bounded by the features, not by the corpus.
    ``mass`` adds up to the number of passages.
    """
    n_f = len(index.features)
    size = max(1, GRAM_BLOCK // n_f) * n_f
    shared = docs.sparkSession.sparkContext.broadcast(index)
    schema = "block long, cells binary, sums binary, mass double"

    def block_rows(blocks, cells, sums, mass) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.float64()]
        data = [blocks, [c.astype(np.int32).tobytes() for c in cells], [s.astype(np.float32).tobytes() for s in sums], mass]
        return pa.RecordBatch.from_arrays([pa.array(d, k) for d, k in zip(data, kinds, strict=True)], names=["block", "cells", "sums", "mass"])

    def in_blocks(cell: np.ndarray, value: np.ndarray, mass: float) -> Iterator[pa.RecordBatch]:
        block = cell // size
        cuts = np.flatnonzero(np.diff(block, prepend=-1)).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(cell)], strict=True):
            yield block_rows([block[a]], [cell[a:b] - block[a] * size], [value[a:b]], [0.0 if a else mass])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        held, n, mass = [], 0, 0.0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return summed_cells(*map(np.concatenate, zip(*held, strict=True)))

        for batch in batches:
            for _, hashes, begins in slices(_texts(batch.column(0))):
                first, _, _, total, f = windows(index, hashes, begins, stride)
                for part in np.array_split(np.arange(len(first)), -(-len(first) // 2000)) if len(first) else ():
                    mass += len(part)
                    for found in row_products(n_f, *unit_rows(index, first[part], total, f)):
                        held.append(found)
                        n += len(found[0])
                        if n > GRAM_HELD:
                            held = [merged()]
                            n = len(held[0][0])
                        if n > GRAM_HELD // 2 and len(held) == 1:
                            yield from in_blocks(*held[0], mass)
                            held, n, mass = [], 0, 0.0
        if held:
            yield from in_blocks(*merged(), mass)

    def total_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums, mass = None, np.zeros(size), 0.0

        def out() -> pa.RecordBatch:
            cells = np.flatnonzero(sums)
            return block_rows([at], [cells], [sums[cells]], [mass])

        for batch in batches:
            for block, cells, values, m in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if block != at:
                    if at is not None:
                        yield out()
                    at, mass = block, 0.0
                    sums[:] = 0.0
                sums[np.frombuffer(cells, np.int32)] += np.frombuffer(values, np.float32)
                mass += m
        if at is not None:
            yield out()

    found = docs.where("text IS NOT NULL").select("text").mapInArrow(parts, schema)
    return found.repartition("block").sortWithinPartitions("block").mapInArrow(total_of, schema)


def gram_product(blocks: DataFrame, q: np.ndarray) -> np.ndarray:
    """``A'A Q`` from the blocks of ``gram``."""
    rows = max(1, GRAM_BLOCK // len(q))
    shared = blocks.sparkSession.sparkContext.broadcast(q.astype(np.float32))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        out = np.zeros(q.shape)
        for batch in batches:
            for block, cells, sums in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                a = block * rows
                b = min(a + rows, len(q))
                part = np.zeros(rows * len(q), np.float32)
                part[np.frombuffer(cells, np.int32)] = np.frombuffer(sums, np.float32)
                part = part.reshape(rows, len(q))[: b - a, :b]
                out[a:b] += part @ q[:b]
                part[np.arange(b - a), np.arange(a, b)] = 0
                out[:b] += part.T @ q[a:b]
        at = [b for b in range(0, len(out), FEATURE_BLOCK) if out[b : b + FEATURE_BLOCK].any()]
        data = [out[b : b + FEATURE_BLOCK].tobytes() for b in at]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(data, pa.binary())], names=["block", "data"])

    def total_of(pdf: pd.DataFrame) -> pd.DataFrame:
        data = sum(np.frombuffer(d) for d in pdf["data"])
        return pd.DataFrame({"block": pdf["block"][:1], "data": [data.tobytes()]})

    schema = "block long, data binary"
    parts = blocks.select("block", "cells", "sums").mapInArrow(add, schema).groupBy("block").applyInPandas(total_of, schema).collect()
    out = np.zeros(q.shape)
    for r in parts:
        data = np.frombuffer(bytes(r.data)).reshape(-1, q.shape[1])
        out[r.block : r.block + len(data)] = data
    shared.unpersist()
    return out


def passes(lcs: float, said: float) -> bool:
    """Whether the shares of an item's and of its answer's words tell that the item is there."""
    return lcs >= VERBATIM or (lcs >= PARAPHRASE and said >= ANSWER)


def word_check(whole: dict, answer: dict, held: list) -> tuple[float, float]:
    """Shares of the item's and of its answer's words that stand in order in one stretch
    of ``held`` of at most one and a half times the item's length: of the stretches that
    pass that where they are most, else of all."""
    n = whole[None]
    width, step = n + max(n // 2, 2), max(1, n // 4)
    best = (False, 0.0, 0.0)
    for a in range(0, max(len(held) - width + step, 1), step):
        part = held[a : a + width]
        lcs = lcs_length(whole, part) / n
        if lcs >= PARAPHRASE and (not best[0] or lcs >= best[1]):
            said = lcs_length(answer, part) / answer[None]
            best = max(best, (passes(lcs, said), lcs, said))
    return best[1:]


def search_batch(index: Index, masks: list, ids: list, texts: list[bytes], stride: int, cosine: float) -> list[tuple]:
    """``(id, item, cosine, lcs, answer, first word)``, the best window of each pair that passes."""
    best: dict = {}
    for i, hashes, begins in slices(texts):
        first, owner, word, total, f = windows(index, hashes, begins, stride)
        for part in np.array_split(np.arange(len(first)), -(-len(first) // 4000)) if len(first) else ():
            vectors = _unit(window_vectors(index, first[part], total, f, index.basis))
            scores = vectors @ index.latent.T
            last = -1
            for w, item in zip(*np.nonzero(scores >= cosine), strict=True):
                p = part[w]
                if w != last:
                    begin = max(int(word[p]), int(begins[owner[p]]))
                    end = min(int(word[p]) + index.window * stride, int(begins[owner[p] + 1]))
                    held = hashes[begin:end].tolist()
                    last, there = w, set(held).__contains__
                # No more words can stand in order than are there at all.
                if sum(map(there, index.words[item])) < PARAPHRASE * len(index.words[item]):
                    continue
                lcs, said = word_check(*masks[item], held)
                if not passes(lcs, said):
                    continue
                key = (i + int(owner[p]), int(item))
                found = (lcs, said, float(scores[w, item]), begin - int(begins[owner[p]]))
                if found[:3] > best.get(key, (0.0, 0.0, 0.0))[:3]:
                    best[key] = found
    return [(ids[k], index.item_ids[item], c, lcs, said, at) for (k, item), (lcs, said, c, at) in sorted(best.items())]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    answer_col: str | None = None,
    rank: int = RANK,
    stride: int = STRIDE,
    cosine: float = COSINE,
    items_at_once: int = ITEMS,
) -> DataFrame:
    """A row per document and item that it holds: ``id_col, item_col, cosine, lcs, answer, at``.

    ``lcs`` is the share of the item's words that a stretch of the window (one and a half
    times the item's length) has in the same order, ``answer`` that of its answer's words,
    ``at`` the window's first word.  A pair is
    reported if some window's latent cosine is at least ``cosine`` and ``lcs`` at least
    0.75, or 0.55 with ``answer`` at least 0.6.  Without ``answer_col`` (or where it is
    NULL) the last quarter of an item's words stands for its answer.

    Documents and items that are NULL or have no word match nothing.  Repeated documents
    give a row each, repeated items too; NULL ids are carried.  Other columns are not
    read.  No documents or no items: no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    queries = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text"), answer.alias("answer"))
    queries = queries.where("text IS NOT NULL")
    out = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField(item_col, benchmark.schema[item_col].dataType),
            *[T.StructField(c, T.DoubleType()) for c in ("cosine", "lcs", "answer")],
            T.StructField("at", T.LongType()),
        ]
    )
    found: DataFrame | None = None
    for block in _blocks(queries, items_at_once):
        index = make_index(block, d, stride)
        if index is None:
            continue
        fit_latent(index, d, rank, stride)
        part = _search(d, index, out, stride, cosine)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], out) if found is None else found


def _blocks(queries: DataFrame, size: int) -> Iterator[list[tuple]]:
    """The items, ``size`` at a time."""
    block: list[tuple] = []
    for r in queries.toLocalIterator():
        block.append((r.item, r.text, r.answer))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def _search(d: DataFrame, index: Index, out: T.StructType, stride: int, cosine: float) -> DataFrame:
    shared = d.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        masks = [(lcs_masks(w), lcs_masks(a)) for w, a in zip(index.words, index.answers, strict=True)]
        for batch in batches:
            rows = search_batch(index, masks, batch.column(0).to_pylist(), _texts(batch.column(1)), stride, cosine)
            if rows:
                kinds = [batch.column(0).type, None, pa.float64(), pa.float64(), pa.float64(), pa.int64()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return d.mapInArrow(run, out)
