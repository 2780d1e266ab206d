"""Near-duplicate documents by bottom-k sketches of one hash function.

1. Signatures.  A narrow pass over Arrow batches hashes the words and the word shingles
   of each whole text with numpy.  It keeps the number of distinct shingles, a 126-bit
   fingerprint of the whole set, the ``k`` smallest shingle hashes (the sketch) and
   ``PARITY`` bits: how many shingles fall to each, modulo two.
2. Classes.  Documents with equal sets are one class from here on.
3. Inverted lists of retained values.  Sketches of sets with a Jaccard similarity of 0.8
   share 0.8 to 0.89 of their values (by the sets' sizes), and six standard deviations
   less but for odds of about 1e-8; that is over half of them.  Put in order of how many
   classes hold them, rarest first, the first value that two such sketches share is not
   among the last of either: lists are built from each sketch's rarer part.  A passage
   that very many documents share is in the other part, unless it makes up half of the
   document.
4. Overlaps.  ``links.linked_groups`` forms the pairs: with each list's hub, and then of
   nodes that are not connected yet.  The latter are formed in the list of their first
   shared value only, and only if the shared values are enough.  Before that, bits that differ
   are as many shingles at least that one set only has: exact, and it leaves hardly a pair
   below the similarity in sets of up to some twice ``PARITY`` shingles, so a group of copies
   that are almost alike forms no pairs for nothing.
5. The union sketch (the ``k`` smallest of both) estimates the similarity and filters;
   whole sets then decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import scratch_scope, written
from eventide.llm.links import linked_groups
from eventide.session import ship_package

SKETCH = 128
#: Bits of the parities, in longs of 64.
PARITY = 1024
#: Standard deviations that an estimate may stay below its expectation.
SIGMAS = 6
#: Texts are hashed in slices of about so many bytes, and of so many rows.
SLICE_BYTES = 1 << 18
SLICE_ROWS = 256

_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_FACTORS = _mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


class Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                out = np.full(size, base, np.uint64)
                out[0] = 1
                setattr(self, name, np.cumprod(out, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_POWERS = Powers()


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word of ``data``; ASCII letters count as lower case."""
    raw = np.frombuffer(data.lower(), np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    gap = np.ones(len(raw) + 2, bool)
    gap[1:-1] = _SPACE[raw]
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _POWERS.get(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:-1], dtype=np.uint64, out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _FACTORS[63]
    return starts, _mix(h)


def _slices(data: bytes, size: int) -> Iterator[bytes]:
    """``data`` cut at white space into parts of about ``size`` bytes."""
    at = 0
    while at < len(data):
        stop = min(len(data), at + size)
        while stop < len(data) and not _SPACE[data[stop]]:
            stop += 1
        yield data[at:stop]
        at = stop


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """The sorted distinct 63-bit hashes of the ``n``-word shingles of a word sequence.

    Fewer words than ``n``: the whole sequence as one shingle; no words: none.
    """
    if not len(words):
        return np.zeros(0, np.int64)
    width = min(n, len(words))
    h = np.full(len(words) - width + 1, np.uint64(width), np.uint64) * _FACTORS[62]
    for k in range(width):
        h += words[k : len(words) - width + 1 + k] * _FACTORS[k]
    return np.unique((_mix(h) >> np.uint64(1)).astype(np.int64))


def batch_sets(texts: list[bytes], n: int, slice_bytes: int = SLICE_BYTES) -> Iterator[np.ndarray]:
    """``shingle_set`` of each text, in order; small texts are hashed together."""
    i = 0
    while i < len(texts):
        if len(texts[i]) > slice_bytes:
            parts = [word_hashes(p)[1] for p in _slices(texts[i], slice_bytes)]
            yield shingle_set(np.concatenate(parts), n)
            i += 1
            continue
        j, held = i, 0
        while j < len(texts) and (j == i or held + len(texts[j]) <= slice_bytes):
            held += len(texts[j]) + 1
            j += 1
        starts, hashes = word_hashes(b"\n".join(texts[i:j]))
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[i:j]])
        cuts = np.searchsorted(starts, begins)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield shingle_set(hashes[a:b], n)
        i = j


def parities(s: np.ndarray) -> np.ndarray:
    """The parity of the elements that fall to each of ``PARITY`` bits, as longs."""
    return np.packbits((np.bincount(s & (PARITY - 1), minlength=PARITY) & 1).astype(bool)).view(np.int64)


def _sets_of(column: pa.Array, ngram: int) -> Iterator[np.ndarray]:
    for at in range(0, len(column), SLICE_ROWS):
        texts = column.slice(at, SLICE_ROWS).cast(pa.large_binary()).to_pylist()
        yield from batch_sets([x or b"" for x in texts], ngram)


def signatures(docs: DataFrame, id_col: str, text_col: str, ngram: int, k: int) -> DataFrame:
    """``id, n_shingles, f1, f2, sketch, parity`` of each row: a narrow pass."""
    ship_package(docs.sparkSession)
    out = T.StructType.fromDDL("id long, n_shingles long, f1 long, f2 long, sketch array<long>, parity array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, f1, f2, sketches, parity = [], [], [], [], []
            for s in _sets_of(batch.column(1), ngram):
                u = s.view(np.uint64)
                sizes.append(len(s))
                f1.append(int(np.bitwise_xor.reduce(_mix(u)) >> np.uint64(1)) if len(u) else 0)
                f2.append(int(_mix(u * np.uint64(_BASE)).sum() >> np.uint64(1)) if len(u) else 0)
                sketches.append(s[:k])
                parity.append(parities(s))
            offsets = np.cumsum([0] + [len(s) for s in sketches]).astype(np.int32)
            flat = np.concatenate(sketches) if sketches else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))
            flat = np.concatenate(parity) if parity else np.zeros(0, np.int64)
            bits = pa.ListArray.from_arrays(pa.array(np.arange(len(parity) + 1, dtype=np.int32) * (PARITY // 64)), pa.array(flat, pa.int64()))
            columns = [batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, f1, f2)), lists, bits]
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, out)


def whole_sets(docs: DataFrame, id_col: str, text_col: str, ngram: int) -> DataFrame:
    """``id, shingles`` of each row."""
    out = T.StructType.fromDDL("id long, shingles array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sets, held = batch.column(0), [], 0
            done = 0
            for s in _sets_of(batch.column(1), ngram):
                sets.append(pa.array(s, pa.int64()))
                held += len(s)
                if held > 1 << 18:
                    yield _set_batch(ids.slice(done, len(sets)), sets, out.names)
                    done, sets, held = done + len(sets), [], 0
            if sets:
                yield _set_batch(ids.slice(done, len(sets)), sets, out.names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, out)


def _set_batch(ids: pa.Array, sets: list[pa.Array], names: list[str]) -> pa.RecordBatch:
    offsets = pa.array(np.cumsum([0] + [len(s) for s in sets]).astype(np.int32))
    return pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(offsets, pa.concat_arrays(sets))], names=names)


def least_shared(k: int, share: float) -> int:
    """Of ``k`` values so many at least are shared if each is with odds ``share``."""
    return max(1, int(k * share - SIGMAS * (k * share * (1 - share)) ** 0.5))


def _enough_shared(percent: int, k: int):
    """Necessary for a similarity of ``percent``, over the shared values of two sketches
    (``values``, rarest first, as 31-bit numbers), the sets' sizes ``n`` and parities ``p0, ...``.

    It holds in the list of the first shared value only, so that a pair is formed once."""
    s = percent / 100

    def condition(a, b) -> Column:
        small, large = F.least(a("n"), b("n")), F.greatest(a("n"), b("n"))
        common = F.array_intersect(a("values"), b("values"))
        # The sets share s / (1 + s) of their sizes' sum, at least; so much of the larger's sketch.
        share = (small + large) * (s / (1 + s)) / large
        sketched = k * share - SIGMAS * F.sqrt(k * share * (1 - F.least(share, F.lit(1.0))))
        whole = (small + large) * (s / (1 + s)) - 1e-9
        need = F.when(large <= k, whole).otherwise(sketched)
        # Shingles of one set only: as many as bits differ, at least.
        unequal = sum((F.bit_count(a(f"p{i}").bitwiseXOR(b(f"p{i}"))) for i in range(PARITY // 64)), F.lit(0))
        return (
            (small * 100 >= large * percent)
            & (unequal * (100 + percent) <= (small + large) * (100 - percent))
            & (F.get(common, F.lit(0)) == _short(a("key")))
            & (F.size(common) >= need)
        )

    return condition


def _short(value: Column) -> Column:
    return value.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


def _estimate_allows(x: str, y: str, nx: str, ny: str, percent: int, k: int) -> Column:
    """The union-sketch estimate: sketches that hold their whole sets decide, others must
    reach what an estimate of ``percent`` falls to by ``SIGMAS``."""
    every = F.array_union(x, y)
    union = F.slice(F.array_sort(every), 1, k)
    both = F.array_intersect(x, y)
    whole = (F.col(nx) <= k) & (F.col(ny) <= k)
    near = F.when(whole, F.size(both) * 100 >= F.size(every) * percent).otherwise(
        F.size(F.array_intersect(both, union)) >= least_shared(k, percent / 100)
    )
    return (F.least(nx, ny) * 100 >= F.greatest(nx, ny) * percent) & near


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    ngram: int = 5,
    percent: int = 80,
    k: int = SKETCH,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_shingles, component_id, kept``.

    Documents whose sets of distinct ``ngram``-word shingles (ASCII letters lower-cased)
    have a Jaccard similarity of ``percent`` or more are linked; ``component_id`` is the
    smallest id reachable, ``kept`` whether that is the document's own.  ``percent`` of 80
    and more is meant: the sketches' bound is set for it.

    NULL or empty text, or no word: no shingle, linked with nothing, kept.  Fewer words
    than ``ngram``: the whole sequence is the only shingle.  Repeated rows get a row each
    (rows of one id and different texts are judged by their own texts).  A NULL id: the
    component of the equal texts (or NULL), kept only where that is NULL.  Other columns
    are not read.  Empty input: empty output.
    """
    signed = written(signatures(docs, id_col, text_col, ngram, k), "signatures")
    identity = ["f1", "f2", "n_shingles"]
    with scratch_scope(docs.sparkSession):
        classes = (
            signed.where("n_shingles > 0")
            .groupBy(*identity)
            .agg(F.min("id").alias("node"), F.first("sketch").alias("sketch"), F.first("parity").alias("parity"))
            .where("node IS NOT NULL")
        )
        classes = written(classes, "classes")

        values = classes.select("node", F.explode("sketch").alias("value"))
        held = written(values.groupBy("value").agg(F.count("*").alias("held")).where("held > 1"), "held")
        shared = values.join(held, "value").groupBy("node").agg(
            F.sort_array(F.collect_list(F.struct("held", "value"))).alias("shared"), F.sum(F.log2("held")).alias("central")
        )
        size = F.size("sketch")
        # The rarest values come first; those that no other class holds make no list.
        least = F.floor(size * (least_shared(k, percent / 100) / k)).cast("int")
        first = size - least + 1 - (size - F.size("shared"))
        shared = classes.select("node", "sketch", "parity", F.col("n_shingles").alias("n")).join(shared, "node")
        shared = shared.select(
            "node", "n", "central", "shared", "parity", F.greatest(first, F.lit(0)).alias("first")
        )
        shared = written(shared, "shared")
        entries = shared.select(F.explode(F.slice("shared", F.lit(1), F.col("first"))).alias("of"), "node", "central")
        # A pair is formed in the list of its first shared value, so lists rank as the values do.
        entries = entries.select(F.col("of.value").alias("key"), "node", "central", F.col("of.held").alias("rank"))

        def verify(pairs: DataFrame) -> DataFrame:
            x = classes.select(F.col("node").alias("a"), F.col("sketch").alias("x"), F.col("n_shingles").alias("nx"))
            y = classes.select(F.col("node").alias("b"), F.col("sketch").alias("y"), F.col("n_shingles").alias("ny"))
            near = pairs.join(x, "a").join(y, "b").where(_estimate_allows("x", "y", "nx", "ny", percent, k))
            near = written(near.select("a", "b").distinct(), "near")
            nodes = written(near.select(F.col("a").alias("id")).union(near.select("b")).distinct(), "nodes")
            texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
            sets = whole_sets(texts.join(nodes.hint("merge"), "id", "left_semi"), "id", "t", ngram)
            sets = written(sets.where(F.size("shingles") > 0), "sets")
            left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
            right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
            both = near.join(left, "a").join(right, "b").withColumn("i", F.size(F.array_intersect("x", "y")))
            return both.where(F.col("i") * 100 >= (F.size("x") + F.size("y") - F.col("i")) * percent).select("a", "b").distinct()

        bits = [F.get("parity", F.lit(i)).alias(f"p{i}") for i in range(PARITY // 64)]
        nodes = shared.select("node", "n", F.transform("shared.value", _short).alias("values"), *bits)
        groups = linked_groups(entries, verify, nodes=nodes, condition=_enough_shared(percent, k))
        classes = classes.select(*identity, "node").join(groups, "node", "left")
        classes = written(classes.select(*identity, F.coalesce("component", "node").alias("component")), "labelled-classes", outlives=True)
    return signed.select("id", *identity).join(classes, identity, "left").select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component", "id"), F.col("component").isNull()).alias("kept"),
    )
