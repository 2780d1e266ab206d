"""Jaccard join of n-gram sets by prefix trees.

1. Sets.  A narrow pass hashes the words and shingles of each whole text with numpy.  It keeps
   the set's size, a 126-bit fingerprint and the *head*, the smallest hashes.  Documents with
   equal sets are one node from here on.
2. Nodes without a partner go.  Two sets of similarity ``percent`` share that much of the larger
   one at least, so all but ``gap = n - need`` of a set's shingles are common ones, and of its
   first ``gap + k`` at least ``k`` (``HEAD``).  Counted over all nodes, shingles of the
   heads that only one node has say which nodes cannot have that many.  This is exact.
3. Global order.  The whole sets of the nodes that are left, their shingles counted over all of
   them; those of one node only are in no intersection and count in the size alone.  The others
   are in order of their counts, the most frequent first, so that similar sets begin alike.
4. Lists.  Read from the rare end, a set's first ``gap + 1`` shingles (the ones of this node
   only included) have one in common with every partner's.  ``links.linked_groups`` forms the
   pairs: with each list's most central node, then of nodes that are not connected yet, in
   their first common list only and if a bound on the overlap of their rare ends allows it.
5. Prefix trees.  The partners of a node, in salted chunks, are stored in a trie in the global
   order, and the node's set goes down it.  A segment that several sets share is compared once;
   a subtree whose overlap so far, with all that remains, cannot reach what its smallest set
   needs is left.  What arrives at a leaf has its exact overlap.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import scratch_scope, written
from eventide.llm.links import linked_groups
from eventide.llm.neardup import _BASE, _mix, _sets_of
from eventide.session import partitions_for, ship_package

#: ``k`` of the heads, in hundredths of a set's size.
HEAD = 10
#: Shingles behind the lists' part of a set that bound the overlap, in hundredths of its size.
EXTRA = 10
#: Partners, and shingles of partners, in one trie.
TRIE_SETS, TRIE_SHINGLES = 256, 1 << 21
#: Hashes in a batch that goes back to the JVM, besides its last set.
OUT_HASHES = 1 << 18


def need_of(n, percent: int):
    """What a set of ``n`` shares with any partner that is as similar, at least."""
    return (n * percent + 99) // 100


def _fingerprint(s: np.ndarray) -> tuple[int, int, int]:
    """Size and two 63-bit sums over the elements' hashes: equal for equal sets."""
    u = s.view(np.uint64)
    if not len(u):
        return 0, 0, 0
    return len(u), int(np.bitwise_xor.reduce(_mix(u)) >> np.uint64(1)), int(_mix(u * np.uint64(_BASE)).sum() >> np.uint64(1))


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, ngram: int, part: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``id, n, f1, f2, part`` of each row: the set's size, fingerprint, and the ``part`` of its
    sorted hashes."""
    ship_package(docs.sparkSession)
    out = T.StructType.fromDDL("id long, n long, f1 long, f2 long, part array<long>")
    names = out.names

    def made(ids: pa.Array, rows: list[tuple], parts: list[np.ndarray]) -> pa.RecordBatch:
        offsets = pa.array(np.cumsum([0] + [len(p) for p in parts]).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(parts), pa.int64()))
        return pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in zip(*rows, strict=True)), lists], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows, parts, held, done = batch.column(0), [], [], 0, 0
            for s in _sets_of(batch.column(1), ngram):
                rows.append(_fingerprint(s))
                parts.append(part(s))
                held += len(parts[-1])
                if held > OUT_HASHES:
                    yield made(ids.slice(done, len(rows)), rows, parts)
                    done, rows, parts, held = done + len(rows), [], [], 0
            if rows:
                yield made(ids.slice(done, len(rows)), rows, parts)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, out)


class SetTrie:
    """A path-compressed trie of sequences in one global order, over flat arrays.

    The sequences are sorted; ``shared[i]`` is what number ``i`` has in common with the one
    before.  The subtree below a branch is a run of sequences."""

    def __init__(self, sequences: list[np.ndarray], sizes: list[int]) -> None:
        self.order = sorted(range(len(sequences)), key=lambda i: sequences[i].tolist())
        self.sequences = [sequences[i] for i in self.order]
        self.sizes = np.array([sizes[i] for i in self.order], np.int64)
        self.lengths = np.array([len(s) for s in self.sequences], np.int64)
        self.shared = np.zeros(len(sequences), np.int64)
        for i in range(1, len(self.sequences)):
            a, b = self.sequences[i - 1], self.sequences[i]
            m = min(len(a), len(b))
            differs = np.flatnonzero(a[:m] != b[:m])
            self.shared[i] = differs[0] if len(differs) else m
        self.compared = 0  # shingles looked up in the probe, all traversals

    def similar(self, probe: np.ndarray, size: int, percent: int) -> list[int]:
        """The numbers (as given) of the stored sets that are similar to ``probe``, any order, a
        set of ``size`` with all shingles."""
        probe = np.sort(probe)
        found: list[int] = []
        if not len(probe) or not self.sequences:
            return found
        # A run of sequences that share ``depth`` shingles, of which ``overlap`` are in the probe.
        stack = [(0, len(self.sequences), 0, 0)]
        while stack:
            lo, hi, depth, overlap = stack.pop()
            # overlap * (100 + percent) >= percent * (both sizes), for the smallest size of the run
            least = percent * (size + int(self.sizes[lo:hi].min()))
            remains = min(int(self.lengths[lo:hi].max()) - depth, len(probe) - overlap)
            if (overlap + remains) * (100 + percent) < least:
                continue
            end = int(self.lengths[lo]) if hi == lo + 1 else int(min(self.shared[lo + 1 : hi].min(), self.lengths[lo]))
            if end > depth:
                segment = self.sequences[lo][depth:end]
                at = np.minimum(np.searchsorted(probe, segment), len(probe) - 1)
                overlap += int((probe[at] == segment).sum())
                self.compared += end - depth
            if hi == lo + 1:
                if overlap * (100 + percent) >= percent * (size + int(self.sizes[lo])):
                    found.append(self.order[lo])
                continue
            cuts = [lo, *(lo + 1 + np.flatnonzero(self.shared[lo + 1 : hi] == end)), hi]
            stack += [(int(a), int(b), end, overlap) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return found


def _searched(percent: int):
    """Links ``a, b`` from rows (probe, chunk, node, n, seq) in order, the probe's own row first in
    each chunk (``node`` is NULL there)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe, size, own = None, 0, None
        held: list[tuple[int, int, np.ndarray]] = []
        weight = 0

        def links() -> list[int]:
            trie = SetTrie([s for _, _, s in held], [n for _, n, _ in held])
            return [held[i][0] for i in trie.similar(own, size, percent)]

        for batch in batches:
            out: list[tuple[int, int]] = []
            lists = batch.column("seq")
            flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            for i, (p, node, n) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("probe", "node", "n")], strict=True)):
                seq = flat[offsets[i] : offsets[i + 1]]
                if node is None or len(held) == TRIE_SETS or weight > TRIE_SHINGLES:
                    out += [(probe, x) for x in (links() if held else [])]
                    held, weight = [], 0
                if node is None:
                    probe, size, own = p, n, seq.copy()
                else:
                    held.append((node, n, seq.copy()))
                    weight += len(seq)
            if out:
                yield _links(out)
        if held:
            out = [(probe, x) for x in links()]
            if out:
                yield _links(out)

    return run


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def trie_links(pairs: DataFrame, sequences: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct ``pairs`` (``a, b``) whose sets are similar.

    Of each pair the node with more pairs is the probe; its partners are salted into chunks
    of about ``TRIE_SETS``, so that a node's partners are in as many tasks as they need."""
    per = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).groupBy("node").agg(F.count("*").alias("c"))
    per = written(per, "pair-counts")
    ca, cb = (per.select(F.col("node").alias(x), F.col("c").alias(f"c{x}")) for x in ("a", "b"))
    sided = pairs.join(ca, "a").join(cb, "b")
    swap = F.col("cb") > F.col("ca")
    sided = sided.select(
        F.when(swap, F.col("b")).otherwise(F.col("a")).alias("probe"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("node"),
        F.greatest("ca", "cb").alias("c"),
    )
    chunk = F.pmod(F.xxhash64("node"), F.ceil(F.col("c") / TRIE_SETS)).cast("long")
    sided = written(sided.select("probe", chunk.alias("chunk"), "node"), "sided")
    others = sided.join(sequences, "node").select("probe", "chunk", "node", "n", "seq")
    own = sequences.select(F.col("node").alias("probe"), "n", "seq")
    own = sided.select("probe", "chunk").distinct().join(own, "probe").select("probe", "chunk", F.lit(None).cast("long").alias("node"), "n", "seq")
    rows = written(others.union(own), "probes")
    rows = rows.repartition(partitions_for(rows), "probe", "chunk").sortWithinPartitions("probe", "chunk", F.col("node").asc_nulls_first())
    return rows.mapInArrow(_searched(percent), "a long, b long")


def _candidates(nodes: DataFrame, percent: int) -> DataFrame:
    """The nodes that can have a partner: enough of their heads' shingles are in other heads."""
    values = nodes.select("node", F.explode("head").alias("value"))
    held = written(values.groupBy("value").agg(F.count("*").alias("held")).where("held > 1").select("value"), "held")
    shared = values.join(held, "value").groupBy("node").agg(F.count("*").alias("c"))
    # A partner may be as small as percent of the node: of the common shingles, so many are in both heads.
    smallest = F.ceil(F.col("n") * percent / 100)
    enough = F.greatest(F.lit(1), F.ceil(smallest * HEAD / 100))
    return nodes.join(shared, "node").where(F.col("c") >= enough).select("node")


def prefix_join(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ngram: int = 5, percent: int = 80
) -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_shingles, component_id``.

    Documents whose sets of distinct ``ngram``-word shingles (ASCII letters lower-cased) have a
    Jaccard similarity of ``percent`` or more are linked; ``component_id`` is the smallest id
    reachable, the document's own included.  The join is exact but for equal 63-bit hashes.

    NULL or empty text, or no word: no shingle, linked with nothing.  Fewer words than
    ``ngram``: the whole sequence is the only shingle.  Repeated rows get a row each (rows of one
    id and different texts are judged by their own texts).  A NULL id: the component of the
    equal texts, or NULL.  Other columns are not read.  Empty input: empty output.
    """
    def head(s: np.ndarray) -> np.ndarray:
        return s[: len(s) - need_of(len(s), percent) + -(-len(s) * HEAD // 100)]

    signed = written(shingle_sets(docs, id_col, text_col, ngram, head), "sets")
    identity = ["f1", "f2", "n"]
    node = F.xxhash64(*identity).alias("node")
    with scratch_scope(docs.sparkSession):
        nodes = signed.where("n > 0").groupBy(*identity).agg(F.min("id").alias("id"), F.first("part").alias("head"))
        nodes = written(nodes.where("id IS NOT NULL").select(node, "id", *identity, "head"), "nodes")
        able = written(_candidates(nodes, percent), "able")

        wanted = nodes.join(able, "node", "left_semi").select(F.col("id").alias("_wanted"))
        texts = docs.join(written(wanted.distinct(), "wanted").hint("merge"), F.col(id_col).cast("long") == F.col("_wanted"), "left_semi")
        whole = shingle_sets(texts, id_col, text_col, ngram, lambda s: s).select(node, "n", F.col("part").alias("shingles"))
        whole = written(whole.dropDuplicates(["node"]).join(able, "node", "left_semi"), "whole-sets")
        values = written(whole.select("node", "n", F.explode("shingles").alias("value")), "values")
        counts = written(values.groupBy("value").agg(F.count("*").alias("held")).where("held > 1"), "counts")
        placed = F.sort_array(F.collect_list(F.struct((-F.col("held")).alias("rank"), "value")))
        seqs = values.join(counts, "value").groupBy("node").agg(F.first("n").alias("n"), placed.alias("s"), F.sum(F.log2("held")).alias("central"))
        need = F.ceil(F.col("n") * percent / 100)
        seqs = seqs.where(F.size("s") >= need)  # else too few can be common
        # From the rare end: the first gap + 1 make lists (less those of this node only), and
        # ``EXTRA`` more bound the overlap.
        first = (F.size("s") - need + 1).cast("int")
        more = F.least(F.size("s"), first + F.ceil(F.col("n") * EXTRA / 100)).cast("int")
        rare = F.slice(F.reverse("s"), F.lit(1), more)
        seqs = seqs.select("node", "n", "central", F.col("s.value").alias("seq"), rare.alias("rare"), first.alias("first"))
        seqs = written(seqs, "sequences")

        entries = seqs.select("node", "central", F.explode(F.slice("rare", F.lit(1), F.col("first"))).alias("of"))
        entries = entries.select(F.col("of.value").alias("key"), "node", "central", (-F.col("of.rank")).alias("rank"))

        def allowed(a, b) -> Column:
            """Formed in the first common list of two nodes whose sizes, and whose rare ends, allow it.

            Up to the end that comes first in the global order, the common shingles are all
            counted; beyond it there are no more than that node has left."""
            small, large = F.least(a("n"), b("n")), F.greatest(a("n"), b("n"))
            common = F.array_intersect(a("keys"), b("keys"))
            most = F.size(common) + F.greatest(a("left"), b("left"))
            enough = most * (100 + percent) >= (a("n") + b("n")) * percent
            return (small * 100 >= large * percent) & enough & (F.get(common, F.lit(0)) == a("key"))

        def verify(pairs: DataFrame) -> DataFrame:
            na, nb = (seqs.select(F.col("node").alias(x), F.col("n").alias(f"n{x}")) for x in ("a", "b"))
            sized = pairs.join(na, "a").join(nb, "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
            return trie_links(written(sized.select("a", "b"), "sized"), seqs.select("node", "n", "seq"), percent)

        bounds = seqs.select("node", "n", F.col("rare.value").alias("keys"), (F.size("seq") - F.size("rare")).alias("left"))
        groups = linked_groups(entries, verify, nodes=bounds, condition=allowed)
        groups = written(groups, "groups")
        least = groups.join(nodes.select("node", "id"), "node").groupBy("component").agg(F.min("id").alias("least"))
        labelled = nodes.join(groups, "node", "left").join(least, "component", "left")
        labelled = written(labelled.select(*identity, F.coalesce("least", "id").alias("component")), "labelled", outlives=True)
    return signed.join(labelled, identity, "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )
