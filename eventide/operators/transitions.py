"""Transition filter (the keyed change filter), batch forms.

:func:`annotate_transitions` is the exact form for any arrival order and any key
skew:

1. ``repartitionByRange(P, key, seq)`` + ``sortWithinPartitions`` (P from the
   size estimate over the advisory partition size): the range partitioner samples
   ``(key, seq)``, so a key holding a third of all rows is spread over about a
   third of the partitions instead of landing in one task.  The sorted ranges are
   checkpointed: partition ``i`` holds the same rows whenever it is read, whatever
   the split settings or the number of cores by then.  A partition is a *chunk*.
2. One narrow Arrow pass writes, per chunk, a request for the entering state of its
   first key and the summary of its last key's slice as a piecewise function
   entering state -> leaving state and number of changes (``fold.run_pieces``).  An
   entering date is never newer than the newest date of the key's earlier chunks, so
   the pieces above that are cut off before anything is gathered by key.
3. A scan over the chunks of each key, in two levels: the summaries of a block of
   sqrt(chunks) chunks are composed into one (``fold.compose_pieces``), the blocks'
   summaries give the state at each block's start, and from there the requests of the
   block are answered.  No group holds more than sqrt(chunks) summaries of a key.
4. The states (one row per chunk) are broadcast to the chunks while there are few enough
   of them (``BROADCAST_CHUNKS``), so that the chunks stay as they are, and joined by
   ``_pid`` beyond that.  Every task folds its chunks from those states (``mapInArrow``:
   payload columns pass through as Arrow, types fold as dictionary codes, vectorised
   across keys when dates are non-decreasing).  A state carries the number of changes
   before it, so changes are numbered over the whole key in the same pass.

:func:`transitions_lag` is the plain built-in window form.  It equals the fold
only when each key's dates are non-decreasing in arrival order, and its
``Window.partitionBy(key)`` puts a whole key in one task; kept for ordered
inputs with bounded keys and as a cross-check.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DATE_EVENT, EVENT_TYPE, ID, INITIAL_DATE, INITIAL_TYPE, SEQ
from ..session import ensure_checkpoint_dir, partitions_for, shared_path, ship_package
from . import fold

PID = "_pid"
CHUNK = "_chunk"
ANNOTATIONS = [
    T.StructField("accepted", T.BooleanType()),
    T.StructField("late", T.BooleanType()),
    T.StructField("prev_type", T.StringType()),
    T.StructField("prev_date", T.LongType()),
    T.StructField("created", T.BooleanType()),
    # number of the chunk this row was folded in (chunks are in (key, seq) order), and the
    # accepted changes of this key before this row
    T.StructField(CHUNK, T.LongType()),
    T.StructField("change_no", T.LongType()),
]

# Two rows per chunk: a request for the entering state of its first key (role 0) and
# the summary of its last key's slice (role 1) with the slice's newest date.
_SUMMARY = T.StructType(
    [
        T.StructField(PID, T.IntegerType()),
        T.StructField("_k", T.StringType()),
        T.StructField("_role", T.IntegerType()),
        T.StructField("_newest", T.LongType()),
        T.StructField("thr", T.ArrayType(T.LongType())),
        T.StructField("t1", T.ArrayType(T.StringType())),
        T.StructField("x1t", T.ArrayType(T.StringType())),
        T.StructField("x1d", T.ArrayType(T.LongType())),
        T.StructField("n1", T.ArrayType(T.LongType())),
        T.StructField("x2t", T.ArrayType(T.StringType())),
        T.StructField("x2d", T.ArrayType(T.LongType())),
        T.StructField("n2", T.ArrayType(T.LongType())),
    ]
)
_PIECES = ["thr", "t1", "x1t", "x1d", "n1", "x2t", "x2d", "n2"]
BLOCK = "_block"
_ENTER = T.StructType(
    [
        T.StructField(PID, T.IntegerType()),
        T.StructField("_enter_type", T.StringType()),
        T.StructField("_enter_date", T.LongType()),
        T.StructField("_enter_initial", T.BooleanType()),
        T.StructField("_enter_changes", T.LongType()),
    ]
)
_STATE = _ENTER.fields[1:]
_BLOCK_SUMMARY = T.StructType([T.StructField("_k", T.StringType()), T.StructField(BLOCK, T.IntegerType()), *_SUMMARY.fields[4:]])
_BLOCK_ENTER = T.StructType([T.StructField("_k", T.StringType()), T.StructField(BLOCK, T.IntegerType()), *_STATE])
_INIT = (INITIAL_TYPE, INITIAL_DATE, True)
_START = (*_INIT, 0)
#: Entering states are broadcast for so many chunks at most: a row is a type, a date and a
#: number, so that is some 50 MB.
BROADCAST_CHUNKS = 1 << 20


def _chunks(pids):
    """(start, end) of the runs of equal ``_pid`` in a batch."""
    cuts = np.flatnonzero(pids[1:] != pids[:-1]) + 1
    starts = np.concatenate([[0], cuts]).tolist()
    ends = np.concatenate([cuts, [len(pids)]]).tolist()
    return zip(starts, ends)


def _summarise(key: str, type_col: str, date_col: str):
    """One narrow Arrow pass: per chunk a request for its first key and the summary of
    its last key's slice."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        rows: list = []
        str_type = None
        cur_pid = first_key = last_key = None
        t_parts: list = []
        d_parts: list = []

        def flush():
            types = pa.concat_arrays(t_parts).to_numpy(zero_copy_only=False)
            dates = np.concatenate(d_parts)
            pieces = fold.run_pieces(types, dates)
            rows.append((cur_pid, first_key, 0, None, *([None] * len(_PIECES))))
            rows.append((cur_pid, last_key, 1, int(dates.max()), *[list(v) for v in pieces]))

        for b in batches:
            n = b.num_rows
            if n == 0:
                continue
            keys = b.column(key)
            str_type = keys.type
            pids = b.column(PID).to_numpy(zero_copy_only=False)
            types = b.column(type_col)
            dates = b.column(date_col).to_numpy(zero_copy_only=False)
            for s, e in _chunks(pids):
                if pids[s] != cur_pid:
                    if cur_pid is not None:
                        flush()
                    cur_pid, first_key, last_key = int(pids[s]), keys[s].as_py(), None
                k_last = keys[e - 1].as_py()
                other = np.flatnonzero(pc.not_equal(keys.slice(s, e - s), k_last).to_numpy(zero_copy_only=False))
                start = s + (int(other[-1]) + 1 if len(other) else 0)
                if start > s or k_last != last_key:
                    t_parts, d_parts = [], []
                last_key = k_last
                t_parts.append(types.slice(start, e - start))
                d_parts.append(dates[start:e])
        if cur_pid is not None:
            flush()
        if rows:
            # strings follow the session's Arrow string type; lists stay regular lists
            lst = pa.list_
            schema = pa.schema([
                (PID, pa.int32()), ("_k", str_type), ("_role", pa.int32()), ("_newest", pa.int64()),
                ("thr", lst(pa.int64())), ("t1", lst(str_type)),
                ("x1t", lst(str_type)), ("x1d", lst(pa.int64())), ("n1", lst(pa.int64())),
                ("x2t", lst(str_type)), ("x2d", lst(pa.int64())), ("n2", lst(pa.int64())),
            ])
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(cols, schema)], schema=schema)

    return run


def bounded_summaries(summaries: DataFrame, per_block: int = 32) -> DataFrame:
    """The summaries (not the requests) with ``_block``, the number of their block of
    ``per_block`` chunks, without the pieces that no entering date can reach.

    The state's date is that of an accepted event, so it is at most the newest date of
    the key's earlier chunks (or the initial date).  Pieces are in ascending order of the
    largest date that they hold for: those up to the bound stay, and the one it falls in."""
    parts = summaries.where("_role = 1").withColumn(BLOCK, (F.col(PID) / per_block).cast("int"))
    earlier = Window.unboundedPreceding, -1
    blocks = parts.groupBy("_k", BLOCK).agg(F.max("_newest").alias("_newest"))
    before = F.max("_newest").over(Window.partitionBy("_k").orderBy(BLOCK).rowsBetween(*earlier))
    parts = parts.join(blocks.select("_k", BLOCK, before.alias("_before")), ["_k", BLOCK])
    within = F.max("_newest").over(Window.partitionBy("_k", BLOCK).orderBy(PID).rowsBetween(*earlier))
    parts = parts.withColumn("_bound", F.greatest(F.lit(INITIAL_DATE), "_before", within))
    parts = parts.withColumn("_reach", F.size(F.filter("thr", lambda t: t < F.col("_bound"))) + 1)
    return parts.select(PID, "_k", BLOCK, "_role", *[F.slice(c, F.lit(1), F.col("_reach")).alias(c) for c in _PIECES])


def _pieces_of(pdf: pd.DataFrame) -> list[tuple]:
    return list(zip(*[pdf[c].to_numpy(dtype=object) for c in _PIECES]))


def _compose_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """One summary of a key's summaries in a block, combined in a tree."""
    pdf = pdf.sort_values(PID, kind="stable")
    level = _pieces_of(pdf)
    while len(level) > 1:
        pairs = [level[i : i + 2] for i in range(0, len(level), 2)]
        level = [fold.compose_pieces(*p) if len(p) == 2 else p[0] for p in pairs]
    row = (pdf["_k"].iloc[0], pdf[BLOCK].iloc[0], *map(list, level[0]))
    return pd.DataFrame([row], columns=_BLOCK_SUMMARY.names)


def _scan(pdf: pd.DataFrame, state: tuple, at: str, emit: list[str]) -> list[tuple]:
    """Rows in the order of ``at``, requests (``_role`` 0) first: the state at each request."""
    pdf = pdf.sort_values([at, "_role"], kind="stable")
    out = []
    for named, role, pieces in zip(pdf[emit].itertuples(index=False), pdf["_role"].tolist(), _pieces_of(pdf)):
        if role == 0:
            out.append((*named, *state))
        else:
            state = fold.apply_pieces(*pieces, state)
    return out


def _enter_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
    """A key's blocks in order: the state in which each block with a request is entered."""
    return pd.DataFrame(_scan(pdf, _START, BLOCK, ["_k", BLOCK]), columns=_BLOCK_ENTER.names)


def _enter_chunks(pdf: pd.DataFrame) -> pd.DataFrame:
    """A key's chunks in a block: the state in which each chunk with a request is entered."""
    state = tuple(pdf[f.name].iloc[0] for f in _STATE)
    return pd.DataFrame(_scan(pdf, state, PID, [PID]), columns=_ENTER.names)


def entering_states(summaries: DataFrame, chunks: int) -> DataFrame:
    """The entering state of each of ``chunks`` chunks, from the rows of ``_SUMMARY`` (best
    a checkpoint or table: they are read several times)."""
    per_block = max(1, math.isqrt(chunks - 1) + 1) if chunks > 0 else 1
    parts = bounded_summaries(summaries, per_block)
    requests = summaries.where("_role = 0").select(
        PID, "_k", (F.col(PID) / per_block).cast("int").alias(BLOCK), "_role", *[F.lit(None).cast(_SUMMARY[c].dataType).alias(c) for c in _PIECES]
    )
    composed = parts.groupBy("_k", BLOCK).applyInPandas(_compose_block, _BLOCK_SUMMARY).withColumn("_role", F.lit(1))
    asked = requests.drop(PID).dropDuplicates(["_k", BLOCK])
    blocks = composed.unionByName(asked).groupBy("_k").applyInPandas(_enter_blocks, _BLOCK_ENTER)
    return parts.unionByName(requests).join(blocks, ["_k", BLOCK]).groupBy("_k", BLOCK).applyInPandas(_enter_chunks, _ENTER)


def _fold_chunks(key: str, order: str, type_col: str, date_col: str, keep: str, out_names: list[str]):
    """Fold pass over Arrow batches (``mapInArrow``): payload columns pass
    through untouched; types are folded as dictionary codes, keys compared in
    Arrow's C++ kernels."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        cur_pid = None
        cur_key = None
        chunk = None
        state = _INIT  # (type text, date, initial)
        counter = 0
        last_pos = None
        for b in batches:
            n = b.num_rows
            if n == 0:
                continue
            pids = b.column(PID).to_numpy(zero_copy_only=False)
            keys_a = b.column(key)
            seqs = b.column(order).to_numpy(zero_copy_only=False)
            dates = b.column(date_col).to_numpy(zero_copy_only=False)
            types_a = b.column(type_col)
            enc = pc.dictionary_encode(types_a)
            names = enc.dictionary.to_pylist()
            code_of = {t: i for i, t in enumerate(names)}

            def code(text):
                if text not in code_of:
                    code_of[text] = len(names)
                    names.append(text)
                return code_of[text]

            types = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            kenc = pc.dictionary_encode(keys_a).indices.to_numpy(zero_copy_only=False)
            same_all = kenc[1:] == kenc[:-1]
            later = pc.greater(keys_a.slice(1), keys_a.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            init_c = (code(INITIAL_TYPE), INITIAL_DATE, True)
            dec = np.empty(n, np.int8)
            prev_t = np.empty(n, np.int64)
            prev_d = np.empty(n, np.int64)
            created = np.empty(n, bool)
            change_no = np.empty(n, np.int64)
            chunk_col = np.empty(n, np.int64)
            for s, e in _chunks(pids):
                k_first = keys_a[s].as_py()
                if pids[s] != cur_pid:
                    *state, counter = (b.column(f.name)[s].as_py() for f in _STATE)
                    if counter is None:
                        raise RuntimeError(f"no entering state for chunk {pids[s]}")
                    cur_pid, cur_key, chunk, last_pos = pids[s], k_first, int(pids[s]), None
                # order: keys strictly increasing, or equal with increasing seq
                ok = bool(np.all(later[s : e - 1] | (same_all[s : e - 1] & (seqs[s + 1 : e] > seqs[s : e - 1]))))
                if last_pos is not None:
                    ok = ok and (k_first > last_pos[0] or (k_first == last_pos[0] and int(seqs[s]) > last_pos[1]))
                if not ok:
                    raise RuntimeError("rows reached the fold out of (key, seq) order, or seq repeats within a key")
                k_last = keys_a[e - 1].as_py()
                last_pos = (k_last, int(seqs[e - 1]))
                if k_first != cur_key:
                    state, counter = _INIT, 0
                chunk_col[s:e] = chunk
                st = (code(state[0]), state[1], state[2])
                k, t, d = kenc[s:e], types[s:e], dates[s:e]
                same = same_all[s : e - 1]
                if not bool(np.any(same & (d[1:] < d[:-1]))):
                    # every key's dates are non-decreasing here: one vectorised pass
                    res = fold.fold_runs_sorted(k, t, d, st, counter, init_c)
                    dec[s:e], prev_t[s:e], prev_d[s:e], created[s:e], change_no[s:e], st, counter = res
                else:
                    cuts = np.flatnonzero(~same) + 1
                    for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), e - s]):
                        if a > 0:
                            st, counter = init_c, 0
                        r = fold.fold_segment(t[a:z], d[a:z], st)
                        dec[s + a : s + z], prev_t[s + a : s + z], prev_d[s + a : s + z], created[s + a : s + z] = r[:4]
                        st = r[4]
                        acc = (r[0] == fold.ACCEPTED).astype(np.int64)
                        change_no[s + a : s + z] = counter + np.cumsum(acc) - acc
                        counter += int(acc.sum())
                state = (names[int(st[0])], int(st[1]), bool(st[2]))
                cur_key = k_last
            type_text = pa.array(names, type=types_a.type)
            cols = [b.column(c) for c in out_names[: -len(ANNOTATIONS)]] + [
                pa.array(dec == fold.ACCEPTED),
                pa.array(dec == fold.LATE),
                pc.take(type_text, pa.array(prev_t)),
                pa.array(prev_d, pa.int64()),
                pa.array(created),
                pa.array(chunk_col, pa.int64()),
                pa.array(change_no, pa.int64()),
            ]
            out = pa.RecordBatch.from_arrays(cols, names=out_names)
            if keep != "all":
                # rows the caller drops anyway never travel back to the JVM
                out = out.filter(pa.array(dec == (fold.ACCEPTED if keep == "accepted" else fold.LATE)))
            yield out

    return run


def annotate_transitions(
    events: DataFrame,
    *,
    key: str = ID,
    order: str = SEQ,
    type_col: str = EVENT_TYPE,
    date_col: str = DATE_EVENT,
    num_partitions: int | None = None,
    keep: str = "all",
) -> DataFrame:
    """Every event with its decision under the transition rule.

    Adds ``accepted``, ``late`` (type differs but older than the state),
    ``prev_type`` / ``prev_date`` (the state it was compared with), ``created``
    (the key had no accepted change before), ``_pid``, ``_chunk`` and
    ``change_no`` (the key's accepted changes before the row).  Events with a NULL key, type, date or order are left out.  ``order``
    must be unique within a key (an arrival position such as a topic offset).
    ``keep="accepted"`` / ``"late"`` returns only those rows (filtered in the
    task, before the rows go back to the JVM).

    Checkpoints the sorted ranges and runs the small summary job eagerly; the returned
    frame (the fold itself) is lazy.  Spark removes the checkpoint when it is no longer
    referenced if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    if keep not in ("all", "accepted", "late"):
        raise ValueError("keep must be 'all', 'accepted' or 'late'")
    spark = events.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    base = events.where(
        F.col(key).isNotNull() & F.col(type_col).isNotNull() & F.col(date_col).isNotNull() & F.col(order).isNotNull()
    )
    base = base.withColumn(key, F.col(key).cast("string")).withColumn(date_col, F.col(date_col).cast("long"))
    # An explicit range count keeps every range its own task (AQE does not merge
    # it); by default it is sized like AQE would: estimated bytes / advisory size.
    ranged = base.repartitionByRange(num_partitions or partitions_for(base), key, order)
    ranged = ranged.sortWithinPartitions(key, order).withColumn(PID, F.spark_partition_id())
    chunks = ranged.checkpoint()

    summaries = chunks.select(PID, key, type_col, date_col).mapInArrow(_summarise(key, type_col, date_col), _SUMMARY)
    n = chunks.rdd.getNumPartitions()
    enter = entering_states(summaries.checkpoint(), n)
    path = shared_path(spark, "fold", unique=True)
    enter.write.mode("overwrite").parquet(path)
    enter = spark.read.schema(_ENTER).parquet(path)

    schema = T.StructType(list(chunks.schema.fields) + ANNOTATIONS)
    if n <= BROADCAST_CHUNKS:
        # One row per chunk: the chunks keep their partitions and their order.
        entered = chunks.join(enter.hint("broadcast"), PID, "left")
    else:
        entered = chunks.join(enter, PID, "left").sortWithinPartitions(PID, key, order)
    return entered.mapInArrow(_fold_chunks(key, order, type_col, date_col, keep, schema.names), schema)


def transitions(events: DataFrame, **kw) -> DataFrame:
    """Accepted changes: the flat change stream (plus ``seq`` and annotations)."""
    return annotate_transitions(events, keep="accepted", **kw)


def late_rejected(events: DataFrame, **kw) -> DataFrame:
    """Events whose type differs from the state but whose date is older."""
    return annotate_transitions(events, keep="late", **kw)


def with_change_kind(changes: DataFrame) -> DataFrame:
    """``change_kind`` ('created' for a key's first change, else 'updated') and
    ``previous_type`` (NULL when created) on annotated accepted rows."""
    return changes.withColumn("change_kind", F.when(F.col("created"), "created").otherwise("updated")).withColumn(
        "previous_type", F.when(F.col("created"), F.lit(None)).otherwise(F.col("prev_type"))
    )


def transitions_lag(
    events: DataFrame,
    *,
    key: str = ID,
    order: str = SEQ,
    type_col: str = EVENT_TYPE,
    date_col: str = DATE_EVENT,
) -> DataFrame:
    """Built-in form for inputs whose dates never decrease in arrival order.

    Events dated before the initial state are rejected first; after that every
    event is compared with its predecessor's type."""
    w = Window.partitionBy(key).orderBy(order)
    kept = events.where(F.col(date_col) >= F.lit(INITIAL_DATE))
    prev = F.coalesce(F.lag(type_col).over(w), F.lit(INITIAL_TYPE))
    return kept.withColumn("_prev", prev).where(F.col(type_col) != F.col("_prev")).drop("_prev")
