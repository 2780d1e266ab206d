"""First hop on the batch fold: a stream whose micro-batches may be any share of one key.

The keyed operators of ``streaming.processor`` hold a key's rows of a micro-batch in one task.
Here each micro-batch goes through the batch fold (``operators.transitions``), which spreads a
key over as many tasks as its rows need.  The keys' states are a table of parts
(``sources.parts``): a batch reads the states as they were before it, for its own keys, and
adds those that it changes.

A state enters the fold as a row before the key's first event, which is accepted by the
initial state and so sets it.  (The type ``-`` of the initial state is not; a state of that type
is led by a row of a type of its own.)

All outputs are parts of the batch's number.  A batch that is given again, whatever it had
written before it failed, reads the same states and replaces the same parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import history as hist
from ..operators import transitions as tr
from ..schema import DATE_EVENT, EVENT_TYPE, FLAT_COLUMNS, ID, INITIAL_TYPE, LAT, LNG, LOCATION, SEQ
from ..sources import parts

STATE = T.StructType([T.StructField(ID, T.StringType()), T.StructField(EVENT_TYPE, T.StringType()), T.StructField(DATE_EVENT, T.LongType())])
DECIDED = T.StructType(
    [
        T.StructField(ID, T.StringType()),
        T.StructField(EVENT_TYPE, T.StringType()),
        T.StructField(DATE_EVENT, T.LongType()),
        T.StructField(LAT, T.DoubleType()),
        T.StructField(LNG, T.DoubleType()),
        T.StructField(LOCATION, T.StringType()),
        T.StructField(SEQ, T.LongType()),
        T.StructField("late", T.BooleanType()),
        T.StructField("change_no", T.LongType()),
    ]
)
SEGMENT = hist.SEGMENT_ROW
#: Arrival positions of the rows that stand for states; no event has one so small.
_LEAD, _STATE_SEQ = -(1 << 62), -(1 << 62) + 1


def _state_rows(state: DataFrame, keys: DataFrame) -> DataFrame:
    """The states of ``keys`` as events."""
    known = state.join(keys, ID, "left_semi")
    blank = [F.lit(None).cast(t).alias(c) for c, t in ((LAT, "double"), (LNG, "double"), (LOCATION, "string"))]
    own = known.select(ID, EVENT_TYPE, DATE_EVENT, *blank, F.lit(_STATE_SEQ).alias(SEQ))
    lead = known.where(F.col(EVENT_TYPE) == INITIAL_TYPE).select(ID, F.lit("\0").alias(EVENT_TYPE), DATE_EVENT, *blank, F.lit(_LEAD).alias(SEQ))
    return own.union(lead)


def fold_batch(events: DataFrame, state: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """``DECIDED`` rows of one micro-batch: its accepted changes and late events, from the states
    before it (``id, event_type, date_event``).  ``change_no`` counts within the batch."""
    events = events.select(*FLAT_COLUMNS, SEQ)
    rows = events.unionByName(_state_rows(state, events.select(ID).distinct()))
    decided = tr.annotate_transitions(rows, num_partitions=num_partitions)
    decided = decided.where(f"(accepted OR late) AND {SEQ} > {_STATE_SEQ}")
    return decided.select(*DECIDED.names)


def ensure_outputs(spark: SparkSession, path: str) -> None:
    for name, schema in (("decided", DECIDED), ("state", STATE), ("segments", SEGMENT)):
        parts.ensure(spark, f"{path}/{name}", schema)


def write_batch(events: DataFrame, path: str, version: int, segment_size: int = 10_000, num_partitions: int | None = None) -> None:
    """Fold one micro-batch into the tables under ``path``: ``decided`` (changes and late
    events), ``segments`` (the changes as history rows) and ``state``, in this order."""
    spark = events.sparkSession
    before = parts.latest(spark, f"{path}/state", STATE, ID, upto=version - 1)
    parts.write_part(fold_batch(events, before, num_partitions), f"{path}/decided", version)
    new = parts.read_parts(spark, f"{path}/decided", DECIDED).where((F.col(parts.VERSION) == version) & ~F.col("late")).drop("late", parts.VERSION)
    parts.write_part(hist.history_table(new, segment_size=segment_size).select(*SEGMENT.names), f"{path}/segments", version)
    last = new.groupBy(ID).agg(F.max_by(F.struct(EVENT_TYPE, DATE_EVENT), SEQ).alias("_last"))
    parts.write_part(last.select(ID, f"_last.{EVENT_TYPE}", f"_last.{DATE_EVENT}"), f"{path}/state", version)


def fold_stream(events: DataFrame, path: str, checkpoint: str, available_now: bool = False, **options):
    """A stream of canonical events folded batch by batch into the tables under ``path``."""
    ensure_outputs(events.sparkSession, path)

    def batch(df: DataFrame, batch_id: int) -> None:
        write_batch(df, path, batch_id + 1, **options)

    writer = events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def changes(spark: SparkSession, path: str, late: bool = False, upto: int | None = None) -> DataFrame:
    """The accepted changes (or the late events) of all batches."""
    rows = parts.read_parts(spark, f"{path}/decided", DECIDED, upto)
    return rows.where(F.col("late") if late else ~F.col("late"))


def segments(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """The history rows of all batches, for ``operators.timetravel``."""
    return parts.read_parts(spark, f"{path}/segments", SEGMENT, upto)
