"""Keyed stateful transition filter for Structured Streaming.

One operator does all jobs of the first hop (flat changes, history rows and rejected late
events): per key it keeps the state ``(type, date)`` of the last accepted event and,
when history output is asked for, the key's accepted changes.  Inside a
micro-batch a key's rows are folded in ``seq`` order; across micro-batches the
state carries over (checkpointed with the query).  With ``late`` the output has the late
events too, told apart by a ``late`` column, so that one state serves both outputs.

Two equivalent forms:

* :func:`keyed_transitions` — ``groupBy(id).applyInPandasWithState`` (state is
  one row; works with any state store provider);
* :class:`TransitionProcessor` — ``groupBy(id).transformWithStateInPandas`` with a
  ``ValueState`` for the rule and a ``ListState`` for the history (RocksDB state
  store provider).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import fold
from ..schema import (
    DATE_EVENT,
    EVENT_TYPE,
    FLAT_CHANGE,
    HISTORY_ROW,
    ID,
    INITIAL_DATE,
    INITIAL_TYPE,
    LAT,
    LNG,
    LOCATION,
    SEQ,
)
from ..session import ship_package

FLAT_OUT = T.StructType(list(FLAT_CHANGE.fields) + [T.StructField(SEQ, T.LongType())])
HISTORY_OUT = T.StructType(list(HISTORY_ROW.fields) + [T.StructField(SEQ, T.LongType())])
LATE = "late"


def output_schema(history: bool, late: bool) -> T.StructType:
    """The operator's output; ``late`` adds the column that tells late events from changes."""
    base = HISTORY_OUT if history else FLAT_OUT
    return T.StructType([*base.fields, T.StructField(LATE, T.BooleanType())]) if late else base


_RULE_STATE = "event_type string, date_event long"
_HISTORY_STATE = (
    "event_type string, date_event long, dates array<bigint>, types array<string>, "
    "coords array<array<double>>, locs array<string>"
)


def _concat(frames) -> pd.DataFrame:
    frames = list(frames)
    full = [f for f in frames if len(f)]
    if not full:
        return frames[0]
    return full[0] if len(full) == 1 else pd.concat(full, ignore_index=True)


def _decide(pdf: pd.DataFrame, state: tuple):
    """One key's rows of a micro-batch, folded in the order of ``seq`` from ``state``: the
    accepted rows, the late ones and the new state."""
    pdf = pdf.sort_values(SEQ, kind="stable")
    types = pdf[EVENT_TYPE].to_numpy(dtype=object)
    dates = pdf[DATE_EVENT].to_numpy(dtype=np.int64)
    dec, _, _, _, new_state = fold.fold_segment(types, dates, state)
    return pdf[dec == fold.ACCEPTED], pdf[dec == fold.LATE], new_state


def _flat_rows(acc: pd.DataFrame, old: pd.DataFrame, late: bool) -> pd.DataFrame:
    names = FLAT_OUT.names
    if not late:
        return acc[names]
    return pd.concat([acc[names].assign(**{LATE: False}), old[names].assign(**{LATE: True})], ignore_index=True)


def _late_rows(key, old: pd.DataFrame) -> pd.DataFrame:
    """Late events in the columns of history rows; they have no history arrays."""
    rows = [
        (key, getattr(r, EVENT_TYPE), int(getattr(r, DATE_EVENT)), _pair(r), getattr(r, LOCATION), None, None, None, None, int(getattr(r, SEQ)), True)
        for r in old.itertuples(index=False)
    ]
    return pd.DataFrame(rows, columns=[*HISTORY_OUT.names, LATE])


def _pair(row) -> list:
    """``[lat, lng]``; a missing number stays None, as in the batch form."""
    return [None if pd.isna(v) else float(v) for v in (getattr(row, LAT), getattr(row, LNG))]


def _history_rows(key, acc: pd.DataFrame, dates: list, types: list, coords: list, locs: list) -> pd.DataFrame:
    out = []
    for r in acc.itertuples(index=False):
        c = _pair(r)
        dates.append(int(getattr(r, DATE_EVENT)))
        types.append(getattr(r, EVENT_TYPE))
        coords.append(c)
        locs.append(getattr(r, LOCATION))
        out.append(
            (key, getattr(r, EVENT_TYPE), int(getattr(r, DATE_EVENT)), c, getattr(r, LOCATION),
             list(dates), list(types), [list(x) for x in coords], list(locs), int(getattr(r, SEQ)))
        )
    return pd.DataFrame(out, columns=[f.name for f in HISTORY_OUT.fields])


def _flat_state_fn(late: bool):
    def run(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.exists:
            t, d = state.get
            st = (t, int(d), False)
        else:
            st = (INITIAL_TYPE, INITIAL_DATE, True)
        acc, old, new_state = _decide(_concat(pdfs), st)
        if not new_state[2]:
            state.update((new_state[0], int(new_state[1])))
        yield _flat_rows(acc, old, late)

    return run


def _history_state_fn(late: bool):
    def run(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        (k,) = key
        pdf = _concat(pdfs)
        if state.exists:
            t, d, dates, types, coords, locs = state.get
            st = (t, int(d), False)
            dates, types, locs = list(dates), list(types), list(locs)
            coords = [list(c) for c in coords]
        else:
            st = (INITIAL_TYPE, INITIAL_DATE, True)
            dates, types, coords, locs = [], [], [], []
        acc, old, new_state = _decide(pdf, st)
        out = _history_rows(k, acc, dates, types, coords, locs)
        if not new_state[2]:
            state.update((new_state[0], int(new_state[1]), dates, types, coords, locs))
        yield out.assign(**{LATE: False}) if late else out
        if late and len(old):
            yield _late_rows(k, old)

    return run


def keyed_transitions(events: DataFrame, history: bool = False, late: bool = False) -> DataFrame:
    """Streaming (or batch) transition filter with state across micro-batches.

    ``events`` needs ``id, event_type, date_event, lat, lng, location, seq``.
    Output: accepted changes (``history=False``) or history rows, plus ``seq``; with ``late``
    also the rejected late events, marked in the column ``late``.  A task
    holds one key's rows of a micro-batch (bound them with the source's rate limit) and,
    for history rows, that key's history."""
    ship_package(events.sparkSession)
    cols = [ID, EVENT_TYPE, DATE_EVENT, LAT, LNG, LOCATION, SEQ]
    grouped = events.select(*cols).groupBy(ID)
    run, state = (_history_state_fn(late), _HISTORY_STATE) if history else (_flat_state_fn(late), _RULE_STATE)
    return grouped.applyInPandasWithState(run, output_schema(history, late), state, "append", "NoTimeout")


class TransitionProcessor(StatefulProcessor):
    """``transformWithStateInPandas`` form: ValueState for the rule, ListState for
    the history (only when ``history=True``)."""

    def __init__(self, history: bool = False, late: bool = False) -> None:
        self.history = history
        self.late = late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rule = handle.getValueState("rule", _RULE_STATE)
        if self.history:
            self.changes = handle.getListState(
                "changes", "date_event long, event_type string, lat double, lng double, location string"
            )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        (k,) = key
        pdf = _concat(rows)
        if self.rule.exists():
            t, d = self.rule.get()
            st = (t, int(d), False)
        else:
            st = (INITIAL_TYPE, INITIAL_DATE, True)
        acc, old, new_state = _decide(pdf, st)
        if not new_state[2]:
            self.rule.update((new_state[0], int(new_state[1])))
        if not self.history:
            yield _flat_rows(acc, old, self.late)
            return
        dates, types, coords, locs = [], [], [], []
        if self.changes.exists():
            for d, t, la, ln, lo in self.changes.get():
                dates.append(int(d))
                types.append(t)
                coords.append([None if pd.isna(v) else float(v) for v in (la, ln)])
                locs.append(lo)
        out = _history_rows(k, acc, dates, types, coords, locs)
        if len(acc):
            self.changes.appendList(
                [(int(getattr(r, DATE_EVENT)), getattr(r, EVENT_TYPE), *_pair(r), getattr(r, LOCATION))
                 for r in acc.itertuples(index=False)]
            )
        yield out.assign(**{LATE: False}) if self.late else out
        if self.late and len(old):
            yield _late_rows(k, old)

    def close(self) -> None:
        pass


def keyed_transitions_tws(events: DataFrame, history: bool = False, late: bool = False) -> DataFrame:
    """:func:`keyed_transitions` on :class:`TransitionProcessor`."""
    ship_package(events.sparkSession)
    cols = [ID, EVENT_TYPE, DATE_EVENT, LAT, LNG, LOCATION, SEQ]
    return events.select(*cols).groupBy(ID).transformWithStateInPandas(
        TransitionProcessor(history, late), output_schema(history, late), "Append", "None"
    )


def last_changes(spark: SparkSession, checkpoint: str, list_state: bool = False) -> DataFrame:
    """The state of a stream, read from its checkpoint: ``id, event_type, date_event`` of the
    last accepted change of each key, as of the last finished micro-batch.

    ``list_state``: the stream runs on :class:`TransitionProcessor`."""
    reader = spark.read.format("statestore")
    if list_state:
        rows = reader.option("stateVarName", "rule").load(checkpoint)
        return rows.select(f"key.{ID}", f"value.{EVENT_TYPE}", f"value.{DATE_EVENT}")
    rows = reader.load(checkpoint)
    return rows.select(f"key.{ID}", f"value.groupState.{EVENT_TYPE}", f"value.groupState.{DATE_EVENT}")
