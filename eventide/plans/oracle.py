"""DuckDB SQL equivalents of the catalogue queries (same column names).

``SRC`` maps the ``events`` table onto the canonical event layout exactly as
``sources.events.events_from_table`` does (epoch_us//1000 floors like Spark).
``TR`` is the transition filter for time-ordered arrival (``lag``); the
out-of-order oracles fold with a recursive CTE in shuffled arrival order.
"""

from __future__ import annotations

from .catalogue import HOT_EVERY, HOT_KEY, REPLAY_IDS, T

SRC = """src as (
  select cast(user_id as varchar) id, event_type, epoch_us(ts)//1000 date_event, value lat,
    cast(props->>'$.k' as double) lng,
    'zone-'||cast(cast(props->>'$.k' as int)%10 as varchar) as location,
    event_id seq, (event_id*7919)%1000003 ooo
  from events)"""

TR = f"""with {SRC},
 t as (select *, lag(event_type) over (partition by id order by seq) p from src),
 a as (select * from t where p is null or p<>event_type)
"""

FOLD = f"""with recursive {SRC},
 r as (select *, row_number() over (partition by id order by ooo) rn from src),
 f as (select id, rn, event_type st, date_event sd, true ok, false late from r where rn=1
   union all
   select r.id, r.rn,
     case when r.event_type<>f.st and f.sd<=r.date_event then r.event_type else f.st end,
     case when r.event_type<>f.st and f.sd<=r.date_event then r.date_event else f.sd end,
     (r.event_type<>f.st and f.sd<=r.date_event),
     (r.event_type<>f.st and f.sd>r.date_event)
   from f join r on r.id=f.id and r.rn=f.rn+1)
"""

FLAT = "id, event_type, date_event, lat, lng, location"
SNAP = "id, date_event, event_type, location, lat, lng"
IDS = ", ".join(f"'{i}'" for i in REPLAY_IDS.split(","))

HISTORY = f"""{TR}select id, event_type, date_event,
  array_to_string(list(event_type) over w, '|') event_type_memory,
  array_to_string(list(date_event) over w, '|') date_event_memory,
  count(*) over w n
from a window w as (partition by id order by seq rows between unbounded preceding and current row)"""

LAST_PER_ID = f"""{TR}select {SNAP} from
  (select *, row_number() over (partition by id order by seq desc) rn from a) where rn=1"""

ASOF = f"""{TR}select {SNAP} from
  (select *, row_number() over (partition by id order by date_event desc, seq desc) rn
   from a where date_event<={T}) where rn=1"""

REPLAY = f"{TR}select {SNAP} from a where date_event>{T}"

TRANSITIONS = f"{TR}select {FLAT} from a"

PARSE = f"with {SRC} select {FLAT}, seq from src"

HOT = f"""with {SRC},
 h as (select case when seq % {HOT_EVERY} = 0 then '{HOT_KEY}' else id end id,
         event_type, date_event, lat, lng, location, seq from src),
 t as (select *, lag(event_type) over (partition by id order by seq) p from h)
select {FLAT} from t where p is null or p<>event_type"""


def oracles() -> dict[str, str]:
    ordered = f"""{FOLD}select r.id, r.event_type, r.date_event, r.lat, r.lng, r.location
from r join f on r.id=f.id and r.rn=f.rn where f.ok"""
    late = f"""{FOLD}select r.id, r.event_type, r.date_event, r.lat, r.lng, r.location
from r join f on r.id=f.id and r.rn=f.rn where f.late"""
    return {
        "stream_out_of_order": ordered,
        "stream_late_rejected": late,
        "stream_state": f"""{FOLD}select id, arg_max(st, rn) event_type, arg_max(sd, rn) date_event
from f group by id having bool_or(ok)""",
        "stream_hot_key": HOT,
        "stream_parts_current": LAST_PER_ID,
        "asof_stored": ASOF,
        "replay_stored": REPLAY,
        "merge_latest": """select o_custkey, o_orderkey, o_totalprice from
  (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) rn
   from orders) where rn=1""",
        "parse_types": f"""with {SRC}, k as (select *, seq % 7 k, cast(seq as varchar) n from src)
select seq,
  case k when 0 then n when 1 then n when 2 then n||'.9' when 3 then 'x'||n when 4 then 'true' when 5 then 'null' else '' end event_type,
  case when seq % 11 = 0 then -1 when k < 3 then seq when k = 4 then 1 else 0 end date_event,
  case k when 0 then seq when 1 then seq when 2 then seq + 0.9 when 4 then 1 else 0 end::double lat,
  '' as location, seq % 11 <> 0 as valid
from k""",
        "parse_events": PARSE,
        "transitions": TRANSITIONS,
        "transitions_hot_key": HOT,
        "transitions_out_of_order": f"""{FOLD}select r.id, r.event_type, r.date_event, r.lat, r.lng, r.location
from r join f on r.id=f.id and r.rn=f.rn where f.ok""",
        "late_rejected": f"""{FOLD}select r.id, r.event_type, r.date_event, r.lat, r.lng, r.location
from r join f on r.id=f.id and r.rn=f.rn where f.late""",
        "change_kind": f"""{TR}select id, event_type, date_event,
  case when lag(event_type) over w is null then 'created' else 'updated' end change_kind,
  lag(event_type) over w previous_type
from a window w as (partition by id order by seq)""",
        "history_rows": HISTORY,
        "history_rows_nulls": f"""{TR}select id, date_event,
  array_to_string(list(coalesce(place, '~')) over w, '|') location_memory, count(*) over w n, count(*) over w n_coordinates
from (select *, case when seq % 4 <> 0 then location end place from a)
window w as (partition by id order by seq rows between unbounded preceding and current row)""",
        "parse_rejects": f"with {SRC} select seq, (seq % 7 <> 0 and seq % 11 <> 0 and seq % 13 <> 0) accepted from src",
        "stream_rejects": f"with {SRC} select seq, true has_text from src where seq % 11 = 0",
        "replay_json_single_file": REPLAY,
        "latest_ties": """select o.o_custkey, o.o_orderkey, o.o_totalprice from orders o
join (select o_custkey c, max(o_orderdate) m from orders group by 1) g
  on c=o_custkey and m=o_orderdate""",
        "latest_per_key": """select o_custkey, o_orderkey, o_totalprice from
  (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) rn
   from orders) where rn=1""",
        "ensure_table": f"""{TR}select id, date_event from
  (select *, row_number() over (partition by id order by seq desc) rn from a) where rn=1""",
        "upsert_merge": LAST_PER_ID,
        "table_at_version": f"""{TR}select {SNAP} from
  (select *, row_number() over (partition by id order by seq desc) rn from a where date_event<={T})
  where rn=1""",
        "current_state": LAST_PER_ID,
        "asof_snapshot": ASOF,
        "asof_snapshot_rows": ASOF,
        "replay_after": REPLAY,
        "replay_after_ids": f"{REPLAY} and id in ({IDS})",
        "replay_from_log": REPLAY,
        "array_ops": f"""{TR}select id, count(*) n_changes,
  count(*) filter (where date_event<={T}) n_before,
  min(date_event) filter (where date_event>{T}) first_after,
  max(lat) max_lat
from a group by id""",
        "parse_event_time": """select event_id, strftime(ts, '%d/%m/%Y') date_text, strftime(ts, '%H:%M:%S') time_text,
  epoch_ms(strptime(strftime(ts, '%d/%m/%Y %H:%M:%S'), '%d/%m/%Y %H:%M:%S')) t_millis
from events""",
        "encode_event_json": TRANSITIONS,
        "encode_history_json": HISTORY,
        "decode_history_json": HISTORY,
        "replay_json_roundtrip": REPLAY,
        "stream_parse_events": PARSE,
        "stream_transitions": TRANSITIONS,
        "stream_history_rows": HISTORY,
        "stream_upsert_latest": LAST_PER_ID,
    }
