"""DuckDB SQL twins of ``queries.QUERIES`` (same column names and types).

Written independently of the Spark plans, over the raw tables, in the most
direct (not the most scalable) form: row_number / running windows / a
recursive CTE where the reference is sequential.
"""

from __future__ import annotations

from .io_queries import IO_ORACLE

# Java's String.split (limit 0) in SQL: '' -> [''], only delimiters -> [],
# otherwise split after removing the trailing delimiter run.
def _java_split(expr: str, pattern: str) -> str:
    stripped = f"regexp_replace({expr}, '(?:{pattern})+\\z', '')"
    return (f"(case when {expr} = '' then ['']::varchar[] "
            f"when {stripped} = '' then []::varchar[] "
            f"else regexp_split_to_array({stripped}, '{pattern}') end)")


WS_RUN = r"[ \t\n\x0B\f\r]+"
WS_ONE = r"[ \t\n\x0B\f\r]"
NON_WORD = r"\W+"

_LINES = ("(select doc_id, unnest(case when text = '' then []::varchar[] else "
          "regexp_split_to_array(regexp_replace(text, '\\r?\\n\\z', ''), '\\r?\\n') end) "
          "as line from documents)")

_INGEST = "(timestamp '2024-01-01 00:00:00' + to_seconds(doc_id))"

_VIEWS_WINDOWS = """
with v as (
  select cast(json_extract_string(props, '$.k') as bigint) as item_id,
         unnest(generate_series(time_bucket(interval '5 minutes', ts) + interval '5 minutes',
                                time_bucket(interval '5 minutes', ts) + interval '60 minutes',
                                interval '5 minutes')) as window_end
  from events where event_type = 'view'),
counts as (
  select item_id, window_end - interval '60 minutes' as window_start, window_end,
         count(*) as view_count
  from v group by item_id, window_end)
"""

_LATE = """
with a as (
  select event_id, event_type, ts, epoch_us(ts) as us,
         event_id + (event_id * 7919) % 50 as arrival
  from events),
b as (
  select *,
         max(us) over (order by arrival, event_id
                       rows between unbounded preceding and 1 preceding) - 7200000000 as wm,
         (us // 3600000000) * 3600000000 + 3600000000 as we
  from a),
s as (
  select *, make_timestamp(we - 3600000000) as window_start, make_timestamp(we) as window_end,
         case when wm is null then 'on_time'
              when we - 1 + 3600000000 <= wm then 'dropped'
              when we - 1 <= wm then 'late'
              else 'on_time' end as status
  from b)
"""

ORACLE: dict[str, str] = {
    "window_item_counts": _VIEWS_WINDOWS + "select * from counts",
    "hot_items": _VIEWS_WINDOWS + """
, r as (
  select window_end,
         cast(row_number() over (partition by window_end
                                 order by view_count desc, item_id) - 1 as integer) as rank,
         item_id, view_count
  from counts)
select * from r where rank < 3""",
    "filter_eq": """
select event_id, user_id, cast(json_extract_string(props, '$.k') as bigint) as item_id
from events where event_type = 'view'""",
    "epoch_seconds": """
select event_id, epoch_us(ts) // 1000000 as epoch_s,
       make_timestamp((epoch_us(ts) // 1000000) * 1000000) as event_second,
       (epoch_us(ts) // 1000000) * 1000 as epoch_ms
from events""",
    "word_count": """
select word, count(*) as count
from (select unnest(regexp_split_to_array(lower(text), '\\W+')) as word from documents)
where length(word) > 0 group by word""",
    "side_output_main": f"""
with t as (
  select doc_id, unnest(regexp_split_to_array(lower(text), '\\W+')) as word from documents)
select word,
       {_INGEST.replace('doc_id', '(doc_id // 5) * 5')} as window_start,
       {_INGEST.replace('doc_id', '(doc_id // 5) * 5 + 5')} as window_end,
       count(*) as count
from t where length(word) between 1 and 5 group by all""",
    "side_output_rejected": """
with t as (
  select doc_id, unnest(regexp_split_to_array(lower(text), '\\W+')) as word from documents)
select doc_id, 'rejected: ' || word as value from t where length(word) > 5""",
    "tokens_ws_plus": f"""
select word, count(*) as count
from (select unnest({_java_split('line', WS_RUN)}) as word from {_LINES}) group by word""",
    "tokens_ws_single": f"""
select word, count(*) as count
from (select unnest({_java_split('line', WS_ONE)}) as word from {_LINES}) group by word""",
    "tumbling_word_count": f"""
with t as (select doc_id, unnest({_java_split('line', WS_ONE)}) as word from {_LINES})
select word,
       {_INGEST.replace('doc_id', '(doc_id // 5) * 5')} as window_start,
       {_INGEST.replace('doc_id', '(doc_id // 5) * 5 + 5')} as window_end,
       count(*) as count
from t group by all""",
    "split_even": "select o_orderkey from orders where o_orderkey % 2 = 0",
    "split_odd": "select o_orderkey from orders where o_orderkey % 2 <> 0",
    "split_all": """
select o_orderkey, case when o_orderkey % 2 = 0 then 'even' else 'odd' end as tags
from orders""",
    "connect_comap": f"""
select cast(o_orderkey as varchar) as value from orders
union all
select unnest({_java_split('line', NON_WORD)}) as value from {_LINES}""",
    "cached_prefix": """
select c_custkey,
       (select string_agg(r_name, ',' order by r_regionkey) from region) || ': ' || c_name
         as enriched
from customer""",
    "parse_tuple_text": """
select cast(l_orderkey as integer) as car_id, cast(l_linenumber as integer) as speed,
       l_extendedprice as distance, epoch_ms(l_shipdate) as ts
from lineitem""",
    "session_sum": """
with a as (
  select user_id, ts, value,
         case when ts - lag(ts) over (partition by user_id order by ts)
                   <= interval '30 minutes' then 0 else 1 end as b
  from events),
g as (select *, sum(b) over (partition by user_id order by ts) as sid from a)
select user_id, min(ts) as first_ts, max(ts) + interval '30 minutes' as session_end,
       count(*) as n, cast(sum(cast(value as decimal(18,2))) as double) as total
from g group by user_id, sid""",
    "tumbling_value_sum": """
with r as (
  select event_type, event_id, time_bucket(interval '10 minutes', ts) as window_start,
         cast(value as decimal(18,2)) * cast('1.2345' as decimal(5,4)) as amount,
         row_number() over (partition by event_type, time_bucket(interval '10 minutes', ts)
                            order by ts, event_id) as rn
  from events)
select event_type, window_start, window_start + interval '10 minutes' as window_end,
       cast(sum(amount) as double) as total, max(event_id) filter (where rn = 1) as first_id
from r group by all""",
    "window_summary": """
select event_type, time_bucket(interval '10 minutes', ts) as window_start,
       time_bucket(interval '10 minutes', ts) + interval '10 minutes' as window_end,
       count(*) as n, min(ts) as first_ts, max(ts) as last_ts
from events group by all""",
    "window_summary_lines": """
select concat_ws(',', coalesce(event_type, ''), cast(count(*) as varchar), strftime(min(ts), '%Y-%m-%d %H:%M:%S.%g'),
                 strftime(max(ts), '%Y-%m-%d %H:%M:%S.%g'),
                 strftime(time_bucket(interval '10 minutes', ts), '%Y-%m-%d %H:%M:%S.%g'),
                 strftime(time_bucket(interval '10 minutes', ts) + interval '10 minutes', '%Y-%m-%d %H:%M:%S.%g')) as line
from events group by event_type, time_bucket(interval '10 minutes', ts)""",
    "count_trigger_running": """
with r as (
  select event_type, event_id,
         row_number() over w as rn,
         sum(cast(value as decimal(18,2))) over w as run
  from events
  window w as (partition by event_type order by ts, event_id
               rows between unbounded preceding and current row))
select event_type, rn // 2 as fire_no, rn as n, cast(run as double) as total,
       event_id as fired_at
from r where rn % 2 = 0""",
    "count_trigger_purged": """
with r as (
  select event_type, event_id, value,
         row_number() over (partition by event_type order by ts, event_id) as rn
  from events)
select event_type, (rn - 1) // 2 as batch_no, count(*) as n,
       cast(sum(cast(value as decimal(18,2))) as double) as total,
       arg_min(event_id, rn) as first_id, arg_max(event_id, rn) as fired_at
from r group by all having count(*) = 2""",
    "top_speed": """
with recursive e as (
  select user_id, event_id, ts, value,
         sum(cast(value as decimal(18,2))) over (partition by user_id order by ts, event_id
                                                 rows unbounded preceding) as cum,
         row_number() over (partition by user_id order by ts, event_id) as rn
  from events),
f as (
  select user_id, rn, cum as base, false as fired, event_id from e where rn = 1
  union all
  select e.user_id, e.rn,
         case when e.cum - f.base > 50 then e.cum else f.base end,
         e.cum - f.base > 50, e.event_id
  from f join e on e.user_id = f.user_id and e.rn = f.rn + 1),
t as (
  select *, max(struct_pack(v := value, n := -epoch_us(ts), i := -event_id)) over (
           partition by user_id order by ts
           range between interval '86399999999 microseconds' preceding and current row) as b
  from e)
select f.user_id, f.event_id, t.b.v as top, -t.b.i as top_id,
       make_timestamp(-t.b.n) as top_ts
from f join t using (user_id, event_id) where fired""",
    "top_speed_free": """
with recursive e as (
  select event_type, event_id, ts, value,
         sum(cast(case when event_id % 3 = 0 then -value else value end as decimal(18,2))) over (partition by event_type order by ts, event_id
                                                 rows unbounded preceding) as cum,
         row_number() over (partition by event_type order by ts, event_id) as rn
  from events),
f as (
  select event_type, rn, cum as base, false as fired, event_id from e where rn = 1
  union all
  select e.event_type, e.rn,
         case when e.cum - f.base > 50 then e.cum else f.base end,
         e.cum - f.base > 50, e.event_id
  from f join e on e.event_type = f.event_type and e.rn = f.rn + 1),
t as (
  select *, max(struct_pack(v := value, n := -epoch_us(ts), i := -event_id)) over (
           partition by event_type order by ts
           range between interval '86399999999 microseconds' preceding and current row) as b
  from e)
select f.event_type, f.event_id, t.b.v as top, -t.b.i as top_id,
       make_timestamp(-t.b.n) as top_ts
from f join t using (event_type, event_id) where fired""",
    "late_status": _LATE + "select event_id, event_type, window_start, status from s",
    "late_status_counts": _LATE + "select status, count(*) as n from s group by status",
    "lateness_firings": _LATE + """
, k as (select * from s where status <> 'dropped'),
o as (
  select event_type, window_start, window_end, count(*) as on_n, min(ts) as on_min,
         max(ts) as on_max
  from k where status = 'on_time' group by all),
l as (
  select event_type, window_start, window_end,
         count(*) over w as ln, min(ts) over w as lmin, max(ts) over w as lmax
  from k where status = 'late'
  window w as (partition by event_type, window_start, window_end order by arrival, event_id
               rows between unbounded preceding and current row))
select event_type, window_start, window_end, 'on_time' as kind, cast(0 as bigint) as fire_no,
       on_n as n, on_min as first_ts, on_max as last_ts
from o
union all
select l.event_type, l.window_start, l.window_end, 'late', l.ln,
       coalesce(o.on_n, 0) + l.ln, least(o.on_min, l.lmin), greatest(o.on_max, l.lmax)
from l left join o using (event_type, window_start, window_end)""",
    "window_summary_with_lateness": _LATE + """
, g as (
  select event_type, window_start, window_end, count(*) as n, min(ts) as first_ts,
         max(ts) as last_ts
  from s where status <> 'dropped' group by all)
select *, concat_ws(',', event_type, cast(n as varchar),
                    strftime(first_ts, '%Y-%m-%d %H:%M:%S.%g'),
                    strftime(last_ts, '%Y-%m-%d %H:%M:%S.%g'),
                    strftime(window_start, '%Y-%m-%d %H:%M:%S.%g'),
                    strftime(window_end, '%Y-%m-%d %H:%M:%S.%g')) as line
from g""",
    "keyword_mask": """
select l.event_id,
       '下游接收的消息为：' || replace(l.props, coalesce(r.kw, '7'), '***') as masked
from (select * from events where event_type <> 'signup') l
asof left join (select ts, arg_max(json_extract_string(props, '$.k'), event_id) as kw
                from events where event_type = 'signup' group by ts) r
on l.ts >= r.ts""",
    "user_table_function": """
select user_id, event_id, epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id order by ts, event_id) as gap_us
from events where ts is not null""",
    "user_aggregate": """
select event_type, cast(sum(cast(round(value * 100) as bigint)) as double) / 100 / nullif(count(value), 0) as mean_value
from events group by event_type""",
    **IO_ORACLE,
}


# Streaming twins: the batch SQL of the same operator.
ORACLE["stream_window_counts"] = """
select event_type, time_bucket(interval '10 minutes', ts) as window_start,
       time_bucket(interval '10 minutes', ts) + interval '10 minutes' as window_end,
       count(*) as count
from events group by all"""
ORACLE["stream_hot_items"] = ORACLE["hot_items"]
ORACLE["stream_sessions"] = ORACLE["session_sum"]
ORACLE["stream_count_trigger"] = """
with r as (
  select event_type, event_id,
         row_number() over w as rn,
         sum(cast(value as decimal(18,2))) over w as run
  from events
  window w as (partition by event_type order by ts, event_id
               rows between unbounded preceding and current row))
select event_type, rn as n, cast(run as double) as total, event_id as fired_at
from r where rn % 2 = 0"""
ORACLE["stream_count_trigger_purged"] = """
with r as (
  select event_type, event_id, value,
         row_number() over (partition by event_type order by ts, event_id) as rn
  from events)
select event_type, count(*) as n, cast(sum(cast(value as decimal(18,2))) as double) as total,
       arg_max(event_id, rn) as fired_at
from r group by event_type, (rn - 1) // 2 having count(*) = 2"""
ORACLE["stream_keyword_mask"] = ORACLE["keyword_mask"]
ORACLE["stream_tumbling_word_count"] = ORACLE["tumbling_word_count"]
ORACLE["stream_side_output_main"] = ORACLE["side_output_main"]
ORACLE["stream_side_output_rejected"] = ORACLE["side_output_rejected"]

ORACLE["stream_split_all"] = ORACLE["split_all"]
ORACLE["stream_connect"] = ORACLE["connect_comap"]


def _late_stream(delay_hours: int) -> str:
    """Rows that a stream in eight micro-batches keeps: a batch drops a row whose window ended
    ``delay_hours`` before the largest event time of the batches up to the second before it."""
    return f"""
with z as (select max(event_id) + 1 as total, (max(event_id) + 1) * 3 // 8 as hop from events),
a as (
  select event_type, epoch_us(ts) // 1000 as ms,
         (event_id + case when event_id % 13 = 0 then hop else 0 end) * 8 // (total + hop) as batch
  from events, z),
m as (select batch, max(ms) as top from a group by batch),
w as (
  select batch, max(top) over (order by batch rows between unbounded preceding and 2 preceding)
                - {delay_hours} * 3600000 as wm
  from m),
k as (
  select a.*, make_timestamp(ms // 3600000 * 3600000000) as window_start,
         make_timestamp((ms // 3600000 + 1) * 3600000000) as window_end
  from a join w using (batch)
  where wm is null or (ms // 3600000 + 1) * 3600000 > wm)
"""


ORACLE["stream_late_drop"] = _late_stream(2) + """
select event_type, window_start, window_end, count(*) as count from k group by all"""
ORACLE["stream_window_summary_late"] = _late_stream(26) + """
select event_type, window_start, window_end, count(*) as n, make_timestamp(min(ms) * 1000) as first_ts,
       make_timestamp(max(ms) * 1000) as last_ts, count(distinct batch) as firings
from k group by event_type, window_start, window_end"""

ORACLE["stream_top_speed"] = ORACLE["top_speed"]
ORACLE["source_custom_stream"] = "select event_id, event_type, ts, value from events"
ORACLE["stream_arrival_windows"] = "select event_type, count(*) as n from events group by event_type"
ORACLE["stream_rule_updates"] = ORACLE["keyword_mask"]
# The clock of a micro-batch is the largest event time of those before it, less the delay of two hours.
ORACLE["stream_lateness_firings"] = """
with z as (select max(event_id) + 1 as total, (max(event_id) + 1) * 3 // 8 as hop from events),
a as (
  select event_type, event_id, epoch_us(ts) // 1000 as ms,
         greatest(0, coalesce((event_id + case when event_id % 13 = 0 then hop else 0 end) * 8 // (total + hop), 0)) as batch
  from events, z),
m as (select batch, max(ms) as top from a group by batch),
c as (
  select batch, max(top) over (order by batch rows between unbounded preceding and 1 preceding) - 2 * 3600000 as clock
  from m),
s as (
  select a.*, ms // 3600000 * 3600000 as start,
         case when clock is null or ms // 3600000 * 3600000 + 3599999 > clock then 'on_time'
              when ms // 3600000 * 3600000 + 3599999 + 24 * 3600000 > clock then 'late' else 'dropped' end as kind
  from a join c using (batch)),
o as (
  select event_type, start, count(*) as n, min(ms) as low, max(ms) as high from s where kind = 'on_time' group by all),
l as (
  select event_type, start, event_id, count(*) over w as n, min(ms) over w as low, max(ms) over w as high
  from s where kind = 'late'
  window w as (partition by event_type, start order by batch, event_id rows unbounded preceding)),
f as (
  select event_type, start, 'on_time' as kind, n, low, high, cast(null as bigint) as event_id from o
  union all
  select l.event_type, l.start, 'late', coalesce(o.n, 0) + l.n, least(l.low, coalesce(o.low, l.low)),
         greatest(l.high, coalesce(o.high, l.high)), l.event_id
  from l left join o using (event_type, start))
select event_type, make_timestamp(start * 1000) as window_start, make_timestamp((start + 3600000) * 1000) as window_end,
       kind, n, make_timestamp(low * 1000) as first_ts, make_timestamp(high * 1000) as last_ts, event_id
from f"""

# The same operators with their hot-key plan (``queries.CHUNKED``).
for _name in ("count_trigger_running", "count_trigger_purged", "session_sum", "top_speed", "top_speed_free",
              "late_status", "lateness_firings", "window_summary_with_lateness", "keyword_mask",
              "user_table_function"):
    ORACLE[f"{_name}_chunked"] = ORACLE[_name]
