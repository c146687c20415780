"""Registered queries of the file sources and sinks.

Each writes a given table in full to a folder of its own under the shared
checkpoint folder with a library sink and returns what a library reader makes
of it, so sink and source are held to the same oracle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import format_tuple
from ..functions.time import to_epoch_millis, to_epoch_seconds
from ..operators.routing import even_odd_selector, select_tags, tag_rows
from ..operators.windows import grouped_sum
from ..session import checkpoint_path
from ..sinks import fan_out, write_delimited, write_text
from ..sources.files import (read_car_text, read_car_text_tolerant, read_key_millis, read_lines, read_or_default,
                             read_user_behavior)
from ..sources.inline import from_elements, sequence
from ..sources.tables import load

CATEGORIES = 10  # stand-in for the CSV's category: the item id modulo this
HOUR_S = 3600


def _folder(spark: SparkSession, name: str) -> str:
    return checkpoint_path(spark, f"io/{name}-{uuid.uuid4().hex[:8]}")


def _lines_of_documents(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "lines")
    write_text(load(spark, sf, "documents").select(F.col("text").alias("value")), path)
    return read_lines(spark, path)


def source_lines(spark, sf):
    """Whole texts written as a text file, read line by line, counted."""
    return grouped_sum(_lines_of_documents(spark, sf), ["value"], alias="n")


def source_user_behavior(spark, sf):
    """The events as the five-field CSV."""
    item = F.get_json_object("props", "$.k").cast("bigint")
    path = _folder(spark, "behavior")
    write_delimited(load(spark, sf, "events").select(
        "user_id", item.alias("item"), (item % CATEGORIES).alias("category"), "event_type",
        to_epoch_seconds("ts").alias("s")), path, ",")
    return read_user_behavior(spark, path)


def source_key_millis(spark, sf):
    """``type,millis`` lines of the events, with the event time they name."""
    path = _folder(spark, "key-millis")
    write_delimited(load(spark, sf, "events").select(
        "event_type", to_epoch_millis("ts").alias("ms")), path, ",")
    return read_key_millis(spark, path)


def source_car_text(spark, sf):
    """Line items as ``(id,speed,distance,ts)`` lines; the path given wins over
    the default rows."""
    path = _folder(spark, "cars")
    write_text(load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", to_epoch_millis("l_shipdate").alias("ms")), path)
    return read_or_default(spark, read_car_text, path, lambda: read_car_text(spark, path).limit(0))


def source_rejects(spark, sf):
    """F8: line items as tuple lines, some broken: typed rows beside the lines that do not parse."""
    path = _folder(spark, "broken")
    key, price = F.col("l_orderkey"), F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    ms = to_epoch_millis("l_shipdate")
    line = (F.when(key % 7 == 0, format_tuple(key, "l_linenumber", F.lit("x"), ms))
            .when(key % 11 == 0, format_tuple(key, "l_linenumber", price))
            .otherwise(format_tuple(key, "l_linenumber", price, ms)))
    load(spark, sf, "lineitem").select(line.alias("value")).write.text(path)
    rows, rejects = read_car_text_tolerant(spark, path)
    return rows.unionByName(rejects.select(F.col("value").alias("line")), allowMissingColumns=True)


def source_elements(spark, sf):
    """Events counted for each element of an inline collection, none included."""
    wanted = from_elements(spark, ["view", "signup", "no such type"], "event_type string")
    counts = grouped_sum(load(spark, sf, "events").select("event_type"), ["event_type"], alias="n")
    return wanted.join(counts, "event_type", "left").select("event_type", F.coalesce("n", F.lit(0)).alias("n"))


def source_sequence(spark, sf):
    """S3: every hour from the first event to the last with its number of events."""
    hour = F.floor(to_epoch_seconds("ts") / HOUR_S).cast("bigint")
    counts = grouped_sum(load(spark, sf, "events").where("ts is not null").select(hour.alias("hour")),
                         ["hour"], alias="n")
    ends = counts.agg(F.min("hour").alias("low"), F.max("hour").alias("high")).first()
    hours = sequence(spark, ends["low"] or 0, -1 if ends["high"] is None else ends["high"], "hour")
    return hours.join(counts, "hour", "left").select("hour", F.coalesce("n", F.lit(0)).alias("n"))


def sink_delimited(spark, sf):
    """K1: lines of the texts (spaces and empty lines among them) with their counts, and a
    field that is null for lines that stand once."""
    path = _folder(spark, "delimited")
    n = F.col("n")
    write_delimited(grouped_sum(_lines_of_documents(spark, sf), ["value"], alias="n").select(
        "value", n, F.when(n > 1, n).alias("again")), path)
    return read_lines(spark, path)


def sink_tuple_text(spark, sf):
    """K2: documents as tuple lines, with null and empty fields."""
    path = _folder(spark, "tuples")
    lang = F.col("lang")
    write_text(load(spark, sf, "documents").select(
        "doc_id", F.when(lang != "en", lang).alias("other"),
        F.when(lang == "en", F.lit("")).otherwise(F.col("source")).alias("origin")), path)
    return read_lines(spark, path)


def fan_out_files(spark, sf):
    """K4: one pass over the orders, an output folder for each tag."""
    tagged = tag_rows(load(spark, sf, "orders").select("o_orderkey"), even_odd_selector("o_orderkey"))
    paths = {tag: _folder(spark, f"fan-{tag}") for tag in ("even", "odd")}

    def branch(tag):
        return lambda d: select_tags(d, tag).select(F.col("o_orderkey").cast("string").alias("value"))

    fan_out(tagged, {t: branch(t) for t in paths},
            {t: (lambda d, p=p: write_text(d, p)) for t, p in paths.items()})
    parts = [read_lines(spark, p).select(F.lit(t).alias("branch"), "value") for t, p in paths.items()]
    return parts[0].unionByName(parts[1])


IO_QUERIES = {f.__name__: f for f in (
    source_lines, source_user_behavior, source_key_millis, source_car_text, source_rejects, source_elements,
    source_sequence, sink_delimited, sink_tuple_text, fan_out_files)}

_LINES = ("(select regexp_replace(unnest(string_split(coalesce(text, ''), chr(10))), '\\r\\z', '') "
          "as value from documents)")

IO_ORACLE = {
    "source_lines": f"select value, count(*) as n from {_LINES} group by value",
    "source_user_behavior": """
select user_id as "userId", cast(json_extract_string(props, '$.k') as bigint) as "itemId",
       cast(cast(json_extract_string(props, '$.k') as bigint) % 10 as integer) as "categoryId",
       event_type as behavior, epoch_us(ts) // 1000000 as timestamp
from events""",
    "source_key_millis": """
select event_type as key, epoch_us(ts) // 1000 as ts_ms, make_timestamp(epoch_us(ts) // 1000 * 1000) as ts from events""",
    "source_car_text": """
select cast(l_orderkey as integer) as car_id, cast(l_linenumber as integer) as speed,
       l_extendedprice as distance, epoch_ms(l_shipdate) as ts
from lineitem""",
    "source_rejects": """
with l as (
  select l_orderkey as k, l_linenumber as n, cast(l_extendedprice as decimal(18,2)) as p, epoch_ms(l_shipdate) as ms,
         l_orderkey % 7 = 0 or l_orderkey % 11 = 0 as broken
  from lineitem)
select case when not broken then cast(k as integer) end as car_id, case when not broken then cast(n as integer) end as speed,
       case when not broken then cast(p as double) end as distance, case when not broken then ms end as ts,
       case when k % 7 = 0 then '(' || k || ',' || n || ',x,' || ms || ')'
            when k % 11 = 0 then '(' || k || ',' || n || ',' || p || ')' end as line
from l""",
    "source_elements": """
select w.event_type, count(e.event_type) as n
from (values ('view'), ('signup'), ('no such type')) w(event_type) left join events e using (event_type)
group by w.event_type""",
    "source_sequence": """
with c as (select epoch_us(ts) // 3600000000 as hour, count(*) as n from events where ts is not null group by 1),
h as (select unnest(generate_series(min(hour), max(hour))) as hour from c)
select hour, coalesce(n, 0) as n from h left join c using (hour)""",
    "sink_delimited": f"""
with c as (select value, count(*) as n from {_LINES} group by value)
select value || ' ' || n || ' ' || case when n > 1 then cast(n as varchar) else '' end as value from c""",
    "sink_tuple_text": """
select '(' || doc_id || ',' || case when lang <> 'en' then lang else 'null' end || ','
       || case when lang = 'en' then '' else coalesce(source, 'null') end || ')' as value
from documents""",
    "fan_out_files": """
select case when o_orderkey % 2 = 0 then 'even' else 'odd' end as branch,
       cast(o_orderkey as varchar) as value
from orders""",
}
