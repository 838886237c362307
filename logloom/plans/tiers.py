"""Tiers and upkeep: upsert, hot, cold, journal, retention, rotation."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from ..functions.text import size_in_bytes
from ..functions.time import as_datetime, moment
from ..operators import joins
from ..operators.latest import upsert
from ..operators.paging import numbered_pages
from ..operators.stats import count_by
from ..session import settle, shared_dir
from ..sinks import compaction, rotation, tiers, warm
from .catalog import query
from .inputs import AS_OF, LOG_EVENTS_SQL, events, log_events, with_metadata

_EVENT = ["id", "level", "message", "timestamp"]
#: Rows of a page where the whole log is walked; the number of pages grows with the log.
_PAGE_SIZE = 500
#: Batches of a table that is merged.
_BATCHES = 20


def _versions(spark, sf_dir):
    """A stored table, and a batch that brings every event twice more, some newer and some older than stored."""
    rows = log_events(spark, sf_dir).select("id", "level", "timestamp")

    def moved(every: int, hours: int):
        step = F.expr(f"interval '{hours}' hour")
        return F.when(F.col("id") % every == 0, F.col("timestamp") + step).otherwise(F.col("timestamp") - step)

    stored = rows.withColumn("processed_at", F.col("timestamp"))
    again = rows.select("id", F.lower("level").alias("level"), "timestamp", moved(2, 24).alias("processed_at"))
    twice = rows.select(
        "id", F.concat(F.lower("level"), F.lit("!")).alias("level"), "timestamp", moved(10, 25).alias("processed_at"))
    return stored, again.unionByName(twice)


_UPSERT_SQL = f"""with {LOG_EVENTS_SQL},
    written as (
      select id, level, "timestamp", "timestamp" as processed_at from log_events
      union all select id, lower(level), "timestamp",
        case when id % 2 = 0 then "timestamp" + interval 1 day else "timestamp" - interval 1 day end from log_events
      union all select id, lower(level) || '!', "timestamp",
        case when id % 10 = 0 then "timestamp" + interval 25 hour else "timestamp" - interval 25 hour end
        from log_events),
    ranked as (select *, row_number() over (partition by id order by processed_at desc) as rn from written)
    select id, level, "timestamp", processed_at from ranked where rn = 1"""


@query("upsert_latest", "K7 W1", _UPSERT_SQL)
def upsert_latest(spark, sf_dir):
    stored, batch = _versions(spark, sf_dir)
    return upsert(stored, batch)


@query("upsert_twice", "K7 T6", _UPSERT_SQL)
def upsert_twice(spark, sf_dir):
    stored, batch = _versions(spark, sf_dir)
    return upsert(upsert(stored, batch), batch)


def _live(spark, sf_dir):
    """Several events per trace, so that the last write shows."""
    return log_events(spark, sf_dir).withColumn(
        "trace_id", F.md5(F.concat(F.lit("s"), F.floor(F.col("id") / 3).cast("string"))))


_LIVE_SQL = f"""with {LOG_EVENTS_SQL},
    live as (select id, level, message, "timestamp",
        md5(concat('s', cast(cast(floor(id / 3.0) as bigint) as varchar))) as trace_id
      from log_events where "timestamp" > timestamp '{AS_OF}' - interval 24 hour),
    ranked as (select *, row_number() over (partition by trace_id order by "timestamp" desc, id desc) as rn from live)"""


@query("hot_tier", "K10 W1 T7", f"""{_LIVE_SQL}
    select trace_id, "timestamp", concat('{{"trace_id":"', trace_id, '","id":', cast(id as varchar), ',"level":"', level,
      '","message":"', message, '"}}') as document from ranked where rn = 1""")
def hot_tier(spark, sf_dir):
    rows = tiers.hot_rows(_live(spark, sf_dir), AS_OF)
    shown = F.from_json("document", "trace_id string, id bigint, level string, message string")
    return rows.select("trace_id", "timestamp", F.to_json(shown).alias("document"))


@query("cold_tier", "K11 F14 E3 E8", f"""with {LOG_EVENTS_SQL}
    select id, lower(level) as level, message, "timestamp", cast("timestamp" as date) as date,
      concat(lower(level), '-', strftime("timestamp", '%Y-%m-%d'), '.log') as file_name
    from log_events where level in ('ERROR', 'WARN') or "timestamp" < timestamp '{AS_OF}' - interval 7 day""")
def cold_tier(spark, sf_dir):
    return tiers.cold_rows(log_events(spark, sf_dir).select(*_EVENT), AS_OF)


@query("tier_routing", "K12", f"""with {LOG_EVENTS_SQL}
    select true as warm, "timestamp" > timestamp '{AS_OF}' - interval 24 hour as hot,
      level in ('ERROR', 'WARN') or "timestamp" < timestamp '{AS_OF}' - interval 7 day as cold, count(*) as count
    from log_events group by 1, 2, 3""")
def tier_routing(spark, sf_dir):
    return count_by(tiers.tier_flags(log_events(spark, sf_dir), AS_OF), "warm", "hot", "cold")


@query("journal", "K15 E3", f"""
    select '{AS_OF[:10]}' as date, '{AS_OF[11:13]}' as hour, 'wal-{AS_OF[:10]}-{AS_OF[11:13]}.log' as file_name,
      concat('{{"id":', cast(event_id as varchar), ',"kind":"', event_type, '"}}') as value from events""")
def journal(spark, sf_dir):
    rows = events(spark, sf_dir).select(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))
    return tiers.journal_rows(rows, AS_OF)


@query("retention", "K17", f"""with {LOG_EVENTS_SQL}
    select id, level, message, "timestamp" from log_events
    where "timestamp" >= timestamp '{AS_OF}' - interval 10 day""")
def retention(spark, sf_dir):
    return warm.retained(log_events(spark, sf_dir).select(*_EVENT), AS_OF, days=10)


@query("retention_count", "K17", f"""
    select count(*) as deleted from events where ts < timestamp '{AS_OF}' - interval 10 day""")
def retention_count(spark, sf_dir):
    return warm.expired(log_events(spark, sf_dir), AS_OF, days=10).agg(F.count(F.lit(1)).alias("deleted"))


@query("rotation_plan", "K16 E8 E9", f"""with {LOG_EVENTS_SQL},
    files as (select concat(lower(level), '-', strftime("timestamp", '%Y-%m-%d'), '.log') as file_name,
        cast(sum(length(message)) as bigint) as file_size, max("timestamp") as modified from log_events group by 1)
    select file_name, file_size, modified, case when file_size > 1024 then 'size' else 'age' end as reason,
      replace(file_name, '.log', '-20240130-000000.log.gz') as rotated_name
    from files where file_size > 1024 or modified < timestamp '{AS_OF}' - interval 24 hour""")
def rotation_plan(spark, sf_dir):
    rows = log_events(spark, sf_dir).withColumn("file_name", F.concat(
        F.lower("level"), F.lit("-"), F.date_format("timestamp", "yyyy-MM-dd"), F.lit(".log")))
    files = rows.groupBy("file_name").agg(
        F.sum(F.length("message")).alias("file_size"), F.max("timestamp").alias("modified"))
    return rotation.rotation_plan(files, AS_OF, max_size="1KB")


@query("size_strings", "E9", """
    select event_id, case event_id % 4 when 0 then event_id when 1 then event_id * 1024
      when 2 then event_id * 1048576 else event_id * 1073741824 end as bytes from events""")
def size_strings(spark, sf_dir):
    unit = F.element_at(F.array(*map(F.lit, ["", "KB", "MB", "GB"])), (F.col("event_id") % 4 + 1).cast("int"))
    text = F.concat(F.col("event_id").cast("string"), unit)
    return events(spark, sf_dir).select("event_id", size_in_bytes(text).alias("bytes"))


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/logloom-runs/{uuid.uuid4().hex}"


def _shared_traces(spark, sf_dir):
    """Three events per trace id, in the order of their ids."""
    return log_events(spark, sf_dir).select(
        "id", "level", "message", "timestamp", F.md5(F.concat(F.lit("s"), F.floor(F.col("id") / 3).cast("string"))).alias("trace_id"))


@query("rotate_cold", "K16 K11", f"""with {LOG_EVENTS_SQL},
    cold as (select id, lower(level) as level, cast("timestamp" as date) as day from log_events
      where level in ('ERROR', 'WARN') or "timestamp" < timestamp '{AS_OF}' - interval 7 day),
    moved as (select id, level, day, true as rotated from cold union all select id, level, day, true from cold where id % 10 = 0
      union all select id, level, day, false from cold where id % 7 = 0)
    select level, cast(day as varchar) as day, rotated, count(*) as lines, cast(sum(id) as bigint) as ids from moved group by 1, 2, 3""")
def rotate_cold(spark, sf_dir):
    """Rotated, appended to, rotated again at the same time and appended to again: archive and rest hold every line once."""
    base, rows = _folder(spark), log_events(spark, sf_dir).select(*_EVENT)
    for number, part in enumerate((rows, rows.filter("id % 10 = 0"))):
        tiers.append_cold(part, f"{base}/cold", AS_OF, number)
        rotation.rotate(spark, f"{base}/cold", f"{base}/archive", AS_OF, max_size=0)
    tiers.append_cold(rows.filter("id % 7 = 0"), f"{base}/cold", AS_OF, 2)
    lines = [spark.read.text(f"{base}/{name}").select("value", "level", "date", F.lit(name == "archive").alias("rotated")) for name in ("cold", "archive")]
    found = lines[0].unionByName(lines[1]).withColumn("id", F.get_json_object("value", "$.id").cast("bigint"))
    return found.groupBy("level", F.col("date").cast("string").alias("day"), "rotated").agg(
        F.count("*").alias("lines"), F.sum("id").alias("ids"))


@query("upsert_table", "K7 W1", f"""with {LOG_EVENTS_SQL},
    written as (select id, level, "timestamp", 0 as write from log_events
      union all select id, lower(level), case when id % 4 = 0 then "timestamp" + interval 1 day else "timestamp" end, 1 from log_events where id % 2 = 0
      union all select id, 'old', "timestamp", -1 from log_events where id % 3 = 0),
    ranked as (select *, row_number() over (partition by id order by write desc) as rn from written)
    select id, level, "timestamp", 'stored' as kind from ranked where rn = 1
    union all select null, level, null, 'rejected' from log_events where id % 50 = 0""")
def upsert_table(spark, sf_dir):
    """A table appended in two batches, then overlaid twice by rows of one version, some on another day, some without id."""
    base = _folder(spark)
    rows = log_events(spark, sf_dir).select("id", "level", "timestamp", moment(AS_OF).alias("processed_at"), F.lit(0).alias("write"))
    for number in (0, 1):
        warm.append_events(rows.filter(F.col("id") % 2 == number), f"{base}/warm", number)
    day = F.expr("interval 1 day")
    changed = rows.filter("id % 2 = 0").withColumns({
        "level": F.lower("level"), "write": F.lit(1),
        "timestamp": F.when(F.col("id") % 4 == 0, F.col("timestamp") + day).otherwise(F.col("timestamp"))})
    late = rows.filter("id % 3 = 0").withColumns({"level": F.lit("old"), "write": F.lit(-1)})
    nameless = rows.filter("id % 50 = 0").withColumn("id", F.lit(None).cast("bigint"))
    warm.upsert_events(changed.unionByName(late).unionByName(nameless), f"{base}/warm", arrival="write", rejects=f"{base}/dead")
    warm.upsert_events(changed, f"{base}/warm", arrival="write")
    stored = spark.read.parquet(f"{base}/warm").select("id", "level", "timestamp", F.lit("stored").alias("kind"))
    dead = spark.read.schema("raw_log string").json(f"{base}/dead")
    return stored.unionByName(dead.select(
        F.lit(None).cast("bigint").alias("id"), F.get_json_object("raw_log", "$.level").alias("level"),
        F.lit(None).cast("timestamp_ntz").alias("timestamp"), F.lit("rejected").alias("kind")))


@query("hot_table", "K10 J2", f"""with {LOG_EVENTS_SQL},
    live as (select id, id % 3 as batch, md5(concat('s', cast(id // 3 as varchar))) as trace_id, "timestamp" from log_events
      where "timestamp" > timestamp '{AS_OF}' - interval 24 hour),
    ranked as (select *, row_number() over (partition by trace_id order by batch) as rn from live)
    select trace_id, id, "timestamp" from ranked where rn = 1""")
def hot_table(spark, sf_dir):
    """Three batches, the first of which is written last: it wins although its events are not the newest."""
    base, rows = _folder(spark), _shared_traces(spark, sf_dir)
    for number in (2, 1, 0):
        tiers.store_batch(rows.filter(F.col("id") % 3 == number), base, AS_OF, 2 - number)
    hot = tiers.read_hot(spark, f"{base}/hot", AS_OF)
    return hot.select("trace_id", F.get_json_object("document", "$.id").cast("bigint").alias("id"), "timestamp")


@query("lookup_copies", "J2 F13", f"""with {LOG_EVENTS_SQL},
    shared as (select id, level, message, "timestamp", md5(concat('s', cast(id // 3 as varchar))) as trace_id from log_events),
    newest as (select *, row_number() over (partition by trace_id order by "timestamp" desc, id desc) as rn, count(*) over (partition by trace_id) as copies from shared)
    select trace_id, id, copies, case when "timestamp" > timestamp '{AS_OF}' - interval 24 hour then 'hot' else 'warm' end as tier from newest where rn = 1""")
def lookup_copies(spark, sf_dir):
    rows = _shared_traces(spark, sf_dir)
    found = joins.lookup_hot_then_warm(rows.select("trace_id"), joins.hot_view(rows, AS_OF), rows)
    return found.select("trace_id", "id", "copies", "tier")


@query("retention_table", "K17 K8", f"""with {LOG_EVENTS_SQL}
    select id, "timestamp" from log_events where "timestamp" >= timestamp '{AS_OF}' - interval 255 hour""")
def retention_table(spark, sf_dir):
    """A table in two batches after retention, the edge day cut at the hour."""
    base = _folder(spark)
    rows = log_events(spark, sf_dir).select(*_EVENT)
    for number in (0, 1):
        warm.append_events(rows.filter(F.col("id") % 2 == number), f"{base}/warm", number)
    warm.apply_retention(spark, f"{base}/warm", as_datetime(AS_OF) - timedelta(hours=15), days=10)
    return spark.read.parquet(f"{base}/warm").select("id", "timestamp")


@query("metadata_table", "K9 K17 K18", f"""with {LOG_EVENTS_SQL}
    select id as log_event_id, m.key, m.value from log_events,
      lateral (select 'user_id' as key, cast(user_id as varchar) as value union all select 'k', json_extract_string(props, '$.k')) as m
    where "timestamp" >= timestamp '{AS_OF}' - interval 255 hour""")
def metadata_table(spark, sf_dir):
    """Metadata rows stored beside their events, after retention of both."""
    base, rows = _folder(spark), with_metadata(spark, sf_dir).select("id", "timestamp", "metadata")
    warm.append_events(rows.drop("metadata"), f"{base}/warm")
    for number in (0, 1):
        warm.append_metadata(rows.filter(F.col("id") % 2 == number), f"{base}/metadata", number)
    warm.apply_retention(spark, f"{base}/warm", as_datetime(AS_OF) - timedelta(hours=15), days=10, children=f"{base}/metadata")
    return spark.read.parquet(f"{base}/metadata").select("log_event_id", "key", "value")


@query("journal_table", "K15", f"""
    select event_id as id, event_type as kind from events""")
def journal_table(spark, sf_dir):
    """The journal as written in two batches, the second one twice, and read back."""
    base = _folder(spark)
    rows = events(spark, sf_dir).select(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))
    for number in (0, 1, 1):
        tiers.append_journal(rows.filter(F.col("id") % 2 == number), f"{base}/journal", AS_OF, number)
    found = spark.read.text(f"{base}/journal").select(F.from_json("value", "id bigint, kind string").alias("line"))
    return found.select("line.id", "line.kind")


def _halved_levels(spark, sf_dir):
    """The log with a level that half of the rows lack."""
    return log_events(spark, sf_dir).select(
        "id", "organization_id", F.when(F.col("id") % 2 == 0, F.col("level")).alias("level"))


@query("pages_walked", "O1 O2", f"""with {LOG_EVENTS_SQL},
    thin as (select id, case when id % 2 = 0 then level end as level from log_events),
    placed as (select id, level, row_number() over (order by level nulls first, id) - 1 as place from thin)
    select cast(place // {_PAGE_SIZE} as bigint) as page, count(*) as rows, cast(sum(id) as bigint) as ids, min(level) as first_level, max(level) as last_level
    from placed group by 1""")
def pages_walked(spark, sf_dir):
    """Every page of the whole log by a column with nulls."""
    pages = numbered_pages(_halved_levels(spark, sf_dir), _PAGE_SIZE, "level", "asc")
    return pages.groupBy("page").agg(F.count("*").alias("rows"), F.sum("id").alias("ids"),
                                     F.min("level").alias("first_level"), F.max("level").alias("last_level"))


@query("pages_walked_all", "O1 O2", f"""with {LOG_EVENTS_SQL},
    thin as (select id, organization_id, case when id % 2 = 0 then level end as level from log_events)
    select organization_id, level, cast(count(*) as bigint) as rows, cast(sum(id) as bigint) as ids from thin group by 1, 2""")
def pages_walked_all(spark, sf_dir):
    """The rows of all pages together are those of the log, each once."""
    pages = numbered_pages(_halved_levels(spark, sf_dir), _PAGE_SIZE, "level", "desc")
    return pages.groupBy("organization_id", "level").agg(F.count("*").alias("rows"), F.sum("id").alias("ids"))


@query("compact_table", "K7 K8 K17 T6", f"""with {LOG_EVENTS_SQL}
    select id, case when id % 5 = 0 then lower(level) else level end as level, "timestamp", 1 as folders_of_day
    from log_events where "timestamp" >= timestamp '{AS_OF}' - interval 255 hour""")
def compact_table(spark, sf_dir):
    """A table in twenty batches: a merge that breaks off, rows read meanwhile, a merge of everything, then upsert and retention."""
    path = f"{_folder(spark)}/warm"
    rows = log_events(spark, sf_dir).select("id", "level", "timestamp", F.lit(0).alias("write"))
    for number in range(_BATCHES):
        warm.append_events(rows.filter(F.col("id") % _BATCHES == number), path, number)
    compaction.copy_folders(spark, path, _BATCHES // 2, ["date"], "parquet", ["timestamp"], None, 2)
    half = settle(compaction.stored(spark, path).drop("batch", "date", "epoch_s"))
    warm.append_events(rows.filter("id % 5 = 0"), path, _BATCHES)  # once more, to be overlaid below
    compaction.compact_warm(spark, path, _BATCHES + 1)
    warm.upsert_events(half.filter("id % 5 = 0").withColumns({"level": F.lower("level"), "write": F.lit(1)}), path, version="write")
    warm.apply_retention(spark, path, as_datetime(AS_OF) - timedelta(hours=15), days=10)
    found = compaction.stored(spark, path)
    folders = found.groupBy("date").agg(F.count_distinct("batch").cast("int").alias("folders_of_day"))
    return found.join(folders, found["date"].eqNullSafe(folders["date"])).select("id", "level", "timestamp", "folders_of_day")


@query("compact_hot_cold", "K10 K11", f"""with {LOG_EVENTS_SQL},
    shared as (select *, md5(concat('s', cast(id // 3 as varchar))) as trace from log_events),
    live as (select trace, id, row_number() over (partition by trace order by id % 3 desc) as rn from shared
      where "timestamp" > timestamp '{AS_OF}' - interval 24 hour),
    cold as (select lower(level) as level, id from shared where level in ('ERROR', 'WARN') or "timestamp" < timestamp '{AS_OF}' - interval 7 day)
    select 'hot' as tier, trace as name, cast(1 as bigint) as rows, id as ids from live where rn = 1
    union all select 'cold', level, count(*), cast(sum(id) as bigint) from cold group by 2""")
def compact_hot_cold(spark, sf_dir):
    """Three batches in the tiers, merged but for the last and then with it; the last written document of a trace id stays."""
    base, rows = _folder(spark), _shared_traces(spark, sf_dir)
    for number in range(3):
        tiers.store_batch(rows.filter(F.col("id") % 3 == number), base, AS_OF, number)
    for below in (2, 3):
        compaction.compact_hot(spark, f"{base}/hot", below)
        compaction.compact_cold(spark, f"{base}/cold", below)
    ids = F.get_json_object("document", "$.id").cast("bigint")
    hot = tiers.read_hot(spark, f"{base}/hot", AS_OF).select(
        F.lit("hot").alias("tier"), F.col("trace_id").alias("name"), F.lit(1).cast("bigint").alias("rows"), ids.alias("ids"))
    lines = compaction.stored(spark, f"{base}/cold", ["level", "date"], "text")
    cold = lines.groupBy("level").agg(F.count("*").alias("rows"), F.sum(F.get_json_object("value", "$.id").cast("bigint")).alias("ids"))
    return hot.unionByName(cold.select(F.lit("cold").alias("tier"), F.col("level").alias("name"), "rows", "ids"))
