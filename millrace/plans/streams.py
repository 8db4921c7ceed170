"""Queries: file streams into files and versioned tables. Each runs until its input is used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans.inputs import new_database, table
from millrace.session import scratch
from millrace.streaming.control import Watched
from millrace.streaming.sinks import to_parquet, to_versioned
from millrace.streaming.sources import json_folder
from millrace.versioned.table import VersionedTable

DEVICE = "event_id BIGINT, device STRING, status STRING"


def _readings(spark, folder, only="true"):
    return table(spark, folder, "events").where(only).select(
        "event_id", F.concat(F.lit("device-"), "user_id").alias("device"), F.col("event_type").alias("status")
    )


def _json_stream(spark, folder, max_files=None):
    path = scratch(spark, "arriving")
    _readings(spark, folder).write.json(path)
    return json_folder(spark, path, DEVICE, max_files or spark.sparkContext.defaultParallelism)


def _through_parquet(spark, stream):
    path, checkpoint = scratch(spark, "stream"), scratch(spark, "checkpoint")
    to_parquet(stream, path, checkpoint, finish=True)
    return spark.read.schema(stream.schema).parquet(path)


def stream_json_source(spark, folder):
    return _through_parquet(spark, _json_stream(spark, folder))


def stream_append_sink(spark, folder):
    """Two rounds of files; the second run goes on where the first stopped."""
    arriving, path, checkpoint = (scratch(spark, n) for n in ("arriving", "stream", "checkpoint"))
    for part in ("event_type IN ('view', 'click')", "event_type NOT IN ('view', 'click')"):
        _readings(spark, folder, part).write.mode("append").json(arriving)
        to_parquet(json_folder(spark, arriving, DEVICE), path, checkpoint, finish=True)
    return spark.read.schema(DEVICE).parquet(path)


def stream_project(spark, folder):
    stream = _json_stream(spark, folder).where("status <> 'error'").select("device", F.upper("status").alias("status"))
    return _through_parquet(spark, stream)


def stream_group_count(spark, folder):
    """Counts over all input so far, kept as the newest version of a table."""
    counts = _json_stream(spark, folder).groupBy("status").count()
    path = scratch(spark, "counts")
    to_versioned(counts, path, scratch(spark, "checkpoint"), finish=True, output_mode="complete")
    return VersionedTable(spark, path).read()


def stream_versioned_sink(spark, folder):
    """Two rounds of files into a versioned table, queried in between."""
    arriving, path, checkpoint = (scratch(spark, n) for n in ("arriving", "devices", "checkpoint"))
    counts = []
    for part in ("event_type IN ('view', 'click')", "event_type NOT IN ('view', 'click')"):
        _readings(spark, folder, part).write.mode("append").json(arriving)
        to_versioned(json_folder(spark, arriving, DEVICE), path, checkpoint, finish=True)
        seen = VersionedTable(spark, path)
        counts.append(seen.read(version=seen.latest().version).groupBy("status").count())
    early = counts[0].select("status", F.col("count").alias("in_first_round"))
    return counts[1].join(early, "status", "left")


def stream_versioned_source(spark, folder):
    """First the table as it is, then an append and the rows an update writes again."""
    versioned = VersionedTable.create(_readings(spark, folder, "event_type = 'view'"), scratch(spark, "devices"))
    versioned.append(_readings(spark, folder, "event_type NOT IN ('view', 'click')"))
    path, checkpoint = scratch(spark, "followed"), scratch(spark, "checkpoint")
    to_parquet(versioned.read_stream(ignore_changes=True, since=0), path, checkpoint, finish=True)
    versioned.append(_readings(spark, folder, "event_type = 'click'"))
    versioned.update("status = 'view'", {"status": "'seen'"})
    to_parquet(versioned.read_stream(ignore_changes=True, since=0), path, checkpoint, finish=True)
    return spark.read.schema(DEVICE).parquet(path)


def stream_while_running(spark, folder):
    """A stream looked at by SQL while it runs, after it was stopped, and after another query went on.

    Three loads arrive: two while the first query runs, the third when it is
    stopped. ``rows_taken`` and ``batches`` are what the query of the moment reports.
    """
    arriving, path, checkpoint = (scratch(spark, n) for n in ("arriving", "devices", "checkpoint"))
    name = f"{new_database(spark)}.devices"
    moments = []

    def arrive(only: str) -> None:
        # One file, so one batch.
        _readings(spark, folder, only).coalesce(1).write.mode("append").json(arriving)

    def start() -> Watched:
        return Watched(to_versioned(json_folder(spark, arriving, DEVICE, max_files=1), path, checkpoint))

    def look(moment: str, running: Watched) -> None:
        batches, taken = running.progress()
        counts = spark.sql(f"SELECT status, count(*) AS count FROM {name} GROUP BY status")
        seen = counts.select(
            F.lit(moment).alias("moment"), F.lit(running.active).alias("running"), F.lit(batches).cast("bigint").alias("batches"),
            F.lit(taken).cast("bigint").alias("rows_taken"), "status", "count",
        )
        # Written, because the table goes on changing.
        seen.write.parquet(kept := scratch(spark, "moment"))
        moments.append(spark.read.schema(seen.schema).parquet(kept))

    arrive("event_type = 'view'")
    with start() as running:
        VersionedTable(spark, path).register(name)
        running.take()
        look("first load", running)
        arrive("event_type = 'click'")
        running.take()
        look("second load", running)
    arrive("event_type NOT IN ('view', 'click')")
    look("stopped", running)
    with start() as again:
        again.take()
        look("resumed", again)
    first, *others = moments
    for moment in others:
        first = first.unionByName(moment)
    return first


_READINGS = "SELECT event_id, 'device-' || user_id AS device, event_type AS status FROM events"

QUERIES = {
    "stream_json_source": (stream_json_source, _READINGS),
    "stream_append_sink": (stream_append_sink, _READINGS),
    "stream_project": (
        stream_project,
        f"SELECT device, upper(status) AS status FROM ({_READINGS}) WHERE status <> 'error'",
    ),
    "stream_group_count": (stream_group_count, "SELECT event_type AS status, count(*) AS count FROM events GROUP BY ALL"),
    "stream_versioned_sink": (
        stream_versioned_sink,
        """SELECT event_type AS status, count(*) AS count,
                  CASE WHEN event_type IN ('view', 'click') THEN count(*) END AS in_first_round
           FROM events GROUP BY event_type""",
    ),
    "stream_while_running": (
        stream_while_running,
        """WITH loads AS (
             SELECT event_type AS status, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS load FROM events),
           moments(moment, running, low, high, batches, shown) AS (
             VALUES ('first load', true, 1, 1, 1, 1), ('second load', true, 1, 2, 2, 2), ('stopped', false, 1, 2, 2, 2),
                    ('resumed', true, 3, 3, 1, 3))
           SELECT moment, running, CAST(batches AS BIGINT) AS batches,
                  CAST((SELECT count(*) FROM loads l WHERE l.load BETWEEN m.low AND m.high) AS BIGINT) AS rows_taken, status,
                  count(*) AS count
           FROM moments m JOIN loads ON load <= shown GROUP BY ALL""",
    ),
    "stream_versioned_source": (
        stream_versioned_source,
        f"""SELECT * FROM ({_READINGS}) 
            UNION ALL SELECT event_id, device, 'seen' FROM ({_READINGS}) WHERE status = 'view'""",
    ),
}
