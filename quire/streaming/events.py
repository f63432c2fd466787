"""The event log as a stream: deduplication under a watermark, hourly counts, custom state."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("ts", "event", "book_id", "variant", "payload")] + [T.StructField("ingested_at", T.TimestampType())]
)


def read_stream(spark: SparkSession, path: str, source: str = "json", files_per_trigger: int | None = None) -> DataFrame:
    """Events appended as files under ``path`` (JSON lines, or parquet)."""
    r = spark.readStream.schema(EVENT_SCHEMA)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.format(source).load(path)


def hourly(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """Distinct events per hour and kind; later than ``late`` behind the newest is dropped."""
    d = events.where("ingested_at is not null").withWatermark("ingested_at", late).dropDuplicatesWithinWatermark(["ts", "event", "book_id", "variant", "payload"])
    return d.groupBy(F.window("ingested_at", "1 hour").alias("w"), "event").agg(F.count("*").alias("events")).select(F.col("w.start").alias("hour"), "event", "events")


def bursts(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Session windows of the events of a book."""
    d = events.where("ingested_at is not null and book_id is not null").withWatermark("ingested_at", late)
    return d.groupBy(F.session_window("ingested_at", gap).alias("s"), "book_id").agg(F.count("*").alias("events")).select("book_id", F.col("s.start").alias("began"), F.col("s.end").alias("ended"), "events")


def progress(events: DataFrame) -> DataFrame:
    """Events seen so far of each book, as they come (arbitrary state)."""

    def step(key: tuple, rows: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        (n,) = state.get if state.exists else (0,)
        n += sum(len(r) for r in rows)
        state.update((n,))
        yield pd.DataFrame({"book_id": [key[0]], "events": [n]})

    return events.where("book_id is not null").groupBy("book_id").applyInPandasWithState(step, "book_id string, events bigint", "n bigint", "update", "NoTimeout")


def write_stream(df: DataFrame, path: str, checkpoint: str) -> None:
    """Append the finished rows of a stream to parquet files under ``path``, each once, and stop when all input is read.

    ``checkpoint`` is a folder that all executors share; a restart goes on from it.
    """
    q = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()


def upsert_stream(df: DataFrame, path: str, checkpoint: str, key: list[str]) -> None:
    """Keep the newest row of each key of a stream of updates: a batch rewrites the partitions it touches.

    ``path`` gets one folder for each value of the first key column.
    """
    spark = df.sparkSession

    def put(batch: DataFrame, _: int) -> None:
        batch.sparkSession.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        new = batch.dropDuplicates(key)
        try:
            old = batch.sparkSession.read.schema(batch.schema).parquet(path).join(new.select(key[0]).distinct(), key[0], "left_semi").join(new, key, "left_anti")
            new = new.unionByName(old.select(*new.columns)).checkpoint() if spark.sparkContext.getCheckpointDir() else new.unionByName(old.select(*new.columns)).cache()
            new.count()  # read before its files are replaced
        except AnalysisException:  # the first batch
            pass
        new.write.mode("overwrite").partitionBy(key[0]).parquet(path)

    df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start().awaitTermination()


def _folder(spark: SparkSession) -> str:
    """A folder of this run below the one the cluster shares; one of this machine only where driver and executors are one process."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return f"{found}/quire-stream-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="quire-stream-")


def log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a stream of its files."""
    at, name = f"{sf_dir}/run_events.parquet", "run_events.parquet"
    r = spark.readStream.schema(EVENT_SCHEMA).format("parquet")
    # a single file is found by its name in the folder, a folder of files as it is
    folder = spark._jvm.org.apache.hadoop.fs.Path(at)
    is_dir = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(folder).isDirectory()
    return r.load(at) if is_dir else r.option("pathGlobFilter", name).load(sf_dir)


def run_once(df: DataFrame) -> DataFrame:
    """Run a stream over what is there into files, and read them."""
    at = _folder(df.sparkSession)
    write_stream(df, f"{at}/out", f"{at}/state")
    return df.sparkSession.read.schema(df.schema).parquet(f"{at}/out")


def q_stream_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts of distinct events under a watermark that covers the whole log, so all hours but the open last one are final."""
    e = log_stream(spark, sf_dir)
    return run_once(hourly(e))


def q_stream_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session windows of each book's events that are final."""
    return run_once(bursts(log_stream(spark, sf_dir)))


QUERIES = {"stream_event_hours": q_stream_hours, "stream_event_bursts": q_stream_bursts}
# what the watermark (two hours behind the newest event) has not closed isn't final
_LAST = "(SELECT max(ingested_at) - INTERVAL 2 HOUR FROM run_events)"
SQL = {
    "stream_event_hours": f"""WITH d AS (SELECT DISTINCT ON (ts, event, book_id, variant, payload) ingested_at, event FROM run_events WHERE ingested_at IS NOT NULL ORDER BY ingested_at)
        SELECT * FROM (SELECT date_trunc('hour', ingested_at) AS hour, event, count(*) AS events FROM d GROUP BY 1, 2) WHERE hour + INTERVAL 1 HOUR <= {_LAST}""",
    "stream_event_bursts": f"""WITH e AS (SELECT book_id, ingested_at AS t, CASE WHEN ingested_at - lag(ingested_at) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS starts FROM run_events WHERE ingested_at IS NOT NULL AND book_id IS NOT NULL WINDOW w AS (PARTITION BY book_id ORDER BY ingested_at)),
        s AS (SELECT book_id, t, sum(starts) OVER (PARTITION BY book_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS k FROM e)
        SELECT book_id, min(t) AS began, max(t) + INTERVAL 30 MINUTE AS ended, count(*) AS events FROM s GROUP BY book_id, k HAVING max(t) + INTERVAL 30 MINUTE <= {_LAST}""",
}
