"""Model calls and the event log: deliveries, attempts, tokens, reasons, sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.functions.ordered import with_running_sum
from quire.sources.tables import table


def once(responses: DataFrame) -> DataFrame:
    """Each response once, however often it was delivered; the first delivery stays."""
    w = Window.partitionBy("response_id").orderBy(F.col("received_at").asc_nulls_last())
    return responses.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def reason(df_stop: str = "stop_reason", df_finish: str = "finish_reason") -> Column:
    """One spelling for the clients' reasons: stop, length, safety, recitation, error, other, none."""
    s = F.regexp_replace(F.lower(F.coalesce(df_stop, df_finish, F.lit(""))), r"^.*\.", "")
    return (
        F.when(s == "", "none").when(s.isin("stop", "end_turn", "stop_sequence"), "stop").when(s.isin("max_tokens", "length"), "length")
        .when(s.isin("safety", "recitation", "error"), s).otherwise("other")
    )


TOKENS = ("input_tokens", "output_tokens", "cached_tokens", "cache_creation_tokens", "cache_read_tokens")


def usage(responses: DataFrame) -> DataFrame:
    """Calls, tokens and time by provider and model, with subtotals by provider and a grand total."""
    r = once(responses).rollup("provider", "model")
    return r.agg(
        F.grouping_id().cast("int").alias("level"), F.count("*").alias("calls"), F.count_if(F.coalesce("success", F.lit(False))).alias("successes"),
        *[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in TOKENS], F.sum("duration_ms").alias("duration_ms"), F.count_if(F.coalesce("safety_blocked", F.lit(False)) | F.coalesce("recitation_blocked", F.lit(False))).alias("blocked"),
    )


def last_attempts(responses: DataFrame) -> DataFrame:
    """The last attempt of each purpose of each extraction, and how many there were."""
    r = once(responses).where("extraction_id is not null")
    return r.groupBy("extraction_id", "purpose").agg(F.count("*").alias("attempts"), F.max_by("response_id", F.struct("attempt", "response_id")).alias("response_id"), F.sum(F.coalesce("output_tokens", F.lit(0))).alias("output_tokens"))


def running_tokens(responses: DataFrame) -> DataFrame:
    """Running output tokens of each book in order of pages.

    Pre-aggregated by page; the running sum runs over cells of pages.
    """
    per = once(responses).where("book_id is not null").groupBy("book_id", "page_number").agg(F.sum(F.coalesce("output_tokens", F.lit(0))).alias("tokens"))
    return with_running_sum(per, "book_id", "page_number", "tokens", "running")


def clean_events(events: DataFrame) -> DataFrame:
    """Distinct events with a parsed time; null where the time is written otherwise.

    Formats: ``yyyy-MM-dd HH:mm:ss``, the same with T, and ``dd/MM/yyyy HH:mm``.
    """
    ts = F.coalesce(F.try_to_timestamp("ts", F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp("ts", F.lit("yyyy-MM-dd'T'HH:mm:ss")), F.try_to_timestamp("ts", F.lit("dd/MM/yyyy HH:mm")))
    keys = [c for c in events.columns if c != "ingested_at"]
    return events.groupBy(*keys).agg(F.min("ingested_at").alias("ingested_at"), F.count("*").alias("deliveries")).withColumn("at", ts)


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Bursts of events of one book and variant with less than ``gap`` between them."""
    e = clean_events(events).where("at is not null")
    w = Window.partitionBy("book_id", "variant").orderBy("at", "event", "payload")
    new = (F.col("at") > F.lag("at").over(w) + F.expr(f"interval {gap}")) | F.lag("at").over(w).isNull()
    d = e.withColumn("new", new.cast("int")).withColumn("session", F.sum("new").over(w))
    return d.groupBy("book_id", "variant", "session").agg(F.count("*").alias("events"), F.min("at").alias("began"), F.max("at").alias("ended"))


def q_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage(table(spark, sf_dir, "model_responses"))


def q_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = once(table(spark, sf_dir, "model_responses"))
    return r.groupBy("provider", "purpose", reason().alias("reason")).agg(F.count("*").alias("calls"), F.count_if("success").alias("successes"))


def q_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_attempts(table(spark, sf_dir, "model_responses"))


def q_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running_tokens(table(spark, sf_dir, "model_responses"))


def q_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = clean_events(table(spark, sf_dir, "run_events"))
    return e.groupBy("event").agg(F.count("*").alias("events"), F.sum("deliveries").alias("deliveries"), F.count_if(F.col("at").isNull()).alias("unparsed"), F.count_distinct("book_id").alias("books"))


def q_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions(table(spark, sf_dir, "run_events"))


def q_event_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling windows of an hour over the time of ingestion."""
    d = table(spark, sf_dir, "run_events").where("ingested_at is not null")
    return d.groupBy(F.window("ingested_at", "1 hour").alias("w"), "event").agg(F.count("*").alias("events")).select(F.col("w.start").alias("hour"), "event", "events")


def q_book_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slug of each book's title and author, for directory names."""
    b = table(spark, sf_dir, "books")
    return b.select("book_id", X.slug(X.text("title"), "book").alias("slug"), X.slug(X.text("author")).alias("author_slug"), F.substring(X.slug(X.text("title"), "book"), 1, 50).alias("file_stem"))


QUERIES = {
    "token_usage": q_usage, "finish_reasons": q_reasons, "last_attempts": q_attempts, "running_tokens": q_running, "event_counts": q_events, "event_sessions": q_sessions, "event_hours": q_event_hours, "book_slugs": q_book_ids,
}

_ONCE = "once AS (SELECT * FROM model_responses QUALIFY row_number() OVER (PARTITION BY response_id ORDER BY received_at ASC NULLS LAST) = 1)"
_REASON = "regexp_replace(lower(coalesce(stop_reason, finish_reason, '')), '^.*[.]', '')"
_EVENTS = """e0 AS (SELECT ts, event, book_id, variant, payload, min(ingested_at) AS ingested_at, count(*) AS deliveries FROM run_events GROUP BY ts, event, book_id, variant, payload),
    e AS (SELECT *, coalesce(try_strptime(ts, '%Y-%m-%d %H:%M:%S'), try_strptime(ts, '%Y-%m-%dT%H:%M:%S'), try_strptime(ts, '%d/%m/%Y %H:%M')) AS "at" FROM e0)"""


def _slug(x: str, fallback: str) -> str:
    s = f"regexp_replace(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
    return f"CASE WHEN {s} = '' THEN '{fallback}' ELSE {s} END"


SQL = {
    "token_usage": f"""WITH {_ONCE} SELECT provider, model, (grouping(provider) * 2 + grouping(model))::INTEGER AS level, count(*) AS calls, count(*) FILTER (WHERE coalesce(success, false)) AS successes,
        {', '.join(f'coalesce(sum({t}), 0)::BIGINT AS {t}' for t in TOKENS)}, sum(duration_ms)::BIGINT AS duration_ms, count(*) FILTER (WHERE coalesce(safety_blocked, false) OR coalesce(recitation_blocked, false)) AS blocked FROM once GROUP BY ROLLUP (provider, model)""",
    "finish_reasons": f"""WITH {_ONCE} SELECT provider, purpose, CASE WHEN {_REASON} = '' THEN 'none' WHEN {_REASON} IN ('stop', 'end_turn', 'stop_sequence') THEN 'stop' WHEN {_REASON} IN ('max_tokens', 'length') THEN 'length'
        WHEN {_REASON} IN ('safety', 'recitation', 'error') THEN {_REASON} ELSE 'other' END AS reason, count(*) AS calls, count(*) FILTER (WHERE success) AS successes FROM once GROUP BY ALL""",
    "last_attempts": f"""WITH {_ONCE} SELECT extraction_id, purpose, count(*) AS attempts, arg_max(response_id, (attempt, response_id)) AS response_id, sum(coalesce(output_tokens, 0))::BIGINT AS output_tokens FROM once WHERE extraction_id IS NOT NULL GROUP BY ALL""",
    "running_tokens": f"""WITH {_ONCE}, p AS (SELECT book_id, page_number, sum(coalesce(output_tokens, 0))::BIGINT AS tokens FROM once WHERE book_id IS NOT NULL GROUP BY ALL)
        SELECT *, sum(tokens) OVER (PARTITION BY book_id ORDER BY page_number NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS running FROM p""",
    "event_counts": f"""WITH {_EVENTS} SELECT event, count(*) AS events, sum(deliveries)::BIGINT AS deliveries, count(*) FILTER (WHERE "at" IS NULL) AS unparsed, count(DISTINCT book_id) AS books FROM e GROUP BY event""",
    "event_sessions": f"""WITH {_EVENTS}, l AS (SELECT *, CASE WHEN lag("at") OVER w IS NULL OR "at" > lag("at") OVER w + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh FROM e WHERE "at" IS NOT NULL WINDOW w AS (PARTITION BY book_id, variant ORDER BY "at", event, payload)),
        s AS (SELECT *, sum(fresh) OVER (PARTITION BY book_id, variant ORDER BY "at", event, payload) AS session FROM l) SELECT book_id, variant, session::BIGINT AS session, count(*) AS events, min("at") AS began, max("at") AS ended FROM s GROUP BY book_id, variant, session""",
    "event_hours": "SELECT date_trunc('hour', ingested_at) AS hour, event, count(*) AS events FROM run_events WHERE ingested_at IS NOT NULL GROUP BY ALL",
    "book_slugs": f"SELECT book_id, {_slug('title', 'book')} AS slug, {_slug('author', 'na')} AS author_slug, substr({_slug('title', 'book')}, 1, 50) AS file_stem FROM books",
}
