"""The streaming operators run over the whole tables as batches, as the same plans allow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.streaming import ingest


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.windowed_counts(spark.read.parquet(f"{sf_dir}/events.parquet")).withColumn("start", F.date_format("start", "yyyy-MM-dd"))


def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ingest.sessions(spark.read.parquet(f"{sf_dir}/events.parquet"))
    return found.groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("n").alias("events"), F.max("n").alias("longest"))


QUERIES = {f.__name__: f for f in (daily_events, user_sessions)}
ORACLES = {
    "daily_events": "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS start, event_type, count(*) AS n, round(sum(value), 6) AS value FROM events GROUP BY 1, 2",
    "user_sessions": """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM g), c AS (SELECT user_id, s, count(*) AS n FROM s GROUP BY ALL)
SELECT user_id, count(*) AS sessions, sum(n)::BIGINT AS events, max(n) AS longest FROM c GROUP BY user_id""",
}
