"""Custom data: conformity to the registry, request jobs and their counters."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdlake.functions.scalars import book_summary_id, venue_of
from mdlake.operators.asof import ffill_state

# Type, channel, venue and required metadata key.
REGISTRY = [
    ("BinanceFuturesLiquidation", "subscribe", "BINANCE", None),
    ("BinanceFuturesTicker", "subscribe", "BINANCE", None),
    ("DeribitVolatilityIndex", "subscribe", "DERIBIT", "index_name"),
    ("HyperliquidOpenInterest", "subscribe", "HYPERLIQUID", None),
    ("DeribitBookSummary", "request", "DERIBIT", "currency"),
]


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGISTRY, "type_name string, known_channel string, venue string, required_key string")


def check_custom(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(type_name, identifier, seq, rule) of rows that don't conform. rows: type_name, channel, identifier, instrument_id, metadata, seq."""
    joined = rows.join(known, "type_name", "left")
    meta = lambda k: F.try_element_at("metadata", k)
    summary = F.col("type_name") == "DeribitBookSummary"
    rules = F.array(
        F.when(F.col("known_channel").isNull(), F.lit("unknown_type")),
        F.when(F.col("known_channel") != F.col("channel"), F.lit("wrong_channel")),
        F.when(F.col("required_key").isNotNull() & (F.coalesce(F.trim(meta(F.col("required_key"))), F.lit("")) == ""), F.lit("missing_key")),
        F.when(~summary & meta(F.lit("instrument_id")).isNotNull() & ~F.col("identifier").eqNullSafe(meta(F.lit("instrument_id"))), F.lit("identifier")),
        F.when(summary & book_summary_id("metadata", "identifier").isNull(), F.lit("identifier")),
        F.when(F.col("instrument_id").isNotNull() & (venue_of("instrument_id") != F.col("venue")), F.lit("venue")),
    )
    return joined.select("type_name", "identifier", "seq", F.explode(F.array_compact(rules)).alias("rule"))


def distinct_ids(rows: DataFrame) -> DataFrame:
    """Instruments seen for each custom type."""
    return rows.groupBy("type_name").agg(F.count_distinct("instrument_id").alias("instruments"))


def replay_requests(log: DataFrame, timeout_ns: int) -> DataFrame:
    """The log of request jobs (job, ts_ns, seq, kind: tick or response, rows) with what each line did.

    A tick while a request is in flight is skipped, or fires after the timeout; a response ends the request. After a
    response nothing is in flight, so a job is cut there and its parts are gone through at once, lines in order.
    """
    columns = ["job", "ts_ns", "seq", "kind", "rows"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, busy, fired = object(), False, 0
        for pdf in batches:
            actions = []
            for job, ts, kind in zip(pdf["job"], pdf["ts_ns"], pdf["kind"], strict=True):
                # A part begins with its response, which nothing before it changes; only a job's first has none.
                if job != current:
                    current, busy, fired = job, False, 0
                if kind == "response":
                    busy = False
                    actions.append("response")
                elif busy and ts - fired < timeout_ns:
                    actions.append("skip")
                else:
                    actions.append("timeout" if busy else "fire")
                    busy, fired = True, ts
            yield pdf[columns].assign(action=actions)

    schema = log.select(*columns).schema.add("action", "string")
    cut = ffill_state(log.select(*columns).withColumn("__from", F.when(F.col("kind") == "response", F.col("ts_ns"))), "job", ["__from"], ("ts_ns", "seq"))
    return cut.repartition("job", "__from").sortWithinPartitions("job", F.col("__from").asc_nulls_first(), "ts_ns", "seq").mapInPandas(run, schema)


def request_metrics(replayed: DataFrame) -> DataFrame:
    """Counters by job, and in total (job null): polls, rows, skipped, timeouts, in flight."""
    state = F.max_by("action", F.struct("ts_ns", "seq"))
    jobs = replayed.groupBy("job").agg(
        F.count_if(F.col("action").isin("fire", "timeout")).alias("polls"), F.sum(F.when(F.col("action") == "response", F.col("rows")).otherwise(0)).alias("rows"), F.count_if(F.col("action") == "skip").alias("skipped"), F.count_if(F.col("action") == "timeout").alias("timeouts"),
        (state != "response").cast("long").alias("in_flight"),
    )
    return jobs.rollup("job").agg(*[F.sum(c).alias(c) for c in ("polls", "rows", "skipped", "timeouts", "in_flight")])
