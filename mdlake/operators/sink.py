"""Writing and sealing the catalog, its manifest and its figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mdlake.functions.scalars import next_seal_ns, stable_key, whole
from mdlake.operators.sealing import PARTITION

# Rows of a memory flush and of a row group by family, and the ranges they are held to.
FLUSH_ROWS = {"order_book_deltas": 20_000, "trades": 2_000, "quotes": 500, "mark_prices": 100, "index_prices": 100, "funding_rate_update": 100, "instrument_status": 100, "instrument_closes": 100, "option_greeks": 2_000, "bars": 500, "instruments": 50}
DELTA_RANGE = (20_000, 50_000)
CUSTOM_FLUSH, CUSTOM_GROUP = 1_000, 50_000
ROW_GROUP_LIMIT = 32_767
SMALL_CONFIGURED = 200


def flush_rows(family: str, configured: int = 2_000) -> tuple[int, int]:
    """(rows of a flush, rows of a row group) of a family for a configured row-group size."""
    if configured < SMALL_CONFIGURED:
        return configured, configured
    if family == "order_book_deltas":
        n = min(max(configured, DELTA_RANGE[0]), DELTA_RANGE[1])
        return n, n
    if family == "custom":
        return CUSTOM_FLUSH, CUSTOM_GROUP
    n = FLUSH_ROWS.get(family, configured)
    return n, n


def with_seal_date(df: DataFrame, hour: int = 6, minute: int = 0, zone: str = "UTC", ts: str = "ts_init_ns") -> DataFrame:
    """df with seal_end_ns, the seal boundary that ends each row's window (arrival clock), and its date."""
    return df.withColumn("seal_end_ns", next_seal_ns(ts, hour, minute, zone)).withColumn("seal_date", F.timestamp_micros(whole("seal_end_ns", 1000)).cast("date"))


def quarantined(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): rows without an id or time can't be placed and go to the dead-letter table."""
    bad = F.col("instrument_id").isNull() | F.col("ts_init_ns").isNull()
    return df.filter(~bad), df.filter(bad)


def write_chunk(df: DataFrame, root: str, family: str, compression: str = "snappy") -> None:
    """Append a batch as complete files, one for each partition that it touches.

    Rows are written by the tasks that hold them: no shuffle, and a busy instrument's day may be several files. Rows
    without an id or time are appended to the family's quarantine.
    """
    good, bad = quarantined(df)
    if bad.take(1):
        bad.write.mode("append").parquet(f"{root}/_quarantine/{family}")
    dated = good if "seal_date" in good.columns else with_seal_date(good).drop("seal_end_ns")
    dated.write.mode("append").option("compression", compression).partitionBy(*PARTITION).parquet(f"{root}/{family}")


def write_instruments(df: DataFrame, root: str) -> None:
    """Definitions are always complete files."""
    write_chunk(df, root, "instruments")


def manifest(written: DataFrame, family: str) -> DataFrame:
    """(family, instrument_id, seal_date, path, rows, bytes, min_ts_ns, max_ts_ns) of written files."""
    rows = written.select("instrument_id", "seal_date", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"), "ts_init_ns")
    return rows.groupBy("instrument_id", "seal_date", "path").agg(F.count(F.lit(1)).alias("rows"), F.max("bytes").alias("bytes"), F.min("ts_init_ns").alias("min_ts_ns"), F.max("ts_init_ns").alias("max_ts_ns")).select(F.lit(family).alias("family"), "*")


def partition_stats(df: DataFrame, keys: tuple[str, ...] = PARTITION, family: str = "trades", kind: str = "Trade") -> DataFrame:
    """Rows and time range of each partition of rows that are still to be written, with its stable key.

    Of written ones catalog.partition_manifest gives bytes and files too, without reading a column.
    """
    stats = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.min("ts_init_ns").alias("min_ts_ns"), F.max("ts_init_ns").alias("max_ts_ns"))
    return stats.withColumn("stable_key", stable_key(F.lit(family), F.lit(kind), F.col("instrument_id"), F.lit(None).cast("string")))


def write_limited(df: DataFrame, root: str, family: str, file_rows: int) -> None:
    """Write partitions as files of at most file_rows rows each.

    Small files take time by their number, not their bytes, so the number of tasks is named and not left to the size of the rows.
    """
    good, _ = quarantined(df)
    dated = good if "seal_date" in good.columns else with_seal_date(good).drop("seal_end_ns")
    dated.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *PARTITION).write.mode("append").option("maxRecordsPerFile", file_rows).partitionBy(*PARTITION).parquet(f"{root}/{family}")


def flushes(files: DataFrame, file_rows: int) -> DataFrame:
    """Files (family, bytes, rows) with the reason of their flush: full, or the end of their window."""
    return files.select("family", "rows", "bytes", F.when(F.col("rows") >= file_rows, "rows").otherwise("seal").alias("reason"))


def disjoint_intervals(batches: DataFrame, key: str, order: str, start: str = "start_ns", end: str = "end_ns", seed: str | None = None) -> DataFrame:
    """batches with file_start and file_end: each interval begins after the one before ends.

    A start at or before the previous end becomes that end plus one, an end before its start becomes the start.
    seed: a column with the largest end that is already on disk for the key.
    """
    w = Window.partitionBy(key).orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    i = F.row_number().over(w).cast("long")
    numbered = batches.withColumn("__i", i)
    last = F.max(F.greatest(start, end) - F.col("__i")).over(upto)
    if seed:
        last = F.greatest(last, F.col(seed))
    ended = numbered.withColumn("file_end", last + F.col("__i"))
    before = F.lag("file_end").over(w)
    if seed:
        before = F.coalesce(before, F.col(seed))
    return ended.withColumn("file_start", F.greatest(F.col(start), before + 1)).drop("__i")


def capacity_report(files: DataFrame, seconds: int = 86_400, group_rows: int = CUSTOM_GROUP) -> DataFrame:
    """For each instrument: rows a second, row groups a day, and seconds until a file meets the row-group limit.

    files: instrument_id, rows, min_ts_ns, max_ts_ns.
    """
    total = files.groupBy("instrument_id").agg(F.sum("rows").alias("rows"), ((F.max("max_ts_ns") - F.min("min_ts_ns")) / 1_000_000_000).alias("span_s"))
    rate = F.when(F.col("span_s") > 0, F.col("rows") / F.col("span_s"))
    found = total.withColumn("rows_per_s", rate)
    return found.withColumn("groups_per_day", F.ceil(F.col("rows_per_s") * seconds / group_rows)).withColumn("limit_s", F.floor(F.lit(ROW_GROUP_LIMIT * group_rows) / F.col("rows_per_s"))).withColumn("least_group_rows", F.ceil(F.col("rows_per_s") * seconds * 10 / ROW_GROUP_LIMIT))


def capture_metrics(writes: DataFrame, dropped: DataFrame) -> DataFrame:
    """Totals and figures by family: rows, files, bytes, mean file bytes, files by flush reason, dropped rows.

    writes: family, rows, bytes, reason; dropped: family, n. The row without a family is the total.
    """
    reasons = ("rows", "bytes", "interval", "partitions", "family_bytes", "seal", "shutdown")
    by = writes.rollup("family").agg(F.sum("rows").alias("accepted"), F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), *[F.count_if(F.col("reason") == r).alias(f"flush_{r}") for r in reasons])
    lost = dropped.rollup("family").agg(F.sum("n").alias("dropped"))
    both = by.join(lost.withColumnRenamed("family", "__f"), F.col("family").eqNullSafe(F.col("__f")), "left").drop("__f")
    return both.withColumn("dropped", F.coalesce("dropped", F.lit(0))).withColumn("mean_file_bytes", F.when(F.col("files") > 0, F.floor(F.col("bytes") / F.col("files"))).otherwise(0))


def metrics_ok(metrics: DataFrame) -> DataFrame:
    """Broken rules of run metrics: dropped rows, a family that accepted none, or, where it is counted, fewer than no active partitions."""
    rules = [F.when(F.col("dropped") > 0, F.lit("dropped")), F.when(F.coalesce("accepted", F.lit(0)) <= 0, F.lit("accepted"))]
    if "active" in metrics.columns:
        rules.append(F.when(F.coalesce("active", F.lit(-1)) < 0, F.lit("active")))
    rules = F.array(*rules)
    return metrics.select("family", F.explode(F.array_compact(rules)).alias("rule"))


def forward_prices(greeks: DataFrame) -> DataFrame:
    """Forward prices that greeks imply, as log records."""
    return greeks.filter("underlying_price IS NOT NULL").select("instrument_id", F.col("underlying_price").cast("string").alias("forward_price"), F.lit(None).cast("string").alias("underlying_index"), "ts_event_ns", "ts_init_ns", F.lit("option_greeks_underlying_price").alias("source"))


def write_forward_prices(greeks: DataFrame, path: str) -> None:
    forward_prices(greeks).write.mode("append").json(path)


def explode_deltas(batches: DataFrame) -> DataFrame:
    """Batches of book deltas (instrument_id, deltas array) as one row for each delta."""
    return batches.select("instrument_id", F.inline("deltas"))
