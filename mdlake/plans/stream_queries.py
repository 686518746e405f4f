"""Queries over streams, logs and landed documents: tables are landed as files, taken by a stream, and read back."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mdlake.functions import scalars as S
from mdlake.operators import lineage, outcomes, sealing, sink, validate
from mdlake.plans.catalog_queries import surface_events
from mdlake.plans.plan_queries import _DAILY, MARKETS, SMOOTHED, daily_oi, outcome_specs, resolved
from mdlake.plans.registry import ORACLES, QUERIES, query
from mdlake.plans.universe_queries import RESOLVED, r6
from mdlake.session import parked, scratch
from mdlake.sources import catalog
from mdlake.sources import derived as D
from mdlake.streaming import capture
from mdlake.streaming.online_metrics import EVENTS, option_metrics_stream
from mdlake.streaming.smoothing import RESOLUTIONS, smooth_strikes_stream

TRADES = "instrument_id string, price double, size double, ts_event_ns bigint, ts_init_ns bigint, seq bigint"
_AS_TEXT = "instrument_id string, price string, size string, ts_event_ns bigint, ts_init_ns bigint, seq bigint"


def _spans() -> list[Column]:
    """What is told of the rows of a group."""
    return [F.count(F.lit(1)).alias("rows"), F.min("ts_init_ns").alias("min_ts_ns"), F.max("ts_init_ns").alias("max_ts_ns")]


def _by_underlying(df: DataFrame) -> DataFrame:
    """Rows filed under their underlying, so that a daily partition holds many of them."""
    return df.withColumn("instrument_id", F.substring_index("instrument_id", "-", 1))


def _as_family(df: DataFrame, family: str) -> DataFrame:
    """df in a family's columns; those that it lacks are null."""
    fields = df.sparkSession.createDataFrame([], catalog.SCHEMAS[family]).schema.fields
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields if f.name != "seal_date"])


def _read_all(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All Parquet files under a folder that may be missing."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path) if sealing.exists(spark, path) else spark.createDataFrame([], schema)


@query(
    "capture_stream",
    """WITH q AS (SELECT split_part(instrument_id, '-', 1) AS instrument_id, ts_init_ns FROM quotes_v), d AS (SELECT split_part(instrument_id, '-', 1) AS instrument_id, min(ts_init_ns) AS ready FROM greeks_v WHERE seq % 29 = 0 GROUP BY 1),
    t AS (SELECT CASE WHEN seq % 31 <> 0 THEN split_part(instrument_id, '-', 1) END AS instrument_id, ts_init_ns, CASE WHEN seq % 37 = 0 THEN 'refused' WHEN seq % 31 = 0 THEN 'quarantined' ELSE 'sealed' END AS outcome FROM trades_v)
    SELECT 'quotes' AS family, 'sealed' AS outcome, instrument_id, count(*) AS rows, min(ts_init_ns) AS min_ts_ns, max(ts_init_ns) AS max_ts_ns FROM q JOIN d USING (instrument_id) WHERE ts_init_ns >= ready GROUP BY instrument_id
    UNION ALL SELECT 'trades', outcome, instrument_id, count(*), min(ts_init_ns), max(ts_init_ns) FROM t GROUP BY outcome, instrument_id""",
)
def capture_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Quotes behind a gate and trades with odd rows, landed in two halves: each is captured from the checkpoint of the one before.

    Windows that have ended by the middle of the time are sealed in between, so rows of the second half are late for them.
    """
    root = scratch(spark, "capture")
    quotes, trades = _as_family(_by_underlying(D.quotes(spark, sf)), "quotes"), _by_underlying(D.trades(spark, sf))
    odd = {"instrument_id": F.when(F.col("seq") % 31 != 0, F.col("instrument_id")), "price": F.when(F.col("seq") % 37 == 0, "n/a").otherwise(F.col("price").cast("string")), "size": F.col("size").cast("string")}
    _by_underlying(D.greeks(spark, sf)).filter("seq % 29 = 0").select("instrument_id", "ts_init_ns").write.parquet(f"{root}/definitions")
    low, high = quotes.agg(F.min("ts_init_ns"), F.max("ts_init_ns")).first()
    middle = (low + high) // 2 if low is not None else 0
    sealed = {"quotes": catalog.SCHEMAS["quotes"], "trades": f"{TRADES}, seal_date date"}
    for half, until in ((0, middle), (1, None)):
        for family, rows in (("quotes", quotes), ("trades", trades.withColumns(odd))):
            rows.filter(F.col("seq") % 2 == half).write.mode("append").parquet(f"{root}/landed/{family}")
        streams = [
            capture.start_capture(catalog.stream_family(spark, f"{root}/landed/quotes", "quotes"), root, "quotes", f"{root}/cp/quotes", definitions=f"{root}/definitions"),
            capture.start_capture(spark.readStream.schema(_AS_TEXT).parquet(f"{root}/landed/trades"), root, "trades", f"{root}/cp/trades", schema=TRADES),
        ]
        for stream in streams:
            stream.awaitTermination()
        for family, schema in sealed.items():
            capture.drain(spark, root, family, until, schema)
    found = [("sealed", family, catalog.read_family(spark, root, family, schema=schema)) for family, schema in sealed.items()]
    found.append(("quarantined", "trades", _read_all(spark, f"{root}/_quarantine/trades", TRADES)))
    refused = _read_all(spark, f"{root}/_refused/trades", "row string, error string").select(F.from_json("row", _AS_TEXT).alias("r")).select("r.*")
    found.append(("refused", "trades", refused))
    parts = [rows.groupBy("instrument_id").agg(*_spans()).select(F.lit(family).alias("family"), F.lit(outcome).alias("outcome"), "instrument_id", "rows", "min_ts_ns", "max_ts_ns") for outcome, family, rows in found]
    return validate.all_violations(parts)


_POLLED = 20


@query(
    "snapshot_polls",
    """WITH e AS (SELECT ['BTC','ETH','SOL'][user_id % 3 + 1] AS und, * FROM events)
    SELECT 'sealed' AS outcome, und || '-DVOL.DERIBIT' AS instrument_id, count(*) AS rows, count(*) FILTER (WHERE event_id % 9 > 0) AS valued, min(epoch_us(ts) * 1000) AS min_ts_ns, max(epoch_us(ts) * 1000) AS max_ts_ns FROM e GROUP BY 2
    UNION ALL SELECT 'refused', und || '-DVOL.DERIBIT', count(*), 0, min(epoch_us(ts) * 1000), max(epoch_us(ts) * 1000) FROM e WHERE event_type = 'error' GROUP BY 2""",
)
def snapshot_polls(spark: SparkSession, sf: str) -> DataFrame:
    """Poll responses, documents with an array of rows, into the table of their custom type; a later stream with other columns is refused."""
    root, name = scratch(spark, "polls"), "DeribitVolatilityIndex"
    underlying = F.element_at(F.array(*map(F.lit, D.UNDERLYINGS)), (F.col("user_id") % 3 + 1).cast("int"))
    rows = D.table(spark, sf, "events").select(
        F.when(F.col("event_id") % 9 > 0, F.col("value")).alias("value"), underlying.alias("index_name"), F.concat(underlying, F.lit("-DVOL.DERIBIT")).alias("instrument_id"), D.nanos(F.col("ts")).alias("ts_event_ns"), D.nanos(F.col("ts")).alias("ts_init_ns"), F.col("event_id").alias("seq"), "event_type"
    )
    polled = rows.groupBy("index_name", S.whole("seq", _POLLED).alias("poll")).agg(F.collect_list(F.struct("value", "index_name", "instrument_id", "ts_event_ns", "ts_init_ns", "seq")).alias("rows"))
    polled.select(F.col("index_name").alias("identifier"), "rows").write.json(f"{root}/landed")
    rows.filter("event_type = 'error'").write.parquet(f"{root}/other")
    capture.write_custom_stream(catalog.stream_snapshots(spark, f"{root}/landed", name).drop("identifier"), root, name, None, f"{root}/cp0").awaitTermination()
    other = spark.readStream.schema(rows.schema).parquet(f"{root}/other")
    capture.write_custom_stream(other, root, name, None, f"{root}/cp1").awaitTermination()
    capture.drain(spark, root, f"custom/{name}", schema=f"{catalog.CUSTOM_SCHEMAS[name]}, {TRADES.replace('price double, size double, ', '')}, seal_date date")
    refused = _read_all(spark, f"{root}/_refused/custom/{name}", "row string, error string").select(F.from_json("row", "instrument_id string, ts_init_ns bigint").alias("r")).select("r.*", F.lit(None).cast("double").alias("value"))
    found = lambda outcome, df: df.groupBy("instrument_id").agg(*_spans(), F.count("value").alias("valued")).select(F.lit(outcome).alias("outcome"), "instrument_id", "rows", F.when(F.lit(outcome) == "sealed", F.col("valued")).otherwise(0).cast("long").alias("valued"), "min_ts_ns", "max_ts_ns")
    return found("sealed", catalog.read_custom(spark, root, name)).union(found("refused", refused))


@query("forward_price_log", "SELECT instrument_id, ts_event_ns, round(underlying_price, 6) AS forward_price, 'option_greeks_underlying_price' AS source FROM greeks_v WHERE underlying_price IS NOT NULL")
def forward_price_log(spark: SparkSession, sf: str) -> DataFrame:
    """The forward prices of a stream of greeks, each logged once though the stream is started twice."""
    root = scratch(spark, "forward")
    greeks = _as_family(D.greeks(spark, sf), "option_greeks")
    for half in (0, 1):
        greeks.filter(F.col("seq") % 2 == half).write.mode("append").parquet(f"{root}/landed")
        capture.log_forward_prices(catalog.stream_family(spark, f"{root}/landed", "option_greeks"), f"{root}/log", f"{root}/cp").awaitTermination()
    log = catalog.read_forward_prices(spark, f"{root}/log")
    return log.select("instrument_id", "ts_event_ns", F.round(F.col("forward_price").cast("double"), 6).alias("forward_price"), "source")


#: Questions that a listing document holds on average at most: a few MB of text, as a venue's whole listing is.
DOCUMENT = 20_000


@query("listing_snapshots", f"WITH {MARKETS} SELECT snapshot_id, universe_id, question_id, expiration_ns, ids FROM market")
def listing_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Listings as documents in files of their own, some 20,000 questions of a month each, read back whole and resolved by their month."""
    root = scratch(spark, "listings")
    month = F.trunc(F.timestamp_micros(S.whole("listed_ns", 1000)).cast("date"), "month")
    question = F.struct("question", F.lit("q").alias("name"), "description", F.col("named_outcomes").alias("namedOutcomes"), F.col("fallback_outcome").alias("fallbackOutcome"))
    rows = D.listings(spark, sf).withColumn("snapshot", F.date_format(month, "yyyy-MM"))
    largest = rows.groupBy("snapshot").count().agg(F.max("count")).first()[0] or 0
    parts = -(-largest // DOCUMENT) or 1
    documents = rows.groupBy("snapshot", F.pmod(F.xxhash64("question"), F.lit(parts)).alias("part")).agg(F.to_json(F.struct(F.collect_list(question).alias("questions"))).alias("value"))
    documents.drop("part").write.option("maxRecordsPerFile", 1).partitionBy("snapshot").text(root)
    snapshot = F.regexp_extract("snapshot_id", "snapshot=([0-9-]+)", 1)
    read = catalog.read_listings(spark, root).withColumn("snapshot_id", snapshot)
    listed = read.withColumn("now_ns", F.unix_micros(F.date_add(F.to_date(F.concat("snapshot_id", F.lit("-01"))), 14).cast("timestamp")) * 1000)
    found = outcomes.resolve_outcome_markets(listed, outcome_specs(spark))
    return found.select("snapshot_id", "universe_id", "question_id", "expiration_ns", F.array_join("all_instrument_ids", ",").alias("ids"))


@query(
    "catalog_families",
    """WITH d AS (SELECT array_to_string(string_split(instrument_id, '-')[1:2], '-') AS instrument_id, ts_init_ns // 604800000000000 AS week, min(ts_init_ns) AS ts_init_ns, max(price) AS strike FROM trades_v GROUP BY 1, 2),
    t AS (SELECT DISTINCT split_part(instrument_id, '-', 1) AS id FROM trades_v)
    SELECT 'latest' AS what, instrument_id, max(ts_init_ns) AS ts_init_ns, round(arg_max(strike, ts_init_ns), 4) AS strike FROM d GROUP BY 2 UNION ALL SELECT DISTINCT 'instruments', instrument_id, NULL::BIGINT, NULL::DOUBLE FROM d UNION ALL SELECT 'trades', id, NULL, NULL FROM t""",
)
def catalog_families(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly definitions of each series and trades as chunks; which ids each family has, and the definitions that hold."""
    root = scratch(spark, "catalog")
    trades = D.trades(spark, sf)
    week = S.whole("ts_init_ns", D.WEEK_NS)
    weekly = trades.groupBy(F.substring_index("instrument_id", "-", 2).alias("instrument_id"), week.alias("week")).agg(F.min("ts_init_ns").alias("ts_init_ns"), F.max("price").alias("strike"), F.min("seq").alias("seq"))
    sink.write_instruments(_as_family(weekly, "instruments"), root)
    sink.write_chunk(_by_underlying(trades), root, "trades")
    none = [F.lit(None).cast("long").alias("ts_init_ns"), F.lit(None).cast("double").alias("strike")]
    latest = catalog.read_instruments(spark, root).select(F.lit("latest").alias("what"), "instrument_id", "ts_init_ns", F.round(F.col("strike").cast("double"), 4).alias("strike"))
    return latest.union(catalog.list_families(spark, root).select("family", "instrument_id", *none))


@query(
    "resolution_log",
    f"""WITH RECURSIVE {RESOLVED}, good AS (SELECT * FROM resolved WHERE error IS NULL), {SMOOTHED.format(source='good')}
    SELECT CASE WHEN n = 1 THEN 'startup' ELSE 'refresh' END AS event_kind, universe_id AS venue_id, resolved_at_ns, mode AS strike_selection_mode, reason AS rollover_reason, array_to_string(list_sort(string_split(ids || ',' || split_part(ids, '-', 1) || '-PERPETUAL.DERIBIT', ',')), ',') AS ids FROM st WHERE n = 1 OR reason IS NOT NULL""",
)
def resolution_log(spark: SparkSession, sf: str) -> DataFrame:
    """The option-universe log, appended twice and read back."""
    path = scratch(spark, "log")
    records = parked(lineage.resolution_records(resolved(spark, sf)), "records")
    for kind in ("startup", "refresh"):
        lineage.append_resolutions(records.filter(F.col("event_kind") == kind), path)
    return lineage.read_resolutions(spark, path).select("event_kind", "venue_id", "resolved_at_ns", "strike_selection_mode", "rollover_reason", F.array_join("all_instrument_ids", ",").alias("ids"))


@query(
    "bad_log_lines",
    """WITH l AS (SELECT user_id % 8 AS file, event_id, row_number() OVER (PARTITION BY user_id % 8 ORDER BY event_id) AS line FROM events)
    SELECT file, line, '{"venue_id": ' || event_id AS text FROM l WHERE event_id % 101 = 0""",
)
def bad_log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A log in eight files with blank and torn lines: where the torn ones stand."""
    path = scratch(spark, "log")
    whole = F.to_json(F.struct(F.lit("startup").alias("event_kind"), F.col("event_id").cast("string").alias("venue_id"), D.nanos(F.col("ts")).alias("resolved_at_ns")))
    line = F.when(F.col("event_id") % 101 == 0, F.concat(F.lit('{"venue_id": '), "event_id")).when(F.col("event_id") % 13 == 0, " ").otherwise(whole)
    lines = D.table(spark, sf, "events").select((F.col("user_id") % 8).alias("file"), "event_id", line.alias("value"))
    lines.repartition("file").sortWithinPartitions("file", "event_id").select("file", "value").write.partitionBy("file").text(path)
    found = lineage.bad_lines(spark, path, lineage.RESOLUTION_SCHEMA)
    return found.select(F.regexp_extract("path", "file=([0-9]+)", 1).cast("long").alias("file"), F.col("line").cast("long").alias("line"), "text")


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside keep their state in RocksDB."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _in_two_runs(spark: SparkSession, rows: DataFrame, schema: str, at: str, stream_of) -> DataFrame:
    """What a stream with state gives when the earlier half of the time is landed, taken, and then the later one from the checkpoint."""
    root = scratch(spark, "state")
    rows = parked(rows, "landing")
    low, high = rows.agg(F.min(at), F.max(at)).first()
    middle = (low + high) // 2 if low is not None else 0
    out = f"{root}/out"
    result = stream_of(spark.createDataFrame([], schema)).schema
    with _rocksdb(spark):
        for half in (F.col(at) <= middle, F.col(at) > middle):
            rows.filter(half).write.mode("append").parquet(f"{root}/landed")
            stream = stream_of(spark.readStream.schema(schema).parquet(f"{root}/landed"))
            stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{root}/cp").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(result).parquet(out)


@query("smoothing_stream", f"WITH RECURSIVE {_DAILY}, {SMOOTHED.format(source='src')} SELECT universe_id, resolved_at_ns, applied, strikes AS applied_strikes FROM st")
def smoothing_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Strike smoothing with its state in a stream that is stopped and started again."""
    rows = daily_oi(spark, sf).select("universe_id", "resolved_at_ns", "strike_mode", F.col("selected_expiry_ns").cast("long").alias("selected_expiry_ns"), F.col("selected_strikes").cast("array<double>").alias("selected_strikes"))
    found = _in_two_runs(spark, rows, RESOLUTIONS, "resolved_at_ns", smooth_strikes_stream)
    return found.select("universe_id", "resolved_at_ns", "applied", F.array_join(F.transform("applied_strikes", lambda s: s.cast("long").cast("string")), ",").alias("applied_strikes"))


def metrics_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The online metrics with their state in a stream that is stopped and started again."""
    found = _in_two_runs(spark, surface_events(spark, sf), EVENTS, "ts_ns", lambda events: option_metrics_stream(events, D.DAY_NS))
    return found.select("universe_id", "ts_ns", "atm_strike", *r6("perp_mid", "atm_iv", "risk_reversal", "wing_richness"), "greeks_ready", "quotes_ready", "option_count")


# The same rows as the replay's, so the same statement.
QUERIES["metrics_stream"], ORACLES["metrics_stream"] = metrics_stream, ORACLES["online_option_metrics"]


@query(
    "id_forms",
    """WITH o AS (SELECT o_orderkey, ['DERIBIT','Bybit','okx','OTHER'][o_orderkey % 4 + 1] AS venue, ['BTC','ETH','SOL'][o_custkey % 3 + 1] AS und, CASE WHEN o_orderkey % 5 > 0 THEN 'USDT' END AS cur, o_custkey, o_totalprice FROM orders)
    SELECT o_orderkey, CASE upper(venue) WHEN 'DERIBIT' THEN und || '-PERPETUAL.DERIBIT' WHEN 'BYBIT' THEN und || cur || '-LINEAR.BYBIT' WHEN 'OKX' THEN und || '-' || cur || '-SWAP.OKX' END AS perp_id, und || '-' || o_custkey || '-OPTION' AS symbol,
    (o_custkey + o_orderkey % 100)::DOUBLE AS threshold_sum, 2::BIGINT AS threshold_count, CASE WHEN o_orderkey % 7 IN (0, 1, 2, 3) THEN NULL ELSE round(o_totalprice, 2) END AS metric FROM o""",
)
def id_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of perpetuals by venue, symbols, number lists with other parts, and metrics of which some are no number above zero."""
    k = F.col("o_orderkey")
    venue = F.element_at(F.array(*map(F.lit, ("DERIBIT", "Bybit", "okx", "OTHER"))), (k % 4 + 1).cast("int"))
    underlying = F.element_at(F.array(*map(F.lit, D.UNDERLYINGS)), (F.col("o_custkey") % 3 + 1).cast("int"))
    listed = S.thresholds(F.concat_ws(", ", F.col("o_custkey").cast("string"), F.lit("x"), (k % 100).cast("string"), F.lit("")))
    text = F.when(k % 7 == 0, "-1.5").when(k % 7 == 1, "abc").when(k % 7 == 2, "Infinity").when(k % 7 == 3, "0").otherwise(F.concat(F.lit(" "), F.col("o_totalprice").cast("string"), F.lit(" ")))
    return D.table(spark, sf, "orders").select(
        "o_orderkey", S.perp_id(venue, underlying, F.when(k % 5 > 0, "USDT")).alias("perp_id"), S.bybit_symbol(F.concat_ws("-", underlying, "o_custkey")).alias("symbol"),
        F.aggregate(listed, F.lit(0.0), lambda a, x: a + x.cast("double")).alias("threshold_sum"), F.size(listed).cast("long").alias("threshold_count"), F.round(S.parse_metric(text), 2).alias("metric"),
    )


@query("delta_batches", "SELECT 'L2-' || l_suppkey % 50 AS instrument_id, l_linenumber::BIGINT AS level, count(*) AS deltas, round(sum(l_extendedprice), 2) AS price, round(sum(l_quantity), 2) AS size FROM lineitem GROUP BY 1, 2")
def delta_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Book updates, one for each supplier's lines in an order, as single deltas."""
    lines = D.table(spark, sf, "lineitem")
    delta = F.struct(F.col("l_linenumber").cast("long").alias("level"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("size"))
    updates = lines.groupBy("l_orderkey", F.concat(F.lit("L2-"), F.col("l_suppkey") % 50).alias("instrument_id")).agg(F.collect_list(delta).alias("deltas"))
    found = sink.explode_deltas(updates).groupBy("instrument_id", "level")
    return found.agg(F.count(F.lit(1)).alias("deltas"), F.round(F.sum("price"), 2).alias("price"), F.round(F.sum("size"), 2).alias("size"))


@query(
    "open_parts",
    """WITH d AS (SELECT split_part(instrument_id, '-', 1) AS id, ts_init_ns // 86400000000000 AS day, count(*) AS n FROM trades_v GROUP BY 1, 2)
    SELECT 'open_part' AS rule, id || '/' || day AS key, '0' AS expected, (n % 5)::VARCHAR AS actual FROM d WHERE day % 3 > 0 UNION ALL SELECT 'sealed_files', 'catalog', '1000000000', (SELECT count(*) FROM d WHERE day % 3 = 0 AND n % 5 > 0)::VARCHAR""",
)
def open_parts(spark: SparkSession, sf: str) -> DataFrame:
    """What is left open in a catalog whose capture was cut: parts with and without bytes, beside sealed files, of which those without bytes don't count."""
    root = scratch(spark, "catalog")
    counts = _by_underlying(D.trades(spark, sf)).groupBy("instrument_id", S.whole("ts_init_ns", D.DAY_NS).alias("day")).agg(F.count(F.lit(1)).alias("n"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(root)
        for batch in batches:
            for id_, day, n in zip(*batch.columns, strict=True):
                place = f"{folder}/trades/instrument_id={id_}"
                store.create_dir(place, recursive=True)
                with store.open_output_stream(f"{place}/{day}.parquet{'.part' if day.as_py() % 3 else ''}", compression=None) as out:
                    out.write(b"x" * (n.as_py() % 5))
            yield pa.RecordBatch.from_arrays([batch.column(2)], names=["n"])

    counts.mapInArrow(write, "n long").agg(F.sum("n")).collect()
    found = validate.no_open_parts(spark, root, least_sealed=1_000_000_000)
    place = F.concat(F.regexp_extract("key", "instrument_id=([^/]+)/", 1), F.lit("/"), F.regexp_extract("key", r"/(\d+)\.parquet", 1))
    return found.withColumn("key", F.when(F.col("rule") == "open_part", place).otherwise("catalog"))


@query(
    "validate_outcome_capture",
    f"""WITH {MARKETS}, f AS (SELECT snapshot_id || ':' || universe_id AS k, question_id AS q, question_id % 7 AS m, question_id % 3 AS t, string_split(ids, ',') AS l FROM market),
    r AS (SELECT k, q, l FROM f WHERE m NOT IN (0, 2, 3) UNION ALL SELECT k, q, l FROM f WHERE m = 1 UNION ALL SELECT k, q + 1, l FROM f WHERE m = 2 UNION ALL SELECT k, q, l[1:1] FROM f WHERE m = 3),
    seen AS (SELECT unnest(l) AS id FROM f WHERE t > 0 UNION SELECT l[1] FROM f), s AS (SELECT k, count(*) AS n, max(q) AS q, max(len(l)) AS ids FROM r GROUP BY 1), j AS (SELECT f.k, f.q AS found, s.n, s.q, s.ids FROM f LEFT JOIN s USING (k))
    SELECT 'one_startup' AS rule, k AS key, '1' AS expected, coalesce(n, 0)::VARCHAR AS actual FROM j WHERE coalesce(n, 0) <> 1 UNION ALL SELECT 'question', k, found::VARCHAR, q::VARCHAR FROM j WHERE found IS DISTINCT FROM q
    UNION ALL SELECT 'outcome_ids', k, '2', ids::VARCHAR FROM j WHERE coalesce(ids, 0) < 2 UNION ALL SELECT DISTINCT 'outcome_rows', id, '1', '0' FROM (SELECT unnest(l) AS id FROM r) WHERE id NOT IN (SELECT id FROM seen)""",
)
def validate_outcome_capture(spark: SparkSession, sf: str) -> DataFrame:
    """Captures of each month's markets: some without or with two startup records, of another question, of one id, or without rows."""
    listed = D.listings(spark, sf)
    month = F.trunc(F.timestamp_micros(S.whole("listed_ns", 1000)).cast("date"), "month")
    question = F.struct("question", F.lit("q").alias("name"), "description", F.col("named_outcomes").alias("namedOutcomes"), F.col("fallback_outcome").alias("fallbackOutcome"))
    documents = listed.select(F.date_format(month, "yyyy-MM").alias("snapshot_id"), (F.unix_micros(F.date_add(month, 14).cast("timestamp")) * 1000).alias("now_ns"), F.to_json(F.struct(F.array(question).alias("questions"))).alias("payload"))
    markets = parked(outcomes.resolve_outcome_markets(documents, outcome_specs(spark)), "markets").select(F.concat_ws(":", "snapshot_id", "universe_id").alias("universe_id"), "question_id", "all_instrument_ids")
    m = F.col("question_id") % 7
    copies = F.explode(F.when(m == 0, F.array().cast("array<int>")).when(m == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    records = markets.select("universe_id", F.when(m == 2, F.col("question_id") + 1).otherwise(F.col("question_id")).alias("question_id"), F.when(m == 3, F.slice("all_instrument_ids", 1, 1)).otherwise(F.col("all_instrument_ids")).alias("all_instrument_ids"), copies).drop("col")
    rows = markets.select(F.explode(F.when(F.col("question_id") % 3 > 0, F.col("all_instrument_ids")).otherwise(F.slice("all_instrument_ids", 1, 1))).alias("instrument_id"))
    return validate.validate_outcome_capture(records, markets.select("universe_id", "question_id"), rows)
