"""Queries over the catalog: sinks, sealing, figures, validation, custom data and request jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mdlake.functions import scalars as S
from mdlake.operators import custom, lineage, presets, sealing, sink, validate
from mdlake.plans.plan_queries import SMOOTHED, resolved
from mdlake.plans.registry import query
from mdlake.plans.universe_queries import RESOLVED, r6
from mdlake.session import scratch
from mdlake.sources import catalog
from mdlake.sources import derived as D
from mdlake.streaming.online_metrics import replay_option_metrics

_SEAL_DATE = "(make_timestamp((ts_init_ns // 1000)::BIGINT) + INTERVAL 18 HOUR)::DATE"
TRADE_SCHEMA = "instrument_id string, price double, size double, ts_event_ns bigint, ts_init_ns bigint, seq bigint, seal_date date"


def _histories(spark: SparkSession, sf: str) -> DataFrame:
    return sink.with_seal_date(D.trades_hist(spark, sf)).drop("seal_end_ns")


def _by_series(df: DataFrame) -> DataFrame:
    """Rows filed under their series (underlying and expiry), so that a daily partition holds more than a row or two."""
    return df.withColumn("instrument_id", F.substring_index("instrument_id", "-", 2))


_SERIES = "array_to_string(string_split(instrument_id, '-')[1:2], '-')"


@query(
    "seal",
    f"WITH t AS (SELECT * FROM trades_v UNION ALL SELECT * FROM trades_v WHERE seq % 5 = 0) SELECT {_SERIES} AS instrument_id, strftime({_SEAL_DATE}, '%Y-%m-%d') AS seal_date, count(*) AS rows, round(sum(price), 4) AS price, min(ts_init_ns) AS min_ts_ns, max(ts_init_ns) AS max_ts_ns FROM t GROUP BY 1, 2",
)
def seal(spark: SparkSession, sf: str) -> DataFrame:
    """Trades of two captures that number their batches alike, the second with equal rows: windows up to a middle date, then
    all others, then nothing more."""
    root = scratch(spark, "catalog")
    rows = sink.with_seal_date(_by_series(D.trades(spark, sf))).drop("seal_end_ns")
    for k, part in enumerate((rows, rows.filter("seq % 5 = 0"))):
        sealing.stage(part, f"{root}/_staging/trades", 0, f"capture-{k}")
    dates = sorted(d for _, d in sealing.staged_windows(spark, f"{root}/_staging/trades"))
    for until in (dates[len(dates) // 2] if dates else None, None, None):
        sealing.seal(spark, root, "trades", TRADE_SCHEMA, f"{root}/_staging/trades", until)
    sealed = catalog.read_family(spark, root, "trades", schema=TRADE_SCHEMA)
    return sealed.groupBy("instrument_id", F.date_format("seal_date", "yyyy-MM-dd").alias("seal_date")).agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("price"), 4).alias("price"), F.min("ts_init_ns").alias("min_ts_ns"), F.max("ts_init_ns").alias("max_ts_ns"))


@query("recover", "SELECT instrument_id, count(*) AS rows, min(ts_init_ns) AS min_ts_ns, max(ts_init_ns) AS max_ts_ns FROM trades_hist_v GROUP BY 1")
def recover(spark: SparkSession, sf: str) -> DataFrame:
    """Trade histories that a crash left as open parts beside an empty and a corrupt one; what is read after recovery."""
    root = scratch(spark, "catalog")
    D.trades_hist(spark, sf).repartition("instrument_id").write.partitionBy("instrument_id").parquet(f"{root}/trades")
    fs, _ = sealing.file_system(spark, root)
    for status in fs.globStatus(sealing.file_system(spark, f"{root}/trades/*/*.parquet")[1]):
        fs.rename(status.getPath(), status.getPath().suffix(".part"))
    fs.create(sealing.file_system(spark, f"{root}/trades/instrument_id=empty/a.parquet.part")[1]).close()
    spark.range(1).select(F.lit("no footer").alias("value")).coalesce(1).write.text(f"{root}/trades/instrument_id=broken")
    for status in fs.globStatus(sealing.file_system(spark, f"{root}/trades/instrument_id=broken/part-*")[1]):
        fs.rename(status.getPath(), status.getPath().suffix(".parquet.part"))
    schema = TRADE_SCHEMA.replace(", seal_date date", "").replace("instrument_id string, ", "")
    sealing.recover(spark, f"{root}/trades", schema)
    back = spark.read.schema(f"{schema}, instrument_id string").option("pathGlobFilter", "*.parquet").parquet(f"{root}/trades")
    return back.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("rows"), F.min("ts_init_ns").alias("min_ts_ns"), F.max("ts_init_ns").alias("max_ts_ns"))


@query("manifest", f"SELECT 'trades' AS family, {_SERIES} AS instrument_id, count(*) AS rows, min(ts_init_ns) AS min_ts_ns, max(ts_init_ns) AS max_ts_ns, count(DISTINCT {_SEAL_DATE}) AS partitions, true AS has_bytes FROM trades_v GROUP BY 2")
def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Trades written as chunks, and the manifest from the files' footers and sizes."""
    root = scratch(spark, "catalog")
    sink.write_chunk(_by_series(D.trades(spark, sf)), root, "trades")
    parts = catalog.partition_manifest(spark, root, ["trades"])
    return parts.groupBy("family", "instrument_id").agg(F.sum("rows").alias("rows"), F.min("min_ts_ns").alias("min_ts_ns"), F.max("max_ts_ns").alias("max_ts_ns"), F.count(F.lit(1)).alias("partitions"), ((F.min("bytes") > 0) & (F.min("files") > 0)).alias("has_bytes"))


@query("count_rows", f"SELECT 'quotes' AS family, {_SERIES} AS instrument_id, count(*) AS rows FROM quotes_v GROUP BY 2 UNION ALL SELECT 'trades', {_SERIES}, count(*) FROM trades_v GROUP BY 2")
def count_rows(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch(spark, "catalog")
    sink.write_chunk(_by_series(D.quotes(spark, sf)), root, "quotes")
    sink.write_chunk(_by_series(D.trades(spark, sf)), root, "trades")
    return catalog.count_rows(spark, root, ["quotes", "trades", "bars"])


@query("partition_stats", f"SELECT instrument_id, strftime({_SEAL_DATE}, '%Y-%m-%d') AS seal_date, count(*) AS rows, min(ts_init_ns) AS min_ts_ns, max(ts_init_ns) AS max_ts_ns, 'trades|Trade|' || instrument_id || '|_' AS stable_key FROM trades_hist_v GROUP BY 1, 2")
def partition_stats(spark: SparkSession, sf: str) -> DataFrame:
    return sink.partition_stats(_histories(spark, sf)).withColumn("seal_date", F.date_format("seal_date", "yyyy-MM-dd"))


def _files(spark: SparkSession, sf: str) -> DataFrame:
    return sink.partition_stats(_histories(spark, sf))


@query(
    "capacity_report",
    f"""WITH f AS (SELECT instrument_id, count(*) AS rows, (max(ts_init_ns) - min(ts_init_ns)) / 1000000000 AS span_s FROM trades_hist_v GROUP BY 1)
    SELECT instrument_id, rows, round(rows / span_s, 9) AS rows_per_s, ceil(rows / span_s * 86400 / 50000)::BIGINT AS groups_per_day, ceil(rows / span_s * 86400 * 10 / 32767)::BIGINT AS least_group_rows FROM f WHERE span_s > 0""",
)
def capacity_report(spark: SparkSession, sf: str) -> DataFrame:
    found = sink.capacity_report(_files(spark, sf)).filter("span_s > 0")
    return found.select("instrument_id", "rows", F.round("rows_per_s", 9).alias("rows_per_s"), "groups_per_day", "least_group_rows")


_FILE_ROWS = 7


@query(
    "capture_metrics",
    f"""WITH t AS (SELECT CASE WHEN instrument_id LIKE '%-C.%' THEN 'calls' ELSE 'puts' END AS family, {_SERIES} AS series, {_SEAL_DATE} AS day FROM trades_v), f AS (SELECT family, count(*) AS n FROM t GROUP BY family, series, day)
    SELECT family, sum(n)::BIGINT AS accepted, sum(ceil(n / {_FILE_ROWS}))::BIGINT AS files, sum(n // {_FILE_ROWS})::BIGINT AS flush_rows, count(*) FILTER (WHERE n % {_FILE_ROWS} > 0) AS flush_seal, true AS has_bytes, true AS mean_fits, 0::BIGINT AS dropped FROM f GROUP BY ROLLUP (family)""",
)
def capture_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Trades of calls and puts in files of a few rows; files, bytes and rows are those that were written."""
    root = scratch(spark, "catalog")
    rows, names = D.trades(spark, sf), {"calls": "instrument_id LIKE '%-C.%'", "puts": "NOT instrument_id LIKE '%-C.%'"}
    for family, which in names.items():
        sink.write_limited(_by_series(rows.filter(which)), root, family, _FILE_ROWS)
    files = catalog.file_sizes(spark, root, "calls").union(catalog.file_sizes(spark, root, "puts"))
    dropped = sink.quarantined(rows)[1].groupBy(F.lit("calls").alias("family")).agg(F.count(F.lit(1)).alias("n"))
    found = sink.capture_metrics(sink.flushes(files, _FILE_ROWS), dropped)
    fits = (F.col("mean_file_bytes") * F.col("files") <= F.col("bytes")) & ((F.col("mean_file_bytes") + 1) * F.col("files") > F.col("bytes"))
    return found.select("family", "accepted", "files", "flush_rows", "flush_seal", (F.col("bytes") > F.col("files")).alias("has_bytes"), fits.alias("mean_fits"), "dropped")


@query(
    "metrics_ok",
    """WITH f AS (SELECT split_part(instrument_id, '-', 1) AS family, count(*) AS rows FROM trades_hist_v GROUP BY 1), w AS (SELECT family, CASE WHEN family = 'ETH' THEN 0 ELSE rows END AS accepted, CASE WHEN family = 'SOL' THEN 1 ELSE 0 END AS dropped FROM f)
    SELECT family, 'dropped' AS rule FROM w WHERE dropped > 0 UNION ALL SELECT family, 'accepted' FROM w WHERE accepted <= 0 UNION ALL SELECT NULL, 'dropped' FROM w HAVING sum(dropped) > 0 UNION ALL SELECT NULL, 'accepted' FROM w HAVING sum(accepted) <= 0""",
)
def metrics_ok(spark: SparkSession, sf: str) -> DataFrame:
    """Writes by underlying: one of them accepted no row, of another a row without an id was dropped."""
    family = F.substring_index("instrument_id", "-", 1)
    rows = _histories(spark, sf)
    writes = rows.groupBy(family.alias("family")).agg(F.count(F.lit(1)).alias("n")).select("family", F.when(F.col("family") == "ETH", 0).otherwise(F.col("n")).alias("rows"), (F.col("n") * 0 + 1).alias("bytes"), F.lit("seal").alias("reason"))
    lost = rows.filter(family == "SOL").orderBy("ts_init_ns", "seq").limit(1).withColumns({"of": family, "instrument_id": F.lit(None).cast("string")})
    dropped = sink.quarantined(lost)[1].groupBy(F.col("of").alias("family")).agg(F.count(F.lit(1)).alias("n"))
    return sink.metrics_ok(sink.capture_metrics(writes, dropped))


@query(
    "disjoint_intervals",
    """WITH RECURSIVE b AS (SELECT o_custkey, o_orderkey, o_orderkey % 97 AS s, o_orderkey % 89 AS e, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders),
    r AS (SELECT o_custkey, o_orderkey, n, s AS file_start, greatest(s, e) AS file_end FROM b WHERE n = 1
      UNION ALL SELECT b.o_custkey, b.o_orderkey, b.n, CASE WHEN b.s <= r.file_end THEN r.file_end + 1 ELSE b.s END, greatest(CASE WHEN b.s <= r.file_end THEN r.file_end + 1 ELSE b.s END, b.e) FROM r JOIN b ON b.o_custkey = r.o_custkey AND b.n = r.n + 1)
    SELECT o_orderkey, file_start, file_end FROM r""",
)
def disjoint_intervals(spark: SparkSession, sf: str) -> DataFrame:
    batches = D.table(spark, sf, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 97).alias("start_ns"), (F.col("o_orderkey") % 89).alias("end_ns"))
    return sink.disjoint_intervals(batches, "o_custkey", "o_orderkey").select("o_orderkey", "file_start", "file_end")


@query("forward_prices", "SELECT instrument_id, ts_event_ns, underlying_price AS forward_price, 'option_greeks_underlying_price' AS source FROM greeks_v WHERE underlying_price IS NOT NULL")
def forward_prices(spark: SparkSession, sf: str) -> DataFrame:
    return sink.forward_prices(D.greeks(spark, sf)).select("instrument_id", "ts_event_ns", F.col("forward_price").cast("double").alias("forward_price"), "source")


@query("latest_definitions", "SELECT o_custkey::VARCHAR AS instrument_id, arg_max(o_orderkey, (epoch_us(o_orderdate), o_orderkey)) AS seq, arg_max(o_totalprice, (epoch_us(o_orderdate), o_orderkey)) AS price FROM orders GROUP BY 1")
def latest_definitions(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("instrument_id"), F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("price"), D.nanos(F.col("o_orderdate")).alias("ts_init_ns"))
    return catalog.latest_definitions(rows).select("instrument_id", "seq", "price")


@query("check_ascending", "SELECT 'ascending' AS rule, 'all' AS key, b::VARCHAR AS expected, user_id::VARCHAR AS actual FROM (SELECT user_id, lag(user_id) OVER (ORDER BY event_id) AS b FROM events) WHERE user_id < b")
def check_ascending(spark: SparkSession, sf: str) -> DataFrame:
    return validate.check_ascending(validate.file_order(D.table(spark, sf, "events")), ts="user_id")


@query("id_matches", "SELECT 'id' AS rule, (event_id % 50)::VARCHAR AS key, '0' AS expected, count(*)::VARCHAR AS actual FROM events WHERE user_id % 50 <> event_id % 50 GROUP BY event_id % 50")
def id_matches(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.table(spark, sf, "events").select((F.col("event_id") % 50).cast("string").alias("partition_id"), (F.col("user_id") % 50).cast("string").alias("instrument_id"))
    return validate.id_matches(rows)


@query("readback_counts", "WITH c AS (SELECT instrument_id, 'q' AS f FROM quotes_v UNION ALL SELECT instrument_id, 'g' FROM greeks_v UNION ALL SELECT instrument_id, 't' FROM trades_v) SELECT instrument_id, count(*) FILTER (WHERE f = 'q') AS quotes, count(*) FILTER (WHERE f = 'g') AS option_greeks, count(*) FILTER (WHERE f = 't') AS trades FROM c GROUP BY 1")
def readback_counts(spark: SparkSession, sf: str) -> DataFrame:
    return validate.readback_counts({"quotes": D.quotes(spark, sf), "option_greeks": D.greeks(spark, sf), "trades": D.trades(spark, sf)})


def _greeks(spark: SparkSession, sf: str) -> DataFrame:
    """Greeks with one sensitivity that is missing, infinite or not a number now and then."""
    odd = F.when(F.col("seq") % 11 == 0, F.lit(None).cast("double")).when(F.col("seq") % 13 == 0, F.lit(float("nan"))).when(F.col("seq") % 17 == 0, F.lit(float("inf"))).otherwise(F.col("delta"))
    return D.greeks(spark, sf).withColumns({"gamma": odd, "vega": F.col("delta"), "theta": F.col("delta")})


@query(
    "greeks_ok",
    """WITH l AS (SELECT instrument_id, max(seq) AS seq FROM greeks_v GROUP BY 1), g AS (SELECT * FROM l JOIN greeks_v USING (instrument_id, seq))
    SELECT 'greeks:mark_iv' AS rule, instrument_id AS key, 'finite' AS expected FROM g WHERE mark_iv IS NULL UNION ALL SELECT 'greeks:gamma', instrument_id, 'finite' FROM g WHERE seq % 11 = 0 OR seq % 13 = 0 OR seq % 17 = 0""",
)
def greeks_ok(spark: SparkSession, sf: str) -> DataFrame:
    return validate.greeks_ok(_greeks(spark, sf)).select("rule", "key", "expected")


def _universes(spark: SparkSession, sf: str) -> DataFrame:
    """Every expiry of an underlying as a universe."""
    return D.options(spark, sf).select(F.concat("underlying", F.lit(":"), F.col("expiration_ns").cast("string")).alias("universe_id"), "instrument_id", "strike")


_UNI = "u AS (SELECT underlying || ':' || expiration_ns AS universe_id, instrument_id, strike FROM options_v)"


@query("any_option_has", f"WITH {_UNI}, c AS (SELECT instrument_id, count(*) AS n FROM trades_v GROUP BY 1) SELECT 'any:trades' AS rule, universe_id AS key, '14' AS expected, max(coalesce(n, 0))::VARCHAR AS actual FROM u LEFT JOIN c USING (instrument_id) GROUP BY 2 HAVING max(coalesce(n, 0)) < 14")
def any_option_has(spark: SparkSession, sf: str) -> DataFrame:
    return validate.any_option_has(_universes(spark, sf), D.trades(spark, sf), 14, "trades")


@query("with_quotes", f"WITH {_UNI}, m AS (SELECT u.*, instrument_id IN (SELECT instrument_id FROM quotes_v) AS q FROM u) SELECT universe_id, instrument_id FROM m QUALIFY q OR NOT bool_or(q) OVER (PARTITION BY universe_id)")
def with_quotes(spark: SparkSession, sf: str) -> DataFrame:
    return validate.with_quotes(_universes(spark, sf), D.quotes(spark, sf))


@query(
    "sample_center",
    f"""WITH {_UNI}, n AS (SELECT *, row_number() OVER (PARTITION BY universe_id ORDER BY strike, instrument_id) - 1 AS i, count(*) OVER (PARTITION BY universe_id) AS n FROM u), s AS (SELECT *, least(greatest(n // 2 - 3, 0) + 6, n) AS stop FROM n)
    SELECT universe_id, string_agg(instrument_id, ',' ORDER BY i) AS sample FROM s WHERE n <= 6 OR (i >= stop - 6 AND i < stop) GROUP BY 1""",
)
def sample_center(spark: SparkSession, sf: str) -> DataFrame:
    return validate.sampled_options(_universes(spark, sf)).select("universe_id", F.array_join("sample", ",").alias("sample"))


BAR_TYPES = tuple(f"{u}-PERPETUAL.DERIBIT-1-DAY-BID" for u in D.UNDERLYINGS)


def _readback_families(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Families that break each rule somewhere: two options in eleven lack a definition, SOL has no index, mark or funding rows."""
    quotes = D.quotes(spark, sf)
    perps = quotes.filter("instrument_id LIKE '%-PERPETUAL.%'")
    some = perps.filter("instrument_id NOT LIKE 'SOL-%'").withColumn("value", F.col("bid_price"))
    bars = perps.filter("instrument_id LIKE 'BTC-%'").select("instrument_id", "bid_price", F.concat("instrument_id", F.lit("-1-DAY-BID")).alias("bar_type"), S.whole(F.col("ts_event_ns"), D.DAY_NS).alias("day"))
    members = D.options(spark, sf)
    return {
        "instruments": members.filter("p_partkey % 11 NOT IN (3, 4)").select("instrument_id").union(perps.select("instrument_id").distinct()),
        "quotes": quotes,
        "mark_prices": some.union(quotes.filter("instrument_id NOT LIKE '%-PERPETUAL.%' AND seq % 2 = 0").withColumn("value", F.col("bid_price"))),
        "index_prices": some,
        "funding_rate_update": some.filter("seq % 8 = 0"),
        "trades": D.trades(spark, sf).filter("instrument_id NOT LIKE 'ETH-%'"),
        "option_greeks": _greeks(spark, sf),
        "bars": bars.groupBy("instrument_id", "bar_type", "day").agg(F.last("bid_price").alias("close")),
    }


_READBACK = f"""{{universes}},
p AS (SELECT * FROM quotes_v WHERE instrument_id LIKE '%-PERPETUAL.%'),
m AS (SELECT instrument_id, 'option' AS role, p_partkey FROM options_v UNION ALL SELECT DISTINCT instrument_id, 'perp', NULL FROM p),
priced AS (SELECT * FROM p WHERE instrument_id NOT LIKE 'SOL-%'),
rows AS (SELECT 'instruments' AS f, instrument_id FROM m WHERE p_partkey IS NULL OR p_partkey % 11 NOT IN (3, 4) UNION ALL SELECT 'quotes', instrument_id FROM quotes_v UNION ALL SELECT 'mark_prices', instrument_id FROM priced
  UNION ALL SELECT 'mark_prices', instrument_id FROM quotes_v WHERE instrument_id NOT LIKE '%-PERPETUAL.%' AND seq % 2 = 0 UNION ALL SELECT 'index_prices', instrument_id FROM priced UNION ALL SELECT 'funding_rate_update', instrument_id FROM priced WHERE seq % 8 = 0
  UNION ALL SELECT 'option_greeks', instrument_id FROM greeks_v),
n AS (SELECT f, instrument_id, count(*) AS n FROM rows GROUP BY 1, 2),
want(f, role, least) AS (VALUES ('instruments', 'perp', 1), ('instruments', 'option', 1), ('quotes', 'perp', 9), ('quotes', 'option', 9), ('mark_prices', 'perp', 9), ('mark_prices', 'option', 9), ('index_prices', 'perp', 9), ('option_greeks', 'option', 9), ('funding_rate_update', 'perp', 1), ('trades', 'perp', 1)),
t AS (SELECT instrument_id, count(*) AS n FROM trades_v WHERE instrument_id NOT LIKE 'ETH-%' GROUP BY 1),
l AS (SELECT instrument_id, max(seq) AS seq FROM greeks_v GROUP BY 1), g AS (SELECT * FROM l JOIN greeks_v USING (instrument_id, seq))
SELECT 'min_rows:' || want.f AS rule, m.instrument_id AS key, least::VARCHAR AS expected, coalesce(n, 0)::VARCHAR AS actual FROM want JOIN m USING (role) LEFT JOIN n ON n.f = want.f AND n.instrument_id = m.instrument_id WHERE coalesce(n, 0) < least
UNION ALL SELECT 'any:trades', universe_id, '3', max(coalesce(n, 0))::VARCHAR FROM u LEFT JOIN t USING (instrument_id) GROUP BY 2 HAVING max(coalesce(n, 0)) < 3
UNION ALL SELECT 'greeks:mark_iv', instrument_id, 'finite', '-' FROM g WHERE mark_iv IS NULL UNION ALL SELECT 'greeks:gamma', instrument_id, 'finite', '-' FROM g WHERE seq % 11 = 0 OR seq % 13 = 0 OR seq % 17 = 0
UNION ALL SELECT 'bars', und || '-PERPETUAL.DERIBIT-1-DAY-BID', '9', '0' FROM (VALUES ('ETH'), ('SOL')) x(und)"""


def _roles(spark: SparkSession, sf: str) -> DataFrame:
    perps = D.quotes(spark, sf).filter("instrument_id LIKE '%-PERPETUAL.%'").select(F.concat(F.substring_index("instrument_id", "-", 1), F.lit(":perp")).alias("universe_id"), "instrument_id", F.lit("perp").alias("role")).distinct()
    return _universes(spark, sf).select("universe_id", "instrument_id", F.lit("option").alias("role")).union(perps)


@query("validate_readback", "WITH " + _READBACK.format(universes=_UNI))
def validate_readback(spark: SparkSession, sf: str) -> DataFrame:
    """All rules over all members; infinite sensitivities print differently, so their values are left out."""
    checks = presets.overridden(presets.PRESETS["venue_trades"], min_rows=9, min_option_trades=3, bar_types=BAR_TYPES)
    found = validate.validate_readback(_roles(spark, sf), _readback_families(spark, sf), checks)
    return found.withColumn("actual", F.when(F.col("rule").startswith("greeks:"), "-").otherwise(F.col("actual")))


@query(
    "validate_skipping_options",
    f"""WITH {_UNI}, d AS (SELECT instrument_id, count(*) AS n FROM trades_v WHERE instrument_id NOT LIKE 'ETH-%' GROUP BY 1)
    SELECT 'min_rows:instruments' AS rule, instrument_id AS key, '1' AS expected, '0' AS actual FROM options_v WHERE p_partkey % 11 IN (3, 4)
    UNION ALL SELECT 'any:order_book_deltas', universe_id, '3', max(coalesce(n, 0))::VARCHAR FROM u LEFT JOIN d USING (instrument_id) GROUP BY 2 HAVING max(coalesce(n, 0)) < 3
    UNION ALL SELECT 'bars', und || '-PERPETUAL.DERIBIT-1-DAY-BID', '1', '0' FROM (VALUES ('ETH'), ('SOL')) x(und)""",
)
def validate_skipping_options(spark: SparkSession, sf: str) -> DataFrame:
    """Definitions, bars and book deltas alone; trades stand for deltas."""
    families = _readback_families(spark, sf)
    families["order_book_deltas"] = families.pop("trades")
    checks = presets.overridden(presets.PRESETS["book_deltas_smoke"], min_option_deltas=3, bar_types=BAR_TYPES)
    return validate.validate_readback(_roles(spark, sf), families, checks)


def _small_catalog(spark: SparkSession, sf: str) -> tuple[str, list[str]]:
    """A catalog by series and month that lacks something of every kind, some families under their other names."""
    root = scratch(spark, "catalog")
    series = F.substring_index("instrument_id", "-", 2)
    month = F.trunc(F.timestamp_micros(S.whole(F.col("ts_init_ns"), 1000)).cast("date"), "month")
    quotes, trades, greeks = (f(spark, sf).select(series.alias("instrument_id"), "ts_init_ns", "seq", month.alias("seal_date")) for f in (D.quotes, D.trades, D.greeks))
    perps = quotes.filter("instrument_id LIKE '%-PERPETUAL.%'")
    families = {
        "instruments": quotes.filter("instrument_id NOT LIKE 'ETH-E2%'").groupBy("instrument_id", "seal_date").agg(F.min("ts_init_ns").alias("ts_init_ns"), F.min("seq").alias("seq")).select("instrument_id", "ts_init_ns", "seq", "seal_date"),
        "quotes": quotes,
        "mark_prices": quotes.filter("instrument_id NOT LIKE 'SOL-P%'"),
        "index_prices": perps.filter("instrument_id NOT LIKE 'SOL-%'"),
        "funding_rates": perps.filter("seq % 8 = 0"),
        "trades": trades.filter("instrument_id NOT LIKE 'ETH-%'"),
        "book_deltas": trades.filter("instrument_id LIKE 'BTC-%'"),
        "option_greeks": greeks.filter("instrument_id NOT LIKE 'BTC-E0%'"),
        "instrument_status": perps,
    }
    for name, rows in families.items():
        rows.repartition("instrument_id", "seal_date").write.partitionBy("instrument_id", "seal_date").parquet(f"{root}/{name}")
    return root, ["instruments", "quotes", "mark_prices", "index_prices", "funding_rate_update", "trades", "order_book_deltas", "option_greeks", "instrument_status", "instrument_closes"]


_SMALL = f"""q AS (SELECT {_SERIES} AS instrument_id, ts_init_ns, seq FROM quotes_v), t AS (SELECT {_SERIES} AS instrument_id, ts_init_ns FROM trades_v), g AS (SELECT {_SERIES} AS instrument_id, ts_init_ns FROM greeks_v),
rows AS (SELECT 'instruments' AS family, instrument_id, min(ts_init_ns) AS ts FROM q WHERE instrument_id NOT LIKE 'ETH-E2%' GROUP BY instrument_id, date_trunc('month', make_timestamp((ts_init_ns // 1000)::BIGINT)) UNION ALL SELECT 'quotes', instrument_id, ts_init_ns FROM q
  UNION ALL SELECT 'mark_prices', instrument_id, ts_init_ns FROM q WHERE instrument_id NOT LIKE 'SOL-P%' UNION ALL SELECT 'index_prices', instrument_id, ts_init_ns FROM q WHERE instrument_id LIKE '%-PERPETUAL.%' AND instrument_id NOT LIKE 'SOL-%'
  UNION ALL SELECT 'funding_rate_update', instrument_id, ts_init_ns FROM q WHERE instrument_id LIKE '%-PERPETUAL.%' AND seq % 8 = 0 UNION ALL SELECT 'trades', instrument_id, ts_init_ns FROM t WHERE instrument_id NOT LIKE 'ETH-%'
  UNION ALL SELECT 'order_book_deltas', instrument_id, ts_init_ns FROM t WHERE instrument_id LIKE 'BTC-%' UNION ALL SELECT 'option_greeks', instrument_id, ts_init_ns FROM g WHERE instrument_id NOT LIKE 'BTC-E0%' UNION ALL SELECT 'instrument_status', instrument_id, ts_init_ns FROM q WHERE instrument_id LIKE '%-PERPETUAL.%'),
n AS (SELECT family, instrument_id, count(*) AS n FROM rows GROUP BY 1, 2),
m AS (SELECT DISTINCT split_part(instrument_id, '-', 1) AS universe_id, {_SERIES} AS instrument_id, 'option' AS role FROM options_v UNION ALL SELECT DISTINCT split_part(instrument_id, '-', 1), instrument_id, 'perp' FROM q WHERE instrument_id LIKE '%-PERPETUAL.%')"""

CHECK_SETS = {
    "plain": presets.checks_for(venues=["DERIBIT"], families=["quotes"]),
    "trades": presets.checks_for(venues=["OKX-1"], families=["trades"]),
    "forward": presets.checks_for(families=["forward_prices"]),
    "refresh": presets.Checks(refresh_change=True),
    "state": presets.Checks(contract_state=True, min_rows=40),
    "deltas": presets.overridden(presets.PRESETS["book_deltas_smoke"], min_option_deltas=3),
    "bars": presets.overridden(presets.PRESETS["bars_smoke"], bar_types=("BTC-PERPETUAL.DERIBIT-1-DAY-BID", "SOL-PERPETUAL.DERIBIT-1-DAY-BID")),
}


@query(
    "validate_manifest",
    f"""WITH {_SMALL},
    sets(checks, least) AS (VALUES ('plain', 1), ('trades', 1), ('forward', 1), ('refresh', 1), ('state', 40), ('deltas', NULL), ('bars', NULL)),
    want AS (SELECT checks, 'instruments' AS family, 'any' AS role, 1 AS least FROM sets UNION ALL SELECT checks, f, r, least FROM sets, (VALUES ('quotes', 'perp'), ('mark_prices', 'perp'), ('index_prices', 'perp'), ('quotes', 'option'), ('mark_prices', 'option'), ('option_greeks', 'option')) x(f, r) WHERE least IS NOT NULL
      UNION ALL SELECT checks, 'funding_rate_update', 'perp', 1 FROM sets WHERE least IS NOT NULL UNION ALL VALUES ('trades', 'trades', 'perp', 1), ('state', 'instrument_status', 'any', 1), ('state', 'instrument_closes', 'any', 1)),
    best(checks, family, least) AS (VALUES ('trades', 'trades', 1), ('deltas', 'order_book_deltas', 3)),
    d AS (SELECT underlying, row_number() OVER (PARTITION BY underlying ORDER BY now_ns) AS i FROM requests_v)
    SELECT checks, 'min_rows:' || w.family AS rule, m.instrument_id AS key, least::VARCHAR AS expected, coalesce(n, 0)::VARCHAR AS actual FROM want w JOIN m ON w.role IN ('any', m.role) LEFT JOIN n ON n.family = w.family AND n.instrument_id = m.instrument_id WHERE coalesce(n, 0) < least
    UNION ALL SELECT checks, 'any:' || b.family, universe_id, any_value(least)::VARCHAR, max(coalesce(n, 0))::VARCHAR FROM best b CROSS JOIN m LEFT JOIN n ON n.family = b.family AND n.instrument_id = m.instrument_id WHERE m.role = 'option' GROUP BY checks, b.family, universe_id HAVING max(coalesce(n, 0)) < any_value(least)
    UNION ALL SELECT 'forward', 'forward_prices', universe_id, '1', '0' FROM m WHERE role = 'option' GROUP BY universe_id HAVING count(*) FILTER (WHERE instrument_id IN (SELECT instrument_id FROM g WHERE instrument_id LIKE 'BTC-%')) = 0
    UNION ALL SELECT 'refresh', 'refresh_change', universe_id, '1', '0' FROM (SELECT DISTINCT universe_id FROM m) WHERE universe_id NOT IN (SELECT underlying FROM d WHERE i > 1 AND i % 5 = 0 AND underlying <> 'SOL')
    UNION ALL SELECT 'bars', 'bars', 'SOL-PERPETUAL.DERIBIT-1-DAY-BID', '1', '0'""",
)
def validate_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Seven sets of checks against one catalog, by footers, a forward-price log and the refreshes of universes; each switch asks for rows that some lack."""
    root, families = _small_catalog(spark, sf)
    counts = catalog.count_rows(spark, root, families)
    options = D.options(spark, sf).select(F.col("underlying").alias("universe_id"), F.substring_index("instrument_id", "-", 2).alias("instrument_id"), F.lit("option").alias("role")).distinct()
    perps = counts.filter("family = 'quotes' AND instrument_id LIKE '%-PERPETUAL.%'").select(F.substring_index("instrument_id", "-", 1).alias("universe_id"), "instrument_id", F.lit("perp").alias("role"))
    log = f"{root}/forward_prices"
    sink.write_forward_prices(_by_series(D.greeks(spark, sf).filter("instrument_id LIKE 'BTC-%'")), log)
    place = Window.partitionBy("underlying").orderBy("now_ns")
    records = D.requests(spark, sf).select(F.col("underlying").alias("universe_id"), F.row_number().over(place).alias("i")).filter("i = 1 OR (i % 5 = 0 AND universe_id <> 'SOL')").select("universe_id", F.when(F.col("i") == 1, "startup").otherwise("refresh").alias("event_kind"))
    bars = D.quotes(spark, sf).filter("instrument_id LIKE 'BTC-PERPETUAL.%'").groupBy(F.concat("instrument_id", F.lit("-1-DAY-BID")).alias("bar_type")).agg(F.count(F.lit(1)).alias("rows"))
    return validate.validate_manifest(options.union(perps), counts, bars, catalog.read_forward_prices(spark, log), records, validate.expectations(spark, CHECK_SETS))


@query(
    "inspect_catalog",
    f"""WITH {_SMALL}, f AS (SELECT family, count(DISTINCT instrument_id) AS ids, count(*) AS n, min(ts) AS low, max(ts) AS high FROM rows GROUP BY 1)
    SELECT 'inspect' AS section, 'instruments' AS rule, family AS key, NULL::VARCHAR AS expected, ids::VARCHAR AS actual FROM f UNION ALL SELECT 'inspect', 'rows', family, NULL, n::VARCHAR FROM f UNION ALL SELECT 'inspect', 'first_ns', family, NULL, low::VARCHAR FROM f UNION ALL SELECT 'inspect', 'last_ns', family, NULL, high::VARCHAR FROM f
    UNION ALL SELECT 'catalog', 'min_rows:trades', instrument_id, '1', '0' FROM m WHERE role = 'option' AND instrument_id NOT IN (SELECT instrument_id FROM n WHERE family = 'trades')""",
)
def inspect_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """What a catalog holds and what it lacks of trades, as sections of one report."""
    root, families = _small_catalog(spark, sf)
    found = catalog.partition_manifest(spark, root, families)
    options = D.options(spark, sf).select(F.lit("trades").alias("family"), F.substring_index("instrument_id", "-", 2).alias("instrument_id"), F.lit(1).alias("least")).distinct()
    return validate.suite(inspect=validate.inspect(found), catalog=validate.min_rows(options, catalog.count_rows(spark, root, ["trades"])))


@query(
    "readback_families",
    f"""WITH {_SMALL}, b AS (SELECT instrument_id, ts_init_ns // 86400000000000 AS day FROM q WHERE instrument_id LIKE '%-PERPETUAL.%')
    SELECT family, instrument_id AS key, n AS rows FROM n UNION ALL SELECT 'bars', instrument_id || '-1-DAY-BID', count(DISTINCT day) FROM b GROUP BY instrument_id""",
)
def readback_families(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of every family by instrument, of bars by bar type."""
    root, families = _small_catalog(spark, sf)
    perps = D.quotes(spark, sf).filter("instrument_id LIKE '%-PERPETUAL.%'")
    bars = perps.select(F.concat("instrument_id", F.lit("-1-DAY-BID")).alias("instrument_id"), S.whole(F.col("ts_init_ns"), D.DAY_NS).alias("day")).distinct()
    counts = catalog.count_rows(spark, root, families).union(validate.family_counts(bars, "bars"))
    return counts.select("family", F.col("instrument_id").alias("key"), "rows")


@query(
    "contract_state",
    """WITH s AS (SELECT 'I' || (user_id % 50) AS instrument_id, 'I' || (event_id % 50) AS partition_id, event_id, event_type FROM events WHERE event_type IN ('signup', 'error')),
    m AS (SELECT DISTINCT 'I' || (user_id % 60) AS instrument_id FROM events), x AS (SELECT *, lag(event_id % 1000) OVER (PARTITION BY instrument_id ORDER BY event_id) AS b FROM s)
    SELECT 'state:instrument_status' AS rule, instrument_id AS key, '1' AS expected, '0' AS actual FROM m WHERE instrument_id NOT IN (SELECT instrument_id FROM s)
    UNION ALL SELECT 'ascending:instrument_status', instrument_id, b::VARCHAR, (event_id % 1000)::VARCHAR FROM x WHERE event_id % 1000 < b
    UNION ALL SELECT 'id:instrument_status', partition_id, '0', count(*)::VARCHAR FROM s WHERE instrument_id <> partition_id GROUP BY partition_id""",
)
def contract_state(spark: SparkSession, sf: str) -> DataFrame:
    """State rows from events in file order: some instruments have none, times step back, ids differ from their partition's."""
    events = validate.file_order(D.table(spark, sf, "events"))
    ids = lambda c, n: F.concat(F.lit("I"), (F.col(c) % n).cast("string"))
    states = events.filter("event_type IN ('signup', 'error')").select(ids("user_id", 50).alias("instrument_id"), ids("event_id", 50).alias("partition_id"), (F.col("event_id") % 1000).alias("ts_init_ns"), "__path", "__row")
    return validate.contract_state(states, events.select(ids("user_id", 60).alias("instrument_id")), "instrument_status")


@query("forward_log", f"WITH {_UNI} SELECT 'forward_prices' AS rule, universe_id AS key FROM u GROUP BY 2 HAVING count(*) FILTER (WHERE instrument_id IN (SELECT instrument_id FROM greeks_v WHERE instrument_id LIKE 'BTC-%')) = 0")
def forward_log(spark: SparkSession, sf: str) -> DataFrame:
    """A log that was written for one underlying only."""
    log = sink.forward_prices(D.greeks(spark, sf)).filter("instrument_id LIKE 'BTC-%'")
    return validate.forward_log_not_empty(log, _universes(spark, sf)).select("rule", "key")


def _custom(spark: SparkSession, sf: str) -> DataFrame:
    """Custom rows from events; some of unknown type, on the wrong channel, of another venue or without their key."""
    e = D.table(spark, sf, "events")
    type_ = F.element_at(F.array(*map(F.lit, ("BinanceFuturesTicker", "DeribitVolatilityIndex", "HyperliquidOpenInterest", "DeribitBookSummary", "Other"))), (F.col("event_id") % 5 + 1).cast("int"))
    currency = F.when(F.col("event_id") % 7 == 0, "").otherwise("btc")
    meta = F.when(F.col("event_id") % 5 == 3, F.create_map(F.lit("currency"), currency)).when(F.col("event_id") % 2 == 0, F.create_map(F.lit("index_name"), F.lit("btc_dvol"))).otherwise(F.create_map().cast("map<string,string>"))
    venue = F.element_at(F.array(*map(F.lit, ("BINANCE", "DERIBIT", "HYPERLIQUID"))), (F.col("user_id") % 3 + 1).cast("int"))
    channel = F.when((F.col("event_id") % 5 == 3) != (F.col("event_id") % 11 == 0), "request").otherwise("subscribe")
    return e.select(type_.alias("type_name"), channel.alias("channel"), F.when(F.col("event_id") % 5 == 3, "BTC:option").alias("identifier"), F.concat(F.lit("I"), F.col("user_id").cast("string"), F.lit("."), venue).alias("instrument_id"), meta.alias("metadata"), F.col("event_id").alias("seq"))


@query(
    "check_custom",
    """WITH c AS (SELECT ['BinanceFuturesTicker','DeribitVolatilityIndex','HyperliquidOpenInterest','DeribitBookSummary','Other'][event_id % 5 + 1] AS type_name, ['BINANCE','DERIBIT','HYPERLIQUID','DERIBIT',NULL][event_id % 5 + 1] AS known, ['BINANCE','DERIBIT','HYPERLIQUID'][user_id % 3 + 1] AS venue, event_id, user_id FROM events)
    SELECT type_name, event_id AS seq, 'unknown_type' AS rule FROM c WHERE event_id % 5 = 4
    UNION ALL SELECT type_name, event_id, 'wrong_channel' FROM c WHERE event_id % 5 <> 4 AND event_id % 11 = 0
    UNION ALL SELECT type_name, event_id, 'missing_key' FROM c WHERE (event_id % 5 = 1 AND event_id % 2 = 1) OR (event_id % 5 = 3 AND event_id % 7 = 0)
    UNION ALL SELECT type_name, event_id, 'identifier' FROM c WHERE event_id % 5 = 3 AND event_id % 7 = 0
    UNION ALL SELECT type_name, event_id, 'venue' FROM c WHERE known <> venue""",
)
def check_custom(spark: SparkSession, sf: str) -> DataFrame:
    return custom.check_custom(_custom(spark, sf), custom.registry(spark)).select("type_name", "seq", "rule")


@query("distinct_ids", "SELECT ['BinanceFuturesTicker','DeribitVolatilityIndex','HyperliquidOpenInterest','DeribitBookSummary','Other'][event_id % 5 + 1] AS type_name, count(DISTINCT user_id) AS instruments FROM events GROUP BY 1")
def distinct_ids(spark: SparkSession, sf: str) -> DataFrame:
    return custom.distinct_ids(_custom(spark, sf))


MINUTES30 = 30 * 60_000_000_000


def _jobs(spark: SparkSession, sf: str) -> DataFrame:
    """A log of request jobs: purchases are responses, other events ticks."""
    e = D.table(spark, sf, "events")
    kind = F.when(F.col("event_type") == "purchase", "response").otherwise("tick")
    return e.select(F.col("user_id").cast("string").alias("job"), D.nanos(F.col("ts")).alias("ts_ns"), F.col("event_id").alias("seq"), kind.alias("kind"), (F.col("event_id") % 10).alias("rows"))


_REPLAY = f"""
lines AS (SELECT user_id::VARCHAR AS job, epoch_us(ts) * 1000 AS ts_ns, event_id AS seq, CASE WHEN event_type = 'purchase' THEN 'response' ELSE 'tick' END AS kind, event_id % 10 AS rows, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
r AS (SELECT job, seq, n, rows, CASE WHEN kind = 'response' THEN 'response' ELSE 'fire' END AS action, kind = 'tick' AS busy, ts_ns AS fired FROM lines WHERE n = 1
 UNION ALL SELECT l.job, l.seq, l.n, l.rows, CASE WHEN l.kind = 'response' THEN 'response' WHEN r.busy AND l.ts_ns - r.fired < {MINUTES30} THEN 'skip' WHEN r.busy THEN 'timeout' ELSE 'fire' END, l.kind = 'tick', CASE WHEN l.kind = 'tick' AND NOT (r.busy AND l.ts_ns - r.fired < {MINUTES30}) THEN l.ts_ns ELSE r.fired END
 FROM r JOIN lines l ON l.job = r.job AND l.n = r.n + 1)
"""


@query("replay_requests", f"WITH RECURSIVE {_REPLAY} SELECT job, seq, action FROM r")
def replay_requests(spark: SparkSession, sf: str) -> DataFrame:
    return custom.replay_requests(_jobs(spark, sf), MINUTES30).select("job", "seq", "action")


@query(
    "request_metrics",
    f"""WITH RECURSIVE {_REPLAY}, j AS (SELECT job, count(*) FILTER (WHERE action IN ('fire', 'timeout')) AS polls, sum(CASE WHEN action = 'response' THEN rows ELSE 0 END)::BIGINT AS rows, count(*) FILTER (WHERE action = 'skip') AS skipped, count(*) FILTER (WHERE action = 'timeout') AS timeouts, (arg_max(action, n) <> 'response')::BIGINT AS in_flight FROM r GROUP BY 1)
    SELECT job, sum(polls)::BIGINT AS polls, sum(rows)::BIGINT AS rows, sum(skipped)::BIGINT AS skipped, sum(timeouts)::BIGINT AS timeouts, sum(in_flight)::BIGINT AS in_flight FROM j GROUP BY ROLLUP (job)""",
)
def request_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return custom.request_metrics(custom.replay_requests(_jobs(spark, sf), MINUTES30))


def surface_events(spark: SparkSession, sf: str) -> DataFrame:
    """The events of every universe, as one stream: a reset, its members, then quotes and greeks."""
    options = D.options(spark, sf).withColumn("universe_id", F.concat("underlying", F.lit(":"), F.col("expiration_ns").cast("string")))
    null = lambda t="double": F.lit(None).cast(t)
    perp = F.concat("underlying", F.lit("-PERPETUAL.DERIBIT"))
    universes = options.select("universe_id", perp.alias("perp_id")).distinct()
    start = D.table(spark, sf, "events").agg(F.min(D.nanos(F.col("ts"))).alias("t")).first()[0] or 0
    resets = universes.select("universe_id", F.lit("reset").alias("kind"), F.col("perp_id").alias("instrument_id"), null().alias("strike"), null("string").alias("option_kind"), null().alias("bid"), null().alias("ask"), null().alias("iv"), null().alias("delta"), F.lit(start - 2).alias("ts_ns"), F.lit(0).cast("long").alias("seq"))
    members = options.select("universe_id", F.lit("member"), "instrument_id", "strike", F.col("kind"), null(), null(), null(), null(), F.lit(start - 1), F.col("p_partkey"))
    quotes = D.quotes(spark, sf).join(options.select("universe_id", "instrument_id").union(universes), "instrument_id").select("universe_id", F.lit("quote"), "instrument_id", null(), null("string"), "bid_price", "ask_price", null(), null(), "ts_event_ns", "seq")
    greeks = D.greeks(spark, sf).join(options.select("universe_id", "instrument_id"), "instrument_id").select("universe_id", F.lit("greek"), "instrument_id", null(), null("string"), null(), null(), "mark_iv", "delta", "ts_event_ns", "seq")
    return resets.union(members).union(quotes).union(greeks)


@query(
    "online_option_metrics",
    f"""WITH RECURSIVE o AS (SELECT underlying || ':' || expiration_ns AS universe_id, underlying, instrument_id, strike, kind FROM options_v),
    ids AS (SELECT universe_id, instrument_id, false AS perp FROM o UNION ALL SELECT DISTINCT universe_id, underlying || '-PERPETUAL.DERIBIT', true FROM o),
    data AS (SELECT universe_id, instrument_id, perp, (bid_price + ask_price) / 2 AS mid, NULL::DOUBLE AS iv, ts_event_ns AS ts, seq FROM quotes_v JOIN ids USING (instrument_id) UNION ALL SELECT universe_id, instrument_id, false, NULL, CASE WHEN abs(mark_iv) > 3 THEN mark_iv / 100 ELSE mark_iv END, ts_event_ns, seq FROM greeks_v JOIN ids USING (instrument_id)),
    firsts AS (SELECT *, mid IS NOT NULL AND NOT perp AND row_number() OVER (PARTITION BY universe_id, instrument_id, mid IS NOT NULL ORDER BY ts, seq) = 1 AS new_quote, iv IS NOT NULL AND row_number() OVER (PARTITION BY universe_id, instrument_id, iv IS NOT NULL ORDER BY ts, seq) = 1 AS new_iv FROM data),
    n AS (SELECT *, row_number() OVER w AS pos, last_value(CASE WHEN perp THEN mid END IGNORE NULLS) OVER w AS perp_mid, sum(new_quote::INT) OVER w AS quoted, sum(new_iv::INT) OVER w AS ready FROM firsts WINDOW w AS (PARTITION BY universe_id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)),
    strikes AS (SELECT DISTINCT universe_id, strike FROM o), ends AS (SELECT universe_id, min(strike) AS low, max(strike) AS high, count(*) AS members FROM o GROUP BY 1),
    atm AS (SELECT universe_id, pos, arg_min(strike, (abs(strike - perp_mid), strike)) AS atm_k FROM n JOIN strikes USING (universe_id) WHERE perp_mid IS NOT NULL AND ready > 0 GROUP BY 1, 2),
    asked AS (SELECT a.universe_id, a.pos, 'atm' AS part, instrument_id FROM atm a JOIN o ON o.universe_id = a.universe_id AND strike = atm_k UNION ALL SELECT a.universe_id, a.pos, 'put', instrument_id FROM atm a JOIN ends e USING (universe_id) JOIN o ON o.universe_id = a.universe_id AND strike = low AND kind = 'P' UNION ALL SELECT a.universe_id, a.pos, 'call', instrument_id FROM atm a JOIN ends e USING (universe_id) JOIN o ON o.universe_id = a.universe_id AND strike = high AND kind = 'C'),
    known AS (SELECT universe_id, instrument_id, pos, iv FROM n WHERE iv IS NOT NULL),
    ivs AS (SELECT q.universe_id, q.pos, avg(iv) FILTER (WHERE part = 'atm') AS iv_at, avg(iv) FILTER (WHERE part = 'put') AS iv_put, avg(iv) FILTER (WHERE part = 'call') AS iv_call FROM asked q ASOF JOIN known k ON k.universe_id = q.universe_id AND k.instrument_id = q.instrument_id AND k.pos <= q.pos GROUP BY 1, 2),
    c AS MATERIALIZED (SELECT universe_id, pos, ts, perp_mid, atm_k, iv_at, iv_put, iv_call, ready, quoted, members FROM n JOIN atm USING (universe_id, pos) JOIN ivs USING (universe_id, pos) JOIN ends USING (universe_id) WHERE iv_at IS NOT NULL AND iv_put IS NOT NULL AND iv_call IS NOT NULL),
    starts AS (SELECT universe_id, ts, min(pos) AS pos FROM c GROUP BY 1, 2),
    steps AS MATERIALIZED (SELECT c.universe_id, c.pos, s.pos AS next FROM c ASOF JOIN starts s ON s.universe_id = c.universe_id AND s.ts >= c.ts + {D.DAY_NS}),
    taken AS (SELECT universe_id, min(pos) AS pos FROM c GROUP BY 1 UNION ALL SELECT t.universe_id, s.next FROM taken t JOIN steps s ON s.universe_id = t.universe_id AND s.pos = t.pos)
    SELECT universe_id, ts AS ts_ns, atm_k AS atm_strike, round(perp_mid, 6) AS perp_mid, round(iv_at, 6) AS atm_iv, round(iv_call - iv_put, 6) AS risk_reversal, round((iv_put + iv_call) / 2 - iv_at, 6) AS wing_richness, ready::BIGINT AS greeks_ready, quoted::BIGINT AS quotes_ready, members AS option_count FROM taken JOIN c USING (universe_id, pos)""",
)
def online_option_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Replayed snapshots, at most one a day; tests hold them against the stream."""
    return replay_option_metrics(surface_events(spark, sf), D.DAY_NS).select("universe_id", "ts_ns", "atm_strike", *r6("perp_mid", "atm_iv", "risk_reversal", "wing_richness"), "greeks_ready", "quotes_ready", "option_count")


@query("iv_quantities", "SELECT instrument_id, seq, round(CASE WHEN abs(mark_iv) > 3 THEN mark_iv / 100 ELSE mark_iv END, 6) AS iv, row_number() OVER (PARTITION BY instrument_id ORDER BY seq) AS n FROM greeks_v WHERE mark_iv > 0")
def iv_quantities(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.greeks(spark, sf).filter(S.finite("mark_iv") & (F.col("mark_iv") > 0))
    return rows.select("instrument_id", "seq", F.round(S.normalize_iv("mark_iv"), 6).alias("iv"), F.row_number().over(Window.partitionBy("instrument_id").orderBy("seq")).cast("long").alias("n"))



def _counts(spark: SparkSession, sf: str) -> DataFrame:
    each = {"quotes": D.quotes(spark, sf), "option_greeks": D.greeks(spark, sf)}
    parts = [df.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("family"), "instrument_id", "rows") for name, df in each.items()]
    return parts[0].union(parts[1])


_SAMPLED = f"""{_UNI}, n AS (SELECT *, row_number() OVER (PARTITION BY universe_id ORDER BY strike, instrument_id) - 1 AS i, count(*) OVER (PARTITION BY universe_id) AS n FROM u),
s AS (SELECT *, least(greatest(n // 2 - 3, 0) + 6, n) AS stop FROM n), centred AS (SELECT instrument_id FROM s WHERE n <= 6 OR (i >= stop - 6 AND i < stop)),
c AS (SELECT 'quotes' AS family, instrument_id, count(*) AS rows FROM quotes_v GROUP BY 2 UNION ALL SELECT 'option_greeks', instrument_id, count(*) FROM greeks_v GROUP BY 2)"""
_THIN = "SELECT 'min_rows:' || e.family AS rule, p.instrument_id AS key, '10' AS expected, coalesce(rows, 0)::VARCHAR AS actual FROM centred p CROSS JOIN (SELECT unnest(['quotes', 'option_greeks']) AS family) e LEFT JOIN c ON c.family = e.family AND c.instrument_id = p.instrument_id WHERE coalesce(rows, 0) < 10"


@query("validate_counts", f"WITH {_SAMPLED} {_THIN}")
def validate_counts(spark: SparkSession, sf: str) -> DataFrame:
    return validate.validate_counts(_universes(spark, sf), _counts(spark, sf), {"quotes": 10, "option_greeks": 10}, sample=6)


@query(
    "validate_catalog",
    f"""WITH RECURSIVE {RESOLVED}, good AS (SELECT * FROM resolved WHERE error IS NULL), {SMOOTHED.format(source="good")}, startup AS (SELECT * FROM st WHERE n = 1), {_SAMPLED}
    SELECT 'lineage:profile_mode' AS rule, universe_id || ':' || split_part(universe_id, ':', 1) AS key, NULL::VARCHAR AS expected, mode AS actual FROM startup WHERE mode <> 'oi_ranked'
    UNION ALL SELECT 'lineage:profile_top_n', universe_id || ':' || split_part(universe_id, ':', 1), NULL, NULL FROM startup WHERE mode <> 'oi_ranked'
    UNION ALL SELECT 'lineage:profile_strikes', universe_id || ':' || split_part(universe_id, ':', 1), NULL, len(string_split(strikes, ','))::VARCHAR FROM startup WHERE len(string_split(strikes, ',')) > 3
    UNION ALL {_THIN}""",
)
def validate_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Lineage, readback and count checks in one report."""
    records = lineage.resolution_records(resolved(spark, sf))
    counts = validate.validate_counts(_universes(spark, sf), _counts(spark, sf), {"quotes": 10, "option_greeks": 10}, sample=6)
    perps = D.quotes(spark, sf).filter("instrument_id LIKE '%-PERPETUAL.%'").select("instrument_id", F.lit("perp").alias("role"))
    readback = validate.min_rows(perps.select(F.lit("quotes").alias("family"), "instrument_id", F.lit(1).alias("least")).distinct(), validate.family_counts(D.quotes(spark, sf), "quotes"))
    return validate.validate_catalog(lineage.validate_lineage(records, require_refresh=True, profile="oi_ranked", top_n=3), readback, counts)
