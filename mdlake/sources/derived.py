"""Market tables derived from the driver's tables; every row comes from a row of `part`, `events`, `orders` or `lineitem`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mdlake.functions.scalars import whole

DAY_NS = 86_400_000_000_000
FIRST_EXPIRY_NS = 1_704_096_000_000_000_000
WEEK_NS = 604_800_000_000_000
#: Lines are dealt out among so many options, events among at least so many; every row gets one.
TRADED = 200
#: Of more options events go to one in so many, from both ends of the strikes.
TRADED_SHARE = 10
UNDERLYINGS = ("BTC", "ETH", "SOL")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _underlying(number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, UNDERLYINGS)), (number % 3 + 1).cast("int"))


def nanos(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) * 1000


def options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option definitions, one for each part: six weekly expiries for each underlying, some strikes unpaired."""
    part = table(spark, sf_dir, "part")
    pair = F.floor(F.col("p_partkey") / 2)
    e, strike = F.floor(pair / 3) % 6, 100 + 10 * F.floor(pair / 18) + F.when(F.col("p_partkey") % 17 == 0, 5).otherwise(0)
    kind = F.when(F.col("p_partkey") % 2 == 0, "C").otherwise("P")
    return part.select(
        F.concat(_underlying(pair), F.lit("-E"), e, F.lit("-"), strike, F.lit("-"), kind, F.lit(".DERIBIT")).alias("instrument_id"),
        F.lit("option").alias("class"),
        _underlying(pair).alias("underlying"),
        _underlying(pair).alias("settlement_currency"),
        strike.cast("double").alias("strike"),
        kind.alias("kind"),
        (F.lit(FIRST_EXPIRY_NS) + e * F.lit(WEEK_NS)).alias("expiration_ns"),
        F.when(F.col("p_partkey") % 13 == 0, 0.0).otherwise(F.col("p_size").cast("double")).alias("open_interest"),
        "p_partkey",
    )


def _on_options(spark: SparkSession, sf_dir: str, types: list[str]) -> DataFrame:
    events = table(spark, sf_dir, "events").filter(F.col("event_type").isin(types))
    ids = options(spark, sf_dir).select("instrument_id", "p_partkey")
    parts = table(spark, sf_dir, "part").count()
    x = F.col("event_id") % max(parts // TRADED_SHARE, min(parts, TRADED), 1)
    return events.withColumn("pk", F.when(x % 2 == 0, whole(x, 2)).otherwise(parts - 1 - whole(x, 2))).join(ids, F.col("pk") == F.col("p_partkey")).drop("pk")


def _times() -> list[Column]:
    ns = nanos(F.col("ts"))
    return [ns.alias("ts_event_ns"), ns.alias("ts_init_ns"), F.col("event_id").alias("seq")]


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["instrument_id", F.col("value").alias("bid_price"), (F.col("value") + 0.5).alias("ask_price"), *_times()]
    perps = table(spark, sf_dir, "events").filter("event_type = 'view'").withColumn("instrument_id", F.concat(_underlying(F.col("user_id")), F.lit("-PERPETUAL.DERIBIT")))
    return perps.select(*columns).union(_on_options(spark, sf_dir, ["click", "signup"]).select(*columns))


def greeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    iv = F.when(F.col("event_id") % 7 == 0, None).when(F.col("event_id") % 3 == 0, F.col("value") / 10).otherwise(F.col("value") / 1000)
    return _on_options(spark, sf_dir, ["error"]).select(
        "instrument_id", iv.alias("mark_iv"), ((F.col("event_id") % 200) / 200).alias("delta"), (F.col("value") + 100).alias("underlying_price"), F.col("user_id").cast("double").alias("open_interest"), *_times()
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_options(spark, sf_dir, ["purchase"]).select("instrument_id", F.col("value").alias("price"), (F.col("event_id") % 10 + 1).cast("double").alias("size"), *_times())


def trades_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades over years, for sinks and layouts; (l_orderkey, l_linenumber) isn't unique, so ties stay ties."""
    lines, ids = table(spark, sf_dir, "lineitem"), options(spark, sf_dir).select("instrument_id", "p_partkey")
    ns = nanos(F.col("l_shipdate"))
    return lines.join(ids, F.col("l_partkey") % TRADED + 1 == F.col("p_partkey")).select(
        "instrument_id", (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").alias("size"), ns.alias("ts_event_ns"), ns.alias("ts_init_ns"), F.col("l_orderkey").alias("seq")
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A resolution request for each underlying and each day that has events, at 06:00 UTC."""
    day = whole(nanos(F.col("ts")), DAY_NS)
    days = table(spark, sf_dir, "events").select(day.alias("day")).distinct()
    underlying = F.explode(F.array(*map(F.lit, UNDERLYINGS)))
    return days.select(underlying.alias("underlying"), (F.col("day") * F.lit(DAY_NS) + F.lit(DAY_NS // 4)).alias("now_ns"))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome-market questions: question, description, named_outcomes, fallback_outcome, now_ns."""
    orders = table(spark, sf_dir, "orders")
    period = F.element_at(F.array(*map(F.lit, ("|period:1d", "|period:daily", "| period : 24h", "|period:1w", ""))), F.substring("o_orderpriority", 1, 1).cast("int"))
    description = F.concat(
        F.lit("class:priceBinary|underlying:"), _underlying(F.col("o_custkey")), F.lit("|expiry:"), F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyyMMdd"), F.lit("-0600"), period, F.lit("|targetPrice:"), F.col("o_totalprice").cast("long")
    )
    return orders.select(
        F.col("o_orderkey").alias("question"), description.alias("description"), F.array(F.col("o_custkey") * 10).alias("named_outcomes"), (F.col("o_custkey") * 10 + 1).alias("fallback_outcome"), nanos(F.col("o_orderdate")).alias("listed_ns")
    )
