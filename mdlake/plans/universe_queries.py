"""Queries over options: state, metrics and universe resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdlake.functions import scalars as S
from mdlake.operators import asof, metrics, universe
from mdlake.plans.registry import query
from mdlake.sources import derived as D


def perps(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(u, f"{u}-PERPETUAL.DERIBIT") for u in D.UNDERLYINGS], "underlying string, perp_id string")


def r6(*columns: str) -> list:
    return [F.round(c, 6).alias(c) for c in columns]


_LATEST = """
WITH q AS (SELECT instrument_id, arg_max(bid_price, seq) AS bid, arg_max(ask_price, seq) AS ask FROM quotes_v GROUP BY 1),
g AS (SELECT instrument_id, arg_max(mark_iv, seq) FILTER (WHERE mark_iv IS NOT NULL) AS raw_iv, arg_max(delta, seq) AS delta FROM greeks_v GROUP BY 1),
s AS (SELECT o.*, (q.bid + q.ask) / 2 AS option_mid, raw_iv, CASE WHEN abs(raw_iv) > 3 THEN raw_iv / 100 ELSE raw_iv END AS iv, delta, (p.bid + p.ask) / 2 AS perp_mid
      FROM options_v o LEFT JOIN q USING (instrument_id) LEFT JOIN g USING (instrument_id) LEFT JOIN q p ON p.instrument_id = o.underlying || '-PERPETUAL.DERIBIT')
"""


@query(
    "option_metrics",
    _LATEST
    + """, m AS (SELECT underlying, expiration_ns, median(strike) AS mid_strike FROM (SELECT DISTINCT underlying, expiration_ns, strike FROM s) GROUP BY ALL),
    a AS (SELECT underlying, expiration_ns, arg_min(strike, (abs(strike - coalesce(perp_mid, mid_strike)), strike)) AS atm_strike, min(strike) AS low_strike, max(strike) AS high_strike, count(*) AS option_count,
          count(*) FILTER (WHERE iv IS NOT NULL AND delta IS NOT NULL) AS greeks_ready, count(option_mid) AS quotes_ready, any_value(perp_mid) AS perp_mid FROM s JOIN m USING (underlying, expiration_ns) GROUP BY ALL),
    v AS (SELECT underlying, expiration_ns, avg(iv) FILTER (WHERE strike = atm_strike) AS atm_iv, avg(iv) FILTER (WHERE strike = low_strike AND kind = 'P') AS low_put_iv, avg(iv) FILTER (WHERE strike = high_strike AND kind = 'C') AS high_call_iv
          FROM s JOIN a USING (underlying, expiration_ns) GROUP BY ALL)
    SELECT underlying, expiration_ns, atm_strike, low_strike, high_strike, option_count, greeks_ready, quotes_ready, round(a.perp_mid, 6) AS perp_mid, round(atm_iv, 6) AS atm_iv, round(low_put_iv, 6) AS low_put_iv, round(high_call_iv, 6) AS high_call_iv,
           round(high_call_iv - low_put_iv, 6) AS risk_reversal, round(coalesce((low_put_iv + high_call_iv) / 2, low_put_iv, high_call_iv) - atm_iv, 6) AS wing_richness FROM a JOIN v USING (underlying, expiration_ns)""",
)
def option_metrics(spark: SparkSession, sf: str) -> DataFrame:
    found = metrics.option_metrics(D.options(spark, sf), D.quotes(spark, sf), D.greeks(spark, sf), perps(spark))
    return found.select("underlying", "expiration_ns", "atm_strike", "low_strike", "high_strike", "option_count", "greeks_ready", "quotes_ready", *r6("perp_mid", "atm_iv", "low_put_iv", "high_call_iv", "risk_reversal", "wing_richness"))


@query("latest_state", _LATEST + "SELECT instrument_id, round(raw_iv, 6) AS raw_iv, round(iv, 6) AS iv, round(delta, 6) AS delta, round(option_mid, 6) AS option_mid FROM s")
def latest_state(spark: SparkSession, sf: str) -> DataFrame:
    state = metrics.option_state(D.options(spark, sf), D.quotes(spark, sf), D.greeks(spark, sf))
    return state.select("instrument_id", *r6("raw_iv", "iv", "delta", "option_mid"))


@query(
    "asof_state",
    """SELECT underlying, now_ns, round(arg_max((bid_price + ask_price) / 2, (ts_event_ns, seq)), 6) AS perp_mid
    FROM requests_v r LEFT JOIN quotes_v q ON q.instrument_id = r.underlying || '-PERPETUAL.DERIBIT' AND q.ts_event_ns <= r.now_ns GROUP BY 1, 2""",
)
def asof_state(spark: SparkSession, sf: str) -> DataFrame:
    asked = D.requests(spark, sf).withColumn("instrument_id", F.concat("underlying", F.lit("-PERPETUAL.DERIBIT")))
    quotes = D.quotes(spark, sf).withColumn("perp_mid", S.mid())
    found = asof.asof_state(asked, quotes, "instrument_id", ["perp_mid"], block_ns=asof.block_length(quotes, "instrument_id"))
    return found.select("underlying", "now_ns", *r6("perp_mid"))


@query(
    "ffill_state",
    "SELECT instrument_id, seq, round(last_value(mark_iv IGNORE NULLS) OVER (PARTITION BY instrument_id ORDER BY ts_event_ns, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS mark_iv FROM greeks_v",
)
def ffill_state(spark: SparkSession, sf: str) -> DataFrame:
    return asof.ffill_state(D.greeks(spark, sf), "instrument_id", ["mark_iv"]).select("instrument_id", "seq", *r6("mark_iv"))


_READY = "SELECT instrument_id, min(ts_init_ns) AS ready FROM greeks_v GROUP BY 1"


@query("gate_on_definition", f"SELECT instrument_id, count(*) AS n, min(ts_init_ns) AS first_ns FROM quotes_v JOIN ({_READY}) USING (instrument_id) WHERE ts_init_ns >= ready GROUP BY 1")
def gate_on_definition(spark: SparkSession, sf: str) -> DataFrame:
    gated = asof.gate_on_definition(D.quotes(spark, sf), D.greeks(spark, sf).select("instrument_id", "ts_init_ns"))
    return gated.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("n"), F.min("ts_init_ns").alias("first_ns"))


@query(
    "atm_reference",
    """WITH a AS (SELECT underlying, now_ns, arg_max(t.price, (t.ts_event_ns, t.seq)) AS mark FROM requests_v r LEFT JOIN (SELECT t.*, o.underlying AS u FROM trades_v t JOIN options_v o USING (instrument_id) WHERE t.price > 60) t ON t.u = r.underlying AND t.ts_event_ns <= r.now_ns GROUP BY 1, 2),
    b AS (SELECT underlying, now_ns, arg_max((bid_price + ask_price) / 2, (ts_event_ns, seq)) AS mid FROM requests_v r LEFT JOIN quotes_v q ON q.instrument_id = r.underlying || '-PERPETUAL.DERIBIT' AND q.ts_event_ns <= r.now_ns GROUP BY 1, 2)
    SELECT underlying, now_ns, round(coalesce(mark, mid), 6) AS atm_reference, CASE WHEN mark IS NOT NULL THEN 'option_trade' WHEN mid IS NOT NULL THEN 'perp_quote_mid' END AS atm_reference_source FROM a JOIN b USING (underlying, now_ns)""",
)
def atm_reference(spark: SparkSession, sf: str) -> DataFrame:
    asked = D.requests(spark, sf).withColumn("perp_id", F.concat("underlying", F.lit("-PERPETUAL.DERIBIT")))
    marks = D.trades(spark, sf).filter("price > 60").join(D.options(spark, sf).select("instrument_id", "underlying"), "instrument_id").withColumn("instrument_id", F.concat("underlying", F.lit("-PERPETUAL.DERIBIT")))
    found = asof.perp_reference(asked, [("option_trade", marks, F.col("price")), ("perp_quote_mid", D.quotes(spark, sf), S.mid())])
    return found.select("underlying", "now_ns", *r6("atm_reference"), "atm_reference_source")


@query(
    "option_snapshots",
    """WITH t AS (SELECT r.underlying, r.now_ns, o.expiration_ns, o.instrument_id, o.strike, o.kind FROM requests_v r JOIN options_v o USING (underlying) WHERE o.expiration_ns > r.now_ns),
    q AS (SELECT t.now_ns, t.instrument_id, arg_max((bid_price + ask_price) / 2, seq) AS option_mid FROM t JOIN quotes_v q ON q.instrument_id = t.instrument_id AND q.ts_event_ns <= t.now_ns GROUP BY 1, 2),
    g AS (SELECT t.now_ns, t.instrument_id, arg_max(CASE WHEN abs(mark_iv) > 3 THEN mark_iv / 100 ELSE mark_iv END, seq) FILTER (WHERE mark_iv IS NOT NULL) AS iv, arg_max(delta, seq) AS delta FROM t JOIN greeks_v g ON g.instrument_id = t.instrument_id AND g.ts_event_ns <= t.now_ns GROUP BY 1, 2),
    p AS (SELECT underlying, now_ns, arg_max((bid_price + ask_price) / 2, seq) AS perp_mid FROM requests_v r JOIN quotes_v q ON q.instrument_id = r.underlying || '-PERPETUAL.DERIBIT' AND q.ts_event_ns <= r.now_ns GROUP BY 1, 2),
    s AS (SELECT * FROM t LEFT JOIN q USING (now_ns, instrument_id) LEFT JOIN g USING (now_ns, instrument_id) JOIN p USING (underlying, now_ns)),
    a AS (SELECT underlying, expiration_ns, now_ns, arg_min(strike, (abs(strike - perp_mid), strike)) AS atm_strike, min(strike) AS low_strike, max(strike) AS high_strike, count(*) FILTER (WHERE iv IS NOT NULL AND delta IS NOT NULL) AS greeks_ready, count(option_mid) AS quotes_ready FROM s GROUP BY ALL),
    v AS (SELECT underlying, expiration_ns, now_ns, atm_strike, greeks_ready, quotes_ready, avg(iv) FILTER (WHERE strike = atm_strike) AS atm_iv, avg(iv) FILTER (WHERE strike = low_strike AND kind = 'P') AS lp, avg(iv) FILTER (WHERE strike = high_strike AND kind = 'C') AS hc FROM s JOIN a USING (underlying, expiration_ns, now_ns) GROUP BY ALL)
    SELECT underlying, expiration_ns, now_ns, atm_strike, greeks_ready, quotes_ready, round(atm_iv, 6) AS atm_iv, round(hc - lp, 6) AS risk_reversal, round((hc + lp) / 2 - atm_iv, 6) AS wing_richness FROM v WHERE atm_iv IS NOT NULL AND lp IS NOT NULL AND hc IS NOT NULL AND greeks_ready > 0""",
)
def option_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    found = metrics.option_snapshots(D.requests(spark, sf), D.options(spark, sf), D.quotes(spark, sf), D.greeks(spark, sf), perps(spark))
    return found.select("underlying", "expiration_ns", "now_ns", "atm_strike", "greeks_ready", "quotes_ready", *r6("atm_iv", "risk_reversal", "wing_richness"))


HOUR6 = 6 * 3_600_000_000_000


@query(
    "throttle",
    f"""WITH RECURSIVE q AS (SELECT *, row_number() OVER (PARTITION BY instrument_id ORDER BY ts_event_ns, seq) AS n FROM quotes_v),
    picked AS (SELECT instrument_id, ts_event_ns, seq FROM q WHERE n = 1 UNION ALL
      SELECT p.instrument_id, x.ts_event_ns, x.seq FROM picked p JOIN LATERAL (SELECT ts_event_ns, seq FROM quotes_v q WHERE q.instrument_id = p.instrument_id AND q.ts_event_ns - p.ts_event_ns >= {HOUR6} ORDER BY ts_event_ns, seq LIMIT 1) x ON true)
    SELECT instrument_id, ts_event_ns, seq FROM picked""",
)
def throttle(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.throttle(D.quotes(spark, sf).select("instrument_id", "ts_event_ns", "seq"), "instrument_id", "ts_event_ns", HOUR6)


@query("tumbling_snapshots", f"SELECT instrument_id, min(ts_event_ns) AS ts_event_ns, arg_min(seq, (ts_event_ns, seq)) AS seq FROM quotes_v GROUP BY instrument_id, ts_event_ns // {HOUR6}")
def tumbling_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.tumbling_snapshots(D.quotes(spark, sf).select("instrument_id", "ts_event_ns", "seq"), "instrument_id", "ts_event_ns", HOUR6)


@query("live_options", "SELECT underlying, now_ns, count(*) AS n, min(instrument_id) AS least FROM requests_v JOIN options_v USING (underlying) WHERE expiration_ns > now_ns GROUP BY 1, 2")
def live_options(spark: SparkSession, sf: str) -> DataFrame:
    return universe.count_live_options(D.options(spark, sf), D.requests(spark, sf)).select("underlying", "now_ns", "n", "least")


@query("strike_pairs", "SELECT underlying, expiration_ns, strike, max(instrument_id) FILTER (WHERE kind = 'C') AS call_id, max(instrument_id) FILTER (WHERE kind = 'P') AS put_id FROM options_v GROUP BY 1, 2, 3 HAVING count(DISTINCT kind) = 2")
def strike_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return universe.strike_pairs(D.options(spark, sf)).drop("settlement_currency")


@query("sum_oi", "SELECT underlying, expiration_ns, strike, sum(open_interest) AS open_interest FROM options_v WHERE open_interest > 0 GROUP BY 1, 2, 3")
def sum_oi(spark: SparkSession, sf: str) -> DataFrame:
    return universe.sum_oi(D.options(spark, sf)).drop("settlement_currency")


@query(
    "oi_by_strike",
    """SELECT underlying, expiration_ns, strike, sum(oi) AS open_interest FROM (SELECT instrument_id, arg_max(open_interest, seq) AS oi FROM greeks_v GROUP BY 1) JOIN (SELECT * EXCLUDE (open_interest) FROM options_v) USING (instrument_id) WHERE oi > 0 GROUP BY 1, 2, 3""",
)
def oi_by_strike(spark: SparkSession, sf: str) -> DataFrame:
    latest = asof.latest_state(D.greeks(spark, sf), "instrument_id", ["open_interest"])
    return universe.sum_oi(D.options(spark, sf).drop("open_interest").join(latest, "instrument_id")).drop("settlement_currency")


def option_requests(spark: SparkSession, sf: str) -> DataFrame:
    """The daily requests in each strike mode, with the perp mid as of then as the reference."""
    asked = D.requests(spark, sf).withColumn("instrument_id", F.concat("underlying", F.lit("-PERPETUAL.DERIBIT")))
    # Perps alone are asked for, so quotes of options needn't be made.
    quotes = D.quotes(spark, sf).filter(F.col("instrument_id").endswith("-PERPETUAL.DERIBIT"))
    asked = asof.asof_state(asked, quotes.withColumn("atm_reference", S.mid() + 100), "instrument_id", ["atm_reference"])
    mode = F.explode(F.array(*map(F.lit, universe.MODES)))
    return asked.select(
        "underlying", "now_ns", "atm_reference", F.lit(None).cast("string").alias("settlement_currency"), F.lit(True).alias("include_perp"), F.col("instrument_id").alias("perp_instrument_id"), F.lit(20).alias("days_max"), F.lit(2).alias("above"), F.lit(1).alias("below"), F.lit(3).alias("top_n"), mode.alias("strike_mode")
    ).withColumn("universe_id", F.concat("underlying", F.lit(":"), "strike_mode"))


RESOLVED = """
asked AS (SELECT underlying, now_ns, arg_max((bid_price + ask_price) / 2 + 100, (ts_event_ns, seq)) AS ref FROM requests_v r LEFT JOIN quotes_v q ON q.instrument_id = r.underlying || '-PERPETUAL.DERIBIT' AND q.ts_event_ns <= r.now_ns GROUP BY 1, 2),
exp AS (SELECT a.*, (SELECT min(expiration_ns) FROM options_v o WHERE o.underlying = a.underlying AND o.expiration_ns > a.now_ns AND o.expiration_ns - a.now_ns <= 20 * 86400000000000) AS expiry, (SELECT count(*) FROM options_v o WHERE o.underlying = a.underlying AND o.expiration_ns > a.now_ns) AS live FROM asked a),
pairs AS (SELECT underlying, expiration_ns AS expiry, strike, max(instrument_id) FILTER (WHERE kind = 'C') AS c, max(instrument_id) FILTER (WHERE kind = 'P') AS p, sum(open_interest) AS oi FROM options_v GROUP BY 1, 2, 3 HAVING count(DISTINCT kind) = 2),
ranked AS (SELECT e.underlying, e.now_ns, e.ref, e.expiry, strike, c, p, oi, row_number() OVER w AS n, row_number() OVER (PARTITION BY e.underlying, e.now_ns ORDER BY oi DESC, strike) AS by_oi,
  row_number() OVER (PARTITION BY e.underlying, e.now_ns ORDER BY abs(strike - ref), strike) AS by_ref FROM exp e JOIN pairs p ON p.underlying = e.underlying AND p.expiry = e.expiry WINDOW w AS (PARTITION BY e.underlying, e.now_ns ORDER BY strike)),
atm AS (SELECT underlying, now_ns, n AS at FROM ranked WHERE by_ref = 1),
chosen AS (SELECT r.*, m.mode FROM ranked r JOIN atm a USING (underlying, now_ns), (SELECT unnest(['atm_relative', 'oi_ranked', 'all']) AS mode) m
  WHERE m.mode = 'all' OR (m.mode = 'oi_ranked' AND by_oi <= 3 AND oi > 0) OR (m.mode = 'atm_relative' AND n BETWEEN a.at - 1 AND a.at + 2)),
picked AS (SELECT underlying, now_ns, mode, string_agg(strike::BIGINT::VARCHAR, ',' ORDER BY strike) AS strikes, string_agg(c || ',' || p, ',' ORDER BY strike) AS ids FROM chosen GROUP BY 1, 2, 3),
resolved AS (SELECT e.underlying || ':' || m.mode AS universe_id, e.now_ns AS resolved_at_ns, e.underlying, m.mode, CASE WHEN strikes IS NOT NULL AND ref IS NOT NULL THEN e.expiry WHEN strikes IS NOT NULL AND m.mode <> 'atm_relative' THEN e.expiry END AS expiry, ref,
  CASE WHEN live = 0 THEN 'NoMatchingOptions' WHEN e.expiry IS NULL THEN 'NoMatchingExpiry' WHEN NOT EXISTS (FROM pairs x WHERE x.underlying = e.underlying AND x.expiry = e.expiry) THEN 'NoStrikePairs' WHEN m.mode = 'oi_ranked' AND strikes IS NULL THEN 'MissingOpenInterest' WHEN m.mode = 'atm_relative' AND ref IS NULL THEN 'MissingAtmReference' END AS error, strikes, ids
  FROM exp e CROSS JOIN (SELECT unnest(['atm_relative', 'oi_ranked', 'all']) AS mode) m LEFT JOIN picked p ON p.underlying = e.underlying AND p.now_ns = e.now_ns AND p.mode = m.mode)
"""


@query(
    "resolve_option_universes",
    f"WITH {RESOLVED} SELECT universe_id, resolved_at_ns, error, CASE WHEN error IS NULL THEN expiry END AS selected_expiry_ns, CASE WHEN error IS NULL THEN strikes END AS selected_strikes, CASE WHEN error IS NULL THEN ids END AS option_instrument_ids, CASE WHEN error IS NULL THEN len(string_split(ids, ',')) + 1 END AS n_ids FROM resolved",
)
def resolve_option_universes(spark: SparkSession, sf: str) -> DataFrame:
    found = universe.resolve_option_universes(option_requests(spark, sf), D.options(spark, sf))
    strikes = F.array_join(F.transform("selected_strikes", lambda s: s.cast("long").cast("string")), ",")
    return found.select("universe_id", "resolved_at_ns", "error", "selected_expiry_ns", strikes.alias("selected_strikes"), F.array_join("option_instrument_ids", ",").alias("option_instrument_ids"), F.size("all_instrument_ids").cast("long").alias("n_ids"))


@query(
    "reference_instrument",
    "SELECT underlying, now_ns, (SELECT min(instrument_id) FROM options_v o WHERE o.underlying = r.underlying AND o.expiration_ns = (SELECT min(expiration_ns) FROM options_v x WHERE x.underlying = r.underlying AND x.expiration_ns > r.now_ns AND x.expiration_ns - r.now_ns <= 1728000000000000)) AS instrument_id FROM requests_v r",
)
def reference_instrument(spark: SparkSession, sf: str) -> DataFrame:
    asked = D.requests(spark, sf).select(F.col("underlying").alias("universe_id"), "now_ns", "underlying", F.lit(None).cast("string").alias("settlement_currency"), F.lit(20).alias("days_max"))
    return universe.reference_instrument(D.options(spark, sf), asked).withColumnRenamed("universe_id", "underlying")


@query(
    "apply_universe_history",
    f"""WITH {RESOLVED}, spans AS (SELECT universe_id, resolved_at_ns, lead(resolved_at_ns) OVER (PARTITION BY universe_id ORDER BY resolved_at_ns) AS until_ns, underlying, ids FROM resolved WHERE error IS NULL),
    members AS (SELECT universe_id, resolved_at_ns, until_ns, unnest(list_append(string_split(ids, ','), underlying || '-PERPETUAL.DERIBIT')) AS instrument_id FROM spans)
    SELECT universe_id, instrument_id, count(*) AS n, min(ts_event_ns) AS first_ns, max(ts_event_ns) AS last_ns FROM members JOIN quotes_v USING (instrument_id) WHERE ts_event_ns >= resolved_at_ns AND (until_ns IS NULL OR ts_event_ns < until_ns) GROUP BY 1, 2""",
)
def apply_universe_history(spark: SparkSession, sf: str) -> DataFrame:
    resolved = universe.resolve_option_universes(option_requests(spark, sf), D.options(spark, sf)).filter("error IS NULL")
    inside = asof.apply_universe_history(D.quotes(spark, sf), resolved)
    return inside.groupBy("universe_id", "instrument_id").agg(F.count(F.lit(1)).alias("n"), F.min("ts_event_ns").alias("first_ns"), F.max("ts_event_ns").alias("last_ns"))


@query(
    "option_report",
    """WITH q AS (SELECT instrument_id, count(*) AS n, arg_max(bid_price, seq) AS bid, arg_max(ask_price, seq) AS ask FROM quotes_v GROUP BY 1), l AS (SELECT instrument_id, count(*) AS n, arg_max(mark_iv, seq) AS mark_iv, arg_max(delta, seq) AS delta FROM greeks_v GROUP BY 1)
    SELECT o.instrument_id, coalesce(q.n, 0) AS quote_rows, coalesce(l.n, 0) AS greek_rows, round((bid + ask) / 2, 6) AS option_mid, round(ask - bid, 6) AS option_spread, round(mark_iv, 6) AS raw_iv, round(CASE WHEN abs(mark_iv) > 3 THEN mark_iv / 100 ELSE mark_iv END, 6) AS iv, round(delta * 2, 6) AS gamma, round(delta * 3, 6) AS vega,
    CASE WHEN l.n IS NULL THEN 'greeks' WHEN mark_iv IS NULL THEN 'mark_iv' END AS missing FROM options_v o LEFT JOIN q USING (instrument_id) LEFT JOIN l USING (instrument_id)""",
)
def option_report(spark: SparkSession, sf: str) -> DataFrame:
    """Every option with its counts and last known raw figures, or what it lacks."""
    greeks = D.greeks(spark, sf).withColumns({"gamma": F.col("delta") * 2, "vega": F.col("delta") * 3, "theta": F.col("delta")})
    found = metrics.option_report(D.options(spark, sf), D.quotes(spark, sf), greeks)
    return found.select("instrument_id", "quote_rows", "greek_rows", *[F.round(c, 6).alias(c) for c in ("option_mid", "option_spread", "raw_iv", "iv", "gamma", "vega")], "missing")
