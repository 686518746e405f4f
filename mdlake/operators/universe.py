"""Option universes: which options a request selects, for many requests at once.

Definitions are first reduced to one row for each (underlying, settlement currency, expiry) with its strikes;
requests meet that small table by equality, so no request is compared with every instrument.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdlake.functions.scalars import finite
from mdlake.session import parked
from mdlake.sources.derived import DAY_NS

MODES = ("atm_relative", "oi_ranked", "all")


def _listed(instruments: DataFrame) -> DataFrame:
    return instruments.filter("class = 'option' AND strike IS NOT NULL AND kind IS NOT NULL AND expiration_ns IS NOT NULL")


def _live(options: DataFrame, requests: DataFrame) -> DataFrame:
    wanted = requests.withColumnRenamed("settlement_currency", "__settle") if "settlement_currency" in requests.columns else requests.withColumn("__settle", F.lit(None).cast("string"))
    joined = wanted.join(options, "underlying").filter(F.col("__settle").isNull() | (F.col("__settle") == F.col("settlement_currency")))
    return joined.filter("expiration_ns > now_ns").drop("__settle")


def live_options(instruments: DataFrame, requests: DataFrame) -> DataFrame:
    """(request columns, instrument columns): options of the request's underlying that expire after now.

    A null settlement_currency in the request accepts any. Requests meet definitions by (underlying), after which
    the expiry is compared.
    """
    return _live(_listed(instruments), requests)


def count_live_options(instruments: DataFrame, requests: DataFrame) -> DataFrame:
    """(request columns, n, least): how many options live_options lists for each request, and the least id of them.

    Options combine by settlement currency and expiry before requests meet them, so no request's list is made.
    """
    grouped = _listed(instruments).groupBy("underlying", "settlement_currency", "expiration_ns").agg(F.count(F.lit(1)).alias("__n"), F.min("instrument_id").alias("__least"))
    asked = [c for c in requests.columns if c != "settlement_currency"]
    live = _live(grouped, requests.withColumn("__asked", F.col("settlement_currency")) if "settlement_currency" in requests.columns else requests)
    named = [*asked, *([F.col("__asked").alias("settlement_currency")] if "settlement_currency" in requests.columns else [])]
    return live.groupBy(*named).agg(F.sum("__n").alias("n"), F.min("__least").alias("least"))


def valid_oi(oi: str | Column) -> Column:
    oi = F.col(oi) if isinstance(oi, str) else oi
    return finite(oi) & (oi > 0)


def strike_pairs(options: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, strike, call_id, put_id): strikes with both kinds; of repeated kinds the greatest id."""
    keys = keys or ["underlying", "settlement_currency", "expiration_ns"]
    pairs = options.groupBy(*keys, "strike").agg(F.expr("max(instrument_id) FILTER (WHERE kind = 'C')").alias("call_id"), F.expr("max(instrument_id) FILTER (WHERE kind = 'P')").alias("put_id"))
    return pairs.filter("call_id IS NOT NULL AND put_id IS NOT NULL")


def sum_oi(options: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, strike, open_interest): the valid open interest of both kinds together."""
    keys = keys or ["underlying", "settlement_currency", "expiration_ns"]
    return options.filter(valid_oi("open_interest")).groupBy(*keys, "strike").agg(F.sum("open_interest").alias("open_interest"))


def listed_pairs(options: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, strike, call_id, put_id, open_interest): strike_pairs with sum_oi (null: none is valid), from one pass over the options."""
    keys = keys or ["underlying", "settlement_currency", "expiration_ns"]
    pairs = options.groupBy(*keys, "strike").agg(F.expr("max(instrument_id) FILTER (WHERE kind = 'C')").alias("call_id"), F.expr("max(instrument_id) FILTER (WHERE kind = 'P')").alias("put_id"), F.sum(F.when(valid_oi("open_interest"), F.col("open_interest"))).alias("open_interest"))
    return pairs.filter("call_id IS NOT NULL AND put_id IS NOT NULL")


def expiries(options: DataFrame, requests: DataFrame) -> DataFrame:
    """requests with expiration_ns, the nearest expiry within days_max, and any_live, whether any option is live.

    Requests meet one row for each underlying, the list of its expiries, so they are gone through once.
    """
    listed = options.filter("class = 'option' AND strike IS NOT NULL AND kind IS NOT NULL AND expiration_ns IS NOT NULL")
    lists = listed.groupBy("underlying").agg(F.collect_set(F.struct(F.col("settlement_currency").alias("settle"), F.col("expiration_ns").alias("at"))).alias("__listed"))
    live = F.filter("__listed", lambda e: (F.col("settlement_currency").isNull() | (F.col("settlement_currency") == e["settle"])) & (e["at"] > F.col("now_ns")))
    found = requests.join(lists, "underlying", "left").withColumn("__live", F.transform(live, lambda e: e["at"]))
    near = F.array_min(F.filter("__live", lambda at: at - F.col("now_ns") <= F.col("days_max") * F.lit(DAY_NS)))
    return found.select(*requests.columns, near.alias("expiration_ns"), F.coalesce(F.size("__live") > 0, F.lit(False)).alias("any_live"))


def reference_instrument(options: DataFrame, requests: DataFrame) -> DataFrame:
    """(universe_id, now_ns, instrument_id): the least option id at the nearest expiry."""
    chosen = expiries(options, requests).filter("expiration_ns IS NOT NULL")
    ids = options.groupBy("underlying", "settlement_currency", "expiration_ns").agg(F.min("instrument_id").alias("instrument_id"))
    wanted = chosen.withColumnRenamed("settlement_currency", "__settle").join(ids, ["underlying", "expiration_ns"]).filter("__settle IS NULL OR __settle = settlement_currency")
    return wanted.groupBy("universe_id", "now_ns").agg(F.min("instrument_id").alias("instrument_id"))


def atm_strike(strikes: Column, reference: Column) -> Column:
    """Of an array of strikes the one nearest to the reference, the lower of two equally near."""
    return F.array_min(F.transform(strikes, lambda s: F.struct(F.abs(s - reference).alias("d"), s.alias("s"))))["s"]


def atm_window(items: Column, reference: Column, above: Column, below: Column, strikes: Column | None = None) -> Column:
    """The slice of items sorted by strike (or of the strikes themselves) around the nearest one: shorter at the edges, never shifted."""
    strikes = items if strikes is None else strikes
    at = F.array_position(strikes, atm_strike(strikes, reference)).cast("int")
    first = F.greatest(at - below, F.lit(1))
    return F.slice(items, first, F.least(at + above, F.size(strikes)) - first + 1)


def top_pairs(pairs: Column, n: Column) -> Column:
    """Of structs that begin with strike and have open_interest the n of most valid open interest, by strike; the lower of equals first."""
    ranked = F.sort_array(F.transform(F.filter(pairs, lambda p: valid_oi(p["open_interest"])), lambda p: F.struct((-p["open_interest"]).alias("o"), p["strike"].alias("s"), p.alias("p"))))
    return F.sort_array(F.transform(F.slice(ranked, 1, n), lambda p: p["p"]))


def top_oi(pairs: Column, n: Column) -> Column:
    """Of structs (strike, open_interest) the n strikes of most valid open interest, ascending; the lower of equals first."""
    return F.transform(top_pairs(pairs, n), lambda p: p["strike"])


def resolve_option_universes(requests: DataFrame, options: DataFrame) -> DataFrame:
    """One row for each request: its expiry, strikes and ids, or the reason why there are none.

    requests: universe_id, now_ns, underlying, settlement_currency (null: any), include_perp, perp_instrument_id,
    days_max, strike_mode, above, below, top_n, atm_reference. Options carry open_interest.
    The requests with their expiries are kept, so that what they come from isn't computed for each of their uses.
    """
    chosen = parked(expiries(options, requests), "requests")
    # Requests of one expiry share its list of pairs, which is made once.
    surface = ["underlying", "expiration_ns", "__settle"]
    wanted = chosen.filter("expiration_ns IS NOT NULL").select("underlying", "expiration_ns", F.col("settlement_currency").alias("__settle")).distinct()
    found = wanted.join(listed_pairs(options), ["underlying", "expiration_ns"]).filter("__settle IS NULL OR __settle = settlement_currency")
    # Several settlement currencies may list a strike: the greatest ids and the sum count.
    merged = found.groupBy(*surface, "strike").agg(F.max("call_id").alias("call_id"), F.max("put_id").alias("put_id"), F.sum("open_interest").alias("open_interest"))
    listed = merged.groupBy(*surface).agg(F.sort_array(F.collect_list(F.struct("strike", "call_id", "put_id", "open_interest"))).alias("pairs")).alias("l")
    same = (F.col("c.underlying") == F.col("l.underlying")) & (F.col("c.expiration_ns") == F.col("l.expiration_ns")) & F.col("c.settlement_currency").eqNullSafe(F.col("l.__settle"))
    rows = chosen.alias("c").join(listed, same, "left").select("c.*", "l.pairs")
    # The pairs themselves are chosen, so that none is looked up among the selected strikes.
    around = atm_window(F.col("pairs"), F.col("atm_reference"), F.col("above"), F.col("below"), F.transform("pairs", lambda p: p["strike"]))
    selected = F.when(F.col("strike_mode") == "all", F.col("pairs")).when(F.col("strike_mode") == "oi_ranked", top_pairs(F.col("pairs"), F.col("top_n"))).otherwise(around)
    rows = rows.withColumn("selected", selected)
    error = (
        F.when(~F.col("any_live"), "NoMatchingOptions")
        .when(F.col("expiration_ns").isNull(), "NoMatchingExpiry")
        .when(F.col("pairs").isNull(), "NoStrikePairs")
        .when((F.col("strike_mode") == "oi_ranked") & (F.size("selected") == 0), "MissingOpenInterest")
        .when((F.col("strike_mode") == "atm_relative") & F.col("atm_reference").isNull(), "MissingAtmReference")
        .when(F.col("include_perp") & F.col("perp_instrument_id").isNull(), "MissingPerpetual")
    )
    rows = rows.withColumn("error", error).withColumn("selected_strikes", F.when(F.col("error").isNull(), F.transform("selected", lambda p: p["strike"])))
    ids = F.flatten(F.transform("selected", lambda p: F.array(p["call_id"], p["put_id"])))
    rows = rows.withColumn("option_instrument_ids", F.when(F.col("error").isNull(), ids)).withColumn("perp_instrument_id", F.when(F.col("error").isNull() & F.col("include_perp"), F.col("perp_instrument_id")))
    every_id = F.sort_array(F.array_distinct(F.concat("option_instrument_ids", F.when(F.col("perp_instrument_id").isNotNull(), F.array("perp_instrument_id")).otherwise(F.array().cast("array<string>")))))
    return rows.select(
        "universe_id", F.col("now_ns").alias("resolved_at_ns"), "underlying", "strike_mode", "top_n", F.when(F.col("error").isNull(), F.col("expiration_ns")).alias("selected_expiry_ns"), "atm_reference", "selected_strikes", "perp_instrument_id", "option_instrument_ids", every_id.alias("all_instrument_ids"), "error"
    )
