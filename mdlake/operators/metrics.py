"""Option-surface metrics of a universe: at-the-money volatility, wings, risk reversal and readiness."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mdlake.functions.scalars import mid, normalize_iv, spread, whole
from mdlake.operators.asof import asof_state, latest_state
from mdlake.operators.universe import atm_strike

HOUR_NS = 3_600_000_000_000


def _surface(keys: list[str], members: DataFrame, reference: Column) -> DataFrame:
    """Conditional averages over members: keys, strike, kind, iv, delta, option_mid, perp_mid.

    Members combine by strike before they meet by key, so a key's many options are few rows there, and nothing is joined back.
    """
    of = lambda kind: F.when(F.col("kind") == kind, F.col("iv"))
    by_strike = members.groupBy(*keys, "strike").agg(
        F.min(F.abs(F.col("strike") - reference)).alias("away"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("iv").isNotNull() & F.col("delta").isNotNull()).alias("ready"),
        F.count_if(F.col("option_mid").isNotNull()).alias("quoted"),
        F.first("perp_mid").alias("perp"),
        F.avg("iv").alias("iv"),
        F.avg(of("P")).alias("put_iv"),
        F.avg(of("C")).alias("call_iv"),
    )
    row = F.struct("strike", "iv", "put_iv", "call_iv")
    whole_key = by_strike.groupBy(*keys).agg(
        F.min_by(row, F.struct("away", "strike")).alias("atm"),
        F.min_by(row, "strike").alias("low"),
        F.max_by(row, "strike").alias("high"),
        F.sum("n").alias("option_count"),
        F.sum("ready").alias("greeks_ready"),
        F.sum("quoted").alias("quotes_ready"),
        F.first("perp").alias("perp_mid"),
    )
    ends = [F.col("atm.strike").alias("atm_strike"), F.col("low.strike").alias("low_strike"), F.col("high.strike").alias("high_strike")]
    means = [F.col("atm.iv").alias("atm_iv"), F.col("low.put_iv").alias("low_put_iv"), F.col("high.call_iv").alias("high_call_iv")]
    return whole_key.select(*keys, *ends, "option_count", "greeks_ready", "quotes_ready", "perp_mid", *means)


def option_state(options: DataFrame, quotes: DataFrame, greeks: DataFrame) -> DataFrame:
    """options with their last quote and greeks: mid, spread, raw_iv, iv, delta."""
    quote = latest_state(quotes, "instrument_id", ["bid_price", "ask_price"])
    greek = latest_state(greeks, "instrument_id", ["mark_iv", "delta"])
    state = options.join(quote, "instrument_id", "left").join(greek, "instrument_id", "left")
    return state.withColumns({"option_mid": mid(), "option_spread": spread(), "raw_iv": F.col("mark_iv"), "iv": normalize_iv("mark_iv")}).drop("bid_price", "ask_price", "mark_iv")


def option_report(options: DataFrame, quotes: DataFrame, greeks: DataFrame) -> DataFrame:
    """Each option with its last quote and greeks in full, its rows, and what it lacks: greeks, volatility or delta.

    greeks: mark_iv, delta, gamma, vega, theta. missing is null for a complete option; volatilities are as captured in
    raw_iv and as fractions in iv.
    """
    rows = lambda df, name: df.groupBy("instrument_id").agg(F.count(F.lit(1)).alias(name))
    quote = latest_state(quotes, "instrument_id", ["bid_price", "ask_price"]).join(rows(quotes, "quote_rows"), "instrument_id")
    greek = latest_state(greeks, "instrument_id", ["mark_iv", "delta", "gamma", "vega", "theta"]).join(rows(greeks, "greek_rows"), "instrument_id")
    state = options.join(quote, "instrument_id", "left").join(greek, "instrument_id", "left")
    missing = F.when(F.col("greek_rows").isNull(), "greeks").when(F.col("mark_iv").isNull(), "mark_iv").when(F.col("delta").isNull(), "delta")
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("quote_rows", "greek_rows")}
    found = state.withColumns({"option_mid": mid(), "option_spread": spread(), "raw_iv": F.col("mark_iv"), "iv": normalize_iv("mark_iv"), "missing": missing, **counts})
    return found.drop("bid_price", "ask_price", "mark_iv")


def option_metrics(options: DataFrame, quotes: DataFrame, greeks: DataFrame, perps: DataFrame, keys: tuple[str, ...] = ("underlying", "expiration_ns")) -> DataFrame:
    """Metrics at the end of the data for each universe (an underlying's expiry).

    Without a perp mid the median of the strikes stands in; one missing wing is allowed. perps: underlying, perp_id.
    """
    keys = list(keys)
    perp = latest_state(quotes, "instrument_id", ["bid_price", "ask_price"]).select(F.col("instrument_id").alias("perp_id"), mid().alias("perp_mid"))
    state = option_state(options, quotes, greeks).join(perps.join(perp, "perp_id"), "underlying", "left")
    middle = state.select(*keys, "strike").distinct().groupBy(*keys).agg(F.median("strike").alias("__median"))
    found = _surface(keys, state.join(middle, keys), F.coalesce("perp_mid", "__median"))
    low, high, atm = F.col("low_put_iv"), F.col("high_call_iv"), F.col("atm_iv")
    wing = F.when(low.isNotNull() & high.isNotNull(), (low + high) / 2).otherwise(F.coalesce(low, high)) - atm
    return found.withColumn("risk_reversal", high - low).withColumn("wing_richness", wing)


def _with_ready_counts(keys: list[str], rows: DataFrame, options: DataFrame, quotes: DataFrame, greeks: DataFrame) -> DataFrame:
    """rows with greeks_ready and quotes_ready: their universe's options with volatility and delta, and with a mid, by now_ns.

    An option is ready from its first values on, so one row for an option and kind stands for all its events.
    """
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.col("ts_event_ns")))
    greek = greeks.groupBy("instrument_id").agg(first("iv").alias("a"), first("delta").alias("b")).filter("a IS NOT NULL AND b IS NOT NULL").select("instrument_id", F.greatest("a", "b").alias("at"), F.lit(1).alias("g"), F.lit(0).alias("q"))
    quote = quotes.groupBy("instrument_id").agg(first("option_mid").alias("at")).filter("at IS NOT NULL").select("instrument_id", "at", F.lit(0).alias("g"), F.lit(1).alias("q"))
    steps = greek.union(quote).join(options.select("instrument_id", *keys), "instrument_id").groupBy(*keys, "at").agg(F.sum("g").alias("g"), F.sum("q").alias("q"))
    none = F.lit(0).cast("long")
    asked = rows.select(*keys, F.col("now_ns").alias("at"), none.alias("g"), none.alias("q"), F.struct("*").alias("row"))
    by = Window.partitionBy(*keys).orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    both = asked.union(steps.withColumn("row", F.lit(None).cast(asked.schema["row"].dataType)))
    counted = both.select("row", F.sum("g").over(by).alias("greeks_ready"), F.sum("q").over(by).alias("quotes_ready"))
    return counted.filter("row IS NOT NULL").select("row.*", "greeks_ready", "quotes_ready")


def option_snapshots(requests: DataFrame, options: DataFrame, quotes: DataFrame, greeks: DataFrame, perps: DataFrame) -> DataFrame:
    """Online-style metrics of each universe at each request time (underlying, now_ns), from the state as of then.

    A snapshot needs a perp mid, an at-the-money volatility and both wings; others are left out. Requests meet the
    expiries of their underlying, one row for each snapshot, and only the options at the three strikes that count are
    looked up as of then; requests and options are never multiplied.
    """
    keys = ["underlying", "expiration_ns"]
    quotes = quotes.withColumn("option_mid", mid())
    greeks = greeks.withColumn("iv", normalize_iv("mark_iv"))
    perp_quotes = quotes.withColumnRenamed("option_mid", "perp_mid").join(perps.select(F.col("perp_id").alias("instrument_id")), "instrument_id", "left_semi")
    asked = requests.select("underlying", "now_ns").distinct().join(perps, "underlying").select("underlying", "now_ns", F.col("perp_id").alias("instrument_id"))
    perp = asof_state(asked, perp_quotes, "instrument_id", ["perp_mid"]).filter("perp_mid IS NOT NULL").select("underlying", "now_ns", "perp_mid")
    listed = options.groupBy(*keys).agg(F.array_sort(F.collect_set("strike")).alias("strikes"), F.count(F.lit(1)).alias("option_count")).filter(F.size("strikes") > 0)
    rows = perp.join(listed, "underlying").filter("expiration_ns > now_ns")
    rows = rows.select(*keys, "now_ns", atm_strike(F.col("strikes"), F.col("perp_mid")).alias("atm_strike"), F.element_at("strikes", 1).alias("low_strike"), F.element_at("strikes", -1).alias("high_strike"), "option_count", "perp_mid")
    # Each row goes along with the options at its strikes, so that nothing is computed twice and joined back.
    roles = F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.col(f"{r}_strike").alias("strike")) for r in ("atm", "low", "high")])).alias("r")
    wanted = rows.select(*keys, "now_ns", F.struct("*").alias("row"), roles).select(*keys, "now_ns", "row", "r.*").join(options.select(*keys, "strike", "kind", "instrument_id"), [*keys, "strike"])
    wanted = wanted.filter("role = 'atm' OR (role = 'low' AND kind = 'P') OR (role = 'high' AND kind = 'C')")
    mean = lambda r: F.avg(F.when(F.col("role") == r, F.col("iv")))
    means = asof_state(wanted, greeks, "instrument_id", ["iv"]).groupBy(*keys, "now_ns").agg(F.first("row").alias("row"), mean("atm").alias("atm_iv"), mean("low").alias("low_put_iv"), mean("high").alias("high_call_iv"))
    ready = means.filter("atm_iv IS NOT NULL AND low_put_iv IS NOT NULL AND high_call_iv IS NOT NULL").select("row.*", "atm_iv", "low_put_iv", "high_call_iv")
    found = _with_ready_counts(keys, ready, options, quotes, greeks).filter("greeks_ready > 0")
    return found.withColumn("risk_reversal", F.col("high_call_iv") - F.col("low_put_iv")).withColumn("wing_richness", (F.col("low_put_iv") + F.col("high_call_iv")) / 2 - F.col("atm_iv"))


def _runs(*columns: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, end) of each run of equal rows."""
    if len(columns[0]):
        cuts = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
        yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(columns[0])], strict=True)


def _exits(times: np.ndarray, start: int, interval_ns: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a block's times: (upto, exit), where the last row let pass ends up for each time of the first one.

    A first row at or before upto[i], and after upto[i - 1], leads to exit[i]. Only times in the block's first interval,
    and the next one, can be the first.
    """
    times = np.unique(times)
    after = np.searchsorted(times, times + interval_ns)
    to = np.where(after < len(times), after, np.arange(len(times)))
    while (to[to] != to).any():
        to = to[to]
    n = min(int(np.searchsorted(times, start + interval_ns)) + 1, len(times))
    ends = times[to[:n]]
    last = np.append(ends[1:] != ends[:-1], True)
    return times[:n][last], ends[last]


def throttle(df: DataFrame, key: str, ts: str, interval_ns: int, seq: str = "seq", block_ns: int | None = None) -> DataFrame:
    """The rows that a snapshot throttle lets pass: the first of a key, then the next at least an interval later.

    Each choice depends on the one before, so time is cut into blocks (of an hour, or four intervals if that is
    longer). A block's task finds where each possible first row leads, a pass over these few rows for each key and
    block links the blocks, and then all blocks are gone through at once: a busy key is as many tasks as it has blocks.
    A task holds the times of one block. Rows without a time are left out; of equal times the least seq passes.
    """
    block_ns = block_ns or max(HOUR_NS, 4 * interval_ns)
    columns = df.columns
    name = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("null"))
    rows = df.filter(F.col(ts).isNotNull()).withColumn("__block", whole(ts, block_ns))

    def exits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple | None = None

        def settled(found: list[tuple]) -> pd.DataFrame:
            led = [(k, b, *_exits(np.concatenate(t), b * block_ns, interval_ns)) for k, b, t in found]
            n = [len(x[2]) for x in led]
            return pd.DataFrame({"k": np.repeat([x[0] for x in led], n), "block": np.repeat([x[1] for x in led], n), "upto": np.concatenate([x[2] for x in led]), "exit": np.concatenate([x[3] for x in led])})

        for pdf in batches:
            done, (k, b, t) = [], (pdf[c].to_numpy() for c in ("k", "block", "t"))
            for at, to in _runs(k, b):
                if held and held[:2] == (k[at], b[at]):
                    held[2].append(t[at:to])
                else:
                    done += [held] if held else []
                    held = (k[at], b[at], [t[at:to]])
            if done:
                yield settled(done)
        if held:
            yield settled([held])

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # last: the last row let pass before the block; now: in the block, once it is known.
        current, block, last, now = object(), None, None, None
        for pdf in batches:
            out = []
            for k, b, upto, end in zip(pdf["k"], pdf["block"], pdf["upto"], pdf["exit"], strict=True):
                if k != current:
                    current, block, last, now = k, None, None, None
                if b != block:
                    last, block, now = now if now is not None else last, b, None
                    out.append((k, b, last))
                if now is None and (last is None or upto >= last + interval_ns):
                    now = end
            yield pd.DataFrame({"k": [x[0] for x in out], "block": [x[1] for x in out], "last": pd.array([x[2] for x in out], "Int64")})

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, due = None, None
        for pdf in batches:
            keep = np.zeros(len(pdf), bool)
            names, blocks, times, lasts = (pdf[c].to_numpy() for c in ("__k", "__block", ts, "__last"))
            for a, z in _runs(names, blocks):
                if (names[a], blocks[a]) != current:
                    current = names[a], blocks[a]
                    due = times[a] if lasts[a] is None else int(lasts[a]) + interval_ns
                at = a + int(np.searchsorted(times[a:z], due))
                while at < z:
                    keep[at], due = True, times[at] + interval_ns
                    at = a + int(np.searchsorted(times[a:z], due))
            yield pdf[keep][columns]

    times = rows.select(name.alias("k"), F.col("__block").alias("block"), F.col(ts).cast("long").alias("t"))
    led = times.repartition("k", "block").sortWithinPartitions("k", "block", "t").mapInPandas(exits, "k string, block long, upto long, exit long")
    linked = led.repartition("k").sortWithinPartitions("k", "block", "upto").mapInPandas(link, "k string, block long, last long")
    linked = linked.select(F.col("k").alias("__k"), F.col("block").alias("__block"), F.col("last").cast("string").alias("__last"))
    dated = rows.withColumn("__k", name).join(linked, ["__k", "__block"])
    return dated.repartition("__k", "__block").sortWithinPartitions("__k", "__block", ts, seq).mapInPandas(pick, df.schema)


def tumbling_snapshots(df: DataFrame, key: str, ts: str, interval_ns: int, seq: str = "seq") -> DataFrame:
    """The parallel variant of the throttle: the first row of each key and interval."""
    slot = whole(ts, interval_ns).alias("__slot")
    row = F.struct(*df.columns)
    return df.groupBy(key, slot).agg(F.min_by(row, F.struct(ts, seq)).alias("row")).select("row.*")
