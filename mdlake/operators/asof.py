"""Latest state, as-of lookups and carried-forward state.

Windows never span a key's whole history: events are cut by (key, block), a day unless the caller names a shorter
block for busier keys, and the last state of earlier blocks is carried in from an aggregate that has one row for each
key and block and combines before its shuffle, so that one busy instrument is many small windows. Every order ends with a unique column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mdlake.functions.scalars import whole
from mdlake.sources.derived import DAY_NS

ORDER = ("ts_event_ns", "ts_init_ns", "seq")


def latest_state(df: DataFrame, key: str | list[str], columns: list[str], order: tuple[str, ...] = ORDER) -> DataFrame:
    """Per key the last non-null value of each column; combines before the shuffle."""
    keys = [key] if isinstance(key, str) else key
    by = F.struct(*order)
    return df.groupBy(*keys).agg(*[F.expr(f"max_by({c}, struct({', '.join(order)})) FILTER (WHERE {c} IS NOT NULL)").alias(c) for c in columns], F.max(by).alias("__at")).drop("__at")


def _day(ns: Column, block_ns: int = DAY_NS) -> Column:
    return whole(ns, block_ns)


#: Rows of a key's block that one task is meant to hold.
BLOCK_ROWS = 1_000_000


def block_length(events: DataFrame, key: str, ts: str = ORDER[0], rows: int = BLOCK_ROWS) -> int:
    """A length of blocks by counts: a day, cut in halves until no key has more than `rows` events in one, down to a second.

    Only the key and the time are read; counts by key and second combine before the shuffle, and one row comes back.
    """
    second = 1_000_000_000
    counts = events.groupBy(key, whole(F.col(ts), second).alias("__s")).agg(F.count(F.lit(1)).alias("n"))
    for k in range(17):
        length = DAY_NS // second >> k
        busiest = counts.groupBy(key, whole(F.col("__s"), length)).agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
        if (busiest or 0) <= rows:
            return length * second
    return second


def asof_state(requests: DataFrame, events: DataFrame, key: str, columns: list[str], now: str = "now_ns", order: tuple[str, ...] = ORDER, block_ns: int = DAY_NS) -> DataFrame:
    """requests (key, now) with the last non-null value of each column among the key's events up to and including now.

    Events are read and shuffled once, by (key, block): the search within a block and the last values of each block both
    start from that exchange. block_ns: from block_length() where keys are busy.
    """
    request_columns = [c for c in requests.columns if c not in columns]
    # A request comes after the events of its own nanosecond.
    at = lambda t, late, by: F.struct(t.cast("long").alias("t"), F.lit(late).alias("late"), *[x.cast("long").alias(f"o{k}") for k, x in enumerate(by)])
    rows = requests.select(key, at(F.col(now), 1, [F.lit(None)] * len(order)).alias("__at"), F.struct(*request_columns).alias("__request"), *[F.lit(None).cast(events.schema[c].dataType).alias(c) for c in columns])
    states = events.select(key, at(F.col(order[0]), 0, [F.col(c) for c in order]).alias("__at"), F.lit(None).cast(rows.schema["__request"].dataType).alias("__request"), *columns)
    both = rows.union(states).withColumn("__day", _day(F.col("__at.t"), block_ns))
    # Both sides below use every column of `both`, and rows that meet nothing go before, so that they share its exchange.
    both = both.filter(F.col(key).isNotNull() & F.col("__day").isNotNull()).repartition(key, "__day")
    last = [F.expr(f"max_by({c}, __at) FILTER (WHERE {c} IS NOT NULL AND __request IS NULL)").alias(c) for c in columns]
    earlier = Window.partitionBy(key).orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    sums = both.groupBy(key, "__day").agg(*last, F.count("__request").alias("__asked"))
    carried = sums.select(key, "__day", "__asked", *[F.last(c, ignorenulls=True).over(earlier).alias(f"__carried_{c}") for c in columns]).filter("__asked > 0").drop("__asked")
    within = Window.partitionBy(key, "__day").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    found = both.select("*", *[F.last(c, ignorenulls=True).over(within).alias(f"__last_{c}") for c in columns]).filter("__request IS NOT NULL")
    return found.join(carried, [key, "__day"]).select("__request.*", *[F.coalesce(f"__last_{c}", f"__carried_{c}").alias(c) for c in columns])


def ffill_state(events: DataFrame, key: str, columns: list[str], order: tuple[str, ...] = ORDER, block_ns: int = DAY_NS) -> DataFrame:
    """events with each column's null replaced by the key's last earlier value."""
    by = F.struct(*order)
    dated = events.withColumn("__day", _day(F.col(order[0]), block_ns))
    last = [F.expr(f"max_by({c}, struct({', '.join(order)})) FILTER (WHERE {c} IS NOT NULL)").alias(c) for c in columns]
    earlier = Window.partitionBy(key).orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    carried = dated.groupBy(key, "__day").agg(*last).select(key, "__day", *[F.last(c, ignorenulls=True).over(earlier).alias(f"__carried_{c}") for c in columns])
    within = Window.partitionBy(key, "__day").orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    filled = dated.select(*[c for c in dated.columns if c not in columns], *[F.last(c, ignorenulls=True).over(within).alias(c) for c in columns]).join(carried, [key, "__day"], "left")
    return filled.select(*[F.coalesce(c, f"__carried_{c}").alias(c) if c in columns else F.col(c) for c in events.columns])


def gate_on_definition(events: DataFrame, instruments: DataFrame, ts: str = "ts_init_ns") -> DataFrame:
    """Events from the moment on at which their instrument's first definition had arrived."""
    ready = instruments.groupBy("instrument_id").agg(F.min("ts_init_ns").alias("__ready"))
    return events.join(ready, "instrument_id").filter(F.col(ts) >= F.col("__ready")).drop("__ready")


def universe_intervals(resolutions: DataFrame, key: str = "universe_id") -> DataFrame:
    """(key, instrument_id, from_ns, until_ns): when each id belongs to a universe, until the next resolution."""
    order = Window.partitionBy(key).orderBy("resolved_at_ns")
    timed = resolutions.withColumn("until_ns", F.lead("resolved_at_ns").over(order))
    return timed.select(key, F.explode("all_instrument_ids").alias("instrument_id"), F.col("resolved_at_ns").alias("from_ns"), "until_ns")


def apply_universe_history(events: DataFrame, resolutions: DataFrame, key: str = "universe_id", ts: str = "ts_event_ns") -> DataFrame:
    """Events while their id is in a universe: equal id first, then the interval [resolved_at, next resolution).

    Intervals are cut at days and joined on (id, day), so that an id's history isn't compared as a whole.
    """
    spans = universe_intervals(resolutions, key)
    last = events.agg(F.max(_day(F.col(ts)))).first()[0]
    if last is None:
        last = 0
    days = F.explode(F.sequence(_day(F.col("from_ns")), F.greatest(_day(F.col("from_ns")), F.least(_day(F.coalesce(F.col("until_ns"), F.lit((last + 1) * DAY_NS)) - 1), F.lit(last)))))
    spans = spans.select(key, "instrument_id", "from_ns", "until_ns", days.alias("__day"))
    dated = events.withColumn("__day", _day(F.col(ts)))
    inside = (F.col(ts) >= F.col("from_ns")) & (F.col("until_ns").isNull() | (F.col(ts) < F.col("until_ns")))
    return dated.join(spans, ["instrument_id", "__day"]).filter(inside).drop("__day", "from_ns", "until_ns")


def perp_reference(requests: DataFrame, sources: list[tuple[str, DataFrame, Column]], perp: str = "perp_id") -> DataFrame:
    """requests (with a perp id and now_ns) and atm_reference, atm_reference_source: the first source that has a value.

    sources: (label, events by instrument_id, value), in order of preference; values must be finite and above zero.
    """
    out = requests
    for k, (_, events, value) in enumerate(sources):
        name = f"__ref_{k}"
        valued = events.select(F.col("instrument_id").alias(perp), value.alias(name), *ORDER).filter(f"{name} > 0 AND NOT isnan({name})")
        out = asof_state(out, valued, perp, [name])
    names = [f"__ref_{k}" for k in range(len(sources))]
    label = reduce(lambda c, k: c.when(F.col(names[k]).isNotNull(), sources[k][0]), range(1, len(sources)), F.when(F.col(names[0]).isNotNull(), sources[0][0]))
    return out.select(*requests.columns, F.coalesce(*names).alias("atm_reference"), label.alias("atm_reference_source"))
