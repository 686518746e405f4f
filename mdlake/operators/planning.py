"""Capture plans as tables: plan(family, instrument_id, bar_type, data_type, book_type, depth)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLAN = ("family", "instrument_id", "bar_type", "data_type", "book_type", "depth")
PLAN_SCHEMA = "family string, instrument_id string, bar_type string, data_type string, book_type string, depth int"

# Which ids of an option universe each family takes.
OPTION_SCOPES = {
    "instruments": "all", "quotes": "all", "trades": "all", "mark_prices": "all", "instrument_statuses": "all", "instrument_closes": "all",
    "index_prices": "perp", "funding_rates": "perp",
    "option_greeks": "options", "forward_prices": "options", "book_deltas": "options",
}
# The same for an outcome universe.
OUTCOME_SCOPES = {"instruments": "all", "quotes": "outcomes", "trades": "outcomes", "mark_prices": "perp"}


def _expand(resolutions: DataFrame, scopes: dict[str, str], ids: dict[str, str], families: list[str] | None) -> DataFrame:
    """The resolutions are gone through once; lists that many of them share are exploded once for each scope that a chosen family has."""
    chosen = {scope: [f for f, s in scopes.items() if s == scope and (families is None or f in families)] for scope in ids}
    lists = [F.struct(F.array(*map(F.lit, chosen[scope])).alias("families"), F.col(source).alias("ids")) for scope, source in ids.items() if chosen[scope]]
    shared = resolutions.select(F.explode(F.array(*lists)).alias("s")).select("s.families", "s.ids").distinct()
    each = shared.select("families", F.explode("ids").alias("instrument_id")).distinct()
    plan = each.select(F.explode("families").alias("family"), "instrument_id")
    book = F.when(F.col("family") == "book_deltas", "L2_MBP")
    null = F.lit(None).cast("string")
    return plan.select("family", "instrument_id", null.alias("bar_type"), null.alias("data_type"), book.alias("book_type"), F.lit(None).cast("int").alias("depth"))


def expand_universe(resolutions: DataFrame, families: list[str] | None = None) -> DataFrame:
    """The plan of resolved option universes (all_instrument_ids, option_instrument_ids, perp_instrument_id)."""
    rows = resolutions.withColumn("__perp", F.array_compact(F.array("perp_instrument_id")))
    return _expand(rows, OPTION_SCOPES, {"all": "all_instrument_ids", "perp": "__perp", "options": "option_instrument_ids"}, families)


def expand_outcome_universe(resolutions: DataFrame, families: list[str] | None = None) -> DataFrame:
    rows = resolutions.withColumn("__perp", F.array_compact(F.array("perp_instrument_id")))
    return _expand(rows, OUTCOME_SCOPES, {"all": "all_instrument_ids", "outcomes": "outcome_instrument_ids", "perp": "__perp"}, families)


def plan_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Specs of left that right lacks; a spec is equal only as a whole, so another depth is another spec."""
    a, b = left.alias("a"), right.select(*PLAN).distinct().alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in PLAN])
    return a.join(b, same, "left_anti")


def _spec_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """(spec, __l, __r): how often each plan has a spec; counts combine before their shuffle, and each plan is gone through once."""
    side = lambda df, l, r: df.select(*PLAN, F.lit(l).alias("__l"), F.lit(r).alias("__r"))
    return side(left, 1, 0).union(side(right, 0, 1)).groupBy(*PLAN).agg(F.sum("__l").alias("__l"), F.sum("__r").alias("__r"))


def _times(n: Column) -> Column:
    """Rows as often as n says."""
    return F.explode(F.array_repeat(F.lit(0), n.cast("int"))).alias("__n")


def plan_delta(previous: DataFrame, following: DataFrame) -> DataFrame:
    """(change, spec): what to add and to remove, as often as the plan has it."""
    alone = _spec_counts(previous, following).filter("__l = 0 OR __r = 0")
    return alone.select(F.when(F.col("__l") == 0, "add").otherwise("remove").alias("change"), *PLAN, _times(F.col("__l") + F.col("__r"))).drop("__n")


def merge_plans(base: DataFrame, additions: DataFrame) -> DataFrame:
    """base as it is, duplicates included, and each new spec once."""
    return _spec_counts(base, additions).select(*PLAN, _times(F.greatest(F.col("__l"), F.lit(1)))).drop("__n")


def effective_plan(static: DataFrame, options: DataFrame | None, outcomes: DataFrame | None, supplemental: DataFrame | None = None) -> DataFrame:
    """The static plan with the dynamic ones; the supplemental plan counts if just one of these is dynamic."""
    plan = static
    for part in (options, outcomes):
        if part is not None:
            plan = merge_plans(plan, part)
    if supplemental is not None and (options is None) != (outcomes is None):
        plan = merge_plans(plan, supplemental)
    return plan


def apply_plan(events: DataFrame, plan: DataFrame) -> DataFrame:
    """Events (family, instrument_id) that the plan names. Spark broadcasts the plan's keys if they are small."""
    return events.join(plan.select("family", "instrument_id").distinct(), ["family", "instrument_id"], "left_semi")


def forward_price_targets(events: DataFrame, plan: DataFrame) -> DataFrame:
    return events.join(plan.filter("family = 'forward_prices'").select("instrument_id").distinct(), "instrument_id", "left_semi")


def overlap_and_new(existing: DataFrame, candidate: DataFrame) -> DataFrame:
    """(instrument_id, status): candidates that exist already (overlap) and those that don't (new)."""
    ids = candidate.select("instrument_id").distinct()
    known = existing.select("instrument_id", F.lit("overlap").alias("__s")).distinct()
    return ids.join(known, "instrument_id", "left").select("instrument_id", F.coalesce("__s", F.lit("new")).alias("status"))


def retired_ids(changes: DataFrame, active_plan: DataFrame) -> DataFrame:
    """Removed ids that are neither a change's perp nor still planned. changes: removed_instrument_ids, perp_instrument_id."""
    removed = changes.select(F.explode("removed_instrument_ids").alias("instrument_id")).distinct()
    perps = changes.select(F.col("perp_instrument_id").alias("instrument_id")).distinct()
    return removed.join(perps, "instrument_id", "left_anti").join(active_plan.select("instrument_id").distinct(), "instrument_id", "left_anti")


def members(resolutions: DataFrame, key: str = "universe_id") -> DataFrame:
    """(universe, instrument): an instrument may belong to many universes."""
    return resolutions.select(key, F.explode("all_instrument_ids").alias("instrument_id")).distinct()


def plan_summary(plan: DataFrame) -> DataFrame:
    """Specs for each family, and whether the family is enabled."""
    return plan.groupBy("family").agg(F.count(F.lit(1)).alias("specs"), F.count_distinct("instrument_id").alias("instruments"))


def planned_instruments(plan: DataFrame) -> DataFrame:
    """The distinct planned ids; bars and custom data name none."""
    return plan.filter("family NOT IN ('bars', 'custom_data', 'custom_data_requests') AND instrument_id IS NOT NULL").select("instrument_id").distinct()


def enabled_families(plan: DataFrame) -> DataFrame:
    """Families with a spec; instruments too if any id is planned; subscribed and requested custom data share one."""
    own = plan.select(F.when(F.col("family") == "custom_data_requests", "custom_data").otherwise(F.col("family")).alias("family"))
    return own.union(planned_instruments(plan).select(F.lit("instruments"))).distinct()
