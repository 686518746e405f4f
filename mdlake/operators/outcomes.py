"""Outcome markets: from listing documents to the market and instruments of each universe, and their rolls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mdlake.functions import scalars as S
from mdlake.session import parked

LISTING_SCHEMA = (
    "questions array<struct<question:bigint,name:string,description:string,namedOutcomes:array<bigint>,fallbackOutcome:bigint>>,"
    "outcomes array<struct<outcome:bigint,name:string,description:string>>"
)


def candidates(listings: DataFrame, include_fallback: bool = False) -> DataFrame:
    """(snapshot_id, now_ns, question_id, name, description, outcome_ids) of listing documents (snapshot_id, now_ns, payload).

    Questions without an id or named outcomes and outcomes without an id are skipped; an outcome is its own question.
    """
    parsed = listings.select("snapshot_id", "now_ns", F.from_json("payload", LISTING_SCHEMA).alias("p"))
    item = lambda id_, x, ids: F.struct(id_.alias("question_id"), x["name"].alias("name"), F.coalesce(x["description"], F.lit("")).alias("description"), ids.alias("outcome_ids"))

    def named(q: Column) -> Column:
        ids = F.filter(q["namedOutcomes"], lambda x: x.isNotNull())
        return F.when(q["fallbackOutcome"].isNotNull(), F.concat(ids, F.array(q["fallbackOutcome"]))).otherwise(ids) if include_fallback else ids

    # A document is parsed once for both of its lists.
    questions = F.transform(F.filter("p.questions", lambda q: q["question"].isNotNull() & (F.size(F.filter(q["namedOutcomes"], lambda x: x.isNotNull())) > 0)), lambda q: item(q["question"], q, named(q)))
    outcomes = F.transform(F.filter("p.outcomes", lambda o: o["outcome"].isNotNull()), lambda o: item(o["outcome"], o, F.array(o["outcome"])))
    none = F.array().cast("array<struct<question_id:bigint,name:string,description:string,outcome_ids:array<bigint>>>")
    return parsed.select("snapshot_id", "now_ns", F.inline(F.concat(F.coalesce(questions, none), F.coalesce(outcomes, none))))


def choose_market(df: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: the nearest expiry from now on, else the latest past one, else the highest id; ids break ties."""
    row = F.struct(*[c for c in df.columns if c not in keys])
    order = F.struct("expiration_ns", "question_id")
    known, future = F.col("expiration_ns") > 0, (F.col("expiration_ns") > 0) & (F.col("expiration_ns") >= F.col("now_ns"))
    best = F.coalesce(F.min_by(F.when(future, row), F.when(future, order)), F.max_by(F.when(known, row), F.when(known, order)), F.max_by(row, F.col("question_id")))
    return df.groupBy(*keys).agg(best.alias("m")).select(*keys, "m.*")


def _matched(found: DataFrame, specs: DataFrame) -> DataFrame:
    """Candidates with the specs that their description matches, its fields and its expiry.

    Specs are the settings of universes, so they are broadcast: a shuffle by underlying would give each one a single task.
    """
    fields = found.withColumn("fields", S.parse_description("description"))
    fields = fields.withColumn("__u", F.lower(F.try_element_at("fields", F.lit("underlying"))))
    matched = fields.join(F.broadcast(specs.withColumn("__u", F.lower("spec_underlying"))), "__u").filter(S.matches_market("fields", F.col("market_class"), F.col("spec_underlying"), F.col("spec_period")))
    return matched.withColumn("expiration_ns", S.expiry_ns(F.coalesce(F.try_element_at("fields", F.lit("expiry")), F.lit("")))).drop("__u")


def _shortlist(matched: DataFrame, keys: list[str]) -> DataFrame:
    """(snapshot_id, question_id) of the questions that choose_market may choose; numbers alone decide, and combine before their shuffle."""
    timed = matched.groupBy(*keys, "now_ns", "expiration_ns").agg(F.min("question_id").alias("low"), F.max("question_id").alias("high"))
    known, future = F.col("expiration_ns") > 0, (F.col("expiration_ns") > 0) & (F.col("expiration_ns") >= F.col("now_ns"))
    place = lambda q: F.struct("expiration_ns", F.col(q).alias("question_id"))
    best = F.coalesce(F.min(F.when(future, place("low"))), F.max(F.when(known, place("high"))), F.max_by(place("high"), F.col("high")))
    return timed.groupBy(*keys).agg(best.alias("w")).select("snapshot_id", "w.question_id").distinct()


def resolve_outcome_markets(listings: DataFrame, specs: DataFrame, include_fallback: bool = False) -> DataFrame:
    """The market of each (snapshot, spec). specs: universe_id, market_class, spec_underlying, spec_period, include_perp.

    The shortlist of questions is kept, so that Spark knows its size; whole rows are made and compared of these alone.
    """
    keys = ["snapshot_id", "universe_id"]
    found = candidates(listings, include_fallback)
    listed = parked(_shortlist(_matched(found, specs), keys), "shortlist").alias("s")
    same = F.col("c.snapshot_id").eqNullSafe(F.col("s.snapshot_id")) & (F.col("c.question_id") == F.col("s.question_id"))
    chosen = choose_market(_matched(found.alias("c").join(listed, same, "left_semi"), specs), keys)
    outcomes = S.outcome_instruments("outcome_ids")
    perp = F.when(F.col("include_perp"), F.concat(F.upper("spec_underlying"), F.lit("-USD-PERP.HYPERLIQUID")))
    return chosen.select(
        "snapshot_id", "universe_id", "now_ns", "question_id", "name", "expiration_ns", "outcome_ids", S.start_price("fields").alias("start_price"), S.thresholds(F.try_element_at("fields", F.lit("priceThresholds"))).alias("price_thresholds"), outcomes.alias("outcome_instrument_ids"), perp.alias("perp_instrument_id"),
        F.concat(F.when(perp.isNotNull(), F.array(perp)).otherwise(F.array().cast("array<string>")), outcomes).alias("all_instrument_ids"),
    )


def refresh_outcome_universes(resolutions: DataFrame, key: str = "universe_id", at: str = "now_ns") -> DataFrame:
    """The resolutions whose id set differs from the one before, with added and removed ids and the reason."""
    order = Window.partitionBy(key).orderBy(at)
    before = {c: F.lag(c).over(order) for c in ("all_instrument_ids", "question_id", "expiration_ns")}
    rows = resolutions.withColumns({f"__{c}": v for c, v in before.items()}).filter("__all_instrument_ids IS NOT NULL")
    rows = rows.withColumns({"added_instrument_ids": F.array_sort(F.array_except("all_instrument_ids", "__all_instrument_ids")), "removed_instrument_ids": F.array_sort(F.array_except("__all_instrument_ids", "all_instrument_ids"))})
    reason = F.when(F.col("__question_id") != F.col("question_id"), "question_roll").when(F.col("__expiration_ns") != F.col("expiration_ns"), "expiry_roll")
    changed = rows.filter((F.size("added_instrument_ids") > 0) | (F.size("removed_instrument_ids") > 0)).withColumn("rollover_reason", reason)
    return changed.withColumn("event_kind", F.lit("refresh")).drop(*[f"__{c}" for c in before])
