"""Resolution history: what changed from one resolution to the next, why, and whether the log is sound."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mdlake.functions.scalars import iso8601
from mdlake.session import parked

REASONS = ("expiry_roll", "atm_drift", "oi_rank_shift", "strike_window_shift")
OUTCOME_REASONS = ("question_roll", "expiry_roll")
RESOLUTION_SCHEMA = (
    "event_kind string, venue_id string, underlying string, resolved_at_ns bigint, resolved_at_iso8601 string, selected_expiry_ns bigint, selected_expiry_iso8601 string, atm_reference string, atm_reference_source string, "
    "strike_selection_mode string, oi_ranked_top_n int, selected_strikes array<string>, perp_instrument_id string, option_instrument_ids array<string>, all_instrument_ids array<string>, added_instrument_ids array<string>, removed_instrument_ids array<string>, rollover_reason string"
)


def resolution_delta(resolutions: DataFrame, key: str = "universe_id", at: str = "resolved_at_ns") -> DataFrame:
    """Each resolution with the ids added and removed since the one before (null for the first)."""
    before = F.lag("all_instrument_ids").over(Window.partitionBy(key).orderBy(at))
    rows = resolutions.withColumn("__before", before)
    return rows.withColumns({"added_instrument_ids": F.array_sort(F.array_except("all_instrument_ids", "__before")), "removed_instrument_ids": F.array_sort(F.array_except("__before", "all_instrument_ids"))}).drop("__before")


def rollover_reason(resolutions: DataFrame, key: str = "universe_id", at: str = "resolved_at_ns") -> DataFrame:
    """resolution_delta with the reason: expiry first, then the reference, then the strikes; null if no id changed."""
    order = Window.partitionBy(key).orderBy(at)
    rows = resolution_delta(resolutions, key, at).withColumns({"__expiry": F.lag("selected_expiry_ns").over(order), "__atm": F.lag("atm_reference").over(order)})
    changed = (F.size("added_instrument_ids") > 0) | (F.size("removed_instrument_ids") > 0)
    reason = (
        F.when(~F.coalesce(changed, F.lit(False)), None)
        .when(F.col("__expiry") != F.col("selected_expiry_ns"), "expiry_roll")
        .when(F.col("__atm") != F.col("atm_reference"), "atm_drift")
        .when(F.col("strike_mode") == "oi_ranked", "oi_rank_shift")
        .otherwise("strike_window_shift")
    )
    return rows.withColumn("rollover_reason", reason).drop("__expiry", "__atm")


class Smoothing:
    """Whether a change of strikes is applied: at once if the expiry changed, else when seen `required` times in a row."""

    def __init__(self, required: int):
        self.required, self.pending, self.count = required, None, 0

    def applies(self, current: list, candidate: list, expiry_changed: bool) -> bool:
        if expiry_changed or not self.required or current == candidate:
            self.pending, self.count = None, 0
            return True
        self.count = self.count + 1 if self.pending == candidate else 1
        self.pending = candidate
        if self.count >= self.required:
            self.pending, self.count = None, 0
            return True
        return False


def _as_list(x) -> list:
    return [] if x is None else list(x)


def smooth_strikes(resolutions: DataFrame, required: int = 2, key: str = "universe_id", at: str = "resolved_at_ns") -> DataFrame:
    """Resolutions with `applied` and `applied_strikes`: which strikes hold after each one.

    Whether a change is applied depends on all before it, so a universe's refreshes are streamed in order; a task
    keeps the state of one universe and holds no group. Only open-interest ranking is smoothed.
    """
    columns = resolutions.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current = object()
        strikes, expiry, state = [], None, None
        for pdf in batches:
            applied, held = [], []
            for k, own, e, mode in zip(pdf[key], pdf["selected_strikes"], pdf["selected_expiry_ns"], pdf["strike_mode"], strict=True):
                own = _as_list(own)
                if k != current:
                    current, strikes, expiry, state = k, own, e, Smoothing(required)
                    ok = True
                else:
                    ok = mode != "oi_ranked" or state.applies(strikes, own, e != expiry)
                if ok:
                    strikes, expiry = own, e
                applied.append(ok)
                held.append(strikes)
            yield pdf.assign(applied=applied, applied_strikes=held)[[*columns, "applied", "applied_strikes"]]

    schema = resolutions.schema.add("applied", "boolean").add("applied_strikes", resolutions.schema["selected_strikes"].dataType)
    return resolutions.repartition(key).sortWithinPartitions(key, at).mapInPandas(run, schema)


def applied_resolutions(good: DataFrame, confirmations: int = 2, key: str = "universe_id", at: str = "resolved_at_ns") -> DataFrame:
    """The resolutions that hold after smoothing. Their strikes go through it as digests, and their ids not at all."""
    digest = F.sha2(F.array_join(F.transform(F.coalesce("selected_strikes", F.array()), lambda s: s.cast("string")), ","), 256)
    narrow = good.select(key, at, "selected_expiry_ns", "strike_mode", F.array(digest).alias("selected_strikes"))
    kept = smooth_strikes(narrow, confirmations, key, at).filter("applied").select(key, at).distinct().alias("k")
    return good.alias("g").join(kept, F.col(f"g.{key}").eqNullSafe(F.col(f"k.{key}")) & F.col(f"g.{at}").eqNullSafe(F.col(f"k.{at}")), "left_semi")


def refresh_option_universes(resolutions: DataFrame, confirmations: int = 2, key: str = "universe_id", at: str = "resolved_at_ns") -> DataFrame:
    """The refresh records of an ordered resolution history: only changes of the id set, with their reason.

    A failed resolution (error not null) keeps what was applied; a smoothed-away one does not move the expiry and
    reference that later ones are compared with.
    """
    smoothed = applied_resolutions(resolutions.filter("error IS NULL"), confirmations, key, at)
    changed = rollover_reason(smoothed, key, at).filter("rollover_reason IS NOT NULL")
    return changed.withColumn("event_kind", F.lit("refresh"))


def startup_records(resolutions: DataFrame, key: str = "universe_id", at: str = "resolved_at_ns") -> DataFrame:
    """The first good resolution of each universe as its startup record."""
    good = resolutions.filter("error IS NULL")
    row = F.struct(*good.columns)
    none = F.array().cast("array<string>")
    first = good.groupBy(key).agg(F.min_by(row, F.col(at)).alias("r")).select("r.*")
    return first.withColumns({"added_instrument_ids": none, "removed_instrument_ids": none, "rollover_reason": F.lit(None).cast("string"), "event_kind": F.lit("startup")})


def resolution_records(resolutions: DataFrame, confirmations: int = 2) -> DataFrame:
    """The log of a resolution history in its 18 fields: a startup record for each universe and its refreshes."""
    smoothed = applied_resolutions(resolutions.filter("error IS NULL"), confirmations)
    first = F.row_number().over(Window.partitionBy("universe_id").orderBy("resolved_at_ns")) == 1
    # A universe's first resolution always holds, so startups and refreshes come from one pass.
    rows = rollover_reason(smoothed).withColumn("__first", first).filter("__first OR rollover_reason IS NOT NULL")
    none = F.array().cast("array<string>")
    both = rows.withColumn("event_kind", F.when(F.col("__first"), "startup").otherwise("refresh")).withColumns({c: F.when(F.col("__first"), none).otherwise(F.col(c)) for c in ("added_instrument_ids", "removed_instrument_ids")})
    text = lambda c: F.transform(c, lambda s: s.cast("long").cast("string"))
    return both.select(
        "event_kind", F.col("universe_id").alias("venue_id"), "underlying", "resolved_at_ns", iso8601("resolved_at_ns").alias("resolved_at_iso8601"), "selected_expiry_ns", iso8601("selected_expiry_ns").alias("selected_expiry_iso8601"), F.col("atm_reference").cast("string").alias("atm_reference"), F.lit("perp_quote_mid").alias("atm_reference_source"),
        F.col("strike_mode").alias("strike_selection_mode"), F.when(F.col("strike_mode") == "oi_ranked", F.col("top_n")).alias("oi_ranked_top_n"), text("selected_strikes").alias("selected_strikes"), "perp_instrument_id", "option_instrument_ids", "all_instrument_ids", "added_instrument_ids", "removed_instrument_ids", "rollover_reason",
    )


#: The outcome log's own record.
OUTCOME_SCHEMA = (
    "event_kind string, venue_id string, underlying string, period string, market_class string, resolved_at_ns bigint, resolved_at_iso8601 string, question_id bigint, expiration_ns bigint, expiration_iso8601 string, outcome_ids array<bigint>, perp_instrument_id string, "
    "outcome_instrument_ids array<string>, all_instrument_ids array<string>, added_instrument_ids array<string>, removed_instrument_ids array<string>, rollover_reason string"
)


def outcome_records(resolutions: DataFrame, refreshes: DataFrame, specs: DataFrame, key: str = "universe_id", at: str = "now_ns") -> DataFrame:
    """The outcome log of a resolution history in its 17 fields: a startup record for each universe and its refreshes.

    resolutions: as from resolve_outcome_markets; refreshes: as from refresh_outcome_universes; specs: the universes.
    """
    none = F.array().cast("array<string>")
    first = resolutions.groupBy(key).agg(F.min_by(F.struct(*[c for c in resolutions.columns if c != key]), at).alias("r")).select(key, "r.*")
    first = first.withColumns({"added_instrument_ids": none, "removed_instrument_ids": none, "rollover_reason": F.lit(None).cast("string"), "event_kind": F.lit("startup")})
    rows = first.unionByName(refreshes.select(*first.columns)).join(specs.select(key, "market_class", "spec_underlying", "spec_period"), key)
    return rows.select(
        "event_kind", F.col(key).alias("venue_id"), F.col("spec_underlying").alias("underlying"), F.col("spec_period").alias("period"), "market_class", F.col(at).alias("resolved_at_ns"), iso8601(at).alias("resolved_at_iso8601"), "question_id", "expiration_ns", iso8601("expiration_ns").alias("expiration_iso8601"),
        F.col("outcome_ids").cast("array<bigint>").alias("outcome_ids"), "perp_instrument_id", "outcome_instrument_ids", "all_instrument_ids", "added_instrument_ids", "removed_instrument_ids", "rollover_reason",
    )


def append_resolutions(records: DataFrame, path: str) -> None:
    """Append records of either log as JSON lines."""
    records.write.mode("append").json(path)


_BAD = "__bad"


def _parsed(lines: DataFrame, schema: str) -> DataFrame:
    """lines with `r`, the record of each line that isn't blank, and in r.__bad the line if it is none."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    return lines.filter(F.trim("value") != "").withColumn("r", F.from_json("value", f"{schema}, {_BAD} string", options))


def bad_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(path, line, text) of the lines that are no record of the log; lines count from 1 in each file.

    Lines are judged in one scan; only files that hold a bad one are read again as a whole, to count their lines.
    """
    judged = _parsed(spark.read.text(path).withColumn("path", F.col("_metadata.file_path")), schema)
    files = [r[0] for r in judged.filter(f"r.{_BAD} IS NOT NULL").select("path").distinct().collect()]
    if not files:
        return spark.createDataFrame([], "path string, line int, text string")
    texts = spark.read.text(files, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", "\r?\n")).alias("at", "value"))
    return _parsed(texts, schema).filter(f"r.{_BAD} IS NOT NULL").select("path", (F.col("at") + 1).alias("line"), F.col("value").alias("text"))


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A log of JSON lines; blank lines are skipped, and a line that is no record is an error that names its file and line."""
    if found := bad_lines(spark, path, schema).orderBy("path", "line").take(1):
        raise ValueError(f"{found[0]['path']}, line {found[0]['line']}: not a record of the log: {found[0]['text'][:200]}")
    names = spark.createDataFrame([], schema).columns
    return _parsed(spark.read.text(path), schema).select(*[F.col(f"r.{c}").alias(c) for c in names])


def read_resolutions(spark: SparkSession, path: str) -> DataFrame:
    """The option-universe log."""
    return read_log(spark, path, RESOLUTION_SCHEMA)


def read_outcome_resolutions(spark: SparkSession, path: str) -> DataFrame:
    """The outcome-universe log."""
    return read_log(spark, path, OUTCOME_SCHEMA)


def summarize_resolutions(records: DataFrame) -> DataFrame:
    """First and latest record and the number of refreshes for each (venue, underlying)."""
    at = F.col("resolved_at_ns")
    return records.groupBy("venue_id", "underlying").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("event_kind") == "refresh").alias("refreshes"), F.min(at).alias("first_ns"), F.max(at).alias("latest_ns"), F.max_by("selected_expiry_ns", at).alias("latest_expiry_ns"), F.max_by("rollover_reason", at).alias("latest_reason")
    )


def _violation(condition, rule: str, actual) -> F.Column:
    return F.when(condition, F.struct(F.lit(rule).alias("rule"), actual.cast("string").alias("actual")))


def validate_lineage(records: DataFrame, require_refresh: bool = False, require_perp: bool = True, profile: str | None = None, top_n: int = 0, min_strikes: int = 5) -> DataFrame:
    """(rule, venue_id, underlying, resolved_at_ns, actual): every broken rule of a resolution log."""
    keys = ["venue_id", "underlying"]
    lists = {"__strikes": "selected_strikes", "__options": "option_instrument_ids", "__added": "added_instrument_ids", "__removed": "removed_instrument_ids"}
    # Of the lists only their sizes are judged; these short rows are used twice.
    records = parked(records.select(*keys, "resolved_at_ns", "event_kind", "strike_selection_mode", "oi_ranked_top_n", "rollover_reason", "perp_instrument_id", *[F.size(c).alias(n) for n, c in lists.items()]), "lineage")
    startup, refresh = F.col("event_kind") == "startup", F.col("event_kind") == "refresh"
    groups = records.groupBy(*keys).agg(F.count_if(startup).alias("startups"), F.count_if(refresh).alias("refreshes"), F.min(F.when(startup, F.col("strike_selection_mode"))).alias("mode"))
    rows = records.join(groups.select(*keys, "mode"), keys)
    empty = lambda c: F.coalesce(F.col(c) <= 0, F.lit(True))
    strikes, ids = F.col("__strikes"), F.col("__options")
    own = [
        _violation(startup & (F.coalesce("strike_selection_mode", F.lit("")) == ""), "startup_mode", F.col("strike_selection_mode")),
        _violation(startup & empty("__options"), "startup_options", ids),
        _violation(refresh & ~F.col("strike_selection_mode").eqNullSafe(F.col("mode")), "refresh_mode", F.col("strike_selection_mode")),
        _violation(refresh & ~F.coalesce(F.col("rollover_reason").isin(*REASONS), F.lit(False)), "refresh_reason", F.col("rollover_reason")),
        _violation(refresh & empty("__added") & empty("__removed"), "refresh_change", F.lit("none")),
    ]
    if require_perp:
        own.append(_violation(startup & (F.coalesce("perp_instrument_id", F.lit("")) == ""), "startup_perp", F.col("perp_instrument_id")))
    if profile == "oi_ranked":
        own += [
            _violation(startup & ~F.col("strike_selection_mode").eqNullSafe("oi_ranked"), "profile_mode", F.col("strike_selection_mode")),
            _violation(startup & ~F.col("oi_ranked_top_n").eqNullSafe(F.lit(top_n)), "profile_top_n", F.col("oi_ranked_top_n")),
            _violation(startup & ~strikes.between(1, top_n), "profile_strikes", strikes),
        ]
    if profile == "all":
        own += [
            _violation(startup & ~F.col("strike_selection_mode").eqNullSafe("all"), "profile_mode", F.col("strike_selection_mode")),
            _violation(startup & F.col("oi_ranked_top_n").isNotNull(), "profile_top_n", F.col("oi_ranked_top_n")),
            _violation(startup & (strikes < min_strikes), "profile_strikes", strikes),
        ]
    if profile:
        own.append(_violation(startup & (ids != 2 * strikes), "profile_options", ids))
    found = rows.select(*keys, "resolved_at_ns", F.explode(F.array_compact(F.array(*own))).alias("v"))
    whole = [_violation(F.col("startups") != 1, "one_startup", F.col("startups"))]
    if require_refresh:
        whole.append(_violation(F.col("refreshes") == 0, "refresh_required", F.col("refreshes")))
    groups = groups.select(*keys, F.lit(None).cast("long").alias("resolved_at_ns"), F.explode(F.array_compact(F.array(*whole))).alias("v"))
    return found.union(groups).select("v.rule", *keys, "resolved_at_ns", "v.actual")


def validate_outcome_lineage(records: DataFrame, key: str = "universe_id", at: str = "now_ns") -> DataFrame:
    """Broken rules of outcome refresh records: kind, a null or known reason, and some change."""
    empty = lambda c: F.coalesce(F.size(c) <= 0, F.lit(True))
    own = [
        _violation(~F.col("event_kind").eqNullSafe("refresh"), "event_kind", F.col("event_kind")),
        _violation(F.col("rollover_reason").isNotNull() & ~F.col("rollover_reason").isin(*OUTCOME_REASONS), "refresh_reason", F.col("rollover_reason")),
        _violation(empty("added_instrument_ids") & empty("removed_instrument_ids"), "refresh_change", F.lit("none")),
    ]
    return records.select(key, at, F.explode(F.array_compact(F.array(*own))).alias("v")).select("v.rule", key, at, "v.actual")
