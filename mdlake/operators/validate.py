"""Data-quality jobs. Each returns its violations: rule, key, expected, actual; all rules run and none stops the others."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mdlake.functions.scalars import finite, sample_center
from mdlake.operators.presets import Checks
from mdlake.operators.sealing import exists, open_parts

VIOLATION = "rule string, key string, expected string, actual string"


def _out(df: DataFrame, rule: str | Column, key: Column, expected: Column, actual: Column) -> DataFrame:
    rule = F.lit(rule) if isinstance(rule, str) else rule
    return df.select(rule.alias("rule"), key.cast("string").alias("key"), expected.cast("string").alias("expected"), actual.cast("string").alias("actual"))


def all_violations(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def file_order(df: DataFrame) -> DataFrame:
    """A scan with its rows' places: __path and __row."""
    return df.select("*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__row"))


#: Rows of a file that one window of check_ascending spans.
BLOCK_ROWS = 1 << 18


def check_ascending(df: DataFrame, key: str | None = None, ts: str = "ts_init_ns") -> DataFrame:
    """Rows before whose time a later one stands, in file order; equal times are allowed.

    df comes from file_order(). Windows span a block of a file's rows, and the ends of blocks are compared in a second, small step.
    """
    keys = [key] if key else []
    rows = df.select(*keys, ts, "__path", "__row", F.call_function("div", F.col("__row"), F.lit(BLOCK_ROWS)).alias("__block"))
    before = F.lag(ts).over(Window.partitionBy(*keys, "__path", "__block").orderBy("__row"))
    inside = rows.withColumn("__before", before).filter(F.col(ts) < F.col("__before"))
    ends = rows.groupBy(*keys, "__path", "__block").agg(F.min_by(ts, "__row").alias("first"), F.max_by(ts, "__row").alias("last"))
    across = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("__path", "__block")
    steps = ends.withColumns({"__before": F.lag("last").over(across), "__file": F.lag("__path").over(across)}).filter(F.col("first") < F.col("__before"))
    name = F.col(key) if key else F.lit("all")
    rule = F.when(F.col("__path") == F.col("__file"), "ascending").otherwise("ascending_files")
    return _out(inside, "ascending", name, F.col("__before"), F.col(ts)).union(_out(steps, rule, name, F.col("__before"), F.col("first")))


def id_matches(df: DataFrame, partition: str = "partition_id", column: str = "instrument_id") -> DataFrame:
    """Rows whose own id isn't that of their partition, by partition."""
    wrong = df.filter(~F.col(column).eqNullSafe(F.col(partition))).groupBy(partition).agg(F.count(F.lit(1)).alias("n"))
    return _out(wrong, "id", F.col(partition), F.lit(0), F.col("n"))


def readback_counts(families: dict[str, DataFrame]) -> DataFrame:
    """(instrument_id, one count for each family) over all ids seen."""
    counts = reduce(DataFrame.union, [df.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("n")).select("instrument_id", F.lit(name).alias("family"), "n") for name, df in families.items()])
    return counts.groupBy("instrument_id").pivot("family", list(families)).agg(F.sum("n")).na.fill(0)


def family_counts(rows: DataFrame, family: str) -> DataFrame:
    return rows.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(family).alias("family"), "instrument_id", "rows")


def min_rows(expected: DataFrame, counts: DataFrame) -> DataFrame:
    """Expected keys (family, instrument_id, least) with fewer rows than that. counts: family, instrument_id, rows."""
    found = expected.join(counts, ["family", "instrument_id"], "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    return _out(found.filter("rows < least"), F.concat(F.lit("min_rows:"), "family"), F.col("instrument_id"), F.col("least"), F.col("rows"))


def greeks_ok(greeks: DataFrame, columns: tuple[str, ...] = ("delta", "gamma", "vega", "theta")) -> DataFrame:
    """Instruments whose latest greeks lack a volatility or a finite sensitivity."""
    latest = greeks.groupBy("instrument_id").agg(F.max_by(F.struct("mark_iv", *columns), F.struct("ts_event_ns", "ts_init_ns", "seq")).alias("g")).select("instrument_id", "g.*")
    rules = F.array(F.when(F.col("mark_iv").isNull(), F.struct(F.lit("greeks:mark_iv").alias("rule"), F.lit(None).cast("double").alias("value"))), *[F.when(~finite(c), F.struct(F.lit(f"greeks:{c}").alias("rule"), F.col(c).alias("value"))) for c in columns])
    bad = latest.select("instrument_id", F.explode(F.array_compact(rules)).alias("v"))
    return _out(bad, F.col("v.rule"), F.col("instrument_id"), F.lit("finite"), F.col("v.value"))


def contract_state(states: DataFrame, members: DataFrame, family: str, required: bool = True) -> DataFrame:
    """State rows of the members (instrument_id): some row for each if required, and what is there in order.

    Rows with file places (file_order) are held to ascending times; rows with a partition_id to that id.
    """
    own = states.join(members.select("instrument_id").distinct(), "instrument_id", "left_semi")
    parts = []
    if required:
        missing = members.select("instrument_id").distinct().join(states.select("instrument_id").distinct(), "instrument_id", "left_anti")
        parts.append(_out(missing, f"state:{family}", F.col("instrument_id"), F.lit(1), F.lit(0)))
    parts += _placed(own, states, family)
    return all_violations(parts) if parts else _out(members.limit(0), "", F.col("instrument_id"), F.lit(1), F.lit(0))


def _placed(rows: DataFrame, whole: DataFrame, family: str) -> list[DataFrame]:
    """Order and id checks of a family, as far as its rows carry their places."""
    parts = []
    if "__path" in whole.columns:
        parts.append(check_ascending(rows, "instrument_id").withColumn("rule", F.concat(F.col("rule"), F.lit(f":{family}"))))
    if "partition_id" in whole.columns:
        parts.append(id_matches(whole).withColumn("rule", F.concat(F.col("rule"), F.lit(f":{family}"))))
    return parts


def any_option_has(universes: DataFrame, rows: DataFrame, least: int, family: str, key: str = "universe_id") -> DataFrame:
    """Universes (key, instrument_id) of which no option reaches the least number of rows."""
    counts = rows.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("n"))
    best = universes.join(counts, "instrument_id", "left").groupBy(key).agg(F.max(F.coalesce("n", F.lit(0))).alias("n"))
    return _out(best.filter(F.col("n") < least), f"any:{family}", F.col(key), F.lit(least), F.col("n"))


def with_quotes(universes: DataFrame, quotes: DataFrame, key: str = "universe_id") -> DataFrame:
    """(key, instrument_id): the ids that have quotes, or all of a universe's where none has."""
    seen = quotes.select("instrument_id", F.lit(True).alias("__q")).distinct()
    marked = universes.join(seen, "instrument_id", "left")
    some = marked.groupBy(key).agg(F.max(F.coalesce("__q", F.lit(False))).alias("__any"))
    return marked.join(some, key).filter("__q OR NOT __any").select(key, "instrument_id")


def sampled_options(universes: DataFrame, limit: int = 6, key: str = "universe_id") -> DataFrame:
    """(key, sample): ids around the middle strike. universes: key, instrument_id, strike."""
    listed = universes.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("strike", "instrument_id"))), lambda x: x["instrument_id"]).alias("ids"))
    return listed.select(key, sample_center("ids", limit).alias("sample"))


def validate_readback(universes: DataFrame, families: dict[str, DataFrame], checks: Checks) -> DataFrame:
    """Read families back for the members of universes (universe_id, instrument_id, role: perp or option).

    Definitions and bars are always checked. Then either quotes, prices, trades, greeks, funding and contract state of
    perps and options, or, where option families are skipped, the book deltas alone. A family that is not given has no
    rows. Order and ids are checked for rows that carry their file places and partition ids.
    """
    members = universes.select("instrument_id", "role").distinct()
    nothing = members.limit(0).select("instrument_id")
    rows_of = lambda name: families.get(name, nothing)
    in_use: set[str] = set()

    def least(name: str, role: str | None, rows: int) -> DataFrame:
        in_use.add(name)
        ids = members if role is None else members.filter(F.col("role") == role)
        return min_rows(ids.select(F.lit(name).alias("family"), "instrument_id", F.lit(rows).alias("least")), family_counts(rows_of(name), name))

    def any_option(name: str, rows: int) -> DataFrame:
        in_use.add(name)
        return any_option_has(universes.filter("role = 'option'"), rows_of(name), rows, name)

    parts = [least("instruments", None, 1)]
    if checks.skip_options:
        if checks.min_option_deltas > 0:
            parts.append(any_option("order_book_deltas", checks.min_option_deltas))
    else:
        parts += [least(name, role, checks.min_rows) for role, names in (("perp", ("quotes", "mark_prices", "index_prices")), ("option", ("quotes", "mark_prices", "option_greeks"))) for name in names]
        parts.append(least("funding_rate_update", "perp", 1))
        if checks.min_perp_trades > 0:
            parts.append(least("trades", "perp", checks.min_perp_trades))
        if checks.min_option_trades > 0:
            parts.append(any_option("trades", checks.min_option_trades))
        if "option_greeks" in families:
            parts.append(greeks_ok(rows_of("option_greeks").join(members.filter("role = 'option'"), "instrument_id", "left_semi")))
        for family in ("instrument_status", "instrument_closes"):
            if checks.contract_state or family in families:
                parts.append(contract_state(rows_of(family), members, family, checks.contract_state))
    for name in sorted(in_use & set(families)):
        parts += _placed(rows_of(name).join(members, "instrument_id", "left_semi"), rows_of(name), name)
    if checks.bar_types:
        bars = families.get("bars", nothing.select(F.col("instrument_id").alias("bar_type"))).groupBy("bar_type").agg(F.count(F.lit(1)).alias("n"))
        wanted = members.sparkSession.createDataFrame([(t,) for t in checks.bar_types], "bar_type string").join(bars, "bar_type", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        parts.append(_out(wanted.filter(F.col("n") < checks.min_rows), "bars", F.col("bar_type"), F.lit(checks.min_rows), F.col("n")))
    return all_violations(parts)


_EXPECTED = "checks string, family string, role string, scope string, least int"


def expectations(spark: SparkSession, named: dict[str, Checks]) -> DataFrame:
    """Checks as a table: checks, family, role, scope, least.

    scope says whose rows count: `each` member of the role, the `best` option of a universe, `some` rows of a
    universe's options in a log, a bar `type`, or `records` of a universe's lineage.
    """
    rows = []
    for name, c in named.items():
        own = [("instruments", "any", "each", 1)]
        if c.skip_options:
            own.append(("order_book_deltas", "option", "best", c.min_option_deltas))
        else:
            own += [(f, "perp", "each", c.min_rows) for f in ("quotes", "mark_prices", "index_prices")] + [(f, "option", "each", c.min_rows) for f in ("quotes", "mark_prices", "option_greeks")]
            own += [("funding_rate_update", "perp", "each", 1), ("trades", "perp", "each", c.min_perp_trades), ("trades", "option", "best", c.min_option_trades)]
            own += [(f, "any", "each", int(c.contract_state)) for f in ("instrument_status", "instrument_closes")]
        own += [("forward_prices", "option", "some", int(c.forward_prices)), ("refresh", "any", "records", int(c.refresh_change))]
        own += [(t, "any", "type", c.min_rows) for t in c.bar_types]
        rows += [(name, *r) for r in own if r[-1] > 0]
    return spark.createDataFrame(rows, _EXPECTED)


def validate_manifest(universes: DataFrame, counts: DataFrame, bars: DataFrame, log: DataFrame, records: DataFrame, expected: DataFrame) -> DataFrame:
    """(checks, rule, key, expected, actual): what a catalog lacks of its expectations, from counts alone.

    universes: universe_id, instrument_id, role; counts: family, instrument_id, rows (from footers); bars: bar_type, rows;
    log: instrument_id of logged forward prices; records: universe_id, event_kind of the lineage.
    """
    members = universes.select("universe_id", "instrument_id", "role").distinct()
    of = lambda scope: expected.filter(F.col("scope") == scope)
    by_role = lambda scope: members.join(of(scope).withColumnRenamed("role", "asked"), (F.col("asked") == "any") | (F.col("asked") == F.col("role")))
    options = members.filter("role = 'option'")
    every = members.select("universe_id").distinct()
    n = F.coalesce("rows", F.lit(0)).cast("long")

    def short(rows: DataFrame, rule: Column, key: str) -> DataFrame:
        found = rows.filter(F.coalesce("rows", F.lit(0)) < F.col("least"))
        return found.select("checks", rule.alias("rule"), F.col(key).alias("key"), F.col("least").cast("string").alias("expected"), n.cast("string").alias("actual"))

    each = by_role("each").select("checks", "family", "instrument_id", "least").distinct().join(counts, ["family", "instrument_id"], "left")
    best = by_role("best").join(counts, ["family", "instrument_id"], "left").groupBy("checks", "family", "universe_id", "least").agg(F.max(n).alias("rows"))
    logged = options.join(log.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("n")), "instrument_id", "left").groupBy("universe_id").agg(F.sum("n").alias("rows"))
    some = logged.join(of("some"))
    refreshed = every.join(records.filter("event_kind = 'refresh'").groupBy("universe_id").agg(F.count(F.lit(1)).alias("rows")), "universe_id", "left").join(of("records"))
    typed = of("type").join(bars, F.col("family") == F.col("bar_type"), "left")
    return all_violations([
        short(each, F.concat(F.lit("min_rows:"), "family"), "instrument_id"), short(best, F.concat(F.lit("any:"), "family"), "universe_id"),
        short(some, F.lit("forward_prices"), "universe_id"), short(refreshed, F.lit("refresh_change"), "universe_id"), short(typed, F.lit("bars"), "family"),
    ])


def inspect(manifest: DataFrame) -> DataFrame:
    """What a catalog holds, in the columns of a report: instruments, rows and time range of each family."""
    found = manifest.groupBy("family").agg(F.countDistinct("instrument_id").alias("ids"), F.sum("rows").alias("rows"), F.min("min_ts_ns").alias("low"), F.max("max_ts_ns").alias("high"))
    lines = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(c).cast("string").alias("actual")) for name, c in (("instruments", "ids"), ("rows", "rows"), ("first_ns", "low"), ("last_ns", "high"))])
    return _out(found.select("family", F.explode(lines).alias("l")), F.col("l.rule"), F.col("family"), F.lit(None).cast("string"), F.col("l.actual"))


def suite(**sections: DataFrame) -> DataFrame:
    """(section, rule, key, expected, actual): all reports of a validation, such as inspect, lineage, readback and catalog."""
    return all_violations([report.select(F.lit(name).alias("section"), "rule", "key", "expected", "actual") for name, report in sections.items()])


def no_open_parts(spark: SparkSession, root: str, least_sealed: int = 0) -> DataFrame:
    """Open parts that are left under a folder, those of no bytes too, and fewer sealed files with bytes than `least_sealed`."""
    parts = spark.createDataFrame(open_parts(spark, root), "path string, length long")
    found = _out(parts, "open_part", F.col("path"), F.lit(0), F.col("length"))
    if not least_sealed:
        return found
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(root) if exists(spark, root) else spark.createDataFrame([], "path string")
    sealed = names.select("path").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < least_sealed)
    return found.union(_out(sealed, "sealed_files", F.lit(root), F.lit(least_sealed), F.col("n")))


def validate_outcome_capture(records: DataFrame, discovered: DataFrame, rows: DataFrame, least: int = 1) -> DataFrame:
    """Outcome captures: one startup record, the discovered question, two outcome ids or more, and rows of each instrument.

    records: universe_id, question_id, all_instrument_ids; discovered: universe_id, question_id; rows: instrument_id.
    """
    starts = records.groupBy("universe_id").agg(F.count(F.lit(1)).alias("n"), F.max("question_id").alias("question_id"), F.max(F.size("all_instrument_ids")).alias("ids"))
    joined = discovered.withColumnRenamed("question_id", "found").join(starts, "universe_id", "left")
    counts = rows.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("n"))
    thin = records.select(F.explode("all_instrument_ids").alias("instrument_id")).distinct().join(counts, "instrument_id", "left").withColumn("n", F.coalesce("n", F.lit(0))).filter(F.col("n") < least)
    return all_violations([
        _out(joined.filter(F.coalesce("n", F.lit(0)) != 1), "one_startup", F.col("universe_id"), F.lit(1), F.coalesce("n", F.lit(0))),
        _out(joined.filter(~F.col("question_id").eqNullSafe(F.col("found"))), "question", F.col("universe_id"), F.col("found"), F.col("question_id")),
        _out(joined.filter(F.coalesce("ids", F.lit(0)) < 2), "outcome_ids", F.col("universe_id"), F.lit(2), F.col("ids")),
        _out(thin, "outcome_rows", F.col("instrument_id"), F.lit(least), F.col("n")),
    ])


def forward_log_not_empty(log: DataFrame, universes: DataFrame) -> DataFrame:
    """Universes (universe_id, instrument_id) for whose options no forward price was logged."""
    seen = universes.join(log.select("instrument_id").distinct(), "instrument_id", "left_semi").select("universe_id").distinct()
    missing = universes.select("universe_id").distinct().join(seen, "universe_id", "left_anti")
    return _out(missing, "forward_prices", F.col("universe_id"), F.lit(1), F.lit(0))


def validate_catalog(lineage: DataFrame, readback: DataFrame, counts: DataFrame) -> DataFrame:
    """One report of the lineage, readback and count checks. lineage: the result of validate_lineage."""
    from_lineage = _out(lineage, F.concat(F.lit("lineage:"), "rule"), F.concat_ws(":", "venue_id", "underlying"), F.lit(None).cast("string"), F.col("actual"))
    return all_violations([from_lineage, readback, counts])


def validate_counts(universes: DataFrame, counts: DataFrame, least: dict[str, int], sample: int | None = None, key: str = "universe_id") -> DataFrame:
    """Least rows of each family, for all members or for a universe's `sample` around its middle strike.

    universes: key, instrument_id, strike; counts: family, instrument_id, rows (from partition values or a manifest).
    """
    ids = universes.select("instrument_id")
    if sample:
        ids = sampled_options(universes, sample, key).select(F.explode("sample").alias("instrument_id"))
    wanted = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(n).alias("least")) for f, n in least.items()])
    expected = ids.distinct().select("instrument_id", F.inline(wanted))
    return min_rows(expected.select("family", "instrument_id", "least"), counts)
