"""Queries over outcome markets, capture plans and resolution history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdlake.functions import scalars as S
from mdlake.operators import lineage, outcomes, planning, universe
from mdlake.plans.registry import query
from mdlake.plans.universe_queries import RESOLVED, option_requests
from mdlake.session import parked, scratch
from mdlake.sources import derived as D


def listing_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON document for each order; a month's documents are a snapshot taken on the 15th."""
    rows = D.listings(spark, sf)
    question = F.struct(F.col("question"), F.lit("q").alias("name"), F.col("description"), F.col("named_outcomes").alias("namedOutcomes"), F.col("fallback_outcome").alias("fallbackOutcome"))
    month = F.trunc(F.timestamp_micros(S.whole("listed_ns", 1000)).cast("date"), "month")
    now = F.unix_micros(F.date_add(month, 14).cast("timestamp")) * 1000
    return rows.select(F.date_format(month, "yyyy-MM").alias("snapshot_id"), now.alias("now_ns"), F.to_json(F.struct(F.array(question).alias("questions"), F.array().cast("array<struct<outcome:bigint,name:string,description:string>>").alias("outcomes"))).alias("payload"))


def outcome_specs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f"{u}-daily", "PRICEBINARY", u.lower(), "1d", True) for u in D.UNDERLYINGS], "universe_id string, market_class string, spec_underlying string, spec_period string, include_perp boolean")


MARKETS = """
docs AS (SELECT strftime(make_timestamp((listed_ns // 1000)::BIGINT), '%Y-%m') AS snapshot_id, epoch_us(date_trunc('month', make_timestamp((listed_ns // 1000)::BIGINT)) + INTERVAL 14 DAY) * 1000 AS now_ns, question, named_outcomes[1] AS outcome_id, description,
  regexp_extract(description, 'underlying:([A-Z]+)', 1) AS und, trim(regexp_extract(description, 'period *: *([^|]*)', 1)) AS period, epoch_us(strptime(regexp_extract(description, 'expiry:([0-9]+-[0-9]+)', 1), '%Y%m%d-%H%M')) * 1000 AS expiry, regexp_extract(description, 'targetPrice:([0-9]+)', 1)::DOUBLE AS start_price FROM listings_v),
daily AS (SELECT * FROM docs WHERE period IN ('1d', 'daily', '24h')),
chosen AS (SELECT *, row_number() OVER (PARTITION BY snapshot_id, und ORDER BY expiry < now_ns, CASE WHEN expiry >= now_ns THEN expiry ELSE -expiry END, CASE WHEN expiry >= now_ns THEN question ELSE -question END) AS n FROM daily),
market AS (SELECT snapshot_id, und || '-daily' AS universe_id, und, now_ns, question AS question_id, expiry AS expiration_ns, start_price, outcome_id, und || '-USD-PERP.HYPERLIQUID,' || outcome_id || '-YES-OUTCOME.HYPERLIQUID,' || outcome_id || '-NO-OUTCOME.HYPERLIQUID' AS ids FROM chosen WHERE n = 1)
"""


@query("resolve_outcome_markets", f"WITH {MARKETS} SELECT snapshot_id, universe_id, question_id, expiration_ns, start_price, ids FROM market")
def resolve_outcome_markets(spark: SparkSession, sf: str) -> DataFrame:
    found = outcomes.resolve_outcome_markets(listing_documents(spark, sf), outcome_specs(spark))
    return found.select("snapshot_id", "universe_id", "question_id", "expiration_ns", F.col("start_price").cast("double").alias("start_price"), F.array_join("all_instrument_ids", ",").alias("ids"))


@query(
    "refresh_outcome_universes",
    f"""WITH {MARKETS}, p AS (SELECT *, lag(ids) OVER w AS before, lag(question_id) OVER w AS q, lag(expiration_ns) OVER w AS e FROM market WINDOW w AS (PARTITION BY universe_id ORDER BY now_ns))
    SELECT universe_id, now_ns, CASE WHEN q <> question_id THEN 'question_roll' WHEN e <> expiration_ns THEN 'expiry_roll' END AS rollover_reason, len(list_filter(string_split(ids, ','), lambda x: NOT list_contains(string_split(before, ','), x))) AS added, len(list_filter(string_split(before, ','), lambda x: NOT list_contains(string_split(ids, ','), x))) AS removed FROM p WHERE before <> ids""",
)
def refresh_outcome_universes(spark: SparkSession, sf: str) -> DataFrame:
    found = outcomes.refresh_outcome_universes(outcomes.resolve_outcome_markets(listing_documents(spark, sf), outcome_specs(spark)))
    return found.select("universe_id", "now_ns", "rollover_reason", F.size("added_instrument_ids").cast("long").alias("added"), F.size("removed_instrument_ids").cast("long").alias("removed"))


@query(
    "outcome_log",
    f"""WITH {MARKETS}, p AS (SELECT *, lag(ids) OVER w AS before, lag(question_id) OVER w AS q, lag(expiration_ns) OVER w AS e, row_number() OVER w AS i FROM market WINDOW w AS (PARTITION BY universe_id ORDER BY now_ns))
    SELECT CASE WHEN i = 1 THEN 'startup' ELSE 'refresh' END AS event_kind, universe_id AS venue_id, lower(und) AS underlying, '1d' AS period, 'PRICEBINARY' AS market_class, now_ns AS resolved_at_ns, strftime(make_timestamp((now_ns // 1000)::BIGINT), '%Y-%m-%d') AS day, question_id, expiration_ns, ids,
      outcome_id::VARCHAR AS outcomes, CASE WHEN i = 1 THEN NULL WHEN q <> question_id THEN 'question_roll' WHEN e <> expiration_ns THEN 'expiry_roll' END AS rollover_reason FROM p WHERE i = 1 OR before <> ids""",
)
def outcome_log(spark: SparkSession, sf: str) -> DataFrame:
    """The outcome log written as JSON lines and read back."""
    path = scratch(spark, "outcome-log")
    specs = outcome_specs(spark)
    found = parked(outcomes.resolve_outcome_markets(listing_documents(spark, sf), specs), "outcomes")
    lineage.append_resolutions(lineage.outcome_records(found, outcomes.refresh_outcome_universes(found), specs), path)
    back = lineage.read_outcome_resolutions(spark, path)
    texts = [F.array_join("all_instrument_ids", ",").alias("ids"), F.array_join(F.col("outcome_ids").cast("array<string>"), ",").alias("outcomes")]
    return back.select("event_kind", "venue_id", "underlying", "period", "market_class", "resolved_at_ns", F.substring("resolved_at_iso8601", 1, 10).alias("day"), "question_id", "expiration_ns", *texts, "rollover_reason")


@query("parse_description", "SELECT question, CASE WHEN description LIKE '%period%' THEN 5 ELSE 4 END::BIGINT AS fields, trim(regexp_extract(description, 'period *: *([^|]*)', 1)) AS period, regexp_extract(description, 'targetPrice:([0-9]+)', 1)::DOUBLE AS target, epoch_us(strptime(regexp_extract(description, 'expiry:([0-9]+-[0-9]+)', 1), '%Y%m%d-%H%M')) * 1000 AS expiry_ns FROM listings_v")
def parse_description(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.listings(spark, sf).withColumn("f", S.parse_description("description"))
    return rows.select("question", F.size("f").cast("long").alias("fields"), F.coalesce(F.col("f")["period"], F.lit("")).alias("period"), S.start_price("f").cast("double").alias("target"), S.expiry_ns(F.col("f")["expiry"]).alias("expiry_ns"))


@query("parse_option_id", "SELECT instrument_id, 'DERIBIT' AS venue, string_split(instrument_id, '-')[2] AS expiry, string_split(instrument_id, '-')[3]::DOUBLE AS strike, kind FROM options_v")
def parse_option_id(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.options(spark, sf).withColumn("p", S.parse_option_id("instrument_id"))
    return rows.select("instrument_id", S.venue_of("instrument_id").alias("venue"), "p.expiry", "p.strike", "p.kind")


@query("next_seal", "SELECT event_id, epoch_us(date_trunc('day', ts - INTERVAL 6 HOUR) + INTERVAL 30 HOUR) * 1000 AS seal_ns, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad((epoch_us(ts) % 1000000)::VARCHAR, 6, '0') || '000Z' AS at FROM events")
def next_seal(spark: SparkSession, sf: str) -> DataFrame:
    events = D.table(spark, sf, "events").select("event_id", D.nanos(F.col("ts")).alias("ns"))
    return events.select("event_id", S.next_seal_ns("ns").alias("seal_ns"), S.iso8601("ns").alias("at"))


def resolved(spark: SparkSession, sf: str) -> DataFrame:
    return universe.resolve_option_universes(option_requests(spark, sf), D.options(spark, sf))


_IDS = "string_split(ids || ',' || underlying || '-PERPETUAL.DERIBIT', ',')"


@query(
    "resolution_delta",
    f"""WITH {RESOLVED}, r AS (SELECT *, lag(ids) OVER w AS before, lag(expiry) OVER w AS e, lag(ref) OVER w AS a FROM resolved WHERE error IS NULL WINDOW w AS (PARTITION BY universe_id ORDER BY resolved_at_ns))
    SELECT universe_id, resolved_at_ns, CASE WHEN before IS NULL OR before = ids THEN NULL WHEN e <> expiry THEN 'expiry_roll' WHEN a <> ref THEN 'atm_drift' WHEN mode = 'oi_ranked' THEN 'oi_rank_shift' ELSE 'strike_window_shift' END AS rollover_reason,
    CASE WHEN before IS NOT NULL THEN len(list_filter(string_split(ids, ','), lambda x: NOT list_contains(string_split(before, ','), x))) END AS added, CASE WHEN before IS NOT NULL THEN len(list_filter(string_split(before, ','), lambda x: NOT list_contains(string_split(ids, ','), x))) END AS removed FROM r""",
)
def resolution_delta(spark: SparkSession, sf: str) -> DataFrame:
    found = lineage.rollover_reason(resolved(spark, sf).filter("error IS NULL"))
    size = lambda c: F.when(F.col(c).isNotNull(), F.size(c).cast("long"))
    return found.select("universe_id", "resolved_at_ns", "rollover_reason", size("added_instrument_ids").alias("added"), size("removed_instrument_ids").alias("removed"))


SMOOTHED = """
ticks AS (SELECT *, row_number() OVER (PARTITION BY universe_id ORDER BY resolved_at_ns) AS n FROM {source}),
st AS (SELECT universe_id, n, resolved_at_ns, mode, expiry, ref, ids, strikes, true AS applied, NULL::VARCHAR AS pending, 0 AS seen, NULL::VARCHAR AS reason FROM ticks WHERE n = 1
  UNION ALL SELECT universe_id, n, resolved_at_ns, mode, CASE WHEN ok THEN t_expiry ELSE expiry END, CASE WHEN ok THEN t_ref ELSE ref END, CASE WHEN ok THEN t_ids ELSE ids END, CASE WHEN ok THEN t_strikes ELSE strikes END, ok, CASE WHEN ok THEN NULL ELSE t_strikes END, CASE WHEN ok THEN 0 ELSE again END,
    CASE WHEN NOT ok OR t_ids = ids THEN NULL WHEN t_expiry <> expiry THEN 'expiry_roll' WHEN t_ref <> ref THEN 'atm_drift' WHEN mode = 'oi_ranked' THEN 'oi_rank_shift' ELSE 'strike_window_shift' END
    FROM (SELECT *, mode <> 'oi_ranked' OR t_expiry <> expiry OR t_strikes = strikes OR again >= 2 AS ok
      FROM (SELECT t.universe_id, t.n, t.resolved_at_ns, t.mode, t.expiry AS t_expiry, t.ref AS t_ref, t.ids AS t_ids, t.strikes AS t_strikes, s.expiry, s.ref, s.ids, s.strikes, CASE WHEN s.pending = t.strikes THEN s.seen + 1 ELSE 1 END AS again FROM st s JOIN ticks t ON t.universe_id = s.universe_id AND t.n = s.n + 1)))
"""


def daily_oi(spark: SparkSession, sf: str) -> DataFrame:
    """Each underlying's three strikes of most trade size on each day: a ranking that moves from day to day."""
    day = S.whole("ts_event_ns", D.DAY_NS).alias("day")
    sizes = D.trades(spark, sf).join(D.options(spark, sf).select("instrument_id", "underlying", "strike"), "instrument_id").groupBy("underlying", day, "strike").agg(F.sum("size").alias("open_interest"))
    ranked = sizes.groupBy("underlying", "day").agg(F.collect_list(F.struct("strike", "open_interest")).alias("pairs"))
    strikes = universe.top_oi(F.col("pairs"), F.lit(1))
    ids = F.transform(strikes, lambda s: F.concat("underlying", F.lit("-"), s.cast("long").cast("string")))
    week = F.floor(F.col("day") / 21)
    return ranked.select("underlying", F.col("underlying").alias("universe_id"), (F.col("day") * F.lit(D.DAY_NS)).alias("resolved_at_ns"), week.alias("selected_expiry_ns"), F.lit(0.0).alias("atm_reference"), F.lit("oi_ranked").alias("strike_mode"), strikes.alias("selected_strikes"), ids.alias("all_instrument_ids"), F.lit(None).cast("string").alias("error"))


_DAILY = """
sizes AS (SELECT underlying, ts_event_ns // 86400000000000 AS day, strike, sum(size) AS oi FROM trades_v JOIN options_v USING (instrument_id) GROUP BY 1, 2, 3),
top AS (SELECT underlying AS universe_id, day * 86400000000000 AS resolved_at_ns, 'oi_ranked' AS mode, day // 21 AS expiry, 0.0 AS ref, arg_min(strike, (-oi, strike))::BIGINT::VARCHAR AS strikes FROM sizes GROUP BY underlying, day),
src AS (SELECT *, universe_id || '-' || strikes AS ids FROM top)
"""


@query("smooth_strikes", f"WITH RECURSIVE {_DAILY}, {SMOOTHED.format(source='src')} SELECT universe_id, resolved_at_ns, applied, strikes AS applied_strikes FROM st")
def smooth_strikes(spark: SparkSession, sf: str) -> DataFrame:
    found = lineage.smooth_strikes(daily_oi(spark, sf), 2)
    return found.select("universe_id", "resolved_at_ns", "applied", F.array_join(F.transform("applied_strikes", lambda s: s.cast("long").cast("string")), ",").alias("applied_strikes"))


@query("refresh_option_universes", f"WITH RECURSIVE {_DAILY}, {SMOOTHED.format(source='src')} SELECT universe_id, resolved_at_ns, reason AS rollover_reason, ids FROM st WHERE reason IS NOT NULL")
def refresh_option_universes(spark: SparkSession, sf: str) -> DataFrame:
    found = lineage.refresh_option_universes(daily_oi(spark, sf), 2)
    return found.select("universe_id", "resolved_at_ns", "rollover_reason", F.array_join("all_instrument_ids", ",").alias("ids"))


@query(
    "summarize_resolutions",
    f"""WITH RECURSIVE {RESOLVED}, good AS (SELECT * FROM resolved WHERE error IS NULL), {SMOOTHED.format(source='good')}
    SELECT universe_id AS venue_id, count(*) AS records, count(*) - 1 AS refreshes, min(resolved_at_ns) AS first_ns, max(resolved_at_ns) AS latest_ns, arg_max(reason, resolved_at_ns) AS latest_reason FROM st WHERE n = 1 OR reason IS NOT NULL GROUP BY 1""",
)
def summarize_resolutions(spark: SparkSession, sf: str) -> DataFrame:
    found = lineage.summarize_resolutions(lineage.resolution_records(resolved(spark, sf)))
    return found.select("venue_id", "records", "refreshes", "first_ns", "latest_ns", "latest_reason")


@query(
    "validate_lineage",
    f"""WITH RECURSIVE {RESOLVED}, good AS (SELECT * FROM resolved WHERE error IS NULL), {SMOOTHED.format(source='good')}, startup AS (SELECT * FROM st WHERE n = 1)
    SELECT 'profile_mode' AS rule, universe_id AS venue_id, mode AS actual FROM startup WHERE mode <> 'all' UNION ALL SELECT 'profile_top_n', universe_id, '3' FROM startup WHERE mode = 'oi_ranked'
    UNION ALL SELECT 'profile_strikes', universe_id, len(string_split(strikes, ','))::VARCHAR FROM startup WHERE len(string_split(strikes, ',')) < 5""",
)
def validate_lineage(spark: SparkSession, sf: str) -> DataFrame:
    return lineage.validate_lineage(lineage.resolution_records(resolved(spark, sf)), require_refresh=True, profile="all").select("rule", "venue_id", "actual")


@query(
    "validate_outcome_lineage",
    f"""WITH {MARKETS}, p AS (SELECT *, lag(ids) OVER w AS before, lag(question_id) OVER w AS q, lag(expiration_ns) OVER w AS e FROM market WINDOW w AS (PARTITION BY universe_id ORDER BY now_ns)),
    r AS (SELECT universe_id, now_ns // 86400000000000 % 4 AS k FROM p WHERE before <> ids)
    SELECT 'event_kind' AS rule, universe_id, 'startup' AS actual FROM r WHERE k = 1 UNION ALL SELECT 'refresh_reason', universe_id, 'mistake' FROM r WHERE k = 2 UNION ALL SELECT 'refresh_change', universe_id, 'none' FROM r WHERE k = 3""",
)
def validate_outcome_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """Refresh records, three in four with a wrong kind, a reason that nobody knows, or no change."""
    k = S.whole(F.col("now_ns"), D.DAY_NS) % 4
    spoiled = lambda c, n, value: F.when(k == n, value).otherwise(F.col(c)).alias(c)
    found = outcomes.refresh_outcome_universes(outcomes.resolve_outcome_markets(listing_documents(spark, sf), outcome_specs(spark)))
    nothing = F.array().cast("array<string>")
    broken = found.select("universe_id", "now_ns", spoiled("event_kind", 1, F.lit("startup")), spoiled("rollover_reason", 2, F.lit("mistake")), spoiled("added_instrument_ids", 3, nothing), spoiled("removed_instrument_ids", 3, nothing))
    return lineage.validate_outcome_lineage(broken).select("rule", "universe_id", "actual")


_MEMBERS = f"every AS (SELECT DISTINCT unnest({_IDS}) AS id FROM resolved WHERE error IS NULL), opts AS (SELECT DISTINCT unnest(string_split(ids, ',')) AS id FROM resolved WHERE error IS NULL), perp AS (SELECT DISTINCT underlying || '-PERPETUAL.DERIBIT' AS id FROM resolved WHERE error IS NULL)"
_PLAN = "plan AS (SELECT f AS family, id AS instrument_id FROM every, (SELECT unnest(['instruments','quotes','trades','mark_prices','instrument_statuses','instrument_closes']) AS f) UNION ALL SELECT f, id FROM perp, (SELECT unnest(['index_prices','funding_rates']) AS f) UNION ALL SELECT f, id FROM opts, (SELECT unnest(['option_greeks','forward_prices','book_deltas']) AS f))"


def option_plan(spark: SparkSession, sf: str) -> DataFrame:
    return planning.expand_universe(resolved(spark, sf).filter("error IS NULL"))


@query("expand_universe", f"WITH {RESOLVED}, {_MEMBERS}, {_PLAN} SELECT *, CASE WHEN family = 'book_deltas' THEN 'L2_MBP' END AS book_type FROM plan")
def expand_universe(spark: SparkSession, sf: str) -> DataFrame:
    return option_plan(spark, sf).select("family", "instrument_id", "book_type")


@query(
    "expand_outcome_universe",
    f"""WITH {MARKETS}, x AS (SELECT DISTINCT und || '-USD-PERP.HYPERLIQUID' AS perp, outcome_id FROM market), o AS (SELECT DISTINCT outcome_id || s AS id FROM x, (SELECT unnest(['-YES-OUTCOME.HYPERLIQUID', '-NO-OUTCOME.HYPERLIQUID']) AS s))
    SELECT 'instruments' AS family, id AS instrument_id FROM o UNION ALL SELECT DISTINCT 'instruments', perp FROM x UNION ALL SELECT f, id FROM o, (SELECT unnest(['quotes', 'trades']) AS f) UNION ALL SELECT DISTINCT 'mark_prices', perp FROM x""",
)
def expand_outcome_universe(spark: SparkSession, sf: str) -> DataFrame:
    return planning.expand_outcome_universe(outcomes.resolve_outcome_markets(listing_documents(spark, sf), outcome_specs(spark))).select("family", "instrument_id")


def event_plan(spark: SparkSession, sf: str) -> DataFrame:
    """The ids seen in quotes and greeks whose strike is a multiple of 20, as a plan."""
    seen = D.quotes(spark, sf).select(F.lit("quotes").alias("family"), "instrument_id").union(D.greeks(spark, sf).select(F.lit("option_greeks"), "instrument_id")).distinct()
    even = D.options(spark, sf).filter("strike % 20 = 0").select("instrument_id")
    null = F.lit(None).cast("string")
    return seen.join(even, "instrument_id", "left_semi").select("family", "instrument_id", null.alias("bar_type"), null.alias("data_type"), null.alias("book_type"), F.lit(None).cast("int").alias("depth"))


_EVENT_PLAN = "ep AS (SELECT DISTINCT family, instrument_id FROM (SELECT 'quotes' AS family, instrument_id FROM quotes_v UNION ALL SELECT 'option_greeks', instrument_id FROM greeks_v) JOIN options_v USING (instrument_id) WHERE strike % 20 = 0)"


@query("plan_delta", f"WITH {RESOLVED}, {_MEMBERS}, {_PLAN}, {_EVENT_PLAN} SELECT 'add' AS change, * FROM (FROM ep EXCEPT FROM plan) UNION ALL SELECT 'remove', * FROM (FROM plan EXCEPT FROM ep)")
def plan_delta(spark: SparkSession, sf: str) -> DataFrame:
    return planning.plan_delta(option_plan(spark, sf), event_plan(spark, sf)).select("change", "family", "instrument_id")


@query("merge_plans", f"WITH {RESOLVED}, {_MEMBERS}, {_PLAN}, {_EVENT_PLAN} FROM plan UNION FROM ep")
def merge_plans(spark: SparkSession, sf: str) -> DataFrame:
    return planning.effective_plan(option_plan(spark, sf), event_plan(spark, sf), None).select("family", "instrument_id")


@query("apply_plan", f"WITH {_EVENT_PLAN} SELECT instrument_id, count(*) AS n FROM quotes_v WHERE instrument_id IN (SELECT instrument_id FROM ep WHERE family = 'quotes') GROUP BY 1")
def apply_plan(spark: SparkSession, sf: str) -> DataFrame:
    kept = planning.apply_plan(D.quotes(spark, sf).withColumn("family", F.lit("quotes")), event_plan(spark, sf))
    return kept.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("n"))


@query("forward_price_targets", f"WITH {RESOLVED}, {_MEMBERS} SELECT instrument_id, seq, underlying_price AS forward_price FROM greeks_v WHERE instrument_id IN (SELECT id FROM opts)")
def forward_price_targets(spark: SparkSession, sf: str) -> DataFrame:
    return planning.forward_price_targets(D.greeks(spark, sf), option_plan(spark, sf)).select("instrument_id", "seq", F.col("underlying_price").alias("forward_price"))


@query("overlap_and_new", f"WITH {RESOLVED}, {_MEMBERS}, {_EVENT_PLAN} SELECT DISTINCT instrument_id, CASE WHEN instrument_id IN (SELECT id FROM every) THEN 'overlap' ELSE 'new' END AS status FROM ep")
def overlap_and_new(spark: SparkSession, sf: str) -> DataFrame:
    return planning.overlap_and_new(option_plan(spark, sf), event_plan(spark, sf))


@query(
    "retired_ids",
    f"""WITH {RESOLVED}, {_EVENT_PLAN}, r AS (SELECT *, lag(ids) OVER (PARTITION BY universe_id ORDER BY resolved_at_ns) AS before FROM resolved WHERE error IS NULL),
    gone AS (SELECT DISTINCT unnest(list_filter(string_split(before, ','), lambda x: NOT list_contains(string_split(ids, ','), x))) AS id FROM r WHERE before IS NOT NULL)
    SELECT id AS instrument_id FROM gone WHERE id NOT IN (SELECT instrument_id FROM ep)""",
)
def retired_ids(spark: SparkSession, sf: str) -> DataFrame:
    return planning.retired_ids(lineage.resolution_delta(resolved(spark, sf).filter("error IS NULL")), event_plan(spark, sf))


@query("universe_members", f"WITH {RESOLVED} SELECT DISTINCT universe_id, unnest({_IDS}) AS instrument_id FROM resolved WHERE error IS NULL")
def universe_members(spark: SparkSession, sf: str) -> DataFrame:
    return planning.members(resolved(spark, sf).filter("error IS NULL"))


@query("plan_summary", f"WITH {RESOLVED}, {_MEMBERS}, {_PLAN} SELECT family, count(*) AS specs, count(DISTINCT instrument_id) AS instruments FROM plan GROUP BY 1")
def plan_summary(spark: SparkSession, sf: str) -> DataFrame:
    return planning.plan_summary(option_plan(spark, sf))


@query("planned_instruments", f"WITH {RESOLVED}, {_MEMBERS} SELECT id AS instrument_id FROM every")
def planned_instruments(spark: SparkSession, sf: str) -> DataFrame:
    return planning.planned_instruments(option_plan(spark, sf))
