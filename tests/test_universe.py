import random
import re

import pytest
from pyspark.sql import functions as F

from mdlake.operators import asof, lineage, metrics, outcomes, planning, universe

E1, E2, NOW = 1782432000000000000, 1783036800000000000, 1781740800000000000
REQUEST = "universe_id string, now_ns long, underlying string, settlement_currency string, include_perp boolean, perp_instrument_id string, days_max int, strike_mode string, above int, below int, top_n int, atm_reference double"


def options(spark, oi=None):
    rows = [(f"BTC-{e}-{k}-{s}.DERIBIT", "option", "BTC", "BTC", float(k), s, e, None if oi is None else oi.get(k)) for e, strikes in ((E1, (64000, 65000, 66000)), (E2, (65000,))) for k in strikes for s in "CP"]
    return spark.createDataFrame(rows, "instrument_id string, class string, underlying string, settlement_currency string, strike double, kind string, expiration_ns long, open_interest double")


def resolve(spark, df=None, **kw):
    row = {"universe_id": "u", "now_ns": NOW, "underlying": "BTC", "settlement_currency": "BTC", "include_perp": True, "perp_instrument_id": "BTC-PERPETUAL.DERIBIT", "days_max": 45, "strike_mode": "atm_relative", "above": 1, "below": 1, "top_n": 2, "atm_reference": 65100.0} | kw
    requests = spark.createDataFrame([tuple(row.values())], REQUEST)
    return universe.resolve_option_universes(requests, options(spark) if df is None else df).first()


def test_atm_window(spark):
    r = resolve(spark)
    assert (r.selected_expiry_ns, r.selected_strikes, len(r.option_instrument_ids)) == (E1, [64000.0, 65000.0, 66000.0], 6)
    assert r.option_instrument_ids[:2] == [f"BTC-{E1}-64000-C.DERIBIT", f"BTC-{E1}-64000-P.DERIBIT"]
    assert "BTC-PERPETUAL.DERIBIT" in r.all_instrument_ids and r.all_instrument_ids == sorted(r.all_instrument_ids)
    assert resolve(spark, atm_reference=64500.0, above=1, below=0).selected_strikes == [64000.0, 65000.0]


def test_open_interest(spark):
    ranked = lambda **oi: resolve(spark, options(spark, {int(k[1:]): v for k, v in oi.items()}), strike_mode="oi_ranked")
    assert ranked(s64000=100.0, s65000=250.0, s66000=200.0).selected_strikes == [65000.0, 66000.0]
    assert ranked(s64000=200.0, s65000=200.0, s66000=100.0).selected_strikes == [64000.0, 65000.0]
    assert ranked(s64000=float("nan"), s65000=0.0, s66000=1.0).selected_strikes == [66000.0]
    assert resolve(spark, strike_mode="oi_ranked").error == "MissingOpenInterest"
    assert len(resolve(spark, strike_mode="all").option_instrument_ids) == 6


def test_errors(spark):
    assert resolve(spark, underlying="ETH").error == "NoMatchingOptions"
    assert resolve(spark, now_ns=E2).error == "NoMatchingOptions"
    assert resolve(spark, days_max=1).error == "NoMatchingExpiry"
    assert resolve(spark, options(spark).filter("kind = 'C'")).error == "NoStrikePairs"
    assert resolve(spark, perp_instrument_id=None).error == "MissingPerpetual"
    assert resolve(spark, perp_instrument_id=None, include_perp=False).error is None
    assert resolve(spark, settlement_currency=None).error is None


def test_reference_instrument(spark):
    requests = spark.createDataFrame([("u", NOW, "BTC", None, 45)], "universe_id string, now_ns long, underlying string, settlement_currency string, days_max int")
    assert universe.reference_instrument(options(spark), requests).first().instrument_id == f"BTC-{E1}-64000-C.DERIBIT"


def test_smoothing():
    sm = lineage.Smoothing(2)
    assert [sm.applies([1], c, False) for c in ([2], [2])] == [False, True]
    sm = lineage.Smoothing(2)
    assert [sm.applies([1], c, False) for c in ([2], [3], [3])] == [False, False, True]
    assert lineage.Smoothing(3).applies([1], [2], True) and lineage.Smoothing(0).applies([1], [2], False)


def history(spark, rows):
    schema = "universe_id string, resolved_at_ns long, underlying string, strike_mode string, top_n int, selected_expiry_ns long, atm_reference double, selected_strikes array<double>, perp_instrument_id string, option_instrument_ids array<string>, all_instrument_ids array<string>, error string"
    return spark.createDataFrame([("u", t, "BTC", mode, 2, e, atm, k, "P", [f"{x}" for x in k], ["P", *[f"{x}" for x in k]], err) for t, mode, e, atm, k, err in rows], schema)


def test_refresh_reasons(spark):
    rows = [(1, "oi_ranked", 1, 5.0, [1.0, 2.0], None), (2, "oi_ranked", 1, 5.0, [2.0, 3.0], None), (3, "oi_ranked", 1, 5.0, [2.0, 3.0], None), (4, "oi_ranked", 1, 5.0, [2.0, 3.0], "NoStrikePairs"), (5, "oi_ranked", 2, 6.0, [9.0, 10.0], None)]
    got = lineage.refresh_option_universes(history(spark, rows), 2).orderBy("resolved_at_ns").collect()
    assert [(r.resolved_at_ns, r.rollover_reason, r.added_instrument_ids, r.removed_instrument_ids) for r in got] == [(3, "oi_rank_shift", ["3.0"], ["1.0"]), (5, "expiry_roll", ["10.0", "9.0"], ["2.0", "3.0"])]
    rows = [(1, "atm_relative", 1, 5.0, [1.0], None), (2, "atm_relative", 1, 6.0, [2.0], None), (3, "atm_relative", 1, 6.0, [3.0], None)]
    assert [r.rollover_reason for r in lineage.refresh_option_universes(history(spark, rows)).orderBy("resolved_at_ns").collect()] == ["atm_drift", "strike_window_shift"]


def test_lineage_rules(spark, tmp_path):
    rows = [(1, "oi_ranked", 1, 5.0, [1.0, 2.0], None), (2, "oi_ranked", 2, 5.0, [3.0, 4.0], None)]
    records = lineage.resolution_records(history(spark, rows))
    path = f"file://{tmp_path}/log"
    lineage.append_resolutions(records, path)
    back = lineage.read_resolutions(spark, path)
    assert back.count() == 2 and back.columns == records.columns
    rules = lambda df, **kw: sorted(r.rule for r in lineage.validate_lineage(df, **kw).collect())
    assert rules(back.withColumn("option_instrument_ids", F.array(*map(F.lit, "abcd"))), require_refresh=True, profile="oi_ranked", top_n=2) == []
    assert rules(back.filter("event_kind = 'startup'"), require_refresh=True) == ["refresh_required"]
    assert rules(back.filter("event_kind = 'refresh'")) == ["one_startup", "refresh_mode"]
    assert rules(back.withColumn("rollover_reason", F.lit("x"))) == ["refresh_reason"]
    assert "profile_mode" in rules(back, profile="all")
    summary = lineage.summarize_resolutions(back).first()
    assert (summary.records, summary.refreshes, summary.latest_reason) == (2, 1, "expiry_roll")


def test_metrics_golden(spark):
    """Perp 62454.0/62454.5 and three strikes: at-the-money 0.3562, risk reversal -0.0781."""
    opts = [("62000-P", "BTC", 1, 62000.0, "P"), ("62500-C", "BTC", 1, 62500.0, "C"), ("62500-P", "BTC", 1, 62500.0, "P"), ("63000-C", "BTC", 1, 63000.0, "C")]
    opts = spark.createDataFrame(opts, "instrument_id string, underlying string, expiration_ns long, strike double, kind string")
    quotes = spark.createDataFrame([("PERP", 62454.0, 62454.5, 1, 1, 1)], "instrument_id string, bid_price double, ask_price double, ts_event_ns long, ts_init_ns long, seq long")
    ivs = {"62000-P": 40.0, "62500-C": 35.62, "62500-P": 35.62, "63000-C": 32.19}
    greeks = spark.createDataFrame([(i, v, 0.5, 1, 1, 1) for i, v in ivs.items()] + [("62000-P", None, 0.4, 2, 2, 2)], "instrument_id string, mark_iv double, delta double, ts_event_ns long, ts_init_ns long, seq long")
    perps = spark.createDataFrame([("BTC", "PERP")], "underlying string, perp_id string")
    r = metrics.option_metrics(opts, quotes, greeks, perps).first()
    assert (round(r.atm_iv, 6), round(r.risk_reversal, 6), r.atm_strike, r.greeks_ready) == (0.3562, -0.0781, 62500.0, 4)


def test_outcomes_golden(spark):
    doc = '{"questions":[{"question":55,"description":"class:priceBinary|underlying:BTC|expiry:20260614-0600|period:1d","namedOutcomes":[326],"fallbackOutcome":325},{"question":56,"description":"class:priceBinary|underlying:BTC|expiry:20260615-0600|period:1d","namedOutcomes":[330],"fallbackOutcome":329},{"question":57},{"name":"no id"}],"outcomes":[{"outcome":9,"description":"class:other"}]}'
    expiry = 1781416800000000000
    listings = spark.createDataFrame([("a", expiry, doc), ("b", expiry + 5_000_000_000, doc), ("c", 2 * expiry, doc), ("d", 0, "{}"), ("e", 0, None)], "snapshot_id string, now_ns long, payload string")
    specs = spark.createDataFrame([("u", "priceBinary", "btc", "daily", True)], "universe_id string, market_class string, spec_underlying string, spec_period string, include_perp boolean")
    got = {r.snapshot_id: r for r in outcomes.resolve_outcome_markets(listings, specs).collect()}
    assert {k: r.question_id for k, r in got.items()} == {"a": 55, "b": 56, "c": 56}
    assert got["a"].all_instrument_ids == ["BTC-USD-PERP.HYPERLIQUID", "326-YES-OUTCOME.HYPERLIQUID", "326-NO-OUTCOME.HYPERLIQUID"]
    changes = outcomes.refresh_outcome_universes(outcomes.resolve_outcome_markets(listings, specs)).collect()
    assert [(r.snapshot_id, r.rollover_reason, len(r.added_instrument_ids), len(r.removed_instrument_ids)) for r in changes] == [("b", "question_roll", 2, 2)]
    assert lineage.validate_outcome_lineage(outcomes.refresh_outcome_universes(outcomes.resolve_outcome_markets(listings, specs))).count() == 0


def test_plans(spark):
    res = spark.createDataFrame([(["o1", "o2"], "p", ["o1", "o2", "p"])], "option_instrument_ids array<string>, perp_instrument_id string, all_instrument_ids array<string>")
    plan = planning.expand_universe(res)
    by = {r.family: r.specs for r in planning.plan_summary(plan).collect()}
    assert (by["trades"], by["option_greeks"], by["forward_prices"], by["index_prices"], by["funding_rates"]) == (3, 2, 2, 1, 1)
    assert planning.expand_universe(res, ["trades"]).count() == 3
    spec = lambda *rows: spark.createDataFrame(rows, planning.PLAN_SCHEMA)
    a = spec(("quotes", "x", None, None, None, None), ("quotes", "x", None, None, None, None), ("book_deltas", "x", None, None, "L2", 5))
    b = spec(("quotes", "x", None, None, None, None), ("book_deltas", "x", None, None, "L2", 10), ("book_deltas", "x", None, None, "L2", 10))
    assert planning.merge_plans(a, b).count() == 4
    assert sorted((r.change, r.depth) for r in planning.plan_delta(a, b).collect()) == [("add", 10), ("add", 10), ("remove", 5)]
    assert {r.family for r in planning.enabled_families(spec(("custom_data_requests", None, None, "T", None, None))).collect()} == {"custom_data"}
    assert {r.family for r in planning.enabled_families(a).collect()} == {"quotes", "book_deltas", "instruments"}
    changes = spark.createDataFrame([(["o1", "p", "z"], "p")], "removed_instrument_ids array<string>, perp_instrument_id string")
    assert [r.instrument_id for r in planning.retired_ids(changes, spec(("quotes", "z", None, None, None, None))).collect()] == ["o1"]


def test_asof_carries_over_days(spark):
    day = 86_400_000_000_000
    events = spark.createDataFrame([("a", 5, 5, 1, 1.0), ("a", 5, 5, 2, 2.0), ("a", 3 * day, 3 * day, 3, None), ("a", 5 * day, 5 * day, 4, 9.0)], "k string, ts_event_ns long, ts_init_ns long, seq long, v double")
    asked = spark.createDataFrame([("a", 4), ("a", 5), ("a", 3 * day + 1), ("a", 4 * day), ("a", 5 * day), ("b", day)], "k string, now_ns long")
    got = {(r.k, r.now_ns): r.v for r in asof.asof_state(asked, events, "k", ["v"]).collect()}
    assert got == {("a", 4): None, ("a", 5): 2.0, ("a", 3 * day + 1): 2.0, ("a", 4 * day): 2.0, ("a", 5 * day): 9.0, ("b", day): None}


def test_throttle_equals_a_plain_loop(spark):
    draw = random.Random(7)
    rows = [(draw.choice(["a", "b", "", None]), draw.choice([None, *range(-400, 400)]), n, f"r{n}") for n in range(1500)]
    # One busy key, most rows at equal times, and one whose rows lie blocks apart.
    rows += [("busy", draw.randrange(300), n, "x") for n in range(5000, 9000)] + [("rare", n * 997, n, "y") for n in range(20)]
    df = spark.createDataFrame(rows, "k string, t long, seq long, note string").repartition(5)
    want, last = set(), {}
    for row in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[1], r[2])):
        if row[0] not in last or row[1] - last[row[0]] >= 13:
            last[row[0]] = row[1]
            want.add(row)
    for block in (13, 40, 1000):
        found = list(map(tuple, metrics.throttle(df, "k", "t", 13, block_ns=block).collect()))
        assert set(found) == want and len(found) == len(want)
    assert metrics.throttle(df.limit(0), "k", "t", 13).count() == 0
    # Three perps of one minute's quotes: gaps are all under the interval, so each choice hangs on the one before.
    dense = spark.range(3000).selectExpr("'p' AS k", "id * 7 AS t", "id AS seq")
    assert [r.t for r in metrics.throttle(dense, "k", "t", 100, block_ns=400).orderBy("t").collect()] == list(range(0, 21000, 105))


def test_asof_state_is_the_same_for_any_block(spark):
    draw = random.Random(3)
    events = [(draw.choice("ab"), draw.randrange(500), draw.choice([None, 1.0, 2.0, 3.0]), n) for n in range(400)]
    asked = [(k, t) for k in "abc" for t in range(0, 500, 37)]
    df = spark.createDataFrame(events, "instrument_id string, ts_event_ns long, v double, seq long").withColumn("ts_init_ns", F.col("ts_event_ns"))
    requests = spark.createDataFrame(asked, "instrument_id string, now_ns long")
    want = {}
    for k, t in asked:
        seen = sorted((e[1], e[3], e[2]) for e in events if e[0] == k and e[1] <= t and e[2] is not None)
        want[k, t] = seen[-1][2] if seen else None
    for block in (10, 100, 10_000):
        found = asof.asof_state(requests, df, "instrument_id", ["v"], block_ns=block)
        assert {(r.instrument_id, r.now_ns): r.v for r in found.collect()} == want


def test_asof_reads_and_shuffles_events_once(spark, tmp_path):
    path = f"file://{tmp_path}/events"
    # One key holds most events, all of them on one day.
    spark.range(6000).selectExpr("IF(id % 6 = 0, concat('k', id % 5), 'busy') AS k", "id * 1000000000 AS ts_event_ns", "id AS ts_init_ns", "id AS seq", "IF(id % 4 = 0, NULL, id * 1.0D) AS v").write.parquet(path)
    events = spark.read.parquet(path)
    requests = spark.createDataFrame([("busy", 5_000_000_000_000), ("busy", 17), ("busy", -1), ("k0", 4_000_000_000_000), ("nobody", 5), (None, 5)], "k string, now_ns long")
    block = asof.block_length(events, "k", rows=500)
    assert block < 700 * 1_000_000_000 and asof.block_length(events, "k") == asof.DAY_NS
    found = asof.asof_state(requests, events, "k", ["v"], block_ns=block)
    got = {(r.k, r.now_ns): r.v for r in found.collect()}
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert plan.count("FileScan") == 1 and len(re.findall(r"\+- Exchange hashpartitioning\(k#\d+, __day", plan)) == 1 and "ReusedExchange" in plan
    rows = events.filter("v IS NOT NULL").collect()
    for (k, now), v in got.items():
        best = max(((r.ts_event_ns, r.v) for r in rows if r.k == k and r.ts_event_ns <= now), default=(0, None))[1]
        assert v == best
    assert set(got) == {("busy", 5_000_000_000_000), ("busy", 17), ("busy", -1), ("k0", 4_000_000_000_000), ("nobody", 5)}


def test_bad_log_lines_are_named_by_file_and_line(spark, tmp_path):
    good = '{"event_kind":"startup","venue_id":"v","underlying":"BTC","resolved_at_ns":5,"selected_strikes":["1"]}'
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.json").write_text(f"{good}\n\n  \n{good}\n")
    path = f"file://{tmp_path}/log"
    assert [(r.venue_id, r.resolved_at_ns, r.selected_strikes) for r in lineage.read_resolutions(spark, path).collect()] == [("v", 5, ["1"])] * 2
    (tmp_path / "log" / "b.json").write_text(f'{good}\n\n{good}\n{{"event_kind":"refr\n{good}\n{{"resolved_at_ns":"soon"}}\n')
    assert sorted((r.path[-6:], r.line) for r in lineage.bad_lines(spark, path, lineage.RESOLUTION_SCHEMA).collect()) == [("b.json", 4), ("b.json", 6)]
    with pytest.raises(ValueError, match=r"b\.json, line 4: not a record"):
        lineage.read_resolutions(spark, path)


def test_outcome_log_round_trip(spark, tmp_path):
    resolutions = spark.createDataFrame([("s1", "u", 10, 7, "q", 100, [1, 2], ["a", "b"], "p", ["p", "a", "b"]), ("s2", "u", 20, 8, "q", 200, [3], ["c"], "p", ["p", "c"]), ("s3", "u", 30, 8, "q", 200, [3], ["c"], "p", ["p", "c"])], "snapshot_id string, universe_id string, now_ns long, question_id long, name string, expiration_ns long, outcome_ids array<long>, outcome_instrument_ids array<string>, perp_instrument_id string, all_instrument_ids array<string>")
    specs = spark.createDataFrame([("u", "PRICEBINARY", "btc", "1d", True)], "universe_id string, market_class string, spec_underlying string, spec_period string, include_perp boolean")
    path = f"file://{tmp_path}/outcomes"
    lineage.append_resolutions(lineage.outcome_records(resolutions, outcomes.refresh_outcome_universes(resolutions), specs), path)
    back = lineage.read_outcome_resolutions(spark, path).orderBy("resolved_at_ns").collect()
    assert back[0].__fields__ == [c.split()[0] for c in lineage.OUTCOME_SCHEMA.split(", ")]
    assert [(r.event_kind, r.question_id, r.outcome_ids, r.added_instrument_ids, r.removed_instrument_ids, r.rollover_reason) for r in back] == [("startup", 7, [1, 2], [], [], None), ("refresh", 8, [3], ["c"], ["a", "b"], "question_roll")]


def test_plan_and_pairs_from_one_pass(spark):
    """A plan goes through its resolutions once, and chosen strikes aren't looked up in a list for each pair."""
    schema = "all_instrument_ids array<string>, option_instrument_ids array<string>, perp_instrument_id string"
    plan = planning.expand_universe(spark.createDataFrame([(["o", "p"], ["o"], "p")], schema))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LogicalRDD") + text.count("LocalRelation") <= 1
    assert plan.count() == 6 * 2 + 2 + 3
    row = spark.createDataFrame([("u", NOW, "BTC", None, True, "p", 45, "all", 1, 1, 2, 65100.0)], REQUEST)
    found = universe.resolve_option_universes(row, options(spark))
    assert "array_contains" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_smoothing_takes_no_ids(spark):
    """Python gets no id list, whatever the universe's size."""
    rows = [("u", n, "all", None, 1, "1.0", [1.0, 2.0 + n], "p", ["a"], ["a", f"b{n}"], "BTC", None) for n in range(3)]
    schema = "universe_id string, resolved_at_ns long, strike_mode string, top_n int, selected_expiry_ns long, atm_reference string, selected_strikes array<double>, perp_instrument_id string, option_instrument_ids array<string>, all_instrument_ids array<string>, underlying string, error string"
    records = lineage.resolution_records(spark.createDataFrame(rows, schema))
    python = [line for line in records._jdf.queryExecution().optimizedPlan().toString().splitlines() if "MapInPandas" in line]
    assert python and not any("instrument_ids" in line for line in python)
    assert [(r.event_kind, r.added_instrument_ids, r.rollover_reason) for r in records.orderBy("resolved_at_ns").collect()] == [("startup", [], None), ("refresh", ["b1"], "strike_window_shift"), ("refresh", ["b2"], "strike_window_shift")]


def test_counted_live_options_equal_the_list(spark):
    schema = "universe_id string, now_ns long, underlying string, settlement_currency string"
    asked = spark.createDataFrame([("u", NOW, "BTC", None), ("v", E1, "BTC", "BTC"), ("w", NOW, "BTC", "USDC"), ("x", E2, "BTC", None)], schema)
    found = universe.count_live_options(options(spark), asked)
    keys = ["universe_id", "now_ns", "underlying"]
    want = universe.live_options(options(spark), asked).groupBy(*keys).agg(F.count("*").alias("n"), F.min("instrument_id").alias("least"))
    assert sorted(map(tuple, found.select(*keys, "n", "least").collect())) == sorted(map(tuple, want.collect())) == [("u", NOW, "BTC", 8, f"BTC-{E1}-64000-C.DERIBIT"), ("v", E1, "BTC", 2, f"BTC-{E2}-65000-C.DERIBIT")]


def test_shortlist_of_questions_by_numbers(spark):
    """Only numbers are compared before the shortlist: no row or description is sorted or shuffled for it."""
    rows = [("a", 100, q, "n", f"d{q}", [q], "u", e) for q, e in ((1, 90), (2, 150), (3, 150), (4, 200))] + [("a", 100, 5, "n", "d", [5], "v", 90), ("a", 100, 6, "n", "d", [6], "v", 80), ("a", 100, 7, "n", "d", [7], "w", 0), ("a", 100, 8, "n", "d", [8], "w", 0)]
    df = spark.createDataFrame(rows, "snapshot_id string, now_ns long, question_id long, name string, description string, outcome_ids array<long>, universe_id string, expiration_ns long")
    listed = outcomes._shortlist(df, ["snapshot_id", "universe_id"])
    assert sorted(r.question_id for r in listed.collect()) == [2, 5, 8]
    chosen = outcomes.choose_market(df, ["snapshot_id", "universe_id"])
    assert sorted(r.question_id for r in chosen.collect()) == [2, 5, 8]


def _leaves(df):
    return df._jdf.queryExecution().optimizedPlan().collectLeaves().size()


def test_requests_are_gone_through_once(spark):
    """Requests came up twice in their expiries, and with them all that they come from."""
    rows = [("u", NOW, "BTC", None, 45), ("v", NOW, "ETH", None, 45), ("w", NOW, "BTC", "USD", 45), ("x", E2, "BTC", None, 45), ("y", NOW, "BTC", "BTC", 1), ("z", E1, "BTC", "BTC", 45)]
    requests = spark.createDataFrame(rows, "universe_id string, now_ns long, underlying string, settlement_currency string, days_max int")
    found = universe.expiries(options(spark), requests)
    got = {r.universe_id: (r.expiration_ns, r.any_live) for r in found.collect()}
    assert got == {"u": (E1, True), "v": (None, False), "w": (None, False), "x": (None, False), "y": (None, True), "z": (E2, True)}
    assert _leaves(found) == 2


def test_plans_are_gone_through_once(spark):
    """Plans came up three times in their merger and four times in their delta."""
    spec = lambda *ids: spark.createDataFrame([("quotes", i, None, None, None, None) for i in ids], planning.PLAN_SCHEMA)
    merged, delta = planning.merge_plans(spec("a", "a", "b"), spec("b", "c", "c")), planning.plan_delta(spec("a", "a", "b"), spec("b", "c", "c"))
    assert sorted(r.instrument_id for r in merged.collect()) == ["a", "a", "b", "c"]
    assert sorted((r.change, r.instrument_id) for r in delta.collect()) == [("add", "c"), ("add", "c"), ("remove", "a"), ("remove", "a")]
    assert (_leaves(merged), _leaves(delta)) == (2, 2)
