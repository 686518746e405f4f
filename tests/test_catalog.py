import glob
import os

import pytest
from pyspark.sql import functions as F

from mdlake.operators import custom, presets, sealing, sink, validate
from mdlake.sources import catalog

TRADES = "instrument_id string, price double, ts_event_ns bigint, ts_init_ns bigint, seq bigint, seal_date date"
DAY = 86_400_000_000_000
START = 1_782_000_000_000_000_000


def trades(spark, n=40, ids=("A.X", "B.X")):
    rows = [(ids[i % len(ids)], float(i), START + i * DAY // 8, START + i * DAY // 8, i) for i in range(n)]
    return spark.createDataFrame(rows, "instrument_id string, price double, ts_event_ns bigint, ts_init_ns bigint, seq bigint")


def test_seal_is_idempotent_sorted_and_keeps_equal_rows(spark, tmp_path):
    root, staging = f"file://{tmp_path}", f"file://{tmp_path}/_staging/trades"
    rows = sink.with_seal_date(trades(spark)).drop("seal_end_ns").repartition(4)
    sealing.stage(rows.filter("seq < 30"), staging, 0)
    for again in range(3):
        if again == 2:
            sealing.stage(rows.filter("seq >= 25"), staging, 1)
        sealed = sealing.seal(spark, root, "trades", TRADES, staging)
        assert (sealed > 0) == (again != 1)
        files = glob.glob(f"{tmp_path}/trades/*/*/*.parquet")
        back = catalog.read_family(spark, root, "trades", schema=TRADES)
        assert back.count() == (30 if again < 2 else 45)
        assert len(files) == back.select("instrument_id", "seal_date").distinct().count()
        assert sealing.staged_windows(spark, staging) == []
    assert validate.check_ascending(validate.file_order(back), "instrument_id").count() == 0
    assert catalog.read_family(spark, root, "trades", ids=["A.X"], start_ns=START + DAY, end_ns=START + 2 * DAY, schema=TRADES).count() == 5
    assert {(r.instrument_id, r.rows) for r in catalog.count_rows(spark, root, ["trades", "quotes"]).collect()} == {("A.X", 22), ("B.X", 23)}
    assert {(r.family, r.instrument_id) for r in catalog.list_families(spark, root).collect()} == {("trades", "A.X"), ("trades", "B.X")}
    files = sink.manifest(spark.read.schema(TRADES).parquet(f"{root}/trades"), "trades").collect()
    assert sum(r.rows for r in files) == 45 and all(r.bytes > 0 and r.min_ts_ns <= r.max_ts_ns for r in files)


def test_days_are_sealed_in_turn_and_stay_untouched(spark, tmp_path):
    root, staging = f"file://{tmp_path}", f"file://{tmp_path}/_staging/trades"
    rows = sink.with_seal_date(trades(spark, 24)).drop("seal_end_ns")
    sealing.stage(rows, staging, 0)
    days = sorted({d for _, d in sealing.staged_windows(spark, staging)})
    stamps = {}
    for k, day in enumerate(days):
        assert sealing.seal(spark, root, "trades", TRADES, staging, until=day) == 1
        files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/trades/*/*/*.parquet")}
        assert stamps.items() <= files.items() and len(files) > len(stamps)
        assert {d for _, d in sealing.staged_windows(spark, staging)} == set(days[k + 1 :])
        stamps = files
    assert catalog.read_family(spark, root, "trades", schema=TRADES).count() == 24
    # The same batch delivered again is known and not sealed a second time.
    sealing.stage(rows, staging, 0)
    assert sealing.seal(spark, root, "trades", TRADES, staging) == 0
    assert catalog.read_family(spark, root, "trades", schema=TRADES).count() == 24
    assert sealing.due_date(START) == "2026-06-21" or sealing.due_date(START) == "2026-06-20"


def test_a_plan_that_was_cut_short_is_carried_out_first(spark, tmp_path, monkeypatch):
    root, staging = f"file://{tmp_path}", f"file://{tmp_path}/_staging/trades"
    rows = sink.with_seal_date(trades(spark, 16)).drop("seal_end_ns")
    sealing.stage(rows, staging, 0)
    real = sealing.remove

    def dies(session, path):
        if "batch=0" in path:
            raise RuntimeError("killed")
        real(session, path)

    monkeypatch.setattr(sealing, "remove", dies)
    with pytest.raises(RuntimeError):
        sealing.seal(spark, root, "trades", TRADES, staging)
    monkeypatch.setattr(sealing, "remove", real)
    sealing.stage(rows.limit(3), staging, 1)
    sealing.seal(spark, root, "trades", TRADES, staging)
    assert catalog.read_family(spark, root, "trades", schema=TRADES).count() == 19
    assert sealing.seal(spark, root, "trades", TRADES, staging) == 0


def test_aliases_parts_and_recovery(spark, tmp_path):
    root = f"file://{tmp_path}"
    trades(spark, 6).withColumn("bar_type", F.col("instrument_id")).write.partitionBy("instrument_id").parquet(f"{root}/bar")
    assert catalog.resolve_family_dir(spark, root, "bars") == f"{root}/bar"
    assert catalog.resolve_family_dir(spark, root, "quotes") is None
    assert catalog.read_family(spark, root, "quotes").count() == 0
    os.makedirs(tmp_path / "open")
    trades(spark, 5).coalesce(1).write.parquet(f"{root}/one")
    whole = open(glob.glob(f"{tmp_path}/one/*.parquet")[0], "rb").read()
    for name, data in (("a", whole), ("b", whole[:50]), ("c", b"")):
        (tmp_path / "open" / f"{name}.parquet.part").write_bytes(data)
    schema = TRADES.replace(", seal_date date", "")
    assert {r.key[-14] for r in validate.no_open_parts(spark, f"{root}/open").collect()} == {"a", "b", "c"}
    active = {p for p, _ in sealing.open_parts(spark, f"{root}/open") if "b.parquet" in p}
    report = {os.path.basename(r.path)[0]: r for r in sealing.recover(spark, f"{root}/open", schema, active).collect()}
    assert {k: r.state for k, r in report.items()} == {"a": "sealed", "c": "empty"}
    assert report["a"].rows == 5 and "2026-06-2" in report["a"].sealed
    report = {os.path.basename(r.path)[0]: r for r in sealing.recover(spark, f"{root}/open", schema).collect()}
    assert {k: r.state for k, r in report.items()} == {"b": "corrupt"}
    assert validate.no_open_parts(spark, f"{root}/open").count() == 1
    assert spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{root}/open").count() == 5
    trades(spark, 5).limit(0).coalesce(1).write.parquet(f"{root}/none")
    os.rename(glob.glob(f"{tmp_path}/none/*.parquet")[0], tmp_path / "none" / "n.parquet.part")
    assert [r.state for r in sealing.recover(spark, f"{root}/none", schema).collect()] == ["empty"]
    assert sealing.recover(spark, f"{root}/nowhere", schema).count() == 0
    os.makedirs(tmp_path / "twins")
    for name in "xy":
        (tmp_path / "twins" / f"{name}.parquet.part").write_bytes(whole)
    twins = sealing.recover(spark, f"{root}/twins", schema).collect()
    assert [r.state for r in twins] == ["sealed"] * 2 and len({r.sealed for r in twins}) == 2
    assert sealing.recover(spark, f"{root}/twins", schema).count() == 0
    assert spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{root}/twins").count() == 10


def test_intervals_and_sizes(spark):
    rows = spark.createDataFrame([("k", i, s, e) for i, (s, e) in enumerate([(100, 100), (100, 100), (200, 300), (150, 180)])], "k string, i int, start_ns long, end_ns long")
    got = sink.disjoint_intervals(rows, "k", "i").orderBy("i").collect()
    assert [(r.file_start, r.file_end) for r in got] == [(100, 100), (101, 101), (200, 300), (301, 301)]
    seeded = sink.disjoint_intervals(rows.withColumn("seed", F.lit(100).cast("long")), "k", "i", seed="seed").orderBy("i").first()
    assert (seeded.file_start, seeded.file_end) == (101, 101)
    assert [sink.flush_rows("order_book_deltas", n)[0] for n in (2000, 40000)] == [20000, 40000]
    assert sink.flush_rows("custom") == (1000, 50000) and sink.flush_rows("mark_prices")[0] == 100 and sink.flush_rows("quotes", 50) == (50, 50)
    files = spark.createDataFrame([("x", 830 * 86400, 0, 86400 * 10**9)], "instrument_id string, rows long, min_ts_ns long, max_ts_ns long")
    r = sink.capacity_report(files).first()
    assert (r.groups_per_day, r.least_group_rows) == (1435, 21886)


def test_violations(spark):
    nan, inf = float("nan"), float("inf")
    greeks = [("ok", 0.5, 1.0, 1.0, 1.0, 1.0, 1), ("bad", 0.5, nan, inf, None, 1.0, 1), ("bad2", 0.5, 1.0, 1.0, 1.0, 1.0, 1), ("bad2", None, 1.0, 1.0, 1.0, 1.0, 2)]
    df = spark.createDataFrame(greeks, "instrument_id string, mark_iv double, delta double, gamma double, vega double, theta double, seq long").withColumns({"ts_event_ns": F.col("seq"), "ts_init_ns": F.col("seq")})
    assert sorted((r.key, r.rule) for r in validate.greeks_ok(df).collect()) == [("bad", "greeks:delta"), ("bad", "greeks:gamma"), ("bad", "greeks:vega"), ("bad2", "greeks:mark_iv")]
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "instrument_id string")
    members = spark.createDataFrame([("u", "a"), ("u", "b"), ("v", "c")], "universe_id string, instrument_id string")
    assert [r.key for r in validate.any_option_has(members, rows, 2, "trades").collect()] == ["v"]
    assert sorted(r.instrument_id for r in validate.with_quotes(members, rows.filter("instrument_id = 'a'")).collect()) == ["a", "c"]
    assert [r.key for r in validate.contract_state(rows, members, "instrument_status").collect()] == ["c"]
    counts = {r.instrument_id: (r.q, r.t) for r in validate.readback_counts({"q": rows, "t": rows.limit(0)}).collect()}
    assert counts == {"a": (2, 0), "b": (1, 0)}
    records = spark.createDataFrame([("u", 5, ["a", "z"])], "universe_id string, question_id long, all_instrument_ids array<string>")
    found = spark.createDataFrame([("u", 6), ("w", 7)], "universe_id string, question_id long")
    assert sorted((r.rule, r.key) for r in validate.validate_outcome_capture(records, found, rows).collect()) == [("one_startup", "w"), ("outcome_ids", "w"), ("outcome_rows", "z"), ("question", "u"), ("question", "w")]
    metrics = sink.capture_metrics(spark.createDataFrame([("q", 5, 100, "seal"), ("q", 5, 200, "rows")], "family string, rows long, bytes long, reason string"), spark.createDataFrame([("q", 1)], "family string, n long"))
    assert {(r.family, r.accepted, r.mean_file_bytes, r.dropped) for r in metrics.collect()} == {("q", 10, 150, 1), (None, 10, 150, 1)}
    assert {r.rule for r in sink.metrics_ok(metrics).collect()} == {"dropped"}


@pytest.mark.parametrize(("lines", "want"), [([("tick", 0), ("tick", 1), ("response", 2), ("tick", 3)], ["fire", "skip", "response", "fire"]), ([("tick", 0), ("tick", 10)], ["fire", "timeout"])])
def test_request_replay(spark, lines, want):
    log = spark.createDataFrame([("j", t * 1_000_000_000, i, k, 5 if k == "response" else 0) for i, (k, t) in enumerate(lines)], "job string, ts_ns long, seq long, kind string, rows long")
    replayed = custom.replay_requests(log, 10_000_000_000)
    assert [r.action for r in replayed.orderBy("seq").collect()] == want
    total = custom.request_metrics(replayed).filter("job IS NULL").first()
    assert (total.polls, total.skipped, total.timeouts, total.in_flight) == (2, want.count("skip"), want.count("timeout"), 1)


def test_presets():
    assert len(presets.PRESETS) == 7 and all(c.min_rows == 1 for c in presets.PRESETS.values())
    base = presets.overridden(presets.PRESETS["research"], min_rows=4, contract_state=False, bar_types=(), min_perp_trades=None)
    assert (base.min_rows, base.contract_state, base.bar_types) == (4, True, (presets.RESEARCH_BARS,))
    assert presets.overridden(base, bar_types=["x"]).bar_types == ("x",)
    assert presets.preset_for(bar_types=[presets.RESEARCH_BARS], refresh=True) == "research" == presets.preset_for(custom_types=[presets.RESEARCH_TYPE])
    assert presets.preset_for(refresh=True, venues=["BYBIT"], families=["trades"]) == "rolling_autorefresh"
    assert presets.preset_for(venues=["Bybit-1"], families=["trades"]) == "venue_trades"
    assert presets.preset_for(venues=["Bybit-1"], families=["quotes"]) == presets.preset_for(venues=["DERIBIT"], families=["trades"]) == "post_capture"
    found = presets.checks_for(bar_types=["b"], venues=["DERIBIT"], families=["trades", "forward_prices"])
    assert (found.bar_types, found.min_perp_trades, found.min_option_trades, found.forward_prices) == (("b",), 1, 1, True)
    for bad in ({"min_rows": 0}, {"min_option_deltas": -1}):
        with pytest.raises(ValueError):
            presets.Checks(**bad)


def test_contract_state_may_be_absent_but_not_wrong(spark):
    members = spark.createDataFrame([("a",), ("b",)], "instrument_id string")
    states = spark.createDataFrame([("a", 1, "f", 0), ("a", 3, "f", 1), ("a", 2, "f", 2)], "instrument_id string, ts_init_ns long, __path string, __row long")
    assert [(r.rule, r.key) for r in validate.contract_state(states, members, "instrument_closes", required=False).collect()] == [("ascending:instrument_closes", "a")]
    assert sorted(r.rule for r in validate.contract_state(states, members, "s").collect()) == ["ascending:s", "state:s"]
    assert validate.contract_state(members.limit(0), members, "s", required=False).count() == 0


def test_counts_come_from_footers(spark, tmp_path):
    root = f"file://{tmp_path}"
    sink.write_chunk(trades(spark, 50), root, "trades")
    footers, sizes = catalog.read_footers(spark, root, "trades"), catalog.file_sizes(spark, root, "trades")
    plan = footers._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(ts_init_ns), MAX(ts_init_ns)]" in plan and "PushedGroupBy: [instrument_id, seal_date]" in plan
    assert "ReadSchema: struct<>" in sizes._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    files = glob.glob(f"{tmp_path}/trades/*/*/*.parquet")
    parts = catalog.partition_manifest(spark, root, ["trades", "quotes"]).collect()
    assert sum(r.files for r in parts) == len(files) and sum(r.bytes for r in parts) == sum(map(os.path.getsize, files)) and sum(r.rows for r in parts) == 50
    assert (min(r.min_ts_ns for r in parts), max(r.max_ts_ns for r in parts)) == (START, START + 49 * DAY // 8)
    assert validate.no_open_parts(spark, root, least_sealed=1).count() == 0
    assert [(r.rule, r.actual) for r in validate.no_open_parts(spark, f"{root}/quotes", least_sealed=2).collect()] == [("sealed_files", "0")]


def test_files_of_a_few_rows(spark, tmp_path):
    root = f"file://{tmp_path}"
    sink.write_limited(trades(spark, 20).withColumn("seal_date", F.lit("2026-06-21").cast("date")), root, "trades", 4)
    files = catalog.file_sizes(spark, root, "trades")
    found = sink.capture_metrics(sink.flushes(files, 4), spark.createDataFrame([], "family string, n long")).filter("family IS NULL").first()
    assert (found.accepted, found.files, found.flush_rows, found.flush_seal) == (20, 6, 4, 2) and found.bytes == sum(map(os.path.getsize, glob.glob(f"{tmp_path}/trades/*/*/*.parquet")))
    active = spark.createDataFrame([("q", 5, 0, -1), ("r", 5, 0, 0), ("s", 5, 0, None)], "family string, accepted long, dropped long, active long")
    assert sorted((r.family, r.rule) for r in sink.metrics_ok(active).collect()) == [("q", "active"), ("s", "active")]


def test_files_of_a_few_rows_are_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(400).select(F.concat("id", F.lit(".X")).alias("instrument_id"), F.lit(START).alias("ts_init_ns"), F.lit("2026-06-21").cast("date").alias("seal_date"))
    sink.write_limited(rows, f"file://{tmp_path}", "trades", 4)
    files = [os.path.basename(f) for f in glob.glob(f"{tmp_path}/trades/*/*/*.parquet")]
    assert len(files) == 400 and len({f.split("-")[1] for f in files}) >= spark.sparkContext.defaultParallelism


def test_definitions_and_rows_that_cannot_be_placed(spark, tmp_path):
    root = f"file://{tmp_path}"
    columns = [c.split()[0] for c in catalog.SCHEMAS["instruments"].split(", ") if "seal_date" not in c and c != "10)"]
    rows = trades(spark, 4).select(*[F.col(c) if c in ("instrument_id", "ts_event_ns", "ts_init_ns", "seq") else F.lit(None).alias(c) if c != "strike" else F.col("price").cast("decimal(28,10)").alias(c) for c in columns])
    schema = {f.name: f.dataType for f in spark.createDataFrame([], catalog.SCHEMAS["instruments"]).schema}
    rows = rows.select(*[F.col(c).cast(schema[c]).alias(c) for c in columns])
    sink.write_instruments(rows, root)
    assert {r.instrument_id: float(r.strike) for r in catalog.read_instruments(spark, root).collect()} == {"A.X": 2.0, "B.X": 3.0}
    assert [r.instrument_id for r in catalog.read_instruments(spark, root, ["A.X"]).collect()] == ["A.X"]
    lost = trades(spark, 3).withColumn("instrument_id", F.when(F.col("seq") > 0, F.col("instrument_id")))
    sink.write_chunk(lost, root, "trades")
    assert spark.read.parquet(f"{root}/_quarantine/trades").count() == 1 and catalog.count_rows(spark, root, ["trades"]).agg(F.sum("rows")).first()[0] == 2


def test_listing_documents_are_whole_files(spark, tmp_path):
    for name, text in (("a", '{\n "questions": []\n}\n'), ("b", "{}")):
        (tmp_path / f"{name}.json").write_text(text)
    assert sorted(r.payload for r in catalog.read_listings(spark, f"file://{tmp_path}").collect()) == ['{\n "questions": []\n}\n', "{}"]


def test_ascending_across_blocks_of_a_file(spark, tmp_path, monkeypatch):
    """No window spans a whole file, and a step back between two of its blocks is found once."""
    spark.range(0, 40, 1, 1).selectExpr("CASE WHEN id = 16 OR id = 21 THEN 0 ELSE id END AS ts_init_ns").write.parquet(f"{tmp_path}/f")
    monkeypatch.setattr(validate, "BLOCK_ROWS", 8)
    found = validate.check_ascending(validate.file_order(spark.read.parquet(f"{tmp_path}/f")))
    assert sorted(map(tuple, found.collect())) == [("ascending", "all", "15", "0"), ("ascending", "all", "20", "0")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert all("__block" in line for line in plan.splitlines() if "Window [" in line)
