import glob

import pytest
from pyspark.sql import functions as F

from mdlake.operators import sealing, sink
from mdlake.operators.lineage import smooth_strikes
from mdlake.plans.catalog_queries import surface_events
from mdlake.sources import catalog, derived
from mdlake.streaming import capture
from mdlake.streaming.online_metrics import EVENTS, StoredMembers, Surface, option_metrics_stream, replay_option_metrics
from mdlake.streaming.smoothing import RESOLUTIONS, smooth_strikes_stream

SF = "/root/testdata/sf0.001"
DAY = derived.DAY_NS


@pytest.fixture
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.unset(key)


def test_surface_golden():
    s = Surface()
    s.take("reset", "PERP", None, None, None, None, None, None, 0, 10)
    for id_, k, kind in (("a", 62000, "P"), ("b", 62500, "C"), ("c", 62500, "P"), ("d", 63000, "C")):
        s.take("member", id_, k, kind, None, None, None, None, 0, 10)
    s.take("quote", "PERP", None, None, 62454.0, 62454.5, None, None, 1, 10)
    out = [s.take("greek", i, None, None, None, None, iv, 0.5, t, 10) for i, iv, t in (("a", 40.0, 2), ("b", 35.62, 3), ("c", 35.62, 4), ("d", 32.19, 5), ("d", 32.19, 6), ("a", None, 15), ("a", 40.0, 3))]
    assert [bool(x) for x in out] == [False, False, False, True, False, True, False]
    assert (round(out[3][2], 6), round(out[3][5], 6)) == (0.3562, -0.0781)
    assert s.take("quote", "PERP", None, None, float("nan"), 1.0, None, None, 18, 10) is None and s.s["perp_mid"] == 62454.25
    s.take("reset", "PERP", None, None, None, None, None, None, 20, 10)
    assert s.take("quote", "PERP", None, None, 1.0, 2.0, None, None, 40, 10) is None


class FakeMap(dict):
    """A map state that counts what is read and written."""

    def __init__(self):
        super().__init__()
        self.reads, self.writes = [], []

    def containsKey(self, key):
        return key in self

    def getValue(self, key):
        self.reads.append(key[0])
        return self[key]

    def updateValue(self, key, value):
        self.writes.append(key[0])
        self[key] = value

    def removeKey(self, key):
        self.pop(key, None)


class FakeValue:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


def test_a_batch_touches_only_its_members():
    state = FakeMap(), FakeMap(), FakeValue()
    store = StoredMembers(*state)
    s = Surface(store)
    s.take("reset", "PERP", None, None, None, None, None, None, 0, 10)
    for i in range(1000):
        s.take("member", f"o{i}", 100 + i // 2, "CP"[i % 2], None, None, None, None, 0, 10)
    store.flush()
    head = tuple(s.s.values())
    assert len(state[0]) == 1000 and len(state[2].value[0]) == 500
    state[0].writes.clear()
    store = StoredMembers(*state)
    s = Surface(store, head)
    for t, (id_, iv) in enumerate((("o1", 0.5), ("o998", 0.4), ("o500", 0.3), ("o500", 0.2)), 1):
        s.take("greek", id_, None, None, None, None, iv, 0.5, t, 10)
    found = s.take("quote", "PERP", None, None, 350.0, 350.2, None, None, 5, 10)
    assert found and found[1] == 350.0 and found[2] == 0.2 and found[7:] == (3, 0, 1000)
    store.flush()
    assert sorted(state[0].writes) == ["o1", "o500", "o998"] and len(state[0].reads) <= 8
    s.take("member", "o500", 99.0, "P", None, None, None, None, 6, 10)
    store.flush()
    assert state[2].value[0][0] == 99.0 and state[1][(350.0,)] == (["o501"],) and s.s["ready"] == 2 and s.s["count"] == 1000


def test_a_universe_without_members_asks_nothing_of_the_store():
    class Asked(FakeMap):
        def containsKey(self, key):
            self.reads.append(key[0])
            return super().containsKey(key)

    state = Asked(), Asked(), FakeValue()
    for again in range(2):
        s = Surface(StoredMembers(*state))
        s.take("reset", "PERP", None, None, None, None, None, None, 0, 10)
        for i in range(100):
            s.take("member", f"o{again}{i}", 100 + i // 2, "CP"[i % 2], None, None, None, None, 0, 10)
        s.take("greek", "unknown", None, None, None, None, 0.5, 0.5, 1, 10)
        s.members.flush()
    assert not state[0].reads and not state[1].reads
    assert len(state[0]) == 100 and len(state[1]) == 50 and ("o00",) not in state[0]


def test_stream_equals_replay(rocksdb, tmp_path):
    spark = rocksdb
    events = surface_events(spark, SF).filter("universe_id LIKE 'BTC:%'")
    rows = events.orderBy("ts_ns", "seq").collect()
    want = sorted(map(tuple, replay_option_metrics(events, DAY).collect()))
    assert len(want) > 5
    for i in range(3):
        part = rows[i * len(rows) // 3 : (i + 1) * len(rows) // 3]
        spark.createDataFrame(part, events.schema).coalesce(1).write.parquet(f"file://{tmp_path}/in/{i}")
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"file://{tmp_path}/in")
    query = option_metrics_stream(stream, DAY).writeStream.format("memory").queryName("surface").outputMode("append").option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination(240)
    assert query.exception() is None
    assert sorted(map(tuple, spark.sql("SELECT * FROM surface").collect())) == want


def test_capture_then_drain(spark, tmp_path):
    root = f"file://{tmp_path}"
    rows = derived.trades(spark, SF).withColumn("side", F.lit("buy")).withColumn("instrument_id", F.substring_index("instrument_id", "-", 1)).withColumn("price", F.col("price").cast("decimal(28,10)")).withColumn("size", F.col("size").cast("decimal(28,10)"))
    bad = rows.limit(3).withColumn("instrument_id", F.lit(None).cast("string"))
    for i, part in enumerate((rows.filter("seq % 3 = 0"), rows.filter("seq % 3 <> 0"), bad)):
        part.coalesce(1).write.mode("append").parquet(f"{root}/land")
        stream = capture.start_capture(catalog.stream_family(spark, f"{root}/land", "trades"), root, "trades", f"{root}/cp")
        stream.awaitTermination(120)
        assert stream.exception() is None
    capture.drain(spark, root, "trades")
    back = catalog.read_family(spark, root, "trades")
    assert back.count() == rows.count()
    assert spark.read.parquet(f"{root}/_quarantine/trades").count() == 3
    assert not glob.glob(f"{tmp_path}/trades/**/*.part", recursive=True)
    stats = sink.with_seal_date(back.drop("seal_date"))
    now = stats.agg(F.max("seal_end_ns")).first()[0]
    assert capture.seal_due(stats, now).count() == stats.select("instrument_id", "seal_end_ns").distinct().count()
    assert capture.seal_due(stats, 0).count() == 0


def test_stateless_and_gated_streams(spark, tmp_path):
    root = f"file://{tmp_path}"
    greeks = derived.greeks(spark, SF)
    greeks.write.parquet(f"{root}/g")
    stream = spark.readStream.schema(greeks.schema).parquet(f"{root}/g")
    ready = greeks.filter("seq % 2 = 0").select("instrument_id", "ts_init_ns")
    for name, df, want in (("fwd", capture.forward_price_stream(stream), sink.forward_prices(greeks)), ("gated", capture.gate_stream(stream, ready), None)):
        q = df.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{root}/cp-{name}").trigger(availableNow=True).start()
        q.awaitTermination(120)
        got = spark.sql(f"SELECT * FROM {name}").count()
        if want is None:
            first = ready.groupBy("instrument_id").agg(F.min("ts_init_ns").alias("r"))
            want = greeks.join(first, "instrument_id").filter("ts_init_ns >= r")
        assert got == want.count() > 0


def test_snapshot_polls(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.json").write_text('{"identifier":"BTC:option","rows":[{"currency":"BTC","kind":"option","mark_iv":0.5,"instrument_id":"x","ts_event_ns":1,"ts_init_ns":2,"seq":3},{"currency":"BTC","kind":"option","instrument_id":"y","ts_event_ns":1,"ts_init_ns":2,"seq":4}]}\n')
    stream = catalog.stream_snapshots(spark, f"file://{tmp_path}/p", "DeribitBookSummary")
    q = stream.writeStream.format("memory").queryName("polls").option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [(r.identifier, r.instrument_id, r.mark_iv) for r in spark.sql("SELECT * FROM polls ORDER BY seq").collect()] == [("BTC:option", "x", 0.5), ("BTC:option", "y", None)]


def test_smoothing_stream_equals_history(rocksdb, tmp_path):
    spark = rocksdb
    strikes = [[1.0], [2.0], [2.0], [3.0], [2.0], [4.0], [4.0], [1.0], [1.0]]
    rows = [(u, t, "oi_ranked", 1 if t < 7 else 2, k) for u in ("a", "b") for t, k in enumerate(strikes)] + [("c", t, "all", 1, k) for t, k in enumerate(strikes)]
    frame = spark.createDataFrame(rows, RESOLUTIONS)
    want = sorted((r.universe_id, r.resolved_at_ns, r.applied, r.applied_strikes) for r in smooth_strikes(frame, 2).collect())
    assert [x[2] for x in want[:9]] == [True, False, True, False, True, False, True, True, True]
    for i in range(3):
        frame.filter(f"resolved_at_ns % 9 div 3 = {i}").coalesce(1).write.parquet(f"file://{tmp_path}/in/{i}")
    stream = spark.readStream.schema(RESOLUTIONS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"file://{tmp_path}/in")
    query = smooth_strikes_stream(stream, 2).writeStream.format("memory").queryName("smoothed").outputMode("append").option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination(240)
    assert sorted((r.universe_id, r.resolved_at_ns, r.applied, r.applied_strikes) for r in spark.sql("SELECT * FROM smoothed").collect()) == want


def test_custom_stream_has_a_frozen_schema(spark, tmp_path):
    rows = derived.trades(spark, SF).withColumn("instrument_id", F.substring_index("instrument_id", "-", 1)).withColumn("value", F.col("price")).select("value", F.lit("dvol").alias("index_name"), "instrument_id", "ts_event_ns", "ts_init_ns", "seq")
    rows.write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"file://{tmp_path}/in")
    schema = "value double, index_name string, instrument_id string, ts_event_ns bigint, ts_init_ns bigint, seq bigint"
    capture.write_custom_stream(stream, f"file://{tmp_path}", "DeribitVolatilityIndex", schema, f"file://{tmp_path}/cp").awaitTermination(120)
    capture.drain(spark, f"file://{tmp_path}", "custom/DeribitVolatilityIndex", schema=f"{schema}, seal_date date")
    assert catalog.read_custom(spark, f"file://{tmp_path}", "DeribitVolatilityIndex").count() == rows.count()
    assert catalog.read_custom(spark, f"file://{tmp_path}", "HyperliquidOpenInterest").count() == 0
    with pytest.raises(ValueError, match="another schema"):
        capture.write_custom_stream(stream.drop("value"), f"file://{tmp_path}", "DeribitVolatilityIndex", schema, f"file://{tmp_path}/cp2")


def test_delta_batches(spark):
    rows = spark.createDataFrame([("x", [(1.0, 5), (2.0, 6)]), ("y", [])], "instrument_id string, deltas array<struct<price:double,seq:bigint>>")
    assert [(r.instrument_id, r.price, r.seq) for r in sink.explode_deltas(rows).collect()] == [("x", 1.0, 5), ("x", 2.0, 6)]


def test_a_batch_that_cannot_be_written_does_not_end_the_stream(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}"
    rows = spark.createDataFrame([("A.X", 1.0, 10, 10, 1), ("B.X", 2.0, 20, 20, 2)], "instrument_id string, price double, ts_event_ns bigint, ts_init_ns bigint, seq bigint")
    real, calls = capture.stage, []

    def once(df, staging, batch, query):
        calls.append(batch)
        if batch == 0:
            raise RuntimeError("disk full")
        real(df, staging, batch, query)

    monkeypatch.setattr(capture, "stage", once)
    for i in range(2):
        rows.filter(f"seq = {i + 1}").coalesce(1).write.parquet(f"{root}/in/{i}")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{root}/in")
    query = capture.start_capture(stream, root, "trades", f"{root}/cp")
    query.awaitTermination(120)
    assert query.exception() is None and calls == [0, 1]
    refused = spark.read.parquet(f"{root}/_refused/trades").collect()
    assert len(refused) == 1 and "disk full" in refused[0].error
    capture.drain(spark, root, "trades", schema="price double, ts_event_ns bigint, ts_init_ns bigint, seq bigint, instrument_id string, seal_date date")
    assert spark.read.option("pathGlobFilter", "*.parquet").parquet(f"{root}/trades").count() == 1


PLAIN = "instrument_id string, price double, ts_event_ns bigint, ts_init_ns bigint, seq bigint"
SEALED = f"{PLAIN}, seal_date date"


def _rows(spark, low, high, ids=("A.X",)):
    return spark.createDataFrame([(ids[i % len(ids)], float(i), DAY + i, DAY + i, i) for i in range(low, high)], PLAIN)


def _capture(spark, source, root, checkpoint, **options):
    stream = spark.readStream.schema(PLAIN).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(source)
    query = capture.start_capture(stream, root, "trades", checkpoint, **options)
    query.awaitTermination(120)
    return query


def test_captures_with_equal_batch_ids_lose_and_double_nothing(spark, tmp_path):
    """Two streams on one family, each from batch 0, then one of them again from a new checkpoint with other rows."""
    root = f"file://{tmp_path}"
    for k, (low, high) in enumerate([(0, 10), (10, 30), (30, 60)]):
        _rows(spark, low, high).coalesce(1).write.parquet(f"{root}/in{k}")
    for k in (0, 1):
        _capture(spark, f"{root}/in{k}", root, f"{root}/cp{k}")
    staged = spark.read.parquet(f"{root}/_staging/trades")
    assert {(r.batch, r.n) for r in staged.groupBy("query", "batch").agg(F.count("*").alias("n")).collect()} == {(0, 10), (0, 20)}
    assert capture.drain(spark, root, "trades", schema=SEALED) == 2
    # Stopped and started from the same checkpoint: nothing new. From a new one: batch 0 again, with other rows.
    _capture(spark, f"{root}/in0", root, f"{root}/cp0")
    _capture(spark, f"{root}/in2", root, f"{root}/cp2")
    assert capture.drain(spark, root, "trades", schema=SEALED) == 1
    assert sorted(r.seq for r in catalog.read_family(spark, root, "trades", schema=SEALED).collect()) == list(range(60))
    assert sealing.ledger(spark, root, "trades").select("query").distinct().count() == 3


def test_a_sealed_batch_id_with_other_rows_is_not_lost(spark, tmp_path):
    root, staging = f"file://{tmp_path}", f"file://{tmp_path}/_staging/trades"
    for low, high, want in ((0, 5, 5), (0, 5, 5), (5, 9, 9)):
        sealing.stage(sink.with_seal_date(_rows(spark, low, high)).drop("seal_end_ns"), staging, 0, "q")
        sealing.seal(spark, root, "trades", SEALED, staging)
        assert catalog.read_family(spark, root, "trades", schema=SEALED).count() == want
        assert sealing.staged_windows(spark, staging) == []


def test_a_busy_day_is_several_sorted_files(spark, tmp_path, monkeypatch):
    root, staging = f"file://{tmp_path}", f"file://{tmp_path}/_staging/trades"
    monkeypatch.setattr(sealing, "TARGET_ROWS", 1000)
    rows = _rows(spark, 0, 9000).union(spark.createDataFrame([("B.X", 1.0, DAY, DAY, -1)], PLAIN))
    sealing.stage(sink.with_seal_date(rows).drop("seal_end_ns").repartition(5), staging, 0)
    sealing.seal(spark, root, "trades", SEALED, staging)
    sizes = [r.n for r in catalog.read_family(spark, root, "trades", schema=SEALED).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 9001 and len(sizes) >= 9 and max(sizes) <= 2500
    spans = [(r.low, r.high) for r in catalog.read_family(spark, root, "trades", ids=["A.X"], schema=SEALED).groupBy(F.input_file_name()).agg(F.min("seq").alias("low"), F.max("seq").alias("high")).collect()]
    assert all(a[1] < b[0] for a, b in zip(sorted(spans), sorted(spans)[1:], strict=False))


def test_one_bad_row_of_a_thousand_loses_one_row(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}"
    _rows(spark, 0, 1000).repartition(3).write.parquet(f"{root}/in")
    real = capture.stage

    def picky(df, staging, batch, query):
        if df.filter("seq = 617").take(1):
            raise RuntimeError("row 617 breaks a rule")
        real(df, staging, batch, query)

    monkeypatch.setattr(capture, "stage", picky)
    stream = spark.readStream.schema(PLAIN).parquet(f"{root}/in")
    query = capture.start_capture(stream, root, "trades", f"{root}/cp")
    query.awaitTermination(240)
    assert query.exception() is None
    capture.drain(spark, root, "trades", schema=SEALED)
    assert sorted(r.seq for r in catalog.read_family(spark, root, "trades", schema=SEALED).collect()) == [i for i in range(1000) if i != 617]
    refused = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/_refused").collect()
    assert len(refused) == 1 and '"seq":617' in refused[0].row and "breaks a rule" in refused[0].error


def test_values_that_do_not_fit_are_kept_and_storage_errors_stop_the_stream(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}"
    text = _rows(spark, 0, 6).withColumn("price", F.when(F.col("seq") == 4, "much").otherwise(F.col("price").cast("string")))
    text.coalesce(1).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(text.schema).parquet(f"{root}/in")
    capture.start_capture(stream, root, "trades", f"{root}/cp", schema=PLAIN).awaitTermination(120)
    capture.drain(spark, root, "trades", schema=SEALED)
    assert sorted(r.price for r in catalog.read_family(spark, root, "trades", schema=SEALED).collect()) == [0.0, 1.0, 2.0, 3.0, 5.0]
    refused = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/_refused").collect()
    assert [r.error for r in refused] == ["does not fit: price"] and '"price":"much"' in refused[0].row

    def full(df, staging, batch, query):
        raise OSError("no space left")

    real = capture.stage
    monkeypatch.setattr(capture, "stage", full)
    with pytest.raises(Exception, match="no space left"):
        _capture(spark, f"{root}/in2" if _rows(spark, 6, 8).coalesce(1).write.parquet(f"{root}/in2") is None else "", root, f"{root}/cp2")
    monkeypatch.setattr(capture, "stage", real)
    _capture(spark, f"{root}/in2", root, f"{root}/cp2")
    capture.drain(spark, root, "trades", schema=SEALED)
    assert catalog.read_family(spark, root, "trades", schema=SEALED).count() == 7


def test_an_instrument_defined_after_the_start_is_captured_from_then_on(spark, tmp_path):
    root = f"file://{tmp_path}"
    define = lambda id_, ts, n: spark.createDataFrame([(id_, ts)], "instrument_id string, ts_init_ns long").coalesce(1).write.parquet(f"{root}/definitions/{n}")
    define("A.X", 0, 0)
    _rows(spark, 0, 10, ("A.X", "B.X")).coalesce(1).write.parquet(f"{root}/in/0")
    _capture(spark, f"{root}/in", root, f"{root}/cp", definitions=f"{root}/definitions")
    define("B.X", DAY + 12, 1)
    _rows(spark, 10, 20, ("A.X", "B.X")).coalesce(1).write.parquet(f"{root}/in/1")
    _capture(spark, f"{root}/in", root, f"{root}/cp", definitions=f"{root}/definitions")
    capture.drain(spark, root, "trades", schema=SEALED)
    back = catalog.read_family(spark, root, "trades", schema=SEALED).collect()
    assert sorted(r.seq for r in back if r.instrument_id == "A.X") == list(range(0, 20, 2))
    assert sorted(r.seq for r in back if r.instrument_id == "B.X") == [13, 15, 17, 19]


def test_the_first_batch_freezes_a_custom_schema(spark, tmp_path):
    root = f"file://{tmp_path}"
    rows = _rows(spark, 0, 5).withColumnRenamed("price", "value")
    rows.write.parquet(f"{root}/in0")
    rows.withColumn("more", F.lit("x")).write.parquet(f"{root}/in1")
    for k in (0, 1, 0):
        source = spark.read.parquet(f"{root}/in{k}").schema
        capture.write_custom_stream(spark.readStream.schema(source).parquet(f"{root}/in{k}"), root, "Own", None, f"{root}/cp{k}").awaitTermination(120)
    frozen = capture.frozen_schema(spark, root, "Own")
    assert "`value` double" in frozen and "more" not in frozen
    capture.drain(spark, root, "custom/Own", schema=f"{frozen}, seal_date date")
    assert spark.read.option("pathGlobFilter", "*.parquet").parquet(f"{root}/custom/Own").count() == 5
    refused = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/_refused/custom/Own").collect()
    assert len(refused) == 5 and all('"more":"x"' in r.row and "other columns" in r.error for r in refused)


def test_forward_price_log(spark, tmp_path):
    greeks = derived.greeks(spark, SF).withColumn("instrument_id", F.col("instrument_id"))
    greeks.write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(greeks.schema).parquet(f"file://{tmp_path}/in")
    for _ in range(2):
        capture.log_forward_prices(stream, f"file://{tmp_path}/log", f"file://{tmp_path}/cp").awaitTermination(120)
    log = catalog.read_forward_prices(spark, f"file://{tmp_path}/log")
    assert log.count() == greeks.filter("underlying_price IS NOT NULL").count() > 0
