import pytest
from pyspark.sql import functions as F

from mdlake.functions import scalars as S


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("id_", "want"),
    [
        ("BTC-20JUN26-62500-C.DERIBIT", ("20JUN26", 62500.0, "C")),
        ("BTC-20JUN26-62500-P-USDT-OPTION.BYBIT", ("20JUN26", 62500.0, "P")),
        ("BTC-USD-260620-62500-C.OKX", ("260620", 62500.0, "C")),
        ("BTC-20JUN26-abc-C.DERIBIT", None),
        ("BTC-PERPETUAL.DERIBIT", None),
        ("C-P", None),
    ],
)
def test_option_ids(spark, id_, want):
    got = one(spark, S.parse_option_id("id"), id=id_)
    assert (tuple(got) if got else None) == want


def test_ids_and_keys(spark):
    assert one(spark, S.venue_of("id"), id="A.B.OKX") == "OKX"
    assert one(spark, S.symbol_of("id"), id="A.B.OKX") == "A.B"
    null = F.lit(None).cast("string")
    assert one(spark, S.stable_key(F.lit("quotes"), F.lit("Q"), null, F.lit("n"))) == "quotes|Q|_|n"
    assert one(spark, S.perp_id(F.lit("deribit"), F.lit("BTC"), null)) == "BTC-PERPETUAL.DERIBIT"
    assert one(spark, S.perp_id(F.lit("BYBIT"), F.lit("BTC"), F.lit("USDT"))) == "BTCUSDT-LINEAR.BYBIT"
    assert one(spark, S.perp_id(F.lit("OKX"), F.lit("BTC"), F.lit("USD"))) == "BTC-USD-SWAP.OKX"
    assert one(spark, S.perp_id(F.lit("OKX"), F.lit("BTC"), null)) is None
    assert one(spark, S.bybit_symbol("s"), s="BTC-1") == "BTC-1-OPTION"


def test_numbers(spark):
    assert one(spark, S.normalize_iv(F.lit(35.62))) == pytest.approx(0.3562)
    assert one(spark, S.normalize_iv(F.lit(0.3562))) == 0.3562
    assert one(spark, S.normalize_iv(F.lit(3.0))) == 3.0
    for text, want in (("12.5", 12.5), (" 7 ", 7.0), ("", None), ("nan", None), ("-1", None), ("0", None), ("Infinity", None)):
        assert one(spark, S.parse_metric("t"), t=text) == want
    assert [float(x) for x in one(spark, S.thresholds("t"), t="1, 2.5,x,,1e3")] == [1.0, 2.5]


def test_descriptions(spark):
    got = one(spark, S.parse_description("d"), d="class:priceBinary| a : x:y |nov|:z|class:B")
    assert got == {"class": "B", "a": "x:y"}
    fields = S.parse_description(F.lit("class:priceBinary|underlying:btc|period:Daily"))
    assert one(spark, S.matches_market(fields, F.lit("PRICEBINARY"), F.lit("BTC"), F.lit("1d")))
    assert not one(spark, S.matches_market(fields, F.lit("priceBinary"), F.lit("ETH"), F.lit("1d")))
    assert not one(spark, S.matches_market(S.parse_description(F.lit("class:priceBinary")), F.lit("priceBinary"), F.lit("BTC"), F.lit("1d")))
    assert float(one(spark, S.start_price(S.parse_description(F.lit("targetPrice:x|startPx:5.5|strike:9"))))) == 5.5
    assert one(spark, S.outcome_instruments(F.array(F.lit(326)))) == ["326-YES-OUTCOME.HYPERLIQUID", "326-NO-OUTCOME.HYPERLIQUID"]


@pytest.mark.parametrize(("text", "want"), [("20260614-0600", 1781416800000000000), ("1781416800", 1781416800000000000), ("1781416800000", 1781416800000000000), ("1781416800000000001", 1781416800000000001), ("soon", 0), ("", 0), ("20261399-0600", 0)])
def test_expiry(spark, text, want):
    assert one(spark, S.expiry_ns("t"), t=text) == want


def ns(spark, text):
    return one(spark, F.unix_micros(F.to_timestamp(F.lit(text))) * 1000)


@pytest.mark.parametrize(
    ("now", "hour", "minute", "zone", "interval", "want"),
    [
        ("2026-06-22 05:30:00", 6, 0, "UTC", 86400, "2026-06-22 06:00:00"),
        ("2026-06-22 06:00:00", 6, 0, "UTC", 86400, "2026-06-23 06:00:00"),
        ("2026-06-22 03:20:00", 6, 0, "UTC", 3600, "2026-06-22 06:00:00"),
        ("2026-06-22 06:20:00", 6, 0, "UTC", 3600, "2026-06-22 07:00:00"),
        ("2026-03-08 06:00:00", 2, 30, "America/New_York", 86400, "2026-03-09 06:30:00"),
        ("2026-11-01 04:30:00", 1, 30, "America/New_York", 86400, "2026-11-01 05:30:00"),
    ],
)
def test_seal_boundary(spark, now, hour, minute, zone, interval, want):
    got = one(spark, S.next_seal_ns(F.lit(ns(spark, now)), hour, minute, zone, interval))
    assert got == ns(spark, want)


def test_nanoseconds_stay_exact(spark):
    assert one(spark, S.iso8601(F.lit(1781416799999999999))) == "2026-06-14T05:59:59.999999999Z"
    assert one(spark, S.whole(F.lit(1781416799999999999), 1000)) == 1781416799999999


def test_sample_and_iso(spark):
    ids = [f"i{k}" for k in range(12)]
    assert one(spark, S.sample_center(F.array(*map(F.lit, ids)), 6)) == ids[3:9]
    assert one(spark, S.sample_center(F.array(*map(F.lit, ids[:4])), 6)) == ids[:4]
    assert one(spark, S.iso8601(F.lit(1781416800000000001))) == "2026-06-14T06:00:00.000000001Z"
    meta = F.create_map(F.lit("currency"), F.lit("btc"))
    assert one(spark, S.book_summary_id(meta, F.lit(None).cast("string"))) == "BTC:option"
    assert one(spark, S.book_summary_id(meta, F.lit("ETH:option"))) is None
