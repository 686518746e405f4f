"""Column expressions of the market operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)\s*$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole(number: str | Column, by: int | Column) -> Column:
    """Integer quotient. Nanoseconds exceed what a double holds, so they are never divided as such."""
    return F.call_function("div", _col(number), F.lit(by) if isinstance(by, int) else by)


def stable_key(family: Column, type_: Column, id_: Column, namespace: Column) -> Column:
    """family|type|id|namespace with _ for absent parts."""
    return F.concat_ws("|", family, type_, F.coalesce(id_, F.lit("_")), F.coalesce(namespace, F.lit("_")))


def venue_of(id_: str | Column) -> Column:
    """The text after the last dot."""
    return F.substring_index(_col(id_), ".", -1)


def symbol_of(id_: str | Column) -> Column:
    id_ = _col(id_)
    return F.when(F.contains(id_, F.lit(".")), F.regexp_extract(id_, r"^(.*)\.[^.]*$", 1)).otherwise(id_)


def parse_option_id(id_: str | Column) -> Column:
    """Struct expiry, strike, kind from the first C or P token at index 2 or later; null where there is none."""
    tokens = F.split(F.substring_index(_col(id_), ".", 1), "-")
    places = F.filter(F.sequence(F.lit(0), F.size(tokens) - 1), lambda i: (i >= 2) & F.element_at(tokens, i + 1).isin("C", "P"))
    at = F.try_element_at(places, F.lit(1))
    strike = F.element_at(tokens, at)
    return F.when(at.isNotNull() & strike.rlike(NUMBER), F.struct(F.element_at(tokens, at - 1).alias("expiry"), strike.try_cast("double").alias("strike"), F.element_at(tokens, at + 1).alias("kind")))


def normalize_iv(x: str | Column) -> Column:
    """Percent to fraction: values beyond 3 are divided by 100."""
    x = _col(x)
    return F.when(F.abs(x) > 3, x / 100).otherwise(x)


def mid(bid: str | Column = "bid_price", ask: str | Column = "ask_price") -> Column:
    return (_col(bid).cast("double") + _col(ask).cast("double")) / 2


def spread(bid: str | Column = "bid_price", ask: str | Column = "ask_price") -> Column:
    return _col(ask).cast("double") - _col(bid).cast("double")


def finite(x: str | Column) -> Column:
    """True for numbers that are neither null, NaN nor infinite."""
    x = _col(x).cast("double")
    return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))


def perp_id(venue: Column, underlying: Column, settlement: Column) -> Column:
    """The perpetual's id by venue kind; null for an unknown venue or a missing settlement currency that it needs."""
    return (
        F.when(F.upper(venue) == "DERIBIT", F.concat(underlying, F.lit("-PERPETUAL.DERIBIT")))
        .when(F.upper(venue) == "BYBIT", F.concat(underlying, settlement, F.lit("-LINEAR.BYBIT")))
        .when(F.upper(venue) == "OKX", F.concat(underlying, F.lit("-"), settlement, F.lit("-SWAP.OKX")))
    )


def bybit_symbol(symbol: str | Column) -> Column:
    return F.concat(_col(symbol), F.lit("-OPTION"))


def parse_description(text: str | Column) -> Column:
    """Map of k:v parts between bars: first colon splits, both sides trimmed, empty keys and parts without a colon dropped, the last of equal keys stays."""
    parts = F.filter(F.split(_col(text), r"\|"), lambda p: F.contains(p, F.lit(":")))
    pairs = F.transform(parts, lambda p: F.struct(F.trim(F.substring_index(p, ":", 1)).alias("k"), F.trim(F.substr(p, F.instr(p, ":") + 1)).alias("v")))
    return F.map_from_entries(F.filter(pairs, lambda p: p["k"] != ""))


def expiry_ns(text: str | Column) -> Column:
    """Nanoseconds of an expiry: 16 or more digits are ns, 13 ms, 10 s; YYYYMMDD-HHMM is UTC; anything else 0."""
    text = F.trim(_col(text))
    number = text.try_cast("long")
    stamp = F.unix_micros(F.try_to_timestamp(text, F.lit("yyyyMMdd-HHmm"))) * 1000
    value = F.when(text.rlike(r"^\d{16,}$"), number).when(text.rlike(r"^\d{13}$"), number * 1_000_000).when(text.rlike(r"^\d{10}$"), number * 1_000_000_000).when(text.rlike(r"^\d{8}-\d{4}$"), stamp)
    return F.coalesce(value, F.lit(0).cast("long"))


def thresholds(text: str | Column) -> Column:
    """The numbers of a comma list; other parts are dropped."""
    parts = F.filter(F.split(_col(text), ","), lambda p: p.rlike(NUMBER))
    return F.transform(parts, lambda p: F.trim(p).cast("decimal(28,10)"))


def start_price(fields: str | Column) -> Column:
    """The first of targetPrice, startPrice, startPx, strike and strikePrice that is a number."""
    fields = _col(fields)
    keys = ("targetPrice", "startPrice", "startPx", "strike", "strikePrice")
    values = [F.try_element_at(fields, F.lit(k)) for k in keys]
    return F.coalesce(*[F.when(v.rlike(NUMBER), F.trim(v).try_cast("decimal(28,10)")) for v in values])


def period_bucket(text: Column) -> Column:
    text = F.lower(F.trim(text))
    return F.when(text.isin("1d", "daily", "24h"), "1d").otherwise(text)


def matches_market(fields: str | Column, class_: Column, underlying: Column, period: Column) -> Column:
    """Class and underlying agree ignoring case, periods agree in their bucket; a missing field never matches."""
    fields = _col(fields)
    own = {k: F.try_element_at(fields, F.lit(k)) for k in ("class", "underlying", "period")}
    same = (F.lower(own["class"]) == F.lower(class_)) & (F.lower(own["underlying"]) == F.lower(underlying)) & (period_bucket(own["period"]) == period_bucket(period))
    return F.coalesce(same, F.lit(False))


def outcome_instruments(ids: str | Column) -> Column:
    """YES then NO instrument of each outcome id."""
    return F.flatten(F.transform(_col(ids), lambda i: F.array(F.concat(i.cast("string"), F.lit("-YES-OUTCOME.HYPERLIQUID")), F.concat(i.cast("string"), F.lit("-NO-OUTCOME.HYPERLIQUID")))))


def next_seal_ns(now_ns: str | Column, hour: int = 6, minute: int = 0, zone: str = "UTC", interval_secs: int = 86_400) -> Column:
    """The next seal boundary strictly after now: the schedule on now's local date, then whole intervals.

    An ambiguous local time is its earlier instant; where a clock change skips the local time, the schedule of the next day counts.
    """
    now = _col(now_ns)
    micros = whole(now, 1000)
    local_day = F.to_date(F.from_utc_timestamp(F.timestamp_micros(micros), zone))

    def instant(day: Column) -> tuple[Column, Column]:
        wall = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(f" {hour:02d}:{minute:02d}:00"))
        utc = F.to_utc_timestamp(F.to_timestamp(wall), zone)
        # The earlier of two instants with this wall time, if an hour before has the same one.
        before = utc - F.expr("INTERVAL 1 HOUR")
        utc = F.when(F.date_format(F.from_utc_timestamp(before, zone), "yyyy-MM-dd HH:mm:ss") == wall, before).otherwise(utc)
        return F.unix_micros(utc) * 1000, F.date_format(F.from_utc_timestamp(utc, zone), "yyyy-MM-dd HH:mm:ss") == wall

    today, exists = instant(local_day)
    tomorrow, _ = instant(F.date_add(local_day, 1))
    anchor = F.when(exists, today).otherwise(tomorrow)
    step = F.lit(interval_secs * 1_000_000_000)
    return F.when(anchor > now, anchor).otherwise(anchor + (whole(now - anchor, step) + 1) * step)


def parse_metric(text: str | Column) -> Column:
    """A metric's text as a number if it is finite and above zero, else null."""
    number = F.trim(_col(text)).try_cast("double")
    return F.when(finite(number) & (number > 0), number)


def iso8601(ns: str | Column) -> Column:
    ns = _col(ns)
    seconds = F.timestamp_seconds(whole(ns, 1_000_000_000))
    return F.concat(F.date_format(seconds, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("."), F.lpad((ns % 1_000_000_000).cast("string"), 9, "0"), F.lit("Z"))


def book_summary_id(metadata: str | Column, identifier: str | Column) -> Column:
    """CUR:kind of a book summary; null if the currency is missing or a given identifier differs."""
    metadata, identifier = _col(metadata), _col(identifier)
    currency = F.upper(F.trim(F.try_element_at(metadata, F.lit("currency"))))
    kind = F.coalesce(F.lower(F.trim(F.try_element_at(metadata, F.lit("kind")))), F.lit("option"))
    own = F.when(currency != "", F.concat(currency, F.lit(":"), kind))
    return F.when(identifier.isNull() | (identifier == own), own)


def sample_center(ids: str | Column, limit: int = 6) -> Column:
    """`limit` ids around the middle of a list sorted by strike."""
    ids = _col(ids)
    n = F.size(ids)
    start = F.greatest(F.floor(n / 2).cast("int") - limit // 2, F.lit(0))
    start = F.least(start + limit, n) - limit
    return F.when(n <= limit, ids).otherwise(F.slice(ids, start + 1, F.lit(limit)))
