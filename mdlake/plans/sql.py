"""The derived market tables in DuckDB SQL, for the statements that queries are held against."""

from __future__ import annotations

_UND = "['BTC','ETH','SOL'][({}) % 3 + 1]"

TABLES = {
    "dealt_v": "SELECT * EXCLUDE (x, n), CASE WHEN x % 2 = 0 THEN x // 2 ELSE n - 1 - x // 2 END AS pk FROM (SELECT events.*, n, event_id % greatest(n // 10, least(n, 200), 1) AS x FROM events, (SELECT count(*) AS n FROM part))",
    "options_v": f"""SELECT und || '-E' || e || '-' || k || '-' || kind || '.DERIBIT' AS instrument_id, 'option' AS class, und AS underlying, und AS settlement_currency, k::DOUBLE AS strike, kind,
        1704096000000000000 + e * 604800000000000 AS expiration_ns, CASE WHEN p_partkey % 13 = 0 THEN 0.0 ELSE p_size END::DOUBLE AS open_interest, p_partkey
        FROM (SELECT *, p_partkey // 2 AS pair, {_UND.format('p_partkey // 2')} AS und, (p_partkey // 2 // 3) % 6 AS e, 100 + 10 * (p_partkey // 2 // 18) + CASE WHEN p_partkey % 17 = 0 THEN 5 ELSE 0 END AS k, CASE WHEN p_partkey % 2 = 0 THEN 'C' ELSE 'P' END AS kind FROM part)""",
    "quotes_v": f"""SELECT {_UND.format('user_id')} || '-PERPETUAL.DERIBIT' AS instrument_id, value AS bid_price, value + 0.5 AS ask_price, epoch_us(ts) * 1000 AS ts_event_ns, epoch_us(ts) * 1000 AS ts_init_ns, event_id AS seq FROM events WHERE event_type = 'view'
        UNION ALL SELECT instrument_id, value, value + 0.5, epoch_us(ts) * 1000, epoch_us(ts) * 1000, event_id FROM dealt_v JOIN options_v ON pk = p_partkey WHERE event_type IN ('click', 'signup')""",
    "greeks_v": """SELECT instrument_id, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 3 = 0 THEN value / 10 ELSE value / 1000 END AS mark_iv, (event_id % 200) / 200.0::DOUBLE AS delta, value + 100 AS underlying_price, user_id::DOUBLE AS open_interest,
        epoch_us(ts) * 1000 AS ts_event_ns, epoch_us(ts) * 1000 AS ts_init_ns, event_id AS seq FROM dealt_v JOIN options_v ON pk = p_partkey WHERE event_type = 'error'""",
    "trades_v": "SELECT instrument_id, value AS price, (event_id % 10 + 1)::DOUBLE AS size, epoch_us(ts) * 1000 AS ts_event_ns, epoch_us(ts) * 1000 AS ts_init_ns, event_id AS seq FROM dealt_v JOIN options_v ON pk = p_partkey WHERE event_type = 'purchase'",
    "trades_hist_v": "SELECT instrument_id, l_extendedprice / l_quantity AS price, l_quantity AS size, epoch_us(l_shipdate) * 1000 AS ts_event_ns, epoch_us(l_shipdate) * 1000 AS ts_init_ns, l_orderkey AS seq FROM lineitem JOIN options_v ON l_partkey % 200 + 1 = p_partkey",
    "requests_v": "SELECT unnest(['BTC','ETH','SOL']) AS underlying, day * 86400000000000 + 21600000000000 AS now_ns FROM (SELECT DISTINCT epoch_us(ts) // 86400000000 AS day FROM events)",
    "listings_v": f"""SELECT o_orderkey AS question, 'class:priceBinary|underlying:' || {_UND.format('o_custkey')} || '|expiry:' || strftime(o_orderdate, '%Y%m%d') || '-0600' || ['|period:1d','|period:daily','| period : 24h','|period:1w',''][substr(o_orderpriority, 1, 1)::INT] || '|targetPrice:' || trunc(o_totalprice)::BIGINT AS description,
        [o_custkey * 10] AS named_outcomes, o_custkey * 10 + 1 AS fallback_outcome, epoch_us(o_orderdate) * 1000 AS listed_ns FROM orders""",
}


def statement(body: str) -> str:
    """A statement with the derived tables before it; the body may go on with more common table expressions."""
    tables = ", ".join(f"{name} AS ({sql})" for name, sql in TABLES.items())
    body = body.strip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {tables}, {body[15:]}"
    return f"WITH {tables}, {body[5:]}" if body[:5].upper() == "WITH " else f"WITH {tables} {body}"
