"""What a validation asks for: presets, overrides, and the preset that a capture's settings call for."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Checks:
    """Least rows and switches of a validation; a least of zero asks for nothing."""

    min_rows: int = 1
    min_perp_trades: int = 0
    min_option_trades: int = 0
    min_option_deltas: int = 0
    contract_state: bool = False
    refresh_change: bool = False
    forward_prices: bool = False
    skip_options: bool = False
    bar_types: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.min_rows <= 0:
            raise ValueError("min_rows must be positive")
        if min(self.min_perp_trades, self.min_option_trades, self.min_option_deltas) < 0:
            raise ValueError("least rows can't be negative")


# The bar type and custom type of a research capture, and what each preset asks for.
RESEARCH_BARS = "BTC-PERPETUAL.DERIBIT-1-MINUTE-LAST-EXTERNAL"
RESEARCH_TYPE = "DeribitVolatilityIndex"
PRESETS = {
    "post_capture": Checks(),
    "rolling_autorefresh": Checks(),
    "venue_trades": Checks(min_perp_trades=1, min_option_trades=1),
    "research": Checks(contract_state=True, bar_types=(RESEARCH_BARS,)),
    "trades_smoke": Checks(min_perp_trades=1, min_option_trades=1),
    "bars_smoke": Checks(skip_options=True),
    "book_deltas_smoke": Checks(skip_options=True, min_option_deltas=1),
}
_TRADE_VENUES = ("bybit", "okx")


def overridden(checks: Checks, **given) -> Checks:
    """checks with the values that are given; None, an empty list and a switch that is off leave them as they are."""
    return replace(checks, **{k: tuple(v) if k == "bar_types" else v for k, v in given.items() if v is not None and v is not False and v != ()})


@dataclass(frozen=True)
class Capture:
    """What a capture's settings say: bar types, custom types, whether universes are refreshed, venues, option families."""

    bar_types: tuple[str, ...] = ()
    custom_types: tuple[str, ...] = ()
    refresh: bool = False
    venues: tuple[str, ...] = ()
    families: tuple[str, ...] = ()

    def has_bars(self, name: str) -> bool:
        return any(name in t for t in self.bar_types)

    def on(self, names: tuple[str, ...]) -> bool:
        return any(name in v.lower() for v in self.venues for name in names)


#: The first of these that a capture answers names its preset.
_CALLS = (
    ("research", lambda c: c.has_bars(RESEARCH_BARS) or RESEARCH_TYPE in c.custom_types),
    ("rolling_autorefresh", lambda c: c.refresh),
    ("venue_trades", lambda c: "trades" in c.families and c.on(_TRADE_VENUES)),
    ("post_capture", lambda c: True),
)
#: What families and bars of a capture add to its preset: at least these values.
_ADDED = (
    (lambda c: "trades" in c.families, {"min_perp_trades": 1, "min_option_trades": 1}),
    (lambda c: "forward_prices" in c.families, {"forward_prices": True}),
)


def _capture(given: dict) -> Capture:
    return Capture(**{k: v if isinstance(v, bool) else tuple(v) for k, v in given.items()})


def preset_for(**given) -> str:
    """The preset of a capture. given: fields of Capture."""
    return next(name for name, answers in _CALLS if answers(_capture(given)))


def checks_for(**given) -> Checks:
    """The checks of a capture: its preset, its own bar types, and what its families call for. given: fields of Capture."""
    capture = _capture(given)
    checks = PRESETS[preset_for(**given)]
    for called, least in _ADDED:
        if called(capture):
            checks = replace(checks, **{k: max(v, getattr(checks, k)) for k, v in least.items()})
    return replace(checks, bar_types=capture.bar_types or checks.bar_types)
