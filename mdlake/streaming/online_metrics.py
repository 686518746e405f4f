"""Online option metrics: throttled snapshots of a universe's surface, in a stream or replayed over history."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Rows of the common stream. kind: reset (a universe change: instrument_id is the perp), member, quote, greek.
EVENTS = "universe_id string, kind string, instrument_id string, strike double, option_kind string, bid double, ask double, iv double, delta double, ts_ns bigint, seq bigint"
SNAPSHOT = "universe_id string, ts_ns bigint, perp_mid double, atm_strike double, atm_iv double, low_put_iv double, high_call_iv double, risk_reversal double, wing_richness double, greeks_ready bigint, quotes_ready bigint, option_count bigint"


def _number(x) -> float | None:
    return None if x is None or x != x else float(x)


def _ready(member: dict) -> bool:
    return member["iv"] is not None and member["delta"] is not None


_FIELDS = ("strike", "kind", "mid", "iv", "delta")


class Members:
    """The options of a universe by id and by strike."""

    def __init__(self):
        self.by_id: dict[str, dict | None] = {}
        self.ids_at: dict[float, list[str]] = {}
        self.strikes: list[float] = []

    def get(self, id_: str) -> dict | None:
        return self.by_id.get(id_)

    def ids(self, strike: float) -> list[str]:
        return self.ids_at.get(strike, [])

    def at(self, strike: float) -> list[dict]:
        return [self.get(i) for i in self.ids(strike)]

    def changed(self, id_: str) -> None:
        """What an id's record holds has changed."""

    def add(self, id_: str, strike: float, kind: str) -> None:
        if (old := self.get(id_)) and old["strike"] != strike:
            left = [i for i in self.ids(old["strike"]) if i != id_]
            self._place(old["strike"], left)
        if id_ not in self.ids(strike):
            self._place(strike, [*self.ids(strike), id_])
        self.by_id[id_] = {"strike": strike, "kind": kind, "mid": None, "iv": None, "delta": None}
        self.changed(id_)

    def _place(self, strike: float, ids: list[str]) -> None:
        at = bisect.bisect_left(self.strikes, strike)
        there = at < len(self.strikes) and self.strikes[at] == strike
        if ids and not there:
            self.strikes.insert(at, strike)
        elif there and not ids:
            del self.strikes[at]
        self.ids_at[strike] = ids

    def clear(self) -> None:
        self.by_id, self.ids_at, self.strikes = {}, {}, []


class StoredMembers(Members):
    """Members in the state of a stream: a record is read when it is first touched and written back if it changed.

    members: records by id; at: ids by strike; index: the sorted strikes, which change only with the members. Without
    an index there are no members, so nothing is asked of the store, to which each call takes long.
    """

    def __init__(self, members, at, index):
        super().__init__()
        self.stored, self.stored_at, self.index = members, at, index
        self.empty = not index.exists()
        self.strikes = [] if self.empty else list(index.get()[0])
        self.dirty: set[str] = set()
        self.dirty_at: set[float] = set()

    def get(self, id_: str) -> dict | None:
        if id_ not in self.by_id:
            self.by_id[id_] = dict(zip(_FIELDS, self.stored.getValue((id_,)), strict=True)) if not self.empty and self.stored.containsKey((id_,)) else None
        return self.by_id[id_]

    def ids(self, strike: float) -> list[str]:
        if strike not in self.ids_at:
            self.ids_at[strike] = list(self.stored_at.getValue((strike,))[0]) if not self.empty and self.stored_at.containsKey((strike,)) else []
        return self.ids_at[strike]

    def changed(self, id_: str) -> None:
        self.dirty.add(id_)

    def _place(self, strike: float, ids: list[str]) -> None:
        super()._place(strike, ids)
        self.dirty_at.add(strike)

    def clear(self) -> None:
        super().clear()
        self.empty, self.dirty, self.dirty_at = True, set(), set()
        for state in (self.stored, self.stored_at, self.index):
            state.clear()

    def flush(self) -> None:
        for id_ in self.dirty:
            self.stored.updateValue((id_,), tuple(self.by_id[id_][f] for f in _FIELDS))
        for strike in self.dirty_at:
            if self.ids_at[strike]:
                self.stored_at.updateValue((strike,), (self.ids_at[strike],))
            else:
                self.stored_at.removeKey((strike,))
        if self.dirty_at:
            self.index.update((self.strikes,))


_HEAD = ("perp", "perp_mid", "last", "ready", "quoted", "count")


class Surface:
    """Last quotes and greeks of one universe's members, and when it last gave a snapshot."""

    def __init__(self, members: Members | None = None, head: tuple | None = None):
        self.members = Members() if members is None else members
        self.s = dict(zip(_HEAD, head or (None, None, None, 0, 0, 0), strict=True))

    def _snapshot(self) -> tuple | None:
        mid, strikes = self.s["perp_mid"], self.members.strikes
        if mid is None or not strikes or not self.s["ready"]:
            return None
        near = bisect.bisect_left(strikes, mid)
        atm = min(strikes[max(near - 1, 0) : near + 1], key=lambda k: (abs(k - mid), k))
        mean = lambda xs: sum(xs) / len(xs) if xs else None
        ivs = lambda strike, kinds: mean([m["iv"] for m in self.members.at(strike) if m["kind"] in kinds and m["iv"] is not None])
        at, put, call = ivs(atm, "CP"), ivs(strikes[0], "P"), ivs(strikes[-1], "C")
        if at is None or put is None or call is None:
            return None
        return mid, atm, at, put, call, call - put, (put + call) / 2 - at, self.s["ready"], self.s["quoted"], self.s["count"]

    def take(self, kind: str, id_: str, strike, option_kind, bid, ask, iv, delta, ts: int, interval_ns: int) -> tuple | None:
        """Apply one row; a snapshot if the row is data, the interval has passed and the surface is complete."""
        s = self.s
        if kind == "reset":
            s.update(perp=id_, perp_mid=None, last=None, ready=0, quoted=0, count=0)
            self.members.clear()
            return None
        member = self.members.get(id_)
        if kind == "member":
            if member:
                s["ready"] -= _ready(member)
                s["quoted"] -= member["mid"] is not None
            else:
                s["count"] += 1
            self.members.add(id_, float(strike), option_kind)
            return None
        if kind == "quote":
            bid, ask = _number(bid), _number(ask)
            if bid is None or ask is None:
                return None
            mid = (bid + ask) / 2
            if id_ == s["perp"]:
                s["perp_mid"] = mid
            elif member:
                s["quoted"] += member["mid"] is None
                member["mid"] = mid
                self.members.changed(id_)
        elif member:
            was, iv = _ready(member), _number(iv)
            if iv is not None:
                member["iv"] = iv / 100 if abs(iv) > 3 else iv
            member["delta"] = _number(delta) if _number(delta) is not None else member["delta"]
            s["ready"] += _ready(member) - was
            self.members.changed(id_)
        if s["last"] is not None and max(0, ts - s["last"]) < interval_ns:
            return None
        found = self._snapshot()
        if found:
            s["last"] = ts
        return found


def _snapshots(surface: Surface, key: str, rows: pd.DataFrame, interval_ns: int) -> list[tuple]:
    columns = ["kind", "instrument_id", "strike", "option_kind", "bid", "ask", "iv", "delta", "ts_ns"]
    out = []
    for row in zip(*[rows[c].tolist() for c in columns], strict=True):
        if found := surface.take(*row, interval_ns):
            out.append((key, row[-1], *found))
    return out


#: Rows that are gone through before their snapshots are handed on.
_CHUNK = 50_000
_NAMES = [c.split()[0] for c in SNAPSHOT.split(", ")]


class OnlineMetrics(StatefulProcessor):
    """State of one universe: a head, its members by id, ids by strike and the sorted strikes; a reset row clears it.

    A batch reads and writes the members that its rows and snapshots touch, not the universe.
    """

    def __init__(self, interval_ns: int):
        self.interval_ns = interval_ns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.head = handle.getValueState("head", "perp string, perp_mid double, last bigint, ready bigint, quoted bigint, count bigint")
        self.members = handle.getMapState("members", "instrument_id string", "strike double, kind string, mid double, iv double, delta double")
        self.at = handle.getMapState("at", "strike double", "ids array<string>")
        self.index = handle.getValueState("index", "strikes array<double>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        members = StoredMembers(self.members, self.at, self.index)
        surface = Surface(members, tuple(self.head.get()) if self.head.exists() else None)
        # Rows of a key come unordered: its part of the batch is put in order once and gone through in chunks.
        batch = pd.concat(rows).sort_values(["ts_ns", "seq"])
        for at in range(0, len(batch), _CHUNK):
            yield pd.DataFrame(_snapshots(surface, key[0], batch.iloc[at : at + _CHUNK], self.interval_ns), columns=_NAMES)
        members.flush()
        self.head.update(tuple(surface.s[f] for f in _HEAD))

    def close(self) -> None:
        pass


def option_metrics_stream(events: DataFrame, interval_ns: int) -> DataFrame:
    """Snapshots of a stream of EVENTS rows; needs the RocksDB state store."""
    return events.groupBy("universe_id").transformWithStateInPandas(OnlineMetrics(interval_ns), SNAPSHOT, "Append", "None")


def replay_option_metrics(events: DataFrame, interval_ns: int) -> DataFrame:
    """The same over history: rows of a universe are streamed in order and only its surface is held."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, surface = None, Surface()
        for pdf in batches:
            out = []
            for k, rows in pdf.groupby("universe_id", sort=False):
                if k != key:
                    key, surface = k, Surface()
                out += _snapshots(surface, k, rows, interval_ns)
            yield pd.DataFrame(out, columns=_NAMES)

    ordered = events.repartition("universe_id").sortWithinPartitions("universe_id", "ts_ns", "seq")
    return ordered.mapInPandas(run, SNAPSHOT)
