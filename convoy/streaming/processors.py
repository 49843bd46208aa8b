"""Keyed state for streams: tumbling means, offline timers, lifetime usage, rolling trends.

One processor call sees the rows one key has in one micro-batch; the source's rate limit
bounds them. Rows are put in event order before they touch the state.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def in_order(rows: Iterator[Row]) -> list[Row]:
    return sorted(rows, key=lambda r: (r.us, r.seq))


class TumblingMean(StatefulProcessor):
    """Mean of a device's window after each event; a window is kept for its own length again."""

    OUTPUT = (
        "device string, type string, seq bigint, us bigint, window_us bigint, n bigint, mean double, "
        "critical_threshold double"
    )

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState(
            "windows", "type string, window_us bigint", "total double, n bigint, width_us bigint"
        )

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        kept: dict[tuple, tuple] = {}
        for row in in_order(rows):
            width = row.window_seconds * 1_000_000
            at = (row.group_type, row.us // width * width)
            total, n, _ = kept.get(at) or (self.windows.getValue(at) if self.windows.containsKey(at) else (0.0, 0, width))
            total, n = total + row.reading, n + 1
            kept[at] = (total, n, width)
            mean = total / n
            if mean > row.critical_threshold:
                yield Row(device=key[0], type=row.type, seq=row.seq, us=row.us, window_us=at[1], n=n, mean=mean,
                          critical_threshold=row.critical_threshold)
        for at, value in kept.items():
            self.windows.updateValue(at, value)
            self.handle.registerTimer((at[1] + 2 * value[2]) // 1000)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        now_ms = expiredTimerInfo.getExpiryTimeInMs()
        old = [at for at, v in self.windows.iterator() if (at[1] + 2 * v[2]) // 1000 <= now_ms]
        for at in old:
            self.windows.removeKey(tuple(at))
        return iter(())

    def close(self) -> None:
        pass


class LifetimeUsage(StatefulProcessor):
    """Usage so far after each observation of an asset."""

    OUTPUT = (
        "asset_id string, seq bigint, us bigint, distance_m double, terrain_deg_km double, "
        "observed_hours double, rounds_fired bigint"
    )

    FIELDS = ("distance_m", "terrain_deg_km", "first_us", "last_us", "rounds", "x", "y", "z", "pitch", "roll")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.usage = handle.getValueState(
            "usage", ", ".join(f"{name} {'bigint' if name in ('first_us', 'last_us', 'rounds') else 'double'}" for name in self.FIELDS))

    def handleInitialState(self, key: Any, initialState: Row, timerValues: Any) -> None:
        """Takes over what ``usage.usage_state`` found in the rows before the stream."""
        self.usage.update(tuple(initialState[name] for name in self.FIELDS))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        seen = self.usage.exists()
        distance, terrain, first, last, rounds, x, y, z, pitch, roll = (
            self.usage.get() if seen else (0.0, 0.0, 0, 0, 0, 0.0, 0.0, 0.0, None, None)
        )
        for row in in_order(rows):
            if seen:
                metres = math.dist((x, y, z), (row.x_m, row.y_m, row.z_m))
                distance += metres
                if None not in (pitch, roll, row.pitch_deg, row.roll_deg):
                    ends = abs(pitch) + abs(row.pitch_deg) + abs(roll) + abs(row.roll_deg)
                    terrain += ends / 2 * metres / 1000.0
                last = max(last, row.us)
            else:
                first = last = row.us
                seen = True
            rounds += bool(row.fired)
            x, y, z = row.x_m, row.y_m, row.z_m
            pitch = pitch if row.pitch_deg is None else row.pitch_deg
            roll = roll if row.roll_deg is None else row.roll_deg
            yield Row(asset_id=key[0], seq=row.seq, us=row.us, distance_m=distance, terrain_deg_km=terrain,
                      observed_hours=(last - first) / 3.6e9, rounds_fired=rounds)
        self.usage.update((distance, terrain, first, last, rounds, x, y, z, pitch, roll))

    def close(self) -> None:
        pass


#: Slices that a window is cut into; a window then needs samples of two slices and the moments of the others.
SLICES = 16
_HOUR_US = 3.6e9


class Moments:
    """Count, means and centred second moments of samples; times in hours after ``origin_us``."""

    FIELDS = "n bigint, mx double, my double, sxx double, syy double, sxy double, first_us bigint, last_us bigint, last double"

    def __init__(self, n=0, mx=0.0, my=0.0, sxx=0.0, syy=0.0, sxy=0.0, first_us=0, last_us=0, last=0.0) -> None:
        self.n, self.mx, self.my, self.sxx, self.syy, self.sxy = n, mx, my, sxx, syy, sxy
        self.first_us, self.last_us, self.last = first_us, last_us, last

    def values(self) -> tuple:
        return self.n, self.mx, self.my, self.sxx, self.syy, self.sxy, self.first_us, self.last_us, self.last

    def add(self, us: int, value: float, origin_us: int) -> None:
        self.join(Moments(1, (us - origin_us) / _HOUR_US, value, 0.0, 0.0, 0.0, us, us, value))

    def join(self, other: "Moments", shift: float = 0.0) -> None:
        """Takes in the samples of ``other``, whose origin lies ``shift`` hours later; of equal times the later one is newest."""
        if not other.n:
            return
        if not self.n:
            self.__init__(*other.values())
            self.mx += shift
            return
        n = self.n + other.n
        dx, dy, share = other.mx + shift - self.mx, other.my - self.my, self.n * other.n / n
        self.sxx, self.syy, self.sxy = self.sxx + other.sxx + dx * dx * share, self.syy + other.syy + dy * dy * share, self.sxy + other.sxy + dx * dy * share
        self.mx, self.my, self.n = self.mx + dx * other.n / n, self.my + dy * other.n / n, n
        self.first_us = min(self.first_us, other.first_us)
        if other.last_us >= self.last_us:
            self.last_us, self.last = other.last_us, other.last

    def trend(self) -> dict | None:
        """Least squares; None below two samples."""
        if self.n < 2:
            return None
        moving = self.sxx > 0
        return {
            "n": self.n, "slope_per_hour": self.sxy / self.sxx if moving else 0.0,
            "r_squared": min(1.0, self.sxy * self.sxy / (self.sxx * self.syy)) if moving and self.syy > 0 else 0.0,
            "latest": self.last, "latest_us": self.last_us, "window_start_us": self.first_us,
        }


class SlicedSignals:
    """The samples of an asset in slices of each signal's window, with the moments of every slice.

    A batch writes the slices that its samples fall into and removes those that no window reaches any more; the others
    stay as they are. With ``ttl_ms`` an entry that was not written for so long goes too, so the state of an asset that
    falls silent does not stay; that is processing time, and should not be below the longest window.
    """

    def __init__(self, handle: StatefulProcessorHandle, ttl_ms: int | None) -> None:
        self._count = handle.getValueState("events", "n bigint, clock bigint", ttl_ms)
        self._known = handle.getMapState("known", "signal string", "width bigint, low string, high string", ttl_ms)
        self._moments = handle.getMapState("moments", "signal string, slice bigint", Moments.FIELDS, ttl_ms)
        self._samples = handle.getMapState("samples", "signal string, slice bigint", "us array<bigint>, value array<double>", ttl_ms)

    def open(self) -> None:
        self.n, self.clock = tuple(self._count.get()) if self._count.exists() else (0, 0)
        self.known = {k[0]: tuple(v) for k, v in self._known.iterator()}
        self.moments = {(k[0], k[1]): Moments(*v) for k, v in self._moments.iterator()}
        self.samples: dict[tuple, tuple[list, list]] = {}
        self.touched: set[tuple] = set()
        self.seen: set[str] = set()

    @staticmethod
    def slice_us(width: int) -> int:
        return max(1, -(-width // SLICES))

    def _of(self, at: tuple) -> tuple[list, list]:
        if at not in self.samples:
            held = self._samples.getValue(at) if self._samples.containsKey(at) else ((), ())
            self.samples[at] = list(held[0]), list(held[1])
        return self.samples[at]

    def add(self, row: Row) -> None:
        self.clock = max(self.clock, row.us)
        for signal, value, unit, width in zip(row.signals, row.readings, row.units, row.widths):
            long = self.slice_us(width)
            at = (signal, row.us // long)
            times, values = self._of(at)
            times.append(row.us)
            values.append(value)
            self.moments.setdefault(at, Moments()).add(row.us, value, at[1] * long)
            _, low, high = self.known.get(signal, (width, unit, unit))
            self.known[signal] = width, min(low, unit), max(high, unit)
            self.touched.add(at)
            self.seen.add(signal)
        self.n += 1

    def window(self, signal: str, us: int, cap: int | None) -> dict | None:
        """The trend of a signal over its window that ends at ``us``, of the newest ``cap`` samples if given."""
        width = self.known[signal][0]
        long, start = self.slice_us(width), us - width
        first, last = start // long, us // long
        found = [(at, m) for at in ((signal, k) for k in range(first, last + 1)) if (m := self.moments.get(at))]
        if cap is not None:
            pairs = sorted(((t, i, v) for at, _ in found for i, (t, v) in enumerate(zip(*self._of(at))) if start <= t <= us), key=lambda p: p[0])
            return self._whole([(t, v) for t, _, v in pairs[-cap:]], first * long).trend()
        out = Moments()
        for at, m in found:
            if m.first_us >= start and m.last_us <= us:
                out.join(m, (at[1] - first) * long / _HOUR_US)
            else:
                out.join(self._whole([(t, v) for t, v in zip(*self._of(at)) if start <= t <= us], first * long))
        return out.trend()

    @staticmethod
    def _whole(pairs: list[tuple], origin_us: int) -> Moments:
        out = Moments()
        for t, v in pairs:
            out.add(t, v, origin_us)
        return out

    def close(self) -> None:
        for at in self.touched:
            self._samples.updateValue(at, self._of(at))
            self._moments.updateValue(at, self.moments[at].values())
        for signal in self.seen:
            self._known.updateValue((signal,), self.known[signal])
        for signal, k in list(self.moments):
            width = self.known[signal][0] if signal in self.known else 0
            if (k + 1) * self.slice_us(width) <= self.clock - width:
                self._moments.removeKey((signal, k))
                self._samples.removeKey((signal, k))
        self._count.update((self.n, self.clock))


class TickTrends(StatefulProcessor):
    """Trends of every signal of an asset at each of its ticks, one row a signal."""

    OUTPUT = (
        "asset_id string, seq bigint, us bigint, signal string, n bigint, slope_per_hour double, "
        "r_squared double, latest double, latest_us bigint, window_start_us bigint"
    )

    def __init__(self, every: int, cap: int | None, ttl_ms: int | None = None) -> None:
        self.every, self.cap, self.ttl_ms = every, cap, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.signals = SlicedSignals(handle, self.ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        held = self.signals
        held.open()
        for row in in_order(rows):
            held.add(row)
            if held.n % self.every == 0:
                yield from self._at(key[0], row)
        held.close()

    def _at(self, asset: str, row: Row) -> Iterator[Row]:
        for signal in self.signals.known:
            found = self.signals.window(signal, row.us, self.cap)
            if found is not None:
                yield Row(asset_id=asset, seq=row.seq, us=row.us, signal=signal, **found)

    def close(self) -> None:
        pass


class TickWindows(TickTrends):
    """One row per tick with the trends of all signals the asset has shown so far."""

    OUTPUT = (
        "asset_id string, seq bigint, us bigint, tick string, trends array<struct<signal:string,unit:string,mixed_units:boolean,"
        "n:bigint,slope_per_hour:double,r_squared:double,latest:double,latest_us:bigint,window_start_us:bigint>>"
    )
    EMPTY = {"slope_per_hour": 0.0, "r_squared": 0.0, "latest": None, "latest_us": None, "window_start_us": None}

    def _at(self, asset: str, row: Row) -> Iterator[Row]:
        if self.signals.known:
            yield Row(asset_id=asset, seq=row.seq, us=row.us, tick=row.tick, trends=[self._trend(s, row.us) for s in self.signals.known])

    def _trend(self, signal: str, us: int) -> Row:
        _, low, high = self.signals.known[signal]
        found = self.signals.window(signal, us, self.cap) or {**self.EMPTY, "n": 0}
        return Row(signal=signal, unit=high, mixed_units=low != high, **{k: found[k] for k in ("n", *self.EMPTY)})


@dataclass(frozen=True)
class Feature:
    """A number that a detector derives from the samples of an asset so far.

    ``step`` takes the state, None before the first sample, and a sample; it returns the new state and the number.
    """

    name: str
    state: str
    step: Callable[[tuple | None, Row], tuple[tuple, float]]


def _rate(state: tuple | None, sample: Row) -> tuple[tuple, float]:
    """Change since the sample before; 0 on the first and after a value of 0."""
    value = sample.component_temp_k
    return (value,), value - ((state or (0.0,))[0] or value)


SAMPLE_RATE = Feature("rate_k_per_sample", "value double", _rate)


def moving_average(alpha: float) -> Feature:
    def step(state: tuple | None, sample: Row) -> tuple[tuple, float]:
        value = sample.component_temp_k if state is None else alpha * sample.component_temp_k + (1 - alpha) * state[0]
        return (value,), value

    return Feature("ewma_k", "value double", step)


class Rated(StatefulProcessor):
    """Samples with the features of all detectors, each kept in a state of its own, in one pass."""

    def __init__(self, features: tuple[Feature, ...]) -> None:
        self.features = features

    @property
    def output(self) -> str:
        plain = "asset_id string, seq bigint, us bigint, sample_us bigint, component_temp_k double, ambient_temp_k double"
        return ", ".join([plain, *(f"{f.name} double" for f in self.features)])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.states = [handle.getValueState(f.name, f.state) for f in self.features]

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        held = [tuple(s.get()) if s.exists() else None for s in self.states]
        for row in in_order(rows):
            found = {}
            for k, feature in enumerate(self.features):
                held[k], found[feature.name] = feature.step(held[k], row)
            yield Row(asset_id=key[0], seq=row.seq, us=row.us, sample_us=row.sample_us, component_temp_k=row.component_temp_k,
                      ambient_temp_k=row.ambient_temp_k, **found)
        for state, value in zip(self.states, held):
            state.update(value)

    def close(self) -> None:
        pass


class RegionHold(StatefulProcessor):
    """Holds events without a region until no registry row can answer them any more, then looks them up."""

    OUTPUT = "asset_id string, region_id string, event string"

    def __init__(self, attempts: int, delay_us: int) -> None:
        self.waits = [k * delay_us for k in range(attempts)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getMapState("known", "us bigint, seq bigint", "region string")
        self.held = handle.getMapState("held", "us bigint, seq bigint", "events array<string>")

    def _expiry(self, us: int) -> int:
        return (us + self.waits[-1]) // 1000 + 1

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        for row in rows:
            if row.event is None:
                self.known.updateValue((row.us, row.seq), (row.region_id,))
            else:
                at = (row.us, row.seq)
                before = self.held.getValue(at)[0] if self.held.containsKey(at) else []
                self.held.updateValue(at, ([*before, row.event],))
                self.handle.registerTimer(self._expiry(row.us))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        now_ms = expiredTimerInfo.getExpiryTimeInMs()
        regions = sorted((at[0], at[1], v[0]) for at, v in self.known.iterator())
        due = sorted((at[0], at[1], v[0]) for at, v in self.held.iterator() if self._expiry(at[0]) <= now_ms)
        for us, seq, events in due:
            self.held.removeKey((us, seq))
            found = (next((r for at, _, r in reversed(regions) if at <= us + wait), None) for wait in self.waits)
            region = next((r for r in found if r is not None), None)
            if region is not None:
                for event in events:
                    yield Row(asset_id=key[0], region_id=region, event=event)
        # Older rows than the last one before anything that may still come answer no event. Held events may be ahead of
        # the watermark, and what still comes may be before them.
        horizon = min([at[0] for at, _ in self.held.iterator()] + [now_ms * 1000 - self.waits[-1]])
        old = [r for r in regions if r[0] <= horizon][:-1]
        for us, seq, _ in old:
            self.known.removeKey((us, seq))

    def close(self) -> None:
        pass
