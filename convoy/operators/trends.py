"""Rolling linear trends over a closed time window, and the windowed-telemetry record.

A window of length W that ends at t covers the end of the previous W-slice and the start of
the slice t lies in. So every sample goes to its own slice and to the next one, running
moments grow forward over the own samples and backward over the samples of the slice before,
and the two parts are merged per row: constant work per row, whatever W holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convoy.functions.common import filled, micros, slot
from convoy.functions.quantities import present
from convoy.operators.ordered import (
    _CHUNK as CHUNK, hot_limit, largest_group, last_value, ordered_groups, running_count, running_set,
)

# Default window lengths, emission interval, and the sample cap for those who ask for one.
FLUID_WINDOW = "15 minutes"
WEAR_WINDOW = "60 minutes"
EMIT_EVERY = 5
SAMPLE_CAP = 4096

FLUID, AMMO, WEAR_HOURS, WEAR_RUL = "fluid:", "ammo:", "wear_hours:", "wear_rul:"

_HOUR_US = 3_600_000_000.0
_UNIT_US = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def interval_us(text: str | int) -> int:
    """Microseconds of ``'15 minutes'``, ``'7 days'`` and the like."""
    if isinstance(text, int):
        return text
    number, unit = text.split()
    return int(float(number) * _UNIT_US[unit.rstrip("s")])


# ---------------------------------------------------------------- signals and ticks

def event_samples(telemetry: DataFrame, *keep: Column) -> DataFrame:
    """One row per event with its samples: fuel, rounds per slot, hours and life per component."""
    def sample(name: Column, value: Column, unit: Column) -> Column:
        return F.struct(name.alias("signal"), value.alias("value"), unit.alias("unit"))

    def of(q: Column, name: Column) -> Column:
        return F.when(present(q["value"], q["unit"]), sample(name, q["value"], q["unit"]))

    fuel = F.array(of(F.col("sustainment.fluids.fuel_remaining"), F.lit(FLUID + "fuel_remaining")))
    items = F.map_entries(F.col("sustainment.consumables.items"))
    ammo = F.transform(items, lambda e: F.when(
        e["value"]["quantity_capacity"] > 0,
        sample(F.concat(F.lit(AMMO), e["key"]), e["value"]["quantity_remaining"], F.lit("count")),
    ))
    parts = F.map_entries(F.col("sustainment.wear.components"))
    hours = F.transform(parts, lambda e: of(e["value"]["hours_in_service"], F.concat(F.lit(WEAR_HOURS), e["key"])))
    rul = F.transform(parts, lambda e: of(e["value"]["remaining_useful_life"], F.concat(F.lit(WEAR_RUL), e["key"])))
    none = F.array().cast("array<struct<signal:string,value:double,unit:string>>")
    found = F.concat(*[F.coalesce(part, none) for part in (fuel, ammo, hours, rul)])
    return telemetry.filter(filled(F.col("asset.asset_id"))).select(
        F.col("asset.asset_id").alias("asset_id"), "ts", "seq", *keep,
        F.filter(found, lambda s: s.isNotNull()).alias("found"),
    )


def signals(telemetry: DataFrame) -> DataFrame:
    """One row per event and signal."""
    rows = event_samples(telemetry)
    return rows.select("asset_id", "ts", "seq", F.explode("found").alias("s")).select("asset_id", "ts", "seq", "s.*")


def emit_ticks(events: DataFrame, every: int = EMIT_EVERY, key: str = "asset_id",
               hot_rows: int | None = None, bound: int | None = None) -> DataFrame:
    """Every ``every``-th event of an asset, with its running number."""
    counted = ordered_groups(events, key, ["ts", "seq"], hot_rows, bound).with_running(n_events=running_count())
    return counted.result().filter(F.col("n_events") % every == 0)


# ---------------------------------------------------------------- trends

def rolling_trend(samples: DataFrame, window, keys=("asset_id", "signal"), cap: int | None = None,
                  hot_rows: int | None = None, bound: int | None = None) -> DataFrame:
    """Trend at each sample over [ts - window, ts]; rows with fewer than two samples are dropped.

    With ``cap`` only the newest ``cap`` samples of a window count.
    """
    rows = samples.withColumns({
        "_us": micros(F.col("ts")), "_wanted": F.lit(True), "_width": F.lit(interval_us(window)),
    })
    return _trends(rows, list(keys), cap, hot_rows, bound).filter(F.col("n") >= 2)


def trends_at(samples: DataFrame, requests: DataFrame, keys=("asset_id", "signal"), cap: int | None = None,
              hot_rows: int | None = None, bound: int | None = None) -> DataFrame:
    """Trend at each requested (keys, ts, seq); requests without samples keep n = 0.

    Both sides carry the window of their signal as ``width`` in microseconds.
    """
    columns = [*keys, "ts", "seq", F.col("width").alias("_width")]
    rows = (
        samples.select(*columns, F.col("value").cast("double").alias("value"), F.lit(False).alias("_wanted"))
        .unionByName(requests.select(*columns, F.lit(None).cast("double").alias("value"),
                                     F.lit(True).alias("_wanted")))
        .withColumn("_us", micros(F.col("ts")))
    )
    return _trends(rows, list(keys), cap, hot_rows, bound).drop("value")


def _trends(rows: DataFrame, keys: list[str], cap: int | None, hot_rows: int | None, bound: int | None,
            deal: bool = True) -> DataFrame:
    found = _timed(rows, keys, hot_rows, bound, deal) if cap is None else _capped(rows, keys, cap, hot_rows, bound, deal)
    return _finish(found)


def _moments(x: Column, y: Column, at: Column, order: Column, over=lambda aggregate: aggregate) -> Column:
    """Count, means and centred second moments of a group or, with ``over``, of a window; with the newest sample."""
    n = over(F.count(y))
    return F.struct(
        n.alias("n"),
        over(F.avg(x)).alias("mx"),
        over(F.avg(y)).alias("my"),
        (over(F.var_pop(x)) * n).alias("sxx"),
        (over(F.var_pop(y)) * n).alias("syy"),
        (over(F.covar_pop(x, y)) * n).alias("sxy"),
        over(F.min(at)).alias("first_us"),
        over(F.max(F.when(y.isNotNull(), F.struct(at.alias("us"), order.alias("seq"), y.alias("value"))))).alias("latest"),
    )


def _merge(a: Column, b: Column) -> Column:
    """Moments of two sets of samples together; null stands for none."""
    zero = F.lit(0.0)

    def of(part: Column, field: str) -> Column:
        return F.coalesce(part[field], zero)

    na, nb = F.coalesce(a["n"], F.lit(0)), F.coalesce(b["n"], F.lit(0))
    share = F.when((na == 0) | (nb == 0), zero).otherwise(na * nb / (na + nb))
    dx, dy = of(a, "mx") - of(b, "mx"), of(a, "my") - of(b, "my")

    def mean(field: str) -> Column:
        return F.when(na == 0, b[field]).when(nb == 0, a[field]).otherwise((na * a[field] + nb * b[field]) / (na + nb))

    return F.struct(
        (na + nb).cast("long").alias("n"), mean("mx").alias("mx"), mean("my").alias("my"),
        (of(a, "sxx") + of(b, "sxx") + dx * dx * share).alias("sxx"),
        (of(a, "syy") + of(b, "syy") + dy * dy * share).alias("syy"),
        (of(a, "sxy") + of(b, "sxy") + dx * dy * share).alias("sxy"),
        F.least(a["first_us"], b["first_us"]).alias("first_us"),
        F.greatest(a["latest"], b["latest"]).alias("latest"),
    )


def _timed(rows: DataFrame, keys: list[str], hot_rows: int | None = None, bound: int | None = None,
           deal: bool = True) -> DataFrame:
    """Moments over [time - width, time]; slices above ``hot_rows`` rows are split."""
    origin = F.col("_slice") * F.col("_width")
    most = rows.count() if bound is None else bound
    return _windowed(rows, keys, F.col("_us"), F.col("_width"), origin, hot_rows, most, deal)


def _capped(rows: DataFrame, keys: list[str], cap: int, hot_rows: int | None, bound: int | None,
            deal: bool = True) -> DataFrame:
    """Moments of the newest ``cap`` samples of the time window.

    The newest ``cap`` samples are a window over the sample number, so the same pass gives them.
    The time window is taken inside blocks of ``cap`` samples that carry the block before: it is
    complete there whenever it holds no more than the cap, and no group holds more than twice the
    cap of samples. Requests whose newest sample is older than the window need no block.
    """
    sample = F.col("value").isNotNull()
    numbered = ordered_groups(rows, keys, [F.col("_us"), F.desc(sample), F.col("seq")], hot_rows, bound, deal)
    known = numbered.with_running(_idx=running_count(sample), _newest=last_value(F.when(sample, F.col("_us")))).result()
    stale = ~sample & (F.coalesce("_newest", F.col("_us") - F.col("_width") - 1) < F.col("_us") - F.col("_width"))
    fresh = known.filter(~stale).drop("_newest")
    counted = _windowed(
        fresh, keys, F.col("_idx"), F.lit(max(cap - 1, 1)),
        F.min("_us").over(Window.partitionBy(*keys, "_slice")),
    ).withColumnRenamed("_m", "_counted")
    blocks = (
        counted.withColumn("_block_home", slot(F.col("_idx") - 1, cap))
        .withColumn("_block", F.explode(
            F.when(sample, F.array(F.col("_block_home"), F.col("_block_home") + 1)).otherwise(F.array("_block_home"))
        ))
    )
    found = (
        _timed(blocks, [*keys, "_block"], bound=4 * cap, deal=False)
        .filter(F.col("_block") == F.col("_block_home"))
        .withColumn("_m", F.when(F.col("_m.n") <= cap, F.col("_m")).otherwise(F.col("_counted")))
        .drop("_idx", "_counted", "_block", "_block_home")
    )
    return found.unionByName(known.filter(stale).drop("_idx", "_newest"), allowMissingColumns=True)


def _windowed(rows: DataFrame, keys: list[str], at: Column, width: Column, origin: Column, hot_rows: int | None = None,
              bound: int = 0, deal: bool = True) -> DataFrame:
    """Adds the moments of the samples whose coordinate lies in [at - width, at].

    Times are taken relative to ``origin``, one value per slice. A slice above ``hot_rows`` rows is cut into chunks of
    neighbouring times: a row's window then holds the chunks before it from its own slice, the chunks after it from the
    slice before, and parts of its own chunk, and whole chunks are one merged entry each. ``bound`` is the number of
    rows that no slice has more of. Without ``deal`` the rows stay in the tasks that an earlier step dealt them out to.
    """
    copies = (
        rows.withColumns({"_at": at, "_home": slot(at, width)})
        .withColumn("_slice", F.explode(
            F.when(F.col("value").isNotNull(), F.array(F.col("_home"), F.col("_home") + 1))
            .otherwise(F.array("_home"))
        ))
        .withColumn("_own", F.col("_slice") == F.col("_home"))
        .withColumn("_t", F.when(F.col("_own"), F.col("_at")).otherwise(F.col("_at") + width))
    )
    slices = [*keys, "_slice"]
    # Equal times stay in one chunk, as the time alone orders the rows here.
    groups = ordered_groups(copies, slices, ["_t"], hot_rows, 2 * bound, deal)
    parts = [*slices, CHUNK] if groups.split else slices
    group = Window.partitionBy(*parts)
    forward = group.orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    backward = group.orderBy(F.desc("_at")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    lookup = (
        group.orderBy(F.desc("_t"), F.asc("_own"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    sample = F.col("value").isNotNull()
    hours = (F.col("_us") - F.col("_origin")) / _HOUR_US

    def part(flag: Column, over=lambda aggregate: aggregate) -> Column:
        mine = flag & sample
        return _moments(F.when(mine, hours), F.when(mine, F.col("value")), F.when(mine, F.col("_us")), F.col("seq"), over)

    placed = groups.df.withColumn("_origin", origin)
    found = (
        placed.withColumn("_head", part(F.col("_own"), lambda a: a.over(forward)))
        .withColumn("_tail", part(~F.col("_own"), lambda a: a.over(backward)))
        .withColumn("_tail", F.last(F.when(~F.col("_own"), F.col("_tail")), ignorenulls=True).over(lookup))
        .filter("_own")
    )
    if groups.split:
        carried = _carried(placed.groupBy(*parts).agg(part(F.col("_own")).alias("_old"), part(~F.col("_own")).alias("_next")), slices)
        found = found.join(carried, parts, "left").withColumns({
            "_head": _merge(F.col("_before"), F.col("_head")), "_tail": _merge(F.col("_tail"), F.col("_after")),
        }).drop("_before", "_after")
    return found.withColumn("_m", _merge(F.col("_head"), F.col("_tail"))).drop(
        "_at", "_home", "_slice", "_own", "_t", "_origin", "_head", "_tail", CHUNK, "_chunk_rank")


def _carried(chunks: DataFrame, slices: list[str]) -> DataFrame:
    """For each chunk of a slice: the own samples of the chunks before it, and the copied ones of those after it."""
    order = Window.partitionBy(*slices).orderBy(CHUNK)
    kind = chunks.schema["_old"].dataType.simpleString()

    def merged(name: str, window) -> Column:
        # One entry a chunk: as many as the slice is larger than the limit.
        return F.aggregate(F.collect_list(name).over(window), F.lit(None).cast(kind), _merge)

    return chunks.filter(F.col(CHUNK) > 0).select(
        *slices, CHUNK, merged("_old", order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        merged("_next", order.rowsBetween(1, Window.unboundedFollowing)).alias("_after"))


def _finish(df: DataFrame) -> DataFrame:
    m = F.col("_m")
    moving = m["sxx"] > 0
    return df.filter("_wanted").withColumns({
        "n": F.coalesce(m["n"], F.lit(0)).cast("long"),
        "slope_per_hour": F.when(moving, m["sxy"] / m["sxx"]).otherwise(0.0),
        "r_squared": F.when(
            moving & (m["syy"] > 0), F.least(F.lit(1.0), m["sxy"] * m["sxy"] / (m["sxx"] * m["syy"]))
        ).otherwise(0.0),
        "latest": m["latest"]["value"],
        "latest_us": m["latest"]["us"],
        "window_start_us": m["first_us"],
        "window_end_us": F.col("_us"),
    }).drop("_m", "_us", "_wanted", "_width")


# ---------------------------------------------------------------- windowed telemetry

def _tick_samples(telemetry: DataFrame, fluid_window, wear_window, every: int, hot_rows: int | None, bound: int | None,
                  *keep: Column) -> tuple[DataFrame, bool]:
    """Samples, and a request at each tick for every signal the asset has shown so far.

    Events are numbered once; what a tick asks for and the columns ``keep`` of its event travel with it. Requests carry
    the unit of their signal and whether it has had several. An event that came twice and is a tick both times counts once.
    Also whether the events of an asset were split; otherwise all its rows are in one task, one of a number that grows with
    the events, and stay there.
    """
    fluid_us, wear_us = interval_us(fluid_window), interval_us(wear_window)
    names = [c for c in telemetry.select(*keep).columns]
    at, tick = F.struct("ts", "seq"), F.col("n_events") % every == 0
    pairs = F.transform("found", lambda s: F.struct(s["signal"].alias("signal"), s["unit"].alias("unit")))
    groups = ordered_groups(event_samples(telemetry, *keep), "asset_id", ["ts", "seq"], hot_rows, bound)
    numbered = groups.with_running(n_events=running_count(), _seen=running_set(pairs)).with_running(
        _last=last_value(F.when(tick, at), inclusive=False)).result()

    def request(signal: Column) -> Column:
        units = F.transform(F.filter("_seen", lambda p: p["signal"] == signal), lambda p: p["unit"])
        return F.struct(
            signal.alias("signal"), F.lit(None).cast("double").alias("value"), F.lit(True).alias("_wanted"),
            F.array_max(units).alias("unit"), (F.array_min(units) != F.array_max(units)).alias("mixed_units"))

    samples = F.transform("found", lambda s: F.struct(
        s["signal"].alias("signal"), s["value"].cast("double").alias("value"), F.lit(False).alias("_wanted"),
        s["unit"].alias("unit"), F.lit(False).alias("mixed_units")))
    signals_seen = F.array_distinct(F.transform("_seen", lambda p: p["signal"]))
    asks = tick & ~F.coalesce(F.col("_last") == at, F.lit(False))
    requests = F.when(asks, F.transform(signals_seen, request))
    rows = numbered.select("asset_id", "ts", "seq", *names, F.explode(F.concat(samples, F.coalesce(requests, F.filter(samples, lambda _: F.lit(False))))).alias("e"))
    return rows.select(
        "asset_id", "ts", "seq", "e.*", *[F.when(F.col("e._wanted"), F.col(n)).alias(n) for n in names],
        F.when(F.col("e.signal").startswith("wear_"), wear_us).otherwise(fluid_us).cast("long").alias("_width"), micros(F.col("ts")).alias("_us")), groups.split


def tick_trends(telemetry: DataFrame, fluid_window=FLUID_WINDOW, wear_window=WEAR_WINDOW,
                every: int = EMIT_EVERY, cap: int | None = None, hot_rows: int | None = None, bound: int | None = None,
                keep: tuple[Column, ...] = ()) -> DataFrame:
    """Every known signal of an asset evaluated at each of the asset's ticks, with ``keep`` of the tick's event."""
    rows, split = _tick_samples(telemetry, fluid_window, wear_window, every, hot_rows, bound, *keep)
    # A signal has a sample and a request in an event at most.
    twice = None if bound is None else 2 * bound
    if not split and (twice is None or 2 * twice > hot_limit(telemetry.sparkSession, hot_rows)):
        # The events of the largest asset are counted from the ids; counting slices would number all events again.
        asset = F.col("asset.asset_id")
        twice = 2 * largest_group(telemetry.filter(filled(asset)), asset)
    return _trends(rows, ["asset_id", "signal"], cap, hot_rows, twice, deal=split).drop("value")


def scalar_trend(unit: Column) -> Column:
    """The trend record of a row of ``trends_at``; null below two samples."""
    return _trend_record(*[F.col(c) for c in ("n", "latest", "slope_per_hour", "r_squared", "latest_us")], unit)


def _trend_record(n: Column, latest: Column, slope: Column, r_squared: Column, latest_us: Column, unit: Column) -> Column:
    return F.when(n >= 2, F.struct(
        F.struct(latest.alias("value"), unit.alias("unit")).alias("latest"),
        F.struct(slope.alias("value"), F.concat(unit, F.lit("/h")).alias("unit")).alias("slope"),
        r_squared.alias("r_squared"),
        F.timestamp_micros(latest_us).alias("latest_sample_at"),
    ))


def pair_wear_trends(trends: DataFrame) -> DataFrame:
    """Hours and remaining life of a component side by side; both signals must exist."""
    hours = F.col("signal").startswith(WEAR_HOURS)
    trend = scalar_trend(F.col("unit"))
    return (
        trends.filter(F.col("signal").startswith("wear_"))
        .withColumn("component_key", F.split("signal", ":", 2)[1])
        .groupBy("asset_id", "ts", "seq", "component_key")
        .agg(
            F.count_if(hours).alias("_h"), F.count_if(~hours).alias("_r"),
            F.max(F.when(hours, trend)).alias("hours_in_service"),
            F.max(F.when(~hours, trend)).alias("remaining_useful_life"),
        )
        .filter((F.col("_h") > 0) & (F.col("_r") > 0)
                & F.coalesce("hours_in_service", "remaining_useful_life").isNotNull())
        .drop("_h", "_r")
    )


def _consumable(items: Column, slot_key: Column, remaining: Column) -> Column:
    """A rounds trend with the capacity and stock number that the tick's event states."""
    item = F.try_element_at(items, slot_key)
    return F.struct(slot_key.alias("slot_key"), remaining.alias("remaining"),
                    item["quantity_capacity"].alias("capacity"), item["nsn"].alias("nsn"))


def enrich_consumables(trends: DataFrame, ticks: DataFrame) -> DataFrame:
    """Rounds trend per slot, enriched from the events of the ticks (asset_id, ts, seq, items)."""
    return (
        trends.filter(F.col("signal").startswith(AMMO) & (F.col("n") >= 2))
        .select("asset_id", "ts", "seq", F.split("signal", ":", 2)[1].alias("slot_key"),
                scalar_trend(F.col("unit")).alias("remaining"))
        .join(ticks.select("asset_id", "ts", "seq", "items"), ["asset_id", "ts", "seq"])
        .select("asset_id", "ts", "seq", _consumable(F.col("items"), F.col("slot_key"), F.col("remaining")).alias("c"))
        .select("asset_id", "ts", "seq", "c.*")
    )


def windowed_telemetry(telemetry: DataFrame, fluid_window=FLUID_WINDOW, wear_window=WEAR_WINDOW,
                       every: int = EMIT_EVERY, cap: int | None = None,
                       edge_id: str = "edge-01", region_id: str = "region-01",
                       producer_id: str = "edge-windows", hot_rows: int | None = None, bound: int | None = None) -> DataFrame:
    """One record per tick: fluid map, rounds and wear arrays, fault codes, window spec.

    Sample count and window start come from the fluid trends alone. ``mixed_units`` names the
    signals whose samples state more than one unit, so that their trends can be told apart.
    """
    trends = tick_trends(telemetry, fluid_window, wear_window, every, cap, hot_rows, bound, (F.struct(*tick_fields()).alias("_tick"),))
    trend = scalar_trend(F.col("unit"))
    name = F.split("signal", ":", 2)[1]
    fluid = F.col("signal").startswith(FLUID) & (F.col("n") >= 2)
    # One entry per signal of the asset, so the lists below stay as short as that vocabulary.
    per_tick = trends.groupBy("asset_id", "ts", "seq").agg(
        F.collect_list(F.when(fluid, F.struct(name.alias("key"), trend.alias("value")))).alias("fluid"),
        F.collect_list(F.when(F.col("signal").startswith(AMMO) & (F.col("n") >= 2),
                              F.struct(name.alias("slot_key"), trend.alias("remaining")))).alias("ammo"),
        F.collect_list(F.when(F.col("signal").startswith(WEAR_HOURS),
                              F.struct(name.alias("component_key"), trend.alias("trend")))).alias("hours"),
        F.collect_list(F.when(F.col("signal").startswith(WEAR_RUL),
                              F.struct(name.alias("component_key"), trend.alias("trend")))).alias("rul"),
        F.sum(F.when(fluid, F.col("n")).otherwise(0)).alias("sample_count"),
        F.min(F.when(fluid, F.col("window_start_us"))).alias("start_us"),
        F.array_sort(F.collect_set(F.when(F.col("mixed_units"), F.col("signal")))).alias("mixed_units"),
        F.first("_tick").alias("_tick"),
    )
    return window_records(per_tick.select("*", "_tick.*").drop("_tick"), edge_id, region_id, producer_id)


def tick_fields() -> list[Column]:
    """What a record takes from the event of its tick."""
    return [
        F.coalesce("asset.platform_variant", F.lit("")).alias("platform_variant"),
        micros(F.col("provenance.sample_time")).alias("sample_us"),
        F.col("sustainment.consumables.items").alias("items"),
        F.col("sustainment.health.active_fault_codes").alias("faults"),
    ]


def gathered_trends(ticks: DataFrame) -> DataFrame:
    """Ticks that hold their trends as an array, with the lists that ``window_records`` reads."""
    def of(prefix: str, least: int) -> Column:
        return F.filter("trends", lambda t: t["signal"].startswith(prefix) & (t["n"] >= least))

    def listed(found: Column, key: str, value: str) -> Column:
        return F.transform(found, lambda t: F.struct(F.split(t["signal"], ":", 2)[1].alias(key), _trend_record(
            t["n"], t["latest"], t["slope_per_hour"], t["r_squared"], t["latest_us"], t["unit"]).alias(value)))

    fluid = of(FLUID, 2)
    return ticks.withColumns({
        "fluid": listed(fluid, "key", "value"), "ammo": listed(of(AMMO, 2), "slot_key", "remaining"),
        "hours": listed(of(WEAR_HOURS, 0), "component_key", "trend"), "rul": listed(of(WEAR_RUL, 0), "component_key", "trend"),
        "sample_count": F.aggregate(fluid, F.lit(0).cast("long"), lambda n, t: n + t["n"]),
        "start_us": F.array_min(F.transform(fluid, lambda t: t["window_start_us"])),
        "mixed_units": F.array_sort(F.transform(F.filter("trends", lambda t: t["mixed_units"]), lambda t: t["signal"])),
    }).drop("trends")


def window_records(per_tick: DataFrame, edge_id: str, region_id: str, producer_id: str) -> DataFrame:
    """The records of ticks with lists of trends by kind and the fields of the tick's event."""
    def slot(a: Column) -> Column:
        return _consumable(F.col("items"), a["slot_key"], a["remaining"])

    def component(h: Column) -> Column:
        match = F.get(F.filter("rul", lambda r: r["component_key"] == h["component_key"]), F.lit(0))
        return F.when(match.isNotNull(), F.struct(
            h["component_key"].alias("component_key"), h["trend"].alias("hours_in_service"),
            match["trend"].alias("remaining_useful_life"),
        ))

    def useful(w: Column) -> Column:
        return F.coalesce(w["hours_in_service"], w["remaining_useful_life"]).isNotNull()

    end_us = micros(F.col("ts"))
    start_us = F.coalesce("start_us", end_us)
    return per_tick.select(
        "asset_id", "seq", "platform_variant", F.col("ts").alias("computed_at"),
        F.struct(
            F.lit(producer_id).alias("producer_id"), F.timestamp_micros("sample_us").alias("sample_time"), F.col("ts").alias("ingest_time"),
            F.lit("U").alias("classification"), F.lit(edge_id).alias("edge_id"), F.lit(region_id).alias("region_id"),
        ).alias("provenance"),
        F.map_from_entries("fluid").alias("fluid_trends"),
        F.transform("ammo", slot).alias("consumable_trends"),
        F.filter(F.transform("hours", component), useful).alias("wear_trends"),
        F.coalesce("faults", F.array().cast("array<string>")).alias("active_fault_codes_latest"),
        F.struct(
            F.timestamp_micros(start_us).alias("window_start"), F.timestamp_micros(end_us).alias("window_end"),
            F.greatest(F.lit(0), end_us - start_us).alias("duration_us"), F.col("sample_count"),
        ).alias("window"),
        "mixed_units",
    )
