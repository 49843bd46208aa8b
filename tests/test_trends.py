import random

import pytest
from pyspark.sql import functions as F

from convoy.operators import thermal
from convoy.operators.thermal import ewma, sample_delta, thermal_runaway
from convoy.operators.trends import rolling_trend, tick_trends, trends_at, windowed_telemetry
from convoy.plans import testviews as tv

SAMPLE = "asset_id string, signal string, us long, seq long, value double"


def samples(spark, rows):
    return spark.createDataFrame(rows, SAMPLE).withColumn("ts", F.timestamp_micros("us")).drop("us")


def brute_force(rows, width, cap):
    """Two-pass least squares per sample, as a plain loop."""
    out = {}
    groups: dict = {}
    for r in sorted(rows, key=lambda r: (r[2], r[3])):
        groups.setdefault(r[:2], []).append(r)
    for group in groups.values():
        for i, now in enumerate(group):
            window = [r for r in group[max(0, i - cap + 1):i + 1] if r[2] >= now[2] - width]
            if len(window) < 2:
                continue
            xs = [(r[2] - window[0][2]) / 3.6e9 for r in window]
            ys = [r[4] for r in window]
            mx, my = sum(xs) / len(xs), sum(ys) / len(ys)
            sxx, syy = sum((x - mx) ** 2 for x in xs), sum((y - my) ** 2 for y in ys)
            sxy = sum((x - mx) * (y - my) for x, y in zip(xs, ys))
            out[now[3]] = (
                len(window), sxy / sxx if sxx else 0.0, min(1.0, sxy * sxy / (sxx * syy)) if sxx and syy else 0.0,
                ys[-1], window[0][2], window[-1][2],
            )
    return out


def evaluate(df):
    return {
        r.seq: (r.n, r.slope_per_hour, r.r_squared, r.latest, r.window_start_us, r.latest_us) for r in df.collect()
    }


@pytest.mark.parametrize("cap,hot_rows", [(4096, None), (12, None), (12, 40)])
def test_against_brute_force(spark, cap, hot_rows):
    rng = random.Random(7)
    rows, seq = [], 0
    for asset, gap in (("dense", 60), ("sparse", 2_000), ("mixed", 300)):
        for signal in ("a", "b"):
            us = 0
            for i in range(80):
                us += int(rng.expovariate(1 / gap) * 1e6) + 1
                rows.append((asset, signal, us, seq, rng.choice([5.0, 5.0, rng.uniform(-50, 50)])))
                seq += 1
    width = 1800
    found = evaluate(rolling_trend(samples(spark, rows), "1800 seconds", cap=cap, hot_rows=hot_rows))
    expected = brute_force(rows, width * 1_000_000, cap)
    assert found.keys() == expected.keys()
    for s in expected:
        assert found[s] == pytest.approx(expected[s], rel=1e-6, abs=1e-7), s


def test_edges(spark):
    minute = 60_000_000
    rows = [
        ("single", "s", 0, 1, 3.0),
        ("flat", "s", 0, 2, 4.0), ("flat", "s", minute, 3, 4.0), ("flat", "s", 2 * minute, 4, 4.0),
        ("closed", "s", 0, 5, 0.0), ("closed", "s", 15 * minute, 6, 15.0),
        ("open", "s", 0, 7, 0.0), ("open", "s", 15 * minute + 1, 8, 15.0),
        ("same time", "s", 5, 9, 1.0), ("same time", "s", 5, 10, 2.0),
    ]
    found = evaluate(rolling_trend(samples(spark, rows), "15 minutes"))
    assert set(found) == {3, 4, 6, 9, 10}
    assert found[4][:3] == (3, 0.0, 0.0)
    assert found[6][:3] == (2, pytest.approx(60.0), pytest.approx(1.0))
    assert found[10][:3] == (2, 0.0, 0.0)


def test_requests_without_samples_stay(spark):
    known = samples(spark, [("a", "s", 10, 1, 1.0)]).withColumn("width", F.lit(60_000_000))
    asked = samples(spark, [("a", "s", 600_000_000, 2, 0.0), ("b", "s", 5, 3, 0.0)]).drop("value").withColumn(
        "width", F.lit(60_000_000))
    for cap in (None, 2):
        out = {r.seq: (r.n, r.latest) for r in trends_at(known, asked, cap=cap).collect()}
        assert out == {2: (0, None), 3: (0, None)}


def test_many_requests_after_the_last_sample(spark):
    """Requests whose window is empty join no group, however many there are."""
    known = samples(spark, [("a", "s", 60_000_000 * i, i, float(i)) for i in range(40)]).withColumn("width", F.lit(600_000_000))
    asked = samples(spark, [("a", "s", 10**11 + i, 100 + i, 0.0) for i in range(500)] + [("a", "s", 60_000_000 * 39 + 1, 99, 0.0)])
    out = trends_at(known, asked.drop("value").withColumn("width", F.lit(600_000_000)), cap=16)
    counts = {r.seq: r.n for r in out.collect()}
    assert counts[99] == 10 and all(counts[100 + i] == 0 for i in range(500)) and len(counts) == 501


def test_tick_trends_with_cap(spark):
    """The cap path and the slice path agree where the cap does not bite."""
    source = tv.telemetry(spark, "/root/testdata/sf0.001")
    plain = tick_trends(source, "20 days", "25 days")
    most = plain.agg(F.max("n")).first()[0]
    capped = tick_trends(source, "20 days", "25 days", cap=most, hot_rows=30)
    columns = ("asset_id", "signal", "seq", "n", F.round("slope_per_hour", 6), "window_start_us")
    assert sorted(map(str, capped.select(*columns).collect())) == sorted(map(str, plain.select(*columns).collect()))


def test_windowed_record_without_trends(spark):
    source = tv.telemetry(spark, "/root/testdata/sf0.001")
    out = windowed_telemetry(source, "1 second", "1 second")
    assert out.count() > 0
    assert out.filter("window.sample_count > 0 or size(wear_trends) > 0").count() == 0
    assert out.filter("window.duration_us <> 0").count() == 0


def series(spark, values):
    return spark.createDataFrame(
        [(a, i, float(v)) for a, vs in values.items() for i, v in enumerate(vs)], "asset_id string, seq long, value double"
    ).withColumn("ts", F.timestamp_seconds("seq"))


@pytest.mark.parametrize("alpha,hot_rows", [(0.2, None), (0.2, 50), (0.9, 50), (0.02, None), (1.0, None), (0.001, 50)])
def test_ewma(spark, alpha, hot_rows, monkeypatch):
    monkeypatch.setattr(thermal, "EWMA_BLOCK", 165)  # a small alpha then takes several levels of blocks
    rng = random.Random(3)
    values = {"long": [rng.uniform(250, 400) for _ in range(700)], "short": [5.0, 6.0]}
    values["spike"] = [1e20 if i in (164, 300) else 1.0 for i in range(900)]
    found = {(r.asset_id, r.seq): r.ewma for r in
             ewma(series(spark, values), "value", alpha=alpha, hot_rows=hot_rows).collect()}
    for asset, vs in values.items():
        mean = vs[0]
        for i, v in enumerate(vs):
            mean = v if i == 0 else alpha * v + (1 - alpha) * mean
            assert found[(asset, i)] == pytest.approx(mean, rel=1e-11)


def test_ewma_seed(spark):
    found = ewma(series(spark, {"a": [10.0, 10.0]}), "value", seed=0.0).orderBy("seq").collect()
    assert [r.ewma for r in found] == pytest.approx([2.0, 3.6])


def test_delta_after_zero(spark):
    found = sample_delta(series(spark, {"a": [3.0, 0.0, 5.0, 6.0]}), "value").orderBy("seq").collect()
    assert [r.rate for r in found] == [0.0, -3.0, 0.0, 1.0]


def test_thermal_limits(spark):
    q = "struct<value:double,unit:string>"
    rows = [
        ("a", 1, (400.0, "K"), (300.0, "K")),      # first sample never alerts
        ("a", 2, (402.0, "K"), (300.0, "K")),      # rate exactly 2
        ("a", 3, (405.0, "K"), None),              # no ambient: leaves no trace
        ("a", 4, (405.0, "K"), (325.0, "K")),      # delta exactly 80, rate 3
        ("a", 5, (409.0, "K"), (300.0, "K")),      # alert
        ("b", 1, (100.0, "degC"), (20.0, "degC")),
        ("b", 2, (230.0, "[degF]"), (20.0, "degC")),   # 110 C: alert
    ]
    view = spark.createDataFrame(rows, f"asset_id string, seq long, component_temp {q}, ambient_temp {q}").withColumn(
        "ts", F.timestamp_seconds("seq")).withColumn("sample_time", F.col("ts"))
    found = {(r.asset_id, r.seq): r for r in thermal_runaway(view).collect()}
    assert set(found) == {("a", 5), ("b", 2)}
    assert found[("a", 5)].summary == "Component 109.0K above ambient, rising 4.00K/sample"
    assert found[("b", 2)].evidence.delta_k == pytest.approx(90.0)


@pytest.mark.parametrize("hot_rows", [7, 40])
def test_hot_slice_is_split(spark, hot_rows):
    """A signal that holds a third of all rows inside two slices, with ties: chunks merge to what one window gives."""
    dense = [("hot", "s", (i // 2) * 700_000, i, (i * 37 % 101) / 7) for i in range(300)]
    sparse = [(f"a{i % 20}", "s", i * 11_000_000, 1000 + i, i % 13 * 1.5) for i in range(600)]
    df = spark.createDataFrame(dense + sparse, "asset_id string, signal string, us long, seq long, value double").withColumn("ts", F.timestamp_micros("us"))
    names = ("asset_id", "seq", "n", "slope_per_hour", "r_squared", "latest", "latest_us", "window_start_us")

    def rows(found):
        return sorted(tuple(round(v, 5) if isinstance(v, float) else v for v in r) for r in found.select(*names).collect())

    plain = rows(rolling_trend(df, 60_000_000))
    split = rolling_trend(df, 60_000_000, hot_rows=hot_rows)
    assert rows(split) == plain
    by_hand = {}
    for asset, _, us, seq, value in dense:
        inside = [(u, s, v) for _, _, u, s, v in dense if us - 60_000_000 <= u <= us]
        by_hand[seq] = (len(inside), round(max(inside)[2], 5), min(inside)[0])
    assert {r[1]: (r[2], r[5], r[7]) for r in plain if r[0] == "hot"} == {k: v for k, v in by_hand.items() if v[0] >= 2}
