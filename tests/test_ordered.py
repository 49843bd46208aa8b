from pyspark.sql import functions as F

from convoy.operators.ordered import (
    first_value, last_value, ordered_groups, previous_row, running_count, running_max, running_sum,
)


def _rows(spark):
    hot = [("a", i, float(i % 7) if i % 3 else None) for i in range(200)]
    cold = [(f"c{i % 5}", i, float(i)) for i in range(40)]
    return spark.createDataFrame(hot + cold, "k string, t int, v double").repartition(5)


def _evaluate(spark, order, hot_rows):
    groups = ordered_groups(_rows(spark), "k", order, hot_rows=hot_rows)
    out = groups.with_running(
        s=running_sum("v"), n=running_count(), m=running_max("v"), f=first_value("v"),
        l=last_value("v", inclusive=False), p=previous_row(t=F.col("t"), v=F.col("v")),
    ).with_columns(d=F.coalesce(F.col("v") - F.col("p.v"), F.lit(0.0)))
    out = out.with_running(ds=running_sum("d"))
    return groups.split, sorted(map(str, out.result().collect()))


def test_hot_groups_give_the_same_rows(spark):
    for order in (["t"], [F.col("t").desc()]):
        split, chunked = _evaluate(spark, order, 20)
        assert split
        plain_split, plain = _evaluate(spark, order, None)
        assert not plain_split
        assert chunked == plain


def test_hot_plan_broadcasts_only_carried_values(spark):
    groups = ordered_groups(_rows(spark), "k", ["t"], hot_rows=20)
    chunk_sizes = groups.df.filter("_chunk > 0").groupBy("k", "_chunk").count().collect()
    assert {r["k"] for r in chunk_sizes} == {"a"}
    assert max(r["count"] for r in chunk_sizes) < 60


def test_packed_parquet_is_split(spark, tmp_path):
    """Rows are counted: a table whose file has far fewer bytes than rows is split all the same."""
    path = str(tmp_path / "packed")
    spark.range(200_000).select(F.lit("hot").alias("k"), F.lit(0).alias("t"), F.lit(1.0).alias("v")).coalesce(1).write.parquet(path)
    groups = ordered_groups(spark.read.parquet(path), "k", ["t"], hot_rows=50_000)
    assert groups.split
    total = groups.with_running(n=running_count(), s=running_sum("v")).result().agg(F.max("n"), F.max("s"), F.count_distinct("n")).first()
    assert tuple(total) == (200_000, 200_000.0, 200_000)


def test_split_plan_shares_one_exchange(spark):
    groups = ordered_groups(_rows(spark), "k", ["t"], hot_rows=20).with_running(p=previous_row(t=F.col("t"))).with_running(n=running_count())
    plan = groups.result()._jdf.queryExecution().optimizedPlan().toString()
    assert "ResolvedHint" not in plan and "broadcast" not in plan.lower()
