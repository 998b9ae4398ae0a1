"""Bucketed tables that join without an exchange, and statistics from sketches that exchange no rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridstats.operators.aggregate import group_stats, with_mad
from gridstats.sources.tables import write_table


def nodes_of(plan):
    """Names of a physical plan's nodes from the root down, each with those below it."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return nodes_of(plan.initialPlan())
    below = [nodes_of(plan.children().apply(i)) for i in range(plan.children().size())]
    return plan.nodeName(), below


def names_below(tree):
    return [name for child in tree[1] for name in (child[0], *names_below(child))]


def find(tree, name):
    found = [tree] if tree[0] == name else []
    return found + [t for child in tree[1] for t in find(child, name)]


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_tables_join_without_exchange(spark, tmp_path, no_broadcast):
    points = spark.range(500).select(F.col("id").alias("rowid"), (F.col("id") * 1.5).alias("speed"), (F.col("id") % 3).alias("part"))
    links = spark.range(1500).select((F.col("id") % 600).alias("rowid"), (F.col("id") % 7).cast("string").alias("node_id"))
    write_table(points, "bucketed_points", str(tmp_path / "points"), bucket_by=["rowid"], buckets=5)
    write_table(links, "bucketed_links", str(tmp_path / "links"), bucket_by=["rowid"], buckets=5)
    write_table(links, "plain_links", str(tmp_path / "plain"))
    joined = {}
    for name in ("bucketed_links", "plain_links"):
        df = spark.table("bucketed_points").join(spark.table(name), "rowid").groupBy("node_id").agg(F.sum("speed").alias("s"))
        joined[name] = {tuple(r) for r in df.collect()}
        (join,) = find(nodes_of(df._jdf.queryExecution().executedPlan()), "SortMergeJoin")
        assert ("Exchange" in names_below(join)) == (name == "plain_links")
    assert joined["bucketed_links"] == joined["plain_links"] and len(joined["plain_links"]) == 7
    assert spark.table("bucketed_points").count() == 500
    write_table(points, "bucketed_parts", str(tmp_path / "parts"), ["part"], bucket_by=["rowid"], buckets=2)
    assert spark.table("bucketed_parts").where("part = 1").count() == 167
    for wrong in ({"bucket_by": ["rowid"]}, {"buckets": 3}):
        with pytest.raises(ValueError, match="buckets need"):
            write_table(points, "bucketed_wrong", str(tmp_path / "wrong"), **wrong)
    for name in ("bucketed_points", "bucketed_links", "plain_links", "bucketed_parts"):
        spark.sql(f"DROP TABLE {name}")


def lower_middle(values):
    return sorted(values)[(len(values) + 1) // 2 - 1]


def test_sketches_of_small_groups_are_exact(spark):
    rng = random.Random(3)
    groups = {n: [rng.choice([0.5, 1.0, rng.gauss(0, 5)]) for _ in range(n)] for n in (1, 2, 3, 4, 5, 9, 10, 77, 250, 499, 500)}
    rows = [(n, v) for n, values in groups.items() for v in [*values, None]] + [(1000, None)]
    df = spark.createDataFrame(rows, "k int, x double").repartition(6)
    found = {r["k"]: (r["x_median"], r["x_mad"]) for r in with_mad(df, ["k"], ["x"], "approx").collect()}
    assert found.pop(1000) == (None, None)
    for n, values in groups.items():
        median = lower_middle(values)
        assert found[n] == (median, lower_middle([abs(v - median) for v in values])), n


@pytest.mark.parametrize("broadcast", [True, False])
def test_sketches_are_exact_below_ten_thousand_rows(spark, monkeypatch, broadcast):
    """Groups of more than 500 rows, of more than a sketch of accuracy 10,000 ranks exactly, with medians that are broadcast or not."""
    if not broadcast:
        monkeypatch.setattr("gridstats.operators.aggregate.fits_broadcast", lambda df: False)
    rng = np.random.default_rng(11)
    groups = {n: np.round(rng.gamma(2.0, 3.0, n), 3).tolist() for n in (501, 625, 1000, 6900, 9999)}
    rows = [(n, v) for n, values in groups.items() for v in [*values, None]] + [(1, None)]
    df = spark.createDataFrame(rows, "k int, x double")
    for parts in (1, 7):
        found = {r["k"]: (r["x_median"], r["x_mad"]) for r in with_mad(df.repartition(parts), ["k"], ["x"], "approx").collect()}
        assert found.pop(1) == (None, None)
        for n, values in groups.items():
            median = lower_middle(values)
            assert found[n] == (median, lower_middle([abs(v - median) for v in values])), n


def test_sketch_of_a_large_group_is_near(spark):
    values = np.random.default_rng(5).gamma(2.0, 3.0, 60_000)
    df = spark.createDataFrame([(1, float(v)) for v in values], "k int, x double").repartition(8)
    row = group_stats(df, ["k"], ["x"], "approx").first()
    rank = (values <= row["x_median"]).mean()
    assert abs(rank - 0.5) < 0.001
    gap = (np.abs(values - row["x_median"]) <= row["x_mad"]).mean()
    assert abs(gap - 0.5) < 0.005
    assert row["n"] == 60_000 and row["x_mean"] == pytest.approx(values.mean())


def test_sketches_exchange_states_only(spark):
    df = spark.range(1000).select((F.col("id") % 5).alias("k"), F.col("id").cast("double").alias("x"))
    plan = nodes_of(group_stats(df, ["k"], ["x"], "approx")._jdf.queryExecution().executedPlan())
    exchanges = find(plan, "Exchange")
    assert len(exchanges) == 1 and any("Aggregate" in name for name in names_below(exchanges[0]))
    assert not find(plan, "Window")
