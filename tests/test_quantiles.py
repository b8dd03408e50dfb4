import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.functions.quantiles import exact_quantiles, exact_quantiles_of, with_group_median
from lotwise.functions.sketches import sketch_median, sketch_quantiles, sketched

PROBS = [0.0, 0.2, 0.5, 0.9, 0.99, 1.0]


@pytest.fixture(scope="module")
def skewed(spark):
    """A group with most rows, a heavily tied one, a null group and tiny ones."""
    rng = np.random.default_rng(5)
    rows = [("hot", float(v)) for v in rng.lognormal(12, 1, 6001)]
    rows += [("tied", 100.0)] * 2000 + [("tied", float(v)) for v in rng.integers(90, 111, 501)]
    rows += [(None, float(v)) for v in rng.normal(0, 1, 300)]
    rows += [(f"g{i % 40}", float(v)) for i, v in enumerate(rng.normal(0, 1e6, 130))]
    rows += [("one", -3.5), ("two", 1.0), ("two", 2.0), ("hot", None), ("void", None)]
    rows += [("one", float("nan"))]
    return spark.createDataFrame(rows, "g string, v double").repartition(6)


def expected(df, by):
    frame = df.toPandas()
    frame = frame[frame.v.notna()]
    if not by:
        return {(): np.quantile(frame.v, PROBS)}
    frame["g"] = frame.g.fillna("<null>")
    return {(k,): np.quantile(part.v, PROBS) for k, part in frame.groupby("g")}


@pytest.mark.parametrize("by", [(), ("g",)])
@pytest.mark.parametrize("slices", ["1", "3", "40"])
def test_groups_match_numpy_however_they_are_cut(spark, skewed, by, slices):
    for name, setting in (("shuffle.partitions", slices), ("adaptive.coalescePartitions.enabled", "false")):
        spark.conf.set(f"spark.sql.{name}", setting)
    try:
        result = exact_quantiles(skewed, "v", PROBS, by)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = expected(skewed, by)
    got = {
        tuple("<null>" if k is None else k for k in row[:-1]): row.quantiles
        for row in result.collect()
    }
    assert got.keys() == want.keys()
    for key, quantiles in got.items():
        np.testing.assert_allclose(quantiles, want[key], rtol=1e-12, err_msg=str(key))


def test_no_rows_no_quantiles(skewed):
    for empty in (skewed.limit(0), skewed.filter("g = 'void'")):
        for by in ((), ("g",)):
            found = exact_quantiles(empty, "v", [0.5], by)
            assert [row for row in found.collect() if row.quantiles is not None] == []


def test_order_of_the_probabilities_is_kept(skewed):
    row = exact_quantiles(skewed, "v", [0.9, 0.1, 0.5]).first()
    assert row.quantiles[0] > row.quantiles[2] > row.quantiles[1]


def test_exact_interpolates_and_approximate_does_not(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)], "v double")
    assert exact_quantiles(df, "v", [0.5]).first().quantiles == [2.5]
    found = sketched(df, [], {"s": F.col("v")})
    assert found.select(sketch_median("s")).first()[0] == 2.0
    assert found.select(sketch_quantiles("s", [0, 0.5, 1])).first()[0] == [1.0, 2.0, 4.0]


def test_several_columns_share_their_passes(spark, skewed):
    both = skewed.withColumn("w", -F.col("v")).withColumn("none", F.lit(None).cast("double"))
    found = exact_quantiles_of(both, ["v", "w", "none"], PROBS, ["g"])
    got = {(r.column, r.g): r.quantiles for r in found.collect()}
    alone = {(r.g): r.quantiles for r in exact_quantiles(skewed, "v", PROBS, ["g"]).collect()}
    assert got.keys() == {(c, g) for c in "vw" for g in alone}
    for g, quantiles in alone.items():
        assert got["v", g] == quantiles
        mirrored = exact_quantiles(both.filter(F.col("g").eqNullSafe(F.lit(g))), "w", PROBS).first().quantiles
        np.testing.assert_allclose(got["w", g], mirrored, rtol=1e-12)


@pytest.mark.parametrize("by", [(), ("g",)])
def test_brackets_are_narrowed_until_they_are_small(skewed, by):
    """Sketches of 512 entries round, and hardly any row may be left in a bracket."""
    found = exact_quantiles_of(skewed, ["v"], PROBS, by, size=512, bracket_rows=300)
    want = expected(skewed, by)
    got = {tuple("<null>" if k is None else k for k in row[1:-1]): row.quantiles for row in found.collect()}
    assert got.keys() == want.keys()
    for key, quantiles in got.items():
        np.testing.assert_allclose(quantiles, want[key], rtol=1e-12, err_msg=str(key))


def test_ties_alone_end_the_narrowing(spark):
    df = spark.range(4000).select((F.col("id") % 2).cast("double").alias("v"))
    found = exact_quantiles_of(df, ["v"], [0.25, 0.5, 0.75], size=64, bracket_rows=1)
    assert found.first().quantiles == [0.0, 0.5, 1.0]


def test_sketches_merge_in_two_levels(spark, capsys):
    df = spark.range(0, 60_000, 1, 12).select((F.col("id") % 7 == 0).alias("g"), (F.col("id") * 1.0).alias("v"))
    found = sketched(df, ["g"], {"s": F.col("v")}, {"n": F.lit(1).cast("long")}, size=512, salts=4)
    rows = {r.g: r for r in found.select("g", "n", sketch_median("s").alias("m"), F.length("s").alias("size")).collect()}
    assert sum(r.n for r in rows.values()) == 60_000
    for r in rows.values():
        assert abs(r.m - 30_000) / 60_000 < 4 * 2.296 / 512**0.9723 and r.size < 512 * 40
    found.explain()
    plan = capsys.readouterr().out
    # The first shuffle is by group and salt, the second by group alone.
    assert "_salt#" in plan.split("Exchange hashpartitioning(")[-1].split(")")[0]
    assert plan.count("kll_merge_agg_double") and plan.count("Exchange hashpartitioning(") == 2


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([("a", None), ("a", float("nan"))], "g string, v double")
    assert sketched(empty, ["g"], {"s": F.col("v")}).select("g", sketch_median("s").alias("m")).collect() == [("a", None)]
    assert sketched(empty.limit(0), [], {"s": F.col("v")}).select(sketch_median("s")).first()[0] is None


def test_group_median_keeps_every_row(skewed):
    result = with_group_median(skewed, "v", "g", "mid")
    assert result.columns == ["g", "v", "mid"]
    assert result.count() == skewed.count()
    assert result.filter("g is null and mid is null").count() == 0
    assert [r.mid for r in result.filter("g = 'void'").collect()] == [None]
    window = skewed.groupBy("g").agg(F.median(F.nanvl("v", F.lit(None))).alias("want"))
    joined = result.join(window.withColumnRenamed("g", "k"), F.col("g").eqNullSafe(F.col("k")))
    assert joined.filter("abs(mid - want) > 1e-9").count() == 0


def test_infinities_and_zeros(spark):
    inf = float("inf")
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("a", inf), ("a", inf), ("b", inf), ("b", inf), ("b", inf)]
        + [("c", -0.0), ("c", 0.0), ("d", -inf), ("d", -inf), ("d", 5.0)],
        "g string, v double",
    )
    found = {r.g: r.quantiles for r in exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.9], ["g"]).collect()}
    assert found == {
        "a": [1.0, 1.75, inf, inf], "b": [inf] * 4, "c": [0.0] * 4, "d": [-inf, -inf, -inf, 5.0 - inf],
    }


def test_a_group_is_never_sorted_or_collected_whole(skewed, capsys):
    exact_quantiles(skewed, "v", [0.5], ["g"]).explain()
    plan = capsys.readouterr().out
    assert "percentile(" not in plan and "SinglePartition" not in plan
    # Rows meet by group and place in the brackets; the window runs over what lies in them.
    assert "hashpartitioning(column#" in plan and "_place#" in plan and "_known#" in plan
