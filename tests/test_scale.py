"""Operators that split what is large or hot, against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dispatchlake.functions import variants
from dispatchlake.operators import intervals, quantiles, sectors


def test_as_of_with_a_key_that_has_half_of_the_rows(spark):
    rng = random.Random(2)
    key = lambda: "hot" if rng.random() < 0.5 else rng.choice([None, *"abcdefgh"])
    states = list({(k, at): (k, at, f"{k}{at}") for k, at in ((key(), rng.randrange(4000)) for _ in range(600))}.values())
    points = [(key(), rng.choice([None, *range(4000)]) if rng.random() < 0.02 else rng.randrange(4000), i) for i in range(6000)]
    s = spark.createDataFrame(states, "k string, since int, state string")
    p = spark.createDataFrame(points, "k string, at int, n int")
    newest = {}
    for k, at, n in points:
        held = [(a, v) for kk, a, v in states if kk == k and k is not None and at is not None and a <= at]
        newest[n] = max(held)[1] if held else None
    want = sorted((n, newest[n]) for _, _, n in points if points[n][0] is not None and points[n][1] is not None)
    for slices in (64, 7):
        got = intervals.as_of_sliced(p, s, "k", "at", "since", ["state"], slices).collect()
        assert len(got) == len(points) and sorted((r["n"], r["state"]) for r in got if r["k"] is not None and r["at"] is not None) == want
    rows = intervals.time_slices(intervals._union(p, s, "k", "at", "since", ["state"]), "k")
    parts = Counter((r["k"], r["_slice"]) for r in rows.select("k", "_slice").collect())
    total = sum(parts.values())
    assert sum(n for (k, _), n in parts.items() if k == "hot") > 0.45 * total and max(parts.values()) < total / 10
    # the same as the plain form, and no states at all
    plain = sorted(map(tuple, intervals.as_of(p, s, "k", "at", "since", ["state"]).collect()), key=str)
    assert sorted(map(tuple, intervals.as_of_sliced(p, s, "k", "at", "since", ["state"], 5, 3).collect()), key=str) == plain
    assert {r["state"] for r in intervals.as_of_sliced(p, s.filter("false"), "k", "at", "since", ["state"]).collect()} == {None}


def test_as_of_where_times_are_equal(spark):
    points = [("h", 5, i) for i in range(50)] + [("h", 4, 99)]
    p, s = spark.createDataFrame(points, "k string, at int, n int"), spark.createDataFrame([("h", 5, "x"), ("h", 1, "w")], "k string, since int, state string")
    got = {r["n"]: r["state"] for r in intervals.as_of_sliced(p, s, "k", "at", "since", ["state"], 8, 1000).collect()}
    assert got == {**dict.fromkeys(range(50), "x"), 99: "w"}


@pytest.mark.parametrize("buckets", [200])
def test_exact_quantiles(spark, buckets):
    rng = random.Random(buckets)
    rows = [("many", rng.gauss(0, 1)) for _ in range(3000)] + [("few", float(rng.randrange(3))) for _ in range(500)] + [("one", 7.5), ("nulls", None), (None, 1.0), (None, None), (None, 4.0)]
    rows += [("far", rng.choice([-1, 1]) * 10.0 ** rng.uniform(-4, 4)) for _ in range(400)] + [("equal", 3.0)] * 50
    at = {"low": 0.0, "p10": 0.1, "median": 0.5, "p99": 0.99, "high": 1.0}
    got = {r["g"]: r for r in quantiles.exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", at, buckets).collect()}
    assert set(got) == {g for g, _ in rows}
    for g, r in got.items():
        values = [v for k, v in rows if k == g and v is not None]
        for name, p in at.items():
            assert (r[name] is None) if not values else np.isclose(r[name], np.quantile(values, p), rtol=1e-12, atol=0), (g, name)
    whole = quantiles.exact_quantiles(spark.createDataFrame(rows, "g string, v double"), [], "v", {"m": 0.5}, buckets).first()["m"]
    assert np.isclose(whole, np.quantile([v for _, v in rows if v is not None], 0.5))
    assert quantiles.exact_quantiles(spark.createDataFrame([], "g string, v double"), ["g"], "v", at).collect() == []
    with pytest.raises(ValueError):
        quantiles.exact_quantiles(spark.createDataFrame([], "g string, v double"), ["g"], "v", {"x": 1.5})


def plain(x, y, corners):
    n = 0
    for (x1, y1), (x2, y2) in zip(corners, corners[1:] + corners[:1], strict=True):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            n += 1
    return n % 2 == 1


@pytest.mark.parametrize("side", [1.0, 3.7])
def test_several_hundred_sectors(spark, side):
    rng = random.Random(int(side))
    polygons = []
    for i in range(200):  # stars, so concave ones too; some with corners on the grid
        cx, cy, n = rng.uniform(-40, 40), rng.uniform(-40, 40), rng.randrange(3, 9)
        ring = [(rng.uniform(1, 9), 2 * np.pi * (k + rng.random() / 2) / n) for k in range(n)]
        corners = [(float(cx + r * np.cos(a)), float(cy + r * np.sin(a))) for r, a in ring]
        polygons.append((i, [(float(round(x)), float(round(y))) for x, y in corners] if i % 3 == 0 else corners))
    points = [(k, float(rng.uniform(-55, 55)), float(rng.uniform(-55, 55))) for k in range(1500)] + [(2000 + k, float(rng.randrange(-50, 50)), float(rng.randrange(-50, 50))) for k in range(500)]
    df = spark.createDataFrame([(i, [{"x": x, "y": y} for x, y in c]) for i, c in polygons], "id int, corners array<struct<x: double, y: double>>")
    covered = sectors.cover(df, "id", "corners", side).persist()
    got = sorted((r["k"], r["sector"]) for r in sectors.located(spark.createDataFrame(points, "k int, x double, y double"), "x", "y", covered, side).collect())
    assert got == sorted((k, i) for k, x, y in points for i, c in polygons if plain(x, y, c))
    sums = Counter(), Counter()
    for k, i in got:
        sums[0][i] += 1
        sums[1][i] += k
    place = spark.createDataFrame(points, "k int, x double, y double")
    for most in (8192, 3):  # whole cells, and cells dealt into parts
        summed = sectors.totals(place, "x", "y", "k", covered, side, most).collect()
        assert sorted(map(tuple, summed)) == sorted((i, n, sums[1][i]) for i, n in sums[0].items())
    if side == 1.0:
        assert covered.filter("edges is null").count() > covered.filter("edges is not null").count() / 4


def test_sums_by_sector_make_no_pairs(spark, tmp_path):
    """Forty sectors over the same four thousand places: no step has a row for each pair, and no cover is broadcast."""
    square = [{"x": x, "y": y} for x, y in ((0.5, 0.5), (9.5, 0.5), (9.5, 9.5), (0.5, 9.5))]
    df = spark.createDataFrame([(i, square) for i in range(40)], "id int, corners array<struct<x: double, y: double>>")
    spark.range(4000).selectExpr("id AS k", "(id % 63) / 63D * 10 AS x", "(id % 97) / 97D * 10 AS y").write.parquet(f"{tmp_path}/p")
    totals = sectors.totals(spark.read.parquet(f"{tmp_path}/p"), "x", "y", "k", sectors.cover(df, "id", "corners", 10.0), 10.0)
    rows = totals.collect()
    want = [k for k in range(4000) if plain((k % 63) / 63 * 10, (k % 97) / 97 * 10, [(c["x"], c["y"]) for c in square])]
    assert {(r["n"], r["total"]) for r in rows} == {(len(want), sum(want))} and len(rows) == 40
    plan = totals._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroup" in plan and "strategy=merge" in plan
    with pytest.raises(Exception, match="(?i)overflow"):
        big = spark.createDataFrame([(2**62, 1.0 + i / 9, 1.0) for i in range(3)], "k long, x double, y double")
        sectors.totals(big, "x", "y", "k", sectors.cover(df, "id", "corners", 10.0), 10.0).collect()


def test_variants(spark):
    texts = ['{"a": [1, "1", null, 2.5], "b": {"c": true}, "d": null, "e": "x"}', "[]", "7", "null", '"t"', "{bad", None, '{"a": 1}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("doc", variants.parsed(F.col("t")))
    d = F.col("doc")
    kinds = [r[0] for r in df.orderBy("i").select(variants.type_of(d)).collect()]
    assert kinds == ["object", "array", "number", "null", "string", None, None, "object"]
    a = variants.at(d, "$.a", "variant")
    assert [r[0] for r in df.orderBy("i").select(variants.type_of(a)).collect()] == ["array", None, None, None, None, None, None, "number"]
    has = lambda v, kind: [r[0] for r in df.orderBy("i").select(variants.contains(d, "$.a", F.lit(v).cast(kind), kind)).collect()]
    assert has(1, "bigint") == [True, *[False] * 6, True] and has(9, "bigint") == [False] * 8
    assert [r[0] for r in df.orderBy("i").select(F.coalesce(variants.has(d, "d"), F.lit(False))).collect()] == [True, *[False] * 7]
    members = variants.each(df, "doc", ["i"]).collect()
    assert sorted((r["i"], r["key"]) for r in members) == [(0, "a"), (0, "b"), (0, "d"), (0, "e"), (7, "a")]
    elements = variants.each(df.select("i", a.alias("doc")).filter("i = 0"), "doc", ["i"]).collect()
    assert [(r["pos"], r["key"]) for r in elements] == [(0, None), (1, None), (2, None), (3, None)]
