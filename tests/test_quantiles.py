"""Exact quantiles by distributed selection against numpy."""

import math
import random

import numpy as np

from notelab.operators import sections as sc


def test_quantiles_equal_numpy(spark):
    rng = random.Random(5)
    groups = {"hot": [rng.lognormvariate(0, 6) for _ in range(6000)], "ties": [rng.choice([1.0, 2.0, 2.5]) for _ in range(400)],
              "one": [-3.0], "two": [1.0, 2.0], "signs": [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-300, 300) for _ in range(500)],
              "wide": [-1.7e308, 1.7e308, 5e-324, 0.0], None: [4.0, 8.0, 15.0]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("hot", None), ("none", None), ("two", float("nan"))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r["g"]: r["quantiles"] for r in sc.exact_quantiles(df, ["g"], "v", (0.0, 0.1, 0.5, 0.75, 1.0)).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        for mine, other in zip(got[g], (np.sort(vs)[i] if i == j else None for i, j in (
                (math.floor((len(vs) - 1) * q), math.ceil((len(vs) - 1) * q)) for q in (0.0, 0.1, 0.5, 0.75, 1.0))), strict=True):
            assert other is None or mine == other
        if g != "wide":
            assert np.allclose(got[g], np.quantile(vs, (0.0, 0.1, 0.5, 0.75, 1.0)), rtol=1e-12, atol=0)


def test_infinities_and_empty_tables(spark):
    inf = float("inf")
    df = spark.createDataFrame([("a", x) for x in (-inf, 1.0, 2.0, 3.0, inf)], "g string, v double")
    assert [tuple(r["quantiles"]) for r in sc.exact_quantiles(df, ["g"], "v", (0.0, 0.25, 0.5, 0.75, 1.0)).collect()] == [
        (-inf, 1.0, 2.0, 3.0, inf)]
    assert sc.exact_quantiles(df.where("false"), ["g"], "v", (0.5,)).count() == 0


def test_statistics_of_notes_and_mentions(spark):
    df = spark.createDataFrame([("a", "n1", 1.0), ("a", "n1", 3.0), ("a", "n2", None), ("b", None, None), (None, "n1", 2.0)],
                               "analyte string, source string, base_value double")
    got = {r["analyte"]: tuple(r)[1:] for r in sc.measurement_stats(df, ["analyte"], "source").collect()}
    assert got == {"a": (2, 3, 1.5, 1.5, 2.0, 2.5), "b": (0, 1, None, None, None, None), None: (1, 1, 1.0, 2.0, 2.0, 2.0)}
