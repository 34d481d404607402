import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwise.operators import cells as C
from panelwise.operators import oversampling as O


def table(spark, data):
    return spark.createDataFrame([(*map(float, x), y) for x, y in data], "a double, b double, c double, y int")


@pytest.fixture(scope="module")
def minority():
    rng = np.random.default_rng(5)
    cloud = rng.normal(size=(260, 3)) * [5, 1, 0.2]
    grid = np.round(rng.normal(size=(60, 3)))  # many equal and equidistant points
    copies = np.repeat([[1.0, 2.0, 3.0], [50.0, 0.0, 0.0]], [90, 3], axis=0)
    return np.vstack([cloud, grid, copies, [[500.0, 500.0, 500.0]]])


@pytest.mark.parametrize("cell, asks", [(10_000, 100_000), (40, 100_000), (15, 20)])
def test_neighbours_equal_brute_force(spark, minority, monkeypatch, cell, asks):
    monkeypatch.setattr(C, "ASKS", asks)
    df = table(spark, [(x, 1) for x in minority])
    points = O.points_of(df, ["a", "b", "c"])
    distinct, counts = np.unique(minority, axis=0, return_counts=True)
    assert points.count() == len(distinct) and points.agg(F.sum("copies")).first()[0] == len(minority)
    found = O.neighbours(points, 3, 5, cell).collect()
    assert len(found) == len(distinct)
    for r in found:
        x = np.array(r["x"])
        d = np.sort(np.sqrt(((distinct - x) ** 2).sum(axis=1)))[1:6]
        # Distances, since equally far points may stand for each other; only as many as the copies leave open.
        have, need = r["copies"] - 1, 0
        for n in r["near"]:
            if have >= 5:
                break
            have, need = have + n["copies"], need + 1
        assert [n["d"] for n in r["near"]][:need] == pytest.approx(list(d[:need]))
        assert have >= 5


def test_ties_are_settled_by_number(spark):
    grid = [(float(a), float(b), 0.0) for a in range(12) for b in range(12)]
    points = O.points_of(table(spark, [(x, 1) for x in grid]), ["a", "b", "c"])
    where = {r.pid: np.array(r.x) for r in points.collect()}
    for r in C.nearest_points(points, 3, 5, 20).collect():
        d = sorted((float(np.sqrt(((where[r.pid] - x) ** 2).sum())), p) for p, x in where.items() if p != r.pid)[:5]
        assert [(n.d, n.pid) for n in r.near] == d


def test_compared_points_stay_few():
    """Eight columns made from one number, as in the catalog: four times the points, about the same comparisons a row."""
    made = []
    for n in (4000, 16000):
        i = np.arange(n) * 7
        x = np.stack([i % 80, i % 300 / 10, i % 130, i % 80 + 45, i % 160, i % 250, i % 75, i % 210], axis=1).astype(float)
        x = np.unique(x, axis=0)
        _, place, compared = C.nearest(x, np.arange(len(x)), x, np.arange(len(x)), np.full(len(x), np.inf), 5)
        assert (place >= 0).all()
        made.append(compared.mean())
    assert made[1] < 2 * made[0]


def test_classes_become_equal_and_rows_lie_between(spark, minority):
    majority = [((float(i), -100.0, 0.0), 0) for i in range(1000)]
    df = table(spark, [(x, 1) for x in minority] + majority)
    out = O.oversample(df, ["a", "b", "c"], "y")
    counts = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts == {0: 1000, 1: 1000}
    made = out.filter("y = 1").exceptAll(df.filter("y = 1")).select("a", "b", "c").collect()
    assert len(made) == 1000 - len(minority)
    for r in made[::17]:
        p = np.array(r)
        # On a segment between two minority rows: the two distances add up to the length.
        d = np.sqrt(((minority - p) ** 2).sum(axis=1))
        lengths = np.sqrt(((minority[:, None] - minority[None]) ** 2).sum(axis=2))
        assert np.abs(d[:, None] + d[None] - lengths).min() < 1e-9


def test_same_rows_again_and_many_copies(spark):
    df = table(spark, [((0, 0, 0), 1)] * 7 + [((1, 0, 0), 1)] + [((9, 9, 9), 0)] * 50)
    first, second = (sorted(map(tuple, O.oversample(df.repartition(n), ["a", "b", "c"], "y").collect())) for n in (1, 5))
    assert first == second and len(first) == 100
    # A point with more copies than neighbours asked for is only joined to itself.
    assert sum(r[:3] == (0.0, 0.0, 0.0) for r in first) >= 7 * 5


def test_balanced_or_hopeless(spark):
    even = table(spark, [((0, 0, 0), 1), ((1, 1, 1), 0)])
    assert O.oversample(even, ["a"], "y").count() == 2
    with pytest.raises(ValueError):
        O.oversample(table(spark, [((0, 0, 0), 1)] + [((1, 1, 1), 0)] * 3), ["a"], "y")
