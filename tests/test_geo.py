"""Exact k-nearest down a tree of cells equals brute force."""

from __future__ import annotations

import math
import random
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from haven.operators.nearest import _placed, build_tree, leaf_visits, nearest

R = 6371.0088


def _hav(a, b):
    la1, lo1, la2, lo2 = map(math.radians, (a[0], a[1], b[0], b[1]))
    h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
    return 2 * R * math.asin(math.sqrt(h))


near_by = st.tuples(st.floats(30.0, 36.0), st.floats(-88.0, -80.0))
anywhere = st.tuples(st.floats(-90.0, 90.0), st.floats(-180.0, 180.0))


def _check(spark, pts, cands, leaf_size, k=3):
    p = spark.createDataFrame([(f"p{i}", a, b) for i, (a, b) in enumerate(pts)], "pid string, lat double, lon double")
    c = spark.createDataFrame([(f"c{i:02d}", a, b, i) for i, (a, b) in enumerate(cands)],
                              "cid string, lat double, lon double, w int")
    got = {}
    for r in nearest(p, c, k=k, leaf_size=leaf_size).collect():
        assert r.cid == f"c{r.w:02d}"
        got.setdefault(r.pid, {})[r.rank] = r
    for i, pt in enumerate(pts):
        want = sorted(_hav(pt, cd) for cd in cands)[:k]
        found = got.get(f"p{i}", {})
        assert sorted(found) == list(range(1, len(want) + 1))
        assert len({r.cid for r in found.values()}) == len(want)
        for rank, km in enumerate(want, start=1):
            r = found[rank]
            assert abs(r.distance_km - km) < 1e-5 and abs(_hav(pt, cands[r.w]) - km) < 1e-5


@settings(max_examples=4, deadline=None)
@given(st.lists(near_by, min_size=1, max_size=6), st.lists(near_by, min_size=1, max_size=12))
def test_nearest_equals_brute_force(spark, pts, cands):
    _check(spark, pts, cands, 1)


@settings(max_examples=4, deadline=None)
@given(st.lists(anywhere, min_size=1, max_size=6), st.lists(anywhere, min_size=1, max_size=12))
def test_nearest_worldwide(spark, pts, cands):
    _check(spark, pts, cands, 2)


def test_nearest_across_date_line_poles_and_far_candidates(spark):
    pts = [(0.0, 179.99), (89.99, 10.0), (-90.0, 0.0), (33.7, -84.4)]
    cands = [(0.0, -179.99), (0.0, 179.0), (89.99, -170.0), (-89.9, 120.0), (-33.8, 151.2), (51.5, 0.0)]
    _check(spark, pts, cands, 2)
    _check(spark, pts, cands[:2], 2)


def test_nearest_same_place_and_no_place(spark):
    p = spark.createDataFrame([("p", 1.0, 1.0), ("q", None, 1.0)], "pid string, lat double, lon double")
    c = spark.createDataFrame([(f"c{i}", 1.0, 1.0) for i in range(9)] + [("z", 1.0, None)], "cid string, lat double, lon double")
    got = sorted((r.pid, r["rank"], r.cid) for r in nearest(p, c, k=3).collect())
    assert got == [("p", 1, "c0"), ("p", 2, "c1"), ("p", 3, "c2")]
    assert nearest(p, c.limit(0), k=3).count() == 0


def _town(r, n, lat=33.75, lon=-84.39, km=1.0):
    d = km / 111.2
    return [(lat + r.random() * d, lon + r.random() * d / math.cos(math.radians(lat))) for _ in range(n)]


def test_nearest_in_a_city_near_it_and_at_the_seams(spark):
    r = random.Random(3)
    city = _town(r, 300) + [(33.75, -84.39)] * 30
    pts = _town(r, 40) + _town(r, 10, lat=33.9) + [(33.7, -84.5), (-10.0, 100.0), (33.75, -84.39)]
    _check(spark, pts, city, 4, k=5)
    _check(spark, [(90.0, 0.0), (89.999, 50.0), (0.0, -180.0)],
           [(89.999, 10.0 * i) for i in range(36)] + [(0.001 * i, 179.999 - 0.0001 * i) for i in range(40)], 3, k=4)


def _frame(spark, key, rows):
    return spark.createDataFrame([(f"{key}{i:05d}", a, b) for i, (a, b) in enumerate(rows)], f"{key}id string, lat double, lon double").cache()


def test_pairs_grow_with_the_points(spark):
    """Many in a kilometre cost no more a point than few (16 times as many cut the same cells once more)."""
    r = random.Random(4)
    pairs, seconds = {}, {}
    for n in (500, 500, 8000):  # the first round warms up
        p, c = _frame(spark, "p", _town(r, n)), _frame(spark, "c", _town(r, n))
        start = time.perf_counter()
        assert nearest(p, c).count() == 3 * n
        seconds[n] = time.perf_counter() - start
        tree = build_tree(_placed(c), 16).cache()
        assert tree.filter("not cut").agg({"n": "max"}).first()[0] <= 16
        visits = leaf_visits(_placed(p), tree, 3).join(tree, ["level", "cx", "cy", "cz"])
        pairs[n] = visits.agg({"n": "sum"}).first()[0]
    assert pairs[8000] / 8000 < 1.5 * pairs[500] / 500 < 150
    assert seconds[8000] / 8000 <= seconds[500] / 500
