"""Exact k nearest candidates on the sphere, through a tree that follows their density.

Candidates lie on the unit sphere, which is cut into cubic cells; a cell is cut
again, ``4 x 4 x 4``, while it holds more than ``leaf_size`` candidates.  So cells
are small where candidates are many and large where they are few, and no cell
width has to be chosen for the data.  Each cell knows its number of candidates
and the box around them, which bounds their distance from any point on both sides.

All points go down the tree together, one equi-join a level.  A point keeps
the cells it may need: those nearer than the distance within which the other
cells surely hold k candidates.  At the leaves only the candidates of cells near
the point are left, in a dense city as in open country, so the candidate pairs
grow with points times k.  There is no seam at the date line or the poles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haven.functions.geo import haversine_km, sphere_xyz
from haven.session import job_dir

NEAREST_K = 3
#: Candidates beyond which a cell is cut again.
LEAF_SIZE = 16
#: Levels, and bits an axis gets at each: the last cells are some 0.2 m wide.
LEVELS, BITS = 13, 2
CELL = ["level", "cx", "cy", "cz"]
AXES = ["x", "y", "z"]
BOX = [f"{side}_{a}" for a in AXES for side in ("lo", "hi")]


def _cell_at(level: Column) -> list[Column]:
    """The cell of (x, y, z) at a level."""
    finest = float(1 << (LEVELS * BITS))
    out = [level]
    for a in AXES:
        q = F.least(F.floor((F.col(a) + 1.0) * (finest / 2)), F.lit(int(finest) - 1)).cast("long")
        out.append(F.floor(q / F.pow(F.lit(2.0), (LEVELS - level) * BITS)).cast("long"))
    return [c.alias(name) for c, name in zip(out, CELL, strict=True)]


def _placed(df: DataFrame) -> DataFrame:
    """Rows with a place, on the unit sphere."""
    for a, v in zip(AXES, sphere_xyz(F.col("lat"), F.col("lon")), strict=True):
        df = df.withColumn(a, v)
    return df.filter(reduce(lambda p, q: p & q, [F.col(a).isNotNull() & ~F.isnan(a) for a in AXES]))


def build_tree(candidates: DataFrame, leaf_size: int) -> DataFrame:
    """(level, cx, cy, cz, n, box, cut) of every cell whose parent was cut; ``cut`` says that it is cut itself."""
    cells = (candidates.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
             .select(*_cell_at(F.col("at")), *AXES).groupBy(*CELL)
             .agg(F.count(F.lit(1)).alias("n"), *[f(a).alias(f"{side}_{a}") for a in AXES for side, f in (("lo", F.min), ("hi", F.max))]))
    cut = (F.col("n") > leaf_size) & (F.col("level") < LEVELS)
    parents = cells.filter(cut).select((F.col("level") + 1).alias("level"), *[F.col(c).alias(f"p{c}") for c in CELL[1:]])
    up = [F.shiftright(F.col(c), BITS) == F.col(f"p{c}") for c in CELL[1:]]
    below = cells.join(parents, [cells["level"] == parents["level"], *up], "left_semi")
    return cells.filter("level = 0").unionByName(below).withColumn("cut", cut)


def _bounds() -> list[Column]:
    """Least and greatest squared distance of (x, y, z) from anything in the box."""
    near, far = F.lit(0.0), F.lit(0.0)
    for a in AXES:
        lo, hi = F.col(f"lo_{a}") - F.col(a), F.col(a) - F.col(f"hi_{a}")
        near = near + F.pow(F.greatest(F.lit(0.0), lo, hi), F.lit(2.0))
        far = far + F.pow(F.greatest(F.abs(lo), F.abs(hi)), F.lit(2.0))
    return [near.alias("near"), far.alias("far")]


def _needed(states: DataFrame, k: int) -> DataFrame:
    """Drop cells beyond the distance within which a point's nearer cells hold k candidates."""
    by_point = Window.partitionBy("pid")
    nearest_first = by_point.orderBy("far", *CELL).rowsBetween(Window.unboundedPreceding, 0)
    held = states.withColumn("held", F.sum("n").over(nearest_first))
    reach = held.withColumn("reach", F.min(F.when(F.col("held") >= k, F.col("far"))).over(by_point))
    # a little more than rounding can move a distance
    return reach.filter(F.col("reach").isNull() | (F.col("near") <= F.col("reach") * (1 + 1e-9) + 1e-15)).drop("held", "reach")


def leaf_visits(points: DataFrame, tree: DataFrame, k: int) -> DataFrame:
    """(pid, lat, lon, cell): the leaves that may hold one of a point's k nearest."""
    depth = tree.agg(F.max("level")).first()[0]
    if depth is None:
        return points.select("pid", "lat", "lon", *[F.lit(None).cast("long").alias(c) for c in CELL]).limit(0)
    # the first level with several cells: above it there is one way down
    several = tree.groupBy("level").count().filter("count > 1").agg(F.min("level")).first()[0]
    start = depth if several is None else several - 1
    root = tree.filter(F.col("level") == start).first()
    # the cell stays a column (plus a zero of the row's own): as a constant it would fold the equi-join with it away
    zero = F.pmod(F.xxhash64("pid"), F.lit(1))
    top = [(F.lit(root[c]) + zero).alias(c) for c in CELL] + [F.lit(root[c]).alias(c) for c in ("n", *BOX)]
    states = points.select("pid", "lat", "lon", *AXES, *top).select("*", *_bounds())
    down = tree.select((F.col("level") - 1).alias("level"), *[F.shiftright(F.col(c), BITS).alias(c) for c in CELL[1:]],
                       F.struct(*CELL, "n", *BOX).alias("child"))
    for _ in range(start, depth):
        # a leaf has no children and stays as it is
        stepped = states.drop("near", "far").join(down, CELL, "left")
        own = {c: F.coalesce(F.col(f"child.{c}"), F.col(c)).alias(c) for c in (*CELL, "n", *BOX)}
        states = stepped.select("pid", "lat", "lon", *AXES, *own.values()).select("*", *_bounds())
        states = _needed(states, k)
    return states.select("pid", "lat", "lon", *CELL)


def nearest(points: DataFrame, candidates: DataFrame, k: int = NEAREST_K, leaf_size: int = LEAF_SIZE) -> DataFrame:
    """Exact k nearest candidates per point by haversine: pid, rank, cid, distance_km, payload.

    Ties go to the smaller cid.  Of candidates at one place only the k smallest
    ids can be among the answer, and only they go on.  Points or candidates
    without a place find nothing; where fewer than k candidates exist, all of
    them are returned.

    points: (pid, lat, lon), pid unique; candidates: (cid, lat, lon, + payload columns).
    """
    spark = points.sparkSession
    payload = [c for c in candidates.columns if c not in ("cid", "lat", "lon")]
    same_place = Window.partitionBy("lat", "lon").orderBy("cid")
    places = (_placed(candidates).withColumn("_nth", F.row_number().over(same_place)).filter(F.col("_nth") <= k).drop("_nth"))
    # the tree is walked level by level, so it and what it is built from are written once
    root = job_dir(spark, "nearest")
    places.write.parquet(f"{root}/places")
    places = spark.read.parquet(f"{root}/places")
    build_tree(places, max(k, leaf_size)).write.parquet(f"{root}/tree")
    tree = spark.read.parquet(f"{root}/tree")

    leaves = tree.filter(~F.col("cut")).select(*CELL)
    located = (places.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
               .select("cid", F.col("lat").alias("c_lat"), F.col("lon").alias("c_lon"), *payload, *_cell_at(F.col("at")))
               .join(leaves, CELL, "left_semi"))
    visits = leaf_visits(_placed(points.select("pid", "lat", "lon")), tree, k)
    hits = visits.join(located, CELL).withColumn(
        "distance_km", haversine_km(F.col("lat"), F.col("lon"), F.col("c_lat"), F.col("c_lon")))
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("pid").orderBy("distance_km", "cid")))
    return ranked.filter(F.col("rank") <= k).select("pid", "rank", "cid", F.round("distance_km", 6).alias("distance_km"), *payload)
