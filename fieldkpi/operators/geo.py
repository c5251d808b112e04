"""Point-in-polygon zone assignment with layer priorities.

Plan (no shuffle of the point side while the cell table stays small):

1. The zones' area is cut into cells of four sizes, small ones only where edges
   are. A cell keeps only the zone's edges that meet it and whether one reference
   point of the cell lies inside; a cell without edges is wholly inside (kept) or
   outside (dropped). The cell table is written to the checkpoint folder and the
   size of each level measured.
2. Each point computes its cell key and meets the levels in equi-joins: broadcast
   up to a size limit. Beyond it a level's join is shuffled; its cells are then
   repeated over a few salts, so that a busy cell's points go to several tasks, and
   points without coordinates are spread over keys of their own.
3. The exact test runs as native higher-order functions over the cell's edges:
   from the point along the row to the reference point's column, then along
   that column to the reference point, every edge crossed flips inside and
   outside (holes and multi-part polygons follow from the even-odd rule).
   Points on an edge are outside (``within`` is strict).
4. The winner is the smallest (priority, zone) among polygons containing the
   point; no match (or null coordinates) gives null.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..session import cut_lineage

EDGE = T.StructType([T.StructField(n, T.DoubleType()) for n in ("x1", "y1", "x2", "y2")])
ZONE_SCHEMA = T.StructType([
    T.StructField("zone", T.DoubleType()),
    T.StructField("name", T.StringType()),
    T.StructField("priority", T.IntegerType()),
    T.StructField("minx", T.DoubleType()), T.StructField("miny", T.DoubleType()),
    T.StructField("maxx", T.DoubleType()), T.StructField("maxy", T.DoubleType()),
    T.StructField("edges", T.ArrayType(EDGE)),
])

# broadcast limit for the cell table, in estimated bytes
BROADCAST_LIMIT = 64 * 1024 * 1024
EDGE_BYTES = 40
STEP = 4      # a cell of one level has 2^STEP x 2^STEP parts of the next
TOP = 3       # levels above the smallest cells: 0.0025, 0.04, 0.64 and 10.24 degrees
DENSE = 16    # edges that a cell may hold without being cut
SALTS = 8     # copies of a level's cells in a shuffled join
NO_CELL = -(10 ** 12)  # keys below it are no cells: rows without coordinates are spread over them


def priority_of(zone: float | None) -> int:
    return K.ZONE_PRIORITY.get(zone, K.REGULAR_PRIORITY)


def _rings(geometry: dict) -> list[list[list[float]]]:
    if geometry["type"] == "Polygon":
        return geometry["coordinates"]
    if geometry["type"] == "MultiPolygon":
        return [ring for poly in geometry["coordinates"] for ring in poly]
    raise ValueError(f"unsupported geometry {geometry['type']}")


def zone_rows(features: list[dict], zone_property: str = "zone", name_property: str = "name") -> list[tuple]:
    """Feature dicts (GeoJSON, lon/lat) -> rows of ZONE_SCHEMA. A feature
    without a zone code raises: a null code would outrank real zones."""
    rows = []
    for f in features:
        props = f.get("properties") or {}
        if props.get(zone_property) is None:
            raise ValueError(f"feature without {zone_property}: {props}")
        zone = float(props[zone_property])
        edges, xs, ys = [], [], []
        for ring in _rings(f["geometry"]):
            pts = [(float(p[0]), float(p[1])) for p in ring]
            if pts and pts[0] != pts[-1]:
                pts.append(pts[0])
            for (x1, y1), (x2, y2) in zip(pts, pts[1:]):
                edges.append((x1, y1, x2, y2))
            xs += [p[0] for p in pts]
            ys += [p[1] for p in pts]
        rows.append((zone, props.get(name_property), priority_of(zone), min(xs), min(ys), max(xs), max(ys), edges))
    return rows


def zones_from_features(spark: SparkSession, features: list[dict], **kw) -> DataFrame:
    return spark.createDataFrame(zone_rows(features, **kw), ZONE_SCHEMA)


def zones_from_geojson(spark: SparkSession, path: str, zone: float | None = None,
                       zone_property: str = "zone") -> DataFrame:
    """Read GeoJSON FeatureCollection file(s) into the zone table on the cluster.

    ``zone`` assigns one code to every feature of the file (special layers);
    otherwise the code comes from ``properties.<zone_property>``, and a feature
    without it ends the job.
    """
    geom = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
    feat = T.StructType([T.StructField("geometry", geom),
                         T.StructField("properties", T.MapType(T.StringType(), T.StringType()))])
    schema = T.StructType([T.StructField("features", T.ArrayType(feat))])
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    f = raw.select(F.explode("features").alias("f"))
    poly = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
    multi = F.from_json("f.geometry.coordinates", "array<array<array<array<double>>>>")
    rings = F.when(F.col("f.geometry.type") == "Polygon", poly).otherwise(F.flatten(multi))
    given = F.col("f.properties")[zone_property].cast("double")
    missing = F.raise_error(F.lit(f"feature without {zone_property} in {path}")).cast("double")
    code = F.lit(zone).cast("double") if zone is not None else F.coalesce(given, missing)
    df = f.select(code.alias("zone"), F.col("f.properties")["name"].alias("name"), rings.alias("rings"))
    return zones_from_rings(df)


def zone_layers(spark: SparkSession, layers: list[str]) -> DataFrame:
    """Several GeoJSON layers as one zone table. A layer is ``path`` (codes in
    property ``zone``), ``path@property`` or ``path=code`` (one fixed code)."""
    out = None
    for layer in layers:
        path, fixed = (layer.rsplit("=", 1) + [None])[:2] if "=" in layer else (layer, None)
        path, prop = (path.rsplit("@", 1) if "@" in path else (path, "zone"))
        one = zones_from_geojson(spark, path, zone=float(fixed) if fixed is not None else None, zone_property=prop)
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no zone layer given")
    return out


def zones_from_rings(df: DataFrame) -> DataFrame:
    """(zone, name, rings array<array<array<double>>>) -> ZONE_SCHEMA rows."""
    closed = F.transform("rings", lambda r: F.when(
        (r[0][0] != r[F.size(r) - 1][0]) | (r[0][1] != r[F.size(r) - 1][1]),
        F.concat(r, F.array(r[0]))).otherwise(r))
    edges = F.flatten(F.transform(closed, lambda r: F.transform(
        F.sequence(F.lit(1), F.size(r) - 1),
        lambda i: F.struct(r[i - 1][0].alias("x1"), r[i - 1][1].alias("y1"),
                           r[i][0].alias("x2"), r[i][1].alias("y2")))))
    pts = F.flatten(F.col("rings"))
    prio = F.lit(K.REGULAR_PRIORITY)
    for z, p in K.ZONE_PRIORITY.items():
        prio = F.when(F.col("zone") == F.lit(z), F.lit(p)).otherwise(prio)
    return df.select(
        F.col("zone").cast("double"), F.col("name"), prio.cast("int").alias("priority"),
        F.array_min(F.transform(pts, lambda p: p[0])).alias("minx"),
        F.array_min(F.transform(pts, lambda p: p[1])).alias("miny"),
        F.array_max(F.transform(pts, lambda p: p[0])).alias("maxx"),
        F.array_max(F.transform(pts, lambda p: p[1])).alias("maxy"),
        edges.cast(T.ArrayType(EDGE)).alias("edges"))


def _parity(edges, px: Column, py: Column) -> Column:
    def crossing(e):
        straddles = (e["y1"] > py) != (e["y2"] > py)
        x_at = (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
        return straddles & (px < x_at)

    return F.aggregate(edges, F.lit(False), lambda acc, e: acc != crossing(e))


# the reference point of a cell lies off its middle, so that no grid-like data falls on its column
REFERENCE = (0.4871239, 0.5128764)


def _reference(cell_x: Column, cell_y: Column, cell: float) -> tuple[Column, Column]:
    return (cell_x + F.lit(REFERENCE[0])) * F.lit(cell), (cell_y + F.lit(REFERENCE[1])) * F.lit(cell)


def _meets(edges: Column, x: Column, y: Column, width: float, hair: float) -> Column:
    """The edges whose box meets a cell. The cell is widened by a hair, so rounding
    in floor(x / cell) can never part a point from an edge beside it."""
    x0, y0 = x * F.lit(width) - F.lit(hair), y * F.lit(width) - F.lit(hair)
    x1, y1 = (x + 1) * F.lit(width) + F.lit(hair), (y + 1) * F.lit(width) + F.lit(hair)
    return F.filter(edges, lambda e: (F.least(e["x1"], e["x2"]) <= x1) & (F.greatest(e["x1"], e["x2"]) >= x0)
                    & (F.least(e["y1"], e["y2"]) <= y1) & (F.greatest(e["y1"], e["y2"]) >= y0))


def _parts(width: float, cell: float, level: int) -> Column:
    """A candidate's cells one level further down, from its own edges alone: each
    with the edges that meet it and its reference point's side, which is the larger
    cell's, flipped by the edges on the way from one reference point to the other."""
    side = 1 << STEP
    rx, ry = _reference(F.col("cell_x"), F.col("cell_y"), width)

    def part(k):
        x, y = F.shiftleft("cell_x", STEP) + k % side, F.shiftleft("cell_y", STEP) + F.floor(k / side)
        px, py = _reference(x, y, width / side)
        inside = F.aggregate("edges", F.col("inside"), lambda acc, e: acc != _flips(e, px, py, rx, ry))
        return F.struct(F.lit(level - 1).alias("level"), x.alias("cell_x"), y.alias("cell_y"),
                        _meets(F.col("edges"), x, y, width / side, cell * 1e-6).alias("edges"), inside.alias("inside"))

    def in_box(k):
        x, y = F.shiftleft("cell_x", STEP) + k % side, F.shiftleft("cell_y", STEP) + F.floor(k / side)
        lo_x, hi_x, lo_y, hi_y = (F.shiftright(F.floor(F.col(c) / cell), STEP * (level - 1)) for c in ("minx", "maxx", "miny", "maxy"))
        return (x >= lo_x) & (x <= hi_x) & (y >= lo_y) & (y <= hi_y)

    near = F.filter(F.sequence(F.lit(0), F.lit(side * side - 1)), in_box)
    return F.filter(F.transform(near, part), lambda c: c["inside"] | (F.size(c["edges"]) > 0))


def zone_cells(zones: DataFrame, cell: float, top: int = TOP, dense: int = DENSE) -> DataFrame:
    """Cells of several sizes (``level`` n: ``cell`` times 16^n) with their candidate
    zones, each with the edges that meet the cell (``edges``) and whether the cell's
    reference point is inside (``inside``).

    A zone starts with the few cells of level ``top`` that its box meets; only for
    these its whole ring is walked. A cell whose zones have more than ``dense``
    edges in it is cut into 16 x 16 parts, for the zones with edges there, down to
    level 0; a cell without edges stays whole, however large it is. So the work and
    the table grow with the boundaries, not with the area.
    """
    names = ["priority", "zone", "minx", "miny", "maxx", "maxy"]
    width = cell * (1 << STEP * top)

    def span(lo: str, hi: str):
        return F.explode(F.sequence(*[F.shiftright(F.floor(F.col(c) / cell), STEP * top) for c in (lo, hi)]))

    roots = zones.select(*names, F.col("edges").alias("ring"), span("minx", "maxx").alias("cell_x"))
    roots = roots.select("*", span("miny", "maxy").alias("cell_y"))
    x, y = F.col("cell_x"), F.col("cell_y")
    now = roots.select(*names, F.lit(top).alias("level"), "cell_x", "cell_y", _meets(F.col("ring"), x, y, width, cell * 1e-6).alias("edges"),
                       _parity(F.col("ring"), *_reference(x, y, width)).alias("inside"))
    for level in range(top, 0, -1):
        crowd = F.sum(F.size("edges")).over(Window.partitionBy("level", "cell_x", "cell_y"))  # a row per zone
        same = F.struct("level", "cell_x", "cell_y", "edges", "inside")
        split = (F.col("level") == level) & (F.col("crowd") > dense) & (F.size("edges") > 0)
        parts = F.when(split, _parts(cell * (1 << STEP * level), cell, level)).otherwise(F.array(same))
        now = now.withColumn("crowd", crowd).select(*names, F.explode(parts).alias("c")).select(*names, "c.*")
    cand = F.struct(*names, "inside", "edges")
    return now.where(F.col("inside") | (F.size("edges") > 0)).groupBy("level", "cell_x", "cell_y").agg(F.collect_list(cand).alias("cands"))


def _flips(e: Column, px: Column, py: Column, rx: Column, ry: Column) -> Column:
    """Whether an edge is crossed an odd number of times on the way from p along its
    row to r's column and along that column to r."""
    x_at = (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
    along_row = ((e["y1"] > py) != (e["y2"] > py)) & ((px < x_at) != (rx < x_at))
    y_at = (e["y2"] - e["y1"]) * (rx - e["x1"]) / (e["x2"] - e["x1"]) + e["y1"]
    along_column = ((e["x1"] > rx) != (e["x2"] > rx)) & ((py < y_at) != (ry < y_at))
    return along_row != along_column


def _within(c: Column, px: Column, py: Column, rx: Column, ry: Column) -> Column:
    in_box = (px > c["minx"]) & (px < c["maxx"]) & (py > c["miny"]) & (py < c["maxy"])

    def on_edge(e):
        cross = (e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"])
        return ((cross == 0) & (px >= F.least(e["x1"], e["x2"])) & (px <= F.greatest(e["x1"], e["x2"]))
                & (py >= F.least(e["y1"], e["y2"])) & (py <= F.greatest(e["y1"], e["y2"])))

    inside = F.aggregate(c["edges"], c["inside"], lambda acc, e: acc != _flips(e, px, py, rx, ry))
    return in_box & inside & ~F.exists(c["edges"], on_edge)


SALTS = 8  # copies of the cell table in a shuffled join
NO_CELL = -(10 ** 12)  # keys below it are no cells: rows without coordinates are spread over them


def _hits(cands: str, px: Column, py: Column, rx: Column, ry: Column) -> Column:
    """(priority, zone) of the candidates that contain the point; none without candidates."""
    found = F.filter(cands, lambda c: _within(c, px, py, rx, ry))
    none = F.array().cast("array<struct<p:int,z:double>>")
    return F.coalesce(F.transform(found, lambda c: F.struct(c["priority"].alias("p"), c["zone"].alias("z"))), none)


class ZoneIndex(NamedTuple):
    """The cell table of a zone table, its smallest cell width and the measured bytes of each level."""

    cells: DataFrame
    cell: float
    bytes: dict[int, int]


def zone_index(zones: DataFrame, cell: float = 0.0025) -> ZoneIndex:
    """Build and checkpoint the cell table (of the bounded zone dimension)."""
    cells = cut_lineage(zone_cells(zones, cell))
    n_bytes = F.aggregate("cands", F.lit(0), lambda n, c: n + F.size(c["edges"]) * EDGE_BYTES + 80)
    return ZoneIndex(cells, cell, {r.level: r.n for r in cells.groupBy("level").agg(F.sum(n_bytes).alias("n")).collect()})  # a row per level


def assign_zone(points: DataFrame, zones: DataFrame | ZoneIndex, lon: str = K.COL_LON, lat: str = K.COL_LAT,
                out: str = K.COL_ZONE, cell: float = 0.0025, broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Left join each point to the zone containing it (strictly), by priority.

    ``lon``/``lat`` must be double columns (WGS84). Every input row is kept
    exactly once; ``out`` is null where no polygon contains the point. The cell
    table is built when the plan is, as the measured size of its levels is part of
    the plan; pass a ``zone_index`` to use one table more than once. The levels
    are broadcast, large cells first, while they stay within ``broadcast_limit``
    together.
    """
    cells, cell, sizes = zones if isinstance(zones, ZoneIndex) else zone_index(zones, cell)
    px, py = F.col(lon), F.col(lat)
    spread, total, hits = F.xxhash64(*points.columns), 0, []
    joined = points.withColumn("__fx", F.floor(px / cell)).withColumn("__fy", F.floor(py / cell))
    for level in sorted(sizes, reverse=True):
        # a larger cell's number comes from the smallest one's, so that rounding can't part the levels
        x, y = F.shiftright("__fx", STEP * level), F.shiftright("__fy", STEP * level)
        one = cells.where(F.col("level") == level).select(F.col("cell_x").alias("__x"), F.col("cell_y").alias("__y"), F.col("cands").alias(f"__c{level}"))
        total += sizes[level]
        if total <= broadcast_limit:
            keyed = joined.withColumn("__kx", x).withColumn("__ky", y)
            match = (F.col("__kx") == F.col("__x")) & (F.col("__ky") == F.col("__y"))
            joined = keyed.join(F.broadcast(one), match, "left").drop("__kx", "__ky", "__x", "__y")
        else:
            keyed = (joined.withColumn("__kx", F.coalesce(x, F.lit(NO_CELL) - F.pmod(spread, F.lit(4096)))).withColumn("__ky", F.coalesce(y, F.lit(0)))
                     .withColumn("__s", F.pmod(spread, F.lit(SALTS)).cast("int")))
            one = one.withColumn("__t", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            match = (F.col("__kx") == F.col("__x")) & (F.col("__ky") == F.col("__y")) & (F.col("__s") == F.col("__t"))
            joined = keyed.join(one, match, "left").drop("__kx", "__ky", "__x", "__y", "__s", "__t")
        rx, ry = _reference(x, y, cell * (1 << STEP * level))
        hits.append(_hits(f"__c{level}", px, py, rx, ry))
    best = F.array_min(F.concat(*hits))["z"] if hits else F.lit(None).cast("double")
    return joined.withColumn(out, best).select(*points.columns, out)
