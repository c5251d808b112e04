"""Zone polygon sources.

The source system's polygons for the regular zones are not available, so the
package ships its own demonstration layer (``assets/demo_zones.geojson``): a
5 x 3 grid of regular zones 1..15 plus two special shapes with codes 2.5 (a
ring with a hole) and 14.5, which overlap each other and the grid so that the
priority rule matters. Real layers are read with ``geo.zones_from_geojson``.
"""

from __future__ import annotations

import json
import math
import os

from pyspark.sql import DataFrame, SparkSession

from .. import constants as K
from ..operators import geo

ASSET = os.path.join(os.path.dirname(os.path.dirname(__file__)), "assets", "demo_zones.geojson")

# FIXED VALUES (demonstration layer): grid origin, cell size and the two special shapes.
GRID_ORIGIN = (-58.5305, -34.7005)
GRID_STEP = (0.04, 0.06)
GRID_SHAPE = (5, 3)
SPECIAL_14_5 = [[-58.43217, -34.58911], [-58.40483, -34.58137], [-58.39671, -34.56329],
                [-58.41152, -34.55218], [-58.43689, -34.55704], [-58.44391, -34.57438]]
SPECIAL_2_5_OUTER = [[-58.41837, -34.60373], [-58.38249, -34.60111], [-58.37913, -34.56947],
                     [-58.41421, -34.57183]]
SPECIAL_2_5_HOLE = [[-58.40523, -34.59317], [-58.39207, -34.59269], [-58.39088, -34.58053],
                    [-58.40371, -34.58121]]


def _closed(ring):
    return ring + [ring[0]]


def demo_features() -> list[dict]:
    feats = []
    (x0, y0), (dx, dy), (nx, ny) = GRID_ORIGIN, GRID_STEP, GRID_SHAPE
    for j in range(ny):
        for i in range(nx):
            a, b = round(x0 + i * dx, 6), round(x0 + (i + 1) * dx, 6)
            c, d = round(y0 + j * dy, 6), round(y0 + (j + 1) * dy, 6)
            zone = float(j * nx + i + 1)
            feats.append({"type": "Feature", "properties": {"zone": zone, "name": f"Comuna {int(zone)}"},
                          "geometry": {"type": "Polygon",
                                       "coordinates": [_closed([[a, c], [b, c], [b, d], [a, d]])]}})
    feats.append({"type": "Feature", "properties": {"zone": 14.5, "name": "Zona especial 14.5"},
                  "geometry": {"type": "Polygon", "coordinates": [_closed(SPECIAL_14_5)]}})
    feats.append({"type": "Feature", "properties": {"zone": 2.5, "name": "Zona especial 2.5"},
                  "geometry": {"type": "Polygon",
                               "coordinates": [_closed(SPECIAL_2_5_OUTER), _closed(SPECIAL_2_5_HOLE)]}})
    return feats


def write_demo_asset(path: str = ASSET) -> str:
    with open(path, "w", encoding="utf-8") as fh:
        json.dump({"type": "FeatureCollection", "features": demo_features()}, fh, indent=1)
    return path


def demo_zones(spark: SparkSession) -> DataFrame:
    """The demonstration zone table (bounded dimension: 17 polygons)."""
    return geo.zones_from_features(spark, demo_features())


# FIXED VALUES (detailed layer): centre, radii, waves and code of each shape; the last is the special layer's
DETAILED = [(-58.441, -34.569, 0.016, 0.011, 7, 3.0), (-58.418, -34.583, 0.014, 0.012, 11, 5.0),
            (-58.405, -34.560, 0.012, 0.010, 5, 9.0), (-58.428, -34.574, 0.010, 0.007, 9, 14.5)]
DETAILED_VERTICES = 1200
DETAILED_ASSET = os.path.join(os.path.dirname(ASSET), "detailed_zones.geojson")
SPECIAL_ASSET = os.path.join(os.path.dirname(ASSET), "detailed_special.geojson")


def _wavy(cx: float, cy: float, rx: float, ry: float, waves: int) -> list[list[float]]:
    out = []
    for k in range(DETAILED_VERTICES):
        a = 2 * math.pi * k / DETAILED_VERTICES
        r = 1 + 0.15 * math.sin(waves * a) + 0.02 * math.sin(97 * a)
        out.append([round(cx + rx * r * math.cos(a), 7), round(cy + ry * r * math.sin(a), 7)])
    return _closed(out)


def write_detailed_assets() -> None:
    """Two layers of shapes with many vertices: codes in property ``comuna``,
    and one shape with only a name, as special layers have."""
    feats = [{"type": "Feature", "properties": {"comuna": code} if code != K.ZONE_SPECIAL_14_5 else {"name": "special"},
              "geometry": {"type": "Polygon", "coordinates": [_wavy(cx, cy, rx, ry, w)]}} for cx, cy, rx, ry, w, code in DETAILED]
    for path, part in ((DETAILED_ASSET, feats[:-1]), (SPECIAL_ASSET, feats[-1:])):
        with open(path, "w", encoding="utf-8") as fh:
            json.dump({"type": "FeatureCollection", "features": part}, fh)


def detailed_zones(spark: SparkSession) -> DataFrame:
    """The detailed layers, read from their files."""
    return geo.zone_layers(spark, [f"{DETAILED_ASSET}@comuna", f"{SPECIAL_ASSET}={K.ZONE_SPECIAL_14_5}"])
