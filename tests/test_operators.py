"""Zone join, evolution windows, incremental append and KPIs on small frames."""

import datetime
import math

import pytest

from pyspark.sql import functions as F

from fieldkpi import constants as K
from fieldkpi.operators import evolution, geo, incremental, kpi
from fieldkpi.sources.zones import demo_features, demo_zones


def _ring(x0, y0, x1, y1):
    return [[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]


def test_zone_priority_holes_and_edges(spark):
    feats = [
        {"properties": {"zone": 5.0}, "geometry": {"type": "Polygon", "coordinates": [_ring(0, 0, 10, 10)]}},
        {"properties": {"zone": 14.5}, "geometry": {"type": "Polygon", "coordinates": [_ring(2, 2, 6, 6)]}},
        {"properties": {"zone": 2.5}, "geometry": {"type": "Polygon",
                                                   "coordinates": [_ring(4, 4, 8, 8), _ring(5, 5, 7, 7)]}},
        {"properties": {"zone": 7.0}, "geometry": {"type": "MultiPolygon",
                                                   "coordinates": [[_ring(20, 0, 22, 2)], [_ring(24, 0, 26, 2)]]}},
    ]
    zones = geo.zones_from_features(spark, feats)
    pts = [(1, 1.0, 1.0), (2, 3.0, 3.0), (3, 4.5, 4.5), (4, 6.0, 4.5), (5, 5.5, 5.5), (6, 10.0, 5.0),
           (7, 0.0, 0.0), (8, None, None), (9, 25.0, 1.0), (10, 23.0, 1.0), (11, 11.0, 1.0), (12, 6.0, 3.0)]
    df = spark.createDataFrame(pts, "id int, lon double, lat double")
    out = {r.id: r.z for r in geo.assign_zone(df, zones, lon="lon", lat="lat", out="z", cell=1.0).collect()}
    assert out[1] == 5.0          # regular only
    assert out[2] == 14.5         # special beats regular
    assert out[3] == 2.5          # 2.5 beats 14.5
    assert out[4] == 2.5          # point on the 14.5 edge, inside the ring: 2.5
    assert out[5] == 14.5         # inside the hole of 2.5, still inside 14.5
    assert out[6] is None         # on the outer boundary of zone 5: not within
    assert out[7] is None         # a vertex
    assert out[8] is None         # null coordinates
    assert out[9] == 7.0 and out[10] is None  # multi-part polygon
    assert out[11] is None
    assert out[12] == 5.0         # on the 14.5 edge only: falls to the regular zone
    assert len(out) == len(pts)   # every point exactly once


def test_zone_join_without_broadcast(spark):
    zones = demo_zones(spark)
    df = spark.createDataFrame([(1, -58.42, -34.57), (2, -58.60, -34.60)], "id int, lon double, lat double")
    a = {r.id: r.z for r in geo.assign_zone(df, zones, "lon", "lat", "z").collect()}
    b = {r.id: r.z for r in geo.assign_zone(df, zones, "lon", "lat", "z", broadcast_limit=0).collect()}
    assert a == b and a[2] is None and a[1] is not None


def test_geojson_reader(spark, tmp_path):
    import json
    p = tmp_path / "z.geojson"
    p.write_text(json.dumps({"type": "FeatureCollection", "features": demo_features()}))
    z = geo.zones_from_geojson(spark, str(p))
    assert z.count() == 17
    ring = z.where(F.col("zone") == 2.5).first()
    assert len(ring.edges) == 8  # outer ring and hole, four edges each


def _frame(spark, rows):
    return spark.createDataFrame(rows, f"row_id long, `{K.COL_START}` timestamp, `{K.COL_KEY}` string, "
                                       f"`{K.COL_ZONE}` double")


def test_row_evolution(spark):
    d = datetime.datetime
    rows = [(1, d(2025, 1, 6, 9), "A", 2.0), (2, d(2025, 1, 8, 9), "A", 3.0),   # week 1: last row kept (zone 3)
            (3, d(2025, 1, 14, 9), "A", None), (4, d(2025, 1, 21, 9), "A", None),
            (5, d(2025, 1, 28, 9), "A", 3.0),
            (6, d(2025, 1, 6, 9), K.KEY_NOT_GIVEN, 2.0), (7, d(2025, 1, 6, 9), K.KEY_NOT_GIVEN, 2.0),
            (8, None, "B", 2.0), (9, d(2025, 1, 6, 9), "C", 4.0), (10, d(2025, 1, 13, 9), "C", 4.0)]
    out = {r.row_id: r[K.COL_EVOLUTION] for r in evolution.label_rows(_frame(spark, rows)).collect()}
    assert 1 not in out                     # de-duplicated (keep last)
    assert out[2] == K.EVO_NEW
    assert out[3] == K.EVO_MIGRANT and out[4] == K.EVO_MIGRANT  # null zones are never equal
    assert out[5] == K.EVO_MIGRANT
    assert out[6] == out[7] == K.EVO_UNCLASSIFIED              # anonymous kept whole
    assert out[8] == K.EVO_UNCLASSIFIED                        # no date
    assert out[9] == K.EVO_NEW and out[10] == K.EVO_RECURRING


def test_population_view(spark):
    d = datetime.datetime
    rows = [(1, d(2025, 12, 7, 9), "A", 2.0), (2, d(2025, 12, 14, 9), "A", None), (3, d(2025, 12, 21, 9), "A", 2.0),
            (4, d(2025, 12, 7, 9), "nan", 2.0), (5, d(2025, 12, 7, 8), "B", 5.0), (6, d(2025, 12, 8, 9), "B", 6.0)]
    out = {(r.DNI, r.Semana): (r.Comuna_Semanal, r.Condicion_Poblacion)
           for r in evolution.population_weekly(_frame(spark, rows)).collect()}
    assert out[("A", datetime.date(2025, 12, 7))] == (2.0, "Nuevo")
    assert out[("A", datetime.date(2025, 12, 14))] == (None, "Migratorio")
    assert out[("A", datetime.date(2025, 12, 21))] == (2.0, "Nuevo")   # previous zone null -> new
    assert ("nan", datetime.date(2025, 12, 7)) not in out
    assert out[("B", datetime.date(2025, 12, 7))] == (5.0, "Nuevo")   # first zone of the Sunday week


def test_zone_evolution_matches_loop(spark):
    import random
    rnd = random.Random(7)
    base = datetime.datetime(2025, 1, 6)
    rows = []
    for i in range(600):
        rows.append((i, base + datetime.timedelta(hours=rnd.randrange(24 * 7 * 12)), f"P{rnd.randrange(40)}",
                     rnd.choice([2.0, 14.0, 3.0, None])))
    df = _frame(spark, rows)
    got = {(r.target, r.week): (r.nuevos, r.recurrentes, r.migratorios)
           for r in evolution.zone_evolution(df, targets=[2.0, 14.0], last_weeks=20).collect()}
    # plain loop, as the source does it
    srt = sorted(rows, key=lambda r: (r[1], r[0]))
    week = lambda t: (t - datetime.timedelta(days=t.weekday())).date()
    first = {}
    for r in srt:
        first.setdefault((week(r[1]), r[2]), r)
    weeks = sorted({w for w, _ in first})
    last, seen, expect = {}, set(), {}
    for w in weeks:
        rws = [r for (ww, _), r in first.items() if ww == w]
        for t in (2.0, 14.0):
            n = rc = m = 0
            for r in rws:
                if r[3] != t:
                    continue
                if r[2] not in seen:
                    n += 1
                elif last.get(r[2]) == t:
                    rc += 1
                else:
                    m += 1
            expect[(t, w)] = (n, rc, m)
        for r in rws:
            last[r[2]] = r[3]
            seen.add(r[2])
    assert got == {k: v for k, v in expect.items() if k[1] in weeks[-20:]}


def test_incremental_append(spark):
    d = datetime.datetime
    hist = spark.createDataFrame([(1, d(2025, 1, 1)), (2, d(2025, 1, 5))], f"row_id long, `{K.COL_START}` timestamp")
    new = spark.createDataFrame([(3, d(2025, 1, 5), "x"), (4, d(2025, 1, 6), "y"), (5, None, "z")],
                                f"row_id long, `{K.COL_START}` timestamp, extra string")
    out, changed = incremental.append_new(hist, new)
    assert changed and sorted(r.row_id for r in out.collect()) == [1, 2, 4]
    assert "extra" in out.columns
    empty = hist.limit(0)
    out2, _ = incremental.append_new(empty, new)
    assert sorted(r.row_id for r in out2.collect()) == [3, 4, 5]   # no history: all rows, null dates too
    nulls = spark.createDataFrame([(9, None)], f"row_id long, `{K.COL_START}` timestamp")
    out3, changed3 = incremental.append_new(nulls, new)
    assert not changed3 and out3.count() == 1                      # all-null history: nothing appended


def test_dashboard_invariants(spark):
    d = datetime.datetime
    rows = []
    for i in range(400):
        rows.append((i, d(2025, 1, 6) + datetime.timedelta(days=i % 70), float(i % 17) if i % 13 else None,
                     "PENDIENTE" if i % 5 == 0 else "CERRADA",
                     K.RESULT_CIS if i % 4 == 0 else K.RESULTS_NO_CONTACT[i % 3],
                     K.CARD_AUTOMATIC if i % 3 else "MANUAL"))
    df = spark.createDataFrame(rows, f"row_id long, `{K.COL_START}` timestamp, `{K.COL_ZONE}` double, "
                                     f"`{K.COL_STATE}` string, `{K.COL_RESULT}` string, `{K.COL_CARD}` string")
    out = kpi.dashboard_kpis(df).collect()
    assert len(out) == 16 * 8
    for r in out:
        assert r.n_contact + r.n_no_contact + r.n_uncovered == r.calls      # classes add up to calls
    tot = {r.week: r.total for r in out if r.scope == "total"}
    zones = {}
    for r in out:
        if r.scope != "total":
            zones[r.week] = zones.get(r.week, 0) + r.total
    assert all(tot[w] >= zones[w] for w in tot)                          # total also holds null / other zones


def test_zone_evolution_text_zones(spark):
    d = datetime.datetime
    rows = [(1, d(2025, 1, 6, 9), "A", "Comuna 2"), (2, d(2025, 1, 13, 9), "A", "2.0"),
            (3, d(2025, 1, 20, 9), "A", "14"), (4, d(2025, 1, 27, 9), "A", "2")]
    df = spark.createDataFrame(rows, f"row_id long, `{K.COL_START}` timestamp, `{K.COL_KEY}` string, "
                                     f"`{K.COL_ZONE}` string")
    got = {(r.target, r.week.isoformat()): (r.nuevos, r.recurrentes, r.migratorios)
           for r in evolution.zone_evolution(df, targets=[2.0, 14.0]).collect()}
    assert got[(2.0, "2025-01-06")] == (1, 0, 0)
    assert got[(2.0, "2025-01-13")] == (0, 1, 0)      # previous 'Comuna 2' counts as zone 2
    assert got[(14.0, "2025-01-20")] == (0, 0, 1)
    assert got[(2.0, "2025-01-27")] == (0, 0, 1)


def test_clean_diagnostics(spark):
    from fieldkpi.plans.clean import clean_diagnostics, clean_history
    from fieldkpi.sources.fixtures import interventions
    diag = {}
    out = clean_history(interventions(spark, "/root/testdata/sf0.001", "orders"), demo_zones(spark), diagnostics=diag)
    n = out.count()
    d = clean_diagnostics(diag)
    assert d["rows"] - d["duplicates_removed"] == n
    assert d["zones_1_15"] + d["no_zone"] == d["rows"]   # 1..15 includes 2.5 and 14.5, as the source counts
    assert d["zone_14_5"] > 0 and d["zone_2_5"] > 0
    assert d["duplicates_removed"] >= 0


def test_row_labels_match_loop(spark):
    """label_rows against the week-by-week loop of the source (keep last per
    week and key, state carried over weeks; anonymous keys unclassified)."""
    import random
    rnd = random.Random(5)
    base = datetime.datetime(2025, 1, 6)
    rows = []
    for i in range(800):
        key = rnd.choice([f"P{rnd.randrange(30)}", K.KEY_NOT_GIVEN, K.KEY_FOREIGN])
        rows.append((i, base + datetime.timedelta(hours=rnd.randrange(24 * 7 * 10)), key,
                     rnd.choice([1.0, 2.0, 2.5, 14.5, None])))
    got = {r.row_id: r[K.COL_EVOLUTION] for r in evolution.label_rows(_frame(spark, rows)).collect()}
    week = lambda t: (t - datetime.timedelta(days=t.weekday())).date()
    anon = [r for r in rows if r[2] in K.ANONYMOUS_KEYS]
    ident = sorted((r for r in rows if r[2] not in K.ANONYMOUS_KEYS), key=lambda r: (r[1], r[0]))
    last_of = {}
    for r in ident:
        last_of[(week(r[1]), r[2])] = r          # keep='last'
    kept = list(last_of.values())
    expect = {r[0]: K.EVO_UNCLASSIFIED for r in anon}
    prior, seen = {}, set()
    for w in sorted({week(r[1]) for r in kept}):
        wk = [r for r in kept if week(r[1]) == w]
        for r in wk:
            p = prior.get(r[2], "missing")
            if r[2] not in seen:
                expect[r[0]] = K.EVO_NEW
            elif p is not None and p == r[3]:
                expect[r[0]] = K.EVO_RECURRING
            else:
                expect[r[0]] = K.EVO_MIGRANT
        for r in wk:
            prior[r[2]] = r[3]
            seen.add(r[2])
    assert got == expect


def test_one_row_per_week(spark):
    d = datetime.datetime
    rows = [(1, d(2025, 1, 6, 9), "A", 1.0), (2, d(2025, 1, 8, 9), "A", 2.0), (3, d(2025, 1, 8, 9), "A", 3.0),
            (4, d(2025, 1, 14, 9), "A", 3.0)]
    df = _frame(spark, rows)
    kept = {r.row_id: r[K.COL_EVOLUTION] for r in evolution.label_rows(df).collect()}
    # equal times: the larger row id is the later row
    assert kept == {3: K.EVO_NEW, 4: K.EVO_RECURRING}
    first = evolution.zone_evolution(df, targets=[1.0]).orderBy("week").first()   # the first row of the week counts
    assert first["nuevos"] == 1


def test_rows_without_person_or_date_are_never_grouped(spark):
    d = datetime.datetime
    rows = [(i, d(2025, 1, 6, 9), K.KEY_NOT_GIVEN, 1.0) for i in range(5)] + [(10 + i, None, "A", 1.0) for i in range(3)] + [(20, d(2025, 1, 6, 9), "A", 1.0)]
    got = evolution.label_rows(_frame(spark, rows))
    assert got.count() == 9 and got.where(F.col(K.COL_EVOLUTION) == K.EVO_UNCLASSIFIED).count() == 8
    with pytest.raises(Exception, match="null row_id"):
        evolution.label_rows(_frame(spark, [(None, d(2025, 1, 6, 9), "A", 1.0)])).collect()


def test_geojson_multipolygon_reader_matches_features(spark, tmp_path):
    import json
    feats = [
        {"type": "Feature", "properties": {"zone": 3.0, "name": "a"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [6, 0], [6, 6], [0, 6]]]}},   # ring not closed
        {"type": "Feature", "properties": {"zone": 9.0, "name": "b"},
         "geometry": {"type": "MultiPolygon", "coordinates": [
             [[[10, 0], [12, 0], [12, 2], [10, 2], [10, 0]]],
             [[[14, 0], [18, 0], [18, 4], [14, 4], [14, 0]], [[15, 1], [17, 1], [17, 3], [15, 3], [15, 1]]]]}},
    ]
    p = tmp_path / "zones.geojson"
    p.write_text(json.dumps({"type": "FeatureCollection", "features": feats}))
    z_spark = geo.zones_from_geojson(spark, str(p))
    z_local = geo.zones_from_features(spark, feats)
    pts = [(i, x + 0.5, y + 0.5) for i, (x, y) in enumerate([(a, b) for a in range(-1, 19) for b in range(-1, 7)])]
    df = spark.createDataFrame(pts, "id int, lon double, lat double")
    a = {r.id: r.z for r in geo.assign_zone(df, z_spark, "lon", "lat", "z", cell=1.0).collect()}
    b = {r.id: r.z for r in geo.assign_zone(df, z_local, "lon", "lat", "z", cell=1.0).collect()}
    assert a == b
    got = {(x, y): a[i] for i, x, y in pts}
    assert got[(1.5, 1.5)] == 3.0 and got[(11.5, 1.5)] == 9.0
    assert got[(16.5, 2.5)] is None and got[(14.5, 0.5)] == 9.0   # hole of the second part


def test_zone_layers_from_files(spark, tmp_path):
    import json
    square = [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]
    inner = [[[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]]

    def layer(name, props, ring):
        p = tmp_path / name
        p.write_text(json.dumps({"type": "FeatureCollection", "features": [
            {"type": "Feature", "properties": props, "geometry": {"type": "Polygon", "coordinates": ring}}]}))
        return str(p)

    regular, special = layer("r.geojson", {"comuna": "3"}, square), layer("s.geojson", {"name": "only a name"}, inner)
    zones = geo.zone_layers(spark, [f"{regular}@comuna", f"{special}=14.5"])
    pts = spark.createDataFrame([(1, 1.5, 1.5), (2, 3.0, 3.0), (3, 9.0, 9.0), (4, None, None), (5, 4.0, 2.0)], "id int, lon double, lat double")
    for limit in (10**9, 0):   # broadcast and shuffled
        got = {r.id: r.z for r in geo.assign_zone(pts, zones, "lon", "lat", "z", cell=0.7, broadcast_limit=limit).collect()}
        assert got == {1: 14.5, 2: 3.0, 3: None, 4: None, 5: None}
    with pytest.raises(Exception, match="feature without zone"):   # a null code would win over real zones
        geo.assign_zone(pts, geo.zone_layers(spark, [special]), "lon", "lat", "z").collect()
    with pytest.raises(ValueError):
        geo.zone_rows([{"properties": {"name": "x"}, "geometry": {"type": "Polygon", "coordinates": square}}])


def test_detailed_polygons_keep_few_edges_per_cell(spark):
    from fieldkpi.sources.zones import DETAILED_VERTICES, detailed_zones
    zones = detailed_zones(spark)
    assert zones.where(F.size("edges") >= 1000).count() == 4
    cells = geo.zone_cells(zones, 0.0025)
    most = cells.select(F.explode("cands").alias("c")).agg(F.max(F.size("c.edges"))).first()[0]
    assert most < DETAILED_VERTICES / 5
    plan = geo.assign_zone(spark.createDataFrame([(1, -58.44, -34.57)], "id int, lon double, lat double"), zones, "lon", "lat", "z")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def _star(cx, cy, radius, vertices, arms):
    ring = []
    for i in range(vertices):
        a = 2 * math.pi * i / vertices
        r = radius * (0.7 + 0.3 * math.sin(arms * a))
        ring.append([cx + r * math.cos(a), cy + r * math.sin(a)])
    return ring + ring[:1]


def _inside(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def test_country_sized_polygon_of_ten_thousand_vertices(spark):
    """Cells are small only along the boundary, and every point gets the zone that a
    walk around the whole rings gives, broadcast or shuffled."""
    import random
    country, hole, lake = _star(-64.0, -38.0, 9.0, 10000, 7), _star(-64.0, -38.0, 2.0, 3000, 5), _star(-62.0, -33.5, 1.0, 400, 3)
    feats = [{"properties": {"zone": 3.0}, "geometry": {"type": "Polygon", "coordinates": [country, hole]}},
             {"properties": {"zone": 2.5}, "geometry": {"type": "Polygon", "coordinates": [lake]}}]
    zones = geo.zones_from_features(spark, feats)
    index = geo.zone_index(zones)
    cells = index.cells.select("level", "cell_x", F.explode("cands").alias("c")).groupBy("level").agg(
        F.count("*").alias("n"), F.max(F.size("c.edges")).alias("edges"), F.count_if(F.size("c.edges") == 0).alias("whole")).collect()
    assert sum(r.n for r in cells) < 20 * 13400          # by the boundary: the box alone has 50 million of the smallest cells
    assert max(r.edges for r in cells) <= 40 and any(r.level >= 2 and r.whole for r in cells)
    rnd = random.Random(3)
    pts = [(rnd.uniform(-74, -54), rnd.uniform(-48, -28)) for _ in range(150)]
    for ring in (country, hole, lake):   # close to the boundary, on both sides
        pts += [(x + rnd.gauss(0, 0.003), y + rnd.gauss(0, 0.003)) for x, y in rnd.sample(ring, 60)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)] + [(-1, None, None), (-2, float("nan"), 1.0)], "id int, lon double, lat double")
    want = {i: 2.5 if _inside([lake], x, y) else 3.0 if _inside([country, hole], x, y) else None for i, (x, y) in enumerate(pts)} | {-1: None, -2: None}
    assert {2.5, 3.0, None} == set(want.values())
    for limit in (10**9, max(index.bytes.values()), 0):
        assert {r.id: r.z for r in geo.assign_zone(df, index, "lon", "lat", "z", broadcast_limit=limit).collect()} == want


def test_points_without_zones(spark):
    zones = geo.zones_from_features(spark, [{"properties": {"zone": 3.0}, "geometry": {"type": "Polygon", "coordinates": [_ring(0, 0, 1, 1)]}}]).limit(0)
    df = spark.createDataFrame([(1, 0.5, 0.5)], "id int, lon double, lat double")
    assert [tuple(r) for r in geo.assign_zone(df, zones, "lon", "lat", "z").collect()] == [(1, 0.5, 0.5, None)]
