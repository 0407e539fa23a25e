import json
import math
import os

import numpy as np
import pytest

from parcelflow import config as C
from parcelflow.operators import spatial
from parcelflow.sources.side import read_geojson_polygons

R = 6378137.0


def merc(lon, lat):
    return [R * math.radians(lon), R * math.log(math.tan(math.pi / 4 + math.radians(lat) / 2))]


def ring(pts):
    return [merc(x, y) for x, y in pts]


def _geojson(path):
    sq = [(-120, 34), (-119, 34), (-119, 35), (-120, 35), (-120, 34)]
    hole = [(-119.7, 34.3), (-119.3, 34.3), (-119.3, 34.7), (-119.7, 34.7), (-119.7, 34.3)]
    tri = [(-118, 34), (-117, 34), (-117.5, 35), (-118, 34)]
    m1 = [(-116, 34), (-115.5, 34), (-115.5, 34.5), (-116, 34.5), (-116, 34)]
    m2 = [(-115.4, 34), (-115, 34), (-115, 34.5), (-115.4, 34.5), (-115.4, 34)]
    ov_a = [(-121, 36), (-120, 36), (-120, 37), (-121, 37), (-121, 36)]
    ov_b = [(-120.5, 36), (-119.5, 36), (-119.5, 37), (-120.5, 37), (-120.5, 36)]
    high = [(-118, 36), (-117, 36), (-117, 37), (-118, 37), (-118, 36)]
    feats = [
        ("Square", "Unified", "Polygon", [ring(sq), ring(hole)]),
        ("Triangle", "Unified", "Polygon", [ring(tri)]),
        ("Multi", "Unified", "MultiPolygon", [[ring(m1)], [ring(m2)]]),
        ("Zeta", "Unified", "Polygon", [ring(ov_a)]),
        ("Alpha", "Unified", "Polygon", [ring(ov_b)]),
        ("HighOnly", "High", "Polygon", [ring(high)]),
    ]
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"DistrictName": n, "DistrictType": t},
         "geometry": {"type": g, "coordinates": c}} for n, t, g, c in feats]}
    with open(path, "w") as fh:
        json.dump(fc, fh)


def _points(spark, pts):
    rows = []
    for i, (lon, lat) in enumerate(pts):
        miss = int(lon is None or lat is None)
        rows.append((i, lon, lat, miss, 0, 0, 0))
    return spark.createDataFrame(rows, "id int, Longitude double, Latitude double, missing_coords_flag tinyint, "
                                       "zero_coord_flag tinyint, positive_longitude_flag tinyint, out_of_ca_flag tinyint")


def test_fixture_rules(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "districts.geojson")
    _geojson(path)
    polys = read_geojson_polygons(spark, path, reproject_from_3857=True)
    assert {r.DistrictType: r.n for r in spatial.district_types(polys).collect()} == {"Unified": 5, "High": 1}
    uni = spatial.unified(polys)
    pts = [(-119.9, 34.1), (-119.5, 34.5), (-117.5, 34.2), (-115.8, 34.2), (-115.2, 34.2), (-120.2, 36.5),
           (-117.5, 36.5), (None, None), (-100.0, 40.0), (-119.0, 34.5)]
    expect = ["Square", None, "Triangle", "Multi", "Multi", "Alpha", None, None, None, None]
    for bound in (C.DEFAULT.spatial_broadcast_bytes, 0):  # broadcast and adaptive-shuffle paths
        params = C.Params(spatial_broadcast_bytes=bound)
        out = {r.id: r for r in spatial.district_join(_points(spark, pts), uni, params, keep_match_count=True).collect()}
        assert [out[i].DistrictName for i in range(len(pts))] == expect
        assert out[5].district_matches == 2  # overlap: smallest name wins
        assert out[7].district_match_status == "missing_coords"
        assert out[1].district_match_status == "no_unified_district"
        assert out[0].district_match_status == "matched"


def _vertices(spark, polys):
    rows = [(n, "Unified", 0, k, i, float(x), float(y)) for n, rings in polys.items() for k, r in enumerate(rings) for i, (x, y) in enumerate(r)]
    return spatial.unified(spatial.polygons_from_vertices(spark.createDataFrame(
        rows, "DistrictName string, DistrictType string, part int, ring int, idx int, x double, y double")))


def _even_odd(rings, x, y):
    """(odd crossings, on an edge) of many points, in the operator's arithmetic."""
    odd, on = np.zeros(len(x), int), np.zeros(len(x), bool)
    for r in rings:
        for (x1, y1), (x2, y2) in zip(r[:-1], r[1:]):
            if y1 != y2:
                odd += ((y1 > y) != (y2 > y)) & (x < x1 + (y - y1) * (x2 - x1) / (y2 - y1))
            on |= (((x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) == 0) & (x >= min(x1, x2)) & (x <= max(x1, x2)) & (y >= min(y1, y2)) & (y <= max(y1, y2)))
    return odd % 2 == 1, on


def test_clipped_cells_of_large_polygons(spark):
    """A coast of 5,000 vertices with a hole, and a neighbour with edges on cell
    borders; most cells are wholly inside and need no edge."""
    rng = np.random.default_rng(5)
    t = np.linspace(0, 2 * np.pi, 5001)[:-1]
    radius = 2 + 0.3 * np.sin(9 * t) + rng.uniform(-0.02, 0.02, len(t))
    coast = [(float(a), float(b)) for a, b in zip(-119 + radius * np.cos(t), 36 + radius * np.sin(t))]
    hole = [(-119.3, 35.7), (-118.7, 35.7), (-118.7, 36.3), (-119.3, 36.3), (-119.3, 35.7)]
    box = [(-118.0, 36.0), (-116.0, 36.0), (-116.0, 38.0), (-118.0, 38.0), (-118.0, 36.0)]
    polys = {"Coast": [[*coast, coast[0]], hole], "Box": [box]}
    x, y = rng.uniform(-122, -115, 4000), rng.uniform(33, 39, 4000)
    grid = [(-118 + i * 0.1, 36 + j * 0.1) for i in range(-3, 24) for j in range(-3, 24)] + coast[::50]
    x, y = np.append(x, [p[0] for p in grid]), np.append(y, [p[1] for p in grid])
    joined = spatial.district_join(_points(spark, list(zip(x.tolist(), y.tolist()))), _vertices(spark, polys), keep_match_count=True)
    got = {r.id: (r.DistrictName, r.district_matches) for r in joined.collect()}
    inside = {n: (lambda odd, on: odd & ~on)(*_even_odd(r, x, y)) for n, r in polys.items()}
    for i in range(len(x)):
        names = sorted(n for n in polys if inside[n][i])
        assert got[i] == (names[0] if names else None, len(names)), (x[i], y[i])
    cells = spatial.cell_index(spatial.polygon_edges(_vertices(spark, polys)), 0.1).selectExpr("inline(cands)")
    sizes = [len(r.edges) for r in cells.where("name = 'Coast'").collect()]
    assert sum(n == 0 for n in sizes) > len(sizes) / 2 and max(sizes) < 1000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1  # the ray is cast once


def test_adaptive_cells(spark):
    """Most points in one grid cell, many of them on one spot: no leaf holds
    more than the bound, and tasks are even."""
    rng = np.random.default_rng(6)
    spot = [(-119.05, 36.05)] * 3000
    dense = [(float(a), float(b)) for a, b in zip(rng.uniform(-119.1, -119.0, 9000), rng.uniform(36.0, 36.1, 9000))]
    wide = [(float(a), float(b)) for a, b in zip(rng.uniform(-121, -117, 600), rng.uniform(34, 38, 600))] + [(None, None)] * 5
    pts = _points(spark, spot + dense + wide)
    polys = _vertices(spark, {"A": [[(-119.08, 36.02), (-119.0, 36.0), (-119.02, 36.09), (-119.08, 36.02)]],
                              "B": [[(-120, 35), (-118, 35), (-118, 37), (-120, 37), (-120, 35)]]})
    want = sorted(map(tuple, spatial.district_join(pts, polys).collect()), key=str)
    params = C.Params(spatial_broadcast_bytes=0, spatial_cell_points=200)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = spatial.district_join(pts, polys, params)
        tasks = [r["count"] for r in joined.selectExpr("spark_partition_id() p").groupBy("p").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted(map(tuple, joined.collect()), key=str) == want
    assert max(tasks) <= 4 * sorted(tasks)[len(tasks) // 2]


def test_coordinate_systems_must_agree(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "districts.geojson")
    _geojson(path)
    assert spatial.crs_of(spatial.unified(read_geojson_polygons(spark, path, reproject_from_3857=True))) == "EPSG:4326"
    with open(path) as fh:
        body = json.load(fh)
    body["crs"] = {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::3857"}}
    with open(path, "w") as fh:
        json.dump(body, fh)
    raw = spatial.unified(read_geojson_polygons(spark, path))
    pts = _points(spark, [(-119.9, 34.1)])
    with pytest.raises(ValueError, match="EPSG:3857, points in EPSG:4326"):
        spatial.district_join(pts, raw)
    with pytest.raises(ValueError, match="points in EPSG:3857"):
        spatial.district_join(spatial.with_crs(pts, "EPSG:3857", "Longitude"), spatial.reproject_rings(raw))
    assert spatial.district_join(pts, spatial.reproject_rings(raw)).first().DistrictName == "Square"
    with pytest.raises(ValueError, match="not EPSG:3857"):
        spatial.reproject_rings(spatial.reproject_rings(raw))


def test_on_edge_excluded_and_brute_force(spark):
    verts = spark.createDataFrame(
        [("A", "Unified", 0, 0, i, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)])]
        + [("B", "Unified", 0, 0, i, float(x), float(y)) for i, (x, y) in enumerate([(1, 1), (3, 1), (2, 3), (1, 1)])],
        "DistrictName string, DistrictType string, part int, ring int, idx int, x double, y double")
    polys = spatial.unified(spatial.polygons_from_vertices(verts))
    rng = np.random.default_rng(3)
    pts = [(float(x), float(y)) for x, y in np.round(rng.uniform(-0.5, 3.5, (300, 2)), 1)]
    pts += [(2.0, 0.5), (0.0, 1.0), (1.0, 0.0), (2.0, 1.0)]  # on edges of A (and B)
    got = {r.id: r.DistrictName for r in spatial.district_join(_points(spark, pts), polys, C.Params(cell_deg=0.7)).collect()}

    def inside(poly, x, y):
        n = len(poly) - 1
        on = False
        c = 0
        for i in range(n):
            (x1, y1), (x2, y2) = poly[i], poly[i + 1]
            if (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) == 0 and min(x1, x2) <= x <= max(x1, x2) \
                    and min(y1, y2) <= y <= max(y1, y2):
                on = True
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                c += 1
        return c % 2 == 1 and not on
    A = [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]
    B = [(1, 1), (3, 1), (2, 3), (1, 1)]
    for i, (x, y) in enumerate(pts):
        names = [n for n, p in (("A", A), ("B", B)) if inside(p, x, y)]
        assert got[i] == (min(names) if names else None), (x, y)
    assert got[len(pts) - 4] is None and got[len(pts) - 3] is None
