"""Stage 5 spatial join: points within district polygons
(S8 shaping, P22, P23, J3, J4, F22-F24, A24-A29).

Plan shape. Polygons become edges, and the edges become rows of the grid cells
that need them: a cell keeps, of a polygon, the edges in its band of latitudes
that don't lie wholly to its right, plus the parity of those that do and span the
band, since every point of the cell crosses them. A cell that no edge touches is
wholly inside or outside; it is marked or left out, and its points need no test.
The cell table has one row per cell with all candidate polygons; each point
computes its own cell and joins on ``(cx, cy)``, so the left join keeps the row
count without a row id. The exact test runs once per point in higher-order
functions over the few edges left (even-odd ray casting, points on an edge
excluded, as a *within* predicate does), and the smallest matching name wins. No
shuffle of the point side when the cell table is broadcast; its size is measured
before that choice. Beyond the bound the join shuffles on adaptive cells: cells
with many points are split in four, again and again, and where even the smallest
holds too many (one spot) it is dealt over salts, all from a count of the points.

Rings carry their coordinate system in the column's metadata; a join of polygons
and points in different systems raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow import config as C
from parcelflow.functions.scalars import rows_or_null, web_mercator_to_lonlat
from parcelflow.session import cut_lineage

EDGE = "struct<x1:double,y1:double,x2:double,y2:double>"


GEOGRAPHIC, MERCATOR = "EPSG:4326", "EPSG:3857"


def with_crs(df: DataFrame, crs: str, col: str = "rings") -> DataFrame:
    """Note the coordinate system of a column in its metadata, which projections,
    joins and stage tables keep."""
    return df.withColumn(col, F.col(col).alias(col, metadata={**df.schema[col].metadata, "crs": crs}))


def crs_of(df: DataFrame, col: str = "rings", default: str = GEOGRAPHIC) -> str:
    return df.schema[col].metadata.get("crs", default)


def polygons_from_vertices(vertices: DataFrame) -> DataFrame:
    """Vertex rows ``(DistrictName, DistrictType, part, ring, idx, x, y)`` ->
    one row per district with ``rings``: array of closed rings (parts of a
    multipolygon and holes are all rings; even-odd parity handles both)."""
    rings = (vertices.groupBy("DistrictName", "DistrictType", "part", "ring")
             .agg(F.sort_array(F.collect_list(F.struct("idx", "x", "y"))).alias("pts"))
             .select("DistrictName", "DistrictType",
                     F.transform("pts", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
                     .alias("ring")))
    return rings.groupBy("DistrictName", "DistrictType").agg(F.collect_list("ring").alias("rings"))


def reproject_rings(polys: DataFrame, rings_col: str = "rings") -> DataFrame:
    """rings in EPSG:3857 metres -> EPSG:4326 degrees, per vertex."""
    if crs_of(polys, rings_col, MERCATOR) != MERCATOR:
        raise ValueError(f"rings are in {crs_of(polys, rings_col)}, not {MERCATOR}")

    def conv(p):
        lon, lat = web_mercator_to_lonlat(p["x"], p["y"])
        return F.struct(lon.alias("x"), lat.alias("y"))
    return with_crs(polys.withColumn(rings_col, F.transform(rings_col, lambda r: F.transform(r, conv))), GEOGRAPHIC, rings_col)


def unified(polys: DataFrame, kind: str = "Unified") -> DataFrame:
    """Keep one district type."""
    return polys.where(F.col("DistrictType") == kind).select("DistrictName", "rings")


def polygon_edges(polys: DataFrame) -> DataFrame:
    """Edges of every ring plus the bounding box."""
    def ring_edges(r):
        return F.transform(F.sequence(F.lit(0), F.size(r) - 2),
                           lambda i: F.struct(r[i]["x"].alias("x1"), r[i]["y"].alias("y1"),
                                              r[i + 1]["x"].alias("x2"), r[i + 1]["y"].alias("y2")))
    pts = F.flatten("rings")
    return polys.select(
        "DistrictName",
        F.flatten(F.transform("rings", ring_edges)).alias("edges"),
        F.array_min(F.transform(pts, lambda p: p["x"])).alias("minx"),
        F.array_max(F.transform(pts, lambda p: p["x"])).alias("maxx"),
        F.array_min(F.transform(pts, lambda p: p["y"])).alias("miny"),
        F.array_max(F.transform(pts, lambda p: p["y"])).alias("maxy"))


def cell_index(edges: DataFrame, cell: float) -> DataFrame:
    """One row per grid cell: ``cands`` has, of every polygon that the cell may
    lie in, its name, the parity of edges that all points of the cell cross, and
    the edges to test; without edges the cell lies wholly inside.

    Borders are compared with a margin, as a point's own cell is rounded."""
    margin = cell * 1e-9
    e = edges.select("DistrictName", "minx", F.inline("edges")).withColumns({
        "lox": F.least("x1", "x2"), "hix": F.greatest("x1", "x2"), "loy": F.least("y1", "y2"), "hiy": F.greatest("y1", "y2")})
    at = lambda c: F.floor(c / cell)
    e = (e.withColumn("cy", F.explode(F.sequence(at(F.col("loy") - margin), at(F.col("hiy") + margin))))
         .withColumn("cx", F.explode(F.sequence(at(F.col("minx") - margin), at(F.col("hix") + margin)))))
    left, low = F.col("cx") * cell - margin, F.col("cy") * cell - margin
    right, high = (F.col("cx") + 1) * cell + margin, (F.col("cy") + 1) * cell + margin
    beyond = F.col("lox") > right
    all_cross = beyond & (F.col("loy") < low) & (F.col("hiy") > high)
    touches = ~beyond & (F.col("hix") >= left) & (F.col("hiy") >= low) & (F.col("loy") <= high)
    middle_x, middle_y = (F.col("cx") + 0.5) * cell, (F.col("cy") + 0.5) * cell
    test = ~all_cross & (F.col("hix") >= left) & ~(beyond & (F.col("y1") == F.col("y2")))
    one = F.struct(*[F.col(c) for c in ("x1", "y1", "x2", "y2")])
    per = e.groupBy("DistrictName", "cx", "cy").agg(
        F.bool_or(touches).alias("touched"), (F.count_if(all_cross) % 2).cast("int").alias("parity"),
        (F.count_if(_crosses(e, middle_x, middle_y)) % 2).cast("int").alias("middle"), F.collect_list(F.when(test, one)).alias("edges"))
    none = F.array().cast(f"array<{EDGE}>")
    return (per.where("touched OR middle = 1")
            .select("cx", "cy", F.struct(F.col("DistrictName").alias("name"), F.when(F.col("touched"), F.col("parity")).otherwise(F.lit(1)).alias("parity"),
                                         F.when(F.col("touched"), F.col("edges")).otherwise(none).alias("edges")).alias("c"))
            .groupBy("cx", "cy").agg(F.collect_list("c").alias("cands")))


def _crosses(e, px: Column, py: Column) -> Column:
    """Whether the ray to the right from a point crosses the edge."""
    straddle = (e["y1"] > py) != (e["y2"] > py)
    return straddle & (px < e["x1"] + F.try_divide((py - e["y1"]) * (e["x2"] - e["x1"]), e["y2"] - e["y1"]))


def point_within(edges: Column, px: Column, py: Column, parity: Column | None = None) -> Column:
    """Even-odd ray casting from ``parity``; a point on any edge is not within."""
    def crossing(acc, e):
        return acc + F.when(_crosses(e, px, py), 1).otherwise(0)

    def on_edge(e):
        cross = (e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"])
        return ((cross == 0)
                & px.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
                & py.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))

    odd = F.aggregate(edges, F.lit(0) if parity is None else parity, crossing) % 2 == 1
    return odd & ~F.exists(edges, on_edge)


#: Halvings of a cell's side down to the smallest adaptive cell.
_HALVINGS = 6


def adaptive_cells(pts: DataFrame, points: int) -> DataFrame:
    """Leaf cells for the points' ``(_fx, _fy)``, their smallest cells: rows
    ``(cx, cy, dense, crowded)`` per grid cell that has cells to split: those with
    more than ``points`` points, as (level, x, y), and the smallest ones with more
    still, as (x, y, salts). Pre-aggregated counts; at most a cell a level for
    every ``points`` points."""
    counts = cut_lineage(pts.where("_fx IS NOT NULL").groupBy("_fx", "_fy").agg(F.count(F.lit(1)).alias("n")))
    over = None
    for level in range(_HALVINGS + 1):
        scale = 2 ** (_HALVINGS - level)
        at = [F.floor(F.col(c) / scale).alias(a) for c, a in (("_fx", "x"), ("_fy", "y"))]
        full = counts.groupBy(*at).agg(F.sum("n").alias("n")).where(F.col("n") > points).withColumn("level", F.lit(level))
        over = full if over is None else over.unionByName(full)
    at = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("level"))).cast("long")
    smallest = F.col("level") == _HALVINGS
    return cut_lineage(over.groupBy(at("x").alias("cx"), at("y").alias("cy")).agg(
        F.collect_list(F.when(~smallest, F.struct("level", "x", "y"))).alias("dense"),
        F.collect_list(F.when(smallest, F.struct("x", "y", F.ceil(F.col("n") / points).cast("int").alias("salts")))).alias("crowded")))


def _with_leaf(df: DataFrame, row_hash: Column) -> DataFrame:
    """``_level, _lx, _ly, _salt`` of each row with ``_fx, _fy, dense, crowded``."""
    def up(c: str, level: Column) -> Column:
        return F.floor(F.col(c) / F.pow(F.lit(2.0), _HALVINGS - level)).cast("long")
    inside = F.filter("dense", lambda d: (up("_fx", d["level"]) == d["x"]) & (up("_fy", d["level"]) == d["y"]))
    df = df.withColumn("_level", F.coalesce(F.size(inside), F.lit(0)))
    salts = F.filter("crowded", lambda k: (k["x"] == F.col("_fx")) & (k["y"] == F.col("_fy")))
    df = df.withColumns({"_lx": up("_fx", F.col("_level")), "_ly": up("_fy", F.col("_level")), "_salts": F.coalesce(F.get(salts, F.lit(0))["salts"], F.lit(1))})
    return df.withColumn("_salt", F.pmod(row_hash, F.col("_salts")).cast("int"))


def _adaptive_join(pts: DataFrame, cells: DataFrame, columns: list[str], points: int) -> DataFrame:
    """``pts`` with ``cands``, shuffled by leaf cells of at most ``points``."""
    pts = cut_lineage(pts)
    split = adaptive_cells(pts, max(points, pts.count() // 20_000))  # so at most 140,000 cells are split, a bounded broadcast
    split = F.broadcast(split.select(F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), "dense", "crowded"))
    pts = _with_leaf(pts.join(split, ["_cx", "_cy"], "left"), F.xxhash64(*columns))
    key = ["_level", "_lx", "_ly", "_salt"]
    leaves = pts.where("_fx IS NOT NULL").select("_cx", "_cy", *key).distinct()
    table = leaves.join(cells, (F.col("_cx") == F.col("cx")) & (F.col("_cy") == F.col("cy"))).select(*key, "cands")
    return pts.join(table, key, "left")


def _cell_table_bytes(cells: DataFrame) -> int:
    """Size estimate of the cell table (boundary side only; bounded by the
    polygon count, never by the number of points)."""
    row = cells.agg(F.sum(F.aggregate("cands", F.lit(0).cast("long"),
                                      lambda a, c: a + F.size(c["edges"]) * 32 + 64) + 32)
                    .alias("b")).first()
    return int(row["b"] or 0)


def district_join(df: DataFrame, polys: DataFrame, params: C.Params = C.DEFAULT,
                  keep_match_count: bool = False) -> DataFrame:
    """J3 + J4 + F22 + P22: ``DistrictName`` of the smallest-named Unified
    polygon containing each trusted point, and ``district_match_status``.
    Row count and order of columns are preserved; two columns are added."""
    cell = params.cell_deg
    theirs, ours = crs_of(polys), crs_of(df, "Longitude")
    if theirs != ours:
        raise ValueError(f"polygons are in {theirs}, points in {ours}")
    # the cell table is bounded by the polygons, not the points: cut it once so
    # the size check and the join read the same materialized copy
    cells = cut_lineage(cell_index(polygon_edges(polys), cell))
    bad_geo = F.greatest(*[F.col(f) for f in C.BAD_GEO_FLAGS]) == 1
    lon, lat = F.col("Longitude"), F.col("Latitude")
    pts = (df.withColumn("_cx", F.when(~bad_geo, F.floor(lon / cell)))
             .withColumn("_cy", F.when(~bad_geo, F.floor(lat / cell))))
    if _cell_table_bytes(cells) <= params.spatial_broadcast_bytes:
        joined = pts.join(F.broadcast(cells),
                          (pts["_cx"] == cells["cx"]) & (pts["_cy"] == cells["cy"]), "left")
    else:
        fine = 2 ** _HALVINGS
        within = lambda c, base: base * fine + F.least(F.greatest(F.floor((c / cell - base) * fine), F.lit(0)), F.lit(fine - 1))
        pts = pts.withColumns({"_fx": within(lon, F.col("_cx")), "_fy": within(lat, F.col("_cy"))})
        joined = _adaptive_join(pts, cells, df.columns, params.spatial_cell_points)
    hits = F.filter("cands", lambda c: point_within(c["edges"], lon, lat, c["parity"]))
    out = joined.withColumn("_hits", F.coalesce(F.transform(hits, lambda c: c["name"]), F.array().cast("array<string>")))
    out = out.withColumn("DistrictName", F.array_min("_hits"))
    extra = ["DistrictName", "district_match_status"]
    if keep_match_count:
        out = out.withColumn("district_matches", F.size("_hits"))
        extra.append("district_matches")
    status = (F.when(F.col("missing_coords_flag") == 1, "missing_coords")
              .when(bad_geo, "invalid_coords")
              .when(F.col("DistrictName").isNull(), "no_unified_district")
              .otherwise("matched"))
    out = out.withColumn("district_match_status", status)
    return out.select(*df.columns, *extra)


# ------------------------------------------------------------------ reports

def district_types(polys: DataFrame) -> DataFrame:
    """Districts per type in the boundary file."""
    return polys.groupBy("DistrictType").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "DistrictType")


def district_coverage(joined: DataFrame) -> DataFrame:
    """Rows and share (%) per match status, the share over the few statuses."""
    per = joined.groupBy("district_match_status").agg(F.count(F.lit(1)).alias("n"))
    return (per.select("district_match_status", "n", (F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())).alias("pct"))
            .orderBy(F.desc("n"), "district_match_status"))


def district_match_summary(joined: DataFrame) -> DataFrame:
    """Match rate among trusted points and the multi-match count
    (needs ``keep_match_count=True`` on the join)."""
    valid = F.col("district_match_status").isin("matched", "no_unified_district")
    matched = F.count_if(F.col("district_match_status") == "matched")
    return joined.agg(
        F.count_if(valid).alias("valid_points"),
        matched.alias("matched"),
        (matched * 100.0 / F.nullif(F.count_if(valid), F.lit(0))).alias("match_rate_pct"),
        F.count_if(F.col("district_matches") > 1).alias("multi_match_points"))


def district_modal_city(joined: DataFrame, cities: list[str] | None = None) -> DataFrame:
    """Most frequent district per city (ties -> smallest name)."""
    d = joined.where(F.col("DistrictName").isNotNull() & F.col("City").isNotNull())
    if cities is not None:
        d = d.where(F.col("City").isin(cities))
    return d.groupBy("City").agg(F.mode("DistrictName", True).alias("modal_district"))


def district_city_check(joined: DataFrame, expected: dict[str, str]) -> DataFrame:
    """The expected against the most frequent district of each listed city;
    a city without a match has none and is not ok."""
    want = joined.sparkSession.createDataFrame(list(expected.items()), "City string, expected string")
    modal = district_modal_city(joined, list(expected))  # a row a listed city
    return (F.broadcast(want).join(modal, "City", "left")
            .select("City", "expected", "modal_district", F.coalesce(F.col("expected") == F.col("modal_district"), F.lit(False)).alias("ok")))


def district_negative_control(joined: DataFrame, city: str) -> DataFrame:
    """Status counts for one city."""
    return (joined.where(F.col("City") == city).groupBy("district_match_status")
            .agg(F.count(F.lit(1)).alias("n")))


def district_top(joined: DataFrame, top: int = 10) -> DataFrame:
    """Districts with the most rows."""
    return (joined.where(F.col("DistrictName").isNotNull()).groupBy("DistrictName")
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "DistrictName").limit(top))


def top_counties(df: DataFrame, top: int = 6) -> DataFrame:
    """The ``top`` counties by rows (ties by name), as a key selector."""
    return (df.where(F.col("CountyOrParish").isNotNull()).groupBy("CountyOrParish")
            .agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "CountyOrParish").limit(top))


def district_county_rate(joined: DataFrame, top: int = 6) -> DataFrame:
    """Matched and missing-coordinate rates (%) in the largest counties,
    from one aggregate."""
    per = joined.where(F.col("CountyOrParish").isNotNull()).groupBy("CountyOrParish").agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count_if(F.col("district_match_status") == "matched") * 100.0 / rows_or_null()).alias("matched_pct"),
        (F.count_if(F.col("district_match_status") == "missing_coords") * 100.0 / rows_or_null()).alias("missing_pct"))
    return per.orderBy(F.desc("rows"), "CountyOrParish").limit(top)
