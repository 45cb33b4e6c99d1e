import dataclasses

import pytest
from pyspark.sql import functions as F

from flightlake.functions import geometry as g
from flightlake.operators import events, geo
from flightlake.plans import lookup
from flightlake.session import cut_lineage

# Hand-made outlines around known cities: convex, concave, with a hole, two-part.
SHAPES = [
    ("COUNTRY", 1, "Nigeria", "POLYGON ((2.7 6.2, 4.5 4.2, 8.5 4.5, 14 11, 13 13.8, 4 13.7, 2.7 9, 2.7 6.2))"),
    ("COUNTRY", 2, "Kenya", "POLYGON ((34 -1, 41.8 -4.6, 41 3.9, 36 4.5, 37.5 1.5, 34 1, 34 -1))"),
    ("COUNTRY", 3, "Egypt", "MULTIPOLYGON (((25 22, 36 22, 32.3 29.9, 32.3 31.2, 25 31.6, 25 22)), ((32.6 30, 34.2 31.3, 34.9 29.5, 33.9 27.8, 32.6 30)))"),
    ("COUNTRY", 4, "South Africa", "POLYGON ((17 -29, 20 -35, 28 -33, 33 -27, 31 -22, 20 -27, 17 -29), (27 -29, 29.4 -29.5, 28.5 -30.6, 27 -29))"),
    ("STATE", 101, "Lagos", "POLYGON ((2.7 6.37, 4.3 6.3, 4.3 6.7, 2.7 6.7, 2.7 6.37))"),
    ("STATE", 102, "Kano", "POLYGON ((7.7 10.6, 9.4 10.6, 9.4 12.6, 7.7 12.6, 7.7 10.6))"),
    ("STATE", 103, "Federal Capital", "POLYGON ((6.8 8.4, 7.7 8.4, 7.7 9.3, 6.8 9.3, 6.8 8.4))"),
    ("STATE", 104, "Nowhere", "POLYGON ((-31 -1, -29 -1, -29 1, -31 1, -31 -1))"),
]
PROBES = [
    (3.39, 6.45, "COUNTRY", "Nigeria"), (36.82, -1.29, "COUNTRY", "Kenya"), (31.24, 30.06, "COUNTRY", "Egypt"),
    (28.04, -26.20, "COUNTRY", "South Africa"), (-30.0, 0.0, "COUNTRY", None), (28.4, -29.6, "COUNTRY", None), (33.7, 29.5, "COUNTRY", "Egypt"),
    (38.0, 2.2, "COUNTRY", "Kenya"), (36.4, 2.0, "COUNTRY", None),
    (3.967, 6.536, "STATE", "Lagos"), (7.49, 9.07, "STATE", "Federal Capital"), (8.52, 12.0, "STATE", "Kano"), (36.82, -1.29, "STATE", None),
]


@pytest.fixture(scope="module")
def territories(spark):
    return geo.boundary_edges(spark.createDataFrame(SHAPES, "level string, territory_id int, territory_name string, wkt string"))


@pytest.mark.parametrize("size", [0.5, 1.0, 5.0, 50.0])
def test_probes(spark, territories, size):
    index = geo.build_cells(territories, size)
    points = spark.createDataFrame([(i, x, y) for i, (x, y, _, _) in enumerate(PROBES)], "i int, longitude double, latitude double")
    found = {r["i"]: r for r in geo.locate(points, index).collect()}
    assert len(found) == len(PROBES)
    for i, (_, _, level, name) in enumerate(PROBES):
        hit = found[i]["country" if level == "COUNTRY" else "state"]
        assert (hit["name"] if hit else None) == name


def test_state_over_country_and_ocean(spark, territories):
    index = geo.build_cells(territories, 2.0)
    points = spark.createDataFrame([(3.967, 6.536), (10.0, 8.0), (-30.0, 0.0), (None, None)], "longitude double, latitude double")
    got = {(r["longitude"]): (r["territory_type"], r["territory_name"], r["country_name"]) for r in geo.with_territory(points, index).collect()}
    assert got[3.967] == ("STATE", "Lagos", "Nigeria")
    assert got[10.0] == ("COUNTRY", "Nigeria", "Nigeria")
    # A state without a country around it does not count.
    assert got[-30.0] == (None, None, None) and got[None] == (None, None, None)


def brute(spark, territories, n=400):
    points = spark.range(n).select("id", ((F.col("id") * 7919) % 6000 / 100 - 20.003).alias("longitude"), ((F.col("id") * 104729) % 7000 / 100 - 35.007).alias("latitude"))
    by_hand = points.join(territories.filter("level = 'COUNTRY'"), g.inside(F.col("edges"), F.col("longitude"), F.col("latitude")))
    return points, sorted((r["id"], r["territory_id"]) for r in by_hand.select("id", "territory_id").collect())


def test_cells_equal_brute_force(spark, territories):
    points, want = brute(spark, territories)
    for size in (0.7, 3.0):
        got = geo.locate(points, geo.build_cells(territories, size)).filter("country is not null").select("id", "country.id").collect()
        assert sorted(tuple(r) for r in got) == want


def test_broadcast_and_salted_joins_agree(spark, territories, monkeypatch):
    points, want = brute(spark, territories)
    index = geo.stored(geo.build_cells(territories, 2.0))
    assert 0 < index.stored_bytes < lookup.BROADCAST_BYTES
    near = geo.locate(points, index)
    assert "BroadcastHashJoin" in near._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(lookup, "SALTS", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = geo.locate(points, index)
        plan = salted._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "_salt" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
        got = salted.filter("country is not null").select("id", "country.id").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert sorted(tuple(r) for r in got) == want


def test_disc(spark, territories, rows):
    spots = spark.createDataFrame([(1, 2.6, 7.0), (2, 2.0, 7.0), (3, 5.0, 8.0)], "i int, lon double, lat double")
    countries = territories.filter("level = 'COUNTRY'")
    for size in (0.1, 1.0, 7.0):
        near = geo.near_territories(spots, geo.build_cells(countries, size, reach=0.2), 0.2, "lon", "lat").select("i", "territory_name")
        assert rows(near) == [(1, "Nigeria"), (3, "Nigeria")]
    with pytest.raises(ValueError):
        geo.near_territories(spots, geo.build_cells(countries, 1.0), 0.2, "lon", "lat")


def test_centroid(spark):
    df = spark.createDataFrame([("POLYGON ((0 0, 4 0, 4 2, 0 2, 0 0))",)], "wkt string")
    c = df.select(g.centroid(g.wkt_edges("wkt")).alias("c")).first()["c"]
    assert (c["lon"], c["lat"]) == (2.0, 1.0)


@pytest.fixture(scope="module")
def airports(spark):
    spots = [(f"A{i:03d}", f"C{i % 70}", (i * 53 % 360) - 180 + 0.3, (i * 31 % 170) - 85 + 0.7, i % 4 != 0) for i in range(120)]
    spots += [("Z1", "TIE", 10.0, 10.0, True), ("Z0", "TIF", 12.0, 10.0, True), ("ZZ", None, 11.0, 10.0, True)]
    return spark.createDataFrame(spots, "ident string, airport_iata_code string, longitude_deg double, latitude_deg double, is_commercial boolean")


def test_nearest_airport_is_exact(spark, airports):
    usable = [r for r in airports.collect() if r["is_commercial"] and r["airport_iata_code"]]
    spots = [(i, float((i * 47) % 360 - 180), float((i * 29) % 180 - 90)) for i in range(150)] + [(900, 11.0, 10.0), (901, None, 5.0)]
    points = spark.createDataFrame(spots, "i int, longitude double, latitude double")
    got = {r["i"]: r["origin_iata"] for r in geo.with_nearest_airport(points, geo.build_airport_grids(airports)).collect()}
    for i, x, y in spots:
        want = None
        if x is not None:
            want = min(usable, key=lambda a: (((x - a["longitude_deg"]) ** 2 + (y - a["latitude_deg"]) ** 2) ** 0.5, a["ident"]))["airport_iata_code"]
        assert got[i] == want
    assert got[900] == "TIF"


def test_nearest_airport_among_clusters(spark):
    """Clusters, airports on one spot, ties, and repeated spots; measured and unmeasured grids agree with a plain search."""
    import random

    rng = random.Random(5)
    spots = [(f"c{i}", f"C{i}", 40 + rng.gauss(0, 0.2), 30 + rng.gauss(0, 0.2)) for i in range(300)]
    spots += [(f"s{i}", f"S{i}", -70.0, -10.0) for i in range(40)] + [(f"f{i}", f"F{i}", rng.uniform(-180, 180), rng.uniform(-90, 90)) for i in range(30)]
    spots += [("t1", "T1", 100.0, 0.0), ("t0", "T0", 102.0, 0.0), ("x", "X", None, 1.0)]
    airports = spark.createDataFrame([(*s, True) for s in spots], "ident string, airport_iata_code string, longitude_deg double, latitude_deg double, is_commercial boolean")
    ask = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(120)] + [(40 + rng.gauss(0, 1), 30 + rng.gauss(0, 1)) for _ in range(60)] + [(101.0, 0.0), (-70.0, -10.0), (-70.0, -10.0)]
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(ask)], "i int, longitude double, latitude double")
    fixed = [s for s in spots if s[2] is not None]
    want = [min(fixed, key=lambda a: (((x - a[2]) ** 2 + (y - a[3]) ** 2) ** 0.5, a[0]))[1] for x, y in ask]
    grids = geo.build_airport_grids(airports)
    for index in (grids, geo.stored(grids)):
        got = {r["i"]: r["origin_iata"] for r in geo.with_nearest_airport(points, index).collect()}
        assert [got[i] for i in range(len(ask))] == want
    assert not [f for f in grids.cells.schema if f.dataType.typeName() == "array"]
    none = geo.with_nearest_airport(points, geo.build_airport_grids(airports.limit(0)))
    assert none.count() == len(ask) and none.filter("origin_iata IS NOT NULL").count() == 0


def test_widest_cells_are_met_by_key(spark, airports):
    points = spark.createDataFrame([(1, 11.0, 10.0), (2, None, 1.0), (3, -170.0, -80.0)], "i int, longitude double, latitude double")
    found = geo.with_nearest_airport(points, geo.stored(geo.build_airport_grids(airports)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    got = {r["i"]: r["origin_iata"] for r in found.collect()}
    assert got[1] == "TIF" and got[2] is None and got[3] is not None


def test_only_departures_get_an_origin(spark, airports):
    df = spark.createDataFrame([("DEPARTED", 10.1, 10.0), ("LANDED", 10.1, 10.0), ("DEPARTED", None, None)], "event_type string, longitude double, latitude double")
    got = sorted((r["event_type"], str(r["longitude"]), r["origin_iata"]) for r in events.with_origin(df, geo.build_airport_grids(airports)).collect())
    assert got == [("DEPARTED", "10.1", "TIE"), ("DEPARTED", "None", None), ("LANDED", "10.1", None)]


def test_detailed_outline_stays_small_per_cell(spark):
    """A jagged outline of 3000 vertices: exact, and a cell keeps its own edges and a few flips only."""
    import math

    ring = [(40 * math.cos(a) * (1 + 0.1 * math.sin(37 * a)), 30 * math.sin(a) * (1 + 0.1 * math.sin(53 * a))) for a in (2 * math.pi * i / 3000 for i in range(3000))]
    wkt = "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in [*ring, ring[0]]) + "))"
    shape = geo.boundary_edges(spark.createDataFrame([("COUNTRY", 1, "Jagged", wkt)], "level string, territory_id int, territory_name string, wkt string"))
    index = geo.stored(geo.build_cells(shape, 4.0))
    sizes = index.cells.select(F.explode("entries").alias("t")).select(F.size("t.edges").alias("e"), F.size("t.flips").alias("f"))
    assert sizes.agg(F.max("e")).first()[0] < 300 and sizes.agg(F.max("f")).first()[0] < 100
    points = spark.range(500).select("id", ((F.col("id") * 7919) % 9001 / 100 - 45.003).alias("longitude"), ((F.col("id") * 104729) % 7001 / 100 - 35).alias("latitude"))
    got = {r["id"] for r in geo.locate(points, index).filter("country is not null").collect()}
    outline = cut_lineage(shape.select("edges"))
    want = {r["id"] for r in points.join(outline).filter(g.inside(F.col("edges"), F.col("longitude"), F.col("latitude"))).collect()}
    assert got == want and 100 < len(want) < 450


def test_crowded_cells_are_divided(spark):
    """A very detailed outline in one corner: edges per cell are bounded, coarse cells stay as they are, and answers equal a plain test."""
    import math

    ring = [(3 + math.cos(a) * (1 + 0.2 * math.sin(61 * a)), 2 + math.sin(a) * (1 + 0.2 * math.sin(83 * a))) for a in (2 * math.pi * i / 4000 for i in range(4000))]
    wkt = "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in [*ring, ring[0]]) + "))"
    rows = [("COUNTRY", 1, "Jagged", wkt), ("COUNTRY", 2, "Plain", "POLYGON ((-40 -40, -20 -40, -20 -20, -40 -20, -40 -40))"), ("STATE", 3, "Inner", "POLYGON ((2.5 1.5, 3.5 1.5, 3.5 2.5, 2.5 2.5, 2.5 1.5))")]
    shape = geo.boundary_edges(spark.createDataFrame(rows, "level string, territory_id int, territory_name string, wkt string"))
    index = geo.build_cells(shape, 8.0, most=200)
    sizes = index.cells.select("depth", F.aggregate("entries", F.lit(0), lambda n, t: n + F.size(t["edges"])).alias("n"))
    assert index.divided is not None and sizes.agg(F.max("n")).first()[0] <= 200
    depths = {r[0] for r in sizes.select("depth").distinct().collect()}
    assert 0 in depths and max(depths) >= 3
    points = spark.range(600).select("id", ((F.col("id") * 7919) % 3001 / 1000 + 1.5).alias("longitude"), ((F.col("id") * 104729) % 3001 / 1000 + 0.5).alias("latitude"))
    points = points.unionByName(spark.createDataFrame([(900, -30.0, -30.0), (901, -10.0, -30.0), (902, None, 1.0)], points.schema))
    outline = cut_lineage(shape.select("level", "territory_id", "edges"))
    for chosen in (index, dataclasses.replace(index, stored_bytes=None)):
        got = {(r["id"], r["country"] and r["country"]["id"], r["state"] and r["state"]["id"]) for r in geo.locate(points, chosen).collect()}
        inside = points.join(outline).filter(g.inside(F.col("edges"), F.col("longitude"), F.col("latitude"))).collect()
        hit = lambda i, level: next((r["territory_id"] for r in inside if r["id"] == i and r["level"] == level), None)
        assert got == {(i, hit(i, "COUNTRY"), hit(i, "STATE")) for i in [*range(600), 900, 901, 902]}


def test_outline_beyond_the_antimeridian(spark):
    rows = [("COUNTRY", 1, "East", "MULTIPOLYGON (((170 0, 190 0, 190 10, 170 10, 170 0), (175 2, 185 2, 185 4, 175 4, 175 2)), ((100 0, 101 0, 101 1, 100 0)))"),
            ("COUNTRY", 2, "West", "POLYGON ((-185 20, -175 20, -175 30, -185 30, -185 20))")]
    shape = geo.boundary_edges(spark.createDataFrame(rows, "level string, territory_id int, territory_name string, wkt string"))
    index = geo.build_cells(shape, 5.0)
    spots = [(172.0, 1.0, 1), (-172.0, 1.0, 1), (-176.0, 3.0, None), (178.0, 3.0, None), (-169.0, 1.0, None), (100.9, 0.5, 1), (178.0, 25.0, 2), (-178.0, 25.0, 2), (0.0, 1.0, None)]
    points = spark.createDataFrame([(i, x, y) for i, (x, y, _) in enumerate(spots)], "i int, longitude double, latitude double")
    got = {r["i"]: r["country"] and r["country"]["id"] for r in geo.locate(points, index).collect()}
    assert [got[i] for i in range(len(spots))] == [want for _, _, want in spots]


def test_outlines_stay_as_drawn_beyond_the_antimeridian(spark):
    rows = [(1, "POLYGON ((174 0, 182 0, 182 6, 174 6, 174 0))"), (2, "POLYGON ((-182 0, -174 0, -174 6, -182 6, -182 0))"), (3, "POLYGON ((0 0, 8 0, 8 6, 0 6, 0 0))")]
    shapes = geo.boundary_edges(spark.createDataFrame(rows, "i int, wkt string")).withColumn("c", g.centroid(F.col("edges")))
    assert {r["i"]: (len(r["edges"]), r["c"]["lon"], r["c"]["lat"]) for r in shapes.collect()} == {1: (4, 178.0, 3.0), 2: (4, -178.0, 3.0), 3: (4, 4.0, 3.0)}
