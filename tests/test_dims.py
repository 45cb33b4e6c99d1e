from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from flightlake.operators import dims
from flightlake.sources import files


def texts(spark, columns, data):
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns))


@pytest.mark.parametrize("registration,iso2,name", [
    ("5N-JJJ", "NG", "Nigeria"), ("GABCD", "GB", "United Kingdom"), ("N12345", "US", "United States"), ("V5-ANF", "NA", "Namibia"),
    ("GALX", "LX", None), (" 5N-A ", "NG", "Nigeria"), ("QQ-1", None, None), ("ZZZZ", None, None), (None, None, None), ("nan", None, None), ("X-1", None, None),
])
def test_country_of_registration(spark, registration, iso2, name):
    prefixes = dims.lookup(texts(spark, ["Prefix", "CountryISO2"], [
        ("5N", "NG"), ("G", "GB"), ("GAL", "LX"), ("N", "US"), ("V5", "NA"), ("X", "TOOLONG")]), "Prefix", "CountryISO2")
    names = dims.lookup(texts(spark, ["ISO", "Name"], [("NG", "Nigeria"), ("GB", "United Kingdom"), ("US", "United States"), ("NA", "Namibia")]), "ISO", "Name")
    df = spark.createDataFrame([(registration,)], "registration string")
    got = dims.with_country_of_registration(df, prefixes, names).first()
    assert (got["country_iso2"], got["country_of_reg"]) == (iso2, name)


def test_aircraft_file(spark, tmp_path):
    head = " ICAO24 ,registration,manufacturername,model,typecode,icaoaircrafttype,operator,operatorcallsign,operatoricao,operatoriata,firstflightdate,engines,categoryDescription"
    body = ["AB12CD,5N-JJJ,Boeing,737,B738,L2J,Air X,AX,AXX,AX,8/15/2017,2,Heavy", "ab12cd,G-AAAA,Other,,,,,,,,,,", "nan,G-BBBB,,,,,,,,,,,", "ff,,,,,,\"Two\"\"s, Air\",,,,bad,,"]
    (tmp_path / "a.csv").write_text("\n".join([head, *body]))
    raw = files.aircraft_file(spark, str(tmp_path / "a.csv"))
    none = spark.createDataFrame([], "key string, value string")
    rows = dims.first_wins(dims.aircraft_rows(raw, none, none), ("icao24",))
    got = {r["icao24"]: r for r in rows.collect()}
    assert set(got) == {"ab12cd", "ff"}
    assert got["ab12cd"]["manufacturername"] == "Boeing" and got["ab12cd"]["first_flight_date"] == date(2017, 8, 15) and got["ab12cd"]["weight_category"] == "Heavy"
    assert got["ff"]["airline_name"] == 'Two"s, Air' and got["ff"]["registration"] is None and got["ff"]["first_flight_date"] is None
    assert dims.distinct_keys(raw, "icao24").first()[0] == 4


def test_airport_file_keeps_na(spark, tmp_path):
    head = "id,ident,type,name,latitude_deg,longitude_deg,continent,iso_country,iso_region,municipality,scheduled_service,icao_code,iata_code"
    body = ["1,FYWH,large_airport,Windhoek,-22.48,17.47,AF,NA,NA-KH,Windhoek,yes,FYWH,WDH", "2,FYWH,small,Copy,0,0,AF,NA,NA-KH,,no,,", "3,,x,,,,,,,,,,", "4,X1,small,,bad,1,NA,US,US-XX,,no,,"]
    (tmp_path / "a.csv").write_text("\n".join([head, *body]))
    regions = dims.lookup(texts(spark, ["code", "name"], [("NA-KH", " Khomas ")]), "code", "name")
    got = {r["ident"]: r for r in dims.first_wins(dims.airport_rows(files.airport_file(spark, str(tmp_path / "a.csv")), regions), ("ident",)).collect()}
    assert set(got) == {"FYWH", "X1"}
    w = got["FYWH"]
    assert (w["iso_country"], w["region_name"], w["is_commercial"], w["latitude_deg"]) == ("NA", "Khomas", True, Decimal("-22.480000"))
    assert got["X1"]["latitude_deg"] is None and got["X1"]["continent"] == "NA" and got["X1"]["airport_iata_code"] is None
    counts = dims.airport_load_counts(spark.createDataFrame(list(got.values()))).first()
    assert (counts["total"], counts["with_iata"], counts["commercial"]) == (2, 1, 1)


def test_lookup_last_wins(spark):
    df = spark.createDataFrame([(" A ", "x", 1), ("A", "b", 2)], "k string, v string, n int")
    assert dims.lookup(df, "k", "v", "n").first()["value"] == "b"


def test_countries(spark):
    raw = spark.createDataFrame([
        ("-99", "KOS", "Kosovo", None, "Europe", "South", 20.9, 42.6, 1.8e6, "POLYGON EMPTY"), ("CN-TW", "TWN", "Taiwan", "Republic", "Asia", "East", 121.0, 23.6, -1.0, None),
        ("FR", "FRA", " ", None, None, None, None, None, None, None),
    ], "ISO_A2 string, ISO_A3 string, NAME string, FORMAL_EN string, CONTINENT string, SUBREGION string, LABEL_X double, LABEL_Y double, POP_EST double, wkt string")
    got = {r["country_name"]: r for r in dims.country_rows(raw).collect()}
    assert set(got) == {"Kosovo", "Taiwan"}
    assert got["Kosovo"]["iso2"] is None and got["Kosovo"]["formal_name"] == "Kosovo" and got["Kosovo"]["population"] == 1800000
    assert got["Taiwan"]["iso2"] == "TW" and got["Taiwan"]["formal_name"] == "Republic" and got["Taiwan"]["population"] is None
    assert dims.boundary_load_counts(dims.country_rows(raw)).first().asDict() == {"total": 2, "with_boundary": 1, "no_iso2": 1}


def test_states(spark):
    columns = "featurecla string, adm1_code string, iso_3166_2 string, name string, type_en string, adm0_a3 string, iso_a2 string, admin string, longitude double, latitude double, wkt string"
    shape = "POLYGON ((0 0, 1 0, 1 1, 0 0))"
    row = lambda code, name="Lagos", iso3="NGA", wkt=shape, kind=dims.STATE_FEATURE: (kind, code, "NG-LA", name, "State", iso3, "NG", "Nigeria", 3.4, 6.5, wkt)
    raw = spark.createDataFrame([row("N1"), row("N2", name=None, iso3="HKG"), row("N3", iso3="XXX"), row("N4", wkt=None), row("N5", kind="other"), row(None), row("N6", wkt="POLYGON EMPTY")], columns)
    countries = spark.createDataFrame([("NGA",), ("CHN",), (None,)], "iso3 string")
    got = {r["adm1_code"]: (r["state_name"], r["country_iso3"]) for r in dims.state_rows(raw, dims.iso3_table(spark), countries).collect()}
    assert got == {"N1": ("Lagos", "NGA"), "N2": ("Nigeria", "CHN"), "N3": ("Lagos", None)}
    assert sorted(r[0] for r in dims.missing_iso3(raw, countries).collect()) == ["HKG", "XXX"]


def test_sample_listing(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("c", 3)], "g string, n int")
    assert [r["n"] for r in dims.sample_listing(df, "g", ["a", "b"], ["g"], 1).collect()] == [1]
    assert df.agg(F.count("g")).first()[0] == 3
