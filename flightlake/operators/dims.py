"""Reference tables: aircraft, airports, countries, states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.functions import clean
from flightlake.plans.sequence import first_per_key

# ISO3 codes of state boundaries and the country code they belong to. Codes that map to themselves are left out.
ISO3_REMAP = {
    "ABW": "ANT", "AIA": "GBR", "ALD": "AUS", "ANT": "NLD", "ASM": "USA", "ATC": "AUS", "BLM": "FRA",
    "BMU": "GBR", "CLP": "CHL", "COK": "NZL", "CSI": "SLV", "CUW": "NLD", "CYM": "GBR", "CYN": "CYP",
    "ESB": "ESP", "GGY": "GBR", "GIB": "GBR", "GUM": "USA", "HKG": "CHN", "HMD": "AUS", "IMN": "GBR",
    "IOA": "GBR", "IOT": "GBR", "JEY": "GBR", "KAB": "KAZ", "KAS": "KAZ", "MAC": "CHN", "MNP": "USA",
    "MSR": "GBR", "NFK": "AUS", "PGA": "PNG", "PSX": "PSE", "PYF": "FRA", "SAH": "ESH", "SDS": "SDN",
    "SGS": "GBR", "SHN": "GBR", "SOL": "SLB", "SPM": "FRA", "SXM": "NLD", "TCA": "GBR", "UMI": "USA",
    "USG": "USA", "VGB": "GBR", "VIR": "USA", "WSB": "WSM",
}
# Fixed value: the feature class of first-level states and provinces.
STATE_FEATURE = "Admin-1 states provinces"


def lookup(df: DataFrame, key: str, value: str, order: str | None = None) -> DataFrame:
    """Two-column lookup ``(key, value)`` of trimmed texts; the last of a repeated key wins.

    Without an ``order`` column the largest value counts as last.
    """
    rows = df.select(clean.stripped(key).alias("key"), clean.stripped(value).alias("value"), *([order] if order else []))
    return rows.groupBy("key").agg(F.max_by("value", order or "value").alias("value"))


def with_lookup(df: DataFrame, table: DataFrame, on: Column, out: str) -> DataFrame:
    """Left lookup of an expression."""
    return (
        df.withColumn("_on", on)
        .join(table.select(F.col("key").alias("_on"), F.col("value").alias(out)), "_on", "left")
        .drop("_on")
    )


def with_country_of_registration(df: DataFrame, prefixes: DataFrame, names: DataFrame, registration: str = "registration") -> DataFrame:
    """Add ``country_iso2`` and ``country_of_reg`` from the registration's prefix.

    The prefix is the text before a hyphen, else the longest of the first three,
    two or one characters that the table knows. Country codes longer than two
    characters count as unknown. Each candidate is one equi-join to the small table.
    """
    text = clean.clean_text(registration)
    dashed = text.contains("-")
    candidates = [
        F.when(dashed, clean.stripped(F.substring_index(text, "-", 1))).otherwise(F.substring(text, 1, 3)),
        F.when(~dashed, F.substring(text, 1, 2)),
        F.when(~dashed, F.substring(text, 1, 1)),
    ]
    out = df
    for i, candidate in enumerate(candidates):
        hit = prefixes.select(F.col("key").alias(f"_p{i}"), F.struct(F.col("value").alias("iso2")).alias(f"_hit{i}"))
        out = out.withColumn(f"_p{i}", F.nullif(candidate, F.lit(""))).join(hit, f"_p{i}", "left")
    iso2 = clean.clean_text(F.coalesce("_hit0", "_hit1", "_hit2")["iso2"])
    out = out.withColumn("country_iso2", F.when(F.length(iso2) <= 2, iso2)).drop(*[f"_{k}{i}" for i in range(3) for k in ("p", "hit")])
    return with_lookup(out, names, F.col("country_iso2"), "country_of_reg")


def aircraft_rows(raw: DataFrame, prefixes: DataFrame, names: DataFrame) -> DataFrame:
    """Aircraft master texts in the shape of the aircraft table; rows without an id are dropped."""
    typed = raw.select(
        F.lower(clean.clean_text("icao24")).alias("icao24"),
        clean.clean_text("registration").alias("registration"),
        clean.clean_text("manufacturername").alias("manufacturername"),
        clean.clean_text("model").alias("model"),
        clean.clean_text("typecode").alias("type_code"),
        clean.type_code_patch("icaoaircrafttype").alias("icao_aircraft_type"),
        clean.clean_text("categorydescription").alias("weight_category"),
        clean.clean_text("operator").alias("airline_name"),
        clean.clean_text("operatorcallsign").alias("operatorcallsign"),
        clean.clean_text("operatoricao").alias("airline_icao"),
        clean.operator_code_patch("operatoriata").alias("airline_iata"),
        clean.clean_text("engines").alias("engines"),
        clean.to_day("firstflightdate").alias("first_flight_date"),
        *[c for c in raw.columns if c == "position"],
    ).filter(F.col("icao24").isNotNull())
    return with_country_of_registration(typed, prefixes, names).withColumn("is_active", F.lit(True))


def airport_rows(raw: DataFrame, regions: DataFrame) -> DataFrame:
    """Airport texts in the shape of the airport table; rows without an ident are dropped."""
    texts = {
        "ident": "ident", "airport_iata_code": "iata_code", "airport_icao_code": "icao_code", "airport_name": "name",
        "airport_type": "type", "municipality": "municipality", "iso_country": "iso_country", "continent": "continent",
        "iso_region": "iso_region",
    }
    typed = raw.select(
        *[clean.clean_text(src).alias(name) for name, src in texts.items()],
        clean.yes("scheduled_service").alias("is_commercial"),
        clean.to_double("latitude_deg").cast("decimal(9,6)").alias("latitude_deg"),
        clean.to_double("longitude_deg").cast("decimal(9,6)").alias("longitude_deg"),
        *[c for c in raw.columns if c == "position"],
    ).filter(F.col("ident").isNotNull())
    return with_lookup(typed, regions, F.col("iso_region"), "region_name")


def country_rows(raw: DataFrame) -> DataFrame:
    """Country boundary attributes in the shape of the country table; nameless rows are dropped."""
    return raw.select(
        clean.iso_code("ISO_A2").alias("iso2"),
        clean.iso_code("ISO_A3").alias("iso3"),
        clean.clean_text("NAME").alias("country_name"),
        clean.first_text("FORMAL_EN", "NAME").alias("formal_name"),
        clean.clean_text("CONTINENT").alias("continent"),
        clean.clean_text("SUBREGION").alias("subregion"),
        F.col("LABEL_X").try_cast("decimal(9,6)").alias("centroid_lon"),
        F.col("LABEL_Y").try_cast("decimal(9,6)").alias("centroid_lat"),
        clean.population("POP_EST").alias("population"),
        F.col("wkt").alias("boundary"),
    ).filter(F.col("country_name").isNotNull())


def iso3_table(spark, remap: dict[str, str] = ISO3_REMAP) -> DataFrame:
    return spark.createDataFrame(sorted(remap.items()), "key string, value string")


def with_known_iso3(df: DataFrame, remap: DataFrame, countries: DataFrame, code: str = "country_iso3") -> DataFrame:
    """Remapped country code, NULL unless the country table has it."""
    known = countries.select(F.col("iso3").alias(code)).filter(F.col(code).isNotNull()).distinct().withColumn("_known", F.lit(True))
    mapped = with_lookup(df, remap, F.col(code), "_to").withColumn(code, F.coalesce("_to", code)).drop("_to")
    return mapped.join(known, code, "left").withColumn(code, F.when(F.col("_known"), F.col(code))).drop("_known")


def missing_iso3(states: DataFrame, countries: DataFrame, code: str = "adm0_a3") -> DataFrame:
    """State country codes that the country table does not have."""
    have = countries.select(F.col("iso3").alias(code)).filter(F.col(code).isNotNull())
    return states.select(code).filter(F.col(code).isNotNull()).distinct().join(have, code, "left_anti")


def state_rows(raw: DataFrame, remap: DataFrame, countries: DataFrame) -> DataFrame:
    """State boundary attributes in the shape of the state table.

    Only first-level states with a code, a name (their own or their country's)
    and a boundary are kept.
    """
    typed = raw.filter(F.col("featurecla") == STATE_FEATURE).select(
        clean.clean_text("adm1_code").alias("adm1_code"),
        clean.clean_text("iso_3166_2").alias("iso_3166_2"),
        clean.first_text("name", "admin").alias("state_name"),
        clean.clean_text("type_en").alias("state_type"),
        clean.clean_text("adm0_a3").alias("country_iso3"),
        clean.clean_text("iso_a2").alias("country_iso2"),
        clean.clean_text("admin").alias("country_name"),
        F.col("longitude").try_cast("decimal(9,6)").alias("centroid_lon"),
        F.col("latitude").try_cast("decimal(9,6)").alias("centroid_lat"),
        F.col("wkt").alias("boundary"),
        *[c for c in raw.columns if c == "position"],
    )
    drawn = F.col("boundary").isNotNull() & ~F.upper("boundary").contains("EMPTY")
    return with_known_iso3(typed.filter(F.col("adm1_code").isNotNull() & F.col("state_name").isNotNull() & drawn), remap, countries)


def first_wins(rows: DataFrame, key: tuple[str, ...], order: tuple[str, ...] = ("position",)) -> DataFrame:
    """First row of each key in input order."""
    return first_per_key(rows, list(key), list(order)).drop(*[c for c in order if c == "position"])


def airport_load_counts(airports: DataFrame) -> DataFrame:
    return airports.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("airport_iata_code").alias("with_iata"),
        F.count_if("is_commercial").alias("commercial"),
        (F.count("airport_iata_code") - F.countDistinct("airport_iata_code")).alias("repeated_iata"),
    )


def boundary_load_counts(table: DataFrame, boundary: str = "boundary", iso2: str = "iso2") -> DataFrame:
    return table.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(boundary).alias("with_boundary"),
        F.count_if(F.col(iso2).isNull()).alias("no_iso2"),
    )


def sample_listing(df: DataFrame, column: str, values: list, order: list[str], k: int = 10) -> DataFrame:
    """First ``k`` rows of some groups, a listing for people to look at."""
    return df.filter(F.col(column).isin(*values)).orderBy(*order).limit(k)


def distinct_keys(df: DataFrame, key: str, approximate: bool = False) -> DataFrame:
    return df.agg((F.approx_count_distinct(key) if approximate else F.countDistinct(key)).alias("distinct_keys"))
