"""Small lookups: regions of countries, exchange rates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldvein.operators.sizes import broadcast_if, counted_small

#: a lookup given as local rows may be broadcast up to this many rows
MAX_LOOKUP_ROWS = 10_000

REGION_SCHEMA = pa.schema(
    [("country", pa.string()), ("state", pa.string()), ("region", pa.string())]
)
RATE_SCHEMA = pa.schema([("unit_price_currency", pa.string()), ("rate_eur", pa.float64())])

# The region of each state, by country.
REGIONS = {
    "India": {
        "MH": "West", "GJ": "West", "RJ": "West", "GA": "West",
        "KA": "South", "TN": "South", "TS": "South", "AP": "South", "KL": "South",
        "UP": "North", "PB": "North", "HR": "North", "HP": "North", "UK": "North",
        "DL": "North",
        "WB": "East", "BR": "East", "OD": "East", "JH": "East",
        "AS": "Northeast", "AR": "Northeast", "MN": "Northeast", "ML": "Northeast",
        "MZ": "Northeast", "NL": "Northeast", "TR": "Northeast", "SK": "Northeast",
        "MP": "Central", "CG": "Central",
    },
    "Australia": {
        "VIC": "SouthEast", "WA": "West", "NSW": "East", "QLD": "NorthEast",
        "SA": "South", "TAS": "South", "ACT": "East", "NT": "North",
    },
    "United Kingdom": {
        "ENG": "England", "WLS": "Wales", "NIR": "Northern Ireland", "SCT": "Scotland",
    },
    "United States": {
        "MA": "NorthEast", "FL": "South", "NJ": "NorthEast", "CA": "West",
        "NY": "NorthEast", "TX": "South",
    },
    "United Arab Emirates": {
        "AUH": "Abu Dhabi", "DXB": "Dubai", "SHJ": "Sharjah", "AJM": "Ajman",
        "RAK": "Ras Al Khaimah", "FUJ": "Fujairah", "UAQ": "Umm Al Quwain",
    },
    "Singapore": {"SG": "Singapore"},
    "Canada": {
        "BC": "West", "AB": "West", "SK": "West", "MB": "Central", "ON": "East",
        "QC": "East", "NB": "East", "PE": "East", "NS": "East",
    },
}

# The base currency, and a rate the published rates lack.
RATE_OVERRIDES = {"EUR": 1.0, "AED": 4.34}


def local_frame(spark: SparkSession, rows: Sequence[Sequence], schema: pa.Schema) -> DataFrame:
    """Local rows as a DataFrame of known size, with no Python in its tasks."""
    columns = [[row[i] for row in rows] for i in range(len(schema))]
    return spark.createDataFrame(pa.table(columns, schema=schema))


def local_lookup(spark: SparkSession, rows: Iterable[Sequence], schema: pa.Schema) -> DataFrame:
    """Local rows as a lookup to join with; small enough ones are broadcast.

    The row count is known here, so the hint rests on a checked size.  A larger
    lookup is left to Spark, which measures it and may shuffle instead.
    """
    rows = list(rows)
    df = local_frame(spark, rows, schema)
    return F.broadcast(df) if len(rows) <= MAX_LOOKUP_ROWS else df


def region_rows() -> list[tuple[str, str, str]]:
    return [
        (country, state, region)
        for country, states in REGIONS.items()
        for state, region in states.items()
    ]


def region_lookup(spark: SparkSession) -> DataFrame:
    return local_lookup(spark, region_rows(), REGION_SCHEMA)


def rates_lookup(
    spark: SparkSession,
    rates: Mapping[str, float] | DataFrame,
    overrides: Mapping[str, float] = RATE_OVERRIDES,
) -> DataFrame:
    """Rates per currency, one row each, with the overrides in place.

    ``rates`` is a mapping or a table with the columns of ``RATE_SCHEMA``.  A
    table that quotes a currency twice is an error when it is used: such a row
    would multiply order lines.  A currency may hold most of the lines, so a
    table counted to be small is broadcast rather than shuffled against them.
    """
    if isinstance(rates, Mapping):
        merged = {**rates, **overrides}
        rows = [(currency, float(rate)) for currency, rate in merged.items()]
        return local_lookup(spark, rows, RATE_SCHEMA)
    named = list(overrides)
    quoted = rates.where(~F.col("unit_price_currency").isin(named)) if named else rates
    once = (
        quoted.groupBy("unit_price_currency")
        .agg(F.count("*").alias("quotes"), F.max("rate_eur").cast("double").alias("rate_eur"))
        .select(
            "unit_price_currency",
            F.when(F.col("quotes") == 1, F.col("rate_eur"))
            .otherwise(F.raise_error(F.lit("a currency has more than one rate")))
            .alias("rate_eur"),
        )
    )
    if named:
        fixed = [(currency, float(rate)) for currency, rate in overrides.items()]
        once = once.unionByName(local_frame(rates.sparkSession, fixed, RATE_SCHEMA))
    return broadcast_if(once, counted_small(rates, MAX_LOOKUP_ROWS))
