"""Small dimension and config tables.

The reference reads GeoIP, time-zone, holiday and schema information from
files or per-row libraries that are not shipped.  Here they are input
DataFrames; the defaults below are the fixed test dimensions (FIXTURES.md
section 3).  Each default also renders as a SQL ``VALUES`` list so the
DuckDB oracle sees identical rows.
"""
from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values: test dimensions --------------------------------------
# IPv4 first-octet ranges -> country (191 and up deliberately uncovered)
IP_RANGE_OCTETS = [
    (11, 30, "GB"), (31, 50, "FR"), (51, 70, "DE"), (71, 90, "US"), (91, 110, "JP"),
    (111, 130, "IN"), (131, 150, "BR"), (151, 170, "ZA"), (171, 190, "AU"),
]
# country -> first time zone (AU omitted on purpose: falls back to UTC)
COUNTRY_TIMEZONES = [
    ("GB", "Europe/London"), ("FR", "Europe/Paris"), ("DE", "Europe/Berlin"),
    ("US", "America/New_York"), ("JP", "Asia/Tokyo"), ("IN", "Asia/Kolkata"),
    ("BR", "America/Noronha"), ("ZA", "Africa/Johannesburg"),
]
# (country, holiday date)
HOLIDAYS = [
    ("GB", "2024-01-01"), ("US", "2024-01-01"), ("US", "2024-01-15"),
    ("IN", "2024-01-26"), ("JP", "2024-01-08"),
]
# schema sheet: column_name, data_type, nullable, is_categorical
DATA_SCHEMA = [
    ("transaction_id", "int", "N", "N"),
    ("transaction_date", "datetime", "N", "N"),
    ("customer_id", "int", "N", "N"),
    ("amount", "float", "Y", "N"),
    ("date_in_sec", "int", "N", "N"),
    ("day_no", "int", "N", "N"),
    ("merchant_id", "int", "N", "Y"),
    ("pos_id", "int", "Y", "N"),
    ("merchant_established_date", "datetime", "N", "N"),
    ("MCCs", "category", "N", "Y"),
    ("merchant_category", "string", "N", "Y"),
    ("IP_address", "string", "Y", "N"),
    ("type_of_credit_card_used", "string", "Y", "Y"),
    ("card_present_or_not", "string", "N", "Y"),
    ("store_card_merchant_id", "int", "Y", "N"),
    ("is_fraud", "boolean", "N", "Y"),
    ("risk_score", "decimal", "Y", "N"),
    ("postcode_latest", "string", "Y", "N"),
]
# binning config: bin group -> column
COLUMNS_TO_BIN = [("bin_2", "amount"), ("bin_3", "MCCs"), ("bin_5", "date_in_sec"), ("bin_5", "pos_id")]
# drop list for modelling
DOMAIN_DROP = ["transaction_id", "transaction_date", "merchant_established_date", "date_in_sec",
               "IP_address", "store_card_merchant_id"]
# London postcode areas (inner then outer) for the in-London flag
LONDON_INNER = ["E", "EC", "N", "NW", "SE", "SW", "W", "WC"]
LONDON_OUTER = ["BR", "CR", "DA", "EN", "HA", "IG", "KT", "RM", "SM", "TN", "TW", "UB", "WD"]
# strings treated as NULL by replace_null_like_values
NULL_LIKE = ["NA", "N/A", "null", "NULL", "-", "", " ", "--", "na", "NaN", "missing", "Missing"]
# ---------------------------------------------------------------------------


def ip_ranges_rows():
    return [(a << 24, ((b + 1) << 24) - 1, cc) for a, b, cc in IP_RANGE_OCTETS]


def _sql_lit(v):
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def values_sql(rows, columns, casts=None) -> str:
    """``SELECT ... FROM (VALUES ...) t(cols)`` for the oracle."""
    body = ", ".join("(" + ", ".join(_sql_lit(v) for v in r) + ")" for r in rows)
    casts = casts or {}
    proj = ", ".join(f"CAST({c} AS {casts[c]}) AS {c}" if c in casts else c for c in columns)
    return f"SELECT {proj} FROM (VALUES {body}) AS t({', '.join(columns)})"


def literal_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """Literal rows as a table of known small size (rows from ``createDataFrame`` have no size
    statistics), so that Spark broadcasts it by size."""
    names = [f.split()[0] for f in schema.split(",")]
    text = json.dumps([dict(zip(names, r)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{re.sub(r' (?=[a-z]+(,|$))', ':', schema)}>>")))


def ip_ranges(spark: SparkSession) -> DataFrame:
    return literal_table(spark, ip_ranges_rows(), "ip_lo bigint, ip_hi bigint, country_code string")


def country_timezone(spark: SparkSession) -> DataFrame:
    return literal_table(spark, COUNTRY_TIMEZONES, "country_code string, timezone string")


def holidays(spark: SparkSession) -> DataFrame:
    df = literal_table(spark, HOLIDAYS, "country_code string, holiday string")
    return df.selectExpr("country_code", "to_date(holiday) AS holiday_date")


def data_schema(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        DATA_SCHEMA, "column_name string, data_type string, nullable string, is_categorical string")


def columns_to_bin(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COLUMNS_TO_BIN, "bin string, column_name string")


SQL_DIMS = {
    "ip_ranges": values_sql(ip_ranges_rows(), ["ip_lo", "ip_hi", "country_code"],
                            {"ip_lo": "BIGINT", "ip_hi": "BIGINT"}),
    "country_timezone": values_sql(COUNTRY_TIMEZONES, ["country_code", "timezone"]),
    "holidays": values_sql(HOLIDAYS, ["country_code", "holiday_date"], {"holiday_date": "DATE"}),
    "data_schema": values_sql(DATA_SCHEMA, ["column_name", "data_type", "nullable", "is_categorical"]),
    "columns_to_bin": values_sql(COLUMNS_TO_BIN, ["bin", "column_name"]),
}
