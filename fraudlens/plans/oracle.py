"""DuckDB twins of the Spark queries (the correctness oracle).

``TX`` is the SQL form of ``fraudlens.sources.tables.transactions``; the
dimension CTEs render the same literal rows as ``fraudlens.sources.dims``.
"""
from __future__ import annotations

from fraudlens.sources.dims import SQL_DIMS
from fraudlens.sources.tables import MERCHANT_EPOCH, SIM_START

TX_CTES = f"""
e_ AS (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
x_ AS (SELECT *, CASE k % 3 WHEN 0 THEN user_id WHEN 1 THEN user_id % 10 ELSE user_id % 50 END AS x FROM e_),
transactions AS (
 SELECT CAST(event_id AS BIGINT) AS transaction_id,
  CAST(ts AS TIMESTAMP) AS transaction_date,
  CAST(user_id AS BIGINT) AS customer_id,
  CASE WHEN k = 99 THEN NULL ELSE CAST(value AS DOUBLE) END AS amount,
  CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '{SIM_START}')) / 1000000) AS BIGINT) AS date_in_sec,
  CAST(date_diff('day', CAST(TIMESTAMP '{SIM_START}' AS DATE), CAST(ts AS DATE)) + 1 AS INTEGER) AS day_no,
  CAST(k % 30 + 1 AS BIGINT) AS merchant_id,
  CASE WHEN event_type = 'view' THEN CAST((k % 30 + 1) * 1000 + k % 5 AS BIGINT) END AS pos_id,
  CAST(DATE '{MERCHANT_EPOCH}' + CAST((k % 30 + 1) * 97 AS INTEGER) AS TIMESTAMP) AS merchant_established_date,
  CAST(5000 + k % 7 AS INTEGER) AS MCCs,
  concat('CAT_', CAST(k % 7 AS VARCHAR)) AS merchant_category,
  CASE WHEN event_type = 'view' THEN NULL
       ELSE concat(CAST(11 + 20 * (x % 10) AS VARCHAR), '.', CAST(x % 200 AS VARCHAR), '.',
                   CAST(k % 3 AS VARCHAR), '.1') END AS IP_address,
  CASE k % 4 WHEN 0 THEN 'Store Credit Card' WHEN 1 THEN 'Cashback' WHEN 2 THEN 'Travel' ELSE NULL END
       AS type_of_credit_card_used,
  CASE WHEN event_type = 'view' THEN 'card present' ELSE 'card not present' END AS card_present_or_not,
  CASE WHEN k % 4 = 0 THEN CAST(user_id % 30 + 1 AS BIGINT) END AS store_card_merchant_id,
  CAST(CASE WHEN event_type = 'error' AND k < 20 THEN 1 ELSE 0 END AS INTEGER) AS is_fraud
 FROM x_)"""

DIM_CTES = ",\n".join(f"{name} AS ({sql})" for name, sql in SQL_DIMS.items())


def with_tx(body: str, dims: bool = False, extra: str = "") -> str:
    """``WITH <transactions>[, <dims>][, extra] <body>``."""
    parts = [TX_CTES]
    if dims:
        parts.append(DIM_CTES)
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n" + body


DERIVED_CTES = """
profiles AS (SELECT customer_id, list_sort(list_distinct(list(type_of_credit_card_used))) AS credit_card_owned,
                    max(store_card_merchant_id) AS store_card_merchant_id,
                    CAST(customer_id * 37 % 100 AS DOUBLE) AS location_x, CAST(customer_id * 61 % 100 AS DOUBLE) AS location_y
             FROM transactions GROUP BY customer_id),
mpos AS (SELECT merchant_id, pos_id, CAST(pos_id * 13 % 100 AS DOUBLE) AS location_x, CAST(pos_id * 29 % 100 AS DOUBLE) AS location_y
         FROM (SELECT DISTINCT merchant_id, pos_id FROM transactions WHERE pos_id IS NOT NULL)),
card_pref AS (SELECT * FROM (VALUES ('Cashback', 'CAT_0', 'CAT_1'), ('Travel', 'CAT_2', 'CAT_3'),
                              ('Store Credit Card', 'CAT_4', 'CAT_5'))
              AS t(card_category, prefer_consumption_category_1, prefer_consumption_category_2))"""

IPN = """CASE WHEN IP_address IS NULL THEN NULL ELSE
 CAST(split_part(IP_address, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(IP_address, '.', 2) AS BIGINT) * 65536
 + CAST(split_part(IP_address, '.', 3) AS BIGINT) * 256 + CAST(split_part(IP_address, '.', 4) AS BIGINT) END"""

SEC_MIDNIGHT = "CAST(coalesce(hour({c}) * 3600 + minute({c}) * 60 + second({c}), -999) AS INTEGER)"
