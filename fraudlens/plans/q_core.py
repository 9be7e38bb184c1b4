"""Registered queries: windows (W), joins (J), dates (D), scalar expressions (E)."""
from __future__ import annotations

from pyspark.sql import functions as F

from fraudlens.functions import dates as D
from fraudlens.functions import ip as IP
from fraudlens.functions import strings as S
from fraudlens.operators import joins as J
from fraudlens.operators import windows as W
from fraudlens.operators.encode import label_encode_column, onehot_encode_column
from fraudlens.operators.rules import holiday_buffer_flag
from fraudlens.plans.oracle import DERIVED_CTES, IPN, SEC_MIDNIGHT, with_tx
from fraudlens.plans.registry import register, tx
from fraudlens.sources import derived, dims

WS = (1, 5, 12, 28, 60)
DAY_US = 86_400_000_000

# ------------------------------------------------------------------ windows


def _w1_sql():
    cols = ",\n ".join(
        f"CAST(count(DISTINCT CASE WHEN IP_address IS NOT NULL AND trim(IP_address) <> '' THEN IP_address END) "
        f"OVER (PARTITION BY customer_id ORDER BY epoch_us(transaction_date) RANGE BETWEEN {w * DAY_US} PRECEDING "
        f"AND CURRENT ROW) AS INTEGER) AS customer_id_distinct_ip_{w}d" for w in WS)
    return with_tx(f"SELECT transaction_id, {cols} FROM transactions")


@register("w1_distinct_ip_windows", _w1_sql())
def q_w1(spark, sf):
    x = W.add_distinct_ip_window(tx(spark, sf).select("transaction_id", "transaction_date", "customer_id", "IP_address"))
    return x.select("transaction_id", *[f"customer_id_distinct_ip_{w}d" for w in WS])


def _w2_sql():
    fr = "OVER (PARTITION BY customer_id ORDER BY epoch_us(transaction_date) RANGE BETWEEN {} PRECEDING AND CURRENT ROW)"
    cols = []
    for w in WS:
        cols.append(f"CASE WHEN count(amount) {fr.format(w * DAY_US)} > 0 THEN sum(CAST(round(amount * 100.0) AS BIGINT)) "
                    f"{fr.format(w * DAY_US)} / count(amount) {fr.format(w * DAY_US)} / 100.0 END AS customer_id_ma_amount_{w}d")
        cols.append(f"CAST(count(*) {fr.format(w * DAY_US)} AS BIGINT) AS customer_id_ma_count_{w}d")
    return with_tx("SELECT transaction_id, " + ", ".join(cols) + " FROM transactions")


@register("w2_moving_amount_count", _w2_sql())
def q_w2(spark, sf):
    x = W.add_ma_trade_info_by_id(tx(spark, sf).select("transaction_id", "transaction_date", "customer_id", "amount"))
    cols = []
    for w in WS:
        cols.append(F.col(f"customer_id_ma_amount_{w}d"))
        cols.append(F.col(f"customer_id_ma_count_{w}d"))
    return x.select("transaction_id", *cols)


@register("w3_sec_since_last_trade", with_tx("""
SELECT transaction_id, CAST(coalesce(floor((epoch_us(transaction_date) - lag(epoch_us(transaction_date))
  OVER (PARTITION BY customer_id ORDER BY epoch_us(transaction_date), transaction_id)) / 1000000), 0) AS BIGINT)
  AS customer_id_sec_since_last_trade FROM transactions"""))
def q_w3(spark, sf):
    return W.add_sec_since_last_trade(tx(spark, sf)).select("transaction_id", "customer_id_sec_since_last_trade")


@register("w4_seconds_since_last_ip", with_tx("""
SELECT transaction_id, CASE WHEN IP_address IS NULL THEN 0.0 ELSE coalesce((epoch_us(transaction_date)
  - lag(epoch_us(transaction_date)) OVER (PARTITION BY customer_id, IP_address ORDER BY transaction_date, transaction_id))
  / 1e6, 0.0) END AS seconds_since_last_ip FROM transactions"""))
def q_w4(spark, sf):
    return W.add_time_since_last_ip_per_customer(tx(spark, sf)).select("transaction_id", "seconds_since_last_ip")


@register("w5_rapid_transactions", with_tx("""
SELECT is_fraud, round(100.0 * (n - n_rapid) / n, 4) AS pct_not_rapid, round(100.0 * n_rapid / n, 4) AS pct_rapid
FROM (SELECT is_fraud, CAST(sum(CASE WHEN coalesce(d <= 30, false) THEN 1 ELSE 0 END) AS BIGINT) AS n_rapid, count(*) AS n
      FROM (SELECT is_fraud, (epoch_us(transaction_date) - lag(epoch_us(transaction_date)) OVER
                (PARTITION BY customer_id ORDER BY epoch_us(transaction_date), transaction_id)) / 60e6 AS d
            FROM transactions) GROUP BY is_fraud)"""))
def q_w5(spark, sf):
    return W.rapid_share_by_label(tx(spark, sf))


@register("w6_minutes_between_fraud_customer_trades", with_tx("""
SELECT customer_id, transaction_id, round(m, 4) AS minutes_since_previous FROM (
 SELECT t.customer_id, t.transaction_id, (epoch_us(transaction_date) - lag(epoch_us(transaction_date)) OVER
   (PARTITION BY t.customer_id ORDER BY epoch_us(transaction_date), transaction_id)) / 60e6 AS m
 FROM transactions t WHERE t.customer_id IN (SELECT DISTINCT customer_id FROM transactions WHERE is_fraud = 1
                                             ORDER BY customer_id LIMIT 100))
WHERE m IS NOT NULL"""))
def q_w6(spark, sf):
    x = W.minutes_between_fraud_customer_trades(tx(spark, sf))
    return x.select("customer_id", "transaction_id", F.round("minutes_since_previous", 4).alias("minutes_since_previous"))


@register("w7_before_first_fraud", with_tx("""
SELECT customer_id, CAST(first_rn - 1 AS BIGINT) AS transactions_before_fraud,
       round(hours, 4) AS time_to_first_fraud, round(avg_amt, 4) AS avg_amount_before_fraud FROM (
 SELECT customer_id, max(first_rn) AS first_rn,
        (max(CASE WHEN rn = first_rn THEN us END) - min(us)) / 3.6e9 AS hours,
        avg(CASE WHEN rn < first_rn THEN amount END) AS avg_amt
 FROM (SELECT *, min(CASE WHEN is_fraud = 1 THEN rn END) OVER (PARTITION BY customer_id) AS first_rn FROM
        (SELECT customer_id, amount, is_fraud, epoch_us(transaction_date) AS us,
                row_number() OVER (PARTITION BY customer_id ORDER BY epoch_us(transaction_date), transaction_id) AS rn
         FROM transactions))
 WHERE first_rn IS NOT NULL AND rn <= first_rn GROUP BY customer_id)
WHERE first_rn > 1"""))
def q_w7(spark, sf):
    return W.transactions_before_first_fraud(tx(spark, sf))


@register("w8_time_position", with_tx("""
SELECT transaction_id, CAST(row_number() OVER (ORDER BY transaction_date, transaction_id) - 1 AS BIGINT) AS position
FROM transactions"""))
def q_w8(spark, sf):
    return W.add_time_position(tx(spark, sf).select("transaction_id", "transaction_date")).select("transaction_id", "position")


# ------------------------------------------------------------------ joins

@register("j1_left_lookup_customer_profile", with_tx("""
SELECT t.transaction_id, p.location_x, p.location_y, p.store_card_merchant_id AS profile_store_card_merchant_id
FROM transactions t LEFT JOIN profiles p ON t.customer_id = p.customer_id""", extra=DERIVED_CTES))
def q_j1(spark, sf):
    t = tx(spark, sf)
    p = derived.customer_profiles(t).select("customer_id", "location_x", "location_y",
                                            F.col("store_card_merchant_id").alias("profile_store_card_merchant_id"))
    return J.left_lookup(t.select("transaction_id", "customer_id"), p, "customer_id").drop("customer_id")


@register("j3_ip_used_by_many", with_tx("""
SELECT t.transaction_id,
  CAST(coalesce(CAST(c.n >= 2 AS INTEGER), 0) AS INTEGER) AS IP_used_by_2_customer_id_or_more,
  CAST(coalesce(CAST(c.n >= 3 AS INTEGER), 0) AS INTEGER) AS IP_used_by_3_customer_id_or_more,
  CAST(coalesce(CAST(c.n >= 5 AS INTEGER), 0) AS INTEGER) AS IP_used_by_5_customer_id_or_more
FROM transactions t LEFT JOIN (SELECT IP_address, count(DISTINCT customer_id) AS n FROM transactions
                               WHERE IP_address IS NOT NULL GROUP BY 1) c ON t.IP_address = c.IP_address"""))
def q_j3(spark, sf):
    x = J.add_ip_used_by_many(tx(spark, sf).select("transaction_id", "customer_id", "IP_address"), [2, 3, 5])
    return x.drop("customer_id", "IP_address")


_LOCAL = f"""
ipn AS (SELECT transaction_id, transaction_date, IP_address, {IPN} AS ipn FROM transactions),
cc AS (SELECT ipn.*, r.country_code AS IP_address_country_code FROM ipn LEFT JOIN ip_ranges r ON ipn.ipn BETWEEN r.ip_lo AND r.ip_hi),
tzj AS (SELECT cc.*, CASE WHEN cc.IP_address_country_code IS NULL THEN NULL ELSE coalesce(z.timezone, 'UTC') END AS timezone
        FROM cc LEFT JOIN country_timezone z ON cc.IP_address_country_code = z.country_code),
loc AS (SELECT *, timezone(timezone, timezone('UTC', transaction_date)) AS country_code_date FROM tzj)"""


def _local_spark(spark, sf):
    x = tx(spark, sf).select("transaction_id", "transaction_date", "IP_address")
    x = J.add_ip_country(x, dims.ip_ranges(spark))
    x = J.add_country_timezone(x, dims.country_timezone(spark))
    return x.withColumn("country_code_date", D.local_time("transaction_date", "timezone"))


@register("j4_ip_country", with_tx("SELECT transaction_id, IP_address_country_code FROM cc", dims=True, extra=_LOCAL))
def q_j4(spark, sf):
    x = tx(spark, sf).select("transaction_id", "IP_address")
    return J.add_ip_country(x, dims.ip_ranges(spark)).select("transaction_id", "IP_address_country_code")


@register("j5_country_timezone", with_tx("SELECT transaction_id, IP_address_country_code, timezone FROM tzj",
                                         dims=True, extra=_LOCAL))
def q_j5(spark, sf):
    return _local_spark(spark, sf).select("transaction_id", "IP_address_country_code", "timezone")


@register("d2_local_time", with_tx(f"""
SELECT transaction_id, country_code_date, {SEC_MIDNIGHT.format(c='country_code_date')} AS country_code_date_sec_since_midnight
FROM loc""", dims=True, extra=_LOCAL))
def q_d2(spark, sf):
    x = _local_spark(spark, sf)
    return x.select("transaction_id", "country_code_date",
                    D.sec_since_midnight("country_code_date").alias("country_code_date_sec_since_midnight"))


@register("j6_is_gb_bank_holiday", with_tx("""
SELECT transaction_id, CAST(CASE WHEN CAST(transaction_date AS DATE) IN
  (SELECT holiday_date FROM holidays WHERE country_code = 'GB') THEN 1 ELSE 0 END AS INTEGER) AS is_GB_bank_holiday
FROM transactions""", dims=True))
def q_j6(spark, sf):
    x = J.add_is_bank_holiday(tx(spark, sf).select("transaction_id", "transaction_date"), dims.holidays(spark), "GB")
    return x.select("transaction_id", "is_GB_bank_holiday")


@register("j7_holiday_of_ip_country", with_tx("""
SELECT transaction_id,
  CAST(CASE WHEN IP_address_country_code IS NULL OR IP_address_country_code NOT IN (SELECT country_code FROM holidays) THEN NULL
       WHEN EXISTS (SELECT 1 FROM holidays h WHERE h.country_code = cc.IP_address_country_code
                    AND h.holiday_date = CAST(cc.transaction_date AS DATE)) THEN 1 ELSE 0 END AS INTEGER)
    AS bank_holiday_of_IP_country,
  CASE WHEN IP_address_country_code IS NULL THEN NULL
       WHEN IP_address_country_code NOT IN (SELECT country_code FROM holidays) THEN 'unsupported'
       WHEN EXISTS (SELECT 1 FROM holidays h WHERE h.country_code = cc.IP_address_country_code
                    AND h.holiday_date = CAST(cc.transaction_date AS DATE)) THEN 'holiday' ELSE 'no holiday' END
    AS bank_holiday_of_IP_country_status
FROM cc""", dims=True, extra=_LOCAL))
def q_j7(spark, sf):
    x = J.add_ip_country(tx(spark, sf).select("transaction_id", "transaction_date", "IP_address"), dims.ip_ranges(spark))
    x = J.add_bank_holiday_by_country_code(x, dims.holidays(spark))
    return x.select("transaction_id", "bank_holiday_of_IP_country", "bank_holiday_of_IP_country_status")


@register("j9_pos_within_radius", with_tx("""
SELECT t.transaction_id, t.customer_id, t.merchant_id, m.pos_id AS near_pos_id,
       round(sqrt(pow(p.location_x - m.location_x, 2) + pow(p.location_y - m.location_y, 2)), 4) AS distance
FROM transactions t JOIN profiles p ON t.customer_id = p.customer_id JOIN mpos m ON t.merchant_id = m.merchant_id
WHERE t.card_present_or_not <> 'card not present'
  AND sqrt(pow(p.location_x - m.location_x, 2) + pow(p.location_y - m.location_y, 2)) < 60""", extra=DERIVED_CTES))
def q_j9(spark, sf):
    t = tx(spark, sf)
    return J.pos_within_radius(t, derived.customer_profiles(t), derived.merchant_pos(t), radius=60.0)


@register("j10_candidate_cards", with_tx("""
SELECT t.transaction_id,
  CASE WHEN coalesce(list_contains(p.credit_card_owned, 'Store Credit Card') AND p.store_card_merchant_id = t.merchant_id, false)
       THEN ['Store Credit Card']
       ELSE coalesce((SELECT list_sort(list_distinct(list(cp.card_category))) FROM card_pref cp
                      WHERE list_contains(p.credit_card_owned, cp.card_category)
                        AND (cp.prefer_consumption_category_1 = t.merchant_category
                             OR cp.prefer_consumption_category_2 = t.merchant_category)), []) END AS candidate_cards
FROM transactions t LEFT JOIN profiles p ON t.customer_id = p.customer_id""", extra=DERIVED_CTES))
def q_j10(spark, sf):
    t = tx(spark, sf)
    return J.candidate_cards(t, derived.customer_profiles(t), derived.card_preferences(spark))


@register("j11_test_then_cash_out", with_tx("""
SELECT a.transaction_id AS test_transaction_id, b.transaction_id AS cash_out_transaction_id, b.day_no
FROM transactions a JOIN transactions b ON a.customer_id = b.customer_id
  AND a.type_of_credit_card_used = b.type_of_credit_card_used
  AND b.day_no BETWEEN a.day_no + 1 AND a.day_no + 1 + 7
WHERE a.is_fraud = 1 AND a.amount < 5"""))
def q_j11(spark, sf):
    t = tx(spark, sf)
    tests = t.where((F.col("is_fraud") == 1) & (F.col("amount") < 5))
    return J.cash_out_matches(tests, t, gap_days=1, window_days=7)


@register("j12_membership_flags", with_tx("""
SELECT transaction_id,
  CAST(CASE WHEN customer_id IN (SELECT customer_id FROM transactions WHERE is_fraud = 1) THEN 1 ELSE 0 END AS INTEGER) AS customer_has_fraud,
  CAST(CASE WHEN merchant_id IN (SELECT store_card_merchant_id FROM transactions WHERE store_card_merchant_id IS NOT NULL)
       THEN 1 ELSE 0 END AS INTEGER) AS merchant_issues_cards
FROM transactions"""))
def q_j12(spark, sf):
    t = tx(spark, sf)
    frauders = t.where(F.col("is_fraud") == 1).select("customer_id")
    issuers = t.where(F.col("store_card_merchant_id").isNotNull()).select("store_card_merchant_id")
    x = J.flag_membership(t.select("transaction_id", "customer_id", "merchant_id"), frauders, "customer_id", "customer_has_fraud")
    x = J.flag_membership(x, issuers, "merchant_id", "merchant_issues_cards")
    return x.select("transaction_id", "customer_has_fraud", "merchant_issues_cards")


@register("j12_semi_anti_fraud_customers", with_tx("""
SELECT 'semi' AS kind, count(*) AS n FROM transactions WHERE customer_id IN (SELECT customer_id FROM transactions WHERE is_fraud = 1)
UNION ALL
SELECT 'anti', count(*) FROM transactions WHERE customer_id NOT IN (SELECT customer_id FROM transactions WHERE is_fraud = 1)"""))
def q_j12b(spark, sf):
    t = tx(spark, sf)
    fr = t.where(F.col("is_fraud") == 1).select("customer_id")
    a = J.semi(t, fr, "customer_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit("semi").alias("kind"), "n")
    b = J.anti(t, fr, "customer_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit("anti").alias("kind"), "n")
    return a.unionByName(b)


# ------------------------------------------------------------------ dates

@register("d1_parse_dates", with_tx("""
SELECT transaction_id, try_strptime(strftime(transaction_date, '%d/%m/%Y %H:%M:%S'), '%d/%m/%Y %H:%M:%S') AS parsed_date,
       CAST(NULL AS TIMESTAMP) AS parsed_bad FROM transactions"""))
def q_d1(spark, sf):
    t = tx(spark, sf)
    return t.select("transaction_id", D.parse_dates(F.date_format("transaction_date", "dd/MM/yyyy HH:mm:ss")).alias("parsed_date"),
                    D.parse_dates(F.col("IP_address")).alias("parsed_bad"))


@register("d3_sec_since_midnight", with_tx(
    f"SELECT transaction_id, {SEC_MIDNIGHT.format(c='transaction_date')} AS transaction_date_sec_since_midnight FROM transactions"))
def q_d3(spark, sf):
    return tx(spark, sf).select("transaction_id", D.sec_since_midnight("transaction_date").alias("transaction_date_sec_since_midnight"))


@register("d4_is_weekend", with_tx(
    "SELECT transaction_id, CAST(coalesce(isodow(transaction_date) - 1 >= 5, false) AS INTEGER) AS is_weekend FROM transactions"))
def q_d4(spark, sf):
    return tx(spark, sf).select("transaction_id", D.is_weekend("transaction_date").alias("is_weekend"))


@register("d5_weekday_flags", with_tx("SELECT transaction_id, " + ", ".join(
    f"CAST(coalesce(isodow(transaction_date) - 1 = {i}, false) AS INTEGER) AS local_is_{n}" for i, n in enumerate(D.WEEKDAYS))
    + " FROM transactions"))
def q_d5(spark, sf):
    return tx(spark, sf).select("transaction_id", *[c.alias(n) for n, c in D.weekday_flags("transaction_date").items()])


@register("d6_day_month", with_tx("""SELECT transaction_id, CAST(dayofmonth(transaction_date) AS INTEGER) AS transaction_date_day,
  CAST(month(transaction_date) AS INTEGER) AS transaction_date_month FROM transactions"""))
def q_d6(spark, sf):
    return tx(spark, sf).select("transaction_id", *[c.alias(n) for n, c in D.day_and_month("transaction_date").items()])


@register("d7_is_night", with_tx("SELECT transaction_id, CAST(coalesce(hour(transaction_date) <= 6, false) AS INTEGER) AS is_night FROM transactions"))
def q_d7(spark, sf):
    return tx(spark, sf).select("transaction_id", D.is_night("transaction_date").alias("is_night"))


@register("d8_time_parts", with_tx("""SELECT transaction_id, CAST(hour(transaction_date) AS INTEGER) AS transaction_hour,
  CAST(dayofmonth(transaction_date) AS INTEGER) AS transaction_day, CAST(isodow(transaction_date) - 1 AS INTEGER) AS transaction_dayofweek,
  CAST(month(transaction_date) AS INTEGER) AS transaction_month FROM transactions"""))
def q_d8(spark, sf):
    return tx(spark, sf).select("transaction_id", *[c.alias(n) for n, c in D.time_parts("transaction_date").items()])


@register("d9_days_established", with_tx("""SELECT transaction_id,
  CAST(date_diff('day', CAST(merchant_established_date AS DATE), DATE '2025-01-01') AS INTEGER) AS established_period_in_day
  FROM transactions"""))
def q_d9(spark, sf):
    return tx(spark, sf).select("transaction_id", D.days_since("merchant_established_date", "2025-01-01").alias("established_period_in_day"))


@register("d10_merchant_age", with_tx("""SELECT transaction_id,
  CAST(floor(floor(floor((epoch_us(transaction_date) - epoch_us(merchant_established_date)) / 1000000) / 86400) / 365) AS INTEGER)
  AS merchant_age FROM transactions"""))
def q_d10(spark, sf):
    return tx(spark, sf).select("transaction_id", D.merchant_age_years("transaction_date", "merchant_established_date").alias("merchant_age"))


@register("d11_shopping_season", with_tx("""SELECT transaction_id, CAST(coalesce((month(transaction_date) = 11 AND dayofmonth(transaction_date) >= 24)
  OR month(transaction_date) = 12 OR (month(transaction_date) = 1 AND dayofmonth(transaction_date) <= 5), false) AS INTEGER)
  AS is_shopping_season FROM transactions"""))
def q_d11(spark, sf):
    return tx(spark, sf).select("transaction_id", D.is_shopping_season("transaction_date").alias("is_shopping_season"))


@register("d12_elapsed_columns", with_tx("""SELECT transaction_id,
  CAST(date_diff('day', DATE '2024-01-01', CAST(transaction_date AS DATE)) + 1 AS INTEGER) AS day_no,
  CAST(floor((epoch_us(transaction_date) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1000000) AS BIGINT) AS date_in_sec
  FROM transactions"""))
def q_d12(spark, sf):
    return tx(spark, sf).select("transaction_id", *[c.alias(n) for n, c in D.elapsed("transaction_date", "2024-01-01 00:00:00").items()])


@register("d13_seconds_to_timestamp", with_tx(
    "SELECT transaction_id, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(date_in_sec) AS sim_timestamp FROM transactions"))
def q_d13(spark, sf):
    return tx(spark, sf).select("transaction_id", D.seconds_to_ts("date_in_sec", "2024-01-01 00:00:00").alias("sim_timestamp"))


@register("d14_shift_to_weekend", with_tx("""SELECT transaction_id, CASE WHEN isodow(transaction_date) - 1 < 5
  THEN transaction_date + to_days(CAST(5 - (isodow(transaction_date) - 1) AS INTEGER)) ELSE transaction_date END AS weekend_date
  FROM transactions"""))
def q_d14(spark, sf):
    return tx(spark, sf).select("transaction_id", D.shift_to_weekend("transaction_date").alias("weekend_date"))


@register("d15_holiday_buffer", with_tx("""
SELECT transaction_id, CAST(CASE WHEN EXISTS (SELECT 1 FROM holidays h WHERE CAST(t.transaction_date AS DATE)
   BETWEEN h.holiday_date - 60 AND h.holiday_date + 30) THEN 1 ELSE 0 END AS INTEGER) AS in_holiday_buffer
FROM transactions t""", dims=True))
def q_d15(spark, sf):
    periods = dims.holidays(spark).select(F.col("holiday_date").alias("holiday_starts"), F.col("holiday_date").alias("holiday_ends"))
    x = holiday_buffer_flag(tx(spark, sf).select("transaction_id", "transaction_date"), periods)
    return x.select("transaction_id", "in_holiday_buffer")


@register("d16_strip_timezone", with_tx("SELECT transaction_id, transaction_date AS naive_date FROM transactions"))
def q_d16(spark, sf):
    zoned = F.col("transaction_date").cast("timestamp")      # an instant; the session's zone is the wall clock
    return tx(spark, sf).select("transaction_id", D.strip_tz(zoned).alias("naive_date"))


# ------------------------------------------------------------------ scalar expressions

@register("e1_in_london", with_tx("""SELECT transaction_id, CAST(coalesce(regexp_extract(postcode_latest, '^([A-Z]+)', 1) IN
  ('E','EC','N','NW','SE','SW','W','WC','BR','CR','DA','EN','HA','IG','KT','RM','SM','TN','TW','UB','WD'), false) AS INTEGER) AS in_london
  FROM (SELECT transaction_id, concat(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST(customer_id % 26 + 1 AS INTEGER),
        CAST(customer_id % 2 + 1 AS INTEGER)), CAST(customer_id % 20 AS VARCHAR), ' 1AB') AS postcode_latest FROM transactions)"""))
def q_e1(spark, sf):
    x = derived.with_postcode(tx(spark, sf))
    return x.select("transaction_id", S.in_london("postcode_latest").alias("in_london"))


@register("e2_onehot_merchant_category", with_tx("SELECT transaction_id, " + ", ".join(
    f"CAST(coalesce(merchant_category = 'CAT_{i}', false) AS INTEGER) AS merchant_category_CAT_{i}" for i in range(7))
    + " FROM transactions"))
def q_e2(spark, sf):
    return onehot_encode_column(tx(spark, sf).select("transaction_id", "merchant_category"), "merchant_category")


@register("e3_label_encode", with_tx("""SELECT transaction_id, c.code AS card_present_or_not FROM transactions t LEFT JOIN
  (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT card_present_or_not AS v
   FROM transactions WHERE card_present_or_not IS NOT NULL)) c ON t.card_present_or_not = c.v"""))
def q_e3(spark, sf):
    return label_encode_column(tx(spark, sf).select("transaction_id", "card_present_or_not"), "card_present_or_not")


@register("e4_is_uk", with_tx("""SELECT transaction_id, CAST(CASE WHEN IP_address_country_code IS NULL THEN NULL
  ELSE IP_address_country_code = 'GB' END AS INTEGER) AS is_UK FROM cc""", dims=True, extra=_LOCAL))
def q_e4(spark, sf):
    x = J.add_ip_country(tx(spark, sf).select("transaction_id", "IP_address"), dims.ip_ranges(spark))
    return x.select("transaction_id", S.is_uk("IP_address_country_code").alias("is_UK"))


@register("e5_card_with_merchant_id", with_tx("""SELECT transaction_id, CASE WHEN type_of_credit_card_used = 'Store Credit Card'
  AND store_card_merchant_id IS NOT NULL THEN concat_ws('_', type_of_credit_card_used, CAST(store_card_merchant_id AS VARCHAR))
  ELSE type_of_credit_card_used END AS type_of_credit_card_used_with_mer_id FROM transactions"""))
def q_e5(spark, sf):
    return tx(spark, sf).select("transaction_id", S.card_with_merchant_id("type_of_credit_card_used", "store_card_merchant_id")
                                .alias("type_of_credit_card_used_with_mer_id"))


@register("e6_merchant_card_flags", with_tx("""SELECT transaction_id,
  CAST(coalesce(type_of_credit_card_used = 'Store Credit Card', false) AS INTEGER) AS is_merchant_card,
  CAST(coalesce(merchant_id = store_card_merchant_id, false) AS INTEGER) AS is_merchant_mismatch,
  CAST(coalesce(type_of_credit_card_used = 'Store Credit Card', false) AND coalesce(merchant_id = store_card_merchant_id, false) AS INTEGER)
    AS is_merchant_card_and_mismatch FROM transactions"""))
def q_e6(spark, sf):
    flags = S.merchant_card_flags("type_of_credit_card_used", "merchant_id", "store_card_merchant_id")
    return tx(spark, sf).select("transaction_id", *[c.alias(n) for n, c in flags.items()])


@register("e7_ip_present", with_tx("""SELECT transaction_id, CAST(coalesce(IP_address IS NOT NULL AND trim(IP_address) <> '', false)
  AS INTEGER) AS ip_present FROM transactions"""))
def q_e7(spark, sf):
    return tx(spark, sf).select("transaction_id", F.coalesce(IP.is_present("IP_address"), F.lit(False)).cast("int").alias("ip_present"))


@register("e8_ipv4_numeric", with_tx(f"""SELECT transaction_id, ip_num, CASE WHEN ip_num IS NULL THEN NULL ELSE
  concat_ws('.', CAST(ip_num // 16777216 % 256 AS VARCHAR), CAST(ip_num // 65536 % 256 AS VARCHAR),
            CAST(ip_num // 256 % 256 AS VARCHAR), CAST(ip_num % 256 AS VARCHAR)) END AS ip_text,
  CASE WHEN ip_num IS NULL THEN NULL ELSE ((ip_num BETWEEN 0 AND 16777215) OR (ip_num BETWEEN 167772160 AND 184549375)
    OR (ip_num BETWEEN 1681915904 AND 1686110207) OR (ip_num BETWEEN 2130706432 AND 2147483647)
    OR (ip_num BETWEEN 2851995648 AND 2852061183) OR (ip_num BETWEEN 2886729728 AND 2887778303)
    OR (ip_num BETWEEN 3221225472 AND 3221225727) OR (ip_num BETWEEN 3221225984 AND 3221226239)
    OR (ip_num BETWEEN 3232235520 AND 3232301055) OR (ip_num BETWEEN 3323068416 AND 3323199487)
    OR (ip_num BETWEEN 3325256704 AND 3325256959) OR (ip_num BETWEEN 3405803776 AND 3405804031)
    OR (ip_num BETWEEN 4026531840 AND 4294967295) OR (ip_num BETWEEN 4294967295 AND 4294967295)) END AS ip_is_private
  FROM (SELECT transaction_id, {IPN} AS ip_num FROM transactions)"""))
def q_e8(spark, sf):
    x = tx(spark, sf).select("transaction_id", IP.ipv4_to_long("IP_address").alias("ip_num"), "IP_address")
    return x.select("transaction_id", "ip_num", IP.long_to_ipv4("ip_num").alias("ip_text"),
                    IP.is_private("IP_address").alias("ip_is_private"))


@register("e10_capped_amount", with_tx(
    "SELECT transaction_id, round(least(amount * 3.0, 100.0), 2) AS capped_amount FROM transactions"))
def q_e10(spark, sf):
    return tx(spark, sf).select("transaction_id", S.capped_amount("amount", 100.0).alias("capped_amount"))


@register("e11_array_membership", with_tx("""SELECT customer_id,
  list_contains(credit_card_owned, 'Store Credit Card') AS has_store_card,
  len(list_intersect(credit_card_owned, ['Cashback', 'Travel'])) > 0 AS has_reward_card,
  list_sort(list_intersect(credit_card_owned, ['Cashback', 'Travel'])) AS reward_cards FROM profiles""", extra=DERIVED_CTES))
def q_e11(spark, sf):
    p = derived.customer_profiles(tx(spark, sf))
    rewards = F.array(F.lit("Cashback"), F.lit("Travel"))
    return p.select("customer_id", F.array_contains("credit_card_owned", "Store Credit Card").alias("has_store_card"),
                    F.arrays_overlap("credit_card_owned", rewards).alias("has_reward_card"),
                    F.sort_array(F.array_intersect("credit_card_owned", rewards)).alias("reward_cards"))


# ------------------------------------------------------------------ J2 and documented feature ideas

@register("j2_one_to_one_key_join", with_tx("""SELECT a.transaction_id, a.amount, b.day_no FROM
  (SELECT transaction_id, amount FROM transactions) a JOIN (SELECT transaction_id, day_no FROM transactions) b
  ON a.transaction_id = b.transaction_id"""))
def q_j2(spark, sf):
    t = tx(spark, sf)
    return t.select("transaction_id", "amount").join(t.select("transaction_id", "day_no"), "transaction_id")


@register("x_holiday_anywhere", with_tx("""SELECT transaction_id, CAST(CASE WHEN CAST(transaction_date AS DATE) IN
  (SELECT holiday_date FROM holidays) THEN 1 ELSE 0 END AS INTEGER) AS is_holiday_anywhere FROM transactions""", dims=True))
def q_x1(spark, sf):
    return J.add_holiday_anywhere(tx(spark, sf).select("transaction_id", "transaction_date"), dims.holidays(spark)) \
        .select("transaction_id", "is_holiday_anywhere")


@register("x_previous_ip_country_holiday", with_tx("""
SELECT transaction_id, prev_cc AS previous_IP_country_code,
  CAST(CASE WHEN prev_cc IS NULL OR prev_cc NOT IN (SELECT country_code FROM holidays) THEN NULL
       WHEN EXISTS (SELECT 1 FROM holidays h WHERE h.country_code = p.prev_cc AND h.holiday_date = CAST(p.transaction_date AS DATE))
       THEN 1 ELSE 0 END AS INTEGER) AS holiday_of_previous_IP_country
FROM (SELECT cc.transaction_id, cc.transaction_date, lag(cc.IP_address_country_code) OVER
      (PARTITION BY t.customer_id ORDER BY cc.transaction_date, cc.transaction_id) AS prev_cc
      FROM cc JOIN transactions t ON cc.transaction_id = t.transaction_id) p""", dims=True, extra=_LOCAL))
def q_x2(spark, sf):
    x = J.add_ip_country(tx(spark, sf).select("transaction_id", "transaction_date", "customer_id", "IP_address"),
                         dims.ip_ranges(spark))
    x = J.add_previous_ip_country(x)
    x = J.add_bank_holiday_by_country_code(x, dims.holidays(spark), country_col="previous_IP_country_code",
                                           out_col="holiday_of_previous_IP_country")
    return x.select("transaction_id", "previous_IP_country_code", "holiday_of_previous_IP_country")


@register("x_recent_ip_country_holiday", with_tx(f"""
SELECT transaction_id, CAST(coalesce(len(list_intersect(recent, hcs)) > 0, false) AS INTEGER) AS holiday_in_recent_IP_country_5d
FROM (SELECT cc.transaction_id, cc.transaction_date,
        list_distinct(list(cc.IP_address_country_code) OVER (PARTITION BY t.customer_id ORDER BY epoch_us(cc.transaction_date)
          RANGE BETWEEN {5 * DAY_US} PRECEDING AND CURRENT ROW)) AS recent
      FROM cc JOIN transactions t ON cc.transaction_id = t.transaction_id) r
LEFT JOIN (SELECT holiday_date, list(country_code) AS hcs FROM holidays GROUP BY 1) h
  ON CAST(r.transaction_date AS DATE) = h.holiday_date""", dims=True, extra=_LOCAL))
def q_x3(spark, sf):
    x = J.add_ip_country(tx(spark, sf).select("transaction_id", "transaction_date", "customer_id", "IP_address"),
                         dims.ip_ranges(spark))
    return J.add_recent_ip_country_holiday(x, dims.holidays(spark), days=5).select(
        "transaction_id", "holiday_in_recent_IP_country_5d")


@register("x_is_workday", with_tx("""
SELECT transaction_id, CAST(isodow(transaction_date) - 1 < 5 AND coalesce(flag, 0) = 0 AS INTEGER) AS is_workday FROM (
 SELECT transaction_id, transaction_date, CASE WHEN IP_address_country_code IS NULL OR IP_address_country_code NOT IN
   (SELECT country_code FROM holidays) THEN NULL WHEN EXISTS (SELECT 1 FROM holidays h WHERE h.country_code = cc.IP_address_country_code
   AND h.holiday_date = CAST(cc.transaction_date AS DATE)) THEN 1 ELSE 0 END AS flag FROM cc)""", dims=True, extra=_LOCAL))
def q_x4(spark, sf):
    x = J.add_ip_country(tx(spark, sf).select("transaction_id", "transaction_date", "IP_address"), dims.ip_ranges(spark))
    x = J.add_bank_holiday_by_country_code(x, dims.holidays(spark))
    return J.add_is_workday(x).select("transaction_id", "is_workday")


@register("j8_align_on_union", with_tx("""
SELECT coalesce(a.day_no, b.day_no, c.day_no) AS day_no, coalesce(a.n_tx, 0) AS n_tx, coalesce(b.n_fraud, 0) AS n_fraud,
       coalesce(c.n_fraud_customers, 0) AS n_fraud_customers
FROM (SELECT day_no, count(*) AS n_tx FROM transactions GROUP BY 1) a
FULL OUTER JOIN (SELECT day_no, count(*) AS n_fraud FROM transactions WHERE is_fraud = 1 GROUP BY 1) b ON a.day_no = b.day_no
FULL OUTER JOIN (SELECT day_no, count(DISTINCT customer_id) AS n_fraud_customers FROM transactions
                 WHERE is_fraud = 1 AND amount > 10 GROUP BY 1) c ON coalesce(a.day_no, b.day_no) = c.day_no"""))
def q_j8(spark, sf):
    t = tx(spark, sf)
    a = t.groupBy("day_no").agg(F.count(F.lit(1)).alias("v"))
    b = t.where(F.col("is_fraud") == 1).groupBy("day_no").agg(F.count(F.lit(1)).alias("v"))
    c = t.where((F.col("is_fraud") == 1) & (F.col("amount") > 10)).groupBy("day_no").agg(F.count_distinct("customer_id").alias("v"))
    return J.align_on_union({"n_tx": a, "n_fraud": b, "n_fraud_customers": c}, "day_no")


@register("e9_customer_pos_distance", with_tx("""SELECT t.transaction_id,
  round(sqrt(pow(p.location_x - m.location_x, 2) + pow(p.location_y - m.location_y, 2)), 4) AS distance
FROM transactions t JOIN profiles p ON t.customer_id = p.customer_id
JOIN mpos m ON t.merchant_id = m.merchant_id AND t.pos_id = m.pos_id""", extra=DERIVED_CTES))
def q_e9(spark, sf):
    t = tx(spark, sf)
    p = derived.customer_profiles(t).select("customer_id", F.col("location_x").alias("cx"), F.col("location_y").alias("cy"))
    m = derived.merchant_pos(t).select("merchant_id", "pos_id", F.col("location_x").alias("px"), F.col("location_y").alias("py"))
    x = t.select("transaction_id", "customer_id", "merchant_id", "pos_id").join(p, "customer_id").join(m, ["merchant_id", "pos_id"])
    return x.select("transaction_id", F.round(S.euclidean("cx", "cy", "px", "py"), 4).alias("distance"))


@register("w2_event_stream_windows", "SELECT * FROM (" + _w1_sql() + ") a JOIN (" + _w2_sql() + ") b USING (transaction_id)")
def q_w12_events(spark, sf):
    x = W.add_window_features_by_events(tx(spark, sf).select("transaction_id", "transaction_date", "customer_id",
                                                                "IP_address", "amount"))
    return x.drop("transaction_date", "customer_id", "IP_address", "amount")
