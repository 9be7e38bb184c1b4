"""Joins (J1-J12): dimension lookups, aggregate-and-map-back, range and
interval joins expressed as equi joins.

No side carries a broadcast hint: Spark broadcasts a dimension by its size in
bytes, at planning or, by AQE, at run time, and otherwise splits skewed
partitions of a sort-merge join.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.functions.ip import ipv4_to_long
from fraudlens.operators import hotsplit as H
from fraudlens.operators.windows import HOT_BUCKET_DAYS, HOT_CUSTOMER_ROWS
from fraudlens.sources.tables import epoch_us


def left_lookup(df: DataFrame, dim: DataFrame, on) -> DataFrame:
    """Left equi join of a dimension (customer attributes, POS of merchant); Spark
    picks broadcast or shuffle by the dimension's size in bytes."""
    return df.join(dim, on, "left")


def add_ip_used_by_many(df: DataFrame, id_count_threshold=None, ip_col="IP_address",
                        id_col="customer_id") -> DataFrame:
    """``IP_used_by_{k}_customer_id_or_more`` = 1 when the row's IP is used by at
    least ``k`` distinct customers; NULL IP -> 0.

    Default ``k = int(0.01 * distinct customers)`` (one scalar aggregate).
    The distinct count pre-aggregates on (IP, customer) map-side, then counts
    per IP with partial aggregation, so a proxy IP shared by millions of
    customers never lands in one task as raw rows.  Only IPs reaching the
    smallest ``k`` are joined back, lazily: Spark broadcasts them if they turn
    out small in bytes and splits hot IPs of a shuffled join otherwise.
    """
    if id_count_threshold is None:
        n = df.agg(F.count_distinct(id_col)).first()[0]
        id_count_threshold = [int(n * 0.01)]
    counts = (df.where(F.col(ip_col).isNotNull())
              .groupBy(ip_col).agg(F.count_distinct(id_col).alias("_n_ids")))
    shared = counts.where(F.col("_n_ids") >= min(id_count_threshold))
    out = df.join(shared, ip_col, "left")
    cols = {f"IP_used_by_{k}_{id_col}_or_more": F.coalesce((F.col("_n_ids") >= k).cast("int"), F.lit(0))
            for k in id_count_threshold}
    return out.withColumns(cols).drop("_n_ids")


def split_ranges_by_prefix(ranges: DataFrame, lo="ip_lo", hi="ip_hi", shift: int = 16) -> DataFrame:
    """Explode non-overlapping [lo, hi] ranges into one row per /(32-shift) block they touch."""
    return ranges.withColumn("_blk", F.explode(F.sequence(F.shiftright(F.col(lo), shift),
                                                          F.shiftright(F.col(hi), shift))))


def add_ip_country(df: DataFrame, ip_ranges: DataFrame, ip_col="IP_address",
                   out_col="IP_address_country_code") -> DataFrame:
    """IPv4 -> country by interval lookup in non-overlapping ranges.

    Equi join on the /16 block plus a residual ``BETWEEN`` instead of a
    theta join (which would plan as a nested-loop join).  The exploded range
    table has at most 65 536 + R rows, so Spark can broadcast it by size.
    """
    blocks = split_ranges_by_prefix(ip_ranges).select(
        "_blk", F.col("ip_lo").alias("_lo"), F.col("ip_hi").alias("_hi"),
        F.col("country_code").alias("_cc"))
    x = df.withColumn("_ipn", ipv4_to_long(ip_col)).withColumn("_blk", F.shiftright("_ipn", 16))
    j = x.join(blocks,
               (x["_blk"] == blocks["_blk"]) & x["_ipn"].between(blocks["_lo"], blocks["_hi"]), "left")
    return j.withColumn(out_col, F.col("_cc")).drop("_ipn", "_blk", "_lo", "_hi", "_cc")


def add_country_timezone(df: DataFrame, tz_dim: DataFrame, country_col="IP_address_country_code",
                         out_col="timezone", default="UTC") -> DataFrame:
    """Country -> first time zone; unknown country -> UTC; NULL -> NULL."""
    d = tz_dim.select(F.col("country_code").alias("_cc"), F.col("timezone").alias("_tz"))
    j = df.join(d, df[country_col] == d["_cc"], "left")
    tz = F.when(F.col(country_col).isNull(), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.col("_tz"), F.lit(default)))
    return j.withColumn(out_col, tz).drop("_cc", "_tz")


def add_is_bank_holiday(df: DataFrame, holidays: DataFrame, country_code="GB",
                        date_col="transaction_date") -> DataFrame:
    """``is_{cc}_bank_holiday`` = the row's date is a holiday of a fixed country."""
    h = (holidays.where(F.col("country_code") == country_code)
         .select(F.col("holiday_date").alias("_hd")).distinct().withColumn("_hit", F.lit(1)))
    x = df.withColumn("_d", F.to_date(date_col))
    j = x.join(h, x["_d"] == h["_hd"], "left")
    return j.withColumn(f"is_{country_code}_bank_holiday", F.coalesce("_hit", F.lit(0))).drop("_d", "_hd", "_hit")


def add_bank_holiday_by_country_code(df: DataFrame, holidays: DataFrame, date_col="transaction_date",
                                     country_col="IP_address_country_code",
                                     out_col="bank_holiday_of_IP_country") -> DataFrame:
    """Holiday in the IP's own country: 1/0; unsupported country -> NULL with
    status ``unsupported``; NULL country -> NULL (status NULL)."""
    supported = holidays.select(F.col("country_code").alias("_sc")).distinct()
    h = holidays.select(F.col("country_code").alias("_hc"), F.col("holiday_date").alias("_hd")).distinct() \
        .withColumn("_hit", F.lit(1))
    x = df.withColumn("_d", F.to_date(date_col))
    x = x.join(supported, x[country_col] == supported["_sc"], "left")
    x = x.join(h, (x[country_col] == h["_hc"]) & (x["_d"] == h["_hd"]), "left")
    flag = (F.when(F.col(country_col).isNull() | F.col("_sc").isNull(), F.lit(None).cast("int"))
            .otherwise(F.coalesce("_hit", F.lit(0))))
    status = (F.when(F.col(country_col).isNull(), F.lit(None).cast("string"))
              .when(F.col("_sc").isNull(), F.lit("unsupported"))
              .when(F.col("_hit") == 1, F.lit("holiday")).otherwise(F.lit("no holiday")))
    return (x.withColumn(out_col, flag).withColumn(out_col + "_status", status)
            .drop("_d", "_sc", "_hc", "_hd", "_hit"))


def align_on_union(frames: dict[str, DataFrame], key: str) -> DataFrame:
    """Full outer join of keyed single-value frames on the union of keys, missing -> 0."""
    out = None
    for name, f in frames.items():
        f = f.select(key, F.col(f.columns[1] if f.columns[0] == key else f.columns[0]).alias(name))
        out = f if out is None else out.join(f, key, "full")
    return out.fillna(0, subset=list(frames))


def pos_within_radius(tx: DataFrame, customers: DataFrame, pos: DataFrame, radius: float = 60.0, within: bool = True,
                      online_col="card_present_or_not", online_value="card not present") -> DataFrame:
    """For each transaction, the POS of its merchant within ``radius`` of the
    customer (Euclidean), or at it and beyond; online transactions get none.

    Within: POS go to the nine cells of radius' size around their own, a transaction
    to the cell of its customer, and both meet by (merchant, cell), so a
    merchant's POS spread over cells and no transaction is multiplied.  Beyond: by
    merchant, whose far POS all come out.  Null coordinates match nothing.
    """
    c = customers.select("customer_id", F.col("location_x").alias("_cx"), F.col("location_y").alias("_cy"))
    p = pos.select("merchant_id", F.col("pos_id").alias("near_pos_id"), F.col("location_x").alias("_px"),
                   F.col("location_y").alias("_py"))
    x = (tx.where(F.col(online_col) != online_value).select("transaction_id", "customer_id", "merchant_id")
         .join(c, "customer_id"))
    keys = ["merchant_id"]
    if within:
        # a little wider than the radius: rounding cannot part neighbours by two cells
        side = max(radius, 1e-9) * 1.000001

        def cell(v):
            return F.floor(F.col(v) / side)
        near = F.array(*[F.lit(d) for d in (-1, 0, 1)])
        x = x.withColumn("_gx", cell("_cx")).withColumn("_gy", cell("_cy"))
        p = (p.select("*", F.explode(near).alias("_dx")).select("*", F.explode(near).alias("_dy"))
             .withColumn("_gx", cell("_px") + F.col("_dx")).withColumn("_gy", cell("_py") + F.col("_dy")).drop("_dx", "_dy"))
        keys += ["_gx", "_gy"]
    x = x.join(p, keys).withColumn("distance", F.sqrt(F.pow(F.col("_cx") - F.col("_px"), 2) + F.pow(F.col("_cy") - F.col("_py"), 2)))
    return (x.where(F.col("distance") < radius if within else F.col("distance") >= radius)
            .select("transaction_id", "customer_id", "merchant_id", "near_pos_id", F.round("distance", 4).alias("distance")))


def candidate_cards(tx: DataFrame, owned: DataFrame, card_pref: DataFrame, store_card="Store Credit Card",
                    category_col="merchant_category") -> DataFrame:
    """Cards the customer may use at the merchant: owned cards whose preferred
    category 1 or 2 is the merchant's category; the store card wins when the
    customer holds that merchant's store card.

    The cards of a category are one array, met with the customer's own by
    ``array_intersect``: the transactions shuffle for the customer join alone.
    """
    pref = card_pref.select("card_category", F.explode(F.array("prefer_consumption_category_1",
                                                               "prefer_consumption_category_2")).alias("_cat"))
    by_cat = pref.where(F.col("_cat").isNotNull()).groupBy("_cat").agg(F.collect_set("card_category").alias("_cards"))
    own = owned.select("customer_id", "store_card_merchant_id", F.col("credit_card_owned").alias("_own"))
    x = tx.select("transaction_id", "customer_id", "merchant_id", category_col).join(own, "customer_id", "left")
    x = x.join(by_cat, F.col(category_col) == F.col("_cat"), "left")
    store_wins = F.coalesce(F.array_contains("_own", store_card)
                            & (F.col("store_card_merchant_id") == F.col("merchant_id")), F.lit(False))
    return x.select(
        "transaction_id",
        F.when(store_wins, F.array(F.lit(store_card)))
         .otherwise(F.coalesce(F.sort_array(F.array_intersect("_own", "_cards")), F.array().cast("array<string>")))
         .alias("candidate_cards"))


def cash_out_matches(tests: DataFrame, later: DataFrame, gap_days: int = 30, window_days: int = 14,
                     day_col="day_no", keys=("customer_id", "type_of_credit_card_used")) -> DataFrame:
    """For each test transaction on day d, the later transactions of the same
    customer and card on days ``[d + gap, d + gap + window_days]``.

    Instead of joining every pair of a (customer, card) group and filtering,
    each test row is expanded to the days of its window (bounded by
    ``window_days + 1``) and joined on (keys..., day).
    """
    t = (tests.select(*keys, F.col("transaction_id").alias("test_transaction_id"),
                      F.col(day_col).alias("_d0"))
         .withColumn("_day", F.explode(F.sequence(F.col("_d0") + gap_days,
                                                  F.col("_d0") + gap_days + window_days))))
    l = later.select(*keys, F.col("transaction_id").alias("cash_out_transaction_id"),
                     F.col(day_col).alias("_day"))
    return t.join(l, [*keys, "_day"]).select("test_transaction_id", "cash_out_transaction_id",
                                             F.col("_day").alias(day_col))


def flag_membership(df: DataFrame, members: DataFrame, col: str, out_col: str) -> DataFrame:
    """0/1 flag = value present in ``members`` (distinct, left join)."""
    m = members.select(F.col(members.columns[0]).alias("_m")).distinct().withColumn("_hit", F.lit(1))
    j = df.join(m, df[col] == m["_m"], "left")
    return j.withColumn(out_col, F.coalesce("_hit", F.lit(0))).drop("_m", "_hit")


def semi(df: DataFrame, members: DataFrame, on) -> DataFrame:
    """Rows whose key is in ``members``."""
    return df.join(members, on, "left_semi")


def anti(df: DataFrame, members: DataFrame, on) -> DataFrame:
    """Rows whose key is not in ``members``."""
    return df.join(members, on, "left_anti")


# ------------------------------------------------------------------ documented feature ideas (2.18)

def add_holiday_anywhere(df: DataFrame, holidays: DataFrame, date_col="transaction_date",
                         out_col="is_holiday_anywhere") -> DataFrame:
    """The row's date is a holiday in any country of the calendar."""
    h = holidays.select(F.col("holiday_date").alias("_hd")).distinct().withColumn("_hit", F.lit(1))
    x = df.withColumn("_d", F.to_date(date_col))
    return (x.join(h, x["_d"] == h["_hd"], "left")
            .withColumn(out_col, F.coalesce("_hit", F.lit(0))).drop("_d", "_hd", "_hit"))


def add_previous_ip_country(df: DataFrame, country_col="IP_address_country_code", id_col="customer_id",
                            date_col="transaction_date", tie_col="transaction_id",
                            out_col="previous_IP_country_code",
                            hot_threshold: int | None = HOT_CUSTOMER_ROWS) -> DataFrame:
    """Country of the customer's previous transaction, in time order; the first has none."""
    def body(split):
        mine = F.struct("_t", tie_col, F.col(country_col).alias("_country"))
        w = Window.partitionBy(*split.keys(id_col)).orderBy("_t", tie_col)
        x = split.rows.withColumn("_prev", F.lag(mine).over(w))
        if split.active:
            s = split.rows.groupBy(id_col, H.BUCKET).agg(F.max(mine).alias("_last"))
            s = s.withColumn("_last", F.lag("_last").over(Window.partitionBy(id_col).orderBy(H.BUCKET)))
            x = H.join_null_safe(x, s, [id_col, H.BUCKET], ["_last"]).withColumn("_prev", F.coalesce("_prev", "_last")).drop("_last")
        return x.withColumn(out_col, F.col("_prev._country")).drop("_prev")
    x = df.withColumn("_t", epoch_us(date_col))
    return H.by_heat(x, id_col, "_t", hot_threshold, HOT_BUCKET_DAYS, body).drop("_t")


def add_recent_ip_country_holiday(df: DataFrame, holidays: DataFrame, days: int = 5,
                                  country_col="IP_address_country_code", id_col="customer_id",
                                  date_col="transaction_date", out_col=None,
                                  hot_threshold: int | None = HOT_CUSTOMER_ROWS) -> DataFrame:
    """1 when the row's date is a holiday in any country the customer's IPs
    resolved to within the trailing ``days`` (both ends inclusive).;
    hot customers are split by time bucket with context rows."""
    out_col = out_col or f"holiday_in_recent_IP_country_{days}d"
    per_day = holidays.groupBy(F.col("holiday_date").alias("_hd")).agg(F.collect_set("country_code").alias("_hcs"))

    def body(split):
        w = (Window.partitionBy(*split.keys(id_col)).orderBy("_t").rangeBetween(-days * H.DAY_US, Window.currentRow))
        return split.rows.withColumn("_recent", F.collect_set(country_col).over(w))
    x = H.by_heat(df.withColumn("_t", epoch_us(date_col)), id_col, "_t", hot_threshold, days, body, max_days=days)
    x = x.withColumn("_d", F.to_date(date_col)).join(per_day, F.col("_d") == F.col("_hd"), "left")
    flag = F.coalesce(F.arrays_overlap("_recent", "_hcs"), F.lit(False)).cast("int")
    return x.withColumn(out_col, flag).drop("_t", "_recent", "_d", "_hd", "_hcs")


def add_is_workday(df: DataFrame, holiday_flag_col="bank_holiday_of_IP_country", date_col="transaction_date",
                   out_col="is_workday") -> DataFrame:
    """Monday-Friday and not a holiday of the IP country (unknown holiday status counts as no holiday)."""
    wd = F.weekday(date_col) < 5
    return df.withColumn(out_col, F.coalesce(wd & (F.coalesce(F.col(holiday_flag_col), F.lit(0)) == 0),
                                             F.lit(False)).cast("int"))
