"""Per-customer trailing-window and lag features.

Windows are trailing and closed at both ends: a row at ``t`` sees rows with
``t - w days <= ts <= t``, those of equal ``ts`` included.  They are computed
as running sums over an event stream: a row adds to every window at its time
and is taken out of window ``w`` at ``time + w + 1us``, so the work is
O(n log n) however dense a customer's rows are, and all windows and lags of
cold customers share one Exchange by customer.  Hot customers are split by
time bucket (``hotsplit.py``); the sums of earlier buckets are added from a
summary.  Rows without a time see each other only.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.functions.ip import is_present
from fraudlens.operators import hotsplit as H
from fraudlens.operators.prefix import with_global_position
from fraudlens.sources.tables import epoch_us

DAY_US = 86_400 * 1_000_000
DEFAULT_WINDOWS = (1, 5, 12, 28, 60)
# customers with more rows than this are split by time bucket (see hotsplit.py)
HOT_CUSTOMER_ROWS = 2_000_000
HOT_BUCKET_DAYS = 1 / 24
_T = "_t_us"
_FAR = 1 << 62            # a gap longer than any window
_ALL = -1                 # an event of all windows


def add_distinct_ip_window(df: DataFrame, windows=DEFAULT_WINDOWS, date_col="transaction_date",
                           id_col="customer_id", ip_col="IP_address", hot_threshold: int | None = HOT_CUSTOMER_ROWS,
                           bucket_days: float = HOT_BUCKET_DAYS) -> DataFrame:
    """Distinct non-NULL, non-blank IPs of the customer in ``[t - w days, t]``,
    as ``{id_col}_distinct_ip_{w}d`` (int)."""
    return add_customer_window_features(df, windows, date_col, id_col, ip_col=ip_col, hot_threshold=hot_threshold,
                                        bucket_days=bucket_days, features=("distinct_ip",))


def fixed_point_mean(total_units, n, scale: int):
    """Mean from an exact integer sum of ``10**scale`` units: order-independent,
    so every partitioning and engine gives the same double."""
    return F.when(n > 0, total_units / n / float(10 ** scale))


def to_units(c, scale: int):
    """Money value -> exact integer count of ``10**-scale`` units."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double") * float(10 ** scale)).cast("bigint")


def add_ma_trade_info_by_id(df: DataFrame, windows=DEFAULT_WINDOWS, trade_info=("amount", "count"),
                            date_col="transaction_date", id_col="customer_id",
                            amount_col="amount", amount_scale: int | None = 2, hot_threshold: int | None = HOT_CUSTOMER_ROWS,
                            bucket_days: float = HOT_BUCKET_DAYS) -> DataFrame:
    """Trailing mean amount (NULL-skipping) and row count in ``[t - w days, t]``.

    With ``amount_scale`` (money with that many decimals) the mean is an exact
    fixed-point sum over the non-NULL count, so it does not drift with the
    summation order; ``None`` sums exact decimals of 8 places.
    """
    bad = set(trade_info) - {"amount", "count"}
    if bad:
        raise ValueError(f"unsupported trade_info {sorted(bad)}; use 'amount' and/or 'count'")
    return add_customer_window_features(df, windows, date_col, id_col, amount_col=amount_col, amount_scale=amount_scale,
                                        hot_threshold=hot_threshold, bucket_days=bucket_days,
                                        features=tuple(f"ma_{i}" for i in trade_info))


def _with_lag(split: H.Split, x: DataFrame, keys: list[str], tie_col: str, out: str) -> DataFrame:
    """``out``: time of the previous row of the same keys (NULL for the first)."""
    w = Window.partitionBy(*split.keys(*keys)).orderBy(_T, tie_col)
    return H.fill_lag(split, x.withColumn(out, F.lag(_T).over(w)), keys, _T, out)


def with_prev_time(df: DataFrame, date_col="transaction_date", id_col="customer_id", tie_col="transaction_id",
                   hot_threshold: int | None = HOT_CUSTOMER_ROWS, bucket_days: float = HOT_BUCKET_DAYS,
                   out="_prev") -> DataFrame:
    """``_t_us`` (event time) and ``out`` = time of the key's previous row (NULL for
    the first), hot keys split by time bucket."""
    x = df.withColumn(_T, epoch_us(date_col))
    return H.by_heat(x, id_col, _T, hot_threshold, bucket_days, lambda sp: _with_lag(sp, sp.rows, [id_col], tie_col, out))


def add_sec_since_last_trade(df: DataFrame, date_col="transaction_date", id_col="customer_id",
                             tie_col="transaction_id", hot_threshold: int | None = HOT_CUSTOMER_ROWS,
                             bucket_days: float = HOT_BUCKET_DAYS) -> DataFrame:
    """Whole seconds since the customer's previous transaction (any IP); first -> 0."""
    return add_customer_window_features(df, (), date_col, id_col, tie_col=tie_col, hot_threshold=hot_threshold,
                                        bucket_days=bucket_days, features=("last_trade",))


def add_time_since_last_ip_per_customer(df: DataFrame, customer_col="customer_id", ip_col="IP_address",
                                        timestamp_col="transaction_date", fill_na_with_zero=True,
                                        tie_col="transaction_id", hot_threshold: int | None = HOT_CUSTOMER_ROWS,
                                        bucket_days: float = HOT_BUCKET_DAYS) -> DataFrame:
    """Seconds (fractional) since the same customer last used the same IP.

    First use, or a NULL IP, gives NULL -> 0 when ``fill_na_with_zero``.
    """
    return add_customer_window_features(df, (), timestamp_col, customer_col, ip_col, tie_col=tie_col,
                                        hot_threshold=hot_threshold, bucket_days=bucket_days, features=("last_ip",),
                                        fill_na_with_zero=fill_na_with_zero)


def add_rapid_flag(df: DataFrame, minutes: float = 30, date_col="transaction_date",
                   id_col="customer_id", tie_col="transaction_id", hot_threshold: int | None = HOT_CUSTOMER_ROWS) -> DataFrame:
    """``time_diff`` (minutes since the customer's previous row) and ``is_rapid``."""
    x = with_prev_time(df, date_col, id_col, tie_col, hot_threshold)
    return (x.withColumn("time_diff", (F.col(_T) - F.col("_prev")) / 60e6)
            .withColumn("is_rapid", F.coalesce(F.col("time_diff") <= minutes, F.lit(False)))
            .drop(_T, "_prev"))


def rapid_share_by_label(df: DataFrame, minutes: float = 30, target="is_fraud",
                         hot_threshold: int | None = HOT_CUSTOMER_ROWS) -> DataFrame:
    """W5 report: per label, % of rapid and non-rapid transactions."""
    r = add_rapid_flag(df, minutes, hot_threshold=hot_threshold)
    counts = r.groupBy(target).agg(
        F.sum(F.col("is_rapid").cast("int")).alias("n_rapid"), F.count(F.lit(1)).alias("n"))
    return counts.select(
        target,
        F.round(100.0 * (F.col("n") - F.col("n_rapid")) / F.col("n"), 4).alias("pct_not_rapid"),
        F.round(100.0 * F.col("n_rapid") / F.col("n"), 4).alias("pct_rapid"))


def minutes_between_fraud_customer_trades(df: DataFrame, n_customers: int = 100, target="is_fraud",
                                          date_col="transaction_date", id_col="customer_id",
                                          tie_col="transaction_id", hot_threshold: int | None = HOT_CUSTOMER_ROWS) -> DataFrame:
    """Minutes between consecutive transactions of the first ``n_customers``
    customers (by id) that have any fraud; each customer's first row dropped."""
    fraud_ids = df.where(F.col(target) == 1).select(id_col).distinct()
    first_ids = fraud_ids.orderBy(id_col).limit(n_customers)   # top-n report: the limit is the feature
    sub = df.join(F.broadcast(first_ids), id_col, "left_semi")  # at most n_customers ids
    x = with_prev_time(sub, date_col, id_col, tie_col, hot_threshold)
    return (x.withColumn("minutes_since_previous", (F.col(_T) - F.col("_prev")) / 60e6)
            .where(F.col("minutes_since_previous").isNotNull())
            .select(id_col, tie_col, "minutes_since_previous"))


def transactions_before_first_fraud(df: DataFrame, target="is_fraud", date_col="transaction_date",
                                    id_col="customer_id", amount_col="amount",
                                    tie_col="transaction_id") -> DataFrame:
    """Per customer with a fraud: rows before the first fraud (only if >= 1),
    hours from the first row to the first fraud, mean amount before the fraud.

    Aggregations only (no per-customer window): the first fraud per customer
    is a min over (time, id), joined back; the counts and means are grouped
    aggregates with map-side partial aggregation, so a hot customer spreads."""
    t = df.withColumn(_T, epoch_us(date_col))
    first = t.where(F.col(target) == 1).groupBy(id_col).agg(
        F.min(F.struct(F.col(_T).alias("t"), F.col(tie_col).alias("i"))).alias("_f"))
    j = t.join(first, id_col)
    before = F.struct(F.col(_T).alias("t"), F.col(tie_col).alias("i")) < F.col("_f")
    agg = j.groupBy(id_col).agg(
        F.sum(before.cast("bigint")).alias("_nb"),
        ((F.max(F.col("_f").getField("t")) - F.min(_T)) / 3.6e9).alias("time_to_first_fraud"),
        F.avg(F.when(before, F.col(amount_col))).alias("avg_amount_before_fraud"))
    return (agg.where(F.col("_nb") >= 1)
            .select(id_col, F.col("_nb").cast("bigint").alias("transactions_before_fraud"),
                    F.round("time_to_first_fraud", 4).alias("time_to_first_fraud"),
                    F.round("avg_amount_before_fraud", 4).alias("avg_amount_before_fraud")))


def add_time_position(df: DataFrame, date_col="transaction_date", tie_col="transaction_id",
                      name="position", num_partitions=None) -> DataFrame:
    """0-based global position by (time, id) - range partitioned, no single-task window."""
    return with_global_position(df, [date_col, tie_col], name=name, num_partitions=num_partitions)


def add_customer_window_features(df: DataFrame, windows=DEFAULT_WINDOWS, date_col="transaction_date",
                                 id_col="customer_id", ip_col="IP_address", amount_col="amount",
                                 tie_col="transaction_id", amount_scale: int | None = 2,
                                 hot_threshold: int | None = HOT_CUSTOMER_ROWS, bucket_days: float = HOT_BUCKET_DAYS,
                                 features=("distinct_ip", "moving", "last_trade", "last_ip"),
                                 fill_na_with_zero: bool = True) -> DataFrame:
    """W1 + W3 + W2 + W4 on one Exchange by customer (hot customers apart, by time
    bucket).  ``features`` picks the groups to add; "moving" is "ma_amount" and "ma_count"."""
    feats = set(features) | ({"ma_amount", "ma_count"} if "moving" in features else set())
    trailing = feats & {"distinct_ip", "ma_amount", "ma_count"}

    def body(split: H.Split) -> DataFrame:
        x = split.rows
        if "last_trade" in feats:
            x = _with_lag(split, x, [id_col], tie_col, "_prev")
            x = x.withColumn(f"{id_col}_sec_since_last_trade", F.coalesce(
                F.floor((F.col(_T) - F.col("_prev")) / 1_000_000), F.lit(0)).cast("bigint")).drop("_prev")
        if "last_ip" in feats:
            x = _with_lag(split, x, [id_col, ip_col], tie_col, "_prev")
            gap = F.when(F.col(ip_col).isNotNull(), (F.col(_T) - F.col("_prev")) / 1e6)
            x = x.withColumn("seconds_since_last_ip",
                             F.coalesce(gap, F.lit(0.0)) if fill_na_with_zero else gap).drop("_prev")
        return _trailing(split, x, windows, id_col, ip_col, amount_col, amount_scale, trailing) if trailing else x

    x = df.withColumn(_T, epoch_us(date_col))
    return H.by_heat(x, id_col, _T, hot_threshold, bucket_days, body).drop(_T)


def _event(payload, time, window, sign, units, present, d, gap):
    """One change of the running sums: of all windows or of one; ``d`` counts
    for a window of ``k`` days if ``gap`` is longer than that."""
    return F.struct(payload.alias("row"), time.cast("bigint").alias("time"), F.lit(window).alias("w"),
                    F.lit(sign).alias("c"), (units * sign).alias("s"), (present * sign).alias("n"),
                    F.lit(d).alias("d"), gap.alias("gap"))


def _trailing(split: H.Split, x: DataFrame, windows, id_col, ip_col, amount_col, amount_scale, feats) -> DataFrame:
    """W1 and W2 as running sums.  A row is the start of its windows and the asking
    row; one more event per window takes it out again.  An IP counts at a row
    if its earlier use lies before the window, and is taken out after the window
    if no later use lies in it: its covered times are disjoint pieces."""
    distinct, moving = "distinct_ip" in feats, bool(feats & {"ma_amount", "ma_count"})
    timeless = F.col(_T).isNull()
    none, zero = F.lit(-1).cast("bigint"), F.lit(0).cast("bigint")
    before = after = none
    names = x.columns
    if distinct:
        by_ip = Window.partitionBy(*split.keys(id_col), ip_col, timeless).orderBy(_T)
        x = x.withColumns({"_before": F.lag(F.struct(_T)).over(by_ip), "_after": F.lead(_T).over(by_ip)})
        before = (F.when(~is_present(ip_col), none).when(F.col("_before").isNull(), F.lit(_FAR))
                  .otherwise(F.coalesce(F.col(_T) - F.col("_before").getField(_T), none)))
        after = F.when(~is_present(ip_col), none).otherwise(F.coalesce(F.col("_after") - F.col(_T), F.lit(_FAR)))
    units = present = zero
    if moving:
        units = (to_units(amount_col, amount_scale) if amount_scale is not None
                 else F.col(amount_col).cast("decimal(28,8)"))
        units, present = F.coalesce(units, F.lit(0)), F.col(amount_col).isNotNull().cast("bigint")
    row = F.struct(*names)
    no_row = F.when(F.lit(False), row)
    start = _event(row, F.col(_T), _ALL, 1, units, present, 1, before)
    ends = [_event(no_row, F.col(_T) + (w * DAY_US + 1), w, -1, units, present, -1, after) for w in windows]
    # the key stays a column of its own, so cold rows keep their partitioning
    ev = x.select(id_col, F.explode(F.when(timeless, F.array(start)).otherwise(F.array(start, *ends))).alias("_e"))
    ev = ev.select(F.col(id_col).alias("_key"), "_e.*") if split.active else ev.select(id_col, "_e.*")
    key = "_key" if split.active else id_col

    def sums():
        for w in windows:
            mine = F.col("w").isin(_ALL, w)
            if moving:
                yield f"_c{w}", F.sum(F.when(mine, F.col("c")))
                yield f"_s{w}", F.sum(F.when(mine, F.col("s")))
                yield f"_n{w}", F.sum(F.when(mine, F.col("n")))
            if distinct:
                yield f"_d{w}", F.sum(F.when(mine & (F.col("gap") > w * DAY_US), F.col("d")))

    cols = dict(sums())
    asked = F.col("row").isNotNull()
    if not split.active:
        frame = (Window.partitionBy(key, F.col("time").isNull()).orderBy("time")
                 .rangeBetween(Window.unboundedPreceding, Window.currentRow))
        out = ev.withColumns({n: c.over(frame) for n, c in cols.items()}).where(asked)
        total = {n: F.coalesce(F.col(n), F.lit(0)) for n in cols}
    else:
        if distinct:
            ev = ev.unionByName(_bucket_seams(x, windows, id_col, ip_col, ev))
        ev = ev.withColumn(H.BUCKET, H.bucket_of("time", split.bucket_days)).repartition("_key", H.BUCKET)
        frame = (Window.partitionBy("_key", H.BUCKET).orderBy("time")
                 .rangeBetween(Window.unboundedPreceding, Window.currentRow))
        out = ev.withColumns({n: c.over(frame) for n, c in cols.items()}).where(asked)
        per = ev.where(F.col("time").isNotNull()).groupBy("_key", H.BUCKET).agg(*[c.alias(n) for n, c in cols.items()])
        earlier = Window.partitionBy("_key").orderBy(H.BUCKET).rowsBetween(Window.unboundedPreceding, -1)
        per = per.select("_key", H.BUCKET, *[F.sum(n).over(earlier).alias(f"{n}_0") for n in cols])
        out = H.join_null_safe(out, per, ["_key", H.BUCKET], [f"{n}_0" for n in cols])
        total = {n: F.coalesce(F.col(n), F.lit(0)) + F.when(F.col("time").isNull(), 0).otherwise(
            F.coalesce(F.col(f"{n}_0"), F.lit(0))) for n in cols}
    add = {}
    if distinct:
        add |= {f"{id_col}_distinct_ip_{w}d": total[f"_d{w}"].cast("int") for w in windows}
    for w in windows:
        if "ma_amount" in feats:
            s, n = total[f"_s{w}"], total[f"_n{w}"]
            add[f"{id_col}_ma_amount_{w}d"] = (fixed_point_mean(s, n, amount_scale) if amount_scale is not None
                                               else F.when(n > 0, s.cast("double") / n))
        if "ma_count" in feats:
            add[f"{id_col}_ma_count_{w}d"] = total[f"_c{w}"].cast("bigint")
    return out.select(*[F.col("row").getField(c).alias(c) for c in names], *[c.alias(n) for n, c in add.items()])


def _bucket_seams(x: DataFrame, windows, id_col, ip_col, like: DataFrame) -> DataFrame:
    """Inside a bucket an IP's first row counts as new and its last as final.  Where the next bucket
    with that IP begins within a window, both are taken back."""
    s = x.where(is_present(ip_col) & F.col(_T).isNotNull()).groupBy(id_col, ip_col, H.BUCKET).agg(
        F.min(_T).alias("_first"), F.max(_T).alias("_last"))
    s = s.withColumn("_next", F.lead("_first").over(Window.partitionBy(id_col, ip_col).orderBy(H.BUCKET)))
    zero, far = F.lit(0).cast("bigint"), F.lit(_FAR)
    units, no_row = F.lit(0).cast(like.schema["s"].dataType), F.lit(None).cast(like.schema["row"].dataType)
    back = []
    for w in windows:
        inside = F.col("_next") - F.col("_last") <= w * DAY_US
        for time, d in ((F.col("_next"), -1), (F.col("_last") + (w * DAY_US + 1), 1)):
            back.append(F.when(inside, _event(no_row, time, w, 0, units, zero, d, far)))
    return (s.select(F.col(id_col).alias("_key"), F.explode(F.array(*back)).alias("_e"))
            .where(F.col("_e").isNotNull()).select("_key", *[F.col(f"_e.{f}").cast(like.schema[f].dataType).alias(f)
                                                             for f in like.columns if f != "_key"]))


def add_window_features_by_events(df: DataFrame, windows=DEFAULT_WINDOWS, **kw) -> DataFrame:
    """W1 + W2 only."""
    return add_customer_window_features(df, windows, features=("distinct_ip", "moving"), **kw)
