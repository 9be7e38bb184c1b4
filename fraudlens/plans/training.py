"""Training job helpers: model frame, time split, fit/score a named model family."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.operators import models as M
from fraudlens.operators import sampling as L
from fraudlens.operators.prep import ExactImputer
from fraudlens.plans.flagship import tree_features
from fraudlens.session import materialize

MODEL_FEATURES = ["customer_id_distinct_ip_1d", "IP_used_by_2_customer_id_or_more", "seconds_since_last_ip",
                  "card_present_or_not", "transaction_date_sec_since_midnight", "amount",
                  "customer_id_ma_amount_1d", "customer_id_ma_count_1d"]


def model_frame(tx: DataFrame) -> DataFrame:
    """Features for the model examples: the tree features + amount + 1-day velocity, NULL amounts as they are."""
    x = tree_features(tx, ("distinct_ip", "last_ip", "moving"))
    return x.select("transaction_id", "transaction_date", *[F.col(c).cast("double") for c in MODEL_FEATURES],
                    F.col("is_fraud").cast("double").alias("is_fraud"))


def train_test(tx: DataFrame, test_ratio: float = 0.2, impute: bool = True):
    """Time split of the model frame; the median imputer and the class weight are
    fitted on the train part alone (``impute=False``: no imputer, for pipelines that bring their own).  The frame is written once to the shared
    checkpoint folder: model fits make many passes over it and should not
    recompute the feature lineage each time."""
    m = materialize(L.time_split(model_frame(tx), test_ratio=test_ratio), "model-frame")
    train, test = m.where(~F.col("is_test")), m.where(F.col("is_test"))
    if not impute:
        return L.with_weights(train, positive_weight=None), test
    imputer = ExactImputer(["amount", "customer_id_ma_amount_1d"], strategy="median").fit(train)
    return L.with_weights(imputer.transform(train), positive_weight=None), imputer.transform(test)


def fit_and_score(tx: DataFrame, family: str, **params) -> DataFrame:
    train, test = train_test(tx)
    pipe = M.build_pipeline(MODEL_FEATURES, M.make_classifier(family, **params))
    return M.score(M.fit(pipe, train), test)
