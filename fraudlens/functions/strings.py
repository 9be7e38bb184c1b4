"""String / flag expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fraudlens.sources.dims import LONDON_INNER, LONDON_OUTER, NULL_LIKE

STORE_CARD = "Store Credit Card"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_null_like(c, values=NULL_LIKE) -> Column:
    """Exact match on a null-like placeholder -> NULL."""
    c = _c(c)
    return F.when(c.isin(list(values)), F.lit(None).cast("string")).otherwise(c)


def in_london(postcode) -> Column:
    """Leading capital letters of the postcode are a London area -> 1 else 0."""
    area = F.regexp_extract(_c(postcode), r"^([A-Z]+)", 1)
    return F.coalesce(area.isin(LONDON_INNER + LONDON_OUTER).cast("int"), F.lit(0))


def is_uk(country) -> Column:
    """GB -> 1, other non-NULL -> 0, NULL -> NULL."""
    c = _c(country)
    return F.when(c.isNull(), F.lit(None).cast("int")).otherwise((c == "GB").cast("int"))


def card_with_merchant_id(card, merchant) -> Column:
    """E5: store cards carry the issuing merchant id: ``Store Credit Card_<id>``."""
    card, merchant = _c(card), _c(merchant)
    return F.when((card == STORE_CARD) & merchant.isNotNull(),
                  F.concat_ws("_", card, merchant.cast("string"))).otherwise(card)


def merchant_card_flags(card, merchant, store_merchant) -> dict[str, Column]:
    """Store card used; merchant equals the store card's merchant; both."""
    is_card = F.coalesce(_c(card) == STORE_CARD, F.lit(False))
    same = F.coalesce(_c(merchant) == _c(store_merchant), F.lit(False))
    return {"is_merchant_card": is_card.cast("int"),
            "is_merchant_mismatch": same.cast("int"),
            "is_merchant_card_and_mismatch": (is_card & same).cast("int")}


def euclidean(x1, y1, x2, y2) -> Column:
    """E9."""
    return F.sqrt(F.pow(_c(x1) - _c(x2), 2) + F.pow(_c(y1) - _c(y2), 2))


def capped_amount(amount, cap, factor: float = 3.0) -> Column:
    """min(amount * factor, cap) rounded to 2 decimals."""
    return F.round(F.least(_c(amount) * factor, _c(cap) if not isinstance(cap, (int, float)) else F.lit(cap)), 2)
