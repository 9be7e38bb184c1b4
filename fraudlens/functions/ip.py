"""IPv4 expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_octet(c) -> Column:
    """Text before the first dot."""
    return F.substring_index(_c(c), ".", 1)


def is_present(c) -> Column:
    """Non-NULL and not blank."""
    c = _c(c)
    return c.isNotNull() & (F.trim(c) != "")


def ipv4_to_long(c) -> Column:
    """Dotted quad -> unsigned 32-bit value as bigint (malformed -> NULL)."""
    parts = F.split(_c(c), r"\.")
    octs = [F.element_at(parts, i + 1).try_cast("bigint") for i in range(4)]
    ok = (F.size(parts) == 4)
    for o in octs:
        ok = ok & o.between(0, 255)
    v = octs[0] * 16777216 + octs[1] * 65536 + octs[2] * 256 + octs[3]
    return F.when(ok, v)


def long_to_ipv4(c) -> Column:
    """Unsigned 32-bit value -> dotted quad."""
    c = _c(c).cast("bigint")
    return F.when(c.isNotNull(), F.concat_ws(".", *[(F.shiftright(c, s) % 256).cast("string") for s in (24, 16, 8, 0)]))


# fixed values: IPv4 special-purpose ("private") networks as (first address, prefix length)
PRIVATE_NETS = [
    ("0.0.0.0", 8), ("10.0.0.0", 8), ("100.64.0.0", 10), ("127.0.0.0", 8),
    ("169.254.0.0", 16), ("172.16.0.0", 12), ("192.0.0.0", 24), ("192.0.2.0", 24),
    ("192.168.0.0", 16), ("198.18.0.0", 15), ("198.51.100.0", 24), ("203.0.113.0", 24),
    ("240.0.0.0", 4), ("255.255.255.255", 32),
]


def _net_bounds():
    out = []
    for addr, plen in PRIVATE_NETS:
        a = [int(x) for x in addr.split(".")]
        lo = (a[0] << 24) | (a[1] << 16) | (a[2] << 8) | a[3]
        out.append((lo, lo + (1 << (32 - plen)) - 1))
    return out


def is_private(c) -> Column:
    """Address inside one of the special-purpose networks."""
    v = ipv4_to_long(c)
    cond = F.lit(False)
    for lo, hi in _net_bounds():
        cond = cond | v.between(lo, hi)
    return F.when(v.isNotNull(), cond)
