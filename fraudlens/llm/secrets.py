"""Secret scans: fixed rules, and a character convolutional network over other candidates.

The rules find assignments, access keys and hex keys.  Candidates are all runs
of ``MIN_RUN`` or more key characters, but for runs of plain words (each piece
between hyphens, dots and slashes in lower case, capitalised or in capitals); each is seen with the
text around it.  The network (embedding, one convolution, maxima over left
context, candidate and right context, one hidden layer) is trained in numpy.
Positives are the labelled findings, candidates that a rule confirms, and
made-up keys of public and of random formats.  Negatives are harmless look-alikes: candidates
of the corpus whose every piece reads as a word or a short number, and made-up names,
paths, dates, versions and ids.  Other unconfirmed candidates may be keys and have no label: they are never
trained on.  Scores are calibrated on a held-out third; the threshold is the largest that keeps the
wished recall there, or lower, halfway to the score that 0.2 % of the look-alikes reach, where that costs nothing.  If more than ``MAX_FALSE`` of the held-out look-alikes pass it, training raises an error rather than
give up recall.  Spans found by rules always stay; candidates above the threshold that touch none are added.

The network is trained on all different confirmed and harmless windows of the table, and the threshold comes from all
held-out ones: nothing is sampled.  They are dealt by hash to shards of about ``SHARD`` windows, each with made-up windows
in the contexts of its own.  In an epoch every shard goes through its windows from the same weights, and the weights and moments
of all shards are averaged, a sum of as many rows as there are weights; the driver holds that, never windows.
Texts are never shuffled.

Defined cases: null text is empty and has no spans; positions count code
points of the whole text, end exclusive; repeated rows are scanned alike;
without any candidates the network is trained on the formats alone; an empty
table gives no rows.
"""
from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.llm.textops import whole
from fraudlens.operators.prefix import with_global_position
from fraudlens.session import materialize

# Fixed by the contract.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

MODEL_KIND = "model"
MIN_RUN = 12
_RUN = re.compile(rf"[A-Za-z0-9+/_=.-]{{{MIN_RUN},}}")
_PLAIN = re.compile(r"(?:(?:[A-Z]?[a-z]+|[A-Z]+)?[-/.]+)*(?:[A-Z]?[a-z]+|[A-Z]+)?=*")
_HARMLESS = re.compile(r"(?:(?:(?:[A-Z]?[a-z]{1,15}|[A-Z]{1,15}|)[0-9]{0,4}|[0-9]{1,8})[-/._=+]+)*"
                       r"(?:(?:[A-Z]?[a-z]{1,15}|[A-Z]{1,15}|)[0-9]{0,4}|[0-9]{1,8})")
_VOWEL = re.compile("[aeiouyAEIOUY]")
_LONG_PIECE = re.compile("[A-Za-z]{4,}")
LEFT, BODY, RIGHT = 24, 40, 12     # characters of a window
WINDOW = LEFT + BODY + RIGHT
SHARD, MADE_UP = 6000, 9000        # labelled windows of a shard, about, and made-up ones beside them
EPOCHS, SEED = 8, 7
RECALL, MAX_FALSE = 0.99, 0.05


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(begin, kind index, end), sorted."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def window(text: str, begin: int, end: int) -> str:
    """Left context, head and tail of the candidate, right context, in fixed places."""
    body = text[begin:end] if end - begin <= BODY else text[begin:begin + BODY - 8] + text[end - 8:end]
    left = text[max(0, begin - LEFT):begin].rjust(LEFT, "\0")
    return left + body.ljust(BODY, "\0") + text[end:end + RIGHT].ljust(RIGHT, "\0")


def harmless(run: str) -> bool:
    """Does every piece of the run read as a word or a short number?"""
    return _HARMLESS.fullmatch(run) is not None and all(_VOWEL.search(w) for w in _LONG_PIECE.findall(run))


def candidates(text: str, base) -> list[tuple[int, int, int, str]]:
    """(begin, end, label, window) of every candidate: 1 if a rule confirms it, 0 if it reads as harmless, else -1."""
    out = []
    for m in _RUN.finditer(text):
        run = m.group().rstrip(".-")
        if len(run) >= MIN_RUN and not _PLAIN.fullmatch(run):
            b, e = m.start(), m.start() + len(run)
            label = 1 if any(x < e and b < y for x, _, y in base) else 0 if harmless(run) else -1
            out.append((b, e, label, window(text, b, e)))
    return out


def spans_text(spans) -> str:
    """``kind:begin:end`` by begin, then kind as listed."""
    names = (*KINDS, MODEL_KIND)
    return ",".join(f"{names[k]}:{b}:{e}" for b, k, e in sorted(spans))


# --- the network -----------------------------------------------------------------------------------------

_CODES = np.zeros(128, np.int64)   # 0 padding, 1 any other character, then printable ASCII
_CODES[9:14] = 2
_CODES[32:127] = np.arange(2, 97)
N_CODES, EMBED, WIDTH, FILTERS, HIDDEN = 97, 12, 5, 24, 16
_POOLS = ((0, LEFT), (LEFT - 2, LEFT + BODY - 2), (LEFT + BODY - 4, WINDOW - WIDTH + 1))


def codes(windows: list[str]) -> np.ndarray:
    raw = np.frombuffer("".join(windows).encode("utf-32-le"), "<u4").reshape(len(windows), WINDOW)
    return np.where(raw < 128, _CODES[np.minimum(raw, 127)], 1)


def _forward(p: dict, x: np.ndarray):
    e = p["embed"][x]                                                     # n, window, embed
    cols = np.lib.stride_tricks.sliding_window_view(e, WIDTH, axis=1)     # n, steps, embed, width
    cols = np.ascontiguousarray(cols).reshape(len(x), -1, EMBED * WIDTH)
    conv = cols @ p["conv"] + p["conv_b"]
    arg = [conv[:, a:b].argmax(1) + a for a, b in _POOLS]
    pooled = np.concatenate([np.take_along_axis(conv, i[:, None], 1)[:, 0] for i in arg], 1)
    feat = np.maximum(pooled, 0)
    hid = np.maximum(feat @ p["hid"] + p["hid_b"], 0)
    return hid @ p["out"] + p["out_b"], (cols, arg, pooled, feat, hid)


def logits(p: dict, windows: list[str], batch: int = 2048) -> np.ndarray:
    """Calibrated logits of windows."""
    parts = [_forward(p, codes(windows[i:i + batch]))[0] for i in range(0, len(windows), batch)]
    return p["scale"] * np.concatenate(parts) + p["shift"] if parts else np.zeros(0)


def _gradients(p: dict, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    z, (cols, arg, pooled, feat, hid) = _forward(p, x)
    dz = (1 / (1 + np.exp(-z)) - y) * weight / len(x)
    g = {"out": hid.T @ dz, "out_b": dz.sum()}
    dhid = np.outer(dz, p["out"]) * (hid > 0)
    g |= {"hid": feat.T @ dhid, "hid_b": dhid.sum(0)}
    dpool = (dhid @ p["hid"].T) * (pooled > 0)
    g |= {"conv": np.zeros_like(p["conv"]), "conv_b": np.zeros_like(p["conv_b"]), "embed": np.zeros_like(p["embed"])}
    rows = np.arange(len(x))[:, None]
    for k, at in enumerate(arg):                     # a maximum sends its gradient to one step
        d = dpool[:, k * FILTERS:(k + 1) * FILTERS]
        g["conv_b"] += d.sum(0)
        g["conv"] += np.einsum("nfc,nf->cf", cols[rows, at], d)
        back = (d[:, :, None] * p["conv"].T[None]).reshape(len(x), FILTERS, EMBED, WIDTH)
        for w in range(WIDTH):
            np.add.at(g["embed"], x[rows, at + w], back[:, :, :, w])
    return g


def _random(rng, alphabet: str, n: int) -> str:
    return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), n))


_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_ALNUM = _UPPER + _LOWER + _DIGITS
_KEYS = ("token = \"", "api_key=", "secret: ", "password = '", "client_secret=", "Authorization: Bearer ",
         "private_key: ", "access_token\": \"", "aws_secret_access_key = ", "key=", "")
_BEFORE = ("", "", "see ", "page ", "http://example.com/", "version ", "file ", "order ", "on ", "id ")
_SOUNDS = tuple(a + v for a in ("b", "c", "d", "f", "g", "h", "l", "m", "n", "p", "r", "s", "t", "st", "tr", "sh", "") for v in "aeiou")


def _word(rng, low: int, high: int) -> str:
    out = ""
    while len(out) < low:
        out += _SOUNDS[int(rng.integers(0, len(_SOUNDS)))] + ("n", "r", "s", "t", "", "")[int(rng.integers(0, 6))]
    return out[:high]


def _key_value(rng) -> str:
    """A made-up key: one of some public formats, or random characters with or without a random prefix."""
    form = int(rng.integers(0, 16))
    if form < 8:
        return (("ghp_" + _random(rng, _ALNUM, 36)), ("sk_live_" + _random(rng, _ALNUM, 24)),
                ("xoxb-" + _random(rng, _DIGITS, 12) + "-" + _random(rng, _ALNUM, 24)),
                ("AIza" + _random(rng, _ALNUM + "_-", 35)), ("eyJhbGciOi" + _random(rng, _ALNUM, 40)),
                _random(rng, _ALNUM + "+/", 40), _random(rng, "0123456789abcdef", int(rng.choice([32, 40, 64]))),
                ("AKIA" + _random(rng, _UPPER + "234567", 16)))[form]
    alphabet = (_ALNUM, _ALNUM, _UPPER + _LOWER, _ALNUM + "_-", _LOWER + _DIGITS, _UPPER + _DIGITS, _ALNUM + "+/")[int(rng.integers(0, 7))]
    body = _random(rng, alphabet, int(rng.integers(20, 64)))
    if form < 13:
        prefix = ""
        for _ in range(int(rng.integers(1, 4))):
            prefix += _random(rng, (_LOWER, _LOWER, _UPPER, _UPPER + _LOWER, _LOWER + _DIGITS)[int(rng.integers(0, 5))],
                              int(rng.integers(1, 7))) + "__--."[int(rng.integers(0, 5))]
        return prefix + body
    if form == 13:
        return body + "." + _random(rng, alphabet, int(rng.integers(16, 44)))
    return body


def _harmless_value(rng) -> str:
    """A made-up look-alike: names, paths, dates, versions, numbers, identifiers."""
    w = lambda a=3, b=9: _word(rng, a, b)
    d = lambda n: _random(rng, _DIGITS, n)
    some = int(rng.integers(2, 5))
    return (w(12, 20) + d(2), f"20{d(2)}-{d(2)}-{d(2)}T{d(2)}", "/".join(w() for _ in range(some)) + "/v" + d(1),
            "_".join(w() for _ in range(max(some, 3))) + "_" + d(1), "-".join(w() for _ in range(max(some, 3))) + "-" + d(2),
            d(18) + "x", d(int(rng.integers(12, 20))), "".join([w(), *[w().capitalize() for _ in range(some)]]) + w(4),
            "".join(w(4).capitalize() for _ in range(some)) + w(4), "_".join(w(4).upper() for _ in range(max(some, 3))),
            f"{w()}_{w()}_v{d(2)}.pdf", f"mail{d(1)}.{w(5)}.com", f"www.{w()}-{w()}.org/{d(4)}", f"{d(4)}/{d(2)}/{d(2)}/{w()}-{w()}",
            f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"+{d(2)}-{d(3)}-{d(7)}", f"{w(4)}-{d(1)}.{d(2)}.{d(1)}-beta.{d(1)}",
            f"{w(4).upper()}-{d(4)}-{d(5)}", f"{w()}.{w()}.{w()}({d(1)}".replace("(", "."), f"====={w(4)}=====",
            f"{w(5)}={d(4)}", f"{w(6)}/{w(6)}_{d(3)}.html", "-" * 12 + d(1), f"{w(3).capitalize()}{d(4)}-{d(4)}",
            )[int(rng.integers(0, 24))]


def _prose(rng, n: int) -> str:
    """At least ``n`` characters of made-up running text."""
    out = ""
    while len(out) < n:
        w = _word(rng, 1, 9)
        w = (w, w, w, w.capitalize(), w.upper(), _random(rng, _DIGITS, 3), "é" + w, w + "ß")[int(rng.integers(0, 8))]
        out += w + (" ", " ", " ", " ", ", ", ". ", "\n", ": ", "; ", " (")[int(rng.integers(0, 10))]
    return out


def _variants(rng, near: list[str], n: int) -> tuple[list[str], list[float]]:
    """Windows with made-up keys (1) and harmless look-alikes (0), half of them in contexts of ``near``."""
    out, y = [], []
    for i in range(n):
        value, before = (_key_value(rng), _KEYS) if i % 2 else (_harmless_value(rng), _BEFORE)
        if near and i % 4 < 2:
            around = near[i % len(near)]
            # the last word before a finding may name it
            left, right = " ".join(around[:LEFT].strip("\0").split(" ")[:-2]), " " + around[-RIGHT:].strip("\0").lstrip("\"' ")
        else:
            left = _prose(rng, LEFT + 6)[int(rng.integers(0, 30)):]
            right = ("\n", " ", " ", ". ", ", ", "\"\n", ") ", "' ")[int(rng.integers(0, 8))] + _prose(rng, RIGHT)
            right = "" if rng.random() < 0.1 else right
        key = before[int(rng.integers(0, len(before)))]
        text = f"{left} {key}{value}{right}"
        at = len(left) + 1 + len(key)
        out.append(window(text, at, at + len(value)))
        y.append(float(i % 2))
    return out, y


def shard_rows(positive: list[str], negative: list[str], seed: int, made_up: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Labelled and made-up windows of a shard, their labels, and which third is held out."""
    rng = np.random.default_rng(seed)
    more, label = _variants(rng, sorted(positive + negative), made_up)
    windows = [*positive, *negative, *more]
    held = np.zeros(len(windows), bool)
    held[rng.permutation(len(windows))[::3]] = True
    return windows, np.array([1.0] * len(positive) + [0.0] * len(negative) + label), held


def start(seed: int) -> dict:
    """First weights."""
    rng = np.random.default_rng(seed)
    p = {"embed": rng.normal(0, 0.3, (N_CODES, EMBED)), "conv": rng.normal(0, 0.15, (EMBED * WIDTH, FILTERS)),
         "conv_b": np.zeros(FILTERS), "hid": rng.normal(0, 0.15, (FILTERS * len(_POOLS), HIDDEN)),
         "hid_b": np.zeros(HIDDEN), "out": rng.normal(0, 0.2, HIDDEN), "out_b": np.zeros(())}
    p["embed"][0] = 0
    return p


def pack(*trees: dict) -> np.ndarray:
    """Weights and moments as one vector."""
    return np.concatenate([np.ravel(t[k]) for t in trees for k in sorted(t)])


def unpack(flat: np.ndarray) -> list[dict]:
    like = start(0)
    out, at = [], 0
    while at < len(flat):
        tree = {}
        for k in sorted(like):
            n = like[k].size
            tree[k] = flat[at:at + n].reshape(like[k].shape)
            at += n
        out.append(tree)
    return out


def epoch(flat: np.ndarray, step: int, windows: list[str], y: np.ndarray, share: float, seed) -> np.ndarray:
    """Weights and moments (``flat``) after one pass over the windows; ``share``: of secrets among all windows."""
    p, m1, m2 = unpack(flat)
    x = codes(windows)
    weight = np.where(y == 1, 0.5 / share, 0.5 / max(1 - share, 1e-3))
    order = np.random.default_rng(seed).permutation(len(x))
    for at in range(0, len(order), 128):
        some = order[at:at + 128]
        step += 1
        for k, g in _gradients(p, x[some], y[some], weight[some]).items():
            m1[k] = 0.9 * m1[k] + 0.1 * g
            m2[k] = 0.999 * m2[k] + 0.001 * g * g
            p[k] = p[k] - 0.003 * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)
    return pack(p, m1, m2)


def _first(seed: int) -> np.ndarray:
    p = start(seed)
    none = {k: np.zeros_like(v) for k, v in p.items()}
    return pack(p, none, none)


def _threshold(keep: float, other: float) -> float:
    """From the score that leaves the wished recall and the one that 0.2 % of the look-alikes reach."""
    return min(keep, (keep + other) / 2)


def _refuse(wrong: float, max_false: float) -> None:
    if wrong > max_false:
        raise ValueError(f"recall {RECALL} would take {wrong:.1%} of harmless look-alikes for secrets")


def train(positive: list[str], negative: list[str], epochs: int = EPOCHS, seed: int = SEED, max_false: float = MAX_FALSE) -> dict:
    """Weights, calibration and threshold from labelled windows of one shard, with the held-out share of look-alikes that
    pass it.  ``fit`` does the same over the windows of a table."""
    windows, y, held = shard_rows(positive, negative, seed, MADE_UP)
    fitted, yf, flat, step = [w for w, h in zip(windows, held) if not h], y[~held], _first(seed), 0
    for i in range(epochs):
        flat = epoch(flat, step, fitted, yf, max(yf.mean(), 1e-3), [seed, i])
        step += -(-len(fitted) // 128)
    p = unpack(flat)[0]
    z, y = logits(p | {"scale": 1.0, "shift": 0.0}, [w for w, h in zip(windows, held) if h]), y[held]
    scale, shift = 1.0, 0.0
    for _ in range(200):                              # logistic calibration, slightly regularised
        q = 1 / (1 + np.exp(-(scale * z + shift)))
        scale -= 0.05 * (((q - y) * z).mean() + 1e-3 * (scale - 1))
        shift -= 0.05 * (q - y).mean()
    z = scale * z + shift
    score, other = np.sort(z[y == 1]), np.sort(z[y == 0])
    keep = _threshold(float(score[int((1 - RECALL) * len(score))]), float(other[int(0.998 * len(other))]))
    wrong = float((other >= keep).mean())
    _refuse(wrong, max_false)
    return p | {"scale": scale, "shift": shift, "threshold": keep, "false_alarms": wrong}


# --- on Spark ----------------------------------------------------------------------------------------------

_FOUND = T.StructType([
    T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()), T.StructField("n_hex", T.LongType()),
    T.StructField("base", T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in ("begin", "kind", "end")]))),
    T.StructField("cands", T.ArrayType(T.StructType([
        T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()),
        T.StructField("label", T.IntegerType()), T.StructField("window", T.StringType())])))])
_BASE = pa.list_(pa.struct([(c, pa.int32()) for c in ("begin", "kind", "end")]))
_CANDS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("label", pa.int32()), ("window", pa.string())]))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, counts by rule, rule spans and candidates of every document (written; texts stay behind)."""
    t = docs.select("doc_id", whole(text).alias("t"))

    def run(batches):
        for b in batches:
            base = [base_spans(x) for x in b.column(1).to_pylist()]
            cands = [candidates(x.as_py(), s) for x, s in zip(b.column(1), base)]
            counts = [pa.array([sum(k == i for _, k, _ in s) for s in base], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([
                b.column(0), *counts,
                pa.array([[dict(zip(("begin", "kind", "end"), x)) for x in s] for s in base], _BASE),
                pa.array([[dict(zip(("begin", "end", "label", "window"), x)) for x in c] for c in cands], _CANDS),
            ], ["doc_id", *_FOUND.names])
    return materialize(t.mapInArrow(run, T.StructType([t.schema["doc_id"], *_FOUND.fields])), "secrets")


def training_rows(scanned: DataFrame, seed: int = SEED) -> DataFrame:
    """(shard, held, y, window): all different labelled windows and made-up ones (written)."""
    c = scanned.select(F.explode("cands").alias("c")).select("c.label", "c.window").where("label >= 0").distinct()
    c = materialize(c, "labelled")
    n = max(1, -(-c.count() // SHARD))
    c = c.select(F.pmod(F.xxhash64("window"), F.lit(n)).alias("shard"), "label", "window")
    c = c.union(scanned.sparkSession.range(n).select("id", F.lit(-1), F.lit("")))       # a shard without windows has made-up ones

    made_up = MADE_UP

    def make(t: pa.Table) -> pa.Table:
        of = [sorted(w for w, x in zip(t["window"].to_pylist(), t["label"].to_pylist()) if x == label) for label in (1, 0)]
        shard = t["shard"][0].as_py()
        windows, y, held = shard_rows(*of, seed + shard, made_up)
        return pa.table([pa.array(np.full(len(y), shard)), pa.array(held), pa.array(y), pa.array(windows, pa.string())],
                        names=["shard", "held", "y", "window"])
    return materialize(c.groupBy("shard").applyInArrow(make, "shard bigint, held boolean, y double, window string"), "training")


def _shard_epoch(flat: np.ndarray, step: int, i: int, n: int, share: float, seed: int):
    """A shard's part of the mean weights and moments after epoch ``i``."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("window", "ascending"), ("y", "ascending")])
        got = epoch(flat, step, t["window"].to_pylist(), t["y"].to_numpy(), share, [seed, t["shard"][0].as_py(), i])
        return pa.table([pa.array(np.arange(len(got))), pa.array(got * (len(t) / n))], names=["at", "v"])
    return run


def fit(scanned: DataFrame, epochs: int = EPOCHS, seed: int = SEED, max_false: float = MAX_FALSE) -> dict:
    """The network from all labelled windows, its calibration and threshold from all held-out ones."""
    rows = training_rows(scanned, seed)
    fitted = rows.where("not held")
    shards = fitted.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("ones"))
    n, ones, longest = shards.agg(F.sum("n"), F.sum("ones"), F.max("n")).first()
    flat, step = _first(seed), 0
    for i in range(epochs):
        # decimals: the mean does not depend on the order of the sum
        one = _shard_epoch(flat, step, i, n, max(ones / n, 1e-3), seed)
        mean = fitted.groupBy("shard").applyInArrow(one, "at bigint, v double").groupBy("at").agg(
            F.sum(F.col("v").cast("decimal(28,20)")).cast("double").alias("v"))
        flat = np.array([r[0] for r in mean.orderBy("at").select("v").collect()])      # as many as weights and moments
        step += -(-longest // 128)
    p = unpack(flat)[0]
    known = scanned.sparkSession.sparkContext.broadcast(p | {"scale": 1.0, "shift": 0.0})

    def score(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(logits(known.value, b.column(1).to_pylist()))],
                                             ["y", "window", "z"])
    held = rows.where("held").select("y", "window").mapInArrow(score, "y double, window string, z double")
    held = with_global_position(held, ["y", "z", "window"], "at").select("y", "z", "at")
    held = materialize(held, "held-out")
    scale, shift = _calibrated(held)
    n0, n1 = held.agg(F.sum(1 - F.col("y")).cast("bigint"), F.sum("y").cast("bigint")).first()
    at = {"keep": n0 + int((1 - RECALL) * n1), "other": int(0.998 * n0)}
    z = {r["at"]: r["z"] for r in held.where(F.col("at").isin(*at.values())).collect()}
    raw = _threshold(z[at["keep"]], z[at["other"]])
    wrong = held.where("y = 0").agg(F.avg((F.col("z") >= raw).cast("double"))).first()[0]
    _refuse(wrong, max_false)
    return p | {"scale": scale, "shift": shift, "threshold": scale * raw + shift, "false_alarms": wrong}


def _calibrated(held: DataFrame) -> tuple[float, float]:
    """Scale and shift of the logits by a logistic fit over all held-out windows; they change no choice."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    x = held.select("y", array_to_vector(F.array("z")).alias("x"))
    m = LogisticRegression(featuresCol="x", labelCol="y", regParam=1e-3).fit(x)
    scale = float(m.coefficients[0])
    return (scale, float(m.intercept)) if scale > 0 else (1.0, 0.0)


def _chosen(model: dict, base, cands) -> list[list[tuple[int, int, int]]]:
    """Rule spans and accepted candidates of several documents."""
    open_ = [(i, b, e, w) for i, cs in enumerate(cands) for b, e, label, w in cs if label != 1]
    out = [list(s) for s in base]
    for (i, b, e, _), z in zip(open_, logits(model, [x[3] for x in open_])):
        if z >= model["threshold"]:
            out[i].append((b, len(KINDS), e))
    return out


def find_secrets(docs: DataFrame, text: str = "text", model: dict | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_model) per document."""
    scanned = scan(docs, text)
    known = docs.sparkSession.sparkContext.broadcast(model or fit(scanned))
    schema = T.StructType([scanned.schema["doc_id"], *_FOUND.fields[:3], T.StructField("base_sha256", T.StringType()),
                           T.StructField("spans", T.StringType()), T.StructField("n_model", T.LongType())])

    def run(batches):
        for b in batches:
            base = [[(x["begin"], x["kind"], x["end"]) for x in s] for s in b.column(4).to_pylist()]
            cands = [[(x["begin"], x["end"], x["label"], x["window"]) for x in s] for s in b.column(5).to_pylist()]
            spans = _chosen(known.value, base, cands)
            yield pa.RecordBatch.from_arrays([
                *b.columns[:4], pa.array([hashlib.sha256(spans_text(s).encode()).hexdigest() for s in base], pa.string()),
                pa.array([spans_text(s) for s in spans], pa.string()),
                pa.array([len(s) - len(t) for s, t in zip(spans, base)], pa.int64())], schema.names)
    return scanned.mapInArrow(run, schema)


def redact(docs: DataFrame, text: str = "text", model: dict | None = None, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``mask`` (touching spans by one); null text stays null."""
    known = docs.sparkSession.sparkContext.broadcast(model or fit(scan(docs, text)))
    at = docs.columns.index(text)

    def run(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            base = [base_spans(x or "") for x in texts]
            spans = _chosen(known.value, base, [candidates(x or "", s) for x, s in zip(texts, base)])
            for i, s in enumerate(spans):
                stop, parts = 0, []
                for begin, _, end in sorted(s):
                    if begin > stop or not parts:
                        parts += [texts[i][stop:begin], mask]
                    stop = max(stop, end)
                if parts:
                    texts[i] = "".join(parts) + texts[i][stop:]
            columns = list(b.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, b.schema.names)
    return docs.mapInArrow(run, docs.schema)
