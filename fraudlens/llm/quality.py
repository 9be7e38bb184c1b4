"""Quality rules: a ledger of rule bits and measurements, policies and ablations.

Every rule is evaluated once per document and leaves one bit in ``fail_bits``
(set = failed) beside the measurements it was decided on.  A policy is a
version name with a mask of the rules that it enforces; applying it is one
bitwise and.  Ablations ask what a policy would keep without each of its
rules; they are sums over the bits, so the texts are not read again.

All expressions are built-in functions: no shuffle, no Python on the
executors.  Defined cases: a null text counts as empty and fails
``few_words``; repeated rows are judged alike; an empty table gives an empty
ledger; the ledger is one struct column, so input columns with the names of
measurements are untouched.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.textops import let, n_without, shingles, whole, words

SYMBOLS = "#*$%&|<>"                                   # fixed by the contract

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]


def _repeat_words(w: Column) -> Column:
    """Words that lie in a 3-word window whose words occur twice or more in the text.

    Equal windows are neighbours after sorting (window, position); a text
    without a repeated window skips the sort."""
    def covered(s):
        hit = F.filter(F.transform(s, lambda x, i: F.when(
            F.get(s, i - 1)["g"].eqNullSafe(x["g"]) | F.get(s, i + 1)["g"].eqNullSafe(x["g"]), x["i"])),
            lambda p: p.isNotNull())
        return F.size(F.array_distinct(F.flatten(F.transform(hit, lambda p: F.array(p, p + 1, p + 2)))))

    def of(g):
        pairs = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(pairs, covered))
    return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(shingles(w, 3), of))


def measure(text) -> Column:
    """Struct of the measurements (bigint each) of one text column."""
    x = whole(text)
    lines = F.filter(F.split(x, "\n", -1), lambda l: n_without(l, " \t\n\x0b\x0c\r") > 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    n = F.length(x)

    def of(w):
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            n_without(x, " \t\n\x0b\x0c\r").cast("bigint").alias("word_chars"),
            (n - n_without(x, SYMBOLS)).cast("bigint").alias("n_symbols"),
            let(lines, lambda l: (F.size(l) - F.size(F.array_distinct(l))).cast("bigint")).alias("n_dup_lines"),
            _repeat_words(w).cast("bigint").alias("n_repeat_words"),
            F.size(lines).cast("bigint").alias("n_lines"),
            (n - n_without(x, upper)).cast("bigint").alias("n_upper"))
    return let(words(x), of)


@dataclass(frozen=True)
class Rule:
    name: str
    bit: int
    failed: object              # measurements struct column -> boolean column


RULES = (
    Rule("few_words", 0, lambda m: m["n_words"] < 50),
    Rule("repeated_windows", 1, lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    Rule("symbols", 2, lambda m: 100 * m["n_symbols"] > 5 * m["word_chars"]),
    Rule("duplicate_lines", 3, lambda m: 100 * m["n_dup_lines"] > 50 * m["n_lines"]),
    Rule("upper_case", 4, lambda m: 100 * m["n_upper"] > 30 * m["word_chars"]),
    Rule("long_words", 5, lambda m: m["word_chars"] > 12 * m["n_words"]),
)
BASE_MASK = 0b000011


@dataclass(frozen=True)
class Policy:
    version: str
    mask: int


POLICIES = {p.version: p for p in (Policy("base", BASE_MASK), Policy("v1", 0b111111))}
DEFAULT_POLICY = POLICIES["v1"]


def fail_bits(m: Column, rules=RULES) -> Column:
    bits = F.lit(0).cast("bigint")
    for r in rules:
        bits = bits.bitwiseOR(F.when(r.failed(m), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("bigint"))
    return bits


def ledger_of(text, rules=RULES) -> Column:
    """Struct (fail_bits, measurements...): every rule evaluated once."""
    return let(measure(text), lambda m: F.struct(fail_bits(m, rules).alias("fail_bits"),
                                                 *[m[c].alias(c) for c in MEASURES]))


def ledger(docs: DataFrame, text: str = "text", name: str = "ledger", rules=RULES) -> DataFrame:
    """``docs`` with one more column ``name``: the ledger struct (an input column of that name is replaced)."""
    return docs.withColumn(name, ledger_of(text, rules))


def passes(bits: Column, policy: Policy) -> Column:
    return bits.bitwiseAND(F.lit(policy.mask)) == 0


def apply_policy(led: DataFrame, policy: Policy = DEFAULT_POLICY, name: str = "ledger") -> DataFrame:
    """Rows of a ledger that the policy keeps."""
    return led.where(passes(F.col(name)["fail_bits"], policy))


def ablation(led: DataFrame, policy: Policy = DEFAULT_POLICY, name: str = "ledger", rules=RULES) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail only it, and that the policy would
    keep without it.  Equal bit patterns are counted first, so at most 2^rules rows are left to sum."""
    pats = led.groupBy(F.col(name)["fail_bits"].bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(
        F.count(F.lit(1)).alias("n"))
    rows = []
    for r in rules:
        bit = 1 << r.bit
        if policy.mask & bit:
            rows.append(F.struct(F.lit(r.name).alias("rule"),
                                 F.when(F.col("bits").bitwiseAND(F.lit(bit)) != 0, F.col("n")).otherwise(0).alias("f"),
                                 F.when(F.col("bits") == bit, F.col("n")).otherwise(0).alias("s"),
                                 F.when(F.col("bits").bitwiseAND(F.lit(policy.mask & ~bit)) == 0, F.col("n"))
                                 .otherwise(0).alias("k")))
    return (pats.select(F.explode(F.array(*rows)).alias("r")).groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum("r.f").alias("n_failed"), F.sum("r.s").alias("n_only"), F.sum("r.k").alias("n_kept_without")))


def quality_digest(docs: DataFrame) -> DataFrame:
    """The columns of the registered query, per document."""
    led = ledger(docs.select("doc_id", "text"), name="led").select("doc_id", "led")
    bits = F.col("led.fail_bits")
    return led.select("doc_id", *[F.col(f"led.{c}").alias(c) for c in MEASURES[:5]],
                      (~passes(bits, POLICIES["base"])).alias("base_failed"),
                      passes(bits, DEFAULT_POLICY).alias("kept"), bits.alias("fail_bits"),
                      F.col("led.n_lines").alias("n_lines"), F.col("led.n_upper").alias("n_upper"))


QUALITY_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS x FROM documents),
w AS (
  SELECT rid, doc_id, x, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (
  SELECT rid, i, list_extract(w, i) || ' ' || list_extract(w, i + 1) || ' ' || list_extract(w, i + 2) AS g
  FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 2)) AS i FROM w WHERE len(w) >= 3)),
d AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM g) WHERE n >= 2),
r AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM d) GROUP BY rid),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         len(ls)::BIGINT AS n_lines, (length(x) - length(regexp_replace(x, '[A-Z]', '', 'g')))::BIGINT AS n_upper
  FROM w LEFT JOIN r USING (rid)),
b AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
         + CASE WHEN 100 * n_symbols > 5 * word_chars THEN 4 ELSE 0 END
         + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
         + CASE WHEN 100 * n_upper > 30 * word_chars THEN 16 ELSE 0 END
         + CASE WHEN word_chars > 12 * n_words THEN 32 ELSE 0 END)::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 AS base_failed,
       fail_bits = 0 AS kept, fail_bits, n_lines, n_upper FROM b
"""
