"""Small column helpers shared by the text operators."""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.session import materialize

WORD = r"[^\x20\x09-\x0D]+"             # fixed by the contracts: a run of non-white-space
_WHITE = "\t\n\x0b\x0c\r"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, even where ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def whole(text) -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a non-null text, in order."""
    return F.array_remove(F.split(F.translate(text, _WHITE, " " * len(_WHITE)), " ", -1), "")


def n_without(text: Column, chars: str) -> Column:
    """Code points of ``text`` that are not in ``chars``."""
    return F.length(F.translate(text, chars, ""))


def lower_ascii(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def shingles(w: Column, k: int) -> Column:
    """All ``k``-word shingles of a word array (an attribute or lambda variable), joined by one
    space, repeats included; fewer words than ``k``: the whole sequence as one; none: empty."""
    n = F.size(w)
    windows = F.transform(F.slice(w, 1, F.greatest(n - (k - 1), F.lit(0))),
                          lambda x, i: F.concat_ws(" ", x, *[F.get(w, i + j) for j in range(1, k)]))
    return (F.when(n >= k, windows).when(n > 0, F.array(F.array_join(w, " ")))
            .otherwise(F.array().cast("array<string>")))


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a bigint column ``name``, unique for each row and the same whenever the rows are read.

    Rows straight from files are numbered by file and position, others by a written copy."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    file, at = f"{name}_file", f"{name}_at"
    if plan.getClass().getSimpleName() == "LogicalRelation":
        try:
            rows = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(at))
        except AnalysisException:
            rows = None
        if rows is not None:
            # one row for each file; 2^40 rows of a file
            files = rows.select(file).distinct().withColumn(name, F.row_number().over(Window.orderBy(file)).cast("bigint"))
            files = materialize(files, "files")
            return rows.join(F.broadcast(files), file).withColumn(name, F.shiftleft(F.col(name), 40) + F.col(at)).select(
                *docs.columns, name)
    return materialize(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")
