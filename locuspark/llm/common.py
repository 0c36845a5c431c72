"""Helpers shared by the corpus operators: shared storage, row keys, skew-safe lookups."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import shared_dir

#: ASCII white space, [\x20\x09-\x0D], as the contracts of the operators define it.
BLANKS = " \t\n\x0b\x0c\r"
#: The same words as a Java regular expression.
WORD = r"[^\x20\x09-\x0D]+"
#: A key is hot if it holds at least this share of all rows, so there are at most 1/HOT_SHARE hot keys.
HOT_SHARE = 1e-3


@dataclass
class Run:
    """The tables that one run of a pipeline has written to its own folder."""

    folder: str
    tables: list[str] = field(default_factory=list)


#: The run that this thread's tables belong to, if there is one.
_run: ContextVar[Run | None] = ContextVar("run", default=None)


@contextmanager
def own_run(spark: SparkSession, name: str) -> Iterator[Run]:
    """Within, intermediate tables go to a folder of their own, which other runs of the session neither see nor sweep."""
    run = Run(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    token = _run.set(run)
    try:
        yield run
    finally:
        _run.reset(token)


def scratch_path(spark: SparkSession, name: str) -> str:
    run = _run.get()
    path = f"{run.folder if run else shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if run:
        run.tables.append(path)
    return path


def sweep(spark: SparkSession, run: Run, *keep: DataFrame) -> None:
    """Delete the tables of a run but for those of ``keep``; results that read them must have been written."""
    kept = {getattr(df, "scratch", None) for df in keep}
    for path in [x for x in run.tables if x not in kept]:
        _delete(spark, path)
        run.tables.remove(path)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def materialise(df: DataFrame, name: str, **options) -> DataFrame:
    """Cut the lineage: write ``df`` as a table in the shared folder and read it back.

    Unlike localCheckpoint, the files survive the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``materialise`` that nothing reads any more."""
    for df in tables:
        path = getattr(df, "scratch", None)
        if path:
            _delete(df.sparkSession, path)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names for internal use that don't clash with those of ``df``, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def pinned(col: Column) -> Column:
    """The same values, computed once where this column is made.

    The optimizer moves a filter on later columns, with all that they are made of, below a projection; within a
    lambda a list would then be made anew for each element. It does not do so with columns
    that it takes for nondeterministic.
    """
    return F.when(F.monotonically_increasing_id() >= 0, col)


def hash128(*cols: Column) -> list[Column]:
    """Two independent 64-bit hashes; together they don't collide in practice."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit(7_046_029_254_386_353_131), *cols)]


def lookup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    share: str,
    how: str = "left",
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Join ``left`` with ``right``, which has one row for each key, when ``left`` may have hot keys.

    ``right[share]`` counts the rows of a key in ``left``. Keys with at least
    ``hot_share`` of all rows number at most ``1 / hot_share``, so these few
    rows of ``right`` are broadcast; their rows of ``left`` are dealt out by a
    hash of the whole row in the shuffle join that serves all others, where
    they meet no partner. Null keys match null keys. The column ``share`` is dropped.
    """
    own = [c for c in right.columns if c not in keys and c != share]
    total = right.agg(F.sum(share)).first()[0] or 0
    least = max(2, int(total * hot_share))
    rest = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[F.col(c).alias(f"_r_{c}") for c in own], F.lit(0).alias("_r_salt"))
    small = right.where(F.col(share) >= least)
    if is_empty(small):
        on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
        out = left.join(rest, _all(on), how)
        return out.select(*left.columns, *[F.col(f"_r_{c}").alias(c) for c in own])
    # At most 1 / hot_share rows: the counts of all keys add up to total.
    small = small.select(*[F.col(k).alias(f"_h_{k}") for k in keys], *[F.col(c).alias(f"_h_{c}") for c in own], F.lit(True).alias("_hot"))
    spread = left.join(F.broadcast(small), _all([F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys]), "left")
    salt = F.when(F.col("_hot"), F.xxhash64(*[quoted(c) for c in left.columns]).bitwiseOR(F.lit(1))).otherwise(F.lit(0).cast("long"))
    spread = spread.withColumn("_salt", salt)
    out = spread.join(rest, _all([F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys] + [F.col("_salt") == F.col("_r_salt").cast("long")]), "left")
    if how == "inner":
        out = out.where(F.col("_hot") | F.col("_r_salt").isNotNull())
    return out.select(*left.columns, *[F.when(F.col("_hot"), F.col(f"_h_{c}")).otherwise(F.col(f"_r_{c}")).alias(c) for c in own])


def _all(parts: Sequence[Column]) -> Column:
    out = parts[0]
    for x in parts[1:]:
        out = out & x
    return out


def with_text(docs: DataFrame, text: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(docs[text].cast("string"), F.lit(""))


def numbered(docs: DataFrame, *without: str) -> list[Column]:
    """The columns of ``docs`` as ``_c0``, ``_c1``, ..., so that no name of theirs clashes with internal ones."""
    return [quoted(c).alias(f"_c{i}") for i, c in enumerate(docs.columns) if c not in without]


def renumbered(docs: DataFrame, text_col: str, text: Column) -> list[Column]:
    """The columns of ``docs`` back from ``numbered``, with another text and, if there is ``n_chars``, its new length."""
    new = {text_col: text} | ({"n_chars": F.length(text).cast("long")} if "n_chars" in docs.columns else {})
    return [new.get(c, F.col(f"_c{i}")).alias(c) for i, c in enumerate(docs.columns)]
