"""Entry point: data sources, table functions and the SQL surface on a Spark session."""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .functions.table_functions import register_functions
from .plans import hints
from .plans.statements import parse_copy, rewrite
from .shipping import ship
from .sources.reader import GordSource, GorSource, GorzSource
from .sources.writer import DelimitedSource

SOURCES = {source.kind: source for source in (GorzSource, GordSource, GorSource)}
_views = itertools.count()


def register(spark: SparkSession) -> None:
    """Make the formats gor, gorz and gord and the read_gor functions known to the session."""
    ship(spark)
    if getattr(spark, "_locuspark_registered", False):
        return
    spark._locuspark_registered = True
    for source in (*SOURCES.values(), DelimitedSource):
        spark.dataSource.register(source)
    register_functions(spark)


class _Scan:
    """One reference to a table within a statement."""

    def __init__(self, engine: Engine, kind: str, options: dict[str, str]):
        self.engine, self.kind, self.options = engine, kind, engine._settings(options)
        # The driver reads headers as well as Spark's planning process would, without starting one.
        self.schema, self.columns = SOURCES[kind](self.options).described()

    def load(self, **more: str) -> DataFrame:
        return self.engine.spark.read.format(self.kind).schema(self.schema).options(**self.options, **more).load()


class Engine:
    """Reads, writes and SQL over position-sorted tables."""

    def __init__(self, spark: SparkSession, file_search_path: str | None = None):
        self.spark, self.file_search_path = spark, file_search_path
        register(spark)

    def _settings(self, options: dict[str, str]) -> dict[str, str]:
        settings = {k: v for k in ("gor.bucket.file.count.threshold", "gor.bucket.initial.usage.threshold") if (v := self.spark.conf.get(f"spark.{k}", None))}
        if self.file_search_path:
            settings["file_search_path"] = self.file_search_path
        return settings | {k.lower(): v for k, v in options.items()}

    def read_gor(
        self, path: str, f: list[str] | None = None, ff: str | None = None, range: str | None = None, source: str | None = None, columns: list[str] | None = None, where: str | None = None, kind: str = "gor", **options: str
    ) -> DataFrame:
        """A table by path; a dictionary if the suffix is .gord (or kind is 'gord').

        where: a SQL condition on the rows. Unlike a filter on the result it also prunes blocks, files and tags.
        """
        given = {"path": path, "ff": ff, "range": range, "source": source, "f": json.dumps([x for x in f if x is not None]) if f else None, "columns": json.dumps(columns) if columns else None}
        options = {k: v for k, v in given.items() if v is not None} | options
        if where is None:
            return _Scan(self, kind, options).load()
        return self._query(lambda view: f"SELECT * FROM {view(kind, options)} WHERE ({where})")

    def read_gorz(self, path: str, **options) -> DataFrame:
        return self.read_gor(path, kind="gorz", **options)

    def read_gord(self, path: str, **options) -> DataFrame:
        return self.read_gor(path, kind="gord", **options)

    def write_gor(self, df: DataFrame, path: str, **options: str) -> None:
        """Write sorted rows; the suffix .gor gives plain text, anything else the compressed format."""
        df.write.format("gor" if path.lower().endswith(".gor") else "gorz").options(**options).mode("overwrite").save(path)

    def _query(self, text: Callable[[Callable[[str, dict[str, str]], str]], str]) -> DataFrame:
        """Run a query over views that ``text`` asks for, each with what the query needs of it (``plans.hints``)."""
        scans: dict[str, _Scan] = {}

        def view(kind: str, options: dict[str, str]) -> str:
            name = f"locus_view_{next(_views)}"
            scans[name] = _Scan(self, kind, options)
            scans[name].load(**{hints.REF: name}).createOrReplaceTempView(name)
            return name

        query = text(view)
        found = hints.find(self.spark, query, {name: x.columns for name, x in scans.items()}) if scans else None
        if found is None:
            return self.spark.sql(query)
        for name, hint in found.items():
            scans[name].load(**{hints.REF: name, "hint": hint.to_option()}).createOrReplaceTempView(name)
        # Beyond an alias no later step can reach columns that the query itself left out.
        out = self.spark.sql(query).alias("result")
        for name in scans:
            self.spark.catalog.dropTempView(name)
        return out

    def sql(self, statement: str) -> DataFrame:
        """Spark SQL, with read_gor*('path', f := [...], ...), FROM 'x.gorz', and COPY (query) TO 'path' (FORMAT ...)."""
        copy = parse_copy(statement)
        if copy is None:
            return self._query(lambda view: rewrite(statement, view))
        df = self._query(lambda view: rewrite(copy.query, view))
        if copy.format == "csv":
            from .operators.tables import write_delimited

            write_delimited(df, copy.path, copy.options)
        else:
            df.write.format(copy.format).options(**copy.options).mode("overwrite").save(copy.path)
        return self.spark.createDataFrame([], "rows long")
