"""``read_gor``, ``read_gorz`` and ``read_gord`` as Python table functions for plain ``spark.sql``.

They read in one task and without pushed filters; ``Engine.sql`` plans the same calls as data source scans.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..sources.reader import GordSource, GorSource, GorzSource, TableSource

NAMES = ("f", "ff", "range", "source")


def _options(path: str | None, given: dict) -> dict[str, str]:
    if not isinstance(path, str):
        raise ValueError("read_gor expects a single VARCHAR file path")
    out = {"path": path}
    for name in NAMES:
        value = given.get(name)
        if value is not None:
            out[name] = value if isinstance(value, str) else json.dumps(list(value))
    return out


def _function(kind: type[TableSource]):
    class ReadTable:
        @staticmethod
        def analyze(path: AnalyzeArgument, f: AnalyzeArgument | None = None, ff: AnalyzeArgument | None = None, range: AnalyzeArgument | None = None, source: AnalyzeArgument | None = None) -> AnalyzeResult:
            given = {n: a.value for n, a in zip(NAMES, (f, ff, range, source), strict=True) if a is not None}
            return AnalyzeResult(kind(_options(path.value, given)).schema())

        def eval(self, path, f=None, ff=None, range=None, source=None) -> Iterator[tuple]:
            table = kind(_options(path, dict(zip(NAMES, (f, ff, range, source), strict=True))))
            reader = table.reader(table.schema())
            for part in reader.partitions():
                for batch in reader.read(part):
                    yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

    return udtf(ReadTable)


def register_functions(spark: SparkSession) -> None:
    for name, kind in (("read_gor", GorSource), ("read_gorz", GorzSource), ("read_gord", GordSource)):
        spark.udtf.register(name, _function(kind))
