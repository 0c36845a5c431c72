"""A stream of the rows of files that are added to a dictionary.

The offset is the number of the dictionary's lines; each micro-batch reads the files of the lines since
the last one. Lines are expected to be appended; buckets and deletions are for batch reads.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyspark.sql.types as T
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSourceStreamReader, InputPartition

from ..plans import dictionary as D
from ..plans import scan as S
from ..plans.ranges import Window
from ..sources.reader import FileScan, GordSource, Part, Reader


class GordStreamReader(DataSourceStreamReader):
    def __init__(self, path: str, schema: T.StructType, full: T.StructType, options: dict[str, str], tags: list[str], window: Window):
        self.path, self.tags, self.window = path, set(tags), window
        self.inner = Reader(path, D.load(path), tags, window, full, schema, options)

    def initialOffset(self) -> dict:
        return {"lines": 0}

    def latestOffset(self) -> dict:
        return {"lines": len(D.load(self.path).entries)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        fresh = D.load(self.path).entries[start["lines"] : end["lines"]]
        wanted = [e for e in fresh if not e.deleted and (not self.tags or self.tags.intersection(e.tags)) and e.overlaps(self.window)]
        return [Part(((D.Scan(e.path, None if e.rows_tagged else (e.tags or ("",))[0], e.rows_tagged, frozenset(self.tags) if self.tags and e.rows_tagged else None), S.Piece(e.path, 0, None, self.window.chrom is not None)),)) for e in wanted] or [Part()]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for one, piece in getattr(partition, "scans", ()):
            yield from FileScan(self.inner, one, piece).batches()


class GordStreamSource(GordSource):
    """``spark.readStream.format("gord_stream").load("d.gord")``."""

    kind = "gord_stream"

    def _is_dictionary(self, path: str) -> bool:
        return True

    def streamReader(self, schema: T.StructType) -> GordStreamReader:
        path = self._path()
        d, tags, window = self._check(path)
        return GordStreamReader(path, schema, self._full_schema(path, d), dict(self.options), tags, window)


def register_stream(spark: SparkSession) -> None:
    spark.dataSource.register(GordStreamSource)
