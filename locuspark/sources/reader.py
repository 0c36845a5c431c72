"""Python data sources ``gorz``, ``gord`` and ``gor`` (by suffix): reading."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.blocks import COLUMNAR, ZSTD, FormatError, Tables, content, decode_columns, split_block
from ..functions.cells import parse_column, positions, split_rows
from ..plans import dictionary as D
from ..plans import scan as S
from ..plans.hints import Columns, Hint
from ..plans.ranges import LEAST, MOST, Window, parse_range
from . import files
from .sidecars import read_tags

BATCH_ROWS = 1 << 16
READ_BYTES = 4 << 20
#: Text of row blocks that is split into columns at once.
SPLIT_TEXT = 1 << 20


@dataclass
class Part(InputPartition):
    """Pieces of files that one task reads one after another."""

    scans: tuple[tuple[D.Scan, S.Piece], ...] = ()

    def __init__(self, scans: tuple = ()):
        super().__init__(None)
        self.scans = scans


def parse_list(value: str | None) -> list[str]:
    """A JSON array or a comma-separated list; nulls and empty items are skipped."""
    if not value:
        return []
    if value.lstrip().startswith("["):
        return [str(x) for x in json.loads(value) if x is not None and x != ""]
    return [x for x in (y.strip() for y in value.split(",")) if x]


class TableSource(DataSource):
    """Options: path, f, ff, range, source, columns, split_bytes, pushdown, file_search_path; see README.

    There is no ``pushFilters``: Spark keeps what it changes with the relation, and a later scan of the
    same relation would be narrowed as well. What a query needs of a scan comes as the option ``hint`` (``plans.hints``).
    """

    kind = "gorz"

    @classmethod
    def name(cls) -> str:
        return cls.kind

    def _path(self) -> str:
        path = self.options.get("path")
        if not path:
            raise ValueError("read_gor expects a single VARCHAR file path")
        path = files.search(path, self.options.get("file_search_path"))
        return path if files.is_uri(path) or os.path.isabs(path) else os.path.abspath(path)

    def _is_dictionary(self, path: str) -> bool:
        return self.kind == "gord" or (self.kind == "gor" and path.lower().endswith(".gord"))

    def _check(self, path: str) -> tuple[D.Dictionary | None, list[str], Window]:
        window = parse_range(self.options.get("range"))
        tags = parse_list(self.options.get("f"))
        if self.options.get("ff"):
            tags += read_tags(self.options["ff"])
        if not self._is_dictionary(path):
            if tags:
                raise ValueError("read_gor: f / ff partition filtering only applies to .gord dictionaries")
            return None, [], window
        d = D.load(path)
        if tags and not any(e.tags for e in d.entries):
            raise OSError(f"read_gor: dictionary {path} carries no tags to filter with f / ff")
        return d, tags, window

    def _full_schema(self, path: str, d: D.Dictionary | None) -> T.StructType:
        return S.dictionary_schema(d, self.options.get("source")) if d else S.file_schema(path)

    def described(self) -> tuple[T.StructType, Columns]:
        """The schema, and what ``plans.hints`` needs to know of the columns."""
        path = self._path()
        d, _, _ = self._check(path)
        full = self._full_schema(path, d)
        names = parse_list(self.options.get("columns")) or full.names
        return T.StructType([full[n] for n in names]), Columns(full.names, names, d is not None)

    def schema(self) -> T.StructType:
        return self.described()[0]

    def reader(self, schema: T.StructType) -> DataSourceReader:
        path = self._path()
        d, tags, window = self._check(path)
        full = self._full_schema(path, d)
        return Reader(path, d, tags, window, full, schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool):
        from .writer import make_writer

        return make_writer(self.kind, self.options, schema, overwrite)


class GorzSource(TableSource):
    kind = "gorz"


class GordSource(TableSource):
    kind = "gord"


class GorSource(TableSource):
    kind = "gor"


class Reader(DataSourceReader):
    """Reads the blocks that can hold rows of the range and the hint, and of these the rows that lie within both."""

    def __init__(self, path: str, d: D.Dictionary | None, tags: list[str], hard: Window, full: T.StructType, schema: T.StructType, options: dict[str, str]):
        self.path, self.dictionary, self.tags = path, d, tags
        self.hint = Hint() if options.get("pushdown", "true").lower() == "false" else Hint.of_option(options.get("hint"))
        self.windows = self.hint.windows(hard)
        self.names, self.schema, self.options = full.names, schema, options
        self.kinds = list(to_arrow_schema(schema).types)
        self.wanted = [full.names.index(f.name) for f in schema.fields]
        self.decoded = [self.hint.columns is None or f.name in self.hint.columns for f in schema.fields]

    def partitions(self) -> list[InputPartition]:
        split = int(self.options.get("split_bytes", S.SPLIT_BYTES))
        if not self.windows:
            found = []
        elif self.dictionary is None:
            found = [(D.Scan(self.path), p) for p in S.pieces(self.path, self.windows, split)]
        else:
            tags = self.tags
            if self.hint.tags is not None:
                known = set(tags) or self.dictionary.valid_tags
                # Only tags that the files' own columns can't add to: every live file with one tag of its own.
                if all(len(e.tags) == 1 and not e.rows_tagged for e in self.dictionary.entries):
                    tags = sorted(known.intersection(self.hint.tags)) or ["\0"]
            plan = D.scans(self.dictionary, tags, self.windows, self.options)
            found = S.pieces_of_files(plan, self.windows, split)
        # Without partitions Spark would still read once, so there is always one.
        return [Part(tuple(x)) for x in S.grouped(found, split)] or [Part()]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for one, piece in getattr(partition, "scans", ()):
            yield from FileScan(self, one, piece).batches()


class FileScan:
    """The rows of one piece of a file as Arrow batches."""

    def __init__(self, reader: Reader, one: D.Scan, piece: S.Piece):
        self.reader, self.scan, self.piece = reader, one, piece
        self.strict = reader.dictionary is not None
        self.width = len(reader.names)
        # All windows have the same positions.
        first = reader.windows[0] if reader.windows else Window()
        self.chroms = None if first.chrom is None else pa.array([w.chrom for w in reader.windows], pa.string())
        self.bounds = None if (first.low, first.high) == (LEAST, MOST) else (first.low, first.high)
        self.needed = {i for i, on in zip(reader.wanted, reader.decoded, strict=True) if on} | {0}
        if self.strict or self.bounds:
            self.needed.add(1)
        if one.rows_tagged:
            self.needed.add(self.width - 1)

    def batches(self) -> Iterator[pa.RecordBatch]:
        try:
            f = files.open_bytes(self.piece.path)
        except OSError as e:
            raise OSError(f"{'GORD entry: cannot open' if self.strict else 'read_gor: cannot open'} {self.piece.path}") from e
        with f:
            header = S.read_header(f)
            ranges = S.window_ranges(self.piece.path, self.reader.windows) if self.piece.seek else [(self.piece.start, self.piece.end)]
            held: list[list[pa.Array]] = []
            rows = 0
            for columns in self._columns(f, header, ranges):
                columns = self._filtered(columns)
                if len(columns[0]):
                    held.append(columns)
                    rows += len(columns[0])
                if rows >= BATCH_ROWS:
                    yield self._batch(held)
                    held, rows = [], 0
            if held:
                yield self._batch(held)

    def _columns(self, f, header, ranges: list[tuple[int, int | None]]) -> Iterator[list[pa.Array | None]]:
        """The columns of the table from one block or several; None for those that nothing needs."""
        tables: Tables | None = None
        texts: list[bytes] = []
        size = 0
        count = len(header.columns)
        places = self._places(count)
        asked = [i for i in dict.fromkeys(places[k] for k in sorted(self.needed)) if i is not None and i >= 0]

        def split() -> list[pa.Array | None]:
            found = split_rows(b"\n".join(texts), count, asked or [0])
            return self._placed(found, places)

        for start, end in ranges:
            for line in self._blocks(f, header.size, start, end):
                block = split_block(line)
                data = content(block)
                if block.flag & COLUMNAR:
                    if tables is None:
                        tables = Tables(header.tables, bool(block.flag & ZSTD))
                    if texts:  # rows stay in the order of the file
                        yield split()
                        texts, size = [], 0
                    columns = decode_columns(data, tables)
                    if columns and len(columns[0]):
                        yield self._placed(dict(enumerate(columns)), self._places(len(columns)))
                else:
                    texts.append(data.removesuffix(b"\n"))
                    size += len(data)
                    if size >= SPLIT_TEXT:
                        yield split()
                        texts, size = [], 0
        if texts:
            yield split()

    def _places(self, count: int) -> list[int | None]:
        """Of each column of the table its place among ``count`` columns of a file: None is blank, -1 the tag that the dictionary has for the file."""
        out: list[int | None] = [i if i < count else None for i in range(self.width)]
        if self.strict and not self.scan.rows_tagged:
            out[-1] = -1
        elif self.scan.rows_tagged and count > self.width:
            out[-1] = count - 1
        return out

    def _placed(self, found: dict[int, pa.Array], places: list[int | None]) -> list[pa.Array | None]:
        n = len(next(iter(found.values())))
        fixed = lambda text: pa.repeat(pa.scalar(text, pa.string()), n)
        return [(fixed("") if at is None else fixed(self.scan.tag or "") if at < 0 else found[at]) if i in self.needed else None for i, at in enumerate(places)]

    def _blocks(self, f, first: int, start: int, end: int | None) -> Iterator[bytes]:
        """The blocks that start in [start, end), each without its line feed."""
        # One byte back: a block that starts exactly at a border belongs to the range it starts in.
        at = max(start, first)
        skip = at > first
        f.seek(at - 1 if skip else at)
        if skip:
            at -= 1
        rest = b""
        while True:
            if not skip and end is not None and at >= end:
                return
            chunk = f.read(READ_BYTES)
            data = rest + chunk
            if not data:
                return
            lines = data.split(b"\n")
            rest = lines.pop()
            if not chunk:
                lines, rest = [*lines, rest] if rest else lines, b""
            for line in lines:
                here, at = at, at + len(line) + 1
                if skip:
                    skip = False
                elif end is not None and here >= end:
                    return
                elif line:
                    yield line
            if not chunk:
                return

    def _filtered(self, columns: list[pa.Array | None]) -> list[pa.Array | None]:
        keep: list[pa.Array] = []
        if self.strict and self.width > 1:
            ok = pc.match_substring_regex(columns[1], r"^-?\d+$")
            if not pc.all(ok).as_py():
                raise FormatError(f"GORD entry: row without an integer position in {self.piece.path}")
        if self.chroms is not None:
            keep.append(pc.is_in(columns[0], self.chroms))
        if self.bounds is not None:
            at = positions(columns[1])
            keep.append(pa.array((at >= self.bounds[0]) & (at <= self.bounds[1])))
        if self.scan.rows_tagged:
            source = columns[-1]
            if self.scan.keep is not None:
                keep.append(pc.is_in(source, pa.array(sorted(self.scan.keep), pa.string())))
            if self.scan.drop:
                keep.append(pc.invert(pc.is_in(source, pa.array(sorted(self.scan.drop), pa.string()))))
        if keep:
            mask = keep[0]
            for x in keep[1:]:
                mask = pc.and_(mask, x)
            if not pc.all(mask).as_py():
                columns = [None if c is None else c.filter(mask) for c in columns]
        return columns

    def _batch(self, held: list[list[pa.Array | None]]) -> pa.RecordBatch:
        rows = sum(len(x[0]) for x in held)
        out = []
        for i, kind, on in zip(self.reader.wanted, self.reader.kinds, self.reader.decoded, strict=True):
            if on:
                out.append(parse_column(pa.concat_arrays([x[i] for x in held]) if len(held) > 1 else held[0][i], kind))
            else:
                out.append(pa.nulls(rows, kind))
        return pa.RecordBatch.from_arrays(out, names=[f.name for f in self.reader.schema.fields])
