"""Writing sorted rows as one block-compressed or plain text file.

Tasks check the order of their rows and encode them, each to a part file in a hidden folder beside the target;
the commit checks the borders between parts, in the order of the partitions, joins the parts behind the header and renames the
result into place. A failed write leaves nothing. What is known of single blocks never passes through the driver's memory: with an
index, a task writes the entries of its blocks beside its part, and the commit joins those files a piece at a time.
"""

from __future__ import annotations

import contextlib
import os
import re
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..functions.blocks import BLOCK_BYTES, ZSTD, frame
from ..functions.cells import column_texts
from . import files
from .sidecars import INDEX_HEAD, index_entry, moved_entries

#: What one process may join into one file.
MOST_BYTES = 64 << 30
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass
class Done(WriterCommitMessage):
    """The driver holds those of all tasks, so their size must not depend on rows or blocks."""

    part: int = 0
    path: str = ""
    rows: int = 0
    first: tuple[str, int] | None = None
    last: tuple[str, int] | None = None


def in_order(last: tuple[str, int], key: tuple[str, int]) -> None:
    if key[0] != last[0] and key[0].encode() < last[0].encode():
        raise ValueError(f"Wrong chromosome order in gor stream {key[0]} {last[0]}")
    if key[0] == last[0] and key[1] < last[1]:
        raise ValueError(f"Wrong order in gor stream {key[1]} {last[1]}")


def check_schema(schema: T.StructType) -> None:
    if len(schema) < 2:
        raise ValueError("COPY to gor: need at least 2 columns (chrom, pos)")
    if not isinstance(schema[0].dataType, (T.StringType, T.VarcharType, T.CharType)):
        raise ValueError("COPY to gor: chrom (column 1) must be VARCHAR")
    kind = schema[1].dataType
    if not isinstance(kind, INTEGERS) and not (isinstance(kind, T.DecimalType) and kind.scale == 0):
        raise ValueError("COPY to gor: pos (column 2) must be an integer type")


def make_writer(kind: str, options: dict[str, str], schema: T.StructType, overwrite: bool) -> Writer:
    check_schema(schema)
    path = options.get("path")
    if not path:
        raise ValueError("COPY to gor expects a file path")
    if not files.is_uri(path):
        path = os.path.abspath(path)
    if kind == "gord":
        raise ValueError("dictionaries are written with operators.tables.write_dictionary")
    return Writer(path, kind == "gorz", options, schema, overwrite)


class Encoder:
    """Sorted rows as blocks, or as lines of text; the order of the rows is checked.

    The lines of a batch are one run of bytes, put together column by column; blocks are cut from it by the lines' offsets.
    ``index``: gets an entry for each block, with offsets from the start of ``out``.
    """

    def __init__(self, out, packed: bool = True, flag: int = 0, block_bytes: int = BLOCK_BYTES, index=None):
        self.out, self.packed, self.flag, self.block_bytes, self.index = out, packed, flag, block_bytes, index
        #: Lines, each with its line feed, that don't fill a block yet, and the key of the last.
        self.held = b""
        self.key = (b"", b"")
        self.offset = self.rows = 0
        self.first: tuple[str, int] | None = None
        self.last: tuple[str, int] | None = None

    def add(self, batch: pa.RecordBatch) -> None:
        self._check(batch)
        self.rows += batch.num_rows
        keys = [batch.column(0).cast(pa.string()), pc.cast(pc.cast(batch.column(1), pa.int64()), pa.string())]
        texts = [*keys, *(column_texts(c) for c in batch.columns[2:])]
        lines = pc.binary_join_element_wise(*[x.cast(pa.large_string()) for x in texts], pa.scalar("\t", pa.large_string()))
        lines = pc.binary_join_element_wise(lines, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
        ends = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
        data = lines.buffers()[2].to_pybytes()[ends[0] : ends[-1]]
        if not self.packed:
            self.out.write(data)
            return
        ends = ends[1:] - ends[0]
        start = row = 0
        while row < len(ends):
            # The first line with which the block is full.
            row = int(np.searchsorted(ends, start - len(self.held) + self.block_bytes))
            if row == len(ends):
                break
            self._flush(self.held + data[start : ends[row]], (keys[0][row].as_py().encode(), keys[1][row].as_py().encode()))
            self.held, start, row = b"", int(ends[row]), row + 1
        if start < len(data):
            self.held += data[start:]
            self.key = (keys[0][-1].as_py().encode(), keys[1][-1].as_py().encode())

    def finish(self) -> None:
        if self.held:
            self._flush(self.held, self.key)
            self.held = b""

    def _flush(self, lines: bytes, key: tuple[bytes, bytes]) -> None:
        data = frame(lines[:-1], *key, self.flag)
        self.out.write(data)
        self.offset += len(data)
        if self.index:
            self.index.write(index_entry(*key, self.offset))

    def _check(self, batch: pa.RecordBatch) -> None:
        for i, name in enumerate(("chrom", "pos")):
            if batch.column(i).null_count:
                raise ValueError(f"COPY to gor: {name} (column {i + 1}) must not be NULL")
        at = pc.cast(batch.column(1), pa.int64()).to_numpy(zero_copy_only=False)
        coded = batch.column(0).dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        key = lambda i: (coded.dictionary[int(codes[i])].as_py(), int(at[i]))
        for i in np.flatnonzero((codes[1:] != codes[:-1]) | (at[1:] < at[:-1])).tolist():
            in_order(key(i), key(i + 1))
        if self.last is None:
            self.first = key(0)
        else:
            in_order(self.last, key(0))
        self.last = key(len(at) - 1)


class Delimiter:
    """Rows of any columns as delimited lines, in the order in which they come."""

    def __init__(self, out, sep: str):
        self.out, self.sep = out, sep
        self.rows = 0
        self.first = self.last = None

    def add(self, batch: pa.RecordBatch) -> None:
        special = f'[{re.escape(self.sep)}"\n\r]'
        cells = []
        for column in batch.columns:
            text = column_texts(column).cast(pa.string())
            quoted = pc.binary_join_element_wise('"', pc.replace_substring(text, '"', '""'), '"', "")
            cells.append(pc.if_else(pc.match_substring_regex(text, special), quoted, text))
        lines = pc.binary_join_element_wise(*cells, self.sep) if len(cells) > 1 else cells[0]
        data = "\n".join([*lines.to_pylist(), ""]).encode()
        self.out.write(data)
        self.rows += batch.num_rows

    def finish(self) -> None:
        pass


class Writer(DataSourceArrowWriter):
    """``sep``: delimited text instead of the formats of this package."""

    def __init__(self, path: str, packed: bool, options: dict[str, str], schema: T.StructType, overwrite: bool, sep: str | None = None):
        # Parts are on storage that driver and executors share, as the target is.
        self.path, self.packed, self.names, self.overwrite, self.sep = path, packed, schema.names, overwrite, sep
        folder, _, name = path.rpartition("/")
        self.scratch = f"{folder}/.{name}.{uuid.uuid4().hex}"
        self.flag = ZSTD if options.get("codec", "zlib") == "zstd" else 0
        self.index = packed and options.get("index", "false").lower() == "true"
        self.header = options.get("header", "true").lower() == "true" or sep is None
        self.block_bytes = int(options.get("block_bytes", BLOCK_BYTES))
        self.most = int(options.get("max_file_bytes", MOST_BYTES))
        if not overwrite and files.exists(path) and files.size(path):
            raise FileExistsError(f"{path} is there already; use mode('overwrite')")
        make_folder(self.scratch)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Done:
        from pyspark import TaskContext

        context = TaskContext.get()
        done = Done(part=context.partitionId() if context else 0)
        # Attempts of a task don't meet in one file.
        done.path = f"{self.scratch}/part-{done.part:06d}-{context.taskAttemptId() if context else 0}"
        with create(done.path) as out, create(f"{done.path}.gori") if self.index else contextlib.nullcontext() as index:
            encoder = Encoder(out, self.packed, self.flag, self.block_bytes, index) if self.sep is None else Delimiter(out, self.sep)
            for batch in iterator:
                if batch.num_rows:
                    encoder.add(batch)
            encoder.finish()
        done.rows, done.first, done.last = encoder.rows, encoder.first, encoder.last
        return done

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        done = sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.part)
        try:
            for a, b in zip(done, done[1:], strict=False):
                if self.sep is None:
                    in_order(a.last, b.first)
            sizes = [files.size(m.path) for m in done]
            total = sum(sizes)
            if total > self.most:
                raise ValueError(f"{total} bytes are too many for one file, which a single process joins (max_file_bytes is {self.most}); write a dictionary with operators.tables.write_dictionary")
            header = (self.sep or "\t").join(self.names).encode() + b"\n" if self.header else b""
            joined = f"{self.scratch}/joined"
            with create(joined) as out:
                out.write(header)
                for m in done:
                    with files.open_bytes(m.path) as part:
                        shutil.copyfileobj(part, out, 8 << 20)
                    # The disk never has the table twice.
                    remove(m.path)
            move(joined, self.path)
            if self.index:
                offset = len(header)
                with create(f"{self.path}.gori") as out:
                    out.write(INDEX_HEAD)
                    for m, size in zip(done, sizes, strict=True):
                        with files.open_bytes(f"{m.path}.gori") as part:
                            for entries in moved_entries(part, offset):
                                out.write(entries)
                        offset += size
        finally:
            remove_folder(self.scratch)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        remove_folder(self.scratch)


class DelimitedSource(DataSource):
    """``locus_delimited``: one delimited text file, for COPY ... (FORMAT csv)."""

    @classmethod
    def name(cls) -> str:
        return "locus_delimited"

    def writer(self, schema: T.StructType, overwrite: bool) -> Writer:
        path = self.options["path"]
        return Writer(path if files.is_uri(path) else os.path.abspath(path), False, self.options, schema, overwrite, self.options.get("delimiter", ","))


def _system(path: str):
    return files._place(path)


def make_folder(path: str) -> None:
    if files.is_uri(path):
        system, at = _system(path)
        system.create_dir(at, recursive=True)
    else:
        os.makedirs(path, exist_ok=True)


def create(path: str):
    if files.is_uri(path):
        system, at = _system(path)
        return system.open_output_stream(at)
    return open(path, "wb")


def move(source: str, target: str) -> None:
    if files.is_uri(source):
        system, a = _system(source)
        system.move(a, _system(target)[1])
    else:
        os.replace(source, target)


def remove(path: str) -> None:
    if files.is_uri(path):
        system, at = _system(path)
        system.delete_file(at)
    else:
        os.remove(path)


def remove_folder(path: str) -> None:
    if files.is_uri(path):
        from pyarrow import fs

        system, at = _system(path)
        if system.get_file_info(at).type != fs.FileType.NotFound:
            system.delete_dir(at)
    else:
        shutil.rmtree(path, ignore_errors=True)
