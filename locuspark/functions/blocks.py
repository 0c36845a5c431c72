"""Blocks of the compressed table format: framing, compression and the columnar encodings.

A file is a header line and a sequence of blocks, each one line of bytes:

    <last chromosome> TAB <last position> TAB <flag byte><packed payload> LF

Flag bit 0 marks a columnar payload, bit 1 zstd instead of zlib.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .pack7 import pack, unpack

COLUMNAR, ZSTD = 1, 2
BLOCK_BYTES = 32 * 1024
LEVEL = 6


class FormatError(ValueError):
    """A file doesn't follow the format."""


class UnsupportedTypeIdError(FormatError):
    """A columnar encoding that isn't implemented."""


class Block(NamedTuple):
    chrom: bytes
    pos: bytes
    flag: int
    payload: bytes


@dataclass(frozen=True)
class Header:
    columns: tuple[str, ...]
    #: Packed and compressed lookup tables; which codec holds them is known from the first columnar block.
    tables: bytes
    #: Bytes of the header line with its line feed.
    size: int


def parse_header(line: bytes, size: int | None = None) -> Header:
    """The first line of a file, without its line feed."""
    text, nul, tables = line.partition(b"\0")
    if not text and not nul:
        raise FormatError("empty file or header")
    names = text.decode("utf-8", "replace").rstrip("\r").removeprefix("#").split("\t")
    return Header(tuple(names), tables if nul else b"", len(line) + 1 if size is None else size)


def split_block(line: bytes) -> Block:
    """One block without its line feed."""
    chrom, tab, rest = line.partition(b"\t")
    if not tab:
        raise FormatError("truncated block: missing pos field")
    pos, tab, rest = rest.partition(b"\t")
    if not tab or not rest:
        raise FormatError("truncated block: missing flag byte")
    if len(rest) == 1:
        raise FormatError("empty block payload")
    return Block(chrom, pos, rest[0], rest[1:])


def block_key(line: bytes) -> tuple[bytes, int]:
    """(chromosome, position) of the last row, from the start of a block; a position that is no integer counts as 0."""
    chrom, _, rest = line.partition(b"\t")
    pos = rest.partition(b"\t")[0]
    try:
        return chrom, int(pos)
    except ValueError:
        return chrom, 0


def inflate(data: bytes, zstd: bool) -> bytes:
    try:
        if zstd:
            import zstandard

            return zstandard.ZstdDecompressor().decompressobj().decompress(data)
        return zlib.decompressobj().decompress(data)
    except Exception as e:
        raise FormatError(f"corrupt block payload: {e}") from e


def deflate(data: bytes, zstd: bool = False) -> bytes:
    if zstd:
        import zstandard

        return zstandard.ZstdCompressor().compress(data)
    return zlib.compress(data, LEVEL)


def content(block: Block) -> bytes:
    data = inflate(unpack(block.payload), bool(block.flag & ZSTD))
    if not data:
        raise FormatError("empty block payload")
    return data


def frame(rows: bytes, chrom: bytes, pos: bytes, flag: int = 0) -> bytes:
    """A block of tab-separated rows (without the last line feed), with its line feed."""
    return b"%b\t%b\t%c%b\n" % (chrom, pos, flag, pack(deflate(rows, bool(flag & ZSTD))))


class Tables:
    """External lookup tables: of each column that has one, the strings by index."""

    def __init__(self, packed: bytes, zstd: bool):
        self.of: dict[int, list[bytes]] = {}
        if not packed:
            return
        data = _Bytes(inflate(unpack(packed), zstd))
        column = 0
        for _ in range(data.number(">u2")):
            column += data.number(">u1")
            self.of[column] = [data.string() for _ in range(data.number(">u2"))]


class _Bytes:
    """Big-endian fields, one after another."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        if n < 0 or self.at + n > len(self.data):
            raise FormatError("truncated columnar block")
        self.at += n
        return self.data[self.at - n : self.at]

    def number(self, kind: str) -> int:
        return int(self.numbers(kind, 1)[0])

    def numbers(self, kind: str, n: int) -> np.ndarray:
        return np.frombuffer(self.take(np.dtype(kind).itemsize * n), kind)

    def string(self) -> bytes:
        end = self.data.find(b"\0", self.at)
        if end < 0:
            raise FormatError("truncated columnar block")
        out, self.at = self.data[self.at : end], end + 1
        return out


# Type ids of columnar payloads.
OFFSETS, STEPS, DIFFS8, DIFFS16, STRINGS, CONSTANT, LOOKUP_DIFFS = 5, 7, 12, 13, 21, 23, 25


def _texts(numbers: np.ndarray) -> pa.Array:
    return pc.cast(pa.array(numbers), pa.string())


def _strings(data: bytes, rows: int) -> pa.Array:
    """The first strings of a run of NUL-terminated ones; bytes that are no UTF-8 become U+FFFD."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        text = data.decode("utf-8", "replace")
    found = pc.split_pattern(pa.array([text], pa.large_string()), "\0").flatten()
    if len(found) <= rows:
        raise FormatError("truncated columnar block")
    return found[:rows].cast(pa.string())


def _column(kind: int, data: _Bytes, rows: int, table: list[bytes] | None) -> pa.Array:
    if kind == OFFSETS:
        base = data.numbers(">i8", 1).astype(np.int64)
        return _texts(base + data.numbers(">u1", rows))
    if kind == STEPS:
        start, step = data.numbers(">i8", 1).astype(np.int64), data.number(">i4")
        return _texts(start + step * np.arange(1, rows + 1, dtype=np.int64))
    if kind in (DIFFS8, DIFFS16):
        start = data.numbers(">i8", 1).astype(np.int64)
        return _texts(start + np.cumsum(data.numbers(">i1" if kind == DIFFS8 else ">i2", rows).astype(np.int64)))
    if kind == STRINGS:
        return _strings(data.take(data.number(">u4")), rows)
    if kind == CONSTANT:
        return pa.repeat(pa.scalar(data.string().decode("utf-8", "replace"), pa.string()), rows)
    if kind == LOOKUP_DIFFS:
        strings = pa.array(["", *(x.decode("utf-8", "replace") for x in table or ())], pa.string())
        at = np.cumsum(data.numbers(">i1", rows).astype(np.int64)) + 1
        return strings.take(pa.array(np.where((at > 0) & (at < len(strings)), at, 0)))
    raise UnsupportedTypeIdError(f"columnar TYPEID {kind} not implemented yet")


def decode_columns(data: bytes, tables: Tables) -> list[pa.Array]:
    """The cells of a columnar payload as text, column by column."""
    source = _Bytes(data)
    rows = source.number(">u2")
    kinds = source.string()
    return [_column(kind, source, rows, tables.of.get(i)) for i, kind in enumerate(kinds)]
