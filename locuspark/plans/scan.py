"""Planning of a scan: schema, seek window, and the byte ranges that tasks read.

Nothing here reads more of a data file than its header line and, for a seek without an index, a few
probes of a block's start. Full scans are cut at byte offsets; each task finds the first
block that starts in its range.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import BinaryIO

import pyspark.sql.types as T

from ..functions.blocks import FormatError, Header, block_key, parse_header
from ..sources import files
from ..sources.sidecars import BlockIndex, read_index, read_meta
from .dictionary import DEFAULT_SOURCE, Dictionary, Entry, Scan
from .ranges import Window

SPLIT_BYTES = 32 << 20
PROBE = 1 << 14
#: What opening a file costs, in bytes that could be read instead.
OPEN_BYTES = 4 << 20
#: Files share a task only if there are enough of them for about this many tasks.
FEW_TASKS = 256
PLAN_THREADS = 32


def read_header(f: BinaryIO) -> Header:
    line = b""
    while b"\n" not in line:
        more = f.read(PROBE)
        if not more:
            break
        line += more
    if not line:
        raise FormatError("empty file")
    text, end, _ = line.partition(b"\n")
    return parse_header(text, len(text) + len(end))


def header_of(path: str) -> Header:
    try:
        with files.open_bytes(path) as f:
            return read_header(f)
    except FormatError as e:
        raise ValueError(f"read_gor: format error in {path}: {e}") from e
    except (OSError, ValueError) as e:
        raise OSError(f"read_gor: cannot open {path}") from e


def typed(names: list[str], declared: list[T.DataType | None]) -> T.StructType:
    """Types from a SCHEMA property of the right length; else string, but 32-bit integer for the second column."""
    if len(declared) != len(names):
        declared = [None] * len(names)
    kinds = [kind or (T.IntegerType() if i == 1 else T.StringType()) for i, kind in enumerate(declared)]
    return T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])


def file_schema(path: str) -> T.StructType:
    return typed(list(header_of(path).columns), read_meta(path).schema)


def dictionary_schema(d: Dictionary, source: str | None) -> T.StructType:
    """Columns of the first live file and, last, the source column."""
    first = next((e for e in d.entries if not e.deleted), d.entries[0])
    at, tagged = _readable(first)
    names = list(d.columns) or list(header_of(at).columns)[: -1 if tagged else None]
    declared = read_meta(at).schema
    if tagged and len(declared) == len(names) + 1:
        declared = declared[:-1]
    name = source or read_meta(d.path).source_column or d.source_name or DEFAULT_SOURCE
    return T.StructType([*typed(names, declared).fields, T.StructField(name, T.StringType())])


def _readable(e: Entry) -> tuple[str, bool]:
    """The file to learn columns from, and whether its last column is the source."""
    if e.bucket and not files.exists(e.path):
        return e.bucket, True
    return e.path, e.rows_tagged


@dataclass(frozen=True)
class Piece:
    """Blocks of one file that start in bytes [start, end); end None is the whole file, and seek says the reader finds the window itself."""

    path: str
    start: int = 0
    end: int | None = None
    seek: bool = False


@dataclass
class Probe:
    """Block starts of an open file."""

    file: BinaryIO
    size: int
    seen: int = field(default=0)

    def block_at(self, offset: int, first: int) -> tuple[int, tuple[bytes, int], int] | None:
        """(start, key, end) of the first block that starts at or after ``offset``; blocks begin at ``first``."""
        start = first if offset <= first else self._after(offset - 1)
        if start is None or start >= self.size:
            return None
        end = self._after(start) or self.size
        self.file.seek(start)
        head = b""
        while head.count(b"\t") < 2:
            more = self.file.read(256)
            if not more:
                break
            head += more
        self.seen += 1
        return start, block_key(head), end

    def _after(self, offset: int) -> int | None:
        """The byte after the first line feed at or after ``offset``."""
        self.file.seek(offset)
        at = offset
        while chunk := self.file.read(PROBE):
            i = chunk.find(b"\n")
            if i >= 0:
                return at + i + 1
            at += len(chunk)
        return None


def first_block(probe: Probe, first: int, reached: Callable[[tuple[bytes, int]], bool]) -> tuple[int, int]:
    """(start, end) of the first block whose key has ``reached`` the target, by bisection of the offsets; (size, size) if none has."""
    low, high = first, probe.size
    while low < high:
        middle = (low + high) // 2
        block = probe.block_at(middle, first)
        if block is None or block[0] >= high or reached(block[1]):
            high = middle
        else:
            low = block[2]
    block = probe.block_at(low, first)
    while block and not reached(block[1]):
        block = probe.block_at(block[2], first)
    return (block[0], block[2]) if block else (probe.size, probe.size)


def window_ranges(path: str, windows: list[Window]) -> list[tuple[int, int | None]]:
    """The bytes of the blocks that can hold rows of the windows, as disjoint ranges in order; (0, None) is all of the file."""
    if any(w.chrom is None for w in windows):
        return [(0, None)]
    found = []
    with files.open_bytes(path) as f:
        header = read_header(f)
        probe = Probe(f, files.size(path))
        index: BlockIndex | None = read_index(path)
        indexed = index is not None and index.ends and index.ends[-1] <= probe.size
        for w in windows:
            chrom = w.chrom.encode()
            low, high = (chrom, w.low), (chrom, w.high)
            if indexed:
                found.append(index.window(header.size, low, high))
                continue
            start, _ = first_block(probe, header.size, lambda key, to=low: key >= to)
            # Rows of a key may go on in the next block, so the last block is the first that is wholly beyond.
            _, end = first_block(probe, header.size, lambda key, to=high: key > to)
            found.append((start, end))
    out: list[tuple[int, int]] = []
    for a, b in sorted(x for x in found if x[0] < x[1]):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _cut(path: str, ranges: list[tuple[int, int]], split_bytes: int) -> list[Piece]:
    out = []
    for start, end in ranges:
        count = max(1, (end - start) // max(split_bytes, 1))
        cuts = [start + (end - start) * i // count for i in range(count + 1)]
        out += [Piece(path, a, b) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]
    return out


def pieces(path: str, windows: list[Window], split_bytes: int = SPLIT_BYTES) -> list[Piece]:
    """The parts of one file that can hold rows of the windows."""
    size = files.size(path)
    return _cut(path, [(a, size if b is None else b) for a, b in window_ranges(path, windows)], split_bytes)


def pieces_of_files(scans: list[Scan], windows: list[Window], split_bytes: int = SPLIT_BYTES) -> list[tuple[Scan, Piece]]:
    """The parts of many files. The planner asks for the size of each; only files that are larger than a part are looked into, smaller ones by their tasks."""

    def one(x: Scan) -> list[tuple[Scan, Piece]]:
        try:
            size = files.size(x.path)
            if size > split_bytes:
                return [(x, p) for p in pieces(x.path, windows, split_bytes)]
        except OSError as e:
            raise OSError(f"GORD entry: cannot open {x.path}") from e
        return [(x, Piece(x.path, 0, size, any(w.chrom is not None for w in windows)))]

    with ThreadPoolExecutor(PLAN_THREADS) as pool:
        return [p for found in pool.map(one, scans) for p in found]


def grouped(found: list[tuple[Scan, Piece]], split_bytes: int = SPLIT_BYTES) -> Iterator[list[tuple[Scan, Piece]]]:
    """Neighbouring parts that one task reads, by their bytes and what opening a file costs: at most about ``split_bytes``, less if that leaves few tasks."""
    costs = [(p.end or 0) - p.start + OPEN_BYTES for _, p in found]
    most = min(split_bytes, max(OPEN_BYTES, sum(costs) // FEW_TASKS))
    held, total = [], 0
    for x, cost in zip(found, costs, strict=True):
        if held and total + cost > most:
            yield held
            held, total = [], 0
        held.append(x)
        total += cost
    if held:
        yield held
