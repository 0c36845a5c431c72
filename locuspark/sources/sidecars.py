"""Small files beside the data: ``.meta`` properties, ``.gori`` block indexes and tag files."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import pyspark.sql.types as T

from . import files

INDEX_HEAD = b"## fileformat=GORIv2\n"
#: Text of an index that is in memory at once while indexes are joined.
INDEX_BYTES = 1 << 20
# Letters of the SCHEMA property.
LETTERS = {"S": T.StringType(), "I": T.IntegerType(), "L": T.LongType(), "D": T.DoubleType()}


def split_items(text: str) -> list[str]:
    """A comma-separated list without its empty items."""
    return [x for x in (y.strip() for y in text.split(",")) if x]


def parse_schema(value: str) -> list[T.DataType | None]:
    """SCHEMA = S,I,null,...; null leaves the type to the convention."""
    out: list[T.DataType | None] = []
    for item in split_items(value):
        if item in ("null", "NULL", "Null"):
            out.append(None)
        elif item[0].upper() in LETTERS:
            out.append(LETTERS[item[0].upper()])
        else:
            raise ValueError(f"meta: unknown SCHEMA type '{item}'")
    return out


@dataclass
class Meta:
    properties: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> list[T.DataType | None]:
        return parse_schema(self.properties.get("SCHEMA", ""))

    @property
    def line_count(self) -> int | None:
        value = self.properties.get("LINE_COUNT", "")
        return int(value) if value.isdigit() else None

    @property
    def source_column(self) -> str | None:
        return self.properties.get("SOURCE_COLUMN") or None


def parse_meta(data: bytes) -> Meta:
    """Lines ``## KEY = VALUE``; keys are in upper case, other lines are skipped."""
    out = Meta()
    for line in data.decode("utf-8", "replace").splitlines():
        if line.startswith("##") and "=" in line:
            key, _, value = line[2:].partition("=")
            out.properties[key.strip().upper()] = value.strip()
    return out


def read_meta(path: str) -> Meta:
    return parse_meta(files.read_if_there(f"{path}.meta") or b"")


@dataclass
class BlockIndex:
    """For each block the key of its last row and the offset at which the next block starts."""

    keys: list[tuple[bytes, int]]
    ends: list[int]

    def window(self, first: int, low: tuple[bytes, int], high: tuple[bytes, int]) -> tuple[int, int]:
        """Bytes [a, b) of the blocks that can hold keys of [low, high]; the file's blocks begin at ``first``."""
        a = bisect_left(self.keys, low)
        # A key may go on in the next block, so the last block is the first whose key is beyond.
        b = bisect_left(self.keys, (high[0], high[1] + 1))
        start = self.ends[a - 1] if a else first
        return start, self.ends[min(b, len(self.ends) - 1)]


def parse_index(data: bytes) -> BlockIndex | None:
    """None for an index of the old version, and for one that doesn't parse."""
    keys, ends = [], []
    try:
        for line in data.split(b"\n"):
            if line.startswith(b"#"):
                if b"GORIv1" in line:
                    return None
                continue
            if line.strip():
                chrom, pos, offset = line.rstrip(b"\r").split(b"\t")[:3]
                keys.append((chrom, int(pos)))
                ends.append(int(offset))
    except ValueError:
        return None
    if not keys or ends != sorted(ends) or keys != sorted(keys):
        return None
    return BlockIndex(keys, ends)


def index_entry(chrom: bytes, pos: bytes, end: int) -> bytes:
    return b"%b\t%b\t%d\n" % (chrom, pos, end)


def moved_entries(f: BinaryIO, by: int) -> Iterator[bytes]:
    """The entries of a part's index with ``by`` added to their offsets, a piece of the file at a time."""
    rest = b""
    while chunk := f.read(INDEX_BYTES):
        lines = (rest + chunk).split(b"\n")
        rest = lines.pop()
        fields = (x.rpartition(b"\t") for x in lines)
        # A line feed within a chromosome's name leaves lines without an offset.
        yield b"".join(b"%b\t%d\n" % (key, int(end) + by) if key and end.isdigit() else b"%b%b%b\n" % (key, tab, end) for key, tab, end in fields)


def read_index(path: str) -> BlockIndex | None:
    data = files.read_if_there(f"{path}.gori")
    return parse_index(data) if data else None


def read_tags(path: str) -> list[str]:
    """The first tab field of each line, trimmed; lines that start with # are skipped."""
    try:
        data = files.read_all(path)
    except OSError as e:
        raise OSError(f"read_gor: cannot open tag file {path}") from e
    firsts = (x.partition("\t")[0].strip() for x in data.decode("utf-8", "replace").splitlines() if not x.startswith("#"))
    return [x for x in firsts if x]
