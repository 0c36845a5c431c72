"""Dictionaries: which files hold the rows of which tags, and which of them a scan reads.

A dictionary lists files with their tags, perhaps the range of their keys, and perhaps a
bucket: one file that holds the rows of several tags with the tag in its last column. The rows of a scan are the same whichever of
the two is read; choosing is about the number of files.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from fractions import Fraction

from ..sources import files
from ..sources.sidecars import split_items
from .ranges import Window

DEFAULT_SOURCE = "Source"
# Defaults and setting names of the bucket rule.
FILE_THRESHOLD, USAGE_PERCENT, SINGLES_PER_BUCKET = 100, 40, 11
FILE_SETTINGS = ("GOR_BUCKET_FILE_COUNT_THRESHOLD", "gor.bucket.file.count.threshold")
USAGE_SETTINGS = ("GOR_BUCKET_INITIAL_USAGE_THRESHOLD", "gor.bucket.initial.usage.threshold")

Key = tuple[str, int]


@dataclass(frozen=True)
class Entry:
    """One file to read. ``rows_tagged``: the tag is the file's own last column."""

    path: str
    tags: tuple[str, ...]
    span: tuple[Key, Key] | None = None
    bucket: str | None = None
    deleted: bool = False
    rows_tagged: bool = False
    dropped_tags: frozenset[str] = frozenset()

    def overlaps(self, window: Window) -> bool:
        """Whether the declared range, if there is one, can hold rows of the window."""
        if window.chrom is None or self.span is None:
            return True
        (c1, p1), (c2, p2) = self.span
        low, high = (window.chrom, window.low), (window.chrom, window.high)
        return (c1, p1) <= high and low <= (c2, p2)


@dataclass
class Bucket:
    members: list[str] = field(default_factory=list)
    dropped: set[str] = field(default_factory=set)
    span: tuple[Key, Key] | None = None
    ranged: bool = True


@dataclass
class Dictionary:
    path: str
    entries: list[Entry] = field(default_factory=list)
    columns: list[str] = field(default_factory=list)
    source_name: str | None = None
    buckets: dict[str, Bucket] = field(default_factory=dict)

    @property
    def valid_tags(self) -> set[str]:
        return {t for e in self.entries if not e.deleted for t in e.tags}


def parse(text: str, path: str) -> Dictionary:
    out = Dictionary(path)
    folder = path.rpartition("/")[0] or ("/" if path.startswith("/") else "")
    for number, raw in enumerate(text.split("\n"), 1):
        line = re.sub(r"[\r ]+$", "", raw)
        if not line:
            continue
        if line.startswith("##"):
            key, _, value = line[2:].partition("=")
            key = key.strip().upper()
            if key == "COLUMNS":
                out.columns = split_items(value)
            elif key == "SOURCE_COLUMN" and value.strip():
                out.source_name = value.strip()
        elif line.startswith("#"):
            names = [x.strip() for x in re.split(r"[\t,]", line[1:])]
            if len(names) >= 2 and names[1] and names[1].lower() != "col2":
                out.source_name = names[1]
        else:
            out.entries.append(_entry(line.split("\t"), number, folder))
    for e in out.entries:
        if e.bucket:
            _join(out.buckets.setdefault(e.bucket, Bucket()), e)
    return out


def _entry(parts: list[str], number: int, folder: str) -> Entry:
    if len(parts) not in (2, 6, 7):
        raise ValueError(f"GORD line {number}: expected 2, 6 or 7 tab-separated columns, found {len(parts)}")
    file, _, rest = parts[0].partition("|")
    deleted = rest[:2] in ("D|", "d|")
    bucket = rest[2:] if deleted else rest
    span = None
    if len(parts) > 2:
        try:
            span = ((parts[2], int(parts[3])), (parts[4], int(parts[5])))
        except ValueError as e:
            raise ValueError(f"GORD line {number}: bad position in range columns") from e
    inline = split_items(parts[6]) if len(parts) == 7 else []
    tags = inline or ([parts[1]] if parts[1] else [])
    return Entry(files.resolve(folder, file), tuple(tags), span, files.resolve(folder, bucket) if bucket else None, deleted, len(inline) > 1)


def _join(bucket: Bucket, e: Entry) -> None:
    bucket.members += [t for t in e.tags if t not in bucket.members]
    if e.deleted:
        bucket.dropped |= set(e.tags)
    elif e.span is None:
        bucket.ranged = False
    else:
        spans = [e.span] if bucket.span is None else [e.span, bucket.span]
        bucket.span = (min(s[0] for s in spans), max(s[1] for s in spans))


def setting(names: tuple[str, ...], default: int, conf: dict[str, str] | None = None) -> int:
    for name in names:
        value = (conf or {}).get(name.lower()) or os.environ.get(name)
        if value is not None:
            try:
                return int(value)
            except ValueError:
                continue
    return default


def choose(d: Dictionary, tags: set[str], file_threshold: int = FILE_THRESHOLD, usage_percent: int = USAGE_PERCENT) -> list[Entry]:
    """The files that hold the rows of ``tags``: single files, or a bucket in place of its members.

    A bucket is taken when more than a share of its tags is asked for, unless that is one file only. While
    too many files are left, the share is halved.
    """
    wanted = [e for e in d.entries if not e.deleted and tags.intersection(e.tags)]
    used: dict[str, int] = {}
    for e in wanted:
        if e.bucket:
            used[e.bucket] = used.get(e.bucket, 0) + 1
    taken: set[str] = set()
    reads = len(wanted)
    fewest = sum(not e.bucket for e in wanted) + len(used)
    share = Fraction(usage_percent, 100)
    while True:
        for name, n in used.items():
            if name not in taken and n != 1 and Fraction(n, len(d.buckets[name].members)) > share:
                taken.add(name)
                reads -= n - 1
        share /= 2
        if reads <= file_threshold or reads <= fewest or reads <= SINGLES_PER_BUCKET * len(taken) or not share:
            break
        if all(name in taken or n == 1 for name, n in used.items()):
            break
    out: list[Entry] = []
    placed: set[str] = set()
    for e in wanted:
        if e.bucket not in taken or d.buckets[e.bucket].dropped.intersection(e.tags):
            out.append(e)  # of a tag that is deleted and there again, the bucket's rows are the old ones
        if e.bucket in taken and e.bucket not in placed:
            placed.add(e.bucket)
            b = d.buckets[e.bucket]
            out.append(Entry(e.bucket, tuple(b.members), b.span if b.ranged else None, None, False, True, frozenset(b.dropped)))
    return out


@dataclass(frozen=True)
class Scan:
    """One file of a scan: append ``tag`` to its rows, or keep those whose last column is in ``keep`` and not in ``drop``."""

    path: str
    tag: str | None = None
    rows_tagged: bool = False
    keep: frozenset[str] | None = None
    drop: frozenset[str] = frozenset()


def scans(d: Dictionary, tags: Iterable[str], windows: list[Window], conf: dict[str, str] | None = None) -> list[Scan]:
    """The files to read for ``tags`` (none: all) within one of the windows, in the order of their declared ranges.

    Rows of a deleted tag in a bucket are dropped however many tags are asked for, unless a live file of its own has the tag:
    such a file is read beside the bucket.
    """
    asked = set(tags)
    if not asked and d.buckets:
        asked = d.valid_tags
    if asked:
        chosen = choose(d, asked, setting(FILE_SETTINGS, FILE_THRESHOLD, conf), setting(USAGE_SETTINGS, USAGE_PERCENT, conf))
    else:
        chosen = [e for e in d.entries if not e.deleted]
    chosen = [e for e in chosen if any(e.overlaps(w) for w in windows)]
    chosen.sort(key=lambda e: e.span[0] if e.span else ("", 0))
    out = []
    for e in chosen:
        if e.rows_tagged:
            whole = not asked or asked.issuperset(e.tags)
            out.append(Scan(e.path, None, True, None if whole else frozenset(asked), e.dropped_tags))
        else:
            out.append(Scan(e.path, e.tags[0] if e.tags else ""))
    return out


def load(path: str) -> Dictionary:
    try:
        data = files.read_all(path)
    except OSError as e:
        raise OSError(f"read_gor: cannot open {path}") from e
    d = parse(data.decode("utf-8", "replace"), path)
    if not d.entries:
        raise OSError(f"read_gor: empty dictionary {path}")
    return d
