"""Genomic range specs and seek windows.

A spec is ``chrom``, ``chrom:p``, ``chrom:a-b``, ``chrom:a-`` or ``chrom:-b``; positions are 1-based and inclusive.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

LEAST, MOST = -(1 << 63), (1 << 63) - 1


@dataclass(frozen=True)
class Window:
    """Rows of one chromosome (None: any) with low <= position <= high."""

    chrom: str | None = None
    low: int = LEAST
    high: int = MOST
    empty: bool = False

    def meet(self, other: Window) -> Window:
        chrom = other.chrom if self.chrom is None else self.chrom
        low, high = max(self.low, other.low), min(self.high, other.high)
        clash = self.chrom is not None and other.chrom is not None and self.chrom != other.chrom
        return Window(chrom, low, high, self.empty or other.empty or clash or low > high)

    @property
    def open(self) -> bool:
        return self == Window()


def _position(text: str, spec: str) -> int:
    body = text.strip(" ")
    if not body:
        raise ValueError(f"range: empty position in '{spec}'")
    # Leading blanks and a plus sign are fine, what follows the digits is not.
    if not re.fullmatch(r"[ \t\n\v\f\r]*\+?\d+", text) or int(text) > MOST:
        raise ValueError(f"range: bad position '{text}' in '{spec}'")
    return int(text)


def parse_range(spec: str | None) -> Window:
    """The window of a spec; None and the empty string are no restriction."""
    if not spec:
        return Window()
    chrom, colon, rest = spec.partition(":")
    if not chrom:
        raise ValueError(f"range: empty chromosome in '{spec}'")
    if not colon:
        return Window(chrom)
    first, dash, last = rest.partition("-")
    if not dash:
        at = _position(rest, spec)
        return Window(chrom, at, at)
    low = _position(first, spec) if first else LEAST
    high = _position(last, spec) if last else MOST
    if first and last and high < low:
        raise ValueError(f"range: end < start in '{spec}'")
    return Window(chrom, low, high)
