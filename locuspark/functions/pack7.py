"""Seven-bit packing: arbitrary bytes as printable-range bytes 33..160 and back.

Seven bytes are one 56-bit little-endian number, cut into eight 7-bit digits.
The packed form holds no tab and no line feed.
"""

from __future__ import annotations

import numpy as np

OFFSET = 33
_SHIFTS = np.arange(0, 56, 7, dtype=np.uint64)


def pack(data: bytes) -> bytes:
    n = len(data)
    raw = np.zeros((-(-n // 7), 8), np.uint8)
    padded = np.zeros(len(raw) * 7, np.uint8)
    padded[:n] = np.frombuffer(data, np.uint8)
    raw[:, :7] = padded.reshape(-1, 7)
    digits = (raw.view("<u8") >> _SHIFTS) & np.uint64(127)
    return (digits.astype(np.uint8) + OFFSET).reshape(-1)[: -(-8 * n // 7)].tobytes()


def unpack(text: bytes) -> bytes:
    n = len(text) * 7 // 8
    digits = np.zeros(-(-len(text) // 8) * 8, np.uint8)
    digits[: len(text)] = np.frombuffer(text, np.uint8) - np.uint8(OFFSET)
    numbers = ((digits.reshape(-1, 8).astype(np.uint64) & np.uint64(127)) << _SHIFTS).sum(axis=1, dtype=np.uint64)
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].reshape(-1)[:n].tobytes()
