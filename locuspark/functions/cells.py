"""Between cell text and typed columns.

Reading: numbers are parsed by their longest numeric prefix, and what has none or is out of range is null. Text
columns are taken as they are; an empty cell is the empty string. Writing: the text of a value is
what SQL engines print, with shortest round-trip decimals for floating-point numbers.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pv

_INT = re.compile(r"-?\d+")
_FLOAT = re.compile(r"[ \t\n\v\f\r]*([+-]?)(inf(?:inity)?|nan(?:\(\w*\))?|0x(?:[0-9a-f]+\.?[0-9a-f]*|\.[0-9a-f]+)(?:p[+-]?\d+)?|(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?)", re.I)


def int_prefix(text: str, bits: int) -> int | None:
    m = _INT.match(text)
    if not m:
        return None
    value = int(m[0])
    return value if -(1 << (bits - 1)) <= value < 1 << (bits - 1) else None


def float_prefix(text: str) -> float | None:
    m = _FLOAT.match(text)
    if not m:
        return None
    body = m[2].lower()
    if body.startswith(("inf", "nan")):
        value = float(body[:3])
    else:
        value = float.fromhex(body) if body.startswith("0x") else float(body)
        # Out of range on either side has no value.
        if math.isinf(value) or value < 2.2250738585072014e-308 and re.search(r"[1-9a-f]", re.split("[ep]" if body[:2] != "0x" else "p", body.removeprefix("0x"))[0]):
            return None
    return -value if m[1] == "-" else value


def parse_column(texts: pa.Array, kind: pa.DataType) -> pa.Array:
    """A typed column from cells; strings stay."""
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return texts
    if pa.types.is_integer(kind):
        if not len(texts) or pc.all(pc.match_substring_regex(texts, r"^-?\d{1,9}$")).as_py():
            return pc.cast(texts, kind)
        parse = lambda x: int_prefix(x, kind.bit_width)
    else:
        if not len(texts) or pc.all(pc.match_substring_regex(texts, r"^-?\d{1,15}(\.\d{1,15})?$")).as_py():
            return pc.cast(texts, kind)
        parse = float_prefix
    coded = texts.dictionary_encode()
    values = pa.array([parse(x) for x in coded.dictionary.to_pylist()], kind)
    return values.take(coded.indices)


def positions(texts: pa.Array) -> np.ndarray:
    """The 64-bit positions of cells; 0 where a cell is no integer."""
    if not len(texts) or pc.all(pc.match_substring_regex(texts, r"^-?\d{1,18}$")).as_py():
        return pc.cast(texts, pa.int64()).to_numpy(zero_copy_only=False)
    return np.array([int_prefix(x, 64) or 0 for x in texts.to_pylist()], np.int64)


def split_rows(data: bytes, n: int, only: list[int] | None = None) -> dict[int, pa.Array]:
    """Rows of n tab-separated cells as string columns by number: short rows are padded, cells beyond n ignored, nothing is quoted or trimmed.

    ``only``: the columns that are asked for, at least one.
    """
    wanted = list(range(n)) if only is None else only
    if b"\r" not in data and data:
        try:
            names = [str(i) for i in range(n)]
            table = pv.read_csv(
                pa.BufferReader(data if data.endswith(b"\n") else data + b"\n"),
                read_options=pv.ReadOptions(use_threads=False, column_names=names, block_size=max(len(data) + 1, 1 << 16)),
                parse_options=pv.ParseOptions(delimiter="\t", quote_char=False, double_quote=False, escape_char=False, newlines_in_values=False, ignore_empty_lines=False),
                convert_options=pv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), strings_can_be_null=False, include_columns=[names[i] for i in wanted]),
            )
            return {i: c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for i, c in zip(wanted, table.columns, strict=True)}
        except pa.ArrowInvalid:
            pass  # rows of other widths, or bytes that are no UTF-8
    rows = [x.split("\t") for x in data.removesuffix(b"\n").decode("utf-8", "replace").split("\n")]
    return {i: pa.array([r[i] if i < len(r) else "" for r in rows], pa.string()) for i in wanted}


def _float_text(value: float, digits: str) -> str:
    """Shortest digits (repr of the value's own width); an exponent below 1e-4 and from 1e16 on."""
    if math.isnan(value):
        return "nan"
    if math.isinf(value):
        return "inf" if value > 0 else "-inf"
    number = decimal.Decimal(digits)
    sign, figures, _ = number.as_tuple()
    power = number.adjusted() if number else 0
    text = "".join(map(str, figures)).rstrip("0") or "0"
    if number and (power < -4 or power >= 16):
        mantissa = text[0] + ("." + text[1:] if len(text) > 1 else "")
        out = f"{mantissa}e{'-' if power < 0 else '+'}{abs(power):02d}"
    elif power < 0:
        out = "0." + "0" * (-power - 1) + text
    else:
        whole, part = text[: power + 1].ljust(power + 1, "0"), text[power + 1 :]
        out = f"{whole}.{part or '0'}"
    return ("-" if sign else "") + out


def _time_text(value: dt.datetime | dt.time) -> str:
    out = value.strftime("%H:%M:%S")
    return out + (f".{value.microsecond:06d}".rstrip("0") if value.microsecond else "")


def value_text(value, kind: pa.DataType, nested: bool = False) -> str:
    """The text of one value; null is empty, within a list, struct or map NULL."""
    t = pa.types
    if value is None:
        return "NULL" if nested else ""
    if t.is_boolean(kind):
        return "true" if value else "false"
    if t.is_float32(kind):
        return _float_text(value, str(np.float32(value)))
    if t.is_float64(kind):
        return _float_text(value, repr(value))
    if t.is_timestamp(kind):
        out = f"{value.year:04d}-{value.month:02d}-{value.day:02d} {_time_text(value)}"
        return out + ("+00" if kind.tz else "")
    if t.is_date(kind):
        return value.isoformat()
    if t.is_binary(kind) or t.is_large_binary(kind):
        return "".join(chr(b) if 32 <= b < 127 and b not in (34, 39, 92) else f"\\x{b:02X}" for b in value)
    if t.is_list(kind) or t.is_large_list(kind):
        return f"[{', '.join(value_text(x, kind.value_type, True) for x in value)}]"
    if t.is_struct(kind):
        return "{" + ", ".join(f"'{f.name}': {value_text(value[f.name], f.type, True)}" for f in kind) + "}"
    if t.is_map(kind):
        return "{" + ", ".join(f"{value_text(k, kind.key_type, True)}={value_text(v, kind.item_type, True)}" for k, v in value) + "}"
    return str(value)


def column_texts(column: pa.Array) -> pa.Array:
    """The texts of a column; kinds that Arrow prints otherwise are printed once for each distinct value."""
    kind, t = column.type, pa.types
    if t.is_string(kind) or t.is_large_string(kind):
        return pc.fill_null(column, "")
    if t.is_integer(kind) or t.is_boolean(kind):
        return pc.fill_null(pc.cast(column, pa.string()), "")
    if t.is_timestamp(kind) and kind.tz:
        column = pc.cast(column, pa.timestamp("us", "UTC"))
    if t.is_floating(kind) or t.is_temporal(kind) or t.is_decimal(kind):
        coded = column.dictionary_encode()
        texts = pa.array([value_text(x, column.type) for x in coded.dictionary.to_pylist()], pa.string())
        return pc.fill_null(texts.take(coded.indices), "")
    return pa.array([value_text(x, kind) for x in column.to_pylist()], pa.string())
