"""C1-C19: packing, framing, compression and columnar encodings, from bytes built by hand."""

import struct
import zlib

import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from locuspark.functions import blocks as B
from locuspark.functions import cells
from locuspark.functions.pack7 import pack, unpack


def slow_pack(data):
    bits = "".join(f"{b:08b}"[::-1] for b in data)
    return bytes(int(bits[i : i + 7][::-1], 2) + 33 for i in range(0, len(bits), 7))


@given(st.binary(max_size=300))
@settings(max_examples=150, deadline=None)
def test_pack_is_the_bitwise_definition_and_round_trips(data):  # C3, C4
    assert pack(data) == slow_pack(data)
    assert unpack(pack(data)) == data
    assert all(33 <= b <= 160 for b in pack(data))
    assert len(pack(data)) == -(-8 * len(data) // 7)


def test_unpack_of_less_than_two_bytes_is_empty():
    assert unpack(b"") == unpack(b"!") == b""


def test_header_variants():  # C1
    assert B.parse_header(b"#chrom\tpos").columns == ("chrom", "pos")
    assert B.parse_header(b"chrom\tpos\tval").columns == ("chrom", "pos", "val")
    h = B.parse_header(b"chrom\tpos\0tables")
    assert h.columns == ("chrom", "pos") and h.tables == b"tables"
    with pytest.raises(B.FormatError):
        B.parse_header(b"")


@pytest.mark.parametrize(("line", "message"), [(b"chr1", "missing pos"), (b"chr1\t5", "missing flag"), (b"chr1\t5\t", "missing flag"), (b"chr1\t5\t\0", "empty block payload")])
def test_block_errors(line, message):  # C2
    with pytest.raises(B.FormatError, match=message):
        B.split_block(line)


def test_frame_and_content():  # C5, C7, C18
    data = b"chr1\t1\tA\nchr1\t2\tB"
    line = B.frame(data, b"chr1", b"2")
    assert line.startswith(b"chr1\t2\t\0") and line.endswith(b"\n") and line.count(b"\n") == 1
    block = B.split_block(line[:-1])
    assert B.content(block) == data
    assert unpack(block.payload) == zlib.compress(data, 6)


def test_zstd_with_and_without_content_size():  # C6
    data = b"chr1\t1\n" * 1000
    sized = zstandard.ZstdCompressor().compress(data)
    writer = zstandard.ZstdCompressor(write_content_size=False).compressobj()
    streamed = writer.compress(data) + writer.flush()
    assert B.inflate(sized, True) == B.inflate(streamed, True) == data


def columnar(kinds, rows, *payloads):
    return struct.pack(">H", rows) + bytes(kinds) + b"\0" + b"".join(payloads)


@pytest.mark.parametrize(
    ("kind", "payload", "want"),
    [
        (5, struct.pack(">q3B", -10, 0, 1, 255), [b"-10", b"-9", b"245"]),  # C10
        (7, struct.pack(">qi", 100, -7), [b"93", b"86", b"79"]),  # C11: the first value is start + step
        (12, struct.pack(">q3b", 5, -1, 0, 127), [b"4", b"4", b"131"]),  # C12
        (13, struct.pack(">q3h", 5, -300, 300, 1), [b"-295", b"5", b"6"]),  # C13
        (21, struct.pack(">I", 6) + b"a\0\0bc\0", [b"a", b"", b"bc"]),  # C14
        (23, b"same\0", [b"same"] * 3),  # C15
        (25, struct.pack(">3b", 2, -1, 9), [b"two", b"one", b""]),  # C16: an unknown index is empty
    ],
)
def test_columnar_encodings(kind, payload, want):  # C9
    table = struct.pack(">HBH", 1, 0, 3) + b"zero\0one\0two\0"
    tables = B.Tables(pack(zlib.compress(table)), False)
    assert [c.to_pylist() for c in B.decode_columns(columnar([kind], 3, payload), tables)] == [[x.decode() for x in want]]


def test_lookup_table_columns_are_deltas():  # C8
    data = struct.pack(">H", 2) + struct.pack(">BH", 2, 1) + b"x\0" + struct.pack(">BH", 3, 1) + b"y\0"
    assert B.Tables(pack(zlib.compress(data)), False).of == {2: [b"x"], 5: [b"y"]}


@pytest.mark.parametrize("kind", [3, 4, 9, 10, 11, 19, 20, 22, 24, 27, 28, 29])
def test_unsupported_encodings(kind):  # C17
    with pytest.raises(B.UnsupportedTypeIdError, match=f"TYPEID {kind} not implemented"):
        B.decode_columns(columnar([kind], 1, b"x" * 20), B.Tables(b"", False))


def test_truncated_columns():
    with pytest.raises(B.FormatError, match="truncated"):
        B.decode_columns(columnar([5], 9, struct.pack(">q", 1)), B.Tables(b"", False))


def test_rows_are_padded_cut_and_not_trimmed():  # C19
    got = [c.to_pylist() for c in cells.split_rows(b'chr1\t1\nchr1\t2\t"q\tx\ty\nchr2\t3\tv\r', 3).values()]
    assert got == [["chr1", "chr1", "chr2"], ["1", "2", "3"], ["", '"q', "v\r"]]
    assert [c.to_pylist() for c in cells.split_rows(b"a\t1\t'x'\nb\t2\tNA", 3).values()] == [["a", "b"], ["1", "2"], ["'x'", "NA"]]


@pytest.mark.parametrize(
    ("text", "i32", "i64", "f64"),
    [
        ("12abc", 12, 12, 12.0),
        ("1.5", 1, 1, 1.5),
        (" 7", None, None, 7.0),
        ("+5", None, None, 5.0),
        ("2147483648", None, 2147483648, 2147483648.0),
        ("", None, None, None),
        ("-3x", -3, -3, -3.0),
        ("1e3", 1, 1, 1000.0),
        ("inf", None, None, float("inf")),
        ("-Infinity", None, None, float("-inf")),
        ("1e400", 1, 1, None),
        ("1e-400", 1, 1, None),
        ("0x1p3", 0, 0, 8.0),
        (".5.5", None, None, 0.5),
        ("abc", None, None, None),
        ("9999999999999999999", None, None, 1e19),
    ],
)
def test_numeric_prefixes(text, i32, i64, f64):  # Q-2, Q-3
    for kind, want in ((pa.int32(), i32), (pa.int64(), i64), (pa.float64(), f64)):
        assert cells.parse_column(pa.array([text, "1"]), kind).to_pylist() == [want, 1]


@given(st.floats(allow_nan=False))
@settings(max_examples=200, deadline=None)
def test_doubles_print_like_repr(x):
    assert cells.value_text(x, pa.float64()) == repr(x)


def test_text_of_other_types():
    import datetime as dt
    import decimal

    assert cells.value_text(True, pa.bool_()) == "true"
    assert cells.value_text(1e10, pa.float32()) == "10000000000.0"
    assert cells.value_text(0.1, pa.float32()) == "0.1"
    assert cells.value_text(dt.datetime(2024, 1, 1, 0, 0, 0, 120000), pa.timestamp("us")) == "2024-01-01 00:00:00.12"
    assert cells.value_text(decimal.Decimal("1.50"), pa.decimal128(5, 2)) == "1.50"
    assert cells.value_text([1, None], pa.list_(pa.int32())) == "[1, NULL]"
    assert cells.value_text({"a": 1}, pa.struct([("a", pa.int32())])) == "{'a': 1}"
    assert cells.value_text([("k", 1)], pa.map_(pa.string(), pa.int32())) == "{k=1}"
    assert cells.value_text(None, pa.int32()) == ""
