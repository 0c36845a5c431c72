"""Token ids as Parquet files with list columns, for selective reads.

Texts are encoded and written in ascending id order: rows are dealt by ranges of the id, sorted, encoded in
place and written by Spark's own Parquet writer with delta encoding for lengths and positions, dictionary encoding for token ids, row
groups and pages of set sizes, and page indexes, which that format has always. A reader
can so take some columns (``n_tokens`` without ``tokens``), some row groups (by ``doc_id``) or some pages.

The position of a document among all ids is the sum of its file's base and its position in the file; the bases come from
one row for each file.

The library encodes every distinct part of the texts once and an encoder keeps the result for later rows, up to a
bound. A part is what stands between two spaces or line feeds, and whether parts may be encoded apart is read from the tokenizer's file
(``separable``); the tests compare the ids with the library's encoding of whole texts.

Defined results: a null or empty text has the end id alone; a very long text is one row, whose ids take up to four bytes a
character of memory; rows that repeat a doc_id are ordered by a hash of their
text; a null doc_id comes first; an empty table gives an empty result; other columns, whatever their names, are neither read nor written.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import quoted, scratch_path, with_text

END_ID = 2
#: Parts kept by an encoder; it starts anew beyond that. About 250 bytes each.
MOST_PARTS = 500_000
#: Parts in one call of the library.
CALL = 1024
#: Rows encoded at once.
SLICE = 2048
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10


# The pre-tokenization for which ``separable`` holds, as tokenizer files state it.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ("NFC", "Lowercase", "Replace")


def _steps(spec: dict | None, inner: str) -> list[dict]:
    """The members of a sequence, or the one step there is."""
    if spec is None:
        return []
    return spec[inner] if spec["type"] == "Sequence" else [spec]


def separable(spec: dict) -> bool:
    """Whether the parts of a text between " " and line feed can be encoded apart, by what a tokenizer file says.

    NFC joins nothing to a space, lower case acts on single characters, runs of white space become one space, the pattern drops white
    space and matches none, added tokens hold none and take none from beside them: no step looks across a space.
    """
    changes = _steps(spec.get("normalizer"), "normalizers")
    cuts = _steps(spec.get("pre_tokenizer"), "pretokenizers")
    return (
        all(x["type"] in NORMALIZERS and (x["type"] != "Replace" or (x["pattern"], x["content"]) == ({"Regex": r"\s+"}, " ")) for x in changes)
        and [x["type"] for x in cuts] == ["Split", "ByteLevel"]
        and (cuts[0]["pattern"], cuts[0]["behavior"], cuts[0]["invert"]) == ({"Regex": PRE_TOKEN}, "Removed", True)
        and not cuts[1]["add_prefix_space"]
        and not cuts[1]["use_regex"]
        and not any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] or re.search(r"\s", x["content"]) for x in spec.get("added_tokens", ()))
        and any(x["type"] == "Lowercase" for x in changes)
        and spec["model"]["type"] == "BPE"
        and not spec["model"].get("dropout")
    )


class Encoder:
    """Encodes texts with a file of the tokenizers library.

    Where the file is ``separable``, every distinct part of the texts between " " and line feeds, after ``_spaced``, goes through the library,
    many in one call; the offsets of the call's tokens say which part they belong to. Otherwise texts are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.safe = separable(spec)
        #: Texts with a mark, which NFC may join to an ASCII letter, or with an added token in any case.
        self.tied = "|".join([r"\p{M}", *(f"(?i:{re.escape(x['content'])})" for x in spec.get("added_tokens", ()))])
        self.forget()

    def forget(self) -> None:
        #: Of each known part its number; number i has ids[starts[i] : starts[i + 1]].
        self.number: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _spaced(self, texts: pa.Array) -> pa.Array:
        """Texts with the same ids and fewer distinct parts: A-Z in lower case, a space where ASCII punctuation follows a-z.

        Lower case is a step of the tokenizer, and there its pattern ends a match whatever stands before or after:
        none of its alternatives goes on from a letter to punctuation.
        """
        spaced = pc.replace_substring_regex(pc.ascii_lower(texts), r"([a-z])([!-/:-@\[-`{-~])", r"\1 \2")
        return pc.if_else(pc.match_substring_regex(texts, self.tied), texts, spaced)

    def _add(self, parts: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        first, total = len(self.number), self.used + len(ids)
        while total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while first + len(parts) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.ids[self.used : total] = ids
        self.starts[first + 1 : first + 1 + len(parts)] = self.used + np.cumsum(sizes)
        self.number.update(zip(parts, range(first, first + len(parts)), strict=True))
        self.used = total

    def _learn(self, parts: list[str]) -> None:
        for at in range(0, len(parts), CALL):
            group = parts[at : at + CALL]
            x = self.tokenizer.encode(" ".join(group), add_special_tokens=False)
            spans = np.fromiter(chain.from_iterable(x.offsets), np.int64).reshape(-1, 2)
            ends = np.cumsum(np.fromiter(map(len, group), np.int64, len(group)) + 1)
            of = np.searchsorted(ends, spans[:, 0], "right")
            if (spans[:, 1] < ends[of]).all() and (of[1:] >= of[:-1]).all():
                self._add(group, np.array(x.ids, np.uint32), np.bincount(of, minlength=len(group)))
            else:
                found = [x.ids for x in self.tokenizer.encode_batch(group, add_special_tokens=False)]
                sizes = np.array([len(x) for x in found], np.int64)
                self._add(group, np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes)

    def _take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of parts by number, one after another, and how many each has."""
        starts = self.starts[numbers]
        sizes = self.starts[numbers + 1] - starts
        offsets = np.cumsum(sizes) - sizes
        return self.ids[np.repeat(starts - offsets, sizes) + np.arange(int(sizes.sum()))], sizes

    def encode(self, texts: pa.Array, end_id: int) -> pa.ListArray:
        """The ids of each text, with the end id."""
        if not self.safe:
            rows = [[*self.tokenizer.encode(x, add_special_tokens=False).ids, end_id] for x in texts.to_pylist()]
            return pa.array(rows, pa.list_(pa.int32()))
        lists = pc.split_pattern(pc.replace_substring(self._spaced(texts), "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        parts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.number) > MOST_PARTS:
            self.forget()
        self._learn([x for x in parts if x not in self.number])
        numbers = np.fromiter(map(self.number.__getitem__, parts), np.int64, len(parts))
        ids, sizes = self._take(numbers[coded.indices.to_numpy()])
        # One more id at the end of each text.
        first = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        before = np.concatenate([[0], np.cumsum(sizes)])
        offsets = before[first] + np.arange(len(first))
        out = np.full(offsets[-1], end_id, np.int32)
        of_text = np.repeat(np.arange(len(texts)), np.diff(before[first]))
        out[np.arange(len(ids)) + of_text] = ids.view(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(out))


@cache
def encoder(path: str) -> Encoder:
    """One for each Python worker, kept from task to task."""
    return Encoder(path)


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            for at in range(0, len(batch), SLICE):  # ids take more room than text
                part = batch.slice(at, SLICE)
                ids = encode(part.column(1), end_id)
                sizes = pc.cast(pc.list_value_length(ids), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), ids, sizes], ["doc_id", "tokens", "n_tokens"])

    return run


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES
) -> None:
    """Write (doc_id, tokens, n_tokens, file) to the folder ``path``, in ascending order over its files. ``file`` numbers the files in order."""
    rows = docs.select(quoted(id_col).alias("doc_id"), with_text(docs, text_col).alias("_text"))
    kind = dict(rows.dtypes)["doc_id"]
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("_text"))
    encoded = ordered.mapInArrow(_encode(tokenizer, end_id), f"doc_id {kind}, tokens array<int>, n_tokens long")
    encoded = encoded.select("*", F.spark_partition_id().alias("file"), F.monotonically_increasing_id().alias("row"))
    options = {
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#tokens.list.element": "true",
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.size": str(page_bytes),
        "compression": "zstd",
    }
    encoded.write.options(**options).parquet(path)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(1)
        values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        ends = lists.offsets.to_numpy()
        sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(sums, pa.int64())], ["doc_id", "file", "row", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files with ``start``, the ids of all documents before a document."""
    rows = spark.read.parquet(path)
    return _placed(rows, rows)


def _placed(rows: DataFrame, written: DataFrame) -> DataFrame:
    """``rows`` with their starts; the files' sums are read from two columns of ``written``."""
    files = written.groupBy("file").agg(F.sum("n_tokens").alias("_sum"))
    # One row for each file.
    bases = files.select("file", (F.sum("_sum").over(Window.orderBy("file")) - F.col("_sum")).alias("_base"))
    within = Window.partitionBy("file").orderBy("row")
    placed = rows.withColumn("_in_file", F.sum("n_tokens").over(within) - F.col("n_tokens"))
    return placed.join(bases, "file").withColumn("start", F.col("_base") + F.col("_in_file")).drop("_base", "_in_file")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids, all from the files."""
    rows = spark.read.parquet(path).select("doc_id", "tokens", "file", "row", "n_tokens")
    kind = dict(rows.dtypes)["doc_id"]
    sums = rows.mapInArrow(_digest, f"doc_id {kind}, file int, row long, n_tokens long, ids_crc32 long")
    return _placed(sums, spark.read.parquet(path)).select("doc_id", "start", "n_tokens", "ids_crc32")


def tokens_table(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the tokens of ``docs`` to a new folder beside the checkpoints and give their digests."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer, **options)
    return token_digests(spark, path)
