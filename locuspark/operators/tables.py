"""Writing tables that several files make up: dictionaries and delimited text."""

from __future__ import annotations

import shutil
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blocks import BLOCK_BYTES, ZSTD
from ..sources import files, writer


def write_delimited(df: DataFrame, path: str, options: dict[str, str]) -> None:
    """One text file in the order of the rows, with a header unless ``header`` is false; cells with the delimiter, a quote or a line end are quoted.

    Tasks write parts, which the commit joins as it does for the formats of this package; no row passes through the driver.
    """
    raw = options.get("delimiter", options.get("delim", options.get("sep", ",")))
    header = "false" if options.get("header", "true").lower() in ("false", "0") else "true"
    df.write.format("locus_delimited").option("delimiter", raw.replace("\\t", "\t")).option("header", header).mode("overwrite").save(path)


def _encode_runs(scratch: str, flag: int, block_bytes: int):
    """Rows sorted by (file, key) in: a part file for each run of one file in a task; its description out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        found: list[dict] = []
        name, encoder, out = None, None, None

        def close() -> None:
            if encoder:
                encoder.finish()
                out.close()
                (c1, p1), (c2, p2) = encoder.first, encoder.last
                found[-1] |= {"c1": c1, "p1": p1, "c2": c2, "p2": p2}

        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(codes)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                this = coded.dictionary[int(codes[a])].as_py()
                if this != name:
                    close()
                    name = this
                    path = f"{scratch}/part-{context.partitionId():06d}-{context.taskAttemptId()}-{len(found):06d}"
                    out = writer.create(path)
                    encoder = writer.Encoder(out, True, flag, block_bytes)
                    found.append({"file": name, "part": context.partitionId(), "path": path})
                encoder.add(batch.slice(a, b - a).drop_columns([batch.schema.names[0]]))
        close()
        yield pa.RecordBatch.from_pylist(found, pa.schema([("file", pa.string()), ("part", pa.int32()), ("path", pa.string()), ("c1", pa.string()), ("p1", pa.int64()), ("c2", pa.string()), ("p2", pa.int64())]))

    return run


def _assemble(folder: str, header: bytes):
    """The parts of each file in order: put together behind the header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for name, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                joined = f"{folder}/.{name}.{attempt}"
                with writer.create(joined) as out:
                    out.write(header)
                    for part in parts:
                        with files.open_bytes(part["path"]) as f:
                            shutil.copyfileobj(f, out, 8 << 20)
                writer.move(joined, f"{folder}/{name}")
            yield batch.select(["file"])

    return run


def _write_files(rows: DataFrame, file: Column, columns: list[str], names: list[str], folder: str, options: dict[str, str]) -> list[tuple[str, str, int, str, int]]:
    """One sorted file for each value of ``file``; returns (file, first chromosome, position, last chromosome, position), one for each file.

    One range shuffle by (file, key) sorts the whole table, so a large file is encoded by many tasks and many
    small ones by one; a second, small job joins the parts of each file.
    """
    scratch = f"{folder}/.parts-{uuid.uuid4().hex}"
    writer.make_folder(scratch)
    try:
        flag = ZSTD if options.get("codec", "zlib") == "zstd" else 0
        keys = [F.col("_file"), *map(F.col, columns[:2])]
        dealt = rows.select(file.alias("_file"), *columns).repartitionByRange(*keys).sortWithinPartitions(*keys)
        parts = dealt.mapInArrow(_encode_runs(scratch, flag, int(options.get("block_bytes", BLOCK_BYTES))), "file string, part int, path string, c1 string, p1 long, c2 string, p2 long")
        at = f"file://{scratch}/made" if not files.is_uri(scratch) else f"{scratch}/made"
        parts.write.parquet(at)  # encoding is done once, whatever reads its descriptions
        parts = rows.sparkSession.read.parquet(at)
        order = F.sort_array(F.collect_list(F.struct("part", "path", F.struct("c1", "p1").alias("first"), F.struct("c2", "p2").alias("last"))))
        whole = parts.groupBy("file").agg(order.alias("parts"))
        header = ("\t".join(names) + "\n").encode()
        whole.select("file", "parts").mapInArrow(_assemble(folder, header), "file string").write.format("noop").mode("overwrite").save()
        first, last = F.col("parts")[0]["first"], F.element_at("parts", -1)["last"]
        return [tuple(r) for r in whole.select("file", first["c1"], first["p1"], last["c2"], last["p2"]).toLocalIterator()]
    finally:
        writer.remove_folder(scratch)


def write_dictionary(df: DataFrame, folder: str, name: str, tag: str, buckets: dict[str, list[str]] | None = None, **options: str) -> str:
    """One sorted file for each tag, a bucket file for each group of tags, and the dictionary ``folder/name``.

    The first two columns but ``tag`` are the key. The declared range of a file is that of its keys. Returns the dictionary's path.
    """
    writer.make_folder(folder)
    own = [c for c in df.columns if c != tag]
    writer.check_schema(df.select(*own).schema)
    bucket_of = {t: b for b, tags in (buckets or {}).items() for t in tags}
    lines = []
    for file, c1, p1, c2, p2 in sorted(_write_files(df, F.concat(F.col(tag), F.lit(".gorz")), own, own, folder, options)):
        t = file.removesuffix(".gorz")
        lines.append("\t".join([file + (f"|{bucket_of[t]}" if t in bucket_of else ""), t, c1, str(p1), c2, str(p2)]))
    if bucket_of:
        pairs = df.sparkSession.createDataFrame(list(bucket_of.items()), "_tag string, _bucket string")
        rows = df.join(pairs, F.col(tag) == F.col("_tag"))
        _write_files(rows, F.col("_bucket"), [*own, tag], [*own, "Source"], folder, options)
    path = f"{folder}/{name}"
    write_text(path, "".join(f"{x}\n" for x in lines))
    return path


def write_text(path: str, text: str) -> None:
    if files.is_uri(path):
        system, at = files._place(path)
        with system.open_output_stream(at) as out:
            out.write(text.encode())
    else:
        with open(path, "w") as out:
            out.write(text)
