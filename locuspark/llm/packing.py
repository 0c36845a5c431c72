"""Best-fit packing of documents into fixed-size training sequences, with conflicts.

A document of more than ``capacity`` units fills whole bins of its own and its
remainder is packed; nothing is cut otherwise, and nothing is left out. Remainders are packed by
decreasing length. Open bins are ordered by what is left in them; a bin also carries two bitmaps, of the sources and of
the duplicate clusters it holds. The search starts at the tightest bin that is large enough and goes on to the next
larger residual until a bin without a conflict is found; else a new bin opens.
No bin holds two pieces of one cluster, or two of one source.

Packing is sequential, so rows are dealt into groups of about ``group_rows`` by a hash of their id and each group is
packed by itself: the number of groups grows with the input, a hot source or cluster is spread evenly over
all groups, and a task holds one group's lengths, never texts. Bins are the same whatever the partitioning.

Within a group a bin of residual r is found in O(log) steps by a bitmap of the residuals in use; per residual, bins are kept by their
source bitmap, so that bins with equal sources are skipped together.

Defined results: a null text and an empty one have the length of their end mark, 1; a very long text fills bins of its own up to its remainder; a null source or cluster never conflicts;
rows that repeat a doc_id are documents of their own (equal texts conflict as one cluster); a null doc_id
is packed as the smallest; ties are taken in the order of doc_id; an empty table gives no bins; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, quoted, with_text

CAPACITY = 2048
GROUP_ROWS = 4096


def pack(pieces: list[tuple[int, int | None, int | None]], capacity: int) -> list[int]:
    """The bin of each piece (length, source, cluster), given in packing order. Sources and clusters are small integers.

    ``used`` is a bitmap of the residuals that some bin has; its lowest bit from
    a length on is the successor. ``open_bins[r]`` maps a source bitmap to the
    bins with residual r and these sources, as (number, cluster bitmap), the oldest first.
    """
    used = 0
    open_bins: list[dict[int, list[tuple[int, int]]]] = [{} for _ in range(capacity + 1)]
    out, bins = [], 0
    for length, source, cluster in pieces:
        s = 0 if source is None else 1 << source
        c = 0 if cluster is None else 1 << cluster
        above = used >> length
        at = length - 1
        best = None
        while above and best is None:
            step = (above & -above).bit_length()
            at, above = at + step, above >> step
            for held, rows in open_bins[at].items():
                if held & s:
                    continue
                for i, (number, clusters) in enumerate(rows):
                    if not clusters & c:
                        if best is None or number < best[0]:
                            best = (number, clusters, held, i)
                        break
        if best is None:
            number, clusters, held, rest = bins, 0, 0, capacity - length
            bins += 1
        else:
            number, clusters, held, i = best
            rows = open_bins[at][held]
            del rows[i]
            if not rows:
                del open_bins[at][held]
                if not open_bins[at]:
                    used ^= 1 << at
            rest = at - length
        out.append(number)
        if rest:
            open_bins[rest].setdefault(held | s, []).append((number, clusters | c))
            open_bins[rest][held | s].sort()
            used |= 1 << rest
    return out


def _pack_groups(capacity: int):
    """Runs of equal group in, already in packing order; (group, bin, _doc, piece, length) out."""

    def one(rows: list[tuple]) -> list[int]:
        sources = {x: i for i, x in enumerate(dict.fromkeys(r[4] for r in rows if r[4] is not None))}
        seen: dict[int, int] = {}
        for r in rows:
            if r[5] is not None:
                seen[r[5]] = seen.get(r[5], 0) + 1
        # A cluster with one member in the group can't conflict and needs no bit.
        clusters = {x: i for i, x in enumerate(x for x, n in seen.items() if n > 1)}
        return pack([(r[3], sources.get(r[4]), clusters.get(r[5])) for r in rows], capacity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_group", "_bin", "_doc", "_piece", "_length"]
        held: list[tuple] = []
        kind = None

        def done() -> pa.RecordBatch:
            bins = one(held)
            columns = [[r[0] for r in held], bins, [r[1] for r in held], [r[2] for r in held], [r[3] for r in held]]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), kind, pa.int32(), pa.int32()), strict=True)], names)

        for batch in batches:
            kind = batch.schema.field(1).type
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and held[0][0] != row[0]:
                    yield done()
                    held = []
                held.append(row)
        if held:
            yield done()

    return run


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str | None = "source",
    length: Column | None = None,
    cluster: Column | None = None,
    capacity: int = CAPACITY,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row for each piece of a document: ``bin_id``, the id, ``piece``, ``start`` (in the document) and ``n_units``.

    length: units of a document; by default its words and one end mark.
    cluster: a column of type long that equal or near-equal documents share; by default a hash of the text without blanks at both ends.
    bin_id is (group << 32) + number of the bin in its group.
    """
    text = with_text(docs, text_col)
    bare = F.lower(F.btrim(text, F.lit(" \t\n\x0b\x0c\r")))
    units = (F.regexp_count(text, F.lit(WORD)) + 1 if length is None else length).cast("int")
    rows = docs.select(
        quoted(id_col).alias("_doc"),
        units.alias("_n"),
        F.xxhash64(text).alias("_t"),
        (F.xxhash64(quoted(source_col)) if source_col else F.lit(None).cast("long")).alias("_s"),
        (F.when(bare != "", F.xxhash64(bare)) if cluster is None else cluster).cast("long").alias("_c"),
        (quoted(source_col).isNull() if source_col else F.lit(True)).alias("_no"),
    ).withColumn("_s", F.when(~F.col("_no"), F.col("_s")))
    groups = max(1, -(-docs.count() // group_rows))
    last = F.floor((F.col("_n") - 1) / capacity).cast("int")
    cuts = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(i.alias("i"), F.least(F.lit(capacity), F.col("_n") - i * capacity).alias("n")))
    pieces = rows.withColumn("_group", F.pmod(F.xxhash64("_doc", "_t"), F.lit(groups))).select("_group", "_doc", "_t", F.explode(cuts).alias("_p"), "_s", "_c")
    pieces = pieces.select("_group", "_doc", F.col("_p.i").alias("_piece"), F.col("_p.n").alias("_length"), "_s", "_c", "_t")
    order = [F.col("_group"), F.col("_length").desc(), F.col("_doc"), F.col("_t"), F.col("_piece")]
    dealt = pieces.repartition("_group").sortWithinPartitions(*order).drop("_t")
    kind = dict(rows.dtypes)["_doc"]
    packed = dealt.mapInArrow(_pack_groups(capacity), f"_group long, _bin long, _doc {kind}, _piece int, _length int")
    out = packed.select((F.shiftleft("_group", 32) + F.col("_bin")).alias("bin_id"), F.col("_doc").alias(id_col), F.col("_piece").alias("piece"), (F.col("_piece") * F.lit(capacity)).cast("long").alias("start"), F.col("_length").cast("long").alias("n_units"))
    return out
