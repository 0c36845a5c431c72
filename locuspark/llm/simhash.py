"""Near-duplicates by SimHash fingerprints, searched with a pigeonring filter.

A fingerprint has 64 bits; two link at ``distance`` or fewer differing bits. It is
cut into m segments on a ring. If two fingerprints differ in at most t bits,
some chain of consecutive segments has, for every length l, at most l * t / m
differing bits in its first l segments. Within those budgets certain segments must
be equal; which ones is a short list of patterns (``patterns``). So pairs are sought
in buckets of fingerprints that agree on the segments of one pattern, a pair
is pruned unless the chain from the pattern's start keeps its budgets, and what
is left gets the full Hamming check.

Work is on distinct fingerprints, and a bucket gives no pairs: it is searched
outward from one member after another, each found member taken out, and gives
the links of a forest that spans its components. A bucket above ``block``
members is dealt out as pairs of blocks, so that no task holds more than two blocks
and every pair still meets; only such a bucket costs the square of its blocks. Its rows never meet in one task: their bucket's size reaches
them by broadcast. m grows with the number of fingerprints, which keeps
buckets of unlike fingerprints small. Components come from joins (``components``).

Defined results: a null or empty text and one of blanks have fingerprint zero and link
like any other; a very long text is hashed in pieces; repeated rows are members like any other; the component's id is its smallest
doc_id that is not null; an empty table gives an empty result; other columns are kept by ``near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, is_empty, lookup, materialise, numbered, quoted, with_text
from .components import connected_components

BITS = 64
DISTANCE = 4
SHINGLE_WORDS = 4
SEED = 42
BLOCK = 20_000
#: Hashes counted at once, so that very long texts need little memory.
CHUNK = 1 << 16


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """The SimHash of UTF-8 text; bytes.lower and bytes.split act on A-Z and [\\x20\\x09-\\x0D] only."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = list(accumulate(map((1).__add__, map(len, tokens))))
    if len(tokens) <= words:
        pieces, n = iter([joined]), 1
    else:
        n = len(tokens) - words + 1
        pieces = map(joined.__getitem__, map(slice, [0, *ends[: n - 1]], map((-1).__add__, ends[words - 1 :])))
    hashes = map(xxhash.xxh64_intdigest, pieces, repeat(SEED))
    counts = np.zeros(BITS, np.int64)
    for done in range(0, n, CHUNK):
        part = np.fromiter(hashes, np.dtype("<u8"), min(CHUNK, n - done))
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        prints = np.fromiter((fingerprint(x.as_buffer().to_pybytes()) for x in texts), np.uint64, len(texts))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(prints.view(np.int64))], ["_doc", "_t", "_print"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_doc, _t, _print) for each row: the id, a hash of the text, and the 64 bits in a signed long."""
    text = with_text(docs, text_col)
    rows = docs.select(quoted(id_col).alias("_doc"), text.alias("_text"), F.xxhash64(text).alias("_t"))
    kind = dict(rows.dtypes)["_doc"]
    return rows.mapInArrow(_fingerprints, f"_doc {kind}, _t long, _print long")


def segments(m: int) -> list[int]:
    """The masks of m segments of nearly equal width."""
    cuts = [BITS * i // m for i in range(m + 1)]
    return [((1 << b) - (1 << a)) for a, b in zip(cuts, cuts[1:], strict=False)]


def patterns(m: int, depth: int, distance: int) -> list[tuple[int, int]]:
    """(start, mask of the segments that are equal): what the chain condition allows within the first ``depth`` segments.

    A segment that differs takes at least one bit of the budget, so of the first l
    segments at most l * distance // m differ, the first never if distance < m.
    """
    masks, need = segments(m), depth - depth * distance // m
    out = []

    def grow(start: int, at: int, equal: int, mask: int) -> None:
        if equal == need:
            out.append((start, mask))
        elif at < depth:
            grow(start, at + 1, equal + 1, mask | masks[(start + at) % m])
            if at + 1 - equal <= (at + 1) * distance // m:
                grow(start, at + 1, equal, mask)

    for start in range(m):
        grow(start, 0, 0, 0)
    return out


def plan(n: int, distance: int) -> tuple[int, int]:
    """(m, depth) for n distinct fingerprints: keys of at least log2(n) + 2 bits, in as few patterns as that allows."""
    bits = max(n, 2).bit_length() + 2
    best = None
    for m in range(distance + 1, 4 * distance + 1):
        for depth in range(1, m + 1):
            width = BITS // m * (depth - depth * distance // m)
            if width >= bits or (m, depth) == (4 * distance, m):
                cost = len(patterns(m, depth, distance))
                if best is None or cost < best[0]:
                    best = (cost, m, depth)
    return best[1], best[2]


def _linker(m: int, distance: int):
    """A function for mapInArrow: runs of equal (start, key, lo, hi) in, links of spanning forests out."""
    masks = np.array(segments(m), np.uint64)
    budgets = [(length + 1) * distance // m for length in range(m)]

    def near(one: np.uint64, others: np.ndarray, start: int) -> np.ndarray:
        x = others ^ one
        ok, spent = np.ones(len(x), bool), np.zeros(len(x), np.uint8)
        for length in range(m):
            spent += np.bitwise_count(x & masks[(start + length) % m])
            ok &= spent <= budgets[length]
        ok[ok] = np.bitwise_count(x[ok]) <= distance
        return ok

    def forest(prints: np.ndarray, start: int, left: list, right: list) -> None:
        rest = np.unique(prints)
        while len(rest) > 1:
            front, rest = [rest[:1]], rest[1:]
            while front and len(rest):
                group = front.pop()
                for one in group:
                    if not len(rest):
                        break
                    hit = near(one, rest, start)
                    if hit.any():
                        found = rest[hit]
                        left.append(np.full(len(found), one))
                        right.append(found)
                        front.append(found)
                        rest = rest[~hit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(left: list, right: list) -> pa.RecordBatch:
            both = [np.concatenate(x).view(np.int64) if x else np.empty(0, np.int64) for x in (left, right)]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in both], ["a", "b"])

        held: tuple | None = None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
            prints = batch.column(4).to_numpy(zero_copy_only=False).view(np.uint64)
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            left, right = [], []
            ends = [0, *cuts.tolist(), len(prints)]
            for a, b in zip(ends, ends[1:], strict=False):
                if a == b:
                    continue
                key = tuple(keys[:, a].tolist())
                if held and held[0] == key:
                    held[1].append(prints[a:b])
                    continue
                if held:
                    forest(np.concatenate(held[1]), held[0][0], left, right)
                held = (key, [prints[a:b]])
            yield out(left, right)
        if held:
            left, right = [], []
            forest(np.concatenate(held[1]), held[0][0], left, right)
            yield out(left, right)

    return run


def links(prints: DataFrame, distance: int = DISTANCE, block: int = BLOCK, shape: tuple[int, int] | None = None) -> DataFrame:
    """Links (a, b) with the same components as all pairs of ``prints`` (one column of distinct longs) within ``distance``."""
    m, depth = shape or plan(prints.count(), distance)
    (name,) = prints.columns
    keys = [F.struct(F.lit(s).alias("s"), F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long").alias("k")) for s, mask in patterns(m, depth, distance)]
    rows = prints.select(F.col(name).alias("f"), F.explode(F.array(*keys)).alias("p")).select("p.s", F.col("p.k").alias("mask"), F.col("p.k").bitwiseAND(F.col("f")).alias("k"), "f")
    rows = rows.select(F.col("s"), F.xxhash64("mask", "k").alias("k"), "f")
    sizes = materialise(rows.groupBy("s", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("c", F.col("n")), "bucket-sizes")
    full = lookup(rows, sizes, ["s", "k"], "c", "inner")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("f"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("own", j).alias("lo"), F.greatest("own", j).alias("hi")))
    dealt = full.withColumn("blocks", blocks).withColumn("own", own).select("s", "k", "f", F.explode(pairs).alias("q"))
    order = ["s", "k", "lo", "hi"]
    dealt = dealt.select("s", "k", "q.lo", "q.hi", "f").repartition(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(_linker(m, distance), "a long, b long").distinct()


def members(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE, block: int = BLOCK, shape: tuple[int, int] | None = None) -> DataFrame:
    """(_doc, _t, _print, _root, _component) for each row of ``docs``; _root is the same throughout a component."""
    rows = materialise(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = materialise(rows.groupBy("_print").agg(F.min("_doc").alias("_least"), F.count(F.lit(1)).alias("_n")), "fingerprint-classes")
    found = materialise(links(classes.select("_print"), distance, block, shape), "fingerprint-links")
    roots = connected_components(found)
    rooted = classes.join(roots, classes["_print"] == roots["node"], "left").select("_print", "_least", "_n", F.coalesce("root", "_print").alias("_root"))
    rooted = materialise(rooted, "fingerprint-roots")
    least = rooted.groupBy("_root").agg(F.min("_least").alias("_component"), F.count(F.lit(1)).alias("_m"))
    named = materialise(lookup(rooted, least, ["_root"], "_m").select("_print", "_root", "_component", "_n"), "fingerprint-components")
    discard(found, classes)
    return lookup(rows, named, ["_print"], "_n")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """``docs`` with one row of each component, that with the smallest id (null ids last, then the smaller text hash)."""
    found = members(docs, id_col, text_col, distance, block)
    rank = F.struct(F.col("_doc").isNull().alias("x"), F.col("_doc").alias("d"), F.col("_t").alias("u"))
    stay = found.groupBy("_root").agg(F.min(rank).alias("_least"), F.count(F.lit(1)).alias("_n")).select(F.col("_least.d").alias("_d"), F.col("_least.u").alias("_u"))
    stay = materialise(stay, "kept-rows")
    same = F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_t") == F.col("_u"))
    left = docs.select(*numbered(docs), quoted(id_col).alias("_doc"), F.xxhash64(with_text(docs, text_col)).alias("_t"))
    kept = left.join(stay, same, "left_semi")
    back = [F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)]
    # Rows that repeat id and text are rare; one of them stays.
    repeats = materialise(found.groupBy("_doc", "_t").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("_doc").alias("_d"), F.col("_t").alias("_u")), "repeated-rows")
    if is_empty(repeats):
        return kept.select(*back)
    names = [F.col(f"_c{i}") for i in range(len(docs.columns))]
    one = kept.join(repeats, same, "left_semi").groupBy("_doc", "_t").agg(F.max(F.struct(*names)).alias("_row"))
    return kept.join(repeats, same, "left_anti").select(*back).unionByName(one.select("_row.*").select(*back))
