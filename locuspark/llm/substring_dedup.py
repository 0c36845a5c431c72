"""Removal of long word sequences that occur more than once.

A window is ``window`` consecutive words. A word goes if a window that covers it
also starts anywhere else in the input, in the same document or another one.

The method is a compacted de Bruijn graph over tokens. Its edges are the windows (k-mers of ``window`` words); the
edge after a window is the window one word on. Only edges that occur twice or more matter, so the
graph is built over repeated edges alone, and in the compressed form that large assemblies use:

1. Seeds. Every window selects one of its shorter k-mers (``kmer`` words), the one with the least hash, so equal windows
   select equal k-mers at the same offset. A run of windows of one document that selects the same k-mer is a
   super-k-mer: about 8 rows per 100 words. Super-k-mers are dealt by their k-mer; a k-mer with one source has no repeated window.
2. Edges. A k-mer whose sources all have the same super-k-mer holds one path of edges, compact already. Where sources
   differ, the graph may branch there: one document of each different super-k-mer is visited, its windows are counted one by one, and
   runs of windows that occur in the same super-k-mers are edges. Windows that occur once are dropped.
3. Compaction. Of each edge the successors and predecessors over all its sources are counted, the end of a repeated
   passage being a neighbour like any other. Two edges are one path if each is the other's only neighbour on that side; joined
   back to the sources, this cuts each document's run of repeated edges into nonbranching paths. A path's first edge names it, and
   every source of it has coordinates: document, first and last word.
4. Verification. The documents are visited at these coordinates. All sources of a path must have the same words, compared
   as text, not by a hash. Where that fails (hashes collided) all windows of the k-mers involved are compared one by one, again as text.
   So a collision costs time and never a word.

Equal words have equal hashes, so nothing is missed; hashes only propose. Counting is by map-side sums; a
k-mer or edge that holds a large share of all sources is looked up by broadcast (``common.lookup``). No pairs of sources are made. The text is
shuffled twice: to the documents that have a repeated k-mer, which are written once and visited there, and for the cut.

Defined results: a null text has no words; texts shorter than a window stay as they are; a very long text is hashed in pieces of
about a megabyte and one task visits it as a whole;
rows that repeat a doc_id are documents of their own, and a repeated row repeats
all windows of its text; a null doc_id is an id; an empty table gives an empty result; other
columns are kept, and where ``n_words`` or ``n_removed`` is taken the new column gets an underscore in front. White space between words that stay is not touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, discard, fresh, is_empty, lookup, materialise, numbered, quoted, renumbered, with_text

WINDOW = 35
#: Words of a k-mer; a window has WINDOW - KMER + 1 of them to select from.
KMER = 12
#: Bytes of text hashed at once, and words of a document looked at together.
PIECE = 1 << 20
CHUNK = 1 << 18
#: Words of more bytes are hashed one by one.
LONG_WORD = 64

_U = np.uint64
_SOLID = np.ones(256, bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False
#: Of a word's last eight bytes those that belong to it, by how many these are.
_TAIL = np.array([(1 << (8 * i)) - 1 for i in range(9)], _U)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of two parts from theirs. It is no polynomial, so no pattern of words makes it small."""
    return _mix(left * _U(0x9E3779B97F4A7C15) + _mix(right ^ _U(0xD6E8FEB86659FD93)))


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word data[start:end], eight bytes at a time for all words together."""
    if not len(starts):
        return np.empty(0, _U)
    low = int(starts[0])
    eights = np.frombuffer(data[low : ends[-1]] + bytes(8), np.uint8)
    eights = np.lib.stride_tricks.sliding_window_view(eights, 8)
    sizes = ends - starts
    out = _mix(sizes.astype(_U) + _U(0x632BE59BD9B4E019))
    live, at = np.arange(len(starts)), 0
    while True:
        live = live[sizes[live] > at]
        if not len(live) or at >= LONG_WORD:
            break
        left = np.minimum(sizes[live] - at, 8)
        chunk = np.ascontiguousarray(eights[starts[live] + (at - low)]).view("<u8").ravel() & _TAIL[left]
        out[live] = _join(out[live], chunk)
        at += 8
    for i in live.tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]], 7)
    return out


class Words:
    """Words of one or several texts: where they start and end in ``data``, and hashes of any run of them.

    Hashes are of contents alone, so equal runs have equal hashes wherever they are. Runs are hashed as a tree: level j
    has the hash of every 2**j consecutive words. ``bits`` below 64 makes collisions likely; tests use it.
    """

    def __init__(self, texts: list[bytes], bits: int = 64):
        self.data = b"\n" + b"\n".join(texts) + b"\n"
        raw = np.frombuffer(self.data, np.uint8)
        solid = _SOLID[raw]
        edges = np.flatnonzero(solid[1:] != solid[:-1]) + 1
        self.starts, self.ends = edges[0::2], edges[1::2]
        begins = np.cumsum([1, *[len(x) + 1 for x in texts]])
        self.first = np.searchsorted(self.starts, begins)  # of each text, the first word; one more at the end
        self.mask = _U((1 << bits) - 1)
        self._levels: list[np.ndarray] = []

    def part(self, a: int, b: int) -> Words:
        """The words [a, b) alone, with hashes of their own, which take eight bytes a word and level."""
        out = object.__new__(Words)
        out.data, out.mask, out._levels = self.data, self.mask, []
        out.starts, out.ends, out.first = self.starts[a:b], self.ends[a:b], np.array([0, b - a])
        return out

    def level(self, j: int) -> np.ndarray:
        """Hashes of the runs of 2**j words from each word on; those that reach beyond the last word are of no use."""
        if not self._levels:
            self._levels = [word_hashes(self.data, self.starts, self.ends)]
        while len(self._levels) <= j:
            last, step = self._levels[-1], 1 << (len(self._levels) - 1)
            self._levels.append(_join(last[: max(len(last) - step, 0)], last[step:]))
        return self._levels[j]

    def runs(self, a: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """Hashes of the runs of ``size`` words from ``a`` on."""
        size = np.broadcast_to(np.asarray(size), a.shape)
        out, at = size.astype(_U), a.copy()
        for j in range(int(size.max(initial=0)).bit_length()):
            on = (size >> j) & 1 > 0
            if on.all():
                out, at = _join(out, self.level(j)[at]), at + (1 << j)
            elif on.any():
                out[on] = _join(out[on], self.level(j)[at[on]])
                at = at + np.where(on, 1 << j, 0)
        return out & self.mask

    def text(self, a: int, b: int) -> bytes:
        """The words [a, b), joined by one space."""
        return b" ".join(self.data[self.starts[a] : self.ends[b - 1]].split())


def select_seeds(words: Words, window: int, kmer: int) -> tuple[np.ndarray, np.ndarray]:
    """(the word at which the k-mer starts that a window selects, for each window; the hashes of all k-mers)."""
    choices = window - kmer + 1
    kmers = words.runs(np.arange(len(words.starts) - kmer + 1), kmer)
    best, covered = np.arange(len(kmers)), 1
    while covered * 2 <= choices:
        a, b = best[:-covered], best[covered:]
        best, covered = np.where(kmers[a] <= kmers[b], a, b), covered * 2
    if covered < choices:
        a, b = best[: covered - choices], best[choices - covered :]
        best = np.where(kmers[a] <= kmers[b], a, b)
    return best, kmers


def _super_kmers(words: Words, window: int, kmer: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, first window, windows, hash of the k-mer, hash of the whole) of each super-k-mer; windows are counted within their text."""
    n = len(words.starts)
    text_of = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    for low in range(0, max(n - window + 1, 0), CHUNK):
        high = min(low + CHUNK, n - window + 1)
        here = words.part(low, high + window - 1)
        chosen, kmers = select_seeds(here, window, kmer)
        at = np.arange(high - low)
        valid = text_of[at + low] == text_of[at + low + window - 1]
        at, chosen = at[valid], chosen[valid]
        if not len(at):
            continue
        cut = np.flatnonzero((chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)) + 1
        first, last = at[np.concatenate([[0], cut])], at[np.concatenate([cut - 1, [len(at) - 1]])]
        word, text = chosen[np.concatenate([[0], cut])], text_of[first + low]
        whole = _join(here.runs(first, last - first + window), (word - first).astype(_U)) & words.mask
        yield text, first + low - words.first[text], last - first + 1, kmers[word], whole


def _groups(sizes: list[int], most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of texts with about ``most`` bytes together."""
    a = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield a, i
            a, total = i, 0
        total += size + 1
    if a < len(sizes):
        yield a, len(sizes)


def _binary(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary()).to_pylist()


def _seeds(window: int, kmer: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _binary(batch.column(2))
            for a, b in _groups(list(map(len, texts))):
                for text, first, count, seed, whole in _super_kmers(Words(texts[a:b], bits), window, kmer):
                    take = pa.array(text + a)
                    longs = [pa.array(x.view(np.int64)) for x in (seed, whole)]
                    ints = [pa.array(x.astype(np.int32)) for x in (first, count)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), *longs, *ints], ["_doc", "_t", "_p", "_q", "_a", "_m"])

    return run


def _spans(column: pa.Array, i: int) -> list[np.ndarray]:
    """The fields of the structs of a row's list."""
    rows = column[i].values
    return [rows.field(j).to_numpy(zero_copy_only=False) for j in range(rows.type.num_fields)]


def _windows(window: int, bits: int):
    """Every window of the given super-k-mers (k-mer, whole, sources, first, count) of each text, with its place in the super-k-mer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(_binary(batch.column(2))):
                words = Words([text], bits)
                seed, whole, n, first, count = _spans(batch.column(3), i)
                count = count.astype(np.int64)
                place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                edge = words.runs(np.repeat(first, count) + place, window).view(np.int64)
                columns = [*(np.repeat(x, count) for x in (seed, whole, count.astype(np.int32), n)), place.astype(np.int32), edge]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["_p", "_q", "_m", "_n", "_o", "_h"])

    return run


def _texts(each: int | None):
    """The words of the given spans (path, a, b) of each text; with ``each``, those of every run of so many words in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.large_binary()]
        for batch in batches:
            for i, text in enumerate(_binary(batch.column(2))):
                words = Words([text])
                p, q, a, b = (x.tolist() for x in _spans(batch.column(3), i))
                rows: list[tuple] = []
                size = 0
                for p0, q0, a0, b0 in zip(p, q, a, b, strict=True):
                    for at in [a0] if each is None else range(a0, b0 - each + 1):
                        rows.append((p0, q0, at, words.text(at, b0 if each is None else at + each)))
                        size += len(rows[-1][3])
                        if size > 4 * PIECE:
                            yield _rows(batch, i, rows, kinds)
                            rows, size = [], 0
                yield _rows(batch, i, rows, kinds)

    return run


def _rows(batch: pa.RecordBatch, i: int, rows: list[tuple], kinds: list[pa.DataType]) -> pa.RecordBatch:
    take = pa.array(np.full(len(rows), i, np.int64))
    columns = [pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)]
    columns[3] = columns[3].cast(pa.large_string()).cast(pa.string())
    return pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), *columns], ["_doc", "_t", "_p", "_q", "_a", "_words"])


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The text without the words of the spans [a, b), and how many words went."""
    words = Words([text])
    n = len(words.starts)
    depth = np.zeros(n + 1, np.int64)
    for a, b in spans:
        depth[a] += 1
        depth[b] -= 1
    gone = np.cumsum(depth)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    places = np.append(words.starts, len(words.data) - 1)
    out, at = [], 1
    for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True):
        out.append(words.data[at : places[a]])
        at = int(places[b])
    out.append(words.data[at:-1])
    return b"".join(out), int(gone.sum())


def _cut(text_at: int, spans_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = [], []
            spans = batch.column(spans_at)
            for i, text in enumerate(_binary(batch.column(text_at))):
                n = 0
                if spans[i].is_valid:
                    rows = spans[i].values
                    text, n = cut_words(text, list(zip(rows.field(0).to_pylist(), rows.field(1).to_pylist(), strict=True)))
                texts.append(text)
                gone.append(n)
            columns = list(batch.columns)
            columns[text_at] = pa.array(texts, pa.large_binary()).cast(pa.large_string()).cast(batch.schema.field(text_at).type)
            columns[spans_at] = pa.array(gone, pa.int64())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:spans_at] + ["_gone"])

    return run


def _same() -> Column:
    return F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_t") == F.col("_u"))


def _visits(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """The texts of the documents in ``asked`` (_doc, _t, _ask), each with the set of what is asked of it."""
    per_doc = asked.groupBy(F.col("_doc").alias("_d"), F.col("_t").alias("_u")).agg(F.collect_set("_ask").alias("_asks"))
    return texts.join(per_doc, _same()).select("_doc", "_t", "_text", "_asks")


def compact(edges: DataFrame) -> DataFrame:
    """Nonbranching paths of repeated edges.

    edges: (_doc, _t, _p, _q, _a, _m), one row for each source of an edge (_p, _q): ``_m`` windows from window ``_a`` on. Returns
    (_doc, _t, _p, _q, _a, _e) for each source of a path: the edge that it starts with, and its windows [_a, _e).
    """
    in_doc = Window.partitionBy("_doc", "_t").orderBy("_a")
    follows = F.lead("_a").over(in_doc) == F.col("_a") + F.col("_m")
    led = F.lag(F.col("_a") + F.col("_m")).over(in_doc) == F.col("_a")
    around = edges.select(
        "*",
        *[F.when(follows, F.lead(c).over(in_doc)).alias(f"_next{c}") for c in ("_p", "_q")],
        *[F.when(led, F.lag(c).over(in_doc)).alias(f"_last{c}") for c in ("_p", "_q")],
    )

    def only(side: str) -> Column:
        """Whether all sources have the same neighbour on one side; none is a neighbour like any other."""
        return (F.count(f"{side}_p") == F.count(F.lit(1))) & (F.min(f"{side}_p") == F.max(f"{side}_p")) & (F.min(f"{side}_q") == F.max(f"{side}_q"))

    sides = around.groupBy("_p", "_q").agg(F.count(F.lit(1)).alias("_n"), F.coalesce(only("_next"), F.lit(False)).alias("_out"), F.coalesce(only("_last"), F.lit(False)).alias("_in"))
    known = lookup(edges, materialise(sides, "edge-sides"), ["_p", "_q"], "_n")
    goes_on = F.col("_in") & F.lag("_out").over(in_doc) & led
    marked = known.withColumn("_new", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1))
    numbered_paths = marked.withColumn("_path", F.sum("_new").over(in_doc))
    first = F.min(F.struct("_a", "_p", "_q")).alias("_first")
    paths = numbered_paths.groupBy("_doc", "_t", "_path").agg(first, F.max(F.col("_a") + F.col("_m")).alias("_e"))
    return paths.select("_doc", "_t", F.col("_first._p").alias("_p"), F.col("_first._q").alias("_q"), F.col("_first._a").alias("_a"), "_e")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, kmer: int = KMER, bits: int = 64) -> DataFrame:
    """(_doc, _t, _spans) for each document with repeated windows: the runs of words [a, b) that they cover. _t is a hash of the text, which tells rows of one id apart."""
    rows = docs.select(quoted(id_col).alias("_doc"), F.xxhash64(with_text(docs, text_col)).alias("_t"), with_text(docs, text_col).alias("_text"))
    kind = dict(rows.dtypes)["_doc"]
    edge = f"_doc {kind}, _t long, _p long, _q long, _a int, _m int"
    # 1. Seeds, and of these the k-mers with two sources or more.
    seeds = materialise(rows.mapInArrow(_seeds(window, kmer, bits), edge), "seeds")
    repeated = seeds.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), (F.min("_q") != F.max("_q")).alias("_branches")).where("_n > 1")
    repeated = materialise(repeated, "repeated-seeds")
    sources = materialise(lookup(seeds, repeated, ["_p"], "_n", "inner"), "sources")
    discard(seeds, repeated)
    held = sources.select(F.col("_doc").alias("_d"), F.col("_t").alias("_u")).distinct()
    texts = materialise(rows.join(held, _same(), "left_semi"), "texts-with-repeats")
    # 2. Repeated edges: whole super-k-mers, or what such share where they differ.
    # The columns of a super-k-mer's edge are the other way round, so that it is no window's.
    whole = sources.where("not _branches").select("_doc", "_t", F.col("_q").alias("_p"), F.col("_p").alias("_q"), "_a", "_m")
    edges = whole.unionByName(_shared_parts(texts, sources.where("_branches"), window, bits))
    # Rows that repeat a document have the same sources.
    edges = materialise(edges.dropDuplicates(["_doc", "_t", "_a"]), "repeated-edges")
    # 3. Paths, with the coordinates of their sources in words.
    paths = compact(edges).select("_doc", "_t", "_p", "_q", "_a", (F.col("_e") + F.lit(window - 1)).cast("int").alias("_b"))
    paths = materialise(paths, "paths")
    # 4. The same words at all sources.
    found = f"_doc {kind}, _t long, _p long, _q long, _a int, _words string"
    ask = paths.select("_doc", "_t", F.struct("_p", "_q", "_a", "_b").alias("_ask"))
    seen = _visits(texts, ask).mapInArrow(_texts(None), found).groupBy("_p", "_q", "_words").agg(F.count(F.lit(1)).alias("_n"))
    sure = (F.count(F.lit(1)) == 1) & (F.sum("_n") > 1)
    mixed = materialise(seen.groupBy("_p", "_q").agg(sure.alias("_sure")).where("not _sure").select("_p", "_q"), "mixed-paths")
    spans = paths.select("_doc", "_t", "_p", "_q", F.struct(F.col("_a").alias("a"), F.col("_b").alias("b")).alias("_span"))
    if not is_empty(mixed):
        # Equal windows have equal seeds, so all windows of these seeds decide the matter.
        bad = paths.join(mixed, ["_p", "_q"], "left_semi").select(F.col("_doc").alias("_d"), F.col("_t").alias("_u"), F.col("_a").alias("_low"), F.col("_b").alias("_high"))
        touched = edges.join(bad, _same() & F.col("_a").between(F.col("_low"), F.col("_high")), "left_semi")
        # Either column may be the seed; one too many does no harm.
        seeds = touched.select(F.explode(F.array("_p", "_q")).alias("_p")).distinct()
        doubtful = sources.join(seeds, "_p", "left_semi").select("_doc", "_t", F.struct("_p", "_q", "_a", (F.col("_a") + F.col("_m") + F.lit(window - 1)).alias("_b")).alias("_ask"))
        each = materialise(_visits(texts, doubtful).mapInArrow(_texts(window), found), "doubtful-windows")
        twice = materialise(each.groupBy("_words").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").withColumn("_on", F.lit(True)), "sure-windows")
        sure = lookup(each, twice, ["_words"], "_n", "inner")
        sure = sure.select("_doc", "_t", "_p", "_q", F.struct(F.col("_a").alias("a"), (F.col("_a") + F.lit(window)).alias("b")).alias("_span"))
        spans = spans.join(mixed, ["_p", "_q"], "left_anti").select(*sure.columns).unionByName(sure)
    out = materialise(spans.groupBy("_doc", "_t").agg(F.collect_set("_span").alias("_spans")), "repeated-spans")
    discard(sources, edges, paths, texts)
    return out


def _shared_parts(texts: DataFrame, sources: DataFrame, window: int, bits: int) -> DataFrame:
    """Of super-k-mers that differ though their k-mer is the same, the runs of windows that occur twice or more, as edges at all sources.

    Of equal super-k-mers one source is visited. What two of one k-mer share is one run of windows, so the windows of a super-k-mer
    fall into runs, each shared with the same set of others; a run is an edge, named by its first window.
    """
    # Equal ones have as many windows, which keeps edges apart even where hashes collide.
    wholes = sources.groupBy("_p", "_q", "_m").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("_doc", "_t", "_a")).alias("_one"))
    wholes = materialise(wholes, "differing-super-k-mers")
    ask = wholes.select(F.col("_one._doc").alias("_doc"), F.col("_one._t").alias("_t"), F.struct("_p", "_q", "_n", F.col("_one._a").alias("_a"), "_m").alias("_ask"))
    single = materialise(_visits(texts, ask).mapInArrow(_windows(window, bits), "_p long, _q long, _m int, _n long, _o int, _h long"), "single-windows")
    # A set of super-k-mers is told by the sum of their hashes.
    shared = single.groupBy("_p", "_h").agg(F.sum("_n").alias("_all"), F.sum(F.xxhash64("_q").cast("decimal(38,0)")).cast("string").alias("_set"), F.count(F.lit(1)).alias("_c"))
    shared = materialise(shared.where("_all > 1").select("_p", "_h", F.xxhash64("_set").alias("_set"), "_c"), "shared-windows")
    known = lookup(single, shared, ["_p", "_h"], "_c", "inner").repartition("_p", "_q").dropDuplicates(["_p", "_q", "_m", "_o"])
    inside = Window.partitionBy("_p", "_q", "_m").orderBy("_o")
    goes_on = (F.lag("_o").over(inside) == F.col("_o") - 1) & (F.lag("_set").over(inside) == F.col("_set"))
    runs = known.withColumn("_new", F.when(goes_on, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(inside))
    runs = runs.groupBy("_p", "_q", "_m", "_run").agg(F.min(F.struct("_o", "_h")).alias("_first"), F.count(F.lit(1)).cast("int").alias("_size"), F.max("_n").alias("_n"))
    runs = runs.groupBy("_p", "_q", "_m").agg(F.max("_n").alias("_n"), F.collect_list(F.struct("_first._o", "_first._h", "_size")).alias("_runs"))
    at = lookup(sources.select("_doc", "_t", "_p", "_q", "_a", "_m"), materialise(runs, "shared-runs"), ["_p", "_q", "_m"], "_n", "inner")
    at = at.select("_doc", "_t", "_p", "_a", F.explode("_runs").alias("_r"))
    return at.select("_doc", "_t", "_p", F.col("_r._h").alias("_q"), (F.col("_a") + F.col("_r._o")).alias("_a"), F.col("_r._size").alias("_m"))


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, kmer: int = KMER, bits: int = 64) -> DataFrame:
    """``docs`` with the text that stays, ``n_words`` (before) and ``n_removed``."""
    spans = repeated_spans(docs, id_col, text_col, window, kmer, bits)
    n_words, n_removed = fresh(docs, "n_words", "n_removed")
    text = with_text(docs, text_col)
    left = docs.select(*numbered(docs, text_col), quoted(id_col).alias("_doc"), F.xxhash64(text).alias("_t"), text.alias("_text"))
    both = left.join(spans.select(F.col("_doc").alias("_d"), F.col("_t").alias("_u"), "_spans"), _same(), "left")
    own = [c for c in left.columns if c not in ("_doc", "_t", "_text")]
    both = both.select(*own, F.regexp_count("_text", F.lit(WORD)).cast("long").alias("_n"), "_text", "_spans")
    schema = ", ".join([*[f"`{c}` {t}" for c, t in both.dtypes if c != "_spans"], "_gone long"])
    at = len(both.columns) - 2
    cut = both.mapInArrow(_cut(at, at + 1), schema)
    return cut.select(*renumbered(docs, text_col, F.col("_text")), F.col("_n").alias(n_words), F.col("_gone").alias(n_removed))
