"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch of texts are put behind one another. A suffix array, sorted as deep as
the longest piece, indexes them; every piece's occurrences are one range of it, found by binary search. The
occurrences are the edges of the words' lattices: sorted by position they say which piece, if any, covers any run of characters. The
lattices are then relaxed. For byte-pair models, whose piece scores are merge ranks, relaxing means applying the best edge
that joins two neighbouring symbols, the leftmost of equals, until none is left, for all words at once;
that gives the library's own ids, which a best-path search over rank scores would not. Where no edge goes across a position, the two sides
have nothing to do with one another, so a word is cut there first; a long run without such a place is relaxed with a heap of its merges, in
n log n steps. Characters without a piece become byte pieces.

A word here is a run of "\\u2581" (white space) with what follows up to the next; no piece crosses its end, which is checked
when a model is loaded (otherwise a text is one word). Characters that stand in no longer piece are words of their own.

Each row is handled by itself, without a shuffle; working memory is that of BATCH_CHARS characters of distinct words, about 200 bytes each,
however long a word is, unless it has a longer run in which pieces overlap everywhere (one letter repeated): then that of twice the run. Defined
results: a null or empty text has no ids and decodes to the empty text; repeated rows give equal results; an empty table gives an empty result; other
columns are kept, and a new column whose name is taken gets an underscore in front. Decoding gives the text back except that "\\u2581" itself becomes a space, as in the library.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, numbered, quoted, with_text

SPACE = "▁"
BATCH_CHARS = 1 << 18
#: Words whose ids are kept; about 200 bytes each.
MOST_WORDS = 200_000
#: Runs of more characters are relaxed with a heap, one by one.
LONG = 256
NONE = np.float32(-np.inf)


class Model:
    """The pieces of a SentencePiece file of byte-pair kind, and what encoding and decoding need of them."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        lib = SentencePieceProcessor(model_file=path)
        n = lib.vocab_size()
        self.unknown = lib.unk_id()
        pieces = [lib.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))]
        self.bytes_id = np.full(256, self.unknown, np.int64)
        self.decoded = [b""] * n
        for i in range(n):
            if lib.is_byte(i):
                value = int(pieces[i][3:-1], 16)
                self.bytes_id[value], self.decoded[i] = i, bytes([value])
            elif lib.is_unknown(i):
                self.decoded[i] = " ⁇ ".encode()
            elif not lib.is_control(i):
                self.decoded[i] = pieces[i].replace(SPACE, " ").encode()
        plain.sort(key=lambda i: pieces[i])
        self.ids = np.array(plain, np.int64)
        self.scores = np.array([lib.get_score(i) for i in plain], np.float32)
        self.pieces = [pieces[i] for i in plain]
        self.lengths = np.array([len(x) for x in self.pieces], np.int64)
        self.depth = int(self.lengths.max(initial=1))
        self._prepare()
        crossing = any(SPACE in x.lstrip(SPACE) for x in self.pieces)
        joined = {c for x in self.pieces if len(x) > 1 for c in x}
        alone = "".join(re.escape(c) for c in "\n\r\t" if c not in joined)
        self.word = re.compile(r"(?s).+") if crossing else re.compile(rf"[{alone}]|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" if alone else rf"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.forget()

    def forget(self) -> None:
        #: Of each known word its number; word i has known[starts[i] : starts[i + 1]].
        self.number: dict[str, int] = {}
        self.known, self.starts = np.empty(0, np.int32), np.zeros(1, np.int64)

    def _prepare(self) -> None:
        """The pieces as keys, once for all texts. Codes keep the order of characters; zero is no character, the last code one that stands in no piece."""
        symbols = sorted({ord(c) for x in self.pieces for c in x})
        self.kind = np.dtype(">u2" if len(symbols) < (1 << 16) - 2 else ">u4")
        self.code_of = np.full(0x110000, len(symbols) + 1, self.kind.newbyteorder("="))
        self.code_of[symbols] = np.arange(1, len(symbols) + 1)
        inside = np.arange(self.depth)[None, :] < self.lengths[:, None]
        low = np.zeros(inside.shape, self.kind)
        low[inside] = self.code_of[np.frombuffer("".join(self.pieces).encode("utf-32-le"), np.uint32)]
        high = np.where(inside, low, np.iinfo(self.kind).max).astype(self.kind)
        self.low, self.high = self._keys(low), self._keys(high)

    def _keys(self, codes: np.ndarray) -> np.ndarray:
        """Rows of codes as byte strings, which sort alike."""
        return np.ascontiguousarray(codes).view(f"S{self.kind.itemsize * self.depth}").ravel()

    def _suffixes(self, windows: np.ndarray) -> np.ndarray:
        """The suffix array, as deep as the windows: ranks by eight bytes, then by twice as many, and so on."""
        n, covered = len(windows), 8 // self.kind.itemsize
        first = np.zeros((n, covered), self.kind)
        first[:, : self.depth] = windows[:, :covered]
        keys = first.view(">u8").ravel().astype(np.uint64)
        while True:
            suffixes = np.argsort(keys)
            if covered >= self.depth:
                return suffixes
            ordered = keys[suffixes]
            ranks = np.zeros(n + covered, np.uint64)  # zero beyond the end
            ranks[suffixes] = np.cumsum(np.append(True, ordered[1:] != ordered[:-1])[:n])
            keys, covered = ranks[:n] << np.uint64(32) | ranks[covered:], covered * 2

    def _found(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """All edges (position, piece) over the text, piece by piece."""
        codes = self.code_of[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        padded = np.zeros(len(codes) + self.depth, self.kind)
        padded[: len(codes)] = codes
        windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, self.depth)[: len(codes)])
        suffixes = self._suffixes(windows)
        keys = self._keys(windows)[suffixes]
        first = np.searchsorted(keys, self.low, "left")
        # A piece that doesn't stand where it would stand does not occur.
        inside = np.flatnonzero(first < len(keys))
        present = inside[keys[first[inside]] <= self.high[inside]]
        first = first[present]
        counts = np.searchsorted(keys, self.high[present], "right") - first
        at = suffixes[np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())]
        return at, np.repeat(present, counts)

    def occurrences(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All edges (position, length, piece), in the order of positions, over the text."""
        at, piece = self._found(text)
        order = np.argsort(at, kind="stable")
        at, piece = at[order], piece[order]
        return at, self.lengths[piece], piece

    def _edges(self, text: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """edge[position, length]: the piece, or -1, without pieces that reach beyond ``ends`` of their position; and the borders.

        Borders are the positions at which none of these pieces goes across: what stands on either side is relaxed by itself.
        """
        at, piece = self._found(text)
        length = self.lengths[piece]
        inside = at + length <= ends[at]
        at, length, piece = at[inside], length[inside], piece[inside]
        n = len(text)
        edge = np.full((n + 1, self.depth + 1), -1, np.int32)
        edge[at, length] = piece
        # A single character is over before the next position.
        across = np.bincount(at + 1, minlength=n + 1) - np.bincount(at + length, minlength=n + 1)
        return edge, np.flatnonzero(np.cumsum(across)[:n] == 0)

    def _relax(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after another, and how many each has."""
        if len(words) == 1 and len(words[0]) > BATCH_CHARS:
            return self._relax_long(words[0])
        text = "".join(words)
        sizes = np.array([len(x) for x in words], np.int64)
        starts = np.cumsum(sizes) - sizes
        ids, counts, begin = self._merge(text, *self._edges(text, np.repeat(starts + sizes, sizes)))
        owner = np.searchsorted(starts, begin, "right") - 1
        return ids, np.bincount(owner, weights=counts, minlength=len(words)).astype(np.int64)

    def _relax_long(self, word: str) -> tuple[np.ndarray, np.ndarray]:
        """One long word, from border to border in parts of about BATCH_CHARS; a part is longer only where no border is near."""
        out, start, size = [], 0, BATCH_CHARS
        while start < len(word):
            part = word[start : start + size]
            last = start + len(part) == len(word)
            edge, borders = self._edges(part, np.full(len(part), len(part)))
            if not last:
                # Pieces that begin in this part and end beyond it are not known yet.
                known = borders[borders <= len(part) - self.depth + 1]
                if len(known) < 2:
                    size *= 2
                    continue
                part, borders = part[: known[-1]], known[:-1]
            out.append(self._merge(part, edge[: len(part) + 1], borders)[0])
            start, size = start + len(part), BATCH_CHARS
        ids = np.concatenate(out)
        return ids, np.array([len(ids)], np.int64)

    def _merge(self, text: str, edge: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of a text whose runs from ``starts`` on are relaxed apart; how many each symbol has, and where the symbols begin."""
        n = len(text)
        sizes = np.diff(np.append(starts, n))
        ends = np.repeat(starts + sizes, sizes)
        after = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        score = np.full(n, NONE, np.float32)

        def rate(i: np.ndarray) -> None:
            """Score the merge of the symbols at i with their right neighbours."""
            middle = after[i]
            value = np.full(len(i), NONE, np.float32)
            ok = middle < ends[i]
            j = i[ok]
            size = after[middle[ok]] - j
            fits = size <= self.depth
            found = edge[j[fits], size[fits]]
            inner = np.where(found >= 0, self.scores[found], NONE)
            part = np.full(len(j), NONE, np.float32)
            part[fits] = inner
            value[ok] = part
            score[i] = value

        rate(np.arange(n))
        for k in np.flatnonzero(sizes > LONG).tolist():
            a, b = int(starts[k]), int(starts[k] + sizes[k])
            after[a:b] = self._merge_one(edge[a:b], score[a:b]) + a
            after[a:b][after[a:b] < a] = -1
        live = np.flatnonzero((sizes > 1) & (sizes <= LONG))
        while len(live):
            # The positions of the live runs, one after another.
            count = sizes[live]
            offsets = np.cumsum(count) - count
            flat = np.repeat(starts[live] - offsets, count) + np.arange(count.sum())
            values = score[flat]
            best = np.maximum.reduceat(values, offsets)
            going = best > NONE
            hit = np.flatnonzero(values == np.repeat(best, count))
            leftmost = hit[np.searchsorted(hit, offsets[going])]
            live = live[going]
            i = flat[leftmost]
            gone = after[i]
            after[i] = after[gone]
            score[gone] = NONE
            following = after[i] < ends[i]
            before[after[i[following]]] = i[following]
            rate(i)
            previous = before[i]
            previous = previous[(i > starts[live])]
            if len(previous):
                rate(previous)
            after[gone] = -1
        begin = np.flatnonzero(after >= 0)
        piece = edge[begin, after[begin] - begin]
        ids = np.where(piece >= 0, self.ids[piece], -1)
        counts = np.ones(len(begin), np.int64)
        missing = np.flatnonzero(ids < 0)
        spelled = [self.bytes_id[list(text[b].encode("utf-8", "surrogatepass"))] for b in begin[missing].tolist()]
        counts[missing] = [len(x) for x in spelled]
        offsets = np.cumsum(counts) - counts
        flat = np.repeat(ids, counts)
        for at, x in zip(offsets[missing].tolist(), spelled, strict=True):
            flat[at : at + len(x)] = x
        return flat.astype(np.int32), counts, begin

    def _merge_one(self, edge: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Of one long run the next symbol after each, below zero for positions that begin none: merges wait in a heap, the best and of equals the leftmost first."""
        n, width = len(edge), edge.shape[1]
        flat, scores = array("i", np.ascontiguousarray(edge).tobytes()), array("f", self.scores.tobytes())
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = np.flatnonzero(score > NONE)
        heap = list(zip((-score[first]).tolist(), first.tolist(), (first + 2).tolist(), strict=True))
        heapify(heap)
        while heap:
            _, i, end = heappop(heap)
            middle = after[i]
            if middle < 0 or middle >= n or after[middle] != end:
                continue  # one of the two has been merged since
            after[i], after[middle] = end, -n - 1
            if end < n:
                before[end] = i
                to = after[end]
                if to - i < width and (p := flat[i * width + to - i]) >= 0:
                    heappush(heap, (-scores[p], i, to))
            j = before[i]
            if j >= 0 and end - j < width and (p := flat[j * width + end - j]) >= 0:
                heappush(heap, (-scores[p], j, end))
        return np.array(after, np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        flat, offsets = self.encode_flat(texts)
        return np.split(flat, offsets[1:-1]) if texts else []

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and the offsets of the texts."""
        rows = [self.word.findall(SPACE + x.replace(" ", SPACE)) if x else [] for x in texts]
        if len(self.number) > MOST_WORDS:
            self.forget()
        new = list(set(chain.from_iterable(rows)).difference(self.number))
        at = 0
        while at < len(new):
            to, total = at, 0
            while to < len(new) and (to == at or total + len(new[to]) <= BATCH_CHARS):
                total += len(new[to])
                to += 1
            group = new[at:to]
            ids, sizes = self._relax(group)
            self.number.update(zip(group, range(len(self.starts) - 1, len(self.starts) - 1 + len(group)), strict=True))
            self.starts = np.concatenate([self.starts, len(self.known) + np.cumsum(sizes)])
            self.known = np.concatenate([self.known, ids])
            at = to
        n = sum(map(len, rows))
        numbers = np.fromiter(map(self.number.__getitem__, chain.from_iterable(rows)), np.int64, n)
        starts = self.starts[numbers]
        sizes = self.starts[numbers + 1] - starts
        before = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.known[np.repeat(starts - before[:-1], sizes) + np.arange(before[-1])]
        return ids, before[np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int64)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        return _text(b"".join(map(self.decoded.__getitem__, ids)))

    def decode_lists(self, lists: pa.ListArray) -> list[str]:
        """The texts of lists of ids: the pieces of all lists are taken at once and lie behind one another."""
        lists = lists.fill_null([]) if lists.null_count else lists
        taken = pa.array(self.decoded, pa.large_binary()).take(lists.flatten())
        ends = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
        data = taken.buffers()[2].to_pybytes() if len(taken) and taken.buffers()[2] else b""
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        cuts = ends[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)].tolist()
        return [_text(data[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _text(data: bytes) -> str:
    text = data.decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


@cache
def model(path: str) -> Model:
    """One for each Python worker."""
    return Model(path)


def _run(path: str, at: int, decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            for low in range(0, len(batch), 512):
                part = batch.slice(low, 512)
                columns = list(part.columns)
                if decode:
                    columns[at] = pa.array(own.decode_lists(columns[at]), pa.string())
                else:
                    ids, offsets = own.encode_flat([x or "" for x in columns[at].to_pylist()])
                    columns[at] = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return run


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with an array of piece ids beside the text."""
    (name,) = fresh(docs, ids_col)
    rows = docs.select(*numbered(docs), with_text(docs, text_col).alias("_ids"))
    schema = ", ".join([*[f"`{c}` {t}" for c, t in rows.dtypes if c != "_ids"], "_ids array<int>"])
    out = rows.mapInArrow(_run(path, len(rows.columns) - 1, False), schema)
    return out.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)], F.col("_ids").alias(name))


def decode(rows: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of an array of piece ids."""
    (name,) = fresh(rows, text_col)
    inner = rows.select(*numbered(rows), quoted(ids_col).alias("_ids"))
    schema = ", ".join([*[f"`{c}` {t}" for c, t in inner.dtypes if c != "_ids"], "_ids string"])
    out = inner.mapInArrow(_run(path, len(inner.columns) - 1, True), schema)
    return out.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(rows.columns)], F.col("_ids").alias(name))
