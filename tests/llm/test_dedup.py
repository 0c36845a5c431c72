"""Exact, line, near and substring deduplication against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from locuspark.llm import simhash
from locuspark.llm.components import connected_components
from locuspark.llm.exact_dedup import exact_duplicates
from locuspark.llm.line_dedup import dedup_lines
from locuspark.llm.simhash import near_duplicates
from locuspark.llm.substring_dedup import dedup_substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
least = lambda x: (x is not None, x)


def taken(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


@pytest.mark.parametrize(("block", "bits"), [(4096, 64), (16, 64), (64, 3), (16, 0)])
def test_exact(odd, block, bits):
    """Small blocks make many levels; few hash bits make every lookup ambiguous."""
    groups = defaultdict(list)
    for d, t in taken(odd):
        groups[t or ""].append(d)
    want = Counter()
    for t, ids in groups.items():
        top = max(ids, key=least)
        for i, d in enumerate(sorted(ids, key=least, reverse=True)):
            want[(d, top, len(ids), i == 0, sha(t))] += 1
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_duplicates(odd, block_bytes=block, hash_bits=bits).collect())
    assert got == want


def test_exact_of_nothing(none):
    assert exact_duplicates(none).count() == 0


def test_lines(odd):
    strip = " \t\n\x0b\x0c\r"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = taken(odd)
    holders = defaultdict(set)
    key = lambda x: x.strip(strip).translate(lower)
    for d, t in docs:
        for x in (t or "").split("\n"):
            holders[key(x)].add(d)
    want = Counter()
    for d, t in docs:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(key(x)) < 40 or len(holders[key(x)]) < 5 or max(holders[key(x)], key=least) == d]
        want[(d, "\n".join(keep), len(lines), len(lines) - len(keep))] += 1
    out = dedup_lines(odd)
    assert out.columns == [*odd.columns, "_n_lines", "n_dropped"]
    assert Counter((r.doc_id, r.text, r._n_lines, r.n_dropped) for r in out.collect()) == want
    assert sum(x[3] for x in want) > 10


def test_lines_of_nothing(none):
    assert dedup_lines(none).count() == 0


def slow_print(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    pieces = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, distance):
    todo, out = set(prints), {}
    while todo:
        front = [todo.pop()]
        group = []
        while front:
            x = front.pop()
            group.append(x)
            near = {y for y in todo if (x ^ y).bit_count() <= distance}
            todo -= near
            front += near
        out |= dict.fromkeys(group, min(group))
    return out


def test_simhash(odd):
    docs = [(d, slow_print(t)) for d, t in taken(odd)]
    root = slow_components([p for _, p in docs], 4)
    smallest = defaultdict(lambda: None)
    for d, p in docs:
        if d is not None and (smallest[root[p]] is None or d < smallest[root[p]]):
            smallest[root[p]] = d
    got = Counter((r._doc, r._print % (1 << 64), r._component) for r in simhash.members(odd).collect())
    assert got == Counter((d, p, smallest[root[p]]) for d, p in docs)
    assert len(set(root.values())) < len(root)
    kept = near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(x for x in smallest.values() if x is not None)


@pytest.mark.parametrize("shape", [(5, 1), (6, 4), (8, 8), (7, 5), (16, 16)])
@pytest.mark.parametrize("block", [5, 20_000])
def test_links_of_dense_clusters(spark, shape, block):
    """Clusters around few centres, in which most pairs are close; small blocks deal hot buckets out."""
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    prints = {int(c) for c in centres}
    for c in centres.tolist():
        for _ in range(25):
            x = c
            for b in rng.integers(0, 64, rng.integers(1, 9)).tolist():
                x ^= 1 << b
            prints.add(x)
    prints |= {0, (1 << 64) - 1, 15, 1 << 63}
    want = slow_components(prints, 4)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    edges = simhash.links(spark.createDataFrame(signed, "p long"), 4, block, shape)
    parts = {r.node % (1 << 64): r.root % (1 << 64) for r in connected_components(edges).collect()}
    groups = lambda f: {frozenset(g) for g in _inverse({x: f(x) for x in prints}).values()}
    assert groups(lambda x: parts.get(x, x)) == groups(want.get)


def _inverse(of):
    out = defaultdict(set)
    for x, y in of.items():
        out[y].add(x)
    return out


def test_every_close_pair_has_a_pattern():
    """The chain condition and the patterns of equal segments hold for some start, whatever bits differ."""
    rng = np.random.default_rng(2)
    for m, depth in ((5, 1), (6, 4), (8, 8), (16, 12)):
        ps = simhash.patterns(m, depth, 4)
        for _ in range(400):
            x = 0
            for b in rng.integers(0, 64, 4).tolist():
                x |= 1 << b
            assert any(not x & mask for _, mask in ps)


def test_plan_grows_with_the_input():
    widths = [64 // m * (d - d * 4 // m) for m, d in (simhash.plan(n, 4) for n in (10, 10**5, 10**7, 10**9))]
    assert widths == sorted(widths) and widths[-1] >= 31


def test_long_chains_become_one_component(spark):
    pairs = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    more = spark.createDataFrame([(1000, 1001), (1001, 1000), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in connected_components(pairs.unionByName(more)).collect()}
    assert got == dict.fromkeys(range(1, 301), 0) | {1001: 1000}


def test_simhash_of_nothing(none):
    assert simhash.members(none).count() == 0
    assert near_duplicates(none).count() == 0


def slow_substrings(docs, window):
    """docs: (id, text). Counts of (id, words that stay, words, words that go)."""
    split = [(d, WORD.findall(t or "")) for d, t in docs]
    seen = Counter(tuple(w[i : i + window]) for _, w in split for i in range(len(w) - window + 1))
    want = Counter()
    for d, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        want[(d, " ".join(x for i, x in enumerate(w) if i not in gone), len(w), len(gone))] += 1
    return want


def fast_substrings(df, **options):
    return Counter((r.doc_id, " ".join(WORD.findall(r.text)), r.n_words, r.n_removed) for r in dedup_substrings(df, **options).collect())


@pytest.mark.parametrize(("window", "kmer", "bits"), [(35, 12, 64), (5, 2, 64), (8, 8, 64), (12, 5, 9)])
def test_substrings(odd, window, kmer, bits):
    """With few bits hashes collide all the time, and words alone tell what repeats."""
    docs = taken(odd)
    want = slow_substrings(docs, window)
    assert fast_substrings(odd, window=window, kmer=kmer, bits=bits) == want
    assert sum(x[3] for x in want) > 100
    # A text that loses nothing stays as it is, blanks included.
    texts = Counter((d, t or "") for d, t in docs)
    assert all(texts[(r.doc_id, r.text)] for r in dedup_substrings(odd, window=window, kmer=kmer).collect() if not r.n_removed)


def test_words_that_defeat_polynomial_hashes(spark):
    """Thue-Morse strings and their complements have equal hashes modulo 2**64 whatever the base."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    side = " ".join(f"w{i}" for i in range(17))
    words = ["x", "y"]
    while len(words) < 64:
        words += [{"x": "y", "y": "x"}[w] for w in words]
    swapped = [{"x": "y", "y": "x"}[w] for w in words]
    docs = [(1, f"{side} {word} {side}"), (2, f"{side} {other} {side}"), (3, " ".join(words)), (4, " ".join(swapped)), (5, f"{side} {word} {side} end")]
    got = fast_substrings(spark.createDataFrame(docs, "doc_id long, text string"))
    assert got == slow_substrings(docs, 35)
    assert {x[0]: x[3] for x in got} == {1: 35, 2: 0, 3: 0, 4: 0, 5: 35}


@pytest.mark.parametrize("bits", [64, 7])
def test_substrings_on_random_graphs(spark, bits):
    """Few words make graphs with branches, loops and repeats within a document; copies make long paths."""
    rng = np.random.default_rng(bits)
    for vocabulary in (2, 30):
        text = lambda n: " ".join(f"t{i}" for i in rng.integers(0, vocabulary, n))  # noqa: E731, B023
        blocks = [text(n) for n in (7, 20, 60, 150)]
        docs = [(i, " ".join(blocks[j] if j < 4 else text(9) for j in rng.integers(0, 8, 6))) for i in range(30)]
        docs += [(40, "a " * 300), (41, "a b " * 40), (42, docs[3][1]), (42, docs[3][1]), (43, docs[3][1] + " end")]
        got = fast_substrings(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), window=10, kmer=4, bits=bits)
        assert got == slow_substrings(docs, 10)


def test_paths_are_compact(spark):
    """A passage that two documents share is one path, however many edges it has; where a third leaves it, it is cut."""
    from locuspark.llm.substring_dedup import compact

    rows = [(1, 0, e, 0, 3 * i, 3) for i, e in enumerate("abcdef")] + [(2, 0, e, 0, 100 + 3 * i, 3) for i, e in enumerate("abcdef")]
    edges = lambda r: spark.createDataFrame([(d, t, ord(p), q, a, m) for d, t, p, q, a, m in r], "_doc long, _t long, _p long, _q long, _a int, _m int")
    found = lambda r: sorted((x._doc, chr(x._p), x._a, x._e) for x in compact(edges(r)).collect())
    assert found(rows) == [(1, "a", 0, 18), (2, "a", 100, 118)]
    third = [(3, 0, "b", 0, 7, 3), (3, 0, "c", 0, 10, 3), (3, 0, "x", 0, 13, 3)]
    assert found([*rows, *third]) == [(1, "a", 0, 3), (1, "b", 3, 9), (1, "d", 9, 18), (2, "a", 100, 103), (2, "b", 103, 109), (2, "d", 109, 118), (3, "b", 7, 13), (3, "x", 13, 16)]


def test_substrings_of_nothing(none):
    assert dedup_substrings(none).count() == 0
