"""Exact duplicates by deterministic block naming.

A text's UTF-8 bytes are cut into blocks of fixed size. The distinct blocks are
sorted and numbered, which gives every block an integer name. Adjacent names
are then paired, the distinct pairs sorted and numbered in turn, and so on
until one name is left for each document. Two texts of the same byte length
have the same name exactly if they are equal: names stand for contents, not for
hashes of them.

The text crosses the network once, in the naming of its blocks. Occurrences find
their block's name through a 64-bit hash; the naming itself shows which hashes
stand for more than one content, and blocks with such a hash are looked up by
content. So a collision costs time and never a wrong match.

Everything is DataFrame operations. Defined results: null counts as the empty
text and empty texts are equal to one another; a very long text is one row per block, its names one list per level; rows that repeat a
doc_id are documents of their own, and where equal texts share their largest
doc_id one of these rows stays; a null doc_id is smaller than any other; an
empty table gives an empty result; other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, is_empty, lookup, materialise, quoted

BLOCK_BYTES = 4096


def block_names(occurrences: DataFrame, content: list[str], key: Column, name: str, keep: bool) -> DataFrame:
    """Number the distinct values of ``content`` in sorted order within hash partitions.

    Returns ``_k`` (the lookup hash), ``_name``, ``_n`` (occurrences) and, with
    ``keep``, the content, written to the shared folder. Names are unique: the
    number of the partition is their upper part.
    """
    distinct = occurrences.groupBy(key.alias("_k"), *content).agg(F.count(F.lit(1)).alias("_n"))
    ranked = distinct.sortWithinPartitions(*content).withColumn("_name", F.monotonically_increasing_id())
    return materialise(ranked.select("_k", *content * keep, "_n", "_name"), name)


def identities(docs: DataFrame, row: list[str], data: str, block_bytes: int = BLOCK_BYTES, hash_bits: int = 64) -> DataFrame:
    """One row for each distinct ``row`` (which determines ``data``, a binary column).

    Columns: ``row``, ``_bytes``, ``_rows`` (how often it is there) and ``_id``;
    (_bytes, _id) is the collision-free identity of the content. hash_bits
    below 64 makes collisions of the lookup hash likely; tests use it.
    """
    last = F.greatest(F.ceil(F.octet_length(data) / block_bytes).cast("int") - 1, F.lit(0))
    cut = F.substring(F.col(data), F.col("_i") * block_bytes + 1, F.lit(block_bytes))
    blocks = docs.select(*row, F.octet_length(data).alias("_bytes"), F.explode(F.sequence(F.lit(0), last)).alias("_i"), data).select(*row, "_bytes", "_i", cut.alias("_block"))
    key = F.xxhash64("_block").bitwiseAND(F.lit(-1 if hash_bits == 64 else (1 << hash_bits) - 1).cast("long"))
    names = block_names(blocks.select("_block"), ["_block"], key, "block-names", keep=False)
    per_key = names.groupBy("_k").agg(F.min("_name").alias("_name"), F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_contents"))
    clear = per_key.where("_contents = 1").drop("_contents")
    ambiguous = per_key.where("_contents > 1").select("_k")
    scratch = [names]
    slim = blocks.select(*row, "_bytes", "_i", key.alias("_k"))
    if is_empty(ambiguous):
        named = lookup(slim, clear, ["_k"], "_n")
    else:
        full = blocks.withColumn("_k", key).join(ambiguous, "_k", "left_semi")
        own = block_names(full.select("_block"), ["_block"], F.lit(0), "ambiguous-names", keep=True).withColumn("_name", -1 - F.col("_name"))
        scratch.append(own)
        named = lookup(slim.join(ambiguous, "_k", "left_anti"), clear, ["_k"], "_n").unionByName(lookup(full, own.drop("_k"), ["_block"], "_n").drop("_block"))
    named = named.groupBy(*row, "_bytes").agg(F.sum(F.when(F.col("_i") == 0, 1).otherwise(0)).alias("_rows"), _in_order())
    level = materialise(named, "block-level")
    discard(*scratch)
    done = [level.where(F.size("_names") == 1)]
    left = level.where(F.size("_names") > 1)
    while not is_empty(left):
        # The odd last name of a document is paired with null, which stands for no block.
        pair = F.transform(F.sequence(F.lit(0), F.ceil(F.size("_names") / 2).cast("int") - 1), lambda i: F.struct(F.get("_names", i * 2).alias("a"), F.get("_names", i * 2 + 1).alias("b")))
        pairs = left.select(*row, "_bytes", "_rows", F.posexplode(pair).alias("_i", "_p")).select(*row, "_bytes", "_rows", "_i", F.col("_p.a").alias("_a"), F.col("_p.b").alias("_b"))
        names = block_names(pairs.select("_a", "_b"), ["_a", "_b"], F.lit(0), "pair-names", keep=True)
        level = materialise(lookup(pairs, names.drop("_k"), ["_a", "_b"], "_n").groupBy(*row, "_bytes", "_rows").agg(_in_order()), "pair-level")
        discard(names)
        done.append(level.where(F.size("_names") == 1))
        left = level.where(F.size("_names") > 1)
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out.select(*row, "_bytes", "_rows", F.col("_names")[0].alias("_id"))


def _in_order() -> Column:
    """A document's names in order. Rows that repeat a document give equal structs, which the set holds once."""
    return F.transform(F.sort_array(F.collect_set(F.struct("_i", "_name"))), lambda x: x["_name"]).alias("_names")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, hash_bits: int = 64) -> DataFrame:
    """For every row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``."""
    data = F.coalesce(quoted(text_col).cast("string"), F.lit("")).cast("binary")
    docs = docs.select(quoted(id_col).alias("_doc"), data.alias("_data"))
    docs = docs.select("_doc", F.sha2("_data", 256).alias("_sha"), "_data")
    members = materialise(identities(docs, ["_doc", "_sha"], "_data", block_bytes, hash_bits), "members")
    groups = members.groupBy("_bytes", "_id").agg(F.max("_doc").alias("_keep"), F.sum("_rows").alias("_size"), F.count(F.lit(1)).alias("_n"))
    out = lookup(members, groups, ["_bytes", "_id"], "_n")
    # A document that is there several times is given back as often; its first copy stays.
    out = out.select("_doc", "_keep", "_size", "_sha", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))).alias("_copy"))
    kept = F.col("_doc").eqNullSafe(F.col("_keep")) & (F.col("_copy") == 1)
    return out.select(F.col("_doc").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_size").cast("long").alias("group_size"), kept.alias("kept"), F.col("_sha").alias("text_sha256"))
