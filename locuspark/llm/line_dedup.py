"""Lines that many documents share.

Lines are exploded and normalised, hashed, and counted by distinct documents;
lines over the threshold are dropped from every document but the one with the
largest id, and what stays is put together again by position.

The occurrences of long lines (a row of integers each) are written once; counting and
dropping read them. Counting is by (hash, document) first, so no task holds all
occurrences of a line, and the few lines that hold a large share of all
occurrences are looked up by broadcast (see ``common.lookup``). Text is shuffled once.

Defined results: a null or empty text is one empty line; a very long text is one row, whose lines are in the memory of one task, and the
places of its dropped lines one list; rows that repeat a
doc_id count as one document and, where it is the largest, all keep the line; a null doc_id counts as one document,
smaller than any other; an empty table gives an empty result; other columns are kept, and where ``n_lines`` or ``n_dropped`` is taken the new column gets an underscore in front.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, discard, fresh, hash128, lookup, materialise, numbered, quoted, renumbered, with_text

MIN_CHARS = 40
MIN_DOCS = 5


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(BLANKS))
    # lower() is a fast path that agrees with A-Z to a-z on ASCII.
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the text that stays, ``n_lines`` (before) and ``n_dropped``."""
    n_lines, n_dropped = fresh(docs, "n_lines", "n_dropped")
    lines = F.split(with_text(docs, text_col), "\n", -1)
    rows = docs.select(quoted(id_col).alias("_doc"), F.xxhash64(with_text(docs, text_col)).alias("_h"), lines.alias("_lines"))
    long = (
        rows.select("_doc", "_h", F.posexplode("_lines").alias("_pos", "_line"))
        .where(F.length("_line") >= min_chars)
        .select("_doc", "_h", "_pos", line_key(F.col("_line")).alias("_key"))
        .where(F.length("_key") >= min_chars)
        .select("_doc", "_h", "_pos", *[x.alias(f"_k{i}") for i, x in enumerate(hash128(F.col("_key")))])
    )
    seen = materialise(long, "lines")
    per_doc = seen.groupBy("_k0", "_k1", "_doc").agg(F.count(F.lit(1)).alias("_n"))
    common = per_doc.groupBy("_k0", "_k1").agg(F.count(F.lit(1)).alias("_docs"), F.max("_doc").alias("_keep"), F.sum("_n").alias("_n")).where(F.col("_docs") >= min_docs)
    common = materialise(common, "common-lines")
    hits = lookup(seen, common.select("_k0", "_k1", "_keep", F.lit(True).alias("_common"), "_n"), ["_k0", "_k1"], "_n", "inner")
    hits = hits.where(~F.col("_doc").eqNullSafe(F.col("_keep")))
    drops = hits.groupBy("_doc", "_h").agg(F.collect_set("_pos").alias("_drop"))
    drops = materialise(drops, "dropped-lines")
    discard(seen, common)
    # The lines are made below the join, so that the lambda above it does not split the text again for each line.
    left = docs.select(*numbered(docs, text_col), quoted(id_col).alias("_doc"), F.xxhash64(with_text(docs, text_col)).alias("_h"), lines.alias("_lines"))
    both = left.join(drops.select(F.col("_doc").alias("_d"), F.col("_h").alias("_g"), "_drop"), F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_g")), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drop"))
    text = F.array_join(F.when(F.col("_drop").isNull(), F.col("_lines")).otherwise(F.transform(stay, lambda i: F.get("_lines", i))), "\n")
    return both.select(*renumbered(docs, text_col, text), F.size("_lines").cast("long").alias(n_lines), F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias(n_dropped))
