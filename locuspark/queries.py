"""The registered queries over position-sorted tables, each with the SQL that gives the same rows.

The fixture tables are made from ``lineitem`` (a genome-like table of 22 chromosomes and 7 tags) and
``events`` (large positions, 5 uneven tags), written once a session in the formats under test.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .functions.blocks import COLUMNAR, ZSTD
from .operators.joins import interval_join, nearest_before, previous_position
from .operators.tables import write_dictionary, write_text
from .session import Engine
from .shared import shared_dir
from .sources import files
from .sources.writer import create, make_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

V = """v AS (SELECT 'chr' || CAST(l_suppkey % 22 + 1 AS STRING) AS chrom, CAST(l_orderkey AS INT) AS pos,
  l_returnflag AS ref, l_linestatus AS alt, CAST(CAST(l_quantity AS INT) AS STRING) AS qty,
  'PN' || CAST(l_linenumber AS STRING) AS pn, l_partkey FROM lineitem)"""
EV_SPARK = "SELECT 'chr' || CAST(user_id % 22 + 1 AS STRING) AS chrom, CAST(unix_timestamp(ts) AS INT) AS pos, event_type AS tag, CAST(event_id AS STRING) AS id FROM events"
EV = "ev AS (SELECT 'chr' || CAST(user_id % 22 + 1 AS STRING) AS chrom, CAST(floor(epoch(ts)) AS INT) AS pos, event_type AS tag, CAST(event_id AS STRING) AS id FROM events)"
BUCKETS = {"b1.gorz": ["PN1", "PN2", "PN3", "PN4"], "b2.gorz": ["PN5", "PN6", "PN7"]}
TEXT = "chrom, pos, ref, alt, qty, pn, CAST(l_partkey AS STRING) AS l_partkey"
BLOCK = str(32 * 1024)

_made: dict[tuple, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql if sql.startswith("WITH") else f"WITH {V}\n{sql}"
        return f

    return add


class Tables:
    """The fixture tables of one session and data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf = spark, sf_dir
        self.engine = Engine(spark)
        for name in ("lineitem", "events"):
            spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)

    @property
    def v(self) -> DataFrame:
        return self.spark.sql(f"WITH {V} SELECT * FROM v")

    @property
    def ev(self) -> DataFrame:
        self.spark.conf.set("spark.sql.session.timeZone", "UTC")
        return self.spark.sql(EV_SPARK)

    def made(self, name: str, make: Callable[[str], None]) -> str:
        """The path of a fixture, made at its first use in this session."""
        key = (self.spark.sparkContext.applicationId, self.sf, name)
        if key not in _made:
            path = f"{shared_dir(self.spark)}/tables/{key[0]}-{zlib.crc32(self.sf.encode()):08x}/{name}"
            make_folder(path.rpartition("/")[0])
            make(path)
            _made[key] = path
        return _made[key]

    def write(self, df: DataFrame, **options: str) -> Callable[[str], None]:
        return lambda path: self.engine.write_gor(df.orderBy("chrom", "pos"), path, **options)

    def file(self, name: str = "v.gorz", **options: str) -> str:
        return self.made(name, self.write(self.v, **options))

    def dictionary(self) -> str:
        """Seven files, two buckets and v.gord."""
        return self.made("dict/v.gord", lambda path: write_dictionary(self.v, path.rpartition("/")[0], "v.gord", "pn", BUCKETS))

    def variant(self, name: str, change: Callable[[list[list[str]]], list[list[str]]], head: str = "") -> str:
        """Another dictionary over the same files."""
        base = self.dictionary()

        def make(path: str) -> None:
            lines = [x.split("\t") for x in files.read_all(base).decode().splitlines()]
            write_text(path, head + "".join("\t".join(x) + "\n" for x in change(lines)))

        return self.made(f"dict/{name}", make)

    def read(self, path: str, **options) -> DataFrame:
        return self.engine.read_gor(path, **options)


def scan(name: str, sql: str, **options):
    """Register a plain scan of v.gorz with options."""
    return query(name, sql)(lambda s, d: (t := Tables(s, d)).read(t.file(), **options))


# A. Scans and round trips.
scan("gorz_roundtrip", f"SELECT {TEXT} FROM v")
query("gorz_count", "SELECT count(*) AS n FROM v")(lambda s, d: (t := Tables(s, d)).engine.sql(f"SELECT count(*) AS n FROM '{t.file()}'"))
scan("gorz_projection", "SELECT chrom, qty FROM v", columns=["chrom", "qty"])
scan("gorz_multi_partition_scan", f"SELECT {TEXT} FROM v", split_bytes="20000")


@query("gorz_meta_schema_types", "SELECT chrom, CAST(pos AS BIGINT) AS pos, ref, alt, CAST(qty AS DOUBLE) AS qty, pn, l_partkey FROM v")
def _meta(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)

    def make(path: str) -> None:
        t.write(t.v)(path)
        write_text(f"{path}.meta", "## SCHEMA = S,L,S,S,D,null,L\n## LINE_COUNT = 1\n")

    return t.read(t.made("meta.gorz", make))


query("gorz_no_meta_types", "SELECT 'chrom' AS col, 'string' AS kind UNION ALL SELECT 'pos', 'int' UNION ALL SELECT 'ref', 'string' UNION ALL SELECT 'alt', 'string' UNION ALL SELECT 'qty', 'string' UNION ALL SELECT 'pn', 'string' UNION ALL SELECT 'l_partkey', 'string'")(
    lambda s, d: s.createDataFrame((t := Tables(s, d)).read(t.file()).dtypes, "col string, kind string")
)


@query("gor_text_roundtrip", f"SELECT chrom, CAST(pos AS STRING) AS pos, ref, alt, qty, pn, CAST(l_partkey AS STRING) AS l_partkey FROM v")
def _text(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    return s.read.csv(t.made("v.gor", t.write(t.v)), sep="\t", header=True)


query("read_gor_autodetect", "SELECT chrom, pos, pn AS Source FROM v")(lambda s, d: (t := Tables(s, d)).read(t.dictionary()).select("chrom", "pos", "Source"))
query("read_gorz_forced", f"SELECT {TEXT} FROM v")(lambda s, d: (t := Tables(s, d)).engine.read_gorz(t.file()))
query("sql_literal_from", "SELECT ref, count(*) AS n FROM v GROUP BY ref")(lambda s, d: (t := Tables(s, d)).engine.sql(f"SELECT ref, count(*) AS n FROM '{t.file()}' GROUP BY ref"))
query("sql_call_in_statement", "SELECT chrom, pos, qty FROM v WHERE chrom = 'chr2' AND pos BETWEEN 100 AND 900")(
    lambda s, d: (t := Tables(s, d)).engine.sql(f"SELECT chrom, pos, qty FROM read_gor('{t.file()}', range := 'chr2:100-900')")
)
query("sql_udtf_named_args", "SELECT chrom, pos, pn AS Source FROM v WHERE chrom = 'chr2' AND pn IN ('PN1', 'PN5')")(
    lambda s, d: (t := Tables(s, d)).spark.sql(f"SELECT chrom, pos, Source FROM read_gord('{t.dictionary()}', f => array('PN1', 'PN5'), range => 'chr2')")
)

# B. Ranges.
scan("range_chrom", f"SELECT {TEXT} FROM v WHERE chrom = 'chr7'", range="chr7")
scan("range_window", f"SELECT {TEXT} FROM v WHERE chrom = 'chr7' AND pos BETWEEN 500 AND 4000", range="chr7:500-4000")
scan("range_open_hi", f"SELECT {TEXT} FROM v WHERE chrom = 'chr10' AND pos >= 1000", range="chr10:1000-")
scan("range_open_lo", f"SELECT {TEXT} FROM v WHERE chrom = 'chr10' AND pos <= 1000", range="chr10:-1000")
scan("range_point", f"SELECT {TEXT} FROM v WHERE chrom = 'chr1' AND pos = 68", range="chr1:68")
query("range_and_where", f"SELECT {TEXT} FROM v WHERE chrom = 'chr3' AND pos > 900")(lambda s, d: (t := Tables(s, d)).read(t.file(), range="chr3", where="pos > 900"))
scan("range_absent_chrom", f"SELECT {TEXT} FROM v WHERE chrom = 'chrZ'", range="chrZ")


# C. Filters on the rows.
def where(name: str, condition: str) -> None:
    query(name, f"SELECT {TEXT} FROM v WHERE {condition}")(lambda s, d: (t := Tables(s, d)).read(t.file(), where=condition))


where("where_chrom_eq", "chrom = 'chr5'")
where("where_pos_between", "chrom = 'chr5' AND pos BETWEEN 200 AND 700")
where("where_pos_only", "pos < 150")
where("where_flipped", "250 >= pos AND 'chr9' = chrom")
where("where_or_residual", "chrom = 'chr1' OR pos = 33")
where("where_in_residual", "chrom IN ('chr1', 'chr22') AND pos < 2000")
where("where_nonkey", "qty = '7' AND ref = 'R'")
where("where_contradiction", "chrom = 'chr1' AND chrom = 'chr2'")


@query(
    "scan_reused",
    "SELECT 1 AS step, count(*) AS n FROM v UNION ALL SELECT 2, count(*) FROM v WHERE chrom = 'chr1' UNION ALL SELECT 3, count(*) FROM v WHERE chrom = 'chr2' AND pos < 900 "
    "UNION ALL SELECT 4, count(*) FROM v WHERE pos BETWEEN 50 AND 90 UNION ALL SELECT 5, count(*) FROM v",
)
def _reused(s: SparkSession, d: str) -> DataFrame:
    """One scan with a filter here and there, in one plan and through a view."""
    t = Tables(s, d)
    v = t.read(t.file())
    v.createOrReplaceTempView("reused_scan")
    n = lambda step, df: df.agg(F.lit(step).alias("step"), F.count(F.lit(1)).alias("n"))
    once = s.sql("SELECT * FROM reused_scan WHERE chrom = 'chr2' AND pos < 900")
    return n(1, v).unionByName(n(2, v.where("chrom = 'chr1'"))).unionByName(n(3, once)).unionByName(n(4, v.where("pos BETWEEN 50 AND 90"))).unionByName(n(5, s.table("reused_scan")))


@query("sql_two_uses", "SELECT (SELECT count(*) FROM v WHERE chrom = 'chr1') AS a, (SELECT count(*) FROM v) AS b, (SELECT max(pos) FROM v WHERE pn = 'PN2' AND chrom IN ('chr3', 'chr4')) AS c")
def _two(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    x = t.file()
    return t.engine.sql(f"WITH v AS (SELECT * FROM '{x}') SELECT (SELECT count(*) FROM v WHERE chrom = 'chr1') AS a, (SELECT count(*) FROM v) AS b, (SELECT max(pos) FROM '{x}' WHERE pn = 'PN2' AND chrom IN ('chr3', 'chr4')) AS c")


# D. Dictionaries. pn is the tag, which files without a source column don't carry.
DICT = "chrom, pos, ref, alt, qty, CAST(l_partkey AS STRING) AS l_partkey, pn AS Source"


def tagged(name: str, condition: str, then: str | None = None, **options) -> None:
    query(name, f"SELECT {DICT} FROM v WHERE {condition}")(lambda s, d: (t := Tables(s, d)).read(t.dictionary(), where=then, **options))


tagged("gord_full_scan", "true")
query("gord_source_rename", "SELECT chrom, pos, pn AS PN FROM v")(lambda s, d: (t := Tables(s, d)).read(t.dictionary(), source="PN").select("chrom", "pos", "PN"))
tagged("gord_f_list", "pn IN ('PN1', 'PN2')", f=["PN1", "PN2"])
tagged("gord_f_single_tag", "pn = 'PN6'", f=["PN6"])
tagged("gord_unknown_tag", "false", f=["nope"])
tagged("gord_range", "chrom = 'chr4' AND pos BETWEEN 1 AND 5000", range="chr4:1-5000")
tagged("gord_range_and_tags", "chrom = 'chr4' AND pn IN ('PN2', 'PN7')", range="chr4", f=["PN2", "PN7"])
tagged("gord_where_source", "pn = 'PN3' AND qty = '9'", "Source = 'PN3' AND qty = '9'")
tagged("gord_where_chrom", "chrom = 'chr11' AND pos >= 3000", "chrom = 'chr11' AND pos >= 3000")
tagged("gord_unknown_chrom_pruned", "false", range="chrZ:5-6")


def _ff(t: Tables) -> str:
    return t.made("tags.tsv", lambda path: write_text(path, "#PN\thdr\nPN1\tx\nPN4\ty\n"))


query("gord_ff_file", f"SELECT {DICT} FROM v WHERE pn IN ('PN1', 'PN4')")(lambda s, d: (t := Tables(s, d)).read(t.dictionary(), ff=_ff(t)))
query("gord_f_union_ff", f"SELECT {DICT} FROM v WHERE pn IN ('PN1', 'PN4', 'PN5')")(lambda s, d: (t := Tables(s, d)).read(t.dictionary(), ff=_ff(t), f=["PN5", "PN1"]))


def _deleted(t: Tables) -> str:
    return t.variant("deleted.gord", lambda ls: [[x[0].replace("|", "|D|"), *x[1:]] if x[1] == "PN3" else x for x in ls])


def _readded(t: Tables) -> str:
    return t.variant("readded.gord", lambda ls: [[x[0].replace("|", "|D|"), *x[1:]] if x[1] == "PN3" else x for x in ls] + [["PN3.gorz", "PN3"]])


def _unbucketed(t: Tables) -> str:
    return t.variant("plain.gord", lambda ls: [[x[0].partition("|")[0], *x[1:]] for x in ls])


query("gord_deleted_tag", f"SELECT {DICT} FROM v WHERE false")(lambda s, d: (t := Tables(s, d)).read(_deleted(t), f=["PN3"]))
query("gord_deleted_full_scan", f"SELECT {DICT} FROM v WHERE pn <> 'PN3'")(lambda s, d: (t := Tables(s, d)).read(_deleted(t)))
query("gord_deleted_all_requested", f"SELECT {DICT} FROM v WHERE pn <> 'PN3'")(lambda s, d: (t := Tables(s, d)).read(_deleted(t), f=[f"PN{i}" for i in range(1, 8)]))
query("gord_readded_tag", f"SELECT {DICT} FROM v")(lambda s, d: (t := Tables(s, d)).read(_readded(t)))
query("gord_unbucketized", f"SELECT {DICT} FROM v")(lambda s, d: (t := Tables(s, d)).read(_unbucketed(t)))
query("gord_two_columns", f"SELECT {DICT} FROM v WHERE pn IN ('PN1', 'PN2', 'PN5')")(lambda s, d: (t := Tables(s, d)).read(t.variant("two.gord", lambda ls: [x[:2] for x in ls]), f=["PN1", "PN2", "PN5"]))
query("gord_declared_range_prune", f"SELECT {DICT} FROM v WHERE chrom = 'chr2' AND pn <> 'PN4'")(
    lambda s, d: (t := Tables(s, d)).read(t.variant("narrow.gord", lambda ls: [[x[0].partition("|")[0], x[1], *(["chr5", "1", "chr6", "9"] if x[1] == "PN4" else x[2:])] for x in ls]), range="chr2")
)
query("gord_legacy_inline_bucket", f"SELECT {DICT} FROM v WHERE pn IN ('PN2', 'PN4', 'PN6')")(
    lambda s, d: (t := Tables(s, d)).read(t.variant("inline.gord", lambda ls: [["b1.gorz", "x", "chr1", "0", "chr9", "99999999", "PN1,PN2,PN3,PN4"], ["b2.gorz", "y", "chr1", "0", "chr9", "99999999", "PN5,PN6,PN7"]]), f=["PN2", "PN4", "PN6"])
)
query("gord_bucket_equals_primary", "SELECT CAST(0 AS BIGINT) AS n")(lambda s, d: (t := Tables(s, d)).read(t.dictionary()).exceptAll(t.read(_unbucketed(t))).agg(F.count(F.lit(1)).alias("n")))


@query("gord_events_uneven_tags", f"WITH {EV} SELECT Source, count(*) AS n, min(pos) AS lo, max(pos) AS hi FROM (SELECT pos, tag AS Source FROM ev) GROUP BY Source")
def _events(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    path = t.made("events/e.gord", lambda path: write_dictionary(t.ev, path.rpartition("/")[0], "e.gord", "tag"))
    return t.read(path).groupBy("Source").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("lo"), F.max("pos").alias("hi"))


# E. Codec.
query("zstd_decode", f"SELECT {TEXT} FROM v")(lambda s, d: (t := Tables(s, d)).read(t.file("zstd.gorz", codec="zstd")))
query("gori_seek", f"SELECT {TEXT} FROM v WHERE chrom = 'chr8' AND pos BETWEEN 100 AND 2000")(lambda s, d: (t := Tables(s, d)).read(t.file("indexed.gorz", index="true", block_bytes="4096"), range="chr8:100-2000"))
query("block_boundary_duplicates", "SELECT chrom, pos, count(*) AS n FROM v WHERE chrom = 'chr6' AND pos BETWEEN 40 AND 60 GROUP BY chrom, pos")(
    lambda s, d: (t := Tables(s, d)).read(t.file("tiny.gorz", block_bytes="64"), range="chr6:40-60").groupBy("chrom", "pos").agg(F.count(F.lit(1)).alias("n"))
)


@query("columnar_decode", "SELECT 'chr1' AS chrom, CAST(10 * (i + 1) AS INT) AS pos, 'v' || CAST(i % 7 AS STRING) AS val, 'k' AS kind FROM range(500) t(i)")
def _columnar(s: SparkSession, d: str) -> DataFrame:
    """One columnar zstd block: a constant, steps, strings and looked-up strings."""
    import struct

    from .functions.blocks import deflate, pack

    t = Tables(s, d)

    def make(path: str) -> None:
        n = 500
        diffs = [(i % 7) - ((i - 1) % 7 if i else 0) for i in range(n)]
        names = b"".join(b"v%d\0" % i for i in range(7))
        table = struct.pack(">HBH", 1, 2, 7) + names
        body = struct.pack(">H", n) + bytes([23, 7, 25, 23, 0]) + b"chr1\0" + struct.pack(">qi", 0, 10) + struct.pack(f">{n}b", *diffs) + b"k\0"
        with create(path) as f:
            f.write(b"#chrom\tpos\tval\tkind\0" + pack(deflate(table, True)) + b"\n")
            f.write(b"chr1\t5000\t%c" % (COLUMNAR | ZSTD) + pack(deflate(body, True)) + b"\n")

    return t.read(t.made("columnar.gorz", make))


# F. Writing.
def copied(name: str, kind: str, sql: str, select: str, rows: str = "true") -> None:
    """``rows``: what the query gives of the copy, where its SQL has a part only."""

    def run(s: SparkSession, d: str) -> DataFrame:
        t = Tables(s, d)
        t.v.createOrReplaceTempView("v")
        path = t.made(f"{name}.{kind}", lambda path: t.engine.sql(f"COPY ({select}) TO '{path}' (FORMAT {kind})") and None)
        return (t.read(path) if kind == "gorz" else s.read.csv(path, sep="\t", header=True)).where(rows)

    query(name, sql)(run)


copied("copy_gorz", "gorz", "SELECT chrom, pos, ref FROM v WHERE pos < 3000", "SELECT chrom, pos, ref FROM v ORDER BY chrom, pos", "pos < 3000")
copied("copy_gor", "gor", "SELECT chrom, CAST(pos AS STRING) AS pos, ref FROM v WHERE pos < 3000", "SELECT chrom, pos, ref FROM v ORDER BY chrom, pos", "CAST(pos AS INT) < 3000")
copied("copy_null_fields", "gorz", "SELECT chrom, pos, CASE WHEN ref = 'A' THEN '' ELSE ref END AS ref, coalesce(CASE WHEN alt = 'O' THEN '' ELSE alt END, '') AS alt FROM v", "SELECT chrom, pos, nullif(ref, 'A') AS ref, nullif(alt, 'O') AS alt FROM v ORDER BY chrom, pos")
copied("copy_typed_text", "gorz", "SELECT chrom, pos, CAST(pos % 2 = 0 AS STRING) AS even, CAST(pos * CAST(0.5 AS DOUBLE) AS STRING) AS half FROM v", "SELECT chrom, pos, pos % 2 = 0 AS even, pos * 0.5D AS half FROM v ORDER BY chrom, pos")


@query("copy_parallel_parts", "SELECT chrom, count(*) AS n, CAST(sum(pos) AS BIGINT) AS total FROM v GROUP BY chrom")
def _parts(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    path = t.made("parts.gorz", lambda path: t.engine.write_gor(t.v.repartitionByRange(6, "chrom", "pos").sortWithinPartitions("chrom", "pos"), path))
    return t.read(path).groupBy("chrom").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").cast("long").alias("total"))


# G. Spark's operators over the tables.
def over(name: str, sql: str) -> Callable[[Callable[[DataFrame, Tables], DataFrame]], None]:
    def add(f: Callable[[DataFrame, Tables], DataFrame]) -> None:
        query(name, sql)(lambda s, d: f((t := Tables(s, d)).read(t.file()), t))

    return add


AGG = "SELECT chrom, count(*) AS n, min(pos) AS lo, max(pos) AS hi, CAST(sum(CAST(qty AS BIGINT)) AS BIGINT) AS qty FROM {} GROUP BY chrom"
query("agg_by_chrom", AGG.format("v"))(lambda s, d: (t := Tables(s, d)).engine.sql(AGG.format(f"'{t.file()}'")))
over("distinct_tags", "SELECT DISTINCT pn FROM v")(lambda v, t: v.select("pn").distinct())
over("rollup_chrom_tag", "SELECT chrom, pn, count(*) AS n FROM v GROUP BY ROLLUP (chrom, pn)")(lambda v, t: v.rollup("chrom", "pn").agg(F.count(F.lit(1)).alias("n")))
over("cube_ref_alt", "SELECT ref, alt, count(*) AS n FROM v GROUP BY CUBE (ref, alt)")(lambda v, t: v.cube("ref", "alt").agg(F.count(F.lit(1)).alias("n")))
ORDER = "pos, pn, CAST(l_partkey AS BIGINT), qty, ref, alt"
over("window_rank_per_chrom", f"SELECT * FROM (SELECT chrom, pos, CAST(row_number() OVER (PARTITION BY chrom ORDER BY {ORDER}) AS INT) AS rn FROM v) WHERE rn <= 5")(
    lambda v, t: v.select("chrom", "pos", F.row_number().over(Window.partitionBy("chrom").orderBy(*[F.expr(x) for x in ORDER.split(", ")])).alias("rn")).where("rn <= 5")
)
over("window_lag_distance", "SELECT chrom, max(gap) AS widest FROM (SELECT chrom, pos - lag(pos) OVER (PARTITION BY chrom ORDER BY pos) AS gap FROM v) GROUP BY chrom")(
    lambda v, t: previous_position(v.select("chrom", "pos"), "chrom", "pos", "before", bin_size=512).groupBy("chrom").agg(F.max(F.col("pos") - F.col("before")).alias("widest"))
)
over("topk_pos", f"SELECT {TEXT} FROM v ORDER BY pos DESC, chrom, pn, CAST(l_partkey AS BIGINT), qty, ref, alt LIMIT 20")(
    lambda v, t: v.orderBy(F.desc("pos"), "chrom", "pn", F.col("l_partkey").cast("long"), "qty", "ref", "alt").limit(20)
)
over("limit_offset", f"SELECT chrom, pos FROM v ORDER BY chrom, pos LIMIT 15 OFFSET 40")(lambda v, t: v.select("chrom", "pos").orderBy("chrom", "pos").offset(40).limit(15))
over("join_two_gor_equi", "SELECT a.chrom, count(*) AS n FROM v a JOIN v b ON a.chrom = b.chrom AND a.pos = b.pos WHERE a.pn = 'PN1' AND b.pn = 'PN2' GROUP BY a.chrom")(
    lambda v, t: v.where("pn = 'PN1'").select("chrom", "pos").join(v.where("pn = 'PN2'").select("chrom", "pos"), ["chrom", "pos"]).groupBy("chrom").agg(F.count(F.lit(1)).alias("n"))
)
over("left_join_counts", "SELECT a.chrom, a.pos, count(b.pos) AS n FROM (SELECT DISTINCT chrom, pos FROM v WHERE pn = 'PN1') a LEFT JOIN (SELECT * FROM v WHERE pn = 'PN7') b ON a.chrom = b.chrom AND a.pos = b.pos GROUP BY a.chrom, a.pos")(
    lambda v, t: v.where("pn = 'PN1'").select("chrom", "pos").distinct().join(v.where("pn = 'PN7'").select("chrom", "pos", F.lit(1).alias("hit")), ["chrom", "pos"], "left").groupBy("chrom", "pos").agg(F.count("hit").alias("n"))
)
over("semi_join", f"SELECT {TEXT} FROM v a WHERE pn = 'PN1' AND EXISTS (SELECT 1 FROM v b WHERE b.pn = 'PN2' AND a.chrom = b.chrom AND a.pos = b.pos)")(
    lambda v, t: v.where("pn = 'PN1'").join(v.where("pn = 'PN2'"), ["chrom", "pos"], "left_semi").select(v.columns)
)
over("anti_join", f"SELECT {TEXT} FROM v a WHERE pn = 'PN1' AND NOT EXISTS (SELECT 1 FROM v b WHERE b.pn = 'PN2' AND a.chrom = b.chrom AND a.pos = b.pos)")(
    lambda v, t: v.where("pn = 'PN1'").join(v.where("pn = 'PN2'"), ["chrom", "pos"], "left_anti").select(v.columns)
)
IV = "SELECT DISTINCT chrom, pos AS lo, pos + 25 AS hi FROM v WHERE pn = 'PN7' AND qty = '3'"
over("interval_join", f"SELECT v.chrom, count(*) AS n, CAST(sum(pos - lo) AS BIGINT) AS dist FROM v JOIN ({IV}) i ON v.chrom = i.chrom AND pos BETWEEN lo AND hi GROUP BY v.chrom")(
    lambda v, t: interval_join(v, v.where("pn = 'PN7' AND qty = '3'").select("chrom", F.col("pos").alias("lo"), (F.col("pos") + 25).alias("hi")).distinct(), "chrom", "pos", "lo", "hi")
    .groupBy("chrom")
    .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("pos") - F.col("lo")).cast("long").alias("dist"))
)
over(
    "asof_nearest_upstream",
    "SELECT a.chrom, a.pos, (SELECT max(b.pos) FROM v b WHERE b.pn = 'PN7' AND b.qty = '5' AND b.chrom = a.chrom AND b.pos <= a.pos) AS upstream FROM v a WHERE a.pn = 'PN6'",
)(lambda v, t: nearest_before(v.where("pn = 'PN6'").select("chrom", "pos"), v.where("pn = 'PN7' AND qty = '5'").select("chrom", "pos", F.col("pos").alias("up")), "chrom", "pos", "up", "upstream", bin_size=512))
query("union_all_sources", "SELECT pn AS Source, count(*) AS n FROM v GROUP BY pn")(
    lambda s, d: (t := Tables(s, d)).read(t.dictionary(), f=["PN1"]).unionByName(t.read(t.dictionary(), f=[f"PN{i}" for i in range(2, 8)])).groupBy("Source").agg(F.count(F.lit(1)).alias("n"))
)
over("intersect_keys", "SELECT chrom, pos FROM v WHERE pn = 'PN1' INTERSECT SELECT chrom, pos FROM v WHERE pn = 'PN3'")(
    lambda v, t: v.where("pn = 'PN1'").select("chrom", "pos").intersect(v.where("pn = 'PN3'").select("chrom", "pos"))
)
over("except_keys", "SELECT chrom, pos FROM v WHERE pn = 'PN1' EXCEPT SELECT chrom, pos FROM v WHERE pn = 'PN3'")(
    lambda v, t: v.where("pn = 'PN1'").select("chrom", "pos").subtract(v.where("pn = 'PN3'").select("chrom", "pos"))
)
over("pivot_tags", "SELECT chrom, " + ", ".join(f"count(*) FILTER (WHERE pn = 'PN{i}') AS PN{i}" for i in range(1, 8)) + " FROM v GROUP BY chrom")(
    lambda v, t: v.groupBy("chrom").pivot("pn", [f"PN{i}" for i in range(1, 8)]).agg(F.count(F.lit(1))).fillna(0)
)
over("histogram_bins", "SELECT chrom, CAST(floor(pos / 1000) AS BIGINT) AS bin, count(*) AS n FROM v GROUP BY ALL")(
    lambda v, t: v.groupBy("chrom", F.floor(F.col("pos") / 1000).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write, read back and aggregate."""
    return QUERIES["agg_by_chrom"](spark, sf_dir)
