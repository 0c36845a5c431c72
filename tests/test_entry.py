"""The driver's contract on small tables."""

import sys
from pathlib import Path

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="needs the test tables")


def test_names_and_flagship(spark):
    import __spark_entry__ as entry

    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) >= 70
    assert entry.entry(spark).columns == ["chrom", "n", "lo", "hi", "qty"]


@pytest.mark.parametrize("name", ["gorz_roundtrip", "gord_full_scan", "range_window", "where_in_residual", "asof_nearest_upstream", "copy_typed_text", "scan_reused", "sql_two_uses", "window_lag_distance"])
def test_against_sql(spark, name):
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    for t in ("lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    want = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(str, (tuple(r) for r in df.select(*names).collect()))) == sorted(map(str, want.fetchall()))


@pytest.mark.parametrize(("name", "kind"), [("copy_gorz", "gorz"), ("copy_gor", "gor")])
def test_copies_are_whole(spark, name, kind):
    import duckdb

    from locuspark import queries

    sf = SF.replace("sf0.001", "sf0.01")  # positions reach 3000 here
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{sf}/lineitem.parquet'")
    got = queries.QUERIES[name](spark, sf)
    rows = lambda df: sorted((r.chrom, int(r.pos), r.ref) for r in df.collect())
    assert rows(got) == sorted((c, int(p), r) for c, p, r in con.execute(queries.SQL[name]).fetchall())
    t = queries.Tables(spark, sf)
    path = t.made(f"{name}.{kind}", None)
    copy = t.read(path) if kind == "gorz" else spark.read.csv(path, sep="\t", header=True)
    assert rows(copy) == rows(t.v) and len(rows(copy)) > got.count()


def test_point_range_has_a_row(spark):
    import __spark_entry__ as entry

    assert entry.queries()["range_point"](spark, SF).count() > 0


def test_a_missing_library_is_not_taken_for_missing_operators():
    import subprocess

    code = "import sys; sys.modules['xxhash'] = None\nimport __spark_entry__"
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True)
    assert out.returncode and "xxhash" in out.stderr


def test_the_rest_stands_without_the_corpus_operators():
    import subprocess

    code = "import sys; sys.modules['locuspark.llm'] = None; sys.modules['corpus_pipeline'] = None\nimport __spark_entry__ as e; print(len(e.queries()) > 60, any(n.startswith('op') for n in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True)
    assert out.stdout.split() == ["True", "False"], out.stderr
