"""F1-F6, D1-D10, S10-S13: ranges, dictionaries, sidecars and SQL rewriting, without Spark."""

import random

import pytest
import pyspark.sql.types as T
from hypothesis import given, settings
from hypothesis import strategies as st

from locuspark.plans import dictionary as D
from locuspark.plans.ranges import LEAST, MOST, Window, parse_range
from locuspark.plans.statements import call_options, parse_copy, rewrite, tokens
from locuspark.sources import files, sidecars


@pytest.mark.parametrize(
    ("spec", "want"),
    [
        (None, Window()),
        ("", Window()),
        ("chr1", Window("chr1")),
        ("chr1:5-9", Window("chr1", 5, 9)),
        ("chr1:5-", Window("chr1", 5, MOST)),
        ("chr1:-9", Window("chr1", LEAST, 9)),
        ("chr1:-", Window("chr1")),
        ("chr1:7", Window("chr1", 7, 7)),
        ("chr1: +7", Window("chr1", 7, 7)),
    ],
)
def test_ranges(spec, want):
    assert parse_range(spec) == want


@pytest.mark.parametrize(("spec", "message"), [("chr1:oops", "bad position"), ("chr1:1x-2", "bad position"), ("chr1:9-5", "end < start"), (":5", "empty chromosome"), ("chr1:", "empty position"), ("chr1:99999999999999999999", "bad position")])
def test_range_errors(spec, message):
    with pytest.raises(ValueError, match=message):
        parse_range(spec)


def test_windows_meet():
    assert parse_range("chr1:5-9").meet(Window(None, 7, 20)) == Window("chr1", 7, 9)
    assert parse_range("chr1").meet(Window("chr2")).empty


DICT = "s1.gorz|b1.gorz\ts1\tchr1\t1\tchr1\t100\ns2.gorz|b1.gorz\ts2\tchr1\t1\tchr1\t100\r\ns3.gorz|D|b1.gorz\ts3\tchr1\t1\tchr1\t100\ns4.gorz|b1.gorz\ts4\tchr1\t1\tchr1\t100  \n\n"


def paths(entries):
    return [e.path.rpartition("/")[2] for e in entries]


def test_parse_and_bucket_index():
    d = D.parse(DICT, "/x/d.gord")
    assert [e.deleted for e in d.entries] == [False, False, True, False]
    assert d.entries[0].path == "/x/s1.gorz" and d.entries[0].bucket == "/x/b1.gorz"
    b = d.buckets["/x/b1.gorz"]
    assert b.members == ["s1", "s2", "s3", "s4"] and b.dropped == {"s3"}
    assert d.valid_tags == {"s1", "s2", "s4"}


@pytest.mark.parametrize(("tags", "want"), [({"s1", "s2"}, ["b1.gorz"]), ({"s1"}, ["s1.gorz"]), ({"nope"}, []), ({"s3"}, []), ({"s1", "s2", "s4"}, ["b1.gorz"])])
def test_choice_of_files(tags, want):
    assert paths(D.choose(D.parse(DICT, "/x/d.gord"), tags)) == want


def test_dropped_tags_stay_dropped_when_all_are_asked_for():  # DEV-2
    (s,) = D.scans(D.parse(DICT, "/x/d.gord"), ["s1", "s2", "s3", "s4"], [Window()])
    assert s.drop == {"s3"} and s.rows_tagged


def test_line_errors_and_headers():
    with pytest.raises(ValueError, match="GORD line 1: expected 2, 6 or 7"):
        D.parse("a\tb\tc\n", "d.gord")
    with pytest.raises(ValueError, match="bad position"):
        D.parse("a\tb\tchr1\tx\tchr1\t5\n", "d.gord")
    d = D.parse("## COLUMNS = chrom,pos,,val\n#file\tPN\na.gorz\tt\n", "d.gord")
    assert d.columns == ["chrom", "pos", "val"] and d.source_name == "PN"
    assert D.parse("#file,col2\na.gorz\tt\n", "d.gord").source_name is None
    assert D.parse("## SOURCE_COLUMN = who\na.gorz\tt\n", "d.gord").source_name == "who"


def test_inline_tags():
    d = D.parse("b.gorz\tx\tchr1\t1\tchr2\t9\tA,,B\nc.gorz\ty\tchr1\t1\tchr2\t9\tC\n", "/d.gord")
    assert d.entries[0].tags == ("A", "B") and d.entries[0].rows_tagged
    assert d.entries[1].tags == ("C",) and not d.entries[1].rows_tagged  # Q-10: column 7 wins over the alias


def test_untagged_lines_go_once_there_is_a_bucket():  # Q-14
    text = "a.gorz\t\nb.gorz|k.gorz\tt\n"
    assert [s.path for s in D.scans(D.parse(text, "/d"), [], [Window()])] == ["/b.gorz"]
    assert [s.path for s in D.scans(D.parse("a.gorz\t\nb.gorz\tt\n", "/d"), [], [Window()])] == ["/a.gorz", "/b.gorz"]


def test_order_and_range_pruning():  # D10, F15
    text = "a.gorz\ta\tchr2\t1\tchr2\t9\nb.gorz\tb\tchr1\t5\tchr1\t9\nc.gorz\tc\n"
    d = D.parse(text, "/d.gord")
    assert [s.path for s in D.scans(d, [], [Window()])] == ["/c.gorz", "/b.gorz", "/a.gorz"]
    assert [s.path for s in D.scans(d, [], [Window("chr1", 1, 4)])] == ["/c.gorz"]
    assert [s.path for s in D.scans(d, [], [Window("chr1", 9, 9)])] == ["/c.gorz", "/b.gorz"]


def test_thresholds(monkeypatch):  # D8 and the halving of the share
    lines = [f"f{i}.gorz|b{i % 10}.gorz\tt{i}" for i in range(250)]
    d = D.parse("\n".join(lines), "/d.gord")
    tags = {f"t{i}" for i in range(250) if i // 10 % 25 < 8}
    few = D.choose(d, tags, 1000)
    assert len(few) == 80
    assert len(D.choose(d, tags, 50)) == 10
    monkeypatch.setenv("GOR_BUCKET_INITIAL_USAGE_THRESHOLD", "10")
    assert len(D.scans(d, tags, [Window()])) == 10
    monkeypatch.setenv("GOR_BUCKET_INITIAL_USAGE_THRESHOLD", "oops")
    assert len(D.scans(d, tags, [Window()])) == 80


@given(st.integers(0, 10**6))
@settings(max_examples=60, deadline=None)
def test_the_choice_never_changes_the_tags_read(seed):  # the invariant of D7
    rng = random.Random(seed)
    n = rng.randint(1, 30)
    lines = []
    for i in range(n):
        bucket = rng.choice(["", "|b1.gorz", "|b2.gorz", "|b3.gorz"])
        deleted = bucket and rng.random() < 0.2
        lines.append(f"f{i}.gorz{'|D' if deleted else ''}{bucket}\tt{i}")
    d = D.parse("\n".join(lines), "/d.gord")
    asked = {f"t{i}" for i in range(n) if rng.random() < 0.6} or d.valid_tags
    for limits in ((100, 40), (0, 1), (1000, 99)):
        got = []
        for e in D.choose(d, asked, *limits):
            got += [t for t in e.tags if t in asked and t not in e.dropped_tags]
        assert sorted(got) == sorted(asked & d.valid_tags)


def test_paths():  # D5, DEV-4
    assert files.resolve("/a/b", "../c/x.gorz") == "/a/c/x.gorz"
    assert files.resolve("/a/b", "/abs/x.gorz") == "/abs/x.gorz"
    assert files.resolve("s3://bucket/dir", "x.gorz") == "s3://bucket/dir/x.gorz"
    assert files.resolve("s3://bucket/dir", "../y/x.gorz") == "s3://bucket/y/x.gorz"
    assert files.resolve("/a", "s3://bucket/x.gorz") == "s3://bucket/x.gorz"


def test_search_path(tmp_path):  # S15
    (tmp_path / "x.gorz").write_text("")
    assert files.search("x.gorz", f"/nowhere,{tmp_path}") == f"{tmp_path}/x.gorz"
    assert files.search("y.gorz", f"{tmp_path}") == "y.gorz"


def test_meta():  # S13
    m = sidecars.parse_meta(b"## SCHEMA = S,i,null,D,Long\n## LINE_COUNT = 12\n# other\n## SOURCE_COLUMN = PN\n")
    assert m.schema == [T.StringType(), T.IntegerType(), None, T.DoubleType(), T.LongType()]
    assert m.line_count == 12 and m.source_column == "PN"
    with pytest.raises(ValueError, match="unknown SCHEMA type"):
        sidecars.parse_schema("S,Q")


def test_index():  # S12
    i = sidecars.parse_index(b"## fileformat=GORIv2\nchr1\t10\t100\nchr1\t20\t200\nchr2\t5\t300\n")
    assert i.window(50, (b"chr1", 15), (b"chr1", 18)) == (100, 200)
    assert i.window(50, (b"chr1", 10), (b"chr1", 20)) == (50, 300)  # a key may go on in the next block
    assert i.window(50, (b"chr3", 1), (b"chr3", 2)) == (300, 300)
    assert sidecars.parse_index(b"## fileformat=GORIv1\nchr1\t10\t100\n") is None
    assert sidecars.parse_index(b"chr1\tx\t100\n") is None


def test_tag_file(tmp_path):  # S11
    p = tmp_path / "t.tsv"
    p.write_text("#PN\thdr\ns1\tx\n s2 \ty\n\n")
    assert sidecars.read_tags(str(p)) == ["s1", "s2"]
    with pytest.raises(OSError, match="cannot open"):
        sidecars.read_tags(str(tmp_path / "missing"))


def test_tokens_keep_every_character():
    sql = "SELECT 'it''s -- no', \"a b\", `c` /* read_gor('x') */ FROM t -- end\nWHERE x >= 1.5"
    assert "".join(t.text for t in tokens(sql)) == sql


def test_rewrite():
    made = []

    def view(kind, options):
        made.append((kind, options))
        return f"v{len(made)}"

    got = rewrite("SELECT 'FROM ''x.gorz''' FROM read_gord('d.gord', f := ['a', NULL, 'b'], range := 'chr1') a JOIN 'x.GORZ' b, read_gor ( 'y.gorz', source => 'PN' )", view)
    assert got.endswith("FROM v1 a JOIN v2 b, v3")
    assert made == [("gord", {"path": "d.gord", "f": '["a", "b"]', "range": "chr1"}), ("gor", {"path": "x.GORZ"}), ("gor", {"path": "y.gorz", "source": "PN"})]
    assert rewrite("SELECT 1 FROM 'x.csv'", view) == "SELECT 1 FROM 'x.csv'"
    assert rewrite("SELECT read_gor FROM t", view) == "SELECT read_gor FROM t"
    for bad in ("(SELECT 1)", "1, 'x'", "'a', wrong := 'b'", "'a', f := (SELECT 1)"):
        with pytest.raises(ValueError):
            call_options(tokens(bad))


def test_copy():
    c = parse_copy("COPY (SELECT * FROM t ORDER BY a, b) TO '/x/y.gorz' (FORMAT gorz, INDEX true);")
    assert (c.query, c.path, c.format, c.options) == ("SELECT * FROM t ORDER BY a, b", "/x/y.gorz", "gorz", {"index": "true"})
    assert parse_copy("copy t to 'z.gor'").format == "gor"  # W3
    assert parse_copy("SELECT 1") is None
