"""Every registered query and every stage on tables whose columns bear the names that the operators add, with nulls, repeated rows and none at all."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from odd_documents import odd_texts

import corpus_pipeline
import public_tokenizers
from locuspark.llm import queries
from locuspark.llm.html_extract import main_text

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that results bear, some in other cases, and names that need quoting.
TAKEN = "n_words n_removed n_lines n_dropped word_chars n_symbols n_dup_lines n_repeat_words n_stop_words n_upper n_exclaimed base_failed KEPT kept_sha256 fingerprint component_id score predicted held_out keep_id group_size text_sha256 ids decoded tokens n_tokens start ids_crc32 bin_id piece n_units _doc _text _t _n _spans _c0".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = DOCS + ", " + ", ".join(f"{n} int" for n in TAKEN) + ", `a.b` string, `c``d` int"


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """The same rows with plain and with clashing columns, and empty tables of both kinds."""
    base = tmp_path_factory.mktemp("tables")
    texts = odd_texts()
    rows = [(i, t, "en", f"src{i % 3}" if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[12], rows[12], (None, "no id", None, None, None), (None, None, None, None, None), (20, "another text of a known id", "en", "src1", 5)]
    pages = [(1, "u", "<article><p>One &amp; two</p></article>"), (1, "u", "<article><p>One &amp; two</p></article>"), (None, None, None), (2, "v", "")]
    labels = [(i, int(len(texts[i] or "") > 60), 0) for i in range(0, len(texts), 2)] + [(2, 0, 1), (None, 1, 0)]
    more = [*[-7] * len(TAKEN), "x", -7]
    out = {}
    for kind, extra in (("plain", False), ("clash", True)):
        for amount in ("full", "empty"):
            at = out[kind, amount] = f"{base}/{kind}-{amount}"
            on = amount == "full"
            spark.createDataFrame([(*r, *more) if extra else r for r in rows * on], CLASH if extra else DOCS).repartition(2).write.parquet(f"{at}/documents.parquet")
            names = "page_id long, url string, html string" + (", text string, N_CHARS int, _html string, _n int" if extra else "")
            spark.createDataFrame([(*r, "x", -7, "y", -7) if extra else r for r in pages * on], names).write.parquet(f"{at}/pages.parquet")
            names = "doc_id long, quality int, toxic int" + (", held_out boolean, score double, _y int, _id long" if extra else "")
            spark.createDataFrame([(*r, True, 0.5, -7, -7) if extra else r for r in labels * on], names).write.parquet(f"{at}/labels.parquet")
    out["texts"] = [(r[0], r[1] or "") for r in rows]
    return out


CONTRACT = {
    "op1_quality_classifier": "doc_id held_out score predicted",
    "op2_substring_dedup": "doc_id n_words n_removed kept_sha256",
    "op3_simhash_near_dedup": "doc_id fingerprint component_id",
    "op4_line_dedup": "doc_id n_lines n_dropped kept_sha256",
    "op5_html_extract": "page_id url text n_chars",
    "op6_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op7_sentencepiece": "doc_id n_tokens ids_sha256 round_trip",
    "op8_token_output": "doc_id start n_tokens ids_crc32",
    "op9_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op10_best_fit_packing": "bin_id doc_id piece start n_units",
}


@pytest.mark.parametrize("name", CONTRACT)
def test_clashing_names_change_nothing(spark, folders, name):
    assert set(CONTRACT) == set(queries.QUERIES)
    run = lambda kind: queries.QUERIES[name](spark, folders[kind, "full"])
    plain, clash = run("plain"), run("clash")
    assert plain.columns == clash.columns == CONTRACT[name].split()
    rows = lambda df: Counter(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())
    got = rows(clash)
    assert got == rows(plain)
    if name != "op5_html_extract":
        assert {r[plain.columns.index("doc_id")] for r in got} == {d for d, _ in folders["texts"]}
    if name not in ("op5_html_extract", "op10_best_fit_packing"):
        assert sum(got.values()) == len(folders["texts"])
    empty = queries.QUERIES[name](spark, folders["clash", "empty"])
    assert empty.columns == plain.columns and empty.count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_with_sql_agree_with_it(spark, folders, name):
    """On rows with one text an id, which is what the SQL takes for granted."""
    at = folders["clash", "full"]
    con = duckdb.connect()
    con.execute(f"CREATE TABLE documents AS SELECT DISTINCT ON (doc_id) doc_id, text FROM (SELECT * FROM read_parquet('{at}/documents.parquet/*.parquet') WHERE doc_id IS NOT NULL ORDER BY doc_id, text) ORDER BY doc_id")
    once = f"{at}-once-{name}"
    spark.createDataFrame([(*r, -7, -7, True) for r in con.execute("SELECT doc_id, text FROM documents").fetchall()], "doc_id long, text string, n_words int, n_lines int, kept boolean").write.parquet(f"{once}/documents.parquet")
    out = queries.QUERIES[name](spark, once)
    want = con.execute(queries.SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(out.columns)
    assert Counter(map(tuple, out.select(*names).collect())) == Counter(want.fetchall())


def test_digests_of_tokens_pages_and_pieces(spark, folders):
    import sentencepiece
    from tokenizers import Tokenizer

    at = folders["clash", "full"]
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {(d, t): [*lib.encode(t, add_special_tokens=False).ids, 2] for d, t in folders["texts"]}
    got = queries.QUERIES["op8_token_output"](spark, at).collect()
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, len(ids[d, t]), crc(ids[d, t])) for d, t in folders["texts"])
    total = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == total
        total += r.n_tokens
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == sorted((d for d, _ in folders["texts"]), key=lambda x: (x is not None, x))
    pages = queries.QUERIES["op5_html_extract"](spark, at).collect()
    assert Counter((r.page_id, r.text, r.n_chars) for r in pages) == {(1, "One & two", 9): 2, (None, "", 0): 1, (2, "", 0): 1}
    assert main_text("<article><p>One &amp; two</p></article>") == "One & two"
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    digest = lambda t: hashlib.sha256(" ".join(map(str, pieces.encode(t))).encode()).hexdigest()
    got = queries.QUERIES["op7_sentencepiece"](spark, at).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.round_trip) for r in got) == Counter((d, len(pieces.encode(t)), digest(t), True) for d, t in folders["texts"])


@pytest.mark.parametrize("at", range(len(corpus_pipeline.STAGES)))
def test_stages_decide_alike_and_keep_the_columns(spark, folders, at):
    name, stage = corpus_pipeline.STAGES[at]
    plain, clash = (spark.read.parquet(f"{folders[k, 'full']}/documents.parquet") for k in ("plain", "clash"))
    a, b = stage(spark, plain, ""), stage(spark, clash, "")
    if name == "best-fit packing":
        assert a.columns == b.columns and Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))
        assert {r.doc_id for r in a.collect()} == {d for d, _ in folders["texts"]}
    else:
        assert a.columns == plain.columns and b.columns == clash.columns
        rows = Counter((r.doc_id, r.text, r.source, r.n_chars) for r in a.collect())
        assert rows == Counter((r.doc_id, r.text, r.source, r.n_chars) for r in b.collect())
        assert all(r["a.b"] == "x" and r["kept_sha256"] == -7 for r in b.collect())
        if name in ("quality rules", "SimHash near-dedup"):
            assert 0 < sum(rows.values()) < plain.count()
        else:
            assert sum(rows.values()) == plain.count()
    empty = spark.read.parquet(f"{folders['clash', 'empty']}/documents.parquet")
    out = stage(spark, empty, "")
    assert out.count() == 0 and out.columns == b.columns


def test_pipelines_of_one_session_keep_their_own_tables(spark, folders):
    first = corpus_pipeline.run(spark, folders["plain", "full"])
    second = corpus_pipeline.run(spark, folders["clash", "full"])
    a, b = (Counter(map(tuple, x.collect())) for x in (first, second))
    assert a == b and sum(a.values()) > 0
    assert corpus_pipeline.run(spark, folders["clash", "empty"]).count() == 0
