import pytest
from odd_documents import odd_texts

#: Columns of documents, one with a name that operators use inside, one that is null throughout.
NAMES = "doc_id long, text string, lang string, source string, n_chars long, n_lines int, _doc string"


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i * 3 - 6, t, "en" if i % 2 else None, f"src{i % 3}" if i % 4 else "src0", len(t or ""), 1, None) for i, t in enumerate(odd_texts())]
    rows += [rows[5], rows[12], rows[12], (None, "no id", None, None, None, None, None), (None, None, None, None, None, None, None), (rows[20][0], "another text of a known id", "en", "src1", 5, 1, None)]
    return spark.createDataFrame(rows, NAMES).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], NAMES)
