import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"

#: Texts every operator must take: NULL, empty, blank, no letters, one word, exotic white space and letters, long.
ODD = [None, "", " \n\t ", "12 34 !!", "word", "a b c\x1cd é É 你好 АБ",
       "<|endoftext|> it's 3.5 \U0001f389.", "x" * 5000, "long text here. " * 6000]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts, one row twice, a NULL id, and extra columns with clashing names."""
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(ODD)]
    rows += [rows[4], (None, "no id here", None, None, None), (50, ODD[8], "en", "s", 1)]
    return spark.createDataFrame(rows, DOC).selectExpr(
        "*", "1 AS score", "'x' AS fp", "'y' AS word", "2 AS grp", "'z' AS cell", "3 AS start", "4 AS row")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def sample(spark):
    """The smallest documents table and its rows in Python."""
    from ledgerhawk.llm.common import read
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    return docs, [(r.doc_id, r.text) for r in docs.collect()]
