import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from tilelake.llm.common import ship

    ship(s)
    return s


#: Rows with nulls, empty and very long texts, ties, repeats and columns whose names clash with inner ones.
@pytest.fixture(scope="session")
def odd_docs(spark):
    long = " ".join(f"word{i % 977}" for i in range(30000))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta", "en", "a"),
        (2, "alpha  beta\tgamma delta epsilon zeta", "en", "b"),
        (3, None, None, None),
        (4, "", "de", "a"),
        (5, " \n\t ", "de", "a"),
        (6, long, "fr", "c"),
        (7, long + " tail", "fr", "c"),
        (8, "ein Wort", "de", "b"),
        (8, "ein Wort", "de", "b"),
        (9, "ALPHA BETA GAMMA DELTA EPSILON ZETA", "en", None),
        (10, "é" * 40 + " \U0001f600 x", None, "d"),
    ]
    extra = [(*r, len(r[1] or ""), "x", 1, "run", b"d", 0) for r in rows]
    return spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long, kept string, n int, run string, digest binary, bf_flag int")
