import random

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
# Extra columns bear names that the operators use inside.
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, digest string, kept boolean, "
        "__id long, slot int, ids string, score double")


def rows_of(pairs, lang="en"):
    return [(i, t, lang, None, None, "d", None, 7, None, "x", 0.5) for i, t in pairs]


def long_text(words=30_000, seed=3):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdeéß", k=draw.randint(1, 9))) for _ in range(words))


ODD = [(1, None), (2, ""), (3, "  \t\n"), (4, "one two three"), (4, "one two three"), (5, "one  two three"),
       (6, "ONE two▁three <|endoftext|> <0x41>"), (None, "no id"), (8, "x" * 5000), (9, "日本語 テキスト́ 🙂"),
       (10, "## %% 123"), (11, "tab\tand\r\nline  feeds \x0b\x0c end"),
       (13, "zero\0byte \0 and\0\0more"), (14, "½ ② Ⅷ 12²"), (15, "b<|endoftext|>c<|startoftext|>")]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every defined special case, and a long one."""
    return spark.createDataFrame(rows_of([*ODD, (12, long_text())]), DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def con():
    connection = duckdb.connect()
    for name in "documents embeddings pages benchmark labels conversations".split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection
