import random

import pytest

from orderloom.llm.common import table

CLASHING = (
    "score string, size string, taken string, times string, fingerprint string, codes string, "
    "set_id string, root string, node string, row string, _row string, _ids string, proposed string, "
    "Piece_Ids string, n_pieces string, block string, held_out string, _statistics string, part string, "
    "`a.b` string, __text string, word string, rank string"
)
COLUMNS = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


@pytest.fixture
def make(spark):
    """Documents from (id, text, lang, source), with other columns whose names clash."""

    def build(rows):
        extra = ["x"] * len(CLASHING.split(","))
        full = [
            (i, t, la, s, None if t is None else len(t), *extra) for i, t, la, s in rows
        ]
        return spark.createDataFrame(full, COLUMNS).repartition(3)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, repeated rows, no letters."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    base = prose(120)
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", "en", None), (4, "one", None, "b"),
        (5, "one", "fr", "b"), (None, "no id at all", "en", "b"), (None, None, None, None),
        (7, base, "en", "a"), (7, base, "en", "a"), (8, base + " and more", "en", "c"),
        (None, base, "en", "c"), (9, base.upper(), "de", "c"), (10, prose(30_000), "en", "c"),
        (11, "x" * 200_000, "en", "c"), (12, "12 34 !!", "en", "c"), (13, "日本 é\u0000😀 ▁", "fr", "d"),
        (2**62, prose(50), "de", "d"), (-5, prose(7), "fr", "d"),
    ]
    return rows + [(100 + k, prose(rng.randint(0, 90)), rng.choice(["en", "fr"]), "e") for k in range(60)]


@pytest.fixture(scope="session")
def small_docs():
    """Documents of the smallest test tables as (id, text, lang, source)."""
    import duckdb

    return duckdb.sql(
        "select doc_id, text, lang, source from '/root/testdata/sf0.001/documents.parquet'"
    ).fetchall()


@pytest.fixture
def documents(spark):
    return table(spark, "/root/testdata/sf0.001", "documents")


@pytest.fixture
def labels(spark):
    return table(spark, "/root/testdata/sf0.01", "labels")
