"""Small tables for the operators: the awkward cases, and slices of none of the given tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from made_texts import sentence  # noqa: E402

AWKWARD = [
    (0, None, "en", "a"), (1, "", "en", "a"), (2, " \n\t ", None, None), (3, "one", "en", "b"), (4, "Ünï cödé, très bien. Это тест 漢字", "fr", "b"),
    (5, sentence(1, 300), "en", "b"), (6, sentence(1, 300), "en", "a"), (7, sentence(1, 299) + " changed", "en", None),
    (8, sentence(2, 4000), "de", "c"), (9, "x" * 30000, "de", "c"), (10, "a  b\n\n c \n \n d!! e's 12 <|endoftext|> ", "es", "c"),
    (11, sentence(3, 120) + " " + sentence(9, 70) + " " + sentence(4, 120), "en", "a"),
    (12, sentence(5, 120) + " " + sentence(9, 70) + " " + sentence(6, 120), "en", "a"),
    (13, "same same " * 200, "en", "b"), (14, sentence(7, 40), "en", "a"), (14, sentence(7, 40), "en", "a"), (15, "a\nb\n" * 3000, None, "b"),
]
KIND = "doc_id long, text string, lang string, source string, n_chars long, shard string, `size` int, _block string"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, and columns with names that operators use."""
    rows = [(*r, None if r[1] is None else len(r[1]), "x", 1, None) for r in AWKWARD]
    return spark.createDataFrame(rows, KIND).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], KIND)


@pytest.fixture(scope="session")
def as_folder(tmp_path_factory):
    """Write a table as ``documents`` and give the folder."""

    def write(df):
        folder = str(tmp_path_factory.mktemp("tables"))
        df.write.parquet(f"{folder}/documents.parquet")
        return folder

    return write
