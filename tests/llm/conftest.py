import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

PASSAGE = " ".join(f"word{i} of the shared passage" for i in range(12))
ODD = [
    (None, "a text without an id\nand a second line of it"),
    (1, None),
    (2, ""),
    (3, " \t\n  \x0b"),
    (4, "short"),
    (5, PASSAGE + "\nand a line of its own here"),
    (6, "Something in front. " + PASSAGE + " And something behind it, to be sure."),
    (6, "Something in front. " + PASSAGE + " And something behind it, to be sure."),  # a repeated row
    (7, PASSAGE + "\nAND A LINE OF ITS OWN HERE "),
    (8, "x" * 250),
    (9, "xy" * 400 + " é中𓀀 ▁ " + "xy" * 60),
    (10, " ".join(f"w{i % 500}" for i in range(30000))),  # a very long text that repeats itself
    (11, " ".join(f"w{i % 500}" for i in range(700)) + "\nshort\nshort\n\n"),
    (12, PASSAGE.replace("word5", "other")),
    (13, "one two three four"),
    (14, "one two three four"),
]
SCHEMA = "part string, doc_id long, text string, lang string, source string, n_chars long, id int, n double, shingle string, rank int"


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with columns whose names the operators use themselves."""
    rows = [("p", d, t, "en" if d else None, "s", len(t or ""), 1, 1.0, "x", 5) for d, t in ODD]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_rows():
    return ODD


@pytest.fixture(scope="session")
def table(spark, sf):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
