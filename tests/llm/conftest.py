import pytest

#: One table with every awkward case: nulls, empty and long texts, repeated rows, ties, extra columns with clashing names.
LONG = "word " * 9000 + "\n" + "x" * 5000


@pytest.fixture(scope="session")
def odd_rows():
    base = "The quick brown fox jumps over the lazy dog and runs away from the very old house\n"
    return [
        (None, None, None),
        (None, "a null id with some text", "en"),
        (1, "", "en"),
        (2, None, "en"),
        (3, base * 3, "en"),
        (3, base * 3, "en"),
        (4, base * 3, None),
        (5, base + "tail of five", "de"),
        (6, base + "tail of six", "de"),
        (7, LONG, "en"),
        (8, "  \t\r\n \x0b\x0c", "fr"),
        (9, "漢字 émoji 💩 ▁ \x00 end", "zh"),
        (10, base + "tail of ten", "de"),
        (11, base.upper() + "tail of eleven", "de"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    rows = [(*r, "kept", 1, "row", 2) for r in odd_rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, id string, th int, row string, rank int")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter("false")
