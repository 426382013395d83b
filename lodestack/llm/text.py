"""Small text helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space of every word rule, as bytes.split() takes it.
WHITE = r"\x20\x09-\x0D"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: bytes.translate table that lower-cases A-Z alone.
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: str | None) -> list[bytes]:
    """UTF-8 words between ASCII white space, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER_BYTES).split() if text else []
