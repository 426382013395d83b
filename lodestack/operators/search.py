"""Ranked search over names: scores, order and highlighted matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Where parts of a name begin, and where whole words end.
PARTS = r"[\s_().,-]+"
WORDS = r"[\s()]+"


def score(name: Column, hay: Column, query: str, is_item: Column) -> Column:
    """Score of a row whose text holds every word of the query, else null; name, hay and query are in search form (``text.search_form``).

    The name itself 100, a name that begins so 80, every word begins a part of the name 60, every word inside it
    40, elsewhere 10; 10 more if every word is a whole word of the name, 5 more for items.
    """
    words, whole = query.split(), query.strip()
    every = lambda test: F.forall(F.array(*[F.lit(w) for w in words]), test)
    begins = every(lambda w: F.exists(F.split(name, PARTS), lambda p: F.startswith(p, w)))
    inside = every(lambda w: F.contains(name, w))
    base = F.when(name == whole, 100).when(F.startswith(name, F.lit(whole)), 80).when(begins, 60).when(inside, 40).otherwise(10)
    exact = F.when(every(lambda w: F.array_contains(F.split(name, WORDS), w)), 10).otherwise(0)
    return F.when(every(lambda w: F.contains(hay, w)), base + exact + F.when(is_item, 5).otherwise(0))


def rank(rows: DataFrame, key: str, name: str, technical: Column, most: int) -> DataFrame:
    """Best rows by (technical last, score, name, key); a bounded top-k, not a sort of the table."""
    return rows.orderBy(technical, F.desc("score"), F.lower(name), key).limit(most)


def highlighted(text: Column, form: Column, query: str) -> Column:
    """The text with every run of matched characters in brackets; ``form`` is its search form, character for character."""
    places = lambda w: F.filter(F.sequence(F.lit(1), F.greatest(F.length(form), F.lit(1))), lambda i: F.substr(form, i, F.lit(len(w))) == w)

    def covered(w: str) -> Column:
        last = len(w) - 1
        return F.flatten(F.transform(places(w), lambda i: F.sequence(i, i + last)))

    hit = F.flatten(F.array(*[covered(w) for w in query.split()]))

    def drawn(marks: Column) -> Column:
        on = lambda i: F.array_contains(marks, i)
        return F.array_join(
            F.transform(
                F.sequence(F.lit(1), F.length(text)),
                lambda i: F.concat(F.when(on(i) & ~on(i - 1), "[").otherwise(""), F.substr(text, i, F.lit(1)), F.when(on(i) & ~on(i + 1), "]").otherwise("")),
            ),
            "",
        )

    return F.when(F.length(text) == 0, text).otherwise(F.get(F.transform(F.array(hit), drawn), F.lit(0)))
