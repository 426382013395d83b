"""Behaviour that users of the catalog see: names, lint findings, search order, rings, ancestors, titles and directories."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lodestack.functions import text as X
from lodestack.operators import contracts, fixpoint, links, packing, resolve, search


def column(spark, values, make):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r.x for r in df.select("k", make(F.col("v")).alias("x")).orderBy("k").collect()]


def test_humanized_names(spark):
    names = ["HTTPServer", "BuildMat_02", "M4A1Rifle", "oldHitSet", "a/b\\c-d", "", "JSONToView", "aBCd"]
    assert column(spark, names, X.humanize) == [
        "Http server", "Build mat 02", "M4 a1 rifle", "Old", "A b c d", "Unnamed record", "Json toview", "A bcd",
    ]
    scenery = ["SM_Pine_LOD2", "PrefabPine", "sm_prefab_rock$12", "TreeLOD", "Rock_lOD0"]
    assert column(spark, scenery, lambda v: X.humanize(v, scenery=True)) == ["Pine", "Pine", "Rock", "Tree lod", "Rock"]


TEXTS = [
    "plain words only", "see bundles/abc.bundle now", "value 0.123456 and 1.23456 not 1.2345", "key deadbeef01 e-12 12345678", "BuildMat and snake_case and M4A1 AK74M",
    "file.cs and a.b.c path/to/file.txt", "x::serialized y", "_private __x A_ b", "", "v1.234567.5", "deadbeef.txt 0xDEADBEEF",
]


def findings(text):
    """By definition: rules in order, overlaps with earlier findings dropped."""
    taken = []
    for rule, pattern in X.JARGON.items():
        flags = re.I if pattern.startswith(("(?iU)", "(?i)")) else 0
        for m in re.finditer(re.sub(r"^\(\?[iU]+\)", "", pattern), text, flags):
            if rule == "identifier" and not re.search(X.CODE, m[0]):
                continue
            if not any(m.start() < e and s < m.end() for s, e, r, _ in taken if r != "identifier"):
                taken.append((m.start(), m.end(), rule, m[0]))
    return sorted(taken)


def test_lint_findings_by_definition(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)) + [(99, None)], "id long, text string")
    got = {}
    for r in X.jargon_spans(df).collect():
        got.setdefault(r.id, []).append((r.start, r.end, r.rule, r.match))
    assert {k: sorted(v) for k, v in got.items()} == {k: findings(t) for k, t in enumerate(TEXTS) if findings(t)}
    assert {x[2] for v in got.values() for x in v} == {"path", "raw_float", "hex", "identifier"}
    coded = spark.createDataFrame([(1, " 12 "), (2, "12 apples")], "id long, text string")
    assert [(r.id, r.rule, r.match) for r in X.jargon_spans(coded, F.lit(True)).collect()] == [(1, "raw_enum", "12")]


def test_search_ranks_words_in_any_order(spark):
    names = ["old small", "old small axe", "small old axe", "boldly smaller", "axe", "Ölträger old small", "small"]
    df = spark.createDataFrame([(k, n) for k, n in enumerate(names)], "k int, name string").withColumn("n", X.search_form("name"))
    hay = F.concat(F.col("n"), F.when(F.col("k") == 4, " old small").otherwise(""))
    got = {r.name: r.s for r in df.select("name", search.score(F.col("n"), hay, "old small", F.col("k") == 2).alias("s")).collect()}
    assert got == {"old small": 110, "old small axe": 90, "small old axe": 75, "boldly smaller": 40, "axe": 10, "Ölträger old small": 70, "small": None}
    assert column(spark, ["Ölträger"], X.search_form) == ["oltrager"]


def test_highlighted_runs_join(spark):
    made = lambda v: search.highlighted(v, F.lower(v), "old ldb")
    assert column(spark, ["Goldbar old", "none", ""], made) == ["G[oldb]ar [old]", "none", ""]


def test_identifiers_match_only_where_code_is(spark):
    """The pattern alone finds the tokens that the definition keeps, and prose gives no matches at all."""
    pick = random.Random(4)
    texts = ["".join(pick.choice("abAB_0 .é") for _ in range(pick.randrange(30))) for _ in range(2000)] + ["plain Words of PROSE 12"]
    want = [[m[0] for m in re.finditer(X.JARGON["identifier"], t) if re.search(X.CODE, m[0])] for t in texts]
    assert column(spark, texts, lambda v: F.regexp_extract_all(v, F.lit(X.CODED), F.lit(0))) == want and want[-1] == []


def test_rings_follow_benches_crafting_and_dismantling(spark):
    recipes = spark.createDataFrame([(1, 10, None, True), (2, 11, 7, True), (3, 12, 8, True), (4, 13, None, False)], "recipe long, output long, bench long, complete boolean")
    ingredients = spark.createDataFrame([(1, 1), (1, 2), (2, 10), (3, 11), (4, 1)], "recipe long, item long")
    benches = spark.createDataFrame([(7, None, True), (8, 11, False), (9, None, False)], "bench long, construction_item long, hand boolean")
    sources = spark.createDataFrame(
        [(1, "mined", None, 0), (1, "looted", None, 2), (2, "mined", None, 1), (10, "crafted", 1, None), (11, "crafted", 2, None), (12, "crafted", 3, None), (13, "crafted", 4, None), (20, "dismantled", 12, None)],
        "item long, type string, via long, ring long",
    )
    best = spark.createDataFrame([(2, 3)], "item long, ring long")
    got = {(r.kind, r.key): (r.earliest_ring, r.main_ring) for r in fixpoint.reachable_rings(recipes, ingredients, benches, sources, best).collect()}
    assert got[("item", "1")] == (0, 2) and got[("item", "2")] == (1, 3)
    for node in (("item", "10"), ("recipe", "2"), ("item", "11"), ("bench", "8"), ("item", "12"), ("item", "20")):
        assert got[node] == (1, 3)
    assert got[("bench", "7")] == (0, 0) and not {("item", "13"), ("bench", "9"), ("recipe", "4")} & set(got)


def test_base_runs_and_cycles(spark):
    runs = [(1, None, "a"), (2, 1, "a"), (3, 2, "b"), (4, 3, "b"), (5, 4, "b"), (6, 7, "c"), (7, 6, "c"), (8, 99, "d")]
    got = {r.run: (r.base, r.state) for r in links.nearest_ancestor(spark.createDataFrame(runs, "run long, parent long, snapshot string")).collect()}
    assert got == {1: (None, "none"), 2: (None, "none"), 3: (2, "base"), 4: (2, "base"), 5: (2, "base"), 6: (None, "cycle"), 7: (None, "cycle"), 8: (None, "none")}


def test_titles_match_normalized_and_unique(spark):
    entities = spark.createDataFrame([(1, "Iron  Ingot"), (2, "ﬁsh"), (3, "axe"), (4, "none"), (5, "hidden"), (6, None)], "id long, name string")
    titles = spark.createDataFrame([("Items/Iron_Ingot",), ("Wiki:Items/FISH",), ("Items/Axe",), ("Items/Tools/axe",), ("Other/hidden",)], "title string")
    told = lambda **kw: {r.id: (r.status, r.reason, r.title) for r in links.title_match(entities, titles, ["Items", "Wiki:Items"], **kw).collect()}
    assert told() == {
        1: ("matched", "exact-title", "Items/Iron_Ingot"), 2: ("matched", "exact-title", "Wiki:Items/FISH"), 3: ("unavailable", "ambiguous-title", None),
        4: ("missing", "no-exact-title", None), 5: ("missing", "no-exact-title", None), 6: ("missing", "no-exact-title", None),
    }
    assert set(told(complete=False).values()) == {("unavailable", "incomplete-index", None)}


def test_absence(spark):
    states = spark.createDataFrame(
        [(1, "gone", False, "o", "s", None), (2, "k", True, "o", "s", "x"), (3, "k", False, "b#1", "t", "x"), (4, "k", False, "b#1", "s", "x"), (5, "k", False, "o", "s", "y"), (6, "k", False, "o", "s", None), (7, "k", False, "p", "s", None)],
        "key long, kind string, summary boolean, source_object string, scope string, anchor string",
    )
    one = lambda v: spark.createDataFrame([(v,)], "v string")
    got = {r.key: r.status for r in resolve.absence(states, one("k"), one("s"), one("x"), one("o")).collect()}
    assert got == {1: "uncaptured", 2: "not-present", 3: "uncaptured", 4: "unresolved", 5: "not-present", 6: "unresolved", 7: "not-present"}


def test_directories_cover_all_keys_level_by_level(spark):
    rows = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("key"), F.lit(10).alias("size"))
    got = packing.directory(rows, limit=200, page_limit=100, entry_bytes=20).collect()
    levels = sorted({r.level for r in got})
    assert len(levels) > 2 and len([r for r in got if r.level == levels[-1]]) == 1
    for level in levels:
        page = [r for r in got if r.level == level]
        assert sum(r["count"] for r in page) == 3000 and all(r.entries * 20 <= 100 or level == 0 for r in page)
        order = sorted((r.first, r["last"]) for r in page)
        assert all(a[1] < b[0] for a, b in zip(order, order[1:]))


def test_evidence_must_be_there_once(spark):
    rows = spark.createDataFrame([("a",)], "k string")
    known = spark.createDataFrame([("a", 1)], "k string, v long")
    assert links.require(rows, known, "k").collect()[0].v == 1
    for wrong in (known.filter("false"), known.union(known)):
        with pytest.raises(ValueError):
            links.require(rows, wrong, "k")


def test_sentinel_numbers(spark):
    made = lambda v: contracts.sentinel_number(F.parse_json(v))
    assert [tuple(x) for x in column(spark, ["1.5", '{"float":"nan"}', "true"], made)] == [(1.5, None), (None, "nan"), (None, None)]
