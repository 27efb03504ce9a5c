"""Titles that look the same."""

import ahocorasick  # noqa: F401

from lexaloom.llm import lookalike


def test_pairs(spark):
    rows = [
        (1, 1, "Café Notes"), (1, 2, "Café Notes"), (1, 3, "Ｃafé Notes"), (1, 4, "Cafe Notes"), (1, 5, "café notes"), (1, 6, "Café Notes"),
        (2, 7, "Café Notes"), (1, 8, None), (1, 9, ""), (1, 10, "​"), (1, 11, "Sum­mary"), (1, 12, "Summаry"), (1, 13, "Summary?"), (1, 14, "Oﬃce"), (1, 15, "Office"),
        (None, 16, "Office"), (1, 17, "  Office "), (1, 15, "Office"),
    ]
    x = spark.createDataFrame([(*r, "z") for r in rows], "g int, id long, title string, form string")
    got = {tuple(r) for r in lookalike.look_alike_pairs(x, "g", "id", "title").collect()}
    same = [{1, 2, 3, 6}, {11, 12}, {14, 15, 17}]
    spelled = {r[1]: r[2] for r in rows}
    want = {(a, b) for s in same for a in s for b in s if a < b and spelled[a] != spelled[b]}
    assert got == want


def test_one_form_and_edges(spark):
    x = spark.createDataFrame([("ＡＢ",), ("AB",), ("AB",), (None,), ("",), ("​",)], "t string")
    got = [r.f for r in lookalike.one_form_column(x, "t", "f").collect()]
    assert got == ["AB", "AB", "AB", None, "", ""]
    assert lookalike.one_form_column(x.limit(0), "t", "f").count() == 0
    assert lookalike.look_alike_pairs(spark.createDataFrame([], "g int, id long, title string"), "g", "id", "title").count() == 0


def test_most_frequent_member_stands_for_its_class(spark):
    got = lookalike.rewriting([("а", 5), ("a", 2)])
    assert got["a"] == "а"
