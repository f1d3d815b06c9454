"""TOP1 / AGG3: ties, NULL policy, complete grids."""

from blotter.operators.crosstab import crosstab_long, crosstab_wide
from blotter.operators.ranking import top_categories, top_values


def test_topk_ties_and_null_policy(spark):
    rows = [("a",)] * 3 + [("b",)] * 2 + [("c",)] * 2 + [(None,)] * 5 + [("d",)]
    df = spark.createDataFrame(rows, "x string")
    # NULL competes for a slot and is removed after the cut
    assert top_values(df, "x", 3) == ["a", "b"]
    # tie between b and c broken by value ascending
    assert top_values(df, "x", 3, null_policy="drop_before") == ["a", "b", "c"]
    ranked = top_categories(df, "x", 10, null_policy="drop_before").orderBy("rank").collect()
    assert [(r.x, r.n, r.rank) for r in ranked] == [("a", 3, 1), ("b", 2, 2), ("c", 2, 3), ("d", 1, 4)]


def test_topk_per_group(spark):
    df = spark.createDataFrame([("A", "x")] * 2 + [("A", "y")] + [("C", "z")] * 3 + [("C", "y")],
                               "g string, v string")
    got = {(r.g, r.v, r.rank) for r in top_categories(df, "v", 1, by=["g"]).collect()}
    assert got == {("A", "x", 1), ("C", "z", 1)}


def test_crosstab_zero_fill_and_null_row(spark):
    df = spark.createDataFrame(
        [("r1", "a"), ("r1", "a"), ("r1", "b"), (None, "a"), ("r2", "zz")], "r string, c string")
    wide = {r.r: (r.a, r.b) for r in crosstab_wide(df, "r", "c", ["a", "b"]).collect()}
    # r2 has only an unlisted category: its row exists with zeros; NULL is a row key
    assert wide == {"r1": (2, 1), None: (1, 0), "r2": (0, 0)}
    long = crosstab_long(df, "r", "c", ["a", "b"], row_filter=["r1", "r2"])
    assert sorted((r.r, r.c, r.n) for r in long.collect()) == [
        ("r1", "a", 2), ("r1", "b", 1), ("r2", "a", 0), ("r2", "b", 0)]
