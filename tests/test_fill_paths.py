"""The gap fill's join by one path column."""

from taxaweave.operators.fill import hierarchical_fill


def test_rows_join_their_path_by_one_column_and_keep_odd_values(spark):
    order = {"family": ["genus"], "tribe": ["genus", "family"]}
    rows = [
        (1, "g", "f", None), (2, "g", None, "t"), (3, None, "b", None), (4, "b", None, None),
        (5, None, None, "b"), (6, "a\x00", "x", None), (7, "a", None, "y"), (8, "g", "f", None),
        (9, None, None, None), (10, "b", "", ""),
    ]
    df = spark.createDataFrame(rows, "id int, genus string, family string, tribe string")
    out = hierarchical_fill(df, order)
    got = {r.id: (r.genus, r.family, r.tribe) for r in out.collect()}
    assert got == {
        1: ("g", "f", "t"), 2: ("g", "f", "t"), 3: (None, "b", None), 4: ("b", "", ""), 5: (None, None, "b"),
        6: ("a\x00", "x", None), 7: ("a", None, "y"), 8: ("g", "f", "t"), 9: (None, None, None), 10: ("b", "", ""),
    }
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    last = next(line for line in plan.splitlines() if "Join" in line)
    assert "<=>" not in last and "__path" in last  # one column, not a condition for each of the path's


def test_fill_of_other_types_joins_by_the_columns(spark):
    df = spark.createDataFrame([(1, 7, "t"), (2, 7, None), (3, None, None)], "id int, genus int, tribe string")
    got = {r.id: (r.genus, r.tribe) for r in hierarchical_fill(df, {"tribe": ["genus"]}).collect()}
    assert got == {1: (7, "t"), 2: (7, "t"), 3: (None, None)}
