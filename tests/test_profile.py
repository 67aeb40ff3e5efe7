"""Profiles of columns: exact, sketched, and united from files."""

from millrace.operators.profile import cardinality_profile, column_sketches, merged_profile


def frame(spark):
    return spark.range(4_000).selectExpr(
        "CAST(id % 7 AS INT) AS file", "CAST(id AS STRING) AS `a.b`", "CASE WHEN id % 2 = 0 THEN 'x' END AS half", "CAST(NULL AS STRING) AS none", "CAST(id % 1500 AS STRING) AS many"
    )


def test_exact_profile_has_no_expand(spark):
    got = {r["column_name"]: (r["distinct_values"], r["ratio"], r["low"]) for r in cardinality_profile(frame(spark)).collect()}
    assert got == {"a.b": (4000, 1.0, False), "half": (1, 1 / 4000, True), "none": (0, 0.0, True), "many": (1500, 0.375, True)}
    assert "Expand" not in cardinality_profile(frame(spark))._jdf.queryExecution().executedPlan().toString()
    empty = {r["column_name"]: (r["distinct_values"], r["ratio"]) for r in cardinality_profile(frame(spark).where("false")).collect()}
    assert empty == {c: (0, None) for c in got}


def test_sketches_of_files_unite(spark):
    by_file = column_sketches(frame(spark), ["file"])
    assert by_file.count() == 7 * 4
    many = {r["column_name"]: (r["rows"], r["distinct_values"]) for r in merged_profile(by_file).collect()}
    once = {r["column_name"]: r["distinct_values"] for r in cardinality_profile(frame(spark), exact=False).collect()}
    assert {c: n for c, (_, n) in many.items()} == once and {rows for rows, _ in many.values()} == {4000}
    assert abs(once["a.b"] - 4000) < 200 and (once["half"], once["none"]) == (1, 0)
