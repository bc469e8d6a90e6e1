"""Type inference, violations, catalog comments and views on small tables."""

import pytest
from conftest import claims_df, medical_df, raw_claim
from pyspark.sql import functions as F

from casegrade.operators import quality as Q
from casegrade.operators.inference import inferred_types, merged, type_counts
from casegrade.operators.staging import stage_claims, stage_medical
from casegrade.plans import catalog
from casegrade.session import qualified, scratch_dir


def types(counts, tolerance=0.0):
    return {r.column_name: (r.inferred_type, r.n_values, r.n_failing) for r in inferred_types(counts, tolerance).collect()}


def test_types_are_the_narrowest_that_hold_the_values(spark):
    columns = {"zeros": ["007", "12"], "int": [" 7 ", "-12"], "big": ["7", "3000000000"], "real": ["1", "2.5e3"],
               "huge": ["1", "99999999999999999999"], "day": ["2026-01-05", " 2026-02-28"], "no_day": ["2026-02-30", "2026-01-01"],
               "flag": ["TRUE", "false"], "mixed": ["1", "true"], "blank": ["", " "], "none": [None, None], "plus": ["+1", "2"],
               "odd.name`x": ["1", None]}
    rows = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"c{i} string" for i in range(len(columns)))).toDF(*columns)
    got = types(type_counts(rows, list(columns)))
    assert {c: k for c, (k, _, _) in got.items()} == {
        "zeros": "text", "int": "int", "big": "bigint", "real": "double", "huge": "double", "day": "date", "no_day": "text",
        "flag": "boolean", "mixed": "text", "blank": "text", "none": "text", "plus": "text", "odd.name`x": "int"}
    assert got["blank"] == ("text", 0, 0) and got["odd.name`x"] == ("int", 1, 0)


def test_counts_of_parts_add_up_and_a_share_may_fail(spark):
    rows = spark.createDataFrame([(str(i) if i % 10 else "unknown", i) for i in range(100)], "v string, n int")
    parts = [type_counts(rows.filter(F.col("n") % 3 == i), ["v"]) for i in range(3)]
    whole = type_counts(rows, ["v"])
    counts = merged(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    for tolerance, want in ((0.0, ("text", 100, 0)), (0.09, ("text", 100, 0)), (0.1, ("int", 100, 10))):
        assert types(whole, tolerance)["v"] == types(counts, tolerance)["v"] == want
    assert types(type_counts(rows.limit(0), ["v"]))["v"] == ("text", 0, 0)


def test_violations_of_all_tests(spark):
    claims = stage_claims(claims_df(spark, [raw_claim("A", body=None), raw_claim("A", body=None), raw_claim("B", date="x"), raw_claim("C")]))
    events = stage_medical(medical_df(spark, [("A", [("surgery", "2026-01-01"), ("yoga", "x"), ("yoga", "x")], None, "f")]))
    got = {tuple(r) for r in Q.all_violations({"stg_claims": claims, "stg_medical_activity": events}).collect()}
    assert got == {
        ("stg_claims", "body_part", "not_null", "A", None, 2), ("stg_claims", "date_of_loss", "not_null", "B", None, 1),
        ("stg_claims", "claim_id", "unique", "A", "A", 2),
        ("stg_medical_activity", "event_type", "accepted_values", "A", "yoga", 2),
        ("stg_medical_activity", "event_date", "not_null", "A", None, 2)}


def test_views_have_the_rows_of_the_staging_functions(spark):
    d = scratch_dir(spark, "t-views")
    claims = claims_df(spark, [raw_claim(" A ", body=" Knee "), raw_claim("", body="x"), raw_claim(None), raw_claim("B", date="x", lit="maybe", priors="7"),
                               raw_claim("C", lit="TRUE", priors="many", rescued="{}")])
    medical = medical_df(spark, [("A", [(" Surgery ", "2026-01-01"), (" ", "x"), None], None, "f"), (" ", [("x", None)], None, "f"),
                                 ("B", [], None, "f"), ("C", None, "{}", "f"), (None, [("x", "y")], None, "f")])
    from casegrade.schemas import RAW_CLAIMS, RAW_MEDICAL
    catalog.setup_namespaces(spark)
    for name, schema, df in (("bronze.raw_claims", RAW_CLAIMS, claims), ("bronze.raw_medical_activity", RAW_MEDICAL, medical)):
        df.select(*schema.fieldNames()).write.parquet(f"{d}/{name}")
        spark.sql(f"drop table if exists {name}")
        catalog.register_table(spark, name, schema, f"{d}/{name}")
    for view, stage in (("silver.stg_claims", stage_claims), ("silver.stg_medical_activity", stage_medical)):
        catalog.register_view(spark, view)
        source = "bronze.raw_claims" if stage is stage_claims else "bronze.raw_medical_activity"
        staged = stage(spark.table(source))
        rows = sorted(map(str, spark.table(view).select(*staged.columns).collect()))
        assert rows == sorted(map(str, staged.collect())) and rows
    spark.sql("drop table bronze.raw_claims")
    spark.sql("drop table bronze.raw_medical_activity")


def test_a_shared_folder_without_a_scheme_is_on_the_default_file_system(spark):
    assert qualified(spark, "/some/folder") == "file:/some/folder"
    assert qualified(spark, "hdfs://host/some") == "hdfs://host/some" and qualified(spark, "file:/x") == "file:/x"
    with pytest.raises(Exception):
        qualified(spark, "")
