from orgmill.operators import classify


def test_a_text_is_lowered_once_for_all_keywords_of_a_table(spark):
    df = spark.createDataFrame([("A School with IELTS kurslar",), (None,), (" Litsey ",)], "text string").selectExpr("text", "string(null) AS type", "array(string(null)) AS categories").withColumn("categories", classify.F.lit(None).cast("array<string>"))
    found = classify.infer_labels(df, ["text"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.count("lower(") <= 3  # one for each keyword, and within a loop over keywords, before
    assert [(r["type"], r["categories"]) for r in found.collect()] == [("SCHOOL", ["IELTS"]), (None, []), ("LYCEUM", [])]
