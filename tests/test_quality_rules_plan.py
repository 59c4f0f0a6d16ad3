"""Distances of the quality rules are worked out once per row."""


def test_each_distance_is_worked_out_once(spark):
    from zonelens.llm import quality_rules

    docs = spark.createDataFrame([(i, "the cat and the dog of it is on a mat " * 9, "en") for i in range(40)], "doc_id bigint, text string, lang string")
    out = quality_rules.measure(docs)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zip_with(") == 2
    assert out.filter("class_distance IS NOT NULL AND word_distance IS NOT NULL").count() == 40
