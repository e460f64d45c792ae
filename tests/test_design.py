"""Designs over documents: what is skipped, and what fails the job."""

import pytest
from pyspark.sql import functions as F

from loomgraph.operators import design


def documents(spark):
    return spark.createDataFrame([("a", '{"k": 1, "t": "x"}'), ("b", '{"t": 2}'), ("c", "{}")], "id string, text string").withColumn("doc", F.try_parse_json("text"))


def test_missing_paths_and_other_types_are_skipped(spark):
    entries = [design.Entry("k", F.try_variant_get("doc", "$.k", "bigint"), "long"), design.Entry("t", F.try_variant_get("doc", "$.t", "string")), design.Entry("n", F.try_variant_get("doc", "$.t", "bigint"), "long")]
    records, attributes = design.apply_design(documents(spark), design.Design(F.col("id"), entries))
    assert {r.record_id for r in records.collect()} == {"a", "b", "c"}
    assert {(r.record_id, r.key, r.value) for r in attributes.collect()} == {("a", "k", "1"), ("a", "t", "x"), ("b", "t", "2"), ("b", "n", "2")}


def test_a_malformed_path_fails_the_job(spark):
    entries = [design.Entry("k", F.try_variant_get("doc", "$.[k", "string"))]
    with pytest.raises(Exception, match="(?i)path"):
        design.apply_design(documents(spark), design.Design(F.col("id"), entries))[1].collect()


def test_many_designs_read_the_documents_once(spark, tmp_path):
    spark.range(20).select("id", F.concat(F.lit("n"), "id").alias("name")).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    designs = [design.Design(F.concat(F.lit(p), "id"), [design.Entry("name", F.col("name")), design.Entry("even", F.when(F.col("id") % 2 == 0, F.lit("yes")))], skip=F.col("id") % k == 0, kind=p) for p, k in (("a", 2), ("b", 3), ("c", 50))]
    records, attributes = design.run_designs(docs, designs)
    for made in (records, attributes):
        assert made._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    apart = [design.apply_design(docs, d) for d in designs]
    for found, wanted in ((records, [r for r, _ in apart]), (attributes, [a for _, a in apart])):
        assert sorted(map(tuple, found.collect())) == sorted(tuple(r) for w in wanted for r in w.collect())
