"""While tables are stored, the driver holds no side of a join, however small its file looks."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from foliate.plans import catalog, family_queries, lineage, tables

DATA = "/root/testdata/sf0.001"


def planned(df):
    """The plan by which a table is made of ``df``."""
    with lineage.joined_as_dealt(df.sparkSession):
        return df.select("*")._jdf.queryExecution().executedPlan().toString()


def test_exploded_lists_are_not_broadcast(spark):
    windows = spark.range(40).select(F.col("id").alias("doc_id"), F.lit(1).alias("question_number"), F.lit(1).alias("start_line"), F.sequence(F.lit(1), F.lit(500)).alias("line_numbers"))
    lines = spark.range(40).select(F.col("id").alias("doc_id"), F.explode(F.sequence(F.lit(1), F.lit(500))).alias("line_number")).withColumn("raw", F.format_string("(a) line %d", "line_number"))
    own, all_lines = lineage.dealt(windows, "broadcast-windows", 4), lineage.dealt(lines, "broadcast-lines", 4)
    both = family_queries.window_lines(all_lines, own)
    assert "BroadcastExchange" not in planned(both) and "Exchange hashpartitioning" not in planned(both)
    assert lineage.dealt(both, "broadcast-both", 4).count() == 20000


def test_settings_are_as_before(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = [spark.conf.get(n, None) for n in names]
    with lineage.joined_as_dealt(spark):
        assert [spark.conf.get(n) for n in names] == ["-1", "-1"]
    assert [spark.conf.get(n, None) for n in names] == before
    spark.conf.set(names[1], "5m")
    try:
        with lineage.joined_as_dealt(spark):
            pass
        assert spark.conf.get(names[1]) == "5m"
    finally:
        spark.conf.unset(names[1])


@pytest.mark.skipif(not Path(DATA).exists(), reason="the given tables are not here")
def test_no_stored_table_is_made_by_a_broadcast(spark, tmp_path, monkeypatch):
    os.symlink(f"{DATA}/documents.parquet", tmp_path / "documents.parquet")  # a folder of its own, so that all is made anew
    made = {}

    def seen(df, label, *rest):
        made[label] = planned(df)
        return lineage.dealt(df, label, *rest)

    monkeypatch.setattr(tables, "dealt", seen)
    for name in ("window_options", "binding_counts", "readiness_counts", "quality_gate", "evidence_hashes", "chunk_diagnostics", "patch_findings", "patch_counts"):
        catalog.QUERIES[name](spark, str(tmp_path))
    assert {"read-lines", "grounded", "validated", "chunk-windows", "chunk-lines", "chunk-diagnostics", "reviewed-items", "judged-patches"} <= set(made)
    assert [label for label, plan in made.items() if "BroadcastExchange" in plan] == []
