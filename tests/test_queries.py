"""Every registered query with checking SQL agrees with it on the smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from foliate.operators import lines as L
from foliate.operators import mapping as M
from foliate.operators import packages as K
from foliate.operators import segment as S
from foliate.plans import catalog, lineage, tables
from foliate.plans import package_queries as PQ
from foliate.plans import section_queries as SQ

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    want = duck.sql(catalog.ORACLES[name])
    assert columns == sorted(want.columns)
    rows = Counter(tuple(map(plain, r)) for r in got.select(*columns).collect())
    assert rows == Counter(tuple(map(plain, r)) for r in want.project(", ".join(f'"{c}"' for c in columns)).fetchall())


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_shared_tables_follow_their_input(spark, tmp_path):
    def lines(text):
        spark.createDataFrame([(1, text)], "doc_id long, text string").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        return [r.raw for r in tables.classified(spark, str(tmp_path)).collect() if "word" in r.raw]

    assert lines("one word")[0].endswith("one word")
    first = tables.classified(spark, str(tmp_path))
    assert tables.classified(spark, str(tmp_path)) is first
    assert lines("two words")[0].endswith("two words")
    lineage.drop(tables.classified(spark, str(tmp_path)))
    assert [r.raw for r in tables.classified(spark, str(tmp_path)).collect() if "word" in r.raw]


def test_solutions_are_found_once(spark):
    for name in ("duplicate_solutions", "unmatched_solutions", "answer_solution_map"):
        catalog.QUERIES[name](spark, DATA).count()
    assert sum(label == "solutions" for _, sf_dir, label in tables._made if sf_dir == DATA) == 1


def exchanges(df):
    """How often rows are shuffled for a table that is made of ``df``."""
    with lineage.joined_as_dealt(df.sparkSession):
        return df.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_lines_are_shuffled_once(spark):
    lines, content = tables.classified(spark, DATA), tables.content(spark, DATA)
    cands, items = PQ._items(spark, DATA)
    assert exchanges(L.content_lines(lines)) == 0
    assert exchanges(S.candidates(content)) == 0
    assert exchanges(M.solutions(content)) == 0
    assert exchanges(K.final_items(cands, PQ._mapped(spark, DATA)[1])) == 0
    assert exchanges(SQ.ranked_windows(spark, DATA).join(items, ["doc_id", "question_number"])) == 0


def test_dealt_tables_hold_every_row_and_empty_ones_too(spark):
    rows = spark.createDataFrame([(i % 7, i, str(i)) for i in range(100)] + [(None, -1, None)], "doc_id long, n long, t string")
    for some in (rows, rows.where("n > 100")):
        stored = lineage.dealt(some, "dealt-test", 3)
        assert stored.schema.names == rows.schema.names and sorted(map(tuple, stored.collect()), key=str) == sorted(map(tuple, some.collect()), key=str)
        assert exchanges(stored.groupBy("doc_id", "n").count()) == 0
        lineage.drop(stored)
        assert not lineage.exists(stored)


def test_buckets_follow_cores_and_bytes(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    for size, rounds in ((0, 1), (1, 1), (tables.BUCKET_BYTES * cores, 1), (tables.BUCKET_BYTES * cores + 1, 2), (tables.BUCKET_BYTES * cores * 50, 50)):
        monkeypatch.setattr(tables, "n_bytes", lambda s, path: size)  # noqa: B023
        assert tables.buckets(spark, "/nowhere") == cores * rounds
