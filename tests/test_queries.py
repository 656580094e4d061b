"""Every query that has SQL gives DuckDB's rows on the small tables; the others run twice alike."""

import math

import duckdb
import pytest

from siftwork.plans import curation, files, relations, rows, stages

QUERIES = rows.QUERIES | relations.QUERIES | stages.QUERIES | files.QUERIES | curation.QUERIES
SQL = rows.SQL | relations.SQL | stages.SQL | files.SQL | curation.SQL
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(str(plain(r[c])) for c in columns) for r in df.collect()))
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(tuple(str(plain(r[names.index(c)])) for c in columns) for r in cursor.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_reruns_agree(spark, sf, name):
    first, second = (sorted(map(str, QUERIES[name](spark, sf).collect())) for _ in range(2))
    assert first and first == second


@pytest.mark.parametrize("name", ["dedup_two_level", "merged_preferred", "cyclic_tasks", "near_duplicate_pairs"])
def test_partitions_and_aqe_do_not_matter(spark, sf, name):
    first = sorted(map(str, QUERIES[name](spark, sf).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert sorted(map(str, QUERIES[name](spark, sf).collect())) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_scans_are_pruned(spark, sf):
    plan = relations.QUERIES["caption_length_histogram"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<n_chars:bigint>" in plan
    ranked = relations.QUERIES["nested_cap_sampling"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in ranked
