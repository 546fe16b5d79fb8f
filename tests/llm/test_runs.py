"""Runs of line hashes: merges, later sessions, hot lines, and the query at a size where merges matter."""

import tempfile

import compare
import pytest
from pyspark.sql import functions as F

from stopwise.llm import line_runs, queries

LARGER = "/root/testdata/sf0.01"


def batch(spark, low, high):
    return spark.range(low, high).select(F.xxhash64("id").alias("h1"), F.xxhash64(F.lit(1), "id").alias("h2"), F.lit(1).cast("long").alias("docs"))


@pytest.fixture
def folder():
    return "file://" + tempfile.mkdtemp()


def test_no_run_holds_a_hash_twice(spark, folder):
    runs = line_runs.LineRuns(spark, folder, common=100)
    for k in range(7):
        runs.add(batch(spark, 100 * k, 2000 + 100 * k))
        assert sum(t.agg(F.sum("docs")).first()[0] for t in runs.tables()) == 2000 * (k + 1) - 0
        for t in runs.tables():
            assert t.count() == t.select("h1", "h2").distinct().count()
    assert [bool(x) for x in runs.levels] == [True, True, True]  # seven batches: four, two and one
    name = runs.compact()
    assert spark.table(name).agg(F.sum("docs")).first()[0] == 14000 and spark.table(name).count() == 2600
    assert [r.docs for r in spark.table(name).groupBy("docs").count().orderBy("docs").collect()] == [1, 2, 3, 4, 5, 6, 7]


def test_merging_shuffles_nothing(spark, folder):
    runs = line_runs.LineRuns(spark, folder, common=100)
    runs.add(batch(spark, 0, 500))
    other = line_runs.LineRuns(spark, folder, common=100)
    other.add(batch(spark, 300, 900))
    merged = runs.merged(runs.levels[0], other.levels[0])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "FullOuter" in plan
    assert merged.count() == 900 and merged.agg(F.sum("docs")).first()[0] == 1100


def test_common_hashes_are_not_counted_again(spark, folder):
    runs = line_runs.LineRuns(spark, folder, common=2)
    runs.add(batch(spark, 0, 10))
    runs.add(batch(spark, 0, 10))
    runs.add(batch(spark, 5, 15))
    assert runs.tables()[-1].count() == 5  # 5 to 9 were common already
    assert runs.common_lines().count() == 10


def test_a_later_session_goes_on(spark, folder):
    first = line_runs.LineRuns(spark, folder, common=3)
    for _ in range(2):
        first.add(batch(spark, 0, 50))
    for name in filter(None, first.levels):
        spark.sql(f"DROP TABLE {name}")  # an external table: the files stay, as they do for another session
    later = line_runs.LineRuns.reopen(spark, folder, common=3)
    later.add(batch(spark, 25, 75))
    assert later.common_lines().count() == 25
    later.close()


def test_no_batches(spark, folder):
    assert line_runs.LineRuns(spark, folder, common=3).common_lines().count() == 0


def test_hot_lines_are_dealt_into_parts(spark, monkeypatch):
    monkeypatch.setattr(line_runs, "LEAST_SHARE", 2)
    monkeypatch.setattr(line_runs, "SHARES", 50)
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit(" Hot \nown "), "id", F.lit("\n\nTwice\ntwice")).alias("text"))
    got = {r.doc_id: (r.kept, r.n_lines, r.n_dropped) for r in line_runs.dedup_lines(docs, min_docs=10).collect()}
    assert got == {i: (f"own {i}\n", 5, 3) for i in range(300)}


def test_long_text_and_least_length(spark):
    long = "\n".join(f"line {i}" for i in range(200_000))
    rows = [(1, long), (2, long + "\nab"), (3, "ab"), (4, "\x0b AB\r")]
    got = {r.doc_id: r for r in line_runs.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), 2, min_chars=3).collect()}
    assert (got[1].kept, got[1].n_dropped, got[2].kept, got[3].kept, got[4].kept) == ("", 200_000, "ab", "ab", "\x0b AB\r")


@pytest.mark.parametrize("sf_dir", [LARGER])
def test_query_where_runs_share_hashes(spark, sf_dir):
    assert not compare.differences(queries.QUERIES["op2_line_dedup"](spark, sf_dir), compare.connect(sf_dir), queries.ORACLES["op2_line_dedup"])
