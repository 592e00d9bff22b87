import random
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlume import schema as S
from postlume.operators.merge import coerce, merge_frames
from postlume.sinks.catalog import CatalogTable, create_table
from postlume.sinks.legacy import as_legacy
from postlume.sinks.snapshot import ConcurrentCommit, SnapshotTable, Upserted

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("j", T.StringType()),
                       T.StructField("a", T.LongType()), T.StructField("b", T.StringType()),
                       T.StructField("date", T.DateType())])
D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def frame(spark, rows, columns="k j a b date"):
    names = columns.split()
    return spark.createDataFrame(rows, T.StructType([SCHEMA[n] for n in names]))


def content(df):
    return sorted(tuple(r) for r in df.collect())


def table(spark, tmp_path, **options):
    return SnapshotTable(spark, str(tmp_path / "table"), SCHEMA, ["k", "j"], **options).create()


@pytest.mark.parametrize("small", [False, True])
def test_partial_update(spark, small):
    old = frame(spark, [("1", "x", 1, "keep", D1), ("2", "x", 2, "stay", D1)])
    new = frame(spark, [("1", "x", None, D2), ("3", "x", 3, D2)], "k j a date")
    assert content(merge_frames(old, new, ["k", "j"], small)) == [
        ("1", "x", None, "keep", D2), ("2", "x", 2, "stay", D1), ("3", "x", 3, None, D2)]


@pytest.mark.parametrize("seed", range(3))
def test_both_ways_agree_and_twice_is_once(spark, seed):
    rng = random.Random(seed)
    def some(n):
        keys = rng.sample([(str(i), j) for i in range(40) for j in "xy"], n)
        return [(k, j, rng.choice([None, 1, 2]), rng.choice([None, "b"]), rng.choice([D1, D2]))
                for k, j in keys]
    before, changes = some(50), some(30)
    old, new = frame(spark, before), frame(spark, changes)
    once = merge_frames(old, new, ["k", "j"])
    expected = {r[:2]: r for r in before} | {r[:2]: r for r in changes}
    for got in (once, merge_frames(old, new, ["k", "j"], True), merge_frames(once, new, ["k", "j"])):
        assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, expected.values()))


def test_small_updates_leave_the_target_in_place(spark, plan, tmp_path):
    for name, n in (("old", 1000), ("new", 10)):
        spark.range(n).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("j"),
                              "id", F.lit("b").alias("b")).write.parquet(str(tmp_path / name))
    old, new = (spark.read.parquet(str(tmp_path / n)) for n in ("old", "new"))
    text = plan(merge_frames(old, new, ["k", "j"], True))
    assert "SortMergeJoin" not in text and "hashpartitioning" not in text
    assert "FullOuter" in plan(merge_frames(old, new, ["k", "j"]))


def test_table_inserts_add_and_updates_move(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.is_empty() and content(t.read()) == []
    first = [(str(i), "x", i, "b", D1) for i in range(5)]
    assert t.upsert(frame(spark, first)) == Upserted(5, 0, 0)
    folders = t._folders(t.version())
    assert t.upsert(frame(spark, [("9", "y", 9, "n", D2)])) == Upserted(1, 0, 0)
    assert set(folders) < set(t._folders(t.version()))

    # Moves the row to another day; the folder with no match is not touched.
    kept = [f for f in t._folders(t.version()) if f.endswith("2024-01-02")]
    assert t.upsert(frame(spark, [("0", "x", 100, D2), ("8", "x", 8, D2)], "k j a date")) == Upserted(1, 1, 1)
    assert set(kept) < set(t._folders(t.version()))
    assert content(t.read()) == sorted(
        [("0", "x", 100, "b", D2), ("8", "x", 8, None, D2), ("9", "y", 9, "n", D2)] + first[1:])
    assert content(t.read(1)) == sorted(first)


def test_last_row_leaves_its_day(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(frame(spark, [("1", "x", 1, "b", D1)]))
    t.upsert(frame(spark, [("1", "x", 2, "b", D2)]))
    assert content(t.read()) == [("1", "x", 2, "b", D2)]


def test_updates_without_a_day_and_tables_without_days(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(frame(spark, [("1", "x", 1, "b", D1)]))
    t.upsert(frame(spark, [("1", "x", 5), ("2", "x", 6)], "k j a"))
    assert sorted(map(str, content_any(t.read()))) == sorted(map(str, [
        ("1", "x", 5, "b", D1), ("2", "x", 6, None, None)]))
    t.upsert(frame(spark, [("2", "x", 7, D2)], "k j a date"))
    assert content(t.read()) == [("1", "x", 5, "b", D1), ("2", "x", 7, None, D2)]

    flat = SnapshotTable(spark, str(tmp_path / "flat"), SCHEMA, ["k"], partition=None).create()
    flat.upsert(frame(spark, [("1", "x", 1, "b", D1), ("2", "x", 1, "b", D1)]))
    assert flat.upsert(frame(spark, [("2", "z"), ("3", "z")], "k j")) == Upserted(1, 1, 1)
    assert [r.j for r in flat.read().orderBy("k").collect()] == ["x", "z", "z"]


def content_any(df):
    return [tuple(r) for r in df.collect()]


def test_large_updates_take_the_full_join(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(frame(spark, [(str(i), "x", i, "b", D1) for i in range(20)]))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t.upsert(frame(spark, [(str(i), "x", -i, D2) for i in range(10, 30)], "k j a date"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    rows = {r.k: (r.a, r.b) for r in t.read().collect()}
    assert len(rows) == 30 and rows["5"] == (5, "b") and rows["15"] == (-15, "b") and rows["25"] == (-25, None)


def test_two_writers(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(frame(spark, [("1", "x", 1, "b", D1)]))
    seen = t.version()
    t.upsert(frame(spark, [("2", "x", 1, "b", D1)]))
    with pytest.raises(ConcurrentCommit):
        t._commit(seen, [])
    assert len(content(t.read())) == 2


def test_nothing_and_wrong_columns(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.upsert(frame(spark, [])) == Upserted() and t.version() == 0
    with pytest.raises(ValueError, match="mood"):
        t.upsert(frame(spark, [("1", "x", 1, "b", D1)]).withColumn("mood", F.lit(1)))
    with pytest.raises(ValueError, match="j"):
        t.upsert(frame(spark, [("1", 1)], "k a"))


def test_coercion(spark):
    row = coerce(spark.sql("""
        SELECT 7 AS source_id, timestamp'2024-01-01 10:00:00.987654' AS scraped_at,
               named_struct('a', 1, 'b', array('x')) AS source_text, array('p') AS people,
               CAST(NULL AS STRING) AS region, true AS is_news"""), S.ENRICHMENTS).first()
    assert row.source_id == "7" and row.scraped_at.microsecond == 0
    assert row.source_text == '{"a":1,"b":["x"]}' and row.people == ["p"]
    assert row.region is None and row.is_news is True


def test_create_table_in_the_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS made")
    try:
        for name, schema in (("enrichments", S.ENRICHMENTS), ("x_tweets_enriched", S.LEGACY_ENRICHED)):
            for _ in range(2):
                create_table(spark, f"made.{name}", schema)
            got = spark.table(f"made.{name}")
            assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in schema]
            assert "date" in [c.name for c in spark.catalog.listColumns(f"made.{name}") if c.isPartition]
        # Plain Parquet tables have no MERGE, and that is said, not hidden.
        rows = spark.createDataFrame([("t", "1")], "source_table string, source_id string")
        with pytest.raises(Exception, match="MERGE"):
            CatalogTable(spark, "made.enrichments").upsert(rows)
    finally:
        spark.sql("DROP DATABASE made CASCADE")


def test_schemas():
    assert len(S.ENRICHMENTS) == 45 and len(S.LEGACY_ENRICHED) == 44


def test_legacy_form(spark):
    rows = spark.createDataFrame([("x_tweets", "1", "hi", "ann", 2, 3), ("reddit_posts", "1", "no", "bob", 4, 5)],
                                 "source_table string, source_id string, source_text string, "
                                 "source_author string, shares long, comments long")
    rows = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType)
                         .alias(f.name) for f in S.ENRICHMENTS])
    legacy = as_legacy(rows)
    assert [(f.name, f.dataType) for f in legacy.schema] == [(f.name, f.dataType) for f in S.LEGACY_ENRICHED]
    row = legacy.first()
    assert (row.tweet_id, row.tweet_text, row.author, row.retweets, row.replies, row.author_handle) == (
        "1", "hi", "ann", 2, 3, None)
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    tweets = spark.createDataFrame([(1, "@new", at), (1, "@old", None)],
                                   "tweet_id long, author_handle string, scraped_at timestamp")
    got = as_legacy(rows, tweets).collect()
    assert [r.author_handle for r in got] == ["@new"]


def test_legacy_table_upserts_by_tweet(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "legacy"), S.LEGACY_ENRICHED, S.LEGACY_KEYS).create()
    def rows(*values):
        return spark.createDataFrame([(*v, D1) for v in values],
                                     "tweet_id string, tweet_text string, likes long, date date")
    assert t.upsert(rows(("1", "a", 1), ("2", "b", 2))) == Upserted(2, 0, 0)
    assert t.upsert(rows(("2", "b", 9), ("3", "c", 3)).drop("tweet_text")) == Upserted(1, 1, 1)
    got = t.read().orderBy("tweet_id")
    assert got.columns == S.LEGACY_ENRICHED.names
    assert [(r.tweet_id, r.tweet_text, r.likes) for r in got.collect()] == [
        ("1", "a", 1), ("2", "b", 9), ("3", None, 3)]


def test_keys_known_to_be_absent(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(frame(spark, [("1", "x", 1, "b", D1)]))
    seen = t.version()
    assert t.upsert(frame(spark, [("2", "x", 2, "b", D1)]), absent_at=seen) == Upserted(1, 0, 0)
    # The table has moved on since: the same promise is checked again.
    assert t.upsert(frame(spark, [("2", "x", 3, "b", D1)]), absent_at=seen) == Upserted(0, 1, 1)
    assert content(t.read()) == [("1", "x", 1, "b", D1), ("2", "x", 3, "b", D1)]
