import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from postlume.operators import select as S
from postlume.operators.select import (dedup_posts, latest_per_key, not_enriched, pending,
                                       top_per_group)

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def candidates(spark, rows):
    return spark.createDataFrame([(i, None if m is None else T0 + timedelta(minutes=m)) for i, m in rows],
                                 "source_id string, scraped_at timestamp")


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "source_id string")


def test_pending_takes_the_newest_that_are_not_enriched(spark):
    rows = candidates(spark, [("a", 1), ("b", 5), ("c", 3), ("d", None), ("e", 4), (None, 9)])
    got = pending(rows, ids(spark, "b"), 3).collect()
    assert {r.source_id for r in got} == {"e", "c", "a"}
    got = pending(rows, ids(spark, "b"), None).collect()
    assert {r.source_id for r in got} == {"a", "c", "d", "e"}
    assert {r.source_id for r in pending(rows, None, None).collect()} == {"a", "b", "c", "d", "e"}


def test_limit_counts_rows_before_copies_fold(spark):
    rows = candidates(spark, [("a", 9), ("a", 8), ("a", 7), ("b", 6), ("c", 5)])
    got = {r.source_id: (r.copies, r.scraped_at.astimezone(timezone.utc)) for r in
           pending(rows, None, 4).collect()}
    assert got == {"a": (3, T0 + timedelta(minutes=9)), "b": (1, T0 + timedelta(minutes=6))}


def test_pending_against_brute_force_with_one_hot_id(spark):
    rng = random.Random(11)
    rows = [("hot" if rng.random() < 0.4 else f"i{rng.randrange(300)}", rng.randrange(10**6))
            for _ in range(3000)]
    done = {f"i{i}" for i in range(0, 300, 3)}
    fresh = sorted(((m, i) for i, m in rows if i not in done), key=lambda r: (-r[0], r[1]))[:700]
    expected = {}
    for m, i in fresh:
        n, newest = expected.get(i, (0, m))
        expected[i] = (n + 1, max(newest, m))
    got = pending(candidates(spark, rows), ids(spark, *done), 700).collect()
    assert {r.source_id: (r.copies, int((r.scraped_at.astimezone(timezone.utc) - T0).total_seconds() // 60))
            for r in got} == expected


def test_dedup_keeps_the_latest_and_is_stable(spark):
    rows = [("t", "1", 5, "old"), ("t", "1", 9, "new"), ("t", "1", None, "never"), ("t", "2", None, "only"),
            ("u", "1", 1, "other"), ("t", "3", 4, "x"), ("t", "3", 4, "y")]
    df = spark.createDataFrame([(a, b, m and T0 + timedelta(minutes=m), c) for a, b, m, c in rows],
                               "source_table string, source_id string, scraped_at timestamp, text string")
    def run(frame):
        return {(r.source_table, r.source_id): r.text for r in
                dedup_posts(frame, ["source_table", "source_id"]).collect()}
    first = run(df)
    assert first.pop(("t", "3")) in "xy"
    assert first == {("t", "1"): "new", ("t", "2"): "only", ("u", "1"): "other"}
    assert run(df) == run(df.orderBy(F.rand(1)).repartition(5))


def test_top_per_group_beyond_the_threshold(spark):
    rng = random.Random(2)
    rows = [("big" if rng.random() < 0.5 else f"g{rng.randrange(5)}", i, rng.randrange(1000))
            for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, i int, v int").repartition(6)
    order = [F.col("v").desc(), F.col("i")]
    for k in (3, 1500):
        expected = set()
        for g in {r[0] for r in rows}:
            mine = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))
            expected |= {r[1] for r in mine[:k]}
        got = top_per_group(df, ["g"], order, k)
        assert got.columns == ["g", "i", "v"]
        assert {r.i for r in got.collect()} == expected


def test_plans(spark, plan, tmp_path):
    df = spark.range(1000).select(F.col("id").cast("string").alias("source_id"),
                                  F.timestamp_seconds("id").alias("scraped_at"), F.lit("x").alias("text"))
    df.write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    assert "LeftAnti" in plan(not_enriched(df, df.select("source_id"), ["source_id"]))
    text = plan(latest_per_key(df, ["source_id"], [F.col("scraped_at").desc()]))
    # One row per key leaves each map task: the limit sits on both sides of the exchange.
    assert text.count("WindowGroupLimit") >= 2
    text = plan(top_per_group(df, ["text"], [F.col("scraped_at").desc()], 10))
    assert text.count("WindowGroupLimit") >= 2
    text = plan(pending(df.select("source_id", "scraped_at"), df.select("source_id"), 10))
    assert "TakeOrderedAndProject" in text and "text" not in text.split("ReadSchema:")[1].split("\n")[0]


def test_newest_of_many_against_brute_force(spark, tmp_path, monkeypatch):
    """Times tie in large numbers, many are missing, one id is a third of the rows."""
    monkeypatch.setattr(S, "BINS", 7)
    rng = random.Random(8)
    rows = [("hot" if rng.random() < 0.35 else f"i{rng.randrange(200)}", rng.choice([None, rng.randrange(10**7), *range(6)]))
            for _ in range(3000)]
    df = candidates(spark, rows).repartition(5)
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    for k in (1, 380, 1500, 2700, 2999, 3000, 9999):
        expected = {}
        for i, m in order[:k]:
            n, newest = expected.get(i, (0, None))
            expected[i] = (n + 1, m if newest is None else newest if m is None else max(newest, m))
        got = S.newest_of_many(df, k, str(tmp_path / f"k{k}")).collect()
        assert {r.source_id: (r.copies, r.scraped_at and int((r.scraped_at.astimezone(timezone.utc) - T0).total_seconds() // 60))
                for r in got} == expected
    assert S.newest_of_many(df.limit(0), 5, str(tmp_path / "none")).count() == 0


def test_newest_of_many_has_no_single_task(spark, plan, tmp_path):
    candidates(spark, [(f"i{i}", i % 50) for i in range(500)]).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    text = plan(S.newest_of_many(df, 250, str(tmp_path / "ties")))
    assert "SinglePartition" not in text and "TakeOrdered" not in text and "GreaterThanOrEqual(scraped_at" in text


def test_a_table_stored_by_day_reads_those_days(spark, plan, tmp_path):
    from datetime import date

    from postlume.sources.posts import latest_tweets, tweets_between
    names = ("tweet_id", "tweet_text", "author", "author_handle", "keyword", "region")
    numbers = ("likes", "retweets", "replies", "views")
    tweets = spark.range(60).select(
        *[F.col("id").cast("string").alias(n) for n in names], *[F.col("id").alias(n) for n in numbers],
        F.lit(T0).alias("posted_at"), F.lit(T0).alias("scraped_at"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 20).cast("int")).alias("date"))
    tweets.write.partitionBy("date").parquet(str(tmp_path / "t"))
    stored = spark.read.schema(tweets.schema).parquet(str(tmp_path / "t"))

    def filters(df):
        return plan(df).split("PartitionFilters: ")[1].split("\n")[0]
    few = tweets_between(stored, date(2024, 1, 3), date(2024, 1, 4))
    assert "date#" in filters(few) and "2024-01-03" in filters(few) and few.count() == 6
    days = stored.where("keyword = '5'").select("date").distinct()
    joined = latest_tweets(stored.join(days, "date"))
    assert "dynamicpruning" in filters(joined) and joined.count() == 3
