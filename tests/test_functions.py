import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from postlume.functions import text as X
from postlume.functions.engagement import with_engagement
from postlume.functions.rounding import round_exact
from postlume.functions.timestamps import with_posted_instant
from postlume.operators.modules import enrich, switched_on

UTC = timezone.utc
AS_OF = datetime(2024, 2, 1, tzinfo=UTC)

# likes retweets replies views posted_at | score rate virality quality hourly percentile tier
GOLDEN = """
100 20 10 10000 2024-01-31T00:00:00 | 280.0 0.013 0.1538 0.3 11.67 61.22 Above Average
- - - - - | 0.0 0.0 0.0 0.0 0.0 0.0 Low
0 5 0 0 2024-01-31T00:00:00 | 15.0 0.0 1.0 0.0 0.62 30.1 Average
1 0 0 32 2024-01-31T00:00:00 | 1.32 0.0312 0.0 0.0 0.06 9.14 Low
1 0 0 160 - | 2.6 0.0063 0.0 0.0 0.0 13.91 Below Average
1 0 0 0 - | 1.0 0.0 0.0 0.0 0.0 7.53 Low
2 0 0 0 - | 2.0 0.0 0.0 0.0 0.0 11.93 Below Average
9 0 0 0 - | 9.0 0.0 0.0 0.0 0.0 25.0 Average
98 0 0 98 - | 98.98 1.0 0.0 0.0 0.0 50.0 Average
99 0 0 0 - | 99.0 0.0 0.0 0.0 0.0 50.0 Above Average
999 0 0 0 - | 999.0 0.0 0.0 0.0 0.0 75.0 High
3980 0 0 0 - | 3980.0 0.0 0.0 0.0 0.0 90.0 High
3981 0 0 0 - | 3981.0 0.0 0.0 0.0 0.0 90.0 Viral
9999 0 0 0 - | 9999.0 0.0 0.0 0.0 0.0 100.0 Viral
1000000 0 0 0 - | 1000000.0 0.0 0.0 0.0 0.0 100.0 Viral
10 0 0 0 2024-02-02T00:00:00 | 10.0 0.0 0.0 0.0 0.0 26.03 Average
10 0 0 0 2024-02-01T00:00:00 | 10.0 0.0 0.0 0.0 0.0 26.03 Average
-5 0 0 10 2024-01-31T00:00:00 | -4.9 -0.5 0.0 0.0 -0.2 0.0 Low
10 0 0 -50 2024-01-31T23:30:00 | 9.5 0.0 0.0 0.0 19.0 25.53 Average
"""
METRICS = ("engagement_score", "engagement_rate", "virality_score", "interaction_quality",
           "time_adjusted_score", "percentile_score")


def test_golden_engagement(spark):
    rows, expected = [], []
    for i, line in enumerate(GOLDEN.strip().splitlines()):
        given, wanted = line.split(" | ")
        *counts, posted = [None if v == "-" else v for v in given.split()]
        rows.append((i, *[None if c is None else int(c) for c in counts],
                     posted and datetime.fromisoformat(posted).replace(tzinfo=UTC)))
        *numbers, tier = wanted.split(maxsplit=6)
        expected.append((*[float(n) for n in numbers], tier))
    df = spark.createDataFrame(
        rows, "i int, likes long, retweets long, replies long, views long, posted_at timestamp")
    scored = with_engagement(df, AS_OF).orderBy("i").collect()
    assert [tuple(r[m] for m in (*METRICS, "engagement_tier")) for r in scored] == expected


def test_weights_are_a_parameter(spark):
    df = spark.createDataFrame([(1, 1, 1, 1, None)],
                               "likes long, retweets long, replies long, views long, posted_at timestamp")
    weights = {"likes": 2.0, "retweets": 4.0, "replies": 8.0, "views": 16.0}
    assert with_engagement(df, AS_OF, weights).first()["engagement_score"] == 30.0


def test_engagement_properties(spark):
    rng = random.Random(7)
    rows = [tuple(rng.choice([0, 1, 5, 100, 10**6, None]) for _ in range(4)) for _ in range(500)]
    df = spark.createDataFrame(rows, "likes long, retweets long, replies long, views long") \
        .withColumn("posted_at", F.lit(None).cast("timestamp"))
    scored = with_engagement(df, AS_OF).collect()
    assert len(scored) == len(rows)
    order = ["Low", "Below Average", "Average", "Above Average", "High", "Viral"]
    ranked = sorted(scored, key=lambda r: r["engagement_score"])
    tiers = [order.index(r["engagement_tier"]) for r in ranked]
    assert tiers == sorted(tiers)
    assert all(0 <= r["percentile_score"] <= 100 for r in scored)


def test_round_is_exact(spark):
    rng = random.Random(3)
    values = [a / b for a in range(200) for b in range(1, 200)]
    values += [rng.uniform(-1e6, 1e6) for _ in range(2000)] + [a / 200 for a in range(-999, 999)]
    values += [0.125, 0.375, 2.675, 1e15 + 0.5, 1e18, -0.5, 98.98]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select("v", round_exact("v", 2).alias("a"), round_exact("v", 4).alias("b")).collect()
    assert [r for r in got if (r.a, r.b) != (round(r.v, 2), round(r.v, 4))] == []


def iso_micros(text):
    try:
        moment = datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        return None
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=UTC)
    return (moment - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)


TIMES = """2024-01-15|2024-01-15T10|2024-01-15 10:20|2024-01-15T10:20:30Z|2024-01-15x10:20
2024-01-15T10:20:30.123456+05:30|20240115|20240115T102030Z|2024-W03-1|2024-W03|2024W031|2024W03
2024-W53-1|2020-W53-7|2024-W00-1|2024-W01-8|2024-W01-0|2024-W01-1|2026-W01-1T12:00|2024|2024-01
2024-1-5| 2024-01-15 |2024-01-15 UTC|10:20:30|Mon Jan 15 10:20:30 +0000 2024||now|today|2024-02-30
2024-01-15T24:00|2024-01-15T10:20:60|2024-01-15T10:20:30,5|2024-01-15T10:20:30.1234567
2024-01-15T10:20:30-0830|2024-01-15T10:20+23:59|0001-01-01|0000-01-01|2024-01-15T|2024-01-15T1
9999-12-31T23:59:59|2024-01-15T10:2030|1969-12-31T23:59:59.999999Z|20240115Z|2024-01-15T10:20:30z
2024-01-15T10:20:30+05|2024-01-15T10:20:30+05:30:15|2024-02-29|2023-02-29"""


def test_iso_times_as_python_reads_them(spark):
    texts = [t for line in TIMES.split("\n") for t in line.split("|")]
    df = spark.createDataFrame([(t,) for t in texts] + [("2024-01-15\n",), (None,)], "t string")
    got = with_posted_instant(df, "t", "at").select("t", F.unix_micros("at").alias("us")).collect()
    for row in got:
        assert row.us == (None if row.t is None else iso_micros(row.t)), row


def test_posted_at_by_source_type(spark):
    df = spark.sql("""SELECT timestamp'2024-01-15 10:00:00' AS a, timestamp_ntz'2024-01-15 10:00:00' AS b,
                             date'2024-01-15' AS c, 5L AS d, '2024-01-15T10:00:00' AS e""")
    for name in "abcde":
        df = with_posted_instant(df, name, f"{name}_at")
    row = df.select(*[F.unix_seconds(f"{n}_at").alias(n) for n in "abcde"]).first()
    assert (row.a, row.b, row.e) == (1705312800,) * 3
    assert row.c == 1705276800 and row.d is None


def test_blank_as_python_strips(spark):
    texts = ["", " ", "\t\n", "a", " a ", " ", " 　", "\u0085", "\x1c\x1d\x1e\x1f",
             "​", " ", "  ", "  ", "é", "\x00", "."]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    for row in df.select("t", X.is_blank(F.col("t")).alias("blank")).collect():
        assert row.blank == (not row.t or not row.t.strip()), repr(row.t)


def test_hashtags_and_mentions(spark):
    text = "#One @two me@mail.com http://x.org/#frag a#b # @ #größe_1 #One (@Ü3) ##four @@five &#39; @six."
    row = spark.createDataFrame([(text,)], "t string").select(
        X.hashtags(F.col("t")).alias("h"), X.mentions(F.col("t")).alias("m")).first()
    assert row.h == ["One", "größe_1", "four"]
    assert row.m == ["two", "Ü3", "six"]


def test_most_frequent_words(spark):
    rng = random.Random(5)
    lists = [[rng.choice("abcdefgh") * 2 for _ in range(rng.randrange(0, 60))] for _ in range(200)]
    lists += [[], ["x"], ["x", "x"], ["y", "x"], None, [f"w{i}" for i in range(50)]]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(lists)], "i int, w array<string>")
    got = {r.i: r.top for r in X.with_most_frequent(df, F.col("w"), 3, "top").collect()}
    for i, words in enumerate(lists):
        if words is None:
            assert not got[i]
            continue
        expected = sorted(Counter(words).items(), key=lambda item: (-item[1], item[0]))[:3]
        assert got[i] == [w for w, _ in expected]


def test_rules_on_blank_and_null_text_give_the_defaults(spark):
    from postlume import schema as S
    from postlume.operators.rules import annotate_by_rules
    df = spark.createDataFrame([(" ",), ("",), (None,)], "text string")
    tasks = ["sentiment", "entities", "topic", "moderation"]
    expected = {**S.SENTIMENT_DEFAULTS, **S.ENTITY_DEFAULTS, **S.TOPIC_DEFAULTS,
                **S.MODERATION_DEFAULTS}
    for row in annotate_by_rules(df, tasks).collect():
        assert {k: row[k] for k in expected} == expected


def test_rules_read_a_post(spark):
    from postlume.operators.rules import annotate_by_rules
    text = ("I love this great album from New York! Thanks @anna #music. "
            "The idiot at the Apache License shop was a stupid clown, a moron.")
    row = annotate_by_rules(spark.createDataFrame([(text,)], "text string"),
                            ["sentiment", "entities", "topic", "moderation"]).first()
    assert (row.sentiment_label, row.sentiment_score) == ("negative", 0.1429)
    assert row.sentiment_emotions == ["anger", "disappointment", "joy", "trust"]
    assert (row.locations, row.organizations, row.products) == (["new york"], ["apache"],
                                                                ["apache license"])
    assert (row.hashtags, row.mentions) == (["music"], ["anna"])
    assert (row.primary_category, row.sub_categories) == ("Technology", ["software"])
    assert row.is_commercial and not row.is_news
    assert (row.risk_level, row.flags, row.recommended_action) == ("high", ["harassment"], "review")
    assert row.confidence_score == 0.8


@pytest.mark.parametrize("switches, expected", [
    (None, ["sentiment", "entity", "topic", "engagement", "moderation"]),
    ({"sentiment": "TRUE", "topic": "yes", "entity": "false"}, ["sentiment", "engagement", "moderation"]),
    ({"moderation": False}, ["sentiment", "entity", "topic", "engagement"]),
    (["engagement"], ["engagement"]),
])
def test_module_switches(switches, expected):
    assert [m.name for m in switched_on(switches)[0]] == expected


def test_modules_off_add_no_columns(spark):
    from postlume import schema as S
    posts = spark.createDataFrame([], S.NORMALIZED)
    on, _ = switched_on(["engagement"])
    columns = enrich(posts, on, AS_OF).columns
    assert "sentiment_label" not in columns and "engagement_tier" in columns
    assert enrich(posts, switched_on()[0], AS_OF).columns == S.ENRICHMENTS.names


def test_a_module_of_ones_own(spark, monkeypatch):
    from pyspark.sql import types as T

    from postlume import schema as S
    from postlume.operators import modules as M
    monkeypatch.setattr(M, "_modules", dict(M._modules))
    M.register_module(M.Module(
        "length", T.StructType([T.StructField("text_length", T.IntegerType())]),
        transform=lambda df, as_of: df.withColumn("text_length", F.length("text"))))

    def broken():
        raise RuntimeError("no licence")
    M.register_module(M.Module("broken", T.StructType([]), prepare=broken))
    on, failed = switched_on()
    assert failed == {"broken": "no licence"}
    assert M.target_schema().names[-4:] == ["text_length", "enriched_at", "enrichment_version", "date"]
    posts = spark.createDataFrame([("t", "1", "abc")], "source_table string, source_id string, text string")
    for name in set(S.NORMALIZED.names) - set(posts.columns):
        posts = posts.withColumn(name, F.lit(None).cast(S.NORMALIZED[name].dataType))
    assert enrich(posts, on, AS_OF).first()["text_length"] == 3
