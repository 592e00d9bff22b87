from datetime import date, datetime, timezone

import pytest
from pyspark.errors import AnalysisException

from postlume import schema as S
from postlume.sources.posts import latest_tweets, normalize, tweets_between
from postlume.sources.providers import Provider, choose, registered

UTC = timezone.utc
AT = datetime(2024, 1, 15, 10, tzinfo=UTC)

EXAMPLES = {
    "x_tweets": ("tweet_id string, tweet_text string, author string, likes long, retweets long, "
                 "replies long, views long, posted_at timestamp, keyword string, region string, "
                 "scraped_at timestamp",
                 ("1", "hi", "ann", 1, 2, 3, 4, AT, "k", "UK", AT)),
    "apify_x_tweets": ("id string, text string, author_username string, like_count long, "
                       "retweet_count long, reply_count long, view_count long, created_at string, "
                       "keyword string, region string, scraped_at timestamp",
                       ("1", "hi", "ann", 1, 2, 3, 4, "2024-01-15T10:00:00Z", "k", "UK", AT)),
    "apify_tiktok_posts": ("id string, text string, author_username string, digg_count long, "
                           "share_count long, comment_count long, play_count long, "
                           "created_at string, keyword string, region string, scraped_at timestamp",
                           ("1", "hi", "ann", 1, 2, 3, 4, "20240115T100000Z", "k", "UK", AT)),
    "instagram_posts": ("post_id string, caption string, username string, likes long, "
                        "comments long, views long, keyword string, region string, "
                        "scraped_at timestamp", ("1", "hi", "ann", 1, 3, 4, "k", "UK", AT)),
    "reddit_posts": ("post_id string, title string, caption string, author string, upvotes long, "
                     "comments long, posted_at timestamp, keyword string, scraped_at timestamp",
                     ("1", "h", "i", "ann", 1, 3, AT, "k", AT)),
    "tiktok_videos": ("video_id string, description string, creator string, likes long, "
                      "shares long, comments long, views long, keyword string, "
                      "scraped_at timestamp", ("1", "hi", "ann", 1, 2, 3, 4, "k", AT)),
    "youtube_videos": ("video_id string, title string, channel string, likes long, comments long, "
                       "views long, upload_date string, keyword string, region string, "
                       "scraped_at timestamp",
                       ("1", "hi", "ann", 1, 3, 4, "2024-01-15 10:00:00", "k", "UK", AT)),
}
# Not mapped, so at its default: retweets, views, posted_at, region.
DEFAULTS = {"instagram_posts": {"retweets", "posted_at"}, "reddit_posts": {"retweets", "views", "region"},
            "tiktok_videos": {"posted_at", "region"}, "youtube_videos": {"retweets"}}


@pytest.mark.parametrize("name", list(EXAMPLES))
def test_each_provider(spark, name):
    ddl, row = EXAMPLES[name]
    got = normalize(spark.createDataFrame([row], ddl), registered()[name])
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in S.NORMALIZED]
    expected = dict(source_table=name, source_id="1", text="h i" if name == "reddit_posts" else "hi",
                    author="ann", likes=1, retweets=2, replies=3, views=4, posted_at=AT, keyword="k",
                    region="UK", scraped_at=AT, source_url="")
    for column in DEFAULTS.get(name, ()):
        expected[column] = {"posted_at": None, "region": ""}.get(column, 0)
    got = got.first().asDict()
    for column in ("posted_at", "scraped_at"):
        got[column] = got[column] and got[column].astimezone(UTC)
    assert got == expected


def test_registry_order_and_names():
    assert list(registered()) == list(EXAMPLES)
    chosen, unknown = choose(" reddit_posts, nowhere ,x_tweets")
    assert list(chosen) == ["x_tweets", "reddit_posts"] and unknown == ["nowhere"]
    assert list(choose("  ")[0]) == list(EXAMPLES) and list(choose(None)[0]) == list(EXAMPLES)
    assert choose(",") == ({}, [])


@pytest.mark.parametrize("title, caption, text", [
    ("t", "c", "t c"), ("t", None, "t"), (None, "c", "c"), ("", "c", " c"), ("t", "", "t "),
    ("", "", " ")])
def test_reddit_text(spark, title, caption, text):
    ddl = EXAMPLES["reddit_posts"][0]
    row = ("1", title, caption, None, None, None, None, None, None)
    assert normalize(spark.createDataFrame([row], ddl), registered()["reddit_posts"]).first()["text"] == text


def test_empty_text_stays_and_missing_text_goes(spark):
    ddl = EXAMPLES["tiktok_videos"][0]
    rows = [("1", "", None, None, None, None, None, None, None),
            ("2", None, "ann", 1, 1, 1, 1, "k", AT), (None, "x", None, None, None, None, None, None, AT)]
    got = normalize(spark.createDataFrame(rows, ddl), registered()["tiktok_videos"]).collect()
    assert [(r.source_id, r.text, r.author, r.likes) for r in got] == [("1", "", "", 0), (None, "x", "", 0)]


def test_a_missing_mapped_column_fails_at_once(spark):
    with pytest.raises(AnalysisException):
        normalize(spark.createDataFrame([("1", "x", AT)], "id string, text string, scraped_at timestamp"),
                  Provider("t", id="id", text="text", likes="hearts"))


def test_numeric_ids_and_textual_counts(spark):
    df = spark.createDataFrame([(7, "x", "12", AT), (8, "y", "many", AT)],
                               "id long, text string, hearts string, scraped_at timestamp")
    got = normalize(df, Provider("t", id="id", text="text", likes="hearts")).orderBy("source_id").collect()
    assert [(r.source_id, r.likes) for r in got] == [("7", 12), ("8", 0)]


def test_only_mapped_columns_are_read(spark, plan, tmp_path):
    ddl, row = EXAMPLES["tiktok_videos"]
    df = spark.createDataFrame([row + ("big",)], ddl + ", raw string")
    df.write.parquet(str(tmp_path / "t"))
    text = plan(normalize(spark.read.parquet(str(tmp_path / "t")), registered()["tiktok_videos"]))
    assert "raw" not in text.split("ReadSchema:")[1].split("\n")[0]
    assert "IsNotNull(description)" in text


LEGACY = ("tweet_id string, tweet_text string, author string, author_handle string, likes long, "
          "retweets long, replies long, views long, posted_at timestamp, keyword string, "
          "region string, scraped_at timestamp, date date")


def tweet(i, text="x", day=15, at=AT):
    return (str(i), text, "a", "@a", 1, 1, 1, 1, AT, "k", "UK", at, date(2024, 1, day))


def test_legacy_reads(spark, plan, tmp_path):
    rows = [tweet(1, day=14), tweet(2, day=15), tweet(3, None, day=15), tweet(4, day=17, at=None),
            tweet(5, day=16, at=datetime(2024, 1, 16, tzinfo=UTC))]
    spark.createDataFrame(rows, LEGACY).write.partitionBy("date").parquet(str(tmp_path / "t"))
    tweets = spark.read.parquet(str(tmp_path / "t"))
    assert [r.tweet_id for r in latest_tweets(tweets, 3).collect()] == ["5", "1", "2"]
    assert [r.tweet_id for r in latest_tweets(tweets).collect()] == ["5", "1", "2", "4"]
    days = tweets_between(tweets, date(2024, 1, 15), date(2024, 1, 16))
    assert [r.tweet_id for r in days.collect()] == ["5", "2"]
    text = plan(days)
    assert "TakeOrderedAndProject" in text and "date" in text.split("PartitionFilters:")[1].split("\n")[0]
