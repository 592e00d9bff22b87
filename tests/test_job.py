import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from postlume.operators.model import ModelBackend
from postlume.plans.job import run
from postlume.sinks.snapshot import SnapshotTable
from postlume.sources.providers import Provider
from postlume.streaming.incremental import start_stream
from tests.clients import calls, good, recording

UTC = timezone.utc
T0 = datetime(2024, 1, 1, tzinfo=UTC)
AS_OF = datetime(2024, 2, 1, 12, 30, 15, 999999, tzinfo=UTC)
DDL = "id string, text string, who string, hearts long, at string, scraped_at timestamp"
REGISTRY = {name: Provider(name, id="id", text="text", author="who", likes="hearts", posted_at="at")
            for name in ("red", "blue", "gone")}


def post(i, minute, text="a great day", hearts=1):
    return (i, text, "ann", hearts, "2024-01-31T00:00:00Z", None if minute is None else T0 + timedelta(minutes=minute))


@pytest.fixture
def world(spark, tmp_path):
    """Source tables on disk that a test may replace, and a target."""
    class World:
        def __init__(self):
            self.n, self.paths = 0, {}
            self.target = SnapshotTable(spark, str(tmp_path / "target"))

        def put(self, name, rows, ddl=DDL):
            self.n += 1
            self.paths[name] = str(tmp_path / f"source{self.n}")
            spark.createDataFrame(rows, ddl).write.parquet(self.paths[name])

        def source(self, name):
            return spark.read.parquet(self.paths[name])

        def run(self, **options):
            options = {"as_of": AS_OF, "registry": REGISTRY, "limit": None, **options}
            return run(spark, self.target, source=self.source, **options)

        def rows(self):
            return {(r.source_table, r.source_id): r for r in self.target.read().collect()}
    return World()


def test_a_run_and_the_next(world):
    world.put("red", [post("1", 1), post("2", 2, "idiot"), post("3", 3, None), post(None, 4), post("4", None, " ")])
    world.put("blue", [post("1", 1, hearts=None)])
    report = world.run()
    assert {n: (p.fetched, p.enriched, p.inserted, p.updated) for n, p in report.providers.items()} == {
        "red": (3, 3, 3, 0), "blue": (1, 1, 1, 0), "gone": (0, 0, 0, 0)}
    assert report.total_enriched == 4 and report.providers["gone"].skipped.startswith("KeyError")
    rows = world.rows()
    assert set(rows) == {("red", "1"), ("red", "2"), ("red", "4"), ("blue", "1")}
    row = rows[("red", "2")]
    assert (row.risk_level, row.sentiment_label, row.source_text) == ("low", "negative", "idiot")
    assert row.enriched_at.astimezone(UTC) == AS_OF.replace(microsecond=0)
    assert (str(row.date), row.enrichment_version, row.engagement_score) == ("2024-02-01", "1.0.0", 1.0)
    assert rows[("red", "4")].sentiment_label == "neutral"

    again = world.run()
    assert {p.skipped for n, p in again.providers.items() if n != "gone"} == {"nothing new"}
    # Enriched once is enriched: new counts, or another source with the same id, change nothing of it.
    world.put("red", [post("1", 50, hearts=99), post("5", 51)])
    world.put("blue", [post("1", 1), post("2", 1)])
    assert world.run().total_enriched == 2
    assert world.rows()[("red", "1")].likes == 1
    report = world.run(reenrich=True, providers=["red"])
    assert (report.providers["red"].updated, report.providers["red"].inserted) == (2, 0)
    assert world.rows()[("red", "1")].likes == 99 and len(world.rows()) == 6


def test_limit_is_per_provider_and_newest_first(world):
    world.put("red", [post(str(i), i) for i in range(50)] + [post("n", None)])
    world.put("blue", [post(str(i), 100 - i) for i in range(3)])
    report = world.run(limit=5)
    assert report.providers["red"].fetched == 5 and report.providers["blue"].fetched == 3
    assert {i for t, i in world.rows() if t == "red"} == {"45", "46", "47", "48", "49"}
    world.run(limit=5)
    assert {int(i) for t, i in world.rows() if t == "red"} == set(range(40, 50))


def test_copies_fold_to_the_newest(world):
    hot = [post("hot", m % 40, f"copy {m % 40}") for m in range(400)]
    world.put("red", hot + [post("one", 3)])
    for limit in (None, 7):
        world.target = SnapshotTable(world.target.spark, f"{world.target.path}-{limit}")
        report = world.run(limit=limit, providers="red")
        assert report.providers["red"].fetched == (401 if limit is None else 7)
        assert world.rows()[("red", "hot")].source_text == "copy 39"
        assert len(world.rows()) == report.total_enriched == (2 if limit is None else 1)


def test_modules_that_are_off_leave_columns_alone(world):
    world.put("red", [post("1", 1), post("2", 2)])
    world.run(limit=1)
    report = world.run(reenrich=True, as_of=AS_OF + timedelta(days=1), providers=["red"],
                       modules={"sentiment": "false", "engagement": "FALSE"})
    assert report.providers["red"].updated == 1
    rows = world.rows()
    assert rows[("red", "2")].sentiment_label == "positive"
    assert rows[("red", "1")].sentiment_label is None and rows[("red", "1")].engagement_tier is None
    assert {str(r.date) for r in rows.values()} == {"2024-02-02"}


def test_one_broken_source_does_not_stop_the_others(world):
    world.put("red", [("1",)], "id string")
    world.put("blue", [post("1", 1)])
    report = world.run(providers="red, blue, nowhere")
    assert "AnalysisException" in report.providers["red"].skipped
    assert report.total_enriched == 1 and report.unknown_providers == ["nowhere"]


def test_with_a_model(world, tmp_path):
    (tmp_path / "calls").mkdir()
    notes = str(tmp_path / "calls")
    backend = ModelBackend(recording(notes, good), "m", str(tmp_path / "answers"))
    world.put("red", [post(str(i), i, "same") for i in range(30)] + [post("b", 1, " ")])
    report = world.run(providers=["red"], backend=backend, modules=["sentiment", "engagement"])
    assert report.total_enriched == 31 and len(calls(notes)) == 1
    assert report.providers["red"].statuses == {("sentiment", "ok"): 30, ("sentiment", "blank"): 1}
    rows = world.rows()
    assert rows[("red", "3")].sentiment_topics == ["same"] and rows[("red", "3")].risk_level is None
    assert world.run(providers=["red"], backend=backend).providers["red"].skipped == "nothing new"


def test_only_recent_row_groups_are_read(spark, world, plan):
    from postlume.plans.job import selected_posts
    world.put("red", [post(str(i), i) for i in range(5)])
    wanted = spark.createDataFrame([("4", T0 + timedelta(minutes=4), 1)],
                                   "source_id string, scraped_at timestamp, copies long")
    posts = selected_posts(world.source("red"), REGISTRY["red"], wanted, T0 + timedelta(minutes=4), False)
    assert "GreaterThanOrEqual(scraped_at" in plan(posts)
    assert [r.source_id for r in posts.collect()] == ["4"]


def scanned(plan, frame):
    """Columns that the scans of a plan read."""
    return [part.split(">")[0] for part in plan(frame).split("ReadSchema: struct<")[1:]]


def test_selection_starts_without_a_text(spark, world, plan):
    from postlume.operators.select import next_candidates
    from postlume.sources.posts import source_keys
    world.put("red", [post(str(i), i) for i in range(5)])
    last = (T0 + timedelta(minutes=3), "3")
    step = next_candidates(source_keys(world.source("red"), REGISTRY["red"]), None, last, 2)
    assert scanned(plan, step) == ["id:string,scraped_at:timestamp"]
    assert "LessThan(scraped_at" in plan(step)
    assert sorted(r.source_id for r in step.collect()) == ["1", "2"]


def brute_selection(rows, limit):
    """ids and rows taken: newest first, those without a text or an id left out."""
    good = [(r[5] is None, -(r[5] or T0).timestamp(), r[0]) for r in rows if r[0] is not None and r[1] is not None]
    taken = sorted(good)[:limit]
    return {t[2] for t in taken}, len(taken)


def test_late_reading_fills_the_limit(spark, world):
    """Most of the newest rows have no text, times tie and are missing, ids repeat."""
    rng = random.Random(5)
    rows = [post(rng.choice([f"i{rng.randrange(90)}", None, f"x{i}"]), rng.choice([None, *range(40)]),
                 None if rng.random() < (0.95 if i % 2 else 0.3) else f"text {i}") for i in range(400)]
    world.put("red", rows)
    for limit in (1, 7, 60, 5000):
        world.target = SnapshotTable(spark, f"{world.target.path}-{limit}")
        report = world.run(limit=limit, providers="red").providers["red"]
        ids, n = brute_selection(rows, limit)
        assert (report.fetched, report.null_ids) == (n, sum(r[0] is None for r in rows))
        assert {i for _, i in world.rows()} == ids and report.enriched == len(ids)
    world.put("red", [post(str(i), i, None) for i in range(9)])
    assert world.run(limit=3, providers="red").providers["red"].skipped == "nothing new"
    assert world.run(providers="red").providers["red"].skipped == "nothing new"


def test_a_bad_record_does_not_stop_the_others(spark, world, tmp_path, monkeypatch):
    from pyspark.sql import types as T

    from postlume.operators import modules as M

    monkeypatch.setattr(M, "_modules", dict(M._modules))
    M.register_module(M.Module("number", T.StructType([T.StructField("number", T.IntegerType())]),
                               transform=lambda df, as_of: df.withColumn("number", F.col("text"))))
    world.target = SnapshotTable(spark, str(tmp_path / "numbers"))
    world.put("red", [post("1", 1, "12"), post("2", 2, "many"), post("3", 3, "7"), post("4", 4, "99999999999")])
    rejects = str(tmp_path / "rejects")
    report = world.run(providers="red", rejects=rejects).providers["red"]
    assert (report.fetched, report.enriched, report.rejected, report.skipped) == (4, 2, 2, None)
    assert {i: r.number for (_, i), r in world.rows().items()} == {"1": 12, "3": 7}
    assert {(r.source_id, *r.reasons.items()) for r in spark.read.parquet(rejects).collect()} == {
        ("2", ("number", "many")), ("4", ("number", "99999999999"))}


def test_separate_on_all_kinds_of_values(spark, tmp_path):
    from pyspark.sql import types as T

    from postlume.operators.rejects import separate
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType()), T.StructField("d", T.DateType()),
                           T.StructField("l", T.ArrayType(T.IntegerType())), T.StructField("s", T.StringType())])
    rows = [("a", "1", "2024-01-02", ["1", None], 1), ("b", "x", "2024-01-02", ["1"], 2), ("c", None, "never", ["y"], 3),
            (None, "4", None, None, 4), ("e", None, None, ["5", "z"], None)]
    df = spark.createDataFrame(rows, "k string, n string, d string, l array<string>, s int")
    good, rejected = separate(df, schema, ["k"], str(tmp_path / "s"), str(tmp_path / "r"), check_keys=True)
    assert [(r.k, r.n, str(r.d), r.l, r.s) for r in good.collect()] == [("a", 1, "2024-01-02", [1, None], "1")] and rejected() == 4
    assert {(r.k, *sorted(r.reasons)) for r in spark.read.parquet(str(tmp_path / "r")).collect()} == {
        ("b", "n"), ("c", "d", "l"), (None, "k"), ("e", "l")}
    assert good.schema.simpleString() == "struct<k:string,n:bigint,d:date,l:array<int>,s:string>"
    same, none = separate(df.select("k", "s"), schema, ["k"], str(tmp_path / "unused"))
    assert same.columns == ["k", "s"] and none() == 0


def test_providers_side_by_side(spark, world):
    for name in ("red", "blue"):
        world.put(name, [post(str(i), i) for i in range(20)])
    groups, real = set(), world.source

    def source(name):
        groups.add(spark.sparkContext.getLocalProperty("spark.jobGroup.id"))
        return real(name)
    world.source = source
    report = world.run(side_by_side=3)
    assert report.total_enriched == 40 and "KeyError" in report.providers["gone"].skipped
    assert groups == {"postlume-red", "postlume-blue", "postlume-gone"} and list(report.providers) == ["red", "blue", "gone"]
    assert len(world.rows()) == 40 and world.run(side_by_side=3).total_enriched == 0


def test_stream_in_batches_and_again(spark, world, tmp_path):
    def start(checkpoint):
        stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        start_stream(stream, REGISTRY["red"], world.target, str(tmp_path / checkpoint), as_of=AS_OF) \
            .awaitTermination()

    def arrive(rows):
        spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    arrive([post("1", 1), post("1", 2, "newer"), post(None, 3)])
    arrive([post("1", 9, "late"), post("2", 3)])
    start("c1")
    assert {i: r.source_text for (_, i), r in world.rows().items()}["2"] == "a great day"
    first = world.rows()
    assert len(first) == 2
    arrive([post("3", 4)])
    start("c1")
    assert len(world.rows()) == 3
    # The whole input once more, as after a lost checkpoint: nothing is added or changed.
    start("c2")
    assert world.rows() == {**first, **{k: v for k, v in world.rows().items() if k[1] == "3"}}


def test_copies_in_a_stream_are_known_from_its_state(spark, world, tmp_path, monkeypatch):
    """Copies in one micro-batch, in a later one and after a restart; the keys of the table are not asked."""
    def start():
        stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        start_stream(stream, REGISTRY["red"], world.target, str(tmp_path / "c"), as_of=AS_OF, copies_within="2 days").awaitTermination()

    def arrive(*rows):
        spark.createDataFrame(list(rows), DDL).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    monkeypatch.setattr(SnapshotTable, "is_empty", lambda self: pytest.fail("the table was asked"))
    arrive(post("1", 1, None), post("1", 1, "first"), post("2", 1, "first"))
    start()
    arrive(post("1", 600, "again"), post("3", 601, "first"), post(None, 601))
    start()
    arrive(post("2", 700, "again"), post("4", 700, "first"))
    start()
    assert {i: r.source_text for (_, i), r in world.rows().items()} == dict.fromkeys("1234", "first")


def test_nothing_is_lost_silently(world):
    """Rows without an id are counted, bare dates are stored and score nothing, bad scrape times and
    fractions in text do not stop a source."""
    ddl = "id string, text string, who string, hearts string, at date, scraped_at string"
    day = datetime(2024, 1, 31).date()
    world.put("red", [("1", "a", "ann", "12.7", day, "2024-01-01 00:00:00"), (None, "b", "ann", "1", day, None),
                      ("2", "c", "ann", "x", None, "no time")], ddl)
    report = world.run(providers="red").providers["red"]
    assert (report.fetched, report.null_ids, report.enriched, report.skipped) == (2, 1, 2, None)
    first, second = world.rows()[("red", "1")], world.rows()[("red", "2")]
    assert first.posted_at.replace(tzinfo=UTC) == datetime(2024, 1, 31, tzinfo=UTC) and first.time_adjusted_score == 0
    assert (first.likes, second.likes, second.scraped_at, second.posted_at) == (12, 0, None, None)


def test_an_added_module(spark, world, tmp_path, monkeypatch):
    from pyspark.sql import types as T

    from postlume.operators import modules as M
    from postlume.operators import rules as R

    monkeypatch.setattr(M, "_modules", dict(M._modules))
    for name in ("_RULES", "_VOCABULARY"):
        monkeypatch.setattr(R, name, dict(getattr(R, name)))
    M.register_module(M.Module("size", T.StructType([T.StructField("n_chars", T.IntegerType())]),
                               transform=lambda df, as_of: df.withColumn("n_chars", F.length("text"))))
    M.register_module(M.Module("greeting", T.StructType([T.StructField("greets", T.BooleanType())]), task="greeting"))
    world.target = SnapshotTable(spark, str(tmp_path / "wider"))
    world.put("red", [post("1", 1, "hello you"), post("2", 2, "bye")])
    assert "register_rule" in world.run(providers="red").providers["red"].skipped
    R.register_rule("greeting", lambda df, text: df.withColumn("greets", F.array_contains("_hits", "hello")), {"hello"})
    assert world.run(providers="red").providers["red"].enriched == 2
    rows = world.rows()
    assert [(rows[("red", i)].n_chars, rows[("red", i)].greets) for i in "12"] == [(9, True), (3, False)]
