import json
import time

import pytest
from pyspark.sql import functions as F

from postlume import schema as S
from postlume.operators import model as M
from postlume.operators.model import ModelBackend, annotate_by_model, status_counts
from postlume.operators.tasks import MODERATION, SENTIMENT, TASKS, TOPIC, with_answer
from tests.clients import calls, faulty, good, hanging, recording


def posts(spark, texts, author="ann"):
    return spark.createDataFrame([("t", str(i), t, author) for i, t in enumerate(texts)],
                                 "source_table string, source_id string, text string, author string")


@pytest.fixture
def notes(tmp_path):
    (tmp_path / "calls").mkdir()
    return str(tmp_path / "calls")


def backend(notes, tmp_path, answer=good, **options):
    return ModelBackend(recording(notes, answer), "m1", str(tmp_path / "answers"), **options)


def test_each_text_is_asked_once(spark, notes, tmp_path):
    texts = ["same"] * 300 + [f"t{i}" for i in range(20)] + ["", " \n", None]
    df = posts(spark, texts).repartition(6)
    b = backend(notes, tmp_path, partitions=4)
    got = annotate_by_model(df, ["sentiment"], b).collect()
    assert len(got) == len(texts) and len(calls(notes)) == 21
    assert {r.sentiment_topics[0] for r in got if r.sentiment_status == "ok"} == set(texts[299:320])
    blank = [r for r in got if r.sentiment_status == "blank"]
    assert len(blank) == 3 and {r.sentiment_label for r in blank} == {"neutral"}
    # Neither a second run nor a recompute asks again.
    annotate_by_model(df, ["sentiment"], b).collect()
    annotate_by_model(posts(spark, ["same", "brand new"]), ["sentiment"], b).collect()
    assert len(calls(notes)) == 22


def test_another_model_or_task_asks_again(spark, notes, tmp_path):
    df = posts(spark, ["x"])
    for name in ("m1", "m2", "m1"):
        annotate_by_model(df, ["sentiment", "moderation"],
                          ModelBackend(recording(notes, good), name, str(tmp_path / "answers"))).collect()
    assert sorted(c.split("\t")[:2] for c in calls(notes)) == sorted(
        [["sentiment", "0.3"], ["moderation", "0.1"]] * 2)


def test_faults_are_data(spark, notes, tmp_path):
    wanted = {"raise": ("failed", "neutral", 0.0), "list": ("malformed", "unknown", 0.0),
              "broken": ("malformed", "unknown", 0.0), "number": ("partial", "positive", 0.0),
              "missing": ("partial", "negative", 0.0), "extra": ("ok", "positive", 0.5),
              "unknown": ("unknown_value", "neutral", 0.5), "text": ("ok", "negative", 1.0),
              "slow": ("ok", "positive", 0.5)}
    df = annotate_by_model(posts(spark, list(wanted)), ["sentiment"], backend(notes, tmp_path, faulty))
    got = {r.text: (r.sentiment_status, r.sentiment_label, r.sentiment_score) for r in df.collect()}
    assert got == wanted
    counted = {(r.task, r.status): r.n for r in status_counts(df, ["sentiment"]).collect()}
    assert counted[("sentiment", "malformed")] == 2 and sum(counted.values()) == len(wanted)
    assert set(df.columns) == {*S.KEYS, "text", "author", *SENTIMENT.columns, "sentiment_status"}
    # Only the failed call is made again.
    annotate_by_model(posts(spark, list(wanted)), ["sentiment"], backend(notes, tmp_path, faulty)).collect()
    assert len(calls(notes)) == len(wanted) + 1


def test_author_is_context_for_topics_only(spark, notes, tmp_path):
    df = posts(spark, ["x"]).unionByName(posts(spark, ["x"], "bob").withColumn("source_id", F.lit("9")))
    annotate_by_model(df, ["topic", "sentiment"], backend(notes, tmp_path)).collect()
    asked = sorted(c.split("\t") for c in calls(notes))
    assert [(a[0], "ann" in a[2] or "bob" in a[2]) for a in asked] == [
        ("sentiment", False), ("topic", True), ("topic", True)]
    prompt = spark.range(1).select(TOPIC.question(F.lit("x"), F.lit("")).alias("p")).first().p
    assert prompt.endswith("Post:\nx")


def test_no_speculation(spark, notes, tmp_path, monkeypatch):
    spark.conf.set("spark.sql.x", "1")
    real = spark.conf.get
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *d: "true"
                        if key == "spark.speculation" else real(key, *d))
    with pytest.raises(ValueError, match="twice"):
        annotate_by_model(posts(spark, ["x"]), ["sentiment"], backend(notes, tmp_path))


def test_moderation_vocabulary(spark):
    answers = [json.dumps({"is_safe": False, "risk_level": "high", "flags": ["spam", "odd"],
                           "content_warnings": ["w"], "recommended_action": "explode",
                           "confidence_score": 1})]
    df = spark.createDataFrame([(a,) for a in answers], "a string")
    row = with_answer(df.withColumn("asked", F.lit(True)), MODERATION, "a", "asked").first()
    assert row.flags == ["spam"] and row.recommended_action == "none" and row.risk_level == "high"
    assert row.moderation_status == "unknown_value" and row.confidence_score == 1.0 and row.is_safe is False


def test_answer_schemas_and_temperatures():
    assert {n: t.temperature for n, t in TASKS.items()} == {
        "sentiment": 0.3, "entities": 0.2, "topic": 0.2, "moderation": 0.1}
    for task in TASKS.values():
        schema = json.loads(task.answer_schema())
        assert schema["required"] == list(schema["properties"]) == task.columns == list(task.defaults)


def test_texts_are_hashed_once_and_only_hashes_move(spark, plan, notes, tmp_path):
    df = posts(spark, ["x", "y", "x"] + [f"t{i}" for i in range(30)])
    df.write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    hashes = M._staged_hashes(df, [SENTIMENT, TOPIC], S.KEYS, "text", "author", str(tmp_path / "h"))
    assert hashes.columns == [*S.KEYS, "_asked", "_hash_sentiment", "_hash_topic"]
    narrow = hashes.groupBy("_hash_sentiment").agg(F.min(F.struct(*S.KEYS)))
    assert plan(narrow).split("ReadSchema: ")[1].startswith("struct<source_table:string,source_id:string,_hash_sentiment:string>")
    # All further plans start from the stored hashes: sha2 is in none of them.
    seen = []
    b = backend(notes, tmp_path)
    original = M._answered

    def spy(hashes, *rest):
        seen.append(plan(hashes))
        return original(hashes, *rest)
    M._answered = spy
    try:
        out = annotate_by_model(df, ["sentiment", "topic"], b)
    finally:
        M._answered = original
    assert len(out.collect()) == 33 and "sha2" not in seen[0] + plan(out)
    assert len(calls(notes)) == 2 * 32


def test_only_the_folders_of_the_prompts_are_read(spark, plan, notes, tmp_path):
    b = backend(notes, tmp_path)
    annotate_by_model(posts(spark, [f"text {i}" for i in range(200)]), ["sentiment"], b).collect()
    assert not [p for p in (tmp_path / "answers" / "new").rglob("*.parquet")]
    whole = M.stored_answers(spark, SENTIMENT, b)
    hashes = M._staged_hashes(posts(spark, ["text 7", "text 8"]), [SENTIMENT], S.KEYS, "text", "author", str(tmp_path / "h"))
    wanted, prefixes = M._wanted(hashes, SENTIMENT, S.KEYS, str(tmp_path / "w"))
    few = M.stored_answers(spark, SENTIMENT, b, prefixes)
    assert len(prefixes) == 2 and "prefix#" in plan(few).split("PartitionFilters: ")[1].split("\n")[0]
    assert few.count() < 20 < whole.count() == 200
    assert few.join(wanted, "prompt_hash", "left_semi").count() == 2


def test_answers_that_were_not_laid_out_are_found(spark, notes, tmp_path, monkeypatch):
    b = backend(notes, tmp_path)
    df = posts(spark, ["a", "b"])
    real = M.Files.remove
    monkeypatch.setattr(M.Files, "remove", lambda self, path: None)  # ended before it tidied up
    annotate_by_model(df, ["sentiment"], b).collect()
    monkeypatch.setattr(M.Files, "remove", real)
    got = annotate_by_model(df, ["sentiment"], b).collect()
    assert len(calls(notes)) == 2 and len(got) == 2 and all(r.sentiment_status == "ok" for r in got)


def test_many_misses_move_once_to_the_tasks_that_ask(spark, notes, tmp_path):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = posts(spark, [f"text {i}" for i in range(60)] + ["hot"] * 200)
        got = annotate_by_model(df, ["sentiment"], backend(notes, tmp_path, calls_per_task=10)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(calls(notes)) == 61 and all(r.sentiment_status == "ok" for r in got) and len(got) == 260


def test_calls_in_order_under_a_deadline():
    started, under_way, most = [], [], []

    def call(prompt):
        started.append(prompt)
        under_way.append(prompt)
        most.append(len(under_way))
        if prompt % 10 == 3:
            time.sleep(60)
        time.sleep(0.02 * (prompt % 3))
        under_way.remove(prompt)
        if prompt % 10 == 5:
            raise RuntimeError
        return prompt

    begin = time.monotonic()
    got = list(M.in_order(iter(range(28)), call, 4, 0.5))
    assert got == [None if i % 10 in (3, 5) else i for i in range(28)] and time.monotonic() - begin < 10
    assert max(most) <= 4 + 3  # those given up linger, beside four that run
    # A dead client is not asked for ever.
    started.clear()
    assert list(M.in_order(iter([3] * 50), call, 2, 0.1)) == [None] * 50 and len(started) <= 4


def test_a_client_that_hangs_does_not_hold_the_run(spark, notes, tmp_path):
    b = backend(notes, tmp_path, hanging, deadline=1.0, partitions=1)
    begin = time.monotonic()
    got = {r.text: r.sentiment_status for r in annotate_by_model(posts(spark, ["a", "hang", "b"]), ["sentiment"], b).collect()}
    assert got == {"a": "ok", "hang": "failed", "b": "ok"} and time.monotonic() - begin < 60


def test_calls_are_spread_by_number(spark, notes, tmp_path, monkeypatch):
    monkeypatch.setattr(M.Files, "remove", lambda self, path: None)
    b = backend(notes, tmp_path, calls_per_task=5)
    annotate_by_model(posts(spark, [f"text {i}" for i in range(40)]), ["sentiment"], b).collect()
    assert len(list((tmp_path / "answers" / "new").rglob("part-*.parquet"))) >= 4


def test_blank_and_shared_texts(spark, notes, tmp_path):
    b = backend(notes, tmp_path)
    df = posts(spark, ["same"] * 30 + [" "] * 30 + [None])
    rows = annotate_by_model(df, ["sentiment", "topic"], b).collect()
    assert len(rows) == 61 and len(calls(notes)) == 2
    assert sum(r.sentiment_status == "blank" for r in rows) == 31


def test_unknown_task_is_an_error(spark, notes, tmp_path):
    with pytest.raises(ValueError, match="unknown tasks"):
        annotate_by_model(posts(spark, ["x"]), ["no_such"], backend(notes, tmp_path))
