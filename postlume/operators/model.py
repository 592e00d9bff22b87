"""Model backend: the caller's client answers each distinct prompt once.

Answers go to a table before anything reads them, so that neither a recompute nor a later run asks
again. They are then laid out by the first digits of their hash, and a run reads those folders alone that
its own prompts fall into. What travels is narrow: every post's prompts are hashed once, into a staged table
of (key, hashes) from which all joins start; a prompt itself moves once, if it has to be asked.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections import defaultdict, deque
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlume import schema as S
from postlume.functions.text import is_blank
from postlume.operators.balance import estimated_bytes
from postlume.operators.tasks import TASKS, Task, with_answer
from postlume.session import broadcast_limit, shared_dir
from postlume.sinks.files import Files

ANSWERS = "prompt_hash string, answer string, task string, model string, prefix string"
#: Hexadecimal digits of a hash that name its folder: 256 folders for each task and model.
PREFIX = 2
#: Runs of one process take turns, by folder, when they lay answers out.
_turns: dict[str, threading.Lock] = defaultdict(threading.Lock)


@dataclass(frozen=True)
class ModelBackend:
    """``connect()`` is called once per task of the job and returns a callable
    ``client(instructions, prompt, answer_schema, task, temperature)`` that gives
    a dict, or JSON text. Both must be picklable. A call that raises, or takes more than
    ``deadline`` seconds, leaves its row unanswered; it is asked again in the next run.
    ``answers`` is the folder of the table that keeps what was paid for.
    """

    connect: Callable[[], Callable]
    model: str
    answers: str
    concurrency: int = 5
    partitions: int | None = None
    calls_per_task: int = 200
    deadline: float = 300.0


def in_order(prompts: Iterator, call: Callable, concurrency: int, deadline: float) -> Iterator:
    """The answers to the prompts, in their order; None for a call that raises or is overdue.

    At most ``concurrency`` calls are under way, and no more answers than that wait for an earlier one.
    A call that is overdue is given up and its place is free again. Once as many have been given
    up as there are places, the client counts as dead and the rest stays unanswered.
    """
    window: deque = deque()
    given_up = 0

    def start(prompt) -> dict:
        slot = {"done": threading.Event(), "answer": None, "until": time.monotonic() + deadline}

        def work():
            try:
                slot["answer"] = call(prompt)
            except Exception:
                pass
            slot["done"].set()

        threading.Thread(target=work, daemon=True).start()
        return slot

    def first():
        nonlocal given_up
        slot = window.popleft()
        if slot is None:
            return None
        if slot["done"].wait(max(0.0, slot["until"] - time.monotonic())):
            return slot["answer"]
        given_up += 1
        return None

    for prompt in prompts:
        if len(window) >= concurrency:
            yield first()
        window.append(start(prompt) if given_up < concurrency else None)
    while window:
        yield first()


def _asker(backend: ModelBackend, task: Task) -> Callable[[Iterator], Iterator]:
    connect, workers, deadline = backend.connect, backend.concurrency, backend.deadline
    fixed = (task.instructions, task.answer_schema(), task.name, task.temperature)

    def ask(batches):
        import pandas

        client = connect()
        instructions, answer_schema, name, temperature = fixed
        hashes: deque = deque()

        def one(prompt):
            answer = client(instructions, prompt, answer_schema, name, temperature)
            return answer if isinstance(answer, str) else json.dumps(answer)

        def prompts():
            for batch in batches:
                hashes.extend(batch["prompt_hash"])
                yield from batch["prompt"]

        rows = []
        for answer in in_order(prompts(), one, workers, deadline):
            rows.append((hashes.popleft(), answer))
            if len(rows) >= 1000:
                yield pandas.DataFrame(rows, columns=["prompt_hash", "answer"])
                rows = []
        if rows:
            yield pandas.DataFrame(rows, columns=["prompt_hash", "answer"])

    return ask


def _hash(task: Task, prompt: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(task.name), F.lit(task.instructions), prompt), 256)


def _prefix(hash: str) -> Column:
    return F.substring(hash, 1, PREFIX)


def stored_answers(spark: SparkSession, task: Task, backend: ModelBackend,
                   prefixes: Sequence[str] | None = None) -> DataFrame:
    """(prompt_hash, answer) of a task, as stored; with ``prefixes`` only those folders are listed and read.
    Answers that a run has not laid out yet are read too."""
    def rows(kind: str) -> DataFrame:
        try:
            # What another run has laid out meanwhile is gone from "new".
            return (spark.read.schema(ANSWERS).option("ignoreMissingFiles", "true")
                    .option("basePath", f"{backend.answers}/{kind}").parquet(f"{backend.answers}/{kind}"))
        except AnalysisException:  # nothing has been stored yet
            return spark.createDataFrame([], ANSWERS)

    def mine(frame: DataFrame) -> DataFrame:
        return frame.where((F.col("task") == task.name) & (F.col("model") == backend.model))

    laid_out = mine(rows("by_hash"))
    if prefixes is not None:
        laid_out = laid_out.where(F.col("prefix").isin(list(prefixes)))
    return laid_out.select("prompt_hash", "answer").union(mine(rows("new")).select("prompt_hash", "answer"))


def _staged_hashes(posts: DataFrame, used: Sequence[Task], keys: Sequence[str], text: str, author: str,
                   folder: str) -> DataFrame:
    """(keys, _asked, a hash for each task) of every post, stored: texts are hashed here and nowhere else."""
    asked = ~is_blank(F.col(text))
    posts.select(*keys, asked.alias("_asked"), *[
        F.when(asked, _hash(t, t.question(F.col(text), F.col(author)))).alias(f"_hash_{t.name}")
        for t in used]).write.parquet(folder)
    return posts.sparkSession.read.parquet(folder)


def _wanted(hashes: DataFrame, task: Task, keys: Sequence[str], folder: str) -> tuple[DataFrame, list[str]]:
    """(prompt_hash, one) for each distinct prompt, ``one`` being the key of a post that has it, stored; and
    the prefixes that occur, 256 at most."""
    hashes.where("_asked").groupBy(F.col(f"_hash_{task.name}").alias("prompt_hash")).agg(
        F.min(F.struct(*keys)).alias("one")).write.parquet(folder)
    wanted = hashes.sparkSession.read.parquet(folder)
    return wanted, [r.prefix for r in wanted.select(_prefix("prompt_hash").alias("prefix")).distinct().collect()]


def _ask_missing(posts: DataFrame, wanted: DataFrame, prefixes: Sequence[str], task: Task, backend: ModelBackend,
                 keys: Sequence[str], text: str, author: str, folder: str) -> None:
    """Ask for every distinct prompt that has no stored answer; store the answers, then lay them out.

    Calls are spread by their number, ``calls_per_task`` each, not by bytes, which say nothing about how long
    they take. Nothing is shuffled between a call and the table that keeps its answer.
    """
    spark = posts.sparkSession
    if str(spark.conf.get("spark.speculation", "false")).lower() == "true":
        raise ValueError("speculative execution would ask the model twice; switch it off")
    wanted.join(stored_answers(spark, task, backend, prefixes), "prompt_hash", "left_anti").write.parquet(f"{folder}-misses")
    misses = spark.read.parquet(f"{folder}-misses").select("prompt_hash", "one.*")
    calls = misses.count()
    if not calls:
        return
    prompt = task.question(F.col(text), F.col(author)).alias("prompt")
    tasks = backend.partitions or -(-calls // backend.calls_per_task)
    texts = posts.select(*keys, text, author)
    if estimated_bytes(misses) <= broadcast_limit(spark):
        # The misses go to the posts; only what is asked moves.
        asked = texts.join(misses, list(keys)).select("prompt_hash", prompt).repartition(tasks)
    else:
        # Both sides move to the tasks that make the calls, once; keys are unique, so these are even.
        asked = texts.repartition(tasks, *keys).join(
            misses.repartition(tasks, *keys).hint("shuffle_hash"), list(keys)).select("prompt_hash", prompt)
    new = f"{backend.answers}/new"
    run = uuid.uuid4().hex
    (asked.mapInPandas(_asker(backend, task), "prompt_hash string, answer string").where("answer IS NOT NULL")
     .withColumns({"task": F.lit(task.name), "model": F.lit(backend.model), "prefix": _prefix("prompt_hash")})
     .write.parquet(f"{new}/run={run}"))
    fresh = spark.read.schema(ANSWERS).parquet(f"{new}/run={run}")
    with _turns[backend.answers]:
        (fresh.repartitionByRange(min(tasks, 16 ** PREFIX), "prefix").write.mode("append")
         .partitionBy("task", "model", "prefix").parquet(f"{backend.answers}/by_hash"))
    # From here on an answer that is in both places would only be read twice.
    Files(spark, new).remove(f"{new}/run={run}")


def _answered(hashes: DataFrame, wanted: dict[str, DataFrame], prefixes: dict[str, list[str]], used: Sequence[Task],
              backend: ModelBackend, staging: str) -> DataFrame:
    """(keys, columns and status of every task) from the stored answers; written to ``staging``.

    The answers of this batch are picked out and made unique first, in a table of
    their own: with no aggregate below the join, a text that very many posts share is
    split over tasks. Blank posts have no prompt and go around the joins.
    """
    spark = hashes.sparkSession
    blank, rows = hashes.where("NOT _asked"), hashes.where("_asked")
    for task in used:
        folder = f"{staging}-{task.name}"
        (stored_answers(spark, task, backend, prefixes[task.name]).join(wanted[task.name].select("prompt_hash"), "prompt_hash", "left_semi")
         .groupBy("prompt_hash").agg(F.min("answer").alias("answer")).write.parquet(folder))
        found = spark.read.schema("prompt_hash string, answer string").parquet(folder)
        rows = rows.join(found.toDF(f"_hash_{task.name}", f"_answer_{task.name}"), f"_hash_{task.name}", "left")
        blank = blank.withColumn(f"_answer_{task.name}", F.lit(None).cast("string"))
    rows = rows.unionByName(blank)
    for task in used:
        rows = with_answer(rows, task, f"_answer_{task.name}", "_asked")
    rows.drop("_asked", *[f"_{part}_{t.name}" for t in used for part in ("hash", "answer")]).write.parquet(staging)
    return spark.read.parquet(staging)


def annotate_by_model(posts: DataFrame, tasks: Sequence[str], backend: ModelBackend,
                      keys: Sequence[str] = S.KEYS, text: str = "text",
                      author: str = "author", staging: str | None = None) -> DataFrame:
    """Add the columns of the tasks; ``posts`` is unique by ``keys``.

    Runs the calls at once. ``posts`` is read once for the hashes, and once per task for the texts to be
    asked: pass a stored frame. Keys, answers and statuses are kept in ``staging``.
    """
    if not tasks:
        return posts
    if unknown := sorted(set(tasks) - set(TASKS)):
        raise ValueError(f"unknown tasks {unknown}; register_task adds one")
    staging = staging or f"{shared_dir(posts.sparkSession)}/postlume-answered-{uuid.uuid4().hex}"
    used = [TASKS[name] for name in tasks]
    hashes = _staged_hashes(posts, used, keys, text, author, f"{staging}-hashes")
    wanted, prefixes = {}, {}
    for task in used:
        wanted[task.name], prefixes[task.name] = _wanted(hashes, task, keys, f"{staging}-{task.name}-wanted")
        _ask_missing(posts, wanted[task.name], prefixes[task.name], task, backend, keys, text, author, f"{staging}-{task.name}")
    return posts.join(_answered(hashes, wanted, prefixes, used, backend, staging), list(keys), "left")


def status_counts(posts: DataFrame, tasks: Sequence[str]) -> DataFrame:
    """(task, status, n) of a frame that carries ``<task>_status`` columns."""
    pairs = F.array(*[F.struct(F.lit(name).alias("task"), F.col(f"{name}_status").alias("status"))
                      for name in tasks])
    return (posts.select(F.explode(pairs).alias("_p")).select("_p.*")
            .groupBy("task", "status").agg(F.count(F.lit(1)).alias("n")))
