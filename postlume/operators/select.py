"""Which posts a run has to work on: not enriched yet, newest first, once each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Bins of time that one pass of ``newest_of_many`` counts; what the driver gets of each.
BINS = 1 << 14


def not_enriched(posts: DataFrame, enriched_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not among ``enriched_keys``; a NULL key never matches.

    Left to Catalyst and AQE: broadcast when the statistics say the keys are
    small, else a sort-merge join whose hot left partitions AQE splits.
    """
    return posts.join(enriched_keys.select(*keys), list(keys), "left_anti")


def latest_per_key(rows: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``newest_first``.

    The ``= 1`` filter lets Spark keep one row per key in every map task before
    the shuffle, so a key with very many copies does not meet in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return rows.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


def dedup_posts(posts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The post scraped last per key; copies scraped together are told apart by hash."""
    whole_row = F.xxhash64(*[F.col(c) for c in posts.columns])
    return latest_per_key(posts, keys, [F.col("scraped_at").desc_nulls_last(), whole_row.desc()])


def top_per_group(rows: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group.

    Every map task keeps ``k`` rows per group before the shuffle as long as ``k``
    is within ``windowGroupLimitThreshold``. Beyond that a first ranking runs on
    salted groups, as many salts as shuffle partitions, so that a group holding most
    of the rows is spread over all tasks and only ``k`` rows per salt go on.
    """
    spark = rows.sparkSession
    threshold = int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))

    def ranked(frame: DataFrame, by: Sequence) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order)
        return frame.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= k)

    if k <= threshold:
        return ranked(rows, group).drop("_rank")
    salts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(salts))
    first = ranked(rows.withColumn("_salt", salt), [*group, "_salt"]).drop("_rank", "_salt")
    return ranked(first, group).drop("_rank")


def after(last: tuple | None) -> Column:
    """Rows that come after ``last``, a (scraped_at, source_id), newest first: a bound that reaches the scan."""
    if last is None:
        return F.lit(True)
    at, id = last
    undated = F.col("scraped_at").isNull()
    if at is None:
        return undated & (F.col("source_id") > F.lit(id))
    time = F.col("scraped_at")
    return (time < F.lit(at)) | ((time == F.lit(at)) & (F.col("source_id") > F.lit(id))) | undated


def next_candidates(candidates: DataFrame, enriched_keys: DataFrame | None, last: tuple | None,
                    n: int) -> DataFrame:
    """(source_id, scraped_at) of the ``n`` newest rows after ``last`` that are not enriched, each once.

    The step of a selection that reads the texts late: what is taken is narrow, and whoever goes on
    from the last of them sees every row of a (source_id, scraped_at) in one step.
    """
    fresh = candidates.where(F.col("source_id").isNotNull() & after(last))
    if enriched_keys is not None:
        fresh = not_enriched(fresh, enriched_keys, ["source_id"])
    return fresh.orderBy(F.col("scraped_at").desc_nulls_last(), "source_id").limit(n).distinct()


def newest_of_many(rows: DataFrame, k: int, folder: str) -> DataFrame:
    """The first ``k`` of (source_id, scraped_at), newest first, ties by id, folded as by ``pending``, where
    ``k`` is too large for the rows to meet in one task.

    Passes over the narrow rows count them by time, in bins that get finer around the k-th newest, until
    its time is known exactly; each pass reads only the times that are still in question. Everything newer is in. Of that
    very time the smallest ids are: their counts are summed up in ranges of ids, with one
    number for each range on the driver. ``folder`` is scratch space that all executors reach.
    """
    spark = rows.sparkSession
    time = F.unix_micros("scraped_at")
    dated = rows.where("scraped_at IS NOT NULL")
    span = rows.agg(F.min(time).alias("low"), F.max(time).alias("high"), F.count("scraped_at").alias("dated")).first()

    def folded(part: DataFrame) -> DataFrame:
        return part.groupBy("source_id").agg(F.max("scraped_at").alias("scraped_at"), F.count(F.lit(1)).alias("copies"))

    def between(low: int, high: int) -> Column:
        # Comparisons with the column itself, so that they reach the scan.
        return F.col("scraped_at").between(F.timestamp_micros(F.lit(low)), F.timestamp_micros(F.lit(high)))

    if span["dated"] < k:
        newer, ties, need = dated, rows.where("scraped_at IS NULL"), k - span["dated"]
    else:
        low, high, need = span["low"], span["high"], k
        newest = high
        while low < high:
            width = (high - low) // BINS + 1
            bins = dated.where(between(low, high)).groupBy(F.floor((time - low) / width).cast("long").alias("bin")).count()
            for bin, n in sorted(map(tuple, bins.collect()), reverse=True):
                if n >= need:
                    low, high = low + bin * width, min(high, low + (bin + 1) * width - 1)
                    break
                need -= n
        newer = dated.where(between(low + 1, newest)) if low < newest else dated.where("false")
        ties = dated.where(between(low, low))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    # Rows of one id fold first, so that a range is no larger than others because an id is frequent.
    folded(ties).repartitionByRange(ranges, "source_id").withColumn("_range", F.spark_partition_id()).write.parquet(folder)
    ranged = spark.read.parquet(folder)
    before, starts = 0, []
    for r in sorted(ranged.groupBy("_range").agg(F.sum("copies").alias("n")).collect()):
        starts.append((r["_range"], before))
        before += r["n"]
    start = F.create_map(*[F.lit(x) for pair in starts for x in pair]) if starts else F.create_map(F.lit(-1), F.lit(0))
    window = Window.partitionBy("_range").orderBy("source_id").rowsBetween(Window.unboundedPreceding, -1)
    sofar = F.element_at(start, F.col("_range")) + F.coalesce(F.sum("copies").over(window), F.lit(0))
    reached = [pid for pid, n in starts if n < need]
    chosen = ranged.where(F.col("_range").isin(reached)).withColumn("_sofar", sofar).where(F.col("_sofar") < need).select(
        "source_id", "scraped_at", F.least("copies", F.lit(need) - F.col("_sofar")).alias("copies"))
    return folded(newer).unionByName(chosen).groupBy("source_id").agg(
        F.max("scraped_at").alias("scraped_at"), F.sum("copies").alias("copies"))


def pending(candidates: DataFrame, enriched_keys: DataFrame | None, limit: int | None) -> DataFrame:
    """What one provider still has to enrich: one row per id.

    ``candidates`` is (source_id, scraped_at); texts do not travel through the
    anti-join or the top-k. ``copies`` counts the selected rows of an id and
    ``scraped_at`` is the newest of them. The limit counts rows, as selected,
    before copies fold; it is meant to be small, as its rows meet in one task.
    """
    fresh = candidates.where(F.col("source_id").isNotNull())

    def folded(rows: DataFrame) -> DataFrame:
        return rows.groupBy("source_id").agg(
            F.max("scraped_at").alias("scraped_at"), F.count(F.lit(1)).alias("copies"))

    if limit is None:
        # Copies fold in the map tasks, so that an id with very many of them joins as one row.
        fresh = folded(fresh)
    if enriched_keys is not None:
        fresh = not_enriched(fresh, enriched_keys, ["source_id"])
    if limit is None:
        return fresh
    return folded(fresh.orderBy(F.col("scraped_at").desc_nulls_last(), "source_id").limit(limit))
