"""The same enrichment on a stream of source rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from postlume.operators.model import ModelBackend
from postlume.operators.modules import switched_on
from postlume.plans.job import enrich_new
from postlume.sources.providers import Provider


def start_stream(stream: DataFrame, provider: Provider, target, checkpoint: str,
                 modules: Mapping | Sequence[str] | None = None,
                 as_of: datetime | None = None, backend: ModelBackend | None = None,
                 copies_within: str | None = None, **trigger) -> StreamingQuery:
    """Run the enrichment on every micro-batch; by default until the input is used up.

    A batch that is replayed after a failure finds its keys in the table and adds
    nothing, so each post is enriched once. ``checkpoint`` must be shared storage.

    ``copies_within``, such as '3 days', keeps the ids of that span of scrape times as state of the stream:
    of the copies of an id, in whatever micro-batches, the first one with a text goes on, and the keys of the table
    are not read to find out. Rows that come later than that are dropped, as is usual with a watermark, and rows without an id
    too. A replayed batch writes the same keys again and changes nothing.
    """
    on, _ = switched_on(modules)
    target.create()
    if copies_within:
        stream = (stream.where(f"({provider.text}) IS NOT NULL AND `{provider.id}` IS NOT NULL")
                  .withWatermark(provider.scraped_at, copies_within).dropDuplicatesWithinWatermark([provider.id]))

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # its parts are read several times; the stream's state is gone through once
        try:
            enrich_new(batch, provider, target, on, as_of or datetime.now(timezone.utc),
                       backend=backend, reenrich=bool(copies_within))
        finally:
            batch.unpersist()

    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
