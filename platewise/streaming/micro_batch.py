"""Structured Streaming entry points for the request-driven steps.

The jobs themselves are batch (daily); what arrives continuously are lookup
requests and new menus.  Both are answered by the same DataFrame functions as
in batch, inside ``foreachBatch``.  Each micro-batch is written to its own
``batch_id=N`` directory with overwrite, so a batch replayed after a failure
replaces its own output instead of duplicating it (exactly-once output with
the query checkpoint in the shared folder).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from platewise.plans.lists import serve


def _batch_writer(transform: Callable[[DataFrame], DataFrame], sink_path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch)
        out.write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/batch_id={batch_id}")
    return write


def start_serving(requests: DataFrame, lists_table: Callable[[], DataFrame], sink_path: str,
                  checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Answer a stream of ``user_id`` requests from the keyed list table.

    ``lists_table`` is called per micro-batch, so each batch reads the latest
    committed version of the table (a new daily upsert is picked up).
    """
    def answer(batch: DataFrame) -> DataFrame:
        return serve(batch.select("user_id"), lists_table())

    w = requests.writeStream.foreachBatch(_batch_writer(answer, sink_path)).option(
        "checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def start_tagging(menus: DataFrame, tag: Callable[[DataFrame], DataFrame], sink_path: str,
                  checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Tag each micro-batch of menus with ``tag`` (e.g. a bound ``tag_menus``)."""
    w = menus.writeStream.foreachBatch(_batch_writer(tag, sink_path)).option(
        "checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()
