"""Arrivals into a lasting keyed table: a key is taken once, whenever it comes again."""

from __future__ import annotations

from pyspark.sql import DataFrame

from logsentry.operators.keyed_table import KeyedTable
from logsentry.session import drop, pin, written


def reject_known(arrivals: DataFrame, table: KeyedTable, source: str, checkpoint: str, arrival: str, rejects: str | None = None,
                 timeout: int | None = None) -> KeyedTable:
    """Insert a stream into ``table``, everything available now: of each key the first arrival ever stays.

    The table's commit holds the number of the last batch of ``source``, so a batch that Spark repeats after a failure changes
    nothing; the number of splits read follows the keys that a batch may share with the table, not the table. ``rejects`` names a
    folder for the rows turned away, one folder per batch, written before the batch counts as taken.
    """
    def take(batch: DataFrame, number: int) -> None:
        if number <= (table.last_batch(source) if table.last_batch(source) is not None else -1):
            return
        rows = pin(batch, "arrivals")
        path = written()[-1]
        table.insert(rows, arrival, source, number, f"{rejects}/batch={number}" if rejects else None)
        drop(rows.sparkSession, [path])

    query = arrivals.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination(timeout) if timeout else query.awaitTermination()
    return table
