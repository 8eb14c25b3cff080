"""Starting, draining and stopping queries."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

Handler = Callable[[DataFrame, int], None]


def start(
    stream: DataFrame,
    handler: Handler,
    checkpoint: str,
    interval_seconds: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Run ``handler`` on each batch; without an interval, process what is there and end.

    An error in the handler fails the query. Its offsets are then not committed, and the batch is
    run again when the query is restarted from the same checkpoint.
    """
    writer = stream.writeStream.foreachBatch(handler).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if interval_seconds is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{interval_seconds} seconds")
    return writer.start()


def drain(stream: DataFrame, handler: Handler, checkpoint: str) -> None:
    start(stream, handler, checkpoint).awaitTermination()


def run_until_stopped(query: StreamingQuery) -> None:
    """Wait for the query; an interrupt stops it after the batch at hand."""
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        query.stop()


def together(spark: SparkSession, tasks: list[Callable[[], None]]) -> None:
    """Submit independent writes of one batch at the same time, so that small jobs share the
    cluster; the first error is raised once all have ended."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
    for task in running:
        task.result()
