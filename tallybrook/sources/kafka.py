"""The message-bus source. Only the options live here; parsing starts from the envelope columns."""

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str,
    topic: str,
    starting: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, **settings) -> DataFrame:
    """Needs the ``spark-sql-kafka`` package on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **settings)).load()


def envelope_files(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """The same envelope columns from files dropped into a folder, oldest first."""
    from tallybrook.schemas import envelope_schema

    return (
        spark.readStream.schema(envelope_schema())
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("latestFirst", "false")
        .parquet(path)
    )
