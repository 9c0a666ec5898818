"""Tables that only add up, kept beside a stream.

Every micro-batch adds the part of its own rows in a folder of its own; nothing is rewritten.
Some batches make a generation. The first batch of a generation brings the one before into
its shortest form, so a reader meets the folders of one generation at most, however many
batches came before. Which folders count follows from the batch number alone, so a replay
reads what the first attempt read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.session import delete_folder
from riskweave.sources.tables import _exists, _names, batch_ids, read_table, write_batch

#: Micro-batches a generation: how many small folders a reader meets at most.
GENERATION = 8


def _folder(path: str, generation: int) -> str:
    return f"{path}/generation={generation}"


def read_sums(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    before_batch: int,
    partition: str | None = None,
) -> DataFrame:
    """What micro-batches before one have added, stacked; with the column ``partition``, if any.

    The first batch has nothing before it; a later one without a table is refused.
    """
    folder = _folder(path, max(before_batch - 1, 0) // GENERATION)
    if before_batch > 0 and not _exists(spark, folder):
        raise RuntimeError(f"{folder} is missing: start with a new store to build the sums")
    place = [T.StructField("batch_id", T.LongType())]
    if partition is not None:
        place.append(T.StructField(partition, T.IntegerType()))
    rows = read_table(spark, folder, T.StructType([*schema.fields, *place]))
    return rows.filter(F.col("batch_id") < before_batch).drop("batch_id")


def add_sums(
    own: DataFrame,
    batch_id: int,
    path: str,
    shortest: Callable[[DataFrame], DataFrame],
    partition: str | None = None,
) -> None:
    """Add the part of a micro-batch; a replay changes nothing.

    ``shortest`` brings stacked parts into their shortest form.
    """
    spark, generation = own.sparkSession, batch_id // GENERATION
    if batch_id and batch_id % GENERATION == 0:
        kinds = T.StructType([f for f in own.schema.fields if f.name != partition])
        before = read_sums(spark, path, kinds, batch_id, partition)
        own = shortest(before.unionByName(own))
    write_batch(own, _folder(path, generation), batch_id, once=True, partition=partition)
    # The batch that merged it is committed, so the generation before is not read again.
    if generation and batch_id % GENERATION:
        delete_folder(spark, _folder(path, generation - 1))


def next_batch(spark: SparkSession, path: str) -> int:
    """The number of the batch that would come next: all before it are there."""
    found = [int(n.removeprefix("generation=")) for n in _names(spark, path) if n.startswith("generation=")]
    ids = batch_ids(spark, _folder(path, max(found))) if found else []
    return max(ids) + 1 if ids else 0
