"""Helpers that several operators share: words, cut lineage, files in the shared folder, exact ranks."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from qloom.session import enable_checkpoints, work_folder

# ASCII white space only; bytes.split() cuts at exactly these characters
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; a null text has none."""
    return text.encode().split() if text else []


# stands for a null id inside Python tasks, where pandas would turn nullable numbers to floats and lose digits
NO_ID = -(1 << 63)


def boxed(column: Column) -> Column:
    return F.coalesce(column.cast("long"), F.lit(NO_ID))


def unboxed(column: Column) -> Column:
    return F.nullif(column, F.lit(NO_ID))


def cut(df: DataFrame) -> DataFrame:
    """The same rows, read from the shared checkpoint folder: a lost executor costs no recomputation."""
    enable_checkpoints(df.sparkSession)
    return df.checkpoint()


def tidied(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle and checkpoint files that nothing refers to any more, for loops that make many.

    It does so once the driver's garbage is collected, which a driver with little to do puts off while disks fill. Files in use stay:
    ``spark.sql.classic.shuffleDependency.fileCleanup.enabled`` also takes those that a step given up by adaptive execution still reads.
    """
    gc.collect()
    # Python's references are given up by a thread that sleeps for a second at a time: what waits for it is given up here
    waiting = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", ())
    for _ in range(len(waiting)):
        try:
            client, target = waiting.pop()
        except IndexError:  # that thread was faster
            break
        client.garbage_collect_object(target, False)
    spark.sparkContext._jvm.System.gc()


def in_place(df: DataFrame) -> DataFrame:
    """The same rows cut, remembered as lying where they lie, for joins and groupings by the keys they are dealt and sorted by.

    A checkpoint remembers that only if its plan was fixed before it ran, so this one is.
    """
    conf, adaptive = df.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(adaptive)
    conf.set(adaptive, "false")
    try:
        # planned anew under the setting
        return cut(df.select("*"))
    finally:
        conf.set(adaptive, before)


def placed(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt by the keys and sorted by them: with ``in_place``, later joins by these keys move the other side alone."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).sortWithinPartitions(*keys)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared root, as a URI that pyarrow reads too."""
    folder = work_folder(spark, name)
    if folder.startswith("file:/") and not folder.startswith("file://"):
        return "file://" + folder[len("file:") :]
    return folder if "://" in folder else "file://" + folder


def open_out(folder: str, stem: str):
    """(path, stream) of a new file. The name is new for each attempt of a task, so that attempts never share one."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    name = f"{stem}-{uuid.uuid4().hex}"
    return f"{folder}/{name}", store.open_output_stream(f"{root}/{name}")


def open_in(path: str):
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def ranked(df: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """The rows with their 0-based place in a complete order, without a window over all rows.

    Rows are dealt by ranges of the order and numbered inside each part; the counts of the parts (one
    row each) give the parts' first places. Ids in the rows are boxed, as pandas would round nullable ones.
    """
    schema = df.selectExpr("*", "0 AS part", "0L AS inner_place").schema

    def number(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, place = TaskContext.get().partitionId(), 0
        for frame in frames:
            yield frame.assign(part=part, inner_place=range(place, place + len(frame)))
            place += len(frame)

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = cut(df.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInPandas(number, schema))
    counts = {r["part"]: r["count"] for r in numbered.groupBy("part").count().collect()}
    base, starts = 0, []
    for part in sorted(counts):
        starts.append((part, base))
        base += counts[part]
    first = df.sparkSession.createDataFrame(starts or [(0, 0)], "part int, first long")
    return numbered.join(F.broadcast(first), "part").withColumn(rank, F.col("inner_place") + F.col("first")).drop("part", "inner_place", "first")
