"""Token ids as length-delimited binary records with checksums, and an index of offsets beside each file.

A record is

    length of the payload, u64 little-endian | masked CRC of those 8 bytes, u32 | payload | masked CRC of it, u32

and its payload is the document's id (i64; the smallest stands for a null id), the number of ids (u32), the width of an id in
bytes (u32) and the ids, little-endian, 2 bytes each where the vocabulary fits and 4 otherwise. The checksum is
CRC-32 as in zlib, masked by rotating it right by 15 bits and adding 0xa282ead8, so that a checksum of data that holds checksums stays useful.
The index is a file of u64: the offset of each record, then the file's size.

Files hold ascending ids: rows are dealt by ranges of ids and sorted inside. Each attempt of a task writes files of its own
names in the shared folder, and only those in the manifest (one row per file, cut by a checkpoint) count, so a
repeated task leaves no doubt. Readers take records through the index, in any order, and check both sums.

Null and empty texts are records of the end id alone. Repeated rows are records each; rows that tie by id are
ordered by the hash of their text; null ids come first. An empty table gives no files and no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from qloom.llm.shared import boxed, cut, open_in, open_out, shared_folder, unboxed
from qloom.llm.tokens import Encoder, vocabulary_path
from qloom.sources.tables import scan

END = 2
# a file is closed when it has grown to so many bytes
FILE_BYTES = 64 << 20

MANIFEST = "part int, place int, path string, index string, n_records long, n_tokens long"


def masked(crc: int) -> int:
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked(zlib.crc32(head))), payload, struct.pack("<I", masked(zlib.crc32(payload)))))


def unframe(stream, offset: int, end: int) -> bytes:
    """The payload of the record between two offsets; ValueError if a length or a checksum is wrong."""
    stream.seek(offset)
    data = stream.read(end - offset)
    if len(data) < 16:
        raise ValueError(f"record at {offset} is cut off")
    n, head = struct.unpack_from("<QI", data)
    if head != masked(zlib.crc32(data[:8])) or n != len(data) - 16:
        raise ValueError(f"record at {offset} has a wrong length")
    payload = data[12:-4]
    if struct.unpack("<I", data[-4:])[0] != masked(zlib.crc32(payload)):
        raise ValueError(f"record at {offset} has a wrong checksum")
    return payload


def serialized(doc_id: int, ids: np.ndarray) -> bytes:
    return struct.pack("<qII", doc_id, len(ids), ids.dtype.itemsize) + ids.tobytes()


def deserialized(payload: bytes) -> tuple[int, np.ndarray]:
    doc_id, n, width = struct.unpack_from("<qII", payload)
    ids = np.frombuffer(payload, f"<u{width}", n, 16)
    return doc_id, ids


class _Writer:
    def __init__(self, folder: str, part: int, place: int):
        self.folder, self.part, self.place = folder, part, place
        self.stem = f"part-{part:05d}-{place:05d}"
        self.path, self.out = open_out(folder, f"{self.stem}.records")
        self.sizes: list[int] = []
        self.size = self.tokens = 0

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        data = frame(serialized(doc_id, ids))
        self.out.write(data)
        self.sizes.append(len(data))
        self.size += len(data)
        self.tokens += len(ids)

    def close(self) -> tuple:
        self.out.close()
        path, out = open_out(self.folder, f"{self.stem}.index")
        with out:
            out.write(np.array([0, *accumulate(self.sizes)], "<u8").tobytes())
        return self.part, self.place, self.path, path, len(self.sizes), self.tokens


def _write(folder: str, tokenizer: str, end: int, file_bytes: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(tokenizer)
        part, place, writer = TaskContext.get().partitionId(), 0, None
        columns = [x.split()[0] for x in MANIFEST.split(", ")]
        for f in frames:
            for doc_id, text in zip(f["doc_id"], f["text"]):
                if writer is None:
                    writer = _Writer(folder, part, place)
                ids = np.append(encoder.ids(text), encoder.dtype.type(end))
                writer.add(doc_id, ids)
                if writer.size >= file_bytes:
                    yield pd.DataFrame([writer.close()], columns=columns)
                    place, writer = place + 1, None
        if writer:
            yield pd.DataFrame([writer.close()], columns=columns)
        encoder.forget()

    return run


def write_records(
    docs: DataFrame,
    folder: str,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end: int = END,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Writes the records and indexes to a shared folder (a URI); the manifest, one row per file, in the order of part and place."""
    own = docs.select(boxed(F.col(f"`{doc_id}`")).alias("doc_id"), F.col(f"`{text}`").alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", F.xxhash64("text")]
    return cut(
        own.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .mapInPandas(_write(folder, tokenizer or vocabulary_path(), end, file_bytes), MANIFEST)
    )


def offsets(index: str) -> np.ndarray:
    with open_in(index) as stream:
        return np.frombuffer(stream.read(), "<u8").astype(np.int64)


def read_file(path: str, index: str, order: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """The records of one file, in a wanted order of their numbers, else as written."""
    at = offsets(index)
    with open_in(path) as stream:
        for k in range(len(at) - 1) if order is None else order.tolist():
            yield deserialized(unframe(stream, int(at[k]), int(at[k + 1])))


def read_records(manifest: DataFrame) -> DataFrame:
    """One row per record of the manifest's files: doc_id, start (ids in all records before it), n_tokens, ids_crc32 (of the ids as u32)."""
    # one row per file
    files = sorted(manifest.collect(), key=lambda r: (r["part"], r["place"]))
    starts = list(accumulate((r["n_tokens"] for r in files), initial=0))
    spark = manifest.sparkSession
    rows = [(r["path"], r["index"], s) for r, s in zip(files, starts)]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, index, start in zip(f["path"], f["index"], f["start"]):
                out = []
                for doc_id, ids in read_file(path, index):
                    out.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                    if len(out) == 10_000:
                        yield pd.DataFrame(out, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                        out = []
                yield pd.DataFrame(out, columns=["doc_id", "start", "n_tokens", "ids_crc32"])

    if not rows:
        return spark.createDataFrame([], schema)
    listed = spark.createDataFrame(rows, "path string, index string, start long")
    read = listed.repartition(len(rows), "path").mapInPandas(run, schema)
    return read.withColumn("doc_id", unboxed(F.col("doc_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_records(write_records(scan(spark, sf_dir, "documents"), shared_folder(spark, "token-records")))


QUERIES = {"op6_token_records": query}
