"""Order-preserving packing of documents into sequences by dynamic programming.

Documents are taken in the order of their ids and laid end to end, each followed by an end id. The stream is
cut into windows of at most ``length`` ids. A cut costs nothing at the end of a document, ``sentence`` at the end of a
sentence, and ``inside`` elsewhere, where cuts are offered every ``grid`` ids of a sentence longer than that; each
unused place of a window costs one. Cheapest cuts follow from

    cost(i) = min over j in [i - length, i) of cost(j) + (length - (i - j)) + penalty(i)

with the smallest cost(j) + j kept by a monotone queue, so that each place is pushed and popped once.

The stream is dealt over tasks by ranges of ids, and each task packs its own range as a stream: of a filled
buffer all windows but the last are final, and the last goes on. So a task holds a bounded number of ids, and
only the last window of a task is cut short by the range's end.

Null and empty texts are the end id alone. Repeated rows are packed each; rows that tie by id are ordered by
the hash of their text; null ids come first. An empty table gives no pieces. Very long texts run over as many
windows as they need.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from qloom.llm.shared import boxed, cut, unboxed
from qloom.llm.tokens import Encoder, vocabulary_path
from qloom.sources.tables import scan

LENGTH = 2048
END = 1
SENTENCE, INSIDE, GRID = 2, 8, 32
# ids a task gathers before it cuts
BUFFER = 1 << 20

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, sequence long, offset long"


def cuts(places: np.ndarray, penalties: np.ndarray, length: int) -> list[int]:
    """The cheapest cuts of a stream, as ascending places ending with the last. Places ascend, none more than ``length`` from the one before."""
    cost = [0] * (len(places) + 1)
    came = [0] * (len(places) + 1)
    at = [0, *places.tolist()]
    extra = [0, *penalties.tolist()]
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (cost + place, index), rising in both
    for i in range(1, len(at)):
        low = at[i] - length
        while at[queue[0][1]] < low:
            queue.popleft()
        best, j = queue[0]
        value = best + length - at[i] + extra[i]
        cost[i], came[i] = value, j
        key = value + at[i]
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, i))
    out = []
    i = len(at) - 1
    while i > 0:
        out.append(at[i])
        i = came[i]
    return out[::-1]


class Packer:
    """Packs documents that come in order; gives pieces as soon as their windows are final."""

    def __init__(self, length: int, sentence_ends: np.ndarray, sentence: int, inside: int, grid: int, buffer: int, marks: list[np.ndarray] = ()):
        self.length, self.ends, self.marks = length, sentence_ends, marks
        self.sentence, self.inside, self.grid, self.buffer = sentence, inside, grid, max(buffer, 4 * length)
        self.docs: deque[list] = deque()  # [doc id, ids left, start of those in the document, all its ids]
        self.size = 0
        self.sequence = 0

    def add(self, doc_id, ids: np.ndarray) -> Iterator[tuple]:
        self.docs.append([doc_id, ids, 0, len(ids)])
        self.size += len(ids)
        if self.size >= self.buffer:
            yield from self.flush(False)

    def _offers(self) -> tuple[np.ndarray, np.ndarray]:
        """Places where the buffered stream may be cut, with what a cut there costs."""
        ids = np.concatenate([d[1] for d in self.docs])
        fee = np.full(len(ids), -1, np.int64)
        fee[self.ends[np.minimum(ids, len(self.ends) - 1)]] = self.sentence
        for mark in self.marks:  # those of several ids
            at = np.flatnonzero(ids[len(mark) - 1 :] == mark[-1]) + len(mark) - 1
            for back in range(1, len(mark)):
                at = at[ids[at - back] == mark[-1 - back]]
            fee[at] = self.sentence
        fee[np.cumsum([len(d[1]) for d in self.docs]) - 1] = 0
        fee[-1] = 0
        place = np.flatnonzero(fee >= 0) + 1
        gaps = np.diff(place, prepend=0)
        more = [np.arange(b - g + self.grid, b, self.grid) for b, g in zip(place[gaps > self.grid].tolist(), gaps[gaps > self.grid].tolist())]
        if more:
            fee[np.concatenate(more) - 1] = self.inside
            place = np.flatnonzero(fee >= 0) + 1
        return place, fee[place - 1]

    def flush(self, last: bool) -> Iterator[tuple]:
        """Pieces of the windows that are final: all at the end, all but the last window before."""
        if not self.size:
            return
        stops = cuts(*self._offers(), self.length)
        if not last:
            stops.pop()
        begin = 0
        for stop in stops:
            room = offset = 0
            room = stop - begin
            while room:
                doc = self.docs[0]
                ids = doc[1][:room]
                n = len(ids)
                yield doc[0], doc[2], n, zlib.crc32(ids.astype("<u4").tobytes()), doc[3], self.sequence, offset
                offset += n
                room -= n
                if n == len(doc[1]):
                    self.docs.popleft()
                else:
                    doc[1], doc[2] = doc[1][n:], doc[2] + n
            self.size -= stop - begin
            begin = stop
            self.sequence += 1


def _pack(path: str, end: int, length: int, sentence: int, inside: int, grid: int, buffer: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path)
        packer = Packer(length, encoder.sentence_ends(), sentence, inside, grid, buffer, encoder.sentence_marks())
        part = TaskContext.get().partitionId()
        names = "doc_id start length ids_crc32 doc_tokens sequence offset".split()

        def frame(rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=names).assign(part=part)[[x.split()[0] for x in PIECES.split(", ")]]

        for f in frames:
            rows = []
            for doc_id, text in zip(f["doc_id"], f["text"]):
                rows.extend(packer.add(doc_id, np.append(encoder.ids(text).astype(np.uint32), np.uint32(end))))
            yield frame(rows)
        yield frame(list(packer.flush(True)))
        encoder.forget()

    return run


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    length: int = LENGTH,
    end: int = END,
    sentence: int = SENTENCE,
    inside: int = INSIDE,
    grid: int = GRID,
    buffer: int = BUFFER,
) -> DataFrame:
    """One row per piece: doc_id, start (its document's ids before it), length, ids_crc32, doc_tokens, sequence_id, offset.

    Sequences are numbered from 0 in the order of the documents.
    """
    own = docs.select(boxed(F.col(f"`{doc_id}`")).alias("doc_id"), F.col(f"`{text}`").alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", F.xxhash64("text")]
    run = _pack(tokenizer or vocabulary_path(), end, length, sentence, inside, min(grid, length), buffer)
    pieces = cut(own.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInPandas(run, PIECES))
    # one row per task
    parts = sorted((r["part"], r["n"]) for r in pieces.groupBy("part").agg(F.max("sequence").alias("n")).collect())
    base, firsts = 0, []
    for part, most in parts:
        firsts.append((part, base))
        base += most + 1
    first = docs.sparkSession.createDataFrame(firsts or [(0, 0)], "part int, first long")
    return pieces.join(F.broadcast(first), "part").select(
        unboxed(F.col("doc_id")).alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", (F.col("first") + F.col("sequence")).alias("sequence_id"), "offset"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(scan(spark, sf_dir, "documents"))


QUERIES = {"op7_packing": query}
