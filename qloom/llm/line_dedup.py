"""Line-level deduplication by pairwise alignment.

Lines are cut at "\\n". Two documents are aligned where they share a line: a rare line (at most ``rare``
documents hold it) points from each of its documents to the one before and to the first, a more frequent
line to the first alone, so the pairs grow with the lines and not with the square of their frequency. The shortest
runs of lines that reach ``min_words`` from each line on, and back from each line, point to the first document that
holds the whole run; every block that an earlier document holds is made of such runs. Each pair is aligned by patience diff over all its lines, rare or not; lines left over are aligned again where they lie in a
run of ``min_words`` that the earlier document holds at any place, repeated or in another order. Blocks of aligned lines with ``min_words``
words or more are deleted from the later document; as a line's first holder keeps it, no line vanishes.

Documents are ordered by id, then by the hash of their text; null ids come last. Rows with the same id and
text are one document and are treated alike. Null texts stay null and have no lines, empty lines and lines
without a word never start a pair. Very long texts are aligned whole. Lines travel as 64-bit hashes beside
their word counts.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from qloom.functions.stages import settled
from qloom.llm.shared import boxed, cut, unboxed
from qloom.sources.tables import scan

MIN_WORDS = 50
RARE = 5
# an odd number and its inverse modulo 2 ** 64
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)


def runs(lines: list[int], words: list[int], min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, stops, hashes) of the shortest runs of lines with enough words from each line with words on, and back from each."""
    n = len(lines)
    counts = np.asarray(words, np.int64)
    so_far = np.concatenate([[0], np.cumsum(counts)])
    least = max(min_words, 1)
    own = np.flatnonzero(counts > 0)
    stop = np.searchsorted(so_far, so_far[own] + least)
    start = np.searchsorted(so_far, so_far[own + 1] - least, "right") - 1
    starts = np.concatenate([own[stop <= n], start[start >= 0]])
    stops = np.concatenate([stop[stop <= n], own[start >= 0] + 1])
    # a polynomial of the line hashes, modulo 2 ** 64, brought to the run's start
    terms = np.asarray(lines, np.int64).view(np.uint64) * np.cumprod(np.full(n, _BASE, np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
    back = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _BACK, np.uint64)]))
    value = (total[stops] - total[starts]) * back[starts]
    value = (value ^ (value >> np.uint64(29))) * np.uint64(_BASE) + (stops - starts).astype(np.uint64)
    return starts, stops, value.view(np.int64)


def _keys(min_words: int):
    """Of each document: its distinct lines with words, their numbers of words up to ``min_words``, and the hashes of its runs."""

    @F.pandas_udf("lines array<long>, n array<int>, runs array<long>")
    def of(lines: pd.Series, words: pd.Series) -> pd.DataFrame:
        out = []
        for x, w in zip(lines, words):
            x, w = np.asarray(x, np.int64), np.asarray(w, np.int64)
            starts, stops, hashes = runs(x, w, min_words)
            own, first = np.unique(x[w > 0], return_index=True)
            # a run of one line has that line's key
            out.append((own, np.minimum(w[w > 0][first], min_words).astype(np.int32), np.unique(hashes[stops - starts > 1])))
        return pd.DataFrame(out, columns=["lines", "n", "runs"])

    return of


def _matches(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Positions matched by patience diff: common ends, then lines unique to both sides in their longest common order, then the gaps alike."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            found.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            found.append((j, m))
        if i == j or k == m:
            continue
        once = _unique(b, k, m)
        anchors = [(x, once[line]) for line, x in sorted(_unique(a, i, j).items(), key=lambda t: t[1]) if line in once]
        anchors = _longest_rise(anchors)
        if not anchors:
            continue
        for x, y in anchors:
            todo.append((i, x, k, y))
            found.append((x, y))
            i, k = x + 1, y + 1
        todo.append((i, j, k, m))
    return sorted(found)


def _unique(lines: list[int], start: int, stop: int) -> dict[int, int]:
    at: dict[int, int] = {}
    for x in range(start, stop):
        at[lines[x]] = -1 if lines[x] in at else x
    return {line: x for line, x in at.items() if x >= 0}


def _longest_rise(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, ordered by the first, whose seconds rise."""
    ends: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for n, (_, y) in enumerate(pairs):
        p = bisect_left(ends, y)
        before.append(last[p - 1] if p else -1)
        ends[p : p + 1] = [y]
        last[p : p + 1] = [n]
    out = []
    n = last[-1] if last else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def blocks(later: list[int], words: list[int], earlier: list[int], min_words: int) -> list[tuple[int, int, int, int]]:
    """(start in the later, start in the earlier, lines, words) of the aligned runs with enough words.

    Runs that no rising alignment holds, as they are repeated or in another order, come after those of the diff.
    """
    common = set(earlier)
    if sum(w for x, w in zip(later, words) if x in common) < min_words:
        return []
    out: list[tuple[int, int, int, int]] = []
    run: list[int] | None = None
    for i, k in _matches(later, earlier):
        if run and i == run[0] + run[2] and k == run[1] + run[2]:
            run[2] += 1
            run[3] += words[i]
        else:
            run = [i, k, 1, words[i]]
            out.append(run)  # type: ignore[arg-type]
    found = [tuple(r) for r in out if r[3] >= min_words]
    return found + _rest(later, words, earlier, min_words, found)


def _rest(later: list[int], words: list[int], earlier: list[int], min_words: int, found: list) -> list[tuple[int, int, int, int]]:
    """Blocks for the lines outside the given ones that lie in a run with enough words that the earlier document holds anywhere."""
    done = np.zeros(len(later), bool)
    for start, _, n, _ in found:
        done[start : start + n] = True
    common = set(earlier)
    done |= np.fromiter((not w or x not in common for x, w in zip(later, words)), bool, len(later))
    if done.all():
        return []
    # a line that the later lacks ends any run of the earlier: no hash of it is looked up
    known = dict(zip(later, words))
    starts, _, hashes = runs(earlier, [known.get(x, max(min_words, 1)) for x in earlier], min_words)
    at = dict(zip(hashes.tolist(), starts.tolist()))
    out = []
    for start, stop, h in zip(*(x.tolist() for x in runs(later, words, min_words))):
        k = at.get(h)
        if k is None or done[start:stop].all() or later[start:stop] != earlier[k : k + stop - start]:
            continue
        while start and k and later[start - 1] == earlier[k - 1]:
            start, k = start - 1, k - 1
        while stop < len(later) and k + stop - start < len(earlier) and later[stop] == earlier[k + stop - start]:
            stop += 1
        done[start:stop] = True
        out.append((start, k, stop - start, sum(words[start:stop])))
    return out


def _align(min_words: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for i, h, ri, rh, lines, words, others in zip(f["id"], f["key"], f["ref"], f["ref_key"], f["lines"], f["words"], f["others"]):
                for start, ref_start, n, w in blocks(list(lines), list(words), list(others), min_words):
                    rows.append((i, h, ri, rh, start, ref_start, n, w))
            yield pd.DataFrame(rows, columns="id key ref ref_key start ref_start n_lines n_words".split())

    return run


def lines_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, key, lines, words) of the distinct documents: hash and word count of each line."""
    cut_up = F.split(F.col(f"`{text}`"), "\n", -1)
    return (
        docs.select(
            F.col(f"`{doc_id}`").cast("long").alias("id"),
            F.xxhash64(F.col(f"`{text}`")).alias("key"),
            F.transform(cut_up, lambda x: F.xxhash64(x)).alias("lines"),
            F.transform(cut_up, lambda x: F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+"))).alias("words"),
        )
        .where("lines is not null")
        .dropDuplicates(["id", "key"])
    )


def aligned_blocks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, rare: int = RARE) -> DataFrame:
    """One row per block to delete: the later document (id, key), the earlier (ref, ref_key), where it starts in each (0-based line), its lines and words."""
    rows = cut(lines_of(docs, doc_id, text))
    place = F.struct(F.isnull("id").alias("none"), "id", "key")
    keyed = rows.select(place.alias("at"), _keys(min_words)("lines", "words").alias("k")).select("at", "k.*")
    single = F.zip_with("lines", "n", lambda x, n: F.struct(x.alias("line"), F.lit(False).alias("run"), n.alias("n")))
    long = F.transform("runs", lambda x: F.struct(x.alias("line"), F.lit(True).alias("run"), F.lit(min_words).alias("n")))
    held = keyed.select("at", F.explode(F.concat(single, long)).alias("x")).select("at", "x.*")
    # a short line tells something only where it is rare; every block that others hold is made of runs
    tells = F.col("run") | (F.col("df") <= rare) | (F.col("n") >= min_words)
    shared = held.groupBy("line", "run").agg(F.count("*").alias("df"), F.min("at").alias("first"), F.max("n").alias("n"))
    # both cut, so that the join stands alone and adaptive execution may split a line that very many documents hold
    shared = cut(shared.where((F.col("df") > 1) & tells).drop("n"))
    known = cut(held.join(shared, ["line", "run"]))
    to_first = known.where("at <> first").select("at", F.col("first").alias("ref"), "n")
    # rare lines only, so that the window never holds more than ``rare`` rows of a line
    few = known.where(~F.col("run") & (F.col("df") <= rare)).select("line", "at", "first", "n")
    to_last = few.withColumn("ref", F.lag("at").over(Window.partitionBy("line").orderBy("at"))).where("ref is not null and ref <> first").select("at", "ref", "n")
    pairs = to_first.unionByName(to_last).groupBy("at", "ref").agg(F.sum("n").alias("n")).where(F.col("n") >= min_words)
    pairs = pairs.select(F.col("at.id").alias("id"), F.col("at.key").alias("key"), F.col("ref.id").alias("ref"), F.col("ref.key").alias("ref_key"))
    p, a, b = pairs.alias("p"), rows.alias("a"), rows.alias("b")
    same = lambda i, k, x: F.col(f"p.{i}").eqNullSafe(F.col(f"{x}.id")) & (F.col(f"p.{k}") == F.col(f"{x}.key"))
    both = (
        p.join(a, same("id", "key", "a"))
        .select("p.*", "a.lines", "a.words")
        .alias("p")
        .join(b, same("ref", "ref_key", "b"))
        .select(boxed(F.col("p.id")).alias("id"), "p.key", boxed(F.col("p.ref")).alias("ref"), "p.ref_key", "p.lines", "p.words", F.col("b.lines").alias("others"))
    )
    schema = "id long, key long, ref long, ref_key long, start int, ref_start int, n_lines int, n_words int"
    found = both.mapInPandas(_align(min_words), schema)
    return found.withColumn("id", unboxed(F.col("id"))).withColumn("ref", unboxed(F.col("ref")))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = None, min_words: int = MIN_WORDS, rare: int = RARE) -> DataFrame:
    """The documents without the blocks that an earlier document holds; ``n_chars`` names a column to keep as the text's length."""
    gone = aligned_blocks(docs, doc_id, text, min_words, rare)
    # the lines of a document bound what is gathered for it
    gone = (
        gone.select("id", "key", F.explode(F.sequence("start", F.col("start") + F.col("n_lines") - 1)).alias("at"))
        .groupBy("id", "key")
        .agg(F.collect_set("at").alias("gone"))
    )
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    own = whole.select("row", F.col(f"row.`{doc_id}`").cast("long").alias("id"), F.xxhash64(F.col(f"row.`{text}`")).alias("key"))
    same = F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.key") == F.col("r.key"))
    joined = own.alias("l").join(gone.alias("r"), same, "left").select("row", "gone")
    old = F.col(f"row.`{text}`")
    lines = F.when(F.col("gone").isNotNull(), F.split(old, "\n", -1))
    joined = settled(joined.withColumn("lines", lines), "lines")
    # the numbers of the lines that stay, by one set of those that go
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    joined = settled(joined.withColumn("stay", F.when(F.col("gone").isNotNull(), stay)), "stay")
    new = F.when(F.col("gone").isNull(), old).otherwise(F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n"))
    joined = joined.withColumn("new", new)
    out = []
    for c in docs.columns:
        col = F.col(f"row.`{c}`")
        if c == text:
            col = F.col("new")
        elif c == n_chars:
            col = F.when(F.col("gone").isNull(), col).otherwise(F.char_length("new")).cast(docs.schema[c].dataType)
        out.append(col.alias(c))
    return joined.select(*out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks deleted from documents, with production parameters."""
    found = aligned_blocks(scan(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("ref").alias("earlier_doc_id"), "start", "ref_start", "n_lines", "n_words"
    ).distinct()


QUERIES = {"op2_line_dedup": query}
