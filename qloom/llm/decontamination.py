"""Benchmark decontamination by templates.

Words are cut at ASCII white space, stripped of the punctuation around them and lower-cased. Numbers, names (words
that start with a capital and go on in lower case) and units become typed placeholders, so that a question with
other numbers or names keeps its template. Windows of ``window`` template tokens with at least ``literals``
literal ones are hashed, once with names as placeholders and once with names as ordinary lower-cased words (so that
a change of case hides nothing), and joined with those of the benchmark (an item shorter than that is one window).
Windows of a document and an item that meet on one diagonal (document position minus item position) are put
together: the value that fills a slot must be the same wherever the item repeats a value, or the diagonal does
not count. A document holds an item if ``coverage`` of the item's windows are found on consistent diagonals.

An item without a window of so many literals (arithmetic, lists of names, scripts without blanks) is searched as it is: its words,
numbers and names included, and its characters one by one where a script has no blanks, are one window that a document has to hold in
full. Null and empty texts have no windows; items of fewer than ``EXACT`` words or such characters can't be told apart and never match. A repeated
item or document is reported once per id and text; null ids are reported as null. Very long texts are read
whole. The windows of the benchmark are broadcast only up to ``broadcast_windows`` of them; with more, the
windows of all documents are shuffled to them instead, with the same result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from qloom.llm.shared import boxed, cut, unboxed
from qloom.sources.tables import scan

WINDOW = 8
LITERALS = 4
COVERAGE = 0.5
BROADCAST_WINDOWS = 1_000_000
# words (or characters of scripts without blanks) that an item without other windows needs to be searched as it is
EXACT = 4
# words remembered per task
KNOWN = 300_000

NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
UNITS = frozenset(
    "km cm mm kg mg ml mph kph mile miles meter meters metre metres kilometer kilometers kilometre kilometres "
    "gram grams kilogram kilograms liter liters litre litres inch inches foot feet yard yards pound pounds ounce "
    "ounces dollar dollars euro euros cent cents percent hour hours minute minutes second seconds day days week weeks "
    "month months year years".split()
)
NUMBERS = frozenset(
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
_EDGE = "\"'`.,;:!?()[]{}<>“”‘’«»„¡¿…"
_NUMBER = re.compile(r"[+\-−$€£#]?\d[\d.,:/\-−]*(?:%|st|nd|rd|th|[a-z]{1,3})?")


def canonical(word: str, names: bool = True) -> tuple[str, str]:
    """(template token, value): the value is what fills the placeholder, empty for a literal. A word of punctuation alone is no token."""
    bare = word.strip(_EDGE)
    low = bare.lower()
    if not low:
        return "", ""
    if low in NUMBERS or _NUMBER.fullmatch(low):
        return NUMBER, low
    if low in UNITS:
        return UNIT, low
    if names and bare[0].isupper() and (len(bare) == 1 or not bare.isupper()):
        return NAME, low
    return low, ""


_PLACE = (NUMBER, NAME, UNIT)
# words of letters that aren't literal
_TYPED = frozenset(w.encode() for w in UNITS | NUMBERS)
_EDGE_BYTES = "".join(c for c in _EDGE if c.isascii()).encode()
# scripts that are written without blanks
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Reader:
    """Turns texts to template windows; remembers a bounded number of words."""

    def __init__(self, window: int, literals: int):
        self.window, self.literals = window, literals
        # a word's row in the tables; rows beyond KNOWN are lent to the text at hand
        self.known: dict[bytes, int] = {}
        self.token = np.zeros((2, KNOWN), np.uint64)
        self.literal = np.zeros((2, KNOWN), bool)
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        """Powers of the base, and of its inverse modulo 2 ** 64, up to a place."""
        if len(self.powers) < n:
            n = max(n, 2 * len(self.powers), 4096)
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            self.powers = np.concatenate([[np.uint64(1)], np.full(n - 1, _BASE, np.uint64)]).cumprod(dtype=np.uint64)
            self.inverses = np.concatenate([[np.uint64(1)], np.full(n - 1, inverse, np.uint64)]).cumprod(dtype=np.uint64)

    def _learn(self, word: bytes, lent: dict[bytes, int]) -> int:
        row = lent.get(word)
        if row is not None:
            return row
        if len(self.known) < KNOWN:
            row = self.known[word] = len(self.known)
        else:
            row = lent[word] = KNOWN + len(lent)
            if row >= self.token.shape[1]:
                self.token = np.pad(self.token, ((0, 0), (0, row)))
                self.literal = np.pad(self.literal, ((0, 0), (0, row)))
        bare = word.strip(_EDGE_BYTES)
        if bare.isalpha() and bare.islower() and bare not in _TYPED:  # ASCII letters, as most words are
            self.token[:, row] = xxhash.xxh64_intdigest(bare)
            self.literal[:, row] = True
            return row
        token, value = canonical(word.decode())
        self.token[:, row] = xxhash.xxh64_intdigest(token) if token else 0
        self.literal[:, row] = bool(token) and token not in _PLACE
        if token == NAME:  # without names it is the word itself
            self.token[1, row], self.literal[1, row] = xxhash.xxh64_intdigest(value), True
        return row

    def tokens(self, text: str | None) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The words that are tokens; their hashes and whether they are literal, one row each with and without names."""
        words = text.encode().split() if text else []
        rows = [*map(self.known.get, words)]
        if None in rows:
            lent: dict[bytes, int] = {}
            for k, row in enumerate(rows):
                if row is None:
                    row = self.known.get(words[k])
                    rows[k] = self._learn(words[k], lent) if row is None else row
        at = np.array(rows, np.int64)
        token, literal = self.token[:, at], self.literal[:, at]
        if not token[0].all():
            marks = token[0] != 0
            words = [w for w, m in zip(words, marks.tolist()) if m]
            token, literal = token[:, marks], literal[:, marks]
        return words, token, literal

    def sums(self, token: np.ndarray) -> np.ndarray:
        """Sums of the token hashes, each times its own power of the inverse base, from which windows of any length follow."""
        self._grow(len(token) + 1)
        return np.concatenate([[np.uint64(0)], np.cumsum(token * self.inverses[: len(token)], dtype=np.uint64)])

    def windows(self, sums: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
        """Hashes of all windows of one length: a polynomial of the token hashes, modulo 2 ** 64, mixed at the end with the length."""
        n = len(sums) - length
        if n < 1:
            return np.zeros(0, np.int64)
        value = (sums[length:] - sums[:n]) * self.powers[length - 1 : length - 1 + n]
        value = (value ^ (value >> np.uint64(29))) * _BASE + np.uint64(length + salt)
        return value.view(np.int64)

    def plain(self, words: list[bytes]) -> np.ndarray:
        """Hashes of the words as they are, but for case and punctuation around them, and of each character of scripts without blanks."""
        out = []
        for word in words:
            bare = word.decode().strip(_EDGE).lower()
            pieces = re.findall(f"{_UNSPACED.pattern}|[^{_UNSPACED.pattern[1:-1]}]+", bare) if _UNSPACED.search(bare) else [bare]
            out += [xxhash.xxh64_intdigest(p) for p in pieces if p.strip(_EDGE + "。、！？，．：；「」『』（）")]
        return np.array(out, np.uint64)


# tells windows of words as they are from template windows
_PLAIN = 1 << 40


def _slots(words: list[bytes], names: bool) -> list[str]:
    """The values in the placeholders of some words, each with its type."""
    out = []
    for w in words:
        token, value = canonical(w.decode(), names)
        if value:
            out.append(f"{token}{value}")
    return out


def _read(window: int, literals: int, lengths: list[int] | None, wanted: np.ndarray | None):
    """Rows of windows: of texts, all or only those whose hash is wanted; of items (no lengths given), shorter ones as one window."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(window, literals)
        # most windows are told apart by a few bits of their hash, before the wanted ones are searched
        hint = np.zeros(1 << 20, bool)
        if wanted is not None:
            hint[wanted.view(np.uint64) >> np.uint64(44)] = True

        def found(value: np.ndarray, ok: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
            """Places and hashes of the windows that are wanted."""
            if wanted is not None:
                near = hint[value.view(np.uint64) >> np.uint64(44)]
                ok = near if ok is None else near & ok
            at = np.flatnonzero(ok) if ok is not None else np.arange(len(value))
            value = value[at]
            if wanted is not None and len(at):
                place = np.minimum(np.searchsorted(wanted, value), len(wanted) - 1)
                hit = wanted[place] == value
                at, value = at[hit], value[hit]
            return at, value

        for frame in frames:
            rows = []
            for i, key, text in zip(frame["id"], frame["key"], frame["text"]):
                words, token, literal = reader.tokens(text)
                sizes = [n for n in lengths if n > 0] if lengths is not None else [min(window, len(words))] if words else []
                alike = (token[0] == token[1]).all()
                sums = [reader.sums(token[0])] if sizes else []
                if sizes and not alike:
                    sums.append(reader.sums(token[1]))
                counts = [np.concatenate([[0], np.cumsum(x)]) for x in literal[: len(sums)]]
                searched = False
                for size in sizes:
                    named = None
                    for form, (part, so_far) in enumerate(zip(sums, counts)):
                        value = reader.windows(part, size)
                        ok = so_far[size:] - so_far[: len(value)] >= literals
                        searched |= bool(ok.any())
                        # a window without names is the same in both forms
                        if form:
                            ok &= value != named
                        named = value
                        for p, v in zip(*(x.tolist() for x in found(value, ok))):
                            rows.append((i, key, p, size, v, _slots(words[p : p + size], not form)))
                if lengths is None and not searched and words:
                    plain = reader.plain(words)
                    if len(plain) >= EXACT:
                        rows.append((i, key, 0, -len(plain), int(reader.windows(reader.sums(plain), len(plain), _PLAIN)[0]), []))
                elif lengths is not None and min(lengths, default=1) < 0:
                    whole = reader.sums(reader.plain(words))
                    for size in [n for n in lengths if n < 0]:
                        for p, v in zip(*(x.tolist() for x in found(reader.windows(whole, -size, _PLAIN), None))):
                            rows.append((i, key, p, size, v, []))
            yield pd.DataFrame(rows, columns="id key at size hash slots".split())

    return run


_ROWS = "id long, key long, at int, size int, hash long, slots array<string>"


def _texts(df: DataFrame, row_id: str, text: str) -> DataFrame:
    return df.select(
        boxed(F.col(f"`{row_id}`")).alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("key"), F.col(f"`{text}`").alias("text")
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    literals: int = LITERALS,
    coverage: float = COVERAGE,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """One row per document and item it holds: doc_id, key (hash of the document's text), item_id, windows found, item windows,
    slot values, slot values changed.
    """
    items = _texts(benchmark, item_id, item_text).dropDuplicates(["id", "key"])
    ours = cut(items.mapInPandas(_read(window, literals, None, None), _ROWS))
    lengths = sorted(r["size"] for r in ours.select("size").distinct().collect())
    hashes = ours.select("hash").distinct()
    small = hashes.limit(broadcast_windows + 1).count() <= broadcast_windows
    wanted = np.sort(np.array([r["hash"] for r in hashes.collect()], np.int64)) if small else None
    own = _texts(docs, doc_id, text)
    if small and not len(wanted):
        own = own.where(F.lit(False))
    found = own.mapInPandas(_read(window, literals, lengths, wanted), _ROWS)
    sizes = ours.groupBy(F.col("id").alias("item"), F.col("key").alias("item_key")).agg(F.countDistinct("at").alias("item_windows"))
    theirs = ours.select(F.col("id").alias("item"), F.col("key").alias("item_key"), F.col("at").alias("item_at"), "hash", F.col("slots").alias("item_slots"))
    theirs = F.broadcast(theirs) if small else theirs
    met = found.join(theirs, "hash").where(F.size("slots") == F.size("item_slots"))
    pair = F.transform(F.arrays_zip("item_slots", "slots"), lambda x: F.struct(x["item_slots"].alias("was"), x["slots"].alias("now")))
    # one diagonal meets each window of an item once, so that an item's length bounds what is gathered
    diagonal = (
        met.groupBy("id", "key", "item", "item_key", (F.col("at") - F.col("item_at")).alias("diagonal"))
        .agg(F.collect_set("item_at").alias("starts"), F.array_distinct(F.flatten(F.collect_set(pair))).alias("pairs"))
        .where(F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda x: x["was"]))))
    )
    # diagonals of one item are joined window by window, whatever number of copies a document holds
    changed = F.size(F.filter("pairs", lambda x: x["was"] != x["now"]))
    held = (
        diagonal.select("id", "key", "item", "item_key", F.size("pairs").alias("n_slots"), changed.alias("n_changed"), F.explode("starts").alias("start"))
        .groupBy("id", "key", "item", "item_key", "start")
        .agg(F.max("n_slots").alias("n_slots"), F.min("n_changed").alias("n_changed"))
        .groupBy("id", "key", "item", "item_key")
        .agg(F.count("*").alias("n_windows"), F.max("n_slots").alias("n_slots"), F.max("n_changed").alias("n_changed"))
    )
    sizes = F.broadcast(sizes) if small else sizes
    return (
        held.join(sizes, ["item", "item_key"])
        .where(F.col("n_windows") >= F.col("item_windows") * coverage)
        .select(unboxed(F.col("id")).alias("doc_id"), "key", unboxed(F.col("item")).alias("item_id"), "n_windows", "item_windows", "n_slots", "n_changed")
        .distinct()
    )


def filter_documents(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The documents that hold no item, unchanged."""
    bad = contaminated(docs, benchmark, doc_id, text, **settings).select(F.col("doc_id").alias("id"), "key").distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    own = whole.select("row", F.col(f"row.`{doc_id}`").cast("long").alias("id"), F.xxhash64(F.col(f"row.`{text}`")).alias("key"))
    same = F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.key") == F.col("r.key"))
    return own.alias("l").join(bad.alias("r"), same, "left_anti").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(scan(spark, sf_dir, "documents"), scan(spark, sf_dir, "benchmark"))
    return found.drop("key").distinct()


QUERIES = {"op1_decontamination": query}
