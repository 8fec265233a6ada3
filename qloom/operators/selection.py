"""Exact selection by rank without bringing a group into one task.

``ORDER BY ... LIMIT n`` collects n rows in one task, and a ranking window sorts a whole group in
one. Both fail once n or a group grows with the data. Here a sort key is read as a few digits of about
twenty bits. Rows are counted by their first digit, the running totals of the counts tell which digit the
wanted rank has, and the rows with that digit are counted by the next one, until the whole key is known.
Counts are combined before they move, and a window never holds more rows than a digit has values,
whatever the size of a group. Nothing runs before the result is asked for.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from qloom.operators.joins import join_null_safe

# Up to this many rows asked for, a plain top-n is one small merge; the result is the same either way.
SMALL = 10_000
ACCURACY = 10_000
_SIGN = -(2**63)

Ranks = Mapping[str, Callable[[Column], Column]]


def _bits(col: Column) -> Column:
    """The bits of a double as a number that orders like it; minus zero counts as zero."""
    raw = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), col + F.lit(0.0)).cast("long")
    return F.when(raw < 0, raw.bitwiseXOR(F.lit(2**63 - 1))).otherwise(raw)


def _from_bits(code: Column) -> Column:
    raw = F.when(code < 0, code.bitwiseXOR(F.lit(2**63 - 1))).otherwise(code)
    return F.java_method(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), raw).cast("double")


def _coding(kind: T.DataType) -> tuple[Callable[[Column], Column], Callable[[Column], Column]]:
    """How values of a type become 64-bit numbers of the same order, and back."""
    if isinstance(kind, T.IntegralType):
        return lambda c: c.cast("long"), lambda n: n.cast(kind)
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return lambda c: _bits(c.cast("double")), lambda n: _from_bits(n).cast(kind)
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        unit = F.lit(10**kind.scale).cast("decimal(19,0)")
        return lambda c: (c * unit).cast("long"), lambda n: (n.cast("decimal(19,0)") / unit).cast(kind)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros, F.timestamp_micros
    if isinstance(kind, T.DateType):
        return F.unix_date, F.date_from_unix_date
    raise TypeError(f"values of type {kind.simpleString()} can't be ranked")


def _digits(code: Column) -> list[Column]:
    """A signed 64-bit number as three digits that order like it; null comes last."""
    u = code.bitwiseXOR(F.lit(_SIGN))
    high = F.coalesce(F.shiftrightunsigned(u, 42), F.lit(1 << 22))
    return [high, *[F.coalesce(F.shiftrightunsigned(u, s).bitwiseAND(F.lit((1 << 21) - 1)), F.lit(0)) for s in (21, 0)]]


def _number(digits: Sequence[Column]) -> Column:
    high, mid, low = digits
    return F.shiftleft(high, 42).bitwiseOR(F.shiftleft(mid, 21)).bitwiseOR(low).bitwiseXOR(F.lit(_SIGN))


def _pick(rows: DataFrame, by: Sequence[str], digits: Sequence[str], ranks: Ranks) -> DataFrame:
    """Per group and named rank (from 0), the digits of the row at the rank and ``_left``, its place among rows of equal digits.

    A rank outside a group gives no row.
    """
    wanted = F.array(
        *[F.struct(F.lit(n).alias("name"), rank(F.col("_total")).cast("long").alias("at")) for n, rank in ranks.items()]
    )
    found, known = None, []
    for digit in digits:
        if found is None:
            group = list(by)
            counts = rows.groupBy(*group, digit).agg(F.count(F.lit(1)).alias("_size"))
            counts = counts.withColumn("_total", F.sum("_size").over(Window.partitionBy(*group)))
        else:
            group = [*by, "rank_name", "_left", *known]
            counts = join_null_safe(rows, found, [*by, *known]).groupBy(*group, digit).agg(F.count(F.lit(1)).alias("_size"))
        before = Window.partitionBy(*group).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        if found is None:
            counts = counts.withColumn("_rank", F.explode(wanted))
            counts = counts.withColumn("rank_name", F.col("_rank.name")).withColumn("_left", F.col("_rank.at"))
        at = F.col("_left")
        inside = counts.where((at >= F.col("_start")) & (at < F.col("_start") + F.col("_size")))
        known = [*known, digit]
        found = inside.select(*by, "rank_name", (at - F.col("_start")).alias("_left"), *known)
    return found


def rank_percentiles(
    df: DataFrame, by: Sequence[str], value: str, shares: Mapping[str, float], approximate: bool = False
) -> DataFrame:
    """Per group, the value at position floor(n * share) of its sorted values, a column per share.

    The rule is positional: the middle of four values is the third one. ``approximate`` gives
    ``percentile_approx`` instead, one pass with a sketch of fixed size.
    """
    if approximate:
        return df.groupBy(*by).agg(*[F.percentile_approx(value, F.lit(s)).alias(n) for n, s in shares.items()])
    ranks = {name: (lambda n, s=share: F.floor(n * F.lit(s))) for name, share in shares.items()}
    code, back = _coding(df.schema[value].dataType)
    # the exchange is the same for every digit, so that what lies below it runs once
    rows = df.select(*by, value).hint("rebalance").where(F.col(value).isNotNull())
    names = ["_d0", "_d1", "_d2"]
    rows = rows.select(*by, code(F.col(value)).alias("_code"))
    rows = rows.select(*by, *[d.alias(n) for d, n in zip(_digits(F.col("_code")), names)])
    found = _pick(rows, by, names, ranks)
    found = found.select(*by, "rank_name", back(_number([F.col(n) for n in names])).alias("_value"))
    # the value comes back from its digits once, before it is looked at
    return found.groupBy(*by).agg(*[F.max(F.when(F.col("rank_name") == n, F.col("_value"))).alias(n) for n in shares])


def _whole_row(df: DataFrame) -> Column:
    """A hash of all columns, to order rows of equal keys."""
    return F.xxhash64(*[F.to_json(F.struct(c)) if isinstance(df.schema[c].dataType, T.MapType) else F.col(f"`{c}`") for c in df.columns])


def _first(df: DataFrame, code: Column, whole: Column, n: int) -> DataFrame:
    """Exactly ``n`` rows by a 64-bit code (nulls last), rows of equal codes by ``whole``, a hash of the row."""
    names = [f"_d{i}" for i in range(6)]
    digits = [*_digits(code), *_digits(whole)]
    rows = df.select(*df.columns, *[d.alias(x) for d, x in zip(digits, names)])
    bound = _pick(rows.select(*names), [], names, {"last": lambda total: F.lit(n - 1)})
    last = bound.select(F.struct(*names)).scalar()
    left = bound.select("_left").scalar()
    before = rows.where(F.coalesce(F.struct(*names) < last, F.lit(True))).drop(*names)
    # rows at the bound are alike in all columns: one of them stands for as many as are still wanted
    alike = rows.where(F.struct(*names) == last).dropDuplicates(names)
    return before.unionByName(
        alike.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), left))).drop("_copy", *names)
    )


def first_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """Exactly the first ``n`` rows by an integer key, nulls last, rows of equal keys by a hash of the row."""
    if n <= 0:
        return df.limit(0)
    if n <= SMALL:
        return df.orderBy(F.col(key).asc_nulls_last(), _whole_row(df)).limit(n)
    return _first(df, F.col(key).cast("long"), _whole_row(df), n)


def with_seeded_hash(df: DataFrame, id_col: str, seed: int) -> DataFrame:
    """Add ``_hash``, a pseudo-random order of 60 bits that depends on seed and id only, not on partitions."""
    text = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return df.withColumn("_hash", F.conv(F.substring(text, 1, 15), 16, 10).cast("long"))


def sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows of the seeded order, null ids last, rows of one id by a hash of the row."""
    if n <= 0:
        return df.limit(0)
    order = with_seeded_hash(df, id_col, seed)
    if n <= SMALL:
        return order.orderBy(F.col("_hash").asc_nulls_last(), _whole_row(df)).limit(n).drop("_hash")
    return _first(order, F.col("_hash"), _whole_row(df), n).drop("_hash")


def split(df: DataFrame, id_col: str, train_fraction: float = 0.95, seed: int = 42) -> DataFrame:
    """Add ``split``: the first ceil(n * (1 - fraction)) rows of the seeded order are 'test'.

    Rows that share an id stay together.
    """
    held_out = 1 - train_fraction
    if held_out <= 0:
        return df.withColumn("split", F.lit("train"))
    names = ["_d0", "_d1", "_d2"]
    hashed = with_seeded_hash(df, id_col, seed)
    rows = hashed.select(*df.columns, *[d.alias(x) for d, x in zip(_digits(F.col("_hash")), names)])
    bound = _pick(rows.select(*names), [], names, {"last": lambda total: F.ceil(total * F.lit(held_out)) - 1})
    is_test = F.coalesce(F.struct(*names) <= bound.select(F.struct(*names)).scalar(), F.lit(True))
    return rows.withColumn("split", F.when(is_test, "test").otherwise("train")).drop(*names)


def held_out_sample(df: DataFrame, id_col: str, n: int, train_fraction: float = 0.95, seed: int = 42) -> DataFrame:
    """``n`` rows of the test part of the split with the same seed, so that no training row is evaluated.

    The test part is the head of the seeded order, and so is the sample.
    """
    test = split(df, id_col, train_fraction, seed).where(F.col("split") == "test").drop("split")
    return sample(test, id_col, n, seed)
