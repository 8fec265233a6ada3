"""Frames with the odd rows that every operator must bear."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

LONG = "Lorem dolor sit amet consectetur. " * 4000

# id, text; the last column names clash with names that operators use inside
ODD = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta. Iota kappa lambda mu nu xi omicron pi rho sigma tau."),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b\x0c\r "),
    (5, "One"),
    (5, "One"),
    (5, "Another text under the same id"),
    (None, "Text without an id."),
    (None, None),
    (6, LONG),
    (7, LONG),
    ((1 << 60) + 1, "ends\x1cwith \x85 odd spaces   and 漢字 🙂"),
    (8, "\n\n\n"),
    (-9, "below zero"),
]


def documents(spark, rows, clashing=False):
    fields = [StructField("doc_id", LongType()), StructField("text", StringType())]
    extra = ["lang", "source"] + (["id", "key", "row", "f", "votes", "label", "fp", "gone", "new", "part", "place", "start", "component_id"] if clashing else [])
    fields += [StructField(c, StringType()) for c in extra] + [StructField("n_chars", LongType())]
    made = [(i, t, *[None if k % 2 else c for k, c in enumerate(extra)], None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(made, StructType(fields))


def odd(spark, clashing=True):
    return documents(spark, ODD, clashing)


def nothing(spark):
    return documents(spark, [])
