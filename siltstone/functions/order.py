"""Total orders, ranks among sampled cut points, interleaved bits."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.session import saved


def last_resort(df: DataFrame, known: Sequence[str]) -> list[Column]:
    """What orders rows that are equal in ``known``: their other columns by name, so that the order depends on
    the rows alone, never on how they arrived.  Rows equal in all of them can't be told apart."""

    def ordered(field: T.StructField) -> Column:
        plain = not re.search("map|variant", field.dataType.simpleString())
        return F.col(field.name) if plain else F.to_json(F.struct(field.name))

    return [ordered(f) for f in sorted(df.schema.fields, key=lambda f: f.name) if f.name not in known]


def row_digest(df: DataFrame, names: Sequence[str]) -> Column:
    """A fingerprint of the named columns.  NULLs leave no trace, so a column added later changes no digest."""

    def text(field: T.StructField) -> Column:
        col = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.unix_micros(col).cast("string")
        if isinstance(field.dataType, T.BinaryType):
            return F.hex(col)
        nested = isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
        return F.to_json(F.struct(field.name)) if nested else col.cast("string")

    fields = sorted((f for f in df.schema.fields if f.name in names), key=lambda f: f.name)
    parts = [F.concat(F.lit(f"{f.name}:"), F.length(text(f)).cast("string"), F.lit(":"), text(f)) for f in fields]
    return F.md5(F.concat_ws("|", *parts))


# Rows sampled for each range that values are cut into.
SAMPLED = 32


def with_ranks(df: DataFrame, names: Mapping[str, str], pieces: int, rows: int) -> DataFrame:
    """``df`` with an integer column ``names[c]`` for each ordered column ``c``: in which of ``pieces`` ranges of
    about equal share its value lies, from 0; NULL lies in the first.

    The cut points are whole values of the column's own type, whatever it is, from a sample of about SAMPLED
    of the ``rows`` for each range.  They are found with a binary search, one comparison per step, inside the generated
    code.  The sample decides only how even the ranges are.
    """
    if pieces < 2:
        return df.withColumns({rank: F.lit(0) for rank in names.values()})
    wanted = SAMPLED * pieces
    sample = df if rows <= wanted else df.sample(wanted / rows, 7)
    depth = (pieces - 1).bit_length()
    listed = sample.agg(*[F.sort_array(F.collect_list(c)).alias(c) for c in names])

    def cuts(c: str) -> Column:
        places = F.sequence(F.lit(1), F.lit(pieces - 1))
        return F.transform(places, lambda i: F.get(c, F.floor(i * F.size(c) / F.lit(pieces)).cast("int")))

    found = saved(listed.select(*[cuts(c).alias(c) for c in names]))
    points = {c: found.select(c).scalar() for c in names}
    out = df.withColumns({rank: F.lit(0) for rank in names.values()})
    for step in (1 << k for k in reversed(range(depth))):
        # Beyond the last cut point there is NULL, which no value reaches.
        reached = {c: F.get(points[c], F.col(rank) + (step - 1)) <= F.col(c) for c, rank in names.items()}
        out = out.withColumns({rank: F.when(reached[c], F.col(rank) + step).otherwise(F.col(rank)) for c, rank in names.items()})
    return out


def interleave(columns: Sequence[Column], bits: int) -> Column:
    """Morton code of integer columns of ``bits`` bits each."""
    if bits * len(columns) > 62:
        raise ValueError("the interleaved code must fit 62 bits")
    code = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, col in enumerate(columns):
            one = F.shiftright(col.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            code = code.bitwiseOR(F.shiftleft(one, bit * len(columns) + i))
    return code


def hash60(columns: Sequence[str], seed: int = 0) -> Column:
    """A uniform value in [0, 2**60) from ``columns``, the same on every engine that has MD5."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *text))
    # Never NULL; saying so keeps Spark from adding a filter that computes the hash twice.
    return F.coalesce(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), F.lit(0).cast("bigint"))
