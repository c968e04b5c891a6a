"""Column expressions used by the jobs.  All built-in, JVM-side functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Timestamp text layout of the POS file and the run-stamp layout
# of export names.
POS_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
RUN_STAMP_FORMAT = "yyyyMMdd_HHmm"
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_pos_ts(c, strict: bool = True) -> Column:
    """Text ``yyyy-MM-dd HH:mm:ss`` to a zone-less timestamp (local store time).

    Strict (default) fails the job on bad text, as the source statement did;
    lenient returns NULL so the caller can route the line to a reject table.
    """
    strict_parse = F.to_timestamp_ntz(_c(c), F.lit(POS_TS_FORMAT))
    if strict:
        return strict_parse
    # try_to_timestamp only tells whether the text parses; the value itself comes
    # from the zone-less parser, so wall-clock times in a DST gap stay as written
    return F.when(F.try_to_timestamp(_c(c), F.lit(POS_TS_FORMAT)).isNotNull(), strict_parse)


def bad_pos_ts(c) -> Column:
    """Whether a time stamp is given but is no ``yyyy-MM-dd HH:mm:ss`` (never NULL; an absent stamp is not bad)."""
    return _c(c).isNotNull() & parse_pos_ts(c, strict=False).isNull()


def run_stamp(c) -> Column:
    """Run time as ``yyyyMMdd_HHmm``, the prefix of export names."""
    return F.date_format(_c(c), RUN_STAMP_FORMAT)


def tran_kind(c) -> Column:
    """Transaction kind: text before the first ``#`` (whole text when absent)."""
    return F.split_part(_c(c), F.lit("#"), F.lit(1))


def country_prefix(c) -> Column:
    """Three-letter country code to two letters by truncation."""
    return F.substring(_c(c), 1, 2)


def amount_real(c) -> Column:
    """Amount text as a 32-bit float, the type of the transaction amount.

    Never compare against a double: 12.1 as float is not 12.1 as double.
    """
    return _c(c).cast("float")


def real_key(c) -> Column:
    """A 32-bit float as a text that is equal where the floats are.  Spark wraps floats in grouping and in join keys, so a join on a float
    cannot use the partitioning of a group by it; on the text it can."""
    return F.when(_c(c) == 0, "0.0").otherwise(_c(c).cast("string"))


# Marks of packed texts: between fields, of an absent field, of several absent ones after each other, and before the digit that
# stands for a mark inside a field.
_BETWEEN, _ABSENT, _ESCAPE = "\u001f", "\u001a", "\u001b"
_RUNS = [("\u001c", 8), ("\u001d", 3), ("\u001e", 1)]
_MARKS = (_BETWEEN, _ABSENT, *(mark for mark, _ in _RUNS), _ESCAPE)
_RUN_CODES = [((_BETWEEN + _ABSENT) * n, mark) for mark, n in _RUNS]


def _replaced(c: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def pack(cols: list[str]) -> Column:
    """Text columns as one text, equal where all of them are (NULL equal to NULL): a row of many columns, most of them absent, is
    shuffled, grouped and sorted in a third of its size.  ``unpack`` gives the columns back."""
    codes = [(mark, _ESCAPE + str(i)) for i, mark in enumerate(reversed(_MARKS))]  # the escape first
    fields = F.array(*cols)
    text = F.array_join(fields, "")
    escaped = F.transform(fields, lambda x: _replaced(x, codes))
    odd = reduce(lambda a, b: a | b, [text.contains(mark) for mark in _MARKS])
    return _replaced(F.array_join(F.when(odd, escaped).otherwise(fields), _BETWEEN, _ABSENT), _RUN_CODES)


def unpack(packed: DataFrame, text: str, cols: list[str], *keep: str | Column) -> DataFrame:
    """The columns that ``pack`` made into ``text``, then those to ``keep``."""
    codes = [(_ESCAPE + str(i), mark) for i, mark in enumerate(reversed(_MARKS))]
    split = F.split(_replaced(F.col(text), [(mark, run) for run, mark in _RUN_CODES]), _BETWEEN, -1)
    present = F.transform(split, lambda x: F.when(x != _ABSENT, x))
    plain = F.transform(split, lambda x: F.when(x != _ABSENT, _replaced(x, codes[::-1])))
    fields = packed.select(F.when(F.col(text).contains(_ESCAPE), plain).otherwise(present).alias("_fields"), *keep)
    return fields.select(*[F.col("_fields")[i].alias(c) for i, c in enumerate(cols)], *[k for k in fields.columns if k != "_fields"])


def row_json(cols: list[str]) -> Column:
    """One JSON object per row, NULL fields kept, timestamps ISO-8601 with ``T``."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]),
                     {"ignoreNullFields": "false",
                      "timestampNTZFormat": JSON_TS_FORMAT,
                      "timestampFormat": JSON_TS_FORMAT})
