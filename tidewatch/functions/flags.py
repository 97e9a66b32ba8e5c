"""Combining rule flags into one decision and one label."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fill_flags(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """NULL flags become false, so that ``flag`` and ``~flag`` partition the rows."""
    return df.na.fill(False, subset=list(columns))


def any_flag(columns: Iterable[str]) -> Column:
    return reduce(or_, [F.coalesce(F.col(c), F.lit(False)) for c in columns])


def reason_label(flags: Mapping[str, str]) -> Column:
    """Names of the raised flags joined by ``+``, in the given order; NULL if none."""
    names = [F.when(F.col(column), F.lit(name)) for name, column in flags.items()]
    return F.nullif(F.concat_ws("+", *names), F.lit(""))
