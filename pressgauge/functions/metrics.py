"""Trend, growth and score functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class code to label.
CLASS_LABELS = {1: "neg", 2: "neu", 3: "pos", 4: "neu_pos"}


def trend(now: Column, before: Column) -> Column:
    """1 up, -1 down, 0 equal."""
    return F.signum(now - before).cast("int")


def increase_rate(now: Column, before: Column) -> Column:
    """Relative change; 1.0 whenever the earlier value is zero."""
    return F.when(before == 0, F.lit(1.0)).otherwise(
        (now - before).cast("double") / F.nullif(before.cast("double"), F.lit(0.0))
    )


def floor4(p: Column) -> Column:
    """Floor to four decimals, exact on the decimal form of the value."""
    return F.floor(p.cast("decimal(20,18)"), F.lit(4)).cast("double")


def two_class_scores(p0: Column, p1: Column) -> Column:
    """The larger probability floored to four places, the other its complement, as fixed text."""
    a, b = floor4(p0), floor4(p1)
    first = F.when(a >= b, a).otherwise(1 - b)
    second = F.when(a >= b, 1 - a).otherwise(b)
    return F.struct(
        F.format_string("%.4f", first).alias("neg"), F.format_string("%.4f", second).alias("neu_pos")
    )


def class_label(code: Column) -> Column:
    """Label of a class code; an unknown code is an error, not a null."""
    out = None
    for value, label in CLASS_LABELS.items():
        out = F.when(code == value, label) if out is None else out.when(code == value, label)
    return F.when(code.isNull(), F.lit(None).cast("string")).otherwise(
        out.otherwise(F.raise_error(F.concat(F.lit("unknown class code "), code.cast("string"))))
    )
