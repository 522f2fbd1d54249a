"""Scalar column functions. Bad input raises whether or not the session is in ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def required(value: Column, message: Column | str) -> Column:
    """``value``, or an error where it is NULL."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.coalesce(value, F.raise_error(text))


def class_number(label: Column) -> Column:
    """``Class_7`` -> 7: the integer after the first underscore."""
    number = F.get(F.split(label, "_"), F.lit(1)).try_cast("bigint")
    return required(number, F.concat(F.lit("not a class label: "), F.coalesce(label, F.lit("NULL"))))


def class_index(label: Column) -> Column:
    """``Class_7`` -> 6: zero-based, as estimators want it. Same parse as ``class_number``."""
    return class_number(label) - 1


def class_last_digit_index(label: Column) -> Column:
    """Zero-based class from the last character; agrees with ``class_index`` for single-digit classes."""
    return required(F.substring(label, -1, 1).try_cast("bigint"), "label does not end in a digit") - 1


def fold_number(key: Column, n_folds: int = 5) -> Column:
    """``key mod n``; the sign follows the key."""
    return (key % F.lit(n_folds)).cast("bigint")


def is_eval(key: Column, fold: int, n_folds: int = 5) -> Column:
    return F.coalesce(fold_number(key, n_folds) == F.lit(fold), F.lit(False))


def log_count(value: Column) -> Column:
    """ln(x + 1); raises for x <= -1, where the logarithm does not exist."""
    return F.when(value <= -1, F.raise_error(F.lit("log feature needs a value above -1"))).otherwise(F.log1p(value))


def element(array: Column, position: int) -> Column:
    """Zero-based element; raises when the array is shorter."""
    got = F.get(array, F.lit(position))
    short = F.size(array) <= position
    return F.when(short, F.raise_error(F.lit(f"array has no position {position}"))).otherwise(got)


def lookup(pairs: Column, key_field: str, key, value_field: str) -> Column:
    """The value stored under ``key`` in an array of structs, NULL if there is none."""
    return F.get(F.filter(pairs, lambda p: p[key_field] == F.lit(key)), F.lit(0))[value_field]


def array_mean(arrays: list[Column], length: int) -> Column:
    """Position-wise mean of equally long arrays."""
    return F.array(*[sum((a[i] for a in arrays[1:]), arrays[0][i]) / F.lit(float(len(arrays))) for i in range(length)])


def doubles(columns) -> Column:
    """The named columns as one array of doubles."""
    return F.array(*[F.col(c).cast("double") for c in columns])


def all_but(df: DataFrame, *columns: str) -> list[str]:
    """Column names without the given ones: features by exclusion."""
    return [c for c in df.columns if c not in columns]
