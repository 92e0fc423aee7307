"""Group-exclusive train / validation / test assignment."""

from __future__ import annotations

from math import ceil, isclose

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alula.operators.ordering import numbered

NAMES = ("train", "val", "test")


class SplitError(ValueError):
    """The requested split is impossible."""


def _ranked_groups(df: DataFrame, group: str, seed: int) -> DataFrame:
    """Groups in a seeded, order-independent random order."""
    groups = df.select(group).filter(F.col(group).isNotNull()).distinct()
    return numbered(groups, [], [F.xxhash64(F.lit(seed), F.col(group)), group], "__rank")


def _assigned(df: DataFrame, ranked: DataFrame, group: str, n_train: int, n_val: int) -> DataFrame:
    name: Column = (
        F.when(F.col("__rank") <= n_train, NAMES[0]).when(F.col("__rank") <= n_train + n_val, NAMES[1]).otherwise(NAMES[2])
    )
    return df.join(ranked.select(group, name.alias("split")), group)


def split_groups(df: DataFrame, group: str, train: float, val: float, test: float, seed: int) -> DataFrame:
    """Adds ``split``; rounded sizes, every split keeps at least one group."""
    if not isclose(train + val + test, 1.0, rel_tol=1e-5, abs_tol=1e-8):
        raise SplitError("train + val + test must equal 1")
    n = df.select(F.countDistinct(group)).first()[0]
    if n < len(NAMES):
        raise SplitError("at least 3 groups are needed")
    n_train = min(max(round(n * train), 1), n - 2)
    n_val = min(max(round(n * val), 1), n - n_train - 1)
    return _assigned(df, _ranked_groups(df, group, seed), group, n_train, n_val)


def split_fractions(df: DataFrame, group: str, val: float = 0.1, test: float = 0.1, seed: int = 58) -> DataFrame:
    """Second sizing rule: held-out shares are rounded up. Use a row id as ``group`` for a row split."""
    n = df.select(F.countDistinct(group)).first()[0]
    rest = ceil((val + test) * n)
    n_test = ceil(test / (val + test) * rest)
    return _assigned(df, _ranked_groups(df, group, seed), group, n - rest, rest - n_test)


def split_statistics(df: DataFrame, group: str) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("annotations"), F.countDistinct(group).alias("specimens"))
