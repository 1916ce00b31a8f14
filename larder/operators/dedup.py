"""Distinct keys and newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def keep_latest(
    df: DataFrame,
    keys: Sequence[str | Column],
    newest: Column | None,
    tie_breakers: Sequence[str] = (),
    hashed: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the newest, rows without a time last; without ``newest`` only what follows decides.

    NULL keys form one group. Equal times are settled by the tie breakers (descending), then by a
    hash of the whole row, so the answer does not depend on the order of the input. ``hashed`` names the columns of
    that hash if others were derived from them.

    ``row_number() = 1`` lets Spark place a group limit before the exchange: every map task sends
    at most one row per key, so a hot key costs one row per task and never a task of its own.
    """
    order = [] if newest is None else [newest.desc_nulls_last()]
    order += [F.col(f"`{name}`").desc_nulls_last() for name in tie_breakers]
    order.append(F.xxhash64(*[F.col(f"`{name}`") for name in hashed or df.columns]).desc())
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One arbitrary row per key, for input without a time column."""
    return df.dropDuplicates(list(keys))


def distinct_keys(df: DataFrame, *keys: Column) -> DataFrame:
    """Distinct key values: a hash aggregate with a partial step, no sort and no window."""
    return df.select(*keys).distinct()


def upsert_latest(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    newest: Column,
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """Target after taking in new versions: the newest row per key over both."""
    return keep_latest(
        target.unionByName(incoming, allowMissingColumns=True), keys, newest, tie_breakers
    )
