"""Latest-version selection over an append-only version history.

The history holds every inserted version of every event. Readers see, per
dedup key, the row with the highest ``version``; equal versions are broken by
insertion order ``(batch_id, seq)``, so the last inserted row wins. A live
snapshot additionally hides tombstones, and the tombstone filter runs after
the dedup, never before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.schema import EVENT_COLS, LINEAGE_COLS

DEFAULT_KEYS = ("id",)
# The literal dedup key of the reference table: its sort key. With it, an
# event whose name changes keeps one visible row per name (see README).
SORT_KEY = ("conversation_id", "event_name", "id")


def _winner_order(df: DataFrame) -> list[Column]:
    order = [F.col("version").desc()]
    order += [F.col(c).desc_nulls_last() for c in LINEAGE_COLS if c in df.columns]
    return order


def latest_version(
    history: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    include_deleted: bool = True,
) -> DataFrame:
    """One row per key: the highest version, last inserted on ties.

    Planned as ``row_number() = 1`` so Catalyst inserts a partial
    ``WindowGroupLimit`` before the shuffle: every map task keeps only its
    best row per key, so a key with many versions is cut down map-side and
    the shuffle carries at most one row per key and map task. Filters on key
    columns placed after this call are pushed below the window to the scan.
    """
    w = Window.partitionBy(*keys).orderBy(*_winner_order(history))
    out = history.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")
    if not include_deleted:
        out = out.where(F.col("is_deleted") == 0)
    return out


def place_in(window: WindowSpec) -> Column:
    """A row's place in an ordered window, as a running count.

    Of ``row_number() = 1`` Spark makes a second sort of full rows, before the
    shuffle, to drop what cannot win. Where few rows share a key it drops
    almost nothing, and costs a task as much memory again.
    """
    return F.count(F.lit(1)).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def live_snapshot(history: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """Latest version per key with tombstones hidden."""
    return latest_version(history, keys, include_deleted=False)


def latest_max_by(history: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """Same result as :func:`latest_version` written as ``max_by`` per key.

    The aggregate form combines map-side like any aggregate, but its struct
    buffer is not hash-aggregatable, so Spark plans a sort aggregate; the
    window form is the default.
    """
    order_cols = ["version"] + [c for c in LINEAGE_COLS if c in history.columns]
    value_cols = [c for c in history.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in order_cols])
    picked = history.groupBy(*keys).agg(F.max_by(F.struct(*value_cols), order).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in value_cols]).select(history.columns)


def restricted_latest(
    history: DataFrame,
    predicate: Column,
    keys: Sequence[str] = DEFAULT_KEYS,
    include_deleted: bool = False,
) -> DataFrame:
    """Latest versions whose winning row satisfies ``predicate``.

    Exact for any predicate: a key whose winner satisfies it has at least one
    version that does, so the candidate keys are found with a pushed-down
    filter, every version of those keys is kept with a semi join, and the
    predicate is re-applied to the winners. AQE turns the semi join into a
    broadcast when the candidate set measures small at runtime; otherwise it
    is a shuffle join that already co-partitions the rows for the dedup.
    """
    candidates = history.where(predicate).select(*keys).distinct()
    scoped = history.join(candidates, list(keys), "left_semi")
    return latest_version(scoped, keys, include_deleted).where(predicate)


def restricted_rows(history: DataFrame, predicate: Column, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """The full live rows that :func:`restricted_latest` finds, reading wide columns only where ``predicate`` holds.

    The winners are found on the key and order columns. A winner satisfies
    the predicate, so the scan of the full rows has it pushed down and skips
    every other file and row group.
    """
    narrow = [*keys, "version", "is_deleted", *[c for c in LINEAGE_COLS if c in history.columns]]
    candidates = history.where(predicate).select(*keys).distinct()
    winners = latest_version(history.select(*narrow).join(candidates, list(keys), "left_semi"), keys, include_deleted=False)
    winners = winners.select([F.col(c).alias(f"_w_{c}") for c in narrow])
    same = [F.col(c).eqNullSafe(F.col(f"_w_{c}")) if c in LINEAGE_COLS else F.col(c) == F.col(f"_w_{c}") for c in narrow]
    rows = history.where(predicate).join(winners, same, "left_semi")
    return latest_version(rows, keys, include_deleted=False)  # copies of a row, if a writer left any


def public_view(df: DataFrame) -> DataFrame:
    """The public event columns: hides ``is_deleted`` and ``version``."""
    return df.select(*[c for c in EVENT_COLS if c not in ("is_deleted", "version")])
