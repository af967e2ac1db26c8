"""Apply create / partial-update / soft-delete operations as version rows.

The reference applies each message with a read-modify-write round trip. Here
a whole batch of operations is folded at once with running windows that all
follow one order of ``(id, seq)``, so the plan has one shuffle and one sort of
full rows (equal ``seq`` are ordered by time, then operation, then content):

1. an operation before the first create of its event has nothing to act on;
2. updates and deletes after the first delete act on a deleted event;
   both are rejected as ``not_found``;
3. a create after the first mutation (or over a stored event already past
   version 1) is inserted as version 1 below the current version, so it is
   never visible and does not feed later updates ("shadowed");
4. each surviving update/delete bumps the version by one;
5. every field takes the last provided value in log order (creates provide
   every field), which is what reading the current row and overlaying the
   patch does message by message.

Incremental form: the stored latest version of each touched event enters the
fold as a ``base`` row at ``seq = -1``; it counts as the first create and
carries its stored values, version, tombstone flag and ``created_at``. Base
rows are never emitted again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.versioning import latest_version
from tidemark.schema import (
    EVENT_COLS,
    MONTH_COL,
    OP_BASE,
    OP_CREATE,
    OP_DELETE,
    OP_UPDATE,
    PATCH_FIELDS,
    R_NOT_FOUND,
    SHADOW_COL,
)


def base_from_history(history: DataFrame, touched_ids: DataFrame) -> DataFrame:
    """Latest stored version (tombstones kept) of each touched id, as base operations.

    Two passes keep wide columns out of the search: the winners are picked
    on the narrow ``(id, version, batch_id, seq)`` columns of the touched
    ids only, then their full rows are fetched with a semi join on those
    columns plus the table's partition columns. AQE chooses the joins from
    measured sizes; when it broadcasts the winners, dynamic partition pruning
    limits the wide read to the folders that hold them.
    """
    ids = touched_ids.select("id").distinct()
    keys = [c for c in ("id", "version", "batch_id", "seq", MONTH_COL) if c in history.columns]
    narrow = history.select(*keys).join(ids, "id", "left_semi")
    winners = latest_version(narrow, ("id",), include_deleted=True)
    winners = winners.alias("w")
    h = history.alias("h")
    cond = [F.col(f"h.{k}").eqNullSafe(F.col(f"w.{k}")) if k == "seq" else F.col(f"h.{k}") == F.col(f"w.{k}")
            for k in keys]
    cur = h.join(winners, cond, "left_semi")
    return as_base(cur)


def as_base(rows: DataFrame) -> DataFrame:
    """Stored current rows as base operations (vectors or their keys as they are)."""
    return rows.select(
        "id",
        F.lit(-1).cast("bigint").alias("seq"),
        F.col("batch_id").cast("bigint").alias("batch_id"),
        F.lit(OP_BASE).alias("op"),
        F.col("updated_at").alias("ts"),
        *PATCH_FIELDS,
        F.col("version").cast("bigint").alias("b_version"),
        F.col("is_deleted").cast("int").alias("b_is_deleted"),
        F.col("created_at").alias("b_created_at"),
    )


# An event's log is cut where a sample of the whole log holds STEP of its operations; a
# cut is worth about 1 / SLICES of the log, so no event is one task and most have no cut.
SLICES, STEP = 256, 16
# The order of one event's operations; rows that tie in all of it are equal.
ORDER = ("seq", "ts", "op", "_tie")


def _prepare(ops: DataFrame, base: DataFrame | None) -> DataFrame:
    x = ops.select(
        "id", "seq", "batch_id", "op", "ts", *PATCH_FIELDS,
        F.lit(None).cast("bigint").alias("b_version"),
        F.lit(None).cast("int").alias("b_is_deleted"),
        F.lit(None).cast("timestamp_ntz").alias("b_created_at"),
    )
    if base is not None:
        x = x.unionByName(base.select(*x.columns))
    return x.withColumn("_tie", op_key())


def op_key() -> Column:
    """The same hash of an operation's content as ``_tie`` of :func:`fold_rows`, over ``ops``."""
    return F.xxhash64("batch_id", *PATCH_FIELDS)


def _op() -> Column:
    return F.col("op")


def _at() -> Column:
    return F.struct(*ORDER)


def _is_mut() -> Column:
    return F.col("op").isin(OP_UPDATE, OP_DELETE)


def _create_time() -> Column:
    return F.when(F.col("op") == OP_CREATE, F.col("ts")).when(F.col("op") == OP_BASE, F.col("b_created_at"))


def _after_create() -> Column:
    return F.col("_first_create").isNotNull() & (_at() >= F.col("_first_create"))


def _deletion() -> Column:
    return F.when(_after_create() & ((_op() == OP_DELETE) | ((_op() == OP_BASE) & (F.col("b_is_deleted") == 1))), _at())


def _ok() -> Column:
    acts = _after_create() & (F.col("_deleted_at").isNull() | (_at() <= F.col("_deleted_at")))
    return ~_is_mut() | acts


def _shadowed() -> Column:
    return (_op() == OP_CREATE) & (
        (F.col("_first_mut").isNotNull() & (_at() > F.col("_first_mut")))
        | (F.coalesce(F.col("_base_version"), F.lit(1)) > 1)
    )


def _rejects(x: DataFrame) -> DataFrame:
    return x.where(~F.col("_ok")).select(
        F.col("id").alias("event_id"),
        F.col("op").alias("operation"),
        "seq",
        F.lit(R_NOT_FOUND).alias("reason"),
        F.to_json(F.struct(
            F.col("op").alias("operation"), F.col("id").alias("event_id"), F.col("ts").cast("timestamp").alias("timestamp"),
            F.struct(*PATCH_FIELDS).alias("data"),
        )).alias("raw"),
    )


def _order_cuts(ops: DataFrame, slices: int, step: int) -> DataFrame | None:
    """``id, _cuts``: places ``(seq, ts)`` at which the logs of events with many operations are cut.

    From the ``slices * step`` operations of least hash, a sample of any log in
    which an event has points in proportion to its operations. At most
    ``slices`` cuts in all, so the result is small enough to broadcast.
    """
    chosen = ops.select("id", "seq", "ts").orderBy(F.xxhash64("id", "seq", "ts"), "id", "seq", "ts").limit(slices * step)
    at: dict[str, list] = {}
    for r in sorted(chosen.collect(), key=lambda r: (r.id, r.seq, r.ts)):
        at.setdefault(r.id, []).append((r.seq, r.ts))
    cuts = [(i, points[step - 1 :: step]) for i, points in at.items() if len(points) >= step]
    schema = "id string, _cuts array<struct<seq: bigint, ts: timestamp_ntz>>"
    return F.broadcast(ops.sparkSession.createDataFrame(cuts, schema)) if cuts else None


def _sliced(x: DataFrame, cuts: DataFrame | None) -> DataFrame:
    """``_slice`` of each operation, and for each later slice a base row: the event as the slices before leave it.

    Every slice then folds on its own. The states come from aggregates over
    the cut events alone (combined map-side, one row for each event or slice),
    and a window over one event's few slices.
    """
    if cuts is None:
        return x.withColumn("_slice", F.lit(0))
    here = F.struct("seq", "ts")
    x = x.join(cuts, "id", "left").withColumn("_slice", F.coalesce(F.size(F.filter("_cuts", lambda c: c < here)), F.lit(0)))
    cut = x.where(F.col("_cuts").isNotNull()).drop("_cuts")

    def told(rows: DataFrame, *facts: Column) -> DataFrame:
        return rows.join(F.broadcast(rows.groupBy("id").agg(*facts)), "id")  # a row for each cut event

    y = told(cut, F.min(F.when(_op().isin(OP_CREATE, OP_BASE), _at())).alias("_first_create"))
    y = told(y, F.min(_deletion()).alias("_deleted_at")).withColumn("_ok", _ok())
    acts = F.col("_ok") & _is_mut()
    y = told(y, F.min(F.when(acts, _at())).alias("_first_mut"), F.max("b_version").alias("_base_version"))
    counts = F.col("_ok") & ~_shadowed()
    fields = [*PATCH_FIELDS, "_created_at"]
    y = y.withColumn("_created_at", _create_time())
    states = y.groupBy("id", "_slice").agg(
        *[F.max_by(c, F.when(counts & F.col(c).isNotNull(), _at())).alias(c) for c in fields],
        F.sum(acts.cast("bigint")).alias("_muts"),
        F.max(_op().isin(OP_CREATE, OP_BASE)).alias("_created"),
        F.max(_at().eqNullSafe(F.col("_deleted_at"))).alias("_gone"),
        F.max("_base_version").alias("_base_version"),
        F.max("batch_id").alias("batch_id"),
    )
    before = Window.partitionBy("id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = states.select(
        "id", F.lit(-1).cast("bigint").alias("seq"), "batch_id", F.lit(OP_BASE).alias("op"), F.lit(None).cast("timestamp_ntz").alias("ts"),
        *[F.last(c, ignorenulls=True).over(before).alias(c) for c in PATCH_FIELDS],
        (F.coalesce("_base_version", F.lit(1).cast("bigint")) + F.sum("_muts").over(before)).alias("b_version"),
        F.max("_gone").over(before).cast("int").alias("b_is_deleted"),
        F.last("_created_at", ignorenulls=True).over(before).alias("b_created_at"),
        F.lit(0).cast("bigint").alias("_tie"), "_slice", F.max("_created").over(before).alias("_created"),
    )
    x = x.drop("_cuts")
    return x.unionByName(carried.where("_created").select(*x.columns))


def _running(x: DataFrame) -> DataFrame:
    """Existence, deletion, mutation count and shadowing as running values of each slice: one shuffle, one sort."""
    order = Window.partitionBy("id", "_slice").orderBy(*ORDER)
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("_created", F.max(_op().isin(OP_CREATE, OP_BASE)).over(running))
    x = x.withColumn("_base_version", F.max("b_version").over(running))
    ends = F.col("_created") & ((_op() == OP_DELETE) | ((_op() == OP_BASE) & (F.col("b_is_deleted") == 1)))
    x = x.withColumn("_gone", F.coalesce(F.max(ends).over(before), F.lit(False)))
    x = x.withColumn("_ok", ~_is_mut() | (F.col("_created") & ~F.col("_gone")))
    acts = (F.col("_ok") & _is_mut()).cast("bigint")
    x = x.withColumn("_muts", F.sum(acts).over(running))
    late = (F.col("_muts") > 0) | (F.coalesce(F.col("_base_version"), F.lit(1)) > 1)
    return x.withColumn("_shadowed", (_op() == OP_CREATE) & late)


def _folded(x: DataFrame) -> DataFrame:
    order = Window.partitionBy("id", "_slice").orderBy(*ORDER)
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = F.col("_ok") & ~F.col("_shadowed")

    def carried(c: Column) -> Column:
        """The last provided value; a shadowed create has its own."""
        return F.when(F.col("_shadowed"), c).otherwise(F.last(F.when(counts, c), ignorenulls=True).over(running))

    version = F.when(_op() == OP_CREATE, F.lit(1).cast("bigint")).otherwise(
        F.coalesce(F.col("_base_version"), F.lit(1).cast("bigint")) + F.col("_muts")
    )
    y = x.select(
        "id",
        *[carried(F.col(c)).alias(c) for c in PATCH_FIELDS],
        (_op() == OP_DELETE).cast("int").alias("is_deleted"),
        version.alias("version"),
        carried(_create_time()).alias("created_at"),
        F.col("ts").alias("updated_at"),
        "batch_id", "seq", F.col("_shadowed").cast("int").alias(SHADOW_COL), "op", "_tie", "_ok",
    )
    return y.where(_op() != OP_BASE)


def fold_rows(ops: DataFrame, base: DataFrame | None = None, slices: int = SLICES, step: int = STEP) -> DataFrame:
    """Every operation with the version row it makes (``EVENT_COLS``, ``batch_id, seq, shadowed``), ``op``,
    ``_tie`` (a hash of its content) and ``_ok``: False where it has nothing to act on."""
    return _folded(_running(_sliced(_prepare(ops, base), _order_cuts(ops, slices, step))))


def fold_operations(
    ops: DataFrame,
    base: DataFrame | None = None,
    slices: int = SLICES,
    step: int = STEP,
) -> tuple[DataFrame, DataFrame]:
    """Fold normalised operations into version rows.

    ``ops``: ``id, seq, batch_id, op, ts`` + patch fields (NULL = not
    provided), from :func:`tidemark.operators.validate.split_messages`.
    ``base``: optional stored state from :func:`base_from_history`.

    All events take one path: their logs are cut into slices by order (an
    event that is a small part of the log is one slice), the state before each
    slice enters it as a base row, and running values fold each slice. The
    cuts come from a bounded sample of ``ops``, read when this is called.

    Returns ``(versions, rejects)``: version rows with ``EVENT_COLS`` +
    ``batch_id, seq, shadowed`` (1: a create that was never visible), and ``not_found`` rejects (``event_id, operation,
    seq, reason, raw``).
    """
    x = _running(_sliced(_prepare(ops, base), _order_cuts(ops, slices, step)))
    versions = _folded(x).where("_ok").select(*EVENT_COLS, "batch_id", "seq", SHADOW_COL)
    return versions, _rejects(x)
