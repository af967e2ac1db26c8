"""Map the driver's parquet tables onto the versioned event model.

The driver tables are not event logs, so each adapter derives one with
plain DataFrame operations. All of them read the whole table; nothing is
sampled or capped.

* A  ``events``: one event per row; 2 in 5 events get an update, 2 in 5 a
  soft delete (the 5:2:2 create/update/delete mix), as a change log
  (:func:`changelog_a`) that the fold turns into version rows.
* B  ``orders``: many months of creates, for partition pruning.
* C  ``conversations`` + ``embeddings``: text and vectors, one event per
  user or system turn, answered by an update with the assistant's reply.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import empty_floats, to_millis
from tidemark.schema import (
    EVENT_NAMES,
    MESSAGE_SCHEMA,
    OP_CREATE,
    OP_DELETE,
    OP_UPDATE,
    PATCH_SCHEMA,
)

# Delay between an event's creation and its update/delete in adapter A.
MUTATION_DELAY = "INTERVAL 1 HOUR"
# Start time of adapter C's conversations.
CONVERSATION_EPOCH = "2024-02-01 00:00:00"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _name_by(n: F.Column) -> F.Column:
    """Event name from a non-negative integer: 0 -> event_a, 1 -> event_b, 2 -> event_c."""
    return F.element_at(F.array(*[F.lit(x) for x in EVENT_NAMES]), (F.pmod(n, F.lit(3)) + 1).cast("int"))


def _events_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.lit("conv_"), F.col("user_id").cast("string")).alias("conversation_id"),
        F.coalesce(F.col("props"), F.lit("")).alias("conversation_metadata"),
        _name_by(F.col("event_id")).alias("event_name"),
        F.when(F.col("event_type") == "error", F.lit("internal_error")).otherwise(F.lit("")).alias("error"),
        F.coalesce(F.col("value"), F.lit(0.0)).alias("latency"),
        F.pmod(F.col("event_id"), F.lit(5)).alias("k"),
        to_millis("ts").alias("created_at"),
    )


def _mutated_at(created_at: F.Column) -> F.Column:
    return (created_at + F.expr(MUTATION_DELAY)).cast("timestamp_ntz")


def _patch(**fields: F.Column) -> F.Column:
    """A patch struct with the given fields set and every other field NULL."""
    cols = []
    for f in PATCH_SCHEMA.fields:
        value = fields.get(f.name)
        cols.append((value if value is not None else F.lit(None)).cast(f.dataType).alias(f.name))
    return F.struct(*cols)


def _message(op: str, event_id: F.Column, ts: F.Column, data: F.Column | None, seq: int) -> list[F.Column]:
    data_col = data if data is not None else F.lit(None).cast(PATCH_SCHEMA)
    return [
        F.lit(op).alias("operation"),
        event_id.alias("event_id"),
        ts.cast("timestamp").alias("timestamp"),
        data_col.alias("data"),
        F.lit(seq).cast("bigint").alias("seq"),
    ]


def changelog_a(spark: SparkSession, sf_dir: str, rename: bool = False) -> DataFrame:
    """Adapter A as change messages (decoded envelope columns, ``MESSAGE_SCHEMA``).

    Per event: ``create`` at seq 0; for k in (0, 1) an ``update`` of error and
    latency at seq 1; for k in (2, 3) a ``delete`` at seq 1. Embeddings are
    not sent, as by the reference load generator. With ``rename`` the k = 0
    updates also move the event to the next event name.
    """
    b = _events_base(spark, sf_dir)
    create = b.select(
        *_message(
            OP_CREATE,
            F.col("id"),
            F.col("created_at"),
            _patch(
                conversation_id=F.col("conversation_id"),
                conversation_metadata=F.col("conversation_metadata"),
                event_name=F.col("event_name"),
                error=F.col("error"),
                latency=F.col("latency"),
            ),
            0,
        )
    )
    update = b.where(F.col("k").isin(0, 1)).select(
        *_message(
            OP_UPDATE,
            F.col("id"),
            _mutated_at(F.col("created_at")),
            _patch(
                error=F.when(F.col("error") == "", F.lit("timeout")).otherwise(F.lit("")),
                latency=F.col("latency") * 2,
                event_name=F.when(F.col("k") == 0, _name_by(F.col("id").cast("bigint") + 1)) if rename else None,
            ),
            1,
        )
    )
    delete = b.where(F.col("k").isin(2, 3)).select(
        *_message(OP_DELETE, F.col("id"), _mutated_at(F.col("created_at")), None, 1)
    )
    return create.unionByName(update).unionByName(delete).select(*[f.name for f in MESSAGE_SCHEMA.fields])


def history_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter B: one live version-1 event per order, spread over many months."""
    o = _table(spark, sf_dir, "orders")
    created = to_millis("o_orderdate")
    return o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("cust_"), F.col("o_custkey").cast("string")).alias("conversation_id"),
        F.col("o_orderpriority").alias("conversation_metadata"),
        _name_by(F.col("o_orderkey")).alias("event_name"),
        F.when(F.col("o_orderstatus") == "P", F.lit("pending")).otherwise(F.lit("")).alias("error"),
        F.col("o_totalprice").alias("latency"),
        F.lit("").alias("input"),
        empty_floats().alias("input_embeddings"),
        F.lit("").alias("output"),
        empty_floats().alias("output_embeddings"),
        F.lit(0).alias("is_deleted"),
        F.lit(1).cast("bigint").alias("version"),
        created.alias("created_at"),
        created.alias("updated_at"),
    )


def _user_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User and system turns with the reply that follows them and their input vector."""
    conv = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    vec = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id"), F.col("embedding").alias("input_embeddings")
    )
    user = conv.where(F.col("role") != "assistant").alias("u")
    reply = conv.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply")
    )
    turns = user.join(reply, ["conv_id", "turn"], "left")
    turns = turns.withColumn("vec_id", F.pmod(F.col("conv_id") * 8 + F.col("turn"), F.lit(500)))
    turns = turns.join(vec, "vec_id", "left")
    start = F.lit(CONVERSATION_EPOCH).cast("timestamp_ntz")
    return turns.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.concat(F.lit("conv_"), F.col("conv_id").cast("string")).alias("conversation_id"),
        _name_by(F.col("turn")).alias("event_name"),
        F.col("text").alias("input"),
        F.coalesce(F.col("input_embeddings"), empty_floats()).alias("input_embeddings"),
        F.col("reply"),
        F.length("text").cast("double").alias("latency"),
        (start + F.make_dt_interval(F.lit(0), F.lit(0), F.col("turn").cast("int"))).alias("created_at"),
    )


def changelog_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter C as change messages: a create per user turn, an update with the reply."""
    t = _user_turns(spark, sf_dir)
    create = t.select(
        *_message(
            OP_CREATE,
            F.col("id"),
            F.col("created_at"),
            _patch(
                conversation_id=F.col("conversation_id"),
                event_name=F.col("event_name"),
                latency=F.col("latency"),
                input=F.col("input"),
                input_embeddings=F.col("input_embeddings"),
            ),
            0,
        )
    )
    update = t.where(F.col("reply").isNotNull()).select(
        *_message(
            OP_UPDATE,
            F.col("id"),
            (F.col("created_at") + F.expr("INTERVAL 30 SECONDS")).cast("timestamp_ntz"),
            _patch(output=F.col("reply")),
            1,
        )
    )
    return create.unionByName(update).select(*[f.name for f in MESSAGE_SCHEMA.fields])


def _plain_creates(b: DataFrame, *extra: str, **over: F.Column) -> DataFrame:
    fields = dict(
        conversation_id=F.col("conversation_id"),
        conversation_metadata=F.col("conversation_metadata"),
        event_name=F.col("event_name"),
        error=F.col("error"),
        latency=F.col("latency"),
    )
    fields.update(over)
    return b.select(*_message(OP_CREATE, F.col("id"), F.col("created_at"), _patch(**fields), 0), *extra)


def faulty_changelog_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter A's creates as JSON text (``value``), with one fault class per event.

    The class is ``event_id % 10`` and every event is kept:

    0 valid create · 1 truncated JSON · 2 operation ``Create`` (wrong case) ·
    3 create without ``data`` · 4 unknown event name · 5 empty session id ·
    6 valid create + update of an id that does not exist · 7 valid create,
    delete, then update of the deleted event · 8 valid create + update to an
    unknown event name · 9 ``latency`` sent as text.
    """
    from tidemark.sources.changelog import encode_json

    b = _events_base(spark, sf_dir).withColumn("r", F.pmod(F.col("id").cast("bigint"), F.lit(10)))
    later = _mutated_at(F.col("created_at"))
    r = F.col("r")
    creates = _plain_creates(
        b,
        "r",
        event_name=F.when(r == 4, F.lit("event_z")).otherwise(F.col("event_name")),
        conversation_id=F.when(r == 5, F.lit("")).otherwise(F.col("conversation_id")),
    )
    creates = creates.withColumn(
        "operation", F.when(r == 2, F.lit("Create")).otherwise(F.col("operation"))
    ).withColumn("data", F.when(r == 3, F.lit(None).cast(PATCH_SCHEMA)).otherwise(F.col("data")))
    ghost = b.where(r == 6).select(
        *_message(OP_UPDATE, F.concat(F.col("id"), F.lit("-ghost")), later, _patch(error=F.lit("x")), 1), "r"
    )
    dead_delete = b.where(r == 7).select(*_message(OP_DELETE, F.col("id"), later, None, 1), "r")
    dead_update = b.where(r == 7).select(
        *_message(OP_UPDATE, F.col("id"), later, _patch(latency=F.lit(1.0)), 2), "r"
    )
    bad_rename = b.where(r == 8).select(
        *_message(OP_UPDATE, F.col("id"), later, _patch(event_name=F.lit("event_q")), 1), "r"
    )
    msgs = creates.unionByName(ghost).unionByName(dead_delete).unionByName(dead_update).unionByName(bad_rename)
    text = encode_json(msgs, keep=("r",))
    value = (
        F.when(r == 1, F.expr("substring(value, 1, length(value) - 1)"))
        .when(r == 9, F.regexp_replace("value", '"latency":[-0-9.Ee]+', '"latency":"n/a"'))
        .otherwise(F.col("value"))
    )
    return text.select(value.alias("value"))


def patch_changelog_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter A's events created with every field set, then one update each.

    The update class is ``event_id % 8`` (each exercises one "not provided"
    rule): 0 ``error=""`` clears · 1 ``output=""`` is ignored · 2
    ``latency=0`` applies · 3 empty patch (version bump only) · 4
    ``input_embeddings=[]`` clears · 5 ``conversation_metadata=""`` ignored and
    ``input`` replaced · 6 ``event_name`` changed · 7 ``conversation_id``
    changed.
    """
    b = _events_base(spark, sf_dir).withColumn("r", F.pmod(F.col("id").cast("bigint"), F.lit(8)))
    vec = F.array(F.lit(1.0), F.lit(2.0)).cast("array<float>")
    creates = _plain_creates(
        b,
        error=F.lit("boom"),
        input=F.lit("in"),
        output=F.lit("out"),
        input_embeddings=vec,
        output_embeddings=vec,
    )
    r = F.col("r")
    patch = _patch(
        error=F.when(r == 0, F.lit("")),
        output=F.when(r == 1, F.lit("")),
        latency=F.when(r == 2, F.lit(0.0)),
        input_embeddings=F.when(r == 4, F.array().cast("array<float>")),
        conversation_metadata=F.when(r == 5, F.lit("")),
        input=F.when(r == 5, F.lit("in2")),
        event_name=F.when(r == 6, _name_by(F.col("id").cast("bigint") + 1)),
        conversation_id=F.when(r == 7, F.concat(F.col("conversation_id"), F.lit("_moved"))),
    )
    updates = b.select(*_message(OP_UPDATE, F.col("id"), _mutated_at(F.col("created_at")), patch, 1))
    return creates.unionByName(updates)


def events_requests(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Adapter A as client requests (the same 5:2:2 mix), for the bulk client builders.

    ``create``: every event with its id and time; ``update`` (k in 0, 1):
    error flipped, latency doubled; ``delete`` (k in 2, 3); for every event
    also ``empty``: an update with no field, and ``bad_name``: a create with
    a name outside the allowed set.
    """
    b = _events_base(spark, sf_dir)
    later = _mutated_at(F.col("created_at")).cast("timestamp").alias("timestamp")
    return {
        "create": b.select(
            "id", "conversation_id", "conversation_metadata", "event_name", "error", "latency",
            F.col("created_at").cast("timestamp").alias("timestamp"), F.lit(0).cast("bigint").alias("seq"),
        ),
        "update": b.where(F.col("k").isin(0, 1)).select(
            F.col("id").alias("event_id"),
            F.when(F.col("error") == "", F.lit("timeout")).otherwise(F.lit("")).alias("error"),
            (F.col("latency") * 2).alias("latency"),
            later,
            F.lit(1).cast("bigint").alias("seq"),
        ),
        "delete": b.where(F.col("k").isin(2, 3)).select(
            F.col("id").alias("event_id"), later, F.lit(1).cast("bigint").alias("seq")
        ),
        "empty": b.select(F.col("id").alias("event_id"), later, F.lit(1).cast("bigint").alias("seq")),
        "bad_name": b.select(
            F.concat(F.col("id"), F.lit("-x")).alias("id"), "conversation_id",
            F.lit("event_d").alias("event_name"), F.col("created_at").cast("timestamp").alias("timestamp"),
        ),
    }


def hot_changelog_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``events`` as operations on one event: a create, then an update of latency and error each.

    The log positions are sparse (every 1000th) with one far outlier.
    """
    b = _events_base(spark, sf_dir)
    number = F.col("id").cast("bigint")
    first = number == 0
    rows = b.select(
        F.when(first, F.lit(OP_CREATE)).otherwise(F.lit(OP_UPDATE)).alias("operation"),
        F.lit("hot").alias("event_id"),
        F.col("created_at").cast("timestamp").alias("timestamp"),
        _patch(
            conversation_id=F.when(first, F.lit("conv_hot")),
            event_name=F.when(first, F.lit(EVENT_NAMES[0])),
            latency=F.when(F.pmod(number, F.lit(3)) == 0, F.col("latency")),
            error=F.when(F.pmod(number, F.lit(7)) == 0, F.col("error")),
        ).alias("data"),
        (number * 1000).alias("seq"),
    )
    outlier = F.lit(10**15).cast("bigint")
    last = rows.limit(0).unionByName(spark.range(1).select(
        F.lit(OP_UPDATE).alias("operation"), F.lit("hot").alias("event_id"), F.lit("2025-01-01 00:00:00").cast("timestamp").alias("timestamp"),
        _patch(latency=F.lit(-1.0)).alias("data"), outlier.alias("seq"),
    ))
    return rows.unionByName(last)
