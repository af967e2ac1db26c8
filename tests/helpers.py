"""Test helpers: message builders and a plain sequential model of the event store.

The model applies messages one at a time the way a read-modify-write store
does: a create inserts version 1; an update/delete reads the visible row
(highest version, last inserted on ties), overlays the patch, bumps the
version and inserts. It is the oracle for the set-based fold.
"""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import Row

from tidemark.schema import MESSAGE_SCHEMA, PATCH_FIELDS

UTC = dt.timezone.utc
T0 = dt.datetime(2024, 1, 1, tzinfo=UTC)
BLANK_IS_ABSENT = ("conversation_id", "conversation_metadata", "event_name", "input", "output")


def msg(op, event_id, seq, ts=None, **data):
    """One decoded message row; ``data=None`` passes no payload."""
    if ts is None:
        ts = T0 + dt.timedelta(minutes=seq)
    payload = data.pop("data", "_") if "data" in data else "_"
    if payload is None:
        d = None
    else:
        d = Row(**{f: data.get(f) for f in PATCH_FIELDS})
    return (op, event_id, ts, d, seq)


def messages_df(spark, rows):
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def _ms(ts):
    ts = ts.astimezone(UTC).replace(tzinfo=None)
    return ts.replace(microsecond=(ts.microsecond // 1000) * 1000)


def model(messages):
    """Apply messages in order. Returns (history rows as dicts, rejects as (id, op, seq, reason))."""
    history, rejects, visible = [], [], {}
    for op, eid, ts, data, seq in messages:
        d = data.asDict() if data is not None else None
        if op == "create":
            row = {
                "id": eid,
                "conversation_id": d["conversation_id"],
                "conversation_metadata": d["conversation_metadata"] or "",
                "event_name": d["event_name"],
                "error": d["error"] if d["error"] is not None else "",
                "latency": d["latency"] if d["latency"] is not None else 0.0,
                "input": d["input"] or "",
                "input_embeddings": list(d["input_embeddings"]) if d["input_embeddings"] is not None else [],
                "output": d["output"] or "",
                "output_embeddings": list(d["output_embeddings"]) if d["output_embeddings"] is not None else [],
                "is_deleted": 0,
                "version": 1,
                "created_at": _ms(ts),
                "updated_at": _ms(ts),
            }
            history.append(row)
            cur = visible.get(eid)
            if cur is None or row["version"] >= cur["version"]:
                visible[eid] = row
        else:
            cur = visible.get(eid)
            if cur is None or cur["is_deleted"] == 1:
                rejects.append((eid, op, seq, "not_found"))
                continue
            new = dict(cur)
            if op == "update":
                for f in PATCH_FIELDS:
                    v = d.get(f)
                    if v is None:
                        continue
                    if f in BLANK_IS_ABSENT and v == "":
                        continue
                    new[f] = list(v) if isinstance(v, (list, tuple)) else v
            else:
                new["is_deleted"] = 1
            new["version"] = cur["version"] + 1
            new["updated_at"] = _ms(ts)
            history.append(new)
            visible[eid] = new
    return history, rejects


def random_log(n_ids=300, n_ops=1500, seed=7):
    """A random but valid-by-validation message log (names from the allowed set)."""
    rnd = random.Random(seed)
    names = ["event_a", "event_b", "event_c"]
    rows = []
    for seq in range(n_ops):
        eid = f"e{rnd.randrange(n_ids)}"
        r = rnd.random()
        ts = T0 + dt.timedelta(seconds=seq * 7, microseconds=rnd.randrange(10**6))
        if r < 0.35:
            rows.append(
                msg(
                    "create", eid, seq, ts,
                    conversation_id=f"c{rnd.randrange(20)}",
                    conversation_metadata=rnd.choice([None, "", "m1", "m2"]),
                    event_name=rnd.choice(names),
                    error=rnd.choice([None, "", "timeout"]),
                    latency=rnd.choice([None, 0.0, round(rnd.uniform(0, 5000), 3)]),
                    input=rnd.choice([None, "", "hi"]),
                    input_embeddings=rnd.choice([None, [], [0.5, 1.5]]),
                    output=rnd.choice([None, "", "yo"]),
                )
            )
        elif r < 0.8:
            rows.append(
                msg(
                    "update", eid, seq, ts,
                    conversation_id=rnd.choice([None, None, "", f"c{rnd.randrange(20)}"]),
                    conversation_metadata=rnd.choice([None, "", "m3"]),
                    event_name=rnd.choice([None, None, "", *names]),
                    error=rnd.choice([None, "", "bad_request"]),
                    latency=rnd.choice([None, 0.0, round(rnd.uniform(0, 5000), 3)]),
                    input=rnd.choice([None, "", "again"]),
                    input_embeddings=rnd.choice([None, [], [2.5]]),
                    output=rnd.choice([None, "", "done"]),
                    output_embeddings=rnd.choice([None, [], [3.5, 4.5]]),
                )
            )
        else:
            rows.append(msg("delete", eid, seq, ts, data=None))
    return rows


def row_key(r: dict) -> tuple:
    return tuple(
        tuple(r[c]) if isinstance(r[c], list) else r[c]
        for c in (
            "id", "conversation_id", "conversation_metadata", "event_name", "error", "latency", "input",
            "input_embeddings", "output", "output_embeddings", "is_deleted", "version", "created_at", "updated_at",
        )
    )


def spark_rows(df) -> list[dict]:
    out = []
    for r in df.collect():
        d = r.asDict()
        for c in ("input_embeddings", "output_embeddings"):
            d[c] = list(d[c]) if d[c] is not None else None
        out.append(d)
    return out
