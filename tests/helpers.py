"""Small inputs for tests: envelopes as JSON files, and log rows."""

import json
import uuid

from pyspark.sql import functions as F

from runledger.plans.inputs import new_table


def value(v):
    """An any-value in OTLP/JSON."""
    if v is None:
        return {}
    if isinstance(v, bool):
        return {"boolValue": v}
    if isinstance(v, int):
        return {"intValue": str(v)}
    if isinstance(v, float):
        return {"doubleValue": v}
    if isinstance(v, list):
        return {"arrayValue": {"values": [value(x) for x in v]}}
    if isinstance(v, dict):
        return {"kvlistValue": {"values": [{"key": k, "value": value(x)} for k, x in v.items()]}}
    return {"stringValue": v}


def attributes(pairs):
    return [{"key": k, "value": value(v)} for k, v in pairs]


def record(run=None, phase=None, event=None, body=None, time=0, observed=0, extra=()):
    named = [("agenticrun.uid", run), ("agenticrun.phase", phase), ("event", event)]
    pairs = [(k, v) for k, v in named if v is not None] + list(extra)
    return {
        "timeUnixNano": str(time),
        "observedTimeUnixNano": str(observed),
        "body": value(body),
        "attributes": attributes(pairs),
    }


def envelope(*records, service=None):
    resource = {"attributes": attributes([("service.name", service)] if service else [])}
    return {"resourceLogs": [{"resource": resource, "scopeLogs": [{"scope": {}, "logRecords": list(records)}]}]}


def write_envelopes(folder, *envelopes):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"{len(list(folder.iterdir())):04d}-{uuid.uuid4().hex}.json"
    path.write_text("".join(json.dumps(e) + "\n" for e in envelopes))
    return str(folder)


def log_rows(spark, rows):
    """Log rows from ``(id, run, phase, seconds, event, body JSON or None)``."""
    made = spark.createDataFrame(rows, "id long, agentic_run_id string, phase string, s double, event string, j string")
    return made.select(
        "id",
        "agentic_run_id",
        "phase",
        F.timestamp_micros((F.col("s") * 1000000).cast("bigint")).alias("timestamp"),
        "event",
        F.parse_json("j").alias("body"),
    )


__all__ = ["attributes", "envelope", "log_rows", "new_table", "record", "value", "write_envelopes"]
