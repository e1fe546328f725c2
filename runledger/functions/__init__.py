"""Column functions: any-values, times, bodies."""

from runledger.functions.anyvalue import any_as_string, attr, body_value, double_text
from runledger.functions.body import body_text, json_text
from runledger.functions.times import epoch_micros, nanos_to_timestamp, resolve_time, rfc3339

__all__ = [
    "any_as_string",
    "attr",
    "body_text",
    "body_value",
    "double_text",
    "epoch_micros",
    "json_text",
    "nanos_to_timestamp",
    "resolve_time",
    "rfc3339",
]
