"""Rules for parameters, checked before anything is planned."""

from __future__ import annotations

import re

from runledger.schema import DEFAULT_LIMIT, MAX_LIMIT

# What a name may look like, and what callers are told.
IDENTIFIER = r"[a-zA-Z_][a-zA-Z0-9_]*"
NO_RUN_ID = "agentic_run_id is required"
BAD_LIMIT = "limit must be a positive integer"
BAD_AFTER = "after must be a non-negative integer"

_INT64 = range(-(1 << 63), 1 << 63)


def _integer(value) -> int | None:
    """A 64-bit integer from an int or decimal text; None if it is not one."""
    if isinstance(value, bool):
        return None
    if isinstance(value, str):
        value = int(value) if re.fullmatch(r"[+-]?[0-9]+", value) else None
    return value if isinstance(value, int) and value in _INT64 else None


def require_run_id(run_id: str | None) -> str:
    if not run_id:
        raise ValueError(NO_RUN_ID)
    return run_id


def clamp_limit(value=None) -> int:
    """Absent: the default.  Below 1 or no integer: an error.  Above the maximum: the maximum."""
    if value is None or value == "":
        return DEFAULT_LIMIT
    limit = _integer(value)
    if limit is None or limit < 1:
        raise ValueError(BAD_LIMIT)
    return min(limit, MAX_LIMIT)


def parse_after(value=None) -> int:
    """Absent: 0.  Negative or no integer: an error."""
    if value is None or value == "":
        return 0
    after = _integer(value)
    if after is None or after < 0:
        raise ValueError(BAD_AFTER)
    return after


def check_identifier(name: str) -> str:
    """A schema or table name, in the one spelling (lower case) used everywhere."""
    if not isinstance(name, str) or not re.fullmatch(IDENTIFIER, name):
        raise ValueError(f"{name!r} is not a valid identifier")
    return name.lower()
