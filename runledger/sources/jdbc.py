"""Options and columns for a PostgreSQL log table.  The driver jar has to be on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.functions import json_text
from runledger.operators.rules import check_identifier
from runledger.schema import DEFAULT_SCHEMA, DEFAULT_TABLE


def jdbc_options(url: str, schema: str = DEFAULT_SCHEMA, table: str = DEFAULT_TABLE) -> dict:
    """Options for ``spark.read`` / ``df.write`` with ``format("jdbc")``.

    ``stringtype=unspecified`` lets the server cast body text to its JSON type;
    filters on run, phase and id are pushed to the server by Spark itself.
    """
    if not url:
        raise ValueError("url must not be empty")
    return {
        "url": url,
        "dbtable": f"{check_identifier(schema)}.{check_identifier(table)}",
        "driver": "org.postgresql.Driver",
        "stringtype": "unspecified",
        "pushDownPredicate": "true",
    }


def jdbc_read_options(url: str, first: int, last: int, parts: int, **names: str) -> dict:
    """Options to read the ids from ``first`` to ``last`` in ``parts`` queries at once.

    The bounds only tell where to cut; rows with other ids are read too, by the first and the last query.
    """
    if parts < 1 or last < first:
        raise ValueError("parts must be positive and last not below first")
    cuts = {"partitionColumn": "id", "lowerBound": str(first), "upperBound": str(last + 1), "numPartitions": str(parts)}
    return {**jdbc_options(url, **names), **cuts}


def to_jdbc(logs: DataFrame) -> DataFrame:
    """What the server is sent: its own five columns, the body as JSON text.  It gives the ids itself."""
    return logs.select("agentic_run_id", "phase", "timestamp", "event", json_text(F.col("body")).alias("body"))


def from_jdbc(rows: DataFrame) -> DataFrame:
    """Rows as the server has them, with the body as a variant again; a missing phase is ''.  Other columns stay."""
    return rows.withColumns({"phase": F.coalesce("phase", F.lit("")), "body": F.parse_json("body")})
