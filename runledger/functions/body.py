"""Bodies as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_text(body: Column) -> Column:
    """Canonical JSON text of a variant; NULL stays NULL.  Variants cannot be compared, this can."""
    return F.to_json(body)


def body_text(body: Column) -> Column:
    """What a plain-text page shows: a JSON string without its quotes, nothing for a
    JSON null or a missing body, and the JSON itself for anything else."""
    text = json_text(body)
    return F.coalesce(
        F.when(F.startswith(text, F.lit('"')), F.variant_get(body, "$", "string"))
        .when(text == "null", F.lit(""))
        .otherwise(text),
        F.lit(""),
    )
