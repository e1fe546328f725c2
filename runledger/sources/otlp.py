"""OTLP/JSON envelopes in files, one envelope per line: scan and forward."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.operators.extract import accepted
from runledger.operators.ids import ARRIVAL_COLUMNS
from runledger.schema import OTLP_LOGS, OTLP_TRACES, REJECTED
from runledger.session import setting, write_through


def _scan(spark: SparkSession, path: str, schema: str, streaming: bool, options: dict) -> DataFrame:
    options = {"mode": "PERMISSIVE", **options, "columnNameOfCorruptRecord": REJECTED}
    reader = (spark.readStream if streaming else spark.read).schema(f"{schema}, {REJECTED} string").options(**options)
    return reader.json(path).select("*", *[f"_metadata.{c}" for c in ARRIVAL_COLUMNS])


def scan_otlp_logs(spark: SparkSession, path: str, streaming: bool = False, **options) -> DataFrame:
    """Log envelopes, with the file columns that tell their order of arrival, and ``rejected``.

    A line that is no JSON or has a field of a wrong type is refused whole, as a receiver would: its
    text is in ``rejected``, flattening and forwarding leave it out, and streams count it.  With
    ``mode="FAILFAST"`` it is an error.  For a stream, ``maxFilesPerTrigger`` or
    ``maxBytesPerTrigger`` bound what one micro-batch takes in, which is all the back-pressure a
    file source needs.
    """
    return _scan(spark, path, OTLP_LOGS, streaming, options)


def scan_otlp_traces(spark: SparkSession, path: str, streaming: bool = False, **options) -> DataFrame:
    """Span envelopes; all below the resource is kept as it came.  Bad lines are refused like those of logs."""
    return _scan(spark, path, OTLP_TRACES, streaming, options)


def rejected_lines(envelopes: DataFrame) -> DataFrame:
    """``file_path``, ``line`` of what was refused, and how many ``resources`` could be read in it nevertheless."""
    field = next(c for c in ("resourceLogs", "resourceSpans") if c in envelopes.columns)
    # Reading the field makes Spark parse it; a line is only found wrong where it is parsed.
    resources = F.coalesce(F.size(field), F.lit(0)).alias("resources")
    return envelopes.where(F.col(REJECTED).isNotNull()).select("file_path", F.col(REJECTED).alias("line"), resources)


# Most records of an envelope.
ENVELOPE_RECORDS = 100_000


def _in_order(position: str, value: Column) -> Column:
    """Values of a group ordered by ``position``.  Variants have no order of their own, so places are sorted and then looked up."""
    gathered = F.collect_list(F.struct(F.col(position).alias("p"), value.alias("v")))
    places = F.array_sort(F.transform(gathered, lambda x, i: F.struct(x["p"].alias("p"), i.alias("i"))))
    return F.transform(places, lambda x: F.get(gathered, x["i"])["v"])


def to_otlp_envelopes(flat: DataFrame, envelope: list[str], max_records: int | None = ENVELOPE_RECORDS) -> DataFrame:
    """Regroup flattened rows into envelopes.

    ``flat`` has the columns of :func:`runledger.operators.extract.flatten_logs`;
    rows equal in the ``envelope`` columns share an envelope, and ``ri, si, li``
    say where in it a row belongs.  An envelope is a batch, so its size is the
    batch size and never that of a whole resource.  One shuffle serves all three
    levels, as rows of an envelope are together from the start.

    Where more than ``max_records`` rows are equal in the ``envelope`` columns, as when these are NULL or one is hot,
    they are dealt by a hash of the record over as many envelopes as it takes, each in the order of
    its rows; so no task gathers more.  The sizes come from a pass over those columns alone; None leaves it out.
    """
    named = flat.select(*envelope, "ri", "si", "li", "resource", "scope", "record")
    if max_records is not None:
        # Fewer than rows / max_records.
        large = flat.groupBy(*envelope).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_records)
        large = large.select(F.struct(*envelope).alias("_key"), F.ceil(F.col("_n") * 2 / max_records).alias("_parts"))
        large = write_through(large, "large")
        if not large.isEmpty():
            named = _dealt(named, large, envelope)
    part = [c for c in ("_part",) if c in named.columns]
    keys = [*envelope, *part]
    # In this order, all three levels can be gathered as the rows go by; hashing would hold the rows of a task three times.
    together = named.repartition(*keys).sortWithinPartitions(*keys, "ri", "si")
    scopes = together.groupBy(*keys, "ri", "si").agg(
        F.first("resource").alias("resource"),
        F.first("scope").alias("scope"),
        _in_order("li", F.col("record")).alias("logRecords"),
    )
    resources = scopes.sortWithinPartitions(*keys, "ri").groupBy(*keys, "ri").agg(
        F.first("resource").alias("resource"), _in_order("si", F.struct("scope", "logRecords")).alias("scopeLogs")
    )
    return resources.sortWithinPartitions(*keys).groupBy(*keys).agg(_in_order("ri", F.struct("resource", "scopeLogs")).alias("resourceLogs")).drop(*part)


def _dealt(rows: DataFrame, large: DataFrame, envelope: list[str]) -> DataFrame:
    """``rows`` with ``_part``, 0 but for those of large envelopes."""
    of_row, of_key = F.struct(*envelope), F.col("_key")
    found = rows.join(large, of_row.eqNullSafe(of_key), "left")
    spread = F.pmod(F.xxhash64("ri", "si", "li", F.to_json("record")), F.col("_parts"))
    return found.withColumn("_part", F.when(F.col("_parts").isNull(), 0).otherwise(spread)).drop("_key", "_parts")


def write_otlp(envelopes: DataFrame, path: str, mode: str = "append") -> None:
    """Forward envelopes downstream: one JSON text per line, ready to be scanned again."""
    field = next(c for c in ("resourceLogs", "resourceSpans") if c in envelopes.columns)
    # Envelopes that were made in order are gathered in order (see to_otlp_envelopes).
    with setting(envelopes.sparkSession, "spark.sql.execution.replaceHashWithSortAgg", "true"):
        accepted(envelopes).select(field).write.mode(mode).json(path)
