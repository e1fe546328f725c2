import pytest

from runledger.operators.rules import check_identifier, clamp_limit, parse_after, require_run_id
from runledger.sources.jdbc import jdbc_options, jdbc_read_options, to_jdbc


@pytest.mark.parametrize("given, limit", [(None, 100), ("", 100), (1, 1), ("50", 50), ("+5", 5), (1000, 1000), (1001, 1000), ("9999", 1000)])
def test_limit(given, limit):
    assert clamp_limit(given) == limit


@pytest.mark.parametrize("given", [0, -1, "0", "-1", "abc", "1.5", 1.5, " 5", "1_000", True, "99999999999999999999"])
def test_bad_limit(given):
    with pytest.raises(ValueError):
        clamp_limit(given)


@pytest.mark.parametrize("given, after", [(None, 0), ("", 0), (0, 0), ("12345", 12345), (7, 7)])
def test_after(given, after):
    assert parse_after(given) == after


@pytest.mark.parametrize("given", [-1, "-1", "abc", "1e3", "9223372036854775808"])
def test_bad_after(given):
    with pytest.raises(ValueError):
        parse_after(given)


@pytest.mark.parametrize("run_id", [None, ""])
def test_run_id_is_required(run_id):
    with pytest.raises(ValueError):
        require_run_id(run_id)


@pytest.mark.parametrize("name", ["", "a b", "1abc", "my-table", "logs;", 'logs"; DROP TABLE x; --', "a.b", "logs\n", "é", None])
def test_bad_identifier(name):
    with pytest.raises(ValueError):
        check_identifier(name)


@pytest.mark.parametrize("name, spelled", [("templogs", "templogs"), ("_t_1", "_t_1"), ("Logs", "logs")])
def test_identifier(name, spelled):
    assert check_identifier(name) == spelled


def test_jdbc_options():
    options = jdbc_options("jdbc:postgresql://db/logs")
    assert options["dbtable"] == "templogs.logs" and options["stringtype"] == "unspecified"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:postgresql://db/logs", "a;b")
    with pytest.raises(ValueError):
        jdbc_options("")


def test_jdbc_reads_in_parts():
    options = jdbc_read_options("jdbc:postgresql://db/logs", 1, 1000, 4, table="more")
    assert options["dbtable"] == "templogs.more" and options["upperBound"] == "1001" and options["numPartitions"] == "4"
    for first, last, parts in ((1, 0, 1), (1, 5, 0)):
        with pytest.raises(ValueError):
            jdbc_read_options("jdbc:postgresql://db/logs", first, last, parts)


def test_jdbc_columns(spark):
    logs = spark.sql("SELECT 1L AS id, 'r' AS agentic_run_id, '' AS phase, timestamp_seconds(1) AS timestamp, 'e' AS event, "
                     "parse_json('{\"a\":[1,null]}') AS body, 2L AS batch_id, 3 AS bucket, 4L AS era")
    sent = to_jdbc(logs)
    assert [f.dataType.simpleString() for f in sent.schema] == ["string", "string", "timestamp", "string", "string"]
    assert sent.first()["body"] == '{"a":[1,null]}'
