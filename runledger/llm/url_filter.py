"""URL filters: host and path rules, found by their rarest literal token and decided by regular expressions."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import packed, quoted, unpacked

# Rules up to this many travel inside the plan (some 100 bytes each); more are joined as a table.
MAX_INLINE = 10_000
# Fixed value: what a token is.
TOKEN = "[0-9A-Za-z_%-]+"


class Rule(NamedTuple):
    """``host/path`` and what becomes of the URLs below it. The host also stands for its subdomains, the path for what starts so."""

    pattern: str
    verdict: str


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://`` or for a null."""
    host = F.regexp_extract(url, r"\A(?s:.*?)://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or for a null."""
    return F.coalesce(F.regexp_extract(url, r"\A(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _regex(pattern: str) -> str:
    host, _, path = pattern.partition("/")
    return r"\A(?:[^/]*\.)?" + re.sub(r"([^0-9A-Za-z_])", r"\\\1", f"{host.lower()}/{path}")


def _tokens(pattern: str) -> list[str]:
    """Tokens that every URL of the rule has whole: the path may go on after the last one, unless it ends at a mark."""
    host, _, path = pattern.partition("/")
    found = re.findall(TOKEN, host.lower())
    inner = re.findall(TOKEN, path)
    return found + (inner if path and not re.match(TOKEN, path[-1]) else inner[:-1])


def _url_tokens(subject: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(subject, F.lit(f"({TOKEN})"), 0))


def _subject(url: Column) -> Column:
    return F.concat(host_of(url), path_of(url))


def token_counts(urls: Column, df: DataFrame, tokens: list[str]) -> dict[str, int]:
    """In how many of all rows each of the rules' tokens is found: at most one row for each token comes to the driver."""
    wanted = F.array(*map(F.lit, sorted(set(tokens))))
    found = df.select(F.explode(F.array_intersect(_url_tokens(_subject(urls)), wanted)).alias("token"))
    return {r["token"]: r["count"] for r in found.groupBy("token").count().collect()}


def judge_urls(df: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow", max_inline: int = MAX_INLINE) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` and ``verdict``, replacing columns so named.

    Of the rules that fit the longest wins; of equally long ones that which blocks,
    then the smaller text. Without a fitting rule ``rule`` is null and ``verdict`` the
    default. A null URL, or one without ``://``, has an empty host and path and fits none.
    Rules without a token of their own, such as one of dots alone, are tried on every URL.
    Equal rows get equal results and an empty table gives an empty one.
    """
    rules = list(dict.fromkeys(rules))
    for rule in rules:
        if "/" not in rule.pattern or rule.verdict not in ("allow", "block"):
            raise ValueError(f"not a rule: {rule}")
    named = {rule: _tokens(rule.pattern) for rule in rules}
    known = [t for own in named.values() for t in own]
    counts = token_counts(F.col(quoted(url)), df, known) if known and len(rules) <= max_inline else {}
    index: dict[str, list[Rule]] = {}
    for rule, own in named.items():
        rarest = min(own, key=lambda t: (counts.get(t, 0), -len(t), t)) if own else ""
        index.setdefault(rarest, []).append(rule)
    link = F.col("row").getField(url)
    parts = packed(df).select("row", host_of(link).alias("h"), path_of(link).alias("p"))
    parts = parts.withColumn("subject", F.concat("h", "p"))
    best = _inline(parts, index) if len(rules) <= max_inline else _joined(parts, index)
    verdict = F.coalesce(F.col("best.verdict"), F.lit(default))
    return unpacked(best, host=F.col("h"), path=F.col("p"), rule=F.col("best.pattern"), verdict=verdict)


def _rank(rule: Rule) -> tuple[int, int, str, str, str]:
    """The greatest wins; negated code points turn text order around."""
    return (len(rule.pattern), int(rule.verdict == "block"), rule.pattern, rule.verdict, _regex(rule.pattern))


_RULE = "struct<len:int,blocks:int,pattern:string,verdict:string,regex:string>"


def _literal(rule: Rule) -> Column:
    values = zip(("len", "blocks", "pattern", "verdict", "regex"), _rank(rule), strict=True)
    return F.struct(*[F.lit(v).alias(k) for k, v in values])


def _best(found: Column, subject: Column) -> Column:
    fitting = F.filter(found, lambda r: F.regexp_like(subject, r["regex"]))
    ordered = F.array_sort(
        fitting,
        lambda a, b: F.when(a["len"] != b["len"], b["len"] - a["len"])
        .when(a["blocks"] != b["blocks"], b["blocks"] - a["blocks"])
        .when(a["pattern"] < b["pattern"], -1)
        .when(a["pattern"] > b["pattern"], 1)
        .otherwise(0),
    )
    return F.get(ordered, F.lit(0))


def _inline(parts: DataFrame, index: dict[str, list[Rule]]) -> DataFrame:
    """The index as a literal map: no shuffle."""
    none = F.array().cast(f"array<{_RULE}>")
    entries = [x for token, own in index.items() for x in (F.lit(token), F.array(*map(_literal, own)))]
    table = F.create_map(*entries) if entries else F.create_map().cast(f"map<string,array<{_RULE}>>")
    tokens = F.concat(_url_tokens(F.col("subject")), F.array(F.lit("")))
    found = F.flatten(F.transform(tokens, lambda t: F.coalesce(F.element_at(table, t), none)))
    return parts.withColumn("found", found).withColumn("best", _best(F.col("found"), F.col("subject")))


def _joined(parts: DataFrame, index: dict[str, list[Rule]]) -> DataFrame:
    """The index as a table: distinct subjects meet it by token, and the winners go back to the rows."""
    spark = parts.sparkSession
    rows = [(token, *_rank(rule)) for token, own in index.items() for rule in own]
    table = spark.createDataFrame(rows, "token string, len int, blocks int, pattern string, verdict string, regex string")
    subjects = parts.select("subject").distinct()
    tokens = subjects.select("subject", F.explode(F.concat(_url_tokens(F.col("subject")), F.array(F.lit("")))).alias("token"))
    fitting = tokens.join(table, "token").where(F.regexp_like("subject", F.col("regex")))
    rule = F.struct("len", "blocks", "pattern", "verdict", "regex")
    best = fitting.groupBy("subject").agg(
        F.min_by(rule, F.struct(-F.col("len"), -F.col("blocks"), F.col("pattern"))).alias("best")
    )
    return parts.join(best, "subject", "left")
