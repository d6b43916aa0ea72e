"""URL filters: rules indexed by their rarest literal token, in DataFrame operations only.

A rule ``host/path`` fits a URL whose host is the rule's host or a subdomain of it and whose path
starts with the rule's path; the longest fitting rule wins.  Every rule is filed under one of its
whole literal tokens, the one that the fewest URLs contain, so most URLs fetch no rule at all and
only the fetched rules run their regular expression.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Up to here the index is a literal in the plan; a longer rule list is joined.
INLINE_RULES = 2000


@dataclass(frozen=True)
class Rule:
    """``text`` is ``host/path``; ``verdict`` is "allow" or "block"."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0].lower()

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2] if "/" in self.text else ""

    @property
    def pattern(self) -> str:
        """Matches ``host + path`` of a URL, as one string without scheme."""
        return rf"^(?:[^/]*\.)?{re.escape(self.host)}{re.escape(self.path) if self.path else '(?:/|$)'}"

    @property
    def tokens(self) -> list[str]:
        """Whole literal tokens: host labels, and path segments that end in a slash."""
        segments = self.path.split("/")[1:-1] if self.path else []
        return [f"h:{x}" for x in self.host.split(".") if x] + [f"p:{x}" for x in segments if x]


#: Fixed values of the query's contract.
RULES = (
    Rule("org/", "allow"),
    Rule("example.org/es/", "block"),
    Rule("example.org/en/1", "block"),
    Rule("com/fr/", "allow"),
    Rule("com/de/", "block"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(host: Column, path: Column) -> Column:
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    segments = F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.concat(labels, segments))


def token_index(parsed: DataFrame, rules: tuple[Rule, ...]) -> dict[str, list[int]]:
    """Token -> rule numbers, each rule under its token that the fewest URLs contain.

    One counting pass whose result has at most a row per rule token; ties take the longer token,
    then the first in order.
    """
    literal = sorted({t for r in rules for t in r.tokens})
    seen = (
        parsed.select(F.explode(url_tokens(F.col("__host"), F.col("__path"))).alias("token"))
        .where(F.col("token").isin(literal))
        .groupBy("token")
        .count()
    )
    count = {r["token"]: r["count"] for r in seen.collect()}
    index: dict[str, list[int]] = {}
    for k, rule in enumerate(rules):
        if not rule.tokens:
            raise ValueError(f"rule without a literal token: {rule.text!r}")
        rarest = min(rule.tokens, key=lambda t: (count.get(t, 0), -len(t), t))
        index.setdefault(rarest, []).append(k)
    return index


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Judge every row: (id, host, path, rule, verdict, candidates).

    A null URL or one without ``://`` has an empty host and path, fits no rule and gets
    ``default``.  Repeated rows are judged alike, columns besides id and URL are ignored, and an
    empty table gives an empty result.  ``candidates`` counts the rules whose expression ran.
    Among equally long rules the first in the list wins.
    """
    url = F.col(url_col)
    parsed = pages.select(F.col(id_col), url.alias("__url"), host_of(url).alias("__host"), path_of(url).alias("__path"))
    if len(rules) > INLINE_RULES:
        return _joined(parsed, rules, default, id_col)
    index = token_index(parsed, rules) if rules else {}
    entries = [x for t, ks in index.items() for x in (F.lit(t), F.array(*[F.lit(k) for k in ks]))]
    table = F.create_map(*entries) if entries else F.lit(None).cast("map<string,array<int>>")
    none = F.array().cast("array<int>")
    fetched = F.flatten(F.transform(url_tokens(F.col("__host"), F.col("__path")), lambda t: F.coalesce(F.try_element_at(table, t), none)))
    order = sorted(range(len(rules)), key=lambda k: (-len(rules[k].text), k))
    subject = F.concat("__host", "__path")
    hit = F.lit(None).cast("int")
    for k in reversed(order):
        # The expression runs only for rules that the tokens fetched: CASE is lazy.
        hit = F.when(F.array_contains("__fetched", k), F.when(subject.rlike(rules[k].pattern), F.lit(k)).otherwise(hit)).otherwise(hit)
    if len(rules) > 64:  # nested CASE would be too deep: filter the fetched rules instead
        patterns, rank = F.array(*[F.lit(r.pattern) for r in rules]), F.array(*[F.lit(order.index(k)) for k in range(len(rules))])
        fits = F.filter("__fetched", lambda k: F.rlike(subject, F.element_at(patterns, k + 1)))
        best = F.array_min(F.transform(fits, lambda k: F.element_at(rank, k + 1)))
        hit = F.try_element_at(F.array(*[F.lit(k) for k in order]), best + 1)
    texts = F.array(*[F.lit(r.text) for r in rules]) if rules else F.array().cast("array<string>")
    verdicts = F.array(*[F.lit(r.verdict) for r in rules]) if rules else F.array().cast("array<string>")
    judged = parsed.withColumn("__fetched", F.array_distinct(fetched)).withColumn("__hit", hit)
    return judged.select(
        id_col,
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.when(F.col("__hit").isNotNull(), F.try_element_at(texts, F.col("__hit") + 1)).alias("rule"),
        F.when(F.col("__hit").isNotNull(), F.try_element_at(verdicts, F.col("__hit") + 1)).otherwise(F.lit(default)).alias("verdict"),
        F.size("__fetched").alias("candidates"),
    )


def _joined(parsed: DataFrame, rules: tuple[Rule, ...], default: str, id_col: str) -> DataFrame:
    """The same for rule lists too long for a literal: distinct URLs fetch rules by a join.

    Spark broadcasts the index only below its own size threshold.
    """
    spark = parsed.sparkSession
    index = token_index(parsed, rules)
    rows = [(t, k, rules[k].text, rules[k].verdict, rules[k].pattern, -len(rules[k].text)) for t, ks in index.items() for k in ks]
    filed = spark.createDataFrame(rows, "token string, __k int, rule string, verdict string, __pattern string, __len int")
    sites = parsed.select("__host", "__path").distinct()
    tokens = sites.withColumn("token", F.explode(url_tokens(F.col("__host"), F.col("__path"))))
    fetched = tokens.join(filed, "token")
    fits = F.rlike(F.concat("__host", "__path"), F.col("__pattern"))
    best = fetched.groupBy("__host", "__path").agg(
        F.min(F.when(fits, F.struct("__len", "__k", "rule", "verdict"))).alias("__best"), F.countDistinct("__k").alias("__n")
    )
    return parsed.join(best, ["__host", "__path"], "left").select(
        id_col,
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.col("__best.rule").alias("rule"),
        F.coalesce("__best.verdict", F.lit(default)).alias("verdict"),
        F.coalesce("__n", F.lit(0)).cast("int").alias("candidates"),
    )
