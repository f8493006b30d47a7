"""Operator 4: URL rules in a sorted array of digests, probed by vectorised binary search.

A rule is a host and the beginning of a path; it fits its host and all subdomains, and the
longest rule that fits wins. A URL has few strings that could be a rule: each run of last labels
of its host, followed by each beginning of its path that is as long as some rule's path. Their
64-bit xxHash digests are looked up, all of a batch at once, in the sorted digests of the rules,
and a hit counts only if the stored rule is that very string, so collisions do no harm.

The index is two files: digests in order, and the rules they belong to. Spark hands the files to
each executor once (``addFile``); its Python workers map them into memory and share the pages.
Rules that would make an index of more than ``MOST_INDEX_BYTES`` are joined to the strings of the
distinct URLs instead: the same result by a shuffle, whatever the number of rules.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import ASCII_LOWER, ASCII_UPPER, ascii_lower, named, saved, table

# The rules of the registered query (verdict, host, beginning of the path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: The verdict where no rule fits.
OTHERWISE = "allow"
MOST_INDEX_BYTES = 256 << 20

_LOWER = str.maketrans(ASCII_UPPER, ASCII_LOWER)
_HOST, _PATH = re.compile(r"[^/?#]*"), re.compile(r"[^?#]*")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null and where there is no ://."""
    before, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = _HOST.match(rest)
    return host[0].translate(_LOWER), _PATH.match(rest, host.end())[0]


def candidates(host: str, path: str, lengths: list[int]) -> Iterator[str]:
    """The strings that a fitting rule can be, longest first (of equal ones the longer host)."""
    hosts, at = [], 0
    while host:
        hosts.append(host[at:])
        at = host.find(".", at) + 1
        if not at:
            break
    whole = [n for n in lengths if n <= len(path)]
    pairs = sorted(((len(h) + n, len(h), h, n) for h in hosts for n in whole), reverse=True)
    for _, _, tail, n in pairs:
        yield tail + path[:n]


def digest(strings: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(x) for x in strings], dtype=np.uint64)


class DigestArray:
    """Sorted digests with the strings they stand for, mapped from two files."""

    @staticmethod
    def write(folder: str, rules: list[tuple[str, str]]) -> tuple[str, str]:
        """Write the files for (string, verdict) rules; their names tell their content."""
        digests = digest([rule for rule, _ in rules])
        order = np.argsort(digests, kind="stable")
        stored = [json.dumps(rules[place]).encode() + b"\n" for place in order]
        ends = np.cumsum([len(x) for x in stored], dtype=np.uint64)
        body = b"".join(stored)
        name = f"url-rules-{hashlib.sha256(body).hexdigest()[:24]}"
        paths = os.path.join(folder, f"{name}.keys"), os.path.join(folder, f"{name}.rules")
        np.stack([digests[order], ends]).tofile(paths[0])
        with open(paths[1], "wb") as file:
            file.write(body)
        return paths

    def __init__(self, keys: str, rules: str) -> None:
        self.keys, self.ends = np.memmap(keys, dtype=np.uint64, mode="r").reshape(2, -1)
        self.rules = np.memmap(rules, dtype=np.uint8, mode="r")

    def stored(self, place: int) -> tuple[str, str]:
        start = int(self.ends[place - 1]) if place else 0
        return tuple(json.loads(self.rules[start : int(self.ends[place])].tobytes()))

    def find(self, strings: list[str]) -> list[tuple[str, str] | None]:
        """For each string its rule, if it is one."""
        digests = digest(strings)
        found: list[tuple[str, str] | None] = [None] * len(strings)
        first = np.searchsorted(self.keys, digests)
        inside = first < len(self.keys)
        hits = inside & (self.keys[np.where(inside, first, 0)] == digests)
        for at in np.flatnonzero(hits):
            place = int(first[at])
            while place < len(self.keys) and self.keys[place] == digests[at]:
                rule = self.stored(place)
                if rule[0] == strings[at]:
                    found[at] = rule
                    break
                place += 1
        return found


_sent: set[tuple[str, ...]] = set()  # applications and the names of files they have


@lru_cache(4)
def _opened(keys: str, rules: str) -> DigestArray:
    return DigestArray(SparkFiles.get(keys), SparkFiles.get(rules))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    otherwise: str = OTHERWISE,
    most_index_bytes: int = MOST_INDEX_BYTES,
) -> DataFrame:
    """Every column of ``pages`` with host, path, rule (null if none fits) and verdict of ``url``.

    ``rules`` has (host, path, verdict), hosts in lower case; equal rules count once, of
    contradicting ones the greater verdict. Rules with a null or an empty host are no rules. A
    null url or one without :// has empty host and path, and no rule. Repeated rows stay, and
    columns of these four names in ``pages`` are replaced.
    """
    pages = pages.drop("host", "path", "rule", "verdict")
    rules = rules.where("host <> '' and path is not null and verdict is not null")
    rules = rules.select(
        F.concat("host", "path").alias("rule"), F.length("path").alias("n"), "host", "verdict"
    )
    # host + path of two rules may spell alike; where the host ends tells them apart.
    rules = rules.groupBy("rule", "n").agg(F.max("verdict").alias("verdict"))
    size = rules.agg(
        F.coalesce(F.sum(F.octet_length("rule") + F.octet_length("verdict") + 64), F.lit(0))
    ).first()[0]
    # Lengths of paths: few, as URLs are short.
    lengths = sorted(row["n"] for row in rules.select("n").distinct().collect())
    if size > most_index_bytes:
        return _judge_by_join(pages, rules, lengths, otherwise)
    return _judge_by_index(pages, rules, lengths, otherwise)


def _judge_by_index(
    pages: DataFrame, rules: DataFrame, lengths: list[int], otherwise: str
) -> DataFrame:
    context = pages.sparkSession.sparkContext
    stored = [(row["rule"], row["verdict"]) for row in rules.collect()]  # of a checked size
    paths = DigestArray.write(tempfile.mkdtemp(prefix="url-rules-"), stored)
    names = [os.path.basename(path) for path in paths]
    if (context.applicationId, *names) not in _sent:
        for path in paths:
            context.addFile(path)
        _sent.add((context.applicationId, *names))

    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = _opened(*names) if stored else None
        for urls in batches:
            split = [split_url(url) for url in urls]
            strings, owners = [], []
            for owner, (host, path) in enumerate(split) if stored else ():
                for string in candidates(host, path, lengths):
                    strings.append(string)
                    owners.append(owner)
            best: dict[int, tuple[str, str]] = {}
            for owner, rule in zip(owners, index.find(strings) if strings else ()):
                if rule is not None:
                    best.setdefault(owner, rule)  # longest first
            chosen = [best.get(place, (None, otherwise)) for place in range(len(split))]
            yield pd.DataFrame(
                {
                    "host": [host for host, _ in split],
                    "path": [path for _, path in split],
                    "rule": [rule for rule, _ in chosen],
                    "verdict": [verdict for _, verdict in chosen],
                },
                dtype=object,
            )

    judge = F.pandas_udf(judged, "host string, path string, rule string, verdict string")
    return pages.withColumn("_judged", judge("url")).select(
        *named(pages), "_judged.*"
    )


def _judge_by_join(
    pages: DataFrame, rules: DataFrame, lengths: list[int], otherwise: str
) -> DataFrame:
    """The same by an equi-join of the distinct URLs' strings with the rules."""
    host, path = _host_and_path(F.col("url"))
    urls = saved(
        pages.select("url").where("url is not null").distinct().withColumns(
            {"host": host, "path": path}
        ),
        "urls-distinct",
    )
    labels = F.split("host", r"\.")
    tails = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda at: F.array_join(F.slice(labels, at, F.size(labels)), "."),
    )
    strings = (
        urls.where("host <> ''")
        .withColumn("tail", F.explode(tails))
        .where("tail <> ''")
        .withColumn("m", F.explode(F.array(*map(F.lit, lengths))))
        .where(F.col("m") <= F.length("path"))
        .select(
            "url",
            F.length("tail").alias("tail_length"),
            "m",
            F.concat("tail", F.expr("substring(path, 1, m)")).alias("string"),
        )
    )
    hits = strings.join(rules, (F.col("string") == F.col("rule")) & (F.col("m") == F.col("n")))
    best = hits.groupBy("url").agg(
        F.max(F.struct(F.length("rule").alias("length"), "tail_length", "rule", "verdict")).alias("best")
    )
    best = saved(best.select(F.col("url").alias("of"), "best.rule", "best.verdict"), "urls-judged")
    joined = pages.withColumns({"host": host, "path": path}).join(
        best, F.col("url") == F.col("of"), "left"
    )
    return joined.select(
        *named(pages),
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.lit(otherwise)).alias("verdict"),
    )


def _host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return ascii_lower(host), path


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    rules = spark.createDataFrame(
        [(host, path, verdict) for verdict, host, path in RULES],
        "host string, path string, verdict string",
    )
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


_VALUES = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in RULES)

OP4_SQL = f"""
with numbered as (
    select row_number() over () as place, page_id, coalesce(url, '') as url from pages
), rests as (
    select place, page_id,
        case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
    from numbered
), hosts as (
    select place, page_id, regexp_extract(rest, '^[^/?#]*') as raw, rest from rests
), parts as (
    select place, page_id, translate(raw, '{ASCII_UPPER}', '{ASCII_LOWER}') as host,
        regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path
    from hosts
), rules(verdict, rule_host, rule_path) as (
    values {_VALUES}
), fitting as (
    select place, rule_host || rule_path as rule, verdict,
        row_number() over (
            partition by place
            order by length(rule_host || rule_path) desc, length(rule_host) desc
        ) as rank
    from parts join rules
        on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
)
select page_id, host, path, rule, coalesce(verdict, '{OTHERWISE}') as verdict
from parts left join (select * from fitting where rank = 1) using (place)
"""
