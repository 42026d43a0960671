"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression over a url's host, its path or the whole url (A-Z lower-cased). Its literal tokens, whole runs
of letters and digits that any matching url must have, are read off the expression. The corpus counts of these tokens choose
each rule's rarest; a url's own tokens fetch the rules filed under them, and only those run their expression. Rules
without a literal token are filed apart and always run.

Host rules (host, path, verdict) are filed the same way under a host token. A host rule fits its host and all its
subdomains if the path starts with the rule's path; the longest fitting rule wins and outweighs the pattern rules.
Among pattern rules allow outweighs block; a url that none fits is allowed.

The rules are parameters (`read_patterns` takes them from a table); up to MAX_RULES are broadcast once, and a worker makes one
index of them, whose expressions are compiled when they are first fetched. More rules are refused, since such lists belong into a
table that is joined by host.

Defined results: a null url or one without `://` has an empty host and path, fits no host rule and is allowed unless a
pattern over whole urls blocks it; repeated rows are judged alike; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from re import _constants as _ops  # the parsed form of an expression
from re import _parser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import shared

MAX_RULES = 200_000
_TOKEN = re.compile(r"[a-z0-9]+")
_HOST = re.compile(r"://([^/?#]*)([^?#]*)")
_UPPER = {c: c + 32 for c in range(65, 91)}


def _alnum(item: tuple) -> bool | None:
    """Whether an item of a set is letters and digits only (True), none of them (False), or neither is sure."""
    op, value = item
    if op is _ops.LITERAL:
        return bool(_TOKEN.fullmatch(chr(value)))
    if op is _ops.RANGE and value in ((97, 122), (48, 57)):
        return True
    return None


def literal_tokens(expr: str) -> tuple[str, ...]:
    """The runs of a-z and 0-9 that stand as whole tokens in every text that expr matches.

    A run counts if both its ends are sure: a literal that is neither letter nor digit, an end of the text, or a look-around that
    forbids letters and digits. Whatever may be absent or vary (repeats, branches, groups, sets) ends a run without being sure.
    """
    found, run, sure = [], "", False

    def end(by: bool) -> None:
        nonlocal run, sure
        if run and sure and by:
            found.append(run)
        run, sure = "", by

    parsed = _parser.parse(expr)
    folds = parsed.state.flags & re.IGNORECASE and not parsed.state.flags & re.ASCII
    for op, value in parsed:
        if op is _ops.LITERAL and folds and chr(value) in "iks":
            end(False)  # these have capitals or small forms that are no ASCII
        elif op is _ops.LITERAL:
            if _TOKEN.fullmatch(chr(value)):
                run += chr(value)
            else:
                end(not chr(value).isupper())  # texts have no upper case A-Z
        elif op is _ops.AT:
            end(value in (_ops.AT_BEGINNING_STRING, _ops.AT_END_STRING))
        elif op is _ops.ASSERT_NOT and [x[0] for x in value[1]] == [_ops.IN] and {(97, 122), (48, 57)} <= {x[1] for x in value[1][0][1] if _alnum(x)}:
            if value[0] < 0 and run:
                end(False)
            end(True) if value[0] < 0 or run else None
            sure = value[0] < 0  # what follows a look-ahead is not bounded by it
        elif op is _ops.IN and all(_alnum(x) is False for x in value):
            end(True)
        else:
            end(False)
    end(False)
    return tuple(dict.fromkeys(found))


@dataclass(frozen=True)
class Pattern:
    """verdict for urls whose part (host, path or url; A-Z lower-cased) expr is found in."""

    expr: str
    verdict: str = "block"
    part: str = "url"

    @property
    def tokens(self) -> tuple[str, ...]:
        return literal_tokens(self.expr)


def read_patterns(table: DataFrame) -> tuple[Pattern, ...]:
    """The rules of a table (expr, verdict, part); at most MAX_RULES."""
    rows = table.select("expr", "verdict", "part").limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    return tuple(Pattern(*r) for r in rows)


@dataclass(frozen=True)
class HostRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Words of spam, adult and gambling hosts, and ends of paths that hold no text.
HOST_WORDS = ("casino", "porn", "xxx", "viagra", "poker", "betting", "escort", "cheap-pills", "free-bets", "free-money")
PATH_ENDS = (".exe", ".zip", ".iso", ".apk")
DEFAULT_PATTERNS = (
    *(Pattern(rf"(?<![a-z0-9]){re.escape(w)}(?![a-z0-9])", "block", "host") for w in HOST_WORDS),
    *(Pattern(rf"{re.escape(x)}\Z", "block", "path") for x in PATH_ENDS),
)
QUERY_HOST_RULES = (HostRule("net", "/", "block"), HostRule("example.net", "/en/", "allow"), HostRule("example.com", "/de/", "block"), HostRule("org", "/fr/", "allow"))


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url; both empty without `://`."""
    if not url or not (m := _HOST.search(url)):
        return "", ""
    return m[1].translate(_UPPER), m[2]


def tokens(url: str) -> set[str]:
    return set(_TOKEN.findall(url.translate(_UPPER)))


class RuleIndex:
    """Rules by their rarest token. counts: how often each token occurs in the urls."""

    def __init__(self, patterns: Iterable[Pattern], hosts: Iterable[HostRule], counts: dict[str, int]):
        self.filed: dict[str, list[Pattern]] = {}
        self.always: list[Pattern] = []
        self.hosts: dict[str, list[HostRule]] = {}
        rarest = lambda words: min(words, key=lambda w: (counts.get(w, 0), w))
        for p in patterns:
            known = p.tokens
            (self.filed.setdefault(rarest(known), []) if known else self.always).append(p)
        self.compiled: dict[str, re.Pattern[str]] = {}
        for h in hosts:
            words = _TOKEN.findall(h.host)
            self.hosts.setdefault(rarest(words) if words else "", []).append(h)
        self.tokens = {*self.filed, *self.hosts} - {""}

    def judge(self, url: str | None) -> tuple[str, str, str | None, str]:
        """host, path, rule, verdict."""
        host, path = split_url(url)
        found = self.tokens & tokens(url) if url else ()
        best: HostRule | None = None
        if host:
            for token in (*found, ""):
                for h in self.hosts.get(token, ()):
                    if path.startswith(h.path) and (host == h.host or host.endswith(f".{h.host}")) and (best is None or (len(h.name), h.name) > (len(best.name), best.name)):
                        best = h
        if best:
            return host, path, best.name, best.verdict
        parts = {"host": host, "path": path.translate(_UPPER), "url": url.translate(_UPPER) if url else ""}
        rules = (*(p for token in found for p in self.filed.get(token, ())), *self.always)
        verdicts = {p.verdict for p in rules if self._compiled(p.expr).search(parts[p.part])}
        return host, path, None, "block" if verdicts == {"block"} else "allow"

    def _compiled(self, expr: str) -> re.Pattern[str]:
        if (found := self.compiled.get(expr)) is None:
            found = self.compiled[expr] = re.compile(expr)
        return found


def token_counts(pages: DataFrame, wanted: set[str], url: str = "url") -> dict[str, int]:
    """How many urls hold each of the wanted tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for x in batch.column(0).to_pylist():
                if x:
                    total.update(wanted & tokens(x))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["token", "n"])

    rows = pages.select(url).mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()  # at most one row for each wanted token
    return {r.token: r.n for r in rows}


def judge_urls(pages: DataFrame, patterns: Iterable[Pattern] = DEFAULT_PATTERNS, hosts: Iterable[HostRule] = (), url: str = "url", key: str = "page_id") -> DataFrame:
    """key, host, path, rule and verdict of every row; one pass over the urls after one that counts the rules' tokens."""
    patterns, hosts = tuple(patterns), tuple(hosts)
    if len(patterns) + len(hosts) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    wanted = {t for p in patterns for t in p.tokens} | {t for h in hosts for t in _TOKEN.findall(h.host)}
    pages = pages.select(pages[key].alias("key"), pages[url].alias("url"))
    rules, name = pages.sparkSession.sparkContext.broadcast((patterns, hosts, token_counts(pages, wanted))), uuid.uuid4().hex

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared(("urls", name), lambda: RuleIndex(*rules.value))
        for batch in batches:
            cols = list(zip(*map(index.judge, batch.column(1).to_pylist()), strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.string()) for c in cols)], ["key", "host", "path", "rule", "verdict"])

    kind = pages.schema["key"].dataType.simpleString()
    return pages.mapInArrow(judge, f"key {kind}, host string, path string, rule string, verdict string").withColumnRenamed("key", key)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), hosts=QUERY_HOST_RULES)


ORACLE_SQL = {
    "op3_url_filter": r"""
        WITH p AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN regexp_extract(url, '://([^/?#]*)([^?#]*)', 1) ELSE '' END AS raw_host,
                   CASE WHEN contains(url, '://') THEN regexp_extract(url, '://([^/?#]*)([^?#]*)', 2) ELSE '' END AS path FROM pages),
        h AS (SELECT page_id, url, path, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM p),
        r AS (SELECT *, CASE WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
                             WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
                             WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
                             WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM h)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                    WHEN regexp_matches(host, '(?:^|[^a-z0-9])(?:casino|porn|xxx|viagra|poker|betting|escort|cheap-pills|free-bets|free-money)(?:[^a-z0-9]|$)') THEN 'block'
                    WHEN regexp_matches(translate(path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '\.(?:exe|zip|iso|apk)$') THEN 'block' ELSE 'allow' END AS verdict
        FROM r"""
}
