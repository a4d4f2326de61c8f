"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a pattern over what follows the first ``://`` of a URL, the host in
lower case: ``||`` at the start is the start of the host or of any of its
parents, ``*`` any text, ``^`` one separator (anything but a letter, a digit or
one of ``_-.%``) or the end, all else is literal. A URL's tokens are its runs of
ASCII letters and digits, A-Z lower-cased. A pattern's tokens are the runs of its
literal text that no letter, digit, ``*`` or pattern end touches, so that they
are whole tokens of every URL that the pattern fits.

1. One pass counts, over all URLs, in how many each token of the rules stands.
2. Every rule is filed under the rarest of its tokens (ties to the longer, then
   the smaller token); one without any is tried on every URL.
3. Each URL looks its tokens up, and only the rules that it fetches run as
   regular expressions.

Two kinds of rules: host rules, written ``host/path`` (a host with its subdomains and
a prefix of the path), of which the longest that fits decides, ties to the
longer host, then the smaller text; and, for URLs that no host rule fits, general patterns, of which an allowing one outweighs
blocking ones. A URL that no rule fits is allowed. The rules are the caller's
list, so what goes to the tasks is bounded by it; URLs are not shuffled.

Defined cases: a null URL and one without ``://`` have an empty host and path,
no rule, and are allowed; an empty table gives no rows; rows stay as often as
they are repeated; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantspark.llm.common import read

BLOCK, ALLOW = "block", "allow"
TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    text: str
    action: str
    by_host: bool = False  # ``text`` is host/path

    @property
    def pattern(self) -> str:
        return f"||{self.text}" if self.by_host else self.text

    @property
    def regex(self) -> str:
        """Of the target, anchored at its start by ``match``. Also fine for RE2."""
        body = self.pattern[2:] if self.pattern.startswith("||") else self.pattern
        start = r"\A(?:[^/?#]*\.)?" if self.pattern.startswith("||") else r"\A[\s\S]*?"
        special = {"*": r"[\s\S]*?", "^": r"(?:[^A-Za-z0-9_.%\-]|\z)"}
        if self.by_host:
            special = {}
        return start + "".join(special.get(c, re.escape(c)) for c in body)

    @property
    def tokens(self) -> list[str]:
        """Runs of the pattern that stand as whole tokens in all it fits."""
        anchored = self.pattern.startswith("||")
        body = self.pattern[2:] if anchored else self.pattern
        wild = "" if self.by_host else "*"
        out = []
        for m in re.finditer("[A-Za-z0-9]+", body):
            left = body[m.start() - 1] not in wild if m.start() else anchored
            right = m.end() < len(body) and body[m.end()] not in wild
            if left and right:
                out.append(m[0].lower())
        return out


HOST_RULES = (
    Rule("net/", BLOCK, True), Rule("example.net/en/", ALLOW, True), Rule("example.com/de/", BLOCK, True), Rule("org/fr/", ALLOW, True),
)
# Pages that carry no prose of their own, whatever their host.
PATTERN_RULES = (
    Rule("||ads.", BLOCK), Rule("||adserver.", BLOCK), Rule("||tracker.", BLOCK), Rule("/ads/", BLOCK), Rule("/banner/*.gif^", BLOCK),
    Rule("/wp-login.php^", BLOCK), Rule("/wp-admin/", BLOCK), Rule("/cart/checkout^", BLOCK), Rule("/account/login^", BLOCK),
    Rule("?sessionid=", BLOCK), Rule("&sessionid=", BLOCK), Rule("/search?q=", BLOCK), Rule("/calendar/*/day/", BLOCK),
    Rule("/robots.txt^", BLOCK), Rule("/sitemap.xml^", BLOCK), Rule("/about/ads/policy^", ALLOW),
)
RULES = HOST_RULES + PATTERN_RULES


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.lit(2**31 - 1)))


def parts_of(url: str | Column) -> tuple[Column, Column, Column]:
    """(host, path, target) of a URL; the target is host, path and all after them."""
    rest = _after_scheme(F.col(url) if isinstance(url, str) else url)
    host_raw = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    host = F.translate(host_raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    after = F.substring(rest, F.length(host_raw) + 1, F.lit(2**31 - 1))
    path = F.regexp_extract(after, r"\A[^?#]*", 0)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit("")), F.concat(host, after)


def _tokens(target: str) -> Column:
    lower = F.translate(target, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(F.regexp_extract_all(lower, F.lit(f"({TOKEN})"), F.lit(1)))


def token_counts(targets: DataFrame, rules: Sequence[Rule]) -> dict[str, int]:
    """In how many of the targets each token of the rules stands."""
    spark = targets.sparkSession
    names = sorted({t for r in rules for t in r.tokens})
    if not names:
        return {}
    wanted = F.broadcast(spark.createDataFrame([(t,) for t in names], "token string"))
    found = (targets.select(F.explode(_tokens("target")).alias("token")).join(wanted, "token", "left_semi")
             .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    return {t: 0 for t in names} | {r.token: r.n for r in found.collect()}  # one row per token of the rules


def index(rules: Sequence[Rule], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """Rule numbers by the rarest token, and those without one."""
    filed: dict[str, list[int]] = {}
    bare = []
    for i, rule in enumerate(rules):
        tokens = rule.tokens
        if tokens:
            filed.setdefault(min(tokens, key=lambda t: (counts.get(t, 0), -len(t), t)), []).append(i)
        else:
            bare.append(i)
    return filed, bare


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "page_id", url: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, pattern, tried): the host rule that
    decides, the general pattern that does where there is none, and the number
    of regular expressions that ran."""
    host, path, target = parts_of(url)
    targets = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), target.alias("target"))
    filed, bare = index(rules, token_counts(targets, rules))
    # the order in which fitting rules decide
    order = sorted(range(len(rules)), key=lambda i: (
        not rules[i].by_host, -len(rules[i].text) if rules[i].by_host else 0, -len(rules[i].text.split("/")[0]) if rules[i].by_host else 0,
        rules[i].action != ALLOW if not rules[i].by_host else False, rules[i].text, rules[i].action))
    place = {rule: i for i, rule in enumerate(order)}
    filed = {t: [place[i] for i in at] for t, at in filed.items()}
    bare = [place[i] for i in bare]
    rules = [rules[i] for i in order]
    token = re.compile(TOKEN)
    # Python writes the end of a text as \Z
    tests = [re.compile(r.regex.replace(r"\z", r"\Z")).match for r in rules]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def run(batches):
        for batch in batches:
            rule, verdict, pattern, tried = [], [], [], []
            for text in batch.column(3).to_pylist():
                best, runs = None, 0
                if text is not None:
                    todo = set(bare)
                    for t in set(token.findall(text.translate(lower))):
                        todo.update(filed.get(t, ()))
                    for i in sorted(todo):
                        runs += 1
                        if tests[i](text):
                            best = rules[i]
                            break
                rule.append(best.text if best and best.by_host else None)
                pattern.append(best.text if best and not best.by_host else None)
                verdict.append(best.action if best else ALLOW)
                tried.append(runs)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(rule, pa.string()), pa.array(verdict, pa.string()),
                                              pa.array(pattern, pa.string()), pa.array(tried, pa.int32())],
                                             names=["id", "host", "path", "rule", "verdict", "pattern", "tried"])

    kind = dict(targets.dtypes)["id"]
    return targets.mapInArrow(run, f"id {kind}, host string, path string, rule string, verdict string, pattern string, tried int")


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(read(spark, sf_dir, "pages"))
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "pattern")


def _oracle(rules: Sequence[Rule] = RULES) -> str:
    """DuckDB: every rule's test on every URL, without an index."""
    def quoted(text):
        return "'" + text.replace("'", "''") + "'"

    hosts = sorted((r for r in rules if r.by_host), key=lambda r: (-len(r.text), -len(r.text.split("/")[0]), r.text))

    def fits(r):
        host, path = r.text.split("/", 1)
        return f"((host = {quoted(host)} OR ends_with(host, {quoted('.' + host)})) AND starts_with(path, {quoted('/' + path)}))"

    general = sorted((r for r in rules if not r.by_host), key=lambda r: (r.action != ALLOW, r.text))
    tests = [f"regexp_matches(target, {quoted(r.regex)})" for r in general]
    upper = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return f"""
        WITH rests AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
        cut AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rests),
        split AS (SELECT page_id, coalesce(translate(raw, {upper}), '') AS host,
            coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') AS path,
            translate(raw, {upper}) || substr(rest, length(raw) + 1) AS target FROM cut),
        ruled AS (SELECT *, CASE {" ".join(f"WHEN {fits(r)} THEN {quoted(r.text)}" for r in hosts)} END AS rule FROM split),
        judged AS (SELECT *, CASE WHEN rule IS NULL THEN CASE {" ".join(f"WHEN {t} THEN {quoted(r.text)}" for r, t in zip(general, tests))} END END AS pattern FROM ruled)
        SELECT page_id, host, path, rule, pattern, CASE coalesce(rule, pattern)
            {" ".join(f"WHEN {quoted(r.text)} THEN {quoted(r.action)}" for r in rules)} ELSE 'allow' END AS verdict FROM judged"""


ORACLE = _oracle()
