"""URL filters: rules indexed by their rarest literal token.

A rule is compiled to a regular expression over the URL's subject, ``host + path
+ query``, and to the literal tokens (runs of letters and digits, in lower case)
that any matching URL must contain as whole tokens.  Token frequencies are
counted over all URLs, but only for tokens that rules have, and each rule is
filed under the one that is rarest.  A URL fetches the rules filed under its own
tokens, and only those run their regular expressions; rules that have no whole
token run on every URL.

Two kinds of rules:

* host and path, like ``example.org/es/``: fits the host and all subdomains if the
  URL's path starts with the rule's.  The longest fitting rule decides.
* patterns for all other URLs: ``*`` stands for anything, ``^`` for a separator or
  the end, ``|`` at either end anchors, ``||`` anchors at a label of the host.  A
  fitting pattern blocks, otherwise the URL is allowed.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# Registered query's rules: (verdict, host/path).
PRODUCTION_RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
)
# What a URL without a rule is judged by.
PRODUCTION_PATTERNS = ("||cheap-pills.", "||spam-farm.", "||casino-win.", "/ads/*", "/track/*", "&click_id=*")

MAX_RULES = 1_000_000  # the index is sent to every executor; 10^6 rules take some hundred MB
_TOKEN = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    text: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    pattern: bool


def host_rule(text: str, verdict: str) -> Rule:
    """A rule ``host/path``; the last token of the path may go on in the URL, so only tokens before it are whole."""
    host, slash, path = text.partition("/")
    host = host.lower()
    whole = _TOKEN.findall(host) + [m.group().lower() for m in re.finditer(r"[A-Za-z0-9]+", path) if m.end() < len(path)]
    regex = rf"^(?:[^/?#]*\.)?{re.escape(host)}(?={'/' if slash else '[/?#]|$'}){re.escape(slash + path)}"
    return Rule(text, verdict, regex, tuple(whole), False)


def pattern_rule(text: str) -> Rule:
    """A blocking pattern, read in lower case."""
    body, low = text.lower(), text.lower()
    start = end = ""
    if body.startswith("||"):
        start, body = r"^(?:[^/?#]*\.)?", body[2:]
    elif body.startswith("|"):
        start, body = "^", body[1:]
    if body.endswith("|"):
        end, body = "$", body[:-1]
    parts = {"*": ".*", "^": r"(?:[^a-z0-9._%-]|$)"}
    regex = start + "".join(parts.get(ch) or re.escape(ch) for ch in body) + end
    whole = []
    for m in _TOKEN.finditer(body):
        left = body[m.start() - 1] if m.start() else ("|" if start else "*")
        right = body[m.end()] if m.end() < len(body) else ("|" if end else "*")
        if left != "*" and right != "*":  # else the token may go on in the URL
            whole.append(m.group())
    return Rule(low, "block", regex, tuple(whole), True)


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://`` or for null."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*(/[^?#]*)", 1)


def _subject(url: Column) -> Column:
    """Host, path and query."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^?#]*(\?[^#]*)", 1)
    return F.concat(host_of(url), path_of(url), query)


def token_counts(urls: DataFrame, url_col: str, tokens: Sequence[str]) -> dict[str, int]:
    """In how many URLs each token of the rules occurs; as many rows as the rules have tokens."""
    spark = urls.sparkSession
    wanted = spark.createDataFrame([(t,) for t in sorted(set(tokens))], "token string")
    found = F.array_distinct(F.split(F.lower(_subject(F.col(url_col))), "[^a-z0-9]+"))
    # `wanted` has at most the tokens of MAX_RULES rules, so it is sent to the URLs: no URL token is shuffled
    counts = urls.select(F.explode(found).alias("token")).join(F.broadcast(wanted), "token", "left_semi").groupBy("token").count()
    return {r["token"]: r["count"] for r in counts.collect()}


def build_index(rules: Sequence[Rule], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """Rule numbers under their rarest token (ties: the longest, then the first in order), and those without one."""
    index: dict[str, list[int]] = defaultdict(list)
    always = []
    for i, rule in enumerate(rules):
        if rule.tokens:
            index[min(rule.tokens, key=lambda t: (counts.get(t, 0), -len(t), t))].append(i)
        else:
            always.append(i)
    return dict(index), always


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = PRODUCTION_RULES,
               patterns: Sequence[str] = PRODUCTION_PATTERNS, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """A row per input row: id, ``host, path, rule, verdict, pattern, n_candidates``.

    ``rule`` is the longest host rule that fits, or null; ``verdict`` is its, else
    ``block`` if a pattern fits (``pattern`` then names the first in the list), else
    ``allow``.  A null URL, an empty one and one without ``://`` have an empty host
    and path, fit no rule and are allowed.  Rows are judged one by one: repeated
    rows get equal results and an empty table none; other columns are ignored.
    """
    compiled = [host_rule(text, verdict) for verdict, text in rules] + [pattern_rule(p) for p in patterns]
    if len(compiled) > MAX_RULES:
        raise ValueError(f"{len(compiled)} rules are more than the {MAX_RULES} that are sent to executors")
    counts = token_counts(pages, url_col, [t for r in compiled for t in r.tokens] or [""])
    index, always = build_index(compiled, counts)
    ready = pages.sparkSession.sparkContext.broadcast((compiled, index, always))

    @F.pandas_udf("rule string, verdict string, pattern string, n_candidates int")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        compiled, index, always = ready.value
        regexes: dict[int, re.Pattern] = {}
        for hosted, subjects in batches:
            out = []
            for plain, subject in zip(hosted, subjects):
                low = subject.lower()
                candidates = set(always)
                for token in set(_TOKEN.findall(low)):
                    candidates.update(index.get(token, ()))
                best = pattern = None
                for i in sorted(candidates) if plain else ():
                    rule = compiled[i]
                    if i not in regexes:
                        regexes[i] = re.compile(rule.regex, re.S)
                    if rule.pattern:
                        if pattern is None and regexes[i].search(low):
                            pattern = rule.text
                    elif (best is None or len(rule.text) > len(best.text)) and regexes[i].match(plain):
                        best = rule
                verdict = best.verdict if best else "block" if pattern else "allow"
                out.append((best.text if best else None, verdict, pattern, len(candidates)))
            yield pd.DataFrame(out, columns=["rule", "verdict", "pattern", "n_candidates"])

    url = F.col(url_col)
    judged = pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"), _subject(url).alias("_subject"))
    judged = judged.withColumn("_judged", judge(F.concat("host", "path"), "_subject"))
    return judged.select(id_col, "host", "path", "_judged.rule", "_judged.verdict", "_judged.pattern", "_judged.n_candidates")
