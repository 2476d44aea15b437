from __future__ import annotations

import random

from panelprep.llm import url_filters as u

SCHEMA = "page_id long, url string, host string, verdict string"


def plain(url, rules, blocked):
    """The contract read literally; ``blocked`` decides without a rule."""
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    best = None
    for verdict, rule in rules:
        rule_host, slash, rule_path = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + rule_path):
            if best is None or len(rule) > len(best[1]):
                best = (verdict, rule)
    return host, path, best and best[1], best[0] if best else "block" if blocked(host, path) else "allow"


URLS = [
    None, "", "no scheme", "http://", "https://A.Example.ORG/en/12", "http://example.org/en/1", "http://example.org/en/2", "http://notexample.org/en/1",
    "http://x.example.org/es/", "http://x.example.org/es", "http://a.com/fr/1?x=://b.org/de/", "http://com/de/x", "http://a.com?q=/de/", "http://a.org#/x",
    "x://y://z.org/", "http://org", "http://a.org/", "http://www.cheap-pills.net/a", "http://cheap-pillsx.net/", "http://xcheap-pills.net/", "http://Spam-Farm.fr/x",
    "http://a.net/ads/1", "http://a.net/ads", "http://a.net/x?y=1&click_id=3", "http://É.org/ü", "http://a.org:80/x", "http://u@b.com/fr/", "http://b.com/fr/\nx",
] * 2


def blocked(host, path):
    spam = any(f".{host}".startswith(f".{d}") or f".{d}" in host for d in ("cheap-pills.", "spam-farm.", "casino-win."))
    return spam or "/ads/" in path or "/track/" in path


def test_equals_plain_reading(spark):
    df = spark.createDataFrame([(i, x, "clash", None) for i, x in enumerate(URLS)], SCHEMA)
    got = {r["page_id"]: r for r in u.judge_urls(df).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        want = plain(url, u.PRODUCTION_RULES, lambda h, p, url=url: blocked(h, p) or "&click_id=" in url)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == want, url


def test_only_candidates_run_and_whole_tokens_count():
    rules = [u.host_rule("example.org/en/1", "block"), u.pattern_rule("||foo*bar^"), u.pattern_rule("*x*")]
    assert rules[0].tokens == ("example", "org", "en")  # 1 may go on: /en/12
    assert rules[1].tokens == () and rules[2].tokens == ()
    index, always = u.build_index(rules, {"example": 5, "org": 9, "en": 2})
    assert index == {"en": [0]} and always == [1, 2]


def test_many_rules_and_long_urls(spark):
    """Thousands of rules: verdicts equal those of trying every rule, and few rules run per URL."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 4)))
    hosts = [f"{word()}.{word()}.{rng.choice(['com', 'org', 'net'])}" for _ in range(400)]
    rules = list({f"{rng.choice(hosts)}/{'/'.join(word() for _ in range(rng.randint(0, 3)))}{rng.choice(['', '/'])}": None for _ in range(4000)})
    rules = [(rng.choice(["allow", "block"]), r) for r in rules]
    urls = [f"https://{rng.choice(['', 'www.', word() + '.'])}{r.split('/', 1)[0]}/{r.split('/', 1)[1]}{rng.choice(['', '/x', 'y', '?q=1', '#z'])}" for _, r in rng.sample(rules, 300)]
    urls += [f"http://{rng.choice(hosts)}/{word()}/{word()}" for _ in range(100)] + ["http://a.org/" + "b/" * 100_000, "x" * 200_000]
    got = {r["page_id"]: r for r in u.judge_urls(spark.createDataFrame([(i, x, "", "") for i, x in enumerate(urls)], SCHEMA), rules, ()).collect()}
    for i, url in enumerate(urls):
        want = plain(url, rules, lambda h, p: False)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == want, url[:100]
    assert sum(r["n_candidates"] for r in got.values()) / len(got) < len(rules) / 20


def test_empty_table(spark):
    assert u.judge_urls(spark.createDataFrame([], SCHEMA)).count() == 0
