import re
from collections import Counter
from itertools import combinations

import pytest

from slotline.llm import url_rules

RULES = [("net", "/", "block", "net/"), ("example.net", "/en/", "allow", "example.net/en/"),
         ("example.com", "/de/", "block", "example.com/de/"), ("org", "/fr/", "allow", "org/fr/")]


@pytest.fixture
def make_pages(spark):
    schema = "page_id long, url string, host string, tokens string, rule string, verdict string, mined string"
    return lambda *rows: spark.createDataFrame([(*r, *[None] * 5) for r in rows], schema)


def given(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[3]), default=None)
    return host, path, best and best[3], best and best[2]


ODD = [None, "", "no scheme", "http://", "http://NET/", "http://net", "http://a.net?x=/en/", "ftp://x://y.net/", "http://xnet/",
       "http://EXAMPLE.net/en/", "http://sub.example.net/en", "http://example.com/de/#a?b", "http://aexample.com/de/", "http://é.ORG/fr/1",
       "http://u@example.net:80/en/", "http:///p", "http://org/fr/", "x://example.com/de/?q"]


def corpus():
    hosts = ["a.example.net", "b.example.com", "c.example.org", "shop.example.com", "D.example.org"]
    return [(i, f"http{'s' * (i % 2)}://{hosts[i % 5]}/{['en', 'de', 'fr', 'es'][i % 4]}/{i}{['', '.html', '?ref=x'][i % 3]}") for i in range(240)]


def test_given_rules(make_pages):
    rows = [*enumerate(ODD), (None, "http://net/"), (1, "http://net/")]
    found = url_rules.judge(make_pages(*rows)).collect()
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in found) == Counter((i, *given(u)[:3]) for i, u in rows)
    assert all(r["verdict"] == v for r in found if (v := dict((x[3], x[2]) for x in RULES).get(r["rule"])))
    assert {r["verdict"] for r in found} <= {"allow", "block"}


def test_mined_rules_are_those_counted_by_hand(make_pages):
    pages = url_rules.parts(make_pages(*corpus()))
    rule, verdict = url_rules.given()
    rows = pages.withColumns({"given": verdict, "tokens": url_rules.tokens()}).filter("given is not null")
    held = [(frozenset(r["tokens"]), r["given"]) for r in rows.collect()]
    counts, right = Counter(), Counter()
    for tokens, label in held:
        for size in (1, 2, 3):
            for chosen in combinations(sorted(tokens), size):
                counts[chosen] += 1
                right[chosen, label] += 1
    least = 0.05
    every = {(c, v): (n / counts[c], n / len(held)) for (c, v), n in right.items() if n >= least * len(held) and n >= 0.9 * counts[c]}
    expected = {
        (c, v): (round(sure, 9), round(share, 6))
        for (c, v), (sure, share) in every.items()
        if not any((part, v) in every and every[part, v][0] >= sure for k in range(1, len(c)) for part in combinations(c, k))
    }
    found = url_rules.mined(rows.selectExpr("tokens", "given as verdict"), min_support=least).collect()
    assert {(tuple(r["antecedent"]), r["verdict"]): (r["confidence"], round(r["support"], 6)) for r in found} == expected
    # The rules as matched by the index, against each rule tried on each URL.
    judged = url_rules.judge(make_pages(*corpus())).collect()
    assert len(judged) == 240 and {r["verdict"] for r in judged if r["rule"] is None} == {"allow", "block"}


def test_best_rule_of_each_url(spark, make_pages):
    rules = [(1, ["p:de"], "block", 0.9, 0.1), (2, ["h0:org", "p:de"], "allow", 0.95, 0.1), (3, ["p:fr", "q:ref"], "block", 1.0, 0.1)]
    frame = spark.createDataFrame(rules, "rule_id long, antecedent array<string>, verdict string, confidence double, support double")
    pages = url_rules.parts(make_pages((1, "http://a.org/de/"), (2, "http://a.com/de/"), (3, "http://a.com/fr/"), (4, "http://a.com/fr/?ref=1")))
    rows = pages.withColumn("tokens", url_rules.tokens())
    found = rows.join(url_rules.matched(rows, frame), "tokens", "left").select("page_id", "mined").collect()
    assert dict(map(tuple, found)) == {1: "allow", 2: "block", 3: None, 4: "block"}


def test_no_pages_and_no_labels(make_pages):
    assert url_rules.judge(make_pages()).count() == 0
    assert [r["verdict"] for r in url_rules.judge(make_pages((1, "http://a.com/x"))).collect()] == ["allow"]


def test_plan_has_no_python(make_pages):
    plan = url_rules.judge(make_pages(*corpus()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_tokens_of_long_urls_count(make_pages):
    """Late path parts, endings and query names of deep hosts and long paths make rules and match them."""
    deep, path = "a1.b2.c3.d4.e5.f6.g7.h8", "/".join(f"part{chr(97 + i)}" for i in range(24))
    url = "http://{}.{}/{}/x/{}.{}?{}=1".format
    rows = [(i, url(deep, "net", path, "bad", "php", "spam")) for i in range(30)]
    rows += [(100 + i, url(deep, "example.net", "en/" + path, "good", "html", "page")) for i in range(30)]
    rows += [(200, url("z", "com", path, "bad", "html", "other")), (201, url("z", "com", path, "fine", "cgi", "spam")),
             (202, url("z", "com", path, "good", "gif", "other")), (203, url("z", "com", path, "fine", "php", "other"))]
    tokens = url_rules.parts(make_pages(*rows)).select("page_id", url_rules.tokens().alias("tokens")).filter("page_id = 0").first()["tokens"]
    assert len(tokens) > 30 and {"q:spam", "x:php", "p:bad.php"} <= set(tokens)
    labelled = url_rules.parts(make_pages(*rows)).withColumns({"verdict": url_rules.given()[1], "tokens": url_rules.tokens()})
    found = url_rules.mined(labelled.filter("verdict is not null").select("tokens", "verdict")).collect()
    single = {(r["antecedent"][0], r["verdict"]) for r in found if len(r["antecedent"]) == 1}
    assert {("q:spam", "block"), ("x:php", "block"), ("p:good.html", "allow"), ("q:page", "allow"), ("x:html", "allow")} <= single
    assert len({r["rule_id"] for r in found}) == len(found)
    judged = {r["page_id"]: r["mined"] for r in url_rules.judge(make_pages(*rows)).collect() if r["page_id"] >= 200}
    assert judged == {200: "allow", 201: "block", 202: None, 203: "block"}
