import random
import re

import pytest

from bankspark.llm import url_filter
from bankspark.llm.queries import URL_RULES


def brute(url, rules, default="allow"):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    raw = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(raw):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), raw)
    best = None
    for h, p, v in rules:
        if h and host and (host == h or host.endswith("." + h)) and path.startswith(p or ""):
            key = (len(h.split(".")), len(p or ""), v)
            best = max(best or (key, h, p, v), (key, h, p, v))
    return host, path, (best[1] + (best[2] or "")) if best else None, best[3] if best else default


def judged(spark, urls, rules, **kw):
    pages = spark.createDataFrame([(i, u, "h", "p", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, path string, verdict string")
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    out = url_filter.apply_rules(pages, frame, **kw)
    assert out.columns == [*pages.columns, "llm_rule"]
    return [tuple(r.llm_rule) for r in out.orderBy("page_id").collect()]


URLS = [
    None, "", "no scheme", "http://", "http:///p", "HTTP://WWW.Example.COM/en/x?q#f", "http://www.example.com/en/", "http://example.com/en/a", "http://a.b.example.com/en",
    "http://notexample.com/en/", "https://x.net/es/1", "https://net/fr/", "https://x.net", "ftp://é.net/fr/é", "http://com", "http://com/", "http://x.com?y=/z", "a://b://c.com/",
    "http://example.com./en/", "http://..com/", "http://ÄX.com/a",
]


@pytest.mark.parametrize("points", [100_000, 2])
def test_contract_rules(spark, points):
    """Also with many sweeps for a host level."""
    urls = URLS + ["http://hot.example.com/en/1"] * 50
    assert judged(spark, urls, URL_RULES, points_per_sweep=points) == [brute(u, URL_RULES) for u in urls]


def test_nested_rules_at_random(spark):
    rnd = random.Random(4)
    label = lambda: rnd.choice(["a", "b", "c"])
    host = lambda n: ".".join(label() for _ in range(n))
    path = lambda: "".join("/" + label() for _ in range(rnd.randint(0, 3)))
    rules = [(host(rnd.randint(1, 3)), path(), rnd.choice(["allow", "block"])) for _ in range(60)] + [("", "/", "block"), (None, "/", "block"), ("a", None, "block")]
    urls = [f"http://{host(rnd.randint(1, 4))}{path()}{path()}" for _ in range(300)]
    assert judged(spark, urls, rules, points_per_sweep=20) == [brute(u, rules) for u in urls]


def test_no_rules_no_pages_and_native_plan(spark):
    assert judged(spark, URLS[:6], [("nowhere", "/", "block")], default="block")[5][2:] == (None, "block")
    pages = spark.createDataFrame([], "page_id long, url string")
    out = url_filter.apply_rules(pages, spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))
    assert out.count() == 0
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text
