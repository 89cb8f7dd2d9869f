import random
import re

import pytest
from mergewell.llm import url_rules
from mergewell.llm.url_rules import judge

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def brute(pages, rules, default):
    out = []
    for page_id, url in pages:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
        fits = [(len(h), len(p), v == "block", h + p, v) for h, p, v in rules if h and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        out.append((page_id, host, path, best and best[3], best[4] if best else default))
    return sorted(out, key=str)


def pages(seed, n=400):
    r = random.Random(seed)
    hosts = ["org", "example.org", "a.example.org", "EXAMPLE.org", "xexample.org", "b.a.example.org", "com", "x.com", "com.org", "example.com", "net", "", "org.", ".org", "u@example.org:80", "é.com", "hot.example.org"]
    out = [(i, r.choice(["http://", "https://", "://", "a://b://"]) + (r.choice(hosts) if r.random() < 0.6 else "hot.example.org") + r.choice(["", "/", "/es/", "/es", "/en/1", "/en/12/x", "/en/2", "/fr/", "/de/a?b=/fr/", "?/es/", "#/en/1", "/é\n/z"])) for i in range(n)]
    return [*out, (n, None), (n + 1, ""), (n + 2, "example.org/es/"), (None, "http://example.org/es/"), (3, "http://com/de/"), (3, "http://com/de/")]


@pytest.mark.parametrize(("rules", "ranges", "drawn"), [(RULES, 6, 3), (RULES, None, 200), ([*RULES, ("a.example.org", "/", "allow"), ("example.org", "/", "block"), ("example.org", "/es/", "allow"), ("", "/", "block"), (None, "/", "block"), ("b.a.example.org", "/en/", "block"), ("net", "", "block"), ("com", "/fr/", "allow")], 9, 2)])
def test_against_all_rules(spark, monkeypatch, rules, ranges, drawn):
    monkeypatch.setattr(url_rules, "DRAWN", drawn)
    rows = pages(len(rules))
    frame = spark.createDataFrame([(*x, "k") for x in rows], "page_id long, url string, host string").repartition(3)
    got = judge(frame, spark.createDataFrame(rules, "host string, path string, verdict string"), "allow", ranges=ranges)
    got = got.select("row.page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, rules, "allow")


def test_empty_tables(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    none = spark.createDataFrame([], "page_id long, url string")
    assert judge(none, rules).count() == 0
    assert judge(spark.createDataFrame([(1, "http://a.org/")], none.schema), rules.limit(0), "block").first().verdict == "block"
