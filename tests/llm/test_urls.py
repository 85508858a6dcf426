"""URL filters against a plain loop over the rules."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from souklake.llm import urls
from souklake.llm.queries import URL_RULES

URL = re.compile(r"://([^/?#]*)([^?#]*)", re.DOTALL)


def expected(url, rules, default="allow"):
    found = URL.search(url or "")
    host, path = (found[1], found[2]) if found else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), len(h), h + p, v) for h, p, v in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


@pytest.fixture
def pages(spark):
    return lambda links: spark.createDataFrame(list(enumerate(links)), "page_id long, url string")


def judged(df, rules, **settings):
    got = urls.judge_urls(df, rules, **settings).collect()
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}


EDGES = [
    None, "", "org", "http://", "://org/", "http://ORG/", "http://org", "http://org?x=/", "http://xorg/",
    "http://a.b.Example.ORG/es/x?y", "http://example.org/es", "http://example.org/en/12#z", "http://example.org/en/2",
    "https://www.é.com/fr/1", "ftp://com/de/", "http://com./de/", "x://y://z.com/de/", "http://a\nb.com/fr/\n?", "HTTP://.org/",
    "http://org/" + "/a" * 5000, "http://" + "a." * 300 + "org/",
]


def test_edge_cases_and_the_given_rules(pages):
    got = judged(pages(EDGES), URL_RULES)
    assert got == {i: expected(url, URL_RULES) for i, url in enumerate(EDGES)}


def test_many_rules_are_exact_on_every_url(pages):
    rng = random.Random(7)
    hosts = [f"h{i}.{t}" for i in range(60) for t in ("com", "org")]
    rules = [(rng.choice(hosts), "/" + "x" * rng.randrange(4), rng.choice(["allow", "block"])) for _ in range(150)]
    rules = list({r[:2]: r for r in rules}.values())
    links = [f"http://{rng.choice(['', 'www.', 'a.b.'])}{rng.choice(hosts)}/{'x' * rng.randrange(6)}" for _ in range(3000)]
    got = judged(pages(links), rules, default="block")
    assert got == {i: expected(url, rules, "block") for i, url in enumerate(links)}


def test_cascade_is_exact_where_one_filter_is_not(spark):
    listed = spark.range(0, 2_000).select(F.concat(F.lit("k"), "id").alias("key"))
    universe = spark.range(0, 40_000).select(F.concat(F.lit("k"), "id").alias("key"))
    levels = urls.build_cascade(listed, universe)
    assert len(levels) > 2
    one = universe.where(levels[0].accepts(F.col("key"))).count()
    assert one > 2_000
    inside = universe.where(urls.in_cascade(levels, F.col("key")))
    assert inside.count() == 2_000 and inside.join(listed, "key", "left_anti").count() == 0


def test_no_rules_no_pages_clashing_columns(pages):
    assert judged(pages(["http://a.org/"]), []) == {0: ("a.org", "/", None, "allow")}
    assert judged(pages([]), URL_RULES) == {}
    clash = pages(["http://a.org/", "http://a.org/"]).withColumn("rule", F.lit(1)).withColumn("path", F.lit(2))
    assert judged(clash, URL_RULES)[1] == ("a.org", "/", "org/", "allow")
    odd = [("org", "/", "allow"), ("org", "/", "block"), (None, "/", "block"), ("com", None, "block")]
    assert judged(pages(["http://a.org/"]), odd)[0][2:] == ("org/", "block")
