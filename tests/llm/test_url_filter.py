import random

import pytest

from cdrflow.llm import url_filter as U
from cdrflow.llm.common import materialize


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    path = rest[n:]
    path = path[: next((i for i, c in enumerate(path) if c in "?#"), len(path))]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n]), path


URLS = [None, "", "no-scheme/x", "http://", "HTTP://EXAMPLE.Org/es/1", "https://a.example.org/en/1?x#y", "http://org/", "http://xorg/",
        "http://É.com/fr/é?z", "http://a.com", "http://a.com?x=/fr/", "http://b.com/de/x://y", "ftp://h#f/g", "http://n.net/\nq",
        "x" * 5000 + "://h/" + "p" * 5000]


def test_host_and_path(spark):
    df = spark.createDataFrame([(u, "c") for u in URLS], "url string, key string")
    out = U.with_host_path(df).collect()
    assert [(r.host, r.path) for r in out] == [split(u) for u in URLS]


@pytest.mark.parametrize("bound", [1 << 20, 8])
def test_cascade_is_exact(spark, bound):
    """With a bound that no level fits, a join gives the same."""
    rnd = random.Random(3)
    keys = [f"h{i}.net/{rnd.random()}" for i in range(3000)]
    listed = set(rnd.sample(keys, 700))
    pages = spark.createDataFrame(
        [(i, f"http://{k}?a", 1, "x") for i, k in enumerate(keys * 2)] + [(-1, None, 1, "x")], "page_id long, url string, hit int, key string"
    )
    want = spark.createDataFrame([(k,) for k in [*listed, "elsewhere/1", "elsewhere/1"]], "key string")
    out = U.judge_urls(pages, want, [], bound).collect()
    assert len(out) == 6001 and {(r.hit, r.key) for r in out} == {(1, "x")}
    assert all((r.verdict == "block") == (r.host + r.path in listed) and r.rule is None for r in out)


def test_nothing_listed_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    none = spark.createDataFrame([], "key string")
    assert [r.verdict for r in U.judge_urls(pages, none, []).collect()] == ["allow"]
    assert U.judge_urls(pages.limit(0), none, []).count() == 0
    both = spark.createDataFrame([("a.net/",)], "key string")
    assert [r.verdict for r in U.judge_urls(pages, both, []).collect()] == ["block"]


def test_longest_rule_wins_over_the_list(spark):
    rules = [U.Rule("allow", "org/"), U.Rule("block", "example.org/es/"), U.Rule("block", "com/de/")]
    urls = ["http://example.org/es/1", "http://a.example.org/es/", "http://badexample.org/es/", "http://org/x", "http://x.com/de/", "http://org"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    listed = spark.createDataFrame([("org/x",), ("org",)], "key string")
    out = {r.page_id: (r.rule, r.verdict) for r in U.judge_urls(pages, listed, rules).collect()}
    assert out == {
        0: ("example.org/es/", "block"), 1: ("example.org/es/", "block"), 2: ("org/", "allow"), 3: ("org/", "allow"),
        4: ("com/de/", "block"), 5: (None, "block"),
    }


def test_levels_answer_for_every_key(spark):
    rows = [(f"k{i}", i % 5 == 0) for i in range(2000)]
    keys = materialize(spark.createDataFrame(rows, "key string, listed boolean"), "t")
    levels = U.build_cascade(keys)
    wrong = keys.filter(U.is_listed(levels, keys["key"]) != keys["listed"]).count()
    assert levels and wrong == 0


def test_columns_of_the_result_take_the_place_of_equal_names(spark):
    df = spark.createDataFrame([(1, "http://a.net/x", "mine", 5, 6, 7)], "page_id long, url string, host string, page int, rule int, listed int")
    out = U.judge_urls(df, spark.createDataFrame([], "key string"), [])
    assert out.columns == ["page_id", "url", "page", "listed", "host", "path", "rule", "verdict", "on_list"]
    assert tuple(out.first()) == (1, "http://a.net/x", 5, 7, "a.net", "/x", None, "allow", False)
