"""URL filters against SQL on awkward urls, and what the template tree merges and rejects."""

from __future__ import annotations

import random

import duckdb
import pyarrow as pa
import pytest

from yearbook.llm.oracle import ORACLE_SQL
from yearbook.llm.queries import URL_RULES
from yearbook.llm.urls import Rule, judge_urls

COLUMNS = "page_id bigint, url string, html string, host string, template string, salt string, `key` string, n int"

AWKWARD = [
    None, "", "no scheme/en/1", "://", "http://", "http:///", "http://A.Example.COM", "http://a.example.com/", "http://a.example.com//x//",
    "https://www.example.com/en/1", "https://shop.www.example.com/en/1?q=/de/", "https://wwww.example.com/en/2", "http://example.com/en", "http://example.com/EN/1",
    "http://com/x", "http://xcom/x", "http://a.net#/es/1", "http://a.net?/es/1", "http://a.net/es/1#x", "http://b.c.net/fr/9/8/7.html", "HTTP://Ä.Net/es/Ü",
    "a://b://c.com/x", "http://u:p@h.com:80/x/12ab34", "http://a.com/line\nbreak/1", "http://a.com/" + "/".join("abcdefghijklmnop"),
    "http://a.com/" + "/".join("abcdefghijklmnoq"), "http://a.com/" + "x" * 70000 + "/1", "http://a.org/?x", "http://a.org/*/#", "http://a.org/%20/ ",
]


def pages(spark, urls):
    return spark.createDataFrame([(None if i == 3 else i, u, "<p>", "clash", "clash", "clash", "clash", 7) for i, u in enumerate(urls)], COLUMNS)


def in_sql(urls):
    connection = duckdb.connect()
    connection.register("given", pa.table({"page_id": pa.array([None if i == 3 else i for i in range(len(urls))], pa.int64()), "url": pa.array(urls, pa.string())}))
    return connection.execute(ORACLE_SQL["op12_url_filters"].replace("FROM pages", "FROM given")).fetchall()


def many() -> list[str]:
    """A host with most urls, wide and narrow nodes, labelled and not."""
    pick, out = random.Random(5), []
    for i in range(3000):
        host = pick.choice(["hot.net"] * 4 + ["a.example.com", "b.example.com", "www.example.com", "c.org", "d.org"])
        lang = pick.choice(["en", "en", "de", "fr", "es"])
        tail = pick.choice([f"{i}", f"{i}.html", f"{i}/", f"slug-{pick.choice('abcdefgh')}{i}-{''.join(pick.choices('xyz', k=4))}", "about", f"u{''.join(pick.choices('pqrst', k=5))}/posts/{i}"])
        out.append(f"http://{host}/{lang}/{tail}{pick.choice(['', '?a=1', '#x'])}")
    return out


@pytest.mark.parametrize("urls", [AWKWARD * 2, many()], ids=["awkward", "many"])
def test_equals_sql(spark, urls):
    got = judge_urls(pages(spark, urls).repartition(3), URL_RULES)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "template", "purity"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(in_sql(urls), key=repr)


def test_rules(spark):
    urls = AWKWARD[6:19]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages(spark, [None] * 4 + urls), URL_RULES).collect()}
    want = [
        ("a.example.com", "", None, None), ("a.example.com", "/", "com/", "allow"), ("a.example.com", "//x//", "com/", "allow"),
        ("www.example.com", "/en/1", "www.example.com/en/", "allow"), ("shop.www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("wwww.example.com", "/en/2", "example.com/en/", "block"), ("example.com", "/en", "com/", "allow"), ("example.com", "/EN/1", "com/", "allow"),
        ("com", "/x", "com/", "allow"), ("xcom", "/x", None, None), ("a.net", "", None, None), ("a.net", "", None, None), ("a.net", "/es/1", "net/es/", "block"),
    ]
    for i, (host, path, rule, verdict) in enumerate(want):
        assert got[i + 4][:3] == (host, path, rule)
        assert verdict is None or got[i + 4][3] == verdict


def test_wildcards_merging_and_purity(spark):
    rows = [(f"http://h/{part}/{''.join(random.Random(i).choices('abcdefg', k=8))}-x/p", label) for part, label in (("spam", "block"), ("good", "allow")) for i in range(200)]
    rows += [("http://h/spam/unseen-words/p", None), ("http://h/good/unseen-words/p", None), ("http://h/other/p", None), ("http://new/spam/x", None)]
    rows += [(f"http://m/{part}/{i}", "block" if i % 10 else "allow") for part in ("p", "q", "r") for i in range(100)]
    frame = spark.createDataFrame([(i, u, x) for i, (u, x) in enumerate(rows)], "page_id long, url string, label string")
    got = {r.page_id: r for r in judge_urls(frame, [], label_col="label").collect()}
    assert {got[i].template for i in range(200)} == {"/spam/?/p"} and {got[i].template for i in range(200, 400)} == {"/good/?/p"}
    assert {got[i].verdict for i in range(200)} == {"block"} and {got[i].verdict for i in range(200, 400)} == {"allow"}
    assert (got[400].template, got[400].verdict, got[401].template, got[401].verdict) == ("/spam/?/p", "block", "/good/?/p", "allow")
    assert got[402].verdict == "allow"  # unlabelled: the share of the whole table, under the limit
    assert {got[i].template for i in range(404, 704)} == {"/?/#"} and {got[i].verdict for i in range(404, 704)} == {"block"}


def test_no_labels_and_no_rows(spark):
    short = AWKWARD[:23]
    got = judge_urls(pages(spark, short), []).collect()
    assert len(got) == len(short) and {r.verdict for r in got} == {"allow"} and {r.rule for r in got} == {None}
    assert judge_urls(pages(spark, short).limit(0), [Rule("block", "a.com", "/")]).collect() == []


def test_no_python_in_the_plan(spark):
    plan = judge_urls(pages(spark, AWKWARD[:23]), URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
