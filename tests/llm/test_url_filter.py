import re

import duckdb
import pytest
from pyspark.sql import functions as F

from etalage.llm import queries, url_filter
from etalage.llm.url_filter import Rule, ShiftAnd
from tests.conftest import SF


def as_regex(glob):
    parts = re.split(r"(\*\*|\*)", glob)
    return re.compile("".join({"**": "(?s:.*)", "*": "[^/]*"}.get(p, re.escape(p)) for p in parts) + r"\Z")


def test_automaton_is_the_globs_over_many_words():
    globs = ["", "*", "**", "a*b", "*a**b*", "a/**", "*.com/**", "x" * 130, "x*" * 4, "é*"] + [f"{i}*z" for i in range(60)]
    machine = ShiftAnd(globs)
    assert machine.words > 3
    texts = ["", "a", "ab", "a/b", "a/x/b", "axxb", ".foo.com/p", "x" * 130, "x" * 41, "é1", "17qz", "17q/z", "zzz", "a" * 3000 + "b"]
    found = machine.matches([t.encode() for t in texts])
    for i, t in enumerate(texts):
        for j, g in enumerate(globs):
            assert found[i, j] == bool(as_regex(g).match(t)), (t, g)
    assert machine.matches([]).shape == (0, len(globs))


CASES = [
    ("http://a.com/x", "a.com", "/x", "com/", "allow"),
    ("HTTP://WWW.Example.COM/en/1?q#f", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://sub.example.com/en/", "sub.example.com", "/en/", "example.com/en/", "block"),
    ("https://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("https://x.net/es/1", "x.net", "/es/1", "net/es/", "block"),
    ("https://x.net/de/a.com/", "x.net", "/de/a.com/", None, "allow"),
    ("https://com", "com", "", None, "allow"),
    ("https://a.com?x=/", "a.com", "", None, "allow"),
    ("https://best-casino.org", "best-casino.org", "", None, "block"),
    ("https://x.org/casino", "x.org", "/casino", None, "allow"),
    ("a://b://c.com/", "b:", "//c.com/", None, "allow"),
    ("no scheme.com/", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://x.com/" + "y" * 50_000, "x.com", "/" + "y" * 50_000, "com/", "allow"),
]


def test_fixture_by_operator_and_by_twin(spark, tmp_path):
    # Repeated rows, a null id, and columns named like the result's.
    rows = [(i, c[0], "h", "r") for i, c in enumerate(CASES)] + [(None, CASES[0][0], None, None)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    got = queries.QUERIES["op5_url_filter"](spark, str(tmp_path)).collect()
    want = [(i, *c[1:]) for i, c in enumerate(CASES)] + [(None, *CASES[0][1:])] * 2
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert sorted(con.execute(queries.SQL["op5_url_filter"]).fetchall(), key=str) == sorted(want, key=str)
    kept = url_filter.judge(pages, queries.url_rules())
    assert kept.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    assert url_filter.judge(pages.where("false"), queries.url_rules()).count() == 0


def test_query_is_its_twin(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = con.execute(queries.SQL["op5_url_filter"]).fetchall()
    got = queries.QUERIES["op5_url_filter"](spark, SF).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_of_equal_weights_the_first_rule_decides(spark):
    pages = spark.createDataFrame([("http://a.b/c",)], "url string")
    rules = [Rule("**c", "block", "one", 1), Rule("*.b/**", "allow", "two", 1)]
    assert url_filter.judge(pages, rules).first().rule == "one"
    assert url_filter.judge(pages, [], default="block").select(F.col("verdict")).first()[0] == "block"


@pytest.mark.parametrize("url", ["x://\n/p", "x://h\n.com/p\nq"])
def test_line_ends_in_urls(spark, url):
    row = url_filter.judge(spark.createDataFrame([(url,)], "url string"), queries.url_rules()).first()
    rest = url.split("://", 1)[1]
    assert (row.host, row.path) == (rest[: rest.index("/")], rest[rest.index("/") :])
