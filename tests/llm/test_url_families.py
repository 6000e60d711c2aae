"""Template families judge branches that hold no labels."""

from __future__ import annotations

from vigil.llm import url_filter
from vigil.llm.queries import RULES


def _judged(spark, urls):
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return {r.page_id: (r.verdict, r.evidence) for r in url_filter.judge(table, RULES).collect()}


def test_urls_without_a_rule_are_judged_by_their_family(spark):
    spam = [f"http://a.net/{x}/{i}.html" for x in ("es", "fr") for i in range(8)]
    near = [f"http://a.net/de/{i}.html" for i in range(9)]       # as many pages as es and fr
    large = [f"http://a.net/en/{i}.html" for i in range(60)]     # far more pages
    other = [f"http://a.net/de/about/{i}" for i in range(8)]     # another shape
    clean = [f"http://b.org/{x}/{i}.html" for x in ("es", "de") for i in range(8)]
    urls = spam + near + large + other + clean
    got = _judged(spark, urls)
    for part, want in ((spam, ("block", "rule")), (near, ("block", "family")),
                       (large, ("allow", "none")), (other, ("allow", "none")),
                       (clean, ("allow", "none"))):
        assert {got[urls.index(u)] for u in part} == {want}


def test_few_labels_on_a_clean_host_block_nothing(spark):
    urls = ["http://a.net/es/1", "http://a.net/de/1"] + [f"http://a.net/x{i}/y/{i}" for i in range(40)]
    got = _judged(spark, urls)
    assert got[0] == ("block", "rule") and got[1] == ("allow", "family")


def test_repeated_rows_and_very_long_urls(spark):
    long = "http://a.net/" + "/".join(f"s{i}x" for i in range(20_000)) + "?" + "q" * 100_000
    got = _judged(spark, [long, long, None, "http://a.net/de/1", "http://a.net/de/1"])
    assert len(got) == 5 and {v for v, _ in got.values()} == {"allow"}
