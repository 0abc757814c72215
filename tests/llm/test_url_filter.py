import pytest

from tidemark.llm.url_filter import filter_urls, labelled_urls, split_url

ODD = [
    (1, "http://www.Example.NET/en/x?y#z"), (2, "https://example.net/de/"), (3, "http://net/"), (4, "http://net"), (5, "ftp://a.example.com/de/1"),
    (6, "http://example.com/de"), (7, "http://x.org/fr/1"), (8, "no scheme"), (9, None), (10, ""), (11, "://"), (12, "http://a?b/c"), (13, "x://h#f/en/"),
    (14, "http://É.org/FR/"), (15, "http://notexample.net/en/"), (16, "http://a://b.net/x"), (16, "http://a://b.net/x"), (None, "http://q.com/"), (17, "http://h.net/" + "a" * 200_000),
]
RULES = {"net/": ("net", "/", "block"), "example.net/en/": ("example.net", "/en/", "allow"), "example.com/de/": ("example.com", "/de/", "block"), "org/fr/": ("org", "/fr/", "allow")}


def expected_rule(host, path):
    fits = [n for n, (h, p, _) in RULES.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=len, default=None)


def pages(spark, rows):
    rows = [(i, u, "x", "y", "z") for i, u in rows]
    return spark.createDataFrame(rows, "page_id bigint, url string, host string, path string, verdict string")


@pytest.fixture(scope="module")
def answers(spark):
    return filter_urls(pages(spark, ODD)).collect()


def test_parts_and_rules(answers):
    assert len(answers) == len(ODD)
    by_id = {r.page_id: r for r in answers}
    for i, url in ODD:
        host, path = split_url(url)
        row = by_id[i]
        assert (row.host, row.path) == (host, path), url
        assert row.rule == expected_rule(host, path), url
        assert row.verdict == (RULES[row.rule][2] if row.rule else "block" if row.block_score >= 0.5 else "allow")
        assert 0 <= row.block_score <= 1
    assert by_id[1].host == "www.example.net" and by_id[1].path == "/en/x"
    assert (by_id[9].host, by_id[9].path, by_id[8].host) == ("", "", "")
    assert (by_id[12].host, by_id[12].path) == ("a", "")
    assert by_id[14].host == "É.org"
    assert by_id[4].rule is None  # no path, so it doesn't start with the rule's


def test_unseen_names(spark):
    wanted = ["http://gardenriver.org/en/1", "https://www.schoolbakery.de/x", "http://tiontion.example.com/es/3", "http://weather-maps.es/"]
    unwanted = ["http://casino-bonus.com/x", "https://www.cheapviagra.example.com/en/2", "http://poker-xxx.de/", "http://torrent-warez.fr/9"]
    urls = [(i, u) for i, u in enumerate([*wanted, *unwanted])]
    assert not {u for _, u in urls} & {u for u, _ in labelled_urls()}
    verdicts = [r.verdict for r in filter_urls(pages(spark, urls), rules=()).orderBy("page_id").collect()]
    assert verdicts == ["allow"] * 4 + ["block"] * 4


def test_empty(spark):
    assert filter_urls(pages(spark, [])).count() == 0
    assert filter_urls(pages(spark, [(1, "http://a.com/")]), labelled=[]).first().block_score == 0.5
