from vistasieve.llm.url_trie import build_trie, longest_match, split_url, url_verdicts

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
         ("block", "example.org", "/fr/pri"), ("block", "a.example.net", "/en/x/"), ("allow", "a.example.net", "/en/x/y")]
URLS = [None, "", "example.net/en/", "http://", "http://net", "http://net/", "HTTP://EXAMPLE.Net/en/a?x=/de/", "s://a.example.net/en/x/y1",
        "s://a.example.net/en/x/", "s://b.a.example.net/en/x/z", "s://xexample.net/en/", "http://example.com#/de/", "http://example.com/de",
        "http://q.example.org/fr/private", "http://q.example.org/fr/pr", "http://org//fr/", "http://é.ORG/fr/ü?", "://net/", "a://b://net/", "x" * 50_000]


def brute(url):
    host, path = split_url(url)
    fits = [(len(h) + len(p), len(h), v, h + p) for v, h, p in RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[3] if fits else None, max(fits)[2] if fits else "allow"


def test_matches_brute_force(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS * 2)] + [(None, "http://net/", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string").repartition(3)
    got = sorted(map(tuple, url_verdicts(df, RULES).collect()), key=str)
    assert got == sorted([(i, *brute(u)) for i, u, _ in rows], key=str)
    assert url_verdicts(df.limit(0), RULES).collect() == []


def test_conflicting_rules_raise():
    import pytest

    with pytest.raises(ValueError):
        build_trie([("block", "a.b", "/"), ("allow", "A.b", "/")])
    assert longest_match(build_trie([]), "a", "/") is None
