from tabulae.llm.url_filter import judge

CASES = [
    ("https://a.example.com/x", "a.example.com", "/x", "com/", "allow"),
    ("HTTP://EXAMPLE.COM/en/1?q=/fr/", "example.com", "/en/1", "example.com/en/", "block"),
    ("http://www.Example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://m.www.example.com/en/1#x", "m.www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://notexample.com/en/1", "notexample.com", "/en/1", "com/", "allow"),
    ("http://a.net/es/", "a.net", "/es/", "net/es/", "block"),
    ("http://a.net/es", "a.net", "/es", None, "allow"),
    ("http://a.net/EN/", "a.net", "/EN/", None, "allow"),
    ("http://a.com", "a.com", "", None, "allow"),            # no path: no rule fits
    ("http://a.com?x=/en/", "a.com", "", None, "allow"),
    ("a.com/en/", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("x://y://z/w", "y:", "//z/w", None, "allow"),
    ("http://casino-win.org/", "casino-win.org", "/", None, "block"),      # strict
    ("http://casino-winner.org/", "casino-winner.org", "/", None, "allow"),  # no boundary; one soft term
    ("http://a.org/free/free/free", "a.org", "/free/free/free", None, "allow"),  # one distinct soft term
    ("http://a.org/free?loan=1", "a.org", "/free", None, "block"),
    ("http://a.org/freeloan", "a.org", "/freeloan", None, "allow"),
    ("http://a.net:80/fr/", "a.net:80", "/fr/", None, "allow"),
]


def test_hosts_paths_rules_and_terms(spark):
    pages = spark.createDataFrame([(i, c[0], "x") for i, c in enumerate(CASES)], "page_id long, url string, host string")
    rows = {r.page_id: r for r in judge(pages).collect()}
    for i, c in enumerate(CASES):
        assert (rows[i].host, rows[i].path, rows[i].rule, rows[i].verdict) == c[1:], c[0]


def test_weights_add_up_to_the_limit(spark):
    pages = spark.createDataFrame([(1, "http://a.org/loan"), (1, "http://a.org/loan"), (None, "u")], "page_id long, url string")
    assert [r.verdict for r in judge(pages, soft={"loan": 2}).orderBy("page_id").collect()] == ["allow", "block", "block"]
    assert judge(pages, strict=(), soft={}).filter("verdict = 'block'").count() == 0
    assert judge(pages.limit(0)).count() == 0


def test_default_lists_do_not_overlap():
    from tabulae.llm import url_filter as u

    assert not set(u.STRICT) & set(u.SOFT) and all(w > 0 for w in u.SOFT.values())
