import re

from rowtide.llm import urls

ROWS = [
    (1, "http://Sub.EXAMPLE.com/en/x?y#z"),
    (2, "http://www.example.com/en/1"),
    (3, "https://a.www.example.com/en/"),
    (4, "http://notexample.com/en/"),
    (5, "http://x.net/es/1"),
    (6, "http://net/fr/"),
    (7, "http://x.net/fr"),
    (8, None),
    (9, "no scheme here/en/"),
    (10, "ftp://a.org?q=http://example.com/en/"),
    (11, "http://x.com"),
    (12, ""),
    (12, ""),
    (None, "http://example.com/EN/"),
    (13, "http://a.net/es/\nnext#"),
    (14, "http://" + "a" * 50_000 + ".net/fr/" + "b" * 50_000),
    (15, "http://ÄÖ.org/de/"),
]


def parts(url):
    m = re.search(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return ("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")


def rule(host, path):
    fit = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def test_rules_and_parts(spark):
    pages = spark.createDataFrame([(i, u, "x", "h") for i, u in ROWS], "page_id long, url string, html string, host string")
    got = urls.judge_urls(pages, urls.labelled_urls(spark)).collect()
    want = sorted(((i, *parts(u), rule(*parts(u))[0]) for i, u in ROWS), key=repr)
    assert sorted(((r.page_id, r.host, r.path, r["rule"]) for r in got), key=repr) == want
    for r in got:
        assert r.verdict == (rule(r.host, r.path)[1] or ("block" if r.p_block >= 0.5 else "allow"))


def test_model_on_held_out_urls(spark):
    new = [("http://m.best-casino-win.example.org/de/9", 1), ("http://www.cheap-pills-online.example.org/", 1), ("http://free-bets-now.example.org/x", 1)]
    new += [("http://city-library.example.org/de/9", 0), ("http://www.weather-news.example.org/", 0), ("http://music-history.example.org/x", 0)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(new)], "page_id long, url string")
    got = {r.page_id: r.verdict == "block" for r in urls.judge_urls(pages, urls.labelled_urls(spark)).collect()}
    assert got == {i: bool(y) for i, (_, y) in enumerate(new)}


def test_no_python_in_the_plan(spark, capsys):
    pages = spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string")
    urls.judge_urls(pages, urls.labelled_urls(spark)).explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge_urls(pages, urls.labelled_urls(spark)).count() == 0
