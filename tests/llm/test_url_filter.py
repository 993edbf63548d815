import re
from collections import Counter

from civicflow.llm import url_filter
from civicflow.llm.queries import URL_RULES

URLS = ["https://www.A.example.org/es/x?y#z", "http://example.org/en/12", "http://example.org/en/2", "http://b.com/fr/", "http://b.com/fr", "http://b.com/de/1", "HTTP://X.NET", "x.net/a", None, "", "://", "http://x.net?u=/org/", "ftp://m.spam.net/a/b.html?utm_source=q&b=2&a=1", "http://spam.net/a/b/?a=1&b=2", "http://notorg/", "http://org/x", "http://org:80/x", "http://x.net/a://b", "http://spam.net/hot"]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def canonical(url):
    host, path = parts(url)
    if not host:
        return None
    query = re.match(r"[^?#]*\?([^#]*)", url)
    kept = sorted(x for x in (query[1].split("&") if query else []) if x and not re.match("utm_|ref=", x))
    path = re.sub(r"(/index)?\.html?$", "", re.sub("/+$", "", path))
    return re.sub(r"^(www|m)\.", "", host) + path + ("?" + "&".join(kept) if kept else "")


def judge(url, listed):
    host, path = parts(url)
    best = None
    for kind, rule in URL_RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = kind, rule
    if best:
        return host, path, best[1], best[0]
    return host, path, None, "block" if canonical(url) in listed else "allow"


def test_against_brute_force(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()
    rows = [(i, u, "clash", "clash", "clash") for i, u in enumerate(URLS + [URLS[-1]] * 300)] + [(1000 + r["page_id"], r["url"], "", "", "") for r in pages] + [(None, URLS[0], "", "", ""), (7, None, "", "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, canon string, __block string")
    names = [URLS[13], URLS[18], "http://x.net", None, "nothing", *[r["url"] for r in pages[::5]]]
    listed = spark.createDataFrame([(u,) for u in names], "url string")
    got = Counter(tuple(r) for r in url_filter.filter_urls(df, listed, URL_RULES).collect())
    keys = {canonical(u) for u in names} - {None}
    assert got == Counter((r[0], *judge(r[1], keys)) for r in rows)
    assert any(k[4] == "block" and k[3] is None for k in got)


def test_empty_list_and_table(spark):
    df = spark.createDataFrame([(1, "http://a.net/b")], "page_id long, url string")
    none = spark.createDataFrame([], "url string")
    assert [r["verdict"] for r in url_filter.filter_urls(df, none, URL_RULES).collect()] == ["allow"]
    assert url_filter.filter_urls(df.limit(0), none, URL_RULES).count() == 0


def test_no_python_on_the_main_path(spark):
    df = spark.createDataFrame([(1, "http://a.net/b")], "page_id long, url string")
    plan = url_filter.filter_urls(df, df.select("url"), URL_RULES)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
