import random
import re

from cartflow.llm import urlfilter
from cartflow.llm.common import table
from llm_help import SF_SMALL


def _address(url):
    m = re.match(r"(.*?)://([^/?#]*)([^?#]*)", url or "", re.S)
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[2]), m[3]) if m else ("", "")


def _rule(host, path):
    fits = [
        (h + p, v)
        for v, h, p in urlfilter.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits, key=lambda r: len(r[0])) if fits else None


def _levels(host):
    """Suffix and registered domain."""
    host = re.sub(r":[0-9]*$", "", re.sub(r"^.*@", "", host))
    if re.fullmatch(r"[0-9.]+|\[.*", host):
        return "", host
    parts = host.split(".")
    n = 2 if ".".join(parts[-2:]) in urlfilter.SUFFIXES else 1
    return ".".join(parts[-n:]), ".".join(parts[-n - 1 :])


def _plain(rows, labels, z=1.645):
    """host -> (n, bad, rate, bound), and the rate of all labelled pages."""
    bad_of = {}
    for i, quality, toxic in labels:
        if None not in (i, quality, toxic):
            bad_of[i] = max(bad_of.get(i, 0), toxic, 1 - quality)
    hosts = {}
    for _, url in rows:
        host, path = _address(url)
        n, bad = hosts.get(host, (0, 0))
        m = re.search(r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", path)
        if m and int(m[1]) in bad_of:
            n, bad = n + 1, bad + bad_of[int(m[1])]
        hosts[host] = (n, bad)

    def pooled(key):
        out = {}
        for host, (n, bad) in hosts.items():
            a, b = out.get(key(host), (0, 0))
            out[key(host)] = (a + n, b + bad)
        return out

    def strength(pool):
        some = [(n, b) for n, b in pool.values() if n]
        n, bad = sum(n for n, _ in some), sum(b for _, b in some)
        if n <= len(some) or bad in (0, n):
            return 1.0
        noise = bad / n * (1 - bad / n)
        spread = sum(b * b / k for k, b in some) / n - (bad / n) ** 2 - noise * len(some) / n
        return 1 / min(max(spread / (noise * (1 - len(some) / n)), 1e-4), 0.5) - 1

    suffixes, domains = pooled(lambda h: _levels(h)[0]), pooled(_levels)
    total, all_bad = sum(n for n, _ in hosts.values()), sum(b for _, b in hosts.values())
    mean = all_bad / total if total else 0.0
    s, d, h = strength(suffixes), strength(domains), strength(hosts)
    out = {}
    for host, (n, bad) in hosts.items():
        suffix, domain = _levels(host)
        above = (suffixes[suffix][1] + s * mean) / (suffixes[suffix][0] + s)
        prior = (domains[suffix, domain][1] + d * above) / (domains[suffix, domain][0] + d)
        rate = (bad + h * prior) / (n + h)
        out[host] = (n, bad, rate, rate - z * (rate * (1 - rate) / (n + h + 1)) ** 0.5)
    return out, mean


def _check(rows, got, labels):
    by_id = {i: u for i, u in rows}
    plain, mean = _plain(rows, labels)
    assert len(got) == len(rows)
    for r in got:
        host, path = _address(by_id[r.page_id])
        rule = _rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule[0])
        n, bad, rate, bound = plain[host]
        assert (r.n, r.bad) == (n, bad) and abs(r.rate - rate) < 1e-9 and abs(r.bound - bound) < 1e-9
        assert r.verdict == (rule[1] if rule else ("block" if bound > mean else "allow"))


ODD = [
    None, "", "nothing", "http://", "http://A.NET", "http://a.net/", "x://example.NET/en/1", "http://EXAMPLE.net/EN/1", "http://example.com/de/2?q=/x",
    "http://notexample.com/de/2", "http://a.example.com/de", "http://org/fr/3", "http://b.org/fr/3/", "http://b.org/?u=://c.net/", "http://b.org#/fr/", "http://h.org:80/fr/7.html",
    "http://É.org/fr/é/9", "http://a\n.net/x\ny", "http://u@h.org/9", "http://a.shop.co.uk/3", "http://b.shop.co.uk/7", "http://co.uk/3",
    "http://10.0.0.1:80/3", "http://10.0.0.2/9", "http://[::1]:80/3", "http://[::1]/9", "http://d.e.f/12", "http://d.e.f/13",
]


def test_odd_addresses(spark):
    rows = [(i, u) for i, u in enumerate(ODD)]
    pages = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "page_id long, url string, host string, n int, bad int")
    # Half a label (9: low quality, toxic unknown; 12: toxic, quality unknown) says nothing.
    told = [(3, 1, 0), (7, None, None), (None, 0, 1), (9, 0, None), (12, None, 1), (13, 0, 0), (3, 1, 1)]
    labels = spark.createDataFrame(told, "doc_id long, quality int, toxic int")
    _check(rows, urlfilter.judge_urls(pages, labels).collect(), told)
    _check(rows, urlfilter.judge_urls(pages, labels.limit(0)).collect(), [])
    half = labels.where("doc_id in (9, 12)")
    assert {(r.n, r.rate, r.bound) for r in urlfilter.judge_urls(pages, half).collect()} == {(0, 0.0, 0.0)}
    twice = urlfilter.judge_urls(pages.union(pages), labels).collect()
    assert len(twice) == 2 * len(rows)
    assert urlfilter.judge_urls(pages.limit(0), labels).count() == 0


def test_pages_of_the_table(spark):
    pages = table(spark, SF_SMALL, "pages")
    rows = [(r.page_id, r.url) for r in pages.collect()]
    labels = table(spark, SF_SMALL, "labels")
    _check(rows, urlfilter.judge_urls(pages, labels).collect(), [(r.doc_id, r.quality, r.toxic) for r in labels.collect()])


def test_suffixes_and_addresses(spark):
    hosts = ["a.b.co.uk", "co.uk", "b.co.uk", "x.y.com", "com", "", "10.0.0.1", "[::1]:8080", "u@a.b.gov.au:80", "uk"]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = [(r.suffix, r.domain) for r in df.select(*urlfilter.levels(df.host)).collect()]
    assert got == [_levels(h) for h in hosts]
    assert got[0] == ("co.uk", "b.co.uk") and got[3] == ("com", "y.com") and got[6] == ("", "10.0.0.1")
    three = df.select(*urlfilter.levels(df.host, ("co.uk", "b.co.uk"))).first()
    assert tuple(three) == ("b.co.uk", "a.b.co.uk")  # the longest


def test_reputation_shrinks_towards_the_domain(spark):
    rnd = random.Random(1)
    rates = {"bad.one.example": 0.95, "good.one.example": 0.02, "some.two.example": 0.1, "rare.one.example": 1.0}
    pages, labels = [], []
    for host, rate in rates.items():
        for _ in range(2 if host.startswith("rare") else 300):
            i = len(pages)
            pages.append((i, f"http://{host}/p/{i}.html"))
            labels.append((i, 1, int(rnd.random() < rate)))
    pages.append((9999, "http://new.two.example/p/x"))
    pages = spark.createDataFrame(pages, "page_id long, url string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    addressed = urlfilter.with_address(pages)
    outcomes = urlfilter.page_outcomes(addressed, labels)
    got = {r.host: r for r in urlfilter.host_reputation(addressed, outcomes).collect()}
    bad, n = got["bad.one.example"].bad, got["bad.one.example"].n
    assert n == 300 and abs(got["bad.one.example"].rate - bad / n) < 0.02
    assert got["rare.one.example"].rate < 0.95 and got["rare.one.example"].bound < got["bad.one.example"].bound
    assert 0 < got["new.two.example"].rate < 0.5 and got["new.two.example"].n == 0
    verdict = {r.host: r.verdict for r in urlfilter.judge_urls(pages, labels, rules=()).collect()}
    assert verdict["bad.one.example"] == "block" and verdict["good.one.example"] == verdict["new.two.example"] == "allow"
