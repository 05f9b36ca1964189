from stratamill.llm.reputation import URL_RULES, url_filter

PAGES = "page_id long, url string, html string, verdict string, bad int"


def expected_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[end:]
    stop = min((path.index(c) for c in "?#" if c in path), default=len(path))
    return "".join(c.lower() if c.isascii() else c for c in rest[:end]), path[:stop]


def expected_rule(host, path):
    fitting = [
        r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fitting, key=lambda r: len(r.name), default=None)


URLS = [
    None,
    "",
    "no scheme.com/x",
    "http://",
    "https://WWW.Example.COM/en/1?x=1#y",
    "http://a.example.com/en/",
    "http://example.com/en",
    "http://example.com",
    "http://xexample.com/en/2",
    "http://www.example.com/en/../x",
    "http://b.net/es/1",
    "http://b.net/fr/",
    "http://b.net/de/",
    "http://b.net?/es/",
    "http://É.net/fr/x",
    "ftp://h.org/a://b/c",
    "http://com/x\ny",
    "a://b#c",
]


def table(spark, rows):
    return spark.createDataFrame([(k, u, None, "x", 1) for k, u in rows], PAGES)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_parts_and_rules(spark):
    rows = list(enumerate(URLS))
    found = {r["page_id"]: r for r in url_filter(table(spark, rows), labels(spark, [])).collect()}
    for key, url in rows:
        host, path = expected_parts(url)
        rule = expected_rule(host, path)
        r = found[key]
        assert (r["host"], r["path"]) == (host, path)
        assert (r["rule"], r["verdict"]) == ((rule.name, rule.verdict) if rule else (None, "allow"))


def test_reputation_shrinks_and_blocks(spark):
    rows = [(i, f"http://bad.farm.org/{i}") for i in range(60)]
    rows += [(100 + i, f"http://good{i % 6}.fine.org/{i}") for i in range(120)]
    rows += [(300, "http://one.other.org/"), (301, "http://unseen.farm.org/"), (302, "http://bad.farm.org/x"), (302, "http://bad.farm.org/x")]
    outcomes = [(i, 0, None) for i in range(60)] + [(100 + i, 1, int(i % 20 == 0)) for i in range(120)]
    outcomes += [(300, 0, 0), (None, 0, 1), (5, None, None), (100, 1, 0)]
    found = url_filter(table(spark, rows), labels(spark, outcomes)).collect()
    assert len(found) == len(rows)
    by_host = {r["host"]: r for r in found}
    bad, good, one, unseen = (by_host[h] for h in ("bad.farm.org", "good0.fine.org", "one.other.org", "unseen.farm.org"))
    assert bad["verdict"] == "block" and bad["n_labelled"] == 60
    assert good["verdict"] == "allow" and 0 < good["posterior_mean"] < 0.2
    # One bad page is no reason to block; a new host of a bad domain gets the domain's mean, not its certainty.
    assert one["verdict"] == "allow" and one["posterior_mean"] < 1
    assert unseen["n_labelled"] == 0 and good["posterior_mean"] < unseen["posterior_mean"] < bad["posterior_mean"]


def test_empty_tables(spark):
    assert url_filter(table(spark, []), labels(spark, [])).count() == 0
    assert url_filter(table(spark, []), labels(spark, [(1, 0, 1)])).count() == 0
