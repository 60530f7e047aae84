"""URL filter: listed rules and mined rules against brute force."""

import itertools
import math
import random
import re

from stationlake.llm import urlfilter as U

DIR = "/root/testdata/sf0.1"
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def listed(host, path):
    fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return (best[1] + best[2], best[0]) if best else (None, None)


def tokens(url):
    host, path = split_url(url)
    query = (re.search(r"\?([^#]*)", url) or [None, ""])[1]
    words = lambda s, m: {m + w for w in re.split(r"[\W_]+", s.lower()) if w and not re.fullmatch("[0-9]+", w)}
    return words(host, "h:") | words(path, "p:") | words(query, "q:")


def brute_rules(known):
    """``known`` [(tokens, blocked)] → minimal sure token sets, by listing every subset."""
    bad = [t for t, b in known if b]
    if len(bad) < U.MIN_COUNT:
        return []
    base, least = len(bad) / len(known), max(math.ceil(U.MIN_SUPPORT * len(bad)), U.MIN_COUNT)

    def is_sure(c, tried):
        k, n = sum(set(c) <= t for t in bad), sum(set(c) <= t for t, _ in known)
        q = k / n
        kl = (q * math.log(q / base) if q else 0) + ((1 - q) * math.log((1 - q) / (1 - base)) if q < 1 else 0)
        return q >= U.MIN_CONFIDENCE and q > base and n * kl >= math.log(tried / U.CHANCE)

    def frequent(token_sets, sizes):
        count = {}
        for t in token_sets:
            for k in sizes:
                for c in itertools.combinations(sorted(t), k):
                    count[c] = count.get(c, 0) + 1
        return [c for c, n in count.items() if n >= least]

    singles = frequent(bad, [1])
    rules = [c for c in singles if is_sure(c, len(singles))]
    where = {}
    for (t,) in sorted(set(singles) - set(rules)):
        where.setdefault(frozenset(i for i, (ts, _) in enumerate(known) if t in ts), t)
    left = [t & set(where.values()) for t in bad]
    sets = frequent(left, range(2, max(map(len, left), default=0) + 1))
    found = [c for c in sets if is_sure(c, len(sets))]
    return rules + [c for c in found if not any(set(o) < set(c) for o in found)]


def test_query_against_brute_force(spark):
    pages = spark.read.parquet(f"{DIR}/pages.parquet").select("page_id", "url").collect()
    labels = {r.doc_id: r.quality == 0 or r.toxic == 1 for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    known = []
    for p in pages:
        t = tokens(p.url)
        number = int((re.search(r"([0-9]+)[^0-9]*$", split_url(p.url)[1]) or [0, "-1"])[1])
        seeded = any(f"h:{w}" in t for w in U.SEED_WORDS)
        if t and (seeded or number in labels):
            known.append((t, seeded or labels[number]))
    rules = brute_rules(known)
    assert rules and not any("p:fr" in c for c in rules)  # nothing learned by chance from a language's path
    got = {r.page_id: r for r in U.op9_url_filter(spark, DIR).collect()}
    assert len(got) == len(pages)
    for p in pages:
        host, path = split_url(p.url)
        rule, verdict = listed(host, path)
        mined = any(set(c) <= tokens(p.url) for c in rules)
        assert tuple(got[p.page_id])[1:] == (host, path, rule, verdict or ("block" if mined else "allow")), p.url


def planted():
    """Urls whose four tokens a, b, c, d are only together a sign of a blocked url, and noise."""
    rng = random.Random(4)
    known = [({"a", "b", "c", "d", f"x{i % 7}"}, True) for i in range(60)]
    for three in itertools.combinations("abcd", 3):
        known += [({*three, f"x{i % 7}"}, False) for i in range(40)]
    known += [({f"x{rng.randrange(7)}", f"y{rng.randrange(9)}", "www"}, rng.random() < 0.2) for _ in range(800)]
    return known


def frame(spark, known):
    return spark.createDataFrame([(sorted(t), b) for t, b in known], "tokens array<string>, blocked boolean")


def test_rules_of_any_length_against_brute_force(spark):
    known = planted()
    rules = {tuple(r["items"]): r for r in U.mine_rules(frame(spark, known)).collect()}
    assert set(rules) == set(brute_rules(known)) and ("a", "b", "c", "d") in rules
    r = rules[("a", "b", "c", "d")]
    assert (r.blocked_urls, r.urls, r.confidence) == (60, 60, 1.0)


def test_a_long_url_that_repeats_is_not_all_its_subsets(spark):
    """Forty tokens, a thousand times, blocked or mixed: one token stands for those that always go together."""
    long = {f"t{i:02}" for i in range(40)}
    known = planted() + [(long, i % 2 == 0) for i in range(1000)]
    rules = {tuple(r["items"]) for r in U.mine_rules(frame(spark, known)).collect()}
    assert ("a", "b", "c", "d") in rules and not any(set(r) & long for r in rules)
    rules = {tuple(r["items"]) for r in U.mine_rules(frame(spark, planted() + [(long, True)] * 1000)).collect()}
    assert {(t,) for t in long} <= rules


def test_labels_go_by_the_document_number_of_the_url(spark):
    pages = spark.createDataFrame([(1, "http://a.com/en/70.html?x=3"), (2, "http://b.com/en/1/"), (3, "http://c.com/x?9"), (70, "http://d.com/")],
                                  "page_id long, url string")
    labels = spark.createDataFrame([(70, 0, 0), (70, 1, 0), (1, 1, None), (9, 0, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    got = {tuple(sorted(r.tokens)): r.blocked for r in U.label_urls(pages, labels).collect()}
    assert got == {("h:a", "h:com", "p:en", "p:html", "q:x"): True, ("h:b", "h:com", "p:en"): False}


def test_listed_rules_and_odd_urls(spark):
    urls = [None, "", "no scheme.net/", "http://x.NET/a", "http://x.net", "https://a.example.net/en/1?q#f", "http://example.net/en",
            "http://xexample.com/de/", "http://b.example.com/de/2", "http://org/fr/x", "ftp://u.org/fr/://y", "http://h?x/y", "http://h#z",
            "http://notnet/", "http://é.net/x", "http://" + "a" * 100_000 + ".net/", "http://x.net/a", "://net/", "http://a\nb.net/p\nq"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'q' AS host", "1 AS verdict", "'t' AS tokens")
    none = spark.createDataFrame([], "items array<string>, token string")
    got = {r.page_id: r for r in U.judge_urls(df, none).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path = split_url(u)
        rule, verdict = listed(host, path)
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict, got[i].tokens) == (host, path, rule, verdict or "allow", "t"), u


def test_no_labels_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x"), (1, "http://a.com/x"), (None, None)], "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert U.mine_rules(U.label_urls(pages, labels)).count() == 0
    assert U.judge_urls(pages, U.mine_rules(U.label_urls(pages, labels))).count() == 3
    assert U.judge_urls(pages.limit(0), U.mine_rules(U.label_urls(pages.limit(0), labels))).count() == 0
