"""Connected components: results on odd graphs, and how many steps and files they take."""

import random
from importlib import import_module

import pytest

components = import_module("stationlake.llm.components")


def brute_roots(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {x: find(x) for x in parent}


def rows_of(df):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(dict(got))  # one row per node
    return dict(got)


def odd_links():
    rng = random.Random(3)
    chain = list(range(-60, 60))
    rng.shuffle(chain)
    links = list(zip(chain, chain[1:]))  # a path in no order, negative ids among it
    links += [(1000, x) for x in range(1001, 1200)] + [(x, 2000) for x in range(1900, 2000)]  # two hubs
    links += [(rng.randrange(3000, 3200), rng.randrange(3000, 3200)) for _ in range(120)]
    return links + links[:50] + [(b, a) for a, b in links[-50:]] + [(7000, 7000), (1000, 1000)]


@pytest.mark.parametrize("rows", [100_000, 7])
def test_against_union_find(spark, monkeypatch, rows):
    monkeypatch.setattr(components, "ROWS", rows, raising=False)
    links = odd_links()
    assert rows_of(components.components(spark.createDataFrame(links, "a long, b long"))) == brute_roots(links)


@pytest.mark.parametrize("links", [[], [(5, 5)]])
def test_no_links(spark, links):
    assert rows_of(components.components(spark.createDataFrame(links, "a long, b long"))) == {}


@pytest.fixture()
def steps(spark, monkeypatch):
    """(name, files) of each staged step, with many shuffle partitions that nothing puts together."""
    found, plain = [], components.staged

    def recorded(df, name):
        out = plain(df, name)
        found.append((name, len(out.inputFiles())))
        return out

    monkeypatch.setattr(components, "staged", recorded)
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield found
    for k, v in before.items():
        spark.conf.set(k, v)


def test_files_follow_the_links_not_the_shuffle_partitions(spark, steps):
    links = odd_links()
    assert rows_of(components.components(spark.createDataFrame(links, "a long, b long"))) == brute_roots(links)
    assert len(steps) > 5 and all(files == 1 for name, files in steps if name != "links")


def test_stars_are_seen_at_once(spark, steps):
    links = [(100, x) for x in range(101, 140)] + [(x, 200) for x in (201, 250)]
    assert rows_of(components.components(spark.createDataFrame(links, "a long, b long"))) == brute_roots(links)
    assert [name for name, _ in steps] == ["links", "star"]
