"""Story clustering against brute force."""

import datetime as dt
import itertools
import math
import random

import numpy as np
import pytest

from newsloom.operators import stories
from newsloom.operators.tables import Scratch, connected_components

DAY = dt.datetime(2024, 1, 1)


def titles(n, seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    out = []
    for i in range(n):
        if out and r.random() < 0.5:
            base = r.choice(out)[1].split()
            if base and r.random() < 0.8:
                base[r.randrange(len(base))] = r.choice(words)
            t = " ".join(base)
        else:
            t = " ".join(r.choice(words) for _ in range(r.randint(0, 8)))
        out.append((i, t, None if r.random() < 0.05 else DAY + dt.timedelta(hours=r.randint(0, 300))))
    return out


def brute(rows, hours=72):
    sets = {i: set(t.split()) for i, t, _ in rows}
    df = {}
    for s in sets.values():
        for w in s:
            df[w] = df.get(w, 0) + 1
    idf = {w: math.log(1 + len(rows) / n) for w, n in df.items()}
    at = {i: p for i, _, p in rows}
    pairs = {}
    for a, b in itertools.combinations(sorted(sets), 2):
        if at[a] and at[b] and abs(at[a] - at[b]) > dt.timedelta(hours=hours):
            continue
        common = sets[a] & sets[b]
        if len(common) >= 3:
            sim = sum(map(idf.get, common)) / sum(map(idf.get, sets[a] | sets[b]))
            if sim >= 0.3:
                pairs[a, b] = sim
    return pairs


def closure(ids, pairs):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_and_stories(spark, seed):
    rows = titles(150, seed)
    items = spark.createDataFrame(rows, "id bigint, title string, published timestamp")
    want = brute(rows)
    got = {(r["a"], r["b"]): r["similarity"] for r in stories.similar_pairs(items).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    members = {r["id"]: r["story_id"] for r in stories.stories(items).collect()}
    assert members == closure([i for i, *_ in rows], want)


def test_window_edge(spark):
    same = "alpha beta gamma delta"
    rows = [(1, same, DAY), (2, same, DAY + dt.timedelta(hours=72)), (3, same, DAY + dt.timedelta(hours=145))]
    items = spark.createDataFrame(rows, "id bigint, title string, published timestamp")
    assert {(r["a"], r["b"]) for r in stories.similar_pairs(items).collect()} == {(1, 2)}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (300, 200), (200, 300)]
    got = {r["node"]: r["component"] for r in connected_components(Scratch(spark, "t"), spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys(range(1, 61), 1), **dict.fromkeys(range(100, 150), 100), 200: 200, 300: 200}


def test_no_links(spark):
    assert connected_components(Scratch(spark, "t"), spark.createDataFrame([], "a bigint, b bigint")).count() == 0
    assert stories.stories(spark.createDataFrame([], "id bigint, title string, published timestamp")).count() == 0


def test_online(spark):
    stored = spark.createDataFrame([(1, "port opens new pier today", DAY, 1), (2, "port opens new pier soon", DAY + dt.timedelta(hours=1), 9)], "id bigint, title string, published timestamp, story_id bigint")
    new = spark.createDataFrame([(10, "port opens new pier soon", DAY), (11, "port opens new pier soon", None), (12, "other", DAY), (13, "port opens new pier today", DAY + dt.timedelta(days=9))], "id bigint, title string, published timestamp")
    assert {r["id"]: r["story_id"] for r in stories.assign_online(new, stored).collect()} == {10: 9, 11: 11, 12: 12, 13: 13}


@pytest.mark.parametrize("seed", [4, 5])
def test_classes_of_equal_titles_give_the_closure_of_all_pairs(spark, seed):
    """Many re-publications of the same words, near slot edges, undated ones, titles of two words."""
    r = random.Random(seed)
    titles = ["port opens new pier", "Pier new opens port", "port opens new bridge today", "mayor visits old market hall", "market hall old mayor", "two words", "storm closes coast road north", "storm closes coast road south"]
    rows = [(i, r.choice(titles), None if r.random() < 0.04 else DAY + dt.timedelta(hours=r.choice([0, 71, 72, 73, 144, 145, 200, 217, 300, r.randint(0, 400)]))) for i in range(90)]
    items = spark.createDataFrame(rows, "id bigint, title string, published timestamp")
    pairs = {(x["a"], x["b"]) for x in stories.similar_pairs(items).collect()}
    got = {x["id"]: x["story_id"] for x in stories.stories(items).collect()}
    assert got == closure([i for i, *_ in rows], pairs)


def test_online_against_all_pairs(spark):
    r = random.Random(8)
    vocabulary = [f"word{i}" for i in range(30)] + ["city"] * 20
    title = lambda: " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 9)))
    at = lambda: DAY + dt.timedelta(hours=r.randint(0, 300))
    stored = [(i, title(), None if i % 17 == 0 else at(), None if i % 13 == 0 else i % 40) for i in range(150)]
    new = [(1000 + i, title(), at()) for i in range(120)]
    got = {x["id"]: x["story_id"] for x in stories.assign_online(spark.createDataFrame(new, "id bigint, title string, published timestamp"), spark.createDataFrame(stored, "id bigint, title string, published timestamp, story_id bigint")).collect()}
    for i, t, p in new:
        best = (0, 0, i)
        for j, u, q, story in stored:
            a, b = set(t.split()), set(u.split())
            if q and story is not None and abs(p - q) <= dt.timedelta(hours=72) and len(a & b) >= 3 and len(a & b) / len(a | b) >= 0.3:
                best = max(best, (len(a & b) / len(a | b), -j, story))
        assert got[i] == best[2]


def test_undated_titles_are_compared_by_word_sets(spark, monkeypatch):
    """Copies in many slots: their words are compared once, their rows spelled out in small runs."""
    compared, real = [], stories._set_pairs
    monkeypatch.setattr(stories, "_set_pairs", lambda sets, *a: compared.append(sets.count()) or real(sets, *a))
    monkeypatch.setattr(stories, "ROWS", 2)
    rows = [(i, ("port opens new pier", "port opens new bridge")[i % 2], None if i % 5 == 0 else DAY + dt.timedelta(hours=90 * i)) for i in range(20)]
    items = spark.createDataFrame(rows, "id bigint, title string, published timestamp")
    want = brute(rows)
    got = sorted((r["a"], r["b"]) for r in stories.similar_pairs(items).collect())
    assert got == sorted(want)
    assert {r["id"]: r["story_id"] for r in stories.stories(items).collect()} == closure([i for i, *_ in rows], want)
    assert compared == [2, 2]


def test_forests_join_what_their_links_join():
    r = random.Random(3)
    links = [(r.randrange(300), 300 + r.randrange(300)) for _ in range(400)] + [(i, i + 1) for i in range(1000, 1100)]
    got = stories._spanning(np.array(links))
    ids = {i for link in links for i in link}
    want = closure(ids, links)
    assert closure(ids, map(tuple, got.tolist())) == want and len(got) == len(ids) - len(set(want.values()))
