"""Queries over the whole table: small tables on which a subset of the rows shows."""

import pytest

import __spark_entry__ as entry


@pytest.fixture
def table(spark, tmp_path):
    """Writes documents and labels and gives their folder."""

    def put(docs, labels=()):
        spark.createDataFrame([(i, t, s) for i, t, s in docs], "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
        spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
        return str(tmp_path)

    return put


def rows(spark, name, d):
    return sorted(tuple(r) for r in entry.queries()[name](spark, d).collect())


def test_band_join_reaches_all_ids(spark, table):
    d = table([(i, f"text {i}", "a") for i in (5, 25, 77, 78, 150)])
    assert rows(spark, "band_join_72h_all", d) == [(25, 5), (77, 5), (77, 25), (78, 25), (78, 77), (150, 78)]


def test_jaccard_pairs_of_any_ids(spark, table):
    t = "harbour council approves seaside festival budget"
    d = table([(4, t, "a"), (7, t, "b"), (8, "harbour council approves nothing", "c"), (90, t, "d")])
    assert rows(spark, "similar_pairs_jaccard_all", d) == [(4, 7, 1.0), (4, 8, 0.428571), (7, 8, 0.428571)]


#: One story of three under different openings, and titles of different stories under one opening.
OPENINGS = [
    (1, "local press agency reports quarrel over bridges", "a"),
    (2, "local press agency reports dolphins near lighthouse", "a"),
    (3, "local press agency reports vineyards flooded yesterday", "a"),
    (4, "local press agency reports orchestra visiting Lisbon", "a"),
    (5, "seaside festival budget approved despite protests tonight", "a"),
    (6, "Council: seaside festival budget approved despite protests", "b"),
    (7, "Finally, seaside festival budget approved despite protests", "c"),
]


def test_highlights_go_by_story_size(spark, table):
    import json

    d = table(OPENINGS)
    member = dict(rows(spark, "story_clusters", d))
    assert member[5] == member[6] == member[7] == 5 and member[1] == 1
    top = [i for _, i in rows(spark, "top_highlights_by_story", d)]
    assert top[:3] == [5, 6, 7]
    whole = json.loads(entry.queries()["payload"](spark, d).first()["payload"])
    replicas = {m["id"]: m["r"] for m in whole["items"]}
    assert replicas[5] == replicas[7] == 3 and replicas[1] == 1


def test_stories_are_counted_by_cluster(spark, table):
    d = table(OPENINGS)
    assert rows(spark, "distinct_story_clusters", d) == [(len(set(dict(rows(spark, "story_clusters", d)).values())),)] == [(5,)]


def test_outcome_is_of_the_first_page_of_an_address(spark, table):
    d = table([(i, "the harbour", "a") for i in (5, 6, 12, 13, 18)])
    urls = {5: "https://x.com/1", 6: "https://x.com/1?utm_id=2", 12: "https://x.com/2", 13: "https://www.x.com/2", 18: "https://x.com/3"}
    spark.createDataFrame(list(urls.items()), "page_id bigint, url string").write.parquet(f"{d}/pages.parquet")
    # 6 repeats 5, which is new; 13 repeats 12, which was stored, as was 18
    assert rows(spark, "collection_outcomes", d) == [("new", 1), ("repeated", 2)]
