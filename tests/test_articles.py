import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import NOW, entry_rows, plan_of, rows, ts
from newsboard.operators import articles as A
from newsboard.operators.counting import period_counts, roll_up
from newsboard.operators.unnest import unnest
from newsboard.sources.feed import entries_from_json, explode_items, parse_entries

MS = 1584525600123


def details(spark, docs, **options):
    return A.entry_details(parse_entries(entry_rows(spark, docs)), **options)


def test_alternates_first_and_all(spark):
    docs = [{"id": "a", "alternate": [{"href": "https://x.com/1"}, {"href": "https://y.com/2"}]}, {"id": "b"}]
    assert rows(details(spark, docs), "feedly_id", "alternate_url") == [("a", "https://x.com/1"), ("b", None)]
    assert rows(details(spark, docs, alternates="all"), "feedly_id", "site") == [
        ("a", "x.com"), ("a", "y.com"), ("b", None),
    ]
    with pytest.raises(ValueError):
        details(spark, docs, alternates="some")


def test_site_needs_an_alternate_but_url_does_not(spark):
    docs = [
        {"id": "a", "canonicalUrl": "https://c.com/p"},
        {"id": "b", "alternate": [{"href": "https://www.a.com/x"}], "ampUrl": "https://amp.a.com/x"},
        {"id": "c", "originId": "o"},
    ]
    assert rows(details(spark, docs), "feedly_id", "url", "site") == [
        ("a", "https://c.com/p", None), ("b", "https://amp.a.com/x", "a.com"), ("c", "o", None),
    ]


def test_image_falls_back_only_from_the_word_none(spark):
    two = [{"href": "1"}, {"href": "2"}]
    docs = [
        {"id": "a", "visual": {"url": "none"}, "enclosure": two},
        {"id": "b", "enclosure": two},
        {"id": "c", "visual": {"url": "u"}, "enclosure": two},
        {"id": "d", "visual": json.dumps({"url": "none"}), "enclosure": json.dumps(two)},
        {"id": "e", "visual": {"url": "none"}, "enclosure": two[:1]},
    ]
    assert rows(details(spark, docs), "feedly_id", "image_url") == [
        ("a", "2"), ("b", None), ("c", "u"), ("d", "2"), ("e", None),
    ]


def test_numbers_and_times(spark):
    docs = [
        {"id": "a", "engagement": "x", "crawled": MS, "published": MS},
        {"id": "b", "engagement": 12, "engagementRate": "0.5", "crawled": "bad"},
        {"id": "c"},
    ]
    assert rows(details(spark, docs), "feedly_id", "engagement", "engagement_rate", "crawled_at", "published") == [
        ("a", 0.0, 0.0, ts("2020-03-18T10:00:00.123"), float(MS)),
        ("b", 12.0, 0.5, None, None),
        ("c", 0.0, 0.0, None, None),
    ]


def test_text_blocks_and_summary(spark):
    docs = [
        {"id": "a", "content": {"content": "c"}, "summary": json.dumps({"content": "s"}),
         "leoSummary": {"sentences": [{"text": "t", "position": 1, "score": 0.5}]}},
        {"id": "b"},
    ]
    got = rows(details(spark, docs), "feedly_id", "content", "summary", "leo_summary")
    assert got[0][:3] == ("a", "c", "s")
    assert json.loads(got[0][3]) == [{"text": "t", "position": 1, "score": 0.5}]
    assert got[1] == ("b", None, None, None)


def doc(i, author=None, engagement=0, crawled=MS, site="s.com", title="Same title", **more):
    out = {"id": i, "title": title, "alternate": [{"href": f"https://{site}/{i}"}], "engagement": engagement, **more}
    if author:
        out["author"] = author
    if crawled:
        out["crawled"] = crawled
    return out


def test_dedup_null_order(spark):
    docs = [
        doc("a"), doc("b", author="Ann"),
        doc("c", author="Bob", site="t.com"), doc("d", author="Bob", site="t.com", crawled=None),
        doc("e", author="Eve", site="u.com", engagement=1), doc("f", author="Eve", site="u.com", engagement=2),
        doc("g", site="u.com", title="Other"),
        {"id": "h", "title": "No site 1"}, {"id": "i", "title": "No site 2"},
    ]
    assert [r[0] for r in rows(A.articles(details(spark, docs)), "feedly_id")] == ["b", "d", "f", "g", "h"]


def test_dedup_is_a_subset_with_one_row_per_key_and_limits_groups_before_the_shuffle(spark):
    docs = [doc(f"x{i}", site=f"s{i % 3}.com", engagement=i, title=f"T{'bdlm'[i % 4]}") for i in range(60)]
    all_rows = details(spark, docs)
    kept = A.articles(all_rows)
    assert kept.count() == kept.select("site", "soundex_title").distinct().count() == 12
    assert kept.drop("duplicate_index").exceptAll(all_rows).count() == 0
    plan = plan_of(kept)
    assert plan.count("WindowGroupLimit") >= 2


ITEMS = {
    "id": "a", "title": "t",
    "commonTopics": [{"id": "1", "label": "x", "score": 0.5, "salienceLevel": "about"}, {"id": "2", "label": "y"}],
    "entities": json.dumps([{"id": "e", "label": "E", "salienceLevel": "m"}]),
    "keywords": ["k1", "k2"],
    "leoSummary": {"sentences": [{"text": "late", "position": 2, "score": 1}, {"text": "early", "position": 1}]},
    "priorities": [
        {"id": "p", "label": "P", "searchTerms": {"parts": [{"id": "s1", "label": "S1"}, {"id": "s2", "label": "S2"}]}},
        json.dumps({"id": "q", "label": "Q", "searchTerms": {"parts": []}}),
    ],
}
BARE = {"id": "b", "title": "u", "commonTopics": [], "entities": [{"id": "f", "label": "F"}]}


def test_item_views(spark):
    arts = details(spark, [ITEMS, BARE])
    topics = A.common_topics(arts)
    assert rows(topics, "feedly_id", "topic_id", "topic_label", "topic_score", "topic_salince_level") == [
        ("a", "1", "x", 0.5, "about"), ("a", "2", "y", None, None),
    ]
    assert rows(A.topic_list(topics)) == [("1", "x"), ("2", "y")]
    assert rows(A.entity_list(A.feed_entities(arts))) == [("e", "E"), ("f", "F")]
    assert rows(A.keyword_list(A.keywords(arts))) == [("k1",), ("k2",)]
    assert rows(A.summary_sentences(arts), "summary_sentence", "summary_sentence_position", "summary_sentence_score") == [
        ("early", 1, None), ("late", 2, 1.0),
    ]
    assert rows(arts.select("feedly_id", A.sentence_texts(F.col("sentences")).alias("s"))) == [
        ("a", ["early", "late"]), ("b", [None]),
    ]
    assert rows(A.priorities(arts), "priority_id", "search_term_id", "search_term_label") == [
        ("p", "s1", "S1"), ("p", "s2", "S2"),
    ]
    assert rows(A.entities_by_topics(arts), "feedly_id", "entity_id", "topic_id") == [
        ("a", "e", "1"), ("a", "e", "2"), ("b", "f", None),
    ]
    assert rows(A.entities_by_keywords(arts), "feedly_id", "entity_id", "keyword") == [
        ("a", "e", "k1"), ("a", "e", "k2"), ("b", "f", None),
    ]
    pairs = A.cooccurrence(A.feed_entities(arts), A.keywords(arts))
    assert rows(pairs, "entity_id", "keyword") == rows(A.entities_by_keywords(arts), "entity_id", "keyword")


def test_unnest_stays_in_step_and_parses_the_document_once(spark):
    arts = details(spark, [ITEMS])
    assert A.common_topics(arts).count() == 2
    physical = A.common_topics(arts)._jdf.queryExecution().executedPlan().toString()
    # One parse of the payload and one of the topic text.
    assert physical.count("from_json(") == 2
    array = spark.createDataFrame([([1, None],), ([],), (None,)], "x array<int>")
    assert rows(unnest(array, F.col("x"), "i")) == [(1,), (None,)]


def test_period_counts_and_roll_up(spark):
    data = [("a", ts("2020-03-16T01:00:00"), "x"), ("b", ts("2020-03-18T01:00:00"), "x"),
            ("c", ts("2020-03-18T23:59:00"), "x"), ("d", ts("2020-03-18T05:00:00"), "y"),
            ("e", ts("2020-03-18T05:00:00"), None), ("f", ts("2020-03-18T05:00:00"), None)]
    df = spark.createDataFrame(data, "feedly_id string, published_at timestamp_ntz, keyword string")
    assert rows(period_counts(df, "keyword", "day")) == [
        ("day", ts("2020-03-18"), "x", 2), ("day", ts("2020-03-18"), None, 2),
    ]
    week = period_counts(df, "keyword", "week")
    assert rows(week) == [("week", ts("2020-03-16"), "x", 3), ("week", ts("2020-03-16"), None, 2)]
    daily = period_counts(df, "keyword", "day", min_freq=1)
    assert rows(roll_up(daily, "keyword", "week")) == rows(week)


def ranking_articles(spark):
    at = ts("2020-03-18T12:00:00")
    data = []
    for i in range(60):
        published = at + timedelta(days=(i % 9) - 4, hours=i % 5)
        data.append((f"a{i}", published, 1.0, float(i % 25) / 10))
    data.append(("month", ts("2020-03-02T12:00:00"), 1.0, 9.0))
    return spark.createDataFrame(data, "feedly_id string, published_at timestamp_ntz, engagement double, engagement_rate double")


@pytest.mark.parametrize("k", [3, 20])
def test_article_rankings_equal_plain_windows(spark, k):
    arts = ranking_articles(spark)
    arts.createOrReplaceTempView("ranking_articles")
    week = ts("2020-03-16")
    local = "published_at - INTERVAL 5 HOURS"
    ranks = ", ".join(
        f"dense_rank() OVER (PARTITION BY date_trunc('{g}', {local}) ORDER BY engagement_rate DESC) AS {g}_rank"
        for g in ("day", "week", "month")
    )
    want = spark.sql(
        f"SELECT feedly_id, day_rank, week_rank, month_rank FROM (SELECT *, {ranks} FROM ranking_articles)"
        f" WHERE date_trunc('week', {local}) = TIMESTAMP '2020-03-16' AND week_rank <= {k}"
    )
    got = A.article_rankings(arts, week, k)
    assert rows(got, "feedly_id", "popularity_by_day", "popularity_by_week", "popularity_by_month") == rows(want)


def test_feed_envelopes(spark):
    docs = [json.dumps({"items": [{"id": "a", "published": MS, "title": "t"}, {"id": "b", "published": "x"}]}),
            '{"items": [{"id": "c", "published": 1.584525600123E12}, {"id": "d", "published": 1584525600000.0}, {"id": "e", "published": 1e300}]}',
            '{"error": 1}', "not json"]
    items = explode_items(spark.createDataFrame([(d,) for d in docs], "value string"))
    entries = entries_from_json(items, "payload", NOW)
    assert rows(entries, "feedly_id", "published_at", "created_at") == [
        ("a", ts("2020-03-18T10:00:00"), NOW), ("b", None, NOW), ("c", ts("2020-03-18T10:00:00"), NOW),
        ("d", ts("2020-03-18T10:00:00"), NOW), ("e", None, NOW),
    ]
    first = entries.where("feedly_id = 'a'").first()["payload"]
    assert json.loads(first)["title"] == "t"
