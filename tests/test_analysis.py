import pytest
from pyspark.sql import functions as F

from helpers import NOW, analysis_rows, entry_rows, rows, ts
from newsboard.operators import analysis as N
from newsboard.operators import register as R
from newsboard.operators import sectors as S
from newsboard.operators.articles import entry_details
from newsboard.sources.feed import parse_analyses, parse_entries
from newsboard.sources.schemas import REGISTER
from newsboard.sources.seeds import conform


def arts(spark, *ids):
    return entry_details(parse_entries(entry_rows(spark, [{"id": i, "title": i} for i in ids])))


def parsed(spark, docs):
    return parse_analyses(analysis_rows(spark, docs))


def orgs(spark, data):
    df = spark.createDataFrame(data, "uuid string, name string, permalink string, category_list string, category_groups_list string")
    return conform(df, REGISTER["organizations"])


def entity(id, pos=0, types=("Company",), **more):
    return {"type": list(types), "entityEnglishId": id, "startingPos": pos, "matchingTokens": [pos], **more}


def test_topics_categories_text(spark):
    docs = {
        "a": {"topics": [{"id": 0, "label": "x", "score": 0.5, "wikiLink": "w", "wikidataId": "Q1"}],
              "categories": [{"id": 1, "label": "c", "score": "0.25", "categoryId": "9", "classifierId": "m"}],
              "cleanedText": "text"},
        "gone": {"topics": [{"id": 0, "label": "y"}]},
        "b": None,
    }
    a, p = arts(spark, "a", "b"), parsed(spark, docs)
    assert rows(N.analysis_topics(a, p)) == [("a", 0, "x", 0.5, "w", "Q1")]
    assert rows(N.analysis_categories(a, p), "feedly_id", "category_position", "category_score", "classifier_id") == [
        ("a", 1, 0.25, "m")
    ]
    assert rows(N.analysis_text(a, p), "feedly_id", "full_text") == [("a", "text"), ("b", None)]


def test_entity_types_are_unnested_with_their_entity(spark):
    docs = {"a": {"entities": [entity("e", types=["A", "B"]), {"entityEnglishId": "none"}, entity("empty", types=[])]}}
    got = N.entity_mentions(arts(spark, "a"), parsed(spark, docs))
    assert rows(got, "entity_type", "entity_id") == [("A", "e"), ("B", "e")]


def test_rollup_keeps_positions_and_counts_ids(spark):
    docs = {"a": {"entities": [
        entity("e", 1, relevanceScore=0.1, confidenceScore=1), entity("e", 1, relevanceScore=0.3),
        entity("e", 2), {"type": ["Company"], "startingPos": 9, "wikiLink": "w"},
    ]}}
    got = N.analysis_entities(arts(spark, "a"), parsed(spark, docs))
    assert rows(got, "entity_id", "starting_pos", "relevance_score", "confidence_sore", "mentions", "entity_external_id") == [
        ("e", 1, 0.3, 1.0, 2, None), ("e", 2, None, None, 1, None), (None, 9, None, None, 0, "w"),
    ]


def test_company_pick_and_register(spark):
    docs = {"a": {"entities": [
        entity("Beta", 1, crunchbaseId="b", relevanceScore=0.2), entity("Alpha", 2, crunchbaseId="b", relevanceScore=0.1),
        entity("Person", 3, types=["Person"], crunchbaseId="p"), entity("Org", 4, types=["Organisation"], wikiLink="w"),
        entity("No id", 5),
    ]}}
    register = orgs(spark, [("u1", "B Inc", "b", "x,y", ""), ("u2", "None", None, "z", None)])
    got = N.resolve_companies(N.analysis_entities(arts(spark, "a"), parsed(spark, docs)), register)
    assert rows(got, "entity_id", "entity_external_id", "uuid", "name", "relevance_score", "categories", "category_groups") == [
        ("Alpha", "b", "u1", "B Inc", 0.1, ["x", "y"], []),
        ("No id", None, None, None, None, None, None),
        ("Org", "w", None, None, None, None, None),
    ]


def test_register_lists(spark):
    register = orgs(spark, [("1", "A", "a", "a, b", "g"), ("2", "B", "b", "", None), ("3", "C", "c", None, "g,h")])
    assert rows(R.org_categories(register)) == [("1", "A", " b"), ("1", "A", "a")]
    assert rows(R.org_category_groups(register)) == [("1", "A", "g"), ("3", "C", "g"), ("3", "C", "h")]
    text = spark.createDataFrame([("1", "n", "p", "x,y"), ("2", "m", "q", "x")], "id string, name string, permalink string, category_groups_list string")
    array = text.withColumn("category_groups_list", F.split("category_groups_list", ","))
    for groups in (text, array):
        assert rows(R.category_map(groups)) == [("1", "n", "p", "x"), ("1", "n", "p", "y"), ("2", "m", "q", "x")]
        assert rows(R.category_list(groups)) == [("1", "n", "p"), ("2", "m", "q")]
        assert rows(R.group_list(groups)) == [("x",), ("y",)]


def topic_rows(spark, data):
    return spark.createDataFrame(data, "feedly_id string, topic_label string, topic_score double")


def test_topic_filter(spark):
    labels = ["Virtual reality", "Machine learning", "Reality television", "Sport", None]
    topics = topic_rows(spark, [("a", x, 1.0) for x in labels])
    assert rows(N.matching_labels(topics)) == [("Machine learning",), ("Virtual reality",)]


LABELS = ["Virtual machine", "Virtual machines", "Virtual machines", "Virtual reality", "Machine learning", "Sport"]


@pytest.mark.parametrize("distinct", [False, True])
@pytest.mark.parametrize("drop", [N.STOP_LABELS, (), ("Virtual machine",)])
@pytest.mark.parametrize("mapping", [N.CANONICAL_LABELS, {}, {"Virtual machine": "Sport", "Machine learning": "Sport"}])
def test_subject_topics_equal_the_join_with_the_label_list(spark, distinct, drop, mapping):
    topics = topic_rows(spark, [(f"a{i}", x, float(i)) for i, x in enumerate([*LABELS, None])])
    labels = N.canonical_labels(N.matching_labels(topics), mapping, drop)
    want = N.topics_with_labels(topics, labels, distinct)
    got = N.subject_topics(topics, mapping=mapping, drop=drop, distinct_topics=distinct)
    assert rows(got, "feedly_id", "topic_label", "topic_score") == rows(want, "feedly_id", "topic_label", "topic_score")


def test_singular_mentions_drop_and_plural_ones_double(spark):
    topics = topic_rows(spark, [("a", "Virtual machine", 1.0), ("b", "Virtual machines", 1.0)])
    assert rows(N.canonical_labels(N.matching_labels(topics))) == [("Virtual machines",)] * 2
    assert rows(N.subject_topics(topics), "feedly_id") == [("b",), ("b",)]
    assert rows(N.subject_topics(topics, distinct_topics=True), "feedly_id") == [("b",)]


def test_uncovered_types(spark):
    seen = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "entity_type string")
    rules = spark.createDataFrame([("B",), ("C",)], "entity_type string")
    assert rows(N.uncovered_types(seen, rules)) == [("A",), (None,)]


def test_themed_mentions(spark):
    entities = spark.createDataFrame(
        [("a", "SportsTeam", "t", 0.2, 1.5), ("a", "SportsTeam", "low", 0.2, 1.0), ("a", "Event", "e", 0.9, 2.0),
         ("b", "BaseballLeague", "old", 0.9, 2.0)],
        "feedly_id string, entity_type string, entity_id string, relevance_score double, confidence_sore double",
    )
    articles = arts(spark, "a").unionByName(arts(spark, "b").withColumn("created_at", F.lit(ts("2020-03-01")).cast("timestamp_ntz")))
    topics = topic_rows(spark, [("a", "Machine learning", 0.2), ("a", "Virtual machines", 0.1), ("b", "Machine learning", 0.9)])
    got = N.themed_mentions(entities, articles, N.subject_topics(topics), N.THEMES["sports"], ts("2020-03-01"))
    assert rows(got, "entity_id") == [("t",)]
    assert N.themed_mentions(entities, articles, N.subject_topics(topics), N.THEMES["events"], ts("2020-03-01")).count() == 1


def sector_inputs(spark):
    articles = arts(spark, "a", "b", "c")
    topics = topic_rows(spark, [
        ("a", "Virtual x", 0.5), ("a", "Learning y", 0.1), ("a", "Sport", 0.9),
        ("b", "Virtual z", 0.1), ("b", "Virtual q", None), ("c", "Virtual z", 0.2),
    ])
    companies = spark.createDataFrame(
        [("a", "e1", "u1", "N1", 0.1, ["k1", "k2"], ["g"]), ("a", "e2", None, None, 0.9, None, None),
         ("b", None, None, None, 0.4, None, None), ("b", "e4", "u4", "N4", 0.1, ["k3"], []),
         ("c", "e5", "u5", "N5", None, ["k5"], ["g5"])],
        "feedly_id string, entity_id string, uuid string, name string, relevance_score double,"
        " categories array<string>, category_groups array<string>",
    ).withColumns({c: F.lit(None).cast("string") for c in ("country_code", "city", "region", "confidence_sore")})
    return articles, topics, companies


def test_company_articles_multiply_by_design(spark):
    got = S.company_articles(*sector_inputs(spark))
    first = got.where("feedly_id = 'a' and name = 'N1'")
    assert first.count() == 2 * 2 * 1
    assert rows(got.where("name = 'e2'"), "topic_label", "category", "category_group") == [
        ("Learning y", None, None), ("Virtual x", None, None),
    ]
    assert first.first()["published_week"] == ts("2020-03-16")


@pytest.mark.parametrize("min_score", [None, 0.3, 0.45, 0.95])
def test_article_sectors_equal_sets_over_the_product(spark, min_score):
    articles, topics, companies = sector_inputs(spark)
    product = S.company_articles(articles, topics, companies)
    if min_score is not None:
        product = product.where((F.col("topic_score") >= min_score) | (F.col("relevance_score") >= min_score))
    sets = lambda c: F.array_sort(F.collect_set(c))
    want = product.groupBy("feedly_id").agg(
        sets("topic_label"), F.when(F.size(sets("category")) > 0, sets("category")),
        F.when(F.size(sets("category_group")) > 0, sets("category_group")),
        F.concat(sets("name"), F.when(F.bool_or(F.col("name").isNull()), F.array(F.lit(None).cast("string")))
                 .otherwise(F.array().cast("array<string>"))),
    )
    got = S.article_sectors(topics, companies, min_score=min_score)
    assert rows(got) == rows(want)
