import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import NOW, entry_rows, rows, ts
from newsboard.functions import captions as C
from newsboard.operators import digests as D
from newsboard.operators import routing as T
from newsboard.operators.articles import entry_details
from newsboard.operators.sectors import article_sectors
from newsboard.sources.feed import parse_entries
from newsboard.sources.schemas import CHANNEL_CONCEPTS, CHANNELS, CONCEPTS, RULES
from newsboard.sources.seeds import conform, default_seeds

AS_OF = ts("2020-03-18T12:00:00")


def articles(spark, docs):
    return entry_details(parse_entries(entry_rows(spark, docs)))


def topics(spark, data):
    return spark.createDataFrame(data, "feedly_id string, topic_label string, topic_score double")


def companies(spark, data):
    return spark.createDataFrame(
        data,
        "feedly_id string, entity_id string, name string, relevance_score double,"
        " categories array<string>, category_groups array<string>",
    )


def entities(spark, data):
    return spark.createDataFrame(
        data, "feedly_id string, entity_type string, entity_id string, confidence_sore double, relevance_score double"
    )


def tables(spark, rules, links=((1, 1),)):
    channels = [(1, "Sports", "slack", "#sports", ":s:", AS_OF), (2, "Fresh", "mail", "x", None, None)]
    return {
        "rules": conform(
            spark.createDataFrame(
                rules,
                "concept_id long, entity_type string, entity_confidence_score_threshold double,"
                " entity_relevance_score_threshold double, topic_score_threshold double, emoji_icon string",
            ), RULES),
        "concepts": conform(spark.createDataFrame([(1, "Play"), (2, "Work")], "id long, name string"), CONCEPTS),
        "channel_concepts": conform(spark.createDataFrame(list(links), "channel_id long, concept_id long"), CHANNEL_CONCEPTS),
        "channels": conform(
            spark.createDataFrame(channels, "id long, name string, target string, target_id string, emoji_icon string, last_sent_at timestamp_ntz"),
            CHANNELS),
    }


def test_match_rules(spark):
    rules = tables(spark, [(1, "Team", 1.0, 0.2, 0.2, ":r:"), (2, "Team", 1.0, 0.2, 0.5, None), (1, "Other", 0.0, 0.0, 0.0, None)])["rules"]
    found = entities(spark, [("a", "Team", "hit", 1.0, 0.2), ("a", "Team", "hit", 3.0, 0.9), ("a", "Team", "low", 0.999, 0.9),
                             ("a", "Team", "dim", 1.0, 0.199), ("a", "Free", "x", 9.0, 9.0), ("a", "Team", "none", None, 0.9)])
    assert rows(T.match_rules(found, rules), "entity_id", "concept_id", "topic_threshold") == [("hit", 1, 0.2), ("hit", 2, 0.5)]


RULES_ROWS = [(1, "Team", 1.0, 0.2, 0.2, ":r:"), (2, "Team", 1.0, 0.2, 0.5, None)]


def routed(spark, links=((1, 1), (1, 1), (1, 2), (2, 2)), entity_id="E"):
    t = tables(spark, RULES_ROWS, links)
    arts = articles(spark, [{"id": "a", "title": "T", "leoSummary": {"sentences": [{"text": "s"}]}}, {"id": "b"}])
    found = entities(spark, [("a", "Team", entity_id, 1.0, 0.2), ("a", "Team", entity_id, 2.0, 0.3), ("b", "Team", "F", 1.0, 0.2)])
    on = topics(spark, [("a", "Virtual x", 0.4), ("a", "Virtual x", 0.1), ("a", "Learning", 0.6), ("b", "Virtual x", 0.1)])
    return T.route(arts, found, on, t["rules"], t["concepts"], t["channel_concepts"], t["channels"]), arts, on, t


def test_route(spark):
    got, *_ = routed(spark)
    assert rows(got, "channel_id", "concept_name", "topic_label") == [
        (1, "Play", "Learning"), (1, "Play", "Virtual x"), (1, "Work", "Learning"), (2, "Work", "Learning"),
    ]
    assert got.select("identifier").distinct().count() == 4
    play = got.where("concept_name = 'Play' AND topic_label = 'Learning'").first()
    assert play["identifier"] == "1-play-slack-#sports-sports-a-team-e-learning"
    assert (play["concept_rule_emoji_icon"], play["summary_sentences"], play["published_at_with_tz"]) == (
        ":r:", ["s"], ts("2020-03-18T07:00:00"))


def test_identifier_is_null_without_an_entity_id(spark):
    got, *_ = routed(spark, entity_id=None)
    assert {r["identifier"] for r in got.collect()} == {None}


def delivered(spark, created=AS_OF + timedelta(seconds=1)):
    got, arts, on, t = routed(spark)
    arts = arts.withColumn("created_at", F.lit(created).cast("timestamp_ntz"))
    sectors = article_sectors(on, companies(spark, [("a", "c", "Corp", 0.5, ["k"], []), ("a", "d", None, 0.1, ["j"], None)]))
    details = T.channel_details(got, sectors)
    return arts, details, t


def test_channel_details(spark):
    _, details, _ = delivered(spark)
    first = details.where("channel_id = 1").first()
    assert first["concept_names"] == ["Play", "Work"]
    assert first["concept_emoji_icons"] is None and first["concept_rule_emoji_icons"] == [":r:"]
    assert first["topic_labels"] == ["Learning", "Virtual x"]
    assert (first["categories"], first["category_group"], first["company_names"]) == (["j", "k"], None, ["Corp", "d"])
    assert first["summary_sentences"] == ["s"]
    got, _, on, _ = routed(spark)
    none = T.channel_details(got, article_sectors(on, companies(spark, [("z", "z", "Z", 1.0, [], [])])))
    assert {tuple(r["company_names"]) for r in none.collect()} == {(None,)}


@pytest.mark.parametrize(
    "created, mode, channels",
    [(AS_OF + timedelta(seconds=1), "never", [1]), (AS_OF, "never", []), (AS_OF, "always", [2]),
     (AS_OF + timedelta(seconds=1), "always", [1, 2])],
)
def test_unsent(spark, created, mode, channels):
    arts, details, t = delivered(spark, created)
    assert [r[0] for r in rows(T.unsent(arts, details, t["channels"], mode), "channel_id")] == channels


def test_unsent_rejects_other_modes(spark):
    arts, details, t = delivered(spark)
    with pytest.raises(ValueError):
        T.unsent(arts, details, t["channels"], "maybe")


def test_outbox(spark):
    arts, details, t = delivered(spark)
    unsent = T.unsent(arts, details, t["channels"], "always")
    got = T.outbox(unsent, "slack", NOW).collect()
    assert len(got) == 1
    message = got[0]
    assert message["channel"] == "#sports"
    assert message["text"] == "I found a new article about :s: Sports.\n\nIt mentions Learning - Virtual x."
    assert message["headline"] == ":postbox: <|T>"
    assert message["captions"] == [
        "*Companies and Organizations:* Corp - d", "*XR Topics:* Learning - Virtual x", "*Market:* j - k",
    ]
    assert message["bullets"] == "* s"
    assert message["author_line"] == "*Author:*  on Mar 18,  7:00 AM"
    assert NOW <= message["post_at"] <= NOW + timedelta(minutes=10)
    item = json.loads(message["item"])
    assert item["channel_id"] == 1 and item["category_group"] is None and "image_url" in item
    assert T.outbox(unsent, "mail", NOW).first()["text"].startswith("I found a new article about  Fresh.")


def test_watermarks_only_move_forward(spark):
    channels = conform(
        spark.createDataFrame([(1, AS_OF), (2, AS_OF), (3, None), (4, AS_OF)], "id long, last_sent_at timestamp_ntz"), CHANNELS)
    sent = spark.createDataFrame(
        [(1, AS_OF - timedelta(days=1)), (2, AS_OF + timedelta(days=1)), (2, AS_OF), (3, AS_OF)],
        "channel_id long, created_at timestamp_ntz")
    moved = T.advance_watermarks(channels, sent)
    assert moved.columns == channels.columns
    assert rows(moved, "id", "last_sent_at") == [(1, AS_OF), (2, AS_OF + timedelta(days=1)), (3, None), (4, AS_OF)]
    assert rows(T.advance_watermarks(moved, sent), "id", "last_sent_at") == rows(moved, "id", "last_sent_at")


def digest_inputs(spark):
    specs = {  # id: created before as_of, engagement, rate
        "edge": (timedelta(hours=24), 10, 0), "old": (timedelta(hours=24, seconds=1), 99, 9),
        "now": (timedelta(0), 10, 0.05), "future": (timedelta(seconds=-1), 99, 9), "dull": (timedelta(hours=1), 9, 0.09),
        "rate": (timedelta(hours=2), 0, 0.1), "lonely": (timedelta(hours=1), 99, 9),
    }
    docs = [({"id": i, "title": i, "engagement": e, "engagementRate": r}, AS_OF - back) for i, (back, e, r) in specs.items()]
    on = topics(spark, [(i, "Virtual x", {"edge": 0.3, "rate": 0.29}.get(i, 0.5)) for i in specs])
    named = companies(spark, [(i, "e", f"Corp {i}", 0.0 if i != "rate" else 0.3, ["k"], []) for i in specs if i != "lonely"])
    return articles(spark, docs), on, named


def test_latest_digest(spark):
    got = D.latest_digest(*digest_inputs(spark), AS_OF)
    assert [r["feedly_id"] for r in got.collect()] == ["now", "dull", "rate", "edge"]
    assert [r["feedly_id"] for r in D.latest_digest(*digest_inputs(spark), AS_OF, k=2).collect()] == ["now", "dull"]
    assert D.latest_digest(*digest_inputs(spark), AS_OF, k=None).count() == 4


def test_top_digest(spark):
    got = D.top_digest(*digest_inputs(spark), AS_OF)
    assert [r["feedly_id"] for r in got.collect()] == ["rate", "now", "edge"]


def test_digest_text(spark):
    digest = D.latest_digest(*digest_inputs(spark), AS_OF, k=2)
    assert D.digest_headline(digest, C.LATEST_TITLE).first()[0] == (
        ":new: *Latest 10 XR articles* mention Corp dull, Corp now")
    lines = {r["feedly_id"]: r for r in D.digest_messages(digest).collect()}
    assert lines["now"]["captions"] == ["*Companies and Organizations:* Corp now", "*XR Topics:* Virtual x", "*Market:* k"]
    assert lines["now"]["bullets"] is None
    empty = D.digest_headline(digest.where("false"), "T").first()[0]
    assert empty == "T mention "


def test_default_rules_belong_to_many_concepts(spark):
    seeds = default_seeds(spark)
    assert [seeds[t].count() for t in ("channels", "concepts", "concept_entity_rules")] == [2, 13, 115]
    rules = seeds["concept_entity_rules"]
    both = rules.where("entity_type IN ('AutoRacingLeague', 'Rocket')")
    assert rows(both, "entity_type", "concept_id") == [
        ("AutoRacingLeague", 12), ("AutoRacingLeague", 13), ("Rocket", 11), ("Rocket", 13)]
    assert rows(seeds["concepts"].where("id = 12"), "name") == [("Sports and Fitness",)]
    limits = [c for c in rules.columns if c.endswith("_threshold")]
    assert [tuple(map(str, r)) for r in rules.select(*limits).distinct().collect()] == [("1.000", "0.200", "0.200")]


def plan_text(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_documents_are_narrowed_before_they_are_parsed(spark):
    from helpers import analysis_rows
    from newsboard.sources.schemas import REGISTER

    docs = {k: {"topics": [{"id": 0, "label": "Virtual x", "score": 0.9}], "entities": [{"type": ["Team"], "entityEnglishId": "E", "relevanceScore": 1, "confidenceScore": 2}]} for k in "ab"}
    t = tables(spark, RULES_ROWS, [(1, 1)])
    given = {
        "concept_entity_rules": t["rules"], "concepts": t["concepts"], "channel_concepts": t["channel_concepts"],
        "channels": t["channels"], "organizations": spark.createDataFrame([], REGISTER["organizations"]),
    }
    arts = entry_details(parse_entries(entry_rows(spark, [({"id": "a"}, AS_OF + timedelta(days=1)), ({"id": "b"}, AS_OF)])))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a broadcast semi join would be pushed down anyway
    try:
        got = T.unsent_from(arts, analysis_rows(spark, docs), given)
        plan = plan_text(got).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows(got, "channel_id", "feedly_id") == [(1, "a")]
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    semis = [i for i, line in enumerate(plan) if "Join LeftSemi" in line]
    assert semis
    for i in semis:
        below = [line for line in plan[i + 1 :]][: next((k for k, line in enumerate(plan[i + 1 :]) if depth(line) <= depth(plan[i])), None)]
        assert not any("Aggregate" in line or "Generate" in line for line in below)
    assert sum("min(_topic" in line for line in plan) == 1  # routes are worked out once
