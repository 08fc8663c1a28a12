"""Rule-based routing of articles to channels, and what was sent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from newsboard.functions import captions as C
from newsboard.functions.arrays import set_of
from newsboard.functions.text import identifier
from newsboard.functions.time import BOARD_ZONE, moment, send_at, shift_zone
from newsboard.operators import analysis as N
from newsboard.operators.articles import sentence_texts
from newsboard.operators.joins import spread_join, together
from newsboard.operators.maintenance import as_json
from newsboard.operators.sectors import article_sectors
from newsboard.sources.feed import parse_analyses


def match_rules(entities: DataFrame, rules: DataFrame) -> DataFrame:
    """Concepts an entity of an article stands for: its type is named by a rule
    and both scores reach the rule's thresholds.

    One row per article, entity, concept and rule icon, with the lowest topic
    threshold of the rules that apply.  Positions and repeated mentions of an
    entity fall together here, before anything else is joined.
    """
    return _matched(entities, rules, ["concept_id"])


def _matched(entities: DataFrame, rules: DataFrame, carried: Sequence[str]) -> DataFrame:
    narrow = entities.select("feedly_id", "entity_type", "entity_id", "relevance_score", "confidence_sore")
    limits = rules.select(
        "entity_type",
        *carried,
        F.col("emoji_icon").alias("concept_rule_emoji_icon"),
        F.col("entity_confidence_score_threshold").cast("double").alias("_confidence"),
        F.col("entity_relevance_score_threshold").cast("double").alias("_relevance"),
        F.col("topic_score_threshold").cast("double").alias("_topic"),
    )
    # Rules are configured by hand.  Their size after joins is only guessed, and
    # a shuffle by type would bring most mentions of all into one task.
    matched = narrow.join(F.broadcast(limits), "entity_type").where(
        (F.col("confidence_sore") >= F.col("_confidence")) & (F.col("relevance_score") >= F.col("_relevance"))
    )
    # Everything after this joins on the article: one shuffle serves all of it.
    return (
        together(matched, "feedly_id")
        .groupBy("feedly_id", "entity_type", "entity_id", *carried, "concept_rule_emoji_icon")
        .agg(F.min("_topic").alias("topic_threshold"))
    )


def _channel_rules(
    rules: DataFrame, concepts: DataFrame, channel_concepts: DataFrame, channels: DataFrame
) -> DataFrame:
    """Rules with the channels they feed; small tables meet before any fact."""
    links = channel_concepts.select("channel_id", "concept_id").distinct()
    named_concepts = concepts.select(
        F.col("id").alias("concept_id"),
        F.col("name").alias("concept_name"),
        F.col("emoji_icon").alias("concept_emoji_icon"),
    )
    named_channels = channels.select(
        F.col("id").alias("channel_id"),
        F.col("name").alias("channel_name"),
        F.col("emoji_icon").alias("channel_emoji_icon"),
        "target",
        "target_id",
    )
    return rules.join(links, "concept_id").join(named_concepts, "concept_id").join(named_channels, "channel_id")


_ROUTE = [
    "channel_id", "channel_name", "channel_emoji_icon", "target", "target_id", "concept_name",
    "concept_emoji_icon", "concept_rule_emoji_icon", "entity_type", "entity_id", "topic_label", "feedly_id",
]


def route_ids(
    entities: DataFrame,
    on_topic: DataFrame,
    rules: DataFrame,
    concepts: DataFrame,
    channel_concepts: DataFrame,
    channels: DataFrame,
) -> DataFrame:
    """Article ids per channel, concept, entity and topic label.

    Entities meet only rules that some channel listens to.
    """
    wanted = _channel_rules(rules, concepts, channel_concepts, channels)
    matched = _matched(entities, wanted, ["concept_id", *_ROUTE[:7]])
    # Best score per article and label: a label then meets a threshold at most once.
    on_topic = (
        together(on_topic, "feedly_id")
        .groupBy("feedly_id", "topic_label")
        .agg(F.max("topic_score").alias("topic_score"))
    )
    return (
        matched.join(on_topic, "feedly_id")
        .where(F.col("topic_score") >= F.col("topic_threshold"))
        .select(*_ROUTE)
    )


def route(
    articles: DataFrame,
    entities: DataFrame,
    on_topic: DataFrame,
    rules: DataFrame,
    concepts: DataFrame,
    channel_concepts: DataFrame,
    channels: DataFrame,
    zone: str = BOARD_ZONE,
) -> DataFrame:
    """Articles per channel, concept, entity and topic label.

    ``on_topic`` holds the topic rows of
    :func:`~newsboard.operators.analysis.subject_topics`.
    """
    about = articles.select(
        "feedly_id", "title", "url", "author", "site", "image_url",
        sentence_texts(F.col("sentences")).alias("summary_sentences"),
        "engagement_rate", "engagement", "created_at", "updated_at", "published_at",
        shift_zone(F.col("published_at"), zone).alias("published_at_with_tz"),
    )
    key = identifier(
        F.col("channel_id"), F.col("concept_name"), F.col("target"), F.col("target_id"),
        F.col("channel_name"), F.col("feedly_id"), F.col("entity_type"), F.col("entity_id"),
        F.col("topic_label"),
    )
    routed = route_ids(entities, on_topic, rules, concepts, channel_concepts, channels)
    return routed.join(about, "feedly_id").select(*_ROUTE, key.alias("identifier"), *about.columns[1:])


def channel_details(routed: DataFrame, sectors: DataFrame, articles: DataFrame | None = None) -> DataFrame:
    """One row per channel and article with the sets of what it is about.

    ``sectors`` is :func:`~newsboard.operators.sectors.article_sectors`: one
    row per article, so joining it multiplies nothing.  ``routed`` is of
    :func:`route`, or of :func:`route_ids` with ``articles``, whose sentences
    are then joined once per row of the result instead of carried along.
    """
    carried = [F.first("summary_sentences").alias("summary_sentences")] if articles is None else []
    per_article = routed.groupBy(
        "channel_id", "channel_emoji_icon", "target", "target_id", "feedly_id"
    ).agg(
        set_of(F.col("concept_name")).alias("concept_names"),
        set_of(F.col("concept_emoji_icon")).alias("concept_emoji_icons"),
        set_of(F.col("concept_rule_emoji_icon")).alias("concept_rule_emoji_icons"),
        set_of(F.col("entity_type")).alias("entity_types"),
        set_of(F.col("topic_label")).alias("topic_labels"),
        *carried,
    )
    if articles is not None:
        sentences = sentence_texts(F.col("sentences")).alias("summary_sentences")
        per_article = per_article.join(articles.select("feedly_id", sentences), "feedly_id")
    sets = sectors.select("feedly_id", "categories", "category_group", "company_names")
    none = F.array(F.lit(None).cast("string"))
    return per_article.join(sets, "feedly_id", "left").select(
        "channel_id", "channel_emoji_icon", "target", "target_id", "feedly_id",
        "summary_sentences", "concept_names", "concept_emoji_icons",
        "concept_rule_emoji_icons", "entity_types", "topic_labels", "categories",
        "category_group", F.coalesce("company_names", none).alias("company_names"),
    )


def details_of(
    articles: DataFrame,
    entities: DataFrame,
    topics: DataFrame,
    companies: DataFrame,
    tables: Mapping[str, DataFrame],
) -> DataFrame:
    """:func:`channel_details` straight from the analysis of ``articles``.

    Routes stand in the plan once: sets per article of sectors are joined to
    the routed articles instead of being worked out for their ids, which would
    route a second time.  Give topics and companies of the articles in question
    only.  ``tables`` holds concept_entity_rules, concepts, channel_concepts and
    channels.
    """
    routed = route_ids(
        entities, N.subject_topics(topics, distinct_topics=True), tables["concept_entity_rules"],
        tables["concepts"], tables["channel_concepts"], tables["channels"],
    )
    return channel_details(routed, article_sectors(topics, companies), articles)


def recent_articles(articles: DataFrame, channels: DataFrame, null_watermark: str = "never") -> DataFrame:
    """Articles that some channel may not have got yet: created after the
    oldest mark.  The one value is read from the channels now and becomes a
    literal that reaches the scan; marks only move forward, so a plan that is
    run later still holds all that is unsent then."""
    if null_watermark == "always":
        return articles
    oldest = channels.agg(F.min("last_sent_at")).first()[0]
    return articles.where(F.col("created_at") > moment(oldest) if oldest else F.lit(False))


def unsent_of(
    articles: DataFrame,
    entities: DataFrame,
    topics: DataFrame,
    companies: DataFrame,
    tables: Mapping[str, DataFrame],
    null_watermark: str = "never",
    zone: str = BOARD_ZONE,
) -> DataFrame:
    """:func:`unsent` straight from the analysis, for recent articles only."""
    recent = recent_articles(articles, tables["channels"], null_watermark)
    if null_watermark != "always":
        ids = recent.select("feedly_id")
        entities, topics, companies = (x.join(ids, "feedly_id", "left_semi") for x in (entities, topics, companies))
    details = details_of(recent, entities, topics, companies, tables)
    return unsent(recent, details, tables["channels"], null_watermark, zone)


def unsent_from(
    articles: DataFrame,
    analyses: DataFrame,
    tables: Mapping[str, DataFrame],
    null_watermark: str = "never",
    zone: str = BOARD_ZONE,
) -> DataFrame:
    """:func:`unsent` from the stored analysis documents.

    Documents of other than recent articles are left out while they are still
    text: nothing of them is parsed, unnested or grouped.  ``tables`` holds
    organizations beside the tables of :func:`details_of`.
    """
    recent = recent_articles(articles, tables["channels"], null_watermark)
    mine = analyses.join(recent.select("feedly_id"), "feedly_id", "left_semi").select(*analyses.columns)
    parsed = parse_analyses(mine)
    entities, topics = N.analysis_entities(recent, parsed), N.analysis_topics(recent, parsed)
    companies = N.resolve_companies(entities, tables["organizations"])
    details = details_of(recent, entities, topics, companies, tables)
    return unsent(recent, details, tables["channels"], null_watermark, zone)


def unsent(
    articles: DataFrame,
    details: DataFrame,
    channels: DataFrame,
    null_watermark: str = "never",
    zone: str = BOARD_ZONE,
) -> DataFrame:
    """Channel articles created after the channel was last sent to.

    A channel that was never sent to selects nothing (``"never"``) or
    everything (``"always"``).
    """
    newer = F.col("created_at") > F.col("last_sent_at")
    if null_watermark == "always":
        newer = newer | F.col("last_sent_at").isNull()
    elif null_watermark != "never":
        raise ValueError(f"null_watermark must be 'never' or 'always', not {null_watermark!r}")
    about = articles.select(
        "feedly_id", "title", "site", "author", "url", "image_url", "engagement_rate",
        "engagement", "created_at", "updated_at", "published_at",
        shift_zone(F.col("published_at"), zone).alias("published_at_with_tz"),
    )
    current = channels.select(
        F.col("id").alias("channel_id"),
        F.col("name").alias("channel_name"),
        F.col("emoji_icon").alias("_icon"),
        "last_sent_at",
    )
    rows = spread_join(details, current, ["channel_id"]).join(about, "feedly_id")
    return rows.where(newer).select(
        "channel_id", "channel_name", F.col("_icon").alias("channel_emoji_icon"), "target",
        "target_id", "feedly_id", "title", "site", "author", "url", "image_url",
        "summary_sentences", "concept_names", "concept_emoji_icons",
        "concept_rule_emoji_icons", "entity_types", "topic_labels", "categories",
        "category_group", "company_names", "engagement_rate", "engagement", "created_at",
        "updated_at", "published_at", "published_at_with_tz", "last_sent_at",
    )


def ordered_unsent(rows: DataFrame) -> DataFrame:
    """Unsent rows in the order to post them: channel by channel, by publishing
    time; what was published at the same time goes by id."""
    return rows.orderBy("channel_id", "channel_name", F.col("published_at").asc_nulls_last(), "feedly_id")


def outbox(unsent_rows: DataFrame, target: str, now: datetime, seed: int = 0) -> DataFrame:
    """Messages to send to one kind of target, with a staggered send time."""
    rows = unsent_rows.where(F.col("target") == target)
    blank = lambda c: F.coalesce(c, F.lit(""))
    text = F.concat(
        F.lit("I found a new article about "),
        blank(F.col("channel_emoji_icon")),
        F.lit(" "),
        blank(F.col("channel_name")),
        F.lit(".\n\nIt mentions "),
        blank(C.names_of(F.col("topic_labels"))),
        F.lit("."),
    )
    return rows.select(
        "channel_id",
        "feedly_id",
        F.col("target_id").alias("channel"),
        text.alias("text"),
        C.headline(F.col("url"), F.col("title")).alias("headline"),
        "image_url",
        C.bullets(F.col("summary_sentences")).alias("bullets"),
        C.captions(
            F.col("company_names"), F.col("topic_labels"), F.col("categories")
        ).alias("captions"),
        C.author_line(F.col("author"), F.col("site"), F.col("published_at_with_tz")).alias("author_line"),
        send_at(now, F.col("published_at"), F.col("feedly_id"), seed).alias("post_at"),
        F.col("created_at").alias("created_at"),
        as_json(*rows.columns).alias("item"),
    )


def advance_watermarks(channels: DataFrame, sent: DataFrame) -> DataFrame:
    """Channels with ``last_sent_at`` moved to the newest article sent.

    Never moves back, and a channel without a mark keeps none.
    """
    newest = sent.groupBy(F.col("channel_id").alias("id")).agg(F.max("created_at").alias("_newest"))
    moved = F.when(F.col("_newest") > F.col("last_sent_at"), F.col("_newest"))
    return (
        channels.join(newest, "id", "left")
        .withColumn("last_sent_at", F.coalesce(moved, "last_sent_at"))
        .select(*channels.columns)
    )
