"""DuckDB SQL for the registered queries, over the same tables.

Written from the meaning of each query, row by row: the SQL builds products
and windows over whole groups where the engine reduces first.
"""

from __future__ import annotations

from bindings import CHANNEL_CONCEPTS, CHANNEL_ICONS, CHANNEL_MARKS, TOPIC_NAMES, TYPE_NAMES
from newsboard.plans.views import GRAINS
from newsboard.sources.seeds import CHANNEL_ROWS, CONCEPT_NAMES, RULE_TYPES

ABC = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Fixed values, written here once more so that a wrong one in the engine shows.
SOUNDEX_DIGITS = "01230120022455012623010202"
CANONICAL_LABELS = {
    "Virtual reality headset": "Virtual reality headsets",
    "Virtual reality organizations": "Virtual reality companies",
    "Virtual machine": "Virtual machines",
    "Virtual economy": "Virtual economies",
    "Virtual assistant": "Virtual assistants",
    "Mixed reality game": "Mixed reality games",
}
STOP_LABELS = ("Alternate reality", "Virtual reality", "Mixed reality", "Reality")
THEMES = {
    "sports": ("%League", "%Team", "Tournament", "Racecourse", "Stadium", "Sports%", "Soccer%"),
    "culture": ("TopicalConcept", "%Show", "VideoGame", "Fashion", "MusicalArtist", "MusicalWork"),
    "academia": ("University", "EducationalInstitution", "AcademicJournal", "AcademicConference", "School"),
    "events": ("Venue", "Theatre", "Event"),
}


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def case(expr: str, names: dict[str, str]) -> str:
    arms = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in names.items())
    return f"CASE {expr} {arms} ELSE {expr} END"


def soundex(x: str) -> str:
    start = f"regexp_replace({x}, '^[^A-Za-z]+', '')"
    codes = f"translate({start}, '{ABC}{ABC.lower()}0123456789', '{SOUNDEX_DIGITS * 2}abcdefghij')"
    runs = "|".join(f"([{d}{m}])[{d}{m}]*" for d, m in zip("0123456", "abcdefg"))
    heads = rf"regexp_replace({codes}, '{runs}', '\1\2\3\4\5\6\7', 'g')"
    rest = f"left(regexp_replace(substr({heads}, 2), '[^1-6]', '', 'g'), 3)"
    first = f"translate(left({start}, 1), '{ABC.lower()}', '{ABC}')"
    return f"CASE WHEN {start} = '' THEN '' ELSE rpad({first} || {rest}, 4, '0') END"


def host(url: str) -> str:
    return (
        f"CASE WHEN regexp_matches({url}, '://') THEN "
        f"replace(regexp_extract({url}, '.*://([^/]*)', 1), 'www.', '') END"
    )


def day(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d')"


def second(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def bucket(ts: str, grain: str) -> str:
    return f"CAST(date_trunc('{grain}', {ts}) AS TIMESTAMP)"


def eastern(ts: str) -> str:
    return f"({ts} - INTERVAL 5 HOUR)"


def joined_set(x: str, where: str = "") -> str:
    cond = f"{x} IS NOT NULL" + (f" AND {where}" if where else "")
    return f"array_to_string(list_sort(list(DISTINCT {x}) FILTER (WHERE {cond})), '|')"


# --- boards ---------------------------------------------------------------

LINE_MENTIONS = """
    SELECT o_orderkey AS feedly_id, o_orderdate AS published_at, s_name AS name,
           p_type AS category, p_brand AS category_group
    FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey
    JOIN part ON p_partkey = l_partkey
    JOIN supplier ON s_suppkey = l_suppkey
"""
EVENT_MENTIONS = """
    SELECT event_id AS feedly_id, ts AS published_at, event_type AS topic_label, value AS topic_score
    FROM events
"""


def board(mentions: str, by: str, grain: str, within: str = "", where: str = "true", more: str = "", tail: str = "") -> str:
    extra = f"{within}, " if within else ""
    scope = f"PARTITION BY {extra}period"
    return f"""
        WITH mentions AS ({mentions}),
        tally AS (
            SELECT {bucket(eastern('published_at'), grain)} AS period, {extra}{by}, count(*) AS freq
            FROM mentions WHERE {where} GROUP BY ALL HAVING count(*) >= 2
        ),
        ranked AS (
            SELECT *, CAST(dense_rank() OVER ({scope} ORDER BY freq DESC) AS INTEGER) AS rank,
                   max(freq) OVER ({scope}) AS max_freq, min(freq) OVER ({scope}) AS min_freq
            FROM tally
        )
        SELECT '{grain}' AS time_period_label, {day('period')} AS time_period, {extra}{by},
               freq, rank, max_freq, min_freq,
               round(CAST(freq AS DOUBLE) / max_freq, 9) AS pct,
               repeat('#', CAST((40 * freq + max_freq) // (2 * max_freq) AS INTEGER)) AS histogram
               {more}
        FROM ranked {tail}
    """


def top_board(mentions: str, by: str, grain: str, start: str, where: str = "true") -> str:
    line = f", lpad(CAST(rank AS VARCHAR), 2, ' ') || ' | *' || {by} || '* (' || freq || ')' AS line"
    tail = f"WHERE period = TIMESTAMP '{start}' ORDER BY rank, {by} LIMIT 10"
    return board(mentions, by, grain, where=where, more=line, tail=tail)


def counts(rows: str, label: str, grain: str, min_freq: int = 2) -> str:
    return f"""
        SELECT '{grain}' AS time_period_label, {day(bucket('published_at', grain))} AS time_period,
               {label}, count(*) AS "count"
        FROM ({rows}) GROUP BY ALL HAVING count(*) >= {min_freq}
    """


# --- documents as feed entries --------------------------------------------

DOCS = f"""
    SELECT *, 'doc/' || doc_id AS feedly_id, string_split(text, chr(10))[1] AS title,
           TIMESTAMP '2020-01-01' + to_hours(CAST(doc_id AS INTEGER)) AS published_at
    FROM documents
"""
DOC_ARTICLES = f"""
    SELECT * FROM ({DOCS})
    QUALIFY row_number() OVER (
        PARTITION BY source, {soundex('title')} ORDER BY lang, n_chars DESC, doc_id DESC
    ) = 1
"""


def doc_words() -> str:
    return f"SELECT feedly_id, published_at, unnest(string_split(text, ' ')) AS keyword FROM ({DOC_ARTICLES})"


def doc_entities() -> str:
    words = "list_distinct(list_filter(string_split(text, ' '), lambda w: w <> ''))"
    return f"""
        SELECT feedly_id, published_at, lang AS entity_salince_level, lower(w) AS entity_id, w AS entity_label
        FROM (SELECT *, unnest({words}) AS w FROM ({DOC_ARTICLES}))
    """


def doc_topics() -> str:
    return " UNION ALL ".join(
        f"SELECT feedly_id, published_at, '{k}/' || {k} AS topic_id, {k} AS topic_label, "
        f"round(n_chars / 1000, 9) AS topic_score, '{s}' AS topic_salince_level FROM ({DOC_ARTICLES})"
        for k, s in (("lang", "about"), ("source", "mention"))
    )


def doc_lines() -> str:
    return f"""
        SELECT feedly_id, line AS summary_sentence, CAST(pos - 1 AS INTEGER) AS summary_sentence_position,
               CAST(length(line) AS DOUBLE) AS summary_sentence_score
        FROM (
            SELECT feedly_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos
            FROM (SELECT feedly_id, string_split(text, chr(10)) AS lines FROM ({DOC_ARTICLES}))
        )
    """


# --- pages as feed entries ------------------------------------------------

PAGES = f"""
    SELECT page_id, url, html, 'page/' || page_id AS feedly_id,
           regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
           CASE WHEN regexp_extract(url, '/([a-z][a-z])/', 1) <> 'en'
                THEN regexp_extract(url, '/([a-z][a-z])/', 1) END AS author,
           {host('url')} AS site,
           CASE WHEN starts_with(url, 'https')
                THEN regexp_extract_all(html, 'href="([^"]*)"', 1)[2]
                ELSE regexp_extract_all(html, 'href="([^"]*)"', 1)[1] END AS image_url,
           CASE WHEN regexp_extract(url, '/([a-z][a-z])/', 1) <> 'fr'
                THEN CAST(length(html) AS DOUBLE) ELSE 0.0 END AS engagement,
           length(url) / 10 AS engagement_rate,
           TIMESTAMP '2020-01-01' + to_hours(CAST(page_id AS INTEGER)) AS published_at
    FROM pages
"""
PAGE_COLUMNS = f"""
    feedly_id, url, site, title, author, image_url, engagement,
    round(engagement_rate, 9) AS engagement_rate, length(html) AS content_chars,
    {day('published_at')} AS published_on,
    {second("published_at + INTERVAL 1 HOUR")} AS crawled_at, {soundex('title')} AS soundex_title
"""

# --- orders as articles, lines as entity mentions -------------------------

ORDER_ARTICLES = f"""
    SELECT o_orderkey, 'order/' || o_orderkey AS feedly_id, o_orderdate AS created_at,
           o_orderdate AS published_at, o_orderpriority AS title,
           'customer ' || o_custkey AS author, 'c' || o_custkey || '.example.com' AS site,
           'https://www.c' || o_custkey || '.example.com/' || o_orderkey AS url,
           CAST(floor(o_totalprice / 10000) AS DOUBLE) AS engagement,
           floor(o_totalprice / 1000) / 1000 AS engagement_rate,
           o_orderstatus || '|' || o_orderpriority AS sentences
    FROM orders
"""
ORDER_DEDUPED = f"""
    SELECT a.* FROM ({ORDER_ARTICLES}) a
    QUALIFY row_number() OVER (
        PARTITION BY site, {soundex('title')}
        ORDER BY author, engagement DESC, engagement_rate DESC, published_at DESC, feedly_id
    ) = 1
"""
TOPICS = " UNION ALL ".join(
    f"SELECT 'order/' || o_orderkey AS feedly_id, {i} AS topic_position, {case(c, TOPIC_NAMES)} AS topic_label, "
    "o_totalprice / 500000 AS topic_score FROM orders"
    for i, c in enumerate(("o_orderpriority", "o_orderstatus"))
)
MENTIONS = f"""
    SELECT 'order/' || l_orderkey AS feedly_id,
           unnest(['Company', {case('p_type', TYPE_NAMES)}]) AS entity_type,
           s_name AS entity_id,
           CASE WHEN l_returnflag <> 'N' THEN 'supplier-' || l_suppkey END AS crunchbase_id,
           'part/' || l_partkey AS wikidata_id,
           p_name AS matched_text, l_linenumber AS starting_pos,
           l_quantity / 50 AS relevance_score, l_extendedprice / 10000 AS confidence_sore
    FROM lineitem
    JOIN part ON p_partkey = l_partkey
    JOIN supplier ON s_suppkey = l_suppkey
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
"""
ENTITIES = f"""
    SELECT feedly_id, entity_type, entity_id, crunchbase_id, wikidata_id,
           coalesce(crunchbase_id, wikidata_id) AS entity_external_id, matched_text, starting_pos,
           max(relevance_score) AS relevance_score, max(confidence_sore) AS confidence_sore,
           count(*) AS mentions
    FROM ({MENTIONS}) GROUP BY ALL
"""
ORGS = """
    SELECT 'org-' || s_suppkey AS uuid, s_name AS name, 'supplier-' || s_suppkey AS permalink,
           n_name AS city, r_name AS region, [r_name, n_name] AS categories,
           CASE WHEN s_acctbal < 0 THEN [] ELSE [r_name] END AS groups
    FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
"""
COMPANIES = f"""
    WITH grouped AS (
        SELECT feedly_id, entity_id, entity_external_id, crunchbase_id,
               max(relevance_score) AS relevance_score, max(confidence_sore) AS confidence_sore
        FROM ({ENTITIES}) WHERE entity_type = 'Company' GROUP BY ALL
    ),
    picked AS (
        SELECT * FROM grouped
        QUALIFY row_number() OVER (
            PARTITION BY feedly_id, entity_external_id
            ORDER BY entity_id, relevance_score DESC, crunchbase_id
        ) = 1
    )
    SELECT p.*, o.uuid, o.name, o.permalink, o.city, o.region, o.categories, o.groups
    FROM picked p LEFT JOIN ({ORGS}) o ON o.permalink = p.crunchbase_id
"""
MATCHES = (
    "(topic_label ILIKE '%reality%' OR topic_label ILIKE '%learn%' OR topic_label ILIKE '%virtual%') "
    "AND topic_label NOT ILIKE '%reality television%'"
)
LABELS = f"SELECT DISTINCT topic_label FROM ({TOPICS}) WHERE {MATCHES}"
CANONICAL = f"""
    SELECT {case('topic_label', CANONICAL_LABELS)} AS topic_label FROM ({LABELS})
    WHERE topic_label NOT IN ({', '.join(quote(x) for x in STOP_LABELS)})
"""
SECTORS = f"""
    SELECT a.feedly_id, t.topic_label, t.topic_score, c.uuid, coalesce(c.name, c.entity_id) AS name,
           c.relevance_score, c.confidence_sore, c.city, c.region, k.category, g.category_group,
           a.title, a.published_at
    FROM ({ORDER_ARTICLES}) a
    JOIN ({TOPICS}) t ON t.feedly_id = a.feedly_id AND {MATCHES.replace('topic_label', 't.topic_label')}
    JOIN ({COMPANIES}) c ON c.feedly_id = a.feedly_id
    LEFT JOIN (SELECT uuid, unnest(categories) AS category FROM ({ORGS})) k ON k.uuid = c.uuid
    LEFT JOIN (SELECT uuid, unnest(groups) AS category_group FROM ({ORGS})) g ON g.uuid = c.uuid
"""


def digest(order: str, where: str, as_of: str = "1998-06-15") -> str:
    return f"""
        SELECT a.feedly_id, {second(eastern('a.published_at'))} AS published_at_with_tz,
               {joined_set('s.topic_label')} AS topic_labels, {joined_set('s.category')} AS categories,
               {joined_set('s.category_group')} AS category_group, {joined_set('s.name')} AS company_names,
               a.title, round(a.engagement_rate, 9) AS engagement_rate, a.engagement, a.url, a.author,
               a.site, a.sentences AS summary_sentences
        FROM ({ORDER_ARTICLES}) a JOIN ({SECTORS}) s ON s.feedly_id = a.feedly_id
        WHERE a.created_at BETWEEN TIMESTAMP '{as_of}' - INTERVAL 24 HOUR AND TIMESTAMP '{as_of}' AND {where}
        GROUP BY a.feedly_id, a.published_at, a.created_at, a.title, a.engagement_rate, a.engagement,
                 a.url, a.author, a.site, a.sentences
        ORDER BY {order}, a.feedly_id LIMIT 10
    """


LATEST = digest("a.created_at DESC", "true")
TOP = digest(
    "a.engagement_rate DESC",
    "(s.topic_score >= 0.3 OR s.relevance_score >= 0.3) AND (a.engagement >= 10 OR a.engagement_rate >= 0.1)",
)

RULES = "SELECT * FROM (VALUES " + ", ".join(
    f"({c}, {quote(t)}, 1.0, 0.2, 0.2)" for c, types in RULE_TYPES for t in types.split()
) + ") r(concept_id, entity_type, confidence, relevance, topic)"
TARGETS = "SELECT * FROM (VALUES " + ", ".join(
    f"({ch}, {quote(CHANNEL_ROWS[ch - 1][0])}, {quote(CHANNEL_ICONS[ch])}, {quote(CHANNEL_ROWS[ch - 1][2])}, "
    f"{quote(CHANNEL_ROWS[ch - 1][3])}, TIMESTAMP '{CHANNEL_MARKS[ch]}', {co}, {quote(CONCEPT_NAMES[co - 1])})"
    for ch, co in CHANNEL_CONCEPTS
) + ") c(channel_id, channel_name, channel_emoji_icon, target, target_id, last_sent_at, concept_id, concept_name)"
ROUTED = f"""
    SELECT DISTINCT c.channel_id, c.channel_name, c.channel_emoji_icon, c.target, c.target_id, c.concept_name,
           e.entity_type, e.entity_id, l.topic_label, e.feedly_id, c.last_sent_at
    FROM ({ENTITIES}) e
    JOIN ({TOPICS}) t ON t.feedly_id = e.feedly_id
    JOIN ({RULES}) r ON r.entity_type = e.entity_type AND e.confidence_sore >= r.confidence
                    AND e.relevance_score >= r.relevance AND t.topic_score >= r.topic
    JOIN ({TARGETS}) c ON c.concept_id = r.concept_id
    JOIN ({CANONICAL}) l ON l.topic_label = t.topic_label
"""
DETAILS = f"""
    SELECT d.*, x.categories, x.category_group, x.company_names
    FROM (
        SELECT channel_id, channel_name, channel_emoji_icon, target, target_id, feedly_id, last_sent_at,
               {joined_set('concept_name')} AS concept_names, {joined_set('entity_type')} AS entity_types,
               {joined_set('topic_label')} AS topic_labels
        FROM ({ROUTED}) GROUP BY ALL
    ) d
    LEFT JOIN (
        SELECT feedly_id, {joined_set('category')} AS categories,
               {joined_set('category_group')} AS category_group, {joined_set('name')} AS company_names
        FROM ({SECTORS}) GROUP BY feedly_id
    ) x ON x.feedly_id = d.feedly_id
"""
UNSENT = f"""
    SELECT d.*, a.title, a.site, a.author, a.url, a.engagement, a.created_at, a.published_at, a.sentences
    FROM ({DETAILS}) d JOIN ({ORDER_ARTICLES}) a ON a.feedly_id = d.feedly_id
    WHERE a.created_at > d.last_sent_at
"""
_STAMP = eastern("published_at")
OUTBOX = f"""
    SELECT channel_id, feedly_id, target_id AS channel,
           'I found a new article about ' || channel_emoji_icon || ' ' || channel_name || '.' || chr(10) || chr(10)
             || 'It mentions ' || replace(topic_labels, '|', ' - ') || '.' AS text,
           ':postbox: <' || url || '|' || title || '>' AS headline,
           '* ' || replace(sentences, '|', chr(10) || chr(10) || '* ') AS bullets,
           concat_ws(chr(10),
             '*Companies and Organizations:* ' || replace(company_names, '|', ' - '),
             '*XR Topics:* ' || replace(topic_labels, '|', ' - '),
             '*Market:* ' || replace(categories, '|', ' - ')) AS captions,
           '*Author:* ' || author || ' - ' || site || ' on ' || strftime({_STAMP}, '%b ')
             || lpad(strftime({_STAMP}, '%-d'), 2, ' ') || ', ' || lpad(strftime({_STAMP}, '%-I'), 2, ' ')
             || strftime({_STAMP}, ':%M %p') AS author_line
    FROM ({UNSENT})
"""

# --- keyed changes --------------------------------------------------------

BY_CUSTOMER = """
    SELECT 'customer/' || o_custkey AS feedly_id, o_orderdate AS ts, o_orderkey AS seq,
           o_orderpriority AS payload, o_orderstatus, o_totalprice
    FROM orders
"""
OLD, NEW = (f"SELECT * FROM ({BY_CUSTOMER}) WHERE ts {op} TIMESTAMP '1998-01-01'" for op in ("<", ">="))


def newest(rows: str) -> str:
    return f"""
        SELECT feedly_id, min(ts) AS first_at, max(ts) AS ts, arg_max(payload, (ts, seq)) AS payload
        FROM ({rows}) GROUP BY feedly_id
    """


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    for g in GRAINS:
        sql[f"board_company_{g}"] = board(LINE_MENTIONS, "name", g)
        sql[f"board_category_{g}"] = board(LINE_MENTIONS, "category", g)
        sql[f"board_group_{g}"] = board(LINE_MENTIONS, "category_group", g)
        sql[f"board_company_in_category_{g}"] = board(LINE_MENTIONS, "name", g, within="category")
        sql[f"board_topic_{g}"] = board(EVENT_MENTIONS, "topic_label", g, where="topic_score >= 50")
        sql[f"period_counts_topic_{g}"] = counts(EVENT_MENTIONS, "topic_label", g)
        sql[f"period_counts_keyword_{g}"] = counts(doc_words(), "keyword", g)
        sql[f"period_counts_entity_{g}"] = counts(doc_entities(), "entity_label", g)
    sql["top_companies_last_month"] = top_board(LINE_MENTIONS, "name", "month", "1998-05-01")
    sql["top_companies_month"] = top_board(LINE_MENTIONS, "name", "month", "1998-06-01")
    sql["top_categories_week"] = top_board(LINE_MENTIONS, "category", "week", "1998-06-15")
    sql["top_groups_last_week"] = top_board(LINE_MENTIONS, "category_group", "week", "1998-06-08")
    sql["top_topics_yesterday"] = top_board(EVENT_MENTIONS, "topic_label", "day", "2024-01-14", "topic_score >= 50")
    sql["top_topics_day"] = top_board(EVENT_MENTIONS, "topic_label", "day", "2024-01-15", "topic_score >= 50")

    # Feed documents.
    sql["entry_details"] = f"SELECT {PAGE_COLUMNS} FROM ({PAGES})"
    sql["page_articles"] = f"""
        SELECT {PAGE_COLUMNS} FROM ({PAGES})
        QUALIFY row_number() OVER (
            PARTITION BY site, {soundex('title')}
            ORDER BY author NULLS LAST, engagement DESC, length(url) DESC, page_id DESC
        ) = 1
    """
    sql["host_of"] = f"SELECT page_id, {host('url')} AS site FROM pages"
    sql["document_soundex"] = f"SELECT doc_id, {soundex('text')} AS code FROM documents"
    sql["articles_dedup"] = f"""
        SELECT doc_id, source, {soundex('text')} AS code, n_chars FROM documents
        QUALIFY row_number() OVER (PARTITION BY source, {soundex('text')} ORDER BY n_chars DESC, doc_id) = 1
    """
    sql["json_fields"] = """
        SELECT event_id, json_extract_string(props, '$.k') AS k_text,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_number,
               CAST(NULL AS VARCHAR) AS missing FROM events
    """
    sql["entries_from_json"] = f"""
        SELECT doc_id || '/' || (pos - 1) AS feedly_id,
               {second("TIMESTAMP '2020-01-01' + to_hours(CAST(doc_id AS INTEGER)) + to_seconds(pos - 1)")} AS published_at,
               line AS title
        FROM (
            SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos
            FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
        )
    """
    sql["common_topics"] = f"SELECT * EXCLUDE (published_at) FROM ({doc_topics()})"
    sql["topic_list"] = f"SELECT DISTINCT topic_id, topic_label FROM ({doc_topics()})"
    sql["feed_entities"] = f"SELECT * EXCLUDE (published_at) FROM ({doc_entities()})"
    sql["entity_list"] = f"SELECT DISTINCT entity_id, entity_label FROM ({doc_entities()})"
    sql["keywords"] = f"SELECT feedly_id, keyword FROM ({doc_words()})"
    sql["keyword_list"] = f"SELECT DISTINCT keyword FROM ({doc_words()})"
    sql["summary_sentences"] = doc_lines()
    sql["sentence_lists"] = f"SELECT feedly_id, replace(text, chr(10), ' / ') AS sentences FROM ({DOC_ARTICLES})"
    sql["priorities"] = f"""
        SELECT feedly_id, source AS priority_id, lang AS priority_label,
               unnest(['lang', 'source']) AS search_term_id, unnest([lang, source]) AS search_term_label
        FROM ({DOC_ARTICLES})
    """
    pairs = """
        SELECT 'part/' || p_partkey AS feedly_id, lower(e) AS entity_id, e AS entity_label, {cols}
        FROM (SELECT p_partkey, p_name, unnest([p_brand, p_type]) AS e FROM part),
             LATERAL (SELECT unnest(string_split(p_name, ' ')) AS w)
    """
    sql["entities_by_topics"] = pairs.format(cols="upper(w) AS topic_id, w AS topic_label")
    sql["entities_by_keywords"] = pairs.format(cols="w AS keyword")
    sql["cooccurrence"] = pairs.format(cols="w AS keyword")
    week = bucket(eastern("published_at"), "week")
    sql["article_rankings"] = f"""
        SELECT feedly_id, {day(bucket(eastern('published_at'), 'day'))} AS published_day,
               round(engagement_rate, 9) AS engagement_rate,
               CAST(popularity_by_day AS BIGINT) AS popularity_by_day,
               CAST(popularity_by_week AS BIGINT) AS popularity_by_week,
               CAST(popularity_by_month AS BIGINT) AS popularity_by_month
        FROM (
            SELECT *, {', '.join(
                f"dense_rank() OVER (PARTITION BY {bucket(eastern('published_at'), g)} ORDER BY engagement_rate DESC)"
                f" AS popularity_by_{g}" for g in GRAINS)}
            FROM ({ORDER_ARTICLES})
        ) WHERE {week} = TIMESTAMP '1998-06-29' AND popularity_by_week <= 20
    """

    # Analysis documents.
    sql["analysis_topics"] = f"SELECT feedly_id, topic_position, topic_label, round(topic_score, 9) AS topic_score FROM ({TOPICS})"
    sql["analysis_categories"] = """
        SELECT 'order/' || o_orderkey AS feedly_id, 0 AS category_position, o_orderpriority AS category_label,
               round(o_totalprice / 500000, 9) AS category_score, o_orderstatus AS category_id,
               'priority' AS classifier_id FROM orders
    """
    sql["analysis_text"] = "SELECT 'order/' || o_orderkey AS feedly_id, o_orderpriority || ' ' || o_orderstatus AS full_text FROM orders"
    sql["analysis_entities"] = f"""
        SELECT * REPLACE (round(relevance_score, 9) AS relevance_score, round(confidence_sore, 9) AS confidence_sore),
               starting_pos || ',' || (starting_pos + 1) AS matching_tokens FROM ({ENTITIES})
    """
    sql["companies"] = f"""
        SELECT feedly_id, entity_id, entity_external_id, crunchbase_id, round(relevance_score, 9) AS relevance_score,
               round(confidence_sore, 9) AS confidence_sore, uuid, name, permalink, city, region
        FROM ({COMPANIES})
    """
    sql["uncovered_types"] = f"SELECT entity_type FROM ({ENTITIES}) EXCEPT SELECT entity_type FROM ({RULES})"
    sql["matching_labels"] = LABELS
    sql["canonical_labels"] = CANONICAL
    sql["matching_words"] = """
        SELECT DISTINCT keyword FROM (SELECT unnest(string_split(text, ' ')) AS keyword FROM documents)
        WHERE (keyword ILIKE '%tion%' OR keyword ILIKE '%ment%') AND keyword NOT ILIKE '%mention%'
    """
    sql["topics_with_labels"] = f"""
        SELECT t.feedly_id, t.topic_label, round(t.topic_score, 9) AS topic_score
        FROM ({TOPICS}) t JOIN ({CANONICAL}) l ON l.topic_label = t.topic_label
    """
    sql["subject_topics"] = sql["topics_with_labels"]
    for theme, types in THEMES.items():
        likes = " OR ".join(f"e.entity_type LIKE {quote(t)}" for t in types)
        sql[f"themed_mentions_{theme}"] = f"""
            SELECT e.entity_type, round(e.confidence_sore, 9) AS confidence_sore,
                   round(e.relevance_score, 9) AS relevance_score, e.entity_id,
                   {day('a.published_at')} AS published_on, a.title, a.url
            FROM ({ENTITIES}) e JOIN ({ORDER_ARTICLES}) a ON a.feedly_id = e.feedly_id
            JOIN ({TOPICS}) t ON t.feedly_id = a.feedly_id
            JOIN ({CANONICAL}) l ON l.topic_label = t.topic_label
            WHERE ({likes}) AND e.confidence_sore > 1 AND e.relevance_score >= 0.2 AND t.topic_score >= 0.2
              AND a.created_at > TIMESTAMP '1998-03-01'
        """
    sql["company_articles"] = f"""
        SELECT feedly_id, topic_label, round(topic_score, 9) AS topic_score, uuid, name,
               round(relevance_score, 9) AS relevance_score, city, region, category, category_group,
               {', '.join(f"{day(bucket('published_at', g))} AS published_{n}"
                          for g, n in (('day', 'on'), ('week', 'week'), ('month', 'month')))}
        FROM ({SECTORS})
    """
    sql["article_sectors"] = f"""
        SELECT feedly_id, {joined_set('topic_label')} AS topic_labels, {joined_set('category')} AS categories,
               {joined_set('category_group')} AS category_group, {joined_set('name')} AS company_names
        FROM ({SECTORS}) GROUP BY feedly_id
    """
    sql["strong_article_sectors"] = f"""
        SELECT feedly_id, {joined_set('topic_label')} AS topic_labels, {joined_set('category')} AS categories,
               {joined_set('category_group')} AS category_group, {joined_set('name')} AS company_names
        FROM ({SECTORS}) WHERE topic_score >= 0.3 OR relevance_score >= 0.3 GROUP BY feedly_id
    """
    sql["latest_digest"] = LATEST
    sql["top_digest"] = TOP
    _at = "CAST(published_at_with_tz AS TIMESTAMP)"
    sql["digest_messages"] = f"""
        SELECT feedly_id, ':postbox: <' || url || '|' || title || '>' AS headline,
               '* ' || replace(summary_sentences, '|', chr(10) || chr(10) || '* ') AS bullets,
               concat_ws(chr(10),
                 '*Companies and Organizations:* ' || replace(company_names, '|', ' - '),
                 '*XR Topics:* ' || replace(topic_labels, '|', ' - '),
                 '*Market:* ' || replace(categories, '|', ' - ')) AS captions,
               '*Author:* ' || author || ' - ' || site || ' on ' || strftime({_at}, '%b ')
                 || lpad(strftime({_at}, '%-d'), 2, ' ') || ', ' || lpad(strftime({_at}, '%-I'), 2, ' ')
                 || strftime({_at}, ':%M %p') AS author_line
        FROM ({LATEST})
    """
    sql["digest_headline"] = f"""
        SELECT ':new: *Latest 10 XR articles* mention ' ||
               array_to_string(list_sort(list(DISTINCT n)), ', ') AS headline
        FROM (SELECT unnest(string_split(company_names, '|')) AS n FROM ({LATEST}))
    """

    # Register.
    sql["org_categories"] = f"SELECT uuid, name, unnest(categories) AS category FROM ({ORGS})"
    sql["org_category_groups"] = f"SELECT uuid, name, unnest(groups) AS category_group FROM ({ORGS})"
    sql["category_map"] = """
        SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS category, replace(p_name, ' ', '-') AS permalink,
               unnest([p_brand, p_type]) AS category_group FROM part
    """
    sql["category_list"] = "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS category, replace(p_name, ' ', '-') AS permalink FROM part"
    sql["group_list"] = "SELECT DISTINCT unnest([p_brand, p_type]) AS category_group FROM part"
    sql["read_register"] = f"""
        SELECT uuid, name, permalink, city, region, array_to_string(categories, ',') AS category_list FROM ({ORGS})
    """

    # Routing.
    sql["match_rules"] = f"""
        SELECT DISTINCT e.feedly_id, e.entity_type, e.entity_id, CAST(r.concept_id AS BIGINT) AS concept_id
        FROM ({ENTITIES}) e JOIN ({RULES}) r
          ON r.entity_type = e.entity_type AND e.confidence_sore >= r.confidence AND e.relevance_score >= r.relevance
    """
    sql["route"] = f"""
        SELECT * EXCLUDE (last_sent_at) REPLACE (CAST(channel_id AS BIGINT) AS channel_id),
               lower(channel_id || '-' || concept_name || '-' || target || '-' || target_id || '-' || channel_name
                 || '-' || feedly_id || '-' || entity_type || '-' || entity_id || '-' || topic_label) AS identifier
        FROM ({ROUTED})
    """
    sql["channel_details"] = f"""
        SELECT CAST(channel_id AS BIGINT) AS channel_id, target, target_id, feedly_id, concept_names, entity_types,
               topic_labels, categories, category_group, company_names FROM ({DETAILS})
    """
    sql["unsent"] = f"""
        SELECT CAST(channel_id AS BIGINT) AS channel_id, channel_name, feedly_id, title, site, author, url,
               concept_names, topic_labels, categories, company_names, engagement,
               {day('created_at')} AS created_at, {second('last_sent_at')} AS last_sent_at FROM ({UNSENT})
    """
    sql["outbox"] = f"""
        SELECT * REPLACE (CAST(channel_id AS BIGINT) AS channel_id), CAST(NULL AS VARCHAR) AS image_url,
               true AS seconds_fit, true AS minutes_fit FROM ({OUTBOX})
    """
    sql["advance_watermarks"] = f"""
        SELECT CAST(c.channel_id AS BIGINT) AS id, c.channel_name AS name,
               {second('greatest(c.last_sent_at, u.newest)')} AS last_sent_at
        FROM (SELECT DISTINCT channel_id, channel_name, last_sent_at FROM ({TARGETS})) c
        LEFT JOIN (SELECT channel_id, max(created_at) AS newest FROM ({UNSENT}) GROUP BY channel_id) u
          ON u.channel_id = c.channel_id
    """

    # Keyed changes, work lists, checks.
    sql["upsert"] = f"""
        SELECT feedly_id, {day('coalesce(b.first_at, i.first_at)')} AS created_at,
               {day('coalesce(i.ts, b.ts)')} AS updated_at, coalesce(i.payload, b.payload) AS payload
        FROM ({newest(OLD)}) b FULL JOIN ({newest(NEW)}) i USING (feedly_id)
    """
    sql["update_existing"] = f"""
        SELECT feedly_id, {day('b.first_at')} AS created_at, {day('coalesce(i.ts, b.ts)')} AS updated_at,
               {day('b.ts')} AS published_at, coalesce(i.payload, b.payload) AS payload
        FROM ({newest(OLD)}) b LEFT JOIN ({newest(NEW)}) i USING (feedly_id)
    """
    sql["merge_analyses"] = f"""
        WITH runs AS (
            SELECT feedly_id, count(*) AS n, arg_max(o_orderstatus <> 'F', (ts, seq)) AS ok,
                   arg_max(payload, (ts, seq)) FILTER (WHERE o_orderstatus <> 'F') AS payload
            FROM ({NEW}) GROUP BY feedly_id
        )
        SELECT feedly_id, coalesce(r.payload, b.payload) AS payload,
               CAST(CASE WHEN r.n IS NULL OR r.ok THEN 200 WHEN b.feedly_id IS NOT NULL OR r.n > 1 THEN 400
                    ELSE 404 END AS INTEGER) AS status_code,
               {day("coalesce(b.first_at, TIMESTAMP '2002-01-01')")} AS created_at,
               {day("CASE WHEN r.n IS NULL THEN b.ts WHEN r.ok THEN TIMESTAMP '2002-01-01' END")} AS parsed_at
        FROM ({newest(OLD)}) b FULL JOIN runs r USING (feedly_id)
    """
    sql["analysis_backlog"] = """
        SELECT 'doc/' || doc_id AS feedly_id, 'https://www.' || source || '.example.com/' || doc_id AS url
        FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
        ORDER BY doc_id DESC LIMIT 300
    """
    sql["refresh_batches"] = """
        SELECT batch, count(*) AS n_ids, string_agg(feedly_id, ',' ORDER BY rn) AS ids
        FROM (
            SELECT feedly_id, rn, CAST((rn - 1) // 250 AS BIGINT) AS batch
            FROM (SELECT 'doc/' || doc_id AS feedly_id, row_number() OVER (ORDER BY doc_id) AS rn
                  FROM documents WHERE doc_id + 1 >= 24)
        ) GROUP BY batch
    """
    sql["check_unique"] = """
        SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1
    """
    sql["check_not_null"] = """
        SELECT * FROM (
            SELECT unnest(['quality', 'toxic', 'text']) AS column_name,
                   unnest([count(*) - count(quality), count(*) - count(toxic), count(*) - count(text)]) AS n_nulls
            FROM documents LEFT JOIN labels USING (doc_id)
        ) WHERE n_nulls > 0
    """
    sql["check_fk"] = """
        SELECT doc_id, count(*) AS n_rows FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id
    """
    sql["as_json"] = "SELECT o_orderkey, o_orderpriority, o_orderstatus, true AS keeps_nulls FROM orders"

    # Whole view graph, from JSON with dedup to the final view.
    deduped_companies = f"""
        SELECT a.published_at, c.* FROM ({ORDER_DEDUPED}) a JOIN ({COMPANIES}) c ON c.feedly_id = a.feedly_id
    """
    deduped_topics = f"""
        SELECT a.published_at, t.topic_label AS ranked_name, t.topic_score FROM ({ORDER_DEDUPED}) a
        JOIN ({TOPICS}) t ON t.feedly_id = a.feedly_id JOIN ({CANONICAL}) l ON l.topic_label = t.topic_label
    """
    for g in GRAINS:
        sql[f"view_ranked_companies_by_{g}"] = board(f"SELECT * FROM ({deduped_companies}) WHERE name IS NOT NULL", "name", g)
        sql[f"view_ranked_categories_by_{g}"] = board(
            f"SELECT published_at, unnest(categories) AS category FROM ({deduped_companies})", "category", g)
        sql[f"view_ranked_category_groups_by_{g}"] = board(
            f"SELECT published_at, unnest(groups) AS category_group FROM ({deduped_companies})", "category_group", g)
        sql[f"view_ranked_companies_by_categories_by_{g}"] = board(
            f"SELECT published_at, name, unnest(categories) AS category FROM ({deduped_companies})", "name", g, within="category")
        sql[f"view_ranked_topics_by_{g}"] = board(deduped_topics, "ranked_name", g, where="topic_score >= 0.35")
        for subject, one in (("topics", "topic"), ("keywords", "keyword"), ("entities", "entity")):
            key = f"view_article_{subject}_by_{g}"
            sql[key] = counts(doc_topics(), "topic_label", g) if one == "topic" else sql[f"period_counts_{one}_{g}"]
    for name, same in (
        ("feedly_entry_details", "entry_details"), ("article_common_topics", "common_topics"),
        ("article_entities", "feed_entities"), ("article_keywords", "keywords"),
        ("article_summary_sentences", "summary_sentences"), ("article_priorities", "priorities"),
        ("article_common_common_topic_list", "topic_list"), ("article_entity_list", "entity_list"),
        ("article_keyword_list", "keyword_list"), ("organization_categories", "org_categories"),
        ("organization_category_groups", "org_category_groups"), ("categories_with_category_groups", "category_map"),
        ("category_list", "category_list"), ("category_groups_list", "group_list"),
    ):
        sql[f"view_{name}"] = sql[same]
    parts = f"""part WHERE p_partkey IN (
        SELECT p_partkey FROM part
        QUALIFY row_number() OVER (PARTITION BY {soundex('p_name')} ORDER BY p_size DESC, 'part/' || p_partkey) = 1)"""
    for name in ("entities_by_topics", "entities_by_keywords"):
        sql[f"view_article_{name}"] = sql[name].replace("FROM part)", f"FROM {parts})")

    kept = f"SELECT feedly_id FROM ({ORDER_DEDUPED})"

    def in_graph(text: str) -> str:
        """The same over the articles that are left when copies are gone."""
        for given in (ORDER_ARTICLES, ENTITIES, TOPICS):
            text = text.replace(f"({given})", f"(@{len(given)})")
        for given in (ORDER_ARTICLES, ENTITIES, TOPICS):
            text = text.replace(f"(@{len(given)})", f"(SELECT * FROM ({given}) WHERE feedly_id IN ({kept}))")
        return text

    unlimited = lambda text: text.replace("LIMIT 10", "").replace("1998-06-15", "1995-07-10")
    for name, same in (
        ("article_nlp_topics", sql["analysis_topics"]), ("article_nlp_entities", sql["analysis_entities"]),
        ("article_nlp_companies", sql["companies"]), ("nlp_topics", LABELS), ("topics", CANONICAL),
        ("nlp_entities_without_concepts", sql["uncovered_types"]),
        ("company_articles_with_sectors", sql["company_articles"]), ("channel_articles", sql["route"]),
        ("channel_article_details", sql["channel_details"]),
        ("channel_articles_unsent_by_channel_and_target", sql["unsent"]),
        ("latest_articles", unlimited(LATEST)), ("top_articles_last_24_hours", unlimited(TOP)),
    ):
        sql[f"view_{name}"] = in_graph(same)
    for name, same in (("article_nlp_categories", "analysis_categories"), ("article_nlp_text", "analysis_text")):
        sql[f"view_{name}"] = f"SELECT * FROM ({sql[same]}) WHERE feedly_id IN ({kept})"
    sql["view_article_rankings"] = f"""
        SELECT feedly_id, published_day, popularity_by_month FROM ({in_graph(sql["article_rankings"])})
    """
    sql["view_articles"] = f"""
        SELECT feedly_id, site, title, url, {day('published_at')} AS published_at FROM ({ORDER_DEDUPED})
    """
    sql["materialize"] = sql["board_company_month"]

    odd = "CASE doc_id % 6 WHEN 0 THEN {} WHEN 1 THEN {} WHEN 3 THEN {} END"
    at = "strftime(TIMESTAMP '2020-01-01' + to_hours(doc_id), '%Y-%m-%d %H:%M:%S')"
    sql["feed_numbers"] = f"""
        SELECT 'doc/' || doc_id AS feedly_id, {odd.format(at, 'NULL', 'NULL')} AS published_at,
               {odd.format(at, 'NULL', 'NULL')} AS crawled_at,
               coalesce({odd.format('CAST(n_chars AS DOUBLE)', '9e18', '1e300')}, 0) AS engagement,
               {odd.format('CAST(n_chars AS DOUBLE)', '9e18', '1e300')} AS topic_score
        FROM documents
    """
    sql["all_alternates"] = """
        SELECT 'page/' || page_id AS feedly_id, unnest(
            CASE WHEN len(l) = 0 THEN [NULL] ELSE l END) AS url
        FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages)
    """
    sql["seed_files"] = """
        SELECT CAST(n_nationkey + 1 AS BIGINT) AS id, n_name AS concept_name, n_name AS entity_type,
               CAST(0.2 AS DOUBLE) AS relevance, '#' || n_name AS target_id, '1998-06-15 00:00:00' AS created_at FROM nation
    """
    flag = "CASE WHEN l_returnflag <> 'N' THEN l_returnflag END"
    sql["null_sets"] = f"""
        SELECT l_orderkey,
               concat_ws('|', string_agg(DISTINCT f, '|' ORDER BY f), CASE WHEN bool_or(f IS NULL) THEN '<null>' END) AS with_nulls,
               coalesce(string_agg(DISTINCT f, '|' ORDER BY f), '<null>') AS without,
               string_agg(coalesce(f, '<null>'), '|' ORDER BY l_linenumber, l_partkey, l_extendedprice) AS in_order
        FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, {flag} AS f FROM lineitem) GROUP BY l_orderkey
    """
    sql["ordered_board"] = f"""
        SELECT time_period, name, rank, CAST(row_number() OVER (PARTITION BY time_period ORDER BY rank, name) AS INTEGER) AS place
        FROM ({sql["board_company_month"]})
    """
    sql["refresh"] = f"""
        SELECT feedly_id, title, count(*) AS n_topics FROM ({ORDER_DEDUPED}) JOIN ({TOPICS}) USING (feedly_id) GROUP BY ALL
    """
    sql["check_tables"] = """
        SELECT * FROM (
            SELECT 'feedly_entries' AS table_name, 'unique (feedly_id)' AS rule,
                   (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)) AS n_violations
            UNION ALL SELECT 'feedly_entries', 'published_at not null', (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R')
            UNION ALL SELECT 'channel_concepts', 'channel_id in channels',
                   (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
        ) WHERE n_violations > 0
    """
    sql["unsent_always"] = f"""
        SELECT CAST(channel_id AS BIGINT) AS channel_id, d.feedly_id, a.title, topic_labels,
               CASE WHEN channel_id = 2 THEN {second('last_sent_at')} END AS last_sent_at
        FROM ({DETAILS}) d JOIN ({ORDER_ARTICLES}) a ON a.feedly_id = d.feedly_id
        WHERE channel_id = 1 OR a.created_at > d.last_sent_at
    """
    sql["stream_routing"] = f"""
        SELECT CAST(channel_id AS BIGINT) AS channel_id, feedly_id, text, headline, captions FROM ({OUTBOX})
    """
    sql["stream_routing_early"] = sql["stream_routing"]
    sql["unsent_documents"] = sql["unsent"]
    sql["refresh_changes"] = sql["refresh"]
    sql["stream_board"] = sql["board_company_month"]
    sql["upsert_buckets"] = sql["upsert"]
    sql["defaults"] = """
        SELECT CASE WHEN c_custkey % 2 = 0 THEN row_number() OVER (PARTITION BY c_custkey % 2 ORDER BY c_custkey)
                    ELSE (SELECT count(*) FROM customer WHERE c_custkey % 2 = 0)
                         + row_number() OVER (PARTITION BY c_custkey % 2 ORDER BY c_custkey) END AS id,
               key AS feedly_id, CASE WHEN c_custkey % 2 = 0 THEN '2001-01-01' ELSE '2002-01-01' END AS created_at,
               '2002-01-01' AS updated_at,
               CASE WHEN c_acctbal > 0 THEN '{"title":"' || c_name || '"}' ELSE '{}' END AS payload,
               concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) AS uuid
        FROM (SELECT *, md5('=' || key) AS h FROM (
            SELECT *, 'customer/' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS key FROM customer))
    """
    sql["register_tables"] = """
        SELECT table_name, CAST(s_suppkey AS VARCHAR) AS key, s_name AS name,
               'He said "' || s_name || '",' || chr(10) || 'then left' AS note,
               CASE WHEN table_name <> 'organization_categories' THEN CAST(s_suppkey AS BIGINT) END AS rank
        FROM supplier, (VALUES ('category_groups'), ('organizations'), ('organization_descriptions'),
                               ('organization_categories'), ('org_parents')) t(table_name)
    """
    sql["ordered_unsent"] = f"""
        SELECT CAST(channel_id AS BIGINT) AS channel_id, feedly_id, {day('published_at')} AS published_at,
               CAST(row_number() OVER (PARTITION BY channel_id ORDER BY published_at NULLS LAST, feedly_id) AS INTEGER) AS place
        FROM ({UNSENT})
    """
    sql["stream_windowed"] = """
        SELECT strftime(ts, '%Y-%m-%d') AS time_period, event_type AS topic_label, count(*) AS count FROM events GROUP BY ALL
    """

    # Streams: equal to the batch result.
    sql["stream_upsert"] = f"""
        SELECT 'user/' || user_id AS feedly_id, {second('min(ts)')} AS created_at, {second('max(ts)')} AS updated_at,
               arg_max(event_type, (ts, event_id)) AS title FROM events GROUP BY user_id
    """
    sql["stream_compact"] = sql["stream_upsert"]
    sql["stream_counts"] = counts(EVENT_MENTIONS, "topic_label", "week")
    sql["stream_unsent"] = f"""
        SELECT CAST(channel_id AS BIGINT) AS channel_id, 'event/' || event_id AS feedly_id,
               {second('ts')} AS created_at,
               'I found a new article about ' || icon || ' ' || name || '.' || chr(10) || chr(10)
                 || 'It mentions ' || event_type || '.' AS text
        FROM (
            SELECT *, CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 2 END AS channel_id FROM events
        ) JOIN (VALUES (1, 'Pop Culture', ':tv:', TIMESTAMP '2024-01-10'),
                       (2, 'Sports', ':trophy:', TIMESTAMP '2024-01-20')) c(id, name, icon, mark) ON id = channel_id
        WHERE ts > mark
    """
    sql["stream_watermarks"] = f"""
        SELECT CAST(id AS BIGINT) AS id, {second('greatest(mark, max(ts))')} AS last_sent_at
        FROM (
            SELECT *, CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 2 END AS channel_id FROM events
        ) JOIN (VALUES (1, TIMESTAMP '2024-01-10'), (2, TIMESTAMP '2024-01-20')) c(id, mark) ON id = channel_id
        GROUP BY id, mark
    """
    return sql
