"""Spark schemas of the stored tables and of the two JSON documents."""

ENTRIES = """
    id bigint, created_at timestamp_ntz, updated_at timestamp_ntz,
    published_at timestamp_ntz, feedly_id string, payload string
"""

ANALYSES = """
    created_at timestamp_ntz, updated_at timestamp_ntz, feedly_id string,
    payload string, status_code int, status_at timestamp_ntz, parsed_at timestamp_ntz
"""

CHANNELS = """
    id bigint, created_at timestamp_ntz, updated_at timestamp_ntz, name string,
    description string, target string, target_id string, emoji_icon string,
    last_sent_at timestamp_ntz
"""

CONCEPTS = """
    id bigint, created_at timestamp_ntz, updated_at timestamp_ntz, name string,
    description string, emoji_icon string
"""

CHANNEL_CONCEPTS = """
    id bigint, created_at timestamp_ntz, updated_at timestamp_ntz,
    channel_id bigint, concept_id bigint
"""

RULES = """
    id bigint, created_at timestamp_ntz, updated_at timestamp_ntz,
    concept_id bigint, entity_type string,
    entity_confidence_score_threshold decimal(5,3),
    entity_relevance_score_threshold decimal(5,3),
    topic_score_threshold decimal(5,3), emoji_icon string
"""

CHANNEL_LOGS = """
    id bigint, created_at timestamp_ntz, updated_at timestamp_ntz,
    channel_id bigint, feedly_id string,
    pending_at timestamp_ntz, sent_at timestamp_ntz
"""

_ORG_HEAD = """
    uuid string, name string, type string, permalink string, cb_url string,
    rank bigint, created_at timestamp_ntz, updated_at timestamp_ntz
"""

# Register files, by table name, in file column order.
REGISTER = {
    "category_groups": """
        id string, name string, type string, permalink string, cb_url string,
        rank bigint, created_at timestamp_ntz, updated_at timestamp_ntz,
        category_groups_list string
    """,
    "organizations": _ORG_HEAD + """,
        legal_name string, roles string, domain string, homepage_url string,
        country_code string, state_code string, region string, city string,
        address string, postal_code string, status string, short_description string,
        category_list string, category_groups_list string, num_funding_rounds int,
        total_funding_usd decimal(18,0), total_funding decimal(18,0),
        total_funding_currency_code string, founded_on date, last_funding_on date,
        closed_on date, employee_count string, email string, phone string,
        facebook_url string, linkedin_url string, twitter_url string, logo_url string,
        alias1 string, alias2 string, alias3 string, primary_role string, num_exits int
    """,
    "organization_descriptions": _ORG_HEAD + ", description string",
    "organization_categories": "organization_uuid string, organization_name string, category string",
    "org_parents": _ORG_HEAD + ", parent_uuid string, parent_name string",
}

# JSON documents.  Scalars are text (see functions.json); fields that feeds may
# send either nested or string-encoded are text here and decoded by a second
# schema below.
ENTRY_PAYLOAD = """
    id string, title string, author string, fingerprint string, originId string,
    ampUrl string, canonicalUrl string, published string, crawled string,
    engagement string, engagementRate string,
    alternate array<struct<href:string>>, visual string, enclosure string,
    content string, summary string, leoSummary string, commonTopics string,
    entities string, keywords array<string>, priorities array<string>
"""
HREFS = "array<struct<href:string>>"
TEXT_BLOCK = "struct<content:string>"
VISUAL = "struct<url:string>"
SUMMARY_TEXT = "struct<sentences:string>"
SENTENCES = "array<struct<text:string,position:string,score:string>>"
COMMON_TOPICS = "array<struct<id:string,label:string,score:string,salienceLevel:string>>"
FEED_ENTITIES = "array<struct<id:string,label:string,salienceLevel:string>>"
PRIORITY = """struct<id:string,label:string,
    searchTerms:struct<parts:array<struct<id:string,label:string>>>>"""

ANALYSIS_PAYLOAD = """
    cleanedText string,
    topics array<struct<id:string,label:string,score:string,wikiLink:string,wikidataId:string>>,
    entities array<struct<type:array<string>,entityEnglishId:string,unit:string,
        crunchbaseId:string,figi:string,freebaseId:string,lei:string,permid:string,
        wikidataId:string,wikiLink:string,matchedText:string,startingPos:string,
        endingPos:string,matchingTokens:array<int>,relevanceScore:string,
        confidenceScore:string>>,
    categories array<struct<id:string,label:string,score:string,categoryId:string,
        classifierId:string>>
"""
