"""Record layouts shared by the jobs, as DDL text (readers, from_json and UDFs all take it)."""

from __future__ import annotations

ITEM = ("""
    id string, title string, url string, source_id string, source_name string, region string, source_type string,
    language string, published_at timestamp, first_seen timestamp, summary_raw string, authors array<string>,
    doi string, topic_filter boolean, source_weight double, date_is_first_seen boolean
""")

SOURCE = ("""
    id string, name string, type string, url string, region string, source_type string, language string,
    topic_filter boolean, weight double, enabled boolean, notes string, funding boolean, reserve boolean,
    protected boolean, max_items int, media_monitor boolean, media_only boolean, organization string,
    homepage string,
    scrape struct<item:string,title:string,link:string,date:string,date_attr:string,summary:string>
""")

SCORE = ("""
    item_id string, relevance int, topics array<string>, geo_focus string,
    is_public_attitudes_or_communication boolean, is_original_research boolean, relevant_to_cz_eu boolean,
    cz_impact int, eu_impact int, is_opinion boolean, is_event boolean, title_cs string, one_line_cs string,
    sentiment int
""")

MEDIA_CLASS = (
    "item_id string, relevant boolean, topic string, frame string, genre string, tone int")

SECTION_REF = (
    "week string, section string, pos int, text string, geo string, dated boolean, evidence_ids array<string>")

PERFORMANCE = (
    "week string, source_id string, n_window long, n_selected long, n_passed long")

SEEN = ("kind string, key string, week string")

HEALTH = ("""
    source_id string, name string, type string, url string, region string, enabled boolean, status string,
    detail string, count long, newest timestamp, checked_at timestamp
""")

OPPORTUNITY_DRAFT = (
    "pos int, item_id string, title_cs string, funder string, deadline string, summary_cs string")

PAYLOAD = (
    "payload_id string, source_id string, url string, content_type string, body string, fetched_at timestamp")

REPORT = ("""
    week string, generated_at timestamp, headline_cs string, items_considered int, items_selected int,
    sections array<struct<section:string,pos:int,text:string,geo:string,evidence_ids:array<string>>>,
    items array<struct<id:string,source_id:string,geo_focus:string,topics:array<string>,final_score:double,
        sentiment:int,is_event:boolean,has_summary:boolean>>
""")

# allowed values of the enumerated columns
REGIONS = ("CZ", "EU", "US", "GLOBAL")
SOURCE_TYPES = ("think_tank", "research", "polling", "government", "media", "journal", "ngo", "industry", "funding")
