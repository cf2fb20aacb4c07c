"""Explicit schemas.  Field names of the source are data: they stay rows, never columns."""

from __future__ import annotations

MEDIA = "struct<type:string,label:string,alt_text:string,caption:string,url:string>"
IMAGE = "struct<url:string,width:int,height:int>"
IMAGES = "array<struct<alt_text:string,caption:string,url:string,width:int,height:int>>"
ASSETS = f"struct<flag:{IMAGE},map:{IMAGE},locator_map:{IMAGE},images:{IMAGES}>"
METADATA = (
    "struct<name:string,region:string,updated:string,field_count:int,"
    "scraped_at:string,source_url:string,error:string>"
)
RAW_FIELD = (
    "struct<name:string,data:string,database_id:string,category:string,"
    f"subfields:array<string>,has_ranking:boolean,media:array<{MEDIA}>>"
)

#: one landed entity document; ``category`` is null until enrichment
RAW_DOCUMENT = (
    "entity string, scraped_at string, source_url string, scrape_success boolean, "
    f"data struct<metadata:{METADATA},assets:{ASSETS},fields:array<{RAW_FIELD}>>"
)

SUB_VALUE = "struct<value:string,year:string>"
#: the three value shapes of the source as one struct; unused members are null
VALUE = f"struct<key:string,value:string,year:string,order:int,sub_values:array<{SUB_VALUE}>>"

CATEGORY_MAPPING = (
    "metadata struct<fetched_at:string,source_url:string,total_categories:int,total_fields:int>, "
    "mapping map<string,string>"
)

ENTITY_INDEX = (
    "metadata struct<scraped_at:string,sitemap_url:string,total_entities:int,total_urls:int,"
    "url_types:map<string,int>>, "
    "entities array<struct<slug:string,urls:struct<main:string,factsheet:string,images:string,"
    "flag:string,map:string,locator_map:string,other:array<string>>>>"
)

#: one stored index row per slug; its other URLs are rows of their own
INDEX_ROW = (
    "slug string, main string, factsheet string, images string, flag string, map string, "
    "locator_map string, other_count bigint"
)

FETCH_LOG = (
    "slug string, success boolean, scraped_at timestamp, source_url string, "
    "duration_seconds double, http_status int, exception_kind string, error string, "
    "error_details string"
)

#: header of the flat export, in output order
EXPORT_COLUMNS = [
    "Entity",
    "Entity Slug",
    "Field Name",
    "Database ID",
    "Category",
    "Structure Type",
    "Key",
    "Value",
    "Order",
    "Has Ranking",
]
