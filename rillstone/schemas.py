"""Explicit schemas of the record types; nothing in the library infers a schema."""

from __future__ import annotations

SENSOR = "id string, timestamp bigint, temperature double"
USER_BEHAVIOR = "userId bigint, itemId bigint, categoryId int, behavior string, timestamp bigint"
MAIL = "appKey string, appVersion string, deviceId string, phoneNo string"

# The analytics tables the catalogue reads.
EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CUSTOMER = (
    "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
)
TABLES = {
    "events": EVENTS,
    "documents": DOCUMENTS,
    "customer": CUSTOMER,
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}
