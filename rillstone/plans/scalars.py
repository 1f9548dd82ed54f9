"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.functions import collections as coll
from rillstone.functions import signing, strings
from rillstone.functions.extensions import map_with_setup
from rillstone.functions.timing import event_time
from rillstone.operators import topn, windows, words
from rillstone.plans.catalog import BEHAVIOR, HOPS, MAIL, SENSOR, WORDS, register, with_
from rillstone.sources import tables, text

UTF16_LENGTH = (
    "cast(length({0}) + length(regexp_replace({0}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')) as int)"
)


@register("map_length", f"select doc_id, {UTF16_LENGTH.format('text')} as len from documents")
def map_length(spark, sf):
    docs = tables.table(spark, sf, "documents")
    return docs.select("doc_id", strings.utf16_length(F.col("text")).alias("len"))


@register("flat_map_split", with_(WORDS) + "select doc_id, word from words")
def flat_map_split(spark, sf):
    return words.flat_map_split(tables.table(spark, sf, "documents"), "text", " ", ["doc_id"])


@register("filter_equals", with_(WORDS) + "select doc_id, word from words where word = 'the'")
def filter_equals(spark, sf):
    found = words.flat_map_split(tables.table(spark, sf, "documents"), "text", " ", ["doc_id"])
    return found.filter(F.col("word") == "the")


@register("map_id_length", with_(SENSOR) + "select id, cast(length(id) as int) as len from sensor")
def map_id_length(spark, sf):
    return tables.sensor(spark, sf).select("id", F.length("id").alias("len"))


@register("map_id_time", with_(SENSOR) + 'select id, "timestamp" from sensor')
def map_id_time(spark, sf):
    return tables.sensor(spark, sf).select("id", "timestamp")


@register("map_id_temp", with_(SENSOR) + "select id, temperature from sensor")
def map_id_temp(spark, sf):
    return tables.sensor(spark, sf).select("id", "temperature")


@register("partition_setup_map", with_(SENSOR) + "select id, temperature * 2 as temperature from sensor")
def partition_setup_map(spark, sf):
    return map_with_setup(
        tables.sensor(spark, sf).select("id", "temperature"),
        setup=lambda: 2.0,
        apply=lambda factor, batch: batch.assign(temperature=batch.temperature * factor),
        teardown=lambda factor: None,
        schema="id string, temperature double",
    )


@register(
    "select_where_eq", with_(SENSOR) + "select id, temperature from sensor where id = 'sensor_1'"
)
def select_where_eq(spark, sf):
    return tables.sensor(spark, sf).where(F.col("id") == "sensor_1").select("id", "temperature")


@register(
    "select_where_ne", with_(SENSOR) + "select id, temperature from sensor where id <> 'sensor_1'"
)
def select_where_ne(spark, sf):
    text.as_view(tables.sensor(spark, sf), "sensor_ne")
    return spark.sql("select id, temperature from sensor_ne where id <> 'sensor_1'")


@register("select_star", with_(SENSOR) + "select * from sensor")
def select_star(spark, sf):
    text.as_view(tables.sensor(spark, sf), "sensor_star")
    return spark.sql("select * from sensor_star")


@register("filter_behavior", with_(BEHAVIOR) + "select * from behavior where behavior = 'pv'")
def filter_behavior(spark, sf):
    return tables.user_behavior(spark, sf).where(F.col("behavior") == "pv")


@register("json_to_mail", with_(MAIL) + "select * from mail")
def json_to_mail(spark, sf):
    return text.json_to_mail(tables.mail_json(spark, sf))


@register(
    "from_unixtime_ts",
    with_(SENSOR) + 'select id, seq, "timestamp" * 1000 as ts_ms from sensor',
)
def from_unixtime_ts(spark, sf):
    timed = tables.sensor(spark, sf).withColumn("ts", event_time(F.col("timestamp")))
    return timed.select("id", "seq", F.unix_millis("ts").alias("ts_ms"))


@register(
    "format_topn_report",
    with_(BEHAVIOR, HOPS)
    + """select window_end, '=====================' || chr(10) || '窗口结束时间: '
      || strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
      || string_agg('No ' || row_num || ': 商品ID= ' || "itemId" || ' 热门度= ' || cnt,
                    chr(10) order by row_num)
      || chr(10) || '===============================' || chr(10) as report
    from ranked where row_num <= 5 group by window_end""",
)
def format_topn_report(spark, sf):
    return topn.format_report(topn.hot_items(hot_counts(spark, sf)))


def hot_counts(spark, sf):
    """Page views per item in 1 h windows sliding by 5 min."""
    rows = tables.user_behavior(spark, sf).withColumn("ts", F.timestamp_seconds("timestamp"))
    return windows.hop_count(rows, "itemId", "ts", 3_600_000, 300_000, F.col("behavior") == "pv")


@register(
    "math_scalars",
    """select event_id, abs(value - user_id) as gap, greatest(value, cast(user_id as double)) as larger,
       least(cast(5 as bigint), user_id) as capped, cast(floor(user_id / 2) as bigint) as half
    from events""",
)
def math_scalars(spark, sf):
    e = tables.table(spark, sf, "events")
    return e.select(
        "event_id",
        F.abs(F.col("value") - F.col("user_id")).alias("gap"),
        F.greatest("value", F.col("user_id").cast("double")).alias("larger"),
        F.least(F.lit(5).cast("bigint"), "user_id").alias("capped"),
        F.floor(F.col("user_id") / 2).alias("half"),
    )


@register(
    "url_codec",
    """select page_id,
      replace(replace(replace(url_encode(url), '%20', '+'), '~', '%7E'), '%2A', '*') as encoded,
      url as decoded from pages""",
)
def url_codec(spark, sf):
    pages = tables.table(spark, sf, "pages")
    coded = pages.select("page_id", signing.url_encode(F.col("url")).alias("encoded"))
    return coded.select("page_id", "encoded", signing.url_decode(F.col("encoded")).alias("decoded"))


REQUEST_SQL = (
    "'GET' || chr(10) || '*/*' || chr(10) || '' || chr(10) || '' || chr(10) || '2024-01-01 00:00:00'"
    " || chr(10) || 'x-app-key:' || page_id || chr(10) || 'x-signature-method:HmacSHA256'"
    " || chr(10) || regexp_extract(url, '^[a-z]+://[^/]*(/.*)$', 1)"
)


def request_parts():
    """The seven parts of a request, taken from a page's address."""
    headers = F.concat(
        F.lit("x-app-key:"), F.col("page_id").cast("string"), F.lit("\nx-signature-method:HmacSHA256")
    )
    return [
        F.lit("GET"),
        F.lit("*/*"),
        F.lit(None).cast("string"),
        F.lit(""),
        F.lit("2024-01-01 00:00:00"),
        headers,
        F.regexp_extract("url", "^[a-z]+://[^/]*(/.*)$", 1),
    ]


@register("canonical_request", f"select page_id, {REQUEST_SQL} as request from pages")
def canonical_request(spark, sf):
    pages = tables.table(spark, sf, "pages")
    return pages.select("page_id", signing.canonical_request(*request_parts()).alias("request"))


# A key for checking only; real keys come from the caller.
CHECK_KEY = b"check-key"
INNER_PAD = bytes(b ^ 0x36 for b in CHECK_KEY.ljust(64, b"\0")).hex()
OUTER_PAD = bytes(b ^ 0x5C for b in CHECK_KEY.ljust(64, b"\0")).hex()


@register(
    "sign_requests",
    f"""select page_id, base64(unhex(sha256(unhex('{OUTER_PAD}') ||
      unhex(sha256(unhex('{INNER_PAD}') || encode({REQUEST_SQL})))))) as signature, true as valid
    from pages""",
)
def sign_requests(spark, sf):
    signed = signing.sign_requests(tables.table(spark, sf, "pages"), request_parts(), CHECK_KEY)
    checked = signing.verify_requests(signed, request_parts(), F.col("signature"), CHECK_KEY)
    return checked.select("page_id", "signature", "valid")


@register(
    "extract_digits",
    r"""select page_id, unnest(regexp_extract_all(html, '\d{3,5}', 0)) as digits from pages""",
)
def extract_digits(spark, sf):
    pages = tables.table(spark, sf, "pages")
    found = strings.find_all(F.col("html"), strings.DIGIT_RUN)
    return pages.select("page_id", F.explode(found).alias("digits"))


@register(
    "extract_quoted",
    r"""select page_id, unnest(regexp_extract_all(html, '"((?:\\"|[^"]|\\")+)"', 1)) as quoted from pages""",
)
def extract_quoted(spark, sf):
    pages = tables.table(spark, sf, "pages")
    found = strings.find_all(F.col("html"), strings.QUOTED_STRING, 1)
    return pages.select("page_id", F.explode(found).alias("quoted"))


@register(
    "map_values_upper",
    """select conv_id, turn, 'role' as k, upper(role) as v from conversations
    union all select conv_id, turn, 'text', upper(replace(text, 'ß', 'ss')) from conversations""",
)
def map_values_upper(spark, sf):
    turns = tables.table(spark, sf, "conversations")
    m = F.create_map(F.lit("role"), "role", F.lit("text"), "text")
    return turns.select("conv_id", "turn", F.explode(coll.upper_values(m)).alias("k", "v"))


INTS_SQL = "list_transform(embedding, lambda x: cast(floor(cast(x as double) * 100) as int))"


def int_vectors(spark, sf):
    """The embeddings in hundredths, as int arrays."""
    vectors = tables.table(spark, sf, "embeddings")
    ints = F.transform("embedding", lambda x: F.floor(x.cast("double") * 100).cast("int"))
    return vectors.select("vec_id", ints.alias("arr"))


def list_text(arr):
    return F.concat_ws(",", arr.cast("array<string>"))


@register(
    "array_sort_dir",
    f"""with v as (select vec_id, {INTS_SQL} as arr from embeddings)
    select vec_id, array_to_string(list_sort(arr, 'ASC'), ',') as up,
      array_to_string(list_sort(arr, 'DESC'), ',') as down from v""",
)
def array_sort_dir(spark, sf):
    arr = F.col("arr")
    return int_vectors(spark, sf).select(
        "vec_id",
        list_text(coll.sort_ints(arr)).alias("up"),
        list_text(coll.sort_ints(arr, False)).alias("down"),
    )


@register(
    "array_partition_pivot",
    f"""with v as (select vec_id, {INTS_SQL} as arr from embeddings)
    select vec_id, array_to_string(list_filter(arr, lambda x: x <= len(arr) // 2), ',') as small,
      array_to_string(list_filter(arr, lambda x: x > len(arr) // 2), ',') as large from v""",
)
def array_partition_pivot(spark, sf):
    small, large = coll.partition_pivot(F.col("arr"), coll.half_length(F.col("arr")))
    return int_vectors(spark, sf).select(
        "vec_id", list_text(small).alias("small"), list_text(large).alias("large")
    )


@register(
    "lambda_add",
    f"""with v as (select vec_id, {INTS_SQL} as arr from embeddings),
    e as (select vec_id, unnest(arr) as x, unnest(list_reverse(arr)) as y,
      generate_subscripts(arr, 1) as i from v)
    select vec_id, string_agg(cast(x + y as varchar), ',' order by i) as sums from e group by vec_id""",
)
def lambda_add(spark, sf):
    added = coll.zip_apply(F.col("arr"), F.reverse("arr"), lambda x, y: x + y)
    return int_vectors(spark, sf).select("vec_id", list_text(added).alias("sums"))
