"""Named queries over the test tables, each with its SQL twin where SQL can say it.

The tables stand in for feeds: orders for posts, lineitem and events for
metrics and child rows, customer for accounts.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedfold.functions.classify import NETWORK_TYPES, UNKNOWN_NETWORK, classify_url
from feedfold.functions.dates import compact_date, date_span, days_before
from feedfold.functions.keys import url_key
from feedfold.operators import merge, reshape, schema, split
from feedfold.operators.latest import latest_per_key
from feedfold.operators.offsets import next_offsets, run_offsets, starting_offsets
from feedfold.plans import jobs
from feedfold.session import scratch_path
from feedfold.sources import kafka, leftout, retention, sinks, synth, tables, touched
from feedfold.streaming import feeds

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(column: str) -> Column:
    return F.to_date(column)


# --- feeds made of the tables ----------------------------------------------

# Where a post of each order priority lives.
HOSTS = {
    "1-URGENT": "https://www.google.com/maps/",
    "2-HIGH": "https://t.me/",
    "3-MEDIUM": "https://yandex.com/",
    "4-NOT SPECIFIED": "https://zen.yandex.ru/",
}
OTHER_HOST = "https://nowhere.example/"

URL_SQL = (
    "CASE o_orderpriority "
    + " ".join(f"WHEN '{p}' THEN '{h}'" for p, h in HOSTS.items())
    + f" ELSE '{OTHER_HOST}' END || o_orderkey"
)


def day_bounds(rows: DataFrame, column: Column) -> tuple[date, date]:
    """First and last day that occur: the window that takes in all rows. Any day will do where there are none."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    return low or date(1970, 1, 1), high or date(1970, 1, 1)


def order_url() -> Column:
    host = None
    for priority, prefix in HOSTS.items():
        hit = F.col("o_orderpriority") == priority
        host = F.when(hit, prefix) if host is None else host.when(hit, prefix)
    return F.concat(host.otherwise(OTHER_HOST), F.col("o_orderkey").cast("string"))


def event_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages of a feed with four partitions."""
    return table(spark, sf_dir, "events").select(
        F.col("props").cast("binary").alias("value"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


def post_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer as nested post records."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    price = F.col("o_totalprice")
    attachment = F.struct(
        F.col("o_orderpriority").alias("Name"),
        F.col("o_orderstatus").alias("Kind"),
        F.struct(F.length("o_orderpriority").alias("SymbolCount"), F.lit(1).alias("WordCount")).alias("BodyStats"),
        F.struct(
            F.col("c_name").alias("Body"),
            F.array(F.struct(price.alias("Left"), F.col("o_orderkey").alias("Ref"))).alias("Boxes"),
            F.struct(F.col("c_mktsegment").alias("Caption")).alias("Meta"),
        ).alias("Ocr"),
    )
    second = F.struct(
        F.col("c_mktsegment").alias("Name"),
        F.lit("extra").alias("Kind"),
        F.struct(F.length("c_mktsegment").alias("SymbolCount"), F.lit(2).alias("WordCount")).alias("BodyStats"),
        F.struct(
            F.lit(None).cast("string").alias("Body"),
            F.array(F.struct(price.alias("Left"), F.col("o_custkey").alias("Ref"))).alias("Boxes"),
            F.struct(F.lit("none").alias("Caption")).alias("Meta"),
        ).alias("Ocr"),
    )
    place = F.struct(F.col("c_nationkey").alias("Type"), F.col("c_mktsegment").alias("Caption"))
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        order_url().alias("Url"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("CreateDate"),
        F.struct(
            F.col("o_custkey").alias("Key"),
            F.col("c_name").alias("Name"),
            F.col("c_mktsegment").alias("Host"),
            F.struct(F.col("c_nationkey").alias("Nation")).alias("Place"),
        ).alias("Author"),
        F.struct(
            F.col("c_nationkey").alias("Type"),
            F.struct(F.col("c_acctbal").alias("FollowerCount")).alias("Metrics"),
            F.lit("x").alias("SubTitle"),
        ).alias("Blog"),
        F.struct(F.col("o_orderkey").alias("LikeCount"), F.col("o_custkey").alias("ViewCount")).alias("Metrics"),
        F.col("o_orderstatus").alias("Body"),
        F.col("o_orderpriority").alias("SourceType"),
        F.when(F.col("o_orderstatus") == "O", F.array(attachment, second))
        .when(F.col("o_orderstatus") == "P", F.array(attachment))
        .alias("Attachments"),
        F.when(F.col("o_orderstatus") != "F", F.array(place)).alias("GeoData"),
        F.struct((F.col("o_orderstatus") == "P").alias("IsModified"), F.col("o_orderkey").alias("Status")).alias(
            "ModificationInfo"
        ),
    )


POST_POLICY = split.FieldPolicy(
    excludes={
        "Author": ["Host"],
        "Blog": ["SubTitle"],
        "Attachments": ["Name", "Ocr.Boxes"],
        "Body": [],
        "GeoData": [],
        "ModificationInfo": [],
    },
    primary=("Author.Key", "Blog.Type", "Blog.Metrics.FollowerCount", "CreateDate", "Metrics.LikeCount", "Url", "Nowhere"),
)


def keyed_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.keyed_posts(post_records(spark, sf_dir))


POSTS_SQL = f"""posts AS (
  SELECT md5({URL_SQL}) AS "Id", {URL_SQL} AS "Url",
         strftime(o_orderdate, '%Y-%m-%d') AS "PostCreateDate", CAST(o_orderdate AS DATE) AS "PartDate", *
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""


# --- messages, schemas ------------------------------------------------------

@query(
    """SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k,
              CAST(user_id % 4 AS INTEGER) AS kafkapartition, event_id AS kafkaoffset
       FROM events"""
)
def json_infer_parse(spark, sf_dir):
    envelope = event_envelope(spark, sf_dir)
    parsed = schema.parse_json_rows(envelope, schema.infer_json_schema(envelope))
    return parsed.select("_json.k", F.col("partition").alias("kafkapartition"), F.col("offset").alias("kafkaoffset"))


@query(
    f"""SELECT o_orderkey AS "Key", o_custkey AS "AuthorKey", o_orderstatus AS "AuthorStatus",
               o_totalprice AS "Price", {URL_SQL} AS "Url"
        FROM orders"""
)
def json_nested_roundtrip(spark, sf_dir):
    """Nested records to JSON and back through an inferred schema."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Key"),
        F.struct(F.col("o_custkey").alias("Key"), F.col("o_orderstatus").alias("Status")).alias("Author"),
        F.col("o_totalprice").alias("Price"),
        order_url().alias("Url"),
    )
    messages = sinks.as_json(orders)
    parsed = schema.parse_json_rows(messages, schema.infer_json_schema(messages)).select("_json.*")
    return reshape.flatten_structs(parsed.drop(schema.UNPARSED), ["Author"])


@query(
    """SELECT c_custkey AS "Key", c_name AS "Name", c_acctbal AS "Balance"
       FROM customer"""
)
def to_json_sink(spark, sf_dir):
    """Rows to JSON lines on storage and back."""
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Key"), F.col("c_name").alias("Name"), F.col("c_acctbal").alias("Balance")
    )
    path = scratch_path(spark, "json")
    sinks.save_json(rows, path)
    lines = spark.read.text(path)
    return schema.parse_json_rows(lines, schema.infer_json_schema(lines)).select("_json.Key", "_json.Name", "_json.Balance")


@query(
    """SELECT p_partkey, p_brand AS label, p_size AS size, CAST(NULL AS VARCHAR) AS note,
              CAST(p_partkey AS VARCHAR) AS code
       FROM part WHERE p_type = 'ECONOMY'
       UNION ALL
       SELECT p_partkey, p_brand, p_size, p_name, p_type || '-' || p_partkey
       FROM part WHERE p_type <> 'ECONOMY'"""
)
def schema_align(spark, sf_dir):
    """Frames with a missing nested field and a clashing type under one schema."""
    part = table(spark, sf_dir, "part")
    older = part.where("p_type = 'ECONOMY'").select(
        "p_partkey",
        F.array(F.struct(F.col("p_brand").alias("label"), F.col("p_size").alias("size"))).alias("items"),
        F.col("p_partkey").alias("code"),
    )
    newer = part.where("p_type <> 'ECONOMY'").select(
        F.array(
            F.struct(F.col("p_size").alias("size"), F.col("p_name").alias("note"), F.col("p_brand").alias("label"))
        ).alias("items"),
        F.concat_ws("-", "p_type", "p_partkey").alias("code"),
        "p_partkey",
    )
    both = schema.union_drift(older, newer)
    return both.select("p_partkey", F.inline("items"), "code").select("p_partkey", "label", "size", "note", "code")


@query("SELECT o_orderkey AS k, o_custkey AS v, o_orderstatus AS s FROM orders")
def dedupe_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    twice = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").toDF("k", "v", "s", "V")
    return schema.dedupe_columns(twice)


@query(
    """SELECT event_id, event_type <> 'error' AS readable,
              CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
              CASE WHEN event_type = 'error' THEN 'broken ' || props END AS text
       FROM events"""
)
def unreadable_messages(spark, sf_dir):
    """Messages of which some are no JSON: left out of the schema, kept with their text."""
    events = table(spark, sf_dir, "events").withColumn(
        "value", F.when(F.col("event_type") == "error", F.concat(F.lit("broken "), "props")).otherwise(F.col("props"))
    )
    parsed = schema.parse_json_rows(events, schema.infer_json_schema(events))
    text = F.col(f"_json.{schema.UNPARSED}")
    return parsed.select("event_id", text.isNull().alias("readable"), "_json.k", text.alias("text"))


# --- keys, classes, dates ---------------------------------------------------

@query("SELECT page_id, md5(url) AS id, substring(sha1(url), 1, 32) AS id_sha1, substring(sha256(url), 1, 32) AS id_sha256 FROM pages")
def url_keys(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        url_key("url").alias("id"),
        url_key("url", "SHA-1").alias("id_sha1"),
        url_key("url", "SHA-256").alias("id_sha256"),
    )


# Fragments that occur in the page table's URLs.
PAGE_TYPES = {"example.com": 1, "example.net": 2, "example.org": 3, "blog.": 4, "www.": 5, "/fr/": 6, "spam-farm.example.org": 7}


def _types_sql(url: str, key: str, source: str, types: dict[str, int], default: int) -> str:
    rows = ", ".join(f"('{fragment}', {i})" for fragment, i in types.items())
    return f"""SELECT k AS {key}, CAST(coalesce(id, {default}) AS INTEGER) AS network FROM (
        SELECT s.k, t.id, row_number() OVER (PARTITION BY s.k ORDER BY length(t.f) DESC, t.f) AS r
        FROM (SELECT {key} AS k, {url} AS u FROM {source}) s
        LEFT JOIN (VALUES {rows}) t(f, id) ON contains(s.u, t.f)) WHERE r = 1"""


@query(_types_sql("url", "page_id", "pages", PAGE_TYPES, 0))
def classify_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", classify_url("url", PAGE_TYPES, 0).alias("network"))


@query(_types_sql(URL_SQL, "o_orderkey", "orders", NETWORK_TYPES, UNKNOWN_NETWORK))
def classify_posts(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", classify_url(order_url()).alias("network"))


@query(
    """SELECT event_id, CAST(ts AS DATE) AS "PartDate" FROM events
       WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"""
)
def part_date_window(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("CreateDate", F.col("ts").cast("string"))
    dated = reshape.derive_post_dates(events)
    return dated.where(merge.in_window("PartDate", "2024-01-08", "2024-01-21")).select("event_id", "PartDate")


@query(
    """SELECT user_id, CAST(d AS DATE) AS day, strftime(d, '%Y%m%d') AS label, CAST(d - INTERVAL 30 DAY AS DATE) AS lower_bound
       FROM (SELECT user_id, unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS d
             FROM events GROUP BY user_id)"""
)
def date_spans(spark, sf_dir):
    """All days between each user's first and last event."""
    ends = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.min(day("ts")).alias("first"), F.max(day("ts")).alias("last")
    )
    days = ends.select("user_id", F.explode(date_span("first", "last")).alias("day"))
    return days.select("user_id", "day", compact_date("day").alias("label"), days_before("day", 30).alias("lower_bound"))


@query("SELECT DISTINCT CAST(ts AS DATE) AS day FROM events")
def delta_dates(spark, sf_dir):
    return table(spark, sf_dir, "events").select(day("ts").alias("day")).distinct()


@query("SELECT o_orderkey, '' AS name, CAST(0 AS BIGINT) AS likes, 0.0::DOUBLE AS score, false AS spam, '' AS tag, CAST(0 AS INTEGER) AS n, DATE '1970-01-01' AS day FROM orders")
def synth_rows(spark, sf_dir):
    """A default record next to every order."""
    record = T.StructType.fromDDL(
        "name string, likes bigint, score double, spam boolean, tags array<struct<tag:string,n:int>>, day date"
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", *synth.default_columns(record))
    return rows.select("o_orderkey", "name", "likes", "score", "spam", F.inline("tags"), "day")


# --- policies and the split -------------------------------------------------

def _packed_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Key"),
        F.struct(
            F.col("o_custkey").alias("Id"),
            F.struct(F.col("o_orderstatus").alias("Status"), F.col("o_orderpriority").alias("Priority")).alias("Stats"),
        ).alias("Account"),
        F.col("o_totalprice").alias("Price"),
        F.lit("t").alias("_TRACE_ID"),
    )


@query(
    """SELECT o_orderkey AS "Key", o_custkey AS "AccountId", o_orderstatus AS "AccountStatsStatus",
              o_orderpriority AS "AccountStatsPriority"
       FROM orders"""
)
def exclude_primary_flatten(spark, sf_dir):
    policy = split.FieldPolicy.parse(
        '{"_TRACE_ID": [], "Price": []}', "Key, Account.Id,Account.Stats.Status, account.stats.Priority,Price"
    )
    flat = split.apply_policy(_packed_orders(spark, sf_dir), policy, "primary")
    return flat.withColumnRenamed("accountstatsPriority", "AccountStatsPriority")


@query(
    """SELECT o_orderkey AS "Key", o_totalprice AS "Price", o_custkey AS "AccountId",
              o_orderstatus AS "AccountStatsStatus", o_orderpriority AS "AccountStatsPriority"
       FROM orders"""
)
def exclude_only_flatten(spark, sf_dir):
    policy = split.FieldPolicy.parse('{"_trace_id": [], "CollectMessage": []}')
    kept = split.apply_policy(_packed_orders(spark, sf_dir), policy)
    return reshape.flatten_structs(reshape.flatten_structs(kept, ["Account"]), ["AccountStats"])


@query(
    f"""WITH {POSTS_SQL}
        SELECT "Id", "PostCreateDate", "PartDate", o_custkey AS "AuthorKey", c_nationkey AS "BlogType",
               c_acctbal AS "BlogMetricsFollowerCount", "PostCreateDate" AS "CreateDate",
               o_orderkey AS "MetricsLikeCount", "Url", '2001-08-01' AS "ExecDate"
        FROM posts"""
)
def split_primary(spark, sf_dir):
    return split.split_posts(keyed_posts(spark, sf_dir), POST_POLICY, "2001-08-01")[split.PRIMARY]


@query(
    f"""WITH {POSTS_SQL}
        SELECT "Id", "PostCreateDate", "PartDate", o_orderkey AS "MetricsLikeCount", o_custkey AS "MetricsViewCount",
               o_orderpriority AS "SourceType", c_name AS "AuthorName", c_nationkey AS "AuthorPlaceNation",
               c_acctbal AS "BlogMetricsFollowerCount", '2001-08-01' AS "ExecDate"
        FROM posts"""
)
def split_other(spark, sf_dir):
    other = split.split_posts(keyed_posts(spark, sf_dir), POST_POLICY, "2001-08-01")[split.OTHER]
    return reshape.flatten_structs(other, schema.struct_columns(other))


@query(
    f"""WITH {POSTS_SQL},
        rows AS (
          SELECT "Id", "PostCreateDate", "PartDate", o_orderstatus AS "Kind", CAST(length(o_orderpriority) AS INTEGER) AS "SymbolCount",
                 CAST(1 AS INTEGER) AS "WordCount", c_name AS "OcrBody", c_mktsegment AS "OcrCaption"
          FROM posts WHERE o_orderstatus IN ('O', 'P')
          UNION ALL
          SELECT "Id", "PostCreateDate", "PartDate", 'extra', CAST(length(c_mktsegment) AS INTEGER), CAST(2 AS INTEGER), NULL, 'none'
          FROM posts WHERE o_orderstatus = 'O'
          UNION ALL
          SELECT "Id", "PostCreateDate", "PartDate", NULL, NULL, NULL, NULL, NULL FROM posts WHERE o_orderstatus = 'F')
        SELECT *, '2001-08-01' AS "ExecDate" FROM rows"""
)
def split_attachments(spark, sf_dir):
    part = split.split_posts(keyed_posts(spark, sf_dir), POST_POLICY, "2001-08-01")[split.ATTACHMENTS]
    return reshape.flatten_structs(part, ["Ocr"])


@query(
    f"""WITH {POSTS_SQL}
        SELECT "Id", "PostCreateDate", "PartDate",
               CASE WHEN o_orderstatus <> 'F' THEN c_nationkey END AS "Type",
               CASE WHEN o_orderstatus <> 'F' THEN c_mktsegment END AS "Caption", '2001-08-01' AS "ExecDate"
        FROM posts"""
)
def split_geo(spark, sf_dir):
    return split.split_posts(keyed_posts(spark, sf_dir), POST_POLICY, "2001-08-01")[split.GEO]


@query(
    f"""WITH {POSTS_SQL}
        SELECT "Id", "PostCreateDate", "PartDate", o_orderstatus = 'P' AS "IsModified", o_orderkey AS "Status",
               '2001-08-01' AS "ExecDate"
        FROM posts"""
)
def split_modification(spark, sf_dir):
    return split.split_posts(keyed_posts(spark, sf_dir), POST_POLICY, "2001-08-01")[split.MODIFICATION]


@query('SELECT c_custkey AS "Id", c_name AS "Name", c_nationkey AS "Nation" FROM customer')
def struct_part_flatten(spark, sf_dir):
    boxed = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Id"),
        F.struct(F.col("c_name").alias("Name"), F.col("c_nationkey").alias("Nation")).alias("Info"),
        F.col("c_acctbal").alias("Balance"),
    )
    return reshape.flatten_struct(boxed, "Info", keys=["Id"])


@query('SELECT o_orderkey AS "Key", o_custkey AS "AccountId", o_totalprice AS "SumPrice" FROM orders')
def keyed_structs_flatten(spark, sf_dir):
    """Several structs with their names in front, next to the keys alone."""
    boxed = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Key"),
        F.struct(F.col("o_custkey").alias("Id")).alias("Account"),
        F.struct(F.col("o_totalprice").alias("Price")).alias("Sum"),
        "o_orderstatus",
    )
    return reshape.flatten_structs(boxed, ["Account", "Sum"], keys=["Key"])


@query(
    f"""WITH {POSTS_SQL}
        SELECT c_nationkey AS "BlogType", o_orderstatus AS "Kind", count(*) AS rows
        FROM posts WHERE o_orderstatus <> 'F' GROUP BY 1, 2
        UNION ALL
        SELECT c_nationkey, 'extra', count(*) FROM posts WHERE o_orderstatus = 'O' GROUP BY 1
        UNION ALL
        SELECT c_nationkey, NULL, count(*) FROM posts WHERE o_orderstatus = 'F' GROUP BY 1"""
)
def parts_join(spark, sf_dir):
    """Child rows joined to their primary rows, counted by columns of both."""
    parts = split.split_posts(keyed_posts(spark, sf_dir), POST_POLICY, "2001-08-01")
    both = parts[split.PRIMARY].select("Id", "BlogType").join(parts[split.ATTACHMENTS].select("Id", "Kind"), "Id")
    return both.groupBy("BlogType", "Kind").agg(F.count("*").alias("rows"))


@query(
    """SELECT conv_id, turn, CAST(i - 1 AS INTEGER) AS "No", lines[i] AS "Text", CAST(length(lines[i]) AS INTEGER) AS "Length"
       FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS lines FROM conversations),
            LATERAL (SELECT unnest(generate_series(1, len(lines))) AS i)"""
)
def turns_rebuild(spark, sf_dir):
    """The lines of each conversation turn as rebuilt array elements."""
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.transform(
            F.split("text", "\n", -1),
            lambda x, i: F.struct(
                i.alias("No"), x.alias("Text"), F.upper(x).alias("Body"), F.struct(F.length(x).alias("Length")).alias("Stats")
            ),
        ).alias("Lines"),
    )
    slim = turns.select("conv_id", "turn", reshape.rebuild_array(turns, "Lines", ["Body"]))
    return reshape.explode_struct_array(slim, "Lines", keys=["conv_id", "turn"])


@query(
    """SELECT user_id AS "BlogType", 'https://t.me/' || user_id AS "BlogUrl", CAST(ts AS DATE) AS "PartDate",
              CAST(NULL AS BIGINT) AS "Comments", CAST(json_extract(props, '$.k') AS BIGINT) AS "Likes",
              event_id AS "Views", event_type AS "MetricsTimestamp",
              md5('https://t.me/' || user_id) AS "Id", '2024-01-31' AS "ExecDate"
       FROM events"""
)
def metrics_project(spark, sf_dir):
    """Nested metrics messages, without some of the fields, as the merge sees them."""
    events = table(spark, sf_dir, "events")
    url = F.concat(F.lit("https://t.me/"), F.col("user_id").cast("string"))
    messages = events.select(
        F.struct(F.col("user_id").alias("Type"), url.alias("Url")).alias("Blog"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("CreateDate"),
        F.struct(
            F.get_json_object("props", "$.k").cast("bigint").alias("LikeCount"),
            F.col("event_id").alias("ViewCount"),
            F.col("event_type").alias("Timestamp"),
        ).alias("Metrics"),
        url.alias("Url"),
    )
    rows = merge.with_day(reshape.canonical_metrics(jobs.flat_metrics(messages, "2024-01-31")))
    return rows.select(
        "BlogType", "BlogUrl", "PartDate", "Comments", "Likes", "Views", "MetricsTimestamp", "Id", "ExecDate"
    )


# --- newest rows ------------------------------------------------------------

@query(
    """SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
       WHERE r = 1"""
)
def latest_row_per_key(spark, sf_dir):
    newest = latest_per_key(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate"], tiebreak=["o_orderkey"])
    return newest.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    """SELECT event_type, event_id, user_id, day FROM (
         SELECT *, rank() OVER (PARTITION BY event_type ORDER BY day DESC) AS r
         FROM (SELECT *, CAST(ts AS DATE) AS day FROM events))
       WHERE r = 1"""
)
def latest_all_ties(spark, sf_dir):
    """Every event of each type's last day: few keys, each with much of the table."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "user_id", day("ts").alias("day"))
    return latest_per_key(events, ["event_type"], ["day"], ties="all")


# --- offsets ----------------------------------------------------------------

LEDGER_SQL = """SELECT CAST(user_id % 4 AS INTEGER) AS kafkapartition, max(event_id) AS latestoffset, 'Events' AS topic,
                       'readers' AS consumergroup, strftime(ts, '%Y-%m-%d') AS execdate, strftime(ts, '%H-00') AS exectime
                FROM events GROUP BY ALL"""


@query(
    """SELECT CAST(user_id % 4 AS INTEGER) AS kafkapartition, max(event_id) AS latestoffset, 'Events' AS topic,
              'readers' AS consumergroup, '2024-01-31' AS execdate, '10-30' AS exectime
       FROM events GROUP BY 1"""
)
def offset_ledger(spark, sf_dir):
    messages = event_envelope(spark, sf_dir)
    return run_offsets(messages, "Events", "readers", "2024-01-31", "10-30", "partition", "offset")


@query(
    f"""SELECT topic, kafkapartition, latestoffset + 1 AS nextoffset FROM (
          SELECT *, row_number() OVER (PARTITION BY topic, kafkapartition ORDER BY execdate DESC, exectime DESC) AS r
          FROM ({LEDGER_SQL})) WHERE r = 1"""
)
def offset_resume(spark, sf_dir):
    """Resume positions from a ledger with a run for every hour."""
    ledger = table(spark, sf_dir, "events").groupBy(
        F.pmod("user_id", F.lit(4)).cast("int").alias("kafkapartition"),
        F.lit("Events").alias("topic"),
        F.lit("readers").alias("consumergroup"),
        F.date_format("ts", "yyyy-MM-dd").alias("execdate"),
        F.date_format("ts", "HH-00").alias("exectime"),
    ).agg(F.max("event_id").alias("latestoffset"))
    return next_offsets(ledger)


# --- merges -----------------------------------------------------------------

SPLIT_DAY = "2000-01-01"


@query(
    f"""SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority FROM (
          SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r
          FROM orders WHERE o_orderdate >= TIMESTAMP '{SPLIT_DAY}') WHERE r = 1
        UNION ALL
        SELECT o_custkey, o_orderkey, o_totalprice, NULL FROM orders h
        WHERE o_orderdate < TIMESTAMP '{SPLIT_DAY}' AND NOT EXISTS (
          SELECT 1 FROM orders d WHERE d.o_custkey = h.o_custkey AND d.o_orderdate >= TIMESTAMP '{SPLIT_DAY}')"""
)
def snapshot_merge(spark, sf_dir):
    """Newest delta row per account, all history rows of other accounts; history lacks a column."""
    orders = table(spark, sf_dir, "orders")
    delta = orders.where(F.col("o_orderdate") >= F.lit(SPLIT_DAY).cast("timestamp_ntz"))
    history = orders.where(F.col("o_orderdate") < F.lit(SPLIT_DAY).cast("timestamp_ntz")).drop("o_orderpriority")
    merged = merge.snapshot_merge(history, delta, ["o_custkey"], ["o_orderdate"], ["o_orderkey"])
    return merged.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority")


@query(
    f"""WITH ranked AS (
          SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate >= TIMESTAMP '{SPLIT_DAY}'
                                       ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders),
        newest AS (SELECT *, o_orderdate >= TIMESTAMP '{SPLIT_DAY}' AS is_new FROM ranked WHERE r = 1)
        SELECT o_custkey, o_orderkey, o_totalprice FROM newest n
        WHERE is_new OR NOT EXISTS (SELECT 1 FROM newest d WHERE d.is_new AND d.o_custkey = n.o_custkey)"""
)
def clustered_snapshot(spark, sf_dir):
    """A snapshot over an older one, both bucketed by key; only the delta is shuffled."""
    orders = table(spark, sf_dir, "orders")
    base = scratch_path(spark, "snapshots")
    cut = F.lit(SPLIT_DAY).cast("timestamp_ntz")
    first = latest_per_key(orders.where(F.col("o_orderdate") < cut), ["o_custkey"], ["o_orderdate"], tiebreak=["o_orderkey"])
    sinks.write_snapshot(sinks.cluster_by(first, 8, ["o_custkey"]), base, "1999-12-31", keys=["o_custkey"], buckets=8)
    history = tables.latest_snapshot(spark, base, "2000-01-01")
    delta = orders.where(F.col("o_orderdate") >= cut)
    merged = merge.snapshot_merge(history, delta, ["o_custkey"], ["o_orderdate"], ["o_orderkey"], clusters=8, laid_out=True)
    sinks.write_snapshot(merged, base, "2000-01-01", keys=["o_custkey"], buckets=8)
    return tables.latest_snapshot(spark, base, "2000-01-02").select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    f"""WITH ranked AS (
          SELECT *, o_orderdate >= TIMESTAMP '{SPLIT_DAY}' AS is_new,
                 row_number() OVER (PARTITION BY o_custkey, o_orderdate >= TIMESTAMP '{SPLIT_DAY}'
                                    ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders),
        h AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM ranked WHERE r = 1 AND NOT is_new),
        d AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END AS o_totalprice,
                     md5(o_orderpriority) AS parent FROM ranked WHERE r = 1 AND is_new)
        SELECT coalesce(d.o_custkey, h.o_custkey) AS o_custkey, coalesce(d.o_orderkey, h.o_orderkey) AS o_orderkey,
               coalesce(d.o_totalprice, h.o_totalprice) AS o_totalprice, o_orderstatus, parent
        FROM h FULL JOIN d ON h.o_custkey = d.o_custkey"""
)
def upsert_coalesce(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    cut = F.lit(SPLIT_DAY).cast("timestamp_ntz")
    newest = lambda df: latest_per_key(df, ["o_custkey"], ["o_orderdate"], tiebreak=["o_orderkey"])
    history = newest(orders.where(F.col("o_orderdate") < cut)).select(
        "o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus"
    )
    delta = newest(orders.where(F.col("o_orderdate") >= cut)).select(
        "o_custkey",
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "O", F.col("o_totalprice")).alias("o_totalprice"),
        url_key("o_orderpriority").alias("parent"),
    )
    return merge.coalesce_merge(history, delta, ["o_custkey"])


EVENT_POSTS = ("view", "click", "signup")


@query(
    """WITH p AS (SELECT * FROM (
            SELECT user_id, CAST(ts AS DATE) AS day, event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
                   strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS stamp,
                   row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
            FROM events WHERE event_type IN ('view', 'click', 'signup')) WHERE r = 1),
       m AS (SELECT * FROM (
            SELECT user_id, CAST(ts AS DATE) AS day, event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type,
                   strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS stamp,
                   row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS r
            FROM events WHERE event_type NOT IN ('view', 'click', 'signup')) WHERE r = 1),
       j AS (SELECT CAST(coalesce(p.user_id, m.user_id) AS VARCHAR) AS "PostId", coalesce(p.day, m.day) AS "PartdatePmd",
                    p.event_id AS "PostEvent", coalesce(m.k, p.k) AS "LikesCount",
                    coalesce(CASE WHEN m.event_type = 'error' THEN m.event_id END, p.event_id) AS "ViewsCount"
             FROM p FULL JOIN m ON p.user_id = m.user_id AND p.day = m.day)
       SELECT "PostId", "PartdatePmd", "PostEvent", "LikesCount", "ViewsCount" FROM j"""
)
def posts_metrics_full_outer(spark, sf_dir):
    """Users' newest post-like event with the newest metrics-like one of its day; metrics of other days stay as well."""
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    count = F.get_json_object("props", "$.k").cast("bigint")
    is_post = F.col("event_type").isin(*EVENT_POSTS)
    posts = table(spark, sf_dir, "events").where(is_post).select(
        F.col("user_id").cast("string").alias("Id"),
        day("ts").alias("PartDate"),
        F.col("event_id").alias("PostEvent"),
        count.alias("MetricsLikeCount"),
        F.col("event_id").alias("MetricsViewCount"),
        stamp.alias("MetricsTimestamp"),
        F.col("event_id").alias("kafkaoffset"),
    )
    metrics = table(spark, sf_dir, "events").where(~is_post).select(
        F.col("user_id").cast("string").alias("Id"),
        day("ts").alias("PartDate"),
        count.alias("Likes"),
        F.when(F.col("event_type") == "error", F.col("event_id")).alias("Views"),
        stamp.alias("MetricsTimestamp"),
        F.col("event_id").alias("KafkaOffset"),
    )
    joined = merge.join_posts_metrics(posts, metrics, *day_bounds(table(spark, sf_dir, "events"), day("ts")))
    return joined.select("PostId", "PartdatePmd", "PostEvent", "LikesCount", "ViewsCount")


def order_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """This run's post messages: orders still open or in part."""
    orders = table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'")
    partial = F.col("o_orderstatus") == "P"
    return orders.select(
        url_key(order_url()).alias("Id"),
        day("o_orderdate").alias("PartDate"),
        order_url().alias("Url"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("CreateDate"),
        F.concat(F.lit("https://t.me/"), F.col("o_custkey").cast("string")).alias("AuthorUrl"),
        F.when(partial, F.concat(F.lit("https://t.me/p/"), F.col("o_custkey").cast("string"))).alias("ParentUrl"),
        F.col("o_custkey").alias("MetricsCommentCount"),
        F.when(partial, F.col("o_orderkey")).alias("MetricsLikeCount"),
        F.when(partial, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("MetricsTimestamp"),
        F.col("o_orderkey").alias("kafkaoffset"),
    )


def order_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics messages: every line item reports on its order's post."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", url_key(order_url()).alias("Id"), day("o_orderdate").alias("PartDate")
    )
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "Id",
        "PartDate",
        F.col("l_quantity").cast("bigint").alias("Likes"),
        F.when(F.col("l_linestatus") == "F", F.col("l_suppkey")).alias("Comments"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("MetricsTimestamp"),
        (F.col("l_partkey") * 10000 + F.col("l_linenumber") * 100 + F.col("l_quantity").cast("bigint")).alias("KafkaOffset"),
    )


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts merged before: orders finished or in part."""
    return table(spark, sf_dir, "orders").where("o_orderstatus <> 'O'").select(
        url_key(order_url()).alias("PostId"),
        day("o_orderdate").alias("Partdate"),
        order_url().alias("Url"),
        F.lit("1995-01-01").alias("MetricsTimestamp"),
        F.col("o_custkey").alias("MetricsLikesCount"),
        F.lit(1).cast("bigint").alias("CommentsCount"),
        F.lit("before").alias("CreateDate"),
        url_key("o_orderpriority").alias("ParentUrlHash"),
    )


@query(
    f"""WITH o AS (SELECT *, {URL_SQL} AS url, md5({URL_SQL}) AS id, CAST(o_orderdate AS DATE) AS day FROM orders),
        p AS (SELECT * FROM o WHERE o_orderstatus <> 'F'),
        m AS (SELECT * FROM (
            SELECT o.id, o.day, CAST(l_quantity AS BIGINT) AS likes, CASE WHEN l_linestatus = 'F' THEN l_suppkey END AS comments,
                   strftime(l_shipdate, '%Y-%m-%d') AS stamp,
                   row_number() OVER (PARTITION BY o.id, o.day ORDER BY strftime(l_shipdate, '%Y-%m-%d') DESC,
                       l_partkey * 10000 + l_linenumber * 100 + CAST(l_quantity AS BIGINT) DESC) AS r
            FROM lineitem JOIN o ON l_orderkey = o_orderkey) WHERE r = 1),
        d AS (SELECT coalesce(p.id, m.id) AS id, coalesce(p.day, m.day) AS day, p.url, strftime(p.day, '%Y-%m-%d') AS created,
                     'https://t.me/' || p.o_custkey AS author,
                     CASE WHEN p.o_orderstatus = 'P' THEN md5('https://t.me/p/' || p.o_custkey) END AS parent,
                     p.o_custkey AS embedded_comments, coalesce(m.comments, p.o_custkey) AS comments,
                     coalesce(m.likes, CASE WHEN p.o_orderstatus = 'P' THEN p.o_orderkey END) AS likes,
                     greatest(m.stamp, CASE WHEN p.o_orderstatus = 'P' THEN strftime(p.day, '%Y-%m-%d') END) AS stamp
              FROM p FULL JOIN m ON p.id = m.id AND p.day = m.day),
        h AS (SELECT id, day, url, o_custkey AS likes, md5(o_orderpriority) AS parent FROM o WHERE o_orderstatus <> 'O'),
        j AS (SELECT coalesce(d.id, h.id) AS id, coalesce(d.day, h.day) AS day, coalesce(d.url, h.url) AS url,
                     author, coalesce(d.created, CASE WHEN h.id IS NOT NULL THEN 'before' END) AS created,
                     coalesce(d.parent, h.parent) AS parent, coalesce(d.likes, h.likes) AS likes, embedded_comments,
                     coalesce(d.comments, CASE WHEN h.id IS NOT NULL THEN 1 END) AS comments,
                     coalesce(d.stamp, CASE WHEN h.id IS NOT NULL THEN '1995-01-01' END) AS stamp
              FROM h FULL JOIN d ON h.id = d.id AND h.day = d.day)
        SELECT id AS "PostId", day AS "Partdate", url AS "Url", author AS "AuthorUrl", created AS "CreateDate",
               parent AS "ParentUrlHash", likes AS "MetricsLikesCount", embedded_comments AS "MetricsCommentsCount",
               CAST(comments AS BIGINT) AS "CommentsCount", stamp AS "MetricsTimestamp",
               CAST(CASE WHEN contains(url, 'google.com/maps') THEN 21 WHEN contains(url, 'zen.yandex.ru') THEN 23
                    WHEN contains(url, 'yandex.com') THEN 1 WHEN contains(url, 't.me') THEN 17 ELSE 32 END AS INTEGER) AS "SocialnetworkType"
        FROM j"""
)
def posts_merge_daily(spark, sf_dir):
    """Posts with their metrics over the posts merged before, all days in one plan."""
    posts, metrics = order_posts(spark, sf_dir), order_metrics(spark, sf_dir)
    delta = merge.join_posts_metrics(posts, metrics, *day_bounds(table(spark, sf_dir, "orders"), day("o_orderdate")))
    merged = merge.upsert_posts(order_history(spark, sf_dir), delta, history_unique=True)
    return merged.select(
        "PostId",
        "Partdate",
        "Url",
        "AuthorUrl",
        "CreateDate",
        "ParentUrlHash",
        "MetricsLikesCount",
        "MetricsCommentsCount",
        "CommentsCount",
        "MetricsTimestamp",
        "SocialnetworkType",
    )


@query(
    """WITH c AS (SELECT *, CAST(date_trunc('month', l_shipdate) AS DATE) AS month FROM lineitem),
       posts AS (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
       newest AS (SELECT * FROM (
            SELECT *, rank() OVER (PARTITION BY l_orderkey, month ORDER BY l_shipdate DESC) AS r
            FROM c WHERE l_returnflag <> 'N') WHERE r = 1),
       fresh AS (SELECT n.* EXCLUDE (r) FROM newest n SEMI JOIN posts p ON n.l_orderkey = p.o_orderkey AND n.month = p.month),
       kept AS (SELECT * FROM c WHERE l_returnflag = 'N' AND NOT EXISTS (
            SELECT 1 FROM fresh f WHERE f.l_orderkey = c.l_orderkey AND f.month = c.month))
       SELECT CAST(l_orderkey AS VARCHAR) AS "PostId", month AS "Partdate", l_linenumber, l_suppkey, l_returnflag
       FROM (SELECT * FROM fresh UNION ALL SELECT * FROM kept)"""
)
def child_merge(spark, sf_dir):
    """Line items as child rows of orders, by month: the newest version of each replaces the older rows."""
    month = lambda c: F.to_date(F.date_trunc("month", F.to_date(c)))
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("Id"),
        month("l_shipdate").alias("PartDate"),
        F.to_date("l_shipdate").alias("PostCreateDate"),
        "l_linenumber",
        "l_suppkey",
        "l_returnflag",
    )
    posts = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("PostId"), month("o_orderdate").alias("Partdate")
    )
    delta = lines.where("l_returnflag <> 'N'")
    history = lines.where("l_returnflag = 'N'").withColumnsRenamed({"Id": "PostId", "PartDate": "Partdate"})
    merged = merge.merge_children(history, delta, posts, *day_bounds(lines, F.col("PartDate")), order=["PostCreateDate"])
    return merged.select("PostId", "Partdate", "l_linenumber", "l_suppkey", "l_returnflag")


# --- tables on storage ------------------------------------------------------

NEWEST_EVENTS_SQL = """SELECT user_id, day, event_id, event_type, label FROM (
    SELECT user_id, CAST(ts AS DATE) AS day, event_id, event_type, 'x' || (event_id % 7) AS label,
           row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id DESC) AS r
    FROM events WHERE {where}) WHERE r = 1"""

UPSERT_SQL = f"""WITH h AS ({NEWEST_EVENTS_SQL.format(where="event_type IN ('view', 'click', 'signup')")}),
     d AS ({NEWEST_EVENTS_SQL.format(where="event_type NOT IN ('view', 'click', 'signup')")})
     SELECT coalesce(d.user_id, h.user_id) AS user_id, coalesce(d.day, h.day) AS day,
            coalesce(d.event_id, h.event_id) AS event_id, coalesce(d.event_type, h.event_type) AS event_type,
            h.label AS label
     FROM h FULL JOIN d ON h.user_id = d.user_id AND h.day = d.day"""


def _event_versions(df: DataFrame) -> DataFrame:
    label = F.concat(F.lit("x"), (F.col("event_id") % 7).cast("string"))
    return df.select(
        "user_id",
        day("ts").alias("day"),
        "event_id",
        "event_type",
        F.when(F.col("event_type").isin(*EVENT_POSTS), label).alias("label"),
    )


@query(UPSERT_SQL)
def partition_upsert_roundtrip(spark, sf_dir):
    """Two deltas folded into a table partitioned by day; the second repeated, as after a failure."""
    path = scratch_path(spark, "upsert")
    events = _event_versions(table(spark, sf_dir, "events"))
    is_post = F.col("event_type").isin(*EVENT_POSTS)
    for delta in (events.where(is_post), events.where(~is_post), events.where(~is_post)):
        feeds.upsert_partitions(delta, path, "day", ["user_id"], ["event_id"])
    return spark.read.parquet(path).select("user_id", "day", "event_id", "event_type", "label")


# run -> events it takes; the second run's label is text, those of the others are numbers
DRIFT_RUNS = (
    "event_type = 'view'",
    "event_type IN ('click', 'signup') AND day(ts) % 2 = 0",
    "event_type NOT IN ('view', 'click', 'signup') OR (event_type <> 'view' AND day(ts) % 2 = 1)",
)


@query(
    f"""WITH runs AS (SELECT *, CASE WHEN {DRIFT_RUNS[0]} THEN 1 WHEN {DRIFT_RUNS[1]} THEN 2 ELSE 3 END AS run FROM events)
       SELECT user_id, day, event_id, label FROM (
         SELECT user_id, CAST(ts AS DATE) AS day, event_id, CASE run WHEN 2 THEN 'x' ELSE '' END || event_id AS label,
                row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY run DESC, event_id DESC) AS r
         FROM runs) WHERE r = 1"""
)
def type_drift_upsert(spark, sf_dir):
    """Three runs upserted into a dated table, where a field is a number, on even days text, then a number again."""
    path = scratch_path(spark, "drift")
    rows = table(spark, sf_dir, "events").withColumn("day", day("ts"))
    for n, some in enumerate(DRIFT_RUNS):
        label = F.concat(F.lit("x"), F.col("event_id").cast("string")) if n == 1 else F.col("event_id")
        run = rows.where(some).select("user_id", "day", "event_id", label.alias("label"))
        feeds.upsert_partitions(run, path, "day", ["user_id"], ["event_id"])
    days = [r["day"] for r in rows.select("day").distinct().collect()]
    return tables.read_partitions(spark, path, "day", days).select("user_id", "day", "event_id", "label")


@query(
    """SELECT event_id, CAST(user_id AS VARCHAR) AS who, event_type AS kind FROM events WHERE event_type IN ('view', 'click')
       UNION ALL
       SELECT event_id, 'u' || user_id, NULL FROM events WHERE event_type NOT IN ('view', 'click')"""
)
def delta_roundtrip(spark, sf_dir):
    """Two runs of a day with clashing types, the first one written twice, read as one delta."""
    base = scratch_path(spark, "delta")
    events = table(spark, sf_dir, "events")
    early = F.col("event_type").isin("view", "click")
    first = events.where(early).select("event_id", F.col("user_id").alias("who"), F.col("event_type").alias("kind"))
    second = events.where(~early).select(
        "event_id", F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("who")
    )
    sinks.write_delta(first, base, "2024-01-31", "01-00")
    sinks.write_delta(first, base, "2024-01-31", "01-00")
    sinks.write_delta(second, base, "2024-01-31", "02-00")
    return tables.read_delta(spark, base, "2024-01-31").select("event_id", "who", "kind")


@query(
    """SELECT event_id, CAST(ts AS DATE) AS day, event_type FROM events
       WHERE CAST(ts AS DATE) IN (DATE '2024-01-02', DATE '2024-01-09', DATE '2024-01-30')"""
)
def partition_scan(spark, sf_dir):
    """Named days of a table partitioned by day; a day it does not have is no error."""
    path = scratch_path(spark, "days")
    events = table(spark, sf_dir, "events").select("event_id", day("ts").alias("day"), "event_type")
    sinks.replace_partitions(events, path, ["day"])
    wanted = [date(2024, 1, 2), date(2024, 1, 9), date(2024, 1, 30), date(2024, 2, 1)]
    return tables.read_partitions(spark, path, "day", wanted).select("event_id", "day", "event_type")


@query(
    """WITH runs AS (SELECT CAST(user_id % 4 AS INTEGER) AS kafkapartition, max(event_id) AS o,
                            event_type IN ('view', 'click') OR user_id % 4 = 3 AS early
                     FROM events GROUP BY ALL)
       SELECT 'Events' AS topic, kafkapartition, coalesce(max(CASE WHEN NOT early THEN o END), max(o)) + 1 AS nextoffset
       FROM runs GROUP BY ALL"""
)
def ledger_roundtrip(spark, sf_dir):
    """Two runs in the ledger on storage, the second written twice; where each partition goes on.

    The last partition is idle in the second run.
    """
    path = scratch_path(spark, "ledger")
    messages = table(spark, sf_dir, "events").select(
        F.pmod("user_id", F.lit(4)).cast("int").alias("kafkapartition"), F.col("event_id").alias("kafkaoffset"), "event_type"
    )
    early = F.col("event_type").isin("view", "click") | (F.col("kafkapartition") == 3)
    sinks.append_ledger(run_offsets(messages.where(early), "Events", "g", "2024-01-30", "23-00"), path)
    for _ in range(2):
        sinks.append_ledger(run_offsets(messages.where(~early), "Events", "g", "2024-01-31", "01-00"), path)
    return next_offsets(sinks.read_ledger(spark, path))


def _upsert_in_two(spark: SparkSession, sf_dir: str, some: Column) -> tuple[str, list[touched.FileReport]]:
    """Post-like events in files of several slots a day, then the others' first and last in two deltas."""
    path = scratch_path(spark, "touched")
    events = _event_versions(table(spark, sf_dir, "events"))
    is_post = F.col("event_type").isin(*EVENT_POSTS)
    reports = []
    for delta in (events.where(is_post), events.where(~is_post & some), events.where(~is_post & ~some)):
        reports.append(touched.upsert_touched(delta, path, "day", ["user_id"], ["event_id"], spread=4, small_bytes=0))
    return path, reports


@query(UPSERT_SQL)
def touched_upsert(spark, sf_dir):
    """Deltas folded into a dated table by rewriting only the files that hold their keys."""
    path, _ = _upsert_in_two(spark, sf_dir, F.col("user_id") % 2 == 0)
    return spark.read.parquet(path).select("user_id", "day", "event_id", "event_type", "label")


@query(
    """SELECT CAST(event_id AS VARCHAR) AS message, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
              CASE WHEN event_id % 5 = 2 THEN 'u' || event_id END AS name, false AS unreadable
       FROM events WHERE event_id % 5 < 3
       UNION ALL
       SELECT CASE WHEN event_id % 5 = 3 THEN '{"Id":' || event_id || ',"Id":0}' ELSE 'no json ' || event_id END, NULL, NULL, true
       FROM events WHERE event_id % 5 >= 3"""
)
def folded_messages(spark, sf_dir):
    """Messages whose names differ in case are one field; repeated keys and other unreadable text are set aside whole."""
    k, key = F.get_json_object("props", "$.k").cast("bigint"), F.col("event_id") % 5
    word = F.concat(F.lit("u"), F.col("event_id").cast("string"))
    text = (
        F.when(key == 0, F.to_json(F.struct(F.col("event_id").alias("Id"), F.struct(k.alias("K")).alias("Props"))))
        .when(key == 1, F.to_json(F.struct(F.col("event_id").alias("id"), F.struct(k.alias("k")).alias("props"))))
        .when(key == 2, F.to_json(F.struct(F.col("event_id").alias("ID"), F.struct(k.alias("K")).alias("props"), F.struct(word.alias("name")).alias("Props"))))
        .when(key == 3, F.concat(F.lit('{"Id":'), "event_id", F.lit(',"Id":0}')))
        .otherwise(F.concat(F.lit("no json "), "event_id"))
    )
    messages = table(spark, sf_dir, "events").select(text.alias("value"))
    parsed = schema.parse_json_rows(messages, schema.infer_json_schema(messages))
    bad = F.col(f"_json.{schema.UNPARSED}").isNotNull()
    field = lambda name: F.when(~bad, F.col(f"_json.{name}"))
    return parsed.select(
        F.when(bad, F.col("value")).otherwise(F.col("_json.Id").cast("string")).alias("message"),
        field("Props.K").alias("k"),
        field("Props.name").alias("name"),
        bad.alias("unreadable"),
    )


@query(
    """SELECT event_id, CAST(CASE WHEN event_id % 3 <> 1 THEN user_id END AS BIGINT) AS likes,
              CASE WHEN event_id % 3 = 1 THEN user_id || 'k' END AS rescued,
              CASE WHEN event_id % 3 = 1 THEN 'unfit' END AS reason
       FROM events"""
)
def rescued_values(spark, sf_dir):
    """Metrics whose count is no number: null in the delta, kept beside it and among the dead letters."""
    place = _scratch_tables(spark)
    count = F.col("user_id").cast("string")
    odd = F.col("event_id") % 3 == 1
    likes = F.struct(F.when(odd, F.concat(count, F.lit("k"))).otherwise(count).alias("LikeCount"))
    records = table(spark, sf_dir, "events").select(F.concat(F.lit("u"), F.col("event_id").cast("string")).alias("Url"), likes.alias("Metrics"), "event_id")
    message = F.to_json(F.struct("Url", "Metrics")).alias("value")
    envelope = records.select(message, F.lit(0).alias("partition"), F.col("event_id").alias("offset"))
    jobs.ingest_metrics(envelope, jobs.Run("2024-01-01", "01-00", "Metrics", "g"), place("delta"), dead_letters=place("dead"))
    letters = tables.read_delta(spark, place("dead"), "2024-01-01").select(F.col("kafkaoffset").alias("_at"), "reason")
    delta = tables.read_delta(spark, place("delta"), "2024-01-01")
    met = delta.join(letters, F.col("kafkaoffset") == F.col("_at"), "left")
    return met.select(F.col("kafkaoffset").alias("event_id"), "likes", F.col(schema.RESCUED)["likes"].alias("rescued"), "reason")


@query(
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN CAST(9007199254740993 + event_id AS VARCHAR) WHEN 1 THEN (event_id * 4 + 1) || '.25' ELSE CAST(event_id AS VARCHAR) END AS amount
       FROM events"""
)
def exact_union(spark, sf_dir):
    """Runs of a day whose field is a large whole number, a fraction and a small number: no digit is lost."""
    base = scratch_path(spark, "exact")
    events = table(spark, sf_dir, "events")
    amounts = (F.lit(2**53 + 1) + F.col("event_id"), (F.col("event_id") * 4 + 1).cast("double") + 0.25, F.col("event_id").cast("int"))
    for n, amount in enumerate(amounts):
        run = events.where(F.col("event_id") % 3 == n).select("event_id", amount.alias("amount"))
        sinks.write_delta(run, base, "2024-01-01", f"0{n}-00")
    return tables.read_delta(spark, base, "2024-01-01").select("event_id", "amount")


# --- streams ----------------------------------------------------------------

def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    # as a pattern, since the table may be one file or a folder of them
    return kafka.file_feed(spark, f"{sf_dir}/events.parquet*", events.schema)


@query("SELECT event_id, user_id, CAST(ts AS DATE) AS day, event_type FROM events")
def stream_drain(spark, sf_dir):
    """Everything new in a feed, drained into files; a second drain finds nothing."""
    path, checkpoint = scratch_path(spark, "drained"), scratch_path(spark, "checkpoint")
    for _ in range(2):
        stream = _event_stream(spark, sf_dir).select("event_id", "user_id", day("ts").alias("day"), "event_type")
        feeds.drain_to_files(stream, path, checkpoint)
    return spark.read.parquet(path)


@query(UPSERT_SQL)
def stream_upsert(spark, sf_dir):
    """Two feeds drained one after the other into a table partitioned by day."""
    path = scratch_path(spark, "upserted")
    for posts in (True, False):
        is_post = F.col("event_type").isin(*EVENT_POSTS)
        handler = feeds.upsert_handler(path, "day", ["user_id"], ["event_id"], transform=_event_versions)
        stream = _event_stream(spark, sf_dir).where(is_post if posts else ~is_post)
        feeds.drain(stream, handler, scratch_path(spark, "checkpoint"))
    return spark.read.parquet(path).select("user_id", "day", "event_id", "event_type", "label")


@query("SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, event_type FROM events")
def stream_dedup(spark, sf_dir):
    """First message per user, day and type within the lateness horizon."""
    path = scratch_path(spark, "deduped")
    stream = _event_stream(spark, sf_dir).select("user_id", day("ts").alias("day"), "event_type", "ts")
    unique = feeds.dedupe_stream(stream, ["user_id", "day", "event_type"], "ts", "60 days")
    feeds.drain_to_files(unique.select("user_id", "day", "event_type"), path, scratch_path(spark, "checkpoint"))
    return spark.read.parquet(path)


@query(
    """SELECT 'https://vk.com/' || user_id AS metricsurl, md5('https://vk.com/' || user_id) AS id,
              CAST(json_extract(props, '$.k') AS BIGINT) AS likes, CAST(user_id % 4 AS INTEGER) AS kafkapartition,
              event_id AS kafkaoffset, strftime(ts, '%Y-%m-%d') AS partdate
       FROM events"""
)
def stream_ingest(spark, sf_dir):
    """A drained feed of metrics messages through the ingest job, batch by batch."""
    place = _scratch_tables(spark)
    url = F.concat(F.lit("https://vk.com/"), F.col("user_id").cast("string"))
    message = F.struct(
        url.alias("Url"),
        F.date_format("ts", "yyyy-MM-dd").alias("CreateDate"),
        F.struct(F.get_json_object("props", "$.k").cast("bigint").alias("LikeCount")).alias("Metrics"),
    )
    envelope = _event_stream(spark, sf_dir).select(
        F.to_json(message).alias("value"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )
    ingest = lambda batch, run: jobs.ingest_metrics(batch, run, place("delta"), place("ledger"), place("dead"))
    feeds.drain(envelope, jobs.ingest_handler(ingest, "2024-01-31", "Metrics", "g", place("checkpoint")), place("checkpoint"))
    return tables.read_delta(spark, place("delta"), "2024-01-31").select(
        "metricsurl", "id", "likes", "kafkapartition", "kafkaoffset", "partdate"
    )


# --- jobs -------------------------------------------------------------------

def _envelope(records: DataFrame, offset: Column) -> DataFrame:
    """Records as JSON messages of a feed with four partitions."""
    value = F.to_json(F.struct(*(schema.quoted(c) for c in records.columns))).alias("value")
    return records.select(value, F.pmod(F.xxhash64(offset), F.lit(4)).cast("int").alias("partition"), offset.alias("offset"))


def _scratch_tables(spark: SparkSession) -> Callable[[str], str]:
    root = scratch_path(spark, "job")
    return lambda name: f"{root}/{name}"


@query(
    """SELECT c_custkey AS "Key", c_name AS "Name", 'https://vk.com/' || c_custkey AS "Url",
              CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS "Balance", c_nationkey AS "Nation",
              CASE WHEN c_acctbal >= 0 THEN '20240102' ELSE '20240101' END AS "MergeDate"
       FROM customer"""
)
def blog_jobs(spark, sf_dir):
    """Accounts ingested on two days, the second with a new field for some, merged to a snapshot each day."""
    place = _scratch_tables(spark)
    policy = split.FieldPolicy.parse('{"_TRACE_ID": []}')
    accounts = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Key"),
        F.col("c_name").alias("Name"),
        F.concat(F.lit("https://vk.com/"), F.col("c_custkey").cast("string")).alias("Url"),
        url_key(F.concat(F.lit("https://vk.com/"), F.col("c_custkey").cast("string"))).alias("UrlHash"),
        F.struct(F.col("c_nationkey").alias("Nation")).alias("Place"),
        F.lit("t").alias("_TRACE_ID"),
        F.col("c_acctbal").alias("Balance"),
    )
    feeds_by_day = {"2024-01-01": accounts.drop("Balance"), "2024-01-02": accounts.where("Balance >= 0")}
    for exec_date, records in feeds_by_day.items():
        run = jobs.Run(exec_date, "01-00", "Blogs", "g")
        jobs.ingest_blogs(_envelope(records, F.col("Key")), run, policy, place("delta"), place("ledger"), place("dead"))
        jobs.merge_blogs(spark, exec_date, place("delta"), place("snapshots"), clusters=8)
    snapshot = tables.latest_snapshot(spark, place("snapshots"), "2024-01-03")
    return snapshot.select(
        "Key", "Name", "Url", "Balance", F.col("Place.Nation").cast("int").alias("Nation"), "MergeDate"
    )


JOB_POLICY = split.FieldPolicy(
    excludes={"Attachments": ["Name", "Ocr.Boxes"], "Body": [], "GeoData": [], "ModificationInfo": []},
    primary=("Author.Key", "Blog.Type", "CreateDate", "Metrics.LikeCount", "Url", "CurrentTimestamp"),
)


def _month_start(column: str) -> Column:
    """First day of the month as text: the days the job queries' posts are made on."""
    return F.date_format(F.date_trunc("month", F.to_date(column)), "yyyy-MM-dd")


def run_post_jobs(spark: SparkSession, sf_dir: str, children: tuple[str, ...] = ()) -> Callable[[str], str]:
    """Posts and metrics of two days through ingest and merges; returns where the tables lie.

    The first day brings the posts of orders in part or finished, the second
    those in part or open, and on both every line item is a metrics message.
    """
    place = _scratch_tables(spark)
    records = post_records(spark, sf_dir).withColumn("CreateDate", _month_start("CreateDate"))
    order_posts_of = {"2001-08-01": "Body <> 'O'", "2001-08-02": "Body <> 'F'"}
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", order_url().alias("Url")),
        F.col("l_orderkey") == F.col("o_orderkey"),
    )
    stamp = F.date_format("l_shipdate", "yyyy-MM-dd")
    offset = F.col("l_partkey") * 10000 + F.col("l_linenumber") * 100 + F.col("l_quantity").cast("bigint")
    metric_records = {
        "2001-08-01": lines.where("l_linestatus = 'F'"),
        "2001-08-02": lines.where("l_linestatus <> 'F'"),
    }
    for exec_date, some in order_posts_of.items():
        posts = _envelope(records.where(some), F.col("Metrics.LikeCount"))
        run = jobs.Run(exec_date, "01-00", "Posts", "g")
        jobs.ingest_posts(posts, run, JOB_POLICY, lambda part: place(f"delta/{part}"), place("ledger/posts"), place("dead/posts"))
        metrics = metric_records[exec_date].select(
            "Url",
            _month_start("o_orderdate").alias("CreateDate"),
            F.struct(
                F.col("l_quantity").cast("bigint").alias("LikeCount"),
                F.col("l_suppkey").alias("CommentCount"),
                stamp.alias("Timestamp"),
            ).alias("Metrics"),
            offset.alias("offset"),
        )
        message = F.to_json(F.struct("Url", "CreateDate", "Metrics")).alias("value")
        envelope = metrics.select(message, F.lit(0).alias("partition"), "offset")
        run = jobs.Run(exec_date, "01-30", "Metrics", "g")
        jobs.ingest_metrics(envelope, run, place("delta/Metrics"), place("ledger/metrics"), place("dead/metrics"))
        jobs.merge_posts(spark, exec_date, "1995-01-01", place("delta/Posts"), place("delta/Metrics"), place("Posts"))
        for part in children:
            jobs.merge_child_table(spark, exec_date, "1995-01-01", place(f"delta/{part}"), place("Posts"), place(part))
    return place


@query(
    f"""WITH o AS (SELECT *, {URL_SQL} AS url, CAST(date_trunc('month', o_orderdate) AS DATE) AS day FROM orders),
        m AS (SELECT *, l_linestatus = 'F' AS early,
                row_number() OVER (PARTITION BY l_orderkey, l_linestatus = 'F' ORDER BY strftime(l_shipdate, '%Y-%m-%d') DESC,
                    l_partkey * 10000 + l_linenumber * 100 + CAST(l_quantity AS BIGINT) DESC) AS r FROM lineitem),
        e AS (SELECT * FROM m WHERE r = 1 AND early), l AS (SELECT * FROM m WHERE r = 1 AND NOT early)
        SELECT md5(url) AS "PostId", day AS partdate,
               url AS "Url",
               coalesce(CAST(l.l_quantity AS BIGINT), CASE WHEN o_orderstatus <> 'F' THEN o_orderkey END,
                        CAST(e.l_quantity AS BIGINT), CASE WHEN o_orderstatus <> 'O' THEN o_orderkey END) AS "MetricsLikesCount",
               coalesce(l.l_suppkey, e.l_suppkey) AS "CommentsCount",
               coalesce(strftime(l.l_shipdate, '%Y-%m-%d'), strftime(e.l_shipdate, '%Y-%m-%d')) AS "MetricsTimestamp",
               CAST(CASE WHEN contains(url, 'google.com/maps') THEN 21 WHEN contains(url, 'zen.yandex.ru') THEN 23
                    WHEN contains(url, 'yandex.com') THEN 1 WHEN contains(url, 't.me') THEN 17 ELSE 32 END AS INTEGER) AS "SocialnetworkType"
        FROM o LEFT JOIN e ON e.l_orderkey = o_orderkey LEFT JOIN l ON l.l_orderkey = o_orderkey"""
)
def post_jobs(spark, sf_dir):
    """The merged posts table after two days."""
    place = run_post_jobs(spark, sf_dir)
    return spark.read.parquet(place("Posts")).select(
        "PostId", "partdate", "Url", "MetricsLikesCount", "CommentsCount", "MetricsTimestamp", "SocialnetworkType"
    )


@query(
    f"""WITH o AS (SELECT *, {URL_SQL} AS url, CAST(date_trunc('month', o_orderdate) AS DATE) AS day FROM orders
                   LEFT JOIN customer ON o_custkey = c_custkey)
        SELECT md5(url) AS "PostId", day AS partdate, o_orderstatus AS "Kind", c_name AS "OcrBody" FROM o WHERE o_orderstatus <> 'F'
        UNION ALL
        SELECT md5(url), day, 'extra', NULL FROM o WHERE o_orderstatus = 'O'
        UNION ALL
        SELECT md5(url), day, NULL, NULL FROM o WHERE o_orderstatus = 'F'"""
)
def child_jobs(spark, sf_dir):
    """The merged attachments table after two days."""
    place = run_post_jobs(spark, sf_dir, (split.ATTACHMENTS,))
    return spark.read.parquet(place(split.ATTACHMENTS)).select(
        "PostId", "partdate", "Kind", F.col("Ocr.Body").alias("OcrBody")
    )


CHILDREN_OF_INTEREST = (split.OTHER, split.GEO, split.MODIFICATION)


@query(
    f"""WITH o AS (SELECT *, {URL_SQL} AS url, CAST(date_trunc('month', o_orderdate) AS DATE) AS day FROM orders
                   LEFT JOIN customer ON o_custkey = c_custkey)
        SELECT '{split.OTHER}' AS part, md5(url) AS "PostId", day AS partdate, c_name AS held FROM o
        UNION ALL
        SELECT '{split.GEO}', md5(url), day, c_mktsegment FROM o WHERE o_orderstatus <> 'F'
        UNION ALL
        SELECT '{split.GEO}', md5(url), day, NULL FROM o WHERE o_orderstatus = 'F'
        UNION ALL
        SELECT '{split.MODIFICATION}', md5(url), day, CAST(o_orderkey AS VARCHAR) FROM o"""
)
def child_tables(spark, sf_dir):
    """The three other merged child tables after two days."""
    place = run_post_jobs(spark, sf_dir, CHILDREN_OF_INTEREST)
    held = {split.OTHER: "AuthorName", split.GEO: "Caption", split.MODIFICATION: "Status"}
    frames = [
        spark.read.parquet(place(part)).select(
            F.lit(part).alias("part"), "PostId", "partdate", F.col(held[part]).cast("string").alias("held")
        )
        for part in CHILDREN_OF_INTEREST
    ]
    return frames[0].union(frames[1]).union(frames[2])


def _order_deltas(spark: SparkSession, sf_dir: str, place: Callable[[str], str], exec_date: str, some: str, day_of: Column) -> None:
    """Orders as a posts delta, written as ingest would."""
    posts = table(spark, sf_dir, "orders").where(some).select(
        url_key(order_url()).alias("Id"),
        F.to_date(day_of).alias("PartDate"),
        order_url().alias("Url"),
        F.col("o_orderkey").alias("MetricsLikeCount"),
        F.lit(exec_date).alias("CreateDate"),
        F.col("o_orderkey").alias("kafkaoffset"),
    )
    sinks.write_delta(posts, place("delta/Posts"), exec_date, "01-00")


LEFT_SQL = """SELECT md5({url}) AS "PostId", CASE WHEN o_orderstatus = 'P' THEN 'undated' WHEN m < DATE '1995-01-01' THEN 'late'
               WHEN m > DATE '1997-12-01' THEN 'early' ELSE 'merged' END AS state
        FROM (SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders)"""


@query(LEFT_SQL.format(url=URL_SQL))
def left_out_rows(spark, sf_dir):
    """Every post is merged or kept with a reason; a second, wider window admits what the first left out."""
    place = _scratch_tables(spark)
    month = F.when(F.col("o_orderstatus") != "P", F.date_trunc("month", "o_orderdate"))
    _order_deltas(spark, sf_dir, place, "1996-06-01", "true", month)
    upkeep = jobs.Upkeep(left_out=place("left"))
    for lower, upper in (("1996-01-01", "1996-06-01"), ("1995-01-01", "1997-12-01")):
        jobs.merge_posts(spark, upper, lower, place("delta/Posts"), place("delta/Metrics"), place("Posts"), upkeep=upkeep)
    merged = spark.read.parquet(place("Posts")).select("PostId", F.lit("merged").alias("state"))
    kept = leftout.read_left_out(spark, place("left/posts")).select(F.col("Id").alias("PostId"), F.col(leftout.REASON).alias("state"))
    return merged.unionByName(kept)


@query(
    """SELECT event_type, count(*) AS messages, event_type IN ('view', 'click') AS removed FROM events GROUP BY event_type"""
)
def consumed_runs(spark, sf_dir):
    """Runs of a delta, one per event type: those that both of its readers have folded in go, the others stay."""
    place = _scratch_tables(spark)
    events, base = table(spark, sf_dir, "events").select("event_id", "event_type"), place("delta")
    kinds = sorted(r[0] for r in events.select("event_type").distinct().collect())
    for kind in kinds:
        sinks.write_delta(events.where(F.col("event_type") == kind), base, "2024-01-01", kind)
    sizes = tables.read_delta(spark, base, "2024-01-01").groupBy(F.col("exec_time").alias("event_type")).agg(F.count("*").alias("messages"))
    sizes = sinks.stage(sizes, place("sizes"))
    runs = tables.delta_runs(spark, base, "2024-01-01")
    of = lambda *names: [r for r in runs if r.rpartition("=")[2] in names]
    retention.note_consumed(spark, place("ledger"), "totals", retention.contents(spark, of("view", "click", "error")))
    retention.note_consumed(spark, place("ledger"), "posts", retention.contents(spark, of("view", "click", "signup")))
    for _ in range(2):
        retention.remove_consumed(spark, place("ledger"), base, ["totals", "posts"])
    left = tables.read_delta(spark, base, "2024-01-01").select(F.col("exec_time").alias("event_type")).distinct()
    return sizes.join(left.withColumn("_left", F.lit(True)), "event_type", "left").select(
        "event_type", "messages", F.col("_left").isNull().alias("removed")
    )


@query(
    f"""SELECT md5({URL_SQL}) AS "PostId", CAST(date_trunc('month', o_orderdate) AS DATE) + CASE WHEN o_orderstatus = 'P' THEN 14 ELSE 0 END AS partdate,
               CASE WHEN o_orderstatus = 'P' THEN '2002-01-02' ELSE '2002-01-01' END AS "CreateDate"
        FROM orders"""
)
def moved_posts(spark, sf_dir):
    """Posts whose newest message has another day leave the old one; each post has one row."""
    place = _scratch_tables(spark)
    month = F.to_date(F.date_trunc("month", "o_orderdate"))
    _order_deltas(spark, sf_dir, place, "2002-01-01", "true", month)
    _order_deltas(spark, sf_dir, place, "2002-01-02", "o_orderstatus = 'P'", F.date_add(month, 14))
    for exec_date in ("2002-01-01", "2002-01-02"):
        jobs.merge_posts(spark, exec_date, "1990-01-01", place("delta/Posts"), place("delta/Metrics"), place("Posts"))
    return spark.read.parquet(place("Posts")).select("PostId", "partdate", "CreateDate")


@query(f"""SELECT md5({URL_SQL}) AS "PostId", CAST(date_trunc('month', o_orderdate) AS DATE) AS partdate, o_orderkey AS likes FROM orders""")
def batched_merge(spark, sf_dir):
    """Posts merged in batches of days, first by a number of days, then by the size of what is there."""
    place = _scratch_tables(spark)
    month = F.date_trunc("month", "o_orderdate")
    _order_deltas(spark, sf_dir, place, "2001-08-01", "o_orderstatus <> 'F'", month)
    _order_deltas(spark, sf_dir, place, "2001-08-02", "o_orderstatus <> 'O'", month)
    for exec_date, bounds in (("2001-08-01", {"max_days": 40}), ("2001-08-02", {"max_bytes": 400_000})):
        jobs.merge_posts(spark, exec_date, "1990-01-01", place("delta/Posts"), place("delta/Metrics"), place("Posts"), **bounds)
    return spark.read.parquet(place("Posts")).select("PostId", "partdate", F.col("MetricsLikesCount").alias("likes"))


@query(
    f"""WITH h AS (SELECT md5('c' || o_custkey) AS id, CAST(date_trunc('year', o_orderdate) AS DATE) AS day, o_orderkey,
                          row_number() OVER (PARTITION BY o_custkey, date_trunc('year', o_orderdate)
                              ORDER BY CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END DESC NULLS LAST, o_orderkey DESC) AS r
                   FROM orders)
        SELECT id AS "PostId", day AS partdate, o_orderkey AS likes FROM h WHERE r = 1"""
)
def repeated_history(spark, sf_dir):
    """A posts table filled from elsewhere repeats posts on a day; a merge leaves the newest row, null times last."""
    place = _scratch_tables(spark)
    stamp = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd"))
    old = table(spark, sf_dir, "orders").select(
        url_key(F.concat(F.lit("c"), F.col("o_custkey").cast("string"))).alias("PostId"),
        F.to_date(F.date_trunc("year", "o_orderdate")).alias("partdate"),
        stamp.alias("MetricsTimestamp"),
        F.timestamp_seconds("o_orderkey").alias("CurrentTimestamp"),
        F.col("o_orderkey").alias("MetricsLikesCount"),
    )
    sinks.replace_partitions(old, place("Posts"), ["partdate"])
    days = [r[0] for r in old.select("partdate").distinct().collect()]
    touch = spark.createDataFrame([("none", d, "touch") for d in days], "Id string, PartDate date, Url string")
    sinks.write_delta(touch, place("delta/Posts"), "2001-08-01", "01-00")
    jobs.merge_posts(spark, "2001-08-01", "1990-01-01", place("delta/Posts"), place("delta/Metrics"), place("Posts"), history_unique=False)
    return spark.read.parquet(place("Posts")).where("PostId <> 'none'").select("PostId", "partdate", F.col("MetricsLikesCount").alias("likes"))


# --- formats, positions, streams of state -----------------------------------

@query(
    """SELECT 'orc' AS format, event_id, event_type, value FROM events
       UNION ALL SELECT 'json', event_id, event_type, value FROM events
       UNION ALL SELECT 'csv', event_id, event_type, value FROM events"""
)
def formats_scan(spark, sf_dir):
    """A table written and read in several formats."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    found = []
    for fmt in ("orc", "json", "csv"):
        path = scratch_path(spark, fmt)
        events.write.format(fmt).save(path)
        # text formats carry no types of their own
        read = tables.read_table(spark, path, fmt) if fmt != "csv" else tables.read_table(spark, path, fmt).toDF(*events.columns)
        found.append(schema.align_to(read, events.schema).select(F.lit(fmt).alias("format"), "*"))
    return found[0].union(found[1]).union(found[2])


@query(
    """SELECT 'Events' AS topic, p AS partition, coalesce(o, -2) AS position
       FROM range(6) r(p) LEFT JOIN (SELECT user_id % 4 AS k, max(event_id) + 1 AS o FROM events GROUP BY ALL) ON k = p"""
)
def offset_positions(spark, sf_dir):
    """The start positions that a ledger gives a feed of six partitions, of which two were never read."""
    messages = table(spark, sf_dir, "events").select(
        F.pmod("user_id", F.lit(4)).cast("int").alias("kafkapartition"), F.col("event_id").alias("kafkaoffset")
    )
    ledger = run_offsets(messages, "Events", "g", "2024-01-30", "23-00")
    latest = {r["kafkapartition"]: r["nextoffset"] for r in next_offsets(ledger).collect()}  # one per partition of the feed
    text = starting_offsets(latest, "Events", range(6))
    positions = F.from_json(F.lit(text), "map<string,map<string,bigint>>")
    one = spark.range(1).select(F.explode(positions).alias("topic", "each"))
    return one.select("topic", F.explode("each").alias("_p", "position")).select("topic", F.col("_p").cast("bigint").alias("partition"), "position")


@query(
    """SELECT user_id, CAST(ts AS DATE) AS day, max(event_id) AS event_id, max_by(event_type, event_id) AS event_type
       FROM events GROUP BY user_id, CAST(ts AS DATE)"""
)
def stream_newest(spark, sf_dir):
    """Newest event per user and day of a drained feed, kept in state of one entry per key and laid over a dated table."""
    path = scratch_path(spark, "newest")
    stream = _event_stream(spark, sf_dir).select("user_id", day("ts").alias("day"), "event_id", "event_type")
    newest = feeds.newest_stream(stream, ["user_id"], ["event_id"], "day", "60 days")
    handler = feeds.upsert_handler(path, "day", ["user_id"], ["event_id"], transform=lambda b: b.drop("_settles"))
    feeds.drain(newest, handler, scratch_path(spark, "checkpoint"), "update")
    return spark.read.parquet(path).select("user_id", "day", "event_id", "event_type")


@query(
    """WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, event_id, event_type IN ('view', 'click', 'signup') AS post FROM events),
       n AS (SELECT user_id, day, post, max(event_id) AS event_id FROM e GROUP BY ALL),
       last AS (SELECT least((SELECT max(day) FROM e WHERE post), (SELECT max(day) FROM e WHERE NOT post)) - 1 AS day)
       SELECT coalesce(p.user_id, m.user_id) AS user_id, coalesce(p.day, m.day) AS day, p.event_id AS event_id, m.event_id AS "event_idMetrics"
       FROM (SELECT * FROM n WHERE post) p FULL JOIN (SELECT * FROM n WHERE NOT post) m ON p.user_id = m.user_id AND p.day = m.day
       WHERE coalesce(p.day, m.day) < (SELECT day FROM last)"""
)
def stream_join(spark, sf_dir):
    """Two feeds joined day by day as streams: all settled days, whether one side or both had the user."""
    path = scratch_path(spark, "joined")
    is_post = F.col("event_type").isin(*EVENT_POSTS)
    sides = [_event_stream(spark, sf_dir).where(some).select("user_id", day("ts").alias("day"), "event_id") for some in (is_post, ~is_post)]
    feeds.drain_to_files(feeds.join_streams(*sides, "user_id", ["event_id"], "day", "1 day"), path, scratch_path(spark, "checkpoint"))
    return spark.read.parquet(path).select("user_id", "day", "event_id", "event_idMetrics")


@query(
    """SELECT 'https://vk.com/' || user_id AS metricsurl, event_id AS kafkaoffset, event_type IN ('view', 'click', 'signup') AS first FROM events"""
)
def two_streams_ingest(spark, sf_dir):
    """Two streams with checkpoints of their own ingest on one day, the second batch repeated on the next: all rows once."""
    place = _scratch_tables(spark)
    is_post = F.col("event_type").isin(*EVENT_POSTS)
    message = F.to_json(F.struct(F.concat(F.lit("https://vk.com/"), F.col("user_id").cast("string")).alias("Url"), is_post.cast("bigint").alias("Type")))
    ingest = lambda batch, run: jobs.ingest_metrics(batch, run, place("delta"))
    for n, some in enumerate((is_post, ~is_post)):
        envelope = _event_stream(spark, sf_dir).where(some).select(message.alias("value"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"))
        feeds.drain(envelope, jobs.ingest_handler(ingest, "2024-01-31", "Metrics", "g", place(f"checkpoint{n}")), place(f"checkpoint{n}"))
    again = table(spark, sf_dir, "events").where(~is_post).select(message.alias("value"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"))
    jobs.ingest_handler(ingest, "2024-02-01", "Metrics", "g", place("checkpoint1"))(again, 0)
    days = [tables.read_delta(spark, place("delta"), d) for d in ("2024-01-31", "2024-02-01")]
    rows = schema.union_drift(*(d for d in days if d is not None))
    return rows.select("metricsurl", "kafkaoffset", (F.col("metricstype") == 1).alias("first"))
