"""Small message shapes for the three feeds, and envelopes built from them.

Only fields that operators name are here. Their names are fixed values: the feeds' own. ``Trace`` and ``Secret`` are ours, to be dropped.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedfold.sources.sinks import as_json
from feedfold.sources.synth import default_rows

COUNTS = "LikeCount:bigint,ViewCount:bigint"

BLOG = f"Url string, UrlHash string, Nick string, Metrics struct<{COUNTS}>, Trace string"

METRICS = f"Url string, CreateDate string, Type bigint, Blog struct<Url:string,Type:bigint>, Metrics struct<{COUNTS},RepostCount:bigint,Timestamp:string>"

POST = f"""
Url string, ParentUrl string, CreateDate string, Body string, Type bigint, IsSpam boolean,
Author struct<Url:string,Name:string,Secret:string>,
Blog struct<Url:string,UrlHash:string,Metrics:struct<FollowerCount:bigint>,Secret:string>,
Metrics struct<{COUNTS},Timestamp:string>,
Attachments array<struct<Type:bigint,Body:string,Ocr:struct<Body:string,Lang:string>>>,
GeoData array<struct<Caption:string,Type:bigint>>,
ModificationInfo struct<IsDeleted:boolean,Status:bigint>,
Topics array<struct<Id:bigint,key:string,value:double>>, Toxicity struct<Score:double>, Trace string
"""

POST_EXCLUDES = """{"Author": ["Secret"], "Blog": ["Secret"], "Attachments": ["Body", "Ocr.Body"],
"Body": [], "GeoData": [], "ModificationInfo": [], "Trace": []}"""

POST_PRIMARY = (
    "Author.Url,Blog.Metrics.FollowerCount, CreateDate,IsSpam,Metrics.LikeCount,Metrics.Timestamp,"
    "ParentUrl,Url,Topics,Toxicity,CurrentTimestamp,PartDate,KafkaPartition,KafkaOffset"
)


def messages(spark, ddl, n, **values):
    """``n`` default messages with some top-level values set, as an envelope."""
    rows = default_rows(spark, T.StructType.fromDDL(ddl.replace("\n", " ")), n)
    rows = rows.withColumns({k: v if hasattr(v, "cast") else F.lit(v) for k, v in values.items()})
    return envelope(as_json(rows))


def envelope(values):
    """Text values as messages of a feed with two partitions."""
    numbered = values.select(F.col("value").cast("binary"), F.monotonically_increasing_id().alias("offset"))
    return numbered.select("value", (F.col("offset") % 2).cast("int").alias("partition"), "offset")
