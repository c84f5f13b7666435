"""Flattening, policies and the five-way split."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from feedfold.operators import reshape as R
from feedfold.operators import split as P
from feedfold.operators.schema import struct_columns


def test_drop_fields_ignores_case_and_unknown(spark):
    df = spark.createDataFrame([(1, 2)], "_TRACE_ID int, b int")
    assert R.drop_fields(df, ["_trace_id", "zzz"]).columns == ["b"]


def test_keep_paths_flattens_any_depth(spark):
    df = spark.createDataFrame([(1, ((5,), 2))], "a int, m struct<w:struct<v:int>, x:int>")
    out = R.keep_paths(df, ["a", "m.w.v", "M.x", "m.nope"])
    assert out.columns == ["a", "mwv", "Mx"] and tuple(out.first()) == (1, 5, 2)
    assert df.select(R.flatten_path("m.w.v")).columns == ["mwv"]


def test_blog_policy_modes(spark):
    df = spark.createDataFrame(
        [("u", (1, 2), (3,), "t")], "Url string, Metrics struct<Audience:int,LikeCount:int>, MetricsAvg1w struct<ViewCount:int>, _TRACE_ID string"
    )
    policy = P.FieldPolicy.parse('{"_TRACE_ID": []}', "Url, Metrics.LikeCount,MetricsAvg1w.ViewCount")
    everything = P.transform_blogs(df, policy)
    assert everything.columns == ["Url", "Metrics", "MetricsAvg1w", "CurrentTimestamp"]
    primary = P.transform_blogs(df, policy, "primary")
    assert primary.columns == ["Url", "MetricsLikeCount", "MetricsAvg1wViewCount", "CurrentTimestamp"]
    assert not struct_columns(primary)
    with pytest.raises(ValueError):
        P.apply_policy(df, policy, "other")


def test_metrics_projection_with_missing_fields(spark):
    df = spark.createDataFrame([(("b", 7), "2024-01-01", "u")], "Blog struct<Url:string,Type:int>, CreateDate string, Url string")
    row = R.project_metrics(df).first()
    assert (row["blogtype"], row["blogurl"], row["likes"], row["metricsurl"]) == (7, "b", None, "u")
    assert R.canonical_metrics(R.project_metrics(df)).columns == list(R.METRICS_NAMES.values())


def test_suffix_only_collisions(spark):
    df = spark.createDataFrame([(1, 2, 3)], "Id int, Likes int, partdate int")
    assert R.suffix_collisions(df, ["id", "PartDate"], "Metrics").columns == ["IdMetrics", "Likes", "partdateMetrics"]


def test_post_dates_survive_bad_text(spark):
    df = spark.createDataFrame([("2024-01-02T10:00:00",), ("",), (None,), ("2024-01-03 01:02:03",)], "CreateDate string")
    rows = R.derive_post_dates(df).collect()
    assert [r["PartDate"] for r in rows] == [date(2024, 1, 2), None, None, date(2024, 1, 3)]
    assert rows[0]["PostCreateDate"] == "2024-01-02T10:00:00"


def test_flatten_structs(spark):
    df = spark.createDataFrame([(1, "c", "d", (5, 6), (7,))], "Id int, PostCreateDate string, PartDate string, A struct<x:int,Id:int>, B struct<y:int>")
    assert R.flatten_struct(df, "A").columns == ["Id", "PostCreateDate", "PartDate", "x", "AId"]
    assert R.flatten_structs(df, ["A", "B", "C"]).columns == ["Id", "PostCreateDate", "PartDate", "Ax", "AId", "By"]
    assert R.flatten_structs(df, ["B"], keys=["Id"]).columns == ["Id", "By"]


ATTACHMENTS = (
    "array<struct<Body:string, BodyStats:struct<SymbolCount:int>, Url:string,"
    "Ocr:struct<Body:string, Boxes:array<struct<Body:string,Position:struct<Left:array<double>>>>, Meta:struct<Lang:string>>,"
    "Ids:array<struct<SymbolCount:int>>>>"
)


def _attachment(n):
    return (f"b{n}", (n,), f"u{n}", (f"ocr{n}", [("box", ([1.0],))], ("ru",)), [(8,), (9,)])


def test_rebuild_by_path_and_by_leaf(spark):
    df = spark.createDataFrame([(1, [_attachment(1), _attachment(2)])], f"Id int, Attachments {ATTACHMENTS}")
    by_path = df.select(R.rebuild_array(df, "Attachments", ["Body", "Ocr.Boxes"]))
    first = by_path.first()["Attachments"][0].asDict(recursive=True)
    assert first == {"SymbolCount": 1, "Url": "u1", "IdsSymbolCount": [8, 9], "Ocr": {"Body": "ocr1", "Lang": "ru"}}
    by_leaf = df.select(R.rebuild_array(df, "Attachments", ["Body", "Lang"], match="leaf"))
    first = by_leaf.first()["Attachments"][0].asDict(recursive=True)
    assert first["Ocr"] == {"Left": [[1.0]]} and "Body" not in first


def test_rebuild_to_nothing_leaves_keys(spark):
    df = spark.createDataFrame([(1, [(5,)])], "Id int, L array<struct<a:int>>")
    slim = df.select("Id", R.rebuild_array(df, "L", ["a"]))
    assert R.explode_struct_array(slim, "L", ["Id"]).columns == ["Id"]


def test_explode_keeps_records_without_elements(spark):
    df = spark.createDataFrame([(1, [(5, 9), None]), (2, []), (3, None)], "Id int, L array<struct<a:int,Id:int>>")
    out = R.explode_struct_array(df, "L", ["Id"])
    assert out.columns == ["Id", "a", "LId"]
    assert {tuple(r) for r in out.collect()} == {(1, 5, 9), (1, None, None), (2, None, None), (3, None, None)}
    assert R.explode_struct_array(df, "Nope", ["Id"]).columns == ["Id"]
    scalars = spark.createDataFrame([(1, [4, 5])], "Id int, L array<int>")
    assert R.explode_struct_array(scalars, "L", ["Id"]).count() == 2


def _posts(spark):
    return spark.createDataFrame(
        [
            ("k", "2024-01-01", date(2024, 1, 1), ("a", 1, "h"), (2, (3,), "s"), (10, 20), ("t",), "body", [_attachment(1)], None, (True,), 5, 0),
        ],
        "Id string, PostCreateDate string, PartDate date, Author struct<Url:string,Type:int,Host:string>,"
        "Blog struct<Type:int,Metrics:struct<FollowerCount:int>,SubTitle:string>, Metrics struct<LikeCount:int,ViewCount:int>,"
        f"Toxicity struct<Label:string>, Body string, Attachments {ATTACHMENTS}, GeoData array<struct<Caption:string>>,"
        "ModificationInfo struct<IsModified:boolean>, kafkapartition int, kafkaoffset int",
    )


POLICY = P.FieldPolicy.parse(
    json.dumps(
        {
            "Author": ["Host", "Url"], "Blog": ["SubTitle"], "Attachments": ["Body", "Ocr.Boxes"], "Toxicity": [],
            "Body": [], "GeoData": [], "ModificationInfo": {"Modifications": []},
        }
    ),
    "Author.Url, Blog.Type,Blog.Metrics.FollowerCount,Metrics.LikeCount,Toxicity,Toxicity.Label,KafkaPartition,PartDate,Nope.x",
)


def test_split_into_five_parts(spark):
    parts = P.split_posts(_posts(spark), POLICY, "2024-01-05")
    keys = ["Id", "PostCreateDate", "PartDate", "kafkapartition", "kafkaoffset"]
    primary = parts[P.PRIMARY]
    # nested excludes of Author do not reach the primary part, nor does case matter
    assert primary.columns == [*keys, "AuthorUrl", "BlogType", "BlogMetricsFollowerCount", "MetricsLikeCount", "Toxicity", "ExecDate"]
    row = primary.first()
    assert (row["AuthorUrl"], row["BlogMetricsFollowerCount"], row["MetricsLikeCount"], row["ExecDate"]) == ("a", 3, 10, "2024-01-05")
    other = parts[P.OTHER]
    assert other.columns == [*keys, "Metrics", "AuthorType", "BlogMetrics", "ExecDate"]
    attachments = parts[P.ATTACHMENTS]
    assert attachments.columns == [*keys, "SymbolCount", "Url", "IdsSymbolCount", "Ocr", "ExecDate"]
    assert parts[P.GEO].first()["Caption"] is None
    assert parts[P.MODIFICATION].first()["IsModified"] is True


def test_unmatched_primary_paths_are_reported(spark):
    _, missing = P.match_primary(_posts(spark), POLICY)
    assert missing == ["Toxicity.Label", "Nope.x"]


def test_split_tolerates_absent_structures(spark):
    bare = _posts(spark).select("Id", "PostCreateDate", "PartDate", "Body")
    parts = P.split_posts(bare, POLICY, "2024-01-05")
    assert all(part.count() == 1 for part in parts.values())
    assert parts[P.ATTACHMENTS].columns == ["Id", "PostCreateDate", "PartDate", "ExecDate"]


def test_split_with_repeated_columns_keeps_first(spark):
    twice = _posts(spark).select("*", F.lit("other").alias("body"))
    assert P.split_posts(twice, P.FieldPolicy(primary=("Body",)), "d")[P.PRIMARY].first()["Body"] == "body"
