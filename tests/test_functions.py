import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from feedfold.functions import (
    NETWORK_TYPES,
    classify_url,
    compact_date,
    date_span,
    days_before,
    run_label,
    text_to_date,
    url_key,
)


def test_key_is_first_16_digest_bytes_and_null_safe(spark):
    df = spark.createDataFrame([("https://vk.com/ü",), (None,)], "u string")
    rows = df.select(
        url_key("u").alias("md5"), url_key("u", "SHA-256").alias("sha256"), url_key("u", "sha1").alias("sha1"),
    ).collect()
    raw = "https://vk.com/ü".encode()
    assert rows[0]["md5"] == hashlib.md5(raw).hexdigest()
    assert rows[0]["sha256"] == hashlib.sha256(raw).hexdigest()[:32]
    assert rows[0]["sha1"] == hashlib.sha1(raw).hexdigest()[:32]
    assert rows[1]["md5"] is None
    with pytest.raises(ValueError):
        url_key("u", "none")


def test_longest_fragment_wins(spark):
    cases = {
        "https://google.com/maps/x": 21,
        "https://google.com/x": 12,
        "https://play.google.com/x": 35,
        "https://yandex.com/x": 1,
        "https://x.com/y": 2,
        "https://zen.yandex.ru/a": 23,
        "https://dzen.ru/a": 23,
        "https://itunes.apple.com/p": 36,
        "https://nowhere.example": 32,
        None: 32,
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    got = {r["u"]: r["n"] for r in df.select("u", classify_url("u").alias("n")).collect()}
    assert got == cases
    assert len(NETWORK_TYPES) == 34


def test_equal_length_fragments_go_by_text_and_empty_map_gives_default(spark):
    df = spark.createDataFrame([("zz-aa",)], "u string")
    assert df.select(classify_url("u", {"zz": 1, "aa": 2}, 0)).first()[0] == 2
    assert df.select(classify_url("u", {}, 9)).first()[0] == 9


def test_dates(spark):
    df = spark.createDataFrame([("2024-02-28", "2024-03-01T23:59:59"), ("2024-03-02", "x")], "a string, b string")
    rows = df.select(
        date_span("a", text_to_date("b")).alias("span"),
        text_to_date("b").alias("b"),
        compact_date(text_to_date("a")).alias("c"),
        days_before(text_to_date("a"), 30).alias("d"),
    ).collect()
    assert rows[0]["span"] == [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]
    assert rows[1]["b"] is None and rows[1]["span"] is None
    assert rows[0]["c"] == "20240228" and rows[0]["d"] == date(2024, 1, 29)
    one = spark.range(1)
    assert one.select(date_span(date(2024, 1, 2), date(2024, 1, 1))).first()[0] == []
    assert one.select(run_label(F.lit("2024-01-01 07:05:00").cast("timestamp"))).first()[0] == "07-05"
    assert len(one.select(run_label()).first()[0]) == 5
