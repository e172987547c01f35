"""Columns against the Python standard library."""

from __future__ import annotations

import hashlib
import json
import math
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from newsloom.functions import score, text, times, url
from newsloom.sources.suffixes import suffix_depth, suffix_rules

URLS = [
    "https://www.Example.com/a?utm_source=x&b=2&a=1#top",
    "HTTP://User:Pw@Example.COM:8080/Path;p?B=1&b=2&B=3",
    "https://example.com/a?q=a+b%20c&q=second&UTM_Medium=x&ref=1&Source=y",
    "https://example.com/?a&b=&=c&&d==e",
    "https://example.com/%7Ea?x=%zz%41&y=%C3%A9&z=%E4%B8%AD",
    "https://example.com/path;?x=1",
    "https://example.com/path;a=b?x=1#f",
    "https://example.com/a;;",
    "https://example.com/a;b/c",
    "https://example.com?x=2&x=1",
    "https://under_score.example.com/with space?q=1 2",
    "//cdn.example.com/x?y=1",
    "/relative/path?b=1&a=2",
    "mailto:Someone@Example.com",
    "https://example.com/a?é=1&z=2&中=3",
    "https://example.com/a?fbclid=1&gclid=2",
    " \thttps://example.com/a\nb",
    "",
]


CANONICAL = [
    "https://www.example.com/a?a=1&b=2",
    "http://user:pw@example.com:8080/Path;p?B=1&b=2",
    "https://example.com/a?q=a b c",
    "https://example.com/?=c&a=&b=&d==e",
    "https://example.com/%7Ea?x=%zzA&y=é&z=中",
    "https://example.com/path?x=1",
    "https://example.com/path;a=b?x=1",
    "https://example.com/a;;",
    "https://example.com/a;b/c",
    "https://example.com?x=2",
    "https://under_score.example.com/with space?q=1 2",
    "//cdn.example.com/x?y=1",
    "/relative/path?a=2&b=1",
    "mailto:Someone@Example.com",
    "https://example.com/a?z=2&é=1&中=3",
    "https://example.com/a",
    "https://example.com/ab",
    "",
]
WITH_ALL_PARAMETERS = [
    "https://www.example.com/a?utm_source=x&b=2&a=1",
    "http://user:pw@example.com:8080/Path;p?B=1&b=2&B=3",
    "https://example.com/a?q=a+b%20c&q=second&UTM_Medium=x&ref=1&Source=y",
    "https://example.com/?a&b=&=c&&d==e",
    "https://example.com/%7Ea?x=%zz%41&y=%C3%A9&z=%E4%B8%AD",
    "https://example.com/path?x=1",
    "https://example.com/path;a=b?x=1",
    "https://example.com/a;;",
    "https://example.com/a;b/c",
    "https://example.com?x=2&x=1",
    "https://under_score.example.com/with space?q=1 2",
    "//cdn.example.com/x?y=1",
    "/relative/path?b=1&a=2",
    "mailto:Someone@Example.com",
    "https://example.com/a?é=1&z=2&中=3",
    "https://example.com/a?fbclid=1&gclid=2",
    "https://example.com/ab",
    "",
]


@pytest.mark.parametrize(("remove_params", "expected"), [(True, CANONICAL), (False, WITH_ALL_PARAMETERS)])
def test_normalize_url(spark, remove_params, expected):
    df = spark.createDataFrame([(u,) for u in URLS], "u string")
    assert [r[0] for r in df.select(url.normalize_url(F.col("u"), remove_params)).collect()] == expected


def test_registered_domain(spark):
    expected = {
        "https://www.reuters.com/article": "reuters.com",
        "https://finance.yahoo.com/news/x": "yahoo.com",
        "https://a.b.example.co.uk/": "example.co.uk",
        "http://user:pw@News.Example.COM:8080/x": "example.com",
        "http://shop.foo.ck/": "shop.foo.ck",
        "http://www.ck/": "ck",
        "http://x.www.ck/": "ck",
        "http://a.b.city.kobe.jp/": "city.kobe.jp",
        "http://a.b.c.kobe.jp/": "b.c.kobe.jp",
        "http://localhost/x": "localhost.",
        "http://192.168.0.1/x": "192.168.0.1.",
        "http://www.com/": "com",
        "http://foo.blogspot.com/": "blogspot.com",
        "http://例子.中国/": "例子.中国",
        "http://a.xn--fiqs8s/": "a.xn--fiqs8s",
        "http://example.com./": "example.com",
    }
    rules = suffix_rules(spark)
    assert suffix_depth(rules) <= 4
    df = spark.createDataFrame([(u,) for u in expected], "u string")
    got = {r["u"]: r["d"] for r in url.with_registered_domain(df, "u", rules, "d").collect()}
    assert got == expected
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = url.with_registered_domain(df, "u", rules, "d")._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_content_hash_and_strip(spark):
    odd = "".join(chr(c) for c in range(0x3100) if chr(c).isspace())
    samples = [("Test Title", "Test  Summary"), (" A \tb ", "　C\n\nd"), ("ÉÀ", "中文"), ("", ""), (odd, "x" + odd + "y")]
    assert sorted(set(odd)) == sorted(set(text.WHITESPACE))

    def expected(title: str, summary: str) -> str:
        return hashlib.sha256(" ".join(f"{title.lower()} {summary.lower()}".split()).encode()).hexdigest()

    df = spark.createDataFrame(samples, "t string, s string")
    rows = df.select(text.content_hash(F.col("t"), F.col("s")), text.strip(F.col("s")), "t", "s").collect()
    assert [r[0] for r in rows] == [expected(t, s) for t, s in samples]
    assert [r[1] for r in rows] == [s.strip() for _, s in samples]


def test_url_hash_and_config_hash(spark):
    row = spark.range(1).select(
        text.url_hash(F.lit("https://é.com/")),
        text.config_hash({"rss_feeds": [{"name": "中"}], "lookback_days": 7, "output_dir": "x"}),
    ).first()
    assert row[0] == hashlib.sha256("https://é.com/".encode()).hexdigest()[:16]
    rendered = json.dumps({"lookback_days": 7, "rss_feeds": [{"name": "中"}]}, sort_keys=True, ensure_ascii=False)
    assert row[1] == hashlib.sha256(rendered.encode()).hexdigest()[:16]


def signatures(spark, *cases):
    df = spark.createDataFrame(list(cases), "k array<string>, d array<string>")
    return [r[0] for r in df.select(text.topic_signature(F.col("k"), F.col("d"))).collect()]


def test_signature_is_stable_and_hexadecimal(spark):
    case = (["harbour", "ferry", "tide", "c", "d"], ["p.net", "q.net", "r.net"])
    first, second, short = signatures(spark, case, case, (["solo"], ["solo.net"]))
    assert first == second and len(short) == 64 and set(short) <= set("0123456789abcdef")


def test_signature_differs_with_content_and_order(spark):
    got = signatures(
        spark,
        (["ferry", "harbour"], ["coast.net"]),
        (["glacier", "ridge"], ["alps.net"]),
        (["harbour", "ferry"], ["coast.net"]),
    )
    assert len(set(got)) == 3


def test_signature_is_cut_to_ten_keywords_and_five_domains(spark):
    words, hosts = [f"term{i}" for i in range(20)], [f"host{i}.net" for i in range(10)]
    long, short = signatures(spark, (words, hosts), (words[:10], hosts[:5]))
    assert long == short


def test_signature_hashes_the_json_text(spark):
    cases = [(["é", '"q"', "中"], ["a\\b.com"]), ([], [])]
    expected = [
        hashlib.sha256(json.dumps({"kw": k, "pub": d}, sort_keys=True, ensure_ascii=False).encode()).hexdigest()
        for k, d in cases
    ]
    assert signatures(spark, *cases) == expected


def test_feed_dates(spark):
    utc = timezone.utc
    expected = {
        "Fri, 13 Feb 2026 10:00:00 GMT": datetime(2026, 2, 13, 10, tzinfo=utc),
        "13 Feb 2026 10:00 +0800": datetime(2026, 2, 13, 2, tzinfo=utc),
        "Fri, 13 Feb 26 10:00:05 EST": datetime(2026, 2, 13, 15, 0, 5, tzinfo=utc),
        "Sat, 1 January 2000 00:00:00 -0130": datetime(2000, 1, 1, 1, 30, tzinfo=utc),
        "2026-02-13T10:00:00Z": datetime(2026, 2, 13, 10, tzinfo=utc),
        "2026-02-13T10:00:00.987+08:00": datetime(2026, 2, 13, 2, tzinfo=utc),
        "2026-02-13 10:00": datetime(2026, 2, 13, 10, tzinfo=utc),
        "2026-02-13": datetime(2026, 2, 13, tzinfo=utc),
        "2026-02": datetime(2026, 2, 1, tzinfo=utc),
        "30 Feb 2026 10:00:00 GMT": None,
        "yesterday": None,
        "": None,
    }
    df = spark.createDataFrame([(t,) for t in expected], "t string")
    got = {r["t"]: r["s"] for r in df.select("t", F.unix_seconds(times.parse_feed_date(F.col("t"))).alias("s")).collect()}
    assert got == {t: None if d is None else int(d.timestamp()) for t, d in expected.items()}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Taipei"])
def test_buckets_and_formats_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        moments = [
            datetime(2026, 2, 13, 23, 59, 59, 999999, tzinfo=timezone.utc),
            datetime(2026, 3, 8, 7, 30, tzinfo=timezone.utc),
            datetime(1969, 12, 31, 5, 0, 0, 5, tzinfo=timezone.utc),
        ]
        micros = [(int((m - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(microseconds=1)),) for m in moments]
        ts = F.timestamp_micros("m")
        rows = spark.createDataFrame(micros, "m bigint").select(
            times.daily_bucket(ts), times.hourly_bucket(ts), times.format_iso8601(ts), times.format_stored(ts),
            F.unix_micros(times.parse_iso8601(times.format_iso8601(ts))), "m",
            F.unix_micros(times.bucket_instant(times.hourly_bucket(ts))),
        ).collect()
        for moment, row in zip(moments, rows):
            hour = moment.replace(minute=0, second=0, microsecond=0)
            assert list(row)[:5] == [
                moment.strftime("%Y-%m-%d"), hour.isoformat(), moment.isoformat(), str(moment), row["m"],
            ]
            assert row[6] == int((hour - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(microseconds=1))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_to_utc(spark):
    wall = F.lit("2026-07-01 10:00:00").cast("timestamp_ntz")
    row = spark.range(1).select(F.unix_seconds(times.to_utc(wall)), F.unix_seconds(times.to_utc(wall, "America/New_York"))).first()
    local = datetime(2026, 7, 1, 10)
    assert row[0] == local.replace(tzinfo=timezone.utc).timestamp()
    assert row[1] == local.replace(tzinfo=ZoneInfo("America/New_York")).timestamp()


def test_unknown_bucket_interval():
    with pytest.raises(ValueError, match="weekly"):
        times.bucket(None, "weekly")


def test_scores(spark):
    now = datetime(2026, 2, 13, tzinfo=timezone.utc)
    cases = [(0, None, 0.5, 1), (10, 24.0, 0.85, 5), (200, -3.0, 1.0, 10), (50_000, 0.5, 2.0, 100), (1, 500.0, 0.0, 2)]
    rows = [(v, None if h is None else now - timedelta(hours=h), w, d) for v, h, w, d in cases]
    df = spark.createDataFrame(rows, "v int, seen timestamp, w double, d int")
    got = df.select(
        score.volume_score(F.col("v")), score.velocity_score(F.col("seen"), F.lit(now)),
        score.source_score(F.col("w"), F.col("d")),
    ).collect()
    for (v, h, w, d), row in zip(cases, got):
        volume = 0 if v <= 0 else min(100, 20 * math.log10(v + 1) + 20)
        velocity = 0 if h is None else min(100, 100 * math.exp(-h / 24))
        spread = min(40, 15 * math.log10(d) + 15) if d > 1 else 0
        assert list(row) == pytest.approx([volume, velocity, max(0, min(100, 60 * w + spread))])


def test_watchlist_bonus(spark):
    df = spark.createDataFrame(
        [(["Market"], ["x"]), (["other"], ["About TSMC today"]), (["marketing"], ["none"]), ([], [])],
        "k array<string>, t array<string>",
    )
    terms = score.watchlist_terms(["market"], ["tsmc", "TSMC"])
    assert terms == ["market", "tsmc"]
    bonus = df.select(score.watchlist_bonus(F.col("k"), F.col("t"), terms)).collect()
    assert [r[0] for r in bonus] == [80.0, 80.0, 0.0, 0.0]
    assert df.select(score.watchlist_bonus(F.col("k"), F.col("t"), [])).first()[0] == 0.0
