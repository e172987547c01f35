"""Feed files read in byte ranges against the same files read whole."""

from __future__ import annotations

from contextlib import contextmanager

import pytest

from newsloom.sources import feeds


@contextmanager
def ranges(spark, size):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def rss(n, title="News & more"):
    texts = ["café", "世界", "a &lt; b", "<![CDATA[raw & <b>bold</b>]]>", "  spaced\n", ""]
    body = "\n".join(
        f"<item><title>t{i} {texts[i % 6]}</title><link>http://x.com/{i}</link>"
        f"{'<description>' + 'long ' * (i % 40) + '</description>' if i % 3 else ''}<pubDate>Mon, 29 Jan 2024</pubDate></item>"
        for i in range(n)
    )
    return f'<?xml version="1.0"?><rss><channel><title>{title.replace("&", "&amp;")}</title><link>http://x.com</link>{body}</channel></rss>'


def atom(n):
    body = "".join(
        f'<entry xml:lang="en"><title type="text">e{i} ü</title><link rel="alternate" href="http://y.com/{i}"/>'
        f"<summary>s{i}</summary><updated>2024-01-29T00:00:00Z</updated><author><name>w{i}</name></author></entry>"
        for i in range(n)
    )
    return f"<feed><title>Atom</title>{body}</feed>"


def write(folder, files):
    for (feed, name), data in files.items():
        target = folder / f"feed={feed}"
        target.mkdir(parents=True, exist_ok=True)
        (target / name).write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(folder)


def rows(df):
    return sorted(map(tuple, df.select("feed", "document", "feed_title", "pos", "title", "summary", "link", "published", "author", "source_title").collect()), key=repr)


@pytest.mark.parametrize("size", [97, 1000, 1 << 20])
@pytest.mark.parametrize(("element", "build"), [("item", rss), ("entry", atom)])
def test_ranges_equal_whole_files(spark, tmp_path, element, build, size):
    path = write(tmp_path / "landed", {("one", "a.xml"): build(60), ("one", "b.xml"): build(1), ("two", "c.xml"): build(0), ("two", "d.xml"): build(25)})
    whole = feeds.feed_entries(feeds.read_feed_documents(spark, path))
    with ranges(spark, size):
        got = feeds.split_feed_entries(spark, path, element)
        assert rows(got) == rows(whole) and len(rows(whole)) == 86


def test_files_cut_anywhere(spark, tmp_path):
    text = rss(6).encode()
    files = {("cut", f"{at:05d}.xml"): text[:at] for at in range(60, len(text), 23)}
    ends = [i + 7 for i in range(len(text)) if text[i : i + 7] == b"</item>"]
    files |= {("cut", f"end{at}.xml"): text[:at] for at in ends} | {("cut", f"tag{at}.xml"): text[: at - 1] for at in ends}
    path = write(tmp_path / "landed", files)
    whole = feeds.feed_entries(feeds.read_feed_documents(spark, path))
    with ranges(spark, 150):
        got = rows(feeds.split_feed_entries(spark, path))
    # a cut inside a character leaves one that can't be read, in the part that is left out
    assert got == rows(whole) and len({r[1] for r in got}) > 20


def test_byte_order_marks_entry_names_and_stray_tags(spark, tmp_path):
    marked = b"\xef\xbb\xbf" + rss(3).encode()
    rdf = "<rdf><channel><title>R</title><items><li/></items></channel><item about='x'><title>one</title><link>http://z.com</link></item></rdf>"
    stray = "<rss><channel><title>S</title></item><item><title>a</title></item> </item><item><title>b &amp; c & d</title></item></channel></rss>"
    path = write(tmp_path / "landed", {("m", "a.xml"): marked, ("m", "cut.xml"): marked[:-60], ("r", "b.xml"): rdf, ("s", "c.xml"): stray, ("s", "empty.xml"): ""})
    got = rows(feeds.split_feed_entries(spark, path))
    found = {}
    for r in got:
        found.setdefault(r[1].rsplit("/", 1)[1], []).append((r[2], r[3], r[4]))
    assert [p for _, p, _ in found["a.xml"]] == [0, 1, 2] and {t for t, _, _ in found["a.xml"]} == {"News & more"}
    assert [p for _, p, _ in found["cut.xml"]] == [0, 1]
    assert found["b.xml"] == [("R", 0, "one")]
    assert found["c.xml"] == [("S", 1, "a"), ("S", 3, "b & c & d")] and "empty.xml" not in found


def test_one_row_per_entry_and_range(spark, tmp_path):
    path = write(tmp_path / "landed", {("one", "a.xml"): rss(200)})
    with ranges(spark, 2000):
        scan = spark.read.schema("value string, feed string").text(path, lineSep="</item>")
        assert scan.rdd.getNumPartitions() > 5
        assert feeds.split_feed_entries(spark, path).count() == 200
    with pytest.raises(ValueError):
        feeds.split_feed_entries(spark, path, "channel")
