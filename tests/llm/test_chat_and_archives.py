"""Chat formatting and WARC archives: exact round trips."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import chat, warc
from newsloom.llm.queries import BYTES, TRAP

TEXTS = ["", "plain", TRAP, "<|end|>", "<|turn|>assistant<|text|>x<|end|>", "a\\", "\\<|", "<\\|", "😀 日本 \n\n x", "<|endoftext|>", " lead", "trail <"]


@pytest.mark.parametrize("text", TEXTS)
def test_escaping_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|" not in chat.escape(text)


@pytest.fixture(scope="module")
def conversations():
    random.seed(2)
    rows: list[tuple] = []
    for conv in range(25):
        for turn in range(random.randint(1, 9)):
            rows.append((conv, turn, random.choice(["user", "assistant", "system", "<|end|>"]), random.choice(TEXTS)))
    rows += [(90, t, "assistant", f"t{t} ") for t in range(700)]
    rows += [(91, 0, None, None), (91, 1, "assistant", None), (92, None, "assistant", "first"), (92, -3, "user", "second")]
    rows += [(None, 0, "assistant", "no id"), (93, 0, "assistant", "tie"), (93, 0, "assistant", "tie"), (93, 0, "assistant", "long " * 20000)]
    return rows


def test_digests_read_back_equal_the_input(spark, conversations):
    by: dict = {}
    key = lambda r: (-(10**9) if r[1] is None else r[1], r[2] or "", r[3] or "")
    for row in sorted(conversations, key=key):
        by.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    expected = set()
    for conv, turns in by.items():
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        expected.add((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    frame = spark.createDataFrame(conversations, "conv_id long, turn int, role string, text string")
    frame = frame.repartition(7).withColumn("ids", F.lit("other")).withColumn("segment", F.lit(1))
    formatted = chat.format_conversations(frame, BYTES, turns_per_segment=100, most_chars=5000)
    got = chat.conversation_digests(formatted).collect()
    assert {tuple(r)[:5] for r in got} == expected and len(got) == len(expected)
    assert formatted.filter("conv_id = 90").count() == 7
    assert chat.conversation_digests(chat.format_conversations(frame.limit(0), BYTES)).collect() == []


def test_tokens_do_not_depend_on_segments(spark, conversations):
    frame = spark.createDataFrame(conversations, "conv_id long, turn int, role string, text string").filter("conv_id = 90")
    cut, whole = (
        [i for r in chat.format_conversations(frame, BYTES, turns_per_segment=n).orderBy("segment", "piece").collect() for i in r.ids]
        for n in (50, 10_000)
    )
    assert cut == whole


def test_mask_is_exactly_the_learned_tokens():
    offsets = np.array([[0, 3], [3, 3], [3, 5], [5, 9], [9, 12]])
    assert chat.mask_tokens(offsets, np.array([[3, 9]])).tolist() == [False, False, True, True, False]


@pytest.fixture(scope="module")
def pages():
    big, other = "<p>" + "copy " * 40, "<p>" + "ü" * 60
    rows = [(i, f"http://h{i % 3}.Example.com:80{i % 2}/p?q={i // 2}", random.Random(i).choice([big, other, f"own {i}", "short"])) for i in range(80)]
    rows += [(200, None, big), (201, "http://a.b/x y\r\nz", None), (None, "http://a.b/", big), (202, "http://[bad", ""), (203, "http://a.b/", "é" * 50)]
    return rows + [rows[3], (204, "http://same.org/", "n" * 200_000)] + [(300 + i, "http://same.org/", f"v{i}") for i in range(30)]


def test_archives_read_back(spark, pages):
    how = warc.ArchiveShape(file_bytes=4000, block_captures=7)
    first: dict[bytes, int] = {}
    for page, _, html in sorted((p for p in pages if p[0] is not None), key=lambda p: p[0]):
        first.setdefault((html or "").encode(), page)
    expected = Counter()
    for page, _, html in pages:
        payload = (html or "").encode()
        original = first[payload] if len(payload) >= 100 and payload in first else page
        revisit = page is not None and original != page
        expected[page, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", original if revisit else None] += 1
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4).withColumn("digest", F.lit("x"))
    captures = warc.write_archives(frame, how)
    directory = warc.write_index(captures, how)
    records = warc.read_records(warc.index_captures(directory)).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records) == expected
    for r in records:
        if r.record_type == "response":
            assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest
    assert directory.count() > 5
    asked = ["http://same.org/", "http://h1.example.com:801/p?q=3", "http://nowhere.org/"]
    keys = {warc.url_key(u) for u in asked}
    found = warc.look_up(directory, asked).collect()
    assert Counter(r.page_id for r in found) == Counter(p for p, u, _ in pages if u is not None and warc.url_key(u) in keys)
    assert {r.page_id for r in warc.read_records(warc.look_up(directory, asked[:1])).collect()} == {204, *range(300, 330)}


AWKWARD = ["http://h/a b", "http://h/a!b", "http://h/a\"b", "http://h/a#b", "http://h/a$b", "http://h/a", "http://h/a%20b", "http://h/a\tb", "http://h/ä b", "http://h/a b?x y", "", None]


def test_look_ups_find_all_captures_of_awkward_keys(spark):
    rows = [(i, AWKWARD[i % len(AWKWARD)], f"page {i}") for i in range(4 * len(AWKWARD))]
    # one url with more captures than a block and than an index file hold
    rows += [(1000 + i, "http://hot/a c", f"hot {i}") for i in range(120)] + [(5000, "http://[bad url", "x")]
    how = warc.ArchiveShape(block_captures=3)
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    directory = warc.write_index(warc.write_archives(frame, how), how)
    keys = Counter(warc.url_key(u) for _, u, _ in rows)
    for url in [*AWKWARD[:-1], "http://hot/a c", "http://[bad url", "http://h/zz", "http://aa/"]:
        found = [r.page_id for r in warc.look_up(directory, [url]).collect()]
        assert sorted(found) == sorted(p for p, u, _ in rows if warc.url_key(u) == warc.url_key(url)), url
    every = warc.look_up_keys(directory, warc.keys_of(frame)).collect()
    assert Counter(r.key for r in every) == keys and Counter(r.page_id for r in every) == Counter(p for p, _, _ in rows)


def test_damaged_payloads_are_seen(spark):
    same = "<p>" + "same " * 40
    frame = spark.createDataFrame([(1, "http://a/", same), (2, "http://b/", same)], "page_id long, url string, html string")
    records = warc.with_named_payloads(warc.read_records(warc.write_archives(frame), payloads=False)).collect()
    assert sorted((r.page_id, r.record_type, r.payload_bytes, r.payload_digest) for r in records) == [
        (1, "response", len(same), hashlib.sha256(same.encode()).hexdigest()), (2, "revisit", len(same), hashlib.sha256(same.encode()).hexdigest()),
    ]
    whole = warc.record_bytes(1, "http://a/", same.encode(), hashlib.sha256(same.encode()).hexdigest(), None, "2024-01-01T00:00:00Z")
    cut = warc.parsed_record(warc._member(whole.replace(b"same same", b"sane same", 1)))
    assert cut["payload_digest"] != hashlib.sha256(same.encode()).hexdigest()
    lost = spark.createDataFrame([(2, "u", 5, "d", "revisit", 9)], warc.RECORDS)
    (row,) = warc.with_named_payloads(lost).collect()
    assert (row.payload_bytes, row.payload_digest, row.refers_to) == (None, None, 9)


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    directory = warc.write_index(warc.write_archives(none))
    assert warc.read_records(warc.index_captures(directory)).collect() == []
    assert warc.look_up_keys(directory, warc.keys_of(none)).collect() == []
