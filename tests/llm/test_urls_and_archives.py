"""URL rules, Bloom cascade, WARC round trip and the merge of runs."""

import base64
import hashlib
import io
import random
import re
from collections import Counter

import pytest
from llm_helpers import rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seriesmill.llm import url_filter, warc

URLS = [
    "http://a.com/x", "https://example.com/en/1?q#f", "https://WWW.Example.COM/en/", "http://m.example.com/en", "http://net/es/",
    "http://x.net/fr/9", "http://x.net/FR/9", "http://com", "http://com/", "http://notcom/", "no scheme", "", None, "x://y://z/a",
    "http://ads.org/1", "http://my-ads.org:80/1", "http://badads.org/1", "http://u@h.net/es/#a", "http://a.com?x=/y", "http://É.com/é",
]


def judged(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [
        (h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    rule, verdict = max(fits, key=lambda f: len(f[0])) if fits else (None, None)
    listed = bool(set(re.split(r"[.-]", host)) & set(url_filter.LISTED_WORDS))
    return host, path, rule, verdict or ("block" if listed else "allow"), listed


def test_rules_and_list(spark):
    rows = [(k, u, "x") for k, u in enumerate(URLS * 2)] + [(None, URLS[0], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string").withColumn("key", F.lit(1))
    found = url_filter.judge_urls(pages, url_filter.host_has_word())
    expected = [(k, *judged(u)) for k, u, _ in rows]
    assert Counter(tuple(r) for r in found.collect()) == Counter(expected)
    assert url_filter.judge_urls(pages.where("false"), url_filter.host_has_word()).count() == 0


@pytest.mark.parametrize("block_keys", [1 << 24, 300])
def test_cascade_is_exact(spark, block_keys):
    """Every key of the universe, in one block and in several; no mistake in either direction."""
    keys = spark.range(20_000).select(
        F.concat(F.lit("key-"), F.col("id") % 12_000).alias("key"), (F.xxhash64(F.col("id") % 12_000) % 11 == 0).alias("listed")
    )
    cascade = url_filter.build_cascade(keys, block_keys)
    assert len(cascade.blocks) == (1 if block_keys > 300 else 4) or block_keys == 300 and len(cascade.blocks) > 2
    assert all(len(b.value) >= 2 for b in cascade.blocks)
    asked = cascade.add_listed(keys, F.col("key"), "found")
    assert asked.where("found <> listed").count() == 0 and asked.count() == 20_000
    size = sum(8 * len(bits) for b in cascade.blocks for _, bits in b.value)
    assert size < 20_000


def test_cascade_without_listed_keys(spark):
    keys = spark.createDataFrame([("a", False), (None, None)], "key string, listed boolean")
    asked = url_filter.build_cascade(keys).add_listed(keys, F.col("key"), "found")
    assert rows_of(asked, "found") == [(False,), (False,)]
    only = spark.createDataFrame([("a", True), (None, True)], "key string, listed boolean")
    assert rows_of(url_filter.build_cascade(only).add_listed(only, F.col("key"), "found"), "found") == [(True,), (True,)]


def brute_archives(rows, least=0):
    first = {}
    for page_id, _, html in rows:
        payload = (html or "").encode()
        if len(payload) >= least and page_id is not None:
            first[payload] = min(first.get(payload, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        revisit = payload in first and page_id != first[payload]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page_id, len(payload), digest, "revisit" if revisit else "response", first[payload] if revisit else None))
    return Counter(out)


@pytest.mark.parametrize("least", [0, 3])
def test_archives(spark, monkeypatch, least):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    rng = random.Random(1)
    rows = [(k, f"http://h{rng.randrange(9)}.org/{rng.randrange(9)}", rng.choice(["same", "", None, "é\r\n\r\nx", f"own {k}", "x" * 40_000, "aé"])) for k in range(300)]
    rows += [(None, "http://a b.org/\r\nX: 1", "same"), (7000, None, "z"), (7000, None, "z"), (7001, "http://[bad", "\0")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, position string").repartition(5)
    found = warc.archive_and_index(pages, least)
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(tuple(r) for r in found.select(*names).collect()) == brute_archives(rows, least)
    order = found.orderBy("position").collect()
    assert [r.position for r in order] == list(range(len(rows)))
    keys = [(r.url_key, r.captured_at, -1 if r.page_id is None else r.page_id) for r in order]
    assert keys == sorted(keys)


def test_one_hot_url_is_merged_over_many_ranges(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("http://hot.org/").alias("url"), F.lit("p").alias("html"))
    index = spark.createDataFrame(
        [(f"run{k % 7}", k // 7, "key", "2024", k, None, 1, "d", "response", None) for k in range(3000)], warc._INDEX
    )
    merged = warc.merged_index(index.repartition(6), range_rows=200)
    assert [r.page_id for r in merged.orderBy("position").collect()] == list(range(3000))
    assert pages.count() == 3000


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_and_index(pages).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 50)), max_size=9))
def test_loser_tree(runs):
    merged = list(warc.LoserTree([iter(sorted(r)) for r in runs], lambda x: x))
    assert merged == sorted(x for r in runs for x in r)


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=300), st.text(max_size=30), st.booleans())
def test_record_round_trip(payload, url, revisit):
    raw = warc.record(5, url, warc._EPOCH, payload, 3 if revisit else None, revisit)
    (found,) = warc.read_records(io.BytesIO(raw))
    assert found["payload_bytes"] == len(payload) and found["payload_digest"] == warc.payload_digest(payload)
    assert (found["page_id"], found["refers_to"]) == (5, 3 if revisit else None)


def test_damaged_payload_is_found():
    raw = warc.record(5, "http://a.org/", warc._EPOCH, b"payload", None, False)
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(raw.replace(b"payload\r\n", b"pAyload\r\n"))))
