"""Which record of equal payloads is the response, over a table, by brute force."""

import base64
import hashlib
import random

from eventflow.llm import queries as Q


def test_op4_against_brute_force(spark, tmp_path):
    rng = random.Random(12)
    payloads = [None, "", "a", "é" * 40, "<p>x</p>", "y" * 70_000, *[f"page {i}" for i in range(6)]]
    ids = rng.sample(range(1000), 150)
    rows = [(i, f"http://h{i % 3}/{i}", rng.choice(payloads)) for i in ids]
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5).write.parquet(f"{tmp_path}/pages.parquet")
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        first[data] = min(first.get(data, i), i)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((i, len(data), digest, "response" if first[data] == i else "revisit", None if first[data] == i else first[data]))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
           for r in Q.op4_warc_zstd(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)
