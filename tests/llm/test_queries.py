"""Every registered corpus query against its checking SQL, on whole small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from linespan.llm import byte_bpe, language_id, mixing, sharding
from linespan.llm.common import settle
from linespan.llm.queries import ORACLE, QUERIES, VOCABULARY
from verification.compare import compare, connect


@pytest.fixture(scope="module")
def connection(small):
    return connect(small)


def test_all_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_checking_sql(spark, connection, small, name):
    ok, note = compare(spark, connection, small, name, QUERIES[name], ORACLE[name])
    assert ok, note


def reference_encoding():
    ranks = byte_bpe.read_ranks(VOCABULARY)
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_bpe_query_equals_reference_library(spark, small):
    encoding = reference_encoding()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op7_byte_bpe"](spark, small).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = encoding.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_shards_are_gapless_and_balanced(spark, small):
    rows = QUERIES["op1_differencing_shards"](spark, small).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    loads, of_text = np.zeros(16, int), {}
    for row in rows:
        assert row["size"] == len((texts[row["doc_id"]] or "").encode()) + 1
        loads[row["shard"]] += row["size"]
        assert of_text.setdefault(texts[row["doc_id"]] or "", row["shard"]) == row["shard"]
    for shard in range(16):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert loads.max() - loads.min() <= 0.01 * loads.mean()


def test_language_query_holds_out_a_quarter(spark, small):
    rows = QUERIES["op8_ftrl_language_id"](spark, "/root/testdata/sf0.01").collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert 0.15 < len(held) / len(rows) < 0.35
    right = sum(r["lang_pred"] == truth[r["doc_id"]] for r in held)
    assert right / len(held) > 0.97


def test_pipeline_equals_its_operators_by_brute_force(spark, small):
    """Stages 1 and 2 by plain Python; 4 by its own quotas; 5 by the reference library."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    verdicts = {r["doc_id"]: r["kept"] for r in QUERIES["op9_line_frequency_quality"](spark, small).collect()}
    passed = corpus_pipeline.quality(spark, docs, small)
    assert passed.columns == docs.columns
    kept = passed.collect()
    assert {r["doc_id"] for r in kept} == {k for k, v in verdicts.items() if v}
    best = {}
    for r in kept:
        key = "".join(c for c in r["text"] if c not in " \t\n\x0b\f\r")
        rank = (-len(r["text"]), r["doc_id"])
        best[key] = min(best.get(key, rank), rank)
    unique = corpus_pipeline.exact(spark, passed, small).collect()
    assert sorted(r["doc_id"] for r in unique) == sorted(doc_id for _, doc_id in best.values())

    def shingles(text):
        w = text.encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {r["doc_id"]: shingles(r["text"]) for r in unique}
    component = {d: d for d in sets}

    def find(x):
        while component[x] != x:
            x = component[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if min(len(sets[a]), len(sets[b])) < 0.8 * max(len(sets[a]), len(sets[b])):
                continue
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                component[max(x, y)] = min(x, y)
    groups = {find(d) for d in sets}
    rows = corpus_pipeline.run(spark, small).collect()
    assert {r["doc_id"] for r in rows} <= groups
    encoding = reference_encoding()
    texts = {r["doc_id"]: r["text"] for r in unique}
    for row in rows:
        assert list(row["ids"]) == encoding.encode_ordinary(texts[row["doc_id"]])
    near = corpus_pipeline.near(spark, spark.createDataFrame(unique, docs.schema), small)
    assert {r["doc_id"] for r in near.collect()} == groups


def mixed_by_hand(rows):
    """Copies of each document by plain Python: targets, quotas by highest quotients, seeded runs, whole documents."""
    white = re.compile("[ \t\n\x0b\f\r]+")
    first = lambda text: int(hashlib.md5(text.encode()).hexdigest()[:8], 16)
    measured = [
        (
            hashlib.md5(f"{mixing.SEED}:{r['doc_id']}:{r['text'] or ''}".encode()).hexdigest(),
            len([w for w in white.split(r["text"] or "") if w]), r["doc_id"], r["source"],
        )
        for r in rows
    ]
    filled, sizes, streams = Counter(), Counter(), defaultdict(list)
    for _, size, _, source in measured:
        sizes[source] += size
        filled[source] += size > 0
    for draw, size, doc_id, source in measured:
        if size:
            shards = max(1, -(-filled[source] // mixing.SHARD_ROWS))
            streams[(int(draw[:8], 16) % shards, source)].append((draw, size, doc_id))
    place = {source: i for i, source in enumerate(sorted(sizes))}
    weight = {source: mixing.WEIGHTS[i % len(mixing.WEIGHTS)] for source, i in place.items()}
    # A target is full at its cap; what is left is shared by weight again until no other target passes its cap.
    cap = {source: size * mixing.REPEATS for source, size in sizes.items()}
    budget, full = sum(sizes.values()) * mixing.BUDGET_PERCENT / 100, set()
    while True:
        left = set(sizes) - full
        level = (budget - sum(cap[s] for s in full)) / sum(weight[s] for s in left) if left else 0
        over = {s for s in left if cap[s] <= weight[s] * level}
        if not over:
            break
        full |= over
    target = {s: cap[s] if s in full else weight[s] * level for s in sizes}

    def highest(share, seats):
        """Seats by highest quotients; of equal ones the first child's."""
        quota = Counter()
        for _ in range(seats):
            quota[max(sorted(share), key=lambda c: share[c] / (2 * quota[c] + 1))] += 1
        return quota

    share = {place[s]: target[s] / mixing.BLOCK_WORDS for s in sizes if target[s] > 0}
    blocks = highest(share, (sum(int(x * 1000) for x in share.values()) + 500) // 1000)
    copies = Counter()
    for s in sizes:
        supply = {k: sum(size for _, size, _ in d) for (k, t), d in streams.items() if t == s}
        own = blocks[place[s]]
        quota = highest({k: own * n / sizes[s] for k, n in supply.items()}, own if supply else 0)
        for k, n in supply.items():
            passes, run = divmod(min(quota[k] * mixing.BLOCK_WORDS, n * mixing.REPEATS), n)
            start = first(f"{mixing.SEED}:s{s}:{k}") % -(-n // mixing.BLOCK_WORDS) * mixing.BLOCK_WORDS
            inside = np.full(n, passes)
            inside[np.arange(start, start + run) % n] += 1
            at = 0
            for _, size, doc_id in sorted(streams[(k, s)]):
                taken = int(inside[at : at + size].sum())
                copies[doc_id] += (2 * taken + size) // (2 * size)
                at += size
    return +copies


def test_pipeline_mixes_as_often_as_by_hand(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet")
    for _, work in corpus_pipeline.STAGES[:3]:
        rows = settle(work(spark, rows, small), "mix-test")
    want = mixed_by_hand(rows.collect())
    assert want and max(want.values()) > 1
    assert Counter(r["doc_id"] for r in corpus_pipeline.run(spark, small).collect()) == want


def test_stages_leave_other_results_alone(spark, small):
    """One stage over two corpora, then both are read; folders of results nobody holds are deleted later."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    even, odd = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    first = corpus_pipeline.quality(spark, even, small)
    second = corpus_pipeline.quality(spark, odd, small)
    third = corpus_pipeline.exact(spark, second, small)
    assert {r["doc_id"] % 2 for r in first.collect()} == {0}
    assert {r["doc_id"] for r in third.collect()} <= {r["doc_id"] for r in second.collect()}
    assert not corpus_pipeline._released
    del first
    left = list(corpus_pipeline._released)
    assert left and all(spark.read.parquet(f).schema for f in left)
    again = corpus_pipeline.exact(spark, second, small)
    assert not corpus_pipeline._released and second.count() and third.count() == again.count()
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(left[0])
    assert not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def differenced_by_hand(sizes, shards):
    """Loads after differencing, by plain lists: always the two partial partitions of largest spread."""
    parts = [(size, -k, [size] + [0] * (shards - 1)) for k, size in enumerate(sorted(sizes, reverse=True))]
    number = len(parts)
    while len(parts) > 1:
        parts.sort()
        (_, _, first), (_, _, second) = parts.pop(), parts.pop()
        loads = sorted((a + b for a, b in zip(first, reversed(second), strict=True)), reverse=True)
        parts.append((loads[0] - loads[-1], -number, loads))
        number += 1
    return parts[0][2]


def test_shards_equal_differencing_by_hand(spark, small):
    """Heavy groups and packs from the texts alone; loads, checksums and whole groups against brute force."""
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op1_differencing_shards"](spark, small).collect()
    total, groups, items = sum(len(t) + 1 for t in texts.values()), Counter(), Counter()
    for text in texts.values():
        groups[hashlib.md5(text).hexdigest()] += len(text) + 1
    for group, size in groups.items():
        heavy = size * sharding.PACKS >= total
        items[group if heavy else xxhash.xxh64_intdigest(group.encode(), 42) % sharding.PACKS] += size
    loads = Counter()
    for r in rows:
        loads[r["shard"]] += r["size"]
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]])
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    want = differenced_by_hand(items.values(), sharding.SHARDS)
    assert max(loads.values()) - min(loads.values()) <= max(want) - min(want) + 1
    assert sorted(loads.values()) == sorted(want)


def test_language_depends_on_the_text_alone(spark, small):
    """Other ids, languages and sources, repeated rows and rows in another order leave predictions unchanged."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    training = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("label"))
    model = language_id.trained(training, per_language=100)
    plain = language_id.predict(docs, model, key=["doc_id"], text=F.col("text")).collect()
    moved = docs.unionByName(docs.limit(50)).select(
        (F.col("doc_id") * -7 + 13).alias("doc_id"), "text", F.lit("xx").alias("lang"), F.lit(None).cast("string").alias("source"),
    ).repartition(5)
    other = language_id.predict(moved, model, key=["doc_id"], text=F.col("text")).collect()
    assert len(other) == len(plain) + 50
    want = {r["doc_id"] * -7 + 13: (r["lang_pred"], r["score"]) for r in plain}
    assert all(want[r["doc_id"]][0] == r["lang_pred"] and abs(want[r["doc_id"]][1] - r["score"]) < 1e-12 for r in other)
