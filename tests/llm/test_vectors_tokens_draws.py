"""Whitening, token files and importance resampling against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.fs
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from linespan.llm import importance, token_files, whitening
from linespan.llm.queries import END_ID, QUERIES, WORD_TOKENIZER

# Whitening ---------------------------------------------------------------


def whitened_by_hand(vectors, scale=256, components=4):
    """key -> x, and n, sums, eigenvalues and eigenvectors of the fit list's covariance."""
    whole = {
        k: [math.floor(scale * float(np.float32(c))) for c in v]
        for k, v in vectors
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    }
    longest = max(map(len, whole.values()), default=0)
    whole = {k: (*v, *[0] * (longest - len(v))) for k, v in whole.items()}
    fit = np.array(sorted(set(whole.values())), float)
    centred = fit - fit.mean(0)
    values, basis = np.linalg.eigh(centred.T @ centred / len(fit))
    return whole, len(fit), [sum(map(int, c)) for c in fit.T], values[::-1], basis[:, ::-1]


def check_whitened(rows, vectors, count, loose=1e-7):
    whole, n, sums, values, basis = whitened_by_hand(vectors)
    assert Counter((r["key"], r["component"]) for r in rows) == Counter((k, c) for k in whole for c in range(1, count + 1))
    signs = {}
    for r in rows:
        x, c = whole[r["key"]], r["component"] - 1
        assert r["n"] == n
        assert int(r["deviation"]) == sum((n * v - s) ** 2 for v, s in zip(x, sums, strict=True))
        assert r["explained"] == pytest.approx(values[c] / values.sum(), rel=1e-9)
        assert r["identity_error"] < loose / 100
        want = (np.array(x) - np.array(sums) / n) @ basis[:, c] / math.sqrt(values[c])
        if abs(want) > 1e-3:
            signs.setdefault(c, set()).add(np.sign(want * r["whitened"]))
        assert abs(r["whitened"]) == pytest.approx(abs(want), abs=loose)
    assert all(len(s) == 1 for s in signs.values())


def whitened_rows(spark, vectors, **options):
    frame = spark.createDataFrame(
        [(k, v, "clash", "clash") for k, v in vectors], "key long, vec array<float>, rows string, block string"
    )
    return whitening.whitened(frame, key=["key"], vector=F.col("vec"), **options).collect()


def test_whitening_equals_eigenvectors(spark):
    rng = np.random.default_rng(5)
    drawn = rng.standard_normal((300, 12)) * np.linspace(3, 0.5, 12) + np.linspace(-40, 40, 12)
    vectors = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(drawn)]
    hot = vectors[7][1]
    vectors += [(1000 + i, hot) for i in range(200)]
    vectors += [(2000, None), (2001, [None] * 12), (2002, [float("nan")] * 12), (2003, [float("inf")] + [0.0] * 11)]
    vectors += [(2004, [1.5, -2.25]), (2005, []), (2006, [-0.0] * 12)]
    check_whitened(whitened_rows(spark, vectors), vectors, 4)


def test_whitening_finds_equal_eigenvalues(spark):
    """Every eigenvalue stands twice or more, so one chain cannot find the components."""
    vectors = [(2 * d + s, [float(x) for x in np.eye(6)[d] * (1 - 2 * s) * (2 if d < 3 else 1)]) for d in range(6) for s in (0, 1)]
    rows = whitened_rows(spark, vectors)
    whole, n, _, values, _ = whitened_by_hand(vectors)
    assert len(rows) == 48 and all(r["identity_error"] < 1e-9 for r in rows)
    explained = {r["component"]: r["explained"] for r in rows}
    assert [explained[c] for c in range(1, 5)] == pytest.approx((values / values.sum())[:4].tolist())
    white = np.zeros((12, 4))
    for r in rows:
        white[r["key"], r["component"] - 1] = r["whitened"]
    assert white.T @ white / n == pytest.approx(np.eye(4), abs=1e-9)


def test_whitening_of_flat_few_and_no_vectors(spark):
    assert whitened_rows(spark, []) == []
    assert whitened_rows(spark, [(1, None), (2, [])]) == []
    assert whitened_rows(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])]) == []
    line = [(i, [float(i), 2.0 * i, -float(i)]) for i in range(9)]
    check_whitened(whitened_rows(spark, line), line, 1)
    huge = [(i, [3e30 * (-1) ** i, float(i)]) for i in range(4)]
    got = whitened_rows(spark, huge)
    assert len({r["key"] for r in got}) == 4 and all(math.isfinite(r["whitened"]) for r in got)
    far = [(i, [1e9 + i * 1e6, float(i % 3)]) for i in range(50)]
    check_whitened(whitened_rows(spark, far), far, 2, loose=1e-6)


def test_whitening_query(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    rows = [r.asDict() | {"key": r["vec_id"]} for r in QUERIES["op11_lanczos_whitening"](spark, small).collect()]
    check_whitened(rows, [(r["vec_id"], r["embedding"]) for r in table], 4)


# Token files ---------------------------------------------------------------


def tokens_by_hand(texts):
    tokenizer = Tokenizer.from_file(WORD_TOKENIZER)
    tokenizer.encode_special_tokens = True
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, END_ID] for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 8, 9, 1000):
        ids = rng.integers(0, 2**32, n, dtype=np.uint64).astype("<u4")
        planes = [p if any(p) else b"" for p in token_files.split_planes(ids, kind)]
        assert token_files.join_planes(planes, n, kind).tolist() == ids.tolist()


def test_files_round_trip_and_ranges(tmp_path):
    rng = np.random.default_rng(2)
    files = pyarrow.fs.LocalFileSystem()
    docs = [(k if k % 5 else None, rng.integers(0, 49_000, int(rng.integers(0, 300_000 if k == 3 else 50)))) for k in range(200)]
    for kind in token_files.PLANES:
        path = str(tmp_path / kind)
        writer = token_files.PlaneWriter(files, path, kind)
        for identifier, ids in docs:
            writer.add(identifier, ids.astype("<u4"))
        every = np.concatenate([ids for _, ids in docs])
        assert writer.close() == (200, len(every))
        reader = token_files.PlaneReader(files, path)
        got = list(reader.each())
        assert [(i, x.tolist()) for i, _, x in got] == [(i, x.tolist()) for i, x in docs]
        assert [s for _, s, _ in got] == np.cumsum([0, *(len(x) for _, x in docs)])[:-1].tolist()
        for start, stop in ((0, 0), (0, 10), (65_530, 65_545), (len(every) - 3, len(every)), (100, 200_000)):
            assert reader.span(start, stop).tolist() == every[start:stop].tolist()
        content = bytearray((tmp_path / kind).read_bytes())
        (tmp_path / "cut").write_bytes(content[:-30])
        with pytest.raises(ValueError):
            token_files.PlaneReader(files, str(tmp_path / "cut"))


def test_ids_of_words_are_the_ids_of_the_text():
    rng = random.Random(4)
    parts = ["word", "Ünï", " ", "\n", "'s", "12", "…", "x" * 90, "é", "e\u0301", "\u0301", "\x1c", "\x0b", "\x85", "\u3000", "İ", "ΑΣ", "<|endoftext|>", "H\u0331", "Word.", "ÀB!?", "x).", "it's,", "\u017f", "ª", "µ", "×", "K"]
    text = "".join(rng.choice(parts) for _ in range(6000))
    encoder = token_files.Encoder(open(WORD_TOKENIZER, encoding="utf-8").read(), END_ID, True)
    texts = [None, text, "", text[:50], "a" * 2_000_000, text * 200, " ", "H\u0331.T"]
    got = list(encoder.encode(t if t is None else t.encode() for t in texts))
    assert [g.tolist() for g in got] == tokens_by_hand(texts)
    whole = token_files.Encoder(open(WORD_TOKENIZER, encoding="utf-8").read(), END_ID, False)
    assert [g.tolist() for g in whole.encode([text.encode(), None])] == tokens_by_hand([text, None])
    cut = list(token_files.pieces(text.encode(), 100))
    assert b"".join(cut) == text.encode() and len(cut) > 50
    assert [w for p in cut for w in p.split()] == text.encode().split()
    assert list(token_files.pieces(b"y" * 500, 100)) == [b"y" * 500]


def test_token_files_of_odd_rows(spark):
    rng = random.Random(9)
    long = " ".join(rng.choice(["Alpha", "beta's", "1234", "naïve", "<|endoftext|>"]) for _ in range(120_000))
    texts = [None, "", " \n", "a B c", long, "z" * 5_000, *["same text here"] * 60, *(f"text {i}" * i for i in range(40))]
    rows = [(k if k % 11 else None, t) for k, t in enumerate(texts)] + [(5, "a"), (5, "b"), (5, "b"), (None, None)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(
        [(*r, "clash", "clash", "clash") for r in rows], "doc_id long, text string, id string, row string, digest string"
    ).repartition(7)
    for planes in token_files.PLANES:
        files = token_files.write(
            frame, identifier=F.col("doc_id"), text=F.col("text"), tokenizer=WORD_TOKENIZER, end_id=END_ID,
            planes=planes, drops_white=True, file_ids=500,
        )
        assert files.count() > 5
        got = token_files.read(files).collect()
        by_hand = Counter((i, len(t), crc(t)) for (i, _), t in zip(rows, tokens_by_hand([t for _, t in rows]), strict=True))
        assert Counter((r["id"], r["n_tokens"], zlib.crc32(r["ids"])) for r in got) == by_hand
        ordered = sorted(got, key=lambda r: r["start"])
        ids = [r["id"] if r["id"] is not None else math.inf for r in ordered]
        assert ids == sorted(ids)
        at = 0
        for r in ordered:
            assert r["start"] == at
            at += r["n_tokens"]
    nothing = token_files.write(
        frame.limit(0), identifier=F.col("doc_id"), text=F.col("text"), tokenizer=WORD_TOKENIZER, end_id=END_ID
    )
    assert nothing.count() == 0 and token_files.read(nothing).collect() == []


def test_token_query(spark, small):
    table = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect())
    got = {r["doc_id"]: r for r in QUERIES["op12_plane_token_files"](spark, small).collect()}
    at = 0
    for (doc_id, _), ids in zip(table, tokens_by_hand([t for _, t in table]), strict=True):
        row = got[doc_id]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (at, len(ids), crc(ids))
        at += len(ids)
    assert len(got) == len(table)


# Importance resampling -------------------------------------------------------


def resampled_by_hand(rows, target, least=20, percent=10, buckets=10_000, longest=1):
    """(doc_id, n_features, weight, score, rank) of every row."""
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

    def lists(text):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = word.findall(lowered)
        runs = [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    found = [(i, *lists(t)) for i, t in rows]
    corpus = Counter(b for *_, bs in found for b in bs)
    aim = Counter(b for t in target for b in lists(t)[1])
    s, t = sum(corpus.values()), sum(aim.values())
    out = []
    for doc_id, n_words, bs in found:
        weight = sum(
            math.floor(1000 * math.log((aim[b] + 1) * (s + buckets) / ((corpus[b] + 1) * (t + buckets)))) for b in bs
        )
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(bs), weight, score, None, n_words])
    order = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(order[: len(order) * percent // 100], 1):
        row[4] = rank
    return Counter(tuple(r[:5]) for r in out)


def resampled(spark, rows, target, **options):
    frame = spark.createDataFrame(
        [(*r, "clash", 1, 2, "clash") for r in rows],
        "doc_id long, text string, key string, score int, row int, buckets string",
    ).repartition(5)
    aim = spark.createDataFrame([(t, "clash") for t in target], "text string, buckets string")
    got = importance.resample(
        frame, aim, key=["doc_id"], identifier=F.col("doc_id"), text=F.col("text"), target_text=F.col("text"), **options
    )
    names = ("doc_id", "n_features", "weight", "score", "rank")
    drawn = importance.selected_rows(frame, aim, **options)
    assert drawn.columns == frame.columns
    assert Counter(r["doc_id"] for r in drawn.collect()) == Counter(
        r["doc_id"] for r in got.where("rank IS NOT NULL").collect()
    )
    return Counter(tuple(r[n] for n in names) for r in got.collect())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(12)
    pool = ["Alpha", "beta", "GAMMA", "naïve", "ÀB", "x1", "42", "日本", "don't", "e-mail"]
    texts = [" ".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(150)]
    texts += [None, "", "!!! ---", "y" * 60_000, " ".join(rng.choices(pool, k=40_000))]
    rows = [(k * 7 % 1000 - 300, t) for k, t in enumerate(texts)]
    hot = " ".join(rng.choices(pool, k=30))
    rows += [(5000, hot)] * 40 + [(None, hot), (None, None), (2**62, hot), (-(2**63), hot)]
    return rows, ["alpha beta naïve", "42 42 日本", None, "", "GAMMA x1"]


@pytest.mark.parametrize(
    "options", [{}, {"percent": 37, "buckets": 50}, {"least_words": 0, "percent": 100, "longest_run": 2}, {"percent": 0}]
)
def test_resampling_equals_brute_force(spark, corpus, options):
    rows, target = corpus
    named = {"least_words": "least", "longest_run": "longest"}
    want = resampled_by_hand(rows, target, **{named.get(k, k): v for k, v in options.items()})
    assert resampled(spark, rows, target, **options) == want


def test_resampling_of_nothing(spark, corpus):
    assert resampled(spark, [], corpus[1]) == Counter()
    assert resampled(spark, corpus[0], []) == resampled_by_hand(corpus[0], [])


def test_bisection_finds_every_cutoff(spark):
    values = [-(2**62), -5, -5, 0, 1, 1, 1, 7, 2**40, 2**63 - 1]
    frame = spark.createDataFrame([(v,) for v in values], "value long")
    for wanted in range(1, len(values) + 1):
        cutoff, below = importance.count_at_most(frame, wanted)
        assert cutoff == sorted(values)[wanted - 1] and below == sum(v < cutoff for v in values)


def test_resampling_query(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    got = QUERIES["op13_importance_resample"](spark, small).collect()
    assert Counter(map(tuple, got)) == resampled_by_hand(rows, target)
