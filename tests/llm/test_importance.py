"""Resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lakeops.llm.batches import chunks, large_texts
from lakeops.llm.importance import Runs, _shift, numbered, resample

BUCKETS = 97


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def features(text):
    words = words_of(text)
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain(docs, target, buckets, share=5, least=20, seed=42):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for text in texts for f in features(text)) for texts in ([d[1] for d in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)
    }
    rows = []
    for key, text in docs:
        runs = features(text)
        weight = sum(gain[bucket(f)] for f in runs)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append([key, len(runs), weight, score, None, len(words_of(text)) >= least])
    fit = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(fit[: share * len(fit) // 100], 1):
        row[4] = place
    return sorted(map(repr, (tuple(r[:5]) for r in rows)))


def got(rows):
    return sorted(map(repr, ((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in rows.collect())))


def test_shift_extends_a_crc():
    for length in (0, 1, 2, 7, 1000):
        table, end = _shift(length), bytes(range(1, 256))[:length] * 1 if length < 256 else b"q" * length
        for start in (b"", b"a", b"some words"):
            crc = zlib.crc32(start)
            moved = 0
            for place in range(4):
                moved ^= int(table[place, crc >> 8 * place & 255])
            assert moved ^ zlib.crc32(end) == zlib.crc32(start + end)


def test_runs_equal_plain_ones():
    letters = random.Random(8)
    texts = [None, "", " .. ", "One", "two  WORDS", "\x00a\x7fb É日本 ſ 1-2", "x" * 3000 + " y"]
    texts += ["".join(letters.choices("ab. É", k=letters.randint(0, 60))) for _ in range(200)]
    gains = np.array([letters.randint(-99, 99) for _ in range(BUCKETS)])
    runs = Runs(pa.array([t or "" for t in texts], pa.large_string()), BUCKETS)
    want = Counter(zlib.crc32(f.encode()) % BUCKETS for t in texts for f in features(t))
    assert runs.counts(BUCKETS).tolist() == [want[b] for b in range(BUCKETS)]
    words, n, weights = runs.per_text(gains)
    assert words.tolist() == [len(words_of(t)) for t in texts] and n.tolist() == [len(features(t)) for t in texts]
    assert weights.tolist() == [sum(int(gains[zlib.crc32(f.encode()) % BUCKETS]) for f in features(t)) for t in texts]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
@pytest.mark.parametrize("nulls", [0, 1])
def test_runs_of_every_slice_of_a_batch(kind, nulls, monkeypatch):
    monkeypatch.setattr("lakeops.llm.batches.CHUNK_BYTES", 300)
    texts = [f"Text {i} É " * (i % 9) for i in range(200)] + [None] * nulls
    parts = list(chunks(pa.record_batch([pa.array(texts, kind)], ["text"]), 0))
    assert len(parts) > 20
    for part in parts:
        runs, some = Runs(large_texts(part.column(0)), BUCKETS), part.column(0).to_pylist()
        want = Counter(zlib.crc32(f.encode()) % BUCKETS for t in some for f in features(t))
        assert runs.counts(BUCKETS).tolist() == [want[b] for b in range(BUCKETS)]


@pytest.mark.parametrize("share", [5, 40, 100])
def test_resampling_equals_plain_python(spark, hard_docs, clashing, prose, share):
    more = [(100 + i, prose(i, 15 + i), None, None, None) for i in range(40)]
    docs = clashing(hard_docs.union(spark.createDataFrame(more, hard_docs.schema)))
    target = spark.createDataFrame([(1, prose(3, 50)), (2, None), (3, prose(20, 30))], "item_id long, text string")
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], BUCKETS, share)
    # Copies of a row that share an id and a score take any of their places.
    assert got(resample(docs, target, share, buckets=BUCKETS)) == want


def test_empty_tables(spark, hard_docs, no_docs):
    target = spark.createDataFrame([], "item_id long, text string")
    assert resample(no_docs, target).count() == 0
    want = plain([(r.doc_id, r.text) for r in hard_docs.collect()], [], BUCKETS)
    assert got(resample(hard_docs, target, buckets=BUCKETS)) == want


def test_places_in_a_total_order(spark):
    from pyspark.sql import functions as F

    values = random.Random(2).choices(range(300), k=2000)
    rows = numbered(spark.createDataFrame([(v,) for v in values], "v long"), [F.col("v").desc()], "place").collect()
    assert sorted((r.place, r.v) for r in rows) == list(enumerate(sorted(values, reverse=True), 1))
