import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm.batches import BATCH_BYTES, small_batches
from lakeops.llm.packing import CHUNK_BYTES, BestFit, _chunks, packed
from lakeops.llm.token_store import PerfectHash, Shard, fetch, new_store_folder, read_store, write_index, write_store
from lakeops.llm.tokens import PieceIds, piece_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


TEXTS = [
    "", " ", "don't WON'T it's I'LL x'S 'tis ''S.'T...", "İstanbul ΣΑΣ ΑΣ. é é ́a a b c\x1cd\x0be\x85f",
    "<|endoftext|> a<|startoftext|>b", "日本語 テキスト 🙂👍🏽 a1b22 3,000.5", "x" * 5000, "A\r\nB\tC",
    "où…. ÉA. a.'s x.don't ×. é× ÷a b÷", "ǅ ß ẞ ſ K Å", "the.*** THE!! les&&& [x](y)", "a​b﻿c",
]


def test_pieces_give_the_ids_of_whole_texts(encode, prose):
    letters = random.Random(5)
    odd = ["".join(letters.choices("aé'. ,1Ü×́\n!日… s", k=40)) for _ in range(300)]
    texts = [*TEXTS, *odd, prose(9, 3000)]
    small = PieceIds(PATH, kept=50)
    for i in range(0, len(texts), 7):
        for text, ids in zip(texts[i : i + 7], small.encode(texts[i : i + 7])):
            assert np.frombuffer(ids, "<u4").tolist() == encode(text), text


def test_operators_give_the_ids_of_the_unmodified_file(spark, hard_docs):
    letters, plain = random.Random(6), Tokenizer.from_file(PATH)
    marks = "\u0331\u0308\u030a\u030c\u0307\u0338\u0301"
    odd = ["".join(letters.choices(f"aHTWYJIShtwyjÉé=<'. 1{marks}", k=40)) for _ in range(1000)]
    special = ["a <|endoftext|> b", "<|endoftext|>", "H\u0331<|startoftext|>x<|endoftext", "é<|ENDOFTEXT|>", "a<|ENDOFTEXT|>"]
    capitals = [f"{c}{m}amas x{c}{m}" for c in "HTWYJI" for m in marks]
    texts = [*TEXTS, *odd, *special, *capitals, "H\u0331amas"]
    want = [plain.encode(text, add_special_tokens=False).ids for text in texts]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in piece_ids(PATH).encode(texts)] == want
    assert want[-1] == [327, 136, 365, 15667] and [320, 49407, 321] in want
    few = [*special, *capitals]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(few)], hard_docs.schema)
    crcs = {
        i: zlib.crc32(np.array(plain.encode(t, add_special_tokens=False).ids + [2], "<u4").tobytes())
        for i, t in enumerate(few)
    }
    store = read_store(write_store(docs, PATH, new_store_folder(spark)))
    assert {r.doc_id: r.ids_crc32 for r in store.collect()} == crcs
    rows = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in packed(docs, PATH, with_ids=True).collect()}
    assert rows == {i: plain.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(few)}


def test_best_fit_equals_a_plain_search():
    numbers = random.Random(3)
    for limit in (1, 3, 50):
        fit, plain, opened = BestFit(100, limit), [], 0
        for _ in range(2000):
            length = numbers.randint(1, 100)
            bin_, offset = fit.place(length)
            roomy = [b for b in plain if b[1] >= length]
            if roomy:
                best = min(b[1] for b in roomy)
                assert [bin_, best] in plain and offset == 100 - best
                plain.remove([bin_, best])
                left = best - length
            else:
                if len(plain) >= limit:
                    fullest = min(b[1] for b in plain)
                    closed = [b for b in plain if b[1] == fullest][-1]
                    plain.remove(closed)
                assert bin_ == opened and offset == 0
                opened, left = opened + 1, 100 - length
            if left:
                plain.append([bin_, left])


def test_packing(spark, hard_docs, no_docs, clashing, encode):
    rows = packed(clashing(hard_docs), PATH, size=512, with_ids=True).collect()
    docs = {}
    for r in hard_docs.collect():
        docs.setdefault(r.doc_id, []).append(encode(r.text) + [0])
    found, bins = {}, {}
    for r in rows:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 and r.start == 512 * r.piece
        found.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for key, parts in docs.items():
        pieces = sorted((i, ids[i : i + 512]) for ids in parts for i in range(0, len(ids), 512))
        assert sorted(found[key]) == pieces
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512
    assert packed(no_docs, PATH).count() == 0


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 20_000, dtype=np.uint64))
    hashed = PerfectHash.build(keys)
    assert sorted(hashed.slots(keys).tolist()) == list(range(len(keys)))
    assert PerfectHash.build(keys[:0]).slots(keys[:3]).tolist() == [-1, -1, -1]


def test_store(spark, hard_docs, no_docs, clashing, encode):
    manifest = write_store(clashing(hard_docs), PATH, new_store_folder(spark))
    rows = sorted(read_store(manifest).collect(), key=lambda r: r.start)
    docs = sorted(hard_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [r.doc_id for r in rows] == [d.doc_id for d in docs]
    at, crcs = 0, {}
    for row in rows:
        assert row.start == at
        at += row.n_tokens
        crcs.setdefault(row.doc_id, []).append(row.ids_crc32)
    for d in docs:
        assert zlib.crc32(np.array(encode(d.text) + [2], "<u4").tobytes()) in crcs[d.doc_id]
    wanted = spark.createDataFrame([(2,), (7,), (2,), (777,), (None,)], "doc_id long")
    got = sorted((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in fetch(manifest, wanted).collect())
    two = encode(next(d.text for d in docs if d.doc_id == 2)) + [2]
    assert got == [(2, two), (2, two), (7, encode("Two words") + [2])]
    empty = write_store(no_docs, PATH, new_store_folder(spark))
    assert empty.count() == 0 and read_store(empty).count() == 0


def test_many_tasks_need_hardly_more_sequences_than_one(spark, prose):
    texts = [prose(i, 20 + i * i % 700) for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = {}
    for tasks in (1, 64):
        rows = packed(docs.repartition(tasks), PATH).collect()
        filled = {}
        for r in rows:
            filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts in filled.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 2048
        counts[tasks] = len(filled)
    least = -(-sum(r.length for r in rows) // 2048)
    assert counts[64] <= 1.01 * max(counts[1], least) + 1


def test_a_key_in_many_shards_and_keys_between_them(spark, prose):
    """A third of all rows have one key, so its rows fill several shards; they come back whole, and no others."""
    rows = [(7 if i % 3 == 0 else 10 * i, prose(i, 30)) for i in range(600)] + [(None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    manifest = write_store(docs, PATH, new_store_folder(spark))
    held = [r for r in manifest.collect() if r.first_key is not None and r.first_key <= 7 <= r.last_key]
    assert len(held) >= 2
    asked = [7, 10, 15, 40, 41, -3, 5990, 6000, None, 7]
    got = {}
    for r in fetch(manifest, spark.createDataFrame([(k,) for k in asked], "doc_id long")).collect():
        got.setdefault(r.doc_id, []).append(zlib.crc32(r.ids))
    plain = Tokenizer.from_file(PATH)
    want = {}
    for key, text in rows:
        if key in (7, 10, 40, 5990):
            ids = np.array(plain.encode(text, add_special_tokens=False).ids + [2], "<u4")
            want.setdefault(key, []).append(zlib.crc32(ids.tobytes()))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert len(read_store(manifest).collect()) == len(rows)


def test_a_look_up_reads_the_same_few_pages_of_any_index(tmp_path):
    reads = {}
    for count in (1_000, 300_000):
        keys = np.sort(np.random.default_rng(3).choice(1 << 40, count, replace=False)).astype(np.int64)
        index, ids = tmp_path / f"{count}.idx", tmp_path / f"{count}.ids"
        index.write_bytes(write_index(keys, np.ones(count, np.int64), 0, 2))
        ids.write_bytes(np.arange(count).astype("<u2").tobytes())
        shard = Shard(str(ids), str(index))
        place = count // 2
        assert shard.documents(int(keys[place]))[0].tolist() == [place & 0xFFFF] and shard.documents(int(keys[0]) - 1) == []
        reads[count] = sum(array.reads for array in shard.arrays.values())
        # The index is smaller than a table of its keys with their rows.
        assert index.stat().st_size < 28 * count
    assert reads[300_000] <= 12


def test_texts_are_decoded_in_small_parts():
    texts = ["é" * (CHUNK_BYTES // 4)] * 9 + [None, "x" * (3 * CHUNK_BYTES), ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    parts = list(_chunks(iter([batch, batch.slice(0, 0)])))
    assert [t for _, part in parts for t in part] == [t or "" for t in texts]
    assert [k for keys, _ in parts for k in keys.to_pylist()] == list(range(len(texts)))
    assert all(len(part) == 1 or sum(len(t.encode()) for t in part) <= CHUNK_BYTES for _, part in parts)


def test_batches_are_small_while_texts_are_packed(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["bytes"])

    texts = spark.range(0, 24, 1, 1).select(F.repeat(F.col("id").cast("string"), 1 << 19).alias("text"))
    before = spark.conf.get(BATCH_BYTES)
    with small_batches(spark, 2 << 20):
        inside = [row.bytes for row in texts.mapInArrow(sizes, "bytes long").collect()]
    assert max(inside) <= 4 << 20 and sum(inside) >= 34 << 19
    assert spark.conf.get(BATCH_BYTES) == before
    with pytest.raises(ValueError), small_batches(spark):
        raise ValueError
    assert spark.conf.get(BATCH_BYTES) == before
