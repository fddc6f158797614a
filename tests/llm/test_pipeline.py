"""The stages one after another against plain Python, and the registered queries on the smallest tables."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lakeops.llm.queries import ORACLES, QUERIES
from test_decontaminate import brute
from test_minhash import plain_groups
from test_quality_rules import plain_good
from test_toxicity import plain_scores

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_stages_equal_plain_python(spark):
    docs, labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    rows, marks = [tuple(r) for r in docs.select("doc_id", "lang", "text").collect()], labels.collect()
    texts = {key: text for key, _, text in rows}
    good = plain_good(rows, [(r.doc_id, r.quality) for r in marks])
    left = set(good)
    toxic = {}
    for r in marks:
        if r.doc_id in left and r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            toxic[r.doc_id] = toxic.get(r.doc_id, False) or r.toxic == 1
    scores = plain_scores([(toxic[k], texts[k] or "") for k in sorted(toxic)], [texts[k] for k in good])
    clean = [k for k, score in zip(good, scores) if score < 0.3]
    one = [key for key, size, least in plain_groups([(i, texts[i]) for i in sorted(clean)]) if not size or key == least]
    items = [tuple(r) for r in bench.collect()]
    kept = [i for i in one if not brute(texts[i], items)[4]]
    assert 0 < len(kept) < len(one) < len(clean) <= len(good) < docs.count()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i in kept:
        ids = [*tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[start : start + 2048], "<u4")
            want.append((i, piece, start, len(part), zlib.crc32(part.tobytes())))
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        ends = [0, *[offset + length for offset, length in sorted(parts)]]
        assert [offset for offset, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048
    # Best-fit needs few more sequences than there are tokens for; no two of them fit one.
    sizes = sorted(sum(length for _, length in parts) for parts in bins.values())
    assert len(sizes) == 1 or sizes[0] + sizes[1] > 2048


def canonical(table):
    names = sorted(table.column_names)
    return names, sorted(map(repr, zip(*[table.column(n).to_pylist() for n in names])))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    assert canonical(QUERIES[name](spark, SF).toArrow()) == canonical(connection.execute(ORACLES[name]).to_arrow_table())


def test_all_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
