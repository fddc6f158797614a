import hashlib
import re

import corpus_pipeline
import duckdb

from lakeops.llm.decontaminate import contamination_report, drop_contaminated
from lakeops.llm.decontaminate_queries import SQL, op3_benchmark_decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, said in items:
        q = words(said)
        size = min(10, len(q))
        windows = {tuple(q[i : i + size]) for i in range(len(q) - size + 1)} if q else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(str(item))
    ids = ",".join(sorted(found))
    return len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


def test_equals_brute_force(spark, hard_docs, no_docs, prose, clashing):
    q = prose(50, 25)
    items = [(1, q), (2, q), (10, "Die Überprüfung, zwei!"), (11, ""), (12, None), (13, prose(1, 200)[30:200]), (14, "don t")]
    items += [(15, "日本"), (None, "two words")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [
        q,
        q.upper().replace(" ", " -- "),
        " ".join(q.split()[:9]),
        " ".join(q.split()[3:14] + ["x"] + q.split()[:10]),
        "die überprüfung zwei die ÜBERPRÜFUNG zwei",
        "die überprüfung zwei",
    ]
    docs = hard_docs.union(spark.createDataFrame([(100 + i, t, None, None, None) for i, t in enumerate(texts)], hard_docs.schema))
    real = [x for x in items if x[0] is not None]
    want = sorted(((r.doc_id or -1), *brute(r.text, real)) for r in docs.collect())
    for block in (1 << 20, 300):
        got = contamination_report(clashing(docs), bench, block).collect()
        assert sorted(((r.doc_id or -1), *tuple(r)[1:6]) for r in got) == want
        text = {r.doc_id: r.text for r in docs.collect()}
        for r in got:
            spans = [(text[r.doc_id] or "").encode()[a:b].decode() for a, b in r.spans] if r.doc_id else []
            assert sum(len(words(s)) for s in spans) == r.n_hit or r.doc_id is None
    clean = drop_contaminated(clashing(docs), bench)
    assert clean.columns == clashing(docs).columns
    assert sorted((r.doc_id or -1) for r in clean.collect()) == [w[0] for w in want if not w[5]]
    assert contamination_report(no_docs, bench).count() == 0
    assert contamination_report(docs, bench.limit(0)).filter("contaminated").count() == 0


def test_items_without_an_id_are_met(spark, hard_docs, prose, tmp_path):
    q = prose(60, 25)
    items = [(1, q), (None, prose(61, 12)), (None, "two words"), (None, q), (None, None), (3, "two words here")]
    texts = [q, prose(61, 12), "Two words, here!", f"x {prose(61, 12)} two words {q}", "two", "here two"]
    docs = hard_docs.filter("doc_id = 7").union(
        spark.createDataFrame([(100 + i, t, None, None, None) for i, t in enumerate(texts)], hard_docs.schema)
    )
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = sorted(con.sql(SQL).fetchall())
    for text, row in ((r.text, next(w for w in want if w[0] == r.doc_id)) for r in docs.collect()):
        n_words, n_hit, _, _, contaminated = brute(text, items)
        ids = sorted({str(i) for i, said in items if i is not None and brute(text, [(i, said)])[4]})
        unnamed = any(brute(text, [(i, said)])[4] for i, said in items if i is None)
        sha = hashlib.sha256(",".join(ids).encode()).hexdigest()
        assert row[1:] == (n_words, n_hit, len(ids) + unnamed, sha, contaminated)
    assert sorted(map(tuple, op3_benchmark_decontamination(spark, str(tmp_path)).collect())) == want
    for block in (1 << 20, 60):
        report = contamination_report(docs, bench, block, unnamed=True).drop("spans")
        assert sorted(map(tuple, report.collect())) == want
    kept = corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in kept) == [w[0] for w in want if not w[5]] == [104, 105]
