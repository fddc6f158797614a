import random

import numpy as np
import pytest

from lakeops.llm.components import components
from lakeops.llm.minhash import duplicate_report, keep_one, shingles, signature

import xxhash


def plain_sets(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    width = min(5, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def plain_groups(rows):
    """The smallest key of each row's group, by comparing all pairs."""
    sets = [plain_sets(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and both * 100 >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    return [(key, len(sets[i]), least.get(root(i))) for i, (key, _) in enumerate(rows)]


@pytest.fixture(scope="module")
def copies(prose):
    """Near copies of a few texts at all distances around the threshold, so that chains form."""
    numbers, rows = random.Random(11), []
    for base in range(6):
        words = prose(300 + base, 150).split()
        for _ in range(60):
            near = list(words)
            for _ in range(numbers.randint(0, 9)):
                near[numbers.randrange(len(near))] = f"w{numbers.randrange(10**6)}"
            rows.append(" ".join(near))
    numbers.shuffle(rows)
    return list(enumerate(rows))


def test_groups_equal_all_pairs(spark, copies, hard_docs, clashing):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in copies], hard_docs.schema)
    docs = docs.union(hard_docs.selectExpr("doc_id + 5000 as doc_id", "text", "lang", "source", "n_chars"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain_groups(rows)
    got = duplicate_report(clashing(docs)).collect()
    order = lambda rows: sorted(rows, key=repr)
    assert order((r.doc_id, r.n_shingles, r.component_id) for r in got) == order(want)
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in got)
    kept = keep_one(clashing(docs))
    assert kept.columns == clashing(docs).columns
    ids = [r.doc_id for r in kept.collect()]
    groups = {c for _, n, c in want if n and c is not None}
    alone = [k for k, n, c in want if not n or c is None]
    assert order(ids) == order([*groups, *alone])


def test_empty(spark, no_docs, hard_docs):
    assert duplicate_report(no_docs).count() == 0 and keep_one(no_docs).count() == 0
    blank = hard_docs.filter("doc_id in (4, 5, 6)")
    assert [r.component_id for r in duplicate_report(blank).orderBy("doc_id").collect()] == [4, 5, 6]
    assert keep_one(blank).count() == 3


def test_one_large_group_of_copies(spark, prose, hard_docs):
    text = prose(77, 100)
    rows = [(i, text, None, None, None) for i in range(3000)] + [(9000, prose(78, 100), None, None, None)]
    got = duplicate_report(spark.createDataFrame(rows, hard_docs.schema)).collect()
    assert sum(r.kept for r in got) == 2 and {r.component_id for r in got} == {0, 9000}


def test_signatures_estimate_similarity():
    words = {}

    class Memo(dict):
        def __missing__(self, word):
            self[word] = xxhash.xxh64_intdigest(word)
            return self[word]

    words = Memo()
    rng = np.random.default_rng(4)
    a = np.unique(rng.integers(0, 1 << 63, 900, dtype=np.uint64))
    for share in (0.5, 0.75, 0.9):
        same = int(len(a) * 2 * share / (1 + share))
        b = np.concatenate([a[:same], np.unique(rng.integers(0, 1 << 63, len(a) - same, dtype=np.uint64))])
        agree = np.mean([signature(a + np.uint64(k)) == signature(b + np.uint64(k)) for k in range(20)])
        assert agree == pytest.approx(share, abs=0.05)
    assert len(shingles("A b  c\td E f", words)) == 2 and len(shingles("é É", words)) == 1 and len(shingles(None, words)) == 0


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(200)]
    hub = [(1000, i) for i in range(1001, 1400)] + [(1399, 999)]
    links = spark.createDataFrame(chain + hub + [(5000, 4999), (5000, 5001)], "u long, v long")
    got = {r.node: r.component for r in components(links.repartition(7)).collect()}
    assert {got[i] for i in range(201)} == {0} and {got[i] for i in range(999, 1400)} == {999}
    assert got[5000] == got[5001] == 4999 and len(got) == 201 + 401 + 3
    assert components(links.limit(0)).count() == 0


def test_a_bucket_of_texts_around_the_threshold(spark, prose):
    """Hundreds of variants of one text share buckets; some pairs are links, many are just below, a few hang alone."""
    letters, base = random.Random(12), prose(77, 120).split()
    texts = []
    for i in range(500):
        words = list(base)
        for place in letters.sample(range(120), letters.choice((1, 2, 2, 3, 4, 5))):
            words[place] = f"w{i}x{place}"
        texts.append((i, " ".join(words)))
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    want = {key: least for key, _, least in plain_groups(texts)}
    got = {r.doc_id: r.component_id for r in duplicate_report(docs).collect()}
    assert got == want and 1 < len(set(want.values())) < 500
