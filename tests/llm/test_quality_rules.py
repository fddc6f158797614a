import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeops.llm.quality import Rules, binomial_tail, certified_cutoffs, keep_good, quality_report

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(hit),
    )


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (8, 0, 0), (8, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")


def test_counts_equal_plain_python(spark, hard_docs, labels, clashing):
    extra = spark.createDataFrame(
        [(20, "a b c a b c x", "en", None, None), (21, "## a$b\n## a$b\n\n \n<|x|>", "en", None, None)], hard_docs.schema
    )
    docs = hard_docs.union(extra)
    got = quality_report(clashing(docs), labels).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = sorted(((r.doc_id or -1), *(r[n] for n in names), r.base_failed) for r in got)
    want = []
    for row in docs.collect():
        c = counts(row.text)
        want.append(((row.doc_id or -1), *c, c[0] < 50 or 100 * c[4] > 50 * c[0]))
    assert found == sorted(want)
    assert all(not (r.base_failed and r.kept) for r in got)


def test_binomial_tail(spark):
    cases = [(0, 10), (3, 10), (10, 10), (20, 1000), (49, 1000), (5000, 100_000), (0, 1), (4900, 100_000)]
    rows = spark.createDataFrame(cases, "k long, n long").select("k", "n", binomial_tail(F.col("k"), F.col("n"), 0.05).alias("p"))
    for k, n, p in rows.collect():
        exact = math.fsum(
            math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(0.05) + (n - i) * math.log(0.95))
            for i in range(k + 1)
        )
        assert p == pytest.approx(min(1, exact), rel=1e-6, abs=1e-300)


def test_a_cutoff_needs_evidence_and_keeps_the_risk(spark):
    good = [("en", i / 1000, True) for i in range(400)]
    bad = [("en", 0.9, False)] * 50
    few = [("de", 0.0, True)] * 20 + [("de", 0.9, False)] * 5
    other = [(None, 0.1, True)] * 500 + [(None, 0.8, False)] + [(None, 0.5, None)] * 9
    labelled = spark.createDataFrame(good + bad + few + other, "stratum string, badness double, good boolean")
    found = {r.stratum: r.cutoff for r in certified_cutoffs(labelled, Rules()).collect()}
    assert "de" not in found
    assert 0.4 <= found["en"] < 0.9 and 0.1 <= found[None] < 0.8
    assert certified_cutoffs(labelled.limit(0), Rules()).count() == 0


def test_keep_good_returns_the_rows_as_they_were(spark, hard_docs, no_docs, labels, clashing):
    docs = clashing(hard_docs)
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 2, 3, 8, None, 10])
    assert keep_good(no_docs, labels).count() == 0 and keep_good(hard_docs, labels.limit(0)).count() == 7


def test_repeats_in_a_text_of_over_a_million_words(spark, hard_docs, labels):
    """Few words make many repeats; numbers make none but those put in."""
    numbers = [str(i) for i in range(1_100_000)]
    numbers[500_000:500_003] = numbers[7:10]
    texts = [" ".join(numbers), "a b " * 60_000 + "c"]
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in enumerate(texts)], hard_docs.schema)
    got = {r.doc_id: r.n_repeat_words for r in quality_report(docs, labels).collect()}
    assert got == {0: 6, 1: 120_000}


def plain_badness(text):
    """The greatest of four shares, from the same counts."""
    text, (n, chars, symbols, repeated, _) = text or "", counts(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]

    def share(part, whole):
        return min(1.0, part / whole) if whole else 0.0

    capitals = sum("A" <= c <= "Z" for c in text)
    return max(share(symbols, n), share(text.count("!"), n), share(capitals, chars), share(repeated, len(lines)) / 2)


def plain_good(docs, labels, rules=Rules()):
    """Ids of the documents (id, lang, text) that the rules keep, worked out one by one."""
    failed, badness = {}, {}
    for key, _, text in docs:
        c = counts(text)
        failed[key] = c[0] < rules.min_words or 100 * c[4] > rules.max_repeat_pct * c[0]
        badness[key] = plain_badness(text)
    lang = {key: name for key, name, _ in docs}
    good = {}
    for key, quality in labels:
        if quality is not None and key in lang and not failed[key]:
            good[key] = good.get(key, True) and quality == 1
    strata = {lang[key] for key in good}
    cutoffs = {}
    for stratum in strata:
        mine = [badness[k] for k, g in good.items() if g and lang[k] == stratum]
        bad = [badness[k] for k, g in good.items() if not g and lang[k] == stratum]
        best = (0.0, None)
        for cutoff in rules.cutoffs:
            lost, caught = sum(b > cutoff for b in mine), sum(b > cutoff for b in bad)
            n = len(mine)
            tail = sum(math.comb(n, i) * rules.risk**i * (1 - rules.risk) ** (n - i) for i in range(lost + 1))
            if min(1.0, tail) > rules.delta / len(strata):
                break
            gain = (caught / len(bad) if bad else 0.0) - (lost / n if n else 0.0)
            if gain > best[0]:  # the loosest of equals comes first
                best = (gain, cutoff)
        if best[1] is not None:
            cutoffs[stratum] = best[1]
    return [key for key, name, _ in docs if not failed[key] and badness[key] <= cutoffs.get(name, 1.0)]


def test_verdicts_equal_plain_python(spark, hard_docs, prose):
    """Strata with and without enough labels; the bad ones shout, and so do a few good ones."""
    rows, labels = [], []
    for i in range(900):
        lang, good = ("en", "de", None)[i % 3], i % 9 > 1
        words = prose(2000 + i, 60).split()
        loud = 30 + i % 20 if not good else 8 if i % 50 == 2 else i % 3
        rows.append((i, " ".join(w.upper() if j < loud else w for j, w in enumerate(words)), lang, None, None))
        if lang != "de" or i < 60:
            labels.append((i, int(good), 0))
    docs = spark.createDataFrame(rows, hard_docs.schema)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = plain_good([(r[0], r[2], r[1]) for r in rows], [(r[0], r[1]) for r in labels])
    assert 0 < len(want) < 900
    assert sorted(r.doc_id for r in quality_report(docs, marks).filter("kept").collect()) == want
    assert sorted(r.doc_id for r in keep_good(docs, marks).collect()) == want
