import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm.toxicity import (
    Fit,
    Matcher,
    Model,
    drop_toxic,
    fitted,
    folded_words,
    strength,
    toxicity_report,
    without_accents,
)

BAD, STEM = ("vilewort", "grubnok"), "snarl"


@pytest.fixture(scope="module")
def corpus(spark, prose):
    """Every fifth document holds bad words or words with a bad stem; every seventh row repeats a text."""
    docs, labels = [], []
    for i in range(600):
        words = prose(1000 + (i if i % 7 else 3), 80).split()
        toxic = i % 5 == 0
        if toxic:
            for j in range(3):
                bad = BAD[(i + j) % 2] if i % 2 else f"{STEM}{words[j][:3]}"
                words.insert(20 + 11 * j + i % 9, bad)
        docs.append((i, " ".join(words), "en", None, None))
        labels.append((i, 1, int(toxic)))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(docs, schema), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_folding():
    # l and i fold to one letter.
    assert folded_words("V1LEW0RT v.i.l.e vіlewоrt") == ["viiewort", "viie", "viiewort"]
    assert folded_words("saaaad que!! les$$$ a+b 2024") == ["sad", "que", "ies", "atb", "2024"]
    assert folded_words("") == [] and folded_words("…—") == []


def test_exceptions_and_length():
    model = Model({"grubnok ": 5.0, "snari": 3.0}, ("the grubnok",), (-2.0, 2.0))
    matcher = Matcher(model)
    assert matcher.features("a grubnok snarling") == (8.0, 3)
    assert matcher.features("the grubnok")[0] == 0 and matcher.features("grubnoks unsnarl")[0] == 0
    assert matcher.score("") == 0 and 0 < matcher.score("grubnok" + " word" * 9000) < matcher.score("grubnok") < 1
    assert Matcher(Model({})).score("grubnok") == 0


def test_held_out_labels_are_met_and_never_learned(spark, corpus, clashing):
    docs, labels = corpus
    rows = {r.doc_id: r for r in toxicity_report(clashing(docs), labels).collect()}
    want = {r.doc_id: r.toxic for r in labels.collect()}
    for i, row in rows.items():
        assert row.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
    assert [rows[i].predicted for i in sorted(rows)] == [want[i] for i in sorted(rows)]
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert fitted(docs, turned) == fitted(docs, labels)


def test_odd_tables(spark, corpus, hard_docs, no_docs, clashing):
    docs, labels = corpus
    mixed = docs.union(hard_docs.withColumn("doc_id", F.col("doc_id") + 10_000))
    report = toxicity_report(mixed, labels.union(spark.createDataFrame([(None, 1, 1), (5, None, None)], labels.schema)))
    assert report.count() == docs.count() + hard_docs.count()
    assert report.filter("doc_id > 10000 or doc_id is null").filter("predicted = 1").count() == 0
    assert not any(r.held_out for r in report.filter("doc_id is null").collect())
    assert toxicity_report(no_docs, labels).count() == 0
    assert toxicity_report(hard_docs, labels.limit(0)).agg(F.max("score")).first()[0] == 0
    kept = drop_toxic(clashing(docs), labels)
    assert kept.columns == clashing(docs).columns and kept.count() == 480
    assert not math.isnan(report.agg(F.sum("score")).first()[0])


def test_labels_without_a_document_take_no_place_in_the_sample(spark, corpus):
    docs, labels = corpus
    fit = Fit(toxic_rows=60, other_rows=200)
    strange = spark.range(10_000, 14_000).selectExpr("id as doc_id", "1 as quality", "cast(id % 2 as int) as toxic")
    alone, mixed = fitted(docs, labels, fit), fitted(docs, labels.union(strange), fit)
    assert alone.entries and mixed.entries == alone.entries and mixed.exceptions == alone.exceptions
    assert mixed.curve == pytest.approx(alone.curve)


def test_short_words_vowel_signs_and_scripts_without_spaces(spark):
    """A word of three letters, one with vowel signs, and runs of characters between others."""
    letters = random.Random(11)
    hindi = ["नमस्ते", "दुनिया", "किताब", "पानी", "सूरज", "रास्ता", "बादल", "मिठाई", "दरवाज़ा", "खिड़की"]
    kanji = [chr(0x4E00 + i) for i in range(40)]
    rows, labels = [], []
    for i in range(480):
        kind, toxic = i % 3, (i // 3) % 3 == 0
        if kind == 0:
            words = letters.choices(["sun", "tea", "oak", "rain", "mill", "pond", "lane", "hut"], k=40)
            bad, join = "zub", " "
        elif kind == 1:
            words, bad, join = letters.choices(hindi, k=40), "गधा", " "
        else:
            words, bad, join = letters.choices(kanji, k=60), "\u5f00\u5f01", ""
        if toxic:
            for place in (7, 15, 30):
                words.insert(place + i % 5, bad)
        rows.append((i, join.join(words), "xx", None, None))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    entries = fitted(docs, marks).entries
    assert "zub " in entries and any(e.startswith("गधा") for e in entries) and "\u5f00 \u5f01 " in entries
    got = {r.doc_id: r.predicted for r in toxicity_report(docs, marks).collect()}
    assert got == {i: toxic for i, _, toxic in labels}
    assert folded_words("गधा है") == ["गधा", "है"] and folded_words("a\u4e00\u4e01b") == ["a", "\u4e00", "\u4e01", "b"]


def plain_entries(rows, fit):
    """Counts, odds and choice of the entries in plain Python: ``rows`` of (toxic, text)."""
    docs, near = {True: Counter(), False: Counter()}, {}
    for toxic, text in rows:
        words = folded_words(text)
        seen = words if toxic else [*words, *without_accents(words)]
        met = set()
        for place, word in enumerate(seen):
            if not word.isalpha():
                continue
            forms = {word + " "} | {word[:n] for n in range(fit.prefix_chars, min(16, len(word)) + 1)}
            met |= forms
            if toxic:
                around = [words[place - 1] if place else "", *words[place + 1 : place + 2]]
                for form in forms:
                    near.setdefault(form, set()).add(zlib.crc32(" ".join(around).encode()))
        docs[toxic].update(met)
    n = {kind: sum(t is kind for t, _ in rows) for kind in (True, False)}
    odds = {}
    for form, count in docs[True].items():
        wide = max(fit.min_surroundings, min(64, fit.surroundings_per_doc * count))
        if count >= max(fit.min_docs, fit.min_share * n[True]) and len(near[form]) >= wide:
            value = math.log((count + 0.5) / (n[True] + 1)) - math.log((docs[False][form] + 0.5) / (n[False] + 1))
            if value >= fit.min_odds:
                odds[form] = value
    out = {}
    for form in sorted(odds, key=lambda f: (-odds[f] * docs[True][f], -len(f), f)):
        longer = any(form != other and other.startswith(form) and len(form) >= fit.prefix_chars for other in out)
        shorter = any(form != other and form.startswith(other) and len(other) >= fit.prefix_chars for other in out)
        if not longer and not shorter:
            out[form] = odds[form]
    return out


def test_entries_and_curve_equal_a_plain_recount(spark, corpus):
    docs, labels = corpus
    toxic = {r.doc_id: r.toxic == 1 for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    rows = [(toxic[r.doc_id], r.text) for r in docs.collect() if r.doc_id in toxic]
    model, want = fitted(docs, labels), plain_entries(rows, Fit())
    assert model.entries.keys() == want.keys() and want
    assert all(model.entries[e] == pytest.approx(want[e]) for e in want)
    # The scan finds the strongest entry at each word; the curve's slope is level with its ridge there.
    matcher, slope = Matcher(model), [0.0, 0.0]
    for is_toxic, text in rows:
        words, total = folded_words(text), 0.0
        for word in words:
            total += max([w for e, w in want.items() if f"{word} ".startswith(e)], default=0.0)
        assert matcher.features(text) == (pytest.approx(total), len(words))
        x = strength(total, len(words))
        p = 1 / (1 + math.exp(-(model.curve[0] + model.curve[1] * x)))
        slope = [slope[0] + (is_toxic - p) / len(rows), slope[1] + (is_toxic - p) * x / len(rows)]
    assert slope[0] == pytest.approx(1e-6 * model.curve[0], abs=1e-5) and slope[1] == pytest.approx(1e-3 * model.curve[1], abs=1e-5)


def plain_scores(rows, texts, fit=Fit()):
    """Scores of ``texts`` by a lexicon learned from ``rows`` of (toxic, text), in plain Python."""
    entries = plain_entries(rows, fit)

    def hits(words):
        return [i for i, w in enumerate(words) if any(f"{w} ".startswith(e) for e in entries)]

    seen = {True: Counter(), False: Counter()}
    for toxic, text in rows:
        words = folded_words(text)
        phrases = {" ".join(words[j : j + 2]) for i in hits(words) for j in (i - 1, i) if 0 <= j < len(words) - 1}
        seen[toxic].update(phrases)
    spared = {p for p, n in seen[False].items() if n >= fit.exception_docs and n >= 10 * seen[True][p]}

    def total(text):
        words = folded_words(text)
        free = {j for i in range(len(words) - 1) if " ".join(words[i : i + 2]) in spared for j in (i, i + 1)}
        both = [w for i, w in enumerate(words) if i not in free] + without_accents(words)
        return sum(max([v for e, v in entries.items() if f"{w} ".startswith(e)], default=0.0) for w in both), len(words)

    label = np.array([float(t) for t, _ in rows])
    curve = Model.curve
    if 0 < label.sum() < len(rows):
        x = np.column_stack([np.ones(len(rows)), [strength(*total(text)) for _, text in rows]])
        beta = np.zeros(2)
        for _ in range(500):  # the same likelihood with its ridge, by small steps of Newton's method
            p = 1 / (1 + np.exp(-x @ beta))
            slope = x.T @ (label - p) / len(rows) - np.array([1e-6, 1e-3]) * beta
            bend = (x * (p * (1 - p))[:, None]).T @ x / len(rows) + np.diag([1e-6, 1e-3])
            beta += np.clip(np.linalg.solve(bend, slope), -0.5, 0.5)
        curve = (beta[0], max(0.1, beta[1]))
    out = []
    for text in texts:
        value, words = total(text or "")
        out.append(1 / (1 + math.exp(-(curve[0] + curve[1] * strength(value, words)))) if value > 0 else 0.0)
    return out


def test_scores_equal_plain_python(spark, corpus):
    docs, labels = corpus
    toxic = {r.doc_id: r.toxic == 1 for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = plain_scores([(toxic[k], texts[k]) for k in texts if k in toxic], texts.values())
    got = {r.doc_id: r.score for r in toxicity_report(docs, labels).collect()}
    assert [got[k] for k in texts] == pytest.approx(want, abs=1e-4)
