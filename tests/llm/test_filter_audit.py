"""The audit against documents walked one by one through every order."""

import re
from itertools import permutations

from lakeops.llm.filter_audit import interaction_audit

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def failures(docs):
    """The filters that each row fails, as letters."""
    least = {}
    for key, text, _ in docs:
        least.setdefault(text or "", []).append(key)
    out = []
    for key, text, _ in docs:
        text = text or ""
        words = [w for w in SPACE.split(text) if w]
        known = [k for k in least[text] if k is not None]
        out.append("".join(letter for letter, fails in {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": bool(known) and (key is None or key > min(known)),
        }.items() if fails))
    return out


def walked(docs, labels):
    good, toxic = ({k for k, *marks in labels if k is not None and marks[i] == 1} for i in (0, 1))
    fails = failures(docs)
    rows, shapley = {}, {}
    for part in {d[2] or "" for d in docs}:
        inside = [(d[0], f) for d, f in zip(docs, fails) if (d[2] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = inside
            for step, letter in enumerate(order, 1):
                gone = [(k, f) for k, f in left if letter in f]
                left = [(k, f) for k, f in left if letter not in f]
                failing = sum(letter in f for _, f in inside)
                rows[part, order, step] = [
                    len(left), len(gone), failing - len(gone), sum(f == letter for _, f in inside),
                    sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone), letter,
                ]
                shapley[part, letter] = shapley.get((part, letter), 0) + len(gone)
    return sorted((*key, *row[:6], shapley[key[0], row[6]]) for key, row in rows.items())


def test_audit_equals_walking(spark, hard_docs, clashing, prose):
    base = prose(40, 150)
    more = [
        (20, base, "", None, None), (21, base + " #", "de", None, None), (22, base.upper(), "de", None, None),
        (23, (prose(41, 30) + " ") * 5, "de", None, None), (24, base, "de", None, None), (None, base, "fr", None, None),
        (25, "SHORT # SHORT", "fr", None, None), (26, "a b", "fr", None, None),
    ]
    docs = clashing(hard_docs.union(spark.createDataFrame(more, hard_docs.schema)))
    docs = docs.withColumnRenamed("found", "mask").withColumnRenamed("kept", "digest").withColumnRenamed("node", "cells")
    marks = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, None, None), (20, 1, 1), (24, 1, 0), (25, 0, 1), (None, 1, 1), (999, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    rows = interaction_audit(docs, labels).collect()
    got = sorted(
        (r.part, r.filter_order, r.step, r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in rows
    )
    want = walked([(r.doc_id, r.text, r.lang) for r in docs.collect()], marks)
    assert len(got) == 600 * 4 and got == want


def test_no_rows(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interaction_audit(no_docs, labels).count() == 0
