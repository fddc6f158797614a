"""Toxicity by a weighted lexicon, learned from labelled rows and matched by Aho-Corasick.

Texts are folded first: case and look-alike letters of other scripts, digits and signs that stand for letters inside a
word, letters parted by dots or dashes, and stretched letters. ``l`` and ``i`` fold to one letter, as ``1`` may stand for
either. Accents tell words apart, so words with accents are looked up as they are and once more without them; vowel signs
are part of their words. Entries are whole words of any length, beginnings of words of ``Fit.prefix_chars`` letters or
more, and, in scripts without spaces, runs of up to ``RUN`` characters, each of which counts as a word there. An entry
inside an exception phrase does not count. The weights of the entries found are added up and divided by a power of the
length; a logistic curve turns them into a score between 0 and 1.

The model is fitted on a sample of labelled rows, ``Fit.toxic_rows`` and ``Fit.other_rows`` at most, taken in the order
of a hash of their ids; all documents are scored. A candidate must stand in many toxic documents and in many different
surroundings, so that words of a text that was merely copied often are not taken for toxic ones.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.batches import give_back
from lakeops.llm.columns import free_name
from lakeops.session import materialize

#: Letters of other scripts that look like Latin ones (Cyrillic, then Greek).
LOOK_ALIKES = dict(
    zip("аеорсухіјѕԁһԛԝвнкмтгпл", "aeopcyxijsdhqwbhkmtrnl", strict=True)
) | dict(zip("αβεηικνορτυχγω", "abenikvoptuxyw", strict=True))
#: Digits and signs that stand for letters inside a word.
STAND_INS = str.maketrans("0123456789@$!|+", "oizeasgtbgasiit")
SIGNS = "@$!|+"
#: Characters without width.
INVISIBLE = "\u200b\u200c\u200d\xad"
THRESHOLD = 0.3
#: The sum of weights is divided by this power of the length in hundreds of words.
LENGTH_POWER = 0.25
#: Characters of an entry in a script without spaces.
RUN = 4
#: Different surroundings that are told apart in one batch.
SURROUNDINGS = 64


@dataclass(frozen=True)
class Fit:
    """Parameters. Rows bound the sample; the others say what makes an entry or an exception."""

    toxic_rows: int = 2000
    other_rows: int = 6000
    min_docs: int = 4
    min_share: float = 0.004
    min_surroundings: int = 3
    surroundings_per_doc: float = 0.4
    min_odds: float = 3.5
    prefix_chars: int = 4
    exception_docs: int = 5


@dataclass(frozen=True)
class Model:
    """``entries``: beginning of a word (a blank behind it: the whole word) to weight; ``curve``: its two terms."""

    entries: dict[str, float]
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float] = (-2.0, 2.0)


class _Letters(dict):
    """Every character to its folded form, worked out when first met."""

    def __missing__(self, code: int) -> str:
        plain = unicodedata.normalize("NFKC", chr(code).lower())
        self[code] = "".join(self._kept(LOOK_ALIKES.get(c, c)) for c in plain if not unicodedata.combining(c))
        return self[code]

    @staticmethod
    def _kept(c: str) -> str:
        if c.isalnum() or c in SIGNS or unicodedata.category(c) in ("Mn", "Mc"):  # vowel signs; accents are gone
            return "i" if c == "l" else c
        return "." if c in ".-_" else "" if c in INVISIBLE else " "


_LETTERS = _Letters()
#: Single letters parted by single dots (dashes and lines have become dots).
_PARTED = re.compile(r"(?<![^\W_])[^\W_](?:\.[^\W_]){2,}(?![^\W_])")
_STRETCHED = re.compile(r"(.)\1{2,}")
#: Scripts without spaces: Thai and Lao, Burmese, Khmer, kana and Chinese characters.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff]")


@lru_cache(1 << 16)
def _word(word: str) -> str:
    """A word with digits or signs: those inside a word of letters become letters, others go."""
    word = word.strip(SIGNS)
    if any(c.isalpha() for c in word):
        word = word.translate(STAND_INS)
    return word


def folded_words(text: str) -> list[str]:
    if text.isascii():
        out = text.translate(_LETTERS)
    else:
        out = _UNSPACED.sub(r" \g<0> ", unicodedata.normalize("NFC", text).translate(_LETTERS))
    if "." in out:
        out = _PARTED.sub(lambda m: m[0].replace(".", ""), out).replace(".", " ")
    out = _STRETCHED.sub(r"\1", out)
    return [w if w.isalpha() else _word(w) for w in out.split()]


def without_accents(words: list[str]) -> list[str]:
    """The words that have accents, without them."""
    out = []
    for word in words:
        if not word.isascii():
            plain = _plain(word)
            if plain != word:
                out.append(plain)
    return out


@lru_cache(1 << 16)
def _plain(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))


class Matcher:
    """Finds the entries of a model in folded words."""

    def __init__(self, model: Model):
        self.model = model
        self.automaton = ahocorasick.Automaton()
        found: dict[str, tuple] = {f" {entry}": (len(entry), weight) for entry, weight in model.entries.items()}
        found |= {f" {phrase} ": (len(phrase) + 1, None) for phrase in model.exceptions}
        for pattern, value in found.items():
            self.automaton.add_word(pattern, value)
        self.empty = not found
        if found:
            self.automaton.make_automaton()

    def hits(self, words: list[str]) -> list[tuple[int, int, float]]:
        """(start, end, weight) of entries in the joined words, without those inside exceptions."""
        if self.empty or not words:
            return []
        entries, spared = [], []
        for end, (length, weight) in self.automaton.iter(f" {' '.join(words)} "):
            if weight is None:
                spared.append((end - length, end))
            else:
                entries.append((end - length, end, weight))
        if spared:
            entries = [e for e in entries if not any(a <= e[0] and e[1] <= b for a, b in spared)]
        return entries

    def features(self, text: str) -> tuple[float, int]:
        """The sum of the weights found, at most one entry for each word, and the number of words."""
        words = folded_words(text)
        best: dict[int, float] = {}
        for start, _, weight in self.hits([*words, "|", *without_accents(words)]):
            best[start] = max(weight, best.get(start, 0.0))
        return sum(best.values()), len(words)

    def score(self, text: str) -> float:
        total, words = self.features(text)
        return curve_value(self.model.curve, total, words) if total > 0 else 0.0


def strength(total: float, words: int) -> float:
    """The sum of weights, normalised by the length of the text."""
    return math.log1p(total / (1 + words / 100) ** LENGTH_POWER)


def curve_value(curve: tuple[float, float], total: float, words: int) -> float:
    x = curve[0] + curve[1] * strength(total, words)
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, x))))


def held_out(key: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def _candidates(words: list[str], fit: Fit) -> Iterator[tuple[str, int]]:
    """Every beginning and the whole of each word, with its place."""
    for place, word in enumerate(words):
        if word.isalpha() or _spelled(word):
            for end in range(fit.prefix_chars, min(len(word), 16) + 1):
                yield word[:end], place
            yield word + " ", place


@lru_cache(1 << 16)
def _spelled(word: str) -> bool:
    """Whether a word is all letters and vowel signs."""
    return bool(word) and all(c.isalpha() or unicodedata.category(c) in ("Mn", "Mc") for c in word)


def _runs(words: list[str]) -> Iterator[tuple[str, int]]:
    """Every run of 2 to ``RUN`` neighbouring characters of a script without spaces, with its place."""
    alone = [len(word) == 1 and _UNSPACED.match(word) is not None for word in words]
    if any(alone):
        for place in range(len(words) - 1):
            for size in range(2, RUN + 1):
                if not all(alone[place : place + size]) or place + size > len(words):
                    break
                yield " ".join(words[place : place + size]) + " ", place


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bool, str]]:
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()])


def _toxic_counts(sample: DataFrame, n_toxic: int, fit: Fit) -> dict[str, int]:
    """Candidates with the number of toxic documents they stand in, if in enough of them and enough surroundings."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: dict[str, int] = defaultdict(int)
        near: dict[str, set[int]] = defaultdict(set)
        for _, text in _texts(batches):
            words, met = folded_words(text), set()
            for candidate, place in chain(_candidates(words, fit), _runs(words)):
                if candidate not in met:
                    met.add(candidate)
                    docs[candidate] += 1
                if len(near[candidate]) < SURROUNDINGS:
                    near[candidate].add(_surrounding(words, place))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(docs), pa.string()),
                pa.array(list(docs.values()), pa.int64()),
                pa.array([sorted(near[c]) for c in docs], pa.list_(pa.int64())),
            ],
            names=["candidate", "docs", "near"],
        )

    counted = sample.filter("toxic").mapInArrow(count, "candidate string, docs long, near array<long>")
    many = counted.groupBy("candidate").agg(
        F.sum("docs").alias("docs"), F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")
    )
    wide = F.greatest(F.lit(fit.min_surroundings), F.least(F.lit(SURROUNDINGS), fit.surroundings_per_doc * F.col("docs")))
    enough = many.filter((F.col("docs") >= max(fit.min_docs, fit.min_share * n_toxic)) & (F.size("near") >= wide))
    return {row.candidate: row.docs for row in enough.select("candidate", "docs").collect()}


def _surrounding(words: list[str], place: int) -> int:
    around = (words[place - 1] if place else "", *words[place + 1 : place + 2])
    return zlib.crc32(" ".join(around).encode(errors="replace"))


def _other_counts(sample: DataFrame, candidates: Iterable[str], fit: Fit) -> dict[str, int]:
    known = sample.sparkSession.sparkContext.broadcast(frozenset(candidates))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: dict[str, int] = defaultdict(int)
        for _, text in _texts(batches):
            in_order = folded_words(text)
            words = list(set(in_order))
            words += without_accents(words)
            for candidate in {c for c, _ in chain(_candidates(words, fit), _runs(in_order))} & known.value:
                docs[candidate] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(docs), pa.string()), pa.array(list(docs.values()), pa.int64())], names=["candidate", "docs"]
        )

    counted = sample.filter("not toxic").mapInArrow(count, "candidate string, docs long")
    return {r.candidate: r.docs for r in counted.groupBy("candidate").agg(F.sum("docs").alias("docs")).collect()}


def _entries(toxic: dict[str, int], other: dict[str, int], n_toxic: int, n_other: int, fit: Fit) -> dict[str, float]:
    """Candidates of high odds, without beginnings and continuations of those already taken.

    Those that tell most come first: odds times documents prefers a stem to each of its many words, and a word to a
    beginning that other words share.
    """

    def odds(candidate: str) -> float:
        inside = (toxic[candidate] + 0.5) / (n_toxic + 1)
        return math.log(inside) - math.log((other.get(candidate, 0) + 0.5) / (n_other + 1))

    chosen: dict[str, float] = {}
    begun: set[str] = set()  # all beginnings of chosen ones
    good = {c: w for c in toxic if (w := odds(c)) >= fit.min_odds}
    for candidate in sorted(good, key=lambda c: (-good[c] * toxic[c], -len(c), c)):
        shorter = {candidate[:end] for end in range(fit.prefix_chars, len(candidate))}
        if candidate not in begun and chosen.keys().isdisjoint(shorter):
            chosen[candidate] = good[candidate]
            begun |= shorter
    return chosen


def _exceptions(sample: DataFrame, model: Model, fit: Fit) -> tuple[str, ...]:
    """Two-word phrases around entries that stand in harmless documents and in hardly any toxic one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        docs: dict[tuple[str, bool], int] = defaultdict(int)
        for toxic, text in _texts(batches):
            words, met = folded_words(text), set()
            starts = np.cumsum([0, *[len(w) + 1 for w in words]])
            for start, *_ in matcher.hits(words):
                place = int(np.searchsorted(starts, start))
                met |= {" ".join(words[i : i + 2]) for i in (place - 1, place) if 0 <= i < len(words) - 1}
            for phrase in met:
                docs[phrase, toxic] += 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _ in docs], pa.string()),
                pa.array([n if t else 0 for (_, t), n in docs.items()], pa.int64()),
                pa.array([0 if t else n for (_, t), n in docs.items()], pa.int64()),
            ],
            names=["phrase", "toxic", "other"],
        )

    counted = sample.mapInArrow(count, "phrase string, toxic long, other long")
    totals = counted.groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    rows = totals.filter((F.col("other") >= fit.exception_docs) & (F.col("other") >= 10 * F.col("toxic"))).collect()
    return tuple(sorted(row.phrase for row in rows))


def _curve(sample: DataFrame, model: Model) -> tuple[float, float]:
    """Logistic regression of the label on the strength, by Newton's method with a small ridge."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        rows = [(t, *matcher.features(text)) for t, text in _texts(batches)]
        columns = list(zip(*rows)) or [(), (), ()]
        kinds = (pa.bool_(), pa.float64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["t", "s", "n"])

    rows = sample.mapInArrow(features, "t boolean, s double, n long").collect()
    label = np.array([float(r.t) for r in rows])
    if not 0 < label.sum() < len(rows):
        return Model.curve
    x = np.column_stack([np.ones(len(rows)), [strength(r.s, r.n) for r in rows]])
    weight = np.full(len(rows), 1 / len(rows))
    beta, ridge = np.zeros(2), np.diag([1e-6, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (label - p)) - ridge @ beta
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        move = np.linalg.solve(curvature, slope)
        beta += np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return float(beta[0]), max(0.1, float(beta[1]))  # more entries never make a text less toxic


def fitted(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Model:
    """The model of a bounded sample of the labelled rows that are not held out.

    Null labels, null ids and ids without a document teach nothing; labels that contradict each other count as toxic.
    Without toxic rows the lexicon is empty and every text scores 0.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    marks = known.groupBy(F.col("doc_id").alias("labelled")).agg((F.max("toxic") == 1).alias("toxic"))
    # Ids without a document must not use up the bound.
    marks = marks.join(docs.select(F.col("doc_id").alias("known")), F.col("labelled") == F.col("known"), "left_semi")
    order = [F.xxhash64("labelled"), "labelled"]
    chosen = marks.filter("toxic").orderBy(*order).limit(fit.toxic_rows)
    chosen = chosen.union(marks.filter("not toxic").orderBy(*order).limit(fit.other_rows))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    # A repeated id must not lift the bound.
    sample = materialize(
        texts.groupBy("labelled").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")).select("toxic", "text"),
        "toxicity-sample",
    )
    sizes = sample.groupBy().agg(F.count_if("toxic").alias("toxic"), F.count_if(~F.col("toxic")).alias("other")).first()
    toxic = _toxic_counts(sample, sizes.toxic, fit)
    entries = _entries(toxic, _other_counts(sample, toxic, fit), sizes.toxic, sizes.other, fit)
    model = Model(entries)
    model = Model(entries, _exceptions(sample, model, fit))
    return Model(entries, model.exceptions, _curve(sample, model))


def score_column(spark, model: Model):
    """A column function text -> score; null and empty texts score 0."""
    shared = spark.sparkContext.broadcast(model)

    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(shared.value)
        for texts in parts:
            # One text at a time becomes a Python string.
            yield pa.array([matcher.score(text.as_py() or "") for text in texts], pa.float64())
        give_back()

    return F.arrow_udf(score, "double")


def toxicity_report(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``; repeated rows get repeated results."""
    model = fitted(docs, labels, fit)
    scored = docs.select("doc_id", score_column(docs.sparkSession, model)("text").alias("score"))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns and no others.

    Null and empty texts score 0 and stay; repeated rows are judged each; without toxic labels all rows stay.
    """
    name = free_name(docs, "_score")
    scored = docs.withColumn(name, score_column(docs.sparkSession, fitted(docs, labels, fit))("text"))
    return scored.filter(F.col(name) < THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])
