"""Encoding to token ids and back, through a transducer lexicon of the frequent words.

The words of all texts are counted first; the most frequent ones and their ids are compiled into the automaton of
``lexicon.py``, which every worker maps into memory. Texts are then cut into words by Arrow, the distinct words of a batch
run through the automaton together, and words that it does not hold are merged exactly by the tokenizers library's rules.
The lexicon only saves work: the ids are those of the library whatever words it holds.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from lakeops.llm.batches import chunks, large_texts
from lakeops.llm.columns import free_name
from lakeops.llm.lexicon import Lexicon, lexicon, write_lexicon
from lakeops.llm.storage import new_file
from lakeops.llm.tokens import KEPT_BYTES, PieceIds, distinct_words, load_tokenizer, piece_ids, value_bytes
from lakeops.session import materialize, work_dir

#: Words of a lexicon. One task compiles them, so this bounds it.
WORDS = 200_000


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word`` (as its bytes) and ``n`` of the words that lie twice in some chunk of texts, folded as for encoding.

    Words that no chunk holds twice are not frequent, and leaving them out spares the shuffle most of its rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 0):
                words, places, _ = distinct_words(large_texts(part.column(0)))
                n = np.bincount(places.to_numpy(), minlength=len(words))
                often = pa.array((n > 1) & (np.diff(value_bytes(words)[1]) <= KEPT_BYTES))
                columns = [words.filter(often).cast(pa.binary()), pa.array(n).filter(often)]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    rows = docs.select(F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(count, "word binary, n long").where("length(word) > 0").groupBy("word").agg(F.sum("n").alias("n"))


def compile_lexicon(docs: DataFrame, tokenizer: str, text: str = "text", words: int = WORDS) -> dict | None:
    """Compile the ``words`` most frequent words of ``docs`` with their ids.

    Returns the file's place and its counts of words, states and arcs; None if no word is frequent. The file lies in the
    shared folder; one that a lost task left behind has another name and is never read.
    """
    folder = work_dir(docs.sparkSession, "lexicon")
    best = word_counts(docs, text).orderBy(F.col("n").desc(), "word").limit(words).select("word")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [word for batch in batches for word in batch.column(0).to_pylist()]
        if not found:
            return
        found.sort()
        uri = new_file(folder, ".fst")
        ids = piece_ids(tokenizer).word_ids(pa.array(found, pa.large_binary()))
        yield pa.RecordBatch.from_pylist([{"uri": uri, **write_lexicon(uri, found, ids)}])

    # The result is stored, so that the task is not run again for it.
    made = best.coalesce(1).mapInArrow(build, "uri string, words long, states long, arcs long")
    row = materialize(made, "lexicon-made").first()
    return row.asDict() if row else None


def encode(
    docs: DataFrame,
    tokenizer: str,
    lexicon_uri: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    decoded: bool = False,
) -> DataFrame:
    """``key`` and ``ids`` (array of int) of every row: what the library's encode of the whole text gives.

    With ``decoded`` a column of that name holds what :func:`decode` makes of the ids, worked out in the same process.
    Without ``lexicon_uri`` every word is merged. Null texts are empty and have no ids; repeated rows and null keys have
    a row each; other columns are left out. Special tokens' strings inside a text are their tokens, as the library has it
    by default. ``tokenizer`` is a path that every executor has.
    """
    rows = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged = piece_ids(tokenizer)
        known = lexicon(lexicon_uri) if lexicon_uri else None
        for batch in batches:
            for part in chunks(batch):
                lists = _encoded(large_texts(part.column(1)), merged, known)
                columns = {key: part.column(0), "ids": lists}
                if decoded:
                    columns["decoded"] = _decoded(lists, tokenizer)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
                del columns, lists
                pa.default_memory_pool().release_unused()

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, ids array<int>" + ", decoded string" * decoded)


def _encoded(texts: pa.Array, merged: PieceIds, known: Lexicon | None) -> pa.Array:
    special = pc.match_substring_regex(texts, merged.added.pattern).to_numpy(zero_copy_only=False)
    plain = pc.if_else(pa.array(special), "", texts) if special.any() else texts
    ids, ends = _looked_up(plain, merged, known)
    if special.any():
        # Texts with added tokens have no ids yet; theirs go between the others'.
        whole = iter(merged.encode(texts.filter(pa.array(special)).to_pylist()))
        parts = [np.frombuffer(next(whole), "<u4") if s else ids[a:b] for s, a, b in zip(special, ends, ends[1:])]
        ids, ends = np.concatenate(parts), np.append(0, np.cumsum([len(part) for part in parts]))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))


def _looked_up(texts: pa.Array, merged: PieceIds, known: Lexicon | None) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts one after another, and where those of each text begin and the last end."""
    words, places, ends = distinct_words(texts)
    if known is None:
        outputs = merged.word_ids(words)
    else:
        found = known.find(words)
        unseen = np.flatnonzero(found < 0)
        found[unseen] = len(known.outputs) + np.arange(len(unseen))
        rest = merged.word_ids(words.take(pa.array(unseen)))
        # Of the lexicon's outputs only those in use are copied.
        held = np.flatnonzero(found < len(known.outputs))
        outputs = pa.concat_arrays([known.outputs.take(pa.array(found[held])), rest])
        order = np.empty(len(words), np.int64)
        order[held], order[unseen] = np.arange(len(held)), len(held) + np.arange(len(unseen))
        outputs = outputs.take(pa.array(order))
    data, cuts = value_bytes(outputs.take(places))
    return data.view("<u4"), cuts[ends] // 4


@functools.cache
def _tokens(path: str) -> tuple[Tokenizer, pa.Array]:
    """The strings of all ids, each behind a blank; ids without a token have none."""
    tokenizer = load_tokenizer(path, False)
    size = max(tokenizer.get_vocab(with_added_tokens=True).values(), default=-1) + 1
    tokens = [tokenizer.id_to_token(i) for i in range(size)]
    return tokenizer, pa.array(["" if token is None else f" {token}" for token in tokens], pa.large_string())


def decode(rows: DataFrame, tokenizer: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the text that the library's decode gives for ``ids``, special tokens included.

    A vocabulary file without a decoder has its tokens joined by blanks. Null ids give the empty text; ids that the
    vocabulary does not have are left out, as the library does. A column named ``name`` is replaced.
    """
    kept = [c for c in rows.columns if c.lower() != name.lower()]
    given = rows.select(*[F.col(f"`{c}`") for c in kept])
    inner = free_name(given, "decoded")
    place = kept.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _decoded(batch.column(place), tokenizer)
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*kept, inner])

    schema = T.StructType([*given.schema, T.StructField(inner, T.StringType())])
    return given.mapInArrow(run, schema).withColumnRenamed(inner, name)


def _decoded(lists: pa.Array, tokenizer: str) -> pa.Array:
    whole, tokens = _tokens(tokenizer)
    if whole.decoder is not None:
        found = [[i for i in one or [] if 0 <= i < len(tokens)] for one in lists.to_pylist()]
        return pa.array(whole.decode_batch(found, skip_special_tokens=False), pa.string())
    return _joined(lists, tokens)


def _joined(lists: pa.Array, tokens: pa.Array) -> pa.Array:
    flat, lengths = lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(tokens)))
    data, cuts = value_bytes(tokens.take(pc.if_else(known, flat, None)).fill_null("").cast(pa.large_binary()))
    ends = cuts[np.append(0, np.cumsum(lengths))]
    # The blank before a text's first token goes.
    first = np.minimum(ends[:-1] + 1, ends[1:]).tolist()
    packed = memoryview(data)
    return pa.array([bytes(packed[a:b]) for a, b in zip(first, ends[1:].tolist())], pa.binary()).cast(pa.string())
