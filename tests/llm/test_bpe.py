"""The transducer lexicon against plain sets, and encoding and decoding against the unmodified library."""

import hashlib
import random

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from lakeops.llm.bpe import compile_lexicon, decode, encode, word_counts
from lakeops.llm.bpe_queries import op11_transducer_bpe
from lakeops.llm.lexicon import Automaton, Lexicon, write_lexicon
from lakeops.llm.registry import table
from test_tokens import TEXTS

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def binary(words):
    return pa.array(words, pa.large_binary())


def test_automaton_finds_its_words_and_no_others(tmp_path):
    letters = random.Random(4)
    words = sorted({bytes(letters.choices(b"ab\xc3\xa9z", k=letters.randint(0, 7))) for _ in range(2000)})
    inside, outside = words[::2], words[1::2]
    outputs = binary([b"%d" % i * (i % 4) for i in range(len(inside))])
    counts = write_lexicon(f"{tmp_path}/a.fst", inside, outputs)
    held = Lexicon(f"file://{tmp_path}/a.fst")
    assert held.find(binary(inside)).tolist() == list(range(len(inside)))
    assert (held.find(binary([*outside, b"abababababab", b"\x00"])) == -1).all()
    assert held.outputs.to_pylist() == outputs.to_pylist()
    # Minimal: as many states as there are different sets of endings.
    endings = {}
    for word in inside:
        for i in range(len(word) + 1):
            endings.setdefault(word[:i], set()).add(word[i:])
    assert counts["states"] == len({frozenset(e) for e in endings.values()})


def test_automaton_of_nothing_and_of_the_empty_word(tmp_path):
    assert len(Automaton([]).states) == 1
    for words, found in (([], [-1, -1]), ([b""], [0, -1])):
        write_lexicon(f"{tmp_path}/{len(words)}.fst", words, binary([b"x"] * len(words)))
        assert Lexicon(f"{tmp_path}/{len(words)}.fst").find(binary([b"", b"a"])).tolist() == found


def test_word_counts_equal_plain_counts(spark):
    texts = ["The the THE cat", "a b a", "cat cat É É é", None, " \n"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    counts = {bytes(r.word).decode(): r.n for r in word_counts(docs).collect()}
    assert counts == {"the": 3, "cat": 3, "a": 2, "É": 2}


def test_round_trip_equals_the_library(spark, hard_docs, no_docs, clashing, prose):
    plain = Tokenizer.from_file(PATH)
    special = ["a <|endoftext|> b", "H̱<|startoftext|>x<|endoftext", "<|endoftext|>", "É <|ENDOFTEXT|> 12 a1 don't"]
    odd = [*TEXTS, *special, prose(5, 500), prose(5, 500).upper() + ", ÀÉ.x"]
    more = spark.createDataFrame([(100 + i, t, None, None, None) for i, t in enumerate(odd)], hard_docs.schema)
    docs = clashing(hard_docs.union(more)).withColumnRenamed("found", "ids")
    made = compile_lexicon(docs, PATH, words=300)
    assert made["words"] == 300 and made["states"] > 1
    want = []
    for r in docs.collect():
        ids = plain.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, ids, plain.decode(ids, skip_special_tokens=False)))
    for uri in (made["uri"], None):
        for rows in (decode(encode(docs, PATH, uri), PATH), encode(docs, PATH, uri, decoded=True)):
            assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.ids, r.decoded)) for r in rows.collect())
    assert compile_lexicon(no_docs, PATH) is None and encode(no_docs, PATH).count() == 0


def test_ids_that_are_missing_or_unknown(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [320, 60000, None, -1, 321]), (4, [49407])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in decode(rows, PATH).collect()}
    assert got == {1: "", 2: "", 3: Tokenizer.from_file(PATH).decode([320, 321]), 4: "<|endoftext|>"}


def test_other_vocabularies_with_a_decoder(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    ids = [plain.encode(t, add_special_tokens=False).ids for t in ("Hello  wörld\n", "日本", "")]
    rows = spark.createDataFrame(list(enumerate(ids)), "doc_id long, ids array<int>")
    assert [r.decoded for r in decode(rows, path).orderBy("doc_id").collect()] == [plain.decode(i, skip_special_tokens=False) for i in ids]


def test_query_equals_the_library(spark):
    plain = Tokenizer.from_file(PATH)
    want = set()
    for r in table(spark, SF, "documents").collect():
        ids = plain.encode(r.text or "", add_special_tokens=False).ids
        texts = " ".join(map(str, ids)), plain.decode(ids, skip_special_tokens=False)
        want.add((r.doc_id, len(ids), *[hashlib.sha256(t.encode()).hexdigest() for t in texts]))
    rows = op11_transducer_bpe(spark, SF)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {tuple(r) for r in rows.collect()} == want
