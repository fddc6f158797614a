"""Token ids of whole texts, with the ids of words kept.

The tokenizer of these files composes letters (NFC), then folds case, drops white space and never joins what white space
parts, nor a letter with an ASCII mark behind it. So the ids of a text are those of its pieces one after another. Words
and pieces repeat: Arrow finds the distinct words of a batch, and each Python worker keeps the packed ids of at most
``KEPT`` words and pieces that it has met, those met most often longest. Only new pieces go to the tokenizers library;
words of plain letters and marks, which it would not compose, are cut here and go straight to its merges. Texts that hold
the string of an added token go to it whole.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from lakeops.llm.batches import give_back

KEPT = 300_000
#: Words of more bytes are encoded each time.
KEPT_BYTES = 64
#: New words that are handed over as one text.
TOGETHER = 256
#: What the vocabulary puts behind the last id of a word.
WORD_END = "</w>"
LETTER, MARK = 1, 2


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Of each byte: the kind of an ASCII character (the apostrophe is no mark here, as it joins letters), and whether it
    makes a letter of U+00C0 to U+00FF behind the lead byte 0xC3."""
    kinds = np.zeros(256, np.uint8)
    for byte in range(0x21, 0x7F):
        if byte != ord("'") and not chr(byte).isdigit():
            kinds[byte] = LETTER if chr(byte).isalpha() else MARK
    after_lead = np.zeros(256, bool)
    after_lead[0x80:0xC0] = [chr(code).isalpha() for code in range(0xC0, 0x100)]
    return kinds, after_lead


KINDS, AFTER_LEAD = _kinds()
LEAD = 0xC3


@functools.cache
def load_tokenizer(path: str, special_as_text: bool) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = special_as_text
    return tokenizer


@functools.cache
def _merges(path: str) -> Tokenizer:
    """The merges of the file alone, for words that are given in the letters of its vocabulary."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    parts |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None, "added_tokens": []}
    return Tokenizer.from_str(json.dumps(parts))


@functools.cache
def byte_letters() -> dict[int, str]:
    """The letter that a byte-level vocabulary writes for each byte: the byte's own if it can be seen, else the next of 256."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    unseen = [byte for byte in range(256) if byte not in seen]
    return {byte: chr(byte) for byte in seen} | {byte: chr(256 + i) for i, byte in enumerate(unseen)}


def _added(tokenizer: Tokenizer) -> re.Pattern:
    """Matches in texts that may hold an added token: in all, if the library looks for one in the normalised text."""
    added = tokenizer.get_added_tokens_decoder().values()
    if any(token.normalized for token in added):
        return re.compile("")
    return re.compile("|".join(re.escape(token.content) for token in added) or r"[^\s\S]")


def _strings(texts: list[str]) -> pa.Array:
    try:
        return pa.array(texts, pa.large_string())
    except UnicodeEncodeError:  # half a surrogate pair
        return pa.array([text.encode(errors="replace").decode() for text in texts], pa.large_string())


def distinct_words(texts: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """The distinct words of large string texts, the place of each word of the texts among them, and where texts end.

    The library splits at white space, too. Words are folded only where nothing can compose, that is in ASCII: a capital
    may do so with the mark behind it in another way than its small letter. White space at the ends of a text gives
    empty words, which have no ids.
    """
    split = pc.ascii_split_whitespace(texts)
    words = split.values.dictionary_encode()
    folded = pc.if_else(pc.string_is_ascii(words.dictionary), pc.ascii_lower(words.dictionary), words.dictionary)
    folded = folded.cast(pa.large_binary()).dictionary_encode()
    return folded.dictionary, folded.indices.take(words.indices), split.offsets.to_numpy()


def value_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large binary array, and where each value begins and the last ends in them."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = values.buffers()
    places = np.frombuffer(offsets, np.int64, len(values) + 1, 8 * values.offset)
    first, last = places[0], places[-1]
    return np.frombuffer(data or b"", np.uint8)[first:last], places - first


def binary_values(places: np.ndarray, data: np.ndarray) -> pa.Array:
    places = pa.py_buffer(np.ascontiguousarray(places, np.int64))
    buffers = [None, places, pa.py_buffer(np.ascontiguousarray(data))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), places.size // 8 - 1, buffers)


class PieceIds:
    """Packed ids (little-endian unsigned 32-bit) of texts.

    With ``special_as_text`` strings of special tokens inside a text are ordinary text. Without it the ids are those that
    ``encode(text, add_special_tokens=False)`` of the file gives, where such a string is its token.
    """

    def __init__(self, path: str, kept: int = KEPT, special_as_text: bool = True):
        self.tokenizer, self.kept = load_tokenizer(path, special_as_text), kept
        self.added = None if special_as_text else _added(self.tokenizer)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.merges = _merges(path)
        self.letters = {byte: letter for byte, letter in byte_letters().items() if byte != 0x20}  # blanks part words
        self.keys = self.values = pa.array([], pa.large_binary())
        self.uses = np.zeros(0, np.int64)

    def _ids(self, texts: list[str], tokenizer: Tokenizer | None = None) -> list[np.ndarray]:
        found = (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, "<u4") for one in found]

    def _learn(self, pieces: pa.Array) -> pa.Array:
        """The ids of new plain pieces: many as one text, cut behind the ids that end a word."""
        if not len(pieces):
            return pieces
        data, starts = value_bytes(pieces)
        spaced = np.full(len(data) + len(pieces), 0x20, np.uint8)
        spaced[np.arange(len(data)) + np.repeat(np.arange(len(pieces)), np.diff(starts))] = data
        text = spaced.tobytes().decode("latin-1").translate(self.letters)
        cuts = [*(starts[:-1] + np.arange(len(pieces)))[::TOGETHER].tolist(), len(text)]
        ids = np.concatenate(self._ids([text[a:b] for a, b in zip(cuts, cuts[1:])], self.merges))
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(pieces) or ends[-1] != len(ids):  # a vocabulary without ends for some letters
            found = self._ids([piece.decode() for piece in pieces.to_pylist()])
            return pa.array([one.tobytes() for one in found], pa.large_binary())
        return binary_values(np.append(0, 4 * ends), ids)

    def _odd(self, words: list[bytes]) -> pa.Array:
        """The ids of words that only the whole tokenizer knows to cut: words of letters many at a time, others one by one."""
        out: dict[bytes, bytes] = {}
        texts = {word: word.decode() for word in words}
        letters = [word for word, text in texts.items() if text.isalpha()]
        groups = [letters[i : i + TOGETHER] for i in range(0, len(letters), TOGETHER)]
        for group, ids in zip(groups, self._ids([" ".join([texts[word] for word in group]) for group in groups])):
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(group) and ends[-1] == len(ids):  # else some word was parted
                packed, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
                out.update((word, packed[a:b]) for word, a, b in zip(group, cuts, cuts[1:]))
        others = [word for word in words if word not in out]
        out.update((word, ids.tobytes()) for word, ids in zip(others, self._ids([texts[word] for word in others])))
        return pa.array(map(out.__getitem__, words), pa.large_binary())

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text."""
        try:
            return self._encoded(texts)
        finally:
            give_back()

    def _encoded(self, texts: list[str]) -> list[bytes]:
        if self.added is None:
            return self._by_words(texts)
        whole = [i for i, text in enumerate(texts) if self.added.search(text)]
        if not whole:
            return self._by_words(texts)
        held = set(whole)
        others = iter(self._by_words([text for i, text in enumerate(texts) if i not in held]))
        ids = iter(self._ids([texts[i].encode(errors="replace").decode() for i in whole]))
        return [next(ids).tobytes() if i in held else next(others) for i in range(len(texts))]

    def _by_words(self, texts: list[str]) -> list[bytes]:
        words, places, ends = distinct_words(_strings(texts))
        data, cuts = value_bytes(self.word_ids(words).take(places))
        ends, packed = cuts[ends].tolist(), memoryview(data)
        return [bytes(packed[start:end]) for start, end in zip(ends, ends[1:])]

    def word_ids(self, words: pa.Array) -> pa.Array:
        """The packed ids of distinct words without white space and added tokens (large binary, as the result)."""
        return self._of(words, self._new_words)

    def _of(self, keys: pa.Array, learn: Callable[[pa.Array], pa.Array]) -> pa.Array:
        """The ids of distinct words or pieces; unknown ones are learned and kept."""
        place = pc.index_in(keys, self.keys).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(place < 0)
        self.uses[place[place >= 0]] += 1
        known, values = len(self.keys), self.values
        fresh = keys.take(pa.array(new))
        learned = learn(fresh)
        place[new] = known + np.arange(len(new))
        out = pa.concat_arrays([values, learned]).take(pa.array(place))
        self._keep(fresh, learned)
        return out

    def _keep(self, keys: pa.Array, values: pa.Array) -> None:
        short = pc.less_equal(pc.binary_length(keys), KEPT_BYTES)
        self.keys = pa.concat_arrays([self.keys, keys.filter(short)])
        self.values = pa.concat_arrays([self.values, values.filter(short)])
        self.uses = np.append(self.uses, np.zeros(len(self.keys) - len(self.uses), np.int64))
        if len(self.keys) > self.kept:
            # Half of the room is for what was met most often; older uses count less and less.
            best = np.sort(np.argpartition(-self.uses, self.kept // 2)[: self.kept // 2])
            self.keys, self.values = self.keys.take(pa.array(best)), self.values.take(pa.array(best))
            self.uses = self.uses[best] // 2

    def _new_words(self, words: pa.Array) -> pa.Array:
        """The ids of new words: cut where letters and marks meet, and put together from those pieces."""
        data, starts = value_bytes(words)
        kinds = KINDS[data]
        leads = np.flatnonzero(data == LEAD)
        leads = leads[AFTER_LEAD[data[leads + 1]]]
        kinds[leads] = kinds[leads + 1] = LETTER
        odd = np.append(0, np.cumsum(kinds == 0))[starts]
        odd = np.diff(odd) > 0
        plain = words.filter(pa.array(~odd))
        of_plain = np.repeat(~odd, np.diff(starts))
        data, kinds = data[of_plain], kinds[of_plain]
        starts = value_bytes(plain)[1]
        # Each capital is 32 below its small letter; above ASCII the sharp s and the last letter have none.
        capital = (data >= 0x41) & (data <= 0x5A)
        capital |= np.append(False, data[:-1] == LEAD)[: len(data)] & (kinds == LETTER) & (data < 0x9F)
        data = data + (capital * 0x20).astype(np.uint8)
        cut = np.append(True, kinds[1:] != kinds[:-1])[: len(data)]
        cut[starts[:-1][starts[:-1] < len(data)]] = True
        begins = np.append(np.flatnonzero(cut), len(data))
        pieces = binary_values(begins, data).dictionary_encode()
        ids = self._of(pieces.dictionary, self._learn).take(pieces.indices)
        # A word's ids reach from those of its first piece to those of the next word's first.
        ends = value_bytes(ids)[1][np.searchsorted(begins, starts)]
        composed = binary_values(ends, value_bytes(ids)[0])
        if not odd.any():
            return composed
        rest = self._odd(words.filter(pa.array(odd)).to_pylist())
        place = np.where(odd, len(composed) + np.cumsum(odd) - 1, np.cumsum(~odd) - 1)
        return pa.concat_arrays([composed, rest]).take(pa.array(place))


@functools.cache
def piece_ids(path: str) -> PieceIds:
    """One memory per Python worker, used by all its tasks; the ids are those the library gives by default."""
    encoder = PieceIds(path, special_as_text=False)
    give_back()
    return encoder
