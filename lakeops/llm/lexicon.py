"""A minimal acyclic transducer of words, in one file that workers map into memory.

Words that end alike share the states of their endings, so the automaton has one state for each set of possible endings.
Its arcs carry numbers that add up along a word to its place among all words in byte order, and under that place stand the
word's output ids. Arcs lie in an open hash table by state and byte, so a batch of words is looked up byte by byte at once.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs

from lakeops.llm.storage import created, opened
from lakeops.llm.tokens import binary_values, value_bytes

#: Arrays begin at multiples of this many bytes.
ALIGNED = 64
EMPTY = -1


class Automaton:
    """The states of sorted distinct words: ``arcs`` holds (label, target) pairs of each, children before parents."""

    def __init__(self, words: Sequence[bytes]):
        register: dict[tuple, int] = {}
        # One state per byte of the last word is still open: its arcs, and whether a word ends there. The target of the
        # last arc is known when the state below is closed.
        open_arcs, ends, last = [[]], [False], b""

        def close(depth: int) -> None:
            while len(open_arcs) > depth + 1:
                state = (ends.pop(), *open_arcs.pop())
                open_arcs[-1].append(register.setdefault(state, len(register)))

        for word in words:
            same, shorter = 0, min(len(word), len(last))
            while same < shorter and word[same] == last[same]:
                same += 1
            close(same)
            for byte in word[same:]:
                open_arcs[-1].append(byte)
                open_arcs.append([])
                ends.append(False)
            ends[-1] = True
            last = word
        close(0)
        self.root = register.setdefault((ends[0], *open_arcs[0]), len(register))
        self.states = list(register)

    def arrays(self) -> dict[str, np.ndarray]:
        """Whether a word ends in each state, and its arcs by hash slot: key (state and byte), target, number."""
        words, keys, targets, adds = [], [], [], []
        for number, (end, *arcs) in enumerate(self.states):
            below = int(end)
            for label, target in zip(arcs[::2], arcs[1::2]):
                keys.append(number << 8 | label)
                targets.append(target)
                adds.append(below)
                below += words[target]
            words.append(below)
        bits = max(1, (2 * len(keys)).bit_length())
        slots, keys = np.full(1 << bits, EMPTY, np.int64), np.array(keys, np.int64)
        place, left = _hashed(keys, bits), np.arange(len(keys))
        taken = np.zeros(len(keys), np.int64)
        while len(left):
            free = left[slots[place[left]] == EMPTY]
            slots[place[free]] = keys[free]  # of those that meet in a slot one stays
            won = free[slots[place[free]] == keys[free]]
            taken[won] = place[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            place[left] = (place[left] + 1) & ((1 << bits) - 1)
        table = {"slots": slots}
        for name, values in (("targets", targets), ("adds", adds)):
            table[name] = np.zeros(1 << bits, np.int32)
            table[name][taken] = values
        return {"ends": np.array([state[0] for state in self.states], bool), **table}


def _hashed(keys: np.ndarray, bits: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def write_lexicon(uri: str, words: Sequence[bytes], outputs: pa.Array) -> dict[str, int]:
    """Write the automaton of sorted distinct words with their outputs (large binary), and return its counts."""
    automaton = Automaton(words)
    data, places = value_bytes(outputs)
    arrays = {**automaton.arrays(), "places": places, "data": data}
    head, at = {}, 0
    for name, values in arrays.items():
        head[name] = (values.dtype.str, len(values), at)
        at += -(-values.nbytes // ALIGNED) * ALIGNED
    text = json.dumps({"root": automaton.root, "arrays": head}).encode()
    with created(uri) as out:
        out.write(len(text).to_bytes(8, "little") + text + bytes(-(8 + len(text)) % ALIGNED))
        for values in arrays.values():
            out.write(values.tobytes() + bytes(-values.nbytes % ALIGNED))
    return {"words": len(words), "states": len(automaton.states), "arcs": int((arrays["slots"] != EMPTY).sum())}


class Lexicon:
    """A written automaton, opened for look-ups."""

    def __init__(self, uri: str):
        fs, path = opened(uri)
        # Mapped where the shared folder is mounted; from another store it is read once a worker.
        local = isinstance(fs, pafs.LocalFileSystem)
        raw = np.memmap(path, np.uint8, "r") if local else np.frombuffer(fs.open_input_file(path).read_buffer(), np.uint8)
        length = int.from_bytes(raw[:8].tobytes(), "little")
        head = json.loads(raw[8 : 8 + length].tobytes())
        start = -(-(8 + length) // ALIGNED) * ALIGNED
        arrays = {}
        for name, (kind, count, at) in head["arrays"].items():
            size = count * np.dtype(kind).itemsize
            arrays[name] = raw[start + at : start + at + size].view(kind)
        self.root, self.bits = head["root"], len(arrays["slots"]).bit_length() - 1
        self.slots, self.targets, self.adds, self.ends = (arrays[n] for n in ("slots", "targets", "adds", "ends"))
        self.outputs = binary_values(arrays["places"], arrays["data"])

    def find(self, words: pa.Array) -> np.ndarray:
        """The place of each word (large binary), or -1 for words that the automaton does not hold."""
        data, starts = value_bytes(words)
        lengths, found = np.diff(starts), np.full(len(words), -1, np.int64)
        state, number = np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        alive, mask, at = np.arange(len(words)), (1 << self.bits) - 1, 0
        while len(alive):
            done = lengths[alive] == at
            over = alive[done]
            over = over[self.ends[state[over]]]
            found[over] = number[over]
            alive = alive[~done]
            key = state[alive] << 8 | data[starts[alive] + at]
            slot = _hashed(key, self.bits)
            held = self.slots[slot]
            while len(off := np.flatnonzero((held != key) & (held != EMPTY))):
                slot[off] = (slot[off] + 1) & mask
                held[off] = self.slots[slot[off]]
            goes = held == key
            alive, slot = alive[goes], slot[goes]
            number[alive] += self.adds[slot]
            state[alive] = self.targets[slot]
            at += 1
        return found


@functools.lru_cache(2)
def lexicon(uri: str) -> Lexicon:
    """One open file per worker and lexicon."""
    return Lexicon(uri)
