"""URL filter: all glob rules at once by a bit-parallel automaton.

Every rule is a glob over the canonical URL (a dot, the host in lower case, the path). The positions of all globs are
packed one after another into 64-bit words. A step of the automaton reads one character of every URL of a batch and
moves all positions of all rules together: shift (with carries between the words), mask by the character, and keep the
positions that stand on a wildcard. The tables have one row per byte value, so their size is that of the rules alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The letters that are lower-cased.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows that are moved together, and bytes of their states, which bound the memory of a step whatever the rules.
STEP_ROWS = 8192
STEP_BYTES = 16 << 20


@dataclass(frozen=True)
class Rule:
    """``name`` is reported (None: the verdict alone is).

    ``glob`` knows ``?`` (a byte), ``*`` (a run without ``/``) and ``**`` (any run).
    """

    name: str | None
    glob: str
    verdict: str
    rank: int


def site_rule(verdict: str, text: str) -> Rule:
    """A rule ``host/path``: the host and its subdomains, where the path starts so. Longer ones win."""
    host, slash, path = text.partition("/")
    literal = "".join("\\" + c if c in "*?\\" else c for c in host + slash + path)
    return Rule(text, f"*.{literal}**", verdict, len(text))


class Automaton:
    """The packed masks of all globs."""

    def __init__(self, globs: Sequence[str]):
        parsed = [self._parse(glob) for glob in globs]
        bits = sum(len(symbols) + 1 for symbols, _ in parsed)
        self.words = max(1, -(-bits // 64))
        # A row takes a state of all words, and the answer of every glob.
        self.rows = max(1, min(STEP_ROWS, STEP_BYTES // (8 * self.words + len(parsed))))
        self.step = np.zeros((256, self.words), np.uint64)  # positions that may be entered by a byte
        self.stay = np.zeros((256, self.words), np.uint64)  # positions that are kept by a byte
        self.start = np.zeros(self.words, np.uint64)
        self.final = []
        at = 0
        for symbols, loops in parsed:
            self._set(self.start, at)
            for place, symbol in enumerate(symbols, 1):
                for byte in range(256) if symbol is None else (symbol,):
                    self._set(self.step[byte], at + place)
            for place, crosses in loops.items():
                for byte in range(256):
                    if crosses or byte != ord("/"):
                        self._set(self.stay[byte], at + place)
            at += len(symbols) + 1
            self.final.append(at - 1)

    @staticmethod
    def _set(words, bit: int) -> None:
        words[bit >> 6] |= np.uint64(1 << (bit & 63))

    @staticmethod
    def _parse(glob: str) -> tuple[list[int | None], dict[int, bool]]:
        """Bytes (None: any), and the positions with a wildcard (True: it crosses slashes)."""
        data, symbols, loops, i = glob.encode(), [], {}, 0
        while i < len(data):
            if data[i : i + 1] == b"*":
                crosses = data[i + 1 : i + 2] == b"*"
                loops[len(symbols)] = loops.get(len(symbols), False) or crosses
                i += 1 + crosses
            elif data[i : i + 1] == b"?":
                symbols.append(None)
                i += 1
            else:
                i += data[i : i + 1] == b"\\" and i + 1 < len(data)
                symbols.append(data[i])
                i += 1
        return symbols, loops

    def matches(self, texts: Sequence[bytes]) -> np.ndarray:
        """A row per text, a column per glob: does the glob match the whole text."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-lengths, kind="stable")
        data = np.frombuffer(b"".join(texts), np.uint8)
        begin = (np.cumsum(lengths) - lengths)[order]
        ends = -lengths[order]  # ascending
        state = np.tile(self.start, (len(texts), 1))
        for place in range(int(lengths.max(initial=0))):
            active = int(np.searchsorted(ends, -place, "left"))  # texts longer than place
            now = state[:active]
            byte = data[begin[:active] + place]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:active] = (moved & ~self.start & self.step[byte]) | (now & self.stay[byte])
        found = np.empty((len(texts), len(self.final)), bool)
        for column, bit in enumerate(self.final):
            found[order, column] = (state[:, bit >> 6] >> np.uint64(bit & 63)) & np.uint64(1)
        return found


def best_rule(rules: Sequence[Rule]):
    """A column function (host, path) -> number of the winning rule, -1 if none fits.

    The highest rank wins, of equal ranks the rule that stands first.
    """
    ranked = sorted(range(len(rules)), key=lambda i: (-rules[i].rank, i))

    def numbers(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        automaton = Automaton([rules[i].glob for i in ranked])
        number = np.array([*ranked, -1], np.int32)
        for hosts, paths in parts:
            texts = [f".{host}{path}".encode(errors="surrogatepass") for host, path in zip(hosts, paths)]
            out = np.full(len(texts), -1, np.int32)
            for i in range(0, len(texts) if ranked else 0, automaton.rows):
                found = automaton.matches(texts[i : i + automaton.rows])
                first = np.where(found.any(axis=1), found.argmax(axis=1), len(ranked))
                out[i : i + automaton.rows] = number[first]
            yield pd.Series(out)

    return F.pandas_udf(numbers, "int")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, in lower case) and path; both empty for null or without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url", otherwise="allow"):
    """``key``, host, path, rule (null if none fits) and verdict of every row; other columns are left out.

    Null urls have an empty host and path, for which rules may still fit. No row depends on another: nothing is shuffled,
    repeated rows give repeated results, empty tables an empty one.
    """
    host, path = url_parts(F.col(f"`{url}`"))
    parts = pages.select(F.col(f"`{key}`").alias(key), host.alias("host"), path.alias("path"))
    numbered = parts.withColumn("number", best_rule(rules)("host", "path"))
    names = F.array(*[F.lit(rule.name) for rule in rules]).cast("array<string>")
    verdicts = F.array(*[F.lit(rule.verdict) for rule in rules]).cast("array<string>")
    return numbered.select(
        key,
        "host",
        "path",
        F.get(names, F.col("number")).alias("rule"),
        F.coalesce(F.get(verdicts, F.col("number")), F.lit(otherwise)).alias("verdict"),
    )
