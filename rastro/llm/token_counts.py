"""Token counts of every prefix of a text, under a byte-level BPE vocabulary.

Prefix dynamic programming: the encoding of a prefix is the encoding of a shorter prefix and
one more token, the one token that ends there and may follow the last token before it. A pair
may stand together if the merges, applied to its joined bytes, give the pair again. The step
is run once for each distinct word that a worker meets; a text's table is the row of its
words' tables. So the count of any prefix, and the longest prefix within a budget, are read
off the table and nothing is encoded again.
"""

from __future__ import annotations

import json
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from rastro.llm import common
from rastro.llm.pretokens import SPACE, Cache, pieces, words_of

TABLE = "doc_id long, n_bytes long, n_tokens long, prefix binary"

_WHITE = rf"[{SPACE}  -     　]"
_RUN = re.compile(rf"{_WHITE}{{2,}}(?=.)", re.S)
_WHITE_END = re.compile(rf"(?<!{_WHITE}){_WHITE}")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in vocabulary files of this kind."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Filled(dict):
    def __init__(self, function) -> None:
        self.function = function

    def __missing__(self, key):
        value = self[key] = self.function(key)
        return value


class PrefixCounter:
    """Token counts of prefixes under the vocabulary of a ``tokenizers`` file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.special = [x["content"] for x in model["added_tokens"] if x["special"]]
        self.found = ahocorasick.Automaton()
        for token in model["model"]["vocab"]:
            self.found.add_word(token, token)
        self.found.make_automaton()
        self.known: dict[tuple[str, str], bool] = {}
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"])
        self.rank = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.letters = _byte_letters()
        self.parts = {}
        for pair in self.rank:
            self.parts.setdefault(pair[0] + pair[1], pair)
        # Worked out on first use; at most one entry for each token.
        self.ends = _Filled(lambda token: self._edge(token, 1))
        self.begins = _Filled(lambda token: self._edge(token, 0))
        self.whole = _Filled(lambda token: self._merged(token) == [token])
        self.deltas = Cache(self._deltas)
        self.split = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")

    def _merged(self, letters: str) -> list[str]:
        parts = list(letters)
        while len(parts) > 1:
            best = min(zip(parts, parts[1:]), key=lambda p: self.rank.get(p, 1 << 60))
            if best not in self.rank:
                break
            joined, i = [], 0
            while i < len(parts):
                pair = i + 1 < len(parts) and (parts[i], parts[i + 1]) == best
                joined.append(parts[i] + parts[i + 1] if pair else parts[i])
                i += 1 + pair
            parts = joined
        return parts

    def _edge(self, token: str, side: int) -> tuple[tuple[str, int], ...]:
        """The parts of ``token`` at its end (side 1) or its begin (side 0) while merges build it,
        each with the rank of the merge that takes it up."""
        edge, taken = [], 1 << 60
        while True:
            edge.append((token, taken))
            if token not in self.parts:
                return tuple(edge)
            taken = self.rank[self.parts[token]]
            token = self.parts[token][side]

    def _may_follow(self, a: str, b: str) -> bool:
        """Whether no merge across the border comes before those that build ``a`` and ``b``.
        Of equal merges the leftmost comes first."""
        rank = self.rank.get
        for x, x_taken in self.ends[a]:
            for y, y_taken in self.begins[b]:
                at = rank((x, y))
                if at is not None and at < x_taken and at <= y_taken:
                    return False
        return True

    def _counts(self, word: str) -> list[int]:
        """Tokens of word[:1], word[:2] and so on, the word being one word of the pattern."""
        data = word.encode("utf-8", "surrogatepass")
        letters = data.decode("latin-1").translate(self.letters)
        last, count, known = [""] * (len(data) + 1), [0] * (len(data) + 1), self.known
        # Every token of the vocabulary that ends at each place, the longest first.
        for end, token in self.found.iter(letters):
            end += 1
            if not last[end]:
                start = end - len(token)
                follows = known.get((last[start], token))
                if follows is None:
                    follows = self._may_follow(last[start], token) if start else self.whole[token]
                    if len(known) >= 200_000:
                        known.clear()
                    known[last[start], token] = follows
                if follows:
                    last[end], count[end] = token, count[start] + 1
        if len(data) == len(word):
            return count[1:]
        return [n for n, byte in zip(count[1:], [*data[1:], 0]) if byte & 0xC0 != 0x80]

    def _deltas(self, word: str) -> bytes:
        if word[0] == "'" and len(word) > 1 and word[1].isalpha():
            # A contraction; what is short of it is split otherwise.
            counts = [sum(self._counts(w)[-1] for w in words_of(word[:i])) for i in range(1, len(word) + 1)]
        else:
            counts = self._counts(word)
        return bytes([(b - a) & 255 for a, b in zip([0, *counts], counts)])

    def _plain(self, text: str) -> np.ndarray:
        """Changes of the count from prefix to prefix, for a text without special strings."""
        deltas = self.deltas
        joined = b"".join(deltas[w] for part in pieces(text) for w in words_of(part))
        found = np.frombuffer(joined, np.int8)
        runs = [(m.start(), m.end()) for m in _RUN.finditer(text)]
        if runs:
            found = found.copy()
            for low, high in runs:
                # A prefix that ends with the run has it as one word; in the whole text
                # its last character is the next word's.
                whole = np.frombuffer(deltas[text[low:high]], np.int8).sum(dtype=np.int64)
                apart = found[low:high].sum(dtype=np.int64)
                found[high - 1] += whole - apart
                found[high] -= whole - apart
        return found

    def table(self, text: str) -> bytes:
        """One signed byte for each character; the sum of the first c is the count of text[:c]."""
        marks = list(self.split.finditer(text))
        if not marks:
            return self._plain(text).tobytes()
        out, low = [], 0
        for mark in marks:
            before = text[low : mark.start()]
            out.append(self._plain(before))
            # What is short of the special string is plain text after all.
            start = int(out[-1].sum(dtype=np.int64))
            tail = self._tail(before)
            rest = int(self._plain(before[len(before) - len(tail) :]).sum(dtype=np.int64))
            counts = [start]
            for c in range(1, len(mark[0])):
                counts.append(start - rest + int(self._plain(tail + mark[0][:c]).sum(dtype=np.int64)))
            out.append(np.diff([*counts, start + 1]).astype(np.int8))
            low = mark.end()
        out.append(self._plain(text[low:]))
        return np.concatenate(out).tobytes()

    @staticmethod
    def _tail(text: str) -> str:
        """The end of a text from its last run of white space on, where words surely part."""
        cut = 0
        for found in _WHITE_END.finditer(text):
            cut = found.start()
        return text[cut:]


def _counter(path: str) -> PrefixCounter:
    return common.held(("counter", path), lambda: PrefixCounter(path))


def prefix_tables(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens and ``prefix``, the table of every text.

    ``prefix`` holds one signed byte for each code point: the change of the token count when
    that character joins the prefix. ``tokens_at`` and ``longest_within`` read it. Counts are
    those of the ``tokenizers`` library for the file ``vocabulary``, which every executor must
    have, without begin or end tokens; special strings inside texts count as its special tokens.

    Null texts are empty, empty texts have no tokens and an empty table. Every row gives one
    row, so repeated rows stay repeated; a null doc_id stays null; an empty table gives an
    empty table; other columns are not read, whatever their names. Long texts are split piece
    by piece. Every text is worked on alone, so no shuffle takes place.
    """

    def tables(batches):
        counter = _counter(vocabulary)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            rows, held = [], 0
            start = 0
            for i in range(len(texts)):
                text = texts[i].as_py() or ""
                rows.append((len(text.encode("utf-8", "surrogatepass")), counter.table(text)))
                held += len(text)
                if held > 8 << 20 or i == len(texts) - 1:
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.slice(start, len(rows)).cast(pa.int64()),
                            pa.array([n for n, _ in rows], pa.int64()),
                            pa.array(
                                [int(np.frombuffer(t, np.int8).sum(dtype=np.int64)) for _, t in rows],
                                pa.int64(),
                            ),
                            pa.array([t for _, t in rows], pa.binary()),
                        ],
                        names=["doc_id", "n_bytes", "n_tokens", "prefix"],
                    )
                    start, rows, held = i + 1, [], 0

    return docs.select("doc_id", "text").mapInArrow(tables, TABLE)


@F.pandas_udf(LongType())
def _tokens_at(prefix, chars):
    import pandas as pd

    return pd.Series(
        [
            None if p is None or c is None else int(np.frombuffer(p, np.int8)[: int(c)].sum(dtype=np.int64))
            for p, c in zip(prefix, chars)
        ],
        dtype="Int64",
    )


@F.pandas_udf(LongType())
def _longest_within(prefix, budget):
    import pandas as pd

    def longest(p, b):
        fits = np.flatnonzero(np.cumsum(np.frombuffer(p, np.int8), dtype=np.int64) <= b)
        return int(fits[-1]) + 1 if len(fits) else 0

    return pd.Series(
        [None if p is None or b is None else longest(p, b) for p, b in zip(prefix, budget)], dtype="Int64"
    )


def tokens_at(prefix: Column, chars: Column) -> Column:
    """Tokens of the first ``chars`` characters; of all, if there are fewer."""
    return _tokens_at(prefix, chars)


def longest_within(prefix: Column, budget: Column) -> Column:
    """Characters of the longest prefix with at most ``budget`` tokens."""
    return _longest_within(prefix, budget)
