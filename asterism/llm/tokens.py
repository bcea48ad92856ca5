"""Token counts of a unigram vocabulary, without the tokens.

The text is cut in front of every blank, each piece standing for itself (the
blank becomes the vocabulary's word mark). An Aho-Corasick automaton lists all
vocabulary entries in a piece by their end, the longest first, and dynamic
programming carries for each position the best score and the number of tokens
of the path that has it. Scores are double precision; on a tie the entry that
begins first wins, as it is tried first and only a better one replaces it. A
character that no entry covers on its own costs the smallest score less 10, and
counts as its UTF-8 bytes if the vocabulary has an entry for every byte.

Pieces repeat, so their counts are kept in a bounded cache. White space that no
entry contains cuts a piece further: no path can step over it.
"""

from __future__ import annotations

from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from asterism.llm.common import add_columns

MARK = "▁"  # stands for a blank
UNKNOWN_PENALTY = 10.0
MAX_CACHE = 100_000  # pieces a Python worker remembers, and as many older ones


@dataclass(frozen=True)
class Vocabulary:
    """Entries and scores by id; ``unknown`` is the id of the unknown token."""

    entries: tuple[tuple[str, float], ...]
    unknown: int = 0

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Entries and scores of a sentencepiece model file."""
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        return cls(tuple((model.id_to_piece(i), model.get_score(i)) for i in ids), model.unk_id())

    def has_bytes(self) -> bool:
        known = {entry for entry, _ in self.entries}
        return all(f"<0x{i:02X}>" in known for i in range(256))


class Counter(dict):
    """Piece (without its mark) -> number of tokens."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for entry, score in vocabulary.entries:
            if entry:
                self.automaton.add_word(entry, (len(entry), score))
        self.automaton.make_automaton()
        self.single = {entry for entry, _ in vocabulary.entries if len(entry) == 1}
        self.unknown = min((s for _, s in vocabulary.entries), default=0.0) - UNKNOWN_PENALTY
        self.by_bytes = vocabulary.has_bytes()
        inside = set("".join(entry for entry, _ in vocabulary.entries))
        self.cuts = "".join(c for c in "\n\t\r\f\v" if c not in inside)
        self.older: dict[str, int] = {}

    def viterbi(self, piece: str) -> int:
        """Tokens of the best path through a piece."""
        n = len(piece)
        best = [0.0] + [float("-inf")] * n
        count = [0] * (n + 1)
        if self.single.issuperset(piece):
            for last, (length, score) in self.automaton.iter(piece):
                start = last + 1 - length
                total = best[start] + score
                if total > best[last + 1]:
                    best[last + 1] = total
                    count[last + 1] = count[start] + 1
            return count[n]

        unknown = [False] * (n + 1)  # the path's last token is the unknown one
        settled = 0

        def settle(end: int) -> None:
            # The unknown token begins last of all that end here, so it is tried last.
            char = piece[end - 1]
            if char not in self.single and best[end - 1] + self.unknown > best[end]:
                best[end] = best[end - 1] + self.unknown
                unknown[end] = True
                if self.by_bytes:
                    count[end] = count[end - 1] + len(char.encode())
                else:  # neighbouring unknown characters are one token
                    count[end] = count[end - 1] + (not unknown[end - 1])

        for last, (length, score) in self.automaton.iter(piece):
            while settled < last:
                settled += 1
                settle(settled)
            start = last + 1 - length
            total = best[start] + score
            if total > best[last + 1]:
                best[last + 1] = total
                count[last + 1] = count[start] + 1
        while settled < n:
            settled += 1
            settle(settled)
        return count[n]

    def __missing__(self, piece: str) -> int:
        # Only with byte tokens, or unknown characters on both sides of a cut would join.
        if self.by_bytes:
            for cut in self.cuts:
                if cut in piece:
                    parts = piece.split(cut)
                    return len(parts) - 1 + sum(self[part] for part in parts if part)
        found = self.older.get(piece)
        if found is None:
            found = self.viterbi(piece)
            if len(piece) > 100:  # hardly repeats
                return found
        if len(self) >= MAX_CACHE:
            self.older = dict(self)
            self.clear()
        self[piece] = found
        return found

    def count(self, text: str | None) -> int:
        """Tokens of a whole text; none in an empty one."""
        if not text:
            return 0
        pieces = text.replace(" ", MARK).split(MARK)
        if not pieces[0]:  # the text begins with a mark of its own
            pieces = pieces[1:]
        return sum(map(self.__getitem__, [MARK + piece for piece in pieces]))


_counters: dict[int, tuple[Vocabulary, Counter]] = {}


class Unigram:
    """A vocabulary, broadcast once; its size is that of the file, not of the data."""

    def __init__(self, spark, vocabulary: Vocabulary):
        self._shared = spark.sparkContext.broadcast(vocabulary)

    def count(self, df: DataFrame, text: str = "text", out: str = "n_tokens") -> DataFrame:
        """Add the number of tokens of every whole text.

        Null and empty texts have none. Rows that repeat count alike. A column
        named like the output is replaced, all others are kept.
        """
        shared = self._shared

        def compute(texts: list) -> list[pa.Array]:
            vocabulary = shared.value
            if id(vocabulary) not in _counters:
                _counters.clear()
                _counters[id(vocabulary)] = (vocabulary, Counter(vocabulary))
            counter = _counters[id(vocabulary)][1]
            return [pa.array(map(counter.count, texts), pa.int64())]

        return add_columns(df, text, f"`{out}` bigint", compute)
