"""Quality rules: counts of words, symbols and repetitions, and compression bands.

Whole texts and their fixed chunks are compressed with zstandard. The share of
its bytes that a text keeps falls with its length, so the limits come in bands
of length: below a band's ``least`` a text is repetitive, above its ``most`` it
is incompressible. A text is rejected when it lies outside its band as a whole,
or when more than a share of its bytes stands in chunks that do.

Words are runs of characters other than the blank and the controls 9 to 13.
Repeated words are found on ranks, not on hashes: words get numbers, pairs of
numbers are ranked, then pairs of ranks, up to windows of eight words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import add_columns
from asterism.llm.words import word_numbers

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
DOUBLINGS = 3  # windows of 2**3 words


@dataclass(frozen=True)
class Band:
    """Limits of compressed size over size for texts of fewer than ``below`` bytes."""

    below: float
    least: float
    most: float


# Prose keeps 0.55 to 0.75 of its bytes at 256, half at 2 KB, 0.4 at 16 KB. The
# lower limits lie at about half of that, the upper ones where encoded or random
# bytes begin. The shortest texts carry more header than text and pass.
BANDS = (
    Band(128, 0.0, math.inf),
    Band(256, 0.36, 1.02),
    Band(512, 0.32, 0.92),
    Band(1024, 0.28, 0.85),
    Band(2048, 0.25, 0.78),
    Band(4096, 0.23, 0.74),
    Band(8192, 0.21, 0.70),
    Band(32768, 0.19, 0.68),
    Band(math.inf, 0.15, 0.66),
)


@dataclass(frozen=True)
class Settings:
    least_words: int = 20
    repeat_percent: int = 30
    bands: tuple[Band, ...] = BANDS
    chunk: int = 4096  # bytes
    bad_share: float = 0.3  # of a text's bytes, in chunks outside their band
    level: int = 3  # of the compression

    def outside(self, ratio: float, size: int) -> bool:
        band = next(b for b in self.bands if size < b.below)
        return not band.least <= ratio <= band.most


@lru_cache(maxsize=2)
def _compressor(level: int) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=level)


def ratio(data: bytes, level: int) -> float:
    return len(_compressor(level).compress(data)) / len(data)


def compression(data: bytes, settings: Settings) -> tuple[float | None, float, bool]:
    """Ratio of the whole, share of bytes in chunks outside their band, and whether it passes."""
    if not data:
        return None, 0.0, True
    whole = ratio(data, settings.level)
    outside = settings.outside(whole, len(data))
    if len(data) <= settings.chunk:
        return whole, float(outside), not outside
    bad = 0
    for at in range(0, len(data), settings.chunk):
        part = data[at : at + settings.chunk]
        if settings.outside(ratio(part, settings.level), len(part)):
            bad += len(part)
    share = bad / len(data)
    return whole, share, not outside and share <= settings.bad_share


def repeated_words(numbers: np.ndarray, text_of: np.ndarray, n_texts: int) -> np.ndarray:
    """Words of each text inside windows of eight that stand in it more than once.

    ``numbers`` are the words of all texts in a row, ``text_of`` their texts.
    """
    rank, width = numbers, 1
    for _ in range(DOUBLINGS):
        if len(rank) <= width:
            return np.zeros(n_texts, np.int64)
        pairs = rank[:-width] * np.int64(rank.max() + 1) + rank[width:]
        rank = np.unique(pairs, return_inverse=True)[1]
        width *= 2
    whole = text_of[: len(rank)] == text_of[width - 1 :]
    starts = np.flatnonzero(whole)
    keys = rank[starts] * np.int64(n_texts) + text_of[starts]
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = starts[counts[inverse] > 1]
    steps = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(steps, again, 1)
    np.add.at(steps, again + width, -1)
    covered = np.cumsum(steps[:-1]) > 0
    return np.bincount(text_of[covered], minlength=n_texts)


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


OUTPUTS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_bytes bigint, ratio double, bad_share double, compresses boolean"
)


def measured(df: DataFrame, text: str, settings: Settings) -> DataFrame:
    """Add the counts and the compression of every text."""

    def compute(values: list[str | None]) -> list[pa.Array]:
        texts = [value or "" for value in values]
        coded = [t.encode() for t in texts]
        known: dict[bytes, int] = {}
        numbers = [word_numbers(c, known) for c in coded]
        n_words = np.array([len(n) for n in numbers], np.int64)
        text_of = np.repeat(np.arange(len(texts)), n_words)
        repeats = repeated_words(np.concatenate([*numbers, np.empty(0, np.int64)]), text_of, len(texts))
        squeezed = [compression(c, settings) for c in coded]
        return [
            pa.array(n_words),
            pa.array([len(t) - sum(map(t.count, SPACES)) for t in texts], pa.int64()),
            pa.array([sum(map(t.count, SYMBOLS)) for t in texts], pa.int64()),
            pa.array([duplicate_lines(t) for t in texts], pa.int64()),
            pa.array(repeats, pa.int64()),
            pa.array(map(len, coded), pa.int64()),
            pa.array([s[0] for s in squeezed], pa.float64()),
            pa.array([s[1] for s in squeezed], pa.float64()),
            pa.array([s[2] for s in squeezed], pa.bool_()),
        ]

    return add_columns(df, text, OUTPUTS, compute)


def judge(
    df: DataFrame, id_: str = "doc_id", text: str = "text", settings: Settings | None = None
) -> DataFrame:
    """One row for each row of ``df``: id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_bytes, ratio, bad_share.

    ``base_failed`` says that there are too few words or too many repeated ones;
    ``kept`` that neither this nor the compression rejects the text. Null and
    empty texts have no words, no ratio and fail the base. Texts are measured
    whole, a long one slice by slice; repeated rows are judged one by one, null
    ids too. Other columns are ignored, whatever their names.
    """
    settings = settings or Settings()
    rows = measured(
        df.select(F.col(id_).alias("id"), F.col(text).alias("text")), "text", settings
    ).drop("text")
    failed = (F.col("n_words") < settings.least_words) | (
        100 * F.col("n_repeat_words") > settings.repeat_percent * F.col("n_words")
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select(
        F.col("id").alias(id_),
        *counts,
        failed.alias("base_failed"),
        (~failed & F.col("compresses")).alias("kept"),
        "n_bytes",
        "ratio",
        "bad_share",
    )
