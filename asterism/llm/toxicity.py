"""Toxicity as an ordered severity, by cumulative-link regression on sparse words.

A text's features are the log counts of a bounded list of words and word
beginnings, those whose presence differs most between marked and unmarked
documents of the labelled sample. Beginnings stand for families of words, of
which a sample knows a part only. One weight for each feature is shared by all
thresholds:
P(grade >= k) = 1 / (1 + exp(threshold_k - weights . features)). The expected
severity is the sum of these probabilities.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import add_columns, stored
from asterism.session import scratch_released

EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„’‘…–—¿¡"
BEGINNINGS = (4, 5, 6, 7)  # characters
MAX_CACHE = 50_000  # words a task remembers


@dataclass(frozen=True)
class Settings:
    """``per_class`` bounds the labelled rows learned from, those of lowest hash of
    the id; ``words`` the features. A feature has to be ``lift`` times as common
    on one side as on the other."""

    per_class: int = 2000
    words: int = 512
    lift: float = 3.0
    severities: int = 2
    penalty: float = 1e-4
    steps: int = 400
    seed: int = 11


def features_of(word: str) -> tuple[str, ...]:
    """A lower-cased word without the punctuation at its ends, and its beginnings."""
    word = word.strip(EDGES)
    begins = tuple(f"{word[:n]}*" for n in BEGINNINGS if len(word) > n)
    return (word, *begins) if word else ()


class _Index(dict):
    """Raw word -> numbers of its features; forgets everything when it is full."""

    def __init__(self, features: dict[str, int]):
        super().__init__()
        self.features = features

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= MAX_CACHE:
            self.clear()
        numbers = (self.features.get(f, -1) for f in features_of(word))
        found = self[word] = tuple(n for n in numbers if n >= 0)
        return found


@dataclass(frozen=True)
class Model:
    words: tuple[str, ...]
    weights: np.ndarray
    thresholds: np.ndarray  # rising; none: every text has severity 0
    cut: float = 0.0  # log-odds of a grade above 0 from which a text counts as toxic

    def index(self) -> _Index:
        return _Index({word: i for i, word in enumerate(self.words)})

    def above(self, texts: list[str | None], index: _Index) -> np.ndarray:
        """P(grade >= k) for k = 1 and on, one row for each text."""
        sums = np.zeros(len(texts))
        for i, text in enumerate(texts):
            found = [f for f in map(index.__getitem__, (text or "").lower().split()) if f]
            for feature, count in Counter(chain.from_iterable(found)).items():
                sums[i] += self.weights[feature] * np.log1p(count)
        return 1 / (1 + np.exp(np.clip(self.thresholds - sums[:, None], -500, 500)))


def fit_ordinal(
    x: np.ndarray, grades: np.ndarray, penalty: float, steps: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds of a cumulative-link model with logistic link.

    Gradient steps with momentum and per-parameter scaling on the mean negative
    log-likelihood plus ``penalty`` times the squared weights. Grades run from
    0 without gaps.
    """
    n, width = x.shape
    top = int(grades.max())
    share = np.array([(grades >= k).mean() for k in range(1, top + 1)])
    start = np.log((1 - share) / share)
    gaps = np.log(np.maximum(np.diff(start), 1e-2))
    params = np.concatenate([np.zeros(width), start[:1], gaps])
    first, second = np.zeros_like(params), np.zeros_like(params)
    rows = np.arange(n)

    def thresholds(params: np.ndarray) -> np.ndarray:
        return np.cumsum(np.concatenate([params[width : width + 1], np.exp(params[width + 1 :])]))

    for step in range(1, steps + 1):
        theta = thresholds(params)
        edges = np.concatenate([[-np.inf], theta, [np.inf]])
        eta = (x @ params[:width])[:, None]
        below = 1 / (1 + np.exp(np.clip(eta - edges, -50, 50)))  # P(grade < k)
        below[:, 0], below[:, -1] = 0, 1
        low, high = below[rows, grades], below[rows, grades + 1]
        p = np.maximum(high - low, 1e-12)
        d_eta = low + high - 1  # of the log-likelihood
        slope = np.zeros((n, top + 2))
        slope[rows, grades + 1] += high * (1 - high) / p
        slope[rows, grades] -= low * (1 - low) / p
        d_theta = slope[:, 1:-1].mean(0)
        after = np.cumsum(d_theta[::-1])[::-1]
        gradient = np.concatenate(
            [
                2 * penalty * params[:width] - x.T @ d_eta / n,
                -after[:1],
                -after[1:] * np.exp(params[width + 1 :]),
            ]
        )
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        scale = np.sqrt(second / (1 - 0.999**step)) + 1e-8
        params -= 0.05 * first / (1 - 0.9**step) / scale
    return params[:width], thresholds(params)


def best_cut(odds: np.ndarray, marked: np.ndarray, dear: float = 5.0) -> float:
    """Where the share of marked rows found, less ``dear`` times that of clean rows
    taken for marked, is largest; the middle of that range."""
    order = np.argsort(-odds, kind="stable")
    odds, marked = odds[order], marked[order]
    gain = np.cumsum(marked) / marked.sum() - dear * np.cumsum(~marked) / (~marked).sum()
    gain[:-1][odds[:-1] == odds[1:]] = -np.inf  # equal rows fall on one side
    at = int(np.argmax(gain))
    return float((odds[at] + odds[min(at + 1, len(odds) - 1)]) / 2)


def train(documents: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model:
    """Learn from at most ``per_class`` marked and as many unmarked labelled rows.

    ``documents`` has id and text, ``labels`` id and grade: whole numbers, 0
    for not toxic. Where the labels only tell 0 from 1, marked rows are graded
    1 to ``severities`` in equal parts by how many harsh words they have, those
    that go along with marked rows. The sample is halved for that, and each
    half is graded by words chosen on the other, so no row's grade comes from
    words that it helped to choose. Null labels, and labels without a document, are not
    used; an id with several labels or texts counts once, with the largest.
    """
    settings = settings or Settings()
    known = labels.filter("id IS NOT NULL AND grade IS NOT NULL").groupBy("id")
    known = known.agg(F.max(F.col("grade").cast("int")).alias("grade"))
    hashed = F.xxhash64("id", F.lit(settings.seed))

    def lowest(rows: DataFrame) -> DataFrame:
        return rows.orderBy(hashed, "id").limit(settings.per_class)

    chosen = lowest(known.filter("grade > 0")).unionByName(lowest(known.filter("grade <= 0")))
    # At most 2 * per_class ids, so the broadcast has a fixed bound.
    sample = documents.select("id", "text").join(F.broadcast(chosen), "id")
    sample = sample.groupBy("id", "grade").agg(F.max("text").alias("text"))

    def compute(texts: list) -> list[pa.Array]:
        split = [(text or "").lower().split() for text in texts]
        counted = [Counter(chain.from_iterable(map(features_of, words))) for words in split]
        return [
            pa.array([list(words) for words in counted], pa.list_(pa.string())),
            pa.array([list(words.values()) for words in counted], pa.list_(pa.int64())),
        ]

    counted = add_columns(sample, "text", "words array<string>, counts array<bigint>", compute)
    with scratch_released(documents.sparkSession):
        return _fit(stored(counted.drop("text"), "sample"), settings)


def _stood_out(a: Column, n: Column, marked: int, clean: int) -> dict[str, Column]:
    """ratio and score of a word that ``a`` of ``marked`` rows have, and ``n`` of all."""
    b = (n - a + 0.5) / (clean + 1)
    a = (a + 0.5) / (marked + 1)
    both = (a + b) / 2
    return {"ratio": a / b, "score": (a - b) * (a - b) / (both * (1 - both))}


def _fit(counted: DataFrame, settings: Settings) -> Model:
    none = Model((), np.zeros(0), np.zeros(0))
    half = (F.pmod(F.xxhash64("id", F.lit(settings.seed + 1)), F.lit(2))).cast("int").alias("half")
    counted = counted.select("*", half, (F.col("grade") > 0).cast("int").alias("marked"))
    sizes = {(r["half"], r["marked"]): r["n"] for r in counted.groupBy("half", "marked").agg(F.count("*").alias("n")).collect()}
    marked, clean = (sum(sizes.get((h, m), 0) for h in (0, 1)) for m in (1, 0))
    if not marked:
        return none
    exploded = counted.select("half", "marked", F.explode("words").alias("word"))
    # Rows that have the word, and marked ones among them: in the sample, and in each half of it.
    sums = [F.sum("marked").alias("a"), F.count("*").alias("n")]
    for h in (0, 1):
        sums += [F.sum(F.when(F.col("half") == h, F.col("marked")).otherwise(0)).alias(f"a{h}"),
                 F.count_if(F.col("half") == h).alias(f"n{h}")]
    stats = stored(exploded.groupBy("word").agg(*sums), "word_stats")

    # The number of features bounds what comes to the driver.
    def best(a: str, n: str, marked: int, clean: int, lifted: Column) -> list[str]:
        known = stats.withColumns(_stood_out(F.col(a), F.col(n), marked, clean)).filter(lifted)
        rows = known.orderBy(F.desc("score"), "word").limit(settings.words).select("word").collect()
        return [row["word"] for row in rows]

    more = F.col("ratio") >= settings.lift
    words = tuple(best("a", "n", marked, clean, more | (F.col("ratio") <= 1 / settings.lift)))
    harsh = [best(f"a{h}", f"n{h}", sizes.get((h, 1), 0), sizes.get((h, 0), 0), more) for h in (0, 1)]
    listed = [*words, *sorted({word for some in harsh for word in some} - set(words))]
    number = {word: i for i, word in enumerate(listed)}
    # At most three times ``words`` words, so the broadcast has a fixed bound.
    wanted = counted.sparkSession.createDataFrame([(word,) for word in listed], "word string")
    pair = F.explode(F.arrays_zip("words", "counts")).alias("pair")
    places = counted.select("id", pair).select("id", F.col("pair.words").alias("word"), F.col("pair.counts").alias("n"))
    places = places.join(F.broadcast(wanted), "word").toArrow().to_pydict()
    rows = sorted(counted.select("id", "grade", "half").collect(), key=lambda r: r["id"])
    place = {row["id"]: i for i, row in enumerate(rows)}
    x = np.zeros((len(rows), len(listed)))
    for id_, word, n in zip(places["id"], places["word"], places["n"], strict=True):
        x[place[id_], number[word]] = n
    grades = np.array([max(row["grade"], 0) for row in rows])
    if grades.max() == 1 and settings.severities > 1:
        halves = np.array([row["half"] for row in rows])
        for h in (0, 1):
            mine = (halves == h) & (grades > 0)
            if mine.any():
                amounts = x[np.ix_(mine, [number[word] for word in harsh[1 - h]])].sum(1)
                cuts = np.quantile(amounts, np.arange(1, settings.severities) / settings.severities)
                grades[mine] = 1 + (amounts[:, None] > cuts).sum(1)
    x = x[:, : len(words)]
    _, grades = np.unique(grades, return_inverse=True)
    if not clean:  # one grade less would be 0: every text is as bad as the sample
        grades = grades + 1
        share = np.array([(grades >= k).mean() for k in range(1, grades.max() + 1)])
        return Model((), np.zeros(0), np.log((1 - share + 1e-9) / (share + 1e-9)))
    x = np.log1p(x)
    weights, thresholds = fit_ordinal(x, grades, settings.penalty, settings.steps)
    return Model(words, weights, thresholds, best_cut(x @ weights - thresholds[0], grades > 0))


def severity(
    df: DataFrame,
    model: Model,
    text: str = "text",
    out: str = "severity",
    flag: str = "toxic",
    grade: str = "grade",
) -> DataFrame:
    """Add the expected severity, the likeliest grade, and toxic: the odds of a grade
    above 0 reach the model's cut.

    Whole texts of any length are scored; a null text scores like an empty one,
    which has no words. A model learned without marked rows finds nothing
    toxic. Rows that repeat score alike. Columns named like an output are
    replaced, all others are kept.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def compute(texts: list) -> list[pa.Array]:
        model = shared.value
        key = id(model)
        if key not in _indexes:
            _indexes.clear()
            _indexes[key] = (model, model.index())  # holds the model, so its id stays its own
        above = model.above(texts, _indexes[key][1])
        ones, zeros = np.ones((len(texts), 1)), np.zeros((len(texts), 1))
        bounds = np.hstack([ones, above, zeros])
        likeliest = np.argmax(bounds[:, :-1] - bounds[:, 1:], axis=1)
        any_ = above[:, 0] >= 1 / (1 + np.exp(-model.cut)) if above.shape[1] else zeros[:, 0] > 0
        return [
            pa.array(above.sum(1), pa.float64()),
            pa.array(likeliest, pa.int32()),
            pa.array(any_, pa.bool_()),
        ]

    outputs = f"`{out}` double, `{grade}` int, `{flag}` boolean"
    return add_columns(df, text, outputs, compute, finish=lambda: _indexes.clear())


# The index of the model in use, while a task of the Python worker runs.
_indexes: dict[int, tuple[Model, _Index]] = {}
