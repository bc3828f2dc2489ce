"""Quality classifier from weak labels.

Heuristic labellers vote good (1), bad (0) or abstain (2) on each text. Over all texts only the
counts of vote patterns are kept, at most 3 ^ labellers of them. Expectation-maximisation over the
pattern counts estimates each labeller's vote probabilities among good and among bad texts, and with
them a pattern's posterior. A linear scorer on hashed words and word shapes is then trained on
posteriors as soft labels, and scores every text, also where all labellers abstain.

The scorer is fitted on a bounded sample, at most `fit_rows` texts drawn by the hash of id and text, in
which rows that repeat both count once; counts, posteriors and scores cover all texts.
Null and empty texts have no words: they are scored 0 by rule and not kept. Repeated rows are scored
alike. An empty table gives an empty result. Without any sample the posterior is the score.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from igarape.llm.common import map_arrow, texts
from igarape.llm.quality_rules import STOP_WORDS

ABSTAIN = 2
_SYMBOLS = b"#*$%&|<>"
_STOP = frozenset(STOP_WORDS)
_SHAPE = ((re.compile(r"[^\W\d_A-ZÀ-Þ]+"), "a"), (re.compile(r"[^\W\d_a]+"), "A"), (re.compile(r"\d+"), "0"))


def _between(value: float, bad_below: float, good_from: float) -> int:
    return 1 if value >= good_from else 0 if value < bad_below else ABSTAIN


def _most(value: float, good_to: float, bad_above: float) -> int:
    return 1 if value <= good_to else 0 if value > bad_above else ABSTAIN


def votes(text: str, words: list[str]) -> tuple[int, ...]:
    """One vote per labeller."""
    n = max(1, len(words))
    data = text.encode()
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    upper = sum(map(str.isupper, words))
    stops = len([w for w in words if w.lower().strip(".,;:!?") in _STOP])
    lines = [x for x in text.split("\n") if x.strip()]
    mean = sum(map(len, words)) / n
    return (
        _between(len(words), 1, 20),
        _most(symbols / n, 0.02, 0.2),
        _most(text.count("!") / n, 0.1, 0.4),
        _most(upper / n, 0.2, 0.5),
        _between(stops / n, 0.03, 0.1) if len(words) >= 20 else ABSTAIN,
        1 if 2.5 <= mean <= 12 else 0,
        _between(len(set(words)) / n, 0.2, 0.35),
        _most(1 - len(set(lines)) / max(1, len(lines)), 0.1, 0.4),
        _most(sum(map(eq, words, words[1:])) / n, 0.05, 0.2),
    )


LABELLERS = 9


def pattern(cast: tuple[int, ...]) -> int:
    number = 0
    for vote in cast:
        number = number * 3 + vote
    return number


def _digits(patterns: np.ndarray) -> np.ndarray:
    return np.stack([patterns // 3 ** (LABELLERS - 1 - i) % 3 for i in range(LABELLERS)], axis=1)


@dataclass(frozen=True)
class LabelModel:
    """`share` of good texts; `chances`[labeller, class, vote]. Abstaining tells nothing."""

    share: float
    chances: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability that a text with these votes is good."""
        digits = _digits(np.asarray(patterns))
        told = np.concatenate((np.log(self.chances), np.zeros((LABELLERS, 2, 1))), axis=2)
        logs = told[np.arange(LABELLERS)[None, :], :, digits].sum(axis=1)
        logs = logs + np.log([1 - self.share, self.share])
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -700, 700)))

    def accuracies(self) -> np.ndarray:
        """Share of right votes of each labeller when it votes."""
        right = (1 - self.share) * self.chances[:, 0, 0] + self.share * self.chances[:, 1, 1]
        wrong = (1 - self.share) * self.chances[:, 0, 1] + self.share * self.chances[:, 1, 0]
        return right / (right + wrong)


#: Expected shares of votes bad and good among bad and among good texts: labellers look for different
#: faults, so that a bad text has few bad votes and a good text next to none.
PRIOR = np.array([[0.2, 0.8], [0.002, 0.998]])


def fit_labels(
    patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, strength: float = 0.03, alarms: float = 0.01
) -> LabelModel:
    """Expectation-maximisation over pattern counts, begun at the majority vote.

    `PRIOR` counts as much as `strength` of all texts in each class, and a labeller's share of bad
    votes among good texts is held at `alarms` or less. Without that, the two classes split the
    texts by one frequent fault and count texts with another as good.
    """
    if not len(patterns):
        return LabelModel(0.5, np.broadcast_to(PRIOR, (LABELLERS, 2, 2)))
    digits = _digits(patterns)
    prior = strength * counts.sum() + 1
    good, bad = (digits == 1).sum(axis=1), (digits == 0).sum(axis=1)
    belief = (good + 0.5) / (good + bad + 1.0)
    model = None
    for _ in range(rounds):
        weights = np.stack([counts * (1 - belief), counts * belief], axis=1)
        share = (weights[:, 1].sum() + 1) / (weights.sum() + 2)
        chances = np.empty((LABELLERS, 2, 2))
        for vote in range(2):
            chances[:, :, vote] = (digits == vote).T.astype(float) @ weights + prior * PRIOR[:, vote]
        chances /= chances.sum(axis=2, keepdims=True)
        wrong = np.minimum(chances[:, 1, 0], alarms)
        chances[:, 1] = np.stack([wrong, 1 - wrong], axis=1)
        model = LabelModel(float(share), chances)
        new = model.posterior(patterns)
        if np.abs(new - belief).max() < 1e-9:
            break
        belief = new
    return model


class _Cells(dict):
    """Hashed cells of a word and of its shape, remembered for up to `most` words."""

    def __init__(self, size: int, most: int = 200_000):
        self._size, self._most = size, most

    def __missing__(self, word: str) -> tuple[int, int]:
        if len(self) > self._most:
            self.clear()
        shape = word
        for expression, sign in _SHAPE:
            shape = expression.sub(sign, shape)
        pair = (
            zlib.crc32(b"w" + word.lower().encode()) % self._size,
            zlib.crc32(b"s" + shape.encode()) % self._size,
        )
        if len(word) <= 64:
            self[word] = pair
        return pair


def _features(words: list[str], cells: _Cells) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells and the weights of a text; squares of all weights add up to 1."""
    found = np.fromiter((c for pair in map(cells.__getitem__, words) for c in pair), "i8", 2 * len(words))
    own, counts = np.unique(found, return_counts=True)
    weights = np.sqrt(counts)
    return own, weights / np.sqrt((weights**2).sum())


def train(rows: list[tuple[np.ndarray, np.ndarray, float]], size: int, rounds: int = 12, rate: float = 0.5):
    """Weights and bias of a logistic scorer on soft labels, by adaptive steps over small blocks."""
    weights, bias = np.zeros(size), 0.0
    squares, bias_square = np.full(size, 1e-6), 1e-6
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for block in np.array_split(order.permutation(len(rows)), max(1, len(rows) // 64)):
            own = np.concatenate([rows[i][0] for i in block])
            value = np.concatenate([rows[i][1] for i in block])
            of = np.repeat(np.arange(len(block)), [len(rows[i][0]) for i in block])
            score = np.bincount(of, weights[own] * value, minlength=len(block)) + bias
            error = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - np.array([rows[i][2] for i in block])
            slope = np.bincount(own, error[of] * value, minlength=size) / len(block)
            squares += slope**2
            weights -= rate * slope / np.sqrt(squares)
            step = error.mean()
            bias_square += step**2
            bias -= rate * step / np.sqrt(bias_square)
    return weights, bias


def classify(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    fit_rows: int = 6000,
    size: int = 1 << 16,
    least: float = 0.5,
) -> DataFrame:
    """(doc_id, pattern, posterior, score, kept): kept if posterior and score are `least` on average.

    The labels and the scorer are fitted at once.
    """
    context = docs.sparkSession.sparkContext
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def start_votes():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            values = [x.decode() for x in texts(batch.column(0))]
            return pa.RecordBatch.from_arrays([pa.array([pattern(votes(x, x.split())) for x in values], pa.int64())], ["pattern"])

        return one

    counted = map_arrow(plain.select("text"), "pattern long", start_votes).groupBy("pattern").count().collect()
    total = sum(row["count"] for row in counted)
    seen = sorted((row["pattern"], row["count"]) for row in counted)
    model = fit_labels(np.array([x for x, _ in seen], "i8"), np.array([n for _, n in seen], "f8"))

    def start_sample():
        cells = _Cells(size)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys, own, values, labels = [], [], [], []
            for key, value in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                words = (value := value.decode()).split()
                if words:
                    keys.append(key)
                    cell, weight = _features(words, cells)
                    own.append(cell.astype("i4"))
                    values.append(weight.astype("f4"))
                    labels.append(pattern(votes(value, words)))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(own, pa.list_(pa.int32())),
                    pa.array(values, pa.list_(pa.float32())),
                    pa.array(labels, pa.int64()),
                ],
                ["key", "own", "weights", "pattern"],
            )

        return one

    # A tenth more by share than needed, so that the hard bound below cuts a few rows only.
    parts = 1 << 30
    keyed = plain.select(F.xxhash64("doc_id", "text").alias("key"), "text")
    chosen = F.pmod("key", F.lit(parts)) < int(parts * min(1.0, 1.1 * fit_rows / max(1, total)))
    found = map_arrow(
        keyed.filter(chosen).dropDuplicates(["key"]),
        "key long, own array<int>, weights array<float>, pattern long",
        start_sample,
    )
    table = found.orderBy("key").limit(fit_rows).toArrow()
    rows = []
    if table.num_rows:
        belief = model.posterior(table.column("pattern").to_numpy())
        order = []
        for own, weight, label in zip(table.column("own"), table.column("weights"), belief.tolist()):
            pair = own.values.to_numpy().astype("i8"), weight.values.to_numpy().astype("f8")
            order.append((zlib.crc32(pair[0].tobytes()), pair[1].tobytes(), *pair, label))
        order.sort(key=lambda x: x[:2])  # not the order in which tasks end
        rows = [x[2:] for x in order]
    weights, bias = train(rows, size) if rows else (None, 0.0)
    shared = context.broadcast((model, weights, bias))  # `size` numbers at most

    def start_scores():
        model, weights, bias = shared.value
        cells = _Cells(size)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            found, scores = [], []
            for value in texts(batch.column(1)):
                words = (value := value.decode()).split()
                found.append(pattern(votes(value, words)))
                if words and weights is not None:
                    own, weight = _features(words, cells)
                    scores.append(1 / (1 + np.exp(-float(np.clip(weights[own] @ weight + bias, -30, 30)))))
                else:
                    scores.append(None if words else 0.0)
            found = np.array(found, "i8")
            belief = model.posterior(found)
            score = np.array([b if s is None else s for s, b in zip(scores, belief.tolist())], "f8")
            kept = (score + belief) / 2 >= least
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found), pa.array(belief), pa.array(score), pa.array(kept)],
                ["doc_id", "pattern", "posterior", "score", "kept"],
            )

        return one

    return map_arrow(plain, "doc_id long, pattern long, posterior double, score double, kept boolean", start_scores)
