"""Quality of texts by Bradley-Terry ranking.

Every labelled text is a player whose strength is a linear function of its features; in
a pair of a good and a bad text the good one wins. The weights maximise the likelihood
of the outcomes: logistic loss on the differences of the features, without a bias. The
accepting strength is the quantile of the sample's strengths that leaves below it the
share of bad texts, and ``score`` is 0.7 exactly there.

Null or empty text has the features of no words and is scored like any other. Labels
other than 0 and 1 and null ids do not train. With one class only, or without labels,
all strengths are 0 and every score is 0.7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from trackloom.llm import arrays
from trackloom.llm.learning import SAMPLE, logistic, sample_texts, sigmoid

ACCEPT = 0.7
PAIRS = 60_000
_KINDS = {
    "upper": [(65, 90)],
    "letter": [(65, 90), (97, 122), (128, 255)],
    "digit": [(48, 57)],
    "line": [(10, 10)],
    "stop": [(33, 33), (46, 46), (63, 63)],
}


def _table(spans) -> np.ndarray:
    out = np.zeros(256, bool)
    for low, high in spans:
        out[low : high + 1] = True
    return out


_TABLES = {name: _table(spans) for name, spans in _KINDS.items()}
_MARK = ~(_TABLES["letter"] | _TABLES["digit"] | _table([(32, 32), (9, 13)]))


def _ratio(a, b):
    return a / np.maximum(b, 1)


def features(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One row of numbers per text: its size, its characters, its words and their repetition."""
    rows = len(starts) - 1

    def count(flags):
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[starts[1:]] - sums[starts[:-1]]

    size = np.diff(starts)
    begins, ends, words = arrays.words(data, starts)
    row = np.repeat(np.arange(rows), words)
    hashes = arrays.word_hashes(data, begins, ends)

    def per_word(flags):
        return _ratio(np.bincount(row, flags, minlength=rows), words)

    def distinct(values, of):
        order = np.lexsort((values, of))
        v, r = values[order], of[order]
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
        return np.bincount(r[new], minlength=rows)

    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    marks = _MARK[data]
    mark_sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    in_word = mark_sums[ends] - mark_sums[begins]
    letters = count(_TABLES["letter"][data])
    triples, cuts = arrays.shingles(hashes, words, 3)
    of = np.repeat(np.arange(rows), np.diff(cuts))
    different = distinct(hashes, row)
    out = np.column_stack(
        [
            np.log1p(words),
            np.log1p(_ratio(size, words)),
            _ratio(count(marks), size),
            _ratio(count(_TABLES["upper"][data]), letters),
            _ratio(count(_TABLES["digit"][data]), size),
            _ratio(letters, size),
            _ratio(count(_TABLES["line"][data]), words),
            _ratio(count(_TABLES["stop"][data]), words),
            per_word(same),
            _ratio(np.log1p(different), np.log1p(words)),
            _ratio(distinct(triples, of), np.maximum(np.diff(cuts), 1)),
            per_word(in_word >= 2),
            per_word(in_word == ends - begins),
            per_word(_TABLES["upper"][data[begins]]) if len(begins) else np.zeros(rows),
            np.sqrt(per_word(same)),
            np.sqrt(per_word(in_word >= 2)),
            np.sqrt(per_word(in_word == ends - begins)),
        ]
    )
    return np.nan_to_num(out)


class Ranking:
    """Standardisation, weights and the accepting strength."""

    def __init__(self, x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, penalty: float = 1.0, seed: int = 7):
        self.mean = x.mean(axis=0) if len(x) else np.zeros(0)
        self.scale = np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0) if len(x) else np.ones(0)
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        self.weights, self.line, self.width = None, 0.0, 1.0
        if not len(good) or not len(bad):
            return
        z = self.design(x)
        draw = np.random.default_rng(seed)
        # Every text plays; the rarer side plays more often.
        a = np.concatenate([good, draw.choice(good, max(0, pairs - len(good)))])
        b = np.concatenate([draw.choice(bad, len(a) - len(bad)), bad]) if len(a) > len(bad) else draw.choice(bad, len(a))
        difference = z[a] - z[b]
        sign = np.where(np.arange(len(a)) % 2 == 0, 1.0, -1.0)
        self.weights = logistic(difference * sign[:, None], (sign > 0).astype(float), penalty, bias=False)
        strength = np.sort(z @ self.weights)
        place = len(bad)  # the quantile below which the share of bad texts lies
        self.line = float((strength[place - 1] + strength[place]) / 2)
        self.width = max(float(strength.std()) / 4, 1e-6)

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([z, np.abs(z)])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), ACCEPT)
        strength = self.design(x) @ self.weights
        return sigmoid((strength - self.line) / self.width + np.log(ACCEPT / (1 - ACCEPT)))


def _by_piece(batch: pa.RecordBatch, make) -> np.ndarray:
    data, starts = arrays.utf8(batch.column("text"))
    made = [make(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a]) for a, b in arrays.pieces(starts)]
    return np.concatenate(made) if made else make(data, starts)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _by_piece(batch, features)
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(list(x))], names=["label", "x"])


def _score_rows(model: Ranking):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _by_piece(batch, lambda d, s: model.score(features(d, s)))
            names = [n for n in batch.schema.names if n not in ("score", "predicted")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(score), pa.array((score >= ACCEPT).astype(np.int32))],
                names=[*names, "score", "predicted"],
            )

    return run


def fit(docs: DataFrame, labels: DataFrame, train: Column, limit: int = SAMPLE) -> Ranking:
    """Learn from at most ``limit`` labelled texts that ``train``, a condition on labels, admits."""
    found = sample_texts(docs, labels, "quality", train, limit, "quality").mapInArrow(
        _feature_rows, "label int, x array<double>"
    )
    rows = sorted((r.label, r.x) for r in found.collect())
    x = np.array([r[1] for r in rows]) if rows else np.zeros((0, 0))
    return Ranking(x, np.array([r[0] for r in rows]))


def score(docs: DataFrame, model: Ranking) -> DataFrame:
    """``docs`` with score and predicted (replaced if they are there)."""
    kept = [f for f in docs.schema if f.name not in ("score", "predicted")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.mapInArrow(_score_rows(model), f"{schema}, score double, predicted int")
