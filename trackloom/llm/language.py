"""Language of a text in two steps: its family, then a vote of linear SVMs within it.

Features are the shares of hashed byte trigrams of the lower-cased text, as square roots
of unit length. A logistic model per family picks the family; within it one linear SVM per
pair of languages votes (one versus one), the summed margins deciding ties.

Languages without an entry in ``FAMILIES`` are families of their own. Texts that are
null or hold no letter are ``und`` with score 0. Null languages and ids do not train;
without any training row every text is ``und``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm import arrays
from trackloom.llm.learning import bounded_sample, linear_svm, logistic, sigmoid

SAMPLE = 4_000
BINS = 1024
UNKNOWN = "und"
# Families of common languages.
FAMILIES = {
    "da": "germanic",
    "de": "germanic",
    "en": "germanic",
    "nl": "germanic",
    "no": "germanic",
    "sv": "germanic",
    "ca": "romance",
    "es": "romance",
    "fr": "romance",
    "it": "romance",
    "pt": "romance",
    "ro": "romance",
    "cs": "slavic",
    "pl": "slavic",
    "ru": "slavic",
    "uk": "slavic",
}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = re.compile(r"[^\W\d_]")


def trigrams(data: np.ndarray, starts: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One row of feature shares per text."""
    rows = len(starts) - 1
    low = _LOWER[data]
    # Upper case of the letters U+00C0 to U+00DE, in UTF-8.
    lead = np.zeros(len(data), bool)
    lead[1:] = data[:-1] == 0xC3
    low = np.where(lead & (low >= 0x80) & (low <= 0x9E) & (low != 0x97), low + np.uint8(0x20), low).astype(np.uint32)
    if len(low) < 3:
        return np.zeros((rows, bins), np.float32)
    code = (low[:-2] << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | low[2:]
    code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - int(bins).bit_length() + 1)
    row = np.repeat(np.arange(rows), np.diff(starts))
    inside = row[:-2] == row[2:]
    flat = np.bincount(row[:-2][inside] * bins + code[inside], minlength=rows * bins)
    out = np.sqrt(flat.reshape(rows, bins).astype(np.float32))
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


class Tree:
    def __init__(self, x: np.ndarray, langs: list[str]):
        y = np.array(langs, dtype=object)
        self.families: dict[str, list[str]] = {}
        for lang in sorted(set(langs)):
            self.families.setdefault(FAMILIES.get(lang, lang), []).append(lang)
        self.names = list(self.families)
        family = np.array([FAMILIES.get(lang, lang) for lang in langs], dtype=object)
        self.first = np.array([_separator(x, family == name) for name in self.names]) if len(self.names) > 1 else None
        self.pairs = {
            (a, b): linear_svm(x[(y == a) | (y == b)], np.where(y[(y == a) | (y == b)] == a, 1.0, -1.0))
            for members in self.families.values()
            for a, b in combinations(members, 2)
        }

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one = np.hstack([x, np.ones((len(x), 1), x.dtype)])
        if self.first is None:
            family, sure = np.zeros(len(x), int), np.ones(len(x))
        else:
            chance = sigmoid(one @ self.first.T)
            family = chance.argmax(axis=1)
            sure = chance.max(axis=1) / np.maximum(chance.sum(axis=1), 1e-12)
        lang, score = np.empty(len(x), dtype=object), sure.copy()
        for index, name in enumerate(self.names):
            at = np.flatnonzero(family == index)
            members = self.families[name]
            votes, margins = np.zeros((len(at), len(members))), np.zeros((len(at), len(members)))
            for (i, a), (j, b) in combinations(enumerate(members), 2):
                margin = one[at] @ self.pairs[a, b]
                votes[:, i] += margin > 0
                votes[:, j] += margin <= 0
                margins[:, i] += margin
                margins[:, j] -= margin
            best = (votes + sigmoid(margins) * 0.5).argmax(axis=1)
            lang[at] = np.array(members, dtype=object)[best]
            if len(members) > 1:
                score[at] *= sigmoid(2 * margins[np.arange(len(at)), best] / (len(members) - 1))
        return lang, score


def _separator(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """A logistic separator along the SVM's direction, so that the fit stays small."""
    svm = linear_svm(x, np.where(positive, 1.0, -1.0))
    along = np.hstack([x, np.ones((len(x), 1), x.dtype)]) @ svm
    slope, bias = logistic(along[:, None], positive.astype(float), 1e-2)
    out = svm * slope
    out[-1] += bias
    return out


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, starts = arrays.utf8(batch.column("text"))
        for a, b in arrays.pieces(starts):
            x = trigrams(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a])
            packed = pa.array([r.tobytes() for r in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("lang").slice(a, b - a), packed], names=["lang", "x"])


def _predict_rows(model: Tree | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = arrays.utf8(batch.column("text"))
            langs, scores = [], []
            for a, b in arrays.pieces(starts):
                body, own = data[starts[a] : starts[b]], starts[a : b + 1] - starts[a]
                sums = np.concatenate([[0], np.cumsum((_LOWER[body] >= 97) & (_LOWER[body] <= 122))])
                plain = sums[own[1:]] > sums[own[:-1]]
                known = np.array(
                    [p or bool(_LETTER.search(body[own[i] : own[i + 1]].tobytes().decode())) for i, p in enumerate(plain)],
                    dtype=bool,
                )
                if model is None:
                    known[:] = False
                    lang, score = np.full(b - a, UNKNOWN, dtype=object), np.zeros(b - a)
                else:
                    lang, score = model.predict(trigrams(body, own))
                langs += [x if k else UNKNOWN for x, k in zip(lang, known)]
                scores += [float(x) if k else 0.0 for x, k in zip(score, known)]
            names = [n for n in batch.schema.names if n not in ("lang_pred", "score")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*names, "lang_pred", "score"],
            )

    return run


def fit(docs: DataFrame, train: Column, limit: int = SAMPLE) -> Tree | None:
    """Learn from at most ``limit`` documents that ``train`` admits; of several rows under one doc_id the least counts."""
    rows = docs.where(train & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    few = F.broadcast(bounded_sample(rows.select("doc_id").distinct(), "doc_id", limit, "language"))
    found = rows.join(few, "doc_id").groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("_")).select("_.lang", "_.text")
    found = found.mapInArrow(_feature_rows, "lang string, x binary")
    got = sorted((r.lang, bytes(r.x)) for r in found.collect())
    if not got:
        return None
    return Tree(np.stack([np.frombuffer(x, np.float32) for _, x in got]), [lang for lang, _ in got])


def predict(docs: DataFrame, model: Tree | None) -> DataFrame:
    """``docs`` with lang_pred and score (replaced if they are there)."""
    kept = [f for f in docs.schema if f.name not in ("lang_pred", "score")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.mapInArrow(_predict_rows(model), f"{schema}, lang_pred string, score double")
