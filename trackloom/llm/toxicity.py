"""Toxicity of texts by a grammar of weighted finite-state transducers over clauses.

*Insults* are learned: of a bounded sample of labelled texts, the word beginnings and
whole words that toxic texts use in many contexts and clean texts hardly ever. Threats,
targets, negations and reported speech are short fixed lists.

Each word is a symbol (insult, threat, target, negation, report or other). Four
transducers are composed, each reading the symbols the last one wrote and adding to the
weights of the path: negation turns the next insult or threat into a denied one, reported
speech turns those after it into quoted ones, a target near an insult makes it aimed, and
the last one scores the clause. A text's features are its clauses' weights by kind; a
logistic model over the sample turns them into a probability. Words outside a matched
clause add nothing.

Null or empty text matches nothing and has the score of a text without matches. Labels
other than 0 and 1 and null ids do not train; without both classes every score is 0.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm import arrays
from trackloom.llm.language import _LOWER
from trackloom.llm.learning import SAMPLE, logistic, sample_texts, sigmoid
from trackloom.session import materialize

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, DENIED, QUOTED, AIMED = range(9)
CHANCE = 1  # patterns that chance would give among all
SHORTEST = 4
LONGEST = 12
# Words of the grammar's closed classes.
CLOSED = {
    THREAT: "kill hurt destroy beat punish töten umbringen tuer frapper matar golpear".split(),
    TARGET: "you your he she they him her them du ihr dich tu vous toi usted ustedes".split(),
    NEGATION: "not never isn't aren't nicht kein keine pas jamais nunca".split(),
    REPORT: "said says reported quoted wrote sagte schrieb disait écrit dijo escribió".split(),
}
_CLAUSE_END = np.isin(np.arange(256), [ord(c) for c in ".!?;:\n"])
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


class Transducer:
    """States with arcs (state, symbol) -> (state, written symbol, weight).

    Without an arc the symbol is written as read, at no weight, and the state becomes
    ``rest[state]`` (itself unless given).
    """

    def __init__(self, arcs: dict, rest: dict | None = None):
        self.arcs, self.rest = arcs, rest or {}

    def step(self, state: int, symbol: int) -> tuple[int, int, float]:
        found = self.arcs.get((state, symbol))
        return found if found else (self.rest.get(state, state), symbol, 0.0)


class Composition:
    """Transducers in a row, read as one: its state is the tuple of their states."""

    def __init__(self, *parts: Transducer):
        self.parts, self.memory = parts, {}

    def step(self, state: tuple, symbol: int) -> tuple[tuple, int, float]:
        key = state, symbol
        if key not in self.memory:
            states, weight = [], 0.0
            for part, own in zip(self.parts, state):
                own, symbol, more = part.step(own, symbol)
                states.append(own)
                weight += more
            self.memory[key] = tuple(states), symbol, weight
        return self.memory[key]

    def run(self, symbols: list[int]) -> list[tuple[int, float]]:
        state, out = (0,) * len(self.parts), []
        for symbol in symbols:
            state, written, weight = self.step(state, symbol)
            out.append((written, weight))
        return out


def grammar() -> Composition:
    hits = (INSULT, THREAT)
    # Negation holds for the two words after it.
    negation = Transducer(
        {(s, NEGATION): (2, NEGATION, 0.0) for s in range(3)} | {(s, h): (0, DENIED, -0.5) for s in (1, 2) for h in hits},
        {2: 1, 1: 0},
    )
    # Reported speech holds to the end of the clause.
    report = Transducer({(s, REPORT): (1, REPORT, 0.0) for s in (0, 1)} | {(1, h): (1, QUOTED, -0.25) for h in hits})
    # A target holds for the three words after it.
    aim = Transducer(
        {(s, TARGET): (3, TARGET, 0.0) for s in range(4)} | {(s, h): (s - 1, AIMED, 0.5) for s in (1, 2, 3) for h in hits},
        {3: 2, 2: 1, 1: 0},
    )
    score = Transducer({(0, h): (0, h, 1.0) for h in (INSULT, THREAT, DENIED, QUOTED, AIMED)})
    return Composition(negation, report, aim, score)


KINDS = (INSULT, THREAT, DENIED, QUOTED, AIMED)


def _lowered(data: np.ndarray) -> np.ndarray:
    low = _LOWER[data]
    lead = np.zeros(len(data), bool)
    lead[1:] = data[:-1] == 0xC3
    return np.where(lead & (low >= 0x80) & (low <= 0x9E) & (low != 0x97), low + np.uint8(0x20), low)


def letter_words(data: np.ndarray, starts: np.ndarray):
    """Lower-cased bytes, and begin, end and text of each run of letters."""
    low = _lowered(data)
    solid = np.zeros(len(data) + 2, np.int8)
    solid[1:-1] = _LETTER[data]
    before = solid[:-1].copy()
    before[starts] = 0
    begins = np.flatnonzero((solid[1:] == 1) & (before == 0))
    after = solid[1:].copy()
    after[starts] = 0
    ends = np.flatnonzero((solid[:-1] == 1) & (after == 0))
    return low, begins, ends, np.searchsorted(starts, begins, side="right") - 1


class Matcher:
    """Finds the symbol of every word: patterns are byte strings, those of whole words end in a blank."""

    def __init__(self, patterns: dict[bytes, tuple[int, float]]):
        self.by_length: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        groups: dict[tuple[int, bool], list] = {}
        for text, (symbol, weight) in sorted(patterns.items()):
            whole = text.endswith(b" ")
            text = text.rstrip(b" ")
            groups.setdefault((len(text), whole), []).append((text, symbol, weight))
        for key, items in groups.items():
            data = np.frombuffer(b"".join(t for t, _, _ in items), np.uint8)
            ends = np.cumsum([len(t) for t, _, _ in items])
            hashes = arrays.word_hashes(data, ends - key[0], ends)
            order = np.argsort(hashes)
            self.by_length[key] = (
                hashes[order],
                np.array([s for _, s, _ in items], np.int8)[order],
                np.array([w for _, _, w in items])[order],
            )

    def symbols(self, low: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        symbol, weight = np.zeros(len(begins), np.int8), np.zeros(len(begins))
        for (length, whole), (hashes, kinds, weights) in sorted(self.by_length.items()):
            at = np.flatnonzero((ends - begins == length) if whole else (ends - begins >= length))
            if not len(at):
                continue
            mine = arrays.word_hashes(low, begins[at], begins[at] + length)
            place = np.minimum(np.searchsorted(hashes, mine), len(hashes) - 1)
            hit = hashes[place] == mine
            at, place = at[hit], place[hit]
            better = (symbol[at] == OTHER) | (weights[place] > weight[at])
            symbol[at[better]], weight[at[better]] = kinds[place[better]], weights[place[better]]
        return symbol, weight


def features(matcher: Matcher, rules: Composition, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per text: the clause weights of each kind, the best clause and the matches per word."""
    low, begins, ends, row = letter_words(data, starts)
    rows = len(starts) - 1
    out = np.zeros((rows, len(KINDS) + 3))
    symbol, weight = matcher.symbols(low, begins, ends)
    marks = np.concatenate([[0], np.cumsum(_CLAUSE_END[data], dtype=np.int64)])
    clause = marks[begins] + row  # texts never share a clause
    loud = np.unique(clause[(symbol == INSULT) | (symbol == THREAT)])
    if not len(loud):
        return out
    first, last = np.searchsorted(clause, loud), np.searchsorted(clause, loud, side="right")
    for i, j in zip(first.tolist(), last.tolist()):
        text, total = row[i], 0.0
        for k, (written, path) in enumerate(rules.run(symbol[i:j].tolist())):
            if written in KINDS:
                value = path * weight[i + k]
                out[text, KINDS.index(written)] += value
                total += value
        out[text, -3] = max(out[text, -3], total)
        out[text, -2] += 1
    sizes = np.bincount(row, minlength=rows)
    out[:, -1] = out[:, -2] / np.sqrt(np.maximum(sizes, 1))
    return np.hstack([np.log1p(np.maximum(out, 0))])


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with the number of toxic and clean texts and a 63-bit sketch of the words before them."""
    for batch in batches:
        data, starts = arrays.utf8(batch.column("text"))
        labels = np.asarray(batch.column("label"))
        low, begins, ends, row = letter_words(data, starts)
        body = low.tobytes()
        seen: dict[bytes, list] = {}
        last: dict[bytes, int] = {}
        before = np.r_[np.uint64(0), arrays.word_hashes(low, begins, ends)[:-1]] if len(begins) else np.zeros(0, np.uint64)
        bits = (np.uint64(1) << (before % np.uint64(63))).view(np.int64).tolist()
        for b, e, r, bit in zip(begins.tolist(), ends.tolist(), row.tolist(), bits):
            word = body[b:e]
            entry = seen.setdefault(word, [0, 0, 0])
            toxic = labels[r] == 1
            if last.get(word) != r:
                last[word] = r
                entry[0 if toxic else 1] += 1
            if toxic:
                entry[2] |= bit
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(seen), pa.binary()),
                pa.array([v[0] for v in seen.values()], pa.int64()),
                pa.array([v[1] for v in seen.values()], pa.int64()),
                pa.array([v[2] for v in seen.values()], pa.int64()),
            ],
            names=["word", "toxic", "clean", "sketch"],
        )


class Model:
    def __init__(self, patterns: dict[bytes, tuple[int, float]]):
        closed = {w.encode() + b" ": (symbol, 1.0) for symbol, words in CLOSED.items() for w in words}
        self.matcher, self.rules, self.weights = Matcher(closed | patterns), grammar(), None

    def features(self, data, starts):
        return features(self.matcher, self.rules, data, starts)

    def score(self, data, starts):
        if self.weights is None:
            return np.zeros(len(starts) - 1)
        x = self.features(data, starts)
        return sigmoid(np.hstack([x, np.ones((len(x), 1))]) @ self.weights)


def learn_insults(sample: DataFrame) -> dict[bytes, tuple[int, float]]:
    """The word beginnings, and whole words, that mark toxic texts, with their weights.

    A pattern must be in six toxic texts, in many contexts (copies of one text repeat a word in
    one), 25 times as often as in clean ones, and so often that chance, at the sample's
    share of toxic texts, would give less than ``CHANCE`` such among all patterns (a
    log-likelihood test). Of patterns that begin alike the shortest stands for all. The patterns
    are words of a bounded sample, and so are few.
    """
    counted = sample.mapInArrow(_word_rows, "word binary, toxic long, clean long, sketch long")
    words = counted.groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_or("sketch").alias("sketch")
    )
    begun = F.expr(
        f"transform(sequence({SHORTEST}, {LONGEST}), n -> if(octet_length(word) >= n, substring(word, 1, n), null))"
    )
    whole = F.array(F.concat("word", F.lit(" ").cast("binary")))
    patterns = materialize(
        words.select(F.explode(F.concat(F.array_compact(begun), whole)).alias("pattern"), "toxic", "clean", "sketch")
        .groupBy("pattern")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_or("sketch").alias("sketch"))
        .withColumn("contexts", F.bit_count("sketch"))
        .drop("sketch"),
        "patterns",
    )
    known = sample.agg(F.avg("label").alias("share")).first()
    share = min(max(known.share or 0.5, 1e-6), 1 - 1e-6)
    n = F.col("toxic") + F.col("clean")

    def term(count, part: float):
        return F.when(count > 0, count * F.log(count / (n * part))).otherwise(0.0)

    likelihood = term(F.col("toxic"), share) + term(F.col("clean"), 1 - share)
    marks = patterns.where("toxic >= 6 and toxic > 25 * clean and contexts >= 0.4 * least(toxic, 40)").where(
        likelihood > float(np.log(max(patterns.count(), 1) / CHANCE))
    )
    starts = F.expr(f"transform(sequence({SHORTEST}, least({LONGEST}, octet_length(pattern) - 1)), n -> substring(pattern, 1, n))")
    longer = marks.where(F.octet_length("pattern") > SHORTEST).select("pattern", F.explode(starts).alias("start"))
    covered = longer.join(marks.select(F.col("pattern").alias("start")), "start", "left_semi").select("pattern").distinct()
    rows = marks.join(covered, "pattern", "left_anti").select("pattern", "toxic", "clean").collect()
    return {bytes(r.pattern): (INSULT, float(np.log((r.toxic + 1) / (r.clean + 1)))) for r in sorted(rows, key=lambda r: bytes(r.pattern))}


def _feature_rows(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = arrays.utf8(batch.column("text"))
            for a, b in arrays.pieces(starts):
                x = model.features(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").slice(a, b - a), pa.array(list(x))], names=["label", "x"]
                )

    return run


def fit(docs: DataFrame, labels: DataFrame, train: Column, limit: int = SAMPLE) -> Model:
    """Learn from at most ``limit`` labelled texts that ``train``, a condition on labels, admits."""
    sample = sample_texts(docs, labels, "toxic", train, limit, "toxicity")
    model = Model(learn_insults(sample))
    rows = sorted((r.label, r.x) for r in sample.mapInArrow(_feature_rows(model), "label int, x array<double>").collect())
    y = np.array([r[0] for r in rows], float)
    if len(set(y.tolist())) == 2:
        model.weights = logistic(np.array([r[1] for r in rows]), y, 1e-2)
    return model


def _score_rows(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = arrays.utf8(batch.column("text"))
            made = [model.score(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a]) for a, b in arrays.pieces(starts)]
            score = np.concatenate(made) if made else np.zeros(0)
            names = [n for n in batch.schema.names if n not in ("score", "predicted")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=[*names, "score", "predicted"],
            )

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score and predicted (replaced if they are there)."""
    kept = [f for f in docs.schema if f.name not in ("score", "predicted")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.mapInArrow(_score_rows(model), f"{schema}, score double, predicted int")
