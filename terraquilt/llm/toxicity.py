"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from terraquilt.llm.byte_cnn import fit_in_task, labelled_sample
from terraquilt.llm.common import text_of

#: Common English insults, the lexicon to start from; labelled rows add to it.
INSULTS = frozenset("""
    idiot idiots idiotic moron morons stupid dumb fool fools loser losers scum trash garbage pathetic worthless disgusting
    clown clowns jerk creep pig pigs filth vermin ugly hate kill die shut damn hell crap bastard ass
""".split())
SECOND_PERSON = frozenset("""
    you your yours yourself yourselves u ur youre du dich dir dein deine ihr euch euer sie tu te toi ton ta tes vous votre vos
    usted ustedes vosotros ti contigo
""".split())
_PUNCTUATION = ".,;:!?\"'()[]{}<>…«»„“”‘’|"
_LOOK_ALIKE = str.maketrans("013457@$!", "oieastasi")
_NO_LETTER = re.compile(r"[^a-z]")
_SPACED_OUT = re.compile(r"(?<!\S)(?:\w ){3,}\w(?!\S)")
_STEM = range(4, 8)
#: Tokens whose meaning one worker remembers; beyond it, it starts anew.
_REMEMBERED = 500_000

NAMES = ["insults", "insult_share", "learnt", "learnt_share", "stems", "stem_share", "hidden", "hidden_share", "second_person_share",
         "near_second_person", "weight_max", "weight_mean", "capital_share", "shouted_share", "exclaimed_share", "punctuation_share",
         "symbol_share", "mixed_share", "log_words"]


def vocabulary(text: str) -> tuple[set[str], set[str]]:
    """Distinct lower-case words of a text, and their beginnings."""
    words = {t.lower().strip(_PUNCTUATION) for t in set(text.split())}
    words.discard("")
    return words, {w[:n] for w in words for n in _STEM if len(w) > n}


@dataclass(frozen=True)
class Lexicon:
    """Words and word beginnings that labelled toxic texts have far more often than others, with log odds."""

    words: dict[str, float]
    stems: dict[str, float]

    @staticmethod
    def learn(found: list[tuple[set[str], set[str]]], labels: np.ndarray, size: int = 400, least: int = 4, odds: float = 2.5) -> Lexicon:
        """At most ``size`` of each, in at least ``least`` toxic texts, log odds of ``odds`` or more. A text counts once."""
        totals = Counter(int(x) for x in labels)
        out = []
        for kind in (0, 1):
            counts = (Counter(), Counter())
            for entry, label in zip(found, labels):
                if label:
                    counts[1].update(entry[kind])
            wanted = {w for w, c in counts[1].items() if c >= least}
            for entry, label in zip(found, labels):
                if not label:
                    counts[0].update(wanted & entry[kind])
            weight = {
                w: float(np.log((counts[1][w] + 0.5) / (totals[1] + 1)) - np.log((counts[0][w] + 0.5) / (totals[0] + 1))) for w in wanted
            }
            strong = sorted(((v * counts[1][w], w) for w, v in weight.items() if v >= odds), key=lambda x: (-x[0], x[1]))[:size]
            out.append({w: weight[w] for _, w in strong})
        return Lexicon(*out)


class Reader:
    """Dense features of whole texts under a lexicon. What a token means is worked out once."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self._known: dict[str, tuple | None] = {}

    def _listed(self, word: str) -> bool:
        return word in INSULTS or word in self.lexicon.words

    def _meaning(self, token: str) -> tuple | None:
        """insult, learnt weight, stem weight, hidden, second person, shouted, capital, mixed; None if nothing holds."""
        w = token.lower().strip(_PUNCTUATION)
        insult, weight = w in INSULTS, self.lexicon.words.get(w, 0.0)
        stem = max((self.lexicon.stems.get(w[:k], 0.0) for k in _STEM if len(w) > k), default=0.0)
        mixed = bool(w) and not w.isalpha()
        hidden = mixed and not insult and not weight and (
            self._listed(_NO_LETTER.sub("", w.translate(_LOOK_ALIKE))) or self._listed(_NO_LETTER.sub("", w))
        )
        bare = token.strip(_PUNCTUATION)
        shouted = len(bare) > 2 and bare.isupper()
        found = (insult, weight, stem, hidden, w in SECOND_PERSON, shouted, token[:1].isupper(), mixed)
        return found if any(found) else None

    def features(self, text: str) -> list[float]:
        """In the order of NAMES."""
        tokens = text.split()
        m = max(1, len(tokens))
        known = self._known
        if len(known) > _REMEMBERED:
            known.clear()
        insults = learnt = stems = hidden = second = shouted = capital = mixed = 0
        most = total = 0.0
        single = sum(len(t) == 1 for t in tokens)
        marked: set[str] = set()
        persons: set[str] = set()
        for token, times in Counter(tokens).items():
            if token in known:
                found = known[token]
            else:
                found = known[token] = self._meaning(token)
            if found is None:
                continue
            is_insult, weight, stem, is_hidden, is_second, is_shouted, is_capital, is_mixed = found
            capital += times * is_capital
            shouted += times * is_shouted
            mixed += times * is_mixed
            if is_second:
                second += times
                persons.add(token)
            if is_insult or weight or stem or is_hidden:
                insults += times * is_insult
                learnt += times * (weight > 0)
                stems += times * (stem > 0)
                hidden += times * is_hidden
                strength = max(weight, stem, 3.0 * (is_insult or is_hidden))
                most = max(most, strength)
                total += times * strength
                marked.add(token)
        for run in _SPACED_OUT.findall(text) if single > 3 else ():
            spaced = self._listed(_NO_LETTER.sub("", run.lower()))
            hidden += spaced
            most = max(most, 3.0 * spaced)
        near = 0
        if marked and persons:
            last_hit = last_person = -10
            for i, token in enumerate(tokens):
                if token in marked:
                    near += i - last_person <= 5
                    last_hit = i
                elif token in persons:
                    near += i - last_hit <= 5
                    last_person = i
        chars = max(1, len(text))
        return [
            insults, insults / m, learnt, learnt / m, stems, stems / m, hidden, hidden / m, second / m, near, most, total / m,
            capital / m, shouted / m, text.count("!") / chars, sum(map(text.count, ".,;:?")) / chars,
            sum(map(text.count, "#*$%&@|")) / chars, mixed / m, float(np.log1p(len(tokens))),
        ]


@dataclass(frozen=True)
class BoostedTrees:
    """Trees of depth ``depth`` as arrays of split feature, value and leaf, on the logistic loss."""

    feature: np.ndarray  # trees x inner nodes
    value: np.ndarray
    leaf: np.ndarray  # trees x leaves
    start: float
    depth: int

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 3, rate: float = 0.15, bins: int = 64, least: float = 2.0,
            penalty: float = 1.0) -> BoostedTrees:
        """Newton steps; splits over at most ``bins`` quantiles of a feature, each side with a hessian of ``least``."""
        n, d = x.shape
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
        base = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        start = float(np.log(base / (1 - base)))
        margin = np.full(n, start)
        inner = 2**depth - 1
        features, values, leaves = [], [], []
        offsets = np.arange(d) * (bins + 1)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, p * (1 - p)
            feature, value = np.zeros(inner, np.int64), np.full(inner, np.inf)
            at = np.zeros(n, np.int64)
            for node in range(inner):
                rows = np.flatnonzero(at == node)
                if len(rows):
                    slots = (binned[rows] + offsets).ravel()
                    gs = np.bincount(slots, np.repeat(g[rows], d), d * (bins + 1)).reshape(d, -1).cumsum(axis=1)
                    hs = np.bincount(slots, np.repeat(h[rows], d), d * (bins + 1)).reshape(d, -1).cumsum(axis=1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + penalty) + (gt - gs) ** 2 / (ht - hs + penalty) - gt**2 / (ht + penalty)
                    gain[(hs < least) | (ht - hs < least)] = 0
                    for j, e in enumerate(edges):
                        gain[j, len(e):] = 0
                    j, b = np.unravel_index(int(gain.argmax()), gain.shape)
                    if gain[j, b] > 1e-9:
                        feature[node], value[node] = j, edges[j][b]
                    right = x[rows, feature[node]] > value[node]
                    at[rows] = 2 * node + 1 + right
            leaf = at - inner
            gs, hs = np.bincount(leaf, g, 2**depth), np.bincount(leaf, h, 2**depth)
            step = -rate * gs / (hs + penalty)
            margin += step[leaf]
            features.append(feature)
            values.append(value)
            leaves.append(step)
        return BoostedTrees(np.array(features), np.array(values), np.array(leaves), start, depth)

    def margins(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, value, leaf in zip(self.feature, self.value, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > value[at])
            total += leaf[at - (2**self.depth - 1)]
        return total


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising step function closest to the labels (pooling adjacent violators): margins and probabilities.

    Each pool is shrunk by one row at the overall rate, so that none is surely 0 or 1.
    """
    order = np.argsort(margin, kind="stable")
    pools: list[list[float]] = []
    for m, label in zip(margin[order], y[order]):
        pools.append([float(label), 1.0, m, m])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            total, weight, low, high = pools.pop()
            pools[-1] = [pools[-1][0] + total, pools[-1][1] + weight, pools[-1][2], high]
    rate = float(y.mean()) if len(y) else 0.0
    knots = [(edge, (p[0] + rate) / (p[1] + 1.0)) for p in pools for edge in dict.fromkeys((p[2], p[3]))]
    x, probability = np.array([k[0] for k in knots]), np.array([k[1] for k in knots])
    return x, np.maximum.accumulate(probability) if len(probability) else probability


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    trees: BoostedTrees
    knots: np.ndarray
    rates: np.ndarray

    @staticmethod
    def fit(texts: list[str], labels: np.ndarray) -> ToxicityModel:
        """A half's features come from the lexicon of the other half, as those of new texts will; so do the
        margins that calibrate, from the other half's trees. The model itself learns from all."""
        labels = np.asarray(labels, float)
        found = [vocabulary(t) for t in texts]
        half = np.arange(len(texts)) % 2
        x, margin = np.zeros((len(texts), len(NAMES))), np.zeros(len(texts))
        sides = [np.flatnonzero(half == side) for side in (0, 1)]
        for own, other in (sides, sides[::-1]):
            reader = Reader(Lexicon.learn([found[i] for i in other], labels[other]))
            for i in own:
                x[i] = reader.features(texts[i])
        for own, other in (sides, sides[::-1]):
            if len(own) and len(other):
                margin[own] = BoostedTrees.fit(x[other], labels[other]).margins(x[own])
        return ToxicityModel(Lexicon.learn(found, labels), BoostedTrees.fit(x, labels), *isotonic(margin, labels))

    def scores(self, texts: list[str], reader: Reader | None = None) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        reader = reader or Reader(self.lexicon)
        margin = self.trees.margins(np.array([reader.features(t) for t in texts]))
        return np.clip(np.interp(margin, self.knots, self.rates), 0.0, 1.0)


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: Column | None = None, max_rows: int = 8000, key: str = "doc_id",
                 text: str = "text", label: str = "toxic") -> ToxicityModel | None:
    """Model fitted on at most ``max_rows`` labelled documents (see ``labelled_sample``); None if there are none, or all have one label."""
    def fit(texts: list[str], marks: np.ndarray) -> ToxicityModel | None:
        return ToxicityModel.fit(texts, marks) if len(set(marks.tolist())) == 2 else None

    admitted = F.lit(True) if learn is None else learn
    return fit_in_task(labelled_sample(docs, labels, label, admitted, max_rows, key, text), fit, key)


def add_toxicity(docs: DataFrame, model: ToxicityModel | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and score of every whole text (NULL: empty); 0 for all without a model. No shuffle, repeated rows alike."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.lexicon) if model else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = model.scores(texts, reader) if model else np.zeros(len(texts))
            yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "score": pa.array(found, pa.float64())})

    kind = docs.schema[key].dataType.simpleString()
    scored = docs.select(F.col(key).alias("key"), text_of(text).alias("text")).mapInArrow(score, f"key {kind}, score double")
    return scored.withColumnRenamed("key", key)
