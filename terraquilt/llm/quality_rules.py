"""Quality rules: statistics of each text, and an isolation forest over them with a threshold from labelled rows."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from terraquilt.llm.common import settle, slices, text_of

_SYMBOL = re.compile(r"[#*$%&|<>]")
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_BLANK = " \t\n\x0b\x0c\r"
#: What the forest looks at: shares and means, so that length by itself tells little.
FEATURES = ["word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "other_share", "digit_share",
            "distinct_share", "same_neighbour_share"]
_COLUMNS = BASE + FEATURES


def repeated_words(words: list[bytes], width: int = 8) -> int:
    """Words that lie in a window of ``width`` words found twice or more, the first find included.

    Windows are compared as whole: pairs of words get numbers, then pairs of pairs, up to the width.
    """
    n = len(words)
    if n <= width:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    span = 1
    while span < width:
        step = min(span, width - span)
        ids = np.unique(ids[:-step] * (ids.max() + 1) + ids[step:], return_inverse=True)[1]
        span += step
    counts = np.bincount(ids)
    starts = np.flatnonzero(counts[ids] > 1)
    if not len(starts):
        return 0
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int((np.cumsum(edges[:n]) > 0).sum())


def _character_kinds() -> np.ndarray:
    """Kind of each code point to U+FFFF: 1 upper-case letter, 2 other letter, 3 digit, 0 the rest, as are those beyond."""
    kinds = np.zeros(0x10000, np.uint8)
    for i in range(0xFFFF):
        c = chr(i)
        kinds[i] = 1 if c.isupper() else 2 if c.isalpha() else 3 if c.isdigit() else 0
    return kinds


_KINDS = _character_kinds()


def statistics(text: str, width: int = 8) -> list[float]:
    """The base counts and then the features of one text."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    chars = len(b"".join(words).decode())
    symbols = len(_SYMBOL.findall(text))
    seen: set[str] = set()
    duplicates = lines = 0
    for line in text.split("\n"):
        if line.strip(_BLANK):
            lines += 1
            duplicates += line in seen
            seen.add(line)
    repeats = repeated_words(words, width)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    _, upper, lower, digits = np.bincount(_KINDS[np.minimum(points, 0xFFFF)], minlength=4).tolist()
    letters = max(1, upper + lower)
    same = sum(map(bytes.__eq__, words, words[1:]))
    m = max(1, n)
    return [
        n, chars, symbols, duplicates, repeats,
        chars / m, symbols / m, duplicates / max(1, lines), repeats / m, upper / letters,
        (chars - upper - lower - digits - symbols) / max(1, chars), digits / max(1, chars), len(set(words)) / m, same / m,
    ]


def add_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 8, others: tuple[str, ...] = ()) -> DataFrame:
    """key, the columns ``others``, the base counts (long) and the features (double) of every whole text; no shuffle."""
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in (key, *others))
    schema = f"{kinds}, " + ", ".join([f"{c} long" for c in BASE] + [f"{c} double" for c in FEATURES])
    columns = [key, *others]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([statistics(t, width) for t in batch.column("_text").to_pylist()], float).reshape(-1, len(_COLUMNS))
            out = {c: batch.column(c) for c in columns}
            out |= {c: found[:, i].astype(np.int64) if c in BASE else found[:, i] for i, c in enumerate(_COLUMNS)}
            yield pa.RecordBatch.from_pydict(out)

    return docs.select(*columns, text_of(text).alias("_text")).mapInArrow(measure, schema)


def _mean_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search in a tree of n points."""
    n = np.maximum(np.asarray(n, float), 1.0)
    return np.where(n > 2, 2.0 * (np.log(np.maximum(n - 1.0, 1.0)) + 0.5772156649015329) - 2.0 * (n - 1.0) / n, np.where(n > 1, 1.0, 0.0))


@dataclass(frozen=True)
class IsolationForest:
    """Trees of random splits, as arrays: feature, value, left child (the right one is next), path length at a leaf.

    Features are held as standard deviations from the median of the good rows, within ``reach``.
    A split is drawn over the whole box that its node covers, not just over the points in it; so what
    lies where no good row is gets a leaf to itself after few splits, though all good rows have
    the same value there (no symbols at all, say).
    """

    centre: np.ndarray
    scale: np.ndarray
    feature: np.ndarray
    value: np.ndarray
    child: np.ndarray
    length: np.ndarray
    expected: float
    reach: float = 10.0

    @staticmethod
    def fit(good: np.ndarray, trees: int = 100, sample: int = 256, depth: int = 12, seed: int = 7) -> IsolationForest:
        rng = np.random.default_rng(seed)
        centre, scale = np.median(good, axis=0), np.maximum(good.std(axis=0), 0.01)
        reach = IsolationForest.reach
        x = np.clip((good - centre) / scale, -reach, reach)
        sample = min(sample, len(x))
        grown = []
        for _ in range(trees):
            nodes: list[list[float]] = [[-1, 0.0, -1, 0.0]]
            drawn = x[rng.choice(len(x), sample, replace=False)]
            todo = [(0, drawn, 0, np.full(x.shape[1], -reach), np.full(x.shape[1], reach))]
            while todo:
                at, points, level, low, high = todo.pop()
                if len(points) <= 1 or level >= depth:
                    nodes[at][3] = level + float(_mean_path(len(points)))
                    continue
                f = int(rng.integers(x.shape[1]))
                cut = rng.uniform(low[f], high[f])
                goes = points[:, f] <= cut
                below, above = high.copy(), low.copy()
                below[f] = above[f] = cut
                nodes[at][:3] = [f, cut, len(nodes)]
                todo += [(len(nodes), points[goes], level + 1, low, below), (len(nodes) + 1, points[~goes], level + 1, above, high)]
                nodes += [[-1, 0.0, -1, 0.0], [-1, 0.0, -1, 0.0]]
            grown.append(np.array(nodes))
        size = max(len(t) for t in grown)
        full = np.stack([np.vstack([t, np.tile([-1, 0, -1, 0], (size - len(t), 1))]) for t in grown])
        return IsolationForest(
            centre, scale, full[:, :, 0].astype(np.int64), full[:, :, 1], full[:, :, 2].astype(np.int64), full[:, :, 3],
            max(1.0, float(_mean_path(sample))),
        )

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / expected path): near 1 for points that few splits set apart."""
        x = np.clip((x - self.centre) / self.scale, -self.reach, self.reach)
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, value, child, length in zip(self.feature, self.value, self.child, self.length):
            at = np.zeros(len(x), np.int64)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] > value[at]
                at = np.where(inner, child[at] + right, at)
            total += length[at]
        return np.exp2(-total / len(self.feature) / self.expected)


def base_failed(n_words, n_repeat_words, least: int = 20, percent: int = 30):
    """Too few words, or too many in repeated windows; for columns and arrays alike."""
    return (n_words < least) | (100 * n_repeat_words > percent * n_words)


@dataclass(frozen=True)
class QualityRules:
    """A forest and the score above which it rejects; without a forest only the base rules count."""

    forest: IsolationForest | None
    threshold: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.forest.score(x) if self.forest and len(x) else np.zeros(len(x))


def add_scores(stats: DataFrame, rules: QualityRules) -> DataFrame:
    """Add ``anomaly`` (0 to 1) to rows that have the features; no shuffle."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in FEATURES]).astype(float)
            yield batch.append_column("anomaly", pa.array(rules.scores(x), pa.float64()))

    return stats.mapInArrow(score, ", ".join(f"`{c}` {t}" for c, t in stats.dtypes) + ", anomaly double")


def pick_threshold(good: np.ndarray, bad: np.ndarray, max_loss: float, cost: float) -> float:
    """Upper edge of the score bin to reject above, from counts of good and bad rows in equal bins of 0 to 1.

    The most of ``caught share - cost * lost share`` with a lost share of at most ``max_loss``; of
    equal ones the highest, so that rejecting nothing wins where nothing is gained.
    """
    lost = 1.0 - np.cumsum(good) / max(1, good.sum())
    caught = 1.0 - np.cumsum(bad) / max(1, bad.sum())
    gain = np.where(lost <= max_loss, caught - cost * lost, -np.inf)
    best = len(gain) - 1 - int(np.argmax(gain[::-1]))
    return (best + 1) / len(gain)


def fit_rules(stats: DataFrame, labels: DataFrame, max_rows: int = 20_000, max_loss: float = 0.005, cost: float = 20.0,
              bins: int = 2000, key: str = "doc_id", label: str = "quality") -> QualityRules:
    """Forest over good labelled rows, at most ``max_rows`` (those of least hash); threshold over all labelled rows.

    ``stats`` has key, base counts and features. Rows that fail the base rules, or whose label is NULL, teach nothing.
    Without a good labelled row there is no forest. Only the sample and ``bins`` counts reach the driver.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.min(label).alias("_label"))
    usable = stats.where(~base_failed(F.col("n_words"), F.col("n_repeat_words"))).join(known, key).select(key, "_label", *FEATURES)
    usable = settle(usable, "rules-labelled")
    # a key is one row, that of least features, whatever it repeats
    good = usable.where(F.col("_label") == 1).groupBy(key).agg(F.min(F.struct(*FEATURES)).alias("_least"))
    sample = good.orderBy(F.xxhash64(key), key).limit(max_rows).select("_least.*").toPandas()
    if not len(sample):
        return QualityRules(None, 1.0)
    rules = QualityRules(IsolationForest.fit(sample.to_numpy(float)), 1.0)
    place = F.least(F.floor(F.col("anomaly") * bins).cast("int"), F.lit(bins - 1))
    counts = add_scores(usable, rules).groupBy("_label", place.alias("bin")).count().toPandas()
    histogram = [np.bincount(c["bin"], c["count"], bins) for c in (counts[counts._label == 1], counts[counts._label == 0])]
    return QualityRules(rules.forest, pick_threshold(*histogram, max_loss, cost))


def judge_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """key, base counts, base_failed, anomaly, kept for every document.

    kept is false if the base rules fail (fewer than 20 words, or over 30% of them in 8-word
    windows found twice or more), or the forest's score is over the threshold. A NULL text is
    empty, so it fails. Rows are judged one by one, repeated ones alike, NULL keys too.
    """
    stats = settle(add_statistics(docs, key, text), "rules-statistics")
    rules = fit_rules(stats, labels, key=key, **options)
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return add_scores(stats, rules).select(
        key, *BASE, failed.alias("base_failed"), "anomaly", (~failed & (F.col("anomaly") <= rules.threshold)).alias("kept")
    )


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that ``judge_quality`` keeps, with the columns of ``docs``.

    The statistics of all are taken once for the fit and once more where each document is judged in place,
    which costs less than moving the texts.
    """
    rules = fit_rules(settle(add_statistics(docs, key, text), "rules-statistics"), labels, key=key, **options)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = len(BASE)
        for batch in slices(batches):
            found = np.array([statistics(t or "") for t in batch.column(text).to_pylist()], float).reshape(-1, len(_COLUMNS))
            bad = base_failed(found[:, 0], found[:, first - 1]) | (rules.scores(found[:, first:]) > rules.threshold)
            yield batch.filter(pa.array(~bad))

    return docs.mapInArrow(keep, docs.schema)
