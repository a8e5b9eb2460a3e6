"""Quality classifier: a byte-level convolutional network in NumPy, max-pooled over overlapping chunks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from terraquilt.llm.common import slices, text_of

_PAD = 256


@dataclass(frozen=True)
class ByteNet:
    """Filters of 8 bytes at every 4th byte; chunks of 512 bytes, each sharing half with the next.

    Bytes are embedded, filtered, rectified and max-pooled over a chunk; a hidden layer gives a chunk
    its logit. A document's logit is a learned combination of the mean, the greatest and the least
    of its chunks' logits. The chunks cover the whole text, its end padded.
    """

    embed: np.ndarray  # 257 x d
    filters: np.ndarray  # 8 d x f
    bias: np.ndarray
    hidden: np.ndarray  # f x h
    hidden_bias: np.ndarray
    out: np.ndarray  # h
    combine: np.ndarray  # mean, max, min, 1
    stride: int = 4
    half: int = 256

    def pooled(self, data: np.ndarray) -> np.ndarray:
        """Greatest activations of each chunk, for bytes padded to whole halves with a stride more."""
        d, f = self.embed.shape[1], len(self.bias)
        blocks = self.embed[data].reshape(-1, self.stride * d)
        both = blocks @ self._halves()
        windows = both[:-1, :f] + both[1:, f:]
        halves = windows.reshape(-1, self.half // self.stride, f).max(axis=1)
        return np.maximum(np.maximum(halves[:-1], halves[1:]) + self.bias, 0.0)

    def _halves(self) -> np.ndarray:
        middle = len(self.filters) // 2
        return np.hstack([self.filters[:middle], self.filters[middle:]])

    def chunk_logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled @ self.hidden + self.hidden_bias, 0.0) @ self.out

    def padded(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode(), np.uint8)
        halves = max(2, -(-len(raw) // self.half))
        data = np.full(halves * self.half + self.stride, _PAD, np.int64)
        data[:len(raw)] = raw
        return data

    def scores(self, texts: list[str], block: int = 1 << 20) -> np.ndarray:
        """Probability of a good text for each; long texts are filtered in blocks of bytes."""
        z = np.empty((len(texts), 4))
        for i, text in enumerate(texts):
            data = self.padded(text)
            logits = []
            for start in range(0, len(data) - self.stride - self.half, block - self.half):
                part = data[start:start + block + self.stride]
                logits.append(self.chunk_logits(self.pooled(part)))
            found = np.concatenate(logits)
            z[i] = found.mean(), found.max(), found.min(), 1.0
        # the last digits may depend on where in memory a text lies
        return np.round(1.0 / (1.0 + np.exp(-np.clip(z @ self.combine, -30, 30))), 9)

    @staticmethod
    def fit(texts: list[str], labels: np.ndarray, steps: int = 1500, batch: int = 192, width: int = 4, filters: int = 32,
            hidden: int = 16, seed: int = 3, rate: float = 0.004) -> ByteNet:
        """Adam on the logistic loss of random chunks, some cut short; then the combination on whole texts."""
        rng = np.random.default_rng(seed)
        size, stride, half = 8, ByteNet.stride, ByteNet.half
        p = {
            "embed": rng.normal(0, 0.5, (257, width)), "filters": rng.normal(0, (2 / (size * width)) ** 0.5, (size * width, filters)),
            "bias": np.zeros(filters), "hidden": rng.normal(0, (2 / filters) ** 0.5, (filters, hidden)),
            "hidden_bias": np.full(hidden, 0.1), "out": rng.normal(0, 0.3, hidden), "shift": np.zeros(1),
        }
        p = {k: v.astype(np.float32) for k, v in p.items()}
        p["embed"][_PAD] = 0.0
        raw = [np.frombuffer(t.encode(), np.uint8) for t in texts]
        labels = np.asarray(labels, np.float32)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
        span = 2 * half
        windows = np.arange(0, span, stride)[:, None] + np.arange(size)[None, :]
        for step in range(1, steps + 1):
            chosen = rng.integers(len(raw), size=batch)
            data = np.full((batch, span + stride), _PAD, np.int64)
            for row, i in enumerate(chosen):
                r = raw[i]
                start = half * int(rng.integers(max(1, -(-len(r) // half) - 1)))
                length = span if rng.random() < 0.6 else int(2.0 ** rng.uniform(3, 9))
                part = r[start:start + length]
                data[row, :len(part)] = part
            y = labels[chosen]
            x = p["embed"][data[:, windows]].reshape(batch, len(windows), size * width)
            a = x @ p["filters"]
            at = a.argmax(axis=1)
            pool = np.maximum(np.take_along_axis(a, at[:, None, :], 1)[:, 0] + p["bias"], 0)
            h = np.maximum(pool @ p["hidden"] + p["hidden_bias"], 0)
            z = h @ p["out"] + p["shift"]
            dz = (1 / (1 + np.exp(-z)) - y) / batch
            g = {"out": h.T @ dz, "shift": dz.sum(keepdims=True)}
            dh = np.outer(dz, p["out"]) * (h > 0)
            g["hidden"], g["hidden_bias"] = pool.T @ dh, dh.sum(axis=0)
            dp = (dh @ p["hidden"].T) * (pool > 0)
            g["bias"] = dp.sum(axis=0)
            best = x[np.arange(batch)[:, None], at]  # batch x f x 8d
            g["filters"] = np.einsum("bf,bfk->kf", dp, best)
            dx = (dp[:, :, None] * p["filters"].T[None]).reshape(-1, width)
            places = data[np.arange(batch)[:, None, None], windows[at]].reshape(-1)
            g["embed"] = np.zeros_like(p["embed"])
            np.add.at(g["embed"], places, dx)
            g["embed"][_PAD] = 0
            pace = rate * min(1.0, 2.0 * (1 - (step - 1) / steps))
            for k, v in p.items():
                m, s = moments[k]
                m += 0.1 * (g[k] - m)
                s += 0.01 * (g[k] ** 2 - s)
                v -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        net = ByteNet(p["embed"], p["filters"], p["bias"], p["hidden"], p["hidden_bias"], p["out"], np.zeros(4))
        z = []
        for t in texts:
            found = net.chunk_logits(net.pooled(net.padded(t))) + p["shift"]
            z.append((found.mean(), found.max(), found.min()))
        weights = _logistic(np.array(z, float).reshape(-1, 3), labels)
        # the shift of the chunks belongs to the constant
        weights[3] += float(p["shift"][0]) * weights[:3].sum()
        return ByteNet(p["embed"], p["filters"], p["bias"], p["hidden"], p["hidden_bias"], p["out"], weights)


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.01, rounds: int = 30) -> np.ndarray:
    """Weights and constant of a ridge logistic regression, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = penalty * len(x) * np.diag([1.0] * (x.shape[1] - 1) + [0.0]) / 100
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge + 1e-9 * np.eye(len(w)), x.T @ (p - y) + ridge @ w)
        w -= np.clip(step, -5, 5)
    return w


def training_fold(key: str, folds: int, held_out: int) -> Column:
    """Whether a row's label may be learnt: crc32 of the key as text, modulo ``folds``, isn't ``held_out``."""
    return F.pmod(F.crc32(F.encode(F.coalesce(F.col(key).cast("string"), F.lit("")), "UTF-8")), F.lit(folds)) != held_out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, max_rows: int, key: str = "doc_id",
                    text: str = "text", max_bytes: int = 64 * 2**20) -> DataFrame:
    """key, _text and _label (0 or 1) of at most ``max_rows`` labelled documents that ``learn`` admits, those of least hash.

    Labels meet the keys of ``docs`` first, so those of absent documents don't count. A key is one
    row, whatever it repeats: its least label with its text of least hash. Texts are taken in that order while they are of
    ``max_bytes`` together. Only hashes and lengths move until then; the bounded sample of keys is
    broadcast to the documents, whose texts stay where they are but for the sample's.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & learn).groupBy(F.col(key).alias("_key")).agg(F.min(label).alias("_label"))
    narrow = docs.select(F.col(key).alias("_key"), F.xxhash64(text_of(text)).alias("_hash"), F.octet_length(text_of(text)).alias("_bytes"))
    met = narrow.join(known, "_key").groupBy("_key").agg(F.min(F.struct("_hash", "_bytes")).alias("_of"), F.any_value("_label").alias("_label"))
    first = met.select("_key", "_of.*", "_label").orderBy(F.xxhash64("_key"), "_key").limit(max_rows)
    so_far = Window.orderBy(F.xxhash64("_key"), "_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chosen = first.withColumn("_so_far", F.sum(F.col("_bytes").cast("long")).over(so_far)).where(F.col("_so_far") <= max_bytes)  # max_rows at most
    texts = docs.select(F.col(key).alias("_key"), text_of(text).alias("_text"), F.xxhash64(text_of(text)).alias("_hash"))
    # rows that repeat a key and a text are one before they leave their task
    return texts.join(F.broadcast(chosen.select("_key", "_hash", "_label")), ["_key", "_hash"]).groupBy("_key").agg(
        F.min("_text").alias("_text"), F.any_value("_label").alias("_label")
    ).withColumnRenamed("_key", key)


def fit_in_task(sample: DataFrame, fit, key: str = "doc_id"):
    """``fit(texts, labels)`` on the bounded sample, in one task; only the model comes back to the driver. None without rows."""
    import pandas as pd
    from pyspark import cloudpickle

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values([key, "_text"], kind="stable")
        model = fit(group["_text"].tolist(), group["_label"].to_numpy())
        return pd.DataFrame({"model": [cloudpickle.dumps(model)]})

    found = sample.groupBy().applyInPandas(run, "model binary").collect()
    return cloudpickle.loads(found[0]["model"]) if found else None


def fit_quality(docs: DataFrame, labels: DataFrame, learn: Column | None = None, max_rows: int = 6000, key: str = "doc_id",
                text: str = "text", label: str = "quality", steps: int = 1500) -> ByteNet | None:
    """Network fitted on at most ``max_rows`` labelled documents (see ``labelled_sample``); None if there are none, or all have one label."""
    def fit(texts: list[str], marks: np.ndarray) -> ByteNet | None:
        return ByteNet.fit(texts, marks, steps) if len(set(marks.tolist())) == 2 else None

    admitted = F.lit(True) if learn is None else learn
    return fit_in_task(labelled_sample(docs, labels, label, admitted, max_rows, key, text), fit, key)


def _scores(net: ByteNet | None, texts: list[str]) -> np.ndarray:
    """A half for all without a network: nothing is known against any text."""
    return net.scores(texts) if net else np.full(len(texts), 0.5)


def add_quality(docs: DataFrame, net: ByteNet | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and score of every whole text (NULL: empty, scored as such); no shuffle, repeated rows alike."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_pydict({
                "key": batch.column("key"), "score": pa.array(_scores(net, batch.column("text").to_pylist()), pa.float64()),
            })

    kind = docs.schema[key].dataType.simpleString()
    scored = docs.select(F.col(key).alias("key"), text_of(text).alias("text")).mapInArrow(score, f"key {kind}, score double")
    return scored.withColumnRenamed("key", key)


def keep_quality(docs: DataFrame, net: ByteNet | None, least: float = 0.5, text: str = "text") -> DataFrame:
    """The documents whose score is ``least`` or more, with the columns of ``docs``; no shuffle."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            yield batch.filter(pa.array(_scores(net, texts) >= least, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
