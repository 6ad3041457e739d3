"""Quality of texts by attention over their passages.

Every passage of a text is encoded; gated attention weighs the passages, and the
weighted sum is scored.  Only labels of whole texts are learned from: encoder,
attention and score are fitted together on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salesmart.llm.batches import append_columns, map_batches, schema_of, slices

#: Words of a passage.
PASSAGE = 64
#: Labelled rows that the model is fitted on, at most.
SAMPLE = 6000
#: Widths of the encoding and of the attention.
ENCODED, ATTENTION = 16, 8
EPOCHS, BATCH, RATE, DECAY = 30, 128, 0.01, 1e-4
SEED = 42

_SIGNS = b".,!?|$%&*#\"'()-;:/=<>@_"
_FEATURES = 11 + len(_SIGNS)


def describe(text: str | None) -> np.ndarray:
    """A row of figures for each passage; one row of zeros without words."""
    words = (text or "").split()
    if not words:
        return np.zeros((1, _FEATURES), np.float32)
    out = np.empty((-(-len(words) // PASSAGE), _FEATURES), np.float32)
    for i in range(len(out)):
        own = words[i * PASSAGE : (i + 1) * PASSAGE]
        n, distinct = len(own), len(set(own))
        chars = np.bincount(np.frombuffer(" ".join(own).encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
        size = max(int(chars.sum()) - n + 1, 1)
        upper, lower, digits, high = chars[65:91].sum(), chars[97:123].sum(), chars[48:58].sum(), chars[128:].sum()
        pairs = set(zip(own, own[1:], strict=False))
        figures = [
            np.log1p(n), n / PASSAGE, size / n / 10, distinct / n, sum(map(eq, own, own[1:])) / n, len(pairs) / max(n - 1, 1),
            upper / size, lower / size, digits / size, high / size, sum(map(str.isupper, own)) / n,
        ]
        out[i, :11] = figures
        out[i, 11:] = chars[list(_SIGNS)] / n
    return out


class Model:
    """Gated attention over encoded passages, and a logistic score."""

    def __init__(self, seed: int = SEED) -> None:
        draw = np.random.default_rng(seed)
        normal = lambda a, b: draw.normal(0, 1 / np.sqrt(a), (a, b))
        self.mean, self.scale = np.zeros(_FEATURES), np.ones(_FEATURES)
        self.parts = {
            "encode": normal(_FEATURES, ENCODED), "shift": np.zeros(ENCODED), "value": normal(ENCODED, ATTENTION),
            "gate": normal(ENCODED, ATTENTION), "weigh": normal(ATTENTION, 1)[:, 0], "out": normal(ENCODED, 1)[:, 0], "bias": np.zeros(1),
        }

    def forward(self, figures: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        """``first``: where the passages of each text begin."""
        p = self.parts
        scaled = np.clip((figures - self.mean) / self.scale, -8, 8)
        encoded = np.tanh(scaled @ p["encode"] + p["shift"])
        value, gate = np.tanh(encoded @ p["value"]), 1 / (1 + np.exp(-(encoded @ p["gate"])))
        raw = (value * gate) @ p["weigh"]
        bag = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(figures))))
        power = np.exp(raw - np.maximum.reduceat(raw, first)[bag])
        attention = power / np.add.reduceat(power, first)[bag]
        whole = np.add.reduceat(attention[:, None] * encoded, first, axis=0)
        score = 1 / (1 + np.exp(-(whole @ p["out"] + p["bias"])))
        return {"scaled": scaled, "encoded": encoded, "value": value, "gate": gate, "attention": attention, "whole": whole, "score": score, "bag": bag}

    def slopes(self, found: dict[str, np.ndarray], first: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logarithmic loss."""
        p, bag, attention, encoded = self.parts, found["bag"], found["attention"], found["encoded"]
        error = (found["score"] - labels) / len(labels)
        to_whole = (error[:, None] * p["out"])[bag]
        to_attention = (to_whole * encoded).sum(axis=1)
        to_raw = attention * (to_attention - np.add.reduceat(attention * to_attention, first)[bag])
        mixed = to_raw[:, None] * p["weigh"]
        to_value = mixed * found["gate"] * (1 - found["value"] ** 2)
        to_gate = mixed * found["value"] * found["gate"] * (1 - found["gate"])
        to_encoded = attention[:, None] * to_whole + to_value @ p["value"].T + to_gate @ p["gate"].T
        inner = to_encoded * (1 - encoded**2)
        return {
            "encode": found["scaled"].T @ inner, "shift": inner.sum(axis=0), "value": encoded.T @ to_value, "gate": encoded.T @ to_gate,
            "weigh": (found["value"] * found["gate"]).T @ to_raw, "out": found["whole"].T @ error, "bias": np.array([error.sum()]),
        }

    def fit(self, bags: list[np.ndarray], labels: np.ndarray) -> Model:
        figures = np.concatenate(bags)
        self.mean, self.scale = figures.mean(axis=0), figures.std(axis=0) + 1e-3
        draw, step = np.random.default_rng(SEED), 0
        mean = {k: np.zeros_like(v) for k, v in self.parts.items()}
        square = {k: np.zeros_like(v) for k, v in self.parts.items()}
        for _ in range(EPOCHS):
            order = draw.permutation(len(bags))
            for at in range(0, len(order), BATCH):
                chosen, step = order[at : at + BATCH], step + 1
                own = [bags[i] for i in chosen]
                first = np.cumsum([0] + [len(b) for b in own[:-1]])
                slopes = self.slopes(self.forward(np.concatenate(own), first), first, labels[chosen])
                for k, slope in slopes.items():
                    slope = slope + DECAY * self.parts[k]
                    mean[k] = 0.9 * mean[k] + 0.1 * slope
                    square[k] = 0.999 * square[k] + 0.001 * slope**2
                    self.parts[k] = self.parts[k] - RATE * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
        return self


def train(sample: DataFrame) -> Model | None:
    """A model of ``sample`` (text, quality), which is bounded; the driver gets the
    figures of its passages.  None without rows."""

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts, labels = (c.to_pylist() for c in part.columns)
                packed = [describe(t).astype(np.float32).tobytes() for t in texts]
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), pa.array(labels, pa.int32())], names=["figures", "quality"])

    rows = map_batches(sample, figures, schema_of("figures binary, quality int")).collect()
    # The order of rows depends on the cluster; the fit must not.
    rows = sorted((bytes(r["figures"]), r["quality"]) for r in rows)
    if not rows:
        return None
    bags = [np.frombuffer(f, np.float32).reshape(-1, _FEATURES) for f, _ in rows]
    return Model().fit(bags, np.array([q for _, q in rows], float))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` and ``score`` (0 to 1; 0 without a model).

    Null and empty texts are one passage without words.  Rows are not moved; a
    column ``score`` is replaced.
    """

    def task():
        def columns(texts):
            if model is None:
                return [[0.0] * len(texts)]
            bags = [describe(t) for t in texts]
            first = np.cumsum([0] + [len(b) for b in bags[:-1]])
            return [model.forward(np.concatenate(bags), first)["score"].tolist()]

        return columns

    return append_columns(docs, ["text"], task, "score double")
