"""Languages of whole texts and of the spans in them.

Each word is scored for each language by letter trigrams.  The script of a word
leaves only the languages that were seen in it.  Viterbi over the words, with a
penalty for each switch, labels spans of mixed texts; a text has the language of
most of its letters.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.batches import SLICE_BYTES, append_columns, map_batches, schema_of, slices

BUCKETS = 1 << 16
#: Bytes of the texts whose paths are found together.
PATH_BYTES = 8_000_000
#: Logarithmic cost of a switch between two words.
SWITCH = 8.0
#: Counts that every trigram has besides its own.
PRIOR = 0.05
#: A language belongs to a script if so much of its own letters is in it, however
#: rare the language is among all.
SHARE = 0.001
UNKNOWN = "und"

# First code points of script ranges, ascending, and their scripts.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "latin"),
    (0x2C00, "other"), (0x2E80, "han"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"),
    (0xA000, "other"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF00, "latin"), (0xFF66, "kana"),
    (0x10000, "other"), (0x20000, "han"), (0x40000, "other"),
)
NAMES = tuple(sorted({name for _, name in SCRIPTS}))

SPANS = "lang_pred string, score double, spans array<struct<start:long,end:long,lang:string>>"


@functools.cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its script plus one, or 0 if it is not part of words;
    and its lower case."""
    points = range(0x110000)
    letters = np.fromiter((unicodedata.category(chr(p))[0] in "LM" for p in points), bool, len(points))
    firsts = np.array([p for p, _ in SCRIPTS])
    names = np.array([NAMES.index(name) + 1 for _, name in SCRIPTS], np.uint8)
    script = names[np.searchsorted(firsts, np.arange(len(points)), "right") - 1] * letters
    lower = np.arange(len(points), dtype=np.uint32)
    for p in np.flatnonzero(letters).tolist():
        small = chr(p).lower()
        if len(small) == 1:
            lower[p] = ord(small)
    return script, lower


@dataclass
class Words:
    """Words of some texts, in order: where each begins and ends in its text, its
    text's number, and its script."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    script: np.ndarray
    #: Of the letters: trigram buckets, and where each word's begin.
    buckets: np.ndarray
    first: np.ndarray


def words_of(texts: list[str | None]) -> Words:
    script_of, lower_of = _characters()
    whole = "\n".join(t or "" for t in texts) + "\n"
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.cumsum([0] + [len(t or "") + 1 for t in texts])
    script = script_of[points]
    letter = script > 0
    low = np.where(letter, lower_of[points], 0).astype(np.uint32)
    at = np.flatnonzero(letter)
    if not len(at):
        empty = np.empty(0, np.int64)
        return Words(empty, empty, empty, empty, empty, empty)
    before = np.concatenate([[np.uint32(0)], low])[at]
    after = low[at + 1]  # a text ends with a line feed
    mixed = before * np.uint32(0x9E3779B1) ^ low[at] * np.uint32(0x85EBCA77) ^ after * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1] + 1]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    text = np.searchsorted(offsets, at[first], "right") - 1
    start, end = at[first] - offsets[text], at[last] + 1 - offsets[text]
    return Words(start.astype(np.int32), end.astype(np.int32), text.astype(np.int32), script[at[first]], (mixed >> np.uint32(16)).astype(np.uint16), first)


def _runs(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs with sums up to ``most``; what is larger is alone."""
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if i > first and total + n > most:
            yield first, i
            first, total = i, 0
        total += n
    if sizes:
        yield first, len(sizes)


@dataclass
class Model:
    langs: list[str]
    #: Log likelihood of each bucket by language.
    weights: np.ndarray
    #: Scripts (from 1) by languages: 0 where a language may be, else a large cost.
    barred: np.ndarray

    def scores(self, words: Words) -> np.ndarray:
        out = np.empty((len(words.start), len(self.langs)), np.float32)
        for k in range(len(self.langs)):
            out[:, k] = np.add.reduceat(self.weights[k][words.buckets], words.first) if len(words.first) else 0
        return out - self.barred[words.script]


def train(docs: DataFrame) -> Model:
    """Counts over all rows of ``docs`` (text, lang), summed by Spark.  The driver
    gets a number for each language and bucket."""
    schema = schema_of("lang string, bucket int, n long")
    width = BUCKETS + len(NAMES) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch):
                texts, langs = (c.to_pylist() for c in part.columns)
                words = words_of(texts)
                own = np.array(langs, object)[words.text] if len(words.text) else np.empty(0, object)
                lengths = np.diff(np.concatenate([words.first, [len(words.buckets)]]))
                for lang in set(langs):
                    chosen = own == lang
                    total = totals.setdefault(lang, np.zeros(width, np.int64))
                    total[:BUCKETS] += np.bincount(words.buckets[np.repeat(chosen, lengths)], minlength=BUCKETS)
                    total[BUCKETS:] += np.bincount(words.script[chosen], lengths[chosen], len(NAMES) + 1).astype(np.int64)
        for lang, total in totals.items():
            kept = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(kept), pa.string()), pa.array(kept, pa.int32()), pa.array(total[kept], pa.int64())],
                names=schema.names,
            )

    counted = map_batches(docs.where("lang IS NOT NULL").select("text", "lang"), count, schema)
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(rows["lang"].to_pylist()))
    counts = np.zeros((len(langs), width))
    number = {lang: i for i, lang in enumerate(langs)}
    counts[[number[x] for x in rows["lang"].to_pylist()], rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    trigrams, scripts = counts[:, :BUCKETS], counts[:, BUCKETS:]
    weights = np.log((trigrams + PRIOR) / (trigrams.sum(axis=1, keepdims=True) + PRIOR * BUCKETS))
    allowed = (scripts >= SHARE * scripts.sum(axis=1, keepdims=True)).T
    allowed[~allowed.any(axis=1)] = True
    return Model(langs, weights.astype(np.float32), np.where(allowed, 0, 1e4).astype(np.float32))


def best_path(scores: np.ndarray, text: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """The language of each word: the path of the highest sum for each text, less
    the penalty for each switch.  Texts are taken word by word side by side."""
    n, langs = scores.shape
    out = np.zeros(n, np.uint16)
    if not n or langs < 2:
        return out
    first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    length = np.diff(np.concatenate([first, [n]]))
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    active = np.searchsorted(-length, -np.arange(length[0]), "left")  # texts with more words than this
    came = np.zeros((n, langs), np.uint16)
    best = scores[first].astype(np.float64)
    own = np.arange(langs)
    for t in range(1, length[0]):
        best = best[: active[t]]
        at = first[: active[t]] + t
        top = best.argmax(axis=1)
        switched = best[np.arange(len(at)), top][:, None] - penalty
        stay = best >= switched
        came[at] = np.where(stay, own, top[:, None])
        best = np.where(stay, best, switched) + scores[at]
        ended = first[: active[t]][length[: active[t]] == t + 1]
        if len(ended):
            out[ended + t] = best[length[: active[t]] == t + 1].argmax(axis=1)
    single = length == 1
    out[first[single]] = scores[first[single]].argmax(axis=1)
    for t in range(length[0] - 1, 0, -1):
        at = first[: active[t]] + t
        out[at - 1] = came[at, out[at]]
    return out


def identify(docs: DataFrame, model: Model, spans: bool = True) -> DataFrame:
    """``docs`` and lang_pred, score (share of the letters that have this label) and,
    if asked for, ``spans`` of one label in code points, end exclusive.

    A null text or one without letters is 'und' with score 0, as is every text if
    the model has seen no language.  Equal shares go to the language that sorts
    first.  Rows are not moved; columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets times languages
    ddl = SPANS if spans else SPANS.rpartition(", spans")[0]
    return append_columns(docs, ["text"], functools.partial(_task, shared, spans), ddl, most=PATH_BYTES)


def _task(shared, spans: bool):
    model: Model = shared.value

    def columns(texts):
        out = [UNKNOWN] * len(texts), [0.0] * len(texts), [[] for _ in texts]
        if model.langs:
            _label(model, texts, out, spans)
        return list(out) if spans else list(out[:2])

    return columns


def _label(model: Model, texts: list[str | None], out: tuple, spans: bool) -> None:
    """The results of ``texts`` put in ``out``.  Letters are scored in
    slices, as each takes many bytes for a moment; the paths of all are found
    together."""
    parts = []
    for a, b in _runs([len(t or "") for t in texts], SLICE_BYTES):
        words = words_of(texts[a:b])
        parts.append((words.start, words.end, words.text + a, model.scores(words)))
    start, end, text, scores = (np.concatenate(c) for c in zip(*parts, strict=True))
    label = best_path(scores, text)
    letters = np.zeros((len(texts), len(model.langs)))
    np.add.at(letters, (text, label), end - start)
    whole = letters.sum(axis=1)
    for i in np.flatnonzero(whole).tolist():
        top = int(letters[i].argmax())
        out[0][i], out[1][i] = model.langs[top], float(letters[i, top] / whole[i])
    if spans and len(text):
        edge = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (label[1:] != label[:-1])]))
        last = np.concatenate([edge[1:], [len(text)]]) - 1
        for a, b in zip(edge.tolist(), last.tolist(), strict=True):
            out[2][text[a]].append({"start": int(start[a]), "end": int(end[b]), "lang": model.langs[label[a]]})
