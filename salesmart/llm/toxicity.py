"""Toxicity of texts whose words may be disguised.

A language model over characters and the words in use are counted from the corpus.
Spans that look disguised (digits and signs for letters, letters set apart, letters
repeated) become lattices of what may have been meant, and Viterbi finds the
likeliest letters under the model.  A word in use that stands as it is was meant as
it is and is never decoded; letters that are merely doubled or set apart are taken
out or joined only where that gives words in use.  A classifier of words scores the
restored text.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from bisect import bisect_right, insort
from collections import Counter
from collections.abc import Container, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.batches import append_columns, map_batches, schema_of, slices
from salesmart.sources.shared import store

#: Letters a to z, and 0 for what ends a word.
LETTERS = 27
#: Letters that the model looks back.
CONTEXT = 3
#: Labelled rows that the classifier is fitted on, at most.
SAMPLE = 20_000
#: Words and beginnings that the classifier knows, at most; standard errors by
#: which the share of toxic texts with one must differ from all; texts it must be in.
FEATURES, APART, OFTEN = 2000, 6.0, 5
#: Letters of the beginnings of longer words, which tell words of a family.
BEGINNINGS = (4, 5, 6)

# Letters that a sign may stand for.
MEANT = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
}
#: Logarithms of how likely a writer does this: a sign for a letter, a letter drawn out
#: to three or more, a letter doubled by mistake, a word's end among letters set
#: apart, a blank or mark put between pieces of a word.
SIGN, DRAWN, DOUBLED, SPLIT, JOINED = -1.5, -0.5, -6.0, -2.0, -0.5
#: The same for a doubled letter in a word not in use, before the words' counts are
#: compared: an unknown word counts for half an occurrence.
MISTAKEN, UNSEEN = -6.0, 0.5
#: Share of all words that makes a word one in use: at most the inverse are kept.
IN_USE = 2e-6
#: Letters of a word that a disguise may hide, at least.
LEAST_LETTERS = 4
#: Words and spans that a task remembers.
REMEMBERED = 300_000

_SIGNS = "".join(re.escape(c) for c in MEANT)
_LETTER = r"[^\W\d_]"
_HINT = re.compile(rf"[{_SIGNS}]+")
_TWICE, _THRICE = re.compile(r"(.)\1"), re.compile(r"(.)\1\1")
_AROUND = re.compile(rf"(?:{_LETTER}|[{_SIGNS}])+")
_APART = re.compile(rf"(?<![^\W_])(?:{_LETTER}|[{_SIGNS}])(?:([ .*_-])(?:{_LETTER}|[{_SIGNS}]))(?:\1(?:{_LETTER}|[{_SIGNS}]))+(?![^\W_])")
_BETWEEN = rf"(?:[^\w{_SIGNS}]|_)"
# For the search of pieces set apart, signs that are no digits are letters of no use
# else, so that a class of characters says what a piece is.
_MARKED = dict(zip("@$!|+", "ªºµþð", strict=True))
_LIKE = "".join(_MARKED.values())
_PIECES = re.compile(rf"[\W_{_LIKE}]([^\W26_]{{1,2}}(?:[\W_]{{1,3}}[^\W26_]{{1,2}}){{2,}})(?![^\W_{_LIKE}])")
_RUN = re.compile(rf"{_BETWEEN}+|(.)\1*", re.DOTALL)
_WORD = re.compile(rf"{_LETTER}+")
# Marks around a word that are no letters: of exclamation, or three equal signs and more.
_MARKS = re.compile(rf"^(?:!+|([{_SIGNS}])\1\1+)|(?:!+|([{_SIGNS}])\2\2+)$")


@functools.cache
def _folded() -> np.ndarray:
    """1 to 26 for each code point whose base letter is a to z, else 0."""
    codes = np.zeros(0x110000, np.uint8)
    for p in range(0x3000):
        base = unicodedata.normalize("NFKD", chr(p))[:1].lower()
        if "a" <= base <= "z":
            codes[p] = ord(base) - 96
    return codes


def fold(text: str) -> np.ndarray:
    return _folded()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


@functools.lru_cache(maxsize=4096)
def _letter(sign: str) -> int:
    return int(fold(sign)[0])


def gram_counts(texts: list[str | None]) -> np.ndarray:
    """Letters after the letters before them in their word, and ends of words."""
    code = np.concatenate([np.zeros(CONTEXT, np.uint8), fold("\n".join(t or "" for t in texts) + "\n")]).astype(np.int64)
    now = code[CONTEXT:]
    index, before = now.copy(), np.ones(len(now), bool)
    for k in range(1, CONTEXT + 1):
        back = np.where(before, code[CONTEXT - k : len(code) - k], 0)
        before = back > 0
        index += back * LETTERS**k
    return np.bincount(index[index > 0], minlength=LETTERS ** (CONTEXT + 1))


def train_corpus(docs: DataFrame) -> tuple[np.ndarray, dict[str, int]]:
    """Log probabilities of letters by context, and the words in use with their counts,
    from all rows of ``docs`` (text).

    Tasks send the counts they have.  The driver gets 27 ** 4 numbers at most and,
    as a word in use has a share of ``IN_USE``, half a million words at most.
    """
    schema = schema_of("gram int, word string, n long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LETTERS ** (CONTEXT + 1), np.int64)
        words: Counter[str] = Counter()

        def rows(grams, words, n) -> pa.RecordBatch:
            columns = [pa.array(grams, pa.int32()), pa.array(words, pa.string()), pa.array(n, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in batches:
            for part in slices(batch):
                texts = part.column(0).to_pylist()
                total += gram_counts(texts)
                for text in texts:
                    words.update(_WORD.findall((text or "").lower()))
                if len(words) > REMEMBERED:
                    yield rows([None] * len(words), list(words.keys()), list(words.values()))
                    words.clear()
        yield rows([None] * len(words), list(words.keys()), list(words.values()))
        kept = np.flatnonzero(total)
        yield rows(kept, [None] * len(kept), total[kept])

    counted = map_batches(docs.select("text"), count, schema).groupBy("gram", "word").agg(F.sum("n").alias("n"))
    counted = store(counted, "letters-and-words")
    rows = counted.where("gram IS NOT NULL").select("gram", "n").toArrow()
    grams = np.zeros(LETTERS ** (CONTEXT + 1))
    grams[rows["gram"].to_numpy()] = rows["n"].to_numpy()
    words = counted.where("word IS NOT NULL").select("word", "n")
    least = max(OFTEN, int((words.agg(F.sum("n")).first()[0] or 0) * IN_USE))
    known = words.where(F.col("n") >= least).toArrow()
    return log_probabilities(grams), dict(zip(known["word"].to_pylist(), known["n"].to_pylist(), strict=True))


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """Each context's letters, smoothed by those of the shorter context."""
    grams = counts.reshape((LETTERS,) * (CONTEXT + 1))
    shorter = np.full(LETTERS, 1 / LETTERS)
    for k in range(CONTEXT + 1):
        own = grams.sum(axis=tuple(range(CONTEXT - k))) if k < CONTEXT else grams
        shorter = (own + 2 * shorter) / (own.sum(axis=-1, keepdims=True) + 2)
    return np.log(shorter).reshape(-1).astype(np.float32)


class Restorer:
    """What disguised spans mean, under log probabilities of letters and with the words
    in use.  Without a list of words only the letters count."""

    def __init__(self, letters: np.ndarray, known: dict[str, int] | None = None) -> None:
        self.table, self.known = letters.tolist(), known
        self.decode = functools.lru_cache(maxsize=REMEMBERED)(self._decode)
        self.read = functools.lru_cache(maxsize=REMEMBERED)(self._read)
        self.meant = functools.lru_cache(maxsize=REMEMBERED)(self._meant)
        # Words that were meant as they stand.
        self.plain: set[str] = set()

    def _decode(self, observed: str, apart: bool) -> str:
        """The likeliest letters.  A state is the letters before; a run of one sign
        may mean one letter or two, and among letters set apart a word may end."""
        states: dict[tuple[int, ...], tuple[float, tuple]] = {(0,) * CONTEXT: (0.0, ())}
        table, at = self.table, 0

        def step(states: dict, code: int, cost: float) -> dict:
            out: dict = {}
            for context, (score, path) in states.items():
                index = 0
                for c in context:
                    index = index * LETTERS + c
                value = score + cost + table[index * LETTERS + code]
                to = (*context[1:], code) if code else (0,) * CONTEXT
                if to not in out or out[to][0] < value:
                    out[to] = (value, (path, code))
            return out

        def best(*options: dict) -> dict:
            out: dict = {}
            for option in options:
                for to, found in option.items():
                    if to not in out or out[to][0] < found[0]:
                        out[to] = found
            return out

        while at < len(observed):
            sign, n = observed[at], 1
            while at + n < len(observed) and observed[at + n] == sign:
                n += 1
            at += n
            meant = MEANT.get(sign)
            codes = [ord(c) - 96 for c in meant] if meant else [_letter(sign)]
            options = []
            for code in codes:
                cost = SIGN if meant else 0.0
                once = step(states, code, cost)
                if n == 1:
                    options.append(once)
                else:
                    options.append({k: (v[0] + (DRAWN if n > 2 else DOUBLED), v[1]) for k, v in once.items()})
                    options.append(step(once, code, cost))
            states = best(*options)
            if apart and at < len(observed):
                states = best(states, step(states, 0, SPLIT))
        _, path = max(step(states, 0, 0.0).values(), key=lambda found: found[0])
        letters = []
        while path:
            path, code = path
            letters.append(chr(code + 96) if code else " ")
        return "".join(reversed(letters)).strip()

    def _read(self, observed: str) -> str:
        """The likeliest reading of a span, the span as it stands among them: signs
        are letters or themselves, runs of a letter mean one, two or all, and what is
        between pieces is dropped or ends a word."""
        table = self.table
        states: dict[tuple[int, ...], tuple[float, tuple]] = {(0,) * CONTEXT: (0.0, ())}

        def step(states: dict, code: int, shown: str, cost: float) -> dict:
            out: dict = {}
            for context, (score, path) in states.items():
                index = 0
                for c in context:
                    index = index * LETTERS + c
                # No word ends where none began.
                value = score + cost + (table[index * LETTERS + code] if code or context[-1] else 0.0)
                to = (*context[1:], code) if code else (0,) * CONTEXT
                if to not in out or out[to][0] < value:
                    out[to] = (value, (path, shown))
            return out

        plain = []
        for m in _RUN.finditer(observed):
            part, sign, n = m[0], m[1], len(m[0])
            codes = [] if sign is None else [ord(c) - 96 for c in MEANT[sign]] if sign in MEANT else [_letter(sign)]
            options = []
            if sign is None or sign in MEANT or codes == [0]:
                options.append(step(states, 0, part, 0.0))
                plain.append(part)
            else:
                plain.append(chr(codes[0] + 96) * n)
            if sign is None:
                options.append({k: (v[0] + JOINED, v[1]) for k, v in states.items()})
            for code in filter(None, codes):
                letter, cost = chr(code + 96), SIGN if sign in MEANT else 0.0
                once = step(states, code, letter, cost)
                options.append({k: (v[0] + (0 if n == 1 else DRAWN if n > 2 else DOUBLED), v[1]) for k, v in once.items()})
                if n > 1:
                    options.append(step(once, code, letter, cost))
                if n > 2 and sign not in MEANT:
                    every = options[-1]
                    for _ in range(n - 2):
                        every = step(every, code, letter, cost)
                    options.append(every)
            states = {}
            for option in options:
                for to, found in option.items():
                    if to not in states or states[to][0] < found[0]:
                        states[to] = found
        _, path = max(step(states, 0, "", 0.0).values(), key=lambda found: found[0])
        shown = []
        while path:
            path, letter = path
            shown.append(letter)
        read = "".join(reversed(shown))
        return observed if read == "".join(plain) else read

    def _meant(self, word: str) -> str:
        """What a word of letters alone was meant to be."""
        if not _TWICE.search(word) or (self.known is not None and word in self.known):
            return word
        if self.known is None or _THRICE.search(word):
            read = self.read(word)
            return read if self._in_use(read) else word
        best, most = word, float(np.log(UNSEEN))
        for dropped, other in single(word):
            if len(other) < LEAST_LETTERS:
                continue
            value = float(np.log(self.known[other])) + dropped * MISTAKEN if other in self.known else most
            if value > most:
                best, most = other, value
        return best

    def _in_use(self, read: str, besides: Container[str] = ()) -> bool:
        """Whether a reading has words, and only words in use (or ``besides``), long
        enough to be what a disguise hides."""
        words = [w for w in _WORD.findall(read) if w not in besides]
        return self.known is None or bool(words) and all(len(w) >= LEAST_LETTERS and w in self.known for w in words)

    def _joined(self, observed: str) -> str:
        """What pieces set apart were meant to be: as they stand if they are short words
        in use, or unless joining them gives words in use."""
        if self.known is not None:
            pieces = _AROUND.findall(observed)
            longer = [p for p in pieces if len(p) > 1]
            if len(pieces) - len(longer) < 3 and all(p in self.known for p in longer):
                return observed
        apart = _APART.fullmatch(observed)
        read = self.decode(observed.replace(apart[1], ""), True) if apart else self.read(observed)
        if self.known is None:
            return read
        return read if self._in_use(read, () if apart else pieces) else observed

    def _unsigned(self, observed: str) -> str:
        """What a run of letters and signs was meant to be, if that is words in use."""
        word = _MARKS.sub("", observed)
        if word.isalpha():
            return observed.replace(word, self.meant(word))
        read = self.read(observed)
        if self._in_use(read):
            return read
        letters = self.decode(observed, False)
        return letters if self._in_use(letters) else observed

    def _signs(self, low: str) -> Iterator[re.Match]:
        """Runs of letters and signs in which a letter stands beside a sign."""
        done = 0
        for hint in _HINT.finditer(low):
            at, end = hint.span()
            if at < done or not (_WORD.match(low, end, end + 1) or at and _WORD.match(low, at - 1, at)):
                continue
            while at > done and _AROUND.fullmatch(low, at - 1, at):
                at -= 1
            run = _AROUND.match(low, at)
            done = run.end()
            yield run

    def lattices(self, low: str) -> list[tuple[int, int, str]]:
        """(start, end, reading) of spans of a text in lower case that may be
        disguised; they do not overlap."""
        found = [(a, b, self._joined(low[a:b])) for a, b in set_apart(low)]
        taken = [(a, b) for a, b, _ in found]
        for m, reading in [*((m, self._unsigned) for m in self._signs(low)), *((m, self.meant) for m in _WORD.finditer(low))]:
            if reading == self.meant and not _TWICE.search(m[0]):
                continue
            k = bisect_right(taken, (m.start(), len(low)))
            if (k == 0 or taken[k - 1][1] <= m.start()) and (k == len(taken) or m.end() <= taken[k][0]):
                found.append((m.start(), m.end(), reading(m[0])))
                insort(taken, (m.start(), m.end()))
        return sorted(found)

    def spans(self, low: str) -> list[tuple[int, int, str]]:
        """(start, end, restored) of the spans that are read otherwise than they stand."""
        return [(a, b, word) for a, b, word in self.lattices(low) if word and word != low[a:b]]

    def restore(self, text: str | None) -> str:
        """The text in lower case with its disguised spans restored."""
        low, out, at = (text or "").lower(), [], 0
        for a, b, word in self.spans(low):
            out += [low[at:a], word]
            at = b
        return "".join([*out, low[at:]])

    def words(self, text: str | None) -> set[str]:
        """Distinct words of the text as it stands and as it is restored."""
        low = (text or "").lower()
        words = set(_WORD.findall(low))
        if len(self.plain) > REMEMBERED:
            self.plain.clear()
        for word in words - self.plain:
            meant = self._meant(word)
            if meant == word:
                self.plain.add(word)
            else:
                words.add(meant)
        for m in self._signs(low):
            if _MARKS.sub("", m[0]).isalpha():
                continue
            words.update(_WORD.findall(self.read(m[0])))
            # The likeliest reading as letters alone counts as well.
            letters = m[0].rstrip("@$!|+")
            if not letters.isalpha() and _AROUND.fullmatch(letters):
                words.update(self.decode(letters, False).split())
        for a, b in set_apart(low):
            words.update(_WORD.findall(self._joined(low[a:b])))
        return words


def set_apart(low: str) -> Iterator[tuple[int, int]]:
    """(start, end) of three pieces or more of one or two letters or signs, with up to
    three blanks or marks between them."""
    marked = f" {low}"
    for sign, letter in _MARKED.items():
        marked = marked.replace(sign, letter)
    for m in _PIECES.finditer(marked):
        yield m.start(1) - 1, m.end(1) - 1


def single(word: str) -> list[tuple[int, str]]:
    """(letters dropped, word) with some of its doubled letters single, one at a time
    or all."""
    at = [m.start() for m in _TWICE.finditer(word)]
    found = [(1, word[:k] + word[k + 1 :]) for k in at]
    if len(at) > 1:
        found.append((len(at), _TWICE.sub(r"\1", word)))
    return found


def features(words: set[str]) -> set[str]:
    """The words, the beginnings of longer ones ('abcd-'), and those that several of
    the words share ('abcd--')."""
    begins = Counter(w[:n] for n in BEGINNINGS for w in words if len(w) > n)
    return words | {f"{b}-" for b in begins} | {f"{b}--" for b, n in begins.items() if n > 1}


@functools.lru_cache(maxsize=1)
def _restorer(shared) -> Restorer:
    return Restorer(*shared.value)


class Model:
    """Weights of words; the score is the logistic function of their sum."""

    def __init__(self, weights: dict[str, float], bias: float) -> None:
        self.names = sorted(weights)
        self.weights, self.bias = [weights[w] for w in self.names], bias
        self.number = {w: k for k, w in enumerate(self.names)}
        #: How words with a feature begin.
        self.begins = {w.rstrip("-")[: BEGINNINGS[0]] for w in self.names}
        self.seen: dict[str, tuple[list[int], list[int]]] = {}

    def of_word(self, word: str) -> tuple[list[int], list[int]]:
        """Numbers of the features that a word has by itself, and with another one."""
        begins = [word[:n] for n in BEGINNINGS if len(word) > n]
        alone = [word, *(f"{b}-" for b in begins)]
        return tuple([self.number[f] for f in fs if f in self.number] for fs in (alone, [f"{b}--" for b in begins]))

    def present(self, words: Iterable[str]) -> list[int]:
        """Numbers of the features of a text with these distinct words, ascending."""
        found, shared, seen = set(), Counter(), self.seen
        if len(seen) > REMEMBERED:
            seen.clear()
        begins, n = self.begins, BEGINNINGS[0]
        for word in [w for w in words if w[:n] in begins]:
            if word not in seen:
                seen[word] = self.of_word(word)
            alone, with_others = seen[word]
            if alone:
                found.update(alone)
            if with_others:
                shared.update(with_others)
        return sorted(found.union(f for f, n in shared.items() if n > 1))

    def score(self, words: Iterable[str]) -> float:
        total = self.bias + sum(self.weights[k] for k in self.present(words))
        return float(1 / (1 + np.exp(-total)))


def train_words(sample: DataFrame, shared) -> Model:
    """A logistic model of ``sample`` (text, toxic), which is bounded.

    Its texts are restored once.  Spark counts the words; the driver sees those that
    tell most, and which of them each sampled text has.  Without rows all scores
    are 0.
    """
    base = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    n, share = base["n"], (base["toxic"] or 0) / max(base["n"], 1)
    if not n or share in (0, 1):
        return Model({}, -np.inf if share == 0 else np.inf)

    def words_of():
        restorer = _restorer(shared)
        return lambda texts: [[sorted(restorer.words(t)) for t in texts]]

    restored = store(append_columns(sample, ["text"], words_of, "words array<string>").select("words", "toxic"), "sample-words")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            rows = [(w, n, seen[1][w]) for w, n in seen[0].items()]
            for c in seen:
                c.clear()
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            types = (pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["word", "n", "toxic"])

        for batch in batches:
            for part in slices(batch):
                for words, toxic in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    own = features(set(words))
                    seen[0].update(own)
                    if toxic:
                        seen[1].update(own)
                if len(seen[0]) > REMEMBERED:
                    yield flush()
        yield flush()

    counted = map_batches(restored, count, schema_of("word string, n long, toxic long"))
    counted = counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).where(F.col("n") >= OFTEN)
    apart = F.abs(F.col("toxic") / F.col("n") - share) / F.sqrt(F.lit(share * (1 - share)) / F.col("n"))
    chosen = counted.withColumn("apart", apart).where(F.col("apart") > APART).orderBy(F.desc("apart"), "word").limit(FEATURES)
    telling = Model({r["word"]: 0.0 for r in chosen.select("word").collect()}, 0.0)

    def present():
        return lambda words: [[telling.present(w) for w in words]]

    known = append_columns(restored, ["words"], present, "found array<int>").select("found", "toxic")
    rows = sorted((tuple(r["found"]), r["toxic"]) for r in known.collect())
    weights, bias = fit([r[0] for r in rows], np.array([r[1] for r in rows]), len(telling.names))
    return Model(dict(zip(telling.names, weights.tolist(), strict=True)), bias)


def fit(rows: list[tuple[int, ...]], labels: np.ndarray, width: int, steps: int = 400, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic regression of presence, by accelerated gradient steps."""
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.fromiter((c for r in rows for c in r), np.int64, len(row))
    at = np.zeros(width + 1)
    mean, square = np.zeros_like(at), np.zeros_like(at)
    at[-1] = np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))
    for t in range(1, steps + 1):
        margin = at[-1] + np.bincount(row, at[column], len(rows))
        error = 1 / (1 + np.exp(-margin)) - labels
        slope = np.append(np.bincount(column, error[row], width) + ridge * at[:-1], error.sum()) / len(rows)
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        at -= 0.1 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-9)
    return at[:-1], float(at[-1])


def train(corpus: DataFrame, sample: DataFrame) -> tuple:
    """Letters and words counted over all of ``corpus`` (text) and a word model of
    ``sample`` (text, toxic), as a broadcast and a model.  The sample is bounded and
    read more than once, so it is stored."""
    sample = store(sample, "toxicity-sample")
    shared = corpus.sparkSession.sparkContext.broadcast(train_corpus(corpus))  # bounded: see there
    return shared, train_words(sample, shared)


def score(docs: DataFrame, trained: tuple, restored: bool = False) -> DataFrame:
    """``docs`` and ``score`` (0 to 1), and the text as it was restored if asked for.

    Null and empty texts have no words: they score what a text without telling
    words does.  Rows are not moved; columns of these names are replaced.
    """
    shared, model = trained

    def task():
        restorer = _restorer(shared)

        def columns(texts):
            out = [[model.score(restorer.words(t)) for t in texts]]
            return [*out, [restorer.restore(t) for t in texts]] if restored else out

        return columns

    return append_columns(docs, ["text"], task, "score double" + (", restored string" if restored else ""))
