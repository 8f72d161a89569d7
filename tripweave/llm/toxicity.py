"""Toxicity by a support vector machine over a gapped string kernel.

The kernel compares words by their common subsequences of three letters, each weighted by
``DECAY`` to the number of letters it skips, so that an insult with letters put in between
still is like the insult. It is normalised by the weights of all subsequences, and word ends
count as letters. Landmarks,
taken from words that labelled toxic texts have and clean ones have not, carry it into a
vector space (Nyström: kernel values with the landmarks times the inverse root of the
landmarks' own kernel matrix), where a linear machine is trained. A text scores by its
most toxic words: a mean of the two largest margins goes through a logistic curve; the
shares in the mean and the curve are fitted to the labelled texts.

Learning needs only whether a text is labelled toxic. It uses at most ``PER_CLASS``
labelled texts of each class, those with the smallest hash of the id, and of their words
at most ``CANDIDATES`` suspicious and ``COUNTER`` clean ones; those are documented bounds,
and the model is of fixed size. Scoring reads all words of all texts.

Letters are the characters of the lower-cased word, as UTF-8. Words are split at ASCII
white space; punctuation at their ends does not count, and three or more single letters in
a row are also read as one word. Words longer than ``WIDTH`` are read in overlapping
stretches. Null and empty texts have no words and score as low as a text without any
suspicious word. Without labelled toxic texts everything scores 0. Repeated rows score
alike; labels may repeat (a text is toxic if any of its labels says so), and null labels
are left out. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tripweave.llm.common import bucket_of, slices, stored, utf8

PER_CLASS = 4000
CANDIDATES = 600
COUNTER = 3000
LANDMARKS = 160
WIDTH = 24
DECAY = 0.6
GAPS = 3
TRAINED = 3  # rows whose id hash, modulo this, is 1 are held out
THRESHOLD = 0.7
PUNCTUATION = b".,;:!?\"'()[]{}<>|/\\*&%$#@~`^_+=-"
SHARES = (1.0, 0.75, 0.5, 0.25)  # of the largest margin in a text's mean
PENALTY = 1e-4
NEEDED = 0.05  # of a suspect's texts, the least share that no stronger suspect explains
FLOOR = -0.5  # no word counts for less than this margin
CACHED = 60_000
SPACED = re.compile(rb"(?<![^\x20\x09-\x0d])(?:\w[\x20\x09-\x0d]+){2,}\w(?![^\x20\x09-\x0d])")


def tokens(text: bytes) -> set[bytes]:
    """The distinct words of a text."""
    found = set(text.split())
    found.update(b"".join(run.split()) for run in SPACED.findall(text))
    return found


def stretches(word: bytes) -> list[bytes]:
    """A word with its ends marked, in overlapping stretches of ``WIDTH`` bytes; one with
    punctuation inside also without that."""
    if word.isalnum() and len(word) + 2 <= WIDTH:
        return [b"\x02" + word + b"\x03"]
    word = word.strip(PUNCTUATION)
    bare = word.translate(None, PUNCTUATION)
    if bare == word and len(word) + 2 <= WIDTH:
        return [b"\x02" + word + b"\x03"]
    out = []
    for form in (word,) if bare == word else (word, bare):
        marked = b"\x02" + form + b"\x03"
        if len(marked) <= WIDTH:
            out.append(marked)
        else:
            out += [marked[i : i + WIDTH] for i in range(0, len(marked) - WIDTH // 2, WIDTH // 2)]
    return out


def with_insertions(word: bytes, times: int = 2) -> list[bytes]:
    """Copies of a marked word, each with one letter put in somewhere: what the machine is
    to tolerate. Which letter and where follows from the word."""
    seed = zlib.crc32(word)
    inside = range(2, len(word) - 1)
    if len(word) >= WIDTH or not inside:
        return []
    places = [inside[(seed >> 5 * i) % len(inside)] for i in range(times)]
    return [word[:at] + bytes([97 + (seed >> 7 * i) % 26]) + word[at:] for i, at in enumerate(places)]


STEPS = [(one, two, DECAY ** (one + two - 2)) for one in range(1, GAPS + 1) for two in range(1, GAPS + 1)]


def laid_out(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' letters with zeros between them, the word of each, and each word's
    length in the kernel's space."""
    gap = bytes(2 * GAPS)
    letters = np.frombuffer(gap.join(words) + gap, np.uint8).astype(np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes + len(gap))
    square = sum(weight**2 * np.maximum(sizes - one - two, 0) for one, two, weight in STEPS)
    return letters, owner, np.sqrt(np.maximum(square, 1e-9))


def triples(letters: np.ndarray, one: int, two: int) -> np.ndarray:
    """For each place the three letters of a gapped triple in one number, 0 for none."""
    n = len(letters) - one - two
    first, second, third = letters[:n], letters[one : one + n], letters[one + two :]
    return np.where((first > 0) & (second > 0) & (third > 0), first << 16 | second << 8 | third, 0)


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, triple, value) of every gapped triple; values in unit length."""
    letters, owner, length = laid_out(words)
    number, code, value = [], [], []
    for one, two, weight in STEPS:
        found = triples(letters, one, two)
        at = np.flatnonzero(found)
        number.append(owner[at])
        code.append(found[at])
        value.append(weight / length[owner[at]])
    return np.concatenate(number), np.concatenate(code), np.concatenate(value)


class Landmarks:
    """Kernel values with a fixed list of words."""

    def __init__(self, words: list[bytes]):
        self.words = words
        number, code, value = features(words)
        self.codes, where = np.unique(code, return_inverse=True)
        self.values = np.zeros((len(self.codes), len(words)))
        np.add.at(self.values, (where, number), value)

    def kernel(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros((len(words), len(self.words)))
        for at in range(0, len(words), 256):
            number, code, value = features(words[at : at + 256])
            rows = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            hit = self.codes[rows] == code
            np.add.at(out, at + number[hit], self.values[rows[hit]] * value[hit][:, None])
        return out


@dataclass
class Model:
    """All that scoring needs; of fixed size. The machine's margin is linear in the kernel
    values and these are linear in a word's triples, so each triple has one share in it."""

    codes: np.ndarray
    shares: np.ndarray
    bias: float
    curve: tuple[float, float, float]

    def __post_init__(self):
        self._known = None
        self._seen: set[bytes] = set()
        self._marked: dict[bytes, float] = {}

    def __getstate__(self):
        return {**self.__dict__, "_known": None, "_seen": set(), "_marked": {}}

    def margins(self, words: list[bytes]) -> np.ndarray:
        """The margin of each word: of its stretches the largest."""
        if not words or not len(self.codes):
            return np.full(len(words), self.bias)
        if self._known is None:
            self._known = np.zeros(1 << 24, bool)
            self._known[self.codes] = True
        cut = [stretches(w) for w in words]
        letters, part, length = laid_out([s for some in cut for s in some])
        total = np.zeros(len(length))
        for one, two, weight in STEPS:
            found = triples(letters, one, two)
            at = np.flatnonzero(self._known[found])
            total += np.bincount(part[at], weight * self.shares[np.searchsorted(self.codes, found[at])], len(length))
        starts = np.cumsum([0, *map(len, cut[:-1])])
        return np.maximum.reduceat(total / length, starts) + self.bias

    def top_two(self, texts: Iterable[bytes]) -> np.ndarray:
        """The two largest margins of each text's words."""
        sets = [tokens(t) for t in texts]
        every = set().union(*sets) if sets else set()
        new = list(every - self._seen)
        if len(self._seen) + len(new) > CACHED:  # begin anew with the words at hand
            self._seen, self._marked = set(), {}
            new = list(every)
        self._seen.update(new)
        margins = self.margins(new)
        raised = np.flatnonzero(margins > FLOOR)
        self._marked.update((new[i], float(margins[i])) for i in raised.tolist())
        out = np.full((len(sets), 2), FLOOR)
        known = self._marked
        for i, words in enumerate(sets):
            if best := sorted(map(known.__getitem__, known.keys() & words))[-2:]:
                out[i, : len(best)] = best[::-1]
        return out

    def probability(self, tops: np.ndarray) -> np.ndarray:
        a, b, c = self.curve
        return 1 / (1 + np.exp(-np.clip(a * tops[:, 0] + b * tops[:, 1] + c, -40, 40)))


def machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Squared-hinge support vector machine by Newton steps, halved until the loss falls;
    the last value is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty * weight.sum())
    ridge[-1] *= 1e-3

    def loss(w: np.ndarray) -> float:
        return float(weight @ np.maximum(0, 1 - y * (x @ w)) ** 2 + ridge @ w**2)

    now = loss(w)
    for _ in range(100):
        active = y * (x @ w) < 1
        xa, wa = x[active], weight[active]
        step = np.linalg.solve((xa * wa[:, None]).T @ xa + np.diag(ridge), (xa * wa[:, None]).T @ y[active]) - w
        size = 1.0
        while size > 1e-6 and (new := loss(w + size * step)) > now:
            size /= 2
        if size <= 1e-6 or now - new < 1e-9 * now:
            break
        w, now = w + size * step, new
    return w


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """A logistic curve over a mean of two values, with the share of the first one that
    fits best."""
    best, curve = np.inf, (0.0, 0.0, 0.0)
    for share in SHARES:
        slope, start = _logistic(x @ np.array([[share], [1 - share]]), y).tolist()
        z = (2 * y - 1) * (slope * (x @ np.array([share, 1 - share])) + start)
        loss = np.logaddexp(0, -z).sum()
        if loss < best:
            best, curve = loss, (share * slope, (1 - share) * slope, start)
    return curve


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.r_[np.full(x.shape[1] - 1, 0.05), 1e-6]
    w = np.zeros(x.shape[1])
    for _ in range(80):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
        w -= step * min(1, 4 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w


def spread_landmarks(words: list[bytes], n: int) -> list[bytes]:
    """Up to ``n`` of the words, each the least like those chosen before it."""
    if len(words) <= n:
        return list(words)
    values = Landmarks(words).kernel(words)
    chosen, like = [0], values[0].copy()
    for _ in range(n - 1):
        nxt = int(np.argmin(like))
        chosen.append(nxt)
        like = np.maximum(like, values[nxt])
    return [words[i] for i in chosen]


def _labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, per_class: int) -> DataFrame:
    """key, text, toxic of at most ``per_class`` training texts of each class."""
    marks = labels.where(F.col("toxic").isNotNull() & (bucket_of(key, TRAINED) != 1))
    marks = marks.groupBy(key).agg(F.max("toxic").cast("int").alias("toxic"))
    turn = F.xxhash64(F.col(key))
    some = [marks.where(F.col("toxic") == c).orderBy(turn, key).limit(per_class) for c in (0, 1)]
    chosen = some[0].unionAll(some[1])  # bounded, so it may be broadcast
    return docs.select(key, text).join(F.broadcast(chosen), key)


def _each_word(batches):
    """Distinct words per text and label."""
    for batch in slices(batches, 0, 2 << 20):
        words, marks = [], []
        for raw, toxic in zip(utf8(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            own = {w.strip(PUNCTUATION) for w in tokens(raw)}
            words += own
            marks += [toxic] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(marks, pa.int32())], names=["word", "toxic"])


def _explaining(sample: DataFrame, suspects: list[tuple[bytes, float]]) -> list[tuple[bytes, float]]:
    """The suspects that toxic texts need: taken in order of evidence, a word stays if it
    stands in texts that hardly any before it stands in. So the other words of a toxic text that
    has many copies are not held against it. Equal texts count once."""
    number = {w: i for i, (w, _) in enumerate(suspects)}

    def found(batches):
        for batch in slices(batches, 0, 2 << 20):
            rows = [
                (zlib.crc32(raw) << 31 | zlib.adler32(raw) >> 1, number[w])
                for raw in utf8(batch.column(0))
                for w in {w.strip(PUNCTUATION) for w in tokens(raw)}
                if w in number
            ]
            texts, words = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.int64()), pa.array(words, pa.int32())], names=["text", "word"])

    # at most PER_CLASS texts with CANDIDATES words
    pairs = sample.where("toxic = 1").select("text").mapInArrow(found, "text long, word int").distinct().toPandas()
    texts = {word: set(own) for word, own in pairs.groupby("word")["text"]}
    explained: Counter = Counter()
    kept = []
    for i, suspect in enumerate(suspects):
        own = texts.get(i, set())
        if sum(explained[t] < 2 for t in own) >= max(2, NEEDED * len(own)):
            kept.append(suspect)
            explained.update(own)
    return kept or suspects[:1]


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", per_class: int = PER_CLASS) -> Model:
    """Learn from the labelled texts that are not held out."""
    sample = _labelled(docs, labels, key, text, per_class)
    sample = stored(sample.select(F.lower(F.coalesce(F.col(text), F.lit(""))).alias("text"), "toxic"), "toxicity-sample")
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return Model(np.zeros(0, np.int64), np.zeros(0), FLOOR, (0.0, 0.0, -40.0))
    words = sample.mapInArrow(_each_word, "word binary, toxic int").where(F.octet_length("word").between(3, WIDTH - 2))
    counts = words.groupBy("word").agg(F.sum("toxic").cast("int").alias("bad"), F.sum(1 - F.col("toxic")).cast("int").alias("good"))
    counts = stored(counts, "toxicity-words")
    # evidence that a word is more frequent in toxic texts than chance has it
    share = sizes[1] / (sizes[0] + sizes[1])
    both = F.col("bad") + F.col("good")
    evidence = (F.col("bad") - both * share) / F.sqrt(both * share * (1 - share) + 1)
    strong = counts.withColumn("evidence", evidence).where("bad > 1 and evidence > 2 and bad > 4 * good")
    picked = strong.orderBy(F.desc("evidence"), "word").limit(CANDIDATES).collect()
    suspects = [(bytes(r.word), r.evidence) for r in picked]
    if not suspects:
        return Model(np.zeros(0, np.int64), np.zeros(0), FLOOR, (0.0, 0.0, -40.0))
    suspects = _explaining(sample, suspects)
    bad = [w for w, _ in suspects]
    probe = Landmarks([b"\x02" + w + b"\x03" for w in spread_landmarks(bad, LANDMARKS)])

    def likeness(batches):
        for batch in batches:
            words = [b"\x02" + w + b"\x03" for w in batch.column(0).to_pylist()]
            near = probe.kernel(words).max(axis=1) if words else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near, pa.float64())], names=["word", "good", "near"])

    clean = counts.where("good > 0 and (bad = 0 or good >= bad)").select("word", "good").mapInArrow(likeness, "word binary, good int, near double")
    # the clean words most like a suspect, and some of every kind
    hard = clean.orderBy(F.desc("near"), "word").limit(COUNTER).union(clean.orderBy(F.xxhash64("word"), "word").limit(COUNTER // 3))
    # a clean word counts for more the more texts have it and the more it is like a suspect
    good = {bytes(r.word): r.good**0.5 * (r.near + 0.2) for r in hard.collect()}
    heavy = sorted(good, key=lambda w: (-good[w], w))[: LANDMARKS // 2]
    positive, negative = [b"\x02" + w + b"\x03" for w in bad], [b"\x02" + w + b"\x03" for w in good]
    landmarks = spread_landmarks(positive, LANDMARKS // 2) + [b"\x02" + w + b"\x03" for w in heavy]
    table = Landmarks(landmarks)
    own = table.kernel(landmarks)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    root = vectors * (1 / np.sqrt(np.maximum(values, 1e-3)))[None, :]
    changed = [v for w in positive for v in with_insertions(w)]
    x = table.kernel(positive + changed + negative) @ root
    y = np.r_[np.ones(len(positive) + len(changed)), -np.ones(len(negative))]
    evidence = np.array([e for _, e in suspects])
    weight = np.r_[evidence / evidence.sum(), np.full(len(changed), 0.1 / max(1, len(changed))), np.array(list(good.values())) / sum(good.values())]
    w = machine(x, y, weight)
    model = Model(table.codes, table.values @ (root @ w[:-1]), float(w[-1]), (1.0, 0.0, 0.0))

    def tops(batches):
        for batch in slices(batches, 0, 2 << 20):
            top = model.top_two(utf8(batch.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array(top[:, 0]), pa.array(top[:, 1]), batch.column(1)], names=["one", "two", "toxic"])

    seen = sample.mapInArrow(tops, "one double, two double, toxic int").toPandas()  # bounded by the sample
    model.curve = logistic(seen[["one", "two"]].to_numpy(), seen["toxic"].to_numpy(float))
    return model


def score(docs: DataFrame, model: Model, text: str = "text", keep: Iterable[str] | None = None, column: str = "toxicity") -> DataFrame:
    """The columns ``keep`` (all by default) of ``docs``, and the score in ``column``."""
    kept = list(docs.columns if keep is None else keep)
    if column in kept:
        raise ValueError(f"the input already has a column {column}")
    lowered = F.lower(F.coalesce(F.col(text), F.lit(""))).alias("lowered")
    rows = docs.select(lowered, F.struct(*[F.col(c) for c in kept]).alias("row"))

    def run(batches):
        for batch in slices(batches, 0, 2 << 20):
            marks = model.probability(model.top_two(utf8(batch.column(0))))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(marks, pa.float64())], names=["row", "score"])

    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema).select("row.*", F.col("score").alias(column))
