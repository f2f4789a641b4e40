"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch

#: Subsequences of three characters that lie within SPAN characters; each counts DECAY ** (last - first).
SPAN, DECAY = 5, 0.6
_OFFSETS = [(a, b) for b in range(2, SPAN + 1) for a in range(1, b)]
#: Character classes; a table of subsequences has _CLASSES ** 3 entries.
_CLASSES = 64
#: Labelled texts that a model is fitted on at most, by label, and words of each kind.
MAX_TOXIC, MAX_CLEAN, MAX_WORDS = 2_000, 8_000, 1_500
LANDMARKS, RIDGE = 128, 1e-6
#: What separates words besides white space, as in paths and tables, and spaces of other scripts.
SIGNS, SPACES = "/|,;", "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u200b\u202f\u205f\u3000"
SEPARATOR = rf"[\x20\x09-\x0D{SIGNS}{SPACES}]+"
#: A longer run counts as overlapping windows of so many characters, as in scripts without spaces.
RUN = 40
#: Words that decide about a text together: the highest.
TOP = 3
#: Characters scored at a time; a longer run without white space is cut there.
STRETCH = 1 << 20
#: Times that the share of toxic texts with a witness is that of clean ones at least.
ODDS = 50
#: Rounds in which clean words that score high are added.
ROUNDS = 2


def _class_table() -> np.ndarray:
    """Class of each byte: 0 white space, 1-26 letters without case, 27 other digits, 28 signs, 29-60 by the last byte of
    longer characters (their case falls together), 255 first bytes, which are left out. Digits and signs that are
    written for letters count as these."""
    table = np.full(256, 28, np.uint8)
    for b in range(26):
        table[[65 + b, 97 + b]] = 1 + b
    table[48:58] = 27
    for sign, letter in zip("013457@$", "oieastas"):
        table[ord(sign)] = ord(letter) - 96
    for b in (9, 10, 11, 12, 13, 32):
        table[b] = 0
    table[128:192] = 29 + (np.arange(64) & 31)
    table[192:] = 255
    return table


_TABLE = _class_table()
_TEXT_TABLE = _TABLE.copy()
_TEXT_TABLE[np.frombuffer(SIGNS.encode(), np.uint8)] = 0
_NORM = np.sqrt(
    np.maximum(sum(np.maximum(0, np.arange(1 << 12) - b) * DECAY ** (2 * b) for _, b in _OFFSETS), DECAY**4)
).astype(np.float32)


def _classes(text: str, table: np.ndarray = _TABLE) -> np.ndarray:
    """Classes of the characters. A space between single characters goes, so that spelled-out words come together."""
    c = table[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    c = c[c != 255]
    if len(c) > 4:
        p = np.zeros(len(c) + 4, bool)  # white space, with an edge of it on both sides
        p[:2] = p[-2:] = True
        p[2:-2] = c == 0
        soft = p[2:-2] & ~p[1:-3] & p[:-4] & ~p[3:-1] & p[4:]
        c = c[~soft]
    return c


def _sums(c: np.ndarray, table: np.ndarray, run: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each word of `c` the sum of `table` over its subsequences, and its length. With `run`, a longer word is
    replaced by windows of that length which overlap by half, with the subsequences that begin there."""
    space = c == 0
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    if not len(starts):
        return np.zeros(0, np.float32), np.zeros(0, np.int64)
    word = np.cumsum(space)
    wide = c.astype(np.int32)
    total = np.zeros(len(c), np.float32)
    for b in range(2, SPAN + 1):
        n = len(c) - b
        if n <= 0:
            break
        inside = word[:n] == word[b:]
        ends = wide[:n] * (_CLASSES * _CLASSES) + wide[b:]
        here = np.zeros(n, np.float32)
        for a in range(1, b):
            here += table[ends + wide[a : a + n] * _CLASSES]
        total[:n] += np.where(inside & ~space[:n], here, 0) * np.float32(DECAY**b)
    sums = np.add.reduceat(total, starts)
    lengths = np.flatnonzero(~space & np.concatenate((space[1:], [True]))) - starts + 1
    if run is None or lengths.max() <= run:
        return sums, lengths
    more, wide = [], []
    for k in np.flatnonzero(lengths > run):
        before = np.concatenate(([0], np.cumsum(total[starts[k] : starts[k] + lengths[k]], dtype=np.float64)))
        at = np.arange(0, lengths[k] - run // 2, run // 2)
        end = np.minimum(at + run, lengths[k])
        more.append(before[end] - before[at])
        wide.append(end - at)
    short = lengths <= run
    return (
        np.concatenate([sums[short], *more]).astype(np.float32),
        np.concatenate([lengths[short], *wide]),
    )


def _kernel(words: list[str], table: np.ndarray) -> np.ndarray:
    """Kernel of each word with what `table` was made of; divided by a norm that depends on the word's length only."""
    sums, lengths = _sums(_classes("  ".join(words)), table)
    return sums / _NORM[np.minimum(lengths, len(_NORM) - 1)]


def _features(word: str) -> tuple[np.ndarray, np.ndarray]:
    """The word's subsequences, as places in a table, and their weights. A word of 40 characters has about 400."""
    c = _classes(word).astype(np.int64)
    places, weights = [], []
    for a, b in _OFFSETS:
        n = len(c) - b
        if n > 0:
            places.append(c[:n] * _CLASSES * _CLASSES + c[a : a + n] * _CLASSES + c[b:])
            weights.append(np.full(n, DECAY**b))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0)
    found, at = np.unique(np.concatenate(places), return_inverse=True)
    return found, np.bincount(at, np.concatenate(weights)) / _NORM[min(len(c), len(_NORM) - 1)]


class _Landmarks:
    """Kernels of a list of words with one landmark after another; a single table serves all of them."""

    def __init__(self, words: list[str]) -> None:
        self.table = np.zeros(_CLASSES**3, np.float32)
        self.classes = _classes("  ".join(words))

    def kernel(self, landmark: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        places, weights = landmark
        self.table[places] = weights
        sums, lengths = _sums(self.classes, self.table)
        self.table[places] = 0
        return sums / _NORM[np.minimum(lengths, len(_NORM) - 1)]


@dataclass
class Model:
    """A word's decision is the kernel with `table` plus `bias`; a text's score comes from its TOP highest words."""

    table: np.ndarray = field(default_factory=lambda: np.zeros(_CLASSES**3, np.float32))
    bias: float = 0.0
    weights: np.ndarray = field(default_factory=lambda: np.ones(TOP))
    shift: float = -6.0 * TOP

    def top(self, text: str) -> np.ndarray:
        """Decisions of the highest words, from the highest; -1 in place of words that are not there."""
        best = np.full(TOP, -1.0)
        if not text.isascii():
            for space in SPACES:
                text = text.replace(space, " ")
        c = _classes(text, _TEXT_TABLE)
        at = 0
        while at < len(c):
            part = c[at : at + STRETCH]
            if len(part) == STRETCH and (spaces := np.flatnonzero(part == 0)).size and spaces[-1]:
                part = part[: spaces[-1]]
            at += len(part)
            sums, lengths = _sums(part, self.table, RUN)
            f = sums / _NORM[lengths] + self.bias
            f = np.partition(f, -TOP)[-TOP:] if len(f) > TOP else f
            best = np.sort(np.concatenate([best, f]))[::-1][:TOP]
        return np.clip(best, -1, 4)

    def decision(self, text: str) -> float:
        return float(self.top(text)[0])

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.top(text) @ self.weights + self.shift, -50, 50))))


def fit_texts(f: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights, none of them negative, and shift of a logistic curve through the highest decisions of labelled texts."""
    x = np.hstack([f, np.ones((len(f), 1))])
    w = np.array([1.0] * f.shape[1] + [-2.0])
    curve = np.linalg.eigvalsh(x.T @ x / len(x))[-1] / 4 + 1e-4
    ahead, t = w.copy(), 1.0
    for _ in range(5000):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -50, 50)))
        new = ahead - (x.T @ (p - y) / len(x) + 1e-4 * np.append(ahead[:-1], 0)) / curve
        new[:-1] = np.maximum(new[:-1], 0)
        later = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / later * (new - w), new, later
    return w[:-1], float(w[-1])


def _gapped(word: str) -> list[str]:
    """The word with a sign, and with a letter, put in its middle: insults are written so to escape lists."""
    k = len(word) // 2
    return [word[:k] + "." + word[k:], word[:k] + word[k - 1] + word[k:]] if len(word) > 3 else []


def fit_words(positive: list[tuple[str, float]], negative: list[tuple[str, float]], landmarks: int = LANDMARKS) -> Model:
    """Support vector machine on weighted words: Nyström features of the landmarks, squared hinge loss, Newton steps.

    Landmarks are taken from both sides, each the word that is farthest from those taken before.
    """
    chosen: list[tuple[np.ndarray, np.ndarray]] = []
    for side in (positive, negative):
        words = [w for w, _ in side]
        kernels = _Landmarks(words)
        near = np.full(len(words), -np.inf)
        at = 0
        for _ in range(min(landmarks, len(words))):
            chosen.append(_features(words[at]))
            near = np.maximum(near, kernels.kernel(chosen[-1]))
            at = int(np.argmin(near))
    samples = positive + [(g, w / 2) for word, w in positive for g in _gapped(word)] + negative
    words = [w for w, _ in samples]
    y = np.array([1.0] * (len(samples) - len(negative)) + [-1.0] * len(negative))
    weight = np.array([w for _, w in samples])
    for side in (y > 0, y < 0):
        weight[side] *= 0.5 / weight[side].sum()
    kernels = _Landmarks(words)
    k = np.stack([kernels.kernel(z) for z in chosen], axis=1).astype(np.float64)
    shared = np.zeros(_CLASSES**3)
    gram = np.empty((len(chosen), len(chosen)))
    for j, (places, weights) in enumerate(chosen):
        shared[places] = weights
        gram[j] = [float(w @ shared[p]) for p, w in chosen]
        shared[places] = 0
    values, vectors = np.linalg.eigh(gram)
    good = values > 1e-6 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])
    x = np.hstack([k @ root, np.ones((len(words), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), RIDGE)
    ridge[-1] = RIDGE / 1e4
    for _ in range(30):
        active = y * (x @ w) < 1
        d = weight * active
        new = np.linalg.solve((x * d[:, None]).T @ x + np.diag(ridge), x.T @ (d * y))
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    beta = root @ w[:-1]
    for b, (places, weights) in zip(beta, chosen):
        shared[places] += b * weights
    return Model(shared.astype(np.float32), float(w[-1]))


def is_held_out(id_: Column, folds: int = 5) -> Column:
    return F.crc32(F.coalesce(id_.cast("string"), F.lit(""))) % folds == 0


def _bare(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")


def _one_of_each(sample: DataFrame) -> DataFrame:
    """One text of those that share the smallest hashes of their long words, as copies and most near copies do."""
    words = F.filter(F.transform(F.split("_text", SEPARATOR), _bare), lambda w: F.length(w) > 7)
    rows = sample.withColumn("_long", words)
    least = [F.array_min(F.transform("_long", lambda w, k=k: F.xxhash64(w, F.lit(k)))) for k in (1, 2)]
    same = [F.coalesce(h, F.xxhash64("_text")).alias(f"_same{k}") for k, h in enumerate(least)]
    return rows.groupBy(*same).agg(F.max("_toxic").alias("_toxic"), F.min("_text").alias("_text"))


def _units(word: Column) -> Column:
    """The word, and its stems of some lengths with a dash."""
    stems = (F.when(F.length(word) >= n, F.concat(F.substring(word, 1, n), F.lit("-"))) for n in (5, 6, 8))
    return F.array_compact(F.array(word, *stems))


def _rare_by_chance(toxic: int, clean: int, words: int) -> int:
    """So many toxic texts, and no clean one, hold a word by chance in less than one of ten such tables of words."""
    return max(2, math.ceil(math.log(10 * max(words, 1)) / -math.log(toxic / (toxic + clean))))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from labelled texts outside the held-out fold, at most MAX_TOXIC and MAX_CLEAN of them, in hash order.

    Labels are of texts, so a text is a bag of words, some of which are the reason. Words and stems that many toxic
    texts and no clean ones hold, more than chance brings, tell the witnesses; copies and near copies count once. A
    machine is trained on the witnesses against frequent and arbitrary words of clean texts. In rounds, the clean words
    that it scores highest are added. Then the TOP highest words of each sampled text are weighed against its label, so
    that one clear insult or some weaker ones decide.
    Without texts of both labels nothing is toxic.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~is_held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max("toxic").alias("_toxic"))
    )
    order = F.xxhash64("_id")
    few = known.where("_toxic = 1").orderBy(order, "_id").limit(MAX_TOXIC)
    few = scratch.save(few.unionByName(known.where("_toxic = 0").orderBy(order, "_id").limit(MAX_CLEAN)))
    # At most MAX_TOXIC + MAX_CLEAN ids.
    sample = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(
        F.broadcast(few), "_id"
    )
    sample = scratch.save(_one_of_each(sample).select("_toxic", "_text"))
    sizes = {r["_toxic"]: r["count"] for r in sample.groupBy("_toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Model()

    split = F.array_distinct(F.transform(F.split("_text", SEPARATOR), _bare))
    texts = sample.select("_toxic", F.filter(split, lambda w: F.length(w).between(3, 40)).alias("_words"))

    def tally(column: Column, name: str) -> DataFrame:
        each = texts.select("_toxic", F.explode(column).alias(name))
        return scratch.save(
            each.groupBy(name).agg(F.sum("_toxic").alias("t"), F.sum(1 - F.col("_toxic")).alias("c"))
        )

    counts = tally(F.col("_words"), "word")
    units = tally(F.array_distinct(F.flatten(F.transform("_words", _units))), "unit")
    mixed = F.xxhash64("word")

    def some(rows: DataFrame, *by: Column, n: int = MAX_WORDS) -> list:
        return rows.orderBy(*by, mixed).limit(n).collect()

    # Labels may be wrong now and then, so a few clean texts do not clear a unit of many toxic ones.
    mostly = F.col("c") / n_clean * ODDS <= F.col("t") / n_toxic
    least = _rare_by_chance(n_toxic, n_clean, units.count())
    suspect = units.where((F.col("t") >= least) & mostly).select("unit")
    held = counts.where(mostly).select("word", "t", F.explode(_units(F.col("word"))).alias("unit"))
    witness = held.join(suspect, "unit").groupBy("word").agg(F.max("t").alias("t"))
    positive = {r.word: float(r.t) ** 0.5 for r in some(witness, F.desc("t"))}
    clean = counts.where(F.col("c") * 10 > F.col("t"))
    negative = {r.word: 1.0 for r in some(clean, F.desc("c")) + some(clean.where("c < 3"))}
    if not positive or not negative:
        return Model()
    model = fit_words(list(positive.items()), list(negative.items()))
    for _ in range(ROUNDS):
        hard = some(clean.withColumn("_f", decision(F.col("word"), model)), F.desc("_f"), n=MAX_WORDS // 2)
        negative |= {r.word: 1.0 for r in hard}
        model = fit_words(list(positive.items()), list(negative.items()))

    judged = sample.select("_toxic", top(F.col("_text"), model).alias("_f")).collect()
    model.weights, model.shift = fit_texts(np.array([r._f for r in judged]), np.array([r._toxic for r in judged]))
    return model


def top(text: Column, model: Model) -> Column:
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([model.top(t or "").tolist() for t in texts.to_pylist()], pa.list_(pa.float64()))

    return run(text)


def decision(text: Column, model: Model) -> Column:
    @F.arrow_udf(T.DoubleType())
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([model.decision(t or "") for t in texts.to_pylist()], pa.float64())

    return run(text)


def score(text: Column, model: Model) -> Column:
    @F.arrow_udf(T.DoubleType())
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t or "") for t in texts.to_pylist()], pa.float64())

    return run(text)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of `docs`: `id_col`, held_out, score (0 to 1), predicted (1 if score >= 0.5).

    Every word of the whole text is scored, longer runs in windows; the TOP highest decide, whatever the text's length.
    Characters put between the letters of an insult, letters written as digits and spelled-out words still share most
    subsequences with it. The model is one table of fixed size, sent with the function; there is no shuffle.

    Null and empty texts score lowest. Null ids belong to the fold of the empty string; null labels, and labels without
    a document, are left out; of several labels of one id the highest counts. Other columns are ignored.
    """
    model = fit(docs, labels, id_col, text_col)
    scored = docs.select(
        id_col, is_held_out(F.col(id_col)).alias("held_out"), score(F.col(text_col), model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
