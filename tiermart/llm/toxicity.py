"""Toxicity by a support vector machine with a subsequence string kernel.

The kernel of two words is the gap-weighted count of common subsequences of three and
four characters, so that an insult with inserted or left-out characters stays close to the
plain one. Landmark words give a Nyström map, and a linear machine is trained on it.
Labels belong to whole texts: a text is a bag of sentences and words of which only a few
are toxic, so training picks the words that toxic texts share and clean ones lack, adds
spoilt spellings of both kinds, and then adds the clean words that the machine gets
wrong. A text scores by its two worst words. As the kernel is a finite sum over
subsequences, the trained machine folds into one weight for each hashed subsequence.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermart.llm import words as W
from tiermart.llm.common import give_back, stored

DIM = 1 << 20
DECAY = 0.5
# Gaps between the characters of a subsequence, of three and of four characters.
GAPS = [(0, 0), (0, 1), (1, 0), (1, 1), (0, 2), (2, 0), (0, 0, 0), (0, 0, 1), (0, 1, 0), (1, 0, 0), (1, 1, 1)]
LANDMARKS = 240  # toxic ones at most; half as many clean ones
SAMPLE = 2000  # labelled texts of each label at most, in the mean
POSITIVE, FREQUENT, RARE, HARD = 1000, 2500, 2500, 1500
LONGEST = 64  # characters; a longer word is scored in overlapping parts
EDGE = 1  # stands before and after each word
MARKS = ".,;:!?\"'()[]{}<>|*#$%&+=/\\~_-"
CUT = 0.7
WORDS = 4096  # scored at a time
LINES = 32  # of the kernel at a time: each word needs one number for each subsequence and landmark


def _spread(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct lower-case words, the word of each occurrence, and bounds of each text.

    Characters that stand alone three times or more in a row also count as one word,
    and a very long word as its overlapping parts, so that none is cut short.
    """
    index: dict[str, int] = {}
    picks: list[int] = []
    bounds = [0]
    for text in texts:
        found = text.lower().split()
        run: list[str] = []
        extra: list[str] = []
        for word in [w for w in found if len(w) == 1 or len(w) > LONGEST] and [*found, ""]:
            if len(word) == 1:
                run.append(word)
                continue
            if len(run) >= 3:
                extra.append("".join(run))
            run = []
        for word in [*found, *extra]:
            word = word.strip(MARKS) or word
            if len(word) <= LONGEST:
                picks.append(index.setdefault(word, len(index)))
            else:
                for a in range(0, len(word) - LONGEST // 2, LONGEST // 2):
                    picks.append(index.setdefault(word[a : a + LONGEST], len(index)))
        bounds.append(len(picks))
    return list(index), np.asarray(picks, np.int64), np.asarray(bounds, np.int64)


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed subsequences of all words: word number, place among DIM, weight."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(sizes)
    mark = chr(EDGE)
    codes = np.frombuffer((mark + (mark + mark).join(words) + mark).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), sizes)
    room = ends[owner] - np.arange(len(codes))  # places from here to the end of the word
    owners, places, weights = [], [], []
    for gaps in GAPS:
        steps = np.cumsum([0, *(g + 1 for g in gaps)])
        at = np.flatnonzero(room > steps[-1])
        key = np.full(len(at), len(gaps), np.uint64)
        for step in steps.tolist():
            key = key * np.uint64(0x200003) + codes[at + step]
        owners.append(owner[at])
        places.append((W.mixed(key) % np.uint64(DIM)).astype(np.int64))
        weights.append(np.full(len(at), DECAY ** sum(gaps), np.float32))
    return np.concatenate(owners), np.concatenate(places), np.concatenate(weights)


def _norms(owner: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    return np.sqrt(np.maximum(np.bincount(owner, weight * weight, n), 1e-9))


class Landmarks:
    """Landmark words: their subsequences, one row for each that occurs."""

    def __init__(self, words: list[str]):
        owner, place, weight = _features(words)
        self.places, row = np.unique(place, return_inverse=True)
        self.rows = np.zeros((len(self.places) + 1, len(words)), np.float32)  # the last row stays empty
        np.add.at(self.rows, (row, owner), weight / _norms(owner, weight, len(words))[owner])
        self.index = np.full(DIM, len(self.places), np.int32)
        self.index[self.places] = np.arange(len(self.places))

    def gram(self) -> np.ndarray:
        return (self.rows.T @ self.rows).astype(float)

    def kernel(self, words: list[str]) -> np.ndarray:
        """Kernel of each word with each landmark."""
        out = [np.zeros((0, self.rows.shape[1]), np.float32)]
        for a in range(0, len(words), LINES):
            part = words[a : a + LINES]
            owner, place, weight = _features(part)
            order = np.argsort(owner, kind="stable")
            sums = np.zeros((len(part), self.rows.shape[1]), np.float32)
            there, begin = np.unique(owner[order], return_index=True)
            if len(there):
                sums[there] = np.add.reduceat(self.rows[self.index[place[order]]] * weight[order, None], begin)
            out.append(sums / _norms(owner, weight, len(part))[:, None])
        return np.concatenate(out)


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.004) -> np.ndarray:
    """Linear machine with squared hinge loss by Newton steps; the last entry is the offset."""
    size = x.shape[1] + 1
    keep = ridge * np.eye(size)
    keep[-1, -1] = 1e-6
    w = np.zeros(size)
    active = np.ones(len(x), bool)
    for _ in range(30):
        gram, right = keep.copy(), np.zeros(size)
        for a in range(0, len(x), 2000):
            on = active[a : a + 2000]
            part = np.hstack([x[a : a + 2000][on], np.ones((on.sum(), 1), np.float32)]).astype(float)
            scaled = part * weight[a : a + 2000][on, None]
            gram += part.T @ scaled
            right += scaled.T @ y[a : a + 2000][on]
        w = np.linalg.solve(gram, right)
        now = y * (x @ w[:-1].astype(np.float32) + w[-1]) < 1
        if (now == active).all():
            break
        active = now
    return w


def _spoilt(word: str, rng: np.random.Generator) -> list[str]:
    """Spellings of a word with inserted marks, one inserted letter and one left out."""
    if len(word) < 4:
        return []
    at = int(rng.integers(1, len(word) - 1))
    mark = ".-*_"[int(rng.integers(4))]
    letter = "aeionrst"[int(rng.integers(8))]
    return [mark.join(word), word[:at] + mark + word[at:], word[:at] + letter + word[at:], word[:at] + mark + word[at + 1 :]]


@dataclass
class Model:
    """Score of a word: weights[subsequences] / norm + offset; of a text: logistic of its two worst words."""

    weights: np.ndarray
    offset: float
    curve: tuple[float, float, float]

    def words(self, words: list[str]) -> np.ndarray:
        out = [np.zeros(0)]
        for a in range(0, len(words), WORDS):  # a word has about a hundred subsequences
            part = words[a : a + WORDS]
            owner, place, weight = _features(part)
            sums = np.bincount(owner, self.weights[place] * weight, len(part))
            out.append(sums / _norms(owner, weight, len(part)) + self.offset)
        return np.concatenate(out)

    def worst(self, texts: list[str | None]) -> np.ndarray:
        """The scores of the two worst words of each text; -2 where there is none."""
        out = np.full((len(texts), 2), -2.0)
        whole = [t or "" for t in texts]
        for a, b in W.chunks(whole):
            words, picks, bounds = _spread(whole[a:b])
            if not len(picks):
                continue
            filled = np.flatnonzero(np.diff(bounds))
            scores, begin = self.words(words)[picks], bounds[filled]
            top = np.maximum.reduceat(scores, begin)
            row = np.repeat(np.arange(len(filled)), np.diff(bounds)[filled])
            tied = np.flatnonzero(scores == top[row])
            scores[tied[np.unique(row[tied], return_index=True)[1]]] = -2
            out[a + filled] = np.stack([top, np.maximum.reduceat(scores, begin)], 1)
        return np.clip(out, -2, 2)

    def score(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.worst(texts) @ np.array(self.curve[:2]) + self.curve[2])))


def _trained(positive: dict[str, int], negative: dict[str, int], hard: list[str], rng: np.random.Generator) -> Model:
    """Machine on the Nyström map of the words and of their spoilt spellings.

    Both map words to the number of texts that have them; its root weighs a word. Clean
    landmarks are words that an earlier machine found worst, the most frequent, and others.
    """
    spoilt = [s for w in positive for s in _spoilt(w, rng)]
    plain = [s for w in [*negative][::3] for s in _spoilt(w, rng)[:2]]
    words = [*positive, *spoilt, *negative, *plain]
    y = np.array([1.0] * (len(positive) + len(spoilt)) + [-1.0] * (len(negative) + len(plain)))
    often = sorted(negative, key=lambda w: (-negative[w], w))[: LANDMARKS // 6]
    others = [*hard[: LANDMARKS // 4], *often, *rng.permutation([*negative]).tolist()]
    marks = Landmarks([*[*positive][:LANDMARKS], *[*dict.fromkeys(others)][: LANDMARKS // 2]])
    values, vectors = np.linalg.eigh(marks.gram())
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    mapped = marks.kernel(words) @ root.astype(np.float32)
    # Half of the weight for the clean words, and of the other half most for the plain insults.

    def part(total: float, counts: list[int]) -> np.ndarray:
        roots = np.sqrt(np.asarray(counts, float))
        return total * roots / max(roots.sum(), 1e-9)

    share = np.concatenate([part(800, [*positive.values()]), part(200, [1] * len(spoilt)), part(800, [*negative.values()]), part(200, [1] * len(plain))])
    w = _machine(mapped, y, share)
    weights = np.zeros(DIM, np.float32)
    weights[marks.places] = marks.rows[:-1] @ (root @ w[:-1])
    return Model(weights, float(w[-1]), (2.0, 2.0, 0.0))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Two slopes and the shift of a logistic curve, with a little ridge.

    All clean texts together weigh four times as much as all toxic ones, whatever the sample's share.
    """
    design = np.hstack([x, np.ones((len(x), 1))])
    balance = np.where(y > 0, 0.2 / max((y > 0).sum(), 1), 0.8 / max((y <= 0).sum(), 1))
    ridge = np.array([1e-3, 1e-3, 1e-6])

    def loss(w: np.ndarray) -> float:
        z = design @ w
        return float(balance @ (np.logaddexp(0, z) - y * z) + ridge @ (w * w) / 2)

    w = np.zeros(3)
    for _ in range(60):
        p = 1 / (1 + np.exp(-design @ w))
        grad = design.T @ (balance * (p - y)) + ridge * w
        hess = (design * (balance * p * (1 - p))[:, None]).T @ design + np.diag(ridge + 1e-9)
        step = np.linalg.solve(hess, grad)
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w - step
    return tuple(float(v) for v in w)


def _word_rows(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    for a, b in W.chunks(texts):
        for i in range(a, b):
            yield i, _spread(texts[i : i + 1])[0]


def _word_sets(texts: DataFrame) -> list[list[str]]:
    """Distinct words of each text of the bounded sample, near copies once.

    Two texts are near copies here if half of 32 minimal word hashes agree.
    """

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [words for _, words in _word_rows(batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], ["words"])

    found = texts.mapInArrow(held, "words array<string>").toLocalIterator()
    # Most words recur: one string serves all rows.
    rows = sorted(sorted(map(sys.intern, r[0])) for r in found if r[0])
    seeds = W.mixed(np.arange(1, 33, dtype=np.uint64))
    least = np.zeros((len(rows), 32), np.uint64)
    for i, words in enumerate(rows):
        cut = W.cut(["\n".join(words)])  # only to hash them
        codes = np.frombuffer("".join(cut.unique).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, cut.unique), np.int64, len(cut.unique))
        least[i] = W.mixed(W.segment_hashes(codes, np.cumsum(sizes) - sizes)[:, None] ^ seeds[None, :]).min(0)
    kept: list[int] = []
    for i in range(len(rows)):
        if not kept or ((least[kept] == least[i]).sum(1) < 16).all():
            kept.append(i)
    return [rows[i] for i in kept]


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, seed: int = 7) -> Model:
    """Trains on a bounded sample of the labelled rows, about ``sample`` of each label.

    Rows are chosen by a hash of their ids; null labels and texts are left out. Without rows
    of both labels every text scores below one half.
    """
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label")).filter("label IN (0, 1) AND text IS NOT NULL")
    chosen = stored(rows, "toxic")
    sizes = {r[0]: r[1] for r in chosen.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return Model(np.zeros(DIM, np.float32), -1.0, (2.0, 2.0, 0.0))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, labels = batch.column("text").to_pylist(), batch.column("label").to_pylist()
            for i, words in _word_rows(texts):
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([labels[i]] * len(words), pa.int32())], ["word", "label"])

    counted = chosen.filter("label = 0").select("text", "label").distinct().mapInArrow(listed, "word string, label int")
    counted = stored(counted.groupBy("word").agg(F.count("label").alias("clean")), "toxic")
    toxic = _word_sets(chosen.filter("label = 1").select("text").distinct())
    shared = Counter(w for words in toxic for w in words)
    few = {w: n for w, n in shared.items() if n >= 2 and len(w) > 2}
    # How often clean texts have these words: a join, so that the driver reads only those.
    spark = chosen.sparkSession
    few_rows = spark.createDataFrame([*few.items()], "word string, toxic long")
    also = {r.word: r.clean for r in counted.join(few_rows, "word").select("word", "clean").collect()}
    ratio = sizes[0] / max(1, len(toxic))
    chance = len(toxic) / (len(toxic) + sizes[0])
    positive = sorted(
        (w for w, n in few.items() if n * ratio > 20 * also.get(w, 0) and chance**n < 1e-4), key=lambda w: (-few[w], w)
    )[:POSITIVE]
    clean = counted.join(F.broadcast(spark.createDataFrame([(w,) for w in positive], "word string")), "word", "left_anti")
    frequent = clean.orderBy(F.desc("clean"), "word").limit(FREQUENT).collect()
    rare = clean.orderBy(F.xxhash64("word", F.lit(seed)), "word").limit(RARE).collect()
    positive = {w: few[w] for w in positive}
    negative = {r.word: r.clean for r in sorted([*frequent, *rare])}
    if not positive or not negative:
        return Model(np.zeros(DIM, np.float32), -1.0, (2.0, 2.0, 0.0))
    model = _trained(positive, negative, [], np.random.default_rng(seed))

    # Rarer words of toxic texts that look like those found.
    others = sorted({w for words in toxic for w in words if len(w) > 2} - set(positive))
    looks = [w for w, v in zip(others, model.words(others), strict=True) if v > 0.5]
    look_rows = spark.createDataFrame([(w,) for w in looks], "word string")
    known = {r[0] for r in counted.join(look_rows, "word").select("word").collect()}
    positive |= {w: shared[w] for w in looks[:POSITIVE] if shared[w] > 1 and w not in known}

    hard: list[str] = []
    for _ in range(3):
        held = model

        def scored(batches: Iterator[pa.RecordBatch], held: Model = held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                score = pa.array(held.words(batch.column("word").to_pylist()), pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("clean"), score], ["word", "clean", "score"])

        found = clean.select("word", "clean").mapInArrow(scored, "word string, clean long, score double").orderBy(F.desc("score"), "word").limit(HARD).collect()
        hard = list(dict.fromkeys([*[r.word for r in found], *hard]))
        negative |= {r.word: r.clean for r in found}
        model = _trained(positive, negative, hard, np.random.default_rng(seed))
        give_back()

    held = model

    def worst(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = held.worst(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), batch.column("label")], ["first", "second", "label"])

    # Three numbers for each text of the bounded sample.
    ends = chosen.select("text", "label").mapInArrow(worst, "first double, second double, label int").toPandas()
    curve = _logistic(ends[["first", "second"]].to_numpy(), ends["label"].to_numpy().astype(float))
    del toxic, shared, few, others, counted
    give_back()
    return Model(model.weights, model.offset, curve)


def sampled(labels: DataFrame, docs: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", sample: int = SAMPLE, seed: int = 7) -> DataFrame:
    """Labelled documents, about ``sample`` of each label; only they are joined with their texts."""
    known = labels.select(F.col(id_col), F.col(label_col)).filter(F.col(label_col).isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy(label_col).count().collect()}
    scale = 1 << 20
    bar = F.lit(0)
    for value, n in sizes.items():
        bar = F.when(F.col(label_col) == value, min(scale, int(scale * sample / n) + 1)).otherwise(bar)
    few = known.filter(F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(scale)) < bar).dropDuplicates([id_col])
    # Bounded by ``sample`` for each label, whatever the input.
    return docs.join(F.broadcast(few), id_col)


def score(docs: DataFrame, model: Model, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.7 on).

    Null and empty texts get the score of a text without words, which is low. Columns of
    the same names are replaced, as by ``withColumn``; ``prefix`` goes before the new names.
    """
    names = [f"{prefix}score", f"{prefix}predicted"]
    docs = docs.drop(*names)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.score(batch.column(place).to_pylist())
            new = [pa.array(found, pa.float64()), pa.array((found >= CUT).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *names])
            give_back()

    schema = T.StructType([*docs.schema.fields]).add(names[0], T.DoubleType()).add(names[1], T.IntegerType())
    return docs.mapInArrow(run, schema)
