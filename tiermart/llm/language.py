"""Language identification by nearest centroid.

A text becomes a TF-IDF vector over hashed character n-grams of its letters, scaled
to length one. Each language has several centroids, found by spherical k-means
over a bounded sample of labelled rows; the language of the closest centroid by cosine
wins. A row whose best cosine is far below what training rows of its length reach is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermart.llm import words as W
from tiermart.llm.common import give_back

DIM = 4096
GRAMS = 2  # short runs of letters are what invented and natural texts of a language share
CENTROIDS = 4
SAMPLE = 600  # labelled rows of each language at most, in the mean
SAMPLE_ALL = 4800  # and of all languages together, but one row of each
FAR = 0.5  # of the lowest usual similarity
USUAL = 0.01  # share of training rows below the lowest usual similarity
LONG = 128  # letters from which on the similarity of a text no longer depends much on its length
GROWTH = 0.4  # power of the number of letters with which it grows before
TEXTS = 512
UNKNOWN = "und"


def _counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram counts of each text, and the number of letters of each."""
    n = len(texts)
    lowered = [t.lower() for t in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, n)
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(n), sizes)
    letter = W.classes()[codes] == W.LETTER
    letters = np.bincount(row[letter], minlength=n)
    # Everything between two words is one blank.
    codes = np.where(letter, codes, 32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    codes, row = codes[keep].astype(np.uint64), row[keep]
    found = np.zeros(n * DIM, np.float32)
    for k in range(1, GRAMS + 1):
        if len(codes) < k:
            break
        gram = np.full(len(codes) - k + 1, k, np.uint64)
        for i in range(k):
            gram = gram * np.uint64(0x1FFFFF) + codes[i : len(codes) - k + 1 + i]
        whole = row[: len(gram)] == row[k - 1 :]
        place = row[: len(gram)] * DIM + (W.mixed(gram) % np.uint64(DIM)).astype(np.int64)
        found += np.bincount(place[whole], minlength=n * DIM).astype(np.float32)
    return found.reshape(n, DIM), letters


def _reach(letters: np.ndarray) -> np.ndarray:
    """Share of the similarity of long texts that texts of so many letters reach."""
    return np.minimum(1, letters / LONG) ** GROWTH


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The TF-IDF vectors of ``counts``, which they replace: no second table of that size is needed."""
    for a in range(0, len(counts), TEXTS):
        part = counts[a : a + TEXTS]
        np.sqrt(part, out=part)
        part *= idf
        part /= np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-12)
    return counts


def _table(found: pa.Table) -> np.ndarray:
    """Counts of all rows, decoded row by row."""
    counts = np.empty((found.num_rows, DIM), np.float32)
    at = 0
    for chunk in found["counts"].chunks:
        for value in chunk:
            counts[at] = np.frombuffer(value.as_buffer(), np.float16)
            at += 1
    return counts


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray  # language of each centroid
    languages: list[str]
    floor: np.ndarray  # lowest similarity of a long text that is not far, by centroid

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine with the closest centroid, and whether that is too far, of each text."""
        counts, letters = _counts([t or "" for t in texts])
        lettered = letters > 0
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        near = _weighted(counts, self.idf) @ self.centroids.T
        best = near.argmax(1)
        score = np.where(lettered, np.clip(near[np.arange(len(best)), best], 0, 1), 0).astype(float)
        labels = [self.languages[self.owner[b]] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
        return labels, score, ~lettered | (score < self.floor[best] * _reach(letters))


def _clusters(rows: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Spherical k-means; an empty cluster goes."""
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)]
    for _ in range(12):
        own = (rows @ centres.T).argmax(1)
        centres = _unit(np.stack([rows[own == i].mean(0) for i in range(len(centres)) if (own == i).any()]))
    return centres


def _apart(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Each row's similarity with the closest centroid, its own one taken without the row."""
    near = rows @ centres.T
    own = near.argmax(1)
    sums = np.stack([rows[own == i].sum(0) for i in range(len(centres))])
    each = np.arange(len(rows))
    inner = (rows * sums[own]).sum(1)
    rest = np.sqrt(np.maximum((sums[own] ** 2).sum(1) - 2 * inner + 1, 0))
    near[each, own] = np.where(rest > 1e-3, (inner - 1) / np.maximum(rest, 1e-3), 0)
    return near.max(1).clip(0, 1)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, seed: int = 5) -> Model:
    """Centroids from a bounded sample of the rows with a language and a text.

    About ``sample`` rows of each language are used, chosen by a hash of their ids, and about
    ``SAMPLE_ALL`` in all if there are many languages. Without labelled rows the model knows no
    language and rejects everything.
    """
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    each = min(sample, max(1, SAMPLE_ALL // max(1, len(sizes))))
    scale = 1 << 20
    bars = labelled.sparkSession.createDataFrame([(lang, min(scale, int(scale * each / n) + 1)) for lang, n in sizes.items()], "lang string, bar int")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, TEXTS):
                part = batch.slice(a, TEXTS)
                counts, letters = _counts(part.column("text").to_pylist())
                lettered = letters > 0
                kept = part.filter(pa.array(lettered))
                yield pa.RecordBatch.from_arrays([kept.column("lang"), pa.array([np.minimum(c, 60_000).astype(np.float16).tobytes() for c in counts[lettered]], pa.binary()), pa.array(letters[lettered], pa.int64())], ["lang", "counts", "letters"])

    # One row for each language.
    chosen = rows.join(F.broadcast(bars), "lang").filter(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(scale)) < F.col("bar")).select("id", "text", "lang")
    found = chosen.mapInArrow(vectors, "lang string, counts binary, letters long").toArrow()
    order = pc.sort_indices(found, sort_keys=[("lang", "ascending"), ("counts", "ascending")]).to_numpy()
    names = found["lang"].to_numpy()[order].tolist()
    languages = sorted(set(names))
    if not languages:
        return Model(np.ones(DIM, np.float32), np.zeros((0, DIM), np.float32), np.zeros(0, int), [], np.zeros(0))
    counts, letters = _table(found), found["letters"].to_numpy()[order]
    # The driver holds one copy of the sample at a time.
    del found
    give_back()
    idf = (np.log((1 + len(counts)) / (1 + np.count_nonzero(counts, axis=0))) + 1).astype(np.float32)
    rows_, rng = _weighted(counts, idf), np.random.default_rng(seed)
    label = np.array([languages.index(x) for x in names])
    # Rows of one language at a time, in the order of their counts.
    rows_of = [order[label == i] for i in range(len(languages))]
    parts = [_clusters(rows_[own], CENTROIDS, rng) for own in rows_of]
    reach = _reach(letters)
    floor = [np.full(len(p), FAR * np.quantile(_apart(rows_[rows_of[i]], p) / reach[label == i], USUAL)) for i, p in enumerate(parts)]
    del counts, rows_
    give_back()
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return Model(idf, np.concatenate(parts).astype(np.float32), owner, languages, np.concatenate(floor))


def identify(docs: DataFrame, model: Model, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (the cosine, 0 to 1) and ``rejected``.

    A null text or one without a letter is ``und``, has score 0 and is rejected. Columns of
    the same names are replaced, as by ``withColumn``; ``prefix`` goes before the new names.
    """
    names = [f"{prefix}{n}" for n in ("lang_pred", "score", "rejected")]
    docs = docs.drop(*names)
    place = docs.columns.index(text_col)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            begin = 0
            while begin < len(texts):
                end, held = begin, 0
                while end < len(texts) and end - begin < TEXTS and held < W.CHUNK:
                    held += len(texts[end] or "")
                    end += 1
                label, score, rejected = model.predict(texts[begin:end])
                new = [pa.array(label, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*batch.slice(begin, end - begin).columns, *new], [*batch.schema.names, *names])
                begin = end
            give_back()

    types = ("string", "double", "boolean")
    schema = docs.schema
    for name, kind in zip(names, types, strict=True):
        schema = T.StructType([*schema.fields]).add(name, kind)
    return docs.mapInArrow(predict, schema)
