"""Fingerprints, importance resampling and hard negatives against plain versions and SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from checks.compare import connect, differences
from tiermart.llm import fingerprints as P
from tiermart.llm import hard_negatives as H
from tiermart.llm import resampling as R
from tiermart.llm.queries import QUERIES
from tiermart.llm.sql import ORACLES

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, key string, id string, slot int, times int, rank int, score long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "en", "k", "i", 3, 4, 5, 6) for r in rows], DOCS)


@pytest.mark.parametrize("name", ["op12_resampling", "op13_hard_negatives"])
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


# Fingerprints


def lcp(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def test_spans_and_extensions_equal_plain_ones():
    rng = random.Random(1)
    for _ in range(60):
        texts = ["".join(rng.choice("ab\0é😀") for _ in range(rng.randrange(40))) for _ in range(2)]
        texts[1] += texts[0][rng.randrange(len(texts[0]) + 1) :]
        one, two = (P.Text(P.codes_of(t), window=3, slice_size=rng.choice([4, 7, 1000])) for t in texts)
        for _ in range(30):
            i, j = rng.randrange(len(one) + 1), rng.randrange(len(two) + 1)
            n = rng.randrange(min(len(one) - i, len(two) - j) + 1)
            assert (one.span(i, i + n) == two.span(j, j + n)) == (texts[0][i : i + n] == texts[1][j : j + n])
            assert P.common_extension(one, two, i, j) == lcp(texts[0][i:], texts[1][j:])
        assert (one == two) == (texts[0] == texts[1])


def test_windows_do_not_depend_on_slices_and_places():
    rng = random.Random(2)
    codes = P.codes_of("".join(rng.choice("abc ") for _ in range(500)))
    assert len({P.fingerprint(P.Text(codes, slice_size=s)) for s in (30, 64, 1000)}) == 1
    whole = P.Prefixes(codes).windows(24)
    assert (P.Prefixes(codes[100:]).windows(24) == whole[100:]).all()


def test_likeness_follows_what_texts_share():
    rng = random.Random(3)
    words = [f"word{i}" for i in range(5000)]
    text, other = (" ".join(rng.choice(words) for _ in range(1500)) for _ in range(2))
    marks = [P.fingerprint(P.Text(P.codes_of(t))) for t in (text, text[: len(text) // 2] + other[: len(text) // 2], other, "", "short")]
    assert P.likeness(marks[0], marks[0]) == P.likeness(marks[3], marks[3]) == 1
    assert 0.3 < P.likeness(marks[0], marks[1]) < 0.7
    assert P.likeness(marks[0], marks[2]) < 0.05 and P.likeness(marks[0], marks[3]) == P.likeness(marks[3], marks[4]) == 0


def brute_fingerprints(rows):
    """(id, n_chars, digest of the edited text, common prefixes), rows of one id in any order of their texts."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for i, (name, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        yield name, len(text), hashlib.sha256(edited.encode()).hexdigest(), lcp(text, edited), lcp(text, following)


@pytest.mark.parametrize("slots", [1, 3, 40])
def test_neighbours_equal_brute_force(spark, slots):
    rng = random.Random(slots)
    rows = [(i * 7 - 150, "".join(rng.choice("ab é😀") for _ in range(rng.randrange(30))) if i % 5 else None) for i in range(60)]
    rows += [(2**63 - 1, "most"), (-(2**63), "least"), (None, "no id"), (5000, "z" * 400)]
    # One row that holds most of the table.
    rows += [(1000, "the same text")] * 300
    rng.shuffle(rows)
    found = P.compared(frame(spark, rows).repartition(5), slots=slots).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.same_edited, r.same_next) for r in found) == Counter(brute_fingerprints(rows))
    marks = {r.fingerprint for r in found if r.doc_id == 1000}
    assert len(marks) == 1 and marks == {r.fingerprint for r in P.fingerprints(frame(spark, [(1, "the same text")])).collect()}


def test_neighbours_of_few_rows(spark, monkeypatch):
    monkeypatch.setattr(P, "REPEATED", 2)
    assert P.compared(frame(spark, [])).count() == 0
    (one,) = P.compared(frame(spark, [(4, "abcd")])).collect()
    assert (one.near_next, one.same_next, one.same_edited, one.edited_sha256) == (1.0, 4, 2, hashlib.sha256(b"abab").hexdigest())
    assert [(r.doc_id, r.near_next) for r in P.compared(frame(spark, [(4, "a b")] * 7)).collect()] == [(4, 1.0)] * 7
    assert [(r.n_chars, r.near_edited) for r in P.compared(frame(spark, [(1, None), (2, "")])).collect()] == [(0, 1.0)] * 2


def test_long_texts_are_taken_in_slices():
    text = "lorem ipsum " * 40_000
    long = P.Text(P.codes_of(text))
    assert len(long.shifts) > 3 and max(p.n for p in long.open.values()) <= P.SLICE + P.WINDOW
    assert P.common_extension(long, P.Text(P.codes_of(text[:400_001] + "!" + text))) == 400_001


# Importance resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_features(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def plain_resample(docs, target, percent, least_words, buckets=10_000):
    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in plain_features(t)[1])

    s, t = counts(d[1] for d in docs), counts(target)
    whole, wanted = sum(s.values()) + buckets, sum(t.values()) + buckets
    rows = []
    for name, text in docs:
        words, features = plain_features(text)
        gains = [math.floor(1000 * math.log((t[b] + 1.0) * whole / ((s[b] + 1.0) * wanted))) for b in (zlib.crc32(f.encode()) % buckets for f in features)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if name is None else name}".encode()).hexdigest()[:8], 16)
        rows.append((name, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= least_words))
    fit = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = [(*r[:4], i + 1) for i, r in enumerate(fit[: percent * len(fit) // 100])]
    rest = Counter(r[:4] for r in rows) - Counter(r[:4] for r in drawn)
    return Counter(drawn) + Counter({(*r, None): n for r, n in rest.items()})


def test_keys_are_xxhash64_and_slots_crc32():
    rng = random.Random(4)
    data = bytes(rng.randrange(256) for _ in range(3000))
    starts, sizes = np.array([rng.randrange(2900) for _ in range(2000)]), np.array([rng.randrange(70) for _ in range(2000)])
    spans = R.Spans(np.frombuffer(data, np.uint8), starts, sizes)
    assert spans.keys().tolist() == [xxhash.xxh64_intdigest(data[a : a + n]) for a, n in zip(starts, sizes, strict=True)]
    # Keys that all collide: the bytes decide.
    for keys in (None, np.zeros(2000, np.uint64), spans.keys() & np.uint64(7)):
        table = R.Interned(spans, 997, keys)
        texts = [bytes(spans[i]) for i in range(2000)]
        assert len({(p, t) for p, t in zip(table.place.tolist(), texts, strict=True)}) == len(set(texts)) == len(set(table.place.tolist())) == len(table.used)
        assert table.bucket[table.place].tolist() == [zlib.crc32(t) % 997 for t in texts]
        assert sorted(table.count[table.used].tolist()) == sorted(Counter(texts).values())


@pytest.mark.parametrize("part", [4, 30, 1 << 20])
def test_features_of_parts_equal_plain_ones(part):
    rng = random.Random(part)
    for _ in range(50):
        texts = [None if rng.random() < 0.1 else "".join(rng.choice("aB9 é\n.,Z中") for _ in range(rng.randrange(60))) for _ in range(rng.randrange(1, 5))]
        found, words = [[] for _ in texts], [0] * len(texts)
        for begin, features in R._blocks([None if t is None else t.encode() for t in texts], part):
            for k, i in enumerate(features.text.tolist()):
                found[begin + i].append(bytes(features.spans[k]).decode())
            for i, n in enumerate(features.words.tolist()):
                words[begin + i] += n
        for text, mine, n in zip(texts, found, words, strict=True):
            assert (n, sorted(mine)) == (len(plain_features(text)[0]), sorted(plain_features(text)[1]))


def test_resample_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"Word{i}" for i in range(50)] + ["é", "naïve", "中", "x" * 90]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "?!"), (None, "word1 word2 " * 20), (3, rows[3][1]), (503, "one " * 30_000)]
    rows += [(600, "the same words again and again")] * 60
    target = ["word1 word2 word3"] * 5 + [None, ""]
    found = R.resample(frame(spark, rows).repartition(6), frame(spark, list(enumerate(target))), least_words=5).collect()
    got = Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in found)
    assert got == plain_resample(rows, target, 25, 5)


def test_resample_of_empty_tables(spark):
    docs, none = frame(spark, [(1, "a b"), (2, None)]), frame(spark, [])
    assert R.resample(none, docs).count() == 0
    found = {r.doc_id: (r.n_features, r.weight) for r in R.resample(docs, none).collect()}
    assert found[2] == (0, 0) and found[1][0] == 3
    assert R.resample(none, none).count() == 0


# Hard negatives


def brute_negatives(rows, anchor, positives, negatives, low=50, high=95):
    out = []
    for a, la, va in rows:
        if not anchor(a):
            continue
        others = sorted(((-sum(x * y for x, y in zip(va, v, strict=True)), i, lab) for i, lab, v in rows if i != a and len(v) == len(va)))
        near = [(-s, i) for s, i, lab in others if lab == la][:positives]
        for p, i in near:
            fine = [(-s, j) for s, j, lab in others if lab != la and low * p <= -100 * s <= high * p][:negatives]
            out += [(a, i, r + 1, j, p, s) for r, (s, j) in enumerate(fine)]
    return sorted(out)


VECTORS = "vec_id long, label long, v array<long>"


@pytest.mark.parametrize(("seed", "shard", "block"), [(1, 16, 4), (2, 1000, 1000), (3, 7, 1), (4, 50, 8)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, seed, shard, block):
    monkeypatch.setattr(H, "BUCKET", 5)
    rng = random.Random(seed)
    rows = []
    for i in range(150):
        size = rng.choice([0, 1, 3, 40])
        rows.append((i - 20, rng.choice([0, 0, 0, 1, -2]), [rng.randrange(-size, size + 1) for _ in range(4 if i % 9 else 3)]))
    rows += [(500 + i, 1, [3, 1, 0, 2]) for i in range(40)]  # one very common vector
    found = H.mine(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 5 == 0, shard=shard, block=block).collect()
    assert sorted(map(tuple, found)) == brute_negatives(rows, lambda i: i % 5 == 0, 5, 3)


def test_ranges_never_lose_a_candidate():
    rng = np.random.default_rng(6)
    for _ in range(200):
        vectors = rng.integers(-9, 10, (30, 6))
        norms = np.sqrt((vectors**2).sum(1).astype(float))
        order = np.argsort(-norms, kind="stable")
        bucket = H.Bucket(np.arange(30), vectors[order], norms[order])
        query = rng.integers(-9, 10, 6)
        length = float(np.sqrt((query**2).sum()))
        unit = query / length if length else query.astype(float)
        scores = bucket.vectors @ query
        least = float(rng.choice(scores))
        rows = bucket.candidates(unit, np.argsort(-np.abs(unit))[:4], length, least)
        assert set(np.flatnonzero(scores >= least).tolist()) <= set(rows.tolist())


def test_ranges_leave_most_of_clustered_vectors_out():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 8))
    vectors = centres[rng.integers(0, 40, 2000)] + rng.normal(size=(2000, 8)) / 20
    vectors = (vectors / np.linalg.norm(vectors, axis=1)[:, None] * 1000).astype(np.int64)
    norms = np.linalg.norm(vectors, axis=1)
    order = np.argsort(-norms)
    bucket = H.Bucket(np.arange(2000), vectors[order], norms[order])
    query, length = vectors[0], float(np.linalg.norm(vectors[0]))
    rows = bucket.candidates(query / length, np.argsort(-np.abs(query))[:4], length, 0.95 * length**2)
    assert len(rows) < 400


def test_odd_rows_take_no_part(spark):
    schema = "vec_id long, embedding array<float>, label int, v string, shard int, block int, least int"
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 0), (2, None, 0), (3, [1.0, None], 0), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (7, [], 1), (8, [0.5, -0.001], 1), (8, [0.5, -0.001], 1), (8, [9.0, 9.0], 2)]
    frame_ = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], schema)
    assert sorted(map(tuple, H.whole_vectors(frame_).collect())) == [(1, 0, [256, 512]), (8, 1, [128, -1])]
    assert H.mine(H.whole_vectors(frame_), F.col("vec_id") % 2 == 0).count() == 0
    assert H.mine(H.whole_vectors(frame_.filter("vec_id = 99")), F.lit(True)).count() == 0
