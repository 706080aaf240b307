"""Document operators against plain versions, with nulls, ties, repeats, empty tables and odd columns."""

import hashlib
import random
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from tiermart.llm import byte_bpe, exact_dedup, graph, near_dedup, packing, sharding
from tiermart.llm import words as W

DOCS = "doc_id long, text string, lang string, kept string, n string"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame([(*r, *[None] * (5 - len(r))) for r in rows] if schema == DOCS else rows, schema)


# Words


def test_words_are_those_of_the_pattern():
    pattern = regex.compile(W.PATTERN.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))
    rng = random.Random(3)
    pieces = ["'", "s", "t", "re", "ve", "ll", " ", "  ", "\n", "é", "1", "½", "!", "中", "😀", " a", "B", "'s", "\x1c", "\x85"]
    for _ in range(400):
        texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(12))) for _ in range(rng.randrange(1, 6))]
        found = W.cut(texts)
        for i, text in enumerate(texts):
            assert [found.unique[k] for k in found.inverse[found.offsets[i] : found.offsets[i + 1]]] == pattern.findall(text)


# Exact dedup


def test_exact_groups_equal_brute_force(spark):
    rng = random.Random(1)
    texts = ["a", "a\0", "", None, "x" * 70, "x" * 70 + "y", "é" * 40, "hot"]
    rows = [(i, rng.choice(texts[:7]) if i % 3 else "hot") for i in range(300)]
    found = {r.doc_id: r for r in exact_dedup.exact_groups(frame(spark, rows), slots=7).collect()}
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    assert len(found) == len(rows)
    for i, text in rows:
        mine, r = groups[text or ""], found[i]
        assert (r.keep_id, r.group_size, r.kept) == (max(mine), len(mine), i == max(mine))
        assert r.text_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_exact_groups_of_odd_ids(spark):
    rows = [(None, "a"), (-5, "a"), (3, "b"), (3, "b"), (None, "c")]
    found = exact_dedup.exact_groups(frame(spark, rows)).collect()
    assert sorted((r.keep_id is None, r.keep_id or 0, r.group_size) for r in found) == [(False, -5, 2), (False, -5, 2), (False, 3, 2), (False, 3, 2), (True, 0, 1)]
    assert sum(r.kept for r in found) == 3


@pytest.mark.parametrize("run", [exact_dedup.exact_groups, near_dedup.near_groups, sharding.shards])
def test_empty_tables(spark, run):
    assert run(frame(spark, [])).count() == 0


def test_exact_main_path_has_no_python(spark, plan_of):
    plan = plan_of(exact_dedup.exact_groups(frame(spark, [(1, "a")])))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_copies_are_dropped_with_all_columns(spark):
    docs = frame(spark, [(1, "a", "en", "x", "y"), (2, "a", "de", None, None), (3, None)])
    found = exact_dedup.drop_copies(docs)
    assert found.columns == docs.columns
    assert sorted(r.doc_id for r in found.collect()) == [2, 3]


def test_copies_of_repeated_rows_and_ids_are_dropped(spark):
    rows = [(5, "A"), (5, "B"), (9, "B"), (7, "C"), (7, "C"), (None, "D"), (None, "D"), (None, "E"), (1, "E"), (2, None), (3, "")]
    found = exact_dedup.drop_copies(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in found) == [("1", "E"), ("3", ""), ("5", "A"), ("7", "C"), ("9", "B"), ("None", "D")]


# Near dedup


def shingles(text, k):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_components(rows, k, percent=80):
    sets = {i: shingles(t, k) for i, t in rows}
    above = {i: i for i in sets}

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if 100 * both >= percent * len(sets[x] | sets[y]):
                    a, b = root(x), root(y)
                    above[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}, sets


def near_rows(seed):
    """Groups of edited copies, one of them dense, and exact copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for size in (1, 2, 3, 90, 4, 1, 1, 6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([4, 40, 90]) if size < 90 else 60)]
        for _ in range(size):
            edited = list(base)
            for _ in range(rng.randrange(4)):
                edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
            rows.append((i, " ".join(edited)))
            i += 1
    rows += [(i, rows[1][1].upper()), (i + 1, "one two"), (i + 2, "ONE\ttwo"), (i + 3, ""), (i + 4, None), (i + 5, " \n"), (i + 6, "one two three four")]
    return rows


@pytest.mark.parametrize("k", [4, 5])
def test_near_groups_equal_brute_force(spark, k):
    rows = near_rows(k)
    expected, sets = brute_components(rows, k)
    found = {r.doc_id: r for r in near_dedup.near_groups(frame(spark, rows), shingle=k).collect()}
    assert len(found) == len(rows)
    for i in expected:
        assert (found[i].n_shingles, found[i].component_id, found[i].kept) == (len(sets[i]), expected[i], expected[i] == i)


def test_near_groups_in_small_runs_and_blocks(spark, monkeypatch):
    for name, value in (("RUN", 16), ("BLOCK", 20), ("DENSE", 8)):
        monkeypatch.setattr(near_dedup, name, value)
    rows = near_rows(9)
    expected, _ = brute_components(rows, 4)
    found = {r.doc_id: r.component_id for r in near_dedup.near_groups(frame(spark, rows), shingle=4).collect()}
    assert found == expected


def test_large_regions_are_compared_in_bounded_tiles(spark, monkeypatch):
    for name, value in (("BLOCK", 40), ("DENSE", 8)):
        monkeypatch.setattr(near_dedup, name, value)
    # 200 components of one row each and one of 60 rows.
    rows = [(7, i, i) for i in range(200)] + [(7, 1000 + i, 1000) for i in range(60)] + [(8, 1, 1), (8, 2, 1), (9, 5, 5), (9, 6, 6)]
    tiles = defaultdict(list)
    placed = spark.createDataFrame(rows, "region long, id long, component long").withColumn("weight", F.lit(1).cast("long"))
    for r in near_dedup._tiles(placed, near_dedup._mixed(placed)).collect():
        tiles[r.region, r.tile].append(r)
    assert {region for region, _ in tiles} == {7, 9}
    assert max(map(len, tiles.values())) <= 2 * 40
    met = defaultdict(int)
    for (region, _), group in tiles.items():
        one_side = len({r.side for r in group}) == 1
        for x in group:
            for y in group:
                if x.id < y.id and x.component != y.component and (one_side or x.side != y.side):
                    met[region, x.id, y.id] += 1
    expected = {(g, i, j) for g, i, c in rows for h, j, d in rows if g == h and i < j and c != d}
    assert set(met) == expected and set(met.values()) == {1}


def test_tiles_are_bounded_by_shingles_too(spark, monkeypatch):
    for name, value in (("BLOCK", 1000), ("DENSE", 8), ("ITEMS", 200)):
        monkeypatch.setattr(near_dedup, name, value)
    placed = spark.createDataFrame([(7, i, i, 20) for i in range(60)], "region long, id long, component long, weight long")
    tiles = defaultdict(int)
    for r in near_dedup._tiles(placed, near_dedup._mixed(placed)).collect():
        tiles[r.tile] += 20
    assert len(tiles) > 1 and max(tiles.values()) <= 3 * 200


def test_runs_grow_deeper_until_they_fit(monkeypatch):
    import numpy as np

    monkeypatch.setattr(near_dedup, "RUN", 8)
    rng = np.random.default_rng(5)
    for depths in (2, near_dedup.LABEL):
        labels = np.array([tuple(rng.integers(0, 3, depths).tolist()) + (0,) * (near_dedup.LABEL - depths) for _ in range(100)], np.uint16)
        labels = np.array(sorted(map(tuple, labels.tolist())), np.uint16)
        import pyarrow as pa

        common = near_dedup._common(pa.chunked_array([pa.array([r.tobytes() for r in labels], pa.binary())]))
        assert common[0] == 0 and all(common[i] == next((k for k in range(near_dedup.LABEL) if labels[i][k] != labels[i - 1][k]), near_dedup.LABEL) for i in range(1, 100))
        runs = list(near_dedup._runs(common, 0, 100))
        assert [a for a, _ in runs] == [0, *(b for _, b in runs[:-1])] and runs[-1][1] == 100
        assert max(b - a for a, b in runs) <= 8
        # A cut lies where neighbours share less than those within the runs beside it, or where all are equal.
        for (a, b), (c, d) in zip(runs, runs[1:], strict=False):
            if common[c] < near_dedup.LABEL:
                assert b == c and common[c] <= max([*common[a + 1 : b], *common[c + 1 : d], common[c]])


def test_documents_with_a_common_passage(spark, monkeypatch):
    for name, value in (("RUN", 16), ("BLOCK", 24), ("DENSE", 8)):
        monkeypatch.setattr(near_dedup, name, value)
    rng = random.Random(11)
    passage, rows = [f"p{i}" for i in range(90)], []
    for i in range(120):
        rows.append((i, " ".join([*passage, *(f"w{rng.randrange(10**6)}" for _ in range(60))])))
    rows += [(200 + i, rows[i * 7][1] + " more words") for i in range(10)]
    expected, _ = brute_components(rows, 4)
    found = {r.doc_id: r.component_id for r in near_dedup.near_groups(frame(spark, rows), shingle=4).collect()}
    assert found == expected and len(set(expected.values())) == 120


def test_refined_regions_keep_similar_rows_together(spark):
    rng = random.Random(13)
    passage = [f"p{i}" for i in range(60)]
    texts = [" ".join([*passage, *(f"w{rng.randrange(10**6)}" for _ in range(40))]) for _ in range(150)]
    texts += [t + " a b c" for t in texts[::10]] + ["short one here now ok", "short one here now ok then"]
    found = [sorted(set(x)) for x in (list(near_dedup._sets([t], 4))[0].tolist() for t in texts)]
    import numpy as np

    rows = [(i, i, len(x), np.array(x, np.uint64).tobytes()) for i, x in enumerate(found)]
    whole = spark.createDataFrame(rows, "id long, component long, weight long, items binary")
    finer = near_dedup._refined(whole.drop("items"), whole.select("id", "items"), 80)
    regions = defaultdict(set)
    for r in finer.collect():
        regions[r.region].add(r.id)
    met = {(i, j) for ids in regions.values() for i in ids for j in ids if i < j}
    similar = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if 100 * len(set(found[i]) & set(found[j])) >= 80 * len(set(found[i]) | set(found[j]))}
    assert len(similar) >= 15 and similar <= met
    # Rows that only share the passage part.
    assert len(met) < 3 * len(similar) and max(map(len, regions.values())) < 10


@pytest.mark.parametrize("size", [400, 800])
def test_rows_of_a_shared_passage_grow_in_proportion(spark, monkeypatch, size):
    for name, value in (("RUN", 16), ("BLOCK", 24), ("DENSE", 8)):
        monkeypatch.setattr(near_dedup, name, value)
    rng = random.Random(14)
    passage = [f"p{i}" for i in range(90)]
    rows = [(i, " ".join([*passage, *(f"w{rng.randrange(10**7)}" for _ in range(60))])) for i in range(size)]
    rows += [(size + i, rows[i][1] + " more words") for i in range(5)]
    made, tiles = [], near_dedup._all_tiles

    def counted(*arguments):
        found = near_dedup.stored(tiles(*arguments), "counted")
        made.append(found.count())
        return found

    monkeypatch.setattr(near_dedup, "_all_tiles", counted)
    found = {r.doc_id: r.component_id for r in near_dedup.near_groups(frame(spark, rows), shingle=4).collect()}
    assert found == {i: i if i < size else i - size for i, _ in rows}
    assert made[0] < 3 * size


def test_a_pair_that_shares_one_region_is_linked(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "TREES", 1)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*words[:-1], f"x{i}"])) for i in (1, 2)] + [(3, "quite another text of words")]
    assert {r.doc_id: r.component_id for r in near_dedup.near_groups(frame(spark, rows), shingle=4).collect()} == {1: 1, 2: 1, 3: 3}


def test_near_groups_of_odd_ids(spark):
    rows = [(None, "a b c d e"), (7, "a b c d e"), (7, "x y z u v"), (9, "x y z u v")]
    found = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in near_dedup.near_groups(frame(spark, rows)).collect())
    assert found == [("7", "7", True), ("7", "7", True), ("9", "7", False), ("None", "None", True)]


def test_texts_that_share_an_id_stay_apart(spark):
    w, u = (" ".join(f"{c}{i}" for i in range(40)) for c in "wu")
    rows = [(3, w), (5, w + " "), (5, u), (8, u + " a b c d"), (9, "other words of another text here"), (9, "other words of another text here")]
    rows += [(None, w), (None, w), (4, None), (4, None), (4, "  "), (6, "")]
    docs = frame(spark, rows)
    found = sorted((str(r.doc_id), r.text) for r in near_dedup.drop_near_copies(docs).collect() if r.text and r.text.strip())
    assert found == sorted([("3", w), ("5", u), ("9", rows[4][1]), ("None", w), ("None", w)])
    blank = sorted((r.doc_id, r.text) for r in near_dedup.drop_near_copies(docs).filter("trim(coalesce(text, '')) = ''").collect() if r.text is not None)
    assert blank == [(4, "  "), (6, "")]
    groups = {(r.doc_id, r.n_shingles): r.component_id for r in near_dedup.near_groups(docs).filter("doc_id = 5 OR doc_id = 8").collect()}
    assert set(groups.values()) == {3, 5} and groups[8, 40] == 5
    assert near_dedup.drop_near_copies(docs).columns == docs.columns


def test_random_repeated_ids_keep_one_row_of_each_group(spark):
    rng = random.Random(12)
    rows = [(rng.randrange(60), text) for _, text in near_rows(6) if text and text.strip()]
    rows += rng.sample(rows, 20)
    # Texts are the nodes of the plain version.
    texts = sorted({t for _, t in rows})
    groups, _ = brute_components(list(enumerate(texts)), 5)
    least = defaultdict(lambda: 10**9)
    for i, t in rows:
        least[groups[texts.index(t)]] = min(least[groups[texts.index(t)]], i)
    found = near_dedup.drop_near_copies(frame(spark, rows)).collect()
    assert sorted((groups[texts.index(r.text)], r.doc_id) for r in found) == sorted(least.items())
    parts = {(r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_groups(frame(spark, rows)).collect()}
    assert parts == {(i, len(shingles(t, 5)), least[groups[texts.index(t)]]) for i, t in rows}


def test_a_hub_of_the_graph_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        edges = spark.range(1, 60000, 1, 8).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
        sym = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sym.groupBy("a").agg(F.min("b").alias("m"))
        joined = graph.left_join_unique(sym, least, ["a"])
        assert joined.count() == 2 * 59999
        assert "skew=true" in _final_plan(joined)
        found = graph.components(edges)
        assert found.filter("component = 0").count() == 60000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).selectExpr("id as a", "id + 1 as b")
    found = {r.id: r.component for r in graph.components(edges).collect()}
    assert found == {i: 0 for i in range(61)}


# Packing


def test_best_fit_uses_the_fullest_bin():
    import numpy as np

    bins, offsets, fills = packing.best_fit(np.array([6, 5, 4, 5, 10]), 10)
    assert sorted(fills.tolist()) == [10, 10, 10]
    assert all(offsets[i] + n <= 10 for i, n in enumerate([6, 5, 4, 5, 10]))


def test_packing_is_gapless_and_whole(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["alpha", "béta", "it's", "12", "\n\n"]) for _ in range(rng.randrange(60)))) for i in range(80)]
    rows += [(80, None), (81, ""), (82, "a<|endoftext|>b"), (83, "x " * 300), (83, "x " * 300)]
    found = packing.pack(frame(spark, rows), path, capacity=128).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 128
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        copies = 2 if i == 83 else 1
        assert sum(p.length for p in pieces[i]) == copies * len(ids)
        for p in pieces[i]:
            assert p.length == 128 or p.piece == 0
            assert p.ids_crc32 == zlib.crc32(struct.pack(f"<{p.length}I", *ids[p.start : p.start + p.length]))
    total = sum(p.length for p in found)
    assert len(sequences) <= 1.1 * -(-total // 128) + 1


def test_merging_goes_on_while_few_bins_join(spark):
    rows = [(i, 96 if i < 990 else 50) for i in range(1010)]
    items = spark.createDataFrame(rows, "key long, length long")
    found = packing.assign(items, "key", "length", capacity=100, slack=3, group=40).collect()
    assert len(found) == len(rows)
    assert len({r.sequence_id for r in found}) == 990 + 10


def test_packing_of_no_documents(spark):
    assert packing.pack(frame(spark, []), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


# Byte-level BPE


def test_bpe_equals_the_library(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoding = tiktoken.Encoding("own", pat_str=W.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    texts = [None, "", "Hello, wörld! it's 12½ 中文\n\n  x", "a" * 700, "é" * 200, "ab" * 150 + " tail", "same", "same"]
    found = byte_bpe.encode(frame(spark, list(enumerate(texts))), path, block_bytes=300).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = encoding.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids) == (len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert bytes(r.decoded).decode() == (texts[r.doc_id] or "")
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_long_words_go_through_the_same_fold(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = byte_bpe.read_ranks(path)
    encoding = tiktoken.Encoding("own", pat_str=W.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCXYZé中") for _ in range(15_000)), "=" * 2_000, "the" * 500, "中文字符" * 800]
    texts = [*words, " ".join(words)]
    found = {r.doc_id: r for r in byte_bpe.encode(frame(spark, list(enumerate(texts))), path).collect()}
    for i, text in enumerate(texts):
        assert found[i].ids == encoding.encode_ordinary(text) and bytes(found[i].decoded).decode() == text


def test_bpe_of_ranks_that_are_no_merges(spark, tmp_path):
    """A token that merging cannot reach is used for the whole word only."""
    import base64

    pieces = [*(bytes([b]) for b in range(256)), b"ab", b"bc", b"xyz", b"abcd", b" a"]
    path = str(tmp_path / "ranks")
    with open(path, "wb") as out:
        out.writelines(base64.b64encode(p) + b" %d\n" % i for i, p in enumerate(pieces))
    encoding = tiktoken.Encoding("own", pat_str=W.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    texts = ["xyz", "xyzx abc abcd bcab", "abab ab", "xyz xyz"]
    found = {r.doc_id: r.ids for r in byte_bpe.encode(frame(spark, list(enumerate(texts))), path).collect()}
    assert found == {i: encoding.encode_ordinary(t) for i, t in enumerate(texts)}


def test_rows_of_bpe_grow_with_blocks(spark):
    """What moves is at most one pack of words for each block and shard, whatever the number of partitions."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(200))) for i in range(60)]
    between = byte_bpe.apart(byte_bpe.read_ranks(path))
    blocks = frame(spark, rows).repartition(3).select(F.col("doc_id").alias("id"), "text").mapInArrow(byte_bpe._blocks(4000, between), "block long, packed binary")
    found = blocks.select(F.lit(0).cast("long").alias("part"), "block", "packed").mapInArrow(byte_bpe._dealt, "part long, shard int, block long, packed binary").groupBy("block").count().collect()
    assert len(found) >= 8 and max(r["count"] for r in found) <= byte_bpe.RANGE


def test_blocks_are_cut_once(spark, plan_of):
    plan = plan_of(byte_bpe.encode(frame(spark, [(1, "a b")]), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    exchanges = [line.split("[plan_id")[0].split("Exchange hashpartitioning")[1] for line in plan.splitlines() if "Exchange hashpartitioning(block" in line and "REPARTITION_BY_NUM" in line]
    # Both readers of the blocks ask for the same shuffle, which Spark then makes once.
    assert len(exchanges) == 2 and plan.count("packed#") > 2
    assert "texts" not in plan


def test_bpe_of_no_documents(spark):
    assert byte_bpe.encode(frame(spark, []), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).count() == 0


# Sharding


def test_shards_fit_and_are_minimal(spark):
    rng = random.Random(4)
    rows = [(i, "x" * rng.randrange(50)) for i in range(400)] + [(1000, "y" * 700), (1001, None)]
    found = sharding.shards(frame(spark, rows), limit=500).collect()
    sizes, names = defaultdict(int), defaultdict(list)
    text = dict(rows)
    for r in found:
        sizes[r.shard] += len(text[r.doc_id] or "")
        names[r.shard].append(r)
    assert len(found) == len(rows)
    for shard, members in names.items():
        assert sizes[shard] <= 500 or len(members) == 1
        assert {(r.depth, r.shard_bytes, r.shard_rows) for r in members} == {(len(shard), sizes[shard], len(members))}
        # A shard's parent was too large, or it would not have been split.
        parent = shard[:-1]
        assert not shard or sum(v for k, v in sizes.items() if k.startswith(parent)) > 500
    assert all(a == b or not a.startswith(b) for a in names for b in names)


def test_rows_of_one_id_are_split_too(spark):
    rows = [(1, "same text")] * 40 + [(None, "other")] * 40 + [(2, "z")]
    found = sharding.shards(frame(spark, rows), limit=60).collect()
    assert len(found) == len(rows)
    assert max(r.shard_bytes for r in found) <= 60


def test_shards_main_path_has_no_python(spark, plan_of):
    plan = plan_of(sharding.shards(frame(spark, [(1, "a"), (2, "b")]), limit=1))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_shards_are_written(spark, tmp_path):
    docs = frame(spark, [(i, "x" * 30) for i in range(20)])
    sharding.write_shards(docs, sharding.shards(docs, limit=200), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.sum(F.length("text"))).first()[0] == 600
