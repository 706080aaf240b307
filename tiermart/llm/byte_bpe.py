"""Byte-level BPE encoding and decoding by a rank file.

Every task cuts its documents once, into blocks of bounded size. Texts are cut into words and
words wherever no token spans two bytes, since no merge can cross such a place; so even very
long words mostly fall into short ones, and the fold below serves all of them. A block keeps its distinct
words and the numbers of the words in its texts.

Blocks form ranges of about ``RANGE``, and the words of a range are dealt to ``RANGE`` shards, so that
a group holds about the words of one block, and the rows moved grow with the blocks. In a group every distinct word is encoded once, by
Spark's higher-order functions: a fold over the bytes' ids merges the adjacent pair of lowest
rank until none is left. Ranks are a literal: buckets of pairs of ids with the id that they merge
to. Decoding concatenates the ids' bytes. The encoded words go back to their blocks, where texts are put together.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermart.llm import words as W
from tiermart.llm.common import give_back

BUCKETS = 32768
BLOCK_BYTES = 32 << 20
RANGE = 64
WIDTH = 1 << 17  # more than any id


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def pairs_of(ranks: dict[bytes, int]) -> Iterator[tuple[int, int, int]]:
    """Ids that may stand side by side and merge: the two and the id of both."""
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
            if left is not None and right is not None:
                yield left, right, rank


def apart(ranks: dict[bytes, int]) -> np.ndarray:
    """For every two bytes (first * 256 + second) whether no token has them side by side."""
    found = np.ones(1 << 16, bool)
    for piece in ranks:
        both = np.frombuffer(piece, np.uint8).astype(np.int64)
        found[both[:-1] << 8 | both[1:]] = False
    return found


def _unreached(ranks: dict[bytes, int], merged: dict[tuple[int, int], int]) -> dict[str, int]:
    """Tokens that merging does not arrive at; a word that is one of them is that token all the same."""
    found = {}
    for piece, rank in ranks.items():
        ids = [ranks[bytes([b])] for b in piece]
        while len(ids) > 1:
            best = min((merged.get(pair, WIDTH), k) for k, pair in enumerate(zip(ids, ids[1:], strict=False)))
            if best[0] == WIDTH:
                found[piece.hex().upper()] = rank
                break
            ids[best[1] : best[1] + 2] = [best[0]]
    return found


class Vocabulary:
    """Literal look-ups: the id of a byte, the id that two ids merge to (null if none) and the bytes of an id.

    All 256 bytes have to be tokens.
    """

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a rank file with all single bytes is needed")
        if max(ranks.values()) >= WIDTH:
            raise ValueError(f"ids below {WIDTH} are needed")
        buckets: list[tuple[list[int], list[int]]] = [([], []) for _ in range(BUCKETS)]
        merged = {}
        for left, right, rank in pairs_of(ranks):
            keys, ids = buckets[(left * 31 + right) % BUCKETS]
            keys.append(left * WIDTH + right)
            ids.append(rank)
            merged[left, right] = rank
        pieces = [""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            pieces[rank] = piece.hex().upper()
        self._pairs = F.from_json(F.lit(json.dumps([{"k": k, "v": v} for k, v in buckets])), "array<struct<k:array<bigint>,v:array<int>>>")
        self._pieces = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
        self._bytes = F.from_json(F.lit(json.dumps([ranks[bytes([b])] for b in range(256)])), "array<int>")
        self.unreached = _unreached(ranks, merged)

    def byte(self, value: Column) -> Column:
        return F.get(self._bytes, value)

    def merged(self, left: Column, right: Column) -> Column:
        bucket = F.get(self._pairs, (left * 31 + right) % BUCKETS)
        key = left.cast("long") * WIDTH + right
        return _let(bucket, lambda b: F.get(b.v, (F.array_position(b.k, key) - 1).cast("int")))

    def decode(self, ids: Column) -> Column:
        return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(self._pieces, i)), ""))


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def encode_word(word: Column, data: Column, vocabulary: Vocabulary) -> Column:
    """Ids of a word of one or more bytes, given as binary and as an array of its bytes."""
    merged = vocabulary.merged
    none = F.array().cast("array<int>")

    def paired(p: Column) -> Column:
        n = F.size(p)
        r = F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: merged(F.get(p, i - 1), F.get(p, i)))).otherwise(none)
        return F.struct(p.alias("p"), r.alias("r"))

    def merge(state: Column, _: Column) -> Column:
        p, r = state.p, state.r
        size = F.size(p)

        def at(best: Column) -> Column:
            # The leftmost pair of lowest rank; places count from 1.
            k = F.array_position(r, best).cast("int")
            left = F.when(k > 1, F.array(merged(F.get(p, k - 2), best))).otherwise(none)
            right = F.when(k + 1 < size, F.array(merged(best, F.get(p, k + 1)))).otherwise(none)
            return F.struct(
                F.concat(F.slice(p, F.lit(1), k - 1), F.array(best), F.slice(p, k + 2, size)).alias("p"),
                F.concat(F.slice(r, F.lit(1), F.greatest(k - 2, F.lit(0))), left, right, F.slice(r, k + 2, size)).alias("r"),
            )

        return _let(F.array_min(r), lambda best: F.when(best.isNotNull(), at(best)).otherwise(state))

    start = _let(F.transform(data, vocabulary.byte), paired)
    steps = F.when(F.size(data) > 1, F.sequence(F.lit(2), F.size(data))).otherwise(none)
    folded = F.aggregate(steps, start, merge, lambda s: s.p)
    if vocabulary.unreached:
        known = F.from_json(F.lit(json.dumps(vocabulary.unreached)), "map<string,int>")
        folded = _let(F.try_element_at(known, F.hex(word)), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(folded))
    return folded


def _pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(packed: bytes | memoryview) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(packed)).read_all()


class _Block:
    """Texts of one block: their words as numbers, common words having small ones."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        self.ids: list[pa.Array] = []
        self.sizes: list[np.ndarray] = []
        self.numbers: list[np.ndarray] = []

    def add(self, ids: pa.Array, texts: list[str], between: np.ndarray) -> None:
        cut = W.cut(texts, between)
        index = self.index
        known = np.array([index.setdefault(w, len(index)) for w in cut.unique], np.int32)
        self.ids.append(ids)
        self.sizes.append(np.diff(cut.offsets))
        self.numbers.append(known[cut.inverse])

    def row(self, place: int) -> pa.RecordBatch:
        numbers = np.concatenate(self.numbers)
        order = np.argsort(-np.bincount(numbers, minlength=len(self.index)), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        words = np.array(list(self.index), object)[order].tolist()
        texts = pa.table({"id": pa.chunked_array(self.ids), "n": pa.array(np.concatenate(self.sizes))})
        parts = [_pack(texts), _planes(rank[numbers]), _pack(pa.table({"word": pa.array([w.encode() for w in words], pa.binary())}))]
        # One column, so that both readers of a block want the same and share its shuffle.
        whole = b"".join([*(len(p).to_bytes(8, "little") for p in parts), *parts])
        name = xxhash.xxh64_intdigest(place.to_bytes(8, "little") + whole) >> 1
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([whole], pa.binary())], ["block", "packed"])


def _opened(whole: bytes) -> list[memoryview]:
    """Texts, numbers and words of a packed block."""
    ends = np.cumsum([24, *(int.from_bytes(whole[a : a + 8], "little") for a in (0, 8, 16))]).tolist()
    view = memoryview(whole)
    return [view[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers by their first bytes, second bytes and so on, which compress by themselves."""
    return pa.compress(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def _numbers(packed: bytes | memoryview, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(pa.py_buffer(packed), 4 * n, "zstd"), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _blocks(block_bytes: int, between: np.ndarray):
    """Rows (id, text) to blocks of about ``block_bytes`` of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 24
        held, size = _Block(), 0
        for batch in batches:
            sizes = np.append(0, np.cumsum(pc.binary_length(batch.column("text")).to_numpy()))
            begin = 0
            while begin < batch.num_rows:
                # About as many bytes at a time as a chunk has.
                end = max(begin + 1, int(np.searchsorted(sizes, sizes[begin] + min(W.CHUNK, block_bytes), "right")) - 1)
                part = batch.slice(begin, end - begin)
                held.add(part.column("id"), part.column("text").to_pylist(), between)
                size += int(sizes[end] - sizes[begin])
                begin = end
                if size >= block_bytes:
                    yield held.row(place)
                    held, size, place = _Block(), 0, place + 1
        if held.ids:
            yield held.row(place)
        give_back()

    return run


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of blocks, dealt to shards by checksum and sorted: (part, shard, block, packed words)."""
    for batch in batches:
        for part, block, packed in zip(*(batch.column(c).to_pylist() for c in ("part", "block", "packed")), strict=True):
            words = _unpack(_opened(packed)[2])["word"].combine_chunks()
            shard = np.fromiter((zlib.crc32(w) % RANGE for w in words.to_pylist()), np.int64, len(words))
            for k in range(RANGE):
                mine = np.flatnonzero(shard == k)
                if len(mine):
                    chosen = pa.table({"word": words.take(pa.array(mine)), "number": pa.array(mine.astype(np.int32))}).sort_by("word")  # sorted words compress well
                    yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([k], pa.int32()), pa.array([block]), pa.array([_pack(chosen)], pa.binary())], ["part", "shard", "block", "packed"])
        give_back()


def _distinct(rows: pa.Table) -> pa.Table:
    """Each distinct word of a shard of a range, with its bytes, the blocks that have it and its number there."""
    packs = [_unpack(p) for p in rows["packed"].to_pylist()]
    blocks = np.repeat(rows["block"].to_numpy(), [p.num_rows for p in packs])
    whole = pa.concat_tables(packs).combine_chunks()
    coded = whole["word"].combine_chunks().dictionary_encode()
    which = coded.indices.to_numpy()
    order = np.argsort(which, kind="stable")
    bounds = pa.array(np.append(0, np.cumsum(np.bincount(which, minlength=len(coded.dictionary)))).astype(np.int32))
    words = coded.dictionary
    data = pa.array(np.frombuffer(b"".join(words.to_pylist()), np.uint8).astype(np.int32))
    ends = pa.array(np.append(0, np.cumsum(pc.binary_length(words).to_numpy())).astype(np.int32))
    owners = pa.ListArray.from_arrays(bounds, pa.array(blocks[order]))
    numbers = pa.ListArray.from_arrays(bounds, pa.array(whole["number"].to_numpy()[order]))
    give_back()
    return pa.table({"word": words, "data": pa.ListArray.from_arrays(ends, data), "blocks": owners, "numbers": numbers})


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Encoded words, packed for each block among some batches."""

    def done(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        blocks, numbers = rows["blocks"].combine_chunks(), rows["numbers"].combine_chunks().flatten()
        owner = np.repeat(np.arange(len(blocks)), pc.list_value_length(blocks).to_numpy(zero_copy_only=False))
        flat = blocks.flatten().to_numpy()
        order = np.argsort(flat, kind="stable")
        found, begin = np.unique(flat[order], return_index=True)
        coded = rows.select(["ids", "decoded"])
        for block, part in zip(found.tolist(), np.split(order, begin[1:]), strict=True):
            mine = coded.take(pa.array(owner[part])).append_column("number", numbers.take(pa.array(part)))
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([_pack(mine)], pa.binary())], ["block", "packed"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= 50_000:
            yield from done(held)
            held = []
    if sum(b.num_rows for b in held):
        yield from done(held)
    give_back()


def encoded_words(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Rows with a ``word`` and its bytes as array ``data``, with its ``ids`` and the ``decoded`` bytes."""
    return words.withColumn("ids", encode_word(F.col("word"), F.col("data"), vocabulary)).withColumn("decoded", vocabulary.decode(F.col("ids")))


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, keep_ids: bool = True) -> DataFrame:
    """Token ids of every whole text and the text decoded from them.

    One row per input row: the id, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by
    commas), ``decoded_sha256`` and, with ``keep_ids``, ``ids`` and ``decoded``. A null text
    counts as empty and has no ids. Repeated rows and ids give a row each, an empty table none.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranks = read_ranks(ranks_path)
    vocabulary = Vocabulary(ranks)
    # Tokens that only stand for whole words need words to be whole.
    between = apart(ranks) if not vocabulary.unreached else np.zeros(1 << 16, bool)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    # Both uses below read the same shuffle.
    blocks = rows.mapInArrow(_blocks(block_bytes, between), "block long, packed binary").repartition(parts, "block")
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-n_bytes // (RANGE * block_bytes)))
    part = F.pmod(F.xxhash64("block"), F.lit(ranges)).alias("part")
    dealt = blocks.select(part, "block", "packed").mapInArrow(_dealt, "part long, shard int, block long, packed binary")
    words = dealt.groupBy("part", "shard").applyInArrow(_distinct, "word binary, data array<int>, blocks array<long>, numbers array<int>")
    coded = encoded_words(words, vocabulary).select(
        "blocks",
        "numbers",
        F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"),
        F.when(F.col("decoded") != F.col("word"), F.col("decoded")).alias("decoded"),  # null: as the word
    )
    back = coded.mapInArrow(_by_block, "block long, packed binary")
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if keep_ids else [])]
    types = [None, pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.binary()]

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            raise ValueError("a block was cut anew from other rows; run again on a stored table")
        out = []
        for texts, numbers, words in map(_opened, left["packed"].to_pylist()):
            decoded = np.array(_unpack(words)["word"].to_pylist(), object)
            ids = np.empty(len(decoded), object)
            for pack in right["packed"].to_pylist():
                coded = _unpack(pack)
                number = coded["number"].to_numpy()
                ids[number] = coded["ids"].to_pylist()
                other = np.flatnonzero(coded["decoded"].is_valid().to_numpy())
                decoded[number[other]] = coded["decoded"].take(pa.array(other)).to_pylist()
            if any(i is None for i in ids):
                raise ValueError("a block was cut anew from other rows; run again on a stored table")
            tokens = np.fromiter((i.count(",") + 1 for i in ids), np.int64, len(ids))
            listed = _unpack(texts)
            number = _numbers(numbers, pc.sum(listed["n"]).as_py() or 0)
            found: list[list] = [[] for _ in names[1:]]
            begin = 0
            for n in listed["n"].to_pylist():
                mine = number[begin : begin + n]
                begin += n
                joined, text = ",".join(ids[mine].tolist()), b"".join(decoded[mine].tolist())
                row = (int(tokens[mine].sum()), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(text).hexdigest())
                if keep_ids:
                    row += (np.fromstring(joined, np.int32, sep=",") if joined else np.zeros(0, np.int32), text)
                for column, value in zip(found, row, strict=True):
                    column.append(value)
            out.append(pa.table([listed["id"], *(pa.array(c, t) for c, t in zip(found, types[1:], strict=False))], names=names))
        give_back()
        return pa.concat_tables(out)

    schema = f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded binary" if keep_ids else "")
    both = blocks.groupBy("block").cogroup(back.groupBy("block"))
    return both.applyInArrow(join, schema).withColumnRenamed("id", id_col)
