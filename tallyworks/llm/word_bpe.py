"""Byte-level BPE over whole corpora: every distinct word is encoded once, decoding joins the bytes of tokens.

Texts are split into words by the vocabulary's pattern. Consecutive documents form blocks of about ``BLOCK`` words;
within a block a word becomes a number, and the texts become runs of numbers: the positions. The
distinct words of all blocks are shuffled by word, so that equal words meet in one task and are encoded
once. Their ids go back to the blocks that asked for them, where every text is put together by position.
Going by blocks is the addition before the shuffle: a word crosses it once a block, not once an occurrence, however
frequent it is. Words are dealt to shares by hash, and those of one block and share travel in one row.

Decoding joins the table of token bytes, which is as long as the vocabulary and is broadcast. It does so once for
every id of some texts, not for each occurrence: a task puts those ids in front of the texts, the join gives them
their bytes, and the next step of the same task puts the bytes of every text together by position.

Words and texts of a block carry its digest. Should a lost task form its blocks anew and otherwise, this is found out, and
raises; the documents have to come in the same order each time, as those of a table do.

Letters and digits are those of the reference library, found by asking it for all code points. Texts of ASCII alone
are split by a pattern for those; texts with a character that the ``regex`` library classes otherwise by one that
lists the characters; all others by ``regex``.

Odd cases: a null or empty text has no ids and decodes to no bytes; repeated rows and doc_ids, also null ones, each keep a
row; very long texts are blocks of their own; an empty table gives an empty result; columns of other names are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import common

# Words in a block; ids whose bytes are asked for at a time; texts put together at a time.
BLOCK = 1 << 21
JOINED = 1 << 21
TEXTS = 1000
# A block is named by its task and its number in the task, which takes so many bits.
BLOCK_BITS = 16
# Words of more bytes than this are merged with a heap.
SHORT = 64
NEVER = 1 << 62
# The classes of characters in patterns.
CLASSES = ("\\p{L}", "\\p{N}", "\\s")

ENTRY_SCHEMA = "key long, block long, proof long, total long, a binary, b binary, c binary, rows array<long>, doc_ids array<long>, lengths array<int>"
ENCODED_SCHEMA = "row long, doc_id long, ids array<int>"
ASKED_SCHEMA = "row long, doc_id long, id int, ids array<int>"
DECODED_SCHEMA = "row long, doc_id long, ids array<int>, data binary"


# --- one word ---------------------------------------------------------------------------


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word: the adjacent pair of least rank is merged, the first of equals, until none has a rank."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > SHORT:
        return _merge_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
    while pairs:
        least = min(pairs)
        if least == NEVER:
            break
        i = pairs.index(least)
        parts[i] += parts.pop(i + 1)
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], NEVER)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], NEVER)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs: part i reaches from byte i to ``end[i]``, ``start`` leads back."""
    end = list(range(1, len(word) + 1))
    start = list(range(-1, len(word) - 1))
    queue: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and end[i] < len(word):
            stop = end[end[i]]
            rank = ranks.get(word[i:stop])
            if rank is not None:
                heapq.heappush(queue, (rank, i, stop))

    for i in range(len(word)):
        offer(i)
    gone = bytearray(len(word))
    while queue:
        _, i, stop = heapq.heappop(queue)
        if gone[i] or end[i] == len(word) or end[end[i]] != stop or end[i] == stop:
            continue
        gone[end[i]] = 1
        end[i] = stop
        if stop < len(word):
            start[stop] = i
        offer(i)
        offer(start[i])
    ids, at = [], 0
    while at < len(word):
        ids.append(ranks[word[at : end[at]]])
        at = end[at]
    return ids


# --- the pattern ------------------------------------------------------------------------


def _known_to_library(kind: str, text: str) -> set[str]:
    """The characters of a class as the reference library has it: all others yield no token."""
    import tiktoken

    single = {bytes([i]): i for i in range(256)}
    found = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=single, special_tokens={}).encode_ordinary(text)
    return set(bytes(found).decode())


def _ranges(characters: Iterable[str]) -> str:
    points, spans = sorted(map(ord, characters)), []
    for p in points:
        if spans and spans[-1][1] == p - 1:
            spans[-1][1] = p
        else:
            spans.append([p, p])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)


def _spelled_out(pattern: str, classes: dict[str, str]) -> str:
    """The pattern with its classes as ranges: as they are within brackets, and in brackets of their own elsewhere."""
    out, within = [], False
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.DOTALL):
        within = part == "[" or within and part != "]"
        if part == "\\S":
            out.append(f"[^{classes[CLASSES[2]]}]")
        elif part in classes:
            out.append(classes[part] if within else f"[{classes[part]}]")
        else:
            out.append(part)
    return "".join(out)


@lru_cache(maxsize=2)
def splitter(pattern: str) -> Callable[[str], list[str]]:
    """Splits a text into the matches of a pattern, as the reference library does."""
    import regex

    text = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
    known = {kind: _known_to_library(kind, text) for kind in CLASSES}
    fast = regex.compile(pattern)
    exact = re.compile(_spelled_out(pattern, {kind: _ranges(c) for kind, c in known.items()}))
    ascii_only = re.compile(_spelled_out(pattern, {kind: _ranges(x for x in c if x < "\x80") for kind, c in known.items()}))
    differing = set().union(*(known[kind] ^ set(regex.findall(kind, text)) for kind in CLASSES))
    doubtful = re.compile(f"[{_ranges(differing)}]").search if differing else lambda _: None

    def split(text: str) -> list[str]:
        if text.isascii():
            return ascii_only.findall(text)
        return (exact if doubtful(text) else fast).findall(text)

    return split


# --- blocks -----------------------------------------------------------------------------


class Block:
    """Consecutive documents: their distinct words in order of appearance, and their texts as numbers of words."""

    def __init__(self, key: int) -> None:
        self.key = key
        self.words: dict[str, int] = {}
        self.rows: list[int] = []
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        self.codes: list[np.ndarray] = []
        self.held = 0

    def add(self, row: int, doc_id: int | None, words: list[str]) -> None:
        known = self.words
        for w in dict.fromkeys(words):
            if w not in known:
                known[w] = len(known)
        self.codes.append(np.fromiter(map(known.__getitem__, words), "<u4", len(words)))
        self.rows.append(row)
        self.doc_ids.append(doc_id)
        self.lengths.append(len(words))
        self.held += len(words)

    def proof(self) -> int:
        """A digest of the texts and their words."""
        digest = hashlib.blake2b(np.array(self.rows + self.lengths, "<i8").tobytes(), digest_size=8)
        digest.update("\0".join(self.words).encode())
        return int.from_bytes(digest.digest(), "little", signed=True)

    def entries(self, shares: int) -> Iterator[dict]:
        """A row with the texts, and one for each share of the words."""
        proof, words = self.proof(), list(self.words)
        texts = {"rows": self.rows, "doc_ids": self.doc_ids, "lengths": self.lengths}
        yield {"key": self.key, "block": self.key, "proof": proof, "total": len(words), "a": packed(np.concatenate(self.codes)), **texts}
        encoded = [w.encode() for w in words]
        share = np.fromiter((zlib.crc32(w) % shares for w in encoded), np.int64, len(encoded))
        order = np.argsort(share, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(share[order]) != 0, True]) if len(order) else np.zeros(1, np.int64)
        for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            places = order[start:stop]
            own = [encoded[i] for i in places.tolist()]
            lengths = np.fromiter(map(len, own), "<u4", len(own))
            # The shares have keys below zero, so that they are dealt apart from the blocks.
            key = -1 - int(share[places[0]])
            yield {"key": key, "block": self.key, "proof": proof, "a": packed(places), "b": packed(lengths), "c": pa.compress(b"".join(own), codec="zstd", asbytes=True)}


def _entries(pattern: str, shares: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents (row, doc_id, text) cut into blocks; a document is never divided."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, first, count = splitter(pattern), TaskContext.get().partitionId() << BLOCK_BITS, 0

        def sent(block: Block) -> Iterator[pa.RecordBatch]:
            for entry in block.entries(shares):
                yield pa.RecordBatch.from_pylist([entry], ENTRY_ARROW)

        block = Block(first)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                for row, doc_id, text in zip(*(c.to_pylist() for c in batch.slice(at, TEXTS).columns)):
                    block.add(row, doc_id, split(text))
                    if block.held >= BLOCK:
                        yield from sent(block)
                        count += 1
                        if count >= 1 << BLOCK_BITS:
                            raise ValueError("a task has too many blocks: read the documents in smaller parts")
                        block = Block(first + count)
        if block.rows:
            yield from sent(block)

    return entries


ENTRY_ARROW = pa.schema(
    [(name, pa.int64()) for name in ("key", "block", "proof", "total")]
    + [(name, pa.binary()) for name in "abc"]
    + [("rows", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32()))]
)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2 ** 32 with their first bytes together, then their second ones, and so on, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(numbers).to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def unpacked(data: bytes) -> np.ndarray:
    count = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], decompressed_size=4 * count, codec="zstd", asbytes=True) if count else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, count).T).view("<u4").reshape(-1)


# --- encoding ---------------------------------------------------------------------------


def _encoder(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Encodes the words of shares, which come one share after the other; every word of a share once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, share, known = read_ranks(path), None, {}
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for i in np.flatnonzero(keys < 0).tolist():
                if keys[i] != share:
                    share, known = keys[i], {}
                entry = batch.slice(i, 1).to_pylist()[0]
                lengths = unpacked(entry["b"])
                text = pa.decompress(entry["c"], decompressed_size=int(lengths.sum()), codec="zstd", asbytes=True)
                ends = np.cumsum(lengths).tolist()
                found = []
                for start, stop in zip([0, *ends], ends):
                    word = text[start:stop]
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = merge(word, ranks)
                    found.append(ids)
                counts = np.fromiter(map(len, found), "<u4", len(found))
                flat = np.fromiter((x for ids in found for x in ids), "<u4", int(counts.sum()))
                own = {"key": entry["block"], "block": entry["block"], "proof": entry["proof"], "a": entry["a"], "b": packed(counts), "c": packed(flat)}
                yield pa.RecordBatch.from_pylist([own], ENTRY_ARROW)

    return encode


def _put_together(words: pa.Table, texts: pa.Table) -> pa.Table:
    """The ids of a block's texts, from the ids of its words and the numbers at each position."""
    rows, shares = texts.to_pylist(), words.to_pylist()
    if rows and rows[0]["key"] < 0:
        # The words of a share, not a block.
        return ENCODED_ARROW.empty_table()
    places = [unpacked(s["a"]) for s in shares]
    order = np.concatenate(places) if places else np.zeros(0, "<u4")
    same = len(rows) == 1 and len(order) == rows[0]["total"] and {s["proof"] for s in shares} <= {rows[0]["proof"]}
    if not same:
        raise RuntimeError("the words of a block are not those of its texts: the documents came in another order")
    row, total = rows[0], len(order)
    counts = np.concatenate([unpacked(s["b"]) for s in shares]).astype(np.int64) if shares else np.zeros(0, np.int64)
    flat = np.concatenate([unpacked(s["c"]) for s in shares]).astype(np.int32) if shares else np.zeros(0, np.int32)
    starts, sizes = np.zeros(total, np.int64), np.zeros(total, np.int64)
    starts[order], sizes[order] = np.cumsum(counts) - counts, counts
    numbers = unpacked(row["a"])
    ends = np.cumsum(row["lengths"], dtype=np.int64)
    parts, done = [], 0
    for at in range(0, len(ends), TEXTS):
        some = slice(at, at + TEXTS)
        own = numbers[done : ends[some][-1]]
        each = sizes[own]
        upto = np.cumsum(each)
        ids = flat[np.repeat(starts[own] - (upto - each), each) + np.arange(int(upto[-1]) if len(upto) else 0)]
        offsets = np.r_[0, upto][np.r_[0, ends[some] - done]]
        column = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))
        parts.append(pa.table([pa.array(row["rows"][some], pa.int64()), pa.array(row["doc_ids"][some], pa.int64()), column], ENCODED_ARROW))
        done = ends[some][-1]
    return pa.concat_tables(parts)


ENCODED_ARROW = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def _encode(docs: DataFrame, path: str, pattern: str, finish: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Blocks of encoded texts, as ``finish`` makes them of the words and texts of a block.

    Texts and words leave the first step by one shuffle, texts to their block and words to their share; the
    encoded words follow to the blocks by a second one. There are as many shares as the session makes shuffle partitions.
    """
    spark = docs.sparkSession
    common.ship(spark)
    row = F.monotonically_increasing_id().alias("row")
    texts = docs.select(row, F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = texts.mapInArrow(_entries(pattern, shares), ENTRY_SCHEMA).repartition("key")
    encoded = dealt.sortWithinPartitions("key").mapInArrow(_encoder(path), ENTRY_SCHEMA)
    return encoded.groupBy("key").cogroup(dealt.groupBy("key")).applyInArrow(finish, schema)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(row, doc_id, ids): the ids of every whole text by the ranks in a file; ``row`` numbers the rows of the table."""
    return _encode(docs, path, pattern, _put_together, ENCODED_SCHEMA)


# --- decoding ---------------------------------------------------------------------------


def token_bytes(spark: SparkSession, path: str) -> DataFrame:
    """(id, data): the bytes of every token of a vocabulary."""
    return spark.createDataFrame([(rank, bytearray(token)) for token, rank in read_ranks(path).items()], "id int, data binary")


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some texts at a time, and in front of them a row for each id in them."""
    names = ["row", "doc_id", "id", "ids"]
    lists = pa.list_(pa.int32())

    def asked(waiting: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = pc.unique(pa.concat_arrays([b.column(2).flatten() for b in waiting]))
        none = [pa.nulls(len(ids), pa.int64())] * 2
        yield pa.RecordBatch.from_arrays([*none, ids, pa.nulls(len(ids), lists)], names=names)
        for b in waiting:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.nulls(b.num_rows, pa.int32()), b.column(2).cast(lists)], names=names)

    waiting, held = [], 0
    for batch in batches:
        waiting.append(batch)
        held += len(batch.column(2).flatten())
        if held >= JOINED:
            yield from asked(waiting)
            waiting, held = [], 0
    if waiting:
        yield from asked(waiting)


class _Tokens:
    """The bytes of the ids that the texts which follow have asked for."""

    def __init__(self) -> None:
        self.parts: list[tuple[pa.Array, pa.Array]] = []
        self.keys: np.ndarray | None = None

    def add(self, ids: pa.Array, data: pa.Array) -> None:
        if self.keys is not None:
            self.parts, self.keys = [], None
        if data.null_count:
            raise ValueError("an id is not in the vocabulary")
        self.parts.append((ids, data))

    def of(self, lists: pa.ListArray) -> pa.Array:
        """The bytes of each list of ids."""
        if self.keys is None:
            ids = np.concatenate([a.to_numpy() for a, _ in self.parts]) if self.parts else np.zeros(0, np.int32)
            # As long as the vocabulary: where the bytes of an id stand, or one past the end.
            self.keys = np.full(int(ids.max(initial=-1)) + 2, len(ids), np.int32)
            self.keys[ids] = np.arange(len(ids))
            self.data = pa.concat_arrays([b for _, b in self.parts]) if self.parts else pa.array([], pa.binary())
        flat = lists.flatten().to_numpy()
        at = self.keys[np.minimum(flat, len(self.keys) - 1)]
        if len(at) and at.max() >= len(self.data):
            raise RuntimeError("texts did not follow the ids they asked for")
        pieces = self.data.take(pa.array(at))
        lengths = pc.binary_length(pieces).to_numpy(zero_copy_only=False)
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        cuts = np.r_[0, np.cumsum(lengths, dtype=np.int64)][np.r_[0, np.cumsum(counts, dtype=np.int64)]]
        # The pieces lie one after another in one buffer already.
        start = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset] if len(pieces) else 0
        content = pieces.buffers()[2] if len(pieces) else pa.py_buffer(b"")
        return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer((cuts + start).astype(np.int32).tobytes()), content])


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts with their bytes; rows with an id come before the texts that hold it."""
    tokens = _Tokens()
    for batch in batches:
        asks = batch.column("id").is_valid().to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(np.r_[True, asks[1:] != asks[:-1]]) if len(asks) else []
        for start, stop in zip(edges, [*edges[1:], len(asks)]):
            run = batch.slice(start, stop - start)
            if asks[start]:
                tokens.add(run.column("id"), run.column("data"))
                continue
            for at in range(0, run.num_rows, TEXTS):
                some = run.slice(at, TEXTS)
                lists = pa.concat_arrays([some.column("ids")])
                yield pa.RecordBatch.from_arrays([some.column("row"), some.column("doc_id"), lists, tokens.of(lists)], names=["row", "doc_id", "ids", "data"])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(row, doc_id, ids, data): the bytes that ids stand for; ``row`` tells the texts apart.

    The ids of some texts are joined with the tokens' bytes ahead of these texts and in the same task, so nothing is shuffled.
    """
    common.ship(encoded.sparkSession)
    return _decoded(encoded.select("row", "doc_id", "ids").mapInArrow(_ask, ASKED_SCHEMA), path)


def _block_that_asks(words: pa.Table, texts: pa.Table) -> pa.Table:
    """A block put together, with the ids it holds in front of its texts."""
    rows = list(_ask(iter(_put_together(words, texts).to_batches())))
    return pa.Table.from_batches(rows, ASKED_ARROW)


ASKED_ARROW = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("id", pa.int32()), ("ids", pa.list_(pa.int32()))])


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``decode(encode(docs))`` with one Python step less: the step that puts texts together also asks for their tokens."""
    return _decoded(_encode(docs, path, pattern, _block_that_asks, ASKED_SCHEMA), path)


def _decoded(asked: DataFrame, path: str) -> DataFrame:
    tokens = F.broadcast(token_bytes(asked.sparkSession, path))
    return asked.join(tokens, "id", "left").select("row", "doc_id", "id", "ids", "data").mapInArrow(_answer, DECODED_SCHEMA)
