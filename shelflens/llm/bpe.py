"""Byte-level BPE: ranked merges of byte pairs, and decoding by concatenation."""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from shelflens.llm.common import MARK, with_field

# Distinct words of at most so many characters whose ids a task keeps; beyond KEPT words, it starts afresh.
KEPT = 1 << 18
LONGEST = 256
# Rows put out at a time, as ids take more room than text.
ROWS = 512
# Bytes of texts that are encoded together, about.
PART_BYTES = 1 << 20
# Pieces up to this many bytes are merged by repeated scans, longer ones with a heap.
SHORT = 48

Ranks = dict[bytes, int]


def load_ranks(path: str) -> Ranks:
    """Ranks from a file of ``base64 rank`` lines. The vocabulary is fixed, so its size is bounded."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _merge_long(piece: bytes, ranks: Ranks) -> list[int]:
    """Merges with a heap over linked parts: n log n, the same order as scanning."""
    n = len(piece)
    end = list(range(1, n + 1))  # end of the part that starts here; 0 once it was merged into another
    before = list(range(-1, n - 1))
    missing = len(ranks)

    def pair(at: int) -> int:
        after = end[at]
        return ranks.get(piece[at : end[after]], missing) if after < n else missing

    heap = [(rank, at, at + 2) for at in range(n - 1) if (rank := pair(at)) != missing]
    heapq.heapify(heap)
    while heap:
        rank, at, stop = heapq.heappop(heap)
        after = end[at]
        if not after or after >= n or end[after] != stop:
            continue  # one of the two has changed meanwhile
        end[at], end[after] = stop, 0
        if stop < n:
            before[stop] = at
        for start in (at, before[at]):
            if start >= 0 and (rank := pair(start)) != missing:
                heapq.heappush(heap, (rank, start, end[end[start]]))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : end[at]]])
        at = end[at]
    return ids


def merge_piece(piece: bytes, ranks: Ranks) -> list[int]:
    """Ids of one piece: the adjacent pair of lowest rank (leftmost first) is merged until none has a rank."""
    whole = ranks.get(piece)
    return [whole] if whole is not None else _merge_long(piece, ranks)


class Merges:
    """The merges of many pieces at once.

    ``pairs`` are all pairs of ids that join to a token, as sorted keys, with the
    token's id beside them. A round merges the lowest pair of each piece.
    """

    def __init__(self, ranks: Ranks):
        self.ranks, self.missing = ranks, len(ranks)
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        joins = [
            (left * self.missing + right, rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if (left := ranks.get(token[:i])) is not None and (right := ranks.get(token[i:])) is not None
        ]
        keys = np.array(joins, np.int64).reshape(-1, 2)
        keys = keys[np.argsort(keys[:, 0])]
        self.keys, self.found = np.r_[keys[:, 0], np.iinfo(np.int64).max], np.r_[keys[:, 1], self.missing]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.missing + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.found[at], self.missing)

    def of_length(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of pieces of one length."""
        out: list[bytes] = [b""] * len(pieces)
        ids = self.bytes[np.frombuffer(b"".join(pieces), np.uint8).reshape(len(pieces), -1)]
        rows, rank = np.arange(len(pieces)), self.rank(ids[:, :-1], ids[:, 1:])
        while len(rows):
            least = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(rows), np.int64)
            best = rank[np.arange(len(rows)), least] if rank.shape[1] else np.full(len(rows), self.missing)
            live = best < self.missing
            width = ids.shape[1] * 4
            packed = ids[~live].astype(np.int32).tobytes()
            for k, row in enumerate(rows[~live].tolist()):
                out[row] = packed[k * width : (k + 1) * width]
            rows, ids, rank, least, best = rows[live], ids[live], rank[live], least[live], best[live]
            if not len(rows):
                break
            at = np.arange(len(rows))
            ids[at, least] = best
            keep = np.ones(ids.shape, bool)
            keep[at, least + 1] = False
            ids = ids[keep].reshape(len(rows), -1)
            keep = np.ones(rank.shape, bool)
            keep[at, least] = False
            rank = rank[keep].reshape(len(rows), -1)
            after = at[least < rank.shape[1]]
            rank[after, least[after]] = self.rank(ids[after, least[after]], ids[after, least[after] + 1])
            ahead = at[least > 0]
            rank[ahead, least[ahead] - 1] = self.rank(ids[ahead, least[ahead] - 1], ids[ahead, least[ahead]])
        return out

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids (32-bit) of each piece."""
        out: list[bytes] = [b""] * len(pieces)
        lengths: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            if len(piece) > SHORT or piece in self.ranks:
                out[k] = array("i", merge_piece(piece, self.ranks)).tobytes()
            else:
                lengths.setdefault(len(piece), []).append(k)
        for places in lengths.values():
            for k, ids in zip(places, self.of_length([pieces[k] for k in places])):
                out[k] = ids
        return out


class Encoder:
    """Ids of texts as packed 32-bit integers; keeps those of distinct words.

    No match of the pattern goes on past a space that follows a visible character.
    So a text is cut at single spaces, and a word with its space is encoded once.
    """

    def __init__(self, ranks: Ranks, pattern: str):
        self.merges, self.split = Merges(ranks), regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        if max(len(self.known), len(self.pieces)) >= KEPT:
            self.known, self.pieces = {}, {}
        cut = [text.split(" ") if text else [""] for text in texts]
        heads = [words.pop(0) for words in cut]
        new = set().union(*cut).difference(self.known)
        odd = {word for word in new if not word or word[-1].isspace()}  # runs of white space lie across the cuts
        for i, (head, words) in enumerate(zip(heads, cut)):
            if texts[i] and (not head or head[-1].isspace() or odd and not odd.isdisjoint(words)):
                heads[i], cut[i] = texts[i], []
        starts = [self.split(head) for head in heads]
        split = {word: self.split(" " + word) for word in new - odd}
        fresh = list({p for found in (*starts, *split.values()) for p in found if p not in self.pieces})
        self.pieces.update(zip(fresh, self.merges([p.encode() for p in fresh])))
        piece, known = self.pieces.__getitem__, self.known
        known.update((word, b"".join(map(piece, found))) for word, found in split.items())
        out = [b"".join([*map(piece, start), *map(known.__getitem__, words)]) for start, words in zip(starts, cut)]
        for kept, added in ((known, split), (self.pieces, fresh)):
            for long in [x for x in added if len(x) > LONGEST]:
                del kept[long]
        return out


def _parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows (start, length) of at most ROWS texts and about PART_BYTES; a longer text is one by itself."""
    start = held = 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > start and (i - start >= ROWS or held + size > PART_BYTES):
            yield start, i - start
            start, held = i, 0
        held += size
    if len(texts) > start:
        yield start, len(texts) - start


def encode(
    docs: DataFrame, ranks: Ranks, pattern: str, text: str = "text", ids: str = "ids", keep: list[str] | None = None, decoded: str | None = None
) -> DataFrame:
    """``keep`` (default: all columns) with the token ids of a text column as ``array<int>``; null and empty texts have none.

    Every match of ``pattern`` is encoded by itself, without special tokens. Nothing
    is shuffled. A task keeps the ids of distinct words (about ``KEPT`` at most), so
    that a frequent word is merged once; a single word of any length costs n log n. An
    extra column named ``ids`` is replaced, an empty table gives an empty result.
    ``decoded`` names a further column: the bytes of the ids, decoded as ``decode`` does
    in the same Python worker, so that a task holds one worker and one vocabulary.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (ids, decoded)]
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded = Encoder(shared.value, pattern)
        piece = {rank: token for token, rank in shared.value.items()}.__getitem__ if decoded else None
        for batch in batches:
            for at, rows in _parts(batch.column(len(keep))):
                part = batch.slice(at, rows)
                packed = encoded(part.column(len(keep)).to_pylist())
                ends = np.cumsum([0, *map(len, packed)]) // 4
                flat = pa.array(np.frombuffer(b"".join(packed), np.int32))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
                columns, names = [*part.columns[:-1], lists], [*keep, ids]
                if piece:
                    columns.append(pa.array([b"".join(map(piece, np.frombuffer(one, np.int32).tolist())) for one in packed], pa.binary()))
                    names.append(decoded)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = {ids: ArrayType(IntegerType())} | ({decoded: BinaryType()} if decoded else {})
    schema = with_field(docs.select(*keep).schema, **fields)
    return docs.select(*keep, F.col(text).alias(f"{MARK}text")).mapInArrow(run, schema)


def decode(docs: DataFrame, ranks: Ranks, ids: str = "ids", data: str = "decoded") -> DataFrame:
    """Adds the bytes of a list of ids: their pieces, concatenated. No ids, or null, give no bytes.

    An id that is not in the vocabulary raises an error.
    """
    keep = [c for c in docs.columns if c != data]
    shared = docs.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = shared.value.__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                pieces = [b"".join(map(piece, one.values.to_numpy().tolist())) if one.is_valid else b"" for one in part.column(len(keep))]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(pieces, pa.binary())], names=[*keep, data])

    schema = with_field(docs.select(*keep).schema, **{data: BinaryType()})
    return docs.select(*keep, F.col(ids).alias(f"{MARK}ids")).mapInArrow(run, schema)


def digest(docs: DataFrame, ranks: Ranks, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: number of ids, SHA-256 of the ids in decimal, and of the bytes that decoding them gives."""
    found = encode(docs, ranks, pattern, text, keep=[id], decoded="decoded")
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select(
        F.col(id).alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


# The same merges as a fold of built-in functions, for frames of distinct words.

BUCKETS = 4096


def _literal_ranks(ranks: Ranks) -> Column:
    """The rank map as a literal: maps by bucket of the hash, as a lookup reads a literal map from its start."""
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for token, rank in ranks.items():
        buckets[int.from_bytes(hashlib.md5(token).digest()[:2], "big") % BUCKETS][token.hex().upper()] = rank
    empty = F.expr("cast(map() as map<string,int>)")
    return F.array(*[F.create_map(*[F.lit(x) for kv in b.items() for x in kv]) if b else empty for b in buckets])


def fold_words(found: DataFrame, ranks: Ranks, word: str = "word", ids: str = "ids") -> DataFrame:
    """Ids of distinct words by a fold of ranked merges over their bytes, in SQL functions only.

    Each round of the fold merges the leftmost pair of lowest rank; a word of n bytes
    takes n - 1 rounds at most. Meant for word lists, not for running text: see README.
    """
    literal, missing = _literal_ranks(ranks), F.lit(len(ranks))

    def rank(token: Column) -> Column:
        bucket = F.conv(F.substring(F.md5(F.unhex(token)), 1, 4), 16, 10).cast("int") % BUCKETS
        return F.coalesce(F.try_element_at(F.get(literal, bucket), token), missing)

    def merged(parts: Column, _: Column) -> Column:
        ranked = F.transform(
            F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))),
            lambda p, i: F.struct(rank(F.concat(p, F.get(parts, i + 1))).alias("r"), i.alias("i")),
        )
        best = F.array_min(ranked)
        joined = F.concat(
            F.slice(parts, 1, best["i"]),
            F.array(F.concat(F.get(parts, best["i"]), F.get(parts, best["i"] + 1))),
            F.slice(parts, best["i"] + 3, F.size(parts)),
        )
        return F.when(best["r"] < missing, joined).otherwise(parts)

    letters = F.filter(F.split(F.hex(F.col(word).cast("binary")), "(?<=\\G..)"), lambda x: x != "")
    start = found.withColumn(f"{MARK}parts", letters)
    rounds = F.when(F.size(f"{MARK}parts") > 1, F.sequence(F.lit(2), F.size(f"{MARK}parts"))).otherwise(F.array().cast("array<int>"))
    parts = F.aggregate(rounds, F.col(f"{MARK}parts"), merged)
    return start.withColumn(ids, F.transform(parts, rank)).drop(f"{MARK}parts")
