"""Near duplicates by SimHash fingerprints, linked through sharded BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from shelflens.llm.common import MARK, with_field, write_once
from shelflens.llm.components import components

SEED = 42
SHINGLE = 4
RADIUS = 4
BITS = 64
# Fingerprints in one tree, about; a larger shard is split into blocks of trees.
BLOCK = 2048
# Pairs of query and tree node that one step of a search may start from.
FRONTIER = 1 << 21


def shingle_hashes(text: bytes | None, shingle: int) -> np.ndarray:
    """Hashes of the shingles of a UTF-8 text in order; fewer words are one shingle, a text without words has none."""
    words = text.lower().split() if text else []
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if n <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    spans = zip((ends - lengths)[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n - shingle + 1)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of a UTF-8 text: a bit is 1 if it is set in over half of the shingle hashes.

    Null, empty and blank texts have fingerprint 0.
    """
    hashes = shingle_hashes(text, shingle)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        block = hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (counts * 2 > len(hashes)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", name: str = f"{MARK}fp", keep: list[str] | None = None) -> DataFrame:
    """Adds the fingerprint of a text column as a signed long. ``keep``: columns to carry (default: all)."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != name]
    given = docs.select(*keep, F.col(text).cast("binary").alias(f"{MARK}bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(t) for t in batch.column(len(keep)).to_pylist()], np.uint64).view(np.int64)
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(marks)], names=[*keep, name])

    return given.mapInArrow(run, with_field(docs.select(*keep).schema, **{name: LongType()}))


def _hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def build_forest(marks: np.ndarray, root: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BK-trees over ``members``, one for each value of ``root``, built level by level.

    A child's key is (parent, distance to the parent); returned are the keys in
    order and the children beside them. Marks within a tree are distinct.
    """
    active = members[members != root[members]]
    at = root[active]
    keys, children = [], []
    while len(active):
        key = at * (BITS + 1) + _hamming(marks[active], marks[at])
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        first = np.r_[True, key[1:] != key[:-1]]
        heads = active[first]
        keys.append(key[first])
        children.append(heads)
        at = heads[np.cumsum(first) - 1]
        active, at = active[~first], at[~first]
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, children = np.concatenate(keys), np.concatenate(children)
    order = np.argsort(keys, kind="stable")
    return keys[order], children[order]


def search_forest(
    marks: np.ndarray, queries: np.ndarray, start: np.ndarray, keys: np.ndarray, children: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """All (query, node) pairs within the radius, node != query; edges outside distance +- radius are not followed."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    q, node = queries, start
    while len(q):
        d = _hamming(marks[q], marks[node])
        near = (d <= radius) & (q != node)
        found.append((q[near], node[near]))
        base = node * (BITS + 1)
        low = np.searchsorted(keys, base + np.maximum(d - radius, 0))
        width = np.searchsorted(keys, base + np.minimum(d + radius, BITS), side="right") - low
        edge = np.repeat(low - np.r_[0, np.cumsum(width)[:-1]], width) + np.arange(width.sum())
        q, node = np.repeat(q, width), children[edge]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the sets of each pair; a label is the smallest index of its set."""
    while True:
        left, right = labels[a], labels[b]
        live = left != right
        if not live.any():
            return labels
        a, b, left, right = a[live], b[live], left[live], right[live]
        np.minimum.at(labels, np.maximum(left, right), np.minimum(left, right))
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels = further


def shard_links(shard: np.ndarray, marks: np.ndarray, is_query: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect, shard by shard, all marks within the radius of each other: at most one per row.

    Rows of a shard stand together, those of its tree first; query rows are
    searched for in the tree but not part of it.
    """
    n = len(shard)
    first = np.r_[True, shard[1:] != shard[:-1]]
    starts = np.flatnonzero(first)
    root = starts[np.cumsum(first) - 1]
    keys, children = build_forest(marks, root, np.flatnonzero(~is_query))
    trees = np.add.reduceat((~is_query).astype(np.int64), starts)[np.cumsum(first) - 1]
    labels = np.arange(n)
    queries = np.flatnonzero((trees > 1) | (is_query & (trees > 0)))  # a tree of one node has nothing to find for that node
    step = np.cumsum(trees[queries]) // FRONTIER
    for part in np.split(queries, np.flatnonzero(np.diff(step)) + 1):
        if len(part):
            labels = _merge(labels, *search_forest(marks, part, root[part], keys, children, radius))
    linked = np.flatnonzero(labels != np.arange(n))
    return marks[linked], marks[labels[linked]]


def _masks(parts: int, radius: int) -> list[int]:
    """Every choice of ``parts - radius`` out of ``parts`` even parts of the bits, as signed masks.

    Marks within the radius differ in ``radius`` parts at most, so they agree under one mask.
    """
    edges = [BITS * i // parts for i in range(parts + 1)]
    bands = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(bands, parts - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def parts_for(count: int, radius: int, block: int) -> int:
    """Into how many parts the bits are cut, so that fewest rows are searched for ``count`` fingerprints.

    Few parts make few keys of few bits, whose shards grow with the count; more parts
    make more keys that few fingerprints share. The links found are the same.
    """

    def searched(parts: int) -> float:
        shard = count / 2.0 ** (BITS * (parts - radius) / parts)
        return comb(parts, radius) * (1 + shard / block / 2)

    return min(range(radius + 1, radius + 5), key=searched)


def links(distinct: DataFrame, mark: str, radius: int = RADIUS, block: int = BLOCK, parts: int | None = None) -> DataFrame:
    """Rows ``a``, ``b`` that connect all distinct fingerprints within the radius.

    The bits are cut into ``parts`` (default: by the number of fingerprints), and
    fingerprints within the radius agree in ``parts - radius`` of them. A shard holds
    the fingerprints that agree in one such choice and searches its own BK-tree. A shard
    of more than ``block`` fingerprints is split into blocks with a tree each, and every
    fingerprint is searched for in the blocks before its own as well. Counts the
    fingerprints, which should be a written table.
    """
    parts = parts_for(distinct.count(), radius, block) if parts is None else parts
    shards = [
        F.struct(F.lit(i).alias("band"), F.col(mark).bitwiseAND(F.lit(mask).cast("long")).alias("value"))
        for i, mask in enumerate(_masks(parts, radius))
    ]
    rows = distinct.select(F.col(mark).alias("mark"), F.explode(F.array(*shards)).alias("s")).select("mark", "s.*")
    large = rows.groupBy("band", "value").agg(F.count("*").alias("n")).filter(F.col("n") > block)
    large = large.select("band", "value", F.ceil(F.col("n") / block).alias("blocks"))
    own = F.coalesce(F.pmod(F.xxhash64("mark"), "blocks"), F.lit(0).cast("long"))
    rows = rows.join(large, ["band", "value"], "left").withColumn("own", own)
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), "own")))
    rows = rows.select("mark", F.xxhash64("band", "value", "block").alias("shard"), (F.col("block") < F.col("own")).alias("query"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # whole batches, until a shard has ended

        def solved(part: list[np.ndarray]) -> pa.RecordBatch:
            a, b = shard_links(part[1], part[0].view(np.uint64), part[2].astype(bool), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(now[0]):
                continue
            cut = int(np.searchsorted(now[1], now[1][-1]))  # the last shard may go on in the next batch
            if held and (cut or held[-1][1][-1] != now[1][0]):
                done = held + [[c[:cut] for c in now]]
                yield solved([np.concatenate([p[i] for p in done]) for i in range(3)])
                held = []
            elif cut:
                yield solved([c[:cut] for c in now])
            held.append([c[cut:] for c in now])
        if held:
            yield solved([np.concatenate([p[i] for p in held]) for i in range(3)])

    placed = rows.repartition("shard").sortWithinPartitions("shard", "query")
    return placed.mapInArrow(run, "a long, b long")


def _labelled(docs: DataFrame, id: str, text: str, radius: int, keep: list[str]) -> DataFrame:
    """``keep`` with the fingerprint, the smallest id of the component and its smallest fingerprint."""
    mark, low, root = f"{MARK}fp", f"{MARK}low", f"{MARK}root"
    marked = write_once(fingerprints(docs, text, mark, list(dict.fromkeys([*keep, id]))), "marked")
    distinct = write_once(marked.groupBy(mark).agg(F.min(id).alias(low)), "fingerprints")
    found = components(links(distinct, mark, radius)).toDF(mark, root)
    classes = distinct.join(found, mark, "left").withColumn(root, F.coalesce(root, mark))
    classes = write_once(classes, "classes")
    lowest = classes.groupBy(root).agg(F.min(low).alias("component_id"))
    labels = classes.join(lowest, root).select(mark, root, "component_id")
    return marked.join(labels, mark).withColumn("fingerprint", F.lower(F.lpad(F.hex(mark), 16, "0")))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", radius: int = RADIUS, keep: list[str] | None = None) -> DataFrame:
    """Rows of ``keep`` (default: all columns) with ``fingerprint`` (16 hex digits) and ``component_id``.

    Texts are lower-cased (A-Z), cut into words and 4-word shingles; fingerprints
    link at ``radius`` or fewer differing bits, and ``component_id`` is the smallest
    id reachable over links. Equal texts share a fingerprint; null, empty and blank
    texts have fingerprint 0 and link like any other. A null id counts only where
    the component has no other. Repeated rows stay as they are. An empty table gives
    an empty result. Columns named like the added ones are replaced.

    Fingerprints are made before anything is shuffled, and only distinct ones are
    searched. Starts jobs and writes to the shared folder.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("fingerprint", "component_id")]
    return _labelled(docs, id, text, radius, keep).select(*keep, "fingerprint", "component_id")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """The row with the smallest id of each component (see ``near_duplicates``); of repeated rows one stays.

    Which rows stay is found without texts, so these are shuffled once.
    """
    who, whole, row, names = f"{MARK}who", f"{MARK}whole", f"{MARK}row", docs.columns
    plain = docs.select(*[F.col(c).alias(f"{MARK}{i}") for i, c in enumerate(names)])
    id, text = f"{MARK}{names.index(id)}", f"{MARK}{names.index(text)}"
    plain = plain.withColumn(whole, F.xxhash64(text))
    found = _labelled(plain, id, text, radius, [id, whole]).filter(F.col(id).eqNullSafe(F.col("component_id")))
    order = Window.partitionBy(f"{MARK}root").orderBy("fingerprint", whole)
    found = found.withColumn(row, F.row_number().over(order)).filter(F.col(row) == 1)
    # Id and text as one value, in which a null equals a null.
    pair = F.struct(F.col(id).alias("id"), F.col(whole).alias("whole")).alias(who)
    stay = write_once(found.select(pair), "stay")
    kept = plain.select("*", pair).join(stay, who, "left_semi").dropDuplicates([who])
    return kept.select(*[F.col(f"{MARK}{i}").alias(c) for i, c in enumerate(names)])
