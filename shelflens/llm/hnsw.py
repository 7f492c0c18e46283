"""Nearest neighbours by inner product: a navigable small-world graph per shard, results merged."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelflens.llm.common import MARK, write_once


@dataclass(frozen=True)
class HnswConfig:
    """Settings of the graphs. ``neighbours`` per layer, twice as many in the lowest."""

    neighbours: int = 16
    build_width: int = 64
    search_width: int = 96
    shard_rows: int = 4096
    query_block: int = 512
    seed: int = 11


class Graph:
    """Flat arrays: neighbours of node i in a layer are row i, filled up with -1; upper layers list their nodes."""

    def __init__(self, vectors: np.ndarray, config: HnswConfig):
        self.vectors, self.config = np.ascontiguousarray(vectors, np.float32), config
        n = len(vectors)
        draws = np.random.default_rng(config.seed).random(n)
        self.levels = np.minimum(np.floor(-np.log(np.maximum(draws, 1e-12)) / np.log(config.neighbours)), 8).astype(np.int64)
        # The first node of the top layer is where searches start; it goes in first.
        self.order = np.argsort(-self.levels, kind="stable")
        self.tops = int(self.levels.max()) if n else 0
        self.links = [np.full((n, config.neighbours * (1 if k else 2)), -1, np.int32) for k in range(self.tops + 1)]
        self.sizes = [np.zeros(n, np.int32) for _ in range(self.tops + 1)]
        self.seen, self.stamp = np.zeros(n, np.int64), 0
        for at, node in enumerate(self.order.tolist()):
            if at:
                self._insert(node)

    @classmethod
    def stored(cls, vectors: np.ndarray, links: list[np.ndarray], sizes: list[np.ndarray], entry: int, config: HnswConfig) -> Graph:
        graph = cls.__new__(cls)
        graph.vectors, graph.config, graph.links, graph.sizes = vectors, config, links, sizes
        graph.tops, graph.order = len(links) - 1, np.array([entry])
        graph.seen, graph.stamp = np.zeros(len(vectors), np.int64), 0
        return graph

    def _near(self, q: np.ndarray, entries: list[tuple[float, int]], width: int, layer: int) -> list[tuple[float, int]]:
        """The ``width`` nearest nodes met from the entries on, nearest first, as (similarity, node)."""
        vectors, links, sizes, seen = self.vectors, self.links[layer], self.sizes[layer], self.seen
        self.stamp += 1
        stamp = self.stamp
        seen[[i for _, i in entries]] = stamp
        todo = [(-s, i) for s, i in entries]
        best = list(entries)
        heapq.heapify(todo)
        heapq.heapify(best)
        while todo:
            s, node = heapq.heappop(todo)
            if -s < best[0][0] and len(best) >= width:
                break
            around = links[node, : sizes[node]]
            around = around[seen[around] != stamp]
            if not len(around):
                continue
            seen[around] = stamp
            likeness = vectors[around] @ q
            if len(best) >= width:
                better = likeness > best[0][0]
                around, likeness = around[better], likeness[better]
            for s, i in zip(likeness.tolist(), around.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (s, i))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, i))
                else:
                    continue
                heapq.heappush(todo, (-s, i))
        return sorted(best, reverse=True)

    def _spread(self, likeness: np.ndarray, nodes: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` of the nodes, nearest first: those not nearer to one taken already, then the others."""
        if len(nodes) <= most:
            return nodes
        rows = self.vectors[nodes]
        between = rows @ rows.T
        # Inner products of augmented vectors of equal length order as distances do.
        taken: list[int] = []
        closest = np.full(len(nodes), -np.inf, np.float32)
        for i in range(len(nodes)):
            if closest[i] < likeness[i]:
                taken.append(i)
                if len(taken) == most:
                    break
                np.maximum(closest, between[i], out=closest)
        if len(taken) < most:
            rest = [i for i in range(len(nodes)) if i not in set(taken)]
            taken += rest[: most - len(taken)]
        return nodes[taken]

    def _insert(self, node: int) -> None:
        q, config = self.vectors[node], self.config
        entry = int(self.order[0])
        near = [(float(self.vectors[entry] @ q), entry)]
        level = int(self.levels[node])
        for layer in range(self.tops, level, -1):
            near = self._near(q, near, 1, layer)
        for layer in range(min(level, self.tops), -1, -1):
            near = self._near(q, near, config.build_width, layer)
            links, sizes = self.links[layer], self.sizes[layer]
            nodes = np.array([i for _, i in near], np.int32)
            chosen = self._spread(np.array([s for s, _ in near], np.float32), nodes, config.neighbours)
            links[node, : len(chosen)] = chosen
            sizes[node] = len(chosen)
            room = links.shape[1]
            for other in chosen.tolist():
                if sizes[other] < room:
                    links[other, sizes[other]] = node
                    sizes[other] += 1
                    continue
                around = np.r_[links[other], np.int32(node)]
                likeness = self.vectors[around] @ self.vectors[other]
                order = np.argsort(-likeness, kind="stable")
                kept = self._spread(likeness[order], around[order], room)
                links[other, : len(kept)] = kept
                sizes[other] = len(kept)

    def search(self, q: np.ndarray, k: int) -> np.ndarray:
        """Up to ``k`` nodes, nearest first."""
        if not len(self.vectors):
            return np.zeros(0, np.int64)
        entry = int(self.order[0])
        near = [(float(self.vectors[entry] @ q), entry)]
        for layer in range(self.tops, 0, -1):
            near = self._near(q, near, 1, layer)
        near = self._near(q, near, max(k, self.config.search_width), 0)
        return np.array([i for _, i in near[:k]], np.int64)


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and no component null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _length(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))


INDEX = "shard long, dims int, classes binary, vectors binary, links array<binary>, sizes array<binary>, entry int"


def build_index(classes: DataFrame, longest: float, shards: int, config: HnswConfig) -> DataFrame:
    """One row per shard: the vectors of its classes, and its graph in flat arrays.

    The largest inner product becomes the nearest neighbour on a sphere by one more
    component, the square root of what a vector's squared length lacks to the longest.
    """

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("class")
        column = table.column("vector").combine_chunks()
        vectors = column.flatten().to_numpy().reshape(table.num_rows, -1).astype(np.float64)
        lack = np.sqrt(np.maximum(longest - (vectors**2).sum(axis=1), 0))
        graph = Graph(np.c_[vectors, lack] / np.sqrt(longest), config)
        row = {
            "shard": table.column("shard")[0].as_py(),
            "dims": vectors.shape[1],
            "classes": table.column("class").to_numpy().astype(np.int64).tobytes(),
            "vectors": vectors.tobytes(),
            "links": [x.tobytes() for x in graph.links],
            "sizes": [x.tobytes() for x in graph.sizes],
            "entry": int(graph.order[0]),
        }
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.int32()]
        return pa.table({name: pa.array([value], kind) for (name, value), kind in zip(row.items(), kinds)})

    # A shard holds vectors of one number of dimensions.
    shard = F.xxhash64(F.size("vector"), F.pmod(F.xxhash64("class"), F.lit(shards)))
    return classes.withColumn("shard", shard).groupBy("shard").applyInArrow(build, INDEX)


def search(index: DataFrame, queries: DataFrame, longest: float, k: int, config: HnswConfig) -> DataFrame:
    """The ``k`` nearest classes of every query in every shard of its dimensions: ``query_id``, ``class``, ``score``.

    Queries go in blocks to each shard; a block and a shard meet in one task.
    """
    blocks = queries.withColumn("block", F.struct(F.size("vector").alias("dims"), F.floor(F.monotonically_increasing_id() / config.query_block).alias("b")))
    blocks = blocks.groupBy("block").agg(F.collect_list(F.struct("query_id", "vector")).alias("queries")).select(F.col("block.dims").alias("dims"), "queries")
    places = write_once(index.select("shard", "dims"), "shards")
    pairs = write_once(blocks, "queries").join(places, "dims").join(index.drop("dims"), "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(i)[at] for i, name in enumerate(batch.schema.names)}
                vectors = np.frombuffer(row["vectors"].as_py()).reshape(-1, row["dims"].as_py())
                members = np.frombuffer(row["classes"].as_py(), np.int64)
                n = len(vectors)
                lack = np.sqrt(np.maximum(longest - (vectors**2).sum(axis=1), 0))
                links = [np.frombuffer(x, np.int32).reshape(n, -1) for x in row["links"].as_py()]
                sizes = [np.frombuffer(x, np.int32) for x in row["sizes"].as_py()]
                graph = Graph.stored(np.ascontiguousarray(np.c_[vectors, lack] / np.sqrt(longest), np.float32), links, sizes, row["entry"].as_py(), config)
                ids, points = row["queries"].values.flatten()
                ids = ids.to_numpy()
                points = points.flatten().to_numpy().reshape(len(ids), -1).astype(np.float64)
                found = [graph.search(np.r_[q / max(np.sqrt(q @ q), 1e-300), 0].astype(np.float32), k) for q in points]
                scores = [(vectors[f] * q).sum(axis=1) for f, q in zip(found, points)]
                columns = [np.repeat(ids, [len(f) for f in found]), members[np.concatenate(found)], np.concatenate(scores)]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["query_id", "class", "score"])

    pairs = pairs.select("shard", "dims", "classes", "vectors", "links", "sizes", "entry", "queries").repartition(F.xxhash64("shard", "queries"))
    return pairs.mapInArrow(run, "query_id long, class long, score double")


def nearest(rows: DataFrame, is_query: Column, k: int = 20, config: HnswConfig = HnswConfig(), id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score``: the k nearest rows found for each query row, itself excluded.

    Nearness is the inner product in double precision; ties go to the smaller id. Every
    usable row is indexed; equal vectors are one node that keeps its k + 1 smallest ids,
    so that no number of copies crowds a graph. Rows whose vector is null, empty, zero
    or has a null or non-finite component take no part, nor do those with a null id.
    Repeated ids count once per different vector. Vectors meet only those of equal
    length. Fewer rows come out where there are fewer candidates; an empty table gives
    an empty result. Other columns are ignored. Starts jobs and writes to the shared
    folder.
    """
    good = rows.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("asked"))
    good = good.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    # -0.0 and 0.0 are one value.
    good = good.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0))).withColumn("class", F.xxhash64("vector"))
    good = write_once(good, "vectors")
    within = Window.partitionBy("class", "vector").orderBy("id")
    members = good.select("class", "vector", "id").dropDuplicates().withColumn("nth", F.row_number().over(within)).filter(F.col("nth") <= k + 1)
    members = members.groupBy("class", "vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    members = write_once(members, "members")
    totals = members.agg(F.count("*"), F.max(_length(F.col("vector")))).first()
    shards, longest = max(1, -(-totals[0] // config.shard_rows)), float(totals[1] or 1.0)
    index = write_once(build_index(members.select("class", "vector"), longest, shards, config), "index")
    queries = good.filter(F.coalesce("asked", F.lit(False))).select(F.col("id").alias("query_id"), "vector").distinct()
    found = search(index, queries, longest, k + 1, config)
    # Only the best k + 1 classes of a query can hold its k nearest: one class may be the query alone. Ties go to the smallest id.
    found = found.join(members.select("class", F.element_at("ids", 1).alias("low")), "class")
    top = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "low")
    found = found.withColumn("nth", F.row_number().over(top)).filter(F.col("nth") <= k + 1).drop("nth", "low")
    each = found.join(members.select("class", "ids"), "class").select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    each = each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return each.select("query_id", "rank", "vec_id", "score")
