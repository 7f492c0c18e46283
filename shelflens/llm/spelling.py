"""Spelling variants: words one edit apart, found through tries over frequency vectors of letter groups."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelflens.llm.common import write_once

# Latin letters; every code point is below 256, so a word has one Latin-1 byte per code point.
LETTERS = r"[A-Za-zÀ-ÿ]"
# Letter groups, that is, levels of a trie.
GROUPS = 16
# Counts in a vector stop here. Stopped counts differ by no more than whole ones, so no near word is lost.
CAP = 62
# Words in one trie, about; a shard that holds more is split into blocks with a trie each.
BLOCK = 1 << 14
# States that one step of a search starts from, code points verified at once, words counted and rows held before they go on.
FRONTIER = 1 << 18
VERIFY = 1 << 21
COUNTED = 1 << 17
HELD = 1 << 16


@dataclass(frozen=True)
class SpellingConfig:
    """Which words take part, and how much more frequent a form is than its variant."""

    min_chars: int = 6
    min_count: int = 5
    dominance: int = 5
    #: Of the hashes of (id, word), every so manyth deletes a letter, to plant misspellings; None: none.
    misspell_every: int | None = None


def misspelt(word: str, seed: int, every: int) -> str:
    """The word, without one letter if ``every`` divides its hash; ``seed``: hash of what stands before the word."""
    h = zlib.crc32(word.encode(), seed)
    return word if h % every else word[: (i := h % len(word))] + word[i + 1 :]


def counted_words(docs: DataFrame, id: str = "doc_id", text: str = "text", config: SpellingConfig = SpellingConfig()) -> DataFrame:
    """Distinct words of enough letters and occurrences with their number ``n``.

    Words are maximal runs of Latin letters, A-Z lower-cased. Tasks count before
    anything is shuffled, and pass counts on whenever they hold many words.
    """
    run_of = re.compile(f"{LETTERS}{{{config.min_chars},}}")
    every, least = config.misspell_every, config.min_chars

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # Lower-casing bytes changes A-Z only.
                found = Counter(m[0] for m in run_of.finditer(raw.lower().decode("utf-8", "replace"))) if raw else {}
                seed = zlib.crc32(f"{name}:".encode()) if name is not None else zlib.crc32(b":")
                for word, n in found.items():
                    if every:
                        word = misspelt(word, seed, every)
                        if len(word) < least:
                            continue
                    counts[word] += n
                if len(counts) >= COUNTED:
                    yield rows(counts)
                    counts = Counter()
        if counts:
            yield rows(counts)

    given = docs.select(F.col(id).cast("string"), F.col(text).cast("binary"))
    partial = given.mapInArrow(run, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= config.min_count)


def letter_groups(words: DataFrame, groups: int = GROUPS) -> list[str]:
    """The letters that occur, dealt into groups of even weight: the most frequent first, each into the lightest group.

    The driver gets one row per letter, of which Latin-1 has 90 at most.
    """
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).filter("letter <> ''").groupBy("letter").count()
    dealt, weight = [""] * groups, [0] * groups
    for row in sorted(letters.collect(), key=lambda r: (-r["count"], r["letter"])):
        lightest = weight.index(min(weight))
        dealt[lightest] += row["letter"]
        weight[lightest] += row["count"]
    return [g for g in dealt if g]


class Words:
    """Words of a task as flat bytes with their counts of letter groups."""

    def __init__(self, texts: list[str], group_of: np.ndarray, groups: int) -> None:
        raw = [t.encode("latin-1") for t in texts]
        self.flat = np.frombuffer(b"".join(raw), np.uint8)
        self.lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        self.starts = np.cumsum(self.lengths) - self.lengths
        place = np.repeat(np.arange(len(raw)) * groups, self.lengths) + group_of[self.flat]
        counts = np.bincount(place, minlength=len(raw) * groups).reshape(len(raw), groups)
        self.counts = np.minimum(counts, CAP)


class Trie:
    """Tries of several shards: a path gives the counts of one letter group after the other, a leaf the words that have them.

    A level lists its nodes in ascending order by (parent, count), as one number.
    """

    def __init__(self, shard: np.ndarray, counts: np.ndarray) -> None:
        self.order = np.lexsort([*counts.T[::-1], shard])
        node, counts = shard[self.order], counts[self.order]
        self.levels: list[np.ndarray] = []
        first = np.ones(len(node), bool)
        for level in range(counts.shape[1]):
            key = node * (CAP + 3) + counts[:, level] + 1
            first = np.r_[True, key[1:] != key[:-1]]
            self.levels.append(key[first])
            node = np.cumsum(first) - 1
        self.leaf_starts = np.flatnonzero(first)
        self.leaf_sizes = np.diff(np.r_[self.leaf_starts, len(node)])

    def search(self, shard: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, word) pairs whose vectors differ by at most one count too many and one too few.

        Depth first: what leads down from a part of the states is followed to the
        leaves before the next part, so the states held don't grow with the queries.
        """
        every = np.arange(len(shard))
        spare = np.full(len(shard), 3, np.int8)  # 1: a count more may follow, 2: a count less
        stack = [(0, every, shard, spare)]
        while stack:
            level, query, node, spare = stack.pop()
            if len(query) > FRONTIER:
                for at in range(0, len(query), FRONTIER):
                    part = slice(at, at + FRONTIER)
                    stack.append((level, query[part], node[part], spare[part]))
                continue
            if level == len(self.levels):
                yield from self._leaves(query, node)
                continue
            keys, found = self.levels[level], []
            wanted = node * (CAP + 3) + counts[query, level] + 1
            for change, cost in ((0, 0), (1, 1), (-1, 2)):
                may = np.flatnonzero((spare & cost) == cost)
                key = wanted[may] + change
                at = np.searchsorted(keys, key)
                hit = at < len(keys)
                hit[hit] = keys[at[hit]] == key[hit]
                found.append((query[may[hit]], at[hit], spare[may[hit]] - np.int8(cost)))
            query, node, spare = (np.concatenate(x) for x in zip(*found))
            if len(query):
                stack.append((level + 1, query, node, spare))

    def _leaves(self, query: np.ndarray, leaf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        sizes, starts = self.leaf_sizes[leaf], self.leaf_starts[leaf]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        for at in range(0, total, FRONTIER):
            place = np.arange(at, min(total, at + FRONTIER))
            which = np.searchsorted(ends, place, side="right")
            yield query[which], self.order[starts[which] + place - (ends - sizes)[which]]


def one_edit(left: Words, i: np.ndarray, right: Words, j: np.ndarray) -> np.ndarray:
    """Which pairs (word ``i`` of left, word ``j`` of right) differ by exactly one inserted, deleted or replaced letter."""
    a, b = left.lengths[i], right.lengths[j]
    hit = np.zeros(len(i), bool)
    for gap in (0, 1, -1):  # by how many letters the right one is longer
        pairs = np.flatnonzero(b - a == gap)
        if not len(pairs):
            continue
        length = np.minimum(a[pairs], b[pairs])
        step = (np.cumsum(length) - length) // VERIFY
        for part in np.split(np.arange(len(pairs)), np.flatnonzero(np.diff(step)) + 1):
            size, pair = length[part], pairs[part]
            start = np.cumsum(size) - size
            inner = np.arange(int(size.sum())) - np.repeat(start, size)
            x = np.repeat(left.starts[i[pair]], size) + inner
            y = np.repeat(right.starts[j[pair]], size) + inner
            differs = left.flat[x] != right.flat[y]
            if gap == 0:
                hit[pair] = np.add.reduceat(differs, start, dtype=np.int64) == 1
                continue
            # One is the other without a letter: equal up to a place, and from there on shifted by one.
            shifted = left.flat[x + (gap < 0)] != right.flat[y + (gap > 0)]
            first = np.minimum.reduceat(np.where(differs, inner, np.repeat(size, size)), start)
            last = np.maximum.reduceat(np.where(shifted, inner, -1), start)
            hit[pair] = last < first
    return hit


def shard_links(
    shard: np.ndarray, texts: list[str], is_query: np.ndarray, known: np.ndarray, group_of: np.ndarray, groups: int
) -> tuple[np.ndarray, np.ndarray]:
    """Near words of the rows of several shards as pairs of row numbers, in both directions.

    Query rows are searched for in the trie of their shard but aren't part of it;
    members that are ``known`` have been searched for before.
    """
    words = Words(texts, group_of, groups)
    members = np.flatnonzero(~is_query)
    if not len(members):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    trie = Trie(shard[members], words.counts[members])
    asked = np.flatnonzero(~known)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for query, member in trie.search(shard[asked], words.counts[asked]):
        i, j = asked[query], members[member]
        near = one_edit(words, i, words, j)
        i, j = i[near], j[near]
        out = is_query[i]  # members find each other from both sides
        left += [i, j[out]]
        right += [j, i[out]]
    return np.concatenate(left), np.concatenate(right)


def levels_for(count: int, block: int) -> int:
    """How many letter groups make the key of a shard: more for more words, so that shards stay small."""
    return next((k for k in range(2, 10) if count / 3.0**k <= block / 4), 10)


def near_words(words: DataFrame, block: int = BLOCK, levels: int | None = None) -> DataFrame:
    """Rows ``word, other, other_n`` for all pairs of distinct words one edit apart, both ways.

    Words (``word, n``, a written table) become vectors: how often the letters of each
    group occur. One edit adds one to a count, takes one from a count, or both. The
    first ``levels`` counts are the upper part of the trie and make the shard; the rest
    of the trie is built where a shard's words are. A word is searched for in its own
    shard and sent to those that one surplus, or a surplus before a deficit, leads to;
    the ways back are found from the other side. A shard of more than ``block`` words is
    split by hash into blocks with a trie each, and every word is searched for in those
    before its own. Leaf words are verified letter by letter.
    """
    levels = levels_for(words.count(), block) if levels is None else levels
    dealt = letter_groups(words)
    levels = min(levels, len(dealt))
    group_of = np.zeros(256, np.int64)
    for i, letters in enumerate(dealt):
        group_of[list(letters.encode("latin-1"))] = i

    def count(letters: str) -> Column:
        return F.least(F.length("word") - F.length(F.translate("word", letters, "")), F.lit(CAP)).cast("long")

    counts = [F.col(f"c{i}") for i in range(levels)]
    digit = [F.lit(64**i).cast("long") for i in range(levels)]
    own_key = sum((c * d for c, d in zip(counts, digit)), F.lit(0).cast("long"))
    # One count more, or also one less at a later place; the differences to other keys in one direction of each pair.
    away = list(digit) + [F.when(counts[j] > 0, digit[i] - digit[j]) for i in range(levels) for j in range(i + 1, levels)]
    rows = words.select("word", "n", *[count(dealt[i]).alias(f"c{i}") for i in range(levels)])
    rows = rows.withColumn("home", own_key)
    places = F.array(F.struct(F.col("home").alias("key"), F.lit(False).alias("away")), *[F.struct((F.col("home") + d).alias("key"), F.lit(True).alias("away")) for d in away])
    rows = rows.select("word", "n", F.explode(F.filter(places, lambda p: p["key"].isNotNull())).alias("p")).select("word", "n", "p.*")
    large = rows.filter("not away").groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > block)
    large = large.select("key", F.ceil(F.col("size") / block).alias("blocks"))
    blocks = F.coalesce("blocks", F.lit(1).cast("long"))
    rows = rows.join(large, "key", "left")
    rows = rows.withColumn("own", F.when(F.col("away"), blocks).otherwise(F.pmod(F.xxhash64("word"), blocks)))
    last = F.when(F.col("away"), F.col("own") - 1).otherwise(F.col("own"))
    rows = rows.select("key", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"), "own", "word", "n")
    rows = rows.select("key", "block", (F.col("block") < F.col("own")).alias("query"), "word", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(group_of, len(dealt))
        for batch in batches:
            if batch.num_rows:
                yield from held.add(batch)
        yield from held.solve(held.rows())

    placed = rows.repartition("key", "block").sortWithinPartitions("key", "block", "query")
    return placed.mapInArrow(run, "word string, other string, other_n long")


class Held:
    """Rows of a task until there are enough to search for at once; of an open shard its members stay."""

    def __init__(self, group_of: np.ndarray, groups: int) -> None:
        self.group_of, self.groups = group_of, groups
        self.shard, self.last = 0, None
        self.parts: list[tuple] = []

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        key, block, query, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 4))
        change = np.r_[(key[0], block[0]) != self.last, (key[1:] != key[:-1]) | (block[1:] != block[:-1])]
        shard = self.shard + np.cumsum(change)
        self.shard, self.last = int(shard[-1]), (key[-1], block[-1])
        self.parts.append((shard, batch.column(3).to_pylist(), query.astype(bool), n, np.zeros(len(n), bool)))
        if sum(len(p[0]) for p in self.parts) >= HELD:
            shard, words, query, n, known = rows = self.rows()
            open_shard = shard == self.shard
            begun = query[open_shard].any()  # else more members may come
            kept = open_shard & ~query
            yield from self.solve(rows if begun else self.only(rows, ~open_shard))
            shard, words, query, n, known = self.only(rows, kept)
            self.parts = [(shard, words, query, n, known | begun)]

    def rows(self) -> tuple:
        if not self.parts:
            return (np.zeros(0, np.int64), [], np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0, bool))
        shard, words, query, n, known = zip(*self.parts)
        return np.concatenate(shard), [w for part in words for w in part], np.concatenate(query), np.concatenate(n), np.concatenate(known)

    @staticmethod
    def only(rows: tuple, chosen: np.ndarray) -> tuple:
        places = np.flatnonzero(chosen)
        return tuple([c[i] for i in places.tolist()] if isinstance(c, list) else c[places] for c in rows)

    def solve(self, rows: tuple) -> Iterator[pa.RecordBatch]:
        shard, words, query, n, known = rows
        a, b = shard_links(shard, words, query, known, self.group_of, self.groups)
        texts, counts = pa.array(words, pa.string()), pa.array(n, pa.int64())
        for at in range(0, len(a), HELD):
            left, right = pa.array(a[at : at + HELD]), pa.array(b[at : at + HELD])
            yield pa.RecordBatch.from_arrays([texts.take(left), texts.take(right), counts.take(right)], names=["word", "other", "other_n"])


def roots(forms: DataFrame) -> DataFrame:
    """Rows ``word, root``: where following ``form`` from a word ends, by doubling the steps in every round.

    A form is some times as frequent as its word, so paths end after a number of steps
    that grows with the logarithm of the largest count, and rounds with that one's.
    """
    ways = write_once(forms.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"), F.lit(True).alias("more")), "forms")
    while ways.filter("more").limit(1).count():
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways = ways.join(further, "root", "left")
        ways = write_once(ways.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("more")), "roots")
    return ways.select("word", "root")


def variants(docs: DataFrame, id: str = "doc_id", text: str = "text", config: SpellingConfig = SpellingConfig()) -> DataFrame:
    """One row per word: ``word, n, n_near, form, form_n, root``.

    ``n_near`` counts the words one edit apart, ``form`` is the most frequent of them
    (ties: the smallest) if it occurs at least ``dominance`` times as often as the word,
    else null like ``form_n``; ``root`` follows forms to the last.

    Null and empty texts have no words; very long texts are read run by run, very long
    words count like others; repeated rows count as often as they stand; null ids only
    matter to planted misspellings. An empty table gives an empty result. Other columns
    are not looked at. Starts jobs and writes to the shared folder.
    """
    words = write_once(counted_words(docs, id, text, config), "words")
    # Of two words, both may count the other, so there is one row per word and near word, and no more.
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("other")))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    frequent = -F.col("best.minus") >= config.dominance * F.col("n")
    found = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(frequent, F.col("best.other")).alias("form"),
        F.when(frequent, -F.col("best.minus")).alias("form_n"),
    )
    found = write_once(found, "variants")
    return found.join(roots(found), "word", "left").withColumn("root", F.coalesce("root", "word"))
