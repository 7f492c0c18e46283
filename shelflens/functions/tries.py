"""Best similarity score of texts among many, by bounds on whole sets of them.

The score of two texts is 2 * LCS / (sum of lengths), see ``similarity``. The row of
the LCS table after some characters of the one text fits into bits, one for each
character of the other: a zero bit says that the row grows there. So a path of a trie
carries a word of bits, and all texts below share it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Characters count as one of so many kinds, and positions up to so many words of bits, where sets of texts are summed up.
KINDS = 64
SUMMARY_WORDS = 4
# States that are followed at once, paths that the first descent keeps per text, and cells of the tables of one step.
FRONTIER = 1 << 16
BEAM = 4
CELLS = 1 << 21


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, end to end, and their lengths."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64), lengths


def scores(matched: np.ndarray, total: np.ndarray) -> np.ndarray:
    """0..100 from LCS length and sum of lengths, halves rounded to even."""
    return np.rint(200.0 * matched / np.maximum(total, 1)).astype(np.int64)


def next_rows(rows: np.ndarray, here: np.ndarray) -> np.ndarray:
    """LCS rows after one more character, which stands at the bits ``here`` of the other text; words are the last axis."""
    used = rows & here
    if rows.shape[-1] == 1:
        return (rows + used) | (rows & ~here)
    out, carry = np.empty_like(rows), np.uint64(0)
    for w in range(rows.shape[-1]):
        total = rows[..., w] + used[..., w]
        more = total + carry
        carry = ((total < used[..., w]) | (more < total)).astype(np.uint64)
        out[..., w] = more | (rows[..., w] & ~here[..., w])
    return out


def grown(rows: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """LCS length within the first ``upto`` characters: zero bits there."""
    found = np.zeros(len(rows), np.int64)
    for w in range(rows.shape[1]):
        bits = np.clip(upto - 64 * w, 0, 64)
        mask = np.where(bits >= 64, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << np.minimum(bits, 63).astype(np.uint64)) - np.uint64(1))
        found += np.bitwise_count(~rows[:, w] & mask)
    return found


def position_bits(kind: np.ndarray, owner: np.ndarray, at: np.ndarray, owners: int, kinds: int, words: int) -> np.ndarray:
    """Bits of the positions ``at`` that each kind takes in each owner: (owners, kinds, words)."""
    bits = np.zeros((owners, kinds, words), np.uint64)
    np.bitwise_or.at(bits, (owner, kind, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
    return bits


# Sets of texts as a whole


def summary(texts: list[str]) -> tuple[int, int, bytes]:
    """Shortest and longest length, and per kind of character the positions it takes in any of the texts."""
    flat, lengths = codes(texts)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    seen = at < 64 * SUMMARY_WORDS
    bits = position_bits(flat[seen] % KINDS, np.zeros(seen.sum(), np.int64), at[seen], 1, KINDS, SUMMARY_WORDS)
    return int(lengths.min()), int(lengths.max()), bits[0].tobytes()


class Summaries:
    """Summaries of several sets of texts, and the best scores they allow."""

    def __init__(self, low: list[int], high: list[int], bits: list[bytes]) -> None:
        self.low, self.high = np.array(low, np.int64), np.array(high, np.int64)
        table = np.frombuffer(b"".join(bits), np.uint64).reshape(-1, KINDS, SUMMARY_WORDS)
        self.words = max(1, min(SUMMARY_WORDS, -(-int(self.high.max(initial=0)) // 64)))
        self.table = np.ascontiguousarray(table[:, :, : self.words].transpose(1, 0, 2))

    def bounds(self, text: str) -> np.ndarray:
        """No text of a set scores higher with this one than its bound.

        The LCS with the sequence of character sets at the positions is at least that
        with any text of the set; what lies beyond the positions kept counts as equal.
        """
        rows = np.full((len(self.low), self.words), 0xFFFFFFFFFFFFFFFF, np.uint64)
        for code in map(ord, text):
            rows = next_rows(rows, self.table[code % KINDS])
        beyond = np.maximum(self.high - 64 * self.words, 0)
        matched = np.minimum(grown(rows, np.full(len(rows), 64 * self.words)) + beyond, len(text))
        length = np.clip(matched, self.low, self.high)  # of the lengths there are, that with the highest score
        return scores(np.minimum(matched, length), length + len(text))


# Tries


class LengthTrie:
    """The texts of one length: distinct prefixes by level, each level in the order of the texts."""

    def __init__(self, table: np.ndarray) -> None:
        n, self.length = table.shape
        self.letters: list[np.ndarray] = []  # of each node, its last character
        self.children: list[np.ndarray] = []  # where the children of a node of the level above begin, and the end
        new = np.r_[True, np.zeros(n - 1, bool)]
        for level in range(self.length):
            parents = np.flatnonzero(new)
            new = new | np.r_[True, table[1:, level] != table[:-1, level]]
            self.letters.append(table[new, level])
            self.children.append(np.r_[(np.cumsum(new) - 1)[parents], new.sum()])


class Tries:
    """Texts of a shard, distinct, as tries by length."""

    def __init__(self, texts: list[str]) -> None:
        flat, lengths = codes(texts)
        self.alphabet, letters = np.unique(flat, return_inverse=True)
        starts = np.cumsum(lengths) - lengths
        self.parts: list[tuple[np.ndarray, LengthTrie]] = []
        for length in np.unique(lengths):
            members = np.flatnonzero(lengths == length)
            table = letters[starts[members][:, None] + np.arange(length)].astype(np.int32)
            order = np.lexsort(table.T[::-1]) if length else np.arange(len(members))
            self.parts.append((members[order], LengthTrie(table[order])))

    def best(self, texts: list[str], least: np.ndarray, threshold: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """Best score of each text, the (text, member) pairs that have it if it reaches the threshold, and the nodes visited.

        Scores of at most ``least`` are not looked for; but those that equal it are, if
        it reaches the threshold already.
        """
        best, pairs, visited = least.copy(), [], np.zeros(len(texts), np.int64)
        words = max(1, -(-max(map(len, texts), default=0) // 64))
        step = max(1, CELLS // (max(1, len(self.alphabet)) * words))
        for at in range(0, len(texts), step):
            part = slice(at, at + step)
            search = Search(self, texts[part], best[part], threshold)
            visited[part] = search.visited
            best[part] = search.best
            pairs += [(at + q, m) for q, m in search.pairs()]
        return best, pairs, visited


class Search:
    """One step of a search: best scores so far let paths go that can't lead to a better one."""

    def __init__(self, tries: Tries, texts: list[str], least: np.ndarray, threshold: int) -> None:
        self.threshold, self.best = threshold, least.copy()
        self.visited = np.zeros(len(texts), np.int64)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        flat, self.lengths = codes(texts)
        owner = np.repeat(np.arange(len(texts)), self.lengths)
        letter = np.searchsorted(tries.alphabet, flat)
        known = letter < len(tries.alphabet)
        known[known] = tries.alphabet[letter[known]] == flat[known]
        owner, letter = owner[known], letter[known]  # others match nothing here
        self.sizes = np.bincount(owner, minlength=len(texts))
        at = np.arange(len(owner)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        words = max(1, -(-int(self.sizes.max(initial=0)) // 64))
        self.bits = position_bits(letter, owner, at, len(texts), max(1, len(tries.alphabet)), words)
        for narrow in (True, False):
            for members, trie in tries.parts:
                self._walk(members, trie, narrow)

    def _bounds(self, trie: LengthTrie, level: int, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Highest score below a node: what the row has before the last characters, and all of these.

        With r characters to come, taking the last r of the text for them is best, since
        a row grows by one per character at most.
        """
        rest = trie.length - level
        size = self.sizes[query]
        matched = grown(rows, np.maximum(size - rest, 0)) + np.minimum(size, rest)
        return scores(matched, self.lengths[query] + trie.length)

    def _open(self, query: np.ndarray, bound: np.ndarray) -> np.ndarray:
        best = self.best[query]
        return (bound > best) | ((bound == best) & (best >= self.threshold))

    def _walk(self, members: np.ndarray, trie: LengthTrie, narrow: bool) -> None:
        """Depth first over parts of the states; ``narrow``: one descent along the most promising paths of each text."""
        query = np.arange(len(self.best))
        rows = np.full((len(query), self.bits.shape[2]), 0xFFFFFFFFFFFFFFFF, np.uint64)
        stack = [(0, query, np.zeros(len(query), np.int64), rows)]
        while stack:
            level, query, node, rows = stack.pop()
            bound = self._bounds(trie, level, query, rows)
            keep = np.flatnonzero(self._open(query, bound))
            if narrow and len(keep) > len(self.best):
                order = keep[np.lexsort([-bound[keep], query[keep]])]
                first = np.r_[True, query[order][1:] != query[order][:-1]]
                nth = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
                keep = order[nth < BEAM]
            query, node, rows = query[keep], node[keep], rows[keep]
            if not len(query):
                continue
            if level == trie.length:
                self._leaves(members, query, node, bound[keep])
                continue
            starts = trie.children[level]
            width = starts[node + 1] - starts[node]
            if len(query) > 1 and not narrow and width.sum() > FRONTIER:
                half = len(query) // 2
                stack += [(level, query[:half], node[:half], rows[:half]), (level, query[half:], node[half:], rows[half:])]
                continue
            child = np.repeat(starts[node] - (np.cumsum(width) - width), width) + np.arange(width.sum())
            query, rows = np.repeat(query, width), np.repeat(rows, width, axis=0)
            self.visited += np.bincount(query, minlength=len(self.best))
            stack.append((level + 1, query, child, next_rows(rows, self.bits[query, trie.letters[level][child]])))

    def _leaves(self, members: np.ndarray, query: np.ndarray, node: np.ndarray, score: np.ndarray) -> None:
        np.maximum.at(self.best, query, score)
        good = score >= self.threshold
        self.found.append((query[good], members[node[good]], score[good]))

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for query, member, score in self.found:
            top = score == self.best[query]
            if top.any():
                yield query[top], member[top]
