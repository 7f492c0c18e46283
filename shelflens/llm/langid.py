"""Language identification by interpolated Kneser-Ney character models."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from shelflens.llm.common import MARK, with_field, write_once

# Characters (16-bit units) of the longest n-gram; a key holds them all.
ORDER = 4
UNIT = 16
VOCABULARY = 1 << UNIT
GAP = 32
# Values (n-grams times languages) that one part of a model holds, about; a larger model is
# cut into parts, and the texts are scored with one after the other.
VALUES = 1 << 22
FACTOR = 0x9E3779B97F4A7C15
# Texts scored at a time.
ROWS = 512
# Windows that count towards the score, at most: beyond, a text is no surer.
SURE = 100


def _letter_table() -> np.ndarray:
    """Which 16-bit units belong to letters; units of surrogate pairs are taken as such."""
    return np.array([chr(c).isalpha() or 0xD800 <= c < 0xE000 for c in range(VOCABULARY)])


def keys(texts: list[str], letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Key of each n-gram, and the text it is of.

    Texts are lower-cased; whatever is no letter is a gap, several gaps are one, and a
    text stands between gaps, so that any letter is in some n-gram.
    """
    units = [np.frombuffer((" " * (ORDER - 1) + t.lower() + " ").encode("utf-16-le"), np.uint16) for t in texts]
    sizes = np.array([len(u) for u in units])
    codes, of = np.concatenate(units), np.repeat(np.arange(len(texts)), sizes)
    gap = ~letter[codes]
    codes = np.where(gap, GAP, codes).astype(np.uint64)
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    for k in range(ORDER - 1):
        keep[starts + k] = True
    codes, of = codes[keep], of[keep]
    n = len(codes) - ORDER + 1
    key = np.zeros(n, np.uint64)
    for k in range(ORDER):
        key = (key << np.uint64(UNIT)) | codes[k : n + k]
    within = of[:n] == of[ORDER - 1 :]
    return key[within], of[:n][within]


def gram_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """Counts of the longest n-grams per language, as ``lang``, ``gram`` (key), ``n``; counted in tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter, held = _letter_table(), {}

        def put(name: str, grams: np.ndarray, n: np.ndarray) -> None:
            old = held.get(name, (grams[:0], n[:0]))
            both, where = np.unique(np.r_[old[0], grams], return_inverse=True)
            held[name] = both, np.bincount(where, np.r_[old[1], n]).astype(np.int64)

        def rows() -> Iterator[pa.RecordBatch]:
            for name, (grams, n) in held.items():
                columns = [pa.array([name] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts: dict[str, list[str]] = {}
                for name, one in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    texts.setdefault(name, []).append(one)
                for name, several in texts.items():
                    put(name, *np.unique(keys(several, letter)[0], return_counts=True))
                if sum(len(g) for g, _ in held.values()) > 1 << 20:
                    yield from rows()
        yield from rows()

    counts = docs.select(F.col(lang).cast("string"), F.col(text)).mapInArrow(run, "lang string, gram long, n long")
    return counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _order(grams: DataFrame, lower: DataFrame | None, k: int) -> tuple[DataFrame, DataFrame]:
    """Interpolated probabilities of the k-grams, and the weight each context leaves to the shorter model."""
    of = grams.groupBy("lang").agg(F.sum((F.col("n") == 1).cast("long")).alias("one"), F.sum((F.col("n") == 2).cast("long")).alias("two"))
    discount = F.when(F.col("one") * F.col("two") > 0, F.col("one") / (F.col("one") + 2 * F.col("two"))).otherwise(F.lit(0.5))
    grams = grams.join(of.select("lang", discount.alias("d")), "lang")
    grams = grams.withColumn("context", F.shiftrightunsigned("gram", UNIT))
    contexts = grams.groupBy("lang", "context").agg(F.sum("n").alias("all"), (F.first("d") * F.count("*") / F.sum("n")).alias("weight"))
    grams = grams.join(contexts, ["lang", "context"]).withColumn("suffix", _suffix(k))
    if lower is None:
        grams = grams.withColumn("lower", F.lit(1.0 / VOCABULARY))
    else:
        grams = grams.join(lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("lower")), ["lang", "suffix"])
    p = (F.col("n") - F.col("d")) / F.col("all") + F.col("weight") * F.col("lower")
    return grams.select("lang", "gram", p.alias("p")), contexts.select("lang", F.col("context").alias("gram"), F.col("weight").alias("p"))


def _suffix(k: int) -> Column:
    return F.col("gram").bitwiseAND((1 << UNIT * (k - 1)) - 1)


@dataclass
class Model:
    """Sorted 64-bit hashes of n-grams per order, with a column of log values per language.

    The value of an n-gram that a language doesn't have is NaN, that of a context 0. A part
    of a model holds all that n-grams with one of its last characters but one need.
    """

    languages: list[str]
    grams: dict[int, tuple[np.ndarray, np.ndarray]]
    contexts: dict[int, tuple[np.ndarray, np.ndarray]]
    units: np.ndarray

    def log_p(self, key: np.ndarray) -> np.ndarray:
        """Log probability of the last character of each n-gram given those before, per language."""
        out = np.full((len(key), len(self.languages)), -math.log(VOCABULARY))
        for k in range(1, ORDER + 1):
            mask = np.uint64((1 << UNIT * k) - 1)
            weight, _ = self._find(self.contexts[k], (key & mask) >> np.uint64(UNIT), 0.0)
            value, known = self._find(self.grams[k], key & mask, np.nan)
            out = np.where(known & ~np.isnan(value), value, out + weight)
        return out

    def _find(self, stored: tuple[np.ndarray, np.ndarray], gram: np.ndarray, missing: float) -> tuple[np.ndarray, np.ndarray]:
        hashes, values = stored
        if not len(hashes):
            return np.full((len(gram), len(self.languages)), missing), np.zeros((len(gram), 1), bool)
        mark = hash_keys(gram)
        at = np.minimum(np.searchsorted(hashes, mark), len(hashes) - 1)
        known = (hashes[at] == mark)[:, None]
        return np.where(known, values[at], missing), known


def hash_keys(gram: np.ndarray) -> np.ndarray:
    """A mix that gives different keys different hashes."""
    mixed = (gram ^ (gram >> np.uint64(31))) * np.uint64(FACTOR)
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(FACTOR)


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model per language of the rows whose text and language are not null, in one part (see ``train_parts``)."""
    return next(train_parts(docs, text, lang, None)[1])


def train_parts(docs: DataFrame, text: str = "text", lang: str = "lang", values: int | None = VALUES) -> tuple[int, Iterator[Model]]:
    """The number of parts of a model per language, and the parts one by one; every n-gram is in one of them.

    The highest order counts occurrences, the lower ones in how many different n-grams
    they end; every order gives up an estimated discount to the next lower one. Counts
    are summed in Spark over all rows. An n-gram, its context and the shorter ones it
    falls back to share the last character but one, by which the parts are cut: each
    holds about ``values`` at most, unless one character alone has more. Single
    characters are in every part.
    """
    docs = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    grams = {ORDER: write_once(gram_counts(docs, text, lang), "grams")}
    for k in range(ORDER, 1, -1):
        shorter = grams[k].groupBy("lang", _suffix(k).alias("gram")).agg(F.count("*").alias("n"))
        grams[k - 1] = write_once(shorter, "grams")
    languages = sorted(r.lang for r in grams[1].select("lang").distinct().collect())
    tables, lower = [], None
    for k in range(1, ORDER + 1):
        lower, contexts = _order(grams[k], lower, k)
        lower = write_once(lower, "order")
        for own, one in ((True, lower), (False, contexts)):
            unit = (F.shiftrightunsigned("gram", UNIT) if own else F.col("gram")).bitwiseAND(VOCABULARY - 1)
            unit = F.lit(-1) if k == 1 else unit.cast("int")
            tables.append(one.select(F.lit(k).alias("k"), F.lit(own).alias("own"), unit.alias("unit"), "lang", "gram", F.log("p").alias("value")))
    entries = write_once(reduce(DataFrame.union, tables), "entries")
    sizes = entries.filter("unit >= 0").groupBy("k", "own", "unit", "gram").agg(F.lit(1).alias("one")).groupBy("unit").agg(F.count("*").alias("n"))
    part_of, filled = np.zeros(VOCABULARY, np.int64), [0]
    for row in sizes.orderBy("unit").collect() if values else []:
        if filled[-1] and (filled[-1] + row.n) * len(languages) > values:
            filled.append(0)
        filled[-1] += row.n
        part_of[row.unit] = len(filled) - 1

    def part(i: int) -> Model:
        mine = entries
        if len(filled) > 1:
            mine = entries.filter((F.col("unit") < 0) | F.col("unit").isin(np.flatnonzero(part_of == i).tolist()))
        return _stored(mine.select("k", "own", "lang", "gram", "value").toArrow(), languages, part_of == i)

    return len(filled), map(part, range(len(filled)))


def _stored(entries: pa.Table, languages: list[str], units: np.ndarray) -> Model:
    column = {name: i for i, name in enumerate(languages)}
    k, own, gram, value = (entries.column(c).to_numpy() for c in ("k", "own", "gram", "value"))
    mark = hash_keys(gram.view(np.uint64))
    lang_at = np.array([column[x] for x in entries.column("lang").to_pylist()], np.int64)

    def stored(which: np.ndarray, missing: float) -> tuple[np.ndarray, np.ndarray]:
        hashes, where = np.unique(mark[which], return_inverse=True)
        values = np.full((len(hashes), len(languages)), missing)
        values[where, lang_at[which]] = value[which]
        return hashes, values

    orders = range(1, ORDER + 1)
    own = own.astype(bool)
    grams, contexts = {i: stored((k == i) & own, np.nan) for i in orders}, {i: stored((k == i) & ~own, 0.0) for i in orders}
    return Model(languages, grams, contexts, units)


def predict(docs: DataFrame, parts: Iterator[Model] | Sequence[Model], count: int = 1, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Rows of ``keep`` (default: all columns) with ``lang_pred``, ``score`` and ``cross_entropy`` (nats a character).

    The language of the lowest length-normalised cross-entropy over the whole text
    (ties: first by name). ``score`` is its share among all languages' likelihoods, of
    100 characters at most. Null texts, texts without a letter, and all texts if no
    language was learned are ``und`` with score 0 and null cross-entropy. Repeated rows
    get equal results, an empty table gives an empty one, columns named like the added
    ones are replaced. Each of the ``count`` parts of the model adds its n-grams'
    share of the sums; between two parts the rows are written to the shared folder.
    """
    added = ["lang_pred", "score", "cross_entropy"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    rows = docs.select(*keep, F.lit(None).cast("array<double>").alias(f"{MARK}sums"), F.col(text).alias(f"{MARK}text"))
    for i, part in enumerate(parts):
        rows = _add(rows, part, keep, added, i == 0, i == count - 1)
        rows = rows if i == count - 1 else write_once(rows, "sums")
    return rows


def _add(rows: DataFrame, model: Model, keep: list[str], added: list[str], first: bool, last: bool) -> DataFrame:
    """Adds what a part of the model knows to each row's sums; the last part makes them the result."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    schema = with_field(rows.select(*keep).schema, lang_pred=StringType(), score=DoubleType(), cross_entropy=DoubleType())
    before = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, letter = shared.value, _letter_table()
        names = np.array([*model.languages, "und"], object)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = part.column(len(keep) + 1).to_pylist()
                usable = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if model.languages else []
                best, score, entropy = np.full(len(texts), len(names) - 1), np.zeros(len(texts)), np.full(len(texts), np.nan)
                sums = np.zeros((len(texts), len(model.languages)))
                if not first:
                    sums += part.column(len(keep)).flatten().to_numpy().reshape(sums.shape)
                if usable:
                    key, of = keys([texts[i] for i in usable], letter)
                    grams, where = np.unique(key, return_inverse=True)
                    inside = model.units[(grams >> np.uint64(UNIT)) & np.uint64(VOCABULARY - 1)]
                    log_p = np.zeros((len(grams), len(model.languages)))
                    log_p[inside] = model.log_p(grams[inside])
                    # Summed text by text over the n-grams in place.
                    log_p = log_p[where]
                    starts = np.searchsorted(of, np.arange(len(usable)))
                    sums[usable] += np.add.reduceat(log_p, starts, axis=0)
                if not last:
                    added_up = pa.array(list(sums), pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], added_up, part.column(len(keep) + 1)], names=before)
                    continue
                if usable:
                    n = np.diff(np.r_[starts, len(of)])
                    cross = -sums[usable] / n[:, None]
                    order = cross.argmin(axis=1)
                    least = cross.min(axis=1)
                    share = np.exp((least[:, None] - cross) * np.minimum(n, SURE)[:, None])
                    best[usable], score[usable], entropy[usable] = order, 1 / share.sum(axis=1), least
                columns = [pa.array(names[best].tolist(), pa.string()), pa.array(score), pa.array(entropy, from_pandas=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *columns], names=[*keep, *added])

    return rows.mapInArrow(run, schema if last else rows.schema)


def identify(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", keep: list[str] | None = None, deviations: float = 4.0, values: int = VALUES) -> DataFrame:
    """Trains on the rows where ``learn`` holds, predicts all, and calibrates the rejection.

    ``rejected`` says that a text's cross-entropy lies over ``deviations`` standard
    deviations above the mean of the learned texts of its language; ``lang_pred`` still
    names the nearest language. ``und`` is always rejected. See ``train_parts`` and
    ``predict``. Starts jobs and writes to the shared folder.
    """
    added = ["lang_pred", "score", "cross_entropy", "rejected"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    held = [F.col(c).alias(f"{MARK}k{i}") for i, c in enumerate(keep)]
    rows = docs.select(*held, F.col(lang).cast("string").alias(f"{MARK}lang"), F.coalesce(learn, F.lit(False)).alias(f"{MARK}learn"), F.col(text).alias(f"{MARK}t"))
    count, parts = train_parts(rows.filter(f"{MARK}learn"), f"{MARK}t", f"{MARK}lang", values)
    found = write_once(predict(rows, parts, count, f"{MARK}t", [c for c in rows.columns if c != f"{MARK}t"]), "predicted")
    own = found.filter((F.col(f"{MARK}lang") == F.col("lang_pred")) & F.col(f"{MARK}learn"))
    limits = own.groupBy("lang_pred").agg((F.avg("cross_entropy") + deviations * F.coalesce(F.stddev("cross_entropy"), F.lit(0.0))).alias(f"{MARK}limit"))
    found = found.join(limits, "lang_pred", "left")
    rejected = F.coalesce(F.col("cross_entropy") > F.col(f"{MARK}limit"), F.col("lang_pred") == "und")
    return found.withColumn("rejected", rejected).select(*[F.col(f"{MARK}k{i}").alias(c) for i, c in enumerate(keep)], *added)
