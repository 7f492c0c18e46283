"""Personal data: patterns, and terms that reveal protected values by their co-occurrence."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, ArrayType, IntegerType

from shelflens.llm.common import MARK, WORD_BREAK, with_field, write_once

KINDS = ("email", "ip", "card", "phone")
TERM = "term"

Span = tuple[int, int, str]


@dataclass(frozen=True)
class PiiConfig:
    """Settings of the disclosure rule."""

    # Words on either side of a protected value that count as its context.
    window: int = 8
    # Different contexts in which a term must stand beside the value.
    min_contexts: int = 3
    # A term discloses a value if it leaves at most so many bits of the value's information:
    # -log2 p(value | term) <= max_residual, that is, mutual information >= information - max_residual.
    max_residual: float = 1.0
    # Disclosing terms that are broadcast; beyond, texts are joined with them.
    broadcast_terms: int = 200_000


# Fixed patterns. A start inside a run of digits can't match where the run's start doesn't, so it isn't tried.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
WORD = re.compile(WORD_BREAK.replace("[", "[^", 1))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    start, at = 0, text.find("@")
    while at >= 0:
        head = text[start:at]
        begin = start + len(head.rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            yield begin, found.end(), "email"
        start = found.end() if found else at + 1
        at = text.find("@", max(start, at + 1))


def base_spans(text: str | None) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, by start, then by the order of kinds."""
    if not text:
        return []
    spans = list(_emails(text)) if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            # Values are compared by length first: a number of many digits isn't read.
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.groups()):
                spans.append((*m.span(), "ip"))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "") if len(m[0]) < 64 else ""
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((*m.span(), "card"))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                    spans.append((*m.span(), "phone"))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def plain_term(word: str) -> str:
    """A word without punctuation at its ends, in lower case."""
    return word.strip(".,;:!?\"'()[]{}<>|*#$%&").lower()


def contexts(text: str | None, window: int) -> Iterator[tuple[str, list[str]]]:
    """Each protected value of a text with the terms of the words around it, values themselves left out."""
    spans = base_spans(text)
    if not spans:
        return
    words = [(m.start(), m.end()) for m in WORD.finditer(text)]
    taken = set()
    starts = [a for a, _ in words]
    reach = []
    for start, end, _ in spans:
        first, last = bisect_right(starts, start) - 1, bisect_right(starts, end - 1) - 1
        reach.append((first, last))
        taken.update(range(max(first, 0), last + 1))
    for (start, end, kind), (first, last) in zip(spans, reach):
        near = [i for i in (*range(max(0, first - window), first), *range(last + 1, min(len(words), last + 1 + window))) if i not in taken]
        yield f"{kind}:{text[start:end].lower()}", [t for i in near if (t := plain_term(text[slice(*words[i])]))]


def cooccurrence(docs: DataFrame, config: PiiConfig, text: str) -> DataFrame:
    """Rows ``value``, ``term``, ``document``, ``context`` (hashes), one per document, value and term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, one in enumerate(batch.column(0).to_pylist()):
                for value, terms in contexts(one, config.window):
                    context = " ".join(terms)
                    rows += [(k, value, term, context) for term in set(terms)] or [(k, value, "", "")]
            columns = list(zip(*rows)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(columns[0], pa.int64())), *(pa.array(c, pa.string()) for c in columns[1:])], names=["document", "value", "term", "context"])

    found = docs.select(text, F.monotonically_increasing_id()).mapInArrow(run, "document long, value string, term string, context string")
    return found.withColumn("context", F.xxhash64("context"))


def _words_with(docs: DataFrame, terms: DataFrame, text: str) -> DataFrame:
    """Distinct (text hash, term) of all texts that hold one of the terms: the way for any number of terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shas, found = [], []
            for one in batch.column(0).to_pylist():
                mine = all_terms(one)
                shas += [hashlib.sha256(one.encode()).hexdigest()] * len(mine)
                found += mine
                if len(found) >= 1 << 16:
                    yield pa.RecordBatch.from_arrays([pa.array(shas, pa.string()), pa.array(found, pa.string())], names=["sha", "term"])
                    shas, found = [], []
            yield pa.RecordBatch.from_arrays([pa.array(shas, pa.string()), pa.array(found, pa.string())], names=["sha", "term"])

    rows = docs.filter(F.col(text).isNotNull()).select(text).mapInArrow(run, "sha string, term string")
    return rows.join(terms, "term", "left_semi").distinct()


def disclosing_terms(docs: DataFrame, config: PiiConfig = PiiConfig(), text: str = "text") -> DataFrame:
    """Terms that disclose a protected value, as ``term``, ``value``, ``residual`` (bits).

    Information of a value is -log2 of the share of documents that hold it; what a term
    tells of it is their pointwise mutual information. The residual, their difference,
    is -log2 of the share of the term's documents in which it stands beside the value.
    Counts cover all documents. Only terms seen beside one value in ``min_contexts``
    different contexts are candidates, so that a rare word met once isn't one.
    """
    pairs = write_once(cooccurrence(docs, config, text), "cooccurrence").filter("term <> ''")
    pairs = pairs.groupBy("value", "term").agg(F.count_distinct("document").alias("both"), F.count_distinct("context").alias("contexts"))
    pairs = write_once(pairs.filter(F.col("contexts") >= config.min_contexts), "candidates")
    totals = _document_counts(docs, pairs.select("term").distinct(), config, text)
    residual = -F.log2(F.least(F.col("both") / F.col("documents"), F.lit(1.0)))
    pairs = pairs.join(totals, "term").withColumn("residual", residual)
    return pairs.filter(F.col("residual") <= config.max_residual).select("term", "value", "residual")


def _document_counts(docs: DataFrame, terms: DataFrame, config: PiiConfig, text: str) -> DataFrame:
    """In how many documents each term occurs."""
    terms = write_once(terms, "terms")
    if terms.count() > config.broadcast_terms:
        rows = docs.filter(F.col(text).isNotNull()).groupBy(F.sha2(F.col(text).cast("binary"), 256).alias("sha")).agg(F.count("*").alias("n"))
        return _words_with(docs.filter(F.col(text).isNotNull()), terms, text).join(rows, "sha").groupBy("term").agg(F.sum("n").alias("documents"))
    shared = docs.sparkSession.sparkContext.broadcast({r.term for r in terms.toLocalIterator()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, counts = shared.value, {}
        for batch in batches:
            for one in batch.column(0).to_pylist() if wanted else ():
                for term in terms_of(one, wanted):
                    counts[term] = counts.get(term, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    return docs.select(text).mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("documents"))


def all_terms(text: str | None) -> set[str]:
    words = {w.decode() for w in set(text.encode().split())} if text else set()
    return {plain_term(w) for w in words}


def terms_of(text: str | None, wanted: set[str]) -> set[str]:
    return all_terms(text) & wanted


def _term_spans(text: str, wanted: set[str], spans: list[Span]) -> list[Span]:
    """Words whose term is wanted, unless they touch a protected value."""
    if terms_of(text, wanted).isdisjoint(wanted):
        return []
    blocked, out, k = sorted((a, b) for a, b, _ in spans), [], 0
    for m in WORD.finditer(text):
        while k < len(blocked) and blocked[k][1] <= m.start():
            k += 1
        if plain_term(m[0]) in wanted and not any(a < m.end() for a, _ in blocked[k : k + 1]):
            out.append((*m.span(), TERM))
    return out


def generalised(term: str) -> str:
    """What stands for a disclosing term: its shape if it has digits, else nothing is left of it."""
    return re.sub("[0-9]", "#", term) if DIGIT.search(term) else "[term]"


def sanitised(text: str, spans: list[Span]) -> str:
    """The text with protected values replaced by their kind, and disclosing terms generalised or removed."""
    out, at = [], 0
    for start, end, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if end <= at:
            continue
        out.append(text[at : max(start, at)])
        out.append(generalised(text[start:end]) if kind == TERM else f"[{kind}]")
        at = end
    return "".join([*out, text[at:]])


SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())]))


def sanitise(docs: DataFrame, config: PiiConfig = PiiConfig(), text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Rows of ``keep`` (default: all columns) with ``spans`` and ``clean_text``.

    ``spans`` are kind, start and end (code points, end exclusive), by start, then email,
    ip, card, phone, term. ``clean_text`` has values replaced by their kind in brackets;
    disclosing terms with digits are generalised to their shape, others become
    ``[term]``. Null texts have no spans and stay null, empty ones stay empty. Repeated
    rows count as often as they occur, but equal contexts once. An empty table gives an
    empty result; columns named like the added ones are replaced. Starts jobs and writes
    to the shared folder; texts are shuffled only if there are more disclosing terms
    than ``broadcast_terms``.
    """
    added = ["spans", "clean_text"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    held = [F.col(c).alias(f"{MARK}k{i}") for i, c in enumerate(keep)]
    names, body, own = [f"{MARK}k{i}" for i in range(len(keep))], f"{MARK}t", f"{MARK}terms"
    rows = docs.select(*held, F.col(text).alias(body))
    terms = write_once(disclosing_terms(rows, config, body).select("term").distinct(), "disclosing")
    if terms.count() <= config.broadcast_terms:
        shared = docs.sparkSession.sparkContext.broadcast({r.term for r in terms.toLocalIterator()})
        rows = rows.withColumn(own, F.lit(None).cast("array<string>"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(set())
        texts = rows.filter(F.col(body).isNotNull())
        lists = _words_with(texts, terms, body).groupBy("sha").agg(F.collect_list("term").alias(own))
        rows = rows.withColumn("sha", F.sha2(F.col(body).cast("binary"), 256)).join(lists, "sha", "left").select(*names, body, own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, clean = [], []
            for one, terms in zip(batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist()):
                found = base_spans(one)
                wanted = set(terms) if terms else shared.value
                if one and wanted:
                    order = (*KINDS, TERM)
                    found = sorted(found + _term_spans(one, wanted, found), key=lambda s: (s[0], order.index(s[2])))
                spans.append([{"kind": kind, "start": a, "end": b} for a, b, kind in found])
                clean.append(sanitised(one, found) if one else one)
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(spans, kind), pa.array(clean, pa.string())], names=[*names, *added])

    schema = with_field(rows.select(*names).schema, spans=SPANS, clean_text=StringType())
    out = rows.select(*names, body, own).mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], *added)
