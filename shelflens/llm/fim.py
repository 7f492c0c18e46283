"""Fill-in-the-middle texts: parts moved by scattering bytes with displacements, restored by gathering them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType

from shelflens.llm.common import MARK, with_field

PLAIN, PSM, SPM = "plain", "psm", "spm"
# Bytes that are moved together, about: texts of a batch are taken until they hold as many.
GROUP_BYTES = 4 << 20
# Bytes whose displacements are spelled out at a time.
STEP = 1 << 20


@dataclass(frozen=True)
class FimConfig:
    """Sentinels, and of 100 texts how many are transformed and how many of these put the suffix first."""

    seed: int = 1
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    transformed: int = 90
    suffix_first: int = 20

    def __post_init__(self) -> None:
        marks = self.sentinels
        tails = {m[i:] for m in marks for i in range(1, len(m))}
        heads = {m[:i] for m in marks for i in range(1, len(m))}
        if not all(marks) or tails & heads or any(a in b for a in marks for b in marks if a is not b):
            raise ValueError("sentinels must not be empty, hold or overlap one another")

    @property
    def sentinels(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def _draw(id: Column, seed: int, at: int) -> Column:
    """The ``at``-th group of 8 hex digits of the hash of seed and id, as a number."""
    whole = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(whole, 1 + 8 * at, 8), 16, 10).cast("long")


def scan_cuts(data: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Byte places of the code points numbered ``targets`` (ascending) in UTF-8 bytes; the end where there is none."""
    places = np.full(len(targets), len(data), np.int64)
    seen = 0
    for at in range(0, len(data), STEP):
        starts = np.flatnonzero((data[at : at + STEP] & 0xC0) != 0x80)
        low, high = np.searchsorted(targets, [seen, seen + len(starts)])
        places[low:high] = at + starts[targets[low:high] - seen]
        seen += len(starts)
    return places


def displacements(begin: np.ndarray, shift: np.ndarray, size: int) -> Iterator[tuple[slice, np.ndarray]]:
    """How far each of ``size`` bytes moves, in steps: the cumulative sum of a difference array.

    Parts begin at ``begin`` (ascending; an empty part begins where the next does) and move by ``shift``.
    """
    change = np.diff(shift, prepend=0)
    carried = 0
    for at in range(0, size, STEP):
        step = min(STEP, size - at)
        low, high = np.searchsorted(begin, [at, at + step])
        difference = np.zeros(step, np.int64)
        np.add.at(difference, begin[low:high] - at, change[low:high])
        difference[0] += carried
        moved = np.cumsum(difference)
        carried = moved[-1]
        yield slice(at, at + step), moved


def _parts(starts: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Where prefix, middle and suffix of every text begin, text by text."""
    return np.stack([starts, first, second], axis=1).ravel()


def scatter(
    data: np.ndarray, ends: np.ndarray, first: np.ndarray, second: np.ndarray, forms: np.ndarray, config: FimConfig
) -> tuple[np.ndarray, np.ndarray]:
    """Transformed bytes of several texts and where each one ends.

    ``ends``: ends of the texts in ``data``; ``first``, ``second``: byte places of
    their cuts; ``forms``: 0 plain, 1 prefix first, 2 suffix first.
    """
    p, s, m = (np.frombuffer(x.encode(), np.uint8) for x in config.sentinels)
    starts = np.r_[0, ends[:-1]]
    cut = forms > 0
    a, b = np.where(cut, first, ends), np.where(cut, second, ends)
    grown = np.cumsum(np.where(cut, len(p) + len(s) + len(m), 0))
    out_ends = ends + grown
    out_starts = np.r_[0, out_ends[:-1]]
    head, tail = a - starts, ends - b
    suffix_first = forms == 2
    # Where sentinels and parts stand in the output.
    at_p = out_starts + np.where(suffix_first, len(s) + tail, 0)
    at_s = out_starts + np.where(suffix_first, 0, len(p) + head)
    at_m = out_starts + len(p) + len(s) + head + tail
    to = np.stack([np.where(cut, at_p + len(p), out_starts), np.where(cut, at_m + len(m), out_ends), np.where(cut, at_s + len(s), out_ends)], axis=1)
    begin = _parts(starts, a, b)
    out = np.empty(int(out_ends[-1]) if len(ends) else 0, np.uint8)
    for piece, shift in displacements(begin, to.ravel() - begin, len(data)):
        out[np.arange(piece.start, piece.stop) + shift] = data[piece]
    for mark, at in ((p, at_p), (s, at_s), (m, at_m)):
        out[at[cut][:, None] + np.arange(len(mark))] = mark
    return out, out_ends


def gather(data: np.ndarray, ends: np.ndarray, forms: np.ndarray, config: FimConfig) -> tuple[np.ndarray, np.ndarray]:
    """The texts that ``scatter`` was given, from its output and the forms alone."""
    p, s, m = (x.encode() for x in config.sentinels)
    starts = np.r_[0, ends[:-1]]
    cut = forms > 0
    whole = data.tobytes()
    # The second sentinel and the one before the middle; texts with sentinels of their own are plain.
    at_2 = np.array([whole.index(s if f == 1 else p, i) if f else i for i, f in zip(starts.tolist(), forms.tolist())], np.int64)
    at_m = np.array([whole.index(m, i) if f else i for i, f in zip(at_2.tolist(), forms.tolist())], np.int64)
    if (at_m + np.where(cut, len(m), 0) > ends).any():
        raise ValueError("an output lacks a sentinel of its form")
    suffix_first = forms == 2
    lead = np.where(suffix_first, len(s), len(p))
    inner = np.where(suffix_first, len(p), len(s))
    one, two = np.where(cut, at_2 - starts - lead, 0), np.where(cut, at_m - at_2 - inner, 0)
    head, tail = np.where(suffix_first, two, one), np.where(suffix_first, one, two)
    lengths = ends - starts - np.where(cut, len(p) + len(s) + len(m), 0)
    back_ends = np.cumsum(lengths)
    back_starts = back_ends - lengths
    a = np.where(cut, back_starts + head, back_ends)
    b = np.where(cut, back_ends - tail, back_ends)
    front, rear = starts + lead, at_2 + inner
    source = np.stack([np.where(cut, np.where(suffix_first, rear, front), starts), at_m + len(m), np.where(suffix_first, front, rear)], axis=1)
    begin = _parts(back_starts, a, b)
    out = np.empty(int(lengths.sum()), np.uint8)
    for piece, shift in displacements(begin, source.ravel() - begin, len(out)):
        out[piece] = data[np.arange(piece.start, piece.stop) + shift]
    return out, back_ends


def _groups(lengths: np.ndarray) -> list[np.ndarray]:
    """Rows of a batch in runs of about GROUP_BYTES; a longer text is a run of its own."""
    return np.split(np.arange(len(lengths)), np.flatnonzero(np.diff((np.cumsum(lengths) - lengths) // GROUP_BYTES)) + 1)


def _joined(column: pa.Array, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    texts = [t or b"" for t in column.slice(rows[0], len(rows)).to_pylist()]
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))


def _cut_up(data: np.ndarray, ends: np.ndarray) -> list[bytes]:
    return [data[a:b].tobytes() for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist())]


def transform(docs: DataFrame, id: str = "doc_id", text: str = "text", config: FimConfig = FimConfig(), keep: list[str] | None = None) -> DataFrame:
    """Rows of ``keep`` (default: all columns) with ``output``, ``form``, ``n``, ``prefix_chars`` and ``middle_chars``.

    A hash of the id draws two cuts among the ``n`` code points of a text, whether it
    is transformed, and which part comes first. Cuts may fall together or on an end,
    which leaves parts empty. Texts that are empty or null, or hold a sentinel, stay
    plain: their output is the text (null: empty), their part lengths are null.

    Spark draws; within a task the bytes of several texts are moved at once: a scan
    finds the byte places of the cuts, a difference array at the begins of the parts
    gives by its cumulative sum how far every byte moves. A text is held whole, with
    its output, and never split over tasks; further memory does not grow with it.
    Equal ids draw alike, so repeated rows give repeated outputs; a null id draws as
    an empty one. Columns named like the added ones are replaced. Nothing is shuffled.
    """
    added = ("output", "form", "n", "prefix_chars", "middle_chars")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    names = {c: f"{MARK}{c}" for c in ("text", "n", "form", "first", "second")}
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    n = F.length(body).cast("long")
    h1, h2, h3, h4 = (_draw(F.col(id), config.seed, i) for i in range(4))
    plain = (n == 0) | (h3 % 100 >= config.transformed)
    for mark in config.sentinels:
        plain = plain | F.contains(body, F.lit(mark))
    form = F.when(plain, 0).when(h4 % 100 < config.suffix_first, 2).otherwise(1)
    drawn = docs.select(
        *keep,
        body.cast("binary").alias(names["text"]),
        n.alias(names["n"]),
        form.cast("int").alias(names["form"]),
        F.least(h1 % (n + 1), h2 % (n + 1)).alias(names["first"]),
        F.greatest(h1 % (n + 1), h2 % (n + 1)).alias(names["second"]),
    )
    schema = with_field(
        docs.select(*keep).schema, output=BinaryType(), form=StringType(), n=LongType(), prefix_chars=LongType(), middle_chars=LongType()
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts, n, forms, first, second = batch.columns[len(keep) :]
            n, forms, first, second = (c.to_numpy() for c in (n, forms, first, second))
            for rows in _groups(pc.binary_length(texts).to_numpy().astype(np.int64)):
                data, ends = _joined(texts, rows)
                before = np.cumsum(n[rows]) - n[rows]
                targets = np.stack([before + first[rows], before + second[rows]], axis=1).ravel()
                places = scan_cuts(data, targets).reshape(-1, 2)
                out, out_ends = scatter(data, ends, places[:, 0], places[:, 1], forms[rows], config)
                cut = forms[rows] > 0
                columns = [c.slice(rows[0], len(rows)) for c in batch.columns[: len(keep)]]
                columns += [
                    pa.array(_cut_up(out, out_ends), pa.binary()),
                    pa.array(np.array([PLAIN, PSM, SPM], object)[forms[rows]], pa.string()),
                    pa.array(n[rows]),
                    pa.array(first[rows], mask=~cut),
                    pa.array((second - first)[rows], mask=~cut),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    found = drawn.mapInArrow(run, schema)
    return found.withColumn("output", F.col("output").cast("string"))


def restore(rows: DataFrame, output: str = "output", form: str = "form", config: FimConfig = FimConfig(), keep: list[str] | None = None) -> DataFrame:
    """Rows of ``keep`` (default: all columns) with ``restored``, the text rebuilt from output and form alone.

    The inverse of ``transform`` with the same sentinels: the sentinels give the parts,
    and every byte is gathered from where it went. A null output gives an empty text. A
    form of neither kind, or null, counts as plain. A column named ``restored`` is replaced.
    """
    keep = [c for c in (rows.columns if keep is None else keep) if c != "restored"]
    kind = F.when(F.col(form) == PSM, 1).when(F.col(form) == SPM, 2).otherwise(0)
    given = rows.select(*keep, F.col(output).cast("binary").alias(f"{MARK}output"), kind.cast("int").alias(f"{MARK}form"))
    schema = with_field(rows.select(*keep).schema, restored=BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts, forms = batch.columns[len(keep)], batch.columns[len(keep) + 1].to_numpy()
            lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
            for group in _groups(lengths):
                back, ends = gather(*_joined(texts, group), forms[group], config)
                columns = [c.slice(group[0], len(group)) for c in batch.columns[: len(keep)]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(_cut_up(back, ends), pa.binary())], names=schema.names)

    return given.mapInArrow(run, schema).withColumn("restored", F.col("restored").cast("string"))
