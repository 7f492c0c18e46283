"""Main text of pages: the site style tree of a host tells content from what its pages share."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from shelflens.llm.common import MARK, with_field, write_once


@dataclass(frozen=True)
class SiteConfig:
    """Settings of the style tree."""

    # Pages with different texts that a node needs for a verdict; below, it is content.
    min_pages: int = 8
    # Least importance of content.
    importance: float = 0.2
    # How much of a node's importance is left to its content for each presentation style it has.
    decay: float = 0.9


# Fixed sets of element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
NOISE = frozenset("nav header footer aside form button select option menu dialog head label input".split()) | RAW
# Words in class, id or role that mark menus, notices, adverts and comments.
NOISE_NAMES = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies disqus footer"
    " header masthead menu modal nav navbar navigation newsletter notice notices notification overlay pagination popup promo promoted related"
    " replies reply search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
# Words that say nothing beside one of these: a name of such words only is one of them too.
NEUTRAL_NAMES = frozenset("area bar block bottom box container content global inner item left links list main outer page panel primary right secondary section site slot top wrap wrapper".split())
COMMENT_NAMES = frozenset("comment comments replies reply disqus".split())
# Elements that hold markup; without an end tag they hold nothing.
MARKUP = frozenset("svg math template object noscript".split())
# An open element of the first kind ends where one of the second starts.
CLOSED_BY = {
    "p": BLOCKS,
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "head": frozenset(["body"]),
}
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
NAME_PART = re.compile(r"[a-z0-9]+")
SPACE = re.compile(r"\s+")


def _names(attributes: str) -> list[list[str]]:
    """The words of each name in class, id and role."""
    if "=" not in attributes:
        return []
    values = [a or b or c for name, a, b, c in ATTRIBUTE.findall(attributes) if name.lower() in ("class", "id", "role")]
    return [NAME_PART.findall(name) for value in values for name in value.lower().split()]


def _marks(names: list[list[str]], words: frozenset[str]) -> bool:
    """Whether a name consists of ``words``, neutral ones aside."""
    return any(not words.isdisjoint(name) and all(part in words or part in NEUTRAL_NAMES for part in name) for name in names)


class Page:
    """Blocks of a page: path of the element, inline styles within it, and text, in page order."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, str, str]] = []
        self.has_article = False
        self._stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]  # name, path, is noise, in article
        self._text: list[str] = []
        self._styles: list[str] = []
        self._home = self._stack[0]
        self._read(source)

    def _block(self) -> tuple[str, str, bool, bool]:
        """The innermost open block: text belongs to it, whatever inline elements are open or were."""
        return next((e for e in reversed(self._stack) if e[0] in BLOCKS), self._stack[0])

    def _flush(self) -> None:
        text = SPACE.sub(" ", "".join(self._text)).strip()
        if text and not self._home[2]:
            self.blocks.append((self._home[1], " ".join(self._styles), text) if not self._home[3] else (self._home[1], " ".join(self._styles), "\x00" + text))
        self._text, self._styles, self._home = [], [], self._block()

    def _write(self, raw: str) -> None:
        if raw and not self._stack[-1][2]:
            self._text.append(html.unescape(raw) if "&" in raw else raw)

    def _open(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self._flush()
        for depth in range(len(self._stack) - 1, 0, -1):
            above = self._stack[depth][0]
            if name in CLOSED_BY.get(above, ()):
                del self._stack[depth:]
                break
            if above in BLOCKS:
                break
        names = _names(attributes)
        _, path, noise, article = self._stack[-1]
        if name in BLOCKS:
            last = ".".join([name, *sorted({part for one in names for part in one})])
            # Runs of equal elements are one node; nesting of the same element too.
            path = path if path.rpartition(">")[2] == last else f"{path}>{last}" if path else last
        elif name == "br":
            self._text.append(" ")
            self._styles = [*self._styles, "br"] if self._styles[-1:] != ["br"] else self._styles
        elif self._styles[-1:] != [name]:
            self._styles.append(name)
        if name in VOID:
            if name == "hr":
                self._home = self._block()
            return
        # An article's own header holds its title; an article in an article may be a comment, as may be one that says so.
        exempt = name in ("main", "body", "html") or name == "article" and not article
        marked = _marks(names, COMMENT_NAMES if exempt and name == "article" else NOISE_NAMES) and (not exempt or name == "article")
        bad = name in NOISE and not (name == "header" and article) or marked
        article = article or name in ("article", "main")
        self._stack.append((name, path, noise or bad, article))
        self.has_article = self.has_article or article and not (noise or bad)
        if name in BLOCKS:
            self._home = self._stack[-1]

    def _close(self, name: str) -> None:
        for depth in range(len(self._stack) - 1, 0, -1):
            if self._stack[depth][0] == name:
                if any(n in BLOCKS for n, *_ in self._stack[depth:]):
                    self._flush()
                del self._stack[depth:]
                self._home = self._block()
                return

    def _read(self, source: str) -> None:
        at = 0
        while at < len(source):
            start = source.find("<", at)
            if start < 0:
                break
            found = TOKEN.match(source, start)
            if not found:  # a lone angle bracket is text
                self._write(source[at : start + 1])
                at = start + 1
                continue
            self._write(source[at:start])
            at, name = found.end(), found[2]
            if name is None:
                continue
            name = name.lower()
            if found[1]:
                self._close(name)
                continue
            self._open(name, found[3])
            if name in RAW:  # its text ends at its own end tag only
                end = None if name in ("svg", "math") and found[3].endswith("/") else re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else at if name in MARKUP else len(source)
                if self._stack[-1][0] == name:
                    self._stack.pop()
        self._write(source[at:])
        self._flush()


def page_blocks(source: str | None) -> list[tuple[str, str, str]]:
    """Blocks that may be main text: those of the articles if a page has one, without menus, forms and the like."""
    if not source:
        return []
    page = Page(source)
    inside = [(p, s, t[1:]) for p, s, t in page.blocks if t[0] == "\x00"]
    return inside if page.has_article else [(p, s, t.lstrip("\x00")) for p, s, t in page.blocks]


BLOCK = ArrayType(
    StructType([StructField("path", LongType()), StructField("style", LongType()), StructField("mark", LongType()), StructField("text", StringType())])
)


def parse(pages: DataFrame, source: str, keep: list[str], blocks: str) -> DataFrame:
    """Adds the blocks of a page: hashes of path, style and text, and the text."""
    kind = pa.list_(pa.struct([("path", pa.int64()), ("style", pa.int64()), ("mark", pa.int64()), ("text", pa.string())]))

    def mark(text: str) -> int:
        return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"path": mark(p), "style": mark(s), "mark": mark(t), "text": t} for p, s, t in page_blocks(one)]
                for one in batch.column(len(keep)).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(found, kind)], names=[*keep, blocks])

    return pages.select(*keep, source).mapInArrow(run, with_field(pages.select(*keep).schema, **{blocks: BLOCK}))


def noisy_nodes(blocks: DataFrame, config: SiteConfig) -> DataFrame:
    """Nodes (``host``, ``path``) of the merged tree of each host that are less important than content.

    ``blocks``: rows host, page (hash of the page's text), path, style, mark, one per
    block. Pages with the same text count once. Presentation: the entropy of a node's
    styles over its pages; content: one minus the entropy with which a text is spread
    over the node's pages, averaged over its blocks; both to the base of the number of
    pages. With l styles: (1 - decay**l) * presentation + decay**l * content.
    """
    once = blocks.groupBy("host", "path", "style", "mark", "page").agg(F.lit(1).alias("one"))
    texts = once.groupBy("host", "path", "mark").agg(F.count_distinct("page").alias("k"))
    pages = once.select("host", "path", "page").distinct().groupBy("host", "path").agg(F.count("*").alias("m"))
    styles = once.select("host", "path", "style", "page").distinct().groupBy("host", "path", "style").agg(F.count("*").alias("n"))
    styles = styles.groupBy("host", "path").agg(F.count("*").alias("l"), F.sum("n").alias("all"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    spread = texts.groupBy("host", "path").agg(F.sum(F.col("k") * F.log("k")).alias("klogk"), F.sum("k").alias("blocks"))
    node = pages.filter(F.col("m") >= config.min_pages).join(styles, ["host", "path"]).join(spread, ["host", "path"])
    base = F.log("m")
    presentation = (F.log("all") - F.col("nlogn") / F.col("all")) / base
    content = 1 - F.col("klogk") / F.col("blocks") / base
    rest = F.pow(F.lit(config.decay), F.col("l"))
    return node.filter((1 - rest) * presentation + rest * content < config.importance).select("host", "path")


def main_text(pages: DataFrame, config: SiteConfig = SiteConfig(), url: str = "url", source: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Rows of ``keep`` (default: all columns) with ``text``: the blocks of the main text, joined by two newlines.

    Elements and class names that stand for menus, headers, footers, notices, adverts,
    forms, scripts and comments are left out, and a page with articles is reduced to
    them. The rest of the pages of a host are merged into a style tree; blocks in its
    low-importance nodes are left out of every page, unless that would leave a page
    empty. Null and empty sources give an empty text; pages with a null or odd address
    form a host of their own. Repeated pages count once in the tree. An empty table
    gives an empty result; a column named ``text`` is replaced. Pages are not shuffled,
    only counts and the few noisy nodes. Starts jobs and writes to the shared folder.
    """
    keep = [c for c in (pages.columns if keep is None else keep) if c != "text"]
    held = [f"{MARK}k{i}" for i in range(len(keep))]
    host, blocks = f"{MARK}host", f"{MARK}blocks"
    named = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))
    rows = pages.select(*[F.col(c).alias(h) for c, h in zip(keep, held)], named.alias(host), F.col(source).alias(f"{MARK}html"))
    rows = write_once(parse(rows, f"{MARK}html", [*held, host], blocks), "blocks")
    page = F.xxhash64(F.transform(blocks, lambda b: b["mark"]))
    each = rows.select(F.col(host).alias("host"), page.alias("page"), F.explode(blocks).alias("b"))
    nodes = noisy_nodes(each.select("host", "page", "b.path", "b.style", "b.mark"), config)
    lists = write_once(nodes.groupBy("host").agg(F.collect_list("path").alias(f"{MARK}noise")), "noise")
    rows = rows.join(lists.withColumnRenamed("host", host), host, "left")
    noise = F.coalesce(F.col(f"{MARK}noise"), F.array().cast("array<bigint>"))
    left = F.filter(blocks, lambda b: ~F.array_contains(noise, b["path"]))
    left = F.when(F.size(left) > 0, left).otherwise(F.col(blocks))
    text = F.array_join(F.transform(left, lambda b: b["text"]), "\n\n")
    return rows.select(*[F.col(h).alias(c) for c, h in zip(keep, held)], text.alias("text"))
