"""Quality rules: base statistics of a text, and robust multivariate outliers per language and source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelflens.llm.common import MARK, words, write_once

SYMBOLS = "#*$%&|<>"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class QualityConfig:
    """Settings of the outlier rule."""

    min_words: int = 50
    max_repeat_share: float = 0.5
    # Rows a group of language and source needs for an estimate of its own; below, the language's is used, then that of all.
    min_rows: int = 200
    # Share of a group's rows that the covariance is fitted to, and how often that share is chosen anew.
    support: float = 0.75
    steps: int = 3
    # Squared distance up to which rows count in the final estimate, and beyond which a row is rejected.
    reweight: float = 14.45  # 97.5 % point of chi squared, 6 degrees of freedom
    cutoff: float = 45.0
    # Least spread of each transformed statistic: smaller differences than this are no evidence.
    floors: tuple[float, ...] = (0.8, 0.08, 0.08, 0.15, 0.08, 0.08)


# For a fit to the inner 75 % in 6 dimensions: support / P(chi squared, 8 degrees <= 75 % point of 6 degrees).
CONSISTENCY = 1.44


def text_stats(text: Column) -> dict[str, Column]:
    """Statistics that need the text alone, and the arrays that ``repeat_words`` goes on from."""
    full = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(full, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    return {
        f"{MARK}words": words(text),
        f"{MARK}lines": lines,
        f"{MARK}marks": F.regexp_replace(full, rf"[^\p{{Lu}}{SYMBOLS}]++", ""),
    }


def base_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the base statistics. A word is repeated if a window of 3 words around it occurs twice or more.

    Windows are compared by 64-bit hashes. They are sorted within the row, so that the
    work is n log n in the words of a text and nothing is shuffled.
    """
    df = docs.withColumns(text_stats(F.col(text)))
    w, lines, marks, windows, places = (f"{MARK}{x}" for x in ("words", "lines", "marks", "windows", "places"))
    df = df.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "n_symbols": F.length(F.regexp_replace(marks, r"\p{Lu}+", "")).cast("long"),
            f"{MARK}upper": F.length(F.regexp_replace(marks, r"\P{Lu}+", "")),
            "word_chars": F.length(F.array_join(w, "")).cast("long"),
            f"{MARK}n_lines": F.size(lines).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            windows: F.when(
                F.size(w) >= 3,
                F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
            ).otherwise(F.array().cast("array<bigint>")),
        }
    )
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    df = df.withColumn(
        places,
        F.when(repeats, F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )
    twice = F.filter(
        places,
        lambda p, i: F.coalesce(p["h"] == F.get(places, i - 1)["h"], F.lit(False)) | F.coalesce(p["h"] == F.get(places, i + 1)["h"], F.lit(False)),
    )
    df = df.withColumn(places, F.sort_array(F.transform(twice, lambda p: p["i"])))
    reach = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
    covered = F.aggregate(reach, F.lit(0), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop(w, lines, marks, windows, places)


def _vector() -> list[Column]:
    """Transformed statistics: comparable spread, no unbounded influence of length."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log1p("n_words"),
        F.log1p(F.col("word_chars") / n),
        F.sqrt(F.least(F.col("n_symbols") / n, F.lit(4.0))),
        F.sqrt(F.col("n_dup_lines") / F.greatest(F.col(f"{MARK}n_lines"), F.lit(1))),
        F.col("n_repeat_words") / n,
        F.sqrt(F.col(f"{MARK}upper") / F.greatest(F.col("word_chars"), F.lit(1))),
    ]


def _at_share(counts: DataFrame, keys: list[str], share: float, name: str) -> DataFrame:
    """The first bucket that reaches a share of each key's rows; ``counts`` has few rows per key."""
    whole = Window.partitionBy(*keys)
    so_far = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumns({"c": F.sum("n").over(so_far), "total": F.sum("n").over(whole)})
    return ranked.filter(F.col("c") >= share * F.col("total")).groupBy(*keys).agg(F.min("bucket").alias(name))


def _centre(rows: DataFrame, config: QualityConfig) -> DataFrame:
    """Per group: arrays of medians and of robust spreads, from histograms."""
    dims = range(len(config.floors))
    width = F.array(*[F.lit(f / 32) for f in config.floors])

    def medians(value) -> DataFrame:
        cells = rows.select("g", F.posexplode(F.array(*[value(i) for i in dims])).alias("dim", "v"))
        cells = cells.select("g", "dim", F.floor(F.col("v") / F.get(width, F.col("dim"))).alias("bucket"))
        counts = cells.groupBy("g", "dim", "bucket").agg(F.count("*").alias("n"))
        mid = _at_share(counts, ["g", "dim"], 0.5, "bucket")
        mid = mid.select("g", "dim", ((F.col("bucket") + 0.5) * F.get(width, F.col("dim"))).alias("m"))
        pairs = mid.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("dim", "m"))).alias("a"))
        return pairs.select("g", F.transform("a", lambda p: p["m"]).alias("m"))

    centre = write_once(medians(lambda i: F.col(f"x{i}")), "centre")
    rows = rows.join(centre, "g")
    spread = medians(lambda i: F.abs(F.col(f"x{i}") - F.get("m", F.lit(i)))).withColumnRenamed("m", "s")
    spread = spread.select("g", F.transform("s", lambda v, i: F.greatest(v * 1.4826, F.get(F.array(*map(F.lit, config.floors)), i))).alias("s"))
    joined = centre.join(spread, "g")
    whiten = {f"w{i}_{j}": 1 / F.get("s", F.lit(i)) if i == j else F.lit(0.0) for i in dims for j in range(i + 1)}
    return joined.select("g", *[F.get("m", F.lit(i)).alias(f"m{i}") for i in dims], *[c.alias(n) for n, c in whiten.items()])


def _distance(dims: range) -> Column:
    """Squared Mahalanobis distance: the whitened difference, squared."""
    total = F.lit(0.0)
    for i in dims:
        y = F.lit(0.0)
        for j in range(i + 1):
            y = y + F.col(f"w{i}_{j}") * (F.col(f"x{j}") - F.col(f"m{j}"))
        total = total + F.pow(y, F.lit(2.0))
    return total


def _fit(rows: DataFrame, config: QualityConfig, factor: float) -> DataFrame:
    """Per group: mean and inverse Cholesky factor of the covariance of the given rows, floors added."""
    dims = range(len(config.floors))
    moments = [F.avg(f"x{i}").alias(f"m{i}") for i in dims]
    moments += [F.covar_pop(f"x{i}", f"x{j}").alias(f"s{i}_{j}") for i in dims for j in range(i + 1)]
    fit = rows.groupBy("g").agg(*moments)
    fit = fit.withColumns(
        {f"s{i}_{j}": F.col(f"s{i}_{j}") * factor + (config.floors[i] ** 2 if i == j else 0.0) for i in dims for j in range(i + 1)}
    )
    fit = write_once(fit, "moments")
    for j in dims:  # the Cholesky factor, column by column
        inner = sum((F.pow(F.col(f"l{j}_{k}"), F.lit(2.0)) for k in range(j)), F.lit(0.0))
        fit = fit.withColumn(f"l{j}_{j}", F.sqrt(F.col(f"s{j}_{j}") - inner))
        below = {}
        for i in range(j + 1, len(config.floors)):
            inner = sum((F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0))
            below[f"l{i}_{j}"] = (F.col(f"s{i}_{j}") - inner) / F.col(f"l{j}_{j}")
        fit = fit.withColumns(below) if below else fit
    for i in dims:  # its inverse, row by row
        row = {}
        for j in range(i):
            inner = sum((F.col(f"l{i}_{k}") * F.col(f"w{k}_{j}") for k in range(j, i)), F.lit(0.0))
            row[f"w{i}_{j}"] = -inner / F.col(f"l{i}_{i}")
        fit = fit.withColumns({**row, f"w{i}_{i}": 1 / F.col(f"l{i}_{i}")})
    return write_once(fit.select("g", *[f"m{i}" for i in dims], *[f"w{i}_{j}" for i in dims for j in range(i + 1)]), "fit")


def _groups(rows: DataFrame, config: QualityConfig, lang: str, source: str) -> tuple[DataFrame, DataFrame]:
    """Per language and source, the group it is estimated with, and all groups that its rows are part of."""
    pair = rows.groupBy(lang, source).agg(F.count("*").alias("n"))
    by_lang = Window.partitionBy(lang)
    pair = pair.withColumn("n_lang", F.sum("n").over(by_lang))
    key = lambda level, *cols: F.xxhash64(F.lit(level), *[x for c in cols for x in (F.coalesce(F.col(c).cast("string"), F.lit("")), F.col(c).isNull())])
    levels = [key(2, lang, source), key(1, lang), F.lit(0).cast("long")]
    group = F.when(F.col("n") >= config.min_rows, levels[0]).when(F.col("n_lang") >= config.min_rows, levels[1]).otherwise(levels[2])
    named = [F.col(lang).alias("gl"), F.col(source).alias("gs")]
    pair = write_once(pair.select(*named, group.alias("g"), F.array(*[x.alias("g") for x in levels]).alias("levels")), "groups")
    every = pair.select("gl", "gs", F.explode("levels").alias("g")).join(pair.select("g").distinct(), "g", "left_semi")
    return pair.drop("levels"), write_once(every, "members")


def quality(docs: DataFrame, config: QualityConfig = QualityConfig(), text: str = "text", lang: str = "lang", source: str = "source", keep: list[str] | None = None) -> DataFrame:
    """Rows of ``keep`` (default: all columns) with the base statistics, ``base_failed``, ``distance`` and ``kept``.

    A minimum covariance determinant estimate is made for each language and source
    from the rows that pass the base rules: start from medians, fit mean and
    covariance to the 75 % of rows nearest by Mahalanobis distance, choose anew,
    and refit to all rows within the 97.5 % ellipse. A row beyond ``cutoff`` is
    rejected. Groups of few rows use the estimate of all rows of their language, or
    of all rows if these are few as well.

    Null and empty texts have no words and fail the base rules; their distance is
    null. Null languages and sources are groups like others. Repeated rows count
    as often as they occur. An empty table gives an empty result. Columns named
    like the added ones are replaced. Starts jobs and writes to the shared folder.
    """
    added = [*STATS, "base_failed", "distance", "kept"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    held = [F.col(c).alias(f"{MARK}k{i}") for i, c in enumerate(keep)]
    short = docs.select(*held, F.col(text).alias(f"{MARK}text"), F.col(lang).alias("gl"), F.col(source).alias("gs"))
    rows = base_stats(short, f"{MARK}text").drop(f"{MARK}text")
    failed = (F.col("n_words") < config.min_words) | (F.col("n_repeat_words") > config.max_repeat_share * F.col("n_words"))
    rows = rows.withColumns({"base_failed": failed, **{f"x{i}": x for i, x in enumerate(_vector())}})
    rows = write_once(rows, "stats")
    passed = rows.filter(~F.col("base_failed"))
    groups, every = _groups(passed, config, "gl", "gs")
    same = lambda a, b: a["gl"].eqNullSafe(b["gl"]) & a["gs"].eqNullSafe(b["gs"])
    dims = range(len(config.floors))
    named = passed.join(every, same(passed, every)).select(every["g"], *[f"x{i}" for i in dims])
    fit = _centre(named, config)
    for _ in range(config.steps):
        near = named.join(fit, "g").select("g", *[f"x{i}" for i in dims], _distance(dims).alias("d"))
        near = near.withColumn("bucket", F.ceil(F.log1p("d") * 64))
        edge = _at_share(near.groupBy("g", "bucket").agg(F.count("*").alias("n")), ["g"], config.support, "edge")
        fit = _fit(near.join(edge, "g").filter("bucket <= edge"), config, CONSISTENCY)
    near = named.join(fit, "g").filter(_distance(dims) <= config.reweight).select("g", *[f"x{i}" for i in dims])
    fit = _fit(near, config, 1.0)
    fit = groups.join(fit, "g").drop("g")
    out = rows.join(fit, same(rows, fit), "left").withColumn("distance", F.when(~F.col("base_failed"), _distance(dims)))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= config.cutoff, F.lit(True))
    return out.withColumn("kept", kept).select(*[F.col(f"{MARK}k{i}").alias(c) for i, c in enumerate(keep)], *added)
