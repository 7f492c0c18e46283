"""Operators against brute force, round trips, held-out accuracy and awkward rows."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
import tiktoken
import xxhash
from pyspark.sql import functions as F

from shelflens.llm import bpe, hnsw, langid, licenses, mixing, pii, quality, sharding, simhash, sitetree

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


# Awkward rows


def sized(df):
    return df.withColumn("size", F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 1)


OPERATORS = {
    "pii": lambda d, r: pii.sanitise(d),
    "quality": lambda d, r: quality.quality(d),
    "licenses": lambda d, r: licenses.scan(d),
    "bpe": lambda d, r: bpe.decode(bpe.encode(d, r, public_tokenizers.PATTERN), r),
    "simhash": lambda d, r: simhash.near_duplicates(d),
    "mixing": lambda d, r: mixing.mix(d),
    "sharding": lambda d, r: sharding.shuffle_shards(sized(d)),
    "langid": lambda d, r: langid.identify(d, F.col("doc_id") != 5),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_awkward_rows(odd, empty, ranks, name):
    found = OPERATORS[name](odd, ranks)
    assert len(set(found.columns)) == len(found.columns) and {"doc_id", "text", "n_chars"} <= set(found.columns)
    key = lambda df: Counter(map(str, df.select("doc_id", "text", "lang", "source").collect()))
    assert key(found) == key(odd)
    none = OPERATORS[name](empty, ranks)
    assert none.count() == 0 and none.columns == found.columns


# Patterns


def slow_spans(text):
    """The contract read literally, one regular expression per kind."""
    text = text or ""
    out = [(*m.span(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((*m.span(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        double = [sum(divmod(2 * x, 10)) for x in d[-2::-2]]
        if 14 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(double)) % 10 == 0:
            out.append((*m.span(), "card"))
    out += [(*m.span(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_spans():
    rng = np.random.default_rng(3)
    parts = ["a", "b.c", "@", ".", "-", "1", "255", "256", "+1", " ", "(", ")", "4111 1111 1111 1111", "10.0.0.1", "x@y.z", "00", "é"]
    for _ in range(3000):
        text = "".join(rng.choice(parts, rng.integers(1, 14)))
        assert pii.base_spans(text) == slow_spans(text), text
    assert pii.base_spans(None) == [] and pii.base_spans("1" * 300_000) == []


def test_disclosing_terms(spark):
    texts = [f"w{i} Project Zebra7 run by ann@corp.com since {i}x" for i in range(6)] + [f"plain project text {i}" for i in range(30)]
    texts += ["reach other@corp.com quickly"] + ["zebra7 alone"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    terms = {r.term for r in pii.disclosing_terms(df).collect()}
    assert {"zebra7", "run", "by", "since"} == terms  # "project" is too common, "quickly" has one context
    for config in (pii.PiiConfig(), pii.PiiConfig(broadcast_terms=0)):
        found = by_id(pii.sanitise(df, config))
        assert found[0].clean_text == "w0 Project Zebra# [term] [term] [email] [term] 0x"
        assert found[37].clean_text == "zebra# alone" and found[10].clean_text == texts[10]


def test_terms_are_the_same_however_many_there_are(spark):
    texts = [f"w{i} project İdil,\u2028 run ann@corp.com" for i in range(6)] + ["İDIL run", "idil,", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    few, many = (by_id(pii.sanitise(df, config)) for config in (pii.PiiConfig(), pii.PiiConfig(broadcast_terms=0)))
    assert {i: (r.spans, r.clean_text) for i, r in few.items()} == {i: (r.spans, r.clean_text) for i, r in many.items()}
    assert any(s.kind == "term" for s in few[0].spans)


# Pages


def test_page_blocks():
    page = """<html><head><title>T</title></head><body><nav><ul><li>Home</ul></nav><div class="cookie-notice">ok</div>
    <article><h1>Head &amp; line</h1><p>One<br>two <b>three<p>Four  \n five &lt;x&gt;<script>var a="</p>";</script><aside>no</aside>
    <section id="comments"><p>me too</p></section></article><footer>f</footer></body>"""
    assert [t for _, _, t in sitetree.page_blocks(page)] == ["Head & line", "One two three", "Four five <x>"]
    assert sitetree.page_blocks(None) == sitetree.page_blocks("") == []
    assert [t for _, _, t in sitetree.page_blocks("a < b <p>c")] == ["a < b", "c"]


@pytest.mark.parametrize(
    "page, want",
    [
        ("<div><button><div>x</div></button>Main text here</div>", ["Main text here"]),
        ('<div><a class="share"><div>x</div></a>Main text here</div>', ["Main text here"]),
        ("<aside><article>teaser</article></aside><div><p>Main body text</p></div>", ["Main body text"]),
        ("<div><p>One</p><svg/><p>Two</p></div>", ["One", "Two"]),
        ("<div><p>One</p><template><p>Two</p></div>", ["One", "Two"]),
        ("<div><p>One</p><svg><text>x</text></svg><p>Two</p></div>", ["One", "Two"]),
        ('<div data-role="ad"><p>Main</p></div>', ["Main"]),
        ('<div title="class=ad"><p>Main</p></div>', ["Main"]),
        ('<article><div class="post-header"><h1>Title</h1></div><p>Text</p></article>', ["Title", "Text"]),
        ('<div class="search-result"><p>Found</p></div>', ["Found"]),
        ('<article><section class="related-work"><p>Others</p></section></article>', ["Others"]),
        ('<article><p>Text</p><article class="comment">reader says</article></article>', ["Text"]),
        ('<article><p>Text</p></article><article class="comment">reader says</article>', ["Text"]),
        ('<div class="site-footer">f</div><div id="cookie-notice">c</div><div class="top ad">a</div><p>Text</p>', ["Text"]),
    ],
)
def test_blocks_of_odd_pages(page, want):
    assert [t for _, _, t in sitetree.page_blocks(page)] == want


def test_style_tree_drops_what_pages_share(spark):
    rows = [(i, "http://h.org/x", f"<body><div class=top>Same words</div><div class=text><p>Story {i} {i * 7}</p></div>") for i in range(20)]
    rows += [(100, None, None), (101, "odd", ""), (102, "http://h.org/y", "<body><div class=top>Same words</div>")]
    found = {r.page_id: r.text for r in sitetree.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[3] == "Story 3 21" and found[100] == found[101] == "" and found[102] == "Same words"


def test_pages_of_the_tables(spark):
    import html

    for r in sitetree.main_text(spark.read.parquet(f"{SF}/pages.parquet")).collect():
        inside = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " ")))).strip() for x in re.split(r"</?(?:p|h1)>", inside)]
        assert r.text == "\n\n".join(filter(None, blocks))


def test_awkward_pages(spark):
    """Nulls, repeats, a very long page, clashing columns and no pages."""
    rows = [(1, "http://h/1", "<p>a</p>" * 3, "t", 1)] * 2 + [(2, None, None, "t", 2), (None, "x", "", "t", 3), (3, "http://h/2", "<p>" + "long " * 200_000, "t", 4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host int")
    found = sorted((r.page_id or 0, len(r.text), r.host) for r in sitetree.main_text(df).collect())
    assert found == [(0, 0, 3), (1, 7, 1), (1, 7, 1), (2, 0, 2), (3, 999_999, 4)]
    assert sitetree.main_text(df.limit(0)).count() == 0


# Quality


def test_base_statistics(docs, odd):
    for df in (docs, odd.filter("doc_id is not null").dropDuplicates(["doc_id"])):
        found = by_id(quality.quality(df))
        for r in df.collect():
            text = r.text or ""
            w = WORD.findall(text)
            windows = list(zip(w, w[1:], w[2:]))
            seen = Counter(windows)
            repeated = {j for i, x in enumerate(windows) if seen[x] > 1 for j in (i, i + 1, i + 2)}
            lines = [x for x in text.split("\n") if WORD.search(x)]
            want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))
            got = found[r.doc_id]
            assert tuple(got[c] for c in quality.STATS) == want
            assert got.base_failed == (len(w) < 50 or 100 * len(repeated) > 50 * len(w))


def test_outliers_go_and_clean_texts_stay(spark):
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(list("abcdefgh"), rng.integers(2, 9)))
    rows = [(i, " ".join(word() for _ in range(int(rng.integers(60, 400)))), "en", "s") for i in range(400)]
    rows += [(1000 + i, " ".join(word() + "***" for _ in range(200)), "en", "s") for i in range(40)]
    found = by_id(quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")))
    assert all(found[i].kept for i in range(400)) and not any(found[1000 + i].kept for i in range(40))


def test_few_rows_use_the_estimate_of_all_rows_above(spark):
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdefgh"), rng.integers(2, 9)))
    clean = lambda: " ".join(word() for _ in range(int(rng.integers(60, 400))))
    junk = " ".join(word() + "***" for _ in range(200))
    rows = [(i, clean(), "en", "s") for i in range(300)] + [(1000 + i, junk, "en", "rare") for i in range(5)]
    rows += [(2000 + i, junk, "xx", "s") for i in range(5)] + [(3000, clean(), "en", "rare"), (3001, clean(), "xx", "s")]
    found = by_id(quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")))
    assert all(r.kept == (i < 1000 or i >= 3000) for i, r in found.items())


# Licenses


def test_licenses(odd, docs):
    found = by_id(licenses.scan(odd.filter("doc_id is not null")))
    assert (found[8].n_notices, found[8].licenses, found[8].best_dice) == (3, "MIT", 1.0)  # both lines, and the whole
    assert (found[0].n_notices, found[0].licenses, found[0].best_dice) == (0, "", 0.0)
    names = sorted(licenses.TEMPLATES)
    grams = lambda t: {*zip(w := re.sub("[^a-z0-9]+", " ", t.lower()).split(), w[1:])}
    for r in licenses.scan(docs).collect():
        units = r.text.split("\n")
        units = [grams(u) for u in (*units, *([r.text] if len(units) > 1 else []))]
        scored = [max((2 * len(u & grams(licenses.TEMPLATES[n])) / (len(u) + len(grams(licenses.TEMPLATES[n]))), -i) for i, n in enumerate(names)) for u in units]
        good = [(d, names[-i]) for d, i in scored if d >= licenses.THRESHOLD]
        assert (r.n_notices, r.licenses) == (len(good), ",".join(sorted({n for _, n in good})))


# Tokens


def test_ids_like_the_library(docs, odd, ranks):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for df in (docs, odd):
        found = bpe.encode(df.withColumn("whole", F.col("text")), ranks, public_tokenizers.PATTERN, text="whole")
        for r in bpe.decode(found, ranks).collect():
            assert list(r.ids) == library.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    row = bpe.digest(docs, ranks, public_tokenizers.PATTERN).first()
    text = docs.filter(F.col("doc_id") == row.doc_id).first().text
    ids = library.encode_ordinary(text)
    assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() and row.n_tokens == len(ids)
    assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_folded_words_like_the_library(spark, docs, ranks):
    """The fold of built-in functions, with the first 3000 ranks."""
    few = {token: rank for token, rank in ranks.items() if rank < 3000}
    library = tiktoken.Encoding("few", pat_str=public_tokenizers.PATTERN, mergeable_ranks=few, special_tokens={})
    words = sorted({w for r in docs.limit(20).collect() for w in r.text.split()}, key=lambda w: hashlib.md5(w.encode()).hexdigest())[:200]
    words += ["", "a", "é漢\U0001f600", "thethethethe"]
    found = bpe.fold_words(spark.createDataFrame([(w,) for w in words], "word string").repartition(4), few).collect()
    assert {r.word: list(r.ids) for r in found} == {w: list(library._encode_single_piece(w.encode())) if w else [] for w in words}


def test_white_space_and_long_words(ranks):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(["a", "the", " ", " ", "\n", "'s", "é", "7", "!", " ", "\x1c", "\t", "漢"], rng.integers(1, 30))) for _ in range(2000)]
    texts += ["".join(rng.choice(list("abehtonsi"), 3000)), "thereof" * 30, None]
    for at in range(0, len(texts), 100):
        for text, ids in zip(texts[at : at + 100], encoder(texts[at : at + 100])):
            assert np.frombuffer(ids, np.int32).tolist() == library.encode_ordinary(text or ""), text


# Vectors


def test_nearest(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(600, 16)).astype(np.float32)
    base[200:320] = base[7]  # copies
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(600, None), (601, [0.0] * 16), (602, [float("nan")] + [1.0] * 15), (603, [None] + [1.0] * 15), (None, base[0].tolist()), (604, [1.0, 2.0]), (605, []), (5, base[5].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = hnsw.nearest(df, F.col("vec_id") % 20 == 0, config=hnsw.HnswConfig(shard_rows=200)).collect()
    x = base.astype(np.float64)
    hits = 0
    for q in range(0, 600, 20):
        scores = x @ x[q]
        want = sorted((i for i in range(600) if i != q), key=lambda i: (-round(scores[i], 9), i))[:20]
        got = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == q)
        assert [g[0] for g in got] == list(range(1, 21)) and np.allclose([g[2] for g in got], scores[[g[1] for g in got]])
        hits += len(set(want) & {g[1] for g in got})
    assert hits >= 0.95 * 600 and {r.query_id for r in found} == set(range(0, 600, 20))
    assert hnsw.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# Near duplicates


def slow_classes(marks, ids, radius=4):
    parent = list(range(len(marks)))

    def find(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i in range(len(marks)):
        for j in np.flatnonzero(np.bitwise_count(marks[i + 1 :] ^ marks[i]) <= radius):
            parent[find(i)] = find(i + 1 + j)
    least = {}
    for i, x in enumerate(ids):
        least[find(i)] = min(least.get(find(i), x), x)
    return [least[find(i)] for i in range(len(ids))]


def test_repeated_rows_use_up_no_ids(spark):
    rows = [(i, [1.0, 2.0]) for i in range(25)] * 2 + [(30, [2.0, 1.0])] * 30
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = hnsw.nearest(df, F.col("vec_id") == 3, k=20).orderBy("rank").collect()
    assert [r.vec_id for r in found] == [i for i in range(21) if i != 3]


def test_fingerprint():
    def plain(text):
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
        shingles = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    for text in ("", " \n", "Ä One", "a b c d", "A b\tc D e f É g h i", "x y " * 50):
        assert simhash.fingerprint(text.encode()) == plain(text)
    assert simhash.fingerprint(None) == 0


def test_components_like_all_pairs(docs):
    rows = simhash.near_duplicates(docs).collect()
    marks = np.array([int(r.fingerprint, 16) for r in rows], np.uint64)
    assert [r.component_id for r in rows] == slow_classes(marks, [r.doc_id for r in rows])


@pytest.mark.parametrize("count, parts", [(0, 5), (200_000, 5), (10**9, 6), (10**11, 7), (10**12, 8)])
def test_more_fingerprints_more_parts(count, parts):
    assert simhash.parts_for(count, 4, 2048) == parts


@pytest.mark.parametrize("block, parts", [(16, 5), (2048, 5), (2048, 6), (16, 7)])
def test_dense_shards_in_blocks(spark, block, parts):
    rng = np.random.default_rng(9)
    centres = rng.integers(0, 2**63, 6, dtype=np.uint64)
    marks = []
    for c in centres:
        for _ in range(60):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            marks.append(int(c) ^ sum(1 << int(b) for b in flips))
    marks = np.unique(np.array(marks + rng.integers(0, 2**63, 50).tolist(), np.uint64))
    df = spark.createDataFrame([(int(m),) for m in marks.view(np.int64)], "m long")
    found = {r.node: r.root for r in simhash.components(simhash.links(df, "m", 4, block, parts)).collect()}
    signed = marks.view(np.int64).tolist()
    assert [found.get(m, m) for m in signed] == slow_classes(marks, signed)


def test_blocks_of_one_node():
    shard, marks = np.array([1, 1, 2, 3, 4, 4]), np.array([0, 7, 0, 1, 2, 3], np.uint64)
    a, b = simhash.shard_links(shard, marks, np.array([False, True, False, True, True, True]), 4)
    assert (a.tolist(), b.tolist()) == ([7], [0])


def test_one_stays(odd):
    kept = simhash.keep_one(odd).collect()
    ids = [r.doc_id for r in kept]
    assert kept[0].asDict().keys() == odd.first().asDict().keys()
    assert ids.count(5) == 1 and 6 not in ids and 1 not in ids and 2 not in ids and ids.count(0) == 1 and ids.count(None) == 1


# Mixing


def test_targets_stop_and_reshare(spark):
    df = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 500), (None, 100)], "source string, size long")
    found = {r.source: r for r in mixing.targets(df, mixing.MixConfig(), "source", "size").collect()}
    sizes, weights = {"a": 1000, "b": 10, "c": 500, None: 100}, {"a": 1, "b": 2, "c": 3, None: 1}
    stopped, total = {}, float(sum(sizes.values()))
    while True:
        left, open_w = total - sum(stopped.values()), sum(w for s, w in weights.items() if s not in stopped)
        share = {s: left * w / open_w for s, w in weights.items() if s not in stopped}
        over = {s: 3.0 * sizes[s] for s, t in share.items() if t > 3 * sizes[s]}
        if not over:
            break
        stopped |= over
    assert {s: pytest.approx(r.target) for s, r in found.items()} == {**stopped, **share}


def test_mix_comes_near_its_targets(spark):
    rows = [(i, "w " * (1 + i * 37 % 90), "abc"[i % 3] if i % 5 else "a") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    first, again = mixing.mix(df).collect(), mixing.mix(df.repartition(3)).collect()
    assert {r.doc_id: r.taken for r in first} == {r.doc_id: r.taken for r in again}
    for source in "abc":
        mine = [r for r in first if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 90 and sum(r.size for r in mine) == mine[0].source_size
    assert all(0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in first)


def slow_mix(rows, config, weigh):
    """Copies per document: classes of weight filled up to the target, Pareto order, a cut where the words come nearest."""
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    weights, total = {s: config.weights[i % 3] for i, s in enumerate(sorted(sizes))}, sum(sizes.values())

    def solve(want, size, weight):
        low, high = 0.0, 1e12
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(mid * weight[k], 3.0) * size[k] for k in size) < want else (low, mid)
        return high

    level = solve(total, sizes, {s: weights[s] / sizes[s] for s in sizes})
    copies, expected = {}, {}
    for s in sizes:
        target = min(level * weights[s], 3 * sizes[s])
        mine = [(i, len(t.split()), t) for i, t, x in rows if x == s]
        step = {i: int(np.floor(np.log2(weigh(n)) * 8 + 1e-9)) for i, n, _ in mine}
        per = {k: sum(n for i, n, _ in mine if step[i] == k) for k in set(step.values())}
        lam = solve(target, per, {k: 2 ** (k / 8) for k in per})
        keys, need = [], target
        for i, n, t in mine:
            e = min(lam * 2 ** (step[i] / 8), 3.0)
            whole = int(e + 1e-9)
            part, copies[i], expected[i] = max(e - whole, 0), whole, e
            need -= whole * n
            text = f"{config.seed}\x1f{i}\x1f{hashlib.md5(t.encode()).hexdigest()}"
            u = (int(hashlib.md5(text.encode()).hexdigest()[:8], 16) + 0.5) / 2**32
            if part > 1e-9:
                keys.append((u * (1 - part) / ((1 - u) * part), i, n))
        at = 0
        for _, i, n in sorted(keys):
            if at + n / 2 > need:
                break
            copies[i] += 1
            at += n
    return copies, expected


@pytest.mark.parametrize("power", [0.5, 1.0, 0.0])
def test_mix_takes_what_pareto_order_says(spark, power):
    rng = np.random.default_rng(7)
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 400)) + [str(i)]), "abc"[i % 3] if i % 4 else "a") for i in range(600)]
    config = mixing.MixConfig(size_power=power)
    want, expected = slow_mix(rows, config, lambda n: n**power)
    found = by_id(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5), config))
    assert {i: r.copies for i, r in found.items()} == want
    assert all(r.expected == pytest.approx(expected[i], abs=1e-6) for i, r in found.items())
    assert len({round(r.expected, 6) for r in found.values()}) > (10 if power else 0)


def test_inclusion_rates_follow_the_wanted_ones(spark):
    """Among documents of one weight, the share that gets one more copy is their inclusion probability."""
    df = spark.range(0, 40_000, 1, 4).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), F.pow(F.lit(4), F.col("id") % 4).cast("int")).alias("text"), F.when(F.col("id") % 5 == 0, "a").otherwise("b").alias("source")
    )
    found = mixing.mix(df, keep=["source"]).groupBy("source", "size").agg(F.count("*").alias("n"), F.avg("copies").alias("rate"), F.first("expected").alias("e"))
    rows = found.collect()
    assert len(rows) == 8 and len({round(r.e, 4) for r in rows}) >= 5
    for r in rows:
        part = r.e - int(r.e + 1e-9)
        assert abs(r.rate - r.e) <= 5 * (part * (1 - part) / r.n) ** 0.5 + 0.01, r


def test_weights_may_be_given(spark):
    rows = [(i, "a b c d", "s", float(1 + i % 2)) for i in range(2000)] + [(5000, "a b", "s", None), (5001, "", "s", 1.0), (6000, "x " * 9000, "t", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, quality double")
    found = by_id(mixing.mix(df, weight=F.col("quality")))
    rate = lambda k: np.mean([r.copies for i, r in found.items() if i < 2000 and i % 2 == k])
    assert rate(1) == pytest.approx(2 * rate(0), rel=0.1) and found[5000].taken == found[5001].taken == 0


def test_repeated_rows_are_told_apart(spark):
    df = spark.createDataFrame([(None, "a b c d", "s")] * 90 + [(1, "x y", "t")] * 300, "doc_id long, text string, source string").repartition(4)
    found = mixing.mix(df).collect()
    for source in "st":
        mine = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 2


# Shards


def test_shards(spark, docs):
    both = sized(docs.union(docs))
    for bucket in (1 << 14, 1 << 24):
        rows = sharding.shuffle_shards(both, 16, bucket_bytes=bucket).collect()
        slots = {}
        for r in rows:
            slots.setdefault(r.shard, []).append(r.slot)
        counts = [len(slots.get(s, [])) for s in range(16)]
        assert max(counts) - min(counts) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
        assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in both.collect())
        order = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
        assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.2
        if bucket == 1 << 24:  # one bucket: the order is that of one seeded shuffle, with its swaps replayed
            want, picks = list(range(both.count())), np.random.default_rng([7, 0]).random(both.count())
            for i in reversed(range(1, len(want))):
                j = int(picks[i] * (i + 1))
                want[i], want[j] = want[j], want[i]
            ids = [r.doc_id for r in both.withColumn("at", F.monotonically_increasing_id()).orderBy("at").collect()]
            assert order == [ids[i] for i in want]
    few = sharding.shuffle_shards(both.limit(3), 16).collect()
    assert sorted((r.shard, r.slot) for r in few) == [(0, 0), (1, 0), (2, 0)]
    assert sorted(sharding.permutation(1000, 1)) == list(range(1000))
    plan = sharding.shuffle_shards(both, 16)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_sl_bucket") == 1  # records move once


def test_starts_of_buckets(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 4)
    buckets = [b for b in range(40) for _ in range(b * 7 % 5)]
    found = sharding.bucket_starts(spark.createDataFrame([(b,) for b in buckets], "b int"), "b").collect()
    assert {r.b: (r.start, r["all"]) for r in found} == {b: (buckets.index(b), len(buckets)) for b in set(buckets)}


# Languages


def test_held_out_accuracy(docs):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = langid.identify(docs, ~held, keep=["doc_id", "lang"]).withColumn("held", F.lit(True))
    rows = found.join(docs.filter(held).select("doc_id"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) >= 0.95 and all(0 <= r.score <= 1 for r in rows)


def test_kneser_ney_sums_to_one(spark):
    df = spark.createDataFrame([("abracadabra", "x"), ("abba cab", "x"), ("zzz", "y")], "text string, lang string")
    model = langid.train(df)
    letters = np.arange(1 << 16, dtype=np.uint64)
    for context in ("abr", " ab", "zzz", "qqq"):
        key = sum(np.uint64(ord(c)) << np.uint64(16 * (3 - i)) for i, c in enumerate(context))
        assert np.allclose(np.exp(model.log_p(key + letters)).sum(axis=0), 1)


def test_every_gram_is_kept(spark):
    rng = np.random.default_rng(3)
    words = ["".join(w) for w in rng.choice(list("abcdefghijklmnopqrstuvwxyz"), (20_000, 4))]
    grams = {one[i : i + 4] for one in ["   " + " ".join(words) + " "] for i in range(len(one) - 3)}
    model = langid.train(spark.createDataFrame([(" ".join(words), "x")], "text string, lang string"))
    assert len(model.grams[4][0]) == len(grams)


def test_parts_score_like_the_whole(docs):
    few = docs.limit(60).checkpoint()
    count, _ = langid.train_parts(few, values=20_000)
    whole, parts = (by_id(langid.identify(few, F.lit(True), values=v)) for v in (10**9, 20_000))
    assert count > 2 and whole.keys() == parts.keys()
    for i, r in whole.items():
        assert (r.lang_pred, r.rejected) == (parts[i].lang_pred, parts[i].rejected)
        assert r.cross_entropy is None or parts[i].cross_entropy == pytest.approx(r.cross_entropy)


def test_texts_without_letters(odd):
    found = by_id(langid.identify(odd.filter("doc_id is not null"), F.lit(True)))
    assert found[0].lang_pred == found[1].lang_pred == found[2].lang_pred == "und" and found[0].score == 0
    assert found[3].lang_pred in ("en", "de")
