"""Web archives, spelling variants and fill-in-the-middle texts: SQL, brute force, round trips and awkward rows."""

import gzip
import hashlib
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelflens.llm import fim, spelling, warc
from shelflens.llm.common import write_once
from shelflens.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_like_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    found = QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(columns)
    assert Counter(map(tuple, found.select(*columns).collect())) == Counter(want.fetchall())


# Fill in the middle


def slow_output(text, lo, hi, form):
    a, b, c = text[:lo], text[lo:hi], text[hi:]
    return {0: text, 1: f"<P>{a}<S>{c}<M>{b}", 2: f"<S>{c}<P>{a}<M>{b}"}[form]


@pytest.mark.parametrize("step", [3, 7, 1 << 20])
def test_scatter_and_gather(monkeypatch, step):
    monkeypatch.setattr(fim, "STEP", step)
    config, rng = fim.FimConfig(), np.random.default_rng(1)
    for _ in range(200):
        texts = ["".join(rng.choice(list("aé漢\U0001f600<P>SM"), rng.integers(0, 9))) for _ in range(rng.integers(1, 8))]
        forms = np.array([0 if not t or any(m in t for m in config.sentinels) else int(rng.integers(0, 3)) for t in texts])
        n = np.array([len(t) for t in texts])
        cuts = np.sort(np.stack([rng.integers(0, n + 1), rng.integers(0, n + 1)], 1), 1)
        raw = [t.encode() for t in texts]
        data, ends = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw])
        places = fim.scan_cuts(data, ((np.cumsum(n) - n)[:, None] + cuts).ravel()).reshape(-1, 2)
        out, out_ends = fim.scatter(data, ends, places[:, 0], places[:, 1], forms, config)
        assert [x.decode() for x in fim._cut_up(out, out_ends)] == [slow_output(t, *c, f) for t, c, f in zip(texts, cuts, forms)]
        assert fim._cut_up(*fim.gather(out, out_ends, forms, config)) == raw


def test_middles_of_awkward_rows(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(fim, "GROUP_BYTES", 64)
    plain = odd.drop("n").withColumn("restored", F.lit(1)).withColumn("output", F.lit(2))
    back = fim.restore(fim.transform(plain))
    assert len(set(back.columns)) == len(back.columns) and {"lang", "score", "shard"} <= set(back.columns)
    rows = back.collect()
    assert len(rows) == odd.count() and {r.form for r in rows} >= {"plain", "psm"}
    for r in rows:
        text = r.text or ""
        assert r.restored == text and r.n == len(text)
        h = hashlib.sha256(f"1:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
        lo, hi = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
        form = 0 if not text or h3 % 100 >= 90 else 2 if h4 % 100 < 20 else 1
        assert (r.form, r.output) == (["plain", "psm", "spm"][form], slow_output(text, lo, hi, form))
        assert (r.prefix_chars, r.middle_chars) == ((lo, hi - lo) if form else (None, None))
    assert fim.restore(fim.transform(empty)).count() == 0


def test_texts_with_sentinels_stay_plain(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a <P> b", "x<M>", "<S>", "<P", "P>"] * 20)], "doc_id long, text string")
    for r in fim.restore(fim.transform(df)).collect():
        assert r.restored == r.text and (r.form == "plain" or ">" not in r.text or r.text == "P>")


def test_outputs_and_sentinels_that_do_not_fit(spark):
    for wrong in (dict(prefix=""), dict(prefix="<S>x"), dict(prefix="ab", suffix="bc"), dict(middle="aa")):
        with pytest.raises(ValueError):
            fim.FimConfig(**wrong)
    with pytest.raises(ValueError):
        fim.gather(np.frombuffer(b"<P>ab<S>c<P>d<S><M>", np.uint8), np.array([9, 19]), np.array([1, 1]), fim.FimConfig())


# Spelling variants


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_variants(texts, config):
    words = Counter()
    for id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if id is None else id}:{run}".encode())
            if config.misspell_every and h % config.misspell_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    words = {w: n for w, n in words.items() if len(w) >= config.min_chars and n >= config.min_count}
    out = {}
    for w, n in words.items():
        others = [o for o in words if o != w and near(o, w)]
        form = min(others, key=lambda o: (-words[o], o.encode()), default=None)
        form = form if form and words[form] >= config.dominance * n else None
        out[w] = (n, len(others), form, words.get(form))
    ends = {}
    for w in out:
        ends[w] = w
        while out[ends[w]][2]:
            ends[w] = out[ends[w]][2]
    return {(w, *v, ends[w]) for w, v in out.items()}


def found_variants(df, config):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.variants(df, config=config).collect()}


@pytest.mark.parametrize("every", [None, 3])
def test_variants_like_all_pairs(spark, every):
    rng = random.Random(every)
    letters = "abcdéÉÀ÷"
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 6))) for _ in range(150)] + ["A" * 90, "a" * 91, "a" * 90 + "b"]
    texts = [(i % 60 or None, " ".join(rng.choice(words) + rng.choice(".,1 ") for _ in range(rng.choice([0, 5, 400])))) for i in range(80)]
    texts += [(0, None), (1, ""), texts[0], texts[0]]
    config = spelling.SpellingConfig(min_chars=2, min_count=2, dominance=2, misspell_every=every)
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("word", F.lit("x")).repartition(5)
    assert found_variants(df, config) == slow_variants(texts, config)


@pytest.mark.parametrize("block, levels, held", [(1, 2, 8), (3, 1, 64), (1000, 4, 16), (1 << 14, None, 1 << 16), (2, 6, 1)])
def test_shards_and_blocks_lose_no_pair(spark, monkeypatch, block, levels, held):
    rng = random.Random(block)
    for name, value in (("FRONTIER", 7), ("VERIFY", 50)) if held < 1 << 16 else ():
        monkeypatch.setattr(spelling, name, value)
    words = sorted({"".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 6))) for _ in range(120)} | {"z" * 70, "z" * 69, "z" * 63, "z" * 62 + "y"})
    table = write_once(spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long"), "words")
    rows = [tuple(r) for r in spelling.near_words(table, block, levels).collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == {(a, b, j) for a in words for j, b in enumerate(words) if a != b and near(a, b)}


@pytest.mark.parametrize("held", [1, 5, 40])
def test_rows_held_over_batches(held, monkeypatch):
    """Small batches, shards of several of them, members and queries apart."""
    import pyarrow as pa

    monkeypatch.setattr(spelling, "HELD", held)
    rng = random.Random(held)
    group_of = np.zeros(256, np.int64)
    for i, c in enumerate("abc"):
        group_of[ord(c)] = i
    rows = sorted({(rng.randrange(4), rng.randrange(2), rng.random() < 0.4, "".join(rng.choice("abc") for _ in range(rng.randrange(1, 4)))) for _ in range(150)}, key=lambda r: r[:3])
    work, got = spelling.Held(group_of, 3), []
    for at in range(0, len(rows), 7):
        k, b, q, w = (list(c) for c in zip(*rows[at : at + 7]))
        batch = pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(b, pa.int64()), pa.array(q), pa.array(w), pa.array([1] * len(w), pa.int64())], names=list("kbqwn"))
        got += [o for batch in work.add(batch) for o in zip(*batch.to_pydict().values())]
    got += [o for batch in work.solve(work.rows()) for o in zip(*batch.to_pydict().values())]
    want = Counter()
    for x in rows:
        for y in rows:
            if x[:2] == y[:2] and not y[2] and near(x[3], y[3]):
                want[x[3], y[3], 1] += 1
                if x[2]:
                    want[y[3], x[3], 1] += 1
    assert Counter(got) == want


def test_variants_of_awkward_rows(odd, empty):
    config = spelling.SpellingConfig(min_count=1)
    assert found_variants(odd, config) == slow_variants([(r.doc_id, r.text) for r in odd.collect()], config)
    assert spelling.variants(empty).count() == 0


def test_roots_over_long_ways(spark):
    ways = [(f"w{i}", f"w{i + 1}") for i in range(21)] + [("w21", None)] + [(f"v{i}", "w20") for i in range(50)]
    found = {r.word: r.root for r in spelling.roots(spark.createDataFrame(ways, "word string, form string")).collect()}
    assert found == {w: "w21" for w, f in ways if f}


@pytest.mark.parametrize("count, levels", [(0, 2), (30_000, 2), (300_000, 4), (10**8, 10)])
def test_more_words_more_levels(count, levels):
    assert spelling.levels_for(count, spelling.BLOCK) == levels


# Web archives


@pytest.fixture
def folder(tmp_path):
    return lambda name: f"file:{tmp_path}/{name}"


def files_of(folder):
    base = folder.removeprefix("file:")
    return {f: open(f"{base}/{f}", "rb").read() for f in sorted(os.listdir(base)) if f.endswith(".gz")}


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(8)
    texts = ["<p>" + "".join(rng.choice("ab c\n") for _ in range(rng.randrange(3000))) for _ in range(60)]
    rows = [(i, f"http://h{i % 7}.org/{rng.randrange(90)}", rng.choice(texts)) for i in range(300)]
    rows += [(400 + i, "http://hot.org/", "hot " * 400) for i in range(150)]  # a third with one payload
    rows += [(600, None, None), (601, "x", ""), (602, "line\r\nbreak é", "short"), (603, None, "short"), (None, "u", "hot " * 400), (None, "v", "id-less " * 20)]
    rows += [(700, "twice", "again " * 30)] * 3 + [(701, "twice", "again " * 30)] + [(702, "long", "x" * 3_000_000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("name", F.lit("n")).repartition(5).checkpoint()


SMALL = warc.WarcConfig(shard_bytes=40_000, roll_bytes=4_000)


def test_archive(spark, pages, folder):
    manifest = warc.write(pages, folder("a"), config=SMALL)
    listed = {r.name: r for r in manifest.collect()}
    files = files_of(folder("a"))
    assert set(files) == set(listed) and len({r.shard for r in listed.values()}) > 5 and any(r.part for r in listed.values())
    assert not os.path.exists(folder("a").removeprefix("file:") + "/_temporary")
    order = []
    for name, raw in files.items():
        assert (len(raw), hashlib.sha256(raw).hexdigest()) == (listed[name].bytes, listed[name].sha256)
        whole, records, at = gzip.decompress(raw), 0, 0
        while at < len(whole):  # a reader of its own: headers, block, two line breaks
            head, end = whole[at:].split(b"\r\n\r\n", 1)[0], whole.index(b"\r\n\r\n", at) + 4
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            block = whole[end : end + int(fields["Content-Length"])]
            assert "sha256:" + hashlib.sha256(block).hexdigest() == fields["WARC-Block-Digest"]
            assert whole[end + len(block) : end + len(block) + 4] == b"\r\n\r\n"
            at, records = end + len(block) + 4, records + 1
            if fields["WARC-Type"] != "warcinfo":
                order.append(fields.get("WARC-Target-URI", ""))
        assert records == listed[name].records + 1
        last = zlib.decompressobj(31)
        last.decompress(raw)
        assert last.unused_data and listed[name].records > 0
    assert order == sorted(order) and sum(r.records for r in listed.values()) == pages.count()
    assert all(r.bytes >= 4_000 or r.part == max(x.part for x in listed.values() if x.shard == r.shard) for r in listed.values())


def test_archive_read_back(spark, pages, folder):
    warc.write(pages, folder("a"), config=SMALL)
    rows = warc.read(spark, folder("a")).collect()
    assert all(r.intact for r in rows) and len({r.record_id for r in rows}) == len(rows)
    plain = [(r.page_id, r.url, (r.html or "").encode()) for r in pages.collect()]
    first = {}
    for id, _, body in plain:
        if id is not None and len(body) >= 100:
            first[body] = min(id, first.get(body, id))
    want = Counter()
    for id, url, body in plain:
        refers = first.get(body) if len(body) >= 100 and first.get(body) != id else None
        url = url and re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url)
        want[id, url, len(body), hashlib.sha256(body).hexdigest(), "revisit" if refers is not None else "response", refers, None if refers is not None else body] += 1
    number = lambda x: None if x is None else int(x)
    got = Counter((number(r.row_id), r.target_uri, r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to_id), None if r.payload is None else bytes(r.payload)) for r in rows)
    assert got == want
    by_record = {r.record_id: r for r in rows}
    for r in rows:
        if r.record_type == "revisit":
            assert by_record[r.refers_to].row_id == r.refers_to_id and by_record[r.refers_to].payload_digest == r.payload_digest


def test_same_rows_same_files(spark, pages, folder):
    warc.write(pages, folder("a"), config=SMALL)
    warc.write(pages.repartition(11, "html").select("html", "url", "page_id"), folder("b"), config=SMALL)
    assert files_of(folder("a")) == files_of(folder("b"))


def test_names_are_given_once_more(spark, pages, folder):
    """A run that ended between names and manifest is repeated; a finished archive is not written to."""
    base = folder("a").removeprefix("file:")
    warc.write(pages, folder("a"), config=SMALL)
    before = files_of(folder("a"))
    reports = write_once(spark.read.parquet(f"{base}/_manifest").withColumn("temporary", F.lit("_temporary/gone")), "reports")
    warc.name_files(reports, folder("a"))
    with pytest.raises(FileExistsError):
        warc.write(pages, folder("a"))
    os.rename(f"{base}/_manifest", f"{base}/old")
    warc.write(pages, folder("a"), config=SMALL)
    assert files_of(folder("a")) == before
    open(f"{base}/{next(iter(before))}", "ab").write(b"x")
    with pytest.raises(Exception, match="not the file that was written"):
        warc.name_files(reports, folder("a"))


def test_shards_cut_where_the_sum_passes(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, "a", "b", "c"]), i, rng.randrange(1, 50)) for i in range(500)]
    df = spark.createDataFrame(rows, "u string, i long, size long").repartition(6)
    starts = warc.shard_starts(df, ["u", "i"], "size", 700)
    want, at, seen = [], 0, set()
    for u, i, size in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        if at // 700 not in seen:
            want.append((u, i))
        seen.add(at // 700)
        at += size
    assert starts == want
    found = {r.i: r.shard for r in df.withColumn("shard", warc.shard_of(["u", "i"], starts, df.schema)).collect()}
    key = lambda t: (t[0] is not None, t[0] or "", t[1])
    assert found == {i: sum(key(s) <= key((u, i)) for s in starts) - 1 for u, i, _ in rows}


def test_no_pages_and_other_columns(spark, pages, folder):
    none = warc.write(pages.limit(0), folder("a"))
    assert none.count() == 0 and warc.read(spark, folder("a")).count() == 0
    named = spark.createDataFrame([("k 1%", "some text", 5), ("é", None, 6)], "key string, body string, kind int")
    warc.write(named.withColumn("uri", F.lit("u")).withColumn("shard", F.lit(9)), folder("b"), id="key", uri="uri", payload="body", order=["kind"])
    assert [(r.row_id, bytes(r.payload)) for r in warc.read(spark, folder("b")).collect()] == [("k 1%", b"some text"), ("é", b"")]
