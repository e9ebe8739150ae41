"""WARC archives, token totals, toxicity and the pipeline."""

import hashlib
import struct
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from trilode.llm import packing, token_counts, toxicity, warc
from trilode.llm.common import crc_mod, new_folder


def one(kind="response", payload=b"<p>x</p>", **options):
    return warc.record(kind, "urn:page:1", "http://a.example/", "2024-01-01T00:00:00Z", payload,
                       hashlib.sha1(payload).hexdigest(), **options)


def test_record_round_trip():
    for payload in (b"", b"x" * 100_000, "é\r\n\r\nWARC/1.1".encode()):
        r = warc.parse(one(payload=payload))
        assert (r.payload, r.payload_bytes) == (payload, len(payload))
        again = warc.parse(one("revisit", payload, refers_to="urn:page:2"))
        assert (again.payload, again.payload_bytes, again.refers_to) == (
            None, len(payload), "urn:page:2")


@pytest.mark.parametrize("spoil", [
    lambda r: r[:-1], lambda r: r + b"x", lambda r: b"HTTP" + r, lambda r: r.replace(b"<p>", b"<q>"),
    lambda r: r.replace(b"WARC-Date", b"No-Date"), lambda r: r.replace(b"WARC-Type: ", b"WARC-Type "),
    lambda r: r.replace(b"Content-Length: 8", b"Content-Length: 9"), lambda r: b"",
])
def test_broken_records(spoil):
    with pytest.raises(warc.Invalid):
        warc.parse(spoil(one()))


def test_archive_frames():
    records = [one(payload=b"%d" % i * (i % 50)) for i in range(400)]
    data = warc.archive(records)
    assert struct.unpack_from("<I", data)[0] == warc.DICTIONARY_MAGIC
    assert [r for _, r in warc.frames(data)] == records
    with_skippable = data + struct.pack("<II", 0x184D2A50, 3) + b"abc"
    assert len(list(warc.frames(with_skippable))) == 400
    plain = zstandard.ZstdCompressor().compress(records[0])  # no dictionary
    assert [r for _, r in warc.frames(plain)] == records[:1]
    for broken in (data[:-3], data[:20], data + b"junk"):
        with pytest.raises(warc.Invalid):
            list(warc.frames(broken))


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_pages_round_trip(spark):
    big, other = "b" * 1000, "é" * 999
    rows = [(1, "http://a/", big), (2, None, big), (3, "http://a b/\r\nX: y", big), (4, "u", None),
            (5, "u", ""), (None, "u", other), (7, "u", other), (8, "u", "s"), (9, "u", "s"),
            (3, "again", big), (None, None, None)]
    df = pages(spark, rows).withColumn("digest", F.lit("clash")).withColumn("payload", F.lit(1))
    got = Counter(tuple(r) for r in warc.round_trip(df).collect())
    want = Counter()
    for page_id, _, html in rows:
        data = (html or "").encode()
        top = {big: 3, other: 7}.get(html)
        again = top is not None and page_id != top
        want[page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response",
             top if again else None] += 1
    assert got == want
    assert warc.round_trip(df.limit(0)).count() == 0


def test_small_archives_and_broken_ones(spark):
    df = pages(spark, [(i, f"http://a/{i}", f"<p>{i}</p>" * 50) for i in range(60)])
    folder = new_folder(spark, "warc-test")
    assert warc.write(df, folder, archive_bytes=5000) == 60
    found = warc.read(spark, folder)
    assert found.select("archive").distinct().count() > 3
    assert {r.payload.decode() for r in found.collect()} == {f"<p>{i}</p>" * 50 for i in range(60)}
    store, path = warc._open(folder)
    with store.open_output_stream(f"{path}/broken.warc.zst", compression=None) as out:
        out.write(warc.archive([one(), one()[:-1], one()])[:-2])
    errors = [r.error for r in warc.read(spark, folder).collect() if r.error]
    assert len(errors) == 2


COUNTS = "source string, lang string, tokenizer string, tokens bigint"


def test_totals(spark):
    first = spark.createDataFrame([("a", "en", "v1", 5), ("a", "en", "v1", None), ("b", None, "v1", 3),
                                   ("c", "en", "v1", 4)], COUNTS)
    new = spark.createDataFrame([("b", None, "v2", 30)], COUNTS)
    folder = new_folder(spark, "totals-test")
    token_counts.commit(token_counts.inserts(first), folder, 1)
    token_counts.commit(token_counts.deletes(first.where("source = 'c'")), folder, 2)
    change = token_counts.revisions(first.where("source = 'b'"), new)
    for _ in range(3):
        token_counts.commit(change, folder, 3)
    token_counts.commit(token_counts.inserts(first), folder, 1)
    got = {tuple(r) for r in token_counts.totals(spark, folder).collect()}
    assert got == {("a", "en", "v1", 2, 5), ("b", None, "v2", 1, 30)}
    before = len(got)
    token_counts.commit(token_counts.inserts(first.limit(0)), folder, 4)
    assert token_counts.totals(spark, folder).count() == before


def test_store_grows_with_groups_only(spark):
    many = spark.range(5000).selectExpr("'a' AS source", "'en' AS lang", "'v' AS tokenizer", "id AS tokens")
    folder = new_folder(spark, "totals-test")
    token_counts.commit(token_counts.inserts(many), folder, 1)
    assert spark.read.parquet(folder).count() == 1


def test_vocabulary_counts(docs, odd):
    tokenizer = packing._tokenizer(None)
    for df in (docs, odd):
        want = Counter()
        for r in df.collect():
            want[r.source] += len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)
        got = Counter()
        for r in token_counts.vocabulary_counts(df, "bpe").collect():
            got[r.source] += r.tokens
        assert got == want


def test_rule_counts_of_odd_rows(odd):
    got = {r.doc_id: r.c for r in odd.select(
        "doc_id", token_counts.rule_counts("text").alias("c")).collect()}
    assert tuple(got[1]) == tuple(got[2]) == tuple(got[3]) == (0, 0)
    assert tuple(got[4]) == (1, 1) and got[6]["words-1"] == 60_000


@pytest.fixture(scope="module")
def toxic_model(docs, spark, sf_dir):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return toxicity.fit(texts, labels, crc_mod("doc_id", 3) != 1), texts, labels


def test_held_out_toxicity(toxic_model):
    model, texts, labels = toxic_model
    rows = toxicity.score(texts, model).join(labels, "doc_id").where(
        crc_mod("doc_id", 3) == 1).select("toxic", "toxicity").collect()
    hits = [r.toxicity >= 0.7 for r in rows if r.toxic == 1]
    alarms = [r.toxicity >= 0.7 for r in rows if r.toxic == 0]
    assert len(hits) > 5 and np.mean(hits) >= 0.7 and np.mean(alarms) <= 0.02


def test_toxicity_odd_rows(toxic_model, odd, none, spark):
    model, texts, labels = toxic_model
    rows = toxicity.score(odd.withColumn("toxicity", F.lit("old")), model).collect()
    assert len(rows) == odd.count() and all(0 <= r.toxicity <= 1 for r in rows)
    assert toxicity.score(none, model).count() == 0
    assert toxicity.fit(none, labels, F.lit(True)) is None
    assert {r.toxicity for r in toxicity.score(odd, None).collect()} == {0.0}
    alone = toxicity.fit(texts.limit(1).withColumn("doc_id", F.lit(1).cast("long")),
                         spark.createDataFrame([(1, 1)], "doc_id bigint, toxic int"), F.lit(True))
    assert alone is not None


def test_obfuscated_words_are_seen_through():
    for word in ("Idiot!!", "id*iot", "1d10t".replace("1", "i", 1), "i.d.i.o.t", "IDIOT,"):
        assert "idiot " in toxicity.stems(word) or "idio" in toxicity.stems(word), word


def test_isotonic():
    x = np.array([0, 1, 2, 3, 4, 5, 6, 7.0])
    y = np.array([0, 0, 1, 0, 0, 1, 1, 1.0])
    knots, values = toxicity.isotonic(x, y)
    fitted = np.interp(x, knots, values)
    assert (np.diff(fitted) >= 0).all() and (np.diff(knots) >= 0).all()
    assert fitted[0] < 0.3 and fitted[7] > 0.7 and len(set(fitted[2:5])) == 1


def test_isotonic_is_the_minimax_fit():
    rng = np.random.default_rng(1)
    for _ in range(30):
        rows = int(rng.integers(1, 40))
        x, y = rng.integers(0, 25, rows) * 1.0, rng.integers(0, 2, rows) * 1.0
        w = rng.choice([1.0, 7.5], rows)
        points = np.unique(x)  # rows with equal x count together
        n = len(points)
        a, b = (np.array([v[x == p].sum() for p in points]) for v in (y * w, w))

        def mean(i, j):
            return a[i:j + 1].sum() / b[i:j + 1].sum()

        best = np.array([max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)])
        blocks = [np.isclose(best, value) for value in best]
        want = np.maximum.accumulate([(a[m].sum() + 0.5) / (b[m].sum() + 1) for m in blocks])
        knots, values = toxicity.isotonic(x, y, w)
        assert np.allclose(np.interp(points, knots, values), want)


def test_splits_are_the_best_of_all(monkeypatch):
    """One tree against a search of every split of every node."""
    monkeypatch.setattr(toxicity, "TREES", 1)
    monkeypatch.setattr(toxicity, "DEPTH", 2)
    rng = np.random.default_rng(2)
    for _ in range(10):
        x, y = rng.integers(0, 6, (60, 3)) * 1.0, rng.integers(0, 2, 60) * 1.0
        model = toxicity.boost(x, y)
        p = np.full(60, y.mean())
        g, h = y - p, p * (1 - p)

        def worth(rows):
            return g[rows].sum() ** 2 / (h[rows].sum() + 1)

        parts = [np.ones(60, bool)]
        for level in range(2):
            halves = []
            for k, rows in enumerate(parts):
                node = 2**level - 1 + k
                low = model.bins(x)[:, model.feature[0, node]] <= model.bound[0, node]
                every = [worth(rows & (x[:, f] <= t)) + worth(rows & (x[:, f] > t))
                         for f in range(3) for t in range(6)]
                assert np.isclose(worth(rows & low) + worth(rows & ~low), max(every))
                halves += [rows & low, rows & ~low]
            parts = halves
        for k, rows in enumerate(parts):
            leaf = toxicity.RATE * g[rows].sum() / (h[rows].sum() + 1)
            assert np.allclose(model.margin(x)[rows], np.log(y.mean() / (1 - y.mean())) + leaf), k


def test_rare_labels_are_all_drawn(spark):
    known = spark.range(30_000).selectExpr("id AS label_id", "int(id % 600 = 0) AS y")
    some, weight = toxicity.drawn(known, 1000)
    n = {r.y: r["count"] for r in some.groupBy("y").count().collect()}
    assert n[1] == 50 and 850 < n[0] < 1050
    assert weight == {0: 29_950 / 950, 1: 1.0}
    few, weight = toxicity.drawn(known.where("label_id < 900"), 1000)
    assert few.count() == 900 and weight == {0: 1.0, 1: 1.0}
    none, weight = toxicity.drawn(known.limit(0), 1000)
    assert none.count() == 0 and weight == {0: 1.0, 1: 1.0}


def test_scores_keep_to_the_share_of_rare_labels(spark, monkeypatch):
    """Half of the texts with the stem are toxic and the draw leaves most clean texts out."""
    monkeypatch.setattr(toxicity, "TRAIN_DOCS", 800)
    texts = spark.range(8000).selectExpr(
        "id AS doc_id", "concat('text ', id, IF(id % 40 < 2, ' vilest', ' mild')) AS text")
    labels = spark.range(8000).selectExpr("id AS doc_id", "int(id % 40 = 0) AS toxic")
    model = toxicity.fit(texts, labels, F.lit(True))
    scores = toxicity.score(texts.where("doc_id < 400"), model).collect()
    bad = np.mean([r.toxicity for r in scores if r.doc_id % 40 < 2])
    assert 0.35 < bad < 0.7 and max(r.toxicity for r in scores if r.doc_id % 40 >= 2) < 0.05


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = toxicity.boost(x, y)
    assert ((model.margin(x) > 0) == y).mean() > 0.95
    flat = toxicity.boost(np.zeros((5, 3)), np.ones(5))
    assert (flat.margin(np.zeros((2, 3))) > 0).all()


def test_pipeline_stages(spark, sf_dir, docs):
    now, columns = docs, docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "pii", "packing"]
    foreign = docs.limit(1).selectExpr(
        "-1L AS doc_id", "'Это русский текст о погоде' AS text", "CAST(NULL AS STRING) AS lang",
        "source", "n_chars")
    now = now.union(foreign).union(foreign.selectExpr(
        "-2L AS doc_id", "'12 !?' AS text", "lang", "source", "n_chars"))
    sizes = [now.count()]
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf_dir).cache()
        sizes.append(now.count())
        if len(sizes) < 6:
            assert now.columns == columns
    kept = len({r.doc_id for r in now.collect()})
    assert sizes[1] == docs.count() and sizes[0] == docs.count() + 2
    assert sizes[1] > sizes[2] > sizes[3] == sizes[4] == kept


def test_pipeline_on_odd_rows(spark, sf_dir, odd, none):
    for df in (odd.drop("item_id"), none):
        now = df
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, sf_dir)
        assert now.count() >= 0


# ---------------------------------------------------------------- broken inputs


def spoiled(data, kind):
    size = struct.unpack_from("<I", data, 4)[0]
    if kind == "dictionary":
        return data[:8] + bytes(b ^ 0x5A for b in data[8:8 + size]) + data[8 + size:]
    if kind == "skippable head":
        return data + b"\x50\x2a\x4d\x18\x09"
    if kind == "skippable body":
        return data + struct.pack("<II", 0x184D2A50, 9) + b"123"
    return data[:8 + size // 2]


@pytest.mark.parametrize("kind", ["dictionary", "skippable head", "skippable body", "cut dictionary"])
def test_spoiled_archives_give_error_rows(spark, tmp_path, kind):
    records = [warc.record("response", f"urn:page:{i}", "http://x.example/", "1970-01-01T00:00:00Z",
                           b"payload %d" % i * 40, hashlib.sha1(b"payload %d" % i * 40).hexdigest(), None)
               for i in range(300)]
    whole = warc.archive(records)
    data = spoiled(whole, kind)
    with pytest.raises(warc.Invalid):
        list(warc.frames(data))
    (tmp_path / f"good{warc.SUFFIX}").write_bytes(whole)
    (tmp_path / f"bad{warc.SUFFIX}").write_bytes(data)
    rows = warc.read(spark, str(tmp_path)).collect()
    assert sum(r.error is None and "good" in r.archive for r in rows) == 300
    assert [r.error is not None for r in rows if "bad" in r.archive][-1]


def test_totals_before_any_commit(spark, tmp_path):
    found = token_counts.totals(spark, str(tmp_path / "none"))
    assert found.count() == 0 and found.columns == ["source", "lang", "tokenizer", "docs", "tokens"]


def test_odd_rows_are_counted(odd, none, spark, tmp_path):
    folder = str(tmp_path / "counts")
    counts = odd.select("source", "lang", token_counts.rule_counts("text").alias("counts"))
    changes = token_counts.inserts(token_counts.by_version(counts, "counts"))
    for _ in range(2):
        token_counts.commit(changes, folder, 1)
    token_counts.commit(changes.limit(0), folder, 2)
    found = token_counts.totals(spark, folder).where("tokenizer = 'words-1'")
    assert found.selectExpr("sum(docs)").first()[0] == odd.count()
    wanted = sum(len((r.text or "").split()) for r in odd.select("text").collect())
    assert found.selectExpr("sum(tokens)").first()[0] == wanted
