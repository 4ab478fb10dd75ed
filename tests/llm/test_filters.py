"""Line templates, URL cascade, decontamination, secrets, quality, against brute force on small tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.llm import packing, quality, secret_scan, url_cascade, wu_manber
from wardline.llm.line_templates import drop_recurring_lines, recurring_lines


def brute_lines(rows, min_documents, depth=3, similarity=0.6, evidence=60):
    def mask(line):
        tokens = [t for t in line.translate({9: 32, 13: 32, 12: 32, 11: 32}).split(" ") if t]
        return tuple("<*>" if re.search("[0-9]", t) else t for t in tokens)

    least = {}
    for d, t in rows:
        if d is not None:
            least[t] = min(d, least.get(t, d))
    lines = [(d, t, i, mask(x)) for d, t in rows for i, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[3]]
    leaves = defaultdict(set)
    for *_, m in lines:
        leaves[len(m), m[:depth]].add(m)
    template = {}
    for leaf, members in leaves.items():
        centre = [min(((-c, t) for t, c in Counter(col).items()))[1] for col in zip(*members)]
        for m in members:
            template[m] = (leaf, None) if sum(a == b for a, b in zip(m, centre)) >= similarity * len(m) else (leaf, m)
    docs = defaultdict(set)
    for _, t, _, m in lines:
        docs[template[m]].add(least.get(t, t))
    return {(d, i) for d, _, i, m in lines if len(docs[template[m]]) >= max(2, min(min_documents, -(-evidence // len(m))))}


def test_documents_needed_fall_with_length(spark):
    """Long lines go from two texts on, short ones, also of one token, from ten; copies of a text count once."""
    long, short = " ".join(f"word{c}" for c in "abcdefghijklmnopqrstuvwxyzabcdef"), "All rights reserved."
    rows = [(i, f"own{'abcdefghijk'[i]} text\n{short}\nLes.") for i in range(10)]
    rows += [(20, f"first\n{long}\nplain"), (21, f"second\n{long}"), (30, "copied " * 40 + "\nLes"), (31, "copied " * 40 + "\nLes")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in recurring_lines(docs).collect()} == {(i, k) for i in range(10) for k in (1, 2)} | {(20, 1), (21, 1)}
    kept = {r.doc_id: r.text for r in drop_recurring_lines(docs).collect()}
    assert (kept[0], kept[20], kept[21], kept[30]) == ("owna text", "first\nplain", "second", rows[12][1])
    assert {tuple(r) for r in recurring_lines(docs).collect()} == brute_lines(rows, 10)


def test_recurring_lines_equal_brute_force(spark, many_partitions):
    draw = random.Random(2)
    rows = []
    for d in range(40):
        own = [" ".join(draw.choice("abcdefgh") * 3 for _ in range(draw.randint(1, 7))) for _ in range(5)]
        own += [f"User u{d} logged in from host {draw.choice('xyz')} today", f"  id\t{d}  fixed   words here "]
        rows.append((d, "\n".join(own)))
    rows += [(40, None), (41, ""), (None, rows[0][1]), (3, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("leaf", F.lit(1))
    got = {tuple(r) for r in recurring_lines(docs, min_documents=4).collect()}
    assert got == brute_lines(rows, 4)
    kept = drop_recurring_lines(docs, min_documents=4).collect()
    assert len(kept) == len(rows)
    assert all("logged in" not in r.text and "fixed" not in r.text for r in kept)
    assert [(r.n_lines, r.n_dropped) for r in kept if r.doc_id in (40, 41)] == [(1, 0)] * 2


def test_lines_go_by_text_where_ids_are_null_or_repeated(spark):
    """The recurring line stands at another place in each text; without an id, each text counts."""
    line = "please accept all cookies now"
    bodies = [[f"clean{'abcdefghij'[i]}{'abcdefghij'[j]} " * 5 for j in range(8)] for i in range(8)]
    rows = [(None if i < 6 else 77, "\n".join([*b[:i], line, *b[i:]])) for i, b in enumerate(bodies)]
    want = sorted((repr(d), "\n".join(b), 9, 1) for (d, _), b in zip(rows, bodies))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((repr(r.doc_id), *r[1:]) for r in drop_recurring_lines(docs, min_documents=7).collect()) == want
    assert sum(r.n_dropped for r in drop_recurring_lines(docs, min_documents=8).collect()) == 0


def test_line_operator_takes_odd_tables(corpus, corpus_rows, empty):
    assert drop_recurring_lines(corpus, min_documents=2).count() == len(corpus_rows)
    assert drop_recurring_lines(empty).count() == 0


URLS = [None, "", "no scheme", "http://", "HTTP://A.Net", "http://a.net/x", "http://ÄB.example.NET/en/1?q", "x://y://z.org/fr/#f", "http://org/fr/",
        "https://example.com/de/a", "https://notexample.com/de/a", "https://u@h.example.com:8/de/?", "a://b.org/fr", "//x/y", "http://h?x=/de/"]


def test_url_parts_and_rules(spark):
    rows = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("host", F.lit("clash"))
    host, path = url_cascade.url_host("url"), url_cascade.url_path("url")
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    rule, verdict = url_cascade.rule_of(F.col("h"), F.col("p"), rules)
    got = rows.select("page_id", host.alias("h"), path.alias("p")).select("page_id", "h", "p", rule.alias("r"), verdict.alias("v")).collect()
    for r in got:
        url = URLS[r.page_id] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        h = re.match("[^/?#]*", rest)[0]
        p = re.match("[^?#]*", rest[len(h):])[0]
        h = re.sub("[A-Z]", lambda m: m[0].lower(), h)
        fits = [(a + b, v) for v, a, b in rules if (h == a or h.endswith("." + a)) and p.startswith(b)]
        assert (r.h, r.p, r.r, r.v) == (h, p, *max(fits, key=lambda f: len(f[0]), default=(None, None)))


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_cascade_is_exact(spark, block_bytes):
    draw = random.Random(3)
    keys = [f"host{i}.example" for i in range(4000)] + ["", "é中", None]
    listed = set(draw.sample(keys[:-1], 600))
    frame = spark.createDataFrame([(k, k in listed) for k in keys] + [(keys[0], keys[0] in listed)], "host string, bad boolean")
    cascade = url_cascade.Cascade.build(frame, "host", "bad", keys_per_shard=500)
    assert cascade.n_shards > 1 and cascade.n_bytes < 4 * 600
    rows = frame.select("host", F.lit(5).alias("out"))
    got = cascade.contains(rows, "host", "in_list", block_bytes=block_bytes).collect()
    assert len(got) == len(keys) + 1
    assert all(r.in_list == (r.host in listed) and r.out == 5 for r in got)


def test_cascade_of_nothing(spark):
    frame = spark.createDataFrame([("a", False), (None, None)], "host string, bad boolean")
    for table in (frame, frame.limit(0)):
        cascade = url_cascade.Cascade.build(table, "host", "bad")
        assert not any(r.hit for r in cascade.contains(frame, "host", "hit").collect())


def brute_hits(rows, items, window):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        if item is not None and w:
            for i in range(max(1, len(w) - window + 1)):
                windows[tuple(w[i : i + window])].add(str(item))
    out = []
    for d, text in rows:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if owners := windows.get(tuple(w[i : i + size])):
                    hit.update(range(i, i + size))
                    found |= owners
        out.append((d, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [16 << 20, 200])
def test_decontamination_equals_brute_force(spark, corpus, corpus_rows, block_bytes):
    texts = [t for _, t in corpus_rows if t and len(t.split()) > 40]
    items = [(i, " ".join(t.upper().split()[5 : 5 + n])) for i, (t, n) in enumerate(zip(texts, (3, 12, 25, 1, 10, 11, 9)))]
    items += [(50, None), (51, ""), (52, "..."), (0, items[1][1]), (53, "中文"), (None, texts[2])]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("hits", F.lit(0))
    got = wu_manber.benchmark_hits(corpus, bench, window=10, block_bytes=block_bytes).collect()
    got = sorted(((r.doc_id, r.n_words, sum(x["end"] - x["first"] for x in r.runs), tuple(r["items"])) for r in got), key=repr)
    assert got == brute_hits(corpus_rows, items, 10)


def test_decontamination_of_empty_tables(spark, corpus, corpus_rows, empty):
    bench = spark.createDataFrame([(1, "river stone")], "item_id long, text string")
    assert wu_manber.benchmark_hits(empty, bench).count() == 0
    assert wu_manber.drop_contaminated(corpus, bench.limit(0)).count() == len(corpus_rows)
    kept = wu_manber.drop_contaminated(corpus, bench, window=10)
    hit = {d for d, _, n, _ in brute_hits(corpus_rows, [(1, "river stone")], 10) if n and d is not None}
    assert kept.columns == corpus.columns
    assert kept.count() == sum(d not in hit for d, _ in corpus_rows)


def test_base_spans_follow_the_patterns():
    text = "é token=secret=abcdefgh API_KEY : 'x y' PassWord='12345678' ſecret=abcdefghij AKIAAKIA AKIAABCDEFGHIJKL " + "0a" * 16 + " " + "f" * 31
    spans = secret_scan.base_spans(text)
    assert [(text[a:b], k) for a, b, k in spans] == [
        ("token=secret=abcdefgh", "assign"), ("PassWord='12345678", "assign"), ("AKIAABCDEFGHIJKL", "access"), ("0a" * 16, "hex"),
    ]


def test_secret_scan(spark, corpus, corpus_rows, empty):
    draw = random.Random(11)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    random_text = "".join(draw.choice(alphabet) for _ in range(60))
    rows = [(i, f"ünder {random_text[i:]}{random_text[:i]} more words") for i in range(30)]
    rows += [(100 + i, "antidisestablishmentarianism internationalization_of_configuration_parameters and/or/even/longer/paths " * 3) for i in range(20)]
    got = {r.doc_id: r for r in secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(s["kind"] == "random" for i in range(30) for s in got[i].spans) >= 28
    assert all(t[s["start"]:s["end"]] in t for d, t in rows for s in got[d].spans)
    assert all(dict(rows)[i][s["start"]] == dict(rows)[i].split()[1][0] for i in range(30) for s in got[i].spans)
    assert not any(got[100 + i].spans for i in range(20))
    every = secret_scan.scan_secrets(corpus).collect()
    assert len(every) == len(corpus_rows)
    for r in every:
        assert [s for s in r.spans if s["kind"] != "random"] == list(r.base)
    assert secret_scan.scan_secrets(empty).count() == 0


def test_randomness_probabilities():
    draw = np.random.default_rng(1)
    passed = 0
    for _ in range(400):
        value = "".join("0123456789abcdef"[i] for i in draw.integers(0, 16, 64))
        passed += min(secret_scan.battery(value)[2:]) >= 0.01 / 3
    assert passed >= 385
    shares = np.zeros(256)
    shares[list(b"etaoinshrdlu")] = range(12, 0, -1)
    chances = [secret_scan.chance_in_text(16.0, n, "abcdefghijklmnopqrstuvwxyz", shares / shares.sum()) for n in (20, 40, 80)]
    assert chances[0] > chances[1] > chances[2]


def test_attention_model_gradients():
    draw = np.random.default_rng(0)
    model = quality.AttentionModel.start()
    x = draw.random((7, quality.N_FEATURES)).astype(np.float64)
    doc, labels, weight = np.array([0, 0, 1, 2, 2, 2, 3]), np.array([1.0, 0, 1, 0]), np.ones(4)

    def loss():
        s = model.forward(x, doc, 4)["score"]
        return -np.mean(labels * np.log(s) + (1 - labels) * np.log(1 - s))

    found = model.gradients(x, doc, labels, weight)
    for name, d in found.items():
        w = model.weights[name]
        at = np.unravel_index(np.abs(d).argmax(), d.shape)
        w[at] += 1e-5
        high = loss()
        w[at] -= 2e-5
        low = loss()
        w[at] += 1e-5
        assert math.isclose((high - low) / 2e-5, d[at], rel_tol=1e-3, abs_tol=1e-8), name


def test_quality_learns_from_document_labels(spark, corpus, corpus_rows, empty):
    draw = random.Random(4)
    good = lambda: " ".join(draw.choice(["river", "stone", "winter", "the"]) for _ in range(draw.randint(5, 300))) + "."
    rows = [(i, good() if i % 3 else good() + " " + " ".join("$$$ %%%" for _ in range(120)) + " " + good()) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumn("label", F.lit("x"))
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)] + [(3, None), (None, 1), (900, 1)], "doc_id long, quality int")
    model = quality.fit_quality(docs, labels)
    scored = docs.select("doc_id", quality.held_out().alias("held"), quality.score_quality(docs, model).alias("score")).collect()
    held = [r for r in scored if r.held]
    assert len(held) > 40 and all((r.score >= 0.3) == (r.doc_id % 3 > 0) for r in held)
    again = quality.fit_quality(docs.repartition(2), labels.union(labels))
    assert all(np.array_equal(model.weights[k], again.weights[k]) for k in model.weights)
    every = corpus.select("doc_id", quality.score_quality(corpus, model).alias("s")).collect()
    assert len(every) == len(corpus_rows) and all(0 <= r.s <= 1 for r in every)
    assert quality.drop_low_quality(corpus, model).columns == corpus.columns
    assert empty.select(quality.score_quality(empty, model).alias("s")).count() == 0
    prior = quality.fit_quality(empty, labels)
    assert corpus.select(quality.score_quality(corpus, prior).alias("s")).first().s == 0.5


def plain_score(model, text):
    """The forward pass of one text, passage by passage, in plain loops."""
    data, size, p = text.encode(), quality.PASSAGE, model.weights
    count = max(1, (len(data) + size // 2) // size)
    bags = [data[i * size : (i + 1) * size if i + 1 < count else len(data)] for i in range(count)]
    hidden, gates = [], []
    for bag in bags:
        pairs = Counter((int(quality._CLASS[a]), int(quality._CLASS[b])) for a, b in zip(bag, bag[1:]))
        x = np.zeros(quality.N_FEATURES)
        for (a, b), n in pairs.items():
            x[a * quality._CLASSES + b] = math.sqrt(n / sum(pairs.values()))
        h = np.tanh(x @ p["E"] + p["e"])
        hidden.append(h)
        gates.append(sum(np.tanh(h @ p["V"]) / (1 + np.exp(-(h @ p["U"]))) * p["w"]))
    weights = [math.exp(g) / sum(math.exp(o) for o in gates) for g in gates]
    return 1 / (1 + math.exp(-(sum(w * h for w, h in zip(weights, hidden)) @ p["c"] + p["b"][0])))


def test_scores_equal_a_plain_forward_pass(corpus, corpus_rows):
    model = quality.AttentionModel.start(3)
    got = corpus.select("text", quality.score_quality(corpus, model).alias("s")).collect()
    assert len(got) == len(corpus_rows)
    for r in got:
        assert math.isclose(r.s, plain_score(model, r.text or ""), abs_tol=1e-5)


def test_training_reads_every_passage_of_the_sample(spark):
    """One decisive passage far inside long texts is learned; the bounds leave out whole documents, never passages."""
    plain = "the river runs past the winter stone. " * 400
    rows = [(i, plain if i % 2 else plain[:9000] + "$$$ %%% " * 100 + plain[9000:]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    scored = docs.select("doc_id", quality.score_quality(docs, quality.fit_quality(docs, labels)).alias("s")).collect()
    assert all((r.s >= 0.5) == (r.doc_id % 2 == 1) for r in scored)
    for documents, size in ((7, 1 << 30), (4000, 100_000), (4000, 10)):
        sample = quality._training_texts(docs, labels, "quality", documents, size).collect()
        assert all(r.text == rows[r.doc_id][1] and r["__label"] == r.doc_id % 2 for r in sample)
        assert len(sample) == (7 if documents == 7 else 6 if size > 10 else 0)


def test_sparse_rows_are_the_rows():
    draw = np.random.default_rng(5)
    dense = (draw.integers(0, 256, (9, quality.N_FEATURES)) * (draw.random((9, quality.N_FEATURES)) < 0.1)).astype(np.uint8)
    dense[4] = 0
    places = [np.flatnonzero(r) for r in dense]
    rows = quality.SparseRows(np.concatenate(places), np.concatenate([r[p] for r, p in zip(dense, places)]), np.array([len(p) for p in places]))
    for chosen in (np.arange(9), np.array([4]), np.array([8, 4, 0, 3])):
        assert np.array_equal(rows[chosen], dense[chosen].astype(np.float32) / 255)


def test_long_text_scores_as_all_its_passages():
    text = np.frombuffer(b"some words here. " * 5000, np.uint8)
    x, doc = quality.passages(text, np.array([0, 0, len(text)]))
    assert doc[0] == 0 and (doc == 1).sum() == (len(text) + quality.PASSAGE // 2) // quality.PASSAGE
    assert not x[0].any()
    assert packing._cut_long(text, 1000)[-1] == len(text)


def test_held_out_is_the_crc_of_the_id_as_text(spark):
    import zlib

    got = spark.range(200).withColumnRenamed("id", "doc_id").select("doc_id", quality.held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
