"""Exact, near and substring deduplication against brute force on small tables."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wardline.llm import simhash, suffix_dedup
from wardline.llm.components import components
from wardline.llm.exact import drop_exact_copies, exact_groups


@pytest.mark.parametrize(("digest_all", "filter_words"), [(True, 1 << 19), (False, 1 << 19), (False, 1)])
def test_exact_groups(corpus, corpus_rows, digest_all, filter_words):
    groups = defaultdict(list)
    for d, t in corpus_rows:
        groups[t or ""].append(d)
    got = exact_groups(corpus, digest_all=digest_all, filter_words=filter_words).collect()
    want = []
    for d, t in corpus_rows:
        members = groups[t or ""]
        known = [x for x in members if x is not None]
        want.append((d, len((t or "").encode()), max(known) if known else None, len(members)))
    assert sorted(((r.doc_id, r.n_bytes, r.keep_id, r.group_size) for r in got), key=repr) == sorted(want, key=repr)
    if digest_all:
        assert {r.text_sha256 for r in got} == {hashlib.sha256(t.encode()).hexdigest() for t in groups}


def test_refinement_hashes_few_texts_that_occur_once(spark):
    """Whatever the number of repeated prefixes, all their rows pass the filter and few others do."""
    rows = spark.range(60_000).select(F.when(F.col("id") < 20_000, F.col("id") % 10_000).otherwise(F.col("id")).alias("doc_id"))
    rows = rows.withColumn("text", F.concat_ws(" ", F.lit("text"), "doc_id"))
    got = exact_groups(rows).groupBy((F.col("group_size") > 1).alias("copy")).agg(F.count("*").alias("n"), F.count("text_sha256").alias("hashed"))
    got = {r.copy: (r.n, r.hashed) for r in got.collect()}
    assert got[True] == (20_000, 20_000)
    assert got[False][0] == 40_000 and got[False][1] < 1_200


def test_exact_copies_leave_one_row_of_each_text(corpus, corpus_rows, empty):
    kept = drop_exact_copies(corpus)
    assert kept.columns == corpus.columns
    rows = kept.collect()
    assert sorted((r.text or "") for r in rows) == sorted({t or "" for _, t in corpus_rows})
    assert {r.doc_id for r in rows if r.text == corpus_rows[3][1]} == {66}
    assert drop_exact_copies(empty).count() == 0


def test_components(spark):
    draw = random.Random(1)
    links = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5, 5), (None, 3)]
    root = {x: x for l in links if None not in l for x in l}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    linked = {x for a, b in links if a is not None and a != b for x in (a, b)}
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, find(x)) for x in linked)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_print(text, words):
    w = text.encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(corpus, corpus_rows):
    for _, text in corpus_rows[:40] + corpus_rows[-10:]:
        assert int.from_bytes(simhash.simhash((text or "").encode(), 3), "big") == brute_print(text or "", 3)


@pytest.mark.parametrize("distance", [1, 3, 5, 7])
def test_every_pair_within_the_distance_meets_at_an_anchor(distance):
    draw = random.Random(distance)
    for _ in range(300):
        x = draw.getrandbits(64)
        y = x
        for b in draw.sample(range(64), draw.randint(0, distance)):
            y ^= 1 << b
        values = np.array([x, y], np.uint64)
        rows, keys, homes = simhash.anchors_of(values, distance)
        home = {int(k) for r, k, h in zip(rows, keys, homes) if r == 0 and h}
        assert home & {int(k) for r, k in zip(rows, keys) if r == 1}


def test_near_duplicate_groups(spark, corpus, corpus_rows, empty, many_partitions):
    prints = [brute_print(t or "", 3) for _, t in corpus_rows]
    group = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    want = []
    for i, (d, _) in enumerate(corpus_rows):
        ids = [corpus_rows[k][0] for k in range(len(prints)) if group[k] == group[i] and corpus_rows[k][0] is not None]
        want.append((d, prints[i], min(ids) if ids else None))
    got = [(r.doc_id, int.from_bytes(r.fingerprint, "big"), r.component_id) for r in simhash.near_duplicate_groups(corpus).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert simhash.near_duplicate_groups(empty).count() == 0


def test_crowded_anchor_is_linked_without_pairs(spark):
    draw = random.Random(8)
    centre = draw.getrandbits(64)
    values = {centre} | {centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)}
    frame = spark.createDataFrame([(v.to_bytes(8, "big"),) for v in values], "fingerprint binary")
    links = simhash.linked_fingerprints(frame, distance=3)
    assert links.count() < 40 * len(values)
    assert components(links).select("root").distinct().count() == 1


def test_near_duplicates_leave_one(corpus, corpus_rows, spark):
    """Long texts that differ in one word, texts without words, and the groups of the operator on the same rows."""
    draw = random.Random(3)
    base = [" ".join(draw.choice("abcdefghijklmnopqrstuvwxyz") * 2 + str(draw.randint(0, 400)) for _ in range(3000)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, t + " end") for i, t in enumerate(base)] + [(200, ""), (201, None), (202, " \n")]
    prints = {d: brute_print(t or "", 3) for d, t in rows}
    linked = {100 + i for i in range(20) if bin(prints[i] ^ prints[100 + i]).count("1") <= 3}
    assert len(linked) > 10
    kept = {r.doc_id for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == set(prints) - linked - {201, 202}
    left = simhash.drop_near_duplicates(corpus)
    assert left.columns == corpus.columns
    groups = simhash.near_duplicate_groups(corpus.where("doc_id is not null")).collect()
    gone = {r.doc_id for r in groups if r.doc_id != r.component_id}
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted(d for d, _ in corpus_rows if d is not None and d not in gone)
    assert left.where("doc_id is null").count() == sum(d is None for d, _ in corpus_rows)


def brute_removal(rows, length):
    """By (id, hash of the text), null ids first; equal rows are one document."""
    order = sorted({(d, t or "") for d, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0, np.int64(np.uint64(xxhash.xxh64_intdigest(r[1].encode(), 42)))))
    seen, out = set(), {}
    for d, t in order:
        b = t.encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            window = b[s : s + length]
            if window in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(window)
        rest = bytes(x for x, g in zip(b, gone) if not g)
        out[d, t] = (len(b), sum(gone), sum(1 for i in range(len(b)) if gone[i] and (not i or not gone[i - 1])), hashlib.sha256(rest).hexdigest())
    return out


@pytest.mark.parametrize(("max_group", "chunk"), [(100_000, 30_000), (3, 20)])
def test_repeated_strings_go(spark, corpus, corpus_rows, empty, many_partitions, monkeypatch, max_group, chunk):
    monkeypatch.setattr(suffix_dedup, "_CHUNK_ROWS", chunk)
    draw = random.Random(6)
    shared = ["".join(draw.choice("abc ") for _ in range(draw.randint(90, 260))) for _ in range(4)]
    rows = corpus_rows + [
        (200 + i, "".join(draw.choice("abcdefgh ") for _ in range(30)) + draw.choice(shared)[draw.randint(0, 60):] + str(i) + draw.choice(shared)) for i in range(40)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("doc", F.lit(0))
    want = brute_removal(rows, 100)
    got = suffix_dedup.remove_repeats(docs, max_group=max_group, digest=True).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept) for r in got if r.doc_id is not None) == sorted(
        (d, *want[d, t or ""]) for d, t in rows if d is not None
    )
    plain = [r for r in rows if r[0] is not None and r[0] not in (5, 7)]
    docs = spark.createDataFrame(plain, "doc_id long, text string").repartition(2)
    want = brute_removal(plain, 100)
    got = suffix_dedup.remove_repeats(docs, max_group=max_group).collect()
    assert len(got) == len(plain)
    for r in got:
        t = next(t for d, t in plain if d == r.doc_id)
        assert (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) == want[r.doc_id, t or ""]
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_lengths_beyond_a_byte(spark):
    draw = random.Random(9)
    text = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    shared = text(900)
    rows = [(i, text(50 + i) + shared[draw.randint(0, 300) : draw.randint(500, 900)] + text(40)) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_removal(rows, 400)
    assert sum(w[1] for w in want.values()) > 0
    got = suffix_dedup.remove_repeats(docs, length=400, digest=True).collect()
    assert sorted((r.doc_id, *r[1:2], r.n_removed, r.n_spans, r.kept) for r in got) == sorted((d, *want[d, t]) for d, t in rows)
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(docs, length=70_000)


def test_long_text_is_cut_into_overlapping_chunks(monkeypatch):
    draw = np.random.default_rng(2)
    data = draw.integers(97, 101, 5000).astype(np.uint8)
    whole = suffix_dedup.anchors(data, np.array([0, len(data)]))
    monkeypatch.setattr(suffix_dedup, "_CHUNK_BYTES", 700)
    starts = set()
    for shift, part in suffix_dedup._chunks(data, 100):
        _, _, at, first, last = suffix_dedup.anchors(part, np.array([0, len(part)]))
        starts |= {(int(a) + shift, s) for a, f, l in zip(at, first, last) for s in range(f + shift, l + shift + 1)}
    assert starts == {(int(a), s) for a, f, l in zip(*whole[2:]) for s in range(f, l + 1)}
