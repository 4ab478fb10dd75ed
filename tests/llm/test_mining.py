"""Collocations, hard negatives and the rule ledger against brute force."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.llm import collocations as C
from wardline.llm import hard_negatives as H
from wardline.llm import rule_ledger as R


def brute_phrases(rows, min_count, cover_pct, top):
    f = collections.Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = [x for x in re.split("[ \t]+", piece) if x]
            f.update((lang or "und", *w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    found = {p: a for p, a in f.items() if len(p) > 2 and a >= min_count}
    out = collections.defaultdict(list)
    for p, a in found.items():
        longer = [b for q, b in found.items() if len(q) > len(p) and q[0] == p[0] and any(q[i : i + len(p) - 1] == p[1:] for i in range(1, len(q)))]
        if any(100 * b >= cover_pct * a for b in longer):
            continue
        cuts = [(2000000 * a // (f[p[:j]] + f[(p[0], *p[j:])]), j, f[p[:j]], f[(p[0], *p[j:])]) for j in range(2, len(p))]
        score, _, left, right = min(cuts)
        out[p[0]].append((-score, -a, " ".join(p[1:]).encode(), left, right))
    rows = []
    for lang, phrases in out.items():
        n = sum(a for p, a in f.items() if len(p) == 2 and p[0] == lang)
        rows += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(phrases)[:top], 1)]
    return sorted(rows)


@pytest.fixture(scope="module")
def phrase_rows():
    draw = random.Random(2)
    words = ["A", "b", "Bé", "ç", "d\x01", "d", "river\x00", "stone", "a a", "-"]
    rows = [(draw.choice(["en", "de", None, "und"]), " ".join(draw.choice(words) + draw.choice(["", "", "", ".", "\t", "\n", ", "]) for _ in range(draw.randint(0, 60)))) for _ in range(120)]
    return [*rows, ("en", None), ("en", ""), ("fr", " .,; "), (None, "x " * 4000), ("en", "hot pair " * 500), *[("de", "one same text of copies")] * 40]


@pytest.mark.parametrize(("shard", "range_bytes", "bits"), [(6 << 20, 16 << 20, 1 << 26), (300, 2_000, 1 << 10)])
def test_collocations(spark, phrase_rows, shard, range_bytes, bits):
    docs = spark.createDataFrame(phrase_rows, "lang string, text string").repartition(3).withColumns({c: F.lit(1) for c in ("phrase", "a", "f", "words", "score", "rank")})
    for min_count, top in ((3, 2000), (8, 7)):
        got = C.collocations(docs, min_count=min_count, top=top, shard_bytes=shard, range_bytes=range_bytes, filter_bits=bits)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == brute_phrases(phrase_rows, min_count, 80, top)
    assert C.collocations(docs.limit(0)).count() == 0


def test_collocations_of_words_that_are_languages(spark):
    """Shards with and without a language are cut alike at paths through a word of that name."""
    draw = random.Random(11)
    langs = ["fr"] * 60 + ["de"] * 5 + [draw.choice(["en", "de", "fr", None]) for _ in range(85)]
    rows = [(lang, " ".join(draw.choice(["en", "de", "fr", "und", "la", "a"]) for _ in range(draw.randint(0, 60)))) for lang in langs]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = C.collocations(docs, min_count=3, shard_bytes=300, range_bytes=1_000, filter_bits=1 << 12)
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, 3, 80, 2000)


def test_minimal_automaton():
    draw = random.Random(7)
    paths = sorted({tuple(draw.choice([b"a", b"ab", b"b", b"c"]) for _ in range(draw.randint(1, 5))) for _ in range(300)})
    automaton = C.MinimalAutomaton()
    for i, p in enumerate(paths):
        automaton.add(p, 1000 + i)
    assert [automaton.weight(p) for p in paths] == list(range(1000, 1000 + len(paths)))
    missing = {tuple(draw.choice([b"a", b"ab", b"b", b"c", b"x"]) for _ in range(draw.randint(1, 6))) for _ in range(300)} - set(paths)
    assert all(automaton.weight(p) is None for p in missing)
    assert len(automaton.states) < len(paths) / 2


def brute_negatives(rows):
    fit = [(i, y, [int(np.floor(256 * np.float64(x))) for x in v]) for i, y, v in rows
           if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, y, v in fit:
        if i % 10:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, z == y) for j, z, w in fit if j != i)
        for s, j, _ in [x for x in scored if x[2]][:5]:
            fits = [(t, k) for t, k, same in scored if not same and 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize(("dims", "block"), [(70, 4 << 20), (3, 64), (1, 8)])
def test_hard_negatives(spark, dims, block):
    draw = random.Random(dims)
    rows = [(i, draw.randint(0, 2), [draw.gauss(0.3, 0.5) for _ in range(dims)]) for i in range(300)]
    rows += [(300, 1, [0.0] * dims), (310, 1, [-1.0] * dims), (None, 1, [1.0] * dims), (311, None, [1.0] * dims), (312, 1, None), (313, 1, [None] * dims),
             (314, 1, [float("nan")] * dims), (315, 1, [float("inf")] * dims), (316, 2, []), (317, 2, [0.5]), rows[20], rows[20], rows[7], (8, 2, rows[8][2])]
    rows += [(400 + i, 2, [0.5] * dims) for i in range(30)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(3).withColumns({c: F.lit(1) for c in ("id", "score", "ints", "rank")})
    got = H.hard_negatives(table, F.col("vec_id") % 10 == 0, block_bytes=max(block, 8 * dims))
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows)


def test_hard_negatives_of_odd_tables(spark):
    schema = "vec_id long, label int, embedding array<float>"
    for rows in ([], [(1, 1, [1.0])], [(None, None, None)], [(10, 1, [])]):
        assert H.hard_negatives(spark.createDataFrame(rows, schema), F.col("vec_id") % 10 == 0).count() == 0


def test_intervals_hold():
    draw = np.random.default_rng(3)
    for dims in (1, 5, 64, 100):
        ints, asked = draw.integers(-300, 300, (200, dims)), draw.integers(-300, 300, (9, dims))
        ints[0], asked[0] = 0, 0
        turn = H.rotation(dims)
        codes, queries, true = H.Codes.of(ints, turn), H.Queries(asked, turn), asked @ ints.T
        lower, upper, estimate = queries.bounds(codes, None, 0)
        pairs = np.nonzero(np.ones_like(true))
        widths = [(upper - lower).mean()]
        assert (lower <= true).all() and (true <= upper).all()
        estimate = estimate[pairs]
        for level in range(1, H.LEVELS):
            lower, upper, estimate = queries.bounds(codes, pairs, level, estimate)
            assert (lower <= true[pairs]).all() and (true[pairs] <= upper).all()
            widths.append((upper - lower).mean())
        assert dims < 5 or widths[-1] < widths[0]


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    fives = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = collections.Counter(fives)
    covered = {i + j for i, f in enumerate(fives) if count[f] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    letter = lambda c: c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" or ord(c) > 127
    trimmed = [x.strip(" \t\r\x0b\x0c") for x in lines]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(lines),
            sum(map(letter, text)), sum("A" <= c <= "Z" for c in text), sum(any(map(letter, w)) for w in words),
            sum(x[0] in "-*•" for x in trimmed), sum(x.endswith(("...", "…")) for x in trimmed))


@pytest.fixture(scope="module")
def rule_rows(corpus_rows):
    return [*corpus_rows, (200, "- a\n* b\n• c\n- a \n- a\nend...\nso…\t\n"), (201, "THE ## $$ 12 %%% " * 30), (202, "a b c d e f " * 3), (203, "\n".join(["same line"] * 9))]


def test_rule_ledger(spark, rule_rows, empty):
    docs = spark.createDataFrame(rule_rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit(1) for c in ("n_words", "failed", "bit", "n")})
    ledger = R.rule_ledger(docs)
    assert ledger.columns == ["doc_id", *R.MEASURES, "failed"]
    got = sorted((tuple(r) for r in ledger.collect()), key=repr)
    want = []
    for d, t in rule_rows:
        m = dict(zip(R.MEASURES, brute_measures(t)))
        failed = [m["n_words"] < 10, 100 * m["n_repeat_words"] > 20 * m["n_words"], False, 10 * m["word_chars"] < 25 * m["n_words"], m["word_chars"] > 12 * m["n_words"],
                  10 * m["n_symbols"] > m["n_words"], 100 * m["n_dup_lines"] > 30 * m["n_lines"], 100 * m["n_letter_words"] < 80 * m["n_words"],
                  100 * m["n_upper"] > 60 * m["n_letters"], 100 * m["n_bullet_lines"] > 90 * m["n_lines"], 100 * m["n_ellipsis_lines"] > 30 * m["n_lines"]]
        want.append((d, *m.values(), sum(1 << i for i, x in enumerate(failed) if x)))
    assert got == sorted(want, key=repr)
    assert R.rule_ledger(empty).count() == 0
    for policy in R.POLICIES:
        kept = sum(r[-1] & R.mask_of(policy) == 0 for r in want)
        assert ledger.where(R.passes(policy)).count() == kept
    for r in R.ablation(ledger).collect():
        policy = next(p for p in R.POLICIES if p.version == r.policy)
        bit = 1 << next(x.bit for x in R.RULES if x.name == r.rule)
        hits = [w[-1] & R.mask_of(policy) for w in want]
        assert (r.n_docs, r.n_failed, r.n_only) == (len(want), sum(h & bit > 0 for h in hits), sum(h == bit for h in hits))
        assert (r.n_kept, r.n_kept_without) == (sum(h == 0 for h in hits), sum(h & ~bit == 0 for h in hits))
    left = R.drop_failed(docs, ledger)
    gone = {w[0] for w in want if w[-1]}
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(d) for d, _ in rule_rows if d is None or d not in gone)
    both = R.always_and_ever(ledger, ["n_lines"]).where("n_lines = 0").first()
    none = [w[-1] for w in want if w[6] == 0]
    assert (both.n_docs, both.ever, both.always) == (len(none), np.bitwise_or.reduce(none), np.bitwise_and.reduce(none))
