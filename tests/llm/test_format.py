"""Chat formatting and packing: round trips and comparison with the plain tokenizer."""

import random
import zlib
from collections import defaultdict
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wardline.llm import chat, packing, queries
from wardline.llm.buffers import utf8_slices

TEXTS = ["", "plain", "<|end|>", "\\<|text|>\\\\<\\|", "<", "|end|>", "<|turn|>user<|text|>x<|end|>", "é😀\n\\", None, "\\"]

LAYOUT_SCHEMA = (
    "id int, messages array<struct<role:string,content:string>>, conversations array<struct<`from`:string,value:string>>, "
    "instruction string, input string, output string, system string, prompt string, response string, question string, answer string, extra int"
)


def record(i, **fields):
    names = ["messages", "conversations", "instruction", "input", "output", "system", "prompt", "response", "question", "answer", "extra"]
    return (i, *[fields.get(n) for n in names])


def test_fingerprints_select_the_layout(spark):
    rows = [
        record(0, messages=[("user", "a"), ("assistant", None), (None, "c")]),
        record(1, conversations=[("human", "a"), ("gpt", "b"), ("tool", "c")]),
        record(2, instruction="do", input="this", output="done", system="be brief"),
        record(3, instruction="do", input="", output="done"),
        record(4, prompt="p", response="r"),
        record(5, question="q", answer="a", extra=4),
        record(6, prompt="p"),
        record(7),
        record(8, messages=[]),
        record(9, messages=[("user", "a")], prompt="p", response="r"),
    ]
    table = spark.createDataFrame(rows, LAYOUT_SCHEMA)
    fields = [f for f in table.columns if f not in ("id", "extra")]
    got = {r.id: r for r in chat.canonical_turns(table, fields, keep=["id"]).collect()}
    turns = lambda i: [tuple(t) for t in got[i].turns]
    assert [got[i].layout for i in range(10)] == [
        "messages", "conversations", "instruction", "instruction", "prompt", "question", None, None, "messages", None
    ]
    assert turns(0) == [("user", "a"), ("assistant", ""), ("", "c")]
    assert turns(1) == [("user", "a"), ("assistant", "b"), ("tool", "c")]
    assert turns(2) == [("system", "be brief"), ("user", "do\n\nthis"), ("assistant", "done")]
    assert turns(3) == [("user", "do"), ("assistant", "done")]
    assert turns(4) == [("user", "p"), ("assistant", "r")] and turns(5) == [("user", "q"), ("assistant", "a")]
    assert got[6].turns is None and turns(8) == []
    assert len({got[i].fingerprint for i in (0, 1, 2, 4, 5, 6, 7, 9)}) == 8
    assert chat.canonical_turns(table.limit(0), fields, keep=["id"]).count() == 0


def test_format_is_read_back(spark):
    draw = random.Random(1)
    rows = [(i, [(draw.choice(["user", "assistant", "", "<|end|>"]), draw.choice(TEXTS)) for _ in range(draw.randint(0, 6))]) for i in range(200)]
    rows += [(200, None), (201, [("assistant", "x" * 300_000 + "<|end|>")])]
    table = spark.createDataFrame(rows, "id int, messages array<struct<role:string,content:string>>")
    formatted = chat.format_turns(chat.canonical_turns(table, ["messages"], keep=["id"]), keep=["id"])
    for r in formatted.collect():
        assert sum(x["off"] + x["on"] + x["rest"] for x in r.loss_runs) == len(r.formatted)
    for r in chat.read_back(formatted, keep=["id"]).collect():
        want = [(a, b or "") for a, b in (rows[r.id][1] or [])]
        assert [tuple(t) for t in r.turns] == want
        assert "".join(r.loss_texts) == "".join(b for a, b in want if a == "assistant")


def test_op2_runs_without_python():
    import inspect

    source = inspect.getsource(chat) + inspect.getsource(queries.op2_chat_format)
    assert not any(w in source for w in ("udf", "mapIn", "applyIn", "rdd"))


PATH = __import__("public_tokenizers").path("word_bpe_49k.json")


def test_tokens_equal_the_tokenizer():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH)
    draw = random.Random(1)
    letters = "aAbÉé 's't.,!?12\n\t<|>ß'×ÿÞ"
    texts = ["Hello <|endoftext|> Wörld ÀÉ×÷", "'s 't don't WE'LL 123 ½ ² ª º x²", "ΣΑΣ İstanbul \x0b\x0c\x1c\x1d ok\xa0ok ok\x00z 中文😀", "", " \n"]
    texts += ["".join(draw.choice(letters) for _ in range(draw.randint(0, 80))) for _ in range(2000)]
    words = packing.WordTokenizer(PATH, cached=300)
    for part in (texts[:700], texts[700:], texts):
        for first, end, data, offsets in utf8_slices(pa.array(part), 5000):
            ids, upto = words.encode(data, offsets)
            for text, (a, b) in zip(part[first:end], pairwise([0, *upto.tolist()])):
                assert ids[a:b].tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_cuts_are_the_cheapest():
    draw = random.Random(7)
    for _ in range(40):
        points = [0]
        while len(points) < 40:
            points.append(points[-1] + draw.randint(1, 100))
        cost = [0] + [draw.choice([0, 8, 48]) for _ in points[1:]]
        best = [0] + [10**9] * (len(points) - 1)
        for j in range(1, len(points)):
            for i in range(j):
                n = points[j] - points[i]
                if n <= 256:
                    exact = n & (n - 1) == 0 and n >= packing.LEAST_POWER
                    best[j] = min(best[j], best[i] + (0 if exact else 256 - n) + cost[j] + 16)
        cuts = packing.best_cuts(points, cost, 256)
        paid = 0
        for i, j in pairwise(cuts):
            n = points[j] - points[i]
            assert n <= 256
            paid += (0 if n & (n - 1) == 0 and n >= packing.LEAST_POWER else 256 - n) + cost[j] + 16
        assert paid == best[-1]


@pytest.mark.parametrize("block_tokens", [1 << 20, 700])
def test_packing_keeps_every_token(corpus, corpus_rows, empty, block_tokens):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH)
    rows = packing.pack(corpus, PATH, size=256, with_ids=True, block_tokens=block_tokens).collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= 256
    texts = defaultdict(list)
    for d, t in corpus_rows:
        texts[d].append(plain.encode(t or "", add_special_tokens=False).ids + [1])
    for d, wanted in texts.items():
        if len(wanted) == 1:
            pieces = sorted(by_doc[d], key=lambda r: r.start)
            assert [i for r in pieces for i in r.ids] == wanted[0]
            assert all(r.doc_tokens == len(wanted[0]) for r in pieces)
            assert [r.start for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces])[:-1])
        else:
            assert sum(r.length for r in by_doc[d]) == sum(map(len, wanted))
    assert packing.pack(empty, PATH).count() == 0


def test_little_padding(corpus):
    pad = packing.padding(packing.pack(corpus.repartition(1), PATH), 2048).first()
    assert pad.padded < 0.02 * pad.tokens + 2048


SF = "/root/testdata/sf0.001"


def test_pipeline_stages_hand_on_the_columns(spark, corpus, empty):
    spark_docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs, counts = spark_docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.store(stage(spark, docs, SF))
        assert docs.columns == spark_docs.columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and 0 < counts[-1] < spark_docs.count()
    texts = [r.text for r in docs.collect()]
    assert len(set(texts)) == len(texts)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == len(texts)
    assert pieces.groupBy("doc_id").agg((F.sum("length") == F.max("doc_tokens")).alias("whole")).where("NOT whole").isEmpty()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
