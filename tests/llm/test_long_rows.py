"""Texts of megabytes and conversations of many turns: offsets grow in proportion, results as by hand."""

import random
import time

from llm_support import frame

from plantmetrics.llm import chat_format, secret_scan


def test_secret_scan_of_a_long_text(spark):
    r = random.Random(2)
    words = ["".join(r.choices("etaoinshrdlu", k=18)) for _ in range(500)]
    parts, at, want = [], 0, []
    for i in range(200_000):
        w = r.choice(words)
        if i % 10 == 0:         # lists of check sums are full of base spans
            w = "".join(r.choices("0123456789abcdef", k=40)) if i % 20 else "token=" + "".join(r.choices("abcdef_", k=8))
            want.append((at, at + len(w), 2 if i % 20 else 0))
        parts.append(w)
        at += len(w) + 1
    began = time.time()
    got = secret_scan.secret_scan(frame(spark, [(1, " ".join(parts), "a")])).collect()
    took = time.time() - began
    assert [tuple(s) for s in got[0].spans if s.kind != 3] == want
    assert all(s.stop - s.start == 18 for s in got[0].spans if s.kind == 3)
    print("secret scan", at, took)
    assert took < 90


def test_chat_format_of_a_long_conversation(spark):
    n = 100_000
    turns = [(1, i, ("user", "assistant")[i % 3 == 0], f"t<|{i}|>\\é" if i % 7 else "") for i in range(n)]
    df = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    began = time.time()
    got = chat_format.read_back(chat_format.chat_format(df)).collect()[0]
    took = time.time() - began
    assert [(t.role, t.text) for t in got.turns] == [(x[2], x[3]) for x in turns]
    assert got.loss_text == "".join(x[3] for x in turns if x[2] == "assistant")
    print("chat format", took)
    assert took < 90
