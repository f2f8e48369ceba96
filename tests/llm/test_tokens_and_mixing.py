import os
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioforge.llm import mixing as M
from folioforge.llm import tokens as K

PATH = os.path.join(K.TOKENIZER_DIR, K.TOKENIZER)
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no tokenizer files")


def whole(texts):
    e = K.encoder(PATH)
    return [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]


PARTS = ["a", "Zq", " ", "  ", "\n", "\t", "'", "'s", "'ll", "→", "é", "Ж", "中", "\u00a0", "\u2009", "\u3000", "\u0085", "\x1c", "1", "22", "!", "’", "<|endoftext|>", "\u200b", "x̄", "\r\n", "\x00", "½", "😀"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join) | st.text(max_size=30).filter(lambda s: s.isprintable()))
def test_equals_the_tokenizer(text):
    assert K.encoder(PATH).encode(pa.array([text])).to_pylist() == whole([text])


def test_batches(monkeypatch):
    rng = random.Random(0)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 30))) for _ in range(500)] + ["", "x" * 50_000]
    monkeypatch.setattr(K, "REMEMBERED", 50)  # the memory is emptied again and again
    assert K.ForcedBoundaryEncoder(PATH).encode(pa.array(texts)).to_pylist() == whole(texts)
    sliced = pa.array(["zz", *texts])[1:]
    assert K.encoder(PATH).encode(sliced).to_pylist() == whole(texts)


def test_table(spark):
    rows = [(1, "hello world", "x"), (2, None, "y"), (3, "", "z"), (1, "hello world", "x"), (4, "\n \n", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted((r["doc_id"], r["ids"]) for r in K.encode_corpus(df).collect())
    assert got[0] == got[1] == (1, whole(["hello world"])[0]) and got[2:4] == [(2, []), (3, [])] and got[4][1]
    assert sorted(r["n_tokens"] for r in K.count_tokens(df).collect())[:2] == [0, 0]
    assert K.encode_corpus(df.limit(0)).count() == 0


def highest_quotients(weights, seats, caps):
    out = [0] * len(weights)
    for _ in range(seats):
        best = max(((w / (2 * k + 1), -i) for i, (w, k, c) in enumerate(zip(weights, out, caps, strict=True)) if k < c and w > 0), default=None)
        if best is None:
            break
        out[-best[1]] += 1
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 40)), max_size=8), st.integers(0, 120))
def test_apportionment(parts, seats):
    weights, caps = [float(w) for w, _ in parts], [c for _, c in parts]
    assert M.sainte_lague(weights, seats, caps) == highest_quotients(weights, seats, caps)


TARGETS = "source string, target_share double, max_repeats int"


def test_mix(spark):
    rng = random.Random(2)
    word = lambda n: " ".join(rng.choice(["stone", "river", "light", "wind"]) for _ in range(n))
    docs = [(i, word(rng.randint(1, 60)), "big") for i in range(600)] + [(1000 + i, word(40), "small") for i in range(40)] + [(2000, None, "small"), (2001, "", "big"), (2002, "x", None), (2003, "x", "other")]
    targets = [("big", 0.5, 1), ("small", 0.4, 3), ("absent", 0.1, 2), (None, 0.3, 1), ("bad", float("nan"), 1), ("none", None, 1)]
    mix, report = M.mix_sources(spark.createDataFrame(docs, "doc_id long, text string, source string"), spark.createDataFrame(targets, TARGETS), plan=M.MixPlan(block_tokens=16, shard_tokens=2000))
    rows = {r["source"]: r for r in report.collect()}
    assert set(rows) == {"big", "small", "absent"}
    assert abs(rows["small"]["actual_share"] - 4 / 9) < 0.02 and rows["small"]["repeats"] == 3 and rows["absent"]["tokens"] == 0
    used = mix.collect()
    assert all(1 <= r["copies"] <= {"big": 1, "small": 3}[r["source"]] for r in used) and len({r["doc_id"] for r in used}) == len(used)
    again = M.mix_sources(spark.createDataFrame(docs[::-1], "doc_id long, text string, source string"), spark.createDataFrame(targets, TARGETS), plan=M.MixPlan(block_tokens=16, shard_tokens=2000))[0]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, used))


def test_empty_mix(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    mix, report = M.mix_sources(docs, spark.createDataFrame([("a", 1.0, 1)], TARGETS))
    assert mix.count() == 0 and report.first()["actual_share"] == 0
    mix, report = M.mix_sources(docs, spark.createDataFrame([], TARGETS))
    assert mix.count() == report.count() == 0
