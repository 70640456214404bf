"""The suffix tree against a plain one, and its probabilities."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from llm_helpers import SF_DIR
from pyspark.sql import functions as F

from authwatch.llm import suffix_tree_lm as lm
from authwatch.llm.queries import QUERIES

END = None


def tokens_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), END]


class Plain:
    """The same tree from dictionaries."""

    def __init__(self, texts):
        self.texts = [tokens_of(t) for t in texts]
        self.uses = [Counter() for _ in range(3)]
        for text in self.texts:
            for n in range(len(text)):
                for size in range(3):
                    if n >= size:
                        self.uses[size][tuple(text[n - size:n + 1])] += 1
        self.total, self.known = sum(map(len, self.texts)), len(self.uses[0])
        self.states = {}
        for size in (1, 2):
            saved = {}
            for text in self.texts:
                for n in range(size, len(text)):
                    context = tuple(text[n - size:n])
                    count = self.uses[size - 1][context]
                    if count < lm.OCCURRENCES:
                        continue
                    base = self.prob(text, n, size - 1, left=1)
                    own = (self.uses[size][*context, text[n]] - 1) / (count - 1)
                    bits = np.log2(1 - lm.WEIGHTS + lm.WEIGHTS * own / base)
                    saved[context] = saved.get(context, 0) + np.rint(bits * lm.UNIT)
            for context, bits in saved.items():
                if bits.max() >= lm.DIVERGENCE * lm.UNIT * self.uses[size - 1][context]:
                    self.states[context] = lm.WEIGHTS[bits.argmax()]

    def prob(self, text, n, longest=2, left=0):
        p = ((self.uses[0][text[n],] + 1 - left) / (self.total + self.known + 1 - left))
        for size in range(1, longest + 1):
            context = tuple(text[n - size:n]) if n >= size else ()
            if context in self.states:
                weight = self.states[context]
                own = ((self.uses[size][*context, text[n]] - left)
                       / (self.uses[size - 1][context] - left))
                p = weight * own + (1 - weight) * p
        return p

    def scores(self, text):
        text = tokens_of(text)
        counts = [self.uses[0][t,] for t in text]
        base = sum(math.log10((c + 1) / (self.total + self.known + 1)) for c in counts)
        own = sum(math.log10(self.prob(text, n)) for n in range(len(text)))
        return len(text), sum(c > 0 for c in counts), self.total, base, own


def check(rows, held, spark, parts=3):
    model = Plain([t for i, t in rows if not held(i)])
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows],
                               "doc_id long, text string, block long, doc string, kind int")
    got = lm.score_texts(df.repartition(parts), ~F.udf(held, "boolean")("doc_id")).collect()
    texts = sorted(rows, key=repr)
    got = sorted(got, key=lambda r: (repr(r.doc_id), r.n_tokens))
    assert len(got) == len(rows)
    by_id = {}
    for i, t in texts:
        by_id.setdefault(i, []).append(model.scores(t))
    for r in got:
        assert r.held_out == bool(held(r.doc_id))
        assert any(r[2:5] == w[:3] and r[5:7] == pytest.approx(w[3:], rel=1e-9, abs=1e-9)
                   for w in by_id[r.doc_id]), (r, by_id[r.doc_id])
    return model, got


def prose(seed, count):
    """Texts in which the next word depends on the last one or two."""
    rng = random.Random(seed)
    follow = {w: rng.choices("abcdefgh", k=2) for w in "abcdefgh"}
    out = []
    for n in range(count):
        words = rng.choices("abcdefghXYZ", k=3)
        for _ in range(rng.choice([0, 5, 60])):
            words.append("q" if words[-2:] == ["b", "c"] else rng.choice(
                follow.get(words[-1].lower(), "abcdefgh")) if rng.random() < 0.8
                else rng.choice("abcdefgh" + "mnop"))
        out.append((n, " ".join(words) if n % 9 else f"rare{n} words"))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_equals_a_plain_tree(spark, monkeypatch, seed):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 700)
    monkeypatch.setattr(lm, "LEAST_BITS", 2)
    rows = prose(seed, 120)
    model, got = check(rows, lambda i: i % 5 == 0, spark)
    assert {len(c) for c in model.states} == {1, 2}
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 0.9 * sum(r.base_score for r in held)


def test_states_give_probabilities_that_add_up_to_one():
    model = Plain([t for _, t in prose(5, 150)])
    words = [w for w, in model.uses[0]] + ["unknown"]
    for context in [(), *model.states]:
        text = [*context, None]
        total = 0.0
        for word in words:
            text[-1] = word
            total += model.prob(text, len(context))
        assert total == pytest.approx(1)


def test_odd_rows(spark, odd_rows):
    check(odd_rows + [(90, "word " * 30_000), (91, "y" * 200_000)],
          lambda i: i is not None and i % 3 == 0, spark)
    check([(1, "a b"), (2, None)], lambda i: True, spark)
    df = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score_texts(df, F.lit(True)).count() == 0


def test_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    held = {i: crc32(str(i).encode()) % 7 == 2 for i in docs}
    model = Plain([docs[i] for i in docs if not held[i]])
    got = QUERIES["op13_suffix_tree_lm"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        want = model.scores(docs[r.doc_id])
        assert r.held_out == held[r.doc_id] and r[2:5] == want[:3]
        assert r[5:7] == pytest.approx(want[3:], rel=1e-9)
    asked = [r for r in got if r.held_out]
    assert sum(r.score for r in asked) > sum(r.base_score for r in asked)
    assert sum(r.n_in_context for r in asked) > 0
