"""Source divergence against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from authwatch.llm import source_divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, uses long, p long"


def brute(rows, min_docs=10, top=10):
    groups, held = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in ((t or "", a or "", s or "") for t, a, s in rows):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        terms = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower))
        groups[lang, source].update(terms)
        held[lang].update(set(terms))
    kept = {lang: sorted(t for t, n in c.items() if n >= min_docs) for lang, c in held.items()}

    def shares(counts, terms):
        total = sum(counts[t] for t in terms)
        return {t: 1 + 10 ** 9 * (counts[t] + 2) // (total + 2 * len(terms)) for t in terms}

    p = {(lang, s): shares(c, kept[lang]) for (lang, s), c in groups.items()}
    q = {lang: shares(sum((c for (a, _), c in groups.items() if a == lang), Counter()), terms)
         for lang, terms in kept.items()}
    f = lambda x, y: (x - y) ** 2 // (x + y)
    out = []
    for lang, source in p:
        own, ref = p[lang, source], q[lang]
        pairs = [(-sum(f(own[t], p[lang, s][t]) for t in own), s.encode())
                 for a, s in p if a == lang and s != source]
        terms = [(-f(own[t], ref[t]), t.encode()) for t in own
                 if groups[lang, source][t] > 0 and own[t] > ref[t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, top)):
            out += [(lang, source, part, item.decode(), -value, n + 1)
                    for n, (value, item) in enumerate(sorted(items)[:most])]
    return sorted(out)


def audited(spark, rows, parts=4, **options):
    df = spark.createDataFrame([(n, *r, "x", 1, 2) for n, r in enumerate(rows)], SCHEMA)
    return sorted(map(tuple, source_divergence.audit(df.repartition(parts), **options).collect()))


WORDS = ["a", "the", "Tea", "été", "ÉTÉ", "word", "eightlet", "nineletrs", "sixteenletters16",
         "seventeenletters7", "x" * 40, "日本語テキスト", "日本", "x" * 33, "k9z", "don't", "B2B"]


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_counting(spark, monkeypatch, seed):
    rng = random.Random(seed)
    rows = [(" ".join(rng.choices(WORDS, k=rng.choice([0, 1, 5, 40]))),
             rng.choice(["en", "en", "en", "fr", None]),
             rng.choice(["hot"] * 5 + ["a", "b", "c", "d", None])) for _ in range(150)]
    monkeypatch.setattr(source_divergence, "BATCH_BYTES", 2000)
    monkeypatch.setattr(source_divergence, "BUCKET_TERMS", 5)
    if seed:  # several blocks of sources
        monkeypatch.setattr(source_divergence, "BLOCK", 2)
        monkeypatch.setattr(source_divergence, "TERMS_AT_ONCE", 3)
    want = brute(rows, min_docs=3, top=4)
    assert audited(spark, rows, min_docs=3, top=4) == want


def test_odd_rows(spark):
    line = "one two three\x00four_five "
    rows = [(None, None, None), ("", "en", "a"), ("  12 \n", "en", "b"), (line * 40000, "en", "c"),
            ("y" * 300_000, "en", "c"), ("É" * 300, "fr", None)] + [(line, "en", "d")] * 12
    want = brute(rows)
    assert audited(spark, rows) == want
    assert {r[:4] for r in want if r[2] == "pair"} >= {("en", "a", "pair", "b")}
    assert audited(spark, []) == []
    assert audited(spark, [("a few words", "en", "x"), ("other", "en", "y")]) == [
        ("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_runs_are_counted_with_their_documents():
    parts = [b"Tea tea TEA abcdefgh abcdefghi", b"tea", b"", b"abcdefghi tea"]
    got = sorted((int(g), t, int(u), int(d))
                 for groups, uses, held, terms in source_divergence.count_terms(
                     parts, np.array([0, 0, 1, 1]))
                 for g, t, u, d in zip(groups, terms.to_pylist(), uses, held, strict=True))
    assert got == [(0, "abcdefgh", 1, 1), (0, "abcdefghi", 1, 1), (0, "tea", 4, 2),
                   (1, "abcdefghi", 1, 1), (1, "tea", 1, 1)]
