"""Suffix, exact and substring dedup against plain Python."""

from __future__ import annotations

import re
from hashlib import sha256

import numpy as np
import pytest
from llm_helpers import SF_DIR, random_texts

from authwatch.llm import exact_dedup, repeats, rolling, substring_dedup, suffix_dedup

WORD = r"[^\x20\x09-\x0D]+"


def by_id(df):
    return {row[0]: tuple(row[1:]) for row in df.collect()}


def documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return docs, [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def suffix_brute(rows, width):
    first, out = set(), {}
    for key, text in sorted(rows):
        data = text.encode()
        covered = bytearray(len(data))
        for at in range(len(data) - width + 1):
            piece = data[at:at + width]
            if piece in first:
                covered[at:at + width] = b"\1" * width
            first.add(piece)
        kept = bytes(b for b, c in zip(data, covered) if not c)
        spans = len(re.findall(b"\1+", bytes(covered)))
        out[key] = (len(data), sum(covered), spans, sha256(kept).hexdigest())
    return out


def substring_brute(rows, width):
    first, out = {}, {}
    for key, text in sorted(rows):
        words = re.findall(WORD, text)
        covered = bytearray(len(words))
        for at in range(len(words) - width + 1):
            if first.setdefault(tuple(words[at:at + width]), key) != key:
                covered[at:at + width] = b"\1" * width
        kept = " ".join(w for w, c in zip(words, covered) if not c)
        out[key] = (len(words), sum(covered), sha256(kept.encode()).hexdigest())
    return out


def exact_brute(rows):
    plain = {key: re.sub(r"[\x20\x09-\x0D]+", " ", text or "") for key, text in rows}
    groups = {}
    for key, text in plain.items():
        groups.setdefault(text, []).append(key)
    return {key: (min(groups[text]), len(groups[text]), key == min(groups[text]),
                  sha256(text.encode()).hexdigest()) for key, text in plain.items()}


@pytest.mark.parametrize("operator, brute, width", [
    (suffix_dedup.remove_earlier, suffix_brute, 100),
    (substring_dedup.remove_repeated, substring_brute, 13)])
def test_whole_table(spark, operator, brute, width):
    docs, rows = documents(spark)
    assert by_id(operator(docs)) == brute(rows, width)


@pytest.mark.parametrize("width, k, split", [(8, 3, 2), (5, 2, 1000)])
def test_dense_repeats(frame, monkeypatch, width, k, split):
    """Few letters, so that everything repeats; large groups are split or not."""
    monkeypatch.setattr(repeats, "SPLIT_FROM", split)
    texts = random_texts(5, 60, ["a", "b", "é", "ab"], 200) + ["a" * 300, "ab" * 200]
    rows = list(enumerate(texts)) + [(100 + n, texts[n][3:]) for n in range(20)]
    got = by_id(suffix_dedup.remove_earlier(frame(rows), width=width, k=k))
    assert got == suffix_brute(rows, width)


@pytest.mark.parametrize("width, k, split", [(6, 2, 2), (5, 2, 1000)])
def test_dense_word_repeats(frame, monkeypatch, width, k, split):
    monkeypatch.setattr(repeats, "SPLIT_FROM", split)
    texts = random_texts(6, 60, ["a", "bé", "cc"], 200) + ["a " * 300, "ab\n" * 200]
    rows = list(enumerate(texts)) + [(100 + n, texts[n][3:]) for n in range(20)]
    got = by_id(substring_dedup.remove_repeated(frame(rows), width=width, k=k))
    assert got == substring_brute(rows, width)


def test_suffix_sort_and_a_hash_collision(monkeypatch):
    rng = np.random.default_rng(0)
    symbols = rng.integers(0, 2, 400).astype(np.uint8)
    starts, bucket = np.arange(380), np.zeros(380, np.int64)
    order = suffix_dedup.suffix_order(symbols, rolling.PrefixHash(symbols), starts, bucket, 20)
    want = sorted(range(380), key=lambda s: (symbols[s:s + 20].tobytes(), s))
    assert order.tolist() == want
    plain = suffix_dedup.starts_earlier(symbols, starts, bucket, 20)
    # Every hash equal: the bytes decide.
    monkeypatch.setattr(rolling.PrefixHash, "of", lambda self, a, b: np.zeros(len(a), np.uint64))
    assert suffix_dedup.starts_earlier(symbols, starts, bucket, 20).tolist() == plain.tolist()


def test_long_documents_are_cut_in_segments(frame, monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 64)
    bounds = np.array([0, 10, 210, 210, 500])
    stretch, begin, stop = repeats.segments(bounds, 8)
    windows = {(d, at) for d, a, b in zip(stretch, begin, stop) for at in range(a, b - 7)}
    assert windows == {(d, at) for d in range(4) for at in range(bounds[d], bounds[d + 1] - 7)}


def test_blocks_hold_each_window_once():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 4, 300).astype(np.uint8)
    bounds = np.array([0, 5, 105, 300])
    blocks = rolling.find_blocks(rolling.PrefixHash(symbols), bounds, 10, 4)
    got = [at for s, n in zip(blocks.start, blocks.windows) for at in range(s, s + n)]
    assert sorted(got) == [*range(5, 96), *range(105, 291)]
    assert all(s <= a <= s + 6 for s, a in zip(blocks.start + blocks.windows - 1, blocks.anchor))


@pytest.mark.parametrize("operator", [
    suffix_dedup.remove_earlier, substring_dedup.remove_repeated, exact_dedup.mark_copies])
def test_odd_rows_and_empty_tables(frame, odd_rows, operator):
    got = operator(frame(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    assert operator(frame([])).count() == 0


def test_a_repeated_row_is_no_repetition_of_itself(frame):
    text = " ".join(map(str, range(200)))
    for operator in (suffix_dedup.remove_earlier, substring_dedup.remove_repeated):
        rows = operator(frame([(4, text), (4, text), (5, text)])).collect()
        assert sorted((r[0], r["n_removed"] > 0) for r in rows) == [
            (4, False), (4, False), (5, True)]


@pytest.mark.parametrize("frequent", [2, 1000])
def test_exact_dedup(spark, frame, frequent):
    rows = [(n, f"text \n {n % 7}" + " " * (n % 3)) for n in range(100)] + [(200, None), (201, "")]
    got = by_id(exact_dedup.mark_copies(frame(rows), tracked=16, frequent=frequent))
    assert got == exact_brute(rows)
    docs, rows = documents(spark)
    assert by_id(exact_dedup.mark_copies(docs, frequent=3)) == exact_brute(rows)


def long_rows():
    """Very long texts that share stretches, one of them alone in being long."""
    words = [f"w{n * 7919 % 60_013}" for n in range(40_000)]
    whole = " ".join(words)
    return [(1, "short text"), (2, whole), (3, " ".join(words[10_000:20_000]) + " own end"),
            (4, whole + " tail"), (5, "é" * 120_000), (6, " ".join(words[5:25])), (7, whole)]


def test_very_long_texts(frame):
    rows = long_rows()
    assert by_id(substring_dedup.remove_repeated(frame(rows))) == substring_brute(rows, 13)
    assert by_id(exact_dedup.mark_copies(frame(rows))) == exact_brute(rows)
    few = [r for r in rows if r[0] != 5]
    assert by_id(suffix_dedup.remove_earlier(frame(few))) == suffix_brute(few, 100)


OPERATORS = [(suffix_dedup.remove_earlier, suffix_brute, 12),
             (substring_dedup.remove_repeated, substring_brute, 5)]


def blind_at_first(seen):
    """Digests that are all equal in the first attempt."""
    real = repeats.digest_of
    return lambda piece, salt: real(piece, salt) if salt else seen


@pytest.mark.parametrize("operator, brute, width", OPERATORS)
def test_blocks_with_equal_digests_are_told_apart(frame, monkeypatch, operator, brute, width):
    texts = random_texts(9, 40, ["a", "bé", "cc", "dd"], 120)
    rows = list(enumerate(texts)) + [(100 + n, texts[n][4:]) for n in range(20)]
    attempts = []
    real = repeats.claims_hold
    monkeypatch.setattr(repeats, "claims_hold", lambda x: attempts.append(real(x)) or attempts[-1])
    monkeypatch.setattr(repeats, "digest_of", blind_at_first(b"\0" * 8))
    assert by_id(operator(frame(rows), width=width, k=3)) == brute(rows, width)
    assert attempts == [False, True]


@pytest.mark.parametrize("operator, brute, width", OPERATORS)
def test_digests_that_never_differ_raise(frame, monkeypatch, operator, brute, width):
    rows = list(enumerate(random_texts(9, 40, ["a", "bé", "cc", "dd"], 120)))
    monkeypatch.setattr(repeats, "digest_of", lambda piece, salt: b"\0" * 8)
    with pytest.raises(ValueError, match="digests of unequal blocks"):
        operator(frame(rows), width=width, k=3)


def test_words_with_equal_hashes_are_told_apart(frame, monkeypatch):
    """In the first attempt all words of one length are one symbol."""
    real = substring_dedup.word_symbols

    def by_length(column, salt=0):
        symbols, bounds = real(column, salt)
        words = [w for text in column.to_pylist() for w in (text or "").encode().split()]
        return (symbols if salt else np.array([len(w) for w in words], np.uint64)), bounds
    monkeypatch.setattr(substring_dedup, "word_symbols", by_length)
    texts = random_texts(4, 40, ["a", "b", "cc", "dd", "eee", "fff"], 150)
    rows = list(enumerate(texts)) + [(100 + n, texts[n][4:]) for n in range(20)]
    got = by_id(substring_dedup.remove_repeated(frame(rows), width=6, k=3))
    assert got == substring_brute(rows, 6)


@pytest.mark.parametrize("operator", [x for x, _, _ in OPERATORS])
def test_a_path_may_be_spread_over_rows_of_one_id(frame, operator):
    """No row of document 1 holds all of document 2, but together they do."""
    words = [f"w{n}" for n in range(120)]
    left, right = words[:80] + ["x"] * 40, ["y"] * 40 + words[40:]
    rows = [(1, " ".join(left)), (1, " ".join(right)), (2, " ".join(words))]
    for ids in ({1: 1, 2: 2}, {1: None, 2: 2}):
        got = operator(frame([(ids[i], t) for i, t in rows])).filter("doc_id = 2").collect()
        size = got[0]["n_words"] if "n_words" in got[0] else got[0]["n_bytes"]
        assert len(got) == 1 and got[0]["n_removed"] == size


def test_claims_are_held_against_their_source(spark):
    fields = "kind int, doc long, start long, windows int, piece binary, source long, " \
             "source_start long"
    claim, source = repeats.CLAIM, repeats.SOURCE
    held = (source, None, None, 4, b"t", 1, 7)

    def holds(*rows):
        return repeats.claims_hold(spark.createDataFrame([held, *rows], fields))
    assert holds((claim, 2, 0, 4, b"t", 1, 7), (claim, 3, 9, 4, b"t", 1, 7))
    assert not holds((claim, 2, 0, 4, b"t", 1, 7), (claim, 3, 9, 4, b"u", 1, 7))
    assert not holds((claim, 2, 0, 4, b"t", 1, 8))
    assert not holds((claim, 2, 0, 4, b"t", None, 7))
    # Two rows of document 2, of which one holds the path.
    assert holds((claim, 2, 0, 4, b"u", 1, 7), (claim, 2, 0, 4, b"t", 1, 7))
