"""Token counts, streaming BPE and packing against the tokenizers library."""

from __future__ import annotations

import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import SF_DIR
from tokenizers import Tokenizer

from authwatch.llm import bpe_files, bpe_stream, packing, token_counts
from authwatch.llm.queries import QUERIES

WORDS, BYTES = (public_tokenizers.path(f"{name}.json") for name in ("word_bpe_49k", "byte_bpe_50k"))
LETTERS = "aAbéÇß \n\t<|>enΣσİ1２٣中文🙂́　՘x\x1c\x85'sll  "


def odd_texts():
    rng = random.Random(1)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    return texts + ["<|endoftext|>a<|startoftext|>", "<|endoftext|", "", " ", "a" * 3000,
                    "ab" * 1500, "".join(rng.choice("etaoinsh") for _ in range(4000))]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_the_decoder_takes_every_token(path, monkeypatch):
    monkeypatch.setattr(bpe_stream, "RUN", 7)
    monkeypatch.setattr(bpe_stream, "WINDOW", 11)
    fed, run = [], bpe_stream.Decoder.run
    monkeypatch.setattr(bpe_stream.Decoder, "run",
                        lambda self, tokens: fed.extend(tokens) or run(self, tokens))
    vocab = bpe_files.Vocabulary(path)
    words, numerals = bpe_stream.encoder(vocab), [str(n) for n in range(60_000)]
    library = Tokenizer.from_file(path)
    for text in odd_texts():
        fed.clear()
        digests = bpe_stream.Digests(words, numerals)
        for ids in words.runs(text):
            digests.add(ids)
        want = library.encode(text, add_special_tokens=False).ids
        assert fed == want, text
        assert digests.finish() == (len(want), *(sha256(x.encode()).hexdigest() for x in (
            " ".join(map(str, want)), library.decode(want, skip_special_tokens=False)))), text
        one = bpe_stream.Decoder(vocab)
        assert "".join(map(one.feed, want)) + one.finish() == one.__class__(vocab).decode(want)


def test_caches_of_two_generations_forget_and_stay_right():
    cache = bpe_stream.Aged(lambda key: key.encode(), most=10, longest=3)
    for turn in range(3):
        for n in [*range(40), *range(5)]:
            assert cache[str(n)] == str(n).encode() and cache["long" * n] == b"long" * n
    assert len(cache) <= 10 and len(cache.old) <= 10 and not any(len(k) > 3 for k in cache)


@pytest.mark.parametrize("query", ["op2_token_counts", "op7_bpe_stream"])
def test_whole_table_against_the_library(spark, query):
    library = Tokenizer.from_file(WORDS)
    docs = {r.doc_id: r.text or "" for r in
            spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES[query](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for row in rows:
        text = docs[row.doc_id]
        ids = library.encode(text, add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        if query == "op2_token_counts":
            assert (row.n_bytes, row.over_limit) == (len(text.encode()), len(ids) > 2048)
        else:
            decoded = library.decode(ids, skip_special_tokens=False)
            assert (row.ids_sha256, row.decoded_sha256) == tuple(
                sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded))


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_every_operator_gives_the_ids_of_the_library(path):
    library, vocab = Tokenizer.from_file(path), bpe_files.Vocabulary(path)
    counts, words = token_counts.counter(vocab), bpe_stream.encoder(vocab)
    ids = packing.TextIds(vocab) if path == BYTES else None
    for text in odd_texts():
        want = library.encode(text, add_special_tokens=False).ids
        assert sum(counts.values(text)) == len(want), text
        count, joined, decoded = bpe_stream.encode_text(text, words)
        assert (count, joined) == (len(want), " ".join(map(str, want))), text
        assert decoded == library.decode(want, skip_special_tokens=False), text
        if ids:
            assert np.frombuffer(ids(text), "<u4").tolist() == want, text


def test_tokens_come_out_before_the_word_ends():
    vocab = bpe_files.Vocabulary(WORDS)
    encoder = bpe_stream.Encoder(vocab)
    symbols = vocab.symbols("the" * 5000)
    out = []
    for at, symbol in enumerate(symbols):
        out += encoder.feed([symbol])
        assert len(encoder.held) < encoder.reach + bpe_stream.CHUNK
    assert len(out) > 0.8 * (len(symbols) - encoder.reach - bpe_stream.CHUNK) / 3
    assert out + [*encoder.finish()] == bpe_stream.merge_all(symbols, vocab.packed)


def test_decoder_holds_unfinished_characters():
    vocab = bpe_files.Vocabulary(BYTES)
    ids = Tokenizer.from_file(BYTES).encode("é🙂", add_special_tokens=False).ids
    parts = [bpe_stream.Decoder(vocab).decode(ids[:n]) for n in range(len(ids) + 1)]
    assert parts[-1] == "é🙂" and all("🙂" not in part for part in parts[:-1])


def pack_brute(text, library):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


def check_packing(rows, pieces):
    library = Tokenizer.from_file(BYTES)
    by_doc, by_sequence = {}, {}
    for piece in pieces:
        by_doc.setdefault(piece.doc_id, []).append(piece)
        by_sequence.setdefault(piece.sequence_id, []).append(piece)
    for key, text in rows:
        ids, at = pack_brute(text, library), 0
        for piece in sorted(by_doc[key], key=lambda p: p.start):
            own = np.array(ids[at:at + piece.length], "<u4").tobytes()
            assert (piece.start, piece.doc_tokens, piece.ids_crc32) == (at, len(ids), crc32(own))
            at += piece.length
        assert at == len(ids)
    padding = 0
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:n]) for n in range(len(own))]
        size = sum(p.length for p in own)
        assert size <= 2048
        padding += 2048 - size if size & (size - 1) else 0
    return padding, sum(p.length for p in pieces)


def test_packing_whole_table(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    pieces = packing.pack_documents(docs, BYTES).collect()
    padding, tokens = check_packing(rows, pieces)
    assert padding < 0.01 * tokens
    loads = {}
    for piece in pieces:
        loads[piece.step_group] = loads.get(piece.step_group, 0) + piece.length
    assert max(loads.values()) - min(loads.values()) <= 4096


def test_packing_with_a_small_buffer(frame):
    rng = random.Random(2)
    rows = [(n, "word " * rng.choice([0, 1, 5, 60, 300, 3000])) for n in range(200)]
    rows += [(300, None), (301, "")]
    pieces = packing.pack_documents(frame(rows, 2), BYTES, step_tokens=4096).collect()
    padding, _ = check_packing(rows, pieces)
    assert padding <= 2 * 2 * 2048


def test_packer_fills_windows_whole():
    packer, out = packing.Packer((8, 4, 2)), []
    for row, length in enumerate([3, 9, 1, 5, 2, 7, 6, 8, 1, 1]):
        out += packer.add(row, length)
        out += packer.pack()
    assert all(sum(p.length for p in window) == tier for tier, window in out)
    left = packer.rest()
    assert sum(p.length for _, w in out for p in w) + sum(p.length for p in left) == 43


def test_queries_over_frames(frame, odd_rows):
    library = Tokenizer.from_file(WORDS)
    counts = token_counts.token_counts(frame(odd_rows), WORDS, limit=3).collect()
    trips = bpe_stream.round_trip(frame(odd_rows), WORDS).collect()
    assert len(counts) == len(trips) == len(odd_rows)
    texts = {key: text or "" for key, text in odd_rows if key is not None}
    for row in counts:
        if row.doc_id is not None:
            n = len(library.encode(texts[row.doc_id], add_special_tokens=False).ids)
            assert (row.n_bytes, row.n_tokens, row.over_limit) == (
                len(texts[row.doc_id].encode()), n, n > 3)
    for row in trips:
        if row.doc_id is not None:
            ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
            assert row.ids_sha256 == sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert packing.pack_documents(frame(odd_rows), BYTES).select("doc_id").distinct().count() == 9
    for empty in (token_counts.token_counts(frame([]), WORDS),
                  bpe_stream.round_trip(frame([]), WORDS),
                  packing.pack_documents(frame([]), BYTES)):
        assert empty.count() == 0
