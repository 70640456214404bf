"""Language-model scoring with a probabilistic suffix tree over words.

The states of the tree are contexts of no, one or two words. The root gives a
word its add-one share of all training tokens. A longer context is a state if
its next-word distribution diverges from that of the longest shorter state: over
its training occurrences, each left out of its own counts, it must save
``DIVERGENCE`` bits a word. A state's distribution is smoothed by mixing its own
shares with those of the shorter state, in the proportion of ``WEIGHTS`` that
saves most. A token is scored by the longest state that ends before it in its
text, so the probabilities of all known words and of one unknown word add up to 1
in every state.

Texts are kept as blocks: the distinct words of some megabytes of text, and the
texts as numbers of them. What a block needs to know of the whole corpus (counts
of its words, pairs and triples, and what its contexts save) it asks for by
64-bit keys, sorted and dealt by their leading bits; the tasks that own a range
of keys add up what all blocks say and answer each block. So counts never meet in
one place, a frequent word costs one entry per block, and memory is bounded by
the size of a block and of a range. Sums are whole numbers, so they do not depend
on how texts were dealt.

A null text counts as empty; an empty text is one end token. Texts of any length
are taken whole; a text above the size of a block makes a block alone. Repeated
rows count and are scored each time; without training texts every token has
probability 1 at the root. An empty table gives no rows. Different words or
sequences count as the same where their 64-bit keys agree. Other columns are
ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authwatch.llm.batches import encoded, split_by_size, type_of, write_table
from authwatch.llm.rolling import PrefixHash, mix
from authwatch.llm.words import word_bounds

#: Bytes of text of a block, and tokens whose keys make a range (about).
BLOCK_BYTES, RANGE_TOKENS, LEAST_BITS = 8 << 20, 1 << 20, 6
#: A context is tested from so many training occurrences on; bits a word it has to save.
OCCURRENCES, DIVERGENCE = 32, 0.05
#: Shares of a state's own counts in its smoothed distribution.
WEIGHTS = np.array([0.1, 0.4, 0.7, 0.95])
#: Saved bits are added up as whole numbers of this part.
UNIT = 1 << 12
#: The token after the last word of a text.
END = np.uint64(0x5EED0F7E47E4D0F5)
#: Kinds of keys: words, pairs, triples, contexts of one and of two words.
WORDS, PAIRS, TRIPLES, ONE, TWO = range(1, 6)

ASKED = "kind int, part int, block long, keys binary, sums binary, width int"
ANSWERED = "kind int, part int, block long, told binary, known long, total long"


def planes(values: np.ndarray) -> bytes:
    """Bytes of numbers by place, so that equal leading bytes compress."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    table = np.frombuffer(data, np.uint8).reshape(size, -1).T
    return np.ascontiguousarray(table).view(kind).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, np.uint64), dtype=np.uint64)


def pack_sums(sums: np.ndarray) -> bytes:
    """Whole numbers with the sign in the last place: small ones have zero leading bytes."""
    return planes(((sums << 1) ^ (sums >> 63)).ravel())


def unpack_sums(data: bytes, width: int) -> np.ndarray:
    found = from_planes(data, np.uint64)
    return ((found >> np.uint64(1)).view(np.int64)
            ^ -(found & np.uint64(1)).view(np.int64)).reshape(-1, width)


def ask(kind: int, block: int, keys: np.ndarray, sums: np.ndarray, bits: int) -> pa.RecordBatch:
    """A block's ascending keys and their sums (a row of numbers each), by range of keys."""
    part = (keys >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(part)) + 1
    spans = list(zip([0, *cuts], [*cuts, len(keys)], strict=True)) if len(keys) else []
    sums = sums.reshape(len(keys), sums.shape[1] if sums.ndim > 1 else 1).astype(np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array([kind] * len(spans), pa.int32()),
        pa.array([int(part[a]) for a, _ in spans], pa.int32()),
        pa.array([block] * len(spans), pa.int64()),
        pa.array([pack_keys(keys[a:b]) for a, b in spans], pa.binary()),
        pa.array([pack_sums(sums[a:b]) for a, b in spans], pa.binary()),
        pa.array([sums.shape[1]] * len(spans), pa.int32())],
        ["kind", "part", "block", "keys", "sums", "width"])


def answer(asked: pa.Table) -> pa.Table:
    """To every block of a range, what all blocks say of its keys together.

    That is the sum of a count; or for a context the number of the weight that saves
    most, 0 if it is no state.
    """
    kind, part, width = (asked[name][0].as_py() for name in ("kind", "part", "width"))
    keys = [unpack_keys(x) for x in asked["keys"].to_pylist()]
    bounds = np.cumsum([0, *map(len, keys)])
    sums = np.concatenate([unpack_sums(x, width) for x in asked["sums"].to_pylist()])
    keys = np.concatenate(keys)
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    added = np.add.reduceat(sums[order], np.flatnonzero(new), axis=0)
    if kind in (ONE, TWO):
        passed = added[:, :-1].max(axis=1) >= DIVERGENCE * UNIT * added[:, -1]
        verdict = np.where(passed, added[:, :-1].argmax(axis=1) + 1, 0).astype(np.uint8)
    else:
        verdict = added[:, 0]
    back = np.empty(len(keys), verdict.dtype)
    back[order] = verdict[np.cumsum(new) - 1]
    blocks = asked["block"].to_pylist()
    known, total = [0] * len(blocks), [0] * len(blocks)
    known[0], total[0] = int((added[:, 0] > 0).sum()), int(added[:, 0].sum())
    return pa.table([
        pa.array([kind] * len(blocks), pa.int32()), pa.array([part] * len(blocks), pa.int32()),
        pa.array(blocks, pa.int64()),
        pa.array([planes(back[a:b])
                  for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
        pa.array(known, pa.int64()), pa.array(total, pa.int64())],
        names=["kind", "part", "block", "told", "known", "total"])


def _blocks(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in split_by_size(whole, block_bytes):
                yield _block(batch)
    return run


def _block(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Texts as numbers of their distinct words, an end token after each text."""
    joined, starts, stops, bounds = word_bounds([x.lower() for x in encoded(batch.column(1))])
    sizes = np.diff(bounds) + 1
    ends = np.cumsum(sizes) - 1
    tokens = np.full(int(sizes.sum()), END)
    inner = np.ones(len(tokens), bool)
    inner[ends] = False
    tokens[inner] = mix(PrefixHash(joined).of(starts, stops) + (stops - starts).astype(np.uint64))
    words, numbers = np.unique(tokens, return_inverse=True)
    # Numbers by falling frequency, so that most of them are small.
    rank = np.argsort(-np.bincount(numbers), kind="stable")
    place = np.empty_like(rank)
    place[rank] = np.arange(len(rank))
    return pa.RecordBatch.from_arrays([
        pa.array([uuid.uuid4().int >> 65], pa.int64()),
        pa.array([batch.column(0).to_pylist()], pa.list_(batch.column(0).type)),
        pa.array([batch.column(2).to_pylist()], pa.list_(pa.bool_())),
        pa.array([planes(sizes.astype(np.int64))], pa.binary()),
        pa.array([len(tokens)], pa.int64()),
        pa.array([words[rank].tobytes()], pa.binary()),
        pa.array([planes(place[numbers].astype(np.uint32))], pa.binary())],
        ["block", "docs", "learns", "sizes", "tokens", "words", "numbers"])


class Block:
    """Tokens of a block, and what it has been told of the corpus."""

    def __init__(self, row: dict, known: int = 0, total: int = 0):
        self.number, self.docs, self.learns = row["block"], row["docs"], row["learns"]
        self.sizes = from_planes(row["sizes"], np.int64)
        words = np.frombuffer(row["words"], np.uint64)
        order = np.argsort(words)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.words = words[order]
        self.at = place[from_planes(row["numbers"], np.uint32)]
        self.learn = np.repeat(np.array(self.learns, bool), self.sizes)
        self.known, self.total = known, total
        self.starts = np.cumsum(self.sizes) - self.sizes
        depth = np.arange(len(self.at)) - np.repeat(self.starts, self.sizes)
        self.second = np.flatnonzero(depth >= 1)  # tokens after one word at least
        self.third = np.flatnonzero(depth >= 2)
        before = self.second - 1
        pairs = mix(self.words[self.at[before]] * np.uint64(3) + self.words[self.at[self.second]])
        self.pairs, inverse = np.unique(pairs, return_inverse=True)
        self.pair_at = np.zeros(len(self.at), np.int64)
        self.pair_at[self.second] = inverse

    def uses(self, keys: np.ndarray, at: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Training occurrences of each key; ``at`` is the key of each token in ``tokens``."""
        return np.bincount(at[self.learn[tokens]], minlength=len(keys))

    def first_questions(self, bits: int) -> Iterator[pa.RecordBatch]:
        everywhere = np.arange(len(self.at))
        yield ask(WORDS, self.number, self.words, self.uses(self.words, self.at, everywhere), bits)
        yield ask(PAIRS, self.number, self.pairs,
                  self.uses(self.pairs, self.pair_at[self.second], self.second), bits)

    def hear(self, answers: dict) -> None:
        """Counts of tokens and pairs, then of triples of frequent contexts, if told."""
        nothing = np.zeros(0, np.int64)
        self.count, self.pair_count = answers[WORDS], answers.get(PAIRS, nothing)
        self.root = (self.count[self.at] + 1) / (self.total + self.known + 1)
        # The same without one occurrence of the token.
        self.root_left = self.count[self.at] / max(1, self.total + self.known)
        self.one = self.second[self.count[self.at[self.second - 1]] >= OCCURRENCES]
        told = self.pair_count[self.pair_at[self.third - 1]]
        self.two = self.third[told >= OCCURRENCES]
        keys = mix(self.pairs[self.pair_at[self.two - 1]] * np.uint64(5)
                   + self.words[self.at[self.two]])
        self.triples, self.triple_at = np.unique(keys, return_inverse=True)
        self.triple_count = answers.get(TRIPLES, nothing)

    def triple_questions(self, bits: int) -> Iterator[pa.RecordBatch]:
        yield ask(TRIPLES, self.number, self.triples,
                  self.uses(self.triples, self.triple_at, self.two), bits)

    def _counts(self, tokens: np.ndarray, longer: bool):
        """Occurrences of the contexts before ``tokens``, and with them."""
        if longer:
            return (self.pair_count[self.pair_at[tokens - 1]], self.triple_count[self.triple_at])
        return self.count[self.at[tokens - 1]], self.pair_count[self.pair_at[tokens]]

    def _contexts(self, kind: int):
        """Tokens after tested contexts, the contexts' numbers, and which each token has."""
        tokens = self.two if kind == TWO else self.one
        at = (self.pair_at if kind == TWO else self.at)[tokens - 1]
        found, place = np.unique(at, return_inverse=True)
        return tokens, found, place

    def saving_questions(self, kind: int, shorter: np.ndarray, bits: int):
        """Bits that each context saves in training against the shorter state, by weight,
        and its training occurrences."""
        tokens, found, place = self._contexts(kind)
        context, together = self._counts(tokens, kind == TWO)
        learn = self.learn[tokens]
        own = (together[learn] - 1) / (context[learn] - 1)
        base = shorter[tokens[learn]]
        sums = np.zeros((len(found), len(WEIGHTS) + 1))
        sums[:, -1] = np.bincount(place[learn], minlength=len(found))
        for n, weight in enumerate(WEIGHTS):
            saved = np.rint(np.log2(1 - weight + weight * own / base) * UNIT)
            sums[:, n] = np.bincount(place[learn], saved, len(found))
        names = self.pairs if kind == TWO else self.words
        yield ask(kind, self.number, names[found], sums, bits)

    def mixed(self, kind: int, told: np.ndarray, shorter: np.ndarray, left: bool) -> np.ndarray:
        """Probabilities of all tokens with the states of one more kind of context.

        With ``left`` a training occurrence does not count for itself.
        """
        tokens, found, place = self._contexts(kind)
        if not len(found):
            return shorter
        context, together = self._counts(tokens, kind == TWO)
        state = (told > 0)[place]
        weight = WEIGHTS[told.astype(np.int64) - 1][place]
        gone = self.learn[tokens] & left
        own = (together - gone) / (context - gone)
        out = shorter.copy()
        out[tokens[state]] = (weight * own + (1 - weight) * shorter[tokens])[state]
        return out

    def scores(self, answers: dict) -> pa.Table:
        one = self.mixed(ONE, answers[ONE], self.root, left=False) if ONE in answers else self.root
        two = self.mixed(TWO, answers[TWO], one, left=False) if TWO in answers else one
        sums = [np.add.reduceat(x, self.starts) for x in (
            np.log10(self.root), np.log10(two), (self.count[self.at] > 0).astype(np.int64),
            (two != self.root).astype(np.int64))]
        return pa.table([pa.array(self.docs), pa.array([not x for x in self.learns], pa.bool_()),
                         pa.array(self.sizes), pa.array(sums[2]),
                         pa.array([self.total] * len(self.docs), pa.int64()),
                         pa.array(sums[0]), pa.array(sums[1]), pa.array(sums[3])],
                        names=["doc", "held_out", "n_tokens", "n_known", "train_tokens",
                               "base_score", "score", "n_in_context"])


def _told(answers: pa.Table) -> dict:
    """Answers by kind, in the order of the keys that the block asked for."""
    rows = answers.sort_by([("kind", "ascending"), ("part", "ascending")]).to_pylist()
    parts: dict[int, list] = {}
    for row in rows:
        parts.setdefault(row["kind"], []).append(
            from_planes(row["told"], np.uint8 if row["kind"] in (ONE, TWO) else np.int64))
    return {kind: np.concatenate(found) for kind, found in parts.items()}


def _exchange(asked: DataFrame, name: str) -> DataFrame:
    return write_table(asked.groupBy("kind", "part").applyInArrow(answer, ANSWERED), name)


def score_texts(docs: DataFrame, learns: Column, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score and
    n_in_context (tokens scored by a longer state than the root).

    The rows for which ``learns`` holds are the training texts.
    """
    kind = type_of(docs, id_col)
    blocks = write_table(
        docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"),
                    F.coalesce(learns, F.lit(False)).alias("learns"))
        .mapInArrow(_blocks(BLOCK_BYTES), f"block long, docs array<{kind}>, learns array<boolean>, "
                    "sizes binary, tokens long, words binary, numbers binary"), "blocks")
    tokens = blocks.agg(F.sum("tokens")).first()[0] or 0
    bits = max(LEAST_BITS, (-(-tokens // RANGE_TOKENS)).bit_length())

    def first(batches):
        for batch in batches:
            for n in range(batch.num_rows):
                yield from Block(batch.slice(n, 1).to_pylist()[0]).first_questions(bits)

    heard = _exchange(blocks.mapInArrow(first, ASKED), "counts")
    words = heard.filter(F.col("kind") == WORDS).agg(F.sum("known"), F.sum("total")).first()
    known, total = (x or 0 for x in words)

    def told(run, schema, answers):
        def both(block: pa.Table, answers: pa.Table) -> pa.Table:
            own, found = Block(block.to_pylist()[0], known, total), _told(answers)
            own.hear(found)
            return run(own, found)
        return (blocks.groupBy("block").cogroup(answers.groupBy("block"))
                .applyInArrow(both, schema))

    def second(block, found):
        return pa.Table.from_batches([*block.triple_questions(bits),
                                      *block.saving_questions(ONE, block.root_left, bits)])

    def third(block, found):
        shorter = block.root_left
        if ONE in found:
            shorter = block.mixed(ONE, found[ONE], shorter, left=True)
        return pa.Table.from_batches([*block.saving_questions(TWO, shorter, bits)])

    heard = heard.unionByName(_exchange(told(second, ASKED, heard), "triples"))
    heard = heard.unionByName(_exchange(told(third, ASKED, heard), "savings"))
    scored = told(lambda block, found: block.scores(found),
                  f"doc {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                  "base_score double, score double, n_in_context long", heard)
    return scored.withColumnRenamed("doc", id_col)
