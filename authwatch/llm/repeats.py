"""Windows that repeat across documents, found through minimiser blocks.

Exchanges, none of which carries more than one row per block but that of the texts:

1. Each task cuts its documents into blocks (see ``rolling``) and keeps one
   row per distinct block and task: further copies within a task are known to
   repeat and travel as joined runs.
2. By anchor: blocks with equal digests claim to be the same windows, so all but
   the first claim to repeat. Unequal blocks under one anchor may still share windows.
3. Claims that follow each other, in the document and in its source, compact
   into maximal paths by their source coordinates.
4. The texts meet what is asked of them: paths, the stretches that paths name as
   their sources, and unequal blocks. Out come digests of both ends of each path
   and the symbols of unequal blocks, which the operators compare window by window.

Blocks are matched by anchor hashes (64-bit polynomials) and 64-bit digests. Nothing
is removed on their word: the text of a path is held against the text at its source
by 128 bits of BLAKE2b, and copies within a task byte by byte where they name no
source. If a claim proves false, all blocks are cut again under another salt.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from authwatch.llm.batches import encoded, map_batches, type_of, write_table
from authwatch.llm.rolling import PrefixHash, find_blocks

#: Symbols of one document that are cut into blocks at once.
SEGMENT = 1 << 24
#: Rivals under one anchor from which a group is split by content.
SPLIT_FROM = 4096
#: Part of a window that an earlier one of the same task equals.
KNOWN = -1
#: Texts that go to Python at once with what they are asked for.
TEXTS = 1000
#: Times that blocks are cut, each with another salt, until all claims prove true.
ATTEMPTS = 3
#: What a document is asked for: windows to compare, runs that are proven already,
#: a path that claims to repeat, and the stretch that a path claims to be equal to.
PIECE, PROVEN, CLAIM, SOURCE = range(4)


def digest_of(piece: bytes, salt: int) -> bytes:
    """The 64 bits by which blocks are matched."""
    return blake2b(piece, digest_size=8, salt=salt.to_bytes(2)).digest()


def part_of(piece: bytes) -> int:
    """The part of a large group that a window's content belongs to."""
    return int.from_bytes(blake2b(piece, digest_size=4).digest())


def known_runs(places: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(key, document, start, windows) of runs in a list of (key, document, window)."""
    runs: list[list[int]] = []
    for key, number, at in sorted(places, key=lambda x: x[1:]):
        if runs and runs[-1][1] == number and at <= runs[-1][2] + runs[-1][3]:
            runs[-1][3] = at + 1 - runs[-1][2]
        else:
            runs.append([key + at * 7919, number, at, 1])
    return [tuple(run) for run in runs]


def signed(value: int) -> int:
    return (value + (1 << 63)) % (1 << 64) - (1 << 63)


class Cutting(NamedTuple):
    """How documents become symbols and windows."""

    symbols: Callable[[pa.Array, int], tuple[np.ndarray, np.ndarray]]  # joined symbols, bounds
    units: Callable[[bytes], Sequence]  # what the symbols stand for, one by one
    piece: Callable[[Sequence], bytes]  # units as bytes
    width: int
    k: int
    same_document: bool  # does an earlier window of the same document count
    sources: bool  # runs keep to one source, so that source columns hold for all of a run
    salt: int = 0


def segments(bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches (document, start, stop) of at most ``SEGMENT`` symbols that
    hold each window of a document whole."""
    lengths = np.diff(bounds)
    parts = np.maximum(1, -(-(lengths - width + 1) // (SEGMENT - width + 1)))
    document = np.repeat(np.arange(len(lengths)), parts)
    number = np.arange(len(document)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = bounds[document] + number * (SEGMENT - width + 1)
    return document, start, np.minimum(start + SEGMENT, bounds[document + 1])


def _cut(cutting: Cutting) -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        symbols, bounds = cutting.symbols(batch.column(1), cutting.salt)
        stretch, begins, stops = segments(bounds, cutting.width)
        if len(stretch) == batch.num_rows:
            yield from cut(batch.column(0), symbols, bounds, np.zeros(len(bounds), np.int64))
            return
        for document, begin, stop in zip(stretch, begins, stops, strict=True):
            yield from cut(batch.column(0).slice(document, 1), symbols[begin:stop],
                           np.array([0, stop - begin]), np.array([begin - bounds[document]]))

    def cut(ids, symbols, bounds, shift) -> Iterator[pa.RecordBatch]:
        blocks = find_blocks(PrefixHash(symbols), bounds, cutting.width, cutting.k)
        count = len(blocks.key)
        if not count:
            return
        raw, size = symbols.tobytes(), symbols.itemsize
        begin = blocks.start * size
        stop = (blocks.start + blocks.windows - 1 + cutting.width) * size
        begin, stop = begin.tolist(), stop.tolist()
        digest = np.frombuffer(b"".join(
            [digest_of(raw[a:b], cutting.salt) for a, b in zip(begin, stop, strict=True)]),
            np.int64)
        # Equal blocks of this batch next to each other, in order of document and start.
        rank = pc.rank(ids, null_placement="at_start", tiebreaker="min").to_numpy()
        order = np.lexsort((blocks.start, rank[blocks.document], digest, blocks.key))
        key, mark, owner = blocks.key[order], digest[order], rank[blocks.document[order]]
        leads = np.ones(count, bool)
        leads[1:] = (key[1:] != key[:-1]) | (mark[1:] != mark[:-1])
        leader = np.maximum.accumulate(np.where(leads, np.arange(count), 0))
        later = owner != owner[leader]
        if cutting.same_document:
            at = (blocks.start - bounds[blocks.document])[order]
            later |= at != at[leader]
        if not cutting.sources:
            # No source to be held against afterwards: the bytes are compared here.
            claimed = np.flatnonzero(later)
            later[claimed] = [
                raw[begin[one]:stop[one]] == raw[begin[first]:stop[first]] for one, first in zip(
                    order[claimed].tolist(), order[leader[claimed]].tolist(), strict=True)]
        repeat = np.zeros(count, bool)
        repeat[order[later]] = True
        source = np.arange(count)
        source[order] = order[leader]
        # Repeats in a row become one run.
        joins = np.zeros(count, bool)
        joins[1:] = (repeat[1:] & repeat[:-1]
                     & (blocks.document[1:] == blocks.document[:-1]))
        if cutting.sources:
            shifts = blocks.start[source] - blocks.start
            joins[1:] &= ((blocks.document[source[1:]] == blocks.document[source[:-1]])
                          & (shifts[1:] == shifts[:-1]))
        heads = np.flatnonzero(~joins)
        windows = np.add.reduceat(blocks.windows, heads)
        document, start, known = blocks.document[heads], blocks.start[heads], repeat[heads]
        source_document, source_start = blocks.document[source[heads]], blocks.start[source[heads]]
        place = pa.array(start - bounds[document] + shift[document])
        yield pa.RecordBatch.from_arrays([
            pa.array(blocks.key[heads].view(np.int64)), pa.array(digest[heads]),
            ids.take(pa.array(document)), place, pa.array(windows.astype(np.int32)),
            pa.array(known), ids.take(pa.array(source_document, mask=~known)),
            pa.array(source_start - bounds[source_document] + shift[source_document],
                     mask=~known)],
            ["key", "digest", "doc", "start", "windows", "known", "source", "source_start"])
    return run


def find_repeats(docs: DataFrame, id_col: str, text_col: str, cutting: Cutting) -> DataFrame:
    """Blocks that repeat or may: doc, start, windows, known, repeat, key, rivals and where from.

    ``repeat``: every window of the block also starts earlier, namely from
    ``source_start`` on in the document ``source``, if equal digests mean equal
    blocks; ``known`` if that was found within a task. Otherwise the
    ``rivals`` blocks with the same anchor (and ``key``) include unequal ones,
    so single windows may start earlier.
    """
    kind = type_of(docs, id_col)
    blocks = map_batches(
        docs.select(id_col, text_col), _cut(cutting),
        f"key long, digest long, doc {kind}, start long, windows int, known boolean, "
        f"source {kind}, source_start long")
    # Known runs meet nobody: a key of their own each keeps them out of the groups.
    blocks = blocks.withColumn("key", F.when(
        F.col("known"), F.xxhash64("doc", "start")).otherwise(F.col("key")))
    ordered = Window.partitionBy("key").orderBy("digest", "doc", "start")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = F.struct("doc", "start")
    earlier = (F.col("first") < place if cutting.same_document
               else F.struct("first.doc") < F.struct("doc"))
    before = F.lag("digest").over(ordered)
    return (blocks
            .withColumn("lead", F.when(before.isNull() | (before != F.col("digest")), place))
            .withColumn("first", F.last("lead", ignorenulls=True).over(so_far))
            .withColumn("repeat", F.col("known") | earlier)
            .withColumn("mixed", ~F.col("repeat") & (
                F.min("digest").over(whole) != F.max("digest").over(whole)))
            .withColumn("rivals", F.count("*").over(whole))
            .filter("repeat or mixed")
            .select("doc", "start", "windows", "known", "repeat", "key", "rivals",
                    F.when(F.col("known"), F.col("source")).otherwise(
                        F.col("first.doc")).alias("source"),
                    F.when(F.col("known"), F.col("source_start")).otherwise(
                        F.col("first.start")).alias("source_start")))


def compact(found: DataFrame, cutting: Cutting) -> DataFrame:
    """What is asked of each document: kind, doc, start, windows, key, rivals, source, source_start.

    Claims become maximal paths: along one diagonal (document, source, shift) a path
    continues the one before if it starts where that one stops, so each meets its
    neighbour in order of place. One shuffle by document; nothing else is joined.
    """
    kind = F.when(~F.col("repeat"), PIECE)
    if not cutting.sources:
        kind = kind.when(F.col("known"), PROVEN)
    kind = kind.otherwise(CLAIM)
    claims = F.col("kind") == CLAIM
    rows = (found.withColumn("kind", kind).select(
                "kind", "doc", "start", (F.col("start") + F.col("windows")).alias("stop"),
                F.when(~claims, F.col("key")).alias("key"),
                F.when(~claims, F.col("rivals")).alias("rivals"),
                F.when(claims, F.col("source")).alias("source"),
                F.when(claims, F.col("start") - F.col("source_start")).alias("shift"))
            .repartition("doc"))
    along = Window.partitionBy("doc", "kind", "source", "shift").orderBy("start", "stop")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    # Under another salt than the first each block stands for itself, since a path can
    # also be spread over rows of one id.
    goes_on = claims & (F.col("reached") >= F.col("start")) & F.lit(cutting.salt == 0)
    return (rows.withColumn("reached", F.max("stop").over(before))
            .withColumn("path", F.sum(F.when(goes_on, 0).otherwise(1)).over(along))
            .groupBy("doc", "kind", "source", "shift", "path")
            .agg(F.min("start").alias("start"), F.max("stop").alias("stop"),
                 F.first("key").alias("key"), F.first("rivals").alias("rivals"))
            .select("kind", "doc", "start",
                    (F.col("stop") - F.col("start")).cast("int").alias("windows"), "key",
                    "rivals", "source", (F.col("start") - F.col("shift")).alias("source_start")))


def by_document(ranges: DataFrame, *columns: str | Column) -> DataFrame:
    """One row per document with its ranges as an array."""
    return ranges.groupBy("doc").agg(F.collect_list(F.struct(*columns)).alias("ranges"))


def _asked(docs: DataFrame, id_col: str, text_col: str, cutting: Cutting) -> DataFrame:
    """Texts with what they are asked for: id, text, ranges, stretches that paths name."""
    asked = compact(find_repeats(docs, id_col, text_col, cutting), cutting)
    stretches = asked.filter(F.col("kind") == CLAIM).select(
        F.col("source").alias("doc"), F.col("source_start").alias("start"), "windows").distinct()
    own = by_document(asked, "kind", "start", "windows", "key", "rivals", "source",
                      "source_start").withColumnRenamed("doc", "own")
    named = by_document(stretches, "start", "windows").select(
        F.col("doc").alias("named"), F.col("ranges").alias("stretches"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (texts.join(own, F.col("id").eqNullSafe(F.col("own")), "left")
            .join(named, F.col("id").eqNullSafe(F.col("named")), "left")
            .filter("ranges is not null or stretches is not null")
            .select("id", "text", "ranges", "stretches"))


def _answers(cutting: Cutting) -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
    """Digests of paths and sources, and the units of mixed blocks: windows of large groups
    one by one, copies within a batch known."""
    width, units, piece_of = cutting.width, cutting.units, cutting.piece

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, single = [], []
        ids = batch.column(0)
        names = ids.to_pylist()
        def mark(held: Sequence, start: int, count: int) -> bytes:
            return blake2b(piece_of(held[start:start + count - 1 + width]),
                           digest_size=16).digest()
        for number, text in enumerate(encoded(batch.column(1))):
            held = units(text)
            count_here, own = len(held) - width + 1, names[number]
            # A stretch beyond the end is that of another row with this id.
            for span in batch.column(3)[number].as_py() or ():
                start, count = span["start"], span["windows"]
                if start + count <= count_here:
                    rows.append((SOURCE, None, None, None, None, count,
                                 mark(held, start, count), own, start))
            for span in batch.column(2)[number].as_py() or ():
                kind, start, count = span["kind"], span["start"], span["windows"]
                if kind == PROVEN:
                    rows.append((kind, None, None, own, start, count, None, None, None))
                elif kind == CLAIM:
                    if start + count <= count_here:
                        rows.append((kind, None, None, own, start, count,
                                     mark(held, start, count), span["source"],
                                     span["source_start"]))
                else:
                    count, key = min(count, count_here - start), span["key"]
                    if count < 1:
                        continue
                    if span["rivals"] < SPLIT_FROM:
                        rows.append((kind, key, 0, own, start, count,
                                     piece_of(held[start:start + count - 1 + width]), None, None))
                    else:
                        single += [(key, piece_of(held[at:at + width]), number, at)
                                   for at in range(start, start + count)]
        if single:
            rank = pc.rank(ids, null_placement="at_start", tiebreaker="min").to_pylist()
            first: dict[tuple[int, bytes], tuple[int, int]] = {}

            def place(number: int, at: int) -> tuple[int, int]:
                return rank[number], at if cutting.same_document else 0
            for key, piece, number, at in single:
                first[key, piece] = min(place(number, at),
                                        first.get((key, piece), place(number, at)))
            known = []
            for key, piece, number, at in single:
                if place(number, at) == first[key, piece]:
                    rows.append((PIECE, key, part_of(piece), names[number], at, 1, piece, None,
                                 None))
                else:
                    known.append((key, number, at))
            rows += [(PIECE, signed(key), KNOWN, names[number], at, count, b"", None, None)
                     for key, number, at, count in known_runs(known)]
        if rows:
            types = (pa.int32(), pa.int64(), pa.int64(), ids.type, pa.int64(), pa.int32(),
                     pa.binary(), ids.type, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(
                    zip(*rows, strict=True), types, strict=True)],
                ["kind", "key", "part", "doc", "start", "windows", "piece", "source",
                 "source_start"])
    return run


def claims_hold(answers: DataFrame) -> bool:
    """Whether each path has the text of the stretch that it names as its source.

    Ends are counted by stretch and digest, so that copies combine before the shuffle.
    Only where an end differs are single paths looked at: rows that share an id are one
    document, and one of them has to hold the path, and one its source.
    """
    stretch = ["source", "source_start", "windows"]
    ends = (answers.filter(F.col("kind").isin(CLAIM, SOURCE)).groupBy(*stretch, "piece")
            .agg(F.max(F.col("kind") == CLAIM).alias("claimed"),
                 F.max(F.col("kind") == SOURCE).alias("held")))
    if ends.filter("claimed and not held").isEmpty():
        return True
    right = ends.select(*(F.col(name).alias(f"its_{name}") for name in [*stretch, "piece"]),
                        "held")
    same = F.lit(True)
    for name in [*stretch, "piece"]:
        same &= F.col(name).eqNullSafe(F.col(f"its_{name}"))
    return (answers.filter(F.col("kind") == CLAIM).join(right, same)
            .groupBy("doc", "start", *stretch).agg(F.max("held").alias("held"))
            .filter(~F.col("held")).isEmpty())


def proven_repeats(docs: DataFrame, id_col: str, text_col: str, cutting: Cutting) -> DataFrame:
    """What texts answer, kept in the shared folder; see ``PIECE`` and what follows it.

    ``CLAIM`` rows are compacted paths (doc, start, windows, source, source_start) whose
    text was held against that of their source, ``PROVEN`` rows are runs (doc, start,
    windows). ``PIECE`` rows (key, part, doc, start, windows, piece) are still to be compared.
    """
    kind = type_of(docs, id_col)
    for salt in range(ATTEMPTS):
        salted = cutting._replace(salt=salt)
        answers = write_table(map_batches(
            _asked(docs, id_col, text_col, salted), _answers(salted),
            f"kind int, key long, part long, doc {kind}, start long, windows int, piece binary, "
            f"source {kind}, source_start long"), "repeats", batch_rows=TEXTS)
        if claims_hold(answers):
            return answers
    raise ValueError(f"digests of unequal blocks are equal under {ATTEMPTS} salts")


def windows_of(answers: DataFrame) -> DataFrame:
    """Windows to compare, each (key, part) whole and in order of document and place."""
    return (answers.filter(F.col("kind") == PIECE)
            .select("key", "part", "doc", "start", "windows", "piece")
            .repartition("key", "part").sortWithinPartitions("key", "part", "doc", "start"))
