"""Substring dedup by De Bruijn compaction: words of long spans seen in earlier documents.

Nodes are runs of ``width - 1`` words and every window of ``width`` words is an
edge. A block of ``repeats`` is a path without branches inside one document, so
edges never travel one by one. Repeated paths that follow each other, in the
document and in its source, compact into maximal paths by their source
coordinates, and the words of each are held against those at its source: both ends give
128 bits of BLAKE2b over their words. Paths meet their sources and their
neighbours by key in windows of one shuffle each; joins of paths with themselves
moved more than the input four times over. Edges of blocks that only share an anchor
are looked up word by word.

A null text has no words; null ids count as the smallest. Documents shorter
than ``width`` words keep all. Rows with equal ids are versions of one
document: spans found in one are removed from all, and none of them repeats
another. Texts of any length are taken whole, and an empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authwatch.llm.batches import encoded, map_batches, type_of
from authwatch.llm.repeats import (
    CLAIM, KNOWN, Cutting, by_document, proven_repeats, windows_of)
from authwatch.llm.suffix_dedup import merge_ranges
from authwatch.llm.words import word_symbols


def _seen_edges(width: int):
    """Edges of each (key, part), in order of document, that an earlier document has."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, first = None, {}
        for batch in batches:
            hits, starts, counts = [], [], []
            for number, (key, part, doc, start, windows, piece) in enumerate(zip(
                    *(column.to_pylist() for column in batch.columns), strict=True)):
                if part == KNOWN:
                    hits.append(number)
                    starts.append(start)
                    counts.append(windows)
                    continue
                if (key, part) != group:
                    group, first = (key, part), {}
                words = piece.split()
                for at in range(len(words) - width + 1):
                    edge = b" ".join(words[at:at + width])
                    if first.setdefault(edge, doc) != doc:
                        if hits and hits[-1] == number and (
                                starts[-1] + counts[-1] == start + at):
                            counts[-1] += 1
                        else:
                            hits.append(number)
                            starts.append(start + at)
                            counts.append(1)
            if hits:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).take(pa.array(hits)), pa.array(starts, pa.int64()),
                     pa.array(counts, pa.int32())], ["doc", "start", "windows"])
    return over


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   width: int = 13, k: int = 4) -> tuple[DataFrame, DataFrame]:
    """Compacted paths with their sources, and the single edges beside them."""
    answers = proven_repeats(docs, id_col, text_col, Cutting(
        word_symbols, bytes.split, b" ".join, width, k, same_document=False, sources=True))
    paths = answers.filter(F.col("kind") == CLAIM).select(
        "doc", "start", "windows", "source", "source_start")
    edges = windows_of(answers).mapInArrow(
        _seen_edges(width), f"doc {type_of(docs, id_col)}, start long, windows int")
    return paths, edges


def kept_words(text: bytes, spans, width: int) -> tuple[int, int, list[bytes]]:
    """Number of words, number removed, and the words that stay."""
    words = text.split()
    runs = merge_ranges(spans, width, len(words))
    kept, done = [], 0
    for start, stop in runs:
        kept += words[done:start]
        done = stop
    kept += words[done:]
    return len(words), sum(b - a for a, b in runs), kept


def _remove(width: int, with_text: bool):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        texts = encoded(batch.column(1))
        for text, spans in zip(texts, batch.column(2).to_pylist(), strict=True):
            count, removed, kept = kept_words(text, spans or (), width)
            joined = b" ".join(kept)
            rows.append((count, removed, sha256(joined).hexdigest(), joined))
        count, removed, digest, joined = zip(*rows, strict=True)
        out = [batch.column(0), pa.array(count, pa.int64()), pa.array(removed, pa.int64()),
               pa.array(digest)]
        names = ["doc", "n_words", "n_removed", "kept_sha256"]
        if with_text:
            # A text that loses nothing stays as it is.
            stays = [new if lost else old
                     for old, new, lost in zip(texts, joined, removed, strict=True)]
            out += [pa.array(stays, pa.binary()).cast(pa.string()), batch.column(3)]
            names += ["kept_text", "carried"]
        yield pa.RecordBatch.from_arrays(out, names)
    return run


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = 13, k: int = 4,
                    with_text: tuple[str, ...] | None = None) -> DataFrame:
    """Per document: id, n_words, n_removed and kept_sha256.

    ``with_text`` names other columns: then kept_text and a struct ``carried`` of
    those columns follow.
    """
    paths, edges = repeated_spans(docs, id_col, text_col, width, k)
    ranges = by_document(paths.select("doc", "start", "windows").unionByName(edges),
                         "start", "windows")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                        *([] if with_text is None else [F.struct(*with_text).alias("carried")]))
    joined = texts.join(ranges, F.col("id").eqNullSafe(F.col("doc")), "left")
    schema = f"doc {type_of(docs, id_col)}, n_words long, n_removed long, kept_sha256 string"
    columns = ["id", "text", "ranges"]
    if with_text is not None:
        schema += f", kept_text string, carried {type_of(texts, 'carried')}"
        columns.append("carried")
    return map_batches(joined.select(*columns), _remove(width, with_text is not None),
                       schema).withColumnRenamed("doc", id_col)
