"""Quality rules by cross-document line frequency.

Lines that many documents of one host share are its boilerplate. Lines of any
length are normalised (white space runs to one blank, ends trimmed, lower case)
and hashed; per host, the distinct documents of each hash are counted. A line
above the limit is removed, and a document that is left with too few words, or
too small a share of its words, is rejected. The limit is a number of documents
per host, whatever the host's size, so verdicts are alike at every size.

Copies of a good text are no reason to lose all of them: every line above the limit
stays in one text of the host and in the exact copies of that text. It is the text
with the most documents among those that hold the line and pass the base rule, of
equals the one with the least id. There is no other rule for long lines, for lines of
few texts or for small hosts.

``judge`` gives counts and verdicts of the texts as they come; ``kept_texts`` gives
the rows of the documents that stay, without the lines above the limit.

``judge`` reads the texts once, ``kept_texts`` twice. Counts are combined before each
shuffle, so a line or host with a large part of all rows is a few rows per task. Null
hosts form one host, a null text has no words, repeated rows are one document and
each get a verdict, and a null id comes before all others. Lines and texts of any
length are taken whole, and an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authwatch.llm.batches import encoded, keep_table, map_batches, type_of

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
#: A line is boilerplate in more than so many documents of a host.
MIN_DOCUMENTS = 20
#: A document stays with at least so many words and this share of its words.
LEAST_WORDS, LEAST_SHARE = 20, 0.3
WINDOW = 8


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur twice or more in the text.

    ``width`` is a power of two: windows get numbers by doubling, exactly.
    """
    if len(words) <= width:
        return 0
    numbers: dict[bytes, int] = {}
    ranks = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    span = 1
    while span < width:
        pairs = ranks[:-span] * (len(words) + 1) + ranks[span:]
        _, ranks, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        span *= 2
    repeated = counts[ranks] > 1
    if not repeated.any():
        return 0
    change = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(repeated)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return int((np.cumsum(change) > 0).sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    words = text.split()
    chars = len(text.decode()) - sum(map(text.count, (bytes([b]) for b in BLANKS)))
    symbols = sum(map(text.count, (bytes([b]) for b in SYMBOLS)))
    lines = [line for line in text.split(b"\n") if line.strip(BLANKS)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def line_key(words: list[bytes]) -> int:
    """Hash of a normalised line, from its words."""
    plain = b" ".join(words).decode().lower().encode()
    return int.from_bytes(blake2b(plain, digest_size=8).digest(), "big", signed=True)


def line_words(text: bytes) -> dict[int, int]:
    """Hash of each normalised line of a text, and its words in all its places."""
    found: dict[int, int] = {}
    for line in text.split(b"\n"):
        if words := line.split():
            key = line_key(words)
            found[key] = found.get(key, 0) + len(words)
    return found


def without_lines(text: bytes, lost: set[int]) -> tuple[bytes, int]:
    """The text without the lines whose hashes are in ``lost``, and how many lines went."""
    lines = text.split(b"\n")
    stay = [line for line in lines if not (words := line.split()) or line_key(words) not in lost]
    return b"\n".join(stay), len(lines) - len(stay)


def _profile(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    rows = encoded(batch.column(2))
    counts = list(zip(*map(base_counts, rows), strict=True))
    lines = [[{"line": k, "words": v} for k, v in line_words(text).items()] for text in rows]
    content = [int.from_bytes(blake2b(text, digest_size=8).digest(), "big", signed=True)
               for text in rows]
    yield pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), pa.array(content, pa.int64()),
         batch.column(3), *(pa.array(c, pa.int64()) for c in counts),
         pa.array(lines, pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())])))],
        ["doc", "host", "content", "copy", "n_words", "word_chars", "n_symbols", "n_dup_lines",
         "n_repeat_words", "lines"])


def profile(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """Base counts and lines per row, kept as a table and numbered."""
    counted = map_batches(
        docs.select(id_col, host_col, text_col, F.xxhash64(text_col)), _profile,
        f"doc {type_of(docs, id_col)}, host {type_of(docs, host_col)}, content long, "
        "copy long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "lines array<struct<line: long, words: long>>")
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return keep_table(counted.withColumn("base_failed", failed)
                      .withColumn("number", F.monotonically_increasing_id()))


def frequent_lines(profiled: DataFrame) -> DataFrame:
    """(host, line) above the limit, and the text that keeps it, if any."""
    texts = profiled.groupBy("host", "content").agg(
        F.count_distinct(F.struct("doc")).alias("documents"), F.min("number").alias("number"),
        F.min(F.struct("doc")).alias("least"))
    # One row for each text goes on, so a text with many copies weighs no more than others.
    order = F.struct((-F.col("documents")).alias("fewest"), "least")
    return (profiled.select("number", "host", "content", "base_failed", "lines")
            .join(texts.select("number", "documents", "least"), "number")
            .select(F.struct("host").alias("host"), "content", "documents", "least", "base_failed",
                    F.explode("lines").alias("at"))
            .groupBy("host", F.col("at.line").alias("line"))
            .agg(F.sum("documents").alias("n"),
                 F.min_by("content", F.when(~F.col("base_failed"), order)).alias("spared"))
            .filter(F.col("n") > MIN_DOCUMENTS)
            .select("host", "line", "spared"))


def _judged(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """Profile and verdict per row, with the hashes of the lines it loses."""
    profiled = profile(docs, id_col, text_col, host_col)
    hits = (profiled.select("number", F.struct("host").alias("host"), "content",
                            F.explode("lines").alias("at"))
            .select("number", "host", "content", F.col("at.line").alias("line"),
                    F.col("at.words").alias("words"))
            .join(frequent_lines(profiled), ["host", "line"])
            .filter(~F.col("content").eqNullSafe(F.col("spared")))
            .groupBy("number").agg(F.sum("words").alias("removed"),
                                   F.collect_list("line").alias("lost")))
    left = F.col("n_words") - F.col("boilerplate_words")
    return (profiled.drop("lines").join(hits, "number", "left")
            .withColumn("boilerplate_words", F.coalesce("removed", F.lit(0)))
            .withColumn("kept", ~F.col("base_failed") & (left >= LEAST_WORDS)
                        & (left >= F.col("n_words") * LEAST_SHARE)))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          host_col: str = "source") -> DataFrame:
    """One row per row: id, base counts, base_failed, kept, and boilerplate_words."""
    return _judged(docs, id_col, text_col, host_col).select(
        F.col("doc").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "boilerplate_words")


def _remove(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    texts, gone = batch.column(1).cast(pa.binary()).to_pylist(), [0] * batch.num_rows
    for number, lost in enumerate(batch.column(2).to_pylist()):
        if lost:
            texts[number], gone[number] = without_lines(texts[number], set(lost))
    yield pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(texts, pa.binary()).cast(pa.string()),
         pa.array(gone, pa.int64()), batch.column(3)],
        ["doc", "kept_text", "n_lines_removed", "carried"])


def kept_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               host_col: str = "source", carried: tuple[str, ...] = ("source",)) -> DataFrame:
    """Rows of the documents that stay: id, kept_text, n_lines_removed and a struct ``carried``.

    ``kept_text`` is the text without its lines above the limit; a text without such
    lines is as it was. A document stays with all its rows if one of them is kept; null
    ids are one document. ``carried`` names the other columns that follow.
    """
    rows = keep_table(_judged(docs, id_col, text_col, host_col)
                      .select("doc", "host", "copy", "kept", "lost"))
    ids = rows.filter("kept").select(F.col("doc").alias("kept_id")).distinct()
    # Texts of one host that share a hash get the lines of both, which are above the limit.
    lost = (rows.join(ids, F.col("doc").eqNullSafe(F.col("kept_id")), "left_semi")
            .groupBy("doc", "host", "copy")
            .agg(F.array_distinct(F.flatten(F.collect_set("lost"))).alias("lost")))
    texts = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(host_col).alias("at"),
        F.xxhash64(text_col).alias("hash"), F.struct(*carried).alias("carried"))
    joined = texts.join(lost, F.col("id").eqNullSafe(F.col("doc"))
                        & F.col("at").eqNullSafe(F.col("host"))
                        & (F.col("hash") == F.col("copy")))
    return map_batches(
        joined.select("id", "text", "lost", "carried"), _remove,
        f"doc {type_of(docs, id_col)}, kept_text string, n_lines_removed long, "
        f"carried {type_of(texts, 'carried')}").withColumnRenamed("doc", id_col)
