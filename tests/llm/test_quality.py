"""Quality rules and classifier."""

from __future__ import annotations

import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import SF_DIR

from authwatch.llm import quality_classifier, quality_rules


def base_brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[n:n + 8]) for n in range(len(words) - 7))
    covered = {m for n in range(len(words) - 7) if windows[tuple(words[n:n + 8])] > 1
               for m in range(n, n + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def test_base_counts_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = quality_rules.judge(docs).collect()
    assert len(rows) == len(texts)
    for row in rows:
        want = base_brute(texts[row.doc_id])
        assert tuple(row[1:6]) == want
        assert row.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])


def judged(frame, rows):
    df = frame(rows)
    return {r.doc_id: r for r in quality_rules.judge(df).collect()}


def body(n):
    return " ".join(f"w{n}x{m}" for m in range(60))


def rule_brute(rows):
    """doc_id -> (boilerplate_words, kept) and the kept text, by the rule as stated."""
    rows = [(i, t or "", f"src{(i or 0) % 3}") for i, t in rows]

    def lines(text):
        return [" ".join(re.findall(r"[^\x20\x09-\x0D]+", x)).lower() for x in text.split("\n")]

    def failed(text):
        n, *_, repeated = base_brute(text)
        return n < 20 or 100 * repeated > 30 * n

    ids = {}
    for i, text, host in rows:
        ids.setdefault((host, text), set()).add(i)
    holders = {}
    for host, text in ids:
        for line in set(lines(text)) - {""}:
            holders.setdefault((host, line), []).append(text)
    spared = {}
    for (host, line), texts in holders.items():
        if sum(len(ids[host, t]) for t in texts) > 20:
            spared[host, line] = min((t for t in texts if not failed(t)), default=None, key=lambda t: (
                -len(ids[host, t]), min(ids[host, t])))
    out = {}
    for i, text, host in rows:
        gone = [(host, x) in spared and spared[host, x] != text for x in lines(text)]
        removed = sum(len(x.split()) for x, lost in zip(lines(text), gone, strict=True) if lost)
        left = len(text.split()) - removed
        kept = not failed(text) and left >= 20 and left >= 0.3 * len(text.split())
        out[i] = removed, kept, "\n".join(
            x for x, lost in zip(text.split("\n"), gone, strict=True) if not lost)
    return out


def check_rule(frame, rows):
    want = rule_brute(rows)
    got = judged(frame, rows)
    assert {i: (r.boilerplate_words, r.kept) for i, r in got.items()} == {
        i: w[:2] for i, w in want.items()}
    texts = {r.doc_id: r.kept_text for r in quality_rules.kept_texts(frame(rows)).collect()}
    assert texts == {i: w[2] for i, w in want.items() if w[1]}
    return got


@pytest.mark.parametrize("words", [3, 40, 41, 90])
@pytest.mark.parametrize("texts, copies", [(60, 1), (20, 5), (21, 5), (20, 1), (21, 1), (1, 30)])
def test_one_rule_for_lines_of_all_lengths_and_counts(frame, words, texts, copies):
    notice = " ".join(f"notice{m}" for m in range(words))
    rows = [(3 * (n * copies + c), f"{notice}\nown words {n}\n{body(n)}")
            for n in range(texts) for c in range(copies)]
    rows += [(1, f"{notice}\n{body(1)}"), (3 * 900, notice.upper()), (4, None)]
    got = check_rule(frame, rows)
    held = sum(got[3 * n].boilerplate_words == words for n in range(texts * copies))
    # One text keeps the line, with all its copies, as soon as the host has it too often.
    assert held == (texts - 1) * copies * (texts * copies + 1 > 20)


def test_depleted_documents_go_and_hosts_are_apart(frame):
    menu = "\n".join(f"Home  About Contact {m}" for m in range(30))
    rows = [(3 * n, f"{menu.upper()}\nown words {n}") for n in range(40)]
    rows += [(3 * n, f"{menu}\n{body(n)}\n{body(n + 500)}") for n in range(40, 60)]
    rows += [(1, menu), (3 * 70 + 1, body(1))]
    got = check_rule(frame, rows)
    assert sum(got[3 * n].kept for n in range(40)) == 1
    assert all(got[3 * n].kept for n in range(40, 60))
    assert got[1].kept and got[1].boilerplate_words == 0


def test_copies_of_a_good_text_are_no_boilerplate(frame):
    text = "\n".join(" ".join(f"s{n}w{m}" for m in range(10)) for n in range(10))
    got = check_rule(frame, [(3 * n, text) for n in range(100)]
                     + [(3 * n, f"{text}\nown words {n}") for n in range(100, 105)])
    assert all(got[3 * n].kept for n in range(100))
    assert all(got[3 * n].boilerplate_words == 100 and not got[3 * n].kept for n in range(100, 105))


def test_rows_that_share_id_and_text_are_one_document(frame):
    page = "\n".join(" ".join(f"s{n}w{m}" for m in range(10)) for n in range(10))
    again = judged(frame, [(3, page)] * 100 + [(6, f"{page}\nown words")])
    assert all(row.kept and row.boilerplate_words == 0 for row in again.values())


def test_verdicts_do_not_depend_on_the_size_of_the_host(frame):
    menu = "\n".join(f"Home  About Contact {m}" for m in range(30))
    rows = [(3 * n, f"{menu}\nown words {n}") for n in range(25)]
    alone = judged(frame, rows)
    among = judged(frame, rows + [(3 * n, f"other {n}") for n in range(100, 3100)])
    assert {key: tuple(among[key]) for key, _ in rows} == {key: tuple(alone[key]) for key, _ in rows}
    assert sum(r.kept for r in alone.values()) == 1


def test_odd_rows(frame, odd_rows):
    assert quality_rules.judge(frame(odd_rows)).count() == len(odd_rows)
    assert quality_rules.judge(frame([])).count() == 0
    got = judged(frame, [(1, None), (2, ""), (3, " \n")])
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in got.values())


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    found = quality_classifier.classify(docs, labels)
    return found.join(labels, "doc_id", "left").collect()


def test_held_out_accuracy(scored):
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored)
    asked = [r for r in scored if r.held_out and r.quality is not None]
    assert sum(r.predicted == r.quality for r in asked) >= 0.9 * len(asked)


def test_ranking_of_held_out_rows(scored):
    """A guess of the majority ranks nothing: it has 0.5 here, whatever its accuracy."""
    asked = [r for r in scored if r.held_out and r.quality is not None]
    good, bad = ([r.score for r in asked if r.quality == q] for q in (1, 0))
    assert good and bad
    wins = sum((g > b) + (g == b) / 2 for g in good for b in bad)
    assert wins / (len(good) * len(bad)) >= 0.9


def plain_ftrl(vectors, labels, passes):
    """The published per-coordinate update, one number at a time."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= quality_classifier.L1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * quality_classifier.L1) / (
            (quality_classifier.BETA + math.sqrt(n[i])) / quality_classifier.ALPHA
            + quality_classifier.L2)

    for turn in range(passes):
        for number in np.random.default_rng(turn).permutation(len(vectors)):
            row = list(zip(*(x.tolist() for x in vectors[number]), strict=True))
            own = {i: weight(i) for i, _ in row}
            p = 1 / (1 + math.exp(-sum(own[i] * x for i, x in row)))
            for i, x in row:
                g = (p - labels[number]) * x
                before = n.get(i, 0.0)
                sigma = (math.sqrt(before + g * g) - math.sqrt(before)) / quality_classifier.ALPHA
                z[i] = z.get(i, 0.0) + g - sigma * own[i]
                n[i] = before + g * g
    return {i: weight(i) for i in z}


def test_weights_equal_the_plain_update():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["good", "fine", "##", "junk", "a", "b", "c"], 12)) for _ in range(40)]
    labels = [int("good" in t and "##" not in t) for t in texts]
    buckets, bounds = quality_classifier.hashed_ngrams(pa.array(texts))
    vectors = [quality_classifier.sparse_vector(buckets[a:b])
               for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    got = quality_classifier.train_shard(vectors, labels)
    want = plain_ftrl(vectors, labels, quality_classifier.PASSES)
    assert np.count_nonzero(got) == sum(w != 0 for w in want.values()) > 10
    assert all(got[i] == pytest.approx(w, rel=1e-9, abs=1e-12) for i, w in want.items())


def test_long_texts_score(spark, frame):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    rows = [(1, "good words " * 60_000), (2, "x" * 300_000), (3, "## " * 9)]
    got = quality_classifier.classify(frame(rows), labels).collect()
    assert len(got) == 3 and all(0 <= r.score <= 1 for r in got)


def test_scores_do_not_depend_on_labels_of_held_out_rows(spark, frame):
    rows = [(n, f"good fine text {n % 7}" if n % 2 else f"## $$ junk {n % 5}") for n in range(200)]
    labels = [(n, n % 2, 0) for n in range(200)]
    turned = [(n, 1 - q if crc32(str(n).encode()) % 5 == 0 else q, t) for n, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    got = [sorted(map(tuple, quality_classifier.classify(
        frame(rows), spark.createDataFrame(own, schema)).collect())) for own in (labels, turned)]
    assert got[0] == got[1]
    assert sum(r[3] == r[0] % 2 for r in got[0]) >= 190


def test_odd_rows_score(spark, frame, odd_rows):
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (8, None, 0), (7, 0, 0), (99, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality_classifier.classify(frame(odd_rows), labels).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    assert quality_classifier.classify(frame([]), labels).count() == 0
