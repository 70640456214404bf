"""The pipeline, stage by stage, against plain Python."""

from __future__ import annotations

import corpus_pipeline as cp
from llm_helpers import SF_DIR
from test_dedup import exact_brute, substring_brute
from test_near import brute as near_brute
from test_tokens import check_packing

from authwatch.llm import quality_rules


def test_stages_over_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = [name for name, _ in cp.STAGES]
    folder = cp.new_folder(spark, "test-pipeline")
    tables = [docs]
    for number, (name, stage) in enumerate(cp.STAGES):
        stage(spark, tables[-1], SF_DIR).write.parquet(f"{folder}/{number}")
        tables.append(spark.read.parquet(f"{folder}/{number}"))
        if number < 4:
            assert tables[-1].dtypes == docs.dtypes
    rows = [{r.doc_id: r for r in table.collect()} for table in tables[:5]]
    texts = [[(key, r.text) for key, r in own.items()] for own in rows]
    kept = {r.doc_id for r in quality_rules.judge(docs).collect() if r.kept}
    assert names[0] == "quality_rules" and set(rows[1]) == kept
    assert set(rows[2]) == {k for k, v in exact_brute(texts[1]).items() if v[2]}
    assert set(rows[3]) == {k for k, v in near_brute(texts[2]).items() if v[1] == k}
    assert all(rows[3][key] == rows[0][key] for key in rows[3])
    cut = substring_brute(texts[3], 13)
    assert set(rows[4]) == set(cut)
    for key, row in rows[4].items():
        if cut[key][1] == 0:
            assert row.text == rows[3][key].text
        else:
            assert len(row.text.split()) == cut[key][0] - cut[key][1]
        assert row.n_chars == len(row.text)
    check_packing(texts[4], tables[5].collect())


def test_odd_rows_pass_all_stages(spark, frame, odd_rows):
    for rows in (odd_rows, []):
        docs = frame(rows)
        for _, stage in cp.STAGES:
            docs = stage(spark, docs, SF_DIR)
        docs.count()


def test_quality_stage_removes_boilerplate_lines(spark, frame):
    menu = "\n".join(f"Home  About Contact {m}" for m in range(30))
    own = {3 * n: f"first {n}\n" + " ".join(f"w{n}x{m}" for m in range(200)) for n in range(40)}
    rows = [(key, f"{menu}\n\n{text}\n{menu.upper()}") for key, text in own.items()]
    other = f"{menu}\n{own[0]}"  # a host that has the menu once
    # Rows of one id share their fate, and each loses its own lines; null ids are one document.
    rows += [(1, other), (3, "short"), (None, f"{menu}\n{own[3]}"), (None, None)]
    got = cp.quality_stage(spark, frame(rows), SF_DIR).collect()
    want = [(key, f"\n{text}") for key, text in own.items()]
    # Of texts with one document each, that of the least id keeps the menu; null comes first.
    want += [(1, other), (3, "short"), (None, f"{menu}\n{own[3]}"), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(want, key=str)
    assert all(r.text is None or r.n_chars == len(r.text) for r in got)
