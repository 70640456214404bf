from __future__ import annotations

import pytest

from authwatch.llm.queries import ship_package

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture()
def frame(spark):
    """Documents from (doc_id, text) pairs, over several partitions, with columns whose
    names clash with those that operators use."""
    def build(rows, parts=4, extra=True):
        df = spark.createDataFrame(
            [(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t)) for i, t in rows],
            DOC).repartition(parts)
        if extra:
            df = df.selectExpr("*", "1 as doc", "'x' as id", "2 as n", "3 as start", "4 as key",
                               "true as kept", "5 as ranges", "6 as size", "7 as digest")
        return df
    return build


@pytest.fixture()
def odd_rows():
    """Nulls, empty and blank texts, ties, and repeated rows."""
    line = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
    return [(None, line * 3), (None, None), (1, None), (2, ""), (3, " \n\t"), (4, line * 3),
            (4, line * 3), (5, line * 3), (6, "É" * 300), (7, "é"), (8, line.upper() * 2)]

