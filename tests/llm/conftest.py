import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with columns whose names clash with the operators' own."""

    def make(rows):
        full = [(d, t, lang, source, None if t is None else len(t)) for d, t, lang, source in rows]
        from pyspark.sql import functions as F

        extra = {c: F.lit(1) for c in ("size", "rep", "blob", "n", "rank", "key", "_text", "range", "grp", "sha", "cells")}
        return spark.createDataFrame(full, DOCS).withColumns(extra)

    return make
