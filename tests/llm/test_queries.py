"""Every query with SQL against it; those without against plain versions."""

import zlib

import numpy as np
import pytest

from quotelane.llm.catalog import QUERIES
from quotelane.llm.oracle import SQL
from tests.compare import connect, difference
from tests.llm import plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return connect(SF)


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]


@pytest.fixture(scope="module")
def ids(documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {d: np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for d, t in documents}


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, sql, name):
    ours = QUERIES[name](spark, SF).toPandas()
    assert len(ours)
    assert difference(ours, sql.execute(SQL[name]).df()) is None


def test_repeated_strings(spark, documents):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    ours = [tuple(r) for r in QUERIES["op5_suffixes"](spark, SF).select(*columns).collect()]
    assert sorted(ours, key=repr) == plain.without_repeats(documents)


def test_near_documents(spark, documents):
    ours = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op6_jaccard"](spark, SF).collect()}
    assert ours == plain.near(documents, 3, 90, 100)


def test_packing(spark, ids):
    rows = QUERIES["op7_packing"](spark, SF).toPandas()
    for doc, group in rows.sort_values("start").groupby("doc_id"):
        assert (group["doc_tokens"] == len(ids[doc])).all()
        at = 0
        for start, length, crc in zip(group["start"], group["length"], group["ids_crc32"], strict=True):
            assert start == at and zlib.crc32(ids[doc][start : start + length].tobytes()) == crc
            at += length
        assert at == len(ids[doc])
    assert set(rows["doc_id"]) == set(ids)
    padding = 0
    for _, group in rows.sort_values("offset").groupby("sequence_id"):
        assert group["offset"].tolist() == [0, *group["length"].cumsum().tolist()[:-1]]
        size = int(group["length"].sum())
        assert size <= 1024
        padding += 0 if size & (size - 1) == 0 else 1024 - size
    assert padding < 0.05 * rows["length"].sum()


def test_token_files(spark, ids):
    rows = {r["doc_id"]: r for r in QUERIES["op9_frames"](spark, SF).collect()}
    at = 0
    for doc in sorted(ids):
        row = rows.pop(doc)
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (at, len(ids[doc]), zlib.crc32(ids[doc].tobytes()))
        at += len(ids[doc])
    assert not rows


def test_language_of_held_out_documents(spark):
    ours = QUERIES["op8_language"](spark, "/root/testdata/sf0.01").toPandas()
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    both = ours.merge(truth, on="doc_id")
    held = both[both["held_out"]]
    assert (held["doc_id"].map(lambda d: zlib.crc32(str(d).encode()) % 4) == 2).all()
    assert (held["lang"] == held["lang_pred"]).mean() > 0.97
    assert both["score"].between(0, 1).all() and len(both) == len(truth)
