"""The pipeline's stages against plain versions of their decisions."""

import collections
import re

import pytest

import corpus_pipeline as pipeline
from quotelane.llm.common import written
from tests.llm import plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF), name.replace(" ", "-")))
    return [[r.asDict() for r in frame.collect()] for frame in out]


def test_stages_keep_the_columns(steps):
    for rows in steps[:-1]:
        assert list(rows[0]) == pipeline.COLUMNS


def test_language(steps):
    raw, told = steps[0], {r["doc_id"]: r for r in steps[1]}
    lost = [r for r in raw if r["doc_id"] not in told]
    assert len(lost) <= 0.01 * len(raw)
    assert sum(told[r["doc_id"]]["lang"] == r["lang"] for r in raw if r["doc_id"] in told) > 0.97 * len(told)


def test_near_copies(steps):
    groups = plain.near([(r["doc_id"], r["text"]) for r in steps[1]], pipeline.NEAR_WORDS, *pipeline.NEAR_SHARE)
    assert sorted(r["doc_id"] for r in steps[2]) == sorted({c for _, c in groups.values()})


def test_secrets(steps):
    before, after = ({r["doc_id"]: r["text"] for r in steps[i]} for i in (2, 3))
    assert set(before) == set(after)
    for doc, text in before.items():
        found = plain.secrets(text)
        assert ("[SECRET]" in after[doc]) >= bool(found)
        assert not plain.secrets(after[doc])
        if not found and "[SECRET]" not in after[doc]:
            assert after[doc] == text


def test_mixing(steps):
    sizes = {r["doc_id"]: len(plain.WORD.findall(r["text"])) for r in steps[3]}
    texts = {r["doc_id"]: r["text"] for r in steps[3]}
    _, taken = plain.mix([(r["doc_id"], r["source"], sizes[r["doc_id"]]) for r in steps[3]])
    got = collections.Counter()
    for row in steps[4]:
        got[row["doc_id"]] += len(plain.WORD.findall(row["text"]))
        assert texts[row["doc_id"]].startswith(row["text"]) and row["n_chars"] == len(row["text"])
    assert {d: n for d, _, n in taken if n} == {d: n for d, n in got.items() if n}


def test_packing(steps):
    want, got = collections.Counter(r["doc_id"] for r in steps[4]), collections.Counter()
    for row in steps[5]:
        if row["start"] == 0:
            got[row["doc_id"]] += 1
    assert got == want


def test_run_and_odd_tables(spark, make_docs, tmp_path):
    assert spark is not None and re.match("/", str(tmp_path))
    rows = [(1, None, None, None), (None, "ein text und noch mehr davon, gut", None, None), (None, "ein text und noch mehr davon, gut", None, None), (2, "", "en", "a"), (3, "the text and more of it, well", "en", "a")]
    make_docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} == {None, 3}
    make_docs(rows).limit(0).write.parquet(str(tmp_path / "none/documents.parquet"))
    assert pipeline.run(spark, str(tmp_path / "none")).count() == 0
