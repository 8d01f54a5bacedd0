"""Documents set aside before the join are linked with none; rows of one id are judged apart."""

import random

import numpy as np
import pytest

import corpus_pipeline as pipeline
from quotelane.llm import jaccard
from quotelane.llm.shingles import shingle_sets
from tests.llm import plain


@pytest.mark.parametrize("share", [(80, 100), (90, 100), (50, 100), (100, 100), (10, 100)])
def test_linked_sets_share_enough_of_their_beginnings(spark, share):
    part, whole = share
    rng = random.Random(part)
    needed = {}
    for n, least in spark.range(1, 1500).select("id", jaccard._needed(jaccard.F.col("id"), part, whole).alias("least")).collect():
        needed[n] = least
    for _ in range(400):
        size = rng.choice([1, 2, 5, 9, 10, 11, 30, 99, 250, 700])
        x = {rng.getrandbits(64) for _ in range(size)}
        common = set(rng.sample(sorted(x), max(1, int(size * rng.uniform(part / whole, 1)))))
        y = common | {rng.getrandbits(64) for _ in range(int(size * (1 - part / whole) * rng.random()))}
        if whole * len(x & y) < part * len(x | y):
            continue
        starts = [set(sorted(s)[: int(jaccard._beginning(np.int64(len(s)), part, whole))]) for s in (x, y)]
        both = len(starts[0] & starts[1])
        assert both >= max(needed[len(x)], needed[len(y)])


def test_links_at_the_border_are_found(spark, make_docs):
    """Edited copies of long texts, near 0.8, among texts that share a passage with all others."""
    rng = random.Random(3)
    passage = " ".join(f"shared{i}" for i in range(60))
    texts = []
    for base in range(12):
        words = [f"w{base}x{i}" for i in range(rng.choice([40, 150, 420]))]
        texts.append(" ".join(words))
        for _ in range(4):
            edited = list(words)
            for at in rng.sample(range(len(words)), max(1, int(len(words) * rng.uniform(0.005, 0.035)))):
                edited[at] = f"e{rng.random()}"
            texts.append(" ".join(edited))
        texts.append(" ".join(f"o{base}y{i}" for i in range(300)) + " " + passage)
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    for width, share, screen in ((5, (80, 100), True), (3, (90, 100), True), (3, (90, 100), False)):
        classes = jaccard.classes(make_docs(rows), width, share, screen)
        found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in classes.collect()}
        assert found == plain.near([(i, t) for i, t, _, _ in rows], width, *share)
        assert len({c for _, c in found.values()}) < len(rows)


@pytest.mark.parametrize("count", [60, 240])
def test_a_passage_of_many_documents_makes_no_pairs(spark, make_docs, monkeypatch, count):
    """Documents of which half is a common passage are compared with no pivot; copies among them are found."""
    rng = random.Random(count)
    passage = [f"shared{i}" for i in range(60)]
    texts = [" ".join([*passage, *(f"o{rng.random()}" for _ in range(60))]) for _ in range(count)]
    texts += [" ".join(t.split()[:-1] + ["other"]) for t in texts[:5]]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    made, written = {}, jaccard.written

    def counted(df, label, **settings):
        found = written(df, label, **settings)
        made[label] = found.count()
        return found

    monkeypatch.setattr(jaccard, "written", counted)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.classes(make_docs(rows), 5, (80, 100), True).collect()}
    assert found == plain.near(list(enumerate(texts)), 5, 80, 100)
    assert [found[count + i][1] for i in range(5)] == list(range(5))
    assert made["pairs"] <= 100  # those of ten documents, however many share the passage


def test_rings_are_made_once(spark, make_docs, monkeypatch):
    """Copies further from each other than a link: what the join by pivot makes is read back, not made again."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(40):
        edited = list(words)
        for at in rng.sample(range(120), 2):
            edited[at] = f"e{rng.random()}"
        texts.append(" ".join(edited))
    regions, plans = jaccard._regions, []

    def seen(*given):
        links = regions(*given)
        plans.append(links._jdf.queryExecution().optimizedPlan().toString())
        return links

    monkeypatch.setattr(jaccard, "_regions", seen)
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.classes(make_docs(rows), 5, (80, 100), True).collect()}
    assert found == plain.near(list(enumerate(texts)), 5, 80, 100)
    assert plans
    assert "LeftSemi" not in plans[0]


def test_packed_numbers_come_back():
    rng = np.random.default_rng(1)
    for values in (np.sort(rng.integers(0, 1 << 62, 50).astype(np.uint64)), np.arange(7, dtype=np.uint64), np.array([5], np.uint64)):
        assert (jaccard._from_steps(jaccard._steps(values)) == values).all()
    refs = rng.integers(0, 1 << 48, 40).astype(np.uint64)
    assert (jaccard._long(jaccard._short(refs)) == refs).all()
    assert len(shingle_sets(["a b c"], 3)[0]) == 1


def test_rows_of_one_id_are_judged_apart(spark, make_docs):
    one = " ".join(f"a{i}" for i in range(200))
    near = one.replace("a100 ", "b ")
    other = " ".join(f"c{i}" for i in range(200))
    rows = [(1, one, "en", "a"), (5, near, "en", "a"), (5, other, "en", "a"), (5, other, "en", "a"), (None, near, "en", "b"), (None, None, "en", "b")]
    kept = pipeline.drop_near_copies(spark, make_docs(rows), "").collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted([(1, one), (5, other), (None, None)], key=str)


def test_equal_rows_each_have_their_part_of_a_mix(spark, make_docs):
    rows = [(1, "x y z", "en", "a")] * 3 + [(2, "p q", "en", "b"), (None, "n m o", "en", "b"), (None, "n m o", "en", "b")]
    out = pipeline.mix_sources(spark, make_docs(rows), "").collect()
    sizes = [(d, s, len(t.split())) for d, t, _, s in rows]
    _, taken = plain.mix([(d, s, n) for d, s, n in sizes])
    assert sum(len(r["text"].split()) for r in out) == sum(n for _, _, n in taken)
