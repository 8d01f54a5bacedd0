"""The manifest against a plain tree, over several rounds of swaps."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quotelane.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _hash(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _field(value):
    if value is None:
        return "-"
    return f"{len(str(value).encode('utf-8', 'surrogatepass'))}:{value}"


def plain_tree(leaves, fanout):
    """The top, and the proof of every leaf as (before, after) per level."""
    proofs, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for leaf, i in enumerate(at):
            first = i - i % fanout
            proofs[leaf].append(("".join(level[first:i]), "".join(level[i + 1 : first + fanout])))
        level = [_hash("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
        at = [i // fanout for i in at]
    return level[0], proofs


def plain_manifest(rows, fanout):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append((row["doc_id"], _hash("".join(_field(row[f]) for f in FIELDS))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = plain_tree([leaf for _, leaf in groups[g]], fanout)
    root, last = plain_tree([trees[g][0] for g in order], fanout)
    out = []
    for at, g in enumerate(order):
        for (key, leaf), proof in zip(groups[g], trees[g][1], strict=True):
            out.append((key, leaf, trees[g][0], root, tuple(proof + last[at])))
    return sorted(out, key=repr)


def _ours(docs, fanout):
    rows = merkle.manifest(docs, FIELDS, "doc_id", "lang", fanout).collect()
    return sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple((s["before"], s["after"]) for s in r["proof"])) for r in rows), key=repr)


def _rows(sizes):
    rng = random.Random(len(sizes))
    rows = []
    for lang, size in sizes.items():
        for _ in range(size):
            rows.append((rng.randrange(10**9), rng.choice(["", "text", "ä€\U0001f600", None, "x" * 30]), lang, rng.choice([None, "s1"])))
    return rows


@pytest.mark.parametrize("fanout", [2, 3])
@pytest.mark.parametrize("leaves", [4, 1024])
def test_manifest_equals_a_plain_tree(make_docs, monkeypatch, fanout, leaves):
    monkeypatch.setattr(merkle, "BLOCK_LEAVES", leaves)
    monkeypatch.setattr(merkle, "EXCHANGE", 4)
    monkeypatch.setattr(merkle, "ROWS_PER_RANGE", 50)
    sizes = {"en": 333, None: 1, "": 17, "a": 2, "é": 64, "zz": 65, "b": 129}
    docs = make_docs(_rows(sizes))
    got = _ours(docs, fanout)
    assert got == plain_manifest([r.asDict() for r in docs.collect()], fanout)


def test_odd_rows(make_docs):
    text = "long " * 100_000
    rows = [(1, text, "en", "a"), (1, text, "en", "a"), (1, "other", "en", "a"), (None, None, None, None), (None, None, None, None), (2, "", "en", None)]
    docs = make_docs(rows)
    assert _ours(docs, 2) == plain_manifest([r.asDict() for r in docs.collect()], 2)
    assert merkle.manifest(docs.limit(0), FIELDS, "doc_id", "lang").count() == 0
    one = docs.where("doc_id = 2")
    (row,) = merkle.manifest(one, FIELDS, "doc_id", "lang").collect()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof"] == []
    with pytest.raises(ValueError, match="fanout"):
        merkle.manifest(docs, FIELDS, "doc_id", "lang", 1)


def test_tampering_shows(make_docs):
    docs = make_docs(_rows({"en": 40, "de": 3}))
    made = merkle.manifest(docs, FIELDS, "doc_id", "lang", 2, {"forged": F.when(F.col("doc_id") % 2 == 0, F.lit("0" * 64))})
    top = merkle.folded(F.coalesce("forged", "leaf"), F.col("proof"))
    rows = made.select("forged", (top == F.col("root")).alias("same")).collect()
    assert len(rows) == 43 and all(r["same"] == (r["forged"] is None) for r in rows)
