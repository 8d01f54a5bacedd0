"""Spelling variants against a plain version that compares all pairs."""

import collections
import re
import zlib

import pytest

from quotelane.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain_words(rows, slips=97):
    counts = collections.Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = _lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % slips == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(words):
    found = {}
    for w, n in words.items():
        near = [v for v in words if _near(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= 2 * n else None
        found[w] = [n, len(near), form, words[form] if form else None]
    for w in found:
        root = w
        while found[root][2]:
            root = found[root][2]
        found[w].append(root)
    return {w: tuple(v) for w, v in found.items()}


def _run(docs, **options):
    words = spelling.vocabulary(docs, **options)
    rows = spelling.variants(words).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:]) for r in rows}


def _texts():
    """Near words by every edit, doublings, chains of forms, ties, other alphabets, one very long word."""
    def times(word, n):
        return " ".join([word] * n)

    long = "abcdefghij" * 300
    parts = [
        times("letter", 40), times("leter", 12), times("lettter", 12), times("lettttter", 3), times("retter", 18), times("leer", 9),
        times("Better", 9), times("bettér", 4), times("bétter", 4), times("bettere", 3), times("aaaaa", 30), times("aaaaaa", 14),
        times("aaaaaaa", 6), times("aaaab", 3), times("tießen", 4), times("tiesen", 4), times("tieten", 4), times("Ärger", 7),
        times("ärger", 3), times(long, 7), times(long[:1500] + "x" + long[1500:], 3), times(long[:2000] + "z" + long[2001:], 3),
        times("alone", 3), times("rare", 50), times("seldom", 2),
    ]
    return [(1, ". ".join(parts[:9]), "en", "a"), (2, "! ".join(parts[9:]), None, None), (2, "letter, leter", None, None),
            (None, "letter\nLETTER× løtter", "en", "a"), (4, None, "en", "a"), (5, "", "en", "a"), (6, "123 _ -", "de", "a")]


@pytest.mark.parametrize("slips", [97, 2])
def test_variants_equal_all_pairs(make_docs, slips):
    rows = _texts() * (1 if slips == 97 else 3)
    expected = plain_variants(plain_words([(d, t) for d, t, _, _ in rows], slips))
    assert _run(make_docs(rows), slips=slips) == expected
    if slips == 97:
        assert expected["leter"][2] == "letter" and expected["lettttter"][4] == "lettttter"


def test_whole_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 40")
    words = plain_words([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert _run(docs) == plain_variants(words)


def test_empty_table(make_docs):
    assert _run(make_docs(_texts()).limit(0)) == {}


def test_forms_must_rise():
    with pytest.raises(ValueError, match="times"):
        spelling.variants(None, times=1)
