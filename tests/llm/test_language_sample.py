"""The sample that dictionaries are made from, and texts that are kept."""

import pyarrow as pa

from quotelane.llm import language


def _run(rows: list[tuple], docs: int, size: int) -> list[tuple]:
    columns = [pa.array(c) for c in zip(*rows, strict=True)]
    batch = pa.RecordBatch.from_arrays(columns, names=["lang", "key", "piece"])
    batches = (batch.slice(i, size) for i in range(0, batch.num_rows, size))
    return [tuple(r.values()) for out in language._smallest(docs)(batches) for r in out.to_pylist()]


def test_a_task_gives_its_smallest_distinct_pieces():
    rows = [(f"l{i % 3}", (i * 7919) % 401 - 200, f"p{i % 5}") for i in range(3000)]
    rows += [("l0", -200, "same")] * 1000  # copies are one
    got = _run(rows, 16, 100)
    for lang in ("l0", "l1", "l2"):
        assert [r for r in got if r[0] == lang] == sorted({r for r in rows if r[0] == lang})[:16]


def test_one_language_too_many_is_held_and_no_more():
    rows = [(f"l{i}", i, "p") for i in range(2 * language.MOST_LANGUAGES)]
    assert len({r[0] for r in _run(rows, 4, 50)}) == language.MOST_LANGUAGES + 1
    assert list(language._smallest(4)(iter(())))[0].num_rows == 0


def test_repeated_rows_and_kept_texts(spark, make_docs):
    rows = [(i % 4, t * 4, lang, "s") for i in range(12) for lang, t in (("en", "the cat of the house "), ("de", "die katze im haus "))]
    learned = language.learn(make_docs(rows).repartition(5))
    assert {lang: raw.count(b"\n") for lang, raw in learned.items()} == {"de": 0, "en": 0}  # one distinct text each
    found = language.identify(make_docs(rows), learned, ["doc_id", "text"]).collect()
    assert sorted((r["doc_id"], r["text"], r["lang_pred"]) for r in found) == sorted((d, t, lang) for d, t, lang, _ in rows)
    none = make_docs(rows).limit(0)
    assert language.learn(none) == {} and language.identify(none, learned, ["doc_id", "text"]).count() == 0
