"""Words of documents whose ids repeat or are null, and what of them moves."""

from quotelane.plans import catalog


def _documents(spark, folder, rows):
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_word_split_of_ids_that_repeat_or_are_null(spark, tmp_path):
    folder = _documents(spark, tmp_path, [(1, "a a b"), (1, "a"), (2, "b"), (2, None), (None, "a b"), (None, "a")])
    got = {(r["doc_id"], r["word"], r["count"]) for r in catalog.word_split(spark, folder).collect()}
    assert got == {(1, "a", 3), (1, "b", 1), (2, "b", 1), (None, "a", 2), (None, "b", 1)}


def test_word_split_moves_texts_and_not_words(spark, tmp_path):
    folder = _documents(spark, tmp_path, [(i, "a b c") for i in range(50)])
    plan = catalog.word_split(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("Generate")]
