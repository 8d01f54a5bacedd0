"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame with the columns of documents, but for the
last, whose rows are pieces of packed sequences. ``run`` writes each stage's result as Parquet and
reads it back for the next.

Defined cases, beside those of the operators: a null text has no language and goes in the first
stage; decisions go by the row, not the id, so of rows of one id each is judged by its own text, and rows
without id are judged too; rows equal in all columns are one to the join, and each of them takes its part in
a mix; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelane.llm import jaccard, language, mixing, packing, secrets
from quotelane.llm.common import WORD, table, word_count, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NEAR_WORDS = 5
NEAR_SHARE = (80, 100)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is told; it replaces the given one."""
    docs = docs.select(*COLUMNS)
    dictionaries = language.learn(docs.select("text", "lang"))
    found = language.identify(docs, dictionaries, ["doc_id", "text", "source", "n_chars"])
    return found.where(~F.col("rejected")).select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def _row_key() -> Column:
    """A number of the row's contents; equal rows have one."""
    return F.xxhash64("doc_id", "text", "lang", "source", "n_chars")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: that of smallest id, those without id last."""
    docs = docs.select(*COLUMNS)
    keyed = docs.select(_row_key().alias("doc_id"), F.col("doc_id").alias("id"), "text")
    found = jaccard.classes(keyed, NEAR_WORDS, NEAR_SHARE, screen=True).select(F.col("doc_id").alias("_row"), "component_id")
    found = written(found, "near-copies", light=True)
    ids = keyed.select(F.col("doc_id").alias("_row"), "id")
    first = F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("_row")))
    stays = found.join(ids, "_row").groupBy("component_id").agg(first["_row"].alias("_row"))
    # both lists are of numbers only and written, so Spark knows their sizes and need not move texts for short ones
    goes = written(found.select("_row").distinct().join(stays, "_row", "left_anti"), "dropped", light=True)
    twice = written(found.groupBy("_row").count().where("count > 1").select("_row"), "repeated", light=True)
    kept = docs.withColumn("_row", _row_key()).join(goes, "_row", "left_anti")
    once = kept.join(twice, "_row", "left_anti")
    return once.unionByName(kept.join(twice, "_row", "left_semi").dropDuplicates(["_row"])).select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark."""
    docs = docs.select(*COLUMNS)
    found = secrets.findings_by_path(docs, secrets.scan(docs.select("text")))
    text = secrets.redact(F.col("text"), F.coalesce("findings", F.array()))
    changed = F.size("findings") > 0
    return found.select(
        "doc_id",
        F.when(changed, text).otherwise(F.col("text")).alias("text"),
        "lang",
        "source",
        F.when(changed, F.length(text).cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; where a source's budget ends, the words up to there."""
    docs = docs.select(*COLUMNS).withColumn("_row", _row_key())
    taken = mixing.mix(docs, word_count(F.col("text")), keys=("doc_id", "_row")).where(F.col("taken") > 0)
    cut = F.col("taken") - F.col("epochs") * F.col("size")
    whole = F.col("epochs") + F.when(cut == F.col("size"), 1).otherwise(0)
    # equal rows are interchangeable: together they have their whole copies, and one of a source at most is cut
    taken = taken.groupBy("_row").agg(
        F.sum(whole).cast("int").alias("_copies"),
        F.max(F.when(cut < F.col("size"), cut).otherwise(0)).cast("int").alias("_cut"),
    )
    rows = docs.join(taken, "_row").dropDuplicates(["_row"])
    words = F.regexp_extract_all("text", F.lit(rf"([\x20\x09-\x0D]*{WORD})"), F.lit(1))
    rest = F.when(F.col("_cut") > 0, F.array(F.array_join(F.slice(words, 1, F.col("_cut")), ""))).otherwise(
        F.array().cast("array<string>")
    )
    copies = rows.select(
        "doc_id", F.explode(F.concat(F.array_repeat("text", F.col("_copies")), rest)).alias("text"), "lang", "source", "n_chars"
    )
    return copies.withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language identification", identify_language),
    ("near copies", drop_near_copies),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Compression sizes and tokens are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
