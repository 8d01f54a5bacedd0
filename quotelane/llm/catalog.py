"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelane.llm import (
    arc,
    frames,
    jaccard,
    language,
    merkle,
    mixing,
    mtree,
    packing,
    quality,
    secrets,
    spelling,
    suffixes,
    templates,
)
from quotelane.llm.common import table, word_count, written

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of each document; sources weigh 1, 2, 3, repeating."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"), word_count(F.col("text")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in each document, scanned once per distinct text."""
    docs = table(spark, sf_dir, "documents")
    found = secrets.findings_by_path(docs.select("doc_id", "text"), secrets.scan(docs.select("text")))
    base = F.filter(F.coalesce("findings", F.array()), lambda f: f["rank"] < len(secrets.BASE_RULES))

    def count(kind: str) -> F.Column:
        return F.coalesce(F.size(F.filter("findings", lambda f: f["kind"] == kind)), F.lit(0)).cast("long")

    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.col("findings")).alias("spans"),
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures of each document and whether the rules keep it."""
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_arc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as legacy archives, converted to WARC and read back."""
    warcs = arc.convert(arc.write_arcs(table(spark, sf_dir, "pages")))
    read = arc.read_warcs(warcs)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the 50-byte strings that documents of smaller id have."""
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with at least 90 % of their 3-word shingles in common."""
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    dictionaries = language.learn(docs.where(~held_out).select("text", "lang"))
    marked = docs.select("text", "doc_id", held_out.alias("held_out"))
    found = language.identify(marked, dictionaries, ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op9_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to files and read back."""
    return frames.read_frames(spark, frames.write_frames(table(spark, sf_dir, "documents")))


def op10_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest products of every 20th vector with all others."""
    vectors = mtree.quantised(table(spark, sf_dir, "embeddings"))
    return mtree.top_k(vectors, F.col("id") % 20 == 0)


def op11_permuterm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots."""
    words = written(spelling.vocabulary(table(spark, sf_dir, "documents")), "vocabulary", light=True)
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, subroots and root of all documents; the root again from rows of which some are tampered with."""
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    changed = merkle.leaf([more if f == "n_chars" else F.col(f) for f in fields])
    made = merkle.manifest(docs, fields, "doc_id", "lang", carry={"changed": F.when(hit, changed)})
    refolded = merkle.folded(F.coalesce("changed", "leaf"), F.col("proof"))
    checked = made.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
        refolded.alias("folded_root"),
    )
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = templates.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op2_secrets": op2_secrets,
    "op3_quality": op3_quality,
    "op4_arc": op4_arc,
    "op5_suffixes": op5_suffixes,
    "op6_jaccard": op6_jaccard,
    "op7_packing": op7_packing,
    "op8_language": op8_language,
    "op9_frames": op9_frames,
    "op10_mtree": op10_mtree,
    "op11_permuterm": op11_permuterm,
    "op12_merkle": op12_merkle,
    "op13_templates": op13_templates,
}
