"""Language identification by compression.

Each language is a raw-content zstandard dictionary: text of that language. A text is cut into
blocks that are compressed apart with every dictionary; the language whose dictionary gives the
fewest bytes wins. Blocks keep the dictionary's part the same in long texts as in short ones. The
margin is the part of the second-best size that the best saves; narrow margins are rejected. Case is ignored.

The dictionaries are made from a bounded sample: of every language the ``SAMPLE_DOCS`` labelled
texts of smallest hash, ``SAMPLE_BYTES / SAMPLE_DOCS`` bytes of each (less one that parts them), from a place told by
the hash, so that openings which many texts share don't fill it. All else sees whole texts.

Defined cases: a null text or one without letters is ``und`` with score 0, and rejected; with one
learned language every other text is that language; with none, every text is ``und``; equal sizes
go to the language that more of the labelled texts have; repeated rows are one in the sample, count each in how often a
language is, and are each identified; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelane.llm.common import tidy

UNKNOWN = "und"
SAMPLE_DOCS = 128
SAMPLE_BYTES = 32 * 1024
MOST_LANGUAGES = 256
BLOCK = 2048
LEVEL = 6
FINE_LEVEL = 19  # for texts that the level above can't tell: it takes matches of three bytes
LEAST_MARGIN = 0.001
LEAST_BYTES = 64  # a margin tells nothing of a text of a few words; shorter ones are not rejected for it


def learn(labelled: DataFrame, docs: int = SAMPLE_DOCS, size: int = SAMPLE_BYTES) -> dict[str, bytes]:
    """A dictionary per language from rows of text and lang; at most ``MOST_LANGUAGES`` of them.

    Only the sample reaches the driver: languages x ``size`` bytes.
    """
    part = max(1, size // docs)
    key = F.xxhash64("text")
    places = F.greatest(F.lit(1), F.length("text") - part + 1)
    sample = labelled.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}")
    ).select("lang", key.alias("key"), F.col("text").substr(F.pmod(F.hash(key), places) + 1, F.lit(part)).alias("piece"))
    # a task gives its own smallest ones, so what is shuffled is bounded by the tasks, not the rows
    few = sample.mapInArrow(_smallest(docs), "lang string, key long, piece string").distinct()
    best = Window.partitionBy("lang").orderBy("key", "piece")
    rows = few.withColumn("n", F.row_number().over(best)).where(F.col("n") <= docs).collect()
    texts: dict[str, list[tuple[int, str]]] = {}
    for row in rows:
        texts.setdefault(row["lang"], []).append((row["n"], _first_bytes(row["piece"].lower(), part - 1)))
    if len(texts) > MOST_LANGUAGES:
        raise ValueError(f"{len(texts)} languages; dictionaries are sent to every task, at most {MOST_LANGUAGES}")
    often = {r["lang"]: r["count"] for r in labelled.where(F.col("lang").isin(list(texts))).groupBy("lang").count().collect()}
    return {
        lang: b"\n".join(t for _, t in sorted(texts[lang])) for lang in sorted(texts, key=lambda x: (-often[x], x))
    }


def _smallest(docs: int):
    """Of each language the ``docs`` smallest distinct (key, piece) of a task. One language too many is enough
    for the driver to refuse, so no more are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, set[tuple[int, str]]] = {}
        bounds: dict[str, int] = {}
        for batch in batches:
            for lang, key, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if lang not in held:
                    if len(held) > MOST_LANGUAGES:
                        continue
                    held[lang], bounds[lang] = set(), 1 << 63
                if key <= bounds[lang]:
                    held[lang].add((key, piece))
                    if len(held[lang]) >= 2 * docs:
                        held[lang] = set(sorted(held[lang])[:docs])
                        bounds[lang] = max(held[lang])[0]
        rows = [(lang, *row) for lang, some in held.items() for row in sorted(some)[:docs]]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        kinds = (pa.string(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=["lang", "key", "piece"]
        )

    return run


def _first_bytes(text: str, size: int) -> bytes:
    """Whole characters of a text in at most ``size`` bytes, one character at least."""
    return text.encode()[:size].decode(errors="ignore").encode() or text[:1].encode()


def _classify(dictionaries: dict[str, bytes], block: int, level: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        def coders_of(level: int) -> list[zstandard.ZstdCompressor]:
            out = []
            for raw in dictionaries.values():
                learned = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                learned.precompute_compress(level=level)
                out.append(zstandard.ZstdCompressor(level=level, dict_data=learned, write_content_size=False))
            return out

        def ranked(coders: list[zstandard.ZstdCompressor], parts: list[bytes]) -> list[tuple[int, int]]:
            return sorted((sum(len(coder.compress(part)) for part in parts), i) for i, coder in enumerate(coders))

        names, coders, fine = list(dictionaries), coders_of(level), None
        letters = lambda text: any(c.isalpha() for c in text)
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(0):
                text = text.as_py()
                if not coders or text is None or not letters(text):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                raw = text.lower().encode("utf-8", "surrogatepass")
                parts = [raw[i : i + block] for i in range(0, len(raw), block)]
                sizes = ranked(coders, parts)
                if len(sizes) > 1 and sizes[0][0] == sizes[1][0]:
                    fine = fine or coders_of(FINE_LEVEL)
                    sizes = ranked(fine, parts)
                langs.append(names[sizes[0][1]])
                scores.append(1 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0)
            first = 0 if with_text else 1
            kept = [batch.column(i) for i in range(first, batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names[first:], "lang_pred", "margin"],
            )

    return run


def identify(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    keep: list[str],
    block: int = BLOCK,
    level: int = LEVEL,
    least_margin: float = LEAST_MARGIN,
    least_bytes: int = LEAST_BYTES,
) -> DataFrame:
    """``keep`` columns with lang_pred, score (the margin, 0 to 1) and rejected. A text that is kept too goes once."""
    with_text = "text" in keep
    kept = docs.select("text", F.octet_length("text").alias("_bytes"), *(k for k in keep if k != "text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[0 if with_text else 1 :])
    found = kept.mapInArrow(
        tidy(_classify(dictionaries, block, level, with_text)), f"{fields}, lang_pred string, margin double"
    )
    narrow = (F.col("margin") < least_margin) & (F.col("_bytes") >= least_bytes)
    rejected = (F.col("lang_pred") == UNKNOWN) | narrow
    return found.select(*keep, "lang_pred", F.col("margin").alias("score"), rejected.alias("rejected"))
