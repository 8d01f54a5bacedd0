"""Operators on the awkward cases: nulls, empty and long texts, ties, repeated rows, empty tables."""

import collections
import datetime
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotelane.llm import arc, frames, jaccard, language, mixing, mtree, packing, quality, secrets, suffixes
from quotelane.llm.common import word_count
from quotelane.llm.graph import components
from quotelane.llm.tokens import Encoder
from tests.llm import plain

LONG = "wort und noch eines " * 20_000


def odd_rows():
    return [
        (1, "alpha beta gamma delta " * 20, "en", "a"),
        (2, None, None, None),
        (3, "", "en", "a"),
        (4, "alpha beta gamma delta " * 20, "en", None),
        (4, "alpha beta gamma delta " * 20, "en", None),
        (None, "password = hunter2hunter2", None, "b"),
        (5, "Token: abc=def; password: token: abcdefghij AKIA" + "Z" * 20 + " " + "0a" * 20, "de", "b"),
        (6, LONG, "de", "B"),
        (7, " \n\n\t", "fr", ""),
        (8, "ein einziges", "de", "b"),
    ]


def small(rows):
    return [(d, t) for d, t, _, _ in rows]


# ---- 1 ----


def test_mixing(spark, make_docs):
    rows = odd_rows()
    got = mixing.mix(make_docs(rows), word_count(F.col("text"))).collect()
    sources, taken = plain.mix([(d, s, len(plain.WORD.findall(t or ""))) for d, t, _, s in rows])
    assert sorted([(r["doc_id"], r["size"], r["taken"]) for r in got], key=repr) == taken
    assert {r["source"]: (r["source_size"], r["target"]) for r in got} == sources
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    for source, (_, target) in sources.items():
        assert sum(r["taken"] for r in got if r["source"] == source) == int(target)
    assert mixing.mix(make_docs(rows).limit(0), word_count(F.col("text"))).count() == 0


def test_mixing_of_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", 3)
    monkeypatch.setattr(mixing, "RANGES_PER_GROUP", 4)
    rng = random.Random(1)
    rows = [(i, rng.choice("aaab"), rng.randint(0, 9)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, words long")
    got = mixing.mix(docs, F.col("words")).collect()
    assert sorted([(r["doc_id"], r["size"], r["taken"]) for r in got], key=repr) == plain.mix(rows)[1]


# ---- 2 ----


def test_secrets(spark, make_docs):
    docs = make_docs(odd_rows()).withColumnRenamed("blob", "other")
    got = secrets.findings_by_path(docs, secrets.scan(docs)).collect()
    assert len(got) == len(odd_rows())
    for row in got:
        base = [(f["start"], f["rank"], f["kind"], f["end"]) for f in row["findings"] or [] if f["rank"] < 3]
        assert base == plain.secrets(row["text"])


def test_ledger_scans_only_unseen_pairs(spark):
    first = spark.createDataFrame([("a", "AKIA" + "A" * 16), ("b", None), ("c", "AKIA" + "A" * 16)], "path string, text string")
    ledger = secrets.scan(first, rules=secrets.BASE_RULES)
    assert ledger.count() == 2 * 3  # two blobs, three rules
    later = first.unionByName(spark.createDataFrame([("a", "token=12345678")], "path string, text string"))
    new = secrets.scan(later, rules=secrets.RULES, ledger=ledger)
    counts = {r["rule"]: r["count"] for r in new.groupBy("rule").count().collect()}
    assert counts == {"assign@1": 1, "access@1": 1, "hex@1": 1, "jwt@1": 3, "pem@1": 3, "forge@1": 3}
    assert secrets.scan(later, ledger=ledger.unionByName(new)).count() == 0
    found = secrets.findings_by_path(later, ledger.unionByName(new)).where("size(findings) > 0")
    assert sorted(r["path"] for r in found.collect()) == ["a", "a", "c"]


def test_redaction(spark):
    docs = spark.createDataFrame([("é token=12345678, ok",), ("nothing",), (None,)], "text string")
    found = secrets.findings_by_path(docs, secrets.scan(docs))
    out = {r[0]: r[1] for r in found.select("text", secrets.redact(F.col("text"), F.coalesce("findings", F.array()))).collect()}
    assert out == {"é token=12345678, ok": "é [SECRET], ok", "nothing": "nothing", None: None}


# ---- 3 ----


def test_quality(spark, make_docs):
    got = quality.judge(make_docs(odd_rows())).collect()
    assert len(got) == len(odd_rows())
    for row in got:
        if row["doc_id"] == 2:
            assert row["n_words"] == 0 and row["base_failed"] and not row["kept"]
        if row["doc_id"] == 6:
            assert row["n_words"] == row["n_repeat_words"] == 80_000
    lines = spark.createDataFrame([(1, "a b\n\na b\nc#|\n \na b")], "doc_id long, text string")
    row = quality.measures(lines).first()
    assert (row["n_dup_lines"], row["n_symbols"], row["word_chars"], row["n_words"]) == (2, 2, 9, 7)


# ---- 4 ----


def test_archive_versions_are_read_by_declared_length():
    body = b"HTTP/1.1 200 OK\r\n\r\nhttp://fake/ 0.0.0.0 20240101000000 text/html 5\nhello"
    for version in (1, 2):
        raw = arc.arc_head(version, "x.arc") + arc.arc_record(version, "http://a/b c", "20240102030405", body, 0, "x.arc")
        raw += arc.arc_record(version, "http://a/", "20240102030405", b"", 9, "x.arc")
        records = list(arc.read_arc(raw))
        assert [r[2] for r in records] == [body, b""]
        assert records[0][1]["URL"] == "http://a/b%20c"
        with pytest.raises(ValueError):
            list(arc.read_arc(raw[: len(raw) // 2]))
    assert arc.iso_time("20240102030405") == "2024-01-02T03:04:05Z"
    assert datetime.datetime.strptime(arc.iso_time("19991231235959"), "%Y-%m-%dT%H:%M:%SZ")


def test_archives(spark):
    big = "x" * 150
    rows = [(5, None, big), (3, "http://a/ b", big), (None, "u", big), (7, "u", "short"), (8, "u", "short"), (9, "u", None), (3, "http://a/ b", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("path", F.lit(1))
    got = sorted((tuple(r)[:5] for r in arc.read_warcs(arc.convert(arc.write_arcs(pages, 400))).collect()), key=repr)
    assert len(got) == 7
    kinds = sorted((r[0], r[3], r[4]) for r in got if r[1] == 150 and r[0] is not None)
    assert kinds == [(3, "response", None), (3, "revisit", 3), (5, "revisit", 3)]
    assert [r[3:] for r in got if r[0] is None] == [("revisit", 3)]
    assert all(r[3] == "response" for r in got if r[1] < 100)
    assert arc.read_warcs(arc.convert(arc.write_arcs(pages.limit(0)))).count() == 0


# ---- 5 ----


def test_suffix_array():
    rng = random.Random(4)
    for _ in range(100):
        letters = rng.choice((2, 3, 20))
        strings = [bytes(rng.randrange(1, letters + 1) for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(1, 9))]
        raw = b"".join(s + b"\0" for s in strings + strings[:2])
        order = suffixes.suffix_array(np.frombuffer(raw, np.uint8)).tolist()
        found = [raw[i : raw.index(b"\0", i)] for i in order]
        assert sorted(order) == list(range(len(raw))) and found == sorted(found)


def test_repeated_strings(spark, make_docs, monkeypatch):
    monkeypatch.setattr(suffixes, "GROUP_BYTES", 20_000)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 20_000)
    rng = random.Random(2)
    parts = ["".join(rng.choice("abcdé fgh") for _ in range(rng.choice([30, 49, 50, 51, 84, 120]))) for _ in range(20)]
    rows = [
        (rng.choice([i, i, i // 2]), "".join(rng.choice(parts) if rng.random() < 0.6 else "".join(rng.choice("xyz ") for _ in range(40)) for _ in range(4)), None, None)
        for i in range(120)
    ]
    rows += [r for r in odd_rows() if r[0] != 6] + [(900, "a" * 500, None, None), (901, "a" * 49, None, None), (902, "a" * 50, None, None)]
    got = suffixes.remove_repeats(make_docs(rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain.without_repeats(small(rows))
    assert suffixes.remove_repeats(make_docs(rows).limit(0)).count() == 0


def test_an_anchor_of_all_documents_loads_no_bucket(spark, make_docs, monkeypatch):
    monkeypatch.setattr(suffixes, "GROUP_BYTES", 40_000)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 80_000)
    plainly = suffixes._removed_strings

    def bounded(table):
        held = sum(len(blob) for blob in table.column("records").to_pylist())
        if held > 160_000:
            raise ValueError(f"a bucket holds {held} bytes")
        return plainly(table)

    monkeypatch.setattr(suffixes, "_removed_strings", bounded)
    rng = random.Random(6)
    own = lambda: "".join(rng.choice("abcdefgh ") for _ in range(60))
    head = own()
    rows = [(i, rng.choice(["", head]) + own() + "-" * rng.choice([50, 60, 110]) + own(), None, None) for i in range(600)]
    got = suffixes.remove_repeats(make_docs(rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain.without_repeats(small(rows))


# ---- 6 ----


@pytest.mark.parametrize(("width", "share"), [(3, (90, 100)), (5, (80, 100))])
def test_near_documents(spark, make_docs, monkeypatch, width, share):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for _ in range(30):
        base = [rng.choice(words) for _ in range(rng.choice([2, 4, 9, 11, 12, 15, 22, 40, 60, 150]))]
        for _ in range(rng.choice([1, 2, 5, 20])):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(text) // 25))):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), " ".join(text), None, None))
    rows += [(1000, None, None, None), (1001, "", None, None), (1002, "Ab", None, None), (1003, "aB", None, None), (1004, LONG, None, None)]
    docs = make_docs(rows + [(None, "Ab", None, None)])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.classes(docs, width, share).collect()}
    assert got.pop(None) == (1, None)
    assert got == plain.near(small(rows), width, *share)
    assert jaccard.classes(docs.limit(0), width, share).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    least = {x: x for e in edges for x in e}
    for _ in least:
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    assert got == {n: c for n, c in least.items() if any(n in e and e[0] != e[1] for e in edges)}


# ---- 7, 9 ----


def test_ids_equal_the_library():
    coder = Encoder()
    rng = random.Random(1)
    pieces = ["'", "s", "re", "ll", "t", " ", "  ", "\n", "\t", "1", "23", "é", "漢", "!", "Word", "\r\n", "🙂", "²", "_", "́", "<|endoftext|>", "\x00"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(3000)] + [None, ""]
    flat, ends = coder.encode(texts)
    for text, part in zip(texts, np.split(flat, ends[:-1]), strict=True):
        assert part.tolist() == [*coder.library.encode(text or "", add_special_tokens=False).ids, 0]


def test_cuts_are_cheapest():
    rng = random.Random(6)
    for _ in range(60):
        places = np.cumsum([rng.randint(1, 12) for _ in range(rng.randint(1, 30))])
        penalty = np.array([float(rng.randint(0, 9)) for _ in places])
        length, window = 16, 5.0

        def price(cuts, places=places, penalty=penalty, length=length, window=window):
            total, at = 0.0, 0
            for cut in cuts:
                size = cut - at
                total += penalty[np.flatnonzero(places == cut)[0]] + window + (0 if size in (16, 8, 4) else length - size)
                at = cut
            return total

        best = {0: (0.0, [])}
        for place in places.tolist():
            best[place] = min((price([*c, place]), [*c, place]) for p, (_, c) in best.items() if place - p <= length)
        got = packing.cut_windows(places, penalty, length, window)
        assert price(got) == best[int(places[-1])][0]


def test_the_packer_takes_every_power_of_two(monkeypatch):
    monkeypatch.setattr(packing, "_powers", lambda start, end: [end])  # leave the last window as it was cut
    rng = random.Random(8)
    length = 64
    price = lambda n: packing.WINDOW + (0 if n & (n - 1) == 0 else length - n)
    for _ in range(100):
        docs = [rng.choice([1, 2, 4, 8, 3, 9, 24]) for _ in range(rng.randint(8, 40))]
        best = {0: 0.0}
        for end in np.cumsum(docs).tolist():  # the documents' ends are the only places
            best[end] = min(cost + price(end - p) for p, cost in best.items() if end - p <= length)
        packer = packing.Packer(np.zeros(2, bool), length, 1 << 20, 0)
        for i, n in enumerate(docs):
            assert not list(packer.add(i, np.ones(n, np.int64)))
        sizes = collections.Counter()
        for piece in packer.finish():
            sizes[piece[5]] += piece[2]
        assert sum(price(n) for n in sizes.values()) == best[sum(docs)]


def test_packing(spark, make_docs):
    rows = odd_rows()
    got = packing.pack(make_docs(rows), with_ids=True).toPandas()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length for r in got.itertuples())
    assert got[got["doc_id"] == 2]["length"].tolist() == [1]
    assert got[got["doc_id"] == 4]["length"].sum() == 2 * got[got["doc_id"] == 4]["doc_tokens"].iloc[0]
    assert got.groupby("sequence_id")["length"].sum().max() <= 1024
    assert packing.pack(make_docs(rows).limit(0)).count() == 0


def test_token_files(spark, make_docs):
    import io

    import zstandard

    rows = odd_rows()
    manifest = frames.write_frames(make_docs(rows), frame_ids=50, file_chars=2000)
    got = frames.read_frames(spark, manifest).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 4, 4, 5, 6, 7, 8]
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]]).tolist()[:-1]
    wanted = {r["doc_id"]: r["ids"] for r in frames.read_documents(spark, manifest, [3, 5, 77]).collect()}
    assert set(wanted) == {3, 5} and wanted[3] == [0]
    for path in [r["path"] for r in manifest.collect()]:
        file = frames.FrameFile(path)
        list(file.documents({3}))
        assert file.decompressed <= 2
        with open(path, "rb") as raw:  # any decoder reads the whole file
            reader = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw.read()), read_across_frames=True)
            assert len(reader.readall()) == int(file.raw.sum())
    assert frames.read_frames(spark, frames.write_frames(make_docs(rows).limit(0))).count() == 0


def test_a_damaged_frame_is_found(spark, make_docs):
    path = frames.write_frames(make_docs(odd_rows())).first()["path"]
    file = frames.FrameFile(path)
    file.sums[0] ^= 1
    with pytest.raises(ValueError):
        list(file.frame(0))


# ---- 8 ----


def test_language(spark, make_docs):
    texts = {"en": "the cat and the dog of the house ", "de": "der hund und die katze im haus "}
    learned = language.learn(make_docs([(i, t * 3 + str(i), lang, "s") for i in range(9) for lang, t in texts.items()]))
    assert sorted(learned) == ["de", "en"]
    rows = [(1, texts["en"] * 50, None, None), (2, texts["de"], None, None), (3, None, None, None), (4, "12 !", None, None), (5, "", None, None)]
    got = {r["doc_id"]: r for r in language.identify(make_docs(rows), learned, ["doc_id"]).collect()}
    assert [got[i]["lang_pred"] for i in range(1, 6)] == ["en", "de", "und", "und", "und"]
    assert [got[i]["rejected"] for i in range(1, 6)] == [False, False, True, True, True]
    assert language.identify(make_docs(rows), {}, ["doc_id"]).where("lang_pred <> 'und'").count() == 0
    only = language.identify(make_docs(rows), {"en": learned["en"]}, ["doc_id"]).where("doc_id = 2").first()
    assert (only["lang_pred"], only["score"]) == ("en", 1.0)


def test_all_sampled_texts_enter_a_dictionary(make_docs):
    letters = "абвгдежзиклмнопр"
    marks = [f"ы{letters[i // 16]}{letters[i % 16]}ы" for i in range(128)]
    head = "одна и та же лицензия стоит в начале каждого текста; " * 6
    rows = [(i, head + f"{mark} " * 2000, "ru", "s") for i, mark in enumerate(marks)]
    raw = language.learn(make_docs(rows))["ru"]
    text = raw.decode(errors="ignore")
    assert len(raw) <= language.SAMPLE_BYTES
    entered = sum(mark in text for mark in marks)
    assert entered >= 120 and text.count("лицензия") < 40, (entered, text.count("лицензия"))


# ---- 10 ----


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(mtree, "BLOCK_ROWS", 60)
    monkeypatch.setattr(mtree, "LEAF_ROWS", 8)
    monkeypatch.setattr(mtree, "QUERIES_PER_CHUNK", 5)
    rng = np.random.default_rng(7)
    vectors = [rng.normal(size=6).round(3).tolist() for _ in range(300)] + [[0.5] * 6] * 60 + [[0.0] * 6, [1.0], []]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(1000, None), (1001, [1.0, None]), (1002, [float("nan")]), (1020, [float("inf")]), (None, [1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1))
    got = mtree.top_k(mtree.quantised(table), F.col("id") % 20 == 0, 7).collect()
    whole = {i: [int(np.floor(64 * x)) for x in v] for i, v in enumerate(vectors)}
    want = []
    for q in range(0, len(vectors), 20):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], w)), i) for i, w in whole.items() if i != q)
        want += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:7])]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert mtree.top_k(mtree.quantised(table.limit(0)), F.col("id") % 20 == 0).count() == 0


def test_search_skips_what_bounds_exclude():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (40, 8))
    v = np.vstack([c + rng.integers(-20, 20, (50, 8)) for c in centres])
    tree = mtree.Tree(np.arange(len(v)), v, float(np.sqrt((v.astype(float) ** 2).sum(1).max())))
    tree.computed = 0
    found = tree.search(v[0], 10, 0, None)
    products = v @ v[0]
    assert [s for s, _ in found] == sorted(np.delete(products, 0).tolist(), reverse=True)[:10]
    assert tree.computed < len(v) // 2
