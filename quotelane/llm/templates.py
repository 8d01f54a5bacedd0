"""Main text of web pages, by the template that pages of one host share.

The tokens of a page are its block-level elements, each as the path of elements around it, and its blocks of
text. How often a token occurs on each page of the host is its occurrence vector; vectors are summed
up as hashes, a partial sum per task, so a large host is never gathered. Tokens of equal vectors on at
least half of the host's pages form an equivalence class. A class is valid if its tokens come in
one order on all its pages. The tokens of valid classes nest into the template: an element lies in
that of the longest path before it, and what lies between them is a slot.

A slot is judged on all pages of the host: by what its elements say (article, menu, advert, form...), by the
share of its text in links (as each block of it is), and by the share of its blocks that are template text themselves. What
remains is extracted: of a page with an article, the article; else of one with a main part, that; else
of the parts named as text; else all other slots. Blocks that the template holds as text are left out,
but not within an article, whose copies on one host would else pass for its template. Elements within a
slot that only some pages have are judged by what they say.

Defined cases: a null or empty page has no text; a page without host, or the only one of its host, has
no template and is judged by its own elements; equal pages give equal rows; an unclosed comment or
script ends with the page; an unclosed menu ends where an article begins; an empty table gives an
empty result; other columns are ignored; a long page is read whole.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelane.llm.common import written
from quotelane.llm.markup import ARTICLE, ROOT, blocks

MOST_LINKED = 0.5
MOST_FIXED = 0.5
LEAST_PAGES = 2

_TOKENS = (
    "host string, page long, token long, is_text boolean, n int, first int, last int, path long, "
    "above array<long>, chars long, linked long, level int, aside boolean"
)
_TOKEN_TYPES = [
    pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.int64(),
    pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int32(), pa.bool_(),
]


def code(text: str) -> int:
    """A 64-bit number for a path or a block."""
    value = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def _text_code(path: str, text: str) -> int:
    return code(f"{path}\n{text}")


def _chain(path: str) -> list[int]:
    """Numbers of a path and those around it, outermost first."""
    out, at = [], 0
    while (at := path.find(">", at + 1)) > 0:
        out.append(code(path[:at]))
    return [code(""), *out, *([code(path)] if path else [])]


def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (host, page, html): a row per distinct token of a page."""
    names = [f.split()[0] for f in _TOKENS.split(", ")]
    chains: dict[str, list[int]] = {}
    for batch in batches:
        columns: list[list] = [[] for _ in names]
        for host, page, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found, begun = blocks(html)
            seen: dict[int, list] = {}
            if len(chains) > 1 << 14:
                chains.clear()

            def meet(token: int, is_text: bool, place: int, element, chars: int = 0, linked: int = 0) -> None:
                row = seen.get(token)
                if row is None:
                    chain = chains.get(element.path)
                    if chain is None:
                        chain = chains[element.path] = _chain(element.path)
                    seen[token] = [
                        host, page, token, is_text, 1, place, place, chain[-1], None if is_text else chain,
                        chars, linked, element.level, element.aside,
                    ]
                else:
                    row[4] += 1
                    row[6] = place
                    row[9] += chars
                    row[10] += linked

            meet(code(""), False, -1, ROOT)
            for place, element in enumerate(begun):
                meet(code(element.path), False, place, element)
            for place, block in enumerate(found):
                element = block.element
                meet(_text_code(element.path, block.text), True, place, element, len(block.text), block.linked)
            for row in seen.values():
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            if len(columns[0]) >= 1 << 14:
                yield _batch(columns, names)
                columns = [[] for _ in names]
        if columns[0]:
            yield _batch(columns, names)


def _batch(columns: list[list], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TOKEN_TYPES, strict=True)], names=names)


def classes(found: DataFrame) -> DataFrame:
    """Tokens of valid equivalence classes: host, token, is_text, class, and sums over the host's pages."""

    def vector(seed: int) -> F.Column:
        return F.sum(F.xxhash64("page", "n", F.lit(seed)).cast("decimal(20,0)"))

    per_token = found.groupBy("host", "token", "is_text").agg(
        F.count("*").alias("pages"),
        vector(1).alias("v1"),
        vector(2).alias("v2"),
        F.sum("n").alias("blocks"),
        F.min("path").alias("path"),
        F.max("above").alias("above"),
        F.sum("chars").alias("chars"),
        F.sum("linked").alias("linked"),
        F.max("level").alias("level"),
        F.max("aside").alias("aside"),
    )
    per_token = written(per_token, "tokens", light=True)
    hosts = per_token.where(F.col("token") == code("")).select("host", F.col("pages").alias("host_pages"))
    often = per_token.join(hosts, "host").where(
        (F.col("host_pages") >= LEAST_PAGES) & (2 * F.col("pages") >= F.col("host_pages"))
    )
    named = often.withColumn("class", F.xxhash64("host", "pages", "v1", "v2"))
    # of one order: the tokens of a class, sorted as they first come on a page, are the same row on all pages
    met = found.join(named.select("host", "token", "class"), ["host", "token"])
    orders = met.groupBy("host", "class", "page", "is_text").agg(
        F.array_sort(F.collect_set(F.struct("first", "token"))).alias("order")
    )
    order = F.xxhash64(F.transform("order", lambda o: o["token"]))
    valid = (
        orders.groupBy("host", "class", "is_text")
        .agg(F.min(order).alias("least"), F.max(order).alias("most"))
        .where(F.col("least") == F.col("most"))
        .select("host", "class", "is_text")
    )
    return named.join(valid, ["host", "class", "is_text"], "left_semi"), per_token


def template(found: DataFrame) -> DataFrame:
    """A row per host of several pages: its slots, whether each is kept, and its fixed blocks of text.

    At most twice a host's mean number of tokens on a page are on half of its pages, which bounds a row.
    """
    members, per_token = classes(found)
    members = written(members, "classes", light=True)
    marks = members.where("NOT is_text").select("host", F.col("token").alias("slot"))
    # the slot of a path is that of the last element before it that the template has
    above = per_token.where("NOT is_text").select("host", "path", F.posexplode("above").alias("depth", "slot"))
    slots = above.join(marks, ["host", "slot"]).groupBy("host", "path").agg(F.max_by("slot", "depth").alias("slot"))
    fixed = members.where("is_text").select("host", "token", F.lit(True).alias("fixed"))
    texts = per_token.where("is_text").join(fixed, ["host", "token"], "left").join(slots, ["host", "path"])
    sums = texts.groupBy("host", "slot").agg(
        F.sum("chars").alias("chars"),
        F.sum("linked").alias("linked"),
        F.sum("blocks").alias("blocks"),
        F.sum(F.when(F.col("fixed"), F.col("blocks")).otherwise(0)).alias("fixed_blocks"),
    )
    said = members.where("NOT is_text").select("host", F.col("token").alias("slot"), "level", "aside")
    judged = said.join(sums, ["host", "slot"], "left").select(
        "host",
        "slot",
        F.when(F.col("aside"), F.lit(False))
        .when(F.col("level") == ARTICLE, F.lit(True))
        .otherwise(
            (F.coalesce("linked", F.lit(0)) <= MOST_LINKED * F.coalesce("chars", F.lit(0)))
            & (F.coalesce("fixed_blocks", F.lit(0)) <= MOST_FIXED * F.coalesce("blocks", F.lit(0)))
        )
        .alias("kept"),
    )
    kept = judged.groupBy("host").agg(F.collect_list(F.struct("slot", "kept")).alias("slots"))
    constant = fixed.groupBy("host").agg(F.collect_list("token").alias("fixed"))
    return kept.join(constant, "host", "left")


def main_text(page: str | None, slots: dict[int, bool], fixed: set[int]) -> str:
    """A page's blocks in kept slots, joined by line feeds. Without template, its elements decide alone."""
    found, _ = blocks(page)
    best = max((b.element.level for b in found if not b.element.aside), default=0)
    links: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    judged: dict[str, bool | None] = {}
    for block in found:
        path = block.element.path
        if path not in judged:
            judged[path] = next((slots[c] for c in reversed(_chain(path)) if c in slots), None) if slots else None
        if judged[path] is None:
            links[path][0] += block.linked
            links[path][1] += len(block.text)
    out, held = [], []
    for block in found:
        element = block.element
        if element.aside or element.level < best:
            continue
        if element.level < ARTICLE:
            kept = judged[element.path]
            if kept is None:
                linked, chars = links[element.path]
                kept = linked <= MOST_LINKED * chars
            kept = kept and block.linked <= MOST_LINKED * len(block.text)
            held.append(block.text)
            if not kept or _text_code(element.path, block.text) in fixed:
                continue
        out.append(block.text)
    return "\n".join(out or held)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, known = [], {}
        held = batch.column(4).to_pylist(), batch.column(5).to_pylist()
        for host, html, slots, fixed in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), *held, strict=True):
            if slots is None:
                texts.append(main_text(html, {}, set()))
                continue
            if host not in known:
                known[host] = {s["slot"]: s["kept"] for s in slots}, set(fixed or ())
            texts.append(main_text(html, *known[host]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and the main text of every page."""
    url = F.col("url").cast("string")
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(
        "page_id", "url", F.when(host != "", host).alias("host"), F.col("html").cast("string").alias("html")
    )
    keyed = rows.where("host IS NOT NULL").select("host", F.xxhash64("page_id", "url", "html").alias("page"), "html")
    found = written(keyed.mapInArrow(tokens, _TOKENS), "page-tokens")
    templates = written(template(found), "templates", light=True)
    joined = rows.join(templates, "host", "left").select("page_id", "url", "host", "html", "slots", "fixed")
    fields = f"page_id {rows.schema['page_id'].dataType.simpleString()}, url {rows.schema['url'].dataType.simpleString()}"
    return joined.mapInArrow(_extracted, f"{fields}, text string")
