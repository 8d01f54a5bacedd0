"""Secret scan over every version of every file, with an incremental ledger of blobs.

Content is addressed by its SHA-256. The ledger has a row per scanned pair of blob and rule
version, with the spans found (possibly none). A scan takes the distinct blobs of the given
versions, leaves out the pairs that the ledger already has, scans each remaining blob once however
many paths hold it, and ``findings_by_path`` joins the spans back to all paths. Built-in functions only.

Spans are code points, end exclusive. Matching is leftmost and non-overlapping per rule; a match
whose measured group is shorter than the rule's least length is dropped after matching.

Defined cases: null content is empty content; a blob without findings has empty lists; an empty
table gives empty results; two versions of one path are two rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelane.llm.common import written


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``group`` is the part measured against ``least``; ``hint`` must occur in the
    text for the pattern to match at all (a cheap test made first)."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    hint: str | None = None
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))

BASE_RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, group=2),
    Rule("access", r"AKIA[A-Z0-9]+", 16, hint="AKIA"),
    Rule("hex", r"[0-9a-f]{32,}", 32),
)
# What the scan adds to the base kinds.
MORE_RULES = (
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 20, hint="eyJ"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----", 40, hint="-----BEGIN "),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", 40, hint="gh"),
)
RULES = BASE_RULES + MORE_RULES
SPANS = "array<struct<start:int,end:int>>"


def _spans(text: Column, rule: Rule) -> Column:
    """Places of a rule's matches: the pieces between matches and the matches alternate, so
    running sums of their lengths are the places."""
    pattern = F.lit(f"({rule.pattern})")
    groups = rule.group + 1 if rule.group else 0
    pieces = F.transform(F.split(text, rule.pattern, -1), lambda piece: F.length(piece))
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(1)), lambda match: F.length(match))
    if groups:
        measured = F.transform(F.regexp_extract_all(text, pattern, F.lit(groups)), lambda m: F.length(m))
    else:
        measured = whole
    steps = F.arrays_zip(pieces.alias("gap"), whole.alias("length"), measured.alias("measured"))
    start = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("found")),
        lambda acc, step: F.when(step["length"].isNull(), acc).otherwise(
            F.struct(
                (acc["at"] + step["gap"] + step["length"]).alias("at"),
                F.when(
                    step["measured"] >= rule.least,
                    F.concat(
                        acc["found"],
                        F.array(
                            F.struct(
                                (acc["at"] + step["gap"]).alias("start"),
                                (acc["at"] + step["gap"] + step["length"]).alias("end"),
                            )
                        ).cast(SPANS),
                    ),
                )
                .otherwise(acc["found"])
                .alias("found"),
            )
        ),
        lambda acc: acc["found"],
    )
    may = text.rlike(rule.pattern)
    if rule.hint:
        may = text.contains(rule.hint) & may
    return F.when(may, start).otherwise(F.array().cast(SPANS))


def address(versions: DataFrame, content: str = "text") -> DataFrame:
    """The versions with ``blob``, the address of their content."""
    return versions.withColumn("blob", F.sha2(F.coalesce(F.col(content), F.lit("")), 256))


def scan(
    versions: DataFrame, content: str = "text", rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None
) -> DataFrame:
    """New rows of the ledger: blob, rule, spans, for the pairs that it doesn't have yet."""
    blobs = (
        address(versions, content)
        .select("blob", F.coalesce(F.col(content), F.lit("")).alias("_content"))
        .dropDuplicates(["blob"])
    )
    if ledger is None:
        unseen = {rule: F.lit(True) for rule in rules}
    else:
        seen = ledger.groupBy("blob").agg(F.collect_set("rule").alias("_seen"))  # at most a row per rule
        blobs = blobs.join(seen, "blob", "left")
        unseen = {rule: ~F.coalesce(F.array_contains("_seen", rule.key), F.lit(False)) for rule in rules}
        blobs = blobs.where(reduce(lambda a, b: a | b, unseen.values()))
    scanned = [
        F.when(todo, F.struct(F.lit(rule.key).alias("rule"), _spans(F.col("_content"), rule).alias("spans")))
        for rule, todo in unseen.items()
    ]
    rows = blobs.select("blob", F.filter(F.array(*scanned), lambda pair: pair.isNotNull()).alias("_pairs"))
    return rows.select("blob", F.inline("_pairs"))


def findings_by_path(
    versions: DataFrame, ledger: DataFrame, content: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """The versions with ``findings``: array of (start, rank, kind, end) over the given rules, by start."""
    ranks = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.key, i)])
    kinds = F.create_map(*[F.lit(x) for r in rules for x in (r.key, r.kind)])
    per_blob = (
        ledger.where(F.col("rule").isin([r.key for r in rules]))
        .groupBy("blob")
        .agg(F.collect_list(F.struct("rule", "spans")).alias("_pairs"))  # at most a row per rule
        .select(
            "blob",
            F.sort_array(
                F.flatten(
                    F.transform(
                        "_pairs",
                        lambda pair: F.transform(
                            pair["spans"],
                            lambda span: F.struct(
                                span["start"].alias("start"),
                                ranks[pair["rule"]].alias("rank"),
                                kinds[pair["rule"]].alias("kind"),
                                span["end"].alias("end"),
                            ),
                        ),
                    )
                )
            ).alias("findings"),
        )
    )
    # written apart from the join, so that a blob with many paths can be split there
    return address(versions, content).join(written(per_blob, "findings"), "blob", "left")


def listed(findings: Column) -> Column:
    """kind:start:end of the findings, joined by commas."""
    return F.array_join(
        F.transform(
            F.coalesce(findings, F.array()),
            lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string")),
        ),
        ",",
    )


def redact(text: Column, findings: Column, mark: str = "[SECRET]") -> Column:
    """The text with every finding replaced; overlapping findings count as one."""
    done = F.aggregate(
        findings,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, f: F.struct(
            F.greatest(acc["at"], f["end"]).alias("at"),
            F.when(
                f["start"] >= acc["at"],
                F.concat(acc["out"], F.substring(text, acc["at"] + 1, f["start"] - acc["at"]), F.lit(mark)),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
    )
    rest = F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
    return F.when(F.size(findings) > 0, rest).otherwise(text)
