"""Secrets found through a trigram inverted index, with DataFrame functions only.

Each rule is a regular expression. From its syntax tree a Boolean trigram query is derived: an
OR of clauses, each an AND of trigrams that every match must contain. The index holds
postings (trigram, text) of the lower-cased texts for the trigrams the rules ask for; clauses
are matched by intersecting postings, and only texts some clause selects are verified with
the expression itself. A few lead trigrams hit every clause; the rest are looked for behind them. A rule without mandatory trigrams scans every text.

Base rules (assign, access, hex) are leftmost non-overlapping matches with fixed limits; the
further rules add spans. Offsets are code points, ends exclusive.

A null text is an empty one: no spans. Repeated rows each get their own result row, null
ids stay null, an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``least`` bounds the length of group ``part`` of a match; shorter matches are dropped."""

    kind: str
    pattern: str
    part: int = 0
    least: int = 0
    ignore_case: bool = False
    base: bool = False

    @property
    def java(self) -> str:
        return ("(?i)" if self.ignore_case else "") + self.pattern


#: The rules in their order. A run of hex digits or of an access key's alphabet is
#: matched as a whole, so there the limit can stand in the pattern.
RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        part=2,
        least=8,
        ignore_case=True,
        base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]{12,}", base=True),
    Rule("hex", r"[0-9a-f]{32,}", base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
)

#: Matches whose positions are added up at once.
CHUNK = 128
#: Alternatives followed exactly before a part of an expression counts as unknown.
MOST_EXACT = 64

Clauses = frozenset[frozenset[str]]
ANYTHING: Clauses = frozenset([frozenset()])


def _absorb(clauses) -> Clauses:
    """Drop clauses that another one implies."""
    return frozenset(c for c in clauses if not any(d < c for d in clauses))


def _both(a: Clauses, b: Clauses) -> Clauses:
    return _absorb({x | y for x in a for y in b})


def _of_strings(strings: set[str]) -> Clauses:
    return _absorb({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def _tree(items) -> tuple[set[str] | None, Clauses]:
    """(all strings the part can match, or None, and the clauses of the part)."""
    strings, clauses, exact = {""}, ANYTHING, True
    for name, value in items:
        own: set[str] | None = None
        needs = ANYTHING
        match str(name):
            case "LITERAL":
                own = {chr(value).lower()}
            case "IN" if all(str(k) in ("LITERAL", "RANGE") for k, _ in value):
                spans = [(v, v) if str(k) == "LITERAL" else v for k, v in value]
                if sum(b - a + 1 for a, b in spans) <= MOST_EXACT // 4:
                    own = {chr(c).lower() for a, b in spans for c in range(a, b + 1)}
            case "SUBPATTERN":
                own, needs = _tree(value[3])
            case "BRANCH":
                found = [_tree(x) for x in value[1]]
                needs = _absorb(set().union(*(n for _, n in found)))
                if all(o is not None for o, _ in found):
                    own = set().union(*(o for o, _ in found))
            case "MAX_REPEAT" | "MIN_REPEAT" | "POSSESSIVE_REPEAT":
                least, most, part = value
                inner, inner_needs = _tree(part)
                if inner is not None and most == 1:
                    own = inner | ({""} if least == 0 else set())
                elif least:
                    needs = inner_needs
                    if inner is not None and least == most and len(inner) ** least <= MOST_EXACT:
                        own = {""}
                        for _ in range(least):
                            own = {a + b for a in own for b in inner}
            case "AT":
                own = {""}
        if own is not None and len(own) * len(strings) <= MOST_EXACT:
            strings = {a + b for a in strings for b in own}
        else:
            clauses = _both(_both(clauses, _of_strings(strings)), needs if own is None else _of_strings(own))
            strings, exact = {""}, False
    return (strings if exact else None), _both(clauses, _of_strings(strings))


def trigram_clauses(pattern: str) -> Clauses:
    """OR of ANDs of lower-case trigrams that each match of ``pattern`` contains.

    The one clause without trigrams means that nothing is mandatory.
    """
    return _tree(re._parser.parse(pattern))[1]


def _key() -> Column:
    return F.xxhash64("doc_id", "text")


def leads(queries: list[Clauses]) -> dict[str, list[str]]:
    """For few trigrams that together occur in every clause, the other trigrams of their clauses.

    A trigram met in more clauses comes first, ties by the alphabet.
    """
    left = {c for q in queries for c in q if c}
    found: dict[str, list[str]] = {}
    while left:
        counts = Counter(t for c in left for t in c)
        lead = min(counts, key=lambda t: (-counts[t], t))
        own = {c for c in left if lead in c}
        found[lead] = sorted(set().union(*own) - {lead})
        left -= own
    return found


def postings(docs: DataFrame, trigrams: list[str], queries: list[Clauses]) -> DataFrame:
    """The inverted index for these trigrams: (trigram as its place in the list, at = text key).

    No clause holds without its lead, so a text without it gets no postings of the clause's other
    trigrams, nor is it searched for them. A trigram of several leads may be listed twice.
    Keys are hashes of row contents; equal keys of different rows would only add candidates.
    """
    place = {t: i for i, t in enumerate(trigrams)}
    has = lambda t: F.contains("low", F.lit(t))
    held = []
    for lead, others in leads(queries).items():
        own = F.array_compact(F.array(F.lit(place[lead]), *[F.when(has(t), F.lit(place[t])) for t in others]))
        held.append(F.when(has(lead), own).otherwise(F.array().cast("array<int>")))
    rows = docs.select(_key().alias("at"), F.lower("text").alias("low"))
    return rows.select("at", F.explode(F.concat(*held)).alias("trigram"))


def candidates(index: DataFrame, trigrams: list[str], queries: list[Clauses]) -> DataFrame:
    """Per selected text the rules to verify, as bits: (at, rules).

    Postings meet the clauses they occur in (a table as small as the rules), and a clause
    holds for a text once all its trigrams have arrived. Bits merge before the shuffle.
    """
    spark = index.sparkSession
    rows, place = [], {t: i for i, t in enumerate(trigrams)}
    number = 0
    for rule, clauses in enumerate(queries):
        for clause in sorted(clauses, key=sorted):
            if clause:
                whole = (1 << len(clause)) - 1
                rows += [(place[t], number, rule, 1 << k, whole) for k, t in enumerate(sorted(clause))]
                number += 1
    table = spark.createDataFrame(rows, "trigram int, clause int, rule int, bit long, whole long")
    met = index.join(F.broadcast(table), "trigram")  # as many rows as the rules have trigrams
    met = met.groupBy("at", "clause", "rule", "whole").agg(F.bit_or("bit").alias("bits")).where("bits = whole")
    return met.groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, rule)")).alias("rules"))


_SPANS = "array<struct<start:bigint,rule:int,end:bigint>>"


def _spans(rule: Rule, number: int) -> Column:
    """Matches of a rule in ``text``: positions follow from the lengths between and of the matches."""
    java = F.lit(rule.java)
    pieces = F.arrays_zip(
        F.split("text", rule.java, -1).alias("gap"), F.regexp_extract_all("text", java, F.lit(0)).alias("hit")
    )

    def step(state, piece):
        start = state["at"] + F.length(piece["gap"])
        end = start + F.coalesce(F.length(piece["hit"]), F.lit(0))
        part = piece["hit"] if not rule.part else F.regexp_extract(piece["hit"], rule.java, rule.part)
        kept = piece["hit"].isNotNull() & (F.length(part) >= rule.least)
        span = F.struct(start.alias("start"), F.lit(number).alias("rule"), end.alias("end"))
        more = F.when(kept, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), more.alias("spans"))

    def chunk(state, at):
        """A run of pieces on its own, so that what is appended to stays short."""
        empty = F.struct(state["at"].alias("at"), F.array().cast(_SPANS).alias("spans"))
        done = F.aggregate(F.slice(pieces, at + 1, CHUNK), empty, step)
        added = lambda old, new: F.struct(new["at"].alias("at"), F.concat(old["spans"], new["spans"]).alias("spans"))
        return F.aggregate(F.array(done), state, added)

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_SPANS).alias("spans"))
    return F.aggregate(F.sequence(F.lit(0), F.size(pieces) - 1, F.lit(CHUNK)), start, chunk, lambda s: s["spans"])


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(r.kind) for r in RULES])
    parts = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rule"]), s["start"], s["end"]))
    return F.array_join(parts, ",")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base rules, their digest and all spans."""
    docs = docs.select("doc_id", "text")
    queries = [trigram_clauses(r.pattern) for r in RULES]
    trigrams = sorted({t for q in queries if q != ANYTHING for c in q for t in c})
    wanted = [frozenset() if q == ANYTHING else q for q in queries]
    chosen = candidates(postings(docs, trigrams, wanted), trigrams, wanted)
    # a text without any lead has no candidate bits and is answered where it is read; only others are shuffled
    low = F.lower("text")
    leading = F.coalesce(reduce(or_, [F.contains(low, F.lit(t)) for t in leads(wanted)], F.lit(False)), F.lit(False))
    met = docs.where(leading).withColumn("at", _key()).join(chosen, "at", "left").drop("at")
    rest = docs.where(~leading).withColumn("rules", F.lit(None).cast("bigint"))
    return _answered(met.unionByName(rest), queries)


def _answered(rows: DataFrame, queries: list[Clauses]) -> DataFrame:
    """The result for rows of doc_id, text and the ``rules`` whose clauses hold."""
    found = []
    for number, (rule, query) in enumerate(zip(RULES, queries)):
        if query == ANYTHING:
            wanted = F.col("text").rlike(rule.java)
        else:
            wanted = F.col("rules").bitwiseAND(F.lit(1 << number)) != 0
        found.append(F.when(wanted, _spans(rule, number)).otherwise(F.array().cast(_SPANS)))
    rows = rows.select("doc_id", F.array_sort(F.concat(*found)).alias("found"))
    base = [n for n, r in enumerate(RULES) if r.base]

    def count(n):
        return F.size(F.filter("found", lambda s: s["rule"] == n)).cast("bigint").alias(f"n_{RULES[n].kind}")

    own = F.filter("found", lambda s: s["rule"] <= max(base))
    return rows.select(
        "doc_id", *map(count, base), F.sha2(_joined(own), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans")
    )
