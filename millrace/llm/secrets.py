"""Secrets in texts: a trigram index narrows the documents, a regex verifies them.

From each rule's regex follows a Boolean query over trigrams of the lower-cased
text: every stretch of literal characters gives alternatives, each a set of
trigrams that must all occur. The index holds a posting (trigram, document) for
the trigrams that some rule asks for; a rule's candidates are the documents in
which its query holds. A rule without a mandatory trigram scans every document.

Spans are code points, end exclusive, leftmost and non-overlapping per rule. A rule
may ask for a least length of one group; a match below it is dropped and its text
stays consumed. NULL counts as empty text. Rows that repeat an id share its
candidates and are each scanned; an empty table gives an empty result.
"""

from __future__ import annotations

import re._constants as ops
import re._parser as regex
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.tables import settle


@dataclass(frozen=True)
class SecretRule:
    """`group` must have `least` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


BASE_RULES = (
    SecretRule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               2, 6),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 20),
    SecretRule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    SecretRule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    SecretRule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    SecretRule("cloud_key", r"AIza[0-9A-Za-z_-]{35}"),
    SecretRule("payment_key", r"sk_live_[0-9A-Za-z]{24,}"),
    SecretRule("url_password", r"[a-z]{2,12}://[^/\s:@]{1,64}:[^/\s:@]{1,64}@"),
)
ALTERNATIVES = 32  # literal stretches with more spellings than this are not asked for
MASK_BITS = 60

Query = list[list[frozenset[str]]]  # all of: any of: these trigrams


def trigram_query(pattern: str) -> Query:
    """What the lower-cased text of every match must contain; empty: nothing is known."""
    query: Query = []

    def close(stretch: set[str]) -> set[str]:
        """End a literal stretch: its spellings become one condition."""
        sets = [frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in stretch]
        if all(sets):
            query.append(sorted(set(sets), key=sorted))
        return {""}

    def spellings(node) -> set[str] | None:
        """All strings that a parse node matches, if they are few."""
        op, arg = node
        if op is ops.LITERAL:
            return {chr(arg).lower()}
        if op is ops.IN and len(arg) <= 4 and all(o is ops.LITERAL for o, _ in arg):
            return {chr(c).lower() for _, c in arg}
        if op is ops.SUBPATTERN:
            return sequence(arg[-1])
        if op is ops.BRANCH:
            parts = [sequence(p) for p in arg[1]]
            return None if None in parts else set().union(*parts)
        if op is ops.MAX_REPEAT and arg[1] == 1:
            inner = sequence(arg[2])
            return None if inner is None else inner | ({""} if arg[0] == 0 else set())
        return None

    def sequence(nodes) -> set[str] | None:
        found = {""}
        for node in nodes:
            one = spellings(node)
            if one is None or len(one) * len(found) > ALTERNATIVES:
                return None
            found = {a + b for a in found for b in one}
        return found

    def walk(nodes, stretch: set[str]) -> set[str]:
        for node in nodes:
            one = spellings(node)
            if one is not None and len(one) * len(stretch) <= ALTERNATIVES:
                stretch = {a + b for a in stretch for b in one}
            elif node[0] is ops.SUBPATTERN:
                stretch = walk(node[1][-1], stretch)
            else:
                stretch = close(stretch)
        return stretch

    close(walk(regex.parse(pattern), {""}))
    return query


def _postings(docs: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """(trigram number, id): each document once for each asked-for trigram in it."""
    lowered = docs.select("_id", F.lower("_text").alias("_low"))
    present = F.array_compact(F.array(*[
        F.when(F.contains("_low", F.lit(t)), F.lit(n)) for n, t in enumerate(trigrams)]))
    return settle(lowered.select(F.explode(present).alias("_tri"), "_id"), "trigrams")


def _candidates(postings: DataFrame, trigrams: Sequence[str], queries: dict[str, Query]) -> DataFrame:
    """Ids in which some rule's query holds, with one flag per rule; postings intersect as bits of a mask."""
    numbers = {t: n for n, t in enumerate(trigrams)}
    words = range(len(trigrams) // MASK_BITS + 1)
    bit = F.expr(f"shiftleft(1L, _tri % {MASK_BITS})")
    masks = postings.groupBy("_id").agg(*[
        F.coalesce(F.bit_or(F.when(F.floor(F.col("_tri") / MASK_BITS) == w, bit)), F.lit(0)).alias(f"_m{w}") for w in words])

    def has(wanted: frozenset[str]) -> Column:
        need = [0] * len(words)
        for t in wanted:
            need[numbers[t] // MASK_BITS] |= 1 << numbers[t] % MASK_BITS
        return reduce(and_, [F.col(f"_m{w}").bitwiseAND(F.lit(m)) == m for w, m in enumerate(need) if m])

    flags = [reduce(and_, [reduce(or_, [has(s) for s in anyof]) for anyof in q]).alias(f"_c_{kind}")
             for kind, q in queries.items()]
    found = masks.select(F.col("_id").alias("_cid"), *flags)
    return settle(found.filter(reduce(or_, [F.col(f"_c_{kind}") for kind in queries])), "candidates")


def _let(value: Column, use) -> Column:
    """`use` of a value that is computed once, however often it is asked for."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _spans(text: Column, rule: SecretRule, number: int) -> Column:
    """The rule's spans in a text: the pieces between matches and the matches add up to positions.

    Sums run in blocks of about the root of the number of matches: first those of whole blocks, then within each.
    """
    pattern = F.lit(rule.pattern)
    zipped = F.arrays_zip(F.split(text, rule.pattern, -1).alias("piece"),
                          F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
                          F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("judged"))
    matched = F.filter(zipped, lambda z: z["hit"].isNotNull())  # there is one piece more
    steps = F.transform(matched, lambda z: F.struct(
        F.length(z["piece"]).alias("gap"), F.length(z["hit"]).alias("size"),
        (F.length(z["judged"]) >= rule.least).alias("good")))
    kind = "array<struct<start:int,number:int,end:int>>"

    def step(state: Column, s: Column) -> Column:
        start = state["at"] + s["gap"]
        end = start + s["size"]
        span = F.array(F.struct(start.alias("start"), F.lit(number).alias("number"), end.alias("end")))
        return F.struct(end.alias("at"),
                        F.when(s["good"], F.concat(state["found"], span)).otherwise(state["found"]).alias("found"))

    def cut(s: Column) -> Column:
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(s))).cast("int"))
        return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(s) - 1) / width).cast("int"))),
                           lambda k: F.slice(s, k * width + 1, width))

    def begins(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda at, s: at + s["gap"] + s["size"]))
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("begins"))
        return F.aggregate(sums, first, lambda state, x: F.struct(
            (state["at"] + x).alias("at"), F.concat(state["begins"], F.array(state["at"])).alias("begins")))["begins"]

    def placed(blocks: Column) -> Column:
        return F.flatten(F.transform(F.arrays_zip(blocks.alias("steps"), begins(blocks).alias("at")), lambda b: F.aggregate(
            b["steps"], F.struct(b["at"].alias("at"), F.array().cast(kind).alias("found")), step)["found"]))

    return _let(_let(steps, cut), placed)


def scan(docs: DataFrame, rules: Sequence[SecretRule] = BASE_RULES + MORE_RULES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: (id, spans), spans sorted by start, then by the rules' order.

    A span is a struct (start, number, end) with the rule's number in `rules`.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    trigrams = sorted({t for q in queries.values() for anyof in q for s in anyof for t in s})
    if queries:
        flagged = _candidates(_postings(rows, trigrams), trigrams, queries)
        rows = rows.join(flagged, rows["_id"].eqNullSafe(flagged["_cid"]), "left")
    none = F.array().cast("array<struct<start:int,number:int,end:int>>")

    def found(n: int, rule: SecretRule) -> Column:
        here = F.col("_text").rlike(rule.pattern)
        if rule.kind in queries:
            here = F.coalesce(F.col(f"_c_{rule.kind}"), F.lit(False)) & here
        return F.when(here, _spans(F.col("_text"), rule, n)).otherwise(none)

    every = F.concat(*[found(n, r) for n, r in enumerate(rules)])
    return rows.select(F.col("_id").alias(id_col), F.array_sort(every).alias("spans"))
