"""Secret scanning with a trigram inverted index.

Every rule's regular expression is turned into a Boolean trigram query: an OR
of ANDs over the trigrams that each match must contain (letters folded to
lower case).  The index holds postings ``(trigram, doc_id)`` of all documents
for the trigrams that the rules ask about; intersecting the postings of a
query gives the rule's candidate documents, and only those are scanned with
its expression.  A rule without mandatory trigrams is run over every text.

Everything on the path is a built-in column function.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as sre  # parse tree of the standard library's expressions
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamestats.llm.common import join_keys, materialize


@dataclass(frozen=True)
class Rule:
    """``pattern`` is read by Java, RE2 and Python alike.  A match counts if
    its group ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


def either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join([either_case("password"), either_case("passwd"), either_case("secret"),
                   either_case("token"), either_case("api") + "_?" + either_case("key")])

# The three base kinds, in the order of their listing.
BASE_RULES = (
    Rule("assign", f"({_NAMES})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
# Further kinds.
MORE_RULES = (
    Rule("code_host", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES

# --- trigram queries --------------------------------------------------------
# A query is a set of conjunctions; a conjunction is a set of trigrams.  ANY
# (one empty conjunction) is true for every text.
Query = frozenset[frozenset[str]]
ANY: Query = frozenset([frozenset()])
MAX_STRINGS = 64    # longer lists of exact strings are cut into trigrams
MAX_CLASS = 4       # larger character classes are not enumerated


def _absorb(q: Query) -> Query:
    return frozenset(c for c in q if not any(d < c for d in q))


def _and(a: Query, b: Query) -> Query:
    both = _absorb(frozenset(x | y for x in a for y in b))
    return both if len(both) <= MAX_STRINGS else a


def _or(queries: list[Query]) -> Query:
    return _absorb(frozenset().union(*queries))


def _of_strings(strings: set[str]) -> Query:
    return _or([frozenset([frozenset(s[i:i + 3] for i in range(len(s) - 2))]) for s in strings])


def _exact(item) -> set[str] | None:
    """All strings (folded) that a part can match, if they are few."""
    op, arg = item
    if op is sre.LITERAL:
        return {chr(arg).lower()}
    if op is sre.IN:
        chars = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                chars.add(chr(value).lower())
            elif kind is sre.RANGE and value[1] - value[0] < MAX_CLASS:
                chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return chars if len(chars) <= MAX_CLASS else None
    if op is sre.SUBPATTERN:
        return _exact_all(arg[-1])
    if op is sre.BRANCH:
        parts = [_exact_all(b) for b in arg[1]]
        return None if None in parts else set().union(*parts)
    if op is sre.MAX_REPEAT:
        low, high, body = arg
        if high is sre.MAXREPEAT or high > 3:
            if low is sre.MAXREPEAT or low != high or low > 16:
                return None
        one, out, grown = _exact_all(body), set(), {""}
        if one is None:
            return None
        for n in range(int(high) + 1):
            if n >= low:
                out |= grown
            grown = {a + b for a in grown for b in one}
            if len(grown) > MAX_STRINGS:
                return None
        return out
    return {""} if op is sre.AT else None


def _exact_all(items) -> set[str] | None:
    out = {""}
    for item in items:
        one = _exact(item)
        if one is None or len(out) * len(one) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in one}
    return out


def _inner(item) -> Query:
    """Trigrams that a part without a short list of strings must contain."""
    op, arg = item
    if op is sre.SUBPATTERN:
        return _sequence(arg[-1])
    if op is sre.BRANCH:
        return _or([_sequence(b) for b in arg[1]])
    if op is sre.MAX_REPEAT and arg[0] >= 1:
        return _sequence(arg[2])
    return ANY


def _sequence(items) -> Query:
    query, run = ANY, {""}
    for item in items:
        one = _exact(item)
        if one is not None and len(run) * len(one) <= MAX_STRINGS:
            run = {a + b for a in run for b in one}
            continue
        query = _and(query, _of_strings(run))
        if one is not None:
            run = one
        else:
            query, run = _and(query, _inner(item)), {""}
    return _and(query, _of_strings(run))


def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query of an expression, over folded text."""
    return _sequence(_parser.parse(pattern))


# --- index and candidates ---------------------------------------------------

def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index: ``(trigram, doc_id)`` for the given trigrams."""
    low = F.lower("text")
    has = [F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in trigrams]
    return docs.select("doc_id", F.explode(F.array_compact(F.array(*has))).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame | None:
    """``(doc_id, rules)``: a bit per rule whose query the document's postings
    satisfy.  None if no rule has mandatory trigrams."""
    asked = []
    for bit, rule in enumerate(rules):
        query = trigram_query(rule.pattern)
        if query != ANY:
            for c, conjunction in enumerate(sorted(query, key=sorted)):
                asked += [(t, bit, c, 1 << i, (1 << len(conjunction)) - 1)
                          for i, t in enumerate(sorted(conjunction))]
    if not asked:
        return None
    spark = docs.sparkSession
    index = materialize(postings(docs, sorted({a[0] for a in asked})), "trigrams")
    table = spark.createDataFrame(
        asked, "trigram string, rule int, conjunction int, bit long, full long")
    met = (index.join(F.broadcast(table), "trigram")  # a row per trigram of the rules
           .groupBy("doc_id", "rule", "conjunction", "full")
           .agg(F.bit_or("bit").alias("bits"))
           .where(F.col("bits") == F.col("full")))
    return materialize(
        met.groupBy("doc_id").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("rule")))
                                  .alias("rules")), "secret-candidates")


# --- verification -----------------------------------------------------------

SPAN = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """Spans of the leftmost non-overlapping matches: the lengths of the pieces
    between the matches and of the matches give their places."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = found if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    rows = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("gap"), found.alias("hit"),
                        judged.alias("judged"))

    def step(state: Column, row: Column) -> Column:
        start = state["at"] + F.length(row["gap"])
        end = start + F.length(row["hit"])
        span = F.array(F.struct(start.alias("start"), F.lit(number).alias("kind"),
                                end.alias("end")))
        return F.struct(end.alias("at"), F.when(
            F.length(row["judged"]) >= rule.least, F.concat(state["spans"], span))
            .otherwise(state["spans"]).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))
    return F.aggregate(rows, start, step, lambda s: s["spans"])


def _joined(spans: Column, rules: tuple[Rule, ...]) -> Column:
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` (``doc_id`` and ``text``; other columns are ignored) as
    ``(doc_id, text, found)``, where ``found`` lists the spans of all rules,
    by start, then rule: ``start`` and ``end`` (exclusive) in code points, and
    the rule's number as ``kind``.

    A null text counts as empty.  Rows that repeat a ``doc_id`` are scanned
    each on its own; a row with a null ``doc_id`` is scanned with every rule.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    chosen = candidates(docs.where(F.col("doc_id").isNotNull()), rules)
    if chosen is None:
        marked = docs.withColumn("rules", F.lit(0).cast("long"))
    else:
        marked = join_keys(docs, chosen, ["doc_id"], "left")
    found = []
    for number, rule in enumerate(rules):
        asked = (F.lit(True) if trigram_query(rule.pattern) == ANY else
                 F.col("doc_id").isNull()
                 | (F.col("rules").bitwiseAND(F.lit(1 << number)) != 0))
        found.append(F.when(asked & F.col("text").rlike(rule.pattern),
                            _spans(F.col("text"), rule, number))
                     .otherwise(F.array().cast(SPAN)))
    return marked.select("doc_id", "text", F.array_sort(F.concat(*found)).alias("found"))


def secret_digest(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the counts of the base kinds, the
    SHA-256 of the base spans and the text of all spans.  An empty table gives
    an empty result."""
    n_base = len(BASE_RULES)
    base = F.filter("found", lambda s: s["kind"] < n_base)

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE_RULES)]
    return find_secrets(docs, rules).select(
        "doc_id", *counts, F.sha2(_joined(base, rules), 256).alias("base_sha256"),
        _joined(F.col("found"), rules).alias("spans"))


def python_spans(text: str | None, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, int]]:
    """The same spans of one text from Python's engine, for tests."""
    return sorted((m.start(), k, m.end()) for k, r in enumerate(rules)
                  for m in re.finditer(r.pattern, text or "") if len(m[r.group]) >= r.least)
