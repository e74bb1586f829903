"""Secret scans by a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams that every
match must contain (in lower case). The index holds a posting (trigram, document) for
every trigram that some query names; intersecting and uniting postings per document gives
the candidates of each rule, and only candidates are searched with the expression itself.
Rules without a mandatory trigram, such as runs of hex digits, search every text.

All work on rows is built-in functions; only the few rules are analysed in Python, on the
driver. Candidates are joined to the texts by broadcast if they are measured to be small,
else by shuffle; texts are searched once, for all rules.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import BROADCAST_BYTES, let, table, text_or_empty
from starloom.operators.lookup import look_up
from starloom.workspace import Workspace


@dataclass(frozen=True)
class Rule:
    """A kind of secret; matches whose `group` is shorter than `least` are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The three base kinds. A run of at least n characters is the same as a run
# of any length that is dropped if shorter, and spares the short ones.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)

# Published forms of credentials
RULES = (
    *BASE_RULES,
    Rule("git", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

# strings that one expression may begin to spell before a query gives up telling them apart
_MOST_STRINGS = 64
_MOST_CHARACTERS = 6

# a query is a set of alternatives, each a set of trigrams that must all occur
Query = frozenset[frozenset[str]]
ANYTHING: Query = frozenset([frozenset()])


def _both(a: Query, b: Query) -> Query:
    return _least(frozenset(x | y for x in a for y in b))


def _least(query: Query) -> Query:
    """Without the alternatives that another one makes superfluous."""
    return frozenset(x for x in query if not any(y < x for y in query))


def _of_strings(strings: set[str]) -> Query:
    return _least(
        frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)
    )


def _spelled(item) -> set[str] | None:
    """All strings an element can match, if they are few."""
    from re import _constants as c

    op, value = item
    if op is c.LITERAL:
        return {chr(value).lower()}
    if op is c.IN:
        if any(kind is not c.LITERAL for kind, _ in value) or len(value) > _MOST_CHARACTERS:
            return None
        return {chr(code).lower() for _, code in value}
    if op is c.SUBPATTERN:
        return _spelled_sequence(value[-1])
    if op is c.BRANCH:
        parts = [_spelled_sequence(branch) for branch in value[1]]
        return None if None in parts else set().union(*parts)
    if op is c.MAX_REPEAT and tuple(value[:2]) == (0, 1):
        once = _spelled_sequence(value[2])
        return None if once is None else once | {""}
    return None


def _spelled_sequence(items) -> set[str] | None:
    strings = {""}
    for item in items:
        part = _spelled(item)
        if part is None or len(strings) * len(part) > _MOST_STRINGS:
            return None
        strings = {a + b for a in strings for b in part}
    return strings


def _query(items) -> Query:
    from re import _constants as c

    query, strings = ANYTHING, {""}
    for op, value in items:
        part = _spelled((op, value))
        if part is not None and len(strings) * len(part) <= _MOST_STRINGS:
            strings = {a + b for a in strings for b in part}
            continue
        query, strings = _both(query, _of_strings(strings)), {""}
        if part is not None:
            strings = part
        elif op is c.SUBPATTERN:
            query = _both(query, _query(value[-1]))
        elif op is c.BRANCH:
            query = _both(query, _least(frozenset().union(*map(_query, value[1]))))
        elif op is c.MAX_REPEAT and value[0] > 0:
            query = _both(query, _query(value[2]))
    return _both(query, _of_strings(strings))


def trigram_query(pattern: str) -> Query:
    """Trigrams without which no match is possible; `ANYTHING` if there are none."""
    from re import _parser

    return _query(_parser.parse(pattern, re.ASCII))


def postings(docs: DataFrame, queries: list[Query], id_col: str, text_col: str) -> DataFrame:
    """The index: trigram, doc_id. Rows without an id cannot be posted."""
    trigrams = sorted(set().union(*[part for query in queries for part in query]))
    # lower case may change other letters too, but never loses one of the query's
    text = F.lower(text_or_empty(text_col))
    rows = docs.filter(F.col(id_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    named = F.array(*[F.lit(t) for t in trigrams]).cast("array<string>")
    found = F.filter(named, lambda trigram: F.contains(F.col("text"), trigram))
    return rows.select(F.explode(found).alias("trigram"), "doc_id")


def candidates(index: DataFrame, queries: list[Query]) -> DataFrame:
    """doc_id and the bits of the rules whose query the document's postings answer."""
    per_document = index.groupBy("doc_id").agg(F.collect_set("trigram").alias("trigrams"))

    def holds(query: Query) -> Column:
        def all_of(part: frozenset[str]) -> Column:
            tests = [F.array_contains("trigrams", trigram) for trigram in sorted(part)]
            return reduce(lambda a, b: a & b, tests)

        return reduce(lambda a, b: a | b, [all_of(part) for part in sorted(query, key=sorted)])

    bits = [
        F.when(holds(query), 1 << number).otherwise(0)
        for number, query in enumerate(queries)
        if query != ANYTHING
    ]
    rules = reduce(lambda a, b: a + b, bits, F.lit(0)).cast("long")
    return per_document.select("doc_id", rules.alias("rules")).filter("rules > 0")


_SPANS = "array<struct<start:int,kind:int,end:int>>"
# matches that are placed together: adding to an array copies it
_MATCHES_AT_ONCE = 256


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """The rule's matches in order: the text between them tells where they lie.

    Runs of matches are placed from their own beginning, then moved to where the runs
    before them end, so that a text may hold any number of matches.
    """
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    steps = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(gaps) - 1),
        F.arrays_zip(matches.alias("match"), checked.alias("checked")),
        lambda gap, found: F.struct(
            F.length(gap).alias("gap"),
            F.length(found["match"]).alias("size"),
            (F.length(found["checked"]) >= rule.least).alias("passes"),
        ),
    )
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(done: Column, found: Column) -> Column:
        start = done["at"] + found["gap"]
        end = start + found["size"]
        span = F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"))
        spans = F.when(found["passes"], F.concat(done["spans"], F.array(span))).otherwise(
            done["spans"]
        )
        return F.struct(end.alias("at"), spans.alias("spans"))

    def runs(steps: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(steps) + 1, F.lit(_MATCHES_AT_ONCE))
        return F.transform(
            firsts, lambda at: F.aggregate(F.slice(steps, at, _MATCHES_AT_ONCE), begin, step)
        )

    def starts(runs: Column) -> Column:
        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        return F.aggregate(
            runs,
            none,
            lambda done, run: F.struct(
                (done["at"] + run["at"]).alias("at"),
                F.concat(done["starts"], F.array(done["at"])).alias("starts"),
            ),
            lambda done: done["starts"],
        )

    def moved(run: Column, by: Column) -> Column:
        return F.transform(
            run["spans"],
            lambda span: F.struct(
                (span["start"] + by).alias("start"),
                span["kind"].alias("kind"),
                (span["end"] + by).alias("end"),
            ),
        )

    placed = let(let(steps, runs), lambda runs: F.zip_with(runs, starts(runs), moved))
    return F.flatten(placed)


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row per document: doc_id and `spans`, an array of (start, kind, end).

    `kind` is the rule's number; places are code points, the end exclusive. Matches of a
    rule are the leftmost that do not overlap, and then too short ones are dropped. Spans
    are sorted by start, then kind.

    A null text counts as empty. A row with a null id is searched for every rule, as the
    index cannot name it; rows that share an id are candidates together. An empty table
    gives an empty result; other columns are not read.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    queries = [trigram_query(rule.pattern) for rule in rules]
    index = workspace.save(postings(docs, queries, id_col, text_col), "postings")
    named = workspace.save(candidates(index, queries), "candidates")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = look_up(rows, named, ["doc_id"], BROADCAST_BYTES)
    text, none = F.col("text"), F.array().cast(_SPANS)
    found = []
    for number, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        matches = F.rlike(text, F.lit(rule.pattern))
        if query != ANYTHING:
            bit = F.col("rules").bitwiseAND(F.lit(1 << number).cast("long")) != 0
            matches = F.coalesce(bit, F.col("doc_id").isNull()) & matches
        found.append(F.when(matches, _spans(text, rule, number)).otherwise(none))
    return rows.select("doc_id", F.sort_array(F.concat(*found)).alias("spans"))


def _listed(spans: Column, kinds: list[str]) -> Column:
    names = F.array(*[F.lit(kind) for kind in kinds])
    texts = F.transform(
        spans,
        lambda span: F.concat_ws(":", F.get(names, span["kind"]), span["start"], span["end"]),
    )
    return F.array_join(texts, ",")


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    spans = F.col("spans")
    kinds = [rule.kind for rule in RULES]
    base = F.filter(spans, lambda span: span["kind"] < len(BASE_RULES))

    def count(number: int) -> Column:
        return F.size(F.filter(spans, lambda span: span["kind"] == number)).cast("long")

    return scan_secrets(table(spark, folder, "documents")).select(
        "doc_id",
        *[count(number).alias(f"n_{rule.kind}") for number, rule in enumerate(BASE_RULES)],
        F.sha2(_listed(base, kinds), 256).alias("base_sha256"),
        _listed(spans, kinds).alias("spans"),
    )


def _oracle() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def found(number: int, rule: Rule) -> str:
        pattern = quoted(rule.pattern)
        return f"""
    SELECT place, {number} AS kind, unnest(list_filter(list_transform(range(1, len(found) + 1),
        lambda i: {{'start': (list_sum(list_transform(gaps[1:i], lambda g: length(g)))
                + coalesce(list_sum(list_transform(found[1:i - 1], lambda g: length(g))), 0))::BIGINT,
            'size': length(found[i]), 'checked': length(checked[i])}}),
        lambda m: m.checked >= {rule.least})) AS span
    FROM (
        SELECT place, string_split_regex(body, {pattern}) AS gaps,
            regexp_extract_all(body, {pattern}, 0) AS found,
            regexp_extract_all(body, {pattern}, {rule.group}) AS checked
        FROM bodies WHERE regexp_matches(body, {pattern})
    )"""

    kinds = "[" + ", ".join(quoted(rule.kind) for rule in RULES) + "]"
    matches = " UNION ALL ".join(found(number, rule) for number, rule in enumerate(RULES))
    counts = ", ".join(
        f"count(*) FILTER (kind = {number}) AS n_{rule.kind}" for number, rule in enumerate(BASE_RULES)
    )
    text = f"{kinds}[kind + 1] || ':' || span.start || ':' || (span.start + span.size)"
    order = "',' ORDER BY span.start, kind"
    return f"""
WITH bodies AS (
    SELECT row_number() OVER () AS place, doc_id, coalesce(text, '') AS body FROM documents
), matches AS ({matches}
), listed AS (
    SELECT place, {counts}, string_agg({text}, {order}) AS spans,
        string_agg({text}, {order}) FILTER (kind < {len(BASE_RULES)}) AS base
    FROM matches GROUP BY place
)
SELECT doc_id, {', '.join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)},
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM bodies LEFT JOIN listed USING (place)
"""


ORACLE = _oracle()
