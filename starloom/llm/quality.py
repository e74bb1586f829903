"""Quality rules: base counts, and how far a document is from its language.

A document's character classes and common words are counted into two histograms. The
reference of a language is the mean of the normalised histograms of its documents, over
the whole table and without the far ones; the verdict compares a document with the
reference of its own language by Jensen-Shannon distance (base 2, from 0 to 1). Short
documents have ragged histograms, so each comparison has a least length below which it
says nothing. All of it is built-in functions; one aggregate of as many rows as there are
reference languages is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import let, table, text_or_empty, text_session, words_of
from starloom.workspace import Workspace

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# A document is rejected if its characters alone are far from its language, or its words
# are and its characters are not near (a clean text may quote another language). A
# histogram of n words strays by chance alone, by some part of 1/sqrt(n). Below the least
# numbers of characters and words a distance is not taken.
MAX_CHARACTER_DISTANCE = 0.30
NEAR_CHARACTER_DISTANCE = 0.12
MAX_WORD_DISTANCE = 0.24
WORD_CHANCE = 0.3
LEAST_CHARACTERS = 300
LEAST_WORDS = 80
# share and number of the long documents that make a language a reference without common words
LEAST_SHARE = 0.001
LEAST_DOCUMENTS = 20

# The most common words of the reference languages
COMMON_WORDS = {
    "en": "the of and to in a is that it for was on with as by",
    "de": "der die und in den von zu das mit sich des auf für ist im",
    "fr": "de la le et les des en un du une que est pour qui dans",
    "es": "de la que el en y a los se del las un por con no",
}
BINS = sorted({word for words in COMMON_WORDS.values() for word in words.split()})

# The character classes beside letters
CLASSES = {
    "digit": r"[0-9]+",
    "symbol": r"[#*$%&|<>]+",
    "upper": r"\p{Lu}+",
    "mark": r"""[.,;:!?'"()\[\]{}\x2D/\\_@+=~^`]+""",
}

HISTOGRAM_COLUMNS = ("language", "n_words", "word_chars", "char_shares", "word_shares")


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _windows(words: Column) -> Column:
    """Hashes of the windows of five words, in order."""

    def of(hashes: Column) -> Column:
        def window(at: Column) -> Column:
            return F.xxhash64(*[F.get(hashes, at + k) for k in range(WINDOW)])

        return F.transform(F.sequence(F.lit(0), F.size(hashes) - WINDOW), window)

    hashed = let(F.transform(words, lambda word: F.xxhash64(word)), of)
    return F.when(F.size(words) >= WINDOW, hashed).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: Column) -> Column:
    """Words in the windows whose hash occurs twice or more, each word once."""

    def repeated(placed: Column) -> Column:
        def twice(entry: Column, at: Column) -> Column:
            before, after = F.get(placed, at - 1), F.get(placed, at + 1)
            return F.coalesce(before["h"] == entry["h"], F.lit(False)) | F.coalesce(
                after["h"] == entry["h"], F.lit(False)
            )

        return F.transform(F.filter(placed, twice), lambda entry: entry["i"])

    placed = F.sort_array(
        F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.cast("int").alias("i")))
    )
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("total"))
    return F.aggregate(
        F.sort_array(let(placed, repeated)),
        start,
        lambda acc, i: F.struct(
            i.alias("last"),
            (acc["total"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("total"),
        ),
        lambda acc: acc["total"],
    )


def _histogram_columns(rows: DataFrame) -> DataFrame:
    """Shares of the character classes and of the common words; null without characters."""
    others = [F.col(f"n_{name}") for name in CLASSES]
    letters = F.col("word_chars") - sum(others[1:], others[0])
    counts = F.array(*others, letters)
    common = F.filter("words", lambda word: word.isin(BINS))
    rows = rows.withColumn("common", common)
    size = F.size("common")
    per_word = [size - F.size(F.array_remove("common", word)) for word in BINS]
    per_word.append(F.col("n_words") - size)

    def shares(counts: Column, total: Column) -> Column:
        return F.when(total > 0, F.transform(counts, lambda n: n / total))

    return rows.withColumns(
        {
            "char_shares": shares(counts, F.col("word_chars")),
            "word_shares": shares(F.array(*per_word), F.col("n_words")),
        }
    ).drop("common")


def _base(docs: DataFrame, text_col: str, lang_col: str | None) -> DataFrame:
    """The base counts and the histograms beside the columns of `docs`."""
    language = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        text_or_empty(text_col).alias("text"),
        language.alias("language"),
    ).withColumn("words", words_of(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    rows = rows.select(
        "row",
        "language",
        "words",
        _windows(F.col("words")).alias("windows"),
        lines.alias("lines"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        *[_count(F.col("text"), p).cast("long").alias(f"n_{n}") for n, p in CLASSES.items()],
    )
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.select(
        "row",
        "language",
        "words",
        "n_words",
        "word_chars",
        *[f"n_{name}" for name in CLASSES],
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(repeats, _covered(F.col("windows")))
        .otherwise(F.lit(0).cast("long"))
        .alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return _histogram_columns(rows.withColumn("base_failed", failed)).select(
        "row",
        "language",
        "n_words",
        "word_chars",
        F.col("n_symbol").alias("n_symbols"),
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "char_shares",
        "word_shares",
    )


def _distance(shares: str, reference: str | Column) -> Column:
    """Jensen-Shannon distance of two distributions, null without one of them."""

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    parts = F.zip_with(shares, reference, lambda p, q: (part(p, q) + part(q, p)) / 2)
    total = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)
    # rounding may leave a little below zero; greatest() alone would make a number of a null
    return F.when(total.isNotNull(), F.sqrt(F.greatest(total, F.lit(0.0))))


def _language(name: str) -> Column:
    """`EN`, `en-GB` and ` en` are one language."""
    return F.lower(F.trim(F.split(F.col(name), "[-_]")[0]))


def language_references(histograms: DataFrame, every: bool = False) -> DataFrame:
    """Mean shares per reference language, one row each, from the stored histograms.

    Reference languages are those with common words here; with `every`, also all others
    that have `LEAST_DOCUMENTS` and a share of `LEAST_SHARE` of the documents long enough, so
    there are never more than `1 / LEAST_SHARE`.

    Documents that are long enough to be compared take part. As some of them may be junk,
    the mean is taken twice: the second time over those that are not farther from the
    first than the language's documents are on average.
    """

    def means(name: str, size: int) -> Column:
        return F.array(*[F.avg(F.get(name, F.lit(k))) for k in range(size)])

    def references(rows: DataFrame) -> DataFrame:
        return rows.groupBy("language").agg(
            means("char_shares", len(CLASSES) + 1).alias("char_reference"),
            means("word_shares", len(BINS) + 1).alias("word_reference"),
        )

    rows = histograms.filter(
        (F.col("n_words") >= LEAST_WORDS) & (F.col("word_chars") >= LEAST_CHARACTERS)
    )
    known = F.col("language").isin(list(COMMON_WORDS))
    if every:
        sizes = rows.groupBy("language").agg(F.count("*").alias("size"))
        share = LEAST_SHARE * sizes.agg(F.sum("size")).scalar()
        enough = F.col("size") >= F.greatest(share, F.lit(LEAST_DOCUMENTS))
        rows = rows.join(F.broadcast(sizes.filter(known | enough)), "language", "left_semi")
    else:
        rows = rows.filter(known)
    compared = rows.join(F.broadcast(references(rows)), "language").select(
        *rows.columns,
        (
            _distance("char_shares", "char_reference") + _distance("word_shares", "word_reference")
        ).alias("distance"),
    )
    usual = compared.groupBy("language").agg(F.avg("distance").alias("usual"))
    # a little room, as all documents may be equally far
    near = F.col("distance") <= F.col("usual") * (1 + 1e-9)
    return references(compared.join(F.broadcast(usual), "language").filter(near))


def _listed(references: DataFrame) -> Column:
    """The references with common words, at most as many as there are such languages."""
    named = references.filter(F.col("language").isin(list(COMMON_WORDS)))
    return named.agg(F.collect_list(F.struct("char_reference", "word_reference"))).scalar()


def _nearest(listed: str) -> Column:
    """The listed reference that a document is nearest to."""

    def placed(reference: Column) -> Column:
        chars, words = reference["char_reference"], reference["word_reference"]
        far = _distance("char_shares", chars) + _distance("word_shares", words)
        return F.struct(far.alias("far"), chars.alias("char"), words.alias("word"))

    return F.array_min(F.transform(listed, placed))


def _judged(measured: DataFrame, references: DataFrame, nearest: bool) -> DataFrame:
    compared = measured.join(F.broadcast(references), "language", "left")
    if nearest:
        own = F.col("char_reference").isNotNull()
        compared = compared.withColumn("listed", _listed(references))
        compared = compared.withColumn("near", F.when(~own, _nearest("listed"))).withColumns(
            {
                f"{kind}_reference": F.coalesce(f"{kind}_reference", f"near.{kind}")
                for kind in ("char", "word")
            }
        )
    compared = compared.withColumns(
        {
            "char_distance": F.when(
                F.col("word_chars") >= LEAST_CHARACTERS, _distance("char_shares", "char_reference")
            ),
            "word_distance": F.when(
                F.col("n_words") >= LEAST_WORDS, _distance("word_shares", "word_reference")
            ),
        }
    )
    chance = F.try_divide(F.lit(WORD_CHANCE), F.sqrt("n_words"))
    far = (F.col("char_distance") > MAX_CHARACTER_DISTANCE) | (
        (F.col("word_distance") > MAX_WORD_DISTANCE + chance)
        & (F.col("char_distance") > NEAR_CHARACTER_DISTANCE)
    )
    # without a reference or below the least length there is no distance, so no objection
    return compared.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False)))


def _measured_and_judged(measured: DataFrame, nearest: bool, workspace: Workspace) -> DataFrame:
    """The verdicts on the stored counts: nothing of a text is counted twice."""
    if nearest:
        measured = measured.withColumn("language", _language("language"))
    references = language_references(measured.select(*HISTOGRAM_COLUMNS), every=nearest)
    return _judged(measured, workspace.save(references, "references"), nearest)


def quality_measures(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
    workspace: Workspace | None = None,
    nearest: bool = False,
) -> DataFrame:
    """One row per document: the base counts, the two distances and the verdict `kept`.

    A null text has no words and fails the base rules, as an empty one does. A null
    language, or one without a reference, leaves only the base rules and null distances. With
    `nearest`, languages are compared without case and region, every language with enough
    documents has a reference, and a document without one is compared with the nearest of
    those with common words. Repeated rows are judged alike. An empty table gives an empty
    result; other columns are not read. The counts are written once, without the texts, and
    both the references and the verdicts are computed from there.
    """
    workspace = workspace or Workspace(text_session(docs.sparkSession))
    columns = [F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")]
    columns += [F.col(lang_col).alias("lang")] if lang_col else []
    measured = _base(docs.select(*columns), "text", "lang" if lang_col else None)
    measured = measured.withColumn("doc_id", F.col("row.doc_id")).drop("row")
    measured = workspace.save(measured, "quality")
    return _measured_and_judged(measured, nearest, workspace).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "char_distance",
        "word_distance",
    )


def drop_low_quality(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str | None = "lang",
    workspace: Workspace | None = None,
    nearest: bool = False,
) -> DataFrame:
    """The rows of `docs`, with all their columns, that `quality_measures` keeps.

    The rows are written once beside their counts; the verdicts are taken from there, so a
    text is counted once and never shuffled.
    """
    workspace = workspace or Workspace(text_session(docs.sparkSession))
    measured = workspace.save(_base(docs, text_col, lang_col), "measured")
    judged = _measured_and_judged(measured, nearest, workspace).filter("kept")
    return judged.select(*[F.col("row").getField(name).alias(name) for name in docs.columns])


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_measures(table(spark, folder, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def _oracle() -> str:
    def listed(values: list[str]) -> str:
        return "[" + ", ".join(values) + "]"

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    others = [f"n_{name}" for name in CLASSES]
    removed = ", ".join(
        f"length(body) - length(regexp_replace(body, {quoted(p)}, '', 'g')) AS n_{n}"
        for n, p in CLASSES.items()
    )
    char_bins = [f"{n} / word_chars" for n in others]
    char_bins.append(f"(word_chars - {' - '.join(others)}) / word_chars")
    common = listed([quoted(word) for word in BINS])
    word_bins = [f"len(list_filter(common, lambda w: w = {quoted(b)})) / n_words" for b in BINS]
    word_bins.append("(n_words - len(common)) / n_words")

    def means(name: str, size: int) -> str:
        return listed([f"avg({name}[{k + 1}])" for k in range(size)])

    references = f"""SELECT language, {means('char_shares', len(CLASSES) + 1)} AS char_reference,
        {means('word_shares', len(BINS) + 1)} AS word_reference"""

    def distance(p: str, q: str) -> str:
        def part(a: int, b: int) -> str:
            return f"CASE WHEN x[{a}] > 0 THEN x[{a}] * log2(2 * x[{a}] / (x[{a}] + x[{b}])) ELSE 0 END"

        return f"""sqrt(greatest(0.0, list_sum(list_transform(list_zip({p}, {q}),
            lambda x: ({part(1, 2)} + {part(2, 1)}) / 2))))"""

    return f"""
WITH bodies AS (
    SELECT row_number() OVER () AS place, doc_id, lang AS language, coalesce(text, '') AS body
    FROM documents
), counted AS (
    SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words, {removed},
        list_filter(string_split(body, chr(10)),
            lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM bodies
), windows AS (
    SELECT place, pos, count(*) OVER (PARTITION BY place, win) AS times
    FROM (
        SELECT place, pos, array_to_string(words[pos:pos + 4], ' ') AS win
        FROM (SELECT place, words, unnest(range(1, len(words) - 3)) AS pos FROM counted)
    )
), covered AS (
    SELECT place, sum(least(5, coalesce(pos - before, 5))) AS n_covered
    FROM (
        SELECT place, pos, lag(pos) OVER (PARTITION BY place ORDER BY pos) AS before
        FROM windows WHERE times > 1
    )
    GROUP BY place
), base AS (
    SELECT place, doc_id, language, n_words, word_chars, n_symbol AS n_symbols, n_dup_lines,
        n_repeat_words, n_words < {MIN_WORDS}
            OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
        CASE WHEN n_words > 0 THEN {listed(char_bins)} END AS char_shares,
        CASE WHEN n_words > 0 THEN {listed(word_bins)} END AS word_shares
    FROM (
        SELECT *, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
            len(lines) - len(list_distinct(lines)) AS n_dup_lines,
            coalesce(n_covered, 0)::BIGINT AS n_repeat_words,
            list_filter(words, lambda w: list_contains({common}, w)) AS common
        FROM (SELECT c.*, v.n_covered FROM counted c LEFT JOIN covered v USING (place))
    )
), long AS (
    SELECT * FROM base
    WHERE n_words >= {LEAST_WORDS} AND word_chars >= {LEAST_CHARACTERS}
        AND language IN ({', '.join(map(quoted, COMMON_WORDS))})
), first AS ({references} FROM long GROUP BY language
), compared AS (
    SELECT long.*, {distance('char_shares', 'char_reference')}
        + {distance('word_shares', 'word_reference')} AS distance
    FROM long JOIN first USING (language)
), second AS (
    {references}
    FROM (SELECT *, avg(distance) OVER (PARTITION BY language) AS usual FROM compared)
    WHERE distance <= usual * (1 + 1e-9) GROUP BY language
), judged AS (
    SELECT base.*,
        CASE WHEN word_chars >= {LEAST_CHARACTERS}
            THEN {distance('char_shares', 'char_reference')} END AS char_distance,
        CASE WHEN n_words >= {LEAST_WORDS}
            THEN {distance('word_shares', 'word_reference')} END AS word_distance
    FROM base LEFT JOIN second USING (language)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT coalesce(char_distance > {MAX_CHARACTER_DISTANCE} OR
        (word_distance > {MAX_WORD_DISTANCE} + {WORD_CHANCE} / sqrt(n_words)
            AND char_distance > {NEAR_CHARACTER_DISTANCE}), false) AS kept
FROM judged
"""


ORACLE = _oracle()
