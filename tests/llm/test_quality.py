import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from starloom.llm import quality
from starloom.llm.common import table
from starloom.llm.quality import drop_low_quality, quality_measures

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def brute_shares(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    chars = "".join(words)
    if not words:
        return None, None
    patterns = [r"[0-9]", r"[#*$%&|<>]", None, r"""[.,;:!?'"()\[\]{}\-/\\_@+=~^`]"""]
    counts = [
        sum(c.isupper() for c in chars) if p is None else len(re.findall(p, chars)) for p in patterns
    ]
    counts.append(len(chars) - sum(counts))
    common = Counter(w for w in words if w in quality.BINS)
    bins = [common[w] for w in quality.BINS]
    bins.append(len(words) - sum(bins))
    return np.array(counts) / len(chars), np.array(bins) / len(words)


def distance(p, q):
    def part(a, b):
        a, b = a[a > 0], b[a > 0]
        return np.sum(a * np.log2(2 * a / (a + b)))

    return math.sqrt(max(0.0, (part(p, q) + part(q, p)) / 2))


@pytest.mark.parametrize("folder", [SMALL, MEDIUM])
def test_query_equals_brute_force(spark, folder):
    docs = table(spark, folder, "documents").collect()
    counts = {r.doc_id: brute_counts(r.text) for r in docs}
    shares = {r.doc_id: brute_shares(r.text) for r in docs}

    def enough(i):
        return counts[i][0] >= quality.LEAST_WORDS and counts[i][1] >= quality.LEAST_CHARACTERS

    def mean(some):
        return [np.mean([s[k] for s in some], axis=0) for k in (0, 1)]

    means = {}
    for lang in quality.COMMON_WORDS:
        some = [shares[r.doc_id] for r in docs if r.lang == lang and enough(r.doc_id)]
        if some:
            far = [sum(distance(s, m) for s, m in zip(x, mean(some), strict=True)) for x in some]
            means[lang] = mean([x for x, d in zip(some, far, strict=True) if d <= np.mean(far) * (1 + 1e-9)])
    rows = {r.doc_id: r for r in quality_measures(table(spark, folder, "documents")).collect()}
    assert len(rows) == len(docs)
    for r in docs:
        ours, mine = rows[r.doc_id], counts[r.doc_id]
        assert tuple(ours[name] for name in COUNTS) == mine
        kept = not mine[-1]
        if r.lang in means and mine[0]:
            far = [distance(s, m) for s, m in zip(shares[r.doc_id], means[r.lang], strict=True)]
            if mine[1] >= quality.LEAST_CHARACTERS:
                assert ours.char_distance == pytest.approx(far[0], abs=1e-9)
                kept &= far[0] <= quality.MAX_CHARACTER_DISTANCE
            else:
                assert ours.char_distance is None
            if mine[0] >= quality.LEAST_WORDS:
                assert ours.word_distance == pytest.approx(far[1], abs=1e-9)
                limit = quality.MAX_WORD_DISTANCE + quality.WORD_CHANCE / math.sqrt(mine[0])
                near = (ours.char_distance or 0) <= quality.NEAR_CHARACTER_DISTANCE
                kept &= far[1] <= limit or near
        assert ours.kept == kept


def test_labelled_rows(spark):
    """Rows labelled good stay unless the base rules reject them; most of the others go."""
    labels = dict(
        duckdb.sql(f"select doc_id, quality from '{MEDIUM}/labels.parquet'").fetchall()
    )
    rows = quality_measures(table(spark, MEDIUM, "documents")).collect()
    good = [r.kept for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    poor = [r.kept for r in rows if labels.get(r.doc_id) == 0]
    assert np.mean(good) > 0.995
    assert np.mean(poor) < 0.3


def test_repeated_windows_and_lines(spark):
    texts = {
        1: "a b c d e a b c d e",
        2: "x " * 50,
        3: "a b c d e f g h i j k a b c d e",
        4: "l\nl\n \nl\n m\nm",
        5: "a\x0bb\x0cc\rd e f g",
    }
    docs = spark.createDataFrame([(i, t, "en") for i, t in texts.items()], "doc_id long, text string, lang string")
    for row in quality_measures(docs).collect():
        assert tuple(row[name] for name in COUNTS) == brute_counts(texts[row.doc_id])


def test_nulls_long_texts_other_columns_and_empty(spark):
    schema = "doc_id long, text string, lang string, words string, kept int, language int"
    rows = [
        (None, None, None, "x", 1, 1),
        (1, "", "en", "x", 1, 1),
        (2, " ".join(f"w{i}" for i in range(60_000)), "xx", None, 1, 1),
        (2, " ".join(f"w{i}" for i in range(60_000)), "xx", None, 1, 1),
        (3, "only " * 12, None, None, 1, 1),
    ]
    docs = spark.createDataFrame(rows, schema)
    report = {r.doc_id: r for r in quality_measures(docs).collect()}
    assert [report[i].kept for i in (None, 1, 2, 3)] == [False, False, True, False]
    kept = drop_low_quality(docs)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.collect()] == [2, 2]
    empty = spark.createDataFrame([], schema)
    assert quality_measures(empty).count() == drop_low_quality(empty).count() == 0


def test_same_verdicts_in_report_and_filter(spark):
    docs = table(spark, SMALL, "documents")
    kept = {r.doc_id for r in quality_measures(docs).collect() if r.kept}
    assert {r.doc_id for r in drop_low_quality(docs).collect()} == kept


def _junk(i):
    return " ".join(f"{i}#{k}%$" + "&|" * (k % 3) for k in range(120))


def test_every_language_with_nearest_references(spark):
    """Junk goes and clean text stays whatever its language is called."""
    docs = table(spark, MEDIUM, "documents").filter("lang = 'en'")
    good = {r.doc_id for r in quality_measures(docs).collect() if r.kept and r.n_words >= 200}
    clean = [r.text for r in docs.collect() if r.doc_id in good][:60]
    names = ["en", "EN", "en-GB", " En", None, "it", ""]
    rows = [(i, t, "en") for i, t in enumerate(clean)]
    rows += [(10_000 + n, clean[n], lang) for n, lang in enumerate(names)]
    rows += [(20_000 + n, _junk(1), lang) for n, lang in enumerate(names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in quality_measures(docs, nearest=True).collect()}
    plain = {r.doc_id: r for r in quality_measures(docs).collect()}
    for n, lang in enumerate(names):
        assert found[10_000 + n].kept and not found[20_000 + n].kept
        assert found[20_000 + n].char_distance == pytest.approx(found[20_000].char_distance)
        # the plain rule knows a language by its exact name; without one there is no distance
        assert plain[20_000 + n].kept == (lang != "en")
        assert (plain[20_000 + n].char_distance is None) == (lang != "en")
    kept = {r.doc_id for r in drop_low_quality(docs, nearest=True).collect()}
    assert kept == {i for i, r in found.items() if r.kept}


def test_a_language_of_the_table_has_a_reference(spark):
    words = " ".join(f"slovo{k % 40}, {k}" for k in range(100))
    rows = [(i, f"{words} {i}", "cs") for i in range(20)] + [(99, _junk(1), "CS")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in quality_measures(docs, nearest=True).collect()}
    # no reference with common words is here, but the documents' own
    assert found[0].char_distance < 0.05 and found[99].char_distance > quality.MAX_CHARACTER_DISTANCE
    empty = quality_measures(docs.filter("doc_id < 0"), nearest=True)
    assert empty.count() == 0


def test_texts_are_counted_once(spark):
    docs = table(spark, SMALL, "documents")
    plan = drop_low_quality(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" not in plan and "regexp_replace" not in plan
