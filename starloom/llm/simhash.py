"""SimHash near-duplicates by multi-index hashing.

A fingerprint of 64 bits is the bitwise majority of the XXH64 hashes of a document's word
shingles. Two fingerprints that differ in at most 3 bits differ in at most one bit in one
of their two halves. So each half is an index of its own (a table from half values to
fingerprints), the values within one bit of a half are enumerated, each is looked up in
the table by an equi-join, and the full distance of what it finds is verified.

A pair that differs in one bit of a half has a 0 there on one side: enumerating the values
with one more bit set (16 of 32 on average) finds every pair, once instead of twice.

Copies share a fingerprint and enter the index once, whatever their number. Half values
that many different fingerprints share (near copies by the thousand) are looked up by a
finer key: the other half is split in two quarters, of which one again differs in at most
one bit, and the key carries that quarter's value.

Fingerprints that differ in one bit are put together first, by an equi-join on the whole
value, and what follows looks for links between these clusters alone: keys that hold one
cluster are left out before the join, and a pair of clusters is one link. So near copies by
the thousand, which are mostly one bit from each other, do not make links in pairs.

Links between fingerprints become groups by alternating large-star and small-star steps,
each written to the shared folder, until nothing changes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import (
    BROADCAST_BYTES,
    ROW_KEY,
    keep_rows,
    row_key,
    table,
    text_or_empty,
    text_session,
)
from starloom.operators.lookup import look_up
from starloom.workspace import Workspace

SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42
# distinct fingerprints with one half value from which on the finer key is used
CROWDED = 64

_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint as a signed 64-bit number; 0 for a text without words."""
    from xxhash import xxh64_intdigest

    # bytes.lower changes A-Z alone, bytes.split parts at blank and the controls 9 to 13
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    count = max(1, len(words) - shingle_words + 1)
    votes = np.zeros(64, dtype=np.int64)
    for start in range(0, count, _HASHES_AT_ONCE):
        stop = min(count, start + _HASHES_AT_ONCE)
        parts = [words[start + k : stop + k] for k in range(shingle_words)]
        if count == 1:
            shingles = [b" ".join(words[:shingle_words])]
        else:
            shingles = map(b" ".join, zip(*parts, strict=True))
        hashes = np.fromiter(
            (xxh64_intdigest(s, HASH_SEED) for s in shingles), np.uint64, stop - start
        )
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > count).view(">i8")[0])


def _fingerprints(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            values = [fingerprint(text.as_py(), shingle_words) for text in texts]
            columns = [*batch.columns[:-1], pa.array(values, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "fp"])

    return run


def fingerprints(
    docs: DataFrame, id_col: str, text_col: str, shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    text_session(docs.sparkSession)
    slim = docs.select(
        F.col(id_col).alias("doc_id"), *row_key(docs), text_or_empty(text_col).alias("text")
    )
    kind = dict(slim.dtypes)["doc_id"]
    return slim.mapInArrow(
        _fingerprints(shingle_words),
        f"doc_id {kind}, {ROW_KEY[0]} long, {ROW_KEY[1]} long, fp long",
    )


def _piece(fp: Column, shift: int, bits: int) -> Column:
    return F.shiftright(fp, shift).bitwiseAND(F.lit((1 << bits) - 1))


def _ball(value: Column, bits: int) -> Column:
    """The value itself and every value with one of its 0 bits set."""
    return F.concat(F.array(value), _one_more(value, range(bits)))


def _one_more(value: Column, bits: range) -> Column:
    """Every value with one more of these bits set."""
    # bit 63 is the sign of a long
    ones = F.array(*[F.lit(1 << bit if bit < 63 else -(1 << 63)) for bit in bits])
    unset = F.filter(ones, lambda one: value.bitwiseAND(one) == 0)
    return F.transform(unset, lambda one: value.bitwiseOR(one))


def _both_ways(value: Column, bits: int) -> Column:
    """The value and every value one bit away."""
    ones = F.array(*[F.lit(1 << bit) for bit in range(bits)])
    return F.concat(F.array(value), F.transform(ones, lambda one: value.bitwiseXOR(one)))


def _entries(nodes: DataFrame, *others: str) -> DataFrame:
    """Both indexes: a row for each half of each fingerprint."""
    fp = F.col("fp")
    halves = F.explode(F.array(F.lit(0), F.lit(1))).alias("half")
    value = F.when(F.col("half") == 0, _piece(fp, 32, 32)).otherwise(_piece(fp, 0, 32))
    return nodes.select("fp", *others, halves).withColumn("value", value)


def _shuffled(probes: DataFrame) -> DataFrame:
    """Never sent to every executor: Spark sizes exploded rows as the rows they come from.

    Probes are up to 66 times as many as the fingerprints, so their true size is far beyond
    the estimate by which Spark would broadcast them.
    """
    return probes.hint("merge")


def shared_values(nodes: DataFrame, workspace: Workspace) -> DataFrame:
    """half, value, count: half values that several fingerprints have."""
    counts = _entries(nodes).groupBy("half", "value").count()
    return workspace.save(counts.filter("count > 1"), "shared")


def one_bit_links(nodes: DataFrame, shared: DataFrame) -> DataFrame:
    """The pairs (a, b) of fingerprints that differ in one bit, each once.

    The half without that bit is a shared value, so other fingerprints need no probes. One
    of the two has a 0 there: at most 32 links a fingerprint, however many are alike.
    """
    alike = _entries(nodes).join(shared, ["half", "value"], "left_semi").select("fp", "half")
    fp = F.col("fp")
    lower, upper = _one_more(fp, range(32)), _one_more(fp, range(32, 64))
    probes = alike.select(
        fp.alias("a"), "half", F.explode(F.when(F.col("half") == 0, lower).otherwise(upper)).alias("fp")
    )
    return _shuffled(probes).join(alike, ["half", "fp"]).select("a", fp.alias("b"))


def links(nodes: DataFrame, workspace: Workspace, crowded: int = CROWDED) -> DataFrame:
    """All pairs (a, b) of different fingerprints of `nodes` within 3 bits, unordered.

    A pair may come more than once.
    """
    alone = nodes.select("fp", F.col("fp").alias("cluster"))
    return cluster_links(alone, shared_values(nodes, workspace), workspace, crowded)


def cluster_links(
    nodes: DataFrame, shared: DataFrame, workspace: Workspace, crowded: int = CROWDED
) -> DataFrame:
    """Pairs (a, b) of clusters of which some fingerprints are within 3 bits, unordered.

    `nodes` has fingerprints and their clusters. Every such pair comes, maybe more than once.
    """
    entries = _entries(nodes, "cluster")
    probes = entries.select(
        F.col("fp").alias("other"),
        F.col("cluster").alias("other_cluster"),
        "half",
        F.explode(_ball(F.col("value"), 32)).alias("value"),
    )
    key = ["half", "value"]
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= MAX_BITS
    dense = shared.filter(F.col("count") > crowded).select(*key)
    has_dense = not dense.isEmpty()
    sparse = entries.join(dense, key, "left_anti") if has_dense else entries
    found = sparse.join(_shuffled(probes), key)
    if has_dense:
        found = found.select(*_FOUND).unionByName(
            _crowded_pairs(entries, probes, dense, workspace).select(*_FOUND)
        )
    return found.filter(close & (F.col("cluster") != F.col("other_cluster"))).select(
        F.col("cluster").alias("a"), F.col("other_cluster").alias("b")
    )


_FOUND = ("fp", "other", "cluster", "other_cluster")


def _mixed(
    entries: DataFrame, probes: DataFrame, key: list[str], workspace: Workspace
) -> tuple[DataFrame, DataFrame]:
    """Both sides at the keys where they hold more than one cluster; others link nothing."""
    seen = entries.select(*key, "cluster").unionByName(
        probes.select(*key, F.col("other_cluster").alias("cluster"))
    )
    spread = seen.groupBy(*key).agg(F.min("cluster").alias("low"), F.max("cluster").alias("high"))
    keys = workspace.save(spread.filter("low < high").select(*key), "mixed")
    return entries.join(keys, key, "left_semi"), probes.join(keys, key, "left_semi")


def _crowded_pairs(
    entries: DataFrame, probes: DataFrame, dense: DataFrame, workspace: Workspace
) -> DataFrame:
    key = ["half", "value"]
    entries, probes = (side.join(dense, key, "left_semi") for side in (entries, probes))
    entries, probes = _mixed(entries, probes, key, workspace)

    def quarters(rows: DataFrame, name: str, both: bool) -> DataFrame:
        fp = F.col(name)
        rest = F.when(F.col("half") == 0, _piece(fp, 0, 32)).otherwise(_piece(fp, 32, 32))
        rows = rows.withColumn("rest", rest)
        rows = rows.withColumn("quarter", F.explode(F.array(F.lit(0), F.lit(16))))
        fine = F.when(F.col("quarter") == 0, F.col("rest").bitwiseAND(F.lit(0xFFFF))).otherwise(
            F.shiftright("rest", 16)
        )
        values = F.explode(_both_ways(fine, 16)) if both else fine
        return rows.withColumn("fine", values).drop("rest")

    # which side has the 0 in the half says nothing about the quarter: both ways here
    finer = [*key, "quarter", "fine"]
    entries, probes = _mixed(
        quarters(entries, "fp", False), quarters(probes, "other", True), finer, workspace
    )
    return entries.join(_shuffled(probes), finer)


def components(edges: DataFrame, workspace: Workspace) -> DataFrame:
    """node, root: the smallest node reachable over the edges (a, b); linked nodes only."""

    def ordered(pairs: DataFrame) -> DataFrame:
        low, high = F.least("a", "b"), F.greatest("a", "b")
        return pairs.select(high.alias("a"), low.alias("b")).filter("a > b").distinct()

    def star(pairs: DataFrame) -> DataFrame:
        """Link the nodes to the smallest of their centre's neighbours; a > b throughout."""
        lowest = pairs.groupBy("a").agg(F.min("b").alias("low"))
        return pairs.join(lowest, "a")

    def state(pairs: DataFrame) -> tuple:
        return tuple(
            pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        )

    current = workspace.save(ordered(edges), "edges")
    before = state(current)
    while True:
        # large star: every neighbour above a node goes to the smallest around that node
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low"))
        lowest = lowest.select("a", F.least("a", "low").alias("low"))
        large = (
            both.join(lowest, "a")
            .filter("b > a")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .distinct()
        )
        # small star: a node and its smaller neighbours go to the smallest of them
        large = workspace.save(large, "large-star")
        small = star(large)
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            small.select("a", F.col("low").alias("b"))
        )
        last, current = current, workspace.save(small.filter("a > b").distinct(), "small-star")
        workspace.release(last, large)
        after = state(current)
        if after == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after


def _grouped(
    docs: DataFrame, id_col: str, text_col: str, workspace: Workspace, shingle_words: int
) -> DataFrame:
    """Every row with its fingerprint and its group's first row (lowest id, null last)."""
    rows = workspace.save(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *ROW_KEY)
    # what only the way to the groups needs goes with it
    steps = Workspace(docs.sparkSession, workspace.root)
    nodes = steps.save(rows.groupBy("fp").agg(F.min(first).alias("first")), "nodes")
    shared = shared_values(nodes, steps)
    near = components(one_bit_links(nodes, shared), steps)
    near = near.withColumnsRenamed({"node": "fp", "root": "cluster"})
    nodes = look_up(nodes, near, ["fp"], BROADCAST_BYTES)
    nodes = steps.save(nodes.withColumn("cluster", F.coalesce("cluster", "fp")), "clusters")
    roots = components(cluster_links(nodes, shared, steps), steps)
    roots = roots.withColumnRenamed("node", "cluster")
    members = look_up(nodes, roots, ["cluster"], BROADCAST_BYTES)
    members = members.withColumn("root", F.coalesce("root", "cluster"))
    groups = members.groupBy("root").agg(F.min("first").alias("group_first"))
    members = members.join(groups, "root").select("fp", "group_first")
    members = workspace.save(members, "members")
    steps.discard()
    return look_up(rows, members, ["fp"], BROADCAST_BYTES)


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    workspace: Workspace | None = None,
    shingle_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints link at 3 or fewer differing bits; component_id is the smallest id that
    links reach, the document's own included. A null text counts as empty; a text without
    words has fingerprint zero and links like any other. Rows with a null id take part and
    get the id of their group, null if the whole group has none. Repeated rows stay
    repeated. An empty table gives an empty result. Other columns, whatever their names and
    types, are read for the hash by which rows with the same id are told apart.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    return _grouped(docs, id_col, text_col, workspace, shingle_words).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("group_first.doc_id").alias("component_id"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    workspace: Workspace | None = None,
    shingle_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """The rows of `docs`, with all columns, that come first in their group.

    The row with the smallest id stays, null ids last; equal ids go by the hash of all
    columns, and of rows equal in every column one stays.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    key = [F.col(name) == F.col(f"group_first.{name}") for name in ROW_KEY]
    winners = (
        _grouped(docs, id_col, text_col, workspace, shingle_words)
        .filter(key[0] & key[1])
        .groupBy(*ROW_KEY)
        .agg(F.count("*").alias("copies"))
    )
    return keep_rows(docs, workspace.save(winners, "winners"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_groups(table(spark, folder, "documents"))
