"""Near-duplicate groups by SimHash and covering locality-sensitive hashing.

A fingerprint bit is set when over half of the shingle hashes have it. For a radius r,
every bit position is given a vector of r + 1 bits; the table of a non-zero vector v
keeps the positions whose vector has an odd product with v. Any r positions leave some v
orthogonal to all of them, so two fingerprints that differ there agree in that table:
2^(r+1) - 1 tables miss no pair within the radius.

Within a bucket the candidates are compared exactly. Buckets of up to SMALL distinct
fingerprints are compared member by member. In larger ones each member is keyed by itself
and by every change of one of the table's free bits: two members share a key exactly if
they differ in two bits or fewer, one of them is the key itself exactly if they differ in
one, and a key has at most one member per free bit, so links grow with the members and not
with their square. Radii above 2 have no such keys here and are refused.

Equal fingerprints are one class from the start. Null and empty texts have fingerprint
zero and are linked like any other. Rows without doc_id take part by their fingerprint
and get the group's smallest id, or null. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleworks.llm.components import components, least_of_class, one_row_per_group
from candleworks.llm.text import spare_name
from candleworks.session import staged

BITS = 64
RADIUS = 2
SHINGLE = 3
SEED = 42
#: Buckets with more distinct fingerprints are split by one-bit changes.
SMALL = 32
#: Shingle hashes whose bits are counted at once.
STEP = 1 << 16


def word_spans(text: str | None, size: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by spaces, and where each shingle starts and ends in them."""
    tokens = text.encode().lower().split() if text else []  # bytes: only A-Z change
    if not tokens:
        return b"", np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(tokens) >= size:
        starts, ends = starts[: len(tokens) - size + 1], ends[size - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    return b" ".join(tokens), starts, ends


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The 64-bit fingerprint, as a signed number."""
    joined, starts, ends = word_spans(text, size)
    if not len(starts):
        return 0
    digest, seed = xxhash.xxh64_intdigest, SEED
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), STEP):
        spans = zip(starts[at : at + STEP].tolist(), ends[at : at + STEP].tolist())
        h = np.array([digest(joined[s:e], seed) for s, e in spans], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(len(h), 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = 2 * counts > len(starts)
    return int(np.packbits(set_bits, bitorder="little").view(np.int64)[0])


def fingerprints(documents: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id and fp of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": [fingerprint(t, size) for t in batch["text"]]})

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, fp long")


def covering_masks(radius: int = RADIUS) -> list[int]:
    """One mask of kept bits per non-zero vector of radius + 1 bits.

    Positions take the non-zero vectors in turn, so each table keeps nearly as many bits.
    """
    span = (1 << (radius + 1)) - 1
    vector = [1 + i % span for i in range(BITS)]
    return [sum(1 << i for i, m in enumerate(vector) if (m & v).bit_count() % 2) for v in range(1, span + 1)]


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` whose components are those of all
    pairs within the radius (0, 1 or 2); every edge is such a pair."""
    if not 0 <= radius <= 2:
        raise ValueError(f"radius {radius}: only 0, 1 and 2 bits are split in large buckets")
    masks = [_signed(m) for m in covering_masks(radius)]
    keys = F.array(*[F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)])
    keyed = distinct.select("fp", F.inline(keys))
    sizes = keyed.groupBy("table", "key").agg(F.count("*").alias("members"))
    shared = staged(sizes.where("members > 1"), "buckets")
    members = staged(keyed.join(shared, ["table", "key"]), "candidates")

    # Bounded lists: at most SMALL fingerprints each.
    lists = members.where(F.col("members") <= SMALL).groupBy("table", "key").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    near = lists.select(F.explode("fps").alias("a"), "fps").select(
        "a",
        F.explode(F.filter("fps", lambda b: (b < F.col("a")) & (F.bit_count(b.bitwiseXOR(F.col("a"))) <= radius))).alias("b"),
    )

    # The free bits of each table, one at a time; 0 leaves the fingerprint as it is.
    every = (1 << BITS) - 1
    free = [[0] + [_signed(1 << i) for i in range(BITS) if ((m ^ every) >> i) & 1] for m in covering_masks(radius)]
    flips = F.element_at(F.array(*[F.array(*[F.lit(x).cast("long") for x in row]) for row in free]), F.col("table") + 1)
    changed = members.where(F.col("members") > SMALL).select("table", "fp", F.explode(flips).alias("flip"))
    ball = changed.groupBy("table", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre")).agg(F.collect_list("fp").alias("fps"))
    # At two bits all members of a key are near each other, at one bit only to the key's own.
    hub = F.array_min("fps") if radius == 2 else F.col("centre")
    star = ball.where(F.array_contains("fps", hub) & (F.size("fps") > 1)).select(F.explode("fps").alias("a"), hub.alias("b"))
    star = star.where("a != b")
    return near.unionByName(star).distinct()


def groups(documents: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable) of every row."""
    marked = staged(fingerprints(documents, size), "fingerprints")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows"))
    distinct = staged(distinct, "classes")
    roots = components(links(distinct.select("fp"), radius))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", "rows", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("rows").alias("rows"))
    # Only classes with company need a lookup; the others are their own component.
    shared = rooted.select("fp", "root").join(least.where("rows > 1").select("root", "component_id"), "root")
    return marked.join(shared.select("fp", "component_id"), "fp", "left").select(
        "doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def deduplicated(documents: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each group, with all its columns.

    It is the row with the smallest id; rows without an id come last, and of rows that
    repeat an id the one with the smallest hash of its text stays.
    """
    near, row = spare_name(documents, "near"), spare_name(documents, "row")

    @F.pandas_udf("long")
    def mark(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t, size) for t in batch], dtype="int64")

    marked = documents.withColumn(near, mark("text")).withColumn(row, F.monotonically_increasing_id())
    marked = staged(marked, "fingerprints")
    classes = staged(least_of_class(marked, F.col(near), row), "classes")
    roots = components(links(classes.select(F.col("class").alias("fp")), radius))
    return one_row_per_group(marked, classes.withColumnRenamed("class", "node"), roots, row).select(*documents.columns)
