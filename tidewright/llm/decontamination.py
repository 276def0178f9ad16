"""Benchmark decontamination by Wu-Manber search over words.

A pattern is a window of `width` consecutive benchmark words; an item with
fewer words, but not none, is one pattern. Patterns of one length share a
table: the shift of a block of two words (one word for patterns of one) is the
least distance from where it stands in a pattern to the pattern's end; a block
that no pattern has lets the search skip all positions but one of the length.
Where the shift is 0 the block selects a bucket of patterns, which are compared
word by word.

The benchmark goes to the executors in parts of at most PART_BYTES of text,
which bounds what is broadcast at any size of the benchmark; the parts follow
each other over the same rows without a shuffle.

Defined cases: null text has no words and no hits; a null item id counts as an
empty id; repeated items share their id; an empty benchmark hits nothing; an
empty table gives an empty result; the documents' own columns pass through
whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tidewright.llm.common import as_bytes, first_columns, folded_words, free_names, picked, slices, tidy

WIDTH = 10
PART_BYTES = 1 << 20
ADDED = ("n_words", "hit_starts", "hit_stops", "items")


class PatternTable:
    """Shift table and buckets of patterns of one length."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], list[str]]):
        self.length, self.block = length, min(2, length)
        self.skip = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = defaultdict(list)
        for words, items in patterns.items():
            for stop in range(self.block, length + 1):
                block = words[stop - 2 : stop] if self.block == 2 else words[0]
                self.shift[block] = min(self.shift.get(block, self.skip), length - stop)
            self.buckets[words[-2:] if self.block == 2 else words[0]].append((words, items))

    def search(self, words: list[bytes], found: list[tuple[int, int, list[str]]]) -> None:
        """Appends (start, stop, items) of every occurrence."""
        length, skip, shift, at, n = self.length, self.skip, self.shift.get, self.length - 1, len(words)
        if self.block == 1:
            found += [(i, i + 1, items) for i, w in enumerate(words) if w in self.shift for _, items in self.buckets[w]]
            return
        while at < n:
            step = shift((words[at - 1], words[at]), skip)
            if step:
                at += step
                continue
            start = at - length + 1
            here = None
            for pattern, items in self.buckets[words[at - 1], words[at]]:
                if words[start] == pattern[0]:
                    here = here or tuple(words[start : at + 1])
                    if here == pattern:
                        found.append((start, at + 1, items))
            at += 1


def pattern_tables(items: list[tuple[str, bytes]], width: int = WIDTH) -> list[PatternTable]:
    by_length: dict[int, dict[tuple[bytes, ...], list[str]]] = defaultdict(dict)
    for item, text in items:
        words = folded_words(text)
        length = min(width, len(words))
        for i in range(len(words) - length + 1 if length else 0):
            named = by_length[length].setdefault(tuple(words[i : i + length]), [])
            if item not in named:
                named.append(item)
    return [PatternTable(length, patterns) for length, patterns in sorted(by_length.items())]


def _union(found: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    starts, stops = [], []
    for a, b in sorted(found):
        if stops and a <= stops[-1]:
            stops[-1] = max(stops[-1], b)
        else:
            starts.append(a)
            stops.append(b)
    return starts, stops


def _scan(tables, own: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched = tables.value
        for whole in batches:
            for batch in slices(whole, "scanned_text"):
                counts, starts, stops, items = [], [], [], []
                # Columns from `own` on are earlier parts' findings.
                before = [batch.column(own + 1 + k).to_pylist() for k in range(len(ADDED))]
                for i, text in enumerate(as_bytes(batch.column("scanned_text"))):
                    words, found = folded_words(text), []
                    for t in searched:
                        t.search(words, found)
                    places = [f[:2] for f in found] + list(zip(before[1][i], before[2][i], strict=True))
                    a, b = _union(places)
                    counts.append(len(words))
                    starts.append(a)
                    stops.append(b)
                    items.append(sorted({x for f in found for x in f[2]}.union(before[3][i])))
                arrays = batch.columns[: own + 1] + [
                    pa.array(counts, pa.int64()),
                    pa.array(starts, pa.list_(pa.int32())),
                    pa.array(stops, pa.list_(pa.int32())),
                    pa.array(items, pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return tidy(run)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
) -> DataFrame:
    """The documents with n_words, hit_starts, hit_stops (word spans, joined) and items behind their own columns.

    Added columns get names that the documents don't have; they are the last
    four, in the order of ADDED.
    """
    spark = docs.sparkSession
    texts = picked(benchmark, item=item_col, text=item_text_col).select(
        F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"),
        F.col("text").cast("string").alias("text"),
    ).where("text is not null")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = -(-size // PART_BYTES) or 1
    own = [f"own_{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*own)
    rows = rows.withColumn("scanned_text", rows[own[docs.columns.index(text_col)]].cast("string")).withColumns(
        {
            "n_words": F.lit(0).cast("long"),
            "hit_starts": F.array().cast("array<int>"),
            "hit_stops": F.array().cast("array<int>"),
            "items": F.array().cast("array<string>"),
        }
    )
    schema = StructType(
        [StructField(f.name, f.dataType) for f in rows.schema.fields[: len(own) + 1]]
        + [
            StructField("n_words", LongType()),
            StructField("hit_starts", ArrayType(IntegerType())),
            StructField("hit_stops", ArrayType(IntegerType())),
            StructField("items", ArrayType(StringType())),
        ]
    )
    for part in range(n_parts):
        # About PART_BYTES: items are dealt out evenly by hash.
        held = texts.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_parts)) == part).orderBy("item", "text").collect()
        tables = pattern_tables([(r.item, r.text.encode()) for r in held], width)
        rows = rows.mapInArrow(_scan(spark.sparkContext.broadcast(tables), len(own)), schema)
    return rows.drop("scanned_text").toDF(*docs.columns, *free_names(docs.columns, ADDED))


def hit_words(starts: str, stops: str):
    """Number of words inside the spans of two array columns."""
    return F.aggregate(
        F.zip_with(starts, stops, lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"), lambda x, y: x + y
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a hit, with their own columns."""
    found = contamination(docs, benchmark, **options)
    return first_columns(found, docs.columns, lambda items: F.size(items) == 0)


def items_digest(items: str):
    return F.sha2(F.array_join(items, ","), 256)


def brute_force(words: list[bytes], items: list[tuple[str, bytes]], width: int = WIDTH) -> tuple[set[int], set[str]]:
    """Hit words and items of one document by comparing every position; for tests."""
    hit, named = set(), set()
    for item, text in items:
        own = folded_words(text)
        length = min(width, len(own))
        for i in range(len(own) - length + 1 if length else 0):
            for k in range(len(words) - length + 1):
                if words[k : k + length] == own[i : i + length]:
                    hit.update(range(k, k + length))
                    named.add(item)
    return hit, named

