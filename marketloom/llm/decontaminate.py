"""Benchmark decontamination by a distributed positional inverted index.

The index holds, for every run of whole documents, the distinct words as sorted
64-bit codes and for each word the sorted places where it stands. It is stored
once; test windows are then looked up in it block by block. A lookup starts with
the window's rarest word in the whole corpus, and the list of places, shifted by
the word's offset, is intersected with the lists of the other words in order of
rarity. What is left are exact phrase matches. Proximity matches ask only that
the rarest words of an item stand near each other.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.words import ALPHANUMERIC, covered, find_words, ranges, release_memory, slices, start_in_worker
from marketloom.scratch import scratch_folder, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 13
# Benchmark text that is looked up, and broadcast, at one time; its windows take some 40 times as much.
BLOCK_BYTES = 2 << 20
# Text of one row of the index.
ROW_BYTES = 1 << 18
# Row groups of the stored index. Parquet's writer looks at sizes every 100 rows only, which are some 50 MB
# of index here, and keeps native buffers of that size; it is told to look after every row.
INDEX_FILES = {
    "parquet.block.size": str(8 << 20),
    "parquet.block.size.row.check.min": "1",
    "parquet.page.size.row.check.min": "1",
}
# Proximity: this many rarest words of an item, all this near to the rarest.
NEAR_TERMS = 4
NEAR_SPAN = 26

_INDEX = (
    "doc_ids array<bigint>, first array<bigint>, terms binary, term_first binary, places binary"
)
_HITS = (
    "doc_id bigint, n_words bigint, starts array<int>, ends array<int>,"
    " items array<string>, near array<string>, chunk bigint, row int"
)


def build_index(docs: DataFrame) -> DataFrame:
    """Postings of every word of every document, one row per run of documents."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        _index_rows, _INDEX
    ).withColumn("chunk", F.monotonically_increasing_id())


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    start_in_worker("decontaminate")
    for part in slices(batches, limit=ROW_BYTES):
        words = find_words(part.column(1), ALPHANUMERIC, lower=True)
        order = np.argsort(words.codes, kind="stable")
        ranked = words.codes[order]
        new = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else order
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                pa.array([words.first], pa.list_(pa.int64())),
                pa.array([ranked[new].tobytes()], pa.binary()),
                pa.array([np.append(new, len(ranked)).astype(np.int32).tobytes()], pa.binary()),
                pa.array([order.astype(np.int32).tobytes()], pa.binary()),
            ],
            ["doc_ids", "first", "terms", "term_first", "places"],
        )


@dataclass
class Lookups:
    """Windows of one block of test items, as places in the block's vocabulary."""

    vocabulary: np.ndarray  # sorted codes
    windows: np.ndarray  # one row per distinct window, -1 beyond its length
    lengths: np.ndarray
    items: list[list[str]]  # per window, the items that have it
    names: list[str]  # per item
    item_terms: list[np.ndarray]  # per item, its distinct words
    order: np.ndarray | None = None  # per window, offsets from the rarest word on
    near: np.ndarray | None = None  # per item, its rarest words


def lookups(items: list[tuple[object, str | None]]) -> Lookups:
    words = find_words(pa.array([text for _, text in items], pa.string()), ALPHANUMERIC, lower=True)
    vocabulary, inverse = np.unique(words.codes, return_inverse=True)
    found: dict[tuple[int, ...], set[str]] = {}
    names, terms = [], []
    for i, (item, _) in enumerate(items):
        own = inverse[words.first[i] : words.first[i + 1]].tolist()
        if not own:
            continue
        name = "" if item is None else str(item)
        names.append(name)
        terms.append(np.unique(own))
        for k in range(max(1, len(own) - WINDOW + 1)):
            found.setdefault(tuple(own[k : k + WINDOW]), set()).add(name)
    table = np.full((len(found), WINDOW), -1, np.int32)
    for row, window in enumerate(found):
        table[row, : len(window)] = window
    return Lookups(vocabulary, table, (table >= 0).sum(1), [sorted(x) for x in found.values()], names, terms)


def rank_by_rarity(asked: Lookups, counts: np.ndarray) -> None:
    """Put each window's words, and each item's, in order of their counts in the corpus."""
    weight = np.where(asked.windows >= 0, counts[asked.windows], np.iinfo(np.int64).max)
    asked.order = np.argsort(weight, axis=1, kind="stable").astype(np.int8)
    asked.near = np.full((len(asked.names), NEAR_TERMS), -1, np.int64)
    for row, terms in enumerate(asked.item_terms):
        rare = terms[np.lexsort((terms, counts[terms]))][:NEAR_TERMS]
        asked.near[row, : len(rare)] = rare


def _find_terms(vocabulary: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Place of every vocabulary word among a chunk's terms, -1 where it has none."""
    if not len(terms):
        return np.full(len(vocabulary), -1)
    at = np.minimum(np.searchsorted(terms, vocabulary), len(terms) - 1)
    return np.where(terms[at] == vocabulary, at, -1)


def _count_terms(asked) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start_in_worker("decontaminate")
        vocabulary = asked.value["vocabulary"]
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for terms, first in zip(batch.column(0), batch.column(1), strict=True):
                at = _find_terms(vocabulary, np.frombuffer(terms.as_buffer(), np.uint64))
                total += np.where(at >= 0, np.diff(np.frombuffer(first.as_buffer(), np.int32), append=0)[at], 0)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "n"])
        release_memory()

    return count


class _Chunk:
    """One row of the index, with lookups of places by word."""

    def __init__(self, row: dict) -> None:
        self.doc_ids = row["doc_ids"].as_py()
        self.first = np.asarray(row["first"].values)
        self.terms = np.frombuffer(row["terms"].as_buffer(), np.uint64)
        self.term_first = np.frombuffer(row["term_first"].as_buffer(), np.int32).astype(np.int64)
        self.places = np.frombuffer(row["places"].as_buffer(), np.int32).astype(np.int64)
        self.n = int(self.first[-1])
        # (word, place) as one sorted number, so that many lists are searched at once.
        self.keys = np.repeat(np.arange(len(self.terms)), np.diff(self.term_first)) * (self.n + 1) + self.places

    def doc_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, place, "right") - 1

    def postings(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into `term`, place) of every posting of the given words."""
        counts = self.term_first[term + 1] - self.term_first[term]
        return np.repeat(np.arange(len(term)), counts), self.places[ranges(self.term_first[term], counts)]

    def phrases(self, asked: Lookups, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, first place) of every exact occurrence."""
        rare = np.take_along_axis(asked.windows, asked.order[:, :1].astype(np.int64), 1)[:, 0]
        alive = np.flatnonzero(at[rare] >= 0)
        windows = asked.windows[alive]
        local = np.where(windows >= 0, at[windows], 0)
        whole = (local >= 0).all(1)
        alive, windows, local = alive[whole], windows[whole], local[whole]
        if not len(alive):
            return alive, alive
        order, lengths = asked.order[alive].astype(np.int64), asked.lengths[alive]
        row, place = self.postings(local[np.arange(len(alive)), order[:, 0]])
        start = place - order[row, 0]
        ok = (start >= 0) & (start + lengths[row] <= self.n)
        row, start = row[ok], start[ok]
        for rank in range(1, WINDOW):
            offset = order[row, rank]
            real = windows[row, offset] >= 0
            key = local[row, offset] * (self.n + 1) + start + offset
            hit = self.keys[np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)] == key
            row, start = row[hit | ~real], start[hit | ~real]
            if not len(row):
                break
        inside = self.doc_of(start) == self.doc_of(start + lengths[row] - 1)
        return alive[row[inside]], start[inside]

    def nearby(self, asked: Lookups, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, document) where the item's rarest words stand near its rarest one."""
        local = np.where(asked.near >= 0, at[asked.near], 0)
        alive = np.flatnonzero((local >= 0).all(1))
        if not len(alive):
            return alive, alive
        owner, place = self.postings(local[alive, 0])
        item = alive[owner]
        doc = self.doc_of(place)
        for rank in range(1, NEAR_TERMS):
            real = asked.near[item, rank] >= 0
            low = np.maximum(place - NEAR_SPAN, self.first[doc])
            high = np.minimum(place + NEAR_SPAN, self.first[doc + 1] - 1)
            base = local[item, rank] * (self.n + 1)
            found = np.searchsorted(self.keys, base + low) < np.searchsorted(self.keys, base + high, "right")
            item, place, doc = (x[found | ~real] for x in (item, place, doc))
        pairs = np.unique(np.stack([item, doc]), axis=1)
        return pairs[0], pairs[1]


def _match(asked) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("n_words", pa.int64()), ("starts", pa.list_(pa.int32())),
            ("ends", pa.list_(pa.int32())), ("items", pa.list_(pa.string())),
            ("near", pa.list_(pa.string())), ("chunk", pa.int64()), ("row", pa.int32()),
        ]
    )

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start_in_worker("decontaminate")
        query = Lookups(**asked.value)
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = _Chunk({name: batch.column(name)[i] for name in batch.schema.names})
                at = _find_terms(query.vocabulary, chunk.terms)
                window, start = chunk.phrases(query, at)
                item, near_doc = chunk.nearby(query, at)
                n_docs = len(chunk.doc_ids)
                starts, ends, items, near = ([[] for _ in range(n_docs)] for _ in range(4))
                for w, s, d in zip(window.tolist(), start.tolist(), chunk.doc_of(start).tolist(), strict=True):
                    starts[d].append(s - int(chunk.first[d]))
                    ends[d].append(s - int(chunk.first[d]) + int(query.lengths[w]))
                    items[d] += query.items[w]
                for k, d in zip(item.tolist(), near_doc.tolist(), strict=True):
                    near[d].append(query.names[k])
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": chunk.doc_ids,
                        "n_words": np.diff(chunk.first),
                        "starts": starts,
                        "ends": ends,
                        "items": [sorted(set(x)) for x in items],
                        "near": [sorted(set(x)) for x in near],
                        "chunk": [batch.column("chunk")[i].as_py()] * n_docs,
                        "row": np.arange(n_docs, dtype=np.int32),
                    },
                    schema,
                )

    return match


def _count_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words in any of a document's matches."""
    for batch in batches:
        n_hit = [
            int(covered(np.array(a, np.int64), np.array(b, np.int64), n).sum()) if a else 0
            for n, a, b in zip(*(batch.column(c).to_pylist() for c in ("n_words", "starts", "ends")), strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(n_hit, pa.int64())], [*batch.schema.names, "n_hit"]
        )


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[object, str | None]]]:
    """The test items in lists of bounded text size; one list is on the driver at a time.

    Items are dealt by a hash of id and text. A block is at most a few times
    `block_bytes`, or one item where that alone is longer.
    """
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    n = 1 + int(size) // block_bytes
    for k in range(n):
        block = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r[0], r[1]) for r in block.collect()]


def find_contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Test windows in every document.

    Returns one row per row of `docs`: doc_id, n_words, n_hit (words in a matched
    window), items and near (sorted ids of items with exact and with proximity
    matches) and contaminated (5 % of the words are hit, one at least).

    Defined cases: NULL and empty texts have no words and are clean; an item
    without words matches nothing; an item id that is NULL counts as ''; rows
    that repeat an id are judged one by one; an empty benchmark leaves every
    document clean; other columns are not read.
    """
    spark = docs.sparkSession
    parts = []
    with scratch_folder(spark, "index") as stored:  # the index goes when all blocks are looked up
        index = stored(build_index(docs), "postings", **INDEX_FILES)
        for block in blocks(benchmark, block_bytes):
            asked = lookups(block)
            shared = spark.sparkContext.broadcast(vars(asked))  # plain arrays: tasks have no package
            rows = index.select("terms", "term_first").mapInArrow(_count_terms(shared), "term bigint, n bigint")
            counts = np.zeros(len(asked.vocabulary), np.int64)
            for row in rows.groupBy("term").agg(F.sum("n").alias("n")).collect():  # within the block's words
                counts[row["term"]] = row["n"]
            rank_by_rarity(asked, counts)
            shared.unpersist()
            shared = spark.sparkContext.broadcast(vars(asked))
            parts.append(written(index.mapInArrow(_match(shared), _HITS), "hits"))
            shared.unpersist()  # one block's tables are out at a time
    found = reduce(DataFrame.unionByName, parts)
    if len(parts) > 1:
        merged = [F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends")]
        named = [F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("items", "near")]
        found = found.groupBy("chunk", "row").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), *merged, *named
        ).select("doc_id", "n_words", "starts", "ends", "items", "near", "chunk", "row")
    counted = found.mapInArrow(_count_hits, _HITS + ", n_hit bigint")
    dirty = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return counted.select("doc_id", "n_words", "n_hit", "items", "near", dirty.alias("contaminated"))
