"""Near duplicates by circulant MinHash, banding and exact Jaccard verification.

Signatures need two permutations only: the first one places a shingle on a ring,
and the second one, shifted around the ring by another step for every
coordinate, ranks it. Documents that agree in one band of coordinates are
candidates; a link counts only when the full shingle sets confirm it.

Documents with equal sets form a class and one of them stands for it. All buckets
with one leader make a group, and every member is compared with the leader. Only
members that it is not linked with, the strays, are compared with the rest of
their group, in blocks of bounded size that count shared shingles by an inverted
index. So n edited copies of a text cost about n comparisons, pairs never become
rows, and no link inside a bucket is lost.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.components import connected
from marketloom.llm.words import SPACED, Words, find_words, mix, ranges, runs, slices, start_in_worker, whole_runs
from marketloom.scratch import scratch_folder, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 4
# A link at 0.8 is missed by all bands with probability (1 - 0.8 ** 4) ** 24, about 3e-6.
BANDS, ROWS = 24, 4
SIMILAR_PERCENT = 80
# Shingles of the members that one task compares at a time.
BLOCK_SHINGLES = 400_000

_RING = 0x9E3779B9
_SIGNED = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"


def _rank(x: np.ndarray) -> np.ndarray:
    """The second permutation, of 32-bit places; overwrites its argument."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def shingle_sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, code) of every distinct shingle, in order of text and code.

    A text of fewer than SHINGLE words has one shingle, its whole sequence.
    """
    text = words.text_of_word()
    whole = np.flatnonzero(whole_runs(words.first, len(words.codes), SHINGLE))
    codes, texts = [runs(words.codes, SHINGLE)[whole]], [text[whole]]
    sizes = np.diff(words.first)
    for length in range(1, SHINGLE):
        short = np.flatnonzero(sizes == length)
        if len(short):
            codes.append(mix(runs(words.codes, length)[words.first[short]] + np.uint64(length)))
            texts.append(short)
    code, text = np.concatenate(codes), np.concatenate(texts)
    order = np.lexsort((code, text))
    code, text = code[order], text[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
    return text[new], code[new]


def signatures(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Coordinates of every set; set i has codes first[i] to first[i + 1], one at least."""
    place = (mix(code) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(first) - 1, BANDS * ROWS), np.uint32)
    with np.errstate(over="ignore"):
        for k in range(BANDS * ROWS):
            shift = np.uint32(k * _RING & 0xFFFFFFFF)
            out[:, k] = np.minimum.reduceat(_rank(place + shift), first[:-1])
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    start_in_worker("near_dups")
    for batch in slices(batches):
        text, code = shingle_sets(find_words(batch.column(1), SPACED, lower=True))
        n = np.bincount(text, minlength=batch.num_rows)
        full = np.flatnonzero(n)
        first = np.concatenate([[0], np.cumsum(n[full])])
        sums = np.zeros((2, batch.num_rows), np.uint64)
        keys = np.zeros((batch.num_rows, BANDS), np.uint64)
        if len(full):
            with np.errstate(over="ignore"):
                for k in range(2):
                    sums[k, full] = np.add.reduceat(mix(code + np.uint64(k + 1)), first[:-1])
                rows = signatures(code, first).reshape(len(full), BANDS, ROWS)
                key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(full), BANDS))
                for k in range(ROWS):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, k])
            keys[full] = key
        sizes = np.where(n > 0, BANDS, 0)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n.astype(np.int64)),
                pa.array(sums[0].view(np.int64)),
                pa.array(sums[1].view(np.int64)),
                pa.ListArray.from_arrays(
                    np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), pa.array(keys[full].ravel().view(np.int64))
                ),
            ],
            ["doc_id", "n_shingles", "set_a", "set_b", "bands"],
        )


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose full sets are similar enough."""
    start_in_worker("near_dups")
    for batch in slices(slices(batches, "text_a"), "text_b"):
        sides = []
        for name in ("text_a", "text_b"):
            text, code = shingle_sets(find_words(batch.column(name), SPACED, lower=True))
            sides.append((text, code, np.bincount(text, minlength=batch.num_rows)))
        text = np.concatenate([sides[0][0], sides[1][0]])
        code = np.concatenate([sides[0][1], sides[1][1]])
        order = np.lexsort((code, text))
        both = (code[order][1:] == code[order][:-1]) & (text[order][1:] == text[order][:-1])
        shared = np.bincount(text[order][1:][both], minlength=batch.num_rows)
        union = sides[0][2] + sides[1][2] - shared
        yield batch.filter(pa.array(100 * shared >= SIMILAR_PERCENT * union)).select(["a", "b"])


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")


def _link_rest(group: pa.Table) -> pa.Table:
    """Links between a block of strays and a block of members that join what is not joined yet.

    Members that the leader is linked with count as joined from the start.
    """
    start_in_worker("near_dups")
    strays = group.filter(group["side"])
    members = group.filter(pc.invert(group["side"]))
    text, code = shingle_sets(find_words(members["text"].combine_chunks(), SPACED, lower=True))
    n_members = np.bincount(text, minlength=members.num_rows)
    order = np.argsort(code, kind="stable")
    code, text = code[order], text[order]
    asked, shingle = shingle_sets(find_words(strays["text"].combine_chunks(), SPACED, lower=True))
    n_strays = np.bincount(asked, minlength=strays.num_rows)
    first = np.concatenate([[0], np.cumsum(n_strays)])
    lo, hi = np.searchsorted(code, shingle, "left"), np.searchsorted(code, shingle, "right")
    ids = members["doc_id"].to_pylist()
    root = {d: None if joined else d for d, joined in zip(ids, members["joined"].to_pylist(), strict=True)}

    def find(x: int | None) -> int | None:
        while x is not None and root.get(x, x) != x:
            x = root[x]
        return x

    found: dict[str, list[int]] = {"a": [], "b": []}
    for k, stray in enumerate(strays["doc_id"].to_pylist()):
        own = slice(first[k], first[k + 1])
        shared = np.bincount(text[ranges(lo[own], (hi - lo)[own])], minlength=len(ids))
        similar = 100 * shared >= SIMILAR_PERCENT * (n_strays[k] + n_members - shared)
        for at in np.flatnonzero(similar).tolist():
            x, y = find(stray), find(ids[at])
            if x != y:
                if x is None:
                    x, y = y, x
                root[x] = y
                found["a"].append(stray)
                found["b"].append(ids[at])
    return pa.table(found, pa.schema([("a", pa.int64()), ("b", pa.int64())]))


def _in_blocks(groups: DataFrame, texts: DataFrame, block: int) -> DataFrame:
    """Rows of every comparison still to be made: blocks of strays against blocks of members.

    `groups` has leader, doc_id, n_shingles and joined. A group is cut by hash
    into blocks of about `block` shingles, on either side.
    """
    stray = ~F.col("joined")
    sizes = groups.groupBy("leader").agg(
        F.ceil(F.sum("n_shingles") / block).cast("int").alias("blocks"),
        F.ceil(F.sum(F.when(stray, F.col("n_shingles"))) / block).cast("int").alias("stray_blocks"),
        F.count(F.lit(1)).alias("n"),
    )
    rows = groups.join(sizes.where("stray_blocks > 0 and n > 2"), "leader").join(texts, "doc_id")
    part = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["leader", "doc_id", "joined", "text"]
    asking = rows.where(stray).select(*columns, F.lit(True).alias("side"), part("stray_blocks").alias("x"), every("blocks").alias("y"))
    asked = rows.select(*columns, F.lit(False).alias("side"), every("stray_blocks").alias("x"), part("blocks").alias("y"))
    return asking.unionByName(asked)


def find_links(sets: DataFrame, texts: DataFrame, block: int = BLOCK_SHINGLES) -> DataFrame:
    """Verified links (a, b) that join the same documents as all links inside buckets would.

    `sets` has doc_id, n_shingles and bands of one document per class, `texts`
    their doc_id and text. A bucket's leader is the member that shares most
    buckets, which in a group of edited copies tends to be the original.
    """
    with scratch_folder(sets.sparkSession, "links") as stored:  # buckets and texts go when the links are known
        return written(_links(sets, texts, block, stored), "edges")


def _links(sets: DataFrame, texts: DataFrame, block: int, stored: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """What `find_links` returns, read from tables that `stored` wrote."""
    buckets = sets.select("doc_id", "n_shingles", F.explode("bands").alias("key"))
    counts = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(buckets.join(counts, "key"), "buckets")
    mates = members.groupBy("doc_id", "n_shingles").agg(F.sum("n").alias("mates"))
    ranked = members.select("key", "doc_id").join(mates, "doc_id")
    best = F.max(F.struct("mates", (-F.col("doc_id")).alias("rank"), F.col("n_shingles").alias("n_leader"))).alias("best")
    leaders = ranked.groupBy("key").agg(best)
    groups = members.join(leaders, "key").select(
        (-F.col("best.rank")).alias("leader"), F.col("best.n_leader").alias("n_leader"), "doc_id", "n_shingles"
    )
    groups = stored(groups.distinct(), "groups")
    texts = stored(texts.join(mates.select("doc_id"), "doc_id", "left_semi"), "candidate_texts")
    # Sets whose sizes differ more than this cannot be similar enough.
    fits = f"100 * least(n_leader, n_shingles) >= {SIMILAR_PERCENT} * greatest(n_leader, n_shingles)"
    pairs = groups.where("doc_id != leader").where(fits).select(F.col("leader").alias("a"), F.col("doc_id").alias("b"))
    links = stored(_with_texts(pairs, texts).mapInArrow(_verify, "a bigint, b bigint"), "links")
    linked = links.select(F.col("a").alias("leader"), F.col("b").alias("doc_id"), F.lit(True).alias("linked"))
    marked = groups.join(linked, ["leader", "doc_id"], "left")
    marked = marked.withColumn("joined", F.col("linked").isNotNull() | (F.col("doc_id") == F.col("leader")))
    rest = _in_blocks(marked, texts, block).groupBy("leader", "x", "y").applyInArrow(_link_rest, "a bigint, b bigint")
    return links.unionByName(rest)


def near_duplicates(docs: DataFrame, stored: Callable[[DataFrame, str], DataFrame] = written) -> DataFrame:
    """Component of every row of `docs` (doc_id, text).

    Returns doc_id, n_shingles, component_id (smallest doc_id that verified links
    reach) and kept (doc_id = component_id).

    Defined cases: NULL and empty texts have no shingles and no links; shorter
    texts than a shingle have one; rows with a NULL id have no links, a NULL
    component, and are kept; rows that share an id count as one document, so a
    row repeated in full is kept as often as it stands there; an empty table
    gives an empty result; other columns are not read. The result reads tables
    that `stored` wrote.
    """
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(slim.mapInArrow(_sign, _SIGNED), "signatures")
    same_set = ["set_a", "set_b", "n_shingles"]
    linked = signed.where("n_shingles > 0 and doc_id is not null")
    classes = stored(
        linked.groupBy(*same_set).agg(F.min("doc_id").alias("head"), F.first("bands").alias("bands")), "classes"
    )
    heads = classes.select(F.col("head").alias("doc_id"), "n_shingles", "bands")
    labels = connected(find_links(heads, slim))
    named = classes.join(labels, classes["head"] == labels["node"], "left").select(
        *same_set, F.coalesce("label", "head").alias("component")
    )
    rows = signed.select("doc_id", *same_set).join(named, same_set, "left")
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component"))
    return rows.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of one document of each group, with all their columns."""
    with scratch_folder(docs.sparkSession, "signed") as stored:
        found = near_duplicates(docs, stored)
        extra = written(found.where(~F.col("kept")).select(F.col("doc_id").alias("_copy")).distinct(), "copies")
    return docs.join(extra, docs["doc_id"].cast("bigint") == extra["_copy"], "left_anti")
