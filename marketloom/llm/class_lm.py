"""Brown class-based n-grams: classes by exchange, class transitions, word emissions.

Texts are cut into blocks, and a block is stored as one row: the numbers of its
words and a dictionary of them, so later passes read numbers and not texts. Word
counts of the corpus are sums over the dictionaries, and come back to a block by
a join on its distinct words.

Words with at least one FREQUENT-th of all training tokens, which are FREQUENT
words at most, are put into CLASSES classes by exchange: each round counts which
classes stand before and after every such word and moves a word to the class
that raises the likelihood of the class bigrams most. Words move in two halves,
by turns; a task starts from the counts of the round and keeps up its own moves. All rarer words belong to the
class of their shape. A text's probability is that of its class trigrams
(Witten-Bell smoothing) times that of each word in its class.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.llm.words import SPACED, find_words, ranges, release_memory, slices
from marketloom.scratch import scratch_folder, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Documents whose checksum leaves this remainder are held out.
FOLDS, HELD_FOLD = 7, 2
CLASSES = 64
FREQUENT = 1 << 16
# Times that class contexts are counted; words move after all but the last.
ROUNDS = 4
# Tasks in which words move side by side.
EXCHANGE_TASKS = 8
# Text of one block.
_BLOCK = 4 << 20
# Classes by shape: without letters and digits, digits alone, digits and letters, then words by last letter and end sign.
_LAST_LETTERS = 8
SHAPES = 3 + 2 * _LAST_LETTERS
ALL_CLASSES = CLASSES + SHAPES + 1
END = ALL_CLASSES - 1
_BLOCKS = (
    "block bigint, doc_ids array<bigint>, held array<boolean>, sizes array<int>, ids binary,"
    " words array<string>, codes array<bigint>, shapes array<int>, train array<bigint>"
)
_SCORED = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint,"
    " base_score double, score double"
)


def _kinds() -> np.ndarray:
    """Kind of each byte: 0 sign, 1 digit, 2 letter or part of a character beyond ASCII."""
    kind = np.zeros(256, np.uint8)
    kind[ord("0") : ord("9") + 1] = 1
    kind[ord("a") : ord("z") + 1] = 2
    kind[ord("A") : ord("Z") + 1] = 2
    kind[0x80:] = 2
    return kind


_KIND = _kinds()


def shapes_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Shape class of each word, from 0 to SHAPES - 1."""
    if not len(starts):
        return np.zeros(0, np.int64)
    kind = _KIND[data]

    def any_of(value: int) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(kind == value)])
        return total[ends] > total[starts]

    digits, letters = any_of(1), any_of(2)
    last = np.maximum.accumulate(np.where(kind == 2, np.arange(len(data)), 0))[ends - 1]
    spelled = 3 + 2 * (data[last].astype(np.int64) % _LAST_LETTERS) + (kind[ends - 1] == 0)
    return np.where(letters, np.where(digits, 2, spelled), np.where(digits, 1, 0))


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block; every text ends with the number that follows the block's words."""
    block = TaskContext.get().partitionId() << 32
    for batch in slices(batches, limit=_BLOCK):
        words = find_words(batch.column("text"), SPACED, lower=True)
        codes, at, local = np.unique(words.codes, return_index=True, return_inverse=True)
        held = batch.column("held").to_numpy(zero_copy_only=False)
        n_words = np.diff(words.first)
        trained = np.repeat(~held, n_words)
        counts = np.bincount(local[trained], minlength=len(codes))
        texts = np.arange(len(held))
        seq = np.full(len(local) + len(held), len(codes), np.int64)
        seq[np.arange(len(local)) + np.repeat(texts, n_words)] = local
        seq = seq.astype(np.uint16 if len(codes) < 1 << 16 else np.int32)
        sizes = (words.ends - words.starts)[at]
        data = words.data[ranges(words.starts[at], sizes)].tobytes()
        ends = np.cumsum(sizes)
        spelled = [data[b - n : b] for b, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
        columns = [
            pa.array([block]),
            pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
            pa.array([held], pa.list_(pa.bool_())),
            pa.array([(n_words + 1).astype(np.int32)], pa.list_(pa.int32())),
            pa.array([seq.tobytes()], pa.binary()),
            pa.ListArray.from_arrays([0, len(codes)], pa.array(spelled, pa.binary()).cast(pa.string())),
            pa.array([codes.view(np.int64)], pa.list_(pa.int64())),
            pa.array([shapes_of(words.data, words.starts[at], words.ends[at]).astype(np.int32)], pa.list_(pa.int32())),
            pa.array([counts], pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _BLOCKS.split(", ")])
        block += 1


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _numbers(raw: pa.Buffer, sizes: np.ndarray) -> np.ndarray:
    """Token numbers of a block, stored in two or four bytes each."""
    return np.frombuffer(raw, np.uint16 if raw.size == 2 * sizes.sum() else np.int32)


@dataclass
class Block:
    """One row of the stored blocks: the token numbers, the texts' sizes, and which tokens are for training."""

    seq: np.ndarray
    sizes: np.ndarray
    trained: np.ndarray
    codes: np.ndarray
    shapes: np.ndarray

    @classmethod
    def of(cls, row: pa.RecordBatch) -> Block:
        sizes = _flat(row.column("sizes")).astype(np.int64)
        raw = row.column("ids")[0].as_buffer()
        trained = np.repeat(~_flat(row.column("held")).astype(bool), sizes)
        return cls(_numbers(raw, sizes), sizes, trained, _flat(row.column("codes")), _flat(row.column("shapes")))

    def word_units(self, frequent: np.ndarray) -> np.ndarray:
        """Unit of every word of the block: a frequent word, else a shape; then that of the end."""
        place = np.minimum(np.searchsorted(frequent, self.codes), max(len(frequent) - 1, 0))
        known = frequent[place] == self.codes if len(frequent) else np.zeros(len(self.codes), bool)
        of_word = np.where(known, place, len(frequent) + self.shapes)
        return np.append(of_word, len(frequent) + SHAPES)

    def units(self, frequent: np.ndarray) -> np.ndarray:
        """Unit of every token."""
        return self.word_units(frequent)[self.seq]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1)
    release_memory()


def _before(values: np.ndarray, first: int) -> np.ndarray:
    """The value before each one; every text ends with the end sign, so that stands before the next text."""
    return np.append(np.array([first], values.dtype), values[:-1])


def classes_of_units(moved: np.ndarray) -> np.ndarray:
    """Class of every unit: that of the frequent words, then the shapes, then the end."""
    return np.concatenate([moved, np.arange(CLASSES, ALL_CLASSES)]).astype(np.int64)


_RIGHT = [f"r{k}" for k in range(ALL_CLASSES)]
_LEFT = [f"l{k}" for k in range(ALL_CLASSES)]
_CONTEXTS = ", ".join(["unit int", "class int", "twice bigint", *[f"{c} bigint" for c in _RIGHT + _LEFT]])


def _count_contexts(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Classes after and before every unit of a task's blocks; the counters have a fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, moved = shared.value
        of_unit = classes_of_units(moved)
        n_units = len(of_unit)
        cells = n_units * ALL_CLASSES
        right, left, twice = np.zeros(cells, np.int64), np.zeros(cells, np.int64), np.zeros(n_units, np.int64)
        for row in _rows(batches):
            block = Block.of(row)
            unit = block.units(frequent)
            before = _before(unit, n_units - 1)
            unit, before = unit[block.trained], before[block.trained]
            right += np.bincount(before * ALL_CLASSES + of_unit[unit], minlength=cells)
            left += np.bincount(unit * ALL_CLASSES + of_unit[before], minlength=cells)
            twice += np.bincount(unit[unit == before], minlength=n_units)
        right, left = right.reshape(n_units, -1), left.reshape(n_units, -1)
        some = np.flatnonzero(right.any(1) | left.any(1))
        for at in range(0, len(some), 4096):
            part = some[at : at + 4096]
            columns = [pa.array(part.astype(np.int32)), pa.array(of_unit[part].astype(np.int32)), pa.array(twice[part])]
            columns += [pa.array(np.ascontiguousarray(x)) for x in (*right[part].T, *left[part].T)]
            yield pa.RecordBatch.from_arrays(columns, ["unit", "class", "twice", *_RIGHT, *_LEFT])

    return count


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(pairs: np.ndarray) -> float:
    """Log likelihood of the class bigrams, up to what does not depend on the classes."""
    return float(_xlogx(pairs).sum() - _xlogx(pairs.sum(0)).sum() - _xlogx(pairs.sum(1)).sum())


def best_class(right: np.ndarray, left: np.ndarray, twice: float, own: int, pairs: np.ndarray) -> int:
    """The class in which a word makes the class bigrams most likely; its own one among equals.

    `right` and `left` count the classes after and before the word, `twice` how
    often it follows itself, and `pairs` the class bigrams with the word in `own`.
    """
    n_after, n_before = right.sum(), left.sum()
    right, left = right.copy(), left.copy()
    right[own] -= twice
    left[own] -= twice
    rest = pairs.copy()
    rest[own] -= right
    rest[:, own] -= left
    rest[own, own] -= twice
    sum_after, sum_before = pairs.sum(1)[:CLASSES], pairs.sum(0)[:CLASSES]
    sum_after[own] -= n_after
    sum_before[own] -= n_before
    at = np.arange(CLASSES)

    def gained(table: np.ndarray, more: np.ndarray) -> np.ndarray:
        """Gain of adding `more` to each class's row, without the cell of the class with itself."""
        some = np.flatnonzero(more)
        gain = _xlogx(table[:CLASSES, some] + more[some]) - _xlogx(table[:CLASSES, some])
        inner = np.flatnonzero(some < CLASSES)
        gain[some[inner], inner] = 0.0
        return gain.sum(1)

    itself = rest[at, at]
    gain = gained(rest, right) + gained(rest.T, left)
    gain += _xlogx(itself + right[:CLASSES] + left[:CLASSES] + twice) - _xlogx(itself)
    gain -= _xlogx(sum_after + n_after) - _xlogx(sum_after)
    gain -= _xlogx(sum_before + n_before) - _xlogx(sum_before)
    best = int(np.argmax(gain))
    return best if gain[best] > gain[own] + 1e-9 else own


def shift(pairs: np.ndarray, right: np.ndarray, left: np.ndarray, twice: float, a: int, b: int) -> None:
    """Move a word from class a to class b in the class bigrams."""
    right, left = right.copy(), left.copy()
    right[a] -= twice
    left[a] -= twice
    pairs[a] -= right
    pairs[:, a] -= left
    pairs[a, a] -= twice
    pairs[b] += right
    pairs[:, b] += left
    pairs[b, b] += twice


def _exchange(pairs: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """New classes of words, one after the other; a task sees its own moves in the class bigrams."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = pairs.copy()
        for batch in batches:
            unit, own, twice = (batch.column(c).to_numpy() for c in ("unit", "class", "twice"))
            right, left = (np.column_stack([batch.column(c).to_numpy() for c in side]).astype(float) for side in (_RIGHT, _LEFT))
            new = own.copy()
            for k in range(batch.num_rows):
                a, b = int(own[k]), best_class(right[k], left[k], float(twice[k]), int(own[k]), now)
                if a != b:
                    shift(now, right[k], left[k], float(twice[k]), a, b)
                    new[k] = b
            yield pa.RecordBatch.from_arrays([pa.array(unit), pa.array(new)], ["unit", "class"])

    return move


def cluster(blocks: DataFrame, frequent: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, list[float]]:
    """Class of every frequent word (codes in order, with their counts), and the likelihood of each round.

    At most FREQUENT classes and ALL_CLASSES squared counts reach the driver.
    """
    spark = blocks.sparkSession
    moved = np.empty(len(frequent), np.int64)
    moved[np.lexsort((frequent, -counts))] = np.arange(len(frequent)) % CLASSES
    best, seen = moved, []
    slim = blocks.select("held", "sizes", "ids", "codes", "shapes")
    sums = [F.sum(c).alias(c) for c in ["twice", *_RIGHT, *_LEFT]]
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((frequent, moved))
        counted = slim.mapInArrow(_count_contexts(shared), _CONTEXTS).groupBy("unit", "class").agg(*sums)
        with scratch_folder(spark, "contexts") as keep:
            contexts = keep(counted, "contexts")
            pairs = np.zeros((ALL_CLASSES, ALL_CLASSES))
            for row in contexts.groupBy("class").agg(*[F.sum(c).alias(c) for c in _RIGHT]).collect():
                pairs[row["class"]] = row[1:]
            seen.append(likelihood(pairs))
            if seen[-1] >= max(seen):
                best = moved
            if turn + 1 == rounds:
                break
            movable = contexts.where((F.col("unit") < len(frequent)) & (F.col("unit") % 2 == turn % 2))
            moves = movable.repartition(EXCHANGE_TASKS, "unit").mapInArrow(_exchange(pairs), "unit int, class int").collect()
        moved = moved.copy()
        for row in moves:
            moved[row["unit"]] = row["class"]
    return best, seen


def _count_trigrams(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, moved = shared.value
        of_unit = classes_of_units(moved)
        total = np.zeros(ALL_CLASSES**3, np.int64)
        for row in _rows(batches):
            block = Block.of(row)
            codes = _trigrams(of_unit[block.units(frequent)], block.sizes)
            total += np.bincount(codes[block.trained], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["code", "n"])

    return count


def _trigrams(classes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Class trigram that ends at every token; end signs stand before a text."""
    one = _before(classes, END)
    two = _before(one, END)
    two[np.cumsum(sizes) - sizes] = END
    return (two * ALL_CLASSES + one) * ALL_CLASSES + classes


def witten_bell(trigrams: np.ndarray) -> np.ndarray:
    """Probability of each class after every two classes, from a cube of counts."""
    lower = np.full((1, ALL_CLASSES), 1.0 / ALL_CLASSES)
    for counts in (trigrams.sum((0, 1))[None], trigrams.sum(0), trigrams.reshape(-1, ALL_CLASSES)):
        kinds = (counts > 0).sum(1, keepdims=True)
        total = counts.sum(1, keepdims=True)
        lower = np.tile(lower, (len(counts) // len(lower), 1))
        smoothed = (counts + kinds * lower) / np.maximum(total + kinds, 1)
        lower = np.where(total > 0, smoothed, lower)
    return lower


@dataclass
class Model:
    """What scoring needs beside a block's word counts; its size does not depend on the corpus."""

    frequent: np.ndarray
    moved: np.ndarray
    log_next: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    n_tokens: int
    n_words: int
    n_ends: int

    def emission(self, counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """log10 probability of words with these counts in their classes; a shape has as many unseen words as seen ones."""
        kinds = np.maximum(self.class_words[classes], 1)
        below = self.class_tokens[classes] + np.where(classes < CLASSES, 0, kinds)
        return np.log10(np.maximum(counts, 1) / np.maximum(below, 1))

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1.0) / (self.n_tokens + self.n_words + 1.0))


_CLASSED = "block bigint, doc_ids array<bigint>, held array<boolean>, sizes array<int>, ids binary, classes binary"


def _classes(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks with the class of each of their words, and of the end, in place of what it follows from."""

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        of_unit = classes_of_units(model.moved).astype(np.uint8)
        for row in _rows(batches):
            found = pa.array([of_unit[Block.of(row).word_units(model.frequent)].tobytes()], pa.binary())
            kept = ["block", "doc_ids", "held", "sizes", "ids"]
            yield pa.RecordBatch.from_arrays([*[row.column(c) for c in kept], found], [*kept, "classes"])

    return classes


def _score(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        for row in _rows(batches):
            sizes = _flat(row.column("sizes")).astype(np.int64)
            seq = _numbers(row.column("ids")[0].as_buffer(), sizes)
            counts = np.append(_flat(row.column("counts")), model.n_ends).astype(np.int64)
            classes = np.frombuffer(row.column("classes")[0].as_buffer(), np.uint8).astype(np.int64)
            emitted = model.emission(counts, classes)
            emitted[-1] = 0.0
            starts = np.cumsum(sizes) - sizes
            got = model.log_next[_trigrams(classes[seq], sizes)] + emitted[seq]
            columns = [
                row.column("doc_ids").flatten(),
                row.column("held").flatten(),
                pa.array(sizes),
                pa.array(np.add.reduceat((counts > 0)[seq].astype(np.int64), starts)),
                pa.array(np.full(len(starts), model.n_tokens, np.int64)),
                pa.array(np.add.reduceat(model.base(counts)[seq], starts)),
                pa.array(np.add.reduceat(got, starts)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SCORED.split(", ")])

    return score


def encode_blocks(docs: DataFrame) -> DataFrame:
    """Stored blocks of the rows of `docs` (doc_id, text)."""
    number = F.col("doc_id").cast("bigint")
    fold = F.crc32(number.cast("string").cast("binary")) % FOLDS
    slim = docs.select(
        number.alias("doc_id"),
        F.coalesce(fold == HELD_FOLD, F.lit(False)).alias("held"),
        F.col("text").cast("string").alias("text"),
    )
    return written(slim.mapInArrow(_encode, _BLOCKS), "token_blocks")


def count_words(blocks: DataFrame) -> DataFrame:
    """Every entry of every block's dictionary (block, place, shape) with the word's training count `n`.

    A word is spelled out in its first entry only. It has at most one entry per
    block, so its entries are a small part of all.
    """
    entry = F.posexplode(F.arrays_zip("words", "shapes", "train")).alias("place", "entry")
    entries = blocks.select("block", entry).select("block", "place", "entry.*")
    of_word = Window.partitionBy("words").orderBy("block")
    every = of_word.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = entries.withColumns({"n": F.sum("train").over(every), "first": F.row_number().over(of_word) == 1})
    spelled = F.when(F.col("first") & (F.col("n") > 0), F.col("words")).alias("word")
    return written(counted.select("block", "place", F.col("shapes").alias("shape"), "n", spelled), "word_entries")


def _codes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = find_words(batch.column("word"), SPACED).codes.view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(codes), batch.column("n")], ["code", "n"])


def fit(blocks: DataFrame, entries: DataFrame, rounds: int = ROUNDS) -> tuple[Model, list[float]]:
    """The model of stored blocks and their word counts, and the likelihood of each round."""
    spark: SparkSession = blocks.sparkSession
    words = entries.where("word is not null").select("word", "shape", "n")
    found = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    trained = F.size(F.filter("held", lambda held: ~held))
    n_ends = blocks.agg(F.sum(trained).alias("n")).first()["n"] or 0
    n_tokens, n_words = (found["n"] or 0) + n_ends, found["v"] + (n_ends > 0)

    often = F.col("n").cast("decimal(38,0)") * FREQUENT >= n_tokens
    rows = words.where(often).select("word", "n").mapInArrow(_codes_of, "code bigint, n bigint").collect()  # FREQUENT at most
    pairs = np.array([tuple(r) for r in rows], np.int64).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0])]
    frequent, counts = np.ascontiguousarray(pairs[:, 0]), pairs[:, 1]
    moved, seen = cluster(blocks, frequent, counts, rounds)

    shared = spark.sparkContext.broadcast((frequent, moved))
    slim = blocks.select("held", "sizes", "ids", "codes", "shapes")
    cube = np.zeros(ALL_CLASSES**3)
    for row in slim.mapInArrow(_count_trigrams(shared), "code int, n bigint").groupBy("code").agg(F.sum("n")).toLocalIterator():
        cube[row[0]] = row[1]
    cube = cube.reshape((ALL_CLASSES,) * 3)
    class_words = np.zeros(ALL_CLASSES, np.int64)
    for row in words.where(~often).groupBy("shape").agg(F.count(F.lit(1)).alias("n")).collect():  # SHAPES rows
        class_words[CLASSES + row["shape"]] = row["n"]
    log_next = np.log10(witten_bell(cube)).ravel()
    return Model(frequent, moved, log_next, cube.sum((0, 1)), class_words, n_tokens, n_words, n_ends), seen


def score_texts(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Score of every row of `docs` (doc_id, text) under a model of those not held out.

    Returns doc_id, held_out, n_tokens (words and one end), n_known (tokens that
    stand in training texts), train_tokens, base_score (add-one unigrams) and
    score, both log10 probabilities of the text.

    Defined cases: NULL and empty texts consist of their end alone; a NULL doc_id
    is not held out; repeated rows count and are scored each; without training
    texts every class is as likely as any other and nothing is known; an empty
    table gives an empty result; other columns are not read. Words are told apart
    by 64-bit codes inside a block, and by themselves everywhere else.
    """
    blocks = encode_blocks(docs)
    entries = count_words(blocks)
    model, _ = fit(blocks, entries, rounds)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    entry = F.struct("place", "n")
    per_block = entries.groupBy("block").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    per_block = per_block.select("block", F.col("entries.n").alias("counts"))
    classed = blocks.select("block", "doc_ids", "held", "sizes", "ids", "codes", "shapes").mapInArrow(_classes(shared), _CLASSED)
    empty = F.array().cast("array<bigint>")  # blocks without any word
    full = classed.join(per_block, "block", "left").withColumn("counts", F.coalesce("counts", empty))
    return full.mapInArrow(_score(shared), _SCORED)
