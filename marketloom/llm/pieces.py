"""SentencePiece encoding with N-best segmentations, and exact decoding.

A text is a lattice whose edges are the pieces of a public model. Pieces never
go on from a word into the next run of spaces, so the lattice of a text is a
chain of small ones, one per word. Distinct words of a batch that the worker
does not know yet are handled at once: a forward Viterbi pass gives every place its best score from the start of
the word. The N best segmentations of a word come from an A* search backward
from its end, for which the forward scores are exact heuristics, so it expands
nothing in vain. The N best of the whole text combine those of the few words
whose second choice costs least.

Scores are the model's own for unigram models. A BPE model has merge ranks
instead; there the score is the log probability of a rank under Zipf's law.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.words import column_bytes, mix, power_tables, ranges, slices, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4
# Text that is cut into words at one time.
_SLICE = 1 << 20
# Bytes of new words whose lattices are built at one time: some 150 MB.
_LATTICE = 1 << 18
# Words, and pieces of words, that a worker remembers at most.
_KNOWN_WORDS, _KNOWN_PIECES, _KNOWN_RANKED = 1 << 18, 1 << 21, 1 << 12
# Bytes of the longest word whose best segmentations are remembered.
_SHORT = 64
# Leading bits of a code that are looked up before the code itself.
_HEAD_BITS = 18
# Score of a byte of a character without a piece, below the least piece.
BYTE_COST = 2.0
_ENCODED = (
    "doc_id bigint, ids array<int>, score double,"
    " others array<struct<score: double, words: array<int>, pieces: array<array<int>>>>"
)
_SPACE, _LINE = 0x20, 0x0A
_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))


def _prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums s and factors f such that (s[b] - s[a]) * f[a] is a code of bytes a to b, wherever they stand."""
    power, inverse = power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE_CODES[data] * power[: len(data)], out=total[1:])
    return total, inverse


def read_model(path: str) -> dict:
    """Pieces of a model file as plain arrays; the sign for a space becomes a space.

    `cut` tells whether a line end stands in no piece, so that it can end a word.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    byte_ids, texts, ids, scores = [-1] * 256, [], [], []
    ranked = min(model.get_score(i) for i in range(model.get_piece_size())) < -100
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            piece = model.id_to_piece(i).replace("▁", " ")
            if " " in piece.lstrip(" "):
                raise ValueError(f"piece {i} goes on after a space")
            texts.append(piece.encode())
            ids.append(i)
            scores.append(-np.log(2.0 - model.get_score(i)) if ranked else model.get_score(i))
    if min(byte_ids) < 0:
        raise ValueError("the model has no byte pieces, so some texts could not be restored")
    return {
        "texts": texts, "ids": np.array(ids), "scores": np.array(scores), "byte_ids": np.array(byte_ids),
        "size": model.get_piece_size(), "cut": not any(b"\n" in t for t in texts),
    }


def _head(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(64 - _HEAD_BITS)).astype(np.int64)


class _Vocabulary:
    """Pieces by byte length, as sorted hashes."""

    def __init__(self, model: dict) -> None:
        self.byte_ids, self.cut = model["byte_ids"], model["cut"]
        self.fallback = float(model["scores"].min()) - BYTE_COST
        sizes = np.array([len(t) for t in model["texts"]])
        self.by_size = []
        for size in np.unique(sizes):
            own = np.flatnonzero(sizes == size)
            total, inverse = _prefix_sums(np.frombuffer(b"".join(model["texts"][k] for k in own), np.uint8))
            at = np.arange(len(own)) * size
            with np.errstate(over="ignore"):
                codes = (total[at + size] - total[at]) * inverse[at]
            order = np.argsort(codes)
            heads = np.zeros(1 << _HEAD_BITS, bool)
            heads[_head(codes)] = True
            self.by_size.append((int(size), heads, codes[order], model["ids"][own][order], model["scores"][own][order]))
        # For decoding: the bytes of every id.
        texts = [b""] * model["size"]
        for i, text in zip(model["ids"], model["texts"], strict=True):
            texts[i] = text
        for value, i in enumerate(model["byte_ids"]):
            texts[i] = bytes([value])
        self.id_sizes = np.array([len(t) for t in texts])
        self.id_starts = np.concatenate([[0], np.cumsum(self.id_sizes)[:-1]])
        self.id_bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.known = _Known.nothing()
        self.ranked: dict[tuple[int, int], list[tuple[float, list[int]]]] = {}


def _vocabulary(shared, key: str) -> _Vocabulary:
    cache = worker_cache("pieces")
    if cache.get("pieces_key") != key:
        cache["pieces"], cache["pieces_key"] = _Vocabulary(shared.value), key
    return cache["pieces"]


def _with_prefix(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every text with a space before it, as the models have it; empty texts stay empty."""
    sizes = np.diff(bounds)
    extra = (sizes > 0).astype(np.int64)
    new = np.concatenate([[0], np.cumsum(sizes + extra)])
    out = np.full(int(new[-1]), _SPACE, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.cumsum(extra), sizes)] = data
    return out, new


def _split(data: np.ndarray, bounds: np.ndarray, cut: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts of words in the bytes, with the end appended, and each word's 64-bit code.

    A word is a run of spaces and what follows up to the next one; a line end is a word.
    """
    n = len(data)
    space, line = data == _SPACE, data == _LINE
    begin = np.zeros(n + 1, bool)
    begin[1:n] = space[1:] & ~space[:-1]
    if cut:
        begin[1:n] |= line[1:] | line[:-1]
    begin[bounds] = True
    begin[n] = True
    starts = np.flatnonzero(begin)
    total, inverse = _prefix_sums(data)
    with np.errstate(over="ignore"):
        codes = mix((total[starts[1:]] - total[starts[:-1]]) * inverse[starts[:-1]] + np.diff(starts).astype(np.uint64))
    return starts, codes


class _Lattice:
    """Edges, forward scores and best paths of many words.

    Word w's bytes are data[first[w] : first[w + 1]] and its nodes start at
    first[w] + w, one more than it has bytes.
    """

    def __init__(self, data: np.ndarray, first: np.ndarray, vocabulary: _Vocabulary) -> None:
        n, sizes = len(data), np.diff(first)
        word = np.repeat(np.arange(len(sizes)), sizes)
        left = np.repeat(first[1:], sizes) - np.arange(n)
        total, inverse = _prefix_sums(data)
        lead = (data & 0xC0) != 0x80
        width = np.where(data < 0x80, 1, np.where(data < 0xE0, 2, np.where(data < 0xF0, 3, 4)))
        single = np.zeros(n, bool)
        found = []
        for size, heads, codes, ids, scores in vocabulary.by_size:
            at = np.flatnonzero(lead & (left >= size))
            with np.errstate(over="ignore"):
                asked = (total[at + size] - total[at]) * inverse[at]
            likely = heads[_head(asked)]
            at, asked = at[likely], asked[likely]
            place = np.minimum(np.searchsorted(codes, asked), len(codes) - 1)
            hit = codes[place] == asked
            at, place = at[hit], place[hit]
            single[at[width[at] == size]] = True
            found.append((at, np.full(len(at), size), ids[place], scores[place]))
        at = np.flatnonzero(lead & ~single)
        found.append((at, width[at], np.full(len(at), -1), vocabulary.fallback * width[at]))
        begin, size, self.ids, self.scores = (np.concatenate(x) for x in zip(*found, strict=True))
        # By end and then longest first: the first of equal scores is the longest piece.
        # Each size is a rising run already, which a stable sort makes use of.
        order = np.argsort((begin + size) * (int(size.max(initial=0)) + 1) - size, kind="stable")
        begin, size = begin[order], size[order]
        self.ids, self.scores = self.ids[order], self.scores[order]
        self.word = word[begin]
        self.start = begin + self.word
        self.end = self.start + size
        self.data, self.first, self.byte_ids = data, first, vocabulary.byte_ids
        self.n_nodes = n + len(sizes)
        self.root = first[:-1] + np.arange(len(sizes))
        self.leaf = first[1:] + np.arange(len(sizes))
        self._pass()

    def _pass(self) -> None:
        """Forward scores, best paths, and what the cheapest other choice in each word costs.

        A node that no edge goes over ends one section and starts the next one.
        Sections are independent, so their depth alone bounds the number of steps.
        """
        nodes = np.arange(self.n_nodes)
        step = np.zeros(self.n_nodes + 1, np.int64)
        np.add.at(step, self.start + 1, 1)
        np.add.at(step, self.end, -1)
        self.whole = np.cumsum(step)[: self.n_nodes] == 0
        opens = np.maximum.accumulate(np.where(self.whole, nodes, 0))
        closes = np.minimum.accumulate(np.where(self.whole, nodes, self.n_nodes)[::-1])[::-1]
        ahead = self._best(self.start, self.end, self.start - opens[self.start])
        behind = self._best(self.end, self.start, closes[self.end] - self.end)
        so_far = np.where(self.whole, 0.0, ahead)[self.start] + self.scores
        to_go = np.where(self.whole, 0.0, behind)[self.end]
        loss = ahead[closes[self.end]] - so_far - to_go
        # Forward scores from the start of the word: whole sections before, and the part of this one.
        base = np.cumsum(np.where(self.whole & np.isfinite(ahead), ahead, 0.0))
        sizes = self.leaf - self.root + 1
        self.forward = np.where(self.whole, base, base[opens] + ahead) - np.repeat(base[self.root], sizes)
        # Best edge into each node: the first in order, which is the longest.
        into = np.full(self.n_nodes, -1)
        best = np.flatnonzero(so_far == ahead[self.end])[::-1]
        into[self.end[best]] = best
        at, node, found = np.arange(len(self.leaf)), self.leaf, []
        while len(at):
            edge = into[node]
            found.append(edge)
            node = self.start[edge]
            more = node > self.root[at]
            at, node = at[more], node[more]
        path = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)  # in order of word and end
        # Summed piece by piece, so that it does not depend on the words around.
        self.best = np.bincount(self.word[path], weights=self.scores[path], minlength=len(self.leaf))
        fallback = self.ids[path] < 0
        count = np.where(fallback, self.end[path] - self.start[path], 1)
        self.path_ids = np.repeat(self.ids[path], count)
        places = ranges((self.start - self.word)[path[fallback]], count[fallback])
        self.path_ids[np.repeat(fallback, count)] = self.byte_ids[self.data[places]]
        self.path_count = np.bincount(self.word[path], weights=count, minlength=len(self.leaf)).astype(np.int64)
        self.path_first = np.cumsum(self.path_count) - self.path_count
        other = np.ones(len(self.start), bool)
        other[path] = False
        self.gap = np.full(len(self.leaf), np.inf)
        np.minimum.at(self.gap, self.word[other], np.maximum(0.0, loss[other]))

    def _best(self, source: np.ndarray, target: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Best score of each node inside its section, passed from source to target by rising depth."""
        score = np.full(self.n_nodes, -np.inf)
        small = depth.max(initial=0) < 1 << 16
        order = np.argsort(depth.astype(np.uint16) if small else depth, kind="stable")
        source, target, gain = source[order], target[order], self.scores[order]
        bounds = np.searchsorted(depth[order], np.arange(int(depth.max(initial=-1)) + 2))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            here = source[a:b]
            np.maximum.at(score, target[a:b], np.where(self.whole[here], 0.0, score[here]) + gain[a:b])
        return score

    def n_best(self, word: int, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a word, best first: (score, ids)."""
        lo, hi = np.searchsorted(self.end, [self.root[word] + 1, self.leaf[word] + 1])
        into: dict[int, list[int]] = {}
        for edge in range(lo, hi):
            into.setdefault(int(self.end[edge]), []).append(edge)
        root, ties = int(self.root[word]), 0
        # Among equal scores the one nearest to its end goes first, as there may be very many.
        heap = [(0.0, int(self.leaf[word]), 0, 0.0, None)]
        out = []
        while heap and len(out) < n:
            _, node, _, done, path = heapq.heappop(heap)
            if node == root:
                ids: list[int] = []
                while path is not None:
                    edge, path = path
                    a, b = int(self.start[edge]) - word, int(self.end[edge]) - word
                    ids += [int(self.ids[edge])] if self.ids[edge] >= 0 else self.byte_ids[self.data[a:b]].tolist()
                out.append((done, ids))
                continue
            for edge in into.get(node, ()):
                so_far = done + float(self.scores[edge])
                start = int(self.start[edge])
                ties += 1
                expected = round(-(so_far + float(self.forward[start])), 6)
                heapq.heappush(heap, (expected, start, ties, so_far, (edge, path)))
        return out


class _Known:
    """Words with their best segmentations, by code: what they score, what another choice costs, and their pieces."""

    def __init__(self, codes, best, gap, count, ids) -> None:
        self.codes, self.best, self.gap, self.count, self.ids = codes, best, gap, count, ids
        self.first = np.cumsum(count) - count

    @classmethod
    def nothing(cls) -> _Known:
        none, whole = np.zeros(0), np.zeros(0, np.int64)
        return cls(np.zeros(0, np.uint64), none, none, whole, np.zeros(0, np.int32))

    def has(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.zeros(len(codes), bool)
        return self.codes[np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)] == codes

    def pieces(self, at: np.ndarray) -> np.ndarray:
        return self.ids[ranges(self.first[at], self.count[at])]

    def with_words(self, codes: np.ndarray, lattice: _Lattice) -> _Known:
        """These words and those of the lattice, whose codes are given."""
        both = np.concatenate([self.codes, codes])
        order = np.argsort(both, kind="stable")
        pairs = zip((self.best, self.gap, self.count), (lattice.best, lattice.gap, lattice.path_count), strict=True)
        best, gap, count = (np.concatenate(x)[order] for x in pairs)
        first = np.concatenate([self.first, len(self.ids) + lattice.path_first])[order]
        ids = np.concatenate([self.ids, lattice.path_ids.astype(np.int32)])
        return _Known(both[order], best, gap, count, ids[ranges(first, count)])


def _lattice_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, vocabulary: _Vocabulary) -> _Lattice:
    first = np.concatenate([[0], np.cumsum(sizes)])
    return _Lattice(data[ranges(starts, sizes)], first, vocabulary)


def combine(choices: list[list[float]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n cheapest ways to take one choice of every list: (cost, choice of each); lists rise from 0."""
    start = tuple(0 for _ in choices)
    heap, seen, out = [(0.0, start)], {start}, []
    while heap and len(out) < n:
        cost, taken = heapq.heappop(heap)
        out.append((cost, taken))
        for k, row in enumerate(choices):
            if taken[k] + 1 < len(row):
                new = (*taken[:k], taken[k] + 1, *taken[k + 1 :])
                if new not in seen:
                    seen.add(new)
                    heapq.heappush(heap, (cost - row[taken[k]] + row[taken[k] + 1], new))
    return out


def _rank_words(
    asked: list[int], data: np.ndarray, at: np.ndarray, sizes: np.ndarray, kinds: np.ndarray,
    vocabulary: _Vocabulary, n: int,
) -> dict[int, list[tuple[float, list[int]]]]:
    """The n best segmentations of each of the asked words; a worker remembers them."""
    if len(vocabulary.ranked) > _KNOWN_RANKED:
        vocabulary.ranked = {}
    new = np.array([k for k in asked if (int(kinds[k]), n) not in vocabulary.ranked], np.int64)
    block = np.cumsum(sizes[new]) // _LATTICE
    out = {}
    for own in np.split(new, np.flatnonzero(np.diff(block)) + 1) if len(new) else ():
        lattice = _lattice_of(data, at[own], sizes[own], vocabulary)
        for word, k in enumerate(own.tolist()):
            out[k] = lattice.n_best(word, n)
            if sizes[k] <= _SHORT:
                vocabulary.ranked[int(kinds[k]), n] = out[k]
    return {k: out[k] if k in out else vocabulary.ranked[int(kinds[k]), n] for k in asked}


def encode_column(column: pa.Array, vocabulary: _Vocabulary, n_best: int) -> tuple[list, np.ndarray, np.ndarray, list]:
    """Offsets and ids of all texts, their best scores, and the other choices of each."""
    data, bounds = _with_prefix(*column_bytes(column))
    starts, codes = _split(data, bounds, vocabulary.cut)
    kinds, at, same = np.unique(codes, return_index=True, return_inverse=True)
    sizes, at = np.diff(starts)[at], starts[:-1][at]
    if len(vocabulary.known.codes) > _KNOWN_WORDS or len(vocabulary.known.ids) > _KNOWN_PIECES:
        vocabulary.known = _Known.nothing()
    new = np.flatnonzero(~vocabulary.known.has(kinds))
    block = np.cumsum(sizes[new]) // _LATTICE
    for own in np.split(new, np.flatnonzero(np.diff(block)) + 1) if len(new) else ():
        vocabulary.known = vocabulary.known.with_words(kinds[own], _lattice_of(data, at[own], sizes[own], vocabulary))
    known = vocabulary.known
    place = np.searchsorted(known.codes, kinds)
    of_word = place[same]
    ids = known.pieces(of_word)
    words = np.searchsorted(starts, bounds)
    token_ends = np.concatenate([[0], np.cumsum(known.count[of_word])])
    scores = np.concatenate([[0.0], np.cumsum(known.best[of_word])])
    scores = scores[words[1:]] - scores[words[:-1]]
    # The words of each text whose second choice costs least.
    nearest = []
    for a, b in zip(words[:-1], words[1:], strict=True):
        gap = known.gap[of_word[a:b]]
        near = np.argpartition(gap, n_best - 2)[: n_best - 1] if len(gap) >= n_best > 1 else np.arange(len(gap))
        nearest.append(sorted(int(k) for k in near if np.isfinite(gap[k])) if n_best > 1 else [])
    ranked = _rank_words(
        sorted({int(same[a + k]) for a, near in zip(words[:-1], nearest, strict=True) for k in near}),
        data, at, sizes, kinds, vocabulary, n_best,
    )
    others = []
    for text, (a, near) in enumerate(zip(words[:-1], nearest, strict=True)):
        rows = [ranked[int(same[a + k])] for k in near]
        costs = [[max(0.0, row[0][0] - score) for score, _ in row] for row in rows]
        others.append(
            [
                {
                    "score": float(scores[text]) - cost,
                    "words": [near[k] for k, c in enumerate(taken) if c],
                    "pieces": [rows[k][c][1] for k, c in enumerate(taken) if c],
                }
                for cost, taken in combine(costs, n_best)[1:]
            ]
        )
    return token_ends[words], ids, scores, others


def _encode(shared, key: str, n_best: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    other = pa.list_(
        pa.struct([("score", pa.float64()), ("words", pa.list_(pa.int32())), ("pieces", pa.list_(pa.list_(pa.int32())))])
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared, key)
        for batch in slices(batches, limit=_SLICE):
            ends, ids, scores, others = encode_column(batch.column("text"), vocabulary, n_best)
            lists = pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), lists, pa.array(scores), pa.array(others, other)],
                ["doc_id", "ids", "score", "others"],
            )

    return encode


def encode(docs: DataFrame, model: str = MODEL, n_best: int = N_BEST) -> DataFrame:
    """Pieces of every row of `docs` (doc_id, text).

    Returns doc_id, ids (best segmentation), score, and others: the next best
    segmentations of the whole text in falling order, each as its score and the
    words (numbered from 0) whose pieces differ from the best ones. Ties may
    come in any but always the same order. `model` is read on the driver.

    Defined cases: NULL and empty texts have no pieces and score 0; characters
    without a piece, and the sign that models use for a space, become byte
    pieces; repeated rows are encoded each; other columns are not read.
    """
    spark = docs.sparkSession
    pieces = read_model(model)
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(_encode(spark.sparkContext.broadcast(pieces), model, n_best), _ENCODED)


def _decode(shared, key: str) -> Callable[[pa.Array], pa.Array]:
    def decode(lists: pa.Array) -> pa.Array:
        vocabulary = _vocabulary(shared, key)
        done = []
        for at in range(0, len(lists), 256):
            part = lists.slice(at, 256)
            ids = np.asarray(part.flatten())
            ends = np.concatenate([[0], np.cumsum([len(x) if x.is_valid else 0 for x in part])])
            sizes = vocabulary.id_sizes[ids]
            data = vocabulary.id_bytes[ranges(vocabulary.id_starts[ids], sizes)]
            bounds = np.concatenate([[0], np.cumsum(sizes)])[ends]
            # The first byte is the space that encoding put before the text.
            done += [data[a + 1 : b].tobytes() if b > a else b"" for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return pa.array(done, pa.binary()).cast(pa.string())

    return decode


def decoded(spark: SparkSession, ids: Column, model: str = MODEL) -> Column:
    """The exact text of a column of ids that `encode` returned; NULL ids give an empty text."""
    shared = spark.sparkContext.broadcast(read_model(model))
    return F.arrow_udf(_decode(shared, model), "string")(ids)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and the exact text of every row that `encode` returned, row by row; an empty table gives an empty one."""
    return encoded.select("doc_id", decoded(encoded.sparkSession, F.col("ids"), model).alias("text"))
