"""Quality rules: counted rules, and perplexity under an n-gram model of the corpus.

The models give every character its probability after the three before, by a
modified Kneser-Ney model of order 4 over the characters themselves: case, script
and sign all count. Characters are UTF-16 units, so that four of them are one 64-bit
number; what lies beyond U+FFFF is two units. Spark counts the n-grams of all
documents that pass the counted rules; a model is sorted arrays of n-grams with
their counts, and all else follows from these.

Only what n-grams of three and four characters leave over for unseen ones is shared
out by a coarser model, in two factors. The first is that of a character's symbol
after the symbols before: 32 symbols stand for white space, 26 classes of letters,
digits, punctuation and other signs; letters of all scripts are dealt over the same
26 classes by code point. The second is that of the character itself after the one
before, given its symbol; unseen pairs and characters are smoothed over all code
points.

Every language has two models, from the two halves of its texts by content, and
a document is judged by the model of the other half: neither it nor a copy of it
vouches for itself. It is rejected when its mean bits per character lie outside the
band of its language: quartiles of the documents that pass the counted rules,
widened by a multiple of their distance. Models are sent out in groups of
bounded size, each to the documents of its languages.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.llm.words import (
    SPACED,
    byte_class,
    column_bytes,
    covered,
    find_words,
    release_memory,
    runs,
    slices,
    start_in_worker,
    whole_runs,
    worker_cache,
)
from marketloom.scratch import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 4
SYMBOLS = 32
HALVES = 2
# N-grams of the models that are sent out at one time, or of a single model.
GROUP_NGRAMS = 1 << 23
# Models that a task counts or a worker keeps at one time, of 4 MB each and their n-grams.
TABLES = 16
# Characters that a task counts before it passes the counts on.
OPEN_CHARACTERS = 1 << 31
# N-grams of one model that a task keeps before it passes their counts on.
OPEN_NGRAMS = 1 << 20
# Characters of all models that wait to be counted.
WAITING = 1 << 21
# Bits of a character in an n-gram, and the n-gram of spaces that stands before a text.
_UNIT = 16
_SPACES = 0x0020002000200020
# Text handled at one time; a character takes some 100 bytes of arrays.
_SLICE = 1 << 19
# The band reaches this many quartile distances, and at least this many bits, beyond the quartiles.
BAND_WIDTH = 4.0
BAND_LEAST = 0.5
# Scores are counted for quantiles in steps of this many bits.
BIN = 0.001
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
REPEAT_WINDOW = 3

_LINE = byte_class((0x0A, 0x0A))
_SIGNS = ~byte_class(*[(b, b) for b in b"#*$%&|<>"])


def _symbol_table() -> np.ndarray:
    """Symbol of each ASCII byte: 0 white space, 1-26 letters, 27 digits, 28 punctuation, 29 signs."""
    table = np.full(256, 29, np.uint8)
    table[~SPACED] = 0
    for k in range(26):
        table[[ord("a") + k, ord("A") + k]] = k + 1
    table[ord("0") : ord("9") + 1] = 27
    table[list(b".,;:!?'\"()-")] = 28
    return table


_SYMBOL = _symbol_table()


def symbols(code: np.ndarray) -> np.ndarray:
    """Symbol of every code point.

    Beyond ASCII the signs below U+00C0 and the punctuation at U+2000 and U+3000
    are signs; all other characters count as letters.
    """
    sign = (code < 0xC0) | ((code >= 0x2000) & (code < 0x2070)) | ((code >= 0x3000) & (code < 0x3040))
    beyond = np.where(sign, 29, 1 + code % 26).astype(np.uint8)
    return np.where(code < 0x80, _SYMBOL[np.minimum(code, 0x7F)], beyond)


# Code points of each symbol.
_POINTS = np.maximum(np.bincount(symbols(np.arange(0x110000)), minlength=SYMBOLS), 1)


def characters(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-16 units of UTF-8 texts, and the bounds of the texts in them."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    point = data[lead].astype(np.uint64)
    bounds = np.searchsorted(lead, bounds)
    some = np.flatnonzero(point >= 0x80)
    if not len(some):
        return point, bounds
    padded = np.append(data, np.zeros(3, np.uint8)).astype(np.int64)
    at, head = lead[some], padded[lead[some]]
    code = np.where(head < 0xE0, head & 0x1F, np.where(head < 0xF0, head & 0x0F, head & 0x07))
    for k, least in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
        code = np.where(head >= least, (code << 6) | (padded[at + k] & 0x3F), code)
    wide = code >= 0x10000
    point[some] = np.where(wide, 0xD800 + ((code - 0x10000) >> 10), code)
    if not wide.any():
        return point, bounds
    after = some[wide] + 1
    point = np.insert(point, after, (0xDC00 + (code[wide] & 0x3FF)).astype(np.uint64))
    return point, bounds + np.searchsorted(after, bounds, "right")


def ngrams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at every character of the texts, each text preceded by spaces, and the texts' bounds."""
    unit, bounds = characters(data, bounds)
    grams = unit.copy()
    for back in range(1, ORDER):
        grams[back:] |= unit[: max(0, len(unit) - back)] << np.uint64(_UNIT * back)
    sizes = np.diff(bounds)
    for k in range(ORDER - 1):
        own = np.uint64((1 << _UNIT * (k + 1)) - 1)
        at = bounds[:-1][sizes > k] + k
        grams[at] = (grams[at] & own) | (np.uint64(_SPACES) & ~own)
    return grams, bounds


def _coarse(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of the symbols of n-grams, and the pair of characters that each ends with."""
    unit = [((grams >> np.uint64(_UNIT * back)) & np.uint64(0xFFFF)).astype(np.int64) for back in range(ORDER)]
    code = np.zeros(len(grams), np.int64)
    for back in range(ORDER - 1, -1, -1):
        code = code * SYMBOLS + symbols(unit[back])
    return code, (unit[1] << 21) | unit[0]


def _codes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code of symbols and pair of characters at every character of the texts, and the texts' bounds."""
    grams, bounds = ngrams(data, bounds)
    return *_coarse(grams), bounds


def _ascii(pairs: np.ndarray) -> np.ndarray:
    """Which pairs are of two ASCII characters."""
    return (pairs & ((0x1FFF80 << 21) | 0x1FFF80)) == 0


def _ascii_place(pairs: np.ndarray) -> np.ndarray:
    """Place of pairs of two ASCII characters in a table of all of these."""
    return ((pairs >> 21) << 7) | (pairs & 0x7F)


def _merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    codes, place = np.unique(np.append(a[0], b[0]), return_inverse=True)
    return codes, np.bincount(place, np.append(a[1], b[1]), len(codes)).astype(np.int64)


def _find(keys: np.ndarray, asked: np.ndarray, values: np.ndarray, missing) -> np.ndarray:
    """Values of the asked keys by sorted keys."""
    if not len(keys):
        return np.broadcast_to(missing, asked.shape).astype(np.float64)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], missing)


@dataclass
class Characters:
    """Probability of a character after the one before, given its symbol, by Witten-Bell smoothing.

    Pairs back off to characters by themselves, and these to all code points of the symbol.
    """

    pairs: np.ndarray  # sorted pairs, and the share of each among those with its first character and symbol
    own: np.ndarray
    contexts: np.ndarray  # sorted (character, symbol), and the share kept for the symbol's characters by themselves
    left: np.ndarray
    points: np.ndarray  # sorted characters, and the probability of each by itself
    alone: np.ndarray
    unseen: np.ndarray  # by symbol, that of a character not seen
    plain: np.ndarray | None = None  # bits of all pairs of two ASCII characters

    def _all_bits(self, pairs: np.ndarray) -> np.ndarray:
        point = pairs & 0x1FFFFF
        symbol = symbols(point).astype(np.int64)
        alone = _find(self.points, point, self.alone, self.unseen[symbol])
        left = _find(self.contexts, (pairs >> 21) * SYMBOLS + symbol, self.left, 1.0)
        return -np.log2(_find(self.pairs, pairs, self.own, 0.0) + left * alone)

    def bits(self, pairs: np.ndarray) -> np.ndarray:
        if self.plain is None:
            every = np.arange(1 << 14)
            self.plain = self._all_bits(((every >> 7) << 21) | (every & 0x7F))
        plain = _ascii(pairs)
        out = np.empty(len(pairs))
        out[plain] = self.plain[_ascii_place(pairs[plain])]
        out[~plain] = self._all_bits(pairs[~plain])
        return out


def character_model(pairs: np.ndarray, counts: np.ndarray) -> Characters:
    """From sorted pair codes and their counts."""
    point = pairs & 0x1FFFFF
    symbol = symbols(point).astype(np.int64)
    points, place = np.unique(point, return_inverse=True)
    n_point = np.bincount(place, counts, len(points))
    of_point = symbols(points)
    n_symbol = np.bincount(of_point, n_point, SYMBOLS)
    kinds = np.bincount(of_point, minlength=SYMBOLS)
    unseen = np.where(kinds > 0, kinds / _POINTS / np.maximum(n_symbol + kinds, 1), 1 / _POINTS)
    alone = n_point / (n_symbol + kinds)[of_point] + unseen[of_point]
    contexts, context = np.unique((pairs >> 21) * SYMBOLS + symbol, return_inverse=True)
    kinds_after = np.bincount(context, minlength=len(contexts))
    total = np.bincount(context, counts, len(contexts)) + kinds_after
    return Characters(pairs, counts / total[context], contexts, kinds_after / total, points, alone, unseen)


def _ngram_rows(totals: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for (model, half), (codes, counts) in totals.items():
        columns = [
            pa.array([model] * len(codes), pa.string()),
            pa.array(np.full(len(codes), half, np.int32)),
            pa.array(codes.view(np.int64)),
            pa.array(counts),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["model", "half", "code", "n"])


def _by_model(models: list[str], halves: np.ndarray, chosen: np.ndarray) -> Iterator[tuple[tuple[str, int], np.ndarray]]:
    """The chosen rows of every (language, half)."""
    names: dict[str, int] = {}
    key = np.array([names.setdefault(m, len(names)) for m in models], np.int64) * HALVES + halves
    spelled = list(names)
    for k in np.unique(key[chosen]):
        yield (spelled[k // HALVES], int(k % HALVES)), np.flatnonzero(chosen & (key == k))


def _count_ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts of a partition's good texts by model; at most TABLES models are open."""
    start_in_worker("quality_rules")
    totals: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
    waiting: dict[tuple[str, int], list[np.ndarray]] = {}
    n_open = n_waiting = 0

    def count() -> None:
        for key, parts in waiting.items():
            found = np.unique(np.concatenate(parts), return_counts=True)
            totals[key] = _merged(totals[key], found) if key in totals else found
        waiting.clear()

    for batch in slices(batches, limit=_SLICE):
        counted = rule_counts(batch.column("text"))
        good = ~_fails(counted["n_words"], counted["n_repeat_words"])
        halves = batch.column("half").to_numpy()
        for key, own in _by_model(batch.column("model").to_pylist(), halves, good):
            grams, _ = ngrams(*column_bytes(batch.column("text").take(pa.array(own))))
            n_open += len(grams)
            new = key not in totals and key not in waiting
            if (new and len(totals.keys() | waiting.keys()) == TABLES) or n_open > OPEN_CHARACTERS:
                count()
                yield from _ngram_rows(totals)
                totals.clear()
                n_open, n_waiting = len(grams), 0
            waiting.setdefault(key, []).append(grams)
            n_waiting += len(grams)
            if n_waiting > WAITING:
                count()
                n_waiting = 0
                for full in [k for k, (codes, _) in totals.items() if len(codes) > OPEN_NGRAMS]:
                    yield from _ngram_rows({full: totals.pop(full)})
    count()
    yield from _ngram_rows(totals)
    totals.clear()
    release_memory()


def _pack_model(group: pa.Table) -> pa.Table:
    """One language's model as arrays in order of the n-grams."""
    code, n = group["code"].to_numpy().view(np.uint64), group["n"].to_numpy()
    order = np.argsort(code)
    return pa.table(
        {
            "model": pa.array([group["model"][0].as_py()], pa.string()),
            "half": group["half"][:1].combine_chunks(),
            "size": pa.array([len(code)], pa.int64()),
            "codes": pa.array([code[order].tobytes()], pa.binary()),
            "counts": pa.array([n[order].astype(np.int64).tobytes()], pa.binary()),
        }
    )


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Discount of each n-gram by its count: for 1, 2 and 3 or more, from counts of counts."""
    n1, n2, n3, n4 = (float((counts == k).sum()) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    step = np.array([0.0, *(min(max(d, 0.1), k + 0.9) for k, d in enumerate(raw))])
    return np.minimum(step[np.minimum(counts, 3)], counts)


def kneser_ney(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bits of every possible n-gram's last symbol after the others, from the sorted arrays of a model."""
    full = np.zeros(SYMBOLS**ORDER, np.int64)
    full[codes] = counts
    by_order = [full.reshape(-1, SYMBOLS)]
    seen = full
    for k in range(ORDER - 1, 0, -1):  # lower orders count the distinct symbols before
        seen = (seen.reshape(SYMBOLS, -1) > 0).sum(0).astype(np.int64)
        by_order.append(seen.reshape(-1, SYMBOLS))
    lower = np.full((1, SYMBOLS), 1.0 / SYMBOLS)
    for table in reversed(by_order):
        off = _discounts(table.ravel()).reshape(table.shape)
        total = table.sum(1, keepdims=True)
        left = np.where(total > 0, off.sum(1, keepdims=True) / np.maximum(total, 1), 1.0)
        # A context's shorter form lacks its first symbol: rows repeat in that order.
        lower = (table - off) / np.maximum(total, 1) + left * np.tile(lower, (len(table) // len(lower), 1))
    return -np.log2(lower.ravel()).astype(np.float32)


@dataclass
class Ngrams:
    """Bits of characters after the three before, by n-grams of characters and the coarser model for unseen ones."""

    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # shorter first: n-grams and their shares, contexts and what these keep
    symbol_bits: np.ndarray
    characters: Characters

    def bits(self, grams: np.ndarray) -> np.ndarray:
        code, pair = _coarse(grams)
        share = 2.0 ** -(self.symbol_bits[code].astype(np.float64) + self.characters.bits(pair))
        for (keys, own, contexts, left), order in zip(self.levels, range(ORDER - len(self.levels) + 1, ORDER + 1), strict=True):
            asked = grams & np.uint64((1 << _UNIT * order) - 1)
            share = _find(keys, asked, own, 0.0) + _find(contexts, asked >> np.uint64(_UNIT), left, 1.0) * share
        return -np.log2(share)


def ngram_model(grams: np.ndarray, counts: np.ndarray) -> Ngrams:
    """From the sorted n-grams of a model and their counts."""
    levels, keys, n = [], grams, counts
    for order in (ORDER, ORDER - 1):
        contexts, start, size = np.unique(keys >> np.uint64(_UNIT), return_index=True, return_counts=True)
        off = _discounts(n)
        total = np.add.reduceat(n, start) if len(n) else n
        left = np.add.reduceat(off, start) if len(n) else off
        own = ((n - off) / np.repeat(total, size)).astype(np.float32)
        levels.append((keys, own, contexts, (left / total).astype(np.float32)))
        # Lower orders count the distinct characters before.
        keys, n = np.unique(keys & np.uint64((1 << _UNIT * (order - 1)) - 1), return_counts=True)
    code, pair = _coarse(grams)
    symbol_counts = np.bincount(code, counts, SYMBOLS**ORDER).astype(np.int64)
    some = np.flatnonzero(symbol_counts)
    pairs, place = np.unique(pair, return_inverse=True)
    pair_counts = np.bincount(place, counts, len(pairs)).astype(np.int64)
    return Ngrams(levels[::-1], kneser_ney(some, symbol_counts[some]), character_model(pairs, pair_counts))


def _model_of(models: dict[tuple[str, int], tuple[bytes, ...]], group: str, key: tuple[str, int]) -> Ngrams | None:
    """One model; a worker keeps the last TABLES of them."""
    if key not in models:
        return None
    cache = worker_cache("quality_rules")
    if cache.get("bits_group") != group:
        cache["bits"], cache["bits_group"] = {}, group
    tables = cache["bits"]
    if key not in tables:
        if len(tables) == TABLES:
            tables.pop(next(iter(tables)))
        codes, counts = models[key]
        tables[key] = ngram_model(np.frombuffer(codes, np.uint64), np.frombuffer(counts, np.int64))
    return tables[key]


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _sorted_equal(code: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorting order of (text, code) pairs, and which of them in that order equals the one before."""
    order = np.lexsort((code, text))
    same = np.zeros(len(code), bool)
    same[1:] = (code[order][1:] == code[order][:-1]) & (text[order][1:] == text[order][:-1])
    return order, same


def _later(code: np.ndarray, text: np.ndarray) -> np.ndarray:
    """All but the first place of every (text, code) pair."""
    order, same = _sorted_equal(code, text)
    return order[same]


def _repeats(code: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which (text, code) pairs stand there more than once."""
    order, same = _sorted_equal(code, text)
    out = np.zeros(len(code), bool)
    out[order[same]] = True
    out[order[:-1][same[1:]]] = True
    return out


def rule_counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The counted rules of every text of a column."""
    words = find_words(column, SPACED)
    inside = np.zeros(len(words.data), bool)
    if len(words.starts):
        inside = covered(words.starts, words.ends, len(words.data))
    bounds = column_bytes(column)[1]
    text = words.text_of_word()
    triples = runs(words.codes, REPEAT_WINDOW)
    whole = np.flatnonzero(whole_runs(words.first, len(words.codes), REPEAT_WINDOW))
    starts = whole[_repeats(triples[whole], text[whole])]
    repeated = covered(starts, starts + REPEAT_WINDOW, len(words.codes))
    lines = find_words(column, _LINE)
    of_line = lines.text_of_word()
    spoken = np.concatenate([[0], np.cumsum(inside)])
    spoken = spoken[lines.ends] > spoken[lines.starts]
    again = of_line[spoken][_later(lines.codes[spoken], of_line[spoken])]
    return {
        "n_words": np.diff(words.first),
        "word_chars": per_text(inside & ((words.data & 0xC0) != 0x80), bounds),
        "n_symbols": per_text(_SIGNS[words.data], bounds),
        "n_dup_lines": np.bincount(again, minlength=len(bounds) - 1),
        "n_repeat_words": per_text(repeated, words.first),
    }


_MODEL = "model string, half int, size bigint, codes binary, counts binary"
_SCORE = (
    "struct<n_words: bigint, word_chars: bigint, n_symbols: bigint, n_dup_lines: bigint, n_repeat_words: bigint, bits: double>"
)
_ARRAYS = ["codes", "counts"]
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _fails(n_words, n_repeat_words):
    """The counted rules, on columns or on arrays."""
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def _bits(texts: pa.Array, models: list[str], halves: np.ndarray, shared: dict, group: str) -> pa.Array:
    """Mean bits per character of each text under the model of the other half; NULL where there is none."""
    bits, known = np.zeros(len(models)), np.zeros(len(models), bool)
    for (lang, half), own in _by_model(models, halves, np.ones(len(models), bool)):
        model = _model_of(shared, group, (lang, 1 - half))
        if model is None:
            continue
        grams, bounds = ngrams(*column_bytes(texts.take(pa.array(own))))
        distinct, place = np.unique(grams, return_inverse=True)
        bits[own] = per_text(model.bits(distinct)[place], bounds) / np.maximum(np.diff(bounds), 1)
        known[own] = True
    return pa.array(bits, mask=~known)


def _score_column(shared, group: str) -> Callable[..., Column]:
    """A column of rule counts and bits from text, model and half; texts alone go through Python."""

    def score(text: pa.Array, model: pa.Array, half: pa.Array) -> pa.Array:
        parts = []
        rows = pa.RecordBatch.from_arrays([text, model, half], ["text", "model", "half"])
        for batch in slices(iter([rows]), limit=_SLICE):
            counted = rule_counts(batch.column("text"))
            columns = [pa.array(counted[c].astype(np.int64)) for c in _COUNTS]
            halves = batch.column("half").to_numpy()
            columns.append(_bits(batch.column("text"), batch.column("model").to_pylist(), halves, shared.value, group))
            parts.append(pa.StructArray.from_arrays(columns, [*_COUNTS, "bits"]))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct([(c, pa.int64()) for c in _COUNTS] + [("bits", pa.float64())]))

    # A filter on the score would otherwise be moved before it, with a second call for every row.
    return F.arrow_udf(score, _SCORE).asNondeterministic()


def train_models(docs: DataFrame) -> DataFrame:
    """Stored models by language and half; `docs` has model, half and text."""
    counts = docs.select("model", "half", "text").mapInArrow(_count_ngrams, "model string, half int, code bigint, n bigint")
    summed = counts.groupBy("model", "half", "code").agg(F.sum("n").alias("n"))
    return written(summed.groupBy("model", "half").applyInArrow(_pack_model, _MODEL), "ngram_models")


def model_groups(models: DataFrame, limit: int = GROUP_NGRAMS) -> list[list[str]]:
    """Languages whose models have at most `limit` n-grams together, or a single one; it sees one row per language."""
    sizes = models.groupBy("model").agg(F.sum("size").alias("size")).orderBy(F.desc("size"), "model").collect()
    groups: list[list[str]] = []
    left = 0
    for row in sizes:
        if not groups or row["size"] > left:
            groups.append([])
            left = limit
        groups[-1].append(row["model"])
        left -= row["size"]
    return groups or [[]]


def quartiles(scored: DataFrame) -> DataFrame:
    """low, middle and high quartile of `bits` by model, exact to BIN, from a histogram."""
    bins = scored.groupBy("model", F.round(F.col("bits") / BIN).cast("bigint").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    ordered = Window.partitionBy("model").orderBy("bin")
    ranked = bins.select(
        "model",
        (F.col("bin") * BIN).alias("value"),
        F.sum("n").over(ordered).alias("up_to"),
        F.sum("n").over(Window.partitionBy("model")).alias("n_all"),
    )

    def at(share: float) -> Column:
        return F.min(F.when(F.col("up_to") >= share * F.col("n_all"), F.col("value")))

    return ranked.groupBy("model").agg(at(0.25).alias("low"), at(0.5).alias("middle"), at(0.75).alias("high"))


def _named(docs: DataFrame) -> DataFrame:
    """doc_id, text, model (the language; NULL counts as the empty name), half, and the whole row."""
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text.alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("model"),
        F.pmod(F.xxhash64(text), F.lit(HALVES)).cast("int").alias("half"),
        F.struct("*").alias("row"),
    )


def _each_group(named: DataFrame, models: DataFrame) -> Iterator[tuple[DataFrame, Column]]:
    """Rows of each group of languages, and their score column; languages without a model come with the first group."""
    groups = model_groups(models)
    elsewhere = [lang for group in groups[1:] for lang in group]
    for k, group in enumerate(groups):
        rows = models.where(F.col("model").isin(group)).collect()  # GROUP_NGRAMS codes and counts, or one model
        arrays = {(r["model"], r["half"]): tuple(bytes(r[c]) for c in _ARRAYS) for r in rows}
        shared = named.sparkSession.sparkContext.broadcast(arrays)
        own = F.col("model").isin(group) if k else ~F.col("model").isin(elsewhere)
        yield named.where(own), _score_column(shared, uuid.uuid4().hex)("text", "model", "half")


def _scored(named: DataFrame, models: DataFrame) -> DataFrame:
    """Rule counts and bits of every row."""
    parts = []
    for rows, score in _each_group(named, models):
        found = rows.select("doc_id", "model", score.alias("score")).select("doc_id", "model", "score.*")
        parts.append(written(found, "scored_text"))
    scored = reduce(DataFrame.union, parts)
    return scored.withColumn("base_failed", _fails(F.col("n_words"), F.col("n_repeat_words")))


def bands_of(scored: DataFrame, width: float = BAND_WIDTH, least: float = BAND_LEAST) -> DataFrame:
    """band_low and band_high by model, from the rows that pass the counted rules."""
    spread = F.greatest(width * (F.col("high") - F.col("low")), F.lit(least))
    return quartiles(scored.where("not base_failed and bits is not null")).select(
        "model", (F.col("low") - spread).alias("band_low"), (F.col("high") + spread).alias("band_high")
    )


def _verdict(bits: Column, low: Column, high: Column) -> Column:
    return F.coalesce(bits.between(low, high), F.lit(True))


def judge(docs: DataFrame, width: float = BAND_WIDTH, least: float = BAND_LEAST) -> DataFrame:
    """Rule counts, score and verdict of every row of `docs` (doc_id, text, lang).

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, model, bits, band_low and band_high. Where no document of
    the other half of a language passes the counted rules, bits are NULL and
    perplexity does not reject.

    Defined cases: NULL and empty texts have no words, so they fail the counted
    rules; a NULL language counts as the empty name; repeated rows are judged
    each and count each; an empty table gives an empty result; other columns are
    not read.
    """
    named = _named(docs)
    scored = _scored(named, train_models(named))
    bands = bands_of(scored, width, least)  # one row per language
    inside = _verdict(F.col("bits"), F.col("band_low"), F.col("band_high"))
    return scored.join(bands, "model", "left").select(
        "doc_id",
        *_COUNTS,
        "base_failed",
        (~F.col("base_failed") & inside).alias("kept"),
        "model",
        "bits",
        "band_low",
        "band_high",
    )


def keep_good(docs: DataFrame, width: float = BAND_WIDTH, least: float = BAND_LEAST) -> DataFrame:
    """The rows that `judge` keeps, with all their columns; texts alone go through Python and nothing is shuffled."""
    named = _named(docs)
    models = train_models(named)
    bands = written(bands_of(_scored(named, models), width, least), "bands")
    parts = []
    for rows, score in _each_group(named, models):
        judged = rows.select("model", "row", score.alias("score"))
        judged = judged.where(~_fails(F.col("score.n_words"), F.col("score.n_repeat_words")))
        inside = _verdict(F.col("score.bits"), F.col("band_low"), F.col("band_high"))
        parts.append(judged.join(bands, "model", "left").where(inside).select("row.*"))
    if len(parts) > 1:  # one group's models at a time
        parts = [written(part, "kept_rows") for part in parts]
    return reduce(DataFrame.union, parts)
