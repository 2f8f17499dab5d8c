"""Removal of passages that an earlier document has, by repeated-phrase automata.

A window is WINDOW consecutive words. The work goes through five steps:

1. Documents are dealt into chunks by a hash. Every window names an anchor, the
   least of the hashed short runs inside it, so equal windows have equal anchors.
   Each chunk sends its distinct anchors, packed by hash range.
2. Each hash range tells the chunks which of their anchors other chunks have too.
3. Chunks cut the passages around anchors that recur and send each distinct
   passage, with the smallest document that has it, to the anchor's shard.
4. A shard confirms the windows that more than one document has, joins windows
   that only occur one after the other into phrases, compiles these into an
   Aho-Corasick automaton over words, and streams its passages through it.
   Every hit in a passage of a later document is marked.
5. Chunks apply the marks to their documents.

Only step 1 moves texts, once; a key that fills a third of the corpus sends one
passage per chunk, since a chunk sends equal passages once.

A chunk sends at most RANGES rows a step, so their number grows in proportion to the
texts. Where more ranges are needed to keep shards small, a row's passages are
dealt further by hash, and a task handles one such part of its range after the other.
"""

from __future__ import annotations

import sys

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.words import SPACED, Words, find_words, mix, power_tables, ranges, runs, whole_runs

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 13
# Words of an anchor: shorter ones recur by chance, longer ones are more numerous.
ANCHOR = 6
# Text of one chunk, and hash ranges for each chunk's worth of text.
CHUNK_BYTES = 6 << 20
RANGES_PER_CHUNK = 4
# Hash ranges that rows are sent to; beyond that, ranges have parts.
RANGES = 1 << 10
# Stands for a NULL id, which is later than any other.
_NO_ID = np.iinfo(np.int64).max

_SENT = "range int, chunk int, anchors binary"
_SHARED = "chunk int, range int, anchors binary, marks binary"
_PASSAGES = "range int, chunk int, parts binary, ids binary, sizes binary, bytes binary"
_KEPT = "doc_id bigint, n_words bigint, n_removed bigint, text string"


def _part(anchor: np.ndarray, n: int) -> np.ndarray:
    """Part of n that each anchor is in, in order of the anchors."""
    return ((anchor >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int32)


class _Chunk:
    """Documents of a chunk in order of id and text, with the anchor of each window."""

    def __init__(self, docs: pa.Table, n_ranges: int, n_parts: int) -> None:
        docs = docs.take(pc.sort_indices(docs, [("doc_id", "ascending"), ("text", "ascending")]))
        self.doc_id = docs["doc_id"].combine_chunks()
        self.ids = pc.fill_null(self.doc_id, _NO_ID).to_numpy()
        self.words: Words = find_words(docs["text"].combine_chunks(), SPACED)
        self.text = self.words.text_of_word()
        codes = runs(self.words.codes, ANCHOR)
        self.windows = np.flatnonzero(whole_runs(self.words.first, len(self.words.codes), WINDOW))
        best = codes[self.windows + WINDOW - ANCHOR] if len(self.windows) else codes[:0]
        place = np.full(len(self.windows), WINDOW - ANCHOR)
        for k in range(WINDOW - ANCHOR - 1, -1, -1):
            here = codes[self.windows + k]
            lower = here <= best  # the first of equals
            best = np.where(lower, here, best)
            place[lower] = k
        self.place = self.windows + place
        self.anchor = best
        self.part = _part(best, n_ranges * n_parts)
        self.range = self.part // n_parts

    def distinct_anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors, and which of them several documents of the chunk have."""
        new = np.ones(len(self.place), bool)
        new[1:] = self.place[1:] != self.place[:-1]
        anchor, ids = self.anchor[new], self.ids[self.text[self.windows[new]]]
        order = np.lexsort((ids, anchor))
        anchor, ids = anchor[order], ids[order]
        distinct, at = np.unique(anchor, return_index=True)
        last = np.append(at[1:], len(anchor)) - 1
        return distinct, ids[at] != ids[last] if len(at) else np.zeros(0, bool)

    def passages(self, shared: pa.Table) -> dict[str, np.ndarray]:
        """Runs of windows with one recurring anchor, in order of hash range, its part and place.

        Equal passages have equal `code`; `leads` marks the first of them, which
        the smallest document has.
        """
        distinct, several = self.distinct_anchors()
        full = [np.frombuffer(b.as_buffer(), np.uint32).astype(np.uint64) for b in shared["anchors"] if b.is_valid]
        home = [r for r, b in zip(shared["range"].to_pylist(), shared["anchors"], strict=True) if b.is_valid]
        key = lambda where, low: (np.asarray(where).astype(np.uint64) << np.uint64(32)) | low
        elsewhere = np.concatenate([key(r, low) for r, low in zip(home, full, strict=True)] or [np.zeros(0, np.uint64)])
        low = np.uint64(0xFFFFFFFF)
        recurring = np.isin(key(self.range, self.anchor & low), elsewhere)
        if len(distinct):
            recurring |= several[np.searchsorted(distinct, self.anchor)]
        use = np.flatnonzero(recurring)
        cut = np.ones(len(use), bool)
        cut[1:] = (np.diff(use) != 1) | (self.place[use][1:] != self.place[use][:-1])
        begin = np.flatnonzero(cut)
        count = np.diff(np.append(begin, len(use)))
        start = self.windows[use[begin]]
        size = count + WINDOW - 1
        power, inverse = power_tables(len(self.words.codes) + 1)
        with np.errstate(over="ignore"):
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.words.codes * power[: len(self.words.codes)])])
            code = mix((total[start + size] - total[start]) * inverse[start] + size.astype(np.uint64))
        part = self.part[use[begin]]
        order = np.lexsort((start, part))
        _, at, same = np.unique(code[order], return_index=True, return_inverse=True)
        text = self.text[start][order]
        # Documents stand in order of id, so the first place is that of the smallest.
        first = np.full(len(at), np.iinfo(np.int64).max)
        np.minimum.at(first, same, start[order])
        return {
            "part": part[order], "start": start[order], "count": count[order], "group": same,
            "id": self.ids[text], "leads": first[same] == start[order],
        }


def _send_anchors(n_ranges: int, n_parts: int):
    def send(docs: pa.Table) -> pa.Table:
        chunk = _Chunk(docs, n_ranges, n_parts)
        anchor, _ = chunk.distinct_anchors()  # in order, so by range too
        home = _part(anchor, n_ranges * n_parts) // n_parts
        bounds = np.searchsorted(home, np.arange(n_ranges + 1))
        filled = np.flatnonzero(np.diff(bounds))
        low = anchor.astype(np.uint32)
        return pa.table(
            {
                "range": pa.array(filled.astype(np.int32)),
                "chunk": pa.array([docs["chunk"][0].as_py()] * len(filled), pa.int32()),
                "anchors": pa.array([np.unique(low[bounds[r] : bounds[r + 1]]).tobytes() for r in filled], pa.binary()),
            }
        )

    return send


def _share_anchors(sent: pa.Table) -> pa.Table:
    """For every chunk, its anchors of this range that other chunks have too."""
    parts = [np.frombuffer(b.as_buffer(), np.uint32) for b in sent["anchors"]]
    every = np.concatenate(parts)
    _, place, counts = np.unique(every, return_inverse=True, return_counts=True)
    shared = counts[place] > 1
    ends = np.cumsum([len(part) for part in parts])
    own = [part[shared[end - len(part) : end]].tobytes() for part, end in zip(parts, ends, strict=True)]
    out = pa.table(
        {
            "chunk": sent["chunk"],
            "range": sent["range"],
            "anchors": pa.array(own, pa.binary()),
            "marks": pa.nulls(len(own), pa.binary()),
        }
    )
    return out.filter(pc.greater(pc.binary_length(out["anchors"]), 0))


def _send_passages(n_ranges: int, n_parts: int):
    def send(docs: pa.Table, shared: pa.Table) -> pa.Table:
        binaries = ["parts", "ids", "sizes", "bytes"]
        schema = pa.schema([("range", pa.int32()), ("chunk", pa.int32()), *[(name, pa.binary()) for name in binaries]])
        if not docs.num_rows:
            return schema.empty_table()
        chunk = _Chunk(docs, n_ranges, n_parts)
        found = chunk.passages(shared)
        lead = found["leads"]
        part, start, size = found["part"][lead], found["start"][lead], found["count"][lead] + WINDOW - 1
        home = part // n_parts
        begin, end = chunk.words.starts[start], chunk.words.ends[start + size - 1]
        rows = {name: [] for name in schema.names}
        bounds = np.searchsorted(home, np.arange(n_ranges + 1))
        for r in np.flatnonzero(np.diff(bounds)):
            own = slice(bounds[r], bounds[r + 1])
            sizes = end[own] - begin[own]
            rows["range"].append(int(r))
            rows["chunk"].append(docs["chunk"][0].as_py())
            rows["parts"].append(part[own].tobytes())
            rows["ids"].append(found["id"][lead][own].tobytes())
            rows["sizes"].append(sizes.astype(np.int64).tobytes())
            rows["bytes"].append(chunk.words.data[ranges(begin[own], sizes)].tobytes())
        return pa.table(rows, schema)

    return send


def _phrase_heads(same: np.ndarray, passage: np.ndarray, n: int) -> np.ndarray:
    """Which windows start a phrase, given each window's number below n and its passage.

    Two windows are in one phrase if the first is always followed by the second
    and the second always comes after the first. A passage starts with a new phrase, so
    every occurrence of a phrase is whole, and a window is in one phrase only.
    """
    inner = passage[1:] == passage[:-1]
    after = np.append(np.where(inner, same[1:], -1), -1)[: len(same)]
    before = np.insert(np.where(inner, same[:-1], -1), 0, -1)[: len(same)]
    one_after, one_before = np.full(n, -1), np.full(n, -1)
    one_after[same], one_before[same] = after, before
    for one, each in ((one_after, after), (one_before, before)):
        one[same[one[same] != each]] = -1
    goes_on = (one_before >= 0) & (one_after[one_before] == np.arange(n))
    return ~goes_on[same]


def _mark_part(ids: np.ndarray, sizes: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which windows of passages stand in a smaller document too, and how many windows each passage has."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    passages = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(data))
    words = find_words(passages, SPACED)
    passage = words.text_of_word()
    windows = np.flatnonzero(whole_runs(words.first, len(words.codes), WINDOW))
    owner = ids[passage[windows]]
    codes, same = np.unique(runs(words.codes, WINDOW)[windows], return_inverse=True)
    first, last = np.full(len(codes), _NO_ID), np.full(len(codes), -_NO_ID)
    np.minimum.at(first, same, owner)
    np.maximum.at(last, same, owner)
    marks = np.zeros(len(windows), np.uint8)
    confirmed = np.flatnonzero(first < last)
    if len(confirmed):
        _, symbols = np.unique(words.codes, return_inverse=True)
        heads = np.flatnonzero(_phrase_heads(same, passage[windows], len(codes)))
        n_windows = np.diff(np.append(heads, len(windows)))
        sample = np.full(len(codes), -1)  # one head of each phrase, at its first window
        sample[same[heads]] = np.arange(len(heads))
        sample = sample[confirmed][sample[confirmed] >= 0]
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for pattern, at in enumerate(sample.tolist()):
            begin = windows[heads[at]]
            phrase = symbols[begin : begin + n_windows[at] + WINDOW - 1] + 1
            automaton.add_word(tuple(phrase.tolist()), pattern)
        automaton.make_automaton()
        # One stream: symbol 0 stands between passages and is in no pattern.
        stream = np.zeros(len(symbols) + len(sizes), np.int64)
        stream[np.arange(len(symbols)) + passage] = symbols + 1
        hits = np.array(list(automaton.iter(tuple(stream.tolist()))), np.int64).reshape(-1, 2)
        at = np.zeros(len(stream), np.int64)  # window of each place in the stream
        at[windows + passage[windows]] = np.arange(len(windows))
        length = n_windows[sample][hits[:, 1]]
        window = at[hits[:, 0] - length - WINDOW + 2]
        later = first[same[heads[sample]]][hits[:, 1]] < owner[window]
        marks[ranges(window[later], length[later])] = 1
    return marks, np.bincount(passage[windows], minlength=len(sizes))


def _mark_passages(sent: pa.Table) -> pa.Table:
    """Which windows of a shard's passages stand in a smaller document too, one part of the shard after the other."""
    ids, sizes, parts = (
        [np.frombuffer(b.as_buffer(), kind) for b in sent[name]]
        for name, kind in (("ids", np.int64), ("sizes", np.int64), ("parts", np.int32))
    )
    per_row = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    ids, sizes, parts = (np.concatenate(x) for x in (ids, sizes, parts))
    data = np.frombuffer(b"".join(b.as_py() for b in sent["bytes"]), np.uint8)
    begin = np.cumsum(sizes) - sizes
    marked, counts = [], np.zeros(len(ids), np.int64)
    order = np.argsort(parts, kind="stable")
    cuts = np.flatnonzero(np.diff(parts[order])) + 1
    groups = np.split(order, cuts)
    for own in groups:
        text = data if len(groups) == 1 else data[ranges(begin[own], sizes[own])]
        found, counts[own] = _mark_part(ids[own], sizes[own], text)
        marked.append(found)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    marks = np.zeros(bounds[-1], np.uint8)
    for own, found in zip(groups, marked, strict=True):
        marks[ranges(bounds[own], counts[own])] = found
    bounds = bounds[per_row]
    return pa.table(
        {
            "chunk": sent["chunk"],
            "range": sent["range"],
            "anchors": pa.nulls(len(per_row) - 1, pa.binary()),
            "marks": pa.array([marks[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
        }
    )


def _joined(words: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of every text, joined by single spaces."""
    kept = np.flatnonzero(keep)
    sizes = words.ends[kept] - words.starts[kept]
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    out = np.full(int(begin[-1]), 0x20, np.uint8)
    step = 1 << 16
    for at in range(0, len(kept), step):  # index arrays stay small
        own = slice(at, at + step)
        out[ranges(begin[:-1][own], sizes[own])] = words.data[ranges(words.starts[kept[own]], sizes[own])]
    bounds = begin[np.searchsorted(kept, words.first)]
    texts = [out[a : max(a, b - 1)].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return pa.array(texts, pa.binary()).cast(pa.string())


def _apply_marks(n_ranges: int, n_parts: int):
    def apply(docs: pa.Table, shared: pa.Table) -> pa.Table:
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])
        if not docs.num_rows:
            return schema.empty_table()
        chunk = _Chunk(docs, n_ranges, n_parts)
        found = chunk.passages(shared)
        marked = shared.filter(shared["marks"].is_valid()).sort_by("range")
        marks = np.frombuffer(b"".join(b.as_py() for b in marked["marks"]), np.uint8)
        lead = np.flatnonzero(found["leads"])
        begin = np.concatenate([[0], np.cumsum(found["count"][lead])])
        if begin[-1] != len(marks):
            raise ValueError("marks and passages of a chunk do not agree")
        # Each passage takes the marks of its group's first one; later documents lose it whole.
        leader = np.zeros(int(found["group"].max(initial=-1)) + 1, np.int64)
        leader[found["group"][lead]] = np.arange(len(lead))
        own = leader[found["group"]]
        window = ranges(found["start"], found["count"])
        later = np.repeat(found["id"] > found["id"][lead][own], found["count"])
        gone = window[later | (marks[ranges(begin[own], found["count"])] > 0)]
        n = len(chunk.words.codes)
        step = np.zeros(n + 1, np.int64)
        np.add.at(step, gone, 1)
        np.add.at(step, gone + WINDOW, -1)
        removed = np.cumsum(step)[:n] > 0
        total = np.concatenate([[0], np.cumsum(removed)])
        first = chunk.words.first
        return pa.table(
            {
                "doc_id": chunk.doc_id,
                "n_words": pa.array(np.diff(first)),
                "n_removed": pa.array(total[first[1:]] - total[first[:-1]]),
                "text": _joined(chunk.words, ~removed),
            },
            schema,
        )

    return apply


def remove_repeats(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Every row of `docs` (doc_id, text) without the passages that smaller ids have.

    Returns doc_id, n_words, n_removed and text: the kept words joined by single
    spaces. A word goes if any window over it also starts in a document with a
    smaller id; windows are judged on the input.

    Defined cases: NULL and empty texts have no words and give an empty text;
    a NULL id is larger than any other; rows that share an id never remove
    each other's words; texts shorter than a window stay whole; an empty table
    gives an empty result; other columns are not read.
    """
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    n_chunks = max(8, 1 + int(size) // chunk_bytes)
    n_parts = -(-n_chunks * RANGES_PER_CHUNK // RANGES)
    n_ranges = min(n_chunks * RANGES_PER_CHUNK, RANGES)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    chunks = slim.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)).cast("int").alias("chunk"), "doc_id", "text")
    by_chunk = chunks.groupBy("chunk")
    sent = by_chunk.applyInArrow(_send_anchors(n_ranges, n_parts), _SENT)
    shared = sent.groupBy("range").applyInArrow(_share_anchors, _SHARED)
    passages = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(_send_passages(n_ranges, n_parts), _PASSAGES)
    marks = passages.groupBy("range").applyInArrow(_mark_passages, _SHARED)
    told = shared.unionByName(marks)
    return by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(_apply_marks(n_ranges, n_parts), _KEPT)
