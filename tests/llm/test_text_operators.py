"""Operators on words and passages against brute force over small, awkward tables."""

import hashlib
import itertools
import random
import re
import time
from collections import Counter, defaultdict
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marketloom.llm import decontaminate, near_dups, quality_rules, substring_dedup, words
from marketloom.llm.components import connected
from marketloom.scratch import written

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("piece", [3, 17, 1 << 20])
def test_words_match_regular_expressions(monkeypatch, piece):
    monkeypatch.setattr(words, "PIECE_BYTES", piece)
    rng = random.Random(piece)
    for _ in range(60):
        texts = ["".join(rng.choice("abAZ09 é\n\t\x00.|漢") for _ in range(rng.choice([0, 1, 6, 50]))) for _ in range(4)]
        found = words.find_words(pa.array([None, *texts]), words.ALPHANUMERIC, lower=True)
        want = [re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", t.translate(LOWER)) for t in ["", *texts]]
        got = [bytes(found.data[a:b]).decode() for a, b in zip(found.starts, found.ends)]
        assert got == [w for row in want for w in row]
        assert [b - a for a, b in itertools.pairwise(found.first)] == [len(row) for row in want]
        code = {}
        assert all(code.setdefault(w, c) == c for w, c in zip(got, found.codes.tolist()))
        assert len(set(code.values())) == len(code)


def removed_by_hand(pairs):
    """Kept words of each (id, text), by looking at every window."""
    first = {}
    cut = [WORD.findall(text or "") for _, text in pairs]
    order = [float("inf") if i is None else i for i, _ in pairs]
    for i, row in zip(order, cut):
        for k in range(len(row) - 12):
            window = tuple(row[k : k + 13])
            first[window] = min(first.get(window, i), i)
    out = Counter()
    for (doc, _), i, row in zip(pairs, order, cut):
        gone = {j for k in range(len(row) - 12) if first[tuple(row[k : k + 13])] < i for j in range(k, k + 13)}
        out[doc, len(row), len(gone), " ".join(w for j, w in enumerate(row) if j not in gone)] += 1
    return out


@pytest.mark.parametrize("chunk_bytes", [4_000, 6 << 20])
def test_repeats_are_removed_as_by_hand(make_docs, texts, chunk_bytes):
    ids = [*range(len(texts) - 3), None, 0, 0]
    docs = make_docs(texts, ids).repartition(5)
    got = substring_dedup.remove_repeats(docs, chunk_bytes)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "text") == removed_by_hand(list(zip(ids, texts)))


def test_ranges_with_parts_remove_the_same(make_docs, texts, monkeypatch):
    monkeypatch.setattr(substring_dedup, "RANGES", 3, raising=False)
    sent, send = [], substring_dedup._send_anchors
    monkeypatch.setattr(substring_dedup, "_send_anchors", lambda n, *more: sent.append(n) or send(n, *more))
    got = substring_dedup.remove_repeats(make_docs(texts), 4_000)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "text") == removed_by_hand(list(enumerate(texts)))
    substring_dedup.remove_repeats(make_docs(texts), 400)
    assert sent == [3, 3]  # a chunk sends no more rows when there are more chunks


def test_anchors_of_many_chunks_are_shared_in_one_pass():
    rng = np.random.default_rng(3)
    own = [np.unique(rng.integers(0, 1 << 20, 400).astype(np.uint32)) for _ in range(4000)]
    sent = pa.table({"range": [1] * 4000, "chunk": list(range(4000)), "anchors": pa.array([x.tobytes() for x in own], pa.binary())})
    start = time.process_time()
    got = substring_dedup._share_anchors(sent)
    assert time.process_time() - start < 8
    values, counts = np.unique(np.concatenate(own), return_counts=True)
    several = set(values[counts > 1].tolist())
    found = {c: np.frombuffer(b, np.uint32).tolist() for c, b in zip(got["chunk"].to_pylist(), got["anchors"].to_pylist())}
    assert all(found.get(c, []) == [x for x in row.tolist() if x in several] for c, row in enumerate(own))


def test_one_passage_in_many_documents(make_docs):
    """A hot passage, also overlapping itself."""
    passage = " ".join(f"p{i % 5}" for i in range(60))
    texts = [f"u{i} {passage} v{i}" for i in range(60)]
    got = substring_dedup.remove_repeats(make_docs(texts), 500)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "text") == removed_by_hand(list(enumerate(texts)))


def test_empty_tables(spark, make_docs):
    docs = make_docs([])
    assert substring_dedup.remove_repeats(docs).count() == 0
    assert near_dups.near_duplicates(docs).count() == 0
    assert near_dups.keep_one(docs).count() == 0
    assert quality_rules.judge(docs).count() == 0
    assert quality_rules.keep_good(docs).columns == docs.columns
    assert decontaminate.find_contamination(docs, docs.select(F.col("doc_id").alias("item_id"), "text")).count() == 0


def components_by_hand(pairs):
    """(id, set size, component) by comparing all pairs."""
    sets = {}
    for i, text in pairs:
        row = WORD.findall((text or "").translate(LOWER))
        sets[i] = {tuple(row[k : k + 4]) for k in range(max(1, len(row) - 3))} if row else set()
    label = {i: i for i in sets}
    for a, b in itertools.combinations(sets, 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
            low, high = sorted((label[a], label[b]))
            label = {i: low if x == high else x for i, x in label.items()}
    return Counter((i, len(sets[i]), label[i], label[i] == i) for i in sets)


@pytest.mark.parametrize("block", [100, 400_000])
def test_components_match_all_pairs(make_docs, texts, monkeypatch, block):
    find = near_dups.find_links
    monkeypatch.setattr(near_dups, "find_links", lambda sets, rows: find(sets, rows, block))
    got = near_dups.near_duplicates(make_docs(texts).repartition(4))
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == components_by_hand(list(enumerate(texts)))


def test_a_large_group_of_edited_copies(make_docs):
    """Edits of different strength, so that some copies are linked only with each other."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for _ in range(90):
        row = list(base)
        for _ in range(rng.choice([1, 2, 4, 7])):
            row[rng.randrange(len(row))] = f"e{rng.randrange(3)}"
        texts.append(" ".join(row))
    got = near_dups.near_duplicates(make_docs(texts))
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == components_by_hand(list(enumerate(texts)))


def test_missing_and_repeated_ids_in_near_dedup(make_docs):
    text = " ".join(f"x{i}" for i in range(30))
    docs = make_docs([text, text, text, text, "other words here now"], [5, 5, None, 9, None])
    kept = near_dups.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == {5: 2, None: 2}


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (7, 7)], "a bigint, b bigint")
    labels = {r.node: r.label for r in connected(edges).collect()}
    assert labels == {i: 0 for i in range(41)} | {90: 90, 100: 90}


def contamination_by_hand(docs, items):
    cut = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
    windows = defaultdict(set)
    for item, text in items:
        row = cut(text)
        for k in range(max(1, len(row) - 12) if row else 0):
            windows[tuple(row[k : k + 13])].add(item)
    out = Counter()
    for doc, text in docs:
        row, hit, found = cut(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(row) - n + 1):
                if tuple(row[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(row[k : k + n])]
        out[doc, len(row), len(hit), tuple(sorted(map(str, found))), bool(hit) and 20 * len(hit) >= len(row)] += 1
    return out


@pytest.mark.parametrize("block_bytes", [300, 1 << 24])
def test_contamination_as_by_hand(spark, make_docs, texts, block_bytes):
    rng = random.Random(2)
    some = [t for t in texts if t and len(t.split()) > 30]
    items = [(i, " ".join(rng.choice(some).split()[3 : 3 + rng.choice([1, 2, 9, 13, 25])])) for i in range(15)]
    items += [(50, None), (51, ""), (52, "..."), (3, "one"), (53, "unseen words only here")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    mixed = [*texts, "ONE!", "w1-w2"]
    got = decontaminate.find_contamination(make_docs(mixed), benchmark, block_bytes)
    found = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got.collect())
    assert found == contamination_by_hand(list(enumerate(mixed)), items)
    exact_is_near = got.where((F.size("items") > 0) & (F.size("near") == 0)).count()
    assert exact_is_near == 0


def test_proximity_needs_no_exact_phrase(spark, make_docs):
    benchmark = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id bigint, text string")
    docs = make_docs(["delta x gamma y beta z alpha", "alpha " + "f " * 99 + "beta gamma delta"])
    near = {r.doc_id: r.near for r in decontaminate.find_contamination(docs, benchmark).collect()}
    assert near == {0: ["1"], 1: []}


def rules_by_hand(text):
    row = WORD.findall(text or "")
    triples = [tuple(row[k : k + 3]) for k in range(len(row) - 2)]
    counts = Counter(triples)
    again = {j for k, t in enumerate(triples) if counts[t] > 1 for j in (k, k + 1, k + 2)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    failed = len(row) < 50 or 100 * len(again) > 50 * len(row)
    return (
        len(row), sum(map(len, row)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
        len(again), failed,
    )


def test_counted_rules_as_by_hand(make_docs, texts):
    extra = ["a|b #1 <x>\n" * 40, "x y z\n\nx y z\n x y z\n", "é ñ\r\né ñ\r\n"]
    mixed = [*texts, *extra]
    got = quality_rules.judge(make_docs(mixed, langs=[None, "en"] * (len(mixed) // 2) + ["fr"] * (len(mixed) % 2)))
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert rows_of(got, "doc_id", *columns) == Counter((i, *rules_by_hand(t)) for i, t in enumerate(mixed))
    assert got.where("kept and base_failed").count() == 0


def test_kneser_ney_is_a_distribution_and_prefers_what_it_saw():
    import numpy as np

    rng = np.random.default_rng(0)
    codes = np.unique(rng.integers(0, quality_rules.SYMBOLS**4, 5000))
    counts = rng.integers(1, 9, len(codes))
    bits = quality_rules.kneser_ney(codes, counts)
    mass = (2.0 ** -bits.astype(float)).reshape(-1, quality_rules.SYMBOLS).sum(1)
    assert np.allclose(mass, 1, atol=1e-3)
    assert bits[codes].mean() < bits.mean() - 2


def test_perplexity_rejects_noise_and_keeps_prose(make_docs):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("aeioustrnl") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    prose = [" ".join(rng.choice(vocabulary) for _ in range(120)) for _ in range(200)]
    noise = ["".join(rng.choice("qwxzjkvQ#@%^~{}=+09") + " " * (k % 4 == 0) for k in range(700)) for _ in range(3)]
    docs = make_docs(prose + noise)
    kept = {r.doc_id for r in quality_rules.keep_good(docs).collect()}
    assert kept == set(range(200))
    judged = quality_rules.judge(docs)
    assert {r.doc_id for r in judged.where("kept").collect()} == kept
    assert judged.where("not kept and not base_failed").count() == 3


def test_query_digests_are_those_of_the_texts(spark):
    from marketloom.llm.queries import op1_substring_dedup

    row = op1_substring_dedup(spark, "/root/testdata/sf0.001").orderBy("doc_id").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").first().text
    assert row.kept_sha256 == hashlib.sha256(" ".join(WORD.findall(text)).encode()).hexdigest()


def test_index_is_stored_in_small_row_groups(spark, tmp_path, monkeypatch):
    @contextmanager
    def kept(spark, name):
        yield lambda df, table, **options: written(df, table, str(tmp_path), **options)

    monkeypatch.setattr(decontaminate, "scratch_folder", kept)
    words = "array_join(transform(sequence(1, 30000), x -> hex(xxhash64(x, id))), ' ')"
    docs = spark.range(40).coalesce(1).select(F.col("id").alias("doc_id"), F.expr(words).alias("text"))
    benchmark = docs.limit(1).select(F.col("doc_id").alias("item_id"), F.expr("substring(text, 1, 400)").alias("text"))
    assert decontaminate.find_contamination(docs, benchmark).where("n_hit > 0").count() == 1
    files = [pq.ParquetFile(f).metadata for f in tmp_path.glob("postings-*/*.parquet")]
    sizes = [f.row_group(k).total_byte_size for f in files for k in range(f.num_row_groups)]
    assert sum(sizes) > 12 << 20
    assert max(sizes) < 10 << 20


def test_every_text_is_scored_once(make_docs, texts, capsys):
    quality_rules.keep_good(make_docs(texts)).explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1


def test_counts_passed_on_early_add_up(monkeypatch):
    rng = random.Random(5)
    batch = pa.RecordBatch.from_pydict(
        {
            "text": pa.array([" ".join(f"w{rng.randrange(10**6)}" for _ in range(80)) for _ in range(12)]),
            "model": pa.array(["en", "fr", "en"] * 4),
            "half": pa.array([0, 1] * 6, pa.int32()),
        }
    )

    def counts():
        total, parts = Counter(), 0
        for part in quality_rules._count_ngrams(iter([batch, batch])):
            parts += 1
            for model, half, code, n in zip(*(c.to_pylist() for c in part.columns), strict=True):
                total[model, half, code] += n
        return total, parts

    whole, parts = counts()
    monkeypatch.setattr(quality_rules, "OPEN_CHARACTERS", 5000)
    early, more = counts()
    assert early == whole
    assert more > parts
