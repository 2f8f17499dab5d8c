"""Language model, manifest and audit against brute force; awkward rows of judged and redacted texts."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketloom.llm import class_lm, divergence, merkle, pieces, pii, quality_rules, queries

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Class-based language model


def held_out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def test_counts_and_base_score_as_by_hand(make_docs, texts, monkeypatch):
    monkeypatch.setattr(class_lm, "_BLOCK", 3000)
    ids = [*range(len(texts) - 3), None, 9, 9]
    docs = make_docs(texts, ids).repartition(3)
    cut = [WORD.findall((t or "").translate(LOWER)) for t in texts]
    trained = [row for i, row in zip(ids, cut) if not held_out(i)]
    counts = Counter(w for row in trained for w in row)
    n, v = sum(counts.values()) + len(trained), len(counts) + 1

    def base(row):
        return sum(math.log10((c + 1) / (n + v + 1)) for c in [*(counts[w] for w in row), len(trained)])

    want = Counter(
        (i, held_out(i), len(row) + 1, sum(counts[w] > 0 for w in row) + 1, n, round(base(row), 6)) for i, row in zip(ids, cut)
    )
    got = class_lm.score_texts(docs, rounds=2).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_classes_tell_word_kinds_apart_and_score_better_than_words_alone(make_docs):
    rng = random.Random(3)
    first, second = ([f"{letter}{k}" for k in range(150)] for letter in "xy")
    texts = [" ".join(rng.choice((first, second)[k % 2]) for k in range(60)) for _ in range(600)]
    blocks = class_lm.encode_blocks(make_docs(texts))
    model, seen = class_lm.fit(blocks, class_lm.count_words(blocks), rounds=4)
    assert seen[-1] > seen[0]
    held = [r for r in class_lm.score_texts(make_docs(texts)).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.1 * sum(r.n_tokens for r in held)


def test_best_class_is_the_one_with_the_greatest_likelihood(monkeypatch):
    monkeypatch.setattr(class_lm, "CLASSES", 4)
    rng = np.random.default_rng(1)
    for _ in range(20):
        n_words = 12
        pairs = rng.integers(0, 6, (n_words, n_words)).astype(float)
        of = np.append(rng.integers(0, 4, n_words - 2), [4, 5])  # two words cannot move

        def table(of, pairs=pairs):
            out = np.zeros((6, 6))
            np.add.at(out, (of[:, None], of[None, :]), pairs)
            return out

        word = int(rng.integers(0, n_words - 2))
        right, left = (np.bincount(of, weights=x, minlength=6) for x in (pairs[word], pairs[:, word]))
        moved = [class_lm.likelihood(table(np.where(np.arange(n_words) == word, c, of))) for c in range(4)]
        found = class_lm.best_class(right, left, pairs[word, word], int(of[word]), table(of))
        assert moved[found] == pytest.approx(max(moved))


def test_class_probabilities_are_a_distribution():
    cube = np.random.default_rng(2).integers(0, 3, (class_lm.ALL_CLASSES,) * 3).astype(float)
    cube[5] = 0
    assert np.allclose(class_lm.witten_bell(cube).sum(1), 1)
    assert np.allclose(class_lm.witten_bell(0 * cube).sum(1), 1)


# Merkle manifest


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, lower=False):
    values = dict(row, text=row["text"].translate(LOWER) if lower and row["text"] is not None else row["text"])
    parts = ["-" if values[c] is None else f"{len(str(values[c]).encode())}:{values[c]}" for c in merkle.FIELDS]
    return digest("".join(parts))


def proofs(nodes):
    """Root of a list of digests, and for each its siblings level by level, as (left, right)."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(places):
            run = nodes[place // 8 * 8 : place // 8 * 8 + 8]
            paths[k].append(("".join(run[: place % 8]), "".join(run[place % 8 + 1 :])))
        nodes = [digest("".join(nodes[a : a + 8])) for a in range(0, len(nodes), 8)]
        places = [place // 8 for place in places]
    return nodes[0], paths


def manifest_by_hand(rows):
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row["lang"]].append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted(by_lang[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees[lang] = own, *proofs([leaf_of(r) for r in own])
    root, upper = proofs([trees[lang][1] for lang in langs])
    out = Counter()
    for lang, above in zip(langs, upper):
        own, subroot, paths = trees[lang]
        for row, path in zip(own, paths):
            changed = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0
            folded = leaf_of(row, changed)
            for left, right in path + above:
                folded = digest(left + folded + right)
            proof = digest("".join(a + b for a, b in path + above))
            out[row["doc_id"], leaf_of(row), subroot, root, proof, folded, folded == root] += 1
    return out


@pytest.mark.parametrize("n", [1, 8, 9, 64, 65, 600])
def test_manifest_as_by_hand(make_docs, n):
    rng = random.Random(n)
    ids = [rng.choice([None, *range(max(2, n // 2))]) if n > 8 else k for k in range(n)]
    langs = [rng.choice([None, "", "de", "en", "Ω", "z"][: 1 + n // 8]) for _ in range(n)]
    texts = [rng.choice([None, "", "Ein Text", "TEXT é", "x" * 50]) for _ in range(n)]
    docs = make_docs(texts, ids, langs).repartition(5)
    rows = [r.asDict() for r in docs.select(*merkle.FIELDS).collect()]
    found = merkle.verify(merkle.manifest(docs)).withColumn("proof", F.sha2(merkle.proof_text(F.col("path")), 256))
    got = found.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified").collect()
    assert Counter(tuple(r) for r in got) == manifest_by_hand(rows)


def test_many_copies_of_a_row_get_a_place_each(spark, make_docs, monkeypatch):
    row = make_docs(["Copy"], [4]).crossJoin(spark.range(700)).drop("id")
    got = merkle.manifest(row).select("root", "path").distinct().collect()
    want, paths = proofs([leaf_of({"doc_id": 4, "source": "s", "lang": "en", "n_chars": 4, "text": "Copy"})] * 700)
    assert {r.root for r in got} == {want}
    assert {tuple((p.left, p.right) for p in r.path) for r in got} == {tuple(p) for p in paths}


# Source divergence


def audit_by_hand(rows, min_docs, top):
    docs_of, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        docs_of[lang or ""].update(set(found))
        counts[lang or "", source or ""].update(found)
    out = set()

    def ranked(lang, source, part, values, limit):
        order = sorted(values, key=lambda x: (-x[1], x[0].encode()))
        out.update((lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(order[:limit]))

    for lang, seen in docs_of.items():
        kept = [t for t, n in seen.items() if n >= min_docs]
        groups = [s for name, s in counts if name == lang]

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in groups}
        q = shares(sum((counts[lang, s] for s in groups), Counter()))
        for s in groups:
            others = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in groups if o != s]
            ranked(lang, s, "pair", others, None)
            ranked(lang, s, "term", [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]], top)
    return out


def test_divergence_as_by_hand(spark, monkeypatch):
    rng = random.Random(6)
    stock = ["the", "The", "a,b", "don't", "é", "É!", "x9y", "漢字", "...", "42", "rare", "end.", "end", "(the"]
    rows = [
        (rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", None, "s3"]), rng.choice(
            [None, "", "\x0b \n", " ".join(rng.choice(stock) for _ in range(rng.choice([1, 5, 40])))]))
        for _ in range(300)
    ]
    rows += [("fr", "lonely", "nothing kept here"), ("fr", None, None), *[("en", "s1", "the the end")] * 40]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, n bigint, item string")
    monkeypatch.setattr(divergence, "_SLICE", 500)
    for min_docs in (1, 12, 30):
        got = divergence.audit_sources(docs.repartition(4), min_docs, top=5).collect()
        assert len(got) == len(set(got))
        assert {tuple(r) for r in got} == audit_by_hand(rows, min_docs, 5)


def test_terms_of_much_text_are_counted_in_little_memory():
    """48 MB in one batch, nearly all words new; a document's terms in two chunks count as one document."""
    rng = np.random.default_rng(3)
    letters = rng.choice(list(b"abcdefghij     "), (3000, 16_000)).astype(np.uint8)
    texts = pa.array([row.tobytes().decode() for row in letters] + ["Mix,mix (MIX) mix"])
    batch = pa.RecordBatch.from_arrays([texts, pa.array(["en"] * 3001), pa.array(["s"] * 3001)], ["text", "lang", "source"])
    tracemalloc.start()
    seen = Counter()
    for out in divergence._count_terms(iter([batch])):
        seen.update({c: sum(n for t, n in zip(out["term"].to_pylist(), out[c].to_pylist(), strict=True) if t == "mix") for c in ("n", "docs")})
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == {"n": 4, "docs": 1}
    assert peak < 300 << 20


def test_empty_tables_of_corpus_operators(make_docs):
    none = make_docs([])
    assert class_lm.score_texts(none).collect() == []
    assert merkle.verify(merkle.manifest(none)).collect() == []
    assert divergence.audit_sources(none).collect() == []
    assert quality_rules.judge(none).collect() == []
    assert quality_rules.keep_good(none).collect() == []
    assert pii.redact(none).collect() == []
    assert pieces.decode(pieces.encode(none)).collect() == []


# Quality rules


@pytest.mark.parametrize("letters, signs", [("абвгдежзик", "щъыьэюяфхц"), ("αβγδεζηθικ", "λμνξοπρσςτ")])
def test_perplexity_in_other_scripts(make_docs, letters, signs):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(200)]
    prose = [" ".join(rng.choice(vocabulary) for _ in range(120)) for _ in range(150)]
    noise = [" ".join("".join(rng.choice(letters + signs) for _ in range(5)) for _ in range(120)) for _ in range(3)]
    kept = {r.doc_id for r in quality_rules.keep_good(make_docs(prose + noise)).collect()}
    assert kept == set(range(150))


def test_character_model_is_a_distribution_over_all_characters():
    rng = np.random.default_rng(2)
    text = "".join(rng.choice(list("abc AÉé漢字的е5.$"), 4000))
    data = np.frombuffer(text.encode(), np.uint8)
    code, pair, bounds = quality_rules._codes(data, np.array([0, len(data)]))
    assert [chr(p & 0x1FFFFF) for p in pair] == list(text) and [chr(p >> 21) for p in pair] == list(" " + text[:-1])
    assert bounds.tolist() == [0, len(text)] and len(code) == len(text)
    model = quality_rules.character_model(*np.unique(pair, return_counts=True))
    points = np.arange(0x110000)
    for before in "a漢q":
        share = 2.0 ** -model.bits((ord(before) << 21) | points)
        assert np.allclose(np.bincount(quality_rules.symbols(points), share, 30), 1, atol=1e-6)


def test_letters_of_one_symbol_are_told_apart(make_docs):
    """Texts in letters that fold to the same symbols as those of all other texts."""
    rng = random.Random(9)
    letters = [chr(0x4E00 + 26 * k) for k in range(6)] + [chr(0x4E01 + 26 * k) for k in range(6)]
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 5))) for _ in range(100)]
    prose = [" ".join(rng.choice(vocabulary) for _ in range(100)) for _ in range(100)]
    strange = [text.translate({ord(c): chr(ord(c) + 26 * 300) for c in letters}) for text in prose[:2]]
    docs = make_docs(prose + strange)
    assert {r.doc_id for r in quality_rules.keep_good(docs).collect()} == set(range(100))


def test_ngrams_are_those_of_the_characters():
    texts = ["", "a", "Abc", "ÉÀ漢字е\t", "", "x\U0001f600yz", "xy"]
    raw = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    grams, ends = quality_rules.ngrams(np.frombuffer(b"".join(raw), np.uint8), bounds)
    units = [[int.from_bytes(u[k : k + 2], "little") for k in range(0, len(u), 2)] for u in (t.encode("utf-16-le") for t in texts)]
    assert np.diff(ends).tolist() == [len(u) for u in units]
    padded = [[0x20] * 3 + u for u in units]
    want = [sum(x << 16 * (3 - k) for k, x in enumerate(p[at : at + 4])) for p in padded for at in range(len(p) - 3)]
    assert grams.tolist() == want


def test_ngram_model_is_a_distribution_over_characters():
    text = "".join(np.random.default_rng(6).choice(list("abAB é漢.5"), 20000))
    data = np.frombuffer(text.encode(), np.uint8)
    grams, _ = quality_rules.ngrams(data, np.array([0, len(data)]))
    model = quality_rules.ngram_model(*np.unique(grams, return_counts=True))
    for before in ("abA", "漢é ", "5.B", "zzz"):
        code = sum(ord(c) << 16 * (3 - k) for k, c in enumerate(before))
        share = 2.0 ** -model.bits(np.uint64(code) | np.arange(1 << 16, dtype=np.uint64))
        assert 0.95 < share.sum() < 1 + 1e-6  # the coarse model also knows points beyond U+FFFF


def test_characters_before_are_not_folded(spark, make_docs):
    """Prose, and texts with the same symbols and pairs of characters in another order."""
    rng = random.Random(12)
    stems = ["".join(rng.choice("mnrstul") for _ in range(rng.randint(1, 3))) for _ in range(60)]

    def text(*tails):
        return " ".join(rng.choice(stems) + rng.choice(tails) for _ in range(90))

    prose = [text("yab", "YaB") for _ in range(120)]
    strange = [text("yaB", "Yab") for _ in range(3)]
    docs = make_docs(prose + strange)
    judged = quality_rules.judge(docs)
    assert {r.doc_id for r in judged.where("kept").collect()} == set(range(120))
    assert judged.where("base_failed").count() == 0
    assert {r.doc_id for r in corpus_pipeline.quality(spark, docs, "").collect()} == set(range(120))


def test_verdicts_do_not_depend_on_other_languages_or_groups(make_docs, monkeypatch):
    rng = random.Random(5)
    prose = [" ".join(rng.choice(["aba", "cadab", "ra", "hokus", "pokus"]) for _ in range(60 + k % 9)) for k in range(40)]
    alone = {r.doc_id: r.bits for r in quality_rules.judge(make_docs(prose)).collect()}
    langs = ["en"] * 40 + [f"l{k % 40}" for k in range(80)]
    monkeypatch.setattr(quality_rules, "GROUP_NGRAMS", 1000)
    monkeypatch.setattr(quality_rules, "TABLES", 2)
    docs = make_docs(prose + prose + prose, range(120), langs)
    among = {r.doc_id: r.bits for r in quality_rules.judge(docs).where("doc_id < 40").collect()}
    assert among == pytest.approx(alone)
    assert quality_rules.keep_good(docs).count() == quality_rules.judge(docs).where("kept").count()


# Personal data and pieces


@pytest.mark.parametrize(
    "unit, start",
    [(".a", "x(at)y"), ("k9", "token="), ("12 ", "+"), ("a@b.cd ", ""), ("1.2.3.4 ", ""), (" a(dot)b", "me [at] ")],
)
def test_long_texts_of_each_sign(make_docs, unit, start):
    text = start + unit * (60_000 // len(unit))
    docs = make_docs([text, "plain"])
    assert pii.find_pii(docs).count() == 2
    assert pii.redact(docs).where(F.col("text") == "plain").count() == 1


def test_spans_of_a_dense_text_are_where_the_pattern_says(make_docs):
    text = "é " + "a@b.cd é " * 3000
    row = pii.find_pii(make_docs([text])).first()
    assert [(s.start, s.end) for s in row.base] == [m.span() for m in re.finditer(r"a@b\.cd", text)]
    assert pii.redact(make_docs([text])).first().text == "é " + "[email] é " * 3000


def test_pieces_of_missing_and_repeated_ids(make_docs, monkeypatch, spark):
    texts = ["one text", "another text", "a third"]
    docs = make_docs(texts, [1, 1, None])
    monkeypatch.setattr(queries, "_table", lambda *_: docs)
    got = queries.op8_sentencepiece(spark, "").collect()
    want = Counter((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in zip([1, 1, None], texts))
    assert Counter((r.doc_id, r.decoded_sha256) for r in got) == want
