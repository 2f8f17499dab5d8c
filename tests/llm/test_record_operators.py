"""Operators on single records: personal data, pieces, shards, lengths, licences, sites, pipeline."""

import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketloom.llm import licenses, pieces, pii, sharding, site_quality, token_counts, words
from marketloom.llm.queries import QUERIES, SQL
from marketloom.scratch import written
from tools.check_queries import compare

SF = "/root/testdata/sf0.001"

# The contract's patterns, plainly.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def base_by_hand(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),  # noqa: B023
                "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),  # noqa: B023
                "phone": lambda: 9 <= len(digits) <= 15,  # noqa: B023
            }[kind]()
            if good:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out))


def test_base_spans_as_by_hand(make_docs, texts):
    rng = random.Random(3)
    signs = [
        "1", "23", "4111111111111111", "1.2.3.4", "255.256.1.1", "+", "a@b.c", "x_@d-e.f.g", " ", "-", ".", "@", "5",
        "+1 (555) 123-4567", "0", "é", "\U0001f600", "(", ")", "%", "..", "4",
    ]
    mixed = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(600)] + texts
    mixed += ["1" * 3000, "a" * 9000, "1." * 3000, "1 " * 3000, "a.b@" + "c." * 2000 + "d", "+1" + " " * 2000 + "x"]
    got = pii.with_base_spans(make_docs(mixed)).select("doc_id", pii.span_text(F.col("base")).alias("s"))
    assert {r.doc_id: r.s for r in got.collect()} == {i: base_by_hand(t) for i, t in enumerate(mixed)}


def test_selected_spans_and_redaction(make_docs):
    rng = random.Random(6)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    texts = [f'set token = "{key()}" now' for _ in range(60)] + [f"see {'abcde' * 5} there" for _ in range(60)]
    texts += ["mail a@b.example and call +1 (212) 555-0100 today", None, ""]
    docs = make_docs(texts)
    found = {r.doc_id: r.s for r in pii.find_pii(docs).select("doc_id", pii.span_text(F.col("spans")).alias("s")).collect()}
    assert all(found[i].startswith("key:13:53") for i in range(60))
    assert all(found[i] == "" for i in range(60, 120))
    clean = pii.redact(docs)
    assert clean.columns == docs.columns
    rows = {r.doc_id: r.text for r in clean.collect()}
    assert rows[0] == 'set token = "[key]" now' and rows[60] == texts[60]
    assert rows[120] == "mail [email] and call [phone] today" and rows[121] is None and rows[122] == ""
    assert pii.redact(make_docs([])).count() == 0


def test_every_candidate_counts_in_the_fit(spark):
    """Two held-out candidates of rare kinds among 80,000 have thresholds of their own."""
    held = "pmod(xxhash64(id, cast(1 as int)), 4L) = 0"
    zeros = ", ".join(f"cast(id % 2 * 20 as double) as {name}" for name in pii.FEATURES)
    first = spark.range(80_000).where(held).agg(F.array_sort(F.collect_list("id"))).first()[0]
    kind = f"case id when {first[100]} then 'address' when {first[101]} then 'number' else 'key' end"
    label = f"case when id % 2 = 1 or id in ({first[100]}, {first[101]}) then 1.0D else 0.0D end"
    rows = spark.range(80_000).selectExpr(
        "id as doc_id",
        f"array(struct({kind} as kind, 4 as rank, 0 as start, 1 as end, struct({zeros}) as features, {label} as label)) as candidates",
    )
    assert set(pii.fit_selector(rows)[1]) == {"key", "address", "number"}


def test_selector_is_fitted_on_all_documents(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "fit_selector", lambda rows: seen.append(rows.agg(F.sum(F.size("candidates"))).first()[0]))
    docs = spark.range(50_000).selectExpr("id as doc_id", "concat('see ', sha1(cast(id as string)), ' there') as text")
    assert pii.find_pii(docs).count() == 50_000
    assert seen == [50_000]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces._Vocabulary(pieces.read_model(pieces.MODEL))


def segmentations(text, model, fallback):
    score = dict(zip(model["texts"], model["scores"], strict=True))
    whole = f" {text}" if text else ""

    def rest(at):
        if at == len(whole):
            yield 0.0
            return
        for end in range(at + 1, len(whole) + 1):
            if (piece := whole[at:end].encode()) in score:
                yield from (score[piece] + s for s in rest(end))
        if (sign := whole[at].encode()) not in score:
            yield from (fallback * len(sign) + s for s in rest(at + 1))

    return sorted(rest(0), reverse=True)


def test_n_best_are_the_best_of_all_segmentations(vocabulary):
    rng = random.Random(1)
    model = pieces.read_model(pieces.MODEL)
    texts = ["".join(rng.choice("ab the é▁ \n漢x0") for _ in range(rng.randint(0, 8))) for _ in range(150)]
    _, _, scores, others = pieces.encode_column(pa.array([*texts, None]), vocabulary, 4)
    for text, best, rest in zip([*texts, ""], scores, others, strict=True):
        want = segmentations(text, model, vocabulary.fallback)[:4]
        assert np.allclose([best, *[o["score"] for o in rest]], want, atol=1e-6)


def test_pieces_come_back_as_the_text(make_docs, texts):
    mixed = [*texts, " lead", "trail ", "  ", "\n\n", "▁", "漢字" * 50, "tab\tand\r\nline", "\U0001f600 ▁▁ a"]
    docs = make_docs(mixed)
    encoded = pieces.encode(docs)
    back = {r.doc_id: r.text for r in pieces.decode(encoded).collect()}
    assert back == {i: t or "" for i, t in enumerate(mixed)}
    worst = encoded.select(F.explode("others.score").alias("o"), "score").where("o > score + 1e-6").count()
    assert worst == 0 and pieces.encode(make_docs([])).count() == 0


def test_long_text_without_spaces(vocabulary):
    ends, ids, scores, others = pieces.encode_column(pa.array(["xy" * 20_000, "漢字" * 5_000]), vocabulary, 3)
    assert len(others[0]) == 2 and len(ids) == ends[-1] and np.isfinite(scores).all()


def test_shards_follow_the_key_and_few_rows_move(make_docs):
    texts = [f"t{i % 7}" for i in range(3000)] + [None, "", "same", "same", "é"]
    ids = [*range(3000), None, None, 5, 5, 9]
    docs = make_docs(texts, ids)
    eight, nine = sharding.equal_weights(8), sharding.equal_weights(9)
    rows = sharding.place(docs, "doc_id", "text", eight, nine).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts)
    )
    for shard in range(8):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots))) and abs(len(slots) - 375) < 120
    moved = [r for r in rows if r.shard != r.grown_shard]
    assert {r.grown_shard for r in moved} == {8} and len(moved) < 3000 / 9 * 1.4
    by_key = {}
    assert all(by_key.setdefault(r.doc_id, r.shard) == r.shard for r in rows)
    assert sharding.place(make_docs([]), "doc_id", "text", eight, nine).count() == 0


def test_weights_and_many_copies(make_docs, monkeypatch, tmp_path):
    monkeypatch.setattr(sharding, "COPY_BLOCK", 7)
    docs = make_docs(["x"] * 50 + [f"t{i}" for i in range(2000)], [1] * 50 + list(range(10, 2010)))
    weights = {0: 1.0, 1: 3.0, 2: 0.0}
    rows = sharding.place(docs, "doc_id", "text", weights, weights).collect()
    counts = Counter(r.shard for r in rows)
    assert set(counts) == {0, 1} and 2.4 < counts[1] / counts[0] < 3.7
    assert sorted(r.slot for r in rows if r.shard == 0) == list(range(counts[0]))
    with pytest.raises(ValueError, match="weight"):
        sharding.place(docs, "doc_id", "text", {0: 0.0}, weights)
    sharding.write_shards(docs, "doc_id", weights, str(tmp_path / "shards"))
    again = docs.sparkSession.read.parquet(str(tmp_path / "shards"))
    assert again.count() == 2050 and again.select("shard").distinct().count() == 2


def test_length_histogram_answers_every_limit(spark, make_docs, texts, monkeypatch):
    monkeypatch.setattr(token_counts, "LENGTH_BLOCK", 16)
    counts = token_counts.token_counts(make_docs(texts))
    lengths = sorted(r.n_tokens for r in counts.collect())
    histogram = token_counts.length_histogram(counts)
    rows = histogram.collect()
    assert sorted(r.n_tokens for r in rows) == sorted(set(lengths))
    for r in rows:
        assert r.truncated_tokens == sum(min(n, r.n_tokens) for n in lengths) and r.total_tokens == sum(lengths)
        assert r.docs_longer == sum(n > r.n_tokens for n in lengths)
        assert r.docs_below == sum(n < r.n_tokens for n in lengths)
    limits = [0, 5, 100, 10**6]
    got = {r.limit: (r.docs_cut, r.kept_tokens) for r in token_counts.at_limits(spark, histogram, limits).collect()}
    assert got == {n: (sum(x > n for x in lengths), sum(min(x, n) for x in lengths)) for n in limits}
    half = token_counts.length_quantile(histogram, 0.5).first().n_tokens
    assert half == lengths[(len(lengths) + 1) // 2 - 1]
    assert token_counts.length_histogram(token_counts.token_counts(make_docs([]))).count() == 0


def test_long_white_space_is_encoded_as_ever(monkeypatch):
    with open(token_counts.VOCABULARY, "rb") as file:
        encoding = token_counts._encoding(file.read(), token_counts.PATTERN)
    plain = re.compile(token_counts._LONG_SPACE.pattern.replace("10000", "3"))
    monkeypatch.setattr(token_counts, "_LONG_SPACE", plain)
    for text in ("a    b", "   ", "x   \n\n\n  y    ", "a\x1c\x1c\x1c\x1c b", "    a", "a" + " \n" * 50):
        assert token_counts.encode_length(encoding, text) == len(encoding.encode_ordinary(text))
    monkeypatch.undo()
    assert token_counts.encode_length(encoding, "a" + " " * 200_000 + "b") > 1


def test_licences_match_sql_and_prune_exactly(spark, make_docs):
    rng = random.Random(9)
    texts = [None, "", "mit", "RELEASED under\tthe MIT License!!", "x\n\nLicensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0\n"]
    for text in licenses.TEMPLATES.values():
        for cut in (0, 1, 3):
            row = text.split()
            for _ in range(cut):
                row[rng.randrange(len(row))] = "zz"
            texts += [" ".join(row), "before\n" + " ".join(row[:-1]) + "\nafter", "\n".join([" ".join(row)] * 3)]
    docs = make_docs(texts)
    con = duckdb.connect()
    frame = docs.select("doc_id", "text").toPandas()
    con.register("documents", frame)
    want = con.sql(licenses.oracle()).df()
    assert compare(licenses.scan_licenses(docs).toPandas(), want) == "" and len(want) > len(licenses.TEMPLATES)
    assert licenses.scan_licenses(make_docs([])).count() == 0
    assert licenses.scan_licenses(docs, {}).count() == 0


def test_needed_words_leave_too_few_bigrams():
    for text in licenses.TEMPLATES.values():
        row = re.sub("[^a-z0-9]+", " ", text.lower()).split()
        pairs = set(itertools.pairwise(row))
        needed = set(licenses.needed_words(row, 2 / 3))
        assert len([p for p in pairs if not needed & set(p)]) < 2 / 3 * len(pairs)


def test_classifier_is_right_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    scored = site_quality.score_sites(docs, labels.where(~held), F.col("source"), site_quality.section("source", "lang"))
    checked = scored.join(labels.where(held), "doc_id")
    right = checked.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("double"))).first()[0]
    lost = checked.where("quality = 1 and not kept").count()
    assert right > 0.93 and lost <= 2


def test_sparse_sites_shrink_toward_their_priors(spark):
    rows = [("big", "big/a", 0.9)] * 300 + [("big", "big/b", 0.2)] * 200 + [("big", "big/c", 0.05)] * 2
    rows += [("bad", "bad/a", 0.1)] * 150 + [("tiny", "tiny/a", 0.05), (None, None, 0.6)]
    rows = [(h, p, v + 0.05 * ((i % 3) - 1)) for i, (h, p, v) in enumerate(rows)]
    sites, mean = site_quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double"))
    got = {r.path: r for r in sites.collect()}
    assert len(got) == 6 and 0.4 < mean < 0.7
    assert got["big/a"].path_posterior > got["big/b"].path_posterior > got["big/c"].path_posterior
    assert got["tiny/a"].path_posterior > 0.05 - 1e-9
    assert got["bad/a"].host_posterior < 0.2


def test_site_scores_of_awkward_rows(spark, make_docs, texts):
    docs = make_docs(texts)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    one = spark.createDataFrame([(1, 1), (2, None), (3, 7)], "doc_id bigint, quality int")
    for labels in (none, one):
        scored = site_quality.score_sites(docs, labels, F.col("source"), F.lit(None))
        assert scored.where(F.col("score").isNull() | F.isnan("score")).count() == 0
        assert scored.count() == len(texts)
    assert site_quality.score_sites(make_docs([]), none, F.col("source"), F.col("lang")).count() == 0


def test_pipeline_stages_do_what_they_say(spark, make_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
            assert out.select("doc_id").exceptAll(docs.select("doc_id")).count() == 0
        docs = written(out, "stage")
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and 0 < seen[-1] < 200
    assert pieces.decode(docs).where("text = ''").count() == 0
    assert corpus_pipeline.run(spark, SF).count() == seen[-1]


def test_deduplicating_stages_leave_small_tables(spark, tmp_path, monkeypatch):
    """What near-dedup and decontamination store on their way is gone when their result is read."""
    monkeypatch.setattr("marketloom.scratch.scratch_root", lambda spark: str(tmp_path))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [stage(spark, docs, SF).count() for _, stage in corpus_pipeline.STAGES[1:3]]
    assert 0 < min(kept) <= docs.count()
    left = {p.parent.name.rsplit("-", 1)[0] for p in tmp_path.rglob("*.parquet")}
    assert left <= {"copies", "dirty", "edges", "labels", "hits"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    assert compare(QUERIES[name](spark, SF).toPandas(), con.sql(SQL[name]).df()) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_queries_return_rows(spark, name):
    rows = QUERIES[name](spark, SF)
    assert rows.count() > 0


def test_remembered_words_change_no_result(monkeypatch):
    model = pieces.read_model(pieces.MODEL)
    texts = ["the cat sat on the mat", "", "a cat, the hat\nand 漢字 " * 30, None, "x" * 500, "the cat sat on the mat"]
    known = pieces._Vocabulary(model)

    def each(vocabulary_of):
        rows = []
        for text in texts * 2:
            _, ids, scores, others = pieces.encode_column(pa.array([text], pa.string()), vocabulary_of(), 4)
            rows.append((ids.tolist(), scores.tolist(), others))
        return rows

    fresh = each(lambda: pieces._Vocabulary(model))
    assert each(lambda: known) == fresh
    monkeypatch.setattr(pieces, "_KNOWN_WORDS", 2)
    monkeypatch.setattr(pieces, "_KNOWN_RANKED", 1)
    monkeypatch.setattr(pieces, "_LATTICE", 8)
    assert each(lambda: known) == fresh


def test_worker_drops_what_other_operators_keep():
    words.worker_cache("one")["table"] = 1
    words.start_in_worker("other")
    assert words.worker_cache("one") == {}
