"""Source divergence audit: how far the term shares of a language's sources lie apart.

A term is a run of bytes of one class, so terms are cut from the bytes of some
texts at a time. Every document lies whole in one such slice: the numbers of
occurrences and of documents of a term by language and source are sums over the
slices, which Spark adds up, and no document is looked at twice.

Shares are whole numbers. Terms that neither of two sources has add the same to
their distance, and terms of one alone depend on the other's least share only,
so a pair of sources costs the terms that both have, not the vocabulary.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.llm.words import Words, byte_class, find_words, ranges, slices
from marketloom.scratch import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 30
# Added to every count of a term.
PRIOR = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
# Text whose terms are counted at one time; the arrays take some 30 times as much.
_SLICE = 4 << 20
# The bytes of TERM; those of code points beyond ASCII are all among them.
_TERM_BYTES = byte_class((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_COUNTED = "lang string, source string, term string, n bigint, docs bigint"


def _strings(words: Words, at: np.ndarray) -> pa.Array:
    """The words at the given places as a string column."""
    sizes = (words.ends - words.starts)[at]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = words.data[ranges(words.starts[at], sizes)]
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_string(), len(at), buffers).cast(pa.string())


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by language and source, of some texts at a time."""
    for batch in slices(batches, limit=_SLICE):
        words = find_words(batch.column("text"), _TERM_BYTES, lower=True)
        groups: dict[tuple[str, str], int] = {}
        names = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
        of_text = np.array([groups.setdefault(name, len(groups)) for name in names], np.int64)
        kinds, at, local = np.unique(words.codes, return_index=True, return_inverse=True)
        width = max(len(kinds), 1)
        in_text, n = np.unique(words.text_of_word() * width + local, return_counts=True)
        in_group = of_text[in_text // width] * width + in_text % width
        order = np.argsort(in_group)
        in_group, n = in_group[order], n[order]
        first = np.flatnonzero(np.append(True, in_group[1:] != in_group[:-1])) if len(n) else np.zeros(0, np.int64)
        langs, sources = (pa.array(x, pa.string()) for x in zip(*groups, strict=True))
        take = pa.array(in_group[first] // width)
        columns = [
            langs.take(take),
            sources.take(take),
            _strings(words, at[in_group[first] % width]),
            pa.array(np.add.reduceat(n, first) if len(first) else n),
            pa.array(np.diff(np.append(first, len(n))).astype(np.int64)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


def _share(count: str, total: str, n_terms: str) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * n_terms)), exact; NULL without terms."""
    above = f"cast({SCALE} as decimal(10, 0)) * cast({count} + {PRIOR} as decimal(20, 0))"
    below = f"nullif(cast({total} + {PRIOR} * {n_terms} as decimal(20, 0)), 0)"
    return F.expr(f"1 + ({above} div {below})")


def _pairs(groups: DataFrame, cells: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language, from the cells with a count."""
    other = groups.select(F.col("lang").alias("_lang"), F.col("source").alias("item"), F.col("zero").alias("other_zero"))
    pairs = groups.join(other, (groups["lang"] == other["_lang"]) & (groups["source"] != other["item"])).drop("_lang")

    # Terms of one source against the least share of the other: shares and least shares in one order.
    shares = cells.groupBy("lang", "source", F.col("p").alias("v")).agg(F.count(F.lit(1)).alias("m"))
    line = shares.select("lang", "source", "v", "m", F.lit(None).cast("string").alias("item")).union(
        pairs.select("lang", "source", F.col("other_zero").alias("v"), F.lit(0).cast("bigint").alias("m"), "item")
    )
    whole = Window.partitionBy("lang", "source")
    up_to = whole.orderBy("v")
    mass = F.col("m") * F.col("v")
    v, n_below, below = F.col("v"), F.sum("m").over(up_to), F.sum(mass).over(up_to)
    n_all, every = F.sum("m").over(whole), F.sum(mass).over(whole)
    apart = v * n_below - below + (every - below) - v * (n_all - n_below)
    sides = line.select("lang", "source", "item", apart.alias("apart"), n_all.alias("n_own")).where("item is not null")

    # Terms that both have: what the two sides say about them is replaced by the true difference.
    a = cells.select("lang", "term", "source", "p", "zero")
    b = cells.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("zero").alias("other_zero"))
    p, q, zero, other_zero = (F.col(c) for c in ("p", "q", "zero", "other_zero"))
    mend = F.abs(p - q) - F.abs(p - other_zero) - F.abs(zero - q) + F.abs(zero - other_zero)
    common = a.join(b, ["lang", "term"]).where("source < item").groupBy("lang", "source", "item").agg(F.sum(mend).alias("mend"))
    mirrored = common.union(common.select("lang", F.col("item"), F.col("source"), "mend"))

    back = sides.select(
        "lang", F.col("item").alias("source"), F.col("source").alias("item"),
        F.col("apart").alias("back_apart"), F.col("n_own").alias("n_other"),
    )
    keys = ["lang", "source", "item"]
    joined = pairs.join(sides, keys).join(back, keys).join(mirrored, keys, "left")
    rest = (F.col("n_terms") - F.col("n_own") - F.col("n_other")) * F.abs(zero - other_zero)
    value = rest + F.col("apart") + F.col("back_apart") + F.coalesce(F.col("mend"), F.lit(0))
    return joined.select(*keys, F.coalesce(value, F.lit(0)).cast("bigint").alias("value"))


def audit_sources(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """Distances between sources, and the terms that set each source apart, by language.

    `docs` has text, lang and source. A language keeps the terms that stand in at
    least `min_docs` of its documents; each group of (lang, source), and the
    language itself, gives every kept term a whole-number share. Returns lang,
    source, part, item, value and rank. In part `pair` the item is another source
    of the language and the value the sum of the differences of all shares; every
    source of a language stands against every other one. In part `term` the items
    are the `top` terms whose share is furthest above the language's.

    Defined cases: NULL text, lang or source count as the empty string; a group
    without terms has the same share for every kept term; without kept terms all
    distances are 0; every row is a document of its own, also when repeated; ties
    are ordered by the bytes of the item; an empty table gives an empty result;
    other columns are not read.
    """
    slim = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = slim.mapInArrow(_count_terms, _COUNTED)
    terms = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = written(terms, "terms")

    kept = terms.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    kept = written(kept.select("lang", "term"), "kept_terms")
    counts = written(terms.join(kept, ["lang", "term"]).select("lang", "source", "term", "n"), "term_counts")

    n_terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = slim.select("lang", "source").distinct().join(n_terms, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = written(groups.fillna(0, ["n_terms", "total"]).withColumn("zero", _share("0", "total", "n_terms")), "groups")
    cells = counts.join(groups, ["lang", "source"]).withColumn("p", _share("n", "total", "n_terms"))
    cells = written(cells, "cells")

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = _pairs(groups, cells).withColumn("rank", F.row_number().over(by_value))
    in_lang = cells.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    whole = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    against = cells.join(in_lang, ["lang", "term"]).join(whole, "lang")
    against = against.withColumn("q", _share("lang_n", "lang_total", "n_terms")).where("p > q")
    above = against.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    above = above.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)

    def part(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return part(pairs, "pair").unionByName(part(above, "term"))


def oracle() -> str:
    """The same rows as DuckDB SQL, with a count for every kept term and source."""

    def share(count: str, total: str) -> str:
        return f"1 + ({SCALE}::hugeint * ({count} + {PRIOR})) // ({total} + {PRIOR} * v)"

    return f"""
with docs as (select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
        translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') as text from documents),
    found as (select id, lang, source, unnest(regexp_extract_all(text, '{TERM}')) as term from docs),
    kept as (select lang, term from found group by all having count(distinct id) >= {MIN_DOCS}),
    vocabulary as (select lang, count(*) as v from kept group by lang),
    sources as (select distinct lang, source from docs),
    counts as (select lang, source, term, count(*) as n from found group by all),
    cells as (select s.lang, s.source, k.term, coalesce(c.n, 0) as n, v,
            sum(coalesce(c.n, 0)) over (partition by s.lang, s.source) as total
        from sources s join kept k on s.lang = k.lang join vocabulary o on s.lang = o.lang
        left join counts c on c.lang = s.lang and c.source = s.source and c.term = k.term),
    shares as (select *, {share("n", "total")} as p,
            {share("sum(n) over (partition by lang, term)", "sum(n) over (partition by lang)")} as q from cells),
    apart as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
        from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
    pairs as (select a.lang, a.source, b.source as item, coalesce(value, 0) as value
        from sources a join sources b on a.lang = b.lang and a.source <> b.source
        left join apart x on x.lang = a.lang and x.source = a.source and x.item = b.source),
    parts as (select lang, source, 'pair' as part, item, value from pairs
        union all select lang, source, 'term', term, p - q from shares where n > 0 and p > q),
    ranked as (select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as rank from parts)
select lang, source, part, item, value::bigint as value, rank::integer as rank
from ranked where part = 'pair' or rank <= {TOP_TERMS}"""
