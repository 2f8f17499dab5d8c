"""Personal data: exact base patterns, and further spans that boosted trees select.

Base spans are the leftmost non-overlapping matches of four patterns that pass a
check. High-recall generators propose more spans, which may overlap: runs that
look like keys, numbers written in parts, and addresses in disguise. Gradient
boosted trees score their format and context, and a span is redacted from a
threshold on that is set per generator for precision on held-out candidates.
Rules that need strong context label the training candidates.

All of it is DataFrame functions and Spark's own trees; the fitted trees become
column expressions. All texts are scanned twice, once for the candidates that the
trees are fitted on and once for the spans, and never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.scratch import written

# The base patterns, in the order that breaks ties. The possessive
# forms match what the plain ones do, without stepping back in long runs.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])(?=(?:[0-9][ -]?){11}[0-9])[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# A text without this sign cannot match.
_SIGN = {"email": "@", "ip": ".", "phone": "+"}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

GENERATORS = {
    "key": r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{20,}+",
    "number": r"(?<![0-9])[0-9]++(?:[ ().-]{1,2}[0-9]++)++",
    "address": rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{{1,63}}(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{{1,63}}+)++",
}
_GENERATOR_SIGN = {"address": "at"}
_CONTEXT = 32
# What the labelling rules look at is not among them.
FEATURES = ("kind", "size", "digits", "letters", "capitals", "separators", "turns", "secret", "contact", "quoted")

TREES, DEPTH = 10, 3
# A fourth of the candidates is held out; thresholds keep this precision there.
PRECISION = 0.95
_STEPS = 50


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has the right check digit."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: F.coalesce(F.try_to_number(d, F.lit("9")), F.lit(0)).cast("int"))
    weighed = F.transform(values, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(weighed, F.lit(0), lambda a, d: a + d) % 10 == 0


def _found(text: Column, pattern: str, sign: str | None) -> tuple[Column, Column]:
    """What stands between matches, and the matches."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if sign is None:
        return gaps, hits
    none = F.array().cast("array<string>")
    has = F.contains(text, F.lit(sign))
    return F.when(has, gaps).otherwise(none), F.when(has, hits).otherwise(none)


def _scanned(items: Column, zero: Column, step: Callable[[Column, Column], Column], form: Callable[[Column, Column], Column]) -> Column:
    """form(state before, item) of every item, where `step` leads from one state to the next.

    Items go in blocks of about the root of their number: an array that grows by
    one item at a time is copied each time, so it must stay short.
    """

    def grow(so_far: Column, value: Column) -> Column:
        return F.concat(so_far, F.array(value))

    def states(first: Column, rows: Column, ahead: Callable[[Column, Column], Column]) -> Column:
        """The state before each row, and after the last one."""
        return F.aggregate(rows, F.array(first), lambda seen, row: grow(seen, ahead(F.element_at(seen, -1), row)))

    def formed(rows: Column, first: Column) -> Column:
        """All rows of a block, from its first state on."""
        before = F.slice(states(first, rows, step), 1, F.size(rows))
        return F.zip_with(rows, before, lambda row, state: form(state, row))

    def joined(blocks: Column) -> Column:
        opening = states(zero, blocks, lambda state, block: F.aggregate(block, state, step))
        return F.flatten(F.zip_with(blocks, F.slice(opening, 1, F.size(blocks)), formed))

    def cut(rows: Column) -> Column:
        n = F.size(rows)
        width = F.ceil(F.sqrt(n)).cast("int")
        block_no = F.sequence(F.lit(0), F.ceil(n / width).cast("int") - 1)
        return F.when(n > 0, _once(F.transform(block_no, lambda b: F.slice(rows, b * width + 1, width)), joined))

    return _once(items, cut)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where the value is computed one time however often it is used."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def _spans(gaps: Column, hits: Column) -> Column:
    """(start, end, text) of every match, in code points."""
    sizes = F.zip_with(gaps, hits, lambda g, h: F.struct(F.length(g).alias("gap"), F.length(h).alias("hit"), h.alias("text")))
    sizes = F.filter(sizes, lambda x: x["text"].isNotNull())

    def span(at: Column, x: Column) -> Column:
        start = at + x["gap"]
        return F.struct(start.alias("start"), (start + x["hit"]).alias("end"), x["text"].alias("text"))

    found = _scanned(sizes, F.lit(0), lambda at, x: at + x["gap"] + x["hit"], span)
    return F.coalesce(found, F.array().cast("array<struct<start:int,end:int,text:string>>"))


def _valid(kind: str, text: Column) -> Column:
    digits = F.length(_digits(text))
    if kind == "ip":
        return text.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return digits.between(12, 19) & luhn(_digits(text))
    if kind == "phone":
        return digits.between(9, 15)
    return F.lit(True)


def _checked(spans: Column, rank: int, kind: str) -> Column:
    """The spans that pass the check of their kind, in sorting form."""
    good = F.filter(spans, lambda s: _valid(kind, s["text"]))
    form = lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
    )
    return F.transform(good, form)


def with_base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with a column `base`: kind, rank, start and end of every base span."""
    rows = docs.withColumn("_text", F.coalesce(F.col(text).cast("string"), F.lit("")))
    for kind, pattern in PATTERNS.items():
        gaps, hits = _found(F.col("_text"), pattern, _SIGN.get(kind))
        rows = rows.withColumns({f"_gaps_{kind}": gaps, f"_hits_{kind}": hits})
    for kind in PATTERNS:
        rows = rows.withColumn(f"_{kind}", _spans(F.col(f"_gaps_{kind}"), F.col(f"_hits_{kind}"))).drop(
            f"_gaps_{kind}", f"_hits_{kind}"
        )
    named = [_checked(F.col(f"_{kind}"), rank, kind) for rank, kind in enumerate(PATTERNS)]
    rows = rows.withColumn("base", F.array_sort(F.concat(*named)))
    return rows.drop(*[f"_{kind}" for kind in PATTERNS])


def _context(text: Column, span: Column) -> tuple[Column, Column]:
    begin = F.greatest(F.lit(0), span["start"] - _CONTEXT)
    return F.substring(text, begin + 1, span["start"] - begin), F.substring(text, span["end"] + 1, F.lit(4))


def _count(text: Column, sign: str) -> Column:
    return F.regexp_count(text, F.lit(sign)).cast("double")


def _features(rank: int, text: Column, before: Column, after: Column) -> Column:
    flag = lambda c: c.cast("double")
    digits = _digits(text)
    values = [
        F.lit(float(rank)),
        F.length(text).cast("double"),
        F.length(digits).cast("double"),
        _count(text, "[A-Za-z]"),
        _count(text, "[A-Z]"),
        _count(text, "[^A-Za-z0-9]"),
        _count(text, "[0-9][A-Za-z]"),
        flag(before.rlike("(?i)token|secret|passw|key|auth")),
        flag(before.rlike("(?i)tel|phone|call|fax|mobile|contact|mail|card|account|iban|ssn")),
        flag(after.rlike("^[\"']")),
    ]
    return F.struct(*[v.alias(name) for name, v in zip(FEATURES, values, strict=True)])


def _weak_label(kind: str, text: Column, before: Column) -> Column:
    """1 where strong context or a check says so, for training only."""
    if kind == "key":
        good = before.rlike("(?i)(?:token|secret|passw(?:or)?d|api.?key) ?[=:] ?[\"']?$")
    elif kind == "number":
        digits = _digits(text)
        good = before.rlike(r"\+$") | (F.length(digits).between(12, 19) & luhn(digits))
    else:
        good = text.rlike("[A-Za-z]{2,6}$")
    return F.coalesce(good, F.lit(False)).cast("double")


def _proposed(spans: Column, text: Column, rank: int, kind: str) -> Column:
    """Spans of one generator with their features and training labels."""

    def candidate(s: Column) -> Column:
        before, after = _context(text, s)
        return F.struct(
            F.lit(kind).alias("kind"),
            F.lit(len(PATTERNS) + rank).alias("rank"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            _features(rank, s["text"], before, after).alias("features"),
            _weak_label(kind, s["text"], before).alias("label"),
        )

    return F.transform(spans, candidate)


def with_candidates(rows: DataFrame) -> DataFrame:
    """Adds `candidates`: kind, start, end, features and label of every proposed span outside the base spans."""
    for kind, pattern in GENERATORS.items():
        gaps, hits = _found(F.col("_text"), pattern, _GENERATOR_SIGN.get(kind))
        rows = rows.withColumns({f"_gaps_{kind}": gaps, f"_hits_{kind}": hits})
    for kind in GENERATORS:
        rows = rows.withColumn(f"_{kind}", _spans(F.col(f"_gaps_{kind}"), F.col(f"_hits_{kind}"))).drop(
            f"_gaps_{kind}", f"_hits_{kind}"
        )
    made = [_proposed(F.col(f"_{kind}"), F.col("_text"), rank, kind) for rank, kind in enumerate(GENERATORS)]
    rows = rows.withColumn("candidates", F.concat(*made))
    return rows.drop(*[f"_{kind}" for kind in GENERATORS])


def _tree(node, features: Column) -> Column:
    """A fitted tree as an expression; it has at most 2 ** DEPTH leaves."""
    if node.numDescendants() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    test = features[FEATURES[split.featureIndex()]] <= F.lit(float(split.threshold()))
    return F.when(test, _tree(node.leftChild(), features)).otherwise(_tree(node.rightChild(), features))


def _margin(model, features: Column) -> Column:
    trees = [
        _tree(tree._java_obj.rootNode(), features) * F.lit(float(weight))
        for tree, weight in zip(model.trees, model.treeWeights, strict=True)
    ]
    return 1 / (1 + F.exp(-2 * reduce(Column.__add__, trees)))


def fit_selector(rows: DataFrame):
    """The fitted trees and a threshold by kind, or None where the candidates are all of one label.

    Every candidate counts: a fourth of them, by hash, sets the thresholds, and the
    trees are fitted on all others. Candidates with the same features and label are
    one row that weighs as much as they are many.
    """
    candidates = rows.select("doc_id", F.explode("candidates").alias("c")).select(
        F.col("c.kind").alias("name"),
        F.col("c.label").alias("label"),
        F.col("c.features").alias("f"),
        (F.pmod(F.xxhash64("doc_id", "c.end"), F.lit(4)) == 0).alias("held"),
    )
    counted = candidates.groupBy("name", "label", "f", "held").agg(F.count(F.lit(1)).cast("double").alias("n"))
    counted = written(counted, "candidates")
    train = counted.where(~F.col("held"))
    if train.select("label").distinct().count() < 2:
        return None
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(train.select("label", "n", "f.*"))
    trees = GBTClassifier(featuresCol="vector", labelCol="label", weightCol="n", maxIter=TREES, maxDepth=DEPTH, seed=7)
    model = trees.fit(assembled)
    scored = counted.where("held").select("name", "label", "n", F.floor(_margin(model, F.col("f")) * _STEPS).alias("step"))
    good_n = F.sum(F.col("label") * F.col("n")).alias("good")
    steps = scored.groupBy("name", "step").agg(good_n, F.sum("n").alias("n")).collect()
    thresholds = {}
    for kind in GENERATORS:  # at most _STEPS rows each
        own = sorted(((r["step"], r["good"], r["n"]) for r in steps if r["name"] == kind), reverse=True)
        good = n = 0.0
        for step, g, k in own:
            good, n = good + g, n + k
            if good >= PRECISION * n and good > 0:
                thresholds[kind] = step / _STEPS
    return model, thresholds


def find_pii(docs: DataFrame) -> DataFrame:
    """Every row of `docs` (doc_id, text) with its spans of personal data.

    Returns the columns of `docs` in a struct `row`, doc_id, base (kind, start,
    end of the base spans) and spans (these and the selected candidates that
    overlap none of them), in order of start and kind, in code points.

    Defined cases: NULL and empty texts have no spans; repeated rows are scanned
    each; where the candidates give no training data only base spans are found;
    an empty table gives an empty result; other columns are not read.
    """
    slim = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    training = with_candidates(slim.select("doc_id", "text").withColumn("_text", F.coalesce("text", F.lit(""))))
    fitted = fit_selector(training.select("doc_id", "candidates"))
    based = with_base_spans(slim)
    if fitted is None or not fitted[1]:
        return based.select("row", "doc_id", "base", F.col("base").alias("spans"))
    model, thresholds = fitted
    scored = with_candidates(based)
    least = F.create_map(*[F.lit(x) for pair in thresholds.items() for x in pair])
    score = lambda c: F.floor(_margin(model, c["features"]) * _STEPS) / _STEPS
    free = lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    chosen = F.filter("candidates", lambda c: F.coalesce(score(c) >= least[c["kind"]], F.lit(False)) & free(c))
    added = F.transform(chosen, lambda c: F.struct(*[c[n].alias(n) for n in ("start", "rank", "end", "kind")]))
    return scored.select("row", "doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def n_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def redact(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with every span of personal data in `text` replaced by its kind in brackets.

    Overlapping spans become one, named after the first; a NULL text stays NULL.
    """
    found = find_pii(docs)
    text = F.col("row.text").cast("string")

    def piece(at: Column, s: Column) -> Column:
        """Text from the end of all spans before, and the mark; nothing for a span that starts before that end."""
        gap = F.substring(text, at + 1, s["start"] - at)
        return F.when(s["start"] >= at, F.concat(gap, F.lit("["), s["kind"], F.lit("]"))).otherwise(F.lit(""))

    pieces = _scanned(F.col("spans"), F.lit(0), lambda at, s: F.greatest(at, s["end"]), piece)
    rest = F.substring(text, F.array_max(F.col("spans")["end"]) + 1, F.length(text))
    cleaned = F.concat(F.array_join(pieces, ""), rest)
    safe = F.when(F.size("spans") > 0, cleaned).otherwise(text)
    columns = [safe.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    return found.select(*columns)
