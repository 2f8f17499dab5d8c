"""Merkle manifest of a table: one root over all rows, and a proof for each.

Nodes of a tree are numbered, and an aligned block of BLOCK nodes keeps each of
its levels as one string of hex digests. Fixed-width substrings of a level are
the runs whose hashes make the next level; what flanks a digest inside its run
are its siblings. The blocks' own roots are the nodes of the next pass, until a
tree has one node left, so a pass shortens every tree by LEVELS levels and no
task ever holds more than one block. Everything here is Spark SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.llm.sharding import expand
from marketloom.scratch import written

# Nodes that become one parent.
RUN = 8
# Levels that a block keeps; it has RUN ** LEVELS nodes, 4 KB of digests.
LEVELS = 2
BLOCK = RUN**LEVELS
_HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Every this many-th row, by its checksum, is shown with its text changed.
TAMPER_EVERY = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of one row: every value as its byte count, a colon and itself, or `-` where it is NULL."""

    def part(value: Column) -> Column:
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value), F.lit(":"), value))

    return _digest(F.concat(*[part(v.cast("string")) for v in values]))


def positions(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """The rows with `pos`, their place from 0 in the order of their group, and `size`, the group's rows.

    Rows are dealt by ranges of (group, order), stored with their place in the
    part, and a part's first place comes from the counts of the parts before. A
    group of any size is spread over as many tasks as it needs. The order has to
    be strict, or rows that tie have to be alike.
    """
    keys = [group, *order]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    stored = written(dealt.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    counts = stored.groupBy(group, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(group).alias("_group"),
        "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("size"),
    )
    same = (stored[group].eqNullSafe(offsets["_group"])) & (F.shiftright(stored["_at"], 33) == offsets["_part"])
    placed = stored.join(offsets, same).withColumn("pos", F.col("_at") + F.col("_shift"))
    return placed.drop("_at", "_group", "_part", "_shift")


def _parents(level: Column) -> Column:
    """The next level of a block: the digest of each run, joined."""
    width = RUN * _HEX
    last = F.ceil(F.length(level) / width).cast("int") - 1
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: _digest(F.substring(level, i * width + 1, F.lit(width))))
    return F.array_join(runs, "")


def _levels_of(size: Column) -> Column:
    """How many levels a block has above its nodes, in a tree that still has `size` nodes."""
    levels = F.lit(0)
    for k in range(LEVELS):
        levels = levels + (size > RUN**k).cast("int")
    return levels


def _pass(nodes: DataFrame, extra: Sequence[str]) -> DataFrame:
    """Blocks of the nodes (tree, size, pos, digest): their levels as strings, and their root."""
    node = F.struct("pos", "digest", *extra)
    sorted_nodes = F.array_sort(F.collect_list(node))
    blocks = nodes.groupBy("tree", "size", F.floor(F.col("pos") / BLOCK).alias("block")).agg(sorted_nodes.alias("nodes"))
    blocks = blocks.select(
        "tree",
        "size",
        "block",
        F.array_join(F.col("nodes.digest"), "").alias("s0"),
        *[F.col(f"nodes.{c}").alias(c) for c in extra],
        _levels_of(F.col("size")).alias("n_levels"),
    )
    for k in range(1, LEVELS + 1):
        blocks = blocks.withColumn(f"s{k}", F.when(F.col("n_levels") >= k, _parents(F.col(f"s{k - 1}"))))
    return blocks.withColumn("top", F.coalesce(*[F.col(f"s{k}") for k in range(LEVELS, -1, -1)])).drop(f"s{LEVELS}")


def _build(nodes: DataFrame, name: str, extra: Sequence[str] = ()) -> list[DataFrame]:
    """All passes over the trees of `nodes`; in the last one every tree has one block."""
    passes = []
    while True:
        blocks = written(_pass(nodes, () if passes else extra), name)
        passes.append(blocks)
        if blocks.where(f"size > {BLOCK}").isEmpty():
            return passes
        left = F.ceil(F.col("size") / F.lit(BLOCK)).cast("bigint")
        nodes = blocks.select("tree", left.alias("size"), F.col("block").alias("pos"), F.col("top").alias("digest"))


def _siblings(place: Column) -> Column:
    """What flanks the node at a place of the block, for every level that the block has."""
    found = []
    for k in range(LEVELS):
        node = F.shiftright(place, 3 * k)  # RUN is 2 ** 3
        first = node - node % RUN
        left = F.substring(F.col(f"s{k}"), first * _HEX + 1, (node % RUN) * _HEX)
        right = F.substring(F.col(f"s{k}"), (node + 1) * _HEX + 1, (RUN - 1 - node % RUN) * _HEX)
        found.append(F.when(F.col("n_levels") > k, F.struct(left.alias("left"), right.alias("right"))))
    return F.filter(F.array(*found), lambda level: level.isNotNull())


def _nodes(more: Callable[[Column], dict[str, Column]] | None) -> Column:
    """The nodes of a block: place, levels of siblings, and further columns."""

    def node(place: Column) -> Column:
        columns = {"at": place, "levels": _siblings(place), **(more(place) if more else {})}
        return F.struct(*[value.alias(c) for c, value in columns.items()])

    return F.transform(F.sequence(F.lit(0), (F.length("s0") / _HEX).cast("int") - 1), node)


def _descend(passes: list[DataFrame], above: DataFrame, leaves: Callable[[Column], dict[str, Column]]) -> DataFrame:
    """Paths of all nodes of the first pass.

    `above` has tree, path (levels over the tree's own root) and further columns
    that every node of the tree gets.
    """
    carried = [c for c in above.columns if c not in ("tree", "path")]
    above = above.withColumn("block", F.lit(0).cast("bigint"))
    for blocks in reversed(passes):
        last = blocks is passes[0]
        nodes_of_block = _nodes(leaves if last else None)
        upper = above.withColumnsRenamed({"tree": "_tree", "block": "_block"})
        joined = blocks.join(upper, (blocks["tree"] == upper["_tree"]) & (blocks["block"] == upper["_block"]))
        nodes = joined.select("tree", "block", "path", *carried, F.explode(nodes_of_block).alias("node"))
        above = nodes.select(
            "tree",
            (F.col("block") * BLOCK + F.col("node.at")).alias("block"),
            F.concat("node.levels", "path").alias("path"),
            *carried,
            *([F.col(f"node.{c}").alias(c) for c in leaves(F.lit(0))] if last else []),
        )
    return above


def fold(digest: Column, path: Column) -> Column:
    """The root that a digest and its siblings, level by level, lead to."""
    return F.aggregate(path, digest, lambda so_far, level: _digest(F.concat(level["left"], so_far, level["right"])))


def proof_text(path: Column) -> Column:
    """All siblings of a path, level by level and left to right, as one string."""
    return F.array_join(F.transform(path, lambda level: F.concat(level["left"], level["right"])), "")


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, tree roots and proof of every row of `docs` (FIELDS), by language.

    Returns doc_id, lang, leaf, changed_leaf (the same row with the letters A-Z
    of its text in lower case where TAMPER_EVERY divides the checksum of its
    doc_id, else the leaf), path (array of left and right siblings, level by
    level to the root), subroot and root. `fold` leads from a leaf to a root.

    Defined cases: NULL in any field is told from the empty string; NULL is a
    language of its own and comes first; a NULL doc_id comes first and its row
    stays unchanged; rows that share a doc_id are ordered by their leaves, and
    rows repeated in full get a place each; a tree with a single leaf has that
    leaf as its root and an empty path; an empty table gives an empty result;
    other columns are not read.
    """
    lowered = F.when(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0, F.translate("text", _UPPER, _LOWER)
    ).otherwise(F.col("text"))
    text = {"text": lowered}
    slim = docs.select(
        F.col("lang").cast("string").alias("lang"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        leaf_digest([F.col(c) for c in FIELDS]).alias("leaf"),
        leaf_digest([text.get(c, F.col(c)) for c in FIELDS]).alias("changed_leaf"),
    )
    rows = written(slim.groupBy(*slim.columns).agg(F.count(F.lit(1)).alias("n")), "manifest_rows")

    langs = rows.select("lang").distinct().withColumn("tree", F.lit(0).cast("bigint"))
    langs = written(positions(langs, "tree", ["lang"], "manifest_langs"), "manifest_langs")
    numbers = langs.select(F.col("lang").alias("_lang"), F.col("pos").alias("tree"))
    numbered = rows.join(numbers, rows["lang"].eqNullSafe(numbers["_lang"])).drop("_lang", "lang")
    first = F.lit(0).cast("bigint")
    one_each = expand(numbered.withColumn("first", first), "n", "first", "copy", ("tree", "doc_id", "leaf"))
    ordered = one_each.select("tree", "doc_id", "leaf", "changed_leaf", "copy")
    leaves = positions(ordered, "tree", ["doc_id", "leaf", "copy"], "manifest_leaves")
    nodes = leaves.select("tree", "size", "pos", F.col("leaf").alias("digest"), "doc_id", "changed_leaf")
    trees = _build(nodes, "manifest_tree", ("doc_id", "changed_leaf"))

    subroots = trees[-1].select("tree", F.col("top").alias("subroot"))
    named = langs.join(subroots.withColumnRenamed("tree", "_tree"), F.col("pos") == F.col("_tree"))
    tops = _build(named.select("tree", "size", "pos", F.col("subroot").alias("digest"), "lang"), "manifest_top", ("lang",))
    start = tops[-1].select(
        "tree", F.array().cast("array<struct<left: string, right: string>>").alias("path"), F.col("top").alias("root")
    )
    roots = _descend(
        tops,
        start,
        lambda place: {"lang": F.col("lang")[place], "subroot": F.substring("s0", place * _HEX + 1, F.lit(_HEX))},
    )
    above = roots.select(F.col("block").alias("tree"), "path", "lang", "subroot", "root")
    return _descend(
        trees,
        above,
        lambda place: {
            "doc_id": F.col("doc_id")[place],
            "leaf": F.substring("s0", place * _HEX + 1, F.lit(_HEX)),
            "changed_leaf": F.col("changed_leaf")[place],
        },
    ).select("doc_id", "lang", "leaf", "changed_leaf", "path", "subroot", "root")


def verify(found: DataFrame) -> DataFrame:
    """`manifest` rows with the root that the changed leaf leads to, and whether it is the true one."""
    folded = found.withColumn("folded_root", fold(F.col("changed_leaf"), F.col("path")))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


_CRC_POLYNOMIAL = 0xEDB88320


def oracle(max_levels: int = 12) -> str:
    """The same rows as DuckDB SQL, for trees of up to RUN ** max_levels leaves and 64 languages."""
    part = "case when {0} is null then '-' else strlen({0}::varchar) || ':' || {0}::varchar end"
    text = f"case when crc % {TAMPER_EVERY} = 0 then translate(text, '{_UPPER}', '{_LOWER}') else text end"
    leaf = " || ".join(part.format(c) for c in FIELDS)
    changed = " || ".join(part.format(f"({text})" if c == "text" else c) for c in FIELDS)
    crc = (
        "case when doc_id is null then null else xor(list_reduce("
        "list_prepend(4294967295::ubigint, range(8 * length(doc_id::varchar))::ubigint[]),"
        " lambda c, i: xor((case when i % 8 = 0 then xor(c, ascii(substr(doc_id::varchar, (i // 8 + 1)::integer, 1))::ubigint)"
        " else c end) >> 1, " + str(_CRC_POLYNOMIAL) + "::ubigint * ((case when i % 8 = 0 then"
        " xor(c, ascii(substr(doc_id::varchar, (i // 8 + 1)::integer, 1))::ubigint) else c end) & 1))),"
        " 4294967295::ubigint) end"
    )
    ctes = [
        f"base as (select *, {crc} as crc from documents)",
        f"leaves as (select doc_id, lang, sha256({leaf}) as leaf, sha256({changed}) as changed from base)",
        "langs as (select lang, row_number() over (order by encode(lang) nulls first) - 1 as t from"
        " (select distinct lang from leaves))",
        "l0 as (select t, row_number() over (partition by t order by doc_id nulls first, leaf) - 1 as pos, leaf as d,"
        " doc_id, leaf, changed from leaves join langs on leaves.lang is not distinct from langs.lang)",
        "n0 as (select t, pos, d, count(*) over (partition by t) as n from l0)",
    ]
    fold_, proof = "l0.changed", []
    joins = []

    def climb(first: str, levels: int, tag: str, key: str, tree: str) -> str:
        """Levels n1, n2, ... over n0; returns the name of the last."""
        nonlocal fold_
        before = first
        for k in range(1, levels + 1):
            now, sib = f"{tag}{k}", f"{tag}s{k}"
            ctes.append(
                f"{now} as (select t, pos // {RUN} as pos, sha256(string_agg(d, '' order by pos)) as d,"
                f" (any_value(n) + {RUN - 1}) // {RUN} as n from {before} where n > 1 group by t, pos // {RUN}"
                f" union all select t, pos, d, n from {before} where n = 1)"
            )
            window = f"over (partition by t, pos // {RUN} order by pos rows between {{}})"
            ctes.append(
                f"{sib} as (select t, pos, coalesce(string_agg(d, '') {window.format('unbounded preceding and 1 preceding')},"
                f" '') as l, coalesce(string_agg(d, '') {window.format('1 following and unbounded following')}, '') as r"
                f" from {before} where n > 1)"
            )
            joins.append(f"left join {sib} on {sib}.t = {tree} and {sib}.pos = {key} // {RUN ** (k - 1)}")
            proof.append(f"coalesce({sib}.l || {sib}.r, '')")
            ctes_fold.append(sib)
            before = now
        return before

    ctes_fold: list[str] = []
    last = climb("n0", max_levels, "a", "l0.pos", "l0.t")
    ctes.append(f"top0 as (select 0 as t, t as pos, d, count(*) over () as n from {last})")
    final = climb("top0", 2, "b", "l0.t", "0")
    steps, name = [], "f0"
    columns = ", ".join(f"{s}.l as {s}_l, {s}.r as {s}_r" for s in ctes_fold)
    ctes.append(
        f"wide as (select l0.doc_id, l0.leaf, l0.changed, l0.t, {' || '.join(proof)} as proof, {columns} from l0 {' '.join(joins)})"
    )
    ctes.append("f0 as (select *, changed as h from wide)")
    for k, s in enumerate(ctes_fold, 1):
        steps.append(
            f"f{k} as (select * exclude (h), case when {s}_l is null then h else sha256({s}_l || h || {s}_r) end as h"
            f" from f{k - 1})"
        )
        name = f"f{k}"
    ctes += steps
    return (
        "with " + ", ".join(ctes) + f" select doc_id, leaf, {last}.d as subroot, {final}.d as root, sha256(proof) as"
        f" proof_sha256, h as folded_root, h = {final}.d as verified from {name} join {last} on {last}.t = {name}.t"
        f" cross join {final}"
    )
