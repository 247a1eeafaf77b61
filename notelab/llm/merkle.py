"""Merkle manifest of a table by lag and lead windows.

Every row is a leaf: the SHA-256 of its fields, each with its length before it,
so that no two rows share an input.  The leaves of a group (a language) stand in
the order of their ids; every ``fanout`` neighbours are hashed to their parent
until one node, the group's subroot, remains; the subroots in the order of the
groups give the root in the same way.

Per level the node at index j keeps slot j mod fanout of its run.  Its siblings
come from ``lag`` and ``lead`` columns at fixed offsets 1 to fanout - 1 (times
the distance between two nodes of the level), masked by the slot and by the
length of the run; the row of the first child hashes the parent.  Downwards the
children take their parent's siblings from the first child's row by ``lag``
columns masked by the slot.  ``LEVELS`` levels lie within one window partition:
a chunk of fanout ** LEVELS neighbours, whatever the size of the group, so no
task holds a group.  The first rows of the chunks are the nodes of the next
phase; each is smaller by fanout ** LEVELS.

Distributed: only ids, groups and digests shuffle, never texts.  Positions come
from a range partitioning by (group, id, leaf) that is written once, and counts
per (partition, group).  The proof of a leaf is put together where it is hashed:
its lower siblings by the window, the upper ones from a join with the chunks.

Edge cases: null groups come first and form a group of their own; null ids come
first; null fields are ``-``; rows that share an id are ordered by their leaf
(equal rows are interchangeable); an empty table gives no row; a group of one
leaf has that leaf as its subroot, a table of one group its subroot as root, and
a proof without siblings is the digest of the empty text.  Columns that are not
named do not count, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notelab.llm.common import written

FANOUT = 8
LEVELS = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """Length in UTF-8 bytes, colon, value; ``-`` for null."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return digest(*(field(v) for v in values))


def tampered(id_: Column) -> Column:
    """Whether the leaf is to be recomputed from a changed text."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows: g (never null) and more.  Adds i, the place in the order within g
    (from 0), and n, the rows of g; written in the order (g, order)."""
    keys = [F.col("g").asc(), *(F.col(c).asc_nulls_first() for c in order), F.col("tie").asc()]
    dealt = (rows.withColumn("tie", F.monotonically_increasing_id())  # parts rows that agree in all else
             .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie"))
    dealt = written(dealt.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "ordered")
    # one row per partition and group
    runs = dealt.groupBy("part", "g").agg(F.min("at").alias("begin"), F.count("*").alias("size"))
    group = Window.partitionBy("g")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("part", "g", "begin", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("skip"),
                       F.sum("size").over(group).alias("n"))
    return (dealt.join(written(runs, "runs"), ["part", "g"])
            .withColumn("i", F.col("at") - F.col("begin") + F.col("skip")).drop("part", "at", "begin", "skip"))


def _climb(nodes: DataFrame, proofs: bool) -> DataFrame:
    """nodes: g, n, i, h and more.  Adds chunk (the index LEVELS levels up) and
    top (that node's hash, on the chunk's first row); with ``proofs`` also path,
    the siblings on each level that has more than one node."""
    over = "over (partition by g, chunk order by i)"
    out = nodes.selectExpr("*", f"i div {FANOUT ** LEVELS} as chunk", "h as top")
    for level in range(LEVELS):
        stride = FANOUT ** level
        # run: nodes in the run of the node that this row holds, 0 if it holds none of this level
        out = out.selectExpr(
            "*", f"(i div {stride}) % {FANOUT} as slot{level}",
            f"if(i % {stride} = 0 and n > {stride}, least({FANOUT}, ceil(n / {stride}) - i div {stride * FANOUT} * {FANOUT}), 0) as run{level}")
        before = [f"if(run{level} > 0 and slot{level} >= {k}, lag(top, {k * stride}) {over}, '')" for k in range(FANOUT - 1, 0, -1)]
        after = [f"if(slot{level} + {k} < run{level}, lead(top, {k * stride}) {over}, '')" for k in range(1, FANOUT)]
        out = out.selectExpr("*", f"concat({', '.join(before)}) as left{level}", f"concat({', '.join(after)}) as right{level}")
        parent = f"if(i % {stride * FANOUT} = 0, if(run{level} > 0, sha2(concat(top, right{level}), 256), top), null)"
        out = out.withColumn("top", F.expr(parent))
    if proofs:
        for level in range(LEVELS - 1, -1, -1):
            own = f"if(run{level} > 0, array(named_struct('left', left{level}, 'right', right{level})), cast(array() as {PATH}))"
            if level < LEVELS - 1:
                stride, above = FANOUT ** level, f"path{level + 1}"
                fetched = " ".join(f"when {k} then lag({above}, {k * stride}) {over}" for k in range(1, FANOUT))
                own = f"concat({own}, case slot{level} {fetched} else {above} end)"
            out = out.selectExpr("*", f"{own} as path{level}")
        out = out.withColumn("path", F.col("path0"))
    return out.drop(*(f"{c}{level}" for c in ("slot", "run", "left", "right", "path") for level in range(LEVELS)))


def _parents(climbed: DataFrame) -> DataFrame:
    return climbed.filter(F.col("i") % FANOUT ** LEVELS == 0).select(
        "g", F.ceil(F.col("n") / FANOUT ** LEVELS).cast("long").alias("n"), F.col("chunk").alias("i"), F.col("top").alias("h"))


def _tree(leaves: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """leaves: g, n, i, h.  The root of every g (g, h), and the nodes above the
    first phase, a table per phase with their paths, from the lowest up."""
    phases: list[DataFrame] = []
    nodes = written(_parents(_climb(leaves, False)), "nodes")
    while True:
        most = nodes.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return nodes.select("g", "h"), phases
        phases.append(written(_climb(nodes, True), "nodes"))
        nodes = written(_parents(phases[-1]), "nodes")


def _paths(phases: list[DataFrame], top: DataFrame) -> DataFrame:
    """top: g and what its leaves share, among it path.  The same for every node
    right above the first phase: g, chunk (its index), path and the rest."""
    rest = [c for c in top.columns if c not in ("g", "path")]
    out = top.withColumn("chunk", F.lit(0).cast("long"))
    for phase in reversed(phases):
        below = phase.select("g", "chunk", "i", F.col("path").alias("lower"))
        out = below.join(out, ["g", "chunk"]).select("g", F.col("i").alias("chunk"), F.concat("lower", "path").alias("path"), *rest)
    return out


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda acc, s: digest(s["left"], acc, s["right"]))


def manifest(docs: DataFrame, changed: DataFrame | None = None, id_col: str = "doc_id", group_col: str = "lang",
             fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), check: Column | None = None) -> DataFrame:
    """Per row: doc_id, g (the group's key), leaf, claimed (``check`` if given,
    else the leaf), subroot, root, path (siblings from the leaf up) and folded,
    the root that ``claimed`` and the path give.  ``check`` is a column over
    ``docs``: a leaf of a later state of the row, to be held against the
    manifest."""
    own = leaf([F.col(f"`{c}`") for c in fields])
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit("")).alias("g"),
        own.alias("h"), (own if check is None else check).alias("claimed"))
    leaves = written(positions(rows, ["doc_id", "h"]), "leaves")
    subroots, phases = _tree(leaves.select("g", "n", "i", "h"))
    # the subroots are the leaves of one more tree, in the order of their groups
    groups = written(positions(subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), "h"), ["name"]), "subroots")
    root, upper = _tree(groups.select("g", "n", "i", "h"))
    shared = _paths(upper, root.select("g", F.array().cast(PATH).alias("path"), F.col("h").alias("root")))
    top = (_climb(groups, True).join(shared.withColumnRenamed("path", "rest"), ["g", "chunk"])
           .select(F.col("name").alias("g"), F.concat("path", "rest").alias("path"), F.col("h").alias("subroot"), "root"))
    above = written(_paths(phases, written(top, "group-paths")).withColumnRenamed("path", "upper"), "chunk-paths")
    # the windows and the join share one exchange by (g, chunk)
    out = _climb(leaves, True).join(above, ["g", "chunk"]).withColumn("path", F.concat("path", "upper"))
    return out.select("doc_id", "g", F.col("h").alias("leaf"), "claimed", "subroot", "root", "path",
                      fold(F.col("claimed"), F.col("path")).alias("folded"))


def lowered_leaf(id_col: str = "doc_id", text_col: str = "text",
                 fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")) -> Column:
    """The leaf after the tampering that op12 checks: A-Z of the text in lower
    case in the rows that ``tampered`` names."""
    low = leaf([F.translate(F.col(f"`{c}`").cast("string"), UPPER, LOWER) if c == text_col else F.col(f"`{c}`") for c in fields])
    return F.when(tampered(F.col(f"`{id_col}`")), low).otherwise(leaf([F.col(f"`{c}`") for c in fields]))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)
