"""Merkle manifest of a document table, with octopus multiproofs.

A row's leaf is a digest of its fields. The leaves of one language, in ascending order of
doc_id, are hashed by runs of eight (the last run may be shorter, even one node) until one
node, the subroot, remains; a lone leaf is its own subroot. The subroots, in the order of
their languages, are hashed likewise into the root.

A *node* is a place (tree, level, index) and its digest. Trees are numbered by language, null
first, then bytewise; the tree above them has the number ``TOP``, and its leaf ``t`` is the
subroot of tree ``t``. Leaves are numbered by a range partitioning, whose borders may cut a
language anywhere, so no task holds a whole one.

Claims about leaves are checked in *leaf partitions*, the claimed leaves below one node four
levels up. A partition first works out the smallest set of nodes that none of its leaves
leads to and that their paths need (an octopus proof), up to the root; it gets each of these
once, derives the nodes that its paths share, and lays out every leaf's own proof from both.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.session import stage

ARITY = 8
#: Levels that one task hashes at a time: a leaf partition lies below one node this far up.
RISE = 4
BLOCK = ARITY**RISE
#: The tree of the subroots.
TOP = -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "tree long, level int, index long, digest string"


def field(value: Column) -> Column:
    """Byte count, colon and value; a dash for null."""
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(**instead: Column) -> Column:
    """The leaf of a row, with other values than its own where given."""
    return F.sha2(F.concat(*[field(instead.get(c, F.col(c).cast("string"))) for c in FIELDS]), 256)


def height(leaves: int) -> int:
    """Levels above that many leaves."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // ARITY), levels + 1
    return levels


def width(leaves: int, level: int) -> int:
    """Nodes at a level."""
    return -(-leaves // ARITY**level)


def hashed(run: list[bytes]) -> bytes:
    return sha256(b"".join(run)).hexdigest().encode()


@dataclass
class Manifest:
    """``leaves``: tree, pos, doc_id, lang, leaf and what else was kept of the rows; ``trees``: tree, lang, size;
    ``nodes``: the inner nodes; ``count``: the number of trees; ``root``: None without rows."""

    leaves: DataFrame
    trees: DataFrame
    nodes: DataFrame
    count: int
    root: str | None


def placed(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The leaves with tree and pos, and the table of trees.

    Rows with one doc_id follow one another by their leaves; equal rows are interchangeable.
    """

    def mark(batches: Iterable[pa.RecordBatch]):
        chunk, run, place, last = TaskContext.get().partitionId(), -1, 0, ()
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            runs, places = np.zeros(len(langs), np.int64), np.zeros(len(langs), np.int64)
            for k, lang in enumerate(langs):
                run, place = (run, place + 1) if (lang,) == last else (run + 1, 0)
                runs[k], places[k], last = run, place, (lang,)
            more = [pa.array(np.full(len(langs), chunk)), pa.array(runs), pa.array(places)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "chunk", "run", "place"])

    order = ["lang", "doc_id", "leaf"]
    # the last key spreads rows that are equal in all others
    ordered = leaves.withColumn("apart", F.monotonically_increasing_id()).repartitionByRange(*order, "apart").sortWithinPartitions(*order, "apart")
    marked = ordered.drop("apart")
    schema = marked.select("*").schema.add("chunk", "long").add("run", "long").add("place", "long")
    rows = stage(marked.mapInArrow(mark, schema), "placed-leaves")
    # a row for each language and range from here on
    runs = rows.groupBy("chunk", "run").agg(F.first("lang").alias("lang"), F.count("*").alias("n"))
    earlier = Window.partitionBy("lang").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    runs = stage(runs.withColumn("begun", (F.col("offset") == 0).cast("long")), "runs")
    chunks = runs.groupBy("chunk").agg(F.sum("begun").alias("begun"))
    # one row a range
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("chunk", F.coalesce(F.sum("begun").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("chunk").orderBy("run").rowsBetween(Window.unboundedPreceding, 0)
    runs = runs.join(chunks, "chunk").withColumn("tree", F.col("before") + F.sum("begun").over(within) - 1)
    runs = stage(runs.select("chunk", "run", "lang", "tree", "offset", "n"), "trees-by-range")
    trees = stage(runs.groupBy("tree").agg(F.first("lang").alias("lang"), F.sum("n").alias("size")), "trees")
    numbered = rows.join(runs.select("chunk", "run", "tree", "offset"), ["chunk", "run"])
    kept = [c for c in leaves.columns if c not in ("tree", "pos")]
    return stage(numbered.select("tree", (F.col("offset") + F.col("place")).alias("pos"), *kept), "leaves"), trees


def raised(nodes: DataFrame, sizes: DataFrame, level: int) -> DataFrame:
    """The inner nodes of up to ``RISE`` levels above the nodes (tree, index, digest) of a level."""

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            out: list[tuple] = []
            for tree, size, block, found in zip(*(batch.column(c).to_pylist() for c in ("tree", "size", "block", "found")), strict=True):
                row = [x["digest"].encode() for x in found]
                index = block * BLOCK
                for up in range(level + 1, min(level + RISE, height(size)) + 1):
                    row = [hashed(row[k : k + ARITY]) for k in range(0, len(row), ARITY)]
                    index //= ARITY
                    out += [(tree, up, index + k, digest.decode()) for k, digest in enumerate(row)]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 4, (pa.int64(), pa.int32(), pa.int64(), pa.string()))], ["tree", "level", "index", "digest"])

    block = F.floor(F.col("index") / BLOCK).alias("block")
    grouped = nodes.groupBy("tree", block).agg(F.array_sort(F.collect_list(F.struct("index", "digest"))).alias("found"))
    return grouped.join(sizes.select("tree", "size"), "tree").select("tree", "size", "block", "found").mapInArrow(run, NODE)


def forest(leaves: DataFrame, sizes: DataFrame, largest: int) -> DataFrame:
    """All inner nodes above the leaves (tree, index, digest) of trees with at most ``largest`` leaves."""
    spark, level, levels = leaves.sparkSession, 0, []
    below, tall = leaves, sizes
    while height(largest) > level:
        tall = tall.where(F.col("size") > ARITY**level)
        made = stage(raised(below.join(tall.select("tree"), "tree", "left_semi"), tall, level), "nodes")
        levels.append(made)
        level += RISE
        below = made.where(F.col("level") == level).select("tree", "index", "digest")
    out = spark.createDataFrame([], NODE)
    for made in levels:
        out = out.unionByName(made)
    return out


def build(docs: DataFrame, **kept: Column) -> Manifest:
    """The manifest of a table with the columns ``FIELDS``; ``kept`` are further columns to carry with the leaves.

    Nulls, empty texts and repeated rows are leaves like any other. Other columns of the
    table play no part. An empty table has no root.
    """
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), leaf_digest().alias("leaf"), *[v.alias(k) for k, v in kept.items()])
    leaves, trees = placed(stage(rows, "digests"))
    about = trees.agg(F.count("*").alias("count"), F.max("size").alias("largest")).first()
    if not about["count"]:
        return Manifest(leaves, trees, docs.sparkSession.createDataFrame([], NODE), 0, None)
    inner = forest(leaves.select("tree", F.col("pos").alias("index"), F.col("leaf").alias("digest")), trees, about.largest)
    alone = leaves.join(trees.where("size = 1").select("tree"), "tree", "left_semi")
    alone = alone.select("tree", F.lit(0).alias("level"), F.lit(0).cast("long").alias("index"), F.col("leaf").alias("digest"))
    heights = trees.withColumn("level", sum([(F.col("size") > ARITY**k).cast("int") for k in range(21)], F.lit(0)))
    tops = inner.join(heights.select("tree", "level"), ["tree", "level"], "left_semi").unionByName(alone)
    subroots = stage(tops.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("index"), "digest"), "subroots")
    size = docs.sparkSession.createDataFrame([(TOP, about["count"])], "tree long, size long")
    above = forest(subroots, size, about["count"])
    nodes = inner.unionByName(above).unionByName(subroots.select("tree", F.lit(0).alias("level"), "index", "digest"))
    root = nodes.where((F.col("tree") == TOP) & (F.col("level") == height(about["count"]))).first().digest
    return Manifest(leaves, trees, nodes, about["count"], root)


def missing(places: Iterable[int], size: int) -> list[tuple[int, int]]:
    """The fewest nodes (level, index) that the paths from these leaves need besides what the leaves lead to."""
    known, out, level = sorted(set(places)), [], 0
    while width(size, level) > 1:
        last, have, parents = width(size, level), set(known), sorted({k // ARITY for k in known})
        out += [(level, k) for p in parents for k in range(p * ARITY, min(p * ARITY + ARITY, last)) if k not in have]
        known, level = parents, level + 1
    return out


def surroundings(known: dict[int, bytes], size: int, fetched: dict[tuple[int, int], bytes]) -> tuple[bytes, list[dict[int, tuple[bytes, bytes]]]]:
    """The digest that the known leaves lead to, and for each level what stands before and after each node in its run."""
    level, around = 0, []
    while width(size, level) > 1:
        last, own, above = width(size, level), {}, {}
        for p in sorted({k // ARITY for k in known}):
            places = range(p * ARITY, min(p * ARITY + ARITY, last))
            run = [known[k] if k in known else fetched[level, k] for k in places]
            for n, k in enumerate(places):
                if k in known:
                    own[k] = b"".join(run[:n]), b"".join(run[n + 1 :])
            above[p] = hashed(run)
        around.append(own)
        known, level = above, level + 1
    return known[0], around


def verify(manifest: Manifest, claim: Column, *columns: str, which: Column | None = None, with_proof: bool = False) -> DataFrame:
    """Proofs of the leaves that ``which`` holds for (all by default), and what their claims fold to.

    ``claim`` is the digest that takes the leaf's place, a column of ``manifest.leaves``. Columns:
    the given ones, leaf, subroot, root, proof if asked for (the siblings' digests from left to
    right, level by level up to the root), proof_sha256, folded_root, verified.
    """
    labels = ["leaf", "subroot", "root", *(["proof"] if with_proof else []), "proof_sha256", "folded_root"]
    chosen = manifest.leaves if which is None else manifest.leaves.where(which)
    carried = F.struct(*columns) if columns else F.struct(F.lit(None).cast("string").alias("none"))
    own = F.struct("pos", "leaf", claim.alias("claim"), carried.alias("row"))
    part = F.floor(F.col("pos") / BLOCK).alias("part")
    parts = chosen.groupBy("tree", part).agg(F.collect_list(own).alias("own"))
    parts = stage(parts.join(manifest.trees.select("tree", "size"), "tree").select("tree", "part", "size", "own"), "leaf-parts")
    count, root = manifest.count, manifest.root

    def ask(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            out: list[tuple] = []
            for tree, part, size, places in zip(*(batch.column(c).to_pylist() for c in ("tree", "part", "size", "places")), strict=True):
                out += [(tree, part, tree, level, index) for level, index in missing(places, size)]
                out += [(tree, part, TOP, level, index) for level, index in missing([tree], count)]
            columns = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32() if k == 3 else pa.int64()) for k, x in enumerate(columns)], ["for_tree", "part", "tree", "level", "index"])

    asked = parts.select("tree", "part", "size", F.col("own.pos").alias("places"))
    asked = stage(asked.mapInArrow(ask, "for_tree long, part long, tree long, level int, index long"), "missing-nodes")
    nodes = manifest.nodes
    if which is not None:
        bottom = manifest.leaves.select("tree", F.lit(0).alias("level"), F.col("pos").alias("index"), F.col("leaf").alias("digest"))
        nodes = nodes.unionByName(bottom)
    fetched = asked.join(nodes, ["tree", "level", "index"]).groupBy("for_tree", "part")
    fetched = fetched.agg(F.collect_list(F.struct("tree", "level", "index", "digest")).alias("fetched")).withColumnRenamed("for_tree", "tree")
    full = parts.join(fetched, ["tree", "part"], "left")

    def expand(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for k in range(batch.num_rows):
                tree, size = batch.column("tree")[k].as_py(), batch.column("size")[k].as_py()
                got = {(x["tree"], x["level"], x["index"]): x["digest"].encode() for x in batch.column("fetched")[k].as_py() or ()}
                own = batch.column("own")[k].values
                places = own.field("pos").to_pylist()
                leaf_texts = own.field("leaf").to_pylist()
                leaves = [x.encode() for x in leaf_texts]
                below = {(level, index): d for (t, level, index), d in got.items() if t == tree}
                above = {(level, index): d for (t, level, index), d in got.items() if t == TOP}
                subroot, around = surroundings(dict(zip(places, leaves, strict=True)), size, below)
                top, beyond = surroundings({tree: subroot}, count, above)
                if top.decode() != root:
                    raise ValueError(f"the nodes of tree {tree} do not lead to the root")
                rest = [level[tree // ARITY**n] for n, level in enumerate(beyond)]
                proofs, digests, folded = [], [], []
                for place, claimed in zip(places, own.field("claim").to_pylist(), strict=True):
                    path = [level[place // ARITY**n] for n, level in enumerate(around)] + rest
                    proof = b"".join([x for sides in path for x in sides])
                    at = claimed.encode()
                    for left, right in path:
                        at = sha256(left + at + right).hexdigest().encode()
                    proofs.append(proof.decode())
                    digests.append(sha256(proof).hexdigest())
                    folded.append(at.decode())
                n = len(places)
                made = [pa.array(x) for x in (leaf_texts, [subroot.decode()] * n, [root] * n, *([proofs] if with_proof else []), digests, folded, [x == root for x in folded])]
                row = own.field("row")
                yield pa.RecordBatch.from_arrays([*[row.field(c) for c in columns], *made], [*columns, *labels, "verified"])

    schema = manifest.leaves.select(*columns).schema
    for name in labels:
        schema = schema.add(name, "string")
    return full.select("tree", "size", "own", "fetched").mapInArrow(expand, schema.add("verified", "boolean"))


def lowered(text: Column) -> Column:
    """The text with A-Z in lower case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
