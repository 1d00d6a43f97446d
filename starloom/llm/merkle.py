"""Merkle manifest of a dataset: a digest per row, per source and of the whole, with proofs.

Leaves are numbered per source in ascending doc_id.  Every level is a table of nodes, and a
level's siblings are found by shifting slots: node i has slot i % 3, its siblings stand at the
slots one and two further on (modulo 3), and two equijoins of the level with itself on these
computed indices bring their digests.  Rows of slot zero then hold a whole run and emit the
parent.  All sources climb together, and their roots climb once more to the root of the whole.
Paths come back down the same way: a node's path is its own siblings, then its parent's path,
so each level is joined once and the long paths only stand at the leaves.

Numbers come from a written table (range layout on source, doc_id, digest and a row number), so
a source with most of the rows is spread over all tasks, copies of one row too.  Every level is
written; a lost executor costs a re-read.

Defined cases: null fields are "-"; a null doc_id comes first in its source; rows with equal
doc_id follow their digests; repeated rows are leaves of their own; a null source is a source
and comes first; a lone leaf is its source's root, a lone source's root the root; an empty table
has no rows; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import PID, POS, RangeLayout, number_rows
from ..operators.sizing import broadcast_if_small
from .common import stage, unstage

#: The columns of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes of a run.
ARITY = 3

_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(**replaced: Column) -> Column:
    """sha256 of the row's fields, each "-" if null, else its bytes counted and given."""
    def field(c):
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return digest(*[field(replaced.get(c, F.col(c))) for c in FIELDS])


def _numbered(rows: DataFrame, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Rows with ``number`` (from 0) in ascending ``order``, and the written table beneath."""
    by = [F.col(c).asc_nulls_first() for c in order]
    laid = stage(rows.repartitionByRange(*by).sortWithinPartitions(*by)
                 .withColumns({PID: F.spark_partition_id(), POS: F.monotonically_increasing_id()}), name)
    offsets, seen = [], 0
    for pid, n in sorted(map(tuple, laid.groupBy(PID).count().collect())):      # a row per partition
        offsets.append((pid, seen))
        seen += n
    offsets = laid.sparkSession.createDataFrame(offsets, f"{PID} int, __off long")
    return number_rows(RangeLayout(laid, offsets, []), "number", start=-1).select(*rows.columns, "number"), laid


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, idx, n, digest) with the digests of the run's others before and after."""
    slot = F.col("idx") % ARITY
    out = nodes
    for k in range(1, ARITY):
        shifted = nodes.select(F.col("tree").alias("__t"), F.col("idx").alias("__i"), F.col("digest").alias(f"__s{k}"))
        at = F.col("idx") - slot + (slot + k) % ARITY
        out = out.join(shifted, (F.col("tree") == F.col("__t")) & (at == F.col("__i")), "left").drop("__t", "__i")
    own = [F.coalesce(F.col(f"__s{k}"), F.lit("")) for k in range(1, ARITY)]
    # The sibling k slots further on stands before the node once the sum passes the last slot.
    before = F.concat(*[F.when(slot + k >= ARITY, own[k - 1]).otherwise("") for k in range(1, ARITY)])
    after = F.concat(*[F.when(slot + k < ARITY, own[k - 1]).otherwise("") for k in range(1, ARITY)])
    return out.select("tree", "idx", "n", "digest", before.alias("left"), after.alias("right"))


def climb(nodes: DataFrame, largest: int) -> tuple[DataFrame, DataFrame]:
    """Paths (tree, idx, digest, path) of the nodes, and roots (tree, root), of trees that are
    given by their lowest nodes (tree, idx from 0, n nodes of the tree, digest)."""
    levels = []
    while True:
        levels.append(stage(with_siblings(nodes), "merkle-level"))
        if largest <= 1:
            break
        nodes = levels[-1].where((F.col("n") > 1) & (F.col("idx") % ARITY == 0)).select(
            "tree", F.expr(f"idx div {ARITY}").alias("idx"), F.expr(f"(n + {ARITY - 1}) div {ARITY}").alias("n"),
            digest(F.col("digest"), F.col("right")).alias("digest"))
        largest = -(-largest // ARITY)
    roots = None
    for level in levels:
        top = level.where("n = 1").select("tree", F.col("digest").alias("root"))
        roots = top if roots is None else roots.unionByName(top)
    roots = stage(roots, "merkle-roots")
    read = levels[-1]                            # the written table that ``paths`` reads
    paths = read.select("tree", "idx", "digest", F.array().cast(_PATH).alias("path"))
    for k in range(len(levels) - 2, -1, -1):
        above = paths.select(F.col("tree").alias("__t"), F.col("idx").alias("__i"), F.col("path").alias("__p"))
        own = F.array(F.struct("left", "right")).cast(_PATH)
        paths = levels[k].join(above, (F.col("tree") == F.col("__t")) & (F.expr(f"idx div {ARITY}") == F.col("__i")), "left") \
            .select("tree", "idx", "digest",
                    F.when(F.col("n") == 1, F.array().cast(_PATH)).otherwise(F.concat(own, "__p")).alias("path"))
        if k:                                    # the lowest and longest paths are read once, not written
            written = stage(paths, "merkle-paths")
            unstage(read)
            unstage(levels[k])
            paths = read = written
    return paths, roots


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda acc, s: digest(s["left"], acc, s["right"]))


def manifest(docs: DataFrame, probe: Column | None = None) -> DataFrame:
    """doc_id, source, leaf, probe, subroot, root, path of every row.  ``probe`` is a leaf
    digest to be verified in the row's place (``leaf`` where null)."""
    leaf = leaf_digest()
    probe = F.lit(None).cast("string") if probe is None else probe
    leaves = stage(docs.select("source", "doc_id", leaf.alias("leaf"), F.coalesce(probe, leaf).alias("probe"),
                               F.monotonically_increasing_id().alias("uid")), "merkle-leaves")
    numbered, laid = _numbered(leaves, ["source", "doc_id", "leaf", "uid"], "merkle-order")
    # The number of a source's first leaf names its tree, and orders the trees as the sources.
    trees = stage(numbered.groupBy("source").agg(F.min("number").alias("tree"), F.count(F.lit(1)).alias("n")), "merkle-trees")
    unstage(leaves)
    side, _ = broadcast_if_small(trees.select(F.col("source").alias("__source"), "tree", "n"))
    placed = numbered.join(side, F.col("source").eqNullSafe(F.col("__source"))).select(
        "doc_id", "source", "leaf", "probe", "tree", (F.col("number") - F.col("tree")).alias("idx"), "n")
    largest = trees.agg(F.max("n")).first()[0] or 0
    paths, subroots = climb(placed.select("tree", "idx", "n", F.col("leaf").alias("digest")), largest)
    n_trees = trees.count()
    ranked, _ = _numbered(subroots, ["tree"], "merkle-sources")
    top_paths, top = climb(ranked.select(F.lit(0).cast("long").alias("tree"), F.col("number").alias("idx"),
                                         F.lit(n_trees).cast("long").alias("n"), F.col("root").alias("digest")), n_trees)
    root = (top.select("root").first() or [None])[0]
    sources = stage(ranked.join(top_paths.select(F.col("idx").alias("number"), F.col("path").alias("__above")), "number")
                    .select(F.col("tree").alias("__tree"), F.col("root").alias("subroot"), "__above",
                            F.to_json("__above").alias("__size")), "merkle-subroots")
    side, _ = broadcast_if_small(sources)
    own = paths.select(F.col("tree").alias("__t"), F.col("idx").alias("__i"), "path")
    return placed.join(own, (F.col("tree") == F.col("__t")) & (F.col("idx") == F.col("__i"))) \
        .join(side, F.col("tree") == F.col("__tree")) \
        .select("doc_id", "source", "leaf", "probe", "subroot", F.lit(root).cast("string").alias("root"),
                F.concat("path", "__above").alias("path"))


def report(docs: DataFrame) -> DataFrame:
    """Digests of every document, with the proof that it belongs to the root; documents with an
    even crc32 of their id are verified after their line breaks were deleted."""
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0,
                      leaf_digest(text=F.replace("text", F.lit("\n"), F.lit(""))))
    rows = manifest(docs, tampered)
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    return rows.withColumn("folded_root", fold(F.col("probe"), F.col("path"))).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))
