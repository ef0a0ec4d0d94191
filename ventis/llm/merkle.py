"""Merkle manifest of a data set: a tree per source, a tree over the sources, proofs by recursion.

The trees are built level by level, each level one aggregate over the one below, and stored as
node rows that name their parent. A recursive query then climbs from every leaf to the root: each
step joins the parent row, appends the siblings and folds the hash. Texts are read once, for the
leaf hashes; from then on only hashes and positions travel. A source of any size is cut into runs
by its global rank, so no task holds a source.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ventis.operators.ranking import with_global_rank
from ventis.session import materialize, scratch_path

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Number of the tree over the sources; the tree of the k-th source has number k.
TOP_TREE = -1

_NODE = ("tree long, level int, pos long, kids array<binary>, up_tree long, up_level int,"
         " up_pos long, idx int")


def _digest(value: Column) -> Column:
    return F.unhex(F.sha2(value, 256))


def _hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hashes(docs: DataFrame, fields: tuple[str, ...] = FIELDS, text_col: str = "text",
                id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Rows (source, doc_id, leaf binary, bent binary) of all documents.

    A leaf is the SHA-256 of the fields, each as byte count, colon and value, a null as ``-``.
    ``bent`` is the leaf after the tampering: where the CRC-32 of the id is even, the text loses
    its line feeds; null where nothing is tampered with.
    """
    def leaf(text: Column) -> Column:
        return _digest(F.concat(*(_field(text if f == text_col else F.col(f)) for f in fields)))

    text = F.col(text_col)
    even = F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0
    joined = F.replace(text, F.lit("\n"), F.lit(""))
    return docs.select(
        F.col(source_col).cast("string").alias("source"), F.col(id_col).cast("long").alias("doc_id"),
        leaf(text).alias("leaf"),
        F.when(even & text.contains("\n"), leaf(joined)).alias("bent"),
    )


def _parent(alone: Column, tree: Column, level: int, pos: Column, sources: int) -> list[Column]:
    """Parent of a node of ``level`` at ``pos`` of its tree, and the node's place among the kids.

    The last node of a source's tree is a leaf of the tree over the sources; its last node, or
    that of the only source, has no parent.
    """
    top = tree == TOP_TREE
    over = alone & ~top & F.lit(sources > 1)
    inside = ~alone
    return [
        F.when(over, F.lit(TOP_TREE)).when(inside, tree).cast("long").alias("up_tree"),
        F.when(over, 1).when(inside, level + 1).cast("int").alias("up_level"),
        F.when(over, F.floor(tree / ARITY)).when(inside, F.floor(pos / ARITY)).cast("long")
        .alias("up_pos"),
        F.when(over, tree % ARITY).when(inside, pos % ARITY).cast("int").alias("idx"),
    ]


def _build(nodes: DataFrame, height: int, path: str, sources: int, first: int = 0) -> list[DataFrame]:
    """Write the levels above ``nodes`` (tree, pos, n, hash), ``n`` nodes on their level of the
    tree, one folder each below ``path``. Returns the frames whose rows with n = 1 are the tops."""
    spark = nodes.sparkSession
    tops = [nodes]
    for level in range(1, height + 1):
        place = F.col("pos") % ARITY
        runs = (
            nodes.filter("n > 1")
            .groupBy("tree", F.floor(F.col("pos") / ARITY).cast("long").alias("pos"), "n")
            .agg(*(F.max(F.when(place == k, F.col("hash"))).alias(f"_kid{k}") for k in range(ARITY)))
            .withColumn("kids", F.array_compact(F.array(*(f"_kid{k}" for k in range(ARITY)))))
            .withColumn("n", F.ceil(F.col("n") / ARITY).cast("long"))
            .select("tree", F.lit(level).alias("level"), "pos", "n", "kids",
                    _digest(F.concat(*(F.coalesce(_hex(F.col(f"_kid{k}")), F.lit(""))
                                       for k in range(ARITY)))).alias("hash"),
                    *_parent(F.col("n") == 1, F.col("tree"), level, F.col("pos"), sources))
        )
        target = f"{path}/built={first + level}"
        runs.write.parquet(target)
        nodes = spark.read.schema(runs.schema).parquet(target)
        tops.append(nodes)
    return tops


def _height(leaves: int) -> int:
    """Levels above ``leaves`` leaves."""
    height = 0
    while leaves > 1:
        leaves, height = -(-leaves // ARITY), height + 1
    return height


CLIMB = """
    WITH RECURSIVE climb(row, step, up_tree, up_level, up_pos, idx, folded, siblings, doc_id, leaf,
                         subroot) MAX RECURSION LEVEL {deepest} AS (
        SELECT row, 0, up_tree, up_level, up_pos, idx, coalesce(bent, leaf),
               CAST(array() AS array<binary>), doc_id, leaf, CAST(NULL AS binary)
        FROM {leaves}
        UNION ALL
        SELECT c.row, c.step + 1, n.up_tree, n.up_level, n.up_pos, n.idx,
               unhex(sha2(array_join(transform(
                   n.kids, (kid, i) -> lower(hex(if(i = c.idx, c.folded, kid)))), ''), 256)),
               filter(n.kids, (kid, i) -> i <> c.idx), CAST(NULL AS bigint), CAST(NULL AS binary),
               if(n.tree = {top} AND n.level = 1, n.kids[c.idx], CAST(NULL AS binary))
        FROM climb c JOIN {nodes} n
          ON n.tree = c.up_tree AND n.level = c.up_level AND n.pos = c.up_pos)
    SELECT * FROM climb LIMIT ALL
"""


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, text_col: str = "text",
             id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Per document: leaf, subroot of its source, root, digest of its proof, root folded from the
    tampered leaf, and whether that is the root. All but doc_id and verified in hex.

    Leaves of a source ascend by id (null first; equal ids by leaf), sources by their bytes (null
    first). Every ``ARITY`` consecutive nodes become the hash of their digests, the last run may
    be shorter. Repeated rows are leaves of their own. An empty table gives no row. The proof is
    the hash of all siblings on the way, that of the empty text if there is none. Columns other
    than ``fields`` play no part.
    """
    spark = docs.sparkSession
    ordered = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    ranked = with_global_rank(leaf_hashes(docs, fields, text_col, id_col, source_col), ordered,
                              "row")
    sizes = ranked.groupBy("source").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    numbered = materialize(
        with_global_rank(sizes, [F.col("source").asc_nulls_first()], "tree"), "merkle-sources")
    sources, largest = numbered.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    pos = F.col("row") - F.col("first")
    leaves = materialize(
        ranked.join(numbered.withColumnRenamed("source", "_source"),
                    F.col("source").eqNullSafe(F.col("_source")))
        .select("row", "doc_id", "leaf", "bent", "tree", pos.alias("pos"), "n",
                F.col("leaf").alias("hash"),
                *_parent(F.col("n") == 1, F.col("tree"), 0, pos, sources)), "merkle-leaves")
    path = scratch_path(spark, "merkle-nodes")
    spark.createDataFrame([], _NODE).write.parquet(f"{path}/built=0")
    tops = _build(leaves.select("tree", "pos", "n", "hash"), _height(largest), path, sources)
    subroots = reduce(DataFrame.unionByName, (
        level.filter("n = 1").select(F.lit(TOP_TREE).cast("long").alias("tree"),
                                     F.col("tree").alias("pos"), F.lit(sources).alias("n"), "hash")
        for level in tops))
    over = _build(subroots, _height(sources), path, sources, first=len(tops))
    top = over[-1].filter("n = 1").select("hash").first()
    root = F.lit(None if top is None else bytes(top["hash"]).hex())
    deepest = _height(largest) + _height(sources) + 2
    nodes = spark.read.schema(_NODE + ", built int").parquet(path)
    climbed = spark.sql(CLIMB.replace("{deepest}", str(deepest)).replace("{top}", str(TOP_TREE)),
                        leaves=leaves, nodes=nodes)
    steps = F.sort_array(F.collect_list(F.struct("step", "siblings")))
    proof = F.expr("array_join(transform(flatten(steps.siblings), s -> lower(hex(s))), '')")
    return (
        climbed.groupBy("row").agg(
            F.max("doc_id").alias("doc_id"), F.max("leaf").alias("leaf"),
            F.max("subroot").alias("subroot"), F.max_by("folded", "step").alias("folded"),
            steps.alias("steps"))
        .select(
            "doc_id", _hex(F.col("leaf")).alias("leaf"),
            F.coalesce(_hex(F.col("subroot")), root).alias("subroot"), root.alias("root"),
            F.sha2(proof, 256).alias("proof_sha256"), _hex(F.col("folded")).alias("folded_root"))
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )
