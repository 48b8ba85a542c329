"""Merkle manifest of a dataset, with a proof for each row, by butterfly exchange.

Every row is a leaf; per group, ``FANOUT`` consecutive nodes become their hash
until one, the subroot, is left; the subroots form a tree of the same kind.

The leaves of a group are ranked by a range partitioning and dealt into aligned
blocks of ``FANOUT ** DEPTH`` places.  A block, which is one row of a table, hashes
its own subtree.  Then blocks exchange: in round r, the subtrees of ``FANOUT ** r``
blocks that have the same parent send their roots to each other, the block at
each place of a subtree to those at the same place of the others, and every block
hashes the parent for itself.  A subtree at the end may have fewer blocks; they
then send to all places that nobody else sends to.  So after as many rounds as
there are levels each block holds the siblings on its way up and the root:
hashes are made many times over, but no pass leads down again.  A round shuffles a
few rows a block.  The tree of the subroots is the same job with one group, and
only block rows, not leaves, meet its proofs.

Texts are hashed once, by the scan; after that rows of two digests are shuffled.
No key holds more rows than a block has places.  A group may hold any share of the
rows, and rows may be equal.

Defined results: rows of equal group and order are ordered by digest (equal ones
are told apart by number, which changes no digest); null order comes first, null
groups are a group, before the others; a group of one leaf is its own subroot; an
empty table has no rows and no root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.shared import materialise, table

FANOUT, DEPTH = 3, 7

_SIDES = T.ArrayType(T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())]))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def framed(col: Column) -> Column:
    """A value as its length in bytes, a colon and itself; null as a dash."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def levels(n: Column, fanout: int = FANOUT) -> Column:
    """Levels of hashing over ``n`` nodes; exact, since it counts powers."""
    powers = [fanout ** k for k in range(64) if fanout ** k < 1 << 63]
    return sum((F.when(n > F.lit(p), 1).otherwise(0) for p in powers), F.lit(0))


def _hash(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def climb(nodes: list[str], n_levels: int, fanout: int = FANOUT) -> list[list[str]]:
    """The nodes of a block at each level, leaves first."""
    rows = [nodes]
    for _ in range(n_levels):
        below = rows[-1]
        rows.append([_hash(below[i:i + fanout]) for i in range(0, len(below), fanout)])
    return rows


def sides(rows: list[list[str]], at: int, fanout: int = FANOUT) -> list[tuple[str, str]]:
    """Siblings left and right of a leaf's way up through a block."""
    out = []
    for below in rows[:-1]:
        first = at - at % fanout
        out.append(("".join(below[first:at]), "".join(below[at + 1:first + fanout])))
        at //= fanout
    return out


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and the siblings on its way lead to."""
    for left, right in path:
        leaf = hashlib.sha256((left + leaf + right).encode()).hexdigest()
    return leaf


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the rows of each group within a sorted partition."""
    from pyspark import TaskContext

    part, now, n = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        at = []
        for group in batch.column(0).to_pylist():
            now, n = group, n + 1 if group == now else 0
            at.append(n)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(at), pa.int32()), pa.array(at, pa.int64())],
                                         names=[*batch.schema.names, "part", "at"])


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``pos``, a row's place in its ``grp``, and ``n``, the rows of that group.

    Ranges of (grp, *order, number) are sorted apart, so a group of any size is
    spread; a range's first place is the sum of what lies before it, for which one
    count a range and group is enough.
    """
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    keys = ["grp", *order, "row"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = numbered.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    cut = cut.select("grp", *[c for c in cut.columns if c != "grp"])
    schema = T.StructType([*cut.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("at", T.LongType())])
    local = materialise(cut.mapInArrow(_running, schema), "merkle-ranges")
    counts = local.groupBy("grp", "part").agg(F.count("*").alias("k"))
    by = W.partitionBy("grp")
    starts = counts.select("grp", "part", (F.sum("k").over(by.orderBy("part")) - F.col("k")).alias("start"), F.sum("k").over(by).alias("n"))
    return (local.join(starts, ["grp", "part"]).withColumn("pos", F.col("start") + F.col("at")).drop("row", "part", "at", "start"))


def blocks(rows: DataFrame, fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """(grp, n, block, leaves, node): a row a block, its leaves in order, its subtree's root.

    ``rows`` has grp, n, pos and leaf, and columns that stay with their leaf.
    """
    size = fanout ** depth
    extra = [c for c in rows.columns if c not in ("grp", "n", "pos", "leaf")]
    gathered = (rows.groupBy("grp", "n", F.expr(f"pos div {size}").alias("block"))
                .agg(F.array_sort(F.collect_list(F.struct("pos", "leaf", *extra))).alias("leaves"))
                .withColumn("own_levels", F.least(levels(F.col("n"), fanout), F.lit(depth))))

    def roots(batches):
        for batch in batches:
            at = {name: i for i, name in enumerate(batch.schema.names)}
            leaves = batch.column(at["leaves"])
            digests = leaves.flatten().field("leaf").to_pylist()
            cuts = (leaves.offsets.to_numpy() - leaves.offsets[0].as_py()).tolist()
            own = batch.column(at["own_levels"]).to_pylist()
            nodes = [climb(digests[a:b], k, fanout)[-1][0] for a, b, k in zip(cuts, cuts[1:], own)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes)], names=[*batch.schema.names, "node"])

    return gathered.mapInArrow(roots, T.StructType([*gathered.schema.fields, T.StructField("node", T.StringType())]))


def butterfly(own: DataFrame, fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """(grp, block, node, path) from (grp, n, block, node): the group's root and the way there.

    ``path`` holds the siblings left and right, level by level above the blocks.
    """
    state = own.select("grp", "block", "node", (F.expr(f"(n + {fanout ** depth - 1}) div {fanout ** depth}")).alias("n_blocks"),
                       levels(F.col("n"), fanout).alias("levels"), F.array().cast(_SIDES).alias("path"))
    top = state.agg(F.max("levels")).first()[0] or 0
    for r in range(max(0, top - depth)):
        w = fanout ** r
        # The subtree's place among its siblings, its first block, its size, the block's place in it.
        here = (state.withColumn("digit", F.expr(f"cast((block div {w}) % {fanout} as int)"))
                .withColumn("first", F.expr(f"block - block % {w}"))
                .withColumn("offset", F.expr(f"block % {w}"))
                .withColumn("size", F.least(F.lit(w), F.col("n_blocks") - F.col("first")))
                .withColumn("going", F.col("levels") > depth + r))
        stays = here.select("grp", "block", "digit", "node", "n_blocks", "levels", "path", "going", F.col("digit").alias("own"))
        to = F.explode(F.sequence(F.lit(0), F.lit(fanout - 1)))
        others = (here.where("going").select("grp", "node", "digit", "first", "offset", "size", "n_blocks", to.alias("to"))
                  .where("`to` <> digit").withColumn("base", F.expr(f"first + (`to` - digit) * {w}"))
                  .withColumn("room", F.least(F.lit(w), F.col("n_blocks") - F.col("base")))
                  .where("offset < room")
                  .select("grp", F.explode(F.expr(f"transform(sequence(offset, room - 1, size), x -> base + x)")).alias("block"), "digit", "node"))
        met = (stays.unionByName(others, allowMissingColumns=True).groupBy("grp", "block")
               .agg(F.array_sort(F.collect_list(F.struct("digit", "node"))).alias("all"),
                    *[F.max(c).alias(c) for c in ("n_blocks", "levels", "going", "own")],
                    F.max(F.when(F.col("own").isNotNull(), F.struct("path", "node"))).alias("mine")))

        def joined(condition: str) -> Column:
            return F.expr(f"array_join(transform(filter(all, x -> {condition}), x -> x.node), '')")

        side = F.struct(joined("x.digit < own").alias("left"), joined("x.digit > own").alias("right"))
        state = met.select("grp", "block", F.when(F.col("going"), digest(joined("true"))).otherwise(F.col("mine.node")).alias("node"), "n_blocks", "levels",
                           F.when(F.col("going"), F.concat(F.col("mine.path"), F.array(side))).otherwise(F.col("mine.path")).cast(_SIDES).alias("path"))
    return state.select("grp", "block", "node", "path")


def tree(leaves: DataFrame, order: list[str], fanout: int = FANOUT, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """Blocks of all groups, and each block's root and upper path.

    ``leaves`` has grp, leaf, the columns of ``order`` and any that stay with the leaf.
    """
    own = materialise(blocks(ranked(leaves, [*order, "leaf"]), fanout, depth), "merkle-blocks")
    return own, materialise(butterfly(own, fanout, depth), "merkle-paths")


_PROOF = "subroot string, root string, proof array<struct<left:string,right:string>>"


def manifest(rows: DataFrame, leaf: Column, group: Column, order: Column, changed: Column | None = None,
             fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """A row for each row: order_key, leaf, subroot, root, proof and what the proof shows.

    ``leaf`` is a row's digest (hexadecimal), ``group`` its tree and ``order`` its place
    there.  ``changed`` is the digest to verify in place of the leaf's (null: the leaf's own):
    ``folded_root`` is where it leads with the proof's siblings, ``verified`` whether that
    is the root.  ``proof`` is a list of the siblings left and right, level by level.
    """
    grp = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))    # sorts null first, then by bytes
    other = F.lit(None).cast("string") if changed is None else changed
    # One pass over the rows themselves; everything after works on digests.
    digests = materialise(rows.select(grp.alias("grp"), order.alias("order_key"), leaf.alias("leaf"), other.alias("changed")), "merkle-leaves")
    own, paths = tree(digests, ["order_key"], fanout, depth)
    subroots = paths.where("block = 0").select(F.lit("").alias("grp"), F.col("grp").alias("order_key"), F.col("node").alias("leaf"))
    top_own, top_paths = tree(subroots, ["order_key"], fanout, depth)
    top = _proofs(top_own, top_paths.select("grp", "block", F.col("node").alias("root"), "path"), fanout)
    upper = (paths.join(top.select(F.col("order_key").alias("grp"), F.col("leaf").alias("subroot"), "root", F.col("proof").alias("above")), "grp")
             .select("grp", "block", "subroot", "root", F.concat("path", "above").alias("path")))
    return _proofs(own, upper, fanout).select("order_key", "leaf", "subroot", "root", "proof", "folded_root",
                                              (F.col("folded_root") == F.col("root")).alias("verified"))


def _proofs(own: DataFrame, upper: DataFrame, fanout: int) -> DataFrame:
    """Each leaf's whole path: through its block, then as its block."""
    joined = own.join(upper, ["grp", "block"])
    fields = own.schema["leaves"].dataType.elementType.fields
    names = [f.name for f in fields if f.name != "pos"]
    subroot = "subroot" in upper.columns
    given = joined.select("leaves", "own_levels", "root", "path", *(["subroot"] if subroot else []))
    schema = T.StructType([*[f for f in fields if f.name != "pos"],
                           *([T.StructField("subroot", T.StringType())] if subroot else []), T.StructField("root", T.StringType()),
                           T.StructField("proof", _SIDES), T.StructField("folded_root", T.StringType())])
    arrow_sides = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))

    def expand(batches):
        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                leaves = column["leaves"][i].values
                digests = leaves.field("leaf").to_pylist()
                rows = climb(digests, column["own_levels"][i].as_py(), fanout)
                path = [(s["left"], s["right"]) for s in column["path"][i].as_py()]
                proof = [sides(rows, k, fanout) + path for k in range(len(digests))]
                shown = leaves.field("changed").to_pylist() if "changed" in names else [None] * len(digests)
                root = column["root"][i].as_py()
                # An unchanged leaf is folded as well: the proof is checked, not assumed.
                folded = [fold(c or leaf, p) for c, leaf, p in zip(shown, digests, proof)]
                n = len(digests)
                flat = [s for p in proof for s in p]
                offsets = [0]
                for p in proof:
                    offsets.append(offsets[-1] + len(p))
                pairs = pa.StructArray.from_arrays([pa.array([s[0] for s in flat], pa.string()), pa.array([s[1] for s in flat], pa.string())],
                                                   fields=list(arrow_sides.value_type))
                yield pa.RecordBatch.from_arrays(
                    [*[leaves.field(c) for c in names], *([pa.array([column["subroot"][i].as_py()] * n)] if subroot else []), pa.array([root] * n),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs).cast(arrow_sides), pa.array(folded)],
                    names=schema.names)

    return given.mapInArrow(expand, schema)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    head = [framed(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    tampers = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    cut = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    changed = F.when(tampers & F.col("text").contains("\n"), digest(*head, framed(cut)))
    out = manifest(docs, digest(*head, framed(F.col("text"))), F.col("source"), F.col("doc_id"), changed)
    siblings = F.expr("array_join(transform(proof, x -> x.left || x.right), '')")
    return out.select(F.col("order_key").alias("doc_id"), "leaf", "subroot", "root", digest(siblings).alias("proof_sha256"), "folded_root", "verified")


_CRC = ("list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),"
        " lambda c, b: xor(c >> 8, t.k[CAST(xor(c, b) & 255 AS INT) + 1]))")

OP12_SQL = rf"""
WITH RECURSIVE t AS (SELECT list(list_reduce(list_prepend(CAST(i AS BIGINT), CAST(range(8) AS BIGINT[])), lambda c, b: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS k FROM range(256) AS r(i)),
d AS (SELECT documents.*, row_number() OVER () AS rid, CASE WHEN doc_id IS NOT NULL AND xor({_CRC}, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS shown FROM documents, t),
f AS (SELECT *, concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
    coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head FROM d),
leaves AS (SELECT rid, doc_id, coalesce('=' || source, '-') AS grp, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(shown) || ':' || shown, '-')) AS changed FROM f),
p AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM leaves),
u AS (SELECT 0 AS lvl, grp, pos, leaf AS h, n FROM p
    UNION ALL SELECT lvl + 1, grp, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM u WHERE n > 1 GROUP BY lvl, grp, pos // 3, n),
s AS (SELECT grp, h AS subroot, lvl AS height, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM u WHERE n = 1),
v AS (SELECT 0 AS lvl, pos, subroot AS h, n FROM s
    UNION ALL SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM v WHERE n > 1 GROUP BY lvl, pos // 3, n),
g AS (SELECT lvl, pos AS mine, coalesce(l, '') AS l, coalesce(r, '') AS r, '*' AS grp FROM (SELECT a.lvl, a.pos,
    string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos) AS l, string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos) AS r
    FROM v a JOIN v b ON a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY a.lvl, a.pos)),
o AS (SELECT lvl, mine, l, r, grp FROM (SELECT a.grp, a.lvl, a.pos AS mine, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
    FROM u a JOIN u b ON a.grp = b.grp AND a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY a.grp, a.lvl, a.pos)),
w AS (SELECT p.rid, o.lvl AS step, o.l, o.r FROM p JOIN o ON o.grp = p.grp AND o.mine = p.pos // CAST(pow(3, o.lvl) AS BIGINT)
    UNION ALL SELECT p.rid, s.height + g.lvl, g.l, g.r FROM p JOIN s ON s.grp = p.grp JOIN g ON g.mine = s.pos // CAST(pow(3, g.lvl) AS BIGINT)),
q AS (SELECT rid, sha256(string_agg(l || r, '' ORDER BY step)) AS proof_sha256, list({{'l': l, 'r': r}} ORDER BY step) AS way FROM w GROUP BY rid),
e AS (SELECT p.doc_id, p.leaf, s.subroot, (SELECT h FROM v WHERE n = 1) AS root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256,
    list_reduce(list_prepend({{'l': p.changed, 'r': ''}}, coalesce(q.way, [])), lambda x, y: {{'l': sha256(y.l || x.l || y.r), 'r': ''}}).l AS folded_root
    FROM p JOIN s ON s.grp = p.grp LEFT JOIN q ON q.rid = p.rid)
SELECT *, folded_root = root AS verified FROM e
"""
