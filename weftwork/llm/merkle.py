"""A Merkle manifest of a table: one leaf for each row, a tree for each source, and a tree over the sources.

H is the SHA-256, in lower-case hexadecimal digits, of its inputs one after the other. Leaves of a source ascend by id; 16 consecutive nodes
(the last run: fewer, even one) have one parent, until one node remains. Subroots, ordered by source with null first, make a tree in the same way.

Rows are numbered within their source by a range partitioning, a sort, and sums over the counts of partitions, so a source
with a third of all rows is no task's alone. ``BLOCK`` consecutive nodes are two levels of a tree, which one task hashes. Their
summits are the nodes of the next round, and rounds end when each tree has one node. Going down again, each block gets the path above it.

Midstates: before each child slot of a parent the hash state is copied and retained. Folding a replaced leaf resumes, at each level, the
state of its slot with the replacement and the siblings to the right only; siblings to the left are never hashed again. The states above
a block are made once for all of its leaves.

Defined cases: null values are told apart from empty ones; rows without an id come first in their source; rows of equal
id are ordered by their leaf, and repeated rows are leaves of their own; an empty table has no leaf and gives no row; a table of one row has that leaf as
its root. Columns beside the fields are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftwork.session import checkpointed

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 16
_BITS = 8  # of a position within a block
BLOCK = 1 << _BITS
LEVELS = 2  # of a whole block: ARITY ** LEVELS == BLOCK
_NODE = "tree string, n long, pos long, digest string"
_PATH = "path array<struct<left:string,right:string>>"


def leaf(fields: Sequence[Column]) -> Column:
    """H of the fields, each ``-`` if null, else its length in UTF-8 bytes, a colon and its value."""
    texts = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _in_order(source: Column) -> Column:
    """The name of a source's tree: not null, and in the order of the sources."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(""))


def _placed(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with their position ``pos`` in their ``tree``, by ``order``, and the number ``n`` of its rows."""
    at = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    # Written with its places: partition number and row number, as the sort has left them.
    at = checkpointed(at.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)))
    parts = at.groupBy("part", "tree").agg(F.min("at").alias("begin"), F.count("*").alias("rows"))
    of_tree = Window.partitionBy("tree")
    before = of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "part", "tree", "begin", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"), F.sum("rows").over(of_tree).alias("n")
    )
    numbered = at.join(parts, ["part", "tree"]).withColumn("pos", F.col("before") + F.col("at") - F.col("begin"))
    return numbered.drop("at", "part", "begin", "before")


def _block() -> Column:
    return F.shiftright("pos", _BITS).alias("block")


def _levels(n: int) -> int:
    """Levels of a block in a tree of n nodes."""
    found = 0
    while found < LEVELS and n > ARITY ** found:
        found += 1
    return found


def _runs(digests: list[str], levels: int) -> list[list[list[str]]]:
    """For each level above ``digests`` its runs of children, and last the summit alone."""
    found, nodes = [], digests
    for _ in range(levels):
        runs = [nodes[i:i + ARITY] for i in range(0, len(nodes), ARITY)]
        found.append(runs)
        nodes = [hashlib.sha256("".join(run).encode()).hexdigest() for run in runs]
    return [*found, [nodes]]


def _sorted(table: pa.Table) -> pa.Table:
    return table.sort_by("pos")


def _summit(table: pa.Table) -> pa.Table:
    table = _sorted(table)
    tree, n, pos = (table.column(c)[0].as_py() for c in ("tree", "n", "pos"))
    summit = _runs(table.column("digest").to_pylist(), _levels(n))[-1][0][0]
    return pa.table({"tree": [tree], "n": [-(-n // BLOCK)], "pos": [pos >> _BITS], "digest": [summit]})


def _climbed(nodes: DataFrame) -> list[DataFrame]:
    """Rounds of nodes (tree, n, pos, digest), the first as given, the last with one node in each tree."""
    rounds = [nodes]
    while (nodes.agg(F.max("n").alias("n")).first()["n"] or 0) > 1:
        nodes = checkpointed(nodes.groupBy("tree", _block()).applyInArrow(_summit, _NODE))
        rounds.append(nodes)
    return rounds


def _beside(run: list[str], slot: int) -> tuple[str, str]:
    return "".join(run[:slot]), "".join(run[slot + 1:])


def _extended(_key: tuple, nodes: pa.Table, above: pa.Table) -> pa.Table:
    """The path of each node of a block: its siblings in the block, then the path above the block."""
    nodes = _sorted(nodes)
    levels = _runs(nodes.column("digest").to_pylist(), _levels(nodes.column("n")[0].as_py()))[:-1]
    rest = above.column("path")[0].as_py()
    paths = []
    for i in range(nodes.num_rows):
        own = []
        for runs in levels:
            left, right = _beside(runs[i // ARITY], i % ARITY)
            own.append({"left": left, "right": right})
            i //= ARITY
        paths.append(own + rest)
    kind = above.schema.field("path").type
    out = {"tree": nodes.column("tree"), "pos": nodes.column("pos"), "path": pa.array(paths, kind)}
    return pa.table(out | {c: pa.array([above.column(c)[0].as_py()] * nodes.num_rows, pa.string()) for c in ("subroot", "root")})


def _descended(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """``above`` (tree, pos, path, subroot, root), the paths of the blocks of the last round, carried down to the nodes of the first."""
    for nodes in reversed(rounds):
        above = checkpointed(
            nodes.groupBy("tree", _block()).cogroup(above.groupBy("tree", "pos"))
            .applyInArrow(_extended, f"tree string, pos long, {_PATH}, subroot string, root string")
        )
    return above


def _folded(leaves: pa.Table, above: pa.Table) -> dict[str, list]:
    """For each leaf of a block the hash of its proof, and the root that its replacement (or itself) gives."""
    digests = leaves.column("leaf").to_pylist()
    levels = []
    for runs in _runs(digests, _levels(leaves.column("n")[0].as_py()))[:-1]:
        level = []
        for run in runs:
            state, joined = hashlib.sha256(), "".join(run).encode()
            size = len(run[0])
            for slot in range(len(run)):
                a, b = slot * size, (slot + 1) * size
                level.append((state.copy(), joined[:a], joined[b:]))
                state.update(joined[a:b])
        levels.append(level)
    path = [(x["left"].encode(), x["right"].encode()) for x in above.column("path")[0].as_py()]
    rest = [(hashlib.sha256(left), right) for left, right in path]
    rest_of_proof = b"".join(left + right for left, right in path)
    proofs, roots = [], []
    for i, (own, replaced) in enumerate(zip(digests, leaves.column("replaced").to_pylist())):
        proof, digest = hashlib.sha256(), replaced or own
        for level in levels:
            state, left, right = level[i]
            proof.update(left + right)
            state = state.copy()
            state.update(digest.encode() + right)
            digest = state.hexdigest()
            i //= ARITY
        for state, right in rest:
            state = state.copy()
            state.update(digest.encode() + right)
            digest = state.hexdigest()
        proof.update(rest_of_proof)
        proofs.append(proof.hexdigest())
        roots.append(digest)
    return {"proof_sha256": proofs, "folded_root": roots}


def _verified(_key: tuple, leaves: pa.Table, above: pa.Table) -> pa.Table:
    leaves = _sorted(leaves)
    subroot, root = (above.column(c)[0].as_py() for c in ("subroot", "root"))
    found = _folded(leaves, above)
    return pa.table({
        "doc_id": leaves.column("doc_id"), "leaf": leaves.column("leaf"), "subroot": [subroot] * leaves.num_rows, "root": [root] * leaves.num_rows,
        **found, "verified": [x == root for x in found["folded_root"]],
    })


@dataclass
class Manifest:
    """``rows`` (tree, doc_id, leaf, replaced, n, pos), the rounds of nodes above them, and for each tree its subroot and path to the root."""

    rows: DataFrame
    rounds: list[DataFrame]
    tops: DataFrame

    def above_blocks(self) -> DataFrame:
        """Rows (tree, pos, path, subroot, root): the path above each block of leaves."""
        return _descended(self.rounds[1:-1], self.tops)

    def paths(self) -> DataFrame:
        """Rows (doc_id, leaf, path, subroot, root): left and right siblings of each leaf at each level, up to the root."""
        above = _descended(self.rounds[:-1], self.tops)
        return self.rows.select("tree", "pos", "doc_id", "leaf").join(above, ["tree", "pos"]).drop("tree", "pos")

    def verify(self) -> DataFrame:
        """Rows (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of all leaves."""
        kind = self.rows.schema["doc_id"].dataType.simpleString()
        schema = (
            f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        )
        return (
            self.rows.groupBy("tree", _block()).cogroup(self.above_blocks().groupBy("tree", "pos")).applyInArrow(_verified, schema)
        )


def manifest(table: DataFrame, changed: dict[str, Column] | None = None, when: Column | None = None, fields: Sequence[str] = FIELDS) -> Manifest:
    """The manifest of ``table``, whose first two ``fields`` are its id and its source.

    Rows for which ``when`` is true are replaced by themselves with the ``changed`` columns when proofs are folded.
    """
    key, source = fields[:2]
    replaced = F.when(when, leaf([(changed or {}).get(c, F.col(c)) for c in fields])) if when is not None else F.lit(None).cast("string")
    # Written before it is sampled for ranges, so that texts are hashed once.
    leaves = checkpointed(table.select(
        _in_order(F.col(source)).alias("tree"), F.col(key).alias("doc_id"), leaf([F.col(c) for c in fields]).alias("leaf"), replaced.alias("replaced"),
    ))
    rows = checkpointed(_placed(leaves, "doc_id", "leaf"))
    rounds = _climbed(rows.select("tree", "n", "pos", F.col("leaf").alias("digest")))
    subroots = rounds[-1].select(F.col("tree").alias("source_tree"), F.col("digest").alias("subroot"))
    forest = checkpointed(_placed(subroots.withColumn("tree", F.lit("")), "source_tree"))
    forest_rounds = _climbed(forest.select("tree", "n", "pos", F.col("subroot").alias("digest")))
    root = forest_rounds[-1].select(
        "tree", "pos", F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.lit(None).cast("string").alias("subroot"),
        F.col("digest").alias("root"),
    )
    down = _descended(forest_rounds[:-1], root).drop("tree", "subroot")
    tops = forest.select(F.col("source_tree").alias("tree"), "pos", "subroot").join(down, "pos")
    return Manifest(rows, rounds, checkpointed(tops.select("tree", F.lit(0).cast("long").alias("pos"), "path", "subroot", "root")))


def lower_ascii(text: Column) -> Column:
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, capitals, capitals.lower())


def audited(documents: DataFrame) -> DataFrame:
    """Verification of all documents, where the text of those whose CRC-32 of the id is divisible by 5 has lost its capitals A to Z."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return manifest(documents, {"text": lower_ascii(F.col("text"))}, F.coalesce(hit, F.lit(False))).verify()


def _sql(levels: int = 5, forest_levels: int = 3) -> str:
    """SQL for ``audited``, for sources of up to 16 ** levels rows and 16 ** forest_levels sources."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def hashed(text: str) -> str:
        parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END" for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(parts)})"

    # CRC-32 bit by bit: every eighth step takes in a byte of the id.
    taken = "xor(c, CASE WHEN j % 8 = 0 THEN ascii(substr(doc_id::VARCHAR, j // 8 + 1, 1)) ELSE 0 END)"
    step = f"xor({taken} // 2, CASE WHEN {taken} % 2 = 1 THEN 3988292384 ELSE 0 END)"
    steps = [
        f"""docs AS (SELECT *, coalesce('s' || source, '') AS tree, translate(text, '{capitals}', '{capitals.lower()}') AS lowered,
            list_reduce(range(0, 8 * length(doc_id::VARCHAR)), lambda c, j: {step}, 4294967295) AS crc FROM documents)""",
        f"leaves AS (SELECT *, {hashed('text')} AS leaf, CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN {hashed('lowered')} END AS replaced FROM docs)",
        """n0 AS (SELECT tree, doc_id, leaf, replaced, leaf AS d, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
            count(*) OVER (PARTITION BY tree) AS n FROM leaves)""",
    ]

    def climb(name: str, k: int) -> str:
        return f"""{name}{k + 1} AS (SELECT tree, i // 16 AS i, (any_value(n) + 15) // 16 AS n,
            CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d FROM {name}{k} GROUP BY tree, i // 16)"""

    def fold(step: str, name: str, k: int, level: int) -> str:
        return f"""{step}{level + 1} AS (SELECT a.row, any_value(a.tree) AS tree, any_value(a.i) // 16 AS i,
            any_value(a.proof) || coalesce(string_agg(s.d, '' ORDER BY s.i) FILTER (s.i <> a.i), '') AS proof,
            CASE WHEN any_value(s.n) = 1 THEN any_value(a.d) ELSE sha256(string_agg(CASE WHEN s.i = a.i THEN a.d ELSE s.d END, '' ORDER BY s.i)) END AS d
            FROM {step}{level} a JOIN {name}{k} s ON s.tree = a.tree AND s.i // 16 = a.i // 16 GROUP BY a.row)"""

    steps += [climb("n", k) for k in range(levels)]
    steps.append(f"f0 AS (SELECT 'all' AS tree, tree AS source_tree, d, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM n{levels})")
    steps += [climb("f", k) for k in range(forest_levels)]
    steps.append("rows AS (SELECT row_number() OVER () AS row, * FROM n0)")
    steps.append("a0 AS (SELECT row, tree, i, '' AS proof, coalesce(replaced, leaf) AS d FROM rows)")
    steps += [fold("a", "n", k, k) for k in range(levels)]
    steps.append(f"b0 AS (SELECT a.row, 'all' AS tree, f0.i, a.proof, a.d FROM a{levels} a JOIN f0 ON f0.source_tree = a.tree)")
    steps += [fold("b", "f", k, k) for k in range(forest_levels)]
    return f"""WITH {", ".join(steps)}
        SELECT doc_id, leaf, f0.d AS subroot, top.d AS root, sha256(b.proof) AS proof_sha256, b.d AS folded_root, b.d = top.d AS verified
        FROM rows JOIN b{forest_levels} b USING (row) JOIN f0 ON f0.source_tree = rows.tree CROSS JOIN f{forest_levels} top"""


SQL = _sql()
