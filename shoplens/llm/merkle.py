"""Merkle manifest of a dataset: proofs of rows, and folding of changed rows through saved hash states.

Rows are leaves, hashed by Spark; per group they ascend by id, every ``fanout`` consecutive nodes become
a parent (SHA-256 of the children's hex digests) until one is left, and the groups' tops form a tree in
the same way. The manifest is a table of nodes. Each node's row also keeps a copy of the state that
its parent's hash had before the node's slot, so a leaf, changed or not, is folded upward by resuming that
state with its digest and the right siblings only; nothing to the left is hashed again.

Trees are built in blocks of at most ``BLOCK`` leaves, whole subtrees that one task each builds; the tops of
the blocks are the leaves of the next round. What a block needs from above, its path to the root, is one
row a block, joined downward once.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, numbered, thin_parts

BLOCK = 16_384
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
HEX = np.frombuffer(b"".join(b"%02x" % i for i in range(256)), np.uint8).reshape(256, 2)
NODES = "grp binary, block long, level int, at long, digest binary, state binary, top boolean, doc_id long, changed binary"


# --- SHA-256 of many messages in step, from any saved state -------------------------------

def _root_bits(prime: int, cube: bool) -> int:
    """The first 32 bits behind the point of a prime's square or cube root."""
    if not cube:
        return math.isqrt(prime << 64) & 0xFFFFFFFF
    wide = prime << 96
    root = round(wide ** (1 / 3))
    while root ** 3 > wide:
        root -= 1
    while (root + 1) ** 3 <= wide:
        root += 1
    return root & 0xFFFFFFFF


PRIMES = [p for p in range(2, 312) if all(p % q for q in range(2, p))]
START = np.array([_root_bits(p, False) for p in PRIMES[:8]], np.uint32)
ROUND = np.array([_root_bits(p, True) for p in PRIMES[:64]], np.uint32)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return x >> np.uint32(n) | x << np.uint32(32 - n)


def resume(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """States (n, 8) after one more block of 64 bytes (n, 64)."""
    w = list(np.ascontiguousarray(block).view(">u4").T.astype(np.uint32, order="C"))
    for i in range(16, 64):
        a, b = w[i - 15], w[i - 2]
        w.append(w[i - 16] + (_turn(a, 7) ^ _turn(a, 18) ^ a >> np.uint32(3)) + w[i - 7] + (_turn(b, 17) ^ _turn(b, 19) ^ b >> np.uint32(10)))
    a, b, c, d, e, f, g, h = np.ascontiguousarray(state.T)
    for k, x in zip(ROUND, w):
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (e & f ^ ~e & g) + k + x
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + (a & b ^ a & c ^ b & c)
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return state + np.array([a, b, c, d, e, f, g, h]).T


def to_hex(digest: np.ndarray) -> np.ndarray:
    return HEX[digest].reshape(len(digest), 64)


def finish(state: np.ndarray, children: np.ndarray) -> np.ndarray:
    """Digests (n, 32) of messages that end here, after ``children`` hex digests each."""
    last = np.zeros((len(state), 64), np.uint8)
    last[:, 0] = 0x80
    last[:, 56:] = (children.astype(np.int64) * 512).astype(">i8").view(np.uint8).reshape(-1, 8)
    return resume(state, last).astype(">u4").view(np.uint8).reshape(-1, 32)


class Tree:
    """The levels of one block: digests (n, 32) of each, and per node below the top the state before its slot."""

    def __init__(self, levels: list[np.ndarray], states: list[np.ndarray], fanout: int):
        self.levels, self.states, self.fanout = levels, states, fanout

    @classmethod
    def grow(cls, leaves: np.ndarray, fanout: int, depth: int, whole: bool) -> Tree:
        """``whole``: go up ``depth`` levels, since the block is one of several; else to a single node."""
        levels, states = [leaves], []
        while len(states) < depth and (whole or len(levels[-1]) > 1):
            nodes = levels[-1]
            size = np.minimum(fanout, len(nodes) - np.arange(0, len(nodes), fanout))
            state, before = np.tile(START, (len(size), 1)), np.empty((len(nodes), 8), np.uint32)
            for slot in range(fanout):
                child = nodes[slot::fanout]
                before[slot::fanout] = state[:len(child)]
                state[:len(child)] = resume(state[:len(child)], to_hex(child))
            states.append(before)
            levels.append(finish(state, size))
        return cls(levels, states, fanout)

    @classmethod
    def saved(cls, table: pa.Table, fanout: int) -> Tree:
        """From a block's rows of a manifest, by level and place."""
        level = table["level"].to_numpy()
        ends = np.flatnonzero(np.diff(level, append=level[-1] + 1)) + 1
        parts = [table.slice(a, b - a) for a, b in zip([0, *ends], ends)]
        levels = [np.frombuffer(b"".join(t["digest"].to_pylist()), np.uint8).reshape(-1, 32) for t in parts]
        states = [np.frombuffer(b"".join(t["state"].to_pylist()), np.uint32).reshape(-1, 8) for t in parts[:-1]]
        return cls(levels, states, fanout)

    def fold(self, at: np.ndarray, digest: np.ndarray) -> np.ndarray:
        """The block's top if the leaf ``at`` were ``digest``, for each of them alone."""
        for nodes, before in zip(self.levels, self.states):
            slot, first = at % self.fanout, at - at % self.fanout
            size = np.minimum(self.fanout, len(nodes) - first)
            state = resume(before[at], to_hex(digest))
            for right in range(1, self.fanout):
                some = np.flatnonzero(slot + right < size)
                state[some] = resume(state[some], to_hex(nodes[at[some] + right]))
            digest, at = finish(state, size), at // self.fanout
        return digest

    def siblings(self) -> list[tuple[list[np.ndarray], np.ndarray]]:
        """Per level and other slot: hex digests (leaf, 64) and whether there is such a sibling."""
        out, at = [], np.arange(len(self.levels[0]))
        for nodes in self.levels[:-1]:
            hexes, first = to_hex(nodes), at - at % self.fanout
            for slot in range(self.fanout):
                other = first + slot
                out.append((hexes[np.minimum(other, len(nodes) - 1)], (other != at) & (other < len(nodes))))
            at = at // self.fanout
        return out

    def path(self, at: int) -> list[bytes]:
        """A step a level: the state before the node's slot, the number of left siblings, all siblings."""
        steps = []
        for nodes, before in zip(self.levels, self.states):
            first = at - at % self.fanout
            run = nodes[first:first + self.fanout]
            steps.append(before[at].tobytes() + (at - first).to_bytes(4, "little") + np.delete(run, at - first, axis=0).tobytes())
            at //= self.fanout
        return steps


def fold_path(path: list[bytes], digest: np.ndarray) -> np.ndarray:
    for step in path:
        left, others = int.from_bytes(step[32:36], "little"), np.frombuffer(step[36:], np.uint8).reshape(-1, 32)
        state = resume(np.tile(np.frombuffer(step[:32], np.uint32), (len(digest), 1)), to_hex(digest))
        for right in to_hex(others[left:]):
            state = resume(state, np.tile(right, (len(digest), 1)))
        digest = finish(state, np.full(len(digest), len(others) + 1))
    return digest


# --- manifest ------------------------------------------------------------------------------

def field(c: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    s = c.cast("string")
    return F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(columns: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256))


def _depth(fanout: int) -> int:
    return max(1, int(math.log(BLOCK, fanout) + 1e-9))


def _build(fanout: int):
    def run(key, table):
        grp, block = (k.as_py() for k in key)
        table = table.sort_by("at")
        leaves = np.frombuffer(b"".join(table["digest"].to_pylist()), np.uint8).reshape(-1, 32)
        # only a group's first block can be its only one; where it is full, both rules give one tree
        tree = Tree.grow(leaves, fanout, _depth(fanout), block > 0)
        out = []
        for level, nodes in enumerate(tree.levels):
            n, top = len(nodes), level + 1 == len(tree.levels)
            states = [None] if top else [s.tobytes() for s in tree.states[level]]
            first = level == 0
            out.append(pa.table({
                "grp": pa.array([grp] * n, pa.binary()), "block": pa.array([block] * n, pa.int64()),
                "level": pa.array([level] * n, pa.int32()), "at": pa.array(range(n), pa.int64()),
                "digest": pa.array([d.tobytes() for d in nodes], pa.binary()), "state": pa.array(states, pa.binary()),
                "top": pa.array([top] * n), "doc_id": table["doc_id"] if first else pa.nulls(n, pa.int64()),
                "changed": table["changed"] if first else pa.nulls(n, pa.binary())}))
        return pa.concat_tables(out).combine_chunks()

    return run


class Manifest:
    """``rounds``: node tables, of leaves first; ``upper``: those over the groups' tops; ``tops``: (grp, subroot)."""

    def __init__(self, rounds: list[DataFrame], upper: list[DataFrame], tops: DataFrame, fanout: int, blocks: int):
        self.rounds, self.upper, self.tops, self.fanout, self.blocks = rounds, upper, tops, fanout, blocks


def _rounds(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame, int]:
    """Node tables of (grp, __n, digest, doc_id, changed) up to one node a group, these, and the number of
    blocks of the first table."""
    spark, size, out, blocks = nodes.sparkSession, fanout ** _depth(fanout), [], 0
    while True:
        rows = nodes.select("grp", F.floor(F.col("__n") / size).cast("long").alias("block"), (F.col("__n") % size).alias("at"), "digest", "doc_id", "changed")
        n = rows.count()
        parts = thin_parts(spark, max(1, n // size + 1))
        done = materialize(rows.repartition(parts, "grp", "block").groupBy("grp", "block").applyInArrow(_build(fanout), NODES))
        out.append(done)
        tops = done.filter("top")
        counted = tops.agg(F.count("*"), F.max("block")).first()
        blocks = blocks or counted[0]
        if not counted[1]:
            return out, tops.select("grp", F.col("digest").alias("subroot")), blocks
        nodes = tops.select("grp", F.col("block").alias("__n"), "digest", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("changed"))


def build_manifest(leaves: DataFrame, fanout: int = 2) -> Manifest:
    """From (grp binary, doc_id, leaf, changed): ``changed`` is a leaf to fold in instead, or null. Leaves ascend by
    id, null ids first, then by digest; groups by their bytes."""
    tie = leaves.withColumn("__tie", F.monotonically_increasing_id())
    nodes = numbered(tie, [F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("__tie")], ["grp"])
    rounds, tops, blocks = _rounds(nodes.withColumnRenamed("leaf", "digest"), fanout)
    one = tops.select(F.lit(b"").alias("grp"), F.col("grp").alias("__grp"), F.col("subroot").alias("digest"),
                      F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("changed"))
    upper_nodes = materialize(numbered(one, [F.col("__grp")], ["grp"]))
    upper, root, _ = _rounds(upper_nodes, fanout)
    root = upper_nodes.join(root.withColumnRenamed("subroot", "root"), "grp").select(F.col("__grp").alias("grp"), "__n", "root")
    tops = tops.join(root, "grp")
    return Manifest(rounds, upper, materialize(tops), fanout, blocks)


def _steps_up(fanout: int):
    """A block's nodes to (grp, at, path): the way from each of its leaves to its top."""
    def run(key, table):
        grp, block = (k.as_py() for k in key)
        tree = Tree.saved(table.sort_by([("level", "ascending"), ("at", "ascending")]), fanout)
        n = len(tree.levels[0])
        at = np.arange(n) + block * fanout ** _depth(fanout)
        return pa.table({"grp": pa.array([grp] * n, pa.binary()), "block": pa.array(at, pa.int64()), "over": pa.array([block] * n, pa.int64()),
                         "path": pa.array([tree.path(i) for i in range(n)], pa.list_(pa.binary()))})

    return run


def _ways(rounds: list[DataFrame], fanout: int) -> DataFrame | None:
    """(grp, block, path) from each leaf of the first of these tables to its group's top."""
    way = None
    for table in reversed(rounds):
        up = table.groupBy("grp", "block").applyInArrow(_steps_up(fanout), "grp binary, block long, over long, path array<binary>")
        if way is not None:
            way = up.join(way.select("grp", F.col("block").alias("over"), F.col("path").alias("rest")), ["grp", "over"])
            way = way.select("grp", "block", F.concat("path", "rest").alias("path"))
        else:
            way = up.select("grp", "block", "path")
        way = materialize(way)
    return way


def paths(manifest: Manifest) -> DataFrame:
    """(grp, block, path, subroot, root) for each block of leaves."""
    top = _ways(manifest.upper, manifest.fanout).select(F.col("block").alias("__n"), F.col("path").alias("rest"))
    groups = manifest.tops.join(top, "__n").select("grp", "subroot", "root", "rest")
    below = _ways(manifest.rounds[1:], manifest.fanout)
    if below is None:
        return groups.select("grp", F.lit(0).cast("long").alias("block"), F.col("rest").alias("path"), "subroot", "root")
    return below.join(groups, "grp").select("grp", "block", F.concat("path", "rest").alias("path"), "subroot", "root")


def _prove(fanout: int):
    def run(key, table, above):
        table = table.sort_by([("level", "ascending"), ("at", "ascending")])
        tree = Tree.saved(table, fanout)
        n = len(tree.levels[0])
        leaves = table.slice(0, n)
        path, subroot, root = above["path"][0].as_py(), above["subroot"][0].as_py(), above["root"][0].as_py()
        beyond = b"".join(to_hex(np.frombuffer(step[36:], np.uint8).reshape(-1, 32)).tobytes() for step in path)
        near = tree.siblings()
        hexes = np.stack([h for h, _ in near], axis=1) if near else np.empty((n, 0, 64), np.uint8)
        there = np.stack([t for _, t in near], axis=1) if near else np.empty((n, 0), bool)
        proof = [hashlib.sha256(h[t].tobytes() + beyond).digest() for h, t in zip(hexes, there)]
        start = pa.compute.coalesce(leaves["changed"], leaves["digest"])
        tops = fold_path(path, tree.fold(np.arange(n), np.frombuffer(b"".join(start.to_pylist()), np.uint8).reshape(-1, 32)))
        folded = [top.tobytes() for top in tops]
        return pa.table({"doc_id": leaves["doc_id"], "leaf": leaves["digest"], "subroot": pa.array([subroot] * n, pa.binary()),
                         "root": pa.array([root] * n, pa.binary()), "proof": pa.array(proof, pa.binary()), "folded": pa.array(folded, pa.binary())})

    return run


def prove(manifest: Manifest) -> DataFrame:
    """Per leaf, digests as binary: doc_id, leaf, subroot, root, proof (SHA-256 of the siblings' hex digests up to the
    root) and folded (the root hashed anew from ``changed``, else from the leaf)."""
    parts = thin_parts(manifest.tops.sparkSession, manifest.blocks)
    left = manifest.rounds[0].drop("top").repartition(parts, "grp", "block").groupBy("grp", "block")
    right = paths(manifest).repartition(parts, "grp", "block").groupBy("grp", "block")
    return left.cogroup(right).applyInArrow(_prove(manifest.fanout), "doc_id long, leaf binary, subroot binary, root binary, proof binary, folded binary")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document; rows of one id are leaves of their own, alike ones too. A null language is a group of
    its own; rows without an id come first and are never tampered with."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS)
    named = {c: F.col(c) for c in FIELDS}
    tampered = named | {"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1}
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    grp = F.coalesce(F.concat(F.lit(b"\x01"), F.col("lang").cast("binary")), F.lit(b""))
    leaves = docs.select(grp.alias("grp"), "doc_id", leaf(list(named.values())).alias("leaf"), F.when(hit, leaf(list(tampered.values()))).alias("changed"))
    out = prove(build_manifest(leaves))
    return out.select("doc_id", *[F.lower(F.hex(c)).alias(n) for c, n in (
        ("leaf", "leaf"), ("subroot", "subroot"), ("root", "root"), ("proof", "proof_sha256"), ("folded", "folded_root"))],
        (F.col("folded") == F.col("root")).alias("verified"))


#: CRC-32 by its table of 256 steps; trees and walks by recursion.
OP13_SQL = r"""
WITH RECURSIVE bits AS (SELECT i, 0 AS step, i AS crc FROM range(256) t(i)
  UNION ALL SELECT i, step + 1, CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END FROM bits WHERE step < 8),
crc_of AS (SELECT list(crc ORDER BY i) AS tab FROM bits WHERE step = 8),
docs AS (
  SELECT row_number() OVER () AS r, lang, doc_id,
    CASE WHEN doc_id IS NULL THEN '-' ELSE length(doc_id::VARCHAR) || ':' || doc_id END
      || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
      || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
    n_chars, CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                    lambda crc, b: xor(crc >> 8, tab[1 + (xor(crc, b) & 255)])), 4294967295) % 7 = 0 AS hit
  FROM documents, crc_of),
leaves AS (
  SELECT r, lang, doc_id, sha256(head || coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    CASE WHEN hit THEN sha256(head || coalesce(length((n_chars::HUGEINT + 1)::VARCHAR) || ':' || (n_chars::HUGEINT + 1), '-') || tail) END AS changed
  FROM docs),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos FROM leaves),
low AS (
  SELECT lang, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(h || coalesce(nxt, '')), (n + 1) // 2
  FROM (SELECT *, lead(h) OVER (PARTITION BY lang ORDER BY pos) AS nxt FROM low WHERE n > 1) WHERE pos % 2 = 0),
tops AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, pos, subroot AS h, count(*) OVER () AS n FROM tops
  UNION ALL
  SELECT level + 1, pos // 2, sha256(h || coalesce(nxt, '')), (n + 1) // 2
  FROM (SELECT *, lead(h) OVER (ORDER BY pos) AS nxt FROM high WHERE n > 1) WHERE pos % 2 = 0),
nodes AS (
  SELECT lang, 0 AS part, level, pos, h, n FROM low WHERE n > 1
  UNION ALL SELECT NULL, 1, level, pos, h, n FROM high WHERE n > 1),
walk AS (
  SELECT r, lang, 0 AS part, 0 AS level, pos, changed AS folded, '' AS proof FROM placed
  UNION ALL
  SELECT w.r, w.lang, w.part, w.level + 1, w.pos // 2,
    sha256(CASE WHEN w.pos % 2 = 1 THEN s.h || w.folded ELSE w.folded || coalesce(s.h, '') END), w.proof || coalesce(s.h, '')
  FROM walk w JOIN (SELECT DISTINCT part, lang, level, n FROM nodes) l
      ON w.part = 0 AND l.part = 0 AND w.level = l.level AND w.lang IS NOT DISTINCT FROM l.lang
    LEFT JOIN nodes s ON s.part = 0 AND s.level = w.level AND s.lang IS NOT DISTINCT FROM w.lang AND s.pos = xor(w.pos, 1)),
below AS (SELECT r, lang, arg_max(folded, level) AS folded, arg_max(proof, level) AS proof, max(level) AS level FROM walk GROUP BY r, lang),
climb AS (
  SELECT b.r, t.pos, 0 AS level, w.folded, w.proof FROM below b JOIN tops t ON b.lang IS NOT DISTINCT FROM t.lang JOIN walk w ON w.r = b.r AND w.level = b.level
  UNION ALL
  SELECT c.r, c.pos // 2, c.level + 1, sha256(CASE WHEN c.pos % 2 = 1 THEN s.h || c.folded ELSE c.folded || coalesce(s.h, '') END), c.proof || coalesce(s.h, '')
  FROM climb c JOIN (SELECT DISTINCT level, n FROM high WHERE n > 1) l ON l.level = c.level
    LEFT JOIN high s ON s.level = c.level AND s.pos = xor(c.pos, 1)),
done AS (SELECT r, max(level) AS level FROM climb GROUP BY r)
SELECT p.doc_id, p.leaf, t.subroot, root.h AS root, sha256(c.proof) AS proof_sha256, coalesce(c.folded, root.h) AS folded_root,
  coalesce(c.folded, root.h) = root.h AS verified
FROM placed p JOIN tops t ON p.lang IS NOT DISTINCT FROM t.lang JOIN done d ON d.r = p.r JOIN climb c ON c.r = d.r AND c.level = d.level,
  (SELECT h FROM high WHERE n = 1) root
"""
