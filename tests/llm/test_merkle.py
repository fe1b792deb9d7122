import hashlib
import random
import zlib

import numpy as np
import pytest

from shoplens.llm import merkle as M

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode('utf-8'))}:{v}" for v in row))


def tree(nodes, fanout):
    """(top, for each node the siblings' runs upward as (left, right))."""
    ways, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(place):
            first = p - p % fanout
            run = nodes[first:first + fanout]
            ways[i].append((run[:p - first], run[p - first + 1:]))
            place[i] = p // fanout
        nodes = [sha("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]
    return nodes[0], ways


def brute(rows, fanout=2):
    """rows: (doc_id, source, lang, n_chars, text); one result a row, sorted."""
    groups = {}
    for r in rows:
        groups.setdefault((r[2] is not None, (r[2] or "").encode()), []).append(r)
    order = sorted(groups)
    tops, ways = [], []
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        top, way = tree([leaf(r) for r in groups[g]], fanout)
        tops.append(top)
        ways.append(way)
    root, over = tree(tops, fanout) if tops else (None, [])
    out = []
    for g, top, way, up in zip(order, tops, ways, over):
        for r, w in zip(groups[g], way):
            w = w + up
            now = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                now = leaf((*r[:3], None if r[3] is None else r[3] + 1, r[4]))
            for left, right in w:
                now = sha("".join(left) + now + "".join(right))
            out.append((r[0], leaf(r), top, root, sha("".join("".join(a + b) for a, b in w)), now, now == root))
    return sorted(out, key=repr)


def digests(spark, docs, fanout=2):
    from pyspark.sql import functions as F
    named = {c: F.col(c) for c in M.FIELDS}
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    grp = F.coalesce(F.concat(F.lit(b"\x01"), F.col("lang").cast("binary")), F.lit(b""))
    leaves = docs.select(grp.alias("grp"), "doc_id", M.leaf(list(named.values())).alias("leaf"),
                         F.when(hit, M.leaf(list((named | {"n_chars": F.col("n_chars") + 1}).values()))).alias("changed"))
    rows = M.prove(M.build_manifest(leaves, fanout)).collect()
    hexes = [(r.doc_id, *(x.hex() for x in (r.leaf, r.subroot, r.root, r.proof, r.folded))) for r in rows]
    return sorted(((*h, h[5] == h[3]) for h in hexes), key=repr)


def test_resumed_states_equal_the_library():
    rng = np.random.default_rng(3)
    for blocks in (1, 2, 5):
        data = rng.integers(0, 256, (40, 64 * blocks), dtype=np.uint8)
        state = np.tile(M.START, (40, 1))
        for i in range(blocks):
            state = M.resume(state, data[:, 64 * i:64 * i + 64])
        got = M.finish(state, np.full(40, blocks))
        assert [g.tobytes() for g in got] == [hashlib.sha256(d.tobytes()).digest() for d in data]


@pytest.mark.parametrize("fanout,block,n", [(2, 8, 75), (2, 8, 64), (3, 9, 100), (2, 16_384, 40), (5, 5, 131)])
def test_trees_of_many_blocks(spark, monkeypatch, fanout, block, n):
    monkeypatch.setattr(M, "BLOCK", block)
    rng = random.Random(n)
    langs = ["en", "en", "en", None, "", "zz", "é", "a"]
    rows = [(i, "s", rng.choice(langs), i * 3, f"text {i}") for i in range(n)]
    rows += [(n, None, "only", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert digests(spark, docs, fanout) == brute(rows, fanout)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*M.FIELDS).collect()]
    got = [tuple(r) for r in M.op13_merkle_manifest(spark, SF).collect()]
    assert sorted(got, key=repr) == brute(rows)
    assert 0 < sum(not r[6] for r in got) < len(got)


def test_hard_rows(spark, tmp_path):
    rows = [(None, None, None, None, None), (None, "s", "en", 1, ""), (7, "s", "en", 2, "x" * 300_000), (7, "s", "en", 2, "x" * 300_000),
            (7, "s", "en", 3, "ü€😀"), (-5, "", "", 0, ""), (9, "s", None, 5, "a")] + [(50, "s", "en", 1, "same")] * 300
    # columns beside the five are no part of a leaf
    docs = spark.createDataFrame([(*r, 1, "y") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, grp int, block string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in M.op13_merkle_manifest(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_unchanged_leaves_are_folded_too(spark):
    """A leaf that is not tampered with is hashed up to the root like the others: altered in the
    manifest, or against another root, it does not verify."""
    from pyspark.sql import functions as F
    rows = [(g, i, bytes([i]) * 32, None) for g in (b"a", b"b") for i in range(5)]
    leaves = spark.createDataFrame(rows, "grp binary, doc_id long, leaf binary, changed binary")
    manifest = M.build_manifest(leaves)
    assert all(r.folded == r.root for r in M.prove(manifest).collect())
    first = (F.col("grp") == b"a") & (F.col("level") == 0) & (F.col("at") == 0)
    manifest.rounds[0] = manifest.rounds[0].withColumn("digest", F.when(first, F.lit(b"x" * 32)).otherwise(F.col("digest")))
    # its right sibling resumes the state saved before, so only its own fold meets the altered digest
    assert [r.folded == r.root for r in M.prove(manifest).collect()].count(False) == 1
    manifest.tops = manifest.tops.withColumn("root", F.lit(b"y" * 32))
    assert not any(r.folded == r.root for r in M.prove(manifest).collect())


def test_largest_count_is_tampered_without_overflow(spark, tmp_path):
    top = 2 ** 63 - 1
    rows = [(i, "s", "en", top, "t") for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted((tuple(r) for r in M.op13_merkle_manifest(spark, str(tmp_path)).collect()), key=repr) == brute(rows)


def test_no_rows(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert M.op13_merkle_manifest(spark, str(tmp_path)).collect() == []
