"""Operators 7 and 10 against brute force, on rows with nulls, ties and repeats."""

import hashlib
import re
import uuid
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from llm_fixtures import make  # noqa: F401
from shoplens.llm import exact_dedup as E
from shoplens.llm import line_dedup as L

LONG = "this line is long enough to count as a shared one"
HARD = [(1, "a  b"), (2, "a b"), (3, None), (4, ""), (5, " "), (6, "a\tb"), (6, "a b"), (6, "a b"), (None, "a b"), (None, "q"),
        (7, "x " * 50_000), (8, "x\n" * 50_000)]


def test_exact_dedup_on_hard_rows(make):
    got = E.deduplicate(make(HARD), cuts=[3, 6]).collect()
    groups = defaultdict(list)
    for i, t in HARD:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    want = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        sha = hashlib.sha256(text.encode()).hexdigest()
        want += [(i, min(known) if known else None, len(ids), sha) for i in ids]
    key = lambda r: (r[3], r[0] is None, r[0] or 0)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=key) == sorted(want, key=key)
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) == len({r.text_sha256 for r in kept})  # of repeated rows one stays
    assert all(r.doc_id == r.keep_id for r in kept)


def test_exact_dedup_of_an_empty_table(make):
    assert E.deduplicate(make([])).collect() == []


def test_index_persists_and_takes_only_what_is_new(spark, make):
    index = E.DigestIndex(spark, f"idx_{uuid.uuid4().hex}")
    index.ingest(E.digest_rows(make([(5, "a"), (6, "b"), (7, "a ")])))
    assert index.read().count() == 3
    rows = E.digest_rows(make([(1, "a"), (2, "c"), (3, "c")]))
    assert index.fresh(rows.select("digest", F.col("doc_id").alias("keep_id"), "row_key")).select("keep_id").distinct().count() == 2
    index.ingest(rows)
    index.ingest(rows)  # a repeated batch adds nothing
    assert sorted(r.keep_id for r in index.read().collect()) == [2, 5, 6, 7]  # the first batch wins
    plan = index.fresh(rows)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan


def brute_lines(rows, min_docs=5, min_chars=40):
    def key(line):
        k = line.strip(" \t\n\x0b\x0c\r")
        return k.encode().lower() if len(k) >= min_chars else None

    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if key(line):
                held[key(line)].add(i)
    low = lambda i: float("-inf") if i is None else i
    keeper = {k: max(ids, key=low) for k, ids in held.items() if len(ids) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if keeper.get(key(x), i) == i]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return out


def test_lines_on_hard_rows(make):
    rows = [(i, f"own {i}\n  {LONG.upper()}\t\n{LONG}") for i in range(1, 8)]
    rows += [(20, LONG), (20, LONG), (21, None), (22, ""), (23, LONG + " é"), (24, LONG[:39] + "\n" + LONG[:39]), (None, LONG),
             (25, "\n".join([LONG, "z" * 60] * 2000))]
    rows += [(30 + i, "four hold this line, which is not enough at all") for i in range(4)]
    got = [(r.doc_id, r.text or "", r["__n_lines"], r["__n_dropped"]) for r in L.dedup_lines(make(rows)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=key) == sorted(brute_lines(rows), key=key)


def test_lines_of_an_empty_table_and_clashing_columns(make):
    docs = make([])
    out = L.dedup_lines(docs.drop("__drop"))
    assert out.collect() == [] and out.columns == [*docs.drop("__drop").columns, "__n_lines", "__n_dropped"]


def test_bloom_pair_misses_no_repeat():
    rng = np.random.default_rng(1)
    keys = np.frombuffer(rng.bytes(16 * 5000), L._PAIR)
    pair = L.BloomPair(10_000)
    pair.add(keys, np.zeros(len(keys), bool))
    assert pair.repeated(keys).mean() < 0.01
    pair.add(keys[:100], np.zeros(100, bool))
    assert pair.repeated(keys[:100]).all()
