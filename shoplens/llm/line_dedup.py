"""Removal of lines that many documents share.

Method: a line is known by a 128-bit digest of its key, and a slice of the digest picks a
segment. Every segment keeps two Bloom filters, for digests seen once and for digests seen again.
What a segment reads are packed arrays of (digest, document), one row per slice of documents. A
digest that several documents of one slice hold is a repeat already: its holders are passed on as
suspects, spread over all tasks, and the segment gets it once, marked as seen again. So the most
common line costs a segment one entry a slice. Only suspects become rows: their holders are
counted exactly, and the largest id is chosen to keep the line.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, free_name, materialize, shuffle_width

STRIPPED = " \t\n\x0b\x0c\r"
MIN_CHARS = 40
MIN_DOCS = 5
#: Bloom filter sizing: bits and hash functions per entry.
BITS_PER_ENTRY, HASHES = 16, 4
SLICE_CHARS = 16 << 20
_DIGEST = pa.binary(16)
_PAIR = np.dtype([("a", "<u8"), ("b", "<u8")])
#: Stands for a null id inside packed arrays; smaller than any id.
NO_ID = np.iinfo(np.int64).min


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """Digest of the stripped line with A-Z lowered; None if it has too few code points."""
    line = line.strip(STRIPPED)
    if len(line) < min_chars:
        return None
    return hashlib.blake2b(line.encode("utf-8", "surrogatepass").lower(), digest_size=16).digest()


def _packed(segments: int, min_chars: int):
    """Documents to rows (segment, digests, docs, again). A segment below 0 holds suspects."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in batches(it, ["doc_id", "text"], SLICE_CHARS):
            digests, docs = [], []
            for doc, text in zip(ids, texts):
                if text:
                    keys = {line_key(x, min_chars) for x in text.split("\n") if len(x) >= min_chars}
                    keys.discard(None)
                    digests += keys
                    docs += [NO_ID if doc is None else doc] * len(keys)
            if not digests:
                continue
            keys, docs = np.frombuffer(b"".join(digests), _PAIR), np.array(docs, "<i8")
            order = np.argsort(keys, kind="stable", order=("a", "b"))
            keys, docs = keys[order], docs[order]
            new = np.append(True, keys[1:] != keys[:-1])
            held = np.diff(np.append(np.flatnonzero(new), len(keys)))
            again, first = held > 1, np.flatnonzero(new)
            many = np.repeat(again, held)
            seg = ((keys["b"][first] >> np.uint64(32)) % np.uint64(segments)).astype(np.int32)
            yield _rows(seg, keys[first], docs[first], again)
            if many.any():
                # any task may pass these on; slices differ in where they start
                spread = (np.arange(many.sum()) // 4096 + int(keys["a"][0] % np.uint64(segments))) % segments
                yield _rows((-1 - spread).astype(np.int32), keys[many], docs[many], np.ones(many.sum(), bool))

    return run


def _rows(seg: np.ndarray, keys: np.ndarray, docs: np.ndarray, again: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(seg, kind="stable")
    seg, keys, docs, again = seg[order], keys[order], docs[order], again[order]
    ids, starts = np.unique(seg, return_index=True)
    cut = list(zip(starts, [*starts[1:], len(seg)]))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids), *(pa.array([x[a:b].tobytes() for a, b in cut], pa.binary()) for x in (keys, docs, again))],
        schema=pa.schema([("segment", pa.int32()), ("digests", pa.binary()), ("docs", pa.binary()), ("again", pa.binary())]))


class BloomPair:
    """Once-seen and twice-seen filters over the digests of one segment."""

    def __init__(self, entries: int):
        self.size = 1 << max(10, int(entries * BITS_PER_ENTRY - 1).bit_length())
        self.once = np.zeros(self.size >> 3, np.uint8)
        self.twice = np.zeros(self.size >> 3, np.uint8)

    def _bits(self, keys: np.ndarray):
        for k in range(HASHES):
            bit = (keys["a"] + np.uint64(k) * (keys["b"] | np.uint64(1))) & np.uint64(self.size - 1)
            yield (bit >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8))

    def _has(self, filt: np.ndarray, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for byte, bit in self._bits(keys):
            found &= (filt[byte] & bit) != 0
        return found

    def _put(self, filt: np.ndarray, keys: np.ndarray) -> None:
        for byte, bit in self._bits(keys):
            np.bitwise_or.at(filt, byte, bit)

    def add(self, keys: np.ndarray, again: np.ndarray) -> None:
        """``keys`` are distinct; ``again`` marks those seen more than once already."""
        self._put(self.twice, keys[again | self._has(self.once, keys)])
        self._put(self.once, keys)

    def repeated(self, keys: np.ndarray) -> np.ndarray:
        return self._has(self.twice, keys)


def _suspects(table: pa.Table) -> pa.Table:
    """The packed rows of one segment to (digest, doc_id) of the entries its second filter holds."""
    rows = [(np.frombuffer(k, _PAIR), np.frombuffer(d, "<i8"), np.frombuffer(m, bool)) for k, d, m in
            zip(*(table.column(c).to_pylist() for c in ("digests", "docs", "again")))]
    if rows and table.column("segment")[0].as_py() >= 0:
        pair = BloomPair(sum(len(k) for k, _, _ in rows))
        for k, _, again in rows:
            pair.add(k, again)
        # holders of marked entries are on their way already
        rows = [(k[hit], d[hit], m[hit]) for k, d, m in rows for hit in [pair.repeated(k) & ~m]]
    keys = np.concatenate([k for k, _, _ in rows]).tobytes()
    docs = np.concatenate([d for _, d, _ in rows])
    digests = pa.Array.from_buffers(_DIGEST, len(docs), [None, pa.py_buffer(keys)]).cast(pa.binary())
    return pa.table({"digest": digests, "doc_id": pa.array(docs, mask=docs == NO_ID)})


def shared_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                 segments: int | None = None) -> tuple[DataFrame, DataFrame]:
    """For docs (doc_id, text): the suspects (digest, doc_id), and of the digests that at least
    ``min_docs`` documents hold (digest, keeper), keeper being the largest id."""
    spark = docs.sparkSession
    segments = segments or max(64, shuffle_width(spark))
    packed = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _packed(segments, min_chars), "segment int, digests binary, docs binary, again binary")
    suspects = materialize(packed.groupBy("segment").applyInArrow(_suspects, "digest binary, doc_id long"))
    holders = suspects.groupBy("digest", "doc_id").agg(F.lit(1).alias("one"))
    shared = holders.groupBy("digest").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper")).filter(F.col("n") >= min_docs)
    # written out, so that a join with it stands alone in its stage and Spark can split a hot digest
    return suspects, materialize(shared.select("digest", "keeper"))


def _rewrite(text_col: str, drop_col: str, min_chars: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            n_lines, n_dropped, kept = [], [], []
            at = {c: batch.schema.get_field_index(c) for c in (text_col, drop_col)}
            for text, drop in zip(batch.column(at[text_col]).to_pylist(), batch.column(at[drop_col]).to_pylist()):
                lines = (text or "").split("\n")
                stay = lines
                if drop:
                    drop = set(drop)
                    stay = [x for x in lines if line_key(x, min_chars) not in drop]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
                kept.append(text if len(stay) == len(lines) else "\n".join(stay))
            columns = [pa.array(kept, pa.string()) if i == at[text_col] else batch.column(i)
                       for i in range(batch.num_columns) if i != at[drop_col]]
            names = [n for n in batch.schema.names if n != drop_col]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                names=[*names, "__n_lines", "__n_dropped"])

    return run


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, the text without the dropped lines, and __n_lines, __n_dropped (in
    place of columns with these names).

    A line's key is the line without blanks at its ends, A-Z lowered. Keys of ``min_chars`` code
    points or more held by ``min_docs`` documents or more lose all their lines except in the
    largest id that holds them, where every occurrence stays. Null and empty texts are one empty
    line and come back as they are. Rows with the same id count as one document, and so do all
    rows without an id, which rank lowest. No rows in, no rows out.
    """
    docs = docs.drop("__n_lines", "__n_dropped")
    pairs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    suspects, shared = shared_lines(pairs, min_docs, min_chars)
    of, drop = free_name(docs, "__doc"), free_name(docs, "__drop")
    drops = (
        suspects.join(shared, "digest").filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc_id").alias(of)).agg(F.collect_set("digest").alias(drop))
    )
    joined = docs.join(drops, docs[id_col].cast("long").eqNullSafe(drops[of]), "left").drop(of)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return joined.mapInArrow(_rewrite(text_col, drop, min_chars), f"{schema}, __n_lines long, __n_dropped long")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH lines AS (
  SELECT doc_id, rid, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, rid, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
        FROM (SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
shared AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT l.doc_id, l.rid, l.pos, l.line, s.k IS NOT NULL AND l.doc_id <> s.keeper AS gone
  FROM lines l LEFT JOIN shared s ON l.k = s.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid, doc_id
"""
