"""Importance resampling of documents toward a target distribution.

Word runs are hashed into buckets; a bucket's gain is the log of how much likelier the target's runs
fall into it than the corpus's, kept in one array. A document's weight is the sum of its runs' gains.
Adding a keyed Gumbel number and taking the highest scores samples without replacement in proportion
to the exponentials of the weights.

The k-th key of the order (score, id, row) is found by distributed quickselect: pivots are random
keys of the rows still in question, one scan counts rows before, at and behind each pivot exactly, and
only rows between the two pivots around the k-th place go on. Only the winners are sorted.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, free_name, materialize, numbered

BUCKETS, RUN, MIN_WORDS, SHARE, SEED = 10_000, 3, 20, (5, 100), 42
PIVOTS = 15
SLICE_CHARS, KNOWN_WORDS = 4 << 20, 500_000
#: A-Z lowered; what is neither letter, digit nor part of a longer character splits words.
TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def _steps() -> tuple[np.ndarray, np.ndarray]:
    """What appending zero bytes does to a CRC-32, which is linear in its bits: by number of bytes
    below 64 and by powers of two of bytes, per byte of the CRC."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, one >> 1 ^ np.uint32(0xEDB88320), one >> 1)
    few = [np.arange(256, dtype=np.uint32)[None, :] << np.arange(0, 32, 8, dtype=np.uint32)[:, None]]
    for _ in range(64):
        few.append(few[-1] >> 8 ^ one[few[-1] & 255])
    powers = [few[1]]
    for _ in range(40):
        powers.append(_shift(powers[-1], powers[-1]))
    return np.array(few[:64]), np.array(powers)


def _shift(crc: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]


class Words(dict):
    """Numbers of words, in order of first sight, with the CRC-32 of the word, of a space and the
    word, and the length of the latter."""

    def __init__(self):
        self.facts: list[tuple[int, int, int]] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.facts.append((zlib.crc32(word), zlib.crc32(b" " + word), len(word) + 1))
        return n


class Features:
    """Buckets of all runs of 1 to ``run`` words of texts."""

    def __init__(self, buckets: int, run: int):
        self.buckets, self.run, self.words = buckets, run, Words()
        self.few, self.powers = _steps()

    def _after(self, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        small = size & 63
        crc = (self.few[small, 0, crc & 255] ^ self.few[small, 1, crc >> 8 & 255]
               ^ self.few[small, 2, crc >> 16 & 255] ^ self.few[small, 3, crc >> 24])
        for j in range(6, int(size.max(initial=0)).bit_length()):
            at = np.flatnonzero(size >> j & 1)
            crc[at] = _shift(crc[at], self.powers[j])
        return crc

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Words per text and, per length of run, (text, bucket) of each run. The CRC-32 of a run is
        made from those of its words."""
        if len(self.words) > KNOWN_WORDS:
            self.words = Words()
        words = [(t or "").encode("utf-8", "surrogatepass").translate(TO_WORDS).split() for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        at = np.fromiter(map(self.words.__getitem__, (w for ws in words for w in ws)), np.int64, int(sizes.sum()))
        facts = np.array(self.words.facts, np.int64).reshape(-1, 3)[at]
        text = np.repeat(np.arange(len(texts)), sizes)
        crc, spaced, size = facts[:, 0].astype(np.uint32), facts[:, 1].astype(np.uint32), facts[:, 2]
        runs = [(text, crc % self.buckets)]
        for n in range(1, self.run):
            # runs of n words that the next word of the same text makes longer
            crc = self._after(crc[:-1], size[n:]) ^ spaced[n:]
            whole = text[:len(text) - n] == text[n:]
            runs.append((text[:len(text) - n][whole], crc[whole] % self.buckets))
        return sizes, runs


def _count(buckets: int, run: int):
    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(buckets, run), np.zeros(buckets, np.int64)
        for (texts,) in batches(it, ["text"], SLICE_CHARS):
            for _, found in features.of(texts)[1]:
                total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    return task


def bucket_counts(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS, run: int = RUN) -> np.ndarray:
    """Word runs of all texts by bucket, added up in the tasks first; the driver gets one number a bucket."""
    out = np.zeros(buckets, np.int64)
    found = df.select(F.col(text_col).alias("text")).mapInArrow(_count(buckets, run), "bucket int, n long")
    for bucket, n in found.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the ratio of smoothed shares) by bucket."""
    size, of, to = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (of + size) / ((s + 1.0) * (to + size)))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def _weigh(gain: np.ndarray, run: int, text_col: str):
    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(len(gain), run)
        for batch in it:
            rest = [n for n in batch.schema.names if n != text_col]
            at = 0
            for (texts,) in batches(iter([batch.select([text_col])]), [text_col], SLICE_CHARS):
                words, runs = features.of(texts)
                weight, found = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
                for text, bucket in runs:
                    found += np.bincount(text, minlength=len(texts))
                    weight += np.bincount(text, gain[bucket], len(texts)).astype(np.int64)
                part = batch.slice(at, len(texts)).select(rest)
                at += len(texts)
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(x, pa.int64()) for x in (words, found, weight))],
                                                 names=[*rest, "__words", "__features", "__weight"])

    return task


def weigh(df: DataFrame, gain: np.ndarray, text_col: str = "text", keep: list[str] | None = None, run: int = RUN) -> DataFrame:
    """The columns ``keep`` (default: all) with ``__words``, ``__features`` and ``__weight``; null texts have none."""
    text = free_name(df, "__text")
    kept = df.select(*[F.col(f"`{c}`") for c in (df.columns if keep is None else keep)], F.col(text_col).alias(text))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != text)
    return kept.mapInArrow(_weigh(gain, run, text), f"{schema + ', ' if schema else ''}__words long, __features long, __weight long")


def gumbel(key: Column, seed: int = SEED) -> Column:
    """floor(-1000 * ln(-ln(u))) of the id's keyed number u between 0 and 1; a null id is an empty one."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000.0 * F.log(-F.log(u)))


def _key(values: list | None = None, types: list | None = None) -> Column:
    names = ["__down", "__no_id", "__id", "__tie"]
    if values is None:
        return F.struct(*names)
    return F.struct(*[F.lit(v).cast(t).alias(n) for n, v, t in zip(names, values, types)])


def kth_key(rows: DataFrame, k: int, pivots: int = PIVOTS) -> list | None:
    """The ``k``-th smallest (from 1) of the keys (``__down``, ``__no_id``, ``__id``, ``__tie``), which differ
    in ``__tie`` at least; None if there are fewer rows or ``k`` is 0."""
    left, n, turn = rows.select("__down", "__no_id", "__id", "__tie"), rows.count(), 0
    if not 0 < k <= n:
        return None
    types = [f.dataType for f in left.schema]
    while True:
        turn += 1
        some = left.orderBy(F.xxhash64("__tie", F.lit(turn)), "__tie").limit(pivots)
        some = [list(r) for r in some.orderBy(_key()).collect()]
        at = [_key(p, types) for p in some]
        counts = left.agg(*[F.count_if(_key() < p) for p in at], *[F.count_if(_key() == p) for p in at]).first()
        before, same = counts[:len(at)], counts[len(at):]
        upto = [b + s for b, s in zip(before, same)]
        i = bisect_left(upto, k)
        if i < len(at) and before[i] < k:
            return some[i]
        inside = F.lit(True)
        if i:
            inside = inside & (_key() > at[i - 1])
        if i < len(at):
            inside = inside & (_key() < at[i])
        left = materialize(left.filter(inside))
        k -= upto[i - 1] if i else 0


def draw(weighed: DataFrame, id_col: str = "doc_id", share: tuple[int, int] = SHARE, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """All rows of ``weighed`` with ``__score`` and ``__rank`` (from 1; null: not drawn). Of rows with
    ``min_words`` words at least, ``share`` of them with the highest scores are drawn, ties to the smaller
    id, null ids last; of rows alike in both, any."""
    key = F.col(f"`{id_col}`")
    scored = weighed.withColumn("__score", F.col("__weight") + gumbel(key, seed)).withColumn("__tie", F.monotonically_increasing_id())
    scored = materialize(scored.withColumns({"__down": -F.col("__score"), "__no_id": key.isNull(), "__id": key}))
    fit = F.col("__words") >= min_words
    kth = kth_key(scored.filter(fit), scored.filter(fit).count() * share[0] // share[1])
    inner = ["__tie", "__down", "__no_id", "__id"]
    if kth is None:
        return scored.withColumn("__rank", F.lit(None).cast("long")).drop(*inner)
    wins = fit & (_key() <= _key(kth, [scored.schema[c].dataType for c in ("__down", "__no_id", "__id", "__tie")]))
    winners = numbered(scored.filter(wins), [F.col(c) for c in ("__down", "__no_id", "__id", "__tie")]).withColumn("__rank", F.col("__n") + 1)
    rest = scored.filter(~wins).withColumn("__rank", F.lit(None).cast("long"))
    return winners.drop("__n").unionByName(rest).drop(*inner)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
             target_text: str = "text", buckets: int = BUCKETS, run: int = RUN, **how) -> DataFrame:
    """``docs`` weighed by what the texts of ``target`` favour and drawn (see ``draw``). Empty tables on either
    side are tables without runs; rows without an id are rows like others."""
    gain = gains(bucket_counts(docs, text_col, buckets, run), bucket_counts(target, target_text, buckets, run))
    return draw(weigh(docs, gain, text_col, keep, run), id_col, **how)


def op12_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    out = resample(docs, target, keep=["doc_id"])
    return out.select("doc_id", *[F.col(f"__{c}").alias(n) for c, n in (("features", "n_features"), ("weight", "weight"), ("score", "score"), ("rank", "rank"))])


#: Run hashes by CRC-32 over UTF-8 bytes, one hash a distinct run.
OP12_SQL = r"""
WITH RECURSIVE bits AS (SELECT i, 0 AS step, i AS crc FROM range(256) t(i)
  UNION ALL SELECT i, step + 1, CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END FROM bits WHERE step < 8),
crc_of AS (SELECT list(crc ORDER BY i) AS tab FROM bits WHERE step = 8),
items AS (
  SELECT row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, text FROM benchmark),
split AS (
  SELECT r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM items),
found AS (
  SELECT r, f, count(*) AS n FROM (SELECT r, unnest(list_concat(w,
      list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
      list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM split) GROUP BY ALL),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(f, ''), lambda c:
        CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
          WHEN unicode(c) < 2048 THEN [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)]::BIGINT[]
          WHEN unicode(c) < 65536 THEN [224 + (unicode(c) >> 12), 128 + ((unicode(c) >> 6) & 63), 128 + (unicode(c) & 63)]::BIGINT[]
          ELSE [240 + (unicode(c) >> 18), 128 + ((unicode(c) >> 12) & 63), 128 + ((unicode(c) >> 6) & 63), 128 + (unicode(c) & 63)]::BIGINT[] END))),
      lambda crc, b: xor(crc >> 8, tab[1 + (xor(crc, b) & 255)])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM found), crc_of),
per AS (SELECT r, bucket, sum(n) AS n FROM found JOIN hashed USING (f) GROUP BY ALL),
shares AS (
  SELECT bucket, coalesce(sum(n) FILTER (r > 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (r < 0), 0)::DOUBLE AS t FROM per GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM shares) + 10000) / ((s + 1) * ((SELECT sum(t) FROM shares) + 10000))))::BIGINT AS g FROM shares),
weighed AS (
  SELECT d.r, any_value(d.doc_id) AS doc_id, any_value(len(d.w)) AS n_words, coalesce(sum(p.n), 0)::BIGINT AS n_features, coalesce(sum(p.n * g.g), 0)::BIGINT AS weight
  FROM split d LEFT JOIN per p ON p.r = d.r LEFT JOIN gain g ON g.bucket = p.bucket WHERE d.r > 0 GROUP BY d.r),
scored AS (
  SELECT *, (weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM weighed),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, r) AS place, 5 * count(*) FILTER (n_words >= 20) OVER () // 100 AS k
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= k THEN place END AS rank FROM ordered
"""
