"""Benchmark decontamination by winnowing, in DataFrame operations only.

Fingerprints: of every ``GRAM`` consecutive words a 64-bit hash, and of every window of
``span - GRAM + 1`` such hashes the smallest. Two texts that share ``span`` words in a row share a
window of hashes and so its smallest one: joining documents' and items' fingerprints misses no
shared span. Where a fingerprint matches, the spans of the document around it are taken as text
and joined with the items' spans, which confirms or refutes each match exactly; confirmed spans
that overlap or touch run together. Items of fewer words than a span are one span of their own length,
found by hashing all of the document's word runs of that length.

Documents are handled by the digest of their text from the first join on: copies of a text are
worked out once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, materialize

#: A word is a run of the characters that this leaves: ASCII letters and digits, and all above U+007F.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPAN = 13
GRAM = 7


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NO_WORD), "")


def _shifted(a: str, by: int) -> Column:
    return F.slice(a, by + 1, F.size(a))


def _runs(df: DataFrame, col: str, length: int, join) -> DataFrame:
    """``col`` (an array) to what ``join`` makes of each ``length`` neighbours, by doubling. The
    last length - 1 elements are not whole and are left to the caller. Each step is a projection
    of its own, so no step is computed twice."""
    have = 1
    while have < length:
        by = min(have, length - have)
        df = df.withColumn(col, F.zip_with(col, _shifted(col, by), join))
        have += by
    return df


def _cut(df: DataFrame, col: str, count: Column) -> DataFrame:
    return df.withColumn(col, F.slice(col, 1, F.greatest(count, F.lit(0))))


def fingerprints(df: DataFrame, hashes: str, span: int, gram: int) -> DataFrame:
    """Replace the word hashes in column ``hashes`` by the fingerprints for shared spans."""
    df = _cut(df.withColumn("__n", F.size(hashes)), hashes, F.col("__n"))
    df = _runs(df, hashes, gram, lambda x, y: F.xxhash64(x, y))
    df = _cut(df, hashes, F.col("__n") - (gram - 1))
    df = _runs(df, hashes, span - gram + 1, lambda x, y: F.least(x, y))
    df = _cut(df, hashes, F.col("__n") - (span - 1))
    return df.withColumn(hashes, F.array_distinct(hashes)).drop("__n")


def _exploded(a: Column) -> Column:
    """One row per element. A plain explode adds a filter on the array's size, which the optimizer
    would push down through every step that built the array, repeating the steps; this does not.
    An empty array gives one row with null, for the caller to drop."""
    return F.explode_outer(a)


def _hashed(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def _span_text(w: Column, at: Column, span: int) -> Column:
    return F.concat_ws(" ", *[F.get(w, at + j) for j in range(span)])


def item_spans(items: DataFrame, id_col: str, text_col: str, span: int = SPAN) -> DataFrame:
    """(span_words, span_text, items): each distinct span of the items with the ids, as strings,
    of those that have it. Items without words have none; a null id adds no id."""
    w = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).filter("size(w) > 0")
    whole = w.filter(F.size("w") < span).select("item", F.size("w").alias("span_words"), F.array_join("w", " ").alias("span_text"))
    starts = F.sequence(F.lit(0), F.size("w") - span)
    long = w.filter(F.size("w") >= span).select(
        "item", F.lit(span).alias("span_words"),
        _exploded(F.transform(starts, lambda i: _span_text(F.col("w"), i, span))).alias("span_text"))
    return materialize(whole.unionByName(long).groupBy("span_words", "span_text").agg(F.collect_set("item").alias("items")))


def _near(df: DataFrame, span: int, gram: int) -> DataFrame:
    """(text_key, w, h, fps) to (text_key, start, span_words, span_text): the document's spans that
    contain a word run whose hash is among the matched fingerprints."""
    df = _runs(df.withColumn("n", F.size("w")), "h", gram, lambda x, y: F.xxhash64(x, y))
    df = df.withColumn("h", F.transform("h", lambda x: F.array_contains("fps", x)))
    df = _cut(df, "h", F.col("n") - (gram - 1))
    df = _runs(df, "h", span - gram + 1, lambda x, y: x | F.coalesce(y, F.lit(False)))
    df = _cut(df, "h", F.col("n") - (span - 1))
    df = df.withColumn("h", F.transform("h", lambda hit, i: F.when(hit, i)))
    df = df.withColumn("h", F.filter("h", lambda i: i.isNotNull()))
    df = df.withColumn("h", F.transform("h", lambda i: F.struct(i.alias("start"), _span_text(F.col("w"), i, span).alias("span_text"))))
    return df.select("text_key", _exploded(F.col("h")).alias("s")).filter("s is not null").select(
        "text_key", "s.start", F.lit(span).alias("span_words"), "s.span_text")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", span: int = SPAN) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (ids as strings, sorted), spans (start and
    end in words, end exclusive, overlapping and touching spans as one).

    A word is hit if a span of ``span`` words in a row that some item has, or a whole item of fewer
    words, lies over it. Null and empty texts have no words and no hits; repeated rows each get
    their row; an empty table on either side gives no hits. Other columns are not looked at.
    """
    spans = item_spans(items, item_id_col, item_text_col, span)
    # at most ``span`` lengths exist, whatever the size of the benchmark
    lengths = [r[0] for r in spans.select("span_words").distinct().collect()]

    # items shorter than a span are looked up whole
    gram = {n: min(GRAM, span) if n == span else n for n in lengths}
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    base = base.withColumn("text_key", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    split = base.select("doc_id", "text_key", words(F.col("text")).alias("w"))
    hashed = split.select("doc_id", "text_key", F.size("w").cast("long").alias("n_words"), _hashed(F.col("w")).alias("h"))
    for n in lengths:
        hashed = fingerprints(hashed.withColumn(f"fp{n}", F.col("h")), f"fp{n}", n, gram[n])
    rows = materialize(hashed.drop("h"))

    found = None
    for n in lengths:
        own = spans.filter(F.col("span_words") == n).select(_hashed(F.split("span_text", " ")).alias("fp"))
        own = fingerprints(own, "fp", n, gram[n]).select(_exploded(F.col("fp")).alias("fp"))
        own = materialize(own.filter("fp is not null").distinct())
        hits = rows.select("doc_id", "text_key", F.explode(f"fp{n}").alias("fp")).join(own, "fp", "left_semi")
        hits = hits.groupBy("text_key").agg(F.collect_set("fp").alias("fps"), F.min("doc_id").alias("rep"))
        hits = hits.withColumn("span_words", F.lit(n))
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        none = "array<struct<start:int,end:int>>"
        return rows.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"),
                           F.array().cast("array<string>").alias("items"), F.array().cast(none).alias("spans"))

    # one copy of each text with a match, cut into words again
    matched = materialize(found).withColumnRenamed("text_key", "key")
    # (matched texts may be many, so the texts are shuffled at any size)
    again = base.hint("merge").join(matched.hint("merge"), (F.col("text_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("rep")))
    again = again.select("text_key", "span_words", "fps", words(F.col("text")).alias("w")).withColumn("h", _hashed(F.col("w")))
    near = None
    for n in lengths:
        part = _near(again.filter(F.col("span_words") == n).drop("span_words"), n, gram[n])
        near = part if near is None else near.unionByName(part)
    confirmed = near.distinct().join(spans, ["span_words", "span_text"])

    upto = Window.partitionBy("text_key").orderBy("start", F.col("end").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ends = confirmed.withColumn("end", F.col("start") + F.col("span_words"))
    ends = ends.withColumn("before", F.coalesce(F.max("end").over(upto), F.lit(-1)))
    ends = ends.withColumn("fresh", F.greatest(F.lit(0), F.col("end") - F.greatest("start", "before")))
    whole = Window.partitionBy("text_key").orderBy("start", F.col("end").desc())
    ends = ends.withColumn("run", F.sum((F.col("start") > F.col("before")).cast("int")).over(whole))
    runs = ends.groupBy("text_key", "run").agg(
        F.struct(F.min("start").alias("start"), F.max("end").alias("end")).alias("span"),
        F.sum("fresh").alias("n"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    # written out, so that the join stands alone in its stage and Spark can split a text with many copies
    result = materialize(runs.groupBy(F.col("text_key").alias("key")).agg(
        F.sum("n").alias("n_hit"), F.array_sort(F.collect_list("span")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
    out = rows.select("doc_id", "text_key", "n_words").join(result, F.col("text_key") == F.col("key"), "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"))


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least one word in twenty is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


OP3_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
m AS (SELECT dw.rid, dw.n, dw.i, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.t = bw.t),
h AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS p FROM m) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM m) GROUP BY rid)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN h ON d.rid = h.rid LEFT JOIN it ON d.rid = it.rid
"""
