"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words. A document's expected number of copies is
``min(cap, rate * weight)``, with the source's ``rate`` solved so that the expected words meet
the target. The whole part of that number is given for certain; for the fraction p each document
draws a uniform u from its id and is ranked by ``(u/(1-u)) / (p/(1-p))``, random odds over
inclusion odds. The documents of lowest rank are taken until the words still wanted are used up,
so the sample's size is fixed and inclusion follows p.

All work is on light rows (id, source, size). Cumulative words are found by bands of rank: band
sums per source give the band in which a source's target falls, and only that band, about one in
``BANDS`` of the source's rows, is ordered row by row. A source with most of the rows thus adds
up in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import NOT_BLANKS, drop_table, materialize

#: Bands of rank per source.
BANDS = 4096
#: Documents much shorter than this many words are chosen less often than long ones.
HALF_WEIGHT_WORDS = 8


def word_count(text: Column) -> Column:
    """Words between blanks; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(NOT_BLANKS + "+")), F.lit(0)).cast("long")


def uniform(key: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 that depends on key and seed only (52 bits of MD5)."""
    digest = F.md5(F.concat(F.lit(seed + ":"), key).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: list[int], budget_percent: int, cap: int) -> DataFrame:
    """(source, source_size) to those and ``target``.

    Sources by code point (null last) weigh ``weights``, repeating, and share ``budget_percent``
    of all sizes. A target stops at ``cap`` times its source's size; the excess goes to the others
    by weight until none is above. The sources of one corpus are one row each here; the loop
    passes two sums a round through the driver, never a row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    t = materialize(sizes.withColumn("pos", F.row_number().over(order) - 1)
                    .withColumn("weight", cycle[F.col("pos") % len(weights)]))
    total = t.agg(F.sum("source_size")).first()[0] or 0
    budget = float(total) * budget_percent / 100.0
    most = F.col("source_size") * float(cap)
    level = 0.0
    while True:
        # sources above their cap at this level stay there: the level only rises
        full = F.col("weight") * F.lit(level) >= most
        row = t.agg(F.sum(F.when(full, most).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not row[1]:
            break
        new = (budget - row[0]) / row[1]
        if new <= level:
            break
        level = new
    target = F.when(F.col("weight") * F.lit(level) >= most, most).otherwise(F.col("weight") * F.lit(level))
    return t.select("source", "source_size", target.alias("target"))


def expected_copies(rows: DataFrame, targets: DataFrame, cap: int, max_rounds: int = 30) -> DataFrame:
    """rows (.., source, size, weight) with ``copies``: min(cap, rate * weight), where the
    source's rate makes the sum of copies * size its target. A round is one aggregation to a row
    per source."""
    solved = materialize(targets.withColumn("rate", F.lit(0.0)))
    for _ in range(max_rounds):
        joined = _with_source(rows.select("source", "size", "weight"), solved.select("source", "rate"))
        full = F.col("weight") * F.col("rate") >= cap
        sums = joined.groupBy("source").agg(
            F.sum(F.when(full, F.col("size") * float(cap)).otherwise(0.0)).alias("held"),
            F.sum(F.when(full, 0.0).otherwise(F.col("size") * F.col("weight"))).alias("open"))
        left = F.col("target") - F.col("held")
        rate = F.when((F.col("open") > 0) & (left > 0), F.greatest(F.col("rate"), left / F.col("open"))).otherwise(F.col("rate"))
        new = materialize(_with_source(solved, sums).select("source", "source_size", "target", "rate", rate.alias("next")))
        moved = new.filter("next > rate * 1.000000001").limit(1).count()
        drop_table(solved)
        solved = new.select("source", "source_size", "target", F.col("next").alias("rate"))
        if not moved:
            break
    return _with_source(rows, solved).withColumn("copies", F.least(F.lit(float(cap)), F.col("weight") * F.col("rate"))).drop("rate")


def _with_source(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Inner join on source, null matching null."""
    facts = facts.withColumnRenamed("source", "__source")
    return rows.join(facts, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")


def pareto_mix(docs: DataFrame, weights: list[int] = (5, 2, 1), budget_percent: int = 150, cap: int = 2,
               seed: str = "mix", id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, text_key (MD5 of the text), source, size, source_size, target,
    n_copies, taken.

    ``size`` is the text's words (null: 0), ``n_copies`` how often the mix holds the document, at
    most ``cap``, ``taken`` the words of these copies. The outcome depends on the rows and
    ``seed`` only. Documents of size 0 are never taken. Repeated rows (same id and text) tie in
    rank and are then ordered by row number; a null id draws by its text alone. No rows in, no
    rows out. Other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.md5(text.cast("binary")).alias("text_key"),
        F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"),
        F.monotonically_increasing_id().alias("row_key")))
    rows = rows.withColumn("u", uniform(F.concat_ws(":", F.col("doc_id").cast("string"), "text_key"), seed))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, list(weights), budget_percent, cap)
    rows = rows.withColumn("weight", F.col("size") / (F.col("size") + F.lit(float(HALF_WEIGHT_WORDS))))
    rows = expected_copies(rows, targets, cap)
    certain = F.floor(F.col("copies")).cast("long")
    p = F.col("copies") - F.floor(F.col("copies"))
    odds = (F.col("u") / (1.0 - F.col("u"))) / (p / (1.0 - p))
    ranked = materialize(
        rows.withColumn("certain", F.when(F.col("size") > 0, certain).otherwise(F.lit(0).cast("long")))
        .withColumn("rank", F.when((F.col("size") > 0) & (p > 0), odds))
        .withColumn("band", F.floor(F.col("rank") / (1.0 + F.col("rank")) * BANDS).cast("long"))
        .drop("u", "weight", "copies"))

    # words still wanted after the certain copies; bands wholly below that are taken
    wanted = ranked.groupBy("source").agg(
        (F.first("target") - F.sum(F.col("certain") * F.col("size"))).alias("wanted"))
    bands = ranked.filter("band is not null").groupBy("source", "band").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("band").rowsBetween(Window.unboundedPreceding, 0)
    bands = _with_source(bands.withColumn("upto", F.sum("words").over(upto)), wanted)
    cut = materialize(bands.filter("upto > wanted").groupBy("source").agg(
        F.min("band").alias("cut_band"), F.min_by(F.col("upto") - F.col("words"), "band").alias("before"),
        F.first("wanted").alias("wanted")))
    facts = cut.withColumnRenamed("source", "__source")
    joined = ranked.join(facts, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")

    # in the cut band rows are taken in order of rank; the last one if that ends nearer the target
    edge = joined.filter("band = cut_band")
    before = Window.partitionBy("source").orderBy("rank", "doc_id", "row_key").rowsBetween(Window.unboundedPreceding, -1)
    have = F.col("before") + F.coalesce(F.sum("size").over(before), F.lit(0))
    edge = edge.withColumn("drawn", (have + F.col("size") / 2.0 <= F.col("wanted")).cast("long"))
    rest = joined.filter("band is null or cut_band is null or band <> cut_band").withColumn(
        "drawn", (F.col("band").isNotNull() & (F.col("cut_band").isNull() | (F.col("band") < F.col("cut_band")))).cast("long"))
    out = rest.unionByName(edge).withColumn("n_copies", F.col("certain") + F.col("drawn"))
    return out.select("doc_id", "text_key", "source", "size", "source_size", "target", "n_copies",
                      (F.col("n_copies") * F.col("size")).alias("taken"))


def op9_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = pareto_mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")
