"""Flexible search over the sales wide table.

``dt`` is an exact filter; the keyword is a match with all tokens required
against the tokenised ``sku_name``. Results rank by BM25 (term and document
frequencies from the whole table), then by id. Corpus statistics are scalar
subqueries, evaluated once and inlined as literals, so no cross join is
planned. The query string is a parameter, so its handful of tokens becomes
literal expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.constants import (AGE_BANDS, AGE_TITLE, GENDER_MALE_LABEL, GENDER_OTHER_LABEL,
                                GENDER_TITLE)
from shoplens.functions.text import query_tokens, term_count, tokens
from shoplens.operators.joins import bounded_broadcast

BM25_K1 = 1.2
BM25_B = 0.75
TIE_BREAK = ["order_id", "order_detail_id"]


def match_all(df: DataFrame, keyword: str | None, field: str = "sku_name",
              empty_keyword: str = "none") -> DataFrame:
    """Rows whose ``field`` contains every token of ``keyword``.

    An empty keyword matches nothing (``empty_keyword='none'``) or everything
    (``'all'``); ``forall`` over an empty array would be true, hence the guard.
    """
    q = query_tokens(keyword)
    if not q:
        if empty_keyword == "all":
            return df
        return df.where(F.lit(False))
    toks = tokens(field)
    cond = None
    for t in q:
        c = F.array_contains(toks, F.lit(t))
        cond = c if cond is None else cond & c
    return df.where(cond)


def search(df: DataFrame, date: str | None, keyword: str | None, field: str = "sku_name",
           empty_keyword: str = "none") -> DataFrame:
    filtered = df if date is None else df.where(F.col("dt") == F.lit(date))
    return match_all(filtered, keyword, field, empty_keyword)


def bm25_score(matches: DataFrame, corpus: DataFrame, keyword: str | None,
               field: str = "sku_name") -> DataFrame:
    """Add ``score``: BM25 of ``keyword`` against each row's ``field``.

    N, the mean length and every query token's document frequency come from
    ``corpus`` in one aggregate, used as a single struct-valued scalar
    subquery (one extra pass over the corpus, evaluated once).
    """
    q = query_tokens(keyword)
    if not q:
        return matches.withColumn("score", F.lit(0.0))
    ctoks = corpus.select(tokens(field).alias("_t"))
    stats = ctoks.agg(F.struct(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.avg(F.size("_t")).cast("double").alias("avgdl"),
        *[F.count_if(F.array_contains("_t", F.lit(t))).cast("double").alias(f"df{i}")
          for i, t in enumerate(q)]).alias("s")).scalar()
    # projected once, so the subquery is planned (and run) once
    matches = matches.withColumn("_bm25", stats)
    n_docs, avg_len = F.col("_bm25.n"), F.col("_bm25.avgdl")
    toks = tokens(field)
    dl = F.size(toks).cast("double")
    score: Column = F.lit(0.0)
    for i, t in enumerate(q):
        df_t = F.col(f"_bm25.df{i}")
        idf = F.log(F.lit(1.0) + (n_docs - df_t + F.lit(0.5)) / (df_t + F.lit(0.5)))
        tf = term_count(toks, t).cast("double")
        part = idf * tf * F.lit(BM25_K1 + 1) / (tf + F.lit(BM25_K1) * (F.lit(1 - BM25_B) + F.lit(BM25_B) * dl / avg_len))
        score = score + part
    return matches.withColumn("score", score).drop("_bm25")


def ranked(matches: DataFrame) -> list[Column]:
    return [F.col("score").desc()] + [F.col(c).asc() for c in TIE_BREAK]


def page(matches: DataFrame, page_no: int, size: int) -> DataFrame:
    """1-based page: rows (page_no-1)*size .. +size in rank order (a top-k
    with offset, planned as TakeOrderedAndProject)."""
    if page_no < 1 or size < 0:
        raise ValueError("page numbers start at 1 and size must be >= 0")
    order = ranked(matches) if "score" in matches.columns else [F.col(c).asc() for c in TIE_BREAK]
    return matches.orderBy(*order).offset((page_no - 1) * size).limit(size)


def page_after(matches: DataFrame, last: tuple | None, size: int) -> DataFrame:
    """The ``size`` rows that follow ``last`` (score and tie-break ids of the
    row before; None: the start). A deep page costs what the first one does:
    each task keeps ``size`` rows, where an offset would gather all before it."""
    rows = matches
    if last is not None:
        score, *ids = last
        after = F.col("score") < F.lit(score)
        same = F.col("score") == F.lit(score)
        for c, v in zip(TIE_BREAK, ids):
            after = after | (same & (F.col(c) > F.lit(v)))
            same = same & (F.col(c) == F.lit(v))
        rows = rows.where(after)
    return rows.orderBy(*ranked(matches)).limit(size)


def report_json(report: dict[str, DataFrame]) -> DataFrame:
    """The search answer as one JSON text: total, the two pies (title with
    options name and value) and the page's rows. All parts are bounded: one
    number, five pie slices and one page."""
    slices = F.struct("name", "value", "share")
    gender = report["gender"].groupBy("title").agg(F.array_sort(F.collect_list(slices)).alias("options"))
    age = report["age"].groupBy("title").agg(
        F.array_sort(F.collect_list(F.struct("band_order", "name", "value", "share"))).alias("o")).select(
        "title", F.transform("o", lambda x: F.struct(x["name"].alias("name"), x["value"].alias("value"),
                                                     x["share"].alias("share"))).alias("options"))
    stat = gender.unionByName(age).agg(F.array_sort(F.collect_list(F.struct("title", "options"))).alias("stat"))
    page_rows = report["detail"]
    keyed = page_rows.select(F.struct((-F.col("score")).alias("rank"), *TIE_BREAK,
                                      F.struct(*page_rows.columns).alias("row")).alias("r"))
    detail = keyed.agg(F.transform(F.array_sort(F.collect_list("r")), lambda x: x["row"]).alias("detail"))
    whole = report["total"].select(F.struct(
        "total", stat.scalar().alias("stat"), detail.scalar().alias("detail")).alias("answer"))
    return whole.select(F.to_json("answer").alias("answer"))


def total(matches: DataFrame) -> DataFrame:
    return matches.agg(F.count(F.lit(1)).alias("total"))


def terms(matches: DataFrame, field: str, size: int) -> DataFrame:
    """Terms aggregation: buckets by count desc then key, nulls excluded,
    first ``size`` buckets."""
    return (matches.where(F.col(field).isNotNull()).groupBy(field)
            .agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col(field).asc()).limit(size))


def gender_stats(matches: DataFrame) -> DataFrame:
    """Gender pie over all rows with a gender: 'M' labelled male, anything else
    female; absent labels are not zero-filled. ``share`` is the pie's
    percentage basis."""
    name = F.when(F.col("user_gender") == "M", F.lit(GENDER_MALE_LABEL)).otherwise(F.lit(GENDER_OTHER_LABEL))
    per_label = (matches.where(F.col("user_gender").isNotNull()).groupBy(name.alias("name"))
                 .agg(F.count(F.lit(1)).alias("value")))
    return _with_share(per_label.select(F.lit(GENDER_TITLE).alias("title"), "name", "value"))


def _band_table(spark) -> DataFrame:
    rows = [(i, name, lo, hi) for i, (name, lo, hi) in enumerate(AGE_BANDS)]
    return spark.createDataFrame(rows, "band_order int, name string, lo int, hi int")


def age_stats(matches: DataFrame) -> DataFrame:
    """Age pie: all rows with an age in three bands, zero-filled."""
    t = matches.where(F.col("user_age").isNotNull())
    bands = _band_table(matches.sparkSession)
    band_of = None
    for i, (_, lo, hi) in enumerate(AGE_BANDS):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col("user_age") >= lo)
        if hi is not None:
            cond = cond & (F.col("user_age") < hi)
        band_of = F.when(cond, F.lit(i)) if band_of is None else band_of.when(cond, F.lit(i))
    per_band = t.groupBy(band_of.alias("band_order")).agg(F.count(F.lit(1)).alias("value"))
    # both sides hold at most three rows (the fixed bands)
    out = bounded_broadcast(bands).join(bounded_broadcast(per_band), "band_order", "left").select(
        F.lit(AGE_TITLE).alias("title"), "band_order", "name",
        F.coalesce(F.col("value"), F.lit(0)).cast("long").alias("value"))
    return _with_share(out)


def _with_share(stat: DataFrame) -> DataFrame:
    """value / sum(value) over the (at most three-row) stat; 0 when empty."""
    from pyspark.sql import Window
    tot = F.sum("value").over(Window.partitionBy("title"))
    return stat.withColumn("share", F.when(tot > 0, F.col("value") / tot).otherwise(F.lit(0.0)))


def sale_report(table: DataFrame, date: str, keyword: str, page_no: int, size: int,
                empty_keyword: str = "none", materialize: str = "none") -> dict[str, DataFrame]:
    """The flexible-search answer: total, one page and the two pies, all
    derived from one filtered, scored DataFrame.

    ``materialize``: 'none' (each answer re-plans from the table), 'persist'
    (executor cache; lost blocks are recomputed from lineage) or 'checkpoint'
    (written once to the shared ``spark.checkpoint.dir``, lineage cut, so the
    four answers survive executor loss without recomputing the join).
    """
    from shoplens.config import checkpoint_root
    matches = search(table, date, keyword, empty_keyword=empty_keyword)
    matches = bm25_score(matches, table, keyword)
    if materialize == "persist":
        matches = matches.persist()
    elif materialize == "checkpoint":
        checkpoint_root(matches.sparkSession)
        matches = matches.checkpoint(eager=True)
    elif materialize != "none":
        raise ValueError("materialize is 'none', 'persist' or 'checkpoint'")
    return {"total": total(matches), "detail": page(matches, page_no, size),
            "gender": gender_stats(matches), "age": age_stats(matches)}
