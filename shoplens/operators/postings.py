"""A stored inverted index over the sales table: searches read postings, not the table.

Per token and row there is one posting with the row's day, name, count of the token and length. Postings
lie in parts by token, so a search opens the parts of its tokens; row count and total length, which BM25
needs, are sums kept up by each batch. An update takes the rows of one batch: of rows stored before, the
tokens they have lost are written as postings with count 0, and the sums get the difference.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.config import in_turn, turns
from shoplens.functions.text import query_tokens, tokens
from shoplens.operators.dedup import keep_last
from shoplens.operators.search import BM25_B, BM25_K1, TIE_BREAK
from shoplens.streaming.state import DayTable

#: Parts of the postings, by token.
PARTS = 256


class SearchIndex:
    def __init__(self, spark: SparkSession, path: str, field: str = "sku_name", **layout):
        self.spark, self.path, self.field = spark, path, field

        def latest(t: DataFrame) -> DataFrame:
            return keep_last(t, ["token", *TIE_BREAK], ["batch_id"]).where("tf > 0")

        def added(t: DataFrame) -> DataFrame:
            return t.groupBy("part").agg(*[F.sum(c).alias(c) for c in ("rows", "named", "length")], F.max("batch_id").alias("batch_id"))

        self.postings = DayTable(spark, f"{path}/postings", "part", latest, ["token"], **layout | {"span": 1})
        self.rows = DayTable(spark, f"{path}/rows", "dt", lambda t: keep_last(t, TIE_BREAK, ["batch_id"]), TIE_BREAK, **layout)
        self.sums = DayTable(spark, f"{path}/sums", "part", added, ["part"], **layout | {"span": 1})

    def _tokens(self, rows: DataFrame) -> DataFrame:
        """(token, key, dt, name, length, tf) of each row's tokens; ``rows`` has a row per key, so they are counted in it."""
        cut = rows.select(*TIE_BREAK, "dt", self.field, tokens(self.field).alias("_t")).withColumn("length", F.coalesce(F.size("_t"), F.lit(0)))
        each = cut.select("*", F.explode(F.array_distinct("_t")).alias("token"))
        return each.select("token", *TIE_BREAK, "dt", self.field, "length", F.expr("size(_t) - size(array_remove(_t, token))").alias("tf"))

    def update(self, batch: DataFrame, batch_id: int) -> None:
        """Add the rows of a batch (key, ``dt``, name), or replace rows of the same key and day. A batch that is
        run again replaces what it wrote."""
        named, k = batch.select(*TIE_BREAK, "dt", self.field), turns(batch)
        new = [keep_last(in_turn(named, TIE_BREAK, i, k), TIE_BREAK, ["dt"]) for i in range(k)]
        mine = self.rows.write(new, batch_id)
        old = self.rows.rows(self.rows.days(mine), before=batch_id)
        found = self._tokens(mine)
        sums = self._size(mine, 1)
        if old is not None:
            before = self.rows.fold(old).drop("batch_id").join(mine.select(*TIE_BREAK), TIE_BREAK, "left_semi")
            gone = self._tokens(before).join(found.select("token", *TIE_BREAK), ["token", *TIE_BREAK], "left_anti").withColumn("tf", F.lit(0))
            found, sums = found.unionByName(gone), sums.unionByName(self._size(before, -1))
        part = F.pmod(F.crc32(F.col("token").cast("binary")), F.lit(PARTS)).cast("int")
        self.postings.write(found.withColumn("part", part), batch_id)
        self.sums.write(sums.groupBy("part").agg(*[F.sum(c).alias(c) for c in ("rows", "named", "length")]), batch_id)

    def _size(self, rows: DataFrame, sign: int) -> DataFrame:
        """Rows, those with a name, and the names' tokens; times ``sign``."""
        length = F.sum(F.when(F.col(self.field).isNotNull(), F.size(tokens(self.field))))
        sums = {"rows": F.count("*"), "named": F.count(self.field), "length": F.coalesce(length, F.lit(0))}
        return rows.agg(*[(c * sign).cast("long").alias(n) for n, c in sums.items()]).withColumn("part", F.lit(0))

    def search(self, keyword: str | None, date: str | None = None) -> DataFrame:
        """Rows with all tokens of ``keyword`` (of day ``date``): key, dt, name and BM25 ``score``. No token, no rows."""
        q = query_tokens(keyword)
        parts = {zlib.crc32(t.encode("utf-8")) % PARTS for t in q}
        posted = self.postings.read(parts).where(F.col("token").isin(q))
        sums = self.sums.read().agg(F.struct(F.sum("rows").cast("double").alias("n"), F.try_divide(F.sum("length"), F.sum("named")).alias("avg")).alias("s")).scalar()
        seen = posted.agg(F.struct(F.lit(0).alias("_"), *[F.count_if(F.col("token") == t).cast("double").alias(f"df{i}") for i, t in enumerate(q)]).alias("s")).scalar()
        mine = posted if date is None else posted.where(F.col("dt") == date)
        each = mine.groupBy(*TIE_BREAK, "dt", self.field, "length").agg(
            F.count_distinct("token").alias("_hits"), *[F.max(F.when(F.col("token") == t, F.col("tf"))).cast("double").alias(f"_tf{i}") for i, t in enumerate(q)])
        each = each.where(F.col("_hits") == len(q)).withColumn("_s", sums).withColumn("_df", seen)
        score = F.lit(0.0)
        for i in range(len(q)):
            tf, df = F.col(f"_tf{i}"), F.col(f"_df.df{i}")
            idf = F.log(F.lit(1.0) + (F.col("_s.n") - df + 0.5) / (df + 0.5))
            score = score + idf * tf * (BM25_K1 + 1) / (tf + BM25_K1 * ((1 - BM25_B) + BM25_B * F.col("length") / F.col("_s.avg")))
        return each.select(*TIE_BREAK, "dt", self.field, score.alias("score"))
