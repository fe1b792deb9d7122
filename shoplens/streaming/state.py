"""A job's stored table: batches behind a base that is kept by day.

Each micro-batch is written to its own ``batch_id=N`` folder (overwritten by a replay). Every so many
batches those folders are folded, for the spans of days they touch, into a base sorted by day and dealt
over files by key. ``_manifest/N.json`` names what the table is after batch N: the folder of each span's
base, and which batches lie in front of it with their spans. A batch or report opens the files of its
own days only, and as many after a year as after an hour.

A batch reads the manifest before its own, so a replay sees what the first run saw. Writing a
manifest is one atomic rename; readers see the table before or after it. What a manifest no longer names
stays for ``GRACE`` batches, for readers that still hold an older one.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.config import shuffles_dropped

#: Batches in front of the base, batches that folders outlive their manifest, manifests kept.
FOLD_EVERY, GRACE, MANIFESTS = 16, 1200, 50
Fold = Callable[[DataFrame], DataFrame]
EPOCH, DAY = dt.date(1970, 1, 1), re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}")
#: The span of rows whose day is none.
NO_DAY = -10 ** 9


def _store(writer: DataFrameWriter, spark: SparkSession, path: str) -> None:
    with shuffles_dropped(spark):
        writer.option("compression", "zstd").parquet(path)


class DayTable:
    """Rows with a ``day`` (a date, a 'yyyy-MM-dd' text or a number) under ``path``.

    ``fold`` merges rows of one span into the rows that stand for them (the latest of each key, sums);
    it gets and returns ``batch_id`` too, and folding twice must equal folding once. ``span``: days that
    share a folder of the base; 1 where a day's rows are many, more where years arrive at once.
    """

    def __init__(self, spark: SparkSession, path: str, day: str, fold: Fold, keys: list[str], span: int = 1,
                 fold_every: int = FOLD_EVERY, grace: int = GRACE):
        self.spark, self.path, self.day, self.fold, self.keys = spark, path.rstrip("/"), day, fold, keys
        self.span, self.fold_every, self.grace = span, fold_every, grace

    # --- files ---

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def _numbers(self) -> list[int]:
        fs, p = self._fs(f"{self.path}/_manifest")
        if not fs.exists(p):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(p)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, before: int | None = None) -> dict | None:
        """What the table is now, or was before batch ``before``; None if there is nothing yet."""
        numbers = [n for n in self._numbers() if before is None or n < before]
        if not numbers:
            return None
        fs, p = self._fs(f"{self.path}/_manifest/{numbers[-1]}.json")
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, manifest: dict) -> None:
        """Make ``manifest`` the table's state after its batch: written beside, then renamed over."""
        jvm = self.spark.sparkContext._jvm
        final = f"{self.path}/_manifest/{manifest['batch']}.json"
        fs, beside = self._fs(f"{final}.new")
        out = fs.create(beside, True)
        out.write(bytearray(json.dumps(manifest).encode("utf-8")))
        out.close()
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(beside.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(beside, jvm.org.apache.hadoop.fs.Path(final), how)

    # --- days and spans ---

    def _span_of(self, day) -> int:
        if isinstance(day, str):
            try:
                day = dt.datetime.strptime(day, "%Y-%m-%d").date() if DAY.fullmatch(day) else None
            except ValueError:
                day = None
        if day is None:
            return NO_DAY
        return ((day - EPOCH).days if isinstance(day, dt.date) else int(day)) // self.span

    def _span(self, df: DataFrame) -> Column:
        c, kind = F.col(self.day), df.schema[self.day].dataType
        if isinstance(kind, T.StringType):
            c = F.when(c.rlike(f"^{DAY.pattern}$"), c.try_cast("date"))
        number = c if isinstance(kind, T.IntegralType) else F.datediff(c, F.lit(EPOCH))
        return F.coalesce(F.floor(number / self.span).cast("long"), F.lit(NO_DAY).cast("long"))

    def _among(self, days: list) -> Column:
        """Whether a row's day is one of ``days``. As one expression: ``isin`` makes a literal at a time, which
        takes a second and a half for 2,500 days."""
        def literal(day) -> str:
            if isinstance(day, str):
                return "'" + day.replace("\\", "\\\\").replace("'", "\\'") + "'"
            return f"DATE'{day.isoformat()}'" if isinstance(day, dt.date) else str(int(day))

        return F.expr(f"`{self.day}` IN ({', '.join(map(literal, days))})")

    def days(self, df: DataFrame) -> list:
        """The distinct days of ``df``: a value per calendar day."""
        return sorted(df.agg(F.collect_set(self.day)).first()[0])

    # --- reading ---

    def _files(self, manifest: dict, spans: set[int] | None) -> tuple[list[str], list[str]]:
        base = [f for s, f in manifest["base"].items() if spans is None or int(s) in spans]
        live = [f"batch_id={b}" for b, touched in manifest["live"].items() if spans is None or spans & set(touched)]
        return base, live

    def _rows(self, manifest: dict, spans: set[int] | None = None) -> DataFrame:
        base, live = self._files(manifest, spans)
        schema = T.StructType.fromJson(manifest["schema"]).add("batch_id", "long")
        none = self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
        out = none if not base and not live else None
        if base:
            out = self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in base])
        if live:
            front = self.spark.read.schema(schema).option("basePath", self.path).parquet(*[f"{self.path}/{f}" for f in live])
            out = front if out is None else out.unionByName(front)
        return out

    def rows(self, days: Iterable | None = None, before: int | None = None) -> DataFrame | None:
        """Stored rows (with ``batch_id``), of ``days`` if given; of batches below ``before``. Not folded.
        None if there are no batches."""
        manifest = self.manifest(before)
        if manifest is None:
            return None
        if days is None:
            return self._rows(manifest)
        days = sorted(days)
        out = self._rows(manifest, {self._span_of(d) for d in days})
        return out.where(self._among(days)) if days else out.where(F.lit(False))

    def read(self, days: Iterable | None = None, before: int | None = None, columns: list[str] | None = None) -> DataFrame:
        """The table (of ``columns``, which ``fold`` must do with): rows folded, whatever part of them is in the base yet."""
        found = self.rows(days, before)
        if found is None:
            raise ValueError(f"no batch is stored under {self.path}")
        return self.fold(found if columns is None else found.select(*columns, "batch_id"))

    # --- writing ---

    def write(self, df: DataFrame | Sequence[DataFrame], batch_id: int) -> DataFrame:
        """Store a batch and return what was stored. Rows without a day are stored too; only readers of
        all days see them. Of a batch in several parts one is written after the other, so that only one's
        shuffle files are on the disks at a time."""
        target = f"{self.path}/batch_id={batch_id}"
        parts = [df] if isinstance(df, DataFrame) else df
        for i, part in enumerate(parts):
            _store(part.sortWithinPartitions(self.day).write.mode("append" if i else "overwrite"), self.spark, target)
        mine = self.spark.read.schema(parts[0].schema).parquet(target)
        touched = mine.agg(F.collect_set(self._span(mine))).first()[0]
        manifest = self.manifest(batch_id) or {"base": {}, "live": {}, "dropped": [], "schema": mine.schema.jsonValue()}
        if len(manifest["live"]) >= self.fold_every:
            manifest = self.folded(manifest, batch_id, f"_base/{batch_id}")
        manifest["live"][str(batch_id)] = sorted(touched)
        manifest["batch"] = batch_id
        gone = [f for b, f in manifest["dropped"] if b + self.grace <= batch_id]
        manifest["dropped"] = [[b, f] for b, f in manifest["dropped"] if b + self.grace > batch_id]
        self.commit(manifest)
        for f in gone:
            self._delete(f"{self.path}/{f}")
        for n in self._numbers()[:-MANIFESTS]:
            self._delete(f"{self.path}/_manifest/{n}.json")
        return mine

    def folded(self, manifest: dict, batch_id: int, folder: str) -> dict:
        """``manifest`` with the batches in front folded into the base, in new folders: nothing that is there is
        changed, and nobody sees the new folders before a manifest names them."""
        spans = {s for touched in manifest["live"].values() for s in touched}
        rows = self.fold(self._rows(manifest, spans))
        rows = rows.withColumn("_span", self._span(rows)).where(F.col("_span").isin(sorted(spans)))
        dealt = rows.repartition("_span", F.pmod(F.xxhash64(*self.keys), F.lit(8))).sortWithinPartitions("_span", self.day, *self.keys)
        _store(dealt.write.mode("overwrite").partitionBy("_span"), self.spark, f"{self.path}/{folder}")
        fs, p = self._fs(f"{self.path}/{folder}")
        there = {f.getPath().getName() for f in fs.listStatus(p)}
        base, old = dict(manifest["base"]), []
        for s in spans:
            if str(s) in base:
                old.append(base.pop(str(s)))
            if f"_span={s}" in there:
                base[str(s)] = f"{folder}/_span={s}"
        old += [f"batch_id={b}" for b in manifest["live"]]
        return manifest | {"base": base, "live": {}, "dropped": manifest["dropped"] + [[batch_id, f] for f in old]}

    def compact(self) -> None:
        """Fold all batches into the base now. For a job that is stopped; a running one folds by itself."""
        manifest = self.manifest()
        if manifest and manifest["live"]:
            self.commit(self.folded(manifest, manifest["batch"], f"_base/{manifest['batch']}-compacted"))
