"""Secret scans in column functions: fixed patterns, and strings that look random.

Two first-order Markov models of characters, one of random strings and one of ordinary
identifiers, are trained from labelled samples; a candidate's log-likelihood ratio decides. The
models are one table of 96 x 96 ratios, a constant in the plan, so scanning is a projection: no
shuffle, no Python in tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Kinds in the order that ties are listed: pattern, least length of the capture, capture group.
#: Hex runs and access keys are matched with their least length, which gives the same matches as
#: dropping short ones afterwards; an assignment's short value must be matched first and dropped
#: then, since it uses up its characters.
PATTERNS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 0),
    "hex": (r"[0-9a-f]{24,}", 0, 0),
}
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
#: Documents that training samples are taken from, and made-up random strings of each alphabet.
MAX_SAMPLE_DOCS, MADE_UP = 2_000, 1_000
#: A candidate is a secret if it is more than e^12 times likelier as a random string.
MIN_RATIO = 12.0
LOW, WIDTH = 32, 96
#: Arrays are folded in chunks, since each append copies what is there.
CHUNK = 256
_SPAN = "struct<start:int,rank:int,kind:string,end:int,word:string>"


def _let(value: Column, then) -> Column:
    """``then`` of a value that is evaluated once, also where ``then`` uses it in a lambda."""
    return F.transform(F.array(value), then)[0]


def _chunks(values: Column) -> Column:
    """A bound array cut into slices of CHUNK entries (an empty one: one empty slice)."""
    last = F.greatest(F.floor((F.size(values) - 1) / CHUNK), F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(values, i * CHUNK + 1, CHUNK))


def _place(pieces: Column, kind: str, rank: int, least: int) -> Column:
    """(at, spans) of some pieces, offsets from their own beginning."""
    def add(acc, x):
        at = acc["at"] + x["gap"]
        span = F.struct(at.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
                        (at + F.length(x["word"])).alias("end"), x["word"].alias("word"))
        spans = F.when(x["value"] >= least, F.array_append(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((at + F.length(x["word"])).alias("at"), spans.alias("spans"))

    return F.aggregate(pieces, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans")), add)


def _shift(s: Column, by: Column) -> Column:
    return F.struct((s["start"] + by).alias("start"), s["rank"].alias("rank"), s["kind"].alias("kind"),
                    (s["end"] + by).alias("end"), s["word"].alias("word"))


def _spans(text: Column, kind: str, rank: int, pattern: str, least: int = 0, group: int = 0) -> Column:
    """All matches, leftmost first, as structs of code point offsets and the matched word. What
    lies between matches comes from splitting at them; lengths added up give the offsets."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    pieces = F.arrays_zip(F.transform(F.slice(between, 1, F.size(found)), lambda x: F.length(x)).alias("gap"),
                          found.alias("word"), F.transform(value, lambda x: F.length(x)).alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{_SPAN}>>").alias("spans"))

    def add(acc, chunk):
        return _let(_place(chunk, kind, rank, least), lambda p: F.struct(
            (acc["at"] + p["at"]).alias("at"),
            F.array_append(acc["spans"], F.transform(p["spans"], lambda s: _shift(s, acc["at"]))).alias("spans")))

    spans = _let(pieces, lambda p: F.flatten(F.aggregate(_chunks(p), start, add, lambda acc: acc["spans"])))
    return F.when(F.rlike(text, F.lit(pattern)), spans).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _without_word(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(*[s[c].alias(c) for c in ("start", "rank", "kind", "end")]))


def _apart(spans: Column, base: Column) -> Column:
    """The spans that overlap no base span. A chunk of spans looks only at the base spans that
    reach into its range, so the work grows with the spans and not with the product."""
    def of_chunk(chunk):
        near = F.filter(base, lambda b: (b["start"] < F.element_at(chunk, -1)["end"]) & (chunk[0]["start"] < b["end"]))
        return _let(near, lambda n: F.filter(chunk, lambda s: ~F.exists(n, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))))

    some = F.filter(_chunks(spans), lambda c: F.size(c) > 0)
    return F.flatten(F.transform(some, of_chunk))


def base_spans(text: Column) -> list[Column]:
    return [_without_word(_spans(text, kind, i, *spec)) for i, (kind, spec) in enumerate(PATTERNS.items())]


def _code(word: Column, i: Column) -> Column:
    """The pair of characters at positions i and i + 1 (from 1) as an index into the table."""
    def one(at):
        return F.greatest(F.lit(0), F.least(F.lit(WIDTH - 1), F.ascii(F.substr(word, at, F.lit(1))) - LOW))
    return one(i) * WIDTH + one(i + 1)


def fit(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios per character pair from samples (word, random): random against
    ordinary, each smoothed by half a count. Words shorter than two characters and null rows add
    nothing. The counts collected are one per class and pair, 2 * 96 * 96 at most."""
    pairs = samples.filter("word is not null and random is not null and length(word) > 1").select(
        "random", F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: _code(F.col("word"), i))).alias("code"))
    counts = {(r[0], r[1]): r[2] for r in pairs.groupBy("random", "code").count().collect()}
    table = [0.0] * (WIDTH * WIDTH)
    for a in range(WIDTH):
        total = {c: sum(counts.get((c, a * WIDTH + b), 0) for b in range(WIDTH)) + 0.5 * WIDTH for c in (True, False)}
        for b in range(WIDTH):
            p = {c: (counts.get((c, a * WIDTH + b), 0) + 0.5) / total[c] for c in (True, False)}
            table[a * WIDTH + b] = round(math.log(p[True] / p[False]), 4)
    return table


def ratio(word: Column, table: Column) -> Column:
    """The word's log-likelihood ratio, random against ordinary, in one pass over its characters."""
    codes = F.transform(F.split(word, ""), lambda c: F.greatest(F.lit(0), F.least(F.lit(WIDTH - 1), F.ascii(c) - LOW)))
    start = F.struct(F.lit(None).cast("int").alias("last"), F.lit(0.0).alias("sum"))

    def add(acc, code):
        of_pair = F.element_at(table, acc["last"] * WIDTH + code + 1)
        return F.struct(code.alias("last"), (acc["sum"] + F.coalesce(of_pair, F.lit(0.0))).alias("sum"))

    return F.aggregate(codes, start, add, lambda acc: acc["sum"])


def labelled_samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     max_docs: int = MAX_SAMPLE_DOCS, made_up: int = MADE_UP) -> DataFrame:
    """(word, random) from at most ``max_docs`` documents, those of smallest hash of the id: what the
    patterns find is random, other words of eight characters or more are ordinary. ``made_up``
    digests in each of three alphabets stand in where documents hold few secrets."""
    spark = docs.sparkSession
    ids = docs.select(F.col(id_col).alias("__id")).filter("__id is not null").distinct()
    ids = ids.withColumn("__h", F.xxhash64("__id")).orderBy("__h", "__id").limit(max_docs).select("__id")
    texts = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.join(F.broadcast(ids), "__id")  # max_docs ids at most
    found = F.concat(F.regexp_extract_all("text", F.lit(PATTERNS["assign"][0]), F.lit(2)),
                     *[F.regexp_extract_all("text", F.lit(PATTERNS[k][0]), F.lit(0)) for k in ("access", "hex")])
    secret = texts.select(F.explode(found).alias("word")).filter("length(word) >= 16").select("word", F.lit(True).alias("random"))
    rest = F.col("text")
    for pattern, _, _ in PATTERNS.values():
        rest = F.regexp_replace(rest, pattern, " ")
    plain = texts.select(F.explode(F.regexp_extract_all(rest, F.lit("[A-Za-z0-9+/_=-]{8,}"), F.lit(0))).alias("word"), F.lit(False).alias("random"))
    hexes = F.sha2(F.col("id").cast("string").cast("binary"), 256)
    digests = spark.range(made_up).select(F.explode(F.array(
        hexes, F.base64(F.unhex(hexes)), F.translate(F.upper(F.conv(F.substring(hexes, 1, 15), 16, 36)), "01", "XY"))).alias("word"),
        F.lit(True).alias("random"))
    return secret.unionByName(plain).unionByName(digests)


def scan(docs: DataFrame, table: list[float], id_col: str = "doc_id", text_col: str = "text",
         min_ratio: float = MIN_RATIO) -> DataFrame:
    """(doc_id, base, added): arrays of spans (start, rank, kind, end) in code points, base spans by
    start, then kind as listed, added ones (kind "markov") by start. Candidates that overlap a
    base span are not added. Null counts as empty; one row per row; other columns are not looked at."""
    ratios = F.split(F.lit(",".join(map(str, table))), ",").cast("array<double>")
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    out = out.withColumn("base", F.array_sort(F.concat(*base_spans(F.col("text")))))
    candidates = _spans(F.col("text"), "markov", len(PATTERNS), CANDIDATE)
    found = F.filter(_let(candidates, lambda c: _let(F.col("base"), lambda b: _apart(c, b))),
                     lambda s: ratio(s["word"], ratios) >= min_ratio)
    return out.select("doc_id", "base", _without_word(found).alias("added"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = scan(docs, fit(labelled_samples(docs)))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select("doc_id", *[count(k) for k in PATTERNS], F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                      _joined(F.array_sort(F.concat("base", "added"))).alias("spans"))
