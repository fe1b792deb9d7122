"""Language-model scores from a weighted backoff automaton, trained and applied in blocks.

The model is a bigram model with absolute discounting. Unigrams cover every word of the training
documents, bigrams every two words that follow each other there, whatever their counts. As an
automaton: the root reads any word; each word is a state, with an arc for each bigram seen and a
failure arc, weighted with the mass that discounting freed, back to the root.

No task holds the whole model. Documents are cut into blocks; a block's distinct words are sent to
the table of counts and come back with count and global number. The bigrams, as pairs of numbers,
are dealt to buckets by their context, a common context over several by its second words too. A
bucket adds up and answers each block with the totals of its bigrams and what is known of their
contexts, in the order asked. The block's own part of the automaton, complete for its documents, is
built from them. One left-to-right traversal carries a state per document and adds up
log-probabilities, all documents of the block side by side.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, drop_table, held_out, materialize, mix64, pack_ints, pack_longs, shuffle_width, tokens, unpack_ints, unpack_longs

#: Characters of text in a block.
BLOCK_CHARS = 8 << 20
#: Share of the training tokens from which on a word has a state: all words have one.
MIN_SHARE = 0.0
#: Training tokens for each bucket of bigrams.
BUCKET_TOKENS = 2 << 20


def _blocks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, train, text) to block rows and, for each distinct word of a block, a row (block,
    local, word, n): its number within the block and its count in training documents."""
    schema = pa.schema([
        ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32())),
        ("ids", pa.binary()), ("words", pa.binary()), ("local", pa.int32()), ("word", pa.binary()), ("n", pa.int64())])
    part, seq = TaskContext.get().partitionId(), 0

    def rows(block, docs, train, lengths, ids, vocab):
        ids = np.concatenate(ids)
        # numbered anew by frequency, so that the numbers of most tokens are small
        order = np.argsort(-np.bincount(ids, minlength=len(vocab)), kind="stable")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        ids = number[ids]
        words = list(vocab)
        words = [words[i] for i in order.tolist()]
        n = np.bincount(ids[np.repeat(np.array(train, bool), lengths)], minlength=len(words))
        yield pa.RecordBatch.from_arrays([
            pa.array([block]), pa.array([docs], schema.field(1).type), pa.array([train], schema.field(2).type),
            pa.array([lengths], schema.field(3).type), pa.array([pack_ints(ids)], pa.binary()), pa.array([zlib.compress(b"\n".join(words), 3)], pa.binary()),
            pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64())], schema=schema)
        for at in range(0, len(words), 100_000):
            some = words[at:at + 100_000]
            k = len(some)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(k, block)), *(pa.nulls(k, schema.field(i).type) for i in range(1, 6)),
                pa.array(np.arange(at, at + k, dtype=np.int32)), pa.array(some, pa.binary()), pa.array(n[at:at + k])], schema=schema)

    docs, train, lengths, ids, vocab, chars = [], [], [], [], {b"": 0}, 0
    for doc_ids, marks, texts in batches(it, ["doc_id", "train", "text"], BLOCK_CHARS >> 2):
        for doc, mark, text in zip(doc_ids, marks, texts):
            own = [vocab.setdefault(w, len(vocab)) for w in tokens(text)]
            own.append(0)  # the end: the empty word, which no text has
            docs.append(doc)
            train.append(mark)
            lengths.append(len(own))
            ids.append(np.array(own, np.int32))
            chars += len(text or "")
            if chars >= BLOCK_CHARS:
                yield from rows((part << 32) + seq, docs, train, lengths, ids, vocab)
                seq += 1
                docs, train, lengths, ids, vocab, chars = [], [], [], [], {b"": 0}, 0
    if docs:
        yield from rows((part << 32) + seq, docs, train, lengths, ids, vocab)


class Pairs:
    """A block's distinct pairs (context, next word), by bucket and key, with counts in its training
    documents. Words are local numbers; ``w`` is -1 for all words without a state, the end among
    them, so each context is asked for. No pair crosses an end."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, train: np.ndarray, counts: np.ndarray, rank: np.ndarray, deal: dict):
        inner = np.ones(len(ids), bool)
        inner[np.cumsum(lengths) - 1] = False
        state = rank >= 0
        at = np.flatnonzero(inner & state[ids])
        width = len(counts) + 1
        second = np.where(state[ids[at + 1]], ids[at + 1] + 1, 0)
        weights = np.repeat(train, lengths)[at] & (second > 0)
        pair, place = np.unique(ids[at] * width + second, return_inverse=True)
        n = np.bincount(place, weights=weights, minlength=len(pair)).astype(np.int64)
        u, w = pair // width, pair % width - 1
        second = np.where(w >= 0, rank[w] + 1, 0)
        keys = rank[u] * deal["width"] + second
        spread = np.where(rank[u] < deal["heavy"], np.minimum(deal["buckets"], counts[u] // deal["limit"] + 1), 1)
        part = mix64(second.astype(np.uint64)) % spread.astype(np.uint64)
        bucket = ((mix64(rank[u].astype(np.uint64)) + part) % np.uint64(deal["buckets"])).astype(np.int64)
        order = np.lexsort((keys, bucket))
        self.u, self.w, self.keys, self.n, self.bucket = u[order], w[order], keys[order], n[order], bucket[order]

    def contexts(self) -> np.ndarray:
        """Places at which a bucket or a context begins."""
        if not len(self.u):
            return np.empty(0, np.int64)
        return np.flatnonzero(np.append(True, (self.u[1:] != self.u[:-1]) | (self.bucket[1:] != self.bucket[:-1])))


BLOCK = "block long, doc_ids array<long>, train array<boolean>, lengths array<int>, ids binary, low binary, ranks binary"
ASKED = "bucket int, keys binary, counts binary"


def _bigrams(deal: dict):
    """A block and the answers for its words to the block with their counts and ranks packed, and to
    packed rows (bucket, block, keys, counts) of its pairs."""

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        row = blocks.to_pylist()[0]
        ids, lengths, train = unpack_ints(row["ids"]), np.array(row["lengths"], np.int64), np.array(row["train"], bool)
        at, c, r = (np.concatenate([unpack_longs(x) for x in answers.column(name).to_pylist()]) for name in ("locals", "low", "ranks"))
        counts, rank = np.zeros(len(at), np.int64), np.full(len(at), -1, np.int64)
        counts[at], rank[at] = c, r - 1
        pairs = Pairs(ids, lengths, train, counts, rank, deal)
        names, starts = np.unique(pairs.bucket, return_index=True)
        cut = list(zip(starts, [*starts[1:], len(pairs.keys)]))
        k = len(names)
        # keys ascend within a bucket: steps cost less
        keys = [pack_longs(np.diff(pairs.keys[a:b], prepend=0)) for a, b in cut]
        return pa.table({
            "block": pa.array([row["block"]] * (k + 1), pa.int64()),
            "doc_ids": pa.array([row["doc_ids"], *[None] * k], pa.list_(pa.int64())),
            "train": pa.array([row["train"], *[None] * k], pa.list_(pa.bool_())),
            "lengths": pa.array([row["lengths"], *[None] * k], pa.list_(pa.int32())),
            "ids": pa.array([row["ids"], *[None] * k], pa.binary()),
            "low": pa.array([pack_longs(counts), *[None] * k], pa.binary()),
            "ranks": pa.array([pack_longs(rank + 1), *[None] * k], pa.binary()),
            "bucket": pa.array([None, *names.tolist()], pa.int32()),
            "keys": pa.array([None, *keys], pa.binary()),
            "counts": pa.array([None, *(pack_longs(pairs.n[a:b]) for a, b in cut)], pa.binary())})

    return run


TOTALS = "block long, bucket int, totals binary, masses binary, kinds binary, context long, mass long, kind long, once long, twice long"


def _totals(deal: dict):
    """A bucket's packed rows to an answer for each: the totals of its keys, and mass and kinds of
    bigrams of its contexts, both in the order of the keys. A light context lies in this bucket
    only; parts of heavy ones, and the bigrams seen once and twice, go out as rows without a block."""

    def run(table: pa.Table) -> pa.Table:
        width = deal["width"]
        bucket = table.column("bucket")[0].as_py()
        blocks = table.column("block").to_pylist()
        keys = [np.cumsum(unpack_longs(x)) for x in table.column("keys").to_pylist()]
        counts = np.concatenate([unpack_longs(x) for x in table.column("counts").to_pylist()])
        known, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, weights=counts, minlength=len(known)).astype(np.int64)
        context, of = np.unique(known // width, return_inverse=True)
        mass = np.bincount(of, weights=total).astype(np.int64)
        kinds = np.bincount(of, weights=total > 0).astype(np.int64)
        out, at = [], 0
        for block, k in zip(blocks, keys):
            asked = np.searchsorted(context, np.unique(k // width))
            out.append((block, bucket, pack_longs(total[place[at:at + len(k)]]), pack_longs(mass[asked]), pack_longs(kinds[asked]), *[None] * 5))
            at += len(k)
        for i in range(int(np.searchsorted(context, deal["heavy"]))):
            out.append((*[None] * 5, int(context[i]), int(mass[i]), int(kinds[i]), None, None))
        out.append((*[None] * 8, int((total == 1).sum()), int((total == 2).sum())))
        types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), *[pa.int64()] * 5]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[c.split()[0] for c in TOTALS.split(", ")])

    return run


def _discount(once: int, twice: int) -> float:
    return min(0.9, max(0.1, once / (once + 2 * twice))) if once + twice else 0.5


def _answers(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, local, c, rank) to packed rows (block, locals, low, ranks): those of a batch
    for one block together."""
    for batch in it:
        block, local, c, rank = (batch.column(batch.schema.get_field_index(x)).to_numpy() for x in ("block", "local", "c", "rank"))
        order = np.argsort(block, kind="stable")
        block, local, c, rank = block[order], local[order], c[order], rank[order]
        names, starts = np.unique(block, return_index=True)
        cut = list(zip(starts, [*starts[1:], len(block)]))
        packed = [[pack_longs(x[a:b]) for a, b in cut] for x in (local, c, rank + 1)]
        yield pa.RecordBatch.from_arrays([pa.array(names), *(pa.array(x, pa.binary()) for x in packed)],
                                         names=["block", "locals", "low", "ranks"])


class Automaton:
    """A block's part of the model. States are numbered by local word + 1; the root is 0."""

    def __init__(self, counts: np.ndarray, rank: np.ndarray, pairs: Pairs, totals: np.ndarray, mass: np.ndarray, kinds: np.ndarray, facts: dict):
        n, v = facts["tokens"], facts["types"]
        d1, d2 = facts["d1"], facts["d2"]
        if n:
            p1 = np.where(counts > 0, (counts - d1) / n, d1 * v / n)
        else:
            p1 = np.ones(len(counts))
        self.root = np.log10(p1)
        self.next = np.where(rank >= 0, np.arange(len(rank)) + 1, 0)
        self.words = len(counts)
        # failure arcs: what discounting leaves of each context
        left = np.ones(self.words + 1)
        left[1:] = 1 - (mass - d2 * kinds) / np.maximum(counts, 1)
        self.fail = np.log10(left)
        seen = (totals > 0) & (pairs.w >= 0)
        u, w = pairs.u[seen], pairs.w[seen]
        arcs = (u + 1) * self.words + w
        weight = np.log10((totals[seen] - d2) / counts[u] + left[u + 1] * p1[w])
        order = np.argsort(arcs)
        self.arcs, self.weight = arcs[order], weight[order]

    def traverse(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Log10 probability of each document, read word by word, all documents in step."""
        order = np.argsort(-lengths, kind="stable")
        starts = (np.cumsum(lengths) - lengths)[order]
        sizes = lengths[order]
        total, state = np.zeros(len(lengths)), np.zeros(len(lengths), np.int64)
        active = len(lengths)
        for t in range(int(sizes[0]) if len(sizes) else 0):
            while sizes[active - 1] <= t:
                active -= 1
            w = ids[starts[:active] + t].astype(np.int64)
            s = state[:active]
            step = self.root[w]
            at = np.flatnonzero(s)
            if len(at):
                arc = s[at] * self.words + w[at]
                place = np.searchsorted(self.arcs, arc)
                place[place == len(self.arcs)] = 0
                hit = self.arcs[place] == arc if len(self.arcs) else np.zeros(len(at), bool)
                step[at] = np.where(hit, self.weight[place] if len(self.arcs) else 0.0, self.fail[s[at]] + step[at])
            total[:active] += step
            state[:active] = self.next[w]
        out = np.empty(len(lengths))
        out[order] = total
        return out


def _score(facts: dict, deal: dict):
    """A block and the totals of its bigrams to its documents' scores."""

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        row = blocks.to_pylist()[0]
        ids, lengths, train = unpack_ints(row["ids"]), np.array(row["lengths"], np.int64), np.array(row["train"], bool)
        counts, rank = unpack_longs(row["low"]), unpack_longs(row["ranks"]) - 1
        pairs = Pairs(ids, lengths, train, counts, rank, deal)
        answers = answers.sort_by("bucket")
        none = np.empty(0, np.int64)
        totals, masses, several = (np.concatenate([none, *(unpack_longs(x) for x in answers.column(c).to_pylist())]) for c in ("totals", "masses", "kinds"))
        mass, kinds = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
        of = pairs.u[pairs.contexts()]
        mass[of], kinds[of] = masses, several
        at = np.flatnonzero((rank >= 0) & (rank < deal["heavy"]))
        mass[at], kinds[at] = facts["mass"][rank[at]], facts["kinds"][rank[at]]
        model = Automaton(counts, rank, pairs, totals, mass, kinds, facts)
        base = np.log10((counts + 0.5) / (facts["tokens"] + 0.5 * (facts["types"] + 1)))
        starts = np.cumsum(lengths) - lengths
        return pa.table({
            "doc_id": pa.array(row["doc_ids"], pa.int64()), "train": pa.array(row["train"], pa.bool_()),
            "n_tokens": pa.array(lengths),
            "n_known": pa.array(np.add.reduceat((counts > 0).astype(np.int64)[ids], starts)),
            "base_score": pa.array(np.add.reduceat(base[ids], starts)),
            "score": pa.array(model.traverse(ids, lengths))})

    return run


def score_documents(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
                    min_share: float = MIN_SHARE) -> DataFrame:
    """One row per document: doc_id, train, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows where ``train`` is true (null counts as false) and scores all rows,
    whole texts. Words are runs between blanks, A-Z lowered, and an end counts as a token, so a
    null or empty text has one token. ``base_score`` is the add-0.5 unigram score; ``score`` is
    the automaton's log10 probability, in which all unseen words share one probability, as they
    do in the base. Repeated rows each count and each get a row; without training rows every
    word has probability 1. Other columns are not looked at.
    """
    spark = docs.sparkSession
    pieces = materialize(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).alias("text"),
    ).mapInArrow(_blocks, "block long, doc_ids array<long>, train array<boolean>, lengths array<int>, ids binary, words binary, "
                          "local int, word binary, n long"))
    blocks = pieces.filter("ids is not null")
    vocab = pieces.filter("word is not null").select("block", "local", "word", "n")
    counts = materialize(vocab.groupBy("word").agg(F.sum("n").alias("c")).filter("c > 0"))
    n, v, once, twice = counts.agg(
        F.sum("c"), F.count("*"), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first()
    n = n or 0
    # numbers by falling count, words with a state first; the end has no successor and no state
    state = (F.col("c") >= n * min_share) & (F.length("word") > 0)
    order = [F.col("state").desc(), F.col("c").desc(), F.col("word")]
    numbered = materialize(counts.withColumn("state", state).repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(
        *order).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    offsets, width = [], 0
    for p, k in sorted(tuple(r) for r in numbered.groupBy(part.alias("p")).agg(F.count("*")).collect()):
        offsets.append((p, width - (p << 33)))
        width += k
    if width >= 3 << 30:
        raise ValueError("pairs of words do not fit 63 bits")
    buckets = max(16, shuffle_width(spark), n // BUCKET_TOKENS)
    limit = -(-n // (4 * buckets)) or 1
    # contexts in more than one bucket: at most 4 * buckets
    heavy = numbered.filter(F.col("state") & (F.col("c") >= limit)).count()
    deal = {"width": width + 1, "buckets": buckets, "limit": limit, "heavy": heavy}
    rank = F.when(F.col("state"), F.col("at") + F.col("offset"))
    ranked = numbered.withColumn("p", part).join(
        F.broadcast(spark.createDataFrame(offsets, "p long, offset long")), "p").select("word", "c", rank.alias("rank"))
    answers = vocab.join(ranked, "word", "left").select(
        "block", "local", F.coalesce("c", F.lit(0)).alias("c"), F.coalesce("rank", F.lit(-1)).alias("rank"))
    answers = answers.mapInArrow(_answers, "block long, locals binary, low binary, ranks binary").withColumnRenamed("block", "of_block")
    asked = materialize(blocks.select("block", "doc_ids", "train", "lengths", "ids").groupBy("block").cogroup(
        answers.groupBy("of_block")).applyInArrow(_bigrams(deal), f"{BLOCK}, {ASKED}"))
    for old in (pieces, counts, numbered):
        drop_table(old)
    totals = materialize(asked.filter("keys is not null").select("bucket", "block", "keys", "counts").groupBy("bucket").applyInArrow(
        _totals(deal), TOTALS))
    once2, twice2 = totals.agg(F.sum("once"), F.sum("twice")).first()
    facts = {"tokens": n, "types": v, "d1": _discount(once, twice), "d2": _discount(once2 or 0, twice2 or 0),
             "mass": np.zeros(heavy, np.int64), "kinds": np.zeros(heavy, np.int64)}
    for c, m, k in totals.filter("context is not null").groupBy("context").agg(F.sum("mass"), F.sum("kind")).collect():
        facts["mass"][c], facts["kinds"][c] = m, k
    grams = totals.filter("block is not null").select(F.col("block").alias("of_block"), "bucket", "totals", "masses", "kinds")
    scored = asked.filter("ids is not null").select(*[c.split()[0] for c in BLOCK.split(", ")]).groupBy("block").cogroup(
        grams.groupBy("of_block")).applyInArrow(
        _score(facts, deal), "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumn("train_tokens", F.lit(n).cast("long"))


def op2_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = score_documents(docs, ~held_out(F.col("doc_id"), 1))
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
