"""Toxicity scores from a learned lexicon, misspellings included.

Learning. A bounded sample of labelled rows gives the lexicon: words and stems (prefixes) that
occur in far more toxic than clean documents, weighed by smoothed log-odds less their standard
error. How many terms of a kind chance alone would give is reckoned from the sample itself, so
small samples have a lexicon too. A logistic model is fitted on what a lexicon finds in a document,
where that lexicon was learned from the other folds of the sample, so terms that fit by chance get
no credit; where there is little to fit on, the model stays near its prior.

Scoring. Each document's words are looked up in the lexicon's trie. A Levenshtein automaton for
the word, run along the trie, finds words one edit away, and stems one edit from its beginning,
unless clean documents hold such a spelling; letters written as digits or signs are
read as letters. Around each hit a window of the text is judged: quoted or reported use counts
apart from plain use, and the model weighs the two. The whole text is read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, free_name, held_out, materialize

#: Bound of the model: labelled rows it is fitted on.
MAX_LABELLED, FOLDS = 20_000, 4
STEMS = range(4, 10)
FUZZY_LENGTH = 4
#: Sizes of what is left of a stem without a letter or whole; words longer than ``LONG_TERM`` are told by halves.
REST_SIZES, LONG_TERM = range(FUZZY_LENGTH - 1, STEMS[-1] + 1), 64
#: Of the terms as telling as a kept one, the share that chance would give at most, and the least weight.
CHANCE, LEAST_WEIGHT = 0.1, 0.5
#: Least share of toxic documents among those of a misspelling.
SHARE_LIMIT = 0.66
#: What the model believes of its features before it has seen a document, and how firmly.
PRIOR, RIDGE = (1.0, 0.5, 0.0, 0.5), 0.3
SLICE_CHARS = 4 << 20
#: Signs that stand for letters inside a word.
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})
EDGE = ".,;:!?\"'()[]{}<>«»“”„‘’`*#&%$|/\\+=~^_-"
QUOTES = "\"“”„«»"
REPORTED = re.compile(r"\b(?:said|says|quot\w*|called|term|word|wrote|reported)\W+(?:\w+\W+){0,2}$")


def plain(token: str) -> str:
    """A token without signs at its ends, look-alikes read as letters if letters are among them."""
    t = token.strip(EDGE)
    if t.isalpha() or not t:
        return t
    if any(c.isalpha() for c in t):
        return "".join(c for c in t.translate(LOOKALIKES) if c.isalpha())
    return ""


def rests(word: str) -> list[str]:
    """The word, and what is left without any one of its letters."""
    return [word, *[word[:i] + word[i + 1:] for i in range(len(word))]]


class Lexicon:
    """Words and stems with weights, in a trie for automaton lookups. ``innocent`` holds spellings
    that are no misspelt terms."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], innocent: set[str] | None = None):
        self.words, self.stems, self.innocent = words, stems, set(innocent or ())
        self.trie: dict = {}
        #: Terms and what is left of them without one letter. Two words one edit apart share such a rest.
        self.word_rests: set[str] = set()
        self.stem_rests: set[str] = set()
        #: Of words too long for that, the two halves.
        self.long_halves: set[str] = set()
        self.longest = 0
        for term in [*words, *(s + "*" for s in stems)]:
            word = term.rstrip("*")
            if len(word) >= FUZZY_LENGTH:
                node = self.trie
                for c in word:
                    node = node.setdefault(c, {})
                node["" if term == word else "*"] = word
                if len(word) > LONG_TERM:
                    half = len(word) // 2
                    self.long_halves.update((word[:half], word[half:]))
                else:
                    (self.word_rests if term == word else self.stem_rests).update(rests(word))
                    self.longest = max(self.longest, len(word))
        #: First letters of all rests, as many as the shortest has.
        self.starts = {rest[:REST_SIZES[0]] for rest in self.word_rests | self.stem_rests}
        self.stem_starts = {rest[:REST_SIZES[0]] for rest in self.stem_rests}
        self.half_sizes = sorted({len(x) for x in self.long_halves})
        #: First letters of the stems, as many as the shortest has.
        self.stem_heads = {s[:STEMS[0]] for s in stems}

    def __reduce__(self):
        # tasks get the terms and make the trie themselves
        return Lexicon, (self.words, self.stems, self.innocent)

    def _may_be_near(self, word: str) -> bool:
        """No for nearly all words that no term is near; never for one that has a term near."""
        starts = self.starts
        # a rest of the word begins in one of these four ways
        if word[:3] in starts or word[1:4] in starts or word[0] + word[2:4] in starts or word[:2] + word[3:4] in starts:
            if len(word) <= self.longest + 1 and not self.word_rests.isdisjoint(rests(word)):
                return True
            # a beginning of the word is one edit from a stem: it shares a rest with it
            for rest in rests(word[:STEMS[-1] + 1]) if self.stem_rests else ():
                if rest[:3] in self.stem_starts and any(rest[:k] in self.stem_rests for k in REST_SIZES):
                    return True
        return bool(self.half_sizes) and any(word[:k] in self.long_halves or word[-k:] in self.long_halves for k in self.half_sizes)

    def near(self, word: str) -> list[tuple[str, float]]:
        """(spelling, weight) of the terms one edit away, innocent or not: the spelling is the word
        or, of a stem, the word's beginning and a star. The automaton is run only for words that
        share a rest with some term."""
        if len(word) < FUZZY_LENGTH - 1 or not self._may_be_near(word):
            return []
        return self._walk(word)

    def _walk(self, word: str) -> list[tuple[str, float]]:
        """The automaton run along the trie. Bit i of a state stands for i letters of the word
        read, ``even`` without an edit and ``odd`` with one at most; it dies when no bit is left."""
        masks: dict[str, int] = {}
        for i, c in enumerate(word):
            masks[c] = masks.get(c, 0) | 1 << i
        end, full = 1 << len(word), (2 << len(word)) - 1
        stack, found = [(self.trie, 1, 3)], []
        while stack:
            node, even, odd = stack.pop()
            for c, child in node.items():
                if not c:
                    if odd & end:
                        found.append((word, self.words[child]))
                    continue
                if c == "*":
                    # a state alive has read some beginning of the word
                    found.append((word[:len(child) + 1] + "*", self.stems[child]))
                    continue
                mask = masks.get(c, 0)
                now = (even & mask) << 1
                odd_now = ((odd & mask) << 1 | even | even << 1 | now | now << 1) & full
                if odd_now:
                    stack.append((child, now, odd_now))
        return found

    def find(self, word: str) -> tuple[float, bool] | None:
        """(weight, exact) of the term that a plain word matches."""
        if word in self.words:
            return self.words[word], True
        if word[:STEMS[0]] in self.stem_heads:
            for k in STEMS:
                if k <= len(word) and word[:k] in self.stems:
                    return self.stems[word[:k]], True
        weights = [w for spelling, w in self.near(word) if spelling not in self.innocent]
        return (max(weights), False) if weights else None


def quoted(text: str, at: int, window: int = 80) -> bool:
    """Whether the place is within quotation marks or just after a word of reporting."""
    before = text[max(0, at - window):at].rsplit("\n", 1)[-1]
    marks = sum(before.count(q) for q in QUOTES)
    after = text[at:at + window].split("\n", 1)[0]
    return (marks % 2 == 1 and any(q in after for q in QUOTES)) or bool(REPORTED.search(before))


class Finder:
    """A document's features; remembers words looked up before, those that match nothing in a set of their own,
    so that most of a document's words are passed over at once."""

    def __init__(self, lexicon: Lexicon, keep: int = 300_000):
        self.lexicon, self.keep, self.known, self.misses = lexicon, keep, {}, set()

    def look(self, token: str):
        if token in self.known:
            return self.known[token]
        found = self.lexicon.find(plain(token))
        if len(self.known) + len(self.misses) >= self.keep:
            self.known.clear()
            self.misses.clear()
        if found:
            self.known[token] = found
        else:
            self.misses.add(token)
        return found

    def features(self, text: str | None) -> list[float]:
        """log(1 + evidence) of plain exact, plain near, and quoted hits; and of exact ones per 100
        different words. Each different word counts once, so repetition changes nothing; it is
        quoted only if it is at every place."""
        low = (text or "").lower()
        tokens = set(low.split())
        hits = {token: found for token in tokens - self.misses if (found := self.look(token))}
        words: dict[str, tuple] = {}
        if hits:
            for m in re.finditer(r"\S+", low):
                token = m.group()
                if token in hits:
                    word = plain(token)
                    if word not in words or words[word][1]:
                        at = m.start() + len(token) - len(token.lstrip(EDGE))
                        words[word] = (hits[token], quoted(low, at))
        exact = near = quote = 0.0
        for _, ((weight, as_written), in_quotes) in sorted(words.items()):
            if in_quotes:
                quote += weight
            elif as_written:
                exact += weight
            else:
                near += weight
        return [math.log1p(exact), math.log1p(near), math.log1p(quote), math.log1p(100 * exact / max(1, len(tokens)))]


def _signatures(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, toxic, text) with ``s0`` to ``s2``, each the smallest hash of the text's three-word runs."""
    for ids, labels, texts in batches(it, ["id", "toxic", "text"], SLICE_CHARS):
        least = []
        for text in texts:
            w = (text or "").lower().split()
            runs = {" ".join(w[i:i + 3]).encode("utf-8", "surrogatepass") for i in range(max(1, len(w) - 2))}
            least.append([min(zlib.crc32(r, seed) for r in runs) for seed in (1, 2, 3)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.string()), pa.array(labels, pa.int32()), pa.array(texts, pa.string()),
             *(pa.array([x[k] for x in least], pa.int64()) for k in range(3))], names=["id", "toxic", "text", "s0", "s1", "s2"])


def _without_copies(rows: DataFrame) -> DataFrame:
    """Of rows that share a signature, the one of smallest id: copies of a document would make all
    its words look telling."""
    rows = materialize(rows.mapInArrow(_signatures, "id string, toxic int, text string, s0 long, s1 long, s2 long"))
    left = rows.select("id", "s0", "s1", "s2")
    for s in ("s0", "s1", "s2"):
        left = left.join(left.groupBy(s).agg(F.min("id").alias("id")).select("id"), "id", "left_semi")
    return rows.join(left.select("id"), "id", "left_semi")


def _count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(fold, toxic, text) to (term, pos0, neg0, pos1, ...): documents per term and fold, added up
    within the task."""
    found = [Counter() for _ in range(2 * FOLDS)]
    for folds, labels, texts in batches(it, ["fold", "toxic", "text"], SLICE_CHARS):
        for fold, label, text in zip(folds, labels, texts):
            words = {plain(t) for t in set((text or "").lower().split())}
            stems = {w[:k] + "*" for w in words for k in STEMS if k < len(w)}
            found[2 * fold + (0 if label else 1)].update(words | stems)
    terms = sorted(set().union(*found))
    for at in range(0, len(terms), 50_000):
        t = terms[at:at + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(t, pa.string()), *(pa.array([c[x] for x in t], pa.int64()) for c in found)], names=["term", *COUNTS])


#: Columns of ``_count``: documents of each fold, toxic and clean.
COUNTS = [f"{c}{f}" for f in range(FOLDS) for c in ("pos", "neg")]


def _near_words(lexicons: list[Lexicon], folds: list[list[int]]):
    """(fold, toxic, text) to (lexicon, term, pos, neg) of the spellings that match a term of a lexicon by
    one edit only, in the folds the lexicon was learned from."""

    # what no lexicon has near it, all of them together have not: most words are looked up once
    every = Lexicon({t: w for x in lexicons for t, w in x.words.items()}, {t: w for x in lexicons for t, w in x.stems.items()})

    def spellings(word: str) -> list[tuple[int, str]]:
        if every.find(word) is None:
            return []
        found = [(k, x, x.find(word)) for k, x in enumerate(lexicons)]
        return [(k, spelling) for k, x, hit in found if hit and not hit[1] for spelling, _ in x.near(word)]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for numbers, labels, texts in batches(it, ["fold", "toxic", "text"], SLICE_CHARS):
            counts = {y: Counter() for y in (True, False)}
            for fold, label, text in zip(numbers, labels, texts):
                hits = set()
                for token in set((text or "").lower().split()):
                    if token not in known:
                        if len(known) >= 300_000:
                            known.clear()
                        known[token] = spellings(plain(token))
                    hits.update(known[token])
                counts[bool(label)].update((k, spelling) for k, spelling in hits if fold in folds[k])
            both = sorted(set(counts[True]) | set(counts[False]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in both], pa.int32()), pa.array([t for _, t in both], pa.string()),
                 *(pa.array([counts[y][x] for x in both], pa.int64()) for y in (True, False))], names=["lexicon", "term", "pos", "neg"])

    return run


def _features(lexicons: list[Lexicon]):
    """Each row's features by the lexicon that did not learn from its fold."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = [Finder(x) for x in lexicons]
        for folds, labels, texts in batches(it, ["fold", "toxic", "text"], SLICE_CHARS):
            rows = [finders[f].features(t) for f, t in zip(folds, texts)]
            yield pa.RecordBatch.from_arrays([pa.array([int(bool(x)) for x in labels], pa.int64()), pa.array(rows, pa.list_(pa.float64()))],
                                             names=["toxic", "x"])

    return run


def innocent(pos, neg):
    """Whether too few of a spelling's documents are toxic for it to be a misspelt term. One clean,
    quoting or mislabelled document among many toxic ones does not bar it."""
    return pos < SHARE_LIMIT * (pos + neg)


def words_under(stems: dict[str, float], terms: list[str]) -> dict[str, float]:
    """The words among ``terms`` that begin with a stem, with its weight: what they weigh as they are
    written, and whole words to compare misspelt ones with."""
    out = {}
    for t in terms:
        stem = next((t[:k] for k in STEMS if t[:k] in stems), None)
        if stem and not t.endswith("*"):
            out[t] = stems[stem]
    return out


def _at_least(pos: int, n: int, share: float) -> float:
    """The chance that ``pos`` or more of ``n`` documents are toxic, if each is by ``share``."""
    total, log_in, log_out = 0.0, math.log(share), math.log1p(-share)
    for x in range(pos, n + 1):
        p = math.exp(math.lgamma(n + 1) - math.lgamma(x + 1) - math.lgamma(n - x + 1) + x * log_in + (n - x) * log_out)
        total += p
        if p <= 1e-12 * total:
            break
    return total


def telling(cells: dict[tuple[int, int], int], n_pos: int, n_neg: int) -> dict[tuple[int, int], float]:
    """From the number of terms by (toxic, clean) documents, the weights of those worth keeping: the
    smoothed log-odds less one standard error. Of all terms with as many documents and at least as
    many toxic ones, chance would have given a ``CHANCE`` part at most."""
    if not n_pos or not n_neg:
        return {}
    by_size: dict[int, list[tuple[int, int]]] = {}
    for (pos, neg), terms in cells.items():
        by_size.setdefault(pos + neg, []).append((pos, terms))
    out = {}
    for n, found in by_size.items():
        all_terms, seen = sum(t for _, t in found), 0
        for pos, terms in sorted(found, reverse=True):
            seen, neg = seen + terms, n - pos
            odds = math.log((pos + 0.5) / (n_pos + 1)) - math.log((neg + 0.5) / (n_neg + 1))
            weight = odds - math.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))
            if weight <= LEAST_WEIGHT:
                break
            if all_terms * _at_least(pos, n, n_pos / (n_pos + n_neg)) <= CHANCE * seen:
                out[pos, neg] = weight
    return out


def choose_terms(found: dict[str, tuple[float, int]]) -> tuple[dict, dict]:
    """Words and stems (given with a star) of telling terms with their weights and toxic documents. A
    stem must say more than its best word, and a term under a kept stem is left to it."""
    order = sorted(found, key=lambda t: (len(t), t))
    best = Counter()
    for t in order:
        if not t.endswith("*"):
            for k in STEMS:
                best[t[:k] + "*"] = max(best[t[:k] + "*"], found[t][1])
    stems: dict[str, float] = {}
    for t in order:
        if t.endswith("*") and found[t][1] >= 1.3 * best[t] and not any(t[:k] in stems for k in STEMS if k < len(t) - 1):
            stems[t[:-1]] = found[t][0]
    words = {t: found[t][0] for t in order if not t.endswith("*") and not any(t[:k] in stems for k in STEMS)}
    return words, stems


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Logistic regression by Newton steps, pulled toward ``PRIOR``; the last coefficient is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    prior = np.append(PRIOR, np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    beta, pull = prior.copy(), np.full(x.shape[1], ridge)
    pull[-1] = 1e-3
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (y - p) - pull * (beta - prior))
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    # what a hit adds is never negative, and a misspelt term says something wherever it occurs
    beta[:-1] = np.maximum(beta[:-1], 0)
    beta[1] = max(beta[1], 0.5 * beta[0])
    return beta


class Model:
    def __init__(self, lexicon: Lexicon, beta: list[float] | None):
        self.lexicon, self.beta = lexicon, beta

    def score(self, features: list[float]) -> float:
        if self.beta is None:
            return 0.0
        z = self.beta[-1] + sum(b * f for b, f in zip(self.beta, features))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_labelled: int = MAX_LABELLED) -> Model:
    """Fit on at most ``max_labelled`` labelled rows, those of smallest hash of the id. Rows
    labelled more than once count as toxic if any label says so; null labels and ids are left
    out. Without toxic or without clean rows the model scores 0. A sample too small for any term
    to tell more than chance gives every text the share of toxic rows."""
    spark = docs.sparkSession
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(
        F.max(F.col(label_col).cast("int")).alias("toxic"))
    sample = known.withColumn("__h", F.xxhash64("__id")).orderBy("__h", "__id").limit(max_labelled)
    # max_labelled rows of two numbers at most
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "__id")
    rows = _without_copies(rows.select(F.col("__id").cast("string").alias("id"), "toxic", "text"))
    rows = materialize(rows.select("toxic", "text", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(FOLDS)).cast("int").alias("fold")))
    sizes = {(r["fold"], int(bool(r["toxic"]))): r["count"] for r in rows.groupBy("fold", "toxic").count().collect()}
    counts = rows.mapInArrow(_count, "term string, " + ", ".join(f"{c} long" for c in COUNTS)).filter("term <> ''")
    counts = materialize(counts.groupBy("term").agg(*[F.sum(c).alias(c) for c in COUNTS]))

    def learn(folds: list[int]) -> Lexicon:
        n_pos, n_neg = (sum(sizes.get((f, y), 0) for f in folds) for y in (1, 0))
        pos, neg = (sum((F.col(f"{c}{f}") for f in folds), F.lit(0)) for c in ("pos", "neg"))
        mine = counts.select("term", F.col("term").endswith("*").alias("stem"), pos.alias("pos"), neg.alias("neg")).filter("pos > 0 or neg > 0")
        # pairs of counts, and the terms that chance does not explain: bounded as the sample is
        cells = {False: {}, True: {}}
        for r in mine.groupBy("stem", "pos", "neg").count().collect():
            cells[r["stem"]][r["pos"], r["neg"]] = r["count"]
        keep = [(stem, p, n, w) for stem in cells for (p, n), w in telling(cells[stem], n_pos, n_neg).items()]
        if not keep:
            return Lexicon({}, {})
        kept = spark.createDataFrame(keep, "stem boolean, pos long, neg long, weight double")
        found = {r["term"]: (r["weight"], r["pos"]) for r in mine.join(F.broadcast(kept), ["stem", "pos", "neg"]).collect()}
        words, stems = choose_terms(found)
        return Lexicon(words | words_under(stems, sorted(found)), stems)

    if not all(sum(sizes.get((f, y), 0) for f in range(FOLDS)) for y in (0, 1)):
        return Model(Lexicon({}, {}), None)
    groups = [[f for f in range(FOLDS) if f != out] for out in range(FOLDS)] + [list(range(FOLDS))]
    lexicons = [learn(folds) for folds in groups]
    seen = rows.mapInArrow(_near_words(lexicons, groups), "lexicon int, term string, pos long, neg long").groupBy("lexicon", "term").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # spellings that happen to be one edit from a term, clean by share; bounded as the sample is
    for r in seen.filter(innocent(F.col("pos"), F.col("neg"))).select("lexicon", "term").collect():
        lexicons[r["lexicon"]].innocent.add(r["term"])
    fit = rows.mapInArrow(_features(lexicons), "toxic long, x array<double>").collect()  # max_labelled rows of five numbers at most
    beta = _fit(np.array([r[1] for r in fit], float), np.array([r[0] for r in fit], float))
    return Model(lexicons[-1], beta.tolist())


def _score(model: Model, text_col: str):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(model.lexicon)
        for batch in it:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            scores = [model.score(finder.features(t)) for t in texts]
            rest = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n != text_col]
            yield pa.RecordBatch.from_arrays([*(c for _, c in rest), pa.array(scores, pa.float64())],
                                             names=[*(n for n, _ in rest), "__score"])

    return run


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` and ``__score`` (in place of
    a column of that name) in 0 to 1. Null and empty
    texts score what a text without hits does. One pass without a shuffle; nothing but the text
    is looked at, and no rows give no rows."""
    docs = docs.drop("__score")
    text = free_name(docs, "__text")
    kept = docs.select(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)], F.col(text_col).alias(text))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != text)
    return kept.mapInArrow(_score(model, text), f"{schema}, __score double")


def fit_tables(spark: SparkSession, sf_dir: str) -> Model:
    """The model of the query and the pipeline: labels of rows that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out(F.col("doc_id"), 0))
    return train(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score(spark.read.parquet(f"{sf_dir}/documents.parquet"), fit_tables(spark, sf_dir), keep=["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id"), 0).alias("held_out"), F.col("__score").alias("score"),
                      (F.col("__score") >= 0.5).cast("int").alias("predicted"))
