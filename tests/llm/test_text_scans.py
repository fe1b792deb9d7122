"""Operators 4, 5 and 8."""

import pickle
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from llm_fixtures import make  # noqa: F401
from shoplens.llm import pii as P
from shoplens.llm import secrets as S
from shoplens.llm import toxicity as T

BASE = [("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24)]


def brute_spans(text):
    spans = [(m.start(), i, kind, m.end()) for i, (kind, p, ok) in enumerate(BASE) for m in re.finditer(p, text or "") if ok(m)]
    return [(k, a, b) for a, _, k, b in sorted(spans)]


SECRET_ROWS = [
    (1, 'password="abcdef" x token = abc secret=token:abcdefgh PASSWD:qwerty12'), (2, "AKIA" + "A" * 16 + " AKIAAKIA" + "B" * 12 + " AKIA123"),
    (3, "é😀 " + "0f" * 12 + " " + "a" * 23 + "\n" + "deadbeef" * 5), (4, None), (5, ""), (6, "api_key: 1" + "f" * 40), (7, "apikey='" + "k" * 6 + "'" * 3),
    (8, "token=" + "z" * 100_000), (9, "secret = short\n" * 400 + "secret=longer1\n" * 400), (3, "ab" * 12), (None, "AKIA" + "Z" * 20),
    (10, "look at Xq7ZpL0vR2mWk9TnB4sYc and at internationalization_of_identifiers here")]


@pytest.fixture(scope="module")
def table(spark):
    return S.fit(S.labelled_samples(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))


def test_base_spans(make, table):
    rows = S.scan(make(SECRET_ROWS), table).collect()
    got = sorted((str(r.doc_id), [(s.kind, s.start, s.end) for s in r.base]) for r in rows)
    assert got == sorted((str(i), brute_spans(t)) for i, t in SECRET_ROWS)
    added = {r.doc_id: [(s.start, s.end) for s in r.added] for r in rows}
    assert added[10] == [(8, 29)]  # the random string, not the long identifier
    for r in rows:
        assert not any(a.start < b.end and b.start < a.end for a in r.added for b in r.base)


def test_texts_of_many_candidates_take_time_in_proportion(make, table):
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    words = ["".join(rng.choices(letters, k=20)) for _ in range(50_000)]
    mixed = " ".join(f"token={w}" if i % 3 == 0 else w for i, w in enumerate(words[:30_000]))
    rows = [(1, " ".join(words)), (2, mixed), (3, "".join(rng.choices(letters, k=1_000_000)))]
    S.scan(make(rows[:0] + [(0, "warm")]), table).collect()
    began = time.monotonic()
    got = {r.doc_id: r for r in S.scan(make(rows[:1]), table).collect()}
    assert time.monotonic() - began < 20  # the machine may be shared; quadratic work took hours
    got.update({r.doc_id: r for r in S.scan(make(rows[1:]), table).collect()})
    assert got[1].base == [] and len(got[1].added) > 49_000
    assert all((s.start % 21, s.end - s.start) == (0, 20) for s in got[1].added)
    assert [(s.kind, s.start, s.end) for s in got[2].base] == brute_spans(mixed)
    plain = {m.start() for m in re.finditer(r"(?<![=A-Za-z0-9])[A-Za-z0-9]{20}", mixed)}
    assert {s.start for s in got[2].added} <= plain and len(got[2].added) > 0.97 * len(plain)
    assert [(s.start, s.end) for s in got[3].added] == [(0, 1_000_000)]


def test_ratio_is_the_sum_over_pairs(spark, table):
    rows = [("a",), ("ab",), ("zQ7~é x",), ("Xq7ZpL0vR2mWk9TnB4sYc",), ("",)]

    def brute(word):
        codes = [max(0, min(S.WIDTH - 1, ord(c) - S.LOW)) for c in word]
        return sum(table[a * S.WIDTH + b] for a, b in zip(codes, codes[1:]))

    ratios = F.split(F.lit(",".join(map(str, table))), ",").cast("array<double>")
    for r in spark.createDataFrame(rows, "word string").select("word", S.ratio(F.col("word"), ratios).alias("got")).collect():
        assert abs(r.got - brute(r.word)) < 1e-9


def test_markov_models_tell_held_out_samples_apart(spark, table):
    rng = random.Random(4)
    alphabet = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    rows = [("".join(rng.choice(alphabet) for _ in range(24)), True) for _ in range(300)]
    words = {w for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("lang = 'en'").select("text").limit(400).collect()
             for w in re.findall("[A-Za-z0-9+/_=-]{16,}", r.text) if not brute_spans("token=" + w)[1:] and w.isalpha()}
    rows += [(w, False) for w in sorted(words)[:300]]
    ratios = F.lit(",".join(map(str, table)))
    out = spark.createDataFrame(rows, "word string, random boolean").select(
        "random", (S.ratio(F.col("word"), F.split(ratios, ",").cast("array<double>")) >= S.MIN_RATIO).alias("found")).collect()
    assert sum(r.found for r in out if r.random) >= 290
    assert sum(r.found for r in out if not r.random) == 0


def test_secrets_of_an_empty_table(make, table):
    assert S.scan(make([]), table).collect() == []
    assert len(S.fit(S.labelled_samples(make([])))) == S.WIDTH ** 2


PII_ROWS = [
    (1, "Mrs Anna Novak wrote to a.b@x.com and A.B@X.com. Mrs Novak called +1 (988) 555-2485 or +1-988-555-2485."),
    (2, "card 4111 1111 1111 1111 and 4111111111111111, ip 42.144.35.254, ssn 123-45-6789"), (3, None), (4, ""), (5, "nothing here"),
    (6, "г-жа Анна Петрова and Herr Paul MÜLLER"), (7, "x 1.2.3.4 " * 5000), (7, "x 1.2.3.4 " * 5000), (None, "b.c@x.com"), (8, "1.2.3.4.5 999.1.1.1 12345")]


def pii(make, rows, key="k"):
    return {(r.doc_id, i): r for i, r in enumerate(sorted(P.pseudonymize(make(rows), key).collect(), key=lambda r: (str(r.doc_id), r.text or "")))}


def test_surrogates(make):
    out = {k[0]: r for k, r in pii(make, PII_ROWS).items()}
    by = {i: [tuple(e) for e in r.entities] for i, r in out.items()}
    one = dict((m, s) for _, m, s in by[1])
    assert one["a.b@x.com"] == one["A.B@X.com"] and one["Mrs Anna Novak"].split()[-1] == one["Mrs Novak"].split()[-1]
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", one["+1 (988) 555-2485"])
    assert re.sub(r"\D", "", one["+1 (988) 555-2485"]) == re.sub(r"\D", "", one["+1-988-555-2485"])
    assert one["Mrs Anna Novak"].split()[1] in P.GIVEN["latin"]["f"]
    two = dict((m, s) for _, m, s in by[2])
    digits = two["4111111111111111"]
    assert two["4111 1111 1111 1111"].replace(" ", "") == digits != "4111111111111111"
    luhn = sum(int(d) if i % 2 else (2 * int(d) - 9 * (int(d) > 4)) for i, d in enumerate(digits))
    assert luhn % 10 == 0
    assert re.fullmatch("[А-Яа-я -]+", by[6][0][2]) and by[6][1][2].split()[-1].isupper()
    assert out[3].text is None and out[4].text == "" and out[5].text == "nothing here" and by[8] == []
    assert [e[1] for e in by[None]] == ["b.c@x.com"]
    for r in out.values():  # the text is the old one with the matches exchanged
        if r.text is not None:
            old = next(t for i, t in PII_ROWS if i == r.doc_id)
            for e in r.entities:
                old = old.replace(e.match, e.replacement, 1) if e.kind != "ip" else old
            if not any(e.kind == "ip" for e in r.entities):
                assert r.text == old
    assert pii(make, PII_ROWS).keys() == pii(make, PII_ROWS).keys()
    assert [r.text for r in pii(make, PII_ROWS).values()] == [r.text for r in pii(make, PII_ROWS).values()]
    assert out[1].text != {k[0]: r for k, r in pii(make, PII_ROWS, "other").items()}[1].text


def test_distinct_units_stay_distinct(make):
    """More given names and one-letter mailboxes than there are short surrogates."""
    letters = [f"{a}@{b}.com" for a in "abcdefghijklmnopqrstuvwxyz0123456789" for b in ("q", "w")]
    names = [f"Mr {a}{b} Stone" for a in "ABCDEFGH" for b in ("ab", "eb", "ib", "ob")]
    out = pii(make, [(1, " , ".join(letters)), (2, " , ".join(names))]).values()
    for r in out:
        matches, new = [e.match for e in r.entities], [e.replacement for e in r.entities]
        assert len(set(new)) == len(set(matches)) == len(matches)
        assert not set(new) & set(matches)


def test_pii_of_an_empty_table(make):
    assert P.pseudonymize(make([]), "k").collect() == []


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_finds_what_is_one_edit_away():
    rng = random.Random(2)
    terms = {"".join(rng.choice("abcde") for _ in range(rng.randrange(5, 9))): float(i) for i in range(60)}
    lexicon = T.Lexicon(terms, {})
    for _ in range(4000):
        word = list(rng.choice(list(terms)))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(word))
            word[at:at + rng.randrange(3)] = rng.choice(["", "x", "ab"])
            word = word or ["a"]
        word = "".join(word)
        assert sorted(lexicon.near(word)) == sorted((word, weight) for t, weight in terms.items() if distance(word, t) <= 1)


def test_no_near_term_is_missed_by_the_look_at_rests():
    """Short and long words and stems: what ``near`` gives is what the automaton run for every word gives."""
    rng = random.Random(3)

    def letters(a, b, of="abcde"):
        return "".join(rng.choice(of) for _ in range(rng.randint(a, b)))

    for _ in range(10):
        words = {letters(1, 9): 1.0 for _ in range(60)} | {letters(T.LONG_TERM - 2, T.LONG_TERM + 9, "ab"): 2.0 for _ in range(4)}
        stems = {letters(4, 9): 3.0 for _ in range(25)}
        lexicon = pickle.loads(pickle.dumps(T.Lexicon(words, stems)))
        asked = [letters(1, 14) for _ in range(1000)]
        for term in [*words, *stems]:
            at = rng.randrange(len(term) + 1)
            for rest in (term[at:], "z" + term[at:], term[at + 1:], "q" + term[at + 1:]):
                asked += [term[:at] + rest, term[:at] + rest + "tail"]
        found = [sorted(lexicon.near(word)) for word in asked]
        assert found == [sorted(lexicon._walk(word)) if len(word) >= T.FUZZY_LENGTH - 1 else [] for word in asked]
        assert any(found) and not all(found)


def test_quotation():
    assert T.quoted('he said "you idiot" to them', 13) and T.quoted("they were called an idiot", 20)
    assert not T.quoted("you idiot", 4) and not T.quoted('"fine" you idiot', 11)


def test_plain():
    assert [T.plain(x) for x in ("stupid,", "st0pid***", "1d1ot", "1999", "", "$$$", "(Trash)")] == ["stupid", "stopid", "idiot", "", "", "", "Trash"]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = T.op8_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.toxic for r in out) / len(out) >= 0.97
    assert all(0 <= r.score <= 1 for r in out)


@pytest.mark.parametrize("sf,share", [("sf0.001", 0.5), ("sf0.01", 0.6), ("sf0.1", 0.9)])
def test_toxic_documents_are_found_at_every_size(spark, sf, share):
    """Of all labelled rows. In the smaller tables a third of the toxic documents hold only words of
    languages with a handful of examples, too few to learn from; clean documents stay clean."""
    sf = f"/root/testdata/{sf}"
    out = T.op8_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    toxic, clean = ([r.predicted for r in out if r.toxic == y] for y in (1, 0))
    assert sum(toxic) >= share * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_chance_terms_are_not_telling():
    # 400 terms in three documents of which a tenth is toxic: chance gives 0.4 with three toxic ones
    cells = {(0, 3): 290, (1, 2): 100, (2, 1): 9, (3, 0): 1}
    assert T.telling(cells, 10, 90) == {}
    assert set(T.telling(cells | {(3, 0): 8}, 10, 90)) == {(3, 0)}
    assert T.telling({(9, 0): 1, (0, 1): 500}, 10, 90) and T.telling(cells, 0, 90) == T.telling(cells, 10, 0) == {}
    assert abs(T._at_least(3, 5, 0.3) - (10 * 0.3 ** 3 * 0.7 ** 2 + 5 * 0.3 ** 4 * 0.7 + 0.3 ** 5)) < 1e-12


def test_hard_rows(spark, make):
    bad = "you are an idiot and a moron, worthless trash"
    rng = random.Random(9)

    def prose():
        return [f"word{rng.randrange(3000)}" for _ in range(40)]

    rows = []
    for i in range(160):
        w = prose()
        if i < 80:
            for insult in rng.sample(["idiot", "moron", "worthless", "trash"], 3):
                w.insert(rng.randrange(len(w)), insult)
        rows.append((i if i < 80 else 100 + i, " ".join(w)))
    labels = spark.createDataFrame([(i, 1 if i < 100 else 0) for i, _ in rows] + [(None, 1), (5, 0), (7, None)], "doc_id long, toxic int")
    model = T.train(make(rows), labels)
    docs = [(1, None), (2, ""), (3, "an 1d1ot"), (4, "what an idiott and morron"), (5, bad * 5000), (None, bad), (6, "sea " * 60_000)]
    got = {r.doc_id: r["__score"] for r in T.score(make(docs), model).collect()}
    assert got[1] == got[2] == got[6] < 0.5 < got[5]
    assert got[4] > got[2] and got[3] > got[2] and got[None] > 0.5
    assert T.score(make([]), model).collect() == []
    assert T.train(make([]), labels).beta is None


def test_misspelt_stems_and_four_letter_terms():
    lexicon = T.Lexicon({"scum": 3.0} | T.words_under({"idiot": 4.0}, ["idiots", "idiotic", "idiom", "idioti*"]), {"idiot": 4.0}, {"sum", "idio*", "idiom*"})
    assert set(lexicon.words) == {"scum", "idiots", "idiotic"}
    for word in ("iddiot", "ibiot", "iddiots", "idotic", "idiiotically", "diots"):
        assert lexicon.find(word) == (4.0, False), word
    assert lexicon.find("idiotically") == (4.0, True)
    assert lexicon.find("scumm") == lexicon.find("skum") == lexicon.find("scu") == (3.0, False)
    assert lexicon.find("sum") is lexicon.find("ideas") is lexicon.find("patriot") is lexicon.find("idiom") is None


def test_each_place_of_a_word_is_judged():
    features = T.Finder(T.Lexicon({"idiot": 4.0}, {})).features
    once = features("you are an idiot , really")
    assert once[0] > 0 == once[2]
    for text in ('he said "idiot" to me\nyou are an idiot', "he said idiot to me. and so on, you idiot", '"idiot," he said\nyou idiot!',
                 'she called: idiotproof it is\nyou idiot'):
        assert features(text)[:3] == once[:3], text
    for text in ('he said "idiot" twice', 'the "idiot" and\nthe "idiot" again'):
        got = features(text)
        assert got[0] == 0 < got[2], text


def test_words_without_a_match_are_looked_up_once(monkeypatch):
    lexicon = T.Lexicon({"idiot": 4.0, "scum": 3.0}, {"moron": 2.0}, {"sum"})
    texts = ["you idiot , the sum is scumm", "the moronic sum is it", "idiot idiot it is", "", None, "the sum of it is moronn"]
    want = [T.Finder(lexicon).features(t) for t in texts]
    for keep in (1, 3, 300_000):  # whenever the finder forgets
        finder = T.Finder(lexicon, keep)
        assert [finder.features(t) for t in texts + texts] == want + want
    finder, asked = T.Finder(lexicon), []
    look = finder.look
    monkeypatch.setattr(finder, "look", lambda token: asked.append(token) or look(token))
    finder.features("the sum of it")
    assert sorted(asked) == ["it", "of", "sum", "the"]
    finder.features("the sum of it and the idiot")
    assert sorted(asked[4:]) == ["and", "idiot"]


def test_a_spelling_is_barred_by_share():
    assert T.innocent(0, 1) and T.innocent(1, 1) and T.innocent(5, 4)
    assert not T.innocent(3, 0) and not T.innocent(30, 1)


def test_one_clean_document_does_not_bar_a_misspelling(spark, make):
    rng = random.Random(11)
    rows, marks = [], []
    for i in range(240):
        w = [f"word{rng.randrange(3000)}" for _ in range(40)]
        toxic = i < 120
        if toxic:
            w += ["moron", "morron"] if i % 8 == 0 else ["moron"]
        elif i == 200:
            w.append("morron")
        rows.append((i, " ".join(w)))
        marks.append((i, int(toxic)))
    model = T.train(make(rows), spark.createDataFrame(marks, "doc_id long, toxic int"))
    assert "morron" not in model.lexicon.innocent and model.lexicon.find("morron")


def test_rare_telling_terms_are_not_crowded_out(spark, make):
    """Frequent words of little weight do not take the place of a rare term."""
    rng = random.Random(12)
    rows, marks = [], []
    for i in range(400):
        toxic = i < 200
        w = [f"p{rng.randrange(10**6)}" for _ in range(30)]
        w += [f"com{c}" for c in "abcdefghijkl" if rng.random() < (0.9 if toxic else 0.3)]
        if toxic and i % 8 < 2:
            w.append("vermin")
        rows.append((i, " ".join(w)))
        marks.append((i, int(toxic)))
    model = T.train(make(rows), spark.createDataFrame(marks, "doc_id long, toxic int"))
    assert model.lexicon.find("vermin")
