import re

from llm_fixtures import make  # noqa: F401
from shoplens.llm import decontaminate as D

ITEM = " ".join(f"w{i}" for i in range(20))


def brute(rows, items, span=13):
    cut = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
    wins = {}
    for i, t in items:
        w = cut(t)
        if w:
            n = min(span, len(w))
            for a in range(len(w) - n + 1):
                wins.setdefault(tuple(w[a:a + n]), set()).add(i)
    out = []
    for i, t in rows:
        w, hit, ids = cut(t), set(), set()
        for n in {len(k) for k in wins}:
            for a in range(len(w) - n + 1):
                k = tuple(w[a:a + n])
                if k in wins:
                    hit.update(range(a, a + n))
                    ids |= wins[k]
        out.append((i, len(w), len(hit), sorted(str(x) for x in ids if x is not None)))
    return out


def check(spark, make, rows, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in D.decontaminate(make(rows), bench).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(brute(rows, items), key=key)
    return got


def test_hard_rows(spark, make):
    words = ITEM.split()
    rows = [
        (1, ITEM), (2, "pre " + " ".join(words[3:16]) + " post"), (3, "pre " + " ".join(words[3:15]) + " post"), (4, None), (5, ""),
        (6, ITEM.upper() + "\n" + ITEM), (7, "it's a tiny item here"), (8, "tiny tiny item"), (9, "ITEM, tiny; item tiny"),
        (10, "a " * 400), (11, ("filler " * 3000) + " ".join(words[:13])), (12, ITEM), (12, ITEM), (None, ITEM), (13, "é " + ITEM.replace("w5", "W5")),
        (14, " ".join(words[:13]) + " x " + " ".join(words[7:])), (15, "...")]
    items = [(1, ITEM), (2, "tiny item"), (3, None), (4, ""), (5, "..."), (6, "a " * 13), (7, "a " * 30), (8, "tiny item"), (10, "one")]
    check(spark, make, rows, items)


def test_empty_tables(spark, make):
    assert check(spark, make, [], [(1, ITEM)]) == []
    check(spark, make, [(1, ITEM)], [])


def test_spans_run_together(spark, make):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    (row,) = D.decontaminate(make([(1, "x " + ITEM + " y")]), bench).collect()
    assert [tuple(s) for s in row.spans] == [(1, 21)]


def test_no_python_in_the_plan(spark, make):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    plan = D.decontaminate(make([(1, ITEM)]), bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
