"""Property tests: masking idempotence, keep-first uniqueness, tokenizer parity."""

from hypothesis import given, settings
from hypothesis import strategies as st

from shoplens.functions import masking
from shoplens.functions.text import query_tokens, tokens
from shoplens.operators.dedup import keep_first

texts = st.text(alphabet=st.sampled_from(list("0123456789*-+ ab小米")), max_size=30)


def _longest_digit_run(s: str) -> int:
    import re
    return max((len(m) for m in re.findall(r"[0-9]+", s)), default=0)


# Re-masking only changes a digit run of 18+ characters (the masked group's
# last four digits join the leftover digits), exactly like the reference's
# replaceAll with the same pattern; phone-like runs (<= 17 digits) are stable.
phone_like = texts.filter(lambda s: _longest_digit_run(s) <= 17)


@settings(max_examples=25, deadline=None)
@given(st.lists(phone_like, min_size=1, max_size=20))
def test_phone_mask_idempotent(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    once = df.select(masking.mask_phone("v").alias("v"))
    twice = once.select(masking.mask_phone("v").alias("v"))
    assert [r.v for r in once.collect()] == [r.v for r in twice.collect()]
    # names: idempotent once non-empty; '' masks to '**' and then '***',
    # exactly as first-character-plus-'**' does in the reference
    n1 = df.select(masking.mask_name("v").alias("v"))
    n2 = n1.select(masking.mask_name("v").alias("v"))
    for src, a, b in zip(values, [r.v for r in n1.collect()], [r.v for r in n2.collect()]):
        assert b == (a if src else "***")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 50), st.integers(0, 1000)),
                min_size=1, max_size=60))
def test_keep_first_one_row_per_key_and_minimal(spark, rows):
    df = spark.createDataFrame(rows, "k int, ts int, id int")
    out = keep_first(df, ["k"], ["ts", "id"]).collect()
    assert len(out) == len({r[0] for r in rows})
    for r in out:
        assert (r.ts, r.id) == min((t, i) for k, t, i in rows if k == r.k)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("abcXYZ 12,.-小米手机")), max_size=20),
                min_size=1, max_size=10))
def test_tokenizer_spark_equals_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [list(r.t) for r in df.select(tokens("v").alias("t")).collect()]
    for v, t in zip(values, got):
        assert list(dict.fromkeys(t)) == query_tokens(v)


def test_long_digit_run_masks_again_like_the_reference(spark):
    df = spark.createDataFrame([("0" * 18,)], "v string")
    once = df.select(masking.mask_phone("v").alias("v"))
    twice = once.select(masking.mask_phone("v").alias("v"))
    assert once.first().v == "000****0000" + "0" * 7
    assert twice.first().v == "000****" + "000****0000"


_EVENTS = st.lists(st.tuples(st.sampled_from(["m1", "m2"]),
                             st.one_of(st.none(), st.sampled_from(["u1", "u2", "u3", "u4"])),
                             st.sampled_from(["coupon", "coupon", "clickItem", "addCart"]),
                             st.integers(0, 3600)),
                   min_size=1, max_size=40)


def _brute_force_windows(rows, length_s, slide_s):
    """Every (device, window start) a sliding window assigns an event to."""
    out = {}
    for mid, uid, name, t in rows:
        first = (t // slide_s) * slide_s - length_s + slide_s
        for start in range(first, t + 1, slide_s):
            if start <= t < start + length_s:
                w = out.setdefault((mid, start), {"accounts": set(), "n": 0, "clicked": False})
                w["n"] += 1
                if name == "coupon" and uid is not None:
                    w["accounts"].add(uid)
                if name == "clickItem":
                    w["clicked"] = True
    return out


@settings(max_examples=12, deadline=None)
@given(_EVENTS)
def test_sliding_alerts_equal_brute_force(spark, rows):
    import datetime as dt
    from shoplens.operators import alerts
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [(m, u, n, t0 + dt.timedelta(seconds=t)) for m, u, n, t in rows],
        "mid string, uid string, eventId string, event_time timestamp_ntz")
    panes = alerts.pane_table(df, "2 minutes")
    want = _brute_force_windows(rows, 600, 120)
    got = {(r.mid, int((r.window_start - t0).total_seconds())): r
           for r in alerts.alert_windows(panes, "10 minutes", "2 minutes").collect()}
    assert set(got) == set(want)
    for key, w in want.items():
        r = got[key]
        assert (r.coupon_accounts, r.n_events, r.clicked) == (len(w["accounts"]), w["n"], w["clicked"])
    alerting = {k for k, w in want.items() if len(w["accounts"]) >= 2 and not w["clicked"]}
    got_alerts = {(r.mid, int((r.window_start - t0).total_seconds())): r.n_events
                  for r in alerts.coupon_alerts(panes, "10 minutes", "2 minutes", 2).collect()}
    assert set(got_alerts) == alerting
    assert all(got_alerts[k] == want[k]["n"] for k in alerting)
