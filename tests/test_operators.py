"""Decoding, reassembly, labels, snapshots, relations, metrics and files."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import content, payload
from tidemark.operators import features, ingest, labels, ranking, relations, scoring, similarity, snapshot
from tidemark.operators.decode import decode_payloads
from tidemark.operators.windows import DAY, HOUR
from tidemark.sources import files

# --- payloads ----------------------------------------------------------------------------


def test_packed_sample():
    assert payload.decode_text(bytes.fromhex("c7f79b0c6abee5eeb4fb0c1aa2cbf2743b0c02"), 0, "SS7") == ("Good Morning Cherima ", "gsm7")


def test_alphabet():
    assert len(payload.GSM_BASIC) == 128 and payload.GSM_BASIC[0x41] == "A" and payload.GSM_BASIC[0x7F] == "à"
    assert payload.gsm_text([0x1B, 0x65, 0x41, 0x1B]) == "€A�"


@pytest.mark.parametrize("raw,want", [("0500033902016869", (5, 0x39, 2, 1, None)), ("0608040102030168", (6, 0x0102, 3, 1, None)), ("06050404d20000aa", (6, None, None, None, 1234)), ("0404020a0b41", (4, None, None, None, 10)), ("0500033902", None), ("48656c6c6f", None), ("00", None), ("", None), ("0300034142", None)])
def test_headers(raw, want):
    h = payload.read_header(bytes.fromhex(raw))
    assert (None if h is None else (h.length, h.ref, h.total, h.part, h.port)) == want


@pytest.mark.parametrize("hexed,scheme,source,text,codec", [
    ("6869", 1, "SMPP", "hi", "ascii"), ("e9", 1, "SMPP", None, "ascii"), ("e9", 3, "SMPP", "é", "latin1"), ("e9", 241, "SMPP", "é", "gsm7"), ("00e9", 8, "SMPP", "é", "utf16"), ("00", 8, "SMPP", None, "utf16"), ("d800", 8, "SMPP", None, "utf16"),
    ("680a69", 0, "SMPP", "h i", "gsm7"), ("6869", 99, "SMPP", "hi", "ascii(auto)"), ("6869", None, "SMPP", "hi", "ascii(auto)"), ("", 0, "SMPP", None, None), ("e834", 1, "SS7", "hi", "gsm7(auto)"),
])
def test_schemes(hexed, scheme, source, text, codec):
    assert payload.decode_text(bytes.fromhex(hexed), scheme, source) == (text, codec)


def test_decode_frame(spark):
    rows = [("a", "68 69", 0, 1), ("b", None, 0, 1), ("c", "", 0, 1), ("d", "6", 0, 1), ("e", "zz", 0, 1), ("f", "050003390201 4869", -15, 1), ("g", "0048", None, 1)]
    got = {r["reference"]: r for r in decode_payloads(spark.createDataFrame(rows, "reference string, content string, dcs int, udh int"), "SMPP").collect()}
    assert [got[k]["text"] for k in "abcdef"] == ["hi", None, None, None, None, "Hi"]
    assert [got[k]["hex_invalid"] for k in "abcdef"] == [False, False, False, True, True, False]
    assert (got["f"]["udh"], got["f"]["udh_ref"], got["f"]["udh_total"], got["f"]["udh_part"]) == (True, 0x39, 2, 1)
    binary = decode_payloads(spark.createDataFrame([("a", "6869", 4)], "reference string, content string, dcs int"), "SS7").first()
    assert binary["text"] is None


def test_smpp_rows(spark):
    schema = "reference string, smpp_operation int, esm_class int, a_number string, b_number string, content string, dcs int, time_stamp string, sar_ref int, sar_msg_parts int, sar_msg_part int"
    rows = [("s", 4, 0, "A", "B", "6869", 0, "2026-03-01T10:00:00Z", None, None, None), ("r", 5, 4, "A", "B", "6869", 0, "x", None, None, None), ("n", 5, None, "", "B", "zz", 0, "2026-03-01 10:00:00.5", 7, 2, 1), ("a", 9, 0, "A", "B", "6869", 0, None, None, None, None)]
    got = {r["record_id"]: r for r in ingest.smpp_canonical(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {"s", "n"}
    assert got["s"]["sender_id"] == "SMPP|A" and got["s"]["timestamp"] == dt.datetime(2026, 3, 1, 10) and got["s"]["concat_total_parts"] == 1
    assert got["n"]["text"] == "" and got["n"]["text_decode_failed"] and got["n"]["originator"] is None and got["n"]["concat_ref"] == 7
    with pytest.raises(ValueError, match="content"):
        ingest.smpp_canonical(spark.createDataFrame(rows, schema).drop("content"))


def test_ss7_rows(spark):
    schema = "reference string, message_type int, a_number string, b_number string, content string, dcs int, imsi string, time_stamp long, sarref int, msg_part int, msg_parts int, vlr_address string, decision int"
    token = "".join(f"{b:02x}" for b in (lambda t: sum(ord(c) << 7 * i for i, c in enumerate(t)).to_bytes((7 * len(t) + 7) // 8, "little"))("(T2ZKaMjKhf4w)"))
    rows = [("q1", 1, None, None, None, None, "i", 10, None, None, None, "V1", None), ("q2", 1, None, None, None, None, "i", 20, None, None, None, "V2", None), ("q3", 1, None, None, None, None, "i", 30, None, None, None, "V3", 1), ("mt", 2, "A", "B", "e834", 0, "i", 15, 9, 1, 2, "x", None), ("mu", 2, "A", "B", "e834", 0, None, 15, 9, 1, 1, "x", None), ("mo", 3, "A", "B", token, 0, "i", 5, None, None, None, None, None), ("d", 4, "A", "B", "e834", 0, "i", 5, None, None, None, None, 2)]
    got = {r["record_id"]: r for r in ingest.ss7_canonical(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {"mt", "mu", "mo"}
    assert got["mt"]["vlr_address"] == "V2" and got["mu"]["vlr_address"] is None and got["mt"]["text"] == "hi"
    assert got["mt"]["concat_ref"] == 9 and got["mu"]["concat_ref"] is None
    assert got["mo"]["is_platform_token_message"] and got["mo"]["text"] == "" and not got["mo"]["text_decode_failed"]


def test_reassembly(spark):
    t = lambda s: dt.datetime(2026, 1, 1, 0, 0, s)
    schema = "record_id string, originator string, destination string, timestamp timestamp_ntz, text string, text_decode_failed boolean, concat_ref int, concat_total_parts int, concat_part_num int, extra string"
    rows = [("b", "o", "d", t(2), "World", False, 1, 2, 2, "hi"), ("a", "o", "d", t(5), "Hello ", True, 1, 2, 1, "lo"), ("c", "p", "d", t(1), "x", False, 1, 2, 1, "e"), ("s", "o", "d", t(1), None, False, None, 1, 1, "e"), ("s2", "o", "d", t(1), "y", False, None, 1, 1, "e"), ("n", None, None, t(1), None, False, 2, 1, 1, "e"), ("r1", "o", "d", t(1), "1", False, 3, 2, 1, "e"), ("r2", "o", "d", t(1), "2", False, 3, 2, 1, "e")]
    got = {r["record_id"]: r for r in ingest.reassemble(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {"a", "c", "s", "s2", "n", "r1"}
    a = got["a"]
    assert (a["text"], a["timestamp"], a["text_decode_failed"], a["message_part_count"], a["message_partial"], a["extra"]) == ("Hello World", t(2), True, 2, False, "lo")
    assert got["c"]["message_partial"] and got["r1"]["message_partial"] and not got["n"]["message_partial"] and got["s"]["text"] is None


def test_label_union(spark):
    rows = [("m", 1, True, False, None), ("m", 2, True, True, "spam"), ("m", 3, False, True, "x"), ("n", 1, False, None, "y"), ("o", 1, True, None, None)]
    got = {r["m"]: tuple(r)[1:] for r in ingest.reassemble_labels(spark.createDataFrame(rows, "m string, part int, rule_evaluated boolean, rule_flagged boolean, fraud_type string"), ["m"], "part").collect()}
    assert got == {"m": (True, True, "spam"), "n": (False, None, None), "o": (True, False, None)}


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d"), (3, "e")], "k int, v string")
    assert sorted(map(tuple, ingest.upsert(old, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "e")]
    timed = spark.createDataFrame([(3, "z", 1), (3, "b", 2)], "k int, v string, at int")
    assert ingest.upsert(old, timed, ["k"], ["at"]).where("k = 3").first()["v"] == "b"


# --- text --------------------------------------------------------------------------------

HITS = {
    "has_url": "see https://x", "has_shortlink": "go BIT.LY/x", "has_phone_number": "call 012-345 67890", "has_currency_symbol": "10 USD", "has_urgency_keyword": "act now", "has_prize_keyword": "you WON", "has_gambling_keyword": "casino!", "has_loan_keyword": "pre-approved", "has_otp_keyword": "your otp", "has_excessive_punctuation": "hi!?",
    "has_account_verification_keyword": "verify your account", "has_delivery_scam_keyword": "package is held", "has_crypto_investment_keyword": "bitcoin", "has_tax_authority_impersonation_keyword": "tax refund", "has_free_bonus_keyword": "free spins", "has_ewallet_transaction_keyword": "top up", "has_registration_cta_keyword": "daftar", "has_suspicious_tld": "promo-1.top/x",
    "has_known_malicious_domain": "at linkto.eu", "has_brand_impersonation_keyword": "vvhatsapp",
}


def test_every_flag_fires(spark):
    df = spark.createDataFrame([(k, v) for k, v in HITS.items()] + [("none", None), ("none", ""), ("none", "éloan a@x.top forfree 验")], "k string, t string")
    got = df.select("k", *[v.alias(k) for k, v in content.flags(F.col("t")).items()]).collect()
    for r in got:
        on = {c for c in content.PATTERNS if r[c] == 1}
        assert (r["k"] in on) if r["k"] != "none" else not on, (r["k"], on)
    for text, flag in (("验证码 1", "has_otp_keyword"), ("恭喜", "has_prize_keyword"), ("贷款", "has_loan_keyword"), ("马上", "has_urgency_keyword"), ("பரிசு", "has_prize_keyword")):
        assert spark.createDataFrame([(text,)], "t string").select(content.flag(F.col("t"), flag)).first()[0] == 1


def test_text_measures(spark):
    texts = ["aabb", "a", "", None, "é😀é😀", "abcdefgh", "x" * 10_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [tuple(r) for r in df.select(content.entropy(F.col("t")), content.text_length(F.col("t")), content.letter_ratio(F.col("t"))).collect()]
    assert [None if h is None else round(h, 9) for h, _, _ in got] == [1.0, 0.0, None, None, 1.0, 3.0, 0.0]
    assert [n for _, n, _ in got] == [4, 1, 0, 0, 4, 8, 10_000] and got[4][2] == 0.0


def test_entropy_z(spark):
    rows = [(2.0, 1.0, 0.5, 2.0), (2.0, 1.0, 0.01, 20.0), (2.0, 1.0, 0.0, None), (None, 1.0, 1.0, None), (2.0, None, 1.0, None)]
    df = spark.createDataFrame(rows, "h double, l double, s double, want double")
    assert all(r[0] == r[1] for r in df.select(content.entropy_z(F.col("h"), F.col("l"), F.col("s")), "want").collect())


# --- labels ------------------------------------------------------------------------------


def test_rule_labels(spark):
    rows = [("0", "S_1", "spam", True, True), ("1", None, None, True, False), ("0", "SW_1", "spam", False, None), (None, None, None, False, None), ("x", None, "spam", False, None), ("6", "S_1", "spam", False, None), ("1", "S_2", "other", True, False)]
    df = spark.createDataFrame(rows, "d string, r string, f string, e boolean, want boolean")
    e = labels.rule_evaluated(F.col("d"), F.col("r"))
    assert all(r[0] == r[1] and r[2] == r[3] for r in df.select(e, "e", labels.rule_flagged(e, F.col("f")), "want").collect())


def test_cluster_labels(spark):
    members = spark.createDataFrame([(1, "a", "t", "o"), (1, "b", "t", "o"), (2, "c", "win jackpot", "p"), (-1, "d", None, None)], "cluster int, key string, text string, originator string")
    summary = {r["cluster"]: r for r in labels.cluster_summary(members).collect()}
    assert summary[1]["n_rows"] == 2 and summary[1]["sample_texts"] == "t ||| t" and summary[-1]["n_unique_originators"] == 0
    template = spark.createDataFrame([(1, " flood "), (2, "  "), (-1, None)], "cluster int, label string")
    assert sorted(map(tuple, labels.label_clusters(members, template).collect())) == [("a", "flood"), ("b", "flood")]
    with pytest.raises(ValueError, match="9"):
        labels.label_clusters(members, spark.createDataFrame([(9, "x")], "cluster int, label string"))
    cases = [(10, 9, 9, "x", "incoherent_no_pattern"), (10, 1, 1, "x", "flooding_burst"), (10, 2, 3, None, "templated_multi_sender_campaign"), (10, 4, 3, "x", "unclassified_review_needed"), (10, 1, 1, "your OTP", "otp_verification_bait"), (0, 0, 0, "x", "templated_multi_sender_campaign")]
    df = spark.createDataFrame(cases, "n int, t int, o int, s string, want string")
    assert all(r[0] == r[1] for r in df.select(labels.suggest(F.col("n"), F.col("t"), F.col("o"), F.col("s")), "want").collect())


# --- snapshots ---------------------------------------------------------------------------


def test_snapshots(spark):
    now = 100 * DAY
    rows = [("a", "x", "t", now), ("a", "x", "t", now - HOUR), ("a", None, "u", now - HOUR - 1), ("b", "x", "t", now + 5), (None, "x", None, now - 60_000_000), ("c", "x", "t", None)]
    df = spark.createDataFrame(rows, "sender string, destination string, text string, at long")
    got = {r["sender_id"]: r for r in snapshot.sender_snapshot(df, now).collect()}
    assert set(got) == {"a", "b", "<NA>"} and got["a"]["msgs_long"] == 2 and got["a"]["dests_long"] == 1 and got["b"]["age_days"] == 0.0 and got["b"]["msgs_long"] == 0
    top = snapshot.top_values(df.where("at IS NOT NULL"), "sender", "text", "at", 1)
    assert {r["sender"]: r["top_values"] for r in top.collect()}["a"] == '{"t":2}'
    cases = [('{"t":2,"$.x":1}', "t", 4, 0.5), ('{"t":2,"$.x":1}', "$.x", 4, 0.25), ("nonsense", "t", 4, 0.0), (None, "t", 4, 0.0), ('{"t":2}', "t", 0, 0.0), ('{"t":2}', None, 4, 0.0)]
    frame = spark.createDataFrame(cases, "js string, t string, n int, want double")
    assert all(r[0] == r[1] for r in frame.select(snapshot.repeat_ratio(F.col("js"), F.col("t"), F.col("n")), "want").collect())


def test_baselines(spark):
    rows = [("s", "ab", 0), ("s", "aabb", 10), ("s", "abcd", HOUR), ("s", "", HOUR), ("s", "abcd", 9 * HOUR)]
    got = snapshot.entropy_baseline(spark.createDataFrame(rows, "sender string, text string, at long"), 2 * HOUR).first()
    assert got["entropy_level"] == pytest.approx(1.1) and got["entropy_spread"] == pytest.approx(0.1) and got["hours"] == 2
    hourly = spark.createDataFrame([("s", h, float(v)) for h, v in enumerate([3, 4, 2, 8, 1, 5])], "e string, hour long, v double")
    got = snapshot.seasonal_baseline(hourly, "e", "v", season=2).first()
    level, trend, spread, season = 3.0, 0.0, 0.0, [0.0, 0.0]
    for h, v in list(enumerate([3, 4, 2, 8, 1, 5]))[1:]:
        i = h % 2
        residual = v - (level + trend + season[i])
        new = 0.1 * (v - season[i]) + 0.9 * (level + trend)
        season[i] = 0.1 * (v - new) + 0.9 * season[i]
        level, trend, spread = new, 0.05 * (new - level) + 0.95 * trend, 0.1 * abs(residual) + 0.9 * spread
    assert (got["level"], got["trend"], got["spread"], got["season"]) == (pytest.approx(level), pytest.approx(trend), pytest.approx(spread), pytest.approx(season))


# --- relations ---------------------------------------------------------------------------


def test_joins(spark):
    left = spark.createDataFrame([("a", 10), ("a", 100), ("b", 5), (None, 5), ("a", None)], "e string, at long")
    right = spark.createDataFrame([("a", 10, "x"), ("a", 10, "y"), ("a", 50, "z"), (None, 5, "n"), ("b", 6, "later")], "e string, at long, v string")
    got = sorted(map(tuple, relations.as_of(left, right, "e", ["v"], ttl=50).collect()), key=repr)
    assert got == sorted([("a", 10, "y"), ("a", 100, "z"), ("b", 5, None), (None, 5, None), ("a", None, None)], key=repr)
    assert {tuple(r) for r in relations.as_of(left, right, "e", ["v"], ttl=49).collect()} >= {("a", 100, None)}
    with pytest.raises(ValueError, match="unique"):
        relations.enrich(left, right.select("e", "v"), ["e"])
    assert relations.frequent(left, "e", 2).count() == 3
    assert relations.unknown_keys(left, right.where("e = 'b'"), ["e"]).count() == 4


def test_similar_in_time(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK", 7)
    rng = np.random.default_rng(3)
    x = rng.standard_normal((80, 4))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    at = rng.integers(0, 60, 80)
    rows = [(f"k{i:02d}", f"o{i % 3}", int(at[i]), [float(v) for v in x[i]]) for i in range(80)] + [(None, "o", 1, [1.0] * 4), ("n", "o", None, [1.0] * 4), ("v", "o", 1, None), ("short", "o", 1, [9.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "key string, originator string, at long, vector array<double>, b int")
    got = {(r["key"], r["match_key"]) for r in similarity.similar_in_time(df, df, 0.5, 10).collect()}
    want = {(f"k{i:02d}", f"k{j:02d}") for i in range(80) for j in range(80) if 0 < at[i] - at[j] <= 10 and x[i] @ x[j] >= 0.5}
    assert got == want and len(want) > 20
    f = {r["key"]: r for r in similarity.neardup_features(df.where("key LIKE 'k%'"), 0.5, {"s": 5, "l": 10}).collect()}
    assert len(f) == 80 and f["k00"]["match_count_l"] == sum(a == "k00" for a, _ in want)
    top = similarity.nearest_exact(df.where("key = 'k00'"), df, 3).orderBy("rank").collect()
    assert [r["match_key"] for r in top] == [f"k{j:02d}" for j in np.argsort(-(x @ x[0])) if j][:3]
    empty = spark.createDataFrame([], df.schema)
    assert similarity.similar_in_time(empty, df, 0.5, 10).count() == 0


# --- metrics -----------------------------------------------------------------------------


def test_metrics(spark):
    rows = [(i, y, s) for i, (y, s) in enumerate([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1), (1, 0.4)])] + [(9, None, 0.5), (10, 1, None)]
    df = spark.createDataFrame(rows, "id int, y int, score double")
    assert ranking.average_precision(df).first()[0] == pytest.approx((1 + 2 / 3 + 3 / 4) / 3)
    assert ranking.roc_auc(df).first()[0] == pytest.approx((2 + 1.5 + 1) / 6)
    one = df.where("y = 1")
    assert all(m(one).first()[0] is None for m in (ranking.average_precision, ranking.roc_auc, ranking.log_loss))
    assert {r["k"]: r["precision"] for r in ranking.precision_at_k(df, [0, 1, 3, 6]).collect()} == {0: None, 1: 1.0, 3: 2 / 3, 6: None}
    assert [(r["k"], r["precision"]) for r in ranking.precision_at_percentiles(df, [1.0, 50.0]).orderBy("percent").collect()] == [(0, None), (2, 0.5)]
    constant = df.withColumn("score", F.lit(0.3))
    assert ranking.log_loss(constant.where("id < 5")).first()[0] == pytest.approx(math.log(2))
    x = spark.createDataFrame([(1, 2), (2, 2), (3, 9), (None, 1)], "a int, b int")
    assert ranking.spearman(x, "a", "b").first()["rho"] == pytest.approx(0.8660254)
    ranks = {r["b"]: r["rank"] for r in ranking.average_rank(x, "b").collect()}
    assert ranks == {1: 1.0, 2: 2.5, 9: 4.0}
    c = {r["label"]: r for r in ranking.confusion(spark.createDataFrame([("a", "a"), ("a", "b"), (None, "a")], "y string, p string"), "y", "p").collect()}
    assert (c["a"]["tp"], c["a"]["fp"], c["a"]["fn"], c["b"]["precision"], c[None]["fn"]) == (1, 1, 1, 0.0, 1)


def test_feature_columns(spark):
    df = spark.createDataFrame([(1, 0.5, "F"), (5, None, "O"), (9, float("nan"), None)], "n int, r double, s string")
    got = features.one_hot(features.with_known(features.gate(df, "r", "n", 3), ["r"]), "s", ["F", "O"]).orderBy("n").collect()
    assert [(r["r"], r["r_known"], r["s_F"], r["s_O"]) for r in got] == [(0.0, 0.0, 1.0, 0.0), (0.0, 0.0, 0.0, 1.0), (0.0, 0.0, 0.0, 0.0)]
    assert [r[0] for r in df.orderBy("n").select(features.right_closed(F.col("n"), [1, 5])).collect()] == ["0", "1", "2"]
    assert [r["x"] for r in features.min_max(df, "n", "x").orderBy("n").collect()] == [0.0, 0.5, 1.0]
    keys = spark.createDataFrame([("SMPP|a|b",), ("x",)], "k string").select(features.key_rest(F.col("k"))).collect()
    assert [r[0] for r in keys] == ["a|b", "x"]


def test_scoring(spark):
    rows = [(0.4, 0.6), (0.6, None), (0.6, 0.4), (0.025, None)]
    got = [tuple(r)[3:] for r in scoring.decide(spark.createDataFrame(rows, "pattern_score double, fusion_score double")).collect()]
    assert got == [("FRAUD", "BLOCK", 40, True), ("FRAUD", "BLOCK", 60, False), ("NOT_FRAUD", "PASS", 60, False), ("NOT_FRAUD", "PASS", 2, False)]
    c = spark.createDataFrame([([("sender_repeat_content_ratio_1hr", 0.5), ("x", 1.0), ("sender_msgs_last_1hr", -1.0)], True, False, True)], "c array<struct<feature:string,contribution:double>>, cold boolean, bad boolean, up boolean")
    assert c.select(scoring.reason_codes(F.col("c"), F.col("cold"), F.col("bad"), F.col("up"))).first()[0] == ["KNOWN_SPAM_PATTERN", "REPEATED_CONTENT", "NEW_SENDER_LOW_HISTORY", "ANOMALY_SIGNAL_ESCALATION"]
    assert [r[0] for r in spark.createDataFrame([(False, False), (True, True)], "a boolean, b boolean").select(scoring.confidence(F.col("a"), F.col("b"))).collect()] == [90, 30]


# --- files -------------------------------------------------------------------------------


def test_csv_scan(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_text('id,text\n1,"x, y"\n2,\n')
    (tmp_path / "sub" / "b.csv").write_text("id,text\nbad,z\n3,w\n")
    (tmp_path / "c.txt").write_text("ignored")
    df = files.scan_csv(spark, str(tmp_path), "id int, text string").persist()
    assert sorted((r["_file"], r["id"]) for r in df.where("_corrupt IS NULL").collect()) == [("a", 1), ("a", 2), ("b", 3)]
    assert {(r["_file"], r["rows"], r["corrupt"]) for r in files.file_report(df).collect()} == {("a", 2, 0), ("b", 2, 1)}
    fixed = files.repair_empty_text(df.withColumn("text_decode_failed", F.col("id") == 2)).where("id = 2").first()
    assert fixed["text"] == ""


def test_sinks(spark, tmp_path):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 3).alias("source"), F.lit("t").alias("text"))
    assert files.write_verified(df, str(tmp_path / "v"), ["source"]) == 100
    files.write_two(df, ["id", "text"], ["id", "source"], str(tmp_path / "two"))
    assert spark.read.parquet(str(tmp_path / "two/labels")).columns == ["id", "source"]
    path = str(tmp_path / "manifest")
    files.update_manifest(spark, path, spark.createDataFrame([("a", 1), ("b", 2)], "source string, n int"))
    assert sorted(map(tuple, files.update_manifest(spark, path, spark.createDataFrame([("b", 5)], "source string, n int")).collect())) == [("a", 1), ("b", 5)]
    state = str(tmp_path / "state.json")
    assert files.is_due(df, "id", state, 10)
    assert files.save_state(df, "id", state) == {"row_count": 100, "max_timestamp": "99"}
    assert not files.is_due(df, "id", state, 10) and files.is_due(df.union(df), "id", state, 10)
    files.disclose(spark, str(tmp_path / "v"), "sample of 1%")
    assert (tmp_path / "v" / "_SAMPLE").read_text() == "sample of 1%"
    files.disclose(spark, str(tmp_path / "v"), None)
    assert not (tmp_path / "v" / "_SAMPLE").exists()
    online = str(tmp_path / "online")
    assert files.read_online(spark, online) is None
    for rows in ([(1, "a", 1), (2, "b", 1)], [(2, "z", 2), (2, "c", 3), (3, "n", 0), (3, "m", 9)], [(1, "d", 4)], [(1, "e", 5)]):
        files.upsert_online(spark, online, spark.createDataFrame(rows, "k int, v string, at int"), ["k"], ["at"])
    assert sorted((r["k"], r["v"]) for r in files.read_online(spark, online).collect()) == [(1, "e"), (2, "c"), (3, "m")]


def test_registry(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert [files.register(spark, path, "m", "pr", v, f"p{v}", least_gain=0.1) for v in (0.5, 0.55, 0.7)] == [True, False, True]
    assert files.champion(spark, path, "m") == "p0.7" and files.champion(spark, path, "other") is None
    assert spark.read.parquet(path).where("champion").count() == 1


def test_samples(spark):
    df = spark.range(10_000).withColumn("evaluated", F.col("id") % 10 == 0)
    s = files.sample_rows(df, ["id"], 0.1, "evaluated", 0.5)
    assert s.exceptAll(files.sample_rows(df, ["id"], 0.1, "evaluated", 0.5)).count() == 0
    n, e = s.count(), s.where("evaluated").count()
    assert 1200 < n < 1600 and 480 < e < 620
    assert files.sample_n(df, "id", 7).count() == 7 and files.head(df, ["id"], 3).count() == 3


def test_exact_quantiles(spark):
    from tidemark.operators.ranking import exact_quantiles

    rng = np.random.default_rng(4)
    data = {"a": rng.integers(0, 9, 57).astype(float), "b": rng.standard_normal(100), None: np.array([3.0])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in data.items() for v in vs] + [("a", None)], "g string, v double")
    got = {(r["g"], r["p"]): r["quantile"] for r in exact_quantiles(df, "v", [0.0, 0.5, 0.9, 0.995, 1.0], ["g"]).collect()}
    assert len(got) == 15 and all(got[g, p] == pytest.approx(np.quantile(data[g], p)) for g, p in got)
    assert exact_quantiles(df.where("g = 'b'"), "v", [0.25]).first()["quantile"] == pytest.approx(np.quantile(data["b"], 0.25))
    assert exact_quantiles(df.where("v > 99"), "v", [0.5]).count() == 0


def test_evaluation(spark):
    from tidemark.operators import evaluation as ev

    df = spark.createDataFrame([(i, int(i >= 50), float(i), float(i % 7), "s" if i % 2 else None) for i in range(100)], "id int, y int, score double, noise double, g string")
    p = ev.plausibility(df).first()
    assert (p["mean_flagged"], p["mean_clean"], p["n_flagged"]) == (74.5, 24.5, 50)
    assert {r["bin"]: r["lift"] for r in ev.lift(df).collect()} == {i: 2.0 if i >= 5 else 0.0 for i in range(10)}
    assert {tuple(r) for r in ev.redundant_groups(df, ["id", "score", "noise"]).collect()} == {("id", "id"), ("score", "id"), ("noise", "noise")}
    assert ev.interior_correlation(df, "score", "id", "g").first()["rho"] == pytest.approx(1.0)
    assert {r["segment"]: r["average_precision"] for r in ev.by_source(df, "g").collect()} == {"all": 1.0, None: 1.0, "s": 1.0}
    assert ev.split_is_justified({"a": 0.5, "b": 0.5}, {"a": 0.56, "b": 0.51}) == {"a": True, "b": False}


def test_encoder(spark):
    from tidemark.ml.encoder import approximate_pairs, encode_distinct

    df = spark.createDataFrame([(0, "hello world"), (1, "hello world"), (2, "Hello worlds"), (3, None), (4, ""), (5, "zebra")], "key int, text string")
    rows = {r["key"]: np.array(r["vector"]) for r in encode_distinct(df, dim=64).collect()}
    assert len(rows) == 6 and np.allclose(rows[0], rows[1]) and not rows[3].any() and rows[0] @ rows[2] > 0.7 > rows[0] @ rows[5]
    pairs = {(r["a"], r["b"]) for r in approximate_pairs(encode_distinct(df.where("length(text) > 0"), dim=64), 0.7, buckets=2.0).collect()}
    assert {(0, 1), (0, 2), (1, 2)} == pairs
