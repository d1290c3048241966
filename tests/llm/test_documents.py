"""Leakage, mixing and repetition against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from tidemark.llm.leakage import leaked_passages
from tidemark.llm.mixing import count_tokens, mix
from tidemark.llm.repetition import fertility, fertility_bands, repeated_sequences, repeated_share, repeated_shares, script_of
from tidemark.llm.tokens import TOKENIZERS, byte_bpe


def ws(text):
    return [w.lower() for w in re.findall("[A-Za-z0-9]+", text or "")]


# --- leakage -----------------------------------------------------------------------------


def runs(text, n=12):
    w = ws(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_leaks(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 5, 12, 13, 40])))) for i in range(30)] + [(None, "x " * 20), (90, None), (91, ""), (92, "same " * 30)]
    docs = []
    for d in range(80):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        if rng.random() < 0.7:
            source = ws(rng.choice(items)[1])
            at, k = rng.randrange(max(1, len(source))), rng.choice([11, 12, 13, 40])
            words[rng.randrange(len(words) + 1) :] = source[at : at + k] + words[:3]
        docs.append((d, rng.choice([" ", ",\n", " ​- "]).join(w.upper() if rng.random() < 0.3 else w for w in words)))
    docs += [(None, items[4][1]), (200, None), (201, ""), (202, "same " * 12), (203, "same " * 11), (204, "é".join(["same"] * 14))]
    want = {(i, d): len(runs(t) & runs(u)) for i, t in items for d, u in docs if i is not None and d is not None and runs(t) & runs(u)}
    a = spark.createDataFrame([(*x, 1) for x in items + items[:3]], "item_id long, text string, ws int")
    b = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, at int")
    got = {(r["item_id"], r["doc_id"]): r["windows"] for r in leaked_passages(a, b).collect()}
    assert got == want and (92, 202) in got and (92, 203) not in got and len(want) > 10


def test_leaks_empty(spark):
    a = spark.createDataFrame([], "item_id long, text string")
    b = spark.createDataFrame([(1, "x " * 20)], "doc_id long, text string")
    assert leaked_passages(a, b).count() == 0
    assert leaked_passages(b.withColumnRenamed("doc_id", "item_id"), a.withColumnRenamed("item_id", "doc_id")).count() == 0


# --- mixing ------------------------------------------------------------------------------


def test_tokens(spark):
    texts = ["hello world", "", None, "<|endoftext|> é 中文 " * 50]
    got = [r["tokens"] for r in count_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id").orderBy("doc_id").collect()]
    assert got == [len(byte_bpe(TOKENIZERS).encode_ordinary(t)) if t else 0 for t in texts]


def test_mix(spark, monkeypatch):
    from tidemark.llm import mixing

    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    rng = random.Random(1)
    docs = [(i, " ".join(["tok"] * rng.randrange(1, 60)), rng.choice(["A", " a", "A ", "b", "c", "unlisted", None])) for i in range(900)] + [(901, None, "b"), (902, "", "b"), (902, "x", "b")]
    targets = [("a", 0.2, 1), ("B ", 0.5, 5), ("c", 0.1, 1), ("absent", 0.1, 3), ("c", 0.9, 9), (None, 0.5, 1), ("d", None, None)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, source string, tokens int")
    picked, shares = mix(df, spark.createDataFrame(targets, "source string, target_share double, max_repeats int"), total=40_000)
    rows = {r["source"]: r for r in shares.collect()}
    assert set(rows) == {"a", "b", "c", "absent", "d"}
    used = Counter()
    for r in picked.collect():
        used[r["source"]] += r["tokens"] * r["repeats"]
        assert 1 <= r["repeats"] <= {"a": 1, "b": 5, "c": 1}[r["source"]]
    for s, share, cap in (("a", 0.2, 1), ("b", 0.5, 5), ("c", 0.1, 1)):
        r = rows[s]
        assert r["budget_tokens"] == min(round(share * 40_000), cap * r["available_tokens"])
        assert r["mixed_tokens"] == used[s] and 0 <= r["budget_tokens"] - used[s] < 61
        assert r["actual_share"] == used[s] / sum(used.values())
    assert rows["absent"]["mixed_tokens"] == 0 and rows["d"]["budget_tokens"] == 0
    assert rows["b"]["epochs"] > 1


def test_mix_empty(spark):
    picked, shares = mix(spark.createDataFrame([], "doc_id long, text string, source string"), spark.createDataFrame([("a", 1.0, 2)], "source string, target_share double, max_repeats int"))
    assert picked.count() == 0 and shares.first()["actual_share"] is None


# --- repetition --------------------------------------------------------------------------


def brute_share(text, n=5):
    w = ws(text)
    grams = [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
    return (len(grams) - len(set(grams))) / len(grams) if grams else None


#: words that public vocabularies hold whole, so that almost every token differs
DIVERSE = (
    "time year people way day man thing woman life child world school state family student group country problem hand part place case week company system program question work government number night point home water room mother area money story fact month lot right study book eye job word business issue side kind head house service friend father power hour game line end member law car city community name president team minute idea body information back parent face others level office door health person art war history party result change morning reason research girl guy moment air teacher force education"
).split()


def texts():
    rng = random.Random(5)
    out = [None, "", " \n", "one two three", "a " * 200, "spam and eggs " * 40, "é" * 3000, "x" * 20_000, "中文 " * 100]
    for share in range(0, 10):
        unique = [f"word{rng.randrange(10**6)}" for _ in range(100)]
        out.append(" ".join(unique + unique[: share * 10]))
        diverse = [w for w in DIVERSE if rng.random() < 0.9]
        out.append(" ".join(diverse + diverse[: share * 4]))
        out.append("; ".join(rng.choice(["the", "and", "of", "to", "cat"]) for _ in range(120)))
    return out


def test_repetition(spark):
    rows = list(enumerate(texts())) + [(None, "spam and eggs " * 40)]
    df = spark.createDataFrame([(*r, None if i % 3 else "EN", 1) for i, r in enumerate(rows)], "doc_id long, text string, lang string, tokens int")
    exact = {r["doc_id"]: r for r in repeated_shares(df).collect()}
    for i, t in rows:
        assert exact[i]["repeated_share"] == brute_share(t) and exact[i]["n_words"] == len(ws(t))
    banded = {r["doc_id"]: r for r in fertility_bands(fertility(df)).collect()}
    assert len(banded) == len(rows) and {r["band"] for r in banded.values()} >= {"en", "script:Latin", "script:none"}
    cases = {i for i, t in rows if i is not None and len(ws(t)) >= 50 and brute_share(t) >= 0.3}
    assert cases and not any(banded[i]["rejected"] for i in cases) and any(r["rejected"] for r in banded.values())
    assert {r["doc_id"] for r in repeated_sequences(df).collect()} == cases


def test_fertility_is_that_of_whole_texts(spark):
    from tidemark.llm.tokens import TOKENIZERS, piece_bpe

    sp, rows = piece_bpe(TOKENIZERS), [(i, t) for i, t in enumerate([*texts(), " a", "a ", "a  b", "a b\n c\t d", "中文字" * 50 + " x"])]
    got = {r["doc_id"]: r for r in fertility(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        assert got[i]["tokens"] == (len(sp.encode(t)) if t else 0) and got[i]["n_words"] == len(ws(t))


def test_repetition_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert fertility_bands(fertility(none)).count() == 0 and repeated_sequences(none).count() == 0


@pytest.mark.parametrize("text,script", [("abc", "Latin"), ("12", None), ("Привет a", "Cyrillic"), ("中文字", "Han"), ("", None)])
def test_script(text, script):
    assert script_of(text) == script


def test_share_counts_exactly():
    assert repeated_share("a b c d e a b c d e".split(), 5) == 1 / 6
    assert repeated_share("a b".split(), 5) is None


def test_leaks_of_different_texts_of_one_item(spark):
    from tidemark.llm.leakage import leaked_passages

    one, two, nowhere = (" ".join(f"{c}{i}" for i in range(14)) for c in "abc")
    items = spark.createDataFrame([(1, one), (1, two), (1, nowhere)], "item_id int, text string")
    docs = spark.createDataFrame([(10, one), (20, "x " + two)], "doc_id int, text string")
    got = {(r["item_id"], r["doc_id"]): (r["windows"], r["share"]) for r in leaked_passages(items, docs).collect()}
    assert got == {(1, 10): (3, 3 / 9), (1, 20): (3, 3 / 9)}
