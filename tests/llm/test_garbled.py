from __future__ import annotations

import pytest

from tidemark.llm.garbled import Describer, diagnose, restore_text, train_dictionaries, undouble
from tidemark.functions.payload import decode_text

GOOD = [
    "Señor Pérez, su préstamo de 2387 está aprobado. Envíe la contraseña mañana, también por aquí",
    "Chère cliente, le café près de la gare rouvre à midi, déjeuner offert, numéro 7",
    "Promoção de verão: leve dois e pague um, cupão válido até amanhã, mínimo 30",
    "Für Sie liegt ein Päckchen zurück, Gebühr 22 € bitte bis Juli überweisen",
    "Уважаемый клиент, ваш кредит одобрен, подробности на сайте сегодня",
    "Αγαπητέ πελάτη, ο λογαριασμός σας κλειδώθηκε, κωδικός 602240",
    "您的贷款已批准，编号请马上联系客服，限时优惠今天结束",
    "Your electricity bill is overdue since May, pay through the branch",
]


def packed(text):
    bits = sum(ord(c) << 7 * i for i, c in enumerate(text))
    return bits.to_bytes((7 * len(text) + 7) // 8, "little")


@pytest.fixture(scope="module")
def dictionaries(spark):
    messages = [(f"{t} {i} ref {i * 7919 % 1000}".encode("utf-16-be").hex(), 8) for i in range(60) for t in GOOD]
    docs = [(f"{t} {i}", lang) for i in range(20) for t, lang in zip(GOOD, ["es", "FR ", "pt", "de", None, "", "zh", "en"])]
    return train_dictionaries(spark.createDataFrame(messages, "content string, dcs int"), spark.createDataFrame(docs, "text string, lang string"))


def cases():
    for t in GOOD:
        if not t.isascii():
            yield t.encode(), 3, t
            yield t.encode(), 1, t
            yield t.encode().decode("latin-1").encode("utf-16-be"), 8, t
            yield t.encode().decode("latin-1").encode(), 3, t
        yield t.encode("utf-16-be"), 3, t
        yield t.encode("utf-16-le"), 8, t
    yield GOOD[4].encode("cp1251"), 3, GOOD[4]
    yield packed(GOOD[7]), 0, GOOD[7]
    yield "“Special” – today…".encode("cp1252"), 3, "“Special” – today…"
    half = GOOD[0][:30].encode().decode("latin-1") + GOOD[0][30:]
    yield half.encode("utf-16-be"), 8, GOOD[0]
    yield GOOD[7].encode(), 8, GOOD[7]


@pytest.mark.parametrize("payload,dcs,text", list(cases()))
def test_restores(dictionaries, payload, dcs, text):
    declared = decode_text(payload, dcs, "SMPP")[0]
    chain, restored = diagnose(payload, declared, Describer(dictionaries))
    assert chain is not None and restored == text


@pytest.mark.parametrize("text", GOOD + ["ÎLE : coût £2380 ¶ À la carte? ×60 → 4D", "№63 – ±93°C, ½ off «helmet» ©", "ATENÇÃO: ENTREGA NÃO SAIU, TAXA ATÉ 8"])
def test_leaves_sound_text_alone(dictionaries, text):
    assert diagnose(text.encode("utf-16-be"), text, Describer(dictionaries))[0] is None


def test_lost_characters_are_reported(dictionaries):
    assert diagnose("caf�".encode("utf-16-be"), "caf�", Describer(dictionaries)) == ("lost", "caf�")


def test_undouble():
    assert undouble("cafÃ© â\x82¬ â‚¬ ok Ã") == "café € € ok Ã"


def test_frame(spark, dictionaries):
    rows = [("a", GOOD[0].encode().hex(" ").upper(), 3, 1), ("b", "", 3, 1), ("c", None, 3, 1), ("d", "4", 3, 1), ("e", "zz", 3, 1), ("f", "6869", None, 1), ("g", "6869", -15, 1), (None, "6869", 0, 1), ("h", "e9" * 5000, 3, 1)]
    got = {r["reference"]: r for r in restore_text(spark.createDataFrame(rows, "reference string, content string, dcs int, chain int"), dictionaries).collect()}
    assert set(got) == {"a", "f", "g", None, "h"}
    assert got["a"]["restored"] == GOOD[0] and got["f"]["chain"] is None and got["g"]["declared"] == "hi"


def test_no_training_text(spark):
    empty = train_dictionaries(spark.createDataFrame([], "content string, dcs int"), spark.createDataFrame([], "text string, lang string"))
    assert empty == {} and diagnose(b"hi", "hi", Describer(empty)) == (None, "hi")
    assert diagnose(GOOD[0].encode(), GOOD[0].encode().decode("latin-1"), Describer(empty))[1] == GOOD[0]


def test_ascii_is_tried_as_well(dictionaries):
    """UTF-16 ideographs whose bytes are all printable ASCII under an 8-bit scheme."""
    from tidemark.llm.garbled import _of_ascii

    text = "买个书主中久" * 4
    payload = text.encode("utf-16-be")
    assert payload.isascii() and dict(_of_ascii(payload))["utf-16-be"] == text
    assert diagnose(payload, payload.decode(), Describer(dictionaries | {"Han:zh": text.encode() * 20})) == ("utf-16-be", text)
    assert diagnose(b"See you at 1830", "See you at 1830", Describer(dictionaries))[0] is None


def test_share_restored_as_written(spark, dictionaries):
    """Sentences that trained nothing, garbled in eight ways: how many come back as written."""
    words = "año niño está mañana también después garçon élève déjà où forêt über größer Straße möchte não você amanhã são".split()
    rng, tried, back = __import__("random").Random(4), 0, 0
    for i in range(120):
        text = f"{' '.join(rng.sample(words, 6))} {i}"
        for payload, dcs in [(text.encode(), 3), (text.encode(), 1), (text.encode().decode("latin-1").encode("utf-16-be"), 8), (text.encode().decode("cp1252", "replace").encode(), 3), (text.encode("utf-16-be"), 3), (text.encode("utf-16-le"), 8)]:
            declared = decode_text(payload, dcs, "SMPP")[0]
            tried, back = tried + 1, back + (diagnose(payload, declared, Describer(dictionaries))[1] == text)
    assert back / tried >= 0.95, back / tried


def test_every_text_trains(spark):
    """The dictionary of many and long texts, in one part and in several, is one of all of them: none is drawn, cut or left out."""
    from tidemark.llm import garbled

    rng = __import__("random").Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9))
    rest = [" ".join(word() for _ in range(12)) for _ in range(3_000)]
    phrase = "quoth zephyr vexing bold jackdaw fjord gymnast"  # only beyond the first 4,000 characters of long documents
    long = [" ".join([*(word() for _ in range(500)), *[phrase] * 200]) for i in range(30)]
    docs = spark.createDataFrame([(t, "xx") for t in rest + long], "text string, lang string")
    nothing = spark.createDataFrame([], "content string, dcs int")
    for size in ({}, {"part_bytes": 1 << 17}):
        got = train_dictionaries(nothing, docs, **size)
        assert list(got) == ["Latin:xx"] and len(got["Latin:xx"]) <= garbled.DICTIONARY_BYTES
        assert any(w.encode() in got["Latin:xx"] for w in phrase.split()), size
    assert got == train_dictionaries(nothing, docs.repartition(7), **size)
    with pytest.raises(ValueError):
        train_dictionaries(nothing, docs, part_bytes=100)


def test_all_texts_reach_the_training(spark, monkeypatch):
    """More different messages and documents than earlier samples held: each is in one part, once."""
    from tidemark.llm import garbled

    docs = [(f"document number {i} of the year", "en") for i in range(4_500)] * 2
    messages = [(f"message number {i} of the day".encode("utf-16-be").hex(), 8) for i in range(31_000)] + [(b"copy".hex(), 1)] * 500
    seen = []
    trained = garbled._trained
    monkeypatch.setattr(garbled, "_trained", lambda texts, size: seen.append(texts) or trained(texts, size))
    garbled.train_dictionaries(spark.createDataFrame(messages, "content string, dcs int"), spark.createDataFrame(docs, "text string, lang string"))
    assert [t.count() for t in seen] == [4_500, 4_500 + 31_001]
    assert seen[1].distinct().count() == 4_500 + 31_001
