"""Text decoded with the wrong character encoding: finding and restoring it."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.payload import LOST, decode_text, gsm_text, one_line, read_header, unpack_septets, whole_bytes
from tidemark.llm.repetition import script_of
from tidemark.runtime import broadcast_if_small, materialize

PART_BYTES = 16 << 20  # bytes of text that are trained on at once, about
TRAIN_CHARS = 4_000  # characters of a training sample; longer texts are several
MERGE_BYTES = 256  # bytes of a training sample where dictionaries are merged
LEAST_TEXTS = 8  # texts that a dictionary needs
DICTIONARY_BYTES = 16_384
#: What ends the entropy tables of a trained dictionary: its repeat offsets. Sound texts have no such bytes.
OFFSETS = bytes([1, 0, 0, 0, 4, 0, 0, 0, 8, 0, 0, 0])
LEVEL = 3

#: Bytes a chain of readings costs beside its text: per step, and per code point that is no text.
STEP_COST = 0.5
ODD_COST = 4.0
#: A wholly different reading of the bytes must save this share of the best cost so far.
READING_SAVING = 0.15

CODECS = ("utf-8", "cp1252", "utf-16-be", "utf-16-le", "cp1251", "iso8859-7", "koi8-r", "gb18030", "shift_jis")
_DOUBLED = re.compile("[Â-ô][\u0080-ÿŒœŠšŸŽžƒˆ˜–—‘-‚“-„†-•…‰‹›€™]+")
_HIGH = re.compile("[^\x00-\x7f]+")
_LATIN_RUN = re.compile("[À-ÿ]{4}")
_BEYOND_LATIN = re.compile("[\u0370-\U0010ffff]")


@lru_cache(maxsize=1)
def _cp1252_bytes() -> dict[int, int]:
    """Code point -> byte, as lenient decoders read windows-1252: unassigned bytes are C1 controls."""
    table = {b: b for b in range(256)}
    for b in range(0x80, 0xA0):
        try:
            table[ord(bytes([b]).decode("cp1252"))] = b
        except UnicodeDecodeError:
            pass
    return table


def undouble(text: str) -> str:
    """``text`` with every stretch that is UTF-8 read as a one-byte encoding read as UTF-8."""
    to_byte = _cp1252_bytes()

    def fix(m: re.Match) -> str:
        run, out, i = m.group(), [], 0
        raw = bytes(to_byte[ord(c)] for c in run)
        while i < len(raw):
            n = 2 if 0xC2 <= raw[i] <= 0xDF else 3 if 0xE0 <= raw[i] <= 0xEF else 4 if 0xF0 <= raw[i] <= 0xF4 else 0
            try:
                out.append(raw[i : i + n].decode("utf-8") if n and len(raw) >= i + n else run[i])
                i += n if n and len(raw) >= i + n else 1
            except UnicodeDecodeError:
                out.append(run[i])
                i += 1
        return "".join(out)

    return _DOUBLED.sub(fix, text)


def reread(text: str, codec: str) -> str | None:
    """``text`` whose characters above ASCII were bytes in ``codec``, read as Latin-1; None if it can't be."""
    to_byte = _cp1252_bytes()
    try:
        return _HIGH.sub(lambda m: bytes(to_byte[ord(c)] for c in m.group()).decode(codec), text)
    except (KeyError, UnicodeDecodeError):
        return None


@lru_cache(maxsize=65_536)
def _odd(c: str) -> bool:
    return c == LOST or (unicodedata.category(c) in ("Cc", "Cn", "Co", "Cs") and c not in "\n\r\t\x0c")


def _clean(text: str) -> bool:
    """Whether no code point is odd; of what is odd only U+FFFD is printable."""
    return LOST not in text and (text.isprintable() or not any(map(_odd, set(text))))


def family(text: str) -> str:
    """The script whose dictionaries suit a text: one other than Latin that has at least a seventh of its letters, else Latin."""
    if not _BEYOND_LATIN.search(text):
        return "Latin"
    other = "".join(_BEYOND_LATIN.findall(text))
    script = script_of(other)
    return script if script and 7 * sum(map(str.isalpha, other)) >= sum(map(str.isalpha, text)) else "Latin"


@lru_cache(maxsize=65_536)
def _everyday(c: str) -> bool:
    """Whether a character is in a national set of everyday use: GB 2312, Big5, JIS X 0208 or KS X 1001."""
    for codec in ("gb2312", "big5", "shift_jis", "euc_kr"):
        try:
            c.encode(codec)
            return True
        except UnicodeEncodeError:
            pass
    return False


class Describer:
    """Bytes needed to describe a text: the least over the dictionaries of its script's languages."""

    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        self.by_script: dict[str, list] = {}
        for name, raw in sorted(dictionaries.items()):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            options = dict(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
            self.by_script.setdefault(name.split(":")[0], []).append(zstandard.ZstdCompressor(**options))
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)

    def cost(self, text: str, least: float = float("inf")) -> float:
        """The cost of ``text``; infinity if its code points that are no text alone cost ``least``."""
        odd = 0 if _clean(text) else ODD_COST * sum(map(_odd, text))
        if odd >= least:
            return float("inf")
        raw = text.encode("utf-8", "surrogatepass")
        return min(len(c.compress(raw)) for c in self.by_script.get(family(text)) or [self.plain]) + odd


def readings(payload: bytes, declared: str | None) -> Iterator[tuple[str, str]]:
    """Other texts that ``payload`` may hold, by the codec that gives them."""
    for codec in CODECS:
        try:
            yield codec, payload.decode(codec)
        except UnicodeDecodeError:
            if codec.startswith("utf-16") and declared is None and len(payload) > 2:  # cut in mid-character
                try:
                    yield f"{codec}, cut", payload[: len(payload) // 2 * 2].decode(codec, "ignore")
                except UnicodeDecodeError:
                    pass
    yield "gsm7 packed", gsm_text(unpack_septets(payload)).rstrip("@\r")


def _of_ascii(payload: bytes) -> Iterator[tuple[str, str]]:
    """Other readings of a payload that reads as printable ASCII: UTF-16 in everyday East Asian characters, and packed septets."""
    if len(payload) % 2 == 0:
        for codec in ("utf-16-be", "utf-16-le"):
            text = payload.decode(codec, "replace")
            if all(c >= "\u2e80" and _everyday(c) for c in text):
                yield codec, text
    yield "gsm7 packed", gsm_text(unpack_septets(payload)).rstrip("@\r")


def diagnose(payload: bytes, declared: str | None, describe: Describer) -> tuple[str | None, str | None]:
    """``(chain, text)`` that describes the payload in the fewest bytes; chain None: leave it.

    The chain ``lost`` means that characters are gone (U+FFFD); then ``text`` is
    the best there is. Of printable ASCII the other readings that can be are
    UTF-16 in everyday ideographs and packed septets.
    """
    plain = declared is not None and declared.isascii() and declared.isprintable()
    best_chain, best = None, declared
    base = describe.cost(declared) if declared else float("inf")
    least = base
    known = {declared}

    def offer(chain: str, text: str | None, steps: int, saving: float) -> None:
        nonlocal best_chain, best, least
        if not text or text in known or LOST in text and LOST not in (declared or ""):
            return
        known.add(text)
        cost = describe.cost(text, least) + STEP_COST * steps
        if cost < least and (least == float("inf") or cost <= least * (1 - saving)):
            best_chain, best, least = chain, text, cost

    bases = [("", declared)] if declared else []
    for codec, text in _of_ascii(payload) if plain else readings(payload, declared):
        offer(codec, one_line(text), 1, READING_SAVING if codec not in ("utf-8", "cp1252") else 0.0)
        if codec in ("cp1252", "utf-8", "utf-16-be", "utf-16-le"):
            bases.append((codec, one_line(text)))
    for name, text in bases:
        if not text or text.isascii():
            continue
        for depth in (1, 2):
            once = undouble(text)
            if once == text:
                break
            offer(" > ".join(filter(None, [name, f"utf-8 x{depth}"])), once, depth + bool(name), 0.0)
            text = once
        if name == "":
            for codec in ("cp1251", "iso8859-7", "koi8-r"):
                offer(f"{codec} reread", reread(declared, codec), 1, READING_SAVING)
    if best_chain is None and declared and LOST in declared:
        return "lost", declared
    return best_chain, best


def train_dictionaries(messages: DataFrame, documents: DataFrame, *, source: str = "SMPP", part_bytes: int = PART_BYTES) -> dict[str, bytes]:
    """zstandard dictionaries by ``script:language`` from all sound texts, each different one counted once.

    ``messages`` has ``content`` (hex) and ``dcs``; ``documents`` has ``text,
    lang``. A message trains the dictionary of the language whose documents
    describe it in the fewest bytes. Texts with lost, control or private
    characters, or which contain doubled UTF-8, train nothing; Chinese ones
    train only if their characters are in everyday use (GB 2312). Languages of
    fewer than ``LEAST_TEXTS`` texts have no dictionary.

    Whole texts of any number and length: what a language has beyond
    ``part_bytes`` is trained in parts, whose dictionaries are merged
    (:func:`_trained`). Only finished dictionaries reach the driver.
    """
    if part_bytes < 4 * DICTIONARY_BYTES:
        raise ValueError(f"part_bytes must be at least {4 * DICTIONARY_BYTES}")
    labelled = materialize(documents.where("text <> ''").select("text", "lang").mapInArrow(_by_label, "name string, text string").distinct(), "labelled")
    spoken = _trained(labelled, part_bytes)

    def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, list[str]] = {}
        for name in sorted(spoken):  # the order of the describer's compressors
            names.setdefault(name.split(":")[0], []).append(name)
        compressors = Describer(spoken).by_script
        for b in batches:
            out = []
            for script, text in zip(b.column("script").to_pylist(), b.column("text").to_pylist()):
                raw = text.encode()
                sizes = [len(c.compress(raw)) for c in compressors.get(script, ())]
                out.append(names[script][sizes.index(min(sizes))] if sizes else f"{script}:")
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), b.column("text")], names=["name", "text"])

    def declared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [_declared(c, d, source) for c, d in zip(b.column("content").to_pylist(), b.column("dcs").to_pylist())]
            scripts = list(map(_sound, texts))
            sound = [t for t, script in zip(texts, scripts) if script]
            yield pa.RecordBatch.from_arrays([pa.array([x for x in scripts if x], pa.string()), pa.array(sound, pa.string())], names=["script", "text"])

    different = messages.where("content <> ''").select("content", "dcs").mapInArrow(declared, "script string, text string").distinct()
    written = materialize(different.mapInArrow(by_language, "name string, text string"), "written")
    return _trained(written.unionAll(labelled), part_bytes)


def _by_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``name, text`` of the documents that may train a dictionary."""
    for b in batches:
        out = [(f"{script}:{(lang or '').strip().lower()}", text) for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()) if (script := _sound(text))]
        names, texts = zip(*out) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["name", "text"])


def _trained(texts: DataFrame, part_bytes: int) -> dict[str, bytes]:
    """A dictionary for each name of ``name, text``, trained on all of its texts.

    A name's texts are split by hash into parts of about ``part_bytes``, so
    that each is like the whole. The parts' dictionaries, cut in pieces, are
    the texts of the next round, until there is one for each name. The names'
    bytes lie one after the other; a task takes what starts in its stretch of
    ``part_bytes``, hence at most about twice that.
    """
    sizes = texts.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).where(F.col("n") >= LEAST_TEXTS)
    before = F.coalesce(F.sum("bytes").over(Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a name
    while True:
        parts = materialize(sizes.select("name", F.ceil(F.col("bytes") / part_bytes).alias("parts"), F.floor(before / part_bytes).alias("first")), "parts")
        most, tasks = parts.agg(F.max("parts"), F.max(F.col("first") + F.col("parts"))).first()
        if most is None:
            return {}
        hashed = texts.join(broadcast_if_small(parts), "name").withColumn("hash", F.xxhash64("text"))
        task = (F.col("first") + F.pmod("hash", "parts")).cast("int")
        trained = hashed.repartitionById(tasks, task).select("name", "hash", "text").mapInArrow(_train_parts, "name string, text binary")
        if most == 1:
            return {r["name"]: bytes(r["text"]) for r in trained.collect()}
        texts = materialize(trained, "dictionaries")
        sizes = texts.groupBy("name").agg(F.sum(F.octet_length("text")).alias("bytes"))


def _train_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The dictionary of each name's texts in a task, or of its dictionaries (binary); a single dictionary stays as it is."""
    if not (held := list(batches)):
        return
    groups: dict[str, list] = {}
    table = pa.Table.from_batches(held).sort_by([("name", "ascending"), ("hash", "ascending"), ("text", "ascending")])
    for name, text in zip(table.column("name").to_pylist(), table.column("text").to_pylist()):
        groups.setdefault(name, []).append(text)
    for name, texts in groups.items():
        if isinstance(texts[0], str):
            raw = _train([t[i : i + TRAIN_CHARS].encode() for t in texts for i in range(0, len(t), TRAIN_CHARS)])
        elif len(texts) == 1:
            raw = texts[0]
        else:
            contents = [t[t.find(OFFSETS) + len(OFFSETS) :] if OFFSETS in t else t for t in texts]
            raw = _train([t[i : i + MERGE_BYTES] for t in contents for i in range(0, len(t), MERGE_BYTES)])
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([raw], pa.binary())], names=["name", "text"])


def _sound(text: str | None) -> str | None:
    """The script of a text that may train a dictionary, else None."""
    if not text or not _clean(text) or undouble(text) != text or _LATIN_RUN.search(text):
        return None
    script = family(text)
    if script == "Han":
        try:
            "".join(c for c in text if c >= "\u3400").encode("gb2312")
        except UnicodeEncodeError:
            return None
    return script


def _body(content: str | None) -> bytes:
    """The payload without its header; empty for contents that are no whole hex bytes."""
    payload = whole_bytes(content) or b""
    header = read_header(payload)
    return payload[1 + header.length :] if header else payload


def _declared(content: str | None, dcs: int | None, source: str) -> str | None:
    return decode_text(_body(content), None if dcs is None else dcs % 256, source)[0]


def _train(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, split_point=1.0).as_bytes()  # else a quarter is only tested on
    except zstandard.ZstdError:  # too little text to train on: the text itself
        return b"\n".join(samples)[-DICTIONARY_BYTES:]


def restore_text(records: DataFrame, dictionaries: dict[str, bytes], *, key: str = "reference", source: str = "SMPP") -> DataFrame:
    """What each record's payload says, and by which chain of encodings.

    ``records`` has ``key``, ``content`` (hex) and ``dcs`` (perhaps signed);
    other columns are ignored. One row per record whose content is whole hex
    bytes: ``key, declared`` (the project's decoding, null where it fails),
    ``chain`` (null: the declared text stands; ``lost``: characters are gone for
    good) and ``restored`` (the text of least description length; null if
    nothing reads the bytes). Null, empty or broken contents have no row.

    All candidate decodings - other readings of the bytes, and one or two
    layers of UTF-8 read as a one-byte encoding, also in part of the text - are
    compressed with the dictionaries of their script's languages. The chain of
    least bytes wins, each step costing half a byte and each code point that is no
    text four; a wholly different reading must also save 15 per
    cent against what keeps bytes as they are. One
    narrow Arrow pass; the dictionaries (16 KB each) travel with the tasks.
    """
    kind = dict(records.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        describe = Describer(dictionaries)
        for b in batches:
            out: list[tuple] = []
            for ref, content, dcs in zip(b.column(key).to_pylist(), b.column("content").to_pylist(), b.column("dcs").to_pylist()):
                body = _body(content)
                if not body:
                    continue
                declared = decode_text(body, None if dcs is None else dcs % 256, source)[0]
                chain, text = diagnose(body, declared, describe)
                safe = lambda t: t if t is None else t.encode("utf-8", "replace").decode()
                out.append((ref, safe(declared), chain, safe(text)))
            refs, declareds, chains, restored = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(refs, b.column(key).type), pa.array(declareds, pa.string()), pa.array(chains, pa.string()), pa.array(restored, pa.string())], names=[key, "declared", "chain", "restored"])

    return records.select(key, "content", "dcs").mapInArrow(run, f"`{key}` {kind}, declared string, chain string, restored string")
