"""Repetition inside single documents, screened by tokeniser fertility."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tokens import TOKENIZERS, piece_bpe, piece_kinds
from tidemark.llm.words import words
from tidemark.runtime import broadcast_if_small, materialize

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
FIELDS = "n_words long, tokens long, chars_per_token double, byte_share double, token_entropy double, missing_bits double, rate double, script string"
MEASURES = ("chars_per_token", "byte_share", "token_entropy")
MEMO, MEMO_CHARS = 100_000, 64  # pieces between blanks whose tokens a worker remembers, and how long they may be
_WORD = re.compile("[A-Za-z0-9]+")


def repeated_sequences(docs: DataFrame, key: str = "doc_id", *, n: int = 5, reject_at: float = 0.30, min_words: int = 50, tokenizers: str = TOKENIZERS) -> DataFrame:
    """Documents in which at least ``reject_at`` of the ``n``-word sequences are repeats: ``key, n_words, repeated_share``.

    Every document's tokeniser fertility is measured and written
    (:func:`fertility`); bands per language or script reject what cannot be
    such a document (:func:`fertility_bands`); the others are counted exactly
    (:func:`repeated_shares`). Documents of fewer than ``min_words`` words, null
    and blank texts, and null keys are no cases; rows of one key count for
    themselves. What is joined back to the texts is the keys that no band
    rejected.
    """
    measured = materialize(fertility(docs.where(F.col(key).isNotNull()), key, n=n, tokenizers=tokenizers), "fertility")
    left = fertility_bands(measured, reject_at=reject_at).where(~F.col("rejected") & (F.col("n_words") >= max(n, min_words))).select(key).distinct()
    suspects = docs.select(key, "text").join(broadcast_if_small(left), key, "left_semi")
    return repeated_shares(suspects, key, n=n).where((F.col("n_words") >= min_words) & (F.col("repeated_share") >= reject_at))


def repeated_shares(docs: DataFrame, key: str = "doc_id", *, n: int = 5) -> DataFrame:
    """``key, n_words, repeated_share`` of each row: 1 - different / all ``n``-word sequences.

    The share is null below ``n`` words, hence for null and blank texts. One
    narrow pass over whole texts, exact.
    """
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ws = [joined.split() if joined else [] for joined in b.column("ws").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array([len(w) for w in ws], pa.int64()), pa.array([repeated_share(w, n) for w in ws], pa.float64())], names=[key, "n_words", "repeated_share"])

    return docs.select(F.col(key), F.array_join(words(F.col("text")), " ").alias("ws")).mapInArrow(run, f"`{key}` {kind}, n_words long, repeated_share double")


def fertility(docs: DataFrame, key: str = "doc_id", *, n: int = 5, tokenizers: str = TOKENIZERS) -> DataFrame:
    """How a public vocabulary takes each document.

    ``docs`` has ``key``, ``text`` and perhaps ``lang``; other columns are
    ignored. One row per input row: ``key, lang, n_words`` and

    * of the whole text: ``tokens``, ``chars_per_token``, ``byte_share`` (tokens
      that are byte fallbacks), ``token_entropy`` in bits (null without
      tokens), and the ``script`` of most letters (fixed names; null without);
    * of its words, tokenised one by one: ``missing_bits``, by which the entropy
      of blocks of ``n`` consecutive tokens stays below what it would be if
      all blocks were different, and ``rate``, the word sequences per block
      (null below ``n`` words).

    One narrow pass, whole texts however long. A vocabulary never joins what
    a blank parts, so the tokens of pieces between blanks are remembered.
    """
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    kind = dict(docs.dtypes)[key]
    schema = f"`{key}` {kind}, lang string, " + FIELDS
    return docs.select(F.col(key), "text", lang.alias("lang")).mapInArrow(lambda batches: _measure(batches, key, n, tokenizers), schema)


#: First code points of scripts other than Latin, with their last ones; fixed values of the Unicode blocks.
SCRIPTS = (("Greek", 0x370, 0x3FF), ("Cyrillic", 0x400, 0x52F), ("Arabic", 0x600, 0x6FF), ("Devanagari", 0x900, 0x97F), ("Tamil", 0xB80, 0xBFF), ("Malayalam", 0xD00, 0xD7F), ("Thai", 0xE00, 0xE7F), ("Kana", 0x3040, 0x30FF), ("Han", 0x3400, 0x9FFF), ("Hangul", 0xAC00, 0xD7A3))


@lru_cache(maxsize=65_536)
def _script(c: str) -> str | None:
    """A letter's script; None for what is no letter."""
    return next((name for name, a, b in SCRIPTS if a <= ord(c) <= b), "Latin" if ord(c) < 0x370 else "Other") if c.isalpha() else None


def script_of(text: str) -> str | None:
    """The script of most letters of ``text``; of equally frequent ones the first in code point order."""
    if text.isascii():
        return "Latin" if any(map(str.isalpha, text)) else None
    totals: dict[str | None, int] = {}
    for c, times in Counter(text).items():
        name = _script(c)
        totals[name] = totals.get(name, 0) + times
    known = [(totals[name], name) for name in ("Latin", *(s[0] for s in SCRIPTS)) if name in totals]
    return max(known, key=lambda x: x[0])[1] if known else "Other" if "Other" in totals else None


def entropy(ids: np.ndarray) -> float:
    counts = np.unique(ids, return_counts=True)[1] if len(ids) else np.array([1])
    p = counts / counts.sum()
    return float(-(p * np.log2(p)).sum()) + 0.0


def repeated_share(ws: list[str], n: int) -> float | None:
    """1 - different / all ``n``-word sequences, compared exactly; null without one."""
    if len(ws) < n:
        return None
    codes: dict[str, int] = {}
    ids = np.array([codes.setdefault(w, len(codes)) for w in ws], dtype=np.int64)
    rank = ids
    for step in range(1, n):  # the rank of a longer sequence from those of its prefix and its last word
        pair = rank[: len(ids) - step] * len(codes) + ids[step:]
        rank = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    return (len(rank) - int(rank.max()) - 1) / len(rank)


def fertility_bands(measured: DataFrame, *, reject_at: float = 0.30, spread: float = 4.0) -> DataFrame:
    """Bands of fertility per language or else script, and which documents they reject as not repetitive.

    ``measured`` comes from :func:`fertility`. The group of a row is its
    language in lower case without blanks, or its script where the language is
    missing. For each group and measure (characters per token, byte share,
    token entropy) the band is the median plus and minus ``spread`` times the
    mean absolute deviation, over all rows. Adds ``band`` (the group), ``odd``
    (an array naming the measures outside their band), ``limit`` and ``rejected``.

    A row is rejected if it is inside all bands of its group and its
    ``missing_bits`` are below the group's ``limit``. No document of which
    ``reject_at`` of the word sequences are repeats is: words are tokenised one
    by one, so equal word sequences have equal tokens, and as a word has at
    least one token, the blocks that start in a sequence's first word lie inside
    the sequence. Let T blocks start in the first words of S sequences. If at
    least ``reject_at * S`` sequences repeat an earlier one, the blocks have at
    most T - reject_at * S different values, so at least
    -log2(1 - reject_at * S / T) bits are missing. The group's limit is that
    for its least rate S / T, of all rows inside the bands. Odd rows and those
    below ``n`` words are never rejected. Two map-side aggregations; what is joined
    back is one row per group, and only broadcast if that is small by count.
    """
    lang = F.lower(F.trim("lang"))
    named = measured.withColumn("band", F.coalesce(F.when(lang != "", lang), F.concat(F.lit("script:"), F.coalesce("script", F.lit("none")))))
    centre = named.groupBy("band").agg(*[F.percentile_approx(m, 0.5, 10_000).alias(f"mid_{m}") for m in MEASURES])
    placed = named.join(broadcast_if_small(centre), "band")
    width = placed.groupBy("band").agg(*[F.avg(F.abs(F.col(m) - F.col(f"mid_{m}"))).alias(f"dev_{m}") for m in MEASURES])
    full = placed.join(broadcast_if_small(width), "band")
    odd = F.array(*[F.when(F.abs(F.col(m) - F.col(f"mid_{m}")) > spread * F.col(f"dev_{m}"), F.lit(m)) for m in MEASURES])
    full = full.withColumn("odd", F.array_compact(odd)).drop(*[f"{a}_{m}" for a in ("mid", "dev") for m in MEASURES])
    ordinary = (F.size("odd") == 0) & F.col("rate").isNotNull()
    limits = full.where(ordinary).groupBy("band").agg((-F.log2(1 - reject_at * F.min("rate"))).alias("limit"))
    return full.join(broadcast_if_small(limits), "band", "left").withColumn("rejected", F.coalesce(ordinary & (F.col("missing_bits") < F.col("limit") - 1e-9), F.lit(False)))


def _measure(batches: Iterator[pa.RecordBatch], key: str, n: int, folder: str) -> Iterator[pa.RecordBatch]:
    sp, is_byte = piece_bpe(folder), piece_kinds(folder)
    memo: dict[str, tuple[list[int], list[int], list[int]]] = {}
    known: dict[str, list[int]] = {}

    def word(w: str) -> list[int]:
        got = known.get(w)
        if got is None:
            if len(known) >= MEMO:
                known.clear()
            got = known[w] = sp.encode(w)
        return got

    def tokens(piece: str) -> tuple[list[int], list[int], list[int]]:
        """The piece's tokens, its words' tokens, and how many each word has."""
        found = _WORD.findall(piece)
        if len(found) == 1 and found[0] == piece and piece.islower():
            ids = own = word(piece)
            lengths = [len(own)]
        else:
            each = [word(w.lower()) for w in found]
            ids, own, lengths = sp.encode(piece), [t for w in each for t in w], [len(w) for w in each]
        if len(piece) <= MEMO_CHARS:
            if len(memo) >= MEMO:
                memo.clear()
            memo[piece] = ids, own, lengths
        return ids, own, lengths

    for batch in batches:
        out: dict[str, list] = {f.split()[0]: [] for f in FIELDS.split(", ")}
        for text in batch.column("text").to_pylist():
            if not text:
                for column, v in zip(out.values(), (0, 0, *[None] * 6)):
                    column.append(v)
                continue
            pieces = [memo.get(piece) or tokens(piece) for piece in text.split(" ")]
            ids, flat, lengths = (np.fromiter(chain.from_iterable(p[i] for p in pieces), kind) for i, kind in enumerate((np.int64, np.uint64, np.int64)))
            if "  " in text or text[0] == " " or text[-1] == " ":  # blanks beside each other are tokens of their own
                ids = np.array(sp.encode(text), np.int64)
            missing = rate = None
            if len(lengths) >= n:
                started = len(lengths) - n + 1
                heads = int(lengths[:started].sum())
                block = np.zeros(heads, np.uint64)
                for j in range(n):  # equal blocks have equal sums; a collision only adds missing bits
                    block = block * MULTIPLIER + flat[j : j + heads]
                missing, rate = float(np.log2(heads)) - entropy(block), started / heads
            for column, v in zip(out.values(), (len(lengths), len(ids), len(text) / len(ids) if len(ids) else None, float(is_byte[ids].mean()) if len(ids) else None, entropy(ids) if len(ids) else None, missing, rate, script_of(text))):
                column.append(v)
        kinds = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}
        yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("lang"), *(pa.array(out[f.split()[0]], kinds[f.split()[1]]) for f in FIELDS.split(", "))], names=[key, "lang", *out])
