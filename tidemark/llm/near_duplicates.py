"""Near-duplicate texts by multi-index hashing of their word sets."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.runtime import broadcast_if_small, materialize

HOT_PAIRS = 1_000_000  # candidate pairs of one table entry above which it is split by further words
MOST_SPLITS = 4  # splits of an entry; what is hot still is compared in blocks
BLOCK_SETS = 1_000  # sets of such a block, and copies of one class that meet in a task
PART_ENTRIES = 2_000_000  # table entries that one task holds
SEND_ENTRIES = 1_000_000  # table entries that a task packs at a time
SAMPLE = 20_000  # sets, at most, in which entries shared by a large share of all sets are looked for
KEY_BITS = np.uint64(32)  # of an entry's key, beside the number of its part
SKETCH_BITS = 48
ONE = np.uint64(1)
ASKS, SIZE = np.uint8(128), np.uint8(127)  # one byte: whether an entry asks, and its set's size (127: that or more)


# --- building blocks -------------------------------------------------------------------


def word_set(text: Column, min_length: int) -> Column:
    """The different words of ``min_length`` or more characters, in lower case, sorted."""
    cut = F.split(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), "[^A-Za-z0-9]+", " ")), " ")
    return F.sort_array(F.array_distinct(F.filter(cut, lambda w: F.length(w) >= min_length)))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x


def most_apart(n: np.ndarray, limit: Fraction) -> np.ndarray:
    """The largest symmetric difference of a set of ``n`` words and any set alike to ``limit``."""
    p, q = limit.numerator, limit.denominator
    top = n * q // p
    best = np.zeros_like(n)
    for back in range(p + q):  # as partners grow, so does the difference, but for its parity
        b = np.maximum(top - back, n)
        best = np.maximum(best, n + b - 2 * -(-p * (n + b) // (p + q)))
    return best


def segments_of(size_class: int) -> int:
    """Four words or so to a segment."""
    return 4 if size_class == 0 else 5 << size_class - 1


def size_class(n: np.ndarray) -> np.ndarray:
    """0 below 20 words, then one class for each doubling."""
    return np.where(n < 20, 0, np.floor(np.log2(np.maximum(n, 20) / 20)).astype(np.int64) + 1)


class Sets:
    """Word sets: ``flat`` words (scrambled), set by set, with the set each belongs to, and how many each has."""

    def __init__(self, owner: np.ndarray, flat: np.ndarray, n: np.ndarray) -> None:
        self.owner, self.flat, self.n = owner, flat, n


NO_ORDER = (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def read_sets(words: pa.ListArray, order: tuple[np.ndarray, np.ndarray] = NO_ORDER) -> Sets:
    """Word sets with each set's words from rare to frequent: by ``order`` (words and how often), then by hash."""
    n = np.diff(words.offsets.to_numpy()).astype(np.int64)
    flat = mix64(words.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    owner = np.repeat(np.arange(len(n)), n)
    known, often = order
    if len(known):
        at = np.minimum(np.searchsorted(known, flat), len(known) - 1)
        flat = flat[np.lexsort((flat, np.where(known[at] == flat, often[at], 0), owner))]
    return Sets(owner, flat, n)


def fingerprints(b: Sets) -> np.ndarray:
    """48-bit parity sketches: two sets' Hamming distance never exceeds their symmetric difference."""
    cell = ((b.flat >> np.uint64(32)) % np.uint64(SKETCH_BITS)).astype(np.int64)
    odd = np.bincount(b.owner * 64 + cell, minlength=len(b.n) * 64).reshape(-1, 64) & 1
    return np.packbits(odd.astype(np.uint8), axis=1, bitorder="little").view(np.uint64).ravel()


def entries(b: Sets, rows: np.ndarray, budget: np.ndarray, classes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """Table entries ``(key, set, radius, deletions, segments, segment)`` of the sets ``rows``, segment by segment.

    A set's words fall into ``m`` segments by hash. Two sets that differ in at
    most ``budget`` words differ in some segment ``i`` by at most its radius,
    where the radii and one each add up to budget + 1. Within a segment the ball
    of that radius is enumerated from below: the segment's words with up to
    ``radius`` of them left out. Sets X and Y within the radius then share an
    entry. ``segments`` has the segment of every word of ``b``, for splitting.
    """
    for c in np.unique(classes):
        m = segments_of(int(c))
        chosen = rows[classes == c]
        mine = np.zeros(len(b.n), bool)
        mine[chosen] = True
        segment = ((mix64(b.flat + ONE) >> np.uint64(20)) % np.uint64(m)).astype(np.int64)
        words = np.flatnonzero(mine[b.owner])
        words = words[np.argsort(segment[words], kind="stable")]
        ends = np.searchsorted(segment[words], np.arange(m + 1))
        for i in range(m):
            radius = np.full(len(b.n), -1)
            radius[chosen] = -(-(budget[chosen] + 1 - i) // m) - 1
            able = chosen[radius[chosen] >= 0]
            if not len(able):
                break
            here = words[ends[i] : ends[i + 1]]
            sums = np.zeros(len(b.n), np.uint64)
            np.add.at(sums, b.owner[here], b.flat[here])
            tag = np.uint64(((int(c) << 32) + i + 1) * 0x9E3779B97F4A7C15 % 2**64)
            yield mix64(sums[able] + tag), able, radius[able], np.zeros(len(able), np.int64), segment, i
            one = here[radius[b.owner[here]] >= 1]
            if len(one):
                r = b.owner[one]
                yield mix64(sums[r] - b.flat[one] + tag), r, radius[r], np.ones(len(one), np.int64), segment, i
            for depth in range(2, int(radius.max(initial=0)) + 1):
                k, r = _left_out(b, here, sums, radius, depth)
                if len(k):
                    yield mix64(k + tag), r, radius[r], np.full(len(k), depth), segment, i


def _left_out(b: Sets, here: np.ndarray, sums: np.ndarray, radius: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment sums without any ``depth`` of the segment's words, for sets whose radius allows it."""
    from itertools import combinations

    here = here[radius[b.owner[here]] >= depth]
    r, words = b.owner[here], b.flat[here]
    starts = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]])) if len(r) else np.zeros(0, np.int64)
    lengths = np.diff(np.concatenate([starts, [len(r)]]))
    keys, rows = [], []
    for size in np.unique(lengths[lengths >= depth]):
        at = starts[lengths == size]
        block = words[at[:, None] + np.arange(size)]
        for pick in combinations(range(size), depth):
            keys.append(sums[r[at]] - block[:, pick].sum(axis=1, dtype=np.uint64))
            rows.append(r[at])
    return (np.concatenate(keys), np.concatenate(rows)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def short_key(keys: np.ndarray, parts: int) -> np.ndarray:
    """The number of an entry's part and 32 more bits of its key, in one integer."""
    return ((keys >> KEY_BITS) * np.uint64(parts) >> np.uint64(32) << KEY_BITS) | keys & np.uint64((1 << 32) - 1)


@dataclass
class Path:
    """Hot entries that are being split: the words outside their segment, and how far these were followed.

    Of the ``length`` words from ``first``, in order of rarity, ``common`` ones up
    to position ``at`` are those that a pair shares; ``apart`` may be unshared.
    """

    key: np.ndarray
    row: np.ndarray
    asks: np.ndarray
    met: np.ndarray
    first: np.ndarray
    length: np.ndarray
    apart: np.ndarray
    at: np.ndarray
    common: np.ndarray

    def take(self, rows: np.ndarray) -> Path:
        return Path(*(getattr(self, f.name)[rows] for f in fields(self)))

    def children(self, words: np.ndarray) -> Path:
        """One entry for each word that may be the next one shared, and one for no further word if that may be."""
        last = np.minimum(self.apart + self.common, self.length - 1)
        times = np.maximum(last - self.at, 0)
        out = self.take(np.repeat(np.arange(len(times)), times))
        out.at = out.at + 1 + np.arange(len(out.at)) - np.repeat(np.cumsum(times) - times, times)
        out.common = out.common + 1
        out.key = mix64(out.key + words[out.first + out.at])
        end = self.take(np.flatnonzero(self.length - self.common <= self.apart))
        end.at = end.length
        end.key = mix64(end.key + ONE)
        return Path(*(np.concatenate([getattr(out, f.name), getattr(end, f.name)]) for f in fields(self)))


@dataclass
class Splits:
    """Which keys are split: ``common`` ones before they are sent, ``hot`` ones after they were met in an earlier turn."""

    common: np.ndarray
    hot: np.ndarray
    turn: int


def table_entries(b: Sets, limit: Fraction, parts: int, splits: Splits) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(key, set, asks)`` of the entries whose turn it is, hot ones split.

    A hot entry is split by the words outside its segment. At most ``apart`` =
    (1 - limit) * size words of a set, less those left out already, are missing
    in a partner, so in order of rarity the first word that both share is among
    the first ``apart + 1`` of either: the entry is split by these, and if need
    be by the next word shared, and so on. Entries in ``common`` were never
    met; what a ``hot`` one is split into comes in the turn after that which met
    it. Of a pair's two entries that with fewer words left out asks; only pairs
    with one that asks are candidates.
    """
    p, q = limit.numerator, limit.denominator
    budget, apart = most_apart(b.n, limit), b.n - -(-p * b.n // q)
    own, largest = size_class(b.n), size_class(b.n * q // p)
    firsts = np.concatenate([[0], np.cumsum(b.n)])
    for step in range(int((largest - own).max(initial=0)) + 1):  # partners may be of a larger class
        rows = np.flatnonzero(own + step <= largest)
        for k, r, radius, deleted, segment, i in entries(b, rows, budget, (own + step)[rows]):
            key, asks = short_key(k, parts), deleted <= radius // 2
            known, seen = _within(key, splits.common), _within(key, splits.hot)
            if splits.turn == 0 and not (known | seen).all():
                yield key[~known & ~seen], r[~known & ~seen], asks[~known & ~seen]
            at = np.flatnonzero((known | seen) & (deleted <= apart[r]) & ((seen & ~known) <= splits.turn))
            if len(at):
                sets = r[at]
                lengths = b.n[sets]
                words = np.repeat(firsts[sets] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
                outside = segment[words] != i
                left = np.bincount(np.repeat(np.arange(len(at)), lengths)[outside], minlength=len(at))
                begin = np.full(len(at), -1)
                path = Path(k[at], sets, asks[at], (seen & ~known)[at].astype(np.int64), np.cumsum(left) - left, left, apart[sets] - deleted[at], begin, begin + 1)
                yield from _descend(path, b.flat[words[outside]], parts, splits)


def _descend(path: Path, words: np.ndarray, parts: int, splits: Splits) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    path = path.children(words)
    key = short_key(path.key, parts)
    known, seen = _within(key, splits.common), _within(key, splits.hot)
    now = ~known & ~seen & (path.met == splits.turn)
    if now.any():
        yield key[now], path.row[now], path.asks[now]
    path.met = path.met + (seen & ~known)
    at = np.flatnonzero((known | seen) & (path.met <= splits.turn))
    if len(at):
        yield from _descend(path.take(at), words, parts, splits)


def _within(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def rarity(sample: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The words that at least five of the sampled sets have, sorted by hash, and how many have them."""
    words, often = np.unique(read_sets(sample).flat, return_counts=True)
    return words[often >= 5], often[often >= 5]


def common_keys(sample: Sets, limit: Fraction, parts: int, scale: float, hot_pairs: int) -> np.ndarray:
    """Keys that so many sampled sets have that, at ``scale`` times as many sets, their pairs must exceed ``hot_pairs``."""
    found = np.zeros(0, np.uint64)
    for _ in range(MOST_SPLITS):
        keys = [k for k, _, _ in table_entries(sample, limit, parts, Splits(found, found[:0], 0))]
        different, times = np.unique(np.concatenate(keys), return_counts=True) if keys else (found, found)
        new = different[(times >= 20) & ((times * scale) ** 2 > 2 * hot_pairs)]
        if not len(new):
            break
        found = np.union1d(found, new)
    return found


# --- the operator ----------------------------------------------------------------------


def near_duplicates(docs: DataFrame, *, key: str = "record_id", text: str = "text", threshold: str = "0.75", min_words: int = 12, min_length: int = 3) -> tuple[DataFrame, DataFrame]:
    """Classes of equal word sets, and the links between classes alike to ``threshold``.

    ``docs`` has ``key`` and ``text``; other columns are ignored. Returns
    ``(members, links)``: ``members`` has ``key, set_id`` for every key whose
    text has at least ``min_words`` different words of ``min_length`` or more
    characters (null keys, and null, blank and shorter texts, have no part in
    it; a repeated row is one member); ``links`` has ``set_a, set_b, jaccard``
    once for every two classes of which the common words are at least
    ``threshold`` of the words in either. Every link is found.

    Multi-index hashing. A word set's fingerprint has one coordinate per word
    and is cut into segments by hash of the word. From the sets' sizes follows
    the largest Hamming distance (symmetric difference) that two sets this alike
    may have; that budget is spread over the segments, and by the pigeonhole
    principle one segment is within its radius. For each segment, small Hamming
    balls are enumerated as table entries, entries of equal key meet, pairs are
    checked by size and by the distance of 48-bit parity sketches, and verified
    by complete distances, word for word.

    Scale: nothing depends on the number of sets but the number of parts. A set
    has some 26 entries of 25 words, packed into 13 bytes each, which are
    shuffled once, by part of the key space; a part has about ``PART_ENTRIES``
    of them whatever the data's size. Copies never meet: they are one class.
    A key whose pairs exceed ``HOT_PAIRS``, such as a campaign's common
    phrases, is counted exactly where its entries meet, and split in the next
    turn by the rarest remaining word that a pair shares, which is exact too
    (``table_entries``), as often as needed. Keys so common that a bounded sample shows it
    are split before they are ever sent, so none fills a task. What still is hot
    after ``MOST_SPLITS`` splits differs in hardly a word, so its pairs are
    links; they are compared in blocks of ``BLOCK_SETS``, by as many tasks.
    """
    limit, hot_pairs = Fraction(threshold), HOT_PAIRS
    p, q = limit.numerator, limit.denominator
    tokens = docs.where(F.col(key).isNotNull()).select(key, word_set(F.col(text), min_length).alias("_w")).where(F.size("_w") >= min_words)
    rows = materialize(tokens.select(key, F.xxhash64("_w").alias("set_id"), F.array_join("_w", " ").alias("words")), "rows")
    members = rows.select(key, "set_id").distinct()
    sets = materialize(rows.select("set_id", "words").distinct().withColumn("no", F.monotonically_increasing_id()), "sets")
    total = sets.count()
    hashes = F.transform(F.split("words", " "), lambda w: F.xxhash64(w)).alias("ws")
    parts = max(1, -(-total * 30 // PART_ENTRIES))
    share = min(1.0, 0.97 * SAMPLE / max(total, 1))
    sample = sets.where(F.pmod("set_id", F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select(hashes).limit(SAMPLE).toArrow()["ws"].combine_chunks()
    order = rarity(sample)
    common = common_keys(read_sets(sample, order), limit, parts, total / max(len(sample), 1), hot_pairs)

    pairs, hot = None, None
    for turn in range(MOST_SPLITS + 1):
        asked = sets.select("no", hashes, F.array().cast("array<bigint>").alias("hot")) if hot is None else sets.join(hot.groupBy("no").agg(F.collect_set("key").alias("hot")), "no").select("no", hashes, "hot")
        packed = asked.mapInArrow(lambda batches, t=turn: _pack(batches, limit, parts, order, common, t), "part int, data binary")
        met = materialize(packed.groupBy("part").applyInArrow(_meeting(limit, hot_pairs), "a long, b long, key long"), "met")
        found = met.where("key IS NULL").select("a", "b")
        pairs = found if pairs is None else pairs.unionByName(found)
        more = met.where("key IS NOT NULL").select(F.col("a").alias("no"), "key")
        if more.isEmpty():
            break
        hot = more if hot is None else hot.unionByName(more)
        if turn == MOST_SPLITS:
            pairs = pairs.unionByName(_in_blocks(more))
    ends = sets.select("no", "set_id", "words")
    a, b = (ends.select(F.col("no").alias(x), F.col("set_id").alias(f"set_{x}"), F.col("words").alias(f"words_{x}")) for x in "ab")
    checked = pairs.distinct().join(a, "a").join(b, "b").withColumns({"_a": F.split("words_a", " "), "_b": F.split("words_b", " ")})
    checked = checked.select("set_a", "set_b", F.size(F.array_intersect("_a", "_b")).alias("o"), (F.size("_a") + F.size("_b")).alias("s"))
    links = checked.where(F.col("o") * (p + q) >= F.col("s") * p)
    return members, materialize(links.select(F.least("set_a", "set_b").alias("set_a"), F.greatest("set_a", "set_b").alias("set_b"), (F.col("o") / (F.col("s") - F.col("o"))).alias("jaccard")), "links")


def _pack(batches: Iterator[pa.RecordBatch], limit: Fraction, parts: int, order: tuple[np.ndarray, np.ndarray], common: np.ndarray, turn: int) -> Iterator[pa.RecordBatch]:
    """Entries as bytes by part: the first set's number, then offsets to it, keys, sizes and sketches."""
    held: list[tuple[np.ndarray, ...]] = []
    first, waiting = 0, 0

    def send() -> pa.RecordBatch:
        key, no, size, sketch = (np.concatenate(x) for x in zip(*held))
        part = (key >> KEY_BITS).astype(np.int64)
        by = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], np.diff(part[by]) > 0]))
        data = []
        for at in np.split(by, cuts[1:]):
            data.append(b"".join(x.tobytes() for x in (np.array([first], np.int64), (no[at] - first).astype(np.uint16), key[at].astype(np.uint32), size[at], sketch[at].astype(np.uint32), (sketch[at] >> np.uint64(32)).astype(np.uint16))))
        return pa.RecordBatch.from_arrays([pa.array(part[by[cuts]].astype(np.int32)), pa.array(data, pa.binary())], names=["part", "data"])

    for batch in batches:
        if not batch.num_rows:
            continue
        every = batch.column("no").to_numpy()
        for at in _runs(every):  # numbers of one run differ by less than 2**16
            b, no = read_sets(batch.column("ws").take(pa.array(at)), order), every[at]
            hot = np.unique(batch.column("hot").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            if held and (waiting > SEND_ENTRIES or no[0] < first or no[-1] - first >= 1 << 16):
                yield send()
                held, waiting = [], 0
            if not held:
                first = int(no[0])
            sketch, size = fingerprints(b), np.minimum(b.n, int(SIZE)).astype(np.uint8)
            for key, r, asks in table_entries(b, limit, parts, Splits(common, hot, turn)):
                held.append((key, no[r], size[r] | np.where(asks, ASKS, np.uint8(0)), sketch[r]))
                waiting += len(key)
    if held:
        yield send()


def _runs(numbers: np.ndarray) -> list[np.ndarray]:
    """Positions in order of number, cut wherever the number's upper bits change."""
    order = np.argsort(numbers, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(numbers[order] >> 15)) + 1)


def _meeting(limit: Fraction, hot_pairs: int):  # noqa: ANN202
    """Candidate pairs ``(a, b, null)`` of one part's entries; those of a hot key as ``(a, null, key)``."""
    p, q = limit.numerator, limit.denominator

    def meet(part: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [d for b in batches for d in b.column("data").to_pylist()]
        n = [(len(d) - 8) // 13 for d in blobs]
        read = lambda kind, skip: np.concatenate([np.frombuffer(d, kind, k, 8 + skip * k) for d, k in zip(blobs, n)])
        no = read(np.uint16, 0).astype(np.int64) + np.repeat([int.from_bytes(d[:8], "little") for d in blobs], n)
        key, size = read(np.uint32, 2).astype(np.uint64), read(np.uint8, 6)
        sketch = read(np.uint32, 7).astype(np.uint64) | read(np.uint16, 11).astype(np.uint64) << np.uint64(32)
        order = np.argsort(key, kind="stable")
        key, no, size, sketch = key[order], no[order], size[order], sketch[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        lengths = np.diff(np.concatenate([starts, [len(key)]]))
        asks = size >= ASKS
        asking = np.add.reduceat(asks.astype(np.int64), starts)
        count = asking * lengths - asking * (asking + 1) // 2
        hot = np.repeat(count > hot_pairs, lengths)
        if hot.any():
            rows = np.flatnonzero(hot)
            name = key[rows] | np.uint64(part[0].as_py()) << KEY_BITS
            yield _met(no[rows], None, name)
        end = np.repeat(starts + lengths, lengths)
        live = np.flatnonzero(~hot & np.repeat(count > 0, lengths))
        after = end[live] - live - 1
        chunk = np.cumsum(after) // 4_000_000
        for at in np.split(np.arange(len(live)), np.flatnonzero(np.diff(chunk)) + 1):
            x, times = live[at], after[at]
            left = np.repeat(x, times)
            right = np.repeat(x + 1 - (np.cumsum(times) - times), times) + np.arange(times.sum())
            keep = (asks[left] | asks[right]) & (no[left] != no[right])
            left, right = left[keep], right[keep]
            s, t = (size[left] & SIZE).astype(np.int64), (size[right] & SIZE).astype(np.int64)
            apart = s + t - 2 * -(-p * (s + t) // (p + q))
            close = (np.minimum(s, t) * q >= np.maximum(s, t) * p) & (np.bitwise_count(sketch[left] ^ sketch[right]) <= apart)
            close |= (s == SIZE) | (t == SIZE)
            a, b = no[left[close]], no[right[close]]
            if len(a):
                both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
                yield _met(both[:, 0], both[:, 1], None)

    return meet


def _met(a: np.ndarray, b: np.ndarray | None, key: np.ndarray | None) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(a), none if b is None else pa.array(b), none if key is None else pa.array(key.view(np.int64))], names=["a", "b", "key"])


def _in_blocks(hot: DataFrame) -> DataFrame:
    """All pairs ``a, b`` of the sets of each key, by blocks of bounded size."""
    hot = hot.distinct()
    sizes = hot.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).cast("int").alias("blocks"))
    placed = hot.join(broadcast_if_small(sizes), "key").withColumn("own", F.pmod(F.xxhash64("no"), F.col("blocks")).cast("int"))
    first = placed.select("key", F.col("own").alias("i"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("j"), F.col("no").alias("a"))
    second = placed.select("key", F.explode(F.sequence(F.lit(0), "own")).alias("i"), F.col("own").alias("j"), F.col("no").alias("b"))
    met = first.join(second, ["key", "i", "j"]).where((F.col("i") < F.col("j")) | (F.col("a") < F.col("b")))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def expand_copies(members: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """All pairs of keys, smaller first, whose classes are linked or equal: columns ``a, b``.

    Classes of more than ``BLOCK_SETS`` copies are cut into blocks by hash of the
    key, and every block pair meets under a key of its own.
    """
    sizes = members.groupBy("set_id").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / BLOCK_SETS).cast("int").alias("blocks"))
    pairs = links.select("set_a", "set_b").unionByName(sizes.where("n > 1").select(F.col("set_id").alias("set_a"), F.col("set_id").alias("set_b")))
    large = broadcast_if_small(sizes.where("blocks > 1").select("set_id", "blocks"))
    placed = members.join(large, "set_id", "left").select("set_id", F.col(key).alias("k"), F.pmod(F.xxhash64(F.col(key)), F.coalesce("blocks", F.lit(1))).cast("int").alias("block"))
    blocks = lambda x: F.sequence(F.lit(0), F.coalesce(f"n_{x}", F.lit(1)) - 1)
    for x in "ab":
        pairs = pairs.join(large.select(F.col("set_id").alias(f"set_{x}"), F.col("blocks").alias(f"n_{x}")), f"set_{x}", "left")
    cells = pairs.withColumn("i", F.explode(blocks("a"))).withColumn("j", F.explode(blocks("b"))).where("set_a <> set_b OR i <= j").select("set_a", "i", "set_b", "j")
    first = cells.join(placed.select(F.col("set_id").alias("set_a"), F.col("block").alias("i"), F.col("k").alias("a")), ["set_a", "i"])
    second = placed.select(F.col("set_id").alias("set_b"), F.col("block").alias("j"), F.col("k").alias("b"))
    met = first.join(second, ["set_b", "j"]).where("set_a <> set_b OR i < j OR a < b")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def class_links(members: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """One row per key: its class, the copies in it, and the classes it is linked to."""
    sizes = members.groupBy("set_id").agg(F.count(F.lit(1)).alias("copies"))
    ends = links.select(F.col("set_a").alias("set_id")).unionByName(links.select(F.col("set_b").alias("set_id"))).groupBy("set_id").agg(F.count(F.lit(1)).alias("links"))
    return members.join(sizes.join(ends, "set_id", "left"), "set_id").select(key, F.col("set_id").alias("class_id"), "copies", F.coalesce("links", F.lit(0)).alias("links"))
