"""Raw records of both protocols to canonical messages, and messages from parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.decode import decode_payloads

CANONICAL = ["record_id", "source", "originator", "destination", "sender_id", "text", "timestamp", "dcs", "text_decode_failed", "imsi", "is_platform_token_message"]

# --- fixed values: signalling texts that are no content --------------------------------
PLATFORM_TOKEN = r"^\([A-Za-z0-9]{12}\)$"
ACTIVATION_PING = r"^REG-REQ\?v=\d+;t=[0-9A-Fa-f]+;r=\d+$"
# ---------------------------------------------------------------------------------------


def require(df: DataFrame, columns: list[str]) -> None:
    """Raise, naming them, if ``df`` lacks any of ``columns``."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def unsigned(dcs: Column) -> Column:
    """A coding scheme, perhaps a signed byte or text, as 0..255; null where it is no number."""
    return F.pmod(dcs.try_cast("int"), F.lit(256))


def parse_time(text: Column) -> Column:
    """ISO 8601 in its several spellings, as a timestamp without zone; offsets are taken to UTC, anything else gives null."""
    plain = F.regexp_replace(F.trim(text), "T", " ")
    return plain.try_cast("timestamp").cast("timestamp_ntz")


def keep_smpp(raw: DataFrame) -> DataFrame:
    """Submissions (operation 4), and operation 5 unless its message class says receipt (4); a null class stays."""
    esm = F.col("esm_class")
    return raw.where((F.col("smpp_operation") == 4) | ((F.col("smpp_operation") == 5) & ~esm.eqNullSafe(F.lit(4))))


def with_text(decoded: DataFrame, fallback: Column | None = None) -> DataFrame:
    """``text`` from the payload, else from ``fallback``; blank gives ``""`` and ``text_decode_failed``. No row is dropped."""
    text = F.coalesce(F.col("text"), fallback) if fallback is not None else F.col("text")
    blank = text.isNull() | (F.trim(F.translate(text, "\t\n\r\f ", "     ")) == "")
    return decoded.withColumns({"text_decode_failed": blank, "text": F.when(blank, "").otherwise(text)})


def parts_of(df: DataFrame, ref: Column, total: Column, part: Column) -> DataFrame:
    """``concat_ref, concat_total_parts, concat_part_num``; (null, 1, 1) for messages of one part."""
    single = total.isNull() | (total <= 1)
    return df.withColumns({"concat_ref": F.when(~single, ref.cast("long")), "concat_total_parts": F.when(single, 1).otherwise(total).cast("long"), "concat_part_num": F.when(single, 1).otherwise(part).cast("long")})


def smpp_canonical(raw: DataFrame) -> DataFrame:
    """Canonical messages of raw SMPP requests, with their part numbers.

    Header parts come before SAR parts. Undecodable rows are kept with empty
    text and the flag. Nulls stay null and blank parties become null; so is ``sender_id``
    then, for which windows put ``<NA>``.
    """
    require(raw, ["reference", "smpp_operation", "a_number", "b_number", "content", "dcs", "esm_class", "time_stamp"])
    rows = with_text(decode_payloads(keep_smpp(raw).withColumn("dcs", unsigned(F.col("dcs"))), "SMPP"))
    numbered = parts_of(rows, F.coalesce("udh_ref", "sar_ref"), F.coalesce("udh_total", "sar_msg_parts"), F.coalesce("udh_part", "sar_msg_part"))
    return _canonical(numbered, "SMPP", F.col("reference"), _known(F.col("a_number")), _known(F.col("b_number")), parse_time(F.col("time_stamp")), F.lit(None).cast("string"), F.lit(False))


def _known(number: Column) -> Column:
    """A party's number; null where it is blank."""
    return F.when(F.trim(number) != "", number)


def latest_routing(raw: DataFrame, key: str = "imsi") -> DataFrame:
    """The last routing answer of each key by time (ties: larger reference), nulls left out."""
    answers = raw.where((F.col("message_type") == 1) & F.col(key).isNotNull())
    return answers.groupBy(key).agg(F.max_by("vlr_address", F.struct("time_stamp", "reference")).alias("vlr_address"))


def ss7_canonical(raw: DataFrame) -> DataFrame:
    """Canonical messages of raw SS7 records: mobile-originated (3) and terminating requests (2).

    Delivery responses with a decision are dropped where the table has one. A
    terminating request takes the VLR of the latest routing answer of its IMSI
    (many to one; null without one). Signalling tokens are flagged and blanked.
    Where a party's number is null its global title stands in.
    """
    require(raw, ["reference", "message_type", "a_number", "b_number", "content", "dcs", "imsi", "time_stamp"])
    if "decision" in raw.columns:
        decision = F.col("decision").try_cast("double")
        raw = raw.where(~(F.col("message_type").isin(1, 4, 7) & decision.isNotNull() & (F.coalesce(decision, F.lit(0)) != 0)))
    mo = raw.where("message_type = 3").withColumn("vlr_address", F.lit(None).cast("string"))
    mt = raw.where("message_type = 2").drop("vlr_address").join(latest_routing(raw), "imsi", "left")
    rows = with_text(decode_payloads(mo.unionByName(mt), "SS7"))
    token = F.col("text").rlike(PLATFORM_TOKEN) | F.col("text").rlike(ACTIVATION_PING)
    marked = rows.withColumn("_token", token).withColumn("text", F.when(F.col("_token"), "").otherwise(F.col("text")))
    numbered = parts_of(marked, F.col("sarref"), F.col("msg_parts"), F.col("msg_part"))
    party = lambda number, title: F.coalesce(number, title) if title in numbered.columns else F.col(number)
    return _canonical(numbered, "SS7", F.col("reference"), party("a_number", "calling_gt"), party("b_number", "called_gt"), F.timestamp_millis(F.col("time_stamp")).cast("timestamp_ntz"), F.col("imsi"), F.col("_token"), "vlr_address")


def _canonical(df: DataFrame, source: str, record: Column, a: Column, b: Column, at: Column, imsi: Column, token: Column, *more: str) -> DataFrame:
    return df.select(
        record.alias("record_id"), F.lit(source).alias("source"), a.alias("originator"), b.alias("destination"), F.concat(F.lit(f"{source}|"), a).alias("sender_id"), "text", at.alias("timestamp"),
        F.col("dcs").cast("double").alias("dcs"), "text_decode_failed", imsi.alias("imsi"), token.alias("is_platform_token_message"), "concat_ref", "concat_total_parts", "concat_part_num", "codec", "udh_port", *more,
    )


def reassemble(messages: DataFrame) -> DataFrame:
    """One row per logical message: parts joined in order, single messages as they are.

    Parts belong together by (originator, destination, concat_ref,
    concat_total_parts), nulls being equal; rows with a null ``concat_ref``
    stand alone. The text is joined by part number (ties by record_id, null
    text empty); ``timestamp`` is the earliest, ``text_decode_failed`` is true
    if any part's is; other columns come from the lowest part. Adds
    ``message_part_count``, ``message_expected_parts`` and ``message_partial``
    (not each of 1..total exactly once).

    Single parts, the bulk, never reach the shuffle. Text is joined by an
    ordered aggregate over at most a message's parts.
    """
    single = messages.where("concat_ref IS NULL").withColumns({"message_part_count": F.lit(1).cast("long"), "message_expected_parts": F.lit(1).cast("long"), "message_partial": F.lit(False)})
    keys = ["originator", "destination", "concat_ref", "concat_total_parts"]
    rest = [c for c in messages.columns if c not in [*keys, "text", "timestamp", "text_decode_failed"]]
    part, order = F.col("concat_part_num"), F.struct("concat_part_num", "record_id")
    texts = F.array_sort(F.collect_list(F.struct("concat_part_num", "record_id", F.coalesce("text", F.lit("")).alias("text"))))
    n, total = F.count(F.lit(1)), F.col("concat_total_parts")
    joined = messages.where("concat_ref IS NOT NULL").groupBy(*keys).agg(
        F.array_join(F.transform(texts, lambda p: p["text"]), "").alias("text"), F.min("timestamp").alias("timestamp"), F.bool_or("text_decode_failed").alias("text_decode_failed"),
        F.min_by(F.struct(*rest), order).alias("_rest"), n.alias("message_part_count"), F.count_distinct(part).alias("_kinds"), F.min(part).alias("_lo"), F.max(part).alias("_hi"),
    )
    whole = (F.col("_kinds") == F.col("message_part_count")) & (F.col("message_part_count") == total) & (F.col("_lo") == 1) & (F.col("_hi") == total)
    parts = joined.select(*keys, "text", "timestamp", "text_decode_failed", *[F.col("_rest")[c].alias(c) for c in rest], "message_part_count", total.alias("message_expected_parts"), (~F.coalesce(whole, F.lit(False))).alias("message_partial"))
    return single.unionByName(parts)


def reassemble_labels(labels: DataFrame, keys: list[str], part: str) -> DataFrame:
    """Labels of a message from those of its parts.

    Evaluated if any part is; flagged if any evaluated part is flagged, null if
    none is evaluated; the fraud type is that of the first flagged part.
    """
    flagged = F.coalesce(F.col("rule_evaluated") & F.col("rule_flagged"), F.lit(False))
    evaluated = F.bool_or(F.coalesce("rule_evaluated", F.lit(False)))
    return labels.groupBy(*keys).agg(evaluated.alias("rule_evaluated"), F.when(evaluated, F.bool_or(flagged)).alias("rule_flagged"), F.min_by(F.when(flagged, F.col("fraud_type")), F.when(flagged & F.col("fraud_type").isNotNull(), F.col(part))).alias("fraud_type"))


def keep_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that comes last in ``order``; map-side, without a window."""
    return _pick(df, keys, F.max_by, order)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that comes first in ``order``."""
    return _pick(df, keys, F.min_by, order)


def _pick(df: DataFrame, keys: list[str], by, order: list[str]) -> DataFrame:  # noqa: ANN001
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*keys, *[F.col("_r")[c].alias(c) for c in rest])


def upsert(existing: DataFrame, new: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """``existing`` with rows of equal keys replaced by ``new``.

    Of several new rows of a key that of the largest ``order`` (say, time and
    number) wins; without ``order`` the largest by its values in column order.
    """
    order = order or [c for c in new.columns if c not in keys] or keys
    both = existing.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return keep_latest(both, keys, ["_new", *order]).drop("_new")


def collisions(parts: DataFrame, keys: list[str], part: str) -> DataFrame:
    """Parts of each message key, and whether a part number occurs twice."""
    return parts.groupBy(*keys).agg(F.count(F.lit(1)).alias("parts"), (F.count(part) > F.count_distinct(part)).alias("collides"))


def in_order(df: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """``df`` with each row's number within its key, from 1."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
