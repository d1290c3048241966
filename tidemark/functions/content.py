"""Content flags and other measures of single texts, as Catalyst expressions."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: the content patterns, by flag, matched without regard to case -------
PATTERNS = {
    "has_url": r"https?://|www\.",
    "has_shortlink": r"\b(?:bit\.ly|tinyurl\.com|t\.co|goo\.gl|is\.gd|ow\.ly|rebrand\.ly|cutt\.ly|tiny\.cc|shorturl\.at)\b",
    "has_phone_number": r"\b(?:\+?\d[\d\-\s]{8,}\d)\b",
    "has_currency_symbol": r"[$€£₹¥₩₦]|\b(?:usd|inr|eur|gbp|jpy|krw|ngn)\b",
    "has_urgency_keyword": r"\b(?:urgent|immediately|act now|expires?|last chance|final notice|limited time|urgente|inmediatamente|ahora mismo|expira|ultima chance|urgent(?:e)?|immediatement|jaldi|abhi|turant|segera|sekarang|cepat|tamat tempoh)\b|紧急|立即|马上|最后机会|限时优惠|அவசரம்|உடனடியாக|கடைசி வாய்ப்பு|അടിയന്തിരം|ഉടൻ|അവസാന അവസരം",
    "has_prize_keyword": r"\b(?:won|winner|prize|reward|claim now|congratulations|selected|ganador|premio|felicidades|reclamar ahora|ganhador|premio|parabens|felicitations|gagnant|inaam|jeeta|badhai ho|pemenang|hadiah|selamat|tahniah)\b|中奖|恭喜|奖金|中奖了|வெற்றியாளர்|பரிசு|வாழ்த்துக்கள்|വിജയി|സമ്മാനം|അഭിനന്ദനങ്ങൾ",
    "has_gambling_keyword": r"\b(?:casino|betting|lottery|jackpot|bet now|poker|loteria|apuesta|apostar ahora|loteria|aposta|sorteio|satta|matka|jua|judi|togel|loteri|nombor ekor)\b|赌场|彩票|博彩|老虎机|சூதாட்டம்|லாட்டரி|ചൂതാട്ടം|ലോട്ടറി",
    "has_loan_keyword": r"\b(?:loan|credit approved|pre-?approved|cash advance|instant loan|prestamo|credito aprobado|prestamo instantaneo|emprestimo|credito aprovado|pret|credit approuve|karza|rin|udhaar|pinjaman|kredit disetujui|diluluskan)\b|贷款|借款|已批准|கடன்|முன் அங்கீகரிக்கப்பட்ட|വായ്പ|മുൻകൂർ അംഗീകാരം",
    "has_otp_keyword": r"\b(?:otp|one[- ]time password|verification code|security code|code de verification|codigo de verificacion|codigo de seguranca)\b|验证码|சரிபார்ப்பு குறியீடு|സ്ഥിരീകരണ കോഡ്",
    "has_excessive_punctuation": r"[!?]{2,}",
    "has_account_verification_keyword": r"\b(?:verify your account|account suspended|account locked|unusual activity|update your (?:kyc|details|payment)|confirm your identity|reactivate your account|verifica tu cuenta|cuenta suspendida|confirme sua conta)\b",
    "has_delivery_scam_keyword": r"\b(?:package (?:is )?held|delivery failed|redeliver(?:y)?|customs fee|pay a? ?small fee|shipment on hold|track your (?:package|parcel|order)|paquete retenido|entrega fallida)\b",
    "has_crypto_investment_keyword": r"\b(?:crypto|bitcoin|invest(?:ment)? opportunity|guaranteed returns?|double your money|forex signals?|trading bot|inversion garantizada|criptomoneda|retornos garantidos)\b",
    "has_tax_authority_impersonation_keyword": r"\b(?:irs|tax refund|income tax department|tax rebate|customs duty|penalty notice|reembolso de impuestos|receita federal|imposto de renda)\b",
    "has_free_bonus_keyword": r"\b(?:free|no cost|free spin|free spins|bonus|new member bonus|percuma|free spin percuma|ahli baru|bonus percuma)\b",
    "has_ewallet_transaction_keyword": r"\b(?:top ?up|deposit|withdraw(?:al)?|recharge|e-?wallet|topup|depo|rebat|cashback|komisen)\b",
    "has_registration_cta_keyword": r"\b(?:daftar|sertai|log masuk|apply now|register now|sign up now)\b",
    "has_suspicious_tld": r"(?<!@)\b[a-z0-9-]{2,20}\.(?:top|xyz|shop|cc|vip|info|work|buzz|fun|icu|cyou|loan|live|store|site|club|sbs|cfd|bid)\b(?:[/?#]\S*)?",
    "has_known_malicious_domain": r"\b(?:mhi-asv\.(?:top|net)|linkto\.eu|xy2\.eu|ipvtt\.online|waxmugay\.info|hkylsop\.in|maixpint\.top|maxspnt\.cc|hotlinkuta\.(?:link|my)|hotlinksm\.(?:link|my)|ironman66\.ca|jtexhris\.uk|paramountproperty\.my|v12mys\.social|jitexpressii\.uk)\b",
    "has_brand_impersonation_keyword": r"\b(?:jt ?express|jtexpre(?:ss|ssmy|sspost)?|jtexhris|whtsapp|whtasapp|vvhatsapp|vvhtasapp|vvhtsapp|vhatsaupp|wapp|wsapp|wassapp|moxis|maxls|hotlinkuta|hotlinksm|mybayar)\b",
}
#: Combinations of which any one, with all its flags, counts as high confidence.
HIGH_CONFIDENCE = [
    ["has_gambling_keyword"],
    ["has_known_malicious_domain"],
    ["has_brand_impersonation_keyword"],
    ["has_otp_keyword", "has_urgency_keyword"],
    ["has_url", "has_urgency_keyword"],
    ["has_url", "has_prize_keyword"],
    ["has_loan_keyword", "has_urgency_keyword"],
    ["has_registration_cta_keyword", "has_urgency_keyword"],
]
#: Cluster labels by the first list of which a sample text holds a member, in lower case.
CLUSTER_KEYWORDS = [
    ("chat_app_invite_spam", ["whatsapp", "telegram", "chat with me", "join me"]),
    ("gambling_promo_spam", ["jackpot", "claim free", "bonus", "prize", " rm ", "reward"]),
    ("otp_verification_bait", ["otp", "verify your", "verification", "reg-req"]),
    ("bank_transaction_alert", ["bank", "debit card", "withdraw", "account", "balance"]),
    ("url_link_spam", ["http://", "https://", "www.", ".com/"]),
]
# ---------------------------------------------------------------------------------------


def flag(text: Column, name: str) -> Column:
    """0 or 1: the flag's pattern occurs; null text has none. Letters and word limits are Unicode's."""
    return F.coalesce(text, F.lit("")).rlike("(?iU)" + PATTERNS[name]).cast("int")


def flags(text: Column) -> dict[str, Column]:
    return {name: flag(text, name) for name in PATTERNS}


def flag_count(names: list[str] | None = None) -> Column:
    """How many of the flag columns are set."""
    total = F.lit(0)
    for n in names or PATTERNS:
        total = total + F.coalesce(F.col(n), F.lit(0))
    return total


def high_confidence() -> Column:
    """Any of the combinations, from flag columns."""
    any_of = F.lit(False)
    for combination in HIGH_CONFIDENCE:
        all_of = F.lit(True)
        for n in combination:
            all_of = all_of & (F.coalesce(F.col(n), F.lit(0)) == 1)
        any_of = any_of | all_of
    return any_of


@F.pandas_udf(T.DoubleType())
def _entropy(texts: pd.Series) -> pd.Series:
    def bits(text: str | None) -> float | None:
        if not text:
            return None
        counts = np.fromiter(Counter(text).values(), dtype=np.float64)
        return float(np.log2(len(text)) - (counts * np.log2(counts)).sum() / len(text))

    return pd.Series([bits(t) for t in texts], dtype="float64")


def entropy(text: Column) -> Column:
    """Shannon entropy in bits per character; null for null and empty text.

    An Arrow UDF: counting characters by higher-order functions took 25 s where
    this takes one, since those are interpreted per character.
    """
    h = _entropy(text)
    return F.when(F.length(text) > 0, h)


def text_length(text: Column) -> Column:
    """Code points; 0 for null."""
    return F.char_length(F.coalesce(text, F.lit("")))


def letter_ratio(text: Column) -> Column:
    """Share of ASCII letters and blanks; null for null and empty text."""
    return F.when(F.length(text) > 0, F.length(F.regexp_replace(text, "[^A-Za-z ]", "")) / F.length(text))


def collapse(text: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def entropy_z(h: Column, level: Column, spread: Column, least: float = 0.05) -> Column:
    """How far an entropy lies from its sender's level, in spreads; null where undefined or the spread is not positive."""
    return F.when(h.isNotNull() & level.isNotNull() & (spread > 0), (h - level) / F.greatest(spread, F.lit(least)))


def keyword_label(text: Column) -> Column:
    """The first cluster label with a keyword in the text; null without one."""
    low = F.lower(F.coalesce(text, F.lit("")))
    out = F.lit(None).cast("string")
    for label, words in reversed(CLUSTER_KEYWORDS):
        hit = F.lit(False)
        for w in words:
            hit = hit | low.contains(w)
        out = F.when(hit, label).otherwise(out)
    return out


def cosine(a: Column, b: Column) -> Column:
    """Inner product in double, as for unit vectors; null for vectors of different length."""
    return F.when(F.size(a) == F.size(b), F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x))


def re2(name: str) -> str:
    """The flag's pattern for engines without Unicode word limits or look-behind, for existence of a match only."""
    p = PATTERNS[name]
    if name == "has_suspicious_tld":
        p = p.replace(r"(?<!@)\b", r"(?:^|[^@\pL\pN_])", 1)
    if name == "has_phone_number":
        p = p.replace(r"\+?", "", 1)
    before, after = r"(?:^|[^\pL\pN_])(?:", r")(?:$|[^\pL\pN_])"
    return "(?i)" + p.replace(r"\b(?:", before).replace(r")\b", after)
