"""Short-message payloads: user data headers and the text behind a data coding scheme.

Plain Python on single payloads; ``tidemark.operators.decode`` applies it in
Arrow batches.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

# --- fixed values of GSM 03.38 and of the two sources' coding tables -------------------
#: The default alphabet by code, 0x00 to 0x7F; U+FFFD stands for the escape code 0x1B.
GSM_BASIC = "@£$¥èéùìòÇ\nØø\rÅåΔ_ΦΓΛΩΠΨΣΘΞ�ÆæßÉ !\"#¤%&'()*+,-./0123456789:;<=>?¡ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÑÜ§¿abcdefghijklmnopqrstuvwxyzäöñüà"
GSM_EXTENSION = {0x0A: "\x0c", 0x14: "^", 0x28: "{", 0x29: "}", 0x2F: "\\", 0x3C: "[", 0x3D: "~", 0x3E: "]", 0x40: "|", 0x65: "€"}
#: Data coding scheme -> codec. SMPP stores the default alphabet one byte a character, SS7 packs it.
SMPP_SCHEMES = {0: "latin1", 1: "ascii", 3: "latin1", 4: "latin1", 8: "utf16", 24: "utf16", 25: "utf16", 26: "ascii", 241: "latin1", 244: "ascii", 245: "latin1"}
SMPP_NAMES = {0: "gsm7", 4: "gsm7", 241: "gsm7", 245: "gsm7"}
SS7_SCHEMES = {0: "gsm7", 8: "utf16", 12: "gsm7", 16: "gsm7", 17: "gsm7", 18: "gsm7", 24: "utf16", 25: "utf16", 26: "ascii", 192: "gsm7", 241: "gsm7", 242: "gsm7", 244: "ascii", 245: "gsm7"}
SS7_CONTESTED = {1: ("gsm7", "ascii"), 3: ("gsm7", "latin1")}
UNKNOWN_ORDER = ("ascii", "latin1", "utf16", "gsm7")
#: Information elements of a user data header: identifier -> (length, meaning).
CONCAT_8, CONCAT_16, PORT_8, PORT_16 = 0x00, 0x08, 0x04, 0x05
# ---------------------------------------------------------------------------------------

LOST = "�"
_LINES = re.compile(r"\r\n|\r|\n")


@dataclass(frozen=True)
class Header:
    """A user data header; ``length`` counts its bytes without the length byte."""

    length: int
    ref: int | None = None
    total: int | None = None
    part: int | None = None
    port: int | None = None


def read_header(payload: bytes) -> Header | None:
    """The header ``payload`` starts with, or None.

    The information elements must fill the announced length exactly, and one
    of them must be a well-formed concatenation or port element; anything else
    is text that merely looks like a header.
    """
    if len(payload) < 2 or not 0 < payload[0] <= len(payload) - 1:
        return None
    body, found = payload[1 : 1 + payload[0]], {}
    while body:
        if len(body) < 2 or len(body) < 2 + body[1]:
            return None
        kind, data, body = body[0], body[2 : 2 + body[1]], body[2 + body[1] :]
        if kind == CONCAT_8 and len(data) == 3:
            found |= {"ref": data[0], "total": data[1], "part": data[2]}
        elif kind == CONCAT_16 and len(data) == 4:
            found |= {"ref": int.from_bytes(data[:2], "big"), "total": data[2], "part": data[3]}
        elif kind == PORT_8 and len(data) == 2:
            found["port"] = data[0]
        elif kind == PORT_16 and len(data) == 4:
            found["port"] = int.from_bytes(data[:2], "big")
    return Header(payload[0], **found) if found else None


def unpack_septets(payload: bytes) -> list[int]:
    """The 7-bit codes of packed octets, least significant bit first; spare bits are dropped."""
    bits = int.from_bytes(payload, "little")
    return [bits >> shift & 0x7F for shift in range(0, len(payload) * 8 - 6, 7)]


def gsm_text(codes: list[int]) -> str:
    """Text of default-alphabet codes, with extension escapes; unassigned codes give U+FFFD."""
    if 0x1B not in codes:
        return "".join([GSM_BASIC[c] if c < 128 else LOST for c in codes])
    out, codes = [], iter(codes)
    for c in codes:
        if c == 0x1B:
            c = next(codes, None)
            out.append(LOST if c is None else GSM_EXTENSION.get(c, LOST))
        else:
            out.append(GSM_BASIC[c] if c < 128 else LOST)
    return "".join(out)


def decode_as(codec: str, payload: bytes) -> str | None:
    """Strict decoding by codec name; None for an empty or unfit payload."""
    if not payload:
        return None
    if codec == "gsm7":
        return gsm_text(unpack_septets(payload))
    try:
        return payload.decode({"latin1": "latin-1", "ascii": "ascii", "utf16": "utf-16-be"}[codec])
    except UnicodeDecodeError:
        return None


def legibility(text: str | None) -> float:
    """Share of printable characters, format and space characters included, U+FFFD excluded."""
    if not text:
        return 0.0
    return sum(c != LOST and (c.isprintable() or unicodedata.category(c) in ("Cf", "Zs")) for c in text) / len(text)


def one_line(text: str | None) -> str | None:
    return None if text is None else _LINES.sub(" ", text)


def decode_text(payload: bytes, scheme: int | None, source: str) -> tuple[str | None, str | None]:
    """Text and codec of a payload without header under an unsigned coding scheme.

    Contested and unknown schemes take the most legible reading, the first of
    equals, and mark the codec ``(auto)``.
    """
    if not payload:
        return None, None
    schemes = {"SMPP": SMPP_SCHEMES, "SS7": SS7_SCHEMES}[source]
    contested = SS7_CONTESTED.get(scheme) if source == "SS7" else None
    if scheme in schemes and contested is None:
        codec = schemes[scheme]
        return one_line(decode_as(codec, payload)), SMPP_NAMES.get(scheme, codec) if source == "SMPP" else codec
    tried = [(c, decode_as("latin1" if source == "SMPP" and c == "gsm7" else c, payload)) for c in contested or UNKNOWN_ORDER]
    codec, text = max(tried, key=lambda x: legibility(x[1]))
    return one_line(text), f"{codec}(auto)"


def whole_bytes(content: str | None) -> bytes | None:
    """The bytes of hex text, blanks allowed anywhere; None for null, empty or broken hex."""
    digits = "".join(content.split()) if content else ""
    if not digits or len(digits) % 2:
        return None
    try:
        return bytes.fromhex(digits)
    except ValueError:
        return None
