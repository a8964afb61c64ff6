"""Secrets: an Aho-Corasick pass finds keywords, anchored patterns look only where one stands, and embedded checksums confirm."""

from __future__ import annotations

import re
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts

#: Kinds that patterns alone define, then those that a checksum within the token confirms; spans at one place come in this order.
BASE_KINDS = ("assign", "access", "hex")
CHECKED_KINDS = ("github", "npm", "age")
KINDS = BASE_KINDS + CHECKED_KINDS
#: The automaton's keywords, in lower case, with the kind whose pattern begins there.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign", "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm", "age-secret-key-1": "age",
}
#: Patterns over UTF-8 bytes (so that letter case is ASCII's alone), each anchored where its keyword begins.
PATTERNS = {
    "assign": re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "hex": re.compile(rb"[0-9a-f]+"),
    "github": re.compile(rb"\bgh[pousr]_([0-9A-Za-z]{36})\b"),
    "npm": re.compile(rb"\bnpm_([0-9A-Za-z]{36})\b"),
    "age": re.compile(rb"\bAGE-SECRET-KEY-1([02-9AC-HJ-NP-Z]{58})\b"),
}
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 6, 20, 24
#: A byte's class: h for what a hexadecimal run may hold. A run of HEX_CHARS of them is the keyword of that kind.
HEX_CLASS = bytes(104 if chr(b) in "0123456789abcdef" else 46 for b in range(256))
#: Fixed values of the published token formats: base 62 digits; bech32 digits and its generator.
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BECH32 = "QPZRY9X8GF2TVDW0S3JN54KHCE6MUA7L"
BECH32_GENERATOR = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)
AGE_PREFIX = "age-secret-key-"
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def crc_digits(payload: bytes) -> bytes:
    """CRC-32 as six base 62 digits, which end a GitHub or npm token."""
    n, out = zlib.crc32(payload), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = BASE62[d] + out
    return out.encode()


def bech32_remainder(digits: bytes) -> int:
    """1 if the last six of the digits are the checksum of an age key's others."""
    c = 1
    for v in [ord(x) >> 5 for x in AGE_PREFIX] + [0] + [ord(x) & 31 for x in AGE_PREFIX] + [BECH32.index(chr(b)) for b in digits]:
        top, c = c >> 25, (c & 0x1FFFFFF) << 5 ^ v
        for i, g in enumerate(BECH32_GENERATOR):
            c ^= g if top >> i & 1 else 0
    return c


def confirmed(kind: str, m: re.Match) -> bool:
    """Whether a match is a secret: long enough for base kinds, with its own checksum for the others."""
    if kind == "assign":
        return len(m[1]) >= ASSIGN_CHARS
    if kind in ("access", "hex"):
        return len(m[0]) >= (ACCESS_CHARS if kind == "access" else HEX_CHARS)
    if kind == "age":
        return bech32_remainder(m[1]) == 1
    return crc_digits(m[1][:30]) == m[1][30:]


def automata():
    import ahocorasick

    words, runs = ahocorasick.Automaton(), ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        words.add_word(word, (len(word), kind))
    runs.add_word("h" * HEX_CHARS, (HEX_CHARS, "hex"))
    words.make_automaton()
    runs.make_automaton()
    return words, runs


def byte_spans(data: bytes, words, runs) -> list[tuple[int, int, int]]:
    """(start, end, number of the kind) by start, then kind; of one kind the leftmost that don't overlap. One pass of each automaton.

    A match that isn't confirmed still takes its characters, as it does for a search by the pattern alone. Every match begins with a keyword, so
    nothing but the text behind keywords is looked at; no pattern reads a character twice for one keyword.
    """
    found, upto = [], dict.fromkeys(KINDS, 0)
    for automaton, folded in ((words, data.lower()), (runs, data.translate(HEX_CLASS))):
        for last, (size, kind) in automaton.iter(folded.decode("latin-1")):
            at = last - size + 1
            if at >= upto[kind] and (m := PATTERNS[kind].match(data, at)):
                upto[kind] = m.end()
                if confirmed(kind, m):
                    found.append((at, m.end(), KINDS.index(kind)))
    return sorted(found, key=lambda s: (s[0], s[2]))


def in_code_points(data: bytes, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans counted in code points: each piece between two ends is decoded once."""
    if data.isascii():
        return found
    places, at, points = {}, 0, 0
    for p in sorted({p for s in found for p in s[:2]}):
        points += len(data[at:p].decode("utf-8", "replace"))
        places[p], at = points, p
    return [(places[a], places[b], k) for a, b, k in found]


def redacted(data: bytes, found: list[tuple[int, int, int]]) -> str:
    """The text with each secret as its kind in brackets; of spans that overlap the first one stays."""
    out, at = [], 0
    for a, b, k in found:
        if a >= at:
            out += [data[at:a], f"[{KINDS[k]}]".encode()]
            at = b
    return b"".join([*out, data[at:]]).decode("utf-8", "replace")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", redact: bool = False) -> DataFrame:
    """doc_id and spans, array<struct<kind, start, end>> by start, then kind, of every whole text; with redact, the text without them too.

    One pass without a shuffle: an automaton of all keywords runs over the text, patterns are tried where a keyword stands, and kinds with a
    checksum are kept only if it holds. Runs of hexadecimal digits have no keyword of their own, so a second automaton looks for HEX_CHARS
    digits in a row. Kinds are searched each by itself: spans of different kinds may overlap.
    Null and empty texts have no spans (redacted: empty). Null and repeated ids and repeated rows stay as they are; other columns are ignored;
    an empty table gives none.
    """
    ready = []

    def scan(texts):
        if not ready:
            ready.extend(automata())
        spans, clean = [], []
        for text in texts:
            data = (text or "").encode("utf-8", "replace")
            found = byte_spans(data, *ready)
            spans.append([{"kind": KINDS[k], "start": a, "end": b} for a, b, k in in_code_points(data, found)])
            if redact:
                clean.append(redacted(data, found))
        return {"spans": spans} | ({"redacted": clean} if redact else {})

    return map_texts(docs, id_col, text_col, f"spans {SPANS}" + (", redacted string" if redact else ""), scan)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_digests(found: DataFrame) -> DataFrame:
    """doc_id, the count of each base kind, n_checked of those with a checksum, base_sha256 and spans."""
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.size(of(*CHECKED_KINDS)).cast("long").alias("n_checked"), F.sha2(joined(of(*BASE_KINDS)), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
