"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Base kinds (email, ip, card, phone) follow fixed patterns, leftmost and non-overlapping per kind; a
match that fails its check is dropped without another try. On top of the base spans the method
proposes further ones and keeps those whose score reaches ``THRESHOLD``:

* card numbers inside longer runs of digits (Luhn; the leading digit adjusts the score),
* international phone numbers inside longer runs, and national ones next to a context word,
* ``iban`` (mod-97), ``ssn`` with its reserved numbers left out, both raised by context words,
* ``secret``: private keys, tokens of known form (those with a checksum or a decodable header confirmed by it), and
  runs of random-looking letters and digits where a word such as "token" or "password" stands before them.

A proposed span never overlaps a base span of its kind. Offsets count code points, ends are
exclusive. Null texts count as empty; ids may be null or repeat; every text is scanned whole, in
time linear in its length.
"""

from __future__ import annotations

import base64
import bisect
import binascii
import collections
import hashlib
import json
import math
import re
import zlib
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from fleetlake.llm.common import arrow_rows, documents

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "secret")
THRESHOLD = 0.6
CONTEXT_CHARS = 40


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


# The base patterns.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin at the first digit of a run, which keeps the scan linear.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

DIGIT_GROUPS = re.compile(r"[0-9]+")
# Country code, then groups of two to four digits: one number of a longer run.
ONE_PHONE = re.compile(r"\+[0-9]{1,3}(?:[\x20.-]?\([0-9]{1,4}\))?(?:[\x20.-]?[0-9]{2,4}){2,5}(?![0-9])")
NATIONAL = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

# One run of token characters; nothing inside a run begins another one, which keeps the scan linear.
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}+={0,2}+(?![A-Za-z0-9=])")
JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{8,4096}+)\.[A-Za-z0-9_-]{2,}+\.[A-Za-z0-9_-]{8,}+")
KEY_BEGIN = re.compile(r"-----BEGIN (?:[A-Z]{1,12} ){0,3}PRIVATE KEY-----")
KEY_END = re.compile(r"-----END (?:[A-Z]{1,12} ){0,3}PRIVATE KEY-----")
# Published forms of access tokens.
KNOWN_TOKEN = re.compile(
    r"(?:AKIA|ASIA)[A-Z0-9]{16}|gh[opsru]_[A-Za-z0-9]{36}|(?:sk|rk)_(?:live|test)_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}"
)
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
NAMED = r"(?:token|secret|passw(?:or)?d|pwd|api[_ -]?key|access[_ -]?key|credentials?|bearer|passwort|mot de passe|contraseña)"
ASSIGNED = re.compile(rf"(?i){NAMED}[\"']?\s?(?::=|=>|[:=])\s?[\"']?$|bearer $")
HEX_BITS, OTHER_BITS = 2.5, 3.2  # entropy per character of a run that looks random

CONTEXT = {
    "card": re.compile(r"(?i)\b(?:card|visa|master ?card|amex|credit|debit|kreditkarte|carte|tarjeta)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|telephone|mobile|cell|call|fax|telefon|handy|téléphone|teléfono)\b"),
    "iban": re.compile(r"(?i)\b(?:iban|bank|account|bic|swift|konto|compte|cuenta)\b"),
    "ssn": re.compile(r"(?i)\b(?:ssn|social security|sozialversicherung)\b"),
    "secret": re.compile(rf"(?i)(?<![a-z]){NAMED}(?![a-z])"),
}
AGAINST = re.compile(r"(?i)\b(?:order|invoice|isbn|issn|tracking|serial|version|sku|part)\b")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The checksum of an account number without blanks."""
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_emails(text: str) -> list[Span]:
    out, low, at = [], 0, text.find("@")
    while at >= 0:
        head = text[low:at]
        start = low + len(head.rstrip(LOCAL))
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            out.append(Span("email", start, match.end(), 1.0))
        low = match.end() if match else at + 1
        at = text.find("@", low)
    return out


def base_ips(text: str) -> list[Span]:
    return [
        Span("ip", m.start(), m.end(), 1.0)
        for m in IP.finditer(text)
        if all(len(p) <= 3 and int(p) <= 255 for p in (g.lstrip("0") or "0" for g in m.groups()))
    ]


def base_cards(text: str, runs: list[tuple[int, int]]) -> list[Span]:
    out = []
    for start, end in runs:
        digits = _digits(text[start:end])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(Span("card", start, end, 1.0))
    return out


def base_phones(text: str, runs: list[tuple[int, int]]) -> list[Span]:
    return [Span("phone", a, b, 1.0) for a, b in runs if 9 <= len(_digits(text[a:b])) <= 15]


def _score(kind: str, start: int, end: int, text: str, score: float) -> float:
    around = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS // 2]
    if CONTEXT[kind].search(around):
        score += 0.3
    if AGAINST.search(around):
        score -= 0.3
    return round(score, 3)


def _cards_within(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Card numbers inside a run that is none as a whole: one digit group, or groups of four."""
    groups = [(start + m.start(), start + m.end()) for m in DIGIT_GROUPS.finditer(text[start:end])]
    out, i = [], 0
    while i < len(groups):
        digits, j = "", i
        while j < len(groups) and len(digits) < 19:
            a, b = groups[j]
            if b - a != 4 and j > i or b - a > 19:
                break
            digits += text[a:b]
            if len(digits) >= 13 and luhn(digits):
                out.append((groups[i][0], b))
                i = j
                break
            if b - a != 4:
                break
            j += 1
        i += 1
    return out


def entropy(run: str) -> float:
    """Bits per character."""
    return -sum(n / len(run) * math.log2(n / len(run)) for n in collections.Counter(run).values())


def looks_random(run: str) -> bool:
    """Letters and digits, evenly used: not a word, a number, a path or a ruler."""
    if not any(c.isdigit() for c in run) or not any(c.isalpha() for c in run):
        return False
    is_hex = all(c in "0123456789abcdefABCDEF" for c in run)
    return entropy(run) >= (HEX_BITS if is_hex else OTHER_BITS)


def token_checksum(token: str) -> bool:
    """The last six characters of such a token are the CRC-32 of the thirty before them, to base 62."""
    value, digits = zlib.crc32(token[4:34].encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits == token[34:]


def jwt_header(part: str) -> bool:
    """Whether the first part of a web token decodes to a header that names an algorithm."""
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, TypeError, binascii.Error):
        return False


def find_secrets(text: str) -> list[Span]:
    """Private keys, tokens of known form, and random-looking runs that a context word names."""
    out = []
    if "PRIVATE KEY-----" in text:
        ends = [m.end() for m in KEY_END.finditer(text)]
        for m in KEY_BEGIN.finditer(text):
            i = bisect.bisect_right(ends, m.end())
            out.append(Span("secret", m.start(), ends[i] if i < len(ends) else m.end(), 1.0))
    out += [Span("secret", *m.span(), 1.0) for m in JWT.finditer(text) if jwt_header(m.group(1))]
    taken = _Cover([(s.start, s.end) for s in out])
    for m in TOKEN.finditer(text):
        run, (start, end) = m.group(), m.span()
        known = KNOWN_TOKEN.fullmatch(run)
        if not known and not looks_random(run) or taken.meets(start, end):
            continue
        if known and run.startswith("gh"):
            score = 1.0 if token_checksum(run) else 0.5
        elif known:
            score = 0.8
        else:
            score = 0.65 if ASSIGNED.search(text[max(0, start - CONTEXT_CHARS) : start]) else 0.3
        score = _score("secret", start, end, text, score)
        if score >= THRESHOLD:
            out.append(Span("secret", start, end, score))
    return out


def find_spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans) of a whole text, each by kind and then start."""
    text = text or ""
    base: dict[str, list[Span]] = {k: [] for k in KINDS}
    added: dict[str, list[Span]] = {k: [] for k in KINDS}
    if "@" in text:
        base["email"] = base_emails(text)
    if DIGIT_GROUPS.search(text):
        base["ip"] = base_ips(text)
        digit_runs = [m.span() for m in CARD.finditer(text)]
        base["card"] = base_cards(text, digit_runs)
        phone_runs = [m.span() for m in PHONE.finditer(text)]
        base["phone"] = base_phones(text, phone_runs)
        phones = {s.start: s.end for s in base["phone"]}
        cards = {s.start for s in base["card"]}

        def add(kind: str, start: int, end: int, score: float) -> None:
            score = _score(kind, start, end, text, score)
            if score >= THRESHOLD:
                added[kind].append(Span(kind, start, end, score))

        for start, end in digit_runs:
            if start not in cards and end - start >= 13:
                for a, b in _cards_within(text, start, end):
                    add("card", a, b, 0.7 if text[a] in "3456" else 0.6)
        for start, end in phone_runs:
            if start not in phones:
                m = ONE_PHONE.match(text, start, end)
                if m and 9 <= len(_digits(m.group())) <= 15:
                    add("phone", m.start(), m.end(), 0.7)
        inside = _Cover([(s.start, s.end) for k in ("card", "phone", "ip") for s in base[k] + added[k]])
        for m in NATIONAL.finditer(text):
            if not inside.meets(*m.span()):
                add("phone", *m.span(), 0.4)
        for m in IBAN.finditer(text):
            plain = m.group().replace(" ", "")
            if 15 <= len(plain) <= 34 and mod97(plain):
                add("iban", *m.span(), 0.7)
        for m in SSN.finditer(text):
            if not inside.meets(*m.span()):
                add("ssn", *m.span(), 0.4)
    added["secret"] = find_secrets(text)
    return (
        [s for k in KINDS for s in base[k]],
        [s for k in KINDS for s in sorted(added[k], key=lambda s: s.start)],
    )


class _Cover:
    """Whether an interval meets one of many, of which at most three kinds overlap each other."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.spans = sorted(spans)

    def meets(self, start: int, end: int) -> bool:
        i = bisect.bisect_left(self.spans, (end,))
        return any(b > start for _, b in self.spans[max(0, i - 3) : i])


def digest(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def _step(cols: dict[str, list]) -> pa.RecordBatch:
    counts: list[list[int]] = [[], [], [], []]
    hashes, spans, found, scores = [], [], [], []
    for text in cols["text"]:
        base, added = find_spans(text)
        for i, kind in enumerate(KINDS[:4]):
            counts[i].append(sum(s.kind == kind for s in base))
        every = sorted(base + added, key=lambda s: (KINDS.index(s.kind), s.start)) if added else base
        hashes.append(hashlib.sha256(digest(base).encode()).hexdigest())
        spans.append(digest(every))
        found.append(len(every))
        scores.append([s.score for s in every])
    return pa.RecordBatch.from_arrays(
        [pa.array(cols["doc_id"], pa.int64()), *[pa.array(c, pa.int64()) for c in counts]]
        + [pa.array(hashes), pa.array(spans), pa.array(found, pa.int64()), pa.array(scores, pa.list_(pa.float64()))],
        names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans", "scores"],
    )


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: base counts, hash of the base spans, all spans, their number and scores."""
    schema = (
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
        "spans string, n_spans long, scores array<double>"
    )
    return arrow_rows(docs, ["doc_id", "text"], _step, schema)


def op2_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(documents(spark, sf_dir)).drop("scores")
