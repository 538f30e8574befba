"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Every kind has a pattern, a validator and a base score. Words near a span that name the kind raise
its score, words that speak against it lower it. Base kinds (email, ip, card, phone) are always
reported as soon as their validator holds; added kinds (iban by mod-97, vat-style and national
numbers only with context) need a score of at least ADDED_SCORE.

Nulls and empty texts have no spans. Offsets are code points, ends exclusive. Very long texts are
scanned whole in linear time: no pattern restarts inside a run that it has already rejected.
Repeated rows each get their row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from . import textkit as tk
from .common import id_text

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "localphone")
CONTEXT_CHARS = 48
ADDED_SCORE = 0.5

LOCAL_REVERSED = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A failed run of digits cannot match from its middle either, hence the look-behind.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9-])")
NOT_DIGIT = re.compile(r"[^0-9]")
DIGIT = re.compile(r"[0-9]")

#: kind: (base score, words nearby that raise it, words nearby that lower it). Fixed values.
CONTEXT = {
    "email": (0.9, ("mail", "e-mail", "contact", "kontakt", "correo"), ("example", "noreply")),
    "ip": (0.6, ("ip", "host", "server", "address", "client"), ("version", "v.", "section", "chapter")),
    "card": (0.7, ("card", "visa", "mastercard", "amex", "credit", "carte", "karte", "tarjeta", "payment"), ("order", "isbn", "tracking", "serial")),
    "phone": (0.8, ("phone", "tel", "call", "mobile", "fax", "telefon"), ("order", "isbn")),
    "iban": (0.8, ("iban", "bank", "account", "konto", "compte", "cuenta"), ()),
    "ssn": (0.4, ("ssn", "social", "security"), ("order", "part", "isbn")),
    "localphone": (0.4, ("phone", "tel", "call", "mobile", "fax"), ("order", "isbn")),
}
WORD = re.compile(r"[^\W\d_][\w.-]*")

SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, scores string"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    value = 0
    for c in iban[4:] + iban[:4]:
        value = (value * (100 if c.isalpha() else 10) + int(c, 36)) % 97
    return value == 1


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping; from one @ to the next, so that every character is seen a bounded number of times."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        low = max(done, text.rfind("@", done, at) + 1)
        local = LOCAL_REVERSED.match(text[low:at][::-1])
        domain = DOMAIN.match(text, at + 1) if local else None
        if domain:
            out.append((at - local.end(), domain.end()))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    return out


def ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in IP.finditer(text) if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split(".")))]


def cards(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CARD.finditer(text) if 14 <= len(d := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d)]


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PHONE.finditer(text) if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15]


def ibans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in IBAN.finditer(text) if 15 <= len(x := m[0].replace(" ", "")) <= 34 and mod97(x)]


def score(text: str, kind: str, start: int, end: int) -> float:
    base, up, down = CONTEXT[kind]
    near = {x.lower() for x in WORD.findall(text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS // 2])}
    return round(max(0.05, min(1.0, base + 0.2 * bool(near & set(up)) - 0.3 * bool(near & set(down)))), 2)


def find(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score), by start, then kind as in KINDS."""
    found: list[tuple[str, int, int]] = []
    if "@" in text:
        found += [("email", *x) for x in emails(text)]
    if DIGIT.search(text):
        found += [("ip", *x) for x in ips(text)]
        found += [("card", *x) for x in cards(text)]
        if "+" in text:
            found += [("phone", *x) for x in phones(text)]
        taken = sorted(x[1:] for x in found)
        for kind, spans in (("iban", ibans(text)), ("ssn", [m.span() for m in SSN.finditer(text)]), ("localphone", [m.span() for m in LOCAL_PHONE.finditer(text)])):
            found += [(kind, a, b) for a, b in spans if kind == "iban" or not any(a < d and c < b for c, d in taken)]
    scored = [(k, a, b, score(text, k, a, b)) for k, a, b in found]
    return sorted((x for x in scored if x[0] in BASE_KINDS or x[3] >= ADDED_SCORE), key=lambda x: (x[1], KINDS.index(x[0])))


def pii_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    counts: dict[str, list[int]] = {k: [] for k in BASE_KINDS}
    sha, spans, added, scores = [], [], [], []
    for text in batch.column("text").to_pylist():
        found = find(text)
        for k in BASE_KINDS:
            counts[k].append(sum(x[0] == k for x in found))
        sha.append(hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b, _ in found if k in BASE_KINDS).encode()).hexdigest())
        spans.append(",".join(f"{k}:{a}:{b}" for k, a, b, _ in found))
        added.append(sum(x[0] not in BASE_KINDS for x in found))
        scores.append(",".join(f"{s:.2f}" for *_, s in found))
    columns = [batch.column("doc_id"), *(pa.array(counts[k], pa.int64()) for k in BASE_KINDS), pa.array(sha, pa.string()), pa.array(spans, pa.string()), pa.array(added, pa.int64()), pa.array(scores, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SCHEMA.split(", ")])


def detect_pii(docs: DataFrame) -> DataFrame:
    """One row per document (see SCHEMA); one pass, nothing is shuffled."""
    return id_text(docs).mapInArrow(tk.arrow_map(pii_batch), SCHEMA)
