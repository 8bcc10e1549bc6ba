"""Personal data: patterns propose spans, checksums confirm them, context words adjust their score.

Base kinds, leftmost and non-overlapping per kind: email, ip (parts at most 255), card (16 to 19 digits passing Luhn)
and phone (8 to 15 digits). The method adds shorter cards (13 to 15 digits passing Luhn), IBANs (mod-97) and, where a
context word stands nearby, identity numbers and national phone numbers. A base span scores 0.8 and is kept whatever
its context; an added one is kept from a score of KEEP on. A word of its kind within NEAR code points adds 0.2, a word
like "example" or "version" takes 0.2 away.

Patterns use possessive repeats and start at a run's first character, so the time of a text is proportional to its
length. Places are code points, ends exclusive. Spans of different kinds may overlap.

Defined cases: a null text is an empty one and has no span; repeated rows are reported each. Every row is judged by
itself, so other columns don't matter.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
ADDED = ("short_card", "iban", "id_number", "local_phone")
KEEP = 0.5
NEAR = 40

# The local part of an address is the run of its characters before the @ sign, found by looking back.
_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGIT = re.compile(r"[0-9]")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+")
_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+().-])(?:\([0-9]{2,5}\) ?|0)[0-9](?:[ /-]?[0-9]){5,12}+(?![0-9])")

_CONTEXT = {
    "email": "mail email e-mail contact write",
    "ip": "ip address server host client",
    "card": "card visa mastercard amex credit debit payment",
    "phone": "phone tel telephone call mobile fax",
    "short_card": "card visa mastercard amex credit debit payment",
    "iban": "iban account bank konto cuenta compte",
    "id_number": "ssn social security identity",
    "local_phone": "phone tel telephone call mobile fax telefon teléfono téléphone",
}
_NEAR = {
    kind: re.compile(r"(?i)(?<!\w)(?:" + "|".join(map(re.escape, words.split())) + r")(?!\w)")
    for kind, words in _CONTEXT.items()
}
_AGAINST = re.compile(r"(?i)(?<!\w)(?:example|sample|dummy|version|isbn|invoice|order)(?!\w)")
_START = {**dict.fromkeys(BASE, 0.8), "short_card": 0.4, "iban": 0.8, "id_number": 0.4, "local_phone": 0.4}


def luhn(digits: str) -> bool:
    doubled = [d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits)))]
    return sum(doubled) % 10 == 0


def mod97(iban: str) -> bool:
    own = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in own[4:] + own[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base kinds, by kind as listed, then by place."""
    out = []
    past = 0
    for m in _AT.finditer(text) if "@" in text else ():
        start = m.start()
        while start > past and _LOCAL.match(text[start - 1]):
            start -= 1
        if start < m.start():
            out.append(("email", start, m.end()))
            past = m.end()
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(own := p.lstrip("0")) < 4 and int(own or "0") < 256 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    phones = []
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 8 <= len(_digits(m[0])) <= 15:
            phones.append(("phone", *m.span()))
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    return out + phones


def added_spans(text: str) -> list[tuple[str, int, int]]:
    """What the method proposes besides; the patterns that have a checksum are confirmed by it."""
    out: list[tuple[str, int, int]] = []
    if not _DIGIT.search(text):
        return out
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() and 13 <= len(d := _digits(m[0])) <= 15 and luhn(d):
            out.append(("short_card", *m.span()))
    for m in _IBAN.finditer(text):
        # A trailing word in capitals may have come along; the longest valid head counts.
        for cut in range(m.end() - m.start(), 14, -1):
            head = m[0][:cut]
            if head[-1] != " " and not text[m.start() + cut:m.start() + cut + 1].isalnum() and mod97(head):
                out.append(("iban", m.start(), m.start() + cut))
                break
    out += [("id_number", *m.span()) for m in _ID.finditer(text)]
    out += [("local_phone", *m.span()) for m in _LOCAL_PHONE.finditer(text)]
    return out


def score(text: str, kind: str, start: int, end: int) -> float:
    around = text[max(0, start - NEAR):start] + " \n " + text[end:end + NEAR]
    value = _START[kind] + 0.2 * bool(_NEAR[kind].search(around)) - 0.2 * bool(_AGAINST.search(around))
    return round(min(max(value, 0.0), 1.0), 2)


def spans(text: str) -> list[tuple[str, int, int, float]]:
    """All kept spans with their scores: the base kinds, then the added ones."""
    out = [(*s, score(text, *s)) for s in base_spans(text)]
    return out + [(*s, v) for s in added_spans(text) if (v := score(text, *s)) >= KEEP]


def _joined(found: list[tuple]) -> str:
    return ",".join(f"{s[0]}:{s[1]}:{s[2]}" for s in found)


REPORT = pa.struct([
    *[(f"n_{kind}", pa.int64()) for kind in BASE], ("base_sha256", pa.string()), ("spans", pa.string()),
    ("scores", pa.string()),
])
REPORT_DDL = (
    "struct<n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, scores string>"
)


def _report(texts: pa.Array) -> pa.Array:
    rows = []
    for text in texts:
        found = spans(text.as_py() or "")
        base = [s for s in found if s[0] in BASE]
        rows.append({
            **{f"n_{kind}": sum(s[0] == kind for s in base) for kind in BASE},
            "base_sha256": hashlib.sha256(_joined(base).encode()).hexdigest(), "spans": _joined(found),
            "scores": ",".join(f"{s[3]:g}" for s in found),
        })
    return pa.array(rows, type=REPORT)


def _redacted(texts: pa.Array) -> pa.Array:
    rows = []
    for text in texts:
        own = text.as_py()
        found = spans(own) if own else []
        # Overlapping spans go as one, under the name of the first.
        merged: list[list] = []
        for kind, start, end, _ in sorted(found, key=lambda s: (s[1], -s[2])):
            if merged and start < merged[-1][2]:
                merged[-1][2] = max(merged[-1][2], end)
            else:
                merged.append([kind, start, end])
        for kind, start, end in reversed(merged):
            own = own[:start] + f"<{kind.upper()}>" + own[end:]
        rows.append(own)
    return pa.array(rows, type=pa.string())


def report(documents: DataFrame) -> DataFrame:
    """``doc_id``, counts of the base kinds, the digest of the base spans, all spans and their scores."""
    find = F.arrow_udf(_report, REPORT_DDL)
    return documents.select("doc_id", find("text").alias("r")).select("doc_id", "r.*")


def redact(text: Column | str) -> Column:
    """The text with every kept span as its kind in angle brackets; null stays null."""
    return F.arrow_udf(_redacted, "string")(text)


def query(spark: SparkSession, d: str) -> DataFrame:
    return report(spark.read.parquet(f"{d}/documents.parquet"))


def stage(spark: SparkSession, docs: DataFrame, d: str) -> DataFrame:
    """The documents with personal data redacted, and their new length."""
    out = docs.withColumn("text", redact("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)
