"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits,
schemes and the cue words of identifiers. Around each anchor a local parser
extends to the left and right as far as its kind allows and validates what it
found. Four kinds follow fixed patterns (base): leftmost, non-overlapping,
matches that fail validation are dropped and not tried again. Three additions
come from the anchors alone: mailboxes with letters beyond ASCII (email),
URLs that carry a user or a bare host address (address), and account numbers
after a cue word (account). Places count code points, ends are exclusive.

Null and empty texts have no span. Spans of different kinds may overlap.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from ipaddress import ip_address

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwright.llm.common import mapped, steps, table, texts_of

#: Base kinds in the order of the digests, then those only the anchors add.
KINDS = ("email", "ip", "card", "phone", "address", "account")
BASE = KINDS[:4]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_RUN = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WIDE_DOMAIN = re.compile(r"[^\W_](?:[\w-]*[^\W_])?(?:\.[^\W_](?:[\w-]*[^\W_])?)+")
_AUTHORITY = re.compile(r"[^\s/?#\"'<>]+")
_REST = re.compile(r"[^\s\"'<>]*")
_CUED = re.compile(
    r"(?:\s+(?:no|nr|num|number|nummer|n°|numéro|número)\b\.?)?\s*[:#=]?\s*"
    r"(?:(?P<iban>[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})|(?P<number>[0-9](?:[ -]?[0-9]){7,16}))(?![\w])"
)
# Cue words of accounts and identifiers in the languages of the corpus.
CUES = (
    "account", "acct", "bank account", "compte", "cuenta", "iban", "identity card", "konto", "kontonummer",
    "passport", "social security", "tax id",
)


def luhn(digits: str) -> bool:
    """Whether the digits pass the Luhn check."""
    double = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]
    return sum(double[int(d)] if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def iban(text: str) -> bool:
    """Whether an IBAN's check digits are right."""
    joined = text.replace(" ", "")
    moved = joined[4:] + joined[:4]
    return 15 <= len(joined) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _automaton() -> ahocorasick.Automaton:
    anchors = ahocorasick.Automaton()
    for c in "@+":
        anchors.add_word(c, c)
    for c in "0123456789":
        anchors.add_word(c, "0")
    anchors.add_word("://", "s")
    for cue in CUES:
        for written in {cue, cue.capitalize(), cue.upper(), cue.title()}:
            anchors.add_word(written, f"c{len(written)}")
    anchors.make_automaton()
    return anchors


_anchors: list[ahocorasick.Automaton] = []


def _wide_email(text: str, at: int) -> tuple[int, int] | None:
    """A mailbox around an at-sign with letters of any script, if some are beyond ASCII."""
    start = at
    while start and (text[start - 1] in _LOCAL or (text[start - 1] > "\x7f" and text[start - 1].isalnum())):
        start -= 1
    while start < at and text[start] in ".-%+":
        start += 1
    found = _WIDE_DOMAIN.match(text, at + 1)
    if start == at or not found:
        return None
    last = found.group().rpartition(".")[2]
    wide = not text[start : found.end()].isascii()
    return (start, found.end()) if wide and len(last) > 1 and not last.isdigit() else None


def _address(text: str, scheme_end: int) -> tuple[int, int] | None:
    """A URL around `://` with a user before its host, or a bare address as host."""
    start = scheme_end - 3
    while start and text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "+.-"):
        start -= 1
    while start < scheme_end - 3 and not text[start].isalpha():
        start += 1
    found = _AUTHORITY.match(text, scheme_end)
    if start == scheme_end - 3 or not found:
        return None
    user, sign, host = found.group().rpartition("@")
    name = host.rpartition(":")[0] if re.search(r":[0-9]+$", host) else host
    try:
        bare = bool(ip_address(name.strip("[]")))
    except ValueError:
        bare = False
    if not (bare or (sign and user and "." in name)):
        return None
    end = _REST.match(text, found.end()).end()
    while text[end - 1] in ".,;:!?)":
        end -= 1
    return start, end


def _account(text: str, start: int, end: int) -> tuple[int, int] | None:
    """An account number after a cue word that stands by itself."""
    if (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()):
        return None
    found = _CUED.match(text, end)
    if not found:
        return None
    kind = "iban" if found["iban"] else "number"
    value = found[kind]
    if kind == "iban":
        while len(value) >= 15 and not iban(value):  # words in capitals may follow
            value = value[: value.rfind(" ")] if " " in value else ""
        if len(value) < 15:
            return None
    return found.start(kind), found.start(kind) + len(value)


def spans_of(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind number, start, end, base) of a text, in the order of kinds and starts."""
    if not _anchors:
        _anchors.append(_automaton())
    found: list[tuple[int, int, int, bool]] = []
    email_done = ip_done = card_done = phone_done = 0
    for end, kind in _anchors[0].iter(text):
        if kind == "0":
            if end >= ip_done:
                match = _IP.match(text, end)
                if match:
                    ip_done = match.end()
                    if all(len(p) <= 3 and int(p) <= 255 for p in (q.lstrip("0") or "0" for q in match.group().split("."))):
                        found.append((1, end, ip_done, True))
                else:
                    ip_done = _RUN.match(text, end).end()
            if end >= card_done:
                match = _CARD.match(text, end)
                card_done = match.end() if match else end + 1
                if match and card_done - end >= 16:
                    digits = match.group().replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        found.append((2, end, card_done, True))
        elif kind == "@":
            start = end
            while start > email_done and text[start - 1] in _LOCAL:
                start -= 1
            match = _DOMAIN.match(text, end + 1) if start < end else None
            if match:
                email_done = match.end()
                found.append((0, start, email_done, True))
            wide = _wide_email(text, end)
            if wide:
                found.append((0, *wide, False))
        elif kind == "+":
            match = _PHONE.match(text, end) if end >= phone_done else None
            if match:
                phone_done = match.end()
                if 8 <= sum(c.isdigit() for c in match.group()) <= 15:
                    found.append((3, end, phone_done, True))
        elif kind == "s":
            address = _address(text, end + 1)
            if address:
                found.append((4, *address, False))
        else:
            account = _account(text, end + 1 - int(kind[1:]), end + 1)
            if account:
                found.append((5, *account, False))
    return sorted(set(found))


SPANS = "array<struct<kind: string, start: long, end: long, base: boolean>>"


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and spans (kind, start, end, base) of each row."""
    element = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            rows = [
                [{"kind": KINDS[k], "start": a, "end": b, "base": c} for k, a, b, c in spans_of(t)]
                for t in texts_of(batch.column(text))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(rows, pa.list_(element))], [key, "spans"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).transform(mapped, run, f"{key} {kind}, spans {SPANS}")


def redacted(text: str) -> str:
    """The text with each span, overlapping ones joined, replaced by the name of its first kind."""
    out, done = [], 0
    merged: list[list] = []
    for kind, start, end, _ in sorted(spans_of(text), key=lambda s: (s[1], -s[2], s[0])):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end, kind])
    for start, end, kind in merged:
        out += [text[done:start], f"[{KINDS[kind]}]"]
        done = end
    return "".join(out) + text[done:]


def redact(docs: DataFrame, text: str = "text", size: str = "n_chars") -> DataFrame:
    """All columns of the rows, personal data in the text replaced, its size brought up to date."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            texts = [t and redacted(t) for t in batch.column(text).to_pylist()]
            changed = {text: pa.array(texts, pa.string()), size: pa.array([t if t is None else len(t) for t in texts], pa.int64())}
            yield pa.RecordBatch.from_arrays([changed.get(n, batch.column(n)) for n in batch.schema.names], batch.schema.names)

    return docs.withColumn(size, F.col(size).cast("long")).transform(mapped, run, docs.withColumn(size, F.col(size).cast("long")).schema)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op1_personal_data(spark, folder: str) -> DataFrame:
    found = find_personal_data(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        own = F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))
        return F.size(own).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
