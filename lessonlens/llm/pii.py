"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, URL schemes and
words that announce an identifier.  A deterministic parser for each kind grows its anchor to
the left and right as far as the kind's characters go and validates the result.  A parser
remembers how far it has looked, also where it refused what it saw, so very long texts stay linear.

Kinds, in the order of ties: ``email``, ``ip``, ``card``, ``phone`` (the base kinds), then
``address`` (a URL) and ``account`` (an IBAN with a right checksum, or the identifier that
follows a cue such as ``account:`` or ``token =``).  Spans count code points, end exclusive.

Defined cases
    null or empty text  no spans
    repeated rows       one output row per input row
    null doc_id         passed through
    empty table         no rows
    overlapping kinds   every kind keeps its span; redaction merges them
    further columns     not read by ``find``; kept untouched by ``redact``
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonlens.llm.common import batch_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "address", "account")

SCHEMES = ("http://", "https://", "ftp://", "mailto:")
CUES = ("iban", "account", "acct", "token", "api_key", "apikey", "password", "secret", "passport", "ssn")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
_DOTTED = re.compile(r"[0-9][0-9.]*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL = re.compile(r"[^\s\"'<>|]++")
_URL_TAIL = frozenset(".,;:!?)]}")               # not of a URL that ends with them
_AFTER_CUE = re.compile(r"(?:[ ]?(?:no|number|nr|id)\b\.?)?[ ]?[:=#][ ]?[\"']?|[ ]?(?:no|nr)\b\.[ ]?[\"']?", re.I)
_IDENTIFIER = re.compile(r"[A-Za-z0-9][A-Za-z0-9_-]{5,}+")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11,30}")


@functools.cache
def anchors() -> ahocorasick.Automaton:
    """Automaton over all anchors; its values are (parser, anchor length)."""
    a = ahocorasick.Automaton()
    a.add_word("@", ("@", 1))
    a.add_word("+", ("+", 1))
    for digit in "0123456789":
        a.add_word(digit, ("9", 1))
    for what, words in (("s", SCHEMES), ("c", CUES)):
        for w in words:
            for form in itertools.product(*({c, c.upper()} for c in w)):
                a.add_word("".join(form), (what, len(form)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        d = int(ch) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    flat = text.replace(" ", "")
    return 15 <= len(flat) <= 34 and int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1


def iban_end(text: str, begin: int) -> int:
    """End of the longest IBAN that starts at ``begin`` and ends a word, 0 without one."""
    m = _IBAN.match(text, begin)
    end = m.end() if m else 0
    while end > begin:
        if (not text[end:end + 1].isalnum() or not text[end].isascii()) and iban_ok(text[begin:end]):
            return end
        end = text.rfind(" ", begin, end)
    return 0


def dotted_quads(run: str) -> Iterator[tuple[int, int]]:
    """Leftmost groups of four numbers joined by single dots in a run of digits and dots."""
    at, parts = 0, []
    for part in run.split("."):
        if part:
            parts.append((at, part))
        else:
            parts = []
        if len(parts) == 4:
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for _, p in parts):
                yield parts[0][0], at + len(part)
            parts = []
        at += len(part) + 1


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of ``text``, by start, then kind, then end."""
    if not text:
        return []
    found: list[tuple[int, int, int]] = []       # start, rank of the kind, end
    email_end = phone_end = card_end = run_end = url_end = account_end = 0
    url_run = url_body = url_refused = 0         # ends of the last run, of its body, of a host without a dot
    for last, (what, size) in anchors().iter(text):
        at = last - size + 1
        if what == "9":
            if at >= run_end:
                run_end = _DOTTED.match(text, at).end()
                if run_end - at >= 7:
                    found += [(at + a, 1, at + b) for a, b in dotted_quads(text[at:run_end])]
            if at >= card_end and (m := _CHAIN.match(text, at)):
                card_end = m.end()
                if card_end - at >= 12:
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        found.append((at, 2, card_end))
        elif what == "@":
            if at < email_end:
                continue
            start = at
            while start > email_end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                email_end = m.end()
                found.append((start, 0, email_end))
        elif what == "+":
            if at >= phone_end and (m := _PHONE.match(text, at)):
                phone_end = m.end()
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append((at, 3, phone_end))
        elif what == "s":
            begin = last + 1
            if at < url_end or begin < url_refused:
                continue
            if begin >= url_run:
                m = _URL.match(text, begin)
                url_run = url_body = m.end() if m else begin
                while url_body > begin and text[url_body - 1] in _URL_TAIL:
                    url_body -= 1
            slash = text.find("/", begin, url_body)
            host_end = slash if slash >= 0 else url_body
            if "." in text[begin:host_end].strip("."):
                url_end = url_body
                found.append((at, 4, url_end))
            else:                                # nor has any part of it a dot inside
                url_refused = host_end
        elif at >= account_end and (at == 0 or not text[at - 1].isalnum()):
            begin = last + 1
            if (m := _AFTER_CUE.match(text, begin)):
                begin = m.end()
            elif text[begin:begin + 1] == " ":
                begin += 1
            if (end := iban_end(text, begin)):
                account_end = end
            elif m and (m2 := _IDENTIFIER.match(text, begin)) and sum(c.isdigit() for c in m2[0]) >= 4:
                account_end = m2.end()
            else:
                continue
            found.append((begin, 5, account_end))
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def merged(found: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Overlapping spans become one, named after the first."""
    out: list[tuple[str, int, int]] = []
    for kind, a, b in found:
        if out and a < out[-1][2]:
            out[-1] = (out[-1][0], out[-1][1], max(b, out[-1][2]))
        else:
            out.append((kind, a, b))
    return out


def redacted(text: str | None) -> str | None:
    """``text`` with every span replaced by its kind in brackets."""
    if not text or not (found := merged(spans(text))):
        return text
    parts, at = [], 0
    for kind, a, b in found:
        parts += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*parts, text[at:]])


def find(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``spans`` (array of kind, start, end) of every row."""
    out = pa.schema([("doc_id", pa.int64()),
                     ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield batch_of(out, [b.column(0), [
                [{"kind": k, "start": s, "end": e} for k, s, e in spans(t)] for t in b.column(1).to_pylist()]])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; ``n_chars``, if there, follows it."""
    names = docs.columns
    types = docs.schema
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            before = b.column(at).to_pylist()
            after = [redacted(t) for t in before]
            columns = list(b.columns)
            columns[at] = pa.array(after, type=b.schema.field(at).type)
            if "n_chars" in names and pa.types.is_integer(b.schema.field(names.index("n_chars")).type):
                k = names.index("n_chars")
                columns[k] = pa.array([len(y) if x != y else n for x, y, n in zip(before, after, b.column(k).to_pylist())],
                                      type=b.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return docs.mapInArrow(run, types)


def query(docs: DataFrame) -> DataFrame:
    """The op9 contract, derived from the spans of ``find``."""
    def text_of(rows):
        return F.array_join(F.transform(rows, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    found = find(docs)
    def count_of(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *map(count_of, BASE),
        F.sha2(text_of(base), 256).alias("base_sha256"),
        text_of(F.col("spans")).alias("spans"))
