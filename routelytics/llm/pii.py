"""Personal data: patterns propose spans, validators confirm, context scores.

Base kinds (email, ip, card, phone) are the leftmost non-overlapping matches
of fixed patterns that pass their check (parts up to 255, Luhn, number of
digits).  Beyond them the operator proposes more spans:

* a card or a phone number inside a run of digits that is too long as a whole
  (two numbers side by side), cut at the run's own separators;
* IBANs (mod 97), IPv6 addresses, spelled-out mail addresses, national phone
  numbers without a country prefix, access keys and passwords.

Each span has a score: its pattern's prior, more for a passed checksum, moved
up or down by words nearby.  Base spans always stay; another span stays if
it scores at least ``least_score`` and overlaps no span that stays.  A secret
of any length that follows its name is kept whole, or as its parts between the
spans inside it.

Every scan is linear in the text: mail addresses are found from their @ and
digit runs from their first digit, never again from each of their characters.

Defined results: null or empty texts have no spans; null ids and repeated rows
are judged each by their text; extra columns are ignored by ``find`` and kept
by ``redact``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, StringType, StructField, StructType)

from routelytics.llm.blocks import map_texts

KINDS = ["email", "ip", "card", "phone", "iban", "secret"]
BASE_KINDS = KINDS[:4]


@dataclass(frozen=True)
class PiiParams:
    least_score: float = 0.5
    #: code points on either side of a span that are read as its context
    reach: int = 40


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in s)) % 97 == 1


_LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
_PATTERNS = {
    "domain": r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "spelled": r"(?<![\w.])[\w.+-]{1,64} ?[\[(] ?at ?[\])] ?[\w-]{1,64}(?: ?(?:[\[(] ?dot ?[\])]|\.) ?[\w-]{2,24}){1,4}",
    "ip6": r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])",
    "national": r"(?<![\w+.)-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "assigned": r"(?i:password|passwd|secret|token|api[_-]?key)[\"']?\s?[=:]\s?[\"']?([^\s\"',;]{8,})",
    "words": r"[^\W\d_]+",
}
#: words that speak for a kind (a prefix of a nearby word is enough) or against it
_FOR = {
    "email": ("mail", "contact", "write", "correo", "adresse"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "master", "credit", "payment", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "call", "fax", "mobil", "cell", "anruf", "llam", "appel"),
    "iban": ("iban", "bank", "account", "konto", "cuenta", "compte"),
    "secret": ("key", "password", "token", "secret", "credential"),
}
_AGAINST = ("version", "isbn", "order", "invoice", "serial", "doi", "example", "sample")


def _proposer(p: PiiParams):
    rx = {k: re.compile(v) for k, v in _PATTERNS.items()}
    groups = re.compile(r"[0-9]+")
    free = re.compile(rb"\0+")

    def digits(s: str) -> str:
        return "".join(c for c in s if "0" <= c <= "9")

    def emails(t: str):
        at, floor = t.find("@"), 0
        while at >= 0:
            m = rx["domain"].match(t, at + 1)
            seg = t[floor:at]
            start = floor + len(seg.rstrip(_LOCAL))
            floor = at + 1
            if m and start < at:
                yield start, m.end()
                floor = m.end()
            at = t.find("@", floor)

    def base(t: str):
        """(kind, start, end) of the base spans, and digit runs that failed as a whole."""
        spans, failed = [("email", a, z) for a, z in emails(t)], []
        for m in rx["ip"].finditer(t):
            if all(len(x.lstrip("0")) <= 3 and int(x[-3:]) <= 255 for x in m[0].split(".")):
                spans.append(("ip", m.start(), m.end()))
        for m in rx["card"].finditer(t):
            d = digits(m[0])
            if 14 <= len(d) <= 19 and luhn(d):
                spans.append(("card", m.start(), m.end()))
            elif len(d) > 12:
                failed.append(("card", m.start(), m.end()))
        if "+" in t:
            for m in rx["phone"].finditer(t):
                n = len(digits(m[0]))
                if 10 <= n <= 15:
                    spans.append(("phone", m.start(), m.end()))
                elif n > 15:
                    failed.append(("phone", m.start(), m.end()))
        return spans, failed

    def inner(t: str, kind: str, a: int, z: int):
        """Numbers inside a run that is too long, made of whole groups of digits."""
        runs = [(m.start(), m.end()) for m in groups.finditer(t, a, z)]
        if kind == "phone":
            n, end = 0, 0
            for s, e in runs:
                n += e - s
                if n > 15:
                    break
                end = e if n >= 10 else end
            if end:
                yield "phone", a, end, 0.6
            return
        i = 0
        while i < len(runs):
            n, hit = 0, None
            for j in range(i, len(runs)):
                n += runs[j][1] - runs[j][0]
                if n > 19:
                    break
                if n >= 13 and luhn(digits(t[runs[i][0]:runs[j][1]])):
                    hit = j
            if hit is None:
                i += 1
            else:
                yield "card", runs[i][0], runs[hit][1], 0.8
                i = hit + 1

    def more(t: str, failed):
        for kind, a, z in failed:
            yield from inner(t, kind, a, z)
        if "at" in t and ("[" in t or "(" in t):
            for m in rx["spelled"].finditer(t):
                yield "email", m.start(), m.end(), 0.6
        if t.count(":") >= 7:
            for m in rx["ip6"].finditer(t):
                yield "ip", m.start(), m.end(), 0.8
        for m in rx["national"].finditer(t):
            yield "phone", m.start(), m.end(), 0.4
        for m in rx["iban"].finditer(t):
            s = m[0].replace(" ", "")
            # a following upper-case word may stick to the match: try its whole groups
            end = m.end()
            while len(s) >= 15 and not mod97(s) and " " in t[m.start():end]:
                end = t.rindex(" ", m.start(), end)
                s = t[m.start():end].replace(" ", "")
            if 15 <= len(s) <= 34 and mod97(s):
                yield "iban", m.start(), end, 0.9
        for m in rx["key"].finditer(t):
            yield "secret", m.start(), m.end(), 0.9
        for m in rx["assigned"].finditer(t):
            yield "secret", m.start(1), m.end(1), 0.6

    def context(t: str, kind: str, a: int, z: int) -> float:
        near = [w.lower() for w in rx["words"].findall(t[max(0, a - p.reach):a] + " " + t[z:z + p.reach])]
        up = any(w.startswith(_FOR[kind]) for w in near)
        down = any(w.startswith(_AGAINST) for w in near)
        return 0.2 * up - 0.2 * down

    prior = {"email": 0.9, "ip": 0.6, "card": 0.9, "phone": 0.7}

    def one(t: str) -> list[tuple]:
        if not t:
            return []
        spans, failed = base(t)
        out = [(k, a, z, min(1.0, prior[k] + context(t, k, a, z)), True) for k, a, z in spans]
        extra = [(k, a, z, min(1.0, s + context(t, k, a, z)), False) for k, a, z, s in more(t, failed)]
        if extra:
            taken = bytearray(len(t))  # 1 where a span lies
            for _, a, z, _, _ in out:
                taken[a:z] = b"\1" * (z - a)
            # the best first; a span may touch only free text
            for k, a, z, s, own in sorted(extra, key=lambda x: (-x[3], x[1], KINDS.index(x[0]))):
                if s < p.least_score:
                    continue
                parts = [(a, z)]
                if 1 in taken[a:z]:
                    parts = [(a + m.start(), a + m.end()) for m in free.finditer(taken[a:z])] if k == "secret" else []
                    parts = [(i, j) for i, j in parts if any(c.isalnum() for c in t[i:j])]
                for i, j in parts:
                    out.append((k, i, j, s, own))
                    taken[i:j] = b"\1" * (j - i)
        return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))
    return one


_SPAN = StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()),
                    StructField("score", DoubleType()), StructField("base", BooleanType())])
_FOUND = StructType([StructField("spans", ArrayType(_SPAN))])


def find(docs: DataFrame, params: PiiParams = PiiParams()) -> DataFrame:
    """(doc_id, spans): spans as (kind, start, end, score, base), code points,
    end exclusive, by start and kind."""
    def make():
        one = _proposer(params)
        return lambda texts: [[one(t) for t in texts]]
    return map_texts(docs, make, _FOUND, ["doc_id"])


def redact(docs: DataFrame, params: PiiParams = PiiParams()) -> DataFrame:
    """Rows of ``docs``, with their own columns, and ``<KIND>`` in place of every span.

    ``n_chars`` follows a changed text; unchanged rows stay as they are.
    """
    def make():
        one = _proposer(params)

        def clean(t: str) -> str | None:
            spans = one(t)
            if not spans:
                return None
            out, at = [], 0
            for kind, a, z, _, _ in spans:  # base spans of two kinds may overlap
                if a >= at:
                    out += [t[at:a], f"<{kind.upper()}>"]
                at = max(at, z)
            return "".join(out) + t[at:]
        return lambda texts: [[clean(t) for t in texts]]

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    got = map_texts(docs.select(row, "text"), make, StructType([StructField("clean", StringType())]), ["row"])

    def value(c):
        own = F.col("row").getField(c)
        if c == "text":
            return F.coalesce("clean", own)
        if c == "n_chars":
            return F.when(F.col("clean").isNotNull(), F.length("clean")).otherwise(own).cast(docs.schema[c].dataType)
        return own
    return got.select(*[value(c).alias(c) for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    """Columns of the op5 contract, from the operator's spans."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                      s["end"].cast("string"))), ",")
    found = find(docs)
    own = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter(own, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(k) for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(own), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("top_score"))
