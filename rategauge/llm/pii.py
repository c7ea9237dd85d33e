"""Personal data: fixed formats, and candidates chosen by boosted trees.

Base spans are the fixed formats of ``BASE`` (email, ip, card, phone), found in one walk over the text
each. Beyond them, generators of high recall propose spans that may overlap: emails in disguise,
secrets to the end of their run, and of every run of digit groups each part made of whole groups, with
7 to 15 digits as a phone number and with 13 to 19 as a card number. So a number that stands next to a
date or another number is proposed by itself. Boosted trees score each candidate by its format and by
the words around it; per kind the threshold is the lowest score that reaches ``PRECISION`` on held-out
examples. Chosen candidates are added where they touch no base span, the best first where they overlap.

The trees are fitted on the driver on examples written by rule, and on candidates from at most
``SAMPLE`` documents (drawn by a hash of their text) whose format settles the label:
numbers that fail the card checksum and plain words are no personal data. Everything else is done in
one pass over all documents, each by itself: no shuffle, whatever the number of copies.

Defined results: a null or empty text has no spans; rows that repeat are searched each; an empty
table gives an empty result (the trees are then fitted on the rule-made examples alone); other
columns are left alone. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rategauge.llm.arrays import pieces
from rategauge.llm.boost import Boosted, threshold

SAMPLE = 2000
PRECISION = 0.98
#: Candidates scored at a time.
SCORED = 1 << 16

#: Formats fixed by contract; the order is that of the digest.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _EMAIL.match(text, start) if start < at else None
        if found:
            yield "email", start, found.end()
        done = found.end() if found else at + 1
        at = text.find("@", done)


def _ips(text: str) -> Iterator[Span]:
    """A run of dotted numbers is taken four at a time from its start."""
    for run in _DOTTED.finditer(text):
        if run.end() - run.start() < 7:
            continue
        parts = list(re.finditer("[0-9]+", run[0]))
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            if all(len(v := p[0].lstrip("0")) <= 3 and int(v or 0) <= 255 for p in four):
                yield "ip", run.start() + four[0].start(), run.start() + four[3].end()


def _cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end()


def _phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            yield "phone", m.start(), m.end()


def base_spans(text: str) -> list[Span]:
    return [*_emails(text), *_ips(text), *_cards(text), *_phones(text)]


# -- candidates ---------------------------------------------------------------

_TRIGGER = re.compile(r"[\[(]\x20?at\x20?[\])]|\x20at\x20(?=[A-Za-z0-9-]{2,40}(?:\x20?[\[(]?dot\b|\.[A-Za-z0-9]))")
_BEFORE = re.compile(r"[A-Za-z0-9._+-]{2,40}\x20?$")
_AFTER = re.compile(
    r"\x20?[A-Za-z0-9-]{2,40}(?:(?:\x20?[\[(]\x20?dot\x20?[\])]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{2,40}){1,4}"
)
_NUMBERS = re.compile(r"[0-9]+(?:[\x20./()-]{1,2}[0-9]+)*+")
_GROUP = re.compile("[0-9]+")
_SECRET = re.compile(r"[A-Za-z0-9_+/=-]{16,}+")
_PHONE_DIGITS, _CARD_DIGITS = range(7, 16), range(13, 20)


@dataclass(frozen=True)
class Candidate:
    """A span that might be personal data; for numbers also its groups and how many more its run has."""

    kind: str
    start: int
    end: int
    groups: tuple[int, ...] = ()
    before: int = 0
    after: int = 0

    @property
    def span(self) -> Span:
        return self.kind, self.start, self.end


def _numbers(text: str) -> Iterator[Candidate]:
    """Parts of whole digit groups; a sign or bracket that opens the part belongs to it."""
    for run in _NUMBERS.finditer(text):
        if run.end() - run.start() < _PHONE_DIGITS[0]:
            continue
        groups = [m.span() for m in _GROUP.finditer(text, *run.span())]
        sizes = [b - a for a, b in groups]
        for i, (start, _) in enumerate(groups):
            n = 0
            lead = text[start - 1 : start] if start else ""
            for j in range(i, len(groups)):
                n += sizes[j]
                if n > _CARD_DIGITS[-1]:
                    break
                if n < _PHONE_DIGITS[0]:
                    continue
                end = groups[j][1]
                opened = lead == "+" or lead == "(" and ")" in text[start:end]
                at = (start - opened, end, tuple(sizes[i : j + 1]), i, len(groups) - j - 1)
                if n in _PHONE_DIGITS:
                    yield Candidate("phone", *at)
                if n in _CARD_DIGITS:
                    yield Candidate("card", *at)


def candidates(text: str) -> Iterator[Candidate]:
    """Spans that might be personal data; they may overlap."""
    for m in _TRIGGER.finditer(text):
        left = _BEFORE.search(text[max(0, m.start() - 42) : m.start()])
        right = _AFTER.match(text, m.end())
        if left and right:
            yield Candidate("email", m.start() - len(left[0]), right.end())
    yield from _numbers(text)
    for m in _SECRET.finditer(text):
        yield Candidate("secret", m.start(), m.end())


_CONTEXT = tuple(
    re.compile(p, re.I)
    for p in (
        r"\b(?:phone|tel|telefon|call|mobile|fax|whatsapp)\b",
        r"\b(?:e-?mail|mail|contact|write)\b",
        r"(?:token|key|secret|passw|pwd|auth|bearer|credential)",
        r"\b(?:card|visa|amex|credit|carte|karte|tarjeta)\b",
        r"\b(?:isbn|issn|version|date|price|total|page|order)\b",
    )
)
_DATE = re.compile(r"(?<![0-9])(?:[0-9]{4}([-./\x20])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-./])[0-9]{1,2}\2[0-9]{4})(?![0-9])")
_REACH, _WORD = 32, 16


def _regions(found: list[Candidate]) -> Iterator[tuple[int, int]]:
    """Where the words before candidates stand, joined where they overlap."""
    start = end = -1
    for low, high in sorted((max(0, c.start - _REACH - _WORD), c.end) for c in found):
        if low > end:
            if end >= 0:
                yield start, end
            start, end = low, high
        end = max(end, high)
    if end >= 0:
        yield start, end


def _near(text: str, found: list[Candidate]) -> list[np.ndarray]:
    """For each context: whether one of its words ends within reach before the candidate."""
    regions, out = list(_regions(found)), []
    starts = np.array([c.start for c in found])
    for pattern in _CONTEXT:
        ends = np.array([m.end() for low, high in regions for m in pattern.finditer(text, low, high)] or [-_REACH - 1])
        last = ends[np.maximum(np.searchsorted(ends, starts, side="right") - 1, 0)]
        out.append((last <= starts) & (last > starts - _REACH))
    return out


def _shape(text: str, c: Candidate) -> list[float]:
    """Numbers on the candidate's own characters and its neighbours."""
    s = text[c.start : c.end]
    sizes = c.groups or tuple(len(g) for g in _GROUP.findall(s))
    n, entropy, letters, uppers, switches, hexa = sum(sizes), 0.0, 0, 0, 0, True
    if c.kind == "secret" or c.kind == "email":
        counts = Counter(s)
        letters = sum(k for ch, k in counts.items() if ch.isalpha())
        uppers = sum(k for ch, k in counts.items() if ch.isupper())
        entropy = -sum(k / len(s) * math.log2(k / len(s)) for k in counts.values())
        switches = sum(a.isdigit() != b.isdigit() for a, b in zip(s, s[1:]))
        hexa = all(ch in "0123456789abcdefABCDEF" for ch in counts)
    digits = _digits(s) if c.kind == "card" else ""
    return [
        KINDS.index(c.kind),
        len(s),
        n,
        letters,
        len(s) - n - letters,
        len(sizes),
        max(sizes, default=0),
        min(sizes, default=0),
        sizes[0] if sizes else 0,
        sizes[-1] if sizes else 0,
        luhn(digits) if digits else 0,
        int(digits[0]) if digits else 0,
        c.before,
        c.after,
        entropy,
        uppers,
        switches,
        hexa,
        text[c.start - 1 : c.start] in ("'", '"') if c.start else 0,
        text[c.end : c.end + 1] in ("'", '"'),
        text[max(0, c.start - 3) : c.start].rstrip()[-1:] in ("=", ":"),
        bool(_DATE.search(s)) if c.groups else 0,
        s[0] in "(0+",
    ]


def features(text: str, found: list[Candidate]) -> np.ndarray:
    """One row of numbers per candidate: its format, and what stands before and behind it."""
    shapes = np.array([_shape(text, c) for c in found], float)
    return np.column_stack([shapes, *_near(text, found)])


@dataclass
class Detector:
    model: Boosted
    thresholds: dict[str, float]

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Candidates above their threshold that touch no base span, best first where they overlap.

        Of equal scores the longer goes first, then the earlier. Places taken are marked in one array
        of the text's length, so the work grows with the text and its candidates alone.
        """
        every = candidates(text)
        first = next(every, None)
        if first is None:
            return []
        taken = np.zeros(len(text) + 1, bool)
        for _, start, end in base:
            taken[start:end] = True
        upto = np.concatenate([[0], np.cumsum(taken)])
        limits = np.array([self.thresholds[kind] for kind in KINDS])
        likely: list[tuple[float, Candidate]] = []
        held = [first]

        def score() -> None:
            free = [c for c in held if upto[c.end] == upto[c.start]]
            held.clear()
            if free:
                x = features(text, free)
                p = self.model.probability(x)
                likely.extend((float(p[k]), free[k]) for k in np.flatnonzero(p >= limits[x[:, 0].astype(int)]))

        for c in every:
            held.append(c)
            if len(held) >= SCORED:
                score()
        score()
        out: list[Span] = []
        for _, c in sorted(likely, key=lambda x: (-x[0], x[1].start - x[1].end, x[1].start, x[1].kind)):
            if not taken[c.start : c.end].any():
                taken[c.start : c.end] = True
                out.append(c.span)
        return out


def made_examples(n: int, seed: int = 11) -> list[tuple[str, Candidate, int]]:
    """Texts with one planted string each; candidates that touch it, 1 for the planted data itself."""
    r = random.Random(seed)
    letters, hexa = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"
    wide = letters + letters.upper() + "0123456789"

    def some(chars: str, low: int, high: int) -> str:
        return "".join(r.choice(chars) for _ in range(r.randint(low, high)))

    def number(*sizes: int, sep: str = "") -> str:
        return sep.join("".join(r.choice("0123456789") for _ in range(k)) for k in sizes)

    def card(valid: bool) -> str:
        sizes = r.choice(((4, 4, 4, 4), (4, 4, 4, 4), (16,), (4, 6, 5), (15,), (13,), (14,), (4, 4, 4, 4, 3), (19,)))
        sep = r.choice(" -")
        while True:
            s = r.choice("3456") + number(*sizes, sep=sep)[1:]
            if luhn(_digits(s)) == valid:
                return s

    def phone() -> str:
        sep = r.choice("-. ")
        forms = (number(3, 3, 4, sep=sep), "0" + number(3, 7, sep=" "), "0" + number(2, 3, 4, sep=sep), f"({number(3)}) {number(3, 4, sep='-')}", f"+{number(1, 3, 3, 4, sep=sep)}", f"({number(3)}) {number(3, 4, sep=' ')}")
        return r.choice(forms)

    def date() -> str:
        sep = r.choice("-./")
        year, month, day = str(r.randint(1900, 2035)), f"{r.randint(1, 12):02d}", f"{r.randint(1, 28):02d}"
        return sep.join(r.choice(((year, month, day), (day, month, year))))

    def filler() -> str:
        return " ".join(some(letters, 2, 9) for _ in range(r.randint(2, 6)))

    def beside() -> tuple[str, str]:
        """Numbers that stand next to the planted one, or none."""
        other = r.choice((date(), str(r.randint(1, 99)), f"{r.randint(1, 12):02d}/{r.randint(20, 39)}", f"{date()} 10:00"))
        return r.choice((("", ""), ("", ""), (other + " ", ""), ("", " " + other)))

    out = []
    for _ in range(n):
        sep = r.choice("- ./")
        name, site, top = some(letters, 3, 9), some(letters, 3, 9), r.choice(("com", "org", "net", "de"))
        at = r.choice((" (at) ", " [at] ", "(at)"))
        dot = r.choice((" (dot) ", " [dot] ", " dot ", "."))
        nothing = r.choice((date(), number(1, 3, 3, 3, sep=sep), number(r.randint(7, 15)), number(2, 2, 2, 2, 2, sep=" "), "978" + number(1, 2, 6, 1, sep="-"), f"{date()} {date()}", number(4, 4, sep=r.choice("- ")), number(3, 3, 3, sep="."), " ".join(number(r.randint(1, 4)) for _ in range(r.randint(3, 8)))))
        made = [
            ("email", name + at + site + dot + top, 1, ""),
            ("email", f"{name} at {site}.{some(letters, 2, 6).capitalize()}", 0, ""),
            ("phone", phone(), 1, r.choice(("", "", "tel ", "phone: ", "call "))),
            ("phone", phone(), 1, r.choice(("tel ", "phone: ", "call "))),
            ("phone", nothing, 0, r.choice(("", "date ", "order ", "isbn "))),
            ("card", card(True), 1, r.choice(("", "card ", "visa: ", "credit card "))),
            ("card", card(False), 0, r.choice(("", "card ", "order "))),
            ("card", nothing, 0, ""),
            ("phone", card(True), 0, r.choice(("", "card ", "visa: "))),
            ("secret", r.choice((some(hexa, 32, 64), some(wide, 20, 60), some(wide, 200, 400))), 1, r.choice(('token = "', "api_key: ", "secret=", 'password = "'))),
            ("secret", r.choice((some(letters, 16, 30), some(letters, 6, 12) + "-" + some(letters, 6, 12), r.choice("-=_") * r.randint(16, 60), some(letters, 5, 9) + "/" + some(letters, 5, 9) + "/" + some(letters, 4, 8), some(letters, 8, 16).title() + some(letters, 8, 16).title())), 0, r.choice(("", "the "))),
            ("secret", r.choice((number(16), number(20), some(letters, 12, 20) + number(4))), 0, ""),
        ]
        for kind, s, label, lead in made:
            left, right = beside() if kind in ("phone", "card") else ("", "")
            before = filler() + " " + lead + left
            tail = '"' if lead.endswith('"') else ""
            text = f"{before}{s}{right}{tail} {filler()}"
            start, end = len(before), len(before) + len(s)
            for c in candidates(text):
                if c.kind == kind and c.start < end and c.end > start:
                    itself = (c.start, c.end) == (start, end)
                    if itself or kind not in ("phone", "card"):
                        out.append((text, c, label))
                    elif not (kind == "card" and luhn(_digits(text[c.start : c.end]))):
                        out.append((text, c, 0))  # a part of it, or it with a neighbour
    return out


def settled_examples(texts: list[str]) -> list[tuple[str, Candidate, int]]:
    """Candidates of real texts whose format settles that they are nothing."""
    out = []
    for text in texts:
        for c in candidates(text):
            s = text[c.start : c.end]
            plain = c.kind == "secret" and (s.isalpha() or not any(ch.isalnum() for ch in s))
            if plain or c.kind == "card" and not luhn(_digits(s)):
                out.append((text, c, 0))
    return out


def fit(texts: list[str], precision: float = PRECISION, seed: int = 5) -> Detector:
    """Fit on two thirds of the examples, set thresholds on the rest."""
    examples = made_examples(400) + settled_examples(texts)
    x = np.concatenate([features(t, [c]) for t, c, _ in examples])
    y = np.array([label for _, _, label in examples], float)
    held = np.random.Generator(np.random.PCG64(seed)).random(len(y)) < 1 / 3
    model = Boosted(depth=4, rounds=80).fit(x[~held], y[~held])
    p = model.probability(x)
    limits = {}
    for i, kind in enumerate(KINDS):
        mine = held & (x[:, 0] == i)
        limits[kind] = threshold(p[mine], y[mine], precision) if mine.any() else 2.0
        limits[kind] = max(limits[kind], 0.5)
    return Detector(model, limits)


def fitted(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Detector:
    """A detector fitted with the help of at most ``sample`` documents, the same at every run.

    Documents are taken by a hash of their text whose bound lets about that many through, so what
    reaches the driver does not grow with the table.
    """
    rows = max(docs.count(), 1)
    bound = min(1 << 40, int((1 << 40) * sample / rows * 1.1) + 1)
    drawn = F.pmod(F.xxhash64(text), F.lit(1 << 40))
    chosen = docs.where(F.col(text).isNotNull() & (drawn < bound)).select(text)
    chosen = chosen.distinct().orderBy(F.xxhash64(text), text).limit(sample)
    return fit([row[0] for row in chosen.collect()])


def spans_of(text: str, detector: Detector) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, by kind and start."""
    base = base_spans(text)
    extra = detector.added(text, base)
    every = sorted(base + extra, key=lambda s: (KINDS.index(s[0]), s[1], s[2])) if extra else base
    return base, every


def _shown(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def found(docs: DataFrame, detector: Detector | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans)`` of every row.

    The four counts are of base spans; ``n_spans`` counts all, those the trees chose included.
    """
    detector = detector or fitted(docs, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            counts: list[list[int]] = [[] for _ in BASE]
            digest, shown, number = [], [], []
            for t in batch.column("text").to_pylist():
                base, every = spans_of(t or "", detector)
                for kind, into in zip(BASE, counts):
                    into.append(sum(s[0] == kind for s in base))
                digest.append(hashlib.sha256(_shown(base).encode()).hexdigest())
                shown.append(_shown(every))
                number.append(len(every))
            columns = [batch.column("id"), *(pa.array(c, pa.int64()) for c in counts)]
            columns += [pa.array(digest, pa.string()), pa.array(shown, pa.string()), pa.array(number, pa.int64())]
            names = ["id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "n_spans"]
            yield pa.record_batch(columns, names=names)

    source = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    numbers = ", ".join(f"n_{k} long" for k in BASE)
    out = source.mapInArrow(run, f"id {kind}, {numbers}, base_sha256 string, spans string, n_spans long")
    return out.withColumnRenamed("id", id)


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; spans that overlap become one."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, detector: Detector | None = None, text: str = "text") -> DataFrame:
    """``docs`` with personal data replaced; the other columns as they are, null stays null."""
    detector = detector or fitted(docs, text)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            texts = batch.column(place).to_pylist()
            clean = [t if t is None else redact(t, spans_of(t, detector)[1]) for t in texts]
            yield batch.set_column(place, text, pa.array(clean, pa.string()))

    return docs.mapInArrow(run, docs.schema)
