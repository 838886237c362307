"""Personal data in texts: four fixed forms found exactly, and further spellings by a semi-Markov conditional random field.

Fixed forms are mail addresses, network addresses, card numbers and phone numbers. Each is found in time in proportion to the text.
For other spellings, runs of tokens that could be an entity are candidates: their whole spans have features (the shape of the span,
its digits, check sums, separators, beginning and end, and the words around it), and ``semi_markov`` jointly decides which
candidates of a stretch of text are entities, and of which type.

The field learns from a bounded sample of texts: what the fixed forms accept is an entity, every other candidate is not. Rewritten
spellings, which no fixed form accepts, and numbers that are nobody's (dates, prices, versions, counts) are put between words of these texts.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import map_slices, pick, texts_of
from .learning import bucket, smallest
from .semi_markov import Field, Window, best_types, train

BASE_KINDS = ("email", "ip", "card", "phone")
#: Types of the field; their spans are named with this prefix, to tell them from the fixed forms.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
FOUND = "crf_"
#: Texts that the field learns from, the longest of them in bytes, and rewritten spellings put into each.
SAMPLE_ROWS, SAMPLE_BYTES, PUT_IN = 800, 20_000, 4
#: Tokens of an entity at most, digits of a candidate without a mail sign at least, tokens of a window that is decided at once.
MOST, DIGITS, WINDOW = 9, 7, 400
BUCKETS = 1 << 15
WIDTH = 18

Span = tuple[str, int, int]

# The characters of the four forms.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBER = re.compile(r"[0-9]+")
_PHONE_REST = re.compile(r"[\x20().0-9-]*")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> list[Span]:
    found, floor = [], 0
    if "@" in text:
        for local in _LOCAL.finditer(text):
            start, at = max(floor, local.start()), local.end()
            if start < at and text.startswith("@", at) and (domain := _DOMAIN.match(text, at + 1)):
                floor = domain.end()
                found.append(("email", start, floor))
    return found


def _chains(text: str) -> list[Span]:
    """Network addresses and card numbers: numbers joined by single dots, or by at most one space or hyphen."""
    found: list[Span] = []
    dotted: list[tuple[int, int]] = []
    joined: list[tuple[int, int]] = []

    def close_dotted() -> None:
        for at in range(0, len(dotted) - 3, 4):
            four = dotted[at : at + 4]
            if all(len(part) < 4 and int(part) < 256 for part in (text[s:e].lstrip("0") or "0" for s, e in four)):
                found.append(("ip", four[0][0], four[3][1]))
        dotted.clear()

    def close_joined() -> None:
        if joined and 16 <= sum(e - s for s, e in joined) <= 19 and luhn("".join(text[s:e] for s, e in joined)):
            found.append(("card", joined[0][0], joined[-1][1]))
        joined.clear()

    before = -2
    for number in _NUMBER.finditer(text):
        start, end = number.span()
        gap = text[before] if start == before + 1 else ""
        if gap != ".":
            close_dotted()
        if gap not in (" ", "-"):
            close_joined()
        dotted.append((start, end))
        joined.append((start, end))
        before = end
    close_dotted()
    close_joined()
    return found


def _phones(text: str) -> list[Span]:
    found, at = [], text.find("+")
    while at >= 0:
        if text[at + 1 : at + 2] in tuple("0123456789"):
            rest = _PHONE_REST.match(text, at + 2).group().rstrip(" ().-")
            if len(rest) > 1 and 8 <= 1 + sum(map(rest.count, "0123456789")) <= 15:
                found.append(("phone", at, at + 2 + len(rest)))
        at = text.find("+", at + 1)
    return found


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed forms, by kind as in ``BASE_KINDS`` and then by start."""
    found = _emails(text) + _chains(text) + _phones(text)
    return sorted(found, key=lambda span: (BASE_KINDS.index(span[0]), span[1]))


# ---- candidates ----

_TOKEN = re.compile(r"[^\s,;:!?=<>|\"'\[\]{}*]+")
_TELLING = re.compile(r"[0-9@]|(?i:\bdot\b)")
_NUMERIC = re.compile(r"[(+]*[0-9][0-9().+/-]*")
_JOINER = re.compile(r"[-–/.()+]+")
_ACCOUNT, _ACCOUNT_PART = re.compile(r"[A-Z]{2}[0-9]{2}[0-9A-Z]{0,30}"), re.compile(r"[0-9A-Z]{1,4}")
_AT, _DOT = frozenset({"at", "(at)", "@"}), frozenset({"dot", "(dot)", "."})
_NAME = re.compile(r"[A-Za-z0-9._%+-]+")
_GAP = re.compile(r"[ \t\[\]]{0,3}")
_RUNS = re.compile(r"[0-9]+|[a-z]+|[A-Z]+")


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """Without punctuation around, and without a parenthesis whose partner is not inside."""
    while start < end and (text[start] in ".-–/)" or (text[start] == "(" and ")" not in text[start:end])):
        start += 1
    while start < end and (text[end - 1] in ".-–/(+" or (text[end - 1] == ")" and "(" not in text[start:end])):
        end -= 1
    return start, end


def _mail_end(tokens: list[str], at: int) -> int:
    """The token behind a spelled-out mail address that begins at ``at``, or ``at``."""
    if at + 2 >= len(tokens) or not _NAME.fullmatch(tokens[at]) or tokens[at + 1].lower() not in _AT or not _NAME.fullmatch(tokens[at + 2]):
        return at
    end = at + 3
    while end + 1 < len(tokens) and end + 2 - at <= MOST and tokens[end].lower() in _DOT and _NAME.fullmatch(tokens[end + 1]):
        end += 2
    return end if end > at + 3 or "." in tokens[at + 2].strip(".") else at


@dataclass
class Found:
    """Candidates of a text: windows of tokens, and for each candidate its place in the text."""

    windows: list[Window]
    places: list[list[tuple[int, int]]]


def _clusters(tokens: list[str], near: list[bool]) -> list[tuple[int, int]]:
    """Spans of tokens that could be an entity, by begin."""
    found = []
    for at, token in enumerate(tokens):
        if "@" in token.strip("@"):
            found.append((at, at + 1))
        elif not token[0].isdigit() and (end := _mail_end(tokens, at)) > at and all(near[at : end - 1]):
            found.append((at, end))
        if _ACCOUNT.fullmatch(token):
            found += [(at, end) for end in _grown(tokens, near, at, _ACCOUNT_PART)]
        elif _NUMERIC.fullmatch(token):
            found += [(at, end) for end in _grown(tokens, near, at, _NUMERIC)]
    return found


def _grown(tokens: list[str], near: list[bool], at: int, part: re.Pattern) -> list[int]:
    """Ends of candidates that begin at ``at`` and go on with tokens like ``part`` or with joiners."""
    ends, digits, end = [], 0, at
    while end < min(len(tokens), at + MOST) and (end == at or near[end - 1]):
        token = tokens[end]
        if end > at and not part.fullmatch(token) and not _JOINER.fullmatch(token):
            break
        digits += sum(c.isdigit() for c in token)
        end += 1
        if digits >= DIGITS and not _JOINER.fullmatch(token):
            ends.append(end)
    return ends


def _iban(span: str) -> bool:
    span = span.replace(" ", "")
    return len(span) > 14 and int("".join(str(int(c, 36)) for c in span[4:] + span[:4])) % 97 == 1


def _features(text: str, start: int, end: int, tokens: int, before: str, behind: str) -> list[int]:
    span = text[start:end]
    digits = "".join(c for c in span if c in "0123456789")
    shape = _RUNS.sub(lambda m: ("9" if m[0][0] <= "9" else "A" if m[0][0] <= "Z" else "a") * min(len(m[0]), 5), span)
    loose = _RUNS.sub(lambda m: "9" if m[0][0] <= "9" else "A" if m[0][0] <= "Z" else "a", span)
    parts = re.findall("[0-9]+", span)
    own = [
        "any", f"shape={shape[:60]}", f"loose={loose[:60]}", f"digits={min(len(digits), 24)}", f"tokens={tokens}", f"parts={min(len(parts), 10)}",
        f"sizes={'-'.join(str(len(p)) for p in parts[:8])}", f"begins={shape[:3]}", f"ends={shape[-3:]}", f"before={before}", f"behind={behind}",
        f"joined={''.join(sorted({c for c in span if not c.isalnum()}))[:12]}", f"length={min(len(span) // 3, 20)}",
    ]
    if 12 < len(digits) < 20:
        own.append(f"luhn={luhn(digits)} {len(digits)}")
    if len(parts) == 4:
        own.append(f"octets={all(len(p) < 4 and int(p) < 256 for p in parts)} {'.' in span}")
    if "@" in span or "dot" in span.lower():
        own.append(f"mail={'@' in span}{'dot' in span.lower()} {span.rpartition('.')[2].rpartition(' ')[2].isalpha()}")
    if _ACCOUNT.match(span) and span.replace(" ", "").isalnum() and span.isascii() and len(span) < 60:
        own.append(f"account={_iban(span)}")
    if digits:
        own.append(f"first={digits[0]}" if len(digits) > 12 else f"zero={digits[:2]}" if digits[0] == "0" else f"few={len(digits)} {len(parts)}")
    return [1 + bucket(name, BUCKETS - 1) for name in own[:WIDTH]] + [0] * (WIDTH - len(own))


def candidates(text: str) -> Found:
    """Windows of all candidates in a text; windows without common tokens are independent, and very long ones are cut."""
    found = Found([], [])
    if not _TELLING.search(text):
        return found
    marks = [m.span() for m in _TOKEN.finditer(text)]
    tokens = [text[s:e] for s, e in marks]
    near = [_GAP.fullmatch(text, a[1], b[0]) is not None for a, b in zip(marks, marks[1:], strict=False)]
    spans = _clusters(tokens, near)
    at = 0
    while at < len(spans):
        begin, end, to = spans[at][0], spans[at][1], at + 1
        while to < len(spans) and spans[to][0] < end and spans[to][1] - begin <= WINDOW:
            end, to = max(end, spans[to][1]), to + 1
        own, places, rows = [], [], []
        for s, e in spans[at:to]:
            start, stop = _trimmed(text, marks[s][0], marks[e - 1][1])
            if start < stop:
                own.append((s - begin, e - begin))
                places.append((start, stop))
                rows.append(_features(text, start, stop, e - s, tokens[s - 1].lower() if s else "", tokens[e].lower() if e < len(tokens) else ""))
        if own:
            found.windows.append(Window(end - begin, own, np.array(rows)))
            found.places.append(places)
        at = to
    return found


# ---- what the field learns from ----

def _digits(pick: random.Random, count: int) -> str:
    return "".join(pick.choice("0123456789") for _ in range(count))


def _card(pick: random.Random, size: int) -> str:
    body = pick.choice("3456") + _digits(pick, size - 2)
    return next(body + d for d in "0123456789" if luhn(body + d))


def _account(pick: random.Random) -> str:
    land, body = pick.choice(["DE", "FR", "ES", "GB", "NL", "AT"]), _digits(pick, pick.choice([14, 16, 18, 20]))
    return next(f"{land}{check:02}{body}" for check in range(2, 99) if _iban(f"{land}{check:02}{body}"))


def _grouped(digits: str, sizes: list[int], by: str) -> str:
    parts, at = [], 0
    for size in sizes:
        parts.append(digits[at : at + size])
        at += size
    return by.join(part for part in [*parts, digits[at:]] if part)


def _name(pick: random.Random) -> str:
    return "".join(pick.choice("abcdefghiklmnoprstuw") for _ in range(pick.randint(3, 9))) + pick.choice(["", "", str(pick.randint(1, 99))])


def _spelled(pick: random.Random, kind: str) -> str:
    """A spelling of a made-up entity that the fixed forms leave out."""
    if kind == "email":
        at, dot = pick.choice([(" at ", " dot "), (" (at) ", " (dot) "), (" [at] ", " [dot] "), (" AT ", " DOT "), (" @ ", "."), (" at ", "."), (" [at] ", ".")])
        return pick.choice(["", "", _name(pick) + "."]) + _name(pick) + at + _name(pick) + dot + pick.choice(["com", "org", "net", "de", "fr", "example.com", "co.uk"])
    if kind == "ip":
        return pick.choice([" . ", "-", " - "]).join(str(pick.randint(0, 255)) for _ in range(4))
    if kind == "card":
        size = pick.choice([13, 15, 15, 16, 16])
        sizes = [4, 6] if size == 15 else [4, 4, 4]
        return _grouped(_card(pick, size), sizes, pick.choice([".", "/", " - ", "  "] if size == 16 else [" ", "-", "."]))
    if kind == "iban":
        account = _account(pick)
        return account if pick.random() < 0.4 else _grouped(account, [4] * 8, " ")
    if kind == "ssn":
        return _grouped(_digits(pick, 9), [3, 2], "-")
    area, local, line = str(pick.randint(201, 989)), _digits(pick, 3), _digits(pick, 4)
    abroad = pick.choice(["00", "00 "]) + str(pick.randint(30, 99)) + " " + _grouped(_digits(pick, pick.randint(8, 10)), pick.choice([[3, 3], [2, 4], [1, 2, 2, 2]]), " ")
    return pick.choice([f"({area}) {local}-{line}", f"({area}){local}-{line}", f"{area}-{local}-{line}", f"{area}.{local}.{line}", f"1-{area}-{local}-{line}", abroad])


def _nobodys(pick: random.Random) -> str:
    """A number that is no personal data."""
    year, month, day = pick.randint(1900, 2030), pick.randint(1, 12), pick.randint(1, 28)
    return pick.choice([
        f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}", f"{day}/{month}/{year}", f"{year}-{pick.randint(1900, 2030)}", f"{year} - {year + 9}",
        _digits(pick, pick.randint(7, 12)), _digits(pick, pick.randint(13, 24)), _grouped(_digits(pick, pick.choice([9, 12])), [3, 3, 3], " "),
        f"{year}{month:02}{day:02}", f"978-{_digits(pick, 1)}-{_digits(pick, 2)}-{_digits(pick, 6)}-{_digits(pick, 1)}", f"{pick.randint(1, 9)}.{_digits(pick, 8)}",
        f"{year} {year + 1} {year + 2}", f"{_digits(pick, 4)}/{_digits(pick, 4)}", ".".join(str(pick.randint(256, 999)) for _ in range(4)), "-".join(_digits(pick, 4) for _ in range(3)),
        f"{pick.randint(1000, 9999)} {pick.randint(1000, 9999)}", f"{_digits(pick, 3)}.{_digits(pick, 3)}.{_digits(pick, 3)}", f"{_name(pick)} at {_name(pick)}.", f"v{pick.randint(1, 9)}.{pick.randint(0, 99)}.{_digits(pick, 5)}"])


def examples(texts: list[str], put_in: int = PUT_IN, salt: int = 3) -> tuple[list[Window], list[np.ndarray]]:
    """Windows of ``texts`` with spellings and numbers put between their words, and the types of their candidates."""
    pick = random.Random(salt)
    windows, truth = [], []
    for text in texts:
        words, spelled = text.split(" "), []
        for at in sorted((pick.randrange(len(words) + 1) for _ in range(2 * put_in)), reverse=True):
            kind = pick.choice(KINDS) if pick.random() < 0.5 else ""
            spelled.append((at, kind, _spelled(pick, kind) if kind else _nobodys(pick)))
        parts, told, size, at = [], {}, 0, 0
        for place, kind, value in reversed(spelled):
            for part in (*words[at:place], value):
                if part is value and kind:
                    told[size, size + len(value)] = 1 + KINDS.index(kind)
                parts.append(part)
                size += len(part) + 1
            at = place
        whole = " ".join([*parts, *words[at:]])
        told |= {(start, end): 1 + KINDS.index(kind) for kind, start, end in base_spans(whole)}
        found = candidates(whole)
        for window, places in zip(found.windows, found.places, strict=True):
            own = np.array([told.get(place, 0) for place in places])
            for k in np.flatnonzero(own):
                clash = [j for j in range(k) if own[j] and window.spans[j][1] > window.spans[k][0]]
                own[k] = 0 if clash else own[k]
            windows.append(window)
            truth.append(own)
    return windows, truth


def private_model(docs: DataFrame, rows: int = SAMPLE_ROWS, most: int = SAMPLE_BYTES) -> Field:
    """Fitted on the ``rows`` texts of at most ``most`` bytes with the smallest hashes of ids."""
    texts = pick(docs, "doc_id", "text").where(F.col("text").isNotNull() & (F.octet_length("text") <= most))
    return train(*examples([row.text for row in smallest(texts, F.xxhash64("doc_id"), "text", rows, docs.count())]), list(KINDS), BUCKETS)


def field_spans(text: str, model: Field) -> list[Span]:
    """Spans that the field finds, by start."""
    found = candidates(text)
    spans = []
    for window, places in zip(found.windows, found.places, strict=True):
        types = best_types(window, model.scores(window.features), model.moves)
        spans += [(FOUND + model.kinds[types[k] - 1], *places[k]) for k in np.flatnonzero(types)]
    return sorted(spans, key=lambda span: span[1:])


def all_spans(text: str, model: Field) -> list[Span]:
    """The fixed forms, then the field's spans that overlap none of them, by kind and start."""
    base = base_spans(text)
    taken = sorted((start, end) for _, start, end in base)
    starts, ends = np.array([t[0] for t in taken]), np.maximum.accumulate([t[1] for t in taken]) if taken else np.zeros(0)
    more = []
    for kind, start, end in field_spans(text, model):
        at = int(np.searchsorted(starts, end, "left")) if taken else 0
        if not at or ends[at - 1] <= start:
            more.append((kind, start, end))
    order = [FOUND + kind for kind in KINDS]
    return base + sorted(more, key=lambda span: (order.index(span[0]), span[1]))


def find_private(docs: DataFrame, model: Field) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id and ``spans``, an array of (kind, start, end).

    Places are code points, the end is exclusive. A null text has no spans, like an empty one; repeated rows and null
    ids are kept as they are; an empty table gives no rows; other columns are not read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [[{"kind": k, "start": s, "end": e} for k, s, e in all_spans(text, shipped.value)] for text in texts_of(batch)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(spans, kind)], ["doc_id", "spans"])

    return map_slices(pick(docs, "doc_id", "text"), work, "doc_id bigint, spans array<struct<kind: string, start: bigint, end: bigint>>")


def masked(text: str, spans: list[Span], shown: Callable[[str], str] = lambda kind: f"<{kind.removeprefix(FOUND)}>") -> str:
    """The text with each span replaced by its kind."""
    parts, done = [], 0
    for kind, start, end in sorted(spans, key=lambda span: span[1:]):
        if start >= done:
            parts += [text[done:start], shown(kind)]
        done = max(done, end)
    return "".join([*parts, text[done:]])
