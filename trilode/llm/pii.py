"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds to them.

The patterns give the base spans, which always stay. The field looks at islands: runs of digit
groups with little between them, and spelled-out addresses. In an island every run of groups of up
to ``MOST_DIGITS`` digits together (no kind has more) is a candidate segment of each kind, scored by
features of the whole span; dynamic programming finds the best segmentation, or in training the
expected features. Its segments are added where they do not touch a base span and score better by
``MARGIN`` than being left alone. Decoding keeps the features of one start at a time, so an
island may be as long as a text.

Spelled-out addresses have up to 64 letters before the "at" and 63 in a label, the limits of the
standard for mail addresses. Islands have at least seven digits, as the shortest phone numbers do,
or four groups with dots between.

The field is trained on base spans of all texts, ``TRAIN_SPANS`` distinct ones of each kind by hash,
rewritten into forms that the patterns miss, and on number forms that are no personal data: dates,
times, coordinates, versions, rows of a table. Fixed examples of the formats (``FORMATS``) stand in for
a kind with fewer than ``LEAST_SPANS``.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import blake2b
from heapq import nsmallest
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trilode.llm.common import free_name, slices

# The kinds in the order in which spans at one place are listed.
KINDS = ("email", "ip", "card", "phone")
TRAIN_SPANS = 30
LEAST_SPANS = 5
PLAIN_NUMBERS = 12
# Addresses and numbers that stand for no one: reserved names, networks and exchanges, test cards.
FORMATS = {
    "email": ("ann.lee@mail3.example.com", "x_1@a-b.example", "info@example.org",
              "j.doe+news@example.net", "sam99@dept.example.edu"),
    "ip": ("192.168.0.1", "198.51.100.23", "203.0.113.77", "172.16.254.3", "192.0.2.146"),
    "card": ("4111 1111 1111 1111", "5500005555555559", "4012888888881881",
             "5555-5555-5555-4444", "6011 1111 1111 1117"),
    "phone": ("+1 (017) 555-7713", "+1 (361) 555-8283", "+1 212-555-0142", "+1 (646) 555-0199",
              "+1 415 555 0123"),
}
EPOCHS = 40
MOST_DIGITS = 19
LEAST_DIGITS = 7
MARGIN = 0.5

# Fixed patterns of the base spans. The local part of an address is found backwards from "@" and a
# dotted number only at the start of its digits, so that no text takes quadratic time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

_GROUP = re.compile(r"[0-9]+")
# What may lie between two groups: up to three marks, or a dot that was put in brackets.
_GAP = re.compile(r"[\x20().+/-]{1,3}|\x20?(?:\[(?:\.|(?i:dot))\]|[({](?:\.|(?i:dot))[)}])\x20?")
_WRAPPED_DOT = re.compile(r"\x20?[\[({](?:\.|(?i:dot))[\])}]\x20?")
_SPELLED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}"
    r"(?:\x20?[\[({](?i:at)[\])}]\x20?[A-Za-z0-9-]{1,63}"
    r"(?:(?:\x20?[\[({](?i:dot)[\])}]\x20?|\.|\x20(?i:dot)\x20)[A-Za-z0-9-]{1,63})+"
    r"|\x20(?i:at)\x20[A-Za-z0-9-]{1,63}(?:\x20(?i:dot)\x20[A-Za-z0-9-]{1,63})+)")
_MAY_SPELL = re.compile(r"[\[({](?i:at)[\])}]|\x20(?i:dot)\x20")
_DATE = re.compile(
    r"(?:(?:19|20)[0-9]{2}(?P<a>[-/.])(?:0?[1-9]|1[0-2])(?P=a)(?:0?[1-9]|[12][0-9]|3[01])"
    r"|(?:0?[1-9]|[12][0-9]|3[01])(?P<b>[-/.])(?:0?[1-9]|[12][0-9]|3[01])(?P=b)(?:19|20)[0-9]{2})(?![0-9])")
_FRACTION = re.compile(r"\.[0-9]{5,}")


class Span(NamedTuple):
    start: int
    end: int
    kind: str
    base: bool


def _digits(text: str) -> str:
    return "".join(filter(str.isdigit, text))


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            done = domain.end()
            yield start, done
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and then kind."""
    found = [Span(a, b, "email", True) for a, b in _emails(text)] if "@" in text else []
    if _GROUP.search(text):
        for m in _IP.finditer(text):
            if all(map(_octet, m[0].split("."))):
                found.append(Span(*m.span(), "ip", True))
        for m in _CARD.finditer(text):
            digits = _digits(m[0]) if len(m[0]) >= 14 else ""
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(Span(*m.span(), "card", True))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m[0])) <= 15:
                    found.append(Span(*m.span(), "phone", True))
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


# --- the field ---------------------------------------------------------------------------------

Groups = list[tuple[int, int]]


def _may_be_personal(text: str, run: Groups) -> bool:
    if sum(b - a for a, b in run) >= LEAST_DIGITS:
        return True
    return len(run) >= 4 and "." in text[run[0][1]:run[-1][0]]


def islands(text: str) -> Iterator[Groups]:
    """Digit groups that stand close together, and spelled-out addresses as islands of one group;
    digits first, each kind in the order of the text."""
    run: Groups = []
    for m in _GROUP.finditer(text):
        if run and not _GAP.fullmatch(text, run[-1][1], m.start()):
            if _may_be_personal(text, run):
                yield run
            run = []
        run.append(m.span())
    if run and _may_be_personal(text, run):
        yield run
    if _MAY_SPELL.search(text):
        for m in _SPELLED.finditer(text):
            yield [m.span()]


def _extent(text: str, groups: Groups, i: int, j: int) -> tuple[int, int]:
    """Bounds of groups ``i..j``, with an opening ``+`` or bracket before the first."""
    start, end = groups[i][0], groups[j][1]
    low = groups[i - 1][1] if i else 0
    if start > low and text[start - 1] == "(":
        start -= 1
    if start > low and text[start - 1] == "+":
        start -= 1
    return start, end


def features(text: str, groups: Groups, i: int, j: int) -> np.ndarray:
    """Features of groups ``i..j`` as one span, the same for each kind."""
    start, end = _extent(text, groups, i, j)
    span = text[start:end]
    spelled = float(not span[-1].isdigit() or "at" in span.lower())
    plain = "" if spelled else _WRAPPED_DOT.sub(".", span)
    wrapped = not spelled and len(plain) < len(span)
    digits = "" if spelled else _digits(span)
    gaps = _GROUP.sub("", plain)
    n, parts = len(digits), j - i + 1
    lengths = [b - a for a, b in groups[i:j + 1]]
    before = text[start - 1:start] if start else ""
    after = text[end:end + 1]
    glued = before.isalnum() or after.isalnum() or before in ("_", "#") and bool(before)
    dotted = parts == 4 and gaps == "..."
    alone = i == 0 and j == len(groups) - 1
    return np.array([
        1.0,
        spelled,
        spelled * bool(re.search(r"[\[({]at", span.lower())),
        span.startswith("+"),
        "(" in span and ")" in span,
        dotted and all(_octet(p) for p in plain.split(".")),
        dotted,
        dotted and wrapped and alone and all(_octet(p) for p in plain.split(".")),
        14 <= n <= 19 and luhn(digits),
        n < 10,
        n == 10,
        n in (11, 12),
        n == 13,
        14 <= n <= 19,
        n > 19,
        parts == 1,
        parts in (3, 4) and lengths[-1] == 4 and set(lengths[-3:-1]) == {3},
        len(set(lengths)) == 1 and parts > 1,
        len(set(gaps)) > 1,
        "/" in gaps,
        glued,
        n == 8 and parts == 3,
        alone,
        parts >= 10 and max(lengths) == 1,
        10 <= parts <= 15 and max(lengths) == 1 and alone,
        bool(_DATE.search(plain)),
        bool(_FRACTION.search(plain)),
        "." in gaps and " " in gaps,
        parts > 1 and gaps.strip(" ") == "" and not len(set(lengths)) == 1,
        n < 7,
    ], float)


WIDTH = 30


class Lattice(NamedTuple):
    """Candidate segments of an island: ``(i, j)`` per row of ``phi``."""

    size: int
    segments: list[tuple[int, int]]
    phi: np.ndarray


def _ends(groups: Groups, i: int) -> Iterator[int]:
    """Last groups of the segments that begin at group ``i``."""
    digits = 0
    for j in range(i, len(groups)):
        digits += groups[j][1] - groups[j][0]
        if digits > MOST_DIGITS and not (i == j and digits <= 320):  # an address is one long group
            return
        yield j


def lattice(text: str, groups: Groups) -> Lattice:
    segments = [(i, j) for i in range(len(groups)) for j in _ends(groups, i)]
    return Lattice(len(groups), segments,
                   np.array([features(text, groups, i, j) for i, j in segments]).reshape(-1, WIDTH))


def _gradient(lat: Lattice, weights: np.ndarray, gold: dict[tuple[int, int], int]) -> np.ndarray:
    """Gradient of the log-likelihood of one segmentation: its features less the expected ones."""
    scores = lat.phi @ weights.T
    ahead, back = np.full(lat.size + 1, -np.inf), np.full(lat.size + 1, -np.inf)
    ahead[0] = back[lat.size] = 0.0
    whole = np.logaddexp.reduce(scores, axis=1)
    ending: dict[int, list[int]] = {}
    starting: dict[int, list[int]] = {}
    for k, (i, j) in enumerate(lat.segments):
        ending.setdefault(j, []).append(k)
        starting.setdefault(i, []).append(k)
    for j in range(lat.size):
        ahead[j + 1] = np.logaddexp.reduce(
            [ahead[j], *(ahead[lat.segments[k][0]] + whole[k] for k in ending[j])])
    for i in reversed(range(lat.size)):
        back[i] = np.logaddexp.reduce(
            [back[i + 1], *(back[lat.segments[k][1] + 1] + whole[k] for k in starting[i])])
    ends = np.array(lat.segments)
    share = np.exp(scores + (ahead[ends[:, 0]] + back[ends[:, 1] + 1] - ahead[-1])[:, None])
    hit = np.zeros_like(share)
    for k, segment in enumerate(lat.segments):
        if segment in gold:
            hit[k, gold[segment]] = 1.0
    return (hit - share).T @ lat.phi


Choices = Iterator[list[tuple[int, float, int]]]


def _decode(size: int, starting: Choices) -> list[tuple[int, int, int]]:
    """The best segmentation as ``(i, j, kind)`` from what can begin at each group in turn:
    ``(j, value, kind)``. A group outside any segment scores zero."""
    best, came = [0.0] + [-np.inf] * size, [None] * (size + 1)
    for i, choices in enumerate(starting):
        if best[i] > best[i + 1]:
            best[i + 1], came[i + 1] = best[i], None
        for j, value, kind in choices:
            if best[i] + value > best[j + 1]:
                best[j + 1], came[j + 1] = best[i] + value, (i, j, kind)
    found, at = [], size
    while at:
        if (segment := came[at]) is None:
            at -= 1
        else:
            found.append(segment)
            at = segment[0]
    return found


def best_segments(lat: Lattice, weights: np.ndarray) -> list[tuple[int, int, int]]:
    """The best segmentation of a lattice."""
    scores = lat.phi @ weights.T
    by_start: list[list[tuple[int, float, int]]] = [[] for _ in range(lat.size)]
    for (i, j), row in zip(lat.segments, scores):
        by_start[i].append((j, float(row.max()), int(row.argmax())))
    return _decode(lat.size, iter(by_start))


def decode(text: str, groups: Groups, weights: np.ndarray) -> list[tuple[int, int, int]]:
    """Like :func:`best_segments`, less ``MARGIN`` for each segment, with the features of one start
    at a time: those of the groups within ``MOST_DIGITS`` digits."""

    def starting() -> Choices:
        for i in range(len(groups)):
            ends = list(_ends(groups, i))
            if not ends:
                yield []
                continue
            scores = np.array([features(text, groups, i, j) for j in ends]) @ weights.T
            yield [(j, float(row.max()) - MARGIN, int(row.argmax())) for j, row in zip(ends, scores)]

    return _decode(len(groups), starting())


def _rewritten(kind: str, span: str, rng: np.random.Generator) -> Iterator[tuple[str, bool]]:
    """Forms of a base span, each with whether it is still personal data."""
    yield span, True
    digits = _digits(span)
    if kind == "email":
        local, domain = span.split("@", 1)
        yield f"{local} at {domain.replace('.', ' dot ')}", True
        yield f"{local} (at) {domain}", True
        yield f"{local}[at]{domain.replace('.', '[dot]')}", True
        yield f"{local} AT {domain.replace('.', ' DOT ')}", True
    elif kind == "phone":
        last = digits[-10:]
        yield f"({last[:3]}) {last[3:6]}-{last[6:]}", True
        yield f"{last[:3]}-{last[3:6]}-{last[6:]}", True
        yield f"{last[:3]}.{last[3:6]}.{last[6:]}", True
        yield " ".join(last), True
        yield " ".join(last * 3), False
        yield last, False
        yield f"{last[:4]}-{last[4:6]}-{last[6:8]}", False
        yield f"{last[:3]} {last[3:8]}", False
    elif kind == "card":
        yield "/".join(digits[i:i + 4] for i in range(0, len(digits), 4)), True
        yield ".".join(digits[i:i + 4] for i in range(0, len(digits), 4)), True
        wrong = digits[:-1] + str((int(digits[-1]) + int(rng.integers(1, 10))) % 10)
        yield wrong, False
        yield "-".join(wrong[i:i + 4] for i in range(0, len(wrong), 4)), False
        yield digits[:13], False
        yield digits[:9], False
    else:
        parts = span.split(".")
        yield "[.]".join(parts), True
        yield "(.)".join(parts), True
        yield "[dot]".join(parts), True
        yield "[.]".join([*parts, "7"]), False
        yield ".".join([*parts[:3], str(256 + int(rng.integers(0, 700)))]), False
        yield ".".join([*parts, "7"]), False
        yield ".".join(parts[:3]) + "0", False


def _plain_numbers(rng: np.random.Generator, count: int) -> Iterator[str]:
    """Number forms that are nobody's: dates, times, coordinates, versions, codes, rows of a table."""
    def n(low: int, high: int) -> int:
        return int(rng.integers(low, high))

    for _ in range(count):
        year, month, day = n(1900, 2100), n(1, 13), n(1, 29)
        date = f"{year}-{month:02}-{day:02}"
        yield date
        yield f"{date} {n(10, 10**8)}"
        yield f"{date} {n(0, 24):02}"
        yield f"{day:02}/{month:02}/{year} {n(0, 10**6)}"
        yield f"{day}.{month}.{year}"
        yield f"{year}{month:02}{day:02} {n(0, 240000):06}"
        yield f"{date} {year + 1}-{month:02}-{day:02}"
        yield f"{n(0, 90)}.{n(10**5, 10**6)} {n(0, 180)}"
        yield f"{n(0, 90)}.{n(10**5, 10**6)} {n(0, 180)}.{n(10**5, 10**6)}"
        yield f"{n(0, 90)}.{n(1000, 10**4)} {n(0, 180)}.{n(1000, 10**4)}"
        yield f"{n(0, 10)}.{n(10**8, 10**12)}"
        yield f"{n(0, 30)}.{n(0, 30)}.{n(0, 30)}-{n(1, 10**4)}"
        yield f"{n(0, 30)}.{n(0, 30)}.{n(1000, 10**5)}.{n(256, 10**4)}"
        yield f"{n(1, 9)}[.]{n(1, 30)}[.]{n(1, 30)}[.]{n(256, 999)}"
        yield " ".join(str(n(0, 10**6)) for _ in range(n(2, 9)))
        yield " ".join(str(n(100, 1000)) for _ in range(n(3, 9)))
        yield " ".join(str(n(1000, 10**4)) for _ in range(n(2, 4)))
        yield " ".join(str(n(0, 10)) for _ in range(n(14, 40)))
        yield " ".join(str(n(10, 100)) for _ in range(n(4, 12)))
        yield f"{n(1, 999)} {n(0, 999):03} {n(0, 999):03}"
        yield f"978-{n(0, 9)}-{n(10, 99)}-{n(100000, 999999)}-{n(0, 9)}"
        yield f"{year}-{year + 3} {n(0, 10**4)}"
        yield f"{n(0, 10**4)}/{n(0, 10**4)} {n(0, 100)}"


def train(examples: list[tuple[str, str]], seed: int = 0) -> np.ndarray | None:
    """Weights by kind and feature from ``(kind, span text)`` examples; None without any."""
    rng = np.random.default_rng(seed)
    data = []
    for kind, span in examples:
        for form, personal in _rewritten(kind, span, rng):
            text = f" {form} "
            for groups in islands(text):
                gold = {(0, len(groups) - 1): KINDS.index(kind)} if personal else {}
                data.append((lattice(text, groups), gold))
    if not data:
        return None
    for form in _plain_numbers(rng, PLAIN_NUMBERS):
        data += [(lattice(form, groups), {}) for groups in islands(form)]
    data = [(lat, gold) for lat, gold in data if lat.segments and gold.keys() <= {*lat.segments}]
    weights, total = np.zeros((len(KINDS), WIDTH)), np.full((len(KINDS), WIDTH), 1e-6)
    for _ in range(EPOCHS):
        step = sum(_gradient(lat, weights, gold) for lat, gold in data) - 0.02 * weights
        total += step * step
        weights += 0.7 * step / np.sqrt(total)
    return weights


def _rank(kind: str, span: str) -> int:
    return int.from_bytes(blake2b(f"{kind}:{span}".encode(), digest_size=8).digest()) >> 1


def fit(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Train on base spans of all texts: the ``TRAIN_SPANS`` distinct ones of each kind that come
    first by hash, with fixed examples for kinds of which there are hardly any."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first spans of a task; the first of all are among those of the tasks."""
        kept: dict[str, list[tuple[int, str]]] = {kind: [] for kind in KINDS}
        for batch in slices(batches):
            new: dict[str, set[tuple[int, str]]] = {}
            for t in batch.column(0).to_pylist():
                for s in base_spans(t) if t else ():
                    # A span that is no island by itself shows the field nothing.
                    if s.end - s.start <= 100 and _shown(s.kind, span := t[s.start:s.end]):
                        new.setdefault(s.kind, set()).add((_rank(s.kind, span), span))
            for kind, spans in new.items():
                kept[kind] = nsmallest(TRAIN_SPANS, spans.union(kept[kind]))
        found = [(kind, *one) for kind, spans in kept.items() for one in spans]
        yield pa.RecordBatch.from_pydict(
            {"kind": [k for k, _, _ in found], "hash": [h for _, h, _ in found],
             "span": [s for _, _, s in found]},
            schema=pa.schema([("kind", pa.string()), ("hash", pa.int64()), ("span", pa.string())]))

    spans = docs.select(text_col).mapInArrow(first, "kind string, hash bigint, span string").distinct()
    rank = F.row_number().over(Window.partitionBy("kind").orderBy("hash", "span"))
    rows = spans.withColumn("rank", rank).where(F.col("rank") <= TRAIN_SPANS).collect()
    examples = sorted((KINDS.index(r.kind), r.rank, r.span) for r in rows)
    found = [(KINDS[k], span) for k, _, span in examples]
    for kind in KINDS:
        missing = max(0, LEAST_SPANS - sum(k == kind for k, _ in found))
        found += [(kind, span) for span in FORMATS[kind][:missing]]
    return train(found)


def _shown(kind: str, span: str) -> bool:
    return kind == "email" or next(islands(f" {span} "), None) is not None


def all_spans(text: str, weights: np.ndarray | None) -> list[Span]:
    """Base spans and the field's additions, by start and then kind."""
    base = base_spans(text)
    if weights is None:
        return base
    # base spans as disjoint stretches in order, so that each island finds its own by bisection
    starts: list[int] = []
    ends: list[int] = []
    for span in base:
        if ends and span.start < ends[-1]:
            ends[-1] = max(ends[-1], span.end)
        else:
            starts.append(span.start)
            ends.append(span.end)

    def touched(start: int, end: int) -> bool:
        at = bisect_right(ends, start)
        return at < len(starts) and starts[at] < end

    added = []
    for groups in islands(text):
        first, last = groups[0][0], groups[-1][1]
        at = bisect_right(ends, first)
        if at < len(starts) and starts[at] <= first and last <= ends[at]:
            continue
        for i, j, kind in decode(text, groups, weights):
            start, end = _extent(text, groups, i, j)
            if not touched(start, end):
                added.append(Span(start, end, KINDS[kind], False))
    if not added:
        return base
    return sorted(set(base + added), key=lambda s: (s.start, KINDS.index(s.kind)))


SPANS = "array<struct<start:int,end:int,kind:string,base:boolean>>"


def find(docs: DataFrame, text_col: str = "text", spans_col: str = "pii_spans",
         weights: np.ndarray | None = None) -> DataFrame:
    """``docs`` with a column of spans ``(start, end, kind, base)``, in code points, end exclusive.

    A null or empty text has no spans. Repeated rows stay; all other columns pass through, and one
    that is already called ``spans_col`` is replaced. Without ``weights`` they are fitted on
    ``docs``; kinds without base spans there are known to the field by fixed examples.
    """
    if weights is None:
        weights = fit(docs, text_col)
    rest = docs.drop(spans_col)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                                   ("kind", pa.string()), ("base", pa.bool_())]))
        for batch in slices(batches):
            texts = batch.column(batch.schema.get_field_index(text_col))
            spans = [[s._asdict() for s in all_spans(t.as_py() or "", weights)] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(spans, kind)], names=[*batch.schema.names, spans_col])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return rest.mapInArrow(add, f"{columns}, `{spans_col}` {SPANS}")


def redact(docs: DataFrame, text_col: str = "text",
           weights: np.ndarray | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind, as in ``[EMAIL]``; overlapping spans become
    one mark, named by the first. Null texts stay null; ``n_chars``, if there, is counted again.

    Spans are those of ``find``. They are found and replaced in one pass, so that a task needs one
    Python worker: executors keep idle workers, with all they have loaded, for later stages.
    """
    if weights is None:
        weights = fit(docs, text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at = batch.schema.get_field_index(text_col)
            texts = [_marked(t, all_spans(t, weights)) if t else t
                     for t in (x.as_py() for x in batch.column(at))]
            yield batch.set_column(at, batch.schema.names[at], pa.array(texts, pa.string()))

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = docs.mapInArrow(cut, columns)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length(text_col).cast(kind)).select(*docs.columns)
    return out


def _marked(text: str, spans: list[Span]) -> str:
    parts, done = [], 0
    for s in spans:
        if s.start >= done:
            parts += [text[done:s.start], f"[{s.kind.upper()}]"]
        done = max(done, s.end)
    return "".join([*parts, text[done:]]) if parts else text
