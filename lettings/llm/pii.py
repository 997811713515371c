"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans.

Base spans follow the patterns of ``base_spans`` and always stay. The field looks at windows around
digits and at-signs, cuts them into units (letters, digits, single marks, blanks) and scores whole
candidate segments of at most ``LONGEST`` units by features of the segment and its neighbours: how
many digits, how grouped, which marks, whether a check digit holds, what stands before and after.
Dynamic programming over the segments of a text finds the best choice of boundaries and types at once.
Its spans count where no base span overlaps them. Features of a segment follow from sums over its
units, so the segments of many windows are scored together in arrays; ``features`` says the same for
one segment, in training.

The field is trained here, by gradient ascent on the likelihood of whole segmentations, from a
bounded sample: windows of some ``SAMPLE_ROWS`` documents chosen by hash, at most ``SAMPLE_WINDOWS``
of them. Base spans are their labels; telephone numbers also come without plus sign and country, so
that such numbers are found as well. Without a labelled window nothing is added.

Null and empty texts have no spans. Rows without an id and repeated rows are rows like any other; an
empty table gives an empty result. Equal scores are settled for the segments that end first. Work per
text is linear in its length, and memory beyond the text in ``UNITS`` and the segments that score above
zero.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettings.llm import common

KINDS = ("email", "ip", "card", "phone")
SAMPLE_ROWS = 3000
SAMPLE_WINDOWS = 500
LONGEST = 24
#: Characters of the longest segment, and units that are scored at once.
WIDEST = 96
UNITS = 4096
EPOCHS = 12

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: The patterns of base spans (that of e-mail from its at-sign on).
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: Numbers that are nobody's data; the field learns them besides what the sample has.
_PLAIN = (
    "on 2024-01-02 at", "from 1990-2010 to", "at 12:30:05 or", "paid 1,250.00 of", "version 1.12.3 and", "is 3.14159 or",
    "order 20240102-17 of", "page 12 (3-4) of", "size 10 x 20 x 30", "code 9f8e7d6c5b4a", "ISBN 978-3-16-148410-0 by",
    "on 01.02.2024 at", "in (2019) 12-18 of", "id 550e8400-e29b-41d4", "room 555-1234a or", "sum 100 200 300 400 5",
)

_HINT = re.compile(r"[0-9@]")
_TOKEN_END = re.compile(r"\s|\Z")
_UNIT = re.compile(r"[^\W\d_]+|[0-9]+|\s+|[\W\d_]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_DIGITS = re.compile(r"[0-9]+")

Span = tuple[int, int, int]  # start, number of the kind, end


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _octets(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(
        part.isdecimal() and len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in parts
    )


def _emails(text: str) -> Iterator[Span]:
    """Every at-sign with the longest name before it that the last match leaves free."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, 0, free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """Spans by pattern: leftmost, not overlapping within a kind; failing matches are dropped."""
    found = list(_emails(text))
    if _DIGITS.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _octets(m.group())]
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m.group()) if m.end() - m.start() <= 40 else ""
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    found.sort()
    return found


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches around words with a digit or an at-sign: these words, close ones together."""
    found: list[list[int]] = []
    hint = _HINT.search(text)
    while hint:
        start = hint.start()
        floor = found[-1][1] if found else 0
        while start > floor and not text[start - 1].isspace():
            start -= 1
        end = _TOKEN_END.search(text, hint.end()).start()
        if found and start - found[-1][1] <= 2:
            found[-1][1] = end
        else:
            found.append([start, end])
        hint = _HINT.search(text, end)
    # A plus or a bracket before a number may stand as a word of its own.
    return [(max(0, a - 2), min(len(text), b + 1)) for a, b in found]


def units(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _UNIT.finditer(text)]


_COUNTS = (0, 1, 4, 7, 10, 11, 12, 14, 16, 17, 20)
_SIDES = ("edge", "blank", "letter", "digit", "plus", "at", "joint", "mark")
_NAMES = [
    "always", "at", "ats", "dot_after_at", "letters", "plus", "brackets", "open_bracket", "blanks", "dashes",
    "octets", "check_digit", "grouped", "one_group", "even_groups", "slash", "other_mark",
    *(f"digits_{n}" for n in _COUNTS), *(f"dots_{n}" for n in range(5)), *(f"groups_{n}" for n in range(6)),
    *(f"before_{s}" for s in _SIDES), *(f"after_{s}" for s in _SIDES),
    "last_group_4", "first_group_3", "starts_with_letter", "ends_with_letter",
]
_NUMBER = {name: at for at, name in enumerate(_NAMES)}


def _side(character: str) -> str:
    if not character:
        return "edge"
    if character.isspace():
        return "blank"
    if character.isalpha():
        return "letter"
    if character.isdigit():
        return "digit"
    return {"+": "plus", "@": "at", ".": "joint", "-": "joint", "_": "joint"}.get(character, "mark")


def features(text: str, start: int, end: int) -> list[int]:
    """Numbers of the features that hold for a whole segment of a text."""
    own = text[start:end]
    groups = _DIGITS.findall(own)
    digits = "".join(groups)
    sizes = [len(g) for g in groups]
    ats = own.count("@")
    names = [
        "always",
        f"digits_{max(n for n in _COUNTS if n <= len(digits))}",
        f"dots_{min(own.count('.'), 4)}",
        f"groups_{min(len(groups), 5)}",
        f"before_{_side(text[start - 1 : start])}",
        f"after_{_side(text[end : end + 1])}",
    ]
    names += ["at"] * (ats == 1) + ["ats"] * (ats > 1)
    names += ["dot_after_at"] * (ats == 1 and "." in own.partition("@")[2])
    names += ["letters"] * any(map(str.isalpha, own))
    names += ["starts_with_letter"] * own[0].isalpha() + ["ends_with_letter"] * own[-1].isalpha()
    names += ["plus"] * own.startswith("+")
    names += ["brackets"] * ("(" in own and ")" in own) + ["open_bracket"] * (("(" in own) != (")" in own))
    names += ["blanks"] * (" " in own) + ["dashes"] * ("-" in own) + ["slash"] * ("/" in own)
    names += ["other_mark"] * any(c not in "+.()- @_%/" and not c.isalnum() for c in own)
    names += ["octets"] * _octets(own)
    if digits:
        names += ["check_digit"] * (12 <= len(digits) <= 19 and luhn(digits))
        names += ["one_group"] * (len(groups) == 1) + ["grouped"] * (len(groups) > 2)
        names += ["even_groups"] * (len(groups) > 1 and len(set(sizes)) == 1)
        names += ["last_group_4"] * (sizes[-1] == 4) + ["first_group_3"] * (3 in sizes[:2])
    return [_NUMBER[name] for name in names]


def segments_from(text: str, cut: list[tuple[int, int]], first: int) -> Iterator[int]:
    """Ends (as numbers of units) of the candidate segments that begin with a unit."""
    start = cut[first][0]
    if not (text[start].isalnum() or text[start] in "+("):
        return
    for last in range(first, min(first + LONGEST, len(cut))):
        end = cut[last][1]
        if text[end - 1] == "\n" or end - start > WIDEST:
            return
        if text[end - 1].isalnum() and _HINT.search(text, start, end):
            yield last + 1


_SUMS = (
    "starts", "ends", "stop", "hint", "digits", "dots", "ats", "letters", "starts_with_letter", "ends_with_letter",
    "plus", "opening", "closing", "blanks", "dashes", "slash", "other_mark", "not_decimal", "groups",
)
_FLAGS = (
    "at", "ats", "dot_after_at", "letters", "starts_with_letter", "ends_with_letter", "plus", "brackets", "open_bracket",
    "blanks", "dashes", "slash", "other_mark", "octets", "check_digit", "one_group", "grouped", "even_groups",
    "last_group_4", "first_group_3",
)


def _unit_values(own: str) -> tuple[int, ...]:
    """What a unit adds to the sums of ``_SUMS``."""
    group = "0" <= own[0] <= "9"
    return (
        own[0].isalnum() or own[0] in "+(",
        own[-1].isalnum(),
        own[-1] == "\n",
        group or own == "@",
        len(own) if group else 0,
        own == ".",
        own == "@",
        any(map(str.isalpha, own)),
        own[0].isalpha(),
        own[-1].isalpha(),
        own == "+",
        own == "(",
        own == ")",
        " " in own,
        own == "-",
        own == "/",
        any(c not in "+.()- @_%/" and not c.isalnum() for c in own),
        own != "." and not own.isdecimal(),
        group,
    )


@lru_cache(4096)
def _side_number(character: str) -> int:
    return _SIDES.index(_side(character))


def _before(values: np.ndarray) -> np.ndarray:
    """Sums of what stands before each place."""
    return np.concatenate([np.zeros((1, *values.shape[1:]), np.int64), np.cumsum(values, 0, np.int64)])


class Segments:
    """Candidate segments that begin with the first ``count`` of some units, and their features.

    ``first`` and ``last`` are their units (``last`` exclusive); ``features`` are numbers of features of
    which each segment has one a column, ``flags`` those of ``_FLAGS`` that hold.
    """

    def __init__(self, text: str, bounds: list[tuple[int, int, int]], count: int):
        own = [text[a : min(b, a + WIDEST + 1)] for a, b, _ in bounds]
        kinds = {unit: number for number, unit in enumerate(dict.fromkeys(own))}
        table = np.array([_unit_values(unit) for unit in kinds], np.int64)
        values = table[[kinds[unit] for unit in own]]
        sums = _before(values)
        starts, ends, window = (np.array(x) for x in zip(*bounds, strict=True))
        self.first, self.last = self._bounds(values, sums, starts, ends, window, count)
        first, last = self.first, self.last
        n = dict(zip(_SUMS, (sums[last] - sums[first]).T, strict=True))
        before = np.array([_side_number(text[a - 1 : a] if a else "") for a in starts.tolist()])
        after = np.array([_side_number(text[b : b + 1]) for b in ends.tolist()])
        groups = sums[:, _SUMS.index("groups")]
        digits = sums[:, _SUMS.index("digits")]
        places = np.searchsorted(_COUNTS, n["digits"], "right") - 1
        self.features = np.stack(
            [
                np.full(len(first), _NUMBER["always"]),
                _NUMBER[f"digits_{_COUNTS[0]}"] + places,
                _NUMBER["dots_0"] + np.minimum(n["dots"], 4),
                _NUMBER["groups_0"] + np.minimum(n["groups"], 5),
                _NUMBER[f"before_{_SIDES[0]}"] + before[first],
                _NUMBER[f"after_{_SIDES[0]}"] + after[last - 1],
            ],
            1,
        )
        at_place = np.maximum.accumulate(np.where(values[:, _SUMS.index("ats")] > 0, np.arange(len(own)), 0))
        dots = sums[:, _SUMS.index("dots")]
        octets = (n["dots"] == 3) & (n["not_decimal"] == 0)
        for at in np.flatnonzero(octets).tolist():
            octets[at] = _octets(text[starts[first[at]] : ends[last[at] - 1]])
        sizes = values[values[:, _SUMS.index("groups")] > 0, _SUMS.index("digits")]
        sizes = np.append(sizes, [0, 0])
        changes = _before(np.diff(sizes) != 0)
        one, other = groups[first], groups[last] - 1
        several, any_group = n["groups"] > 1, n["groups"] > 0
        named = {
            "at": n["ats"] == 1,
            "ats": n["ats"] > 1,
            "dot_after_at": (n["ats"] == 1) & (dots[last] > dots[at_place[last - 1]]),
            "starts_with_letter": values[first, _SUMS.index("starts_with_letter")] > 0,
            "ends_with_letter": values[last - 1, _SUMS.index("ends_with_letter")] > 0,
            "plus": values[first, _SUMS.index("plus")] > 0,
            "brackets": (n["opening"] > 0) & (n["closing"] > 0),
            "open_bracket": (n["opening"] > 0) != (n["closing"] > 0),
            "octets": octets,
            "check_digit": self._check_digit("".join(x for x in own if "0" <= x[0] <= "9"), digits[first], digits[last]),
            "one_group": n["groups"] == 1,
            "grouped": n["groups"] > 2,
            "even_groups": several & (changes[np.maximum(other, 0)] == changes[one]),
            "last_group_4": any_group & (sizes[other] == 4),
            "first_group_3": (any_group & (sizes[one] == 3)) | (several & (sizes[one + 1] == 3)),
        }
        self.flags = np.stack([named[x] if x in named else n[x] > 0 for x in _FLAGS], 1)

    @staticmethod
    def _bounds(values, sums, starts, ends, window, count) -> tuple[np.ndarray, np.ndarray]:
        """Segments inside one window, not too wide, that begin and end well and hold a hint."""
        size = len(values)
        first = np.flatnonzero(values[:count, _SUMS.index("starts")])
        limit = np.searchsorted(window, window[first], "right")
        stops = np.append(np.flatnonzero(values[:, _SUMS.index("stop")]), size)
        limit = np.minimum(limit, stops[np.searchsorted(stops, first)])
        first, limit = np.repeat(first, LONGEST), np.repeat(limit, LONGEST)
        last = first + np.tile(np.arange(1, LONGEST + 1), len(first) // LONGEST)
        kept = last <= limit
        first, last = first[kept], last[kept]
        hints = sums[:, _SUMS.index("hint")]
        kept = (ends[last - 1] - starts[first] <= WIDEST) & (hints[last] > hints[first])
        kept &= values[last - 1, _SUMS.index("ends")] > 0
        return first[kept], last[kept]

    @staticmethod
    def _check_digit(digits: str, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Luhn sums as differences: digits at even or at odd places are the plain ones."""
        plain = np.frombuffer(digits.encode(), np.uint8).astype(np.int64) - 48
        double = 2 * plain - 9 * (plain > 4)
        odd = np.arange(len(plain)) % 2 == 1
        even_plain, odd_plain = _before(np.where(odd, double, plain)), _before(np.where(odd, plain, double))
        total = np.where(last % 2 == 1, even_plain[last] - even_plain[first], odd_plain[last] - odd_plain[first])
        return (last - first >= 12) & (last - first <= 19) & (total % 10 == 0)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Segments by kinds."""
        found = self.flags @ weights[[_NUMBER[x] for x in _FLAGS]]
        for column in self.features.T:
            found += weights[column]
        return found


def _unit_blocks(text: str, places: list[tuple[int, int]]) -> Iterator[tuple[list[tuple[int, int, int]], int]]:
    """Units of windows (start, end, number of the window), and how many of them begin segments here."""
    held: list[tuple[int, int, int]] = []
    for number, (a, b) in enumerate(places):
        for m in _UNIT.finditer(text, a, b):
            held.append((*m.span(), number))
            if len(held) == UNITS + LONGEST:
                yield held, UNITS
                held = held[UNITS:]
    if held:
        yield held, len(held)


def decoded(text: str, places: list[tuple[int, int]], weights: np.ndarray) -> list[Span]:
    """The choice of segments and kinds of the highest score in some windows.

    A unit outside scores nothing, so only segments that score above zero can be chosen.
    """
    found: list[tuple[int, int, int, float]] = []
    for bounds, count in _unit_blocks(text, places):
        segments = Segments(text, bounds, count)
        scores = segments.scores(weights)
        kinds = scores.argmax(1)
        best = scores[np.arange(len(kinds)), kinds]
        for at in np.flatnonzero(best > 0).tolist():
            start, end = bounds[segments.first[at]][0], bounds[segments.last[at] - 1][1]
            found.append((end, start, int(kinds[at]), float(best[at])))
    found.sort()
    ends = [x[0] for x in found]
    total, chosen = [0.0], []
    for number, (_, start, _, score) in enumerate(found):
        # Segments that end before this one starts; none of a later number does.
        before = bisect_right(ends, start, 0, number)
        taken = total[before] + score > total[-1]
        chosen.append(before if taken else -1)
        total.append(total[before] + score if taken else total[-1])
    spans, number = [], len(found)
    while number > 0:
        before = chosen[number - 1]
        if before >= 0:
            end, start, kind, _ = found[number - 1]
            spans.append((start, kind, end))
        number = before if before >= 0 else number - 1
    return spans[::-1]


class Window:
    """A stretch of text with its units and candidate segments, for training."""

    def __init__(self, text: str):
        self.bounds = units(text)
        self.segments: list[tuple[int, int]] = []
        self.features: list[list[int]] = []
        for i in range(len(self.bounds)):
            for j in segments_from(text, self.bounds, i):
                self.segments.append((i, j))
                self.features.append(features(text, self.bounds[i][0], self.bounds[j - 1][1]))

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Segments by kinds."""
        found = np.zeros((len(self.segments), len(KINDS)))
        for at, own in enumerate(self.features):
            found[at] = weights[own].sum(0)
        return found

    def gradient(self, weights: np.ndarray, gold: dict[tuple[int, int], int]) -> dict[int, np.ndarray]:
        """Of the log-likelihood of the gold segmentation, as a change per segment and kind."""
        scores = self.scores(weights)
        size = len(self.bounds)
        by_end: list[list[int]] = [[] for _ in range(size + 1)]
        by_start: list[list[int]] = [[] for _ in range(size + 1)]
        for at, (i, j) in enumerate(self.segments):
            by_end[j].append(at)
            by_start[i].append(at)
        mass = np.logaddexp.reduce(scores, axis=1) if len(scores) else np.zeros(0)
        forward, backward = np.zeros(size + 1), np.zeros(size + 1)
        for j in range(1, size + 1):
            parts = [forward[j - 1], *(forward[self.segments[at][0]] + mass[at] for at in by_end[j])]
            forward[j] = np.logaddexp.reduce(parts)
        for i in range(size - 1, -1, -1):
            parts = [backward[i + 1], *(backward[self.segments[at][1]] + mass[at] for at in by_start[i])]
            backward[i] = np.logaddexp.reduce(parts)
        changes = {}
        for at, (i, j) in enumerate(self.segments):
            change = -np.exp(forward[i] + scores[at] + backward[j] - forward[size])
            kind = gold.get((i, j))
            if kind is not None:
                change[kind] += 1
            if np.abs(change).max() > 1e-4:
                changes[at] = change
        return changes

    def gold(self, spans: list[Span]) -> dict[tuple[int, int], int] | None:
        """Labels on units; none if a span is no candidate segment."""
        starts = {a: i for i, (a, _) in enumerate(self.bounds)}
        ends = {b: i + 1 for i, (_, b) in enumerate(self.bounds)}
        known = set(self.segments)
        found, free = {}, 0
        for a, kind, b in sorted(spans, key=lambda x: (x[0], -x[2])):
            if a < free:
                continue
            place = (starts.get(a, -1), ends.get(b, -1))
            if place not in known:
                return None
            found[place] = kind
            free = b
        return found


def train(examples: list[tuple[str, list[Span]]], epochs: int = EPOCHS) -> np.ndarray | None:
    """Weights of features by kinds, from texts of windows with their spans."""
    prepared = []
    for text, spans in [*examples, *((text, []) for text in _PLAIN)]:
        window = Window(text)
        gold = window.gold(spans)
        if gold is not None and window.segments:
            prepared.append((window, gold))
    if not any(gold for _, gold in prepared):
        return None
    weights = np.zeros((len(_NAMES), len(KINDS)))
    weights[_NUMBER["always"]] = -2
    history = np.full_like(weights, 1e-3)
    random = np.random.default_rng(5)
    for _ in range(epochs):
        for at in random.permutation(len(prepared)).tolist():
            window, gold = prepared[at]
            slope = -1e-4 * weights
            for segment, change in window.gradient(weights, gold).items():
                slope[window.features[segment]] += change
            history += slope**2
            weights += 0.5 * slope / np.sqrt(history)
    return weights


def _examples(text: str) -> list[tuple[str, list[Span]]]:
    """Windows of a text with their base spans, and telephone numbers without the plus as well."""
    spans = base_spans(text)
    found = []
    for a, b in windows(text):
        if b - a > 200:
            continue
        own = [(s - a, k, e - a) for s, k, e in spans if a <= s and e <= b]
        if any(s < b and a < e and not (a <= s and e <= b) for s, _, e in spans):
            continue
        part = text[a:b]
        found.append((part, own))
        if len(own) == 1 and own[0][1] == 3 and "(" in part[own[0][0] : own[0][2]]:
            s, _, e = own[0]
            bracket = part.index("(", s)
            found.append((part[:s] + part[s + 1 :], [(s, 3, e - 1)]))
            found.append((part[:s] + part[bracket:], [(s, 3, e - bracket + s)]))
    return found


def fit(documents: DataFrame, text: str = "text", key: str = "doc_id") -> np.ndarray | None:
    """Train on a bounded sample of the documents' windows."""
    share = common.share_of(documents.count(), SAMPLE_ROWS)
    rows = documents.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.filter(common.in_sample(F.coalesce("key", F.lit("")), share, "windows"))

    def take(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [x for whole in common.texts(part) for x in _examples(whole)]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x[0] for x in found], pa.string()),
                        pa.array([[n for s in x[1] for n in s] for x in found], pa.list_(pa.int32())),
                    ],
                    ["window", "spans"],
                )

    found = rows.select("text").mapInArrow(take, "window string, spans array<int>").distinct()
    # Windows with spans first, then by hash.
    order = [F.size("spans") == 0, F.xxhash64("window"), "window"]
    chosen = found.orderBy(*order).limit(SAMPLE_WINDOWS // 2).unionByName(
        found.filter(F.size("spans") == 0).orderBy(*order).limit(SAMPLE_WINDOWS // 2)
    )
    examples = []
    for row in chosen.distinct().collect():
        numbers = list(row["spans"])
        spans = list(zip(numbers[::3], numbers[1::3], numbers[2::3], strict=True))
        examples.append((row["window"], spans))
    return train(sorted(examples))


def all_spans(text: str, weights: np.ndarray | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and those that the field adds."""
    base = base_spans(text)
    if weights is None:
        return base, []
    taken: list[list[int]] = []
    for start, _, end in base:
        if taken and start < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    ends = [end for _, end in taken]
    added = []
    for span in decoded(text, windows(text), weights):
        at = bisect_right(ends, span[0])
        if at == len(taken) or taken[at][0] >= span[2]:
            added.append(span)
    return base, added


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def found(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The query's columns for every row."""
    common.prepare(documents.sparkSession)
    weights = fit(documents, text, key)
    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    names = ["key", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans", "n_added"]

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            held = []
            for whole in common.texts(part):
                base, added = all_spans(whole, weights)
                counts = [sum(x[1] == kind for x in base) for kind in range(len(KINDS))]
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                held.append((*counts, digest, listed(sorted(base + added)), len(added)))
            if held:
                kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.int64()]
                columns = [pa.array(x, k) for x, k in zip(zip(*held, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("key"), *columns], names)

    kind = rows.schema["key"].dataType.simpleString()
    counts = ", ".join(f"n_{x} long" for x in KINDS)
    result = rows.mapInArrow(
        scan, f"key {kind}, {counts}, base_sha256 string, spans string, n_added long"
    )
    return result.select(F.col("key").alias(key), *names[1:])


def redact(text: str, weights: np.ndarray | None) -> str:
    """Spans replaced by their kind; overlapping ones by that of the first.

    What is left is searched again, since a number may only stand out once its neighbour is gone.
    """
    while True:
        spans = sum(all_spans(text, weights), [])
        if not spans:
            return text
        parts, before = [], 0
        for start, kind, end in sorted(spans, key=lambda x: (x[0], -x[2])):
            if start >= before:
                parts += [text[before:start], f"[{KINDS[kind].upper()}]"]
            before = max(before, end)
        text = "".join([*parts, text[before:]])


def redacted(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns, with spans replaced by their kind in the text; null stays null."""
    common.prepare(documents.sparkSession)
    weights = fit(documents, text, key)
    place = documents.columns.index(text)

    def replace(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            new = [
                None if whole is None else redact(whole, weights)
                for whole in part.column(place).to_pylist()
            ]
            columns = list(part.columns)
            columns[place] = pa.array(new, part.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return documents.mapInArrow(replace, documents.schema)
