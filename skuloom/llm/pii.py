"""Personal data: overlapping candidate spans, scored by boosted trees.

Base spans follow four fixed patterns with their checks and are always kept. Generators of high recall propose further
spans, which overlap: written-out addresses with each end that a dot gives, phone and card numbers from each group of digits
to each group that the format allows, addresses of eight groups and shortened ones. A number that stands next to another
is thus proposed alone and together with it, and the trees, which learn from parts and joined numbers too, choose. A
candidate has at most five groups of digits, so that the work is linear in the text. Every candidate is described by its format and its context; gradient-boosted trees score it, the score is
calibrated per kind, and a threshold per kind, set on calibration examples for `PRECISION`, selects the redactions.
Selected candidates that touch a base span or a better candidate are dropped.

The trees learn from a bounded, seeded set of `EXAMPLES` rendered examples per template (a parameter): they need no
corpus, so that every run over any corpus applies the same model.

Null text counts as empty and has no spans. Offsets count code points, the end is exclusive. Repeated rows and repeated
or null ids each give a row. Further columns are ignored by `find_spans` and kept by `redact`.
"""

from __future__ import annotations

import functools
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuloom.llm.common import light_batches, map_rows, slices

KINDS = ("email", "ip", "card", "phone")
EXAMPLES = 150
ROUNDS, DEPTH, SHRINK, BINS = 60, 3, 0.2, 24
PRECISION = 0.98

# fixed values of the base rules
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# the first two are searched in parts, in linear time: a local part ends at an @ that none can hold, an ip takes four
# parts of an unbroken row of numbers
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
NOT_DIGIT = re.compile(r"[^0-9]")
DIGIT = re.compile(r"[0-9]")

# generators: anything that could be of the kind; numbers are matched from a group of digits to another
AT = re.compile(r"(?=(\s?(?:\[at\]|\(at\)|\{at\}|\s[Aa][Tt]\s|@)\s?))")
LOCAL_CHARS = 64
PART = re.compile(r"[A-Za-z0-9-]{2,63}")
DOT = re.compile(r"\s?(?:\.|\[dot\]|\(dot\)|\s[Dd][Oo][Tt]\s)\s?")
MORE_PARTS = 4
CARD_GROUPS = re.compile(r"[0-9]{4}(?:[ .-]?[0-9]{2,6}){2,4}")
PHONE_GROUPS = re.compile(
    r"(?:\(0?[0-9]{2,4}\)|00[0-9]{2}|0[0-9]{2,4}|[0-9]{3})[ ./-]?(?:[0-9]{2,4}[ ./-]?){1,3}[0-9]{2,4}"
)
#: Most groups of digits and characters of either.
GROUPS, LONGEST = 5, 32
GROUP = re.compile(r"[0-9]+")
#: What may stand between two groups; a parenthesis closes the first.
GAPS = frozenset((" ", ".", "/", "-", ")", ") ", ").", ")/", ")-"))
ADDRESS = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Za-z]*+(?::[0-9A-Za-z]*+){2,}+")
HEX = re.compile(r"[0-9A-Fa-f]{1,4}")
KEYS = {
    "email": ("mail", "contact", "write", "courriel", "correo", "kontakt"),
    "ip": ("ip", "host", "server", "addr", "login", "ping"),
    "card": ("card", "visa", "carte", "tarjeta", "karte", "credit", "pay"),
    "phone": ("tel", "phone", "call", "fax", "mobil", "cell", "anruf", "whatsapp"),
    "other": ("isbn", "order", "invoice", "id", "ref", "version", "no.", "page", "token", "sku", "date"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of EMAIL."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at)
        start = at
        while domain and start > done and text[start - 1] in LOCAL:
            start -= 1
        if domain and start < at:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of IP with parts up to 255."""
    for row in NUMBERS.finditer(text):
        if "." not in row[0]:
            continue
        parts, start = row[0].split("."), row.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, end
            start = end + 1


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by the fixed rules, by kind and start."""
    found = []
    if "@" in text:
        found += [("email", *span) for span in emails(text)]
    if DIGIT.search(text) is None:
        return found
    found += [("ip", *span) for span in addresses(text)]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def written_addresses(text: str) -> Iterator[tuple[int, int]]:
    """Around every sign: the local part before it and a domain after it, to each of its dots."""
    for m in AT.finditer(text):
        part = PART.match(text, m.end(1))
        if not part or not DOT.match(text, part.end()):
            continue
        start = m.start()
        while start and m.start() - start < LOCAL_CHARS and text[start - 1] in LOCAL:
            start -= 1
        if m.start() - start < 2:
            continue
        for _ in range(MORE_PARTS):
            dot = DOT.match(text, part.end())
            part = dot and PART.match(text, dot.end())
            if not part:
                break
            yield start, part.end()


def shortened(text: str) -> Iterator[tuple[int, int]]:
    """Rows of four to eight hexadecimal groups, and up to seven with one double colon; in longer rows every eight."""
    for row in ADDRESS.finditer(text):
        if row.start() and text[row.start() - 1] == ".":
            continue
        at, places = row.start(), []
        for part in row[0].split(":"):
            places.append((at, at + len(part)))
            at += len(part) + 1
        # stretches of groups and empty places
        fits = [a == b or HEX.fullmatch(text, a, b) is not None for a, b in places]
        i = 0
        while i < len(places):
            if not fits[i]:
                i += 1
                continue
            j = i
            while j < len(places) and fits[j]:
                j += 1
            yield from _of_stretch(places[i:j], i > 0)
            i = j


def _of_stretch(places: list[tuple[int, int]], after: bool) -> Iterator[tuple[int, int]]:
    empty = [k for k, (a, b) in enumerate(places) if a == b]
    # runs of groups without an empty place between
    edges = [-1, *empty, len(places)]
    runs = [(lo + 1, hi) for lo, hi in zip(edges, edges[1:], strict=False)]
    for lo, hi in runs:
        if 4 <= hi - lo <= 8:
            yield places[lo][0], places[hi - 1][1]
        for k in range(lo, hi - 8 if hi - lo > 8 else lo):
            yield places[k][0], places[k + 7][1]
        if hi - lo > 8:
            yield places[hi - 8][0], places[hi - 1][1]
    # the empty place of a double colon has a group, or the end of the row, on either side
    for n, k in enumerate(empty):
        before, behind = runs[n], runs[n + 1]
        left, right = before[1] - before[0], behind[1] - behind[0]
        if not 1 <= left + right <= 7:
            continue
        if k == 0 and after or not left and k != 1 or not right and k != len(places) - 2:
            continue
        yield (places[before[0]][0] if left else places[k][0] - 1), (places[behind[1] - 1][1] if right else places[k][1] + 1)


def numbers(text: str) -> Iterator[tuple[str, int, int]]:
    """Cards and phone numbers from every group of digits to every other that the formats allow."""
    groups = [m.span() for m in GROUP.finditer(text)]
    for i, (start, _) in enumerate(groups):
        near = text[start - 1] if start else ""
        if near.isascii() and near.isalnum():
            continue
        opened = near == "(" and not (start > 1 and text[start - 2].isascii() and (text[start - 2].isalnum() or text[start - 2] == "+"))
        for j in range(i, min(i + GROUPS, len(groups))):
            end = groups[j][1]
            if end - start > LONGEST or (j > i and text[groups[j - 1][1] : groups[j][0]] not in GAPS):
                break
            behind = text[end : end + 1]
            if behind.isascii() and behind.isalnum():
                break
            if CARD_GROUPS.fullmatch(text, start, end):
                yield "card", start, end
            if near != "+" and PHONE_GROUPS.fullmatch(text, start, end):
                yield "phone", start, end
            if opened and PHONE_GROUPS.fullmatch(text, start - 1, end):
                yield "phone", start - 1, end


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Further spans, which overlap."""
    found = [("email", *span) for span in written_addresses(text)]
    if "::" in text or text.count(":") > 2:
        found += [("ip", *span) for span in shortened(text)]
    return found + list(numbers(text))


def stands_apart(text: str, start: int, end: int) -> list[float]:
    """How a number is grouped, and whether its marks go on to a digit before or behind."""
    span = text[start:end]
    sizes = [len(g) for g in GROUP.findall(span)]
    marks = set(re.findall(r"[0-9]([ ./-])(?=[0-9])", span))
    left, right = text[max(0, start - 2) : start], text[end : end + 2]
    goes_left = len(left) == 2 and left[1] in " ./-" and (left[0].isdigit() or left[0] == ")") or left[-1:] == ")"
    goes_right = len(right) == 2 and right[0] in " ./-" and right[1].isdigit()
    dotted = DOT.match(text, end)
    return [
        *(float(sizes[k]) if k < len(sizes) else 0.0 for k in range(3)), float(sizes[-1]) if sizes else 0.0, len(marks),
        float(goes_left), float(goes_left and left[-1] in marks), float(goes_right), float(goes_right and right[0] in marks),
        float(dotted is not None and text[dotted.end() : dotted.end() + 1].islower()), span.count("::"), float(left[-1:] == "("),
    ]


def described(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a span."""
    span = text[start:end]
    digits = NOT_DIGIT.sub("", span)
    before, after = text[max(0, start - 32) : start].lower(), text[end : end + 16].lower()
    groups = re.findall(r"[0-9]+", span)
    names = re.findall(r"[A-Za-z]+", span)
    last = names[-1].lower() if names else ""
    near = text[start - 1 : start] if start else ""
    behind = text[end : end + 1]
    return [
        float(KINDS.index(kind)), len(span), len(digits), len(groups), max(map(len, groups), default=0),
        min(map(len, groups), default=0), float(luhn(digits)) if digits else 0.0, len(set(digits)),
        float(span.startswith("0")), float("(" in span), span.count("-"), span.count("."), span.count(" "), span.count("/"),
        span.count(":"), float("@" in span), float("[" in span or "(at" in span), len(last), len(names),
        float(last in ("com", "org", "net", "edu", "de", "fr", "es", "uk", "io", "info", "eu")),
        float(bool(digits) and digits[:1] in "3456"), float(bool(digits) and digits[:2] in ("34", "37")),
        float(near.isalnum()), float(behind.isalnum()), float(near in ("=", "#", "$", '"', "/", "-", ".")),
        float(bool(re.search("[0-9]", before[-8:]))), float(bool(re.search("[0-9]", after[:8]))),
        *(float(any(k in before for k in keys)) for keys in KEYS.values()), *stands_apart(text, start, end),
    ]


def rendered(seed: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Examples from templates: descriptions and whether the span is personal data.

    Personal data stand alone or next to more numbers; what else the generators propose there are examples against.
    """
    r = random.Random(seed)

    def digits(n: int, first: str = "0123456789") -> str:
        return r.choice(first) + "".join(r.choice("0123456789") for _ in range(n - 1))

    def word(a: int = 3, b: int = 9) -> str:
        return "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(a, b)))

    def checked(n: int, first: str, right: bool) -> str:
        while True:
            d = digits(n, first)
            if luhn(d) == right:
                return d

    def grouped(d: str, sizes: tuple[int, ...], mark: str) -> str:
        parts, at = [], 0
        for s in sizes:
            parts.append(d[at : at + s])
            at += s
        return mark.join(p for p in [*parts, d[at:]] if p)

    def short() -> str:
        return r.choice((str(r.randint(1900, 2100)), digits(r.randint(1, 4)), digits(5)))

    top = ("com", "org", "net", "de", "fr", "es", "io")
    templates = (
        ("email", 1, lambda: f"{word()}{r.choice((' at ', ' [at] ', '[at]', ' (at) ', '(at)'))}{word()}{r.choice((' dot ', ' [dot] ', '[dot]', ' (dot) ', '.'))}{r.choice(top)}"),
        ("email", 0, lambda: f"{word(2, 7)} at {word(2, 5)}.{word(2, 7).title()}"),
        ("email", 0, lambda: f"{word(2, 7)} at {word(2, 5)} dot {word(5, 9)}"),
        ("ip", 1, lambda: ":".join(f"{r.randrange(65536):x}" for _ in range(8))),
        ("ip", 1, lambda: f"{r.choice(('fe80', '2001:db8', 'fd00'))}::{':'.join(f'{r.randrange(1, 65536):x}' for _ in range(r.randint(1, 4)))}"),
        ("ip", 0, lambda: ":".join(f"{r.randrange(60):02d}" for _ in range(4))),
        ("ip", 0, lambda: f"{r.choice(('ab', 'dead', 'add', 'face', 'c', 'de'))}::{r.choice(('add', 'be', 'fed', 'decade'[:4], 'a'))}"),
        ("ip", 0, lambda: f"{r.randrange(60):02d}::{r.randrange(60):02d}"),
        ("card", 1, lambda: checked(15, "3", True)),
        ("card", 1, lambda: grouped(checked(15, "3", True), (4, 6), r.choice(" -"))),
        ("card", 1, lambda: grouped(checked(16, "456", True), (4, 4, 4), ".")),
        ("card", 1, lambda: grouped(checked(16, "456", True), (4, 4, 4), r.choice(" -"))),
        ("card", 0, lambda: checked(r.choice((12, 13, 14, 15, 16, 17, 18)), "0123456789", False)),
        ("card", 0, lambda: digits(r.choice((10, 11, 12, 13, 14)))),
        ("card", 0, lambda: grouped(digits(12), (4, 4), r.choice(" -."))),
        ("card", 0, lambda: f"{r.randint(1900, 2100)}-{r.randint(10, 12)}-{r.randint(10, 28)}"),
        ("phone", 1, lambda: f"({digits(3, '23456789')}) {digits(3, '23456789')}-{digits(4)}"),
        ("phone", 1, lambda: f"00{digits(2, '34')} {digits(3)} {digits(3)} {digits(3)}"),
        ("phone", 1, lambda: f"0{digits(3)} {digits(3)} {digits(4)}"),
        ("phone", 1, lambda: f"{digits(3, '23456789')}-{digits(3, '23456789')}-{digits(4)}"),
        ("phone", 0, lambda: digits(r.choice((7, 8, 9, 10, 11, 12, 13, 14)))),
        ("phone", 0, lambda: f"{digits(3)}.{digits(2)}.{digits(3)}.{digits(2)}"),
        ("phone", 0, lambda: f"{digits(3)} {digits(2)} {digits(2)}"),
        ("phone", 0, lambda: f"{r.randint(100, 999)}/{r.randint(10, 99)}/{r.randint(10, 99)}"),
    )
    fills = ("the of and", "re que les", "und der die", "###", "=", "|", "was on", "los de la")
    x, y = [], []
    for kind, label, make in templates:
        for i in range(count):
            span = make()
            told = i % 3 == 0
            near = r.choice(KEYS[kind] if label else KEYS["other"]) + r.choice((" ", ": ")) if told else ""
            text = f"{word()} {r.choice(fills)} {word()} {near}"
            # a number inside a longer token is not personal data
            stuck = not label and i % 4 == 0
            text += r.choice(("", '"', "#")) + word(1, 3) + r.choice(("-", "_", ".")) if stuck else ""
            own = []
            # beside a number of its like, a short number, or nothing
            for part in (r.choice((None, None, make, short)) if label else None, lambda: span, r.choice((None, None, make, short)) if label else None):
                if part is not None:
                    held = part()
                    own += [] if part is short else [(kind, len(text), len(text) + len(held))]
                    text += held + " "
            text += f"{word()} {word()}"
            base = base_spans(text)
            for k, s, e in own:
                if not any(s < d and c < e for _, c, d in base):
                    x.append(described(text, k, s, e))
                    y.append(label)
            others = [c for c in candidates(text) if label and c not in own and not any(c[1] < d and b < c[2] for _, b, d in base)]
            for c in r.sample(others, min(4, len(others))):
                x.append(described(text, *c))
                y.append(0)
    return np.array(x), np.array(y, float)


Tree = tuple[np.ndarray, np.ndarray, np.ndarray]


def grow(x: np.ndarray, slope: np.ndarray, bend: np.ndarray, cuts: list[np.ndarray]) -> Tree:
    """A complete tree of DEPTH levels for the gradient and second derivative of the loss: features, cuts, leaves."""
    inner = (1 << DEPTH) - 1
    features, values = np.zeros(inner, int), np.full(inner, np.inf)
    node = np.zeros(len(x), int)
    for at in range(inner):
        here = node == at
        g, h = slope[here], bend[here]
        best = 1e-6
        for f, points in enumerate(cuts):
            if not len(points) or not len(g):
                continue
            slot = np.searchsorted(points, x[here, f], side="left")
            left_g = np.cumsum(np.bincount(slot, g, len(points) + 1))[:-1]
            left_h = np.cumsum(np.bincount(slot, h, len(points) + 1))[:-1]
            gain = left_g**2 / (left_h + 1) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + 1) - g.sum() ** 2 / (h.sum() + 1)
            k = int(gain.argmax())
            if gain[k] > best:
                best, features[at], values[at] = gain[k], f, points[k]
        node[here] = 2 * at + 1 + (x[here, features[at]] > values[at])
    leaves = np.array([-slope[node == inner + i].sum() / (bend[node == inner + i].sum() + 1) for i in range(1 << DEPTH)])
    return features, values, leaves


def reached(tree: Tree, x: np.ndarray) -> np.ndarray:
    features, values, leaves = tree
    node = np.zeros(len(x), int)
    for _ in range(DEPTH):
        node = 2 * node + 1 + (x[np.arange(len(x)), features[node]] > values[node])
    return leaves[node - len(features)]


@dataclass(frozen=True)
class Boosted:
    trees: tuple[Tree, ...]
    #: Per kind: slope and offset of the calibration, threshold of the probability.
    calibration: dict[str, tuple[float, float, float]]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return SHRINK * sum((reached(t, x) for t in self.trees), np.zeros(len(x)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Calibrated by the kind in the first column."""
        raw = self.raw(x)
        a, b, _ = np.array([self.calibration[KINDS[int(k)]] for k in x[:, 0]]).T
        return 1 / (1 + np.exp(-np.clip(a * raw + b, -40, 40)))


@functools.lru_cache(maxsize=1)
def model(examples: int = EXAMPLES) -> Boosted:
    """Trees from one set of examples, calibration and thresholds from another."""
    x, y = rendered(11, examples)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[:-1])) for f in range(x.shape[1])]
    raw, trees = np.zeros(len(x)), []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-raw))
        trees.append(grow(x, p - y, p * (1 - p), cuts))
        raw += SHRINK * reached(trees[-1], x)
    held_x, held_y = rendered(13, examples)
    fitted = Boosted(tuple(trees), dict.fromkeys(KINDS, (1.0, 0.0, 1.0)))
    raw = fitted.raw(held_x)
    calibration = {}
    for i, kind in enumerate(KINDS):
        own = held_x[:, 0] == i
        a, b = logistic(raw[own], held_y[own])
        p = 1 / (1 + np.exp(-(a * raw[own] + b)))
        calibration[kind] = (a, b, threshold(p, held_y[own]))
    return Boosted(fitted.trees, calibration)


def logistic(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit with a slight pull to (1, 0), by Newton's steps."""
    w = np.array([1.0, 0.0])
    x = np.stack([raw, np.ones(len(raw))], 1)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + (w - [1.0, 0.0])
        h = (x * (p * (1 - p))[:, None]).T @ x + np.eye(2)
        w = w - np.linalg.solve(h, g)
    return float(w[0]), float(w[1])


def threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Where to cut so that the examples above are right as often as PRECISION asks: half way to the next one, at 0.5 least."""
    p, y = p[order := np.argsort(-p, kind="stable")], y[order]
    good = np.flatnonzero((np.cumsum(y) / np.arange(1, len(y) + 1) >= PRECISION) & (p >= 0.5))
    return float(max(0.5, (p[good[-1]] + (p[good[-1] + 1] if good[-1] + 1 < len(p) else 0)) / 2)) if len(good) else 1.0


def selected(text: str, base: list[tuple[str, int, int]], boosted: Boosted) -> list[tuple[str, int, int]]:
    """Candidates over the threshold of their kind, best first, that touch no span kept before."""
    found = [c for c in candidates(text) if not any(c[1] < e and s < c[2] for _, s, e in base)]
    if not found:
        return []
    p = boosted.probability(np.array([described(text, *c) for c in found]))
    taken: list[tuple[str, int, int]] = []
    for i in sorted(range(len(found)), key=lambda i: (-p[i], found[i][1] - found[i][2], found[i])):
        kind, start, end = found[i]
        if p[i] >= boosted.calibration[kind][2] and not any(start < e and s < end for _, s, e in taken):
            taken.append(found[i])
    return taken


def by_kind(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id, base spans and all spans (arrays of kind, start, end, by kind and start) of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in slices(batches):
            base, spans = [], []
            for text in batch.column(1).to_pylist():
                own = base_spans(text or "")
                more = selected(text or "", own, held.value)
                base.append(own)
                spans.append(by_kind(own + more))
            columns = [pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in x] for x in xs], kind) for xs in (base, spans)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "base", "spans"])

    rows = light_batches(docs).select("doc_id", F.col("text").cast("string").alias("text"))
    span = T.ArrayType(T.StructType().add("kind", "string").add("start", "long").add("end", "long"))
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"]]).add("base", span).add("spans", span))


def written(spans: str):
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, and the spans as text."""
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, F.lit(k).__eq__)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(written("base"), 256).alias("base_sha256"), written("spans").alias("spans"))


def masked(text: str, boosted: Boosted) -> str:
    """The text with a mark in place of each span; spans that overlap get one mark, of the first."""
    base = base_spans(text)
    parts, at = [], 0
    for kind, start, end in sorted(base + selected(text, base, boosted), key=lambda s: (s[1], -s[2])):
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, column: str = "text") -> DataFrame:
    """The same rows and columns with the spans of `column` masked; null stays null."""
    held = docs.sparkSession.sparkContext.broadcast(model())
    place = docs.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [None if t is None else masked(t, held.value) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return map_rows(docs, run)
