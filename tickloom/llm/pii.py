"""Personal data: wide generators propose spans, boosted trees score them, calibrated thresholds choose.

The base finder (email, ip, card, phone by fixed patterns and checks) always keeps its spans. Wider generators propose
obfuscated e-mail addresses, phone numbers in national forms, dotted or grouped numbers that the base rules did not take,
IPv6 addresses, bank account numbers (IBAN), national ids, and secrets beside a telling word. Each candidate gets format and
context features; gradient-boosted trees, fitted in numpy on generated labelled spans (fixed seed), give a margin, a sigmoid
fitted on held-out spans calibrates it, and a threshold per kind, the lowest with the wanted precision on held-out spans,
decides. Held-out spans have other cues and forms than those that the trees are grown on. Overlaps go to the higher score.

Edge cases: a null or empty text has no spans; spans are code points, end exclusive; every text is read whole; rows with
equal or null ids are judged one by one; extra columns pass through in `redact`.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._text import tune

KINDS = ("email", "ip", "card", "phone", "secret", "iban", "id")
FIELDS = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_OBFUSCATED = re.compile(r"[A-Za-z0-9._%+-]{1,64}\s?[\[({<]?\s?\b(?:at|AT)\b\s?[\])}>]?\s?[A-Za-z0-9-]{1,63}(?:\s?[\[({<]?\s?\b(?:dot|DOT)\b\s?[\])}>]?\s?[A-Za-z0-9-]{1,63})+")
_LABEL = re.compile(r"[A-Za-z0-9-]*")
_NATIONAL = re.compile(r"(?<![0-9A-Za-z+.])(?:\([0-9]{2,5}\) ?|[0-9]{2,5}[ .-])[0-9]{2,5}(?:[ .-][0-9]{2,5}){1,4}(?![0-9A-Za-z])")
_SECRET = re.compile(r"\b(?:token|secret|api[_-]?key|apikey|password|passwd|pwd)\b[\"']?\s?[=:]\s?[\"']?([A-Za-z0-9+/_=.-]{8,})", re.IGNORECASE)
_IPV6 = re.compile(r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]*[0-9A-Fa-f])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
_ID = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")
_CUES = {"email": r"mail|contact|write", "ip": r"\bip\b|ipv6|host|server|address", "card": r"card|visa|payment|account", "phone": r"phone|call|tel\b|mobile|fax|reach", "secret": r"token|secret|key|passw|pwd", "iban": r"iban|account|bank|transfer", "id": r"ssn|social|national|taxpayer|\bid\b"}
_CUE = {k: re.compile(v, re.IGNORECASE) for k, v in _CUES.items()}
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    """Whether the Luhn sum of the digits is a multiple of ten."""
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(x), 10)) for x in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> list[Span]:
    """Matches of the address pattern, leftmost first. Each @ is looked at once, so a long run costs no more than its length."""
    found, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        end = 0
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            found.append(("email", start, end))
        floor = max(end, at + 1)
        at = text.find("@", floor)
    return found


def base_spans(text: str) -> list[Span]:
    """The spans that the fixed patterns and checks give, by kind, then start."""
    found = _emails(text) if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            found += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


def _obfuscated(text: str) -> list[Span]:
    """Obfuscated addresses, each to both ends of its run. The pattern looks at 64 characters before its "at", and no run is
    walked twice, so a long one costs no more than its length."""
    found, floor, reach = [], 0, 0
    for m in _OBFUSCATED.finditer(text):
        start = m.start()
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        floor = m.end()
        reach = reach if floor < reach else _LABEL.match(text, floor).end()
        found.append(("email", start, reach))
    return found


def candidates(text: str) -> list[Span]:
    """Overlapping proposals of the wide generators."""
    found: list[Span] = []
    if _DIGIT.search(text):
        found += [("phone", *m.span()) for m in _NATIONAL.finditer(text)]
        found += [("card", *m.span()) for m in _CARD.finditer(text) if 13 <= sum(c.isdigit() for c in m[0]) <= 19]
        if "." in text:
            found += [("ip", *m.span()) for m in _IP.finditer(text)]
        if "-" in text:
            found += [("id", *m.span()) for m in _ID.finditer(text)]
        found += [("iban", *m.span()) for m in _IBAN.finditer(text)]
    if ":" in text:
        found += [("ip", *m.span()) for m in _IPV6.finditer(text)]
    lower = text.lower()
    if "dot" in lower:
        found += _obfuscated(text)
    if "=" in text or ":" in text:
        found += [("secret", *m.span(1)) for m in _SECRET.finditer(text)]
    return found


def mod97(s: str) -> bool:
    """Whether letters and digits, the first four moved to the end, leave 1 when divided by 97 (A is 10)."""
    body = s.replace(" ", "")
    return len(body) > 4 and body.isascii() and body.isalnum() and int("".join(str(int(c, 36)) for c in body[4:] + body[:4])) % 97 == 1


def _ipv6(s: str) -> bool:
    """Eight groups of hexadecimal digits, or fewer with one gap."""
    groups = s.split(":")
    return s.count("::") <= 1 and ":::" not in s and ("::" in s and len(groups) <= 9 or len(groups) == 8 and all(groups)) and all(len(g) <= 4 for g in groups)


def span_features(text: str, span: Span) -> list[float]:
    """Format of the span, and what stands around it."""
    kind, a, b = span
    s, left, right = text[a:b], text[max(0, a - 32) : a], text[b : b + 16]
    digits, alphas = sum(c.isdigit() for c in s), sum(c.isalpha() for c in s)
    numbers = re.findall(r"[0-9]+", s)
    figures = "".join(numbers)
    return [
        float(KINDS.index(kind)), len(s), digits, alphas, len(s) - digits - alphas, len(numbers), max(map(len, numbers), default=0), min(map(len, numbers), default=0),
        float(13 <= len(figures) <= 19 and luhn(figures)), float(all(int(x[:4]) <= 255 for x in numbers)) if numbers else 0.0, len(set(s)) / max(1, len(s)),
        float("(" in s or "[" in s), float("-" in s), float("." in s), float(" " in s), float(any(c.isupper() for c in s)), float(all(c in "0123456789abcdefABCDEF" for c in s)),
        float(bool(_CUE[kind].search(left))), float(left[-1:].isalnum()), float(right[:1].isalnum()), sum(c.isdigit() for c in left), float(left[-2:-1] in ":=" and left[-2:-1] != "" or left[-1:] in ":=" and left[-1:] != ""),
        float(s.lower().count(" at ") + s.lower().count("[at]") + s.lower().count("(at)") > 0), float(any(s.lower().endswith(x) for x in ("com", "org", "net", "edu", "io", "de", "fr", "es"))),
        s.count(":"), float(kind == "iban" and mod97(s)), float(kind == "ip" and ":" in s and _ipv6(s)), float(kind == "id" and numbers[0] not in ("000", "666") and numbers[0] < "900" and "0" * len(numbers[1]) != numbers[1]) if len(numbers) == 3 else 0.0,
    ]


def _generated(rng: np.random.Generator, n: int, half: int = 0) -> tuple[list[list[float]], list[int], list[str]]:
    """Labelled spans: personal data in common forms, and look-alikes such as prices, versions, dates and counters. Each half
    has cues and forms of its own."""

    def of(*forms: str) -> str:
        return str(rng.choice([f for i, f in enumerate(forms) if i % 2 == half]))

    def figures(k: int) -> str:
        return "".join(map(str, rng.integers(0, 10, k)))

    def word() -> str:
        return "".join(rng.choice(list("abcdefghilmnoprstu"), int(rng.integers(2, 9))))

    def card(good: bool) -> str:
        d = figures(15)
        d += next(str(x) for x in range(10) if luhn(d + str(x)) == good)
        return " ".join(d[i : i + 4] for i in range(0, 16, 4)) if rng.random() < 0.5 else d

    def one() -> tuple[str, str, str, str, int]:
        i = int(rng.integers(0, 16))
        sep = str(rng.choice([" ", "-", "."]))
        if i == 0:
            form = of("{} at {} dot {}", "{} at {} dot {}", "{} [at] {} [dot] {}", "{}(at){}(dot){}")
            return "email", of("mail: ", "contact ", "write to ", "email ", "", ""), form.format(word(), word(), rng.choice(["com", "org", "net", "de"])), " .", 1
        if i == 1:
            return "email", word() + " ", f"{word()} at {word()} dot {word()}", " " + word(), 0
        if i == 2:
            return "phone", of("phone ", "call ", "tel: ", "mobile ", "reach me on ", "fax "), (f"({figures(3)}) " if rng.random() < 0.5 else figures(3) + sep) + figures(3) + sep + figures(4), " " + word(), 1
        if i == 3:
            return "phone", word() + of(" ", " on ", " v", " ", " of ", " no "), str(rng.choice([f"{2000 + rng.integers(0, 30)}-{figures(2)}-{figures(2)}", sep.join(figures(int(rng.integers(2, 5))) for _ in range(int(rng.integers(3, 5))))])), " " + word(), 0
        if i == 4:
            return "card", of("card ", "visa ", "pay with ", "payment by ", "", ""), card(True), " ", 1
        if i == 5:
            return "card", of("number ", "id ", "card ", "card ", "part ", "serial "), card(False), " ", 0
        if i == 6:
            return "ip", of("host ", "ip ", "from ", "server ", "", ""), ".".join(str(rng.integers(0, 256)) for _ in range(4)), " ", 1
        if i == 7:
            return "ip", of("version ", "section ", "ip ", "host ", "release ", "chapter "), ".".join(str(x) for x in [*rng.integers(0, 20, 3), rng.integers(256, 9999)]), " ", 0
        if i == 8:
            return "secret", of('token = "', "api_key: ", "secret=", 'password = "', "pwd=", "token: "), "".join(rng.choice(list(str(rng.choice(["0123456789abcdef", "0123456789ABCDEF", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]))), int(rng.integers(16, 65)))), str(rng.choice(['"', " ", ""])), 1
        if i == 10:
            groups = [f"{rng.integers(0, 65536):x}" for _ in range(8)]
            cut = int(rng.integers(2, 6))
            return "ip", of("host ", "ipv6 ", "from ", "address ", "", ""), ":".join(groups) if rng.random() < 0.5 else ":".join(groups[:cut]) + "::" + ":".join(groups[6:]), " ", 1
        if i == 11:  # times, ratios and parts of code
            return "ip", of("at ", "ratio ", "score ", "mix ", "std", "from "), of(f"{rng.integers(0, 24)}:{figures(2)}:{figures(2)}", f"{rng.integers(1, 9)}:{rng.integers(1, 9)}:{rng.integers(1, 99)}", "a::b", "::", ":::", "1:2:3:4"), " " + word(), 0
        if i in (12, 13):
            country, body = of("DE", "FR", "GB", "ES", "NL", "IT"), figures(int(rng.integers(11, 20)))
            check = 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
            if i == 13:
                check = (check + int(rng.integers(1, 90))) % 97 + 2
                check = check if not mod97(f"{country}{check:02d}{body}") else (check - 1) % 97 + 1
            whole = f"{country}{check:02d}{body}"
            return "iban", of("iban ", "account ", "transfer to ", "bank ", "", "") if i == 12 else of("part ", "model ", "iban ", "order ", "serial ", "account "), " ".join(whole[k : k + 4] for k in range(0, len(whole), 4)) if rng.random() < 0.5 else whole, " ", int(i == 12)
        if i == 14:
            return "id", of("ssn ", "social security number ", "ssn: ", "national id ", "taxpayer id ", "ssn is "), f"{rng.integers(1, 899):03d}-{rng.integers(1, 100):02d}-{rng.integers(1, 10000):04d}", " ", 1
        if i == 15:
            return "id", of("part ", "model ", "call ", "order ", "lot ", word() + " "), f"{rng.integers(0, 1000):03d}-{figures(2)}-{figures(4)}", " " + word(), 0
        return "secret", of("token: ", "key = ", "secret: ", "password: ", "token = ", "key: "), word() + word() + word(), " " + word(), 0

    rows, labels, kinds = [], [], []
    for _ in range(n):
        kind, left, body, right, label = one()
        left = f"{word()} {word()} {left}"
        rows.append(span_features(left + body + right, (kind, len(left), len(left) + len(body))))
        labels.append(label)
        kinds.append(kind)
    return rows, labels, kinds


class Trees:
    """Boosted regression trees of depth 3 for log loss, grown on quantile bins."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 0.2, depth: int = 3):
        self.cuts = [np.unique(np.quantile(x[:, f], np.linspace(0.04, 0.96, 24))) for f in range(x.shape[1])]
        self.depth, self.trees = depth, []
        bins = self._bins(x)
        margin = np.zeros(len(x))
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(bins, y - p, p * (1 - p), rate)
            self.trees.append(tree)
            margin += self._leaf(tree, bins)

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(self.cuts)], 1)

    def _grow(self, bins: np.ndarray, grad: np.ndarray, hess: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        nodes = 2**self.depth - 1
        feature, cut, value = np.zeros(nodes, int), np.full(nodes, 99), np.zeros(nodes + 2**self.depth)
        at = np.zeros(len(bins), int)
        for node in range(nodes):
            own = np.flatnonzero(at == node)
            best = 1e-6
            g, h = grad[own].sum(), hess[own].sum()
            for f in range(bins.shape[1]) if len(own) else ():
                width = len(self.cuts[f]) + 1
                gl, hl = np.cumsum(np.bincount(bins[own, f], grad[own], width))[:-1], np.cumsum(np.bincount(bins[own, f], hess[own], width))[:-1]
                gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                if len(gain) and gain.max() > best:
                    best, feature[node], cut[node] = gain.max(), f, int(gain.argmax())
            at[own] = 2 * node + 1 + (bins[own, feature[node]] > cut[node])
        for leaf in range(nodes, len(value)):
            own = at == leaf
            value[leaf] = rate * grad[own].sum() / (hess[own].sum() + 1)
        return feature, cut, value

    def _leaf(self, tree: tuple[np.ndarray, np.ndarray, np.ndarray], bins: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        at = np.zeros(len(bins), int)
        for _ in range(self.depth):
            at = 2 * at + 1 + (bins[np.arange(len(bins)), feature[at]] > cut[at])
        return value[at]

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of the trees' leaves."""
        bins = self._bins(x)
        return sum((self._leaf(t, bins) for t in self.trees), np.zeros(len(x)))


class Chooser:
    """Trees, the sigmoid that calibrates them, and a threshold per kind."""

    def __init__(self, n: int = 4500, seed: int = 11, precision: float = 0.98):
        rng = np.random.default_rng(seed)
        x, y, _ = (np.array(v) for v in _generated(rng, n))
        self.trees = Trees(x, y)
        x, y, kinds = (np.array(v) for v in _generated(rng, n, half=1))
        margin = self.trees.margin(x)
        self.a, self.b = 1.0, 0.0
        for _ in range(200):  # Platt's sigmoid by gradient steps
            p = 1 / (1 + np.exp(-(self.a * margin + self.b)))
            self.a -= 0.05 * float(((p - y) * margin).mean())
            self.b -= 0.5 * float((p - y).mean())
        p = self._calibrated(margin)
        self.least = {}
        for kind in KINDS:
            own = np.flatnonzero(kinds == kind)
            order = own[np.argsort(-p[own])]
            right = np.cumsum(y[order]) / np.arange(1, len(order) + 1)
            good = np.flatnonzero(right >= precision)
            self.least[kind] = max(0.5, float(p[order[good[-1]]])) if len(good) else 1.1

    def _calibrated(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.a * margin + self.b)))

    def choose(self, text: str, fixed: list[Span]) -> list[Span]:
        """The base spans and the accepted candidates that overlap neither these nor a better candidate."""
        taken: list[tuple[int, int]] = []  # disjoint, in order
        for a, b in sorted((a, b) for _, a, b in fixed):
            if taken and a < taken[-1][1]:
                taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
            else:
                taken.append((a, b))
        free = [c for c in dict.fromkeys(candidates(text)) if not _overlaps(taken, c[1], c[2])]
        if not free:
            return fixed
        p = self._calibrated(self.trees.margin(np.array([span_features(text, c) for c in free])))
        added: list[Span] = []
        for i in np.argsort(-p, kind="stable"):
            kind, a, b = free[i]
            if p[i] >= self.least[kind] and not _overlaps(taken, a, b):
                added.append(free[i])
                bisect.insort(taken, (a, b))
        return sorted([*fixed, *added], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _overlaps(taken: list[tuple[int, int]], a: int, b: int) -> bool:
    """Whether [a, b) meets one of some disjoint spans in order."""
    i = bisect.bisect_left(taken, (b, -1))
    return i > 0 and taken[i - 1][1] > a


@lru_cache(maxsize=1)
def chooser() -> Chooser:
    """Fitted once, from a fixed seed; tasks get it from the driver."""
    return Chooser()


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in `keep`, counts and digest of the base spans, and all spans, in one pass without a shuffle."""
    tune(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(chooser())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = shared.value
        for batch in batches:
            rows = []
            for text in batch.column(len(keep)).to_pylist():
                fixed = base_spans(text or "")
                n = [sum(s[0] == k for s in fixed) for k in KINDS[:4]] if fixed else [0, 0, 0, 0]
                rows.append((*n, hashlib.sha256(_joined(fixed).encode()).hexdigest(), _joined(by.choose(text or "", fixed))))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [*[pa.int64()] * 4, pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], [*keep, *(f.split()[0] for f in FIELDS.split(", "))])

    own = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    return docs.select(*keep, "text").mapInArrow(run, f"{own}, {FIELDS}")


def redacted(text: str | None, by: Chooser | None = None) -> str | None:
    """The text with each span replaced by its kind in brackets."""
    if not text:
        return text
    out, at = [], 0
    for kind, a, b in sorted((by or chooser()).choose(text, base_spans(text)), key=lambda s: (s[1], -s[2])):
        if b > at:  # base spans of two kinds may overlap
            out += [text[at:a], f"[{kind.upper()}]"] if a >= at else []
            at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns, with personal data in `text` replaced and `n_chars`, where it exists, counted anew."""
    tune(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(chooser())
    at, n_chars = docs.columns.index("text"), docs.columns.index("n_chars") if dict(docs.dtypes).get("n_chars") in ("int", "bigint") else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = shared.value
        for batch in batches:
            columns, texts = list(batch.columns), [redacted(t, by) for t in batch.column(at).to_pylist()]
            columns[at] = pa.array(texts, columns[at].type)
            if n_chars is not None:
                columns[n_chars] = pa.array([None if t is None else len(t) for t in texts], columns[n_chars].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
