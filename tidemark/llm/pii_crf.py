"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds what they miss.

The patterns give the base spans. The field cuts the text around triggers into tokens and scores whole candidate
segments of up to ``LONGEST`` tokens by their features; a dynamic programme over segment ends chooses boundaries and
types together. Triggers are digits, ``@``, bracketed ``at``, and ``at`` between spaces after a local part and before a
name with a spelt ``dot``, in either case of letters; prose has names after ``at`` too (``look at www.example.com``), but
none with a spelt dot. A candidate holds a whole trigger, and a stretch reaches
``LONGEST`` whole tokens to either side of one, so leaving out the rest is exact.
A span of the field is added where it touches no base span.

The weights are fitted to the base spans of a bounded sample of the table's own documents, to every stretch of it: of
each document with a trigger a passage of at most ``PASSAGE`` characters, which starts at most a quarter of that before
its first base span (of half a passage at most; else its first trigger) and cuts no base span; ``SAMPLE`` - ``OTHERS``
passages with base spans and ``OTHERS`` without, the first by a hash of the passage, equal ones once. Stretches of over
``PIECE`` tokens are cut between base spans. Each base phone and mail address is used also in spellings that the
patterns don't know. All other work covers whole texts of all documents.

Defined cases: a null or empty text has no spans; equal rows are treated alike; where no document has a base span, the
weights are zero and nothing is added; other columns are kept by ``redacted`` and ignored by ``spans``.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, written

KINDS = ("email", "ip", "card", "phone")
SAMPLE, OTHERS, PASSAGE, PIECE, EPOCHS, LONGEST = 400, 100, 2000, 256, 12, 32
#: Segments that are scored together.
BLOCK = 512

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT, _SPELT = r"[\[(][Aa][Tt][\])]", r"(?:\s?[\[(][Dd][Oo][Tt][\])]\s?|\s[Dd][Oo][Tt]\s)"
_DOT = rf"(?:\.|{_SPELT})"
_NAME = "[A-Za-z0-9-]+"
#: A domain with a spelt dot at least.
_SPELT_DOMAIN = rf"{_NAME}(?:\.{_NAME})*{_SPELT}{_NAME}"
_TRIGGER = re.compile(rf"[0-9]+|@|{_AT}|(?<=[A-Za-z0-9._%+-])\s[Aa][Tt]\s(?={_SPELT_DOMAIN})")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\W\d_]+|\s+|.", re.S)


def luhn(digits: str) -> bool:
    total = sum(int(c) for c in digits[-1::-2]) + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each ``@`` in turn: the run of local characters before it, not before the last match's end."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def _ip_ok(found: str) -> bool:
    return all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in found.split(".")))


def _card_ok(found: str) -> bool:
    digits = found.replace(" ", "").replace("-", "")
    return 16 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed patterns' spans as (kind, start, end), by kind, then start; leftmost, without overlap in a kind."""
    out = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _ip_ok(m.group())]
        out += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if m.end() - m.start() >= 16 and _card_ok(m.group())]
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() and c.isascii() for c in m.group()) <= 15]
    return out


# --- the field -------------------------------------------------------------------------------------------------

#: Features of a whole segment; each is 0 or 1.
FEATURES = (
    "bias", "plus", "at", "at_word", "dot_word", "digits_3_7", "digits_8_15", "digits_16_19", "digits_more", "no_digit",
    "luhn", "ip_shape", "brackets", "dashes", "spaces", "letters", "dot_end", "two_parts", "word_left", "digit_edge", "glued", "one_token", "odd_sign", "goes_on",
)
_SIGNS = frozenset("+-.()@_%")
_GOES_ON, _COMES_ON = re.compile(rf"{_DOT}[A-Za-z0-9-]"), re.compile(rf"[A-Za-z0-9._%+-]{_SPELT}\Z")
_IP_SHAPE = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
_PARTS = re.compile(rf"[A-Za-z0-9._%+-]+(?:{_SPELT}[A-Za-z0-9._%+-]+)*(?:(?:@|\s?{_AT}\s?){_NAME}(?:{_DOT}{_NAME})+|\s[Aa][Tt]\s{_SPELT_DOMAIN}(?:{_DOT}{_NAME})*)")
_DOT_WORD = re.compile(_SPELT)


def features(text: str, start: int, end: int, tokens: int) -> np.ndarray:
    """One segment's features, as they are defined; ``Shape`` has those of many at once."""
    s = text[start:end]
    digits = "".join(c for c in s if c in "0123456789")
    n = len(digits)
    left, right = text[start - 1 : start], text[end : end + 1]
    low = s.lower()
    dot_word = _DOT_WORD.search(s) is not None
    values = (
        True, s[0] == "+", "@" in s, (" at " in low and dot_word) or "(at)" in low or "[at]" in low, dot_word, 3 <= n <= 7, 8 <= n <= 15, 16 <= n <= 19, n > 19, n == 0,
        16 <= n <= 19 and luhn(digits), bool(_IP_SHAPE.fullmatch(s)) and _ip_ok(s), "(" in s and ")" in s, "-" in s, " " in s, any(c.isalpha() for c in s), not (s[-1].isalnum()), bool(_PARTS.fullmatch(s)), left.isalpha(),
        (left.isdigit() and s[0].isdigit()) or (right.isdigit() and s[-1].isdigit()), (left != "" and left in "@._%+-") or right == "@", tokens == 1, any(not (c.isalnum() or c in _SIGNS or c == " ") for c in s), _GOES_ON.match(text, end) is not None or _COMES_ON.search(text[max(0, start - 8) : start]) is not None,
    )
    return np.fromiter(values, np.float64, len(FEATURES))


#: What must be in a segment for some features; each pattern finds strings of one length.
_AT_CORE, _DOT_CORE = re.compile(r"(?=\x20[Aa][Tt]\x20|\([Aa][Tt]\)|\[[Aa][Tt]\])"), re.compile(r"(?=\s[Dd][Oo][Tt]\s|[\[(][Dd][Oo][Tt][\])])")
_PARTS_CORE = re.compile(r"(?=[\s\[(][Aa][Tt][\s\])])")


class Shape:
    """What the features of a stretch's segments are read from: signs counted up to each token's end, and those beside it."""

    def __init__(self, text: str, ends: array):
        self.text, self.ends = text, np.array(ends, np.int64)
        a, b = ends[0], ends[-1]
        codes, of = np.unique(np.frombuffer(text[a:b].encode("utf-32-le", "surrogatepass"), np.uint32), return_inverse=True)
        signs = [(c in "0123456789", c == "@", c == "(", c == ")", c == "-", c == " ", c.isalpha(), not (c.isalnum() or c in _SIGNS or c == " ")) for c in map(chr, codes.tolist())]
        counts = np.zeros((len(ends), 8), np.int32)
        if b > a:
            np.cumsum(np.add.reduceat(np.array(signs, bool)[of], self.ends[:-1] - a, axis=0, dtype=np.int32), axis=0, out=counts[1:])
        self.counts = counts.T
        self.at_cores, self.dot_cores, self.parts_cores = (np.array([m.start() for m in p.finditer(text, a, b)], np.int64) for p in (_AT_CORE, _DOT_CORE, _PARTS_CORE))
        left, right = [text[p - 1 : p] for p in ends], [text[p : p + 1] for p in ends]
        bits = lambda x: np.fromiter(x, bool, len(ends))
        self.left_alpha, self.left_alnum, self.left_digit = bits(map(str.isalpha, left)), bits(map(str.isalnum, left)), bits(map(str.isdigit, left))
        self.left_glue, self.right_plus, self.right_at = bits(c != "" and c in "@._%+-" for c in left), bits(c == "+" for c in right), bits(c == "@" for c in right)
        self.right_digit = bits(map(str.isdigit, right))
        self.goes_on = bits(_GOES_ON.match(text, p) is not None for p in ends)
        spelt = _DOT_WORD.search(text, max(0, a - 8), b) is not None
        self.comes_on = bits(spelt and _COMES_ON.search(text[max(0, p - 8) : p]) is not None for p in ends)

    def _holds(self, cores: np.ndarray, size: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return np.searchsorted(cores, end - size, "right") > np.searchsorted(cores, start, "left")

    def features(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The values of ``FEATURES`` for the segments from token ``i`` up to ``j``, a row each."""
        text, start, end = self.text, self.ends[i], self.ends[j]
        n, at, opened, closed, dashes, spaces, letters, odd = self.counts[:, j] - self.counts[:, i]
        dot_word = self._holds(self.dot_cores, 5, start, end)
        at_core = self._holds(self.at_cores, 4, start, end)
        none = np.zeros(len(i), bool)
        found = lambda which, test: np.fromiter((bool(w and test(text[a:b])) for w, a, b in zip(which.tolist(), start.tolist(), end.tolist(), strict=True)), bool, len(i)) if which.any() else none
        plain_at = found(at_core & ~dot_word, lambda s: "(at)" in s.lower() or "[at]" in s.lower())
        return np.stack(
            [
                np.ones(len(i), bool), self.right_plus[i], at > 0, (at_core & dot_word) | plain_at, dot_word, (n >= 3) & (n <= 7), (n >= 8) & (n <= 15), (n >= 16) & (n <= 19), n > 19, n == 0,
                found((n >= 16) & (n <= 19), lambda s: luhn("".join(c for c in s if c in "0123456789"))), found((end - start == n + 3) & (j - i == 7), lambda s: _IP_SHAPE.fullmatch(s) and _ip_ok(s)), (opened > 0) & (closed > 0), dashes > 0, spaces > 0, letters > 0, ~self.left_alnum[j],
                found((at > 0) | self._holds(self.parts_cores, 4, start, end), _PARTS.fullmatch), self.left_alpha[i],
                (self.left_digit[i] & self.right_digit[i]) | (self.right_digit[j] & self.left_digit[j]), self.left_glue[i] | self.right_at[j], j - i == 1, odd > 0, self.goes_on[j] | self.comes_on[i],
            ],
            axis=1,
        )


def stretches(text: str) -> list[tuple[int, int]]:
    """Stretches of ``text`` around triggers, ``LONGEST`` whole tokens to either side, joined where they meet."""
    out: list[list[int]] = []
    if _TRIGGER.search(text) is None:
        return []
    ends = array("q", [0])
    ends.extend(m.end() for m in _TOKEN.finditer(text))
    for s, e in (m.span() for m in _TRIGGER.finditer(text)):
        a, b = ends[max(0, bisect_right(ends, s) - 1 - LONGEST)], ends[min(len(ends) - 1, bisect_left(ends, e) + LONGEST)]
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def token_ends(text: str, a: int, b: int) -> array:
    """``a`` and the ends of the tokens of a stretch."""
    ends = array("q", [a])
    ends.extend(m.end() for m in _TOKEN.finditer(text, a, b))
    return ends


def candidates(text: str, ends: array) -> Iterator[tuple[int, int]]:
    """The candidate segments of a stretch, by their first token: those with a whole trigger that start and end on a letter, digit, ``+`` or ``(``."""
    n = len(ends) - 1
    hits = (m.span() for m in _TRIGGER.finditer(text, ends[0], ends[n]))
    hit = next(hits, None)
    for i in range(n):
        while hit is not None and hit[0] < ends[i]:
            hit = next(hits, None)
        if hit is None:  # what starts here or later has no trigger
            return
        if hit[1] > ends[min(n, i + LONGEST)] or not (text[ends[i]].isalnum() or text[ends[i]] in "+("):
            continue
        for j in range(max(i + 1, bisect_left(ends, hit[1], i, min(n, i + LONGEST) + 1)), min(n, i + LONGEST) + 1):
            if text[ends[j] - 1].isalnum():
                yield i, j


def best(text: str, a: int, b: int, w: np.ndarray) -> list[tuple[str, int, int]]:
    """The segments of the highest total score in a stretch; a token outside of segments scores 0.

    Segments come by their first token, whose own value is final then, and are scored some hundred at a time: of a
    stretch of any length only a few numbers a token are held.
    """
    ends = token_ends(text, a, b)
    n = len(ends) - 1
    shape = Shape(text, ends)
    value, top = array("d", [0.0]) * (n + 1), array("d", [-np.inf]) * (n + 1)
    start, kind = array("q", [-1]) * (n + 1), array("b", [0]) * (n + 1)
    settled = 0

    def settle(upto: int) -> None:
        nonlocal settled
        for j in range(settled + 1, upto + 1):
            if top[j] > value[j - 1] + 1e-12:
                value[j] = top[j]
            else:
                value[j], start[j] = value[j - 1], -1
        settled = max(settled, upto)

    segments = candidates(text, ends)
    while block := list(islice(segments, BLOCK)):
        scores = shape.features(*np.array(block, np.int64).T) @ w.T
        for (i, j), k, s in zip(block, scores.argmax(1).tolist(), scores.max(1).tolist(), strict=True):
            settle(i)
            if (v := value[i] + s) > top[j] + 1e-12:
                top[j], start[j], kind[j] = v, i, k
    settle(n)
    out, j = [], n
    while j:
        if start[j] < 0:
            j -= 1
        else:
            i = start[j]
            out.append((KINDS[kind[j]], ends[i], ends[j]))
            j = i
    return out[::-1]


class Lattice:
    """All candidate segments of a short stretch with their features, for the fit."""

    def __init__(self, text: str, a: int, b: int):
        self.text, self.a, self.b = text, a, b
        self.ends = token_ends(text, a, b)
        self.n = len(self.ends) - 1
        self.segments = list(candidates(text, self.ends))
        self.x = Shape(text, self.ends).features(*np.array(self.segments, np.int64).reshape(-1, 2).T).astype(np.float64)

    def best(self, w: np.ndarray) -> list[tuple[str, int, int]]:
        return best(self.text, self.a, self.b, w)

    def marginals(self, w: np.ndarray) -> np.ndarray:
        """The probability of each segment and kind, by forward and backward sums."""
        return _marginals(np.array(self.segments, np.int32).reshape(-1, 2), self.x, self.n, w)


def _log_sum(terms: list[float]) -> float:
    """The logarithm of the sum of exponentials; plain numbers, as the lists are short."""
    most = max(terms)
    return most + math.log(sum([math.exp(t - most) for t in terms]))


def _marginals(at: np.ndarray, x: np.ndarray, n: int, w: np.ndarray) -> np.ndarray:
    scores = x @ w.T
    top = np.logaddexp.reduce(scores, axis=1) if len(scores) else np.zeros(0)
    by_end = np.argsort(at[:, 1], kind="stable")
    opens, closes = np.searchsorted(at[:, 0], np.arange(n + 2)).tolist(), np.searchsorted(at[by_end, 1], np.arange(n + 2)).tolist()
    start, end, score, tops = at[by_end, 0].tolist(), at[:, 1].tolist(), top[by_end].tolist(), top.tolist()
    f, b = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(1, n + 1):
        f[j] = f[j - 1]
        if (lo := closes[j]) < (hi := closes[j + 1]):
            f[j] = _log_sum([f[j], *[f[i] + s for i, s in zip(start[lo:hi], score[lo:hi], strict=True)]])
    for i in range(n - 1, -1, -1):
        b[i] = b[i + 1]
        if (lo := opens[i]) < (hi := opens[i + 1]):
            b[i] = _log_sum([b[i], *[b[j] + s for j, s in zip(end[lo:hi], tops[lo:hi], strict=True)]])
    f, b = np.array(f), np.array(b)
    return np.exp(scores + (f[at[:, 0]] + b[at[:, 1]] - f[n])[:, None])


def _respelt(text: str, spans: list[tuple[str, int, int]], turn: int) -> tuple[str, list[tuple[str, int, int]]]:
    """``text`` with its phones and mail addresses spelt as the patterns don't know them, and the moved spans."""
    out, marks, at = [], [], 0
    size = 0
    for kind, s, e in sorted(spans, key=lambda x: x[1]):
        if s < at:
            continue
        found = text[s:e]
        if kind == "phone":
            found = re.sub(r"^\+[0-9]+[\x20.-]*", "", found) if turn % 2 else found
        elif kind == "email":
            found = found.replace("@", (" at ", " (at) ", " [at] ")[turn % 3]).replace(".", (" dot ", ".", " [dot] ")[turn % 3])
        out += [text[at:s], found]
        size += s - at
        marks.append((kind, size, size + len(found)))
        size += len(found)
        at = e
    return "".join([*out, text[at:]]), marks


def fit(texts: list[str]) -> np.ndarray:
    """Weights (kinds x features) that make the base spans of ``texts`` likely: adaptive gradient ascent with an L2 term."""
    chosen: list[tuple[np.ndarray, np.ndarray, int, list[tuple[int, int]]]] = []  # bits, not floats: the sample is held as a whole
    for turn, text in enumerate(texts):
        spans = base_spans(text)
        kinds = [(text, spans)]
        if spans:
            kinds.append(_respelt(text, spans, turn))
        for t, marks in kinds:
            truth = {(s, e): KINDS.index(k) for k, s, e in marks}
            for a, b in _pieces(t, marks):
                lattice = Lattice(t, a, b)
                y = [(k, kind) for k, (i, j) in enumerate(lattice.segments) if (kind := truth.get((lattice.ends[i], lattice.ends[j]))) is not None]
                if lattice.segments:
                    chosen.append((np.array(lattice.segments, np.int32), lattice.x.astype(bool), lattice.n, y))
    w, g2 = np.zeros((len(KINDS), len(FEATURES))), np.full((len(KINDS), len(FEATURES)), 1e-6)
    if not any(y for *_, y in chosen):
        return w
    for _ in range(EPOCHS):
        for at, bits, n, y in chosen:
            x = bits.astype(np.float64)
            g = -_marginals(at, x, n, w).T @ x - 1e-3 * w
            for k, kind in y:
                g[kind] += x[k]
            g2 += g * g
            w += 0.5 * g / np.sqrt(g2)
    return w


def _pieces(text: str, marks: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """The stretches of ``text``, those of over ``PIECE`` tokens cut at the next token's end that is inside no mark."""
    out = []
    for a, b in stretches(text):
        inside, n = [(s, e) for _, s, e in marks if s < b and e > a], 0
        for m in _TOKEN.finditer(text, a, b):
            n += 1
            if n >= PIECE and m.end() < b and not any(s < m.end() < e for s, e in inside):
                out.append((a, m.end()))
                a, n = m.end(), 0
        out.append((a, b))
    return out


def passage(text: str) -> tuple[bool, str] | None:
    """What ``text`` gives to the sample, and whether that has a base span; None where nothing triggers."""
    if (hit := _TRIGGER.search(text)) is None:
        return None
    found = base_spans(text)
    first = min((x for x in found if x[2] - x[1] <= PASSAGE // 2), key=lambda x: x[1], default=None)
    begin = hit.start() if first is None else first[1]
    a = max(0, begin - PASSAGE // 4)
    b = min(len(text), a + PASSAGE)
    moved = True
    while moved:  # spans may overlap
        moved = False
        for _, s, e in found:
            if s < a < e:
                a, moved = min(e, begin), moved or a != min(e, begin)
            if s < b < e and s > begin:
                b, moved = s, True
    return first is not None, text[a:b]


def all_spans(text: str, w: np.ndarray) -> list[tuple[str, int, int, bool]]:
    """Base spans and those that the field adds, by kind, then start; the last value tells base spans."""
    base = base_spans(text)
    out = [(*s, True) for s in base]
    if w.any():
        near = sorted((s, e) for _, s, e in base)
        starts, furthest = [s for s, _ in near], list(accumulate((e for _, e in near), max))
        free = lambda s, e: (k := bisect_left(starts, e)) == 0 or furthest[k - 1] <= s
        for a, b in stretches(text):
            out += [(k, s, e, False) for k, s, e in best(text, a, b, w) if free(s, e)]
    return sorted(out, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def fitted(docs: DataFrame) -> np.ndarray:
    """Weights from a bounded sample of ``docs``; the sample, not more, comes to the driver."""
    limits = {True: SAMPLE - OTHERS, False: OTHERS}

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bool, dict[str, str]] = {True: {}, False: {}}
        for b in batches:
            for text in b.column(0).to_pylist():
                if (p := passage(text)) is not None:
                    kept[p[0]][hashlib.sha256(p[1].encode("utf-8", "surrogatepass")).hexdigest()] = p[1]
                    if len(kept[p[0]]) > 2 * limits[p[0]]:
                        kept[p[0]] = {k: kept[p[0]][k] for k in sorted(kept[p[0]])[: limits[p[0]]]}
        rows = [(base, k, found[k]) for base, found in kept.items() for k in sorted(found)[: limits[base]]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else ((), (), ()), (pa.bool_(), pa.string(), pa.string()), strict=True)], names=["base", "key", "passage"])

    some = written(id_and_text(docs).select("text").mapInArrow(first, "base boolean, key string, passage string"))
    once = some.groupBy("base", "key").agg(F.min("passage").alias("passage"))
    rows = [r for base, n in limits.items() for r in once.where(F.col("base") == base).orderBy("key").limit(n).collect()]
    return fit([r["passage"] for r in sorted(rows, key=lambda r: r["key"])])


def spans(docs: DataFrame, w: np.ndarray | None = None) -> DataFrame:
    """doc_id and ``spans``: array<struct<kind, start, end, base>> of code point offsets, end exclusive, by kind, then start."""
    w = fitted(docs) if w is None else w
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in all_spans(t, w)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(item))], names=["doc_id", "spans"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, spans array<struct<kind: string, start: long, end: long, base: boolean>>")


def redacted(docs: DataFrame, w: np.ndarray | None = None) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in brackets; overlapping spans become one, of the first kind."""
    w = fitted(docs) if w is None else w
    at = docs.columns.index("text")

    def hidden(text: str | None) -> str | None:
        if not text:
            return text
        out, end = [], 0
        for kind, s, e, _ in sorted(all_spans(text, w), key=lambda x: (x[1], -x[2])):
            if s >= end:
                out += [text[end:s], f"[{kind}]"]
            end = max(end, e)
        return "".join([*out, text[end:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.set_column(at, b.schema.field(at), pa.array(list(map(hidden, b.column(at).to_pylist())), b.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def op1_pii(docs: DataFrame) -> DataFrame:
    """The contract's columns, with ``n_spans``, all spans, and ``n_added``, those of the field."""
    d = spans(docs)
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["base"])
    return d.select(
        "doc_id",
        *map(_count, KINDS),
        F.sha2(F.encode(F.array_join(F.transform(base, line), ","), "UTF-8"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", line), ",").alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"),
    )


def _count(kind: str):
    return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
