"""Secrets in whole texts: patterns, and the cost of guessing a value in a credential's place.

The patterns find assigned values, access keys and long hexadecimal runs. Beyond them, each value
that stands where a credential stands ("the pwd is ...", "auth -> ...") is costed: the cheapest
way to cut it into common words, dates, repeated characters, keyboard walks, alphabet and digit
runs, and spans to be tried out by brute force, where a piece's cost is the decimal logarithm of
the guesses it takes and costs add up. A value that takes 10**GUESSES guesses or more is a secret;
a cheaper one is a placeholder or prose.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log10

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

KINDS = ("assign", "access", "hex", "guess")
#: Decimal logarithm of the guesses from which a value counts as a secret.
GUESSES = 11.0
#: Shortest value in a credential's place that is costed.
SHORTEST = 8

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_HINT = re.compile(r"pass|secret|token|key|pwd|auth|credential", re.I | re.A)
_PLACE = re.compile(
    r"""\b(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private|secret|auth)[_\x20-]?key|"""
    r"""auth(?:orization)?|credentials?)["']?\x20*(?:[:=]>?|->|\bis\b)\x20*["']?([^\s"'`<>,;]+)""", re.I | re.A
)

#: Frequent parts of passwords, most frequent first.
WORDS = (
    "password pass admin welcome login letmein qwerty monkey dragon master hello love secret test user guest root "
    "default changeme example sample demo temp token key access public private server system super manager summer "
    "winter spring autumn monday friday january june july october december football baseball soccer hockey shadow "
    "sunshine princess flower star angel baby happy lucky money freedom whatever trust computer internet google "
    "apple orange banana cookie coffee chocolate tiger lion eagle wolf bear horse killer hunter ranger batman "
    "superman pokemon matrix michael jordan jennifer thomas robert daniel charlie george andrew michelle jessica "
    "ashley nicole matthew anthony the and you your for this that with from not null none true false value string "
    "insert replace here your todo xxxx office company london paris berlin new york china data code word dev prod"
).split()
_RANK = {w: k + 2 for k, w in reversed(list(enumerate(WORDS)))}
_LONGEST = max(map(len, WORDS))
_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_KEY_AT = {c: (x, y) for y, row in enumerate(_ROWS) for x, c in enumerate(row)}
_LEET = str.maketrans("@430157$!", "aaeoistsi")
_DATE = re.compile(
    r"(?:19|20)\d\d|(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])"
    r"|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:(?:19|20)\d\d|\d\d)", re.A
)


def _runs(value: str, follows) -> list[int]:
    """For each character, where the run that it continues began."""
    out: list[int] = []
    for k in range(len(value)):
        out.append(out[-1] if k and follows(value[k - 1], value[k]) else k)
    return out


def _near(a: str, b: str) -> bool:
    x, y = _KEY_AT.get(a), _KEY_AT.get(b)
    return x is not None and y is not None and x != y and abs(x[0] - y[0]) <= 1 and abs(x[1] - y[1]) <= 1


def guesses(value: str) -> float:
    """Decimal logarithm of the guesses of the cheapest segmentation."""
    low = value.lower()
    plain = low.translate(_LEET)
    alphabet = sum(n for n, rx in ((26, r"[a-z]"), (26, r"[A-Z]"), (10, r"[0-9]"), (33, r"[^A-Za-z0-9]"))
                   if re.search(rx, value))
    brute = log10(max(alphabet, 2))
    same = _runs(value, lambda a, b: a == b)
    walk = _runs(low, _near)
    up = _runs(value, lambda a, b: ord(b) - ord(a) == 1)
    down = _runs(value, lambda a, b: ord(a) - ord(b) == 1)
    # Turns of a walk up to each character: its step along the row is not the step before.
    steps = [_KEY_AT[b][0] - _KEY_AT[a][0] if _near(a, b) else 0 for a, b in zip(low, low[1:])]
    turned = [0, 0]
    for one, other in zip(steps, steps[1:]):
        turned.append(turned[-1] + (one != other))
    best = [0.0]
    for j in range(1, len(value) + 1):
        cost = best[j - 1] + brute
        for i, n in ((same[j - 1], log10(12)), (up[j - 1], log10(40)), (down[j - 1], log10(80))):
            if j - i >= 3:
                cost = min(cost, best[i] + n + log10(j - i))
        i = walk[j - 1]
        if j - i >= 4:
            turns = turned[j - 1] - turned[i + 1]
            cost = min(cost, best[i] + log10(47 * (j - i)) + turns * log10(4))
        for n in range(3, min(_LONGEST, j) + 1):
            i = j - n
            rank = _RANK.get(low[i:j]) or 2 * _RANK.get(plain[i:j], 0) or 2 * _RANK.get(low[i:j][::-1], 0)
            if rank:
                upper = sum(c.isupper() for c in value[i:j])
                cost = min(cost, best[i] + log10(rank) + (log10(2 + upper) if upper else 0))
        for n in range(4, min(10, j) + 1):
            if _DATE.fullmatch(value, j - n, j):
                cost = min(cost, best[j - n] + log10(365 * (100 if n > 4 else 1)))
        best.append(cost)
    return best[-1]


def spans(text: str, least: float = GUESSES) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then by kind."""
    out = []
    if _HINT.search(text):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
        out += [
            ("guess", *m.span(1)) for m in _PLACE.finditer(text)
            if len(m[1]) >= SHORTEST and guesses(m[1]) >= least
        ]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


_SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"


def find_secrets(docs: DataFrame, text: str = "text", least: float = GUESSES) -> DataFrame:
    """docs with `secrets`, an array of (kind, start, end), after its own columns; one of that name
    is replaced. A null or empty text has none. Other columns may hold anything; repeated rows get
    the same answer; no rows give no rows."""

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    @F.arrow_udf(_SPAN)
    def of(texts: pa.Array) -> pa.Array:
        found = [
            [{"kind": k, "start": a, "end": b} for k, a, b in spans(x or "", least)] for x in texts.to_pylist()
        ]
        return pa.array(found, kind)

    return docs.select(
        *(c for c in docs.columns if c != "secrets"), of(F.col(text).cast("string")).alias("secrets")
    )


def redact(docs: DataFrame, text: str = "text", least: float = GUESSES) -> DataFrame:
    """docs with every secret in the text replaced by [secret]; overlapping ones as one."""
    from pyspark.sql.types import StringType

    @F.arrow_udf(StringType())
    def cleaned(texts: pa.Array) -> pa.Array:
        return pa.array([None if x is None else _without(x, least) for x in texts.to_pylist()], pa.string())

    return docs.withColumn(text, cleaned(F.col(text).cast("string")))


def _without(text: str, least: float) -> str:
    def merged() -> Iterator[tuple[int, int]]:
        start = end = -1
        for _, a, b in spans(text, least):
            if a > end:
                if end > 0:
                    yield start, end
                start, end = a, b
            end = max(end, b)
        if end > 0:
            yield start, end

    out, at = [], 0
    for a, b in merged():
        out += [text[at:a], "[secret]"]
        at = b
    return "".join([*out, text[at:]]) if at else text
