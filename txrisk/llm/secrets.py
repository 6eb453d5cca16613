"""Secret scan: fixed patterns, and values in a credential context that are hard to guess.

A value that follows a credential word and an assignment sign (or ``is``; after ``bearer``,
blanks suffice) is cut into segments a guesser would try: words of a ranked vocabulary, dates,
repeats, keyboard walks, runs of digits or letters, separators, and spans tried by brute force
(``segment_cost``). Dynamic programming over the positions finds the segmentation with the
fewest guesses in all: guesses multiply, so their logarithms add, and every further segment
costs a factor of two. Every pair of start and end is tried for each sort of segment, up to
``SEGMENT_MOST`` characters; beyond that length, a walk, run or repeat counts to its end only,
so that time is linear in the length of the value. The value is a secret from 10^``GUESSES``
guesses on. A value that is a reference in whole, such as ``${DB_PASSWORD}`` or
``process.env.TOKEN``, names a secret and holds none.

Cases: a missing text counts as empty and has no span; a missing doc_id stays missing;
repeated rows are scanned each; spans found by guess cost that touch a fixed pattern's span
are left out; a very long value is cut like any other; between segmentations of one cost there
is nothing to choose, since only the cost counts; an empty table gives no rows; other columns
are not read.
"""

import json
import math
import re
from collections.abc import Iterator
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from txrisk.llm import tables
from txrisk.llm.spans import Span, digest, free_of, listing
from txrisk.llm.tokens import vocabulary_path

KINDS = ("assign", "access", "hex", "guess")
GUESSES = 10.0  # decimal logarithm

_KEYS = "password|passwd|secret|token|api_?key"
_ASSIGN = re.compile(
    rf"""({_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{16,}")  # runs are taken whole, so shorter ones fall away

# Words before a credential, and what each pattern needs to occur at all.
_CONTEXT = re.compile(
    r"(?:password|passwd|passphrase|passcode|pwd|secret|token|api[_-]?key|access[_-]?key"
    r"|credentials?|auth[_-]?key|private[_-]?key|login|bearer)"
    r"""["']?[ \t]*(?:=>|:=|[:=]|\bis\b)[ \t]*["']?([^\s"'<>,;]{6,})""",
    re.IGNORECASE | re.ASCII,
)
_BEARER = re.compile(r"""bearer[ \t]+["']?(?=([^\s"'<>,;]{6,}))""", re.IGNORECASE | re.ASCII)
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_CONTEXT_HINTS = (*_ASSIGN_HINTS, "passphrase", "passcode", "pwd", "key", "credential", "login", "bearer")

# What guessers try first, commonest first.
COMMON_WORDS = (
    "password 123456 qwerty letmein welcome admin login master monkey dragon football baseball "
    "sunshine princess shadow superman batman iloveyou trustno1 hello freedom whatever starwars "
    "secret token user guest root test demo sample example default change changeme your here "
    "insert replace enter none null true false value string text name mail email http https www "
    "com org net example placeholder undefined required optional config setting server client "
    "database local host public private access key api id the and for you not with this that from "
    "have are was but all can her his they what when who will more about time love life home work "
    "summer winter spring autumn monday friday january december"
).split()
LONGEST = 24  # letters of a word
SEGMENT_MOST = 32
UNIT_MOST = 8  # characters that a repeat repeats
VOCABULARY_WORD = re.compile("Ġ[A-Za-z]{3,}")
# Signs between words, commonest first, and how variables are written.
SEPARATORS = "._-/:@!#$&+*=~|(){}[]"
_REFERENCE = re.compile(
    r"\$?\{\{?\x20?[A-Za-z_][A-Za-z0-9_.]*\x20?\}?\}?|\$\(?[A-Za-z_][A-Za-z0-9_.]*\)?"
    r"|%[A-Za-z_][A-Za-z0-9_]*%|(?:process\.env|os\.environ|import\.meta\.env)"
    r"(?:\.[A-Za-z_][A-Za-z0-9_]*|(?:\.get)?[\[(].*)",
    re.ASCII | re.DOTALL,
)
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("4301$5@7", "aeoissat")
_DATE = re.compile(
    r"(?:19|20)[0-9]{2}[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:[0-2][0-9]|3[01])"
    r"|(?:[0-2]?[0-9]|3[01])[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}"
)
_MORE = math.log10(2)  # each further segment, and each swap of a letter


@cache
def word_ranks() -> dict[str, int]:
    """Ranks of words: the common ones, then those of the public vocabulary, commonest first."""
    ids = json.loads(Path(vocabulary_path()).read_text(encoding="utf-8"))["model"]["vocab"]
    words = (t[1:].lower() for t in sorted(ids, key=ids.get) if VOCABULARY_WORD.fullmatch(t))
    words = (w for w in words if len(w) <= LONGEST)
    return {w: i for i, w in enumerate(dict.fromkeys([*COMMON_WORDS, *words]), 1)}


def _neighbours() -> dict[str, set[str]]:
    near: dict[str, set[str]] = {}
    for r, row in enumerate(KEY_ROWS):
        for c, key in enumerate(row):
            around = row[max(0, c - 1) : c + 2]
            if r:
                around += KEY_ROWS[r - 1][c : c + 2]
            if r + 1 < len(KEY_ROWS):
                around += KEY_ROWS[r + 1][max(0, c - 1) : c + 1]
            near[key] = set(around) - {key}
    return near


NEAR = _neighbours()


def alphabet_cost(value: str) -> float:
    """Brute force, a character: logarithm of the alphabet the value draws on."""
    size = sum(
        n * bool(re.search(p, value))
        for p, n in (("[a-z]", 26), ("[A-Z]", 26), ("[0-9]", 10), ("[^a-zA-Z0-9]", 33))
    )
    return math.log10(size)


def _lower(value: str) -> str:
    low = value.lower()
    return low if len(low) == len(value) else value  # a letter whose lower case is longer


def _case_cost(word: str) -> float:
    """Small letters, or one or all large, are tried first; else the ways to choose them."""
    up = sum(map(str.isupper, word))
    if not up:
        return 0.0
    if word[0].isupper() and up in (1, len(word)):
        return _MORE
    down = len(word) - up
    return math.log10(2 + sum(math.comb(up + down, i) for i in range(1, min(up, down) + 1)))


def word_cost(word: str) -> float:
    """A word of the vocabulary, in any case, with digits or signs for some letters."""
    low = _lower(word)
    for plain in (low, low.translate(LEET)):
        if rank := word_ranks().get(plain):
            swaps = sum(x != y for x, y in zip(low, plain, strict=True))
            return math.log10(rank + 1) + _case_cost(word) + swaps * _MORE
    return math.inf


def _walk_cost(length: int, turns: int) -> float:
    return math.log10(47 * length) + turns * _MORE


def _unit_cost(unit: str, char: float) -> float:
    """What a repeat repeats; the number of copies comes on top."""
    return min(len(unit) * char, word_cost(unit) + _MORE)


def _step(low: str, i: int) -> int:
    """Between the neighbours i and i + 1, if they follow each other in an order; else 0."""
    step = ord(low[i + 1]) - ord(low[i])
    return step if abs(step) == 1 else 0


def segment_cost(value: str, a: int, b: int, char: float) -> float:
    """Decimal logarithm of the guesses for ``value[a:b]`` as one segment."""
    part, n = value[a:b], b - a
    low, costs = _lower(value)[a:b], [n * char, word_cost(part) if n >= 2 else math.inf]
    if n == 1 and part in SEPARATORS:
        costs.append(math.log10(SEPARATORS.index(part) + 2))
    if _DATE.fullmatch(part):
        costs.append(math.log10(365 * 119))
    if n >= 3 and all(low[i + 1] in NEAR.get(low[i], ()) for i in range(n - 1)):
        jumps = [ord(low[i + 1]) - ord(low[i]) for i in range(n - 1)]
        costs.append(_walk_cost(n, 1 + sum(x != y for x, y in zip(jumps, jumps[1:]))))
    steps = {_step(low, i) for i in range(n - 1)}
    if n >= 3 and len(steps) == 1 and steps != {0}:
        costs.append(math.log10(52 * n))
    for size in range(1, min(UNIT_MOST, n // 2) + 1):
        if n % size == 0 and low == low[:size] * (n // size):
            costs.append(_unit_cost(part[:size], char) + math.log10(n // size))
    return min(costs)


def _reach(n: int, holds) -> list[int]:
    """For each position, how far the pairs go on that ``holds`` of it and the next."""
    out = list(range(1, n + 1))
    for i in range(n - 2, -1, -1):
        if holds(i):
            out[i] = out[i + 1]
    return out


def _ends(a: int, least: int, end: int, step: int = 1) -> Iterator[int]:
    """Ends from ``least`` characters after ``a`` on, near ones all, and the last."""
    last = a + (end - a) // step * step
    yield from range(a + least, min(last, a + SEGMENT_MOST) + 1, step)
    if last > a + SEGMENT_MOST:
        yield last


def guess_cost(value: str) -> float:
    """Decimal logarithm of the guesses the cheapest segmentation needs."""
    if not value:
        return 0.0
    n, low, char, ranks = len(value), _lower(value), alphabet_cost(value), word_ranks()
    plain = low.translate(LEET)
    walk = _reach(n, lambda i: low[i + 1] in NEAR.get(low[i], ()))
    up = _reach(n, lambda i: ord(low[i + 1]) - ord(low[i]) == 1)
    down = _reach(n, lambda i: ord(low[i + 1]) - ord(low[i]) == -1)
    same = [[]]  # by unit: up to where each character equals the one a unit before
    for size in range(1, min(UNIT_MOST, n // 2) + 1):
        far = [n] * (n - size + 1)
        for i in range(n - size - 1, -1, -1):
            far[i] = far[i + 1] if low[i] == low[i + size] else i + size
        same.append(far)
    best, brute = [0.0] + [math.inf] * n, math.inf
    for a in range(n):
        # brute force from any start before here ends here; its first character costs a segment
        brute = min(best[a - 1] + _MORE * (a > 1), brute) + char if a else brute
        best[a] = min(best[a], brute) if a else 0.0
        own = best[a] + _MORE * (a > 0)

        def offer(b, cost):
            if own + cost < best[b]:
                best[b] = own + cost

        if value[a] in SEPARATORS:
            offer(a + 1, math.log10(SEPARATORS.index(value[a]) + 2))
        for b in range(a + 2, min(n, a + LONGEST) + 1):
            if low[a:b] in ranks or plain[a:b] in ranks:
                offer(b, word_cost(value[a:b]))
        if "0" <= value[a] <= "9":
            for b in range(a + 4, min(n, a + 10) + 1):
                if _DATE.fullmatch(value, a, b):
                    offer(b, math.log10(365 * 119))
        if walk[a] - a >= 3:
            turns, counted = 1, a + 2
            for b in _ends(a, 3, walk[a]):
                for i in range(counted, b):
                    turns += ord(low[i]) - ord(low[i - 1]) != ord(low[i - 1]) - ord(low[i - 2])
                counted = b
                offer(b, _walk_cost(b - a, turns))
        for b in _ends(a, 3, max(up[a], down[a])):
            offer(b, math.log10(52 * (b - a)))
        for size in range(1, len(same)):
            if a < len(same[size]) and same[size][a] - a >= 2 * size:
                unit = _unit_cost(value[a : a + size], char)
                for b in _ends(a, 2 * size, same[size][a], size):
                    offer(b, unit + math.log10((b - a) // size))
    brute = min(best[n - 1] + _MORE * (n > 1), brute) + char
    return min(best[n], brute)


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    low = text.lower()
    if any(h in low for h in _ASSIGN_HINTS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    if "AKIA" in text:
        spans = (m.span() for m in _ACCESS.finditer(text))
        found += [("access", a, b) for a, b in spans if b - a >= 18]
    return found + [("hex", *m.span()) for m in _HEX.finditer(text)]


def guessed_spans(text: str, base: list[Span], least: float = GUESSES) -> list[Span]:
    low = text.lower()
    if not any(h in low for h in _CONTEXT_HINTS):
        return []
    found = []
    for context in (_CONTEXT, _BEARER):
        for m in context.finditer(text):
            value = m.group(1).rstrip(".!?)]}")
            if len(value) < 6 or _REFERENCE.fullmatch(value):
                continue
            if guess_cost(value) >= least:
                found.append(("guess", m.start(1), m.start(1) + len(value)))
    return free_of(found, base)


def all_spans(text: str, least: float = GUESSES) -> list[Span]:
    base = base_spans(text)
    return base + guessed_spans(text, base, least)


SCHEMA = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
    "spans string"
)


def _row(name, text, least):
    base = base_spans(text)
    more = guessed_spans(text, base, least)
    counts = [sum(k == kind for k, _, _ in base) for kind in KINDS[:3]]
    return (name, *counts, digest(listing(base, KINDS)), listing(base + more, KINDS))


def scan_secrets(docs: DataFrame, least: float = GUESSES) -> DataFrame:
    """One row for each document: counts and digest of the fixed patterns' spans, all spans."""

    names = tables.names_of(SCHEMA)

    def scan(some: dict) -> dict:
        rows = [_row(d, t, least) for d, t in zip(some["doc_id"], some["text"], strict=True)]
        return dict(zip(names, zip(*rows, strict=True), strict=True))

    return tables.map_slices(tables.spread(tables.texts(docs)), lambda: scan, SCHEMA)


def redact(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """``text`` with ``mark`` in place of each stretch that spans cover."""
    out, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: (s[1], s[2])):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, least: float = GUESSES, mark: str = "[SECRET]") -> DataFrame:
    """``docs``, its columns as they are, with the secrets in ``text`` replaced."""

    def clean(text: str) -> str:
        return redact(text, all_spans(text, least), mark)

    return tables.replace_texts(tables.spread(docs), clean)


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(tables.read(spark, sf_dir, "documents"))
