"""Personal data: fixed patterns, and further spans by weak supervision.

Emails, addresses of machines, card and phone numbers that fit a fixed pattern are spans
as they are. Further candidates (national phone numbers, spelled-out emails, account and
social numbers, birth dates, titled names) are judged by labelers of three sorts: regexes
(shape), gazetteers (names, words of other numbers), and context (words near by). Each
votes for, against, or not at all.

All candidates are counted by kind and votes, a table bounded by the number of vote
patterns however many documents there are. On it, expectation-maximisation estimates how
reliable each labeler is (over all kinds, then for each kind, drawn towards the whole) and
how likely each pattern is personal data. Those likelihoods are the labels of the span
classifier, a logistic regression that sees no votes, but the span itself and what stands
around it: hashed three-letter shapes, neighbouring words and signs, length and position.
It is fitted on at most ``TRAIN_MOST`` different candidates, picked by a hash of their
features. Every candidate is scored; those with ``LEAST`` or more become spans, the leftmost
and then the longest first where they overlap.

Cases: a missing text counts as empty and has no span; a missing doc_id stays missing;
repeated rows are scanned (and counted) each, but teach the classifier once; candidates that
touch a fixed pattern's span are left out; of candidates with one start the longest wins,
then the kind's name; a very long text is scanned whole, like any other; with no candidates
at all nothing is trained; an empty table gives no rows; other columns are not read.
"""

import re
import zlib
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm import tables
from txrisk.llm.spans import Span, clear_of, digest, free_of, listing
from txrisk.sources.stages import materialize

BASE = ("email", "ip", "card", "phone")
FURTHER = ("local_phone", "spelled_email", "account", "social", "birth", "name")
KINDS = BASE + FURTHER
LEAST = 0.5
WINDOW = 40  # characters of context on either side
EM_ROUNDS = 50
POOLED = 50.0  # candidates that the reliabilities over all kinds weigh in those of a kind
TRAIN_MOST = 20_000
FEATURES = 1 << 14
MAX_NAMES = 1_000_000

_LOCAL_PART = re.compile("[A-Za-z0-9._%+-]*")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_SMALL, _LARGE, _WORD = map(re.compile, ("[a-zß-öø-ÿ]", "[A-ZÀ-ÖØ-Þ]", r"\w+"))
_LONG_NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9]){13}")

_CANDIDATES = {
    "local_phone": re.compile(
        r"(?<![0-9+(-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
    ),
    "social": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "account": re.compile(r"(?<![0-9A-Za-z.-])(?:[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}|[0-9]{8,19})(?![0-9A-Za-z])"),
    "birth": re.compile(
        r"(?<![0-9./-])(?:[0-9]{1,2}([./-])[0-9]{1,2}\1(?:19|20)[0-9]{2}"
        r"|(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2})(?![0-9])"
    ),
    "spelled_email": re.compile(
        r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{2,64}\x20?(?:\[at\]|\(at\)|\x20at\x20)\x20?"
        r"[A-Za-z0-9-]{2,63}\x20?(?:\[dot\]|\(dot\)|\x20dot\x20)\x20?[a-z]{2,6}\b"
    ),
    "name": re.compile(
        r"\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Monsieur|Madame|Señor|Señora)\.?\x20"
        r"([A-ZÀ-Ý][a-zß-ÿ]{1,30})(?:\x20[A-ZÀ-Ý][a-zß-ÿ]{1,30})?"
    ),
}
_NEEDS = {"spelled_email": ("at", "dot"), "name": ("M", "Dr", "Herr", "Frau", "Señor")}

# The gazetteers to begin with; ``find_pii`` takes a longer list of names.
GIVEN_NAMES = frozenset(
    "james mary john patricia robert jennifer michael linda david elizabeth william barbara "
    "richard susan joseph jessica thomas sarah anna maria peter paul laura daniel sofia lucas "
    "emma marie pierre jean claude sophie hans klaus ursula heike stefan juan carlos jose carmen "
    "luis ana pedro miguel isabel".split()
)
OTHER_NUMBERS = re.compile(
    r"\b(?:order|invoice|version|isbn|page|figure|table|total|price|serial|part|model|item|"
    r"token|hash|build|release|chapter|volume|section|lot|sku)\b",
    re.IGNORECASE | re.ASCII,
)
NEAR_WORDS = {
    "local_phone": r"tel|phone|call|fax|mobile|cell|contact|whatsapp|telefon|tél|móvil|ring",
    "spelled_email": r"mail|contact|write|reach|address|schreib|écri|escrib",
    "account": r"account|iban|bank|card|konto|compte|cuenta|passport|licen[cs]e|member|customer",
    "social": r"ssn|social|security|taxpayer|tax\s?id",
    "birth": r"born|birth|dob|geboren|né[e]?\ble|nacid|birthday",
    "name": r"dear|regards|patient|signed|resident|tenant|address|lives|met",
}
_NEAR = {
    k: re.compile(rf"(?<![a-zà-ÿ])(?:{v})", re.IGNORECASE) for k, v in NEAR_WORDS.items()
}
LABELERS = ("shape", "checksum", "gazetteer", "other_number", "context", "neighbour")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """From each @, the run of local-part characters before it (after the last span) and
    the domain after it: the leftmost matches, in time linear in the text."""
    found, last, n = [], 0, len(text)
    if "@" not in text:
        return found
    backwards, at = text[::-1], text.find("@")
    while at >= 0:
        run = _LOCAL_PART.match(backwards, n - at).end() - (n - at)
        start = max(at - run, last)
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append(("email", start, domain.end()))
            last = domain.end()
        at = text.find("@", at + 1)
    return found


def _part_fits(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    found = emails(text)
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(map(_part_fits, m.group().split("."))):
            found.append(("ip", *m.span()))
    if _LONG_NUMBER.search(text):
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m.group())) <= 15:
                found.append(("phone", *m.span()))
    return found


def _votes(text: str, kind: str, a: int, b: int, given: frozenset[str]) -> str:
    """One letter for each labeler: + for, - against, 0 no vote."""
    value, before, after = text[a:b], text[max(0, a - WINDOW) : a], text[b : b + WINDOW]
    digits = "".join(filter(str.isdigit, value))
    shape = "+" if kind in ("social", "spelled_email", "name") or "(" in value else "0"
    checksum = "0"
    if kind == "account" and digits:
        checksum = "+" if len(digits) >= 12 and luhn(digits) else "-"
    words = re.findall("[a-zà-ÿ]+", f"{value} {before[-20:]}".lower())
    gazetteer = "+" if any(w in given for w in words) else "0"
    other = "-" if OTHER_NUMBERS.search(before) else "0"
    context = "+" if _NEAR[kind].search(before) else "0" if before.strip() else "-"
    glued = before[-1:] in tuple("=#/_:\"'") or after[:1] in tuple("=/_%\"'")
    neighbour = "-" if glued or (digits and re.search(r"[0-9]\s*\Z", before)) else "0"
    return shape + checksum + gazetteer + other + context + neighbour


def _shape(text: str) -> str:
    return _SMALL.sub("a", _LARGE.sub("A", _DIGIT.sub("9", text)))


def features(text: str, kind: str, a: int, b: int) -> list[int]:
    """Hashed features of a span of ``text`` and of what stands around it."""
    value, before, after = text[a:b], text[max(0, a - WINDOW) : a], text[b : b + WINDOW]
    shape = f"^{_shape(value)}$"
    found = {f"shape {shape[i : i + 3]}" for i in range(len(shape) - 2)}
    found.update(f"word {w}" for w in _WORD.findall(value.lower()))
    last, following = (_WORD.findall(_DIGIT.sub("9", x.lower())) for x in (before, after))
    found.update(f"before {w}" for w in last[-3:])
    found.update(f"next {w}" for w in last[-1:])
    found.update(f"after {w}" for w in following[:2])
    found.add(f"left {_shape(before[-1:])}")
    found.add(f"right {_shape(after[:1])}")
    found.add(f"length {len(value)}")
    found.add(f"place {4 * a // max(1, len(text))}")
    found.add("")  # the kind itself
    return sorted({zlib.crc32(f"{kind} {f}".encode()) % FEATURES for f in found})


Candidate = tuple[str, int, int, str, list[int]]


def candidates(text: str, base: list[Span], given: frozenset[str] = GIVEN_NAMES) -> list[Candidate]:
    """Further spans that may be personal data and may overlap, each with the labelers' votes
    and its features."""
    digit, found = bool(_DIGIT.search(text)), []
    for kind, pattern in _CANDIDATES.items():
        hints = _NEEDS.get(kind)
        if digit if hints is None else any(h in text for h in hints):
            found += [(kind, *m.span()) for m in pattern.finditer(text)]
    return [
        (k, a, b, _votes(text, k, a, b, given), features(text, k, a, b))
        for k, a, b in clear_of(found, base)
    ]


SCANNED = (
    "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
    "base_sha256 string, base string, "
    "found array<struct<kind:string,start:int,end:int,votes:string,features:array<int>>>"
)


def scan(docs: DataFrame, given: frozenset[str] = GIVEN_NAMES) -> DataFrame:
    """For each document its base spans, and its candidates with their votes."""

    names = tables.names_of(SCANNED)

    def rows(some: dict) -> dict:
        out = []
        for name, text in zip(some["doc_id"], some["text"], strict=True):
            base = base_spans(text)
            counts = [sum(k == kind for k, _, _ in base) for kind in BASE]
            line = listing(base, KINDS)
            found = [
                {"kind": k, "start": a, "end": b, "votes": v, "features": f}
                for k, a, b, v, f in candidates(text, base, given)
            ]
            out.append((name, *counts, digest(line), line, found))
        return dict(zip(names, zip(*out, strict=True), strict=True))

    return tables.map_slices(tables.spread(tables.texts(docs)), lambda: rows, SCANNED)


def reliabilities(patterns: pd.DataFrame, rounds: int = EM_ROUNDS, prior=None, weight: float = 3.0):
    """Expectation-maximisation over vote patterns (kind, votes, n). Returns how likely each
    pattern is personal data, and each labeler's share of votes for and against among
    personal data and among the rest (a table labelers x {for, against} x {yes, no}). Shares
    begin at those of ``prior`` (else a third) with the weight of so many candidates."""
    votes = np.array([list(v) for v in patterns["votes"]])
    cast = np.stack([votes == "+", votes == "-"], axis=2)  # pattern, labeler, side
    n = patterns["n"].to_numpy(float)
    lead = cast[:, :, 0].sum(1) - cast[:, :, 1].sum(1)
    likely = 1 / (1 + np.exp(-2.0 * lead + 0.5))  # the majority to begin with
    kinds = pd.factorize(patterns["kind"])[0]
    share, first = None, np.full((len(LABELERS), 2, 2), 1 / 3) if prior is None else prior
    for _ in range(rounds):
        yes = np.stack([likely, 1 - likely], axis=1) * n[:, None]
        held = np.einsum("pls,pc->lsc", cast, yes)
        none = yes.sum(0) - held.sum(1)
        whole = yes.sum(0) + weight
        share = (held + weight * first) / whole
        silent = (none + weight * (1 - first.sum(1))) / whole
        common = np.stack([np.bincount(kinds, yes[:, c]) for c in (0, 1)], axis=1) + 1
        log = np.log(common / common.sum(1, keepdims=True))[kinds]
        log = log + np.einsum("pls,lsc->pc", cast, np.log(share))
        log = log + (~cast.any(2)).astype(float) @ np.log(silent)
        likely = 1 / (1 + np.exp(np.clip(log[:, 1] - log[:, 0], -30, 30)))
    return likely, share


def likelihoods(patterns: pd.DataFrame) -> np.ndarray:
    """How likely each vote pattern is personal data, with reliabilities of its own kind that
    begin at those over all kinds."""
    _, pooled = reliabilities(patterns)
    likely = np.zeros(len(patterns))
    for _, rows in patterns.groupby("kind").indices.items():
        likely[rows] = reliabilities(patterns.iloc[rows], prior=pooled, weight=POOLED)[0]
    return likely


def score_spans(weights: np.ndarray, spans: list) -> np.ndarray:
    """How likely each list of features is personal data, by the classifier."""
    counts = np.array([len(f) for f in spans], np.int64)
    flat = np.concatenate(spans).astype(np.int64) if len(spans) else np.zeros(0, np.int64)
    total = np.bincount(np.repeat(np.arange(len(counts)), counts), weights[flat], len(counts))
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def train_classifier(spans: list, likely: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Weights of a ridge logistic regression from features to likelihoods, by gradient steps
    that shrink for each feature with the gradients it has had."""
    counts = np.array([len(f) for f in spans])
    flat = np.concatenate(spans).astype(np.int64)
    weights, seen = np.zeros(FEATURES), np.full(FEATURES, 1e-8)
    for _ in range(rounds):
        off = np.repeat(score_spans(weights, spans) - likely, counts)
        slope = np.bincount(flat, off, FEATURES) / len(spans) + weights / (10 * len(spans))
        seen += slope * slope
        weights -= 0.3 * slope / np.sqrt(seen)
    return weights


def training_rows(each: DataFrame, most: int = TRAIN_MOST) -> pd.DataFrame:
    """At most ``most`` different candidates (kind, votes, features), those with the least
    hashes of what they hold."""
    rows = each.select("c.kind", "c.votes", "c.features")
    rows = rows.withColumn("pick", F.xxhash64("kind", "votes", "features"))
    different = rows.agg(F.approx_count_distinct("pick", 0.02)).first()[0]
    share = min(1.0, 1.25 * most / max(1, different))
    near = F.col("pick") <= int(-(2**63) + share * (2**64 - 1) // 1) if share < 1 else F.lit(True)
    return rows.filter(near).distinct().orderBy("pick", "kind", "votes").limit(most).toPandas()


def find_pii(
    docs: DataFrame,
    least: float = LEAST,
    names: Iterable[str] = GIVEN_NAMES,
    train_most: int = TRAIN_MOST,
) -> DataFrame:
    """One row for each document: counts and digest of the base spans, and all spans.
    ``names`` is the gazetteer of given names, at most ``MAX_NAMES``."""
    given = frozenset(n.lower() for n in names)
    if len(given) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} names")
    scanned = materialize(scan(docs, given), "scanned")
    each = scanned.select(F.explode("found").alias("c"))
    counted = each.groupBy("c.kind", "c.votes").agg(F.count("*").alias("n"))
    patterns = counted.orderBy("kind", "votes").toPandas()  # 6 kinds x 3^6 at most
    weights = np.zeros(FEATURES)
    if len(patterns):
        taught = training_rows(each, train_most)
        patterns["likely"] = likelihoods(patterns)
        labels = taught.merge(patterns, on=["kind", "votes"], how="left", sort=False)["likely"]
        weights = train_classifier(list(taught["features"]), labels.to_numpy())

    def spans(some: dict) -> dict:
        bases, founds = some.pop("base"), some.pop("found")
        score = iter(score_spans(weights, [c["features"] for found in founds for c in found]))
        out = []
        for base, found in zip(bases, founds, strict=True):
            more = [(c["kind"], c["start"], c["end"]) for c in found if next(score) >= least]
            own = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in base.split(",") if s)]
            out.append(listing(own + free_of(more, own), KINDS) if more else base)
        return {**some, "spans": out}

    schema = SCANNED.split(", base string")[0] + ", spans string"
    return tables.map_slices(scanned, lambda: spans, schema)


def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(tables.read(spark, sf_dir, "documents"))
