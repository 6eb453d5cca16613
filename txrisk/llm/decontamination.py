"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are compared as words: runs of letters and digits, in lower case. An
item of n words may differ from a passage by n // ``PER_EDIT`` words (changed, left out or
put in). It is cut into that many pieces and one more; edits can't touch all of them, so
at least one piece stands in the passage as it is. All pieces are searched at once by an
automaton over the text, and at each hit Myers' bit-parallel algorithm, whose pattern bits
are the item's words, measures the edit distance of the item to the words around.

Items are broadcast in blocks of ``ITEM_CHARS`` characters at most, one pass over the
texts for each block.

Cases: missing texts and items, and those without words, match nothing; repeated items are
reported each, repeated documents too; of overlapping matches of one item the closest
counts, then the first; an empty table on either side gives no match; a missing id stays
missing; other columns are not read (``decontaminate`` hands them on).
"""

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm import tables

PER_EDIT = 8
ITEM_CHARS = 16_000_000
OUT = "doc_id bigint, item_id bigint, start_word bigint, end_word bigint, edits int"
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def myers(pattern: dict[str, int], n: int, text: list[str], limit: int) -> tuple[int, int] | None:
    """The least edit distance, if at most ``limit``, of a pattern of ``n`` words to any run
    of ``text``, and the first end of such a run. ``pattern`` gives the bits of each word."""
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score, best = full, 0, n, None
    for end, word in enumerate(text, 1):
        eq = pattern.get(word, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        if up & top:
            score += 1
        if down & top:
            score -= 1
        vertical = eq | minus
        up, down = (up << 1) & full, (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        if score <= limit:
            best, limit = (score, end), score - 1
    return best


class Item:
    """A test item: its words, its edit budget, its pieces."""

    def __init__(self, item_id, words: list[str], per_edit: int):
        self.item_id, self.words, self.n = item_id, words, len(words)
        self.budget = self.n // per_edit
        cuts = [i * self.n // (self.budget + 1) for i in range(self.budget + 2)]
        self.pieces = [(a, words[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        self.bits, self.turned = {}, {}
        for i, w in enumerate(words):
            self.bits[w] = self.bits.get(w, 0) | 1 << i
            self.turned[w] = self.turned.get(w, 0) | 1 << (self.n - 1 - i)

    def match(self, text: list[str], at: int) -> tuple[int, int, int] | None:
        """Start, end and edits of the closest match whose first word stands near ``at``."""
        low = max(0, at - self.budget)
        found = myers(self.bits, self.n, text[low : at + self.n + self.budget], self.budget)
        if not found:
            return None
        edits, end = found[0], low + found[1]
        back = text[max(0, end - self.n - edits) : end][::-1]
        _, length = myers(self.turned, self.n, back, edits)
        return end - length, end, edits


class Matcher:
    def __init__(self, items: list[tuple], per_edit: int = PER_EDIT):
        import ahocorasick

        made = [Item(i, words, per_edit) for i, t in items if t and (words := words_of(t))]
        where: dict[str, list] = {}
        for item in made:
            for offset, piece in item.pieces:
                where.setdefault(f" {' '.join(piece)} ", []).append((item, offset))
        self.automaton = ahocorasick.Automaton() if where else None
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple]:
        """(item_id, start, end, edits) of every match in a text, in words."""
        if not text or self.automaton is None:
            return []
        words, starts, seen, found = words_of(text), None, set(), {}
        line = f" {' '.join(words)} "
        for last, (size, places) in self.automaton.iter(line):
            if starts is None:  # where each word begins, only for texts with a hit
                starts, at = [], 1
                for w in words:
                    starts.append(at)
                    at += len(w) + 1
            first = bisect_left(starts, last - size + 2)
            for item, offset in places:
                if (id(item), first - offset) in seen:
                    continue
                seen.add((id(item), first - offset))
                match = item.match(words, first - offset)
                if match:
                    found.setdefault(id(item), (item, set()))[1].add(match)
        out = []
        for item, matches in found.values():
            taken: list[tuple[int, int]] = []
            for start, end, edits in sorted(matches, key=lambda m: (m[2], m[0], m[1])):
                if all(end <= a or start >= b for a, b in taken):
                    taken.append((start, end))
                    out.append((item.item_id, start, end, edits))
        return sorted(out, key=lambda m: (m[1], m[2], m[0] is None, m[0] or 0))


def item_blocks(benchmark: DataFrame, limit: int = ITEM_CHARS) -> Iterator[list[tuple]]:
    """The test items, in lists of about ``limit`` characters at most."""
    items = benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")
    ).filter("text IS NOT NULL")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * chars // limit)) if chars > limit else 1
    for b in range(blocks):
        some = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        yield [tuple(r) for r in some.collect()]


def find_contamination(docs: DataFrame, benchmark: DataFrame, per_edit: int = PER_EDIT) -> DataFrame:
    """Every match of a test item in a document."""
    rows, spark = tables.spread(tables.texts(docs)), docs.sparkSession
    names = tables.names_of(OUT)

    def one_pass(items):
        held = spark.sparkContext.broadcast(items)

        def start():
            matcher = Matcher(held.value, per_edit)

            def search(some: dict) -> dict:
                found = [
                    (d, *m)
                    for d, t in zip(some["doc_id"], some["text"], strict=True)
                    for m in matcher.matches(t)
                ]
                return {c: [row[i] for row in found] for i, c in enumerate(names)}

            return search

        return tables.map_slices(rows, start, OUT)

    return reduce(DataFrame.unionByName, map(one_pass, item_blocks(benchmark)))


def decontaminate(docs: DataFrame, benchmark: DataFrame, per_edit: int = PER_EDIT) -> DataFrame:
    """``docs`` without the rows whose text holds a test item, all columns as they are."""
    spark, out = docs.sparkSession, tables.spread(docs)
    for items in item_blocks(benchmark):
        held = spark.sparkContext.broadcast(items)

        def start(held=held):
            matcher = Matcher(held.value, per_edit)
            return lambda texts: [not matcher.matches(t) for t in texts]

        out = tables.filter_rows(out, start)
    return out


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(*(tables.read(spark, sf_dir, t) for t in ("documents", "benchmark")))
