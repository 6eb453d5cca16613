"""PartEnum signatures of word-shingle sets.

Sets are put into bands of sizes: band i ends where sizes exceed its first by more than
1 / 0.75, and instance i takes the sets of bands i - 1 and i, so two sets of Jaccard
similarity 0.75 or more always stand together in some instance. There they differ in at
most k = 2 * (largest size) / 7 shingles. The shingles of the instance are dealt by hash to
n1 parts, of which one holds k2 of the differences at most, and each part to n2 cells, so
that leaving out the right k2 cells of that part leaves equal sets. Each part and choice of
cells to leave out gives one signature: a hash of what stays. Where linked sets differ in
nothing (k = 0), a hash of the whole set is the one signature: different texts can have
equal sets, such as one word repeated 6 or 40 times.

A signature of nothing says nothing, so it is left out where that can't lose a pair: n1 is
larger than the argument needs, and a set with few such signatures keeps another one that
its partner must share. Sets with too many of them send those, too.
"""

from functools import cache
from itertools import combinations

import numpy as np

from txrisk.llm.codes import mix, window_hashes, word_hashes_of

SHINGLE = 5
SPARE = 1.25  # parts beyond those the pigeonhole argument needs
WHOLE_UP_TO = 4  # up to so many differences, one part with more cells


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct ``size``-word shingles, ascending; A-Z count as a-z. A shorter
    text is one shingle."""
    return shingle_sets([text], size)[0]


def shingle_sets(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """``shingles`` of several texts, one behind the other, and how many each text has."""
    hashes, of = word_hashes_of(texts, lower=True)
    words = np.bincount(of, minlength=len(texts))
    items, owner = window_hashes(hashes, size), of[: max(0, len(of) - size + 1)]
    inside = owner == of[len(of) - len(owner) :]
    items, owner = items[inside], owner[inside]
    ends = np.cumsum(words)
    short = np.flatnonzero((words > 0) & (words < size))
    if len(short):
        whole = [hashes[ends[i] - words[i] : ends[i]] for i in short]
        whole = [mix(window_hashes(h, len(h)) + np.uint64(len(h))) for h in whole]
        items, owner = np.concatenate([items, *whole]), np.r_[owner, short]
        order = np.argsort(owner, kind="stable")
        items, owner = items[order], owner[order]
    bounds = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(texts)))].tolist()
    for a, z in zip(bounds[:-1], bounds[1:], strict=True):
        items[a:z].sort()
    first = np.ones(len(items), bool)
    first[1:] = (items[1:] != items[:-1]) | (owner[1:] != owner[:-1])
    return items[first], np.bincount(owner[first], minlength=len(texts))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two ascending sets have 100 * |a and b| >= 75 * |a or b|."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return len(a) > 0 and 100 * both >= 75 * (len(a) + len(b) - both)


def most_differences(a, largest: int):
    """Differences of a set of ``a`` shingles to a linked one of ``largest`` at most."""
    return (a + np.minimum(4 * a // 3, largest)) // 7


_bands = [(1, 1)]


def bands_of(sizes: np.ndarray) -> np.ndarray:
    """Number of the band that holds each size; a band's last size is 4/3 of its first."""
    most = int(sizes.max(initial=0))
    while _bands[-1][1] < 2 * most or len(_bands) < 3:
        first = _bands[-1][1] + 1
        _bands.append((first, 4 * first // 3))
    return np.searchsorted([last for _, last in _bands], sizes)


@cache
def plan(instance: int) -> tuple[int, int, int, int]:
    """n1, n2, k2 and the largest size of an instance."""
    largest = _bands[instance][1]
    k = 2 * largest // 7
    if k <= WHOLE_UP_TO:
        return 1, k + 3, k, largest
    return int(np.ceil(SPARE * (k // 2 + 1))), 3, 1, largest


@cache
def _choices(n2: int, k2: int) -> np.ndarray:
    """Which cells each choice keeps: a row of 0 and 1 for each."""
    keep = np.ones((0, n2), np.uint64)
    for out in combinations(range(n2), k2):
        row = np.ones((1, n2), np.uint64)
        row[0, list(out)] = 0
        keep = np.vstack([keep, row])
    return keep


@cache
def _places(instance: int, side: int) -> np.ndarray:
    """A number for each part and choice of an instance (n1 x choices)."""
    n1, n2, k2, _ = plan(instance)
    place = np.arange(n1 * len(_choices(n2, k2)), dtype=np.uint64).reshape(n1, -1)
    return mix(place + np.uint64((2 * instance + side + 1) * 0xD1B54A32D192ED03 % 2**64))


def _instance(items: np.ndarray, owner: np.ndarray, sizes: np.ndarray, instance: int, side: int):
    """Signatures of one instance (sets x parts x choices) from ``items``, shingles of sets
    on one side of the domain; which are of something; and whether a set's such ones suffice."""
    n1, n2, k2, largest = plan(instance)
    cells = n1 * n2
    turned = mix(items + np.uint64((2 * instance + side) * 0x9E3779B97F4A7C15 % 2**64))
    cell = ((turned >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)
    cell += owner * cells
    # a cell's hash is the sum of its shingles' numbers, in two halves that doubles hold exactly
    number = turned * np.uint64(0xFF51AFD7ED558CCD)
    halves = (number >> np.uint64(40), (number >> np.uint64(16)) & np.uint64(0xFFFFFF))
    high, low = (np.bincount(cell, half, len(sizes) * cells).astype(np.uint64) for half in halves)
    total = ((high << np.uint64(32)) + low).reshape(len(sizes), n1, n2)
    held = np.zeros(len(sizes) * cells, bool)
    held[cell] = True
    held = held.reshape(total.shape)
    keep = _choices(n2, k2)
    kept = np.empty((*total.shape[:2], len(keep)), np.uint64)
    some = np.empty(kept.shape, bool)
    for choice, row in enumerate(keep):
        at = np.flatnonzero(row)
        kept[..., choice], some[..., choice] = total[..., at[0]], held[..., at[0]]
        for column in at[1:]:
            kept[..., choice] += total[..., column]
            some[..., choice] |= held[..., column]
    thin = (~some.all(axis=2)).sum(axis=1)
    enough = thin < n1 - most_differences(sizes, largest) // (k2 + 1)
    return mix(kept ^ _places(instance, side)), some, enough


def signatures_of(items: np.ndarray, sizes: np.ndarray, frequent=None) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of several sets, which lie one behind the other, and the set of each."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    rare = np.ones(len(items), bool)
    if frequent is not None and len(frequent):
        at = np.minimum(np.searchsorted(frequent, items), len(frequent) - 1)
        rare = frequent[at] != items
    bands = np.where(sizes > 0, bands_of(sizes), -2)
    out, of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]

    def some_of(chosen, instance, side, only):
        """Adds signatures of the chosen sets; tells the sets they don't suffice for."""
        sets = np.flatnonzero(chosen)
        number = np.cumsum(chosen) - 1
        mine = chosen[owner] & only
        found, some, enough = _instance(items[mine], number[owner[mine]], sizes[sets], instance, side)
        if side:
            some |= ~enough[:, None, None]
        out.append(found[some])
        of.append(np.repeat(sets, some.sum(axis=(1, 2))))
        left = np.zeros(len(sizes), bool)
        left[sets[~enough]] = True
        return left

    for instance in np.unique([bands, bands + 1]).tolist():
        if instance < 0:
            continue
        if plan(instance)[2] == 0:  # linked sets are equal, so of one band
            sets = np.flatnonzero(bands == instance)
            start = np.uint64((2 * instance + 1) * 0xD1B54A32D192ED03 % 2**64)
            ends = np.cumsum(sizes)[sets]
            whole = [mix(items[z - sizes[i] : z]).sum(dtype=np.uint64) for i, z in zip(sets, ends, strict=True)]
            out.append(mix(np.array(whole, np.uint64) + start))
            of.append(sets)
            continue
        left = some_of((bands == instance) | (bands == instance - 1), instance, 0, rare)
        if left.any():
            some_of(left, instance, 1, True)
    return np.concatenate(out), np.concatenate(of)


def signatures(items: np.ndarray, frequent: np.ndarray | None = None) -> np.ndarray:
    """All signatures (64 bits) of a set of shingle hashes. ``frequent``: ascending hashes
    of shingles in many sets, the same list for every set."""
    return signatures_of(items, np.array([len(items)]), frequent)[0]
