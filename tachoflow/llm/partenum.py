"""PartEnum signatures of sets for an exact Jaccard join.

Sizes are cut into bands so that two sets with enough overlap lie in the same band or in
neighbouring ones. A set signs for its own band and for the next, so such a pair meets in
one band of size r at most, where their symmetric difference holds no more than k features.
There the feature domain is dealt to more than k parts by hash, so at least one part is
untouched by the difference and gives both sets the same signature (the enumeration of
single first-level parts, the choice of the scheme with fewest signatures per set).

Parts in which a set has no feature agree trivially and are left out: with n parts at least
n - k agree, so a set with fewer than n - k empty parts keeps an agreeing part that is not
empty. Only a set with more of them signs its empty parts too.
"""

from __future__ import annotations

import numpy as np

from tachoflow.llm.words import U64, mix

#: Largest set size for which the band table is laid out.
LARGEST = 1 << 40


class Bands:
    """Size bands for the condition ``100 * intersection >= percent * union``."""

    def __init__(self, percent: int) -> None:
        if not 0 < percent <= 100:
            raise ValueError("percent must lie in 1..100")
        upper = [1]
        while upper[-1] < LARGEST:
            upper.append(max(upper[-1] + 1, upper[-1] * 100 // percent))
        self.percent = percent
        self.upper = np.array(upper, np.int64)
        # |A| + |B| - 2 |A and B| <= (|A| + |B|) (100 - percent) / (100 + percent)
        self.most_apart = 2 * self.upper * (100 - percent) // (100 + percent)
        parts = self.most_apart + 1
        # A few parts more than needed, against empty ones.
        self.parts = np.where(self.most_apart > 0, parts + parts // 32 + 1, parts)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.upper, sizes, "left")


def set_ids(features: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """A 64-bit id of each set, equal for equal sets; the empty set has id 0."""
    sizes = np.bincount(owner, minlength=count)
    out = np.zeros(count, U64)
    full = np.flatnonzero(sizes)
    if len(full):
        begin = (np.cumsum(sizes) - sizes)[full]
        out[full] = mix(np.add.reduceat(mix(features ^ U64(0x5851F42D4C957F2D)), begin) ^ sizes[full].astype(U64))
    return out


def signatures(features: np.ndarray, owner: np.ndarray, count: int, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Signature and owner (0..count-1) for sets given as distinct features ordered by owner."""
    sizes = np.bincount(owner, minlength=count)
    band = bands.of(sizes)
    signs, owners = [], []
    value = mix(features)
    low, high = (value & U64(0xFFFFFFFF)).astype(float), (value >> U64(32)).astype(float)
    for step in (0, 1):
        own_band = band + step
        parts = np.where(sizes > 0, bands.parts[own_band], 0)
        base = np.cumsum(parts) - parts
        total = int(parts.sum())
        if not total:
            continue
        # A part's features are summed in two exact halves of 32 bits.
        at = base[owner] + (features % parts[owner].astype(U64)).astype(np.int64)
        sums = [np.bincount(at, half, total).astype(np.int64).astype(U64) for half in (low, high)]
        filled = np.bincount(at, minlength=total) > 0
        who = np.repeat(np.arange(count), parts)
        place = np.arange(total) - base[who]
        empty = parts - np.bincount(who[filled], minlength=count)
        keep = filled | (empty >= parts - bands.most_apart[own_band])[who]
        where = (own_band[who].astype(U64) << U64(40)) ^ place.astype(U64)
        signs.append(mix(sums[0] + mix(sums[1] + mix(where)))[keep])
        owners.append(who[keep])
    if not signs:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    return np.concatenate(signs), np.concatenate(owners)
