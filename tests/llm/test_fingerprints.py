"""Feature choice, chained filters and likeness against plain Python, byte by byte."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from panelloom.llm import bloom_digest as digest

MASK = 2**64 - 1


def level(window):
    terms = (int(np.round(n * np.log2(n) * 65536)) for n in Counter(window).values())
    return (digest.FULL - sum(terms)) >> digest.LEVEL_SHIFT


def windows(text):
    raw = text.encode()
    raw = raw.ljust(digest.WINDOW, b"\0") if raw else raw
    return [raw[i : i + digest.WINDOW] for i in range(len(raw) - digest.WINDOW + 1)] if raw else []


def mix(x):
    x ^= x >> 33
    x = x * 0xFF51AFD7ED558CCD & MASK
    x ^= x >> 33
    x = x * 0xC4CEB9FE1A85EC53 & MASK
    return x ^ x >> 33


def name(window):
    found = 0
    for i in range(0, digest.WINDOW, 8):
        part = int.from_bytes(window[i : i + 8], "little")
        found = mix(((found ^ part) + i // 8 + 1) & MASK)
    return found


def ranks_by_hand(texts):
    seen = Counter(level(w) for text in texts for w in windows(text))
    order = sorted(range(digest.LEVELS), key=lambda at: (seen[at], at))
    return {at: rank for rank, at in enumerate(order)}


def features(text, rank):
    found = windows(text)
    place = [(rank[level(w)], i) for i, w in enumerate(found)]
    score = Counter(
        min(place[i : i + digest.NEIGHBOURS])[1]
        for i in range(len(found) - digest.NEIGHBOURS + 1)
    )
    chosen = sorted(i for i, n in score.items() if n >= digest.MIN_SCORE)
    if not chosen and found:
        chosen = [min(place)[1]]
    return list(dict.fromkeys(name(found[i]) for i in chosen))


def chain(text, rank):
    names = features(text, rank)
    filters = []
    for low in range(0, len(names), digest.PER_FILTER):
        filters.append({
            h >> 11 * i & digest.BITS - 1
            for h in names[low : low + digest.PER_FILTER] for i in range(digest.HASHES)
        })
    return filters


def likeness_by_hand(one, two):
    if not one or not two:
        return float(len(one) == len(two))

    def best(few, many):
        score = weight = 0.0
        for own in few:
            tries = []
            for other in many:
                chance = len(own) * len(other) / digest.BITS
                most = min(len(own), len(other))
                tries.append(min(1.0, max(0.0, (len(own & other) - chance) / max(most - chance, 1e-9))))
            score += max(tries) * len(own)
            weight += len(own)
        return min(1.0, score / weight)

    if len(one) > len(two):
        one, two = two, one
    if len(one) == len(two):
        return (best(one, two) + best(two, one)) / 2
    return best(one, two)


def texts_of(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9))) for _ in range(90)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    long = prose(900)
    return ["", "x", "short text", "é漢" * 50, "a" * 400, prose(60), prose(200), long,
            long[:3000] + prose(300), long, "0" * 63, "0" * 64, prose(12) * 9]


@pytest.mark.parametrize("seed", [1, 2])
def test_fingerprints_by_hand(seed):
    texts = texts_of(seed)
    rank = ranks_by_hand(texts)
    found = digest.ranks(digest.level_counts(texts))
    assert found.tolist() == [rank[at] for at in range(digest.LEVELS)]
    prints = digest.fingerprints(texts, found)
    chains = [chain(text, rank) for text in texts]
    for text, own, plain in zip(texts, prints, chains, strict=True):
        bits = [set(np.flatnonzero(row).tolist()) for row in np.unpackbits(own, axis=1)] if len(own) else []
        assert bits == plain, text[:40]
    assert max(map(len, chains)) >= 1
    for i, one in enumerate(prints):
        for j, two in enumerate(prints):
            expected = 1.0 if chains[i] == chains[j] else likeness_by_hand(chains[i], chains[j])
            assert math.isclose(digest.likeness(one, two), expected, abs_tol=1e-5)


def test_long_texts_chain_filters():
    rng = random.Random(4)
    text = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=6)) for _ in range(6_000))
    rank = digest.ranks(digest.level_counts([text]))
    owners, names = digest._features([text], rank)
    (own,) = digest.fingerprints([text], rank)
    assert len(own) == -(-len(names) // digest.PER_FILTER) > 1
    half = text[: len(text) // 2]
    (part,) = digest.fingerprints([half], rank)
    assert digest.likeness(own, part) > 0.5 > digest.likeness(own, digest.fingerprints([text[::-1]], rank)[0])
