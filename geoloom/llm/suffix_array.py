"""Suffix arrays by linear grouping, over many strings at once.

Suffixes are grouped by their Lyndon prefix, the longest Lyndon word that they start with. A scan from right to left finds
these words by merging, and with them each suffix's previous smaller suffix; groups get their ranges in descending order
of their words. The order within groups is then emitted in one pass from the smallest suffix on: whatever precedes an
emitted suffix, and the previous smaller suffixes above it, take the front of their groups. Nothing is renamed and
nothing recurses (after Baier, "Linear-time Suffix Sorting", 2016).
"""

from __future__ import annotations


def lyndon_words(text: bytes) -> tuple[list[int], list[int]]:
    """(length of the longest Lyndon prefix, previous smaller suffix or -1) of each suffix; the end is the smallest.

    A word swallows the one after it for as long as it is the smaller of the two; what it swallows has its start as
    previous smaller suffix.
    """
    n = len(text)
    size = [1] * n
    smaller = [-1] * n
    for i in range(n - 2, -1, -1):
        j = i + 1
        if text[i] > text[j]:
            continue
        while j < n:
            k = j + size[j]
            if text[i:j] >= text[j:k]:
                break
            smaller[j] = i
            j = k
        size[i] = j - i
    return size, smaller


def suffix_array(texts: list[bytes]) -> list[int]:
    """Positions in the concatenation of all texts, each closed by an end that is smaller than any byte, in suffix order.

    Ends come first, in the texts' order; a suffix stops at its text's end.
    """
    up: list[int] = []
    group: list[int] = []
    ends: list[int] = []
    number: dict[bytes, int] = {}
    counts: list[int] = []
    base = 0
    for text in texts:
        size, smaller = lyndon_words(text)
        up += [p + base if p >= 0 else -1 for p in smaller] if base else smaller
        for i, n in enumerate(size):
            word = text[i : i + n]
            g = number.get(word)
            if g is None:
                g = number[word] = len(counts)
                counts.append(0)
            counts[g] += 1
            group.append(g)
        base += len(text)
        up.append(-1)
        group.append(-1)
        ends.append(base)
        base += 1
    # Descending: the group of the largest word takes the last places.
    front = [0] * len(counts)
    at = base
    for word in sorted(number, reverse=True):
        g = number[word]
        at -= counts[g]
        front[g] = at
    order = [-1] * base
    order[: len(ends)] = ends
    for k in range(base):
        i = order[k] - 1
        while i >= 0:
            g = group[i]
            if g < 0:  # an end, or already in its place
                break
            order[front[g]] = i
            front[g] += 1
            group[i] = -1
            i = up[i]
    return order


def repeated_starts(texts: list[bytes], width: int) -> list[list[int]]:
    """For each text, the positions whose next `width` bytes also stand elsewhere: in another text, or in the same one."""
    joined = b"\0".join(texts)
    room = bytearray()
    for text in texts:
        n = max(0, len(text) - width + 1)
        room += b"\1" * n + b"\0" * (len(text) + 1 - n)
    hit = bytearray(len(room))
    before, before_at = None, 0
    for p in suffix_array(texts):
        if room[p]:
            window = joined[p : p + width]
            if window == before:
                hit[p] = hit[before_at] = 1
            before, before_at = window, p
    found, base = [], 0
    for text in texts:
        own = hit[base : base + len(text)]
        found.append([i for i, x in enumerate(own) if x] if 1 in own else [])
        base += len(text) + 1
    return found
