"""Linear-time suffix sorting by grouping suffixes on their Lyndon prefixes."""

from __future__ import annotations

from array import array


def suffix_array(text: list[int]) -> array:
    """Suffix array of ``text``, whose last symbol must be smaller than all others and occur once.

    First, suffixes are grouped by their first symbol. From the highest group down, each group extends its previous
    smaller suffixes: of a suffix, that is the nearest one before it in a lower group. Those followed by the same
    number of suffixes of this group leave their own group together for a new one right above it. In the end a group holds the
    suffixes with one Lyndon prefix.

    Then the order is emitted from the lowest suffix up: when a suffix gets its place, the suffixes whose Lyndon prefix ends
    where it begins take the next free place in their groups; previous-smaller pointers lead to them. Nothing is renamed.
    """
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    order = array("i", order)
    none = array("i", [0]) * n
    place, group = none[:], none[:]  # of a suffix: its place in the order, and the first place of its group
    end = none[:]  # of a group, by its first place: its last place
    start = 0
    for at, i in enumerate(order):
        if text[i] != text[order[start]]:
            start = at
        place[i] = at
        group[i] = start
        end[start] = at
    before = array("i", [-1]) * n  # previous smaller suffix
    at = n - 1
    while at >= 0:
        start = group[order[at]]
        if start == at:  # most groups hold one suffix
            i = order[at]
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = before[p]
            before[i] = p
            if p >= 0:
                g = group[p]
                last = end[g]
                if last != g:  # it leaves for a group of its own at the end
                    q, was = order[last], place[p]
                    order[was], place[q] = q, was
                    order[last], place[p] = p, last
                    end[g] = last - 1
                    group[p] = end[last] = last
            at -= 1
            continue
        times: dict[int, int] = {}
        for i in sorted(order[start:at + 1]):
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = before[p]
            before[i] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        by_times: dict[int, list[int]] = {}
        for p, k in times.items():
            by_times.setdefault(k, []).append(p)
        for k in sorted(by_times, reverse=True):  # more repeats are larger: they move first, to the very end
            moved: dict[int, int] = {}
            for p in by_times[k]:
                g = group[p]
                last = end[g] - moved.get(g, 0)
                moved[g] = moved.get(g, 0) + 1
                q, was = order[last], place[p]
                order[was], place[q] = q, was
                order[last], place[p] = p, last
            for g, m in moved.items():
                last = end[g]
                first = last - m + 1
                if first != g:
                    end[g] = first - 1
                    end[first] = last
                    for x in range(first, last + 1):
                        group[order[x]] = first
        at = start - 1
    # Emit: free[g] is the next free place of the group that starts at g.
    free = array("i", range(n))
    done = bytearray(n)
    out = none[:]
    out[0] = n - 1
    done[n - 1] = 1
    for at in range(n):
        j = out[at] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            done[j] = 1
            j = before[j]
    return out
