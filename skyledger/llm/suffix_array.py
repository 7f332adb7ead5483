"""Linear suffix sorting by grouping (the library part of ``suffix_dedup``).

Two phases, after the published linear-time grouping construction:

1. Suffixes start in groups by their first symbol.  Groups are processed in
   descending order.  For each suffix of the current group, its *previous smaller pointer*
   leads to the nearest suffix to the left that is in a lower group; that
   suffix's known prefix is extended by the current group's.  Suffixes so extended leave their group for
   a new one right above it, higher the more often they were extended.  In the end a
   group holds the suffixes that share one Lyndon prefix, and groups are in order.
2. Ranks are filled in ascending order: when a suffix gets its rank, the suffixes whose
   Lyndon prefix ends where it starts (its left neighbour and that one's
   chain of previous smaller pointers) take the next free places of their
   groups.  Nothing is renamed and nothing recurses.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes of ``text`` in order.  Its last symbol must be smaller than all others (0), and occur once."""
    n = len(text)
    # groups are nodes of a list in order: below[g] is the next lower one
    first: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        first.setdefault(c, []).append(i)
    members = [first[c] for c in sorted(first)]
    of = [0] * n
    for g, m in enumerate(members):
        for i in m:
            of[i] = g
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members))) + [-1]
    jump = [-1] * n      # for suffixes of processed groups: somewhere to the left, towards a lower group
    done = bytearray(n)
    smaller = [-1] * n   # previous smaller pointer
    order: list[list[int]] = []  # final groups, descending
    g = len(members) - 1
    while g >= 0:
        group = members[g]
        group = [i for i in group if of[i] == g]
        if group:
            order.append(group)
            for i in group:
                done[i] = 1
                jump[i] = i - 1
            count: dict[int, int] = {}
            for i in group:
                j = i - 1
                while j >= 0 and done[j]:
                    k = jump[j]
                    if k >= 0 and done[k]:
                        jump[j] = jump[k]  # halve the way for those who come later
                    j = k
                smaller[i] = jump[i] = j
                if j >= 0:
                    count[j] = count.get(j, 0) + 1
            if len(count) == 1:
                (j, _), = count.items()
                fresh = {(of[j], 1): [j]}
            else:
                fresh = {}
                for j, c in count.items():
                    key = (of[j], c)
                    if key in fresh:
                        fresh[key].append(j)
                    else:
                        fresh[key] = [j]
            # the most often extended go first, so fewer extensions end up below them
            for low, _ in sorted(fresh, reverse=True) if len(fresh) > 1 else fresh:
                new, up = len(members), above[low]
                moved = fresh[low, _]
                members.append(moved)
                for j in moved:
                    of[j] = new
                below.append(low)
                above.append(up)
                above[low] = new
                below[up] = new  # up is at most the current group, so it exists
        g = below[g]
    # places: groups ascending
    at = 0
    free = [0] * len(members)
    for group in reversed(order):
        free[of[group[0]]] = at
        at += len(group)
    ranks = [-1] * n
    placed = bytearray(n)
    ranks[0] = n - 1
    placed[n - 1] = 1
    free[of[n - 1]] += 1
    for r in range(n):
        j = ranks[r] - 1
        while j >= 0 and not placed[j]:
            placed[j] = 1
            g = of[j]
            ranks[free[g]] = j
            free[g] += 1
            j = smaller[j]
    return ranks
