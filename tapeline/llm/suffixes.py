"""Suffix order by linear grouping."""

from __future__ import annotations


def suffix_order(text: str) -> list[int]:
    """The suffixes of ``text`` in rising order, a proper prefix before what it begins.

    Every suffix has a longest prefix that is a Lyndon word: it ends where the next smaller suffix begins. Suffixes are
    first grouped by it. Groups start with one character and are taken from the highest down; each suffix of the group at
    hand then knows its previous smaller suffix, the nearest one to the left in a lower group, which it reaches by the
    pointers of the suffixes in between. That suffix's Lyndon prefix goes on with the group's, once for each pointer to it:
    those that get pointers leave their group upwards, the more pointers the higher. A group's place is the order's range
    that it fills, so nothing is renamed and nothing sorted again. Then suffixes are emitted from the smallest on: each one
    settles, as the next in its group, every suffix whose next smaller suffix it is.
    """
    n = len(text)
    counts: dict[str, int] = {}
    for c in text:
        counts[c] = counts.get(c, 0) + 1
    start, at = {}, 0
    size = [0] * (n + 1)  # of a group, by the place it starts at
    first = [0] * (n + 1)  # place a group starts at, by the place it ends at
    members: dict[int, list[int]] = {}
    for c in sorted(counts):
        start[c], k = at, counts[c]
        size[at], first[at + k - 1], members[at] = k, at, []
        at += k
    group = [start[c] for c in text]
    for i, g in enumerate(group):
        members[g].append(i)
    previous = [-1] * n

    end = n - 1
    while end >= 0:
        g = first[end]
        end = g - 1
        if size[g] == 1 and len(members[g]) == 1:
            i = members[g][0]
            p = i - 1
            while p >= 0 and group[p] >= g:
                p = previous[p]
            previous[i] = p
            if p < 0 or size[q := group[p]] == 1:
                continue
            pointers = {p: 1}
        else:
            pointers = {}
            for i in sorted([i for i in members[g] if group[i] == g]):
                p = i - 1
                while p >= 0 and group[p] >= g:
                    p = previous[p]
                previous[i] = p
                if p >= 0 and size[group[p]] > 1:
                    pointers[p] = pointers.get(p, 0) + 1
        if len(pointers) == 1:
            ((p, _),) = pointers.items()
            q = group[p]
            k = size[q]
            size[q] = k - 1
            first[q + k - 2] = q
            group[p] = top = q + k - 1
            size[top], first[top], members[top] = 1, top, [p]
            continue
        leave: dict[int, dict[int, list[int]]] = {}
        for p, k in pointers.items():
            leave.setdefault(group[p], {}).setdefault(k, []).append(p)
        for q, by_count in leave.items():
            top = q + size[q]
            for k in sorted(by_count, reverse=True):
                moved = by_count[k]
                size[q] -= len(moved)
                first[top - 1] = top = top - len(moved)
                if top == q:  # none stay
                    size[q] = len(moved)
                else:
                    size[top] = len(moved)
                members[top] = moved
                for p in moved:
                    group[p] = top
            if top != q:
                first[top - 1] = q

    order, free, s = [0] * n, list(range(n)), n
    stop = -1
    for k in range(-1, n):
        if k >= 0:
            s = order[k]
            stop = previous[s]
        p = s - 1
        while p > stop:
            g = group[p]
            order[free[g]] = p
            free[g] += 1
            p = previous[p]
    return order
