"""Re-Pair grammars and the runs that cross their rules, over many texts at a time.

Texts are number sequences put one after another. A task handles a block of them with arrays; no text meets another one.

* Stretches. A pair of neighbours that occurs once in its text is never replaced, and no run of three periods holds it: within the
  run it recurs a period before or after. So texts are cut there, and stretches shorter than the least run are left out.
* Rules. In rounds, each text's most frequent pairs (without overlap, twice or more) become symbols. Of pairs of one count that
  meet in some place only one is taken in a round, so a round is a series of steps of plain Re-Pair, all with ties broken
  somehow. A pair whose count has fallen to one never recurs, so the sequence is cut there and what is left alone is final.
* Nodes. Rules, and a balanced tree over what is left of each stretch, are nodes: a place in the text where the node occurs first,
  where its two halves meet, and where it ends. Every run has one node that holds it whole and whose halves it crosses.
* Runs across a node are computed once: a run that crosses it and is long enough repeats, at the distance of its period, the
  ``GRAM`` words before or after the place where the halves meet. Occurrences of these words within the node give the periods to
  try, and common extensions by names of 2^k words give the stretch of each.
* Runs are then moved to all places where their node is derived. What an occurrence cuts off a longer run lies within that
  run, which its own node gives whole: so of intervals with one period those within another go, and maximal ones are left.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Nodes(NamedTuple):
    """``begin``, ``middle``, ``end``: places of the first occurrence. ``symbol``: of a rule, or -1."""

    begin: np.ndarray
    middle: np.ndarray
    end: np.ndarray
    symbol: np.ndarray


class Grammar(NamedTuple):
    """``left``, ``right``: symbols of each rule, by symbol - ``base`` (smaller numbers are words). ``size``: words of each rule.

    ``first``: place of its first occurrence. ``at``, ``symbol``: the final sequence. ``stretch``: its stretches, as numbers.
    """

    base: int
    left: np.ndarray
    right: np.ndarray
    size: np.ndarray
    first: np.ndarray
    at: np.ndarray
    symbol: np.ndarray
    stretch: np.ndarray

    def sizes(self, symbol: np.ndarray) -> np.ndarray:
        return np.where(symbol < self.base, 1, self.size[np.maximum(symbol - self.base, 0)] if len(self.size) else 1)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each key among the distinct ones in their order, and how often each of these occurs."""
    order = np.argsort(keys, kind="stable")
    new = np.empty(len(keys), bool)
    new[:1] = True
    ordered = keys[order]
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, np.diff(np.append(np.flatnonzero(new), len(keys)))


def _even(same: np.ndarray) -> np.ndarray:
    """Of the pairs of two equal symbols (``same``), every second one in a row of them counts: they overlap."""
    places = np.arange(len(same))
    since = np.maximum.accumulate(np.where(same, -1, places))
    return ~same | ((places - since) % 2 == 1)


def stretches(words: np.ndarray, text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (rising) of the stretches of ``least`` words or more in which every pair recurs in its text, and their numbers."""
    if len(words) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    many = int(words.max()) + 1
    joined = text[1:] == text[:-1]
    at = np.flatnonzero(joined)
    one = text[at] * many + words[at]
    number, _ = _counted(one)  # words told apart by text, in few numbers
    pair = number * many + words[at + 1]
    number, counts = _counted(pair)
    alive = np.zeros(len(words), bool)  # the pair of a place and the next one
    alive[at] = counts[number] > 1
    begins = np.ones(len(words), bool)
    begins[1:] = ~alive[:-1]
    which = np.cumsum(begins) - 1
    long = np.bincount(which) >= least
    chosen = np.flatnonzero(long[which])
    return chosen, which[chosen]


def grammar(words: np.ndarray, text: np.ndarray, at: np.ndarray, stretch: np.ndarray) -> Grammar:
    """Re-Pair of the given stretches; ``words`` and ``text`` are those of all places."""
    _, symbol = np.unique(text[at] * (int(words.max(initial=0)) + 1) + words[at], return_inverse=True)
    symbol = symbol.reshape(-1).astype(np.int64)  # words of one text share no symbol with another's
    base = many = int(symbol.max(initial=-1)) + 1
    owner, place, part = text[at], at, stretch
    size = np.ones(len(at), np.int64)
    left, right, sizes, first = [], [], [], []
    done_at, done_symbol, done_part = [], [], []
    step = 0
    while len(place):
        step += 1
        linked = np.empty(len(place), bool)  # with the next symbol
        linked[-1] = False
        linked[:-1] = (part[:-1] == part[1:]) & (place[:-1] + size[:-1] == place[1:])
        pairs = np.flatnonzero(linked)
        a, b = symbol[pairs], symbol[pairs + 1]
        number, _ = _counted(a * many + b)
        same = np.zeros(len(place), bool)
        same[pairs] = a == b
        counts_once = _even(same)[pairs]
        times = np.bincount(number, counts_once)
        count = np.zeros(len(place), np.int64)
        count[pairs] = times[number]
        # The most frequent pairs of each text.
        edges = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        most = np.repeat(np.maximum.reduceat(count, edges), np.diff(np.append(edges, len(place))))
        wanted = np.zeros(len(place), bool)
        wanted[pairs] = counts_once
        wanted &= (count == most) & (count > 1)
        # Of those that share a symbol somewhere, one goes ahead: by numbers that are shuffled anew in each round.
        factor = np.uint64((0x9E3779B97F4A7C15 + 2 * step * 0x5851F42D4C957F2D) & 0xFFFFFFFFFFFFFFFF)  # odd: no two ranks are equal
        rank = np.full(len(place), np.iinfo(np.int64).min)
        rank[pairs] = (np.arange(len(times), dtype=np.uint64) * factor).view(np.int64)[number]
        rank[~wanted] = np.iinfo(np.int64).min
        beaten = np.zeros(len(place), bool)
        beaten[:-1] |= rank[1:] > rank[:-1]
        beaten[1:] |= rank[:-1] > rank[1:]
        lost = np.zeros(len(times), bool)
        held = wanted[pairs]
        lost[number[held & beaten[pairs]]] = True
        taken = pairs[held & ~lost[number]]
        if len(taken):
            new, _ = _counted(symbol[taken] * many + symbol[taken + 1])
            kinds = int(new.max()) + 1
            example = np.full(kinds, len(place), np.int64)
            np.minimum.at(example, new, taken)
            left.append(symbol[example])
            right.append(symbol[example + 1])
            sizes.append(size[example] + size[example + 1])
            first.append(place[example])
            symbol[taken] = many + new
            size[taken] += size[taken + 1]
            many += kinds
        stay = np.ones(len(place), bool)
        stay[taken + 1] = False
        # Cut where a pair occurs once; what is joined with nothing is final.
        on = linked & (count > 1)
        on[taken] = on[taken + 1]  # the new symbol's next one
        before = np.zeros(len(place), bool)
        before[1:] = on[:-1]
        before[taken[taken + 2 < len(place)] + 2] = on[taken[taken + 2 < len(place)]]
        final = stay & ~on & ~before
        done_at.append(place[final])
        done_symbol.append(symbol[final])
        done_part.append(part[final])
        # Parts keep their numbers apart by place: a cut starts a new one.
        keep = stay & ~final
        cut = ~on[keep]
        kept_part = part[keep]
        symbol, size, owner, place = symbol[keep], size[keep], owner[keep], place[keep]
        part = np.cumsum(np.append(False, cut[:-1])) if len(cut) else kept_part
    whole_at = np.concatenate(done_at) if done_at else np.empty(0, np.int64)
    whole_symbol = np.concatenate(done_symbol) if done_symbol else np.empty(0, np.int64)
    order = np.argsort(whole_at)
    whole_at, whole_symbol = whole_at[order], whole_symbol[order]
    join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
    return Grammar(base, join(left), join(right), join(sizes), join(first), whole_at, whole_symbol,
                   stretch[np.searchsorted(at, whole_at)])


def nodes(g: Grammar, least: int) -> Nodes:
    """Rules and the nodes of the trees over the final sequences, of ``least`` words or more."""
    where = np.flatnonzero(g.size >= least)
    begin = [g.first[where]]
    middle = [g.first[where] + g.sizes(g.left[where])]
    end = [g.first[where] + g.size[where]]
    symbol = [g.base + where]
    at, to, part = g.at, g.at + g.sizes(g.symbol), g.stretch
    while len(at):
        edges = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        within = np.arange(len(at)) - np.repeat(edges, np.diff(np.append(edges, len(at))))
        firsts = np.flatnonzero(within % 2 == 0)
        paired = np.zeros(len(firsts), bool)
        inside = firsts + 1 < len(at)
        paired[inside] = part[firsts[inside] + 1] == part[firsts[inside]]
        if not paired.any():
            break
        two = firsts[paired]
        long = to[two + 1] - at[two] >= least
        begin.append(at[two][long])
        middle.append(to[two][long])
        end.append(to[two + 1][long])
        symbol.append(np.full(int(long.sum()), -1))
        ends = to[firsts]
        ends[paired] = to[two + 1]
        at, to, part = at[firsts], ends, part[firsts]
    return Nodes(*map(np.concatenate, (begin, middle, end, symbol)))


class Names:
    """Names of the 2^k words from each place of the stretches; places whose words reach beyond a stretch have none."""

    def __init__(self, words: np.ndarray, at: np.ndarray, stretch: np.ndarray) -> None:
        self.edge = np.searchsorted(stretch, stretch, side="right")  # of each place's stretch, in the order of ``at``
        self.levels = [np.unique(words[at], return_inverse=True)[1].reshape(-1).astype(np.int64)]

    def level(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            half, step = self.levels[-1], 1 << (len(self.levels) - 1)
            name = np.full(len(half), -1, np.int64)
            whole = np.flatnonzero(np.arange(len(half)) + 2 * step <= self.edge)
            name[whole] = _counted(half[whole] * (int(half.max(initial=0)) + 2) + half[whole + step])[0]
            self.levels.append(name)
        return self.levels[k]

    def common(self, i: np.ndarray, j: np.ndarray, room: np.ndarray, back: bool) -> np.ndarray:
        """Words in common from places i < j on (or, ``back``, before them), ``room`` at most."""
        length = np.zeros(len(i), np.int64)
        for k in reversed(range(int(room.max(initial=0)).bit_length())):
            names, step = self.level(k), 1 << k
            todo = np.flatnonzero(length + step <= room)
            shift = -length[todo] - step if back else length[todo]
            x, y = names[i[todo] + shift], names[j[todo] + shift]
            length[todo[(x == y) & (x >= 0)]] += step
        return length


def crossing(n: Nodes, names: Names, least: int, times: int) -> tuple[np.ndarray, ...]:
    """(node, start, end, period) of the runs across each node; nodes and runs count places in the order of the stretches.

    A run has ``least`` words or more and ``times`` periods or more. The words that repeat at the distance of its period number
    least - least / times or more, so half of them stand together before or after the middle, or a period away from it.
    """
    level = max((least - least // times) // 2, 1).bit_length() - 1
    gram = 1 << level
    named = names.level(level)
    order = np.lexsort((np.arange(len(named)), named))
    ordered = named[order] * (len(named) + 1) + order  # (name, place) in one number
    found = []
    for shift in (0, -gram):
        anchor = n.middle + shift
        use = np.flatnonzero((anchor >= n.begin) & (anchor + gram <= n.end))
        a = anchor[use]
        base = named[a] * (len(named) + 1)
        lo = np.searchsorted(ordered, base + n.begin[use])
        hi = np.searchsorted(ordered, base + n.end[use] - gram, side="right")
        many = hi - lo
        node = np.repeat(use, many)
        other = order[np.repeat(lo - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(int(many.sum()))]
        a = np.repeat(a, many)
        q = np.abs(other - a)
        ok = (q > 0) & (times * q <= n.end[node] - n.begin[node])
        found.append((node[ok], np.minimum(a, other)[ok], q[ok]))
    node, i, q = (np.concatenate(x) for x in zip(*found))
    # One look per node, period and place is enough.
    order = np.lexsort((i, q, node))
    node, i, q = node[order], i[order], q[order]
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (i[1:] != i[:-1]) | (q[1:] != q[:-1])
    node, i, q = node[new], i[new], q[new]
    ahead = names.common(i, i + q, n.end[node] - i - q, back=False)
    behind = names.common(i, i + q, i - n.begin[node], back=True)
    start, end = i - behind, i + q + ahead
    ok = (end - start >= np.maximum(least, times * q)) & (start < n.middle[node]) & (end > n.middle[node])
    node, start, end, q = node[ok], start[ok], end[ok], q[ok]
    order = np.lexsort((q, end, start, node))  # of one stretch in one node the smallest period
    node, start, end, q = node[order], start[order], end[order], q[order]
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return node[new], start[new], end[new], q[new]


def derived(g: Grammar, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbol, place) of every place where one of the rules ``symbols`` is derived."""
    wanted = np.zeros(len(g.left) + g.base, bool)
    wanted[symbols] = True
    leads = wanted.copy()  # to a wanted symbol
    for rule in range(len(g.left)):  # children come before their parents
        leads[g.base + rule] |= leads[g.left[rule]] or leads[g.right[rule]]
    symbol, at = g.symbol, g.at
    out_symbol, out_at = [], []
    while len(symbol):
        on = leads[symbol]
        symbol, at = symbol[on], at[on]
        hit = wanted[symbol]
        out_symbol.append(symbol[hit])
        out_at.append(at[hit])
        rule = symbol[symbol >= g.base] - g.base
        at = at[symbol >= g.base]
        symbol = np.concatenate((g.left[rule], g.right[rule]))
        at = np.concatenate((at, at + g.sizes(g.left[rule])))
    empty = [np.empty(0, np.int64)]
    return np.concatenate(out_symbol or empty), np.concatenate(out_at or empty)


def maximal(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, end, period) of the intervals that lie within no other of their period, in order."""
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    group = np.cumsum(np.append(True, period[1:] != period[:-1])) if len(period) else period
    reach = np.maximum.accumulate(end + group * (int(end.max(initial=0)) + 1))
    keep = np.ones(len(start), bool)
    keep[1:] = (reach[1:] > reach[:-1]) | (group[1:] != group[:-1])
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def runs(words: np.ndarray, text: np.ndarray, least: int = 24, times: int = 3) -> tuple[np.ndarray, ...]:
    """(start, end, period) of the maximal runs of all texts, in order: stretches of ``least`` words and ``times`` smallest periods or more.

    ``words``: numbers, from 0, of the words of all texts one after another. ``text``: the number of each word's text, rising from 0.
    Fewer than three periods are refused.
    """
    if times < 3:
        raise ValueError("a run needs three periods or more")
    at, stretch = stretches(words, text, least)
    if not len(at):
        return (np.empty(0, np.int64),) * 3
    g = grammar(words, text, at, stretch)
    n = nodes(g, least)
    place = np.zeros(len(words) + 1, np.int64)  # in the order of the stretches
    place[at] = np.arange(len(at))
    there = Nodes(place[n.begin], place[n.begin] + n.middle - n.begin, place[n.begin] + n.end - n.begin, n.symbol)
    node, start, end, period = crossing(there, Names(words, at, stretch), least, times)
    start, end = start - there.begin[node], end - there.begin[node]  # within the node
    of_rule = n.symbol[node] >= 0
    symbol, where = derived(g, np.unique(n.symbol[node[of_rule]]))
    order = np.argsort(symbol, kind="stable")
    symbol, where = symbol[order], where[order]
    mine = n.symbol[node[of_rule]]
    lo, hi = np.searchsorted(symbol, mine), np.searchsorted(symbol, mine, side="right")
    many = hi - lo
    moved = where[np.repeat(lo - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(int(many.sum()))] if len(mine) else where[:0]
    top = ~of_rule
    return maximal(
        np.concatenate((n.begin[node[top]] + start[top], moved + np.repeat(start[of_rule], many))),
        np.concatenate((n.begin[node[top]] + end[top], moved + np.repeat(end[of_rule], many))),
        np.concatenate((period[top], np.repeat(period[of_rule], many))))
