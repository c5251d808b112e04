"""Weighted fuzzy ratio (the public WRatio definition) against a fixed list of labels, as one SQL expression.

Similarities are Indel based: ``100 * 2 * LCS / (len1 + len2)``. The LCS is a
running bit row: the shorter string (a label, or a text shorter than one) is a
bit per character, each character of the other string is the mask of the places
where the first one has it, and ``aggregate`` carries the row over the masks.

A text is compared with all labels in one array, so nothing is exploded or
shuffled. Every label first gets the scores that need no window scan, which bound
its final score from below, and the common characters, which bound it from above.
Windows (partial ratios) are scanned only for labels that can still be the best
one. Ties keep the earlier label.

The functions return SQL text, as a Column of this depth takes seconds to build
call by call. ``_let`` names a value that an expression uses more than once, so
that it is computed once.
"""

from __future__ import annotations

import json
from collections import Counter

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_NEEDLE = 62  # places of a bit row that additions leave in a long
LABEL = ("label string, place int, n int, full bigint, raw map<string,bigint>, sorted map<string,bigint>, in_order string, "
         "words array<string>, counts map<string,int>")


def _let(name: str, value: str, use: str) -> str:
    return f"transform(array({value}), {name} -> {use})[0]"


def _chars(text: str) -> str:
    return f"filter(split({text}, ''), c -> c <> '')"


def _joined(words: str) -> str:
    return f"array_join(array_sort({words}), ' ')"


def _full(n: str) -> str:
    return f"(shiftleft(1L, {n}) - 1)"


def _lcs(masks: str, n: str, full: str) -> str:
    """LCS length of a string of ``n`` characters, all set in ``full``, with the one that gave ``masks``."""
    return f"({n} - bit_count(aggregate({masks}, {full}, (v, m) -> ((v + (v & m)) | (v & ~m)) & {full})))"


def _masks(needle: str, other: str) -> str:
    """Masks of the characters of ``other`` by their places in ``needle`` (arrays of characters)."""
    bits = f"transform({needle}, (c, i) -> struct(c AS c, shiftleft(1L, i) AS bit))"
    return _let("places", bits, f"transform({other}, c -> aggregate(places, 0L, (m, b) -> CASE WHEN b.c = c THEN m | b.bit ELSE m END))")


def _windows(needle: str, other: str) -> str:
    """Best ratio of ``needle`` with a window of ``other`` (arrays of characters, ``other`` no shorter):
    every window of its length, and the shorter ones at both ends."""
    ends = "sequence(1, greatest(w.n - 1, 1))"
    spans = (f"concat(transform(sequence(1, w.size - w.n + 1), i -> struct(i AS at, w.n AS k)), transform({ends}, k -> struct(1 AS at, k AS k)), "
             f"transform({ends}, k -> struct(w.size - k + 1 AS at, k AS k)))")
    scan = f"array_max(transform({spans}, s -> 200D * {_lcs('slice(w.masks, s.at, s.k)', 'w.n', 'w.full')} / (w.n + s.k)))"
    return _let("w", f"struct({_masks(needle, other)} AS masks, size({needle}) AS n, size({other}) AS size, {_full(f'size({needle})')} AS full)", scan)


def _partial(a: str, b: str) -> str:
    """Partial ratio of two texts; equally long ones are scanned both ways."""
    scan = (f"greatest(CASE WHEN size(u.x) <= size(u.y) THEN {_windows('u.x', 'u.y')} ELSE 0D END, "
            f"CASE WHEN size(u.y) <= size(u.x) THEN {_windows('u.y', 'u.x')} ELSE 0D END)")
    return _let("u", f"struct({_chars(a)} AS x, {_chars(b)} AS y)", scan)


def _label(text: str, place: int) -> dict:
    """What comparisons need to know of a label."""
    def masks(s: str) -> dict[str, int]:
        found: dict[str, int] = {}
        for i, c in enumerate(s):
            found[c] = found.get(c, 0) | 1 << i
        return found

    words = text.split()
    in_order = " ".join(sorted(words))
    return {"label": text, "place": place, "n": len(text), "full": (1 << len(text)) - 1, "raw": masks(text), "sorted": masks(in_order),
            "in_order": in_order, "words": words, "counts": Counter(text)}


def _bounded() -> str:
    """A pair of text ``t`` and label ``p`` with the most it can score: no window
    and no pair of word sets beats its common characters."""
    common = "aggregate(map_entries(p.counts), 0, (s, c) -> s + least(c.value, t.held[c.key]))"
    basis = _let("b", f"struct({common} AS common, {_joined('array_intersect(t.words, p.words)')} AS shared, least(t.size, p.n) AS small, t.size + p.n AS total, "
                      "greatest(t.size, p.n) / least(t.size, p.n) AS lens)",
                 "struct(b.common AS common, b.shared AS shared, b.total AS total, b.lens < 1.5 AS near, "
                 "CASE WHEN b.lens < 1.5 THEN 1D WHEN b.lens < 8 THEN 0.9D ELSE 0.6D END AS scale, 200D * b.common / (b.small + b.common) AS window)")
    most = ("greatest(200D * a.common / a.total, CASE WHEN a.near THEN 100D WHEN a.shared <> '' THEN a.scale * greatest(a.window, 95D) ELSE a.scale * a.window END)")
    return _let("a", basis, f"struct(p AS label, a.near AS near, a.scale AS scale, a.shared AS shared, {most} AS most)")


def _words_ratio() -> str:
    """Token set ratio of pair ``q``: its shared, own-text and own-label words."""
    lcs = f"CASE WHEN e.a > 0 AND e.b > 0 THEN {_lcs(_masks(_chars('q.theirs'), _chars('q.own')), 'e.b', 'e.full')} ELSE 0 END"
    total = "(2 * (e.s + CASE WHEN e.s > 0 THEN 1 ELSE 0 END) + e.a + e.b)"
    differing = f"CASE WHEN {total} > 0 THEN 100D - 100D * (e.a + e.b - 2 * ({lcs})) / {total} ELSE 100D END"
    lone = "100D - 100D * (1 + e.{0}) / (2 * e.s + 1 + e.{0})"
    return _let("e", f"struct(length(q.own) AS a, length(q.theirs) AS b, length(q.shared) AS s, {_full('length(q.theirs)')} AS full)",
                f"CASE WHEN e.s = 0 THEN {differing} WHEN e.a = 0 OR e.b = 0 THEN 100D "
                f"ELSE greatest({differing}, {lone.format('a')}, {lone.format('b')}) END")


def _sure() -> str:
    """Pair ``p`` with what it scores without windows: all of a near pair, the least of another."""
    def ratio(chars: str, masks: str) -> str:
        found = f"transform({chars}, c -> coalesce(try_element_at({masks}, c), 0L))"
        return f"200D * {_lcs(found, 'p.label.n', 'p.label.full')} / (size({chars}) + p.label.n)"

    own, theirs = (_joined(f"array_except({x}, {y})") for x, y in (("t.words", "p.label.words"), ("p.label.words", "t.words")))
    words = (f"CASE WHEN p.near THEN 0.95D * greatest({ratio('t.in_order', 'p.label.sorted')}, {_words_ratio()}) "
             "WHEN p.shared <> '' THEN 95D * p.scale ELSE 0D END")
    return _let("q", f"struct({own} AS own, {theirs} AS theirs, p.shared AS shared)",
                f"struct(p AS p, q.own AS own, q.theirs AS theirs, greatest({ratio('t.chars', 'p.label.raw')}, {words}) AS sure)")


def _final() -> str:
    """Score of pair ``x``, with its windows if they may still reach ``bar``."""
    differ = "length(x.own) < size(t.in_order) OR length(x.theirs) < length(x.p.label.in_order)"
    words = (f"greatest({_partial(_joined('t.words'), 'x.p.label.in_order')}, "
             f"CASE WHEN {differ} THEN {_partial('x.own', 'x.theirs')} ELSE 0D END)")
    scan = f"greatest({_partial('t.text', 'x.p.label.label')}, CASE WHEN x.p.shared = '' THEN 0.95D * {words} ELSE 0D END)"
    score = f"CASE WHEN x.p.near OR x.p.most < bar OR x.p.most <= x.sure THEN x.sure ELSE greatest(x.sure, x.p.scale * {scan}) END"
    return f"struct({score} AS score, -x.p.label.place AS place, x.p.label.label AS label)"


def best_label(text: str, labels: list[str], floor: float = 0.0) -> Column:
    """Struct (``label``, ``score``) of the best label for the column ``text``. Labels that
    can't reach ``floor`` are left out; null if none is left, and for a null text."""
    if max(map(len, labels)) > MAX_NEEDLE:
        raise ValueError(f"a label is longer than {MAX_NEEDLE} characters")

    def quoted(s: str) -> str:
        return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"

    every = f"from_json({quoted(json.dumps([_label(x, i) for i, x in enumerate(labels)]))}, 'array<struct<{LABEL}>>')"
    held = ", ".join(f"{quoted(c)}, length(s) - length(replace(s, {quoted(c)}, ''))" for c in sorted(set("".join(labels))))
    words = "filter(split(s, '\\\\s+'), w -> w <> '')"
    facts = f"struct(s AS text, length(s) AS size, {_chars('s')} AS chars, {words} AS words, {_chars(_joined(words))} AS in_order, map({held}) AS held)"
    able = f"filter(transform({every}, p -> {_bounded()}), p -> p.most >= {float(floor)}D)"
    bar = f"aggregate(xs, {float(floor)}D, (m, x) -> greatest(m, x.sure))"
    best = _let("xs", f"transform({able}, p -> {_sure()})", _let("bar", bar, f"array_max(transform(xs, x -> {_final()}))"))
    found = _let("b", _let("t", _let("s", f"`{text}`", facts), best), "CASE WHEN b IS NOT NULL THEN struct(b.label AS label, b.score AS score) END")
    empty = f"struct({quoted(labels[0])} AS label, 0D AS score)" if floor <= 0 else "NULL"
    return F.expr(f"CASE WHEN length(`{text}`) > 0 THEN {found} WHEN `{text}` IS NOT NULL THEN {empty} END")
