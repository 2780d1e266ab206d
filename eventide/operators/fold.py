"""Kernels of the transition rule, run inside Spark tasks on numpy arrays.

Rule (per key, in arrival order): the state is ``(type, date)`` of the last
accepted event, initially ``("-", 0)``.  An event is accepted iff its type
differs from the state type and its date is not older than the state date.
Accepted events replace the state; other events leave it untouched (a repeated
type does not advance the date).

Kernels:

* :func:`fold_segment` folds a slice of one key from a known state.  When the
  slice's dates are non-decreasing the result is a shifted comparison
  (vectorised); otherwise a plain loop.  :func:`fold_runs_sorted` does the
  vectorised form for a whole batch of keys at once.
* :func:`run_pieces` summarises a slice as a function *entering state ->
  leaving state* and the number of events that it accepts, without knowing the
  entering state.  It lets the slices of one key, held by different tasks, be folded
  in parallel: :func:`compose_pieces` makes one summary of two consecutive ones (it is
  associative, so summaries are combined in a tree) and every task then re-folds
  its slice from the exact entering state.  Time-ordered slices have a closed form
  (:func:`_sorted_pieces`); any order is handled by :func:`_vector_pieces`.

Entry function: from state ``(t0, d0)`` the first accepted event of a slice is
the first ``i`` with ``type[i] != t0`` and ``date[i] >= d0``; after it the path
no longer depends on the entering state, so the leaving state is the end of
the chain of "next accepted" pointers starting at ``i``.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np

ACCEPTED, REPEAT, LATE = 0, 1, 2


def fold_segment(types: np.ndarray, dates: np.ndarray, state: tuple):
    """Fold one key's events (in arrival order) from ``state = (type, date, initial)``.

    Returns ``(decision, prev_type, prev_date, created, new_state)``; ``prev_*`` and
    ``created`` describe the state each event was compared with.
    """
    n = len(types)
    if n > 1 and not bool(np.all(dates[1:] >= dates[:-1])):
        return _fold_loop(types, dates, state)
    return _fold_sorted(types, dates, state)


def _fold_loop(types, dates, state):
    n = len(types)
    dec = np.empty(n, np.int8)
    prev_t = np.empty(n, types.dtype)
    prev_d = np.empty(n, np.int64)
    created = np.empty(n, bool)
    t, d, init = state
    for i in range(n):
        ti = types[i]
        di = int(dates[i])
        prev_t[i] = t
        prev_d[i] = d
        created[i] = init
        if ti != t:
            if d <= di:
                dec[i] = ACCEPTED
                t, d, init = ti, di, False
            else:
                dec[i] = LATE
        else:
            dec[i] = REPEAT
    return dec, prev_t, prev_d, created, (t, d, init)


def _fold_sorted(types, dates, state):
    """Dates non-decreasing: after the first acceptance every event is compared
    with its predecessor's type, so the rule is a shifted comparison."""
    n = len(types)
    t0, d0, init0 = state
    dec = np.where(types == t0, REPEAT, LATE).astype(np.int8)
    prev_t = np.full(n, t0, dtype=types.dtype)
    prev_d = np.full(n, d0, dtype=np.int64)
    created = np.full(n, init0, dtype=bool)
    entry = (dates >= d0) & (types != t0)
    if n == 0 or not entry.any():
        return dec, prev_t, prev_d, created, state
    f = int(np.argmax(entry))
    acc = np.zeros(n, bool)
    acc[f] = True
    if f + 1 < n:
        acc[f + 1 :] = types[f + 1 :] != types[f:-1]
    dec[f:] = np.where(acc[f:], ACCEPTED, REPEAT)
    last_acc = np.maximum.accumulate(np.where(acc, np.arange(n), -1))
    if f + 1 < n:
        prev_t[f + 1 :] = types[f:-1]
        prev_d[f + 1 :] = dates[last_acc[f:-1]]
        created[f + 1 :] = False
    k = int(last_acc[-1])
    return dec, prev_t, prev_d, created, (types[n - 1], int(dates[k]), False)


def fold_runs_sorted(keys, types, dates, first_state: tuple, first_counter: int, init_state: tuple):
    """Vectorised fold of a batch holding many keys (consecutive runs of equal
    ``keys``), each run's dates non-decreasing.  The first run starts from
    ``first_state`` / ``first_counter``; every other run from ``init_state``.

    Returns ``(decision, prev_type, prev_date, created, change_no, last_state,
    last_counter)``."""
    n = len(keys)
    idx = np.arange(n)
    new_run = np.empty(n, bool)
    new_run[0] = True
    new_run[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(new_run)
    run = np.cumsum(new_run) - 1
    n_runs = len(starts)
    tdtype = types.dtype
    t0 = np.full(n_runs, init_state[0], dtype=tdtype)
    d0 = np.full(n_runs, init_state[1], dtype=np.int64)
    i0 = np.full(n_runs, init_state[2], dtype=bool)
    t0[0], d0[0], i0[0] = first_state[0], first_state[1], first_state[2]
    rt0, rd0, ri0 = t0[run], d0[run], i0[run]
    entry = (dates >= rd0) & (types != rt0)
    first = np.minimum.reduceat(np.where(entry, idx, n), starts)[run]
    after = idx > first
    acc = (idx == first) | (after & np.concatenate([[False], types[1:] != types[:-1]]))
    before = idx < first
    dec = np.where(acc, ACCEPTED, np.where(before & (types != rt0), LATE, REPEAT)).astype(np.int8)
    prev_types = np.empty(n, dtype=tdtype)
    prev_types[0] = types[0]  # placeholder: row 0 is never after its run's first acceptance
    prev_types[1:] = types[:-1]
    prev_t = np.where(after, prev_types, rt0)
    last_acc = np.maximum.accumulate(np.where(acc, idx, -1))
    prev_acc = np.concatenate([[0], np.maximum(last_acc[:-1], 0)])
    prev_d = np.where(after, dates[prev_acc], rd0)
    created = np.where(after, False, ri0)
    a = acc.astype(np.int64)
    cum = np.cumsum(a)
    base = np.concatenate([[0], cum[starts[1:] - 1]]) if n_runs > 1 else np.zeros(1, np.int64)
    change_no = cum - a - base[run]
    change_no[run == 0] += first_counter
    last_start = starts[-1]
    in_last = acc[last_start:]
    counter = int(in_last.sum()) + (first_counter if n_runs == 1 else 0)
    if in_last.any():
        state = (types[n - 1], int(dates[last_acc[n - 1]]), False)
    else:
        state = (t0[-1], int(d0[-1]), bool(i0[-1]))
    return dec, prev_t, prev_d, created, change_no, state, counter


def run_pieces(types: np.ndarray, dates: np.ndarray):
    """Summary of a slice as a piecewise function of the entering date.

    Returns parallel lists sorted by ascending threshold
    ``(thr, t1, x1_type, x1_date, n1, x2_type, x2_date, n2)``.  A piece with threshold
    ``thr`` applies to entering dates ``d0 <= thr`` down to the next smaller threshold;
    above the largest threshold the state passes unchanged.  In a piece, an entering type
    other than ``t1`` (every one if that is None) leaves as ``x1`` after ``n1`` accepted
    events; ``t1`` leaves as ``x2`` after ``n2``, or unchanged if ``x2`` is None.
    """
    n = len(types)
    if n == 0:
        return ([],) * 8
    if n == 1 or bool(np.all(dates[1:] >= dates[:-1])):
        return _sorted_pieces(types, dates)
    return _vector_pieces(types, dates)


def _lists(pieces: list[tuple]) -> tuple[list, ...]:
    """``[(thr, (t1, x1, n1, x2, n2)), ...]`` as the parallel lists of a summary."""
    rows = [(t, t1, *x1, n1, *(x2 or (None, None)), n2) for t, (t1, x1, n1, x2, n2) in pieces]
    return tuple(map(list, zip(*rows, strict=True))) if rows else ([],) * 8


def next_accepted(codes: np.ndarray, dates: np.ndarray) -> np.ndarray:
    """``next[i]``: the first ``j > i`` of another type whose date is not older, else ``n``.

    A tree over the positions holds in each node the largest date, its type, and the
    largest date of any other type.  All positions search it together: up over the nodes
    to the right until one has a fit, then down to the first.  O(n log n) steps of numpy
    and O(n) memory, whatever the number of types."""
    n = len(codes)
    depth = max(1, (n - 1).bit_length())
    low = np.iinfo(np.int64).min
    size = 1 << depth
    best = np.full(size, low, np.int64)
    owner = np.full(size, -1, np.int64)
    best[:n], owner[:n] = dates, codes
    levels = [(best, owner, np.full(size, low, np.int64))]
    for _ in range(depth):
        best, owner, other = levels[-1]
        (b0, b1), (o0, o1), (r0, r1) = ((x[::2], x[1::2]) for x in (best, owner, other))
        left = b0 >= b1
        same = o0 == o1
        top, who = np.where(left, b0, b1), np.where(left, o0, o1)
        rest = np.where(same, np.maximum(r0, r1), np.where(left, np.maximum(r0, b1), np.maximum(r1, b0)))
        levels.append((top, who, rest))

    def fits(level: int, node: np.ndarray, q: np.ndarray) -> np.ndarray:
        best, owner, other = levels[level]
        return np.where(owner[node] != codes[q], best[node], other[node]) >= dates[q]

    out = np.full(n, n, np.int64)
    query, pos = np.arange(n), np.arange(1, n + 1)
    hits: list[tuple[np.ndarray, np.ndarray]] = []
    for level in range(depth):
        inside = pos < size
        query, pos = query[inside], pos[inside]
        right = (pos >> level) & 1 == 1
        ok = right.copy()
        ok[right] = fits(level, pos[right] >> level, query[right])
        hits.append((query[ok], pos[ok] >> level))
        pos = np.where(right, pos + (1 << level), pos)
        query, pos = query[~ok], pos[~ok]
    # Down again: those found at a level go on with those found below it.
    query, node = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for level in range(depth - 1, -1, -1):
        if level < depth - 1:
            node = node * 2
            node = np.where(fits(level, node, query), node, node + 1)
        query, node = np.concatenate([query, hits[level][0]]), np.concatenate([node, hits[level][1]])
    out[query] = node
    return np.minimum(out, n)


def _vector_pieces(types, dates):
    """:func:`run_pieces` for any date order: next pointers over a tree, chain ends and
    lengths by pointer doubling, and one sweep over descending dates that keeps the two
    smallest positions of different types (the entry candidates)."""
    n = len(types)
    _, codes = np.unique(types.astype(str), return_inverse=True)
    hop = np.append(next_accepted(codes, dates), n)
    length = np.append(np.ones(n, np.int64), 0)
    end = np.where(hop < n, hop, np.arange(n + 1))
    while (hop < n).any():
        length += np.where(hop < n, length[hop], 0)
        hop = hop[hop]
        end = end[end]
    end, length, code, date = end.tolist(), length.tolist(), codes.tolist(), dates.tolist()
    descending: list[tuple] = []
    first = second = -1
    order = np.argsort(-dates, kind="stable").tolist()
    for k, j in enumerate(order):
        if first < 0:
            first = j
        elif j < first:
            if code[j] != code[first]:
                second = first
            first = j
        elif code[j] != code[first] and (second < 0 or j < second):
            second = j
        if k + 1 < n and date[order[k + 1]] == date[j]:
            continue
        x1, n1 = (types[end[first]], date[end[first]]), length[first]
        if second < 0:
            value = (types[first], x1, n1, None, 0)
        else:
            value = _choice(types[first], x1, n1, (types[end[second]], date[end[second]]), length[second])
        if not descending or descending[-1][1] != value:
            descending.append((date[j], value))
    return _lists(descending[::-1])


def _choice(t1, x1: tuple, n1: int, x2: tuple | None, n2: int) -> tuple:
    """A piece's value; without ``t1`` where both branches are the same."""
    return (None, x1, n1, None, 0) if (x1, n1) == (x2, n2) else (t1, x1, n1, x2, n2)


def _sorted_pieces(types, dates):
    """:func:`run_pieces` for non-decreasing dates, vectorised.

    Let ``L`` start the last run of equal types.  Entering in a run before ``L``, with this
    or another type, ends at ``L``; one change more if the run itself is accepted (one
    piece per run).  Entering at ``s >= L`` accepts ``s`` and nothing after it (one piece
    per distinct date from ``L`` on)."""
    change = np.flatnonzero(types[1:] != types[:-1]) + 1
    last = int(change[-1]) if len(change) else 0
    type_l = types[last]
    leaving = (type_l, int(dates[last]))
    uniq, first = np.unique(dates, return_index=True)  # ascending dates, first positions
    run = np.searchsorted(change, first, side="right")
    before = int(np.searchsorted(first, last))
    ends = np.flatnonzero(np.append(run[1:before] != run[: max(before - 1, 0)], True)) if before else []
    pieces: list[tuple] = []
    for k in ends:
        more = len(change) - int(run[k])
        pieces.append((int(uniq[k]), (types[first[k]], leaving, more + 1, leaving, more)))
    pieces += [(int(d), (type_l, (type_l, int(d)), 1, None, 0)) for d in uniq[before:]]
    return _lists(pieces)


def apply_pieces(thr, t1, x1t, x1d, n1, x2t, x2d, n2, state: tuple) -> tuple:
    """Leaving state ``(type, date, initial, changes so far)`` of a summarised slice for a
    given entering state."""
    t0, d0, _, changes = state
    k = bisect_left(list(thr), d0)
    if k == len(thr):
        return state
    if t1[k] is None or t0 != t1[k]:
        return (x1t[k], int(x1d[k]), False, changes + int(n1[k]))
    if x2t[k] is None:
        return state
    return (x2t[k], int(x2d[k]), False, changes + int(n2[k]))


def compose_pieces(a: tuple, b: tuple) -> tuple[list, ...]:
    """The summary of a slice summarised by ``a`` and the next one, summarised by ``b``.

    A piece of ``a`` that leaves in a known state leaves ``b`` in a known one.  Where ``a``
    lets the state pass (its type is ``t1``, or the date is above all thresholds), the
    pieces of ``b`` in that range decide, so they cut the piece further."""
    thr_a, thr_b = list(a[0]), list(b[0])
    pieces: list[tuple] = []

    def add(threshold: int, value: tuple) -> None:
        if pieces and pieces[-1][1] == value:
            pieces[-1] = (threshold, value)
        else:
            pieces.append((threshold, value))

    def after(x: tuple, n: int) -> tuple[tuple, int]:
        t, d, _, total = apply_pieces(*b, (*x, False, n))
        return (t, d), total

    low = None  # entering dates above this one
    for k, top in enumerate(thr_a):
        t1 = a[1][k]
        x1, n1 = after((a[2][k], int(a[3][k])), int(a[4][k]))
        if t1 is None:
            add(top, (None, x1, n1, None, 0))
        elif a[5][k] is not None:
            add(top, _choice(t1, x1, n1, *after((a[5][k], int(a[6][k])), int(a[7][k]))))
        else:
            at = 0 if low is None else bisect_right(thr_b, low)
            while True:
                inside = at < len(thr_b)
                threshold = min(top, int(thr_b[at])) if inside else top
                x2, n2 = None, 0
                if inside and (b[1][at] is None or b[1][at] != t1):
                    x2, n2 = (b[2][at], int(b[3][at])), int(b[4][at])
                elif inside and b[5][at] is not None:
                    x2, n2 = (b[5][at], int(b[6][at])), int(b[7][at])
                add(threshold, _choice(t1, x1, n1, x2, n2))
                if threshold == top:
                    break
                at += 1
        low = top
    for at in range(0 if low is None else bisect_right(thr_b, low), len(thr_b)):
        x2 = None if b[5][at] is None else (b[5][at], int(b[6][at]))
        add(int(thr_b[at]), (b[1][at], (b[2][at], int(b[3][at])), int(b[4][at]), x2, int(b[7][at])))
    return _lists(pieces)


def fold_reference(events, state=None):
    """Plain sequential fold over ``[(type, date), ...]``; the rule as written.

    Test oracle for the kernels and the distributed operator."""
    from ..schema import INITIAL_DATE, INITIAL_TYPE

    t, d = (INITIAL_TYPE, INITIAL_DATE) if state is None else state
    out = []
    for ty, dt in events:
        if ty != t and d <= dt:
            out.append(ACCEPTED)
            t, d = ty, dt
        elif ty != t:
            out.append(LATE)
        else:
            out.append(REPEAT)
    return out
