"""The per-slice kernels agree with the plain sequential fold (no Spark)."""

from bisect import bisect_right

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.operators import fold
from eventide.schema import INITIAL_DATE, INITIAL_TYPE

INIT = (INITIAL_TYPE, INITIAL_DATE, True)

def _next_pointers(types, dates) -> np.ndarray:
    """next[i] = first j > i with type[j] != type[i] and date[j] >= date[i], else -1.

    Right-to-left sweep with one monotone stack per type (an element is dropped
    once an earlier element of its type has a date at least as large)."""
    n = len(types)
    nxt = np.full(n, -1, np.int64)
    neg_dates: dict = {}
    idxs: dict = {}
    for i in range(n - 1, -1, -1):
        ti = types[i]
        di = int(dates[i])
        best = -1
        for u, negs in neg_dates.items():
            if u == ti or not negs:
                continue
            k = bisect_right(negs, -di) - 1
            if k >= 0:
                j = idxs[u][k]
                if best < 0 or j < best:
                    best = j
        nxt[i] = best
        negs = neg_dates.setdefault(ti, [])
        ix = idxs.setdefault(ti, [])
        while negs and -negs[-1] <= di:
            negs.pop()
            ix.pop()
        negs.append(-di)
        ix.append(i)
    return nxt


def _general_pieces(types, dates):
    """Summary pieces for any date order: next pointers, chain ends, then a
    sweep over the distinct dates in descending order."""
    n = len(types)
    nxt = _next_pointers(types, dates)
    end = np.arange(n)
    length = np.ones(n, np.int64)
    for i in range(n - 1, -1, -1):
        if nxt[i] >= 0:
            end[i] = end[nxt[i]]
            length[i] += length[nxt[i]]

    def exit_of(i):
        e = end[i]
        return (types[e], int(dates[e])), int(length[i])

    order = np.argsort(dates, kind="stable")[::-1]
    desc: list = []  # (threshold, value), thresholds descending
    i1, t1, i2 = -1, None, -1
    k = 0
    while k < n:
        d = dates[order[k]]
        while k < n and dates[order[k]] == d:
            j = int(order[k])
            tj = types[j]
            if i1 < 0:
                i1, t1, i2 = j, tj, -1
            elif j < i1:
                if tj != t1:
                    i2 = i1
                i1, t1 = j, tj
            elif tj != t1 and (i2 < 0 or j < i2):
                i2 = j
            k += 1
        x1, n1 = exit_of(i1)
        if i2 < 0:
            value = (t1, x1, n1, None, 0)
        else:
            x2, n2 = exit_of(i2)
            value = (None, x1, n1, None, 0) if (x1, n1) == (x2, n2) else (t1, x1, n1, x2, n2)
        if not desc or desc[-1][1] != value:
            desc.append((int(d), value))
    desc.reverse()
    rows = [(t, v[0], *v[1], v[2], *(v[3] or (None, None)), v[4]) for t, v in desc]
    return tuple(map(list, zip(*rows)))


event = st.tuples(st.sampled_from(["A", "B", "C", "-"]), st.integers(-3, 12))
events = st.lists(event, max_size=40)


def _arrays(evs):
    types = np.array([e[0] for e in evs], dtype=object)
    dates = np.array([e[1] for e in evs], dtype=np.int64)
    return types, dates


def _state_after(evs, state):
    t, d, init = state
    for ty, dt in evs:
        if ty != t and d <= dt:
            t, d, init = ty, dt, False
    return (t, d, init)


@settings(max_examples=300, deadline=None)
@given(events)
def test_fold_segment_matches_reference(evs):
    types, dates = _arrays(evs)
    dec, _, _, _, _ = fold.fold_segment(types, dates, INIT)
    assert list(dec) == fold.fold_reference(evs)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 50)), max_size=40).map(
    lambda xs: sorted(xs, key=lambda e: e[1])
))
def test_sorted_path_matches_loop(evs):
    types, dates = _arrays(evs)
    for state in [INIT, ("A", 7, False), ("B", 60, False)]:
        a = fold._fold_sorted(types, dates, state)
        b = fold._fold_loop(types, dates, state)
        assert list(a[0]) == list(b[0])
        assert list(a[1]) == list(b[1])
        assert list(a[2]) == list(b[2])
        assert list(a[3]) == list(b[3])
        assert a[4] == b[4]


@settings(max_examples=300, deadline=None)
@given(events, st.lists(st.integers(0, 40), max_size=4))
def test_pieces_compose_like_sequential_fold(evs, cuts):
    """Summaries of consecutive slices, applied in order, give the entering state
    of every slice, and re-folding each slice from it gives the whole-key result."""
    bounds = sorted({0, len(evs), *[c for c in cuts if c <= len(evs)]})
    state = (*INIT, 0)
    decisions = []
    for lo, hi in zip(bounds, bounds[1:]):
        part = evs[lo:hi]
        types, dates = _arrays(part)
        pieces = fold.run_pieces(types, dates)
        dec, _, _, _, after = fold.fold_segment(types, dates, state[:3])
        decisions.extend(dec)
        summarised = fold.apply_pieces(*pieces, state)
        assert summarised[:2] == after[:2] == _state_after(part, state[:3])[:2]
        assert summarised[3] == state[3] + list(dec).count(fold.ACCEPTED)
        state = summarised
    assert decisions == fold.fold_reference(evs)


@settings(max_examples=200, deadline=None)
@given(events, st.sampled_from(["A", "B", "-"]), st.integers(-5, 15))
def test_pieces_any_entering_state(evs, t0, d0):
    types, dates = _arrays(evs)
    pieces = fold.run_pieces(types, dates)
    got = fold.apply_pieces(*pieces, (t0, d0, False, 3))
    assert got[:2] == _state_after(evs, (t0, d0, False))[:2]
    dec, *_ = fold.fold_segment(types, dates, (t0, d0, False))
    assert got[3] == 3 + list(dec).count(fold.ACCEPTED)


@settings(max_examples=400, deadline=None)
@given(st.lists(events, min_size=2, max_size=6), st.randoms())
def test_composed_pieces_equal_one_after_the_other(parts, rnd):
    """Any tree of compositions gives what applying the summaries in order gives."""
    level = [fold.run_pieces(*_arrays(p)) for p in parts]
    single = list(level)
    while len(level) > 1:
        i = rnd.randrange(len(level) - 1)
        level[i : i + 2] = [fold.compose_pieces(level[i], level[i + 1])]
    assert list(level[0][0]) == sorted(set(level[0][0]))
    for t0 in ("A", "B", "C", "-"):
        for d0 in range(-5, 15):
            state = (t0, d0, False, 0)
            for pieces in single:
                state = fold.apply_pieces(*pieces, state)
            assert fold.apply_pieces(*level[0], (t0, d0, False, 0)) == state
    assert fold.apply_pieces(*level[0], (*INIT, 0))[2] == (fold.apply_pieces(*level[0], (*INIT, 0))[3] == 0)


HAND_CASES = [
    ("A@5", "A@5"),
    ("A@1 A@2 B@3", "A@1 B@3"),
    ("A@1 B@1", "A@1 B@1"),
    ("A@5 B@3 B@6", "A@5 B@6"),
    ("A@1 A@5 B@3", "A@1 B@3"),
    ("A@1 B@2 A@3", "A@1 B@2 A@3"),
    ("-@1 A@2 -@3", "A@2 -@3"),
    ("A@-1 A@0", "A@0"),
    ("A@5 B@3 A@6 B@7", "A@5 B@7"),
]


def parse_case(text):
    out = []
    for tok in text.split():
        t, d = tok.split("@")
        out.append((t, int(d)))
    return out


def test_hand_cases_kernel():
    for arrivals, accepted in HAND_CASES:
        evs = parse_case(arrivals)
        types, dates = _arrays(evs)
        dec, *_ = fold.fold_segment(types, dates, INIT)
        got = [e for e, k in zip(evs, dec) if k == fold.ACCEPTED]
        assert got == parse_case(accepted), arrivals


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 30)), max_size=40).map(
    lambda xs: sorted(xs, key=lambda e: e[1])
))
def test_sorted_pieces_equal_general_pieces(evs):
    types, dates = _arrays(evs)
    if len(evs) == 0:
        return
    assert fold._sorted_pieces(types, dates) == _general_pieces(types, dates)


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.sampled_from(["A", "B", "-"]), st.integers(-2, 20)),
        min_size=1,
        max_size=40,
    ),
    st.sampled_from([INIT, ("A", 3, False), ("-", 0, True)]),
    st.integers(0, 5),
)
def test_fold_runs_sorted_matches_per_run(rows, first_state, first_counter):
    rows = sorted(rows, key=lambda r: (r[0], r[2]))
    keys = np.array([r[0] for r in rows], dtype=object)
    types, dates = _arrays([(r[1], r[2]) for r in rows])
    got = fold.fold_runs_sorted(keys, types, dates, first_state, first_counter, INIT)
    # per-run reference
    dec, pt, pd_, cr, cn = [], [], [], [], []
    state, counter = first_state, first_counter
    start = 0
    for i in range(1, len(rows) + 1):
        if i == len(rows) or keys[i] != keys[start]:
            if start > 0:
                state, counter = INIT, 0
            d, a, b, c, state = fold.fold_segment(types[start:i], dates[start:i], state)
            acc = (d == fold.ACCEPTED).astype(np.int64)
            cn.extend(counter + np.cumsum(acc) - acc)
            counter += int(acc.sum())
            dec.extend(d), pt.extend(a), pd_.extend(b), cr.extend(c)
            start = i
    assert list(got[0]) == dec
    assert list(got[1]) == pt
    assert list(got[2]) == pd_
    assert list(got[3]) == cr
    assert list(got[4]) == cn
    assert got[5] == state and got[6] == counter


@settings(max_examples=500, deadline=None)
@given(events)
def test_vector_pieces_equal_general_pieces(evs):
    if not evs:
        return
    types, dates = _arrays(evs)
    assert fold._vector_pieces(types, dates) == _general_pieces(types, dates)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 30)), min_size=2, max_size=70))
def test_next_accepted_equals_the_sweep(evs):
    codes = np.array([e[0] for e in evs], dtype=np.int64)
    dates = np.array([e[1] for e in evs], dtype=np.int64)
    want = _next_pointers(codes, dates)
    assert fold.next_accepted(codes, dates).tolist() == np.where(want < 0, len(evs), want).tolist()


def test_many_types_take_little_memory():
    import tracemalloc

    rng = np.random.default_rng(0)
    types = np.array([f"t{i}" for i in rng.integers(0, 500, 50_000)], dtype=object)
    dates = rng.integers(0, 10**6, 50_000)
    tracemalloc.start()
    fold.run_pieces(types, dates)
    assert tracemalloc.get_traced_memory()[1] < 60e6
    tracemalloc.stop()
