"""Sliding frames of any length from a few lags: sums, counts, deviations and extremes.

Spark works a sliding frame out anew for every row.  Here a column's values over 8, 64,
512 ... rows are each put together from eight values of an eighth of that length (seven
lags), and a frame from the lengths its size is made of.  All columns and frames climb the
ladder together: one window node per rung and one for the frames, all in one sort order.

* Sums and counts are additions only, so a value that has left a frame leaves no trace.
* Deviations come from (count, sum, sum of squares around the own mean), which merge exactly:
  the squares of the parts plus count * (mean of the part - mean of the whole) ** 2.  Nothing is
  subtracted from a large sum of squares.
* Extremes may overlap, so a frame needs two to eight pieces of the longest rung below it.

A frame's value depends on its own size alone, not on the frames asked for beside it.
"""

from collections import defaultdict
from dataclasses import dataclass

RADIX = 8

MEAN, STD, STD_POP, LOW, HIGH = "mean", "std", "std_pop", "low", "high"
_TRACKS = {MEAN: ("num", "sum"), STD: ("num", "sum", "sq"), STD_POP: ("num", "sum", "sq"), LOW: ("num", "low"), HIGH: ("num", "high")}
_NEUTRAL = {"num": "0", "sum": "0D", "sq": "0D", "low": "NULL", "high": "NULL"}
_FIRST = {
    "num": "int({0} IS NOT NULL)",
    "sum": "coalesce(double({0}), 0D)",
    "sq": "0D",
    "low": "{0}",
    "high": "{0}",
}


@dataclass(frozen=True)
class Frame:
    """``n`` rows of ``column``: the current one and those before it, or after it (``forward``).

    ``ahead`` moves the frame that many rows on; rows without a row so far ahead then have
    no value.  With ``full`` the value is NULL until n values exist.
    """

    kind: str
    column: str
    n: int
    full: bool = False
    forward: bool = False
    ahead: int = 0


def mean(column, n, full=False):
    return Frame(MEAN, column, n, full)


def std(column, n, population=False):
    return Frame(STD_POP if population else STD, column, n, True)


def add_frames(df, w, frames):
    """Add columns: name -> Frame.  ``w`` is the window of the series or of one block of it."""
    longest = defaultdict(int)
    for f in frames.values():
        for track in _tracks(f):
            key = (track, f.column, f.forward)
            longest[key] = max(longest[key], f.n)
    over = f"OVER (PARTITION BY {', '.join(map(_quoted, w.by))} ORDER BY {_quoted(w.order)})"
    held = sorted({_name(k, 1) for k in longest})
    df = df.selectExpr("*", *[f"{_FIRST[k[0]].format(_quoted(k[1]))} AS {_quoted(_name(k, 1))}" for k in sorted(longest)])
    length = 1
    while grown := sorted(k for k, n in longest.items() if n >= RADIX * length):
        pieces = [(length, j * length) for j in range(RADIX)]
        want = {_name(k, RADIX * length): (k, pieces, 0) for k in grown}
        df = _gathered(df, over, want)
        held += want
        length *= RADIX
    want = {}
    for out, f in frames.items():
        for track in _tracks(f):
            split = _covering if track in ("low", "high") else _adding
            want[f"_{track}_of_{out}"] = ((track, f.column, f.forward), split(f.n), f.ahead)
    df = _gathered(df, over, want)
    held += want
    df = df.selectExpr("*", *[f"{_value(out, f)} AS {_quoted(out)}" for out, f in frames.items()])
    return df.drop(*held)


def _tracks(f):
    return [t for t in _TRACKS[f.kind] if f.full or t != "num" or f.kind not in (LOW, HIGH)]


def _quoted(c):
    return f"`{c}`"


def _name(key, length):
    track, column, forward = key
    return f"_{track}{'_f' if forward else ''}_{column}_{length}"


def _adding(n):
    """(length, rows back) of pieces that make up n rows without overlap, longest first."""
    pieces, length, back = [], 1, 0
    while length * RADIX <= n:
        length *= RADIX
    while length:
        for _ in range((n - back) // length):
            pieces.append((length, back))
            back += length
        length //= RADIX
    return pieces


def _covering(n):
    """(length, rows back) of pieces of the longest rung that cover n rows."""
    length = 1
    while length * RADIX <= n:
        length *= RADIX
    return [(length, back) for back in (*range(0, n - length, length), n - length)]


def _gathered(df, over, want):
    """Put pieces together: name -> (key, pieces, rows ahead).  One window node, then expressions."""
    moved, parts = {}, {}
    for out, (key, pieces, ahead) in want.items():
        track, _, forward = key
        parts[out] = []
        for length, back in pieces:
            source, rows = _name(key, length), (back if forward else -back) + ahead
            if rows:
                name = f"{source}_at_{'m' if rows < 0 else 'p'}{abs(rows)}"
                side = "lag" if rows < 0 else "lead"
                moved[name] = f"{side}({_quoted(source)}, {abs(rows)}, {_NEUTRAL[track]}) {over} AS {_quoted(name)}"
                source = name
            parts[out].append(source)
    df = df.selectExpr("*", *moved.values()) if moved else df
    plain = {out: _together(key[0], parts[out]) for out, (key, _, _) in want.items() if key[0] != "sq"}
    df = df.selectExpr("*", *[f"{e} AS {_quoted(out)}" for out, e in plain.items()])
    squares = {out: key for out, (key, _, _) in want.items() if key[0] == "sq"}
    if squares:
        df = df.selectExpr("*", *[f"{_spread(out, parts)} AS {_quoted(out)}" for out in squares])
    return df.drop(*moved)


def _together(track, names):
    names = [_quoted(n) for n in names]
    if track in ("low", "high"):
        return names[0] if len(names) == 1 else f"{'least' if track == 'low' else 'greatest'}({', '.join(names)})"
    return " + ".join(names)


def _spread(out, parts):
    """Sum of squares around the mean of the whole, from those of the parts."""
    n, s = (out.replace("_sq", t, 1) for t in ("_num", "_sum"))
    terms = [_quoted(p) for p in parts[out]]
    if len(terms) == 1:
        return terms[0]
    middle = f"try_divide({_quoted(s)}, {_quoted(n)})"
    for count, total in zip(parts[n], parts[s]):
        gap = f"({_quoted(total)} / {_quoted(count)} - {middle})"
        terms.append(f"CASE WHEN {_quoted(count)} > 0 THEN {_quoted(count)} * {gap} * {gap} ELSE 0D END")
    return " + ".join(terms)


def _value(out, f):
    n = _quoted(f"_num_of_{out}")
    if f.kind in (LOW, HIGH):
        value = _quoted(f"_{f.kind}_of_{out}")
        return f"CASE WHEN {n} = {f.n} THEN {value} END" if f.full else value
    enough = f"{n} = {f.n}" if f.full else f"{n} > 0"
    if f.kind == MEAN:
        return f"CASE WHEN {enough} THEN {_quoted(f'_sum_of_{out}')} / {n} END"
    squares = _quoted(f"_sq_of_{out}")
    if f.kind == STD_POP:
        return f"CASE WHEN {enough} THEN sqrt({squares} / {n}) END"
    return f"CASE WHEN {enough} AND {n} > 1 THEN sqrt({squares} / ({n} - 1)) END"
