"""Sections and log ranges: values by hand, and no rows made that are not results."""

import pytest

from tidemark.operators import section as sec


def plan(df):
    return df._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_overlapping_logs_do_not_copy_the_track(spark, width):
    """Ranges of logs that overlap, hold nothing, touch one row, are backward or lack an end."""
    rows = [(s, t, t / 10) for s in ("a", None) for t in range(0, 50, 2)]
    spans = {"all": (0, 50), "same": (0, 50), "open": (10, 20), "one": (10, 11), "none": (11, 12), "back": (20, 10), "empty": (10, 10), "before": (-9, -1), "endless": (5, None)}
    logs = [(s, n, a, b, 0) for s in ("a", None) for n, (a, b) in spans.items()] + [("a", "open", 0, 50, 1)]
    track = spark.createDataFrame(rows, "series string, us long, km double")
    out = sec.log_ranges(track, spark.createDataFrame(logs, "series string, label string, start long, end long, position long"), ["series"], "us", "km", width)
    # Once every row was copied to each log of its time cell, which grows with rows times logs.
    assert "_cell" not in plan(out)
    want = set()
    for s in ("a", None):
        for name, (a, b) in spans.items():
            inside = [km for series, t, km in rows if series == s and b is not None and a <= t < b]
            if inside:
                want.add((s, name, inside[0], inside[-1]))
    assert {(r.series, r.label, r.start_km, r.end_km) for r in out.collect()} == want


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_section_grid_is_made_last(spark, size):
    """Columns filled between their cells; cells above and below the grid count as neighbours."""
    known = {0: {2: 1.0, 6: 5.0}, 1: {-2: 0.0, 4: 6.0}, 5: {10: 2.0, 30: 22.0}, 2: {}}
    cells = [("a", x / 5, zi / 2, 2, v) for x, column in known.items() for zi, v in column.items()]
    cells += [("a", 0.4, None, 2, 7.0), ("a", 1.0, 10.0, 2, None)]
    df = spark.createDataFrame(cells, "series string, x double, depth double, profile long, v double")
    out = sec.grid_section(df, ["series"], "x", "depth", "profile", "v", size=size)
    # Six columns over a length of one, down to 10 metres: 20 is not reached, as only the deepest value counts.
    text = plan(out)
    assert text.rindex("Generate") < text.index("Window")  # no grid row goes through a shuffle or a window
    bottom = int(15 // 10 * 10 * 2)
    want = {}
    for xi, column in known.items():
        at = sorted(column.items())
        for zi in range(bottom + 1):
            value = column.get(zi)
            for (z0, v0), (z1, v1) in zip(at, at[1:], strict=False):
                if z0 < zi < z1:
                    value = v0 + (v1 - v0) * (zi - z0) / (z1 - z0)
            want[(xi, zi, zi * 0.5)] = value
    got = {(r.xi, r.zi, r.depth): r.v for r in out.collect()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == (None if v is None else pytest.approx(v, abs=1e-12))
