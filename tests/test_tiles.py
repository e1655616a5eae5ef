"""Objects that go over the borders of tiles, openings and cloud clean-up, zones and sweeps, against plain computations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import raster, research, thresholds, zones
from strandline.operators.components import connected
from strandline.plans import preprocess


def labelled(on, diagonal):
    """Sizes of objects by flood fill."""
    size, seen = np.zeros(on.shape, int), np.zeros(on.shape, bool)
    steps = [(r, c) for r in (-1, 0, 1) for c in (-1, 0, 1) if (r or c) and (diagonal or not (r and c))]
    for start in zip(*np.nonzero(on), strict=True):
        if seen[start]:
            continue
        seen[start], todo, held = True, [start], []
        while todo:
            here = todo.pop()
            held.append(here)
            for r, c in steps:
                there = (here[0] + r, here[1] + c)
                if 0 <= there[0] < on.shape[0] and 0 <= there[1] < on.shape[1] and on[there] and not seen[there]:
                    seen[there] = True
                    todo.append(there)
        for h in held:
            size[h] = len(held)
    return size


def frame(spark, *grids, name="on"):
    rows = [(k, r, c, v.item()) for k, g in enumerate(grids) for (r, c), v in np.ndenumerate(g)]
    return spark.createDataFrame(rows, f"scene_id long, row int, col int, {name} {'boolean' if grids[0].dtype == bool else 'double'}")


@pytest.mark.parametrize("diagonal", [False, True])
def test_objects_over_borders(spark, diagonal):
    rng = np.random.default_rng(3)
    snake = np.zeros((23, 23), bool)
    snake[::2] = True
    snake[1::4, -1] = snake[3::4, 0] = True
    grids = [rng.random((23, 23)) < p for p in (0.35, 0.55)] + [snake, np.ones((23, 23), bool), np.zeros((23, 23), bool)]
    got = {(r.scene_id, r.row, r.col): r.size for r in raster.objects(frame(spark, *grids), "on", diagonal, 5).collect()}
    want = {(k, r, c): n for k, g in enumerate(grids) for (r, c), n in np.ndenumerate(labelled(g, diagonal)) if n}
    assert got == want
    kept = raster.drop_small_objects(frame(spark, *grids), "on", 9, diagonal, 5).collect()
    assert len(kept) == 5 * 23 * 23 and {(r.scene_id, r.row, r.col) for r in kept if r.on} == {k for k, n in want.items() if n >= 9}


def test_components_of_groups(spark):
    chain = [(1, i, i + 1) for i in range(90)]
    links = [*chain, (2, 5, 4), (2, 90, 5), (2, 7, 7), (3, 10, 2), (3, 2, 10), (3, 11, 10)]
    got = {(r.g, r.node): r.root for r in connected(spark.createDataFrame(links, "g int, a long, b long"), ["g"]).collect()}
    assert got == {(1, i): 0 for i in range(91)} | {(2, 4): 4, (2, 5): 4, (2, 90): 4, (3, 2): 2, (3, 10): 2, (3, 11): 2}


def opened(on, k):
    """Opening by its definition: squares anchored in the image, beyond which all is set."""
    h, w = on.shape
    out, b = np.zeros_like(on), k // 2
    for r in range(h):
        for c in range(w):
            rows, cols = slice(max(r - b, 0), min(r - b + k, h)), slice(max(c - b, 0), min(c - b + k, w))
            if on[rows, cols].all():
                out[rows, cols] = True
    return out


@pytest.mark.parametrize("size", [3, 6])
def test_opening_by_a_square(spark, size):
    grid = np.random.default_rng(4).random((40, 40)) < 0.93
    got = {(r.row, r.col) for r in raster.focal(frame(spark, grid), size - 1, {"on": ("on", f"open{size}")}, 13).collect() if r.on}
    assert got == set(zip(*np.nonzero(opened(grid, size)), strict=True))
    same = {(r.row, r.col) for r in raster.open_square(frame(spark, grid), "on", size).collect() if r.on}
    assert same == got


def test_cloud_clean_up(spark):
    qa = np.zeros((40, 40), int)
    qa[2:9, 2:9] = 2  # 49 pixels stay
    qa[20:26, 30:36] = 8  # 36 pixels go
    qa[30, :] = 4  # a line of 40 stays by size, not by opening
    qa[12:24, 10:22] = 4  # 144 pixels
    likely = np.zeros((40, 40))
    likely[33:39, 20:26], likely[33:38, 2:8] = 90, 90
    rows = [(1, r, c, int(qa[r, c]), float(likely[r, c]), 0.1, 0.1, None if (r, c) == (0, 0) else 0.1) for r in range(40) for c in range(40)]
    px = spark.createDataFrame(rows, "scene_id long, row int, col int, qa int, prob double, g double, nir double, swir1 double")
    at = lambda df: {(r.row, r.col) for r in df.where("cloud").collect()}
    box = lambda r0, r1, c0, c1: {(r, c) for r in range(r0, r1) for c in range(c0, c1)}
    bands = ["g", "nir", "swir1"]
    base = box(2, 9, 2, 9) | box(30, 31, 0, 40) | box(12, 24, 10, 22)
    assert at(preprocess.masked(px, "L8", bands)) == base | {(0, 0)}
    assert at(preprocess.masked(px, "L8", bands, probability="prob")) == base | {(0, 0)} | box(33, 39, 20, 26)
    assert at(preprocess.masked(px, "L8", bands, doubtful=True)) == box(12, 24, 10, 22) | {(0, 0)}
    out = preprocess.masked(px, "L8", bands).where("nodata").collect()
    assert len(out) == 1 and out[0].g is None and out[0].cloud


def test_local_minimum_leaves_out_end_bins_and_nan(spark):
    values = [-1.0] * 50 + [-0.6] * 40 + [-0.3] * 9 + [0.1] * 2 + [0.5] * 30 + [1.0] * 60 + [float("nan")] * 5
    df = spark.createDataFrame([("s", v) for v in values] + [("one", 3.0), ("one", 3.0)], "g string, v double")
    got = {r.g: r.threshold for r in thresholds.local_minimum(df, ["g"], "v", 16).collect()}
    counts, edges = np.histogram(values[:-5], 16)
    peaks = [i for i in range(1, 15) if counts[i] > counts[i - 1] and counts[i] > counts[i + 1]]
    centres = (edges[1:] + edges[:-1]) / 2
    otsu = {r.g: r.threshold for r in thresholds.otsu(df, ["g"], "v", 16).collect()}
    assert 0 not in peaks and len(peaks) >= 2
    side = lambda inside, none: max(((counts[i], -i) for i in peaks if inside(centres[i])), default=(0, none))
    low, high = side(lambda x: x < otsu["s"], None), side(lambda x: x >= otsu["s"], None)
    lower = otsu["s"] if low[1] is None else centres[-low[1]]
    upper = otsu["s"] if high[1] is None else centres[-high[1]]
    between = [i for i in range(16) if lower + 1e-9 < centres[i] < upper - 1e-9]
    want = centres[min(between, key=lambda i: (counts[i], i))] if between else otsu["s"]
    assert got["s"] == pytest.approx(want) and got["one"] == 3.0
    assert thresholds.histogram(df, ["g"], "v", 16).agg(F.sum("n")).first()[0] == len(values) - 5 + 2


def test_kolmogorov_series(spark):
    # tabulated: P(K > 1.3581) = 0.05, P(K > 1.6276) = 0.01, P(K > 0.5712) = 0.9
    df = spark.createDataFrame([(1.3581,), (1.6276,), (0.5712,), (0.2,)], "x double")
    got = [r[0] for r in df.select(thresholds.kolmogorov(F.col("x"))).collect()]
    assert got == pytest.approx([0.05, 0.01, 0.9, 1.0], abs=1e-4)


def test_zones_and_sweep_of_two_shores(spark):
    """A scene whose upper half has its shore at 0.3 and whose lower half at 0.7: zones find both, one level can't."""
    rows, refs = [], []
    for r in range(40):
        level, edge = (0.3, 6.0) if r < 20 else (0.7, 8.0)
        refs.append((1, r, float(r), edge))
        for c in range(16):
            rows.append((1, r, c, level + (c - edge) * (0.02 if r < 20 else 0.03), False, True))
    px = spark.createDataFrame(rows, "scene_id long, row int, col int, value double, cloud boolean, in_buffer boolean")
    line = spark.createDataFrame(refs, "scene_id long, idx int, row double, col double")
    found = zones.zone_indicators(px, line, 4, 0.05).orderBy("idx").collect()
    starts = [r.idx for a, r in zip(found, found[1:], strict=False) if r.zone > a.zone]
    assert found[0].zone == 0 and found[-1].zone == len(starts) >= 1 and all(14 <= i <= 26 for i in starts)
    split = line.withColumn("zone", (F.col("idx") >= 20).cast("long"))
    halves = lambda df, group, value: df.groupBy(*group).agg(F.when(F.first("zone") == 0, 0.3).otherwise(0.7).alias("threshold"))
    points, _ = zones.zone_contours(px, split, 5.0, halves)
    got = points.collect()
    assert len({round(p.row) for p in got}) >= 38
    assert all(abs(p.col - (6 if p.zone == 0 else 8)) < 1e-6 for p in got if abs(p.row - 19.5) > 1)
    best = zones.optimal_threshold(px.where("row < 20"), line.where("idx < 20"), 50).first()
    assert abs(best.level - 0.3) < 0.01 and best.error < 0.5
    assert zones.optimal_threshold(px.where("false"), line, 50).count() == 0


def test_lines_over_borders(spark):
    """A hill's ring, a spiral and straight lines: each is one line in order, whatever the tiles."""
    r, c = np.mgrid[0:31, 0:31].astype(float)
    ring = np.hypot(r - 15.2, c - 14.7)
    angle, radius = np.arctan2(r - 15, c - 15), np.hypot(r - 15, c - 15)
    spiral = np.sin(radius * 1.1 - angle)
    bands = c - 0.1 * r + 0.05
    for tile in (4, 128):
        for k, (grid, level) in enumerate(((ring, 9.3), (spiral, 0.05), (bands, 11.0))):
            pieces = raster.contour_segments(frame(spark, grid, name="v"), "v", level)
            made = {tuple(sorted(((round(s.p.row, 9), round(s.p.col, 9)), (round(s.q.row, 9), round(s.q.col, 9))))) for s in pieces.collect()}
            lines = {}
            for x in sorted(raster.link_contours(pieces, tile=tile).collect(), key=lambda x: (x.contour_id, x.pt_idx)):
                lines.setdefault(x.contour_id, []).append(x)
            walked = []
            for line in lines.values():
                assert [x.pt_idx for x in line] == list(range(len(line)))
                points = [(x.row, x.col) for x in line]
                walked += [tuple(sorted(p)) for p in zip(points, points[1:], strict=False)]
            assert len(walked) == len(made) and set(walked) == made
            heads = [((line[0].row, line[0].col), (line[-1].row, line[-1].col)) for line in lines.values()]
            closed = [a == b for a, b in heads]
            assert all(a <= b for a, b in heads)
            free = [p for h, shut in zip(heads, closed, strict=True) if not shut for p in h]
            assert len(free) == len(set(free))  # no two lines could be joined
            if k == 0:
                assert closed == [True]
            if k == 2:
                assert closed == [False] and len(made) > 30
    assert raster.link_contours(pieces.where("false")).count() == 0


def test_gaussian_model_is_recovered(spark):
    rows = [(s, h, 10, b + c * (1 - np.exp(-((2 * h / a) ** 2))).item()) for s, (a, c, b) in enumerate([(6.0, 2.0, 0.5), (12.5, 1.0, 0.0), (3.3, 0.0, 0.7)]) for h in range(1, 21)]
    got = {r.scene_id: r for r in research.gaussian_model(spark.createDataFrame(rows, "scene_id long, lag int, n long, gamma double")).collect()}
    assert [(round(got[s].reach, 1), round(got[s].sill, 3), round(got[s].nugget, 3)) for s in (0, 1)] == [(6.0, 2.0, 0.5), (12.5, 1.0, 0.0)]
    assert abs(got[2].sill) < 1e-9 and abs(got[2].nugget - 0.7) < 1e-9


def test_warp_between_grids(spark):
    """A plane stays a plane on a sheared grid; a missing pixel leaves its weight to the others."""
    plane = lambda x, y: 3 + 0.5 * x - 0.2 * y
    src, dst = (10.0, 2.0, 0.0, 80.0, 0.0, -2.0), (12.0, 1.3, 0.2, 77.0, -0.1, -1.1)
    names = ("xtr", "xscale", "xshear", "ytr", "yshear", "yscale")
    at = lambda g, r, c: (g[0] + g[1] * (c + 0.5) + g[2] * (r + 0.5), g[3] + g[4] * (c + 0.5) + g[5] * (r + 0.5))
    px = [(1, r, c, plane(*at(src, r, c))) for r in range(12) for c in range(15) if (r, c) != (5, 5)]
    df = spark.createDataFrame(px, "scene_id long, row int, col int, v double")
    georef = lambda g, more, kinds: spark.createDataFrame([(1, *g, *more)], "scene_id long, " + ", ".join(f"{n} double" for n in names) + kinds)
    out = raster.warp(df, "v", georef(src, (), ""), georef(dst, (14, 18), ", height int, width int")).collect()
    inner = 0
    for r in out:
        x, y = at(dst, r.row, r.col)
        sc, sr = (x - 10) / 2 - 0.5, (80 - y) / 2 - 0.5
        assert -0.5 <= sc <= 14.5 and -0.5 <= sr <= 11.5
        if 0 <= sc <= 14 and 0 <= sr <= 11 and max(abs(sc - 5), abs(sr - 5)) >= 1:
            inner += 1
            assert abs(r.v - plane(x, y)) < 1e-9
        assert max(abs(sc - 5), abs(sr - 5)) > 0.5
    assert inner > 100


def test_semivariogram_joins_nothing(spark):
    values = {(0, 0): 1.0, (0, 1): 3.0, (0, 3): -2.0, (0, 9): 0.5, (1, 0): 2.0, (1, 2): 4.0}
    rows = [(s, r, c, v + s) for s in (0, 1) for (r, c), v in values.items()] + [(0, 1, 1, None), (0, 1, 3, float("nan"))]
    got = research.semivariogram(spark.createDataFrame(rows, "scene_id long, row int, col int, value double"), "value", 3)
    # a join would be a broadcast of all pixels where Spark takes exploded arrays for small
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    gaps = {}
    for (r, c), v in values.items():
        for k in (1, 2, 3):
            if (r, c + k) in values:
                gaps.setdefault(k, []).append(abs(v - values[r, c + k]) ** 0.5)
    want = {k: (len(g), (sum(g) / len(g)) ** 4 / (0.457 + 0.494 / len(g) + 0.045 / len(g) ** 2) / 2) for k, g in gaps.items()}
    for s in (0, 1):
        one = {r.lag: (r.n, r.gamma) for r in got.where(f"scene_id = {s}").collect()}
        assert one.keys() == want.keys() and all(one[k] == pytest.approx(want[k]) for k in want)


def test_sweep_and_windows_with_few_and_many_references(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(s, r, c, float(np.sin(r / 3 + s) + c / 4 + rng.normal(0, 0.3)), bool((r + c) % 11 == 0), 1 <= c <= 8) for s in range(3) for r in range(10) for c in range(10)]
    pixels = spark.createDataFrame(rows, "scene_id long, row int, col int, value double, cloud boolean, in_buffer boolean")
    refs = spark.createDataFrame([(s, i, float(i % 10), 4.0 + i % 3) for s in range(3) for i in range(4 + 3 * s)], "scene_id long, idx int, row double, col double")
    sweep = lambda: zones.level_sweep(pixels, refs, 9, 2.0)
    local = lambda: zones.point_contours(pixels, refs, 2, lambda df, group, value: thresholds.otsu(df, group, value, 16), 2.0)[0]
    read = lambda df: sorted(tuple(round(x, 9) for x in r) for r in df.collect())
    swept, held = read(sweep()), read(local())
    for few in (0, 6):
        monkeypatch.setattr(zones, "FEW", few)
        assert read(sweep()) == swept and read(local()) == held
    # by hand, over the contours' distinct points
    inside = thresholds.finite(pixels.where("in_buffer"), "value")
    for s in range(3):
        own = [r for r in rows if r[0] == s and r[5]]
        lo, hi = min(r[3] for r in own), max(r[3] for r in own)
        for k, level, error in [x[1:] for x in swept if x[0] == s][1::3]:
            assert level == pytest.approx(lo + k * (hi - lo) / 8)
            p = raster.contour_points(raster.contour_segments(inside.where(f"NOT cloud AND scene_id = {s}"), "value", lo + k * (hi - lo) / 8), ["scene_id"]).collect()
            want = np.mean([min(np.hypot(x.row - r.row, x.col - r.col) for x in p) for r in refs.where(f"scene_id = {s}").collect()])
            assert error == pytest.approx(want, abs=1e-8)


def test_sweep_broadcasts_no_cells_and_meets_no_rounds(spark, sf, monkeypatch):
    from strandline.catalog import zones as queries

    monkeypatch.setattr(zones, "nearest", None)
    out = queries.best_level(spark, sf)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 500 and "SortMergeJoin" in plan
    queries.local_extraction(spark, sf).count()


def test_lines_of_many_tiles_in_one_batch(spark):
    rng = np.random.default_rng(8)
    rows = [(s, r, c, float(np.sin(r / 2 + s) + np.cos(c / 3) + rng.normal(0, 0.2))) for s in range(4) for r in range(12) for c in range(12)]
    pieces = raster.contour_segments(spark.createDataFrame(rows, "scene_id long, row int, col int, value double"), "value", 0.1)
    out = raster.contour_chains(pieces, ["scene_id"], 3)
    # a Python group for each tile costs more than its rows
    assert "FlatMapGroups" not in out._jdf.queryExecution().executedPlan().toString()
    want = {}
    for x in pieces.collect():
        ends = tuple(sorted((round(e.row, 9), round(e.col, 9)) for e in (x.p, x.q)))
        if ends[0] != ends[1]:
            want.setdefault((x.scene_id, x.r0 // 3, x.c0 // 3), set()).add(ends)

    def read():
        chains, seen = {}, {}
        for x in out.orderBy("scene_id", "chain", "idx").collect():
            chains.setdefault((x.scene_id, x.chain), []).append((x.row, x.col))
        for (s, chain), points in chains.items():
            tile = (s, chain >> 40, chain >> 20 & (1 << 20) - 1)
            seen.setdefault(tile, []).extend(tuple(sorted(p)) for p in zip(points, points[1:]))
        assert all(len(p) == len(set(p)) for p in seen.values())
        return {k: set(p) for k, p in seen.items()}

    assert read() == want
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        assert read() == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
