import numpy as np
import pytest
from helpers import array, exchanges, frame
from pixelquery import Grid
from pixelquery.operators import features, resample
from pixelquery.operators.focal import Derivatives, LocalStats, focal, mirror_pad


def box_mean(a, size):
    k = size // 2
    padded = a
    for _ in range(3):  # several reflections for windows wider than the array
        if padded.shape[0] >= a.shape[0] + 2 * k and padded.shape[1] >= a.shape[1] + 2 * k:
            break
        padded = np.pad(padded, min(k, *padded.shape), mode="symmetric")
    extra_r, extra_c = (
        (padded.shape[0] - a.shape[0]) // 2 - k,
        (padded.shape[1] - a.shape[1]) // 2 - k,
    )
    padded = padded[extra_r : padded.shape[0] - extra_r, extra_c : padded.shape[1] - extra_c]
    view = np.lib.stride_tricks.sliding_window_view(padded, (size, size))
    return view.mean(axis=(2, 3))


@pytest.mark.parametrize("shape,tile", [((30, 41), 8), ((16, 16), 16), ((6, 23), 4)])
def test_windows_match_numpy_across_tiles(spark, shape, tile):
    z = np.random.default_rng(1).normal(500, 100, shape)
    grid = Grid(0, 0, 10, *shape, tile=tile)
    stats = [LocalStats("z", 3, mean="m3"), LocalStats("z", 7, "m7", "s7")]
    out = focal(frame(spark, z=z), grid, stats, Derivatives("z", 10.0)).cache()
    assert out.count() == z.size
    assert np.allclose(array(out, "m3", shape), box_mean(z, 3))
    assert np.allclose(array(out, "m7", shape), box_mean(z, 7))
    spread = np.sqrt(box_mean(z * z, 7) - box_mean(z, 7) ** 2)
    assert np.allclose(array(out, "s7", shape), spread)
    zy, zx = np.gradient(z, 10.0, 10.0)
    assert np.allclose(array(out, "zx", shape), zx)
    assert np.allclose(array(out, "zy", shape), zy)
    assert np.allclose(array(out, "zxx", shape), np.gradient(zx, 10.0, axis=1))
    assert np.allclose(array(out, "zyy", shape), np.gradient(zy, 10.0, axis=0))
    assert np.allclose(array(out, "zxy", shape), np.gradient(zy, 10.0, axis=1))


def test_window_wider_than_raster(spark):
    z = np.arange(6.0).reshape(2, 3)
    out = focal(frame(spark, z=z), Grid(0, 0, 10, 2, 3, tile=2), [LocalStats("z", 11, mean="m")])
    rows = [int(i) for i in np.pad(np.arange(2), 10, mode="symmetric")[5:-5]]
    cols = [int(i) for i in np.pad(np.arange(3), 10, mode="symmetric")[5:-5]]
    wide = z[np.ix_(rows, cols)]
    expected = np.lib.stride_tricks.sliding_window_view(wide, (11, 11)).mean(axis=(2, 3))
    assert np.allclose(array(out, "m", (2, 3)), expected)


def test_single_pixel(spark):
    z = np.array([[7.0]])
    grid = Grid(0, 0, 10, 1, 1)
    row = focal(
        frame(spark, z=z), grid, [LocalStats("z", 11, "m", "s")], Derivatives("z")
    ).first()
    assert (row.m, row.s, row.zx, row.zy, row.zxx) == (7.0, 0.0, 0.0, 0.0, 0.0)


def test_mirror_pad(spark):
    z = np.random.default_rng(2).normal(size=(5, 6))
    padded = mirror_pad(frame(spark, z=z), Grid(0, 0, 10, 5, 6), 2)
    got = {(r, c): v for r, c, v in padded.collect()}
    expected = np.pad(z, 2, mode="symmetric")
    assert len(got) == expected.size
    assert all(expected[r + 2, c + 2] == v for (r, c), v in got.items())


def test_terrain_keeps_nodata_and_fills_with_median(spark):
    z = np.random.default_rng(3).normal(300, 50, (12, 13))
    z[4, 5] = np.nan
    grid = Grid(0, 0, 10, 12, 13, tile=8)
    out = features.terrain(frame(spark, Elevation=z), grid)
    filled = np.where(np.isnan(z), np.nanmedian(z), z)
    tri = np.where(np.isnan(z), np.nan, np.abs(filled - box_mean(filled, 3)))
    assert np.allclose(array(out, "TRI", z.shape), tri, equal_nan=True)
    zy, zx = np.gradient(filled, 10.0, 10.0)
    slope = np.where(np.isnan(z), np.nan, np.degrees(np.arctan(np.hypot(zx, zy))))
    assert np.allclose(array(out, "Slope", z.shape), slope, equal_nan=True)


def test_flat_ground(spark):
    out = features.terrain(frame(spark, Elevation=np.full((12, 12), 5.0)), Grid(0, 0, 10, 12, 12))
    row = out.where("row = 6 AND col = 6").first()
    assert (row.Slope, row.PlanCurv, row.ProfCurv, row.TRI, row.TPI) == (0, 0, 0, 0, 0)
    assert (row.Aspect_sin, row.Aspect_cos) == (0.0, 1.0)


def test_feature_stack_needs_one_shuffle(spark):
    bands = {b: np.ones((4, 4)) for b in ("B02", "B03", "B04", "B08", "B11", "B12", "Elevation")}
    stack = features.feature_stack(frame(spark, **bands), Grid(0, 0, 10, 4, 4), fill=1.0)
    assert exchanges(stack) == 1


def upsampled(a, factor):
    height, width = a.shape
    out = np.full((height * factor, width * factor), np.nan)
    for r in range(height * factor):
        for c in range(width * factor):
            out[r, c] = bilinear(a, (r + 0.5) / factor - 0.5, (c + 0.5) / factor - 0.5)
    return out


def bilinear(a, y, x):
    r0, c0 = int(np.floor(y)), int(np.floor(x))
    total = weight = 0.0
    for dr in (0, 1):
        for dc in (0, 1):
            w = (y - r0 if dr else 1 - y + r0) * (x - c0 if dc else 1 - x + c0)
            v = a[np.clip(r0 + dr, 0, a.shape[0] - 1), np.clip(c0 + dc, 0, a.shape[1] - 1)]
            if not np.isnan(v):
                total, weight = total + v * w, weight + w
    return total / weight if weight > 1e-12 else np.nan


@pytest.mark.parametrize("factor", [2, 3])
def test_upsample_matches_brute_force(spark, factor):
    a = np.random.default_rng(4).normal(size=(7, 5))
    a[2, 2] = a[0, 0] = np.nan
    out = resample.upsample_bilinear(frame(spark, v=a), Grid(0, 0, 20, 7, 5, tile=4), factor, ["v"])
    assert out.count() == a.size * factor**2
    expected = upsampled(a, factor)
    assert np.allclose(array(out, "v", expected.shape), expected, equal_nan=True)


def test_mosaic_takes_first_valid(spark):
    rows = [(0, 0, 5.0, 2), (0, 0, None, 1), (0, 1, 1.0, 1), (0, 1, 2.0, 2), (0, 2, None, 1)]
    tiles = spark.createDataFrame(rows, "row INT, col INT, z DOUBLE, source_rank INT")
    got = {r.col: r.z for r in resample.mosaic(tiles, "z").collect()}
    assert got == {0: 5.0, 1: 1.0, 2: None}


def test_clip_to_aoi(spark):
    bounds = spark.createDataFrame(
        [("in", 0.0, 0.0, 10.0, 10.0), ("out", 50.0, 50.0, 60.0, 60.0)],
        "scene STRING, left DOUBLE, bottom DOUBLE, right DOUBLE, top DOUBLE",
    )
    row = resample.clip_to_aoi(bounds, (5, 5, 15, 15)).collect()
    assert [(r.scene, r.coverage_pct) for r in row] == [("in", 25.0)]
    with pytest.raises(Exception, match="does not intersect"):
        resample.clip_to_aoi(bounds, (5, 5, 15, 15), strict=True).collect()


@pytest.mark.parametrize("lost", ["row = 1 AND col = 2", "row = 0", "col = 5", "row = 5 AND col = 5", "tile_row = 1"])
def test_windows_refuse_a_raster_with_gaps(spark, lost):
    grid = Grid(0, 0, 10, 6, 6, tile=3)
    whole = grid.with_tiles(frame(spark, z=np.arange(36.0).reshape(6, 6)))
    stats = [LocalStats("z", 3, mean="m")]
    assert focal(whole, grid, stats).count() == 36
    with pytest.raises(Exception, match="every pixel once"):
        focal(whole.where(f"NOT ({lost})"), grid, stats).collect()
    filled = grid.densify(whole.where(f"NOT ({lost})").drop("tile_row", "tile_col")).fillna(0.0, "z")
    assert focal(filled, grid, stats).count() == 36
