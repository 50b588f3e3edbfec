import numpy as np
import pytest
from pyspark.sql import functions as F

from radspark.functions import pixels as px
from radspark.operators import imaging, kernels as k, mammography as mg


@pytest.fixture(scope="module")
def breast():
    rng = np.random.default_rng(42)
    y, x = np.mgrid[:512, :256]
    inside = ((x - 50) / 75) ** 2 + ((y - 256) / 225) ** 2 <= 1
    a = np.where(inside, rng.uniform(0.2, 0.8, (512, 256)), 0) + rng.normal(0, 0.02, (512, 256))
    return np.clip(a, 0, 1).astype(np.float32)


def test_resizing():
    a = np.arange(64, dtype=np.float32).reshape(8, 8)
    assert k.resize((4, 4))(a).shape == (4, 4) and np.allclose(k.resize((4, 4))(a)[0, 0], a[:2, :2].mean())
    assert k.resize((16, 12))(a).shape == (16, 12) and np.allclose(k.resize((16, 16))(np.ones((8, 8), np.float32)), 1)
    assert k.resize((4, 8), keep_aspect=True)(a).shape == (4, 4)
    assert k.resize_pad((10, 20))(a).shape == (10, 20)
    assert k.pad_to((10, 12))(a)[1, 2] == 0 and k.pad_to((10, 12))(a).shape == (10, 12) and k.pad_to((4, 4))(a).shape == (4, 4)
    assert (k.center_crop((4, 4))(a) == a[2:6, 2:6]).all() and k.center_crop((10, 4))(a).shape == (10, 4)
    assert k.add_channel(a).shape == (1, 8, 8) and k.to_tensor(a.astype(np.float64)).dtype == np.float32


def test_intensity():
    rng = np.random.default_rng(0)
    a = rng.normal(5, 2, (32, 32)).astype(np.float32)
    z = k.intensity("z_score")(a)
    assert abs(z.mean()) < 1e-4 and abs(z.std() - 1) < 1e-4
    assert k.intensity("zero_one")(a).max() == 1 and k.intensity()(a).max() <= 1
    flat = np.full((4, 4), 3.0, np.float32)
    assert (k.intensity("z_score")(flat) == 3).all() and (k.normalise(flat, "z_score") == 0).all() and (k.normalise(flat, "min_max") == 0).all()
    with pytest.raises(ValueError):
        k.intensity("preset")
    assert np.allclose(k.intensity("preset", mean=1, std=2)(flat), 1) and (k.intensity("other")(flat) == flat).all()
    assert np.allclose(k.blur(4)(flat), 3) and k.blur(3)(a).std() < a.std()
    steps = k.from_config({"transforms": [{"name": "Resize", "params": {"target_size": [4, 4]}}, {"name": "IntensityNormalize", "params": {"method": "zero_one"}}, {"name": "AddChannelDim"}]})
    assert len(steps) == 3 and k.compose(steps)(a).shape == (1, 4, 4)
    with pytest.raises(ValueError):
        k.from_config({"transforms": [{"name": "None"}]})
    assert k.compose(k.mammography_preset((64, 32)))(a).shape == (1, 64, 32) and k.compose(k.ct_preset((16, 16), (5, 4)))(a).shape == (1, 16, 16)


def test_stored_values():
    v = np.array([0, 1023, 2047, 4095], np.uint16)
    assert np.allclose(k.normalise(v, "min_max")[[0, -1]], [0, 1]) and np.isclose(k.normalise(v, "fixed_range", 12).max(), 1)
    assert np.allclose(k.photometric(np.array([0, 0.5, 1], np.float32), "MONOCHROME1"), [1, 0.5, 0])
    assert (k.photometric(v, "MONOCHROME1") == 65535 - v).all() and (k.photometric(v, "RGB") == v).all()
    assert k.modality_lut(v, 0, None)[1] == 1023 and (k.modality_lut(np.array([0, 5, 99]), table=(4, [7, 8, 9])) == [7, 8, 9]).all()
    assert np.allclose(k.voi_window(v, [100, 2000], [0, 1000], index=5), np.clip((v - 1500.0) / 1000, 0, 1)) and (k.voi_window(v, 5, 0) == v).all()
    h = k.normalise(v, "histogram_eq")
    assert h.min() == 0 and h.max() == 1 and (k.equalise(np.ones(5)) == 0).all()
    with pytest.raises(ValueError):
        k.normalise(v, "none")
    assert k.Correction(dead_columns=(1,))(np.array([[1.0, 9, 3]]))[0, 1] == 2 and k.Correction(log_base=10)(np.array([100.0, 0]))[0] == 2


def test_native_equals_kernel(spark):
    rng = np.random.default_rng(1)
    images = [rng.normal(0, 1, (8, 8)) for _ in range(5)] + [np.full((8, 8), 2.0), np.zeros((8, 8))]
    df = spark.createDataFrame([(i, a.ravel().tolist()) for i, a in enumerate(images)], "i int, a array<double>")
    a = F.col("a")
    rows = df.select("i", px.min_max(a).alias("mm"), px.percentile_scale(a).alias("p"), px.z_score(a).alias("z"), px.equalise(a, 64).alias("h"), px.flip(a, 8, 8).alias("f"),
                     px.pad(a, 8, 8, 10, 12).alias("pad"), px.center_crop(a, 8, 8, 4, 6).alias("c"), px.window(a, 0.2, 1.0).alias("w")).collect()
    for r in rows:
        v = images[r["i"]]
        assert np.allclose(r["mm"], k.normalise(v, "min_max", clip_negative=False).ravel(), atol=1e-5)
        assert np.allclose(r["p"], k.normalise(v, "percentile", clip_negative=False).ravel(), atol=1e-4)
        assert np.allclose(r["z"], k.normalise(v, "z_score", clip_negative=False).ravel(), atol=1e-4)
        assert np.allclose(r["h"], k.equalise(v, 64).ravel(), atol=1e-6)
        assert np.allclose(r["f"], v[:, ::-1].ravel()) and np.allclose(r["pad"], k.pad_to((10, 12))(v).ravel()) and np.allclose(r["c"], k.center_crop((4, 6))(v).ravel()) and np.allclose(r["w"], k.voi_window(v, 0.2, 1.0).ravel())


def test_orientation_and_flip():
    a = np.zeros((100, 100), np.float32)
    a[:, :40] = 1
    assert mg.detect_orientation(a) == mg.LEFT and mg.detect_orientation(a[:, ::-1]) == mg.RIGHT and mg.detect_orientation(a * 0) == mg.UNKNOWN
    b, flipped = mg.normalise_laterality(a, "R")
    assert flipped and b[:, 60:].all() and not mg.normalise_laterality(a, None)[1]
    with pytest.raises(ValueError):
        mg.detect_orientation(a[None])


def test_masks(breast):
    m = mg.segment_breast(breast)
    assert m.dtype == np.uint8 and m.shape == breast.shape and set(np.unique(m)) <= {0, 255}
    y, x = np.mgrid[:512, :256]
    true = ((x - 50) / 75) ** 2 + ((y - 256) / 225) ** 2 <= 1
    assert ((m > 0) & true).sum() / true.sum() > 0.95 and ((m > 0) & ~true).sum() / true.sum() < 0.1
    c, box = mg.crop_to_breast(breast, m, 5)
    assert c.size < breast.size and c.shape == (box[2] - box[0], box[3] - box[1]) and mg.crop_to_breast(breast, m * 0)[1] == (0, 0, 512, 256)
    e = mg.clahe(breast)
    assert 0 <= e.min() and e.max() <= 1 and e.dtype == np.float32
    bright = breast.copy()
    bright[200:300, 20:100] = 1
    assert mg.detect_implant(bright, m)[0] and not mg.detect_implant(breast, m)[0] and mg.detect_implant(breast, m, known=True)[0] and mg.detect_implant(breast, m * 0, known=True) == (False, None)
    assert mg.segment_pectoral(breast, m, mg.LEFT).shape == breast.shape


def test_components_and_holes():
    m = np.zeros((20, 20), bool)
    m[2:10, 2:10] = True
    m[4:8, 4:8] = False
    m[12, 12] = m[13, 13] = True
    lab, n = mg.components(m)
    assert n == 2 and mg.fill_holes(lab == 1).sum() == 64 and mg.outline_area(mg.fill_holes(lab == 1)) == 49
    assert mg.dilate(m, 3)[11, 12] and not mg.erode(m, 3)[2, 2]


def test_process(spark, breast):
    out, x = mg.process(breast, "L", "MLO")
    assert out.ndim == 2 and x.view_position == "MLO" and x.orientation == mg.LEFT and x.breast_area_pixels > 0 and x.pectoral_mask is not None
    rows = [("a", imaging.encode(breast), "L", "CC"), ("b", None, "L", "CC"), ("c", imaging.encode(np.zeros((2, 3, 4), np.float32)), "R", "CC")]
    df = spark.createDataFrame(rows, f"key string, image {imaging.IMAGE}, side string, view string")
    got = {r["key"]: r for r in imaging.mammograms(df, "side", "view").collect()}
    assert got["a"]["analysis"]["view_position"] == "CC" and got["a"]["error"] is None and got["b"]["image"] is None and "2-D" in got["c"]["error"]
    t = {r["key"]: r for r in imaging.transform(df, k.mammography_preset((32, 16))).collect()}
    assert t["a"]["image"]["height"] == 32 and t["a"]["side"] == "L" and t["c"]["error"]
    s = imaging.statistics(df).where("key = 'a'").first()
    assert abs(s["mean"] - breast.mean()) < 1e-6 and s["pixels"] == breast.size
