import pytest

from broadleaf.sources import objects


def test_contained(tmp_path):
    (tmp_path / "a").mkdir()
    assert objects.contained(str(tmp_path), "a/b.json").name == "b.json"
    (tmp_path / "out").symlink_to("/")
    for bad in ("", "/etc/x", "../x", "a/../../x", "a\\b", "a//b", "out/x"):
        with pytest.raises(ValueError):
            objects.contained(str(tmp_path), bad)


def test_atomic_write_is_skipped_for_equal_bytes(spark, tmp_path):
    path = f"file://{tmp_path}/d/manifest.json"
    assert objects.write_atomic(spark, path, b"one") and not objects.write_atomic(spark, path, b"one") and objects.write_atomic(spark, path, b"two")
    assert (tmp_path / "d/manifest.json").read_bytes() == b"two" and not list((tmp_path / "d").glob("*.tmp"))


def test_objects_are_put_once(spark, tmp_path):
    key = "daily/2024/01/02/" + "0" * 64 + ".webp"
    df = spark.createDataFrame([(key, bytearray(b"x"))], "key string, content binary")
    root = f"file://{tmp_path}/o"
    assert [(r.key, r.written) for r in objects.ensured(df, root).collect()] == [(key, True)]
    assert [r.written for r in objects.ensured(df, root).collect()] == [False]
    assert [tuple(r) for r in objects.listed(spark, root).collect()] == [(key, 1)]
    with pytest.raises(Exception, match="invalid_object_key no/key"):
        objects.ensured(spark.createDataFrame([("no/key", bytearray(b"y"))], df.schema), root).collect()


def test_settings(spark):
    row = spark.range(1).select(objects.image_configuration(1, 2, 3).alias("c")).select("c.*").collect()[0]
    assert (row.conversion.quality, row.max_image_pixels, row.accepted_upstream_formats[0]) == (82, 2, "image/jpeg")
    assert objects.bounded("cap", "", 60, 1, 200) == 60
    with pytest.raises(ValueError):
        objects.bounded("cap", "0", 60, 1, 200)
