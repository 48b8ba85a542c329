"""Media results (FIXTURES section 7)."""

from tidewater.operators import media


def test_manifest(spark):
    files = media.media_files(spark.createDataFrame(
        [(1, "in/a%20b.jpg", 1), (2, "in/v.mp4", 2), (3, "in/x.gif", 3), (4, "in/w.mov", 4),
         (5, "other/a%20b.jpg", 5)], "asset long, key string, seq long"))
    det = spark.createDataFrame([(a, f"l{i}", float(i)) for a in (1, 2, 4, 5) for i in range(7)],
                                "asset long, label string, confidence double")
    failed = spark.createDataFrame([(4,)], "asset long")
    res = media.manifest(files, det, failed)
    got = {r.asset: r for r in res.collect()}
    assert got[1].labels == ["l6", "l5", "l4", "l3", "l2"] and got[1].status == "IMAGE_PROCESSED"
    assert len(got[2].labels) == 7 and got[2].status == "VIDEO_PROCESSED"
    assert got[3].status == "UNSUPPORTED" and got[3].labels is None
    assert got[4].status == "VIDEO_PROCESSING_FAILED"
    up = media.upsert_results(res).collect()
    assert len(up) == 4 and [r for r in up if r.fileName == "a b.jpg"][0].asset == 5
    assert media.notifications(res).count() == 5
