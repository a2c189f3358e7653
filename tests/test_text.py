from pyspark.sql import functions as F

from tesserae.functions import text as T


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


def test_image_tokens_and_white_space(spark):
    assert one(spark, T.question_text(F.lit("<image>\n　图中有路吗？ "))) == "图中有路吗？"
    assert one(spark, T.strip_image_token(F.lit("a<image>\nb"))) == "ab"
    assert one(spark, T.question_text(F.lit("a<image>\nb"))) == "a\nb"
    assert one(spark, T.squeeze(F.lit(" a\x1c\t b　"))) == "a b"
    assert one(spark, T.strip(F.lit(None).cast("string"))) is None


def test_remap_image(spark):
    move = lambda p: one(spark, T.remap_image(F.lit(p), "/a/b", "/n"))
    assert [move(p) for p in ("/a/b/c.png", "/a/bX/c.png", "\\a\\b\\c.png", "/a//b/./c.png", "/a/b")] == ["/n/c.png", "/a/bX/c.png", "/n/c.png", "/n/c.png", "/n"]
    assert one(spark, T.remap_image(F.lit("/a/b/c.png"), "/a/b", "")) == "/a/b/c.png"


def test_paths(spark):
    p = F.lit("/d/EBD/storm-x/images/storm-x_00001_post_disaster.png")
    assert [one(spark, f(p)) for f in (T.event_of, T.event_image_of, T.event_status_of)] == ["storm-x", "00001", "post"]
    assert one(spark, T.folder_label(F.lit("x/Sea_Ice/a.png"))) == "sea ice" and one(spark, T.folder_label(F.lit("a.png"))) == ""
    assert one(spark, T.parent_folder(p, 2)) == "storm-x"
    assert one(spark, T.url_quote(F.lit("/a b/图+.png"))) == "/a%20b/%E5%9B%BE%2B.png"
    assert one(spark, T.mime_type(F.lit("a.PNG"))) == "image/png" and one(spark, T.mime_type(F.lit("a.tif"))) == "image/jpeg"


def test_natural_order(spark, rows):
    d = rows([("a10",), ("a9",), ("A1",), ("a010b",)], "s string")
    assert [r.s for r in d.orderBy(T.natural_key(F.col("s"))).collect()] == ["A1", "a9", "a10", "a010b"]


def test_counts(spark):
    assert one(spark, T.cjk_count(F.lit("图a图"))) == 2
    assert one(spark, T.cyrillic_count(F.lit("аб1"))) == 2
    assert one(spark, T.mojibake_count(F.lit("锘x"))) == 2


def test_flatten_content(rows):
    data = [(None,), ("null",), ('"  a "',), ('["a", {"text": "b"}, {"content": " c"}, {"text": ["d", {"text": "e"}]}, {}]',), ("plain",), ("12",)]
    assert [r.x for r in rows(data, "c string").select(T.flatten_content("c").alias("x")).collect()] == ["", "", "a", "a\nb\nc\nd\ne", "plain", "12"]
