"""Ground truth: layout annotations in COCO form and JSON files named after their document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the order in which splits are searched.
SPLITS = ("train", "val", "test")
_COCO = "images array<struct<id:bigint,file_name:string>>, annotations array<struct<id:bigint,image_id:bigint,category_id:bigint,bbox:array<double>,area:double>>, categories array<struct<id:bigint,name:string>>"


def read_coco(spark: SparkSession, folder: str) -> DataFrame:
    """(split, images, annotations, categories) of the files {split}.json in a folder; missing ones are left out."""
    d = spark.read.schema(_COCO + ", _corrupt_record string").option("multiLine", True).json(folder, pathGlobFilter="*.json")
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1)
    return d.select(name.alias("split"), "images", "annotations", "categories").where(F.col("split").isin(*SPLITS))


def coco_annotations(coco: DataFrame) -> DataFrame:
    """(document_id, ord, annotation_id, category, category_id, x0, y0, x1, y1, area): the annotations of each image under its name without .png.

    An image is taken from the first split that has it, and the last image of a name in a split; it has no rows if that has no
    annotations. Unknown categories are ``unknown``; the box is null unless it has four numbers; ord is the place in the file.
    """
    rank = F.array_position(F.array(*map(F.lit, SPLITS)), F.col("split"))
    images = coco.select("split", F.posexplode("images").alias("n", "i")).where(F.col("i.file_name").endswith(".png"))
    images = images.select("split", rank.alias("rank"), "n", F.col("i.id").alias("image_id"), F.regexp_replace("i.file_name", r"\.png$", "").alias("document_id"))
    chosen = images.groupBy("document_id").agg(F.min_by(F.struct("split", "image_id"), F.struct("rank", -F.col("n"))).alias("c")).select("document_id", "c.split", "c.image_id")
    a = coco.select("split", F.posexplode("annotations").alias("ord", "a"))
    a = a.select("split", "ord", F.col("a.image_id").alias("image_id"), F.col("a.id").alias("annotation_id"), F.col("a.category_id").alias("category_id"), F.col("a.bbox").alias("bbox"), F.coalesce("a.area", F.lit(0.0)).alias("area"))
    names = coco.select("split", F.explode("categories").alias("c")).groupBy("split", F.col("c.id").alias("category_id")).agg(F.max("c.name").alias("category"))
    j = chosen.join(a, ["split", "image_id"]).join(names, ["split", "category_id"], "left")
    whole = F.size("bbox") == 4
    at = lambda k: F.try_element_at("bbox", F.lit(k))
    box = {"x0": at(1), "y0": at(2), "x1": at(1) + at(3), "y1": at(2) + at(4)}
    return j.select("document_id", "ord", F.col("annotation_id").cast("string").alias("annotation_id"), F.coalesce("category", F.lit("unknown")).alias("category"), "category_id", *(F.when(whole, c).alias(k) for k, c in box.items()), "area")


def ground_truth(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """(document_id, truth, error) of the files {id}.json in a folder; a file that isn't such an object has a null truth and an error."""
    d = spark.read.option("wholetext", True).text(folder, pathGlobFilter="*.json").select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1).alias("document_id"), "value")
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE"})
    t = d.withColumn("truth", parsed)
    empty = F.coalesce(F.to_json("truth"), F.lit("{}")) == "{}"
    return t.select("document_id", F.when(~empty, F.col("truth")).alias("truth"), F.when(empty, "unreadable ground truth").alias("error"))


def with_truth(results: DataFrame, truth: DataFrame, key: str = "document_id") -> DataFrame:
    """Results joined to their ground truth; one without is a failure row: success false, error "Ground truth not found"."""
    j = results.join(truth.select(key, "truth"), key, "left")
    missing = F.col("truth").isNull()
    return j.withColumn("error", F.when(missing & F.coalesce("success", F.lit(True)), "Ground truth not found").otherwise(F.col("error"))).withColumn("success", F.coalesce("success", F.lit(True)) & ~missing)
