"""Scans of image trees. Listing never reads pixels; pixels are decoded by Spark's own image source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths as P


def relative(path: Column, root: str) -> Column:
    plain = F.regexp_replace(path, r"^[a-z]+:/+", "/")
    base = "/" + root.split(":", 1)[-1].strip("/") if ":/" in root else root.rstrip("/")
    return F.when(plain == base, P.file_name(plain)).otherwise(F.substr(plain, F.lit(len(base) + 2)))


def list_files(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """path, name (relative to the root), length. Only the listing columns are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", glob).load(root)
    return files.select("path", relative(F.col("path"), root).alias("name"), "length")


def file_contents(spark: SparkSession, root: str) -> DataFrame:
    """name, content: whole files, unread until a filter on the name has been applied."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(relative(F.col("path"), root).alias("name"), "content")


def scan_names(listing: DataFrame, suffixes: tuple[str, ...] = P.IMAGE_SUFFIXES) -> DataFrame:
    return listing.filter(P.is_image(F.col("name"), suffixes))


def in_path_order(listing: DataFrame) -> DataFrame:
    """By components, as paths compare; :func:`in_text_order` compares the whole strings."""
    return listing.orderBy(P.parts(F.col("name")))


def in_text_order(listing: DataFrame) -> DataFrame:
    return listing.orderBy("name")


def require_some(listing: DataFrame, what: str = "images") -> DataFrame:
    if listing.isEmpty():
        raise FileNotFoundError(f"no {what} found")
    return listing


def read_images(spark: SparkSession, root: str, suffixes: tuple[str, ...] = P.IMAGE_SUFFIXES, invalid: str = "keep") -> DataFrame:
    """name, path, height, width, channels, data. invalid: keep (height -1), drop, or fail when one is read."""
    images = spark.read.format("image").option("recursiveFileLookup", True).option("dropInvalid", invalid == "drop").load(root)
    named = images.select(relative(F.col("image.origin"), root).alias("name"), F.col("image.origin").alias("path"), F.col("image.height").alias("height"), F.col("image.width").alias("width"), F.col("image.nChannels").alias("channels"), F.col("image.data").alias("data"))
    named = scan_names(named, suffixes)
    if invalid == "fail":
        return named.withColumn("height", F.when(F.col("height") < 0, F.raise_error(F.concat(F.lit("unreadable image: "), "path")).cast("int")).otherwise(F.col("height")))
    return named


def dimensions(images: DataFrame) -> DataFrame:
    """name, width, height; 0 for what cannot be read."""
    return images.select("name", *(F.greatest(F.coalesce(c, F.lit(0)), F.lit(0)).alias(c) for c in ("width", "height")))


def masks(spark: SparkSession, root: str) -> DataFrame:
    return in_text_order(list_files(spark, root, "*_mask.png"))


def patient_scans(listing: DataFrame) -> DataFrame:
    return listing.filter(P.is_patient_scan(F.col("name")))


def index_by_stem(listing: DataFrame, suffixes: tuple[str, ...] = tuple(s for s in P.IMAGE_SUFFIXES if s != "webp")) -> DataFrame:
    """stem, name: the first file of each stem in path order."""
    own = scan_names(listing, suffixes).withColumn("stem", P.stem(F.col("name")))
    return own.groupBy("stem").agg(F.min_by("name", P.parts(F.col("name"))).alias("name"))


def last_by_stem(listing: DataFrame) -> DataFrame:
    own = listing.withColumn("stem", P.stem(F.col("name")))
    return own.groupBy("stem").agg(F.max_by("name", P.parts(F.col("name"))).alias("name"))


def by_file_name(listing: DataFrame) -> DataFrame:
    """file, name: the last file of each name in path order, whatever its folder."""
    return listing.groupBy(P.file_name(F.col("name")).alias("file")).agg(F.max_by("name", P.parts(F.col("name"))).alias("name"))


def split_readable(images: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Images that were decoded, and name, error of those that were not."""
    failed = images.filter("height < 0").select("name", F.concat(F.lit("could not read image: "), "path").alias("error"))
    return images.filter("height >= 0"), failed


def candidate_images(masks_: DataFrame) -> DataFrame:
    """mask, candidates: where the image of a mask may be, best first. masks: mask, label_image (or null), root, mask_root."""
    base = F.regexp_replace("mask", r"_mask\.png$", "")
    beside = F.regexp_replace("mask", r"[^/]+$", "")
    named = F.col("label_image")
    in_root = F.concat_ws("/", "root", F.expr("substring(mask, length(mask_root) + 2)"))
    stem_in_root = F.regexp_replace(in_root, r"_mask\.png$", "")
    suffixes = [f".{s}" for s in P.IMAGE_SUFFIXES]
    options = [
        F.array(named), F.array(F.concat(beside, P.file_name(named))), F.array(F.concat_ws("/", "root", named)),
        F.array(*[F.concat(stem_in_root, F.lit(s)) for s in suffixes]), F.array(*[F.concat(base, F.lit(s)) for s in suffixes]),
    ]
    return masks_.select("mask", F.array_distinct(F.array_compact(F.concat(*options))).alias("candidates"))


def medical_format(path: Column) -> Column:
    """Which decoder a file needs; null for files that are skipped. DICOM and NIfTI need a plug-in."""
    lower = F.lower(path)
    return F.when(lower.endswith(".nii.gz") | lower.endswith(".nii"), "nifti").when(lower.endswith(".dcm"), "dicom").when(P.suffix(path).isin("png", "jpg", "jpeg"), "image")
