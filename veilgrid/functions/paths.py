"""Paths, names and short texts as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: File name suffixes of images that are read.
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "bmp", "tif", "tiff", "webp")
#: Media types of images sent to a model; others go as png.
MEDIA_TYPES = {"jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png", "bmp": "image/bmp", "tif": "image/tiff", "tiff": "image/tiff"}
#: What the keys of the review mean.
KEY_STATUS = {"y": "ok", "n": "bad", "s": "skip", "q": "quit"}


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """The file name without its last suffix; a leading dot begins no suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]+$", "")


def suffix(path: Column) -> Column:
    """The last suffix in lower case, without the dot; empty where there is none."""
    return F.lower(F.regexp_extract(file_name(path), r"(?<=.)\.([^.]+)$", 1))


def is_image(path: Column, suffixes: tuple[str, ...] = IMAGE_SUFFIXES) -> Column:
    return suffix(path).isin(*suffixes)


def parts(path: Column) -> Column:
    """The components of a path: their order is the order of paths, unlike that of the strings."""
    return F.split(path, "/")


def as_png(path: Column) -> Column:
    return F.regexp_replace(path, r"(?<=[^/])\.[^./]+$", ".png")


def png_path(path: Column) -> Column:
    """The path with its last suffix replaced by .png, or with .png where it has none."""
    return F.when(suffix(path) == "", F.concat(path, F.lit(".png"))).otherwise(as_png(path))


def mask_image_name(mask: Column, source_suffix: Column) -> Column:
    """The image name of a mask: without its mark, under the suffix of its source in lower case."""
    return F.concat(F.regexp_replace(mask, r"_mask\.[^./]+$", ""), F.lower(source_suffix))


def label_path(image: Column) -> Column:
    return F.concat(F.regexp_replace(image, r"(?<=[^/])\.[^./]+$", ""), F.lit("_labels.json"))


def is_patient_scan(path: Column) -> Column:
    return stem(path).rlike(r"^.*_patient_\d+$")


def model_file_name(model: Column) -> Column:
    return F.translate(model, "/", "_")


def output_path(source: Column, root: Column, target: Column) -> Column:
    """Where a result goes: below a target folder at the source's place, or at the target itself if it names a file.
    A source without suffix is written as png."""
    relative = F.when(root.isNull(), file_name(source)).otherwise(F.substr(source, F.length(root) + 2))
    named = F.when(suffix(relative) == "", F.concat(relative, F.lit(".png"))).otherwise(relative)
    return F.when((suffix(target) != "") & root.isNull(), target).otherwise(F.concat_ws("/", target, named))


def data_url(content: Column, path: Column) -> Column:
    pairs = [F.lit(x) for kv in MEDIA_TYPES.items() for x in kv]
    media = F.coalesce(F.try_element_at(F.create_map(*pairs), suffix(path)), F.lit("image/png"))
    return F.concat(F.lit("data:"), media, F.lit(";base64,"), F.translate(F.base64(content), "\r\n", ""))


def extract_json(reply: Column) -> Column:
    """The outermost braces of a model's reply, or an answer without detections if they hold no JSON."""
    inner = F.regexp_extract(F.trim(reply), r"(?s)\{.*\}", 0)
    return F.when((inner != "") & F.try_parse_json(inner).isNotNull(), inner).otherwise(F.lit('{"detections":[]}'))


def key_status(key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in KEY_STATUS.items() for x in kv]), F.lower(key))


def latex_number(x: Column, decimals: int = 3, missing: str = "--") -> Column:
    shown = F.replace(F.format_string(f"%.{decimals}f", x.cast("double")), F.lit("."), F.lit("{,}"))
    return F.when(x.isNull(), F.lit(missing)).otherwise(shown)


def joined_text(texts: Column, strip: bool = True) -> Column:
    """Texts joined by a bar; blank ones are left out."""
    shown = F.transform(texts, lambda t: F.trim(t)) if strip else texts
    return F.array_join(F.filter(shown, lambda t: F.trim(t) != ""), " | ")


def utc_now() -> Column:
    """The time of the query in UTC, to the second, as ISO text."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
