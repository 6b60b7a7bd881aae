"""The registered queries over the derived relations, each with its DuckDB counterpart.

A query is a function of relations; its SQL is written against the same relations (see :mod:`veilgrid.plans.fixtures`).
Columns are flat and named alike on both sides; sums of doubles are rounded to six places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G
from ..functions import paths as P
from ..operators import cluster, evaluate, masks, models, records
from ..operators.detections import SHIPPED, filter_detections, redaction_boxes, sweep
from ..sources import images as I
from ..sources import schemas
from .fixtures import relation, with_sql

QueryFunction = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFunction] = {}
_SQL: dict[str, str] = {}

MARGIN = 5.0
PARAMS = SHIPPED.with_(max_area=60000.0)
MOST_AREA, AXIS_X, AXIS_Y = 60000, 0.45, 0.35


def query(sql: str):
    """Registers a query under the name of its function, and its counterpart."""

    def add(f: QueryFunction) -> QueryFunction:
        _QUERIES[f.__name__] = f
        _SQL[f.__name__] = with_sql(sql)
        return f

    return add


def queries() -> dict[str, QueryFunction]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- relations as the operators want them ----------------------------------------------------------------------------
def _rect() -> Column:
    return G.rect(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))


def _det(spark: SparkSession, sf: str) -> DataFrame:
    return relation(spark, sf, "det").withColumn("r", _rect())


def _boxes(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """gt or pred as img_id, ix, r (pred with w, h, conf)."""
    rows = relation(spark, sf, name).withColumn("r", _rect())
    return rows.drop("x1", "y1", "x2", "y2")


def _fractional() -> Column:
    """Corners of a detection a quarter, half or three quarters to the right, in a mixed order."""
    shift = (F.col("l_linenumber") % 4) * F.lit(0.25)
    x1, x2 = F.col("x1") + shift, F.col("x2") + shift
    y1, y2 = F.col("y1").cast("double"), F.col("y2").cast("double")
    return F.array(F.array(x2, y2), F.array(x1, y1), F.array(x2, y1), F.array(x1, y2))


_KEY = ["img_id", "ix"]
_SHIFT = "(l_linenumber % 4) * CAST(0.25 AS DOUBLE)"


def _flat(r: str = "r") -> list[Column]:
    return [F.col(f"{r}.{c}").alias(c) for c in ("x1", "y1", "x2", "y2")]


def _box_columns(b: str = "b") -> list[Column]:
    return [F.col(f"{b}.{c}").cast("long").alias(n) for c, n in (("x", "x"), ("y", "y"), ("w", "bw"), ("h", "bh"))]


# --- geometry --------------------------------------------------------------------------------------------------------
@query("SELECT img_id, ix, bw * bh AS area FROM {det}")
def box_area(spark, sf):
    return _det(spark, sf).select(*_KEY, G.box_area(G.box(F.col("x1"), F.col("y1"), F.col("bw"), F.col("bh"))).alias("area"))


@query(f"SELECT img_id, ix, x1 + {_SHIFT} AS x1, CAST(y1 AS DOUBLE) AS y1, x2 + {_SHIFT} AS x2, CAST(y2 AS DOUBLE) AS y2 FROM {{det}}")
def quad_to_rect(spark, sf):
    return _det(spark, sf).select(*_KEY, G.quad_to_rect(_fractional()).alias("r")).select(*_KEY, *_flat())


@query(f"""SELECT img_id, ix, CAST(round_even(x1 + {_SHIFT}, 0) AS BIGINT) AS left_x, y1 AS top_y, CAST(round_even(x2 + {_SHIFT}, 0) AS BIGINT) AS right_x, y2 AS bottom_y,
  CAST(round_even(x2 + {_SHIFT}, 0) AS BIGINT) AS second_x, CAST(round_even(x1 + {_SHIFT}, 0) AS BIGINT) AS fourth_x FROM {{det}}""")
def rect_to_quad(spark, sf):
    q = _det(spark, sf).select(*_KEY, G.rect_to_quad(G.quad_to_rect(_fractional())).alias("q"))
    at = lambda k, axis: F.col("q")[k][axis].cast("long")
    return q.select(*_KEY, at(0, 0).alias("left_x"), at(0, 1).alias("top_y"), at(2, 0).alias("right_x"), at(2, 1).alias("bottom_y"), at(1, 0).alias("second_x"), at(3, 0).alias("fourth_x"))


@query("SELECT img_id, ix, CAST(greatest(0, x2 - x1) * greatest(0, y2 - y1) AS DOUBLE) AS area FROM {gt}")
def rect_area(spark, sf):
    return _boxes(spark, sf, "gt").select(*_KEY, G.rect_area(F.col("r")).alias("area"))


@query("SELECT img_id, ix, CAST(x AS DOUBLE) AS x1, CAST(y AS DOUBLE) AS y1, CAST(x + bw AS DOUBLE) AS x2, CAST(y + bh AS DOUBLE) AS y2 FROM {gt_xywh}")
def xywh_to_rect(spark, sf):
    rows = relation(spark, sf, "gt_xywh")
    return rows.select(*_KEY, G.xywh_to_rect(G.box(F.col("x"), F.col("y"), F.col("bw"), F.col("bh"))).alias("r")).select(*_KEY, *_flat())


@query("""SELECT img_id, ix, coalesce(n[1], list_min(xs)) AS x1, coalesce(n[2], list_min(ys)) AS y1, coalesce(n[1] + n[3], list_max(xs)) AS x2, coalesce(n[2] + n[4], list_max(ys)) AS y2 FROM (
  SELECT img_id, ix, CASE WHEN len(n) = 4 AND len(list_filter(n, lambda v: v IS NULL)) = 0 AND n[3] > 0 AND n[4] > 0 THEN n END AS n, list_transform(p, lambda v: v[1]) AS xs, list_transform(p, lambda v: v[2]) AS ys FROM (
    SELECT img_id, ix, TRY_CAST(payload AS DOUBLE[]) AS n, TRY_CAST(payload AS DOUBLE[][]) AS p FROM (
      SELECT img_id, ix, CAST(CASE l_linenumber % 3 WHEN 0 THEN printf('[%d,%d,%d,%d]', x1, y1, bw, bh) WHEN 1 THEN printf('[[%d,%d],[%d,%d]]', x1, y1, x2, y2) ELSE '[1,2,"z",4]' END AS JSON) AS payload FROM {det})))""")
def box_payload_decode(spark, sf):
    number = lambda c: F.col(c).cast("string")
    as_box = F.concat(F.lit("["), F.concat_ws(",", number("x1"), number("y1"), number("bw"), number("bh")), F.lit("]"))
    as_points = F.concat(F.lit("[["), F.concat_ws(",", number("x1"), number("y1")), F.lit("],["), F.concat_ws(",", number("x2"), number("y2")), F.lit("]]"))
    payload = F.when(F.col("l_linenumber") % 3 == 0, as_box).when(F.col("l_linenumber") % 3 == 1, as_points).otherwise(F.lit('[1,2,"z",4]'))
    return _det(spark, sf).select(*_KEY, G.box_payload(payload).alias("r")).select(*_KEY, *_flat())


@query("""SELECT img_id, ix, x1 AS x, y1 AS y, CAST(trunc(bw + CAST(0.75 AS DOUBLE)) AS BIGINT) AS bw, bh FROM {det} WHERE l_linenumber % 4 <> 3""")
def paddle_boxes(spark, sf):
    """Replies of three forms: a list within a list, a bare list of lines, and one whose quad holds no numbers."""
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    line = text("[[[", x1, ".25,", y1, ".5],[", x2 + 1, ",", y1, ".5],[", x2 + 1, ",", y2, ".5],[", x1, ".25,", y2, '.5]],["t",0.9]]')
    bad = F.lit('[[["a",1],[2,3]],["t",0.5]]')
    k = F.col("l_linenumber") % 4
    reply = F.when(k == 0, text("[[", line, "]]")).when(k == 1, text("[", line, ",", bad, "]")).when(k == 2, text("[[", bad, ",null,", line, "]]")).otherwise(text("[[", bad, "]]"))
    each = _det(spark, sf).select(*_KEY, F.explode(G.paddle_boxes(reply)).alias("b"))
    return each.select(*_KEY, *_box_columns())


def _raw_boxes(spark, sf) -> DataFrame:
    raw = F.array(*(F.col(c).cast("double") for c in ("x1", "y1", "bw", "bh")))
    raw = F.when(F.col("q") % 5 == 0, F.slice(raw, 1, 3)).otherwise(raw)
    return _det(spark, sf).groupBy("img_id").agg(F.array_sort(F.collect_list(F.struct("ix", raw.alias("b")))).alias("all")).select("img_id", F.transform("all", lambda s: s["b"]).alias("raw"))


@query("""SELECT img_id, CAST(row_number() OVER (PARTITION BY img_id ORDER BY bw * bh DESC, ix) - 1 AS BIGINT) AS pos, x1 AS x, y1 AS y, bw, bh FROM {det} WHERE q % 5 <> 0""")
def deserialize_boxes(spark, sf):
    each = _raw_boxes(spark, sf).select("img_id", F.posexplode(G.deserialize_boxes(F.col("raw"))).alias("pos", "b"))
    return each.select("img_id", F.col("pos").cast("long").alias("pos"), *_box_columns())


@query("""SELECT img_id, ix, l AS x, t AS y, rr - l AS bw, b - t AS bh FROM (
  SELECT img_id, ix, least(greatest(x1 - 300, 0), w) AS l, least(greatest(x2 - 300, 0), w) AS rr, least(greatest(y1 - 30, 0), h) AS t, least(greatest(y2 - 30, 0), h) AS b FROM {det})
WHERE rr > l AND b > t""")
def xyxy_clamp_boxes(spark, sf):
    moved = [F.col("x2") - 300, F.col("y1") - 30, F.col("x1") - 300, F.col("y2") - 30]
    return _det(spark, sf).select(*_KEY, G.xyxy_to_clamped_box(*moved, F.col("w"), F.col("h")).alias("b")).filter("b is not null").select(*_KEY, *_box_columns())


@query("""SELECT img_id, ix, l AS x, t AS y, rr - l AS bw, b - t AS bh FROM (
  SELECT img_id, ix, greatest(0, x1 - 10) AS l, greatest(0, y1 - 10) AS t, least(w, x2 + 10) AS rr, least(h, y2 + 10) AS b FROM {det}) WHERE rr > l AND b > t""")
def pad_clamp_boxes(spark, sf):
    return _det(spark, sf).select(*_KEY, G.pad_and_clamp(F.col("r"), 10, F.col("w"), F.col("h")).alias("b")).filter("b is not null").select(*_KEY, *_box_columns())


@query(f"""SELECT img_id, ix, CAST(round_even(x2 + {_SHIFT}, 0) AS BIGINT) AS first_x, y2 AS first_y, text, conf AS prob FROM {{det}} WHERE l_linenumber % 2 = 0""")
def parse_detections(spark, sf):
    quad = F.when(F.col("l_linenumber") % 2 == 0, _fractional()).otherwise(F.slice(_fractional(), 1, 3))
    raw = F.array(F.struct(quad.alias("quad"), F.col("text"), F.col("conf").alias("prob")))
    each = _det(spark, sf).select(*_KEY, F.explode(G.parse_detections(raw)).alias("d"))
    return each.select(*_KEY, F.col("d.quad")[0][0].cast("long").alias("first_x"), F.col("d.quad")[0][1].cast("long").alias("first_y"), "d.text", "d.prob")


@query("""SELECT img_id, ix, round(CASE WHEN a > 45 THEN 90 - a WHEN a < -45 THEN -90 - a ELSE -a END, 6) + 0.0 AS angle FROM (
  SELECT img_id, ix, CASE WHEN d > 90 THEN d - 180 WHEN d <= -90 THEN d + 180 ELSE d END AS a FROM (
    SELECT img_id, ix, degrees(CASE WHEN side > 1 THEN atan2(dx * side, -dy * side) ELSE atan2(dy, dx) END) AS d FROM (
      SELECT img_id, ix, CAST(l_partkey % 50 - 25 AS DOUBLE) AS dx, CAST((3 + l_suppkey % 40) * (1 - 2 * (l_partkey % 2)) AS DOUBLE) AS dy,
        CASE l_linenumber % 3 WHEN 0 THEN CAST(0.25 AS DOUBLE) WHEN 1 THEN CAST(1 AS DOUBLE) ELSE CAST(2 AS DOUBLE) END AS side FROM {det})))""")
def rotation_to_zero(spark, sf):
    """Turned rectangles whose first edge is the longest, as long as the second, or the shorter one, upwards and downwards."""
    x, y, dx = F.lit(500.0), F.lit(300.0), (F.col("l_partkey") % 50 - 25).cast("double")
    dy = ((3 + F.col("l_suppkey") % 40) * (1 - 2 * (F.col("l_partkey") % 2))).cast("double")
    side = F.when(F.col("l_linenumber") % 3 == 0, 0.25).when(F.col("l_linenumber") % 3 == 1, 1.0).otherwise(2.0)
    quad = F.array(F.array(x, y), F.array(x + dx, y + dy), F.array(x + dx - dy * side, y + dy + dx * side), F.array(x - dy * side, y + dx * side))
    return _det(spark, sf).select(*_KEY, (F.round(G.rotation_to_zero(quad), 6) + 0.0).alias("angle"))


@query("""SELECT img_id, ix, l AS x1, t AS y1, r AS x2, b AS y2, greatest(31, ((greatest(b - t, r - l) // 2) | 1)) AS kernel FROM (
  SELECT img_id, ix, greatest(0, x1 - 12) AS l, greatest(0, y1 - 12) AS t, least(w, x2 + 12) AS r, least(h, y2 + 12) AS b FROM {det})""")
def blur_roi(spark, sf):
    roi = _det(spark, sf).select(*_KEY, G.blur_roi(F.col("r"), F.col("w"), F.col("h")).alias("b"))
    return roi.select(*_KEY, *(F.col(f"b.{c}").cast("long").alias(c) for c in ("x1", "y1", "x2", "y2", "kernel")))


@query("SELECT img_id, ix, CASE WHEN l_linenumber % 3 = 0 THEN 0.0 ELSE round(CAST(bw AS DOUBLE) / CAST(l_linenumber % 3 AS DOUBLE), 6) END AS ratio FROM {det}")
def safe_div(spark, sf):
    return _det(spark, sf).select(*_KEY, F.round(G.safe_div(F.col("bw"), F.col("l_linenumber") % 3), 6).alias("ratio"))


@query("SELECT img_id, round(least(1500.0 / CAST(w AS DOUBLE), 900.0 / CAST(h AS DOUBLE), 1.0), 6) AS scale FROM {scan}")
def fit_scale(spark, sf):
    return relation(spark, sf, "scan").select("img_id", F.round(G.fit_scale(F.col("w").cast("double"), F.col("h").cast("double")), 6).alias("scale"))


@query("SELECT img_id, ix, x1 AS x, y1 AS y, bw, bh, trim(text) AS text FROM {det} WHERE q % 4 <> 0")
def vlm_boxes(spark, sf):
    bbox = F.array(F.col("x1"), F.col("y1"), F.when(F.col("q") % 4 == 0, F.lit(0)).otherwise(F.col("bw")), F.col("bh"))
    reply = F.concat(F.lit("Here: ```json\n"), F.to_json(F.struct(F.array(F.struct(F.trim("text").alias("text"), bbox.alias("bbox"))).alias("detections"))), F.lit("\n``` done"))
    replies = _det(spark, sf).select(F.struct(*_KEY).alias("name"), reply.alias("reply"), F.lit(None).cast("string").alias("error"))
    each = models.vlm_records(replies).select("name.*", F.explode("boxes").alias("b"))
    return each.select(*_KEY, *_box_columns(), "b.text")


@query("SELECT img_id, ix, x1 AS x, y1 AS y, bw, bh FROM {det} WHERE img_id % 3 <> 0 AND q % 6 <> 0")
def label_boxes_norm(spark, sf):
    box = F.when(F.col("q") % 6 == 0, F.array(F.col("x1").cast("double"))).otherwise(F.array(*(F.col(c).cast("double") for c in ("x2", "y2", "x1", "y1"))))
    labels = _det(spark, sf).filter("img_id % 3 <> 0").select(*_KEY, "w", "h", box.alias("b"))
    scans = _det(spark, sf).select(*_KEY)
    joined = scans.join(labels, _KEY, "left").filter(F.size("b") == 4)
    return joined.select(*_KEY, G.xyxy_to_clamped_box(*(F.col("b")[k] for k in range(4)), F.lit(10**6), F.lit(10**6)).alias("b")).select(*_KEY, *_box_columns())


@query("""SELECT img_id, ix, round(cos(radians(a)) * (x1 - w / CAST(2 AS DOUBLE)) + sin(radians(a)) * (y1 - h / CAST(2 AS DOUBLE)) + w / CAST(2 AS DOUBLE), 4) AS x,
  round(-sin(radians(a)) * (x1 - w / CAST(2 AS DOUBLE)) + cos(radians(a)) * (y1 - h / CAST(2 AS DOUBLE)) + h / CAST(2 AS DOUBLE), 4) AS y
FROM (SELECT *, CAST(l_partkey % 61 - 30 AS DOUBLE) AS a FROM {det})""")
def rotate_points(spark, sf):
    cx, cy = F.col("w") / F.lit(2.0), F.col("h") / F.lit(2.0)
    p = G.rotate_point(F.col("x1"), F.col("y1"), cx, cy, (F.col("l_partkey") % 61 - 30).cast("double"))
    return _det(spark, sf).select(*_KEY, p.alias("p")).select(*_KEY, F.round("p.x", 4).alias("x"), F.round("p.y", 4).alias("y"))


# --- names and paths -------------------------------------------------------------------------------------------------
_FILE = "string_split(name, '/')[-1]"
_SUFFIX = f"lower(regexp_extract({_FILE}, '^.+\\.([^.]+)$', 1))"
_STEM = f"regexp_replace({_FILE}, '^(.+)\\.[^.]+$', '\\1')"
_IMAGES = "('jpg', 'jpeg', 'png', 'bmp', 'tif', 'tiff', 'webp')"


@query(f"SELECT img_id, {_STEM} AS stem FROM {{scan}}")
def path_stem(spark, sf):
    return relation(spark, sf, "scan").select("img_id", P.stem(F.col("name")).alias("stem"))


@query("SELECT img_id, regexp_replace(name, '\\.[^./]+$', '.png') AS png FROM {scan}")
def relpath_png(spark, sf):
    return relation(spark, sf, "scan").select("img_id", P.png_path(F.col("name")).alias("png"))


@query(f"SELECT img_id, regexp_replace(name, '\\.[^./]+$', '') || '.' || {_SUFFIX} AS name FROM {{scan}}")
def mask_rel_name(spark, sf):
    mask = F.concat(F.regexp_replace("name", r"\.[^./]+$", ""), F.lit("_mask.png"))
    return relation(spark, sf, "scan").select("img_id", P.mask_image_name(mask, F.concat(F.lit("."), F.regexp_extract("name", r"\.([^./]+)$", 1))).alias("name"))


@query("""SELECT img_id, CASE WHEN img_id % 3 = 2 THEN '{"detections":[]}' ELSE '{"n":' || CAST(img_id AS VARCHAR) || '}' END AS json FROM {scan}""")
def extract_json(spark, sf):
    inner = F.concat(F.lit('{"n":'), F.col("img_id").cast("string"), F.lit("}"))
    reply = F.when(F.col("img_id") % 3 == 0, F.concat(F.lit("```json\n"), inner, F.lit("\n```"))).when(F.col("img_id") % 3 == 1, F.concat(F.lit(" so: "), inner, F.lit(" ."))).otherwise(F.lit('{"detections": [{'))
    return relation(spark, sf, "scan").select("img_id", P.extract_json(reply).alias("json"))


@query(f"""SELECT img_id, 'data:' || (CASE {_SUFFIX} WHEN 'jpg' THEN 'image/jpeg' WHEN 'jpeg' THEN 'image/jpeg' WHEN 'tif' THEN 'image/tiff' ELSE 'image/png' END)
  || ';base64,' || base64(encode(repeat(name, 4))) AS url FROM {{scan}}""")
def base64_data_url(spark, sf):
    content = F.encode(F.repeat("name", 4), "utf-8")
    return relation(spark, sf, "scan").select("img_id", P.data_url(content, F.col("name")).alias("url"))


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN 'ok' WHEN 'view' THEN 'bad' WHEN 'signup' THEN 'skip' WHEN 'purchase' THEN 'quit' END AS status FROM {events}""")
def key_status_map(spark, sf):
    key = F.when(F.col("event_type") == "click", "Y").when(F.col("event_type") == "view", "n").when(F.col("event_type") == "signup", "s").when(F.col("event_type") == "purchase", "Q").otherwise("x")
    return relation(spark, sf, "events").select("event_id", P.key_status(key).alias("status"))


@query("""SELECT img_id, ix, CASE WHEN l_linenumber = 7 THEN '--' ELSE replace(printf('%.3f', CAST(x1 AS DOUBLE) / 8), '.', '{,}') END AS cell FROM {det}""".replace("{,}", "{{,}}").replace("{{,}}", "{,}"))
def latex_cells(spark, sf):
    value = F.when(F.col("l_linenumber") != 7, F.col("x1").cast("double") / 8)
    return _det(spark, sf).select(*_KEY, P.latex_number(value).alias("cell"))


@query(f"SELECT img_id, name FROM {{scan}} WHERE {_SUFFIX} IN {_IMAGES}")
def scan_filter_suffix(spark, sf):
    return I.scan_names(relation(spark, sf, "scan")).select("img_id", "name")


@query(f"SELECT img_id, name FROM {{scan}} WHERE regexp_matches({_STEM}, '^.*_patient_\\d+$')")
def scan_patient_regex(spark, sf):
    return I.patient_scans(relation(spark, sf, "scan")).select("img_id", "name")


@query(f"""SELECT img_id, CASE WHEN img_id % 4 = 0 THEN 'out/one.png' ELSE 'out/' || {_FILE} END AS target FROM {{scan}}""")
def output_path_case(spark, sf):
    target = F.when(F.col("img_id") % 4 == 0, "out/one.png").otherwise("out")
    return relation(spark, sf, "scan").select("img_id", P.output_path(F.col("name"), F.lit(None).cast("string"), target).alias("target"))


@query("""SELECT img_id, CAST(row_number() OVER (ORDER BY string_split(name, '/')) AS BIGINT) AS path_rank, CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS text_rank FROM {scan}""")
def scan_order(spark, sf):
    """Ranks over the whole listing by both orders, without one task for all rows."""
    names = relation(spark, sf, "scan").select("img_id", "name", P.parts(F.col("name")).alias("parts"))
    by_path = records.global_rank(names, "parts", "path_rank").select("img_id", "path_rank")
    return by_path.join(records.global_rank(names, "name", "text_rank").select("img_id", "text_rank"), "img_id")


# --- filters ---------------------------------------------------------------------------------------------------------
def _duck_ellipse(table: str = "") -> str:
    return f"""(power2((least(greatest(w / CAST(2 AS DOUBLE), x1), x2) - w / CAST(2 AS DOUBLE)) / greatest(1.0, w * CAST({AXIS_X} AS DOUBLE)))
  + power2((least(greatest(h / CAST(2 AS DOUBLE), y1), y2) - h / CAST(2 AS DOUBLE)) / greatest(1.0, h * CAST({AXIS_Y} AS DOUBLE)))) <= 1.0"""


def _squares(sql: str) -> str:
    """power2(x) is written out as a product, as Spark's side multiplies."""
    out, at = "", 0
    while (k := sql.find("power2(", at)) >= 0:
        depth, end = 1, k + 7
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = sql[k + 7 : end - 1]
        out += sql[at:k] + f"(({inner}) * ({inner}))"
        at = end
    return out + sql[at:]


_ELLIPSE = _squares(_duck_ellipse())
_KEPT = f"bw * bh <= {MOST_AREA} AND NOT ({_ELLIPSE})"


@query(f"SELECT img_id, ix FROM {{det}} WHERE bw * bh <= {MOST_AREA}")
def filter_max_area(spark, sf):
    return _det(spark, sf).filter(G.within_area(F.col("r"), float(MOST_AREA))).select(*_KEY)


@query(f"SELECT img_id, ix FROM {{det}} WHERE NOT ({_ELLIPSE})")
def filter_center_ellipse(spark, sf):
    return filter_detections(_det(spark, sf), PARAMS.with_(max_area=None)).select(*_KEY)


@query(f"SELECT img_id, ix FROM {{det}} WHERE {_KEPT}")
def filter_detections_query(spark, sf):
    return filter_detections(_det(spark, sf), PARAMS).select(*_KEY)


for _registry in (_QUERIES, _SQL):  # the operator has the same name
    _registry["filter_detections"] = _registry.pop("filter_detections_query")

_CENTER = _squares("""power2(((x1 + x2) / CAST(2 AS DOUBLE) - w / CAST(2 AS DOUBLE)) / (w / CAST(2 AS DOUBLE) * CAST(0.78 AS DOUBLE)))
 + power2(((y1 + y2) / CAST(2 AS DOUBLE) - h / CAST(2 AS DOUBLE)) / (h / CAST(2 AS DOUBLE) * CAST(0.72 AS DOUBLE))) <= 1.0""")


@query(f"SELECT img_id, ix FROM {{det}} WHERE {_CENTER}")
def ellipse_center_point(spark, sf):
    return _det(spark, sf).filter(G.center_in_ellipse(F.col("r"), F.col("w").cast("double"), F.col("h").cast("double"))).select(*_KEY)


@query("SELECT img_id, ix FROM {det} WHERE CASE WHEN l_linenumber = 7 THEN 0.0 ELSE conf END >= 0.5")
def pred_min_confidence(spark, sf):
    return _det(spark, sf).filter(F.coalesce(F.when(F.col("l_linenumber") != 7, F.col("conf")), F.lit(0.0)) >= 0.5).select(*_KEY)


@query("SELECT img_id, ix FROM {det} WHERE l_linenumber = 7 OR conf >= 0.5")
def score_filter_nan(spark, sf):
    score = F.when(F.col("l_linenumber") == 7, F.lit(float("nan"))).otherwise(F.col("conf"))
    return _det(spark, sf).withColumn("score", score).filter(records.score_passes(F.col("score"), 0.5)).select(*_KEY)


@query("""SELECT img_id, count(*) FILTER (CAST(bw * bh AS DOUBLE) >= CAST(0.1 AS DOUBLE) * CAST(w * h AS DOUBLE)) AS n_large,
  count(*) FILTER (CAST(bw * bh AS DOUBLE) >= CAST(0.1 AS DOUBLE) * CAST(w * h AS DOUBLE)) > 1 AS triggered FROM {det} GROUP BY img_id""")
def alarm_large_boxes(spark, sf):
    return masks.alarm(_det(spark, sf), 0.1)


# --- clusters --------------------------------------------------------------------------------------------------------
_CLOSE = "b.x1 - a.x2 <= 10 AND a.x1 - b.x2 <= 10 AND b.y1 - a.y2 <= 10 AND a.y1 - b.y2 <= 10"


@query(f"SELECT a.img_id, a.ix AS i, b.ix AS j FROM {{det}} a JOIN {{det}} b ON a.img_id = b.img_id AND a.ix < b.ix AND {_CLOSE}")
def close_pairs(spark, sf):
    return cluster.close_pairs(_det(spark, sf), 10.0)


_MERGED = f"""WITH RECURSIVE kept AS (SELECT * FROM {{det}} WHERE {_KEPT}),
linked AS (SELECT a.img_id, a.ix AS s, b.ix AS d FROM kept a JOIN kept b ON a.img_id = b.img_id AND {_CLOSE}),
reach AS (SELECT img_id, s, d FROM linked UNION SELECT reach.img_id, reach.s, linked.d FROM reach JOIN linked ON reach.img_id = linked.img_id AND reach.d = linked.s),
rooted AS (SELECT img_id, s AS ix, min(d) AS root FROM reach GROUP BY img_id, s),
groups AS (SELECT k.img_id, r.root, min(k.w) AS w, min(k.h) AS h, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2, max(conf) AS conf, count(*) AS n,
  coalesce(string_agg(trim(text), ' | ' ORDER BY k.ix) FILTER (trim(text) <> ''), '') AS text
  FROM kept k JOIN rooted r ON k.img_id = r.img_id AND k.ix = r.ix GROUP BY k.img_id, r.root),
placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY img_id ORDER BY y1, x1, root) - 1 AS BIGINT) AS pos FROM groups)
SELECT img_id, pos, greatest(0, x1 - 10) AS x, greatest(0, y1 - 10) AS y, least(w, x2 + 10) - greatest(0, x1 - 10) AS bw, least(h, y2 + 10) - greatest(0, y1 - 10) AS bh, text, conf, n
FROM placed WHERE least(w, x2 + 10) > greatest(0, x1 - 10) AND least(h, y2 + 10) > greatest(0, y1 - 10)"""


@query(_MERGED)
def merge_close_detections(spark, sf):
    """The redaction decision as a whole: filter, merge, pad and clamp."""
    out = redaction_boxes(_det(spark, sf), PARAMS)
    return out.select("img_id", *(F.col(c).cast("long").alias(c) for c in ("pos", "x", "y", "bw", "bh")), "text", "conf", F.col("n").cast("long").alias("n"))


# --- joins of records ------------------------------------------------------------------------------------------------
@query("""WITH s AS (SELECT name, arg_max(sam_time, pos) AS sam_time FROM {sam} GROUP BY name), d AS (SELECT name, arg_max(deid_time, pos) AS deid_time FROM {deid} GROUP BY name)
SELECT p.name, coalesce(p.sam_time, s.sam_time, 0.0) AS sam_time, p.post_time, coalesce(d.deid_time, 0.0) AS deid_time, s.name IS NOT NULL AS has_sam, d.name IS NOT NULL AS has_deid
FROM {post} p LEFT JOIN s ON p.name = s.name LEFT JOIN d ON p.name = d.name""")
def report_left_join(spark, sf):
    return records.report(*(relation(spark, sf, n) for n in ("post", "sam", "deid")))


_COVERAGE = f"""SELECT g.img_id, g.ix, max(CASE WHEN p.img_id IS NULL OR (g.x2 - g.x1) * (g.y2 - g.y1) <= 0 THEN 0.0 ELSE least(1.0,
  greatest(0.0, least(g.x2, p.x2 + {MARGIN}) - greatest(g.x1, p.x1 - {MARGIN})) * greatest(0.0, least(g.y2, p.y2 + {MARGIN}) - greatest(g.y1, p.y1 - {MARGIN})) / ((g.x2 - g.x1) * (g.y2 - g.y1))) END) AS coverage
FROM {{gt}} g LEFT JOIN {{pred}} p ON g.img_id = p.img_id GROUP BY g.img_id, g.ix"""
_OUTSIDE = f"""SELECT p.img_id, p.ix FROM {{pred}} p WHERE NOT EXISTS (SELECT 1 FROM {{gt}} g WHERE g.img_id = p.img_id
  AND p.x1 <= g.x2 + {MARGIN} AND g.x1 - {MARGIN} <= p.x2 AND p.y1 <= g.y2 + {MARGIN} AND g.y1 - {MARGIN} <= p.y2)"""
_PER_IMAGE = f"""cov AS ({_COVERAGE}), outs AS ({_OUTSIDE}),
g AS (SELECT img_id, count(*) AS n_gt FROM {{gt}} GROUP BY img_id), p AS (SELECT img_id, count(*) AS n_pred FROM {{pred}} GROUP BY img_id),
c AS (SELECT img_id, sum(coverage) AS total, count(*) FILTER (coverage >= 0.999999) AS n_full, count(*) FILTER (coverage <= 0) AS n_uncovered FROM cov GROUP BY img_id),
o AS (SELECT img_id, count(*) AS n_outside FROM outs GROUP BY img_id),
per AS (SELECT coalesce(g.img_id, p.img_id) AS img_id, coalesce(n_gt, 0) AS n_gt, coalesce(n_pred, 0) AS n_pred, coalesce(total, 0.0) AS total, coalesce(n_full, 0) AS n_full,
  coalesce(n_uncovered, 0) AS n_uncovered, coalesce(n_outside, 0) AS n_outside
  FROM g FULL OUTER JOIN p ON g.img_id = p.img_id LEFT JOIN c ON c.img_id = coalesce(g.img_id, p.img_id) LEFT JOIN o ON o.img_id = coalesce(g.img_id, p.img_id))"""
_RATES = """CAST(sum(n_gt) AS BIGINT) AS n_gt, CAST(sum(n_pred) AS BIGINT) AS n_pred, CAST(sum(n_full) AS BIGINT) AS n_full, CAST(sum(n_uncovered) AS BIGINT) AS n_uncovered, CAST(sum(n_outside) AS BIGINT) AS n_outside,
  round(coalesce(sum(total) / nullif(sum(n_gt), 0), 0.0), 6) AS coverage, round(coalesce(sum(n_full) / CAST(nullif(sum(n_gt), 0) AS DOUBLE), 0.0), 6) AS full_rate,
  round(coalesce(sum(n_outside) / CAST(nullif(sum(n_pred), 0) AS DOUBLE), 0.0), 6) AS outside_rate"""


def _evaluated(spark, sf) -> DataFrame:
    return evaluate.per_image(_boxes(spark, sf, "gt"), _boxes(spark, sf, "pred"), MARGIN)


@query(f"SELECT img_id, ix, round(coverage, 6) AS coverage FROM ({_COVERAGE})")
def gt_best_coverage(spark, sf):
    return evaluate.best_coverage(_boxes(spark, sf, "gt"), _boxes(spark, sf, "pred"), MARGIN, "img_id").select(*_KEY, F.round("coverage", 6).alias("coverage"))


@query(_OUTSIDE)
def pred_outside_gt(spark, sf):
    return evaluate.outside(_boxes(spark, sf, "gt"), _boxes(spark, sf, "pred"), MARGIN, "img_id").select(*_KEY)


@query(f"WITH {_PER_IMAGE} SELECT img_id, n_gt, n_pred FROM per")
def eval_full_outer(spark, sf):
    return evaluate.universe(_boxes(spark, sf, "gt"), _boxes(spark, sf, "pred"))


@query("SELECT img_id, name FROM {scan} s WHERE EXISTS (SELECT 1 FROM {gt} g WHERE g.img_id = s.img_id)")
def crops_semi_gt(spark, sf):
    return relation(spark, sf, "scan").join(relation(spark, sf, "gt").select("img_id"), "img_id", "left_semi").select("img_id", "name")


_LATEST = "SELECT relpath, arg_max(status, pos) AS status FROM {decisions} WHERE trim(relpath) <> '' GROUP BY relpath"


def _reviewable(spark, sf) -> DataFrame:
    return relation(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("relpath"))


@query(f"SELECT CAST(c_custkey AS VARCHAR) AS relpath FROM {{customer}} WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT relpath FROM ({_LATEST}) WHERE status IN ('ok', 'bad'))")
def pending_review_anti(spark, sf):
    return records.pending(_reviewable(spark, sf), relation(spark, sf, "decisions"))


@query("SELECT s.img_id, s.name AS relpath, p.name IS NULL AS missing FROM {scan} s LEFT JOIN {post} p ON p.name = s.img_id")
def scan_processed_left(spark, sf):
    names = relation(spark, sf, "scan").select("img_id", F.col("name").alias("relpath"))
    done = names.join(relation(spark, sf, "post").select(F.col("name").alias("img_id")), "img_id", "left_semi").select("relpath")
    return records.with_processed(names, done)


@query("SELECT img_id, regexp_replace(name, '\\.[^./]+$', '') || '_labels.json' AS label FROM {scan} WHERE img_id % 3 <> 0")
def image_label_inner(spark, sf):
    names = relation(spark, sf, "scan").withColumn("label", P.label_path(F.col("name")))
    labels = names.filter("img_id % 3 <> 0").select("label").distinct()
    return names.join(labels, "label").select("img_id", "label")


@query("""SELECT img_id, CASE WHEN img_id % 3 = 0 THEN 'first/' WHEN img_id % 3 = 1 THEN 'second/' ELSE 'third/' END || name AS path FROM {scan} WHERE img_id % 5 <> 0""")
def resolve_priority(spark, sf):
    names = relation(spark, sf, "scan")
    at = lambda folder: F.concat(F.lit(f"{folder}/"), "name")
    candidates = names.select("img_id", F.array(at("first"), at("second"), at("first"), at("third")).alias("candidates"))
    there = names.filter("img_id % 5 <> 0")
    listing = there.filter("img_id % 3 = 0").select(at("first").alias("path")).unionAll(there.filter("img_id % 3 <= 1").select(at("second"))).unionAll(there.select(at("third")))
    return records.first_existing(candidates, listing, "img_id")


@query("SELECT img_id, CAST(ix AS BIGINT) AS pos, x1 AS x, CASE WHEN ix < 3 THEN conf ELSE CAST('nan' AS DOUBLE) END AS score FROM {det} WHERE ix >= 3 OR conf >= 0.5")
def box_score_zip(spark, sf):
    item = F.array_sort(F.collect_list(F.struct("ix", "x1", "conf")))
    grouped = _det(spark, sf).groupBy("img_id").agg(item.alias("all"))
    boxes = grouped.select("img_id", F.transform("all", lambda s: s["x1"]).alias("boxes"), F.slice(F.transform("all", lambda s: s["conf"]), 1, 3).alias("scores"))
    each = records.zip_scores(boxes, "img_id").filter(records.score_passes(F.col("score"), 0.5))
    return each.select("img_id", F.col("pos").cast("long").alias("pos"), F.col("box").alias("x"), "score")


@query("""SELECT CASE WHEN s.img_id IS NULL THEN 'missing' WHEN s.name LIKE '%.txt' THEN 'failed' ELSE 'saved' END AS status, count(*) AS n
FROM (SELECT DISTINCT img_id FROM {pred}) p LEFT JOIN (SELECT * FROM {scan} WHERE img_id % 7 <> 1) s ON s.img_id = p.img_id GROUP BY 1""")
def overlay_status_counts(spark, sf):
    index = relation(spark, sf, "scan").filter("img_id % 7 <> 1").select("img_id", "name")
    joined = relation(spark, sf, "pred").select("img_id").distinct().join(index, "img_id", "left")
    status = F.when(F.col("name").isNull(), "missing").when(~P.is_image(F.col("name")), "failed").otherwise("saved")
    return joined.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


# --- evaluation ------------------------------------------------------------------------------------------------------
@query(f"WITH {_PER_IMAGE} SELECT img_id, n_gt, n_pred, round(coalesce(total / nullif(n_gt, 0), 0.0), 6) AS coverage, n_full, n_uncovered, n_outside FROM per")
def eval_per_image(spark, sf):
    return _evaluated(spark, sf).drop("total").withColumn("coverage", F.round("coverage", 6))


@query(f"WITH {_PER_IMAGE} SELECT {_RATES} FROM per")
def eval_summary(spark, sf):
    return evaluate.summary(_evaluated(spark, sf))


@query(f"WITH {_PER_IMAGE} SELECT CASE img_id % 3 WHEN 0 THEN 'a/one' WHEN 1 THEN 'b/two' ELSE 'c' END AS model, {_RATES} FROM per GROUP BY 1")
def vlm_score_by_model(spark, sf):
    model = F.when(F.col("img_id") % 3 == 0, "a/one").when(F.col("img_id") % 3 == 1, "b/two").otherwise("c")
    return evaluate.summary(_evaluated(spark, sf).withColumn("model", model), "model")


@query(f"""WITH {_PER_IMAGE}, central AS (SELECT img_id, count(*) AS central_fp FROM {{pred}} WHERE {_ELLIPSE} GROUP BY img_id),
l AS (SELECT img_id, list(round(coverage, 6) ORDER BY ix) AS each FROM cov GROUP BY img_id)
SELECT per.img_id, n_outside, coalesce(central_fp, 0) AS central_fp, coalesce(len(l.each), 0) AS n_regions, round(coalesce(list_min(l.each), 0.0), 6) AS least_covered
FROM per LEFT JOIN central ON central.img_id = per.img_id LEFT JOIN l ON l.img_id = per.img_id""")
def eval_extended(spark, sf):
    gt, pred = _boxes(spark, sf, "gt"), _boxes(spark, sf, "pred")
    fp = evaluate.central(pred).groupBy("img_id").agg(F.count("*").alias("central_fp"))
    each = evaluate.best_coverage(gt, pred, MARGIN, "img_id").groupBy("img_id").agg(F.collect_list(F.round("coverage", 6)).alias("each"))
    joined = evaluate.per_image(gt, pred, MARGIN).join(fp, "img_id", "left").join(each, "img_id", "left")
    return joined.select("img_id", "n_outside", F.coalesce("central_fp", F.lit(0)).cast("long").alias("central_fp"), F.coalesce(F.when(F.col("each").isNotNull(), F.size("each")), F.lit(0)).cast("long").alias("n_regions"), F.coalesce(F.array_min("each"), F.lit(0.0)).alias("least_covered"))


@query(f"WITH {_PER_IMAGE} SELECT img_id, n_gt - n_full AS n_not_full FROM per WHERE n_gt > n_full")
def not_fully_covered(spark, sf):
    return _evaluated(spark, sf).filter("n_gt > n_full").select("img_id", (F.col("n_gt") - F.col("n_full")).alias("n_not_full"))


@query(f"""WITH {_PER_IMAGE} SELECT img_id, CAST(sum(n_gt) AS BIGINT) AS n_gt, CAST(sum(n_pred) AS BIGINT) AS n_pred, CAST(sum(n_outside) AS BIGINT) AS n_outside FROM per GROUP BY ROLLUP (img_id)""")
def eval_rollup(spark, sf):
    """An extension: rows per image and the total in one pass."""
    return _evaluated(spark, sf).rollup("img_id").agg(*(F.sum(c).alias(c) for c in ("n_gt", "n_pred", "n_outside")))


@query("""SELECT m AS modality, round(coalesce(avg(sam_time), 0.0), 6) AS sam, round(coalesce(avg(post_time), 0.0), 6) AS post, round(coalesce(avg(deid_time), 0.0), 6) AS deid,
  round(coalesce(avg(sam_time), 0.0) + coalesce(avg(post_time), 0.0) + coalesce(avg(deid_time), 0.0), 6) AS total, count(*) AS n
FROM (SELECT p.name % 3 AS m, p.sam_time, p.post_time, d.deid_time FROM {post} p LEFT JOIN {deid} d ON d.name = p.name) GROUP BY m""")
def bench_stage_means(spark, sf):
    joined = relation(spark, sf, "post").join(relation(spark, sf, "deid").select("name", "deid_time"), "name", "left").withColumn("modality", F.col("name") % 3)
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    total = mean("sam_time") + mean("post_time") + mean("deid_time")
    return joined.groupBy("modality").agg(F.round(mean("sam_time"), 6).alias("sam"), F.round(mean("post_time"), 6).alias("post"), F.round(mean("deid_time"), 6).alias("deid"), F.round(total, 6).alias("total"), F.count("*").alias("n"))


@query(f"SELECT status, count(*) AS n FROM ({_LATEST}) GROUP BY status")
def decision_counts(spark, sf):
    return records.latest_decisions(relation(spark, sf, "decisions")).groupBy("status").agg(F.count("*").alias("n"))


_EDGES = " + ".join(f"CASE WHEN coverage >= CAST({i} AS DOUBLE) / 10 THEN 1 ELSE 0 END" for i in range(1, 10))


@query(f"SELECT b.bin, count(c.bin) AS n FROM range(10) b(bin) LEFT JOIN (SELECT {_EDGES} AS bin FROM (SELECT round(coverage, 6) AS coverage FROM ({_COVERAGE}))) c ON c.bin = b.bin GROUP BY b.bin")
def coverage_histogram(spark, sf):
    return evaluate.histogram(gt_best_coverage(spark, sf), "coverage")


@query("SELECT CAST(floor(abs(CAST(l_partkey % 901 - 450 AS DOUBLE) / 10)) AS BIGINT) AS bin, count(*) AS n FROM {lineitem} GROUP BY 1")
def theta_histogram(spark, sf):
    theta = ((F.col("l_partkey") % 901 - 450).cast("double") / 10).alias("theta")
    return evaluate.degree_histogram(relation(spark, sf, "lineitem").select(theta), "theta")


@query(_LATEST)
def decision_latest(spark, sf):
    return records.latest_decisions(relation(spark, sf, "decisions"))


@query(_LATEST)
def decision_latest_window(spark, sf):
    return records.latest_decisions_by_window(relation(spark, sf, "decisions"))


def _record_boxes(spark, sf) -> DataFrame:
    """Records whose stems repeat: the images of one hundredth share a stem."""
    return relation(spark, sf, "pred").groupBy("img_id").agg(F.array_sort(F.collect_list("x1")).alias("boxes")).select(F.expr("img_id div 100").alias("stem"), F.col("img_id").alias("pos"), "boxes")


@query("""SELECT img_id // 100 AS stem, count(*) AS n_appended, CAST(sum(x1) AS DOUBLE) AS total, max(n) FILTER (img_id = last) AS n_last
FROM (SELECT *, max(img_id) OVER (PARTITION BY img_id // 100) AS last, count(*) OVER (PARTITION BY img_id) AS n FROM {pred}) GROUP BY 1""")
def preds_by_stem(spark, sf):
    rows = _record_boxes(spark, sf)
    last = evaluate.by_stem(rows, append=False).select("stem", F.size("boxes").cast("long").alias("n_last"))
    sums = evaluate.by_stem(rows).select("stem", F.size("boxes").cast("long").alias("n_appended"), F.aggregate("boxes", F.lit(0.0), lambda a, x: a + x).alias("total"))
    return sums.join(last, "stem")


@query("SELECT img_id, count(*) AS n, min(x1) AS x1, max(y2) AS y2 FROM {gt} WHERE ix % 4 <> 3 GROUP BY img_id")
def gt_rects(spark, sf):
    corner = lambda x, y: F.array(F.col(f"r.{x}"), F.col(f"r.{y}"))
    points = F.when(F.col("ix") % 4 == 3, F.array(corner("x1", "y1"))).otherwise(F.array(corner("x2", "y2"), corner("x1", "y1")))
    shapes = _boxes(spark, sf, "gt").groupBy("img_id").agg(F.collect_list(F.struct(points.alias("points"))).alias("shapes"))
    each = shapes.select("img_id", F.explode("shapes").alias("s")).filter(F.size("s.points") >= 2).select("img_id", G.quad_to_rect(F.col("s.points")).alias("r"))
    return each.groupBy("img_id").agg(F.count("*").alias("n"), F.min("r.x1").alias("x1"), F.max("r.y2").alias("y2"))


@query(f"""SELECT stem, name FROM (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY string_split(name, '/')) AS k FROM (
  SELECT {_STEM} AS stem, {_SUFFIX} AS suffix, name FROM (SELECT regexp_replace(name, 'scan_patient_\\d+', 'scan_patient_' || CAST(img_id % 1000 AS VARCHAR)) AS name FROM {{scan}}))
  WHERE suffix IN ('jpg', 'jpeg', 'png', 'bmp', 'tif', 'tiff')) WHERE k = 1""")
def image_index_first(spark, sf):
    again = F.regexp_replace("name", F.lit(r"scan_patient_\d+"), F.concat(F.lit("scan_patient_"), (F.col("img_id") % 1000).cast("string")))
    return I.index_by_stem(relation(spark, sf, "scan").select(again.alias("name")))


@query("SELECT CASE WHEN img_id % 9 = 0 THEN 'failed' ELSE 'sound' END AS part, count(*) AS n, CAST(sum(img_id) AS BIGINT) AS ids FROM {scan} GROUP BY 1")
def dead_letter_split(spark, sf):
    results = relation(spark, sf, "scan").select("img_id", F.when(F.col("img_id") % 9 == 0, "ValueError").alias("error"))
    count = lambda rows, part: rows.agg(F.lit(part).alias("part"), F.count("*").alias("n"), F.sum("img_id").alias("ids"))
    sound, failed = records.dead_letters(results)
    return count(sound, "sound").unionAll(count(failed, "failed"))


# --- sweeps ----------------------------------------------------------------------------------------------------------
_GRID = [
    ("merge", "5", 5.0, 60000.0, 10, 0.45, 0.35), ("merge", "10", 10.0, 60000.0, 10, 0.45, 0.35), ("merge", "20", 20.0, 60000.0, 10, 0.45, 0.35),
    ("area", "30000", 10.0, 30000.0, 10, 0.45, 0.35), ("area", "60000", 10.0, 60000.0, 10, 0.45, 0.35), ("area", "none", 10.0, None, 10, 0.45, 0.35),
    ("padding", "0", 10.0, 60000.0, 0, 0.45, 0.35), ("padding", "10", 10.0, 60000.0, 10, 0.45, 0.35), ("padding", "20", 10.0, 60000.0, 20, 0.45, 0.35),
]
_ABLATION = [("ellipse", "on", 10.0, 60000.0, 10, 0.45, 0.35), ("ellipse", "off", 10.0, 60000.0, 10, 0.001, 0.001)]


def _values(rows: list[tuple]) -> str:
    cell = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows)


def _grid(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    names = "param, value, merge_distance, max_area, padding, axis_x, axis_y"
    return spark.sql(f"SELECT param, value, CAST(merge_distance AS DOUBLE) AS merge_distance, CAST(max_area AS DOUBLE) AS max_area, CAST(padding AS INT) AS padding, CAST(axis_x AS DOUBLE) AS axis_x, CAST(axis_y AS DOUBLE) AS axis_y FROM VALUES {_values(rows)} AS t({names})")


def _sweep_sql(rows: list[tuple]) -> str:
    ellipse = _squares("""(power2((least(greatest(w / CAST(2 AS DOUBLE), x1), x2) - w / CAST(2 AS DOUBLE)) / greatest(1.0, w * axis_x))
 + power2((least(greatest(h / CAST(2 AS DOUBLE), y1), y2) - h / CAST(2 AS DOUBLE)) / greatest(1.0, h * axis_y)))""")
    close = "b.x1 - a.x2 <= a.md AND a.x1 - b.x2 <= a.md AND b.y1 - a.y2 <= a.md AND a.y1 - b.y2 <= a.md"
    return f"""WITH RECURSIVE grid(param, value, md, ma, pad, axis_x, axis_y) AS (SELECT a, b, CAST(c AS DOUBLE), CAST(d AS DOUBLE), e, CAST(f AS DOUBLE), CAST(g AS DOUBLE) FROM (VALUES {_values(rows)}) v(a, b, c, d, e, f, g)),
kept AS (SELECT det.*, grid.* FROM {{det}} det CROSS JOIN grid WHERE (ma IS NULL OR bw * bh <= ma) AND NOT ({ellipse} <= 1.0)),
linked AS (SELECT a.param, a.value, a.img_id, a.ix AS s, b.ix AS d FROM kept a JOIN kept b ON a.param = b.param AND a.value = b.value AND a.img_id = b.img_id AND {close}),
reach AS (SELECT param, value, img_id, s, d FROM linked UNION SELECT r.param, r.value, r.img_id, r.s, l.d FROM reach r JOIN linked l ON r.param = l.param AND r.value = l.value AND r.img_id = l.img_id AND r.d = l.s),
rooted AS (SELECT param, value, img_id, s AS ix, min(d) AS root FROM reach GROUP BY ALL),
groups AS (SELECT k.param, k.value, k.img_id, root, min(w) AS w, min(h) AS h, min(pad) AS pad, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2 FROM kept k JOIN rooted r ON k.param = r.param AND k.value = r.value AND k.img_id = r.img_id AND k.ix = r.ix GROUP BY k.param, k.value, k.img_id, root),
boxes AS (SELECT param, value, img_id, w, h, greatest(0, x1 - pad) AS x1, greatest(0, y1 - pad) AS y1, least(w, x2 + pad) AS x2, least(h, y2 + pad) AS y2 FROM groups)"""


@query(_sweep_sql(_GRID) + "SELECT param, value, count(*) AS n, CAST(sum((x2 - x1) * (y2 - y1)) AS DOUBLE) AS area, count(DISTINCT img_id) AS n_images FROM boxes WHERE x2 > x1 AND y2 > y1 GROUP BY param, value")
def sensitivity_sweep(spark, sf):
    boxes = sweep(_det(spark, sf), _grid(spark, _GRID))
    per_image = boxes.groupBy("param", "value", "img_id").agg(F.count("*").alias("n"), F.sum(G.rect_area(F.col("r"))).alias("area"))
    return per_image.groupBy("param", "value").agg(F.sum("n").alias("n"), F.sum("area").alias("area"), F.count("*").alias("n_images"))


@query(_sweep_sql(_ABLATION) + f"SELECT value AS ellipse, count(*) AS n, count(*) FILTER ({_ELLIPSE}) AS central_fp FROM boxes WHERE x2 > x1 AND y2 > y1 GROUP BY value")
def ablation_ellipse(spark, sf):
    boxes = sweep(_det(spark, sf), _grid(spark, _ABLATION))
    central = G.touches_center_ellipse(F.col("r"), F.col("w").cast("double"), F.col("h").cast("double"), AXIS_X, AXIS_Y)
    return boxes.groupBy(F.col("value").alias("ellipse")).agg(F.count("*").alias("n"), F.count_if(central).alias("central_fp"))


# --- windows, sorts, sets --------------------------------------------------------------------------------------------
@query("SELECT img_id, ix, CAST(row_number() OVER (PARTITION BY img_id ORDER BY bw * bh DESC, ix) AS BIGINT) AS rank FROM {det}")
def box_area_rank(spark, sf):
    order = Window.partitionBy("img_id").orderBy(F.desc(F.col("bw") * F.col("bh")), "ix")
    return _det(spark, sf).select(*_KEY, F.row_number().over(order).cast("long").alias("rank"))


@query("SELECT img_id FROM {gt} UNION SELECT img_id FROM {pred}")
def image_universe(spark, sf):
    return relation(spark, sf, "gt").select("img_id").union(relation(spark, sf, "pred").select("img_id")).distinct()


@query(f"SELECT img_id, name FROM {{scan}} WHERE {_SUFFIX} IN {_IMAGES} ORDER BY string_split(name, '/') LIMIT 30")
def limit_images(spark, sf):
    return I.in_path_order(I.scan_names(relation(spark, sf, "scan"))).select("img_id", "name").limit(30)


@query("SELECT img_id, ix, x1 FROM {det} WHERE l_linenumber <= 4 UNION ALL SELECT img_id, ix + 1000000 AS ix, x1 FROM {det} WHERE l_linenumber > 2")
def ocr_pass_union(spark, sf):
    d = _det(spark, sf).select(*_KEY, "x1", "l_linenumber")
    return models.union_passes(d.filter("l_linenumber <= 4").drop("l_linenumber"), d.filter("l_linenumber > 2").drop("l_linenumber"))


# --- masks -----------------------------------------------------------------------------------------------------------
_PX = """px AS (SELECT vec_id, CAST(k - 1 AS BIGINT) AS k, (k - 1) // 8 AS y, (k - 1) % 8 AS x, CAST(embedding[k] AS DOUBLE) > CAST(-0.15 AS DOUBLE) AS on_
  FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS k FROM {embeddings})),
near AS (SELECT a.vec_id, a.y, a.x, bool_and(b.on_) AS on_ FROM px a JOIN px b ON a.vec_id = b.vec_id AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 GROUP BY ALL),
wide AS (SELECT a.vec_id, a.y, a.x, bool_or(b.on_) AS on_ FROM px a JOIN px b ON a.vec_id = b.vec_id AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 GROUP BY ALL),
opened AS (SELECT a.vec_id, a.y, a.x, bool_or(b.on_) AS on_ FROM near a JOIN near b ON a.vec_id = b.vec_id AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 GROUP BY ALL)"""
_SIDE = 8


def _masks(spark, sf) -> DataFrame:
    return relation(spark, sf, "embeddings").select("vec_id", masks.threshold(F.col("embedding"), -0.15).alias("mask"))


def _pixel_sums(df: DataFrame, key: str = "vec_id") -> DataFrame:
    on = masks.on_pixels(F.col("mask"), _SIDE)
    return df.select(key, F.size(on).cast("long").alias("n"), F.aggregate(on, F.lit(0).cast("long"), lambda a, p: a + p["y"] * _SIDE + p["x"]).alias("places"))


def _sums_sql(table: str, key: str = "vec_id") -> str:
    return f"SELECT {key}, count(*) FILTER (on_) AS n, CAST(coalesce(sum(8 * y + x) FILTER (on_), 0) AS BIGINT) AS places FROM {table} GROUP BY {key}"


@query(f"WITH {_PX}, joined AS (SELECT vec_id // 3 AS stack, y, x, bool_or(on_) AS on_ FROM px GROUP BY ALL) {_sums_sql('joined', 'stack')}")
def mask_combine(spark, sf):
    stacked = _masks(spark, sf).select(F.expr("vec_id div 3").alias("stack"), "mask")
    return _pixel_sums(masks.combine(stacked, "stack"), "stack")


@query(f"""WITH cells AS (SELECT v.vec_id, y.y, x.x, (x.x >= v.vec_id % 5 AND x.x <= v.vec_id % 5 + 2 AND y.y >= v.vec_id % 3 AND y.y <= v.vec_id % 3 + 3) AS on_
  FROM {{embeddings}} v, range(8) y(y), range(8) x(x)) {_sums_sql('cells')}""")
def mask_from_boxes(spark, sf):
    boxes = F.array(G.box(F.col("vec_id") % 5, F.col("vec_id") % 3, F.lit(2), F.lit(3)))
    return _pixel_sums(relation(spark, sf, "embeddings").select("vec_id", masks.from_boxes(boxes, _SIDE, _SIDE).alias("mask")))


@query(f"WITH {_PX} SELECT vec_id, min(x) AS x, min(y) AS y, max(x) - min(x) + 1 AS bw, max(y) - min(y) + 1 AS bh FROM px WHERE on_ GROUP BY vec_id")
def mask_bbox(spark, sf):
    return _masks(spark, sf).select("vec_id", masks.bounds(masks.on_pixels(F.col("mask"), _SIDE)).alias("b")).filter("b is not null").select("vec_id", *_box_columns())


@query(f"WITH {_PX} {_sums_sql('near')}")
def mask_erode(spark, sf):
    return _pixel_sums(_masks(spark, sf).withColumn("mask", masks.erode(F.col("mask"), _SIDE)))


@query(f"WITH {_PX} {_sums_sql('wide')}")
def mask_dilate(spark, sf):
    return _pixel_sums(_masks(spark, sf).withColumn("mask", masks.dilate(F.col("mask"), _SIDE)))


def _opened(spark, sf) -> DataFrame:
    return masks.opened(_masks(spark, sf).withColumn("width", F.lit(_SIDE)), 3, 1).drop("width")


@query(f"WITH {_PX} {_sums_sql('opened')}")
def mask_open(spark, sf):
    return _pixel_sums(_opened(spark, sf))


_REACH = f"""WITH RECURSIVE {_PX}, lit AS (SELECT vec_id, 8 * y + x AS k, y, x FROM px WHERE on_),
links AS (SELECT a.vec_id, a.k AS s, b.k AS d FROM lit a JOIN lit b ON a.vec_id = b.vec_id AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1),
reach AS (SELECT vec_id, s, d FROM links UNION SELECT r.vec_id, r.s, l.d FROM reach r JOIN links l ON r.vec_id = l.vec_id AND r.d = l.s),
rooted AS (SELECT vec_id, s AS k, min(d) AS root FROM reach GROUP BY ALL)"""


@query(f"""{_REACH} SELECT l.vec_id, r.root, count(*) AS n, min(l.x) AS x, min(l.y) AS y, max(l.x) - min(l.x) + 1 AS bw, max(l.y) - min(l.y) + 1 AS bh
FROM lit l JOIN rooted r ON r.vec_id = l.vec_id AND r.k = l.k GROUP BY l.vec_id, r.root""")
def mask_components(spark, sf):
    pixels = F.transform(masks.on_pixels(F.col("mask"), _SIDE), lambda p: F.struct(p["y"].alias("y"), p["x"].alias("x")))
    groups = cluster.components(pixels, lambda a, b: (F.abs(a["y"] - b["y"]) <= 1) & (F.abs(a["x"] - b["x"]) <= 1), "struct<y:int,x:int>")
    each = _masks(spark, sf).select("vec_id", F.explode(groups).alias("g"))
    root = F.array_min(F.transform("g", lambda p: p["y"] * _SIDE + p["x"])).cast("long").alias("root")
    return each.select("vec_id", root, F.size("g").cast("long").alias("n"), masks.bounds(F.col("g")).alias("b")).select("vec_id", "root", "n", *_box_columns())


@query(f"WITH {_PX} SELECT vec_id, coalesce(max(x) FILTER (on_) - min(x) FILTER (on_) + 1, 8) AS bw, coalesce(max(y) FILTER (on_) - min(y) FILTER (on_) + 1, 8) AS bh FROM px GROUP BY vec_id")
def mask_crop_size(spark, sf):
    b = masks.bounds(masks.on_pixels(F.col("mask"), _SIDE))
    size = lambda side: F.coalesce(b[side], F.lit(_SIDE)).cast("long")
    return _masks(spark, sf).select("vec_id", size("w").alias("bw"), size("h").alias("bh"))


@query(f"WITH {_PX}, o AS ({_sums_sql('opened')}) SELECT vec_id, CASE WHEN n > 0 THEN 'mask' ELSE 'segmenter' END AS source FROM o")
def postprocess_boxes_fallback(spark, sf):
    boxes = masks.component_boxes(F.col("mask"), _SIDE)
    return _opened(spark, sf).select("vec_id", F.when(F.size(boxes) > 0, "mask").otherwise("segmenter").alias("source"))


@query(f"""WITH {_PX} SELECT vec_id, CASE WHEN vec_id % 4 = 0 THEN min(x) FILTER (on_) ELSE vec_id % 3 END AS x, CASE WHEN vec_id % 4 = 0 THEN max(x) FILTER (on_) - min(x) FILTER (on_) + 1 ELSE 5 END AS bw FROM px GROUP BY vec_id""")
def sam_box_fallback(spark, sf):
    own = F.when(F.col("vec_id") % 4 != 0, G.box(F.col("vec_id") % 3, F.lit(0), F.lit(5), F.lit(5)))
    b = F.coalesce(own, masks.bounds(masks.on_pixels(F.col("mask"), _SIDE)))
    return _masks(spark, sf).select("vec_id", b.alias("b")).select("vec_id", F.col("b.x").cast("long").alias("x"), F.col("b.w").cast("long").alias("bw"))


# --- records in and out ----------------------------------------------------------------------------------------------
@query("SELECT name, coalesce(sam_time, 0.0) AS sam_time, post_time FROM {post}")
def records_scan(spark, sf):
    """Post-processing records through their wire form: written as JSON text, parsed under the record schema."""
    wire = F.to_json(F.struct(F.col("name").cast("string").alias("name"), F.col("sam_time").alias("sam3_inference_time"), F.col("post_time").alias("erosion_diffusion_time")))
    parsed = relation(spark, sf, "post").select(F.from_json(wire, schemas.POSTPROCESS, {"mode": "FAILFAST"}).alias("r"))
    return parsed.select(F.col("r.name").cast("long").alias("name"), F.coalesce("r.sam3_inference_time", F.lit(0.0)).alias("sam_time"), F.col("r.erosion_diffusion_time").alias("post_time"))


@query("""WITH s AS (SELECT name, arg_max(sam_time, pos) AS sam_time FROM {sam} GROUP BY name), d AS (SELECT name, arg_max(deid_time, pos) AS deid_time FROM {deid} GROUP BY name)
SELECT p.name, '{"name":"' || p.name || '","metrics":{"times":{"sam3_inference":' || coalesce(p.sam_time, s.sam_time, 0.0::DOUBLE) || ',"erosion_diffusion":' || coalesce(p.post_time, 0.0::DOUBLE)
  || ',"deidentification":' || coalesce(d.deid_time, 0.0::DOUBLE) || '}}}' AS json FROM {post} p LEFT JOIN s ON p.name = s.name LEFT JOIN d ON p.name = d.name""")
def report_json(spark, sf):
    """The final report as one JSON text per image."""
    r = report_left_join(spark, sf)
    times = F.struct(F.col("sam_time").alias("sam3_inference"), F.coalesce("post_time", F.lit(0.0)).alias("erosion_diffusion"), F.col("deid_time").alias("deidentification"))
    return r.select("name", F.to_json(F.struct(F.col("name").cast("string").alias("name"), F.struct(times.alias("times")).alias("metrics"))).alias("json"))
