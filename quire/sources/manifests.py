"""IIIF manifests: both versions' nested canvases flattened with variants, page ids, image URLs and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def canvases(manifests: DataFrame, key: str = "doc_id", value: str = "manifest") -> DataFrame:
    """(key, position, canvas_id, label, service, image, width, height): the first usable image of each canvas, in order.

    Version 3 is told by its items. Canvases of other types are passed over.
    """
    v = manifests.select(key, F.parse_json(value).alias("_m"))
    v.createOrReplaceTempView("_quire_manifests")
    spark = manifests.sparkSession
    sql = f"""
    with two as (
      select {key}, s.pos as p1, c.pos as p2, i.pos as p3, c.value as canvas, variant_get(i.value, '$.resource', 'variant') as body
      from _quire_manifests, lateral variant_explode_outer(variant_get(_m, '$.sequences', 'variant')) s,
        lateral variant_explode_outer(variant_get(s.value, '$.canvases', 'variant')) c, lateral variant_explode_outer(variant_get(c.value, '$.images', 'variant')) i
      where variant_get(_m, '$.items', 'variant') is null and c.value is not null
    ), three as (
      select {key}, 0 as p1, c.pos as p2, coalesce(a.pos, 0) * 1000 + coalesce(i.pos, 0) as p3, c.value as canvas, variant_get(i.value, '$.body', 'variant') as body
      from _quire_manifests, lateral variant_explode_outer(variant_get(_m, '$.items', 'variant')) c,
        lateral variant_explode_outer(variant_get(c.value, '$.items', 'variant')) a, lateral variant_explode_outer(variant_get(a.value, '$.items', 'variant')) i
      where variant_get(_m, '$.items', 'variant') is not null and try_variant_get(c.value, '$.type', 'string') = 'Canvas'
    ), both as (select * from two union all select * from three)
    select {key}, p1, p2, p3,
      coalesce(try_variant_get(canvas, '$["@id"]', 'string'), try_variant_get(canvas, '$.id', 'string')) as canvas_id,
      coalesce(try_variant_get(canvas, '$.label', 'string'), try_variant_get(canvas, '$.label.none[0]', 'string'), try_variant_get(canvas, '$.label.en[0]', 'string'), try_variant_get(canvas, '$.label["@value"]', 'string')) as label,
      coalesce(try_variant_get(body, '$.service["@id"]', 'string'), try_variant_get(body, '$.service.id', 'string'), try_variant_get(body, '$.service[0]["@id"]', 'string'), try_variant_get(body, '$.service[0].id', 'string')) as service,
      coalesce(try_variant_get(body, '$["@id"]', 'string'), try_variant_get(body, '$.id', 'string')) as image,
      try_variant_get(canvas, '$.width', 'int') as width, try_variant_get(canvas, '$.height', 'int') as height
    from both
    """
    rows = spark.sql(sql).where("service is not null or image is not null")
    first = Window.partitionBy(key, "p1", "p2").orderBy("p3")
    rows = rows.withColumn("_n", F.row_number().over(first)).where("_n = 1")
    return rows.withColumn("position", F.row_number().over(Window.partitionBy(key).orderBy("p1", "p2"))).drop("_n", "p1", "p2", "p3")


def image_url(service: Column, size: str = "max") -> Column:
    """A IIIF image URL of the given size (max, full or a width); direct image files stay, a query string is kept."""
    wanted = "max" if size.lower() in ("max", "full") else f"{int(size)},"
    path, query = F.regexp_replace(F.regexp_extract(service, r"^([^?#]*)", 1), "/+$", ""), F.regexp_extract(service, r"^[^?#]*(.*)$", 1)
    bare = F.regexp_replace(path, r"(?i)/info\.json$", "")
    sized = F.when(bare.contains("/full/"), F.regexp_replace(bare, "/full/[^/]+/", f"/full/{wanted}/")).otherwise(F.concat(bare, F.lit(f"/full/{wanted}/0/default.jpg")))
    return F.when(path.rlike(r"(?i)\.(?:jpe?g|png|webp|tiff?)$"), service).otherwise(F.concat(sized, query))


def folio_label(label: Column) -> Column:
    """f, three digits, r or v from a label's first number; null without one."""
    rx = r"(?i)(?:f(?:ol(?:io)?)?\.?\s*)?(\d+)\s*([rv])?"
    number, side = F.regexp_extract(label, rx, 1), F.lower(F.regexp_extract(label, rx, 2))
    return F.when(number != "", F.concat(F.lit("f"), F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(F.concat(F.regexp_replace(number, "^0+(?=\\d{3})", ""))), F.when(side == "", "r").otherwise(side)))


def page_ids(rows: DataFrame, key: str, position: str, label: str) -> DataFrame:
    """rows with page_id: the folio of its label, or page_ and the 0-based place where there is none or it was used before."""
    place = F.format_string("page_%04d", F.col(position) - 1)
    rows = rows.withColumn("_folio", folio_label(F.col(label)))
    w = Window.partitionBy(key, "_folio").orderBy(position)
    return rows.withColumn("page_id", F.when(F.col("_folio").isNull() | (F.row_number().over(w) > 1), place).otherwise(F.col("_folio"))).drop("_folio")


def page_list(manifests: DataFrame, size: str = "max", key: str = "doc_id") -> DataFrame:
    """(key, page_id, canvas_id, url, order, width, height, label) of manifests."""
    rows = page_ids(canvases(manifests, key), key, "position", "label")
    url = image_url(F.coalesce("service", "image"), size)
    return rows.select(key, "page_id", "canvas_id", url.alias("url"), F.col("position").alias("order"), "width", "height", "label")


def largest_image(files: DataFrame, key: list[str]) -> DataFrame:
    """Of each group of files the JPEG or PNG image with the most pixels, the first among equals."""
    good = files.where(F.col("mimetype").startswith("image/") & F.lower("url").rlike(r"\.(jpe?g|png)$"))
    w = Window.partitionBy(*key).orderBy(F.desc(F.coalesce("width", F.lit(0)) * F.coalesce("height", F.lit(0))), "position")
    return good.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
