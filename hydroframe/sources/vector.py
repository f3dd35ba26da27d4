"""Vector features: GeoJSON in, nested-array geometry, bounds and clipping.

Two read paths: a FeatureCollection document (``multiLine`` JSON, one file per request, as
the remote service returns it) and GeoJSON text sequences (one Feature per line), which
split across tasks and are the form to use at scale.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydroframe.functions.geometry import (clip_line_sql, clip_polygon_sql, let,
                                           line_length_sql, open_ring_sql, ring_area_sql)
from hydroframe.params import Extent

POLYGON_COORDS = T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))


def feature_schema(properties: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("properties", properties),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("coordinates", POLYGON_COORDS),
        ])),
    ])


def read_feature_collection(spark: SparkSession, path: str,
                            properties: T.StructType | None = None) -> DataFrame:
    """FeatureCollection files -> one row per feature (``properties.*`` + geometry).

    With ``properties`` given the read needs no schema-inference pass over the files, and
    the geometry keeps its coordinates as raw JSON text (``polygons_of`` turns Polygon and
    MultiPolygon geometry into ``polys``); without it the schema is inferred. Each file is
    one document (one task); many files are read in parallel.
    """
    reader = spark.read.option("multiLine", True)
    if properties is not None:
        feat = T.StructType([T.StructField("type", T.StringType()),
                             T.StructField("properties", properties),
                             T.StructField("geometry", POLYGON_GEOMETRY)])
        reader = reader.schema(T.StructType([T.StructField("type", T.StringType()),
                                             T.StructField("features", T.ArrayType(feat))]))
    doc = reader.json(path)
    return (doc.select(F.explode("features").alias("f"))
               .select("f.properties.*", F.col("f.geometry").alias("geometry")))


def polygons_of(geometry: str = "geometry") -> Column:
    """Polygon / MultiPolygon geometry with raw coordinates text -> ``polys``."""
    ring = open_ring_sql("rr")
    return F.expr(
        f"CASE {geometry}.type "
        f"WHEN 'Polygon' THEN array(transform(from_json({geometry}.coordinates, 'array<array<array<double>>>'), rr -> {ring})) "
        f"WHEN 'MultiPolygon' THEN transform(from_json({geometry}.coordinates, 'array<array<array<array<double>>>>'), "
        f"pg -> transform(pg, rr -> {ring})) END")


def read_feature_lines(spark: SparkSession, path: str, properties: T.StructType) -> DataFrame:
    """A7 at scale: one Feature per line, schema given (no inference pass)."""
    return parse_features(spark.read.text(path), "value", properties)


def parse_features(text_df: DataFrame, col: str, properties: T.StructType) -> DataFrame:
    """I18 + F9: GeoJSON Feature text -> property columns + ``rings`` (open rings of x/y)."""
    f = F.from_json(F.col(col), feature_schema(properties)).alias("f")
    parsed = text_df.select(f)
    return parsed.select("f.properties.*", rings_of("f.geometry.coordinates").alias("rings"))


def rings_of(coords: str) -> Column:
    """Polygon coordinates -> ``array<array<struct<x, y>>>`` with the closing point removed."""
    return F.expr(f"transform({coords}, rr -> {open_ring_sql('rr')})")


def rings_bbox_sql(rings: str) -> str:
    """Bounding box of all rings as one struct ``(xmin, xmax, ymin, ymax)``."""
    def body(rs):
        xs = f"flatten(transform({rs}, r -> transform(r, p -> p.x)))"
        ys = f"flatten(transform({rs}, r -> transform(r, p -> p.y)))"
        return (f"named_struct('xmin', array_min({xs}), 'xmax', array_max({xs}), "
                f"'ymin', array_min({ys}), 'ymax', array_max({ys}))")
    return let(rings, body)


def with_rings_bbox(df: DataFrame, rings: str = "rings") -> DataFrame:
    """Add the bounding box of all rings as columns xmin, xmax, ymin, ymax (computed once,
    as one struct, then expanded)."""
    keep = [c for c in df.columns if c not in ("xmin", "xmax", "ymin", "ymax")]
    return (df.select(*keep, F.expr(rings_bbox_sql(rings)).alias("_box"))
              .select(*keep, *[F.col("_box")[k].alias(k) for k in ("xmin", "xmax", "ymin", "ymax")]))


def rings_area_sql(rings: str) -> str:
    """Area of the outer ring minus the holes (shoelace)."""
    def body(rs):
        return (f"CASE WHEN size({rs}) = 0 THEN 0D ELSE {ring_area_sql(f'{rs}[0]')} - "
                f"aggregate(slice({rs}, 2, size({rs})), 0D, (acc, h) -> acc + {ring_area_sql('h')}) END")
    return let(rings, body)


def rings_area(rings: str = "rings") -> Column:
    return F.expr(rings_area_sql(rings))


def features_in_extent(df: DataFrame, ext: Extent, rings: str = "rings") -> DataFrame:
    """C1 + C2 + C3 for single-polygon features (``rings``): see ``polygons_in_extent``."""
    others = [c for c in df.columns if c != rings]
    wrapped = df.select(*others, F.array(F.col(rings)).alias("_polys"))
    out = polygons_in_extent(wrapped, ext, "_polys")
    return out.select(*others, F.element_at("_polys", 1).alias(rings), "area", "xmin", "xmax", "ymin", "ymax")


def polygons_in_extent(df: DataFrame, ext: Extent, polys: str = "polys") -> DataFrame:
    """C1 + C2 + C3 for polygon layers (``polys``: one entry per polygon, each a list of
    rings, outer first): bbox meets the extent, every ring clipped, polygons left without
    area dropped, features left without polygons dropped; adds ``area`` (outer minus holes,
    summed over polygons) and the clipped bbox.

    The per-feature work is one expression evaluated once per row: a 0-or-1 element
    array that ``inline_outer`` expands, then a filter on a generated column. A filter on
    derived columns (or the size filter Catalyst infers for a plain ``inline``) would be
    pushed below the projection and re-evaluate the clip.
    """
    def per_feature(ps):
        box = rings_bbox_sql(f"flatten({ps})")

        def result(c, bx_sql):
            def with_areas(areas):
                kept = f"filter(zip_with({c}, {areas}, (pg, a) -> named_struct('pg', pg, 'a', a)), z -> z.a > 0)"

                def finish(k):
                    return (f"CASE WHEN size({k}) > 0 THEN array(named_struct('{polys}', transform({k}, z -> z.pg), "
                            f"'area', aggregate({k}, 0D, (acc, z) -> acc + z.a), 'box', {bx_sql(f'flatten(transform({k}, z -> z.pg))')})) END")
                return let(kept, finish)
            return let(f"transform({c}, pg -> {rings_area_sql('pg')})", with_areas)

        def decide(bx):
            meets = (f"{bx}.xmax >= {ext.west!r} AND {bx}.xmin <= {ext.east!r} AND "
                     f"{bx}.ymax >= {ext.south!r} AND {bx}.ymin <= {ext.north!r}")
            inside = (f"{bx}.xmin >= {ext.west!r} AND {bx}.xmax <= {ext.east!r} AND "
                      f"{bx}.ymin >= {ext.south!r} AND {bx}.ymax <= {ext.north!r}")
            # Exact fast path: a feature inside the extent is its own clip (same rings, same
            # box); only features crossing an edge pay for the four half-plane passes.
            clipped = f"transform({ps}, pg -> {clip_polygon_sql('pg', ext)})"
            crossing = let(clipped, lambda c: result(c, rings_bbox_sql))
            return (f"CASE WHEN {inside} THEN {result(ps, lambda _: bx)} "
                    f"WHEN {meets} THEN {crossing} END")
        return let(box, decide)

    others = [c for c in df.columns if c != polys]
    kept = df.select(*others, F.expr(f"coalesce({let(polys, per_feature)}, array())").alias("_g"))
    # inline_outer + a filter on a generated column: with plain inline, Catalyst infers
    # size(_g) > 0 and pushes it down to the scan, evaluating the clip a second time there.
    out = kept.select(*others, F.inline_outer("_g")).filter(F.col("area").isNotNull())
    return out.select(*others, polys, "area", *[F.col("box")[k].alias(k) for k in ("xmin", "xmax", "ymin", "ymax")])


POLYGON_GEOMETRY = T.StructType([T.StructField("type", T.StringType()),
                                 T.StructField("coordinates", T.StringType())])


def parse_polygon_features(text_df: DataFrame, col: str, properties: T.StructType) -> DataFrame:
    """Polygon and MultiPolygon features -> property columns + ``polys``
    (``array<array<ring>>``, one entry per polygon, outer ring first). Coordinates are read
    as raw JSON text and parsed by geometry type, so both types share one column."""
    schema = T.StructType([T.StructField("type", T.StringType()),
                           T.StructField("properties", properties),
                           T.StructField("geometry", POLYGON_GEOMETRY)])
    f = text_df.select(F.from_json(F.col(col), schema).alias("f"))
    return f.select("f.properties.*", polygons_of("f.geometry").alias("polys"))


def to_feature_text(df: DataFrame, property_cols: list[str], rings: str = "rings") -> DataFrame:
    """The inverse of ``parse_features``: GeoJSON Feature text per row (closed rings)."""
    coords = F.expr(f"transform({rings}, r -> concat(transform(r, p -> array(p.x, p.y)), "
                    f"CASE WHEN size(r) > 0 THEN array(array(r[0].x, r[0].y)) ELSE array() END))")
    feature = F.struct(F.lit("Feature").alias("type"),
                       F.struct(*property_cols).alias("properties"),
                       F.struct(F.lit("Polygon").alias("type"), coords.alias("coordinates")).alias("geometry"))
    return df.select(F.to_json(feature).alias("feature"))


# --- line layers (rivers, A2) -----------------------------------------------------------------

LINE_GEOMETRY = T.StructType([T.StructField("type", T.StringType()),
                              T.StructField("coordinates", T.StringType())])


def parse_line_features(text_df: DataFrame, col: str, properties: T.StructType) -> DataFrame:
    """A2: LineString / MultiLineString features -> property columns + ``lines``
    (``array<array<struct<x, y>>>``). Coordinates are read as raw JSON text first and parsed
    by geometry type, so both types share one column."""
    schema = T.StructType([T.StructField("type", T.StringType()),
                           T.StructField("properties", properties),
                           T.StructField("geometry", LINE_GEOMETRY)])
    f = text_df.select(F.from_json(F.col(col), schema).alias("f"))
    pts = "transform(l, p -> named_struct('x', CAST(p[0] AS DOUBLE), 'y', CAST(p[1] AS DOUBLE)))"
    lines = F.expr(
        "CASE f.geometry.type "
        "WHEN 'LineString' THEN array(transform(from_json(f.geometry.coordinates, 'array<array<double>>'), "
        "p -> named_struct('x', CAST(p[0] AS DOUBLE), 'y', CAST(p[1] AS DOUBLE)))) "
        f"WHEN 'MultiLineString' THEN transform(from_json(f.geometry.coordinates, 'array<array<array<double>>>'), l -> {pts}) "
        "END")
    return f.select("f.properties.*", lines.alias("lines"))


def lines_in_extent(df: DataFrame, ext: Extent, lines: str = "lines") -> DataFrame:
    """C1 + C2 + C3 for line layers: every line clipped to the rectangle (pieces inside,
    merged where they connect), features with nothing inside dropped; adds ``length`` and
    the clipped bbox. Evaluated once per row inside an ``inline`` generator."""
    def per_feature(ls):
        clipped = f"flatten(transform({ls}, l -> {clip_line_sql('l', ext)}))"

        def result(c):
            length = f"aggregate({c}, 0D, (acc, l) -> acc + {line_length_sql('l')})"
            return (f"CASE WHEN size({c}) > 0 THEN array(named_struct('{lines}', {c}, "
                    f"'length', {length}, 'box', {rings_bbox_sql(c)})) END")
        return let(clipped, result)

    others = [c for c in df.columns if c != lines]
    kept = df.select(*others, F.expr(f"coalesce({let(lines, per_feature)}, array())").alias("_g"))
    out = kept.select(*others, F.inline_outer("_g")).filter(F.col("length").isNotNull())
    return out.select(*others, lines, "length",
                      *[F.col("box")[k].alias(k) for k in ("xmin", "xmax", "ymin", "ymax")])


# --- unknown properties (I18) -----------------------------------------------------------------

PROPERTY_TYPES = {"integer": "bigint", "number": "double", "boolean": "boolean", "string": "string"}


def feature_properties(text_df: DataFrame, col: str, out: str = "properties") -> DataFrame:
    """The ``properties`` of GeoJSON Feature text as a VARIANT column, beside the other columns.

    Text that is no JSON, or has no properties, gives NULL.
    """
    props = F.try_variant_get(F.try_parse_json(F.col(col)), "$.properties", "variant")
    return text_df.select(*[c for c in text_df.columns if c != col], props.alias(out))


def _json_type(value: Column) -> Column:
    name = F.schema_of_variant(value)
    return (F.when(name.startswith("OBJECT"), "object").when(name.startswith("ARRAY"), "array")
            .when(name == "BIGINT", "integer").when(name == "STRING", "string").when(name == "BOOLEAN", "boolean")
            .when(name == "VOID", "null").otherwise("number"))


def property_keys(df: DataFrame, properties: str = "properties", depth: int = 2) -> DataFrame:
    """Every key that the properties of the features carry: (path, type, n_features, n_null).

    Keys of nested objects are listed as ``outer.inner``, down to ``depth`` levels. ``type`` is
    the JSON type of the values that are not null: ``number`` where integers and other numbers
    meet, ``mixed`` where other types meet, ``null`` where there is none. One scan, in which a
    feature becomes a row per key, and partial counts per key before the only shuffle.
    """
    spark = df.sparkSession
    level = df.select(F.col(properties).alias("_v0"))
    names = []
    for i in range(depth):  # each level opens the objects of the level above and keeps its own rows
        inner = F.col(f"_v{i}") if i == 0 else F.when(_json_type(F.col(f"_v{i}")) == "object", F.col(f"_v{i}"))
        level = (level.withColumn("_open", inner).lateralJoin(spark.tvf.variant_explode_outer(F.col("_open").outer()))
                 .withColumnsRenamed({"key": f"_k{i + 1}", "value": f"_v{i + 1}", "pos": f"_p{i + 1}"}).drop("_open"))
        names.append(f"_k{i + 1}")
    found = []
    for i in range(1, depth + 1):
        # a key shows once for each key below it: it counts with the first
        first = F.lit(True)
        for j in range(i + 1, depth + 1):
            first &= F.coalesce(F.col(f"_p{j}"), F.lit(0)) == 0
        found.append(F.when(F.col(f"_k{i}").isNotNull() & first,
                            F.struct(F.concat_ws(".", *names[:i]).alias("path"), _json_type(F.col(f"_v{i}")).alias("kind"))))
    kinds = level.select(F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("f")).select("f.*")
    each = F.collect_set(F.when(F.col("kind") != "null", F.col("kind")))  # seven types at most
    return (kinds.groupBy("path")
            .agg(each.alias("kinds"), F.count("*").alias("n_features"), F.count_if(F.col("kind") == "null").alias("n_null"))
            .select("path", F.when(F.size("kinds") == 0, "null").when(F.size("kinds") == 1, F.element_at("kinds", 1))
                    .when(F.size(F.array_except("kinds", F.array(F.lit("integer"), F.lit("number")))) == 0, "number")
                    .otherwise("mixed").alias("type"), "n_features", "n_null"))


def property_value(path: str, kind: str = "string", properties: str = "properties") -> Column:
    """One property by path (``name`` or ``outer.inner``); NULL where absent or not of that kind."""
    def step(name: str) -> str:
        quote = '"' if "'" in name else "'"
        return f".{name}" if name.isidentifier() else f"[{quote}{name}{quote}]"

    steps = "".join(map(step, path.split(".")))
    return F.try_variant_get(F.col(properties), "$" + steps, kind)


def with_property_columns(df: DataFrame, properties: str = "properties", keys: list[tuple[str, str]] | None = None) -> DataFrame:
    """The properties of unknown features as columns, beside the table's other columns.

    ``keys`` are (path, type) pairs; by default those found by ``property_keys``, one level deep,
    in order of name (the list of keys reaches the driver: it becomes the schema). Integers,
    numbers, booleans and strings get their own type; everything else is JSON text.
    """
    if keys is None:
        keys = [(r["path"], r["type"]) for r in property_keys(df, properties, depth=1).orderBy("path").collect()]

    def column(path: str, kind: str) -> Column:
        if kind in PROPERTY_TYPES:
            return property_value(path, PROPERTY_TYPES[kind], properties)
        return F.to_json(property_value(path, "variant", properties))

    return df.select(*[c for c in df.columns if c != properties], *[column(p, k).alias(p) for p, k in keys])


# --- large FeatureCollection documents (A7) -----------------------------------------------------

_TYPE_KEY = r'"type"\s*:\s*$'
_COLLECTION = r'(?s)^.*?"features"\s*:\s*\['


def _feature_mark(spark: SparkSession, path: str) -> str | None:
    """The text that names the type of a feature in these documents, blanks included; None without a feature.

    Reads up to the first feature only.
    """
    head = spark.read.option("lineSep", '"Feature"').text(path).limit(1).collect()
    found = re.search(_TYPE_KEY, head[0]["value"]) if head else None
    return None if found is None else found[0] + '"Feature"'


def read_feature_collection_split(spark: SparkSession, path: str, properties: T.StructType) -> DataFrame:
    """FeatureCollection documents of any size, each read by many tasks: a row per feature.

    ``"type": "Feature"``, as the documents write it, is the record separator of Spark's text reader, which
    finds records in byte ranges of a file; so a document is split like any text file, and a
    task holds one feature at a time. Between two marks lie the end of one feature and the start
    of the next: members after the mark belong to the feature it names, and where the type is the last
    member, as in documents with sorted keys, those before it do. What follows a feature's
    closing brace is not read by the JSON parser. The columns are those of ``read_feature_collection`` with ``properties``.
    Documents of one path must be written alike; a property named ``type`` must not be the string ``Feature``.
    """
    schema = T.StructType([T.StructField("properties", properties), T.StructField("geometry", POLYGON_GEOMETRY)])
    mark = _feature_mark(spark, path)
    if mark is None:
        pieces = spark.createDataFrame([], "value string")
    else:
        pieces = spark.read.option("lineSep", mark).text(path)
    piece = F.col("value")
    after = F.concat(F.lit('{"_":0'), piece)                          # type first: , "properties": ... }
    before = F.regexp_replace(piece, r"(?s)^\s*\}\s*,?\s*", "")        # type last: the next feature up to its type
    before = F.regexp_replace(F.regexp_replace(before, _COLLECTION, ""), r",\s*$", "}")
    text = (F.when(piece.rlike(r"^\s*,"), after)
            .when(before.rlike(r"^\s*\{") & before.rlike(r"\}\s*$"), before))
    # the filter is on the parsed column's own members: headers and closing brackets hold no feature
    feature = pieces.select(F.from_json(text, schema).alias("f")).filter("f.properties IS NOT NULL OR f.geometry IS NOT NULL")
    return feature.select("f.properties.*", F.col("f.geometry").alias("geometry"))
