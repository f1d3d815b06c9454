"""Scans (SRC1-SRC4).

Raw feeds are read with an explicit schema: JSON/CSV schema inference is a
full extra pass over the input, which at terabyte scale costs as much as the
analysis itself, and it makes the column set depend on which keys a file
happens to contain.  A JSON line that does not parse is no record: the feed
leaves it out, and ``corrupt_records`` lists such lines, so that a run can
count or divert them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.schema import ARREST_SCHEMA, COMPLAINT_SCHEMA, DEMOGRAPHIC_YEARS

CORRUPT = "_corrupt_record"


def _paths(paths: str | Sequence[str]) -> list[str]:
    out = [paths] if isinstance(paths, str) else list(paths)
    if len(set(out)) != len(out):
        # A duplicated source silently double-counts every record in it.
        raise ValueError(f"duplicate input path in {out}")
    return out


def read_feed(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
              fmt: str = "json", header: bool = True) -> DataFrame:
    """Read one feed (several files or folders, e.g. history + current year)."""
    if fmt == "json":
        parsed = _json_lines(spark, paths, schema).filter(F.col(f"j.{CORRUPT}").isNull())
        return parsed.select(*[F.col(f"j.`{f.name}`") for f in schema.fields],
                             *[c for c in parsed.columns if c not in ("value", "j", *schema.fieldNames())])
    if fmt == "csv":
        # CSV columns are matched by header *name* (a fixed schema would be
        # applied by position); cells stay text, so there is no inference pass.
        raw = spark.read.option("header", header).option("mode", "PERMISSIVE").csv(_paths(paths))
        return raw.select(*[
            (F.col(f"`{f.name}`") if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields])
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(*_paths(paths))
    raise ValueError(f"unsupported feed format {fmt!r}")


def _json_lines(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Non-blank lines with their parsed record ``j``; a line that does not parse fills its corrupt field."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.text(_paths(paths)).filter(F.length(F.trim("value")) > 0)
    return lines.withColumn("j", F.from_json("value", full, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))


def corrupt_records(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """The lines of a JSON feed that ``read_feed`` leaves out, as text: ``(value)``."""
    return _json_lines(spark, paths, schema).filter(F.col(f"j.{CORRUPT}").isNotNull()).select("value")


def read_arrests(spark: SparkSession, paths, fmt: str = "json") -> DataFrame:
    return read_feed(spark, paths, ARREST_SCHEMA, fmt)


def read_complaints(spark: SparkSession, paths, fmt: str = "json") -> DataFrame:
    return read_feed(spark, paths, COMPLAINT_SCHEMA, fmt)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None, header: bool = True) -> DataFrame:
    """Generic table scan (parquet, csv with header, json)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        return r.option("header", header).csv(path)
    return r.format(fmt).load(path)


def read_demographics_wide(spark: SparkSession, path: str,
                           years: Sequence[str] = DEMOGRAPHIC_YEARS,
                           entity: str = "Borough", entity_alias: str | None = None) -> DataFrame:
    """One wide demographic CSV: entity, short/long name, one column per year.

    ``entity_alias`` renames e.g. ``Sub-Borough Area`` to ``Borough``.  Cells
    are read as text (no inference pass) and converted by ``try_cast`` later,
    so a junk cell becomes NULL instead of failing the read.  Only the listed
    year columns are kept; a year the file lacks is an all-NULL column.
    """
    df = spark.read.option("header", True).csv(path)
    if entity_alias:
        df = df.withColumnRenamed(entity_alias, entity)
    names = [entity] + [c for c in ("short_name", "long_name") if c in df.columns]
    return df.select(*names, *[F.col(f"`{y}`") if y in df.columns else F.lit(None).cast("string").alias(y)
                               for y in years])


def read_regions(spark: SparkSession, path: str, fmt: str = "csv",
                 id_col: str = "bor_subb", name_col: str = "name",
                 geometry_col: str = "geometry") -> DataFrame:
    """Region boundaries as ``(bor_subb, name, geometry WKT)``.

    ``fmt='geojson'`` reads a FeatureCollection (multi-line JSON) and turns
    each Polygon/MultiPolygon feature into WKT text with native functions.
    """
    if fmt == "geojson":
        # Explicit schema: ``coordinates`` nests to different depths for
        # Polygon and MultiPolygon, so it is kept as raw JSON text and parsed
        # per geometry type (inference would collapse both to strings).
        schema = T.StructType([T.StructField("features", T.ArrayType(T.StructType([
            T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
            T.StructField("geometry", T.StructType([
                T.StructField("type", T.StringType()),
                T.StructField("coordinates", T.StringType())]))])))])
        fc = spark.read.schema(schema).option("multiLine", True).json(path)
        feats = fc.select(F.explode("features").alias("f"))
        raw = F.col("f.geometry.coordinates")
        gtype = F.col("f.geometry.type")

        def ring_txt(ring):
            return F.array_join(F.transform(ring, lambda p: F.concat_ws(
                " ", p[0].cast("string"), p[1].cast("string"))), ", ")

        def poly_txt(poly):
            return F.concat(F.lit("("), F.array_join(F.transform(
                poly, lambda r: F.concat(F.lit("("), ring_txt(r), F.lit(")"))), ", "), F.lit(")"))

        poly = F.from_json(raw, "array<array<array<double>>>")
        multi = F.from_json(raw, "array<array<array<array<double>>>>")
        return feats.select(
            F.col("f.properties").getItem(id_col).alias("bor_subb"),
            F.col("f.properties").getItem(name_col).alias("name"),
            F.when(gtype == "Polygon", F.concat(F.lit("POLYGON "), poly_txt(poly)))
            .when(gtype == "MultiPolygon",
                  F.concat(F.lit("MULTIPOLYGON ("), F.array_join(F.transform(multi, poly_txt), ", "),
                           F.lit(")")))
            .alias("geometry"))
    # no forced schema: CSV columns are then matched by header name below
    df = read_table(spark, path, fmt)
    return df.select(F.col(id_col).cast("string").alias("bor_subb"),
                     F.col(name_col).cast("string").alias("name"),
                     F.col(geometry_col).cast("string").alias("geometry"))
