"""Loading and standardising of source tables: casts, flags, tags and filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions.ids import uuid3

#: Names and codes of the source tables.
STOP_TYPE = "Haltestelle Bahn"
TRUE = "wahr"
TRACK_FLAGS = {"cog": "zahnradbahn", "funicular": "standseilbahn", "museum": "museumsbahn", "service": "betriebsbahn", "axis_dkm": "achse_dkm"}


def bool_tag(column: str, name: str | None = None) -> Column:
    return F.when(F.col(column), F.lit(name or column))


def prefixed_tag(column: str, prefix: str = "") -> Column:
    return F.when(F.col(column).isNotNull(), F.concat(F.lit(prefix), F.col(column).cast("string")))


def tags(*columns: Column) -> Column:
    """Tags that apply, without repeats, in order."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*columns))))


def is_true(column: str) -> Column:
    return F.lower(column) == TRUE


def load_stops(df: DataFrame) -> DataFrame:
    return df.where(F.col("objektart") == STOP_TYPE).select(
        "uuid", F.expr("try_cast(datum_aenderung AS date)").alias("changed"), F.expr("try_cast(datum_erstellung AS date)").alias("created"), "name", F.expr("try_cast(dienststellen_nummer AS int)").alias("number"), "geometry"
    )


def load_tracks(df: DataFrame) -> DataFrame:
    """National topographic tracks: plain uuid, main flag, structure, five flags; those out of use are left out."""
    structure = F.when(F.lower("kunstbaute").startswith("br"), "bridge").when(F.lower("kunstbaute").startswith("tun"), "tunnel").when(F.lower("kunstbaute") != "keine", F.lower("kunstbaute"))
    return df.where(F.col("ausser_betrieb").isNull() | (F.lower("ausser_betrieb") != TRUE)).select(
        F.lower(F.regexp_replace("uuid", "[{}]", "")).alias("uuid_track"), "objektart", "verkehrsmittel", (~is_true("anschlussgleis")).alias("main"), structure.alias("structure"),
        *[is_true(source).alias(name) for name, source in TRACK_FLAGS.items()], F.expr("try_cast(anzahl_spuren AS smallint)").alias("n_tracks"), F.expr("try_cast(stufe AS smallint)").alias("level"), "name", "line",
    )


def load_sections(df: DataFrame) -> DataFrame:
    """Network register sections: decimal commas, name-based uuid; one row per feature."""
    number = lambda c: F.expr(f"try_cast(replace({c}, ',', '.') AS float)")
    return df.select(uuid3("feature_id").alias("uuid_track"), "feature_id", number("length_text").alias("length_km"), number("speed_text").alias("speed"), F.expr("try_cast(opened AS date)").alias("opened"), *[c for c in ("line",) if c in df.columns])


def load_osm(df: DataFrame) -> DataFrame:
    """Map extract: properties map<string,string> and GeoJSON text."""
    p = lambda k: F.col("properties")[k]
    return df.select(
        uuid3("geometry").alias("uuid_track"), p("ref").alias("ref"), p("track_ref").alias("track_ref"), F.coalesce(p("usage") == "main", F.lit(False)).alias("main"),
        F.expr("try_cast(properties['maxspeed'] AS int)").alias("maxspeed"), p("operator").alias("operator"), p("railway").alias("railway"), "geometry",
    )


def railway_ways(df: DataFrame, kinds: tuple[str, ...] = ("rail", "tram", "subway", "narrow_gauge")) -> DataFrame:
    """The pre-extract: ways of the kinds of railway that are wanted."""
    return df.where(F.col("properties")["railway"].isin(*kinds))


def listed(column: str, include: tuple[str, ...] = (), exclude: tuple[str, ...] = ()) -> Column:
    """In the include list and not in the exclude list; an empty list lets everything pass."""
    out = F.col(column).isin(*include) if include else F.lit(True)
    return out & ~F.col(column).isin(*exclude) if exclude else out


def main_lines(df: DataFrame, include: tuple[str, ...] = (), exclude: tuple[str, ...] = ()) -> DataFrame:
    return df.where((F.col("railway") == "rail") & F.col("main") & F.col("ref").isNotNull() & (F.size("line") > 1) & listed("operator", include, exclude))


def topo_tracks(df: DataFrame) -> DataFrame:
    flags = [bool_tag(c) for c in ("main", *TRACK_FLAGS) if c in df.columns]
    return df.where(F.size("line") > 1).select("uuid_track", "line", tags(F.lower("objektart"), F.lower("structure"), *flags).alias("tags"))


def osm_tracks(df: DataFrame) -> DataFrame:
    return df.where(F.size("line") > 1).select("uuid_track", "line", tags(F.col("railway"), prefixed_tag("operator"), prefixed_tag("ref", "line"), prefixed_tag("track_ref", "track"), bool_tag("main")).alias("tags"))


def register_tracks(df: DataFrame) -> DataFrame:
    """Multi-part sections: one row per part, cut where it doubles back; every part gets an id of its own."""
    parts = df.select("*", F.posexplode("lines").alias("_i", "_l")).select("*", F.posexplode(g.split_acute("_l")).alias("_j", "line")).where(F.size("line") > 1)
    name = F.concat_ws("#", "uuid_track", F.col("_i").cast("string"), F.col("_j").cast("string"))
    kind = F.when(F.col("electrified"), "electrified")
    return parts.select(uuid3(name).alias("uuid_track"), "line", tags(kind, F.when(F.col("n_tracks") > 1, "multitrack"), F.when(F.col("usage").isin("high speed", "main"), F.col("usage")), prefixed_tag("line_number", "line")).alias("tags"))
