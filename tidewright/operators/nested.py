"""Nested records as flat child tables that keep the link to their record and their place in it.

One projection per record: transform calls over the arrays attach the ancestors' keys and indices, flatten joins the arrays, and one inline
emits the rows of a child table. Nothing is shuffled and nothing is exploded twice."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.session import spread

VARIANTS = "array<variant>"


@dataclass(frozen=True)
class Child:
    """A collection of objects in a record. path: its field in each root object, or '' if the roots are the collection.
    key: the field that names an object. parent: a field of the object with the number of its parent, or '' (0)."""

    name: str
    path: str
    key: str
    parent: str = ""


def let(x: Column, body) -> Column:
    """body(x) with x computed once."""
    return F.transform(F.array(x), body)[0]


def parsed(text: Column) -> Column:
    """JSON text as a variant; null if the text isn't valid JSON as a whole (with a repeated key in an object it counts as invalid).

    The text is read as the first of two entries, of which the second must be found where it was put: a parser that stops after
    the first complete value would otherwise take text with something after it, or with one bracket too many, for JSON."""
    return let(
        F.try_parse_json(F.concat(F.lit("["), text, F.lit(",7]"))),
        lambda v: F.when((F.try_variant_get(v, "$[1]", "string") == "7") & F.try_variant_get(v, "$[2]", "string").isNull(), F.try_variant_get(v, "$[0]", "variant")),
    )


def is_object(v: Column) -> Column:
    """Whether a variant is an object: only that can be read as a struct, here one of a field that needn't exist, so that nothing is rendered."""
    return F.try_variant_get(v, "$", "struct<_:string>").isNotNull()


def unquoted(v: Column) -> Column:
    """Objects as they are; of others the variant of the JSON text that they hold, or are written as."""
    return F.when(is_object(v), v).otherwise(parsed(F.try_variant_get(v, "$", "string")))


def entries(v: Column) -> Column:
    """The entries of a collection in any of its forms (an array, a single object, or text that holds either), in place, nulls too;
    an empty array for anything else."""
    listed = lambda x: F.coalesce(F.try_variant_get(x, "$", VARIANTS), F.when(is_object(x), F.array(x)), F.array().cast(VARIANTS))
    return let(v, lambda x: F.coalesce(F.try_variant_get(x, "$", VARIANTS), let(unquoted(x), listed)))


def child_rows(roots: Column, child: Child) -> Column:
    """The objects of one collection in all root objects: array of (child, parent_seq, pos, child_key, object)."""

    def objects(items: Column) -> Column:
        placed = F.transform(
            items,
            lambda e, i: F.struct(
                F.lit(child.name).alias("child"),
                (F.coalesce(F.try_variant_get(e, f"$.{child.parent}", "string").try_cast("int"), F.lit(0)) if child.parent else F.lit(0)).alias("parent_seq"),
                i.alias("pos"),
                F.coalesce(F.try_variant_get(e, f"$.{child.key}", "string"), F.lit("")).alias("child_key"),
                e.alias("object"),
            ),
        )
        return F.filter(placed, lambda x: is_object(x.object))

    if not child.path:
        return objects(roots)
    return F.flatten(F.transform(roots, lambda r: objects(entries(F.try_variant_get(r, f"$.{child.path}", "variant")))))


def explode_children(df: DataFrame, record_key: str, text: str, children: list[Child]) -> DataFrame:
    """One row per object in the children's collections: record_key, child, parent_seq int, pos int, child_key string, object variant.

    The text, and each collection, may be an array, a single object (position 0) or a string that holds the JSON text of either.
    Positions count from 0; entries that are null, or no objects, take a position but give no row. Text that is null, empty or not valid
    JSON gives none. child_key is empty if absent or null; parent_seq is 0 if absent or not a number. Repeated records give
    their rows each time; other columns are ignored. The parts of a record are parsed once."""
    texts = spread(df.select(F.col(record_key).cast("string").alias("record_key"), F.col(text).alias("_text")))
    roots = texts.select("record_key", entries(parsed(F.col("_text"))).alias("_roots"))
    return roots.select("record_key", F.inline(F.concat(*[child_rows(F.col("_roots"), c) for c in children])))


def child_table(df: DataFrame, record_key: str, text: str, child: Child, fields: dict[str, str]) -> DataFrame:
    """The flat table of one collection: record_key, parent_seq, pos, child_key and the fields (name: SQL type) of the object, a value
    that doesn't fit its type being null."""
    rows = explode_children(df, record_key, text, [child])
    return rows.select("record_key", "parent_seq", "pos", "child_key", *[F.try_variant_get(F.col("object"), f"$.{f}", "string").try_cast(t).alias(f) for f, t in fields.items()])
