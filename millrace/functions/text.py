"""Text columns: name splitting and scalar values out of JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def word(text: Column, index: int) -> Column:
    """The index-th blank-separated word, NULL where the text has fewer."""
    return F.get(F.split(text, " "), F.lit(index))


def split_name(df: DataFrame, column: str, first: str = "FirstName", last: str = "LastName") -> DataFrame:
    """Replace a full-name column by first and last name."""
    return df.withColumns({first: word(F.col(column), 0), last: word(F.col(column), 1)}).drop(column)


def json_paths(df: DataFrame, document: str, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """Values at several paths of a JSON column, which is parsed once per row into a VARIANT.

    ``paths`` maps new columns to (path, type). NULL where the document does not
    parse, has nothing at the path, or a value that does not fit the type. With the
    type ``kind`` a column names the type of what is there, OBJECT and ARRAY for
    nested values.
    """
    parsed = df.withColumn("_document", F.try_parse_json(document))

    def value(path: str, kind: str) -> Column:
        if kind == "kind":
            found = F.schema_of_variant(F.try_variant_get("_document", path, "variant"))
            return F.regexp_extract(found, "^[A-Z]+", 0)
        return F.try_variant_get("_document", path, kind)

    return parsed.select(*df.columns, *[value(*p).alias(name) for name, p in paths.items()])


def json_value(document: Column, path: str) -> Column:
    """Scalar at a JSON path as text; NULL for objects, arrays and bad JSON."""
    value = F.get_json_object(document, path)
    # A text value may itself begin with a bracket; only then is the document's
    # own type at that path looked up.
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(document), path, "variant"))
    nested = value.rlike(r"^\s*[\[{]") & F.coalesce(kind.rlike("^(OBJECT|ARRAY)"), F.lit(True))
    return F.when(~nested, value)
