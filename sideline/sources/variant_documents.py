"""JSON documents of any shape: one value per file, with the types as they were written."""

from pyspark.sql import DataFrame, SparkSession

from sideline.functions import variants
from sideline.sources import documents


def read_values(docs: DataFrame) -> DataFrame:
    """(sourceFile, value) of texts: a variant, null where the text is not exactly one JSON value.

    Unlike columns of a fixed type, a variant keeps whether 2026 was written as a number, a text or
    not at all. Keys that an object repeats make it malformed. The parser passes over what follows a
    value, so the text is parsed inside an array and inside an object: what follows cannot end both.
    """
    text = "ltrim(' \\n\\r\\t\\uFEFF', text)"
    parsed = docs.selectExpr("sourceFile", f"try_parse_json(concat('[', {text}, ']')) AS a", f"try_parse_json(concat('{{\"v\":', {text}, '}}')) AS o")
    one = f"a IS NOT NULL AND o IS NOT NULL AND size({variants.items('a')}) = 1"
    return parsed.selectExpr("sourceFile", f"if({one}, variant_get(a, '$[0]', 'variant'), NULL) AS value")


def scan_values(spark: SparkSession, path: str) -> DataFrame:
    """Values of one file, or of all .json files of a folder."""
    return read_values(documents.scan_documents(spark, path))


def exploded(values: DataFrame, array: str, name: str, *keep: str) -> DataFrame:
    """One row per item of an array: (sourceFile, *keep, rowIndex, ``name``, ``fields`` as a map or null)."""
    rows = values.selectExpr("sourceFile", *keep, f"posexplode({variants.items(array)}) AS (rowIndex, {name})")
    return rows.selectExpr("*", f"{variants.fields(name)} AS fields")
