"""Text helpers: collation order and source path labels."""

from pyspark.sql import Column
from pyspark.sql import functions as F

SAMPLE_DIR = "/data/sample/"
FIXTURE_DIR = "/fixtures/"


def locale_order(c: Column) -> Column:
    """Sort key in dictionary order instead of binary order."""
    return F.collate(c, "UNICODE")


def normalized_path(path: Column) -> Column:
    """Forward slashes, no leading ./, cut to the part from the sample or fixture folder on."""
    p = F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), r"^\./", "")
    sample, fixture = F.instr(p, SAMPLE_DIR), F.instr(p, FIXTURE_DIR)
    tail = lambda at: F.substring(p, at + 1, F.length(p))
    cut = F.when(sample > 0, tail(sample)).when(fixture > 0, tail(fixture)).otherwise(p)
    return F.when(path != "", cut)


def path_type(path: Column) -> Column:
    """sample, fixture or unknown."""
    p = normalized_path(path)
    return (
        F.when(p.startswith("data/sample/"), "sample")
        .when(p.startswith("fixtures/") | p.contains(FIXTURE_DIR), "fixture")
        .otherwise("unknown")
    )
