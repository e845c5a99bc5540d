"""Writing data sets of a run."""

from pyspark.sql import DataFrame


def write_dataset(df: DataFrame, folder: str, name: str, fmt: str = "json", by: tuple = ()) -> str:
    """Write one named data set, replacing an earlier one; folders are created as needed."""
    target = f"{folder.rstrip('/')}/{name}"
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", False)
    if by:
        writer = writer.partitionBy(*by)
    writer.save(target)
    return target
