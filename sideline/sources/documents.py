"""JSON documents: array files and envelopes of team-week rows.

A document is one JSON value per file, so a file is the unit of parallelism here. Large volumes
belong in parquet or JSON lines with the canonical columns (``read_table_rows``).
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sideline import config, schemas
from sideline.functions.lineage import written
from sideline.operators import quality
from sideline.operators.quality import QualityError

_STRICT_JSON = "map('mode', 'PERMISSIVE', 'allowNonNumericNumbers', 'false', 'columnNameOfCorruptRecord', '_bad')"
_ENVELOPE = (
    "artifact string, generatedAt string, season string, sourceArtifacts string, "
    "metadata string, rows string"
)


def _is_file(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(where) and files.getFileStatus(where).isFile()


def plain_path(uri: Column) -> Column:
    """A file's address as a path: no file: scheme, no percent escapes."""
    text = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(text, "^file:(//)?(?=/)", "")


def scan_documents(spark: SparkSession, path: str) -> DataFrame:
    """One file of any name, or all ``*.json`` files of a folder (any case, not recursive):
    (sourceFile, text)."""
    only = {} if _is_file(spark, path) else {"pathGlobFilter": "*.[jJ][sS][oO][nN]"}
    docs = (
        spark.read.text(path, wholetext=True, **only)
        .select(plain_path(F.col("_metadata.file_path")).alias("sourceFile"), F.col("value").alias("text"))
    )
    if not docs.inputFiles():
        raise QualityError(f"No .json files found in input directory: {path}")
    return docs


def parse_documents(docs: DataFrame) -> DataFrame:
    """Parse each document into its envelope fields; a top-level array becomes ``rows``.

    The text is wrapped in an object, so text after the first JSON value makes it malformed.
    """
    wrapped = docs.selectExpr("sourceFile", "ltrim(' \\n\\r\\t\\uFEFF', text) AS text").selectExpr(
        "sourceFile", "startswith(text, '[') AS isArray", "startswith(text, '{') AS isEnvelope",
        "text", "concat('{\"doc\":', text, '}') AS wrapped",
    )
    parsed = wrapped.selectExpr(
        "sourceFile", "isArray", "isEnvelope",
        f"if(isEnvelope, from_json(wrapped, 'doc struct<{_ENVELOPE.replace(' string', ': string')}>, _bad string', {_STRICT_JSON}), NULL) AS e",
        f"if(isArray, from_json(wrapped, 'doc array<string>, _bad string', {_STRICT_JSON}), NULL) AS a",
    )
    return parsed.selectExpr(
        "sourceFile", "isArray", "isEnvelope",
        "coalesce(e._bad, a._bad) IS NOT NULL OR (isEnvelope AND e.doc IS NULL)"
        " OR (isArray AND a.doc IS NULL) AS malformed",
        "e.doc.*", "a.doc AS arrayRows",
    )


def document_rules() -> list[quality.Rule]:
    """Rules of whole documents, checked before their rows."""
    raw = config.ARTIFACT_RAW
    return [
        quality.Rule("malformed", "concat('Invalid JSON in ', sourceFile)"),
        quality.Rule("NOT malformed AND NOT isArray AND NOT isEnvelope",
                     quality.text(f"Invalid {raw} artifact: expected object envelope.")),
        quality.Rule(f"NOT malformed AND isEnvelope AND NOT artifact <=> '{raw}'",
                     f"concat('Invalid artifact literal: expected {raw}, received ', "
                     "coalesce(artifact, 'undefined'))"),
        quality.Rule("NOT malformed AND isEnvelope AND NOT coalesce(startswith(rows, '['), false)",
                     quality.text(f"Invalid {raw} artifact: rows must be an array.")),
    ]


def _exploded(parsed: DataFrame, texts: str, schema: StructType, keep=(), spread: bool = False) -> DataFrame:
    """One row per record: its typed fields, and ``raw`` with the text of every key present.

    ``spread`` deals the records of a document to all tasks before their fields are parsed.
    """
    rows = parsed.selectExpr("sourceFile", *keep, f"posexplode({texts}) AS (rowIndex, record)")
    if spread:
        rows = rows.repartition("sourceFile", "rowIndex")
    # a generator parses each record once, however many rules read its fields
    fields = f"from_json(record, 'array<struct<{schema.toDDL()}>>', {_STRICT_JSON})"
    return rows.selectExpr(
        "sourceFile", "rowIndex", *keep,
        "coalesce(startswith(ltrim(record), '{'), false) AS isObject",
        f"from_json(record, 'map<string,string>', {_STRICT_JSON}) AS raw",
        f"inline_outer({fields})",
    )


def array_records(parsed: DataFrame, spread: bool = False) -> DataFrame:
    """Records of array documents, in snake_case."""
    return _exploded(parsed.where("isArray"), "arrayRows", schemas.RAW_ROW, spread=spread)


def envelope_records(parsed: DataFrame, spread: bool = False) -> DataFrame:
    """Records of envelope documents, in camelCase, with the declared provenance."""
    texts = f"from_json(rows, 'array<string>', {_STRICT_JSON})"
    status = "get_json_object(metadata, '$.provenanceStatus') AS provenanceStatus"
    docs = parsed.where("isEnvelope").selectExpr("*", status)
    return _exploded(docs, texts, schemas.ENVELOPE_ROW, ["provenanceStatus"], spread)


def _renamed(records: DataFrame, names: dict[str, str]) -> DataFrame:
    return records.selectExpr(
        *schemas.ORIGIN,
        *[f"if(abs({raw}) <= 1.7976931348623157E308D, {raw}, NULL) AS {name}"
          if name in schemas.SPLITS else f"{raw} AS {name}" for raw, name in names.items()],
    )


def canonical_from_array(records: DataFrame) -> DataFrame:
    """Raw columns under their canonical names; a split that is not a finite number is absent."""
    return _renamed(records, schemas.RAW_NAMES)


def canonical_from_envelope(records: DataFrame) -> DataFrame:
    return _renamed(records, schemas.ENVELOPE_NAMES)


def _violations(parsed: DataFrame, arrays: DataFrame, envelopes: DataFrame) -> DataFrame:
    located = list(schemas.ORIGIN)
    whole = quality.violations(parsed.selectExpr("*", "-1 AS rowIndex"), document_rules(), located)
    return whole.unionByName(
        quality.violations(arrays, quality.raw_array_rules(), located)
    ).unionByName(quality.violations(envelopes, quality.envelope_rules(), located))


def raw_violations(parsed: DataFrame) -> DataFrame:
    """Everything wrong with the documents and the shape of their rows."""
    return _violations(parsed, array_records(parsed), envelope_records(parsed))


def parsed_once(docs: DataFrame) -> DataFrame:
    """Parsed documents as a stored table: their texts are read and parsed a single time."""
    return docs if "malformed" in docs.columns else written(parse_documents(docs), "documents")


def load_rows(docs: DataFrame) -> DataFrame:
    """Canonical rows of checked documents, with their file and position. Raises on the first error.

    Documents and records are read by every later step, so both are parsed once and kept. Broken rules
    are counted while they are written; the rows are looked at again only for the message of an error. ``docs`` are scanned
    or already parsed documents.
    """
    located = list(schemas.ORIGIN)
    of_documents, of_arrays, of_envelopes = (quality.Watch(rules(), located) for rules in (
        document_rules, quality.raw_array_rules, quality.envelope_rules))
    ready = "malformed" in docs.columns
    parsed = docs if ready else written(of_documents.watch(parse_documents(docs)), "documents")
    arrays = written(of_arrays.watch(array_records(parsed, spread=True)), "arrays")
    envelopes = written(of_envelopes.watch(envelope_records(parsed, spread=True)), "envelopes")
    if ready or not (of_documents.clean() and of_arrays.clean() and of_envelopes.clean()):
        quality.require_clean(_violations(parsed, arrays, envelopes), schemas.ORIGIN)
    return canonical_from_array(arrays).unionByName(canonical_from_envelope(envelopes))


def declared_provenance(docs: DataFrame) -> str | None:
    """Provenance of the last file, in name order, that declares one."""
    declared = parsed_once(docs).selectExpr(
        "sourceFile", "get_json_object(metadata, '$.provenanceStatus') AS status"
    )
    key = F.collate(F.col("sourceFile"), "UNICODE")
    row = declared.where("status IS NOT NULL").agg(F.max_by("status", key).alias("status")).first()
    return row["status"]


def canonical_records(docs: DataFrame) -> DataFrame:
    """Rows of array documents, scanned or parsed, that already have the canonical column names (not yet checked)."""
    parsed = parsed_once(docs)
    if not parsed.where("malformed OR NOT isArray").isEmpty():
        raise QualityError("Expected an array of team-week rows in input JSON.")
    records = _exploded(parsed, "arrayRows", schemas.CANONICAL_ROW)
    return records.select(*schemas.ORIGIN, *schemas.CANONICAL_ROW.names)


def read_canonical(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a document, or of all .json files of a folder, with canonical column names (not yet checked)."""
    return canonical_records(scan_documents(spark, path))


def read_table_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Canonical rows stored as a splittable table: parquet, orc or JSON lines."""
    reader = spark.read.format(fmt)
    if fmt == "json":
        reader = reader.schema(schemas.TEAM_WEEK)
    return reader.load(path)


def typed_keys(rows: DataFrame) -> DataFrame:
    """Season and week as integers, once the rules have shown that they are."""
    return rows.withColumns({k: F.col(k).cast("int") for k in ("season", "week")})
