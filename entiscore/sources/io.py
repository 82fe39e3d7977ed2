"""Sources and sinks (S1–S3, S6) with declared schemas.

Readers never infer types from the data at scale: delimited and JSON files
are read with an explicit schema (inference would run an extra pass over
the whole input), and every reader returns a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entiscore.session import stored

# Declared schemas of the delimited / JSON inputs.
TERM_SCHEMA = "`Name` string, `Subcellular location ID` string, `Is a` string, `Is part of` string"
PHENOTYPE_SCORE_SCHEMA = "id string, label string, score double"
SYMBOL_PAIR_SCHEMA = "hgnc_protein string, EFO_disease string, Therapy_area string"
ATLAS_SCHEMA = ("Ensembl string, `RNA tissue distribution` string, `RNA tissue specificity` string, "
                "Antibody array<string>")
ATLAS_COLUMNS = ("Ensembl", "RNA tissue distribution", "RNA tissue specificity", "Antibody")

# The nested fields of the entity table that the operators read. Higher-order
# functions over arrays of structs do not prune unused struct fields from the
# parquet scan, so reading the entity table with this schema is what keeps
# the scan to these leaf columns on wide real-world records.
ENTITY_READ_SCHEMA = (
    "id string, approvedSymbol string, biotype string, "
    "subcellularLocations array<struct<location:string,source:string,termSL:string>>, "
    "tractability array<struct<id:string,value:boolean>>, "
    "safetyLiabilities array<struct<event:string>>, "
    "constraint array<struct<constraintType:string,upperRank:int>>, "
    "homologues array<struct<homologyType:string,speciesName:string,queryPercentageIdentity:double>>, "
    "hallmarks struct<attributes:array<struct<description:string>>>, "
    "tep struct<description:string>, "
    "chemicalProbes array<struct<isHighQuality:boolean,mechanismOfAction:string,urls:array<struct<url:string>>>>"
)


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A Parquet file or directory; ``columns`` prunes the scan."""
    df = spark.read.parquet(path)
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def scan_entities(spark: SparkSession, path: str | Sequence[str], schema: str = ENTITY_READ_SCHEMA) -> DataFrame:
    """S1 for the entity table: parquet read with the declared nested schema,
    so only the struct fields the operators use are read from disk. Several
    paths are releases whose schemas may differ (:func:`scan_releases`)."""
    if isinstance(path, str):
        return spark.read.schema(schema).parquet(path)
    return scan_releases(spark, path, schema)


def _as_written(wanted: T.DataType, written: T.DataType | None, where: str) -> T.DataType:
    """The type to read ``wanted`` with: its own nesting and field names, and
    the leaf types of the file. Fields that the file lacks keep their type."""
    if written is None:
        return wanted
    if isinstance(wanted, T.StructType) and isinstance(written, T.StructType):
        there = {f.name: f.dataType for f in written.fields}
        return T.StructType([T.StructField(f.name, _as_written(f.dataType, there.get(f.name), f"{where}.{f.name}".lstrip(".")))
                             for f in wanted.fields])
    if isinstance(wanted, T.ArrayType) and isinstance(written, T.ArrayType):
        return T.ArrayType(_as_written(wanted.elementType, written.elementType, f"{where}[]"))
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(wanted, nested) or isinstance(written, nested):
        raise ValueError(f"{where} is {written.simpleString()} in the file, {wanted.simpleString()} was asked for")
    return written


def scan_releases(spark: SparkSession, paths: Sequence[str], schema: str = ENTITY_READ_SCHEMA) -> DataFrame:
    """S1 for parquet folders written by several releases: one frame in the
    declared schema, with the rows of all of them.

    The schema of each path is taken from its footers, which Spark merges in a
    job, and reconciled with the declared one: a column or struct field that a
    release lacks is null, others are not read, and a leaf of another type is
    cast. A value that does not fit the declared type fails the read (ANSI
    casts); a field that is nested in one and a plain value in the other, or two
    files of one path that contradict each other, raise at once."""
    wanted = T.StructType.fromDDL(schema)
    out = None
    for path in paths:
        read = _as_written(wanted, spark.read.option("mergeSchema", True).parquet(path).schema, "")
        rows = spark.read.schema(read).parquet(path).select(
            *[F.col(f"`{f.name}`") if read[f.name].dataType == f.dataType else F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
              for f in wanted.fields])
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no path to read")
    return out


def scan_delimited(spark: SparkSession, path: str, sep: str = "\t", header: bool = True,
                   schema: str | None = None) -> DataFrame:
    """Header TSV/CSV. With ``schema`` its columns are taken from the file
    by header name, in any order and among any others, and cast; a name that
    the header lacks raises. An unnamed column of the file can be asked for as
    ``_c<i>``. Without a schema every column is a string named from the header.
    A malformed line, or a value that does not cast, fails the read."""
    rows = spark.read.option("sep", sep).option("header", header).option("mode", "FAILFAST").option("inferSchema", False).csv(path)
    if schema is None:
        return rows
    wanted = T.StructType.fromDDL(schema)
    missing = [f.name for f in wanted if f.name not in rows.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {rows.columns}")
    return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted])


def scan_delimited_tolerant(spark: SparkSession, path: str, quarantine: str, sep: str = "\t",
                            schema: str | None = None) -> tuple[DataFrame, int]:
    """S2 for inputs with bad lines: (the lines that parse, the number that do
    not). A bad line's text is written to ``quarantine`` as in
    :func:`scan_json_tolerant`. A line is bad if it has more or fewer values than
    the header, or a value of ``schema`` that does not fit its type; values of
    columns that the schema does not name are not looked at. The columns are
    those of :func:`scan_delimited`; a header without lines gives no rows and 0."""
    names = spark.read.option("sep", sep).option("header", True).csv(path).columns
    typed = {f.name: f.dataType for f in T.StructType.fromDDL(schema).fields} if schema else dict.fromkeys(names, T.StringType())
    missing = [c for c in typed if c not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {names}")
    full = T.StructType([T.StructField(c, typed.get(c, T.StringType())) for c in names] + [T.StructField(_BAD, T.StringType())])
    rows = (spark.read.option("sep", sep).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _BAD).schema(full).csv(path))
    return _set_bad_aside(rows, quarantine, list(typed), "delimited-lines")


_BAD = "_corrupt_record"


def _set_bad_aside(rows: DataFrame, quarantine: str, columns: Sequence[str], name: str) -> tuple[DataFrame, int]:
    # Parsed once, with every column: a record is bad by any of them, also by one that later plans do not read.
    rows = stored(rows, name)
    broken = rows.filter(F.col(_BAD).isNotNull()).select(F.col(_BAD).alias("record"))
    n = broken.count()
    if n:
        broken.write.mode("errorifexists").json(quarantine)
    return rows.filter(F.col(_BAD).isNull()).select(*[F.col(f"`{c}`") for c in columns]), n


def scan_json_records(spark: SparkSession, path: str, columns: Sequence[str] = ATLAS_COLUMNS,
                      schema: str = ATLAS_SCHEMA, multi_line: bool = False) -> DataFrame:
    """S3: JSON records (one per line, or a single array per line), keeping
    ``columns``. A column of the schema that a record lacks is null; a column
    that the schema lacks raises, and a malformed record fails the read.
    ``multi_line`` for pretty-printed files. The read is distributed; nothing
    passes through the driver."""
    df = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST").schema(schema).json(path)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"the schema has no column {', '.join(missing)}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def scan_json_tolerant(spark: SparkSession, path: str, quarantine: str, columns: Sequence[str] = ATLAS_COLUMNS,
                       schema: str = ATLAS_SCHEMA, multi_line: bool = False) -> tuple[DataFrame, int]:
    """S3 for inputs with bad records: (the records that parse, the number that
    do not). A bad record's text is written, as JSON lines, to the folder
    ``quarantine``, which must not exist; nothing is written if there is none.
    A record is bad if its text does not parse or a value does not fit its
    type. The records are parsed once, into a table in the shared checkpoint
    folder; an empty input gives no rows and 0."""
    declared = T.StructType.fromDDL(schema)
    missing = [c for c in columns if c not in declared.names]
    if missing:
        raise ValueError(f"the schema has no column {', '.join(missing)}")
    rows = (spark.read.option("multiLine", multi_line).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD)
            .schema(T.StructType([*declared.fields, T.StructField(_BAD, T.StringType())])).json(path))
    return _set_bad_aside(rows, quarantine, columns, "json-records")


def write_json_report(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "gzip") -> str:
    """Write a report as JSON lines; the file count is left to Spark
    (no ``coalesce(1)``: the write stays parallel). The files are compressed,
    for every row repeats the column names (``compression="none"``: plain
    text); Spark's JSON reader takes either. Returns ``path``."""
    df.write.mode(mode).option("compression", compression).json(path)
    return path


def write_delimited(df: DataFrame, path: str, sep: str = "\t", mode: str = "overwrite") -> str:
    """Write a header TSV/CSV (used to hand term lists to other tools)."""
    df.write.mode(mode).option("sep", sep).option("header", True).csv(path)
    return path
