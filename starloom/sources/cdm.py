"""Metadata-driven ingest of entity exports: manifest -> definitions ->
typed CSV scan -> raw table, with a quarantine and a per-entity report.

Layout (as in the source): ``<base>/<folder>/<folder>.manifest.cdm.json``,
``<base>/<folder>/<entity>.cdm.json`` and ``<base>/<folder>/<entity>/*.csv``.
Metadata files are read with Spark's JSON reader; only the attribute list
(a few hundred names at most) reaches the driver, never the data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources import drift
from starloom.sources.catalog import write_raw

# Source dataFormat name -> Spark type. Decimal maps to DOUBLE
# as in the source (lossy for money; pass decimal_type to keep precision).
# A missing dataFormat, or any other name, falls back to STRING.
TYPE_MAP: dict[str, T.DataType] = {
    "String": T.StringType(),
    "Int32": T.IntegerType(),
    "Int64": T.LongType(),
    "Double": T.DoubleType(),
    "Decimal": T.DoubleType(),
    "Boolean": T.BooleanType(),
    "Date": T.DateType(),
    "DateTime": T.TimestampType(),
    "Guid": T.StringType(),
}
CORRUPT = "_corrupt_record"
FOLDERS = ("Purchase", "Hr", "Sales", "Others")


def manifest_path(base: str, folder: str) -> str:
    return f"{base}/{folder}/{folder}.manifest.cdm.json"


def definition_path(base: str, folder: str, entity: str) -> str:
    return f"{base}/{folder}/{entity}.cdm.json"


def data_path(base: str, folder: str, entity: str) -> str:
    return f"{base}/{folder}/{entity}"


def read_manifest(spark: SparkSession, path: str) -> list[str]:
    """Entity names listed by a manifest, in manifest order."""
    return [name for name, _ in read_manifest_entities(spark, path)]


# CSV partition trait and its argument names -> reader options.
CSV_TRAIT = "is.partition.format.CSV"
TRAIT_OPTIONS = {"columnHeaders": "header", "delimiter": "delimiter", "escape": "escape",
                 "quote": "quote", "encoding": "encoding", "newline": "lineSep"}


def _field_names(dt: T.DataType) -> list[str]:
    if isinstance(dt, T.ArrayType):
        dt = dt.elementType
    return dt.fieldNames() if isinstance(dt, T.StructType) else []


def read_manifest_entities(spark: SparkSession, path: str) -> list[tuple[str, dict[str, str]]]:
    """(entity name, CSV reader options) per manifest entity, in order.

    Options come from the CSV format trait on the entity's data partitions
    (``dataPartitions[].exhibitsTraits[]`` with ``traitReference``
    is.partition.format.CSV and ``arguments`` name/value pairs): header,
    delimiter, escape, quote, encoding, newline. Absent traits give {}.
    """
    m = spark.read.option("multiLine", True).json(path)
    ents = m.select(F.posexplode("entities").alias("pos", "e"))
    efields = _field_names(ents.schema["e"].dataType)
    if "dataPartitions" not in efields:
        rows = ents.select("pos", F.col("e.entityName").alias("name")).orderBy("pos").collect()
        return [(r["name"], {}) for r in rows]
    parts = ents.select("pos", F.col("e.entityName").alias("name"),
                        F.explode_outer("e.dataPartitions").alias("p"))
    pfields = _field_names(parts.schema["p"].dataType)
    if "exhibitsTraits" not in pfields:
        rows = parts.select("pos", "name").distinct().orderBy("pos").collect()
        return [(r["name"], {}) for r in rows]
    tr = parts.select("pos", "name", F.explode_outer("p.exhibitsTraits").alias("t"))
    tfields = _field_names(tr.schema["t"].dataType)
    if "arguments" not in tfields or "traitReference" not in tfields:
        rows = tr.select("pos", "name").distinct().orderBy("pos").collect()
        return [(r["name"], {}) for r in rows]
    args = tr.select("pos", "name", F.col("t.traitReference").alias("ref"),
                     F.explode_outer("t.arguments").alias("a"))
    args = args.select("pos", "name", "ref", F.col("a.name").alias("k"), F.col("a.value").alias("v"))
    out: dict[int, tuple[str, dict[str, str]]] = {}
    for r in args.orderBy("pos").collect():  # metadata only: a few rows per entity
        name, opts = out.setdefault(r["pos"], (r["name"], {}))
        if r["ref"] == CSV_TRAIT and r["k"] in TRAIT_OPTIONS and r["v"] is not None:
            opts[TRAIT_OPTIONS[r["k"]]] = str(r["v"])
    return [out[p] for p in sorted(out)]


@dataclass
class EntitySchema:
    schema: T.StructType
    fallbacks: list[tuple[str, str | None]] = field(default_factory=list)


def read_definition(spark: SparkSession, path: str, decimal_type: str | None = None) -> EntitySchema:
    """StructType from ``definitions[0].hasAttributes`` (attribute order kept,
    every field nullable). Attributes whose dataFormat is missing or unknown
    become STRING and are listed in ``fallbacks``."""
    d = spark.read.option("multiLine", True).json(path)
    attrs = d.select(F.col("definitions").getItem(0).getField("hasAttributes").alias("a"))
    attrs = attrs.select(F.posexplode("a").alias("pos", "attr"))
    attr_type = attrs.schema["attr"].dataType
    has_fmt = isinstance(attr_type, T.StructType) and "dataFormat" in attr_type.fieldNames()
    fmt = F.col("attr.dataFormat") if has_fmt else F.lit(None).cast("string")
    rows = attrs.select("pos", F.col("attr.name").alias("name"), fmt.alias("fmt")).orderBy("pos").collect()
    return build_schema([(r["name"], r["fmt"]) for r in rows], decimal_type)


def build_schema(attrs: list[tuple[str, str | None]], decimal_type: str | None = None) -> EntitySchema:
    fields, fallbacks = [], []
    for name, fmt in attrs:
        if fmt == "Decimal" and decimal_type:
            p, sc = (int(x) for x in decimal_type.strip().lower()
                     .removeprefix("decimal(").removesuffix(")").split(","))
            dt = T.DecimalType(p, sc)
        elif fmt in TYPE_MAP:
            dt = TYPE_MAP[fmt]
        else:
            dt = T.StringType()
            fallbacks.append((name, fmt))
        fields.append(T.StructField(name, dt, True))
    return EntitySchema(T.StructType(fields), fallbacks)


def read_entity(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
                delimiter: str = ",", recursive: bool = False, infer: bool = False,
                options: dict[str, str] | None = None) -> DataFrame:
    """Typed CSV scan. Malformed rows (bad cell, too few or too many cells)
    keep their text in ``_corrupt_record`` instead of being silently nulled.
    Binding is positional; with ``header`` the first line of each file is
    skipped, so header-less exports must pass header=False."""
    r = spark.read.option("header", header).option("delimiter", delimiter)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    if infer:
        return r.option("inferSchema", True).csv(path)
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    return (r.schema(full).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", CORRUPT).csv(path))


def read_text(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """Plain text scan (one row per line, or per file with ``whole``)."""
    return spark.read.text(path, wholetext=whole)


def _exists(spark: SparkSession, path: str) -> bool:
    """Is there anything at ``path``, in whatever file system it names?"""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


@dataclass
class EntityResult:
    folder: str
    entity: str
    status: str
    error: str | None = None
    rows: int | None = None
    bad_rows: int | None = None
    fallbacks: str | None = None
    drift: str | None = None


REPORT_SCHEMA = ("folder string, entity string, status string, error string, rows long, "
                 "bad_rows long, fallbacks string, drift string")


def entity_options(header: bool, delimiter: str, options: dict[str, str] | None, recursive: bool) -> dict[str, str]:
    """The CSV reader's options; those of the manifest's trait win."""
    return {"header": str(header).lower(), "delimiter": delimiter, **(options or {}),
            **({"recursiveFileLookup": "true"} if recursive else {})}


def ingest_entity(spark: SparkSession, base: str, folder: str, entity: str, raw_root: str,
                  fmt: str = "parquet", header: bool = True, delimiter: str = ",",
                  decimal_type: str | None = None, options: dict[str, str] | None = None,
                  recursive: bool = False, by_header: bool = False) -> EntityResult:
    """One entity: definition -> typed scan -> raw table (+ quarantine).
    ``options`` (from the manifest's CSV trait) override header/delimiter.

    Every file's header is read. With ``by_header`` its columns are bound by
    name, new ones are kept, and columns whose cells outgrow the declared type
    are widened (see ``drift``); without, a file whose header is not the
    definition raises. Files without headers are bound by position.
    """
    es = read_definition(spark, definition_path(base, folder, entity), decimal_type)
    csv, path = entity_options(header, delimiter, options, recursive), data_path(base, folder, entity)
    found = drift.layouts(spark, path, csv) if csv["header"] == "true" else []
    if csv["header"] == "true" and not by_header:
        drift.check_headers(found, es.schema)
    differs = drift.differences(found, es.schema) if by_header else []
    bad = F.col(CORRUPT).isNotNull()

    def load(wide: dict[str, str]) -> tuple[DataFrame, int, int]:
        """Writes the valid rows; returns all rows and the numbers of valid and rejected ones."""
        if by_header and csv["header"] == "true":
            df = drift.read_by_header(spark, found, drift.full_schema(found, es.schema, wide), csv)
        else:
            df = read_entity(spark, path, es.schema, header, delimiter, recursive=recursive, options=options)
        obs = Observation(f"ingest_{folder}_{entity}")
        # counts are gathered during the write itself: no second pass over the files
        observed = df.observe(obs, F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"))
        write_raw(observed.filter(~bad).drop(CORRUPT), f"{raw_root}/{folder}/{entity}", fmt)
        return df, int(obs.get.get("good") or 0), int(obs.get.get("bad") or 0)
    df, n_good, n_bad = load({})
    if n_bad and by_header and (wide := drift.needed(spark, found, es.schema, csv)):
        differs += drift.widened(found, es.schema, wide)
        df, n_good, n_bad = load(wide)
    quarantine = f"{raw_root}/_quarantine/{folder}/{entity}"
    if n_bad or _exists(spark, quarantine):  # a clean run empties what an earlier one left
        write_raw(df.filter(bad), quarantine, fmt)
    fb = ", ".join(f"{n}:{f}" for n, f in es.fallbacks) or None
    return EntityResult(folder, entity, "loaded", None, n_good, n_bad, fb, "; ".join(map(str, differs)) or None)


def ingest(spark: SparkSession, base: str, raw_root: str, folders=FOLDERS, fmt: str = "parquet",
           header: bool = True, delimiter: str = ",", decimal_type: str | None = None,
           recursive: bool = False, by_header: bool = True) -> DataFrame:
    """Load every entity of every folder; one failure never stops the rest.

    Returns the report as a DataFrame: one row per entity (or per folder
    whose manifest could not be read)."""
    results: list[EntityResult] = []
    for folder in folders:
        try:
            entities = read_manifest_entities(spark, manifest_path(base, folder))
        except Exception as e:  # noqa: BLE001 - recorded in the report
            results.append(EntityResult(folder, "Manifest Read", "failed", _error_text(e)))
            continue
        for entity, options in entities:
            try:
                results.append(ingest_entity(spark, base, folder, entity, raw_root, fmt, header,
                                             delimiter, decimal_type, options, recursive, by_header))
            except Exception as e:  # noqa: BLE001
                results.append(EntityResult(folder, entity, "failed", _error_text(e)))
    return spark.createDataFrame([tuple(r.__dict__.values()) for r in results], REPORT_SCHEMA)


def _error_text(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"
