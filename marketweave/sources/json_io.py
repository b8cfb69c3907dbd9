"""JSON sources: record-array files, root-shape normalisation, corrupt-record handling.

Files are read by Spark's JSON source with an explicit schema (no inference pass) and every
field as text first, so a value of the wrong type costs that value alone; a file that does not
parse is counted and can be kept as a ``_corrupt`` row for a quarantine sink.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_COL = "_corrupt"
WHOLE_FILE = "\0 no such line end: 8c1f5a0e-2f0b-4c57-9d7e-5b1b6d1c7a43 \0"


def as_text(st: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in st.fields])


def typed(f: T.StructField) -> Column:
    """A field read as JSON text in its declared type; a value that does not fit is null."""
    c = F.col(f.name)
    if isinstance(f.dataType, T.StringType):
        return c
    if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.from_json(c, f.dataType).alias(f.name)
    return c.try_cast(f.dataType).alias(f.name)


def _read_arrays(spark: SparkSession, path: str, st: T.StructType, keep_corrupt: bool) -> DataFrame:
    """Every record with its fields as text, so that only a file that does not parse is
    malformed; ``keep_corrupt`` adds such files as rows with their raw text.

    A file is one line whose end never comes. Read as ``multiLine``, the source opens and reads the
    file anew for every number that is taken as text (some 11 kB a record); a line it has at hand.
    Files are UTF-8 (in UTF-16 and UTF-32, numbers come back null) and hold less than 2 GB; a file
    that is larger than a split is read on from each of its splits, so ``scan_json_splits`` is for
    such files."""
    st = as_text(st)
    r = spark.read.option("lineSep", WHOLE_FILE)
    if keep_corrupt:
        st = st.add(CORRUPT_COL, T.StringType())
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COL)
    else:
        r = r.option("mode", "DROPMALFORMED")
    try:
        return r.schema(st).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], st)
        raise


def scan_json_records(spark: SparkSession, path: str, schema: T.StructType | str,
                      keep_corrupt: bool = False) -> DataFrame:
    """Read JSON-array files (one array of flat records per file). A value of the wrong type
    makes that field null and loses nothing else; a missing path gives an empty result with
    the schema. A file that does not parse gives no rows here: ``corrupt_files`` counts them,
    and ``keep_corrupt=True`` keeps each as a row with its raw text in ``_corrupt``."""
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    raw = _read_arrays(spark, path, st, keep_corrupt)
    named = {f.name for f in st.fields}
    cols = [typed(f) for f in st.fields]
    cols += [F.col(c) for c in raw.columns if c not in named and c != CORRUPT_COL]  # of the folders
    if keep_corrupt:
        return raw.select(*cols, CORRUPT_COL)
    return raw.select(*cols)


def corrupt_files(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """``(n_files, n_values)``: files under ``path`` that do not parse (the ones to quarantine),
    and present values of the schema's first field in the others."""
    rows = scan_json_records(spark, path, schema, keep_corrupt=True)
    return rows.agg(F.count(CORRUPT_COL).alias("n_files"), F.count(rows.columns[0]).alias("n_values"))


def write_json_arrays(df: DataFrame, path: str, group: str, record: Column,
                      max_bytes: int = 32 << 20) -> None:
    """Write the records as JSON-array files (the collectors' landing format) under
    ``group=<value>/_part=<b>/``, one array per file of about ``max_bytes`` of text. Records
    are dealt to the files of their group by a hash of the record and, where it repeats, of its
    number among its equals, so neither a hot group nor many equal records gather in one
    array, and a task that is run again deals alike."""
    sizes = df.select(group, F.octet_length(F.to_json(record)).alias("_b")).groupBy(group).agg(
        F.ceil(F.sum("_b") / F.lit(max_bytes)).cast("int").alias("_nb"))
    each = df.select(group, F.to_json(record).alias("_r")).groupBy(group, "_r").agg(
        F.count(F.lit(1)).alias("_n")).withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    j = each.join(sizes, group).withColumn(
        "_part", F.pmod(F.xxhash64("_r", "_k"), F.greatest("_nb", F.lit(1))).cast("int"))
    arrays = (j.groupBy(group, "_part")
                .agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("_r")), F.lit("]"))
                     .alias("value")))
    # each (group, part) folder is written by exactly one task → one array per file
    (arrays.repartition(group, "_part")
           .write.mode("overwrite").partitionBy(group, "_part").text(path))


def malformed_roots(df: DataFrame, text: str) -> DataFrame:
    """Rows whose ``text`` opens an array or an object but does not parse: the ones that
    ``normalise_root`` gives no records for (for a quarantine sink)."""
    t = F.ltrim(F.col(text))
    broken = ((t.startswith("[") & F.from_json(F.col(text), "array<string>").isNull())
              | (t.startswith("{") & F.from_json(F.col(text), "map<string,string>").isNull()))
    return df.where(broken)


def normalise_root(text: str | Column) -> Column:
    """JSON root → array of record texts: an array root gives its elements, an object
    root gives its values (the reference turns a dict into its values), any other
    scalar gives itself; null/empty text gives an empty array."""
    c = F.col(text) if isinstance(text, str) else text
    t = F.ltrim(c)
    as_array = F.from_json(c, "array<string>")
    as_object = F.map_values(F.from_json(c, "map<string,string>"))
    return (F.when(c.isNull() | (t == ""), F.array().cast("array<string>"))
             .when(t.startswith("["), F.coalesce(as_array, F.array().cast("array<string>")))
             .when(t.startswith("{"), F.coalesce(as_object, F.array().cast("array<string>")))
             .otherwise(F.array(c)))
