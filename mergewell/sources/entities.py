"""Tables of any shape read into the standard entity schema: ten string columns without nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.normalize import stripped

#: Names that a column may have in a source, the preferred one first.
SYNONYMS = {
    "id": ["id", "source1_id", "source2_id", "source3_id", "record_id", "business_id", "s1_id", "s2_id", "s3_id"],
    "name": ["name", "business_name", "company_name", "title", "legal_name", "store_name"],
    "address": ["address", "street_address", "street", "addr", "location", "address_line_1"],
    "city": ["city", "town", "locality", "municipality"],
    "state": ["state", "province", "region", "state_code"],
    "zip": ["zip", "postal_code", "zipcode", "postcode", "pincode"],
    "country": ["country", "country_code", "cntry", "nation", "iso_country"],
    "phone": ["phone", "phone_number", "telephone", "tel", "contact"],
    "category": ["category", "categories", "business_category", "type", "industry"],
}
ENTITY = [*SYNONYMS, "source_tag"]
#: Cells that mean nothing, in columns other than id.
NULL_TOKENS = ["nan", "None", "NULL", "null"]
_ROW = "_mergewell_row"


def resolve(columns: list[str]) -> dict[str, str | None]:
    """The source's column for each standard one. Header names fold to lower case and underscores; of those that fold to
    the same the last counts. Without an id column, the first column is the id."""
    folded = {c.lower().strip().replace(" ", "_"): c for c in columns}
    found = {k: next((folded[s] for s in names if s in folded), None) for k, names in SYNONYMS.items()}
    if found["id"] is None and columns:
        found["id"] = columns[0]
    return found


def standardize(df: DataFrame, tag: str | Column) -> DataFrame:
    """The ten standard columns; those that the source lacks are empty, others of its columns are left out. tag: the source's,
    or a column that has each row's."""
    found = resolve(df.columns)
    out = []
    for k, c in found.items():
        value = stripped(df[f"`{c}`"]) if c is not None else F.lit("")
        out.append((value if k == "id" else F.when(value.isin(NULL_TOKENS), F.lit("")).otherwise(value)).alias(k))
    return df.select(*out, (F.lit(tag) if isinstance(tag, str) else tag).alias("source_tag"))


def _header(spark: SparkSession, path: str, encoding: str, sep: str) -> list[str]:
    first = spark.read.option("encoding", encoding).option("sep", sep).option("header", True).option("inferSchema", False).csv(path)
    return first.columns


def has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a quoted cell may go on in the next line: some line has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return bool(spark.read.text(path).where(quotes % 2 == 1).limit(1).count())


def is_utf8(spark: SparkSession, path: str) -> bool:
    """Whether all lines are valid UTF-8. Spark's reader would put replacement signs instead of failing."""
    return not spark.read.text(path).where(~F.is_valid_utf8("value")).limit(1).count()


def read_delimited(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A delimited file with a header, all columns strings without nulls, cells stripped.

    Rows with too many fields are dropped, rows with too few are padded with "". Quoted cells may have line breaks; only a
    file that seems to have some is read as a whole by one task. A file that isn't UTF-8 is read as Latin-1 and without
    quotes. A missing file raises an AnalysisException.
    """
    utf8 = is_utf8(spark, path)
    encoding = "UTF-8" if utf8 else "ISO-8859-1"
    columns = _header(spark, path, encoding, sep)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _ROW]])
    reader = spark.read.schema(schema).option("sep", sep).option("header", True).option("encoding", encoding).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", _ROW).option("escape", '"').option("enforceSchema", True)
    rows = reader.option("quote", '"' if utf8 else "").option("multiLine", utf8 and has_line_breaks(spark, path)).csv(path)
    bare = F.regexp_replace(F.col(_ROW), '"[^"]*"', "") if utf8 else F.col(_ROW)
    fields = F.size(F.split(bare, sep.replace("|", r"\|"), -1))
    kept = rows.where(F.col(_ROW).isNull() | (fields <= len(columns)))
    return kept.select(*[stripped(F.col(f"`{c}`")).alias(c) for c in columns])


def read_source(spark: SparkSession, path: str, tag: str) -> DataFrame:
    return standardize(read_delimited(spark, path), tag)


def union_targets(second: DataFrame, third: DataFrame) -> DataFrame:
    return second.unionByName(third)


def last_of_each(entities: DataFrame, position: str, id_col: str = "id") -> DataFrame:
    """One row for each id: of repeated ids the one with the highest position."""
    best = entities.groupBy(id_col).agg(F.max_by(F.struct(*entities.columns), position).alias("row"))
    return best.select("row.*")


def values_source(spark: SparkSession, rows: list[dict[str, str]], tag: str) -> DataFrame:
    """Standard entities from literals; missing keys are empty."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ENTITY])
    return spark.createDataFrame([tuple(r.get(c, tag if c == "source_tag" else "") for c in ENTITY) for r in rows], schema)


def query_record(spark: SparkSession, name: str) -> DataFrame:
    return values_source(spark, [{"id": "query", "name": name}], "query")


def read_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """All sources that exist under folder, with the tags that lookups show, in load order (load_pos). A file without a
    column `name` is left out."""
    frames = []
    for pos, (split, k) in enumerate((s, k) for k in (1, 2, 3) for s in ("train", "test")):
        path = f"{folder}/{split}_source{k}.tsv"
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            continue
        df = read_delimited(spark, path)
        if "name" in df.columns:
            frames.append(standardize(df, f"source{k}").withColumn("load_pos", F.lit(pos)))
    if not frames:
        return values_source(spark, [], "").withColumn("load_pos", F.lit(0))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out

