"""Raw file layouts. Every column is text; typing happens in the silver step."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of the four published files, in file order.
RAW_COLUMNS = {
    "sub": [
        "adsh", "cik", "name", "sic", "countryba", "stprba", "cityba", "zipba", "bas1",
        "bas2", "baph", "countryma", "stprma", "cityma", "zipma", "mas1", "mas2",
        "countryinc", "stprinc", "ein", "former", "changed", "afs", "wksi", "fye", "form",
        "period", "fy", "fp", "filed", "accepted", "prevrpt", "detail", "instance", "nciks",
        "aciks"],
    "num": [
        "adsh", "tag", "version", "ddate", "qtrs", "uom", "segments", "coreg", "value",
        "footnote"],
    "tag": [
        "tag", "version", "custom", "abstract", "datatype", "iord", "crdr", "tlabel", "doc"],
    "pre": [
        "adsh", "report", "line", "stmt", "inpth", "rfile", "tag", "version", "plabel",
        "negating"],
}
RESCUED = "_rescued_data"
# Columns without which a file says nothing; others may be missing from it.
REQUIRED = {
    "sub": ["adsh", "cik", "form", "period", "accepted"],
    "num": ["adsh", "tag", "version", "ddate", "qtrs", "uom", "value"],
    "tag": ["tag", "version"],
    "pre": ["adsh", "stmt", "tag", "version"],
}


def raw_columns(kind: str) -> list[str]:
    return RAW_COLUMNS[kind]


def raw_schema(kind: str) -> T.StructType:
    """The file's columns plus one that receives lines with too many or too few fields."""
    names = [*raw_columns(kind), RESCUED]
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


CONTROL = T.StructType([
    T.StructField("quarter", T.StringType(), metadata={"comment": "such as 2024q1"}),
    T.StructField("zip_url", T.StringType()),
    T.StructField("status", T.StringType(),
                  metadata={"comment": "PENDING, RUNNING, DONE or FAILED"}),
    T.StructField("bytes_downloaded", T.LongType()),
    T.StructField("files_extracted", T.IntegerType()),
    T.StructField("row_counts", T.MapType(T.StringType(), T.LongType())),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("last_error", T.StringType()),
    T.StructField("discovered_at", T.TimestampNTZType()),
    T.StructField("completed_at", T.TimestampNTZType()),
])

CONCEPT_MAP = T.StructType([
    T.StructField("src_tag", T.StringType(), metadata={"comment": "tag as filed"}),
    T.StructField("canonical_tag", T.StringType(),
                  metadata={"comment": "concept it counts towards"}),
    T.StructField("statement", T.StringType(), metadata={"comment": "BS, IS, CF or EPS"}),
    T.StructField("mapping_method", T.StringType(),
                  metadata={"comment": "SELF, TAXONOMY_MIGRATION or MANUAL"}),
    T.StructField("confidence", T.StringType(), metadata={"comment": "HIGH, MEDIUM or LOW"}),
    T.StructField("note", T.StringType()),
])
