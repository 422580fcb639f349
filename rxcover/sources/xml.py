"""XML record files -> product and classification records.

Files are found at any depth under a root (``recursiveFileLookup``) and kept
by file-name glob (``pathGlobFilter``). They are read block by block
(:mod:`rxcover.sources.xml_blocks`): a large file by many tasks, every file
once, records of all element names together and nested at any depth. Of a
repeated child the first counts, of its text what stands before its first
inner element; namespaces are ignored.

A malformed file fails the read, as an uncaught parse error would. Empty input
raises :class:`NoRecordsError`: no matching file, or files without records.
The parsed records are written to the shared scratch folder, or to ``scratch``
if given, and read from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxcover.session import scratch_path
from rxcover.sources.records import (
    CLASSIFICATION_TAGS,
    PRODUCT_TAGS,
    classification_records,
    product_records,
)
from rxcover.sources.xml_blocks import xml_records

PRODUCT_FILES = "f_vmp2*.xml"
CLASSIFICATION_FILES = "f_bnf*.xml"


class NoRecordsError(RuntimeError):
    """A source matched no file or produced no record."""


def _require_files(spark: SparkSession, path: str, name_glob: str, what: str) -> None:
    # one file name is enough: the list of files stays on the executors
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name_glob)
             .load(path).select("path"))
    if not files.take(1):
        raise NoRecordsError(f"no {what} XML files found")


def _require_rows(df: DataFrame, what: str, check_rows: bool) -> DataFrame:
    if check_rows and not df.select().take(1):
        raise NoRecordsError(f"{what} records are empty")
    return df


def read_products_xml(spark: SparkSession, path: str, name_glob: str = PRODUCT_FILES,
                      row_tag: str = "VMP", check_rows: bool = True, scratch: str | None = None) -> DataFrame:
    """Product records (vpid, vmp_nm, vtmid, vpid_prev) from XML files.
    Every ``row_tag`` element is a record, with ``""`` for absent children."""
    _require_files(spark, path, name_glob, "product")
    raw = xml_records(spark, path, name_glob, list(PRODUCT_TAGS.values()), lambda name, _: name == row_tag,
                      scratch or scratch_path(spark, "xml", unique=True))
    out = product_records(raw.select(*[F.col(t).alias(c) for c, t in PRODUCT_TAGS.items()]))
    return _require_rows(out, "product", check_rows)


def read_classifications_xml(spark: SparkSession, path: str, name_glob: str = CLASSIFICATION_FILES,
                             row_tags=None, check_rows: bool = True, scratch: str | None = None) -> DataFrame:
    """Classification records (vpid, bnf_code, atc_code, ddd, ddd_uom).

    A record is any element whose first ``VPID`` child has text before
    trimming: ``<VPID/>`` is skipped, ``<VPID> </VPID>`` gives the key ``""``.
    ``row_tags`` keeps elements of these names only. The unit is ``DDD_UOMCD``
    if non-empty, else ``DDD_UOM``, translated through the unit code table.
    """
    _require_files(spark, path, name_glob, "classification")
    key = CLASSIFICATION_TAGS["vpid"]
    names = None if row_tags is None else frozenset(row_tags)
    raw = xml_records(spark, path, name_glob, list(CLASSIFICATION_TAGS.values()),
                      lambda name, kids: bool(kids.get(key)) and (names is None or name in names),
                      scratch or scratch_path(spark, "xml", unique=True))
    out = raw.select(*[F.col(t).alias(c) for c, t in CLASSIFICATION_TAGS.items()])
    return classification_records(_require_rows(out, "classification", check_rows))


def write_xml_records(df: DataFrame, path: str, row_tag: str, root_tag: str, tags: dict[str, str],
                      mode: str = "overwrite") -> None:
    """Write records as XML (one child element per column, renamed to its
    tag). Used to produce XML inputs from tables."""
    (df.select(*[F.col(c).alias(t) for c, t in tags.items() if c in df.columns])
     .write.format("xml").option("rowTag", row_tag).option("rootTag", root_tag)
     .mode(mode).save(path))
