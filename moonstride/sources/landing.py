"""Landing files: JSON snapshots with a time stamp in their name."""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moonstride.session import stage
from moonstride.sources.arrays import array_elements

_LOG = logging.getLogger(__name__)

# Stamp layouts of the landing file names, as (regex, Spark pattern).
SECOND_STAMP = (r"\d{8}_\d{6}", "yyyyMMdd_HHmmss")
DAY_STAMP = (r"\d{4}-\d{2}-\d{2}", "yyyy-MM-dd")

# where an element ends in an array indented by two blanks, and nowhere else in such a file
END_OF_ELEMENT = "\n  },"

FILE, WRITTEN = "_landing_file", "_landing_time"

# a line longer than this makes its file an array, whose elements are told apart without reading lines
LONGEST_LINE = 4 << 20
_PACKED = r"\.(gz|gzip|bz2|zst|lz4|snappy|deflate|xz)$"
FORMS = ("lines", "indented", "array", "whole")
_CHUNK_BYTES = "spark.sql.files.maxPartitionBytes"
_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@dataclass(frozen=True)
class LandingFile:
    """``form``: ``lines`` (a record or an array per line), ``indented`` (an array indented by two
    blanks), ``array`` (anything else, cut over tasks) or ``whole`` (anything else that a task reads alone:
    compressed, or no larger than what Spark deals to a task). ``sound``: every part of it is JSON and its
    end is there."""

    path: str
    form: str
    sound: bool


def _located(texts: DataFrame) -> DataFrame:
    return texts.select(
        "value",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_modification_time").alias(WRITTEN),
    )


def _read_text(spark: SparkSession, paths: list[str], wholetext: bool = False, **options) -> DataFrame:
    """Texts of files. Spark lists each path given in a task of its own; many are listed together, by a few tasks per core."""
    before = spark.conf.get(_LISTING_TASKS)
    tasks = min(int(before), max(32, 4 * spark.sparkContext.defaultParallelism))
    spark.conf.set(_LISTING_TASKS, str(tasks))
    try:
        return spark.read.options(**options).text(paths, wholetext=wholetext)
    finally:
        spark.conf.set(_LISTING_TASKS, before)


def _chunk_bytes(spark: SparkSession) -> int:
    """Size of the byte ranges that Spark deals to tasks."""
    number, unit = re.match(r"\s*(\d+)\s*([kmgt]?)", spark.conf.get(_CHUNK_BYTES).lower()).groups()
    return int(number) << 10 * " kmgt".index(unit or " ")


def _forms(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The form of every file that is not blank, from counts of its lines.

    Lines beyond ``LONGEST_LINE`` are passed over, which shows in the bytes that are missing.
    """
    # every line of every file comes by here, so plain searches stand before or instead of patterns
    line = F.rtrim(F.when(F.contains("value", F.lit("\r")), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value")))
    bare = F.btrim("value", F.lit(" \t\r"))
    whole = (bare.startswith("{") & bare.endswith("}")) | (bare.startswith("[") & bare.endswith("]"))
    count = lambda condition: F.count_if(condition)
    limit = {"lineSep": "\n", "mapreduce.input.linerecordreader.line.maxlength": LONGEST_LINE}
    facts = (
        _read_text(spark, paths, **limit)
        .select("value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_size").alias("size"))
        .groupBy(FILE)
        .agg(
            F.max("size").alias("size"),
            F.sum(F.octet_length("value") + 1).alias("bytes"),
            count(bare != "").alias("lines"),
            count(whole).alias("whole"),
            count(line == "[").alias("opens"),
            count(line == "]").alias("closes"),
            count(line == "  {").alias("begins"),
            count(line == "  },").alias("goes_on"),
            count(line == "  }").alias("ends"),
            count((line != "") & ~line.startswith("   ") & ~line.isin("[", "]", "  {", "  },", "  }")).alias("other"),
        )
    )
    packed = F.col(FILE).rlike(_PACKED)
    seen = packed | (F.col("bytes") >= F.col("size") - 4)  # a byte order mark and the last line's end may be missing
    indented = F.expr("opens = 1 AND closes = 1 AND ends = 1 AND begins = goes_on + 1 AND other = 0") & ~packed
    form = (
        F.when(seen & (F.col("lines") == 0), None)
        .when(seen & (F.col("lines") == F.col("whole")), "lines")
        .when(seen & indented, "indented")
        .otherwise(F.when(packed | (F.col("size") <= _chunk_bytes(spark)), "whole").otherwise("array"))
    )
    return facts.select(FILE, form.alias("form"))


def _arrays(spark: SparkSession, paths: list[str], form: str) -> DataFrame:
    """Each part of the files as the text of a JSON array (``value``), with its file; empty text is no part of one.

    Large files are split over tasks, unless they are compressed. A piece of an indented array lacks the brackets that
    its neighbours hold, and the brace where it was cut.
    """
    if form == "lines":
        bare = F.btrim("value", F.lit(" \t\r"))
        read = _located(_read_text(spark, paths)).where(bare != "")
        return read.withColumn("value", F.when(bare.startswith("["), bare).otherwise(F.concat(F.lit("["), bare, F.lit("]"))))
    if form == "indented":
        read = _located(_read_text(spark, paths, lineSep=END_OF_ELEMENT)).where(F.col("value").rlike(r"\S"))
        piece = F.col("value")
        opens, closes = piece.rlike(r"^\s*\["), piece.rlike(r"\n\]\s*$")
        return read.withColumn("value", F.concat(F.when(opens, "").otherwise("["), piece, F.when(closes, "").otherwise("}]")))
    if form == "array":
        return array_elements(spark, paths).select("value", F.col("_file").alias(FILE), F.col("_written").alias(WRITTEN))
    return _located(_read_text(spark, paths, wholetext=True))


def _is_array(text: Column) -> Column:
    """Whether the text is one JSON array and nothing else."""
    bare = F.btrim(text, F.lit(" \t\r\n"))
    wrapped = F.concat(F.lit('{"v":'), text, F.lit("}"))
    return bare.startswith("[") & bare.endswith("]") & F.get_json_object(wrapped, "$").isNotNull()


def _found(spark: SparkSession, path: str | list[str]) -> tuple[list[str], dict[str, str]]:
    """All files, and the form of those that are not blank. What reaches the driver is a row per file, like Spark's own listing."""
    names = list(spark.read.format("binaryFile").load(path).inputFiles())  # empty files too
    return names, {r[FILE]: r["form"] for r in (_forms(spark, names).collect() if names else []) if r["form"]}


def _judged(names: list[str], forms: dict[str, str], broken: set[str]) -> list[LandingFile]:
    known = {_plain(p): p for p in forms}
    return [
        LandingFile(known.get(_plain(n), n), forms.get(known.get(_plain(n)), "array"), _plain(n) in known and known[_plain(n)] not in broken)
        for n in sorted(names)
    ]


def _parts(spark: SparkSession, forms: dict[str, str]) -> list[DataFrame]:
    chosen = {form: [p for p, f in forms.items() if f == form] for form in FORMS}
    return [_arrays(spark, paths, form).select("value", FILE, WRITTEN) for form, paths in chosen.items() if paths]


def _broken(parts: DataFrame, sound: Column) -> set[str]:
    return {r[FILE] for r in parts.where(~sound).select(FILE).distinct().collect()}


def landing_files(spark: SparkSession, path: str | list[str]) -> list[LandingFile]:
    """Form and soundness of every file; an empty file is not sound."""
    names, forms = _found(spark, path)
    parts = _parts(spark, forms)
    sound = _is_array(F.col("value")) & F.from_json("value", "array<struct<any: string>>").isNotNull()
    return _judged(names, forms, _broken(reduce(DataFrame.union, parts), sound) if parts else set())


def _plain(path: str) -> str:
    return re.sub(r"^file:/+", "/", path)


@dataclass(frozen=True)
class Landed:
    """``records`` of the sound ones of ``files``, from the table ``parsed`` (None without files) in the shared folder."""

    records: DataFrame
    files: list[LandingFile]
    parsed: DataFrame | None


def land(spark: SparkSession, path: str | list[str], schema: str, origin: bool = False) -> Landed:
    """Records of landing files, parsed once; with ``origin`` also the file and when it was written.

    A first reading finds the forms from counts of lines. A second one parses and checks every part and
    writes what it found, so whoever reads the records several times does not parse them again; a file
    with a part that is no JSON is then left out as a whole.
    """
    layout = T.StructType.fromDDL(schema)
    extra = [FILE, WRITTEN] if origin else []
    names, forms = _found(spark, path)
    parts = _parts(spark, forms)
    if not parts:
        more = [T.StructField(FILE, T.StringType()), T.StructField(WRITTEN, T.TimestampType())] if origin else []
        return Landed(spark.createDataFrame([], T.StructType([*layout.fields, *more])), _judged(names, forms, set()), None)
    parsed_value = F.from_json("value", T.ArrayType(layout))  # null if something else than records is there
    sound = _is_array(F.col("value")) & parsed_value.isNotNull()
    records = F.filter(parsed_value, lambda r: r.isNotNull())
    checked = reduce(DataFrame.union, parts).select(FILE, WRITTEN, sound.alias("sound"), records.alias("records"))
    parsed = stage(checked, "landed")
    broken = _broken(parsed, F.col("sound"))
    kept = parsed
    if broken:
        lost = spark.createDataFrame([(p,) for p in sorted(broken)], "_lost string")
        kept = parsed.join(lost, F.col(FILE) == F.col("_lost"), "left_anti")
    return Landed(kept.select(F.inline("records"), *extra), _judged(names, forms, broken), parsed)


def read_landing(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Records of JSON landing files, laid out in any way.

    A file counts as a whole or not at all: one that is cut off, damaged anywhere or empty, or that holds
    something else than records and nulls, yields no record, and ``unreadable_files`` names it. A field of a wrong type is null. Files are split over tasks
    whatever their layout (``sources.arrays``), but for compressed ones, which a task reads from the start.
    """
    return land(spark, path, schema).records


def unreadable_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file_path`` of the files that ``read_landing`` leaves out."""
    rows = [(f.path,) for f in landing_files(spark, path) if not f.sound]
    return spark.createDataFrame(rows, "file_path string")


def warn_unreadable(files: list[LandingFile]) -> None:
    for file in files:
        if not file.sound:
            _LOG.warning("not loaded, because it is not whole JSON: %s", file.path)


def newest_snapshot(
    spark: SparkSession, folder: str, prefix: str, stamp: tuple[str, str] = SECOND_STAMP
) -> str | None:
    """Path of the newest ``prefix_<stamp>.json`` below ``folder``; None if there is none.

    A snapshot is a file or a folder of part files. Names whose stamp is no real time are
    skipped. Only names are read, and older snapshots are left alone.
    """
    pattern, layout = stamp
    name = rf"^(.*/{re.escape(prefix)}_({pattern})\.json)(?:/[^/]*)?$"
    found = []
    # direct children only: files, and folders of part files
    for children in (f"{folder}/{prefix}_*.json", f"{folder}/{prefix}_*.json/*"):
        try:
            found.append(spark.read.format("binaryFile").load(children).select("path"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if not found:
        return None
    stamped = reduce(DataFrame.union, found).select(
        F.regexp_extract("path", name, 1).alias("snapshot"),
        F.try_to_timestamp(F.nullif(F.regexp_extract("path", name, 2), F.lit("")), F.lit(layout)).alias("taken_at"),
    )
    return stamped.where(F.col("taken_at").isNotNull()).agg(F.max_by("snapshot", "taken_at").alias("s")).first()["s"]


def read_newest(
    spark: SparkSession, folder: str, prefix: str, schema: str, stamp: tuple[str, str] = SECOND_STAMP
) -> DataFrame:
    """Records of the newest snapshot; an empty frame if there is none."""
    path = newest_snapshot(spark, folder, prefix, stamp)
    if path is None:
        return spark.createDataFrame([], T.StructType.fromDDL(schema))
    return read_landing(spark, path, schema)
