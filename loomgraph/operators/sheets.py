"""Tab-separated test sheets: which file is what, and what the lines say."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.columns import iso_duration, parse_number, parse_orientation, parse_percent, parse_timestamp, standard_name
from loomgraph.operators.repository import first_per

# Kinds of a test's own files, and names of what complements the tests.
TEST_FILES = ("md_tr", "creep", "loading")
COMPLEMENTARY = (
    ("heat_treatment", ("heat-treatment", "heat_treatment")),
    ("chemical_measured", ("ch.-comp.-measured", "chemical")),
    ("chemical_nominal", ("ch.-comp.-nominal",)),
    ("data_acquisition_creep", ("data-acquisition-creep",)),
    ("data_acquisition", ("data-acquisition",)),
    ("primary_processed", ("primary",)),
    ("roughness", ("roughness",)),
    ("rp02", ("rp0.2", "rp02")),
)
#: Texts that say nothing.
BLANK_WORDS = ("not applicable", "n/a", "", "-")
JOB, PARAMETERS, MATERIAL = "Metadata --> Test info --> Test job details", "Metadata --> Test info --> Test parameters", "Metadata --> Material history and condition"
AS_MANUFACTURED, AS_TESTED = "Manufacturing process description as-manufactured material", "Manufacturing process description as-tested material"
FIELDS = (
    "date_test_start", "date_test_end", "project", "test_id", "applicable_standard", "specified_temperature", "initial_stress",
    "percentage_creep_extension", "material_id", "single_crystal_orientation", "manufacturing_as_manufactured", "manufacturing_as_tested",
)
COMMON_FIELDS = (
    ("material_id", "material identifier", None),
    ("applicable_standard", "test standard", "applied"),
    ("form_of_as_manufactured_material", "form of as-manufactured material", None),
    ("geometry_size_as_manufactured", "geometry/size as-manufactured material", None),
    ("geometry_size_as_tested", "geometry/size as-tested material", None),
)


def classify_files(files: DataFrame, *, test_prefix: str = "Vh5205_") -> DataFrame:
    """Sheets among files (record_id, name, pos: of any type that has an order) with test_id, file_type and type_first (the type precedes the id)."""
    own = files.where(F.lower("name").endswith(".lis"))
    number, kind = F.regexp_extract("name", r"(?i)C-([0-9]+)", 1), F.lower(F.regexp_extract("name", "(?i)(MD-TR|Creep|Loading)", 1))
    is_test = (number != "") & (kind != "")
    at = lambda p: F.regexp_instr("name", F.lit(p))
    return own.select(
        "*",
        F.when(is_test, F.concat(F.lit(f"{test_prefix}C-"), number)).alias("test_id"),
        F.when(is_test, F.replace(kind, F.lit("-"), F.lit("_"))).alias("file_type"),
        F.when(is_test, at("(?i)(MD-TR|Creep|Loading)") < at("(?i)C-[0-9]+")).alias("type_first"),
    )


def pick_files(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One file for each test and type (of each collection, if by names its column): the last whose type comes first in
    its name, else the first."""
    own = classified.where("test_id is not null")
    return first_per(own, [*by, "test_id", "file_type"], F.desc("type_first"), F.desc(F.when(F.col("type_first"), F.col("pos"))), F.when(~F.col("type_first"), F.col("pos")))


def test_collections(picked: DataFrame, by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(collections, errors): tests with all three files, as columns; others with the types they lack."""
    wide = picked.groupBy(*by, "test_id").pivot("file_type", list(TEST_FILES)).agg(F.first("record_id"))
    missing = F.array_compact(F.array(*[F.when(F.col(t).isNull(), t) for t in TEST_FILES]))
    judged = wide.withColumn("missing", missing)
    errors = judged.where(F.size("missing") > 0).select("test_id", F.lit(None).cast("string").alias("filename"), F.lit("INCOMPLETE_FILES").alias("error_type"), F.concat(F.lit("missing: "), F.array_join("missing", ", ")).alias("message"))
    return judged.where(F.size("missing") == 0).drop("missing"), errors


def complementary_files(files: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row of record ids (for each collection that has any, if by names its column), a column for each kind ('' where
    there is none): the last file of the first kind that fits."""
    kind = F.lower(F.nullif(F.regexp_extract("name", r"(?i)^Vh[0-9]+_Complementary_(.+)\.lis", 1), F.lit("")))
    chosen = None
    for name, parts in COMPLEMENTARY:
        test = None
        for part in parts:
            test = F.contains(kind, F.lit(part)) if test is None else test | F.contains(kind, F.lit(part))
        chosen = F.when(test, name) if chosen is None else chosen.when(test, name)
    own = files.withColumn("what", chosen).where("what is not null")
    one = own.groupBy(*by).agg(*[F.max_by(F.when(F.col("what") == n, F.col("record_id")), F.when(F.col("what") == n, F.col("pos"))).alias(n) for n, _ in COMPLEMENTARY])
    return one.select(*by, *[F.coalesce(n, F.lit("")).alias(n) for n, _ in COMPLEMENTARY])


def common_file(files: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """record_id of the last file that holds what is common to all tests (of a collection), or null."""
    own = files.where(F.col("name").rlike(r"(?i)^Vh[0-9]+_MD-TR_Common-to-all\.lis"))
    return own.groupBy(*by).agg(F.max_by("record_id", "pos").alias("record_id"))


def sheet_lines(sheets: DataFrame) -> DataFrame:
    """key, line_no, categorization, entry, information of the lines of sheets (key, content) that say something."""
    lines = sheets.select("key", F.posexplode(F.split("content", "\n")).alias("line_no", "line"))
    cols = lines.select("key", (F.col("line_no") + 1).alias("line_no"), F.split("line", "\t").alias("c")).where(F.size("c") >= 7)
    cell = lambda i: F.btrim(F.get("c", F.lit(i)), F.lit(" \r\n"))
    named = cols.select("key", "line_no", cell(0).alias("categorization"), cell(1).alias("entry"), cell(6).alias("information"))
    return named.where(~F.lower("information").isin(*BLANK_WORDS))


def test_field() -> Column:
    """The field that a line of a test sheet sets, by its category and entry; the first rule that fits."""
    c, e = F.col("categorization"), F.col("entry")
    has = lambda col, text: F.contains(col, F.lit(text))
    job = F.when(has(e, "Date of test start"), "date_test_start").when(has(e, "Date of test end"), "date_test_end").when(has(e, "Project"), "project").when(has(e, "Test ID"), "test_id")
    standard = has(e, "Test standard") & ~has(F.lower(e), "applied")
    parameters = F.when(standard, "applicable_standard").when(has(e, "Specified temperature"), "specified_temperature").when(has(e, "Initial stress"), "initial_stress").when(has(e, "Percentage creep extension"), "percentage_creep_extension")
    orientation = has(e, "Single crystal orientation") & ~has(c, "Determination method")
    material = F.when(has(e, "Material Identifier"), "material_id").when(orientation, "single_crystal_orientation")
    material = material.when(has(c, AS_MANUFACTURED) | has(e, AS_MANUFACTURED), "manufacturing_as_manufactured").when(has(c, AS_TESTED) | has(e, AS_TESTED), "manufacturing_as_tested")
    return F.when(has(c, JOB), job).when(has(c, PARAMETERS), parameters).when(has(c, MATERIAL), material)


def parse_tests(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tests, errors): a row for each sheet with both dates, later lines over earlier ones; other sheets, and numbers
    that can't be read, are errors. file_references are the files that lines mention, sorted."""
    return judge_tests(fold_tests(lines))


def fold_tests(lines: DataFrame) -> DataFrame:
    """A row for each sheet: the texts of its fields, the files that it mentions, and what can't be read of it (unread)."""
    value = F.col("information")
    typed = {
        "date_test_start": parse_timestamp(value).cast("string"),
        "date_test_end": parse_timestamp(value).cast("string"),
        "specified_temperature": parse_number(value).cast("string"),
        "initial_stress": parse_number(value).cast("string"),
        "percentage_creep_extension": parse_percent(value).cast("string"),
        "single_crystal_orientation": parse_orientation(value).cast("string"),
    }
    read = None
    for name, column in typed.items():
        read = F.when(F.col("field") == name, column) if read is None else read.when(F.col("field") == name, column)
    fields = lines.withColumn("field", test_field()).withColumn("read", read.otherwise(value))
    mentions = F.regexp_extract_all("information", F.lit('(?i)See file "([^"]+)"'), 1)
    strict = ("specified_temperature", "initial_stress", "percentage_creep_extension", "date_test_start", "date_test_end")
    return fields.groupBy("key").agg(
        *[F.max_by("read", F.when((F.col("field") == n) & F.col("read").isNotNull(), F.col("line_no"))).alias(n) for n in FIELDS],
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(mentions)))).alias("file_references"),  # of one sheet
        F.collect_list(F.when(F.col("field").isin(*strict) & F.col("read").isNull(), F.struct("line_no", "field"))).alias("unread"),  # of one sheet
    )


def judge_tests(folded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tests, errors) of folded sheets. Both read them, so a job writes them first."""
    stamp = lambda n: F.col(n).cast("timestamp_ntz").alias(n)
    number = lambda n: F.col(n).cast("double").alias(n)
    tests = folded.select(
        "key", stamp("date_test_start"), stamp("date_test_end"), "project", F.coalesce("test_id", "key").alias("test_id"), "applicable_standard", number("specified_temperature"),
        number("initial_stress"), number("percentage_creep_extension"), "material_id", number("single_crystal_orientation"), "manufacturing_as_manufactured", "manufacturing_as_tested", "file_references",
    )
    dated = F.col("date_test_start").isNotNull() & F.col("date_test_end").isNotNull()
    error = lambda df, kind, message: df.select(F.col("key").alias("test_id"), F.lit(None).cast("string").alias("filename"), F.lit(kind).alias("error_type"), message.alias("message"))
    undated = error(tests.where(~dated), "PARSE_ERROR", F.lit("missing dates"))
    unread = error(folded.select("key", F.inline("unread")), "VALUE_ERROR", F.concat(F.lit("line "), F.col("line_no").cast("string"), F.lit(": "), "field"))
    return tests.where(dated), undated.unionByName(unread)


def parse_common(lines: DataFrame) -> DataFrame:
    """key and the fields that are common to all tests."""
    entry = F.lower("entry")
    field = None
    for name, text, but in COMMON_FIELDS:
        test = F.contains(entry, F.lit(text))
        test = test if but is None else test & ~F.contains(entry, F.lit(but))
        field = F.when(test, name) if field is None else field.when(test, name)
    named = lines.withColumn("field", field)
    return named.groupBy("key").agg(*[F.max_by("information", F.when(F.col("field") == n, F.col("line_no"))).alias(n) for n, _, _ in COMMON_FIELDS])


def fetch_errors(collections: DataFrame, sheets: DataFrame) -> DataFrame:
    """Tests whose sheet (by md_tr) hasn't landed."""
    gone = collections.join(sheets.select(F.col("key").alias("md_tr")), "md_tr", "left_anti")
    return gone.select("test_id", F.col("md_tr").alias("filename"), F.lit("FETCH_ERROR").alias("error_type"), F.lit("content not found").alias("message"))


def first_tests(tests: DataFrame, order: str = "pos", by: Sequence[str] = ()) -> DataFrame:
    """The first test of each material (of each collection), which speaks for it."""
    return first_per(tests.where("material_id <> ''"), [*by, "material_id"], order)


def with_duration(tests: DataFrame) -> DataFrame:
    return tests.withColumn("test_duration", iso_duration(F.col("date_test_start"), F.col("date_test_end")))


def with_keywords(tests: DataFrame, fallback: Column) -> DataFrame:
    """tests with keywords: material and standard without its edition; else the fallback (an array)."""
    own = F.array_distinct(F.array_compact(F.array(F.nullif(F.col("material_id"), F.lit("")), F.nullif(standard_name(F.col("applicable_standard")), F.lit("")))))
    return tests.withColumn("keywords", F.when(F.size(own) > 0, own).otherwise(fallback))


def images(attributes: DataFrame, *, of_records: bool = False) -> DataFrame:
    """kind and value of the images among file records: checksums of microscope images (sem), addresses of previews; with
    of_records also the record_id of each."""
    wide = attributes.where(F.col("key").isin("name", "mimeType", "dataObjectLocation")).groupBy("record_id").pivot("key", ["name", "mimeType", "dataObjectLocation"]).agg(F.min("value"))
    name, mime = F.lower("name"), F.coalesce("mimeType", F.lit(""))
    sem = (name.endswith(".tif") | F.contains(mime, F.lit("image/tiff"))) & name.rlike("sem|dendrite|microstructure|interdentritic")
    preview = (name.rlike(r"\.jpe?g$") | F.contains(mime, F.lit("image/jpeg"))) & name.rlike("location|optical|overview|test[- ]piece")
    kinds = F.array_compact(F.array(F.when(sem, F.struct(F.lit("sem").alias("kind"), F.col("record_id").alias("value"))), F.when(preview, F.struct(F.lit("preview").alias("kind"), F.col("dataObjectLocation").alias("value")))))
    found = wide.select("record_id", F.explode(kinds).alias("i")).select("record_id", "i.*").where("value is not null")
    return found if of_records else found.drop("record_id").distinct()


def error_report(errors: DataFrame) -> DataFrame:
    """scope, error_type, test_id and n: errors of each type (scope type, no test_id), and of each test (scope test)."""
    each = errors.groupBy("error_type", "test_id").agg(F.count("*").alias("n"))
    every = each.groupBy("error_type").agg(F.sum("n").alias("n"))
    return every.select(F.lit("type").alias("scope"), "error_type", F.lit(None).cast("string").alias("test_id"), "n").union(each.where("test_id is not null").select(F.lit("test"), "error_type", "test_id", "n"))


def successes(tests: DataFrame, errors: DataFrame) -> DataFrame:
    """test_id of the tests without an error that stops them."""
    stopping = errors.where("error_type <> 'VALUE_ERROR'").select("test_id")
    return tests.select("test_id").distinct().join(stopping, "test_id", "left_anti")
