"""Test sheets: the sample sheet, file names, and the whole experiment plan."""

import pytest
from pyspark.sql import functions as F

from loomgraph.functions.vocabulary import PROFILES
from loomgraph.operators import matching, sheets
from loomgraph.plans.experiment import build_experiment_graph

JOB, PARAMETERS, MATERIAL = "Metadata --> Test info --> Test job details", "Metadata --> Test info --> Test parameters", "Metadata --> Material history and condition"
ROWS = [
    (JOB, "Date of test start", "2023-02-08 09:06:15"),
    (JOB, "Date of test end", "2023-02-11 15:48:15"),
    (JOB, "Project", "Vh 5205"),
    (JOB, "Test ID", "Vh5205_C-78"),
    (PARAMETERS, "Test standard applied", "Yes"),
    (PARAMETERS, "Test standard", "DIN EN ISO 204:2019-4"),
    (PARAMETERS, "Specified temperature", "980"),
    (PARAMETERS, "Initial stress", "230"),
    (PARAMETERS, "Percentage creep extension", "1.5%"),
    (MATERIAL, "Material Identifier", "CMSX-6"),
    (f"{MATERIAL} --> Microstructure", "Single crystal orientation ", "6.9"),
    (f"{MATERIAL} --> As-manufactured material", "Manufacturing process description as-manufactured material", "Vacuum Induction Refined"),
    (f"{MATERIAL} --> As-tested material", "Manufacturing process description as-tested material", "Single Crystal Investment Cast"),
    ("Metadata --> Test piece", "Test piece technical drawing", 'See file "FormA.pdf"'),
    (f"{MATERIAL} --> Chemical composition", "Chemical composition - measured", 'See file "Vh5205_Complementary_Ch.-Comp.-measured.LIS"'),
    (JOB, "Project", "n/a"),
]
SHEET = "CATEGORIZATION\tENTRY\t\t\t\t\tINFORMATION\t\r\n" + "\r\n".join(f"{a}\t{b}\t\t\t\tMandatory\t{c}\t*" for a, b, c in ROWS)


def test_sample_sheet(spark):
    lines = sheets.sheet_lines(spark.createDataFrame([("k", SHEET), ("bad", "a\tb")], "key string, content string"))
    tests, errors = sheets.parse_tests(lines)
    t = tests.first()
    assert (t.test_id, t.project, str(t.date_test_start), str(t.date_test_end)) == ("Vh5205_C-78", "Vh 5205", "2023-02-08 09:06:15", "2023-02-11 15:48:15")
    assert (t.applicable_standard, t.specified_temperature, t.initial_stress, t.material_id, t.single_crystal_orientation) == ("DIN EN ISO 204:2019-4", 980.0, 230.0, "CMSX-6", 6.9)
    assert t.percentage_creep_extension == pytest.approx(0.015)
    assert (t.manufacturing_as_manufactured, t.manufacturing_as_tested) == ("Vacuum Induction Refined", "Single Crystal Investment Cast")
    assert t.file_references == ["FormA.pdf", "Vh5205_Complementary_Ch.-Comp.-measured.LIS"]
    assert sheets.with_duration(tests).first()["test_duration"] == "P3DT6H42M" and errors.count() == 0


def test_values_that_cannot_be_read(spark):
    text = SHEET.replace("\t980\t", "\thot\t").replace("2023-02-11 15:48:15", "later")
    tests, errors = sheets.parse_tests(sheets.sheet_lines(spark.createDataFrame([("k", text)], "key string, content string")))
    assert tests.count() == 0
    assert sorted(r.error_type for r in errors.collect()) == ["PARSE_ERROR", "VALUE_ERROR", "VALUE_ERROR"]


def test_file_names(spark):
    names = ["Vh5205_C-78-MD-TR.lis", "Vh5205_MD-TR_C-78.LIS", "Vh5205_C-78-Creep.LIS", "Vh5205_C-78-Loading.LIS", "Vh5205_C-79-Creep.LIS", "x.pdf"]
    files = spark.createDataFrame([(n, n, i) for i, n in enumerate(names)], "record_id string, name string, pos int")
    good, bad = sheets.test_collections(sheets.pick_files(sheets.classify_files(files)))
    assert good.first().asDict() == {"test_id": "Vh5205_C-78", "md_tr": names[1], "creep": names[2], "loading": names[3]}
    assert bad.first()["message"] == "missing: md_tr, loading"


def test_experiment_graph(spark):
    names = {
        "md5:a": "Vh5205_MD-TR_C-78.LIS", "md5:b": "Vh5205_C-78-Creep.LIS", "md5:c": "Vh5205_C-78-Loading.LIS", "md5:d": "Vh5205_Complementary_Heat-treatment.LIS",
        "md5:e": "Vh5205_Complementary_Ch.-Comp.-measured.LIS", "md5:f": "FormA.pdf", "md5:g": "SEM-1.tif", "md5:h": "Vh5205_C-79-Creep.LIS",
    }
    own = spark.createDataFrame([(k, "", "file") for k in names] + [("10.5281/zenodo.1", "", "dataset")], "record_id string, pid string, kind string")
    rows = [(k, "name", n, "string") for k, n in names.items()] + [("10.5281/zenodo.1", "creator", "https://orcid.org/0000-0000-0000-0001", "string")]
    attributes = spark.createDataFrame(rows, "record_id string, key string, value string, value_type string")
    out = build_experiment_graph(own, attributes, spark.createDataFrame([("md5:a", SHEET)], "key string, content string"))
    pairs = {}
    for r in out["attributes"].collect():
        pairs.setdefault(r.record_id, set()).add((r.key, r.value))
    test, material = pairs["Vh5205_C-78"], pairs["CMSX-6_md5:e"]
    assert {("testDuration", "P3DT6H42M"), ("usesMaterial", "CMSX-6_md5:e"), ("specifiedTemperature", "980.0"), ("hasData", "md5:b"), ("hasMetadata", "md5:a"), ("references", "md5:f"), ("keyword", "DIN EN ISO 204"), ("description", "Creep test at 980.0°C, 230.0 MPa")} <= test
    assert {("hasChemicalComposition", "md5:e"), ("hasHeatTreatment", "md5:d"), ("semImage", "md5:g"), ("isPartOf", "Vh5205_C-78"), ("description", "As-tested: Single Crystal Investment Cast")} <= material
    assert ("references", "md5:e") not in material
    assert ("isPartOf", "Vh5205_C-78") in pairs["md5:b"]
    assert {(r.error_type, r.test_id) for r in out["errors"].collect()} == {("INCOMPLETE_FILES", "Vh5205_C-79")}


def test_experiments_of_two_datasets_stay_apart(spark):
    """Each dataset's tests get its own creators, images, complements and drawings; a nested part counts, a shared file in both."""
    own, rows, parts = [], [], []
    for i, creators in ((1, "A"), (2, "B")):
        names = {f"{i}m": f"Vh5205_MD-TR_C-{i}8.LIS", f"{i}b": f"Vh5205_C-{i}8-Creep.LIS", f"{i}c": f"Vh5205_C-{i}8-Loading.LIS", f"{i}h": "Vh5205_Complementary_Heat-treatment.LIS", f"{i}e": "Vh5205_Complementary_Ch.-Comp.-measured.LIS", f"{i}f": "FormA.pdf", f"{i}g": f"SEM-{i}.tif"}
        own += [(f"md5:{k}", "", "file") for k in names] + [(f"10.5281/zenodo.{i}", "", "dataset")]
        rows += [(f"md5:{k}", "name", n, "string") for k, n in names.items()] + [(f"10.5281/zenodo.{i}", "creator", creators, "string")]
        parts += [(f"10.5281/zenodo.{i}", "hasPart", f"md5:{k}", "string") for k in names if k[1] != "g"]
        parts += [(f"md5:{i}f", "hasPart", f"md5:{i}g", "string"), (f"md5:{i}g", "hasPart", f"10.5281/zenodo.{i}", "string")]  # a part's part, and a circle
    own.append(("md5:s", "", "file"))
    rows.append(("md5:s", "name", "overview.jpg", "string"))
    rows.append(("md5:s", "dataObjectLocation", "https://p/s", "string"))
    parts += [("10.5281/zenodo.1", "hasPart", "md5:s", "string"), ("10.5281/zenodo.2", "hasPart", "md5:s", "string")]
    records = spark.createDataFrame(own, "record_id string, pid string, kind string")
    attributes = spark.createDataFrame(rows + parts, "record_id string, key string, value string, value_type string")
    out = build_experiment_graph(records, attributes, spark.createDataFrame([("md5:1m", SHEET), ("md5:2m", SHEET.replace("C-78", "C-28"))], "key string, content string"))
    pairs = {}
    for r in out["attributes"].collect():
        pairs.setdefault(r.record_id, set()).add((r.key, r.value))
    tests = {k: {v for key, v in p if key == "creator"} for k, p in pairs.items() if ("profile", PROFILES["CreepExperiment"]) in p}
    assert sorted(map(sorted, tests.values())) == [["A"], ["B"]]
    for i, creator in ((1, "A"), (2, "B")):
        material = pairs[f"CMSX-6_md5:{i}e"]
        assert {("creator", creator), ("hasHeatTreatment", f"md5:{i}h"), ("semImage", f"md5:{i}g"), ("previewImage", "https://p/s"), ("references", f"md5:{i}f")} <= material
        assert not {v for _, v in material} & {f"md5:{3 - i}h", f"md5:{3 - i}g", f"md5:{3 - i}f"}


def test_sheets_and_graph_are_read_once(spark, tmp_path):
    """Errors are told from what was written of the sheets: neither the sheets nor the graph are read again for them."""
    names = {f"md5:{kind}{i}": name for i in (1, 2, 3) for kind, name in (("m", f"Vh5205_MD-TR_C-{i}.LIS"), ("c", f"Vh5205_C-{i}-Creep.LIS"), ("l", f"Vh5205_C-{i}-Loading.LIS"))}
    given = {
        "records": spark.createDataFrame([(k, "", "file") for k in names], "record_id string, pid string, kind string"),
        "attributes": spark.createDataFrame([(k, "name", n, "string") for k, n in names.items()], "record_id string, key string, value string, value_type string"),
        "landed": spark.createDataFrame([("md5:m1", SHEET.replace("980", "hot")), ("md5:m2", "nothing"), ("md5:x", SHEET)], "key string, content string"),
    }
    for name, df in given.items():
        df.write.parquet(str(tmp_path / name))
    errors = build_experiment_graph(*(spark.read.parquet(str(tmp_path / name)) for name in given))["errors"]
    found = sorted((r.error_type, r.test_id or r.filename, r.message) for r in errors.collect())
    unresolved = [("UNRESOLVED_FILE", "FormA.pdf"), ("UNRESOLVED_FILE", "Vh5205_Complementary_Ch.-Comp.-measured.LIS")]
    assert [f[:2] for f in found] == [("FETCH_ERROR", "Vh5205_C-3"), *unresolved, ("VALUE_ERROR", "Vh5205_C-1")] and found[-1][2].endswith(": specified_temperature")
    assert not [f for f in errors.inputFiles() if str(tmp_path) in f]


def test_salted_join_splits_hot_keys(spark):
    left = spark.createDataFrame([("hot", i) for i in range(500)] + [("cold", 1), (None, 2), ("alone", 3)], "k string, i long")
    right = spark.createDataFrame([("hot", "x"), ("hot", "y"), ("cold", "z"), ("other", "w"), (None, "n")], "k string, v string")
    for how in ("inner", "left"):
        found = matching.salted_join(left, right, "k", how=how, rows=40)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, left.join(right, "k", how).select(*found.columns).collect()))


def test_bad_bytes(spark, tmp_path):
    from loomgraph.sources import readers

    (tmp_path / "a.LIS").write_bytes(b"x\xff\ty")
    assert readers.read_sheets(spark, str(tmp_path / "a.LIS")).first()["content"] == "x�\ty"


def test_registry(spark, tmp_path):
    import json

    from loomgraph.operators import quality
    from loomgraph.sources import readers

    for kind, name, body in (
        ("profiles", "P", {"Identifier": "p1", "name": "P", "Schema": {"Properties": [{"Name": "ratio", "Type": "i1", "Properties": {"Cardinality": "1 - n"}}, {"Name": "x", "Type": "i2", "Properties": {"Cardinality": "0 - 1"}}]}}),
        ("info_types", "ratio", {"identifier": "i1", "name": "ratio", "Schema": {"Properties": [{"Name": "ratio", "Type": "b1", "Properties": {"Cardinality": "1"}}]}}),
        ("basic_info_types", "B", {"Identifier": "b1", "name": "B", "Schema": {"Type": "Number", "Properties": [{"Property": "minimum", "Value": 0}, {"Property": "maximum", "Value": 1}]}}),
    ):
        (tmp_path / kind).mkdir()
        (tmp_path / kind / f"{name}.json").write_text(json.dumps(body, indent=1))
    registry = readers.read_type_registry(spark, str(tmp_path))
    assert sorted((r.property, r.min_count, r.max_count) for r in registry["profile_properties"].collect()) == [("ratio", 1, None), ("x", 0, 1)]
    attributes = spark.createDataFrame([("r", "i1", "2", "double"), ("r", "i1", "0.5", "double")], "record_id string, key string, value string, value_type string")
    assert [tuple(r) for r in quality.check_values(attributes, quality.value_rules(registry)).collect()] == [("r", "i1", "2", "range")]


def test_documents(spark, tmp_path):
    from loomgraph.sources import readers

    for name, text in (("a.json", '{"k":\n [1]}'), ("b.json", " "), ("c.json", "{"), ("d.txt", "{}")):
        (tmp_path / name).write_text(text)
    good, bad = readers.read_documents(spark, str(tmp_path))
    assert good.select(F.try_variant_get("doc", "$.k[0]", "int")).first()[0] == 1
    assert sorted(r.message for r in bad.collect()) == ["empty file", "not JSON"]
