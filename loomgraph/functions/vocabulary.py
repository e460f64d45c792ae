"""Fixed vocabularies of record graphs: keys, profiles, relations, resource types and backlink rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Keys of attributes and the identifiers under which they are exported.
INFO_TYPES = {
    "creator": "21.T11969/7c67083a5d218e544063",
    "creatorAffiliation": "21.T11969/ea9f6b3d78c6608fe801",
    "dateCreated": "21.T11969/29f92bd203dd3eaa5a1f",
    "dateModified": "21.T11969/397d831aa3a9d18eb52c",
    "keyword": "21.T11969/793ff5c33c3aeb32907a",
    "name": "21.T11969/bd3e9fb9b606d2198c9e",
    "description": "21.T11969/880724416f5857987e70",
    "mimeType": "21.T11969/3313b863118ed5eb0ded",
    "dataObjectLocation": "21.T11969/479febb2bbe8400da547",
    "spdxLicense": "21.T11969/623654b1072ae7b88202",
    "checksum": "21.T11969/a80ed2ef79e22f1d8af8",
    "version": "21.T11969/be1ae3492b235faad933",
    "nextVersion": "21.T11969/7f1a6afddcfeefbf195b",
    "previousVersion": "21.T11969/7c97f00a2a95826c1a8f",
    "latestVersion": "21.T11969/2b4d6ceda80ddd63f7a9",
    "doi": "21.T11969/48e563f148dc04d8b31c",
    "dataCitePublicationType": "21.T11969/48dbf6a89f9748ae4ead",
    "publisher": "21.T11969/cdd96207a7dfbcc0db93",
    "datePublished": "21.T11969/0c9b86e828976a85d4f2",
    "hasPart": "21.T11969/39c056d0cc63e2d0ff17",
    "hasData": "21.T11969/cc230f978e8add2e2520",
    "isPartOf": "21.T11969/30f4a1f8aacab81faf38",
    "cites": "21.T11969/813e06c1441327b72e68",
    "isCitedBy": "21.T11969/520bb71b795d8573f533",
    "references": "21.T11969/f4c9a69f715c3c60aa2f",
    "isReferencedBy": "21.T11969/e5945ef3ff07f314a146",
    "namedReference": "21.T11969/46b995a19dd6f5d36d0d",
    "landingPageLocation": "21.T11969/8710d753ad10f371189b",
    "previewImage": "21.T11969/925e3f9925a88476ffba",
    "applicableStandard": "21.T11969/dda596702b20205cba36",
    "testID": "21.T11969/1a34a6966f91cc341f58",
    "specifiedTemperature": "21.T11969/ac4a911ffb09772718e3",
    "initialStress": "21.T11969/8bd53487030550ee2e94",
    "testDuration": "21.T11969/7e84faadd49ac88d02b8",
    "percentageCreepExtension": "21.T11969/4be978cac878da94105e",
    "SingleCrystalOrientation": "21.T11969/4597cf0db467d7e365a9",
    "materialID": "21.T11969/716805eef0349802dc9a",
    "semImage": "21.T11969/19a94f596420bb274408",
    "hasChemicalComposition": "21.T11969/e32cfb93d7fc61ce3ca5",
    "hasHeatTreatment": "21.T11969/766ae14d72b49cfb5273",
    "hasMetadata": "21.T11969/d0773859091aeb451528",
    "usesMaterial": "21.T11969/2dced98076fda9cbf0ef",
}

# Profiles, and the keys under which records declare them (the second is the registry's own).
PROFILE_KEY = "21.T11148/076759916209e5d62bd5"
REGISTRY_PROFILE_KEY = "21.T11969/01e3f7ccb897f9c724dd"
PROFILES = {
    "Base": "21.T11969/077fe9c54ed5ed26fa54",
    "Versionable": "21.T11969/6c663a0695a411803d70",
    "DataResource": "21.T11969/0738c2ef35faef0fb552",
    "Publication": "21.T11969/e00441c49bf6cb62a4a5",
    "CreepExperiment": "21.T11969/222fb86c0b3bece35729",
    "Material": "21.T11969/d8169782b57c7a9e9f01",
}

# Relations between publications and data (DataCite), as pairs of opposites.
RELATION_PAIRS = (
    ("isCitedBy", "cites"),
    ("isSupplementTo", "isSupplementedBy"),
    ("isContinuedBy", "continues"),
    ("isDescribedBy", "describes"),
    ("hasMetadata", "isMetadataFor"),
    ("isNewVersionOf", "isPreviousVersionOf"),
    ("isPartOf", "hasPart"),
    ("isReferencedBy", "references"),
    ("isDocumentedBy", "documents"),
    ("isCompiledBy", "compiles"),
    ("isVariantFormOf", "isOriginalFormOf"),
    ("isIdenticalTo", "isIdenticalTo"),
    ("isReviewedBy", "reviews"),
    ("isDerivedFrom", "isSourceOf"),
    ("requires", "isRequiredBy"),
    ("isObsoletedBy", "obsoletes"),
)
#: A relation without an opposite.
ONE_WAY_RELATIONS = ("isAlternateIdentifier",)
INVERSE_RELATIONS = {a: b for a, b in RELATION_PAIRS} | {b: a for a, b in RELATION_PAIRS}
RELATIONS = (*INVERSE_RELATIONS, *ONE_WAY_RELATIONS)

# Resource types of repositories, and the general types they stand for.
RESOURCE_TYPES = {
    "publication-article": "JournalArticle",
    "publication-preprint": "Preprint",
    "publication-review": "PeerReview",
    "publication-editorial": "JournalArticle",
    "publication-journal": "Journal",
    "publication-book": "Book",
    "publication-book-chapter": "BookChapter",
    "publication-conferencepaper": "ConferencePaper",
    "publication-conferenceposter": "Poster",
    "presentation-poster": "Poster",
    "publication-thesis": "Dissertation",
    "mastersthesis": "Dissertation",
    "bachelorthesis": "Dissertation",
    "publication-report": "Report",
    "report-workingpaper": "Report",
    "report-deliverable": "Report",
    "report-other": "Report",
    "dataset": "Dataset",
    "software": "Software",
    "code": "Software",
    "presentation": "Presentation",
    "lecture": "Presentation",
    "lesson": "Presentation",
    "teachingmaterial": "Presentation",
    "image-figure": "Image",
    "image-photo": "Image",
    "image-plot": "Image",
    "image-diagram": "Image",
    "image-drawing": "Image",
    "image-other": "Image",
    "figure": "Image",
    "photo": "Image",
    "plot": "Image",
    "diagram": "Image",
    "drawing": "Image",
    "video": "Audiovisual",
    "audio": "Sound",
    "recording": "Sound",
    "outputmanagementplan": "OutputManagementPlan",
    "plan": "OutputManagementPlan",
    "instrument": "Instrument",
    "equipment": "Instrument",
    "physicalobject": "PhysicalObject",
    "sample": "PhysicalObject",
    "event": "Event",
    "workshop": "Event",
    "project": "Project",
    "collection": "Collection",
    "computationalnotebook": "ComputationalNotebook",
    "notebook": "ComputationalNotebook",
    "workflow": "Workflow",
    "model": "Model",
    "journal": "Journal",
    "conferenceproceeding": "ConferenceProceeding",
    "datapaper": "DataPaper",
    "peerreview": "PeerReview",
    "standard": "Standard",
    "protocol": "Standard",
    "service": "Service",
    "interactiveresource": "InteractiveResource",
    "award": "Award",
    "prize": "Award",
    "studyregistration": "StudyRegistration",
    "text": "Text",
    "manuscript": "Text",
    "annotation": "Text",
    "other": "Other",
}

# The general resource types.
GENERAL_TYPES = (
    "Audiovisual",
    "Award",
    "Book",
    "BookChapter",
    "Collection",
    "ComputationalNotebook",
    "ConferencePaper",
    "ConferenceProceeding",
    "DataPaper",
    "Dataset",
    "Dissertation",
    "Event",
    "Image",
    "InteractiveResource",
    "Instrument",
    "Journal",
    "JournalArticle",
    "Model",
    "OutputManagementPlan",
    "PeerReview",
    "PhysicalObject",
    "Poster",
    "Preprint",
    "Presentation",
    "Project",
    "Report",
    "Service",
    "Software",
    "Sound",
    "Standard",
    "StudyRegistration",
    "Text",
    "Workflow",
    "Other",
)

# A forward key implies the backward key on the record it points at.
BACKLINK_RULES = (
    ("hasData", "isPartOf"),
    ("hasPart", "isPartOf"),
    ("nextVersion", "previousVersion"),
    ("previousVersion", "nextVersion"),
    ("cites", "isCitedBy"),
    ("references", "isReferencedBy"),
    ("usesMaterial", "isPartOf"),
    ("hasChemicalComposition", "isReferencedBy"),
    ("hasHeatTreatment", "isReferencedBy"),
)

#: Kinds of edges by key.
EDGE_KINDS = {
    "nextVersion": "version",
    "previousVersion": "version",
    "latestVersion": "version",
    "hasData": "file",
    "hasPart": "file",
    "isPartOf": "file",
    "hasMetadata": "file",
    "cites": "citation",
    "isCitedBy": "citation",
    "references": "citation",
    "isReferencedBy": "citation",
    "namedReference": "citation",
}


def info_types(spark: SparkSession) -> DataFrame:
    """(name, pid) of every key."""
    return pairs_table(spark, INFO_TYPES, "name", "pid")


def pairs_table(spark: SparkSession, pairs: object, first: str, second: str) -> DataFrame:
    """A small table of pairs, marked for broadcast: Spark doesn't know its size, and would deal what it meets by a few hot keys."""
    rows = list(pairs.items()) if isinstance(pairs, dict) else list(pairs)
    return F.broadcast(spark.createDataFrame(rows, f"{first} string, {second} string"))
