"""Schemas of the tables that operators exchange."""

from __future__ import annotations

#: One record per row; attributes hold its (key, value) pairs, a set for each record.
RECORDS = "record_id string, pid string, kind string"
ATTRIBUTES = "record_id string, key string, value string, value_type string"

CREATOR = "struct<name: string, affiliation: string, orcid: string>"
LANDED_RECORD = (
    "id bigint, conceptdoi string, conceptrecid string, "
    "metadata struct<doi: string, title: string, description: string, version: string, publication_date: string, "
    "license: struct<id: string, title: string, url: string>, keywords: array<string>, "
    f"creators: array<{CREATOR}>, "
    "related_identifiers: array<struct<identifier: string, relation: string, resource_type: string, scheme: string>>, "
    "grants: array<struct<code: string, title: string, funder: struct<name: string>, internal_id: string>>, "
    "communities: array<struct<id: string, slug: string, name: string>>>, "
    "files array<struct<key: string, size: bigint, checksum: string, mimetype: string, links: struct<self: string>>>"
)
IDENTIFIER = "struct<scheme: string, identifier: string>"
EXPORT = (
    "id bigint, metadata struct<creators: array<struct<"
    f"person_or_org: struct<name: string, identifiers: array<{IDENTIFIER}>>, "
    f"affiliations: array<struct<name: string, identifiers: array<{IDENTIFIER}>>>>>>"
)
ORGANIZATION = "struct<name: string, disambiguated_organization: struct<disambiguated_organization_identifier: string>>"
SUMMARY = f"array<struct<organization: {ORGANIZATION}, start_date: struct<value: string>, end_date: struct<value: string>>>"
AFFILIATIONS = f"orcid string, `employment-summary` {SUMMARY}, `education-summary` {SUMMARY}"

DATASET_INPUT = (
    "doi string, title string, description string, publication_date date, version_label string, "
    "creators array<struct<orcid: string, ror_id: string>>, keywords array<string>, previous_version_doi string, "
    "next_version_doi string, latest_version_doi string, files array<string>, landing_page_url string, preview_images array<string>"
)
FILE_INPUT = (
    "checksum string, filename string, mimetype string, download_url string, license_url string, "
    "previous_version_checksum string, next_version_checksum string, dataset_versions array<string>, landing_page_url string"
)
PUBLICATION_INPUT = (
    "identifier string, resource_type string, publisher string, publication_date string, title string, description string, "
    "creator_orcids array<string>, referenced_by_datasets array<string>, landing_page_url string"
)
EXPERIMENT_INPUT = (
    "test_id string, applicable_standard string, specified_temperature double, initial_stress double, test_duration string, "
    "single_crystal_orientation double, date_of_test_start string, date_of_test_end string, project string, "
    "has_data array<string>, has_metadata array<string>, uses_material string, percentage_creep_extension double, "
    "creators array<string>, creator_affiliations array<string>, keywords array<string>, referenced_files array<string>"
)
MATERIAL_INPUT = (
    "material_id string, pid_composition string, has_chemical_composition string, has_heat_treatment string, "
    "descriptions array<string>, preview_images array<string>, sem_images array<string>, creators array<string>, "
    "creator_affiliations array<string>, keywords array<string>, referenced_files array<string>"
)
ERRORS = "test_id string, filename string, error_type string, message string"
