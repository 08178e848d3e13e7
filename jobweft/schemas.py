"""Fixed schemas of the silver tables and the value domains of their columns."""

from __future__ import annotations

# Domains of enumerated columns.
POSTING_STATUSES = ["active", "inactive", "unknown"]
RUN_STATUSES = ["pending", "processing", "processed", "partial", "failed"]
HOURS_PERIODS = ["day", "week", "month", "year"]
SALARY_PERIODS = ["hour", "day", "week", "month", "year", "project"]
MATCH_METHODS = ["new_canonical_job", "algorithmic_match", "llm_match", "manual_match"]

EMPLOYMENT_OPTION = (
    "struct<employment_relation_name:string,workload_name:string,"
    "hours_min:decimal(7,2),hours_max:decimal(7,2),hours_period:string>"
)
COMPENSATION = (
    "struct<salary_min:decimal(12,2),salary_max:decimal(12,2),"
    "salary_currency:string,salary_period:string>"
)
SKILL_REQUIREMENT = (
    "struct<name:string,proficiency_level_name:string,"
    "requirement_type_name:string,priority:smallint>"
)

#: What parsing yields for one advertisement.
RECORD = {
    "source_job_id": "string",
    "company_name": "string",
    "role_name": "string",
    "seniority_level_name": "string",
    "source_url": "string",
    "source_published_at": "timestamp",
    "source_updated_at": "timestamp",
    "raw_advertisement": "string",
    "content_fingerprint": "string",
    "locations": "array<string>",
    "work_modes": "array<string>",
    "employment_options": f"array<{EMPLOYMENT_OPTION}>",
    "compensation": COMPENSATION,
    "skill_requirements": f"array<{SKILL_REQUIREMENT}>",
}

#: One row per posting; the canonical link is part of the row because a posting
#: has exactly one.
POSTINGS = {
    "posting_key": "string",
    "source_key": "string",
    **RECORD,
    "retrieved_at": "timestamp",
    "last_seen_at": "timestamp",
    "status": "string",
    "normalization_version": "string",
    "created_at": "timestamp",
    "updated_at": "timestamp",
    "run_id": "string",
    "canonical_id": "string",
    "match_method": "string",
    "matched_at": "timestamp",
}

LEDGER = {
    "source_id": "string",
    "run_id": "string",
    "source_key": "string",
    "raw_path": "string",
    "retrieved_at": "timestamp",
    "record_count": "int",
    "payload_sha256": "string",
    "status": "string",
    "processed_records": "int",
    "parser_version": "string",
    "error_message": "string",
    "attempt_id": "string",
    "processing_started_at": "timestamp",
    "processed_at": "timestamp",
    "created_at": "timestamp",
    "updated_at": "timestamp",
}

ERRORS = {
    "source_id": "string",
    "run_id": "string",
    "source_job_id": "string",
    "stage": "string",
    "error_type": "string",
    "error_message": "string",
    "created_at": "timestamp",
}


def ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in fields.items())
