"""Schemas of the engine's tables."""

TABLES = {
    "source": "source_id string, source_name string, source_type string, reliability decimal(3,2), describes string, created_at timestamp, updated_at timestamp",
    "batch": "batch_id string, source_id string, entity_type string, file_path string, file_name string, file_hash string, file_size_bytes long, status string, rows_read int, rows_ingested int, rows_skipped int, error_message string, started_at timestamp, finished_at timestamp, events_published_at timestamp, columns array<string>, source_schema_id string, seq long",
    "raw_record": "record_id string, batch_id string, source_id string, entity_type string, source_record_id string, row_number int, payload_hash string, raw_payload map<string,string>, ingested_at timestamp",
    "source_schema": "source_schema_id string, source_id string, first_seen_batch_id string, entity_type string, column_fingerprint string, columns array<string>, schema_version string, created_at timestamp",
    "column_mapping": "mapping_id string, source_schema_id string, source_column string, canonical_field string, mapping_method string, mapping_confidence decimal(4,3), mapping_status string, evidence string, schema_version string, subject string, reviewed_at timestamp, reviewed_by string, created_at timestamp",
    "attribute_observation": "observation_id string, record_id string, batch_id string, source_id string, entity_type string, source_column string, canonical_field string, mapping_status string, value_index int, raw_value string, normalized_value string, value_type string, normalization_method string, is_null_token boolean, observed_at timestamp, subject string",
    "validation_result": "observation_id string, record_id string, batch_id string, source_id string, entity_type string, scope string, canonical_field string, rule_id string, severity string, outcome string, message string",
    "record_validation": "record_id string, batch_id string, source_id string, entity_type string, status string, error_count long, warning_count long, validated_attributes long, unvalidated_attributes long, failed_rules array<string>, error_rules array<string>, ruleset_version string",
    "quarantine_item": "quarantine_id string, record_id string, batch_id string, source_id string, entity_type string, status string, reason_codes array<string>, error_count int, quarantined_at timestamp, reviewed_at timestamp, reviewed_by string, review_note string, updated_at timestamp",
    "quarantine_event": "event_id string, quarantine_id string, record_id string, action string, from_status string, to_status string, reason_codes array<string>, actor string, note string, created_at timestamp",
    "entity": "entity_id string, entity_type string, status string, merged_into_entity_id string, first_seen_record_id string",
    "record_entity_link": "link_id string, record_id string, entity_id string, entity_type string, batch_id string, source_id string, match_method string, match_confidence decimal(4,3), match_status string, role string, linked_at timestamp",
    "entity_identity_key": "key_id string, entity_id string, entity_type string, key_type string, key_value string, strength string, source_record_id string, seq long",
    "match_candidate": "candidate_id string, record_id string, entity_id string, entity_type string, match_method string, match_confidence decimal(4,3), status string, reviewed_at timestamp, reviewed_by string, review_note string, created_at timestamp",
    "entity_merge": "merge_id string, merged_entity_id string, surviving_entity_id string, match_confidence decimal(4,3), records_moved int, keys_moved int, actor string, reason string, created_at timestamp",
    "entity_relationship": "relationship_id string, from_entity_id string, to_entity_id string, relationship_type string, record_id string, batch_id string, source_id string, valid_from timestamp, valid_to timestamp",
    "golden_attribute": "golden_id string, entity_id string, canonical_field string, entity_type string, value string, raw_value string, strategy string, confidence decimal(4,3), winning_record_id string, winning_source_id string, supporting_sources int, competing_values int, evidence string, valid_from timestamp, valid_to timestamp, superseded_by string",
    "record_error": "error_id string, batch_id string, source_id string, entity_type string, row_number int, source_record_id string, raw_payload map<string,string>, raw_payload_bytes binary, stage string, error_type string, error_message string, status string, reviewed_by string, review_note string, occurred_at timestamp",
    "event": "topic string, key string, value string, at timestamp",
}
#: The columns that identify a row.
KEYS = {
    "source": ["source_id"], "batch": ["batch_id"], "raw_record": ["record_id"], "source_schema": ["source_schema_id"], "column_mapping": ["source_schema_id", "source_column"],
    "attribute_observation": ["observation_id"], "validation_result": ["record_id", "observation_id", "rule_id"], "record_validation": ["record_id"], "quarantine_item": ["record_id"], "quarantine_event": ["event_id"],
    "entity": ["entity_id"], "record_entity_link": ["record_id", "role"], "entity_identity_key": ["entity_id", "key_type", "key_value"], "match_candidate": ["record_id", "entity_id"], "entity_merge": ["merge_id"],
    "entity_relationship": ["from_entity_id", "to_entity_id", "relationship_type"], "golden_attribute": ["golden_id"], "record_error": ["batch_id", "row_number"], "event": ["topic", "key", "value"],
}
