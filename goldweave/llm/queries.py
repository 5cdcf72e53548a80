"""The queries of the training-data operators, and their DuckDB SQL where SQL can say the same."""

from . import chat, classifier, decontaminate, licenses, lines, mixing, passages, quality_rules, sharding, simhash
from .common import table


def op10_simhash_near_dedup(spark, sf_dir):
    from .common import written

    return simhash.linked(written(simhash.fingerprints(table(spark, sf_dir, "documents")))).withColumnRenamed("fp", "_fp").selectExpr(
        "doc_id", "lower(lpad(hex(_fp), 16, '0')) AS fingerprint", "component_id"
    )


QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_quality_classifier": classifier.op2_quality_classifier,
    "op3_mixing": mixing.op3_mixing,
    "op4_line_dedup": lines.op4_line_dedup,
    "op5_chat_formatting": chat.op5_chat_formatting,
    "op6_sharding": sharding.op6_sharding,
    "op7_substring_dedup": passages.op7_substring_dedup,
    "op8_benchmark_decontamination": decontaminate.op8_benchmark_decontamination,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
}

ORACLE_SQL = {
    "op1_license_scan": licenses.OP1_SQL,
    "op3_mixing": mixing.OP3_SQL,
    "op4_line_dedup": lines.OP4_SQL,
    "op5_chat_formatting": chat.OP5_SQL,
}
