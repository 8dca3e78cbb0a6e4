"""Registry of the training-data queries: one ``opN_<name>`` per operator."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, decontaminate, langid, merkle, pii, quality, quality_rules, sharding, simhash, simhash_sql, spelling, toxicity, url_rules

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_simhash": simhash.op1,
        "op2_quality": quality.op2,
        "op3_sharding": sharding.op3,
        "op4_pii": pii.op4,
        "op5_quality_rules": quality_rules.op5,
        "op6_url_rules": url_rules.op6,
        "op7_decontaminate": decontaminate.op7,
        "op8_toxicity": toxicity.op8,
        "op9_bpe": bpe.op9,
        "op10_language": langid.op10,
        "op11_spelling": spelling.op11,
        "op12_merkle": merkle.op12,
        "op13_chat": chat.op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_simhash": simhash_sql.OP1_SQL,
        "op3_sharding": sharding.OP3_SQL,
        "op4_pii": pii.OP4_SQL,
        "op5_quality_rules": quality_rules.OP5_SQL,
        "op6_url_rules": url_rules.OP6_SQL,
        "op7_decontaminate": decontaminate.OP7_SQL,
        "op11_spelling": spelling.OP11_SQL,
        "op12_merkle": merkle.OP12_SQL,
        "op13_chat": chat.OP13_SQL,
    }
