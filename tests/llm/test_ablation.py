"""The ablation over documents."""

from marketvane.llm import quality_rules
from marketvane.llm.queries import QUERIES
from tests.llm.test_operators import SCHEMA, corpus


def test_ablation_is_a_query(spark, tmp_path):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["rule"]: r for r in QUERIES["op9_rule_ablation"](spark, str(tmp_path)).collect()}
    failed = [r["failed"] & quality_rules.policy_mask("v1") for r in quality_rules.ledger(docs).collect()]
    for rule in quality_rules.rules():
        if rule.mask & quality_rules.policy_mask("v1"):
            r = got.pop(rule.name)
            assert r["n_failed"] == sum(bool(f & rule.mask) for f in failed) and r["n_only"] == failed.count(rule.mask)
            assert r["n_kept_without"] == sum(not f & ~rule.mask for f in failed)
    assert not got
