import os
import pathlib
import subprocess
import sys

import __spark_entry__

ROOT = pathlib.Path(__file__).parent.parent


def test_every_sql_has_its_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert len(__spark_entry__.queries()) >= 47


def test_import_without_the_corpus_operators():
    code = """
import sys
class Gone:
    def find_spec(self, name, *_):
        if name.startswith("mergewell.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert "candidate_topk" in e.queries() and not any(n.startswith("op") or n == "pipeline" for n in e.queries()), e.queries().keys()
assert "candidate_topk" in e.oracle_sql()
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, env=os.environ | {"PYTHONPATH": str(ROOT)})


def test_errors_inside_the_corpus_operators_are_not_hidden():
    code = """
import sys
class Broken:
    def find_spec(self, name, *_):
        if name == "tokenizers" or name.endswith(".token_store"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Broken())
try:
    import __spark_entry__
except ImportError:
    sys.exit(0)
sys.exit("the error was swallowed")
"""
    if (ROOT / "mergewell" / "llm").exists():
        subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, env=os.environ | {"PYTHONPATH": str(ROOT)})


def test_no_column_of_a_feature_query_is_constant(spark):
    """The tables that queries run on vary every feature but the equality of names, which two different parts hardly have."""
    from mergewell import queries
    from pyspark.sql import functions as F

    for name in ("addr_features", "tri_state_matches", "length_features", "feature_vector_21"):
        df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
        counts = df.agg(*[F.countDistinct(c).alias(c) for c in df.columns]).first().asDict()
        assert all(n > 1 for c, n in counts.items() if c != "name_exact_match"), (name, counts)
    kinds = {r.kind for r in queries.QUERIES["block_keys"](spark, "/root/testdata/sf0.001").select(F.split("key", "::")[0].alias("kind")).collect()}
    assert kinds == {f"{c}{k}" for c in ("", "C_") for k in ("PRE", "TOK", "ZIP", "LONG")}
    for name in ("missing_entities", "audit_issues", "self_matches", "invalid_targets"):
        assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    assert queries.QUERIES["idf_top"](spark, "/root/testdata/sf0.01").count() == 10_000


def test_nothing_else_imports_them():
    for path in (ROOT / "mergewell").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "llm" not in path.read_text(), path


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns[:2] == ["s1_id", "target_id"]
