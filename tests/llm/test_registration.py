"""The corpus queries are registered as long as their subpackage is there, and only then."""

import subprocess
import sys

import __spark_entry__ as contract

NAMES = {"op1_toxicity", "op2_sharding", "op3_pieces", "op4_licenses", "op5_token_files", "op6_simhash", "op7_decontamination", "op8_exact_dedup", "op9_quality", "op10_secrets", "op11_packing", "op12_whitening", "op13_merkle", "pipeline"}


def test_queries_are_registered():
    assert NAMES <= set(contract.queries())
    assert {"op4_licenses", "op8_exact_dedup", "op13_merkle"} <= set(contract.oracle_sql())


def test_entry_imports_without_the_subpackage(tmp_path):
    code = f"""
import shutil, sys
shutil.copytree("/root/repo/tessitura", "{tmp_path}/tessitura", ignore=shutil.ignore_patterns("llm", "__pycache__"))
shutil.copy("/root/repo/__spark_entry__.py", "{tmp_path}")
sys.path.insert(0, "{tmp_path}")
import __spark_entry__ as e
print("left", len(e.queries()), [n for n in e.queries() if n.startswith("op") and n[2:3].isdigit() or n == "pipeline"])
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.stdout.endswith("[]\n") and int(done.stdout.split()[1]) > 100, done.stderr[-1500:]
