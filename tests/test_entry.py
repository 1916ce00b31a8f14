"""The entry without the optional part, or without a library that only this part needs."""

import subprocess
import sys

import pytest
from conftest import ROOT


@pytest.mark.parametrize("missing", ["larder.llm", "tiktoken", "xxhash", "regex", "corpus_pipeline"])
def test_core_queries_are_there(missing):
    code = (
        f"import sys; sys.modules[{missing!r}] = None; import warnings; warnings.simplefilter('ignore'); import __spark_entry__ as e; "
        "names = e.queries(); assert 'dim_brand' in names and not any(n.startswith('op1') for n in names), names; "
        "assert set(e.oracle_sql()) <= set(names)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
