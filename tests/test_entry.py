import importlib
import sys

import pytest


@pytest.fixture
def fresh(monkeypatch):
    """The entry module, imported anew while some modules cannot be imported."""

    def make(*absent):
        for name in [m for m in sys.modules if m.startswith("millrace.llm") or m in ("corpus_pipeline", "__spark_entry__")]:
            monkeypatch.delitem(sys.modules, name)
        for name in absent:
            monkeypatch.setitem(sys.modules, name, None)
        return importlib.import_module("__spark_entry__")

    return make


@pytest.mark.parametrize("absent", ["millrace.llm", "millrace.llm.queries"])
def test_queries_without_the_folders(fresh, absent):
    entry = fresh(absent)
    assert "g9_trending" in entry.queries() and not any(q.startswith("op") or q == "pipeline" for q in entry.queries())
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_a_missing_library_leaves_the_other_queries(fresh):
    if importlib.util.find_spec("millrace.llm") is None:
        pytest.skip("without the folder")
    with pytest.warns(UserWarning, match="public_tokenizers"):
        assert "g9_trending" in fresh("public_tokenizers").queries()


def test_a_broken_module_of_ours_is_an_error(fresh):
    if importlib.util.find_spec("millrace.llm") is None:
        pytest.skip("without the folder")
    with pytest.raises(ModuleNotFoundError):
        fresh("millrace.llm.textnum")
