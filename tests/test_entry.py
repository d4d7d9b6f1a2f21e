"""The driver contract, with and without the subpackage of text operators."""

import importlib
import sys

import catalog


class Hidden:
    """An import finder that refuses some modules."""

    def __init__(self, *names):
        self.names = names

    def find_spec(self, name, path=None, target=None):
        if name in self.names:
            raise ModuleNotFoundError(name, name=name)


def loaded(monkeypatch, *hidden):
    for name in list(sys.modules):
        if name in ("__spark_entry__", "corpus_pipeline") or name.startswith("tessella.llm"):
            monkeypatch.delitem(sys.modules, name)
    if hidden:
        monkeypatch.setattr(sys, "meta_path", [Hidden(*hidden), *sys.meta_path])
    return importlib.import_module("__spark_entry__")


def test_core_queries_without_the_text_operators(monkeypatch):
    for hidden in ("tessella.llm", "corpus_pipeline"):
        entry = loaded(monkeypatch, hidden)
        assert entry.queries() == catalog.QUERIES and entry.oracle_sql() == catalog.ORACLES


def test_core_queries_without_a_library_of_theirs(monkeypatch):
    for name in ("tiktoken", "sentencepiece"):
        monkeypatch.delitem(sys.modules, name, raising=False)
    entry = loaded(monkeypatch, "tiktoken", "sentencepiece")
    assert entry.queries() == catalog.QUERIES


def test_every_sql_has_its_query(monkeypatch):
    entry = loaded(monkeypatch)
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(catalog.QUERIES) <= set(entry.queries())
