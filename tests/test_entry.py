"""The registry without the training-data package, and without a library that only it needs."""

import importlib
import sys
import warnings

import pytest

import __spark_entry__
from leaguescore.registry import QUERIES


class Blocked:
    """Imports of one module fail as if it were not installed."""

    def __init__(self, name):
        self.name = name

    def find_spec(self, name, path=None, target=None):
        if name == self.name or name.startswith(f"{self.name}."):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return None


def reloaded(monkeypatch, name):
    for loaded in list(sys.modules):
        if loaded.startswith(("leaguescore.llm", "corpus_pipeline", name)):
            monkeypatch.delitem(sys.modules, loaded)
    monkeypatch.setattr(sys, "meta_path", [Blocked(name), *sys.meta_path])
    return importlib.reload(__spark_entry__)


@pytest.fixture(autouse=True)
def afterwards(monkeypatch):
    yield
    monkeypatch.undo()
    importlib.reload(__spark_entry__)


@pytest.mark.parametrize("name", ["corpus_pipeline", "leaguescore.llm"])
def test_league_queries_stay_without_the_package(monkeypatch, name):
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        entry = reloaded(monkeypatch, name)
    assert entry.queries().keys() == QUERIES.keys() == entry.oracle_sql().keys()


def test_a_missing_library_leaves_out_the_training_queries(monkeypatch):
    with pytest.warns(UserWarning, match="left out: absent_library"):
        monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
        monkeypatch.delitem(sys.modules, "corpus_pipeline")

        class Absent(Blocked):
            def find_spec(self, name, path=None, target=None):
                if name == "corpus_pipeline":
                    raise ModuleNotFoundError("No module named 'absent_library'", name="absent_library")
                return None

        monkeypatch.setattr(sys, "meta_path", [Absent("absent_library"), *sys.meta_path])
        entry = importlib.reload(__spark_entry__)
    assert entry.queries().keys() == QUERIES.keys()


def test_a_missing_part_of_the_library_is_an_error(monkeypatch):
    class Broken(Blocked):
        def find_spec(self, name, path=None, target=None):
            if name == "corpus_pipeline":
                raise ModuleNotFoundError("No module named 'leaguescore.sinks'", name="leaguescore.sinks")
            return None

    monkeypatch.delitem(sys.modules, "corpus_pipeline", raising=False)
    monkeypatch.setattr(sys, "meta_path", [Broken(""), *sys.meta_path])
    with pytest.raises(ModuleNotFoundError):
        importlib.reload(__spark_entry__)
