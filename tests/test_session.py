"""Checkpoint-folder rules: read it from the session, never invent a local
folder on a cluster, set a fresh one only in local mode when none is set."""

import os
import subprocess
import sys

import pytest

from tessera import session


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf=None, current=None):
        self.master = master
        self._conf = _Conf(conf or {})
        self._dir = current

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = f"file:{d}/fresh-uuid"

    def getConf(self):
        return self._conf


class _Session:
    def __init__(self, ctx):
        self.sparkContext = ctx


def test_configured_folder_is_used():
    s = _Session(_Context("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt"}))
    assert session.checkpoint_root(s).startswith("file:hdfs://nn/shared/ckpt")
    assert session.ensure_local_checkpoint_dir(s).startswith("file:hdfs://nn/shared/ckpt")


def test_cluster_without_folder_fails():
    s = _Session(_Context("yarn"))
    with pytest.raises(RuntimeError):
        session.checkpoint_root(s)
    with pytest.raises(RuntimeError):
        session.ensure_local_checkpoint_dir(s)


def test_local_without_folder_gets_a_fresh_one():
    s = _Session(_Context("local[4]"))
    path = session.ensure_local_checkpoint_dir(s)
    assert "tessera-ckpt-" in path


def test_existing_context_folder_wins():
    s = _Session(_Context("local[4]", {"spark.checkpoint.dir": "/other"}, current="file:/already/set"))
    assert session.ensure_local_checkpoint_dir(s) == "file:/already/set"
    assert session.scratch_path(s, "x").startswith("file:/already/set/x-")


@pytest.mark.parametrize("missing", ["xxhash", "tokenizers", "public_tokenizers", "tessera.llm", "corpus_pipeline"])
def test_entry_works_without_what_only_the_training_data_queries_use(missing):
    code = f"""
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r}:
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
from tessera.plans.catalog import QUERIES
assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())
# A package that only workers import leaves the queries registered.
assert {missing!r} == "tokenizers" or set(entry.queries()) == set(entry.oracle_sql()) == set(QUERIES)
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
