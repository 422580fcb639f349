"""Scratch folder rules and the command line."""

import json
import subprocess
import sys
import os

import pytest

from rxcover.session import checkpoint_dir, scratch_path
from tests import fixtures as fx


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, ckpt=None):
        self.master = master
        self.ckpt = ckpt

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, d):
        self.ckpt = d


class _Session:
    def __init__(self, master, ckpt=None, conf=None):
        self.sparkContext = _Context(master, ckpt)
        self.conf = _Conf(conf or {})


def test_cluster_without_checkpoint_dir_is_an_error():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session("yarn"))


def test_configured_checkpoint_dir_is_used():
    assert checkpoint_dir(_Session("yarn", conf={"spark.checkpoint.dir": "hdfs:///shared/ckpt/"})) == \
        "hdfs:///shared/ckpt"
    assert scratch_path(_Session("k8s://x", ckpt="s3a://b/c"), "a", "b") == "s3a://b/c/rxcover/a/b"


def test_local_without_checkpoint_dir_gets_one():
    s = _Session("local[2]")
    d = checkpoint_dir(s)
    assert d and s.sparkContext.getCheckpointDir() == d


def test_command_line_build(tmp_path):
    item24, item25 = fx.release(tmp_path)
    env = dict(os.environ, PYTHONPATH=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-m", "rxcover", "--local", "build", "--products", item24,
                          "--classifications", item25, "--out", str(tmp_path / "out"),
                          "--row-tag", "VMP", "--row-tag", "REC"],
                         capture_output=True, text=True, env=env, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    result = json.loads(out.stdout.strip().splitlines()[-1])
    assert result["metrics"]["spine_rows"] == 6
