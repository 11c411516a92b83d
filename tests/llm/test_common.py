"""The shared folder, and helpers for columns of any name."""

from types import SimpleNamespace

import pytest

from cdrflow.llm import common as C


class Context:
    def __init__(self, master, checkpoint=None):
        self.master, self.checkpoint = master, checkpoint

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, path):
        self.checkpoint = f"file:{path}"


def session(master, named=None, checkpoint=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: named or default), sparkContext=Context(master, checkpoint))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[3,2,1024]"])
def test_a_cluster_needs_a_named_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        C.shared_dir(session(master))
    assert C.shared_dir(session(master, named="hdfs://n/c/")) == "hdfs://n/c"
    assert C.shared_dir(session(master, checkpoint="hdfs://n/d")) == "hdfs://n/d"


def test_one_machine_gets_one_temporary_folder(monkeypatch, tmp_path):
    monkeypatch.setattr(C.tempfile, "mkdtemp", lambda prefix: str(tmp_path / prefix))
    s = session("local[4]")
    assert C.shared_dir(s) == f"file:{tmp_path}/cdrflow-shared-" == C.shared_dir(s)
    assert C.fresh_path(s, "x") != C.fresh_path(s, "x")


def test_a_written_copy_keeps_schema_and_rows(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a', array(1)), (1, 'a', array(1)), (NULL, '', NULL) AS t(n, t, a)")
    copy = C.materialize(df, "copy")
    assert copy.schema.simpleString() == df.schema.simpleString()
    assert sorted(copy.collect(), key=repr) == sorted(df.collect(), key=repr)
    assert C.materialize(df.where("false"), "empty").count() == 0


def test_columns_of_added_names_give_way_whatever_their_case():
    assert C.other_columns(["doc_id", "IDS", "Text"], ["ids"]) == ["doc_id", "Text"]


def test_ascii_lower_leaves_other_letters(spark):
    texts = ["ABC xyz", "\u00c4B\u0130", "", None, "A" * 100_000]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.low for r in rows.select("i", C.ascii_lower(rows["t"]).alias("low")).collect()}
    assert got == {0: "abc xyz", 1: "\u00c4b\u0130", 2: "", 3: None, 4: "a" * 100_000}
