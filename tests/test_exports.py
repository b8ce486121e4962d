import json
import os
from types import SimpleNamespace

import pytest

from citeflow.operators.documents import documents
from citeflow.plans import workspace
from citeflow.sources.exports import read_documents_json, write_documents_json
from citeflow.sources.records import read_records, relative_to
from tests.samples import article, titled, write_file


@pytest.mark.parametrize("codec", ["gzip", "bzip2", "none"])
def test_json_round_trip(spark, tmp_path, codec):
    write_file(tmp_path, "d/baseline/a.xml.gz", article("1", title=titled('q " é')), article("2"))
    folder = str(tmp_path / "d")
    docs = documents(read_records(spark, folder, relative_to(folder)))
    out = str(tmp_path / "out")
    write_documents_json(docs, out, codec)
    back = read_documents_json(spark, out)
    assert back.schema.simpleString() == docs.select(*back.columns).schema.simpleString()
    assert sorted(back.collect()) == sorted(docs.select(*back.columns).collect())


def test_only_json_files_are_documents(spark, tmp_path):
    for name, pmid in (("a/1.json", "1"), ("b/c/2.json", "2"), ("3.json.bak", "3"), ("4.txt", "4")):
        os.makedirs(os.path.dirname(tmp_path / name), exist_ok=True)
        (tmp_path / name).write_text(json.dumps({"pmid": pmid, "other": 1}))
    docs = read_documents_json(spark, str(tmp_path)).collect()
    assert {(d.pmid, d.title) for d in docs} == {("1", None), ("2", None)}


def session(master, named=None, app="app"):
    context = SimpleNamespace(master=master, applicationId=app, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: named), sparkContext=context)


def test_shared_folder():
    assert workspace.shared_dir(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    own = workspace.shared_dir(session("local[2]"))
    assert os.path.isdir(own) and own == workspace.shared_dir(session("local[2]"))
    with pytest.raises(ValueError):
        workspace.shared_dir(session("spark://host:7077"))
