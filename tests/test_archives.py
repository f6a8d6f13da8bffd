import io
import json
import tarfile
import zipfile

import pytest

from quarryline.sources import archives


def zipped(path, files, method=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", method) as z:
        for name, text in files.items():
            z.writestr(name, text)


def tarred(path, files, mode="w:gz"):
    with tarfile.open(path, mode) as t:
        for name, text in files.items():
            info = tarfile.TarInfo(name)
            info.size = len(text.encode())
            t.addfile(info, io.BytesIO(text.encode()))


def test_members_of_archives_and_folders(spark, tmp_path):
    files = {"repo/a.py": "a = 1\n", "repo/sub/b.py": "é", "repo/c.txt": "no", "repo/sub/large.py": "x" * 500}
    zipped(tmp_path / "one.zip", files)
    tarred(tmp_path / "two.tar.gz", files)
    tarred(tmp_path / "three.tar", files, "w")
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain/d.py").write_text("d")
    (tmp_path / "broken.tar.gz").write_bytes(b"no tar at all")
    want = {("repo/a.py", "a = 1\n"), ("repo/sub/b.py", "é")}
    got = archives.members(spark, str(tmp_path), most_bytes=100).collect()
    assert {(r.archive, r.name, r.text) for r in got} == {(a, *w) for a in ("one.zip", "two.tar.gz", "three.tar") for w in want} | {(None, "plain/d.py", "d")}
    assert {r.name for r in archives.members(spark, str(tmp_path / "one.zip"), suffix="").collect()} == set(files)
    assert archives.members(spark, str(tmp_path / "nowhere")).collect() == []


def test_a_large_zip_is_read_by_several_tasks(spark, tmp_path):
    """No task holds the archive: each reads a run of members of bounded size, of which it holds one at a time."""
    files = {f"m{k:03}.py": f"{k}:" + "ab" * 5000 for k in range(60)}
    zipped(tmp_path / "large.zip", files, zipfile.ZIP_STORED)
    df = archives.members(spark, str(tmp_path / "large.zip"), split_bytes=50_000)
    reader = archives.MemberReader({"path": str(tmp_path / "large.zip"), "splitbytes": "50000"})
    parts = reader.partitions()
    assert len(parts) == 15 and df.rdd.getNumPartitions() == 15
    assert all(sum(len(r[3]) for r in reader.read(p)) <= 50_000 for p in parts)
    assert {r.name: r.text for r in df.collect()} == files


def test_common_folders_and_counts(spark, tmp_path):
    zipped(tmp_path / "a.zip", {f"owner-repo/src/{n}.py": n for n in ("z", "x/y", "b")})
    zipped(tmp_path / "b.zip", {"top/only.py": "1"})
    zipped(tmp_path / "c.zip", {"src/a.py": "1", "srcs/a.py": "2"})
    zipped(tmp_path / "d.zip", {"p/q": "0", "p/q.py": "1", "p/q/r.py": "2"})
    rows = archives.code_files(spark, str(tmp_path)).collect()
    got = {(r.archive, r.name) for r in rows}
    assert got == {("a.zip", "z.py"), ("a.zip", "x/y.py"), ("a.zip", "b.py"), ("b.zip", "top/only.py"), ("c.zip", "src/a.py"), ("c.zip", "srcs/a.py"), ("d.zip", "q.py"), ("d.zip", "q/r.py")}
    assert {(r.archive, r.name) for r in archives.code_files(spark, str(tmp_path), most_files=1).collect()} == {("a.zip", "b.py"), ("b.zip", "top/only.py"), ("c.zip", "src/a.py"), ("d.zip", "q.py")}


def test_graphml(spark, tmp_path):
    (tmp_path / "g1.graphml").write_text("""<?xml version="1.0"?><graphml xmlns="http://graphml.graphdrawing.org/xmlns">
      <key id="d0" for="node" attr.name="name" attr.type="string"/><key id="d1" for="edge" attr.name="type" attr.type="string"/>
      <graph edgedefault="directed"><node id="a"><data key="d0">Alpha</data></node><node id="b"/><edge source="a" target="b"><data key="d1">CALLS</data><data key="d9">x</data></edge></graph></graphml>""")
    nodes, edges = archives.graphml(spark, str(tmp_path))
    assert sorted((r.graph_id, r.id, r.attributes) for r in nodes.collect()) == [("g1", "a", {"name": "Alpha"}), ("g1", "b", {})]
    assert [tuple(r) for r in edges.collect()] == [("g1", "a", "b", {"type": "CALLS", "d9": "x"})]


@pytest.mark.parametrize(
    ("edges", "want"),
    [
        ([{"source": "a", "target": "b", "type": "CALLS", "key": 1}, {"src": "b", "dst": "c"}], {("a", "b", "CALLS", "1"), ("b", "c", None, None)}),
        ([["a", "b"], ["b", "c"]], {("a", "b", None, None), ("b", "c", None, None)}),
        ({"a": ["b", "c"], "b": {"c": {"type": "IMPORTS"}}, "c": "a", "d": []}, {("a", "b", None, None), ("a", "c", None, None), ("b", "c", "IMPORTS", None), ("c", "a", None, None)}),
    ],
)
def test_graphs_of_any_form(spark, tmp_path, edges, want):
    for name, key in (("x", "edges"), ("y", "links")):
        (tmp_path / f"{name}.json").write_text(json.dumps({"nodes": [{"id": "a", "name": "A"}, "b"], key: edges}))
    nodes, got, others = archives.any_graphs(spark, str(tmp_path))
    assert sorted((r.graph_id, r.id) for r in nodes.collect()) == [("x", "a"), ("x", "b"), ("y", "a"), ("y", "b")]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == {(g, *w) for g in "xy" for w in want}
    assert others.collect() == []


def test_what_is_no_graph_stays_raw(spark, tmp_path):
    (tmp_path / "raw.json").write_text('{"modules": {"a": 1}}')
    (tmp_path / "list.json").write_text("[1, 2]")
    (tmp_path / "bad.json").write_text("{oops")
    nodes, edges, others = archives.any_graphs(spark, str(tmp_path))
    assert nodes.collect() == [] and edges.collect() == []
    assert {r.graph_id: r.raw.toPython() if r.raw is not None else None for r in others.collect()} == {"raw": {"modules": {"a": 1}}, "list": [1, 2], "bad": None}
    assert all(x.collect() == [] for x in archives.any_graphs(spark, str(tmp_path / "nowhere")))
