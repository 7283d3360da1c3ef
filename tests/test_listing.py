"""The complete listing against a walk of the folder."""

import os

import pytest

from siltworks.sources import listing
from siltworks.sources.files import inventory_lines


def walked(root):
    found = []
    for folder, _, names in os.walk(root):
        for name in names:
            path = os.path.join(folder, name)
            found.append((path, os.path.relpath(path, root), name, os.path.getsize(path)))
    return sorted(found)


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "a folder+%20é"
    for place, content in {
        "top.txt": "x", "empty.txt": "", ".hidden": "abc", "_SUCCESS": "", "noext": "12",
        "day=1/a.json": "{}", "day=1/_temporary/b.json": "", "day=1/.c.crc": "crc", "deep/er/est/z.tar.gz": "zz",
        "deep/.git/config": "", "two words/#1 ä.txt": "ü",
    }.items():
        (root / place).parent.mkdir(parents=True, exist_ok=True)
        (root / place).write_text(content, encoding="utf8")
    (root / "no files").mkdir()
    return root


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
@pytest.mark.parametrize("levels", [1, 2, 5])
def test_all_files(spark, tree, prefix, levels):
    path = f"{prefix}{tree}"
    found = listing.inventory_all(spark, path, levels=levels).collect()
    assert sorted((r["place"], r["name"], r["size"]) for r in found) == sorted(w[1:] for w in walked(tree))
    assert all(r["path"] == f"{path}/{r['place']}" for r in found)
    assert {r["name"]: r["type"] for r in found}["z.tar.gz"] == "gz"
    for row in found:
        assert abs(row["modified"].timestamp() - os.path.getmtime(tree / row["place"])) < 1


def test_options(spark, tree):
    names = {r["name"] for r in listing.inventory_all(spark, str(tree), recursive=False).collect()}
    assert names == {"top.txt", "empty.txt", ".hidden", "_SUCCESS", "noext"}
    found = listing.inventory_all(spark, str(tree) + "/", name_glob="*.json")
    assert {r["place"] for r in found.collect()} == {"day=1/a.json", "day=1/_temporary/b.json"}
    line = inventory_lines(found.filter("size > 0")).first()["line"]
    assert line == f"{'a.json':<100}{'json':<10}  {2:<10}"
    with pytest.raises(Exception, match="absent"):
        listing.inventory_all(spark, str(tree / "absent")).collect()
    assert listing.inventory_all(spark, str(tree / "no files")).count() == 0


def test_listed_in_tasks(spark, tree, monkeypatch):
    """The driver lists the first level and nothing below it; a task lists each folder."""
    reader = listing.ListingReader({"path": str(tree)})
    listed = []
    plain = listing.ListingReader._listed

    def noted(self, system, root, place, deep):
        listed.append((place, deep))
        return plain(self, system, root, place, deep)

    monkeypatch.setattr(listing.ListingReader, "_listed", noted)
    parts = reader.partitions()
    assert listed == [("", False)]
    assert {(p.place, p.deep) for p in parts} == {
        ("", False), ("day=1", True), ("deep", True), ("two words", True), ("no files", True)
    }
    assert listing.inventory_all(spark, str(tree)).rdd.getNumPartitions() == len(parts)


def test_many_files(spark, tmp_path, monkeypatch):
    for i in range(60):
        (tmp_path / f"{i}.txt").write_text("x" * i)
    monkeypatch.setattr(listing, "ROWS_PER_BATCH", 7)
    reader = listing.ListingReader({"path": str(tmp_path)})
    batches = list(reader.read(listing.Folder("", False)))
    assert len(batches) == 9 and sum(b.num_rows for b in batches) == 60
    assert listing.inventory_all(spark, str(tmp_path)).groupBy().sum("size").first()[0] == sum(range(60))
