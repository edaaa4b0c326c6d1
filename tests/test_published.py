"""Loads published as snapshots: atomic, late rows merged, landed files found by their months."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from wardgrid.operators.normalise import declared_kinds
from wardgrid.plans import published
from wardgrid.schemas import DATASETS, Dataset, Resource, text_schema
from wardgrid.sources import snapshots

CRASHES = Dataset("crashes_table", "crash_date", "collision_id", (Resource("crashes", 2020, 2021),), rows_per_file=2)
KINDS = declared_kinds(["collision_id", "crash_date", "borough"])
SCHEMA = text_schema("collision_id", "crash_date", "borough")


def crash(i, day, **more):
    return json.dumps({"collision_id": None if i is None else f"{i:03d}", "crash_date": f"{day}T00:00:00.000"} | more)


class Landing:
    def __init__(self, spark, folder, data=CRASHES, kinds=KINDS):
        self.spark, self.folder, self.root, self.data, self.kinds = spark, folder / "land", str(folder / "t"), data, kinds
        self.folder.mkdir()

    def put(self, name, *lines):
        path = self.folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(lines))

    def load(self, as_of=date(2020, 3, 10), resource="crashes"):
        return published.publish_months(self.spark, {resource: str(self.folder)}, self.data, self.root, as_of, self.kinds, cells=False)

    def rows(self, version=None):
        found = snapshots.read_snapshot(self.spark, self.root, SCHEMA, version).collect()
        return sorted((r["collision_id"] or "", r["crash_date"][:10], r["borough"] or "", r["month"]) for r in found)

    def files(self):
        found = snapshots.read_part(self.spark, self.root, snapshots.latest(self.spark, self.root), "files", snapshots.FILES)
        return {r["path"]: (r["month"], r["rows"], r["low"], r["high"]) for r in found.collect()}

    def states(self):
        return {(r["year"], r["month"]): (r["status"], r["rows"]) for r in published.month_states(self.spark, self.root).collect()}


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


def test_late_rows_are_merged_and_other_files_keep_their_names(landing):
    landing.put("a.json", *[crash(i, "2020-01-05") for i in range(8)], *[crash(i, "2020-02-05") for i in range(20, 24)], crash(50, "2020-03-01"))
    first = landing.load()
    assert (first.version, first.lines, first.taken, first.late) == (1, 13, 13, 0)
    before = landing.files()
    assert sum(m == "01" for m, *_ in before.values()) == 4 and all(n <= 2 for _, n, *_ in before.values())
    # changed, new, and moved to another month; a row of the open month besides
    landing.put("late.json", crash(1, "2020-01-09", borough="X"), crash(9, "2020-01-07"), crash(5, "2020-02-07"), crash(51, "2020-03-02"))
    second = landing.load()
    assert (second.lines, second.taken, second.late, second.refused) == (4, 4, 3, {"crashes": {}})
    assert landing.rows() == sorted(
        [(f"{i:03d}", "2020-01-05", "", "01") for i in (0, 2, 3, 4, 6, 7)] + [("001", "2020-01-09", "X", "01"), ("009", "2020-01-07", "", "01"), ("005", "2020-02-07", "", "02")]
        + [(f"{i:03d}", "2020-02-05", "", "02") for i in (20, 21, 22, 23)] + [("050", "2020-03-01", "", "03"), ("051", "2020-03-02", "", "03")]
    )
    after = landing.files()
    held = {p for p, (m, _, low, high) in before.items() if m != "03" and (low <= "001" <= high or low <= "005" <= high)}
    assert len(held) == 2 == second.files_rewritten
    assert {p for p, (m, *_) in before.items() if m != "03"} - held == set(before) & set(after) and second.files_kept == 4
    assert landing.states()["2020", "01"] == ("loaded", 8) and landing.states()["2020", "02"] == ("loaded", 5) and landing.states()["2020", "03"] == ("open", 2)


def test_nothing_new_changes_nothing(landing):
    landing.put("a.json", crash(1, "2020-01-05"), crash(None, "2020-01-06"), crash(None, "2020-01-06"))
    landing.load()
    rows = landing.rows()
    again = landing.load()
    assert (again.version, again.lines, again.files_read, again.late) == (2, 0, 0, 0) and landing.rows() == rows and len(rows) == 3


def test_only_files_that_meet_a_month_are_read_wherever_they_lie(landing):
    landing.put("year=2020/month=01/a.json", crash(1, "2020-01-05"), crash(2, "2020-03-05"))
    landing.put("year=2020/month=02/b.json", crash(3, "2020-02-05"))
    landing.put("empty.json", "")
    landing.put("junk.json", "{broken", "[1]", crash(7, "soon"), crash(8, "2031-01-01"))
    first = landing.load()
    assert (first.files_read, first.lines, first.taken) == (3, 7, 3) and first.refused == {"crashes": {"malformed": 2, "undated": 1, "outside": 1}}
    # March is open: the file in January's folder is read for it, February's is not
    second = landing.load()
    assert second.files_read == 1 and second.lines == 0 and second.refused == {"crashes": {}}
    assert [r[0] for r in landing.rows()] == ["001", "002", "003"]
    landing.put("year=2020/month=02/b.json", crash(3, "2020-02-05"), crash(4, "2020-02-06"))
    assert landing.load().late == 2 and [r[0] for r in landing.rows()] == ["001", "002", "003", "004"]


def test_a_killed_load_leaves_the_old_state(landing, monkeypatch):
    landing.put("a.json", crash(1, "2020-01-05"))
    landing.load()
    landing.put("b.json", crash(2, "2020-01-06"), crash(3, "2020-02-06"))

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(snapshots, "publish", die)
        landing.load()
    assert [r[0] for r in landing.rows()] == ["001"] and snapshots.versions(landing.spark, landing.root) == [1]
    assert landing.load().late == 2 and [r[0] for r in landing.rows()] == ["001", "002", "003"]
    # files of the killed load are in nobody's way, and go
    assert snapshots.remove_unused(landing.spark, landing.root, keep=1, hours=0) >= 2
    assert [r[0] for r in landing.rows()] == ["001", "002", "003"] and snapshots.versions(landing.spark, landing.root) == [3 - 1]


def test_of_two_loads_at_once_one_wins(landing, monkeypatch):
    landing.put("a.json", crash(1, "2020-01-05"))
    landing.load()
    landing.put("b.json", crash(2, "2020-01-06"))
    publish = snapshots.publish

    def beaten(*arguments):
        monkeypatch.setattr(snapshots, "publish", publish)
        landing.put("c.json", crash(3, "2020-02-06"))
        landing.load()
        return publish(*arguments)

    monkeypatch.setattr(snapshots, "publish", beaten)
    with pytest.raises(snapshots.PublishConflict):
        landing.load()
    assert [r[0] for r in landing.rows()] == ["001", "002", "003"] and landing.rows(1) == [("001", "2020-01-05", "", "01")]
    assert not list((landing.folder.parent / "t" / "_snapshots").glob("_draft*"))
    assert landing.load().lines == 0


def test_resources_keep_to_themselves(spark, tmp_path):
    data = DATASETS["requests"]
    kinds = declared_kinds(["unique_key", "created_date"])
    root = str(tmp_path / "t")
    for name, lines in (("311_legacy", [("1", "2019-12-05")]), ("311_current", [("2", "2020-03-05"), ("3", "2020-06-05")])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.json").write_text("\n".join(json.dumps({"unique_key": k, "created_date": f"{d}T01:00:00.000"}) for k, d in lines))
    for name in ("311_legacy", "311_current", "311_legacy", "311_current"):
        published.publish_months(spark, {name: str(tmp_path / name)}, data, root, date(2020, 6, 10), kinds, cells=False)
    rows = snapshots.read_snapshot(spark, root, text_schema("unique_key"))
    assert sorted(r["unique_key"] for r in rows.collect()) == ["1", "2", "3"]
    only = snapshots.read_snapshot(spark, root, text_schema("unique_key"), months=F.col("year") == "2019")
    assert [r["unique_key"] for r in only.collect()] == ["1"]


def test_new_columns_and_tables_without_a_key(spark, tmp_path):
    data = Dataset("rides", "at", None, (Resource("rides", 2020),), typed=True, float_columns=("riders",))
    landing = Landing(spark, tmp_path, data, None)
    landing.put("a.json", json.dumps({"at": "2020-01-05T00:00:00", "riders": "2"}))
    landing.load(resource="rides")
    landing.put("b.json", json.dumps({"at": "2020-01-05T00:00:00", "riders": "3", "kind": "x"}))
    assert landing.load(resource="rides").late == 1
    rows = snapshots.read_snapshot(spark, landing.root, text_schema("kind"))
    assert sorted((r["kind"] or "") for r in rows.collect()) == ["", "x"]
