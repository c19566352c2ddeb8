import json
import threading

import pytest

import scorekit as sk
import scorekit.plans.jobs as jobs
from scorekit.sources import releases
from scorekit.sources.files import names_in, put_in_place, read_small, write_small
from tests.test_jobs import SMALL_FOREST, tables  # noqa: F401


def publish(spark, root, rows, **facts):
    staged = sk.stage_release(root, ["rows"])
    spark.range(rows).write.parquet(staged["rows"])
    return sk.publish_release(spark, staged, **facts)


def rows_of(spark, root):
    return spark.read.parquet(sk.current_release(spark, root)["rows"]).count()


def test_the_last_release_is_the_current_one(spark, tmp_path):
    root = f"file:{tmp_path}/r/"
    with pytest.raises(FileNotFoundError):
        sk.current_release(spark, root)
    for rows in (3, 5, 7):
        published = publish(spark, root, rows, size=rows)
        assert rows_of(spark, root) == rows
        assert sk.current_release(spark, root) == published
    assert [r.facts["size"] for r in sk.list_releases(spark, root)] == [7, 5, 3]


def test_what_is_staged_is_not_seen(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, 3)
    staged = sk.stage_release(root, ["rows", "more"])
    spark.range(9).write.parquet(staged["rows"])
    assert rows_of(spark, root) == 3
    with pytest.raises(ValueError, match="more"):
        sk.publish_release(spark, staged)
    assert rows_of(spark, root) == 3
    sk.discard_staged(spark, staged)
    assert not (tmp_path / staged.version).exists()


@pytest.mark.parametrize("text", ["", '{"version": "x"', "nonsense"])
def test_a_manifest_that_is_not_whole_is_passed_over(spark, tmp_path, text):
    root = str(tmp_path)
    publish(spark, root, 3)
    (tmp_path / "_releases" / "0000000002.json").write_text(text)
    (tmp_path / "_releases" / "note.txt").write_text("not a manifest")
    assert rows_of(spark, root) == 3
    assert publish(spark, root, 4).number == 3
    assert rows_of(spark, root) == 4


def test_manifests_are_never_replaced(spark, tmp_path, monkeypatch):
    """Another job has published in between: the listing was of before."""
    root = str(tmp_path)
    publish(spark, root, 3)
    publish(spark, root, 4)
    listings = [["0000000001.json"]]
    monkeypatch.setattr(
        releases, "names_in", lambda *a: listings.pop() if "_releases" in a[1] and listings else names_in(*a)
    )
    assert publish(spark, root, 5).number == 3
    assert [r.number for r in sk.list_releases(spark, root)] == [3, 2, 1]


def test_many_publish_at_once(spark, tmp_path):
    root = str(tmp_path)
    threads = [threading.Thread(target=publish, args=(spark, root, n)) for n in range(1, 6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(r.number for r in sk.list_releases(spark, root)) == [1, 2, 3, 4, 5]
    assert len({r.version for r in sk.list_releases(spark, root)}) == 5


def test_old_releases_are_removed(spark, tmp_path):
    root = str(tmp_path)
    for rows in (3, 5, 7):
        publish(spark, root, rows)
    staged = sk.stage_release(root, ["rows"])
    spark.range(1).write.parquet(staged["rows"])
    assert [r.number for r in sk.remove_releases(spark, root, keep=2)] == [1]
    assert len(sk.list_releases(spark, root)) == 2 and rows_of(spark, root) == 7
    with pytest.raises(ValueError):
        sk.remove_releases(spark, root, keep=0)
    assert sk.publish_release(spark, staged).number == 4


def test_a_failed_move_puts_the_old_folder_back(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "old").write_text("x")
    with pytest.raises(Exception):
        put_in_place(spark, str(tmp_path / "missing"), str(tmp_path / "a"))
    assert [p.name for p in (tmp_path / "a").iterdir()] == ["old"]
    assert [p.name for p in tmp_path.iterdir()] == ["a"]


def test_small_files(spark, tmp_path):
    path = f"file:{tmp_path}/x.json"
    write_small(spark, path, "é\n")
    assert read_small(spark, path) == "é\n"
    with pytest.raises(Exception):
        write_small(spark, path, "other")
    assert read_small(spark, path) == "é\n"


def test_model_and_predictions_are_published_together(spark, tables, tmp_path):  # noqa: F811
    root = str(tmp_path / "r")
    result, release = sk.train_release(*tables, "rf", root, **SMALL_FOREST)
    assert sk.current_release(spark, root) == release
    assert release.facts["valid_rows"]["scanned"] == 300
    assert release.facts["train_rows"] == {"scanned": 900, "bad": 0, "dropped": result.train_counts.dropped}
    again = sk.score(sk.load_model(release["model"]), sk.prepare(tables[1]))
    saved = sk.read_predictions(spark, release["predictions"])
    assert sorted(r.prediction for r in again.collect()) == sorted(r.prediction for r in saved.collect())
    scored, other = sk.predict_release(tables[1], root, str(tmp_path / "p"))
    assert other.facts["model"] == {"root": root, "number": 1}
    assert scored.metrics.first() == result.metrics.first()
    json.dumps(other.facts, allow_nan=False)


@pytest.mark.parametrize("step", ["save_model", "write_predictions", "publish_release"])
def test_a_failure_after_a_write_leaves_the_old_release(spark, tables, tmp_path, monkeypatch, step):  # noqa: F811
    root = str(tmp_path / "r")
    _, before = sk.train_release(*tables, "rf", root, **SMALL_FOREST)
    done = getattr(jobs, step)

    def fail(*args, **options):
        if step != "publish_release":
            done(*args, **options)
        raise RuntimeError("injected")

    monkeypatch.setattr(jobs, step, fail)
    with pytest.raises(RuntimeError, match="injected"):
        sk.train_release(*tables, "rf", root, **SMALL_FOREST)
    assert sk.list_releases(spark, root) == [before]
    sk.load_model(before["model"])
    assert sk.read_predictions(spark, before["predictions"]).count() > 0
    assert sorted(p.name for p in (tmp_path / "r").iterdir()) == sorted(["_releases", before.version])
