"""Outputs that belong together, published at once.

A release is some folders of one version, such as a model and its predictions. Each version is written to
folders of its own, which nobody reads until a manifest names them; the manifest is one small new file.
Nothing is ever renamed or replaced, so this holds on object stores too, where renaming a folder copies
it and may stop half-way. Whatever step fails, a reader finds the release before or the new one, whole.

    <root>/_releases/0000000007.json    the manifest of the seventh release
    <root>/<version>/<part>/            its folders
"""

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from scorekit.sources.files import names_in, read_small, remove, write_small

_MANIFESTS = "_releases"


@dataclass(frozen=True)
class Release:
    root: str
    version: str
    paths: Mapping[str, str]
    """Where each part lies."""
    facts: Mapping[str, object] = field(default_factory=dict)
    number: int | None = None
    """None until it is published."""

    def __getitem__(self, part: str) -> str:
        return self.paths[part]


def stage_release(root: str, parts: Sequence[str]) -> Release:
    """Paths below `root` to write the parts of a new version to."""
    root, version = root.rstrip("/"), uuid.uuid4().hex
    return Release(root, version, {part: f"{root}/{version}/{part}" for part in parts})


def publish_release(spark: SparkSession, staged: Release, **facts) -> Release:
    """Make the staged version the current one; its parts must have been written. `facts` are kept in the
    manifest, so they are of what JSON can hold.

    A manifest that another job has written meanwhile is not replaced: creating a file that exists fails,
    and this one takes the next number. The highest number is the current release.
    """
    missing = [part for part, path in staged.paths.items() if not names_in(spark, path)]
    if missing:
        raise ValueError(f"nothing was written for {', '.join(missing)}")
    body = {"version": staged.version, "parts": sorted(staged.paths), "facts": facts}
    for _ in range(100):
        numbers = [_number(name) for name in names_in(spark, f"{staged.root}/{_MANIFESTS}")]
        number = max(numbers, default=0) + 1
        try:
            write_small(spark, _manifest(staged.root, number), json.dumps(body))
        except Exception as error:
            if "AlreadyExists" not in str(error) and "already exists" not in str(error):
                raise
            continue
        return Release(staged.root, staged.version, staged.paths, facts, number)
    raise OSError(f"{staged.root} is published to all the time")


def current_release(spark: SparkSession, root: str) -> Release:
    """The release with the highest number whose manifest is whole."""
    for release in _releases(spark, root):
        return release
    raise FileNotFoundError(f"nothing is published in {root}")


def list_releases(spark: SparkSession, root: str) -> list[Release]:
    """All releases that can still be read, the current one first."""
    return list(_releases(spark, root))


def remove_releases(spark: SparkSession, root: str, keep: int = 1) -> list[Release]:
    """Delete all but the last `keep` releases, manifests first, and return what was deleted.

    Call it when no reader of an older release is left. Versions that were never published, as after a
    failure, are not touched, since they may be in the making.
    """
    if keep < 1:
        raise ValueError("the current release cannot be removed")
    old = list_releases(spark, root)[keep:]
    for release in old:
        remove(spark, _manifest(release.root, release.number))
        remove(spark, f"{release.root}/{release.version}")
    return old


def discard_staged(spark: SparkSession, staged: Release) -> None:
    """Delete the folders of a version that will not be published."""
    remove(spark, f"{staged.root}/{staged.version}")


def _releases(spark: SparkSession, root: str):
    root = root.rstrip("/")
    for number in sorted(map(_number, names_in(spark, f"{root}/{_MANIFESTS}")), reverse=True):
        if not number:
            continue
        try:
            body = json.loads(read_small(spark, _manifest(root, number)))
        except ValueError:
            continue  # it is still being written, or its writer died
        paths = {part: f"{root}/{body['version']}/{part}" for part in body["parts"]}
        yield Release(root, body["version"], paths, body["facts"], number)


def _manifest(root: str, number: int) -> str:
    return f"{root}/{_MANIFESTS}/{number:010d}.json"


def _number(name: str) -> int:
    stem, _, kind = name.partition(".")
    return int(stem) if kind == "json" and stem.isdigit() else 0
