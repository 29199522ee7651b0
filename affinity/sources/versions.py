"""Folders with numbered states.

Data files are only ever added, each write in a folder of its own; a state is one small JSON file that
names the folders it consists of. It is written under another name and renamed last, so a reader sees the
whole old state or the whole new one, and a write that fails on the way leaves the old one in force. Several
readers may go on reading older states until ``vacuum`` removes their files. Of two writers that started from
the same state the later one fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class StaleStateError(RuntimeError):
    """Another writer has published the state that was to be published."""


def _files(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _names(spark: SparkSession, path: str) -> list[str]:
    system, folder = _files(spark, path)
    return [f.getPath().getName() for f in system.listStatus(folder)] if system.exists(folder) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of all states that are there, in order."""
    found = (name.removesuffix(".json") for name in _names(spark, f"{path}/_states") if name.endswith(".json"))
    return sorted(int(name) for name in found if name.isdigit())


def read_state(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """A state, by default the last one; None where nothing has been published. ``version`` is among its values."""
    known = versions(spark, path)
    if version is None and not known:
        return None
    if version is not None and version not in known:
        raise ValueError(f"{path} has no state {version}")
    version = known[-1] if version is None else version
    text = spark.read.text(f"{path}/_states/{version:010d}.json", wholetext=True).first()[0]
    return json.loads(text) | {"version": version}


def new_folder(version: int, kind: str) -> str:
    """A name for a folder that no other write uses."""
    return f"{kind}/v{version:010d}-{uuid.uuid4().hex}"


def publish(spark: SparkSession, path: str, state: dict, version: int) -> None:
    """Make ``state`` the state ``version``, which must be one more than that it was made from."""
    system, final = _files(spark, f"{path}/_states/{version:010d}.json")
    _, draft = _files(spark, f"{path}/_states/.draft-{uuid.uuid4().hex}")
    out = system.create(draft, False)
    out.write(bytearray(json.dumps({k: v for k, v in state.items() if k != "version"}).encode()))
    out.close()
    if system.exists(final) or not system.rename(draft, final):
        system.delete(draft, False)
        raise StaleStateError(f"state {version} of {path} has been published by another writer")


def vacuum(spark: SparkSession, path: str, folders_of, keep: int = 1) -> list[str]:
    """Delete all states but the last ``keep``, and the folders that none of those names; returns what went.

    ``folders_of(state)`` lists a state's folders. Run it when no write is under way.
    """
    known = versions(spark, path)
    states = [read_state(spark, path, v) for v in known[-keep:]]
    used = {f for s in states for f in folders_of(s)}
    gone = [f"{kind}/{name}" for kind in {f.split("/")[0] for f in used} for name in _names(spark, f"{path}/{kind}")]
    gone = sorted(set(gone) - used)
    for name in [f"_states/{v:010d}.json" for v in known[:-keep]] + gone:
        system, target = _files(spark, f"{path}/{name}")
        system.delete(target, True)
    return gone
