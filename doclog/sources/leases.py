"""Signs of life of the consumers of target tables, and taking over from one that is lost.

A consumer owns its target through the table's last commit. While a run works, which can take longer than the time
after which a consumer counts as lost, it leaves small files `_beats/T.json` beside the commits (T in milliseconds)
and deletes all but the last few. A takeover is a commit that must follow the one it was judged by, so of several nodes one
replaces a lost owner, and an owner that was only slow gets `CommitConflict` when it publishes.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from doclog import schema as S
from doclog.sources import files, tables

_WIDTH = 15
KEPT = 8
"""Signs that stay, so that one which is being read does not go."""


def beat(spark: SparkSession, path: str, node: str, now: float | None = None) -> str:
    """Leave a sign of life of `node` for the table at `path`; the file's name comes back."""
    now = time.time() if now is None else now
    while True:
        name = f"{path}/_beats/{int(now * 1000):0{_WIDTH}d}.json"
        try:
            files.create_new(spark, name, json.dumps({"node": node, "ts": now}))
            return name
        except Exception:
            if not files.exists(spark, name):
                raise
            now += 0.001


def last_beat(spark: SparkSession, path: str, node: str) -> float:
    """When `node` last gave a sign of life for the table; 0 when it never did."""
    for name in sorted((n for n in files.names(spark, f"{path}/_beats") if n[0].isdigit()), reverse=True):
        try:
            found = json.loads(files.read_text(spark, f"{path}/_beats/{name}"))
        except Exception:
            if files.exists(spark, f"{path}/_beats/{name}"):
                raise
            continue  # its consumer has left a later one since
        if found["node"] == node:
            return found["ts"]
    return 0.0


def _clear(spark: SparkSession, path: str, keep: int) -> None:
    old = sorted(n for n in files.names(spark, f"{path}/_beats") if n[0].isdigit())[:-keep]
    for name in old:
        files.remove(spark, f"{path}/_beats/{name}")


@contextmanager
def alive(spark: SparkSession, path: str, node: str | None, every: float = S.ALIVE_SECONDS / 4) -> Iterator[None]:
    """Give signs of life every `every` seconds while the body runs. An owner without a name gives none."""
    if not node:
        yield
        return
    done = threading.Event()

    def work() -> None:
        while not done.wait(every):
            try:
                beat(spark, path, node)
                _clear(spark, path, KEPT)
            except Exception:  # a sign that could not be left; the next one may be
                continue

    thread = threading.Thread(target=work, daemon=True)
    thread.start()
    try:
        yield
    finally:
        done.set()
        thread.join()
        _clear(spark, path, 1)


def take_over(
    spark: SparkSession, root: str, target: str, node: str, alive_seconds: float = S.ALIVE_SECONDS
) -> bool:
    """Make `node` the owner of a target whose owner has given no sign for `alive_seconds`; False when it lives, was
    stopped, is `node` itself, or somebody else was first. The position stays."""
    path = f"{root}/{target}"
    at = tables.last_commit(spark, path)
    if at is None or not at.node.strip() or at.node == node:
        return False
    if time.time() - max(at.ts, last_beat(spark, path, at.node)) < alive_seconds:
        return False
    try:
        tables.move_position(spark, path, at.position, node, time.time(), base=at)
    except tables.CommitConflict:
        return False
    return True
