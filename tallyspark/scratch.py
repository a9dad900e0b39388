"""Owners of scratch folders.

Whatever an operator writes for itself (staged intermediates, stream outputs of a run) lies in a
folder of its own under the shared checkpoint folder and belongs to a ``Scratch``: the innermost
one open in the calling code, or else the session's, which is closed when Python exits. Closing
deletes the folders. Results are lazy, so a ``Scratch`` is closed when the readers of its folders
are done::

    with Scratch(spark):
        top_with_ties(trades).write.parquet(target)
"""

from __future__ import annotations

import atexit
import contextlib
import uuid
from contextvars import ContextVar, Token

from pyspark.sql import SparkSession

from tallyspark.session import scratch_path
from tallyspark.sources.files import delete_folder

_open: ContextVar[Scratch | None] = ContextVar("tallyspark_scratch", default=None)
_of_session: dict[str, Scratch] = {}


class Scratch:
    """Folders that are deleted together."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folders: list[str] = []
        self._inner: list[Scratch] = []
        self._outer: list[Token] = []

    def own(self, path: str) -> str:
        self.folders.append(path)
        return path

    def after(self, inner: Scratch) -> None:
        """Close another owner, if nobody did, together with this one."""
        self._inner.append(inner)

    def close(self) -> None:
        """Delete the folders. What still reads them fails afterwards."""
        while self._inner:
            self._inner.pop().close()
        while self.folders:
            delete_folder(self.spark, self.folders.pop())

    def __enter__(self) -> Scratch:
        self._outer.append(_open.set(self))
        return self

    def __exit__(self, *failure) -> None:
        _open.reset(self._outer.pop())
        self.close()

    @contextlib.contextmanager
    def building(self):
        """Own what is written inside, without closing at the end."""
        token = _open.set(self)
        try:
            yield self
        finally:
            _open.reset(token)


def session_scratch(spark: SparkSession) -> Scratch:
    """The owner of last resort, closed at exit."""
    application = spark.sparkContext.applicationId
    if application not in _of_session:
        _of_session[application] = Scratch(spark)
        atexit.register(_close_quietly, _of_session[application])
    return _of_session[application]


def _close_quietly(scratch: Scratch) -> None:
    with contextlib.suppress(Exception):  # the session may have been stopped before
        scratch.close()


def new_folder(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared folder, owned by the innermost open ``Scratch``."""
    owner = _open.get()
    if owner is None:
        owner = session_scratch(spark)
    *kind, label = parts
    return owner.own(scratch_path(spark, *kind, f"{label}-{uuid.uuid4().hex}"))


__all__ = ["Scratch", "new_folder", "session_scratch"]
